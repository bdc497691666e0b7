import hashlib
import random
import struct

import public_tokenizers
import pytest
from tokenizers import Tokenizer

from stationdw.llm import bpe
from tests.conftest import SF_ORACLE
from tests.llm.helpers import docs

PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


@pytest.fixture(scope="module")
def own():
    return bpe.WordBpe(PATH, cache_size=100)


def both(library, text):
    ids = library.encode(text or "", add_special_tokens=False).ids
    return ids, library.decode(ids, skip_special_tokens=False)


def test_random_texts(library, own):
    rng = random.Random(1)
    parts = list("abcXYZ  \n\t\r's't0123éÉñßΣσςİı½Ⅷ中文日ि́̀\x00\x1c\x1f\x85\xa0 ​🙂👩‍👧<|>_-.,!?'\"ſﬁＡ")
    parts += ["<|endoftext|>", "<|startoftext|>", " the", "ing", "'ll", "hello", "    "]
    for _ in range(4000):
        text = "".join(rng.choice(parts) for _ in range(rng.randint(0, 30)))
        ids, decoded = both(library, text)
        assert own.encode(text) == ids, text
        assert own.decode(ids) == decoded


@pytest.mark.parametrize("n", [300, 5000])
def test_long_words_take_the_heap(library, own, n):
    rng = random.Random(n)
    for alphabet in ("ab", "the", "abcdefghijklmnop"):
        word = "".join(rng.choice(alphabet) for _ in range(n))
        assert own.encode(word) == both(library, word)[0]


def test_cuts_are_certain(own):
    """No merge of the file ever joins two symbols across a forced boundary."""
    for a, b in list(own.rank)[::7]:
        left, right = own._symbols(a)[-1], own._symbols(b)[0]
        assert (left, right) in own.inside
    assert len(own.fragments("x")) == 1
    assert [s for part in own.fragments("naïve…") for s in part] == [
        own._bytes[b] for b in "naïve…".encode()][:-1] + [own._bytes["…".encode()[-1]] + own.suffix]
    assert any(len(own.fragments(w)) > 1 for w in ("cióñn", "€uro", "zq中"))


def digest(ids, decoded):
    return (len(ids), hashlib.sha256(struct.pack(f"<{len(ids)}I", *ids)).hexdigest(),
            hashlib.sha256(decoded.encode()).hexdigest())


def test_whole_table(spark, library):
    d = spark.read.parquet(f"{SF_ORACLE}/documents.parquet")
    got = {r["doc_id"]: tuple(r)[1:] for r in bpe.bpe_round_trip(d, PATH).collect()}
    assert got == {r["doc_id"]: digest(*both(library, r["text"])) for r in d.collect()}


def test_awkward_rows(spark, library):
    d = docs(spark)
    want = sorted(str((r["doc_id"], *digest(*both(library, r["text"])))) for r in d.collect())
    assert sorted(str(tuple(r)) for r in bpe.bpe_round_trip(d, PATH).collect()) == want
    rows = bpe.encode(d, PATH).collect()
    assert sorted(str((r["doc_id"], *digest(r["ids"], r["decoded"]))) for r in rows) == want
    assert bpe.bpe_round_trip(docs(spark, []), PATH).count() == 0
