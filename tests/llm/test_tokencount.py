import random

import public_tokenizers
import pytest
import sentencepiece

from stationdw.llm import tokencount
from tests.conftest import SF_ORACLE
from tests.llm.helpers import docs

PATH = public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=PATH)


def test_random_texts(library):
    own = tokencount.PieceCounter(PATH, cache_size=50)
    rng = random.Random(2)
    parts = list("abXY  \n\t\ré中0123.,'<>\x00\xa0▁🙂ﬁ") + ["<s>", "</s>", "<unk>", "<0x0A>",
                                                            " the", "ing", "   ", ");\r\n"]
    for _ in range(6000):
        text = "".join(rng.choice(parts) for _ in range(rng.randint(0, 25)))
        assert own.count(text) == len(library.encode(text)), text


def test_proven_strings_are_one_token(library):
    own = tokencount.PieceCounter(PATH)
    assert len(own.proven) > 25_000
    for p in sorted(own.proven)[::97]:
        if p[0] == tokencount.SPACE and set(p) != {tokencount.SPACE}:
            assert len(library.encode(p[1:].replace(tokencount.SPACE, " "))) == 1


def test_whole_table(spark, library):
    d = spark.read.parquet(f"{SF_ORACLE}/documents.parquet")
    got = {r["doc_id"]: tuple(r)[1:] for r in tokencount.token_counts(d, PATH).collect()}
    want = {}
    for r in d.collect():
        n = len(library.encode(r["text"] or ""))
        want[r["doc_id"]] = (len((r["text"] or "").encode()), n, n > 4096)
    assert got == want


def test_awkward_rows(spark, library):
    d = docs(spark)
    want = sorted(str((r["doc_id"], len((r["text"] or "").encode()),
                       len(library.encode(r["text"] or "")),
                       len(library.encode(r["text"] or "")) > 4096)) for r in d.collect())
    assert sorted(str(tuple(r)) for r in tokencount.token_counts(d, PATH).collect()) == want
    assert tokencount.token_counts(docs(spark, []), PATH).count() == 0
