"""Alignment against a brute-force version: whole texts, plain loops over all token pairs."""

import hashlib
import random
from collections import Counter

import numpy as np
import public_tokenizers
import sentencepiece
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from stationdw.llm import alignment

from .helpers import TEXTS, docs

A = public_tokenizers.path("byte_bpe_50k.json")
B = public_tokenizers.path("piece_bpe_32k.model")


def brute(rows):
    """{(id, text): rows of the result}, from (id, text) pairs."""
    a, b = Tokenizer.from_file(A), sentencepiece.SentencePieceProcessor(model_file=B)
    a.encode_special_tokens = True
    signs = {c: n for n, c in enumerate(alignment._byte_signs())}

    def of_a(i):
        return bytes(signs[c] for c in a.id_to_token(i))

    def of_b(i):
        piece = b.id_to_piece(i)
        return bytes([int(piece[3:5], 16)]) if b.is_byte(i) else piece.replace("▁", " ").encode()

    links, parts = [], []
    for _, text in rows:
        raw = (" " + (text or "")).encode()
        ids_a = a.encode(raw.decode(), add_special_tokens=False).ids if text else []
        ids_b = b.encode(text) if text else []
        if b"".join(map(of_a, ids_a)) != raw or b"".join(map(of_b, ids_b)) != raw:
            ids_a = ids_b = []

        def spans(ids, of):
            at, out = 0, []
            for i in ids:
                out.append((at, at + len(of(i)), i))
                at = out[-1][1]
            return out
        sa, sb = spans(ids_a, of_a), spans(ids_b, of_b)
        ends = sorted({e for _, e, _ in sa} & {e for _, e, _ in sb})
        cuts = list(zip([0, *ends], ends))
        pairs = []
        first = 0
        for s, e, i in sa:  # every overlapping B token
            while first and sb[first][0] > s:
                first -= 1
            for k in range(first, len(sb)):
                if sb[k][0] >= e:
                    break
                if sb[k][1] > s:
                    pairs.append((i, sb[k][2]))
                    first = k
        groups, x, y = [], 0, 0
        for _, end in cuts:
            ga, gb = [], []
            while x < len(sa) and sa[x][1] <= end:
                ga.append(str(sa[x][2]))
                x += 1
            while y < len(sb) and sb[y][1] <= end:
                gb.append(str(sb[y][2]))
                y += 1
            groups.append(",".join(ga) + "|" + ",".join(gb))
        links.append(pairs)
        parts.append((len(sa), len(sb), groups))
    count = Counter(p for pairs in links for p in pairs)
    most = Counter()
    for (_, i), n in count.items():
        most[i] = max(most[i], n)
    return Counter(
        (doc, n_a, n_b, len(groups), len(pairs), sum(count[p] == most[p[1]] for p in pairs),
         sum(count[p] for p in pairs),
         hashlib.sha256(";".join(groups).encode()).hexdigest() if groups else "")
        for (doc, _), pairs, (n_a, n_b, groups) in zip(rows, links, parts))


def result(df):
    return Counter(tuple(r) for r in df.select(
        "doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum",
        "groups_sha256").collect())


def test_awkward_rows_equal_brute_force(spark):
    rows = [(r[0], r[1]) for r in TEXTS]
    assert result(alignment.align(docs(spark), A, B)) == brute(rows)


def test_random_texts_equal_brute_force(spark):
    """White space of all kinds, strings of special tokens, byte fallbacks, the piece model's own
    space sign (which gives zeros); cut into several blocks."""
    rng = random.Random(5)
    signs = [" ", "\n", "\t", "\r", "\x00", "\x1c", "\u0085", "　", "a", "The", "'s", "é",
             "日本", "🙂", ".", "123", "<s>", "<|endoftext|>", "<0x0A>", "lo", "rem", "aaa"]
    rows = [(i, "".join(rng.choice(signs) for _ in range(rng.randrange(40)))) for i in range(600)]
    rows += [(1000, "a ▁ b"), (1001, "▁"), (1002, "aaaa aaaaa aaaaaa"), (1003, " "), (1004, "\n")]
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    assert result(alignment.align(frame, A, B, block_bytes=2000)) == brute(rows)


def test_given_documents_equal_brute_force(spark):
    frame = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows = [tuple(r) for r in frame.select("doc_id", "text").collect()]
    assert result(alignment.align(frame, A, B)) == brute(rows)


def test_empty_table_and_irregular_pairs_only_are_shuffled(spark):
    frame = spark.createDataFrame([], "doc_id long, text string")
    assert alignment.align(frame, A, B).count() == 0
    both = alignment.Pair(A, B)
    vector = np.zeros(both.size_a, int)
    row = alignment._block_row(both, [1], ["the house of the city"], vector)
    assert vector.sum() == 5 and len(row["pairs"]) == 0  # five one-to-one groups, no pair


def test_extra_columns_with_clashing_names(spark):
    frame = spark.createDataFrame([(1, "the house")], "doc_id long, text string")
    for name in ("block", "n", "pair", "best", "links"):
        frame = frame.withColumn(name, F.lit(1))
    assert result(alignment.align(frame, A, B)) == brute([(1, "the house")])
