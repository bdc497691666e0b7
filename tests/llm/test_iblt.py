import hashlib
import re

import pytest
from pyspark.sql import functions as F

from stationdw.llm import iblt
from tests.conftest import SF_ORACLE
from tests.llm.helpers import TEXTS, docs


def paragraphs(text):
    return set(re.findall(iblt.PARAGRAPH, text))


def likeness(a, b):
    return 1.0 if not a and not b else 1 - len(a ^ b) / (len(a) + len(b))


def brute(rows):
    rows = [(i, t or "") for i, t in rows]
    out = []
    for i, (key, text) in enumerate(rows):
        n, after = len(text), rows[(i + 1) % len(rows)][1]
        edited = text[:n - n // 2] + after[:n // 2]
        own = paragraphs(text)
        out.append((key, n, hashlib.sha256(edited.encode()).hexdigest(),
                    round(likeness(own, paragraphs(edited)), 9),
                    round(likeness(own, paragraphs(after)), 9)))
    return out


def plain(df):
    return [(r["doc_id"], r["n_chars"], r["edited_sha256"], round(r["near_edited"], 9),
             round(r["near_next"], 9)) for r in df.collect()]


def test_whole_table(spark):
    d = spark.read.parquet(f"{SF_ORACLE}/documents.parquet")
    rows = [(r["doc_id"], r["text"]) for r in d.orderBy("doc_id").collect()]
    got = iblt.version_fingerprints(d)
    assert sorted(plain(got)) == sorted(brute(rows))
    prints: dict = {}
    text = dict(rows)
    for r in got.collect():
        assert prints.setdefault(text[r["doc_id"]], r["fingerprint"]) == r["fingerprint"]


def test_awkward_rows(spark):
    rows = [r for r in TEXTS if r[0] not in (None, 7)]
    assert sorted(plain(iblt.version_fingerprints(docs(spark, rows)))) == sorted(
        brute([r[:2] for r in rows]))
    everything = iblt.version_fingerprints(docs(spark)).collect()
    assert len(everything) == len(TEXTS)
    assert sum(r["doc_id"] is None for r in everything) == 2
    twice = [tuple(r) for r in everything if r["doc_id"] == 7]
    assert len(twice) == 2 and len(set(twice)) == 1
    assert iblt.version_fingerprints(docs(spark, [])).count() == 0


def test_single_document_is_its_own_next(spark):
    got = iblt.version_fingerprints(docs(spark, [(5, "one line\nand another", None, None)]))
    assert got.first()["near_next"] == 1.0


def test_digests_are_recovered_and_small_sketches_grow(spark):
    rows = [(1, [1, 2, 3], [2, 3, 4]), (2, [], []), (3, [5], [5]), (4, [], [6]),
            (5, list(range(1000, 4000)), list(range(2500, 6000)))]
    pairs = spark.createDataFrame(rows, "pair long, a array<long>, b array<long>")
    got: dict = {}
    for r in iblt.differences(pairs, recover=True).collect():
        got.setdefault((r["pair"], r["side"]), set()).add(r["digest"])
    want = {}
    for p, a, b in rows:
        for side, only in ((1, set(a) - set(b)), (-1, set(b) - set(a))):
            if only:
                want[p, side] = only
    assert got == want
    counts = {r["pair"]: (r["only_a"], r["only_b"])
              for r in iblt.differences(pairs, rounds=1).collect()}
    assert counts == {1: (1, 1), 4: (0, 1), 5: (1500, 2000)}


def test_no_python_in_the_plan(spark):
    d = docs(spark, TEXTS[:2])
    plan = iblt.version_fingerprints(d)._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


def test_paragraphs_in_spark_are_those_of_the_pattern(spark):
    text = "short\n\n" + "A long line goes on. " * 40 + "\n" + "x" * 1000
    n = spark.createDataFrame([(text,)], "t string").select(F.size(iblt.digests(F.col("t")))).first()
    assert n[0] == len(paragraphs(text))


@pytest.mark.parametrize("a,b", [("x\ny", "x\ny"), ("", ""), ("x", "")])
def test_equal_texts_equal_prints(spark, a, b):
    rows = [(1, a, None, None), (2, b, None, None)]
    got = [r["fingerprint"] for r in
           iblt.version_fingerprints(docs(spark, rows)).orderBy("doc_id").collect()]
    assert (got[0] == got[1]) == (a == b)
