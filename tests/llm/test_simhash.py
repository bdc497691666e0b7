import random

import numpy as np
import pytest
import xxhash

from stationdw.llm import graph, simhash
from tests.conftest import SF_ORACLE
from tests.llm.helpers import docs


def slow_print(text):
    words = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    for c in "\t\n\v\f\r":
        words = words.replace(c, " ")
    words = [w for w in words.split(" ") if w]
    if not words:
        return 0
    shingles = [" ".join(words[i:i + 4]) for i in range(max(1, len(words) - 3))]
    h = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def slow_components(rows, budget=4):
    prints = sorted({p for _, p in rows})
    label = {p: p for p in prints}

    def top(p):
        while label[p] != p:
            p = label[p]
        return p

    for i, a in enumerate(prints):
        for b in prints[:i]:
            if (a ^ b).bit_count() <= budget:
                label[top(a)] = top(b)
    least: dict = {}
    for i, p in rows:
        if i is not None:
            least[top(p)] = min(i, least.get(top(p), i))
    return [(i, least.get(top(p))) for i, p in rows]


@pytest.mark.parametrize("text", [None, "", " \n", "One", "a B c", "a b c d", "a b c d e",
                                  "É x y z ab\tcd\x0bef " * 9])
def test_fingerprint(text):
    assert simhash.fingerprint(text) == slow_print(text)


def test_whole_table_against_brute_force(spark):
    d = spark.read.parquet(f"{SF_ORACLE}/documents.parquet")
    got = simhash.near_duplicates(d).toPandas()
    rows = [(r["doc_id"], slow_print(r["text"])) for r in d.collect()]
    assert dict(zip(got.doc_id, got.fingerprint)) == {i: f"{p:016x}" for i, p in rows}
    assert sorted(zip(got.doc_id, got.component_id)) == sorted(slow_components(rows))


@pytest.mark.parametrize("bucket_rows", [4096, 3])
def test_planted_links_are_all_found(spark, bucket_rows):
    """Fingerprints at every distance up to 6 from centres, chains, and a dense group; buckets of
    three rows force every wide bucket through pairs of pieces."""
    rng = random.Random(3)
    prints = set()
    for _ in range(60):
        p = rng.getrandbits(64)
        prints.add(p)
        for _ in range(4):
            for b in rng.sample(range(64), rng.randint(1, 6)):
                p ^= 1 << b
            prints.add(p)
    centre = rng.getrandbits(64)
    prints |= {centre ^ 1 << a ^ 1 << b for a in range(12) for b in range(12)}
    prints = sorted(prints)
    signed = [(p - (1 << 64) if p >> 63 else p,) for p in prints]
    links = simhash.similar_links(spark.createDataFrame(signed, "fp long"), 4, bucket_rows)
    pairs = [((a % (1 << 64)), b % (1 << 64)) for a, b in links.collect()]
    assert all((a ^ b).bit_count() <= 4 * 40 for a, b in pairs)
    groups = {r["node"] % (1 << 64): r["component"] for r in graph.components(links).collect()}
    want = dict(slow_components([(p, p) for p in prints]))
    by: dict = {}
    for p in prints:
        by.setdefault(groups.get(p, ("single", p)), set()).add(p)
    expected: dict = {}
    for p, c in want.items():
        expected.setdefault(c, set()).add(p)
    assert sorted(map(sorted, by.values())) == sorted(map(sorted, expected.values()))
    assert len(pairs) < 30 * len(prints)  # trees, not all pairs


def test_components_of_a_long_path(spark):
    edges = [(i, i + 1) for i in range(200)] + [(500, 501), (501, 502), (7, 7)]
    got = {r["node"]: r["component"]
           for r in graph.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(201)}, 500: 500, 501: 500, 502: 500}


def test_awkward_rows(spark):
    d = docs(spark)
    got = simhash.near_duplicates(d).toPandas()
    assert len(got) == d.count()
    rows = [(r["doc_id"], slow_print(r["text"])) for r in d.collect()]
    want = slow_components(rows)
    key = lambda x: (str(x[0]), str(x[1]))
    assert sorted([(None if np.isnan(a) else int(a), None if np.isnan(b) else int(b))
                   for a, b in zip(got.doc_id, got.component_id)], key=key) == sorted(want, key=key)
    assert simhash.near_duplicates(docs(spark, [])).count() == 0


def test_one_of_each_group_stays(spark):
    d = docs(spark)
    kept = simhash.one_per_group(d)
    assert kept.columns == d.columns
    groups = simhash.near_duplicates(d).select("group").distinct().count()
    ids = [r["doc_id"] for r in kept.collect()]
    assert len(ids) == groups and 6 in ids and 7 not in ids
