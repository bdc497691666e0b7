import itertools
import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from stationdw.llm import mixing
from tests.conftest import SF_ORACLE
from tests.llm.helpers import docs


@settings(max_examples=150, deadline=None)
@given(st.dictionaries(st.integers(0, 30), st.integers(1, 5), min_size=1, max_size=5),
       st.integers(0, 200), st.sampled_from([1, 8, 10_000]))
def test_fit_is_best_from_below(hist, budget, exact_below):
    lengths, counts = zip(*sorted(hist.items()))
    taken = mixing.fit_lengths(lengths, counts, budget, exact_below)
    assert all(0 <= t <= c for t, c in zip(taken, counts))
    total = sum(t * n for t, n in zip(taken.tolist(), lengths))
    assert total <= budget
    if exact_below == 10_000 and budget <= 60:
        sums = {sum(x * n for x, n in zip(pick, lengths)) for pick in itertools.product(
            *[range(c + 1) for c in counts])}
        assert total == max(s for s in sums if s <= budget)


@settings(max_examples=150, deadline=None)
@given(st.dictionaries(st.integers(0, 12), st.integers(1, 4), min_size=1, max_size=4),
       st.floats(0, 100))
def test_fit_is_nearest_of_both_sides(hist, target):
    lengths, counts = zip(*sorted(hist.items()))
    taken = mixing.fit_nearest(lengths, counts, target)
    assert all(0 <= t <= c for t, c in zip(taken, counts))
    sums = {sum(x * n for x, n in zip(pick, lengths)) for pick in itertools.product(
        *[range(c + 1) for c in counts])}
    total = sum(t * n for t, n in zip(taken.tolist(), lengths))
    assert abs(total - target) == pytest.approx(min(abs(s - target) for s in sums))


def test_targets_equal_the_loop_over_sources(spark):
    rng = random.Random(5)
    for n, weights, share in [(1, (5, 2, 1), 1.5), (40, (5, 2, 1), 1.5), (40, (7, 0.5), 3),
                              (300, (5, 2, 1), 0.3), (9, (1,), 2)]:
        names = sorted({f"h{rng.randrange(10 ** 6)}" for _ in range(n)})
        sizes = [rng.choice([0, 3, 50, 50, 10 ** 4, 10 ** 7]) for _ in names]
        rows = [(0, "s" + x, s) for x, s in zip(names, sizes)] + [(1, "", 17)]
        rng.shuffle(rows)
        got = mixing.targets(spark.createDataFrame(rows, "_none int, _key string, size long"),
                             weights, share, 2).toPandas().set_index("_key")
        every = [weights[i % len(weights)] for i in range(len(names) + 1)]
        want = mixing.water_fill(sizes + [17], every, share, 2)
        assert got.loc[["s" + x for x in names] + [""], "target"].tolist() == pytest.approx(want)
        assert got.loc["", "source_size"] == 17


def test_water_fill():
    assert mixing.water_fill([100, 100, 100], [5, 2, 1], 1.5, 2) == [200, 500 / 3, 250 / 3]
    got = mixing.water_fill([10, 1000, 0, 7], [5, 2, 1, 5], 1.5, 2)
    assert sum(got) == pytest.approx(1.5 * 1017) and got[2] == 0 and got[0] == 20
    assert mixing.water_fill([], [], 1.5, 2) == []


def test_whole_table(spark):
    d = spark.read.parquet(f"{SF_ORACLE}/documents.parquet")
    got = mixing.mix(d, keep=("source", "text")).toPandas()
    assert len(got) == d.count()
    assert got["size"].tolist() == [len((t or "").encode().split()) for t in got.text]
    assert set((got.taken // got["size"]).unique()) <= {0, 1, 2}
    by = got.groupby("source").agg(s=("size", "sum"), all=("source_size", "first"),
                                   target=("target", "first"), taken=("taken", "sum"))
    assert (by.s == by["all"]).all() and ((by.taken - by.target).abs() <= 1).all()
    weights = dict(zip(sorted(by.index), itertools.cycle([5, 2, 1])))
    want = mixing.water_fill(by.s.tolist(), [weights[s] for s in by.index], 1.5, 2)
    assert by.target.tolist() == pytest.approx(want)
    again = mixing.mix(d.repartition(7)).toPandas()
    assert sorted(zip(got.doc_id, got.taken)) == sorted(zip(again.doc_id, again.taken))


def test_awkward_rows(spark):
    d = docs(spark)
    rows = mixing.mix(d).toPandas()
    assert len(rows) == d.count()
    assert (rows.taken <= 2 * rows["size"]).all()
    per = rows.groupby("target").taken.sum()
    assert ((per.index - per).abs() <= 60_002).all()
    assert mixing.mix(docs(spark, [])).count() == 0
    none = mixing.mix(docs(spark, [(1, None, None, "a"), (2, "", None, None)])).toPandas()
    assert none.target.tolist() == [0, 0] and none.taken.tolist() == [0, 0]


def test_null_source_comes_last(spark):
    text = " ".join(["w"] * 10)
    rows = [(i, text, None, s) for i, s in enumerate(["b", "a", None, "B"] * 10)]
    got = mixing.mix(docs(spark, rows), keep=("source",)).toPandas()
    target = got.groupby(got.source.fillna("null")).target.first()
    # code point order: B, a, b, null; weights 5, 2, 1, 5
    assert target["B"] == target["null"] == 200 and target["a"] == pytest.approx(400 / 3)


def test_a_hot_length_is_dealt_over_buckets(spark):
    rows = [(i, "one two three", None, "a") for i in range(500)] + [(999, "x", None, "b")]
    got = mixing.mix(docs(spark, rows), weights=(1, 5)).toPandas()
    assert got[got.doc_id < 999].taken.sum() == pytest.approx(1501 * 1.5 - 2, abs=3)
