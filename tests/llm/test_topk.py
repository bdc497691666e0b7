import math

import numpy as np
import pytest

from stationdw.llm import topk
from tests.conftest import SF_ORACLE
from tests.llm.helpers import vectors


def brute(rows, k=20, every=20):
    good = [(i, np.floor(np.array(v, float) * 64).astype(int)) for i, v in rows
            if i is not None and v is not None and all(
                x is not None and np.isfinite(x) and abs(x) * 64 < topk.LARGEST for x in v)]
    width = max((len(v) for _, v in good), default=0)
    good = [(i, np.pad(v, (0, width - len(v)))) for i, v in good]
    out = []
    for i, v in good:
        if i % every == 0:
            best = sorted((-int(v @ w), j) for j, w in good if j != i)[:k]
            out += [(i, r, j, -s) for r, (s, j) in enumerate(best, 1)]
    return sorted(out)


def plain(df):
    return sorted(tuple(r) for r in df.select("query_id", "rank", "vec_id", "score").collect())


@pytest.mark.parametrize("block_rows,query_rows", [(1 << 15, 256), (37, 5)])
def test_whole_table(spark, block_rows, query_rows):
    d = spark.read.parquet(f"{SF_ORACLE}/embeddings.parquet")
    got = plain(topk.top_k(d, block_rows=block_rows, query_rows=query_rows))
    assert got == brute([(r["vec_id"], r["embedding"]) for r in d.collect()])


def test_ties_extremes_and_bad_rows(spark):
    rng = np.random.default_rng(1)
    rows = [(int(i), rng.integers(-2, 3, 5).astype(float).tolist()) for i in range(0, 300)]
    rows += [(400, [1e4, -1e4, 0.0, 0.0, 0.0]), (401, [1e5, 1.0, 2.0, 3.0, 4.0]),
             (402, [float("nan")] * 5), (403, [float("inf"), 0.0, 0.0, 0.0, 0.0]),
             (404, [1.0, None, 0.0, 0.0, 0.0]), (405, None), (406, [1e30] * 5), (408, [1.0]),
             (409, []), (420, [0.0] * 5)]
    got = plain(topk.top_k(vectors(spark, [(*r, 1, 2) for r in rows]), block_rows=64))
    assert got == brute(rows)


def test_few_rows_repeats_and_empty(spark):
    assert topk.top_k(vectors(spark, [])).count() == 0
    assert topk.top_k(vectors(spark, [(20, [1.0], 0, 0)])).count() == 0
    rows = [(20, [1.0, 2.0]), (20, [1.0, 2.0]), (3, [1.0, 1.0]), (3, [1.0, 1.0]), (None, [1.0, 1.0])]
    got = plain(topk.top_k(vectors(spark, [(*r, 0, 0) for r in rows])))
    assert got == [(20, 1, 3, 3 * 4096), (20, 2, 3, 3 * 4096)]


def test_scores_in_slices_are_the_sums():
    rng = np.random.default_rng(2)
    import pandas as pd
    q = rng.integers(-40, 40, (130, 9))
    row = topk._slice_block(pd.DataFrame({"block": 0, "vec_id": np.arange(130),
                                          "q": list(q)})).iloc[0]
    block = topk.Block(row.ids, row.widths, row.lows, row.slices)
    for w in rng.integers(-40, 40, (10, 9)):
        slices, base = block.add(w)
        total = sum(np.unpackbits(s.view(np.uint8), bitorder="little").astype(int) << i
                    for i, s in enumerate(slices))[:130] + base
        assert total.tolist() == (q @ w).tolist()


def test_large_finite_components_are_kept(spark):
    rows = [(0, [3e6, -1.0]), (1, [2.0**21, 5.0]), (2, [-2.0**24, 0.5]), (3, [1.0, 1.0]),
            (20, [2.0**24, -2.0**24]), (21, [2.0**20, 0.0]), (22, [float("inf"), 0.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = {(r["query_id"], r["vec_id"]): r["score"] for r in topk.top_k(df, k=5).collect()}
    q = {i: [math.floor(x * 64) for x in v] for i, v in rows if i != 22}
    assert got == {(a, b): sum(x * y for x, y in zip(q[a], q[b]))
                   for a in (0, 20) for b in q if a != b}


def test_sums_up_to_a_long_are_exact_and_larger_ones_fail(spark):
    def run(rows):
        df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
        return {(r["query_id"], r["vec_id"]): r["score"] for r in topk.top_k(df, scale=1).collect()}

    big = 2.0**30
    got = run([(0, [big, -big]), (1, [2.0**31, -2.0**31]), (2, [-2.0**31, 2.0**31]), (3, [0.0, 7.0])])
    assert got == {(0, 1): 2**62, (0, 2): -2**62, (0, 3): -7 * 2**30}
    with pytest.raises(OverflowError):
        run([(0, [2.0**31, 0.0]), (1, [2.0**32, 1.0])])
