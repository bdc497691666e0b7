"""Exact top-k search by inner product over a bit-sliced index.

Rows are split into blocks. In a block, bit j of every row's quantised attribute d is one bitmap
over the rows, a slice. A query's score is a weighted sum of attributes: each slice counts once
for every bit of the query's weight, and all slices of equal place value are added with bitmap
full adders (xor and majority) whose carries move to the next place. That leaves the scores of
all rows as slices, too. The best k are found from the most significant slice downward: rows
with the bit set are in if they are not too many, else only they stay in question; what is still
level after the last slice has exactly equal scores, and ids decide.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import columns_of, ship_package, stage

INDEX = ("block long, ids array<long>, widths array<int>, lows array<long>, slices binary")
#: Quantised attributes are below this, so that the difference of two fits a long.
LARGEST = 1 << 62


def quantise(vectors: DataFrame, scale: int = 64, id_col: str = "vec_id",
             vector_col: str = "embedding") -> DataFrame:
    """``vec_id, q`` (q: array of floor(scale * x)). Null vectors and vectors with a null or a
    non-finite component, or one beyond ``LARGEST / scale``, are left out."""
    read = columns_of(vectors, vec_id=id_col, v=vector_col)
    fit = F.forall("v", lambda x: F.coalesce(
        F.abs(x.cast("double")) * scale < float(LARGEST), F.lit(False)))
    return (read.where(F.col("vec_id").isNotNull() & F.col("v").isNotNull() & fit)
            .select(F.col("vec_id").cast("long").alias("vec_id"),
                    F.transform("v", lambda x: F.floor(x.cast("double") * scale)).alias("q")))


def check_sums(rows: DataFrame, queries: DataFrame) -> None:
    """Raise an error unless the largest sum the vectors could give, by the largest size of each
    attribute (one row per attribute), fits a long."""
    def sizes(df, name):
        each = df.select(F.posexplode("q").alias("d", "x"))
        return each.groupBy("d").agg(F.max(F.abs("x")).alias(name))

    both = sizes(rows, "row").join(sizes(queries, "query"), "d").collect()
    if sum(r["row"] * r["query"] for r in both) >= 1 << 63:
        raise OverflowError("an inner product of the quantised vectors may not fit a long")


def _matrix(vectors) -> np.ndarray:
    """Rows of equal length; shorter vectors end in zeros, which add nothing to a score."""
    width = max((len(v) for v in vectors), default=0)
    out = np.zeros((len(vectors), width), np.int64)
    for i, v in enumerate(vectors):
        out[i, :len(v)] = v
    return out


def _slice_block(pdf: pd.DataFrame) -> pd.DataFrame:
    pdf = pdf.sort_values("vec_id", kind="stable")
    values = _matrix(pdf["q"].tolist())
    n, dims = values.shape
    lows = values.min(axis=0) if n else np.zeros(dims, np.int64)
    values = values - lows
    widths = [int(x).bit_length() for x in values.max(axis=0)]
    words, bits = -(-n // 64), np.zeros((1, -(-n // 64) * 64), bool)
    slices = np.zeros((sum(widths), words), np.uint64)
    at = 0
    for d, width in enumerate(widths):
        for j in range(width):
            bits[0, :n] = values[:, d] >> j & 1
            slices[at] = np.packbits(bits, axis=1, bitorder="little").view("<u8")[0]
            at += 1
    return pd.DataFrame({"block": [pdf["block"].iloc[0]], "ids": [pdf["vec_id"].to_numpy()],
                         "widths": [np.array(widths, np.int32)], "lows": [lows],
                         "slices": [slices.astype("<u8").tobytes()]})


def build_index(rows: DataFrame, n_blocks: int) -> DataFrame:
    """One row per block: sorted ids, and per attribute its least value, its number of slices
    and the slices. Rows are dealt to blocks by hash, about equally many to each."""
    ship_package(rows.sparkSession)
    return (rows.withColumn("block", F.pmod(F.xxhash64("vec_id", "q"), F.lit(n_blocks)))
            .groupBy("block").applyInPandas(_slice_block, INDEX))


class Block:
    """A block's slices, ready for queries."""

    def __init__(self, ids, widths, lows, slices):
        self.ids, self.lows = np.asarray(ids, np.int64), np.asarray(lows, np.int64)
        self.widths, self.words = np.asarray(widths, np.int64), -(-len(ids) // 64)
        plain = np.frombuffer(slices, "<u8").reshape(-1, self.words)
        self.count = len(plain)
        self.slices = np.concatenate([plain, ~plain])  # a negative weight adds the complement
        self.dim = np.repeat(np.arange(len(self.widths)), self.widths)
        self.place = np.concatenate([np.arange(w) for w in self.widths] or [[]]).astype(np.int64)

    def add(self, weights) -> tuple[list[np.ndarray], int]:
        """Score slices from the lowest place upward, and what to add to every score."""
        n = min(len(weights), len(self.lows))
        weight = np.zeros(len(self.lows), np.int64)
        weight[:n] = weights[:n]
        size, negative = np.abs(weight), weight < 0
        # Modulo 2^64, as are the scores: exact, because a whole score fits a long.
        flipped = (size * ((1 << self.widths) - 1))[negative]
        base = int(np.concatenate([weight * self.lows, -flipped]).sum())
        rows = np.arange(self.count) + np.where(negative[self.dim], self.count, 0)
        size = size[self.dim]
        waiting: list[list[np.ndarray]] = []

        def queue(place):
            while len(waiting) <= place:
                waiting.append([])
            return waiting[place]

        for i in range(int(size.max(initial=0)).bit_length()):
            on = size >> i & 1 == 1
            for j in np.unique(self.place[on]).tolist():
                queue(i + j).append(self.slices[rows[on & (self.place == j)]])
        out, place = [], 0
        while place < len(waiting):
            stack = np.concatenate(waiting[place]) if waiting[place] else \
                np.zeros((1, self.words), np.uint64)
            while len(stack) > 1:
                k = len(stack) // 3
                if k:
                    a, b, c = stack[:k], stack[k:2 * k], stack[2 * k:3 * k]
                    half = a ^ b
                    queue(place + 1).append((a & b) | (c & half))
                    stack = np.concatenate([half ^ c, stack[3 * k:]])
                else:
                    queue(place + 1).append(stack[:1] & stack[1:])
                    stack = stack[:1] ^ stack[1:]
            out.append(stack[0])
            waiting[place] = []
            place += 1
        return out, base

    def top(self, own_id: int, weights, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids and scores of the k best rows but those with the query's own id, ties to smaller
        ids; all rows if there are no more than k."""
        slices, base = self.add(weights)
        bits = np.zeros(self.words * 64, bool)
        bits[:len(self.ids)] = True
        bits[np.searchsorted(self.ids, own_id):np.searchsorted(self.ids, own_id, "right")] = False
        open_rows = np.packbits(bits, bitorder="little").view("<u8")
        chosen, n_chosen = np.zeros(self.words, np.uint64), 0
        for s in reversed(slices):
            high = open_rows & s
            n = n_chosen + int(np.bitwise_count(high).sum())
            if n > k:
                open_rows = high
            else:
                chosen, n_chosen = chosen | high, n
                open_rows = open_rows & ~s
            if n == k:
                break
        rows = np.concatenate([self._rows(chosen), self._rows(open_rows)[:k - n_chosen]])
        word, bit = rows // 64, (rows % 64).astype(np.uint64)
        scores = np.full(len(rows), base, np.int64)
        for place, s in enumerate(slices[:64]):
            scores += (s[word] >> bit & np.uint64(1)).astype(np.int64) << place
        return self.ids[rows], scores

    def _rows(self, bitmap: np.ndarray) -> np.ndarray:
        return np.flatnonzero(np.unpackbits(bitmap.view(np.uint8), bitorder="little"))


def search(index: DataFrame, queries: DataFrame, n_blocks: int, n_parts: int, k: int = 20
           ) -> DataFrame:
    """``query_id, rank, vec_id, score`` for ``queries`` (``vec_id, q``) against every block.

    Each (block, part of the queries) is one group of bounded size; a block yields at most k rows
    a query, and the best k of these are the result.
    """
    def cell(key, blocks: pd.DataFrame, wanted: pd.DataFrame) -> pd.DataFrame:
        found: dict[str, list] = {"query": [], "query_id": [], "vec_id": [], "score": []}
        for b in blocks.itertuples():
            block = Block(b.ids, b.widths, b.lows, b.slices)
            for q in wanted.itertuples():
                ids, scores = block.top(q.vec_id, q.q, k)
                found["query"] += [q.query] * len(ids)
                found["query_id"] += [q.vec_id] * len(ids)
                found["vec_id"] += ids.tolist()
                found["score"] += scores.tolist()
        return pd.DataFrame(found).astype("int64")

    parts = index.withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(n_parts - 1))))
    asked = (queries.distinct().withColumn("query", F.xxhash64("vec_id", "q"))
             .withColumn("part", F.pmod("query", F.lit(n_parts)).cast("int"))
             .withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(n_blocks - 1))))
             .withColumn("block", F.col("block").cast("long")))
    found = parts.groupBy("block", "part").cogroup(asked.groupBy("block", "part")).applyInPandas(
        cell, "query long, query_id long, vec_id long, score long")
    best = Window.partitionBy("query").orderBy(F.desc("score"), "vec_id")
    return (found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))


def top_k(vectors: DataFrame, k: int = 20, every: int = 20, scale: int = 64,
          block_rows: int = 1 << 15, query_rows: int = 256, id_col: str = "vec_id",
          vector_col: str = "embedding") -> DataFrame:
    """Rows whose id is divisible by ``every`` against all rows but those with their own id.

    Vectors of unequal length compare on their common components (the rest counts as zero).
    Exactly repeated queries are answered once; repeated candidates each count. Rows with a null
    id take no part.
    """
    rows = stage(quantise(vectors, scale, id_col, vector_col), "quantised")
    queries = rows.where(F.col("vec_id") % every == 0)
    check_sums(rows, queries)
    n_blocks = max(1, -(-rows.count() // block_rows))
    n_parts = max(1, -(-queries.count() // query_rows))
    index = stage(build_index(rows, n_blocks), "slices")
    return search(index, queries, n_blocks, n_parts, k)
