"""Mixing sources to target weights by subset-sum budget fitting.

1. Count documents by exact length per source (and hashed bucket, for step 4).
2. Share the budget over the sources by weight; a source stops at a multiple of its size and
   the excess is shared again among the others. Sources stay a table: they are numbered in order
   for their weights, and running sums over the sources by size for weight give the words per
   unit of weight at which the budget is spent.
3. Fit each source's budget on its length counts alone: a proportional bulk first, then bounded
   knapsack dynamic programming picks how many more documents of which length fill the rest.
   The documents taken are fitted from below and the ones left out likewise; the nearer is used.
4. Pick that many documents of each length, by seeded hash. A (source, length) group is ranked
   over 1,024 hash buckets: whole buckets are taken or left by their counts, and rows are sorted
   only inside a bucket, so no group, however hot, is sorted in one task.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stationdw.operators.ranking import dense_index

from .common import WORD, ship_package, stage


def water_fill(sizes: list[int], weights: list[float], share: float, most: float) -> list[float]:
    """Targets in proportion to ``weights`` that add up to ``share`` times all sizes, none above
    ``most`` times its size: what a source can't take is shared among the others again."""
    targets, free = [0.0] * len(sizes), set(range(len(sizes)))
    left = min(share, most) * sum(sizes)
    while free:
        unit = left / sum(weights[i] for i in free)
        full = {i for i in free if unit * weights[i] > most * sizes[i]}
        if not full:
            for i in free:
                targets[i] = unit * weights[i]
            break
        for i in full:
            targets[i] = float(most * sizes[i])
            left -= targets[i]
        free -= full
    return targets


def fit_lengths(lengths, counts, budget: int, exact_below: int = 1 << 14) -> np.ndarray:
    """How many documents of each length to take, at most ``counts``, so that their lengths add
    up to ``budget`` or as little below it as can be.

    All but the last ``exact_below`` words of the budget are taken as a proportional bulk, what
    its rounding leaves over as the longest that fit; the last ``exact_below`` words are fitted
    exactly by bounded subset-sum dynamic programming over bit sets (a set bit s: some choice
    adds up to s). Time and memory don't grow with the counts.
    """
    lengths, counts = np.asarray(lengths, np.int64), np.asarray(counts, np.int64)
    total = int((lengths * counts).sum())
    if budget >= total:
        return counts.copy()
    bulk = max(0, budget - exact_below)  # in whole numbers: the products can pass 64 bits
    taken = np.array([int(c) * bulk // total if n else 0
                      for n, c in zip(lengths.tolist(), counts.tolist())], np.int64)
    left = budget - int((lengths * taken).sum())
    order = [i for i in np.argsort(lengths).tolist() if lengths[i] > 0]
    for i in reversed(order):
        if left <= exact_below:
            break
        n = min(int(counts[i] - taken[i]), (left - exact_below) // int(lengths[i]))
        taken[i] += n
        left -= n * int(lengths[i])
    reach, mask, items = 1, (1 << (left + 1)) - 1, []
    for i in order:
        room = min(int(counts[i] - taken[i]), left // int(lengths[i]))
        part = 1
        while room > 0 and not reach >> left & 1:  # 1, 2, 4, ... and the rest: any number
            n = min(part, room)
            items.append((i, n, reach))
            reach |= (reach << (n * int(lengths[i]))) & mask
            room, part = room - n, part * 2
        if reach >> left & 1:
            break
    at = reach.bit_length() - 1
    for i, n, before in reversed(items):
        if not before >> at & 1:
            taken[i] += n
            at -= n * int(lengths[i])
    return taken


def fit_nearest(lengths, counts, target: float, exact_below: int = 1 << 14) -> np.ndarray:
    """As ``fit_lengths``, but as near ``target`` as can be from either side (below on a tie).

    The least sum from ``target`` on leaves out the greatest one up to what lies beyond it, so
    the same fit, of the documents left out, serves from above.
    """
    lengths, counts = np.asarray(lengths, np.int64), np.asarray(counts, np.int64)
    total = int((lengths * counts).sum())
    below = fit_lengths(lengths, counts, int(target), exact_below)
    if target >= total:
        return below
    above = counts - fit_lengths(lengths, counts, int(total - target), exact_below)
    gap = [abs(int((lengths * taken).sum()) - target) for taken in (below, above)]
    return above if gap[1] < gap[0] else below


def sums_before(df: DataFrame, order: str, cols: list[str]) -> DataFrame:
    """``df``, whose ``order`` values are distinct, with ``before_<col>``: the sum of ``col`` over
    all rows of smaller ``order``. Rows are range-partitioned; only the partitions' totals (one
    row each) come together in one task."""
    ranged = stage(df.repartitionByRange(order).withColumn("_part", F.spark_partition_id()),
                   "ordered")
    offsets = ranged.groupBy("_part").agg(*[F.sum(c).alias(f"_{c}") for c in cols]).select(
        "_part", *[F.coalesce(F.sum(f"_{c}").over(
            Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
            .alias(f"_offset_{c}") for c in cols])
    inside = Window.partitionBy("_part").orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    local = ranged.select("*", *[F.coalesce(F.sum(c).over(inside), F.lit(0)).alias(f"_local_{c}")
                                 for c in cols])
    return local.join(offsets, "_part").select(
        *df.columns, *[(F.col(f"_offset_{c}") + F.col(f"_local_{c}")).alias(f"before_{c}")
                       for c in cols])


def targets(sizes: DataFrame, weights: tuple[float, ...], share: float, most: float) -> DataFrame:
    """``_key, source_size, target`` for ``sizes`` (``_none, _key, size``; one row per source).

    The targets of ``water_fill`` without a loop over sources: a source is full at ``full`` words
    per unit of weight (most * size / weight). By ascending ``full``, what the fuller sources
    leave of the budget, over the weight from here on, is the unit if this source is not full; the
    first such unit holds for all sources. One number of it reaches the driver.
    """
    numbered = sizes.join(dense_index(sizes, ["_none", "_key"], "_nth"), ["_none", "_key"])
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]),
                          ((F.col("_nth") - 1) % len(weights) + 1).cast("int"))
    sources = stage(
        numbered.withColumn("weight", weight)
        .withColumn("most", F.col("size") * F.lit(float(most)))
        .withColumn("full", F.col("most") / F.col("weight")), "source-sizes")
    whole = sources.agg(F.sum("size").alias("size"), F.sum("weight").alias("weight")).first()
    left = min(share, most) * (whole["size"] or 0)
    steps = sums_before(sources.groupBy("full").agg(F.sum("most").alias("most"),
                                                    F.sum("weight").alias("weight")),
                        "full", ["most", "weight"])
    unit = (F.lit(float(left)) - F.col("before_most")) / (
        F.lit(float(whole["weight"] or 0)) - F.col("before_weight"))
    unit = (steps.withColumn("unit", unit).where("unit <= full")
            .agg(F.min_by("unit", "full")).first()[0])
    target = F.col("most") if unit is None else F.least("most", F.lit(unit) * F.col("weight"))
    return sources.select("_key", F.col("size").alias("source_size"), target.alias("target"))


def mix(docs: DataFrame, weights: tuple[float, ...] = (5, 2, 1), share: float = 1.5,
        most: int = 2, seed: int = 17, id_col: str = "doc_id", text_col: str = "text",
        source_col: str = "source", keep: tuple[str, ...] = ()) -> DataFrame:
    """``doc_id, size, source_size, target, copies, taken`` (and ``keep``) for every row.

    ``size``: words of the text (null: 0). Sources in code point order, null last, get
    ``weights`` in turn and share ``share`` times all sizes, each at most ``most`` times its
    size (``most`` is 1 or 2: a document is taken at most that often). ``taken`` = copies * size.
    A source without words has target 0 and takes nothing. Rows with equal id and text rank
    equally and are interchangeable; reruns give the same rows. Neither sources nor documents nor
    length counts are gathered on the driver.
    """
    if most not in (1, 2):
        raise ValueError("a document can be taken once or twice")
    spark = docs.sparkSession
    ship_package(spark)
    text = docs[text_col]
    h = F.xxhash64(F.lit(seed), docs[id_col], text)
    read = docs.select(
        docs[id_col].alias("_id"), docs[source_col].alias("_source"),
        # a never-null key for joins and windows
        F.coalesce(F.concat(F.lit("s"), docs[source_col]), F.lit("")).alias("_key"),
        F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long").alias("_size"),
        h.alias("_h"), F.shiftrightunsigned(h, 54).alias("_bucket"),
        *[docs[c].alias(f"_keep_{c}") for c in keep])
    group = ["_key", "_size", "_bucket"]
    buckets = stage(read.groupBy(*group).agg(F.first("_source").alias("_source"),
                                             F.count("*").alias("n")), "length-buckets")
    sizes = buckets.groupBy("_key").agg(
        F.max(F.col("_source").isNull().cast("int")).alias("_none"),
        F.sum(F.col("_size") * F.col("n")).alias("size"))
    plan = targets(sizes, weights, share, most)

    def fit(pdf):
        size, target = int(pdf["source_size"].iloc[0]), float(pdf["target"].iloc[0])
        whole = int(target >= size > 0)
        extra = fit_nearest(pdf["_size"], pdf["n"], target - whole * size)
        return pdf.assign(whole=whole, extra=np.where(pdf["_size"] > 0, extra, 0) if size else 0)[
            ["_key", "_size", "source_size", "target", "whole", "extra"]]

    counts = buckets.groupBy("_key", "_size").agg(F.sum("n").alias("n")).join(plan, "_key")
    fitted = stage(counts.groupBy("_key").applyInPandas(
        fit, "_key string, _size long, source_size long, target double, whole int, extra long"),
        "fitted-lengths")
    before = F.sum("n").over(Window.partitionBy("_key", "_size").orderBy("_bucket")
                             .rowsBetween(Window.unboundedPreceding, -1))
    quotas = stage(
        buckets.withColumn("before", F.coalesce(before, F.lit(0)))
        .join(fitted, ["_key", "_size"])
        .select(*group, "source_size", "target", "whole",
                F.greatest(F.lit(0), F.least("n", F.col("extra") - F.col("before"))).alias("quota")),
        "bucket-quotas")
    rank = F.row_number().over(Window.partitionBy(*group).orderBy("_h", "_id"))
    copies = F.col("whole") + (rank <= F.col("quota")).cast("int")
    return (read.drop("_source").join(quotas, group).withColumn("copies", copies)
            .select(F.col("_id").alias("doc_id"), F.col("_size").alias("size"), "source_size",
                    "target", "copies", (F.col("copies") * F.col("_size")).alias("taken"),
                    *[F.col(f"_keep_{c}").alias(c) for c in keep if c != id_col]))
