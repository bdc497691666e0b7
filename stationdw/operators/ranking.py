"""Global ranks and dense surrogate keys without a single-partition window.

A window with no PARTITION BY moves every row into one task. For large inputs we instead:

1. reduce the input to its distinct sort keys with a row count each (partial aggregation, so a
   key holding a third of all rows costs nothing extra),
2. range-partition the distinct keys and checkpoint them to the shared checkpoint folder (the
   sampled range bounds are then fixed, and a lost executor cannot reshuffle rows),
3. sum the counts per range partition (one row per partition) and turn them into offsets,
4. inside each partition, rank = offset + rows of smaller keys in that partition + 1,
5. join the ranks back on the key (the large side keeps its partitioning; AQE splits skew).

Equal keys always land in the same range partition, so ties get equal ranks exactly as RANK().
The same plan runs at every size.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stationdw.session import checkpoint_root


def _sort_orders(cols: Sequence[str], ascending: Sequence[bool]) -> list[Column]:
    # ASC puts nulls first and DESC puts them last (as RANK() does in SQL engines).
    return [F.col(c).asc_nulls_first() if a else F.col(c).desc_nulls_last()
            for c, a in zip(cols, ascending)]


def _rank_distinct(keys: DataFrame, key_cols: Sequence[str], ascending: Sequence[bool],
                   weight: str, out: str, partitions: int | None = None) -> DataFrame:
    """Rank distinct keys: out = 1 + total weight of all keys ordered before this one."""
    spark = keys.sparkSession
    checkpoint_root(spark)
    n = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    orders = _sort_orders(key_cols, ascending)
    ranged = keys.repartitionByRange(n, *orders).checkpoint(eager=True)
    ranged = ranged.withColumn("_pid", F.spark_partition_id())
    totals = ranged.groupBy("_pid").agg(F.sum(weight).alias("_total"))
    # One row per range partition: bounded by the partition count, safe to broadcast.
    offsets = totals.select(
        "_pid",
        F.coalesce(F.sum("_total").over(
            Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
        .alias("_offset"))
    local = Window.partitionBy("_pid").orderBy(*orders).rowsBetween(
        Window.unboundedPreceding, -1)
    ranked = ranged.withColumn("_before", F.coalesce(F.sum(weight).over(local), F.lit(0)))
    return (ranked.join(F.broadcast(offsets), "_pid")
            .select(*key_cols, (F.col("_offset") + F.col("_before") + 1).alias(out)))


def global_rank(df: DataFrame, keys: Sequence[Column | str], ascending: Sequence[bool],
                out: str = "rank", distributed: bool = True) -> DataFrame:
    """RANK() OVER (ORDER BY keys) over the whole frame.

    The range-partitioned algorithm runs at every size; ``distributed=False`` asks for the
    single-partition window, for frames whose size is bounded by what they are.
    """
    names = [f"_rk{i}" for i in range(len(keys))]
    keyed = df.select("*", *[(F.col(k) if isinstance(k, str) else k).alias(n)
                             for k, n in zip(keys, names)])
    if not distributed:
        w = Window.orderBy(*_sort_orders(names, ascending))
        return keyed.withColumn(out, F.rank().over(w).cast("long")).drop(*names)
    counts = keyed.groupBy(*names).agg(F.count(F.lit(1)).alias("_w"))
    ranks = _rank_distinct(counts, names, ascending, "_w", out)
    cond = [keyed[n].eqNullSafe(ranks[n]) for n in names]
    # One row per distinct key; AQE broadcasts it when its measured bytes allow and splits the
    # skewed partitions of a sort-merge join otherwise.
    joined = keyed.join(ranks, cond, "inner")
    return joined.select(*[keyed[c] for c in df.columns], ranks[out].cast("long").alias(out))


def rank_within(df: DataFrame, partition: Sequence[str], keys: Sequence[Column | str],
                ascending: Sequence[bool], out: str = "rank",
                distributed: bool = True) -> DataFrame:
    """RANK() OVER (PARTITION BY partition ORDER BY keys) without one task per group.

    A window puts each group into one task, so a group holding a third of all rows would be
    sorted by a single core. The distributed form ranks the whole frame by (partition, keys)
    with ``global_rank`` and subtracts, per group, the rank of its first row minus one (one
    row per group, joined back); ``distributed=False`` asks for the plain window.
    """
    if not distributed:
        w = Window.partitionBy(*partition).orderBy(
            *_sort_orders([f"_rw{i}" for i in range(len(keys))], ascending))
        keyed = df.select("*", *[(F.col(k) if isinstance(k, str) else k).alias(f"_rw{i}")
                                 for i, k in enumerate(keys)])
        return keyed.withColumn(out, F.rank().over(w)).drop(
            *[f"_rw{i}" for i in range(len(keys))])
    names = [f"_gp{i}" for i in range(len(partition))]
    # Rank of each group's first row = 1 + rows in groups ordered before it: a prefix sum over
    # the (few, distinct) group values weighted by group size.
    sizes = df.groupBy(*[F.col(c).alias(n) for c, n in zip(partition, names)]) \
        .agg(F.count(F.lit(1)).alias("_w"))
    firsts = _rank_distinct(sizes, names, [True] * len(names), "_w", "_gfirst")
    ranked = global_rank(df, [*partition, *keys], [True] * len(partition) + list(ascending),
                         "_grank", distributed=True)
    cond = [F.col(c).eqNullSafe(F.col(n)) for c, n in zip(partition, names)]
    joined = ranked.join(firsts, cond, "inner")
    return joined.select(*df.columns,
                         (F.col("_grank") - F.col("_gfirst") + 1).cast("int").alias(out))


def dense_index(keys: DataFrame, key_cols: Sequence[str], out: str, start_after: int = 0,
                distributed: bool = True) -> DataFrame:
    """Number the **distinct** keys 1..n in key order, shifted by ``start_after``."""
    distinct = keys.select(*key_cols).distinct()
    if not distributed:
        w = Window.orderBy(*[F.col(c).asc_nulls_first() for c in key_cols])
        return distinct.select(*key_cols,
                               (F.row_number().over(w) + F.lit(start_after)).alias(out))
    idx = _rank_distinct(distinct.withColumn("_w", F.lit(1)), key_cols,
                         [True] * len(key_cols), "_w", "_idx")
    return idx.select(*key_cols, (F.col("_idx") + F.lit(start_after)).alias(out))


def first_per_group(df: DataFrame, partition: Sequence[str],
                   order: Sequence[tuple[str, bool]], strategy: str = "aggregate") -> DataFrame:
    """First row of each group under ``order`` = [(column, ascending), ...].

    ``aggregate`` (default): ``min_by`` over a struct sort key, a partial aggregation, so a group
    holding a third of all rows is reduced map-side. ``window``: ROW_NUMBER() = 1 (Spark adds a
    per-partition group limit before the shuffle). Both keep SQL's null placement: nulls first
    ascending, last descending. The aggregate form needs numeric or date keys when descending.
    """
    if strategy == "window":
        w = Window.partitionBy(*partition).orderBy(*_sort_orders([c for c, _ in order],
                                                                 [a for _, a in order]))
        return (df.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") == 1)
                .drop("_rn"))
    parts = []
    for c, asc in order:
        col = F.col(c)
        if asc:
            parts += [col.isNotNull(), col]          # nulls first
        else:
            parts += [col.isNull(), -col]            # nulls last, larger first
    sort_key = F.struct(*[p.alias(f"_o{i}") for i, p in enumerate(parts)])
    rest = [c for c in df.columns if c not in partition]
    picked = df.groupBy(*partition).agg(
        F.min_by(F.struct(*rest), sort_key).alias("_top"))
    return picked.select(*partition, *[F.col("_top")[c].alias(c) for c in rest])
