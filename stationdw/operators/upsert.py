"""Keyed upserts on immutable files: keep-latest, insert-ignore, SCD-1 dimension merge.

Keep-latest is a ``max_by`` aggregate that runs partially before the shuffle, so a hot key is
reduced on the map side instead of piling up in one task. Merging a batch into a table is an
anti join against the batch's keys plus a union; the planner broadcasts the keys when their
measured bytes allow, and the table's rows are then not shuffled. A ``groupBy`` form over both
sides is kept as an alternative.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException

from stationdw.operators.ranking import dense_index
from stationdw.session import remove_path, scratch_dir


def keep_latest(df: DataFrame, keys: Sequence[str], order_cols: Sequence[str]) -> DataFrame:
    """One row per key: the row with the greatest ``order_cols`` (arrival order) wins."""
    rest = [c for c in df.columns if c not in keys]
    order = F.struct(*[F.col(c) for c in order_cols])
    latest = df.groupBy(*keys).agg(F.max_by(F.struct(*rest), order).alias("_row"))
    return latest.select(*[F.col(c) if c in keys else F.col("_row")[c].alias(c)
                           for c in df.columns])


def upsert_latest(current: DataFrame | None, incoming: DataFrame, keys: Sequence[str],
                  order_cols: Sequence[str], keep_first: Sequence[str] = (),
                  drop_order: bool = True, incoming_unique: bool = False,
                  strategy: str = "antijoin", compare_order: bool = False) -> DataFrame:
    """ON DUPLICATE KEY UPDATE: the latest incoming row per key replaces the current row.

    ``keep_first`` columns (e.g. a load timestamp) keep the value of the first insert.
    Incoming rows need ``order_cols``; the result drops them unless ``drop_order=False``.
    ``incoming_unique`` declares the incoming keys unique (e.g. read from a keyed table), so
    they need no keep-latest aggregation.
    ``compare_order``: ``current`` holds ``order_cols`` as well, the result keeps them, and a
    current row later than the batch's stays; equal order, or none stored, lets the batch win.

    ``strategy="antijoin"`` (default): current rows whose key is not in the batch are kept as
    they are and the batch's latest rows are appended. ``"aggregate"``: one ``groupBy``
    over current and incoming rows (``max_by`` on (batch first, then arrival order)).
    """
    columns = [c for c in incoming.columns
               if c not in order_cols or compare_order or not drop_order]
    fresh = incoming if incoming_unique else keep_latest(incoming, keys, order_cols)
    if current is None:
        return fresh.select(*columns)
    if strategy == "aggregate":
        return _upsert_by_aggregate(current, incoming, keys, order_cols, keep_first, columns,
                                    compare_order)
    fresh = fresh.select(*columns)
    names = [f"_uk{i}" for i in range(len(keys))]
    fresh_keys = fresh.select(*[F.col(k).alias(n) for k, n in zip(keys, names)])
    cond = [F.col(k).eqNullSafe(F.col(n)) for k, n in zip(keys, names)]
    kept = current.join(fresh_keys, cond, "left_anti").select(*columns)
    if compare_order:
        # Stored rows of the batch's keys (no more than the batch has) against the batch's rows.
        stored = current.join(fresh_keys, cond, "left_semi")
        fresh = _upsert_by_aggregate(stored, fresh, keys, order_cols, keep_first, columns, True)
    elif keep_first:
        # First-insert values of the keys the batch replaces (no more rows than the batch).
        firsts = (current.join(fresh_keys, cond, "left_semi")
                  .select(*[F.col(k).alias(n) for k, n in zip(keys, names)],
                          *[F.col(c).alias(f"_first_{c}") for c in keep_first]))
        fresh = (fresh.join(firsts, cond, "left")
                 .select(*[F.coalesce(F.col(f"_first_{c}"), F.col(c)).alias(c)
                           if c in keep_first else F.col(c) for c in columns]))
    return kept.unionByName(fresh)


def _upsert_by_aggregate(current, incoming, keys, order_cols, keep_first, columns,
                         compare_order=False):
    value_cols = [c for c in columns if c not in keys]
    cur = current.select(*keys, *value_cols,
                         *[F.lit(None).cast(incoming.schema[c].dataType).alias(c)
                           for c in order_cols if c not in current.columns],
                         F.lit(0).alias("_prio"))
    inc = incoming.select(*keys, *value_cols, *[c for c in order_cols if c not in value_cols],
                          F.lit(1).alias("_prio"))
    both = cur.unionByName(inc)
    order = F.struct(F.col("_prio"), *[F.col(c) for c in order_cols])
    latest = F.struct(*[F.col(c) for c in order_cols], F.col("_prio")) if compare_order else order
    replace = [c for c in value_cols if c not in keep_first]
    aggs = [F.max_by(F.struct(*replace), latest).alias("_row")] if replace else []
    aggs += [F.min_by(F.col(c), order).alias(c) for c in keep_first]
    merged = both.groupBy(*keys).agg(*aggs)
    return merged.select(*[F.col("_row")[c].alias(c) if c in replace else F.col(c)
                           for c in columns])


def insert_ignore(current: DataFrame | None, incoming: DataFrame, keys: Sequence[str]
                  ) -> DataFrame:
    """INSERT IGNORE: new keys are added (first occurrence), existing rows are left as they are."""
    fresh = incoming.dropDuplicates(list(keys))
    if current is None:
        return fresh
    return current.unionByName(fresh.join(current.select(*keys), list(keys), "left_anti"))


def upsert_dim(current: DataFrame | None, incoming: DataFrame, natural_key: str,
               surrogate_key: str, stage_incoming: bool = True) -> DataFrame:
    """SCD type 1: attributes overwritten, surrogate keys kept; new members get new keys.

    ``incoming`` holds one row per natural key. New keys continue after the current maximum,
    in natural-key order (stable and dense; they need not copy any AUTO_INCREMENT numbering).
    ``stage_incoming`` first writes the (dimension-sized) incoming rows as Parquet under the
    checkpoint folder, so key assignment does not re-run its lineage.
    """
    if stage_incoming:
        from stationdw.sources.tables import materialize
        incoming = materialize(incoming, "dim-incoming")
    attrs = [c for c in incoming.columns if c != natural_key]
    if current is None:
        start = 0
        known = None
    else:
        start = current.agg(F.max(surrogate_key)).first()[0] or 0
        known = current.select(natural_key, surrogate_key)
    if known is not None:
        matched = incoming.join(known, natural_key, "left")
    else:
        matched = incoming.withColumn(surrogate_key, F.lit(None).cast("int"))
    new_ids = dense_index(matched.where(F.col(surrogate_key).isNull()), [natural_key],
                          "_new_key", start_after=start)
    assigned = (matched.join(new_ids, natural_key, "left")
                .select(F.coalesce(F.col(surrogate_key), F.col("_new_key")).cast("int")
                        .alias(surrogate_key), natural_key, *attrs))
    if current is None:
        return assigned
    untouched = current.join(incoming.select(natural_key), natural_key, "left_anti")
    return untouched.select(surrogate_key, natural_key, *attrs).unionByName(assigned)


def _read_or_none(spark: SparkSession, path: str, schema=None) -> DataFrame | None:
    """The table at ``path`` (partition columns typed by ``schema``), or None if absent."""
    try:
        reader = spark.read.schema(schema) if schema is not None else spark.read
        df = reader.parquet(path)
        df.schema  # noqa: B018 - resolves the path now
        return df
    except AnalysisException:
        return None


def _stage_complete(spark: SparkSession, stage: str) -> bool:
    """True when a previous attempt finished writing ``stage`` (its job-commit marker exists)."""
    try:
        spark.read.text(stage.rstrip("/") + "/_SUCCESS").schema  # noqa: B018
        return True
    except AnalysisException:
        return False


def merge_into_path(incoming: DataFrame, path: str, keys: Sequence[str],
                    order_cols: Sequence[str], partition_col: str,
                    keep_first: Sequence[str] = (), stages: str | None = None,
                    epoch: int = 0, store_order: bool = False) -> None:
    """Upsert ``incoming`` into the Parquet table at ``path``, partitioned by ``partition_col``.

    Only the partitions the batch touches are read (a semi join on the partition column, which
    dynamic partition pruning turns into a partition filter at the scan), merged, staged under
    the shared checkpoint folder, then swapped in with dynamic partition overwrite. The table is
    never overwritten by a plan that reads it. ``partition_col`` must be a function of the key.

    ``store_order`` keeps ``order_cols`` in the table, so that a stored row that is later than
    the batch's row of its key stays; without it the later batch wins.

    ``stages`` (a stream's own folder, kept over restarts, see ``merge_stages``) and ``epoch``
    name the stage deterministically: a retried batch whose stage was completely written reuses
    it instead of merging again, also in a new session, so a crash during the swap (some months
    already replaced) cannot make the retry merge against an incomplete table. A stage is
    removed once the next epoch has begun, which it only does after this one was committed; a
    stage without ``stages`` as soon as it is swapped in.
    """
    spark = incoming.sparkSession
    table_cols = [c for c in incoming.columns if c not in order_cols or store_order]
    schema = incoming.select(*table_cols).schema
    if stages:
        stage = f"{stages}/{epoch}"
        remove_path(spark, f"{stages}/{epoch - 1}")
        if _stage_complete(spark, stage):
            swap_in(spark, stage, schema, path, partition_col)
            return
    else:
        stage = scratch_dir(spark, "merge")
    # The touched partitions, the rows to keep and the rows to add all look at the batch: it is
    # reduced to its latest rows once and written.
    latest = f"{stage}-batch"
    reduced = keep_latest(incoming, keys, order_cols)
    reduced.write.mode("overwrite").parquet(latest)
    merged = merged_months(spark.read.schema(reduced.schema).parquet(latest), path, keys,
                           order_cols, partition_col, keep_first, store_order, True)
    # No repartition by the partition column before writing: a month holding a third of the
    # rows would then be written by one task. The merge output is spread by key instead and each
    # task writes its share of every touched month.
    # The stage is a fresh folder: a static write commits the whole job with a _SUCCESS marker
    # (a dynamic-overwrite write, the session default, leaves none).
    (merged.write.mode("overwrite").option("partitionOverwriteMode", "static")
     .partitionBy(partition_col).parquet(stage))
    swap_in(spark, stage, merged.schema, path, partition_col)
    remove_path(spark, latest)
    if not stages:
        remove_path(spark, stage)


def merged_months(incoming: DataFrame, path: str, keys: Sequence[str], order_cols: Sequence[str],
                  partition_col: str, keep_first: Sequence[str] = (), store_order: bool = False,
                  incoming_unique: bool = False) -> DataFrame:
    """The rows that the partitions touched by ``incoming`` have after the upsert.

    ``incoming`` is read several times: callers pass a written table."""
    table_cols = [c for c in incoming.columns if c not in order_cols or store_order]
    current = _read_or_none(incoming.sparkSession, path, incoming.select(*table_cols).schema)
    if current is not None:
        touched = incoming.select(partition_col).distinct()
        current = current.join(touched, partition_col, "left_semi")
    return upsert_latest(current, incoming, keys, order_cols, keep_first,
                         incoming_unique=incoming_unique, compare_order=store_order)


def merge_stages(checkpoint: str) -> str:
    """Where a stream stages its merges: in its own checkpoint folder, so that a restart finds
    them and a stream with a new checkpoint never does."""
    return checkpoint.rstrip("/") + "/merge"


def swap_in(spark: SparkSession, stage: str, schema, path: str, partition_col: str) -> None:
    """Replace the partitions that ``stage`` has by its rows; others stay."""
    staged = spark.read.schema(schema).parquet(stage)
    (staged.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy(partition_col).parquet(path))
