"""Parquet tables: driver inputs and warehouse tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def read_table(spark: SparkSession, base: str, name: str, columns: list[str] | None = None
               ) -> DataFrame:
    """``<base>/<name>.parquet`` (or a folder of that name), pruned to ``columns``."""
    df = spark.read.parquet(f"{base.rstrip('/')}/{name}.parquet")
    return df.select(*columns) if columns else df


def write_table(df: DataFrame, path: str, partition_by: list[str] | None = None,
                mode: str = "overwrite") -> None:
    writer = df.write.mode(mode)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)


def materialize(df: DataFrame, name: str, partition_by: list[str] | None = None) -> DataFrame:
    """Write ``df`` as a Parquet table in the shared checkpoint folder and read it back.

    Cuts the lineage like ``checkpoint()`` (a lost executor re-reads files instead of re-running
    the plan), and unlike a checkpoint the result is a Parquet scan: later queries get column
    pruning, filter pushdown to row groups and file-size statistics for join planning.
    """
    from stationdw.session import scratch_dir

    spark = df.sparkSession
    path = scratch_dir(spark, name)
    write_table(df, path, partition_by)
    return spark.read.schema(df.schema).parquet(path)
