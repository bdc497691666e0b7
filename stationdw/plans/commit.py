"""Loads of several tables that take effect together, over plain Parquet folders.

A load first writes everything that it will change into its journal, a folder beside the tables,
and then the journal's commit marker, one small file. Only then the tables are replaced from the
journal, and the journal goes. What is found of an earlier load that ended anywhere is put right
before the next one begins:

* a journal without its marker is dropped: no table was touched;
* a journal with its marker is applied again from its start: replacing a table, or a month of
  one, by the same rows twice gives the same table.

So keys and the facts that use them are always of one load. The journal lies in the warehouse,
not in the session's scratch folder, and is found by any later session.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from stationdw.session import remove_path, write_text

MARKER = "_COMMITTED"


def journal_path(warehouse: str) -> str:
    return warehouse.rstrip("/") + "/_load"


def exists(spark: SparkSession, path: str) -> bool:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()).exists(target)


def log(df: DataFrame, warehouse: str, table: str, partition_by: str | None = None) -> None:
    """Write a table's new rows (all of them, or those of the changed partitions) to the journal."""
    writer = df.write.mode("overwrite").option("partitionOverwriteMode", "static")
    if partition_by:
        writer = writer.partitionBy(partition_by)
    writer.parquet(f"{journal_path(warehouse)}/{table}")


def commit(spark: SparkSession, warehouse: str) -> None:
    """From here on the journal's rows are the tables' rows, whatever happens to this session."""
    write_text(spark, f"{journal_path(warehouse)}/{MARKER}", "")


def recover(spark: SparkSession, warehouse: str, tables: dict[str, Callable[[str], None]]) -> bool:
    """Apply a committed journal, or drop one that is not; True if one was applied.

    ``tables``: for each table's name what replaces it by its folder in the journal. It must give
    the same table when it is called again.
    """
    journal = journal_path(warehouse)
    if not exists(spark, journal):
        return False
    committed = exists(spark, f"{journal}/{MARKER}")
    if committed:
        for name, replace in tables.items():
            if exists(spark, f"{journal}/{name}/_SUCCESS"):
                replace(f"{journal}/{name}")
        # the marker goes last: without it the rest of an applied journal would be dropped, too
        for name in tables:
            remove_path(spark, f"{journal}/{name}")
    remove_path(spark, journal)
    return committed
