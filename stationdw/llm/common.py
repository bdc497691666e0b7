"""Helpers shared by the operators of this package."""

from __future__ import annotations

import gc
import os
import tempfile
import zipfile
from collections.abc import Callable
from contextlib import contextmanager
from pathlib import Path

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from stationdw.sources.tables import materialize, read_table

#: What separates words everywhere in this package: space and the five ASCII controls.
WORD = r"[^\x20\x09-\x0D]+"

_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def _shuffles_removed(spark: SparkSession):
    before = spark.conf.get(_CLEANUP, "false")
    spark.conf.set(_CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.set(_CLEANUP, before)


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet in the shared checkpoint folder and read it back.

    Cuts the lineage (a lost executor re-reads files) and gives later plans the table's real
    size, from which Spark itself decides whether a join side may be broadcast. Shuffle files of
    the finished step are removed with it, so that disk use does not add up over the steps.
    """
    with _shuffles_removed(df.sparkSession):
        return materialize(df, name)


def ship_package(spark: SparkSession) -> None:
    """Let Python workers import this package even where it is not installed: the driver adds
    its source files as one small zip, once per application."""
    sc = spark.sparkContext
    if getattr(sc, "_stationdw_shipped", False):
        return
    package = Path(__file__).resolve().parents[1]
    target = os.path.join(tempfile.mkdtemp(prefix="stationdw-src-"), "stationdw-src.zip")
    with zipfile.ZipFile(target, "w") as z:
        for source in sorted(package.rglob("*.py")):
            z.write(source, source.relative_to(package.parent))
    sc.addPyFile(target)
    sc._stationdw_shipped = True


_BATCH = "spark.sql.execution.arrow.maxBytesPerBatch"
#: What empties a module's tables in a Python worker, by module.
_TABLES: dict[str, Callable[[], None]] = {}


def keeps_tables(module: str, clear: Callable[[], None]) -> None:
    """Name what empties the tables a module's functions keep in a worker between batches."""
    _TABLES[module] = clear


def only_tables_of(module: str) -> None:
    """Workers are used again by later stages: empty what functions of other modules have kept."""
    emptied = [clear() for name, clear in _TABLES.items() if name != module]
    if emptied:
        gc.collect()
        pa.default_memory_pool().release_unused()


def small_batches(spark: SparkSession) -> None:
    """Bound what a worker gets at once by 4 MB, since texts differ in length; a bound that the
    session has set itself (other than Spark's default) stays."""
    if spark.conf.get(_BATCH, "64MB").upper() in ("64MB", "64M", str(64 << 20)):
        spark.conf.set(_BATCH, str(4 << 20))


def pieces(batches, target: int = 1 << 20):
    """Arrow batches cut into pieces of about ``target`` bytes, so that the Python objects made
    of a piece stay small whatever the size of a batch."""
    for batch in batches:
        step = max(1, batch.num_rows * target // max(batch.nbytes, 1))
        for at in range(0, batch.num_rows, step):
            yield batch.slice(at, step)


def arrow_map(df: DataFrame, rows, schema: str) -> DataFrame:
    """``mapInArrow`` with a function from a batch (dict of Python lists) to a dict of columns.

    ``rows(columns) -> columns`` sees a piece of about a megabyte at a time.
    """
    ship_package(df.sparkSession)
    small_batches(df.sparkSession)
    out, module = to_arrow_schema(StructType.fromDDL(schema)), rows.__module__

    def run(batches):
        only_tables_of(module)
        for batch in pieces(batches):
            got = rows(batch.to_pydict())
            if got is not None:
                yield pa.RecordBatch.from_pydict(got, schema=out)

    return df.mapInArrow(run, schema)


def columns_of(df: DataFrame, **names: str) -> DataFrame:
    """Only the columns an operator reads, under its own names, so that extra columns of the
    input can never clash with columns the operator adds."""
    return df.select(*[df[column].alias(name) for name, column in names.items()])
