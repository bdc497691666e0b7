"""Constraint checks. Each returns the violating rows (empty = constraint holds)."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, DecimalType


def check_unique(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once, with their count (``dup_count``)."""
    return (df.groupBy(*keys).agg(F.count(F.lit(1)).alias("dup_count"))
            .where(F.col("dup_count") > 1))


def check_not_null(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Rows with a null in any of ``cols`` plus ``null_columns`` naming them."""
    names = F.concat_ws(",", *[F.when(F.col(c).isNull(), F.lit(c)) for c in cols])
    cond = None
    for c in cols:
        cond = F.col(c).isNull() if cond is None else cond | F.col(c).isNull()
    return df.where(cond).withColumn("null_columns", names)


class ConstraintViolation(ValueError):
    """Rows that a table's declared constraints do not allow."""


def require_unique(df: DataFrame, keys: Sequence[str], table: str) -> None:
    """Raise ``ConstraintViolation`` if a key of ``df`` is null in part or occurs twice.

    Only the key columns are read; counts combine before the shuffle, and one violating key is
    all that reaches the driver.
    """
    bad = (df.groupBy(*keys).agg(F.count(F.lit(1)).alias("dup_count"))
           .where((F.col("dup_count") > 1)
                  | F.greatest(*[F.col(k).isNull() for k in keys], F.lit(False)))
           .limit(1).collect())
    if bad:
        row = bad[0].asDict()
        count = row.pop("dup_count")
        raise ConstraintViolation(f"{table}: key {row} occurs {count} times"
                                  if None not in row.values() else f"{table}: null in key {row}")


def check_fk(child: DataFrame, parent: DataFrame, child_key: str,
             parent_key: str | None = None) -> DataFrame:
    """Child rows whose (non-null) key has no parent row."""
    parent_key = parent_key or child_key
    parents = parent.select(F.col(parent_key).alias("_pk"))
    return (child.where(F.col(child_key).isNotNull())
            .join(parents, F.col(child_key) == F.col("_pk"), "left_anti"))


def _always_fits(have: DataType, limit: DecimalType) -> bool:
    """Whether every value of type ``have`` fits ``limit``, so that there is nothing to check."""
    return (isinstance(have, DecimalType) and have.scale <= limit.scale
            and have.precision - have.scale <= limit.precision - limit.scale)


def check_domain(df: DataFrame, lengths: Mapping[str, int] | None = None,
                 decimals: Mapping[str, DecimalType] | None = None) -> DataFrame:
    """Rows whose text exceeds a length limit or whose number does not fit a DECIMAL(p,s).

    ``violations`` names the offending columns.
    """
    checks = []
    for c, limit in (lengths or {}).items():
        checks.append((F.length(F.col(c)) > limit, c))
    for c, dtype in (decimals or {}).items():
        src = F.col(c)
        if not _always_fits(df.schema[c].dataType, dtype):
            checks.append((src.isNotNull() & src.try_cast(dtype).isNull(), c))
    if not checks:
        return df.limit(0).withColumn("violations", F.lit(None).cast("string"))
    cond = None
    for bad, _ in checks:
        bad = F.coalesce(bad, F.lit(False))
        cond = bad if cond is None else cond | bad
    names = F.concat_ws(",", *[F.when(F.coalesce(b, F.lit(False)), F.lit(c)) for b, c in checks])
    return df.where(cond).withColumn("violations", names)
