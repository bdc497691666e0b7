"""Output shaping for reports that leave the engine."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def plain_types(df: DataFrame) -> DataFrame:
    """Decimals -> DOUBLE, tiny/small ints -> INT, so any SQL engine shows the same types."""
    cols = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, T.DecimalType):
            c = c.cast("double")
        elif isinstance(f.dataType, (T.ByteType, T.ShortType)):
            c = c.cast("int")
        cols.append(c.alias(f.name))
    return df.select(*cols)
