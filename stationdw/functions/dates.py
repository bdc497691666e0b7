"""Date parsing and calendar attributes."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from stationdw.functions.numeric import col_of


def parse_yyyymmdd(c: Column | str) -> Column:
    """Strict ``yyyyMMdd`` text (surrounding whitespace allowed) -> DATE; anything else
    (short, non-digit, 20100230) -> null."""
    digits = F.regexp_extract(col_of(c).cast("string"), r"^\s*([0-9]{8})\s*$", 1)
    return F.when(digits != F.lit(""), F.try_to_date(digits, "yyyyMMdd"))


def date_key(d: Column | str) -> Column:
    """Smart key ``yyyymmdd`` as an integer."""
    d = col_of(d)
    return (F.year(d) * 10000 + F.month(d) * 100 + F.dayofmonth(d)).cast("int")


def month_name(d: Column | str) -> Column:
    """English month name (``January`` ...)."""
    return F.date_format(col_of(d), "MMMM")


def month_key(text_date: Column | str) -> Column:
    """``yyyyMM`` month key: the first six characters of a ``yyyyMMdd`` text date."""
    return F.substring(col_of(text_date), 1, 6)
