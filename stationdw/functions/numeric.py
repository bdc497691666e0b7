"""Numeric text conversions and exact decimal arithmetic as Spark column expressions.

Arithmetic on measures stays in DECIMAL so rounding is exact and half-away-from-zero; literal
factors are decimal literals (``dec("0.1")``), never doubles.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, DecimalType


def col_of(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def dec(value: str) -> Column:
    """Exact decimal literal (precision and scale taken from the text)."""
    d = Decimal(value)
    digits = len(d.as_tuple().digits)
    scale = max(-d.as_tuple().exponent, 0)
    precision = max(digits, scale + 1)
    return F.lit(d).cast(DecimalType(precision, scale))


def strip_ws(c: Column | str) -> Column:
    """Remove leading and trailing whitespace (all of it, not only spaces)."""
    return F.regexp_replace(F.regexp_replace(col_of(c), r"^\s+", ""), r"\s+$", "")


def blank_to_null(c: Column | str) -> Column:
    """Stripped text, or null when nothing is left."""
    return F.nullif(strip_ws(c), F.lit(""))


def to_float(c: Column | str, strict: bool = True) -> Column:
    """Blank -> null, else a double. ``strict`` raises on bad text (ANSI cast), else null."""
    text = blank_to_null(c)
    return text.cast("double") if strict else text.try_cast("double")


def to_int(c: Column | str, strict: bool = True) -> Column:
    """Blank -> null, else the number truncated toward zero (``"-3.7"`` -> -3)."""
    return to_float(c, strict).cast("int")


def to_decimal(c: Column | str, dtype: DataType, strict: bool = True) -> Column:
    """Blank -> null, else the decimal value (half-up; out of range raises when strict)."""
    c = col_of(c)
    text = F.nullif(c.cast("string"), F.lit(""))
    return text.cast(dtype) if strict else text.try_cast(dtype)


def scaled(c: Column | str, factor: str, digits: int = 2) -> Column:
    """``ROUND(x * factor, digits)`` in decimal arithmetic (``factor`` like ``"0.1"``)."""
    return F.round(col_of(c) * dec(factor), digits)


def half(c: Column) -> Column:
    """x / 2 as an exact decimal product."""
    return c * dec("0.5")
