"""Unit conversion of raw normals (tenths of degree F, hundredths of inch)."""

from __future__ import annotations

from pyspark.sql import Column

from stationdw.functions.numeric import scaled


def tenths_to_degrees(c: Column | str) -> Column:
    """ROUND(x / 10.0, 2), written as the exact decimal product x * 0.1."""
    return scaled(c, "0.1")


def hundredths_to_inches(c: Column | str) -> Column:
    """ROUND(x / 100.0, 2), written as the exact decimal product x * 0.01."""
    return scaled(c, "0.01")
