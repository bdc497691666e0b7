"""Meteorological seasons of a month number (December stays in its own calendar year)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from stationdw.functions.numeric import col_of

# Season label, sort order and months.
SEASONS = [
    ("Winter", 1, (12, 1, 2)),
    ("Spring", 2, (3, 4, 5)),
    ("Summer", 3, (6, 7, 8)),
    ("Fall", 4, (9, 10, 11)),
]


def _case(month: Column, pick) -> Column:
    expr = None
    for label, order, months in SEASONS[:-1]:
        value = F.lit(pick(label, order))
        expr = F.when(month.isin(*months), value) if expr is None else \
            expr.when(month.isin(*months), value)
    last_label, last_order, _ = SEASONS[-1]
    return expr.otherwise(F.lit(pick(last_label, last_order)))


def season_name(month: Column | str) -> Column:
    return _case(col_of(month), lambda label, order: label)


def season_order(month: Column | str) -> Column:
    return _case(col_of(month), lambda label, order: order)
