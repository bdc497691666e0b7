"""Aggregations of the warehouse: monthly rollups, stream summary, seasons, years, pivots."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stationdw.functions.numeric import half
from stationdw.functions.season import season_name, season_order
from stationdw.operators.ranking import rank_within, first_per_group

MONTHLY_MEASURES = ["monthly_avg_temperature_f", "monthly_max_temperature_f",
                    "monthly_min_temperature_f", "monthly_total_precipitation_in"]


def monthly_view(daily: DataFrame, group_cols: Sequence[str], lo: str, hi: str, mtd: str
                 ) -> DataFrame:
    """Monthly rollup of daily readings (decimal in, decimal out).

    num_days = COUNT(*); average = ROUND(AVG((lo + hi) / 2), 2); max of ``hi``; min of ``lo``;
    month total = MAX(month-to-date), since the running value peaks at month end.
    """
    return daily.groupBy(*group_cols).agg(
        F.count(F.lit(1)).alias("num_days"),
        F.round(F.avg(half(F.col(lo) + F.col(hi))), 2).alias("monthly_avg_temperature_f"),
        F.round(F.max(hi), 2).alias("monthly_max_temperature_f"),
        F.round(F.min(lo), 2).alias("monthly_min_temperature_f"),
        F.round(F.max(mtd), 2).alias("monthly_total_precipitation_in"),
    )


def monthly_summary(readings: DataFrame, keys: Sequence[str] | None = None,
                    dedupe_keys: Sequence[str] | None = None, arrival: str | None = None
                    ) -> DataFrame:
    """Continuous monthly summary (batch or streaming input).

    COUNT(*) days, AVG of each temperature (nulls skipped), MAX month-to-date precipitation,
    grouped by the five month keys. Rows with a null grouping value are dropped first, as the
    stream-SQL engine does. ``dedupe_keys`` optionally drops replayed readings first (batch:
    distinct; streaming: state-backed ``dropDuplicates`` without expiry). ``arrival`` names the
    readings' arrival order: the latest one of a group is kept in the state under the same name,
    so that a loader knows which of two groups changed last; readings without it have no order.
    """
    keys = list(keys or ["station_id", "station_name", "norm_month", "year_num", "month_num"])
    cond = None
    for k in keys:
        cond = F.col(k).isNotNull() if cond is None else cond & F.col(k).isNotNull()
    rows = readings.where(cond)
    if dedupe_keys:
        rows = rows.dropDuplicates(list(dedupe_keys))
    return rows.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("num_days"),
        F.avg("dly_tmin_normal").alias("avg_dly_tmin_normal"),
        F.avg("dly_tmax_normal").alias("avg_dly_tmax_normal"),
        F.max("mtd_prcp_normal").alias("month_end_prcp_normal"),
        *([F.max(arrival).alias(arrival)] if arrival in rows.columns else []),
    )


def seasonal(monthly: DataFrame, entity_cols: Sequence[str], year_col: str = "year_num",
             month_col: str = "month_num") -> DataFrame:
    """Season rollup of the rounded monthly values (an unweighted mean of monthly means)."""
    grouped = monthly.withColumn("season_name", season_name(month_col)) \
        .withColumn("season_order", season_order(month_col))
    agg = grouped.groupBy(*entity_cols, year_col, "season_name", "season_order").agg(
        F.round(F.avg("monthly_avg_temperature_f"), 2).alias("seasonal_avg_temperature"),
        F.round(F.max("monthly_max_temperature_f"), 2).alias("seasonal_max_temperature"),
        F.round(F.min("monthly_min_temperature_f"), 2).alias("seasonal_min_temperature"),
        F.round(F.sum("monthly_total_precipitation_in"), 2)
        .alias("seasonal_total_precipitation"),
    )
    return agg.withColumn(
        "seasonal_temperature_range",
        F.round(F.col("seasonal_max_temperature") - F.col("seasonal_min_temperature"), 2))


def compare_entities(monthly: DataFrame, entity_col: str, left: str, right: str,
                     measures: Mapping[str, str], keys: Sequence[str],
                     labels: tuple[str, str] | None = None,
                     differences: Mapping[str, str] | None = None,
                     left_minus_right: bool = True) -> DataFrame:
    """Two-entity pivot: ``MAX(CASE WHEN entity = x THEN measure END)`` per measure and entity.

    ``measures`` maps source column -> output suffix, giving ``<label>_<suffix>`` columns.
    ``differences`` maps a suffix -> output name of ROUND(left - right, 2) (or right - left).
    The IN filter is on a grouping column, so Catalyst pushes it below the monthly rollup.
    """
    lab_l, lab_r = labels or (left, right)
    rows = monthly.where(F.col(entity_col).isin(left, right))
    aggs = []
    for src, suffix in measures.items():
        for ent, lab in ((left, lab_l), (right, lab_r)):
            aggs.append(F.max(F.when(F.col(entity_col) == F.lit(ent), F.col(src)))
                        .alias(f"{lab}_{suffix}"))
    out = rows.groupBy(*keys).agg(*aggs)
    for suffix, name in (differences or {}).items():
        a, b = F.col(f"{lab_l}_{suffix}"), F.col(f"{lab_r}_{suffix}")
        out = out.withColumn(name, F.round(a - b if left_minus_right else b - a, 2))
    return out


def annual_profile(monthly: DataFrame, entity_cols: Sequence[str], id_col: str,
                   year_col: str = "year_num", month_col: str = "month_num",
                   distributed: bool = True) -> DataFrame:
    """Yearly profile per entity with its wettest month and the range rank within the year.

    Wettest month: largest month total, ties to the earlier month (first row per entity-year).
    Rank: RANK() OVER (PARTITION BY year ORDER BY range DESC), range-partitioned
    at every size; ``distributed=False`` asks for one window task per year.
    """
    annual = monthly.groupBy(*entity_cols, year_col).agg(
        F.round(F.avg("monthly_avg_temperature_f"), 2).alias("annual_avg_temperature"),
        F.round(F.max("monthly_max_temperature_f"), 2).alias("annual_max_temperature"),
        F.round(F.min("monthly_min_temperature_f"), 2).alias("annual_min_temperature"),
        F.round(F.max("monthly_max_temperature_f") - F.min("monthly_min_temperature_f"), 2)
        .alias("annual_temperature_range"),
        F.round(F.sum("monthly_total_precipitation_in"), 2)
        .alias("annual_total_precipitation"),
    )
    wettest = first_per_group(
        monthly.select(id_col, year_col, month_col, "month_name",
                       "monthly_total_precipitation_in"),
        [id_col, year_col],
        [("monthly_total_precipitation_in", False), (month_col, True)],
    ).select(id_col, year_col, F.col("month_name").alias("wettest_month_name"),
             F.col("monthly_total_precipitation_in").alias("wettest_month_precipitation"))
    joined = annual.join(wettest, [id_col, year_col])
    # Written once: the rank reads its input several times, and then reads the small annual table
    # instead of re-running the monthly rollup behind it.
    from stationdw.sources.tables import materialize
    joined = materialize(joined, "annual")
    return rank_within(joined, [year_col], ["annual_temperature_range"], [False],
                       "annual_temperature_range_rank", distributed=distributed)
