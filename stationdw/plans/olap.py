"""The five analytical reports over the monthly view, as parameterised DataFrame plans.

Station ids and output labels are arguments; nothing about particular stations is built in.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stationdw.operators.aggregate import annual_profile, compare_entities, seasonal
from stationdw.operators.ranking import global_rank


def q1_monthly(monthly: DataFrame) -> DataFrame:
    """Monthly station summary, ordered by station name, year, month."""
    return monthly.select(
        "station_id", "station_name", "year_num", "month_num", "month_name", "num_days",
        F.col("monthly_avg_temperature_f").alias("monthly_avg_temperature_normal"),
        F.col("monthly_max_temperature_f").alias("monthly_max_temperature_normal"),
        F.col("monthly_min_temperature_f").alias("monthly_min_temperature_normal"),
        F.col("monthly_total_precipitation_in").alias("monthly_total_precipitation_normal"),
    ).orderBy("station_name", "year_num", "month_num")


def q2_compare(monthly: DataFrame, left: str, right: str, left_label: str, right_label: str
               ) -> DataFrame:
    """Two stations side by side per month, with left-minus-right differences."""
    L, R = left_label, right_label
    out = compare_entities(
        monthly, "station_id", left, right,
        {"monthly_avg_temperature_f": "avg_temperature",
         "monthly_total_precipitation_in": "total_precipitation"},
        ["year_num", "month_num", "month_name"], labels=(L, R),
        differences={"avg_temperature": f"{L}_minus_{R}_avg_temperature",
                     "total_precipitation": f"{L}_minus_{R}_precipitation"})
    return out.select(
        "year_num", "month_num", "month_name", f"{L}_avg_temperature", f"{R}_avg_temperature",
        f"{L}_minus_{R}_avg_temperature", f"{L}_total_precipitation",
        f"{R}_total_precipitation", f"{L}_minus_{R}_precipitation",
    ).orderBy("year_num", "month_num")


def q3_season(monthly: DataFrame, station_ids: Sequence[str]) -> DataFrame:
    """Season profile of the given stations, in season order (Winter first)."""
    rows = monthly.where(F.col("station_id").isin(*station_ids))
    out = seasonal(rows, ["station_id", "station_name"])
    return out.orderBy("year_num", "season_order", "station_name").select(
        "year_num", "season_name", "station_name", "seasonal_avg_temperature",
        "seasonal_max_temperature", "seasonal_min_temperature",
        "seasonal_temperature_range", "seasonal_total_precipitation")


def q4_gap_rank(monthly: DataFrame, first: str, second: str, first_label: str,
                second_label: str, distributed: bool = False) -> DataFrame:
    """Two stations per month, ranked by the absolute (unrounded) average-temperature gap.

    The ranked frame holds one row per calendar month of the two stations, a bound set by the
    date range and not by the data volume, so the single-partition window is the right plan
    by default (``distributed=True`` switches to the range-partitioned rank).
    """
    A, B = first_label, second_label
    paired = compare_entities(
        monthly, "station_id", first, second,
        {"latitude": "latitude", "monthly_avg_temperature_f": "avg_temperature",
         "monthly_total_precipitation_in": "total_precipitation"},
        ["year_num", "month_num", "month_name"], labels=(A, B),
        differences={"avg_temperature": f"{B}_minus_{A}_temperature",
                     "total_precipitation": f"{B}_minus_{A}_precipitation"},
        left_minus_right=False)
    gap = F.abs(F.col(f"{B}_avg_temperature") - F.col(f"{A}_avg_temperature"))
    ranked = global_rank(paired, [gap], [False], "temperature_difference_rank",
                         distributed=distributed)
    return ranked.select(
        "year_num", "month_num", "month_name", f"{A}_latitude", f"{B}_latitude",
        f"{A}_avg_temperature", f"{B}_avg_temperature", f"{B}_minus_{A}_temperature",
        f"{A}_total_precipitation", f"{B}_total_precipitation", f"{B}_minus_{A}_precipitation",
        "temperature_difference_rank",
    ).orderBy("temperature_difference_rank", "year_num", "month_num")


def q5_annual_profile(monthly: DataFrame, distributed: bool = True) -> DataFrame:
    """Yearly profile per station with wettest month and temperature-range rank."""
    out = annual_profile(monthly, ["station_id", "station_name"], "station_id",
                         distributed=distributed)
    return out.select(
        "station_id", "station_name", "year_num", "annual_avg_temperature",
        "annual_max_temperature", "annual_min_temperature", "annual_temperature_range",
        "annual_total_precipitation", "wettest_month_name", "wettest_month_precipitation",
        "annual_temperature_range_rank",
    ).orderBy("year_num", "annual_temperature_range_rank", "station_name")
