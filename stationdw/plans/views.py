"""The shared daily and monthly views over the star."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stationdw.functions.units import hundredths_to_inches, tenths_to_degrees
from stationdw.operators.aggregate import monthly_view

MONTH_GROUP = ["station_id", "station_name", "latitude", "longitude", "year_num", "month_num",
               "month_name"]


def daily_view(fact: DataFrame, dim_date: DataFrame, dim_station: DataFrame) -> DataFrame:
    """Daily readings in degrees F and inches; a day with any null measure is left out.

    The null filter sits on fact columns and reaches the Parquet scan; whether a
    dimension is broadcast is decided from its measured size.
    """
    f = fact.where(F.col("dly_tmin_normal").isNotNull() & F.col("dly_tmax_normal").isNotNull()
                   & F.col("mtd_prcp_normal").isNotNull())
    dd = dim_date.select("date_key", "year_num", "month_num", "month_name", "quarter_num",
                         "full_date")
    ds = dim_station.select("station_key", "station_id", "station_name", "latitude",
                            "longitude")
    joined = f.join(dd, "date_key").join(ds, "station_key")
    return joined.select(
        "station_id", "station_name", "latitude", "longitude", "year_num", "month_num",
        "month_name", "quarter_num", "full_date",
        tenths_to_degrees("dly_tmin_normal").alias("dly_tmin_normal_f"),
        tenths_to_degrees("dly_tmax_normal").alias("dly_tmax_normal_f"),
        hundredths_to_inches("mtd_prcp_normal").alias("mtd_prcp_normal_in"),
    )


def monthly_climate(daily: DataFrame) -> DataFrame:
    """Monthly view: one row per station-month with count, average, extremes and total."""
    return monthly_view(daily, MONTH_GROUP, "dly_tmin_normal_f", "dly_tmax_normal_f",
                        "mtd_prcp_normal_in")


def monthly_from_star(fact: DataFrame, dim_date: DataFrame, dim_station: DataFrame) -> DataFrame:
    """The monthly view computed straight from the star, narrow keys first.

    Same rows as ``monthly_climate(daily_view(...))`` when every fact row has its station (the
    fact -> dim_station key, checked by ``checks.check_fk``): the rollup groups by the integer
    ``station_key`` and the month, so the shuffled partial aggregates carry four small keys
    instead of the station's id, name and coordinates, and the station attributes are joined
    onto the (much smaller) monthly result afterwards.
    """
    f = fact.where(F.col("dly_tmin_normal").isNotNull() & F.col("dly_tmax_normal").isNotNull()
                   & F.col("mtd_prcp_normal").isNotNull())
    dd = dim_date.select("date_key", "year_num", "month_num", "month_name")
    ds = dim_station.select("station_key", "station_id", "station_name", "latitude",
                            "longitude")
    joined = f.join(dd, "date_key")
    daily = joined.select(
        "station_key", "year_num", "month_num", "month_name",
        tenths_to_degrees("dly_tmin_normal").alias("dly_tmin_normal_f"),
        tenths_to_degrees("dly_tmax_normal").alias("dly_tmax_normal_f"),
        hundredths_to_inches("mtd_prcp_normal").alias("mtd_prcp_normal_in"))
    monthly = monthly_view(daily, ["station_key", "year_num", "month_num", "month_name"],
                           "dly_tmin_normal_f", "dly_tmax_normal_f", "mtd_prcp_normal_in")
    named = monthly.join(ds, "station_key")
    return named.select(*MONTH_GROUP, "num_days", "monthly_avg_temperature_f",
                        "monthly_max_temperature_f", "monthly_min_temperature_f",
                        "monthly_total_precipitation_in")
