"""The four-station daily normals behind the published reports, rebuilt from the samples.

Petersburg comes from the daily-normals CSV as is. Pittsburgh, Seattle and San Francisco come
from their per-month daily files (``MM-DD`` dates, year 2010) joined to their monthly file, whose
monthly precipitation stands in for the month-to-date value of every day of that month (only
its monthly maximum is used by the reports). Station names follow the published monthly report;
the two latitudes are the ones printed in the gap report, other coordinates are unknown (null).
"""

from __future__ import annotations

import os

from pyspark.sql import functions as F

from stationdw.operators.clean import split_valid
from stationdw.plans.star import load_star
from stationdw.plans.views import daily_view, monthly_climate
from stationdw.sources.csv_daily import read_daily_csv, read_header_csv
from stationdw.sources.messages import stage_typed

DATA = os.path.join(os.path.dirname(os.path.abspath(__file__)), "data")

# Folder, station name, latitude of the three stations outside the daily CSV.
CITIES = [
    ("pittsburgh", "PITTSBURGH INTL AP PA US", None),
    ("seattle", "SEATTLE URBAN SITE WA US", "47.65"),
    ("san_francisco", "SAN FRANCISCO OCEANSD CA US", "37.728"),
]


def city_rows(spark, folder, name, latitude):
    base = os.path.join(DATA, "normals", folder)
    daily = read_header_csv(spark, os.path.join(base, "daily", "*.csv"))
    monthly = read_header_csv(spark, os.path.join(base, "monthly.csv")).select(
        F.col("DATE").alias("_mm"), F.col("`MLY-PRCP-NORMAL`").alias("_prcp"))
    joined = daily.join(monthly, F.substring("DATE", 1, 2) == F.col("_mm"))
    return joined.select(
        F.concat(F.lit("GHCND:"), F.col("STATION")).alias("station_id"),
        F.lit(name).alias("station_name"),
        F.lit(None).cast("double").alias("elevation"),
        F.lit(latitude).cast("double").alias("latitude"),
        F.lit(None).cast("double").alias("longitude"),
        F.concat(F.lit("2010"), F.regexp_replace("DATE", "-", "")).alias("norm_date"),
        F.col("`DLY-TMIN-NORMAL`").cast("int").alias("dly_tmin_normal"),
        F.col("`DLY-TMAX-NORMAL`").cast("int").alias("dly_tmax_normal"),
        F.col("_prcp").cast("int").alias("mtd_prcp_normal"),
    )


def four_station_staging(spark):
    rows = read_daily_csv(spark, os.path.join(DATA, "NORMAL_DLY_sample_csv.csv"))
    for folder, name, lat in CITIES:
        rows = rows.unionByName(city_rows(spark, folder, name, lat))
    valid, rejected = split_valid(stage_typed(rows), ["station_id", "station_name", "norm_date"])
    return valid, rejected


def four_station_star(spark):
    staging, rejected = four_station_staging(spark)
    staging = staging.checkpoint(eager=True)
    star = load_star(staging, materialize=True)
    daily = daily_view(star["fact"], star["dim_date"], star["dim_station"])
    monthly = monthly_climate(daily).checkpoint(eager=True)
    return {"staging": staging, "rejected": rejected, "star": star, "daily": daily,
            "monthly": monthly}
