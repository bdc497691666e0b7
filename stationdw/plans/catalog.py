"""Warehouse tables in the Spark catalog: DDL, database selection, shared SQL views.

Tables are Parquet at explicit locations (the shared warehouse folder), created only when
absent. Staging and the monthly summary are partitioned by month, which replaces a secondary
index on the date: month predicates prune partitions and Parquet min/max statistics prune row
groups inside them.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from stationdw.plans.views import daily_view, monthly_climate
from stationdw.schemas import DIM_DATE, DIM_STATION, FACT, MONTHLY_SUMMARY, STAGING

# Table name -> (schema, partition column or None).
TABLES = {
    "climate_normal_daily_raw": (
        T.StructType(STAGING.fields + [T.StructField("norm_month", T.StringType())]),
        "norm_month"),
    "dim_date": (DIM_DATE, None),
    "dim_station": (DIM_STATION, None),
    "fact_daily_climate_normal": (
        T.StructType(FACT.fields + [T.StructField("date_month", T.IntegerType())]),
        "date_month"),
    "monthly_climate_normal_summary": (MONTHLY_SUMMARY, "norm_month"),
}


def _ddl(schema: T.StructType) -> str:
    cols = []
    for f in schema.fields:
        null = "" if f.nullable else " NOT NULL"
        cols.append(f"`{f.name}` {f.dataType.simpleString()}{null}")
    return ", ".join(cols)


def table_paths(base_path: str, database: str) -> dict[str, str]:
    """Fixed location of every warehouse table (plus the quarantine and changelog folders)."""
    root = f"{base_path.rstrip('/')}/{database}"
    paths = {name: f"{root}/{name}" for name in TABLES}
    paths["quarantine"] = f"{root}/quarantine"
    paths["summary_changelog"] = f"{root}/summary_changelog"
    paths["checkpoints"] = f"{root}/_checkpoints"
    return paths


def ensure_tables(spark: SparkSession, database: str, base_path: str) -> dict[str, str]:
    """CREATE DATABASE / TABLE IF NOT EXISTS for the five warehouse tables.

    Returns table name -> location. Existing tables and their data are left untouched, so every
    job can call it to register the tables in its session's catalog.
    """
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{database}`")
    locations = {}
    paths = table_paths(base_path, database)
    for name, (schema, part) in TABLES.items():
        location = paths[name]
        partition = f" PARTITIONED BY (`{part}`)" if part else ""
        spark.sql(f"CREATE TABLE IF NOT EXISTS `{database}`.`{name}` ({_ddl(schema)}) "
                  f"USING parquet{partition} LOCATION '{location}'")
        locations[name] = location
    return locations


def use_database(spark: SparkSession, database: str) -> None:
    """Select the current database (``USE db``)."""
    spark.catalog.setCurrentDatabase(database)


def register_views(star: Mapping[str, DataFrame], prefix: str = "") -> dict[str, DataFrame]:
    """Expose the star and the two shared views to Spark SQL as temporary views.

    Names: ``fact_daily_climate_normal``, ``dim_date``, ``dim_station``,
    ``vw_daily_climate_imperial`` and ``vw_monthly_climate_imperial`` (``CREATE OR REPLACE``
    semantics), so analysts can keep writing reports in SQL against the same plans.
    """
    daily = daily_view(star["fact"], star["dim_date"], star["dim_station"])
    monthly = monthly_climate(daily)
    views = {
        "fact_daily_climate_normal": star["fact"],
        "dim_date": star["dim_date"],
        "dim_station": star["dim_station"],
        "vw_daily_climate_imperial": daily,
        "vw_monthly_climate_imperial": monthly,
    }
    for name, df in views.items():
        df.createOrReplaceTempView(prefix + name)
    return views


#: The shared views as SQL over a database's tables; the same rows and types as
#: ``views.daily_view`` and ``views.monthly_climate``.
VIEWS = {
    "vw_daily_climate_imperial": """
        SELECT s.station_id, s.station_name, s.latitude, s.longitude, d.year_num, d.month_num,
               d.month_name, d.quarter_num, d.full_date,
               ROUND(f.dly_tmin_normal * CAST(0.1 AS DECIMAL(2,1)), 2) AS dly_tmin_normal_f,
               ROUND(f.dly_tmax_normal * CAST(0.1 AS DECIMAL(2,1)), 2) AS dly_tmax_normal_f,
               ROUND(f.mtd_prcp_normal * CAST(0.01 AS DECIMAL(3,2)), 2) AS mtd_prcp_normal_in
        FROM {db}.fact_daily_climate_normal f
        JOIN {db}.dim_date d ON d.date_key = f.date_key
        JOIN {db}.dim_station s ON s.station_key = f.station_key
        WHERE f.dly_tmin_normal IS NOT NULL AND f.dly_tmax_normal IS NOT NULL
          AND f.mtd_prcp_normal IS NOT NULL""",
    "vw_monthly_climate_imperial": """
        SELECT station_id, station_name, latitude, longitude, year_num, month_num, month_name,
               COUNT(*) AS num_days,
               ROUND(AVG((dly_tmin_normal_f + dly_tmax_normal_f) * CAST(0.5 AS DECIMAL(2,1))), 2)
                 AS monthly_avg_temperature_f,
               ROUND(MAX(dly_tmax_normal_f), 2) AS monthly_max_temperature_f,
               ROUND(MIN(dly_tmin_normal_f), 2) AS monthly_min_temperature_f,
               ROUND(MAX(mtd_prcp_normal_in), 2) AS monthly_total_precipitation_in
        FROM {db}.vw_daily_climate_imperial
        GROUP BY station_id, station_name, latitude, longitude, year_num, month_num, month_name""",
}


def create_views(spark: SparkSession, database: str) -> list[str]:
    """``CREATE OR REPLACE VIEW`` of the shared views in ``database``, over its tables.

    Unlike ``register_views`` these are catalog objects: every session of the application sees
    them, and with a persistent catalog every later application. Returns their full names.
    """
    for name, sql in VIEWS.items():
        spark.sql(f"CREATE OR REPLACE VIEW `{database}`.`{name}` AS "
                  + sql.format(db=f"`{database}`"))
    return [f"{database}.{name}" for name in VIEWS]


def refresh_tables(spark: SparkSession, database: str) -> None:
    """Pick up partitions and files written by jobs since the tables were registered."""
    for name, (_, part) in TABLES.items():
        try:
            if part:
                spark.catalog.recoverPartitions(f"{database}.{name}")
            spark.catalog.refreshTable(f"`{database}`.`{name}`")
        except Exception as exc:  # noqa: BLE001 - a table nothing was written to yet
            if "does not exist" not in str(exc) and "PATH_NOT_FOUND" not in str(exc):
                raise
