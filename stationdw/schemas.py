"""Declared schemas and keys of the warehouse tables.

Fixed values (they must equal the reference's table definitions): column names, decimal
precision/scale, VARCHAR limits and natural keys below.
"""

from __future__ import annotations

from pyspark.sql import types as T

# ---- fixed values: source layout -------------------------------------------------------------
# Header names of the daily-normals CSV and the message field each one becomes.
DAILY_CSV_RENAME = {
    "STATION": "station_id",
    "STATION_NAME": "station_name",
    "ELEVATION": "elevation",
    "LATITUDE": "latitude",
    "LONGITUDE": "longitude",
    "DATE": "norm_date",
    "DLY-TMIN-NORMAL": "dly_tmin_normal",
    "DLY-TMAX-NORMAL": "dly_tmax_normal",
    "MTD-PRCP-NORMAL": "mtd_prcp_normal",
}
FLOAT_FIELDS = ("elevation", "latitude", "longitude")
INT_FIELDS = ("dly_tmin_normal", "dly_tmax_normal", "mtd_prcp_normal")

# Raw message (one JSON object per reading): strings, doubles, integers; the date stays text.
RAW_MESSAGE = T.StructType([
    T.StructField("station_id", T.StringType()),
    T.StructField("station_name", T.StringType()),
    T.StructField("elevation", T.DoubleType()),
    T.StructField("latitude", T.DoubleType()),
    T.StructField("longitude", T.DoubleType()),
    T.StructField("norm_date", T.StringType()),
    T.StructField("dly_tmin_normal", T.IntegerType()),
    T.StructField("dly_tmax_normal", T.IntegerType()),
    T.StructField("mtd_prcp_normal", T.IntegerType()),
])

# ---- fixed values: table definitions ---------------------------------------------------------
ELEVATION = T.DecimalType(8, 2)
COORD = T.DecimalType(10, 6)
TEMP = T.DecimalType(7, 2)
PRCP = T.DecimalType(10, 2)

STAGING = T.StructType([
    T.StructField("station_id", T.StringType(), False),
    T.StructField("station_name", T.StringType(), False),
    T.StructField("elevation", ELEVATION),
    T.StructField("latitude", COORD),
    T.StructField("longitude", COORD),
    T.StructField("norm_date", T.DateType(), False),
    T.StructField("dly_tmin_normal", TEMP),
    T.StructField("dly_tmax_normal", TEMP),
    T.StructField("mtd_prcp_normal", PRCP),
    T.StructField("created_at", T.TimestampType()),
])
STAGING_KEY = ["station_id", "norm_date"]
STATION_ATTRS = ["station_name", "elevation", "latitude", "longitude"]
MEASURES = ["dly_tmin_normal", "dly_tmax_normal", "mtd_prcp_normal"]

DIM_DATE = T.StructType([
    T.StructField("date_key", T.IntegerType(), False),
    T.StructField("full_date", T.DateType(), False),
    T.StructField("day_num", T.IntegerType(), False),
    T.StructField("month_num", T.IntegerType(), False),
    T.StructField("month_name", T.StringType(), False),
    T.StructField("quarter_num", T.IntegerType(), False),
    T.StructField("year_num", T.IntegerType(), False),
])
DIM_STATION = T.StructType([
    T.StructField("station_key", T.IntegerType(), False),
    T.StructField("station_id", T.StringType(), False),
    T.StructField("station_name", T.StringType(), False),
    T.StructField("elevation", ELEVATION),
    T.StructField("latitude", COORD),
    T.StructField("longitude", COORD),
])
FACT = T.StructType([
    T.StructField("date_key", T.IntegerType(), False),
    T.StructField("station_key", T.IntegerType(), False),
    T.StructField("dly_tmin_normal", TEMP),
    T.StructField("dly_tmax_normal", TEMP),
    T.StructField("mtd_prcp_normal", PRCP),
])
FACT_KEY = ["station_key", "date_key"]
MONTHLY_SUMMARY = T.StructType([
    T.StructField("station_id", T.StringType(), False),
    T.StructField("station_name", T.StringType(), False),
    T.StructField("norm_month", T.StringType(), False),
    T.StructField("year_num", T.IntegerType(), False),
    T.StructField("month_num", T.IntegerType(), False),
    T.StructField("num_days", T.IntegerType()),
    T.StructField("avg_dly_tmin_normal", TEMP),
    T.StructField("avg_dly_tmax_normal", TEMP),
    T.StructField("month_end_prcp_normal", PRCP),
])
SUMMARY_KEY = ["station_id", "norm_month"]
SUMMARY_GROUP = ["station_id", "station_name", "norm_month", "year_num", "month_num"]

# VARCHAR / CHAR limits per table and column.
LENGTH_LIMITS = {
    "staging": {"station_id": 30, "station_name": 100},
    "dim_station": {"station_id": 30, "station_name": 100},
    "dim_date": {"month_name": 15},
    "monthly_summary": {"station_id": 30, "station_name": 100, "norm_month": 6},
}
NOT_NULL = {
    "staging": ["station_id", "station_name", "norm_date"],
    "dim_date": [f.name for f in DIM_DATE.fields],
    "dim_station": ["station_key", "station_id", "station_name"],
    "fact": ["date_key", "station_key"],
    "monthly_summary": SUMMARY_GROUP,
}

# ---- fixed values: keyed monthly-summary messages --------------------------------------------
# Field names the summary topic may use (upper case as the stream-SQL engine writes them,
# lower case, with and without the ``_V`` value copies), in the order they are tried.
SUMMARY_VALUE_ALIASES = {
    "station_id": ["STATION_ID_V", "station_id_v", "STATION_ID", "station_id"],
    "station_name": ["STATION_NAME_V", "station_name_v", "STATION_NAME", "station_name"],
    "norm_month": ["NORM_MONTH_V", "norm_month_v", "NORM_MONTH", "norm_month",
                   "OBS_MONTH_V", "obs_month_v", "OBS_MONTH", "obs_month"],
    "year_num": ["YEAR_NUM_V", "year_num_v", "YEAR_NUM", "year_num"],
    "month_num": ["MONTH_NUM_V", "month_num_v", "MONTH_NUM", "month_num"],
    "num_days": ["NUM_DAYS", "num_days", "COUNT", "count"],
    "avg_dly_tmin_normal": ["AVG_DLY_TMIN_NORMAL", "avg_dly_tmin_normal",
                            "AVG_TMIN_NORMAL", "avg_tmin_normal", "AVG_TMIN", "avg_tmin"],
    "avg_dly_tmax_normal": ["AVG_DLY_TMAX_NORMAL", "avg_dly_tmax_normal",
                            "AVG_TMAX_NORMAL", "avg_tmax_normal", "AVG_TMAX", "avg_tmax"],
    "month_end_prcp_normal": ["MONTH_END_PRCP_NORMAL", "month_end_prcp_normal",
                              "MAX_MTD_PRCP_NORMAL", "max_mtd_prcp_normal",
                              "MAX_PRCP_NORMAL", "max_prcp_normal",
                              "MTD_PRCP_NORMAL", "mtd_prcp_normal"],
}
SUMMARY_KEY_ALIASES = {
    "station_id": ["STATION_ID", "station_id"],
    "station_name": ["STATION_NAME", "station_name"],
    "norm_month": ["NORM_MONTH", "norm_month", "OBS_MONTH", "obs_month"],
    "year_num": ["YEAR_NUM", "year_num"],
    "month_num": ["MONTH_NUM", "month_num"],
}

SUMMARY_COLUMNS_ORDER = [f.name for f in MONTHLY_SUMMARY.fields]
