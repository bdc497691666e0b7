"""Star-schema load from the staging table: dimensions, fact, load report.

staging --min_by--> stations --SCD1 merge + new keys--> dim_station
staging --distinct dates + calendar attributes--> insert-ignore --> dim_date
staging --smart date key, station key lookup--> keep-latest merge --> fact

Re-running a load with the same staging changes nothing (keys are kept, merges are keyed).
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stationdw.functions.dates import date_key, month_name
from stationdw.operators.upsert import insert_ignore, upsert_dim, upsert_latest
from stationdw.schemas import FACT_KEY, MEASURES, STATION_ATTRS
from stationdw.sources.tables import materialize as write_and_read


def distinct_stations(df: DataFrame, key: str = "station_id", order_col: str = "norm_date",
                      attrs: Sequence[str] = tuple(STATION_ATTRS)) -> DataFrame:
    """One row per station; the metadata of its earliest reading wins."""
    picked = df.groupBy(key).agg(F.min_by(F.struct(*attrs), F.col(order_col)).alias("_m"))
    return picked.select(key, *[F.col("_m")[a].alias(a) for a in attrs])


def build_dim_date(df: DataFrame, date_col: str = "norm_date") -> DataFrame:
    """Distinct dates with smart key and calendar attributes."""
    d = F.col("full_date")
    return (df.select(F.col(date_col).alias("full_date")).where(d.isNotNull()).distinct()
            .select(date_key(d).alias("date_key"), d,
                    F.dayofmonth(d).alias("day_num"), F.month(d).alias("month_num"),
                    month_name(d).alias("month_name"), F.quarter(d).alias("quarter_num"),
                    F.year(d).alias("year_num")))


def resolve_keys(fact: DataFrame, dim: DataFrame, natural_key: str, surrogate_key: str,
                 check: bool = True) -> DataFrame:
    """Replace the natural key by the dimension's surrogate key.

    With ``check`` an id missing from the dimension raises ``KeyError`` (like a dict lookup).
    """
    lookup = dim.select(natural_key, surrogate_key)
    if check:
        missing = (fact.select(natural_key).distinct()
                   .join(lookup, natural_key, "left_anti").limit(1).collect())
        if missing:
            raise KeyError(missing[0][0])
    return fact.join(lookup, natural_key, "inner")


def fact_rows(staging: DataFrame, dim_station: DataFrame,
              measures: Sequence[str] = tuple(MEASURES)) -> DataFrame:
    """Fact rows for every staging row: (date_key, station_key, measures).

    A station without a key fails the load. The lookup itself raises, in the plan that writes the
    rows, so no second pass over staging is needed and no row can be lost silently.
    """
    keyed = staging.select("station_id", "norm_date", *measures).join(
        dim_station.select("station_id", "station_key"), "station_id", "left")
    miss = F.raise_error(F.concat(F.lit("no station key for "),
                                  F.coalesce("station_id", F.lit("a null station_id"))))
    return keyed.select(date_key("norm_date").alias("date_key"),
                        F.coalesce(F.col("station_key"), miss).cast("int").alias("station_key"),
                        *measures)


def load_star(staging: DataFrame, current: Mapping[str, DataFrame] | None = None,
              materialize: bool = False) -> dict[str, DataFrame]:
    """Load (or re-load) the star from staging. Returns dim_station, dim_date and fact.

    ``materialize`` writes the two dimensions as Parquet tables in the shared checkpoint folder,
    so the later joins read small files instead of re-running the lineage.
    An empty staging leaves the current tables untouched.
    """
    current = dict(current or {})
    if staging.limit(1).count() == 0:
        return current
    stations = distinct_stations(staging)
    dim_station = upsert_dim(current.get("dim_station"), stations, "station_id", "station_key")
    dim_date = insert_ignore(current.get("dim_date"), build_dim_date(staging), ["date_key"])
    if materialize:
        dim_station = write_and_read(dim_station, "dim_station")
        dim_date = write_and_read(dim_date, "dim_date")
    incoming = fact_rows(staging, dim_station).withColumn("_order", F.lit(1))
    # Staging is keyed by (station, date), so its fact rows are unique by (station_key, date_key).
    fact = upsert_latest(current.get("fact"), incoming, FACT_KEY, ["_order"],
                         incoming_unique=True)
    return {"dim_station": dim_station, "dim_date": dim_date, "fact": fact}


def load_report(staging: DataFrame, star: Mapping[str, DataFrame],
                written: DataFrame | None = None) -> DataFrame:
    """Rows per load stage as a small tall table ``(stage, row_count)``.

    Stages: staging rows read, stations and dates they carry (upserted / inserted-or-verified),
    fact rows upserted, and the sizes of the two dimension tables after the load. Staging is read
    once. ``written`` is the table of fact rows this load wrote; without it the fact itself is
    counted (a first load). Counting a written table reads Parquet footers, not rows.
    """
    read = staging.agg(F.count(F.lit(1)).alias("rows"),
                       F.count_distinct("station_id").alias("stations"),
                       F.count_distinct("norm_date").alias("dates"))
    out = read.select(F.expr("stack(3, 'staging_rows', rows, 'staging_stations', stations, "
                             "'staging_dates', dates) AS (stage, row_count)"))
    for name, table in (("fact_upserted", star["fact"] if written is None else written),
                        ("dim_station", star["dim_station"]), ("dim_date", star["dim_date"])):
        out = out.unionByName(table.agg(F.count(F.lit(1)).alias("row_count")).select(
            F.lit(name).alias("stage"), "row_count"))
    return out
