"""End-to-end jobs: the user-facing steps of the warehouse, each a Spark job or stream.

publish_daily_csv      header CSV -> JSON message topic (files or Kafka)
consume_to_staging     message topic -> staging table (keep-latest upsert) + quarantine
load_warehouse         staging table -> star tables (dimensions merged, fact merged by month)
summary_changelog      message topic -> continuous monthly aggregate as a keyed changelog
load_summary_changelog keyed changelog topic -> monthly summary table (later message wins)
monthly_summary_table  message topic -> monthly summary table directly (one stream)
reports                star tables -> the five reports

Tables live at explicit paths (the shared warehouse folder); every write is keyed and
idempotent, so any step can be re-run after a failure.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.utils import AnalysisException

from stationdw.operators.aggregate import monthly_summary
from stationdw.operators.checks import ConstraintViolation, require_unique
from stationdw.operators.clean import pick_fields, split_valid
from stationdw.operators.upsert import merge_into_path, merge_stages, merged_months, swap_in
from stationdw.plans import commit, olap
from stationdw.plans.star import load_report, load_star
from stationdw.plans.views import daily_view, monthly_climate, monthly_from_star
from stationdw.schemas import (DIM_DATE, DIM_STATION, FACT, FACT_KEY, LENGTH_LIMITS,
                               MONTHLY_SUMMARY, NOT_NULL, PRCP, STAGING, SUMMARY_GROUP,
                               SUMMARY_KEY, SUMMARY_KEY_ALIASES, SUMMARY_VALUE_ALIASES, TEMP)
from stationdw.sources.csv_daily import read_daily_csv
from stationdw.sources.messages import read_raw_stream
from stationdw.sources.sinks import (epoch_folder, reported, write_changelog_stream,
                                     write_messages)
from stationdw.sources.tables import materialize
from stationdw.streaming.jobs import clean_stream, write_staging_stream, write_summary_stream

STAGING_COLUMNS = [f.name for f in STAGING.fields if f.name != "created_at"]
# The stored fact carries its month (a function of the date key) as partition column.
FACT_STORED = T.StructType(FACT.fields + [T.StructField("date_month", T.IntegerType())])
# UNIQUE and NOT NULL columns of the dimensions.
DIMENSION_KEYS = {"dim_station": ["station_key", "station_id"], "dim_date": ["date_key", "full_date"]}
# What the last load of a month brought.
DIGESTS = T.StructType([T.StructField("date_month", T.IntegerType()),
                        T.StructField("n", T.LongType()), T.StructField("x1", T.LongType()),
                        T.StructField("x2", T.LongType())])


def _read(spark: SparkSession, path: str, schema) -> DataFrame | None:
    try:
        df = spark.read.schema(schema).parquet(path)
        df.columns  # noqa: B018
        return df
    except AnalysisException:
        return None


def publish_daily_csv(spark: SparkSession, csv_path: str, target: str, sink: str = "files",
                      options: dict | None = None) -> int:
    """Producer: every CSV row becomes one JSON message. Returns the number sent."""
    sent = Observation("published")
    rows = read_daily_csv(spark, csv_path).observe(sent, F.count(F.lit(1)).alias("n"))
    write_messages(rows, target, sink, options)
    return sent.get["n"]


def consume_to_staging(spark: SparkSession, source: str, options: dict, staging_path: str,
                       quarantine_path: str, checkpoint: str, available_now: bool = True
                       ) -> StreamingQuery:
    """Consumer: raw topic -> staging (last arrival wins per station and day) + quarantine."""
    raw = read_raw_stream(spark, source, options)
    return write_staging_stream(raw, staging_path, quarantine_path, checkpoint,
                                available_now=available_now)


def read_staging(spark: SparkSession, staging_path: str) -> DataFrame:
    """Full staging read (9 columns); order does not matter to any consumer."""
    schema = T.StructType(STAGING.fields + [T.StructField("norm_month", T.StringType())])
    return spark.read.schema(schema).parquet(staging_path).select(*STAGING_COLUMNS)


def star_paths(warehouse: str) -> dict[str, str]:
    """Locations of the star tables under ``warehouse`` (a folder or a catalog's table root)."""
    base = warehouse.rstrip("/")
    return {"dim_station": f"{base}/dim_station", "dim_date": f"{base}/dim_date",
            "fact": f"{base}/fact_daily_climate_normal",
            "fact_digests": f"{base}/_fact_digests"}


def _digest(df: DataFrame, by: list[str] | None = None) -> DataFrame:
    """Row count and two 64-bit digests of all rows, in any order, per value of ``by``."""
    cols = sorted(df.columns)
    return df.groupBy(*(by or [])).agg(
        F.count(F.lit(1)).alias("n"), F.bit_xor(F.xxhash64(*cols)).alias("x1"),
        F.bit_xor(F.xxhash64(F.lit(1), *reversed(cols))).alias("x2"))


def _replacements(spark: SparkSession, warehouse: str) -> dict:
    """How each star table takes over its rows from a load's journal."""
    paths = star_paths(warehouse)

    def whole(path, schema):
        return lambda logged: spark.read.schema(schema).parquet(logged).write.mode(
            "overwrite").parquet(path)

    return {"dim_station": whole(paths["dim_station"], DIM_STATION),
            "dim_date": whole(paths["dim_date"], DIM_DATE),
            "fact": lambda logged: swap_in(spark, logged, FACT_STORED, paths["fact"],
                                           "date_month"),
            "fact_digests": whole(paths["fact_digests"], DIGESTS)}


def recover_warehouse(spark: SparkSession, warehouse: str) -> bool:
    """Finish or drop what a load that ended early has left; True if it was finished."""
    return commit.recover(spark, warehouse, _replacements(spark, warehouse))


def prepare_load(spark: SparkSession, staging_path: str, warehouse: str
                 ) -> tuple[DataFrame, dict[str, DataFrame], DataFrame] | None:
    """Write to the journal what a load changes, and commit it, without touching a table.

    Returns staging, the dimensions and the fact rows of the load; None if staging is empty. A
    dimension is written if its rows change, the fact for those months alone whose incoming rows
    differ from what the last load of the month brought (one digest a month is kept beside the
    fact): merging equal rows again changes nothing, so such months are neither read nor written.
    What is to be written must keep the tables' keys unique and not null; else the load raises
    ``ConstraintViolation`` before its journal is committed, and the tables stay as they were.
    """
    paths = star_paths(warehouse)
    current = {"dim_station": _read(spark, paths["dim_station"], DIM_STATION),
               "dim_date": _read(spark, paths["dim_date"], DIM_DATE)}
    current = {k: v for k, v in current.items() if v is not None}
    staging = read_staging(spark, staging_path)
    star = load_star(staging, current, materialize=True)
    if not star or "fact" not in star:
        return None
    # written once: digests, merge and report look at it
    incoming = materialize(star["fact"].withColumn(
        "date_month", (F.col("date_key") / 100).cast("int")), "fact-incoming")
    digests = materialize(_digest(incoming, ["date_month"]), "fact-digests")
    known = _read(spark, paths["fact_digests"], DIGESTS)
    changed = digests
    if known is not None:
        changed = digests.join(known, DIGESTS.names, "left_anti")
        digests = known.join(digests, "date_month", "left_anti").unionByName(digests)
    changed = materialize(changed.select("date_month"), "changed-months")
    if not changed.where(F.col("date_month").isNull()).isEmpty():
        raise ConstraintViolation("climate_normal_daily_raw: null in key norm_date")
    logged = False
    for name in ("dim_station", "dim_date"):
        columns = star[name].columns
        for key in DIMENSION_KEYS[name]:
            require_unique(star[name], [key], name)
        if name not in current or _digest(current[name].select(*columns)).first() \
                != _digest(star[name]).first():
            commit.log(star[name], warehouse, name)
            logged = True
    if not changed.isEmpty():
        rows = incoming.join(changed, "date_month", "left_semi").withColumn("_order", F.lit(1))
        require_unique(rows, FACT_KEY, "fact_daily_climate_normal")
        commit.log(merged_months(rows, paths["fact"], FACT_KEY, ["_order"], "date_month",
                                 incoming_unique=True),
                   warehouse, "fact", "date_month")
        commit.log(digests, warehouse, "fact_digests")
        logged = True
    if logged:
        commit.commit(spark, warehouse)
    return staging, star, incoming


def load_warehouse(spark: SparkSession, staging_path: str, warehouse: str) -> DataFrame:
    """Load dimensions and fact from staging into ``warehouse`` and return the load report.

    Dimensions are small and replaced as a whole (keys kept); the fact is merged keyed by
    (station_key, date_key), for the months that changed. All tables change together: a load that
    ends anywhere leaves a journal that the next one finishes or drops (``plans.commit``).
    """
    recover_warehouse(spark, warehouse)
    prepared = prepare_load(spark, staging_path, warehouse)
    if prepared is None:
        return spark.createDataFrame([], "stage string, row_count bigint")
    recover_warehouse(spark, warehouse)
    staging, star, incoming = prepared
    return load_report(staging, star, incoming)


def read_star(spark: SparkSession, warehouse: str) -> dict[str, DataFrame]:
    paths = star_paths(warehouse)
    return {
        "dim_station": spark.read.schema(DIM_STATION).parquet(paths["dim_station"]),
        "dim_date": spark.read.schema(DIM_DATE).parquet(paths["dim_date"]),
        "fact": spark.read.schema(FACT_STORED).parquet(paths["fact"]).drop("date_month"),
    }


def latest_fact_month(spark: SparkSession, warehouse: str) -> int:
    """The greatest month (yyyyMM) of the stored fact; no other column is read."""
    fact = spark.read.schema(FACT_STORED).parquet(star_paths(warehouse)["fact"])
    return fact.agg(F.max("date_month")).first()[0]


def read_fact_months(spark: SparkSession, warehouse: str, first: int, last: int) -> DataFrame:
    """Fact rows of the months ``first`` to ``last`` (yyyyMM); other months' files are not read."""
    fact = spark.read.schema(FACT_STORED).parquet(star_paths(warehouse)["fact"])
    return fact.where(F.col("date_month").between(first, last)).drop("date_month")


def summary_changelog(spark: SparkSession, source: str, options: dict, target: str,
                      checkpoint: str, sink: str = "files", sink_options: dict | None = None
                      ) -> StreamingQuery:
    """Continuous monthly aggregate of the raw topic, emitted as a keyed JSON changelog."""
    summary = monthly_summary(clean_stream(read_raw_stream(spark, source, options)),
                              arrival="_arrival")
    return write_changelog_stream(summary, SUMMARY_GROUP, checkpoint, sink, target,
                                  sink_options)


def summary_from_changelog(msgs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Keyed changelog messages -> (summary rows with an ``_order``, rejected rows).

    Tombstones are skipped, fields are picked by alias (value first, key as fallback), rows
    missing any of the five month keys, or with a key too long for its column, are rejected.
    """
    picked = pick_fields(msgs, SUMMARY_VALUE_ALIASES, SUMMARY_KEY_ALIASES)
    valid, rejected = split_valid(picked.where(~F.col("tombstone")), NOT_NULL["monthly_summary"],
                                  limits=LENGTH_LIMITS["monthly_summary"])
    typed = valid.select(
        "station_id", "station_name", "norm_month",
        F.col("year_num").cast("double").cast("int").alias("year_num"),
        F.col("month_num").cast("double").cast("int").alias("month_num"),
        F.col("num_days").cast("double").cast("int").alias("num_days"),
        F.col("avg_dly_tmin_normal").cast(TEMP).alias("avg_dly_tmin_normal"),
        F.col("avg_dly_tmax_normal").cast(TEMP).alias("avg_dly_tmax_normal"),
        F.col("month_end_prcp_normal").cast(PRCP).alias("month_end_prcp_normal"),
        *[c for c in msgs.columns if c.startswith("_")])
    return typed, rejected


def load_summary_changelog(spark: SparkSession, changelog: str, table_path: str,
                           checkpoint: str, available_now: bool = True,
                           rejects_path: str | None = None, source: str = "files",
                           options: dict | None = None) -> StreamingQuery:
    """Summary loader: keyed changelog -> monthly summary table, keyed (station_id, norm_month),
    later message wins.

    ``files``: a folder of JSON lines with ``key``/``value``/``_epoch`` and, where two groups of one
    month can be in an epoch, ``_arrival``. ``kafka``: topic
    ``changelog`` with ``options`` such as the bootstrap servers, in the topic's own order.
    Messages without one of the five month keys go with their reason to ``rejects_path`` (by
    default ``<table_path>_rejected``), one folder of JSON lines per micro-batch."""
    rejects = rejects_path or table_path.rstrip("/") + "_rejected"
    if source == "files":
        order = ["_epoch", "_arrival"]
        # an arrival is a number or, from Kafka, an object of fixed-width parts: text either way
        msgs = (spark.readStream.schema("key string, value string, _epoch long, _arrival string")
                .option("recursiveFileLookup", "true").options(**(options or {})).json(changelog))
    else:
        order = ["_arrival"]
        msgs = read_raw_stream(spark, source, {"subscribe": changelog, **(options or {})})

    def upsert(batch: DataFrame, epoch_id: int) -> None:
        rows, rejected = summary_from_changelog(batch)
        # Arrival order: the loader's batch first (a restarted producer begins its epochs at 0
        # again), then the producer's epoch within one batch.
        parts = [F.col(c) for c in order]
        if source == "files":  # by value if it is a number
            parts.insert(1, F.expr("try_cast(_arrival AS DECIMAL(38, 0))").alias("_number"))
        rows = rows.withColumn("_order", F.struct(F.lit(epoch_id).alias("batch"), *parts))
        merge_into_path(rows.drop(*order), table_path, SUMMARY_KEY, ["_order"],
                        "norm_month", stages=merge_stages(checkpoint), epoch=epoch_id)
        rejected.write.mode("overwrite").json(epoch_folder(rejects, checkpoint, epoch_id))

    writer = reported(msgs.writeStream.option("checkpointLocation", checkpoint)
                      .foreachBatch(upsert), spark, checkpoint)
    return (writer.trigger(availableNow=True) if available_now else writer).start()


def monthly_summary_table(spark: SparkSession, source: str, options: dict, table_path: str,
                          checkpoint: str, available_now: bool = True) -> StreamingQuery:
    """One stream from the raw topic straight into the monthly summary table."""
    raw = read_raw_stream(spark, source, options)
    return write_summary_stream(raw, table_path, checkpoint, available_now=available_now)


def read_summary(spark: SparkSession, table_path: str) -> DataFrame:
    return spark.read.schema(MONTHLY_SUMMARY).parquet(table_path)


def reports(star: dict[str, DataFrame], pair_a: tuple[str, str, str, str],
            season_ids: list[str], pair_b: tuple[str, str, str, str]) -> dict[str, DataFrame]:
    """The five reports over a loaded star.

    All-station reports roll up on narrow keys; the station-filtered ones use the rollup over
    the daily view, where their station filter is pushed to the fact rows.

    ``pair_a`` = (left id, right id, left label, right label) for the side-by-side report,
    ``season_ids`` for the season report, ``pair_b`` = (first, second, labels) for the gap rank.
    """
    every = monthly_from_star(star["fact"], star["dim_date"], star["dim_station"])
    few = monthly_climate(daily_view(star["fact"], star["dim_date"], star["dim_station"]))
    return {
        "query1": olap.q1_monthly(every),
        "query2": olap.q2_compare(few, *pair_a),
        "query3": olap.q3_season(few, season_ids),
        "query4": olap.q4_gap_rank(few, *pair_b),
        "query5": olap.q5_annual_profile(every),
    }
