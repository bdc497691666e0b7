"""

Queries run on the driver's TPC-H-like tables through the mapping in
``stationdw/plans/bridge.py`` (nations as stations, orders as daily readings, events as the raw
JSON message topic). Every query reads whole tables. Outputs use plain types (decimals as
DOUBLE) so that Spark and the oracle agree on schema and values.
"""

from __future__ import annotations

import os
import sys
from collections.abc import Callable
from decimal import Decimal

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_HERE = os.path.dirname(os.path.abspath(__file__))
if _HERE not in sys.path:
    sys.path.insert(0, _HERE)

from stationdw.operators import checks  # noqa: E402
from stationdw.operators.aggregate import monthly_summary  # noqa: E402
from stationdw.operators.clean import clean_readings, pick_fields, split_valid  # noqa: E402
from stationdw.operators.ranking import global_rank, first_per_group  # noqa: E402
from stationdw.operators.upsert import insert_ignore, upsert_dim  # noqa: E402
from stationdw.plans import catalog, jobs, olap  # noqa: E402
from stationdw.plans.bridge import event_messages, event_readings  # noqa: E402
from stationdw.plans.output import plain_types  # noqa: E402
from stationdw.plans.star import (build_dim_date, distinct_stations, load_report,  # noqa: E402
                                  load_star)
from stationdw.plans.warehouse import event_staging, orders_warehouse  # noqa: E402
from stationdw.schemas import (COORD, DAILY_CSV_RENAME, ELEVATION, MONTHLY_SUMMARY, PRCP, RAW_MESSAGE,  # noqa: E402
                               SUMMARY_COLUMNS_ORDER, SUMMARY_KEY_ALIASES,
                               STAGING, SUMMARY_VALUE_ALIASES, TEMP)
from stationdw.session import scratch_dir  # noqa: E402
from stationdw.sources.csv_daily import read_daily_csv  # noqa: E402
from stationdw.sources.messages import parse_raw, read_raw_stream, to_raw_messages  # noqa: E402
from stationdw.sources.sinks import write_report_csv  # noqa: E402
from stationdw.sources.tables import materialize, read_table  # noqa: E402
from stationdw.streaming.jobs import (write_clean_stream, write_staging_stream,  # noqa: E402
                                      write_summary_stream)

SMOKE_DIR = "/root/testdata/sf0.001"

# Stations compared by the pair reports (nation keys of the mapping).
Q2_PAIR = ("1", "2", "n1", "n2")
Q3_STATIONS = ("3", "4")
Q4_PAIR = ("5", "6", "n5", "n6")

STAGING_OUT = ["station_id", "station_name", "elevation", "latitude", "longitude", "norm_date",
               "dly_tmin_normal", "dly_tmax_normal", "mtd_prcp_normal"]
CLEAN_OUT = ["station_id", "station_name", "elevation", "latitude", "longitude", "norm_date",
             "year_num", "month_num", "norm_month", "dly_tmin_normal", "dly_tmax_normal",
             "mtd_prcp_normal"]


# ---------------------------------------------------------------------------------------------
# Orders mapping: star schema and reports
# ---------------------------------------------------------------------------------------------

def _monthly(spark, sf):
    """Monthly view for reports filtered to a few stations (filter reaches the fact scan)."""
    return orders_warehouse(spark, sf)["monthly"]


def _monthly_all(spark, sf):
    """Monthly view for all-station reports (narrow-key rollup)."""
    return orders_warehouse(spark, sf)["monthly_all"]


def q1_monthly(spark, sf):
    return plain_types(olap.q1_monthly(_monthly_all(spark, sf)))


def q2_compare(spark, sf):
    return plain_types(olap.q2_compare(_monthly(spark, sf), *Q2_PAIR))


def q3_season(spark, sf):
    return plain_types(olap.q3_season(_monthly(spark, sf), list(Q3_STATIONS)))


def q4_gap_rank(spark, sf):
    return plain_types(olap.q4_gap_rank(_monthly(spark, sf), *Q4_PAIR))


def q5_annual_profile(spark, sf):
    return plain_types(olap.q5_annual_profile(_monthly_all(spark, sf)))


def dim_station(spark, sf):
    return plain_types(orders_warehouse(spark, sf)["star"]["dim_station"])


def dim_date(spark, sf):
    return plain_types(orders_warehouse(spark, sf)["star"]["dim_date"])


def fact_load(spark, sf):
    return plain_types(orders_warehouse(spark, sf)["star"]["fact"])


def fact_reload(spark, sf):
    """A second load of the same staging over the loaded star changes nothing."""
    wh = orders_warehouse(spark, sf)
    again = load_star(wh["staging"], wh["star"])
    return plain_types(again["fact"].join(again["dim_station"], "station_key")
                       .select("station_id", "date_key", "station_key", "dly_tmin_normal",
                               "dly_tmax_normal", "mtd_prcp_normal"))


def daily_view(spark, sf):
    return plain_types(orders_warehouse(spark, sf)["daily"])


def load_report_q(spark, sf):
    wh = orders_warehouse(spark, sf)
    return load_report(wh["staging"], wh["star"])


def check_domain_q(spark, sf):
    staging = orders_warehouse(spark, sf)["staging"]
    bad = checks.check_domain(
        staging, {"station_id": 30, "station_name": 100},
        {"elevation": ELEVATION, "latitude": COORD, "longitude": COORD,
         "dly_tmin_normal": TEMP, "dly_tmax_normal": TEMP, "mtd_prcp_normal": PRCP})
    return bad.select("station_id", "norm_date", "violations")


def check_fk_q(spark, sf):
    orders = read_table(spark, sf, "orders", ["o_orderkey", "o_custkey"])
    customer = read_table(spark, sf, "customer", ["c_custkey"])
    return checks.check_fk(orders, customer, "o_custkey", "c_custkey") \
        .select("o_orderkey", "o_custkey")


def check_fk_users(spark, sf):
    """Events whose user is no nation's key: a foreign key that many rows violate."""
    events = read_table(spark, sf, "events", ["event_id", "user_id"])
    nation = read_table(spark, sf, "nation", ["n_nationkey"])
    return checks.check_fk(events, nation, "user_id", "n_nationkey").select("event_id", "user_id")


def check_fk_star(spark, sf):
    star = orders_warehouse(spark, sf)["star"]
    bad_station = checks.check_fk(star["fact"], star["dim_station"], "station_key")
    bad_date = checks.check_fk(star["fact"], star["dim_date"], "date_key")
    return plain_types(bad_station.unionByName(bad_date))


def first_per_group_q(spark, sf):
    monthly = _monthly_all(spark, sf).select("station_id", "year_num", "month_num",
                                             "month_name", "monthly_total_precipitation_in")
    top = first_per_group(monthly, ["station_id", "year_num"],
                         [("monthly_total_precipitation_in", False), ("month_num", True)])
    return plain_types(top)


def global_rank_q(spark, sf):
    monthly = _monthly_all(spark, sf).select("station_id", "year_num", "month_num",
                                             "monthly_avg_temperature_f")
    ranked = global_rank(monthly, ["monthly_avg_temperature_f"], [False], "avg_rank",
                         distributed=True)
    return plain_types(ranked)


# ---------------------------------------------------------------------------------------------
# Events mapping: message topic, staging, stream paths
# ---------------------------------------------------------------------------------------------

def staging_upsert(spark, sf):
    """Every message upserted twice (a full replay): staging holds the latest per key."""
    st = event_staging(spark, sf, replay=2)["staging"]
    return plain_types(st.select(*STAGING_OUT))


def split_valid_ok(spark, sf):
    valid = event_staging(spark, sf)["valid"]
    return plain_types(valid.select(*STAGING_OUT, F.col("_arrival").alias("event_id")))


def split_valid_bad(spark, sf):
    rejected = event_staging(spark, sf)["rejected"]
    return rejected.select("station_id", "norm_date", "reject_reason",
                           F.col("_arrival").alias("event_id"))


def check_unique_q(spark, sf):
    valid = event_staging(spark, sf)["valid"]
    return checks.check_unique(valid, ["station_id", "norm_date"])


def check_not_null_q(spark, sf):
    decoded = event_staging(spark, sf)["decoded"]
    bad = checks.check_not_null(decoded, ["station_id", "station_name", "norm_date"])
    return bad.select("station_id", "norm_date", F.col("_arrival").alias("event_id"),
                      "null_columns")


def distinct_stations_q(spark, sf):
    st = event_staging(spark, sf)["staging"]
    return plain_types(distinct_stations(st))


def upsert_dim_q(spark, sf):
    """SCD-1 merge of the event stations into the nation station dimension."""
    current = orders_warehouse(spark, sf)["star"]["dim_station"]
    incoming = distinct_stations(event_staging(spark, sf)["staging"])
    return plain_types(upsert_dim(current, incoming, "station_id", "station_key"))


def insert_ignore_q(spark, sf):
    """Dates of both mappings inserted into the loaded date dimension; existing rows win."""
    current = orders_warehouse(spark, sf)["star"]["dim_date"]
    incoming = build_dim_date(
        event_staging(spark, sf)["staging"].select("norm_date")
        .unionByName(orders_warehouse(spark, sf)["staging"].select("norm_date")))
    return insert_ignore(current, incoming, ["date_key"])


def clean_readings_q(spark, sf):
    clean = clean_readings(parse_raw(event_messages(spark, sf)))
    return clean.select(*CLEAN_OUT, F.col("_arrival").alias("event_id"))


def q6_monthly_summary(spark, sf):
    return monthly_summary(clean_readings(parse_raw(event_messages(spark, sf))))


def pick_fields_q(spark, sf):
    """Keyed summary messages (upper-case names, value copies) read back by alias lists."""
    summary = monthly_summary(clean_readings(parse_raw(event_messages(spark, sf))))
    opts = {"ignoreNullFields": "false"}
    keyed = summary.select(
        F.to_json(F.struct(*[F.col(c).alias(c.upper()) for c in
                             ["station_id", "station_name", "norm_month", "year_num",
                              "month_num"]]), opts).alias("key"),
        F.to_json(F.struct(
            *[F.col(c).alias(c.upper() + "_V") for c in
              ["station_id", "station_name", "norm_month", "year_num", "month_num"]],
            *[F.col(c).alias(c.upper()) for c in
              ["num_days", "avg_dly_tmin_normal", "avg_dly_tmax_normal",
               "month_end_prcp_normal"]]), opts).alias("value"))
    picked = pick_fields(keyed, SUMMARY_VALUE_ALIASES, SUMMARY_KEY_ALIASES)
    valid, _ = split_valid(picked.where(~F.col("tombstone")),
                           ["station_id", "station_name", "norm_month", "year_num",
                            "month_num"])
    typed = valid.select(
        "station_id", "station_name", "norm_month",
        F.col("year_num").cast("int").alias("year_num"),
        F.col("month_num").cast("int").alias("month_num"),
        F.col("num_days").cast("int").alias("num_days"),
        F.col("avg_dly_tmin_normal").cast(TEMP).alias("avg_dly_tmin_normal"),
        F.col("avg_dly_tmax_normal").cast(TEMP).alias("avg_dly_tmax_normal"),
        F.col("month_end_prcp_normal").cast(PRCP).alias("month_end_prcp_normal"))
    return plain_types(typed)


def summary_rejected(spark, sf):
    """Summary messages of four kinds, by station id: blank and JSON null values (skipped), no
    station name in value or key (rejected), and whole ones (accepted, reason null)."""
    summary = monthly_summary(clean_readings(parse_raw(event_messages(spark, sf))))
    kind = F.col("station_id").cast("int") % 4
    name = F.when(kind != 2, F.col("station_name"))
    opts = {"ignoreNullFields": "false"}
    keys = [F.col("station_id").alias("STATION_ID"), name.alias("STATION_NAME"),
            F.col("norm_month").alias("NORM_MONTH")]
    value = F.to_json(F.struct(*keys, F.col("year_num").alias("YEAR_NUM"),
                               F.col("month_num").alias("MONTH_NUM"),
                               F.col("num_days").alias("NUM_DAYS")), opts)
    messages = summary.select(
        F.to_json(F.struct(*keys), opts).alias("key"),
        F.when(kind == 0, " ").when(kind == 1, "null").otherwise(value).alias("value"))
    rows, rejected = jobs.summary_from_changelog(messages)
    return (rows.withColumn("reject_reason", F.lit(None).cast("string"))
            .select("station_id", "norm_month", "reject_reason")
            .unionByName(rejected.select("station_id", "norm_month", "reject_reason")))


def month_slice(spark, sf):
    """The event staging table loaded into a warehouse; the fact rows of its latest month, read
    from that month's files alone."""
    table, warehouse = scratch_dir(spark, "month-staging"), scratch_dir(spark, "month-warehouse")
    (event_staging(spark, sf)["staging"].withColumn("created_at", F.current_timestamp())
     .withColumn("norm_month", F.date_format("norm_date", "yyyyMM"))
     .write.partitionBy("norm_month").parquet(table))
    jobs.load_warehouse(spark, table, warehouse)
    month = jobs.latest_fact_month(spark, warehouse)
    fact = jobs.read_fact_months(spark, warehouse, month, month)
    return plain_types(fact.join(jobs.read_star(spark, warehouse)["dim_station"], "station_key")
                       .select("station_id", "date_key", "dly_tmin_normal", "dly_tmax_normal",
                               "mtd_prcp_normal"))


def _staging_table(spark, staging):
    """A staging frame as the staging table that a load reads."""
    table = scratch_dir(spark, "staging-table")
    types = {f.name: f.dataType for f in STAGING.fields}
    (staging.select(*[F.col(c).cast(types[c]).alias(c) for c in STAGING_OUT])
     .withColumn("created_at", F.current_timestamp())
     .withColumn("norm_month", F.date_format("norm_date", "yyyyMM"))
     .write.partitionBy("norm_month").parquet(table))
    return table


def read_csv(spark, sf):
    """The orders mapping's readings as header CSV files in two column orders, one without the
    elevation, names with commas, quotes and line breaks, padded numbers; read back by name."""
    rows = orders_warehouse(spark, sf)["staging"]
    name = F.concat("station_name", F.lit(',\n"'), "station_id", F.lit('"'))
    texts = {"station_name": name, "norm_date": F.date_format("norm_date", "yyyyMMdd"),
             "dly_tmin_normal": F.concat(F.lit(" "), F.col("dly_tmin_normal").cast("string"))}
    columns = [texts.get(new, F.col(new).cast("string")).alias(old)
               for old, new in DAILY_CSV_RENAME.items()]
    folder = scratch_dir(spark, "csv")
    even = F.dayofmonth("norm_date") % 2 == 0
    for part, order in ((rows.where(even), columns),
                        (rows.where(~even), [c for c, new in zip(
                            columns[::-1], list(DAILY_CSV_RENAME.values())[::-1])
                            if new != "elevation"])):
        part.select(*order).write.mode("append").csv(
            folder, header=True, quote='"', escape='"', ignoreLeadingWhiteSpace=False,
            ignoreTrailingWhiteSpace=False)
    return read_daily_csv(spark, folder)


def shared_views(spark, sf):
    """The orders loaded into the tables of a database; its monthly view, read by name in another
    session of the catalog."""
    base, database = scratch_dir(spark, "views").rsplit("/", 1)
    database = database.replace("-", "_")
    locations = catalog.ensure_tables(spark, database, base)
    tenth = F.lit(Decimal("0.1"))  # order totals pass the largest reading
    jobs.load_warehouse(spark, _staging_table(spark, orders_warehouse(spark, sf)["staging"].withColumns(
        {c: F.col(c) * tenth for c in ("dly_tmin_normal", "dly_tmax_normal")})),
        locations["dim_date"].rsplit("/", 1)[0])
    catalog.create_views(spark, database)
    catalog.refresh_tables(spark, database)
    other = spark.newSession()
    catalog.use_database(other, database)
    return plain_types(other.table("vw_monthly_climate_imperial"))


def report_csv(spark, sf):
    """The first report written as header CSV files and read back."""
    report = q1_monthly(spark, sf)
    folder = scratch_dir(spark, "report-csv")
    write_report_csv(report, folder)
    return spark.read.schema(report.schema).csv(folder, header=True)


def created_at_kept(spark, sf):
    """The event topic consumed into staging, then again from its start by a new consumer: whether
    each row still has the time of its first insert."""
    topic, table = _event_topic(spark, sf), scratch_dir(spark, "staging")
    stored = []
    for _ in range(2):
        _consume(spark, topic, table, batches=None).awaitTermination()
        stored.append(materialize(spark.read.parquet(table).select(
            "station_id", "norm_date", "created_at"), "created-at"))
    first, second = stored
    return second.join(first.withColumnRenamed("created_at", "inserted_at"),
                       ["station_id", "norm_date"], "left").select(
        "station_id", "norm_date",
        F.coalesce(F.col("created_at") == F.col("inserted_at"), F.lit(False)).alias("kept"))


def load_after_crash(spark, sf):
    """The orders loaded; a load of the events that ends when it is committed, before it replaces
    any table; then the orders again. The warehouse has both, each fact row with its station."""
    warehouse = scratch_dir(spark, "crash-warehouse")
    tenth = F.lit(Decimal("0.1"))  # order totals pass the largest reading
    orders = _staging_table(spark, orders_warehouse(spark, sf)["staging"].withColumns(
        {c: F.col(c) * tenth for c in ("dly_tmin_normal", "dly_tmax_normal")}))
    jobs.load_warehouse(spark, orders, warehouse)
    jobs.prepare_load(spark, _staging_table(spark, event_staging(spark, sf)["staging"]), warehouse)
    jobs.load_warehouse(spark, orders, warehouse)
    star = jobs.read_star(spark, warehouse)
    return plain_types(star["fact"].join(star["dim_station"], "station_key")
                       .join(star["dim_date"], "date_key")
                       .select("station_id", "date_key", "month_name", "dly_tmin_normal",
                               "dly_tmax_normal", "mtd_prcp_normal"))


def _event_topic(spark, sf):
    """The event messages written as a file topic, dealt round-robin: messages of one staging
    row lie in several files, so later micro-batches hold older and newer ones of stored keys."""
    topic = scratch_dir(spark, "topic")
    fields = [f.name for f in RAW_MESSAGE.fields] + ["event_order"]
    files = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = event_readings(spark, sf).withColumn("event_order", F.col("_arrival"))
    messages = to_raw_messages(rows.repartition(files), fields)
    messages.select("value").write.text(topic)
    return topic


def _topic_stream(spark, topic, batches=4):
    """A file topic as a stream of about four micro-batches (one if ``batches`` is None)."""
    options = {"path": topic, "arrival_field": "event_order"}
    if batches:
        files = int(spark.conf.get("spark.sql.shuffle.partitions"))
        options["maxFilesPerTrigger"] = max(1, files // batches)
    return read_raw_stream(spark, "files", options)


def _event_stream(spark, sf):
    """The events table as a file stream (a single-file table is picked by a name filter)."""
    path = f"{sf.rstrip('/')}/events.parquet"
    schema = spark.read.parquet(path).schema
    reader = spark.readStream.schema(schema)
    if os.path.isfile(path):
        events = reader.option("pathGlobFilter", "events.parquet").parquet(sf.rstrip("/"))
    else:
        events = reader.parquet(path)
    return event_messages(spark, sf, events)


def stream_monthly(spark, sf):
    """Continuous monthly summary (update mode + foreachBatch upsert) over several micro-batches,
    each of which updates months of the ones before."""
    table = scratch_dir(spark, "summary")
    q = write_summary_stream(_topic_stream(spark, _event_topic(spark, sf)), table,
                             scratch_dir(spark, "summary-ck"), available_now=True)
    q.awaitTermination()
    return plain_types(spark.read.schema(MONTHLY_SUMMARY).parquet(table)
                       .select(*SUMMARY_COLUMNS_ORDER))


def stream_changelog(spark, sf):
    """Monthly aggregate emitted as a keyed JSON changelog, then loaded back into the summary
    table by alias picking (value first, key fallback) with later messages winning."""
    from stationdw.sources.sinks import write_changelog_stream
    topic = _topic_stream(spark, _event_topic(spark, sf))
    summary = monthly_summary(clean_readings(parse_raw(topic)), arrival="_arrival")
    changelog = scratch_dir(spark, "changelog")
    q = write_changelog_stream(summary, ["station_id", "station_name", "norm_month",
                                         "year_num", "month_num"],
                               scratch_dir(spark, "changelog-ck"), target=changelog)
    q.processAllAvailable()
    q.stop()
    table = scratch_dir(spark, "summary-from-changelog")
    jobs.load_summary_changelog(spark, changelog, table,
                                scratch_dir(spark, "load-ck")).awaitTermination()
    return plain_types(spark.read.schema(MONTHLY_SUMMARY).parquet(table)
                       .select(*SUMMARY_COLUMNS_ORDER))


def stream_clean(spark, sf):
    out = scratch_dir(spark, "clean")
    q = write_clean_stream(_event_stream(spark, sf), out, scratch_dir(spark, "clean-ck"),
                           available_now=True)
    q.awaitTermination()
    return spark.read.parquet(out).select(*CLEAN_OUT, F.col("_arrival").alias("event_id"))


def watch_latest(spark, sf):
    """Continuous query over the cleaned readings, watched as a bucketed table of the latest reading
    per station and month."""
    from stationdw.sources.sinks import watch
    clean = clean_readings(parse_raw(_topic_stream(spark, _event_topic(spark, sf))))
    q = watch(clean, "latest_readings", keys=["station_id", "norm_month"], buckets=16,
              available_now=True)
    q.awaitTermination()
    return spark.table("latest_readings").select(*CLEAN_OUT, F.col("_arrival").alias("event_id"))


def stream_staging(spark, sf):
    """Staging consumer stream: keyed keep-latest upsert per micro-batch, quarantine aside."""
    table = scratch_dir(spark, "staging")
    _consume(spark, _event_topic(spark, sf), table).awaitTermination()
    return plain_types(spark.read.parquet(table).select(*STAGING_OUT))  # no partition in output


def _consume(spark, topic, table, batches=4):
    return write_staging_stream(_topic_stream(spark, topic, batches), table,
                                scratch_dir(spark, "quarantine"),
                                scratch_dir(spark, "staging-ck"), available_now=True)


def stream_replay(spark, sf):
    """A topic consumed, then consumed again from its start by a consumer with a new checkpoint:
    the table is as it was."""
    topic, table = _event_topic(spark, sf), scratch_dir(spark, "staging")
    for _ in range(2):
        _consume(spark, topic, table).awaitTermination()
    return plain_types(spark.read.parquet(table).select(*STAGING_OUT))


def stream_two_subscribers(spark, sf):
    """Two streams over one topic at the same time, each with its own checkpoint; what each has
    stored, by month."""
    topic = _event_topic(spark, sf)
    staging, summary = scratch_dir(spark, "staging"), scratch_dir(spark, "summary")
    running = [_consume(spark, topic, staging),
               write_summary_stream(_topic_stream(spark, topic), summary,
                                    scratch_dir(spark, "summary-ck"), available_now=True)]
    for q in running:
        q.awaitTermination()
    stored = (spark.read.parquet(staging)
              .groupBy(F.date_format("norm_date", "yyyyMM").alias("norm_month"))
              .agg(F.count(F.lit(1)).alias("readings")))
    days = (jobs.read_summary(spark, summary).groupBy("norm_month")
            .agg(F.sum("num_days").alias("readings")))
    return (stored.withColumn("subscriber", F.lit("staging"))
            .unionByName(days.withColumn("subscriber", F.lit("summary"))))


# ---------------------------------------------------------------------------------------------

def _training_data() -> tuple[dict[str, Callable[[SparkSession, str], DataFrame]], dict[str, str]]:
    """Queries and SQL of the training-data operators, if that subpackage is there."""
    try:
        import corpus_pipeline
        from stationdw.llm.queries import ORACLE_SQL, QUERIES
    except ImportError:  # the subpackage, or a library that only it needs, is not there
        return {}, {}
    sql = dict(ORACLE_SQL)
    if corpus_pipeline.ORACLE_SQL:
        sql["pipeline"] = corpus_pipeline.ORACLE_SQL
    return {**QUERIES, "pipeline": corpus_pipeline.run}, sql


def entry(spark: SparkSession) -> DataFrame:
    """Flagship: monthly station summary over the star loaded from sf0.001."""
    return q1_monthly(spark, SMOKE_DIR)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "q1_monthly": q1_monthly,
        "q2_compare": q2_compare,
        "q3_season": q3_season,
        "q4_gap_rank": q4_gap_rank,
        "q5_annual_profile": q5_annual_profile,
        "q6_monthly_summary": q6_monthly_summary,
        "dim_station": dim_station,
        "dim_date": dim_date,
        "fact_load": fact_load,
        "fact_reload": fact_reload,
        "daily_view": daily_view,
        "load_report": load_report_q,
        "check_domain": check_domain_q,
        "check_fk": check_fk_q,
        "check_fk_star": check_fk_star,
        "check_fk_users": check_fk_users,
        "summary_rejected": summary_rejected,
        "month_slice": month_slice,
        "load_after_crash": load_after_crash,
        "shared_views": shared_views,
        "report_csv": report_csv,
        "created_at_kept": created_at_kept,
        "read_csv": read_csv,
        "first_per_group": first_per_group_q,
        "global_rank": global_rank_q,
        "staging_upsert": staging_upsert,
        "split_valid_ok": split_valid_ok,
        "split_valid_bad": split_valid_bad,
        "check_unique": check_unique_q,
        "check_not_null": check_not_null_q,
        "distinct_stations": distinct_stations_q,
        "upsert_dim": upsert_dim_q,
        "insert_ignore": insert_ignore_q,
        "clean_readings": clean_readings_q,
        "pick_fields": pick_fields_q,
        "stream_clean": stream_clean,
        "stream_monthly": stream_monthly,
        "stream_staging": stream_staging,
        "stream_changelog": stream_changelog,
        "stream_replay": stream_replay,
        "stream_two_subscribers": stream_two_subscribers,
        "watch_latest": watch_latest,
        **_training_data()[0],
    }


def oracle_sql() -> dict[str, str]:
    from oracle_queries import ORACLE_SQL
    return {**ORACLE_SQL, **_training_data()[1]}
