"""Structured Streaming: stream = batch, replay, staging consumer, two subscribers, changelog."""

import json
import os

import pytest
from pyspark.sql import functions as F

from stationdw.operators.aggregate import monthly_summary
from stationdw.operators.clean import pick_fields
from stationdw.schemas import MONTHLY_SUMMARY, SUMMARY_KEY_ALIASES, SUMMARY_VALUE_ALIASES
from stationdw.session import scratch_dir
from stationdw.sources.csv_daily import read_daily_csv
from stationdw.sources.messages import read_raw_stream, to_raw_messages
from stationdw.sources.sinks import write_changelog_stream, watch
from stationdw.streaming.jobs import (clean_stream, summary_rows, write_staging_stream,
                                      write_summary_stream)
from tests.conftest import DATA


def sample_messages(spark):
    """The sample station's 365 readings as JSON messages with an arrival number."""
    df = read_daily_csv(spark, os.path.join(DATA, "NORMAL_DLY_sample_csv.csv"))
    rows = [json.loads(r.value) for r in to_raw_messages(df).collect()]
    for i, r in enumerate(rows):
        r["_arrival"] = i
    return rows


def write_files(folder, rows, parts):
    os.makedirs(folder, exist_ok=True)
    size = (len(rows) + parts - 1) // parts
    existing = len(os.listdir(folder))
    for p in range(parts):
        chunk = rows[p * size:(p + 1) * size]
        with open(os.path.join(folder, f"part-{existing + p:04d}.json"), "w") as f:
            f.write("\n".join(json.dumps(r) for r in chunk) + "\n")


def run_to_end(query):
    query.awaitTermination()
    assert query.exception() is None


def summary_table(spark, path):
    return spark.read.schema(MONTHLY_SUMMARY).parquet(path)


def batch_summary(spark, folder):
    raw = spark.read.text(folder)
    return summary_rows(monthly_summary(clean_stream(raw)))


def table_rows(df):
    return sorted(tuple(r[c] for c in sorted(df.columns)) for r in df.collect())


@pytest.fixture()
def topic(tmp_path, spark):
    folder = str(tmp_path / "topic")
    write_files(folder, sample_messages(spark), parts=5)
    return folder


def stream(spark, folder):
    return read_raw_stream(spark, "files", {"path": folder, "maxFilesPerTrigger": 1,
                                            "arrival_field": "_arrival"})


def test_summary_stream_equals_batch(spark, topic):
    table = scratch_dir(spark, "t-summary")
    run_to_end(write_summary_stream(stream(spark, topic), table, scratch_dir(spark, "ck"),
                                    available_now=True))
    got = summary_table(spark, table)
    assert got.count() == 12
    assert table_rows(got) == table_rows(batch_summary(spark, topic))
    jan = got.where("norm_month = '201001'").first()
    assert jan.num_days == 31 and float(jan.month_end_prcp_normal) == 55.0


def test_replayed_file_doubles_counts_unless_deduplicated(spark, topic):
    rows = sample_messages(spark)
    plain, dedup = scratch_dir(spark, "t-plain"), scratch_dir(spark, "t-dedup")
    ck1, ck2 = scratch_dir(spark, "ck1"), scratch_dir(spark, "ck2")
    run_to_end(write_summary_stream(stream(spark, topic), plain, ck1, available_now=True))
    run_to_end(write_summary_stream(stream(spark, topic), dedup, ck2, available_now=True,
                                    dedupe_keys=["station_id", "norm_date"]))
    write_files(topic, rows, parts=2)                       # the same file sent again
    run_to_end(write_summary_stream(stream(spark, topic), plain, ck1, available_now=True))
    run_to_end(write_summary_stream(stream(spark, topic), dedup, ck2, available_now=True,
                                    dedupe_keys=["station_id", "norm_date"]))
    jan = "norm_month = '201001'"
    assert summary_table(spark, plain).where(jan).first().num_days == 62
    assert summary_table(spark, dedup).where(jan).first().num_days == 31


def test_staging_stream_latest_wins_and_quarantine(spark, tmp_path):
    folder = str(tmp_path / "topic")
    good = {"station_id": "S", "station_name": "old", "norm_date": "20100101",
            "dly_tmin_normal": 1, "_arrival": 1}
    write_files(folder, [good, {"station_id": "S", "norm_date": "20100102", "_arrival": 2}], 1)
    write_files(folder, [dict(good, station_name="new", dly_tmin_normal=2, _arrival=3)], 1)
    with open(os.path.join(folder, "part-9999.json"), "w") as f:
        f.write("[1,2]\n")
    table, quarantine = scratch_dir(spark, "t-st"), scratch_dir(spark, "t-q")
    run_to_end(write_staging_stream(stream(spark, folder), table, quarantine,
                                    scratch_dir(spark, "ck"), available_now=True))
    st = spark.read.parquet(table).collect()
    assert [(r.station_name, float(r.dly_tmin_normal)) for r in st] == [("new", 2.0)]
    reasons = sorted(r.reject_reason for r in spark.read.parquet(quarantine).collect())
    assert reasons == ["missing station_name", "not an object"]


def test_two_subscribers_and_watch(spark, topic):
    s1 = write_summary_stream(stream(spark, topic), scratch_dir(spark, "a"),
                              scratch_dir(spark, "cka"), available_now=True)
    q = watch(clean_stream(read_raw_stream(spark, "files", {"path": topic})), "clean_watch")
    q.processAllAvailable()
    run_to_end(s1)
    assert spark.table("clean_watch").count() == 365
    q.stop()


def test_watch_keeps_the_latest_row_per_key_in_touched_buckets(spark):
    source, table, ck = (scratch_dir(spark, n) for n in ("w-in", "w-table", "w-ck"))
    schema = "k string, v int, _arrival long"

    def send(rows):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(source)
        q = watch(spark.readStream.schema(schema).parquet(source), "w_latest", keys=["k"],
                  table=table, checkpoint=ck, buckets=8, available_now=True)
        run_to_end(q)
        return sorted(((r.k, r.v) for r in spark.table("w_latest").collect()), key=str)

    def files():
        return {os.path.join(d, f) for d, _, fs in os.walk(table.removeprefix("file:"))
                for f in fs if f.endswith(".parquet")}

    assert send([("a", 1, 5), ("a", 2, 4), (None, 3, 1)]) == [("a", 1), (None, 3)]
    first = files()
    # an older message in a later batch replaces nothing; a null key equals a null key
    assert send([("a", 9, 3), (None, 4, 2)]) == [("a", 1), (None, 4)]
    before = files()
    assert first and before
    assert send([(None, 5, 9)]) == [("a", 1), (None, 5)]
    kept = before & files()
    assert kept and kept != before  # the bucket of "a" was not written again


def test_watch_complete_mode_shows_the_last_result(spark, topic):
    counts = clean_stream(read_raw_stream(spark, "files", {"path": topic})).groupBy(
        "norm_month").count()
    q = watch(counts, "w_counts", "complete", available_now=True)
    run_to_end(q)
    got = spark.table("w_counts")
    assert got.count() == 12 and got.groupBy().sum("count").first()[0] == 365


def test_changelog_stream_read_back_by_pick_fields(spark, topic):
    summary = monthly_summary(clean_stream(stream(spark, topic)))
    out = scratch_dir(spark, "changelog")
    q = write_changelog_stream(summary, ["station_id", "station_name", "norm_month",
                                         "year_num", "month_num"],
                               scratch_dir(spark, "ck"), target=out)
    q.processAllAvailable()
    q.stop()
    msgs = spark.read.json(out)
    # Last change per key (highest epoch) is the final state.
    picked = pick_fields(msgs.withColumnRenamed("_epoch", "_order"),
                         SUMMARY_VALUE_ALIASES, SUMMARY_KEY_ALIASES)
    latest = (picked.groupBy("station_id", "norm_month")
              .agg(F.max_by("num_days", "_order").alias("num_days")))
    days = {r.norm_month: int(r.num_days) for r in latest.collect()}
    assert days["201002"] == 28 and len(days) == 12


def test_staging_replay_leaves_staging_unchanged(spark, topic):
    table, quarantine = scratch_dir(spark, "t-st2"), scratch_dir(spark, "t-q2")
    ck = scratch_dir(spark, "ck")
    run_to_end(write_staging_stream(stream(spark, topic), table, quarantine, ck,
                                    available_now=True))
    cols = ["station_id", "norm_date", "station_name", "dly_tmin_normal", "dly_tmax_normal",
            "mtd_prcp_normal", "created_at"]
    before = sorted(map(tuple, spark.read.parquet(table).select(*cols).collect()))
    rows = sample_messages(spark)
    for r in rows:
        r["_arrival"] += 10_000                 # the whole topic delivered again, later
    write_files(topic, rows, parts=3)
    q = write_staging_stream(stream(spark, topic), table, quarantine, ck, available_now=True)
    run_to_end(q)
    after = sorted(map(tuple, spark.read.parquet(table).select(*cols).collect()))
    assert len(before) == 365 and before == after   # values and first-load times kept


@pytest.mark.parametrize("parts", [1, 3, 7])
def test_summary_stream_equals_batch_any_split(spark, tmp_path, parts):
    from stationdw.sources.sinks import stream_report
    folder = str(tmp_path / f"topic{parts}")
    write_files(folder, sample_messages(spark), parts=parts)
    table = scratch_dir(spark, "t-split")
    q = write_summary_stream(stream(spark, folder), table, scratch_dir(spark, "ck"),
                             available_now=True)
    run_to_end(q)
    assert table_rows(summary_table(spark, table)) == table_rows(batch_summary(spark, folder))
    report = stream_report(q).collect()
    assert sum(r.input_rows for r in report) == 365 and len(report) == parts


def test_clean_stream_as_json_topic(spark, topic):
    from stationdw.streaming.jobs import write_clean_stream
    out = scratch_dir(spark, "clean-topic")
    run_to_end(write_clean_stream(stream(spark, topic), out, scratch_dir(spark, "ck"),
                                  available_now=True, fmt="json"))
    rows = spark.read.json(out)
    assert rows.count() == 365
    first = rows.where("norm_date = '20100101'").first()
    assert (first.year_num, first.month_num, first.norm_month) == (2010, 1, "201001")
    assert first.dly_tmin_normal == -33.0


def test_restarted_epoch_repeats_no_rows_and_old_stages_go(spark, tmp_path):
    folder, ck = str(tmp_path / "topic"), str(tmp_path / "ck")
    bad = {"station_id": "S", "norm_date": "20100102"}
    good = dict(bad, station_name="N")
    for i in range(3):
        write_files(folder, [dict(bad, _arrival=2 * i), dict(good, _arrival=2 * i + 1)], 1)
    table, quarantine = scratch_dir(spark, "t-re"), scratch_dir(spark, "q-re")

    def once():
        run_to_end(write_staging_stream(stream(spark, folder), table, quarantine, ck,
                                        available_now=True))

    once()
    assert os.listdir(os.path.join(ck, "merge")) == ["2"]     # only the last epoch's stage
    for name in ("2", ".2.crc"):       # the driver died before it could commit the last epoch
        if os.path.exists(os.path.join(ck, "commits", name)):
            os.rename(os.path.join(ck, "commits", name), str(tmp_path / f"commit{name}"))
    once()
    assert spark.read.parquet(quarantine).count() == 3
    assert spark.read.parquet(table).count() == 1


def test_summary_loader_keeps_rejected_messages(spark, tmp_path):
    from stationdw.plans.jobs import load_summary_changelog
    folder = str(tmp_path / "changelog")
    key = {"STATION_ID": "S", "STATION_NAME": "N", "NORM_MONTH": "201001", "YEAR_NUM": 2010,
           "MONTH_NUM": 1}
    lacking = {k: v for k, v in key.items() if k != "STATION_NAME"}
    write_files(folder, [{"key": json.dumps(k), "value": v, "_epoch": 0} for k, v in
                         [(key, json.dumps({"NUM_DAYS": 31})), (key, "null"), (key, ""),
                          (lacking, json.dumps({"NUM_DAYS": 30}))]], 1)
    table, rejects = str(tmp_path / "summary"), str(tmp_path / "rejects")
    run_to_end(load_summary_changelog(spark, folder, table, str(tmp_path / "ck"),
                                      rejects_path=rejects))
    assert [r.num_days for r in summary_table(spark, table).collect()] == [31]
    assert [r.reject_reason for r in spark.read.json(rejects).collect()] == \
        ["missing station_name"]


@pytest.mark.parametrize("published", [False, True])
def test_older_message_in_a_later_batch_replaces_nothing(spark, tmp_path, published):
    folder = str(tmp_path / "topic")

    def message(name, order, day="20100101"):
        at = {"_published": 1, "_seq": order} if published else {"_arrival": order}
        return {"station_id": "S", "station_name": name, "norm_date": day, **at}

    write_files(folder, [message("newest", 7), message("old", 1, "20100102")], 1)
    write_files(folder, [message("older", 5), message("new", 2, "20100102")], 1)
    write_files(folder, [message("oldest", 3)], 1)
    for i, name in enumerate(sorted(os.listdir(folder))):
        os.utime(os.path.join(folder, name), (1_700_000_000 + i, 1_700_000_000 + i))
    options = {"path": folder, "maxFilesPerTrigger": 1}
    if not published:
        options["arrival_field"] = "_arrival"
    table = scratch_dir(spark, "t-late")
    run_to_end(write_staging_stream(read_raw_stream(spark, "files", options), table,
                                    scratch_dir(spark, "q-late"), scratch_dir(spark, "ck"),
                                    available_now=True))
    got = {r.norm_date.day: r.station_name for r in spark.read.parquet(table).collect()}
    assert got == {1: "newest", 2: "new"}


def test_query_topic_repeats_keys_in_later_files(spark):
    import __spark_entry__ as entry
    from tests.conftest import SF_SMALL
    topic = spark.read.text(entry._event_topic(spark, SF_SMALL))
    places = topic.select(F.get_json_object("value", "$.station_id").alias("s"),
                          F.get_json_object("value", "$.norm_date").alias("d"),
                          F.input_file_name().alias("file")).distinct()
    assert not places.groupBy("s", "d").count().where("count > 1").isEmpty()


def test_report_keeps_batches_that_spark_forgets(spark, tmp_path):
    import time
    from stationdw.sources.sinks import stream_report
    from stationdw.streaming.jobs import write_clean_stream
    folder, out, ck = (str(tmp_path / n) for n in ("topic", "clean", "ck"))
    rows = sample_messages(spark)
    spark.conf.set("spark.sql.streaming.numRecentProgressUpdates", 2)
    try:
        for part in (rows[:300], rows[300:]):       # the second run is a restart
            write_files(folder, part, 5)
            q = write_clean_stream(stream(spark, folder), out, ck, available_now=True)
            run_to_end(q)
        assert len(q.recentProgress) <= 2
        for _ in range(50):                        # the listener runs beside the stream
            report = stream_report(q).collect()
            if len(report) == 10:
                break
            time.sleep(0.2)
    finally:
        spark.conf.unset("spark.sql.streaming.numRecentProgressUpdates")
    assert sorted(r.batch_id for r in report) == list(range(10))
    assert sum(r.input_rows for r in report) == 365
