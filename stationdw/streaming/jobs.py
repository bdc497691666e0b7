"""Structured Streaming jobs over the raw message topic.

Two independent subscribers of one topic, each with its own checkpoint:

* ``summary`` path: declared schema -> clean projection -> unbounded keyed aggregation in update
  mode (no watermark: late readings are always accepted, state is one row per station-month)
  -> ``foreachBatch`` keyed upsert into the monthly summary table.
* ``staging`` path: staging decoder -> valid rows upserted keyed (station, date), last arrival
  wins, first load time kept; rejected rows go to a quarantine table with their reason, one
  folder per micro-batch.

``foreachBatch`` writes are keyed merges or replace their own epoch's folder, so a micro-batch re-run after a failure (or a full
replay from the earliest offset) leaves the tables unchanged: exactly-once results from an
at-least-once sink.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from stationdw.operators.aggregate import monthly_summary
from stationdw.operators.clean import clean_readings, split_valid
from stationdw.operators.upsert import merge_into_path, merge_stages
from stationdw.schemas import (LENGTH_LIMITS, NOT_NULL, PRCP, STAGING_KEY, SUMMARY_KEY, TEMP)
from stationdw.sources.messages import decode_staging, parse_raw
from stationdw.sources.sinks import epoch_folder, reported


def clean_stream(raw: DataFrame) -> DataFrame:
    """Raw ``value`` messages -> typed, cleaned readings (batch or streaming)."""
    return clean_readings(parse_raw(raw))


def summary_rows(summary: DataFrame) -> DataFrame:
    """Aggregate output -> monthly summary table types (averages as DECIMAL(7,2))."""
    return summary.select(
        "station_id", "station_name", "norm_month",
        F.col("year_num").cast("int").alias("year_num"),
        F.col("month_num").cast("int").alias("month_num"),
        F.col("num_days").cast("int").alias("num_days"),
        F.col("avg_dly_tmin_normal").cast(TEMP).alias("avg_dly_tmin_normal"),
        F.col("avg_dly_tmax_normal").cast(TEMP).alias("avg_dly_tmax_normal"),
        F.col("month_end_prcp_normal").cast(PRCP).alias("month_end_prcp_normal"),
        *[c for c in summary.columns if c == "_arrival"],
    )


def _trigger(writer, available_now: bool, processing_time: str | None, spark: SparkSession,
             checkpoint: str):
    writer = reported(writer, spark, checkpoint)
    if available_now:
        return writer.trigger(availableNow=True)
    if processing_time:
        return writer.trigger(processingTime=processing_time)
    return writer


def write_summary_stream(raw: DataFrame, table_path: str, checkpoint: str,
                         dedupe_keys: list[str] | None = None, available_now: bool = False,
                         processing_time: str | None = None) -> StreamingQuery:
    """Continuous monthly summary of a raw message stream, upserted into ``table_path``.

    A month that has readings under two names of its station has two groups and one row: that of
    the group whose latest reading arrived last.
    """
    summary = monthly_summary(clean_stream(raw), dedupe_keys=dedupe_keys, arrival="_arrival")

    def upsert(batch: DataFrame, epoch_id: int) -> None:
        rows = summary_rows(batch).withColumn("_epoch", F.lit(epoch_id))
        order = [c for c in ("_epoch", "_arrival") if c in rows.columns]
        merge_into_path(rows, table_path, SUMMARY_KEY, order, "norm_month",
                        stages=merge_stages(checkpoint), epoch=epoch_id)

    writer = (summary.writeStream.outputMode("update").option("checkpointLocation", checkpoint)
              .foreachBatch(upsert))
    return _trigger(writer, available_now, processing_time, raw.sparkSession,
                    checkpoint).start()


def write_clean_stream(raw: DataFrame, path: str, checkpoint: str, available_now: bool = False,
                       processing_time: str | None = None, fmt: str = "parquet",
                       options: dict | None = None) -> StreamingQuery:
    """Derived stream of cleaned readings.

    ``fmt="parquet"``: a table (exactly-once file sink); ``"json"``: a file topic of JSON lines;
    ``"kafka"``: topic ``path`` with each reading as a JSON ``value`` (Kafka connector needed,
    ``options`` carries ``kafka.bootstrap.servers``).
    """
    clean = clean_stream(raw)
    writer = clean.writeStream.outputMode("append").option("checkpointLocation", checkpoint)
    if fmt == "kafka":
        value = F.to_json(F.struct(*[c for c in clean.columns if not c.startswith("_")]),
                          {"ignoreNullFields": "false"})
        writer = (clean.select(value.alias("value")).writeStream.outputMode("append")
                  .option("checkpointLocation", checkpoint).format("kafka")
                  .options(**(options or {})).option("topic", path))
    else:
        writer = writer.format(fmt).option("path", path)
        if fmt == "json":
            writer = writer.option("ignoreNullFields", "false")
    return _trigger(writer, available_now, processing_time, raw.sparkSession,
                    checkpoint).start()


def staging_rows(batch: DataFrame, decoded: bool = False) -> tuple[DataFrame, DataFrame]:
    """Decode one batch of raw messages into (valid staging rows, rejected rows)."""
    decoded = batch if decoded else decode_staging(batch)
    valid, rejected = split_valid(decoded, NOT_NULL["staging"], limits=LENGTH_LIMITS["staging"])
    valid = (valid.drop("raw_value")
             .withColumn("created_at", F.current_timestamp())
             .withColumn("norm_month", F.date_format("norm_date", "yyyyMM")))
    return valid, rejected


def write_staging_stream(raw: DataFrame, table_path: str, quarantine_path: str,
                         checkpoint: str, available_now: bool = False,
                         processing_time: str | None = None) -> StreamingQuery:
    """Staging consumer: keyed keep-latest upsert by arrival order, plus a quarantine table.

    The table is partitioned by the month of ``norm_date`` (a function of the key), so each
    micro-batch rewrites only the months it touches. ``_arrival`` is stored with each row: an
    older message in a later micro-batch does not replace a newer one.
    """

    def upsert(batch: DataFrame, epoch_id: int) -> None:
        # The batch feeds two writes: decode it once (persisted; a lost block is recomputed
        # from the replayable source batch).
        decoded = decode_staging(batch).persist()
        try:
            valid, rejected = staging_rows(decoded, decoded=True)
            rejected.withColumn("_epoch", F.lit(epoch_id)).write.mode("overwrite").parquet(
                epoch_folder(quarantine_path, checkpoint, epoch_id))
            merge_into_path(valid, table_path, STAGING_KEY, ["_arrival"], "norm_month",
                            keep_first=["created_at"],
                            stages=merge_stages(checkpoint), epoch=epoch_id, store_order=True)
        finally:
            decoded.unpersist()

    writer = (raw.writeStream.option("checkpointLocation", checkpoint).foreachBatch(upsert))
    return _trigger(writer, available_now, processing_time, raw.sparkSession,
                    checkpoint).start()
