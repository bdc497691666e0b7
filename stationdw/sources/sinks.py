"""Sinks: report files, message topics (batch), keyed changelog streams, watch queries."""

from __future__ import annotations

import hashlib
import json
import time
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery, StreamingQueryListener
from pyspark.sql.utils import AnalysisException

from stationdw.operators.upsert import merge_into_path, merge_stages
from stationdw.session import scratch_dir, write_text
from stationdw.sources.messages import to_raw_messages


def epoch_folder(target: str, checkpoint: str, epoch_id: int) -> str:
    """Folder of one micro-batch's appended rows below ``target``. Overwriting it makes an append
    repeatable: a retried epoch replaces its own rows. Streams with other checkpoints, which
    count their epochs anew, write elsewhere."""
    run = hashlib.sha1(checkpoint.encode("utf-8")).hexdigest()[:12]
    return f"{target.rstrip('/')}/run={run}/epoch={epoch_id}"


def write_report_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """A report as header CSV files (all fields quoted, nulls as empty fields)."""
    (df.write.mode(mode).option("header", "true").option("quoteAll", "true")
     .option("nullValue", "").csv(path))


def write_messages(df: DataFrame, target: str, sink: str = "files",
                   options: dict | None = None) -> None:
    """Publish rows as JSON messages: ``files`` appends JSON-lines text, ``kafka`` a topic.

    A file topic has no offsets, so each message also carries its arrival order: ``_published``
    (the publish run's time in milliseconds) and ``_seq`` (increasing within the run, by
    partition then row). Consumers ignore fields they do not know.
    For Kafka, ``options`` carries ``kafka.bootstrap.servers`` and the topic is ``target``
    (needs the Kafka connector on the classpath); arrival order is the offset there.
    """
    if sink == "files":
        stamped = df.select(*[F.col(c) for c in df.columns if not c.startswith("_")],
                            F.lit(int(time.time() * 1000)).alias("_published"),
                            F.monotonically_increasing_id().alias("_seq"))
        opts = {"ignoreNullFields": "false"}
        stamped.select(F.to_json(F.struct(*stamped.columns), opts).alias("value")) \
            .write.mode("append").text(target)
        return
    msgs = to_raw_messages(df)
    if sink == "kafka":
        msgs.write.format("kafka").options(**(options or {})).option("topic", target).save()
    else:
        raise ValueError(f"unknown sink {sink!r}")


def changelog_messages(summary: DataFrame, keys: list[str]) -> DataFrame:
    """Keyed changelog of an aggregate: JSON key of the group columns, JSON value of all
    columns with upper-case names and ``<KEY>_V`` copies of the keys in the value."""
    opts = {"ignoreNullFields": "false"}
    measures = [c for c in summary.columns if c not in keys and not c.startswith("_")]
    key = F.to_json(F.struct(*[F.col(k).alias(k.upper()) for k in keys]), opts)
    value = F.to_json(F.struct(*[F.col(k).alias(k.upper() + "_V") for k in keys],
                               *[F.col(m).alias(m.upper()) for m in measures]), opts)
    return summary.select(key.alias("key"), value.alias("value"),
                          *[c for c in summary.columns if c == "_arrival"])


def write_changelog_stream(summary: DataFrame, keys: list[str], checkpoint: str,
                           sink: str = "files", target: str | None = None,
                           options: dict | None = None) -> StreamingQuery:
    """Stream every change of an aggregate as keyed JSON messages (update mode).

    ``files``: each micro-batch of changes as JSON lines (``key``/``value``, ``_epoch`` and, if the
    aggregate has it, ``_arrival``) in its own folder under ``target`` (a retried epoch replaces
    it); ``kafka``: to topic ``target``.
    """
    out = changelog_messages(summary, keys)
    writer = reported(out.writeStream.outputMode("update")
                      .option("checkpointLocation", checkpoint), out.sparkSession, checkpoint)
    if sink == "kafka":
        messages = out.drop("_arrival")  # the topic has an order of its own
        return (reported(messages.writeStream.outputMode("update")
                         .option("checkpointLocation", checkpoint), out.sparkSession, checkpoint)
                .format("kafka").options(**(options or {})).option("topic", target).start())

    def append(batch: DataFrame, epoch_id: int) -> None:
        (batch.withColumn("_epoch", F.lit(epoch_id)).write.mode("overwrite")
         .json(epoch_folder(target, checkpoint, epoch_id)))

    return writer.foreachBatch(append).start()


def watch(stream_df: DataFrame, name: str, output_mode: str = "append",
          keys: Sequence[str] | None = None, order_col: str = "_arrival",
          table: str | None = None, checkpoint: str | None = None, buckets: int = 64,
          available_now: bool = False) -> StreamingQuery:
    """A continuous query whose current output can be read as the view ``name``.

    The output is a Parquet table (``table``, by default a scratch folder), never driver memory.
    ``append`` and ``update`` keep the rows of every micro-batch, ``complete`` those of the last
    one. With ``keys`` the view holds the latest row per key by ``order_col``, whatever the order
    of the micro-batches (null keys equal each other): the table is hash-bucketed by key into
    ``buckets`` folders, and a micro-batch reads and rewrites only the buckets its keys fall in.
    ``table`` and ``checkpoint`` continue an earlier watch, with the same keys and buckets.
    """
    spark = stream_df.sparkSession
    table = table or scratch_dir(spark, "watch")
    checkpoint = checkpoint or scratch_dir(spark, "watch-ck")
    bucketed = stream_df
    if keys:
        bucketed = stream_df.withColumn(
            "_bucket", F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int"))

    def show(path: str) -> None:
        # a view lists its files when it is made, so each micro-batch makes it anew
        (spark.read.schema(bucketed.schema).option("recursiveFileLookup", str(not keys).lower())
         .parquet(path).select(*stream_df.columns).createOrReplaceTempView(name))

    def store(batch: DataFrame, epoch_id: int) -> None:
        if keys:
            merge_into_path(batch, table, keys, [order_col], "_bucket", store_order=True,
                            stages=merge_stages(checkpoint), epoch=epoch_id)
            show(table)
            return
        folder = epoch_folder(table, checkpoint, epoch_id)
        batch.write.mode("overwrite").parquet(folder)
        show(folder if output_mode == "complete" else table)

    spark.createDataFrame([], stream_df.schema).createOrReplaceTempView(name)
    if output_mode != "complete":
        try:
            show(table)  # of an earlier watch
        except AnalysisException:  # no folder yet
            pass
    writer = reported(bucketed.writeStream.outputMode(output_mode)
                      .option("checkpointLocation", checkpoint).foreachBatch(store),
                      spark, checkpoint)
    return (writer.trigger(availableNow=True) if available_now else writer).start()


_REPORT = "batch_id long, input_rows long, rows_per_second double, state_rows long"
#: Report folder by name of the query; sessions (by application) that have the listener.
_REPORT_FOLDERS: dict[str, str] = {}
_LISTENING: dict[str, StreamingQueryListener] = {}


def _report_row(p) -> tuple[int, int, float, int]:
    state = sum(op.numRowsTotal for op in (p.stateOperators or []))
    return (int(p.batchId), int(p.numInputRows), float(p.processedRowsPerSecond or 0.0),
            int(state))


class _ReportListener(StreamingQueryListener):
    """One report row per finished micro-batch, a JSON line in its own folder; a retried batch
    replaces its row."""

    def __init__(self, spark: SparkSession):
        self.spark = spark

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        folder = _REPORT_FOLDERS.get(event.progress.name or "")
        if folder:
            row = dict(zip(("batch_id", "input_rows", "rows_per_second", "state_rows"),
                           _report_row(event.progress)))
            write_text(self.spark, f"{folder}/epoch={row['batch_id']}/report.json",
                       json.dumps(row) + "\n")

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass


def reported(writer: DataStreamWriter, spark: SparkSession, checkpoint: str) -> DataStreamWriter:
    """``writer`` as a query whose micro-batches go to the report table in its checkpoint folder,
    where a restart continues it."""
    app = spark.sparkContext.applicationId
    if app not in _LISTENING:
        _LISTENING[app] = _ReportListener(spark)
        spark.streams.addListener(_LISTENING[app])
    name = "stationdw-" + hashlib.sha1(checkpoint.encode("utf-8")).hexdigest()[:12]
    _REPORT_FOLDERS[name] = checkpoint.rstrip("/") + "/report"
    return writer.queryName(name)


def stream_report(query: StreamingQuery) -> DataFrame:
    """Per-micro-batch load report of a stream of this package, over all its runs with one
    checkpoint: batch id, input rows, rows per second and state rows.

    Read from the report table; the progress history the query still holds (the last batches)
    stands in for rows that the listener has yet to write.
    """
    spark = SparkSession.getActiveSession()
    recent = spark.createDataFrame([_report_row(p) for p in query.recentProgress], _REPORT)
    folder = _REPORT_FOLDERS.get(query.name or "")
    if not folder:
        return recent
    try:
        stored = (spark.read.schema(_REPORT).option("recursiveFileLookup", "true").json(folder)
                  .where("batch_id IS NOT NULL"))
    except AnalysisException:  # nothing written yet
        return recent
    return stored.join(recent, "batch_id", "left_anti").unionByName(recent)
