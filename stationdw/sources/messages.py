"""JSON messages: producing them from rows, reading them as a stream, decoding them.

Two decoders exist because the reference has two consumers of the same topic:

* ``parse_raw`` declares a typed schema over the value (the stream-SQL consumer): a value that
  does not fit a field type gives null for that field.
* ``decode_staging`` mirrors the staging consumer: only JSON objects are accepted, numbers are
  converted to the staging decimals, dates must be ``yyyyMMdd``, and each row gets a
  ``reject_reason`` (null when valid) instead of being dropped silently.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stationdw.functions.dates import parse_yyyymmdd
from stationdw.functions.json_fields import json_fields, json_keys
from stationdw.schemas import RAW_MESSAGE, STAGING

_STAGING_TYPES = {f.name: f.dataType for f in STAGING.fields}


def to_raw_messages(df: DataFrame, fields: list[str] | None = None,
                    key_cols: list[str] | None = None) -> DataFrame:
    """Rows -> ``value`` JSON text (nulls written as ``null``), plus an optional JSON ``key``."""
    fields = fields or [f.name for f in RAW_MESSAGE.fields]
    opts = {"ignoreNullFields": "false"}
    out = [F.to_json(F.struct(*[F.col(c) for c in fields]), opts).alias("value")]
    if key_cols:
        out.insert(0, F.to_json(F.struct(*[F.col(c) for c in key_cols]), opts).alias("key"))
    keep = [c for c in df.columns if c.startswith("_")]
    return df.select(*out, *keep)


def read_raw_stream(spark: SparkSession, source: str, options: dict | None = None) -> DataFrame:
    """Streaming source of raw messages with ``key``/``value`` strings and an arrival order.

    ``source="kafka"``: needs the Kafka connector on the classpath; starts at the earliest offset
    unless told otherwise; arrival order = (record timestamp, partition, offset).
    ``source="files"``: JSON-lines text files in ``options["path"]``. Spark does not expose a
    line position, so arrival order comes from fields the producer puts in each message:
    ``(_published, _seq)`` by default (see ``sinks.write_messages``), or the single field
    ``options["arrival_field"]``. A message whose order field is absent or not a number comes
    before every message that has one.
    """
    options = dict(options or {})
    if source == "kafka":
        options.setdefault("startingOffsets", "earliest")
        try:
            df = spark.readStream.format("kafka").options(**options).load()
        except Exception as exc:  # noqa: BLE001
            if "kafka" in str(exc).lower() and "data source" in str(exc).lower():
                raise RuntimeError(
                    "the Kafka connector (spark-sql-kafka) is not on the classpath; add it to "
                    "the cluster or read a file topic with source='files'") from exc
            raise
        return df.select(
            F.col("key").cast("string").alias("key"),
            F.col("value").cast("string").alias("value"),
            # One partition (as the raw topic has) makes the offset the arrival order; across
            # partitions the record timestamp comes first.
            F.struct(F.col("timestamp"), F.col("partition"), F.col("offset")).alias("_arrival"),
        )
    if source == "files":
        path = options.pop("path")
        reader = spark.readStream.format("text")
        if "maxFilesPerTrigger" in options:
            reader = reader.option("maxFilesPerTrigger", options.pop("maxFilesPerTrigger"))
        arrival = options.pop("arrival_field", None)
        fields = [arrival] if arrival else ["_published", "_seq"]
        df = reader.load(path)
        parts = [F.get_json_object("value", f"$.{f}").try_cast("long") for f in fields]
        arrival_col = parts[0] if len(parts) == 1 else F.struct(
            *[p.alias(f) for p, f in zip(parts, fields)])
        return df.select(F.lit(None).cast("string").alias("key"), F.col("value"),
                         arrival_col.alias("_arrival"))
    raise ValueError(f"unknown source {source!r}")


def parse_raw(df: DataFrame, schema: T.StructType = RAW_MESSAGE,
              value_col: str = "value") -> DataFrame:
    """Declare ``schema`` over the JSON value: one field per column, matched by exact
    (case-sensitive) name; a value that does not fit its declared type becomes null.

    The text is parsed once per row (``json_tuple``); later filters cannot re-parse it.
    """
    extra = [c for c in df.columns if c.startswith("_")]
    names = [f.name for f in schema.fields]
    parsed, cols = json_fields(df.select(F.col(value_col).alias("_raw"), *extra), "_raw",
                               names, "_f")
    return parsed.select(*[cols[f.name].try_cast(f.dataType).alias(f.name)
                           for f in schema.fields], *extra)


_NUMERIC = ("elevation", "latitude", "longitude",
            "dly_tmin_normal", "dly_tmax_normal", "mtd_prcp_normal")


def _staging_select(field, is_object):
    """Staging columns from per-field text getters, with the first ``reject_reason``."""
    typed = {name: F.nullif(field(name), F.lit("")).try_cast(_STAGING_TYPES[name])
             for name in _NUMERIC}
    norm_date = parse_yyyymmdd(field("norm_date"))
    checks = [(~is_object, "not an object")]
    for name in _NUMERIC:
        raw = F.nullif(field(name), F.lit(""))
        checks.append((raw.isNotNull() & typed[name].isNull(), f"bad {name}"))
    checks += [
        (field("station_id").isNull(), "missing station_id"),
        (field("station_name").isNull(), "missing station_name"),
        (norm_date.isNull(), "missing norm_date"),
    ]
    reason = None
    for cond, label in checks:
        reason = F.when(cond, F.lit(label)) if reason is None else reason.when(cond, F.lit(label))
    return [
        field("station_id").alias("station_id"),
        field("station_name").alias("station_name"),
        typed["elevation"].alias("elevation"),
        typed["latitude"].alias("latitude"),
        typed["longitude"].alias("longitude"),
        norm_date.alias("norm_date"),
        typed["dly_tmin_normal"].alias("dly_tmin_normal"),
        typed["dly_tmax_normal"].alias("dly_tmax_normal"),
        typed["mtd_prcp_normal"].alias("mtd_prcp_normal"),
        reason.alias("reject_reason"),
    ]


_FIELDS = ("station_id", "station_name", "elevation", "latitude", "longitude", "norm_date",
           "dly_tmin_normal", "dly_tmax_normal", "mtd_prcp_normal")


def decode_staging(df: DataFrame, value_col: str = "value") -> DataFrame:
    """Decode raw messages the way the staging consumer does, with a ``reject_reason``.

    Reasons (first that applies): ``not an object`` (blank, broken or non-object JSON),
    ``bad <field>`` (a number that does not convert to its staging decimal),
    ``missing <field>`` (station_id, station_name or a valid yyyyMMdd norm_date absent).
    The raw text is kept in ``raw_value`` for the quarantine table. Each message is parsed once.
    """
    extra = [c for c in df.columns if c.startswith("_")]
    base = df.select(F.col(value_col).alias("raw_value"),
                     json_keys(F.col(value_col)).alias("_keys"), *extra)
    fields, cols = json_fields(base, "raw_value", _FIELDS, "_j")
    return fields.select(*_staging_select(lambda name: cols[name], F.col("_keys").isNotNull()),
                         "raw_value", *extra)


def stage_typed(df: DataFrame) -> DataFrame:
    """The same conversion for already typed message-shaped rows (e.g. from the CSV reader)."""
    extra = [c for c in df.columns if c.startswith("_")]
    return df.select(*_staging_select(lambda name: F.col(name).cast("string"), F.lit(True)),
                     *extra)
