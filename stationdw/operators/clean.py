"""Cleaning, validation and quarantine of readings and summary messages."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stationdw.functions.dates import month_key
from stationdw.functions.json_fields import (first_present, json_fields, json_keys, json_types,
                                             pick_or, settled)


def clean_readings(df: DataFrame) -> DataFrame:
    """Clean-stream projection: pass 6 fields, derive year/month/month key, measures as DOUBLE.

    Works on batch and streaming frames; underscore-prefixed bookkeeping columns pass through.
    """
    d = F.col("norm_date")
    extra = [c for c in df.columns if c.startswith("_")]
    return df.select(
        "station_id", "station_name", "elevation", "latitude", "longitude", "norm_date",
        F.substring(d, 1, 4).try_cast("int").alias("year_num"),
        F.substring(d, 5, 2).try_cast("int").alias("month_num"),
        month_key(d).alias("norm_month"),
        F.col("dly_tmin_normal").try_cast("double").alias("dly_tmin_normal"),
        F.col("dly_tmax_normal").try_cast("double").alias("dly_tmax_normal"),
        F.col("mtd_prcp_normal").try_cast("double").alias("mtd_prcp_normal"),
        *extra,
    )


def split_valid(df: DataFrame, required: Sequence[str], reason_col: str = "reject_reason",
                limits: Mapping[str, int] | None = None) -> tuple[DataFrame, DataFrame]:
    """Split into (valid, rejected). Rejected rows keep every column plus ``reason_col``.

    An existing ``reason_col`` (e.g. from message decoding) takes precedence; then the first
    null required field gives ``missing <field>``, then the first text longer than its column's
    limit in ``limits`` gives ``too long <field>``.
    """
    bad = [(F.col(c).isNull(), f"missing {c}") for c in required]
    bad += [(F.length(c) > limit, f"too long {c}") for c, limit in (limits or {}).items()]
    reason = F
    for cond, label in bad:
        reason = reason.when(cond, F.lit(label))
    if reason_col in df.columns:
        reason = F.coalesce(F.col(reason_col), reason)
    tagged = df.withColumn(reason_col, reason)
    valid = tagged.where(F.col(reason_col).isNull()).drop(reason_col)
    rejected = tagged.where(F.col(reason_col).isNotNull())
    return valid, rejected


def pick_fields(df: DataFrame, value_aliases: Mapping[str, Sequence[str]],
                key_aliases: Mapping[str, Sequence[str]] | None = None,
                value_col: str = "value", key_col: str = "key") -> DataFrame:
    """Read fields of keyed JSON messages by alias lists, value first, key as fallback.

    For each output field: the first alias *present* in the value object (even if null), then
    ``or`` the first alias present in the key object, so null, "", 0 and false in the value fall
    back to the key. Non-object key or value counts as empty. Output fields are text; a
    ``tombstone`` flag marks messages whose value is null, blank or JSON ``null``. Text is never
    taken for a number: "0" and "false" in quotes are values.
    """
    key_aliases = key_aliases or {}
    has_key = key_col in df.columns
    extra = [c for c in df.columns if c.startswith("_")]
    v_names = [a for aliases in value_aliases.values() for a in aliases]
    k_names = [a for aliases in key_aliases.values() for a in aliases]
    base = df.select(F.col(value_col).alias("_value"), json_keys(value_col).alias("_vkeys"),
                     (F.col(key_col) if has_key else F.lit(None).cast("string")).alias("_key"),
                     (json_keys(key_col) if has_key else F.lit(None).cast("array<string>"))
                     .alias("_kkeys"), *extra)
    parsed, v_cols = json_fields(base, "_value", v_names, "_v")
    k_cols = {}
    if k_names:
        parsed, k_cols = json_fields(parsed, "_key", k_names, "_k")
    parsed, v_types = settled(parsed, json_types("_value", [
        a for n in value_aliases if n in key_aliases for a in value_aliases[n]]), "_t")
    out = {}
    for name, aliases in value_aliases.items():
        primary = first_present(F.col("_vkeys"), v_cols, list(aliases))
        if name in key_aliases:
            fallback = first_present(F.col("_kkeys"), k_cols, list(key_aliases[name]))
            kind = first_present(F.col("_vkeys"), v_types, list(aliases))
            out[name] = pick_or(primary, fallback, kind)
        else:
            out[name] = primary
    parsed, picked = settled(parsed, out, "_p")
    blank = F.col("_value").isNull() | F.trim("_value").isin("", "null")
    return parsed.select(*[c.alias(n) for n, c in picked.items()], blank.alias("tombstone"), *extra)
