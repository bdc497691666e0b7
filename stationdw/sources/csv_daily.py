"""Header CSV source for daily normals (batch and streaming).

Columns bind by header **name**, file by file. Spark binds a supplied schema by position, so files
are grouped by their header line; each group is read with an all-string schema in its own order
(``enforceSchema=false`` checks every file against it) and the groups are united by name.
"""

from __future__ import annotations

from functools import reduce
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stationdw.functions.numeric import strip_ws, to_float, to_int
from stationdw.schemas import DAILY_CSV_RENAME, FLOAT_FIELDS, INT_FIELDS

# Records, not lines: a quoted field may hold line breaks. A file is then read by one task, so
# large inputs come as many files.
_CSV_OPTIONS = {"header": "true", "encoding": "UTF-8", "quote": '"', "escape": '"',
                "mode": "PERMISSIVE", "multiLine": "true"}


def header_columns(spark: SparkSession, path: str | list[str]) -> list[str]:
    """Column names of the CSV header (reads only the first line)."""
    return spark.read.options(**_CSV_OPTIONS).csv(path).columns


def files_by_header(spark: SparkSession, path: str | list[str]) -> list[list[str]]:
    """The input's files, grouped by equal header lines (one pass over the text of each file's
    first block; the driver gets the file names, as it does for any scan)."""
    lines = spark.read.text(path).select(
        F.trim("value").alias("line"), F.input_file_name().alias("file"),
        F.col("_metadata.file_block_start").alias("start"),
        F.monotonically_increasing_id().alias("at"))
    heads = (lines.where("start = 0 AND line <> ''").groupBy("file")
             .agg(F.min_by("line", "at").alias("header")))
    groups = heads.groupBy("header").agg(F.sort_array(F.collect_list("file")).alias("files"))
    # file names come as URIs
    return [[unquote(f) for f in r["files"]] for r in groups.orderBy("files").collect()]


def read_header_csv(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """All-string DataFrame, columns by header name in every file; a column that a file lacks is
    null there."""
    def one(files):
        schema = T.StructType([T.StructField(n, T.StringType())
                               for n in header_columns(spark, files)])
        return (spark.read.options(**_CSV_OPTIONS).option("enforceSchema", "false")
                .schema(schema).csv(files))

    groups = files_by_header(spark, path) or [path]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), map(one, groups))


def typed_daily(raw: DataFrame, rename: dict[str, str] | None = None,
                strict: bool = True) -> DataFrame:
    """Rename, strip and type the raw string columns into one message-shaped record per row.

    Absent source columns become null (the date becomes ""), blank numbers become null,
    integers are truncated toward zero; bad number text raises when ``strict``.
    """
    rename = rename or DAILY_CSV_RENAME
    present = set(raw.columns)

    def src(target: str):
        for source, name in rename.items():
            if name == target and source in present:
                return F.col(f"`{source}`")
        return F.lit(None).cast("string")

    cols = []
    for target in rename.values():
        c = src(target)
        if target in FLOAT_FIELDS:
            c = to_float(c, strict)
        elif target in INT_FIELDS:
            c = to_int(c, strict)
        elif target == "norm_date":
            c = F.coalesce(strip_ws(c), F.lit(""))
        cols.append(c.alias(target))
    return raw.select(*cols)


def read_daily_csv(spark: SparkSession, path: str | list[str],
                   rename: dict[str, str] | None = None, strict: bool = True) -> DataFrame:
    """Header CSV of daily normals -> typed message-shaped rows (S1, P1, X-num1/2, X-str2)."""
    return typed_daily(read_header_csv(spark, path), rename, strict)


def read_daily_csv_stream(spark: SparkSession, directory: str, columns: list[str],
                          rename: dict[str, str] | None = None, strict: bool = True,
                          max_files_per_trigger: int | None = None) -> DataFrame:
    """Streaming variant: files arriving in ``directory`` with the given header ``columns``."""
    schema = T.StructType([T.StructField(n, T.StringType()) for n in columns])
    reader = (spark.readStream.options(**_CSV_OPTIONS).option("enforceSchema", "false")
              .schema(schema))
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return typed_daily(reader.csv(directory), rename, strict)
