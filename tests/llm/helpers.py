"""Shared rows with the awkward cases every operator must handle."""

from pyspark.sql.types import (ArrayType, DoubleType, LongType, StringType, StructField,
                               StructType)

DOCS = StructType([StructField("doc_id", LongType()), StructField("text", StringType()),
                   StructField("lang", StringType()), StructField("source", StringType()),
                   StructField("n_chars", LongType()),
                   # names the operators use inside
                   StructField("th", LongType()), StructField("key", StringType()),
                   StructField("size", LongType()), StructField("copies", LongType())])

LONG = " ".join(f"word{i}" for i in range(30_000))
TEXTS = [
    (1, "The quick brown fox\njumps over the lazy dog. " * 5, "en", "a"),
    (2, None, "en", "a"),
    (3, "", None, None),
    (4, " \t\n ", "en", "b"),
    (5, "42 + 17 = 59 !!", "de", "b"),
    (6, "Der schnelle braune Fuchs springt über den faulen Hund", "de", None),
    (7, "Der schnelle braune Fuchs springt über den faulen Hund", "de", "c"),
    (7, "Der schnelle braune Fuchs springt über den faulen Hund", "de", "c"),
    (8, LONG, "en", "a"),
    (9, LONG + " tail", "en", "a"),
    (None, "row without an id", "en", None),
    (None, None, None, None),
    (10, "日本語のテキスト 🙂 é é ﬁ", None, "b"),
]


def docs(spark, rows=TEXTS):
    full = [(i, t, lang, s, len(t) if t is not None else None, 1, "k", 2, 3)
            for i, t, lang, s in rows]
    return spark.createDataFrame(full, DOCS)


def vectors(spark, rows):
    return spark.createDataFrame(rows, StructType([
        StructField("vec_id", LongType()), StructField("embedding", ArrayType(DoubleType())),
        StructField("score", LongType()), StructField("block", LongType())]))
