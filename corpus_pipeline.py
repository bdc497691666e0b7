"""A training corpus from raw documents, in five stages that each call one operator.

``STAGES`` holds (name, function) pairs; a function takes (spark, docs, sf_dir) and returns a
DataFrame, which is written as Parquet and read again as the next one's docs. All but the last
return the columns of ``documents``.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stationdw.llm import bpe, langid, mixing, pii, simhash
from stationdw.llm.common import read_table, stage
from stationdw.llm.queries import PII_KEY

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language can be told; those without a letter and those that lie about as
    near to two languages go."""
    docs = docs.select(*COLUMNS)
    told = langid.predict(docs, langid.fit(docs), keep=tuple(COLUMNS[1:]))
    return told.where((F.col("lang_pred") != langid.UNDETERMINED) & ~F.col("ambiguous")).select(
        *COLUMNS)


def simhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates, the one with the smallest id."""
    return simhash.one_per_group(docs.select(*COLUMNS))


def pii_surrogates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with surrogates in place of personal data and secrets."""
    done = pii.surrogates(docs.select(*COLUMNS), PII_KEY)
    return done.withColumn("n_chars", F.when(F.col("n_entities") > 0, F.char_length("text").cast(
        "long")).otherwise(F.col("n_chars"))).select(*COLUMNS)


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents the mix takes; a document taken twice is there twice."""
    mixed = mixing.mix(docs.select(*COLUMNS), keep=tuple(COLUMNS))
    return mixed.where("copies > 0").withColumn(
        "copy", F.explode(F.sequence(F.lit(1), F.col("copies")))).select(*COLUMNS)


def bpe_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """``doc_id, n_tokens, ids, decoded`` of every document of the mix."""
    return bpe.encode(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [("language_id", language_id), ("simhash_near_dedup", simhash_near_dedup),
          ("pii_surrogates", pii_surrogates), ("source_mix", source_mix),
          ("bpe_tokens", bpe_tokens)]

#: SQL cannot express the classifier, the keyed surrogates or the encoder; the stages are tested
#: against brute force instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for name, step in STAGES[:-1]:
        docs = stage(step(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
