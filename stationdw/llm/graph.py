"""Connected components as Spark joins and aggregations (large star and small star)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stage


def components(links: DataFrame) -> DataFrame:
    """``node, component`` for every node of ``links`` (columns a, b of long); the component is
    the smallest node reachable.

    Each round hangs every node below the smallest neighbour it has seen; it ends when a round
    changes no link. Rounds grow with the logarithm of the longest path. Minima are aggregated
    map-side and joined back, so a node with very many links is a skewed join, which AQE splits,
    and never one group in one task. Every round is written to the shared folder.
    """
    def oriented(df):
        return df.where("a != b").select(F.greatest("a", "b").alias("a"),
                                         F.least("a", "b").alias("b")).distinct()

    def state(df):
        row = df.agg(F.count("*").alias("n"),
                     F.bit_xor(F.xxhash64("a", "b")).alias("x")).first()
        return row["n"], row["x"]

    now = stage(oriented(links), "links")
    seen = state(now)
    while seen[0]:
        both = now.unionByName(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
        # large star: larger neighbours move below the smallest one
        large = (both.join(low, "a").where(F.col("b") > F.col("a"))
                 .select(F.col("b").alias("a"), F.col("m").alias("b")))
        large = oriented(large)
        # small star: smaller neighbours, and the node itself, move below the smallest one
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(low, "a").select(
            F.explode(F.array(F.struct(F.col("b").alias("a"), F.col("m").alias("b")),
                              F.struct(F.col("a").alias("a"), F.col("m").alias("b")))).alias("e"))
        now = stage(oriented(small.select("e.a", "e.b")), "links")
        if (new := state(now)) == seen:
            break
        seen = new
    tops = now.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    return now.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(tops)
