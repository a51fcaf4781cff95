"""Connected components by alternating large and small stars (Kiveris and others, 2014)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sessionloom.llm.shared import cut


def _state(edges: DataFrame) -> tuple:
    row = edges.agg(F.count(F.lit(1)).alias("n"), F.bit_xor(F.xxhash64("u", "v")).alias("x")).first()
    return row["n"], row["x"]


def _stars(edges: DataFrame) -> DataFrame:
    """One large and one small star step over edges (u, v) with u > v."""
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u > v").distinct()
    lower = large.groupBy("u").agg(F.min("v").alias("m"))
    small = large.join(lower, "u").where("v > m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return small.unionByName(lower.select("u", F.col("m").alias("v"))).distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of edges (u, v) but the roots; root is the smallest node reachable.

    Each round is a few joins and aggregates over the edges, written to the shared folder; a hub's
    edges are split by the adaptive skew join and pre-aggregated for its minimum.
    """
    now = cut(edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "edges")
    before, state = None, _state(now)
    while state != before:
        now = cut(_stars(now), "stars")
        before, state = state, _state(now)
    return now.select(F.col("u").alias("node"), F.col("v").alias("root"))
