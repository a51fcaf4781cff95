"""Removal of boilerplate lines by the number of distinct sites that have them, in DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sessionloom.llm.shared import cut

LG_K = 10  # of the sketches, whose relative error then is about 0.03


def _lines(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def boilerplate(lines: DataFrame, sites: int) -> DataFrame:
    """(key, check) of the lines that `sites` or more distinct sites have. lines: key, check, site.

    Sketches decide where they are sure: four standard errors and one site away. Nearer lines are counted.
    """
    margin = 4 * 1.04 / 2 ** (LG_K / 2)
    low, high = sites * (1 - margin) - 1, sites * (1 + margin) + 1
    spread = lines.groupBy("key", "check").agg(F.hll_sketch_estimate(F.hll_sketch_agg("site", LG_K)).alias("spread"))
    spread = cut(spread.where(F.col("spread") >= low), "spread")
    near = spread.where(F.col("spread") <= high).select("key", "check")
    exact = lines.join(near, ["key", "check"], "left_semi").select("key", "check", "site").distinct().groupBy("key", "check").agg(F.count(F.lit(1)).alias("n"))
    return spread.where(F.col("spread") > high).select("key", "check").unionByName(exact.where(F.col("n") >= sites).select("key", "check"))


def without_boilerplate(docs: DataFrame, site: str = "source", sites: int = 3) -> DataFrame:
    """Remove the lines that `sites` or more distinct sites have.

    Returns one row per row of docs: doc_id, n_lines, n_removed, kept_text. Lines end at a line feed and are compared as
    they are; lines of white space only are never removed. A null text is one empty line; null is a site of
    its own. Rows that repeat a doc_id and text all lose the same lines. Other columns aren't read. An
    empty table gives an empty result.

    Lines are known by a 64-bit and a 32-bit hash and aren't compared as texts: among n different lines two are taken for one with
    a probability of about n * n / 2**97. Only hashes are sketched, counted and joined; texts move once, to
    meet the places of their own removed lines.
    """
    name = F.coalesce(F.concat(F.lit("s"), F.col(site).cast("string")), F.lit("n"))
    tied = docs.select("doc_id", "text", F.xxhash64("text").alias("tie"), name.alias("site"))
    lines = tied.select("doc_id", "tie", "site", F.posexplode(_lines(F.col("text"))).alias("pos", "line")).where(F.trim(F.regexp_replace("line", "[\\x09-\\x0D]", " ")) != "")
    lines = cut(lines.select("doc_id", "tie", "site", "pos", F.xxhash64("line").alias("key"), F.hash("line").alias("check")), "lines")
    found = lines.join(boilerplate(lines.select("key", "check", "site"), sites), ["key", "check"])
    places = found.groupBy("doc_id", "tie").agg(F.collect_set("pos").alias("places")).select(F.col("doc_id").alias("id"), F.col("tie").alias("id_tie"), "places")
    joined = tied.join(places, F.col("doc_id").eqNullSafe(F.col("id")) & F.col("tie").eqNullSafe(F.col("id_tie")), "left")
    own = _lines(F.col("text"))
    left = F.array_except(F.sequence(F.lit(0), F.size(own) - 1), F.col("places"))
    kept = F.when(F.col("places").isNull(), own).otherwise(F.transform(left, lambda i: F.get(own, i)))
    return joined.select(
        "doc_id", F.size(own).cast("long").alias("n_lines"), F.coalesce(F.size("places"), F.lit(0)).cast("long").alias("n_removed"), F.array_join(kept, "\n").alias("kept_text")
    )
