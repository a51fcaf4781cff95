"""Mixing sources to target weights by hash order and distributed prefix sums."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from sessionloom.llm.shared import cut

BUCKET = 1024  # rows of a range of hash keys of one source, about


def word_count(text: Column) -> Column:
    return F.when(text.isNull(), F.lit(0)).otherwise(F.regexp_count(text, F.lit("[^\\x20\\x09-\\x0D]+"))).cast("long")


def source_targets(sizes: DataFrame, weights: list[int], most: int) -> DataFrame:
    """Per source: source_size and target. sizes: source, source_size, one row per source, which one task takes in order.

    Targets share the total by weight, but none is above `most` times its source's size: the excess goes to the
    others by weight. Sources run full in the order of most * size / weight, so the level of the rest
    follows from prefix sums over that order.
    """
    every = Window.orderBy(F.col("source").isNull(), "source")
    weight = F.element_at(F.array(*map(F.lit, weights)), ((F.row_number().over(every) - 1) % len(weights) + 1).cast("int"))
    full = Window.orderBy("fills", F.col("source").isNull(), "source")
    before, whole = full.rowsBetween(Window.unboundedPreceding, -1), Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    out = sizes.withColumn("weight", weight.cast("long")).withColumn("cap", most * F.col("source_size")).withColumn("fills", F.col("cap") / F.col("weight"))
    out = out.withColumn("left_words", F.sum("source_size").over(whole) - F.coalesce(F.sum("cap").over(before), F.lit(0)))
    out = out.withColumn("left_weight", F.sum("weight").over(whole) - F.coalesce(F.sum("weight").over(before), F.lit(0)))
    out = out.withColumn("is_full", F.col("cap").cast("double") * F.col("left_weight") <= F.col("left_words").cast("double") * F.col("weight"))
    # once a source isn't full, none after it is; the level is the one met first
    out = out.withColumn("nth", F.row_number().over(full))
    out = out.withColumn("level_words", F.min(F.when(~F.col("is_full"), F.struct("nth", "left_words", "left_weight"))).over(whole))
    share = F.col("level_words.left_words").cast("double") * F.col("weight") / F.col("level_words.left_weight")
    return out.select("source", "source_size", F.when(F.col("is_full"), F.col("cap").cast("double")).otherwise(share).alias("target"))


def mix(docs: DataFrame, weights: list[int] | None = None, most: int = 3, bucket: int = BUCKET, keep: list[str] | None = None) -> DataFrame:
    """How many words the mix takes of each document.

    Returns one row per row of docs: doc_id, source, size, source_size, target, taken, and the columns named in keep. Sources
    in code point order, null last (a source of its own), have the weights in turn and share the total
    number of words; a target stops at `most` times its source's size. Documents of a source are
    ordered by MD5 of doc_id (of the text, where doc_id is null; ties by size and text). A source is
    taken as often as it fits its target, then in that order up to the rest; the last document is
    taken in part, so that the floor of the target is met exactly. Reruns agree. Texts that are null or
    without words have size 0 and are taken 0 times. An empty table gives an empty result.

    Only ids, sources, sizes and keys are shuffled. Keys are uniform, so equal ranges of them are even; no
    window spans a source, only its ranges' totals.
    """
    weights = weights or [1, 2, 3]
    digest = F.md5(F.coalesce("text", F.lit("")))
    sized = docs.select(
        "doc_id", "source", *(keep or []), word_count(F.col("text")).alias("size"),
        F.md5(F.coalesce(F.col("doc_id").cast("string"), F.concat(F.lit("t"), digest))).alias("key"), F.xxhash64(F.coalesce("text", F.lit(""))).alias("tie"),
    )
    sized = cut(sized, "sizes").withColumn("name", F.coalesce(F.concat(F.lit("s"), F.col("source").cast("string")), F.lit("n")))
    ranges = max(1, sized.count() // bucket)
    sized = sized.withColumn("range", F.floor(F.conv(F.substring("key", 1, 8), 16, 10).cast("long") * ranges / F.lit(2.0**32)).cast("long"))
    parts = sized.groupBy("name", "source", "range").agg(F.sum("size").alias("words"))
    totals = parts.groupBy("name", "source").agg(F.sum("words").alias("source_size"))
    targets = source_targets(totals.select("source", "source_size"), weights, most)
    targets = targets.withColumn("name", F.coalesce(F.concat(F.lit("s"), F.col("source").cast("string")), F.lit("n"))).drop("source")
    running = Window.partitionBy("name").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.drop("source").join(targets, "name").withColumn("ahead", F.coalesce(F.sum("words").over(running), F.lit(0))).drop("words")
    inside = Window.partitionBy("name", "range").orderBy("key", "size", "tie").rowsBetween(Window.unboundedPreceding, -1)
    out = sized.join(parts, ["name", "range"]).withColumn("before", F.col("ahead") + F.coalesce(F.sum("size").over(inside), F.lit(0)))
    budget = F.floor("target").cast("long")
    times = F.when(F.col("source_size") > 0, F.floor(budget / F.col("source_size"))).otherwise(0).cast("long")
    rest = budget - times * F.col("source_size")
    taken = times * F.col("size") + F.greatest(F.lit(0), F.least(F.col("size"), rest - F.col("before")))
    return out.select("doc_id", "source", *(keep or []), "size", "source_size", "target", F.when(F.col("source_size") > 0, taken).otherwise(0).cast("long").alias("taken"))


def mixed_documents(docs: DataFrame, weights: list[int] | None = None, most: int = 3) -> DataFrame:
    """The mix itself: rows with the columns doc_id, text, lang, source and n_chars, each document as often as it is taken, always whole.

    The document that mix takes in part comes whole too, so that a source is above its target by less than one document, and no text is cut or rewritten.
    """
    taken = mix(docs, weights, most, keep=["text", "lang", "n_chars"]).where("taken > 0")
    copies = taken.withColumn("nth", F.explode(F.sequence(F.lit(1).cast("long"), F.ceil(F.col("taken") / F.col("size")).cast("long"))))
    return copies.select("doc_id", "text", "lang", "source", "n_chars")
