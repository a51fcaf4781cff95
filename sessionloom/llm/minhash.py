"""Document fingerprints by one-permutation MinHash, in DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from sessionloom.llm.shared import cut, words

BINS, BITS, SHINGLE = 128, 8, 5
NO_SHINGLE = "00" * BINS


def _bin(x: Column) -> Column:
    return F.shiftrightunsigned(x, 64 - BINS.bit_length() + 1).cast("int")


def _bind(value: Column, body) -> Column:
    """body(value), with the value computed once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _shingles(w: Column) -> Column:
    n = F.size(w)
    whole = F.when(n == 0, F.array().cast("array<bigint>")).otherwise(F.array(F.xxhash64(F.array_join(w, " "))))
    return F.when(n < SHINGLE, whole).otherwise(F.transform(F.sequence(F.lit(0), n - SHINGLE), lambda i: F.xxhash64(*[F.get(w, i + k) for k in range(SHINGLE)])))


def _minima(hashes: Column) -> Column:
    """The least hash of every bin that has one; sorted hashes of a bin stand together."""
    return _bind(F.sort_array(hashes), lambda s: F.filter(s, lambda x, i: (i == 0) | (_bin(x) != _bin(F.get(s, i - 1)))))


def _dense(m: Column) -> Column:
    """One hash per bin. An empty bin probes the bins in a random order of its own and takes the first that isn't empty,
    which is, of those that aren't, the one with the least hash of the two bins' numbers."""

    def filled(own: Column) -> Column:
        def of(b: Column) -> Column:
            donor = F.array_min(F.transform(m, lambda x: F.struct(F.xxhash64(b, _bin(x)).alias("order"), x.alias("x"))))["x"]
            return F.coalesce(F.try_element_at(own, b), donor)

        return F.transform(F.sequence(F.lit(0), F.lit(BINS - 1)), of)

    return _bind(F.map_from_arrays(F.transform(m, _bin), m), filled)


def fingerprint(text: Column) -> Column:
    """BITS low-order bits of each bin, as hex digits; zeros for a text without words.

    Shingles are SHINGLE words (the whole sequence, if there are fewer), hashed once; a hash's leading bits name its bin.
    """

    def packed(d: Column) -> Column:
        return F.array_join(F.transform(d, lambda x: F.lpad(F.lower(F.hex(x.bitwiseAND(F.lit(2**BITS - 1)))), 2, "0")), "")

    of_words = lambda w: _bind(_minima(_shingles(w)), lambda m: F.when(F.size(m) == 0, F.lit(NO_SHINGLE)).otherwise(packed(_dense(m))))
    return _bind(words(text), of_words)


def likeness(a: Column, b: Column) -> Column:
    """Estimated Jaccard similarity of two texts' shingles: the share of equal bins, less what equals by chance in BITS bits."""
    equal = F.size(F.filter(F.sequence(F.lit(0), F.lit(BINS - 1)), lambda i: F.substring(a, 2 * i + 1, F.lit(2)) == F.substring(b, 2 * i + 1, F.lit(2)))) / F.lit(float(BINS))
    chance = 2.0**-BITS
    estimate = F.greatest(F.lit(0.0), (equal - chance) / (1 - chance))
    return F.when(a == b, F.lit(1.0)).when((a == NO_SHINGLE) | (b == NO_SHINGLE), F.lit(0.0)).otherwise(estimate)


def _next_of(ids: DataFrame, per_range: int) -> DataFrame:
    """For each key of ids its neighbour before it in descending doc_id (before_key, before_tie, before_chars, before_copies); the last stands before the first.

    Ids alone are sorted, in ranges of about per_range rows. Only the head of a range needs the tail of another, and only tails, one per range, meet in one task.
    """
    ranges = max(1, ids.count() // per_range)
    order = [F.desc_nulls_last("doc_id"), F.col("tie"), F.col("key")]
    dealt = cut(ids.repartitionByRange(ranges, *order).withColumn("range", F.spark_partition_id()), "ordered")
    inside = Window.partitionBy("range").orderBy(*order)
    me = F.struct(*[F.col(c).alias(f"before_{c}") for c in ("key", "tie", "chars", "copies")])
    rows = dealt.withColumn("me", me).withColumns({"before": F.lag("me").over(inside), "is_tail": F.lead("key").over(inside).isNull()})
    tails = rows.where("is_tail").select("range", "me")
    every = Window.orderBy("range")
    whole = every.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    tails = tails.select("range", F.coalesce(F.lag("me").over(every), F.last("me").over(whole)).alias("before"))
    heads = rows.where("before is null").drop("before").join(tails, "range")
    return rows.where("before is not null").select("key", "tie", "before.*").unionByName(heads.select("key", "tie", "before.*"))


def edited_fingerprints(docs: DataFrame, per_range: int = 100_000) -> DataFrame:
    """Fingerprints of each text and of the text with its second half replaced by the start of the next document.

    Returns one row per row of docs: doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next, next_id. The next
    document is that of the next smaller doc_id, after the last the first; null ids come last, and rows of
    one doc_id follow each other by a hash of the text, rows of one doc_id and text in any order. Null texts are empty; without words the
    fingerprint is zeros, like only another such one. A single row is its own next. Only doc_id (of any type that sorts) and text
    are read. An empty table gives an empty result.

    Texts are shuffled once by their own key, 128 bits of hashes of doc_id and text. A text's start, as long as its neighbour needs it, then moves to
    that neighbour; the order is found from ids alone.
    """
    text = F.coalesce("text", F.lit(""))
    named = docs.select("doc_id", text.alias("text"), F.xxhash64(text).alias("tie"), F.xxhash64("doc_id", text).alias("key"))
    ids = named.groupBy("key", "tie").agg(F.max("doc_id").alias("doc_id"), F.max(F.char_length("text")).alias("chars"), F.count(F.lit(1)).alias("copies"))
    before = _next_of(cut(ids, "ids"), per_range)
    rows = named.withColumn("fingerprint", fingerprint(F.col("text"))).withColumn("nth", F.row_number().over(Window.partitionBy("key", "tie").orderBy("key")))
    half = lambda n: F.floor(n / 2).cast("int")
    # a plain nth = 1 would be pushed below the exchange, which both joins share
    given = rows.where((F.col("nth") - 1) == 0).join(before, ["key", "tie"]).select(
        F.col("before_key").alias("key"), F.col("before_tie").alias("tie"), F.substring("text", F.lit(1), half(F.col("before_chars"))).alias("given"),
        F.col("fingerprint").alias("next_print"), F.col("doc_id").alias("next_id"), F.col("before_copies").alias("copies"),
    )
    n = F.char_length("text")
    # of equal rows each but the last is followed by another of them
    last = F.col("nth") == F.col("copies")
    own = {"given": F.when(last, F.col("given")).otherwise(F.substring("text", F.lit(1), half(n))), "next_print": F.when(last, F.col("next_print")).otherwise(F.col("fingerprint")), "next_id": F.when(last, F.col("next_id")).otherwise(F.col("doc_id"))}
    out = rows.join(given, ["key", "tie"]).withColumns(own)
    out = out.select("doc_id", n.cast("long").alias("n_chars"), F.concat(F.substring("text", F.lit(1), n - half(n)), "given").alias("edited"), "fingerprint", "next_print", "next_id")
    out = out.withColumn("edited_fingerprint", fingerprint(F.col("edited")))
    return out.select(
        "doc_id", "n_chars", F.sha2("edited", 256).alias("edited_sha256"), "fingerprint", "edited_fingerprint",
        likeness(F.col("fingerprint"), F.col("edited_fingerprint")).alias("near_edited"), likeness(F.col("fingerprint"), F.col("next_print")).alias("near_next"), "next_id",
    )
