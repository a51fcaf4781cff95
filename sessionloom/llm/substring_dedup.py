"""Substring deduplication by seed and extend: winnowed anchors, extended both ways to repeats of a fixed length or more."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sessionloom.llm.shared import Rolling, cut, text_slices, word_hashes, word_spans

LENGTH, SEED = 50, 16  # words of a window, and of an anchor
SLICE = 1 << 20
SHARE = 128  # contexts of one anchor that a task extends


class Words:
    """Words of a slice of texts, hashes of their runs, and the texts with one space after each word."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray):
        starts, ends, self.first = word_spans(data, offsets)
        self.runs = Rolling(word_hashes(data, starts, ends), 0xD1342543DE82EF95)
        self.counts = np.diff(self.first)
        self.text = np.repeat(np.arange(len(self.counts)), self.counts)
        lengths = ends - starts
        self.at = np.concatenate(([0], np.cumsum(lengths + 1)))
        spaced = np.full(self.at[-1], 32, np.uint8)
        spaced[np.arange(int(lengths.sum())) + np.repeat(np.arange(len(starts)), lengths)] = data[np.arange(int(lengths.sum())) + np.repeat(starts - np.cumsum(lengths) + lengths, lengths)]
        self.spaced = spaced.tobytes()

    def runs_of(self, lo: np.ndarray, hi: np.ndarray) -> list[bytes]:
        """The texts of runs of words, joined by single spaces."""
        return [self.spaced[a:b] for a, b in zip(self.at[lo].tolist(), (self.at[hi] - 1).tolist())]


def anchors(words: Words, length: int, seed: int) -> np.ndarray:
    """Places of the winnowed anchors: each run of `length` words holds the last least of its grams of `seed` words."""
    total, reach = len(words.text), length - seed + 1
    if total < length:
        return np.zeros(0, np.int64)
    at = np.arange(total - seed + 1)
    grams, place = words.runs.of(at, at + seed), at

    def later(i: np.ndarray, j: np.ndarray) -> np.ndarray:
        return np.where(grams[j] <= grams[i], j, i)

    span = 1
    while 2 * span <= reach:
        place = later(place[:-span], place[span:])
        span *= 2
    if span < reach:
        place = later(place[: -(reach - span)], place[reach - span :])
    whole = np.arange(total - length + 1)
    whole = whole[words.text[whole] == words.text[whole + length - 1]]
    return np.unique(place[whole])


def _context(words: Words, at: np.ndarray, length: int, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """First and end of all windows that hold the anchor."""
    text = words.text[at]
    return np.maximum(words.first[text], at - (length - seed)), np.minimum(words.first[text + 1], at + length)


def _seeds(length: int, seed: int):
    def run(batches: Iterator[pa.RecordBatch]):
        for batch in batches:
            ties = batch.column("tie").to_numpy()
            for row, data, offsets in text_slices(batch.column("text"), SLICE):
                words = Words(data, offsets)
                at = anchors(words, length, seed)
                text = words.text[at]
                lo, hi = _context(words, at, length, seed)
                context = [xxhash.xxh3_64_intdigest(x, k) for x, k in zip(words.runs_of(lo, hi), (at - lo).tolist())]
                ids = batch.column("doc_id").take(pa.array(text + row))
                where = (ties[text + row] << 32) | (at - words.first[text])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(words.runs.of(at, at + seed).view(np.int64)), pa.array(np.array(context, np.uint64).view(np.int64)), ids, pa.array(where), pa.array((at - lo).astype(np.int16)), pa.array((hi - at).astype(np.int16))],
                    ["anchor", "context", "doc_id", "place", "ahead", "behind"],
                )

    return run


CHOSEN = ["anchor", "context", "contexts", "leads"]


def _context_texts(length: int, seed: int):
    """The contexts of the anchors named in `chosen`, as text."""

    def run(batches):
        for batch in batches:
            batch = batch.filter(pc.greater(pc.list_value_length(batch.column("chosen")), 0))
            for row, data, offsets in text_slices(batch.column("text"), SLICE):
                words = Words(data, offsets)
                own = batch.column("chosen").slice(row, len(offsets) - 1)
                flat, text = own.flatten(), np.repeat(np.arange(len(own)), own.value_lengths().to_numpy())
                at = (flat.field("place").to_numpy() & 0xFFFFFFFF) + words.first[text]
                lo, hi = _context(words, at, length, seed)
                columns = {c: flat.field(c) for c in CHOSEN} | {"doc_id": batch.column("doc_id").take(pa.array(text + row)), "ahead": pa.array(at - lo), "body": pa.array(words.runs_of(lo, hi), pa.binary())}
                yield pa.RecordBatch.from_arrays(list(columns.values()), list(columns))

    return run


def _equal(a: list[bytes], b: list[bytes]) -> int:
    n = 0
    for x, y in zip(a, b):
        if x != y:
            break
        n += 1
    return n


def _extended(length: int, seed: int):
    """Contexts of an anchor, the leading one first, which each of the others is matched with from the anchor outwards, word by word.

    Matches of `length` words or more are emitted (other: the document matched). Where the anchor has three contexts or more, so are the windows that the
    match doesn't cover: these differ from the leading context's, but others may have them.
    """

    def run(batches):
        anchor, lead, lead_at, lead_id = None, None, None, None
        for batch in batches:
            ids, kind = batch.column("doc_id"), batch.schema.field("doc_id").type
            rows = zip(*(batch.column(c).to_pylist() for c in (*CHOSEN, "ahead", "body")))
            out, of, other = [], [], []
            for j, (key, context, contexts, leads, at, body) in enumerate(rows):
                words = body.split(b" ")
                if leads:
                    anchor, lead, lead_at, lead_id = key, words, at, ids[j]
                    continue
                lo = hi = at
                if key == anchor and words[at : at + seed] == lead[lead_at : lead_at + seed]:
                    lo = at - _equal(words[:at][::-1], lead[:lead_at][::-1])
                    hi = at + seed + _equal(words[at + seed :], lead[lead_at + seed :])
                    if hi - lo >= length:
                        out.append((key, context, lo, hi, key ^ context, 0))
                        of.append(j)
                        other.append(lead_id)
                if contexts > 2:
                    for k in range(len(words) - length + 1):
                        if k < lo or k + length > hi:
                            w = xxhash.xxh3_128_intdigest(b" ".join(words[k : k + length]))
                            out.append((key, context, k, k + length, (w >> 64) - (1 << 63), (w & (1 << 64) - 1) - (1 << 63)))
                            of.append(j)
                            other.append(None)
            columns = [pa.array(c, t) for c, t in zip(zip(*out), (pa.int64(), pa.int64(), pa.int16(), pa.int16(), pa.int64(), pa.int64()))] if out else [pa.array([], t) for t in (pa.int64(), pa.int64(), pa.int16(), pa.int16(), pa.int64(), pa.int64())]
            yield pa.RecordBatch.from_arrays([*columns, ids.take(pa.array(of, pa.int64())), pa.array([None if x is None else x.as_py() for x in other], kind)], ["anchor", "context", "lo", "hi", "w1", "w2", "doc_id", "other"])

    return run


def _kept(batches):
    for batch in batches:
        lists = batch.column("spans")
        n_words, n_removed, kept, sha = [], [], [], []
        for row, data, offsets in text_slices(batch.column("text"), SLICE):
            starts, ends, first = word_spans(data, offsets)
            body = data.tobytes()
            for i in range(len(offsets) - 1):
                n = int(first[i + 1] - first[i])
                spans = lists[row + i].values
                step = np.zeros(n + 1, np.int64)
                if spans is not None and len(spans):
                    np.add.at(step, spans.field("lo").to_numpy(), 1)
                    np.add.at(step, np.minimum(spans.field("hi").to_numpy(), n), -1)
                stay = np.flatnonzero(np.cumsum(step[:n]) == 0) + first[i]
                text = b" ".join([body[a:b] for a, b in zip(starts[stay].tolist(), ends[stay].tolist())])
                n_words.append(n)
                n_removed.append(n - len(stay))
                kept.append(text.decode())
                sha.append(hashlib.sha256(text).hexdigest())
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), pa.array(n_words, pa.int64()), pa.array(n_removed, pa.int64()), pa.array(kept, pa.string()), pa.array(sha, pa.string())],
            ["doc_id", "n_words", "n_removed", "kept_text", "kept_sha256"],
        )


def without_repeats(docs: DataFrame, length: int = LENGTH, seed: int = SEED) -> DataFrame:
    """Remove every word that a window of `length` words covers whose sequence also starts in a document of a smaller doc_id.

    Returns one row per row of docs: doc_id, n_words, n_removed, kept_text (kept words joined by one space), kept_sha256.
    Windows are judged on the input. Null texts have no words; texts shorter than a window keep all. Rows
    of null doc_id are neither smaller nor larger than any other: they keep all words. Rows that share a doc_id
    don't remove each other's words. Other columns aren't read. An empty table gives an empty result.

    Each window holds a winnowed anchor at the same place in all documents, so documents are joined on anchors. Those that agree in an
    anchor's whole context (all windows around it) are covered by it but for the smallest, which stands for them. Where an anchor has several contexts, each
    is joined with the leading one (of the smallest document) and extended both ways, word by word, to the maximal match; what such
    matches leave open between three contexts or more is settled by grouping the open windows. Repeats are
    the unions of what is found. Contexts and windows are the same if hashes of their words (XXH3, besides the anchor's) are; matches compare the words.
    """
    kind = docs.schema["doc_id"].dataType.simpleString()
    tied = docs.select("doc_id", "text", (F.xxhash64("text").bitwiseAND(F.lit(0x7FFFFFFF))).alias("tie"))
    seeds = tied.where("doc_id is not null").mapInArrow(_seeds(length, seed), f"anchor long, context long, doc_id {kind}, place long, ahead short, behind short")
    contexts = cut(seeds.groupBy("anchor", "context").agg(F.min("doc_id").alias("least"), F.max("doc_id").alias("most")), "contexts")
    several = contexts.groupBy("anchor").agg(F.count(F.lit(1)).alias("contexts"), F.min("least").alias("first_id")).where("contexts > 1")
    # contexts that have something to compare: with others of the anchor, or among themselves
    live = contexts.join(several, "anchor", "left").where("contexts > 1 or least < most").select("anchor", "context", "least", F.coalesce("contexts", F.lit(1)).alias("contexts"), (F.col("least") == F.col("first_id")).alias("may_lead"))
    found = seeds.join(live, ["anchor", "context"]).where("doc_id > least or contexts > 1")
    found = cut(found.select("anchor", "context", "doc_id", "place", "ahead", "behind", "contexts", "may_lead", (F.col("doc_id") > F.col("least")).alias("same")), "found")
    pos = F.col("place").bitwiseAND(F.lit(0xFFFFFFFF))
    tie = F.shiftright("place", 32)
    span = lambda lo, hi: ["doc_id", tie.alias("tie"), lo.cast("int").alias("lo"), hi.cast("int").alias("hi")]
    whole = found.where("same").select(*span(pos - F.col("ahead"), pos + F.col("behind")))
    open_places = found.where("not same and contexts > 1")
    leads = cut(open_places.where("may_lead").groupBy("anchor").agg(F.min("context").alias("lead")), "leads")
    chosen = open_places.groupBy("anchor", "context", "doc_id").agg(F.min("place").alias("place"), F.max("contexts").alias("contexts")).join(leads, "anchor")
    chosen = chosen.select("doc_id", tie.alias("tie"), F.struct("anchor", "context", "contexts", (F.col("context") == F.col("lead")).alias("leads"), "place").alias("c"))
    chosen = chosen.groupBy("doc_id", "tie").agg(F.collect_list("c").alias("chosen"))
    # both joins with the texts are left joins on the same columns and belong to one job, so that the texts are shuffled once for both
    none = F.array().cast("array<struct<anchor:bigint,context:bigint,contexts:bigint,leads:boolean,place:bigint>>")
    with_chosen = tied.join(chosen, ["doc_id", "tie"], "left").select("doc_id", "text", F.coalesce("chosen", none).alias("chosen"))
    bodies = with_chosen.mapInArrow(_context_texts(length, seed), f"anchor long, context long, contexts long, leads boolean, doc_id {kind}, ahead long, body binary")
    # the leading context goes to every share of the others
    shares = F.ceil(F.col("contexts") / SHARE).cast("int")
    share = F.when(F.col("leads"), F.sequence(F.lit(0), shares - 1)).otherwise(F.array(F.pmod(F.xxhash64("context"), shares).cast("int")))
    dealt = bodies.withColumn("share", F.explode(share)).repartition("anchor", "share").sortWithinPartitions("anchor", "share", F.desc("leads"))
    rows = dealt.mapInArrow(_extended(length, seed), f"anchor long, context long, lo short, hi short, w1 long, w2 long, doc_id {kind}, other {kind}")
    firsts = rows.where("other is null").groupBy("w1", "w2").agg(F.min("doc_id").alias("least"), F.max("doc_id").alias("most")).where("least < most").drop("most")
    covered = rows.join(firsts, ["w1", "w2"], "left").where(F.coalesce("other", "least") < F.col("doc_id")).select("anchor", "context", "lo", "hi")
    again = open_places.join(covered, ["anchor", "context"]).select(*span(pos - F.col("ahead") + F.col("lo"), pos - F.col("ahead") + F.col("hi")))
    spans = whole.unionByName(again).groupBy("doc_id", "tie").agg(F.collect_list(F.struct("lo", "hi")).alias("spans"))
    joined = tied.join(spans, ["doc_id", "tie"], "left").select("doc_id", "text", F.coalesce("spans", F.array().cast("array<struct<lo:int,hi:int>>")).alias("spans"))
    return joined.mapInArrow(_kept, f"doc_id {kind}, n_words long, n_removed long, kept_text string, kept_sha256 string")
