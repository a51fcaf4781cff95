"""Exact deduplication by recipes of content-defined chunks."""

from __future__ import annotations

import hashlib
from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from sessionloom.llm.shared import cut, lower_ascii, text_slices

LEAST, MOST, SPARSE = 512, 8192, 10  # bytes of a chunk, and the zero bits that end one


def _cuts(data: np.ndarray, offsets: np.ndarray, gear: np.ndarray) -> list[list[int]]:
    """For each text the ends of its chunks: a chunk ends where the rolling hash of 32 bytes has SPARSE leading zeros."""
    h = gear[data]
    for s in (1, 2, 4, 8, 16):
        more = h.copy()
        more[s:] += h[:-s] << np.uint32(s)
        h = more
    ends = (np.flatnonzero(h >> np.uint32(32 - SPARSE) == 0) + 1).tolist()
    out = []
    for start, stop in zip(offsets[:-1].tolist(), offsets[1:].tolist()):
        at, own = start, []
        while at < stop:
            i = bisect_left(ends, at + LEAST)
            at = min(ends[i] if i < len(ends) else stop, at + MOST, stop)
            own.append(at)
        out.append(own)
    return out


def _walk(batches: Iterator[pa.RecordBatch], bits: int):
    """(doc_ids, row, normalised text, [(key, chunk)]) of every row. Chunks are found in the text with A-Z lower-cased."""
    gear = np.random.default_rng(9).integers(0, 1 << 32, 256, dtype=np.uint32)
    mask = (1 << bits) - 1
    for batch in batches:
        for first, data, offsets in text_slices(batch.column("text")):
            body = data.tobytes().lower()
            for i, ends in enumerate(_cuts(np.frombuffer(body, np.uint8), offsets, gear)):
                parts = [body[a:b] for a, b in zip([int(offsets[i]), *ends], ends)]
                keys = [xxhash.xxh64_intdigest(p) & mask for p in parts]
                yield batch, first + i, body[offsets[i] : offsets[i + 1]], [(k - (1 << 64) if k >> 63 else k, p) for k, p in zip(keys, parts)]


def _recipes(bits: int):
    def run(batches):
        rows, held = [], None
        schema = None
        for batch, row, text, parts in _walk(batches, bits):
            if held is not batch and rows:
                yield pa.RecordBatch.from_pylist(rows, schema)
                rows = []
            held = batch
            schema = pa.schema([("doc_id", batch.schema.field("doc_id").type), ("text_sha256", pa.string()), ("recipe", pa.list_(pa.int64()))])
            rows.append({"doc_id": batch.column("doc_id")[row].as_py(), "text_sha256": hashlib.sha256(text).hexdigest(), "recipe": [k for k, _ in parts]})
        if rows:
            yield pa.RecordBatch.from_pylist(rows, schema)

    return run


def _chunks(bits: int):
    def run(batches):
        keys, chunks, n = [], [], 0
        for _, _, _, parts in _walk(batches, bits):
            for k, p in parts:
                keys.append(k)
                chunks.append(p)
                n += len(p)
            if n > 1 << 22:
                yield pa.RecordBatch.from_arrays([pa.array(keys, pa.int64()), pa.array(chunks, pa.binary())], ["key", "chunk"])
                keys, chunks, n = [], [], 0
        if keys:
            yield pa.RecordBatch.from_arrays([pa.array(keys, pa.int64()), pa.array(chunks, pa.binary())], ["key", "chunk"])

    return run


def _told_apart(docs: DataFrame, recipes: DataFrame, clash: DataFrame, bits: int) -> DataFrame:
    """Recipes in which the chunks of a clashing key also carry the rank of their text among that key's texts."""

    def run(batches):
        for batch, row, text, parts in _walk(batches, bits):
            sha = hashlib.sha256(text).hexdigest()
            yield pa.RecordBatch.from_arrays(
                [pa.array([sha] * len(parts), pa.string()), pa.array(range(len(parts)), pa.int32()), pa.array([k for k, _ in parts], pa.int64()), pa.array([p for _, p in parts], pa.binary())],
                ["text_sha256", "pos", "key", "chunk"],
            )

    own = docs.select("doc_id", "text").mapInArrow(run, "text_sha256 string, pos int, key long, chunk binary").join(clash, "key", "left_semi").dropDuplicates(["text_sha256", "pos"])
    ranks = own.select("key", "chunk").distinct().withColumn("rank", F.row_number().over(Window.partitionBy("key").orderBy("chunk")))
    marks = own.join(ranks, ["key", "chunk"]).groupBy("text_sha256").agg(F.array_sort(F.collect_list(F.struct("pos", "rank"))).alias("m"))
    marks = marks.select("text_sha256", F.transform("m", lambda x: x["rank"]).alias("marks"))
    return recipes.join(marks, "text_sha256", "left").withColumn("marks", F.coalesce("marks", F.array().cast("array<int>")))


def exact_groups(docs: DataFrame, key_bits: int = 64) -> DataFrame:
    """Groups of texts that are identical after lower-casing A-Z.

    Returns one row per row of docs: doc_id, keep_id, group_size, kept, text_sha256. Of equal texts the
    row with the largest doc_id stays (null counts as smallest; of repeated rows with that doc_id exactly
    one stays). A null text is empty; an empty text has the empty recipe. Other columns are not read, so
    their names cannot clash. An empty table gives an empty result.

    Texts are cut into content-defined chunks. Each distinct chunk text is shuffled once, to prove that
    its 64-bit key stands for one text only; where a key stands for several, their rank tells them apart.
    After that only recipes, the ordered lists of verified identifiers, are grouped and compared.
    key_bits: of the chunk key; tests lower it to force clashes.
    """
    docs = docs.select("doc_id", "text")
    id_type = docs.schema["doc_id"].dataType.simpleString()
    recipes = docs.mapInArrow(_recipes(key_bits), f"doc_id {id_type}, text_sha256 string, recipe array<long>")
    recipes = cut(recipes.withColumn("row", F.monotonically_increasing_id()), "recipes")
    texts = docs.select("text", "doc_id").mapInArrow(_chunks(key_bits), "key long, chunk binary").distinct()
    clash = cut(texts.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("key"), "clash")
    if clash.isEmpty():
        recipes = recipes.withColumn("marks", F.array().cast("array<int>"))
    else:
        recipes = _told_apart(docs, recipes, clash, key_bits)
    groups = recipes.groupBy("recipe", "marks").agg(F.max(F.struct("doc_id", "row")).alias("best"), F.count(F.lit(1)).alias("group_size"))
    return recipes.join(groups, ["recipe", "marks"]).select(
        "doc_id", F.col("best.doc_id").alias("keep_id"), "group_size", (F.col("row") == F.col("best.row")).alias("kept"), "text_sha256"
    )


def without_copies(docs: DataFrame) -> DataFrame:
    """The rows of docs that exact_groups keeps, with all their columns: one of each group of equal texts."""
    kept = exact_groups(docs).where("kept").select(F.col("doc_id").alias("__kept_id"), F.col("text_sha256").alias("__kept_sha"))
    sha = F.sha2(lower_ascii(F.coalesce("text", F.lit(""))), 256)
    found = docs.withColumn("__kept_sha", sha).alias("d").join(kept.alias("k"), F.col("d.doc_id").eqNullSafe(F.col("k.__kept_id")) & (F.col("d.__kept_sha") == F.col("k.__kept_sha"))).drop(F.col("d.__kept_sha"))
    # rows may repeat a doc_id with the same text
    return found.withColumn("__nth", F.row_number().over(Window.partitionBy("__kept_id", "__kept_sha").orderBy("text"))).where("__nth = 1").select(*docs.columns)
