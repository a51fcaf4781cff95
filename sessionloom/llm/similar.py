"""Similarity of word shingles: signatures of least hashes, bands that propose pairs, and signatures and sets that verify them."""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sessionloom.llm.components import components
from sessionloom.llm.shared import Rolling, cut, mixed, text_slices, word_hashes, word_spans

HASHES, BAND, BANDS = 256, 5, 20  # least hashes of a text; of a band; bands
GROUP, ROOM = 4096, 1 << 25  # texts of one key, and bytes of their shingles, that make a share
FEW, LEADS = 16, 64  # texts of a key that are all compared at once; leading texts of a share of a larger one
TASK = 1 << 25  # pairs of tiles that are dealt to a task, about
DOUBT = 0.1  # estimates no further from the similarity than this are settled by the shingles themselves: four standard errors or more


def _functions() -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng(17)
    return rng.integers(0, 1 << 32, HASHES, dtype=np.uint32) | np.uint32(1), rng.integers(0, 1 << 32, HASHES, dtype=np.uint32)


def least_hashes(data: np.ndarray, offsets: np.ndarray, k: int) -> np.ndarray:
    """For each text, by hash function, the least hash of its shingles of k words (all words, if there are fewer). A text without words has zeros."""
    starts, ends, first = word_spans(data, offsets)
    runs = Rolling(word_hashes(data, starts, ends), 0xD1342543DE82EF95)
    counts = np.diff(first)
    out = np.zeros((len(counts), HASHES), np.uint32)
    filled = np.flatnonzero(counts)
    if not len(filled):
        return out
    shingles = np.maximum(counts[filled] - k + 1, 1)
    begin = np.concatenate(([0], np.cumsum(shingles)[:-1]))
    at = np.arange(shingles.sum()) + np.repeat(first[:-1][filled] - begin, shingles)
    size = np.repeat(np.minimum(counts[filled], k), shingles)
    h = runs.of(at, at + size).astype(np.uint32)
    held = np.empty_like(h)
    for j, (a, b) in enumerate(zip(*_functions())):
        np.multiply(h ^ b, a, out=held)
        out[filled, j] = np.minimum.reduceat(held, begin)
    return out


def signatures(docs: DataFrame, k: int) -> DataFrame:
    """tie, keys (one per band) and signature (a byte per hash function) of every row of docs (tie, text), whose A-Z are lower-cased first."""

    def run(batches: Iterator[pa.RecordBatch]):
        for batch in batches:
            for row, data, offsets in text_slices(batch.column("text"), 1 << 18):
                least = least_hashes(np.frombuffer(data.tobytes().lower(), np.uint8), offsets, k)
                keys = np.zeros((len(least), BANDS), np.uint64)
                for band in range(BANDS):
                    key = np.full(len(least), band, np.uint64)
                    for j in range(BAND * band, BAND * band + BAND):
                        key = mixed(key * np.uint64(0xD1342543DE82EF95) + least[:, j])
                    keys[:, band] = key
                codes = (least * np.uint32(0x9E3779B1) >> np.uint32(24)).astype(np.uint8)
                n = len(least)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("tie").slice(row, n), pa.ListArray.from_arrays(pa.array(np.arange(n + 1, dtype=np.int32) * BANDS), pa.array(keys.view(np.int64).ravel())), pa.array([x.tobytes() for x in codes], pa.binary())],
                    ["tie", "keys", "signature"],
                )

    return docs.select("tie", "text").mapInArrow(run, "tie long, keys array<long>, signature binary")


def estimate(equal: np.ndarray) -> np.ndarray:
    """Jaccard similarity from the share of equal bytes of two signatures."""
    return (equal - 1 / 256) / (1 - 1 / 256)


def _led(least: float):
    """Rows (key, share, n, tie, signature), those of a key and share together: links (u, v, estimate) of rows whose estimate is `least` or more. Rows of a key of FEW are
    linked to all of these before them, rows of others to the first of LEADS leading rows, if any; what this leaves open is _crossed's."""

    def run(batches):
        now, leads = None, []
        for batch in batches:
            key, share, n, tie = (batch.column(c).to_numpy() for c in ("key", "share", "n", "tie"))
            body = np.array([np.frombuffer(x.as_py(), np.uint8) for x in batch.column("signature")]).reshape(-1, HASHES)
            u, v, near = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], [np.zeros(0)]
            edges = np.flatnonzero((key[1:] != key[:-1]) | (share[1:] != share[:-1])) + 1 if len(key) else []
            for a, b in zip([0, *edges], [*edges, len(key)]):
                if a == b:
                    continue
                if (key[a], share[a]) != now:
                    now, leads = (key[a], share[a]), []
                few, rest, i = n[a] <= FEW, np.arange(a, b), 0
                while len(rest) and (few or i < LEADS):
                    if i == len(leads):
                        leads.append((tie[rest[0]], body[rest[0]]))
                        rest = rest[1:]
                    found = estimate((body[rest] == leads[i][1]).mean(axis=1))
                    hit = found >= least
                    u.append(tie[rest[hit]])
                    v.append(np.full(hit.sum(), leads[i][0]))
                    near.append(found[hit])
                    rest, i = rest if few else rest[~hit], i + 1
            u, v, near = np.concatenate(u), np.concatenate(v), np.concatenate(near)
            other = u != v
            yield pa.RecordBatch.from_arrays([pa.array(u[other]), pa.array(v[other]), pa.array(near[other])], ["u", "v", "estimate"])

    return run


def _shingle_sets(k: int):
    """tie and the distinct hashes of the shingles of k words of each row (tie, text)."""

    def run(batches):
        for batch in batches:
            for row, data, offsets in text_slices(batch.column("text"), 1 << 18):
                data = np.frombuffer(data.tobytes().lower(), np.uint8)
                starts, ends, first = word_spans(data, offsets)
                runs = Rolling(word_hashes(data, starts, ends), 0xD1342543DE82EF95)
                sets = []
                for a, b in zip(first, first[1:]):
                    at = np.arange(a, max(a + 1, b - k + 1)) if b > a else np.zeros(0, np.int64)
                    sets.append(np.unique(runs.of(at, np.minimum(at + k, b)).view(np.int64)))
                yield pa.RecordBatch.from_arrays([batch.column("tie").slice(row, len(sets)), pa.array(sets, pa.list_(pa.int64()))], ["tie", "shingles"])

    return run


def verified(doubtful: DataFrame, texts: DataFrame, k: int, similarity: float) -> DataFrame:
    """Those of doubtful (u, v) whose sets of shingles have the similarity. texts: tie, text. Only texts of doubtful pairs are made sets."""
    named = doubtful.select(F.explode(F.array("u", "v")).alias("tie")).distinct()
    sets = cut(texts.join(named, "tie", "left_semi").dropDuplicates(["tie"]).select("tie", "text").mapInArrow(_shingle_sets(k), "tie long, shingles array<long>"), "sets")
    both = doubtful.join(sets.select(F.col("tie").alias("u"), F.col("shingles").alias("a")), "u").join(sets.select(F.col("tie").alias("v"), F.col("shingles").alias("b")), "v")
    shared = F.size(F.array_intersect("a", "b"))
    return both.where(shared >= similarity * (F.size("a") + F.size("b") - shared)).select("u", "v")


def _shared(one: np.ndarray, sets: list[np.ndarray]) -> np.ndarray:
    """How many values each of sets has of one; all are sorted and without repeats."""
    sizes = np.array([len(x) for x in sets])
    out = np.zeros(len(sets), np.int64)
    if not len(one) or not sizes.any():
        return out
    values = np.concatenate(sets)
    has = one[np.minimum(np.searchsorted(one, values), len(one) - 1)] == values
    out[sizes > 0] = np.add.reduceat(has.astype(np.int64), (np.cumsum(sizes) - sizes)[sizes > 0])
    return out


def _joined(rows: list[tuple], least: float, sure: float, similarity: float) -> list[tuple[int, int]]:
    """Links (u, v) that connect all rows (side, tie, root, signature, shingles) of a tile which are similar across its sides (among themselves, if it has one)
    and not yet connected by their roots: every such pair is estimated, and those from `least` to `sure` are settled by their shingles."""
    side, tie = np.array([r[0] for r in rows]), np.array([r[1] for r in rows], np.int64)
    body = np.array([np.frombuffer(r[3], np.uint8) for r in rows]).reshape(-1, HASHES)
    label = np.unique(np.array([r[2] for r in rows], np.int64), return_inverse=True)[1]
    one, found = not side.any(), []

    def join(i: int, others: np.ndarray) -> None:
        for c, j in zip(*np.unique(label[others], return_index=True)):
            if c != label[i]:
                found.append((int(tie[i]), int(tie[others[j]])))
                label[label == c] = label[i]

    right = np.flatnonzero(side == 1)
    for i in range(len(rows)) if one else np.flatnonzero(side == 0).tolist():
        others = np.arange(i + 1, len(rows)) if one else right
        others = others[label[others] != label[i]]
        if not len(others):
            continue
        near = estimate(np.count_nonzero(body[others] == body[i], axis=1) / HASHES)
        join(i, others[near >= sure])
        doubt = others[(near >= least) & (near < sure)]
        for a in range(0, len(doubt), 256):
            part = doubt[a : a + 256]
            part = part[label[part] != label[i]]
            if len(part):
                sets = [rows[j][4] for j in part]
                shared = _shared(rows[i][4], sets)
                join(i, part[shared >= similarity * (len(rows[i][4]) + np.array([len(x) for x in sets]) - shared)])
    return found


def _tiles(least: float, sure: float, similarity: float):
    """Reads rows (tile, side, tie, root, signature, shingles), those of a tile together."""

    def made(held):
        links = np.array(_joined(held, least, sure, similarity), np.int64).reshape(-1, 2)
        return pa.RecordBatch.from_arrays([pa.array(links[:, 0]), pa.array(links[:, 1])], ["u", "v"])

    def run(batches):
        now, held = None, []
        for batch in batches:
            tile, shingles = batch.column("tile").to_numpy(), batch.column("shingles")
            others = [batch.column(c).to_pylist() for c in ("side", "tie", "root", "signature")]
            for i, row in enumerate(zip(*others)):
                if tile[i] != now and held:
                    yield made(held)
                    held = []
                now = tile[i]
                held.append((*row, shingles[i].values.to_numpy().copy()))
        if held:
            yield made(held)

    return run


def _crossed(rows: DataFrame, edges: DataFrame, least: float, group: int, texts: DataFrame | None, k: int, similarity: float, room: int) -> DataFrame:
    """Links (u, v) by which texts that share a key and are similar become connected, where edges don't connect them yet. rows: key, n, tie, signature.

    Keys of more than FEW texts, of which not all are connected, are compared whole: their texts are dealt into shares of about `group` texts and `room` bytes of shingles, and every
    two shares meet in a tile, a task's work, so that no pair is left out and no task holds more than two shares. What is connected isn't compared: a large class has shares of its own,
    which don't meet each other. Many texts of a key that are unlike are compared pair by pair.
    """
    roots = components(edges)
    named = rows.where(F.col("n") > FEW).join(roots.withColumnRenamed("node", "tie"), "tie", "left").withColumn("root", F.coalesce("root", "tie"))
    open_ = named.groupBy("key").agg(F.min("root").alias("a"), F.max("root").alias("b")).where("a <> b").select("key")
    named = cut(named.join(open_, "key").select("key", "tie", "root", "signature"), "crossing")
    if named.isEmpty():
        return edges.limit(0)
    sets = named.select("tie").distinct()
    if texts is None:
        sets = sets.withColumn("shingles", F.array().cast("array<long>"))
    else:
        sets = cut(texts.join(sets, "tie", "left_semi").dropDuplicates(["tie"]).select("tie", "text").mapInArrow(_shingle_sets(k), "tie long, shingles array<long>"), "sets")
    named = named.join(sets.select("tie", F.size("shingles").alias("size")), "tie")
    shares = lambda n, size: F.greatest(F.ceil(n / group), F.ceil(size * 8 / room))
    classes = named.groupBy("key", "root").agg(F.count(F.lit(1)).alias("m"), F.sum("size").alias("size"))
    classes = classes.withColumn("own", shares(F.col("m"), F.col("size")))
    others = classes.where("own <= 1").groupBy("key").agg(shares(F.sum("m"), F.sum("size")).alias("all"))
    dealt = named.join(classes.where("own > 1").select("key", "root", "own"), ["key", "root"], "left").join(others, "key", "left")
    share = F.when(F.col("own").isNull(), F.pmod(F.xxhash64("root"), F.greatest("all", F.lit(1)))).otherwise(F.xxhash64("root", F.pmod(F.xxhash64("tie"), F.col("own"))))
    dealt = cut(dealt.select("key", "tie", "root", "signature", share.alias("share"), F.when(F.col("own").isNotNull(), F.col("root")).alias("class")), "shares")
    each = dealt.groupBy("key", "share", "class").agg(F.count(F.lit(1)).alias("m"))
    one, two = (each.select("key", *[F.col(c).alias(f"{c}_{x}") for c in ("share", "class", "m")]) for x in "ab")
    tiles = one.join(two, "key").where("share_a <= share_b and not coalesce(class_a = class_b, false)")
    tiles = cut(tiles.select("key", "share_a", "share_b", F.xxhash64("key", "share_a", "share_b").alias("tile"), (F.col("m_a") * F.col("m_b")).alias("pairs")), "tiles")
    work = tiles.agg(F.coalesce(F.sum("pairs"), F.lit(0))).first()[0]
    sides = [tiles.where(where).select("key", F.col(f"share_{x}").alias("share"), "tile", F.lit(side).alias("side")) for side, x, where in ((0, "a", "true"), (1, "b", "share_a < share_b"))]
    met = dealt.join(sides[0].unionByName(sides[1]), ["key", "share"]).select("tile", "side", "tie", "root", "signature").join(sets, "tie")
    tasks = max(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")), work // TASK)
    met = met.repartition(tasks, "tile").sortWithinPartitions("tile", "side", "tie").select("tile", "side", "tie", "root", "signature", "shingles")
    return cut(met.mapInArrow(_tiles(least, least if texts is None else similarity + DOUBT, similarity), "u long, v long"), "crossed")


def _compared(rows: DataFrame, least: float, group: int, texts: DataFrame | None = None, k: int = 0, similarity: float = 0.0, room: int = ROOM) -> list[DataFrame]:
    """Tables of edges (u, v) that connect all texts that share a key and are similar. rows: key, tie, signature.

    First comes what is near the leading texts of a key's shares, so that copies become one class without pairs among them, then whatever is still unconnected at a key
    (_crossed). Similar is what has an estimate of `least` or more; with texts (tie, text), only what has the similarity too.
    """
    rows = rows.join(rows.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1"), "key")
    dealt = rows.withColumns({"share": F.pmod(F.xxhash64("tie"), F.ceil(F.col("n") / group)).cast("int"), "turn": F.xxhash64("key", "tie")})
    met = dealt.repartition("key", "share").sortWithinPartitions("key", "share", "turn").select("key", "share", "n", "tie", "signature").mapInArrow(_led(least), "u long, v long, estimate double")
    found = cut(met.groupBy("u", "v").agg(F.max("estimate").alias("estimate")), "found")
    edges = found.select("u", "v")
    if texts is not None:
        sure = F.col("estimate") >= similarity + DOUBT
        edges = cut(found.where(sure).select("u", "v").unionByName(verified(found.where(~sure).select("u", "v"), texts, k, similarity)), "led")
    return [edges, _crossed(rows, edges, least, group, texts, k, similarity, room)]


def links(prints: DataFrame, pairs: DataFrame, texts: DataFrame, k: int, similarity: float, group: int = GROUP, room: int = ROOM) -> DataFrame:
    """Edges (u, v) between texts (tie, text) of a similarity or more. prints: tie, keys, signature, one row per text; pairs (u, v): proposals beside the keys'.

    All similar texts that share a key become connected. Signatures settle what is further than DOUBT from the similarity, the shingles themselves the rest.
    """
    proposed = pairs.select(F.xxhash64("u", "v").alias("key"), F.explode(F.array("u", "v")).alias("tie"))
    members = prints.select(F.explode("keys").alias("key"), "tie").unionByName(proposed)
    shared = members.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("key")
    rows = members.join(shared, "key").join(prints.select("tie", "signature"), "tie")
    return reduce(DataFrame.unionByName, _compared(rows.select("key", "tie", "signature"), similarity - DOUBT, group, texts, k, similarity, room))
