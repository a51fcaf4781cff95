"""SimHash near-deduplication by meet-in-the-middle ball hashing."""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sessionloom.llm import similar
from sessionloom.llm.components import components
from sessionloom.llm.shared import cut, text_slices

LEVELS = (16, 24, 32, 48, 64)  # leading bits of a variant by which it is dealt; later ones for places that hold too much
ROOM = 1 << 22  # variants of a place that a task holds at a time
TASK = 1 << 25  # variants that are dealt to a task, about
LARGE = 1024  # a group of more than this part of all fingerprints is large


def simhash(text: bytes, k: int) -> int:
    """Fingerprint of a text whose A-Z are lower-cased; zero if it has no word."""
    words = text.split()
    if not words:
        return 0
    if len(words) <= k:
        shingles = [b" ".join(words)]
    else:
        body = b" ".join(words)
        ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
        starts = np.concatenate(([0], ends[:-1] + 1))
        shingles = [body[a:b] for a, b in zip(starts.tolist(), ends[k - 1 :].tolist())]
    h = np.fromiter((xxhash.xxh64_intdigest(s, 42) for s in shingles), np.uint64, len(shingles))
    counts = np.zeros(64, np.int64)
    for part in np.split(h, range(4096, len(h), 4096)):
        counts += np.unpackbits(part.view(np.uint8), bitorder="little").reshape(-1, 64).sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * counts > len(h), bitorder="little").view(np.uint64)[0])


def fingerprints(docs: DataFrame, k: int = 4) -> DataFrame:
    """doc_id, tie (a hash of the text as it is) and fp (the 64 bits as a signed long) of every row; a null text has no word."""

    def run(batches: Iterator[pa.RecordBatch]):
        for batch in batches:
            fps = []
            for _, data, offsets in text_slices(batch.column("text")):
                body = data.tobytes().lower()
                fps += [simhash(body[a:b], k) for a, b in zip(offsets[:-1], offsets[1:])]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("tie"), pa.array(np.array(fps, np.uint64).view(np.int64))], ["doc_id", "tie", "fp"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", F.xxhash64("text").alias("tie"), "text").mapInArrow(run, f"doc_id {kind}, tie long, fp long")


def _flips(bits: int, most: int) -> np.ndarray:
    """All masks of up to `most` of the low `bits` bits, the empty one first."""
    return np.array([sum(1 << b for b in flip) for n in range(most + 1) for flip in combinations(range(bits), n)], np.uint64)


def _spent(place: np.ndarray, fp: np.ndarray, bits: int) -> np.ndarray:
    """How many of the leading `bits` bits of a fingerprint are flipped to be at its place."""
    return np.bitwise_count(place ^ (fp >> np.uint64(64 - bits))) if bits else np.zeros(len(fp), np.uint8)


def deal(rows: DataFrame, before: int, bits: int, half: int) -> DataFrame:
    """(place, fp) for every place that holds a variant of fp within `half` flips; place is the variant's leading `bits` bits.

    rows are (place, fp) of the places of `before` bits, which are split; before=0 is the one place that holds all.
    """
    more = bits - before

    def run(batches):
        flips = [_flips(more, half - d) for d in range(half + 1)]
        for batch in batches:
            place, fp = (batch.column(c).to_numpy().view(np.uint64) for c in ("place", "fp"))
            spent = _spent(place, fp, before)
            own = (fp >> np.uint64(64 - bits)) & np.uint64((1 << more) - 1)
            if before:
                own |= place << np.uint64(more)
            for d, masks in enumerate(flips):
                at = np.flatnonzero(spent == d)
                for part in np.split(at, range(1024, len(at), 1024)):
                    places = own[part][:, None] ^ masks
                    yield pa.RecordBatch.from_arrays([pa.array(places.ravel().view(np.int64)), pa.array(np.repeat(fp[part], len(masks)).view(np.int64))], ["place", "fp"])

    return rows.mapInArrow(run, "place long, fp long")


def _collisions(bits: int, half: int, radius: int, room: int):
    """Reads (place, fp) in order and emits all variants at each place; fingerprints that share one link to its first.

    A place of more than `room` variants is not worked on: its rows are passed on, with the place, to be dealt by more bits.
    """
    names = ["u", "v", "place"]

    def passed(place, fp):
        return pa.RecordBatch.from_arrays([pa.array(fp), pa.array(fp), pa.array(place)], names)

    def met(place, fp, spent, flips):
        low = np.uint64(64 - bits)
        own = (place.view(np.uint64) << low) | (fp.view(np.uint64) & np.uint64((1 << (64 - bits)) - 1))
        at = [np.flatnonzero(spent == d) for d in range(half + 1)]
        variant = np.concatenate([(own[i][:, None] ^ masks).ravel() for i, masks in zip(at, flips)])
        row = np.concatenate([np.repeat(i.astype(np.int32), len(masks)) for i, masks in zip(at, flips)])
        order = np.argsort(variant)
        variant, row = variant[order], row[order]
        starts = np.flatnonzero(np.concatenate(([True], variant[1:] != variant[:-1])))
        first = np.repeat(np.minimum.reduceat(row, starts), np.diff(np.append(starts, len(row))))
        shared = row != first
        pairs = np.unique(row[shared].astype(np.int64) << 32 | first[shared])
        u, v = fp[pairs >> 32], fp[pairs & 0xFFFFFFFF]
        near = np.bitwise_count((u ^ v).view(np.uint64)) <= radius
        return pa.RecordBatch.from_arrays([pa.array(u[near]), pa.array(v[near]), pa.nulls(int(near.sum()), pa.int64())], names)

    def whole(place, fp, flips):
        """Rows of whole places, in runs of places of about a quarter of `room` variants."""
        if not len(fp):
            return
        spent = _spent(place.view(np.uint64), fp.view(np.uint64), bits)
        starts = np.flatnonzero(np.concatenate(([True], place[1:] != place[:-1])))
        sizes = np.diff(np.append(starts, len(fp)))
        held = np.add.reduceat(np.array([len(f) for f in flips])[spent], starts)
        full = np.repeat(held > room, sizes)
        if full.any():
            yield passed(place[full], fp[full])
        turn = np.repeat(np.cumsum(np.where(held > room, 0, held)) // max(room // 4, 1), sizes)[~full]
        place, fp, spent = place[~full], fp[~full], spent[~full]
        ends = np.flatnonzero(turn[1:] != turn[:-1]) + 1
        for i, j in zip([0, *ends], [*ends, len(fp)]):
            if i < j:
                yield met(place[i:j], fp[i:j], spent[i:j], flips)

    def run(batches):
        flips = [_flips(64 - bits, half - d) for d in range(half + 1)]
        place, fp, full = np.zeros(0, np.int64), np.zeros(0, np.int64), None
        for batch in batches:
            p, f = batch.column("place").to_numpy(), batch.column("fp").to_numpy()
            if full is not None:
                same = p == full
                yield passed(p[same], f[same])
                p, f = p[~same], f[~same]
            place, fp = np.concatenate((place, p)), np.concatenate((fp, f))
            if not len(fp):
                continue
            last = int(np.argmax(place == place[-1]))
            yield from whole(place[:last], fp[:last], flips)
            place, fp, full = place[last:], fp[last:], None
            if len(fp) > room:
                full = place[-1]
                yield passed(place, fp)
                place, fp = place[:0], fp[:0]
        yield from whole(place, fp, flips)

    return run


def _variants_met(batches):
    """(fp, first fp of the variant) of whole variants, read in order; a variant of any size passes as a stream."""
    last, first = None, None
    for batch in batches:
        place, fp = batch.column("place").to_numpy(), batch.column("fp").to_numpy()
        if not len(fp):
            continue
        starts = np.flatnonzero(np.concatenate(([place[0] != last], place[1:] != place[:-1])))
        firsts = np.full(len(fp), fp[0] if last is None else first, np.int64)
        if len(starts):
            firsts[starts[0] :] = np.repeat(fp[starts], np.diff(np.append(starts, len(fp))))
        last, first = place[-1], firsts[-1]
        pairs = np.unique(np.stack((fp, firsts))[:, fp != firsts], axis=1)
        yield pa.RecordBatch.from_arrays([pa.array(pairs[0]), pa.array(pairs[1])], ["u", "v"])


def links(fps: DataFrame, radius: int = 4, levels: tuple[int, ...] = LEVELS, room: int = ROOM) -> DataFrame:
    """Edges (u, v), u > v, over distinct fingerprints (fp): every pair within the radius is linked, directly or by a path of such pairs.

    A fingerprint has a variant for every flip of up to half the radius (2081 of them at radius 4). Variants are dealt by
    their leading levels[0] bits, and a place gets each fingerprint once for all of its variants there (137 rows each
    instead of 2081) and emits them. Two fingerprints within the radius share a variant, and two that share one
    are within the radius; so all of a variant link to its first, with no pairs within a group. A place of more than
    `room` variants is dealt again by the bits of the next level; at 64 bits a place is one variant, read as a stream. Levels
    whose places would hold more than that on average are left out from the start (beyond 132 million fingerprints the first).
    """
    if radius % 2 or radius < 0:
        raise ValueError("the radius must be even: both sides flip up to half of it")
    if not levels or levels[-1] != 64 or list(levels) != sorted(set(levels)):
        raise ValueError("levels must rise to 64")
    half = radius // 2
    held = fps.count() * len(_flips(64, half))
    # few bytes become many: as many tasks as a shuffle has or as the variants need, not as few as the bytes would get
    tasks = max(int(fps.sparkSession.conf.get("spark.sql.shuffle.partitions")), held // TASK)
    levels = [b for b in levels if b == 64 or held >> b <= room]
    rows, before, found = fps.select(F.lit(0).cast("long").alias("place"), "fp"), 0, []
    for bits in levels:
        dealt = deal(rows.repartition(tasks, F.xxhash64("fp")), before, bits, half).repartition(tasks, "place").sortWithinPartitions("place", "fp")
        if bits == 64:
            found.append(dealt.mapInArrow(_variants_met, "u long, v long").distinct())
            break
        out = cut(dealt.mapInArrow(_collisions(bits, half, radius, room), "u long, v long, place long").distinct(), "pairs")
        found.append(out.where("place is null").select("u", "v"))
        rows, before = out.where("place is not null").select("place", F.col("u").alias("fp")), bits
        if rows.isEmpty():
            break
    return reduce(DataFrame.unionByName, found)


def near_groups(docs: DataFrame, k: int = 4, radius: int = 4, levels: tuple[int, ...] = LEVELS, room: int = ROOM) -> DataFrame:
    """SimHash fingerprints of whole texts and the groups that near fingerprints link.

    Returns one row per row of docs: doc_id, fingerprint (16 hex digits), component_id (the smallest doc_id
    reachable over fingerprints of `radius` or fewer differing bits, its own included), tie (xxhash64 of the text),
    kept (true for the row that stands for its group: that of the smallest doc_id, then tie). A null or empty text
    has fingerprint zero, linked like any other. A null doc_id never is a component_id unless all are null. Repeated
    rows stay. Other columns are not read. An empty table gives an empty result. The radius is even;
    levels and room: see links.
    """
    fps = cut(fingerprints(docs, k), "fingerprints")
    edges = links(fps.select("fp").distinct(), radius, levels, room)
    return grouped(fps.withColumn("node", F.col("fp")), edges).select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id", "tie", "kept")


def grouped(rows: DataFrame, edges: DataFrame) -> DataFrame:
    """rows (doc_id, tie, node) with component_id, the smallest doc_id of the nodes that edges (u, v) connect, and kept, true for that row."""
    first = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "tie")
    classes = rows.groupBy("node").agg(F.min(first).alias("least"))
    roots = cut(components(edges), "roots").withColumnRenamed("node", "_node")
    rooted = cut(classes.join(roots, F.col("node") == F.col("_node"), "left").select("node", F.coalesce("root", "node").alias("root"), "least"), "rooted")
    least = cut(rooted.groupBy("root").agg(F.min("least").alias("best"), F.count(F.lit(1)).alias("n")), "least")
    # fewer than LARGE groups can hold more than that share of all: they are broadcast, so that none of them meets in a task
    large = F.broadcast(least.where(F.col("n") * LARGE > rooted.count()))
    named = rooted.join(large, "root").select("node", "best").unionByName(
        rooted.join(large.select("root"), "root", "left_anti").join(least, "root").select("node", "best")
    )
    kept = F.col("doc_id").eqNullSafe(F.col("best.doc_id")) & F.col("tie").eqNullSafe(F.col("best.tie"))
    return rows.join(named, "node").withColumns({"component_id": F.col("best.doc_id"), "kept": kept})


def similar_groups(docs: DataFrame, k: int = 5, similarity: float = 0.8, radius: int = 4, group: int = similar.GROUP) -> DataFrame:
    """Groups of texts whose shingles of k words have a Jaccard similarity of `similarity` or more, over chains of such pairs.

    Returns one row per row of docs: doc_id, tie, component_id, kept, as near_groups does, and with its cases; texts without words are alike. Fingerprints
    within the radius propose pairs by ball hashing. Few pairs of that similarity have such near fingerprints, so bands of least hashes propose
    too. All proposals are verified, by signatures of 256 bytes where their estimate is clear and else by the sets of shingles.
    """
    texts = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).withColumn("tie", F.xxhash64("text"))
    prints = cut(similar.signatures(texts, k).distinct(), "signatures")
    fps = cut(fingerprints(docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")), k), "fingerprints")
    reps = cut(fps.groupBy("fp").agg(F.min("tie").alias("rep")), "reps")
    near = links(reps.select("fp"), radius)
    near = near.join(reps.select(F.col("fp").alias("u"), F.col("rep").alias("a")), "u").join(reps.select(F.col("fp").alias("v"), F.col("rep").alias("b")), "v")
    same = fps.join(reps, "fp").where("tie <> rep").select(F.col("tie").alias("u"), F.col("rep").alias("v")).distinct()
    pairs = near.select(F.col("a").alias("u"), F.col("b").alias("v")).unionByName(same)
    edges = similar.links(prints, pairs, texts.select("tie", "text"), k, similarity, group)
    return grouped(fps.withColumn("node", F.col("tie")), edges).select("doc_id", "tie", "component_id", "kept")


def first_of_groups(docs: DataFrame, k: int = 5, similarity: float = 0.8, radius: int = 4) -> DataFrame:
    """The rows of docs that similar_groups keeps: one document of each group, identical rows of it included."""
    text = F.coalesce("text", F.lit(""))
    kept = similar_groups(docs, k, similarity, radius).where("kept").select(F.col("doc_id").alias("__kept_id"), F.col("tie").alias("__kept_tie")).distinct()
    return docs.join(kept, F.col("doc_id").eqNullSafe(F.col("__kept_id")) & (F.xxhash64(text) == F.col("__kept_tie")), "left_semi")
