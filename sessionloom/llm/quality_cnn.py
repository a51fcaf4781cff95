"""Quality classifier: a byte-level convolutional network in numpy."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, LongType, StructField, StructType

from sessionloom.llm.shared import text_slices

CHUNK, STEP, WIDTH, STRIDE = 512, 496, 8, 4  # bytes; chunks overlap, so that no window is lost between them
PAD, DEPTH, FILTERS = 256, 6, 24
SAMPLE_ROWS = 2500  # labelled rows that the classifier is fitted on, at most
SAMPLE_BYTES = 1 << 26  # bytes of their texts, at most
BLOCK = 256  # chunks that are worked on together


def held_out(doc_id: Column) -> Column:
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 5 == 0


def _layout(offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For the chunks that cover each text whole: the text of each, where it starts in it, and the first chunk of each text. An empty text has one of padding."""
    lengths = np.diff(offsets)
    counts = np.maximum(1, -(-(lengths - (CHUNK - STEP)) // STEP))
    first = np.concatenate(([0], np.cumsum(counts)[:-1]))
    owner = np.repeat(np.arange(len(lengths)), counts)
    return owner, (np.arange(len(owner)) - first[owner]) * STEP, first


def _codes(data: np.ndarray, offsets: np.ndarray, owner: np.ndarray, start: np.ndarray) -> np.ndarray:
    """A row of CHUNK byte codes for each of the chunks."""
    at = start[:, None] + np.arange(CHUNK)
    inside = at < np.diff(offsets)[owner][:, None]
    at = np.minimum(at + offsets[:-1][owner][:, None], max(0, len(data) - 1))
    codes = data[at].astype(np.int16) if len(data) else np.zeros(at.shape, np.int16)
    return np.where(inside, codes, PAD)


class ByteCnn:
    """Bytes are embedded; each filter takes the largest response in a chunk, rectified; a text has the
    largest and the mean of its chunks' responses, which one logistic unit combines."""

    def __init__(self, seed: int = 5):
        rng = np.random.default_rng(seed)
        self.embed = rng.normal(0, 0.5, (257, DEPTH)).astype(np.float32)
        self.embed[PAD] = 0
        self.conv = rng.normal(0, 1 / np.sqrt(WIDTH * DEPTH), (WIDTH * DEPTH, FILTERS)).astype(np.float32)
        self.conv_bias = np.zeros(FILTERS, np.float32)
        self.out = rng.normal(0, 0.1, 2 * FILTERS).astype(np.float32)
        self.out_bias = np.zeros(1, np.float32)

    def weights(self) -> list[np.ndarray]:
        return [self.embed, self.conv, self.conv_bias, self.out, self.out_bias]

    def settled(self) -> tuple[np.ndarray, np.ndarray]:
        """Embedding and filters in whole 128ths and 256ths, within 4 and 2: sums of WIDTH * DEPTH of their products are exact in single precision, in whatever order they are added."""
        return np.clip(np.round(self.embed * 128) / 128, -4, 4).astype(np.float32), np.clip(np.round(self.conv * 256) / 256, -2, 2).astype(np.float32)

    def respond(self, codes: np.ndarray, embed: np.ndarray, conv: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Largest response of each filter in each chunk, and the responses of all windows."""
        x = embed[codes].reshape(len(codes), CHUNK * DEPTH)
        view = np.lib.stride_tricks.sliding_window_view(x, WIDTH * DEPTH, axis=1)[:, :: STRIDE * DEPTH]
        z = (view.reshape(-1, WIDTH * DEPTH) @ conv).reshape(len(codes), -1, FILTERS)
        return z.max(axis=1) + self.conv_bias, z

    def score(self, data: np.ndarray, offsets: np.ndarray, settled: bool = True) -> np.ndarray:
        """The probability of each text, by settled weights; otherwise by those that are learned."""
        owner, start, first = _layout(offsets)
        top, weights = np.empty((len(owner), FILTERS), self.conv.dtype), self.settled() if settled else (self.embed, self.conv)
        for i in range(0, len(owner), BLOCK):
            # memory doesn't grow with a text
            own = slice(i, i + BLOCK)
            top[own] = self.respond(_codes(data, offsets, owner[own], start[own]), *weights)[0]
        return self._combine(np.maximum(top, 0), first)[0]

    def _combine(self, top: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        counts = np.diff(np.append(first, len(top)))[:, None]
        pooled = np.concatenate((np.maximum.reduceat(top, first), np.add.reduceat(top.astype(np.float64), first) / counts), axis=1)
        logit = (pooled * self.out).sum(axis=1) + self.out_bias
        return 1 / (1 + np.exp(-np.clip(logit, -30, 30))), pooled, counts

    def gradients(self, data: np.ndarray, offsets: np.ndarray, labels: np.ndarray) -> list[np.ndarray]:
        """Chunks are worked on in blocks both ways: beside the text, some hundred bytes are held for each of its chunks and a few MB for a block."""
        owner, start, first = _layout(offsets)
        blocks = [slice(i, i + BLOCK) for i in range(0, len(owner), BLOCK)]
        raw, where = np.empty((len(owner), FILTERS), self.conv.dtype), np.empty((len(owner), FILTERS), np.int16)
        for own in blocks:
            raw[own], responses = self.respond(_codes(data, offsets, owner[own], start[own]), self.embed, self.conv)
            where[own] = responses.argmax(axis=1)
        top = np.maximum(raw, 0)
        p, pooled, counts = self._combine(top, first)
        d = ((p - labels) / len(labels)).astype(np.float32)
        pooled_d = d[:, None] * self.out
        top_d = (pooled_d[:, FILTERS:] / counts).astype(raw.dtype)[owner]
        largest = np.maximum.reduceat(top, first)[owner]
        tied = (top == largest) & (top > 0)
        share = np.add.reduceat(tied.astype(np.float32), first)
        top_d = (top_d + tied * (pooled_d[:, :FILTERS] / np.maximum(share, 1)).astype(raw.dtype)[owner]) * (raw > 0)
        conv_d, embed_d = np.zeros_like(self.conv), np.zeros_like(self.embed)
        for own in blocks:
            codes = _codes(data, offsets, owner[own], start[own])
            bytes_of = codes[np.arange(len(codes))[:, None, None], where[own][:, :, None] * STRIDE + np.arange(WIDTH)]
            conv_d += np.einsum("cf,cfd->df", top_d[own], self.embed[bytes_of].reshape(len(codes), FILTERS, -1))
            spread = np.einsum("cf,df->cfd", top_d[own], self.conv).reshape(-1, DEPTH)
            for k in range(DEPTH):
                embed_d[:, k] += np.bincount(bytes_of.ravel(), spread[:, k], 257)
        embed_d[PAD] = 0
        return [embed_d, conv_d, top_d.sum(axis=0), pooled.T @ d, d.sum(keepdims=True)]

    def fit(self, texts: list[bytes], labels: np.ndarray, steps: int = 800, rate: float = 0.01, batch: int = 32) -> ByteCnn:
        """Adam on the logistic loss, for about `steps` batches whatever the number of texts."""
        if not len(texts):
            return self
        share = np.clip(labels.mean(), 0.02, 0.98)
        self.out_bias[:] = np.log(share / (1 - share))
        rng = np.random.default_rng(1)
        moments = [[np.zeros_like(w), np.zeros_like(w)] for w in self.weights()]
        per_epoch = -(-len(texts) // batch)
        epochs = -(-steps // per_epoch)
        step, steps = 0, epochs * per_epoch
        for _ in range(epochs):
            order = rng.permutation(len(texts))
            for i in range(0, len(order), batch):
                own = order[i : i + batch]
                data = np.frombuffer(b"".join(texts[j] for j in own), np.uint8)
                offsets = np.concatenate(([0], np.cumsum([len(texts[j]) for j in own])))
                step += 1
                pace = rate * (1 - (step - 1) / steps)
                for w, g, m in zip(self.weights(), self.gradients(data, offsets, labels[own]), moments):
                    m[0] += 0.1 * (g - m[0])
                    m[1] += 0.001 * (g * g - m[1])
                    w -= (pace * (m[0] / (1 - 0.9**step)) / (np.sqrt(m[1] / (1 - 0.999**step)) + 1e-8)).astype(np.float32)
        return self


def train(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS, sample_bytes: int = SAMPLE_BYTES) -> ByteCnn:
    """Fit on at most sample_rows labelled rows that are not held out, taken by hash of doc_id, whose texts have at most sample_bytes in all.

    labels: doc_id, quality (0 or 1; other values and null are no labels). Of repeated labels of a doc_id the
    larger counts; of rows that repeat a doc_id one with the least hash of its text. A text that would pass sample_bytes is left
    out, and the next ones that fit are taken. Without any labelled row the network stays as it is seeded.
    """
    known = labels.where(F.col("quality").isin(0, 1) & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id"))).groupBy("doc_id").agg(F.max("quality").alias("quality"))
    sample = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample_rows)
    texts = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).withColumn("tie", F.xxhash64("text"))
    sizes = texts.join(F.broadcast(sample), "doc_id").groupBy("doc_id").agg(F.min(F.struct("tie", F.octet_length("text").alias("size"))).alias("m"), F.max("quality").alias("quality"))
    # one row per sampled id
    rows, total = [], 0
    for r in sorted(sizes.select("doc_id", "m.*", "quality", F.xxhash64("doc_id").alias("turn")).collect(), key=lambda r: (r["turn"], r["doc_id"])):
        if total + r["size"] > sample_bytes:
            continue
        total += r["size"]
        rows.append((r["doc_id"], r["tie"], float(r["quality"])))
    chosen = docs.sparkSession.createDataFrame(rows, StructType([docs.schema["doc_id"], StructField("tie", LongType()), StructField("quality", DoubleType())]))
    found = {r["doc_id"]: r for r in texts.join(F.broadcast(chosen), ["doc_id", "tie"]).dropDuplicates(["doc_id"]).collect()}
    found = [found[i] for i in sorted(found)]
    return ByteCnn().fit([r["text"].encode() for r in found], np.array([r["quality"] for r in found], np.float64))


def score(docs: DataFrame, model: ByteCnn, keep: list[str], threshold: float = 0.3) -> DataFrame:
    """The columns named in keep (none called score, predicted or score_text), score (0 to 1) and predicted (1 if score >= threshold) of every row of docs.

    Whole texts are scored, whatever their length; null is empty and gets the score of padding. Scores have six
    decimals and don't depend on how rows are dealt. Nothing is shuffled.
    """

    def run(batches: Iterator[pa.RecordBatch]):
        for batch in batches:
            got = [model.score(data, offsets) for _, data, offsets in text_slices(batch.column("text" if "text" in keep else "score_text"), 1 << 18)]
            got = np.round(np.concatenate(got), 6) if got else np.zeros(0)
            arrays = [batch.column(c) for c in keep] + [pa.array(got, pa.float64()), pa.array((got >= threshold).astype(np.int32))]
            yield pa.RecordBatch.from_arrays(arrays, [*keep, "score", "predicted"])

    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in docs.select(*keep).schema]
    return docs.select(*keep, *([] if "text" in keep else [F.col("text").alias("score_text")])).mapInArrow(run, ", ".join([*fields, "score double", "predicted int"]))
