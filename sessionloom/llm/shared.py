"""What the corpus operators share: scratch tables, text slices, words and their hashes."""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sessionloom.sources.scratch import new_path

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def cut(df: DataFrame, name: str) -> DataFrame:
    """Write df as a table in the shared folder and read it back: its lineage ends here."""
    path = new_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def lower_ascii(text: Column) -> Column:
    """Lower-case A-Z and nothing else."""
    return F.translate(text, UPPER, LOWER)


def words(text: Column) -> Column:
    """The runs of characters other than space and 0x09 to 0x0D; none for a null text."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), "[\\x20\\x09-\\x0D]+"), "")


def text_slices(column: pa.Array, limit: int = 1 << 20) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first row, bytes, offsets of rows in bytes) of runs of rows of about `limit` bytes; null is empty.

    A longer text comes alone and whole.
    """
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column, "" if pa.types.is_string(column.type) or pa.types.is_large_string(column.type) else b"")
    if not len(column):
        return
    kind = np.int64 if pa.types.is_large_string(column.type) else np.int32
    offsets = np.frombuffer(column.buffers()[1], kind)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    body = column.buffers()[2]
    data = np.frombuffer(body, np.uint8) if body is not None and body.size else np.zeros(0, np.uint8)
    first = 0
    while first < len(column):
        last = max(first + 1, int(np.searchsorted(offsets, offsets[first] + limit, "right")) - 1)
        last = min(last, len(column))
        yield first, data[offsets[first] : offsets[last]], offsets[first : last + 1] - offsets[first]
        first = last


def signed(values: np.ndarray) -> np.ndarray:
    return values.astype(np.uint64).view(np.int64)


_SPACE = np.isin(np.arange(256), [32, *range(9, 14)])


@cache
def _powers(base: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd number and of its inverse, modulo 2**64."""
    up, down = np.full(n, base, np.uint64), np.full(n, pow(base, -1, 1 << 64), np.uint64)
    up[0] = down[0] = 1
    return np.cumprod(up), np.cumprod(down)


@cache
def _letters() -> np.ndarray:
    return np.random.default_rng(11).integers(1, 1 << 64, 256, dtype=np.uint64)


def mixed(h: np.ndarray) -> np.ndarray:
    """The finaliser of SplitMix64."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


class Rolling:
    """Hashes of any run of a sequence of 64-bit values, from prefix sums."""

    def __init__(self, values: np.ndarray, base: int):
        size = 1 << max(16, int(len(values)).bit_length())
        self.up, self.down = _powers(base, size)
        self.sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(values * self.up[: len(values)])))

    def of(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mixed((self.sums[end] - self.sums[start]) * self.down[start])


def word_spans(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end of every word in the bytes, and the first word of each text (with the number of words at the end)."""
    word = ~_SPACE[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[offsets] = True
    before = np.concatenate(([False], word[:-1])) if len(data) else word
    after = np.concatenate((word[1:], [False])) if len(data) else word
    starts = np.flatnonzero(word & (~before | edge[:-1]))
    ends = np.flatnonzero(word & (~after | edge[1:])) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of every word. Runs of words are worked on in turn, so that what is held beside the text doesn't grow with it."""
    out = np.empty(len(starts), np.uint64)
    for i in range(0, len(starts), 1 << 15):
        a, b = starts[i : i + (1 << 15)], ends[i : i + (1 << 15)]
        rolling = Rolling(_letters()[data[a[0] : b[-1]]], 0x9E3779B97F4A7C15)
        out[i : i + (1 << 15)] = mixed(rolling.of(a - a[0], b - a[0]) + (b - a).astype(np.uint64))
    return out


def packed(values: np.ndarray) -> bytes:
    """Whole numbers that aren't negative, in as few bytes each as the largest needs."""
    size = max(1, -(-int(values.max()).bit_length() // 8)) if len(values) else 1
    return bytes([size]) + values.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :size].tobytes()


def unpacked(body: bytes) -> np.ndarray:
    size = body[0]
    out = np.zeros(((len(body) - 1) // size, 8), np.uint8)
    out[:, :size] = np.frombuffer(body, np.uint8, offset=1).reshape(-1, size)
    return out.view("<u8")[:, 0].astype(np.int64)
