"""Runs of words that repeat with a period, found exactly by recompression.

A batch of texts is one sequence of word numbers with a wall of its own between any two texts. Block compression (x x x becomes one symbol) and pair
compression (every x y with x on one side of a random split of the alphabet and y on the other) take turns until each text is one symbol: a run-length grammar. Equal stretches
get the same symbols but near their ends, so the longest common extension of two places climbs the grammar while symbols agree and comes
down where they differ, in a few steps a level.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sessionloom.llm.shared import mixed, text_slices, word_spans, words

LEAST, REPEATS = 24, 3  # words of a run, and how often its period fits in it
AT_ONCE = 1 << 20  # candidates that are worked on at a time
NEAR = 3  # neighbours that are compared before the grammar is asked


class Grammar:
    """The run-length grammar of a sequence. All levels lie in one array of nodes, level 0 (the sequence) first, so that a node is a number."""

    def __init__(self, sequence: np.ndarray, walls: int, least_size: int):
        """sequence: symbols from 0; those below `walls` occur once each and are never merged. Levels are made until one has no more than least_size symbols."""
        level, names, offset, turn = sequence.astype(np.int64), int(sequence.max(initial=0)) + 1, 0, 0
        symbols, up, up_last, rest, rest_back, down, down_last = [level], [], [], [], [], [np.full(len(level), -1)], [np.full(len(level), -1)]
        while len(level) > least_size:
            turn += 1
            first, key, ahead, behind = self._blocks(level, names) if turn % 2 else self._pairs(level, walls, turn)
            if len(first) == len(level):
                continue
            last = np.append(first[1:], len(level)) - 1
            joined = last > first
            made, new = np.unique(key[joined], return_inverse=True)
            above = level[first].copy()
            above[joined] = names + new
            names += len(made)
            node = offset + len(level) + np.arange(len(first))
            up.append(self._at(len(level), first, node))
            up_last.append(self._at(len(level), last, node))
            rest.append(ahead)
            rest_back.append(behind)
            down.append(offset + first)
            down_last.append(offset + last)
            offset += len(level)
            level = above
            symbols.append(level)
        up.append(np.full(len(level), -1))
        up_last.append(up[-1])
        rest.append(np.ones(len(level), np.int64))
        rest_back.append(rest[-1])
        self.symbols = np.concatenate(symbols).astype(np.int32)
        self.forward = tuple(np.concatenate(x).astype(np.int32) for x in (up, down, rest))
        self.backward = tuple(np.concatenate(x).astype(np.int32) for x in (up_last, down_last, rest_back))

    @staticmethod
    def _at(size: int, places: np.ndarray, values: np.ndarray) -> np.ndarray:
        out = np.full(size, -1)
        out[places] = values
        return out

    @staticmethod
    def _blocks(level: np.ndarray, names: int) -> tuple[np.ndarray, ...]:
        """First symbol and key of each block of equal symbols; and for each symbol how many of its block are left ahead and behind, itself included."""
        first = np.flatnonzero(np.append(True, level[1:] != level[:-1]))
        size = np.diff(np.append(first, len(level)))
        place, start = np.arange(len(level)), np.repeat(first, size)
        behind = place - start + 1
        return first, level[first] * (len(level) + 1) + size, np.repeat(size, size) - behind + 1, behind

    @staticmethod
    def _pairs(level: np.ndarray, walls: int, turn: int) -> tuple[np.ndarray, ...]:
        """As _blocks, for the pairs over a random split of the alphabet; the order of sides that merges more is taken."""
        left = mixed(level.astype(np.uint64) + np.uint64(turn * 0x9E3779B97F4A7C15 % 2**64)) >> np.uint64(63) == 1
        free = level >= walls
        ways = [free[:-1] & free[1:] & (side[:-1] > side[1:]) for side in (left, ~left)]
        pair = max(ways, key=np.count_nonzero)
        begins = np.append(True, ~pair)
        first = np.flatnonzero(begins)
        after = level[np.minimum(first + 1, len(level) - 1)]
        one = np.ones(len(level), np.int64)
        return first, level[first] << 32 | after, one, one

    def extensions(self, a: np.ndarray, b: np.ndarray, back: bool = False) -> np.ndarray:
        """How many symbols agree from places a and b of the sequence on; back: ahead of them, themselves included."""
        up, down, rest = self.backward if back else self.forward
        symbols, step = self.symbols, -1 if back else 1
        x, y, out, open_ = a.astype(np.int64), b.astype(np.int64), np.zeros(len(a), np.int64), np.arange(len(a))
        begun = x.copy()
        while len(open_):
            same = symbols[x] == symbols[y]
            higher_x, higher_y = up[x], up[y]
            rise = same & (higher_x >= 0) & (higher_y >= 0) & (symbols[higher_x] == symbols[higher_y])
            ahead = np.minimum(rest[x], rest[y]) * step
            next_x = np.where(rise, higher_x, np.where(same, x + ahead, down[x]))
            next_y = np.where(rise, higher_y, np.where(same, y + ahead, down[y]))
            over = next_x < 0
            if over.any():
                out[open_[over]] = np.abs(x[over] - begun[open_[over]])
                stay = ~over
                open_, next_x, next_y = open_[stay], next_x[stay], next_y[stay]
            x, y = next_x.astype(np.int64), next_y.astype(np.int64)
        return out


def _grid(first: np.ndarray, size: np.ndarray, least: int, repeats: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(text, place, period) of the candidates of all texts, some at a time.

    A run of period q has at least s = max(least - q, (repeats - 1) * q) places in a row whose word comes again q words on, so one of them is a multiple of s. Over all
    q these are n * log(n) / (repeats - 1) places of n words, about.
    """
    periods = np.where(size >= least, size // repeats, 0)
    text = np.repeat(np.arange(len(size)), periods)
    q = np.arange(len(text)) - np.repeat(np.cumsum(periods) - periods, periods) + 1
    step = np.maximum(np.maximum(least - q, (repeats - 1) * q), 1)
    places = (size[text] - q - 1) // step + 1
    ends = np.cumsum(places)
    start = 0
    while start < len(text):
        stop = max(start + 1, int(np.searchsorted(ends, (ends[start - 1] if start else 0) + AT_ONCE)))
        n = places[start:stop]
        own = np.repeat(np.arange(start, stop), n)
        nth = np.arange(len(own)) - np.repeat(np.cumsum(n) - n, n)
        yield text[own], first[text[own]] + nth * step[own], q[own]
        start = stop


def _likely(sequence: np.ndarray, place: np.ndarray, q: np.ndarray, near: int) -> np.ndarray:
    """Which candidates agree there and in the next or the last `near` places: all that are in a run do."""
    found = np.flatnonzero(sequence[place] == sequence[place + q])
    p, d = place[found], q[found]
    sides = []
    for way in (1, -1):
        agree = np.ones(len(found), bool)
        for k in range(1, near + 1):
            i = np.clip(p + way * k, 0, len(sequence) - 1)
            j = np.clip(p + d + way * k, 0, len(sequence) - 1)
            agree &= sequence[i] == sequence[j]
        sides.append(agree)
    return found[sides[0] | sides[1]]


def runs_of(ids: np.ndarray, bounds: np.ndarray, least: int = LEAST, repeats: int = REPEATS) -> np.ndarray:
    """Rows (text, start, length, period) of all runs, in that order of texts, starts and periods. ids: word numbers of all texts; bounds: where texts begin, and the end."""
    if repeats < 2:
        raise ValueError("a run holds its period twice at least")
    size = np.diff(bounds)
    near = min(NEAR, max(0, -(-(least * (repeats - 1) // repeats - 1) // 2)))
    sequence = ids.astype(np.int64)
    some = np.zeros(len(size), bool)
    # no walls part the texts yet: neighbours in another text may agree by chance, which only keeps a candidate more
    for text, place, q in _grid(bounds[:-1], size, least, repeats):
        some[text[_likely(sequence, place, q, near)]] = True
    held = np.flatnonzero(some)
    if not len(held):
        return np.zeros((0, 4), np.int64)
    # the texts with candidates, with a wall before each and after the last
    size = size[held]
    first = np.cumsum(size + 1) - size
    sequence = np.zeros(int(size.sum()) + len(size) + 1, np.int64)
    inside = np.ones(len(sequence), bool)
    inside[np.append(first - 1, len(sequence) - 1)] = False
    sequence[~inside] = np.arange(len(size) + 1)
    sequence[inside] = ids[np.repeat(some, np.diff(bounds))].astype(np.int64) + len(size) + 1
    grammar = Grammar(sequence, len(size) + 1, 2 * len(size) + 1)
    found = [np.zeros((0, 4), np.int64)]
    for text, place, q in _grid(first, size, least, repeats):
        keep = _likely(sequence, place, q, near)
        text, place, q = text[keep], place[keep], q[keep]
        behind = grammar.extensions(place - 1, place + q - 1, back=True)
        length = q + grammar.extensions(place, place + q) + behind
        long = length >= np.maximum(least, repeats * q)
        rows = np.stack((held[text], place - behind - first[text], length, q), axis=1)[long]
        found.append(np.unique(rows, axis=0))
    rows = np.unique(np.concatenate(found), axis=0)
    # a stretch is also found by multiples of its period: the least comes first
    rows = rows[np.append(True, (rows[1:, :3] != rows[:-1, :3]).any(axis=1))] if len(rows) else rows
    return rows[np.lexsort((rows[:, 3], rows[:, 1], rows[:, 0]))]


def _kept(ids: np.ndarray, bounds: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Which words stay: those that no run contains after its first period."""
    edge = np.zeros(len(ids) + 1, np.int64)
    begin = bounds[rows[:, 0]] + rows[:, 1]
    np.add.at(edge, begin + rows[:, 3], 1)
    np.add.at(edge, begin + rows[:, 2], -1)
    return np.cumsum(edge[:-1]) == 0


def _joined(letters: np.ndarray, length: np.ndarray, kept: np.ndarray, bounds: np.ndarray) -> pa.Array:
    """For each text its kept words, joined by single spaces. letters: the bytes of all words."""
    text = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))[kept]
    size = length[kept]
    gap = np.append(text[1:] == text[:-1], False).astype(np.int64) if len(text) else size
    ends = np.cumsum(size + gap)
    out = np.full(int(ends[-1]) if len(ends) else 0, 0x20, np.uint8)
    is_letter = np.ones(len(out), bool)
    is_letter[ends[gap == 1] - 1] = False
    out[is_letter] = letters[np.repeat(kept, length)]
    sizes = np.bincount(text, weights=size + gap, minlength=len(bounds) - 1).astype(np.int64)
    offsets = np.append(0, np.cumsum(sizes))
    return pa.Array.from_buffers(pa.large_string(), len(bounds) - 1, [None, pa.py_buffer(offsets), pa.py_buffer(out)])


def _found(least: int, repeats: int):
    kind = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))

    def run(batches: Iterator[pa.RecordBatch]):
        for batch in batches:
            for first, data, offsets in text_slices(batch.column("text"), 1 << 21):
                starts, ends, bounds = word_spans(data, offsets)
                length = ends - starts
                letters = data[np.repeat(starts - (np.cumsum(length) - length), length) + np.arange(int(length.sum()))]
                body = pa.Array.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(np.append(0, np.cumsum(length)).astype(np.int64)), pa.py_buffer(letters)])
                ids = body.dictionary_encode().indices.to_numpy()
                rows = runs_of(ids, bounds, least, repeats)
                places = pa.StructArray.from_arrays([pa.array(rows[:, k]) for k in (1, 2, 3)], fields=list(kind.value_type))
                lists = pa.ListArray.from_arrays(pa.array(np.searchsorted(rows[:, 0], np.arange(len(bounds))), pa.int32()), places)
                texts = _joined(letters, length, _kept(ids, bounds, rows), bounds).cast(pa.string())
                own = batch.slice(first, len(bounds) - 1)
                yield pa.RecordBatch.from_arrays([own.column("doc_id"), pa.array(np.diff(bounds), pa.int64()), lists.cast(kind), texts], ["doc_id", "n_words", "runs", "collapsed"])

    return run


def find_runs(docs: DataFrame, least: int = LEAST, repeats: int = REPEATS) -> DataFrame:
    """The runs of words of whole texts, and the texts without what runs repeat.

    Returns one row per row of docs: doc_id, n_words, runs (array of start, length, period in words from 0, by start, then period) and
    collapsed (kept words joined by single spaces). Words are [^\\x20\\x09-\\x0D]+ and compared byte by byte. A run is a stretch of `least` words or more in which its
    smallest period fits `repeats` times, and that no neighbouring word extends with that period. A word goes if a run contains it after the
    run's first period. Null and empty texts have no words and no runs. Repeated rows stay. Other columns are not read. An empty table gives an empty result.

    Candidates lie on a harmonic grid: for every period, places so far apart that none of its runs misses them all. Those that don't agree with their neighbourhood one period on are left; of the others the
    grammar gives the exact extensions both ways. Texts are worked on in slices and nothing is shuffled. A text with candidates needs some 200 bytes for each of its words.
    """
    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(_found(least, repeats), f"doc_id {kind}, n_words long, runs array<struct<start:long,length:long,period:long>>, collapsed string")


def planted(docs: DataFrame) -> DataFrame:
    """docs with a run in every tenth text or so: from word a on, the first p words after a repeat.

    With h = crc32 of the decimal doc_id and g = h div 10, a text of n words is changed if h % 10 is 0 and n > 0; a = g % n, p = 1 + (n - a) div (3 + g % 8). Texts of a null
    doc_id stay as they are.
    """
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    out = docs.withColumns({"_own": words(F.col("text")), "_g": F.call_function("div", h, F.lit(10)), "_h": h % 10}).withColumn("_n", F.size("_own").cast("long"))
    out = out.withColumn("_a", F.when(F.col("_n") > 0, F.col("_g") % F.greatest(F.col("_n"), F.lit(1))))
    out = out.withColumn("_p", 1 + F.call_function("div", F.col("_n") - F.col("_a"), 3 + F.col("_g") % 8))
    times = F.ceil((F.col("_n") - F.col("_a")) / F.col("_p")).cast("int")
    tail = F.slice(F.flatten(F.array_repeat(F.slice("_own", F.col("_a").cast("int") + 1, F.col("_p").cast("int")), times)), 1, (F.col("_n") - F.col("_a")).cast("int"))
    changed = F.array_join(F.concat(F.slice("_own", 1, F.col("_a").cast("int")), tail), " ")
    return out.withColumn("text", F.when((F.col("_h") == 0) & (F.col("_n") > 0), changed).otherwise(F.col("text"))).drop("_own", "_g", "_h", "_n", "_a", "_p")


def described(found: DataFrame) -> DataFrame:
    """doc_id, n_runs, the run of greatest length / period (ties: smallest start, then period; nulls without a run), and digests of all runs and of the collapsed text."""
    better = lambda a, b: b["length"] * a["period"] > a["length"] * b["period"]
    best = F.aggregate("runs", F.get("runs", F.lit(0)), lambda a, b: F.when(better(a, b), b).otherwise(a))
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", *[r[c].cast("string") for c in ("start", "length", "period")]), F.lit("\n")))
    out = found.select("doc_id", F.size("runs").cast("long").alias("n_runs"), best.alias("_best"), F.sha2(F.array_join(lines, "").cast("binary"), 256).alias("runs_sha256"), F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"))
    milli = F.call_function("div", 1000 * F.col("_best.length"), F.col("_best.period"))
    return out.select("doc_id", "n_runs", *[F.col(f"_best.{c}").alias(c) for c in ("start", "length", "period")], milli.alias("exponent_milli"), "runs_sha256", "collapsed_sha256")
