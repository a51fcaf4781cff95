"""Scoring by cross-entropy difference between a target and a background bigram model."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sessionloom.llm.shared import cut, mixed, packed, text_slices, unpacked, word_hashes, word_spans

HOT = 1 << 16  # a word or pair is hot if it makes up this part of all tokens or more, so that few are
SMOOTHING = 1000.0  # weight of the lower order
BROADCAST_IDS = 4_000_000  # target ids up to which they are broadcast
PART = 1 << 20  # tokens whose pairs are scored together, about
SLICE = 1 << 21  # bytes of text that are worked on together
UNIT = 1 << 20  # losses are summed as whole multiples of 1 / UNIT, so that no order of addition shows
EDGE = 0  # the word at either edge of a text


class Tokens:
    """The words of a slice of texts as 64-bit hashes, each text ended by EDGE; heads are the words before them, EDGE at the start."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray):
        starts, ends, first = word_spans(data, offsets)
        self.counts = np.diff(first)
        filled = np.flatnonzero(self.counts)
        lengths = self.counts[filled] + 1
        self.text = np.repeat(filled, lengths)
        self.words = np.full(len(self.text), EDGE, np.int64)
        stops = np.cumsum(lengths) - 1
        inner = np.ones(len(self.text), bool)
        inner[stops] = False
        self.words[inner] = word_hashes(data, starts, ends).view(np.int64)
        self.heads = np.concatenate((np.full(min(1, len(self.text)), EDGE), self.words[:-1]))


def pair_keys(heads: np.ndarray, words: np.ndarray) -> np.ndarray:
    return mixed(heads.view(np.uint64) * np.uint64(0xD1342543DE82EF95) + words.view(np.uint64)).view(np.int64)


def _slices(batches: Iterator[pa.RecordBatch]):
    for batch in batches:
        chosen = batch.column("target").to_numpy(zero_copy_only=False)
        for row, data, offsets in text_slices(batch.column("text"), SLICE):
            yield batch, row, Tokens(data, offsets), chosen[row : row + len(offsets) - 1]


def _tally(keys: np.ndarray, chosen: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct keys, and how often each occurs in target and other texts."""
    kinds, of = np.unique(keys, return_inverse=True)
    return kinds, np.bincount(of[chosen], minlength=len(kinds)), np.bincount(of[~chosen], minlength=len(kinds))


def _rows(names: list[str], *columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names)


def _place(sorted_keys: np.ndarray, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where each key stands among sorted ones, and whether it is one of them."""
    if not len(sorted_keys):
        return np.zeros(len(keys), np.int64), np.zeros(len(keys), bool)
    at = np.minimum(np.searchsorted(sorted_keys, keys), len(sorted_keys) - 1)
    return at, sorted_keys[at] == keys


COUNTS = ["is_pair", "key", "target", "background"]


def _words_and_busy_pairs(hot: int):
    """Counts of all words, and of the pairs that are more than half as busy in a slice as a hot one is on the whole."""

    def run(batches):
        for _, _, tokens, chosen in _slices(batches):
            if not len(tokens.words):
                continue
            chosen = chosen[tokens.text]
            words = _tally(tokens.words, chosen)
            yield _rows(COUNTS, np.zeros(len(words[0]), bool), *words)
            pairs = _tally(pair_keys(tokens.heads, tokens.words), chosen)
            busy = 2 * hot * (pairs[1] + pairs[2]) >= len(tokens.words)
            yield _rows(COUNTS, np.ones(busy.sum(), bool), *(x[busy] for x in pairs))

    return run


def _hot_pair_counts(pairs):
    def run(batches):
        for _, _, tokens, chosen in _slices(batches):
            keys = pair_keys(tokens.heads, tokens.words)
            hit = _place(pairs.value, keys)[1]
            found = _tally(keys[hit], chosen[tokens.text][hit])
            yield _rows(COUNTS[1:], *found)

    return run


class Hot:
    """What every task knows: totals of both models, number of words, and counts of the hot words and pairs by sorted key."""

    def __init__(self, totals: tuple[int, int], vocabulary: int, words: list, pairs: list):
        self.totals, self.vocabulary = np.array(totals, np.float64), vocabulary
        self.words, self.word_counts = self._table(words)
        self.pairs, self.pair_counts = self._table(pairs)

    @staticmethod
    def _table(rows: list) -> tuple[np.ndarray, np.ndarray]:
        table = np.array([(r["key"], r["target"], r["background"]) for r in rows], np.int64).reshape(-1, 3)
        table = table[np.argsort(table[:, 0])]
        return table[:, 0].copy(), table[:, 1:].T.copy()

    def losses(self, model: int, pair: np.ndarray, word: np.ndarray) -> np.ndarray:
        """Of a pair in a model, for one occurrence, with the loss that its word will cost as a head taken from the next pair to this one:
        every word is a head once for each time it occurs, so that the sum over a text is the same."""
        total = self.totals[model]
        share = max(total, 1) / max(self.totals.sum(), 1)
        prior = (word + share) / (total + share * (self.vocabulary + 1))
        return np.log(word + SMOOTHING) - np.log(pair + SMOOTHING * prior)

    def both(self, n: np.ndarray, own: np.ndarray, chosen: np.ndarray, pair: np.ndarray, word: np.ndarray) -> list[np.ndarray]:
        """Losses under target and background in units; what a text itself adds (n, own) is taken off the model that counts it."""
        out = []
        for model, counted in enumerate((chosen, ~chosen)):
            loss = self.losses(model, pair[model] - n * counted, word[model] - own * counted)
            out.append(np.rint(n * loss * UNIT).astype(np.int64))
        return out


BLOBS = ["words", "fan", "heads", "runs", "texts", "n", "own"]
LOCAL = ["ids", "tokens", "target", "background"]


def _posted(hot, parts: int):
    """Per slice: by part, its texts' pairs to be scored there; and one row of its texts, with what hot pairs cost them.

    A pair belongs to the part of its word, a pair of a hot word to a part of its own; so no part is much larger than others. Beside its word, a pair is known
    by 48 bits of its hash.
    """

    def run(batches):
        known, number = hot.value, 0
        for batch, row, tokens, chosen in _slices(batches):
            name = TaskContext.get().partitionId() << 32 | number
            number += 1
            local = [np.zeros(len(chosen), np.int64) for _ in range(2)]
            # each pair of a text once, in order of text, word and head
            kinds, of = np.unique(tokens.words, return_inverse=True)
            size = max(1, len(kinds))
            head_of = np.concatenate((np.full(min(1, len(of)), np.searchsorted(kinds, EDGE)), of[:-1]))
            keys, n = np.unique((tokens.text * size + of) * size + head_of, return_counts=True)
            text, word, head = keys // (size * size), keys // size % size, keys % size
            group = np.flatnonzero(np.append(True, keys[1:] // size != keys[:-1] // size)) if len(keys) else np.zeros(0, np.int64)
            own = np.repeat(np.add.reduceat(n, group), np.diff(np.append(group, len(keys)))) if len(keys) else n
            pair = pair_keys(kinds[head], kinds[word])
            at, busy = _place(known.pairs, pair)
            word_at, word_busy = _place(known.words, kinds)
            if busy.any():
                where = at[busy]
                counts = known.word_counts[:, word_at[word[busy]]]
                for sums, loss in zip(local, known.both(n[busy], own[busy], chosen[text[busy]], known.pair_counts[:, where], counts)):
                    np.add.at(sums, text[busy], loss)
            sent = ~busy
            text, word, head, n, own, pair = (x[sent] for x in (text, word, head, n, own, pair))
            part = (np.where(word_busy[word], pair, mixed(kinds.view(np.uint64)).view(np.int64)[word]).view(np.uint64) % np.uint64(parts)).astype(np.int64)
            order = np.lexsort((head, word, part))
            text, word, head, n, own, part, short = (x[order] for x in (text, word, head, n, own, part, pair.view(np.uint64) >> np.uint64(16)))
            rows = {c: [] for c in ["part", *BLOBS]}
            edges = np.flatnonzero(np.append(True, part[1:] != part[:-1])) if len(part) else []
            for a, b in zip(edges, [*edges[1:], len(part)]):
                w, h = word[a:b], head[a:b]
                new_word = np.append(True, w[1:] != w[:-1])
                new_pair = new_word | np.append(True, h[1:] != h[:-1])
                first = np.flatnonzero(new_pair)
                rows["part"].append(int(part[a]))
                rows["words"].append(kinds[w[new_word]].tobytes())
                rows["fan"].append(packed(np.diff(np.append(np.flatnonzero(new_word[first]), len(first)))))
                rows["heads"].append(packed(short[a:b][first]))
                rows["runs"].append(packed(np.diff(np.append(first, b - a))))
                rows["texts"].append(packed(2 * text[a:b] + chosen[text[a:b]]))
                rows["n"].append(packed(n[a:b]))
                rows["own"].append(packed(own[a:b]))
            count = len(rows["part"])
            ids = batch.column("doc_id").slice(row, len(chosen))
            columns = {"part": pa.array([*rows["part"], name % parts], pa.int32()), "slice": pa.array([name] * (count + 1), pa.int64())}
            columns["ids"] = pa.ListArray.from_arrays(pa.array([0] * (count + 1) + [len(ids)], pa.int32()), ids, mask=pa.array([True] * count + [False]))
            none = [None] * count
            columns |= {c: pa.array(none + [packed(x)], pa.binary()) for c, x in zip(LOCAL[1:], (tokens.counts, *local))}
            columns |= {c: pa.array([*rows[c], None], pa.binary()) for c in BLOBS}
            yield pa.RecordBatch.from_arrays(list(columns.values()), list(columns))

    return run


def _scored(hot):
    """All blobs of a part: counts of its pairs and words, and from them what the pairs cost each text. Rows of texts pass through."""

    def score(batch: pa.Table) -> list[list[bytes]]:
        known = hot.value
        blobs = {c: [x.as_py() for x in batch.column(c)] for c in BLOBS}
        words = [np.frombuffer(x, np.int64) for x in blobs["words"]]
        heads = np.concatenate([unpacked(x) for x in blobs["heads"]])
        fan = [unpacked(x) for x in blobs["fan"]]
        words = np.repeat(np.concatenate(words), np.concatenate(fan))
        runs = np.concatenate([unpacked(x) for x in blobs["runs"]])
        texts = [unpacked(x) for x in blobs["texts"]]
        sizes = [len(x) for x in texts]
        texts = np.concatenate(texts)
        chosen, n, own = texts % 2 == 1, np.concatenate([unpacked(x) for x in blobs["n"]]), np.concatenate([unpacked(x) for x in blobs["own"]])
        pairs, pair_of = np.unique(pair_keys(heads, words), return_inverse=True)
        kinds, word_of = np.unique(words, return_inverse=True)
        pair_of, word_of = np.repeat(pair_of, runs), np.repeat(word_of, runs)
        weight = [(n * counted).astype(np.float64) for counted in (chosen, ~chosen)]
        pair_counts = np.array([np.bincount(pair_of, x, len(pairs)) for x in weight])
        word_counts = np.array([np.bincount(word_of, x, len(kinds)) for x in weight])
        at, busy = _place(known.words, kinds)
        word_counts[:, busy] = known.word_counts[:, at[busy]]
        del words, heads, runs, weight
        # sums by blob and text
        keys, of = np.unique(np.repeat(np.arange(len(sizes)), sizes) << 40 | texts >> 1, return_inverse=True)
        sums = [np.zeros(len(keys), np.int64) for _ in range(2)]
        for i in range(0, len(n), 1 << 16):
            own_rows = slice(i, i + (1 << 16))
            losses = known.both(n[own_rows], own[own_rows], chosen[own_rows], pair_counts[:, pair_of[own_rows]], word_counts[:, word_of[own_rows]])
            for s, loss in zip(sums, losses):
                np.add.at(s, of[own_rows], loss)
        edges = np.searchsorted(keys >> 40, np.arange(len(sizes) + 1))
        return [[packed(x[a:b]) for a, b in zip(edges, edges[1:])] for x in (keys & (1 << 40) - 1, *sums)]

    names = ["slice", "ids", "tokens", "texts", "target", "background"]

    def flush(held: list[pa.RecordBatch], kind: pa.DataType):
        table = pa.Table.from_batches(held)
        none = pa.nulls(table.num_rows)
        columns = [table.column("slice").combine_chunks(), none.cast(kind), none.cast(pa.binary()), *(pa.array(x, pa.binary()) for x in score(table))]
        return pa.RecordBatch.from_arrays(columns, names)

    def run(batches):
        held, now, kind = [], None, None
        for batch in batches:
            kind = batch.schema.field("ids").type
            own = batch.filter(pc.is_valid(batch.column("ids")))
            yield pa.RecordBatch.from_arrays([own.column("slice"), own.column("ids"), own.column("tokens"), pa.nulls(own.num_rows, pa.binary()), own.column("target"), own.column("background")], names)
            batch = batch.filter(pc.is_null(batch.column("ids"))).select(["part", "slice", *BLOBS])
            part = batch.column("part").to_numpy()
            edges = np.flatnonzero(part[1:] != part[:-1]) + 1
            for a, b in zip([0, *edges], [*edges, len(part)]):
                if a < b and part[a] != now:
                    if held:
                        yield flush(held, kind)
                    held, now = [], part[a]
                if a < b:
                    held.append(batch.slice(a, b - a))
        if held:
            yield flush(held, kind)

    return run


def _gathered(batches):
    """Rows of a slice, that of its texts first: what each text costs in all."""
    names = ["doc_id", "n_tokens", "target_loss", "background_loss"]

    def done(ids, counts, sums):
        return pa.RecordBatch.from_arrays([ids, pa.array(counts), *(pa.array(s / UNIT) for s in sums)], names)

    now = None
    for batch in batches:
        for j in range(batch.num_rows):
            if batch.column("ids")[j].is_valid:
                if now is not None:
                    yield done(*now)
                now = batch.column("ids")[j].values, unpacked(batch.column("tokens")[j].as_py()), [unpacked(batch.column(c)[j].as_py()) for c in LOCAL[2:]]
            else:
                texts = unpacked(batch.column("texts")[j].as_py())
                for s, c in zip(now[2], LOCAL[2:]):
                    s[texts] += unpacked(batch.column(c)[j].as_py())
    if now is not None:
        yield done(*now)


def score(docs: DataFrame, target_ids: DataFrame, hot: int = HOT, part: int = PART) -> DataFrame:
    """Cross-entropy of each text under a target and a background bigram model, and the difference.

    Returns one row per row of docs: doc_id, n_tokens, ce_target, ce_background (nats per word, the end of the text counted as one), ce_difference =
    ce_target - ce_background: the lower, the more a text is like the target. The target model counts the texts whose doc_id is in
    target_ids (a table with the column doc_id; null ids and repeats count for nothing), the background model all others; a text's
    own counts are taken off the model that has them, so that every text is scored as if it were unseen. Both models
    have one vocabulary, all words of docs, and the same order and smoothing: (count + S * prior(word)) /
    (count of the word before + S), where prior(word) = (count of the word + share) / (words of the model + share * (vocabulary + 1)) and share is
    the model's part of all words: so a word that neither has seen costs the same in both, whatever their sizes.

    Words are runs without white space, known by a 64-bit hash; null texts and texts without words have 0 tokens and 0.0 everywhere. Rows
    that repeat a doc_id are scored each by itself. Other columns aren't read. An empty table gives an empty result. A
    task that is repeated must find its rows in the same order, as those of a stored table are.

    Counting and scoring are one shuffle: pairs go to the part of their word, where all counts that they need meet, and only sums per text and
    part come back. Hot words and pairs (fewer than 2 * hot, whatever the input) are counted first and go to every task, so no part is hot.
    """
    docs = docs.select("doc_id", "text")
    kind = docs.schema["doc_id"].dataType.simpleString()
    spark = docs.sparkSession
    targets = cut(target_ids.select(F.col("doc_id").alias("target_id")).where("target_id is not null").distinct(), "targets")
    targets = F.broadcast(targets) if targets.count() <= BROADCAST_IDS else targets
    flagged = docs.join(targets, F.col("doc_id") == F.col("target_id"), "left").select("doc_id", "text", F.col("target_id").isNotNull().alias("target"))
    sums = [F.sum(c).alias(c) for c in COUNTS[2:]]
    texts = flagged.select("text", "target")
    counts = cut(texts.mapInArrow(_words_and_busy_pairs(hot), "is_pair boolean, key long, target long, background long").groupBy("is_pair", "key").agg(*sums), "counts")
    whole = counts.where("not is_pair").agg(F.count(F.lit(1)).alias("words"), *[F.coalesce(s, F.lit(0)).alias(c) for s, c in zip(sums, COUNTS[2:])]).first()
    total, often = whole["target"] + whole["background"], F.col("target") + F.col("background")
    hot_words = counts.where(~F.col("is_pair") & (often * 2 * hot >= total)).collect()
    # a hot pair has half of its count in slices where it is busy, so that what was counted there tells of it; its word is as frequent, so hot too
    busy = spark.sparkContext.broadcast(np.sort(np.array([r["key"] for r in counts.where(F.col("is_pair") & (often * 2 * hot >= total)).select("key").collect()], np.int64)))
    hot_pairs = texts.mapInArrow(_hot_pair_counts(busy), "key long, target long, background long").groupBy("key").agg(*sums).collect()
    known = spark.sparkContext.broadcast(Hot((whole["target"], whole["background"]), whole["words"], hot_words, hot_pairs))
    parts = max(1, total // part)
    blobs = ", ".join(f"{c} binary" for c in [*LOCAL[1:], *BLOBS])
    posted = flagged.mapInArrow(_posted(known, parts), f"part int, slice long, ids array<{kind}>, {blobs}")
    dealt = posted.repartitionById(parts, F.col("part")).sortWithinPartitions("part", "slice")
    scored = dealt.mapInArrow(_scored(known), f"slice long, ids array<{kind}>, tokens binary, texts binary, target binary, background binary")
    gathered = scored.repartition("slice").sortWithinPartitions("slice", F.col("ids").isNull())
    out = gathered.mapInArrow(_gathered, f"doc_id {kind}, n_tokens long, target_loss double, background_loss double")
    target, background = (F.round(F.when(F.col("n_tokens") > 0, F.col(c) / (F.col("n_tokens") + 1)).otherwise(0.0), 6) for c in ("target_loss", "background_loss"))
    return out.select("doc_id", "n_tokens", target.alias("ce_target"), background.alias("ce_background"), F.round(target - background, 6).alias("ce_difference"))
