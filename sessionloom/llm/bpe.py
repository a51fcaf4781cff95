"""Byte-pair encoding and decoding with word ends, merged for many words at once in numpy."""

from __future__ import annotations

import hashlib
import json
import re
import unicodedata
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

KEPT_WORDS = 150_000  # words whose encoding a task keeps
NONE = np.int32(2**31 - 1)  # the rank of a pair that never merges
# the vocabulary file's word pattern (a fixed value), and the same words found faster: its alternatives begin with different letters
WORDS = "'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+"
FIND_WORDS = regex.compile("\\p{L}+|\\p{N}|'(?:s|t|re|ve|m|ll|d)|[^\\p{White_Space}\\p{L}\\p{N}]+").findall
FIND_ASCII = re.compile("[a-z]+|[0-9]|'(?:s|t|re|ve|m|ll|d)|[^\\t-\\r a-z0-9]+").findall


def default_vocabulary() -> str:
    import public_tokenizers

    return str(public_tokenizers.path("word_bpe_49k.json"))


def byte_letters() -> list[str]:
    """The printable letter that stands for each byte in byte-level vocabularies: itself, or the next one from U+0100."""
    plain = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    shifted = (chr(0x100 + i) for i in range(256))
    return [chr(b) if b in plain else next(shifted) for b in range(256)]


def check_spec(spec: dict) -> None:
    """Raise for a file whose options this encoder doesn't follow, so that no text is encoded in another way than the file says."""
    model, problems = spec["model"], []
    steps = spec["normalizer"].get("normalizers", [spec["normalizer"]]) if spec.get("normalizer") else []
    if [x["type"] for x in steps] not in (["NFC", "Replace", "Lowercase"], ["NFC", "Lowercase"]):
        problems.append("normalizer")
    if any(x["type"] == "Replace" and (x["pattern"], x["content"]) != ({"Regex": "\\s+"}, " ") for x in steps):
        problems.append("replacement")
    before = spec["pre_tokenizer"].get("pretokenizers", []) if spec.get("pre_tokenizer") else []
    if [x["type"] for x in before] != ["Split", "ByteLevel"] or before[0].get("behavior") != "Removed" or not before[0].get("invert") or before[1].get("add_prefix_space"):
        problems.append("pre_tokenizer")
    if model.get("type", "BPE") != "BPE" or model.get("byte_fallback") or model.get("dropout") or model.get("ignore_merges") or model.get("continuing_subword_prefix") or not model.get("end_of_word_suffix"):
        problems.append("model")
    if any(not x["content"].startswith("<|") or x.get("single_word") or x.get("lstrip") or x.get("rstrip") or x.get("normalized") for x in spec["added_tokens"]):
        problems.append("added_tokens")
    if spec.get("decoder") is not None and spec["decoder"]:
        problems.append("decoder")
    if problems:
        raise ValueError(f"unsupported in the vocabulary file: {', '.join(problems)}")


class WordBpe:
    """The encoder of a vocabulary file whose merges work on bytes and whose words end in a suffix."""

    def __init__(self, spec: dict):
        check_spec(spec)
        model = spec["model"]
        vocab, suffix = model["vocab"], model["end_of_word_suffix"]
        self.special = {x["content"]: x["id"] for x in spec["added_tokens"]}
        self.names = {i: t for t, i in vocab.items()} | {i: t for t, i in self.special.items()}
        letters = byte_letters()
        if len(vocab) > 1 << 16:
            raise ValueError("pair keys hold ids of 16 bits")
        self.inner = np.array([vocab[x] for x in letters], np.uint32)
        self.final = np.array([vocab[x + suffix] for x in letters], np.uint32)
        pairs = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
        keys = np.array([vocab[a] << 16 | vocab[b] for a, b in pairs], np.uint32)
        order = np.argsort(keys)
        self.keys, self.ranks = keys[order], order.astype(np.int32)
        self.made = np.array([vocab[a + b] for a, b in pairs], np.uint32)
        self.split_special = regex.compile("(" + "|".join(map(regex.escape, sorted(self.special, key=len, reverse=True))) + ")").split
        pattern = next(p["pattern"]["Regex"] for p in spec["pre_tokenizer"]["pretokenizers"] if p["type"] == "Split")
        self.find_words = regex.compile(pattern.replace("\\s", "\\p{White_Space}")).findall
        self.find_ascii = self.find_words
        if pattern == WORDS:
            self.find_words, self.find_ascii = FIND_WORDS, FIND_ASCII
        self.digits = [str(i) for i in range(max(self.names) + 1)]
        self.seen: dict[str, tuple[str, int, str]] = {t: (str(i), 1, t) for t, i in self.special.items()}

    def merge(self, words: list[bytes]) -> list[list[int]]:
        """The ids of each word. All symbols lie in one array; each round merges the lowest pair of every word that still has one."""
        lengths = np.fromiter(map(len, words), np.int64, len(words))
        data = np.frombuffer(b"".join(words), np.uint8)
        symbols = self.inner[data]
        ends = np.cumsum(lengths)
        symbols[ends - 1] = self.final[data[ends - 1]]
        owner = np.repeat(np.arange(len(words), dtype=np.int32), lengths)
        rank = self.pair_ranks(symbols, owner, np.arange(len(symbols)))
        done_symbols, done_owner = [symbols[:0]], [owner[:0]]
        while len(symbols):
            starts = np.flatnonzero(np.append(True, owner[1:] != owner[:-1]))
            best = np.repeat(np.minimum.reduceat(rank, starts), np.diff(np.append(starts, len(symbols))))
            over = best == NONE
            if over.any():
                done_symbols.append(symbols[over])
                done_owner.append(owner[over])
                symbols, owner, rank, best = symbols[~over], owner[~over], rank[~over], best[~over]
                if not len(symbols):
                    break
            hit = rank == best
            # in a run of hits, as in "aaaa", every other one counts
            place = np.arange(len(hit))
            run = np.maximum.accumulate(np.where(hit & ~np.append(False, hit[:-1]), place, -1))
            hit &= (place - run) % 2 == 0
            symbols[hit] = self.made[rank[hit]]
            stay = ~np.append(False, hit[:-1])
            symbols, owner, rank, hit = symbols[stay], owner[stay], rank[stay], hit[stay]
            hit[:-1] |= hit[1:]
            at = np.flatnonzero(hit)
            rank[at] = self.pair_ranks(symbols, owner, at)
        symbols, owner = np.concatenate(done_symbols), np.concatenate(done_owner)
        order = np.argsort(owner, kind="stable")
        flat, bounds = symbols[order].tolist(), np.searchsorted(owner[order], np.arange(len(words) + 1)).tolist()
        return [flat[a:b] for a, b in zip(bounds, bounds[1:])]

    def pair_ranks(self, symbols: np.ndarray, owner: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Ranks of the pairs that begin at the places `at`, by binary search over the sorted pair keys."""
        after = np.minimum(at + 1, len(symbols) - 1)
        pair = symbols[at] << np.uint32(16) | symbols[after]
        i = np.minimum(np.searchsorted(self.keys, pair), len(self.keys) - 1)
        return np.where((self.keys[i] == pair) & (owner[at] == owner[after]) & (after > at), self.ranks[i], NONE)

    def learn(self, words: set[str]) -> None:
        """Keep what encoding and decoding need of words."""
        new = list(words - self.seen.keys())
        if len(self.seen) + len(new) > KEPT_WORDS:
            self.seen = {t: (str(i), 1, t) for t, i in self.special.items()}
            new = list(words - self.seen.keys())
        if new:
            digits, names = self.digits.__getitem__, self.names.__getitem__
            for word, ids in zip(new, self.merge([w.encode() for w in new])):
                self.seen[word] = (" ".join(map(digits, ids)), len(ids), " ".join(map(names, ids)))

    def decode_ids(self, ids: list[int]) -> str:
        """The strings of the ids joined by a space; ids that the vocabulary hasn't are left out."""
        return " ".join([self.names[i] for i in ids if i in self.names])

    def words(self, text: str) -> list[str]:
        """What is encoded one by one: special tokens' strings as they are, and the words of what lies between, normalised."""
        if "<|" not in text:
            return self.plain_words(text)
        parts = self.split_special(text)
        return [w for i, part in enumerate(parts) for w in ([part] if i % 2 else self.plain_words(part))]

    def plain_words(self, text: str) -> list[str]:
        """Words of the NFC text with the lower case of each letter by itself."""
        if text.isascii():
            return self.find_ascii(text.lower())
        return self.find_words(unicodedata.normalize("NFC", text).replace("Σ", "σ").lower())

    def encode(self, texts: list[str]) -> Iterator[tuple[str, int, str]]:
        """(decimal ids joined by a space, how many, decoded text) of each text."""
        split = [self.words(t) for t in texts]
        self.learn(set().union(*split))
        for words in split:
            got = list(map(self.seen.__getitem__, words))
            yield " ".join([x[0] for x in got]), sum([x[1] for x in got]), " ".join([x[2] for x in got])


def _encoded(path: str, outputs: str, batch_texts: int = 512):
    def run(batches: Iterator[pa.RecordBatch]):
        bpe = WordBpe(json.loads(Path(path).read_text(encoding="utf-8")))
        for batch in batches:
            for first in range(0, batch.num_rows, batch_texts):
                part = batch.slice(first, batch_texts)
                texts = [x or "" for x in part.column("text").to_pylist()]
                ids, counts, decoded = map(list, zip(*bpe.encode(texts)))
                columns = {c: part.column(c) for c in part.schema.names if c != "text"} | {"n_tokens": pa.array(counts, pa.int64())}
                if "ids" in outputs:
                    columns["ids"] = pa.array([[int(i) for i in x.split()] for x in ids], pa.list_(pa.int32()))
                if "decoded" in outputs:
                    columns["decoded"] = pa.array(decoded, pa.string())
                if "sha" in outputs:
                    columns["ids_sha256"] = pa.array([hashlib.sha256(x.encode()).hexdigest() for x in ids], pa.string())
                    columns["decoded_sha256"] = pa.array([hashlib.sha256(x.encode()).hexdigest() for x in decoded], pa.string())
                yield pa.RecordBatch.from_arrays(list(columns.values()), list(columns))

    return run


def encode(docs: DataFrame, vocabulary: str | None = None, keep: list[str] | None = None, outputs: tuple[str, ...] = ("ids", "decoded")) -> DataFrame:
    """Encode whole texts and decode the ids again.

    Returns one row per row of docs with the columns named in keep (doc_id, if not given), n_tokens, and by outputs:
    ids (array of int), decoded (the ids' strings, joined by a space as the file has no decoder), sha (ids_sha256 of
    the decimal ids joined by a space, decoded_sha256). Null texts are empty; an empty text has no token.
    Special tokens' strings in a text become their ids. Repeated rows stay. Each text is read once and nothing is shuffled.

    vocabulary: path of the file, which every executor has to have; default: that of the public tokenizers.
    """
    keep = keep or ["doc_id"]
    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in docs.select(*keep).schema] + ["n_tokens long"]
    fields += ["ids array<int>"] * ("ids" in outputs) + ["decoded string"] * ("decoded" in outputs) + ["ids_sha256 string", "decoded_sha256 string"] * ("sha" in outputs)
    return docs.select(*keep, "text").mapInArrow(_encoded(vocabulary or default_vocabulary(), "+".join(outputs)), ", ".join(fields))
