"""Runs against brute force: sequences of few words, planted repeats, odd rows, and the query on sf0.001."""

import hashlib
import random
import re
import zlib
from fractions import Fraction

import numpy as np
import pytest

from sessionloom.llm import periodic_runs, queries

WORD = re.compile("[^\x20\x09-\x0d]+")


def brute(words, least=24, repeats=3):
    """(start, period, length) of all runs, by the matches of every period."""
    out = {}
    for q in range(1, len(words) // repeats + 1):
        start = 0
        for i in range(len(words) - q + 1):
            if i == len(words) - q or words[i] != words[i + q]:
                if i - start + q >= max(least, repeats * q) and i > start:
                    out.setdefault((start, i + q), q)
                start = i + 1
    return sorted((s, q, e - s) for (s, e), q in out.items())


@pytest.mark.parametrize("seed", range(12))
def test_random_sequences(seed):
    rng = random.Random(seed)
    texts = []
    for _ in range(40):
        alphabet, text = rng.choice([1, 2, 3, 20]), []
        while len(text) < rng.randrange(1, 400):
            piece = [rng.randrange(alphabet) for _ in range(rng.randrange(1, 30))]
            text += piece * rng.choice([1, 1, 2, 3, 5])
        texts.append(text[: rng.randrange(0, 400)])
    texts += [[], [7], [5] * 23, [5] * 24, [1, 2] * 12, [1, 2, 3] * 8 + [1], [4] * 700]
    least, repeats = rng.choice([(24, 3), (24, 3), (4, 2), (1, 2), (9, 5)])
    ids, bounds = np.array([w for t in texts for w in t], np.int64), np.append(0, np.cumsum([len(t) for t in texts]))
    got = periodic_runs.runs_of(ids, bounds, least, repeats).tolist()
    assert [[n, s, size, q] for n, t in enumerate(texts) for s, q, size in brute(t, least, repeats)] == got


def test_extensions():
    rng = np.random.default_rng(3)
    for alphabet in (1, 2, 5):
        walls = 3
        sequence = np.concatenate(([0], rng.integers(walls, walls + alphabet, 500), [1], rng.integers(walls, walls + alphabet, 300), [2]))
        grammar = periodic_runs.Grammar(sequence, walls, 5)
        a = rng.integers(0, len(sequence) - 1, 400)
        b = np.minimum(a + rng.integers(1, 50, 400), len(sequence) - 1)
        for back, way in ((False, 1), (True, -1)):
            want = []
            for i, j in zip(a[b > a].tolist(), b[b > a].tolist()):
                n = 0
                while sequence[i + way * n] == sequence[j + way * n]:
                    n += 1
                want.append(n)
            assert grammar.extensions(a[b > a], b[b > a], back).tolist() == want


def edited(i, text):
    words = WORD.findall(text or "")
    if i is None or not words or zlib.crc32(str(i).encode()) % 10:
        return words
    n, g = len(words), zlib.crc32(str(i).encode()) // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return words[:a] + [words[a + (k - a) % p] for k in range(a, n)]


def expected(words):
    runs = brute(words)
    gone = {k for s, q, size in runs for k in range(s + q, s + size)}
    best = min(runs, key=lambda r: (-Fraction(r[2], r[1]), r[0], r[1]), default=None)
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    own = (best[0], best[2], best[1], 1000 * best[2] // best[1]) if best else (None,) * 4
    return (len(runs), *own, sha("".join(f"{s},{size},{q}\n" for s, q, size in runs)), sha(" ".join(w for k, w in enumerate(words) if k not in gone)))


def test_query_equals_brute_force(spark):
    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet").collect()
    got = {r["doc_id"]: tuple(r)[1:] for r in queries.QUERIES["op11_periodic_runs"](spark, sf).collect()}
    assert len(got) == len(docs)
    short = [r for r in docs if len(r["text"] or "") < 12_000]
    assert len(short) > 150 and sum(got[r["doc_id"]][0] > 0 for r in short) > 5
    for r in short:
        assert got[r["doc_id"]] == expected(edited(r["doc_id"], r["text"])), r["doc_id"]


def test_odd_rows(spark):
    one = "a b c d e f g h "
    rows = [(1, None), (2, ""), (3, " \n\t "), (4, one * 3), (5, one * 3 + "a b"), (5, one * 3 + "a b"), (None, one * 9), (None, None), (6, "x " * 23), (7, "x\n" * 24 + "y"), (8, "é É " * 15), (9, "w" * 40_000), (10, "q " * 60_000), (11, "solo")]
    rows += [(100 + k, (one * 4).upper() + "z " * 30) for k in range(60)]
    docs = spark.createDataFrame([(i, t, [1], "c", 1, 2, 3) for i, t in rows], "doc_id long, text string, runs array<int>, collapsed string, start int, _n int, _own int")
    plain = periodic_runs.find_runs(docs).collect()
    assert len(plain) == len(rows)
    for (i, t), r in zip(rows, plain):
        words = WORD.findall(t or "")
        runs = [(x["start"], x["period"], x["length"]) for x in r["runs"]]
        assert r["doc_id"] == i and r["n_words"] == len(words)
        assert runs == (brute(words) if len(words) < 5000 else [(0, 1, len(words))])
        gone = {k for s, q, size in runs for k in range(s + q, s + size)}
        assert r["collapsed"] == " ".join(w for k, w in enumerate(words) if k not in gone)
    got = periodic_runs.described(periodic_runs.find_runs(periodic_runs.planted(docs.drop("_n", "_own")))).collect()
    for (i, t), r in zip(rows, got):
        if len(t or "") < 100_000:
            assert tuple(r)[1:] == expected(edited(i, t)), i
    assert periodic_runs.find_runs(docs.limit(0)).count() == 0
