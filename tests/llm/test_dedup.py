"""Exact, near, substring and line deduplication against plain Python, on rows with every odd case."""

import hashlib
import random
import re

import numpy as np
import pytest
import xxhash

from sessionloom.llm import exact_dedup, line_dedup, simhash, substring_dedup
from sessionloom.llm.components import components

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, tie string, key int, row int, size int, kept boolean, fp string, spans string, places string, anchor int, site int, nth int, pos int, line int"
WORD = re.compile("[^\x20\x09-\x0d]+")


def table(spark, rows):
    """documents with columns whose names the operators use inside."""
    return spark.createDataFrame([(i, t, None, s, None, "x", 1, 2, 3, True, "f", "s", "p", 4, 5, 6, 7, 8) for i, t, s in rows], SCHEMA)


def prose(n, seed, vocabulary=400):
    rng = random.Random(seed)
    return " ".join(f"w{rng.randrange(vocabulary)}" for _ in range(n))


@pytest.fixture(scope="module")
def rows():
    base, passage = prose(300, 1), prose(80, 2)
    out = [(1, base, "a"), (2, base.upper(), "b"), (3, base, None), (4, None, "a"), (5, "", "b"), (6, "  \n\t ", "a"), (7, "One two", "a"), (8, "one TWO", "c"), (9, "É é", "a"), (10, "é é", "a")]
    out += [(11, prose(60, 3) + " " + passage + " " + prose(30, 4), "a"), (12, passage, "b"), (13, prose(10, 5) + "\n" + passage + " tail", "c"), (14, passage[:-3], "a"), (15, prose(20_000, 6, 5000), "a")]
    out += [(16, "a " * 3000, "a"), (17, "a " * 200, "b"), (None, base, "a"), (None, prose(120, 7), "d"), (20, prose(90, 8), "a"), (20, prose(90, 8), "a"), (20, prose(90, 9), "b")]
    words = base.split()
    for k in range(60):  # a crowd of near copies
        other = words[:]
        other[3 * k] = f"new{k}"
        out.append((100 + k, " ".join(other), "e"))
    return out


def test_exact(spark, rows):
    for bits in (64, 3):
        got = exact_dedup.exact_groups(table(spark, rows), key_bits=bits).collect()
        assert len(got) == len(rows)
        groups = {}
        for i, t, _ in rows:
            body = (t or "").encode().lower()
            groups.setdefault(hashlib.sha256(body).hexdigest(), []).append(i)
        for r in got:
            own = groups[r["text_sha256"]]
            best = max((i for i in own if i is not None), default=None)
            assert r["group_size"] == len(own) and r["keep_id"] == best and (not r["kept"] or r["doc_id"] == best)
        assert sum(r["kept"] for r in got) == len(groups)


def test_exact_rows_kept(spark, rows):
    docs = table(spark, rows)
    out = exact_dedup.without_copies(docs)
    assert out.columns == docs.columns
    texts = [(r["text"] or "").encode().lower() for r in out.collect()]
    assert sorted(texts) == sorted({(t or "").encode().lower() for _, t, _ in rows})


def fingerprint(text):
    w = (text or "").encode().lower().split()
    s = [b" ".join(w[i : i + 4]) for i in range(len(w) - 3)] if len(w) >= 4 else [b" ".join(w)] if w else []
    h = [xxhash.xxh64_intdigest(x, 42) for x in s]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def brute_components(fps):
    label = list(range(len(fps)))
    again = True
    while again:
        again = False
        for a in range(len(fps)):
            for b in range(len(fps)):
                if label[b] < label[a] and (fps[a] ^ fps[b]).bit_count() <= 4:
                    label[a], again = label[b], True
    return label


@pytest.mark.parametrize(("levels", "room"), [(simhash.LEVELS, simhash.ROOM), ((5, 9, 40, 64), 6000), ((64,), 1)])
def test_near(spark, rows, levels, room):
    got = simhash.near_groups(table(spark, rows), levels=levels, room=room).collect()
    fps = [fingerprint(t) for _, t, _ in rows]
    label = brute_components(fps)
    least = {}
    for (i, _, _), c in zip(rows, label):
        if i is not None:
            least[c] = min(least.get(c, i), i)
    want = sorted((str(i), f"{f:016x}", str(least.get(c))) for (i, _, _), f, c in zip(rows, fps, label))
    assert sorted((str(r["doc_id"]), r["fingerprint"], str(r["component_id"])) for r in got) == want
    assert len({r["component_id"] for r in got if r["kept"]}) == len(least)


def test_links_lose_nothing(spark):
    rng = np.random.default_rng(1)
    centers = rng.integers(0, 1 << 63, 20, dtype=np.uint64)
    fps = []
    for c in centers:
        for _ in range(40):
            flips = rng.choice(64, rng.integers(0, 6), replace=False)
            fps.append(int(c) ^ sum(1 << int(b) for b in flips))
    fps = sorted(set(fps))
    df = spark.createDataFrame([(f - (1 << 64) if f >> 63 else f,) for f in fps], "fp long")
    label = brute_components(fps)
    signed = [f - (1 << 64) if f >> 63 else f for f in fps]
    near = {(a, b) for i, a in enumerate(signed) for b in signed[:i] if ((a ^ b) & (1 << 64) - 1).bit_count() <= 4}
    for levels, room in ((simhash.LEVELS, simhash.ROOM), ((8, 11, 64), 12_000)):
        edges = simhash.links(df, levels=levels, room=room)
        assert all((r["u"], r["v"]) in near or (r["v"], r["u"]) in near for r in edges.collect())
        roots = {r["node"]: r["root"] for r in components(edges).collect()}
        got = [roots.get(s, s) for s in signed]
        for a in range(len(fps)):
            for b in range(a):
                assert (label[a] == label[b]) == (got[a] == got[b])


def test_places_hold_the_full_ball():
    """Over all places, each of the 2081 variants of a fingerprint is emitted once, at any level."""
    for bits in (5, 12, 40):
        at_place = [len(simhash._flips(bits, d)) - (len(simhash._flips(bits, d - 1)) if d else 0) for d in range(3)]
        assert sum(n * len(simhash._flips(64 - bits, 2 - d)) for d, n in enumerate(at_place)) == 2081


def test_near_rows_kept(spark, rows):
    docs = table(spark, rows)
    kept = simhash.first_of_groups(docs).collect()
    groups = simhash.similar_groups(docs).collect()
    assert len(groups) == len(rows)
    assert {(r["doc_id"]) for r in kept} == {r["doc_id"] for r in groups if r["kept"]}


def brute_substrings(rows, length):
    words = [WORD.findall(t or "") for _, t, _ in rows]
    first = {}
    for (i, _, _), w in zip(rows, words):
        for p in range(len(w) - length + 1):
            if i is not None:
                k = tuple(w[p : p + length])
                first[k] = min(first.get(k, i), i)
    out = []
    for (i, _, _), w in zip(rows, words):
        gone = [False] * len(w)
        for p in range(len(w) - length + 1):
            if i is not None and first[tuple(w[p : p + length])] < i:
                gone[p : p + length] = [True] * length
        kept = " ".join(x for x, g in zip(w, gone) if not g)
        out.append((str(i), len(w), sum(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return sorted(out)


@pytest.mark.parametrize(("length", "seed"), [(50, 16), (12, 5)])
def test_substrings(spark, rows, length, seed):
    got = substring_dedup.without_repeats(table(spark, rows), length, seed).collect()
    assert sorted((str(r["doc_id"]), r["n_words"], r["n_removed"], r["kept_sha256"]) for r in got) == brute_substrings(rows, length)


def test_matches_with_others_than_the_leading_context(spark, monkeypatch):
    """An anchor of many contexts, of which each agrees with the leading one less than with some other."""
    monkeypatch.setattr(substring_dedup, "SHARE", 3)
    rng, rows = random.Random(3), []
    core = prose(6, 1, 9)
    sides = [(prose(12, 10 + k, 5), prose(12, 30 + k, 5)) for k in range(4)]
    for i in range(60):
        (left, _), (_, right) = rng.choice(sides), rng.choice(sides)
        own = rng.randrange(13)
        rows.append((i, f"u{i} " + " ".join(left.split()[own:]) + f" {core} " + " ".join(right.split()[: 12 - own]) + f" v{i}", "a"))
    got = substring_dedup.without_repeats(table(spark, rows), 12, 5).collect()
    assert sorted((str(r["doc_id"]), r["n_words"], r["n_removed"], r["kept_sha256"]) for r in got) == brute_substrings(rows, 12)
    assert sum(r["n_removed"] for r in got) > 300


def test_anchor_in_every_window():
    rng = np.random.default_rng(0)
    text = " ".join(f"w{x}" for x in rng.integers(0, 30, 3000)).encode()
    words = substring_dedup.Words(np.frombuffer(text, np.uint8), np.array([0, len(text)]))
    at = substring_dedup.anchors(words, 50, 16)
    assert all(((at >= p) & (at + 16 <= p + 50)).any() for p in range(3000 - 49)) and len(at) < 3000 / 10


def test_lines(spark):
    rng = random.Random(0)
    pool = [f"line {k}" for k in range(12)] + ["", "  ", "\t", "é", "E"]
    rows = [(i if i % 9 else None, "\n".join(rng.choice(pool[: 5 + i % 12]) for _ in range(i % 14)) if i % 11 else None, rng.choice(["s1", "s2", "s3", "s4", None])) for i in range(120)]
    for sites in (1, 3, 5):
        sources = {}
        for _, t, s in rows:
            for x in (t or "").split("\n"):
                sources.setdefault(x, set()).add(s)
        want = []
        for i, t, _ in rows:
            lines = (t or "").split("\n")
            kept = [x for x in lines if not x.strip(" \t") or len(sources[x]) < sites]
            want.append((str(i), len(lines), len(lines) - len(kept), "\n".join(kept)))
        got = line_dedup.without_boilerplate(table(spark, rows), sites=sites).collect()
        assert sorted((str(r["doc_id"]), r["n_lines"], r["n_removed"], r["kept_text"]) for r in got) == sorted(want)


def test_sketches_decide_far_from_the_threshold(spark):
    """Lines of 1 to 600 sites at a threshold of 100: near it all are exact, far from it sketches are right."""
    spread = [1, 2, 50, 84, 95, 99, 100, 101, 110, 130, 300, 600]
    lines = spark.createDataFrame([(k, k, f"s{x}") for k in spread for x in range(k) for _ in range(2)], "key long, check int, site string")
    assert sorted(r["key"] for r in line_dedup.boilerplate(lines, 100).collect()) == [k for k in spread if k >= 100]


def test_many_places_of_one_text(spark):
    text = "\n".join(f"line {k}" if k % 2 else f"own {k}" for k in range(30_000))
    other = "\n".join(f"line {k}" for k in range(1, 30_000, 2))
    got = line_dedup.without_boilerplate(table(spark, [(1, text, "a"), (2, other, "b"), (3, other, "c")])).collect()
    assert sorted((r["doc_id"], r["n_removed"], r["kept_text"].count("\n")) for r in got) == [(1, 15_000, 14_999), (2, 15_000, 0), (3, 15_000, 0)]


def test_empty_tables(spark):
    docs = table(spark, [])
    for f in (exact_dedup.exact_groups, exact_dedup.without_copies, simhash.near_groups, simhash.first_of_groups, substring_dedup.without_repeats, line_dedup.without_boilerplate):
        assert f(docs).count() == 0
