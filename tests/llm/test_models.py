"""Classifier, language models, encoder, mixing, secrets and fingerprints."""

import collections
import hashlib
import json
import math
import random
import re
import tracemalloc
from pathlib import Path

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from sessionloom.llm import bpe, lm_score, minhash, mixing, quality_cnn, secrets
from tests.llm.test_dedup import WORD, prose, table

SF = Path("/root/testdata/sf0.01")


def test_classifier_on_held_out_rows(spark):
    docs, labels = spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet")
    out = quality_cnn.score(docs, quality_cnn.train(docs, labels), ["doc_id"]).join(labels, "doc_id").where(quality_cnn.held_out(F.col("doc_id"))).toPandas()
    good, bad = out.score[out.quality == 1].to_numpy(), out.score[out.quality == 0].to_numpy()
    auc = (good[:, None] > bad).mean() + (good[:, None] == bad).mean() / 2
    assert auc > 0.9 and (out.predicted[out.quality == 1] == 1).mean() > 0.95


def test_classifier_gradients():
    net = quality_cnn.ByteCnn(3)
    for name in ("embed", "conv", "conv_bias", "out", "out_bias"):
        setattr(net, name, getattr(net, name).astype(np.float64))
    net.conv_bias += 0.05  # an empty text else lies on the edge of the rectifier
    rng = np.random.default_rng(0)
    data = rng.integers(32, 127, 3000).astype(np.uint8)
    offsets, labels = np.array([0, 900, 900, 2000, 3000]), np.array([1.0, 0.0, 0.0, 1.0])
    grads = net.gradients(data, offsets, labels)

    def loss():
        p = net.score(data, offsets, settled=False)
        return -(labels * np.log(p) + (1 - labels) * np.log(1 - p)).mean()

    for w, g in zip(net.weights(), grads):
        for at in rng.integers(0, w.size, 6):
            at = np.unravel_index(at, w.shape)
            if w is net.embed and at[0] == quality_cnn.PAD:
                continue
            old, step = w[at], 1e-6
            w[at] = old + step
            up = loss()
            w[at] = old - step
            down = loss()
            w[at] = old
            assert g[at] == pytest.approx((up - down) / (2 * step), abs=1e-5)


def test_classifier_covers_whole_texts():
    for n in (0, 1, 512, 513, 1008, 5000):
        offsets = np.array([0, n])
        owner, start, first = quality_cnn._layout(offsets)
        codes = quality_cnn._codes(np.arange(n).astype(np.uint8), offsets, owner, start)
        assert first.tolist() == [0] and (codes != quality_cnn.PAD).sum() >= n
        for p in range(0, max(0, n - quality_cnn.WIDTH)):
            assert any(k * quality_cnn.STEP <= p and p + quality_cnn.WIDTH <= k * quality_cnn.STEP + quality_cnn.CHUNK for k in range(len(codes)))


def test_classifier_scores_do_not_depend_on_batches(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    docs = docs.unionByName(docs.where("doc_id < 3").select(F.col("doc_id") + 1_000_000, F.repeat("text", 400).alias("text")).toDF("doc_id", "text"))
    model = quality_cnn.ByteCnn(4)
    scores = [sorted(map(tuple, quality_cnn.score(docs.repartition(n), model, ["doc_id"]).collect())) for n in (1, 7, 60)]
    assert scores[0] == scores[1] == scores[2]


def test_classifier_sample_is_bounded(spark, monkeypatch):
    seen = []
    monkeypatch.setattr(quality_cnn.ByteCnn, "fit", lambda self, texts, labels: seen.append((texts, labels.tolist())))
    docs = table(spark, [(i, f"text {i} " * 10, "a") for i in range(1, 60)] + [(5, "again", "a")] * 40 + [(77, "x" * 5000, "a")])
    labels = spark.createDataFrame([(i, i % 2) for i in range(1, 80)], "doc_id long, quality int")
    quality_cnn.train(docs, labels, 1000)
    quality_cnn.train(docs, labels, 10)
    quality_cnn.train(docs, labels, 1000, 1500)
    assert len(seen[0][0]) > 40 and len(set(seen[0][0])) == len(seen[0][0]) and len(seen[1][0]) <= 10 and 0 < sum(map(len, seen[2][0])) <= 1500
    assert all(len(t) == len(y) for t, y in seen)


def test_a_long_labelled_text_is_passed_over(spark, monkeypatch):
    """The first text of the order is beyond the bound; the others still are the sample."""
    seen = []
    monkeypatch.setattr(quality_cnn.ByteCnn, "fit", lambda self, texts, labels: seen.append(texts))
    rows = [(i, f"text {i} " * 10, "a") for i in range(1, 60)]
    labels = spark.createDataFrame([(i, i % 2) for i in range(1, 60)], "doc_id long, quality int")
    first = labels.where(~quality_cnn.held_out(F.col("doc_id"))).orderBy(F.xxhash64("doc_id")).first()["doc_id"]
    quality_cnn.train(table(spark, [(i, t * 100 if i == first else t, s) for i, t, s in rows]), labels, 1000, 5000)
    assert len(seen[0]) > 30 and max(map(len, seen[0])) < 200


def test_gradients_hold_a_block_at_a_time(monkeypatch):
    """The same slopes whatever the block; beside a text of 8 MB, less than 200 bytes for each of its chunks of 512 and a few MB."""
    rng = np.random.default_rng(0)
    data, offsets, labels = rng.integers(0, 256, 40_000, dtype=np.uint8), np.array([0, 9000, 9000, 9100, 40_000]), np.array([1.0, 0.0, 0.0, 1.0])
    one = quality_cnn.ByteCnn().gradients(data, offsets, labels)
    monkeypatch.setattr(quality_cnn, "BLOCK", 7)
    assert all(np.allclose(a, b, atol=1e-5) for a, b in zip(one, quality_cnn.ByteCnn().gradients(data, offsets, labels)))
    monkeypatch.undo()
    text = rng.integers(0, 256, 8_000_000, dtype=np.uint8)
    tracemalloc.start()
    quality_cnn.ByteCnn().gradients(text, np.array([0, len(text)]), np.array([1.0]))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 60_000_000


def test_classifier_odd_rows(spark):
    docs = table(spark, [(1, None, "a"), (2, "", "a"), (None, "x " * 100_000, None), (3, "y", "b"), (3, "y", "b")])
    none = spark.createDataFrame([], "doc_id long, quality int, extra string")
    out = quality_cnn.score(docs, quality_cnn.train(docs, none), ["doc_id"]).collect()
    assert len(out) == 5 and all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.3) for r in out)
    assert quality_cnn.score(docs.limit(0), quality_cnn.ByteCnn(), ["doc_id"]).count() == 0


def brute_language_models(rows, targets):
    """(id, words, target, background) of each row, with its own counts taken off."""
    smooth = lm_score.SMOOTHING
    seqs = [["", *WORD.findall(t or ""), ""] for _, t, _ in rows]
    seqs = [s if len(s) > 2 else [] for s in seqs]
    pairs, words = [collections.Counter(), collections.Counter()], [collections.Counter(), collections.Counter()]
    model = [0 if i in targets else 1 for i, _, _ in rows]
    for m, s in zip(model, seqs):
        pairs[m].update(zip(s, s[1:]))
        words[m].update(s[1:])
    size = len({w for m in words for w in m})
    for (i, _, _), m, s in zip(rows, model, seqs):
        ce, own, own_words = [], collections.Counter(zip(s, s[1:])), collections.Counter(s[1:])
        for k in (0, 1):
            less = lambda c, o, x: c[x] - (o[x] if k == m else 0)  # noqa: B023, E731
            loss = 0.0
            for h, w in zip(s, s[1:]):
                share = words[k].total() / (words[0].total() + words[1].total())
                prior = (less(words[k], own_words, w) + share) / (words[k].total() + share * (size + 1))
                loss -= math.log((less(pairs[k], own, (h, w)) + smooth * prior) / (less(words[k], own_words, h) + smooth))
            ce.append(loss / max(1, len(s) - 1))
        yield str(i), max(0, len(s) - 2), *ce


def test_language_models_against_counts(spark, monkeypatch):
    rows = [(i, prose(30 + i, i, 40), "a") for i in range(1, 30)] + [(40, None, "a"), (41, " \n", "a"), (None, prose(20, 99, 40), "b"), (7, prose(37, 7, 40), "a"), (50, prose(5000, 50, 300), "c")]
    rows += [(60 + i, "the same pair in the same text " * 3 + prose(9, i, 9), "d") for i in range(30)]
    ids = (1, 2, 3, 7, 7, 40, 63, None)
    targets = spark.createDataFrame([(i,) for i in ids], "doc_id long")
    want = sorted(brute_language_models(rows, set(ids) - {None}))
    for hot, part, size in ((1 << 16, 1 << 20, 1 << 22), (1, 300, 400), (40, 1000, 3000), (1 << 16, 50, 1 << 22)):
        monkeypatch.setattr(lm_score, "SLICE", size)
        got = lm_score.score(table(spark, rows), targets, hot, part).collect()
        assert len(got) == len(rows)
        for r, (i, k, a, b) in zip(sorted(got, key=lambda r: (str(r["doc_id"]), r["n_tokens"])), want):
            assert str(r["doc_id"]) == i and r["n_tokens"] == k and r["ce_target"] == pytest.approx(a, abs=2e-6) and r["ce_background"] == pytest.approx(b, abs=2e-6)
            assert r["ce_difference"] == pytest.approx(a - b, abs=4e-6)
    monkeypatch.setattr(lm_score, "BROADCAST_IDS", 0)
    assert sorted(map(str, lm_score.score(table(spark, rows), targets).collect())) == sorted(map(str, got))
    assert lm_score.score(table(spark, []), targets).count() == 0


def test_language_models_keep_every_word(spark):
    """70,000 words that are all as frequent have counts of their own, and ids may be strings."""
    words = [f"w{i}" for i in range(70_000)]
    docs = spark.createDataFrame([(f"d{i}", " ".join(words)) for i in range(3)], "doc_id string, text string")
    got = lm_score.score(docs, spark.createDataFrame([("d0",)], "doc_id string")).collect()
    for r in got:
        seen = 1 if r["doc_id"] == "d0" else 0  # of the one target text, what is left without itself
        left = [1 - seen, 1 + seen]
        for ce, n, k in ((r["ce_target"], left[0], 1), (r["ce_background"], left[1], 2)):
            prior = (n + k / 3) / (k * 70_001 + k / 3 * 70_002)
            assert ce == pytest.approx(-math.log((n + lm_score.SMOOTHING * prior) / (n + lm_score.SMOOTHING)), abs=2e-6)


ODD = ["", "   ", "<|endoftext|>A<|startoftext|> x's 12 É é ΑΣ İ aaaaaaa aaaaaaaa \x1c a\x1db ﬁ Å \u0085z", "a" * 3000, "<|startoftext|>", "don't I'LL we'Ve", "ẞ straße 你好 😀😀 ¼½ ²", "é   x y"]


def test_encoder_equals_the_library(spark):
    tokenizers = pytest.importorskip("tokenizers")
    lib = tokenizers.Tokenizer.from_file(bpe.default_vocabulary())
    texts = ODD + [r["text"] for r in spark.read.parquet(f"{SF}/documents.parquet").where("doc_id % 7 = 0").collect()]
    docs = table(spark, [(i, t, "a") for i, t in enumerate(texts)] + [(None, None, "a"), (1, "x", "a"), (1, "x", "a")])
    got = bpe.encode(docs, outputs=("ids", "decoded", "sha")).collect()
    assert len(got) == len(texts) + 3
    want = {i: lib.encode(t, add_special_tokens=False).ids for i, t in enumerate(texts)}
    for r in got:
        if r["doc_id"] is None:
            assert r["n_tokens"] == 0 and r["ids"] == [] and r["decoded"] == ""
        elif r["doc_id"] != 1:
            ids = want[r["doc_id"]]
            assert r["ids"] == ids and r["n_tokens"] == len(ids) and r["decoded"] == lib.decode(ids, skip_special_tokens=False)
            assert r["ids_sha256"] == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest() and r["decoded_sha256"] == hashlib.sha256(r["decoded"].encode()).hexdigest()
    assert bpe.encode(docs.limit(0)).count() == 0


def test_encoder_forgets_words(monkeypatch):
    monkeypatch.setattr(bpe, "KEPT_WORDS", 50)
    enc = bpe.WordBpe(json.loads(Path(bpe.default_vocabulary()).read_text()))
    once = bpe.WordBpe(json.loads(Path(bpe.default_vocabulary()).read_text()))
    texts = [prose(40, s, 1000) for s in range(6)]
    assert [next(enc.encode([t])) for t in texts] == list(once.encode(texts))


def water_levels(sizes, weights, most):
    """Targets by sharing again and again what is above."""
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    w = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    total, full = sum(sizes.values()), set()
    while True:
        rest = total - sum(most * sizes[s] for s in full)
        free = sum(w[s] for s in names if s not in full)
        target = {s: most * sizes[s] if s in full else rest * w[s] / free for s in names}
        over = {s for s in names if s not in full and target[s] > most * sizes[s]}
        if not over:
            return target
        full |= over


@pytest.mark.parametrize("bucket", [4, 4096])
def test_mixing(spark, bucket):
    rng = random.Random(2)
    rows = [(i, prose(rng.randrange(0, 60), i), rng.choice(["big"] * 6 + ["b", "c", "é", "Z", None])) for i in range(150)] + [(None, "x y", "big"), (3, prose(9, 3), "big"), (3, prose(9, 3), "big"), (400, None, "b"), (401, None, "nothing")]
    docs = table(spark, rows)
    got = mixing.mix(docs, bucket=bucket).collect()
    again = mixing.mix(docs.repartition(7), bucket=bucket).collect()
    assert sorted(map(str, got)) == sorted(map(str, again)) and len(got) == len(rows)
    sizes = collections.Counter()
    for _, t, s in rows:
        sizes[s] += len(WORD.findall(t or ""))
    targets = water_levels(dict(sizes), [1, 2, 3], 3)
    for s in sizes:
        own = [r for r in got if r["source"] == s]
        assert {r["source_size"] for r in own} == {sizes[s]} and own[0]["target"] == pytest.approx(targets[s])
        assert sum(r["taken"] for r in own) == math.floor(own[0]["target"] + 1e-9) or sizes[s] == 0
        times = {r["taken"] // r["size"] for r in own if r["size"]}
        assert all(0 <= r["taken"] <= 3 * r["size"] for r in own) and (not times or max(times) - min(times) <= 1)
    mixed = mixing.mixed_documents(docs)
    want = sum(-(-r["taken"] // r["size"]) for r in got if r["taken"])
    assert mixed.count() == want and mixed.exceptAll(docs.select(mixed.columns).unionAll(docs.select(mixed.columns)).unionAll(docs.select(mixed.columns))).isEmpty()
    assert mixing.mix(docs.limit(0)).count() == 0


ASSIGN = re.compile(r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")


def base_spans(text):
    out = [(m.start(), 0, m.end(), "assign") for m in ASSIGN.finditer(text) if len(m[2]) >= 8]
    out += [(m.start(), 1, m.end(), "access") for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 16]
    out += [(m.start(), 2, m.end(), "hex") for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 32]
    return ",".join(f"{k}:{a}:{b}" for a, _, b, k in sorted(out))


def test_secrets(spark):
    live, copied, hexa = "qR7tY2uI9oP4aS6dF8gH1", "EXAMPLEkey12345678abc", "0123456789abcdef" * 3
    rows = [
        (1, f"é Password = '{live}' and token=secret:abcdefgh12 x", "a"), (2, f"loose {live} here", "a"), (3, f"API_KEY:{copied}", "a"), (4, f'apikey": "{copied}"', "b"), (5, f"secret={copied}", "c"), (6, f"say {copied}", "d"),
        (7, f"AKIA{'B' * 12} AKIA123 AKIA{'C' * 30}", "a"), (8, f"x{hexa}g {hexa[:31]}", "a"), (9, None, None), (10, "", "a"), (None, f"passwd:{'z' * 8}", None), (11, "token: ab", "a"), (12, "token=token=abcdefgh1", "a"),
        (13, ("word " * 50_000) + f"passwd = {live}", "a"), (14, f"key {live}", "a"), (14, f"key {live}", "a"), (15, "tOKen  :=abcdefgh9", "q"), (16, f"😀😀 secret={live}", "a"),
    ]
    got = {(str(r["doc_id"])): r for r in secrets.scan(table(spark, rows)).collect()}
    for i, t, _ in rows:
        r, want = got[str(i)], base_spans(t or "")
        assert r["base_sha256"] == hashlib.sha256(want.encode()).hexdigest(), (t or "")[:60]
        assert ",".join(s for s in r["spans"].split(",") if not s.startswith("bare")) == want
        assert (r["n_assign"], r["n_access"], r["n_hex"]) == tuple(want.count(k + ":") for k in ("assign", "access", "hex"))
    assert got["2"]["spans"] == f"bare:6:{6 + len(live)}" and got["1"]["n_live"] == 1 and got["14"]["spans"].startswith("bare:4:")
    assert got["6"]["spans"] == "" and got["3"]["n_example"] == 1 and got["3"]["n_live"] == 0 and got["3"]["most_copies"] == 4
    assert secrets.scan(table(spark, [])).count() == 0


def test_secrets_against_brute_force(spark):
    """Verdicts of random values over random owners and repositories, and of a text of very many matches."""
    rng = random.Random(5)
    values = ["".join(rng.choice("abcDEF0123456789xyzQRS") for _ in range(24)) for _ in range(40)] + ["lowercase" * 4, "A" * 30]
    rows = []
    for i in range(400):
        own = [rng.choice(values[: 1 + rng.randrange(len(values))]) for _ in range(rng.randrange(4))]
        rows.append((i, " ".join(f"token={v}" if rng.random() < 0.5 else v for v in own) + " end", rng.choice(["big"] * 9 + ["a", "b", None])))
    rows.append((1000, " ".join(f"secret={'k' * 8}{k} AKIA{k:012d}" for k in range(16_000)), "z"))
    got = {r["doc_id"]: r for r in secrets.scan(table(spark, rows), copied_owners=3, copied_repositories=30).collect()}
    marked, spread = {}, {}
    for i, t, s in rows:
        base = [(m.start(), 0, m.end(), m[2]) for m in ASSIGN.finditer(t) if len(m[2]) >= 8]
        base += [(m.start(), 1, m.end(), m[0]) for m in re.finditer("AKIA[A-Z0-9]+", t) if len(m[0]) >= 16]
        base += [(m.start(), 2, m.end(), m[0]) for m in re.finditer("[0-9a-f]+", t) if len(m[0]) >= 32]
        bare = [(m.start(), 3, m.end(), m[0]) for m in re.finditer("[A-Za-z0-9+/_-]{20,}", t) if all(re.search(c, m[0]) for c in ("[0-9]", "[A-Z]", "[a-z]"))]
        bare = [b for b in bare if i == 1000 or not any(x[0] < b[2] and b[0] < x[2] for x in base)] if i != 1000 else []
        marked[i] = base + bare
        for *_, v in marked[i]:
            spread.setdefault(v, set()).add((s, i))
    live = lambda v: len(v) >= 16 and re.search("[0-9]", v) and re.search("[A-Za-z]", v) and len(set(v)) >= 8
    example = {v: len({s for s, _ in x}) >= 3 or len(x) >= 30 for v, x in spread.items()}
    assert len(set(example.values())) == 2
    for i, _, _ in rows:
        kept = [x for x in marked[i] if x[1] < 3 or (live(x[3]) and not example[x[3]])]
        assert got[i]["spans"] == ",".join(f"{['assign', 'access', 'hex', 'bare'][k]}:{a}:{b}" for a, k, b, _ in sorted(kept)), i
        assert got[i]["n_example"] == sum(example[x[3]] for x in marked[i]) and got[i]["n_live"] == sum(bool(live(x[3]) and not example[x[3]]) for x in marked[i])
        assert got[i]["most_copies"] == max((len(spread[x[3]]) for x in marked[i]), default=0)
    assert got[1000]["n_assign"] == got[1000]["n_access"] == 16_000
    assert any(r["spans"].count("bare:") for r in got.values())


def test_encoder_refuses_what_it_does_not_follow():
    spec = json.loads(Path(bpe.default_vocabulary()).read_text())
    for change in ({"normalizer": {"type": "NFKC"}}, {"model": spec["model"] | {"dropout": 0.1}}, {"added_tokens": [{"id": 1, "content": "<mask>"}]}, {"pre_tokenizer": {"type": "Whitespace"}}, {"decoder": {"type": "ByteLevel"}}):
        with pytest.raises(ValueError, match=next(iter(change))):
            bpe.WordBpe(spec | change)


def shingles(text):
    w = WORD.findall(text)
    return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def brute_fingerprint(text):
    """The bins of a text, with a hash library of its own and plain loops."""
    def chain(parts):
        h = 42
        for x in parts:
            h = xxhash.xxh64_intdigest(x, h)
        return h

    w = [x.encode() for x in WORD.findall(text)]
    if not w:
        return minhash.NO_SHINGLE
    hashes = [chain(w[i : i + 5]) for i in range(len(w) - 4)] if len(w) >= 5 else [chain([b" ".join(w)])]
    least = {}
    shift = 64 - minhash.BINS.bit_length() + 1
    signed = lambda h: h - (1 << 64) if h >> 63 else h
    for h in hashes:
        least[h >> shift] = min(least.get(h >> shift, signed(h)), signed(h))
    number = lambda b: int(b).to_bytes(4, "little")
    out = ""
    for b in range(minhash.BINS):
        donor = b if b in least else min((signed(chain([number(b), number(c)])), c) for c in least)[1]
        out += f"{least[donor] & 255:02x}"
    return out


def test_fingerprint_bits(spark):
    texts = [prose(n, n) for n in (0, 1, 4, 5, 6, 40, 300, 3000)] + ["é 😀 x", "a a a a a a a", None]
    got = minhash.edited_fingerprints(table(spark, [(i, t, "a") for i, t in enumerate(texts)])).collect()
    assert all(r["fingerprint"] == brute_fingerprint(texts[r["doc_id"]] or "") for r in got)


def test_fingerprints_of_string_ids_and_repeated_rows(spark):
    rows = [(f"d{i:03}", prose(30, i)) for i in range(50)] + [("d007", prose(30, 7))] * 5 + [(None, prose(30, 99))] * 2
    order = sorted(rows, key=lambda r: (r[0] is not None, r[0] or ""), reverse=True)
    for per_range in (3, 1000):
        got = minhash.edited_fingerprints(spark.createDataFrame(rows, "doc_id string, text string"), per_range).collect()
        want = []
        for (i, t), (j, u) in zip(order, [*order[1:], order[0]]):
            half = len(t) // 2
            want.append((str(i), str(j), hashlib.sha256((t[: len(t) - half] + u[:half]).encode()).hexdigest()))
        assert sorted((str(r["doc_id"]), str(r["next_id"]), r["edited_sha256"]) for r in got) == sorted(want)


def test_fingerprints(spark):
    rows = [(i, prose(400, i) if i % 3 else prose(200, 0) + " " + prose(200, i), "a") for i in range(40)] + [(50, None, "a"), (51, "", "a"), (52, "😀é", "a"), (53, "a b c", "a"), (54, prose(20_000, 1, 9000), "a"), (None, prose(300, 77), "a"), (None, "b", "a"), (7, prose(400, 7), "a")]
    for per_range in (5, 10_000):
        got = minhash.edited_fingerprints(table(spark, rows), per_range).collect()
        assert len(got) == len(rows)
        known = sorted({i for i, _, _ in rows if i is not None and i != 7}, reverse=True)
        text = {i: t or "" for i, t, _ in rows}
        by_id = {r["doc_id"]: r for r in got if r["doc_id"] is not None}
        wrong = []
        for a, b in zip(known, known[1:]):
            if a == 8 or b == 8:
                continue
            x, y, r = text[a], text[b], by_id[a]
            half = len(x) // 2
            edited = x[: len(x) - half] + y[:half]
            assert r["n_chars"] == len(x) and r["edited_sha256"] == hashlib.sha256(edited.encode()).hexdigest()
            for other, near in ((edited, r["near_edited"]), (y, r["near_next"])):
                p, q = shingles(x), shingles(other)
                want = len(p & q) / len(p | q) if p | q else 1.0
                wrong.append(abs(near - want))
                assert abs(near - want) < 0.2
        assert np.mean(wrong) < 0.03
        assert len({r["fingerprint"] for r in got if r["doc_id"] == 7}) == 1 and len(by_id[54]["fingerprint"]) == 2 * minhash.BINS
        assert by_id[50]["fingerprint"] == by_id[51]["fingerprint"] == minhash.NO_SHINGLE
    one = minhash.edited_fingerprints(table(spark, [(1, "a b c d e f g h", "a")])).first()
    assert one["near_next"] == 1.0 and one["edited_sha256"] == hashlib.sha256(b"a b c d a b c d"[:8] + b"a b c d").hexdigest()
    assert minhash.edited_fingerprints(table(spark, [])).count() == 0
