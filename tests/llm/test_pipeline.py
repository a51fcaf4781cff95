"""The pipeline stage by stage against plain Python on a small table."""

import hashlib
import random
import time

import numpy as np
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
import corpus_pipeline
from sessionloom.llm import bpe, queries, simhash, similar
from sessionloom.llm.components import components

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark):
    out, docs = [spark.read.parquet(f"{SF}/documents.parquet").cache()], None
    for name, stage in corpus_pipeline.STAGES:
        docs = corpus_pipeline.cut(stage(spark, out[-1], SF), name)
        out.append(docs)
    return [d.collect() for d in out]


def test_columns(spark, stages):
    for rows in stages[1:5]:
        assert rows[0].__fields__ == corpus_pipeline.COLUMNS


def test_quality_keeps_clean_documents(spark, stages):
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    kept = {r["doc_id"] for r in stages[1]}
    clean = [i for i, q in labels.items() if q == 1]
    assert sum(i in kept for i in clean) >= 0.97 * len(clean) and len(stages[1]) < len(stages[0])


def test_exact(stages):
    best = {}
    for r in stages[1]:
        k = r["text"].encode().lower()
        best[k] = max(best.get(k, -1), r["doc_id"])
    assert sorted(r["doc_id"] for r in stages[2]) == sorted(best.values())


def shingles(text):
    w = text.encode().lower().split()
    return {b" ".join(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def similar_components(texts, similarity=0.8):
    """For each text the first of those that pairs of that Jaccard similarity of five-word shingles connect it with."""
    sets = [shingles(t) for t in texts]
    label, again = list(range(len(texts))), True
    near = [(a, b) for a in range(len(texts)) for b in range(a) if sets[a] & sets[b] and len(sets[a] & sets[b]) >= similarity * len(sets[a] | sets[b])]
    while again:
        again = False
        for a, b in near:
            if label[a] != label[b]:
                label[a] = label[b] = min(label[a], label[b])
                again = True
    return label


def test_near(stages):
    """One document of each group of five-word similarity 0.8 or more stays, that of the smallest doc_id; on this table bands miss no pair."""
    least = {}
    for r, c in zip(stages[2], similar_components([r["text"] for r in stages[2]])):
        least[c] = min(least.get(c, r["doc_id"]), r["doc_id"])
    assert sorted(r["doc_id"] for r in stages[3]) == sorted(least.values()) and len(stages[3]) < len(stages[2])


def test_near_over_similarities(spark):
    """Copies with more and more words replaced: nearly all pairs of 0.8 or more are found, none of less. One group is large, and its keys are in shares."""
    rng, rows, want = random.Random(4), [], []
    for i in range(300):
        words = [f"w{rng.randrange(900)}" for _ in range(rng.randrange(60, 300))]
        other = words[:]
        for at in rng.sample(range(len(words)), 1 + i % 9):
            other[at] = f"n{rng.randrange(900)}"
        a, b = shingles(" ".join(words)), shingles(" ".join(other))
        want.append(len(a & b) / len(a | b))
        rows += [(2 * i, " ".join(words)), (2 * i + 1, " ".join(other).upper())]
    base = [f"z{k}" for k in range(200)]
    rows += [(1000 + k, " ".join(base[:k] + [f"own{k}"] + base[k + 1 :])) for k in range(200)]
    got = {r["doc_id"]: r["component_id"] for r in simhash.similar_groups(spark.createDataFrame(rows, "doc_id long, text string"), group=16).collect()}
    found = [got[2 * i] == got[2 * i + 1] for i in range(300)]
    assert all(w >= 0.8 for w, f in zip(want, found) if f)
    reach = [f for w, f in zip(want, found) if w >= 0.8]
    assert len(reach) > 60 and sum(reach) >= 0.98 * len(reach)
    assert {got[1000 + k] for k in range(200)} == {1000}


def test_a_key_of_many_unlike_texts(spark):
    """Signatures that share one key and little else, some of them twice with a tenth of the bytes changed: all of these meet, and no task compares all."""
    rng = np.random.default_rng(8)
    body = rng.integers(0, 256, (20_000, similar.HASHES), dtype=np.uint8)
    near = body[:500].copy()
    near[:, :24] += 1
    rows = [(7, i, bytes(b)) for i, b in enumerate([*body, *near])]
    prints = spark.createDataFrame(rows, "key long, tie long, signature binary").repartition(8)
    began = time.time()
    found = {tuple(sorted((r["u"], r["v"]))) for part in similar._compared(prints, 0.7, 1024) for r in part.collect()}
    assert found == {(i, 20_000 + i) for i in range(500)}
    assert time.time() - began < 120


def test_a_crowded_key_loses_no_link(spark):
    """Chains whose ends are unlike, and pairs that are both near a leading text but not similar to it, beside a large class of copies: at one key, whatever leads, all links are found."""
    rng, rows = random.Random(6), []
    base = [f"b{k}" for k in range(100)]
    for i in range(60):
        # of the base's shingles some 0.7, of the next one's 0.9
        own = base[:83] + [f"t{i}_{k}" for k in range(17)]
        rows += [own, own[:-2] + ["x", "y"], own[:-4] + ["x", "y", "z", "q"], own[:-6] + [f"{i}{k}" for k in range(6)]]
    rows += [base[:k] + [f"c{k}"] + base[k + 1 :] for k in range(100)]
    rng.shuffle(rows)
    texts = [" ".join(r) for r in rows]
    docs = spark.createDataFrame(list(enumerate(texts)), "tie long, text string")
    prints = similar.signatures(docs, 5).select("tie", F.array(F.lit(7).cast("long")).alias("keys"), "signature")
    want = similar_components(texts)
    for group, room in ((4096, 1 << 25), (32, 1 << 25), (4096, 8192)):
        edges = similar.links(prints, spark.createDataFrame([], "u long, v long"), docs, 5, 0.8, group, room)
        least = {r["node"]: r["root"] for r in components(edges).collect()}
        assert [least.get(i, i) for i in range(len(texts))] == want
    assert 1 < len(set(want)) < len(texts)


ODD = [(1, None, "en", "a", None), (2, "", "en", "a", 0), (3, " \n\t ", None, None, 4), (None, "no id " * 30, "en", "b", 180), (5, "five " * 40, "en", "b", 200), (5, "five " * 40, "en", "b", 200), (6, "FIVE " * 40, "en", "c", 200), (7, "long text of words that go on " * 20_000, "en", "c", 1), (8, "short", "en", None, 5)]


@pytest.mark.parametrize("rows", [ODD, []])
def test_odd_and_empty_tables(spark, tmp_path, rows):
    """Every stage on nulls, empty and very long texts, repeated rows and clashing columns, and on no rows."""
    rows = rows + [(100 + i, f"{' '.join(f'w{i * k % 97}' for k in range(80))} end", "en", "abc"[i % 3], 9) for i in range(60)] if rows else rows
    extra = ["tie", "kept", "score", "size", "taken", "text_sha256", "__kept_id", "predicted"]
    schema = "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"`{c}` string" for c in extra)
    spark.createDataFrame([(*r, *extra) for r in rows], schema).write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(100 + i, int(i % 4 > 0)) for i in range(60)] if rows else [], "doc_id long, quality int").write.parquet(str(tmp_path / "labels.parquet"))
    docs = spark.read.parquet(str(tmp_path / "documents.parquet"))
    before = len(rows)
    for name, stage in corpus_pipeline.STAGES[:3]:
        if name == "quality":
            out = stage(spark, docs, str(tmp_path))
            assert out.columns == corpus_pipeline.COLUMNS and out.count() <= before
            docs = docs.select(corpus_pipeline.COLUMNS)  # the stages below get every row, whatever the classifier says of these
            continue
        docs = corpus_pipeline.cut(stage(spark, docs, str(tmp_path)), name)
        kept = docs.collect()
        assert docs.columns == corpus_pipeline.COLUMNS and len(kept) < before or not rows
        if name == "exact_dedup":
            texts = [(t or "").encode().lower() for _, t, *_ in rows]
            assert sorted((r["text"] or "").encode().lower() for r in kept) == sorted(set(texts))
        before = len(kept)
    texts = {r["text"] for r in kept}
    docs = corpus_pipeline.cut(corpus_pipeline.mixture(spark, docs, str(tmp_path)), "mixture")
    mixed = docs.collect()
    assert docs.columns == corpus_pipeline.COLUMNS and {r["text"] for r in mixed} <= texts and (not rows or len(mixed) > 3)
    out = corpus_pipeline.tokens(spark, docs, str(tmp_path))
    assert out.count() == docs.count() and (not rows or out.where("n_tokens > 0").count() == docs.count())
    assert corpus_pipeline.run(spark, str(tmp_path)).columns == out.columns


def test_mixing(stages):
    """Whole documents, each 3 times at most; a source has its target and less than one document more."""
    texts = {r["doc_id"]: r["text"] for r in stages[3]}
    words, most, got, times = {}, {}, {}, {}
    for r in stages[3]:
        n = len(r["text"].split())
        words[r["source"]], most[r["source"]] = words.get(r["source"], 0) + n, max(n, most.get(r["source"], 0))
    for r in stages[4]:
        assert r["text"] == texts[r["doc_id"]]
        got[r["source"]] = got.get(r["source"], 0) + len(r["text"].split())
        times[r["doc_id"]] = times.get(r["doc_id"], 0) + 1
    assert all(n <= 3 for n in times.values())
    weights = {s: 1 + k % 3 for k, s in enumerate(sorted(words))}
    target, free, left, full = {}, set(words), sum(words.values()), True
    while full:
        level = left / sum(weights[s] for s in free)
        full = {s for s in free if level * weights[s] >= 3 * words[s]}
        target |= {s: 3 * words[s] for s in full} if full else {s: level * weights[s] for s in free}
        left, free = left - sum(3 * words[s] for s in full), free - full
    assert all(target[s] - 1 <= got.get(s, 0) < target[s] + most[s] for s in words)


def test_encoding(stages):
    tokenizers = pytest.importorskip("tokenizers")
    lib = tokenizers.Tokenizer.from_file(bpe.default_vocabulary())
    want = sorted((r["doc_id"], hashlib.sha256(" ".join(map(str, lib.encode(r["text"], add_special_tokens=False).ids)).encode()).hexdigest()) for r in stages[4])
    assert sorted((r["doc_id"], r["ids_sha256"]) for r in stages[5]) == want
    assert all(len(r["ids"]) == r["n_tokens"] for r in stages[5])


def test_registered():
    names = entry.queries()
    assert set(queries.QUERIES) | {"pipeline"} <= set(names) and len([n for n in names if n.startswith("op")]) == 13


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_query_equals_sql(spark, name):
    duckdb = pytest.importorskip("duckdb")
    con = duckdb.connect()
    for t in ("documents", "pages"):
        con.execute(f"create view {t} as select * from '{SF}/{t}.parquet'")
    want = con.execute(queries.ORACLES[name])
    columns = [c[0] for c in want.description]
    got = queries.QUERIES[name](spark, SF)
    assert sorted(columns) == sorted(got.columns)
    plain = lambda rows: sorted(tuple(str(round(v, 6)) if isinstance(v, float) else str(v) for v in r) for r in rows)
    assert plain(got.select(*columns).collect()) == plain(want.fetchall())
    assert got.where(F.lit(False)).count() == 0
