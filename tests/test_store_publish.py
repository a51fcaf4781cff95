import hashlib
import random
import shutil
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from sessionloom.operators import publish as P
from sessionloom.sources import files, store
from sessionloom.streaming import arrivals
from tests.helpers import day


def test_window_replacement_and_idempotence(spark):
    old = spark.createDataFrame([("A", day(i), "old") for i in range(6)] + [("B", day(2), "old")], "symbol string, session_date date, v string")
    new = spark.createDataFrame([("A", day(2), "new"), ("A", day(3), "new")], "symbol string, session_date date, v string")
    out = store.replace_window(old, new, ["symbol"], "session_date", F.lit(day(2)), F.lit(day(5)))
    assert sorted((r["symbol"], (r["session_date"] - day(0)).days, r["v"]) for r in out.collect()) == [("A", 0, "old"), ("A", 1, "old"), ("A", 2, "new"), ("A", 3, "new"), ("A", 5, "old"), ("B", 2, "old")]
    assert store.insert_absent(old, new, ["symbol", "session_date"]).count() == 7
    tagged = old.withColumn("dataset_id", F.lit("d"))
    assert store.load_once(tagged, tagged).count() == 0


def test_runs(spark):
    m = spark.createDataFrame([("r1", "A", "success", date(2020, 1, 1)), ("r1", "B", "success", date(2020, 1, 1)), ("r2", "A", "success", date(2020, 1, 2)), ("r2", "B", "failed", date(2020, 1, 2)), ("r3", "A", "success", date(2020, 1, 3))], "run_id string, symbol string, status string, finished_at date")
    assert store.latest_complete_run(m, spark.createDataFrame([("A",), ("B",)], "symbol string")).first()["run_id"] == "r1"


def test_failed_publication_keeps_the_old_one(spark, tmp_path):
    root = str(tmp_path / "p")
    store.publish(spark.range(3), root)
    bad = spark.range(3).select(F.raise_error(F.lit("no")).alias("id"))
    try:
        store.publish(bad, root)
    except Exception:
        pass
    assert store.published(spark, root).count() == 3


def test_no_pointer_is_not_an_empty_store(spark, tmp_path, monkeypatch):
    """Killed before the log's row: the version before stays, and the next attempt goes on. A lost log is an error."""
    root = str(tmp_path / "p")
    kept = store._append

    def killed(spark, root, rows):
        if rows[0][0] >= 0:
            raise KeyboardInterrupt
        kept(spark, root, rows)

    for before in (None, 5):
        monkeypatch.setattr(store, "_append", killed)
        try:
            store.publish(spark.range(9), root)
        except KeyboardInterrupt:
            pass
        monkeypatch.setattr(store, "_append", kept)
        if before is None:
            assert store.published_state(spark, root) == (-1, {})
        else:
            assert store.published(spark, root).count() == before
        store.publish(spark.range(5), root)
        assert store.published(spark, root).count() == 5
    shutil.rmtree(f"{root}/_log")
    with pytest.raises(RuntimeError, match="its log is gone"):
        store.published(spark, root)
    with pytest.raises(RuntimeError, match="its log is gone"):
        store.publish(spark.range(1), root)


def test_revisions_survive_a_replay_and_a_crash(spark, tmp_path, monkeypatch):
    schema = "symbol string, session_date date, v string"
    path, root = tmp_path / "in", str(tmp_path / "out")
    path.mkdir()

    def arrive(rows):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(str(path))

    def run(offsets):
        arrivals.revise(arrivals.arrivals(spark, str(path), schema, 1), root, str(tmp_path / offsets), ["symbol"]).awaitTermination()

    def now():
        return sorted((r["symbol"], (r["session_date"] - day(0)).days, r["v"]) for r in store.published(spark, root).collect())

    arrive([("A", day(i), "old") for i in range(0, 100, 10)] + [("B", day(45), "old")])
    run("offsets")
    first = now()
    assert len(first) == 11
    # the same batch again, as after a lost commit, changes nothing
    before = store.published_state(spark, root)
    (own,) = store.state(spark, root).commits
    arrivals.revise_batch(spark.createDataFrame([("A", day(0), "twice")], schema), root, ["symbol"], own, 0)
    assert store.published_state(spark, root) == before and now() == first
    arrive([("A", day(40), "new"), ("A", day(50), "new")])
    kept = store._append
    monkeypatch.setattr(store, "_append", lambda *a: (_ for _ in ()).throw(ValueError("killed")))
    with pytest.raises(Exception, match="killed"):
        run("offsets")
    monkeypatch.setattr(store, "_append", kept)
    assert now() == first
    run("offsets")
    want = sorted([x for x in first if x[:2] not in (("A", 40), ("A", 50))] + [("A", 40, "new"), ("A", 50, "new")])
    assert now() == want
    # months that the second batch didn't touch are the same folders as before
    assert set(before[1].values()) & set(store.published_state(spark, root)[1].values())


def test_streams_have_batches_of_their_own(spark, tmp_path):
    """Two checkpoints, a whole table published between them, and rows without a date: none is lost."""
    schema, root = "symbol string, session_date date, v string", str(tmp_path / "out")

    def run(name, rows):
        path = tmp_path / f"in-{name}"
        path.mkdir(exist_ok=True)
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(str(path))
        arrivals.revise(arrivals.arrivals(spark, str(path), schema, 1), root, str(tmp_path / name), ["symbol"]).awaitTermination()

    def now():
        return [(r["symbol"], r["session_date"] and (r["session_date"] - day(0)).days, r["v"]) for r in store.published(spark, root).collect()]

    run("a", [("A", day(1), "a0"), ("A", day(40), "a0"), ("N", None, "a0"), ("M", None, "a0")])
    assert len(now()) == 4
    run("b", [("B", day(1), "b0"), ("N", None, "b0")])
    assert sorted(now(), key=str) == sorted([("A", 1, "a0"), ("A", 40, "a0"), ("B", 1, "b0"), ("M", None, "a0"), ("N", None, "b0")], key=str)
    run("a", [("A", day(40), "a1")])
    run("b", [("O", None, "b1")])
    have = [("A", 1, "a0"), ("A", 40, "a1"), ("B", 1, "b0"), ("M", None, "a0"), ("N", None, "b0"), ("O", None, "b1")]
    assert sorted(now(), key=str) == sorted(have, key=str)
    assert sorted(store.state(spark, root).commits.values()) == [1, 1]
    # a whole table counts as a version of its own, and both streams go on
    store.publish(store.published(spark, root).where("symbol <> 'M'").select("symbol", "session_date", "v"), root)
    run("a", [("C", day(2), "a2")])
    assert sorted(now(), key=str) == sorted([x for x in have if x[0] != "M"] + [("C", 2, "a2")], key=str)
    run("a", [])
    assert len(now()) == 6


def test_log_is_compacted(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(store, "EPOCH", 2)
    root = str(tmp_path / "p")
    for n in range(7):
        store.publish(spark.range(n + 1), root)
        assert store.published(spark, root).count() == n + 1
    assert store.state(spark, root).number == 6
    held = {p.name: spark.read.parquet(str(p)).count() for p in (tmp_path / "p/_log").iterdir() if p.is_dir()}
    assert held == {"epoch=0": 0, "epoch=1": 0, "epoch=2": 2, "epoch=3": 1}


@pytest.mark.parametrize("ranges", [1, 5, 4096])
def test_reconciliation_by_ranges(spark, ranges):
    """Counts are those of a full comparison, whatever the ranges; of equal tables no row is joined."""
    rng = random.Random(ranges)
    left = {(s, i): (rng.random(), rng.choice([None, 1.0])) for s in "ab" for i in range(200)}
    right = {k: v for k, v in left.items() if rng.random() < 0.95} | {("c", i): (0.5, None) for i in range(7)}
    for k in rng.sample(sorted(right), 30):
        right[k] = (right[k][0] + rng.choice([1e-9, 0.1]), right[k][1])
    for k in rng.sample(sorted(right), 10):
        right[k] = (right[k][0], None if right[k][1] else 1.0)
    a, b = (spark.createDataFrame([(*k, *v) for k, v in t.items()], "s string, i int, x double, y double") for t in (left, right))
    both = left.keys() & right.keys()
    differ = {k for k in both if abs(left[k][0] - right[k][0]) > 1e-6 or (left[k][1] is None) != (right[k][1] is None)}
    assert tuple(store.reconcile(a, b, ["s", "i"], {"x": 1e-6, "y": 1e-6}, ranges).first()) == (len(left.keys() - right.keys()), len(right.keys() - left.keys()), len(differ), len(both) - len(differ))
    same = store.reconcile(a, a.repartition(3), ["s", "i"], {"x": 0.0}, ranges)
    assert tuple(same.first()) == (0, 0, 0, len(left))
    assert tuple(store.reconcile(a.limit(0), a, ["s", "i"], {"x": 0.0}, ranges).first()) == (0, len(left), 0, 0)


def test_files_are_held_against_their_manifest(spark, tmp_path):
    path = str(tmp_path / "files")
    df = spark.createDataFrame([("A", 1.0), ("B", 2.0)], "symbol string, close double")
    manifest = files.write_with_manifest(df.repartition("symbol"), path, "symbol")
    assert files.verified(manifest, path).count() == 2
    one = next((tmp_path / "files").rglob("*.parquet"))
    one.write_bytes(one.read_bytes())
    assert files.verified(manifest, path).count() == 2
    spark.createDataFrame([("A", 3.0)], "symbol string, close double").coalesce(1).write.mode("append").partitionBy("symbol").parquet(path)
    with pytest.raises(ValueError, match="'unknown': 1"):
        files.verified(manifest, path)


def test_an_older_dataset_is_refused(spark):
    rows = spark.createDataFrame([("d1", 1), ("d2", 2)], "dataset_id string, x int")
    active = spark.createDataFrame([("d2",)], "dataset_id string")
    assert store.load_once(rows, rows.where("dataset_id = 'd2'"), active).count() == 0
    assert store.load_once(rows, rows.limit(0).union(spark.createDataFrame([("d3", 3)], rows.schema)), active).count() == 1
    with pytest.raises(Exception, match="older dataset"):
        store.load_once(rows, rows.where("dataset_id = 'd1'"), active).collect()


def test_run_log(spark):
    t = lambda h: datetime(2020, 1, 1, h)
    steps = spark.createDataFrame([("a", 1, "load", t(1), t(2), True), ("a", 2, "fit", t(3), t(4), True), ("b", 1, "load", t(1), t(2), True), ("b", 2, "fit", t(2), None, True), ("b", 3, "out", t(5), t(6), True), ("c", 1, "load", t(1), t(2), None)], "run_id string, step int, stage string, started_at timestamp_ntz, finished_at timestamp_ntz, ok boolean")
    got = {r["run_id"]: tuple(r)[1:] for r in P.run_log(steps).collect()}
    assert got == {"a": ("success", "load,fit", None, t(1), t(4)), "b": ("failed", "load,fit", "fit", t(1), t(2)), "c": ("failed", "load", "load", t(1), t(2))}


def test_mixed_datasets_are_not_coherent(spark):
    ids = {k: spark.createDataFrame([(k,)], "dataset_id string") for k in ("x", "y")}
    none = ids["x"].limit(0)
    assert [P.coherent(ids["x"], *o).first()["coherent"] for o in ((ids["x"], ids["x"]), (ids["x"], ids["y"]), (none,), (ids["x"].union(ids["y"]),))] == [True, False, False, False]


def test_append_only_and_fingerprints(spark, tmp_path):
    path = str(tmp_path / "a")
    bars = spark.createDataFrame([("A", 1.0)], "symbol string, close double")
    files.append_run(bars, path, "r1")
    before = {r["file"]: r["sha256"] for r in files.file_fingerprints(spark, path).collect()}
    files.append_run(bars, path, "r2")
    after = {r["file"]: r["sha256"] for r in files.file_fingerprints(spark, path).collect()}
    assert before.items() <= after.items() and files.read_run(spark, path, "close double", "r1").count() == 1


@pytest.mark.parametrize("piece", [1, 7, 1 << 20])
def test_digests_of_files_and_manifests(spark, tmp_path, piece, monkeypatch):
    """Files in pieces, names that look escaped, a file of no bytes; both ways of reading; ids whatever the order of rows."""
    root = tmp_path / "landed files"
    want = {}
    for name, data in {"a.parquet": b"x" * 5000, "day=2020%2F01/b c.parquet": bytes(range(256)) * 9, "k=1/empty.parquet": b"", "k=1/seven.parquet": b"1234567"}.items():
        (root / name).parent.mkdir(parents=True, exist_ok=True)
        (root / name).write_bytes(data)
        want[name] = (hashlib.sha256(data).hexdigest(), len(data))
    want.pop("k=1/empty.parquet")  # Spark passes over files of no bytes
    (root / "other.txt").write_bytes(b"not listed")
    found = lambda: {r["file"]: (r["sha256"], r["length"]) for r in files.file_fingerprints(spark, str(root), piece).collect()}
    assert found() == want
    monkeypatch.setattr(files, "STREAMED", ())
    assert found() == want


def test_dataset_id(spark):
    rows = [(f"é{i % 50}", i) for i in range(30_000)]
    schema = "file string, n long"
    lines = sorted((f'{{"file":"{f}","n":{n}}}' for f, n in rows), key=str.encode)
    for some in (rows, rows[::-1]):
        got = files.dataset_id(spark.createDataFrame(some, schema), "file", "n").first()
        assert got["dataset_id"] == hashlib.sha256("\n".join(lines).encode()).hexdigest() and got["members"] == 30_000
    empty = files.dataset_id(spark.createDataFrame([], schema), "file", "n").first()
    assert empty["dataset_id"] == hashlib.sha256(b"").hexdigest() and empty["members"] == 0


def test_csv_round_trip_keeps_nulls(spark, tmp_path):
    df = spark.createDataFrame([("A", None, 1.5), ("B", True, None)], "s string, b boolean, x double")
    files.write_csv(df, str(tmp_path / "c"))
    assert sorted(map(tuple, files.read_csv(spark, str(tmp_path / "c"), "s string, b boolean, x double").collect())) == [("A", None, 1.5), ("B", True, None)]


def test_forecast_states(spark):
    rows = spark.createDataFrame([("a", day(5), day(5), "t", day(9)), ("b", day(1), day(1), "t", day(9)), ("c", day(5), day(5), "t", None), ("d", day(5), day(99), "t", day(9))], "symbol string, as_of_date date, available_at date, target string, target_date date")
    rows = rows.withColumns({"prediction": F.lit(0.5), "model": F.lit("m")})
    got = {r["symbol"]: (r["status"], r["value"]) for r in P.forecasts(rows, F.lit(day(10)), F.lit(day(6)), F.lit(day(5))).collect()}
    assert got == {"a": (P.VALID, 0.5), "b": (P.STALE, None), "c": (P.UNAVAILABLE, None), "d": (P.UNAVAILABLE, None)}


def test_first_issue_counts(spark):
    issued = spark.createDataFrame([("s2", datetime(2020, 1, 1, 5), "A", day(0), "t", day(1), 0.2, "ok", "m"), ("s1", datetime(2020, 1, 1, 4), "A", day(0), "t", day(1), 0.1, "ok", "m"), ("s3", datetime(2020, 1, 2, 1), "A", day(0), "t", day(1), 0.3, "ok", "m")], "snapshot_id string, issued_at timestamp_ntz, symbol string, as_of_date date, target string, target_date date, value double, status string, model string")
    outcomes = spark.createDataFrame([("A", day(0), "t", day(1), 1.0)], "symbol string, as_of_date date, target string, target_date date, actual double")
    out = P.first_issued(P.matched_forecasts(issued, outcomes, F.lit(datetime(2020, 1, 5)).cast("timestamp_ntz"))).collect()
    assert len(out) == 1 and out[0]["snapshot_id"] == "s1" and out[0]["state"] == "scored"
