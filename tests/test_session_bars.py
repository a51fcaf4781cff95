import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from sessionloom.plans import relations
from sessionloom.sources import store
from sessionloom.streaming import arrivals
from tests.helpers import day

TICKS = "symbol string, ts timestamp, price double, quantity long, tick_id long"
KINDS = {0: "regular", 1: "closed", 2: "muhurat", 3: "regular", 45: "special"}


def at(i, hour, minute=0):
    return datetime(2020, 1, 1) + timedelta(days=i, hours=hour, minutes=minute)


def ticks():
    rng = random.Random(3)
    rows = [(s, at(d, rng.randrange(24), rng.randrange(60)), rng.randrange(1, 400) / 4, rng.randrange(1, 9)) for d in KINDS for s in "ABC" for _ in range(40)]
    rows += [("A", at(0, 9), 7.0, 1), ("A", at(0, 9), 8.0, 1), ("A", at(0, 16), 9999.0, 1), ("A", at(2, 21, 29), 2000.0, 1), (None, at(0, 10), 5.0, 2), ("A", None, 1.0, 1), ("A", at(3, 10), None, 1)]
    return [(*r, i) for i, r in enumerate(rows)]


def expected(rows, now):
    """Bars in plain Python."""
    out = {}
    for s, ts, price, quantity, i in sorted((r for r in rows if r[1]), key=lambda r: (r[1], r[4])):
        d = (ts.date() - day(0)).days
        kind, minute = KINDS.get(d, "closed"), ts.hour * 60 + ts.minute
        final = 1290 if kind in ("muhurat", "special") else 960
        if kind == "closed" or minute >= final or now < at(d, 0, final):
            continue
        out.setdefault((s, d), []).append((price, quantity))
    prices = {k: [p for p, _ in v if p is not None] for k, v in out.items()}
    return sorted(((k[0], k[1], v[0][0], max(prices[k]), min(prices[k]), v[-1][0], sum(q for _, q in v)) for k, v in out.items()), key=str)


@pytest.fixture(scope="module")
def calendar(spark):
    return spark.createDataFrame([(day(i), KINDS.get(i, "closed") != "closed", KINDS.get(i, "closed")) for i in range(60)], "session_date date, expected_open boolean, session_kind string")


def bars(spark, root, calendar, now):
    rows = arrivals.completed_bars(spark, root, calendar, F.lit(now).cast("timestamp")).collect()
    return sorted(((r["symbol"], (r["session_date"] - day(0)).days, r["open"], r["high"], r["low"], r["close"], r["volume"]) for r in rows), key=str)


@pytest.mark.parametrize("order", ["by time", "by time, backwards", "at random"])
def test_bars_dont_depend_on_the_order_of_files(spark, calendar, tmp_path, order):
    """Late files, early files, nulls and ticks outside of sessions; a batch that comes again adds nothing."""
    rows = ticks()
    if order == "at random":
        random.Random(4).shuffle(rows)
    else:
        rows.sort(key=lambda r: r[1] or datetime(2030, 1, 1), reverse=order != "by time")
    path, root = tmp_path / "in", str(tmp_path / "out")
    path.mkdir()
    share = -(-len(rows) // 4)
    stream = lambda: arrivals.add_ticks(arrivals.arrivals(spark, str(path), TICKS, 1), root, calendar, str(tmp_path / "offsets")).awaitTermination()
    for k in range(4):
        spark.createDataFrame(rows[k * share : (k + 1) * share], TICKS).coalesce(1).write.mode("append").parquet(str(path))
        stream()
    for now in (at(0, 15, 59), at(0, 16), at(2, 21, 29), at(2, 21, 30), at(90, 0)):
        want = expected(rows, now)
        assert bars(spark, root, calendar, now) == want
    assert len(want) > 12
    # every tick is at the root, once, and a batch that comes again changes nothing
    total = lambda: store.published(spark, root).agg(F.sum("ticks")).first()[0]
    assert total() == len(rows)
    (own,) = store.state(spark, root).commits
    arrivals.add_ticks_batch(spark.createDataFrame(rows[:9], TICKS), root, calendar, own, 3)
    assert total() == len(rows)


def test_nothing_arrived(spark, calendar, tmp_path):
    assert arrivals.completed_bars(spark, str(tmp_path / "none"), calendar, F.lit(at(9, 0))).collect() == []


def test_ticks_of_a_large_table_come_in_few_files(spark, tmp_path):
    """Each batch costs the driver the same, so their number must not grow with the table: all ticks arrive, in no more files than TICK_FILES and one for each task that writes."""
    rows = spark.range(0, 2_000_000, 1, 4).selectExpr("id as event_id", "timestamp_micros(id * 1000) as ts", "'a' as event_type", "id / 2 as value")
    rows.write.parquet(str(tmp_path / "events.parquet"))
    path = relations._ticks(spark, str(tmp_path))
    ticks = spark.read.parquet(path)
    assert ticks.count() == 2_000_000
    assert len(ticks.inputFiles()) <= relations.TICK_FILES + 8
