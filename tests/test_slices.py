import math
import random

import pytest
from pyspark.sql import functions as F

from sessionloom.operators.features import features, history
from sessionloom.operators.slices import running, segments, sliced_features
from tests.helpers import panel


@pytest.fixture(scope="module")
def long(spark):
    """A run of 1,700 sessions, which is longer than features remember, between shorter ones; and a series that begins and ends with gaps."""
    rng = random.Random(8)
    price, closes = 100.0, []
    for _ in range(2300):
        price *= math.exp(rng.gauss(0, 0.02))
        closes.append(price)
    a = panel(spark, closes, gaps={0, 1, 90, 91, 400, 2101, 2299}, zero_volume={500, 1000})
    b = panel(spark, closes[:300], symbol="B", kind="index", gaps={0, 299})
    late = F.expr("date_add(session_date, pmod(hash(session_date), 9))")  # observations aren't in order
    return a.unionByName(b).withColumn("observed_at", F.when(F.col("price_valid"), late))


@pytest.fixture(scope="module")
def whole(long):
    return {(r["symbol"], r["session_date"]): r.asDict() for r in features(long).collect()}


@pytest.mark.parametrize("rows", [64, 512, 1 << 16])
def test_slices_give_the_values_of_whole_runs(long, whole, rows):
    assert history() < 1700
    got = {(r["symbol"], r["session_date"]): r.asDict() for r in sliced_features(long, F.year("session_date"), rows=rows).collect()}
    assert got.keys() == whole.keys() and len(got) == 2600
    for key, row in whole.items():
        for n, want in row.items():
            have = got[key][n]
            assert have == want or isinstance(want, float) and have == pytest.approx(want, rel=1e-11, abs=1e-11), (key, n)
    assert sum(r["segment_age"] >= 1700 for r in got.values()) == 1 and sum(r["core_ready"] for r in got.values()) > 1700


def test_slices_are_whole_blocks(long):
    for rows in (0, -64, 100):
        with pytest.raises(ValueError, match="multiple of 64"):
            sliced_features(long, F.year("session_date"), rows=rows)


def test_no_task_has_a_whole_series(long):
    """Of 1,700 rows of a run, a slice of 64 has its own and the history."""
    eligible = long.where("feature_eligible and symbol = 'A'")
    ranked = running(eligible, ["symbol", "segment_id"], "session_date", F.year("session_date"), {"_pos": F.lit(1)})
    assert ranked.agg(F.max("_pos")).first()[0] == 1700
    sizes = ranked.groupBy("segment_id", F.year("session_date")).count().agg(F.max("count")).first()[0]
    assert sizes <= 366


@pytest.mark.parametrize("bucket", ["year(session_date)", "0", "unix_date(session_date)"])
def test_running_values(spark, bucket):
    rng = random.Random(2)
    rows = [(k, i, rng.choice([None, rng.randrange(50)])) for k in "xyz" for i in range(80 if k != "z" else 1)]
    table = spark.createDataFrame(rows, "k string, i int, v int").withColumn("session_date", F.expr("date_add(date'2019-11-20', i)"))
    out = running(table, ["k"], "session_date", F.expr(bucket), {"total": F.col("v"), "n": F.lit(1)}, {"top": F.col("v")}).collect()
    assert len(out) == len(rows)
    for r in out:
        before = [v for k, i, v in rows if k == r["k"] and i <= r["i"]]
        known = [v for v in before if v is not None]
        assert (r["total"], r["n"], r["top"]) == (sum(known), len(before), max(known, default=None))


def test_segments_and_empty_panels(spark, long):
    want = {(r["symbol"], r["session_date"]): r["segment_id"] for r in long.collect()}
    assert {(r["symbol"], r["session_date"]): r["segment_id"] for r in segments(long, F.year("session_date")).collect()} == want
    assert sliced_features(long.limit(0), F.year("session_date")).collect() == []
