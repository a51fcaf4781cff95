import numpy as np
import pytest
from pyspark.sql import functions as F

from sessionloom.config import Analytics
from sessionloom.operators import analytics as A
from sessionloom.operators import evaluate as E
from sessionloom.operators import signals as G
from sessionloom.operators.features import features
from sessionloom.operators.labels import average_ranks
from tests.helpers import day, panel

CONFIG = Analytics(benchmark="B", least_returns=3, rolling=3)


def prices(spark, **series):
    rows = [(s, day(i), None if p is None else float(p)) for s, ps in series.items() for i, p in enumerate(ps)]
    return spark.createDataFrame(rows, "symbol string, session_date date, price double")


def test_beta_and_correlation_of_doubled_returns(spark):
    r = [0.01, -0.02, 0.03, 0.01, -0.01, 0.02]
    table = prices(spark, B=100 * np.cumprod([1, *[1 + x for x in r]]), A=100 * np.cumprod([1, *[1 + 2 * x for x in r]]))
    m = {x["symbol"]: x for x in A.metrics(table, CONFIG).collect()}
    assert m["A"]["beta"] == pytest.approx(2) and m["B"]["beta"] == pytest.approx(1) and m["A"]["benchmark_pairs"] == 6
    pair = A.pair_statistics(A.returns(A.window_prices(table)), 3).where("symbol = 'A' and other = 'B'").first()
    assert pair["correlation"] == pytest.approx(1) and pair["pairs"] == 6


def test_gap_is_not_bridged(spark):
    table = prices(spark, B=[100, 101, 102, 103, 104, 105], A=[100, 101, None, 100, 101, 102])
    rets = {(x["session_date"] - day(0)).days: x["ret"] for x in A.returns(table).where("symbol = 'A'").collect()}
    assert rets[2] is None and rets[3] is None and rets[4] == pytest.approx(0.01)
    assert {x["symbol"]: x for x in A.metrics(table, CONFIG).collect()}["A"]["endpoint_return"] == pytest.approx(0.02)


def test_drawdown_and_constant_benchmark(spark):
    m = {x["symbol"]: x for x in A.metrics(prices(spark, B=[50, 50, 50, 50], A=[100, 120, 90, 100]), CONFIG).collect()}
    assert m["A"]["max_drawdown"] == pytest.approx(-0.25) and m["B"]["sharpe"] is None and m["A"]["beta"] is None
    assert A.pair_statistics(A.returns(prices(spark, B=[50, 50, 50, 50], A=[100, 120, 90, 100])), 3).where("symbol = 'A' and other = 'B'").first()["correlation"] is None


def test_votes(spark):
    row = spark.createDataFrame([(110.0, 100.0, 2.0, 1.0, 0.1, 0.4, None), (100.0, 110.0, 1.0, 2.0, -0.1, 0.1, 3.0), (None, 1.0, None, 1.0, 0.1, None, 1.0)], "ema_12 double, ema_26 double, macd double, macd_signal double, return_20d double, volatility_20 double, relative_volume_20 double")
    got = [(r["signal"], r["risk_band"], r["abnormal_volume"]) for r in G.readings(row).collect()]
    assert got == [("Bullish", "High Risk", None), ("Bearish", "Low", True), ("Unavailable", "Unavailable", False)]


def test_surprise_and_isolation(spark):
    rng = np.random.default_rng(3)
    closes = 100 * np.cumprod(1 + rng.normal(0, 0.01, 220))
    closes[219] = closes[218] * 1.3
    table = features(panel(spark, closes)).cache()
    out = G.risk_table(table).first()
    assert out["training_rows"] == 219 - 33 and out["training_end"] == day(218) and out["statistical_anomaly"] and out["isolation_anomaly"] and out["attention"]
    short = features(panel(spark, closes, gaps={185}))
    assert G.return_surprise(short).where("return_z is not null").count() == 0


def test_scores(spark):
    rows = spark.createDataFrame([(1.0, 0.9), (0.0, 0.2), (1.0, 0.4), (0.0, 0.4)], "actual double, prediction double").withColumn("k", F.lit("x"))
    got = E.classification(rows, "k").first()
    assert got["roc_auc"] == pytest.approx(0.875) and got["balanced_accuracy"] == pytest.approx(0.75)
    assert E.classification(rows.where("actual = 1"), "k").first()["roc_auc"] is None
    bins = {r["bin"]: r for r in E.calibration(rows).collect()}
    assert len(bins) == 10 and bins[4]["n_rows"] == 2 and bins[0]["mean_probability"] is None
    tied = spark.createDataFrame([("t", "b", 1.0), ("t", "a", 1.0)], "target string, model string, score double")
    assert E.winners(tied).first()["model"] == "a"


@pytest.mark.parametrize("ranges", [1, 4, 64])
def test_average_ranks(spark, ranges):
    """Ranks over ranges are those of the whole key, ties over the edges of ranges included."""
    rng = np.random.default_rng(2)
    rows = [(k, float(v)) for k in "ab" for v in np.round(rng.normal(0, 1, 300), 1 if k == "a" else 6)] + [("c", 1.0)] * 5 + [("d", -2.5)]
    tally = spark.createDataFrame(rows, "k string, v double").groupBy("k", "v").agg(F.count(F.lit(1)).alias("n"))
    got = {(r["k"], r["v"]): r["average_rank"] for r in average_ranks(tally, "v", "k", ranges=ranges).collect()}
    assert len(got) == len(set(rows))
    for k, v in got:
        own = [x for key, x in rows if key == k]
        assert got[k, v] == sum(x < v for x in own) + (sum(x == v for x in own) + 1) / 2


@pytest.mark.parametrize(("tile", "block"), [(64, 256), (2, 7)])
def test_tiled_correlation(spark, tile, block):
    """Sums by tiles and blocks of days give the correlations of common days; repeated values have none."""
    rng = np.random.default_rng(4)
    x = rng.normal(5, 1, (7, 90)) + rng.normal(0, 1, 90)
    x[rng.random(x.shape) < 0.3] = np.nan
    x[6] = 3.25
    rows = [(f"s{k}", day(i), None if np.isnan(v) else float(v)) for k, r in enumerate(x) for i, v in enumerate(r)]
    got = {(r["symbol"], r["other"]): (r["pairs"], r["correlation"]) for r in A.pair_statistics(spark.createDataFrame(rows, "symbol string, session_date date, ret double"), 30, tile, block).collect()}
    assert len(got) == 49
    for (a, b), (n, c) in got.items():
        u, v = x[int(a[1])], x[int(b[1])]
        both = ~np.isnan(u) & ~np.isnan(v)
        assert n == both.sum()
        assert c is None if n < 30 or "s6" in (a, b) else c == pytest.approx(np.corrcoef(u[both], v[both])[0, 1], abs=1e-12)
