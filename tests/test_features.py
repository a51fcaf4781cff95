import math

import numpy as np
import pytest

from sessionloom.functions.recursive import ema, recurse, wilder
from sessionloom.operators.features import bound_violations, coverage, feature_names, features
from tests.helpers import by_day, panel


@pytest.fixture(scope="module")
def rising(spark):
    return by_day(features(panel(spark, [100 + i for i in range(300)])))


def test_known_values(rising):
    assert rising[4]["sma_5"] == 102 and rising[3]["sma_5"] is None
    assert rising[1]["return_1d"] == pytest.approx(0.01) and rising[0]["return_1d"] is None
    assert rising[14]["rsi_14"] == 100 and rising[13]["rsi_14"] is None
    assert rising[13]["atr_14"] == pytest.approx(4) and rising[12]["atr_14"] is None
    assert rising[251]["high_252"] == 353 and rising[250]["high_252"] is None
    assert rising[20]["relative_volume_20"] == 1 and rising[19]["relative_volume_20"] is None
    assert rising[33]["macd_signal"] is not None and rising[32]["macd_signal"] is None
    assert len(feature_names()) == 39


def test_core_ready(spark):
    rows = by_day(features(panel(spark, [100] * 100)))
    assert sum(r["core_ready"] for r in rows.values()) == 67
    assert rows[14]["rsi_14"] == 50 and rows[30]["bollinger_width"] == 0 and rows[30]["bollinger_percent_b"] is None


def test_gap_restarts_everything(spark):
    closes = [100 + (i * 7) % 13 for i in range(220)]
    rows = by_day(features(panel(spark, closes, gaps={150})))
    assert all(rows[150][n] is None for n in feature_names()) and rows[150]["segment_age"] == 0
    assert rows[151]["return_1d"] is None and rows[154]["sma_5"] is None and rows[155]["sma_5"] is not None
    fresh = by_day(features(panel(spark, closes[151:])))
    for i in (160, 190, 219):
        for n in feature_names():
            a, b = rows[i][n], fresh[i - 151][n]
            assert (a is None) == (b is None) and (a is None or a == pytest.approx(b, rel=1e-9)), n


def test_future_rows_change_nothing(spark, rising):
    other = by_day(features(panel(spark, [100 + i if i < 200 else 7 * (100 + i) for i in range(300)])))
    for i in (50, 199):
        assert all(rising[i][n] == other[i][n] or math.isclose(rising[i][n], other[i][n], rel_tol=1e-12) for n in feature_names() if rising[i][n] is not None)


def test_index_has_no_volume_and_prices_are_adjusted(spark):
    rows = by_day(features(panel(spark, [100] * 260, kind="index", adj=50)))
    assert rows[13]["atr_14"] == pytest.approx(2) and rows[251]["high_252"] == 51
    assert all(r[n] is None for r in rows.values() for n in ("volume_change_1d", "volume_sma_20", "relative_volume_20"))


def test_unusable_volume(spark):
    rows = by_day(features(panel(spark, [100] * 130, zero_volume={100})))
    assert all(rows[i]["volume_sma_20"] is None for i in range(100, 120)) and rows[120]["volume_sma_20"] == 100
    assert rows[101]["volume_change_1d"] is None


def test_recursions_against_a_loop(spark):
    x = np.random.default_rng(0).normal(size=500).tolist()
    df = spark.createDataFrame([("a", i, v) for i, v in enumerate(x)], "k string, i long, x double")
    specs = [ema("e9", "x", 9), ema("e50", "x", 50), ema("late", "x", 9, 25), wilder("w3", "x", 3), wilder("w14", "x", 14, 1)]
    got = recurse(df, ["k"], "i", "i", specs).orderBy("i").collect()

    def loop(span_decay, start, seed, shown):
        y, out = None, []
        for i, v in enumerate(x):
            if i == start:
                y = float(np.mean(x[start - seed + 1 : start + 1]))
            elif i > start:
                y = span_decay * y + (1 - span_decay) * v
            out.append(y if i >= shown else None)
        return out

    for s in specs:
        for r, want in zip(got, loop(s.decay, s.start, s.seed, s.shown)):
            assert (r[s.name] is None) == (want is None) and (want is None or r[s.name] == pytest.approx(want, abs=1e-12))


def test_coverage_and_bounds(spark):
    table = features(panel(spark, [100 + i % 5 for i in range(60)], gaps={30}))
    rows = {r["feature"]: r for r in coverage(table, ["return_1d", "sma_5"]).collect()}
    assert rows["return_1d"]["non_null"] == 57 and rows["return_1d"]["nulls"] == 3
    assert set(bound_violations(table).first().asDict().values()) == {0}
