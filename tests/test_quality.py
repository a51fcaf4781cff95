from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from sessionloom.operators import quality as Q
from tests.helpers import day

T0 = datetime(2020, 1, 1)
COLUMNS = ["symbol", "kind", "source_row", "ts", "Open", "High", "Low", "Close", "Adj Close", "Volume", "Dividends", "Stock Splits"]


def check(spark, change=None, drop=(), rows=3, kind="equity"):
    data = []
    for i in range(rows):
        r = dict(zip(COLUMNS, ["A", kind, i, T0 + timedelta(days=i), 100.0, 102.0, 98.0, "100.0", 100.0, 50.0, 0.0, 0.0])) | (change or {}).get(i, {})
        data.append(tuple(r[c] for c in COLUMNS))
    raw = spark.createDataFrame(data, "symbol string, kind string, source_row long, ts timestamp_ntz, Open double, High double, Low double, Close string, `Adj Close` double, Volume double, Dividends double, `Stock Splits` double")
    raw = raw.drop(*drop).withColumns({"start": F.lit(day(0)), "end": F.lit(day(10))})
    calendar = spark.createDataFrame([(day(i), i != 9) for i in range(10)], "session_date date, expected_open boolean")
    return Q.checked(raw, calendar), calendar


@pytest.mark.parametrize(("change", "rule"), [
    ({"High": 80.0}, "invalid_ohlc_order"), ({"Open": float("inf")}, "invalid_price"), ({"Low": -1.0}, "invalid_price"), ({"Volume": 1.5}, "invalid_volume"), ({"Volume": -2.0}, "invalid_volume"),
    ({"Close": None}, "invalid_price"), ({"Close": "n/a"}, "invalid_numeric"), ({"Adj Close": -1.0}, "invalid_adjusted_close"), ({"Adj Close": float("inf")}, "invalid_adjusted_close"), ({"ts": None}, "invalid_date"),
    ({"ts": T0 + timedelta(days=1, hours=9)}, "non_daily_timestamp"), ({"ts": T0 + timedelta(days=40)}, "date_out_of_range"), ({"Dividends": -1.0}, "invalid_corporate_action"), ({"ts": T0 + timedelta(days=9)}, "verified_closed_session"),
    ({"Volume": float("inf")}, "invalid_volume"), ({"Volume": 2.0**63}, "invalid_volume"),
])
def test_one_bad_row(spark, change, rule):
    rows, _ = check(spark, {1: change})
    assert Q.clean(rows).count() == 2
    bad = Q.quarantine(rows).collect()
    assert len(bad) == 1 and rule in bad[0]["reasons"].split(",")


@pytest.mark.parametrize(("change", "rule"), [({"Volume": 0.0}, "zero_volume"), ({"Adj Close": None}, "missing_adjusted_close"), ({"Volume": None}, "missing_volume"), ({"Dividends": 1.0}, "corporate_action")])
def test_warnings_keep_the_row(spark, change, rule):
    rows, _ = check(spark, {1: change})
    assert Q.clean(rows).count() == 3
    assert [r["rule"] for r in Q.row_issues(rows).collect()] == [rule]


def test_copies_are_all_condemned(spark):
    rows, calendar = check(spark, {1: {"ts": T0}})
    assert {r["reasons"] for r in Q.quarantine(rows).collect()} == {"duplicate_date"} and Q.quarantine(rows).count() == 2 and Q.clean(rows).count() == 1
    log = Q.issue_log(rows, calendar)
    state = {(r["session_date"] - day(0)).days: r["rule"] for r in log.where("rule like '%_session'").collect()}
    assert state[0] == "unusable_session" and state[1] == "missing_session" and 2 not in state


def test_missing_column_condemns_every_row(spark):
    rows, _ = check(spark, drop=["Volume"])
    assert Q.clean(rows).count() == 0 and Q.quarantine(rows).count() == 3


def test_index_volume_is_not_judged(spark):
    rows, _ = check(spark, {1: {"Volume": None}, 2: {"Volume": 0.0}}, kind="index")
    assert Q.row_issues(rows).count() == 0


def test_series_warnings(spark):
    change = {20: {"Volume": 5000.0}, 25: {"Adj Close": 150.0}}
    data, _ = check(spark, {k: v for k, v in change.items()}, rows=30)
    good = Q.checked(data.select(*[c for c in data.columns if c not in ("issues", "bad", "missing", "session_date", "expected_open") and not c.startswith("raw_")]).withColumn("end", F.lit(day(100))), spark.createDataFrame([(day(i), True) for i in range(100)], "session_date date, expected_open boolean"))
    found = {(r["rule"], (r["session_date"] - day(0)).days) for r in Q.series_issues(Q.clean(good)).collect()}
    assert found == {("volume_spike", 20), ("large_observed_return", 25), ("large_observed_return", 26)}


def test_unsorted_and_unexpected(spark):
    rows, _ = check(spark, {0: {"source_row": 9}})
    assert Q.order_issues(rows).count() == 1
    assert Q.column_issues(spark.createDataFrame([("A", 1)], "symbol string, Odd int"), ["symbol"]).first()["detail"] == "Odd"
