from datetime import date, datetime

import pytest
from pyspark.errors import SparkRuntimeException
from pyspark.sql import functions as F

from sessionloom.config import Models
from sessionloom.functions.columns import order_key
from sessionloom.operators import labels as L
from sessionloom.operators import sessions as S
from tests.helpers import by_day, day, panel


@pytest.fixture(scope="module")
def calendar(spark):
    span = spark.createDataFrame([(date(2020, 1, 1), date(2020, 2, 1))], "start date, end date")
    d = lambda *rows: spark.createDataFrame([(x, "u") for x in rows] or [], "session_date date, url string")
    annual = spark.createDataFrame([(2020, date(2020, 1, 19), "circular")], "year int, muhurat_date date, source string")
    closed = spark.createDataFrame([(date(2020, 1, 1),)], "session_date date")
    return S.make_calendar(S.days(span), annual, closed, d(date(2020, 1, 4), date(2020, 1, 11)), d(date(2020, 1, 11), date(2020, 1, 15)), "v1").cache()


def test_calendar_exceptions(calendar):
    kind = {r["session_date"]: (r["expected_open"], r["session_kind"]) for r in calendar.collect()}
    assert len(kind) == 31
    assert kind[date(2020, 1, 1)] == (False, "closed") and kind[date(2020, 1, 2)] == (True, "regular") and kind[date(2020, 1, 5)] == (False, "closed")
    assert kind[date(2020, 1, 4)] == (True, "special") and kind[date(2020, 1, 19)] == (True, "muhurat")
    assert kind[date(2020, 1, 11)] == (False, "closed"), "closed wins over open" 
    assert kind[date(2020, 1, 15)] == (False, "closed")


@pytest.mark.parametrize(("now", "want"), [
    (datetime(2020, 1, 3, 15, 59), date(2020, 1, 2)), (datetime(2020, 1, 3, 16, 0), date(2020, 1, 3)), (datetime(2020, 1, 5, 18, 0), date(2020, 1, 4)),
    (datetime(2020, 1, 19, 18, 15), date(2020, 1, 17)), (datetime(2020, 1, 19, 21, 30), date(2020, 1, 19)),
])
def test_expected_session(spark, calendar, now, want):
    moments = spark.createDataFrame([(now,)], "now timestamp_ntz")
    assert S.expected_session(calendar, moments).first()["expected_session"] == want


def test_alignment_and_masks(spark):
    rows = by_day(panel(spark, [1, 2, 3, 4, 5, 6, 7, 8, 9], gaps={2}))
    assert rows[2]["gap"] and rows[2]["close"] is None and not rows[1]["target_1d_eligible"] and not rows[0]["target_5d_eligible"]
    assert not rows[8]["target_1d_eligible"] and rows[3]["target_5d_eligible"] and not rows[4]["target_5d_eligible"]
    assert rows[1]["segment_id"] != rows[3]["segment_id"] and rows[2]["segment_id"] == rows[3]["segment_id"]


def test_labels(spark):
    closes = [100, 100, 110, 120, 130, 140, 150, 160, 170, 180, 190, 200]
    rows = by_day(L.labels(panel(spark, closes)))
    assert rows[0]["direction_1d"] == 0 and rows[0]["future_return_5d"] == pytest.approx(0.4)
    assert all(rows[i]["future_return_5d"] is None for i in range(7, 12))
    rows = by_day(L.labels(panel(spark, closes, gaps={3})))
    assert all(rows[i]["future_return_5d"] is None for i in range(4)) and rows[2]["future_return_1d"] is None
    assert rows[4]["future_return_1d"] == pytest.approx(140 / 130 - 1) and rows[2]["target_date_1d"] == day(3)


def test_purge(spark):
    rows = L.labels(panel(spark, [100, 100, 110, 120, 130, 140, 150, 160, 170, 180, 190, 200])).withColumn("core_ready", F.lit(True))
    fold = spark.createDataFrame([(0, day(7), day(10))], "fold int, start date, end date")
    marks = L.marked(rows, fold).collect()
    train = [r for r in marks if r["train_future_return_1d"]]
    test = [r for r in marks if r["test_future_return_1d"]]
    assert len(train) == 2 and all(r["target_date_5d"] < day(7) for r in train)
    assert test and all(r["target_date_1d"] < day(10) for r in test) and not {r["session_date"] for r in train} & {r["session_date"] for r in test}


def test_folds(spark):
    dates = spark.createDataFrame([(date(2015, 1, 1),), (date(2026, 9, 9),)], "session_date date")
    rows = sorted((r["fold"], r["start"], r["end"]) for r in L.folds(dates, Models()).collect())
    assert rows[0][:2] == (-1, date(2025, 9, 9)) and rows[1][1] == date(2018, 1, 1) and rows[-1][2] == date(2025, 9, 9)
    assert all(a[2] == b[1] for a, b in zip(rows[1:], rows[2:]))


def test_imputation_uses_training_only(spark):
    rows = spark.createDataFrame([(0, 1.0, True), (0, 3.0, True), (0, None, True), (0, 99.0, False), (0, None, False)], "fold int, x double, train_t boolean")
    out = L.imputed(rows, L.fold_medians(rows, ["x"], "t"), ["x"]).collect()
    assert sorted(r["x"] for r in out) == [1, 2, 2, 3, 99] and sum(r["missing_x"] for r in out) == 2


def test_order_key(spark):
    """Sorts like the columns, keeps nulls, and refuses what its digits can't hold."""
    rows = spark.createDataFrame([(5, 2, 7), (5, 2, 6), (-4, 99, 0), (-5, 0, 3), (5, 10, 0), (None, 1, 1), (9_000_000_000_000_000_000, 0, 1)], "a long, b int, c long")
    out = rows.withColumn("k", order_key(a=19, b=2, c=17)).collect()
    assert [r["k"] for r in out if r["a"] is None] == [None]
    known = [r for r in out if r["a"] is not None]
    assert sorted(known, key=lambda r: r["k"]) == sorted(known, key=lambda r: (r["a"], r["b"], r["c"]))
    assert [int(r["k"]) for r in rows.withColumn("k", order_key(b=2, c=3)).limit(2).collect()] == [2007, 2006]
    for digits in ({"a": 2, "b": 2}, {"b": 1, "c": 1}, {"b": 2, "a": 19}):
        with pytest.raises(SparkRuntimeException):
            rows.select(order_key(**digits)).collect()
    with pytest.raises(ValueError, match="38"):
        order_key(a=19, b=19, c=1)
