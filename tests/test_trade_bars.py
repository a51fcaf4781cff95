"""Bars of the driver's trades, whose order takes five columns."""

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from sessionloom.functions.columns import order_key
from sessionloom.operators import bars as B
from sessionloom.plans import fixtures as X
from sessionloom.plans import research

KIND = "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_extendedprice double, l_discount double, l_returnflag string, l_linestatus string, l_shipdate timestamp"


@pytest.fixture
def trades(spark, tmp_path):
    """Many rows of one order and line, null keys, and sessions without a row in order."""
    rng, rows = random.Random(3), []
    for _ in range(3000):
        keys = [rng.randrange(3), rng.randrange(4), rng.randrange(3), rng.randrange(2)]
        if rng.random() < 0.05:
            keys[rng.randrange(4)] = None
        rows.append((*keys, float(rng.randrange(1, 9)), rng.choice([None, 1.25, 7.5, 20.0, 99.0]), rng.randrange(9) / 100, rng.choice(["A", "R", None]), "F", rng.choice([None, *[datetime(2000, 1, 1) + timedelta(days=i) for i in range(40)]])))
    rows.append((None, 1, 1, 1, 2.0, 8.0, 0.0, "N", "F", datetime(2000, 3, 1)))
    spark.createDataFrame(rows, KIND).write.parquet(str(tmp_path / "lineitem.parquet"))
    return str(tmp_path)


def test_leads_find_the_same_ends(spark, trades):
    c = F.col
    rows = X.table(spark, trades, "lineitem").withColumn("l_cents", F.round(c("l_extendedprice") * 100))
    want = B.bars(rows, F.concat("l_returnflag", "l_linestatus"), c("l_shipdate").cast("date"), c("l_extendedprice") / c("l_quantity"), c("l_quantity"), order_key(**X.ORDER), 1 - c("l_discount"))
    # rows of equal keys and cents may differ in quantity and discount: which of them comes first is open
    got = X.trade_bars(spark, trades)
    fixed = ["symbol", "session_date", "high", "low", "volume"]
    assert got.select(fixed).exceptAll(want.select(fixed)).isEmpty() and got.count() == want.count() > 80
    tied = rows.groupBy(F.concat("l_returnflag", "l_linestatus").alias("symbol"), c("l_shipdate").cast("date").alias("session_date"), *X.ORDER).count().where("count > 1").select("symbol", "session_date").distinct()
    sure = lambda df: df.join(tied, df["symbol"].eqNullSafe(tied["symbol"]) & df["session_date"].eqNullSafe(tied["session_date"]), "left_anti")
    assert sure(got).exceptAll(sure(want)).isEmpty() and sure(got).where("open <> close").count() > 20
    assert got.where("symbol = 'NF' and open is null and high = 4 and volume = 2").count() == 1


def test_wide_keys_only_at_the_ends(spark, trades):
    """Only a session's first and last rows are put in the wide order: a part's number beyond it, which that refuses, does no harm between them."""
    day, row = datetime(2001, 1, 1), (2.0, 8.0, 0.0, "R", "F")
    rows = [(k, 10**12 if k == 2 else 1, 1, 1, *row[:1], 8.0 * k, *row[2:], day) for k in (1, 2, 3)]
    spark.createDataFrame(rows, KIND).write.mode("overwrite").parquet(f"{trades}/lineitem.parquet")
    assert [(r["open"], r["high"], r["low"], r["close"], r["volume"]) for r in X.trade_bars(spark, trades).collect()] == [(4.0, 12.0, 4.0, 12.0, 6)]


def test_folds_by_two_dates(spark, trades):
    dates = X.table(spark, trades, "lineitem").select(F.col("l_shipdate").cast("date").alias("session_date"))
    assert sorted(r[0] for r in X.trade_dates(spark, trades).collect()) == list(dates.agg(F.min("session_date"), F.max("session_date")).first())
    assert research._folds(spark, trades).collect() == research.L.folds(dates).collect()
