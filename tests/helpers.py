"""Small panels for tests."""

from datetime import date, timedelta

from pyspark.sql import functions as F

from sessionloom.operators.sessions import align

DAY0 = date(2020, 1, 1)


def day(i: int) -> date:
    return DAY0 + timedelta(days=i)


def panel(spark, closes, symbol="A", kind="equity", gaps=(), volume=100, adj=None, zero_volume=()):
    """Aligned bars of one symbol on successive days; days in gaps have no bar."""
    rows = []
    for i, c in enumerate(closes):
        if i not in gaps and c is not None:
            rows.append((symbol, day(i), float(c), float(c) + 2, float(c) - 2, float(c), float(adj if adj is not None else c), 0 if i in zero_volume else volume))
    bars = spark.createDataFrame(rows, "symbol string, session_date date, open double, high double, low double, close double, adj_close double, volume long")
    calendar = spark.createDataFrame([(day(i), True) for i in range(len(closes))], "session_date date, expected_open boolean")
    return align(bars, calendar).withColumns({"kind": F.lit(kind), "observed_at": F.when(F.col("price_valid"), F.col("session_date"))})


def by_day(df, symbol="A"):
    """Rows by number of the day."""
    return {(r["session_date"] - DAY0).days: r.asDict() for r in df.where(F.col("symbol") == symbol).collect()}
