"""Bars from trades or ticks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sessionloom.sources.scratch import stored


def bars(ticks: DataFrame, symbol: Column, session: Column, price: Column, quantity: Column, order: Column, adjustment: Column | None = None, lead: Column | None = None) -> DataFrame:
    """One row per symbol and session_date: open, high, low, close, adj_close, volume.

    Open and close are the first and last price by `order`, which is unique within a symbol and session and of a fixed width (see order_key). One
    hash aggregation with partial sums per task; only one row per task and key is shuffled.

    lead: a number of at most 18 digits that `order` begins with, null where that is null. With it ticks are read twice, as wide decimals cost more than all else: the first
    reading compares leads alone, and only ticks of a session's least and greatest lead are put in `order`.
    """
    # what several aggregates use is computed once per row
    rows = ticks.select(symbol.alias("symbol"), session.alias("session_date"), price.alias("price"), quantity.alias("quantity"), (order if lead is None else lead).alias("order"), (adjustment if adjustment is not None else F.lit(1.0)).alias("adjustment"))
    whole = [F.max("price").alias("high"), F.min("price").alias("low"), F.sum("quantity").cast("long").alias("volume")]
    ends = [F.min_by("price", "order").alias("open"), F.max_by("price", "order").alias("close"), F.max_by("adjustment", "order").alias("_adjustment")]
    if lead is None:
        out = rows.groupBy("symbol", "session_date").agg(*ends, *whole)
    else:
        sessions = stored(rows.groupBy("symbol", "session_date").agg(*whole, F.min("order").alias("_first"), F.max("order").alias("_last")), "sessions")
        bounds = sessions.select(F.col("symbol").alias("_symbol"), F.col("session_date").alias("_session"), "_first", "_last")
        near = ticks.join(bounds, symbol.eqNullSafe(F.col("_symbol")) & session.eqNullSafe(F.col("_session")) & lead.isin(F.col("_first"), F.col("_last")))
        near = near.select("_symbol", "_session", price.alias("price"), order.alias("order"), (adjustment if adjustment is not None else F.lit(1.0)).alias("adjustment"))
        found = near.groupBy("_symbol", "_session").agg(*ends)
        out = sessions.join(found, F.col("symbol").eqNullSafe(F.col("_symbol")) & F.col("session_date").eqNullSafe(F.col("_session")), "left")
    return out.select("symbol", "session_date", "open", "high", "low", "close", (F.col("close") * F.col("_adjustment")).alias("adj_close"), "volume")
