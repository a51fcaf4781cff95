"""Performance, risk and correlation over the window in which every instrument has a price."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sessionloom.config import Analytics
from sessionloom.functions.columns import ratio
from sessionloom.operators.sessions import by_symbol, so_far

TILE, BLOCK = 64, 256  # symbols and days that meet in a task



def prices(aligned: DataFrame) -> DataFrame:
    """session_date, symbol, price: the adjusted close where it is eligible, else null."""
    return aligned.select("symbol", "session_date", F.when(F.col("feature_eligible"), F.col("adj_close")).alias("price"))


def common_window(table: DataFrame) -> DataFrame:
    """One row: first and last date on which every symbol has a price, and how many such dates there are. Fewer than two are an error."""
    n = table.agg(F.count_distinct("symbol").alias("n"))
    full = table.where("price is not null").groupBy("session_date").agg(F.count(F.lit(1)).alias("priced")).join(F.broadcast(n), F.col("priced") == F.col("n"))
    out = full.agg(F.min("session_date").alias("first_session"), F.max("session_date").alias("last_session"), F.count(F.lit(1)).alias("common_dates"))
    few = F.raise_error(F.lit("fewer than two dates on which every instrument has a price")).cast("long")
    return out.withColumn("common_dates", F.when(F.col("common_dates") < 2, few).otherwise(F.col("common_dates"))).where("common_dates > 1")


def window_prices(table: DataFrame) -> DataFrame:
    span = F.broadcast(common_window(table))
    return table.join(span, (F.col("session_date") >= F.col("first_session")) & (F.col("session_date") <= F.col("last_session"))).drop("common_dates")


def returns(table: DataFrame) -> DataFrame:
    """table with ret: the return between adjacent rows, null if either has no price."""
    return table.withColumn("ret", F.col("price") / F.lag("price").over(by_symbol()) - 1)


def drawdowns(table: DataFrame) -> DataFrame:
    return table.withColumn("drawdown", F.col("price") / F.max("price").over(so_far()) - 1)


def normalized(table: DataFrame) -> DataFrame:
    return table.withColumn("normalized", F.col("price") / F.first("price").over(so_far()) * 100)


def with_benchmark(rets: DataFrame, benchmark: str) -> DataFrame:
    """rets with the benchmark's return of the same day (bench)."""
    bench = rets.where(F.col("symbol") == benchmark).select("session_date", F.col("ret").alias("bench"))
    return rets.join(bench, "session_date", "left")


def metrics(table: DataFrame, config: Analytics = Analytics()) -> DataFrame:
    """One row per symbol. table: symbol, session_date, price over all sessions."""
    rows = with_benchmark(drawdowns(returns(window_prices(table))), config.benchmark)
    rf, year = config.daily_risk_free, float(config.year)
    excess = F.col("ret") - rf
    pair = F.col("ret").isNotNull() & F.col("bench").isNotNull()
    agg = rows.groupBy("symbol", "first_session", "last_session").agg(
        F.count("price").alias("usable_price_rows"), F.count_if(F.col("price").isNull()).alias("missing_prices"), F.count("ret").alias("daily_return_observations"),
        F.count_if(pair).alias("benchmark_pairs"),
        (F.max(F.when(F.col("session_date") == F.col("last_session"), F.col("price"))) / F.max(F.when(F.col("session_date") == F.col("first_session"), F.col("price"))) - 1).alias("endpoint_return"),
        F.stddev_samp("ret").alias("_sd"), F.avg(excess).alias("_mean"), F.stddev_samp(excess).alias("_sd_excess"), F.sqrt(F.avg(F.pow(F.least(excess, F.lit(0.0)), 2))).alias("_down"),
        F.min("drawdown").alias("max_drawdown"), F.covar_samp("ret", "bench").alias("_cov"), F.var_samp(F.when(pair, F.col("bench"))).alias("_var"),
    )
    years = F.datediff("last_session", "first_session") / 365.25
    enough = F.col("daily_return_observations") >= config.least_returns
    root = F.sqrt(F.lit(year))
    bench = F.broadcast(agg.where(F.col("symbol") == config.benchmark).select(F.col("endpoint_return").alias("_bench_return")))
    return agg.join(bench, how="left").select(
        "symbol", "first_session", "last_session", "usable_price_rows", "missing_prices", "daily_return_observations", "benchmark_pairs", "endpoint_return",
        F.when(years > 0, F.pow(1 + F.col("endpoint_return"), 1 / F.nullif(years, F.lit(0.0))) - 1).alias("endpoint_cagr"),
        F.when(enough, F.col("_sd") * root).alias("annualized_volatility"), F.when(enough, ratio(F.col("_mean") * root, F.col("_sd_excess"))).alias("sharpe"),
        F.when(enough, ratio(F.col("_mean") * root, F.col("_down"))).alias("sortino"), "max_drawdown",
        F.when(F.col("benchmark_pairs") >= config.least_returns, ratio(F.col("_cov"), F.col("_var"))).alias("beta"), (F.col("endpoint_return") - F.col("_bench_return")).alias("endpoint_excess"),
    )


def _tile_sums(part: pd.DataFrame) -> pd.DataFrame:
    """Of every symbol of one tile with every one of another, over one block of days: common days, and sums of their values, squares and products on these."""
    symbols, at = np.unique(part["symbol"].to_numpy(), return_inverse=True)
    days, on = np.unique(part["day"].to_numpy(), return_inverse=True)
    held, x = np.zeros((len(symbols), len(days))), np.zeros((len(symbols), len(days)))
    held[at, on], x[at, on] = 1.0, part["value"].to_numpy()
    tile = np.empty(len(symbols), np.int64)
    tile[at] = part["tile"].to_numpy()
    a, b = (np.flatnonzero(tile == part[c].iloc[0]) for c in ("lo", "hi"))
    i, j = np.nonzero(held[a] @ held[b].T)
    sums = {"n": held[a] @ held[b].T, "x": x[a] @ held[b].T, "y": held[a] @ x[b].T, "xx": x[a] ** 2 @ held[b].T, "yy": held[a] @ (x[b] ** 2).T, "xy": x[a] @ x[b].T}
    out = pd.DataFrame({"symbol": symbols[a][i], "other": symbols[b][j], **{k: v[i, j] for k, v in sums.items()}})
    out = out.astype({"n": "int64"})
    # each two symbols once, in order
    swapped = out["symbol"] > out["other"]
    turned = out[swapped].rename(columns={"symbol": "other", "other": "symbol", "x": "y", "y": "x", "xx": "yy", "yy": "xx"})[out.columns]
    return out[~swapped] if part["lo"].iloc[0] == part["hi"].iloc[0] else pd.concat([out[~swapped], turned])


def pair_sums(rows: DataFrame, tile: int = TILE, block: int = BLOCK) -> DataFrame:
    """symbol, other (symbol <= other), n common days, and sums x, y, xx, yy, xy over them. rows: symbol, session_date, value (not null), one row per symbol and day.

    Symbols are dealt into tiles of about `tile`, days into blocks: a task multiplies two tiles over one block, so no row per day and pair is made, and what is shuffled is a row per
    symbol, day and tile, and then a row per pair and block.
    """
    tiles = max(1, -(-rows.select("symbol").distinct().count() // tile))
    own = F.pmod(F.xxhash64("symbol"), F.lit(tiles)).cast("int")
    day = F.datediff("session_date", F.lit("1970-01-01").cast("date"))
    rows = rows.select("symbol", day.alias("day"), "value", own.alias("tile"), F.explode(F.sequence(F.lit(0), F.lit(tiles - 1))).alias("_other"))
    rows = rows.select("symbol", "day", "value", "tile", F.least("tile", "_other").alias("lo"), F.greatest("tile", "_other").alias("hi"), F.floor(F.col("day") / block).alias("block"))
    parts = rows.groupBy("lo", "hi", "block").applyInPandas(_tile_sums, "symbol string, other string, n long, x double, y double, xx double, yy double, xy double")
    return parts.groupBy("symbol", "other").agg(*[F.sum(c).alias(c) for c in ("n", "x", "y", "xx", "yy", "xy")])


def both_ways(pairs: DataFrame) -> DataFrame:
    """pairs (symbol <= other) and the same with the names exchanged."""
    rest = [c for c in pairs.columns if c not in ("symbol", "other")]
    return pairs.unionByName(pairs.where("symbol < other").select(F.col("other").alias("symbol"), F.col("symbol").alias("other"), *rest))


def pair_statistics(rets: DataFrame, least: int = 30, tile: int = TILE, block: int = BLOCK) -> DataFrame:
    """Pairs and correlation of every two symbols over days on which both have a return, from sums by tiles (pair_sums) of returns less their symbol's mean."""
    r = rets.where("ret is not null").select("symbol", "session_date", "ret")
    centred = r.join(r.groupBy("symbol").agg(F.avg("ret").alias("_mean")), "symbol").select("symbol", "session_date", (F.col("ret") - F.col("_mean")).alias("value"))
    sums = pair_sums(centred, tile, block)
    vx, vy = (F.col(c * 2) - F.col(c) * F.col(c) / F.col("n") for c in "xy")
    spread = F.sqrt(F.greatest(vx, F.lit(0.0))) * F.sqrt(F.greatest(vy, F.lit(0.0)))
    # a spread that is rounding only is none
    varied = (vx > 1e-14 * F.col("xx")) & (vy > 1e-14 * F.col("yy"))
    out = sums.select("symbol", "other", F.col("n").alias("pairs"), F.when((F.col("n") >= least) & varied, (F.col("xy") - F.col("x") * F.col("y") / F.col("n")) / F.nullif(spread, F.lit(0.0))).alias("correlation"))
    return both_ways(out)


def sector_summary(table: DataFrame, sectors: DataFrame, benchmark: str) -> DataFrame:
    return table.where(F.col("symbol") != benchmark).join(sectors, "symbol").groupBy("sector").agg(
        F.count(F.lit(1)).alias("instruments"), F.avg("endpoint_return").alias("mean_return"), F.avg("annualized_volatility").alias("mean_volatility"), F.avg("beta").alias("mean_beta")
    )


def rolling(rets: DataFrame, config: Analytics = Analytics()) -> DataFrame:
    """Rolling volatility and beta over full windows of returns."""
    n = config.rolling
    frame = by_symbol().rowsBetween(1 - n, 0)
    rows = with_benchmark(rets, config.benchmark)
    bench = F.when(F.col("ret").isNotNull(), F.col("bench"))
    full, paired = F.count("ret").over(frame) == n, F.count(bench).over(frame) == n
    variance = F.var_samp(bench).over(frame)
    return rows.withColumns({
        "rolling_volatility": F.when(full, F.stddev_samp("ret").over(frame) * F.sqrt(F.lit(float(config.year)))),
        "rolling_beta": F.when(paired & (variance > 0), F.covar_samp("ret", bench).over(frame) / F.nullif(variance, F.lit(0.0))),
    })


def metric_violations(rets: DataFrame, stats: DataFrame, table: DataFrame, benchmark: str) -> DataFrame:
    """One row of counts that must be zero: returns other than those of adjacent prices, asymmetric correlations, correlations out of range, a benchmark beta other than 1.

    rets: symbol, session_date, price, ret. stats: as pair_statistics. table: as metrics.
    """
    again = F.col("price") / F.lag("price").over(by_symbol()) - 1
    off = rets.withColumn("_again", again).agg(F.count_if(~F.col("ret").eqNullSafe(F.col("_again")) & F.coalesce(F.abs(F.col("ret") - F.col("_again")) > 1e-9, F.lit(True))).alias("wrong_returns"))
    mirror = stats.select(F.col("symbol").alias("other"), F.col("other").alias("symbol"), F.col("correlation").alias("mirrored"))
    sym = stats.join(mirror, ["symbol", "other"]).agg(F.count_if(F.abs(F.col("correlation") - F.col("mirrored")) > 1e-9).alias("asymmetric"), F.count_if(F.abs("correlation") > 1 + 1e-9).alias("out_of_range"))
    beta = table.agg(F.count_if((F.col("symbol") == benchmark) & (F.abs(F.col("beta") - 1) > 1e-9)).alias("bad_benchmark_beta"))
    return off.join(sym).join(beta)
