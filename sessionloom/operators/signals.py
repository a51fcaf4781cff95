"""Technical votes, risk bands and anomaly flags."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from sessionloom.config import Signals


def technical_score(row: dict[str, Column] | None = None) -> Column:
    """Mean of up to three votes (-1, 0 or 1), null with fewer than two."""
    c = F.col
    votes = F.array(F.signum(c("ema_12") - c("ema_26")), F.signum(c("macd") - c("macd_signal")), F.signum(c("return_20d")))
    given = F.filter(votes, lambda v: v.isNotNull())
    return F.when(F.size(given) >= 2, F.aggregate(given, F.lit(0.0), lambda a, v: a + v) / F.size(given))


def trend(score: Column) -> Column:
    return F.when(score.isNull(), "Unavailable").when(score >= 0.5, "Bullish").when(score <= -0.5, "Bearish").otherwise("Neutral")


def risk_band(volatility: Column, config: Signals = Signals()) -> Column:
    return F.when(volatility.isNull(), "Unavailable").when(volatility >= config.high_volatility, "High Risk").when(volatility < config.low_volatility, "Low").otherwise("Moderate")


def abnormal_volume(relative: Column, config: Signals = Signals()) -> Column:
    return relative >= config.abnormal_volume


def readings(table: DataFrame, config: Signals = Signals()) -> DataFrame:
    """table with technical_score, signal, risk_band and abnormal_volume on every row."""
    out = table.withColumn("technical_score", technical_score())
    return out.withColumns({"signal": trend(F.col("technical_score")), "risk_band": risk_band(F.col("volatility_20"), config), "abnormal_volume": abnormal_volume(F.col("relative_volume_20"), config)})


def latest_ready(table: DataFrame) -> DataFrame:
    """The last core-ready row per symbol, with source_last_session and latest_input_missing. Only one row per symbol and task is shuffled."""
    last = table.groupBy("symbol").agg(F.max("session_date").alias("source_last_session"), F.max(F.when(F.col("core_ready"), F.col("session_date"))).alias("session_date"))
    return table.join(last, ["symbol", "session_date"]).withColumn("latest_input_missing", F.col("session_date") != F.col("source_last_session"))


def history(table: DataFrame, rows: int) -> DataFrame:
    """The last `rows` core-ready rows before the latest one, per symbol; they may lie before a gap."""
    w = Window.partitionBy("symbol").orderBy(F.desc("session_date"))
    return table.where("core_ready").withColumn("_nth", F.row_number().over(w)).where(f"_nth between 2 and {rows + 1}").drop("_nth")


def provenance(table: DataFrame, config: Signals = Signals()) -> DataFrame:
    return history(table, config.forest_rows).groupBy("symbol").agg(F.count(F.lit(1)).alias("training_rows"), F.max("session_date").alias("training_end"))


def return_surprise(table: DataFrame, config: Signals = Signals()) -> DataFrame:
    """symbol, return_z, statistical_anomaly of the latest core-ready row, against the returns before it in its gap-free run."""
    w = Window.partitionBy("symbol").orderBy("session_date")
    run = table.withColumn("_run", F.sum(F.when(F.col("input_valid"), 0).otherwise(1)).over(w.rowsBetween(Window.unboundedPreceding, 0)))
    past = Window.partitionBy("symbol", "_run", "input_valid").orderBy("session_date").rowsBetween(-config.z_rows, -1)
    stats = run.withColumns({"_mean": F.avg("return_1d").over(past), "_sd": F.stddev_samp("return_1d").over(past), "_n": F.count("return_1d").over(past)})
    z = F.when((F.col("_n") >= config.z_least) & (F.col("_sd") > 0), (F.col("return_1d") - F.col("_mean")) / F.nullif(F.col("_sd"), F.lit(0.0)))
    out = latest_ready(stats.withColumn("return_z", z))
    return out.select("symbol", "session_date", "return_z", (F.abs("return_z") >= config.z_threshold).alias("statistical_anomaly"))


def _path_length(n: np.ndarray) -> np.ndarray:
    """Mean depth of an unsuccessful search among n points."""
    n = np.maximum(n, 1).astype(float)
    return np.where(n > 2, 2 * (np.log(np.maximum(n - 1, 1)) + 0.5772156649015329) - 2 * (n - 1) / n, np.where(n == 2, 1.0, 0.0))


def _isolate(x: np.ndarray, points: np.ndarray, rng: np.random.Generator, sample: int) -> np.ndarray:
    """Depth at which one random tree over a sample of x isolates each of the points."""
    own = x[rng.permutation(len(x))[:sample]]
    limit = int(np.ceil(np.log2(max(2, len(own)))))
    depth = np.zeros(len(points))
    stack = [(own, np.arange(len(points)), 0)]
    while stack:
        rows, at, level = stack.pop()
        low, high = (rows.min(axis=0), rows.max(axis=0)) if len(rows) else (np.zeros(1), np.zeros(1))
        free = np.flatnonzero(high > low)
        if level == limit or len(rows) < 2 or not len(free) or not len(at):
            depth[at] = level + _path_length(np.array([len(rows)]))[0]
            continue
        f = free[rng.integers(len(free))]
        cut = rng.uniform(low[f], high[f])
        left, below = rows[:, f] < cut, points[at, f] < cut
        stack += [(rows[left], at[below], level + 1), (rows[~left], at[~below], level + 1)]
    return depth


def isolation(table: DataFrame, config: Signals = Signals()) -> DataFrame:
    """symbol, isolation_score, isolation_anomaly of the latest core-ready row by an isolation forest (Liu, Ting and Zhou, 2008).

    Trained on up to forest_rows rows before it, medians in place of nulls; a symbol's rows move once and its trees grow in one task. The score is the
    share of contamination among training scores taken off; below 0 is an anomaly. Null with too little history.
    """
    names = ["return_1d", "volatility_20", "rsi_14", "relative_volume_20"]
    past = history(table, config.forest_rows).select("symbol", "session_date", *names, F.lit(False).alias("now"))
    now = latest_ready(table).select("symbol", "session_date", *names, F.lit(True).alias("now"))
    seed, sample, trees, share = config.seed, config.forest_sample, config.forest_trees, config.contamination

    def grow(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("session_date")
        train = pdf.loc[~pdf["now"], names]
        used = [c for c in names if train[c].notna().any()]
        if not used:
            return pd.DataFrame({"symbol": [key[0]], "raw": [None], "offset": [None], "n": [len(train)]}).astype({"raw": float, "offset": float})
        x = pdf[used].astype(float).fillna(train[used].astype(float).median()).to_numpy()
        known = ~pdf["now"].to_numpy()
        depth = np.mean([_isolate(x[known], x, np.random.default_rng([seed, k, *key[0].encode()]), sample) for k in range(trees)], axis=0)
        raw = -(2.0 ** (-depth / _path_length(np.array([min(sample, max(2, len(train)))]))[0]))
        return pd.DataFrame({"symbol": [key[0]], "raw": [raw[~known].max()], "offset": [np.quantile(raw[known], share)], "n": [len(train)]})

    by = past.unionByName(now).groupBy("symbol").applyInPandas(grow, "symbol string, raw double, offset double, n long")
    score = F.when(F.col("n") >= config.forest_least, F.col("raw") - F.col("offset"))
    return by.select("symbol", score.alias("isolation_score"), (score < 0).alias("isolation_anomaly"))


def attention(band: Column, *flags: Column) -> Column:
    out = band == "High Risk"
    for flag in flags:
        out = out | F.coalesce(flag, F.lit(False))
    return out


def risk_table(table: DataFrame, config: Signals = Signals(), forest: bool = True) -> DataFrame:
    """One row per symbol with a core-ready row: readings, provenance, surprise, isolation and attention."""
    now = readings(latest_ready(table), config)
    out = now.join(provenance(table, config), "symbol", "left").join(return_surprise(table, config).drop("session_date"), "symbol", "left")
    if forest:
        out = out.join(isolation(table, config), "symbol", "left")
    else:
        out = out.withColumns({"isolation_score": F.lit(None).cast("double"), "isolation_anomaly": F.lit(None).cast("boolean")})
    return out.select(
        "symbol", "session_date", "source_last_session", "latest_input_missing", "technical_score", "signal", "risk_band", F.col("volatility_20").alias("annualized_volatility"), "rsi_14",
        F.col("relative_volume_20").alias("relative_volume"), "abnormal_volume", "isolation_score", "isolation_anomaly", F.coalesce("training_rows", F.lit(0).cast("long")).alias("training_rows"), "training_end",
        "return_z", "statistical_anomaly", attention(F.col("risk_band"), F.col("abnormal_volume"), F.col("isolation_anomaly"), F.col("statistical_anomaly")).alias("attention"),
    )
