"""The 39 causal features of a gap-free run of sessions."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window, WindowSpec

from sessionloom.config import Features
from sessionloom.functions.columns import divide, finite, over_full, spread
from sessionloom.functions.recursive import BLOCK, Recursion, ema, recurse, terms, wilder
from sessionloom.operators.sessions import available_at

KEYS = ["symbol", "segment_id"]


def in_run(keys: list[str] = KEYS) -> WindowSpec:
    """Rows of a gap-free run, or of a part of it that keys name, in order."""
    return Window.partitionBy(*keys).orderBy("session_date")


def feature_names(config: Features = Features()) -> list[str]:
    names = [f"return_{n}d" for n in config.returns] + ["log_return_1d"]
    names += [f"{p}_{n}" for n in config.sma for p in ("sma", "distance_sma")] + [f"ema_{n}" for n in config.ema]
    names += [f"rsi_{config.rsi}", "macd", "macd_signal", "macd_histogram", "bollinger_middle", "bollinger_upper", "bollinger_lower", "bollinger_width", "bollinger_percent_b"]
    names += [f"atr_{config.atr}", "atr_fraction", "momentum_10", "roc_10"] + [f"volatility_{n}" for n in config.volatility]
    return [*names, "high_252", "low_252", "distance_high_252", "distance_low_252", "volume_change_1d", "volume_sma_20", "relative_volume_20"]


def adjusted(rows: DataFrame) -> DataFrame:
    """rows with adjusted close, high and low (c, h, l) and usable share volume (v; index volume is none)."""
    factor = F.col("adj_close") / F.col("close")
    share = F.col("volume_feature_eligible") & (F.coalesce("kind", F.lit("equity")) != "index")
    return rows.withColumns({"c": F.col("adj_close"), "h": F.col("high") * factor, "l": F.col("low") * factor, "v": F.when(share, F.col("volume").cast("double"))})


def _averages(config: Features) -> list[Recursion]:
    """Recursive averages of columns of the run itself."""
    fast, slow, _ = config.macd
    out = [ema(f"ema_{n}", "c", n) for n in dict.fromkeys((*config.ema, fast, slow))]
    return [*out, wilder("_up", "_gain", config.rsi, 1), wilder("_down", "_loss", config.rsi, 1), wilder(f"atr_{config.atr}", "_range", config.atr)]


def _signal(config: Features) -> Recursion:
    _, slow, signal = config.macd
    return ema("macd_signal", "macd", signal, slow - 1)


def history(config: Features = Features()) -> int:
    """So many rows of a run before a row, in whole blocks, decide its features: what is before them has no trace in a double."""
    frames = max(config.extremes, config.bollinger, config.volume, config.momentum, *config.sma, *config.returns, *config.volatility) + 1
    blocks = 1 + max(terms(s.decay) for s in _averages(config)) + terms(_signal(config).decay)
    return BLOCK * max(blocks, -(-frames // BLOCK))


def _simple(config: Features, run: WindowSpec) -> dict[str, Column]:
    """Features that lags and sliding frames express."""
    c, h, low, v = (F.col(x) for x in "chlv")
    out = {f"return_{n}d": c / F.lag(c, n).over(run) - 1 for n in config.returns}
    for n in config.sma:
        out[f"sma_{n}"] = over_full(F.avg, c, run, 1 - n, 0)
        out[f"distance_sma_{n}"] = divide(c, out[f"sma_{n}"]) - 1
    n = config.bollinger
    middle, spread = over_full(F.avg, c, run, 1 - n, 0), config.bollinger_width * over_full(F.stddev_pop, c, run, 1 - n, 0)
    out |= {"bollinger_middle": middle, "bollinger_upper": middle + spread, "bollinger_lower": middle - spread}
    back = F.lag(c, config.momentum).over(run)
    out |= {"momentum_10": c - back, "roc_10": c / back - 1}
    high, lowest = over_full(F.max, h, run, 1 - config.extremes, 0), over_full(F.min, low, run, 1 - config.extremes, 0)
    out |= {"high_252": high, "low_252": lowest, "distance_high_252": divide(c, high) - 1, "distance_low_252": divide(c, lowest) - 1}
    out |= {"volume_change_1d": divide(v, F.lag(v, 1).over(run)) - 1, "volume_sma_20": over_full(F.avg, v, run, 1 - config.volume, 0)}
    out["relative_volume_20"] = divide(v, over_full(F.avg, v, run, -config.volume, -1))
    return out


def run_features(rows: DataFrame, config: Features = Features(), part: str | None = None) -> DataFrame:
    """Features of eligible rows. Every window and recursion starts anew in each (symbol, segment_id).

    part: a column that cuts runs into parts, which are worked on apart. Its rows tell their place in the run (_pos, from 0) and whether they come out (_own): before
    those that do, a part has the run's `history` of rows that don't.
    """
    c, keys = F.col("c"), [*KEYS, part] if part else KEYS
    run = in_run(keys)
    out = adjusted(spread(rows, *keys)).withColumn("_before", F.lag("c", 1).over(run))
    if not part:
        out = out.withColumns({"_pos": F.row_number().over(run) - 1, "_own": F.lit(True)})
    change = c - F.col("_before")
    out = out.withColumns({
        "log_return_1d": F.ln(c / F.col("_before")), "_gain": F.greatest(change, F.lit(0.0)), "_loss": F.greatest(-change, F.lit(0.0)),
        "_range": F.greatest(F.col("h") - F.col("l"), F.abs(F.col("h") - F.col("_before")), F.abs(F.col("l") - F.col("_before"))),
    })
    # greatest() skips nulls, and the first row of a run has no change
    out = out.withColumns({x: F.when(F.col("_before").isNotNull(), F.col(x)) for x in ("_gain", "_loss")})
    fast, slow, _ = config.macd
    out = recurse(out, keys, "session_date", "_pos", _averages(config)).withColumn("macd", F.col(f"ema_{fast}") - F.col(f"ema_{slow}"))
    out = recurse(out, keys, "session_date", "_pos", [_signal(config)])
    up, down = F.col("_up"), F.col("_down")
    more = _simple(config, run)
    more[f"rsi_{config.rsi}"] = F.when((down == 0) & (up > 0), 100.0).when((down == 0) & (up == 0), 50.0).otherwise(100 - 100 / (1 + divide(up, down)))
    more |= {"macd_histogram": F.col("macd") - F.col("macd_signal"), "atr_fraction": divide(F.col(f"atr_{config.atr}"), c)}
    for n in config.volatility:
        more[f"volatility_{n}"] = over_full(F.stddev_samp, F.col("log_return_1d"), run, 1 - n, 0) * F.sqrt(F.lit(float(config.year)))
    out = out.withColumns(more)
    upper, lower = F.col("bollinger_upper"), F.col("bollinger_lower")
    out = out.withColumns({"bollinger_width": divide(upper - lower, F.col("bollinger_middle")), "bollinger_percent_b": divide(c - lower, upper - lower)})
    return out.where("_own").select("symbol", "session_date", (F.col("_pos") + 1).cast("long").alias("segment_age"), *[finite(F.col(x)).alias(x) for x in feature_names(config)])


def features(aligned: DataFrame, config: Features = Features()) -> DataFrame:
    """The feature table: every aligned row, with nulls on gaps.

    aligned needs kind (index or equity) and observed_at. Returns symbol, session_date, segment_age, input_valid, core_ready,
    available_at, feature_version and the features.
    """
    timed = aligned.withColumn("available_at", available_at(F.col("observed_at"), F.col("feature_eligible")))
    return feature_table(timed, run_features(timed.where("feature_eligible"), config), config)


def feature_table(timed: DataFrame, made: DataFrame, config: Features = Features()) -> DataFrame:
    """The rows of timed (feature_eligible, available_at) with what run_features made of the eligible ones."""
    out = timed.select("symbol", "session_date", F.col("feature_eligible").alias("input_valid"), "available_at").join(made, ["symbol", "session_date"], "left")
    core = reduce(lambda a, b: a & b, [F.col(x).isNotNull() for x in config.core])
    return out.select(
        "symbol", "session_date", F.coalesce("segment_age", F.lit(0).cast("long")).alias("segment_age"), "input_valid",
        (F.col("input_valid") & core).alias("core_ready"), "available_at", F.lit(config.version).alias("feature_version"), *feature_names(config),
    )


METADATA = ["symbol", "session_date", "segment_age", "input_valid", "core_ready", "available_at", "feature_version"]


def split_columns(table: DataFrame, config: Features = Features()) -> tuple[DataFrame, DataFrame]:
    """(keys and predictors, metadata). A column that is neither, or a predictor that is absent, is an error: nothing else may reach a model."""
    names = feature_names(config)
    other = set(table.columns) ^ {*names, *METADATA}
    if other:
        raise ValueError(f"neither predictor nor metadata, or absent: {sorted(other)}")
    return table.select("symbol", "session_date", *names), table.select(*METADATA)


def coverage(table: DataFrame, names: list[str]) -> DataFrame:
    """Non-null and null values per symbol and feature."""
    wide = table.groupBy("symbol").agg(F.count(F.lit(1)).alias("_rows"), *[F.count(n).alias(n) for n in names])
    return wide.unpivot(["symbol", "_rows"], names, "feature", "non_null").select("symbol", "feature", "non_null", (F.col("_rows") - F.col("non_null")).alias("nulls"))


def build_summary(table: DataFrame) -> DataFrame:
    return table.groupBy("symbol").agg(
        F.count(F.lit(1)).alias("n_rows"), F.count_if("input_valid").alias("n_valid"), F.count_if("core_ready").alias("n_core_ready"),
        F.max(F.when(F.col("core_ready"), F.col("session_date"))).alias("latest_core_session"),
    )


def bound_violations(table: DataFrame) -> DataFrame:
    """One row of counts that must be zero: RSI out of [0, 100], negative ATR, features on gaps, repeated sessions."""
    some = reduce(lambda a, b: a | b, [F.col(x).isNotNull() for x in feature_names()])
    one = table.groupBy("symbol", "session_date").agg(
        F.count(F.lit(1)).alias("n"), F.count_if((F.col("rsi_14") < 0) | (F.col("rsi_14") > 100)).alias("r"), F.count_if(F.col("atr_14") < 0).alias("a"), F.count_if(~F.col("input_valid") & some).alias("g"),
    )
    return one.agg(F.sum("r").alias("bad_rsi"), F.sum("a").alias("bad_atr"), F.sum("g").alias("filled_gaps"), F.sum(F.col("n") - 1).alias("repeated"))
