"""Published tables: market, history, forecasts, model scores, insights."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

VALID, STALE, UNAVAILABLE = "Research baseline only", "Skipped: stale input or non-future target date", "Skipped: calendar/availability"


def market(risk: DataFrame, latest_prices: DataFrame, instruments: DataFrame, today: Column, expected: Column) -> DataFrame:
    """Risk readings with price, return and sector, their age in days, and whether they miss the expected session."""
    out = risk.drop("latest_input_missing").join(latest_prices, ["symbol", "session_date"]).join(instruments.select("symbol", "sector"), "symbol")
    out = out.withColumns({"calendar_age_days": F.datediff(today, "session_date"), "latest_input_missing": F.col("session_date") < expected})
    return out.withColumn("data_status", F.when(F.col("latest_input_missing"), "No current risk reading").otherwise("Current indicators"))


def history(features: DataFrame, aligned: DataFrame) -> DataFrame:
    names = ["sma_20", "ema_12", "ema_26", "rsi_14", "macd", "macd_signal", "volatility_20", "return_1d"]
    return features.select("symbol", "session_date", *names).join(aligned.select("symbol", "session_date", "adj_close", "volume"), ["symbol", "session_date"]).select("symbol", "session_date", "adj_close", "volume", *names)


def forecasts(rows: DataFrame, now: Column, today: Column, expected: Column) -> DataFrame:
    """Eligibility of forecasts. rows: symbol, as_of_date, available_at, target, target_date, prediction, model.

    Valid are those available by now, from the expected session or later, for a date after today; others keep a status and no value.
    """
    stale = F.col("as_of_date") < expected
    future = F.coalesce(F.col("target_date") > today, F.lit(False))
    valid = F.coalesce(F.col("available_at") <= now, F.lit(False)) & ~stale & future
    status = F.when(valid, VALID).when(stale | F.coalesce(F.col("target_date") <= today, F.lit(False)), STALE).otherwise(UNAVAILABLE)
    return rows.select("symbol", "as_of_date", "target", "target_date", F.when(valid, F.col("prediction")).alias("value"), status.alias("status"), "model")


def model_table(summary: DataFrame, winners: DataFrame) -> DataFrame:
    chosen = F.broadcast(winners.select("target", F.col("model").alias("chosen")))
    out = summary.join(chosen, "target", "left").withColumn("selection", F.when(F.col("model") == F.col("chosen"), "Selected").otherwise("Candidate"))
    return out.drop("chosen").withColumn("evidence", F.lit("Chosen on validation folds; holdout scored for the winner and the baseline only"))


def market_counts(table: DataFrame, benchmark: str) -> DataFrame:
    """One row of counts over current equities."""
    current = table.where((F.col("symbol") != benchmark) & ~F.col("latest_input_missing"))
    return current.agg(
        F.count(F.lit(1)).alias("equities"), *[F.count_if(F.col("signal") == s).alias(s.lower()) for s in ("Bullish", "Bearish", "Neutral")],
        F.count_if(F.coalesce("abnormal_volume", F.lit(False))).alias("abnormal"), F.count_if(F.col("risk_band") == "High Risk").alias("high_risk"),
    )


def insights(counts: DataFrame, missing: DataFrame, expected: Column) -> DataFrame:
    """Four rows of text from counts (market_counts) and missing (one row: last_session, missing)."""
    both = counts.crossJoin(missing)
    texts = {
        "Market summary": F.format_string(
            "On %s %d equities have current readings (bullish %d, bearish %d, neutral %d); unusual volume in %d, high volatility in %d.",
            F.date_format(expected, "yyyy-MM-dd"), "equities", "bullish", "bearish", "neutral", "abnormal", "high_risk",
        ),
        "Data freshness": F.format_string("Bars reach %s; %d instruments have no current reading and aren't counted.", F.date_format("last_session", "yyyy-MM-dd"), "missing"),
        "Model evidence": F.lit("Scores of the validation folds choose the model, and that may be the baseline."),
        "Interpretation": F.lit("Labels say what was observed, and a flag is a reason to look, not a finding."),
    }
    return both.select(F.explode(F.array(*[F.struct(F.lit(k).alias("topic"), v.alias("insight")) for k, v in texts.items()])).alias("r")).select("r.*")


def release_violations(market_table: DataFrame, forecast_table: DataFrame, targets: int = 3) -> DataFrame:
    """One row of counts that must be zero."""
    m = market_table.groupBy("symbol").count().agg(F.coalesce(F.sum(F.col("count") - 1), F.lit(0)).alias("repeated_market_rows"), F.count(F.lit(1)).alias("_n"))
    f = forecast_table.agg(
        F.count(F.lit(1)).alias("_f"), F.count_if(F.col("status").startswith("Skipped") & F.col("value").isNotNull()).alias("skipped_with_value"),
        F.count_if((F.col("target") == "direction_1d") & ((F.col("value") < 0) | (F.col("value") > 1))).alias("bad_probability"),
    )
    return m.crossJoin(f).select("repeated_market_rows", F.abs(F.col("_f") - targets * F.col("_n")).alias("missing_forecasts"), "skipped_with_value", "bad_probability")


def matched_forecasts(issued: DataFrame, outcomes: DataFrame, now: Column) -> DataFrame:
    """Issued forecasts with their outcomes and a state: scored, excluded (no such outcome) or open.

    issued: snapshot_id, issued_at, symbol, as_of_date, target, target_date, value, status, model. Only forecasts issued before the target day, whose
    day is over at 16:00, count; of several for one key the first issued.
    """
    live = issued.where(F.col("value").isNotNull() & ~F.col("status").startswith("Skipped") & (F.col("issued_at") < F.col("target_date").cast("timestamp_ntz")))
    live = live.where(F.col("target_date").cast("timestamp_ntz") + F.expr("interval 16 hours") <= now)
    out = live.join(outcomes.withColumnRenamed("target_date", "outcome_date"), ["symbol", "as_of_date", "target"], "left")
    match = F.col("actual").isNotNull() & (F.col("outcome_date") == F.col("target_date"))
    return out.withColumn("state", F.when(F.coalesce(match, F.lit(False)), "scored").otherwise("excluded"))


def first_issued(rows: DataFrame) -> DataFrame:
    w = Window.partitionBy("symbol", "as_of_date", "target_date", "target").orderBy("issued_at", "snapshot_id")
    return rows.withColumn("_nth", F.row_number().over(w)).where("_nth = 1").drop("_nth")


def run_log(steps: DataFrame) -> DataFrame:
    """One row per run: status, its stages in order, the stage it stopped at, first start and last end.

    steps: run_id, step (sorts in the order of the run), stage, started_at, finished_at (null: it didn't end), ok. What comes after the first step that
    isn't ok or didn't end doesn't count as run.
    """
    broken = F.when(~F.coalesce("ok", F.lit(False)) | F.col("finished_at").isNull(), F.col("step"))
    first = steps.groupBy("run_id").agg(F.min(broken).alias("_broken"))
    run = steps.join(first, "run_id").where("_broken is null or step <= _broken")
    out = run.groupBy("run_id").agg(
        F.when(F.max("_broken").isNull(), "success").otherwise("failed").alias("status"),
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("step", "stage"))), lambda x: x["stage"]), ",").alias("stages"),
        F.max(F.when(F.col("step") == F.col("_broken"), F.col("stage"))).alias("stopped_at"), F.min("started_at").alias("started_at"), F.max(F.coalesce("finished_at", "started_at")).alias("finished_at"),
    )
    return out


def coherent(features_id: DataFrame, *other_ids: DataFrame) -> DataFrame:
    """One row: whether what is published beside the features was made from the same dataset. Each table: one row of dataset_id; none or another id isn't coherent."""
    out = features_id.select(F.col("dataset_id").alias("features_id"))
    checks = F.lit(True)
    for k, one in enumerate(other_ids):
        out = out.join(one.agg(F.min("dataset_id").alias(f"_least{k}"), F.max("dataset_id").alias(f"_most{k}")), how="left")
        checks = checks & F.col(f"_least{k}").eqNullSafe(F.col("features_id")) & F.col(f"_most{k}").eqNullSafe(F.col("features_id"))
    return out.select("features_id", checks.alias("coherent"))


def skip_run(pointer: DataFrame, expected: Column) -> DataFrame:
    """One row: whether what is published is current. pointer: expected_session, stale_instruments (one row or none)."""
    return pointer.agg(F.coalesce(F.bool_and((F.col("expected_session") == expected) & (F.col("stale_instruments") == 0)), F.lit(False)).alias("skip"))
