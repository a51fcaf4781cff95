"""Scores of predictions, and the choice of a model."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sessionloom.functions.columns import is_finite
from sessionloom.operators.labels import average_ranks

TINY = 2.220446049250313e-16


def classification(predictions: DataFrame, *keys: str) -> DataFrame:
    """n_rows, balanced_accuracy, roc_auc (null with one class), brier and log_loss. predictions: keys, actual (0 or 1), prediction.

    Rows of one prediction are added up first; ranks of predictions come from ranges of them (labels.average_ranks), so no task holds a whole key.
    """
    y, p = F.col("actual"), F.col("prediction")
    clipped = F.least(F.greatest(p, F.lit(TINY)), F.lit(1 - TINY))
    # all metrics are sums over rows of one prediction and outcome
    tally = predictions.groupBy(*keys, "prediction").agg(F.count(F.lit(1)).alias("n"), F.sum(y).alias("_ones"))
    ones, zeros, n = F.col("_ones"), F.col("n") - F.col("_ones"), F.sum("n")
    over = (p >= 0.5).cast("double")
    agg = average_ranks(tally, "prediction", *keys).groupBy(*keys).agg(
        n.alias("n_rows"), F.sum(ones).alias("_pos"), F.sum(ones * over).alias("_true_pos"), F.sum(zeros * (1 - over)).alias("_true_neg"), F.sum(ones * F.col("average_rank")).alias("_sum"),
        (F.sum(ones * F.pow(p - 1, 2) + zeros * F.pow(p, 2)) / n).alias("brier"), (-F.sum(ones * F.ln(clipped) + zeros * F.ln(1 - clipped)) / n).alias("log_loss"),
    )
    agg = agg.withColumns({"_tpr": F.col("_true_pos") / F.nullif(F.col("_pos"), F.lit(0.0)), "_tnr": F.col("_true_neg") / F.nullif(F.col("n_rows") - F.col("_pos"), F.lit(0.0))})
    pos, neg = F.col("_pos"), F.col("n_rows") - F.col("_pos")
    balanced = F.coalesce((F.col("_tpr") + F.col("_tnr")) / 2, F.col("_tpr"), F.col("_tnr"))
    auc = F.when((pos > 0) & (neg > 0), (F.col("_sum") - pos * (pos + 1) / 2) / F.nullif(pos * neg, F.lit(0.0)))
    return agg.select(*keys, "n_rows", balanced.alias("balanced_accuracy"), auc.alias("roc_auc"), "brier", "log_loss")


def regression(predictions: DataFrame, *keys: str) -> DataFrame:
    miss = F.col("prediction") - F.col("actual")
    return predictions.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_rows"), F.avg(F.abs(miss)).alias("mae"), F.sqrt(F.avg(F.pow(miss, 2))).alias("rmse"))


def scored(predictions: DataFrame, target: str) -> DataFrame:
    """Metrics by model and fold with target, split and score: the Brier score of a direction, the mean absolute error of a return. predictions: model, fold, actual, prediction."""
    direction = target.startswith("direction")
    out = (classification if direction else regression)(predictions, "model", "fold")
    absent = [c for c in ("balanced_accuracy", "roc_auc", "brier", "log_loss", "mae", "rmse") if c not in out.columns]
    return out.withColumns({
        "target": F.lit(target), "split": F.when(F.col("fold") < 0, "holdout").otherwise("validation"), "score": F.col("brier" if direction else "mae"), **{c: F.lit(None).cast("double") for c in absent},
    })


def score_summary(metrics: DataFrame) -> DataFrame:
    """Means over folds by target, model and split."""
    return metrics.groupBy("target", "model", "split").agg(*[F.avg(c).alias(c) for c in ("balanced_accuracy", "roc_auc", "brier", "mae", "rmse")])


def winners(metrics: DataFrame, score: str = "score") -> DataFrame:
    """Model of the lowest mean fold score per target; each fold counts the same, ties go to the first name."""
    means = metrics.groupBy("target", "model").agg(F.avg(score).alias("mean_score"))
    return means.groupBy("target").agg(F.min(F.struct("mean_score", "model")).alias("b")).select("target", F.col("b.model").alias("model"), F.col("b.mean_score").alias("mean_score"))


def calibration(predictions: DataFrame, *keys: str) -> DataFrame:
    """Ten bins of a tenth each, the last closed; empty bins stay, with nulls."""
    bins = predictions.sparkSession.range(10).select(F.col("id").cast("int").alias("bin"))
    used = predictions.withColumn("bin", F.least(F.floor(F.col("prediction") * 10), F.lit(9)).cast("int"))
    agg = used.groupBy(*keys, "bin").agg(F.count(F.lit(1)).alias("n"), F.avg("prediction").alias("mean_probability"), F.avg("actual").alias("positive_rate"))
    grid = predictions.select(*keys).distinct().crossJoin(F.broadcast(bins)) if keys else bins
    return grid.join(agg, [*keys, "bin"], "left").select(*keys, "bin", (F.col("bin") / 10.0).alias("lower"), F.coalesce("n", F.lit(0)).alias("n_rows"), "mean_probability", "positive_rate")


def prediction_violations(predictions: DataFrame, holdout: DataFrame) -> DataFrame:
    """One row of counts that must be zero: repeated keys, predictions that aren't finite, rows before the holdout (one row: start)."""
    one = predictions.crossJoin(F.broadcast(holdout.select("start"))).groupBy("symbol", "session_date").agg(
        F.count(F.lit(1)).alias("n"), F.count_if(~is_finite(F.col("prediction"))).alias("bad"), F.count_if(F.col("session_date") < F.col("start")).alias("early")
    )
    return one.agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(name) for c, name in ((F.col("n") - 1, "repeated"), ("bad", "not_finite"), ("early", "before_holdout"))])


def forecast_scores(scored: DataFrame) -> DataFrame:
    """Scores of issued forecasts per target and target date. scored: target, target_date, prediction, actual, model."""
    y, p, up = F.col("actual"), F.col("prediction"), F.col("target") == "direction_1d"
    return scored.groupBy("target", "target_date").agg(
        F.count(F.lit(1)).alias("n"), F.array_join(F.array_sort(F.collect_set("model")), ",").alias("models"),
        F.avg(F.when(up, ((p >= 0.5).cast("double") == y).cast("double"))).alias("accuracy"), F.avg(F.when(up, F.pow(p - y, 2))).alias("brier"), F.avg(F.when(up, y)).alias("always_up_accuracy"),
        F.max(F.when(up, 0.25)).alias("half_brier"), F.avg(F.when(~up, F.abs(p - y))).alias("mae"), F.avg(F.when(~up, F.abs(y))).alias("zero_return_mae"),
    )
