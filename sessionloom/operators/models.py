"""The walk-forward: every model on every fold, the choice of one by its scores, its holdout and its forecasts."""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import reduce
from multiprocessing.pool import ThreadPool

import numpy as np
from pyspark import inheritable_thread_target
from pyspark.ml import Model
from pyspark.ml.classification import GBTClassifier, RandomForestClassifier
from pyspark.ml.feature import CountVectorizerModel, VectorAssembler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import GBTRegressor, RandomForestRegressor
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sessionloom.config import Models
from sessionloom.operators import evaluate as E
from sessionloom.operators import linear
from sessionloom.sources.scratch import new_path, stored

FITTED = ("linear", "random_forest", "boosted")
AT_ONCE = 8  # fits of trees at a time
TASK_ROWS = 50_000  # training rows of a task of a fit
PREDICTIONS = "fold int, symbol string, session_date date, actual double, prediction double, target string, model string"


def estimator(name: str, direction: bool, config: Models = Models()):
    """random_forest or boosted."""
    if name == "random_forest":
        kind = RandomForestClassifier if direction else RandomForestRegressor
        return kind(numTrees=config.trees, maxDepth=config.depth, minInstancesPerNode=config.least_leaf, featureSubsetStrategy="0.7", seed=config.seed)
    if name == "boosted":
        kind = GBTClassifier if direction else GBTRegressor
        return kind(maxIter=config.boost_trees, maxDepth=config.boost_depth, stepSize=config.boost_rate, seed=config.seed)
    raise ValueError(name)


@dataclass
class Walk:
    """A panel with its folds (labels.windows), written once. rows also has identity, the instrument as a sparse 0/1 vector, and latest, which rows are to forecast."""

    rows: DataFrame
    folds: list[int]
    names: list[str]
    config: Models
    sizes: dict[tuple[str, int], tuple[int, int]]
    scales: linear.Scales
    medians: dict[tuple[str, int], np.ndarray]
    missing: dict[tuple[str, int], np.ndarray]
    identity: CountVectorizerModel
    linear_fits: dict[str, linear.Fit] = field(default_factory=dict)

    def place(self, fold: int) -> int:
        return self.folds.index(fold)

    def lines(self, target: str) -> linear.Fit:
        """The linear models of a target on all folds; those of all returns are made together."""
        if target not in self.linear_fits:
            if target.startswith("direction"):
                self.linear_fits[target] = linear.logistic(self.rows, target, len(self.folds), self.scales, self.medians)
            else:
                returns = [t for t in self.config.targets if not t.startswith("direction")]
                self.linear_fits |= dict.fromkeys(returns, linear.ridge(self.rows, returns, len(self.folds), self.scales, self.medians))
        return self.linear_fits[target]


def walk(rows: DataFrame, folds: list[int], names: list[str], config: Models = Models()) -> Walk:
    """Write rows of labels.windows, and take what all fits share: sizes of folds, exact medians of their training rows, and how many values are null there.

    A column `latest` marks rows to forecast. Rows that are neither in a fold nor latest are left out.
    """
    used = reduce(lambda a, b: a | b, [F.col(f"{p}_{t}").isNotNull() for t in config.targets for p in ("since", "test")])
    rows = rows.withColumn("latest", F.col("latest") if "latest" in rows.columns else F.lit(False)).where(used | F.col("latest")).withColumn("symbol", F.col("symbol").cast("string"))
    rows = stored(rows, "windows")
    # an instrument that isn't known has no 1 in the vector
    symbols = sorted(r["symbol"] for r in rows.select("symbol").distinct().collect())
    if not symbols:
        raise ValueError("no row is in a fold")
    identity = CountVectorizerModel.from_vocabulary(symbols, inputCol="_symbols", outputCol="identity", binary=True)
    rows = stored(identified(identity, rows), "panel")
    targets, n = list(config.targets), len(folds)
    marks = [f"{p}_{t}" for p in ("since", "test") for t in targets]
    held, sizes = rows.groupBy(*marks).agg(F.count(F.lit(1)).alias("n")).collect(), {}
    for t in targets:
        train, test = (np.array([sum(r["n"] for r in held if r[f"{c}_{t}"] == p) for p in range(n)]) for c in ("since", "test"))
        sizes |= {(t, p): (int(train[: p + 1].sum()), int(test[p])) for p in range(n)}
    scales, bounds = linear.scales(rows, len(names))
    medians, values = linear.medians(rows, targets, n, bounds)
    return Walk(rows, folds, names, config, sizes, scales, medians, {k: sizes[k][0] - v for k, v in values.items()}, identity)


def identified(identity: CountVectorizerModel, rows: DataFrame) -> DataFrame:
    return identity.transform(rows.withColumn("_symbols", F.array("symbol"))).drop("_symbols")


def _adequate(walk: Walk, target: str, fold_ids: list[int]) -> None:
    """A fold with fewer than least_train training rows or without a test row is an error."""
    short = [k for k in fold_ids if k not in walk.folds or walk.sizes[target, walk.place(k)][0] < walk.config.least_train or walk.sizes[target, walk.place(k)][1] < 1]
    if short:
        raise ValueError(f"too few rows of {target} in folds {short}")


def columns(rows: DataFrame, median: np.ndarray, missing: np.ndarray) -> DataFrame:
    """rows with features: predictors with nulls as the fold's training median (0 without one), flags for those that training has nulls of, and the instrument."""
    fill = F.array(*[F.lit(float(v)) for v in np.where(np.isnan(median), 0.0, median)])
    values = F.zip_with("x", fill, lambda v, m: F.coalesce(v, m))
    flags = F.transform(F.array(*[F.lit(int(j)) for j in np.flatnonzero(missing)]).cast("array<int>"), lambda j: F.get("x", j).isNull().cast("double"))
    out = rows.withColumn("_values", array_to_vector(F.concat(values, flags)))
    return VectorAssembler(inputCols=["_values", "identity"], outputCol="features").transform(out).drop("_values")


def fit(walk: Walk, target: str, name: str, fold: int) -> Model:
    """Trees fitted on the fold's training rows, which are read from the panel by their first fold, in as many tasks as they need."""
    p = walk.place(fold)
    rows = walk.rows.where(F.col(f"since_{target}") <= p).select("x", "identity", F.col(target).alias("label"))
    rows = columns(rows, walk.medians[target, p], walk.missing[target, p]).select("label", "features")
    return estimator(name, target.startswith("direction"), walk.config).fit(rows.coalesce(-(-walk.sizes[target, p][0] // TASK_ROWS)))


def predict(walk: Walk, model: Model, rows: DataFrame, target: str, fold: int) -> DataFrame:
    """rows of the panel with prediction: the probability of 1 for a direction, else the value."""
    p = walk.place(fold)
    return chance(model.transform(columns(rows, walk.medians[target, p], walk.missing[target, p])), target)


def chance(out: DataFrame, target: str) -> DataFrame:
    """A model's output, whose prediction of a direction becomes the probability of 1."""
    if target.startswith("direction"):
        out = out.withColumn("prediction", vector_to_array("probability")[1])
    return out.drop("features", "rawPrediction", "probability")


def _tested(walk: Walk, target: str, fold_ids: list[int]) -> DataFrame:
    return walk.rows.where(F.col(f"test_{target}").isin([walk.place(k) for k in fold_ids]))


def _named(walk: Walk, rows: DataFrame, target: str, model: str) -> DataFrame:
    """Predictions in the columns of PREDICTIONS. rows: place, symbol, session_date, the target and prediction."""
    fold = F.get(F.array(*map(F.lit, walk.folds)), F.col("place")).cast("int")
    return rows.select(fold.alias("fold"), "symbol", "session_date", F.col(target).cast("double").alias("actual"), F.col("prediction").cast("double").alias("prediction"), F.lit(target).alias("target"), F.lit(model).alias("model"))


def fold_predictions(walk: Walk, target: str, names: tuple[str, ...], fold_ids: list[int]) -> DataFrame:
    """Predictions of the test rows of every fold of fold_ids by every model of names, fitted on that fold's training rows.

    Linear models of all folds are fitted together. Fits of trees are distributed, AT_ONCE of them at a time; their predictions are written, so that no plan holds many models.
    """
    _adequate(walk, target, fold_ids)
    spark, parts = walk.rows.sparkSession, []
    if "linear" in names:
        tested = _tested(walk, target, fold_ids).select("symbol", "session_date", target, "x", F.col(f"test_{target}").alias("place"))
        parts.append(stored(_named(walk, walk.lines(target).predict(tested, target, "place"), target, "linear"), "predictions"))
    path = new_path(spark, "predictions")

    def run(job: tuple[str, int]) -> str:
        name, fold = job
        rows = _tested(walk, target, [fold]).withColumn("place", F.lit(walk.place(fold)))
        _named(walk, predict(walk, fit(walk, target, name, fold), rows, target, fold), target, name).coalesce(-(-walk.sizes[target, walk.place(fold)][1] // TASK_ROWS)).write.parquet(f"{path}/{name}_{fold}")
        return f"{path}/{name}_{fold}"

    # large folds first
    jobs = [(n, k) for k in sorted(fold_ids, key=walk.place, reverse=True) for n in ("boosted", "random_forest") if n in names]
    if jobs:
        with ThreadPool(AT_ONCE) as pool:
            parts.append(spark.read.schema(PREDICTIONS).parquet(*pool.map(inheritable_thread_target(spark)(run), jobs, chunksize=1)))
    return reduce(DataFrame.unionByName, parts)


def walk_forward(walk: Walk, target: str, name: str, fold_ids: list[int] | None = None) -> DataFrame:
    """Predictions of the test rows of each fold by a model fitted on that fold's training rows."""
    return fold_predictions(walk, target, (name,), fold_ids or walk.folds)


def baseline(walk: Walk, target: str, fold_ids: list[int]) -> DataFrame:
    """Test rows with the baseline's prediction: the training share of 1 for a direction, else 0."""
    rows = _tested(walk, target, fold_ids).withColumn("place", F.col(f"test_{target}"))
    prior = F.lit(0.0)
    if target.startswith("direction"):
        prior = F.get(F.array(*[F.lit(v) for v in priors(walk, target)]), F.col("place"))
    return _named(walk, rows.withColumn("prediction", prior), target, "baseline")


def priors(walk: Walk, target: str) -> list[float]:
    """Mean of the target over each fold's training rows, by place."""
    sums = {r["p"]: r["s"] for r in walk.rows.groupBy(F.col(f"since_{target}").alias("p")).agg(F.sum(target).alias("s")).collect()}
    upto = np.cumsum([sums.get(p) or 0.0 for p in range(len(walk.folds))])
    return [float(s / max(1, walk.sizes[target, p][0])) for p, s in enumerate(upto)]


@dataclass
class Selection:
    """What the walk-forward found for a target: the scores of the validation folds, and the model chosen by them."""

    walk: Walk
    target: str
    scores: DataFrame
    winner: str


def select(walk: Walk, target: str, models: tuple[str, ...] = FITTED) -> Selection:
    """Fit every model on every validation fold; the winner is that of the lowest mean score (Brier for a direction, mean absolute error for a return)."""
    validation = [k for k in walk.folds if k >= 0]
    _adequate(walk, target, [*validation, -1])
    found = baseline(walk, target, validation).unionByName(fold_predictions(walk, target, models, validation))
    scores = stored(E.scored(found, target), "scores")
    return Selection(walk, target, scores, E.winners(scores).where(F.col("target") == target).first()["model"])


def holdout(chosen: Selection) -> DataFrame:
    """Predictions of the holdout (fold -1) by the baseline and by the winner, fitted anew on all rows before it: fold, symbol, session_date, actual, prediction, target, model."""
    last = baseline(chosen.walk, chosen.target, [-1])
    return last if chosen.winner == "baseline" else last.unionByName(fold_predictions(chosen.walk, chosen.target, (chosen.winner,), [-1]))


def forecast(chosen: Selection) -> DataFrame:
    """Predictions of the rows that are latest by the winner, fitted on all rows before the holdout: symbol, session_date, prediction, model."""
    walk, target, p = chosen.walk, chosen.target, chosen.walk.place(-1)
    latest = walk.rows.where("latest").withColumn("place", F.lit(p))
    if chosen.winner == "linear":
        made = walk.lines(target).predict(latest.select("symbol", "session_date", "x", "place"), target, "place")
    elif chosen.winner != "baseline":
        made = predict(walk, fit(walk, target, chosen.winner, -1), latest, target, -1)
    else:
        made = latest.withColumn("prediction", F.lit(priors(walk, target)[p] if target.startswith("direction") else 0.0))
    return made.select("symbol", "session_date", F.col("prediction").cast("double").alias("prediction"), F.lit(chosen.winner).alias("model"))


SCORES = ["target", "model", "split", "fold", "n_rows", "balanced_accuracy", "roc_auc", "brier", "log_loss", "mae", "rmse"]


def select_all(walk: Walk, models: tuple[str, ...] = FITTED) -> list[Selection]:
    return [select(walk, target, models) for target in walk.config.targets]


def all_scores(chosen: list[Selection], held: DataFrame) -> DataFrame:
    """Scores of the baseline and every model by target and fold; on the holdout (fold -1) only winner and baseline are scored. held: holdout of all targets.

    Columns: target, model, split, fold, n_rows, balanced_accuracy, roc_auc, brier, log_loss (null for returns), mae, rmse
    (null for a direction), winner.
    """
    out = [c.scores.unionByName(E.scored(held.where(F.col("target") == c.target), c.target)).select(*SCORES, F.lit(c.winner).alias("winner")) for c in chosen]
    return reduce(DataFrame.unionByName, out)


def select_and_score(walk: Walk, models: tuple[str, ...] = FITTED) -> DataFrame:
    chosen = select_all(walk, models)
    return all_scores(chosen, stored(reduce(DataFrame.unionByName, map(holdout, chosen)), "holdout"))
