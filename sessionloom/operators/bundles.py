"""Selected models as published bundles: fitted once, checked before use, and asked for predictions without another fit."""

from __future__ import annotations

import uuid
from dataclasses import dataclass

import numpy as np
from pyspark.ml.classification import GBTClassificationModel, RandomForestClassificationModel
from pyspark.ml.feature import CountVectorizerModel
from pyspark.ml.regression import GBTRegressionModel, RandomForestRegressionModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sessionloom.operators import linear
from sessionloom.operators import models as M
from sessionloom.sources import store

BUNDLE = (
    "target string, model string, predictors array<string>, dataset_id string, holdout_start date, score double, prior double, medians array<double>, missing array<long>, "
    "centre array<double>, scale array<double>, coefficients array<double>, folder string"
)
TREES = {("random_forest", True): RandomForestClassificationModel, ("random_forest", False): RandomForestRegressionModel, ("boosted", True): GBTClassificationModel, ("boosted", False): GBTRegressionModel}


def content_id(rows: DataFrame) -> str:
    """An id of what a table holds, whatever the order of its rows: SHA-256 over its schema, number of rows, and sum and xor of two hashes of each."""
    one, two = F.xxhash64(*rows.columns), F.xxhash64(F.lit("again"), *rows.columns)
    sums = rows.agg(F.count(F.lit(1)), F.sum(one.cast("decimal(38,0)")), F.bit_xor(one), F.sum(two.cast("decimal(38,0)")), F.bit_xor(two)).first()
    return rows.sparkSession.sql("select sha2(:text, 256)", {"text": f"{rows.schema.simpleString()}|{'|'.join(map(str, sums))}"}).first()[0]


def publish(chosen: list[M.Selection], root: str, dataset_id: str, holdout_start) -> None:
    """Fit the winner of each target on all rows before the holdout and publish them as the next version: model folders first, the log's row last."""
    spark, rows = chosen[0].walk.rows.sparkSession, []
    for c in chosen:
        walk, target, p = c.walk, c.target, c.walk.place(-1)
        folder, direction = f"{root}/models/{uuid.uuid4().hex}", target.startswith("direction")
        coefficients = None
        if c.winner == "linear":
            fit = walk.lines(target)
            coefficients = fit.coefficients[target, p].tolist()
            fit.gamma.where((F.col("target") == target) & (F.col("position") == p)).select("target", "position", "symbol", "gamma").write.parquet(f"{folder}/gamma")
        elif c.winner != "baseline":
            M.fit(walk, target, c.winner, -1).write().save(f"{folder}/trees")
            walk.identity.write().save(f"{folder}/identity")
        score = c.scores.where(F.col("model") == c.winner).agg(F.avg("score")).first()[0]
        prior = M.priors(walk, target)[p] if direction else 0.0
        as_list = lambda a: [None if np.isnan(v) else float(v) for v in a]
        rows.append((target, c.winner, walk.names, dataset_id, holdout_start, score, prior, as_list(walk.medians[target, p]), walk.missing[target, p].tolist(), walk.scales.centre.tolist(), walk.scales.scale.tolist(), coefficients, folder))
    store.publish(spark.createDataFrame(rows, BUNDLE).coalesce(1), root)


@dataclass
class Bundle:
    """A published model: what it predicts, by which predictors, and from which dataset it was made."""

    target: str
    model: str
    predictors: list[str]
    dataset_id: str
    holdout_start: object
    score: float
    row: object

    def predict(self, rows: DataFrame) -> DataFrame:
        """rows (symbol and the predictors by name) with prediction: the probability of 1 for a direction, else the value. A predictor that rows don't have is null, an instrument
        that the model doesn't know has no part in it."""
        spark, r = rows.sparkSession, self.row
        have = rows.withColumn("x", F.array(*[F.col(n).cast("double") if n in rows.columns else F.lit(None).cast("double") for n in self.predictors]))
        if self.model == "baseline":
            return have.withColumn("prediction", F.lit(r["prior"])).drop("x")
        median = np.array([np.nan if v is None else v for v in r["medians"]])
        if self.model == "linear":
            gamma = spark.read.schema("target string, position int, symbol string, gamma double").parquet(f"{r['folder']}/gamma").withColumn("position", F.lit(0))
            by = linear.Scales(np.array(r["centre"]), np.array(r["scale"]))
            fit = linear.Fit(by, self.target.startswith("direction"), {(self.target, 0): np.array(r["coefficients"])}, {}, gamma)
            return fit.predict(have.withColumn("_place", F.lit(0)), self.target, "_place").drop("_place")
        known = M.identified(CountVectorizerModel.load(f"{r['folder']}/identity"), have)
        trees = TREES[self.model, self.target.startswith("direction")].load(f"{r['folder']}/trees")
        return M.chance(trees.transform(M.columns(known, median, np.array(r["missing"]))), self.target).select(*rows.columns, "prediction")


def load(spark: SparkSession, root: str, dataset_id: str) -> dict[str, Bundle]:
    """The current version's bundles by target. Bundles of another dataset than dataset_id are refused."""
    rows = store.published(spark, root).collect()
    other = sorted({r["dataset_id"] for r in rows} - {dataset_id})
    if other:
        raise ValueError(f"models of dataset {', '.join(other)} can't be used with dataset {dataset_id}")
    return {r["target"]: Bundle(r["target"], r["model"], r["predictors"], r["dataset_id"], r["holdout_start"], r["score"], r) for r in rows}

