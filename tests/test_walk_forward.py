"""The walk-forward over every fold, target, model and symbol."""

import random
from datetime import timedelta
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F

from sessionloom.config import Models
from sessionloom.operators import bundles as B
from sessionloom.operators import evaluate as E
from sessionloom.operators import features as FT
from sessionloom.operators import labels as L
from sessionloom.operators import linear as LN
from sessionloom.operators import models as M
from sessionloom.plans import fixtures as X
from sessionloom.plans import research
from tests.helpers import DAY0

SF = "/root/testdata/sf0.01"
FOLDS = [0, 1, 2, -1]
STARTS = (80, 120, 140, 160)


def panel(spark, n=200, symbols=("A", "B"), more=0, missing=0.0, seed=1):
    """Three validation folds and the holdout; x decides the direction, returns are noise around 0. `more` noisy predictors, and nulls in all of them."""
    rng, rows = random.Random(seed), []
    for i in range(n):
        since = next((k for k, s in enumerate(STARTS) if i < s), None)
        test = max((k for k, s in enumerate(STARTS) if i >= s), default=None)
        for k, s in enumerate(symbols):
            x = rng.uniform(-1, 1)
            others = [None if rng.random() < missing else rng.gauss(100 * j, 10.0**j) + k for j in range(more)]
            rows.append((s, DAY0 + timedelta(days=i), [None if rng.random() < missing / 2 else x, *others], float(x + rng.uniform(-0.2, 0.2) > 0), rng.uniform(-1, 1) + k / 5, rng.uniform(-1, 1), *[since] * 3, *[test] * 3, i == n - 1))
    targets = list(Models().targets)
    kind = "symbol string, session_date date, x array<double>, " + ", ".join([f"{t} double" for t in targets] + [f"{p}_{t} int" for p in ("since", "test") for t in targets]) + ", latest boolean"
    return spark.createDataFrame(rows, kind)


@pytest.fixture(scope="module")
def walk(spark):
    return M.walk(panel(spark), FOLDS, ["x"])


@pytest.fixture(scope="module")
def wide(spark):
    """Six predictors of very different size, with nulls, and five symbols, one of which comes late."""
    rows = panel(spark, symbols=tuple("ABCDE"), more=5, missing=0.1).where("symbol <> 'E' or session_date > date '2020-04-15'")
    return M.walk(rows, FOLDS, list("abcdef"))


def closed(walk, target, p):
    """Design matrices of a fold in plain numpy: imputed, flagged, with instruments, standardized by the training rows; and both outcomes."""
    rows = walk.rows.select("symbol", "session_date", "x", target, f"since_{target}", f"test_{target}").toPandas()
    x = np.array(rows["x"].tolist(), float)
    train, test = (rows[f"since_{target}"] <= p).to_numpy(), (rows[f"test_{target}"] == p).to_numpy()
    nulls = np.isnan(x)
    x = np.where(nulls, np.nanmedian(x[train], axis=0), x)
    x = np.hstack((x, nulls[:, nulls[train].any(axis=0)], np.array([rows["symbol"] == s for s in sorted(set(rows["symbol"]))]).T)).astype(float)
    spread = x[train].std(axis=0)
    x = (x - x[train].mean(axis=0)) / np.where(spread > 1e-9, spread, 1)
    keys = list(zip(rows["symbol"][test], rows["session_date"][test]))
    return x[train], rows[target][train].to_numpy(float), x[test], keys


@pytest.mark.parametrize("p", [0, 2, 3])
def test_ridge_is_the_closed_form(wide, p):
    for target in ("future_return_1d", "future_return_5d"):
        x, y, later, keys = closed(wide, target, p)
        beta = np.linalg.solve(x.T @ x + 10 * np.eye(x.shape[1]), x.T @ (y - y.mean()))
        want = dict(zip(keys, later @ beta + y.mean()))
        got = {(r["symbol"], r["session_date"]): r["prediction"] for r in M.walk_forward(wide, target, "linear", [FOLDS[p]]).collect()}
        assert got.keys() == want.keys() and all(got[k] == pytest.approx(want[k], abs=1e-9) for k in want)


def test_logistic_is_the_optimum(wide):
    target, p = "direction_1d", 1
    x, y, later, keys = closed(wide, target, p)
    x, later = (np.hstack((np.ones((len(m), 1)), m)) for m in (x, later))
    beta, penalty = np.zeros(x.shape[1]), np.diag([0.0, *[10.0] * (x.shape[1] - 1)])
    for _ in range(50):
        chance = 1 / (1 + np.exp(-x @ beta))
        beta += np.linalg.lstsq((x.T * (chance * (1 - chance))) @ x + penalty, x.T @ (y - chance) - penalty @ beta, rcond=None)[0]
    want = dict(zip(keys, 1 / (1 + np.exp(-later @ beta))))
    got = {(r["symbol"], r["session_date"]): r["prediction"] for r in M.walk_forward(wide, target, "linear", [FOLDS[p]]).collect()}
    assert got.keys() == want.keys() and all(got[k] == pytest.approx(want[k], abs=1e-7) for k in want)


def test_slopes_tell_an_optimum(wide):
    for target in Models().targets:
        fit = wide.lines(target)
        rows = LN.steepest(wide.rows, fit, target).collect()
        assert [(r["position"], r["n"]) for r in sorted(rows)] == [(p, wide.sizes[target, p][0]) for p in range(4)] and all(r["slope"] < 1e-8 for r in rows)
        moved = LN.Fit(fit.by, fit.direction, {k: c + 0.01 for k, c in fit.coefficients.items()}, fit.problems, fit.gamma)
        assert all(r["slope"] > 1e-4 for r in LN.steepest(wide.rows, moved, target).collect())


def test_steps_that_are_too_long_are_halved(spark):
    """Outcomes that one predictor nearly decides, with a weight that makes Newton's first steps overshoot."""
    rows = panel(spark, n=200).withColumn("x", F.transform("x", lambda v: F.when(F.col("direction_1d") == 1, 1e6 + v).otherwise(v - 1e6)))
    own = M.walk(rows, FOLDS, ["x"])
    fit = own.lines("direction_1d")
    assert all(r["slope"] < 1e-8 for r in LN.steepest(own.rows, fit, "direction_1d").collect())


def test_medians_are_exact(wide):
    rows = wide.rows.toPandas()
    x = np.array(rows["x"].tolist(), float)
    for t in Models().targets:
        for p in range(4):
            assert wide.medians[t, p] == pytest.approx(np.nanmedian(x[(rows[f"since_{t}"] <= p).to_numpy()], axis=0))


def test_select_and_score(walk):
    rows = M.select_and_score(walk, ("linear",)).collect()
    for target in Models().targets:
        own = [r for r in rows if r["target"] == target]
        score = "brier" if target.startswith("direction") else "mae"
        assert sorted((r["model"], r["fold"]) for r in own if r["split"] == "validation") == [(m, k) for m in ("baseline", "linear") for k in range(3)]
        mean = {m: sum(r[score] for r in own if r["model"] == m and r["fold"] >= 0) for m in ("baseline", "linear")}
        winner = min(mean, key=mean.get)
        assert {r["winner"] for r in own} == {winner}
        assert sorted(r["model"] for r in own if r["split"] == "holdout") == sorted({winner, "baseline"})
    assert {r["winner"] for r in rows if r["target"] == "direction_1d"} == {"linear"}
    assert {(r["fold"], r["n_rows"]) for r in rows} == {(0, 80), (1, 40), (2, 40), (-1, 80)}


def test_selected_model_is_refitted_and_forecasts(walk):
    for target, winner in (("direction_1d", "linear"), ("future_return_1d", None)):
        chosen = M.select(walk, target, ("linear",))
        assert chosen.winner == (winner or chosen.winner)
        held = M.holdout(chosen).collect()
        assert {r["model"] for r in held} == {"baseline", chosen.winner} and all(r["fold"] == -1 for r in held)
        made = M.forecast(chosen).collect()
        assert sorted(r["symbol"] for r in made) == ["A", "B"] and {r["model"] for r in made} == {chosen.winner}
        if chosen.winner == "linear":  # the same model as that of the holdout
            same = {(r["symbol"], r["session_date"]): r["prediction"] for r in held if r["model"] == "linear"}
            assert all(same[r["symbol"], r["session_date"]] == pytest.approx(r["prediction"]) for r in made)


@pytest.mark.parametrize("model", M.FITTED)
def test_every_model_predicts_every_fold(spark, walk, model):
    small = M.Walk(**{**vars(walk), "config": Models(trees=3, boost_trees=2)})
    for target in ("direction_1d", "future_return_5d"):
        out = M.walk_forward(small, target, model, [-1, 1])
        assert {(r["fold"], r["count"]) for r in out.groupBy("fold").count().collect()} == {(-1, 80), (1, 40)}
        if target == "direction_1d" and model != "boosted":
            assert all(r["roc_auc"] > 0.9 for r in E.classification(out, "fold").collect())


def test_short_fold_is_an_error(walk):
    with pytest.raises(ValueError, match="folds \\[5\\]"):
        M.walk_forward(walk, "direction_1d", "linear", [0, 5])


def test_bundles(spark, wide, tmp_path):
    """Every kind of model is published, loaded and asked without another fit; an unknown symbol and an absent predictor are no error, another dataset is."""
    small = M.Walk(**{**vars(wide), "config": Models(trees=3, boost_trees=2)})
    latest = wide.rows.where("latest").select("symbol", "session_date", *[F.get("x", F.lit(j)).alias(n) for j, n in enumerate(wide.names)])
    for model in ("baseline", *M.FITTED):
        root = str(tmp_path / model)
        chosen = [M.Selection(small, t, spark.createDataFrame([(model, 0.5)], "model string, score double"), model) for t in Models().targets]
        B.publish(chosen, root, "one", DAY0)
        bundles = B.load(spark, root, "one")
        assert {(b.target, b.model, b.dataset_id, b.holdout_start, b.score) for b in bundles.values()} == {(t, model, "one", DAY0, 0.5) for t in Models().targets}
        for c in chosen:
            want = {r["symbol"]: r["prediction"] for r in M.forecast(c).collect()}
            got = {r["symbol"]: r["prediction"] for r in bundles[c.target].predict(latest).collect()}
            assert got.keys() == want.keys() == set("ABCDE") and all(got[s] == pytest.approx(want[s], abs=1e-12) for s in want)
        odd = latest.withColumn("symbol", F.lit("new")).drop("a", "b")
        assert all(r["prediction"] is not None for r in bundles["direction_1d"].predict(odd).collect())
        with pytest.raises(ValueError, match="dataset one can't be used with dataset two"):
            B.load(spark, root, "two")
    with pytest.raises(RuntimeError, match="nothing is published"):
        B.load(spark, str(tmp_path / "none"), "one")


def test_content_id(spark):
    rows = spark.createDataFrame([(1, "a"), (2, None), (2, None)], "i int, s string")
    same = B.content_id(rows)
    assert same == B.content_id(rows.orderBy(F.desc("i")).repartition(3)) and len(same) == 64
    others = [rows.distinct(), rows.withColumn("i", F.col("i") + 1), rows.withColumnRenamed("i", "k"), rows.limit(0)]
    assert len({same, *map(B.content_id, others)}) == 5


@pytest.mark.skipif(not Path(SF).exists(), reason="no test data")
def test_windows_are_the_marks(spark):
    """since and test say what the copy per fold says."""
    design = research._design(spark, SF)
    folds = research._folds(spark, SF)
    rows, ids = L.windows(design, folds, FT.feature_names())
    assert len(ids) > 10 and ids[-1] == -1
    marks = L.marked(design, folds)
    for t in Models().targets:
        train = rows.where(f"since_{t} is not null").select("symbol", "session_date", F.explode(F.sequence(F.col(f"since_{t}"), F.lit(len(ids) - 1))).alias("p"))
        test = rows.where(f"test_{t} is not null").select("symbol", "session_date", F.col(f"test_{t}").alias("p"))
        for own, name in ((train, "train"), (test, "test")):
            got = own.select("symbol", "session_date", F.get(F.array(*map(F.lit, ids)), F.col("p")).alias("fold"))
            want = marks.where(f"{name}_{t}").select("symbol", "session_date", "fold")
            assert got.exceptAll(want).isEmpty() and want.exceptAll(got).isEmpty()


@pytest.mark.skipif(not Path(SF).exists(), reason="no test data")
def test_registered_over_all(spark, monkeypatch):
    walk = research._walk(spark, SF)
    assert walk.names == FT.feature_names() and len(walk.names) == 39
    assert {r["symbol"] for r in walk.rows.select("symbol").distinct().collect()} == {r["symbol"] for r in X.instruments(spark, SF).collect()}
    assert walk.folds == [*range(len(walk.folds) - 1), -1] and len(walk.folds) > 10
    seen = []
    monkeypatch.setattr(research, "_walk", lambda spark, sf: walk)
    monkeypatch.setattr(M, "walk_forward", lambda own, target, model: seen.append((model, target)) or spark.range(1))
    for name in ("ml_08_linear", "ml_08_ridge", "ml_09_random_forest", "ml_10_boosted"):
        research.QUERIES[name](spark, SF)
    assert set(seen) == {(m, t) for m in M.FITTED for t in Models().targets}
