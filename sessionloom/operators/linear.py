"""Ridge and logistic models of every fold at once.

A walk-forward's training windows expand, so a row says from which fold on it trains (since_<target>) and nothing is copied per fold. What a fit needs are sums over rows of products of
z = (1, values, flags of nulls): nulls count as 0 in the values, so that any fold's imputed and flagged columns are z times a small matrix of that fold's medians. Sums add up over
partitions and over folds. Instruments aren't columns: their block of the normal equations is diagonal, so they are eliminated from it by sums per instrument, in Spark, and a
driver solves systems as large as the predictors, whatever the number of rows and instruments.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from sessionloom.sources.scratch import stored

PENALTY = 10.0  # on squared coefficients of standardized columns: ridge's alpha, and 1 / C of the logistic with C = 0.1
BINS = 128  # of values, for medians
STEPS = 60  # of Newton's method, at most
PARTS = "target string, position int, symbol string, values array<double>"


@dataclass
class Scales:
    """Centre and scale by which values are shifted before products are summed, so that sums keep their digits. Results don't depend on them."""

    centre: np.ndarray
    scale: np.ndarray


def scales(rows: DataFrame, n: int) -> tuple[Scales, list[list[float]]]:
    """Scales and bounds of BINS bins of every one of the n predictors, in one scan."""
    at = [k / BINS for k in range(1, BINS)]
    long = rows.select(F.posexplode("x").alias("feature", "value")).groupBy("feature")
    found = {r["feature"]: r for r in long.agg(F.avg("value").alias("m"), F.stddev_pop("value").alias("s"), F.percentile_approx("value", at, 1000).alias("q")).collect()}
    of = lambda j, c, default: default if j not in found or found[j][c] is None else found[j][c]
    scale = np.array([of(j, "s", 1.0) for j in range(n)])
    return Scales(np.array([of(j, "m", 0.0) for j in range(n)]), np.where(scale > 0, scale, 1.0)), [sorted(set(of(j, "q", []))) for j in range(n)]


def medians(rows: DataFrame, targets: list[str], folds: int, bounds: list[list[float]]) -> tuple[dict[tuple[str, int], np.ndarray], dict[tuple[str, int], np.ndarray]]:
    """By target and position of the fold, over the fold's training rows: the exact median of every predictor (NaN where it has no value), and how many values it has.

    Values are counted by bin and first fold; the counts, which don't grow with the rows, say in which bins the medians lie and at which rank, and only values in these are ordered.
    """
    edges = F.array(*[F.array(*map(F.lit, b)).cast("array<double>") for b in bounds])
    long = rows.select(*[f"since_{t}" for t in targets], F.posexplode("x").alias("feature", "value")).where("value is not null")
    long = long.withColumn("bin", F.size(F.filter(F.get(edges, F.col("feature")), lambda e: e < F.col("value"))))
    held = long.groupBy("feature", "bin", *[f"since_{t}" for t in targets]).agg(F.count(F.lit(1)).alias("n")).toArrow().to_pandas()
    values = {}
    wanted = []
    for t in targets:
        own = held[held[f"since_{t}"].notna()]
        count = np.zeros((len(bounds), BINS + 1, folds), np.int64)
        np.add.at(count, (own["feature"].to_numpy(), own["bin"].to_numpy(), own[f"since_{t}"].to_numpy().astype(int)), own["n"].to_numpy())
        upto = count.cumsum(axis=2)
        total = upto.sum(axis=1)
        values |= {(t, p): total[:, p] for p in range(folds)}
        below = upto.cumsum(axis=1)
        for j, p in zip(*np.nonzero(total)):
            places: dict[int, list[int]] = {}
            for r in {(total[j, p] + 1) // 2, total[j, p] // 2 + 1}:
                b = int(np.searchsorted(below[j, :, p], r))
                places.setdefault(b, []).append(int(r - (below[j, b - 1, p] if b else 0)))
            wanted += [(t, int(p), int(j), b, ranks) for b, ranks in places.items()]
    out = {(t, p): np.full(len(bounds), np.nan) for t in targets for p in range(folds)}
    if not wanted:
        return out, values
    wanted = F.broadcast(rows.sparkSession.createDataFrame(wanted, "target string, position int, feature int, bin int, ranks array<int>"))
    near = long.join(wanted, ["feature", "bin"])
    trained = reduce(lambda a, b: a | b, [(F.col("target") == t) & (F.col(f"since_{t}") <= F.col("position")) for t in targets])
    rank = F.row_number().over(Window.partitionBy("target", "position", "feature", "bin").orderBy("value"))
    found = near.where(trained).withColumn("rank", rank).where(F.array_contains("ranks", F.col("rank")))
    for r in found.groupBy("target", "position", "feature").agg(F.avg("value").alias("median")).collect():
        out[r["target"], r["position"]][r["feature"]] = r["median"]
    return out, values


def _z(batch: pa.RecordBatch, by: Scales) -> np.ndarray:
    values = batch.column("x").flatten().to_numpy(zero_copy_only=False).astype(float).reshape(batch.num_rows, len(by.centre))
    flags = np.isnan(values)
    return np.hstack((np.ones((batch.num_rows, 1)), np.where(flags, 0.0, (values - by.centre) / by.scale), flags.astype(float)))


def _numbers(batch: pa.RecordBatch, name: str, absent: float) -> np.ndarray:
    return batch.column(name).fill_null(absent).to_numpy(zero_copy_only=False)


def _by_symbol(symbols: np.ndarray, values: np.ndarray) -> Iterator[tuple[str, np.ndarray]]:
    names, code = np.unique(symbols, return_inverse=True)
    order = np.argsort(code, kind="stable")
    sums = np.add.reduceat(values[order], np.searchsorted(code[order], np.arange(len(names))))
    yield from zip(names, sums)


def _listed(sums: dict[tuple, np.ndarray]) -> Iterator[pa.RecordBatch]:
    kind = pa.schema([("target", pa.string()), ("position", pa.int32()), ("symbol", pa.string()), ("values", pa.list_(pa.float64()))])
    for key, values in sums.items():
        yield pa.RecordBatch.from_arrays([pa.array([k], t.type) for k, t in zip((*key, values), kind)], schema=kind)


def _added(parts: DataFrame) -> DataFrame:
    """Sums of arrays by (target, position, symbol), added up on either side of the shuffle."""
    sums = parts.groupBy("target", "position", "symbol").agg(Summarizer.sum(array_to_vector("values")).alias("v"))
    return sums.select("target", "position", "symbol", vector_to_array("v").alias("values"))


def moments(rows: DataFrame, targets: list[str], by: Scales) -> DataFrame:
    """By target and first fold: z'z and z'y (symbol null), and by symbol the sums of z, y and 1. One scan of rows."""

    def run(batches):
        sums: dict[tuple, np.ndarray] = {}
        for batch in batches:
            z, symbols = _z(batch, by), batch.column("symbol").to_numpy(zero_copy_only=False)
            for t in targets:
                since, y = _numbers(batch, f"since_{t}", -1), _numbers(batch, t, 0.0)
                for p in np.unique(since[since >= 0]).tolist():
                    own = since == p
                    part = z[own]
                    sums[t, p, None] = sums.get((t, p, None), 0) + np.concatenate(((part.T @ part).ravel(), part.T @ y[own]))
                    for s, v in _by_symbol(symbols[own], np.column_stack((part, y[own], np.ones(len(part))))):
                        sums[t, p, s] = sums.get((t, p, s), 0) + v
        yield from _listed(sums)

    columns = ["symbol", "x", *[c for t in targets for c in (t, f"since_{t}")]]
    return _added(rows.select(*columns).mapInArrow(run, PARTS))


@dataclass
class Problem:
    """A fold's columns as linear maps of z: turn (z to columns), spread (their population deviation), used (which are not constant), n rows, median z-values."""

    turn: np.ndarray
    spread: np.ndarray
    used: np.ndarray
    n: float

    @classmethod
    def of(cls, gram: np.ndarray, median: np.ndarray, by: Scales) -> Problem:
        """gram: z'z of the fold's training rows. A predictor without values is 0 there, as the flag of one without nulls."""
        d, n = len(median), gram[0, 0]
        turn = np.eye(2 * d + 1)
        turn[np.arange(d) + d + 1, np.arange(d) + 1] = (np.where(np.isnan(median), 0.0, median) - by.centre) / by.scale
        own = turn.T @ gram @ turn / n
        variance = np.diag(own) - own[0] ** 2
        used = variance > 1e-12 * np.maximum(1.0, np.diag(own))
        used[0] = True
        return cls(turn, np.where(used, np.sqrt(np.maximum(variance, 0)), 0.0), used, n)


def _symbol_terms(problem: Problem, values: np.ndarray, gamma: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, ...]:
    """Of instruments' sums: h (weighted sums of the columns), the diagonal entry with its penalty, the penalised residual, and the penalty. Nothing for those that are constant in the fold."""
    share = n / problem.n
    penalty = PENALTY * share * (1 - share)
    h = values[:, :-2] @ problem.turn * problem.used
    return h, values[:, -2] - penalty * gamma, penalty, (share > 0) & (share < 1 - 1e-12)


def _eliminated(symbols: DataFrame, problems: dict[tuple[str, int], Problem]) -> dict[tuple[str, int], tuple[np.ndarray, np.ndarray, float, float]]:
    """By problem what the instruments take off the matrix and the right side, their share of Newton's decrement, and their penalty. symbols: target, position, symbol, values, gamma."""

    def run(batches):
        sums: dict[tuple, np.ndarray] = {}
        for batch in batches:
            keys = list(zip(batch.column("target").to_pylist(), batch.column("position").to_pylist()))
            values = batch.column("values").flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1)
            gamma = _numbers(batch, "gamma", 0.0)
            for key in dict.fromkeys(keys):
                if key in problems:
                    own = np.array([k == key for k in keys])
                    h, r, penalty, free = _symbol_terms(problems[key], values[own], gamma[own], values[own][:, -1])
                    h, r, penalty, weight, g = h[free], r[free], penalty[free], values[own][free, 0], gamma[own][free]
                    part = h / (weight + penalty)[:, None]
                    sums[*key, None] = sums.get((*key, None), 0) + np.concatenate(((part.T @ h).ravel(), part.T @ r, [(r * r / (weight + penalty)).sum(), (penalty * g * g).sum()]))
        yield from _listed(sums)

    out = {}
    for row in _added(symbols.mapInArrow(run, PARTS)).collect():
        values, m = np.array(row["values"]), len(problems[row["target"], row["position"]].spread)
        out[row["target"], row["position"]] = values[: m * m].reshape(m, m), values[m * m : -2], values[-2], values[-1]
    return out


def _solved(problem: Problem, matrix: np.ndarray, right: np.ndarray) -> np.ndarray:
    """The step of the used columns; zero for the others."""
    step, used = np.zeros(len(right)), problem.used
    step[used] = np.linalg.solve(matrix[np.ix_(used, used)], right[used])
    return step


@dataclass
class Fit:
    """Coefficients on z by (target, position), and gamma: target, position, symbol, gamma (an instrument that a fold didn't train on has none)."""

    by: Scales
    direction: bool
    coefficients: dict[tuple[str, int], np.ndarray]
    problems: dict[tuple[str, int], Problem]
    gamma: DataFrame
    steps: int = 1

    def predict(self, rows: DataFrame, target: str, position: str) -> DataFrame:
        """rows (symbol, x and the column `position`, the fold whose model is asked) with prediction: the probability of 1 for a direction."""
        by, direction, coefficients = self.by, self.direction, {p: c for (t, p), c in self.coefficients.items() if t == target}
        own = self.gamma.where(F.col("target") == target).select("symbol", F.col("position").alias(position), "gamma")
        joined = rows.join(own, ["symbol", position], "left")

        def run(batches):
            for batch in batches:
                z, at = _z(batch, by), batch.column(position).to_numpy(zero_copy_only=False)
                value = _numbers(batch, "gamma", 0.0).copy()
                for p in np.unique(at).tolist():
                    value[at == p] += z[at == p] @ coefficients[p]
                out = 1 / (1 + np.exp(-value)) if direction else value
                yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in names], pa.array(out)], [*names, "prediction"])

        names = [c for c in rows.columns if c != "x"]
        fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.select(*names).schema)
        return joined.mapInArrow(run, f"{fields}, prediction double")


def ridge(rows: DataFrame, targets: list[str], folds: int, by: Scales, median: dict[tuple[str, int], np.ndarray]) -> Fit:
    """Ridge models of all targets and folds from one scan: min sum (y - b0 - b x - g[instrument])**2 + PENALTY * (squares of coefficients of standardized columns)."""
    sums = stored(moments(rows, targets, by), "moments")
    m = 2 * len(by.centre) + 1
    whole = {t: np.zeros((folds, m * m + m)) for t in targets}
    for r in sums.where("symbol is null").collect():
        whole[r["target"]][r["position"]] = r["values"]
    problems, sides = {}, {}
    for t in targets:
        for p, values in enumerate(whole[t].cumsum(axis=0)):
            gram = values[: m * m].reshape(m, m)
            if gram[0, 0] > 0:
                problem = problems[t, p] = Problem.of(gram, median[t, p], by)
                sides[t, p] = problem.turn.T @ gram @ problem.turn + np.diag(PENALTY * problem.spread**2), problem.turn.T @ values[m * m :]
    # an instrument's sums up to each fold
    steps = F.sequence(F.col("position"), F.lit(folds - 1))
    upto = sums.where("symbol is not null").select("target", F.explode(steps).alias("position"), "symbol", "values")
    symbols = stored(_added(upto).withColumn("gamma", F.lit(0.0)), "symbol_sums")
    taken = _eliminated(symbols, problems)
    beta = {}
    for key, (matrix, right) in sides.items():
        off, part, _, _ = taken.get(key, (0, 0, 0, 0))
        beta[key] = _solved(problems[key], matrix - off, right - part)
    gamma = _moved(symbols, problems, {k: (b, 1.0, True) for k, b in beta.items()})
    return Fit(by, False, {k: problems[k].turn @ b for k, b in beta.items()}, problems, stored(gamma.select("target", "position", "symbol", (F.col("gamma") + F.col("delta")).alias("gamma")), "gamma"))


def _moved(symbols: DataFrame, problems: dict[tuple[str, int], Problem], moves: dict[tuple[str, int], tuple[np.ndarray, float, bool]]) -> DataFrame:
    """Instruments' next state: gamma and the full step delta from it that belongs to the step of the columns. moves: step of the columns, and whether it starts from the state's end."""

    def run(batches):
        for batch in batches:
            keys = list(zip(batch.column("target").to_pylist(), batch.column("position").to_pylist()))
            values = batch.column("values").flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1)
            gamma, delta = _numbers(batch, "gamma", 0.0), np.zeros(batch.num_rows)
            for key in dict.fromkeys(keys):
                own = np.array([k == key for k in keys])
                if key in moves:
                    h, r, penalty, free = _symbol_terms(problems[key], values[own], gamma[own], values[own][:, -1])
                    delta[own] = np.where(free, (r - h @ moves[key][0]) / (values[own][:, 0] + np.where(free, penalty, 1.0)), 0.0)
            yield pa.RecordBatch.from_arrays([batch.column("target"), batch.column("position"), batch.column("symbol"), pa.array(gamma), pa.array(delta)], ["target", "position", "symbol", "gamma", "delta"])

    return symbols.mapInArrow(run, "target string, position int, symbol string, gamma double, delta double")


def _logistic_sums(rows: DataFrame, target: str, by: Scales, folds: list[int], coefficients: dict[int, np.ndarray], gamma: DataFrame | None) -> DataFrame:
    """By fold at its coefficients: z'wz, z'r and the loss (symbol null); by symbol the sums of wz, r and 1. One scan for all folds."""
    table = rows.select("symbol", "x", target, f"since_{target}").where(F.col(f"since_{target}").isNotNull())
    if gamma is None:
        table = table.withColumn("gammas", F.lit(None).cast("map<int,double>"))
    else:
        table = table.join(gamma.groupBy("symbol").agg(F.map_from_entries(F.collect_list(F.struct("position", "gamma"))).alias("gammas")), "symbol", "left")
    table = table.withColumn("gammas", F.array(*[F.coalesce(F.try_element_at("gammas", F.lit(p)), F.lit(0.0)) for p in folds]))

    def run(batches):
        sums: dict[tuple, np.ndarray] = {}
        for batch in batches:
            z, symbols = _z(batch, by), batch.column("symbol").to_numpy(zero_copy_only=False)
            since, y = _numbers(batch, f"since_{target}", -1), _numbers(batch, target, 0.0)
            gammas = batch.column("gammas").flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, len(folds))
            for k, p in enumerate(folds):
                own = since <= p
                if own.any():
                    part = z[own]
                    logit = part @ coefficients[p] + gammas[own, k]
                    chance = 1 / (1 + np.exp(-logit))
                    weighted, r = part * (chance * (1 - chance))[:, None], y[own] - chance
                    loss = (np.logaddexp(0, logit) - y[own] * logit).sum()
                    sums[target, p, None] = sums.get((target, p, None), 0) + np.concatenate(((part.T @ weighted).ravel(), part.T @ r, part.sum(axis=0), [loss]))
                    for s, v in _by_symbol(symbols[own], np.column_stack((weighted, r, np.ones(len(part))))):
                        sums[target, p, s] = sums.get((target, p, s), 0) + v
        yield from _listed(sums)

    return _added(table.mapInArrow(run, PARTS))


def logistic(rows: DataFrame, target: str, folds: int, by: Scales, median: dict[tuple[str, int], np.ndarray], tolerance: float = 1e-10) -> Fit:
    """Logistic models of all folds by Newton's method, a step of all of them at a time: min sum of log losses + PENALTY / 2 * (squares of coefficients of standardized columns).

    A fold's step is halved while its objective would rise, and a fold ends when Newton's decrement is below `tolerance` a row. No convergence is an error.
    """
    first = {}
    m = 2 * len(by.centre) + 1
    for r in moments(rows, [target], by).where("symbol is null").collect():
        first[r["position"]] = np.array(r["values"])
    problems, total = {}, np.zeros(m * m + m)
    for p in range(folds):
        total = total + first.get(p, 0)
        if total[0] > 0:
            problems[target, p] = Problem.of(total[: m * m].reshape(m, m), median[target, p], by)
    beta = {k: np.zeros(m) for k in problems}
    base, step, factor, best = dict(beta), dict(beta), {k: 1.0 for k in problems}, {}
    state, gamma, open_ = None, None, sorted(problems)
    for turn in range(STEPS):
        now = {p: problems[t, p].turn @ beta[t, p] for t, p in open_}
        sums = stored(_logistic_sums(rows, target, by, [p for _, p in open_], now, gamma), "newton")
        known = gamma if gamma is not None else sums.limit(0).select("target", "position", "symbol", F.lit(0.0).alias("gamma"))
        symbols = sums.where("symbol is not null").join(known, ["target", "position", "symbol"], "left").fillna(0.0, ["gamma"])
        taken = _eliminated(symbols, problems)
        moves, done = {}, []
        for r in sums.where("symbol is null").collect():
            key, values = (r["target"], r["position"]), np.array(r["values"])
            problem, (off, part, decrement, penalty) = problems[key], taken.get(key, (0.0, 0.0, 0.0, 0.0))
            own = PENALTY * problem.spread**2
            objective = values[-1] + (own @ beta[key] ** 2 + penalty) / 2
            if objective > best.get(key, np.inf) * (1 + 1e-12):
                factor[key] /= 2
                continue
            best[key] = objective
            right = problem.turn.T @ values[m * m : m * m + m] - own * beta[key] - part
            right = np.where(problem.used, right, 0.0)
            move = _solved(problem, problem.turn.T @ values[: m * m].reshape(m, m) @ problem.turn + np.diag(own) - off, right)
            moves[key] = move, 1.0, True
            base[key], step[key], factor[key] = beta[key], move, 1.0
            if (right @ move + decrement) / problem.n < tolerance:
                done.append(key)
        for key in open_:
            beta[key] = base[key] + factor[key] * step[key]
        moved = _moved(symbols, problems, moves)
        if state is not None:
            # a fold whose step was too long keeps its start; a fold that ended its place
            kept = state.join(F.broadcast(rows.sparkSession.createDataFrame([(t, p) for t, p in moves] or [("", -1)], "target string, position int")), ["target", "position"], "left_anti")
            moved = moved.join(F.broadcast(rows.sparkSession.createDataFrame([(t, p) for t, p in moves] or [("", -1)], "target string, position int")), ["target", "position"], "left_semi").unionByName(kept)
        state = stored(moved, "instruments")
        length = F.coalesce(*[F.when((F.col("target") == t) & (F.col("position") == p), F.lit(f)) for (t, p), f in factor.items()], F.lit(1.0))
        gamma = state.select("target", "position", "symbol", (F.col("gamma") + length * F.col("delta")).alias("gamma"))
        open_ = [k for k in open_ if k not in done]
        if not open_:
            return Fit(by, True, {k: problems[k].turn @ b for k, b in beta.items()}, problems, gamma, turn + 1)
    raise RuntimeError(f"no convergence in {STEPS} steps for folds {[p for _, p in open_]}")


def steepest(rows: DataFrame, fit: Fit, target: str) -> DataFrame:
    """By position: training rows n, and the largest slope of the objective along any standardized coefficient or intercept, over n. It is 0 at the answer, but for rounding.

    Residuals come from predictions, row by row, not from the sums that the fit was made of.
    """
    folds = sorted(p for t, p in fit.coefficients if t == target)
    trained = rows.where(F.col(f"since_{target}").isNotNull()).select("symbol", "x", F.col(target).cast("double").alias("y"), F.explode(F.sequence(F.col(f"since_{target}"), F.lit(max(folds)))).alias("at"))
    by, problems, coefficients = fit.by, fit.problems, fit.coefficients
    predicted = fit.predict(trained.withColumn("kept", F.col("x")), target, "at").select("symbol", "at", F.col("kept").alias("x"), (F.col("y") - F.col("prediction")).alias("r"))

    def run(batches):
        sums: dict[tuple, np.ndarray] = {}
        for batch in batches:
            z, at, r, symbols = _z(batch, by), batch.column("at").to_numpy(), batch.column("r").to_numpy(), batch.column("symbol").to_numpy(zero_copy_only=False)
            for p in np.unique(at).tolist():
                own = at == p
                sums[target, p, None] = sums.get((target, p, None), 0) + z[own].T @ r[own]
                for s, v in _by_symbol(symbols[own], np.column_stack((r[own], np.ones(int(own.sum()))))):
                    sums[target, p, s] = sums.get((target, p, s), 0) + v
        yield from _listed(sums)

    sums = _added(predicted.mapInArrow(run, PARTS)).join(fit.gamma, ["target", "position", "symbol"], "left")

    def slopes(batches):
        for batch in batches:
            out = []
            for p, s, values, gamma in zip(*[batch.column(c).to_pylist() for c in ("position", "symbol", "values", "gamma")]):
                problem, v = problems[target, p], np.array(values)
                if s is None:
                    beta = np.linalg.solve(problem.turn, coefficients[target, p])
                    slope = (problem.turn.T @ v - PENALTY * problem.spread**2 * beta)[problem.used] / np.where(problem.spread > 0, problem.spread, 1.0)[problem.used]
                    out.append(float(np.abs(slope).max() / problem.n))
                else:
                    share = v[1] / problem.n
                    spread = np.sqrt(share * (1 - share))
                    out.append(float(abs(v[0] - PENALTY * spread**2 * (gamma or 0.0)) / spread / problem.n) if share < 1 - 1e-12 else 0.0)
            yield pa.RecordBatch.from_arrays([batch.column("position"), pa.array(out), batch.column("symbol").is_null()], ["position", "slope", "whole"])

    n = {p: int(round(problems[target, p].n)) for p in folds}
    found = sums.mapInArrow(slopes, "position int, slope double, whole boolean").groupBy("position").agg(F.max("slope").alias("slope"))
    return found.select("position", F.get(F.array(*[F.lit(n.get(p, 0)).cast("long") for p in range(max(folds) + 1)]), F.col("position")).alias("n"), "slope")
