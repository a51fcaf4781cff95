"""Forward labels and purged walk-forward splits."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from sessionloom.config import Models
from sessionloom.operators.sessions import by_symbol, horizon_eligible


def labels(aligned: DataFrame) -> DataFrame:
    """future_return_h where sessions t..t+h all are eligible, target_date_h whether or not, and direction_1d (0 or 1)."""
    price = F.col("adj_close")
    out = {}
    for h in (1, 5):
        out[f"future_return_{h}d"] = F.when(horizon_eligible(F.col("feature_eligible"), h), F.lead(price, h).over(by_symbol()) / price - 1)
        out[f"target_date_{h}d"] = F.lead("session_date", h).over(by_symbol())
    made = aligned.select("symbol", "session_date", "feature_eligible", *[v.alias(k) for k, v in out.items()])
    direction = F.when(F.col("future_return_1d").isNotNull(), (F.col("future_return_1d") > 0).cast("double"))
    return made.drop("feature_eligible").withColumn("direction_1d", direction)


def folds(dates: DataFrame, config: Models = Models()) -> DataFrame:
    """fold, start, end for each validation fold, and one row of fold -1 for the holdout. Folds begin train_years after the
    first date and are fold_months long; the last one ends with the holdout's start."""
    span = dates.agg(F.min("session_date").alias("first"), F.max("session_date").alias("last"))
    span = span.select(F.add_months("first", 12 * config.train_years).alias("first"), F.add_months("last", -config.holdout_months).alias("holdout"), F.date_add("last", 1).alias("stop"))
    n = F.greatest(F.lit(0), F.ceil(F.months_between("holdout", "first") / config.fold_months) + 1).cast("int")
    many = span.where("first < holdout").withColumn("fold", F.explode(F.sequence(F.lit(0), n)))
    many = many.withColumn("start", F.add_months("first", F.col("fold") * config.fold_months)).where("start < holdout")
    many = many.select("fold", "start", F.least(F.add_months("first", (F.col("fold") + 1) * config.fold_months), F.col("holdout")).alias("end"))
    return many.unionByName(span.select(F.lit(-1).alias("fold"), F.col("holdout").alias("start"), F.col("stop").alias("end")))


def ready(target: str) -> Column:
    return F.col("core_ready") & F.col(target).isNotNull()


def is_train(target: str) -> Column:
    """Rows before the fold whose five-session outcome also is, whatever the target's horizon."""
    return F.coalesce(ready(target) & (F.col("session_date") < F.col("start")) & (F.col("target_date_5d") < F.col("start")), F.lit(False))


def is_test(target: str, horizon: int) -> Column:
    inside = (F.col("session_date") >= F.col("start")) & (F.col("session_date") < F.col("end"))
    return F.coalesce(ready(target) & inside & (F.col(f"target_date_{horizon}d") < F.col("end")), F.lit(False))


def marked(rows: DataFrame, fold_table: DataFrame, config: Models = Models()) -> DataFrame:
    """rows for every fold with train_<target> and test_<target>: all folds in one pass over broadcast folds (a few rows per year)."""
    out = rows.join(F.broadcast(fold_table), F.col("session_date") < F.col("end"))
    marks = {f"train_{t}": is_train(t) for t in config.targets} | {f"test_{t}": is_test(t, h) for t, h in config.targets.items()}
    out = out.withColumns(marks)
    return out.where(reduce(lambda a, b: a | b, [F.col(m) for m in marks]))


def windows(rows: DataFrame, fold_table: DataFrame, names: list[str], config: Models = Models()) -> tuple[DataFrame, list[int]]:
    """What marked says of rows and folds, without a copy per fold: symbol, session_date, targets, x (the predictors as an array), and for each target
    since_<t>, the place of the first fold that trains on the row (as do all later ones), and test_<t>, the place of the fold that it tests; null for none.

    Also returns the ids of folds by place: in the order of their starts, so that the holdout (-1) is last. Folds are a few rows per year.
    """
    table = sorted((r["start"], r["end"], r["fold"]) for r in fold_table.collect())
    starts, ends = (F.array(*[F.lit(r[k]) for r in table]).cast("array<date>") for k in (0, 1))

    def reached(day: Column) -> Column:
        return F.size(F.filter(starts, lambda s: s <= day))

    first, own = reached(F.greatest("session_date", "target_date_5d")), reached(F.col("session_date")) - 1
    out = {}
    for t, h in config.targets.items():
        out[f"since_{t}"] = F.when(F.coalesce(ready(t), F.lit(False)) & F.col("target_date_5d").isNotNull() & (first < len(table)), first)
        end = F.get(ends, own)
        out[f"test_{t}"] = F.when(F.coalesce(ready(t) & (own >= 0) & (F.col("session_date") < end) & (F.col(f"target_date_{h}d") < end), F.lit(False)), own)
    x = F.array(*[F.col(n).cast("double") for n in names])
    return rows.select("symbol", "session_date", *config.targets, x.alias("x"), *[v.alias(k) for k, v in out.items()]), [r[2] for r in table]


def split_audit(marks: DataFrame, config: Models = Models()) -> DataFrame:
    """Per target and fold: bounds, train and test rows, latest training outcome."""
    parts = []
    for t in config.targets:
        parts.append(marks.groupBy("fold", "start", "end").agg(
            F.count_if(f"train_{t}").alias("train_rows"), F.count_if(f"test_{t}").alias("test_rows"), F.max(F.when(F.col(f"train_{t}"), F.col("target_date_5d"))).alias("latest_training_outcome"),
        ).withColumn("target", F.lit(t)))
    return reduce(DataFrame.unionByName, parts).select("target", "fold", "start", "end", "train_rows", "test_rows", "latest_training_outcome")


def audit_violations(audit: DataFrame, config: Models = Models()) -> DataFrame:
    """Counts that must be zero: outcomes that reach the fold, folds with too few rows."""
    return audit.groupBy("target").agg(
        F.count_if(F.col("latest_training_outcome") >= F.col("start")).alias("leaks"),
        F.count_if((F.col("train_rows") < config.least_train) | (F.col("test_rows") < 1)).alias("inadequate"),
    )


def fold_medians(marks: DataFrame, names: list[str], target: str) -> DataFrame:
    """Exact medians of the training rows of each fold, and how many of their values are null.

    Sketched quantiles bracket the median; only the few values between them are ranked, so no task holds all values of a fold.
    """
    train = marks.where(f"train_{target}").select("fold", *[F.col(n).cast("double").alias(n) for n in names])
    nulls = train.groupBy("fold").agg(*[F.count_if(F.col(n).isNull()).alias(f"nulls_{n}") for n in names])
    long = train.unpivot("fold", names, "feature", "value").where("value is not null")
    keys = ["fold", "feature"]
    bounds = long.groupBy(*keys).agg(F.percentile_approx("value", [0.499, 0.501], 10_000).alias("b"), F.count(F.lit(1)).alias("n"))
    rows = long.join(bounds, keys).select(*keys, "value", "n", F.col("b")[0].alias("low"), F.col("b")[1].alias("high"))
    below = rows.groupBy(*keys).agg(F.count_if(F.col("value") < F.col("low")).alias("below"))
    ranked = rows.where("value between low and high").withColumn("at", F.row_number().over(Window.partitionBy(*keys).orderBy("value")))
    at = F.col("at") + F.col("below")
    middle = ranked.join(below, keys).where((at == F.floor((F.col("n") + 1) / 2)) | (at == F.ceil((F.col("n") + 1) / 2))).groupBy(*keys).agg(F.avg("value").alias("median"))
    wide = middle.groupBy("fold").pivot("feature", names).agg(F.first("median")).withColumnsRenamed({n: f"median_{n}" for n in names})
    return nulls.join(wide, "fold", "left")


def imputed(marks: DataFrame, medians: DataFrame, names: list[str]) -> DataFrame:
    """Nulls become the fold's training median (0 if training has none); missing_<n> tells of it where training had nulls too."""
    out = marks.join(F.broadcast(medians), "fold")
    fill = {n: F.coalesce(F.col(n), F.col(f"median_{n}"), F.lit(0.0)) for n in names}
    flags = {f"missing_{n}": F.when(F.col(f"nulls_{n}") > 0, F.col(n).isNull().cast("double")).otherwise(0.0) for n in names}
    return out.withColumns(flags).withColumns(fill).drop(*[f"median_{n}" for n in names], *[f"nulls_{n}" for n in names])


def standardized(rows: DataFrame, names: list[str], target: str) -> DataFrame:
    """Columns less the training mean, over the population standard deviation of training (1 where that is 0)."""
    stats = rows.where(f"train_{target}").groupBy("fold").agg(*[F.avg(n).alias(f"avg_{n}") for n in names], *[F.stddev_pop(n).alias(f"sd_{n}") for n in names])
    out = rows.join(F.broadcast(stats), "fold")
    scaled = {n: (F.col(n) - F.col(f"avg_{n}")) / F.when(F.col(f"sd_{n}") > 0, F.col(f"sd_{n}")).otherwise(1.0) for n in names}
    return out.withColumns(scaled).drop(*[f"{p}_{n}" for n in names for p in ("avg", "sd")])


def baseline(marks: DataFrame, target: str) -> DataFrame:
    """Test rows with the baseline's prediction: the training share of 1 for a direction, else 0."""
    test = marks.where(f"test_{target}").select("fold", "symbol", "session_date", F.col(target).alias("actual"))
    if not target.startswith("direction"):
        return test.withColumn("prediction", F.lit(0.0))
    prior = marks.where(f"train_{target}").groupBy("fold").agg(F.avg(target).alias("prediction"))
    return test.join(F.broadcast(prior), "fold")


RANGES = 64  # of the values of one key, ranked apart


def average_ranks(tally: DataFrame, c: str, *keys: str, ranges: int = RANGES) -> DataFrame:
    """tally (a row per distinct value c of keys, with n, how many rows have it) with average_rank: the rank of its rows among all of the same keys, ties averaged, from 1.

    Sketched quantiles cut a key's values into ranges, and ranks are prefix sums of the ranges' counts plus those inside a range, so that no task holds all values of a key. A value
    has one row, so ties never meet. c and keys aren't null.
    """
    at = [k / ranges for k in range(1, ranges)]
    none = F.array().cast("array<double>")
    cuts = tally.groupBy(*keys).agg(F.coalesce(F.percentile_approx(c, at, 100 * ranges), none).alias("_cuts") if at else F.first(none).alias("_cuts"))
    rows = tally.join(cuts, [*keys]).withColumn("_range", F.size(F.filter("_cuts", lambda x: x < F.col(c)))).drop("_cuts")
    before = Window.rowsBetween(Window.unboundedPreceding, -1)
    parts = rows.groupBy(*keys, "_range").agg(F.sum("n").alias("_n"))
    parts = parts.select(*keys, "_range", F.coalesce(F.sum("_n").over(before.partitionBy(*keys).orderBy("_range")), F.lit(0)).alias("_ahead"))
    inside = F.coalesce(F.sum("n").over(before.partitionBy(*keys, "_range").orderBy(c)), F.lit(0))
    ranked = rows.withColumn("_inside", inside).join(parts, [*keys, "_range"])
    return ranked.withColumn("average_rank", F.col("_ahead") + F.col("_inside") + (F.col("n") + 1) / 2.0).drop("_range", "_inside", "_ahead")
