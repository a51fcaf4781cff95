"""Versioned tables: which run is current, how a new snapshot replaces an old one, and whether two tables agree."""

from __future__ import annotations

import uuid
from dataclasses import dataclass
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def latest_complete_run(manifest: DataFrame, universe: DataFrame) -> DataFrame:
    """run_id of the run that finished last among those that succeeded for every instrument. manifest: run_id, symbol, status, finished_at."""
    n = universe.agg(F.count_distinct("symbol").alias("n"))
    known = manifest.join(universe.select("symbol", F.lit(True).alias("known")), "symbol", "left")
    runs = known.groupBy("run_id").agg(
        F.bool_and(F.col("status") == "success").alias("ok"), F.bool_and(F.coalesce("known", F.lit(False))).alias("all_known"), F.count_distinct("symbol").alias("have"), F.max("finished_at").alias("finished_at"),
    )
    good = runs.join(F.broadcast(n), F.col("have") == F.col("n")).where("ok and all_known")
    return good.agg(F.max_by("run_id", "finished_at").alias("run_id"), F.max("finished_at").alias("finished_at"))


def run_status(manifest: DataFrame) -> DataFrame:
    return manifest.groupBy("run_id").agg(F.when(F.bool_and(F.col("status") == "success"), "success").otherwise("partial_failure").alias("status"))


def insert_absent(old: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """old and the rows of new whose key it doesn't have."""
    return old.unionByName(new.join(old.select(*keys), keys, "left_anti"))


def replace_window(old: DataFrame, new: DataFrame, keys: list[str], date: str, start: Column, end: Column) -> DataFrame:
    """old without the rows of new's keys in [start, end), and new."""
    inside = (F.col(date) >= start) & (F.col(date) < end)
    marked = old.withColumn("_inside", inside)
    gone = new.select(*keys).distinct().withColumn("_inside", F.lit(True))
    return marked.join(gone, [*keys, "_inside"], "left_anti").drop("_inside").unionByName(new)


def load_once(loaded: DataFrame, batch: DataFrame, active: DataFrame | None = None, dataset: str = "dataset_id") -> DataFrame:
    """Rows of batch that a first load adds: none of a dataset that is there already.

    active (one row or none: the dataset in use): a row of an older dataset, loaded once but not in use now, is an error when it is read, since what was
    loaded after it may have replaced its windows.
    """
    known = loaded.select(dataset).distinct().withColumn("_loaded", F.lit(True))
    rows = batch.join(known, dataset, "left")
    if active is not None:
        rows = rows.join(F.broadcast(active.select(F.col(dataset).alias("_active")).limit(1)), how="left")
        old = F.col("_loaded") & ~F.coalesce(F.col(dataset) == F.col("_active"), F.lit(False))
        rows = rows.withColumn("_loaded", F.when(old, F.raise_error(F.lit("an older dataset can't be loaded again")).cast("boolean")).otherwise(F.col("_loaded")))
    return rows.where("_loaded is null").drop("_loaded", "_active")


def current(table: DataFrame, pointer: DataFrame, dataset: str = "dataset_id") -> DataFrame:
    """Rows of the active dataset. pointer: one row."""
    return table.join(F.broadcast(pointer.select(dataset)), dataset)


def readable(spark: SparkSession, path: str) -> bool:
    try:
        spark.read.format("binaryFile").load(path)
        return True
    except AnalysisException as e:
        if e.getCondition() == "PATH_NOT_FOUND":
            return False
        raise


STEPS = "number long, part string, folder string, stream string, batch long, epoch int"
EPOCH = 100  # versions of a folder of the log
RANGES = 4096  # of keys, digested apart


@dataclass
class State:
    """The current version: its number (-1: none yet), the folder of each of its parts, and the last batch that each stream has committed."""

    number: int
    folders: dict[str, str]
    commits: dict[str, int]


def _append(spark: SparkSession, root: str, rows: list[tuple]) -> None:
    """Add one version's rows. Every version says all, so epochs before the last but one are emptied, and the log's files stay few."""
    number = rows[0][0]
    own, kind = max(0, number) // EPOCH, STEPS.rpartition(",")[0]
    spark.createDataFrame(rows, kind).coalesce(1).write.mode("append").parquet(f"{root}/_log/epoch={own}")
    if number > 0 and number % EPOCH == 0 and own > 1:
        spark.createDataFrame([], kind).coalesce(1).write.mode("overwrite").parquet(f"{root}/_log/epoch={own - 2}")


def state(spark: SparkSession, root: str) -> State:
    """The log is only added to, one file per version, and the largest number counts: a failure at any time leaves the version before. The log begins before
    the first version is written; versions without a log are an error, not an empty store.
    """
    if not readable(spark, f"{root}/_log"):
        if readable(spark, f"{root}/versions"):
            raise RuntimeError(f"{root} has versions, but its log is gone")
        _append(spark, root, [(-1, None, None, None, None)])
    log = spark.read.schema(STEPS).parquet(f"{root}/_log")
    rows = log.join(log.agg(F.max("number").alias("number")), "number").collect()
    return State(rows[0]["number"], {r["part"]: r["folder"] for r in rows if r["part"] is not None}, {r["stream"]: r["batch"] for r in rows if r["stream"] is not None})


def published_state(spark: SparkSession, root: str) -> tuple[int, dict[str, str]]:
    """Number of the current version (-1: none yet) and the folder of each of its parts."""
    now = state(spark, root)
    return now.number, now.folders


def publish_parts(df: DataFrame, root: str, now: State, stay: dict[str, str], part: str | None = None, commit: tuple[str, int] | None = None) -> None:
    """Make the version after `now` of df, by the values of the column `part` if named, and of parts that stay, by their folders. Every attempt writes to a folder of its own.

    commit: the stream and its batch that df is; the log's row of it comes with the version's.
    """
    spark, number = df.sparkSession, now.number + 1
    folder = f"{root}/versions/{number}-{uuid.uuid4().hex}"
    (df.write.partitionBy(part) if part else df.write).parquet(folder)
    made = {r[part]: f"{folder}/{part}={r[part]}" for r in spark.read.parquet(folder).select(F.col(part).cast("string").alias(part)).distinct().collect()} if part and not df.isEmpty() else {} if part else {"all": folder}
    if None in made:
        raise ValueError(f"rows without a {part} can't be published")
    rows = [(number, k, f, None, None) for k, f in (stay | made).items()] + [(number, None, None, s, b) for s, b in (now.commits | dict([commit] if commit else [])).items()]
    _append(spark, root, rows or [(number, None, None, None, None)])


def publish(df: DataFrame, root: str) -> None:
    """Write a whole table as the next version, and then the log's row of it."""
    publish_parts(df, root, state(df.sparkSession, root), {})


def published(spark: SparkSession, root: str) -> DataFrame:
    folders = sorted(published_state(spark, root)[1].values())
    if not folders:
        raise RuntimeError(f"nothing is published at {root}")
    return spark.read.parquet(*folders)


def orphans(fact: DataFrame, dimension: DataFrame, key: str) -> DataFrame:
    """One row: facts whose key the dimension hasn't, and repeated keys of the dimension."""
    facts = fact.join(dimension.select(key), key, "left_anti").agg(F.count(F.lit(1)).alias("orphans"))
    dims = dimension.groupBy(key).count().agg(F.coalesce(F.sum(F.col("count") - 1), F.lit(0)).alias("repeated"))
    return facts.crossJoin(dims)


def _range_digests(rows: DataFrame, side: str) -> DataFrame:
    """By range: rows, and sum and xor of their hashes, which don't depend on order and add up map-side. rows: _range and what is hashed."""
    h = F.xxhash64(*[c for c in rows.columns if c != "_range"])
    return rows.groupBy("_range").agg(F.struct(F.count(F.lit(1)).alias("n"), F.sum(h.cast("decimal(38,0)")).alias("sum"), F.bit_xor(h).alias("xor")).alias(side))


def reconcile(left: DataFrame, right: DataFrame, keys: list[str], values: dict[str, float], ranges: int = RANGES) -> DataFrame:
    """One row: keys only on one side (left_only, right_only), and matching keys of which a value differs by more than its tolerance (different) or none does (equal).

    Rows are dealt into ranges by a hash of their keys, and each side's ranges are digested; only ranges whose digests differ are joined row by row, so equal tables shuffle
    digests alone. Both sides have the same types, and keys aren't null and don't repeat.
    """
    a, b = (df.select(*keys, *values).withColumn("_range", F.pmod(F.xxhash64(*keys), F.lit(ranges)).cast("int")) for df in (left, right))
    both = _range_digests(a, "one").join(_range_digests(b, "two"), "_range", "full_outer")
    # at most `ranges` rows, whatever the tables
    both = both.select("_range", F.coalesce(F.col("one") == F.col("two"), F.lit(False)).alias("same"), "one.n")
    other = F.broadcast(both.where(~F.col("same")).select("_range"))
    a, b = (df.join(other, "_range").select(*keys, F.struct(*values).alias(c)) for df, c in ((a, "a"), (b, "b")))
    differs = reduce(lambda x, y: x | y, [
        F.col(f"a.{v}").isNull() != F.col(f"b.{v}").isNull() if not tolerance else (F.col(f"a.{v}").isNull() != F.col(f"b.{v}").isNull()) | F.coalesce(F.abs(F.col(f"a.{v}") - F.col(f"b.{v}")) > tolerance, F.lit(False))
        for v, tolerance in values.items()
    ])
    joined = a.join(b, keys, "full_outer")
    left_only, right_only = F.col("b").isNull(), F.col("a").isNull()
    counts = joined.agg(F.count_if(left_only).alias("left_only"), F.count_if(right_only).alias("right_only"), F.count_if(~left_only & ~right_only & differs).alias("different"), F.count_if(~left_only & ~right_only & ~differs).alias("equal"))
    same = both.where("same").agg(F.coalesce(F.sum("n"), F.lit(0)).alias("_same"))
    return counts.join(F.broadcast(same)).select("left_only", "right_only", "different", (F.col("equal") + F.col("_same")).alias("equal"))


def same_set(a: DataFrame, b: DataFrame) -> DataFrame:
    """One row: rows that only one of two tables has."""
    return a.exceptAll(b).agg(F.count(F.lit(1)).alias("only_left")).crossJoin(b.exceptAll(a).agg(F.count(F.lit(1)).alias("only_right")))
