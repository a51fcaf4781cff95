"""Series too long for a task: running values by buckets of time, and features by slices of a run."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from sessionloom.config import Features
from sessionloom.functions.recursive import BLOCK
from sessionloom.operators.features import KEYS, feature_table, history, run_features
from sessionloom.sources.scratch import stored

ROWS = 1 << 16  # of a run that a slice makes features of


def running(rows: DataFrame, keys: list[str], order: str, bucket: Column, sums: dict[str, Column], maxima: dict[str, Column] | None = None) -> DataFrame:
    """rows with running sums and maxima by name, over rows of the same keys up to this one by `order`; a sum without values is 0, a maximum null.

    bucket never falls as order grows. A task has the rows of one key and bucket; the totals of a key's earlier buckets, a row each, are added to them. rows is read
    twice. Keys, order and bucket aren't null, and order doesn't repeat within a key, as in every aligned panel.
    """
    made = {**{n: (F.sum, c) for n, c in sums.items()}, **{n: (F.max, c) for n, c in (maxima or {}).items()}}
    rows = rows.withColumns({"_bucket": bucket, **{f"_of_{n}": c for n, (_, c) in made.items()}})
    totals = rows.groupBy(*keys, "_bucket").agg(*[f(f"_of_{n}").alias(f"_all_{n}") for n, (f, _) in made.items()])
    earlier = Window.partitionBy(*keys).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    carried = totals.select(*keys, "_bucket", *[f(f"_all_{n}").over(earlier).alias(f"_all_{n}") for n, (f, _) in made.items()])
    here = Window.partitionBy(*keys, "_bucket").orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    out = rows.join(carried, [*keys, "_bucket"]).withColumns({n: f(f"_of_{n}").over(here) for n, (f, _) in made.items()})
    out = out.withColumns({n: F.coalesce(F.col(n), F.lit(0)) + F.coalesce(F.col(f"_all_{n}"), F.lit(0)) for n in sums} | {n: F.greatest(n, f"_all_{n}") for n in maxima or {}})
    return out.drop("_bucket", *[f"{p}{n}" for n in made for p in ("_of_", "_all_")])


def segments(aligned: DataFrame, bucket: Column) -> DataFrame:
    """aligned with segment_id, the running count of rows that aren't eligible, however long a series is."""
    return running(aligned.drop("segment_id"), ["symbol"], "session_date", bucket, {"segment_id": F.when(F.col("feature_eligible"), 0).otherwise(1)})


def sliced_features(aligned: DataFrame, bucket: Column, config: Features = Features(), rows: int = ROWS) -> DataFrame:
    """The table that `features` gives, for series of any length: bars of a minute or of a tick, say.

    A run is cut into slices of `rows` rows (a multiple of 64), each worked on apart with the `history` before it: some 1,300 rows, within which frames
    end and recursions forget. So a task never has more than rows + history rows of a run, and values are those of the whole run. bucket (see `running`) numbers
    the rows; segment_id is made here. For short series `features` does the same with fewer shuffles.
    """
    if rows <= 0 or rows % BLOCK:
        raise ValueError(f"a slice has a multiple of {BLOCK} rows")
    eligible = F.col("feature_eligible")
    table = stored(aligned.drop("segment_id"), "panel")
    timed = running(table, ["symbol"], "session_date", bucket, {"segment_id": F.when(eligible, 0).otherwise(1)}, {"available_at": F.col("observed_at")})
    timed = stored(timed.withColumn("available_at", F.when(eligible, F.col("available_at"))), "timed")
    run = running(timed.where(eligible), KEYS, "session_date", bucket, {"_pos": F.lit(1)}).withColumn("_pos", F.col("_pos") - 1)
    own, last = F.expr(f"_pos div {rows}"), F.expr(f"(_pos + {history(config)}) div {rows}")
    parts = run.withColumn("_slice", F.explode(F.sequence(own, last))).withColumn("_own", F.col("_slice") == own)
    return feature_table(timed, run_features(parts, config, "_slice"), config)
