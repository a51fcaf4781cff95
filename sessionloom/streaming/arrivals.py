"""Structured Streaming entry points: arriving bar files, a quality gate, completed bars, and revisions."""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from sessionloom.functions.columns import order_key
from sessionloom.operators.quality import canonical, clean, quarantine, row_rules
from sessionloom.operators.sessions import final_minute, is_final, minute_of_day
from sessionloom.sources.store import publish_parts, replace_window, state


def arrivals(spark: SparkSession, path: str, schema: str, files_per_batch: int = 8) -> DataFrame:
    """Bar files as they arrive below path, a bounded number per batch."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).parquet(path)


def partial_bars(ticks: DataFrame, calendar: DataFrame) -> DataFrame:
    """What ticks (symbol, ts in local time, price, quantity, tick_id) say of the bars they belong to: one row per symbol, session_date and in_session.

    A tick is in its day's session if the day is open and the session isn't final yet; other ticks are kept apart. Ticks without ts are those of a null
    session_date, and in no session. Rows tell by their order keys which price is first and last, so that `merged` can add them up in any order.
    """
    at = order_key(micros=19, tick_id=18)
    rows = ticks.withColumns({"session_date": F.to_date("ts"), "micros": F.unix_micros("ts")})
    rows = rows.join(F.broadcast(calendar.select("session_date", "expected_open", "session_kind")), "session_date", "left")
    inside = F.coalesce(F.col("expected_open") & (minute_of_day("ts") < final_minute()), F.lit(False))
    rows = rows.withColumns({"in_session": inside, "at": at})
    return rows.groupBy("symbol", "session_date", "in_session").agg(
        F.min("at").alias("open_at"), F.min_by("price", "at").alias("open"), F.max("price").alias("high"), F.min("price").alias("low"), F.max("at").alias("close_at"),
        F.max_by("price", "at").alias("close"), F.sum("quantity").alias("volume"), F.count(F.lit(1)).alias("ticks"),
    )


def merged(partials: DataFrame) -> DataFrame:
    """Rows of partial_bars, of any number of batches, as one row per symbol, session_date and in_session."""
    return partials.groupBy("symbol", "session_date", "in_session").agg(
        F.min("open_at").alias("open_at"), F.min_by("open", "open_at").alias("open"), F.max("high").alias("high"), F.min("low").alias("low"), F.max("close_at").alias("close_at"),
        F.max_by("close", "close_at").alias("close"), F.sum("volume").alias("volume"), F.sum("ticks").alias("ticks"),
    )


def add_ticks_batch(batch: DataFrame, root: str, calendar: DataFrame, stream: str, number: int) -> None:
    """Batch `number` of a stream of ticks is added to the bars at root. A batch that was added before changes nothing; see revise_batch."""
    _change(batch.sparkSession, lambda: partial_bars(batch, calendar), root, stream, number, lambda old, new, span: merged(old.unionByName(new)))


def add_ticks(stream: DataFrame, root: str, calendar: DataFrame, checkpoint: str) -> StreamingQuery:
    """add_ticks_batch for every batch of a stream. Files may come in any order and however late: nothing waits for a watermark, and no tick is dropped."""
    return _each_batch(stream, checkpoint, lambda batch, known, number: add_ticks_batch(batch, root, calendar, known, number))


def completed_bars(spark: SparkSession, root: str, calendar: DataFrame, now: Column) -> DataFrame:
    """Bars of the sessions that are over at now (local time) by the exchange's calendar: symbol, session_date, open, high, low, close, volume.

    Those of a session that goes on are at root, but don't come out before its end: 16:00, or 21:30 for an evening or special one. Ticks that come
    later than that, but were in the session, are in the bar from then on. A root without ticks gives no rows.
    """
    folders = sorted(state(spark, root).folders.values())
    columns = ["symbol", "session_date", "open", "high", "low", "close", "volume"]
    if not folders:
        return spark.createDataFrame([], "symbol string, session_date date, open double, high double, low double, close double, volume long")
    over = F.broadcast(calendar.where(is_final(now)).select("session_date"))
    return spark.read.parquet(*folders).where("in_session").join(over, "session_date").select(*columns)


def gate(batch: DataFrame) -> DataFrame:
    """The row-local rules and repeated dates of the batch, without a calendar."""
    rows = canonical(batch).withColumn("session_date", F.to_date("ts"))
    copies = batch.groupBy("symbol", F.to_date("ts").alias("session_date")).agg(F.count(F.lit(1)).alias("_copies"))
    rows = rows.join(copies, ["symbol", "session_date"], "left")
    repeated = F.when(F.col("_copies") > 1, F.struct(F.lit("duplicate_date").alias("rule"), F.lit("error").alias("severity"), F.lit("Date comes more than once").alias("detail")))
    rows = rows.withColumn("issues", F.filter(F.array(*row_rules(calendar=False), repeated), lambda x: x.isNotNull())).drop("_copies")
    return rows.withColumn("bad", F.exists("issues", lambda x: x["severity"] == "error"))


def run_gate(stream: DataFrame, clean_path: str, quarantine_path: str, checkpoint: str) -> StreamingQuery:
    """Each batch goes to two tables by batch number; a repeated batch overwrites its own folder."""

    def write(batch: DataFrame, number: int) -> None:
        rows = gate(batch).persist()
        try:
            clean(rows).write.mode("overwrite").parquet(f"{clean_path}/batch={number}")
            quarantine(rows).write.mode("overwrite").parquet(f"{quarantine_path}/batch={number}")
        finally:
            rows.unpersist()

    return stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def _change(spark: SparkSession, made: Callable[[], DataFrame], root: str, stream: str, number: int, combine: Callable[[DataFrame, DataFrame, Row], DataFrame]) -> None:
    """Publish the table at root with what batch `number` of a stream makes of it: combine(old, made(), span) gives the new rows of the parts it touches.

    The table is kept by month, rows without a date in a part of their own (`undated`): only parts that the batch touches are written anew, the others stay where they
    are. The version's row of the log names stream and batch: one that was published before changes nothing, whatever other streams or whole tables were published since; one that
    failed before is made from the current version. Batches of one root are applied one after another.
    """
    now = state(spark, root)
    if number <= now.commits.get(stream, -1):
        return
    batch = made().persist()
    try:
        span = batch.agg(F.min("session_date").alias("a"), F.date_add(F.max("session_date"), 1).alias("b"), F.count_if(F.col("session_date").isNull()).alias("undated"), F.count(F.lit(1)).alias("n")).first()
        if not span["n"]:
            return
        first, last = (f"m{span['a']:%Y-%m}", f"m{span['b']:%Y-%m}") if span["a"] else ("", "")
        touched = {m: f for m, f in now.folders.items() if m == "all" or m == "undated" and span["undated"] or m != "undated" and first <= m <= last}
        old = spark.read.schema(batch.schema).parquet(*touched.values()) if touched else batch.limit(0)
        rows = combine(old, batch, span).withColumn("month", F.coalesce(F.date_format("session_date", "'m'yyyy-MM"), F.lit("undated")))
        publish_parts(rows, root, now, {m: f for m, f in now.folders.items() if m not in touched}, "month", (stream, number))
    finally:
        batch.unpersist()


def _each_batch(stream: DataFrame, checkpoint: str, change: Callable[[DataFrame, str, int], None]) -> StreamingQuery:
    """change(batch, stream, number) for every batch of a stream, which is known by the id that its checkpoint holds: a stream with a new checkpoint is another stream, and its rows count."""

    def apply(batch: DataFrame, number: int) -> None:
        change(batch, json.loads(batch.sparkSession.read.text(f"{checkpoint}/metadata").first()[0])["id"], number)

    return stream.writeStream.foreachBatch(apply).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def revise_batch(batch: DataFrame, root: str, keys: list[str], stream: str, number: int) -> None:
    """Batch `number` of a stream replaces its keys' rows within its own range of session dates, and those without a date by its own without one.

    A batch that was published before changes nothing, and only months that it touches are written anew (`_change`).
    """

    def replace(old: DataFrame, new: DataFrame, span: Row) -> DataFrame:
        if span["undated"]:
            old = old.withColumn("_undated", F.col("session_date").isNull())
            old = old.join(new.where("session_date is null").select(*keys, F.lit(True).alias("_undated")).distinct(), [*keys, "_undated"], "left_anti").select(*new.columns)
        return replace_window(old, new, keys, "session_date", F.lit(span["a"]).cast("date"), F.lit(span["b"]).cast("date"))

    _change(batch.sparkSession, lambda: batch, root, stream, number, replace)


def revise(stream: DataFrame, root: str, checkpoint: str, keys: list[str]) -> StreamingQuery:
    """revise_batch for every batch of a stream."""
    return _each_batch(stream, checkpoint, lambda batch, known, number: revise_batch(batch, root, keys, known, number))
