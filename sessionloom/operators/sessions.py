"""The session calendar, and bars aligned to it without filling a gap."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window, WindowSpec


def by_symbol() -> WindowSpec:
    return Window.partitionBy("symbol").orderBy("session_date")


def so_far() -> WindowSpec:
    return by_symbol().rowsBetween(Window.unboundedPreceding, 0)


def days(first: DataFrame) -> DataFrame:
    """session_date for every day from `start` to before `end`, columns of a one-row table."""
    return first.select(F.explode(F.sequence("start", F.date_sub("end", 1))).alias("session_date"))


def make_calendar(all_days: DataFrame, annual: DataFrame, closed: DataFrame, extra_open: DataFrame, extra_closed: DataFrame, version: str) -> DataFrame:
    """One row per day: session_date, expected_open, session_kind, source, calendar_version.

    annual: year, muhurat_date, source. closed: session_date of each year's closed days. extra_open, extra_closed: session_date, url; the latter
    wins. A day is open on weekdays that aren't closed; the evening session of the year is open whatever the day.
    """
    opened = F.broadcast(extra_open.select("session_date", F.col("url").alias("open_url")))
    shut = F.broadcast(extra_closed.select("session_date", F.col("url").alias("closed_url")))
    out = all_days.withColumn("year", F.year("session_date")).join(F.broadcast(annual), "year", "left").join(F.broadcast(closed.withColumn("is_closed", F.lit(True))), "session_date", "left")
    out = out.join(opened, "session_date", "left").join(shut, "session_date", "left")
    weekend, evening = F.weekday("session_date") > 4, F.col("session_date") == F.col("muhurat_date")
    regular = ~weekend & F.col("is_closed").isNull()
    kind = (
        F.when(F.col("closed_url").isNotNull(), "closed").when(evening, "muhurat")
        .when(F.col("open_url").isNotNull(), F.when(weekend, "special").otherwise("regular")).when(regular, "regular").otherwise("closed")
    )
    return out.select("session_date", (kind != "closed").alias("expected_open"), kind.alias("session_kind"), F.coalesce("closed_url", "open_url", "source").alias("source"), F.lit(version).alias("calendar_version"))


def uncovered(requests: DataFrame, coverage: DataFrame) -> DataFrame:
    """Requests (start, end) that are empty or reach outside coverage (first, last, end exclusive): none may be served."""
    return requests.join(F.broadcast(coverage)).where("start >= end or start < first or end > last").select(*requests.columns)


def align(clean: DataFrame, calendar: DataFrame) -> DataFrame:
    """Every symbol on every open session. Gaps are rows of nulls with masks; each row tells whether the next h sessions are usable.

    A row with no usable price raises segment_id, so that it shares the id of the valid run after it.
    """
    grid = clean.select("symbol").distinct().crossJoin(F.broadcast(calendar.where("expected_open").select("session_date")))
    out = grid.join(clean, ["symbol", "session_date"], "left")
    valid = F.coalesce("price_valid", F.lit(False)) if "price_valid" in clean.columns else F.col("close").isNotNull()
    out = out.withColumn("price_valid", valid).withColumn("gap", ~F.col("price_valid"))
    out = out.withColumn("feature_eligible", F.col("price_valid") & F.col("adj_close").isNotNull())
    eligible = F.col("feature_eligible")
    masks = {
        "volume_feature_eligible": eligible & F.coalesce(F.col("volume") > 0, F.lit(False)),
        "gap_disposition": F.when(F.col("gap"), "excluded_no_imputation").otherwise(""),
        "segment_id": F.sum(F.when(eligible, 0).otherwise(1)).over(so_far()),
    }
    for h in (1, 5):
        masks[f"target_{h}d_eligible"] = horizon_eligible(eligible, h)
    return out.withColumns(masks)


def horizon_eligible(eligible: Column, h: int) -> Column:
    """True where this session and the next h all are eligible; false past the end."""
    frame = by_symbol().rowsBetween(0, h)
    return F.bool_and(eligible).over(frame) & (F.count(F.lit(1)).over(frame) == h + 1)


def segment_age(aligned: DataFrame) -> DataFrame:
    """aligned with segment_age: 1, 2, ... in a valid run, 0 on gaps."""
    run = Window.partitionBy("symbol", "segment_id", "feature_eligible").orderBy("session_date")
    return aligned.withColumn("segment_age", F.when(F.col("feature_eligible"), F.row_number().over(run)).otherwise(0).cast("long"))


def available_at(observed: Column, valid: Column) -> Column:
    """Latest observation so far, on valid rows."""
    return F.when(valid, F.max(observed).over(so_far()))


def gaps(aligned: DataFrame) -> DataFrame:
    return aligned.where("gap").select("symbol", "session_date", "gap_disposition")


def final_minute() -> Column:
    """Minute of the day from which on the bars of a calendar's session are final: 16:00, or 21:30 for an evening or special session."""
    return F.when(F.col("session_kind").isin("muhurat", "special"), 21 * 60 + 30).otherwise(16 * 60)


def minute_of_day(moment: Column | str) -> Column:
    return F.hour(moment) * 60 + F.minute(moment)


def is_final(now: Column) -> Column:
    """Whether a row of the calendar is a session whose bars are final at now (local time)."""
    today = F.to_date(now)
    return F.col("expected_open") & ((F.col("session_date") < today) | (F.col("session_date") == today) & (minute_of_day(now) >= final_minute()))


def expected_session(calendar: DataFrame, moments: DataFrame) -> DataFrame:
    """For each moment (column now, local time): the latest open session whose bars are final.

    Those of the day itself count from 16:00 on, or 21:30 after an evening or special session; 14 days back are looked at. Null: none.
    """
    local = moments.select("now", F.to_date("now").alias("today"))
    near = local.join(F.broadcast(calendar), (F.col("session_date") <= F.col("today")) & (F.col("session_date") >= F.date_sub("today", 14)), "left")
    return near.groupBy("now").agg(F.max(F.when(is_final(F.col("now")), F.col("session_date"))).alias("expected_session"))


def is_fresh(latest: DataFrame, expected: Column) -> DataFrame:
    """One row: whether the latest_usable of every instrument reaches the expected session."""
    return latest.agg(F.bool_and(F.coalesce(F.col("latest_usable") >= expected, F.lit(False))).alias("fresh"))


def later_session(calendar: DataFrame, h: int) -> DataFrame:
    """session_date and the h-th open session after it; null past the calendar."""
    opens = calendar.where("expected_open").select("session_date")
    return opens.withColumn("target_date", F.lead("session_date", h).over(Window.orderBy("session_date")))


def series_violations(rows: DataFrame) -> DataFrame:
    """Per symbol: repeated sessions, eligible rows whose prices aren't finite and positive, eligible rows without observation time."""
    counted = rows.groupBy("symbol", "session_date").agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if(F.col("feature_eligible") & F.coalesce(~((F.least("open", "high", "low", "close", "adj_close") > 0) & (F.greatest("open", "high", "low", "close", "adj_close") < float("inf"))), F.lit(True))).alias("bad"),
        F.count_if(F.col("feature_eligible") & F.col("observed_at").isNull()).alias("unobserved"),
    )
    return counted.groupBy("symbol").agg(F.sum(F.col("n") - 1).alias("repeated"), F.sum("bad").alias("bad_prices"), F.sum("unobserved").alias("unobserved"))


def recheck(gap_rows: DataFrame, second: DataFrame) -> DataFrame:
    """Status of each gap against a second snapshot: candidate_found, still_invalid or still_missing."""
    prices = ("open", "high", "low", "close", "adj_close")
    invalid = F.lit(False)
    for c in prices:
        invalid = invalid | F.coalesce(F.col(c) <= 0, F.lit(True))
    seen = second.groupBy("symbol", "session_date").agg(F.count(F.lit(1)).alias("n"), F.bool_or(invalid).alias("invalid"))
    status = F.when(F.coalesce(F.col("n"), F.lit(0)) != 1, "still_missing").when(F.col("invalid"), "still_invalid").otherwise("candidate_found")
    return gap_rows.join(seen, ["symbol", "session_date"], "left").select("symbol", "session_date", status.alias("status"))


def closeout(gap_rows: DataFrame, rechecked: DataFrame) -> DataFrame:
    """One row of what must be zero before gaps are closed, and the totals."""
    keys = ["symbol", "session_date"]
    both = gap_rows.select(*keys, F.lit(1).alias("g"), F.lit(0).alias("r"), F.lit(None).cast("string").alias("status")).unionByName(rechecked.select(*keys, F.lit(0).alias("g"), F.lit(1).alias("r"), "status"))
    one = both.groupBy(*keys).agg(F.sum("g").alias("g"), F.sum("r").alias("r"), F.count_if(F.col("status") == "candidate_found").alias("found"))
    return one.agg(
        F.sum("g").alias("gaps"), F.sum("r").alias("rechecked"), F.count_if((F.col("g") > 0) & (F.col("r") == 0)).alias("not_rechecked"),
        F.count_if((F.col("g") == 0) & (F.col("r") > 0)).alias("not_gaps"), F.count_if(F.col("r") > 1).alias("rechecked_twice"), F.sum("found").alias("candidates"),
    )
