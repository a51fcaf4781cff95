"""Validation of landed bars: one issue row per rule that a row breaks, and quarantine of rows with errors."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from sessionloom.config import Quality
from sessionloom.functions.columns import bad_number, is_finite, to_number

RENAME = {"Open": "open", "High": "high", "Low": "low", "Close": "close", "Adj Close": "adj_close", "Volume": "volume", "Dividends": "dividends", "Stock Splits": "stock_splits"}
PRICES = ["open", "high", "low", "close"]
REQUIRED = [*PRICES, "adj_close", "volume"]
NUMERIC = [*REQUIRED, "dividends", "stock_splits"]
# fixed values: what published issue logs say, and the rules that it is said of
DISPOSITIONS = {
    "error": "quarantined", "session": "excluded_with_explicit_session_mask", "price_only": "retained_price_only; eligibility_masks_apply",
    "other": "retained_source_observation; no_automatic_repair",
}
SESSION_RULES = ["missing_session", "unusable_session", "stale_latest_bar"]
PRICE_ONLY_RULES = ["missing_adjusted_close", "missing_volume", "zero_volume"]
ISSUE = "struct<rule:string,severity:string,detail:string>"


def unexpected_columns(raw: DataFrame, known: list[str]) -> list[str]:
    return sorted(set(raw.columns) - set(known))


def canonical(raw: DataFrame) -> DataFrame:
    """Canonical names, absent columns as null, and each number beside its text as it came (column raw_<name>)."""
    out = raw.withColumnsRenamed(RENAME)
    absent = [c for c in NUMERIC if c not in out.columns]
    out = out.withColumns({c: F.lit(None).cast("string") for c in absent})
    out = out.withColumns({f"raw_{c}": F.col(c).cast("string") for c in NUMERIC})
    return out.withColumns({c: to_number(F.col(f"raw_{c}")) for c in NUMERIC}).withColumn("missing", F.array(*[F.lit(c) for c in REQUIRED if c in absent]).cast("array<string>"))


def _issue(hit: Column, rule: str, severity: str = "error", detail: str = "") -> Column:
    return F.when(F.coalesce(hit, F.lit(False)), F.struct(F.lit(rule).alias("rule"), F.lit(severity).alias("severity"), F.lit(detail).alias("detail")))


def row_rules(calendar: bool = True) -> list[Column]:
    """Issues of a row by itself. Needs canonical(), ts, session_date, kind, start, end (exclusive), and expected_open if calendar."""
    c = F.col
    rules = [
        _issue(c("session_date").isNull(), "invalid_date"),
        _issue(c("ts") != F.date_trunc("day", "ts"), "non_daily_timestamp"),
        _issue((c("session_date") < c("start")) | (c("session_date") >= c("end")), "date_out_of_range"),
        *[_issue(F.array_contains("missing", x), "missing_column", detail=x) for x in REQUIRED],
        *[_issue(bad_number(c(f"raw_{x}")), "invalid_numeric", detail=x) for x in NUMERIC],
        *[_issue(c(x).isNull() | (c(x) <= 0), "invalid_price", detail=x) for x in PRICES],
        _issue((c("raw_adj_close").try_cast("double").isNotNull() & ~is_finite(c("raw_adj_close").try_cast("double"))) | (c("adj_close") <= 0), "invalid_adjusted_close"),
        _issue(c("adj_close").isNull(), "missing_adjusted_close", "warning", "No label can be made"),
        _issue((c("high") < F.greatest(*PRICES)) | (c("low") > F.least(*PRICES)), "invalid_ohlc_order"),
        _issue((c("raw_volume").try_cast("double").isNotNull() & c("volume").isNull()) | (c("volume") < 0) | (c("volume") >= 2.0**63) | (c("volume") % 1 != 0), "invalid_volume"),
        _issue((c("kind") == "equity") & c("volume").isNull(), "missing_volume", "warning"),
        _issue((c("kind") == "equity") & (c("volume") == 0), "zero_volume", "warning"),
        _issue((c("dividends") > 0) | (c("stock_splits") > 0), "corporate_action", "info", "Kept as it came"),
        *[_issue(c(x) < 0, "invalid_corporate_action", detail=x) for x in ("dividends", "stock_splits")],
    ]
    return rules + [_issue(~c("expected_open"), "verified_closed_session", detail="Not a session")] * calendar


def checked(raw: DataFrame, calendar: DataFrame) -> DataFrame:
    """canonical(raw) with issues (array of structs) and bad, whether one of them is an error.

    raw: symbol, kind, source_row, ts, start, end and the provider's columns. A repeated date condemns all its rows.
    """
    rows = canonical(raw).withColumn("session_date", F.to_date("ts"))
    rows = rows.join(F.broadcast(calendar.select("session_date", "expected_open")), "session_date", "left")
    copies = F.count(F.lit(1)).over(Window.partitionBy("symbol", "session_date"))
    repeated = _issue(F.col("session_date").isNotNull() & (copies > 1), "duplicate_date", detail="Date comes more than once")
    rows = rows.withColumn("issues", F.filter(F.array(*row_rules(), repeated), lambda x: x.isNotNull()))
    return rows.withColumn("bad", F.exists("issues", lambda x: x["severity"] == "error"))


BARS = ["symbol", "kind", "source_row", "session_date", *PRICES, "adj_close", "volume", "dividends", "stock_splits"]


def clean(rows: DataFrame) -> DataFrame:
    """Rows without errors, with their flags; a closed day is an error, so none of them needs review."""
    return rows.where("not bad").select(*BARS).withColumns({
        "volume": F.col("volume").cast("long"), "price_valid": F.lit(True), "label_price_available": F.col("adj_close").isNotNull(), "calendar_review_required": F.lit(False),
    })


def quarantine(rows: DataFrame) -> DataFrame:
    """Rows with errors and the sorted names of the rules."""
    errors = F.transform(F.filter("issues", lambda x: x["severity"] == "error"), lambda x: x["rule"])
    return rows.where("bad").select(*BARS, F.array_join(F.array_sort(F.array_distinct(errors)), ",").alias("reasons"))


def _row_issue(rule: str, severity: str, detail: str) -> list[Column]:
    return ["symbol", F.col("source_row").cast("long"), "session_date", F.lit(rule).alias("rule"), F.lit(severity).alias("severity"), F.lit(detail).alias("detail")]


def series_issues(good: DataFrame, config: Quality = Quality()) -> DataFrame:
    """Warnings that compare retained bars with each other; these may lie on either side of a gap."""
    w = Window.partitionBy("symbol").orderBy("session_date")
    before = F.lag("adj_close").over(w)
    trail = w.rowsBetween(-config.spike_window, -1)
    volume = F.col("volume").cast("double")
    base = F.when(F.count(volume).over(trail) >= config.spike_least, F.percentile(volume, 0.5).over(trail))
    rows = good.withColumns({"_change": F.abs(F.col("adj_close") / before - 1), "_base": base})
    large = rows.where(F.col("_change") > config.large_return).select(*_row_issue("large_observed_return", "warning", "Change from the bar before, whatever lies between"))
    spike = rows.where((F.col("kind") == "equity") & (F.col("_base") > 0) & (volume > F.col("_base") * config.spike_multiple)).select(*_row_issue("volume_spike", "warning", "Above the median of recent bars"))
    return large.unionByName(spike)


def session_issues(rows: DataFrame, calendar: DataFrame) -> DataFrame:
    """Expected sessions without a usable bar, and symbols whose last usable bar is before the last session."""
    opens = calendar.where("expected_open").select("session_date")
    requests = rows.groupBy("symbol").agg(F.max("start").alias("start"), F.max("end").alias("end"))
    grid = requests.join(F.broadcast(opens), (F.col("session_date") >= F.col("start")) & (F.col("session_date") < F.col("end"))).select("symbol", "session_date")
    seen = rows.groupBy("symbol", "session_date").agg(F.bool_or(~F.col("bad")).alias("usable"))
    state = grid.join(seen, ["symbol", "session_date"], "left")
    rule = F.when(F.col("usable").isNull(), "missing_session").otherwise("unusable_session")
    none = F.lit(None).cast("long").alias("source_row")
    absent = state.where("coalesce(usable, false) = false").select("symbol", none, "session_date", rule.alias("rule"), F.lit("warning").alias("severity"), F.lit("Open day without a usable bar").alias("detail"))
    usable = rows.groupBy("symbol").agg(F.max(F.when(~F.col("bad"), F.col("session_date"))).alias("usable"))
    stale = grid.groupBy("symbol").agg(F.max("session_date").alias("session_date")).join(usable, "symbol").where("usable is null or usable < session_date")
    stale = stale.select("symbol", none, "session_date", F.lit("stale_latest_bar").alias("rule"), F.lit("warning").alias("severity"), F.lit("Last open day has no usable bar").alias("detail"))
    return absent.unionByName(stale)


def order_issues(rows: DataFrame) -> DataFrame:
    """Symbols whose rows weren't in order of time, by source row."""
    w = Window.partitionBy("symbol").orderBy("source_row")
    moved = rows.select("symbol", (F.lag("ts").over(w) > F.col("ts")).alias("back")).groupBy("symbol").agg(F.bool_or("back").alias("back")).where("back")
    return moved.select("symbol", F.lit(None).cast("long").alias("source_row"), F.lit(None).cast("date").alias("session_date"), F.lit("unsorted_dates").alias("rule"), F.lit("info").alias("severity"), F.lit("Rows came out of order").alias("detail"))


def column_issues(raw: DataFrame, known: list[str]) -> DataFrame:
    """Columns that no rule knows, one issue per symbol."""
    extra = unexpected_columns(raw, known)
    rows = raw.select("symbol").distinct() if extra else raw.select("symbol").where("false")
    return rows.select("symbol", F.lit(None).cast("long").alias("source_row"), F.lit(None).cast("date").alias("session_date"), F.lit("unexpected_columns").alias("rule"), F.lit("warning").alias("severity"), F.lit(", ".join(extra)).alias("detail"))


def row_issues(rows: DataFrame) -> DataFrame:
    return rows.select("symbol", "source_row", "session_date", F.explode("issues").alias("i")).select("symbol", F.col("source_row").cast("long"), "session_date", "i.rule", "i.severity", "i.detail")


def disposition(issues: DataFrame) -> DataFrame:
    """issues with what became of them, by severity and rule."""
    value = (
        F.when(F.col("severity") == "error", DISPOSITIONS["error"]).when(F.col("rule").isin(SESSION_RULES), DISPOSITIONS["session"])
        .when(F.col("rule").isin(PRICE_ONLY_RULES), DISPOSITIONS["price_only"]).otherwise(DISPOSITIONS["other"])
    )
    return issues.withColumn("disposition", value)


def issue_log(rows: DataFrame, calendar: DataFrame, config: Quality = Quality()) -> DataFrame:
    out = row_issues(rows).unionByName(series_issues(clean(rows), config)).unionByName(session_issues(rows, calendar)).unionByName(order_issues(rows))
    return disposition(out)


def summary(rows: DataFrame, aligned: DataFrame) -> DataFrame:
    """Per symbol: raw, clean and quarantined rows, missing and excluded sessions, usable windows, latest usable bar."""
    raw = rows.groupBy("symbol").agg(F.count(F.lit(1)).alias("n_raw"), F.count_if(~F.col("bad")).alias("n_clean"), F.count_if("bad").alias("n_quarantined"), F.max(F.when(~F.col("bad"), F.col("session_date"))).alias("latest_usable"))
    seen = rows.select("symbol", "session_date").distinct().withColumn("seen", F.lit(True))
    grid = aligned.join(seen, ["symbol", "session_date"], "left").groupBy("symbol").agg(
        F.count_if(F.col("gap") & F.col("seen").isNull()).alias("missing_sessions"), F.count_if("gap").alias("excluded_sessions"),
        F.count_if("target_1d_eligible").alias("eligible_1d"), F.count_if("target_5d_eligible").alias("eligible_5d"),
    )
    return raw.join(grid, "symbol", "left")


def conservation(raw: DataFrame, clean_rows: DataFrame, quarantined: DataFrame) -> DataFrame:
    """Per symbol: source rows of raw that neither output has (lost), and rows of the outputs beyond one for each (extra)."""
    key = ["symbol", "source_row"]
    tagged = raw.select(*key, F.lit(1).alias("r"), F.lit(0).alias("o"))
    for out in (clean_rows, quarantined):
        tagged = tagged.unionByName(out.select(*key, F.lit(0).alias("r"), F.lit(1).alias("o")))
    one = tagged.groupBy(*key).agg(F.sum("r").alias("r"), F.sum("o").alias("o"))
    return one.groupBy("symbol").agg(F.sum(F.greatest(F.col("r") - F.col("o"), F.lit(0))).alias("lost"), F.sum(F.greatest(F.col("o") - F.col("r"), F.lit(0))).alias("extra"))


def invariant_violations(aligned: DataFrame) -> DataFrame:
    """One row of counts that must be zero for aligned bars."""
    one = aligned.groupBy("symbol", "session_date").agg(
        F.count(F.lit(1)).alias("n"), F.count_if(F.col("price_valid") & ~(F.least(*PRICES) > 0)).alias("p"), F.count_if(F.col("gap") & F.coalesce(*PRICES).isNotNull()).alias("f"),
        F.count_if(F.col("target_5d_eligible") & ~F.col("target_1d_eligible")).alias("m"),
    )
    return one.agg(F.sum(F.col("n") - 1).alias("repeated"), F.sum("p").alias("bad_prices"), F.sum("f").alias("filled_gaps"), F.sum("m").alias("bad_masks"))


def run_gate(symbols: DataFrame, universe: DataFrame) -> DataFrame:
    """One row: instruments missing from the run, instruments it doesn't know, and whether it may go on. symbols: symbol, status."""
    both = symbols.select("symbol", "status", F.lit(1).alias("r")).join(universe.select("symbol", F.lit(1).alias("u")), "symbol", "full_outer")
    counts = both.agg(F.count_if(F.col("r").isNull()).alias("missing"), F.count_if(F.col("u").isNull()).alias("unknown"), F.count_if(F.col("status") != "success").alias("failed"))
    return counts.withColumn("may_run", (F.col("missing") + F.col("unknown") + F.col("failed")) == 0)


def expectations(table: DataFrame, rules: dict[str, Column]) -> DataFrame:
    """rule, violations: rows for which a rule that must hold is false (null counts as holding, as in SQL constraints)."""
    counts = table.agg(*[F.count_if(~rule).alias(name) for name, rule in rules.items()])
    return counts.unpivot([], list(rules), "rule", "violations")
