"""Queries on sources, sinks, projections, validation and calendars."""

from __future__ import annotations

from functools import reduce

from pyspark.errors import SparkRuntimeException
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from sessionloom.functions import columns as C
from sessionloom.operators import quality as Q
from sessionloom.operators import sessions as S
from sessionloom.operators import slices as SL
from sessionloom.plans import fixtures as X
from sessionloom.plans.registry import ORACLES, QUERIES, query, r, view
from sessionloom.sources import files, store
from sessionloom.sources.scratch import new_path

PRICE_SCHEMA = "session_date date, open double, high double, low double, close double, adj_close double, volume long"


def _archive(spark, sf: str) -> str:
    """Two runs: bars before 2000, then all of them."""
    path, rows = new_path(spark, "archive"), X.trade_bars(spark, sf)
    files.append_run(rows.where("session_date < '2000-01-01'"), path, "run1")
    files.append_run(rows, path, "run2")
    return path


@query("src_01_scan_run", f"select symbol, count(*) as n, min(session_date) as first_session, max(session_date) as last_session, {r('sum(close)', 4)} as closes from bars where session_date < date '2000-01-01' group by symbol")
def src_01(spark, sf):
    rows = files.read_run(spark, _archive(spark, sf), PRICE_SCHEMA, "run1")
    return rows.groupBy("symbol").agg(F.count(F.lit(1)).alias("n"), F.min("session_date").alias("first_session"), F.max("session_date").alias("last_session"), F.round(F.sum("close"), 4).alias("closes"))


@query("src_02_inspect", """select symbol, count(*) as n_rows, min(session_date) as first_session, max(session_date) as last_session, count(session_date) - count(distinct session_date) as duplicate_dates,
  count(*) filter (where open is null) as null_open, count(*) filter (where high is null) as null_high, count(*) filter (where low is null) as null_low, count(*) filter (where close is null) as null_close,
  count(*) filter (where adj_close is null) as null_adj_close, count(*) filter (where volume is null) as null_volume,
  count(*) filter (where session_date < date '1996-01-01' or session_date >= date '1998-07-01') as outside from dirty group by symbol""")
def src_02(spark, sf):
    rows = Q.canonical(X.dirty(spark, sf)).withColumn("session_date", F.to_date("ts"))
    return files.inspect(rows, F.lit(X.START).cast("date"), F.lit(X.END).cast("date"))


@query("src_03_append_only", "select 'run1' as run_id, count(*) as n from bars where session_date < date '2000-01-01' union all select 'run2', count(*) from bars")
def src_03(spark, sf):
    path = _archive(spark, sf)
    return spark.read.schema(f"{PRICE_SCHEMA}, run_id string, symbol string").parquet(path).groupBy("run_id").agg(F.count(F.lit(1)).alias("n"))


def _manifest(spark, sf):
    """Three runs; the last one failed for one instrument, the first covers fewer days."""
    runs = spark.createDataFrame([("run1", "2000-01-02"), ("run2", "2002-01-01"), ("run3", "2002-01-02")], "run_id string, day string")
    rows = X.trade_bars(spark, sf).groupBy("symbol").agg(F.count_if(F.col("session_date") < "2000-01-01").alias("early"), F.count(F.lit(1)).alias("n"))
    failed = (F.col("run_id") == "run3") & (F.col("symbol") == "AF")
    return rows.crossJoin(F.broadcast(runs)).select(
        "run_id", "symbol", F.when(failed, "failed").otherwise("success").alias("status"), F.col("day").cast("date").alias("finished_at"),
        F.concat("run_id", F.lit("/"), "symbol", F.lit(".parquet")).alias("file"), F.when(F.col("run_id") == "run1", F.col("early")).otherwise(F.col("n")).alias("n_rows"),
    )


view("manifest", """select run_id, symbol, case when run_id = 'run3' and symbol = 'AF' then 'failed' else 'success' end as status, finished_at, run_id || '/' || symbol || '.parquet' as file,
  case when run_id = 'run1' then early else n end as n_rows from (select symbol, count(*) filter (where session_date < date '2000-01-01') as early, count(*) as n from bars group by symbol) b
  cross join (select 'run1' as run_id, date '2000-01-02' as finished_at union all select 'run2', date '2002-01-01' union all select 'run3', date '2002-01-02') k""")


@query("src_04_latest_complete_run", "select arg_max(run_id, finished_at) as run_id, max(finished_at) as finished_at from (select run_id, max(finished_at) as finished_at from manifest group by run_id having bool_and(status = 'success') and count(distinct symbol) = (select count(*) from instruments))")
def src_04(spark, sf):
    return store.latest_complete_run(_manifest(spark, sf), X.instruments(spark, sf))


@query("src_05_dataset_id", """select sha256(string_agg(j, chr(10) order by j)) as dataset_id, count(*) as members from (select '{"run_id":"' || run_id || '","symbol":"' || symbol || '","n_rows":' || n_rows::varchar || '}' as j from manifest)""")
def src_05(spark, sf):
    return files.dataset_id(_manifest(spark, sf), "run_id", "symbol", "n_rows")


@query("src_05_file_fingerprints", "select 3 as files, 3 as distinct_files, 64 as digits from (select count(*) from manifest)")
def src_05_files(spark, sf):
    path = new_path(spark, "fingerprints")
    _manifest(spark, sf).where("run_id = 'run1'").coalesce(1).write.parquet(path + "/one")
    _manifest(spark, sf).where("run_id = 'run2'").coalesce(1).write.parquet(path + "/two")
    _manifest(spark, sf).where("run_id = 'run3'").coalesce(1).write.parquet(path + "/three")
    some = reduce(DataFrame.unionByName, [files.file_fingerprints(spark, f"{path}/{p}") for p in ("one", "two", "three")])
    return some.agg(F.count(F.lit(1)).cast("int").alias("files"), F.count_distinct("sha256").cast("int").alias("distinct_files"), F.max(F.length("sha256")).alias("digits"))


@query("src_06_manifest_check", """select 'as written' as state, 0::bigint as missing, 0::bigint as unknown, 0::bigint as different, count(*) as n_rows from bars
  union all select 'one file more', 0, 1, 0, count(*) + count(*) filter (where symbol = 'AF') from bars union all select 'manifest of other rows', count(distinct symbol), count(distinct symbol), 0, count(*) from bars
  union all select 'rows miscounted', 0, 0, count(distinct symbol), count(*) from bars""")
def src_06(spark, sf):
    """Files of one symbol each against manifests: their own, with a file added, that of other rows, and one with wrong counts."""
    path, rows = new_path(spark, "verified"), X.stored(X.trade_bars(spark, sf), "bars")
    manifest = files.write_with_manifest(rows.repartition("symbol"), path, "symbol")
    other = files.write_with_manifest(rows.withColumn("close", F.col("close") + 1).repartition("symbol"), new_path(spark, "verified"), "symbol")
    checks = {"as written": manifest, "manifest of other rows": other, "rows miscounted": manifest.withColumn("n_rows", F.col("n_rows") + 1)}
    n = files.verified(files.files_with_rows(spark, path), path).count()
    now = files.files_with_rows(spark, path)
    parts = [files.manifest_mismatches(m, now, "file", "sha256", "n_rows").withColumns({"state": F.lit(k), "n_rows": F.lit(n).cast("long")}) for k, m in checks.items()]
    parts = [X.stored(p, "checked") for p in parts]
    rows.where("symbol = 'AF'").coalesce(1).write.mode("append").partitionBy("symbol").parquet(path)
    now = files.files_with_rows(spark, path)
    parts.append(files.manifest_mismatches(manifest, now, "file", "sha256", "n_rows").withColumn("state", F.lit("one file more")).crossJoin(now.agg(F.sum("n_rows").alias("n_rows"))))
    return reduce(DataFrame.unionByName, parts)


@query("src_07_json", "select symbol, kind, sector from instruments")
def src_07(spark, sf):
    path = new_path(spark, "json")
    X.instruments(spark, sf).write.json(path)
    return spark.read.schema("symbol string, kind string, sector string").json(path)


@query("src_08_csv", f"select symbol, count(*) as n, {r('sum(close)', 4)} as closes, sum(volume)::bigint as volume from bars group by symbol")
def src_08(spark, sf):
    path = new_path(spark, "csv")
    files.write_csv(X.trade_bars(spark, sf), path)
    rows = files.read_csv(spark, path, f"symbol string, {PRICE_SCHEMA}")
    return rows.groupBy("symbol").agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("close"), 4).alias("closes"), F.sum("volume").alias("volume"))


@query("src_09_csv_sink", "select symbol, session_date, gap_disposition from panel where gap")
def src_09(spark, sf):
    path = new_path(spark, "gaps")
    files.write_csv(S.gaps(X.panel(spark, sf)), path)
    return files.read_csv(spark, path, "symbol string, session_date date, gap_disposition string")


@query("src_10_parquet_sink", "select symbol, count(*) as n from bars group by symbol")
def src_10(spark, sf):
    path = new_path(spark, "bars")
    files.write_parquet(X.trade_bars(spark, sf), path, "symbol")
    return spark.read.schema(f"{PRICE_SCHEMA}, symbol string").parquet(path).groupBy("symbol").agg(F.count(F.lit(1)).alias("n"))


@query("src_11_filtered_read", "select symbol, session_date, close as close from bars where symbol in ('AF', 'RF') and session_date >= date '1997-01-01' order by symbol, session_date")
def src_11(spark, sf):
    rows = X.trade_bars(spark, sf).where(F.col("symbol").isin("AF", "RF") & (F.col("session_date") >= F.lit("1997-01-01").cast("date")))
    return rows.select("symbol", "session_date", "close").orderBy("symbol", "session_date")


@query("src_12_insert_absent", "select symbol, session_date, case when session_date < date '1998-01-01' then 'old' else 'new' end as version from bars")
def src_12(spark, sf):
    rows = X.trade_bars(spark, sf).select("symbol", "session_date")
    old = rows.where("session_date < '1998-01-01'").withColumn("version", F.lit("old"))
    return store.insert_absent(old, rows.where("session_date >= '1996-01-01'").withColumn("version", F.lit("new")), ["symbol", "session_date"])


@query("src_13_replace_window", "select symbol, session_date, case when session_date >= date '1997-01-01' and session_date < date '1999-01-01' and symbol like 'A%' then 'new' else 'old' end as version from bars")
def src_13(spark, sf):
    rows = X.trade_bars(spark, sf).select("symbol", "session_date")
    new = rows.where("symbol like 'A%' and session_date >= '1997-01-01' and session_date < '1999-01-01'").withColumn("version", F.lit("new"))
    return store.replace_window(rows.withColumn("version", F.lit("old")), new, ["symbol"], "session_date", F.lit("1997-01-01").cast("date"), F.lit("1999-01-01").cast("date"))


@query("src_14_load_once", "select 'd2' as dataset_id, count(*) as n, true as older_is_refused from bars where session_date >= date '2000-01-01'")
def src_14(spark, sf):
    """A second load of d1 adds nothing while d1 is in use, and is refused once d2 is."""
    rows = X.stored(X.trade_bars(spark, sf).select("symbol", "session_date", F.when(F.col("session_date") < "2000-01-01", "d1").otherwise("d2").alias("dataset_id")), "datasets")
    old = rows.where("dataset_id = 'd1'")
    added = store.load_once(old, rows, rows.agg(F.min("dataset_id").alias("dataset_id")))
    try:
        store.load_once(rows, old, rows.agg(F.max("dataset_id").alias("dataset_id"))).count()
        refused = False
    except SparkRuntimeException:
        refused = True
    return added.groupBy("dataset_id").agg(F.count(F.lit(1)).alias("n")).withColumn("older_is_refused", F.lit(refused))


@query("src_15_current", "select symbol, count(*) as n from bars where session_date >= date '2000-01-01' group by symbol")
def src_15(spark, sf):
    rows = X.trade_bars(spark, sf).select("symbol", "session_date", F.when(F.col("session_date") < "2000-01-01", "d1").otherwise("d2").alias("dataset_id"))
    pointer = rows.agg(F.max("dataset_id").alias("dataset_id"))
    return store.current(rows, pointer).groupBy("symbol").agg(F.count(F.lit(1)).alias("n"))


@query("src_16_publish", "select symbol, count(*) as n from bars group by symbol")
def src_16(spark, sf):
    root = new_path(spark, "published")
    counts = X.trade_bars(spark, sf).groupBy("symbol").agg(F.count(F.lit(1)).alias("n"))
    store.publish(counts.limit(0), root)
    store.publish(counts, root)
    return store.published(spark, root)


@query("src_17_records", """select '{"symbol":"' || symbol || '","session_date":"' || session_date::varchar || '","volume":' || coalesce(volume::varchar, 'null') || ',"gap":' || gap::varchar || '}' as record from panel""")
def src_17(spark, sf):
    return X.panel(spark, sf).select("symbol", "session_date", "volume", "gap").select(C.as_json("symbol", "session_date", "volume", "gap").alias("record"))


@query("src_18_schema", "select unnest(['symbol', 'session_date', 'open', 'gap', 'volume']) as \"column\", unnest(['string', 'string', 'double', 'boolean', 'double']) as kind from (select count(*) from bars)")
def src_18(spark, sf):
    return files.schema_summary(X.panel(spark, sf).select("symbol", "session_date", "open", "gap", "volume"))


@query("src_19_typed_import", "select symbol, session_date, adj_close as adj_close, volume from panel")
def src_19(spark, sf):
    path = new_path(spark, "import")
    files.write_csv(X.panel(spark, sf).select("symbol", "session_date", "adj_close", "volume"), path)
    return files.read_csv(spark, path, "symbol string, session_date date, adj_close double, volume long")


@query("src_20_orphans", "select (select count(*) from bars where symbol = 'RF') as orphans, 0::bigint as repeated from (select count(*) from bars)")
def src_20(spark, sf):
    return store.orphans(X.trade_bars(spark, sf), X.instruments(spark, sf).where("symbol <> 'RF'"), "symbol")


# projections


@query("prj_01_rename", "select symbol, source_row, open as open, adj_close as adj_close from dirty")
def prj_01(spark, sf):
    return X.dirty(spark, sf).withColumnsRenamed(Q.RENAME).select("symbol", "source_row", "open", "adj_close")


@query("prj_02_absent_columns", "select symbol, source_row, null::double as volume, ['volume'] as missing from dirty")
def prj_02(spark, sf):
    return Q.canonical(X.dirty(spark, sf).drop("Volume")).select("symbol", "source_row", "volume", "missing")


@query("prj_03_numbers", "select symbol, source_row, close as close, volume as volume from dirty")
def prj_03(spark, sf):
    return Q.canonical(X.dirty(spark, sf)).select("symbol", "source_row", "close", "volume")


@query("prj_04_exchange_date", "select event_id, (ts + interval 330 minute)::date as local_date from events")
def prj_04(spark, sf):
    return X.table(spark, sf, "events").select("event_id", C.exchange_date(F.col("ts").cast("timestamp")).alias("local_date"))


@query("prj_05_source_row", "select symbol, session_date, (row_number() over (partition by symbol order by session_date) - 1)::bigint as source_row from bars")
def prj_05(spark, sf):
    return X.trade_bars(spark, sf).select("symbol", "session_date", (F.row_number().over(Window.partitionBy("symbol").orderBy("session_date")) - 1).cast("long").alias("source_row"))


@query("prj_06_lineage", "select b.symbol, session_date, file, 'provider' as provider, 'raw_ohlc_with_adj_close' as adjustment from bars b join manifest m on b.symbol = m.symbol and run_id = 'run2'")
def prj_06(spark, sf):
    m = F.broadcast(_manifest(spark, sf).where("run_id = 'run2'").select("symbol", "file"))
    return X.trade_bars(spark, sf).select("symbol", "session_date").join(m, "symbol").withColumns({"provider": F.lit("provider"), "adjustment": F.lit("raw_ohlc_with_adj_close")})


@query("prj_07_ratio", f"select l_orderkey, l_linenumber, l_partkey, l_suppkey, {r('case when l_tax > 0 then l_discount::double / l_tax::double end')} as per_tax from lineitem")
def prj_07(spark, sf):
    rows = X.table(spark, sf, "lineitem")
    return rows.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", F.round(C.ratio(F.col("l_discount").cast("double"), F.col("l_tax").cast("double")), 6).alias("per_tax"))


@query("prj_08_finite", "select event_id, case when value::double % 7 >= 1 then value::double end as value from events")
def prj_08(spark, sf):
    v = F.col("value").cast("double")
    return X.table(spark, sf, "events").select("event_id", C.finite(F.when(v % 7 < 1, float("inf")).otherwise(v)).alias("value"))


@query("prj_09_adjusted", "select symbol, session_date, adj_close as c, high * (adj_close / close) as h, low * (adj_close / close) as l from panel where feature_eligible")
def prj_09(spark, sf):
    from sessionloom.operators.features import adjusted

    return adjusted(X.panel(spark, sf).where("feature_eligible")).select("symbol", "session_date", *"chl")


@query("prj_10_allow_list", """select symbol, session_date, count as predictors, metadata from (select p.symbol, p.session_date, n.count, 'symbol,session_date,segment_age,input_valid,core_ready,available_at,feature_version' as metadata from panel p cross join (select 39::bigint as count) n)""")
def prj_10(spark, sf):
    """The feature table split into its predictors, which are on the allow-list, and the columns that only describe a row."""
    from sessionloom.operators import features as FT

    predictors, metadata = FT.split_columns(FT.features(X.panel(spark, sf)))
    return predictors.select("symbol", "session_date", F.lit(len(predictors.columns) - 2).cast("long").alias("predictors")).join(metadata.select("symbol", "session_date", F.lit(",".join(metadata.columns)).alias("metadata")), ["symbol", "session_date"])


SYMBOLS = ["AF", "AO", "NF", "NO", "RF", "RO"]


@query("prj_11_one_hot", "select symbol, session_date, " + ", ".join(f"(symbol = '{s}')::int::double as instrument_{s}" for s in SYMBOLS) + " from bars")
def prj_11(spark, sf):
    return X.trade_bars(spark, sf).select("symbol", "session_date", *C.one_hot(F.col("symbol"), SYMBOLS, "instrument"))


@query("prj_13_labels", "select symbol, session_date, case when gap then 'excluded_no_imputation' else '' end as gap_disposition, case when gap then 'No current risk reading' else 'Current indicators' end as data_status from panel")
def prj_13(spark, sf):
    return X.panel(spark, sf).select("symbol", "session_date", "gap_disposition", F.when(F.col("gap"), "No current risk reading").otherwise("Current indicators").alias("data_status"))


@query("prj_14_share_volume", "select symbol, session_date, case when volume_feature_eligible and kind <> 'index' then volume::double end as v from panel where feature_eligible")
def prj_14(spark, sf):
    from sessionloom.operators.features import adjusted

    return adjusted(X.panel(spark, sf).where("feature_eligible")).select("symbol", "session_date", "v")


@query("prj_15_prices", "select symbol, session_date, case when feature_eligible then adj_close end as price from panel")
def prj_15(spark, sf):
    from sessionloom.operators.analytics import prices

    return prices(X.panel(spark, sf))


@query("prj_16_symbol_filter", "select symbol, count(*) as n, (select count(*) from (select 'AF' as s union all select 'ZZ') k where s not in (select symbol from bars)) as unknown from bars where symbol in ('AF', 'ZZ') group by symbol")
def prj_16(spark, sf):
    rows = X.trade_bars(spark, sf)
    wanted = spark.createDataFrame([("AF",), ("ZZ",)], "symbol string")
    unknown = wanted.join(rows, "symbol", "left_anti").agg(F.count(F.lit(1)).alias("unknown"))
    return rows.join(F.broadcast(wanted), "symbol", "left_semi").groupBy("symbol").agg(F.count(F.lit(1)).alias("n")).crossJoin(unknown)


@query("prj_17_age", "select symbol, (date '2002-01-01' - max(session_date))::int as age_days from bars group by symbol")
def prj_17(spark, sf):
    return X.trade_bars(spark, sf).groupBy("symbol").agg(F.max("session_date").alias("d")).select("symbol", F.datediff(F.lit("2002-01-01").cast("date"), "d").alias("age_days"))


@query("prj_18_request_window", "select o_orderkey, o_orderdate::date < date '1997-06-01' and date '1997-06-01' <= (case when o_orderkey % 24 >= 16 then date '1997-06-01' else date '1997-05-31' end) + 0 as accepted from orders")
def prj_18(spark, sf):
    o = X.table(spark, sf, "orders")
    end = F.lit("1997-06-01").cast("date")
    most = F.when(F.col("o_orderkey") % 24 >= 16, end).otherwise(F.date_sub(end, 1))
    return o.select("o_orderkey", ((F.col("o_orderdate").cast("date") < end) & (end <= most)).alias("accepted"))


# validation rules


def _checked(spark, sf):
    return X.stored(Q.checked(X.dirty(spark, sf), X.exchange_calendar(spark, sf)), "checked")


def _rule(number: str, rule: str, condition: str, details: dict[str, str] | None = None):
    """A query of one rule's issue rows; details: SQL condition by detail."""
    parts = details or {"": condition}
    sql = " union all ".join(f"select symbol, source_row, session_date, '{d}' as detail from (select *, coalesce({c}, false) as hit from dirty_days) where hit" for d, c in parts.items())

    def run(spark, sf):
        return Q.row_issues(_checked(spark, sf)).where(F.col("rule") == rule).select("symbol", "source_row", "session_date", "detail")

    QUERIES[f"{number}_{rule}"] = run
    from sessionloom.plans.registry import with_views

    ORACLES[f"{number}_{rule}"] = with_views(sql)


_rule("q_03", "invalid_date", X.RULES["invalid_date"])
_rule("q_04", "non_daily_timestamp", X.RULES["non_daily_timestamp"])
_rule("q_05", "duplicate_date", "", {"Date comes more than once": X.RULES["duplicate_date"]})
_rule("q_06", "date_out_of_range", X.RULES["date_out_of_range"])
_rule("q_08", "invalid_numeric", "", {"close": "close_text"})
_rule("q_09", "invalid_price", "", {c: f"{c} is null or {c} <= 0" for c in Q.PRICES})
_rule("q_10", "invalid_adjusted_close", X.RULES["invalid_adjusted_close"])
_rule("q_11", "missing_adjusted_close", "", {"No label can be made": "adj_close is null"})
_rule("q_12", "invalid_ohlc_order", X.RULES["invalid_ohlc_order"])
_rule("q_13", "invalid_volume", X.RULES["invalid_volume"])
_rule("q_14", "missing_volume", "kind = 'equity' and volume is null")
_rule("q_15", "zero_volume", "kind = 'equity' and volume = 0")
_rule("q_16", "corporate_action", "", {"Kept as it came": "dividends > 0 or stock_splits > 0"})
_rule("q_17", "invalid_corporate_action", "", {"dividends": "dividends < 0"})
_rule("q_18", "verified_closed_session", "", {"Not a session": "not expected_open"})


@query("q_01_unexpected_columns", "select symbol, 'Vendor' as detail from dirty group by symbol")
def q_01(spark, sf):
    return Q.column_issues(X.dirty(spark, sf), X.KNOWN).select("symbol", "detail")


@query("q_02_unsorted_dates", "select symbol, 'info' as severity from (select symbol, lag(ts) over (partition by symbol order by source_row) > ts as back from dirty) where back group by symbol")
def q_02(spark, sf):
    return Q.order_issues(X.dirty(spark, sf)).select("symbol", "severity")


@query("q_07_missing_column", "select symbol, source_row, session_date, 'volume' as detail from dirty")
def q_07(spark, sf):
    rows = Q.checked(X.dirty(spark, sf).drop("Volume"), X.exchange_calendar(spark, sf))
    return Q.row_issues(rows).where("rule = 'missing_column'").select("symbol", "source_row", "session_date", "detail")


view("good", "select symbol, kind, source_row, session_date, open, high, low, close, adj_close, volume::bigint as volume, dividends from judged where not bad")


@query("q_19_large_observed_return", "select symbol, source_row, session_date from (select *, abs(adj_close / lag(adj_close) over (partition by symbol order by session_date) - 1) as change from good) where change > 0.2")
def q_19(spark, sf):
    return Q.series_issues(Q.clean(_checked(spark, sf))).where("rule = 'large_observed_return'").select("symbol", "source_row", "session_date")


view("trail_base", """select *, case when n >= 10 then (case when n % 2 = 1 then v[(n + 1) // 2]::double else (v[n // 2] + v[n // 2 + 1]) / 2.0 end) end as base from (
  select *, len(v) as n from (select *, list_sort(list_filter(array_agg(volume) over (partition by symbol order by session_date rows between 20 preceding and 1 preceding), lambda x: x is not null)) as v from good))""")


@query("q_20_volume_spike", "select symbol, source_row, session_date from trail_base where kind = 'equity' and base > 0 and volume > base * 10")
def q_20(spark, sf):
    return Q.series_issues(Q.clean(_checked(spark, sf))).where("rule = 'volume_spike'").select("symbol", "source_row", "session_date")


view("expected", f"select s.symbol, session_date as day from (select distinct symbol from dirty) s cross join calendar where expected_open and session_date >= date '{X.START}' and session_date < date '{X.END}'")


@query("q_21_stale_latest_bar", "select e.symbol, max(day) as session_date from expected e left join (select symbol, max(session_date) as latest from good where session_date < date '1998-06-30' group by symbol) g on e.symbol = g.symbol group by e.symbol, latest having latest is null or latest < max(day)")
def q_21(spark, sf):
    # the last days are withheld, so that the rule has something to find
    rows = _checked(spark, sf).withColumn("bad", F.col("bad") | F.coalesce(F.col("session_date") >= "1998-06-30", F.lit(False)))
    return Q.session_issues(rows, X.exchange_calendar(spark, sf)).where("rule = 'stale_latest_bar'").select("symbol", "session_date")


@query("q_22_absent_sessions", """select e.symbol, day as session_date, case when usable is null then 'missing_session' else 'unusable_session' end as rule from expected e
  left join (select symbol, session_date, bool_or(not bad) as usable from judged where session_date is not null group by 1, 2) j on e.symbol = j.symbol and day = j.session_date where not coalesce(usable, false)""")
def q_22(spark, sf):
    return Q.session_issues(_checked(spark, sf), X.exchange_calendar(spark, sf)).where("rule <> 'stale_latest_bar'").select("symbol", "session_date", "rule")


@query("q_23_clean", "select symbol, source_row, session_date, close as close, volume, true as price_valid, adj_close is not null as label_price_available, false as calendar_review_required from good")
def q_23(spark, sf):
    return Q.clean(_checked(spark, sf)).select("symbol", "source_row", "session_date", "close", "volume", "price_valid", "label_price_available", "calendar_review_required")


@query("q_24_quarantine", "select symbol, source_row, array_to_string(list_sort(list_filter([" + ", ".join(f"case when {x} then '{x}' end" for x in X.RULES) + "], lambda x: x is not null)), ',') as reasons from judged where bad")
def q_24(spark, sf):
    return Q.quarantine(_checked(spark, sf)).select("symbol", "source_row", "reasons")


@query("q_25_conservation", """select symbol, count(*) filter (where not bad and day(session_date) = 3) as lost, count(*) filter (where bad and coalesce(day(session_date) = 4, false)) as extra from judged group by symbol""")
def q_25(spark, sf):
    """The outputs against the source rows, with the third of each month lost from one and the fourth twice in the other."""
    rows = _checked(spark, sf)
    bad = Q.quarantine(rows)
    return Q.conservation(rows, Q.clean(rows).where("day(session_date) <> 3"), bad.unionByName(bad.where("day(session_date) = 4")))


@query("q_26_invariants", """select count(*) filter (where day(session_date) = 2) as repeated, (count(*) filter (where price_valid and day(session_date) = 5))::bigint as bad_prices, (count(*) filter (where gap and day(session_date) % 2 = 0))::bigint
  + (count(*) filter (where gap and day(session_date) = 2))::bigint as filled_gaps, (count(*) filter (where target_1d_eligible and target_5d_eligible and day(session_date) = 7))::bigint as bad_masks from panel""")
def q_26(spark, sf):
    """The panel with faults planted by day of the month."""
    day = F.dayofmonth("session_date")
    panel = X.panel(spark, sf)
    rows = panel.withColumns({
        "low": F.when(F.col("price_valid") & (day == 5), -F.col("low")).otherwise(F.col("low")), "close": F.when(F.col("gap") & (day % 2 == 0), 1.0).otherwise(F.col("close")),
        "target_1d_eligible": F.col("target_1d_eligible") & (day != 7),
    })
    return Q.invariant_violations(rows.unionByName(rows.where(day == 2)))


@query("q_27_run_gate", "select 1::bigint as missing, 0::bigint as unknown, 1::bigint as failed, false as may_run from (select count(*) from manifest)")
def q_27(spark, sf):
    return Q.run_gate(_manifest(spark, sf).where("run_id = 'run3' and symbol <> 'RO'"), X.instruments(spark, sf))


@query("q_28_expectations", """select 'prices_positive' as rule, count(*) filter (where not (least(open, high, low, close) > 0)) as violations from dirty union all
  select 'high_is_highest', count(*) filter (where not (high >= greatest(open, low, close))) from dirty union all select 'low_is_lowest', count(*) filter (where not (low <= least(open, high, close))) from dirty union all
  select 'volume_not_negative', count(*) filter (where not (volume >= 0)) from dirty union all select 'kind_known', count(*) filter (where not (kind in ('index', 'equity'))) from dirty union all
  select 'whole_volume', count(*) filter (where not (volume % 1 = 0)) from dirty""")
def q_28(spark, sf):
    rows = Q.canonical(X.dirty(spark, sf))
    c = F.col
    return Q.expectations(rows, {
        "prices_positive": F.least(*Q.PRICES) > 0, "high_is_highest": c("high") >= F.greatest("open", "low", "close"), "low_is_lowest": c("low") <= F.least("open", "high", "close"),
        "volume_not_negative": c("volume") >= 0, "kind_known": c("kind").isin("index", "equity"), "whole_volume": c("volume") % 1 == 0,
    })


view("issue_rows", " union all ".join(
    [f"select symbol, source_row, session_date, '{n}' as rule, 'error' as severity from judged where {n}" for n in X.RULES if n not in ("invalid_price",)]
    + [f"select symbol, source_row, session_date, 'invalid_price', 'error' from judged where {c} is null or {c} <= 0" for c in Q.PRICES]
    + ["select symbol, source_row, session_date, 'missing_adjusted_close', 'warning' from judged where adj_close is null", "select symbol, source_row, session_date, 'missing_volume', 'warning' from judged where kind = 'equity' and volume is null",
       "select symbol, source_row, session_date, 'zero_volume', 'warning' from judged where kind = 'equity' and volume = 0", "select symbol, source_row, session_date, 'corporate_action', 'info' from judged where dividends > 0"]))


view("issue_log", """select symbol, source_row, session_date, rule, severity from issue_rows
  union all select symbol, source_row, session_date, 'large_observed_return', 'warning' from (select *, abs(adj_close / lag(adj_close) over (partition by symbol order by session_date) - 1) as change from good) where change > 0.2
  union all select symbol, source_row, session_date, 'volume_spike', 'warning' from trail_base where kind = 'equity' and base > 0 and volume > base * 10
  union all select e.symbol, null, day, case when usable is null then 'missing_session' else 'unusable_session' end, 'warning' from expected e
    left join (select symbol, session_date, bool_or(not bad) as usable from judged where session_date is not null group by 1, 2) j on e.symbol = j.symbol and day = j.session_date where not coalesce(usable, false)
  union all select e.symbol, null, max(day), 'stale_latest_bar', 'warning' from expected e left join (select symbol, max(session_date) as latest from good group by symbol) g on e.symbol = g.symbol group by e.symbol, latest having latest is null or latest < max(day)
  union all select symbol, null, null, 'unsorted_dates', 'info' from (select symbol, lag(ts) over (partition by symbol order by source_row) > ts as back from dirty) where back group by symbol""")


@query("prj_12_disposition", """select symbol, source_row, session_date, rule, case severity when 'error' then 'quarantined' else
    case rule when 'missing_session' then 'excluded_with_explicit_session_mask' when 'unusable_session' then 'excluded_with_explicit_session_mask' when 'stale_latest_bar' then 'excluded_with_explicit_session_mask'
      when 'missing_adjusted_close' then 'retained_price_only; eligibility_masks_apply' when 'missing_volume' then 'retained_price_only; eligibility_masks_apply' when 'zero_volume' then 'retained_price_only; eligibility_masks_apply'
      else 'retained_source_observation; no_automatic_repair' end end as disposition from issue_log""")
def prj_12(spark, sf):
    """The whole issue log: rows, series, sessions and order."""
    return Q.issue_log(_checked(spark, sf), X.exchange_calendar(spark, sf)).select("symbol", "source_row", "session_date", "rule", "disposition")


@query("ag_01_validation_summary", """select j.symbol, n_raw, n_clean, n_quarantined, latest_usable, missing_sessions, excluded_sessions, eligible_1d, eligible_5d from (
    select symbol, count(*) as n_raw, count(*) filter (where not bad) as n_clean, count(*) filter (where bad) as n_quarantined, max(session_date) filter (where not bad) as latest_usable from judged group by symbol) j
  join (select symbol, count(*) filter (where gap and not seen) as missing_sessions, count(*) filter (where gap) as excluded_sessions, count(*) filter (where t1) as eligible_1d, count(*) filter (where t5) as eligible_5d from (
      select *, bool_and(fe) over (w rows between current row and 1 following) and count(*) over (w rows between current row and 1 following) = 2 as t1,
             bool_and(fe) over (w rows between current row and 5 following) and count(*) over (w rows between current row and 5 following) = 6 as t5 from (
        select s.symbol, c.session_date, g.close is null as gap, g.adj_close is not null as fe, d.symbol is not null as seen
        from (select distinct symbol from good) s cross join (select session_date from calendar where expected_open) c left join good g on s.symbol = g.symbol and c.session_date = g.session_date
        left join (select distinct symbol, session_date from judged) d on s.symbol = d.symbol and c.session_date = d.session_date) window w as (partition by symbol order by session_date)) group by symbol) a on j.symbol = a.symbol""")
def ag_01(spark, sf):
    rows = _checked(spark, sf)
    return Q.summary(rows, X.stored(S.align(Q.clean(rows).drop("kind"), X.exchange_calendar(spark, sf)), "aligned"))


@query("ag_02_issues_by_rule", "select rule, count(*) as n from issue_rows group by rule")
def ag_02(spark, sf):
    return Q.row_issues(_checked(spark, sf)).groupBy("rule").agg(F.count(F.lit(1)).alias("n"))


@query("ag_03_ready", "select bool_and(n > 0) as ready from (select symbol, count(*) filter (where target_5d_eligible) as n from panel group by symbol)")
def ag_03(spark, sf):
    return X.panel(spark, sf).groupBy("symbol").agg(F.count_if("target_5d_eligible").alias("n")).agg(F.bool_and(F.col("n") > 0).alias("ready"))


# calendars


@query("cal_01_calendar", "select session_date, expected_open, session_kind, source, calendar_version from calendar")
def cal_01(spark, sf):
    return X.exchange_calendar(spark, sf)


@query("cal_02_uncovered", "select o_orderkey, a as start, b as \"end\" from (select o_orderkey, o_orderdate::date as a, o_orderdate::date + (o_orderkey % 9 - 2)::int as b from orders) where a >= b or a < date '1993-01-01' or b > date '1998-01-01'")
def cal_02(spark, sf):
    o = X.table(spark, sf, "orders").select("o_orderkey", F.col("o_orderdate").cast("date").alias("start"))
    o = o.withColumn("end", F.date_add("start", (F.col("o_orderkey") % 9 - 2).cast("int")))
    cover = spark.range(1).select(F.lit("1993-01-01").cast("date").alias("first"), F.lit("1998-01-01").cast("date").alias("last"))
    return S.uncovered(o, cover)


@query("cal_03_align", "select symbol, session_date, close as close, volume from panel")
def cal_03(spark, sf):
    return X.panel(spark, sf).select("symbol", "session_date", "close", "volume")


@query("cal_04_masks", "select symbol, session_date, price_valid, gap, feature_eligible, volume_feature_eligible from panel")
def cal_04(spark, sf):
    return X.panel(spark, sf).select("symbol", "session_date", "price_valid", "gap", "feature_eligible", "volume_feature_eligible")


@query("cal_05_segments", "select symbol, session_date, segment_id from panel")
def cal_05(spark, sf):
    return X.panel(spark, sf).select("symbol", "session_date", "segment_id")


@query("cal_05_segments_by_year", "select symbol, session_date, segment_id from panel")
def cal_05_by_year(spark, sf):
    """The same as running counts within years and totals of earlier ones, for series of any length."""
    return SL.segments(X.panel(spark, sf), F.year("session_date")).select("symbol", "session_date", F.col("segment_id").cast("long").alias("segment_id"))


@query("cal_06_horizons", "select symbol, session_date, target_1d_eligible, target_5d_eligible from panel")
def cal_06(spark, sf):
    return X.panel(spark, sf).select("symbol", "session_date", "target_1d_eligible", "target_5d_eligible")


@query("cal_07_segment_age", "select symbol, session_date, case when feature_eligible then row_number() over (partition by symbol, segment_id, feature_eligible order by session_date) else 0 end::bigint as segment_age from panel")
def cal_07(spark, sf):
    return S.segment_age(X.panel(spark, sf)).select("symbol", "session_date", "segment_age")


view("moments", "select distinct ts as now from events")


def _moments(spark, sf):
    """Times of day from the events, on the calendar's days."""
    return X.table(spark, sf, "events").select((F.col("ts") - F.expr("interval 27 years")).alias("now")).distinct()


view("moments_past", "select distinct ts - interval 27 year as now from events")


@query("cal_08_expected_session", """select now, max(case when expected_open and (session_date < now::date or hour(now) * 60 + minute(now) >= case when session_kind in ('muhurat', 'special') then 1290 else 960 end) then session_date end) as expected_session
  from moments_past left join calendar on session_date <= now::date and session_date >= now::date - 14 group by now""")
def cal_08(spark, sf):
    return S.expected_session(X.exchange_calendar(spark, sf), _moments(spark, sf))


@query("cal_09_fresh", "select bool_and(coalesce(latest >= date '1998-10-01', false)) as fresh from (select symbol, max(session_date) as latest from bars group by symbol)")
def cal_09(spark, sf):
    latest = X.trade_bars(spark, sf).groupBy("symbol").agg(F.max("session_date").alias("latest_usable"))
    return S.is_fresh(latest, F.lit("1998-10-01").cast("date"))


@query("cal_10_later_session", "select session_date, lead(session_date, 5) over (order by session_date) as target_date from calendar where expected_open")
def cal_10(spark, sf):
    return S.later_session(X.exchange_calendar(spark, sf), 5)


@query("cal_11_preconditions", """select symbol, count(*) filter (where day(session_date) = 2) as repeated, count(*) filter (where feature_eligible and day(session_date) = 5) as bad_prices,
  count(*) filter (where feature_eligible and day(session_date) = 6) as unobserved from panel group by symbol""")
def cal_11(spark, sf):
    """The panel with faults planted by day of the month."""
    day = F.dayofmonth("session_date")
    rows = X.panel(spark, sf).withColumns({"close": F.when(day == 5, 0.0).otherwise(F.col("close")), "observed_at": F.when(day != 6, F.col("observed_at"))})
    return S.series_violations(rows.unionByName(rows.where(day == 2)))


@query("cal_12_available_at", "select symbol, session_date, case when feature_eligible then max(observed_at) over (partition by symbol order by session_date) end as available_at from panel")
def cal_12(spark, sf):
    return X.panel(spark, sf).select("symbol", "session_date", S.available_at(F.col("observed_at"), F.col("feature_eligible")).alias("available_at"))


@query("cal_14_gaps", "select symbol, session_date, gap_disposition from panel where gap")
def cal_14(spark, sf):
    return S.gaps(X.panel(spark, sf))


def _gaps_and_recheck(spark, sf):
    """Gaps on the exchange calendar, and what the landed rows have for their days."""
    rows = _checked(spark, sf)
    found = S.gaps(S.align(Q.clean(rows).drop("kind"), X.exchange_calendar(spark, sf)))
    return found, S.recheck(found, rows)


view("calendar_gaps", "select s.symbol, c.session_date from (select distinct symbol from good) s cross join (select session_date from calendar where expected_open) c left join good g on s.symbol = g.symbol and c.session_date = g.session_date where g.symbol is null")
view("rechecked", """select c.symbol, c.session_date, case when coalesce(n, 0) <> 1 then 'still_missing' when invalid then 'still_invalid' else 'candidate_found' end as status from calendar_gaps c
  left join (select symbol, session_date, count(*) as n, bool_or(coalesce(open <= 0, true) or coalesce(high <= 0, true) or coalesce(low <= 0, true) or coalesce(close <= 0, true) or coalesce(adj_close <= 0, true)) as invalid from dirty group by 1, 2) d
  on c.symbol = d.symbol and c.session_date = d.session_date""")


@query("cal_15_recheck", "select symbol, session_date, status from rechecked")
def cal_15(spark, sf):
    return _gaps_and_recheck(spark, sf)[1]


@query("cal_16_closeout", "select count(*) as gaps, count(*) as rechecked, 0::bigint as not_rechecked, 0::bigint as not_gaps, 0::bigint as rechecked_twice, count(*) filter (where status = 'candidate_found') as candidates from rechecked")
def cal_16(spark, sf):
    return S.closeout(*_gaps_and_recheck(spark, sf))


@query("ag_27_recheck_counts", "select status, count(*) as n from rechecked group by status")
def ag_27(spark, sf):
    return _gaps_and_recheck(spark, sf)[1].groupBy("status").agg(F.count(F.lit(1)).alias("n"))


@query("ag_28_nulls", "select 'open' as \"column\", count(*) filter (where open is null) as nulls from panel union all select 'adj_close', count(*) filter (where adj_close is null) from panel union all select 'volume', count(*) filter (where volume is null) from panel")
def ag_28(spark, sf):
    names = ["open", "adj_close", "volume"]
    return X.panel(spark, sf).agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in names]).unpivot([], names, "column", "nulls")


@query("ag_29_duplicates", "select symbol, session_date, count(*) as n from dirty where session_date is not null group by 1, 2 having count(*) > 1")
def ag_29(spark, sf):
    rows = X.dirty(spark, sf).where("ts is not null").groupBy("symbol", F.to_date("ts").alias("session_date")).agg(F.count(F.lit(1)).alias("n"))
    return rows.where("n > 1")


@query("ag_33_run_status", "select run_id, case when bool_and(status = 'success') then 'success' else 'partial_failure' end as status from manifest group by run_id")
def ag_33(spark, sf):
    return store.run_status(_manifest(spark, sf))


@query("ag_34_universe", "select count(*) as instruments, count(distinct symbol) as distinct_symbols from instruments")
def ag_34(spark, sf):
    return X.instruments(spark, sf).agg(F.count(F.lit(1)).alias("instruments"), F.count_distinct("symbol").alias("distinct_symbols"))
