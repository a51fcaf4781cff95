"""Queries on joins, sets, order, scalar functions and streams."""

from __future__ import annotations

from pyspark.sql import functions as F

from sessionloom.operators import analytics as A
from sessionloom.operators import publish as P
from sessionloom.operators import quality as Q
from sessionloom.operators import sessions as S
from sessionloom.plans import fixtures as X
from sessionloom.plans.landing import _manifest
from sessionloom.plans.registry import query, r, view
from sessionloom.sources import files, store
from sessionloom.sources.scratch import new_path
from sessionloom.streaming import arrivals


@query("jn_01_left", "select g.symbol, g.session_date, b.volume from grid g left join bars b on g.symbol = b.symbol and g.session_date = b.session_date")
def jn_01(spark, sf):
    return X.panel(spark, sf).select("symbol", "session_date", "volume")


@query("jn_02_one_to_one", "select symbol, session_date, volume, 0::bigint as repeated from bars")
def jn_02(spark, sf):
    """An inner join with the number of keys that repeat on either side, which must be 0."""
    rows = X.trade_bars(spark, sf)
    left, right = rows.select("symbol", "session_date"), rows.select("symbol", "session_date", "volume")
    repeated = left.unionByName(right.select("symbol", "session_date")).groupBy("symbol", "session_date").count().agg(F.count_if(F.col("count") > 2).alias("repeated"))
    return left.join(right, ["symbol", "session_date"]).crossJoin(F.broadcast(repeated))


@query("jn_03_semi", "select symbol, session_date from bars where session_date in (select session_date from calendar where not expected_open)")
def jn_03(spark, sf):
    closed = X.exchange_calendar(spark, sf).where("not expected_open").select("session_date")
    return X.trade_bars(spark, sf).select("symbol", "session_date").join(F.broadcast(closed), "session_date", "left_semi").select("symbol", "session_date")


@query("jn_04_anti", "select symbol, session_date from panel where gap")
def jn_04(spark, sf):
    rows = X.trade_bars(spark, sf).select("symbol", "session_date")
    return X.panel(spark, sf).select("symbol", "session_date").join(rows, ["symbol", "session_date"], "left_anti")


@query("jn_05_dimension", "select b.symbol, session_date, sector from bars b left join instruments i on b.symbol = i.symbol and i.symbol <> 'RO'")
def jn_05(spark, sf):
    sectors = X.instruments(spark, sf).where("symbol <> 'RO'").select("symbol", "sector")
    return X.trade_bars(spark, sf).select("symbol", "session_date").join(F.broadcast(sectors), "symbol", "left")


@query("jn_06_pointer", "select symbol, n_rows from manifest where run_id = 'run2'")
def jn_06(spark, sf):
    m = _manifest(spark, sf)
    active = store.latest_complete_run(m, X.instruments(spark, sf)).select("run_id")
    return m.join(F.broadcast(active), "run_id").select("symbol", "n_rows")


@query("jn_08_all_pairs", "select a.symbol, b.symbol as other, count(*) as days from bars a join bars b on a.session_date = b.session_date group by 1, 2")
def jn_08(spark, sf):
    rows = X.stored(X.trade_bars(spark, sf).select("symbol", "session_date", F.lit(0.0).alias("value")), "days")
    return A.both_ways(A.pair_sums(rows).select("symbol", "other", F.col("n").alias("days")))


@query("jn_10_reconcile", """select count(*) filter (where session_date >= date '2001-01-01') as left_only, 0::bigint as right_only, count(*) filter (where session_date < date '2001-01-01' and volume % 97 = 0) as different,
  count(*) filter (where session_date < date '2001-01-01' and volume % 97 <> 0) as equal from bars""")
def jn_10(spark, sf):
    rows = X.trade_bars(spark, sf)
    other = rows.where("session_date < '2001-01-01'").withColumn("close", F.col("close") + F.when(F.col("volume") % 97 == 0, 0.01).otherwise(1e-9))
    return store.reconcile(rows, other, ["symbol", "session_date"], {"close": 1e-6, "open": 1e-6})


@query("jn_11_grid", "select symbol, count(*) as sessions from grid group by symbol")
def jn_11(spark, sf):
    rows = X.trade_bars(spark, sf)
    return rows.select("symbol").distinct().crossJoin(F.broadcast(X.every_day(rows).select("session_date"))).groupBy("symbol").agg(F.count(F.lit(1)).alias("sessions"))


view("run_ids", """select run_id, sha256(string_agg(j, chr(10) order by j)) as dataset_id from (select run_id, '{"symbol":"' || symbol || '","n_rows":' || n_rows::varchar || '}' as j from manifest) group by run_id""")


@query("jn_12_coherence", "select o.run_id as risk_run, f.dataset_id as features_id, o.dataset_id = f.dataset_id as coherent from run_ids f cross join run_ids o where f.run_id = 'run2'")
def jn_12(spark, sf):
    """Features and analytics of run2, risk of each of the runs: run3 has the same rows, run1 fewer."""
    m = X.stored(_manifest(spark, sf), "manifest")
    ids = {k: files.dataset_id(m.where(F.col("run_id") == k), "symbol", "n_rows") for k in ("run1", "run2", "run3")}
    parts = [P.coherent(ids["run2"], ids["run2"], ids[k]).withColumn("risk_run", F.lit(k)) for k in ids]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@query("set_01_union", "select symbol, session_date from bars")
def set_01(spark, sf):
    rows = X.trade_bars(spark, sf).select("symbol", "session_date")
    return rows.where("symbol < 'N'").unionByName(rows.where("symbol >= 'N'"))


@query("set_02_difference", "select session_date from calendar where expected_open except all select distinct session_date from bars")
def set_02(spark, sf):
    opens = X.exchange_calendar(spark, sf).where("expected_open").select("session_date")
    return opens.exceptAll(X.trade_bars(spark, sf).select("session_date").distinct())


@query("set_03_equality", "select 0::bigint as only_left, (select count(*) from instruments where symbol = 'AF') as only_right from (select count(*) from bars)")
def set_03(spark, sf):
    symbols = X.trade_bars(spark, sf).select("symbol").distinct()
    return store.same_set(symbols.where("symbol <> 'AF'"), X.instruments(spark, sf).select("symbol"))


@query("set_04_distinct", "select distinct symbol, session_date from dirty where session_date is not null")
def set_04(spark, sf):
    return X.dirty(spark, sf).where("ts is not null").select("symbol", F.to_date("ts").alias("session_date")).dropDuplicates(["symbol", "session_date"])


@query("sl_01_sorted", "select session_date, symbol, volume from bars order by session_date, symbol")
def sl_01(spark, sf):
    return X.trade_bars(spark, sf).select("session_date", "symbol", "volume").orderBy("session_date", "symbol")


@query("sl_02_tail", "select symbol, session_date from (select symbol, session_date, row_number() over (partition by symbol order by session_date desc) as nth from bars) where nth <= 5")
def sl_02(spark, sf):
    from pyspark.sql.window import Window

    w = Window.partitionBy("symbol").orderBy(F.desc("session_date"))
    return X.trade_bars(spark, sf).select("symbol", "session_date", F.row_number().over(w).alias("nth")).where("nth <= 5").drop("nth")


@query("sl_04_arg_extremes", "select symbol, arg_min(session_date, row(volume, session_date)) as least_day, arg_max(session_date, row(volume, session_date)) as most_day from bars group by symbol")
def sl_04(spark, sf):
    at = F.struct("volume", "session_date")
    return X.trade_bars(spark, sf).groupBy("symbol").agg(F.min_by("session_date", at).alias("least_day"), F.max_by("session_date", at).alias("most_day"))


@query("sl_05_common_dates", "select min(session_date) as first_session, max(session_date) as last_session from (select session_date from bars group by session_date having count(*) = (select count(*) from instruments))")
def sl_05(spark, sf):
    n = F.broadcast(X.instruments(spark, sf).agg(F.count(F.lit(1)).alias("n")))
    full = X.trade_bars(spark, sf).groupBy("session_date").agg(F.count(F.lit(1)).alias("have")).join(n, F.col("have") == F.col("n"))
    return full.agg(F.min("session_date").alias("first_session"), F.max("session_date").alias("last_session"))


@query("fn_math", f"select o_orderkey, {r('ln(o_totalprice::double)')} as l, {r('sqrt(o_totalprice::double)')} as s, {r('pow(1.01::double, o_orderkey % 50)')} as p, sign(o_orderkey % 3 - 1)::int as g, greatest(o_orderkey % 7 - 3, 0)::bigint as c, (o_orderkey % 9)::bigint as m from orders")
def fn_math(spark, sf):
    k, t = F.col("o_orderkey"), F.col("o_totalprice").cast("double")
    return X.table(spark, sf, "orders").select(
        "o_orderkey", F.round(F.ln(t), 6).alias("l"), F.round(F.sqrt(t), 6).alias("s"), F.round(F.pow(F.lit(1.01), k % 50), 6).alias("p"), F.signum(k % 3 - 1).cast("int").alias("g"), F.greatest(k % 7 - 3, F.lit(0)).cast("long").alias("c"), (k % 9).cast("long").alias("m"),
    )


@query("fn_dates", "select o_orderkey, strftime(d, '%Y-%m-%d') as iso, (isodow(d) - 1)::int as weekday, (d + interval 3 month)::date as later, (d + interval 2 year)::date as years_on, (d - date '1992-01-01')::int as age from (select o_orderkey, o_orderdate::date as d from orders)")
def fn_dates(spark, sf):
    d = F.col("o_orderdate").cast("date")
    return X.table(spark, sf, "orders").select("o_orderkey", F.date_format(d, "yyyy-MM-dd").alias("iso"), F.weekday(d).alias("weekday"), F.add_months(d, 3).alias("later"), F.add_months(d, 24).alias("years_on"), F.datediff(d, F.lit("1992-01-01").cast("date")).alias("age"))


@query("fn_strings", "select l_returnflag || '-' || l_linestatus as joined, l_returnflag = 'A' as starts, count(*) as n from lineitem group by 1, 2")
def fn_strings(spark, sf):
    rows = X.table(spark, sf, "lineitem").select(F.array_join(F.array("l_returnflag", "l_linestatus"), "-").alias("joined"))
    return rows.groupBy("joined", F.col("joined").startswith("A").alias("starts")).agg(F.count(F.lit(1)).alias("n"))


@query("fn_nulls", "select symbol, session_date, coalesce(volume, 0) as filled, last_value(volume ignore nulls) over (partition by symbol order by session_date) as carried, volume is not null as present from panel")
def fn_nulls(spark, sf):
    return X.panel(spark, sf).select("symbol", "session_date", F.coalesce("volume", F.lit(0)).alias("filled"), F.last("volume", ignorenulls=True).over(S.so_far()).alias("carried"), F.col("volume").isNotNull().alias("present"))


@query("fn_json", "select symbol, session_date, volume from bars")
def fn_json(spark, sf):
    rows = X.trade_bars(spark, sf).select("symbol", "session_date", F.to_json(F.struct("volume")).alias("payload"))
    return rows.select("symbol", "session_date", F.get_json_object("payload", "$.volume").cast("long").alias("volume"))


@query("fn_arrays", "select symbol, array_to_string(list_sort(array_agg(distinct year(session_date))), ',') as years from bars group by symbol")
def fn_arrays(spark, sf):
    return X.trade_bars(spark, sf).groupBy("symbol").agg(F.array_join(F.array_sort(F.collect_set(F.year("session_date"))), ",").alias("years"))


@query("fn_hash", "select o_orderkey, sha256(o_orderkey::varchar) as sha from orders")
def fn_hash(spark, sf):
    return X.table(spark, sf, "orders").select("o_orderkey", F.sha2(F.col("o_orderkey").cast("string"), 256).alias("sha"))


@query("event_bars", f"select event_type as symbol, date_trunc('hour', ts) as session_date, {r('arg_min(value, row(ts, event_id))::double')} as open, {r('max(value)::double')} as high, {r('min(value)::double')} as low, {r('arg_max(value, row(ts, event_id))::double')} as close, count(*) as volume from events group by 1, 2")
def event_bars(spark, sf):
    out = X.tick_bars(spark, sf).drop("adj_close")
    return out.withColumns({c: F.round(c, 6) for c in Q.PRICES}).withColumn("session_date", F.col("session_date").cast("timestamp_ntz"))


# streams: each is drained and its tables are read


TICK_FILES = 32


def _ticks(spark, sf) -> str:
    """Files of ticks as they arrive: of 20,000 rows, or about TICK_FILES larger ones."""
    path = new_path(spark, "ticks")
    rows = X.table(spark, sf, "events").select(F.col("event_type").alias("symbol"), F.col("ts").cast("timestamp").alias("ts"), F.col("value").cast("double").alias("price"), F.lit(1).cast("long").alias("quantity"), F.col("event_id").alias("tick_id"))
    # larger tables come in larger files, so that batches, each of which costs the driver the same, don't get more and more
    rows.write.option("maxRecordsPerFile", max(20_000, rows.count() // TICK_FILES)).parquet(path)
    return path


TICKS = "symbol string, ts timestamp, price double, quantity long, tick_id long"

@query("st_01_arrivals", "select event_type as symbol, count(*) as n from events group by 1")
def st_01(spark, sf):
    out, stream = new_path(spark, "arrived"), arrivals.arrivals(spark, _ticks(spark, sf), TICKS, 2)
    stream.writeStream.format("parquet").option("path", out).option("checkpointLocation", new_path(spark, "offsets")).trigger(availableNow=True).start().awaitTermination()
    return spark.read.schema(TICKS).parquet(out).groupBy("symbol").agg(F.count(F.lit(1)).alias("n"))


def _landed(spark, sf) -> tuple[str, object]:
    path, rows = new_path(spark, "landed"), X.dirty(spark, sf).drop("Vendor").withColumnRenamed("Adj Close", "adj_close").withColumnRenamed("Stock Splits", "stock_splits")
    rows.write.parquet(path)
    return path, rows.schema


@query("st_02_quality_gate", "select bad, count(*) as n from (select " + " or ".join(f"coalesce({c}, false)" for k, c in X.RULES.items() if k not in ("verified_closed_session",)) + " as bad from dirty_days) group by bad")
def st_02(spark, sf):
    path, schema = _landed(spark, sf)
    clean, bad = new_path(spark, "clean"), new_path(spark, "quarantine")
    stream = arrivals.arrivals(spark, path, schema, 1000)
    arrivals.run_gate(stream, clean, bad, new_path(spark, "offsets")).awaitTermination()
    good = spark.read.parquet(clean).select(F.lit(False).alias("bad"))
    return good.unionByName(spark.read.parquet(bad).select(F.lit(True).alias("bad"))).groupBy("bad").agg(F.count(F.lit(1)).alias("n"))


FINAL = "case when session_kind in ('muhurat', 'special') then 1290 else 960 end"
view("session_ticks", f"select event_type, session_date, ts, event_id, value::double as price, {FINAL} as final from events join event_calendar on session_date = ts::date where expected_open and hour(ts) * 60 + minute(ts) < {FINAL}")


@query("st_03_completed_bars", f"""select event_type as symbol, session_date, {r('arg_min(price, row(ts, event_id))')} as open, {r('max(price)')} as high, {r('min(price)')} as low, {r('arg_max(price, row(ts, event_id))')} as close, count(*) as volume
  from session_ticks cross join (select max(ts) - interval 12 hour as now from events)
  where session_date < now::date or session_date = now::date and hour(now) * 60 + minute(now) >= final group by 1, 2""")
def st_03(spark, sf):
    """Ticks arrive in the order of their table; bars come out of sessions that are over twelve hours before the last tick."""
    root, calendar = new_path(spark, "bars"), X.exchange_calendar(spark, sf, "events", "ts")
    arrivals.add_ticks(arrivals.arrivals(spark, _ticks(spark, sf), TICKS, 8), root, calendar, new_path(spark, "offsets")).awaitTermination()
    now = X.table(spark, sf, "events").agg((F.max("ts").cast("timestamp") - F.expr("interval 12 hours")).alias("now")).first()["now"]
    rows = arrivals.completed_bars(spark, root, calendar, F.lit(now))
    return rows.select("symbol", "session_date", *[F.round(c, 6).alias(c) for c in ("open", "high", "low", "close")], "volume")


@query("st_04_revisions", "select symbol, count(*) as n from bars group by symbol")
def st_04(spark, sf):
    """Two snapshots arrive; the second replaces the first within its range, so that every bar is there once."""
    path, root = new_path(spark, "snapshots"), new_path(spark, "store")
    rows = X.trade_bars(spark, sf).select("symbol", "session_date", "volume")
    rows = X.stored(rows, "bars")
    rows.where("session_date < '1998-01-01'").write.parquet(path)
    offsets = new_path(spark, "offsets")
    schema = "symbol string, session_date date, volume long"
    arrivals.revise(arrivals.arrivals(spark, path, schema, 1000), root, offsets, ["symbol"]).awaitTermination()
    rows.where("session_date >= '1996-01-01'").write.mode("append").parquet(path)
    arrivals.revise(arrivals.arrivals(spark, path, schema, 1000), root, offsets, ["symbol"]).awaitTermination()
    return store.published(spark, root).groupBy("symbol").agg(F.count(F.lit(1)).alias("n"))
