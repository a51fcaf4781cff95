"""Bars, calendars and snapshots that the queries derive from the driver's tables, in Spark and as SQL views."""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sessionloom.functions.columns import order_key
from sessionloom.operators.bars import bars
from sessionloom.operators.sessions import align, days, make_calendar
from sessionloom.plans.registry import view
from sessionloom.sources.scratch import stored

BENCHMARK = "NO"
ORDER = {"l_orderkey": 11, "l_linenumber": 2, "l_partkey": 9, "l_suppkey": 8, "l_cents": 8}


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def trade_bars(spark: SparkSession, sf: str) -> DataFrame:
    """Instrument: return flag and line status; session: ship date; price: extended price by quantity."""
    c = F.col
    # the key's first two numbers, where it isn't null; cents are rounded for a session's first and last rows only
    known = reduce(and_, [c(n).isNotNull() for n in ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice")])
    lead = F.when(known, order_key(**{n: ORDER[n] for n in ("l_orderkey", "l_linenumber")}).cast("long"))
    return bars(
        table(spark, sf, "lineitem").withColumn("l_cents", F.round(c("l_extendedprice") * 100)), F.concat("l_returnflag", "l_linestatus"), c("l_shipdate").cast("date"),
        c("l_extendedprice").cast("double") / c("l_quantity").cast("double"), c("l_quantity"), order_key(**ORDER), 1 - c("l_discount").cast("double"), lead,
    )


def trade_dates(spark: SparkSession, sf: str) -> DataFrame:
    """session_date: the first and the last ship date, which bound calendars and folds, in two rows."""
    ends = table(spark, sf, "lineitem").agg(F.array(F.min("l_shipdate"), F.max("l_shipdate")).alias("ends"))
    return ends.select(F.explode("ends").alias("session_date")).select(F.col("session_date").cast("date").alias("session_date"))


view("bars", """
select symbol, session_date, open, high, low, close, close * adj as adj_close, volume from (
  select l_returnflag || l_linestatus as symbol, l_shipdate::date as session_date,
         arg_min(l_extendedprice::double / l_quantity::double, row(l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice)) as open,
         max(l_extendedprice::double / l_quantity::double) as high, min(l_extendedprice::double / l_quantity::double) as low,
         arg_max(l_extendedprice::double / l_quantity::double, row(l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice)) as close,
         arg_max(1 - l_discount::double, row(l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice)) as adj,
         sum(l_quantity)::bigint as volume
  from lineitem group by 1, 2)""")


def tick_bars(spark: SparkSession, sf: str) -> DataFrame:
    """Hourly bars of the events table: symbol event_type, session_date the hour."""
    c = F.col
    rows = table(spark, sf, "events").withColumn("micros", F.unix_micros(c("ts").cast("timestamp")))
    return bars(rows, c("event_type"), F.date_trunc("hour", c("ts").cast("timestamp")), c("value").cast("double"), F.lit(1), order_key(micros=19, event_id=18))


def instruments(spark: SparkSession, sf: str) -> DataFrame:
    """symbol, kind (the benchmark is an index), sector."""
    symbols = table(spark, sf, "lineitem").select(F.concat("l_returnflag", "l_linestatus").alias("symbol")).distinct()
    return symbols.select("symbol", F.when(F.col("symbol") == BENCHMARK, "index").otherwise("equity").alias("kind"), F.substring("symbol", 2, 1).alias("sector"))


view("instruments", f"select distinct symbol, case when symbol = '{BENCHMARK}' then 'index' else 'equity' end as kind, substr(symbol, 2, 1) as sector from bars")


def span(bar_table: DataFrame) -> DataFrame:
    return bar_table.agg(F.min("session_date").alias("start"), F.date_add(F.max("session_date"), 1).alias("end"))


def every_day(bar_table: DataFrame) -> DataFrame:
    """Calendar on which each day between the first and the last bar is open."""
    return days(span(bar_table)).withColumn("expected_open", F.lit(True))


def panel(spark: SparkSession, sf: str) -> DataFrame:
    """Bars on every day; kind and observed_at (the day after, at midnight) as features need them. The source is read once."""
    bar_table = stored(trade_bars(spark, sf), "bars")
    kind = F.when(F.col("symbol") == BENCHMARK, "index").otherwise("equity")
    out = align(bar_table, every_day(bar_table)).withColumns({"kind": kind, "observed_at": F.when(F.col("price_valid"), F.date_add("session_date", 1))})
    return stored(out, "panel")


view("open_days", "select unnest(generate_series((select min(session_date) from bars)::timestamp, (select max(session_date) from bars)::timestamp, interval 1 day))::date as session_date")
view("grid", "select symbol, session_date from (select distinct symbol from bars) s cross join open_days")
view("joined", """
select g.symbol, g.session_date, open, high, low, close, adj_close, volume, close is not null as price_valid, close is null as gap,
       close is not null and adj_close is not null as feature_eligible
from grid g left join bars b on g.symbol = b.symbol and g.session_date = b.session_date""")
view("panel", f"""
select *, feature_eligible and coalesce(volume > 0, false) as volume_feature_eligible,
       case when gap then 'excluded_no_imputation' else '' end as gap_disposition,
       sum(case when feature_eligible then 0 else 1 end) over (partition by symbol order by session_date)::bigint as segment_id,
       bool_and(feature_eligible) over (partition by symbol order by session_date rows between current row and 1 following)
         and count(*) over (partition by symbol order by session_date rows between current row and 1 following) = 2 as target_1d_eligible,
       bool_and(feature_eligible) over (partition by symbol order by session_date rows between current row and 5 following)
         and count(*) over (partition by symbol order by session_date rows between current row and 5 following) = 6 as target_5d_eligible,
       case when symbol = '{BENCHMARK}' then 'index' else 'equity' end as kind, case when price_valid then session_date + 1 end as observed_at
from joined""")


def reference(all_days: DataFrame) -> dict[str, DataFrame]:
    """A calendar reference by rule: New Year and Christmas closed, an evening session on the last Sunday of October, Saturdays opened in March and
    September, two days closed beside that, and in leap years one day on both lists."""
    d = F.col("session_date")
    saturday = (F.weekday(d) == 5) & (F.dayofmonth(d) <= 7)
    month, day, year = F.month(d), F.dayofmonth(d), F.year(d)
    return {
        "annual": all_days.groupBy(year.alias("year")).agg(F.max(F.when((month == 10) & (F.weekday(d) == 6), d)).alias("muhurat_date")).withColumn("source", F.concat(F.lit("circular-"), F.col("year").cast("string"))),
        "closed": all_days.where(((month == 1) & (day == 1)) | ((month == 12) & (day == 25))),
        "extra_open": all_days.where(saturday & month.isin(3, 9)).withColumn("url", F.concat(F.lit("open-"), d.cast("string"))),
        "extra_closed": all_days.where(((month == 5) & (day == 2)) | ((month == 11) & (day == 3)) | (saturday & (month == 3) & (year % 4 == 0))).withColumn("url", F.concat(F.lit("closed-"), d.cast("string"))),
    }


def years_of(bar_table: DataFrame) -> DataFrame:
    return days(bar_table.agg(F.make_date(F.year(F.min("session_date")), F.lit(1), F.lit(1)).alias("start"), F.make_date(F.year(F.max("session_date")) + 1, F.lit(1), F.lit(1)).alias("end")))


def exchange_calendar(spark: SparkSession, sf: str, source: str = "lineitem", date: str = "l_shipdate") -> DataFrame:
    # the dates alone bound the calendar
    dates = table(spark, sf, source).select(F.col(date).cast("date").alias("session_date"))
    all_days = stored(years_of(dates), "days")
    return make_calendar(all_days, **reference(all_days), version="rule-1")


YEAR_DAYS = "select unnest(generate_series(make_date(year((select min({0}) from {1})), 1, 1)::timestamp, make_date(year((select max({0}) from {1})), 12, 31)::timestamp, interval 1 day))::date as session_date"
CALENDAR = """
select session_date, session_kind <> 'closed' as expected_open, session_kind, source, 'rule-1' as calendar_version from (
  select session_date,
         case when is_shut then 'closed' when session_date = muhurat then 'muhurat' when is_extra then case when dow > 5 then 'special' else 'regular' end
              when dow <= 5 and not is_closed then 'regular' else 'closed' end as session_kind,
         case when is_shut then 'closed-' || session_date::varchar when is_extra then 'open-' || session_date::varchar else 'circular-' || year(session_date)::varchar end as source
  from (
    select session_date, isodow(session_date) as dow, max(case when month(session_date) = 10 and isodow(session_date) = 7 then session_date end) over (partition by year(session_date)) as muhurat,
           (month(session_date) = 1 and day(session_date) = 1) or (month(session_date) = 12 and day(session_date) = 25) as is_closed,
           isodow(session_date) = 6 and day(session_date) <= 7 and month(session_date) in (3, 9) as is_extra,
           (month(session_date) = 5 and day(session_date) = 2) or (month(session_date) = 11 and day(session_date) = 3)
             or (isodow(session_date) = 6 and day(session_date) <= 7 and month(session_date) = 3 and year(session_date) % 4 = 0) as is_shut
    from {0}))"""
view("year_days", YEAR_DAYS.format("session_date", "bars"))
view("calendar", CALENDAR.format("year_days"))
view("event_days", YEAR_DAYS.format("ts", "events"))
view("event_calendar", CALENDAR.format("event_days"))

START, END = "1996-01-01", "1998-07-01"


def dirty(spark: SparkSession, sf: str) -> DataFrame:
    """Landed bars of a provider with defects planted by day: text, signs, fractions, copies, nulls, times, actions."""
    d = F.datediff("session_date", F.lit("1995-01-01").cast("date"))
    rows = trade_bars(spark, sf).withColumn("d", d)
    rows = rows.withColumn("copy", F.explode(F.sequence(F.lit(0), F.when(F.col("d") % 107 == 0, 1).otherwise(0))))
    # one instrument comes in descending order
    n = F.when(F.col("symbol") == "RF", -F.col("d")).otherwise(F.col("d"))
    ts = F.when(F.col("d") % 151 == 0, None).when(F.col("d") % 137 == 0, F.col("session_date").cast("timestamp_ntz") + F.expr("interval 555 minutes")).otherwise(F.col("session_date").cast("timestamp_ntz"))
    volume = F.when(F.col("d") % 157 == 0, None).when(F.col("d") % 127 == 0, 0.0).when(F.col("d") % 103 == 0, F.col("volume") + 0.5).when(F.col("d") % 163 == 0, F.col("volume") * 50.0).otherwise(F.col("volume").cast("double"))
    close = F.when(F.col("d") % 139 == 0, "n/a").otherwise(F.when(F.col("d") % 101 == 0, -F.col("close")).otherwise(F.col("close")).cast("string"))
    return rows.select(
        "symbol", F.when(F.col("symbol") == BENCHMARK, "index").otherwise("equity").alias("kind"), (n * 2 + F.col("copy")).cast("long").alias("source_row"), ts.alias("ts"),
        F.lit(START).cast("date").alias("start"), F.lit(END).cast("date").alias("end"), F.col("open").alias("Open"), F.when(F.col("d") % 113 == 0, F.col("low") / 2).otherwise(F.col("high")).alias("High"),
        F.col("low").alias("Low"), close.alias("Close"), F.when(F.col("d") % 109 != 0, F.when(F.col("d") % 167 == 0, -F.col("adj_close")).otherwise(F.col("adj_close"))).alias("Adj Close"), volume.alias("Volume"),
        F.when(F.col("d") % 131 == 0, 1.5).when(F.col("d") % 149 == 0, -1.0).otherwise(0.0).alias("Dividends"), F.lit(0.0).alias("Stock Splits"), F.lit("x").alias("Vendor"),
    )


KNOWN = ["symbol", "kind", "source_row", "ts", "start", "end", "Open", "High", "Low", "Close", "Adj Close", "Volume", "Dividends", "Stock Splits"]
view("dirty", f"""
select symbol, kind, source_row, ts, ts::date as session_date, open, high, low, close, close_text, adj_close, volume, dividends, stock_splits from (
  select symbol, case when symbol = '{BENCHMARK}' then 'index' else 'equity' end as kind, ((case when symbol = 'RF' then -d else d end) * 2 + copy)::bigint as source_row,
         case when d % 151 = 0 then null when d % 137 = 0 then session_date::timestamp + interval 555 minute else session_date::timestamp end as ts,
         open, case when d % 113 = 0 then low / 2 else high end as high, low, case when d % 139 = 0 then null when d % 101 = 0 then -close else close end as close, d % 139 = 0 as close_text,
         case when d % 109 = 0 then null when d % 167 = 0 then -adj_close else adj_close end as adj_close,
         case when d % 157 = 0 then null when d % 127 = 0 then 0.0 when d % 103 = 0 then volume + 0.5 when d % 163 = 0 then volume * 50.0 else volume end::double as volume,
         case when d % 131 = 0 then 1.5 when d % 149 = 0 then -1.0 else 0.0 end::double as dividends, 0.0::double as stock_splits
  from (select *, (session_date - date '1995-01-01') as d from bars) b
  join (select 0 as copy union all select 1) k on copy = 0 or d % 107 = 0)""")
RULES = {
    "invalid_date": "ts is null", "non_daily_timestamp": "ts <> date_trunc('day', ts)", "duplicate_date": "session_date is not null and count(*) over (partition by symbol, session_date) > 1",
    "date_out_of_range": f"session_date < date '{START}' or session_date >= date '{END}'", "invalid_numeric": "close_text", "invalid_price": "close is null or close <= 0",
    "invalid_adjusted_close": "adj_close <= 0", "invalid_ohlc_order": "high < greatest(open, high, low, close) or low > least(open, high, low, close)",
    "invalid_volume": "volume < 0 or volume % 1 <> 0", "invalid_corporate_action": "dividends < 0", "verified_closed_session": "not expected_open",
}
view("dirty_days", "select d.*, c.expected_open from dirty d left join (select session_date as day, expected_open from calendar) c on d.session_date = c.day")
view("ruled", "select *, " + ", ".join(f"coalesce({sql}, false) as {name}" for name, sql in RULES.items()) + " from dirty_days")
view("judged", f"select *, {' or '.join(RULES)} as bad from (select symbol, kind, source_row, ts, session_date, open, high, low, close, adj_close, volume, dividends, stock_splits, {', '.join(RULES)} from ruled)")
