"""Queries on features, analytics, signals, labels, evaluation and publication."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from sessionloom.config import Analytics, Features, Models, Signals
from sessionloom.operators import analytics as A
from sessionloom.operators import bundles as B
from sessionloom.operators import evaluate as E
from sessionloom.operators import features as FT
from sessionloom.operators import labels as L
from sessionloom.operators import linear as LN
from sessionloom.operators import models as M
from sessionloom.operators import publish as P
from sessionloom.operators import sessions as S
from sessionloom.operators import signals as G
from sessionloom.operators import slices as SL
from sessionloom.plans import fixtures as X
from sessionloom.plans.registry import ORACLES, QUERIES, query, r, view, with_views
from sessionloom.sources import store
from sessionloom.sources.scratch import new_path, scratch_dir
from sessionloom.sources.store import publish, published, readable

YEAR = "sqrt(252.0::double)"


def _features(spark, sf):
    """Features that a query reads once: what it doesn't return isn't computed."""
    return FT.features(X.panel(spark, sf))


def _stored_features(spark, sf):
    """Features that a query reads several times."""
    return X.stored(_features(spark, sf), "features")


# the feature views restate the definitions in another way: recursions as scaled running sums over the whole run

view("run0", """
select symbol, segment_id, session_date, adj_close as c, high * (adj_close / close) as h, low * (adj_close / close) as l,
       case when volume_feature_eligible and kind <> 'index' then volume::double end as v,
       (row_number() over (partition by symbol, segment_id order by session_date) - 1)::int as pos, lag(adj_close) over (partition by symbol, segment_id order by session_date) as pc
from panel where feature_eligible""")
view("run1", """
select *, ln(c / pc) as log_return, case when pc is not null then greatest(c - pc, 0.0::double) end as gain, case when pc is not null then greatest(pc - c, 0.0::double) end as loss,
       case when pc is null then h - l else greatest(h - l, abs(h - pc), abs(l - pc)) end as tr
from run0""")
W = "partition by symbol, segment_id order by session_date"


def _recursive(x: str, q: float, start: int, seed: int, shown: int) -> str:
    first = x if seed == 1 else f"avg({x}) over ({W} rows between {seed - 1} preceding and current row)"
    return f"""case when pos >= {shown} then pow({q!r}::double, pos) * sum(seeded) over ({W} rows unbounded preceding) end""", f"""case when pos < {start} then 0 when pos = {start} then {first} else {1 - q!r} * {x} end * pow({q!r}::double, -pos)"""


def _rec(name: str, x: str, q: float, start: int = 0, seed: int = 1, shown: int = 0, source: str = "run1") -> None:
    outer, inner = _recursive(x, q, start, seed, shown)
    view(name, f"select symbol, session_date, {outer} as y from (select *, {inner} as seeded from {source})")


for _n in (12, 26, 50):
    _rec(f"ema{_n}", "c", 1 - 2 / (_n + 1), shown=_n - 1)
_rec("up14", "gain", 1 - 1 / 14, 14, 14, 14)
_rec("down14", "loss", 1 - 1 / 14, 14, 14, 14)
_rec("atr14", "tr", 1 - 1 / 14, 13, 14, 13)
view("run2", "select a.*, e12.y as ema_12, e26.y as ema_26, e50.y as ema_50, u.y as up, d.y as down, t.y as atr_14, e12.y - e26.y as macd from run1 a " + " ".join(
    f"join {v} {k} on a.symbol = {k}.symbol and a.session_date = {k}.session_date" for v, k in (("ema12", "e12"), ("ema26", "e26"), ("ema50", "e50"), ("up14", "u"), ("down14", "d"), ("atr14", "t"))))
_rec("sig9", "macd", 1 - 2 / 10, 25, 1, 33, "run2")


def _full(agg: str, x: str, n: int, first: str | None = None) -> str:
    frame = f"({W} rows between {first or f'{n - 1} preceding and current row'})"
    return f"case when count({x}) over {frame} = {n} then {agg}({x}) over {frame} end"


view("run3", "select a.*, s.y as macd_signal from run2 a join sig9 s on a.symbol = s.symbol and a.session_date = s.session_date")
view("feat_run", "select symbol, session_date, pos + 1 as segment_age, " + ", ".join([
    *[f"c / lag(c, {n}) over ({W}) - 1 as return_{n}d" for n in (1, 5, 20)], "log_return as log_return_1d", *[f"{_full('avg', 'c', n)} as sma_{n}" for n in (5, 10, 20, 50, 200)],
    "ema_12, ema_26, ema_50", "case when down = 0 and up > 0 then 100.0 when down = 0 and up = 0 then 50.0 else 100 - 100 / (1 + up / nullif(down, 0)) end as rsi_14", "macd, macd_signal, macd - macd_signal as macd_histogram",
    f"{_full('avg', 'c', 20)} as bollinger_middle, 2 * {_full('stddev_pop', 'c', 20)} as spread", "atr_14, atr_14 / c as atr_fraction", f"c - lag(c, 10) over ({W}) as momentum_10, c / lag(c, 10) over ({W}) - 1 as roc_10",
    *[f"{_full('stddev_samp', 'log_return', n)} * {YEAR} as volatility_{n}" for n in (20, 60)], f"{_full('max', 'h', 252)} as high_252, {_full('min', 'l', 252)} as low_252", "c",
    f"v / nullif(lag(v) over ({W}), 0) - 1 as volume_change_1d, {_full('avg', 'v', 20)} as volume_sma_20, v / nullif({_full('avg', 'v', 20, '20 preceding and 1 preceding')}, 0) as relative_volume_20",
]) + " from run3")
view("feat_all", "select *, " + ", ".join(f"c / sma_{n} - 1 as distance_sma_{n}" for n in (5, 10, 20, 50, 200)) + """,
  bollinger_middle + spread as bollinger_upper, bollinger_middle - spread as bollinger_lower, 2 * spread / bollinger_middle as bollinger_width,
  (c - (bollinger_middle - spread)) / nullif(2 * spread, 0) as bollinger_percent_b, c / high_252 - 1 as distance_high_252, c / low_252 - 1 as distance_low_252 from feat_run""")
CORE = " and ".join(f"f.{c} is not null" for c in Features().core)
view("feats", f"""select p.symbol, p.session_date, coalesce(f.segment_age, 0)::bigint as segment_age, p.feature_eligible as input_valid, p.feature_eligible and {CORE} as core_ready,
  case when p.feature_eligible then max(p.observed_at) over (partition by p.symbol order by p.session_date) end as available_at, """ + ", ".join(f"f.{n}" for n in FT.feature_names()) + " from panel p left join feat_all f on p.symbol = f.symbol and p.session_date = f.session_date")

PRICE_LEVEL = {"momentum_10", "macd", "macd_signal", "macd_histogram", "atr_14", "high_252", "low_252", "volume_sma_20", "bollinger_middle", "bollinger_upper", "bollinger_lower", "bollinger_width"}


def _digits(c: str) -> int:
    return 3 if c in PRICE_LEVEL or c.startswith(("sma_", "ema_")) else 6


def _window_query(name: str, *columns: str) -> None:
    def run(spark, sf):
        return _features(spark, sf).select("symbol", "session_date", *[F.round(c, _digits(c)).alias(c) for c in columns])

    QUERIES[name] = run
    ORACLES[name] = with_views(f"select symbol, session_date, {', '.join(f'{r(c, _digits(c))} as {c}' for c in columns)} from feats")


_window_query("wn_01_returns", "return_1d", "return_5d", "return_20d")
_window_query("wn_02_log_return", "log_return_1d")
_window_query("wn_03_sma", "sma_5", "sma_10", "sma_20", "sma_50", "sma_200")
_window_query("wn_04_distance_sma", *[f"distance_sma_{n}" for n in (5, 10, 20, 50, 200)])
_window_query("wn_05_ema", "ema_12", "ema_26", "ema_50")
_window_query("wn_06_rsi", "rsi_14")
_window_query("wn_07_macd", "macd")
_window_query("wn_08_macd_signal", "macd_signal")
_window_query("wn_09_macd_histogram", "macd_histogram")
_window_query("wn_10_bollinger", "bollinger_middle", "bollinger_upper", "bollinger_lower")
_window_query("wn_11_bollinger_width", "bollinger_width")
_window_query("wn_12_bollinger_percent_b", "bollinger_percent_b")
_window_query("wn_13_atr", "atr_14")
_window_query("wn_14_atr_fraction", "atr_fraction")
_window_query("wn_15_momentum", "momentum_10", "roc_10")
_window_query("wn_16_volatility", "volatility_20", "volatility_60")
_window_query("wn_17_extremes", "high_252", "low_252")
_window_query("wn_18_distance_extremes", "distance_high_252", "distance_low_252")
_window_query("wn_19_volume", "volume_change_1d", "volume_sma_20")
_window_query("wn_20_relative_volume", "relative_volume_20")


@query("cal_13_core_ready", "select symbol, session_date, core_ready from feats")
def cal_13(spark, sf):
    return _features(spark, sf).select("symbol", "session_date", "core_ready")


@query("wn_30_prefix", "select 0::bigint as changed, count(*) filter (where session_date < date '1999-01-01') as compared from panel")
def wn_30(spark, sf):
    """Features of a prefix of the sessions are those of the whole run."""
    panel = X.panel(spark, sf)
    names = FT.feature_names()
    keep = ["symbol", "session_date", *names]
    part = FT.features(panel.where("session_date < '1999-01-01'")).select(keep)
    out = store.reconcile(FT.features(panel).where("session_date < '1999-01-01'").select(keep), part, ["symbol", "session_date"], {n: 1e-6 for n in names})
    return out.select((F.col("left_only") + F.col("right_only") + F.col("different")).alias("changed"), (F.col("equal") + F.col("different")).alias("compared"))


@query("wn_31_sliced", f"select symbol, session_date, segment_age, core_ready, available_at, {', '.join(f'{r(c, _digits(c))} as {c}' for c in FT.feature_names())} from feats")
def wn_31(spark, sf):
    """All features by slices of runs, short ones as runs here are; what is added up in a task is a symbol's half year."""
    half = F.year("session_date") * 2 + (F.month("session_date") > 6).cast("int")
    table = SL.sliced_features(X.panel(spark, sf), half, rows=512)
    return table.select("symbol", "session_date", "segment_age", "core_ready", "available_at", *[F.round(c, _digits(c)).alias(c) for c in FT.feature_names()])


@query("ag_04_coverage", " union all ".join(f"select symbol, '{n}' as feature, count({n}) as non_null, count(*) - count({n}) as nulls from feats group by symbol" for n in FT.feature_names()))
def ag_04(spark, sf):
    return FT.coverage(_features(spark, sf), FT.feature_names())


@query("ag_05_build_summary", "select symbol, count(*) as n_rows, count(*) filter (where input_valid) as n_valid, count(*) filter (where core_ready) as n_core_ready, max(session_date) filter (where core_ready) as latest_core_session from feats group by symbol")
def ag_05(spark, sf):
    return FT.build_summary(_features(spark, sf))


@query("ag_30_bounds", """select count(*) filter (where rsi_14 is not null and day(session_date) = 5) as bad_rsi, count(*) filter (where atr_14 is not null and day(session_date) = 6) as bad_atr,
  count(*) filter (where not input_valid and day(session_date) % 2 = 0) + count(*) filter (where not input_valid and day(session_date) = 2) as filled_gaps, count(*) filter (where day(session_date) = 2) as repeated from feats""")
def ag_30(spark, sf):
    """The feature table with faults planted by day of the month."""
    day, rows = F.dayofmonth("session_date"), _stored_features(spark, sf)
    rows = rows.withColumns({
        "rsi_14": F.when(F.col("rsi_14").isNotNull() & (day == 5), 101.0).otherwise(F.col("rsi_14")), "atr_14": F.when(F.col("atr_14").isNotNull() & (day == 6), -1.0).otherwise(F.col("atr_14")),
        "return_1d": F.when(~F.col("input_valid") & (day % 2 == 0), 0.0).otherwise(F.col("return_1d")),
    })
    return FT.bound_violations(rows.unionByName(rows.where(day == 2)))


# analytics

view("priced", "select symbol, session_date, case when feature_eligible then adj_close end as price from panel")
view("common", "select min(session_date) as first_session, max(session_date) as last_session, count(*) as common_dates from (select session_date from priced group by session_date having count(price) = (select count(distinct symbol) from priced))")
view("rets0", "select symbol, session_date, price, price / lag(price) over (partition by symbol order by session_date) - 1 as ret, price / max(price) over (partition by symbol order by session_date) - 1 as drawdown, first_value(price) over (partition by symbol order by session_date) as first_price, first_session, last_session from priced cross join common where session_date between first_session and last_session")
view("rets", f"select a.*, b.ret as bench from rets0 a left join rets0 b on a.session_date = b.session_date and b.symbol = '{X.BENCHMARK}'")
view("perf0", """select symbol, first_session, last_session, count(price) as usable_price_rows, count(*) - count(price) as missing_prices, count(ret) as n, count(*) filter (where ret is not null and bench is not null) as pairs,
  max(price) filter (where session_date = last_session) / max(price) filter (where session_date = first_session) - 1 as endpoint_return, stddev_samp(ret) as sd, avg(ret) as mean, sqrt(avg(pow(least(ret, 0), 2))) as down, min(drawdown) as max_drawdown,
  covar_samp(ret, bench) as cov, var_samp(case when ret is not null then bench end) as var from rets group by 1, 2, 3""")
view("perf", f"""select symbol, first_session, last_session, usable_price_rows, missing_prices, n as daily_return_observations, pairs as benchmark_pairs, endpoint_return,
  pow(1 + endpoint_return, 1 / ((last_session - first_session) / 365.25::double)) - 1 as endpoint_cagr, case when n >= 30 then sd * {YEAR} end as annualized_volatility, case when n >= 30 and sd > 0 then mean * {YEAR} / sd end as sharpe,
  case when n >= 30 and down > 0 then mean * {YEAR} / down end as sortino, max_drawdown, case when pairs >= 30 and var > 0 then cov / var end as beta,
  endpoint_return - (select endpoint_return from perf0 where symbol = '{X.BENCHMARK}') as endpoint_excess from perf0""")


def _prices(spark, sf):
    return A.prices(X.panel(spark, sf))


def performance(spark, sf):
    """Performance and risk per instrument; the flagship query."""
    out = A.metrics(_prices(spark, sf), Analytics(benchmark=X.BENCHMARK))
    return out.select(*[F.round(c, 6).alias(c) if t == "double" else F.col(c) for c, t in out.dtypes])


DOUBLES = ["endpoint_return", "endpoint_cagr", "annualized_volatility", "sharpe", "sortino", "max_drawdown", "beta", "endpoint_excess"]
INTS = ["symbol", "first_session", "last_session", "usable_price_rows", "missing_prices", "daily_return_observations", "benchmark_pairs"]
query("ag_performance", f"select {', '.join(INTS)}, {', '.join(f'{r(c)} as {c}' for c in DOUBLES)} from perf")(performance)


def _metric_query(name: str, *columns: str) -> None:
    QUERIES[name] = lambda spark, sf: performance(spark, sf).select("symbol", *columns)
    ORACLES[name] = with_views(f"select symbol, {', '.join(f'{r(c)} as {c}' if c in DOUBLES else c for c in columns)} from perf")


_metric_query("ag_07_price_counts", "usable_price_rows", "missing_prices", "daily_return_observations", "benchmark_pairs")
_metric_query("ag_08_endpoint_return", "endpoint_return", "endpoint_cagr")
_metric_query("ag_09_volatility", "annualized_volatility")
_metric_query("ag_10_sharpe", "sharpe")
_metric_query("ag_11_sortino", "sortino")
_metric_query("ag_12_max_drawdown", "max_drawdown")
_metric_query("ag_13_beta", "beta")
_metric_query("ag_14_excess", "endpoint_excess")


@query("ag_06_common_window", "select first_session, last_session, common_dates from common")
def ag_06(spark, sf):
    return A.common_window(_prices(spark, sf))


def _returns(spark, sf):
    return A.returns(A.window_prices(_prices(spark, sf)))


view("pair_stats", """select a.symbol, b.symbol as other, count(*) as pairs, case when count(*) >= 30 and stddev_samp(a.ret) * stddev_samp(b.ret) > 0 then covar_samp(a.ret, b.ret) / (stddev_samp(a.ret) * stddev_samp(b.ret)) end as correlation
  from rets0 a join rets0 b on a.session_date = b.session_date where a.ret is not null and b.ret is not null group by 1, 2""")


@query("ag_15_correlation", f"select symbol, other, {r('correlation')} as correlation from pair_stats")
def ag_15(spark, sf):
    return A.pair_statistics(_returns(spark, sf)).select("symbol", "other", F.round("correlation", 6).alias("correlation"))


@query("ag_16_pair_counts", "select symbol, other, pairs from pair_stats")
def ag_16(spark, sf):
    return A.pair_statistics(_returns(spark, sf)).select("symbol", "other", "pairs")


@query("ag_17_sectors", f"select sector, count(*) as instruments, {r('avg(endpoint_return)')} as mean_return, {r('avg(annualized_volatility)')} as mean_volatility, {r('avg(beta)')} as mean_beta from perf p join instruments i on p.symbol = i.symbol where p.symbol <> '{X.BENCHMARK}' group by sector")
def ag_17(spark, sf):
    out = A.sector_summary(A.metrics(_prices(spark, sf), Analytics(benchmark=X.BENCHMARK)), X.instruments(spark, sf).select("symbol", "sector"), X.BENCHMARK)
    return out.select("sector", "instruments", *[F.round(c, 6).alias(c) for c in ("mean_return", "mean_volatility", "mean_beta")])


@query("ag_32_invariants", f"""select (select count(*) from rets0 where ret is not null and day(session_date) = 5) as wrong_returns, (select count(*) from pair_stats where correlation is not null and ((symbol = 'AF' and other > 'AF') or (other = 'AF' and symbol > 'AF'))) as asymmetric,
  (select count(*) from pair_stats where correlation is not null and symbol = 'RO' and other = 'RO') as out_of_range, (select count(*) from perf where symbol = '{X.BENCHMARK}' and beta is not null) as bad_benchmark_beta""")
def ag_32(spark, sf):
    """Analytics with faults planted: returns of each fifth of a month, correlations of AF, that of RO with itself, the benchmark's beta."""
    rets, day = X.stored(_returns(spark, sf), "returns"), F.dayofmonth("session_date")
    stats = X.stored(A.pair_statistics(rets), "pairs")
    one, other = F.col("symbol"), F.col("other")
    stats = stats.withColumn("correlation", F.when((one == "AF") & (other > "AF"), F.col("correlation") / 2 + 0.1).when((one == "RO") & (other == "RO"), 2.0).otherwise(F.col("correlation")))
    table = A.metrics(rets.select("symbol", "session_date", "price"), Analytics(benchmark=X.BENCHMARK)).withColumn("beta", F.col("beta") + F.when(one == X.BENCHMARK, 1.0).otherwise(0.0))
    return A.metric_violations(rets.withColumn("ret", F.col("ret") + F.when(day == 5, 0.1).otherwise(0.0)), stats, table, X.BENCHMARK)


@query("wn_21_returns_drawdowns", f"select symbol, session_date, {r('ret')} as ret, {r('drawdown')} as drawdown from rets0")
def wn_21(spark, sf):
    return A.drawdowns(_returns(spark, sf)).select("symbol", "session_date", F.round("ret", 6).alias("ret"), F.round("drawdown", 6).alias("drawdown"))


@query("wn_22_normalized", f"select symbol, session_date, {r('price / first_price * 100')} as normalized from rets0")
def wn_22(spark, sf):
    return A.normalized(A.window_prices(_prices(spark, sf))).select("symbol", "session_date", F.round("normalized", 6).alias("normalized"))


F60 = "(partition by symbol order by session_date rows between 59 preceding and current row)"
view("rolled", f"""select symbol, session_date, case when count(ret) over {F60} = 60 then stddev_samp(ret) over {F60} * {YEAR} end as vol, count(pb) over {F60} as np, covar_samp(ret, pb) over {F60} as cov, var_samp(pb) over {F60} as var
  from (select *, case when ret is not null then bench end as pb from rets)""")


@query("wn_23_rolling_volatility", f"select symbol, session_date, {r('vol')} as rolling_volatility from rolled")
def wn_23(spark, sf):
    return A.rolling(_returns(spark, sf), Analytics(benchmark=X.BENCHMARK)).select("symbol", "session_date", F.round("rolling_volatility", 6).alias("rolling_volatility"))


@query("wn_24_rolling_beta", f"select symbol, session_date, {r('case when np = 60 and var > 0 then cov / var end')} as rolling_beta from rolled")
def wn_24(spark, sf):
    return A.rolling(_returns(spark, sf), Analytics(benchmark=X.BENCHMARK)).select("symbol", "session_date", F.round("rolling_beta", 6).alias("rolling_beta"))


@query("wn_25_trailing_median", "select symbol, session_date, base from trail_base")
def wn_25(spark, sf):
    from sessionloom.operators import quality as Q

    w = Window.partitionBy("symbol").orderBy("session_date").rowsBetween(-20, -1)
    rows = Q.clean(Q.checked(X.dirty(spark, sf), X.exchange_calendar(spark, sf)))
    v = F.col("volume").cast("double")
    return rows.select("symbol", "session_date", F.when(F.count(v).over(w) >= 10, F.percentile(v, 0.5).over(w)).alias("base"))


@query("jn_07_benchmark", f"select symbol, session_date, {r('ret')} as ret, {r('bench')} as bench from rets where ret is not null and bench is not null")
def jn_07(spark, sf):
    out = A.with_benchmark(_returns(spark, sf), X.BENCHMARK).where("ret is not null and bench is not null")
    return out.select("symbol", "session_date", F.round("ret", 6).alias("ret"), F.round("bench", 6).alias("bench"))


# signals

view("votes", """select *, case when n >= 2 then (coalesce(a, 0) + coalesce(b, 0) + coalesce(d, 0)) / n::double end as technical_score from (
  select *, (a is not null)::int + (b is not null)::int + (d is not null)::int as n from (select *, sign(ema_12 - ema_26)::int as a, sign(macd - macd_signal)::int as b, sign(return_20d)::int as d from feats))""")
view("readings", """select *, case when technical_score is null then 'Unavailable' when technical_score >= 0.5 then 'Bullish' when technical_score <= -0.5 then 'Bearish' else 'Neutral' end as signal,
  case when volatility_20 is null then 'Unavailable' when volatility_20 >= 0.35 then 'High Risk' when volatility_20 < 0.15 then 'Low' else 'Moderate' end as risk_band, relative_volume_20 >= 2 as abnormal_volume from votes""")


def _readings(spark, sf):
    return G.readings(_features(spark, sf))


@query("sg_01_score", f"select symbol, session_date, {r('technical_score')} as technical_score from readings")
def sg_01(spark, sf):
    return _readings(spark, sf).select("symbol", "session_date", F.round("technical_score", 6).alias("technical_score"))


@query("sg_02_trend", "select symbol, session_date, signal from readings")
def sg_02(spark, sf):
    return _readings(spark, sf).select("symbol", "session_date", "signal")


@query("sg_03_risk_band", "select symbol, session_date, risk_band from readings")
def sg_03(spark, sf):
    return _readings(spark, sf).select("symbol", "session_date", "risk_band")


@query("sg_04_abnormal_volume", "select symbol, session_date, abnormal_volume from readings")
def sg_04(spark, sf):
    return _readings(spark, sf).select("symbol", "session_date", "abnormal_volume")


view("latest", "select f.*, l.last as source_last_session, f.session_date <> l.last as latest_input_missing from readings f join (select symbol, max(session_date) as last, max(session_date) filter (where core_ready) as ready from feats group by symbol) l on f.symbol = l.symbol and f.session_date = l.ready")


@query("sg_05_latest", "select symbol, session_date, source_last_session, latest_input_missing from latest")
def sg_05(spark, sf):
    return G.latest_ready(_stored_features(spark, sf)).select("symbol", "session_date", "source_last_session", "latest_input_missing")


view("z_runs", "select *, sum(case when input_valid then 0 else 1 end) over (partition by symbol order by session_date) as run from feats")
view("z_past", """select symbol, session_date, return_1d, avg(return_1d) over p as m, stddev_samp(return_1d) over p as sd, count(return_1d) over p as n from z_runs where input_valid
  window p as (partition by symbol, run order by session_date rows between 60 preceding and 1 preceding)""")
view("surprise", "select l.symbol, l.session_date, case when z.n >= 40 and z.sd > 0 then (z.return_1d - z.m) / z.sd end as return_z from latest l join z_past z on l.symbol = z.symbol and l.session_date = z.session_date")


@query("sg_06_return_surprise", f"select symbol, session_date, {r('return_z')} as return_z, abs(return_z) >= 3 as statistical_anomaly from surprise")
def sg_06(spark, sf):
    return G.return_surprise(_stored_features(spark, sf)).select("symbol", "session_date", F.round("return_z", 6).alias("return_z"), "statistical_anomaly")


@query("sg_07_isolation_forest")
def sg_07(spark, sf):
    return G.isolation(_stored_features(spark, sf))


view("past_ready", "select * from (select symbol, session_date, row_number() over (partition by symbol order by session_date desc) as nth from feats where core_ready) where nth between 2 and 253")


@query("sg_07_isolation_frame", "select l.symbol, coalesce(held, 0) >= 120 as scored, true as sound from latest l left join (select symbol, count(*) as held from past_ready group by symbol) p on l.symbol = p.symbol")
def sg_07_frame(spark, sf):
    """Which symbols have enough history for a score, and whether every score is a difference of two shares and its flag says that it is below 0."""
    score, flag = F.col("isolation_score"), F.col("isolation_anomaly")
    sound = F.when(score.isNull(), flag.isNull()).otherwise(score.between(-1, 1) & (flag == (score < 0)))
    return G.isolation(_stored_features(spark, sf)).select("symbol", score.isNotNull().alias("scored"), sound.alias("sound"))


@query("sg_08_attention_frame", "select l.symbol, l.risk_band = 'High Risk' or coalesce(l.abnormal_volume, false) or coalesce(abs(s.return_z) >= 3, false) as other_terms, true as consistent from latest l join surprise s on l.symbol = s.symbol")
def sg_08_frame(spark, sf):
    """The terms of attention but the forest's, and whether attention is these or the forest's flag."""
    table = G.risk_table(_stored_features(spark, sf)).withColumn("other_terms", G.attention(F.col("risk_band"), F.col("abnormal_volume"), F.col("statistical_anomaly")))
    return table.select("symbol", "other_terms", (F.col("attention") == (F.col("other_terms") | F.coalesce("isolation_anomaly", F.lit(False)))).alias("consistent"))


@query("sg_08_attention", "select l.symbol, l.risk_band = 'High Risk' or coalesce(l.abnormal_volume, false) or coalesce(abs(s.return_z) >= 3, false) as attention from latest l join surprise s on l.symbol = s.symbol")
def sg_08(spark, sf):
    return G.risk_table(_stored_features(spark, sf)).select("symbol", "attention")


@query("sg_09_provenance", "select symbol, count(*) as training_rows, max(session_date) as training_end from past_ready group by symbol")
def sg_09(spark, sf):
    return G.provenance(_features(spark, sf))


@query("wn_28_latest_row", "select symbol, session_date from latest")
def wn_28(spark, sf):
    return G.latest_ready(_stored_features(spark, sf)).select("symbol", "session_date")


@query("wn_29_history", "select symbol, session_date from past_ready")
def wn_29(spark, sf):
    return G.history(_features(spark, sf), 252).select("symbol", "session_date")


# labels and splits

LW = "(partition by symbol order by session_date)"
view("labels", f"""select symbol, session_date, future_return_1d, target_date_1d, future_return_5d, target_date_5d, case when future_return_1d is not null then (future_return_1d > 0)::int::double end as direction_1d from (
  select symbol, session_date, {', '.join(f"case when target_{h}d_eligible then lead(adj_close, {h}) over {LW} / adj_close - 1 end as future_return_{h}d, lead(session_date, {h}) over {LW} as target_date_{h}d" for h in (1, 5))} from panel)""")
view("span", "select (min(session_date) + interval 3 year)::date as first, (max(session_date) - interval 12 month)::date as holdout, max(session_date) + 1 as stop from panel")
view("folds", """select k::int as fold, (first + to_months((3 * k)::int))::date as start, least((first + to_months((3 * k + 3)::int))::date, holdout) as stop from span cross join (select unnest(range(0, 400)) as k) where (first + to_months((3 * k)::int))::date < holdout
  union all select -1, holdout, stop from span""")
view("design", "select l.*, f.core_ready, " + ", ".join(f"f.{n}" for n in FT.feature_names()) + " from labels l join feats f on l.symbol = f.symbol and l.session_date = f.session_date")
TARGETS = Models().targets
view("marks", "select d.*, fold, start, stop, " + ", ".join(
    f"coalesce(core_ready and {t} is not null and session_date < start and target_date_5d < start, false) as train_{t}, coalesce(core_ready and {t} is not null and session_date >= start and session_date < stop and target_date_{h}d < stop, false) as test_{t}" for t, h in TARGETS.items()) + " from design d cross join folds")


def _design(spark, sf, names=None):
    """Labels and features of a row, stored; names: the features to be read, beside readiness (None: all)."""
    panel = X.panel(spark, sf)
    features = FT.features(panel)
    if names is not None:
        features = features.select("symbol", "session_date", "core_ready", *names)
    return X.stored(L.labels(panel).join(features, ["symbol", "session_date"]), "design")


def _folds(spark, sf):
    # the dates alone bound the folds
    return L.folds(X.trade_dates(spark, sf))


def _marks(spark, sf, *names):
    """Rows of all folds with the features named: what isn't named isn't computed, as rows come once per fold."""
    return L.marked(_design(spark, sf, names), _folds(spark, sf))


@query("ml_01_labels", f"select symbol, session_date, {r('future_return_1d')} as future_return_1d, target_date_1d, {r('future_return_5d')} as future_return_5d, target_date_5d, direction_1d from labels")
def ml_01(spark, sf):
    return L.labels(X.panel(spark, sf)).withColumns({c: F.round(c, 6) for c in ("future_return_1d", "future_return_5d")})


QUERIES["wn_27_forward_shift"] = lambda spark, sf: L.labels(X.panel(spark, sf)).select("symbol", "session_date", "target_date_1d", "target_date_5d")
ORACLES["wn_27_forward_shift"] = with_views("select symbol, session_date, target_date_1d, target_date_5d from labels")


@query("ml_02_folds", 'select fold, start, stop as "end" from folds')
def ml_02(spark, sf):
    return _folds(spark, sf)


@query("ml_03_purge_masks", "select symbol, session_date, fold, " + ", ".join(f"train_{t}, test_{t}" for t in TARGETS) + " from marks where " + " or ".join(f"train_{t} or test_{t}" for t in TARGETS))
def ml_03(spark, sf):
    return _marks(spark, sf).select("symbol", "session_date", "fold", *[f"{p}_{t}" for t in TARGETS for p in ("train", "test")])


view("audit", " union all ".join(f"select '{t}' as target, fold, start, stop, count(*) filter (where train_{t}) as train_rows, count(*) filter (where test_{t}) as test_rows, max(target_date_5d) filter (where train_{t}) as latest_training_outcome from marks where {' or '.join(f'train_{x} or test_{x}' for x in TARGETS)} group by fold, start, stop" for t in TARGETS))


@query("ag_24_split_audit", 'select target, fold, start, stop as "end", train_rows, test_rows, latest_training_outcome from audit')
def ag_24(spark, sf):
    return L.split_audit(_marks(spark, sf))


@query("ml_04_adequacy", "select target, count(*) filter (where fold % 4 = 1 and latest_training_outcome is not null) as leaks, count(*) filter (where train_rows < 100 or test_rows < 1 or fold % 5 = 2) as inadequate from audit group by target")
def ml_04(spark, sf):
    """The split audit with a leak planted in every fourth fold, and every fifth one left without test rows."""
    audit = L.split_audit(_marks(spark, sf))
    return L.audit_violations(audit.withColumns({
        "latest_training_outcome": F.when((F.col("fold") % 4 == 1) & F.col("latest_training_outcome").isNotNull(), F.col("start")).otherwise(F.col("latest_training_outcome")),
        "test_rows": F.when(F.col("fold") % 5 == 2, 0).otherwise(F.col("test_rows")),
    }))


NAMES = ["return_1d", "rsi_14", "relative_volume_20", "sma_200"]


@query("ml_05_imputation", f"""select m.symbol, m.session_date, m.fold, {', '.join(f"{r(f'coalesce({n}, k.m_{n}, 0)', _digits(n))} as {n}, case when k.n_{n} > 0 and {n} is null then 1.0 else 0.0 end as missing_{n}" for n in NAMES)} from marks m
  join (select fold, {', '.join(f"median({n}) as m_{n}, count(*) - count({n}) as n_{n}" for n in NAMES)} from marks where train_direction_1d group by fold) k on m.fold = k.fold where test_direction_1d""")
def ml_05(spark, sf):
    marks = _marks(spark, sf, *NAMES)
    out = L.imputed(marks, L.fold_medians(marks, NAMES, "direction_1d"), NAMES).where("test_direction_1d")
    return out.select("symbol", "session_date", "fold", *[F.round(n, _digits(n)).alias(n) for n in NAMES], *[f"missing_{n}" for n in NAMES])


@query("ml_06_standardized", f"""select m.symbol, m.session_date, m.fold, {', '.join(f"{r(f'({n} - k.m_{n}) / case when k.s_{n} > 0 then k.s_{n} else 1 end')} as {n}" for n in ("return_1d", "rsi_14"))} from marks m
  join (select fold, {', '.join(f"avg({n}) as m_{n}, stddev_pop({n}) as s_{n}" for n in ("return_1d", "rsi_14"))} from marks where train_direction_1d group by fold) k on m.fold = k.fold where test_direction_1d""")
def ml_06(spark, sf):
    names = ["return_1d", "rsi_14"]
    return L.standardized(_marks(spark, sf, *names), names, "direction_1d").where("test_direction_1d").select("symbol", "session_date", "fold", *[F.round(n, 6).alias(n) for n in names])


view("base_pred", "select m.fold, symbol, session_date, direction_1d as actual, prior as prediction from marks m join (select fold, avg(direction_1d) as prior from marks where train_direction_1d group by fold) k on m.fold = k.fold where test_direction_1d")


@query("ml_07_baseline", f"select fold, symbol, session_date, actual, {r('prediction')} as prediction from base_pred")
def ml_07(spark, sf):
    return L.baseline(_marks(spark, sf), "direction_1d").select("fold", "symbol", "session_date", "actual", F.round("prediction", 6).alias("prediction"))


# a prediction with some spread, for the scores
view("spread_pred", "select fold, symbol, session_date, direction_1d as actual, rsi_14 / 100 as prediction, future_return_1d as ret, return_1d as ret_prediction from marks where test_direction_1d")


def _spread(spark, sf, marks=None):
    return (marks or _marks(spark, sf, "rsi_14", "return_1d")).where("test_direction_1d").select("fold", "symbol", "session_date", F.col("direction_1d").alias("actual"), (F.col("rsi_14") / 100).alias("prediction"), F.col("future_return_1d").alias("ret"), F.col("return_1d").alias("ret_prediction"))


def _class_sql(keys: str) -> str:
    on = keys.replace(", ", ", ")
    return f"""select {keys}, count(*) as n_rows, {r('coalesce((avg((prediction >= 0.5)::int) filter (where actual = 1) + avg((prediction < 0.5)::int) filter (where actual = 0)) / 2, avg((prediction >= 0.5)::int) filter (where actual = 1), avg((prediction < 0.5)::int) filter (where actual = 0))')} as balanced_accuracy,
      {r('case when sum(actual) > 0 and sum(1 - actual) > 0 then (sum(rk) filter (where actual = 1) - sum(actual) * (sum(actual) + 1) / 2) / (sum(actual) * sum(1 - actual)) end')} as roc_auc, {r('avg(pow(prediction - actual, 2))')} as brier, {r('avg(case when actual = 1 then -ln(prediction) else -ln(1 - prediction) end)')} as log_loss
      from (select *, rank() over (partition by {on} order by prediction) + (count(*) over (partition by {on}, prediction) - 1) / 2.0 as rk from spread_pred) group by {keys}"""


def _rounded(df, *keys):
    return df.select(*keys, "n_rows", *[F.round(c, 6).alias(c) for c in df.columns if c not in (*keys, "n_rows")])


@query("ag_18_classification", _class_sql("fold"))
def ag_18(spark, sf):
    return _rounded(E.classification(_spread(spark, sf), "fold"), "fold")


@query("ag_20_by_symbol", _class_sql("fold, symbol"))
def ag_20(spark, sf):
    return _rounded(E.classification(_spread(spark, sf), "fold", "symbol"), "fold", "symbol")


@query("wn_26_average_rank", "select symbol, session_date, fold, (rank() over (partition by fold order by prediction) + (count(*) over (partition by fold, prediction) - 1) / 2.0)::double as average_rank from spread_pred")
def wn_26(spark, sf):
    rows = _spread(spark, sf).select("symbol", "session_date", "fold", "prediction")
    ranks = L.average_ranks(rows.groupBy("fold", "prediction").agg(F.count(F.lit(1)).alias("n")), "prediction", "fold")
    return rows.join(ranks, ["fold", "prediction"]).select("symbol", "session_date", "fold", "average_rank")


@query("ag_19_regression", f"select fold, count(*) as n_rows, {r('avg(abs(ret_prediction - ret))')} as mae, {r('sqrt(avg(pow(ret_prediction - ret, 2)))')} as rmse from spread_pred group by fold")
def ag_19(spark, sf):
    rows = _spread(spark, sf).select("fold", F.col("ret").alias("actual"), F.col("ret_prediction").alias("prediction"))
    return _rounded(E.regression(rows, "fold"), "fold")


# a direction is scored by its Brier score, a return by its mean absolute error
SPLIT = "case when fold < 0 then 'holdout' else 'validation' end"
view("scores", f"""select 'direction_1d' as target, 'rsi' as model, {SPLIT} as split, fold, avg(pow(prediction - actual, 2)) as score, avg(pow(prediction - actual, 2)) as brier, null::double as mae from spread_pred group by fold
  union all select 'direction_1d', 'baseline', {SPLIT}, fold, avg(pow(prediction - actual, 2)), avg(pow(prediction - actual, 2)), null from base_pred group by fold
  union all select 'future_return_1d', 'momentum', {SPLIT}, fold, avg(abs(ret_prediction - ret)), null, avg(abs(ret_prediction - ret)) from spread_pred group by fold
  union all select 'future_return_1d', 'baseline', {SPLIT}, fold, avg(abs(ret)), null, avg(abs(ret)) from spread_pred group by fold""")


def _scores(spark, sf):
    marks = _marks(spark, sf, "rsi_14", "return_1d")
    spread = _spread(spark, sf, marks).select("fold", "actual", "prediction").withColumn("model", F.lit("rsi"))
    momentum = _spread(spark, sf, marks).select("fold", F.col("ret").alias("actual"), F.col("ret_prediction").alias("prediction")).withColumn("model", F.lit("momentum"))
    parts = []
    for target, own in (("direction_1d", spread), ("future_return_1d", momentum)):
        both = own.unionByName(L.baseline(marks, target).select("fold", "actual", "prediction").withColumn("model", F.lit("baseline")))
        parts.append(E.scored(both, target))
    return parts[0].unionByName(parts[1])


@query("ag_21_score_summary", f"select target, model, split, {r('avg(brier)')} as brier, {r('avg(mae)')} as mae from scores group by 1, 2, 3")
def ag_21(spark, sf):
    return E.score_summary(_scores(spark, sf)).select("target", "model", "split", F.round("brier", 6).alias("brier"), F.round("mae", 6).alias("mae"))


view("winners", "select target, arg_min(model, row(s, model)) as model, min(s) as mean_score from (select target, model, avg(score) as s from scores where split = 'validation' group by 1, 2) group by target")


@query("ag_22_winner", f"select target, model, {r('mean_score')} as mean_score from winners")
def ag_22(spark, sf):
    return E.winners(_scores(spark, sf).where("split = 'validation'")).withColumn("mean_score", F.round("mean_score", 6))


@query("ag_23_calibration", f"""select k::int as bin, k / 10.0::double as lower, coalesce(n, 0) as n_rows, {r('mp')} as mean_probability, {r('pr')} as positive_rate from (select unnest(range(0, 10)) as k) b
  left join (select least(floor(prediction * 10), 9)::int as bin, count(*) as n, avg(prediction) as mp, avg(actual) as pr from spread_pred where fold = -1 group by 1) c on k = bin""")
def ag_23(spark, sf):
    out = E.calibration(_spread(spark, sf).where("fold = -1"))
    return out.select("bin", "lower", "n_rows", F.round("mean_probability", 6).alias("mean_probability"), F.round("positive_rate", 6).alias("positive_rate"))


def _walk(spark, sf):
    """The walk-forward's panel with all predictors, written once, each instrument's latest core-ready row marked."""
    design, names = _design(spark, sf), FT.feature_names()
    rows, folds = L.windows(design, _folds(spark, sf), names)
    latest = G.latest_ready(design).select("symbol", "session_date", F.lit(True).alias("latest"))
    return M.walk(rows.join(latest, ["symbol", "session_date"], "left").withColumn("latest", F.coalesce("latest", F.lit(False))), folds, names)


def _model_query(name: str, model: str, *targets: str) -> None:
    def run(spark, sf):
        """Predictions of every fold and the holdout."""
        walk = _walk(spark, sf)
        return reduce(DataFrame.unionByName, [M.walk_forward(walk, t, model) for t in targets])

    QUERIES[name] = run


_model_query("ml_08_linear", "linear", *[t for t in TARGETS if t.startswith("direction")])
_model_query("ml_08_ridge", "linear", *[t for t in TARGETS if not t.startswith("direction")])
_model_query("ml_09_random_forest", "random_forest", *TARGETS)
_model_query("ml_10_boosted", "boosted", *TARGETS)


@query("ml_08_optimality", " union all ".join(f"select '{t}' as target, fold, count(*) filter (where train_{t}) as train_rows, true as optimal from marks group by fold" for t in TARGETS))
def ml_08_optimality(spark, sf):
    """Whether the slope of every linear model's objective, taken from its predictions row by row, is below 1e-6 in every direction."""
    walk, out = _walk(spark, sf), []
    fold = F.get(F.array(*map(F.lit, walk.folds)), F.col("position")).cast("int")
    for t in TARGETS:
        out.append(LN.steepest(walk.rows, walk.lines(t), t).select(F.lit(t).alias("target"), fold.alias("fold"), F.col("n").alias("train_rows"), (F.col("slope") < 1e-6).alias("optimal")))
    return reduce(DataFrame.unionByName, out)


@query("ml_09_random_forest_frame", " union all ".join(f"select '{t}' as target, fold, count(*) filter (where test_{t}) as test_rows, true as inside from marks group by fold" for t in TARGETS))
def ml_09_frame(spark, sf):
    """Test rows that the forests predict, and whether all predictions lie between the least and largest training outcome, as means of outcomes do."""
    walk, out = _walk(spark, sf), []
    for t in TARGETS:
        span = walk.rows.where(F.col(f"since_{t}").isNotNull()).agg(F.min(t).alias("low"), F.max(t).alias("high"))
        rows = M.walk_forward(walk, t, "random_forest").crossJoin(F.broadcast(span))
        out.append(rows.groupBy("target", "fold").agg(F.count(F.lit(1)).alias("test_rows"), F.bool_and(F.col("prediction").between(F.col("low") - 1e-12, F.col("high") + 1e-12)).alias("inside")))
    return reduce(DataFrame.unionByName, out)


def _selected(spark, sf):
    """Bundles of the selected models by target, their design, and the folder of what the selection found: tables scores and holdout.

    The first query that asks runs the whole walk-forward and publishes; later ones of a session read what is published, if its dataset is theirs.
    """
    design = _design(spark, sf)
    dataset = B.content_id(design.select("symbol", "session_date", *TARGETS, *FT.feature_names()))
    root = f"{scratch_dir(spark)}/selection-{dataset}"
    if not readable(spark, f"{root}/_log"):
        names = FT.feature_names()
        walk = M.walk(*L.windows(design, _folds(spark, sf), names), names)
        chosen = M.select_all(walk)
        found = new_path(spark, "found")
        reduce(DataFrame.unionByName, map(M.holdout, chosen)).write.parquet(f"{found}/holdout")
        held = spark.read.schema(M.PREDICTIONS).parquet(f"{found}/holdout")
        M.all_scores(chosen, held).write.parquet(f"{found}/scores")
        publish(spark.createDataFrame([(found,)], "folder string").coalesce(1), f"{root}/found")
        start = _folds(spark, sf).where("fold = -1").first()["start"]
        B.publish(chosen, root, dataset, start)
    return B.load(spark, root, dataset), design, published(spark, f"{root}/found").first()["folder"]


@query("ml_11_select_and_score")
def ml_11(spark, sf):
    """Validation scores of baseline and every model by target and fold, the winners, and holdout scores of winner and baseline."""
    return spark.read.parquet(f"{_selected(spark, sf)[2]}/scores")


@query("ml_11_selection_frame", " union all ".join(f"""select '{t}' as target, model, fold, count(*) filter (where test_{t}) as n_rows, true as sound from marks cross join (select unnest(['baseline', 'boosted', 'linear', 'random_forest']) as model)
  where fold >= 0 group by model, fold union all select '{t}', 'selected', -1, count(*) filter (where test_{t} and fold = -1), true from marks""" for t in TARGETS))
def ml_11_frame(spark, sf):
    """Rows scored by target, model and fold; sound: the scores are in their range, and no model's mean validation score is below the winner's."""
    bundles, _, found = _selected(spark, sf)
    scores = spark.read.parquet(f"{found}/scores").withColumn("score", F.coalesce("brier", "mae"))
    best = scores.where("split = 'validation'").groupBy("target", "model").agg(F.avg("score").alias("mean")).groupBy("target").agg(F.min("mean").alias("least"))
    known = spark.createDataFrame([(b.target, b.model, float(b.score)) for b in bundles.values()], "target string, chosen string, mean double")
    rows = scores.join(F.broadcast(known), "target").join(F.broadcast(best), "target").where((F.col("split") == "validation") | (F.col("model") == F.col("winner")))
    sound = (F.coalesce(F.col("brier") <= 1, F.col("rmse") >= F.col("mae"))) & (F.col("score") >= 0) & (F.col("chosen") == F.col("winner")) & (F.abs(F.col("mean") - F.col("least")) < 1e-12)
    return rows.select("target", F.when(F.col("split") == "holdout", "selected").otherwise(F.col("model")).alias("model"), "fold", "n_rows", sound.alias("sound"))


@query("ml_12_holdout_predictions", f"select symbol, session_date, target_date_1d as target_date, direction_1d as actual, {r('prior')} as prediction, 'direction_1d' as target, 'baseline' as model from marks m cross join (select avg(direction_1d) as prior from marks where train_direction_1d and fold = -1) where fold = -1 and test_direction_1d")
def ml_12(spark, sf):
    marks = _marks(spark, sf).where("fold = -1")
    dates = marks.select("symbol", "session_date", F.col("target_date_1d").alias("target_date"))
    out = L.baseline(marks, "direction_1d").join(dates, ["symbol", "session_date"])
    return out.select("symbol", "session_date", "target_date", "actual", F.round("prediction", 6).alias("prediction"), F.lit("direction_1d").alias("target"), F.lit("baseline").alias("model"))


def _selected_forecasts(spark, sf, bundles, design):
    """Forecasts of each instrument's latest core-ready row of the design by the published models, without another fit."""
    latest = G.latest_ready(design).select("symbol", F.col("session_date").alias("as_of_date"), "available_at", *FT.feature_names())
    calendar, out = X.every_day(X.trade_dates(spark, sf)), []
    for target, h in TARGETS.items():
        later = F.broadcast(S.later_session(calendar, h).withColumnRenamed("session_date", "as_of_date"))
        made = bundles[target].predict(latest).join(later, "as_of_date", "left")
        out.append(made.select("symbol", "as_of_date", "available_at", F.lit(target).alias("target"), "target_date", "prediction", F.lit(bundles[target].model).alias("model")))
    return reduce(DataFrame.unionByName, out)


@query("ml_12_pb_03_selected")
def ml_12_pb_03_selected(spark, sf):
    """The holdout's predictions by baseline and selected model, and the selected models' forecasts of each instrument's latest core-ready row. kind is holdout or forecast."""
    bundles, design, found = _selected(spark, sf)
    dates = design.select("symbol", "session_date", "target_date_1d", "target_date_5d")
    own = F.coalesce(*[F.when(F.col("target") == t, F.col(f"target_date_{h}d")) for t, h in TARGETS.items()])
    held = spark.read.schema(M.PREDICTIONS).parquet(f"{found}/holdout").join(dates, ["symbol", "session_date"]).withColumns({"target_date": own, "kind": F.lit("holdout")})
    made = _selected_forecasts(spark, sf, bundles, design).withColumnRenamed("as_of_date", "session_date").withColumns({"kind": F.lit("forecast"), "actual": F.lit(None).cast("double")})
    return reduce(DataFrame.unionByName, [x.select("kind", "target", "symbol", "session_date", "target_date", "actual", "prediction", "model") for x in (held, made)])


@query("ml_12_holdout_frame", " union all ".join(f"select '{t}' as target, session_date, count(*) as n_rows, count(distinct symbol) as symbols, true as sound from marks where fold = -1 and test_{t} group by session_date" for t in TARGETS))
def ml_12_frame(spark, sf):
    """Holdout rows of the selected models by day, and whether each symbol comes once, with the actual outcome and a finite prediction."""
    bundles, design, found = _selected(spark, sf)
    truth = design.select("symbol", "session_date", F.map_from_arrays(F.array(*map(F.lit, TARGETS)), F.array(*[F.col(t).cast("double") for t in TARGETS])).alias("truth"))
    chosen = spark.createDataFrame([(b.target, b.model) for b in bundles.values()], "target string, model string")
    rows = spark.read.schema(M.PREDICTIONS).parquet(f"{found}/holdout").join(F.broadcast(chosen), ["target", "model"]).join(truth, ["symbol", "session_date"])
    sound = (F.try_element_at("truth", F.col("target")) == F.col("actual")) & (F.abs("prediction") < 1e3)
    return rows.groupBy("target", "session_date").agg(F.count(F.lit(1)).alias("n_rows"), F.count_distinct("symbol").alias("symbols"), F.bool_and(sound).alias("sound"))


@query("ml_13_reload", "select count(*) as n, 0.0::double as largest from marks where fold = -1 and test_direction_1d")
def ml_13(spark, sf):
    """Largest difference between predictions before and after a fitted bundle is published and loaded: 0."""
    target, walk = "direction_1d", _walk(spark, sf)
    root = new_path(spark, "bundles")
    dataset = B.content_id(walk.rows.select("symbol", "session_date", target))
    scores = spark.createDataFrame([("linear", 0.0)], "model string, score double")
    B.publish([M.Selection(walk, target, scores, "linear")], root, dataset, None)
    bundle = B.load(spark, root, dataset)[target]
    test = walk.rows.where(F.col(f"test_{target}") == walk.place(-1))
    before = M.walk_forward(walk, target, "linear", [-1]).select("symbol", "session_date", "prediction")
    named = test.select("symbol", "session_date", *[F.get("x", F.lit(j)).alias(n) for j, n in enumerate(walk.names)])
    after = bundle.predict(named).select("symbol", "session_date", F.col("prediction").alias("reloaded"))
    return before.join(after, ["symbol", "session_date"]).agg(F.count(F.lit(1)).alias("n"), F.max(F.abs(F.col("prediction") - F.col("reloaded"))).alias("largest"))


@query("ml_14_split_check", "select target, count(*) filter (where latest_training_outcome >= start) as leaks from audit group by target")
def ml_14(spark, sf):
    return L.audit_violations(L.split_audit(_marks(spark, sf))).select("target", "leaks")


@query("ml_15_prediction_check", """select count(*) filter (where day(session_date) = 2) as repeated, count(*) filter (where day(session_date) in (5, 6)) as not_finite, count(*) filter (where day(session_date) = 9) as before_holdout from base_pred where fold = -1""")
def ml_15(spark, sf):
    """Holdout predictions with faults planted by day of the month: repeated, null, infinite or dated before the holdout."""
    day = F.dayofmonth("session_date")
    rows = X.stored(L.baseline(_marks(spark, sf).where("fold = -1"), "direction_1d"), "predictions")
    rows = rows.withColumn("prediction", F.when(day == 5, None).when(day == 6, float("inf")).otherwise(F.col("prediction"))).unionByName(rows.where(day == 2))
    return E.prediction_violations(rows.withColumn("session_date", F.when(day == 9, F.date_sub("session_date", 4000)).otherwise(F.col("session_date"))), _folds(spark, sf).where("fold = -1"))


# publication

def _day(text: str):
    return F.lit(text).cast("date")


TODAY, EXPECTED = "2001-11-05", "2001-10-30"
T_SQL, E_SQL = "date '2001-11-05'", "date '2001-10-30'"


def _market(spark, sf):
    panel = X.panel(spark, sf)
    feats = X.stored(FT.features(panel), "features")
    prices = panel.select("symbol", "session_date", "adj_close").join(feats.select("symbol", "session_date", "return_1d"), ["symbol", "session_date"])
    return P.market(G.risk_table(feats, forest=False).drop("return_1d"), prices, X.instruments(spark, sf), _day(TODAY), _day(EXPECTED))


view("market", f"""select l.symbol, l.session_date, l.signal, l.risk_band, l.abnormal_volume, i.sector, p.adj_close, l.return_1d, ({T_SQL} - l.session_date)::int as calendar_age_days, l.session_date < {E_SQL} as latest_input_missing,
  case when l.session_date < {E_SQL} then 'No current risk reading' else 'Current indicators' end as data_status from latest l join panel p on l.symbol = p.symbol and l.session_date = p.session_date join instruments i on l.symbol = i.symbol""")


@query("pb_01_market", f"select symbol, session_date, signal, risk_band, abnormal_volume, sector, adj_close, {r('return_1d')} as return_1d, calendar_age_days, latest_input_missing, data_status from market")
def pb_01(spark, sf):
    return _market(spark, sf).select("symbol", "session_date", "signal", "risk_band", "abnormal_volume", "sector", "adj_close", F.round("return_1d", 6).alias("return_1d"), "calendar_age_days", "latest_input_missing", "data_status")


H = ["sma_20", "ema_12", "ema_26", "rsi_14", "macd", "macd_signal", "volatility_20", "return_1d"]


@query("pb_02_history", f"select f.symbol, f.session_date, adj_close, volume, {', '.join(f'{r(h, _digits(h))} as {h}' for h in H)} from feats f join panel p on f.symbol = p.symbol and f.session_date = p.session_date")
def pb_02(spark, sf):
    panel = X.panel(spark, sf)
    return P.history(FT.features(panel), panel).withColumns({h: F.round(h, _digits(h)) for h in H})


def _forecast_rows(spark, sf):
    """Baseline forecasts of the latest core-ready rows: 0 for returns, the holdout's prior for the direction."""
    panel = X.panel(spark, sf)
    design = X.stored(L.labels(panel).join(FT.features(panel), ["symbol", "session_date"]), "design")
    marks = L.marked(design, _folds(spark, sf)).where("fold = -1")
    prior = marks.where("train_direction_1d").agg(F.avg("direction_1d").alias("prior"))
    latest = G.latest_ready(design).select("symbol", F.col("session_date").alias("as_of_date"), "available_at")
    calendar = X.every_day(panel)
    targets = None
    for name, h in TARGETS.items():
        later = F.broadcast(S.later_session(calendar, h).withColumnRenamed("session_date", "as_of_date"))
        value = F.col("prior") if name.startswith("direction") else F.lit(0.0)
        part = latest.join(later, "as_of_date", "left").crossJoin(prior).select("symbol", "as_of_date", "available_at", F.lit(name).alias("target"), "target_date", value.alias("prediction"), F.lit("baseline").alias("model"))
        targets = part if targets is None else targets.unionByName(part)
    return targets


view("forecast_rows", " union all ".join(f"select l.symbol, l.session_date as as_of_date, l.available_at, '{t}' as target, case when l.session_date + {h} < (select stop from span) then l.session_date + {h} end as target_date, {'(select avg(direction_1d) from marks where train_direction_1d and fold = -1)' if t.startswith('direction') else '0.0::double'} as prediction, 'baseline' as model from latest l" for t, h in TARGETS.items()))


@query("pb_03_forecast_rows", f"select symbol, as_of_date, target, target_date, {r('prediction')} as prediction, model from forecast_rows")
def pb_03(spark, sf):
    return _forecast_rows(spark, sf).select("symbol", "as_of_date", "target", "target_date", F.round("prediction", 6).alias("prediction"), "model")


F_EXPECTED, F_TODAY = "2001-06-01", "2001-10-29"
view("forecasts", f"""select symbol, as_of_date, target, target_date, case when ok then prediction end as value, case when ok then '{P.VALID}' when as_of_date < date '2001-06-01' or coalesce(target_date <= date '2001-10-29', false) then '{P.STALE}' else '{P.UNAVAILABLE}' end as status, model
  from (select *, coalesce(available_at <= date '2002-01-01', false) and as_of_date >= date '2001-06-01' and coalesce(target_date > date '2001-10-29', false) as ok from forecast_rows)""")


def _forecasts(spark, sf):
    return P.forecasts(_forecast_rows(spark, sf), F.lit("2002-01-01").cast("date"), _day(F_TODAY), _day(F_EXPECTED))


@query("pb_04_forecasts", f"select symbol, as_of_date, target, target_date, {r('value')} as value, status, model from forecasts")
def pb_04(spark, sf):
    return _forecasts(spark, sf).withColumn("value", F.round("value", 6))


@query("pb_05_models", f"select s.target, s.model, split, {r('avg(brier)')} as brier, case when s.model = w.model then 'Selected' else 'Candidate' end as selection from scores s left join winners w on s.target = w.target group by s.target, s.model, split, w.model")
def pb_05(spark, sf):
    scores = _scores(spark, sf)
    out = P.model_table(E.score_summary(scores), E.winners(scores.where("split = 'validation'")))
    return out.select("target", "model", "split", F.round("brier", 6).alias("brier"), "selection")


@query("pb_05_selected_models", " union all ".join(f"select '{t}' as target, model, 'validation' as split, true as in_range, 'one of four' as selection from (select unnest(['baseline', 'boosted', 'linear', 'random_forest']) as model)" for t in TARGETS))
def pb_05_selected(spark, sf):
    """The Models table of the published selection over validation folds: whether every mean score lies in its range, and that each target has one Selected model of its four."""
    bundles, _, found = _selected(spark, sf)
    chosen = spark.createDataFrame([(b.target, b.model, float(b.score)) for b in bundles.values()], "target string, model string, mean_score double")
    table = P.model_table(E.score_summary(spark.read.parquet(f"{found}/scores").where("split = 'validation'")), chosen)
    inside = (F.coalesce("brier", "mae") >= 0) & F.coalesce(F.col("brier") <= 1, F.lit(True)) & F.coalesce(F.col("balanced_accuracy").between(0, 1) & F.col("roc_auc").between(0, 1), F.col("rmse") >= F.col("mae"))
    picked = F.sum((F.col("selection") == "Selected").cast("int")).over(Window.partitionBy("target"))
    return table.select("target", "model", "split", inside.alias("in_range"), F.when(picked == 1, "one of four").otherwise("wrong").alias("selection"))


view("market_counts", f"select count(*) as equities, count(*) filter (where signal = 'Bullish') as bullish, count(*) filter (where signal = 'Bearish') as bearish, count(*) filter (where signal = 'Neutral') as neutral, count(*) filter (where coalesce(abnormal_volume, false)) as abnormal, count(*) filter (where risk_band = 'High Risk') as high_risk from market where symbol <> '{X.BENCHMARK}' and not latest_input_missing")


@query("ag_25_market_counts", "select * from market_counts")
def ag_25(spark, sf):
    return P.market_counts(_market(spark, sf), X.BENCHMARK)


@query("pb_06_insights", """select 'Market summary' as topic, 'On 2001-10-30 ' || equities || ' equities have current readings (bullish ' || bullish || ', bearish ' || bearish || ', neutral ' || neutral || '); unusual volume in ' || abnormal || ', high volatility in ' || high_risk || '.' as insight from market_counts
  union all select 'Data freshness', 'Bars reach ' || (select max(session_date) from panel)::varchar || '; ' || (select count(*) filter (where latest_input_missing) from market) || ' instruments have no current reading and aren''t counted.'
  union all select 'Model evidence', 'Scores of the validation folds choose the model, and that may be the baseline.' union all select 'Interpretation', 'Labels say what was observed, and a flag is a reason to look, not a finding.'""")
def pb_06(spark, sf):
    market = _market(spark, sf)
    missing = market.agg(F.count_if("latest_input_missing").alias("missing")).crossJoin(X.trade_bars(spark, sf).agg(F.max("session_date").alias("last_session")))
    return P.insights(P.market_counts(market, X.BENCHMARK), missing, _day(EXPECTED))


@query("pb_07_symbols", "select symbol, sector from instruments")
def pb_07(spark, sf):
    return X.instruments(spark, sf).select("symbol", "sector")


@query("pb_07_anomalies", f"select l.symbol, l.session_date, {r('s.return_z')} as return_z, coalesce(abs(s.return_z) >= 3, null) as statistical_anomaly, l.abnormal_volume from latest l join surprise s on l.symbol = s.symbol")
def pb_07_anomalies(spark, sf):
    return G.risk_table(_stored_features(spark, sf), forest=False).select("symbol", "session_date", F.round("return_z", 6).alias("return_z"), "statistical_anomaly", "abnormal_volume")


@query("pb_07_anomalies_with_isolation")
def pb_07_isolation(spark, sf):
    """The anomalies table with the isolation forest's columns, which SQL can't give."""
    return G.risk_table(_stored_features(spark, sf)).select("symbol", "session_date", "return_z", "statistical_anomaly", "abnormal_volume", "isolation_score", "isolation_anomaly", "attention")


@query("pb_08_skip", "select max(session_date) = date '2001-11-04' as skip from panel")
def pb_08(spark, sf):
    pointer = X.trade_bars(spark, sf).agg(F.max("session_date").alias("expected_session"), F.lit(0).alias("stale_instruments"))
    return P.skip_run(pointer, F.lit("2001-11-04").cast("date"))


view("run_steps", "select user_id % 500 as run_id, event_id as step, event_type as stage, ts as started_at, case when event_id % 11 <> 0 then ts + interval 5 minute end as finished_at, value::double >= 1 as ok from events")
view("broken_runs", "select run_id, min(step) filter (where not coalesce(ok, false) or finished_at is null) as broken from run_steps group by run_id")


@query("pb_09_run_log", """select s.run_id, case when max(broken) is null then 'success' else 'failed' end as status, string_agg(stage, ',' order by step) as stages, max(stage) filter (where step = broken) as stopped_at,
  min(started_at) as started_at, max(coalesce(finished_at, started_at)) as finished_at from run_steps s join broken_runs b on s.run_id = b.run_id where broken is null or step <= broken group by s.run_id""")
def pb_09(spark, sf):
    """Runs out of the events: a run's steps are those of a group of users."""
    e = X.table(spark, sf, "events").withColumn("ts", F.col("ts").cast("timestamp_ntz"))
    steps = e.select(
        (F.col("user_id") % 500).alias("run_id"), F.col("event_id").alias("step"), F.col("event_type").alias("stage"), F.col("ts").alias("started_at"),
        F.when(F.col("event_id") % 11 != 0, F.col("ts") + F.expr("interval 5 minutes")).alias("finished_at"), (F.col("value").cast("double") >= 1).alias("ok"),
    )
    return P.run_log(steps)


@query("ag_31_release_check", """select (select count(*) from market where symbol = 'AF') as repeated_market_rows, (select count(*) from forecasts where symbol = 'NF') as missing_forecasts,
  (select count(*) from forecasts where status like 'Skipped%' and target = 'future_return_1d' and symbol <> 'NF') as skipped_with_value, (select count(*) from forecasts where target = 'direction_1d' and symbol not in ('NF', 'RF') and value is not null) as bad_probability""")
def ag_31(spark, sf):
    """A release with faults planted: a repeated market row, a symbol without forecasts, values that were skipped, probabilities above 1."""
    market, rows = X.stored(_market(spark, sf), "market"), X.stored(_forecasts(spark, sf), "forecasts").where("symbol <> 'NF'")
    skipped = F.col("status").startswith("Skipped") & (F.col("target") == "future_return_1d")
    sure = (F.col("target") == "direction_1d") & (F.col("symbol") != "RF")
    rows = rows.withColumn("value", F.when(skipped, 0.5).when(sure, F.col("value") + 1).otherwise(F.col("value")))
    return P.release_violations(market.unionByName(market.where("symbol = 'AF'")), rows)


def _issued(spark, sf):
    """One forecast per symbol, day and target, issued the evening before the target day or, every seventh, too late; every fifth twice."""
    rows = L.labels(X.panel(spark, sf))
    d = F.datediff("session_date", F.lit("1995-01-01").cast("date"))
    parts = None
    for t, h in TARGETS.items():
        part = rows.select("symbol", F.col("session_date").alias("as_of_date"), F.lit(t).alias("target"), F.col(f"target_date_{h}d").alias("target_date"), F.when(d % 11 != 0, (d % 10) / 10.0).alias("value"), d.alias("d"))
        parts = part if parts is None else parts.unionByName(part)
    parts = parts.withColumn("copy", F.explode(F.sequence(F.lit(0), F.when(F.col("d") % 5 == 0, 1).otherwise(0))))
    issued = F.col("target_date").cast("timestamp_ntz") + F.when(F.col("d") % 7 == 0, F.expr("interval 1 hour")).otherwise(F.expr("interval -6 hours")) + F.col("copy") * F.expr("interval 2 hours")
    return parts.select(F.concat(F.lit("s"), F.col("copy").cast("string")).alias("snapshot_id"), issued.alias("issued_at"), "symbol", "as_of_date", "target", "target_date", "value", F.when(F.col("d") % 13 == 0, "Skipped: x").otherwise("ok").alias("status"), F.lit("baseline").alias("model"))


def _outcomes(spark, sf):
    rows = L.labels(X.panel(spark, sf))
    parts = None
    for t, h in TARGETS.items():
        part = rows.select("symbol", F.col("session_date").alias("as_of_date"), F.lit(t).alias("target"), F.col(f"target_date_{h}d").alias("target_date"), F.col(t).alias("actual"))
        parts = part if parts is None else parts.unionByName(part)
    return parts


view("outcomes", " union all ".join(f"select symbol, session_date as as_of_date, '{t}' as target, target_date_{h}d as target_date, {t} as actual from labels" for t, h in TARGETS.items()))
view("issued", """select 's' || copy::varchar as snapshot_id, target_date::timestamp + case when d % 7 = 0 then interval 1 hour else interval (-6) hour end + copy * interval 2 hour as issued_at, symbol, as_of_date, target, target_date,
  case when d % 11 <> 0 then (d % 10) / 10.0::double end as value, case when d % 13 = 0 then 'Skipped: x' else 'ok' end as status, 'baseline' as model
  from (select *, (as_of_date - date '1995-01-01') as d from outcomes) join (select 0 as copy union all select 1) on copy = 0 or d % 5 = 0""")
view("matched", """select i.*, o.actual, case when o.actual is not null and o.target_date = i.target_date then 'scored' else 'excluded' end as state from issued i left join outcomes o on i.symbol = o.symbol and i.as_of_date = o.as_of_date and i.target = o.target
  where i.value is not null and i.status not like 'Skipped%' and i.issued_at < i.target_date::timestamp and i.target_date::timestamp + interval 16 hour <= timestamp '2001-10-20 18:00:00'""")
view("firsts", "select * from (select *, row_number() over (partition by symbol, as_of_date, target_date, target order by issued_at, snapshot_id) as nth from matched where state = 'scored') where nth = 1")


def _matched(spark, sf):
    return P.matched_forecasts(_issued(spark, sf), _outcomes(spark, sf), F.lit("2001-10-20 18:00:00").cast("timestamp_ntz"))


@query("jn_09_matched_forecasts", "select target, state, count(*) as n from matched group by 1, 2")
def jn_09(spark, sf):
    return _matched(spark, sf).groupBy("target", "state").agg(F.count(F.lit(1)).alias("n"))


@query("sl_03_first_issued", "select snapshot_id, symbol, as_of_date, target from firsts")
def sl_03(spark, sf):
    return P.first_issued(_matched(spark, sf).where("state = 'scored'")).select("snapshot_id", "symbol", "as_of_date", "target")


@query("ag_26_forecast_scores", f"""select target, target_date, count(*) as n, array_to_string(list_sort(array_agg(distinct model)), ',') as models, {r("avg((((value >= 0.5)::int)::double = actual)::int) filter (where target = 'direction_1d')")} as accuracy,
  {r("avg(pow(value - actual, 2)) filter (where target = 'direction_1d')")} as brier, {r("avg(actual) filter (where target = 'direction_1d')")} as always_up_accuracy, max(case when target = 'direction_1d' then 0.25::double end) as half_brier,
  {r("avg(abs(value - actual)) filter (where target <> 'direction_1d')")} as mae, {r("avg(abs(actual)) filter (where target <> 'direction_1d')")} as zero_return_mae from firsts group by 1, 2""")
def ag_26(spark, sf):
    out = E.forecast_scores(P.first_issued(_matched(spark, sf).where("state = 'scored'")).withColumnRenamed("value", "prediction"))
    return out.select("target", "target_date", "n", "models", "half_brier", *[F.round(c, 6).alias(c) for c in ("accuracy", "brier", "always_up_accuracy", "mae", "zero_return_mae")])
