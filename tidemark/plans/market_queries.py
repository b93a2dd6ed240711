"""Registered queries over bars and events around them."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.functions.text import category
from tidemark.operators import events as ev
from tidemark.operators import market as mk
from tidemark.operators import sessions as ss
from tidemark.operators.quantiles import quantiles
from tidemark.operators.sides import kept
from tidemark.plans.fixtures import BARS_EV, BARS_LI, BRONZE_MARKET, NEWS_EV, bars_ev, bars_li, bronze_market, news_ev, returns, returns_sql, sql, table

QUERIES: dict = {}
ORACLES: dict[str, str] = {}


def query(oracle: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if oracle:
            ORACLES[f.__name__] = oracle
        return f

    return add


def r6(name: str, alias: str | None = None):
    return F.round(F.col(name), 6).alias(alias or name)


INDEXED = """ix AS (SELECT *, row_number() OVER w AS session_index, lag(close) OVER w AS anchor_close, lag(session_date) OVER w AS anchor_date FROM bars_ev_r WINDOW w AS (PARTITION BY ticker ORDER BY session_date))"""
BENCH = """bench AS (SELECT session_date, avg(daily_return) AS benchmark_daily_return, count(DISTINCT ticker) AS benchmark_constituents,
    exp(sum(coalesce(CASE WHEN avg(daily_return) > -1 THEN ln(1 + avg(daily_return)) END, 0)) OVER (ORDER BY session_date)) AS benchmark_index FROM bars_ev_r GROUP BY session_date)"""
T0 = """t0 AS (SELECT e.*, i.session_date AS t0_date, i.session_index AS t0_index, i.anchor_close, i.anchor_date
  FROM (SELECT *, event_date + CAST(after_close AS INTEGER) AS eff FROM news_ev) e ASOF JOIN ix i ON e.ticker = i.ticker AND e.eff <= i.session_date)"""
GOLD = """gold AS (SELECT t0.event_id, t0.ticker, t0.event_date, t0.after_close, t0.t0_date, o.relative_session, s.session_date, s.close, t0.anchor_close, t0.anchor_date, b.benchmark_constituents,
    s.session_date IS NOT NULL AS has_market_data, s.close / nullif(t0.anchor_close, 0) - 1 AS stock_return, b.benchmark_index / nullif(a.benchmark_index, 0) - 1 AS bench_return
  FROM t0 CROSS JOIN (SELECT unnest([-5, -3, -2, -1, 0, 1, 2, 3, 5]) AS relative_session) o LEFT JOIN ix s ON s.ticker = t0.ticker AND s.session_index = t0.t0_index + o.relative_session
  LEFT JOIN bench b ON b.session_date = s.session_date LEFT JOIN bench a ON a.session_date = t0.anchor_date)"""
GOLD_PARTS = [BARS_EV, returns_sql("bars_ev"), NEWS_EV, INDEXED, BENCH, T0, GOLD]


def gold(spark, sf_dir):
    return ev.event_window(news_ev(spark, sf_dir), returns(bars_ev(spark, sf_dir)))


@query(sql(*GOLD_PARTS, """SELECT event_id, ticker, relative_session, t0_date, session_date, has_market_data, round(close, 6) AS close, anchor_date AS anchor_date_t_minus_1,
  CAST(benchmark_constituents AS BIGINT) AS benchmark_constituents, round(stock_return, 6) AS stock_cumulative_return, round(bench_return, 6) AS benchmark_cumulative_return, round(stock_return - bench_return, 6) AS abnormal_return FROM gold"""))  # fmt: skip
def event_window_gold(spark, sf_dir):
    return gold(spark, sf_dir).select("event_id", "ticker", "relative_session", "t0_date", "session_date", "has_market_data", r6("close"), "anchor_date_t_minus_1", F.col("benchmark_constituents").cast("long").alias("benchmark_constituents"), r6("stock_cumulative_return"), r6("benchmark_cumulative_return"), r6("abnormal_return"))


@query(sql(BARS_EV, returns_sql("bars_ev"), NEWS_EV, INDEXED, T0, "SELECT event_id, ticker, event_date, after_close, t0_date, CAST(t0_index AS INTEGER) AS t0_index FROM t0"))
def t0_asof(spark, sf_dir):
    return ss.reaction_session(news_ev(spark, sf_dir), mk.indexed(bars_ev(spark, sf_dir))).select("event_id", "ticker", "event_date", "after_close", "t0_date", "t0_index")


KNOWN = """known AS (SELECT e.*, i.session_date AS known_date, i.close AS known_close, i.session_index AS known_index
  FROM (SELECT *, event_date + CAST(after_close AS INTEGER) - 1 AS eff FROM news_ev) e ASOF JOIN ix i ON e.ticker = i.ticker AND e.eff >= i.session_date)"""


@query(sql(BARS_EV, returns_sql("bars_ev"), NEWS_EV, INDEXED, KNOWN, "SELECT event_id, ticker, known_date, round(known_close, 6) AS known_close, CAST(known_index AS INTEGER) AS known_index FROM known"))
def known_anchor_asof(spark, sf_dir):
    return ss.known_session(news_ev(spark, sf_dir), mk.indexed(bars_ev(spark, sf_dir))).select("event_id", "ticker", "known_date", r6("known_close"), "known_index")


@query(sql(BARS_EV, NEWS_EV, "ib AS (SELECT ticker, CAST(session_date AS TIMESTAMP) AS bar_time, close, lead(close, 1) OVER w AS c1, lead(close, 3) OVER w AS c3, lead(close, 5) OVER w AS c5 FROM bars_ev WINDOW w AS (PARTITION BY ticker ORDER BY session_date))",
  "SELECT event_id, e.ticker, round(close, 6) AS price_at_event, round(c1 / nullif(close, 0) - 1, 6) AS return_1session, round(c3 / nullif(close, 0) - 1, 6) AS return_3session, round(c5 / nullif(close, 0) - 1, 6) AS return_5session FROM news_ev e ASOF JOIN ib b ON e.ticker = b.ticker AND e.ts >= b.bar_time"))
def mvp_asof(spark, sf_dir):
    bars = bars_ev(spark, sf_dir).select("ticker", F.col("session_date").cast("timestamp").alias("bar_time"), "close")
    events = news_ev(spark, sf_dir).select("event_id", "ticker", F.col("published_timestamp").alias("event_time"))
    return ss.last_bar_at(events, bars).select("event_id", "ticker", r6("price_at_event"), *[r6(f"return_{h}session") for h in (1, 3, 5)])


MARKET_BENCH = "b0 AS (SELECT session_date, avg(close) AS close FROM bars_ev GROUP BY session_date)"
LABEL = "CASE WHEN {v} >= 0.02 THEN 'positive' WHEN {v} <= -0.02 THEN 'negative' WHEN {v} IS NOT NULL THEN 'neutral' END"
QUALITY = "CASE WHEN {a} IS NOT NULL THEN 'exact_abnormal_return' ELSE 'raw_return_no_benchmark' END || CASE WHEN published_precision = 'timestamp' THEN '' ELSE '|imprecise_event_time' END"


def market_average(spark, sf_dir):
    return bars_ev(spark, sf_dir).groupBy("session_date").agg(F.avg("close").alias("close"))


IMPACTS = f"""imp AS (SELECT k.event_id, k.ticker, k.published_precision, h AS horizon_sessions, k.known_date, t.session_date AS target_date, t.close / nullif(k.known_close, 0) - 1 AS raw_return,
    nullif(b1.close, 0) / nullif(b0.close, 0) - 1 AS benchmark_return
  FROM known k CROSS JOIN (SELECT unnest([1, 3, 5]) AS h) JOIN ix t ON t.ticker = k.ticker AND t.session_index = k.known_index + h LEFT JOIN b0 ON b0.session_date = k.known_date LEFT JOIN b0 AS b1 ON b1.session_date = t.session_date)"""
IMPACT_PARTS = [BARS_EV, returns_sql("bars_ev"), NEWS_EV, INDEXED, KNOWN, MARKET_BENCH, IMPACTS]


def impact_rows(spark, sf_dir):
    return ev.impacts(news_ev(spark, sf_dir), bars_ev(spark, sf_dir), market_average(spark, sf_dir))


@query(sql(*IMPACT_PARTS, f"""SELECT event_id, ticker, CAST(horizon_sessions AS INTEGER) AS horizon_sessions, known_date, target_date, round(raw_return, 6) AS raw_return, round(benchmark_return, 6) AS benchmark_return, round(raw_return - benchmark_return, 6) AS abnormal_return,
  {LABEL.format(v="coalesce(raw_return - benchmark_return, raw_return)")} AS impact_label, {QUALITY.format(a="(raw_return - benchmark_return)")} AS join_quality FROM imp"""))  # fmt: skip
def impact_horizons(spark, sf_dir):
    return impact_rows(spark, sf_dir).select("event_id", "ticker", "horizon_sessions", "known_date", "target_date", r6("raw_return"), r6("benchmark_return"), r6("abnormal_return"), "impact_label", "join_quality")


@query(sql(BARS_EV, returns_sql("bars_ev"), NEWS_EV, INDEXED, T0, MARKET_BENCH, "br AS (SELECT session_date, close / nullif(lag(close) OVER (ORDER BY session_date), 0) - 1 AS r FROM b0)",
  "w AS (SELECT t0.event_id, t0.ticker, t0.published_precision, relative_session, s.session_date, s.daily_return AS r, br.r AS b FROM t0 CROSS JOIN (SELECT unnest([-5, -3, -2, -1, 0, 1, 2, 3, 5]) AS relative_session) JOIN ix s ON s.ticker = t0.ticker AND s.session_index = t0_index + relative_session LEFT JOIN br ON br.session_date = s.session_date)",
  f"SELECT event_id, ticker, relative_session, session_date, round(r, 6) AS session_return, round(b, 6) AS benchmark_session_return, round(r - b, 6) AS abnormal_session_return, {LABEL.format(v='coalesce(r - b, r)')} AS impact_label, {QUALITY.format(a='(r - b)')} AS join_quality FROM w"))
def event_window_sessions(spark, sf_dir):
    out = ev.session_windows(news_ev(spark, sf_dir), bars_ev(spark, sf_dir), market_average(spark, sf_dir))
    return out.select("event_id", "ticker", "relative_session", "session_date", r6("session_return"), r6("benchmark_session_return"), r6("abnormal_session_return"), "impact_label", "join_quality")


@query(sql(BARS_EV, returns_sql("bars_ev"), NEWS_EV, INDEXED, T0, KNOWN, "n AS (SELECT ticker, count(*) AS s FROM bars_ev GROUP BY ticker)",
  """SELECT count(*) FILTER (t.event_id IS NULL) AS no_t0, CAST(sum(CASE WHEN t.event_id IS NULL THEN 0 ELSE len(list_filter([-5, -3, -2, -1, 0, 1, 2, 3, 5], lambda o: t.t0_index + o < 1 OR t.t0_index + o > n.s)) END) AS BIGINT) AS outside_history,
  count(*) FILTER (k.event_id IS NULL) AS no_anchor, CAST(sum(CASE WHEN k.event_id IS NULL THEN 0 ELSE len(list_filter([1, 3, 5], lambda h: k.known_index + h > n.s)) END) AS BIGINT) AS no_future
  FROM news_ev e LEFT JOIN t0 t ON t.event_id = e.event_id AND t.ticker = e.ticker LEFT JOIN known k ON k.event_id = e.event_id AND k.ticker = e.ticker LEFT JOIN n ON n.ticker = e.ticker"""))  # fmt: skip
def skip_counters(spark, sf_dir):
    return ev.skip_counts(news_ev(spark, sf_dir), bars_ev(spark, sf_dir))


@query(sql(BRONZE_MARKET, "SELECT raw_id, ticker, session_date, source, round(previous_close, 6) AS previous_close, round(close / nullif(previous_close, 0) - 1, 6) AS daily_return, round(CASE WHEN close / nullif(previous_close, 0) > 0 THEN ln(close / nullif(previous_close, 0)) END, 6) AS log_return, strftime(session_date, '%Y-%m') AS session_year_month FROM silver WHERE len(errors) = 0"))
def market_silver(spark, sf_dir):
    return mk.market_silver(bronze_market(spark, sf_dir), tie=("raw_id",)).filter("is_valid").select("raw_id", "ticker", "session_date", "source", r6("previous_close"), r6("daily_return"), r6("log_return"), "session_year_month")


@query(sql(BRONZE_MARKET, "SELECT e AS error, count(*) AS bars FROM (SELECT unnest(errors) AS e FROM silver) GROUP BY e"))
def market_quality_errors(spark, sf_dir):
    return mk.market_silver(bronze_market(spark, sf_dir), tie=("raw_id",)).select(F.explode("data_quality_errors").alias("error")).groupBy("error").agg(F.count("*").alias("bars"))


@query(sql(BRONZE_MARKET, "SELECT raw_id, ticker, array_to_string(errors, ',') AS errors FROM silver WHERE len(errors) > 0"))
def market_quarantine(spark, sf_dir):
    return mk.quarantined(mk.market_silver(bronze_market(spark, sf_dir), tie=("raw_id",))).select("raw_id", "ticker", F.array_join("data_quality_errors", ",").alias("errors"))


@query(sql(BARS_EV, returns_sql("bars_ev"), BENCH, "SELECT session_date, round(benchmark_daily_return, 6) AS benchmark_daily_return, benchmark_constituents, round(benchmark_index, 6) AS benchmark_index FROM bench"))
def benchmark_index(spark, sf_dir):
    return mk.benchmark_index(returns(bars_ev(spark, sf_dir))).select("session_date", r6("benchmark_daily_return"), "benchmark_constituents", r6("benchmark_index"))


@query(sql(BARS_LI, "s AS (SELECT *, CASE WHEN day(session_date) % 3 = 0 AND CAST(ticker AS INTEGER) % 2 = 0 THEN 'vnstock_vci' WHEN day(session_date) % 3 = 1 THEN 'b_feed' ELSE 'a_feed' END AS source FROM bars_li)",
  "p AS (SELECT ticker, arg_min(source, CASE WHEN source = 'vnstock_vci' THEN '0' ELSE '1' || source END) AS source FROM s GROUP BY ticker)", "SELECT ticker, source, count(*) AS bars, min(session_date) AS first_session FROM s JOIN p USING (ticker, source) GROUP BY ALL"))
def preferred_source(spark, sf_dir):
    day, ticker = F.dayofmonth("session_date"), F.col("ticker").cast("int")
    source = F.when((day % 3 == 0) & (ticker % 2 == 0), "vnstock_vci").when(day % 3 == 1, "b_feed").otherwise("a_feed")
    return mk.preferred_source(bars_li(spark, sf_dir).withColumn("source", source)).groupBy("ticker", "source").agg(F.count("*").alias("bars"), F.min("session_date").alias("first_session"))


@query(sql(*IMPACT_PARTS, "SELECT event_id, ticker, horizon_sessions, round(coalesce(raw_return - benchmark_return, raw_return), 6) AS impact FROM imp WHERE horizon_sessions = 3 ORDER BY abs(coalesce(raw_return - benchmark_return, raw_return)) DESC NULLS LAST, event_id LIMIT 100"))
def topk_impact(spark, sf_dir):
    rows = impact_rows(spark, sf_dir).filter("horizon_sessions = 3").withColumn("impact", F.coalesce("abnormal_return", "raw_return"))
    return rows.orderBy(F.abs("impact").desc_nulls_last(), "event_id").limit(100).select("event_id", "ticker", "horizon_sessions", r6("impact"))


@query(sql(*IMPACT_PARTS, f"SELECT CAST(horizon_sessions AS INTEGER) AS horizon_sessions, {LABEL.format(v='coalesce(raw_return - benchmark_return, raw_return)')} AS impact_label, count(*) AS n FROM imp GROUP BY ALL"))
def labels_by_horizon(spark, sf_dir):
    return impact_rows(spark, sf_dir).groupBy("horizon_sessions", "impact_label").agg(F.count("*").alias("n"))


@query(sql(*GOLD_PARTS, "SELECT relative_session, count(*) AS n, count(*) FILTER (has_market_data) AS available, round(100.0 * count(*) FILTER (has_market_data) / count(*), 2) AS coverage_pct FROM gold GROUP BY relative_session"))
def window_coverage(spark, sf_dir):
    return gold(spark, sf_dir).groupBy("relative_session").agg(F.count("*").alias("n"), F.count_if("has_market_data").alias("available")).withColumn("coverage_pct", F.round(100.0 * F.col("available") / F.col("n"), 2))


STATS = "count(v) AS n, round(avg(v), 6) AS mean, round(median(v), 6) AS median, round(stddev_samp(v), 6) AS std, round(stddev_samp(v) / sqrt(count(v)), 6) AS se, round(1.96 * stddev_samp(v) / sqrt(count(v)), 6) AS ci95"


def stats(c):
    se = F.stddev_samp(c) / F.sqrt(F.count(c))
    return [F.count(c).alias("n"), F.round(F.avg(c), 6).alias("mean"), F.round(F.stddev_samp(c), 6).alias("std"), F.round(se, 6).alias("se"), F.round(1.96 * se, 6).alias("ci95")]


@query(sql(*GOLD_PARTS, f"SELECT relative_session, {STATS} FROM (SELECT relative_session, stock_return - bench_return AS v FROM gold) GROUP BY relative_session"))
def abnormal_stats(spark, sf_dir):
    g = kept(gold(spark, sf_dir).select("relative_session", "abnormal_return"), "abnormal-returns")
    middle = quantiles(g, "abnormal_return", {"median": 0.5}, ["relative_session"]).withColumn("median", F.round("median", 6))
    return g.groupBy("relative_session").agg(*stats("abnormal_return")).join(middle, "relative_session", "left")


@query(sql(*GOLD_PARTS, "SELECT after_close, relative_session, count(stock_return - bench_return) AS n, round(avg(stock_return - bench_return), 6) AS mean FROM gold WHERE relative_session IN (0, 1, 3, 5) GROUP BY ALL"))
def timing_split(spark, sf_dir):
    return gold(spark, sf_dir).filter(F.col("relative_session").isin(0, 1, 3, 5)).groupBy("after_close", "relative_session").agg(F.count("abnormal_return").alias("n"), F.round(F.avg("abnormal_return"), 6).alias("mean"))


@query(sql(*GOLD_PARTS, "SELECT ticker, count(stock_return - bench_return) AS events, round(avg(stock_return - bench_return), 6) AS mean FROM gold WHERE relative_session = 5 GROUP BY ticker HAVING count(stock_return - bench_return) >= 5"))
def ticker_t5(spark, sf_dir):
    return gold(spark, sf_dir).filter("relative_session = 5").groupBy("ticker").agg(F.count("abnormal_return").alias("events"), F.round(F.avg("abnormal_return"), 6).alias("mean")).filter("events >= 5")


@query(sql(*GOLD_PARTS, """p AS (SELECT DISTINCT event_id, ticker, event_date, after_close, t0_date, anchor_date FROM gold)""", """SELECT (SELECT count(*) FROM gold) AS n_rows, (SELECT count(DISTINCT event_id) FROM gold) AS events, count(*) AS pairs,
  count(*) FILTER (after_close) AS after_close, count(*) FILTER (t0_date < event_date OR (after_close AND t0_date = event_date)) AS bad_t0, count(*) FILTER (anchor_date >= t0_date) AS bad_anchor FROM p"""))  # fmt: skip
def gold_quality(spark, sf_dir):
    g = gold(spark, sf_dir)
    pairs = g.groupBy("event_id", "ticker").agg(F.count("*").alias("k"), *[F.first(c).alias(c) for c in ("event_date", "after_close", "t0_date", "anchor_date_t_minus_1")])
    bad = (F.col("t0_date") < F.col("event_date")) | (F.col("after_close") & (F.col("t0_date") == F.col("event_date")))
    return pairs.agg(F.sum("k").alias("n_rows"), F.count_distinct("event_id").alias("events"), F.count("*").alias("pairs"), F.count_if("after_close").alias("after_close"), F.count_if(bad).alias("bad_t0"), F.count_if(F.col("anchor_date_t_minus_1") >= F.col("t0_date")).alias("bad_anchor"))


@query(sql(BARS_LI, returns_sql("bars_li"), "SELECT ticker, count(*) AS sessions, min(session_date) AS first_session, max(session_date) AS last_session, count(*) FILTER (daily_return IS NULL) AS missing_returns FROM bars_li_r GROUP BY ticker"))
def market_coverage(spark, sf_dir):
    return returns(bars_li(spark, sf_dir)).groupBy("ticker").agg(F.count("*").alias("sessions"), F.min("session_date").alias("first_session"), F.max("session_date").alias("last_session"), F.count_if(F.col("daily_return").isNull()).alias("missing_returns"))


@query(sql(BARS_LI, returns_sql("bars_li"), "SELECT ticker, round(avg(daily_return), 6) AS mean_return, round(stddev_samp(daily_return), 6) AS std_return, round(median(volume), 6) AS median_volume FROM bars_li_r GROUP BY ticker"))
def ticker_risk(spark, sf_dir):
    bars = kept(returns(bars_li(spark, sf_dir)).select("ticker", "daily_return", "volume"), "risk")
    middle = quantiles(bars, "volume", {"median_volume": 0.5}, ["ticker"]).withColumn("median_volume", F.round("median_volume", 6))
    return bars.groupBy("ticker").agg(F.round(F.avg("daily_return"), 6).alias("mean_return"), F.round(F.stddev_samp("daily_return"), 6).alias("std_return")).join(middle, "ticker", "left")


@query(sql(BARS_LI, returns_sql("bars_li"), "SELECT count(v) AS n, round(avg(v), 4) AS mean, round(stddev_samp(v), 4) AS std, round(min(v), 4) AS least, round(quantile_cont(v, 0.01), 4) AS p01, round(quantile_cont(v, 0.05), 4) AS p05, round(quantile_cont(v, 0.5), 4) AS p50, round(quantile_cont(v, 0.95), 4) AS p95, round(quantile_cont(v, 0.99), 4) AS p99, round(max(v), 4) AS most FROM (SELECT daily_return * 100 AS v FROM bars_li_r)"))
def return_describe(spark, sf_dir):
    rows, v = kept(returns(bars_li(spark, sf_dir)).select((F.col("daily_return") * 100).alias("v")), "returns"), F.col("v")
    at = {"p01": 0.01, "p05": 0.05, "p50": 0.5, "p95": 0.95, "p99": 0.99}
    whole = rows.agg(F.count(v).alias("n"), F.round(F.avg(v), 4).alias("mean"), F.round(F.stddev_samp(v), 4).alias("std"), F.round(F.min(v), 4).alias("least"), F.round(F.max(v), 4).alias("most"))
    return whole.join(quantiles(rows, "v", at).select(*[F.round(c, 4).alias(c) for c in at]), how="left")


@query(sql(BARS_LI, returns_sql("bars_li"), "q AS (SELECT ticker FROM bars_li_r GROUP BY ticker ORDER BY count(*) DESC, ticker LIMIT 5)",
  "SELECT a.ticker AS a, b.ticker AS b, round(corr(a.daily_return, b.daily_return), 6) AS correlation, count(*) AS overlaps FROM bars_li_r a JOIN bars_li_r b ON a.session_date = b.session_date AND a.ticker <> b.ticker WHERE b.ticker IN (SELECT ticker FROM q) AND a.daily_return IS NOT NULL AND b.daily_return IS NOT NULL GROUP BY ALL HAVING count(*) >= 100"))
def return_corr(spark, sf_dir):
    """Every ticker against a basket: the five with the most sessions."""
    bars = returns(bars_li(spark, sf_dir))
    basket = bars.groupBy("ticker").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "ticker").limit(5).select("ticker")
    return mk.correlation_with(bars, basket).withColumn("correlation", F.round("correlation", 6))


@query(sql(BARS_LI, returns_sql("bars_li"), "SELECT count(*) AS n_rows, count(DISTINCT ticker) AS tickers, count(DISTINCT session_date) AS sessions, count(*) - count(DISTINCT (ticker, session_date)) AS duplicate_keys, count(*) FILTER (dayofweek(session_date) IN (0, 6)) AS weekend_rows, count(*) FILTER (daily_return IS NULL) AS null_returns, count(*) FILTER (abs(daily_return) > 0.1) AS large_moves, min(session_date) AS first_session, max(session_date) AS last_session FROM bars_li_r"))
def market_quality(spark, sf_dir):
    return returns(bars_li(spark, sf_dir)).agg(F.count("*").alias("n_rows"), F.count_distinct("ticker").alias("tickers"), F.count_distinct("session_date").alias("sessions"), (F.count("*") - F.count_distinct(F.struct("ticker", "session_date"))).alias("duplicate_keys"), F.count_if(F.dayofweek("session_date").isin(1, 7)).alias("weekend_rows"), F.count_if(F.col("daily_return").isNull()).alias("null_returns"), F.count_if(F.abs("daily_return") > 0.1).alias("large_moves"), F.min("session_date").alias("first_session"), F.max("session_date").alias("last_session"))


@query(sql(BARS_LI, returns_sql("bars_li"), "SELECT CAST(CASE WHEN v >= 15 THEN 60 ELSE floor((v + 15) / 0.5) END AS BIGINT) AS bin, count(*) AS n FROM (SELECT least(greatest(daily_return * 100, -15), 15) AS v FROM bars_li_r WHERE daily_return IS NOT NULL) GROUP BY bin"))
def return_histogram(spark, sf_dir):
    v = F.least(F.greatest(F.col("daily_return") * 100, F.lit(-15.0)), F.lit(15.0))
    bins = F.when(v >= 15, F.lit(60)).otherwise(F.floor((v + 15) / 0.5)).cast("long").alias("bin")
    return returns(bars_li(spark, sf_dir)).filter("daily_return is not null").groupBy(bins).agg(F.count("*").alias("n"))


RULES = {"colour": ["green", "blue", "red"], "size": ["small", "large"], "metal": ["steel", "brass"]}


@query("SELECT p_partkey, CASE WHEN lower(p_name) LIKE '%green%' OR lower(p_name) LIKE '%blue%' OR lower(p_name) LIKE '%red%' THEN 'colour' WHEN lower(p_name) LIKE '%small%' OR lower(p_name) LIKE '%large%' THEN 'size' WHEN lower(p_name) LIKE '%steel%' OR lower(p_name) LIKE '%brass%' THEN 'metal' ELSE 'other' END AS category FROM part")
def categorize(spark, sf_dir):
    return table(spark, sf_dir, "part").select("p_partkey", category(F.col("p_name"), RULES, "other").alias("category"))
