"""Registered queries behind the serving views: newest rows, labelled tops, one event's window, outcomes and parity."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.functions import entities as ent
from tidemark.functions.tickers import tickers
from tidemark.operators import events as ev
from tidemark.operators import metrics as mt
from tidemark.operators import state
from tidemark.plans.fixtures import BARS_EV, NEWS_EV, returns_sql, sql, table
from tidemark.plans.market_queries import GOLD_PARTS, IMPACT_PARTS, gold, impact_rows
from tidemark.plans.news_queries import COMPANIES, RULED
from tidemark.sources import lake

QUERIES: dict = {}
ORACLES: dict[str, str] = {}


def query(oracle: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if oracle:
            ORACLES[f.__name__] = oracle
        return f

    return add


@query("SELECT event_id, ts, event_type FROM events WHERE event_type IN ('purchase', 'click') ORDER BY ts DESC, event_id DESC LIMIT 50")
def latest_news(spark, sf_dir):
    e = table(spark, sf_dir, "events").filter(F.col("event_type").isin("purchase", "click"))
    return e.orderBy(F.desc("ts"), F.desc("event_id")).limit(50).select("event_id", "ts", "event_type")


@query(sql(RULED, "SELECT DISTINCT unnest(r) AS ticker FROM d"))
def distinct_tickers(spark, sf_dir):
    return table(spark, sf_dir, "documents").select(F.explode(tickers(F.col("text"), COMPANIES)).alias("ticker")).distinct().orderBy("ticker")


@query(sql(*IMPACT_PARTS, "SELECT i.event_id, e.event_type, i.horizon_sessions, round(coalesce(raw_return - benchmark_return, raw_return), 6) AS impact FROM imp i JOIN events e USING (event_id) WHERE horizon_sessions = 1 ORDER BY abs(coalesce(raw_return - benchmark_return, raw_return)) DESC NULLS LAST, i.event_id LIMIT 100"))
def top_impacts_with_news(spark, sf_dir):
    rows = impact_rows(spark, sf_dir).filter("horizon_sessions = 1").withColumn("v", F.coalesce("abnormal_return", "raw_return"))
    rows = rows.join(table(spark, sf_dir, "events").select("event_id", "event_type"), "event_id")
    return rows.orderBy(F.abs("v").desc_nulls_last(), "event_id").limit(100).select("event_id", "event_type", "horizon_sessions", F.round("v", 6).alias("impact"))


@query(sql(*GOLD_PARTS, "f AS (SELECT min(event_id) AS event_id FROM gold)", "SELECT relative_session, session_date, round(stock_return * 100, 3) AS stock_pct, round(bench_return * 100, 3) AS benchmark_pct, round((stock_return - bench_return) * 100, 3) AS abnormal_pct FROM gold JOIN f USING (event_id)"))
def one_event_window(spark, sf_dir):
    """The window of the first event, in per cent."""
    g = gold(spark, sf_dir)
    rows = g.join(F.broadcast(g.agg(F.min("event_id").alias("event_id"))), "event_id")
    pct = lambda c, n: F.round(F.col(c) * 100, 3).alias(n)
    return rows.select("relative_session", "session_date", pct("stock_cumulative_return", "stock_pct"), pct("benchmark_cumulative_return", "benchmark_pct"), pct("abnormal_return", "abnormal_pct"))


def event_news(spark, sf_dir):
    return table(spark, sf_dir, "events").select("event_id", F.col("event_type").alias("title"), F.col("user_id").cast("string").alias("source"))


@query(sql(*GOLD_PARTS, "SELECT event_id, g.ticker, e.event_type AS title, count(*) FILTER (has_market_data) AS sessions FROM gold g JOIN events e USING (event_id) GROUP BY ALL"))
def event_choices(spark, sf_dir):
    return ev.event_choices(gold(spark, sf_dir), event_news(spark, sf_dir))


@query(sql(*GOLD_PARTS, "SELECT event_id, g.ticker, g.session_date, round(coalesce(stock_return - bench_return, stock_return) * 100, 3) AS moved_pct, e.event_type AS title, CAST(e.user_id AS VARCHAR) AS source FROM gold g JOIN events e USING (event_id) WHERE relative_session = 1 ORDER BY abs(coalesce(stock_return - bench_return, stock_return)) DESC NULLS LAST, event_id, g.ticker LIMIT 100"))
def windows_with_news(spark, sf_dir):
    rows = ev.windows_with_news(gold(spark, sf_dir), event_news(spark, sf_dir), 1)
    moved = F.round(F.coalesce("abnormal_return", "stock_cumulative_return") * 100, 3).alias("moved_pct")
    return rows.select("event_id", "ticker", "session_date", moved, "title", "source")


@query("SELECT user_id AS k, CASE WHEN a IS NULL THEN o ELSE a END AS v FROM (SELECT user_id, min(event_id) AS o, max(event_id * 10) FILTER (event_type = 'purchase') AS a FROM events GROUP BY user_id)")
def upsert_by_arrival(spark, sf_dir):
    """Old state: a user's first event. New rows: all purchases, of which the last to arrive stays."""
    e = table(spark, sf_dir, "events")
    old = e.groupBy(F.col("user_id").alias("k")).agg(F.min("event_id").alias("v"))
    new = e.filter("event_type = 'purchase'").select(F.col("user_id").alias("k"), (F.col("event_id") * 10).alias("v"), F.col("event_id").alias("arrival"))
    return state.replaced(old, new, ["k"]).select("k", "v")


@query(sql(BARS_EV, returns_sql("bars_ev"), NEWS_EV, "SELECT count(*) AS events, count(*) FILTER (after_close) AS after_close, count(DISTINCT ticker) AS tickers, count(*) FILTER (published_precision = 'timestamp') AS exact FROM news_ev"))
def event_counters(spark, sf_dir):
    from tidemark.plans.fixtures import news_ev

    return news_ev(spark, sf_dir).agg(F.count("*").alias("events"), F.count_if("after_close").alias("after_close"), F.count_distinct("ticker").alias("tickers"), F.count_if(F.col("published_precision") == "timestamp").alias("exact"))


@query("SELECT CASE WHEN no_url THEN 'skipped' WHEN code = 429 THEN 'rate_limited' WHEN code < 200 OR code >= 300 OR chars < 200 THEN 'failed' ELSE 'success' END AS status, count(*) AS n FROM (SELECT [200, 204, 301, 404, 429, 500][1 + event_id % 6] AS code, event_id % 400 AS chars, event_id % 13 = 0 AS no_url FROM events) GROUP BY status")
def crawl_outcomes(spark, sf_dir):
    e = table(spark, sf_dir, "events")
    code = F.get(F.array(*[F.lit(c) for c in (200, 204, 301, 404, 429, 500)]), (F.col("event_id") % 6).cast("int"))
    return e.groupBy(state.crawl_status(code, F.col("event_id") % 400, F.when(F.col("event_id") % 13 != 0, "https://x")).alias("status")).agg(F.count("*").alias("n"))


@query("SELECT key, arg_max(ticker, (n, -first_seen)) AS ticker FROM (SELECT lower(event_type) AS key, CAST(user_id % 5 AS VARCHAR) AS ticker, count(*) AS n, min(event_id) AS first_seen FROM events GROUP BY ALL) GROUP BY key")
def mention_table(spark, sf_dir):
    e = table(spark, sf_dir, "events")
    return ent.mention_table(e.select(F.col("event_type").alias("mention"), (F.col("user_id") % 5).cast("string").alias("ticker"), F.col("event_id").alias("seen")))


@query("SELECT count(*) AS n, 0::BIGINT AS different FROM orders")
def model_parity(spark, sf_dir):
    """Predictions from a fitted model's coefficients by plain expressions, against those of the model saved and read again."""
    from pyspark.ml import PipelineModel
    from pyspark.ml.functions import vector_to_array

    o = table(spark, sf_dir, "orders").select("o_orderkey", (F.col("o_totalprice") / 1e5).alias("price"), (F.col("o_custkey") % 10).cast("double").alias("cust"), (F.col("o_totalprice") > 2e5).cast("int").alias("y"))
    path = lake.scratch(spark, "parity-model")
    mt.baseline(o, ["price", "cust"], "y").write().overwrite().save(path)  # the fitted one holds its training summary
    model = PipelineModel.load(path)
    lr = model.stages[-1]  # a coefficient matrix of two rows
    own = mt.linear_prediction(F.col("x"), lr.coefficientMatrix.toArray().tolist(), list(lr.interceptVector))
    out = model.transform(o).withColumn("x", vector_to_array("features")).withColumn("own", own)
    return out.agg(F.count("*").alias("n"), F.count_if(F.col("own") != F.col("prediction")).alias("different"))


@query(sql(BARS_EV, "SELECT ticker, min(session_date) AS first_session, max(session_date) AS last_session, count(*) AS sessions FROM bars_ev GROUP BY ticker"))
def stored_coverage(spark, sf_dir):
    from tidemark.plans.fixtures import bars_ev

    return bars_ev(spark, sf_dir).groupBy("ticker").agg(F.min("session_date").alias("first_session"), F.max("session_date").alias("last_session"), F.count("*").alias("sessions"))
