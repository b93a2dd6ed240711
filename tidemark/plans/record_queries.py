"""Registered queries over raw records: sources and sinks, times, addresses, bodies, filters, collector tables."""

from __future__ import annotations

import gzip
import zlib

import pandas as pd
from pyspark.sql import functions as F

from tidemark.functions import entities as ent
from tidemark.functions import text as tx
from tidemark.functions.tickers import tickers
from tidemark.operators import events as ev
from tidemark.operators import gates, indicators, market, news, sessions, state
from tidemark.operators.sides import spread
from tidemark.plans.fixtures import BARS_EV, NEWS_DOC, NEWS_EV, bars_ev, news_doc, news_ev, returns_sql, sql, table
from tidemark.plans.news_queries import COMPANIES, LOG, RULED, attempt_log, entity, gate_sql, in_news, silver
from tidemark.schemas import MARKET, NEWS
from tidemark.sources import feeds, lake
from tidemark.streaming import bronze

QUERIES: dict = {}
ORACLES: dict[str, str] = {}


def query(oracle: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if oracle:
            ORACLES[f.__name__] = oracle
        return f

    return add


BARS_TWO = "two AS (SELECT ticker, session_date, close, 'a' AS source FROM bars_ev UNION ALL SELECT ticker, session_date, close * 1.01, 'b' FROM bars_ev WHERE CAST(ticker AS BIGINT) % 2 = 0 AND day(session_date) % 3 > 0)"
TWO = "ix2 AS (SELECT *, row_number() OVER (PARTITION BY ticker ORDER BY session_date, source) AS i FROM two)"


def bars_two(spark, sf_dir):
    """Bars of which every other ticker has a second source on some days."""
    a = bars_ev(spark, sf_dir).select("ticker", "session_date", "close", F.lit("a").alias("source"))
    b = a.filter((F.col("ticker").cast("long") % 2 == 0) & (F.dayofmonth("session_date") % 3 > 0))
    return a.unionByName(b.withColumns({"close": F.col("close") * 1.01, "source": F.lit("b")}))


@query(sql(BARS_EV, BARS_TWO, TWO, NEWS_EV, "t AS (SELECT e.event_id, min(i) AS i FROM news_ev e JOIN ix2 x ON e.ticker = x.ticker AND x.session_date >= e.event_date + CAST(e.after_close AS INTEGER) GROUP BY e.event_id)",
  "k AS (SELECT e.event_id, max(i) AS i FROM news_ev e JOIN ix2 x ON e.ticker = x.ticker AND x.session_date <= e.event_date + CAST(e.after_close AS INTEGER) - 1 GROUP BY e.event_id)",
  "SELECT e.event_id, a.session_date AS t0_date, CAST(t.i AS INTEGER) AS t0_index, b.session_date AS known_date, round(b.close, 6) AS known_close, CAST(k.i AS INTEGER) AS known_index FROM news_ev e LEFT JOIN t USING (event_id) LEFT JOIN k USING (event_id) LEFT JOIN ix2 a ON a.ticker = e.ticker AND a.i = t.i LEFT JOIN ix2 b ON b.ticker = e.ticker AND b.i = k.i"))
def two_source_asof(spark, sf_dir):
    """T0 and the last known close where a date has bars of two sources: nothing of a later date is seen."""
    ix, e = market.indexed(bars_two(spark, sf_dir)), news_ev(spark, sf_dir).select("event_id", "ticker", "event_date", "after_close")
    t0 = sessions.reaction_session(e, ix).select("event_id", "t0_date", "t0_index")
    known = sessions.known_session(e, ix).select("event_id", "known_date", F.round("known_close", 6).alias("known_close"), "known_index")
    return e.select("event_id").join(t0, "event_id", "left").join(known, "event_id", "left")


TWO_RETURNS = "sr AS (SELECT *, close / nullif(lag(close) OVER (PARTITION BY ticker ORDER BY i), 0) - 1 AS r FROM ix2), br AS (SELECT session_date, avg(close) / nullif(lag(avg(close)) OVER (ORDER BY session_date), 0) - 1 AS b FROM two GROUP BY session_date)"


@query(sql(BARS_EV, BARS_TWO, TWO, NEWS_EV, TWO_RETURNS, "t AS (SELECT e.event_id, e.ticker, min(i) AS i FROM news_ev e JOIN ix2 x ON e.ticker = x.ticker AND x.session_date >= e.event_date + CAST(e.after_close AS INTEGER) GROUP BY ALL)",
  "SELECT t.event_id, o AS relative_session, s.session_date, s.source, round(s.r, 6) AS session_return, round(s.r - b, 6) AS abnormal_session_return FROM t CROSS JOIN (SELECT unnest([-5, -3, -2, -1, 0, 1, 2, 3, 5]) AS o) JOIN sr s ON s.ticker = t.ticker AND s.i = t.i + o LEFT JOIN br ON br.session_date = s.session_date"))
def two_source_windows(spark, sf_dir):
    """Sessions around events where a date has bars of two sources: each bar is a session, in the order of its source."""
    bars = bars_two(spark, sf_dir)
    average = bars.groupBy("session_date").agg(F.avg("close").alias("close"))
    out = ev.session_windows(news_ev(spark, sf_dir), bars, average)
    return out.select("event_id", "relative_session", "session_date", "source", F.round("session_return", 6).alias("session_return"), F.round("abnormal_session_return", 6).alias("abnormal_session_return"))


FEATURES = ("market_return_1d", "market_momentum_5")
FEATURE_SQL = "ft AS (SELECT ticker, session_date, daily_return AS market_return_1d, close / nullif(lag(close, 5) OVER (PARTITION BY ticker ORDER BY session_date), 0) - 1 AS market_momentum_5 FROM bars_ev_r)"


@query(sql(BARS_EV, returns_sql("bars_ev"), NEWS_EV, FEATURE_SQL, "SELECT e.event_id, e.ticker, f.session_date AS known_date, round(f.market_return_1d, 6) AS market_return_1d, round(f.market_momentum_5, 6) AS market_momentum_5 FROM (SELECT *, event_date - CASE WHEN published_precision = 'timestamp' AND after_close THEN 0 ELSE 1 END AS eff FROM news_ev) e ASOF LEFT JOIN ft f ON e.ticker = f.ticker AND e.eff >= f.session_date"))
def known_features(spark, sf_dir):
    """Market features of the last session known at each event."""
    out = sessions.with_known_features(news_ev(spark, sf_dir), indicators.model_features(bars_ev(spark, sf_dir)), list(FEATURES))
    return out.select("event_id", "ticker", "known_date", *[F.round(c, 6).alias(c) for c in FEATURES])


@query(sql(BARS_EV, "SELECT sha256(ticker || '|' || CAST(session_date AS VARCHAR) || '|1d|yahoo') AS event_id, 'market.daily.collected' AS event_type, ticker, CAST(session_date AS VARCHAR) AS session_date, 'split_dividend_adjusted' AS price_adjustment, round(close, 6) AS close, '2024-02-01' AS ingest_date FROM bars_ev"))
def market_json_bronze(spark, sf_dir):
    """Provider rows to raw bars, through JSON files by schema."""
    path = lake.scratch(spark, "bars")
    raw = lake.bronze_market(bars_ev(spark, sf_dir).withColumnRenamed("session_date", "date"), "yahoo", F.lit("2024-02-01T00:00:00+00:00"))
    lake.write_json(raw, path)
    return lake.read_json(spark, path, MARKET).select("event_id", "event_type", "ticker", "session_date", "price_adjustment", F.round("close", 6).alias("close"), "ingest_date")


STORED = "st AS (SELECT doc_id, 'T' || CAST(doc_id AS VARCHAR) AS title, source, CASE WHEN doc_id % 3 = 0 THEN '' ELSE 'https://n/' || CAST(doc_id AS VARCHAR) END AS url, trim(text, ' ') AS content, doc_id % 5 = 0 AS bad FROM documents WHERE doc_id % 4 <> 0)"


@query(sql(STORED, "SELECT sha256(CASE WHEN url = '' THEN source || '|' || title ELSE url END) AS event_id, 'news.historical.exported' AS event_type, title, length(content) AS content_length, CASE WHEN length(content) >= 200 THEN 'success' ELSE 'metadata_only' END AS article_enrichment_status, CASE WHEN bad THEN '' ELSE '2024-03-05T02:00:00+00:00' END AS published_at_utc, CASE WHEN bad THEN 'soon' ELSE '2024-03-05T09:00:00+07:00' END AS published_at_vn FROM st"))
def news_json_bronze(spark, sf_dir):
    """Stored news to raw events, through JSON files by schema."""
    i, path = F.col("doc_id"), lake.scratch(spark, "news")
    rows = table(spark, sf_dir, "documents").select(
        F.concat(F.lit("T"), i.cast("string")).alias("title"), F.lit("").alias("summary"), F.col("text").alias("content"), F.when(i % 3 == 0, "").otherwise(F.concat(F.lit("https://n/"), i.cast("string"))).alias("url"), "source",
        F.when(i % 5 == 0, "soon").otherwise("2024-03-05T09:00:00+07:00").alias("published"), F.when(i % 4 == 0, F.array().cast("array<string>")).otherwise(F.array(F.lit("X"))).alias("tickers"),
    )
    lake.write_json(lake.bronze_news(rows, F.lit("2024-03-06T00:00:00+00:00"), lake.EXPORTED), path, rows_per_file=500)
    out = lake.read_json(spark, path, NEWS)
    return out.select("event_id", "event_type", "title", F.col("content_length").cast("long").alias("content_length"), "article_enrichment_status", "published_at_utc", "published_at_vn")


@query("SELECT CAST(doc_id AS VARCHAR) AS key, lang, source FROM documents d WHERE NOT EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id)")
def messages_once(spark, sf_dir):
    """Messages for a broker, of rows that were not sent before; their payload is read again."""
    sent = table(spark, sf_dir, "labels").select("doc_id").distinct()
    new = state.unseen(table(spark, sf_dir, "documents").select("doc_id", "lang", "source"), [sent], "doc_id")
    return bronze.messages_out(new, "doc_id").select("key", *[F.get_json_object("value", f"$.{c}").alias(c) for c in ("lang", "source")])


@query("SELECT p_partkey, CASE WHEN p_partkey % 4 = 0 THEN 'Google News RSS' ELSE 'Paper ' || CAST(p_partkey % 3 AS VARCHAR) END AS publisher, CASE WHEN p_partkey % 2 = 0 THEN TIMESTAMP '2024-03-05 09:00:00' END AS published FROM part WHERE p_partkey % 5 <> 0")
def search_feed(spark, sf_dir):
    """Parts as items of a search feed, with other names of the date and other ways to write it."""
    p, k = table(spark, sf_dir, "part"), F.col("p_partkey")
    link = F.when(k % 5 == 0, "").otherwise("<link>https://x</link>")
    source = F.when(k % 4 == 0, "").otherwise(F.concat(F.lit("<source>Paper "), (k % 3).cast("string"), F.lit("</source>")))
    date = F.when(k % 4 == 0, "<pubDate>5 Mar 2024 09:00 GMT</pubDate>").when(k % 4 == 2, "<date>2024-03-05T16:00:00+07:00</date>").otherwise("<published>yesterday</published>")
    xml = F.concat(F.lit("<rss><channel><item><title>t</title>"), link, source, date, F.lit("</item></channel></rss>"))
    return feeds.search_items(p.select("p_partkey", xml.alias("xml"))).select("p_partkey", "publisher", F.col("published").cast("timestamp_ntz").alias("published"))


@query("SELECT o_orderkey, o_orderstatus, o_comment FROM (SELECT o_orderkey, o_orderstatus, 'a, \"b\" ' || o_orderpriority AS o_comment FROM orders)")
def csv_roundtrip(spark, sf_dir):
    path = lake.scratch(spark, "csv")
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus", F.concat(F.lit('a, "b" '), "o_orderpriority").alias("o_comment"))
    lake.write_csv(o, path)
    return spark.read.option("header", True).schema(o.schema).csv(path)


@query("SELECT o_orderstatus, count(*) AS n FROM orders WHERE o_orderstatus = 'P' GROUP BY ALL")
def quarantine_readback(spark, sf_dir):
    """Invalid rows lie apart, and can be read there."""
    path, apart = lake.scratch(spark, "valid"), lake.scratch(spark, "quarantine")
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus", (F.col("o_orderstatus") != "P").alias("is_valid"))
    lake.write_valid(o, path, "o_orderstatus", apart)
    return spark.read.parquet(apart).groupBy("o_orderstatus").agg(F.count("*").alias("n"))


@query("SELECT c_custkey, c_name || ' & é <x>' AS plain FROM customer")
def page_texts(spark, sf_dir):
    """Markup, entities and references that lost their ampersand."""
    html = F.concat(F.lit("<b>"), F.col("c_name"), F.lit("</b>  &amp; #233; &lt;x&gt; "))
    return table(spark, sf_dir, "customer").select("c_custkey", tx.html_text(html).alias("plain"))


@query("SELECT event_id, CASE event_id % 4 WHEN 0 THEN date_trunc('second', ts) WHEN 1 THEN date_trunc('second', ts) - INTERVAL 7 HOUR WHEN 2 THEN date_trunc('second', ts) - INTERVAL 7 HOUR END AS at FROM events")
def instants(spark, sf_dir):
    """Times with Z, with another offset, without one (local times), and text that is none."""
    i, iso = F.col("event_id") % 4, F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss")
    raw = F.when(i == 0, F.concat(iso, F.lit("Z"))).when(i == 1, F.concat(iso, F.lit("+07:00"))).when(i == 2, iso).otherwise("soon")
    return table(spark, sf_dir, "events").select("event_id", tx.instant(raw).cast("timestamp_ntz").alias("at"))


@query("SELECT page_id, CASE WHEN page_id % 4 < 3 THEN sha256(html) END AS page_sha256 FROM pages")
def http_bodies(spark, sf_dir):
    """Pages as gzip, deflate and plain bodies; another encoding is refused."""

    @F.pandas_udf("binary")
    def packed(pages: pd.Series, ids: pd.Series) -> pd.Series:
        ways = [gzip.compress, zlib.compress, bytes, bytes]
        return pd.Series([ways[i % 4](p.encode()) for p, i in zip(pages, ids, strict=True)])

    kind = F.get(F.array(*[F.lit(x) for x in ("gzip", "deflate", "identity", "br")]), (F.col("page_id") % 4).cast("int"))
    rows = table(spark, sf_dir, "pages").select("page_id", packed("html", "page_id").alias("body"), kind.alias("encoding"))
    return feeds.body_text(rows, "body", "encoding").select("page_id", F.sha2("page", 256).alias("page_sha256"))


@query("SELECT c_custkey, ['https://h/i.png', 'https://h/a/i.png', 'https://o/x', NULL][1 + c_custkey % 4] AS url FROM customer")
def absolute_links(spark, sf_dir):
    link = F.get(F.array(*[F.lit(x) for x in ("/i.png", "i.png", "https://o/x", "")]), (F.col("c_custkey") % 4).cast("int"))
    return table(spark, sf_dir, "customer").select("c_custkey", tx.absolute_url(F.lit("https://h/a/b.html"), link).alias("url"))


@query("SELECT p_partkey, len(string_split(p_name, ' ')) AS tokens, length(p_name) AS last_end FROM part")
def token_places(spark, sf_dir):
    t = spread(table(spark, sf_dir, "part").select("p_partkey", "p_name")).select("p_partkey", ent.tokens(F.col("p_name")).alias("t"))
    return t.select("p_partkey", F.size("t").cast("long").alias("tokens"), F.element_at("t", -1)["end"].cast("long").alias("last_end"))


TOKENS = r"t AS (SELECT p_partkey, regexp_extract_all(p_brand || ' ' || p_type || ' ' || p_name, '[A-Za-z0-9_]+(?:[.-][A-Za-z0-9_]+)*|[^A-Za-z0-9_\s]') AS w FROM part), u AS (SELECT p_partkey, unnest(w) AS w, generate_subscripts(w, 1) AS i FROM t)"
SEEN = "v AS (SELECT p_partkey, i, w, lower(w) AS lower, upper(w) = w AND lower(w) <> w AS is_upper, regexp_full_match(w, '[^A-Za-z]*([A-Z][a-z]*([^A-Za-z]+|$))+') AS is_title FROM u)"
SIDES = ", ".join(f"{f}({c}) OVER s AS {side}_{c}" for f, side in (("lag", "back"), ("lead", "ahead")) for c in ("lower", "is_upper", "is_title"))


@query(sql(TOKENS, SEEN, f"SELECT p_partkey, i - 1 AS place, lower, right(lower, 3) AS last3, right(lower, 2) AS last2, left(lower, 3) AS first3, is_upper, is_title, regexp_full_match(w, '[0-9]+') AS is_digit, regexp_matches(w, '[0-9]') AS has_digit, least(length(w), 20) AS length, {SIDES}, lag(i) OVER s IS NULL AS first, lead(i) OVER s IS NULL AS last FROM v WINDOW s AS (PARTITION BY p_partkey ORDER BY i)"))
def token_features(spark, sf_dir):
    """What a sequence labeller sees of each token of brand, type and name."""
    texts = spread(table(spark, sf_dir, "part").select("p_partkey", F.concat_ws(" ", "p_brand", "p_type", "p_name").alias("text")))
    t = texts.select("p_partkey", ent.tokens(F.col("text")).alias("t"))
    seen = ent.token_features(t, "t").select("p_partkey", F.posexplode("features").alias("place", "f"))
    return seen.select("p_partkey", F.col("place").cast("long").alias("place"), "f.*").withColumn("length", F.col("length").cast("long"))


ANY = in_news("and","thatre", "inn", "pour", "que", "nicht", "elle", "the", "erenin")
SECOND = [in_news("inn", "par"), in_news("que", "nicht")]
FIRST = [in_news("inn", "pour"), in_news("que", "nicht", "elle")]


@query(sql(NEWS_DOC, f"SELECT event_id, doc_id FROM news WHERE {ANY}"))
def silver_with_ticker(spark, sf_dir):
    """Only rows that name a ticker."""
    return news.news_silver(news_doc(spark, sf_dir), rule=lambda t: tickers(t, COMPANIES), tie=("doc_id",)).select("event_id", "doc_id")


@query(sql(NEWS_DOC, f"SELECT count(*) AS total, count(*) FILTER (len(errors) = 0) AS valid, count(*) FILTER ({ANY} OR {SECOND[0]} OR {SECOND[1]}) AS with_ticker, count(*) FILTER (has_full_text) AS full_text, count(*) FILTER (({SECOND[0]} AND NOT {FIRST[0]}) OR ({SECOND[1]} AND NOT {FIRST[1]})) AS entity_added FROM news"))
def silver_counts(spark, sf_dir):
    return news.counts(silver(spark, sf_dir, entity=entity))


@query(sql(NEWS_DOC, "SELECT doc_id, published_date_ AS event_date FROM raw_news WHERE published_date_ IS NOT NULL"))
def timed_events(spark, sf_dir):
    """Events without a readable time go."""
    rows = news_doc(spark, sf_dir).select("doc_id", F.array("source").alias("tickers"), F.try_to_timestamp("published_at_utc").alias("published_timestamp"))
    return ev.local_events(rows).select("doc_id", "event_date")


@query(sql(RULED, "SELECT doc_id, array_to_string(list_sort(list_filter(r, lambda x: x IN ('AND', 'QUE'))), ',') AS tickers FROM d"))
def basket_tickers(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", F.array_join(F.array_sort(tickers(F.col("text"), COMPANIES, ["AND", "QUE"])), ",").alias("tickers"))


@query(sql(LOG, "SELECT id, count(*) FILTER (status NOT IN ('rate_limited', 'skipped')) AS attempts FROM log GROUP BY id HAVING count(*) FILTER (status NOT IN ('rate_limited', 'skipped')) < 5"))
def retry_state(spark, sf_dir):
    return state.retryable(state.attempts(attempt_log(spark, sf_dir))).select("id", "attempts")


@query("SELECT DISTINCT o_orderkey AS k FROM orders WHERE o_orderkey % 2 = 0 OR o_orderkey % 5 = 0")
def insert_ignore(spark, sf_dir):
    o = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("k"))
    return state.inserted(o.filter("k % 2 = 0").distinct(), o.filter("k % 5 = 0"), "k")


@query("SELECT event_id AS id, event_type AS source FROM events WHERE event_type IN ('click', 'purchase') AND 'U' || CAST(user_id % 9 AS VARCHAR) = 'U3' ORDER BY ts DESC NULLS LAST, event_id DESC LIMIT 100")
def filtered_news(spark, sf_dir):
    """The newest rows of chosen sources and one ticker."""
    e = table(spark, sf_dir, "events")
    rows = e.select(F.col("event_id").alias("id"), F.col("event_type").alias("source"), F.array(F.concat(F.lit("U"), (F.col("user_id") % 9).cast("string"))).alias("tickers"), F.col("ts").alias("published"))
    return news.filtered(rows, ["click", "purchase"], " u3 ").select("id", "source")


@query(sql(RULED, "SELECT doc_id FROM d WHERE list_has_any(r, ['INN', 'QUE'])"))
def universe_overlap(spark, sf_dir):
    d = table(spark, sf_dir, "documents").select("doc_id", tickers(F.col("text"), COMPANIES).alias("tickers"))
    return news.in_universe(d, ["INN", "QUE"]).select("doc_id")


@query(gate_sql({"missing_columns": "4", "wrong_row_sum": "0", "wrong_partitions": "0"}, "(SELECT count(*) FROM orders)"))
def gate_partitions(spark, sf_dir):
    o = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("event_id"), F.col("o_custkey").alias("ticker"))
    return gates.gate_partitions(o, 4)


@query(gate_sql({"missing_columns": "12", "too_few_rows": "0", "duplicate_event_ids": "0", "invalid_rows": "count(*)", "blank_titles": "count(*)", "unknown_tickers": "0"}, "customer"))
def gate_incomplete(spark, sf_dir):
    """A table that lacks columns is reported, not met with an error."""
    c = table(spark, sf_dir, "customer").select(F.col("c_custkey").cast("string").alias("event_id"), F.col("c_name").alias("url"))
    return gates.gate_news(c)
