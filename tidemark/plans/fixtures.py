"""Inputs of the registered queries, derived from the given tables, each as a DataFrame and as SQL of the same rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def bars_ev(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily bars per user from events, at prices around 100; weekends are left out."""
    e = table(spark, sf_dir, "events").select(F.col("user_id").cast("string").alias("ticker"), F.col("ts"), (F.col("value") + 100).alias("value"), F.to_date("ts").alias("session_date"))
    e = e.filter(~F.dayofweek("session_date").isin(1, 7))
    return e.groupBy("ticker", "session_date").agg(F.min_by("value", "ts").alias("open"), F.max("value").alias("high"), F.min("value").alias("low"), F.max_by("value", "ts").alias("close"), F.count("*").cast("double").alias("volume"))


BARS_EV = """bars_ev AS (
  SELECT CAST(user_id AS VARCHAR) AS ticker, CAST(ts AS DATE) AS session_date, arg_min(value + 100, ts) AS open, max(value + 100) AS high, min(value + 100) AS low, arg_max(value + 100, ts) AS close, CAST(count(*) AS DOUBLE) AS volume
  FROM events WHERE dayofweek(ts) NOT IN (0, 6) GROUP BY ALL)"""


def bars_li(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily bars per supplier from lineitem, over some years."""
    li = table(spark, sf_dir, "lineitem").select(F.col("l_suppkey").cast("string").alias("ticker"), F.to_date("l_shipdate").alias("session_date"), F.col("l_extendedprice").alias("p"), F.struct("l_orderkey", "l_linenumber", "l_extendedprice").alias("k"), "l_quantity")
    return li.groupBy("ticker", "session_date").agg(F.min_by("p", "k").alias("open"), F.max("p").alias("high"), F.min("p").alias("low"), F.max_by("p", "k").alias("close"), F.sum("l_quantity").alias("volume"))


BARS_LI = """bars_li AS (
  SELECT CAST(l_suppkey AS VARCHAR) AS ticker, CAST(l_shipdate AS DATE) AS session_date, arg_min(l_extendedprice, (l_orderkey, l_linenumber, l_extendedprice)) AS open, max(l_extendedprice) AS high,
    min(l_extendedprice) AS low, arg_max(l_extendedprice, (l_orderkey, l_linenumber, l_extendedprice)) AS close, sum(l_quantity) AS volume
  FROM lineitem GROUP BY ALL)"""


def returns(bars: DataFrame) -> DataFrame:
    from tidemark.operators.market import with_returns

    return with_returns(bars.withColumn("source", F.lit("feed")))


def returns_sql(name: str) -> str:
    return f"""{name}_r AS (
  SELECT *, lag(close) OVER w AS previous_close, close / nullif(lag(close) OVER w, 0) - 1 AS daily_return,
    CASE WHEN close / nullif(lag(close) OVER w, 0) > 0 THEN ln(close / nullif(lag(close) OVER w, 0)) END AS log_return
  FROM {name} WINDOW w AS (PARTITION BY ticker ORDER BY session_date))"""


def news_ev(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Purchases as news on one ticker each, in local time."""
    from tidemark.operators.events import local_events

    e = table(spark, sf_dir, "events").filter("event_type = 'purchase'")
    news = e.select("event_id", F.array(F.col("user_id").cast("string")).alias("tickers"), F.col("ts").cast("timestamp").alias("published_timestamp"), F.when(F.col("event_id") % 3 == 0, "date").otherwise("timestamp").alias("published_precision"))
    return local_events(news)


NEWS_EV = """news_ev AS (
  SELECT event_id, CAST(user_id AS VARCHAR) AS ticker, ts, ts + INTERVAL 7 HOUR AS event_at, CAST(ts + INTERVAL 7 HOUR AS DATE) AS event_date, hour(ts + INTERVAL 7 HOUR) >= 15 AS after_close,
    CASE WHEN event_id % 3 = 0 THEN 'date' ELSE 'timestamp' END AS published_precision
  FROM events WHERE event_type = 'purchase')"""


def bronze_market(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw bars with the faults that validation is for, two collections of some bars and two sources."""
    e = table(spark, sf_dir, "events")
    v, i = F.col("value"), F.col("event_id")
    return e.select(
        F.when(i % 97 == 0, None).otherwise(F.sha2(i.cast("string"), 256)).alias("event_id"),
        F.when(i % 89 == 0, 2).otherwise(1).alias("schema_version"),
        F.concat(F.lit(" u"), F.col("user_id").cast("string"), F.lit(" ")).alias("ticker"),
        F.when(i % 83 == 0, "no date").otherwise(F.date_format("ts", "yyyy-MM-dd")).alias("session_date"),
        F.when(i % 79 == 0, None).when(i % 73 == 0, "1h").otherwise("1d").alias("interval"),
        F.when(i % 71 == 0, -v).otherwise(v).alias("open"), F.when(i % 67 == 0, v * 0.5).otherwise(v * 1.25).alias("high"),
        F.when(i % 61 == 0, v * 1.5).otherwise(v * 0.75).alias("low"), F.when(i % 59 == 0, 0.0).otherwise(v * 1.125).alias("close"),
        F.when(i % 53 == 0, None).otherwise(F.col("user_id").cast("double")).alias("volume"),
        F.when(i % 2 == 0, "Feed_A ").otherwise("feed_b").alias("source"),
        F.when(i % 47 == 0, "soon").otherwise(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'")).alias("collected_at_utc"),
        i.alias("raw_id"),
    )


BRONZE_MARKET = """bronze AS (
  SELECT CASE WHEN event_id % 97 <> 0 THEN sha256(CAST(event_id AS VARCHAR)) END AS event_id, CASE WHEN event_id % 89 = 0 THEN 2 ELSE 1 END AS schema_version, 'U' || CAST(user_id AS VARCHAR) AS ticker,
    CASE WHEN event_id % 83 <> 0 THEN CAST(ts AS DATE) END AS session_date, CASE WHEN event_id % 79 = 0 THEN NULL WHEN event_id % 73 = 0 THEN '1h' ELSE '1d' END AS "interval",
    CASE WHEN event_id % 71 = 0 THEN -value ELSE value END AS open, CASE WHEN event_id % 67 = 0 THEN value * 0.5 ELSE value * 1.25 END AS high,
    CASE WHEN event_id % 61 = 0 THEN value * 1.5 ELSE value * 0.75 END AS low, CASE WHEN event_id % 59 = 0 THEN 0.0 ELSE value * 1.125 END AS close,
    CASE WHEN event_id % 53 <> 0 THEN CAST(user_id AS DOUBLE) END AS volume, CASE WHEN event_id % 2 = 0 THEN 'feed_a' ELSE 'feed_b' END AS source,
    CASE WHEN event_id % 47 <> 0 THEN ts END AS collected, event_id AS raw_id
  FROM events), latest AS (
  SELECT * FROM bronze QUALIFY row_number() OVER (PARTITION BY ticker, session_date, "interval", source ORDER BY collected DESC NULLS LAST, raw_id) = 1), silver AS (
  SELECT *, list_filter([
    CASE WHEN event_id IS NULL THEN 'missing_event_id' END, CASE WHEN NOT regexp_matches(ticker, '^[A-Z0-9]{2,10}$') THEN 'invalid_ticker' END, CASE WHEN session_date IS NULL THEN 'invalid_session_date' END,
    CASE WHEN "interval" <> '1d' THEN 'unsupported_interval' END, CASE WHEN open IS NULL OR open <= 0 THEN 'invalid_open' END, CASE WHEN high IS NULL OR high <= 0 THEN 'invalid_high' END,
    CASE WHEN low IS NULL OR low <= 0 THEN 'invalid_low' END, CASE WHEN close IS NULL OR close <= 0 THEN 'invalid_close' END,
    CASE WHEN high + slack < greatest(open, close, low) THEN 'high_below_ohlc' END, CASE WHEN low - slack > least(open, close, high) THEN 'low_above_ohlc' END,
    CASE WHEN volume IS NULL OR volume < 0 THEN 'invalid_volume' END, CASE WHEN collected IS NULL THEN 'invalid_collected_at' END, CASE WHEN schema_version <> 1 THEN 'unsupported_schema' END], lambda x: x IS NOT NULL) AS errors
  FROM (SELECT *, greatest(abs(open), abs(high), abs(low), abs(close)) * 1e-6 + 1e-6 AS slack, lag(close) OVER (PARTITION BY ticker, source ORDER BY session_date NULLS FIRST, "interval" NULLS FIRST) AS previous_close FROM latest))"""


def news_doc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as raw news: repeated ids, missing fields and bad times among them."""
    d = table(spark, sf_dir, "documents")
    i = F.col("doc_id")
    day = F.date_format(F.date_add(F.lit("2024-01-01").cast("date"), (i % 90).cast("int")), "yyyy-MM-dd")
    return d.select(
        F.when(i % 101 == 0, None).otherwise(F.concat(F.lit("n"), (i - i % 2 * (i % 10 == 1).cast("int")).cast("string"))).alias("event_id"),
        F.when(i % 37 == 0, 3).otherwise(1).alias("schema_version"), F.upper("source").alias("source"),
        F.when(i % 41 == 0, "ftp://x").otherwise(F.concat(F.lit(" https://news/"), i.cast("string"))).alias("url"),
        F.when(i % 43 == 0, " <b></b> ").otherwise(F.concat(F.lit("<h1>Title "), i.cast("string"), F.lit("</h1>"))).alias("title"),
        F.substring("text", 1, 200).alias("summary"), F.col("text").alias("content"), "lang",
        F.when(i % 31 == 0, "yesterday").otherwise(F.concat(day, F.lit("T05:30:00Z"))).alias("published_at_utc"),
        F.when(i % 29 == 0, None).otherwise(F.concat(day, F.lit("T06:00:00Z"))).alias("collected_at_utc"), i.alias("doc_id"),
    )


NEWS_DOC = r"""raw_news AS (
  SELECT CASE WHEN doc_id % 101 <> 0 THEN 'n' || CAST(doc_id - CASE WHEN doc_id % 10 = 1 THEN doc_id % 2 ELSE 0 END AS VARCHAR) END AS event_id, CASE WHEN doc_id % 37 = 0 THEN 3 ELSE 1 END AS schema_version,
    lower(trim(upper(source))) AS source, trim(CASE WHEN doc_id % 41 = 0 THEN 'ftp://x' ELSE ' https://news/' || CAST(doc_id AS VARCHAR) END) AS url,
    CASE WHEN doc_id % 43 = 0 THEN '' ELSE 'Title ' || CAST(doc_id AS VARCHAR) END AS title,
    trim(regexp_replace(regexp_replace(substr(text, 1, 200), '<[^>]+>', ' ', 'g'), '[ \t\n\x0B\f\r]+', ' ', 'g')) AS summary, trim(regexp_replace(regexp_replace(text, '<[^>]+>', ' ', 'g'), '[ \t\n\x0B\f\r]+', ' ', 'g')) AS content, lang,
    CASE WHEN doc_id % 31 <> 0 THEN DATE '2024-01-01' + CAST(doc_id % 90 AS INTEGER) END AS published_date_, CASE WHEN doc_id % 29 <> 0 THEN DATE '2024-01-01' + CAST(doc_id % 90 AS INTEGER) END AS collected_date_, doc_id
  FROM documents), news AS (
  SELECT *, length(content) AS content_length, length(content) >= 200 AS has_full_text, coalesce(published_date_, collected_date_) AS published_date,
    trim(title || chr(10) || chr(10) || CASE WHEN length(content) >= 200 THEN content ELSE summary END, ' ') AS text_for_extraction,
    list_filter([CASE WHEN event_id IS NULL THEN 'missing_event_id' END, CASE WHEN length(title) = 0 THEN 'missing_title' END, CASE WHEN NOT regexp_matches(url, '^https?://') THEN 'invalid_url' END,
      CASE WHEN published_date_ IS NULL THEN 'invalid_published_at' END, CASE WHEN collected_date_ IS NULL THEN 'invalid_collected_at' END, CASE WHEN schema_version <> 1 THEN 'unsupported_schema' END], lambda x: x IS NOT NULL) AS errors
  FROM (SELECT * FROM raw_news QUALIFY row_number() OVER (PARTITION BY event_id ORDER BY length(content) >= 200 DESC, length(content) DESC, collected_date_ DESC NULLS LAST, doc_id) = 1))"""


def sql(*parts: str) -> str:
    """WITH clause of fixtures, then the query (the last part)."""
    return "WITH " + ",\n".join(parts[:-1]) + "\n" + parts[-1]
