"""Registered queries over news, gates and collector state."""

from __future__ import annotations

import re
import uuid

from pyspark.sql import functions as F

from tidemark.functions.text import CATEGORIES, OTHER_CATEGORY, category, clean_html
from tidemark.functions.tickers import NAMES, merged, tickers
from tidemark.operators import gates, market, news, state
from tidemark.operators.keyed import KeyedState
from tidemark.operators.quantiles import quantiles
from tidemark.operators.sides import kept
from tidemark.plans.fixtures import BRONZE_MARKET, NEWS_DOC, bronze_market, news_doc, sql, table
from tidemark.plans.market_queries import GOLD_PARTS, gold
from tidemark.sources import lake

QUERIES: dict = {}
ORACLES: dict[str, str] = {}

#: Invented companies: names are words of the documents.
COMPANIES = {"AND": ["thatre"], "THE": ["erenin"], "INN": ["pour"], "QUE": ["nicht", "elle"]}


def query(oracle: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if oracle:
            ORACLES[f.__name__] = oracle
        return f

    return add


def rule(text):
    return tickers(text, COMPANIES)


def entity(text):
    """A second extractor that knows fewer names."""
    return tickers(text, {"INN": ["par"], "QUE": ["nicht"]})


def silver(spark, sf_dir, **kw):
    return news.news_silver(news_doc(spark, sf_dir), keep_all=True, rule=rule, tie=("doc_id",), **kw)


@query(sql(NEWS_DOC, "SELECT event_id, doc_id, content_length, has_full_text FROM news"))
def news_dedup(spark, sf_dir):
    return news.best_version(news.cleaned(news_doc(spark, sf_dir)), "doc_id").select("event_id", "doc_id", F.col("content_length").cast("long").alias("content_length"), "has_full_text")


@query(sql(NEWS_DOC, "SELECT event_id, doc_id, source, url, title, published_date, strftime(published_date, '%Y-%m') AS published_year_month, sha256(text_for_extraction) AS content_hash, len(errors) = 0 AS is_valid FROM news"))
def news_silver(spark, sf_dir):
    return silver(spark, sf_dir).select("event_id", "doc_id", "source", "url", "title", "published_date", "published_year_month", "content_hash", "is_valid")


@query(sql(NEWS_DOC, "SELECT e AS error, count(*) AS n FROM (SELECT unnest(errors) AS e FROM news) GROUP BY e"))
def news_quality_errors(spark, sf_dir):
    return silver(spark, sf_dir).select(F.explode("data_quality_errors").alias("error")).groupBy("error").agg(F.count("*").alias("n"))


@query(r"SELECT page_id, sha256(trim(regexp_replace(regexp_replace(coalesce(html, ''), '<[^>]+>', ' ', 'g'), '[ \t\n\x0B\f\r]+', ' ', 'g'), ' ')) AS cleaned_sha256 FROM pages")
def html_cleaned(spark, sf_dir):
    return table(spark, sf_dir, "pages").select("page_id", F.sha2(clean_html("html"), 256).alias("cleaned_sha256"))


WORD = r"regexp_matches(' ' || coalesce(text, '') || ' ', '(?i)[^\pL\pN_]{w}[^\pL\pN_]')"


def found(*words):
    return "(" + " OR ".join(WORD.replace("{w}", w) for w in words) + ")"


def in_news(*words):
    """The same over the text of a silver row."""
    return found(*words).replace("coalesce(text, '')", "text_for_extraction")


RULED = f"d AS (SELECT doc_id, list_filter([CASE WHEN {found('and', 'thatre')} THEN 'AND' END, CASE WHEN {found('inn', 'pour')} THEN 'INN' END, CASE WHEN {found('que', 'nicht', 'elle')} THEN 'QUE' END, CASE WHEN {found('the', 'erenin')} THEN 'THE' END], lambda x: x IS NOT NULL) AS r, list_filter([CASE WHEN {found('inn', 'par')} THEN 'INN' END, CASE WHEN {found('que', 'nicht')} THEN 'QUE' END], lambda x: x IS NOT NULL) AS e FROM documents)"


@query(sql(RULED, "SELECT doc_id, array_to_string(list_sort(r), ',') AS tickers FROM d"))
def ticker_detect(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", F.array_join(F.array_sort(rule(F.col("text"))), ",").alias("tickers"))


def first_place(text: str, name: str) -> str:
    """SQL: characters before the first whole-word match of a name, null without one."""
    quoted = name.replace("'", "''")
    pattern = re.sub(r"([^\w\s])", r"\\\1", quoted)
    match = rf"(?is)^(.*?)(?:^|[^\pL\pN_])({pattern})(?:[^\pL\pN_]|$)"
    return f"CASE WHEN contains(lower({text}), lower('{quoted}')) AND regexp_matches({text}, '{match}') THEN length(regexp_replace(regexp_extract({text}, '(?is)^.*?(?:^|[^\\pL\\pN_]){pattern}(?:[^\\pL\\pN_]|$)'), '(?is){pattern}([^\\pL\\pN_]|$)$', '')) END"


def placed(names: dict[str, list[str]]) -> str:
    """SQL: tickers in the order of their places, joined by commas; lists before a colon are looked for in another column."""
    each = ", ".join(f"{{'place': coalesce({', '.join(first_place('text', n) for n in [t, *more])}), 'turn': {i}, 't': '{t}'}}" for i, (t, more) in enumerate(names.items()))
    return f"array_to_string(list_transform(list_sort(list_filter([{each}], lambda x: x.place IS NOT NULL)), lambda x: x.t), ',')"


@query(f"SELECT doc_id, {placed(COMPANIES)} AS tickers, {placed(NAMES)} AS listed FROM (SELECT doc_id, coalesce(text, '') AS text FROM documents)")
def ticker_extract(spark, sf_dir):
    """Invented companies, and those of the dictionary, each in the order of places."""
    return table(spark, sf_dir, "documents").select("doc_id", F.array_join(rule(F.col("text")), ",").alias("tickers"), F.array_join(tickers(F.col("text")), ",").alias("listed"))


@query(f"SELECT p_partkey, {placed(NAMES)} AS tickers FROM (SELECT p_partkey, {{0}} AS text FROM part)".replace("{0}", "p_name || CASE p_partkey % 4 WHEN 0 THEN ' - Hòa Phát, vnm và VINGROUP' WHEN 1 THEN ' (Ngân hàng Sài Gòn - Hà Nội) HPGX, fpt' WHEN 2 THEN ' ăACB; Tập đoàn FPT: thế giới di động' ELSE '' END"))
def ticker_names(spark, sf_dir):
    """Names of the dictionary among other words, in any case and between word boundaries."""
    k = F.col("p_partkey") % 4
    more = F.when(k == 0, " - Hòa Phát, vnm và VINGROUP").when(k == 1, " (Ngân hàng Sài Gòn - Hà Nội) HPGX, fpt").when(k == 2, " ăACB; Tập đoàn FPT: thế giới di động").otherwise("")
    return table(spark, sf_dir, "part").select("p_partkey", F.array_join(tickers(F.concat("p_name", more)), ",").alias("tickers"))


@query(sql(RULED, "SELECT t AS ticker, count(*) AS n FROM (SELECT unnest(r) AS t FROM d) GROUP BY t"))
def ticker_counts(spark, sf_dir):
    return table(spark, sf_dir, "documents").select(F.explode(rule(F.col("text"))).alias("ticker")).groupBy("ticker").agg(F.count("*").alias("n"))


@query(sql(RULED, "SELECT CASE WHEN list_sort(r) = list_sort(e) THEN 'agree' WHEN len(e) = 0 THEN 'rule_only' WHEN len(r) = 0 THEN 'entity_only' ELSE 'partial' END AS kind, count(*) AS n FROM d GROUP BY kind"))
def agreement(spark, sf_dir):
    return news.agreement(table(spark, sf_dir, "documents").select(rule(F.col("text")).alias("rulebased_tickers"), entity(F.col("text")).alias("ner_tickers")))


@query(sql(RULED, "SELECT count(*) AS docs, count(*) FILTER (len(r) > 0 OR len(e) > 0) AS with_ticker, count(*) FILTER (len(list_filter(e, lambda x: NOT list_contains(r, x))) > 0) AS entity_added FROM d"))
def merged_counts(spark, sf_dir):
    d = table(spark, sf_dir, "documents").select(rule(F.col("text")).alias("r"), entity(F.col("text")).alias("e"))
    return d.agg(F.count("*").alias("docs"), F.count_if(F.size(merged(F.col("r"), F.col("e"))) > 0).alias("with_ticker"), F.count_if(F.size(F.array_except("e", "r")) > 0).alias("entity_added"))


GATE = "SELECT unnest([{n}]) AS \"check\", unnest([{v}]) AS violations FROM ({q})"


def gate_sql(checks: dict[str, str], source: str) -> str:
    names = ", ".join(f"'{n}'" for n in checks)
    values = ", ".join(f"CAST(c{i} AS BIGINT)" for i in range(len(checks)))
    return GATE.format(n=names, v=values, q="SELECT " + ", ".join(f"{v} AS c{i}" for i, v in enumerate(checks.values())) + f" FROM {source}")


@query(sql(NEWS_DOC, gate_sql({"missing_columns": "0", "too_few_rows": "greatest(0, 100000 - count(*))", "duplicate_event_ids": "count(*) - count(DISTINCT coalesce(event_id, ''))", "invalid_rows": "count(*) FILTER (len(errors) > 0)", "blank_titles": "count(*) FILTER (title = '')", "unknown_tickers": f"count(*) FILTER {in_news('que', 'nicht', 'elle')}"}, "news")))
def gate_news(spark, sf_dir):
    return gates.gate_news(silver(spark, sf_dir), min_rows=100_000, universe=[t for t in COMPANIES if t != "QUE"])


@query(sql(BRONZE_MARKET, gate_sql({"missing_columns": "0", "too_few_rows": "greatest(0, 1000 - count(*))", "too_few_tickers": "greatest(0, 1000 - count(DISTINCT ticker))", "duplicate_keys": "count(*) - count(DISTINCT (ticker, coalesce(CAST(session_date AS VARCHAR), ''), coalesce(\"interval\", ''), source))", "invalid_rows": "count(*) FILTER (len(errors) > 0)", "weekend_rows": "count(*) FILTER (dayofweek(session_date) IN (0, 6))", "jumps": "count(*) FILTER (abs(close / nullif(previous_close, 0) - 1) > 0.5)"}, "silver")))
def gate_market(spark, sf_dir):
    return gates.gate_market(market.market_silver(bronze_market(spark, sf_dir), tie=("raw_id",)), min_rows=1000, min_tickers=1000)


@query(sql(*GOLD_PARTS, gate_sql({"too_few_pairs": "greatest(0, 10 - count(DISTINCT (event_id, ticker)))", "duplicate_keys": "count(*) - count(DISTINCT (event_id, ticker, relative_session))", "wrong_offsets": "CASE WHEN list_sort(list(DISTINCT relative_session)) = [-5, -3, -2, -1, 0, 1, 2, 3, 5] THEN 0 ELSE 1 END", "wrong_row_count": "abs(count(*) - 9 * count(DISTINCT (event_id, ticker)))", "look_ahead": "count(*) FILTER (t0_date < event_date OR (after_close AND t0_date = event_date))", "close_without_data": "count(*) FILTER (NOT has_market_data AND close IS NOT NULL)"}, "gold")))
def gate_gold(spark, sf_dir):
    return gates.gate_gold(gold(spark, sf_dir), min_pairs=10)


@query()
def partition_profile(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    return gates.partition_profile(o, 4, "o_orderkey", "o_custkey", {"open_orders": F.col("o_orderstatus") == "O", "large": F.col("o_totalprice") > 100_000})


ITEMS = """items AS (SELECT event_id, user_id, ts, CASE WHEN event_id % 5 = 0 THEN '' ELSE 'http://n/' || CAST(event_id % 700 AS VARCHAR) END AS url, 't' || CAST(event_id % 300 AS VARCHAR) AS title,
  CASE WHEN event_id % 2 = 0 THEN '' ELSE 'c' || CAST(event_id % 50 AS VARCHAR) END AS content, 's' || CAST(event_id % 40 AS VARCHAR) AS summary, ['A' || CAST(user_id % 7 AS VARCHAR), 'B' || CAST(event_id % 3 AS VARCHAR)] AS tickers,
  ['A' || CAST(user_id % 7 AS VARCHAR)] AS rulebased_tickers, CASE WHEN event_id % 4 = 0 THEN ['B' || CAST(event_id % 3 AS VARCHAR), 'C'] ELSE [] END AS ner_tickers, CASE WHEN event_id % 4 = 0 THEN 'hybrid' || CAST(event_id % 3 AS VARCHAR) ELSE 'rulebased' END AS strategy FROM events)"""


def items(spark, sf_dir):
    e, i = table(spark, sf_dir, "events"), F.col("event_id")
    text = lambda p, n: F.concat(F.lit(p), (i % n).cast("string"))
    return e.select(
        "event_id", "user_id", F.col("ts").alias("observed_at"), F.when(i % 5 == 0, "").otherwise(text("http://n/", 700)).alias("url"), text("t", 300).alias("title"),
        F.when(i % 2 == 0, "").otherwise(text("c", 50)).alias("content"), text("s", 40).alias("summary"),
        F.array(F.concat(F.lit("A"), (F.col("user_id") % 7).cast("string")), text("B", 3)).alias("tickers"), F.array(F.concat(F.lit("A"), (F.col("user_id") % 7).cast("string"))).alias("rulebased_tickers"),
        F.when(i % 4 == 0, F.array(text("B", 3), F.lit("C"))).alias("ner_tickers"), F.when(i % 4 == 0, text("hybrid", 3)).otherwise("rulebased").alias("strategy"),
    )


KEYED = "keyed AS (SELECT *, coalesce(nullif(url, ''), sha256(title || '|' || coalesce(nullif(content, ''), summary))) AS identity FROM items)"


def in_order(column: str) -> str:
    """SQL of a ticker array merged over the rows of an identity, by first occurrence."""
    return f"(SELECT coalesce(array_to_string(list(t ORDER BY o), ','), '') FROM (SELECT t, min((ts, event_id, i)) AS o FROM (SELECT ts, event_id, unnest({column}) AS t, generate_subscripts({column}, 1) AS i FROM keyed k WHERE k.identity = g.identity) GROUP BY t)) AS {column}"


@query(sql(ITEMS, KEYED, "g AS (SELECT identity, count(*) AS versions, arg_min(event_id, (ts, event_id)) AS first_id, coalesce(arg_max(strategy, (ts, event_id)) FILTER (strategy <> 'rulebased'), arg_min(strategy, (ts, event_id))) AS strategy FROM keyed GROUP BY identity)",
  f"SELECT identity, versions, first_id, strategy, {in_order('tickers')}, {in_order('rulebased_tickers')}, {in_order('ner_tickers')} FROM g"))
def news_upsert_merge(spark, sf_dir):
    """Ticker arrays keep their order here and in the SQL."""
    out = state.upserted(items(spark, sf_dir), order=("observed_at", "event_id"))
    return out.select("identity", "versions", F.col("event_id").alias("first_id"), "strategy", *[F.array_join(c, ",").alias(c) for c in ("tickers", "rulebased_tickers", "ner_tickers")])


@query(sql(ITEMS, KEYED, "g AS (SELECT identity, count(*) AS versions, arg_min(event_id, (ts, event_id)) AS first_id, coalesce(arg_max(strategy, (ts, event_id)) FILTER (strategy <> 'rulebased'), arg_min(strategy, (ts, event_id))) AS strategy FROM keyed GROUP BY identity)",
  f"SELECT identity, versions, first_id, strategy, {in_order('tickers')}, {in_order('ner_tickers')} FROM g"))
def keyed_upsert(spark, sf_dir):
    """The same merge into a stored table in three steps of time; each rewrites only the slots that its keys fall into."""
    rows = items(spark, sf_dir)
    low, high = rows.agg(F.min(F.unix_micros(F.col("observed_at").cast("timestamp"))), F.max(F.unix_micros(F.col("observed_at").cast("timestamp")))).first()
    third = F.least(F.lit(2), ((F.unix_micros(F.col("observed_at").cast("timestamp")) - low) * 3 / max(1, high - low)).cast("int"))
    steps = [state.upserted(rows.filter(third == i), order=("observed_at", "event_id")).select("identity", "event_id", "strategy", "tickers", "ner_tickers", "versions") for i in range(3)]
    table_ = KeyedState(spark, f"news_state_{uuid.uuid4().hex}", "identity", 8)
    table_.create(steps[0], lake.scratch(spark, "news-state"))
    for step in steps[1:]:
        table_.upsert(step)
    return table_.rows().select("identity", "versions", F.col("event_id").alias("first_id"), "strategy", *[F.array_join(c, ",").alias(c) for c in ("tickers", "ner_tickers")])


@query(sql(ITEMS, "keyed AS (SELECT *, coalesce(nullif(url, ''), sha256(title || '|' || coalesce(nullif(content, ''), summary))) AS identity FROM (SELECT * FROM items ORDER BY ts, event_id LIMIT 900))", "SELECT substr(sha1(identity), 1, 16) AS annotation_id, event_id AS id FROM keyed QUALIFY row_number() OVER (PARTITION BY identity ORDER BY ts, event_id) = 1"))
def annotation_first_rows(spark, sf_dir):
    """The annotation set of the earliest rows only: the ordered limit is the feature."""
    i = items(spark, sf_dir)
    rows = i.select(F.col("event_id").alias("id"), F.col("observed_at").alias("published"), "title", "url", F.lit("").alias("content_hash"), F.concat_ws("|", "title", F.coalesce(F.nullif(F.col("content"), F.lit("")), F.col("summary"))).alias("text"))
    return state.annotation_set(rows, limit=900).select("annotation_id", "id")


@query(sql(ITEMS, KEYED, "SELECT substr(sha1(identity), 1, 16) AS annotation_id, event_id AS id FROM keyed QUALIFY row_number() OVER (PARTITION BY identity ORDER BY ts, event_id) = 1"))
def annotation_set(spark, sf_dir):
    i = items(spark, sf_dir)
    rows = i.select(F.col("event_id").alias("id"), F.col("observed_at").alias("published"), "url", F.lit("").alias("content_hash"), F.concat_ws("|", "title", F.coalesce(F.nullif(F.col("content"), F.lit("")), F.col("summary"))).alias("text"))
    return state.annotation_set(rows).select("annotation_id", "id")


@query("SELECT event_id, event_type FROM events e WHERE event_id % 3 <> 0 AND NOT EXISTS (SELECT 1 FROM orders o WHERE o.o_orderkey = e.event_id AND o.o_orderstatus = 'F')")
def unseen_antijoin(spark, sf_dir):
    e = table(spark, sf_dir, "events")
    emitted = e.filter("event_id % 3 = 0").select("event_id")
    filtered = table(spark, sf_dir, "orders").filter("o_orderstatus = 'F'").select(F.col("o_orderkey").alias("event_id"))
    return state.unseen(e, [emitted, filtered], "event_id").select("event_id", "event_type")


LOG = "log AS (SELECT user_id AS id, ts AS tm, CASE WHEN value > 90 THEN 'rate_limited' WHEN value > 60 THEN 'failed' WHEN value > 40 THEN 'skipped' ELSE 'success' END AS status, CASE WHEN value > 60 THEN props END AS error FROM events WHERE event_type = 'click')"


def attempt_log(spark, sf_dir):
    v = F.col("value")
    return table(spark, sf_dir, "events").filter("event_type = 'click'").select(F.col("user_id").alias("id"), F.col("ts").alias("at"), F.when(v > 90, "rate_limited").when(v > 60, "failed").when(v > 40, "skipped").otherwise("success").alias("status"), F.when(v > 60, F.col("props")).alias("error"))


@query(sql(LOG, "SELECT id, count(*) FILTER (status NOT IN ('rate_limited', 'skipped')) AS attempts, arg_max(status, tm) AS status, substr(arg_max_null(error, tm), 1, 500) AS last_error FROM log GROUP BY id"))
def attempts_counter(spark, sf_dir):
    return state.attempts(attempt_log(spark, sf_dir))


@query(sql(LOG, "a AS (SELECT id, count(*) FILTER (status NOT IN ('rate_limited', 'skipped')) AS attempts, arg_max(status, tm) AS status FROM log GROUP BY id)", "n AS (SELECT c_custkey AS id, CASE WHEN c_custkey % 4 = 0 THEN 0 ELSE 1 END AS tickers, repeat('x', CAST(c_custkey % 400 AS INTEGER)) AS content, c_acctbal AS published FROM customer)",
  "SELECT n.id, coalesce(attempts, 0) AS attempts FROM n LEFT JOIN a USING (id) WHERE tickers > 0 AND length(content) < 200 AND coalesce(status, '') NOT IN ('success', 'skipped') AND coalesce(attempts, 0) < 12 ORDER BY n.id LIMIT 50"))
def crawl_candidates(spark, sf_dir):
    c = table(spark, sf_dir, "customer")
    rows = c.select(F.col("c_custkey").alias("id"), F.when(F.col("c_custkey") % 4 == 0, F.array().cast("array<string>")).otherwise(F.array(F.lit("X"))).alias("tickers"), F.expr("repeat('x', cast(c_custkey % 400 as int))").alias("content"), F.col("c_acctbal").alias("published"))
    return state.crawl_candidates(rows, state.attempts(attempt_log(spark, sf_dir)), 50, max_attempts=12).select("id", F.coalesce("attempts", F.lit(0)).alias("attempts"))


@query(sql("c AS (SELECT c_custkey AS id, c_acctbal, c_custkey % 4 = 0 AS bare, c_custkey % 6 AS attempts, c_custkey % 11 = 0 AS lost, c_custkey % 7 = 0 AS other, c_custkey % 400 AS chars FROM customer)", "n AS (SELECT id, row_number() OVER (ORDER BY c_acctbal, id) AS turn FROM c WHERE NOT bare AND attempts < 5)",
  "SELECT c.id, CASE WHEN bare THEN 'rejected' WHEN turn IS NULL OR turn > 500 THEN 'deferred' WHEN lost OR chars < 200 THEN 'failed' WHEN other THEN 'rejected' ELSE 'ready' END AS route FROM c LEFT JOIN n USING (id)"))
def ticker_gate_routes(spark, sf_dir):
    c, k = table(spark, sf_dir, "customer"), F.col("c_custkey")
    none, one = F.array().cast("array<string>"), F.array(F.lit("X"))
    rows = c.select(
        k.alias("id"), F.when(k % 4 == 0, none).otherwise(one).alias("tickers"), F.expr("repeat('x', cast(c_custkey % 400 as int))").alias("content"), F.col("c_acctbal").alias("observed_at"),
        (k % 6).alias("attempts"), F.when(k % 11 == 0, "").otherwise("https://x").alias("url"), F.when(k % 7 == 0, none).otherwise(one).alias("text_tickers"),
    )
    return state.routed(rows, 500).select("id", "route")


@query(sql("m AS (SELECT CAST(x AS DATE) AS m FROM (SELECT unnest(generate_series(DATE '2024-01-01', DATE '2024-06-19', INTERVAL 1 MONTH)) AS x))", "j AS (SELECT s_suppkey, CAST(s_suppkey AS VARCHAR) AS ticker, greatest(m, DATE '2024-01-15') AS \"from\", least(CAST(m + INTERVAL 1 MONTH AS DATE), DATE '2024-06-20') AS until FROM supplier, m)",
  "SELECT ticker, \"from\", until FROM (SELECT *, row_number() OVER (ORDER BY ticker, \"from\") AS turn FROM j) WHERE turn > 7 AND NOT (s_suppkey % 3 = 0 AND month(\"from\") = 2) AND NOT (s_suppkey % 5 = 0 AND month(\"from\") = 4)"))
def backfill_pending(spark, sf_dir):
    t = table(spark, sf_dir, "supplier").select(F.col("s_suppkey").cast("string").alias("ticker"), "s_suppkey")
    done = t.filter("s_suppkey % 3 = 0").select("ticker", F.lit("2024-02-01").cast("date").alias("from"), F.lit("success").alias("status"))
    failed = t.filter("s_suppkey % 5 = 0").select("ticker", F.lit("2024-04-01").cast("date").alias("from"), F.lit("failed").alias("status"))
    return state.pending_jobs(t.select("ticker"), "2024-01-15", "2024-06-20", done.unionByName(failed), offset=7)


@query("SELECT o_orderkey AS k, CASE WHEN o_orderkey % 10 = 0 THEN 'new' ELSE o_orderstatus END AS v FROM orders WHERE o_orderkey % 2 = 0 UNION ALL SELECT o_orderkey, 'new' FROM orders WHERE o_orderkey % 10 = 5")
def upsert_replace(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    old = o.filter("o_orderkey % 2 = 0").select(F.col("o_orderkey").alias("k"), F.col("o_orderstatus").alias("v"))
    return state.replaced(old, o.filter("o_orderkey % 5 = 0").select(F.col("o_orderkey").alias("k"), F.lit("new").alias("v")), ["k"])


@query("SELECT event_id, ts FROM (SELECT *, [user_id, user_id + 1] AS u FROM events) WHERE list_contains(u, 7) ORDER BY ts DESC, event_id LIMIT 20")
def array_contains_search(spark, sf_dir):
    e = table(spark, sf_dir, "events").withColumn("u", F.array("user_id", F.col("user_id") + 1))
    return e.filter(F.array_contains("u", F.lit(7).cast("long"))).orderBy(F.desc("ts"), "event_id").limit(20).select("event_id", "ts")


@query("SELECT source, count(*) AS n, count(*) FILTER (length(text) >= 1000) AS full_texts, round(100.0 * count(*) FILTER (length(text) >= 1000) / count(*), 2) AS rate_pct FROM documents GROUP BY source ORDER BY n DESC, source LIMIT 20")
def source_stats(spark, sf_dir):
    d = table(spark, sf_dir, "documents").groupBy("source").agg(F.count("*").alias("n"), F.count_if(F.length("text") >= 1000).alias("full_texts"))
    return d.withColumn("rate_pct", F.round(100.0 * F.col("full_texts") / F.col("n"), 2)).orderBy(F.desc("n"), "source").limit(20)


@query("SELECT CASE WHEN length(text) >= 1000 THEN 'full_text' ELSE 'metadata_only' END AS status, count(*) AS n, round(100.0 * count(*) / sum(count(*)) OVER (), 2) AS pct FROM documents GROUP BY status")
def content_status(spark, sf_dir):
    d = table(spark, sf_dir, "documents").groupBy(F.when(F.length("text") >= 1000, "full_text").otherwise("metadata_only").alias("status")).agg(F.count("*").alias("n"))
    return d.crossJoin(d.agg(F.sum("n").alias("_all"))).select("status", "n", F.round(100.0 * F.col("n") / F.col("_all"), 2).alias("pct"))


@query("SELECT count(*) AS n, round(avg(v), 4) AS mean, round(stddev_samp(v), 4) AS std, CAST(min(v) AS BIGINT) AS least, round(quantile_cont(v, 0.25), 4) AS q25, round(quantile_cont(v, 0.5), 4) AS q50, round(quantile_cont(v, 0.75), 4) AS q75, CAST(max(v) AS BIGINT) AS most FROM (SELECT length(text) AS v FROM documents WHERE length(text) >= 200)")
def length_describe(spark, sf_dir):
    v, at = F.col("v"), {"q25": 0.25, "q50": 0.5, "q75": 0.75}
    d = kept(table(spark, sf_dir, "documents").select(F.length("text").alias("v")).filter("v >= 200"), "lengths")
    whole = d.agg(F.count("*").alias("n"), F.round(F.avg(v), 4).alias("mean"), F.round(F.stddev_samp(v), 4).alias("std"), F.min(v).cast("long").alias("least"), F.max(v).cast("long").alias("most"))
    return whole.join(quantiles(d, "v", at).select(*[F.round(c, 4).alias(c) for c in at]), how="left")


@query("SELECT strftime(ts + INTERVAL 7 HOUR, '%Y-%m') AS month, count(*) AS n, min(ts) AS first_event, max(ts) AS last_event FROM events GROUP BY month")
def monthly_volume(spark, sf_dir):
    at = F.from_utc_timestamp(F.col("ts").cast("timestamp"), "Asia/Ho_Chi_Minh")
    return table(spark, sf_dir, "events").groupBy(F.date_format(at, "yyyy-MM").alias("month")).agg(F.count("*").alias("n"), F.min("ts").alias("first_event"), F.max("ts").alias("last_event"))


@query(sql(NEWS_DOC, "SELECT count(*) AS n, count(*) FILTER (has_full_text) AS full_texts, count(*) FILTER (len(errors) > 0) AS invalid, count(url) - count(DISTINCT url) AS duplicate_urls, count(*) - count(DISTINCT sha256(text_for_extraction)) AS duplicate_texts, count(DISTINCT source) AS sources, min(published_date) AS first_day, max(published_date) AS last_day FROM news"))
def news_quality(spark, sf_dir):
    return silver(spark, sf_dir).agg(F.count("*").alias("n"), F.count_if("has_full_text").alias("full_texts"), F.count_if(~F.col("is_valid")).alias("invalid"), (F.count("url") - F.count_distinct("url")).alias("duplicate_urls"), (F.count("*") - F.count_distinct("content_hash")).alias("duplicate_texts"), F.count_distinct("source").alias("sources"), F.min("published_date").alias("first_day"), F.max("published_date").alias("last_day"))


#: Phrases of the fixed table and one that is in none, with the turn of their category.
PHRASES = [(p, turn) for turn, phrases in enumerate(CATEGORIES.values()) for p in phrases] + [("khác", len(CATEGORIES))]
NAMES_SQL = "[" + ", ".join(f"'{n}'" for n in [*CATEGORIES, OTHER_CATEGORY]) + "]"
TURNS_SQL = "[" + ", ".join(str(t) for _, t in PHRASES) + "]"


@query(f"SELECT {NAMES_SQL}[1 + least({TURNS_SQL}[1 + doc_id % {len(PHRASES)}], {TURNS_SQL}[1 + doc_id * 7 % {len(PHRASES)}])] AS category, lang, count(*) AS n FROM documents GROUP BY ALL")
def category_counts(spark, sf_dir):
    """Documents with two phrases of the fixed table each: the category that comes first in the table counts."""
    phrases = F.array(*[F.lit(p) for p, _ in PHRASES])
    at = lambda i: F.get(phrases, (i % len(PHRASES)).cast("int"))
    d = table(spark, sf_dir, "documents").withColumn("t", F.concat_ws(" - ", F.upper(at(F.col("doc_id"))), F.lit("x"), at(F.col("doc_id") * 7)))
    return d.groupBy(category(F.col("t")).alias("category"), "lang").agg(F.count("*").alias("n"))


@query("SELECT CAST(LEAST(14, floor((v - lo) / ((hi - lo) / 15.0))) AS BIGINT) AS bin, count(*) AS n FROM (SELECT length(text) AS v, min(length(text)) OVER () AS lo, max(length(text)) OVER () AS hi FROM documents) GROUP BY bin")
def length_histogram(spark, sf_dir):
    d = table(spark, sf_dir, "documents").select(F.length("text").alias("v"))
    span = d.agg(F.min("v").alias("lo"), F.max("v").alias("hi"))  # one row
    width = (F.col("hi") - F.col("lo")) / 15.0
    return d.crossJoin(F.broadcast(span)).groupBy(F.least(F.lit(14), F.floor((F.col("v") - F.col("lo")) / width)).cast("long").alias("bin")).agg(F.count("*").alias("n"))
