"""Registered queries through files, feeds, pages, entities and streams."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.functions import entities as ent
from tidemark.functions.text import mention_key
from tidemark.plans.fixtures import table
from tidemark.schemas import NEWS
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


@query("SELECT o_orderkey, o_orderstatus, round(o_totalprice, 2) AS o_totalprice, strftime(o_orderdate, '%Y-%m') AS month FROM orders")
def lake_json_roundtrip(spark, sf_dir):
    """Compressed JSON by month, read again by schema."""
    path = lake.scratch(spark, "roundtrip")
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice", F.date_format("o_orderdate", "yyyy-MM").alias("month"))
    lake.write_json(o.withColumn("m", F.col("month")), path, ["m"])
    out = lake.read_json(spark, path, o.schema)
    return out.withColumn("o_totalprice", F.round("o_totalprice", 2))


@query("SELECT strftime(o_orderdate, '%Y') AS year, count(*) AS n, round(sum(o_totalprice), 2) AS total FROM orders WHERE o_orderstatus <> 'P' GROUP BY year")
def lake_partitioned_overwrite(spark, sf_dir):
    """Valid rows by year; a second write replaces only the years that it holds."""
    path = lake.scratch(spark, "years")
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice", F.date_format("o_orderdate", "yyyy").alias("year"), (F.col("o_orderstatus") != "P").alias("is_valid"))
    lake.write_valid(o, path, "year", lake.scratch(spark, "quarantine"))
    lake.write_valid(o.filter("year = '1996'"), path, "year")
    return spark.read.parquet(path).groupBy(F.col("year").cast("string").alias("year")).agg(F.count("*").alias("n"), F.round(F.sum("o_totalprice"), 2).alias("total"))


@query("SELECT count(*) AS n_rows, min(CAST(o_orderdate AS DATE)) AS first_date, max(CAST(o_orderdate AS DATE)) AS last_date, count(*) FILTER (o_orderstatus = 'F') AS f_rows FROM orders")
def snapshot_manifest(spark, sf_dir):
    o = table(spark, sf_dir, "orders").withColumn("d", F.to_date("o_orderdate"))
    return lake.manifest(o, "d", "o_orderstatus").select(F.col("rows").alias("n_rows"), "first_date", "last_date", F.element_at("labels", "F").alias("f_rows"))


@query("SELECT count(*) AS n, round(sum(o_totalprice), 2) AS total, 2::BIGINT AS version, 1::BIGINT AS conflicts, 1::BIGINT AS expired FROM orders WHERE o_orderkey % 2 = 0")
def versioned_publish(spark, sf_dir):
    """Two runs are published, a third that was made from the first is refused; readers see the second, whose checksum holds."""
    root, o = lake.scratch(spark, "published"), table(spark, sf_dir, "orders")
    lake.publish(o, root, "first", "o_orderdate")
    lake.publish(o.filter("o_orderkey % 2 = 0"), root, "second", "o_orderdate")
    conflicts = 0
    try:
        lake.publish(o.filter("o_orderkey % 3 = 0"), root, "third", "o_orderdate", based_on=1)
    except lake.PublishConflict:
        conflicts = 1
    rows = lake.published(spark, root, verify=True)
    gone = lake.expire(spark, root, older_than_ms=1 << 60)
    facts = [F.lit(x).cast("long").alias(n) for n, x in (("version", lake.manifest_of(spark, root)["version"]), ("conflicts", conflicts), ("expired", len(gone)))]
    return rows.agg(F.count("*").alias("n"), F.round(F.sum("o_totalprice"), 2).alias("total"), *facts)


@query("SELECT o_orderstatus, count(*) AS n FROM orders GROUP BY o_orderstatus")
def rebalanced_write(spark, sf_dir):
    """By status, of which three hold all rows: large values are written by several tasks."""
    path = lake.scratch(spark, "by-status")
    lake.write_partitioned(table(spark, sf_dir, "orders"), path, "o_orderstatus", file_mb=1)
    return spark.read.parquet(path).groupBy(F.col("o_orderstatus").cast("string").alias("o_orderstatus")).agg(F.count("*").alias("n"))


@query("SELECT p_partkey, trim(regexp_replace(p_name, '\\s+', ' ', 'g')) || ' & co' AS title, 'http://x/' || CAST(p_partkey AS VARCHAR) AS url, TIMESTAMP '2024-03-05 02:00:00' + to_minutes(CAST(p_partkey % 60 AS INTEGER)) AS published, 'timestamp' AS published_precision FROM part WHERE p_partkey % 9 <> 0")
def rss_items(spark, sf_dir):
    """Parts as feed documents, parsed again; items without a title are left out."""
    p = table(spark, sf_dir, "part")
    title = F.when(F.col("p_partkey") % 9 == 0, F.lit(" ")).otherwise(F.concat("p_name", F.lit(" &amp;amp; co")))
    when = F.concat(F.lit("Tue, 5 Mar 2024 09:"), F.lpad((F.col("p_partkey") % 60).cast("string"), 2, "0"), F.lit(":00 +0700"))
    xml = F.concat(F.lit("<rss><channel><title>c</title><item><title>"), title, F.lit("</title><link>http://x/"), F.col("p_partkey").cast("string"), F.lit("</link><description>d</description><pubDate>"), when, F.lit("</pubDate></item></channel></rss>"))
    return feeds.feed_items(p.select("p_partkey", xml.alias("xml"))).select("p_partkey", "title", "url", F.col("published").cast("timestamp_ntz").alias("published"), "published_precision")


P = r"""list_filter(list_transform(regexp_extract_all(html, '(?is)<p\b[^>]*>(.*?)</p>', 1), lambda p: trim(regexp_replace(regexp_replace(p, '<[^>]+>', ' ', 'g'), '[ \t\n\x0B\f\r]+', ' ', 'g'), ' ')), lambda p: length(p) >= 50)"""


@query(f"SELECT page_id, CAST(len(list_distinct({P})) AS INTEGER) AS paragraphs, list_sum(list_transform(list_distinct({P}), lambda p: length(p))) AS chars FROM pages")
def article_paragraphs(spark, sf_dir):
    p = table(spark, sf_dir, "pages").select("page_id", feeds.paragraphs(F.col("html")).alias("p"))
    total = F.aggregate("p", F.lit(0).cast("long"), lambda s, x: s + F.length(x))
    return p.select("page_id", F.size("p").alias("paragraphs"), F.when(F.size("p") > 0, total).alias("chars"))


@query()
def article_content(spark, sf_dir):
    """Scoped to the article element; tests hold it against fixed pages."""
    return feeds.article(table(spark, sf_dir, "pages")).select("page_id", "url", "article_title", "article_text", "article_author", "article_image")


@query("SELECT c_custkey, trim(regexp_replace(lower(c_name), '[^a-z0-9]+', ' ', 'g')) AS key FROM customer")
def mention_keys(spark, sf_dir):
    return table(spark, sf_dir, "customer").select("c_custkey", mention_key(F.col("c_name")).alias("key"))


@query("SELECT s_suppkey, CAST(s_suppkey AS VARCHAR) AS ticker, CASE WHEN s_suppkey % 2 = 0 THEN 1.0 ELSE round(2.0 * length(s_name) / (2 * length(s_name) + 1), 3) END AS link_confidence FROM supplier")
def entity_links(spark, sf_dir):
    """Names of suppliers, every other one with a letter added, are linked to the table of names."""
    s = table(spark, sf_dir, "supplier")
    known = s.select(mention_key(F.col("s_name")).alias("key"), F.col("s_suppkey").cast("string").alias("ticker"))
    asked = s.select("s_suppkey", F.when(F.col("s_suppkey") % 2 == 0, F.col("s_name")).otherwise(F.concat("s_name", F.lit("x"))).alias("mention"))
    return ent.linked(asked, known, known.limit(0)).select("s_suppkey", "ticker", "link_confidence")


@query("SELECT round(tp / (tp + fp), 4) AS precision, round(tp / (tp + fn), 4) AS recall, round(2 * tp / (2 * tp + fp + fn), 4) AS f1, CAST(tp AS BIGINT) AS true_positive, CAST(fp AS BIGINT) AS false_positive, CAST(fn AS BIGINT) AS false_negative FROM (SELECT sum(CASE WHEN p_partkey % 3 = 0 THEN 1 ELSE 0 END)::DOUBLE AS tp, sum(CASE WHEN p_partkey % 3 = 1 THEN 1 ELSE 0 END)::DOUBLE AS fp, sum(CASE WHEN p_partkey % 3 > 0 THEN 1 ELSE 0 END)::DOUBLE AS fn FROM part)")
def entity_metrics(spark, sf_dir):
    """Names of parts as texts: the true entity is the words two and three; an extractor finds it, or one word too many, or none."""
    p, i = table(spark, sf_dir, "part"), F.col("p_partkey") % 3
    text = F.concat(F.lit("Mua "), F.lit("Hòa "), F.lit("Phát "), F.col("p_name"))  # three words before the name
    span = lambda end: F.array(F.struct(F.lit(4).alias("start"), F.lit(end).alias("end")))
    rows = p.select(ent.tokens(text).alias("w"), span(12).alias("gold"), F.when(i == 0, span(12)).when(i == 1, span(14)).otherwise(F.array().cast(ent.SPAN)).alias("guess"))
    return ent.span_scores(rows.select(ent.bio(F.col("w"), F.col("gold")).alias("gold"), ent.bio(F.col("w"), F.col("guess")).alias("guess")), "gold", "guess")


@query("SELECT doc_id, 'src' || CAST(doc_id % 5 AS VARCHAR) AS source, length(text) AS chars FROM documents WHERE doc_id % 10 <> 3")
def stream_bronze(spark, sf_dir):
    """Documents as messages, every tenth of them broken: streamed to the raw zone and read again."""
    root = lake.scratch(spark, "stream")
    d = table(spark, sf_dir, "documents")
    event = F.to_json(F.struct(F.col("doc_id").cast("string").alias("event_id"), F.lit(1).alias("schema_version"), F.concat(F.lit("src"), (F.col("doc_id") % 5).cast("string")).alias("source"), F.col("text").alias("content")))
    d.select(F.when(F.col("doc_id") % 10 == 3, "not json").otherwise(event).alias("value")).write.text(f"{root}/in")
    stream = bronze.stream_bronze(bronze.files(spark, f"{root}/in"), f"{root}/bronze", f"{root}/dead", f"{root}/checkpoint")
    stream.awaitTermination()
    out = lake.read_json(spark, f"{root}/bronze", NEWS)
    return out.select(F.col("event_id").cast("long").alias("doc_id"), "source", F.length("content").cast("long").alias("chars"))
