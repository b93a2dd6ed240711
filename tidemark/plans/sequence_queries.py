"""Registered queries of the sequence model over documents."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions import entities as ent
from tidemark.functions.text import mention_key
from tidemark.operators import sequence as sq
from tidemark.plans.fixtures import sql, table

QUERIES: dict = {}
ORACLES: dict[str, str] = {}

#: Names that one extractor knows; the model learns them from its labels.
KNOWN = ["que", "und", "of the", "in the"]


def query(oracle: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if oracle:
            ORACLES[f.__name__] = oracle
        return f

    return add


def documents(spark, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", "text")


def learned(docs: DataFrame) -> sq.SequenceModel:
    """A model of all documents that are not held out."""
    return sq.learned(docs.filter("doc_id % 5 <> 0"), "text", sq.labeller(KNOWN))


TOKENS = r"t AS (SELECT doc_id, regexp_extract_all(lower(coalesce(text, '')), '[\pL\pN_]+(?:[.-][\pL\pN_]+)*|[^\pL\pN_\s]') AS w FROM documents)"
NAMED = "n AS (SELECT doc_id, name FROM (SELECT doc_id, w, unnest(range(1, len(w) + 1)) AS i FROM t) CROSS JOIN (SELECT unnest(['que', 'und', 'of the', 'in the']) AS name) WHERE name = CASE WHEN name IN ('que', 'und') THEN w[i] ELSE w[i] || ' ' || coalesce(w[i + 1], '') END)"


@query(sql(TOKENS, NAMED, "SELECT 1.0::DOUBLE AS precision, 1.0::DOUBLE AS recall, 1.0::DOUBLE AS f1, count(*) AS true_positive, 0::BIGINT AS false_positive, 0::BIGINT AS false_negative FROM n WHERE doc_id % 5 = 0"))
def sequence_f1(spark, sf_dir):
    """Spans of documents that the model did not learn from; the SQL counts what the extractor that labels them finds."""
    docs = documents(spark, sf_dir)
    held_out, model = docs.filter("doc_id % 5 = 0"), learned(docs)
    found = held_out.select(sq.entity_spans(F.col("text"), sq.by_names(KNOWN)).alias("gold"), sq.entity_spans(F.col("text"), sq.by_model(model)).alias("predicted"))
    return ent.range_scores(found, "gold", "predicted")


@query(sql(TOKENS, NAMED, "SELECT name AS mention, count(*) AS n, count(DISTINCT doc_id) AS docs FROM n GROUP BY name"))
def sequence_mentions(spark, sf_dir):
    """What the model finds in all documents, as linked mentions."""
    docs = documents(spark, sf_dir)
    found = docs.select("doc_id", "text", F.explode(sq.entity_spans(F.col("text"), sq.by_model(learned(docs)))).alias("s"))
    mention = F.substr("text", F.col("s.first_char") + 1, F.col("s.end_char") - F.col("s.first_char"))
    return found.groupBy(mention_key(mention).alias("mention")).agg(F.count("*").alias("n"), F.count_distinct("doc_id").alias("docs"))
