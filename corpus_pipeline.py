"""From raw documents to token ids: drop toxic documents, drop lines that many documents hold, keep one document of each group
of near duplicates, drop documents that hold benchmark items, encode the rest.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as Parquet and read again as the next one's
docs. All but the last return the columns of documents.

Defined results, of every stage: an empty table gives an empty one; a null or empty text is a document without words and stays
until its stage says otherwise; very long texts are used whole; extra columns go along unchanged until the last stage, which
returns the columns that it names; rows are never told by their order.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.bpe import bpe_encode
from tidemark.llm.common import fold, sized, staged, table, unstaged
from tidemark.llm.decontaminate import contaminated
from tidemark.llm.line_dedup import line_dedup
from tidemark.llm.near_dedup import near_groups
from tidemark.llm.toxicity import fitted, toxicity_scores

VOCABULARY = "word_bpe_49k.json"


def column(name: str) -> Column:
    """A column by its whole name, dots and all."""
    return F.col("`" + name.replace("`", "``") + "`")


def apart(docs: DataFrame) -> tuple[DataFrame, dict[str, str]]:
    """docs with its other columns under names that no operator uses, and the name of each column there."""
    names = {c: c if c in ("doc_id", "text") else f"other column {i}" for i, c in enumerate(docs.columns)}
    return docs.select(*[column(c).alias(n) for c, n in names.items()]), names


def as_before(out: DataFrame, names: dict[str, str]) -> DataFrame:
    return out.select(*[column(n).alias(c) for c, n in names.items()])


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a score under 0.5; labels of the fold that is held out are not learnt from. Rows with a null id have no
    label and are scored like others; repeated rows go or stay together."""
    labels = table(spark, sf_dir, "labels").filter(fold("doc_id", 5) != 0)
    rows, names = apart(docs)
    return as_before(toxicity_scores(rows, fitted(rows, labels)).filter("predicted = 0"), names)


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the lines that others hold; n_chars follows a text that changes. A null text becomes an empty one;
    a document that loses all lines stays as an empty text; rows with a null id count as one document."""
    rows, names = apart(docs)
    out = line_dedup(rows)
    if "n_chars" in names:
        own = column(names["n_chars"])
        out = out.withColumn(names["n_chars"], F.when(F.col("n_dropped") > 0, F.length("text")).otherwise(own).cast(docs.schema["n_chars"].dataType))
    return as_before(out, names)


def keep_one_of_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each group of near duplicates (five words, 0.8). Of rows with one id the smallest
    stays, compared column by column; rows with a null id are in no group and stay."""
    rows, names = apart(docs)
    groups = staged(near_groups(rows, size=5, threshold=0.8), "groups")
    out = rows.join(sized(groups.filter("not kept").select("doc_id")), "doc_id", "left_anti").select(*map(column, rows.columns))
    again = staged(groups.filter(F.col("doc_id").isNotNull()).groupBy("doc_id").count().filter("count > 1").select("doc_id"), "repeated-ids")
    if not again.limit(1).count():
        return as_before(out, names)
    others = [c for c in rows.columns if c != "doc_id"]
    one = out.join(sized(again), "doc_id", "left_semi").groupBy("doc_id").agg(F.min(F.struct(*map(column, others))).alias("x")).select("doc_id", *[F.col("x").getField(c).alias(c) for c in others])
    return as_before(out.join(sized(again), "doc_id", "left_anti").unionByName(one), names)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item. Rows with a null id are not searched and stay; rows with one id go together."""
    rows, names = apart(docs)
    found = staged(contaminated(rows, table(spark, sf_dir, "benchmark")).select("doc_id").distinct(), "contaminated")
    return as_before(rows.join(sized(found), "doc_id", "left_anti"), names)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, lang, source, token ids (packed little-endian uint32) and the digest of the text that they decode to. A null or
    empty text has no ids; repeated rows are encoded each."""
    out = bpe_encode(docs.select("doc_id", "lang", "source", "text"), public_tokenizers.path(VOCABULARY), keep_text=False)
    return out.select("doc_id", "lang", "source", "n_tokens", "ids", F.sha2(F.encode("decoded", "utf-8"), 256).alias("decoded_sha256"))


STAGES = [
    ("toxicity", drop_toxic),
    ("line_dedup", drop_repeated_lines),
    ("near_dedup", keep_one_of_group),
    ("decontamination", drop_contaminated),
    ("bpe", encode),
]

#: SQL cannot express near duplicates and scores; the tests compare run() with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs, before = staged(stage(spark, docs, sf_dir), f"pipeline-{name}"), docs
        if name != STAGES[0][0]:
            unstaged(before)
    return STAGES[-1][1](spark, docs, sf_dir)
