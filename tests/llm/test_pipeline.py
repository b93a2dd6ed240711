"""The pipeline against plain versions of its stages."""

import hashlib

import public_tokenizers
from cases import documents, rows
from pyspark.sql import functions as F
from test_operators import SMALL, groups

import corpus_pipeline as pipeline
from tidemark.llm import decontaminate
from tidemark.llm.bpe import tokenizer
from tidemark.llm.common import fold, staged
from tidemark.llm.near_dedup import near_groups
from tidemark.llm.toxicity import fitted


def plain_lines(docs):
    keys = {}
    for i, t in docs.items():
        for line in t.split("\n"):
            k = line.strip(" \t\n\x0b\f\r").translate({c: c + 32 for c in range(65, 91)})
            if len(k) >= 20:
                keys.setdefault(k, set()).add(i)
    out = {}
    for i, t in docs.items():
        keep = []
        for line in t.split("\n"):
            own = keys.get(line.strip(" \t\n\x0b\f\r").translate({c: c + 32 for c in range(65, 91)}), ())
            if len(own) < 3 or i == max(own):
                keep.append(line)
        out[i] = "\n".join(keep)
    return out


def test_run(spark):
    out = {r.doc_id: r for r in pipeline.run(spark, SMALL).collect()}
    table = spark.read.parquet(f"{SMALL}/documents.parquet")
    index = fitted(table, spark.read.parquet(f"{SMALL}/labels.parquet").filter(fold("doc_id", 5) != 0))
    docs = {r.doc_id: r.text for r in table.collect() if index.score(r.text)[0] < 0.5}
    docs = plain_lines(docs)
    docs = {i: docs[i] for i, (_, c) in groups(docs.items(), 5).items() if i == c}
    items = spark.read.parquet(f"{SMALL}/benchmark.parquet")
    left = spark.createDataFrame(list(docs.items()), "doc_id long, text string")
    assert {r.doc_id for r in decontaminate.contaminated(left, items).collect()} == set(docs) - set(out)
    t = tokenizer(public_tokenizers.path(pipeline.VOCABULARY))
    for i, r in out.items():
        assert bytes(r.ids) == t.encode(docs[i]) and r.n_tokens == len(r.ids) // 4
        assert r.decoded_sha256 == hashlib.sha256(t.decode(bytes(r.ids)).encode()).hexdigest()


def test_odd_documents(spark):
    docs = documents(spark)
    for name, stage in pipeline.STAGES:
        n, columns = docs.count(), docs.columns
        docs = staged(stage(spark, docs, SMALL), name)
        assert docs.count() <= n and (name == "bpe" or docs.columns == columns), name
    ids = [r.doc_id for r in docs.collect()]
    assert len([i for i in ids if i is not None]) == len({i for i in ids if i is not None}) and ids.count(None) == sum(r[0] is None for r in rows())


def test_other_columns_and_string_ids(spark):
    """Columns that operators add, dots in names and ids that are strings: every stage returns what it was given."""
    docs = documents(spark).withColumn("doc_id", F.concat(F.lit("d"), F.lpad("doc_id", 4, "0")))
    docs = docs.select("*", *[F.concat(F.lit(f"{c} of "), F.coalesce("doc_id", F.lit("none"))).alias(c) for c in ("predicted", "n_lines", "n_dropped", "cosines", "a.b", "tag", "id", "component_id", "x")])
    docs = docs.withColumn("score", F.concat(F.lit("score of "), F.coalesce("doc_id", F.lit("none"))))
    for name, stage in pipeline.STAGES[:-1]:
        before = docs
        docs = staged(stage(spark, docs, SMALL), name)
        assert docs.columns == before.columns and docs.dtypes == before.dtypes, name
        rows_ = docs.collect()
        assert rows_
        for r in rows_:
            for c in ("predicted", "n_lines", "n_dropped", "cosines", "a.b", "tag", "id", "component_id", "x", "score"):
                assert r[c] == f"{c} of {r['doc_id'] or 'none'}", (name, c)
    assert pipeline.encode(spark, docs, SMALL).count() == docs.count()


def test_groups_of_string_ids(spark):
    text = " ".join(f"w{i}" for i in range(60))
    docs = [("b", text), ("a", text + " end"), ("c", text), (None, text), ("d", "another text of its own"), ("e", None), ("c", text)]
    out = near_groups(spark.createDataFrame(docs, "doc_id string, text string").repartition(3)).collect()
    assert {(r.doc_id, r.component_id, r.kept) for r in out if r.doc_id} == {("a", "a", True), ("b", "a", False), ("c", "a", False), ("d", "d", True), ("e", "e", True)}
    assert [r.kept for r in out if r.doc_id is None] == [True] and len(out) == len(docs)


def test_sample_of_repeated_labels(spark):
    """An id with many texts counts once among those that are learnt from."""
    texts = [(i % 7, f"text number {i} of these") for i in range(500)]
    labels = spark.createDataFrame([(i, i % 2) for i in range(7)], "doc_id long, toxic int")
    index = fitted(spark.createDataFrame(texts, "doc_id long, text string"), labels)
    assert len(index.ids) == 7
