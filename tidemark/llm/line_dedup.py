"""Operator 7: lines that many documents hold.

Method: lines are normalised (white space of [\\x20\\x09-\\x0D] stripped at both ends, A-Z lower-cased) and hashed (128 bits), the
distinct documents of each hash are counted, lines over the threshold go from all documents but the one with the largest id,
and what stays is put together again by position.

Plan: one scan yields (hash, document, positions); it is written once and read twice. The count is a partial aggregate, so a
line in a third of all documents is one row per task. The few hashes over the threshold meet the lines in a join that is
broadcast only up to a counted size and otherwise shuffled with skewed partitions split. Positions then meet the texts by id.

Defined results: a null or empty text is one empty line; lines under min_chars code points always stay; rows with one id and
one text count as one document and get the same result; rows with a null id count as one document, which keeps a line only if
all its holders are such; a document that loses all lines gets an empty text; an empty table gives an empty one. Added columns replace those of the same name.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import free_name, give_back, sized, slices, staged, table, without

MIN_CHARS, MIN_DOCS = 20, 3


def keyed_lines(text: str | None, min_chars: int) -> dict[bytes, list[int]]:
    """Digest of each long enough key: positions of its lines."""
    out: dict[bytes, list[int]] = {}
    for at, line in enumerate((text or "").encode("utf-8", "surrogatepass").split(b"\n")):
        key = line.strip()  # bytes: exactly the six white-space characters of the contract
        if len(key) < min_chars or len(key) < 4 * min_chars and len(key.decode("utf-8", "surrogatepass")) < min_chars:
            continue
        out.setdefault(xxhash.xxh3_128_digest(key.lower()), []).append(at)  # bytes: A-Z alone
    return out


def line_rows(df: DataFrame, id_col: str, text_col: str, min_chars: int) -> DataFrame:
    """One row for each document and key: h1, h2, id, tag (hash of the whole text), at (positions)."""

    def run(batches):
        for batch in batches:
            for part in slices(batch, 1, 512):
                owner, digests, places = [], [], []
                for n, text in enumerate(part.column(1).to_pylist()):
                    for digest, at in keyed_lines(text, min_chars).items():
                        owner.append(n)
                        digests.append(digest)
                        places.append(at)
                h = np.frombuffer(b"".join(digests), "<i8").reshape(-1, 2)
                owner = pa.array(owner, pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(h[:, 0]), pa.array(h[:, 1]), part.column(0).take(owner), part.column(2).take(owner), pa.array(places, pa.list_(pa.int32()))],
                    names=["h1", "h2", "id", "tag", "at"],
                )
        give_back()

    kind = df.schema[id_col].dataType.simpleString()
    return df.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), F.xxhash64(text_col).alias("tag")).mapInArrow(run, f"h1 long, h2 long, id {kind}, tag long, at array<int>")


def line_dedup(df: DataFrame, min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """df with text_col without the repeated lines, and n_lines (before) and n_dropped."""
    lines = staged(line_rows(df, id_col, text_col, min_chars), "lines")
    holders = F.count_distinct(F.coalesce(F.col("id").cast("string"), F.lit("")))
    common = lines.groupBy("h1", "h2").agg(holders.alias("n"), F.max("id").alias("keeper")).filter(F.col("n") >= min_docs)
    common = staged(common.select("h1", "h2", "keeper"), "common-lines")
    gone = lines.join(sized(common), ["h1", "h2"]).filter(~F.col("id").eqNullSafe(F.col("keeper")))
    gone = gone.groupBy("id", "tag").agg(F.flatten(F.collect_set("at")).alias("at"))  # a set: repeated rows have the same positions
    gone_col, tag_col, gone_id, gone_tag = (free_name(df, c) for c in ("gone_lines", "text_tag", "gone_id", "gone_tag"))
    rest = without(df, ["n_lines", "n_dropped"])
    docs = df.select(*[F.col(f"`{c}`") for c in rest], F.xxhash64(text_col).alias(tag_col))
    gone = gone.select(F.col("id").alias(gone_id), F.col("tag").alias(gone_tag), F.col("at").alias(gone_col))
    joined = docs.join(gone, F.col(id_col).eqNullSafe(F.col(gone_id)) & (F.col(tag_col) == F.col(gone_tag)), "left").drop(gone_id, gone_tag, tag_col)
    return rebuilt(joined, gone_col, text_col, rest)


def rebuilt(df: DataFrame, gone_col: str, text_col: str, order: list[str]) -> DataFrame:
    """Texts without the lines at the positions of gone_col."""
    others = [c for c in df.columns if c not in (gone_col, text_col)]
    source = df.select(text_col, gone_col, *others)

    def run(batches):
        for batch in batches:
            for part in slices(batch, 0, 512):
                texts, n_lines, n_gone = [], [], []
                for text, gone in zip(part.column(0).to_pylist(), part.column(1).to_pylist(), strict=True):
                    text = text or ""
                    n_lines.append(text.count("\n") + 1)
                    if gone:
                        out, kept = set(gone), text.split("\n")
                        text = "\n".join([x for i, x in enumerate(kept) if i not in out])
                        n_gone.append(len(out))
                    else:
                        n_gone.append(0)
                    texts.append(text)
                made = {text_col: pa.array(texts, pa.string())} | {c: part.column(2 + i) for i, c in enumerate(others)}
                yield pa.RecordBatch.from_arrays([*(made[c] for c in order), pa.array(n_lines, pa.int64()), pa.array(n_gone, pa.int64())], names=[*order, "n_lines", "n_dropped"])
        give_back()

    fields = [f"`{c}` {'string' if c == text_col else df.schema[c].dataType.simpleString()}" for c in order]
    return source.mapInArrow(run, ", ".join([*fields, "n_lines long", "n_dropped long"]))


def op7_line_dedup(spark, sf_dir: str) -> DataFrame:
    """Lines of at least 20 code points in at least 3 documents stay only in the largest id."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return line_dedup(docs).select("doc_id", "n_lines", "n_dropped", F.sha2(F.encode("text", "utf-8"), 256).alias("kept_sha256"))


OP7_SQL = r"""
WITH split AS (
  SELECT doc_id, generate_subscripts(l, 1) AS pos, unnest(l) AS line
  FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS l FROM documents)
), keyed AS (
  SELECT doc_id, pos, line, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS k FROM split
), common AS (
  SELECT k, max(doc_id) AS keeper FROM keyed WHERE length(k) >= 20 GROUP BY k HAVING count(DISTINCT doc_id) >= 3
), marked AS (
  SELECT s.doc_id, s.pos, s.line, c.k IS NOT NULL AND s.doc_id <> c.keeper AS gone FROM keyed s LEFT JOIN common c ON s.k = c.k
)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT gone), '')) AS kept_sha256
FROM marked GROUP BY doc_id
"""
