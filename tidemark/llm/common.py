"""What the operators of this folder share: staging, checked joins, Arrow maps over texts and the training folds."""

from __future__ import annotations

import ctypes
import tempfile
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

#: A side of a join is broadcast up to so many rows, counted beforehand; beyond it the join is shuffled.
BROADCAST_ROWS = 200_000

#: The white space of the word and line contracts: \x20 and \x09-\x0D, nothing else.
SPACE_CLASS = r"[\x20\x09-\x0D]+"
SPACE_CHARS = " \t\n\x0b\f\r"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """The cluster's folder in spark.checkpoint.dir; a temporary one only where that is unset and the master is local."""
    sc = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if not folder:
        folder = getattr(sc, "_tidemark_folder", None)
        if folder is None:
            if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
                raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
            folder = sc._tidemark_folder = "file://" + tempfile.mkdtemp(prefix="tidemark-")
    return folder


def staged(df: DataFrame, name: str) -> DataFrame:
    """Write df as Parquet to the shared folder and read it again: cuts the lineage, survives lost executors."""
    path = f"{shared_folder(df.sparkSession)}/tidemark/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out._tidemark_path = path
    return out


def unstaged(*tables: DataFrame) -> None:
    """Delete tables that staged wrote, when nothing that is still to be computed reads them."""
    for df in tables:
        spark, path = df.sparkSession, df._tidemark_path
        at = spark._jvm.org.apache.hadoop.fs.Path(path)
        at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


def give_back() -> None:
    """Return what the allocators of a Python worker hold but do not use: workers live on between stages."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):  # another C library than glibc
        pass


def sized(df: DataFrame, limit: int = BROADCAST_ROWS, weight: Column | None = None) -> DataFrame:
    """df with a broadcast hint if it has at most limit rows (they are counted), else as it is, for a shuffled join.

    weight: number of elements of a row with arrays; their sum may then be ten times the limit at most.
    """
    if weight is None:
        fits = df.limit(limit + 1).count() <= limit
    else:
        rows, elements = df.agg(F.count("*"), F.coalesce(F.sum(weight), F.lit(0))).first()
        fits = rows <= limit and elements <= 10 * limit
    return F.broadcast(df) if fits else df


def free_name(df: DataFrame, stem: str) -> str:
    """A column name that df does not have."""
    taken = {c.lower() for c in df.columns}
    name = stem
    while name.lower() in taken:
        name += "_"
    return name


def without(df: DataFrame, names: list[str]) -> list[str]:
    """Columns of df but those that an operator is about to add; Spark's names ignore case."""
    gone = {n.lower() for n in names}
    return [c for c in df.columns if c.lower() not in gone]


def fold(column: Column | str, n: int) -> Column:
    """crc32 of the id as text, modulo n; the split between rows that are learnt from and rows held out."""
    column = F.col(column) if isinstance(column, str) else column
    return F.pmod(F.crc32(column.cast("string").cast("binary")), F.lit(n))


#: Texts handed to Python at once: rows, and characters from which a slice is closed.
SLICE_ROWS, SLICE_CHARS = 256, 1 << 21


def slices(batch: pa.RecordBatch, texts: int, rows: int = SLICE_ROWS) -> Iterator[pa.RecordBatch]:
    """Parts of a batch of at most so many rows and, but for a single text, about SLICE_CHARS bytes in the column numbered texts."""
    size = pc.fill_null(pc.binary_length(batch.column(texts)), 0).to_numpy(zero_copy_only=False)
    at = 0
    while at < batch.num_rows:
        fit = int(np.searchsorted(np.cumsum(size[at : at + rows]), SLICE_CHARS, "right"))
        n = min(max(1, fit), rows, batch.num_rows - at)
        yield batch.slice(at, n)
        at += n


def map_text(
    df: DataFrame,
    make: Callable[[], Callable[[list], dict]],
    added: str,
    text_col: str = "text",
    keep_text: bool = True,
) -> DataFrame:
    """Add columns that Python computes from one text column, slice by slice.

    make() runs once in each task and returns a function from a list of texts (None: null) to a dict of columns, named and
    typed by the DDL string added. Other columns pass through; one with the name of an added column is replaced. text_col
    itself may be among the added ones, and is then replaced. At the end of a task free memory goes back to the system.
    """
    new = T.StructType.fromDDL(added)
    rest = [c for c in without(df, new.names) if keep_text or c.lower() != text_col.lower()]
    arrow_new = to_arrow_schema(new)
    source = df.select(*[F.col(f"`{c}`") for c in rest], F.col(f"`{text_col}`").cast("string").alias("__text__"))
    schema = T.StructType([source.schema[c] for c in rest] + list(new.fields))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        func = make()
        for batch in batches:
            for part in slices(batch, len(rest)):
                out = func(part.column(len(rest)).to_pylist())
                made = [out[f.name] if isinstance(out[f.name], pa.Array) else pa.array(out[f.name], f.type) for f in arrow_new]
                yield pa.RecordBatch.from_arrays([part.column(i) for i in range(len(rest))] + made, names=rest + arrow_new.names)
        give_back()

    return source.mapInArrow(run, schema)
