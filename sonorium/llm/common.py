"""Session plumbing shared by the corpus operators: shared-folder tables, names, ids."""

from __future__ import annotations

import ctypes
import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .textops import forget_powers

#: Most bytes of a key table that may be broadcast, reckoned from its row count and width; a larger one is shuffle-joined.
BROADCAST_BYTES = 32 << 20
#: Bytes that a broadcast row takes beside its values, and what a text or a list in it is taken for.
_ROW_BYTES, _WIDE_BYTES = 24, 64


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that all executors share, from ``spark.checkpoint.dir``.

    A temporary folder stands in only on a local master, where there are no other machines.
    """
    found = spark.conf.get("spark.checkpoint.dir", None)
    if found:
        return found
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    found = getattr(shared_dir, "local", None)
    if found is None:
        found = shared_dir.local = tempfile.mkdtemp(prefix="sonorium-")
    return found


@contextmanager
def tidy(spark: SparkSession) -> Iterator[None]:
    """While it holds, shuffle files go as soon as the query that made them has ended."""
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key, "false")
    spark.conf.set(key, "true")
    try:
        yield
    finally:
        spark.conf.set(key, before)


def cut(df: DataFrame, name: str) -> DataFrame:
    """Write df once to the shared folder and read it back: short lineage that outlives executors."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    with tidy(spark):
        df.write.parquet(path)
    found = spark.read.schema(df.schema).parquet(path)
    found._cut_path = path
    return found


def discard(*tables: DataFrame) -> None:
    """Delete tables that cut() wrote, once all that is made from them is written itself."""
    for df in tables:
        jvm = df.sparkSession._jvm
        path = jvm.org.apache.hadoop.fs.Path(df._cut_path)
        path.getFileSystem(df.sparkSession._jsparkSession.sessionState().newHadoopConf()).delete(path, True)


def _give_back() -> None:
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc has it
    if trim is not None:
        trim(0)


def released(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """run for mapInArrow, giving freed memory back to the system between batches and when its task ends: workers outlive tasks, and an executor's add up."""

    def trimmed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        size = 0
        for b in batches:
            size += b.nbytes
            yield b
            del b
            if size > 32 << 20:
                size = 0
                _give_back()

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from run(trimmed(batches))
        forget_powers()
        _give_back()

    return task


def fresh(df: DataFrame, name: str) -> str:
    """A column name that df doesn't have in any case: name, or name with underscores."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def small(df: DataFrame, most: int) -> bool:
    """Whether df has at most that many rows; stops counting beyond."""
    return df.limit(most + 1).count() <= most


def maybe_broadcast(df: DataFrame, most: int | None = None, row_bytes: int | None = None) -> DataFrame:
    """df with a broadcast hint if its counted rows, of about row_bytes each, keep to BROADCAST_BYTES (and to most rows)."""
    width = row_bytes or _ROW_BYTES + sum(8 if t in ("bigint", "int", "double", "boolean", "float", "smallint", "tinyint") else _WIDE_BYTES for _, t in df.dtypes)
    fits = BROADCAST_BYTES // width
    return F.broadcast(df) if small(df, fits if most is None else min(most, fits)) else df


def key_text(doc_id: Column, text: Column) -> Column:
    """What identifies a document in a hash: its id, or its text's digest where the id is null."""
    return F.coalesce(doc_id.cast("string"), F.md5(F.coalesce(text, F.lit(""))))


def remove_rows(docs: DataFrame, rows: DataFrame, losing: str) -> DataFrame:
    """docs without the rows of the given (id, mark) that fulfil ``losing``, and with the others once.

    mark is xxhash64 of the text; ``copies`` of rows counts how often docs has the id and text. Where none is
    repeated this is a single anti join, which only sends keys and what has to move.
    """
    mark, act = fresh(docs, "mark"), fresh(docs, "action")
    keyed = docs.withColumn(mark, F.xxhash64(F.col("text").cast("string")))
    named = lambda t, what: t.select(F.col("id").alias(act + "_id"), F.col("mark").alias(act + "_mark"), F.lit(what).alias(act))
    losers = named(rows.filter(losing), "drop")
    repeated = named(rows.filter(f"NOT ({losing}) AND copies > 1"), "once")
    on = (keyed["doc_id"].cast("long") == F.col(act + "_id")) & (keyed[mark] == F.col(act + "_mark")) & keyed["text"].isNotNull()
    if repeated.isEmpty():
        return keyed.join(losers, on, "left_anti").drop(mark)
    marked = keyed.join(losers.unionByName(repeated), on, "left")
    once = marked.filter(F.col(act) == "once").dropDuplicates(["doc_id", "text"])
    return marked.filter(F.col(act).isNull()).unionByName(once).drop(mark, act, act + "_id", act + "_mark")
