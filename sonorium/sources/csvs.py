"""CSV as text at the edge: quotes doubled, cells over several lines, no inference."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructType

from ..functions.values import is_completed

OPTIONS = {"header": True, "escape": '"', "quote": '"', "multiLine": True, "encoding": "UTF-8"}


def read(spark: SparkSession, path: str, schema: StructType | None = None) -> DataFrame:
    """All columns as text in the file's order (a BOM is skipped); blank cells are null."""
    if schema is not None:
        return spark.read.options(**OPTIONS, enforceSchema=False).schema(StructType([f.__class__(f.name, StringType()) for f in schema.fields])).csv(path)
    return spark.read.options(**OPTIONS, inferSchema=False).csv(path)


def read_typed(spark: SparkSession, path: str, schema: StructType | None = None, nulls: tuple[str, ...] = ("", "NA", "N/A", "NaN", "nan", "NULL", "null", "None", "n/a", "<NA>", "#N/A")) -> DataFrame:
    """A catalog with typed columns: those of the schema, or inferred from all rows; the null words are null in any column."""
    text = read(spark, path, schema)
    text = text.select(*[F.when(~F.col(f"`{c}`").isin(*nulls), F.col(f"`{c}`")).alias(c) for c in text.columns])
    if schema is None:
        known = text.agg(*[F.struct(F.coalesce(F.bool_and(F.col(f"`{c}`").try_cast(t).isNotNull() | F.col(f"`{c}`").isNull()), F.lit(False)).alias("ok"), F.count(f"`{c}`").alias("n")).alias(f"{i}_{t}") for i, c in enumerate(text.columns) for t in ("bigint", "double", "boolean")]).first()
        kinds = [next((t for t in ("bigint", "double", "boolean") if known[f"{i}_{t}"]["ok"] and known[f"{i}_{t}"]["n"]), "string") for i in range(len(text.columns))]
    else:
        kinds = [f.dataType for f in schema.fields]
    return text.select(*[F.col(f"`{c}`").try_cast(t).alias(c) for c, t in zip(text.columns, kinds)])


def with_position(df: DataFrame, name: str = "row_index") -> DataFrame:
    """df as read, with the position of its rows from 0. Only right behind a read, ahead of any shuffle.

    A multi-line CSV file is one partition, so numbers are consecutive within a file.
    """
    return df.withColumn(name, F.monotonically_increasing_id())


def progress(df: DataFrame) -> DataFrame:
    """A catalog with completed as TRUE or FALSE, the column added if it is missing."""
    flag = is_completed(F.col("completed")) if "completed" in df.columns else F.lit(False)
    return df.withColumn("completed", F.when(flag, "TRUE").otherwise("FALSE"))


def write(df: DataFrame, path: str, single: bool = False, mode: str = "errorifexists") -> None:
    """A folder of CSV files; nulls are blank cells. single makes one file of it, for export only."""
    (df.coalesce(1) if single else df).write.mode(mode).options(header=True, escape='"', nullValue="", emptyValue="").csv(path)


def write_unless_empty(df: DataFrame, path: str, single: bool = False, required: bool = False) -> int:
    """Rows written; nothing is written for none, which is an error if rows are required."""
    n = df.count()
    if not n:
        if required:
            raise ValueError("no rows to write")
        return 0
    write(df, path, single)
    return n


def backup(df: DataFrame, path: str) -> None:
    """A snapshot beside the table, before it is written anew."""
    write(df, path.rstrip("/") + ".bak", mode="overwrite")


def replace_if_changed(df: DataFrame, changed: str, path: str) -> int:
    """Rows that a column of flags says have changed; the table at path is written anew, without that column, if there are any."""
    n = df.filter(changed).count()
    if n:
        replace(df.drop(changed), path)
    return n


def replace(df: DataFrame, path: str) -> None:
    """Writes next to path and renames: the table being read is never written over."""
    fs_path = df.sparkSession._jvm.org.apache.hadoop.fs.Path
    new, old = path.rstrip("/") + ".new", path.rstrip("/") + ".old"
    write(df, new, mode="overwrite")
    fs = fs_path(path).getFileSystem(df.sparkSession._jsc.hadoopConfiguration())
    fs.delete(fs_path(old), True)
    if fs.exists(fs_path(path)):
        fs.rename(fs_path(path), fs_path(old))
    fs.rename(fs_path(new), fs_path(path))
