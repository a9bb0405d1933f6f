"""Merging a year's new rows into a published manifest."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.durations import declared_seconds
from ..functions.texts import basename, parent, sanitize_text

COLUMNS = ("id", "file_path", "title", "description", "publish_date", "duration", "duration_seconds", "url")


def validate(metadata: DataFrame) -> str:
    """The path column's name; an error without publish_date or any path column."""
    if "publish_date" not in metadata.columns:
        raise ValueError("metadata needs publish_date")
    found = next((c for c in ("audio", "file_path") if c in metadata.columns), None)
    if found is None:
        raise ValueError("metadata needs audio or file_path")
    return found


def of_year(metadata: DataFrame, year: int | str) -> DataFrame:
    """Rows whose date text begins with the year; 20 matches 2024."""
    return metadata.filter(F.col("publish_date").cast("string").startswith(str(year)))


def drop_unresolved(rows: DataFrame, path: str = "path") -> tuple[DataFrame, DataFrame]:
    """(rows with a path, their count and that of the others)."""
    return rows.filter(F.col(path).isNotNull()), rows.agg(F.count_if(F.col(path).isNotNull()).alias("resolved"), F.count_if(F.col(path).isNull()).alias("unresolved"))


def parents(files: DataFrame) -> DataFrame:
    """One row with the number of distinct parent folders; an upload needs exactly 1."""
    return files.agg(F.countDistinct(parent(F.col("path"))).alias("parents"))


def minus(a: DataFrame, b: DataFrame, key: str) -> DataFrame:
    """Keys of a that b doesn't have, each once."""
    return a.select(key).distinct().join(b.select(key).distinct(), key, "left_anti")


def present(rows: DataFrame, files: DataFrame, key: str) -> DataFrame:
    return rows.join(files.select(key).distinct(), key, "left_semi")


def manifest_rows(rows: DataFrame, config: str, year: int | str) -> DataFrame:
    """Manifest columns of rows that have path; file_path is config/year/name, nulls are empty or 0."""
    name = basename(F.col("path"))
    has = lambda c: F.col(c) if c in rows.columns else F.lit(None)
    out = {
        "id": sanitize_text(has("id") if "id" in rows.columns else name),
        "file_path": F.concat_ws("/", F.lit(config), F.lit(str(year)), name),
        **{c: sanitize_text(has(c)) for c in ("title", "description", "publish_date", "duration")},
        "duration_seconds": declared_seconds(has("duration_seconds").cast("string"), has("duration").cast("string")),
    }
    if "url" in rows.columns:
        out["url"] = sanitize_text(F.col("url"))
    return rows.select(*[v.alias(k) for k, v in out.items()])


def normalise(manifest: DataFrame) -> DataFrame:
    """An old manifest in today's shape: audio becomes file_path, missing seconds 0, nulls empty, columns in order."""
    m = manifest
    if "audio" in m.columns:
        m = m.drop("audio") if "file_path" in m.columns else m.withColumnRenamed("audio", "file_path")
    if "duration_seconds" not in m.columns:
        m = m.withColumn("duration_seconds", F.lit(0))
    m = m.withColumn("duration_seconds", F.coalesce(F.col("duration_seconds").cast("bigint"), F.lit(0)))
    return m.select(*[F.col(c) if c in ("id", "duration_seconds") else sanitize_text(F.col(c)).alias(c) for c in COLUMNS if c in m.columns], *[c for c in m.columns if c not in COLUMNS])


def upsert(old: DataFrame, new: DataFrame, key: str = "id", order: str | None = None) -> DataFrame:
    """old and new rows with the last of each key: new before old, then the highest order. Null keys are one key.

    A hash aggregate (max_by over a struct) on the key; no sort and no window.
    """
    both = old.withColumn("_src", F.lit(0)).unionByName(new.withColumn("_src", F.lit(1)), allowMissingColumns=True)
    cols = [c for c in both.columns if c not in (key, "_src")]
    rank = F.struct("_src", order) if order else F.col("_src")
    last = both.groupBy(key).agg(F.max_by(F.struct(*cols), rank).alias("_r"))
    return last.select(*[key if c == key else F.col(f"_r.{c}").alias(c) for c in both.columns if c != "_src"])


def newest(manifest: DataFrame, tie: str = "id") -> DataFrame:
    return manifest.orderBy(F.col("publish_date").desc_nulls_last(), F.col("duration_seconds").desc_nulls_last(), F.col(tie))


def staging_plan(rows: DataFrame, config: str, year: int | str) -> DataFrame:
    """(path, target) of the files to stage; total size is the sum of length."""
    return rows.select("path", F.concat_ws("/", F.lit(config), F.lit(str(year)), basename(F.col("path"))).alias("target"))
