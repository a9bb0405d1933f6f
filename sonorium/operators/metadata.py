"""Dataset metadata: which catalog rows become samples, and why the others don't."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.durations import hms, infer_year
from ..functions.texts import strip
from ..functions.values import half_even

#: Reasons in the order in which they are tested; the first that holds is the row's.
REASONS = ("missing_id", "not_downloaded", "missing_file", "probe_failed")


def with_reason(rows: DataFrame, video_id: Column, downloaded: Column, path: Column, seconds: Column) -> DataFrame:
    """rows with the reason why each is skipped, null for those that are kept."""
    reason = F.when(F.coalesce(video_id, F.lit("")) == "", REASONS[0]).when(~downloaded, REASONS[1]).when(path.isNull(), REASONS[2]).when(seconds.isNull(), REASONS[3])
    return rows.withColumn("reason", reason)


def paths_to_probe(rows: DataFrame) -> DataFrame:
    """Each path once, however many rows share it; guards come first, so that nothing is probed in vain."""
    return rows.filter("path IS NOT NULL").select("path").distinct()


def build(rows: DataFrame, probed: DataFrame) -> DataFrame:
    """rows (id, downloaded, path, title, description, publish_date) with duration, duration_seconds and reason.

    probed is (path, duration): null where the probe failed. Seconds are rounded half to even.
    """
    seconds = probed.groupBy("path").agg(F.max("duration").alias("_d"))
    met = rows.join(seconds, "path", "left").withColumn("duration_seconds", half_even(F.col("_d"))).withColumn("duration", F.when(F.col("_d").isNotNull(), hms(half_even(F.col("_d")))))
    return with_reason(met, F.col("id"), F.col("downloaded"), F.col("path"), F.col("duration_seconds")).drop("_d")


def kept(built: DataFrame) -> DataFrame:
    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c)
    return built.filter("reason IS NULL").select("id", F.col("path").alias("audio"), text("title"), text("description"), text("publish_date"), "duration", "duration_seconds")


def diagnostics(built: DataFrame) -> DataFrame:
    """(reason, n) of the reasons that occur."""
    return built.filter("reason IS NOT NULL").groupBy("reason").agg(F.count("*").alias("n"))


def failed_ids(built: DataFrame) -> DataFrame:
    """(path, id) of rows whose probe failed."""
    return built.filter(F.col("reason") == "probe_failed").select("path", "id")


def samples(metadata: DataFrame, files: DataFrame, years: list[str] | None = None, strict: bool = True) -> DataFrame:
    """Metadata rows with an audio path whose file exists, with size_bytes, mtime and year; those of the years, or all."""
    audio = strip(F.coalesce(F.col("audio"), F.lit("")))
    there = files.select(F.col("path").alias("_path"), F.col("length").alias("size_bytes"), F.floor(F.unix_micros("modificationTime") / 1_000_000).alias("mtime"))
    rows = metadata.withColumn("audio", audio).filter("audio <> ''").join(there, F.col("audio") == F.col("_path")).drop("_path")
    out = rows.withColumn("year", infer_year(F.col("publish_date"), F.col("audio"), strict))
    return out.filter(F.col("year").isin(*years)) if years else out
