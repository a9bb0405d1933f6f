"""Integrity of recordings: expected against actual durations."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.status import classify
from ..functions.texts import stem
from ..functions.values import absolute_difference, percent_off

#: Order in which lists of problems are put together.
PROBLEMS = ("corrupted", "truncated", "suspicious")


def check(probes: DataFrame, expected: DataFrame | None, key: str = "id") -> DataFrame:
    """probes (path, ok, duration, error) with id, expected, status, duration_diff and percent_off.

    The id is the file's stem; expected is (id, expected). A missing table means that nothing is expected.
    """
    rows = probes.withColumn(key, stem(F.col("path")))
    rows = rows.withColumn("expected", F.lit(None).cast("double")) if expected is None else rows.join(expected, key, "left")
    status = classify(F.col("ok"), F.col("duration"), F.col("expected"))
    out = rows.withColumn("status", status)
    off = F.col("status") == "truncated"
    return out.withColumn("duration_diff", F.when(off, absolute_difference(F.col("duration"), F.col("expected")))).withColumn("percent_off", F.when(off, percent_off(F.col("duration"), F.col("expected"))))


def summary(checked: DataFrame) -> DataFrame:
    """One row: files, count of each status, problems, sum and mean duration of the valid ones."""
    valid = F.when(F.col("status") == "valid", F.col("duration"))
    counts = [F.count_if(F.col("status") == s).alias(s) for s in ("valid", *PROBLEMS)]
    return checked.agg(F.count("*").alias("total"), *counts, F.count_if(F.col("status") != "valid").alias("problems"), F.sum(valid).alias("valid_seconds"), F.avg(valid).alias("mean_seconds"))


def problems(checked: DataFrame) -> DataFrame:
    """(rank, path, id, status) of the problem files; rank orders corrupted, truncated, suspicious."""
    rank = F.array_position(F.array(*map(F.lit, PROBLEMS)), F.col("status")).cast("int")
    return checked.filter(F.col("status").isin(*PROBLEMS)).select(rank.alias("rank"), "path", "id", "status")


def redownload_ids(checked: DataFrame, orphans: DataFrame | None = None) -> DataFrame:
    """Distinct ids of problem files and of orphaned conversions (path)."""
    ids = problems(checked).select("id")
    if orphans is not None:
        ids = ids.unionByName(orphans.select(stem(F.col("path")).alias("id")))
    return ids.distinct()


def delete_plan(checked: DataFrame, orphans: DataFrame | None = None) -> DataFrame:
    """(path, reason) of what a cleanup removes; nothing is removed here."""
    out = problems(checked).select("path", F.col("status").alias("reason"))
    return out if orphans is None else out.unionByName(orphans.select("path", F.lit("orphan").alias("reason")))


def flag_counts(before: DataFrame, after: DataFrame, flag: str = "downloaded") -> DataFrame:
    """(flags_before, flags_after): rows whose flag is true."""
    n = lambda df, name: df.agg(F.coalesce(F.sum(F.col(flag).cast("int")), F.lit(0)).alias(name))
    return n(before, "flags_before").crossJoin(n(after, "flags_after"))
