"""The catalog of recordings against the files on disk.

"Last wins" always names the column that orders the rows: source position is data, not an accident of partitioning.
Lookup sides that may be small are left to adaptive execution, which broadcasts what it has measured.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.durations import hms_or_null, year_digits
from ..functions.values import pending
from ..shared import written


def pending_rows(catalog: DataFrame, flag: str = "downloaded") -> DataFrame:
    """Rows whose flag is false; a blank flag counts as done."""
    return catalog.filter(pending(F.col(flag)))


def newest_first(catalog: DataFrame, date: str, tie: str) -> DataFrame:
    return catalog.orderBy(F.to_date(F.col(date)).desc_nulls_last(), F.col(tie))


def candidates(rows: DataFrame, order: str, limit: int = 0, reprocess: bool = False, completed: str = "completed") -> DataFrame:
    """Rows to process in source order: those not completed, or all; the first limit of them, or all if it is 0."""
    todo = rows if reprocess else rows.filter(~F.coalesce(F.col(completed) == "TRUE", F.lit(False)))
    return todo.orderBy(order).limit(limit) if limit > 0 else todo


def reconcile(catalog: DataFrame, disk: DataFrame, key: str, flag: str = "downloaded") -> DataFrame:
    """catalog with found, updated, missing and the new flag: set where the file is there, never unset."""
    there = disk.select(key).distinct().withColumn("_there", F.lit(True))
    was = F.coalesce(F.col(flag), F.lit(True))
    out = catalog.join(there, key, "left").withColumn("found", F.coalesce("_there", F.lit(False)))
    return out.withColumn("updated", F.col("found") & ~was).withColumn("missing", ~F.col("found") & was).withColumn(flag, F.when(F.col("found"), True).otherwise(F.col(flag))).drop("_there")


def last_by(df: DataFrame, key: str, value: Column, order: Column, name: str) -> DataFrame:
    """(key, name): the value of each key's last row; a plain hash aggregate, no window."""
    return df.groupBy(key).agg(F.max_by(value, order).alias(name))


def assign_years(files: DataFrame, catalog: DataFrame, key: str, date: str, order: str) -> DataFrame:
    """files with the year of their catalog row, the last one of repeated keys; null if unmapped."""
    return files.join(last_by(catalog, key, F.substring_index(F.col(date), "-", 1), F.col(order), "year"), key, "left")


def move_plan(files: DataFrame, root: str) -> DataFrame:
    """(path, target) of files that have a year and aren't in its folder."""
    target = F.concat_ws("/", F.lit(root), "year", F.substring_index("path", "/", -1))
    return files.filter("year IS NOT NULL").select("path", target.alias("target")).filter("path <> target")


def expected_seconds(catalog: DataFrame, key: str, duration: str, order: str) -> DataFrame:
    """(key, expected): seconds of each key's last row that has any; unparsable and 0 count as none."""
    known = catalog.withColumn("_s", hms_or_null(F.col(duration))).filter(F.col(key).isNotNull() & (F.col("_s") != 0))
    return last_by(known, key, F.col("_s"), F.col(order), "expected")


def resolve_paths(rows: DataFrame, files: DataFrame, row_key: str, choices: Column, name: str = "path") -> DataFrame:
    """rows with the first of their candidate paths that exists, null if none does.

    One row a candidate meets the files once; the least position wins. row_key must be unique.
    """
    each = rows.select(F.col(row_key).alias("_k"), F.posexplode(F.array_distinct(choices)).alias("_pos", "_path"))
    hit = each.join(files.select(F.col("path").alias("_path")).distinct(), "_path", "left_semi").groupBy("_k").agg(F.min_by("_path", "_pos").alias(name))
    return rows.join(hit, rows[row_key] == hit["_k"], "left").drop("_k")


def download_paths(root: str, video_id: Column, date: Column) -> Column:
    """root/<year>/<id>.opus if the date begins with four digits, root/<id>.opus, root/<id>/<id>.opus."""
    name = F.concat(video_id, F.lit(".opus"))
    year = year_digits(date)
    return F.filter(F.array(F.when(year.isNotNull(), F.concat_ws("/", F.lit(root), year, name)), F.concat_ws("/", F.lit(root), name), F.concat_ws("/", F.lit(root), video_id, name)), lambda p: p.isNotNull())


def upload_paths(cell: Column, metadata_dir: str, audio_root: str, config: str) -> Column:
    """An absolute path itself; else beside the metadata, in the audio folder, and there without the config's name."""
    p = F.trim(cell)
    rest = F.when(p.startswith(f"{config}/"), F.concat_ws("/", F.lit(audio_root), F.substring(p, len(config) + 2, 1 << 30)))
    relative = F.array(F.concat_ws("/", F.lit(metadata_dir), p), F.concat_ws("/", F.lit(audio_root), p), rest)
    return F.when(F.coalesce(p, F.lit("")) == "", F.array().cast("array<string>")).when(p.startswith("/"), F.array(p)).otherwise(F.filter(relative, lambda x: x.isNotNull()))


def apply_results(catalog: DataFrame, results: DataFrame, key: str, flag: str = "downloaded") -> DataFrame:
    """catalog with the flag set where results (key, ok) succeeded."""
    done = results.groupBy(key).agg(F.bool_or("ok").alias("_ok"))
    return catalog.join(done, key, "left").withColumn(flag, F.when(F.col("_ok"), True).otherwise(F.col(flag))).drop("_ok")


def clear_flags(catalog: DataFrame, problems: DataFrame, id_col: str, url_col: str, flag: str = "downloaded") -> DataFrame:
    """catalog with the flag false on every row that shares the address of a row with a problem id."""
    urls = catalog.join(problems.select(id_col).distinct(), id_col, "left_semi").select(url_col).distinct().withColumn("_bad", F.lit(True))
    return catalog.join(urls, url_col, "left").withColumn(flag, F.when(F.col("_bad"), False).otherwise(F.col(flag))).drop("_bad")


def progress_counts(reconciled: DataFrame) -> DataFrame:
    return reconciled.agg(F.count_if("updated").alias("updated"), F.count_if("missing").alias("missing"), F.count_if(F.col("found")).alias("found"))


def skip_blank_urls(rows: DataFrame, url: str = "url", completed: str = "completed") -> tuple[DataFrame, DataFrame]:
    """(rows with completed FALSE where the url is null or blank, one row with the number of these failures)."""
    blank = F.coalesce(F.trim(F.col(url)), F.lit("")) == ""
    return rows.withColumn(completed, F.when(blank, "FALSE").otherwise(F.col(completed))), rows.agg(F.count_if(blank).alias("failures"))


def row_number_by(df: DataFrame, order: str, name: str) -> DataFrame:
    """A global number from 1 in order, without a single-partition window.

    Rows are range-partitioned, sorted, numbered inside their partition and written once: a second planning of the
    same exchange could draw other boundaries. Each partition's offset is the count of those before it, a
    table of one row a partition.
    """
    inside = F.shiftrightunsigned("_at", 33), F.col("_at").bitwiseAND(F.lit((1 << 33) - 1))
    ranged = df.repartitionByRange(F.col(order)).sortWithinPartitions(order).withColumn("_at", F.monotonically_increasing_id())
    ranged = written(ranged, "numbered").withColumn("_part", inside[0]).withColumn("_in", inside[1] + 1).drop("_at")
    sizes = ranged.groupBy("_part").agg(F.max("_in").alias("_n"))
    before = sizes.withColumn("_before", F.coalesce(F.sum("_n").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).drop("_n")
    return ranged.join(F.broadcast(before), "_part").withColumn(name, F.col("_in") + F.col("_before")).drop("_part", "_in", "_before")
