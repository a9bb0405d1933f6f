"""Time intervals: gap merge, bounded split, fixed windows, statistics, rolling counts."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def gap_merge(df: DataFrame, keys: list[str], gap: float, start: str = "start", end: str = "end") -> DataFrame:
    """Intervals of each key joined where the next begins no more than gap behind the furthest end so far.

    (keys, start, end, n): one shuffle on the keys, then two window passes over the same sort.
    """
    order = Window.partitionBy(*keys).orderBy(start, end)
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    reach = F.max(end).over(before)
    opens = F.when(reach.isNull() | (F.col(start) - reach > F.lit(float(gap))), 1).otherwise(0)
    island = df.withColumn("_opens", opens).withColumn("_island", F.sum("_opens").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    return island.groupBy(*keys, "_island").agg(F.min(start).alias(start), F.max(end).alias(end), F.count("*").alias("n")).drop("_island")


def pieces(start: Column, end: Column, size: float | None) -> Column:
    """Array of structs (start, end) that tile [start, end) in steps of size; empty if it is empty, whole if size isn't positive.

    Bounds are start + i * size; for sizes that binary fractions can't hold, the last bits differ from repeated addition.
    """
    if size is None or size <= 0:
        return F.when(end > start, F.array(F.struct(start.alias("start"), end.alias("end")))).otherwise(F.array().cast("array<struct<start:double,end:double>>"))
    n = F.ceil((end - start) / F.lit(float(size))).cast("int")
    made = F.transform(F.sequence(F.lit(0), F.greatest(n, F.lit(1)) - 1), lambda i: F.struct((start + i * F.lit(float(size))).alias("start"), F.least(start + (i + 1) * F.lit(float(size)), end).alias("end")))
    return F.when(end > start, made).otherwise(F.array().cast("array<struct<start:double,end:double>>"))


def bounded_split(df: DataFrame, size: float | None, start: str = "start", end: str = "end") -> DataFrame:
    """df with every interval cut to pieces of at most size; empty intervals vanish."""
    rest = [c for c in df.columns if c not in (start, end)]
    cut = df.select(*rest, F.explode(pieces(F.col(start).cast("double"), F.col(end).cast("double"), size)).alias("_p"))
    return cut.select(*rest, F.col("_p.start").alias(start), F.col("_p.end").alias(end))


def exact_split(df: DataFrame, size: float, start: str = "start", end: str = "end") -> DataFrame:
    """bounded_split by repeated addition, bit for bit as a loop does it."""
    if size <= 0:
        raise ValueError("size must be positive")
    rest = [c for c in df.columns if c not in (start, end)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            who, lo, hi = [], [], []
            for i, (x, to) in enumerate(zip(b.column(start).to_pylist(), b.column(end).to_pylist())):
                while x is not None and to is not None and x < to:
                    upto = min(x + size, to)
                    who.append(i)
                    lo.append(x)
                    hi.append(upto)
                    x = upto
            taken = b.select(rest).take(pa.array(who, pa.int64())) if rest else None
            yield pa.RecordBatch.from_arrays([*(taken.columns if rest else []), pa.array(lo, pa.float64()), pa.array(hi, pa.float64())], [*rest, start, end])

    schema = df.select(*rest, F.col(start).cast("double"), F.col(end).cast("double"))
    return schema.mapInArrow(run, schema.schema)


def fixed_windows(total: Column, size: float) -> Column:
    """Array of windows (start, end) that tile [0, total)."""
    if not size > 0:
        raise ValueError("size must be positive")
    return pieces(F.lit(0.0), total.cast("double"), size)


def fallback_windows(segments: Column, total: Column, max_seg: float, batch: bool = True) -> Column:
    """The segments if there are any, else fixed windows of max(max_seg, 30) in batch, or of max_seg, 30 if not positive."""
    size = max(max_seg, 30.0) if batch else (max_seg if max_seg > 0 else 30.0)
    return F.when(F.coalesce(F.size(segments), F.lit(0)) > 0, segments).otherwise(fixed_windows(total, size))


def numbered(df: DataFrame, keys: list[str], order: list[str], name: str = "idx") -> DataFrame:
    """df with a number from 1 within each key."""
    return df.withColumn(name, F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))


def length_stats(df: DataFrame, keys: list[str], length: Column) -> DataFrame:
    """(keys, n, mean, median): exact; no row for a key without rows."""
    return df.groupBy(*keys).agg(F.count(length).alias("n"), F.avg(length).alias("mean"), F.median(length).alias("median"))


def length_series(df: DataFrame, keys: list[str], order: list[str], length: Column) -> DataFrame:
    """Rows to plot: (keys, idx, length, mean, median) of each key's intervals in order."""
    whole = Window.partitionBy(*keys)
    return df.select(*keys, F.row_number().over(whole.orderBy(*order)).alias("idx"), length.alias("length"), F.avg(length).over(whole).alias("mean"), F.median(length).over(whole).alias("median"))


def rolling_starts(df: DataFrame, keys: list[str], ts: str, seconds: int = 60, name: str = "in_window") -> DataFrame:
    """df with the number of starts of its key in the half-open window of that many seconds that ends with each row."""
    micros = F.unix_micros(F.col(ts).cast("timestamp"))
    return df.withColumn(name, F.count("*").over(Window.partitionBy(*keys).orderBy(micros).rangeBetween(-(seconds * 1_000_000 - 1), 0)))


def speech_segments(intervals: DataFrame, keys: list[str], merge_gap_ms: int, max_seg: float | None) -> DataFrame:
    """What becomes of voice activity: gaps merged, long segments cut, numbered from 1."""
    merged = gap_merge(intervals, keys, max(0, int(merge_gap_ms)) / 1000.0).drop("n")
    return numbered(bounded_split(merged, max_seg), keys, ["start"])


