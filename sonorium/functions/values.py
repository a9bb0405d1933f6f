"""Sizes, rates, differences, flags and audio samples."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .texts import strip


def size_text(n: Column) -> Column:
    """512 B, 1.50 KB ... up to TB."""
    x = n.cast("double")
    out = F.when(x < 1024, F.format_string("%d B", x.cast("bigint")))
    for k, unit in enumerate(("KB", "MB", "GB"), 1):
        out = out.when(x < 1024.0 ** (k + 1), F.format_string(f"%.2f {unit}", x / 1024.0**k))
    return F.when(n.isNotNull(), out.otherwise(F.format_string("%.2f TB", x / 1024.0**4)))


def rate_text(speed: Column) -> Column:
    """1.5KB/s ... up to GB/s; ? for null and 0."""
    x = speed.cast("double")
    out = F.when(speed.isNull() | (x == 0), "?").when(x < 1024, F.format_string("%.1fB/s", x))
    for k, unit in enumerate(("KB", "MB"), 1):
        out = out.when(x < 1024.0 ** (k + 1), F.format_string(f"%.1f{unit}/s", x / 1024.0**k))
    return out.otherwise(F.format_string("%.1fGB/s", x / 1024.0**3))


def rounded(x: Column, places: int) -> Column:
    """x to so many decimals, as databases round doubles: x * 10^places to whole numbers, halves away from zero.

    What rounds to nothing keeps its sign (-0.0); what can't be scaled stays as it is.
    """
    x, unit = x.cast("double"), 10.0**places
    scaled = F.abs(x) * unit
    near = F.rint(scaled)  # halves to even here; those that went down go up again
    found = F.signum(x) * (near + F.when(scaled - near == 0.5, 1.0).otherwise(0.0)) / unit
    return F.when(F.isnan(found) | (F.abs(found) == float("inf")), x).otherwise(found)


def gigabytes(n: Column) -> Column:
    return rounded(n.cast("double") / 1024.0**3, 2)


def half_even(x: Column) -> Column:
    return F.rint(x).cast("bigint")


def absolute_difference(actual: Column, expected: Column) -> Column:
    return F.abs(actual - expected)


def percent_off(actual: Column, expected: Column) -> Column:
    return F.when(expected != 0, F.abs(actual - expected) / expected * 100.0)


def segment_length(start: Column, end: Column) -> Column:
    return F.greatest(end - start, F.lit(0.0))


def segment_length_text(start: Column, end: Column) -> Column:
    """The length with three decimals, as command lines take it."""
    return F.format_string("%.3f", segment_length(start, end))


def worker_count(jobs: Column, cores: int) -> Column:
    """Workers for a wish: null and 0 mean all cores; a negative wish is an error."""
    return F.when(jobs < 0, F.raise_error(F.lit("jobs must not be negative")).cast("int")).when(F.coalesce(jobs, F.lit(0)) == 0, F.lit(cores)).otherwise(jobs.cast("int"))


def pending(flag: Column) -> Column:
    """Rows still to download; a blank flag counts as done."""
    return ~F.coalesce(flag, F.lit(True))


def is_downloaded(value: Column) -> Column:
    """The canonical flag: numbers other than 0, and 1, true, yes, y; null is false."""
    text = F.lower(strip(value.cast("string")))
    return F.coalesce(text.isin("1", "true", "yes", "y"), F.lit(False))


def number_flag(value: Column) -> Column:
    """A numeric flag: its whole part is not 0; null is false."""
    return F.coalesce(value.cast("bigint") != 0, F.lit(False))


def is_completed(value: Column) -> Column:
    """The progress flag: TRUE, 1 or YES, and not Y."""
    return F.coalesce(F.upper(strip(value.cast("string"))).isin("TRUE", "1", "YES"), F.lit(False))


def is_confirmed(value: Column) -> Column:
    return F.coalesce(F.lower(strip(value)).isin("yes", "y"), F.lit(False))


def mono(left: Column, right: Column) -> Column:
    """The mean of two channels, sample by sample."""
    return F.zip_with(left, right, lambda a, b: (a.cast("double") + b.cast("double")) / 2)


def downmix(channels: Column) -> Column:
    """The mean over an array of channels, sample by sample."""
    n = F.size(channels)
    zero = F.transform(F.get(channels, 0), lambda _: F.lit(0.0))
    total = F.aggregate(channels, zero, lambda acc, ch: F.zip_with(acc, ch, lambda a, b: a + b.cast("double")))
    return F.transform(total, lambda x: x / n)


def head_seconds(samples: Column, rate: int, seconds: float = 30.0) -> Column:
    return F.slice(samples, 1, int(rate * seconds))
