"""Durations and timestamps: parsing, coalescing, formatting.

Integers are what Spark's try_cast takes: surrounding spaces and signs, not underscores.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .texts import coerce_text, strip


def _int(c: Column) -> Column:
    """Whole numbers only: a text with a fraction is no integer."""
    text = strip(c)
    return F.when(F.regexp_like(text, F.lit(r"^[+-]?[0-9]+$")), text.try_cast("bigint"))


def iso_duration(c: Column) -> Column:
    """PT#H#M#S as HH:MM:SS; anything that doesn't begin with PT is 00:00:00. A fraction of any part is an error."""
    whole = F.when(c.startswith("PT") & F.regexp_like(c, F.lit(r"[0-9]*[.,][0-9]+[HMS]")), F.raise_error(F.concat(F.lit("not whole seconds: "), c)).cast("string"))
    part = lambda unit: F.coalesce(F.nullif(F.regexp_extract(c, rf"^PT.*?([0-9]+){unit}", 1), F.lit("")).cast("int"), F.lit(0))
    return F.when(c.isNotNull(), F.coalesce(whole, F.when(c.startswith("PT"), F.format_string("%02d:%02d:%02d", part("H"), part("M"), part("S"))).otherwise("00:00:00")))


def hms_or_null(c: Column) -> Column:
    """Seconds of H:M:S, M:S or a plain integer; null for all else."""
    p = F.split(c, ":")
    n = [_int(F.get(p, i)) for i in range(3)]
    return F.when(F.size(p) == 3, n[0] * 3600 + n[1] * 60 + n[2]).when(F.size(p) == 2, n[0] * 60 + n[1]).when(F.size(p) == 1, _int(c))


def hms_or_zero(c: Column) -> Column:
    """Seconds of H:M:S; 0 for all else."""
    return F.coalesce(F.when(F.size(F.split(c, ":")) == 3, hms_or_null(c)), F.lit(0).cast("bigint"))


def declared_seconds(duration_seconds: Column, duration: Column) -> Column:
    """The integer column if it has one, else the H:M:S text, else 0."""
    return F.coalesce(duration_seconds.try_cast("double").cast("bigint"), hms_or_zero(duration))


def coerce_duration(c: Column) -> Column:
    """A number truncated to whole seconds; null if it is none, negative, NaN or infinite."""
    x = c.try_cast("double")
    return F.when((x >= 0) & ~F.isnan(x) & (x < float("inf")), x.cast("bigint"))


def base60(c: Column) -> Column:
    """Any number of integer parts between colons, folded in base 60; null if one is no integer."""
    return F.aggregate(F.split(c, ":"), F.lit(0).cast("bigint"), lambda acc, x: acc * 60 + _int(x))


def entry_duration(duration: Column, duration_seconds: Column, duration_ms: Column, duration_string: Column) -> Column:
    """The first usable of seconds, seconds, milliseconds and text."""
    ms = duration_ms.try_cast("double")
    text = F.nullif(coerce_text(duration_string), F.lit(""))
    return F.coalesce(coerce_duration(duration), coerce_duration(duration_seconds), F.when((ms >= 0) & (ms < float("inf")), (ms / 1000).cast("bigint")), base60(text))


def cue_seconds(c: Column) -> Column:
    """Seconds of HH:MM:SS.mmm with a point or a comma; anything else is an error."""
    text = strip(F.replace(c, F.lit(","), F.lit(".")))
    p = F.split(text, ":")
    value = _int(F.get(p, 0)) * 3600 + _int(F.get(p, 1)) * 60 + F.get(p, 2).try_cast("double")
    return F.when(c.isNull(), F.lit(None).cast("double")).otherwise(F.coalesce(F.when(F.size(p) == 3, value), F.raise_error(F.concat(F.lit("not a cue time: "), c)).cast("double")))


def hms(seconds: Column) -> Column:
    """HH:MM:SS; hours may have more digits."""
    s = seconds.cast("bigint")
    return F.format_string("%02d:%02d:%02d", F.floor(s / 3600), F.floor(s % 3600 / 60), s % 60)


def human(seconds: Column) -> Column:
    """1h 2m 3s, 2m 3s or 3s, truncated."""
    s = F.floor(seconds).cast("bigint")
    h, m, r = F.floor(s / 3600), F.floor(s % 3600 / 60), s % 60
    return F.when(h > 0, F.format_string("%dh %dm %ds", h, m, r)).when(m > 0, F.format_string("%dm %ds", m, r)).otherwise(F.format_string("%ds", r))


def clock(seconds: Column) -> Column:
    """H:MM:SS or M:SS; ? for null, 0:00 below 0."""
    s = F.greatest(seconds.cast("bigint"), F.lit(0))
    h, m, r = F.floor(s / 3600), F.floor(s % 3600 / 60), s % 60
    return F.when(seconds.isNull(), "?").when(h > 0, F.format_string("%d:%02d:%02d", h, m, r)).otherwise(F.format_string("%d:%02d", m, r))


def cue_time(seconds: Column) -> Column:
    """HH:MM:SS.mmm, milliseconds rounded half to even and carried."""
    whole = F.floor(seconds).cast("bigint")
    ms = whole * 1000 + F.rint((seconds - whole) * 1000.0).cast("bigint")
    s = F.floor(ms / 1000)
    return F.format_string("%02d:%02d:%02d.%03d", F.floor(s / 3600), F.floor(s % 3600 / 60), s % 60, ms % 1000)


def published_on(timestamp: Column) -> Column:
    """The text before the T of a timestamp; empty for null."""
    return F.coalesce(F.substring_index(timestamp, "T", 1), F.lit(""))


def year_of(date: Column) -> Column:
    """The text before the first dash."""
    return F.substring_index(date, "-", 1)


def year_digits(date: Column) -> Column:
    """The first four characters if they are digits, else null."""
    y = F.substring(date, 1, 4)
    return F.when(F.regexp_like(y, F.lit("^[0-9]{4}$")), y)


def infer_year(date: Column, path: Column, strict: bool = True) -> Column:
    """The year of the date, else the first part of the path that is four digits; else an error, or null if not strict."""
    parts = F.filter(F.split(path, "/"), lambda p: F.regexp_like(p, F.lit("^[0-9]{4}$")))
    found = F.coalesce(year_digits(strip(date)), F.get(parts, 0))
    return F.coalesce(found, F.raise_error(F.concat(F.lit("no year in "), F.coalesce(path, F.lit("null")))).cast("string")) if strict else found
