"""Rules that classify probed files."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

TOLERANCE, SHORT, LEAST = 1.0, 60.0, 1.0


def probe_error(probe_ok: Column, duration: Column, format_ok: Column, message: Column) -> Column:
    """Why a probe isn't valid, null if it is: tool failure, unreadable duration, too short, unreadable format."""
    return (
        F.when(~F.coalesce(probe_ok, F.lit(False)), F.concat(F.lit("probe error: "), F.coalesce(message, F.lit(""))))
        .when(duration.isNull() | F.isnan(duration), "Cannot parse duration")
        .when(duration < LEAST, "Duration too short (< 1 second)")
        .when(~F.coalesce(format_ok, F.lit(False)), "Cannot read format information")
    )


def classify(ok: Column, actual: Column, expected: Column) -> Column:
    """corrupted, truncated (off by more than a second either way), suspicious (short, nothing expected) or valid.

    An expectation of 0 counts as none.
    """
    known = F.coalesce(expected != 0, F.lit(False))
    return (
        F.when(~F.coalesce(ok, F.lit(False)), "corrupted")
        .when(known, F.when(F.abs(actual - expected) > TOLERANCE, "truncated").otherwise("valid"))
        .when(actual < SHORT, "suspicious")
        .otherwise("valid")
    )
