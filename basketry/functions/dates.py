"""Date and time columns."""

from __future__ import annotations

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

SECONDS = {"second": 1, "minute": 60, "hour": 3600, "day": 86400, "week": 604800}


def duration_seconds(text: str) -> int:
    """Seconds in a duration such as ``"2 minutes"``."""
    total = 0
    words = text.split()
    for amount, unit in zip(words[::2], words[1::2], strict=True):
        total += int(amount) * SECONDS[unit.rstrip("s")]
    return total


def epoch_to_timestamp(value: Column, unit: str) -> Column:
    """Epoch number in ``unit`` ("s" or "ms") to a timestamp."""
    if unit == "s":
        return F.timestamp_seconds(value)
    if unit == "ms":
        return F.timestamp_millis(value)
    raise ValueError(f"unit must be 's' or 'ms', not {unit!r}")


def year_month(ts: Column) -> Column:
    """``yyyyMM`` of a timestamp or date."""
    return F.date_format(ts, "yyyyMM")


def year_month_of_text(day: Column) -> Column:
    """``yyyyMM`` of a ``yyyy-MM-dd`` string: its first two dash parts, joined."""
    parts = F.split(day, "-")
    return F.concat(F.get(parts, F.lit(0)), F.get(parts, F.lit(1)))


def register_change_date(spark: SparkSession) -> None:
    """Make ``changeDate('yyyy-MM-dd')`` available to SQL text."""
    spark.sql(
        "CREATE OR REPLACE TEMPORARY FUNCTION changeDate(day STRING) RETURNS STRING "
        "RETURN concat(get(split(day, '-'), 0), get(split(day, '-'), 1))"
    )


def hour_label(ts: Column) -> Column:
    return F.date_format(ts, "yyyy/MM/dd/HH")


def second_label(ts: Column) -> Column:
    return F.date_format(ts, "yyyy-MM-dd HH:mm:ss")


def as_timestamp(col: Column) -> Column:
    """Zone-less timestamps are read in the session time zone."""
    return col.cast(T.TimestampType())
