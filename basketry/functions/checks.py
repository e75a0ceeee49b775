"""Guards and number repairs."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from basketry.functions.values import MAX_INT_ID


def try_long(col: Column) -> Column:
    return col.try_cast("long")


def try_double(col: Column) -> Column:
    return col.try_cast("double")


def valid_id(col: Column) -> Column:
    """True for a numeric id that is a 32-bit integer strictly below the largest one."""
    number = col.try_cast("double")
    return F.coalesce(
        (number < F.lit(float(MAX_INT_ID))) & (number >= F.lit(-float(MAX_INT_ID) - 1)),
        F.lit(False),
    )


def half_score(score: Column) -> Column:
    """A page score (star count x 2) as a rating, to two decimals, half up."""
    return F.round(score / F.lit(2.0), 2)
