"""Parsing and formatting of message and log lines, as columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from basketry.functions.values import RATING_PREFIX


def field(line: Column, sep: str, position: int) -> Column:
    """One trimmed field of a separated line (null when the line is too short)."""
    return F.trim(F.get(F.split(line, f"[{sep}]" if sep in "|^." else sep), F.lit(position)))


def extract_rating_payload(line: Column, prefix: str = RATING_PREFIX) -> Column:
    """Text after ``prefix:`` in a log line, trimmed; null where the prefix is absent."""
    mark = prefix + ":"
    return F.when(
        F.contains(line, F.lit(mark)), F.trim(F.split_part(line, F.lit(mark), F.lit(2)))
    )


def rating_payload(user_id: Column, product_id: Column, score: Column, ts: Column) -> Column:
    """``user|product|score|epoch seconds``."""
    return F.concat_ws(
        "|",
        user_id.cast("string"),
        product_id.cast("string"),
        score.cast("double").cast("string"),
        F.unix_seconds(ts).cast("string"),
    )


def rating_log_line(
    user_id: Column, product_id: Column, score: Column, ts: Column, prefix: str = RATING_PREFIX
) -> Column:
    """The log line a submitted rating leaves behind."""
    return F.concat(F.lit(prefix + ":"), rating_payload(user_id, product_id, score, ts))


def redecode(text: Column) -> Column:
    """Repair UTF-8 text that was read as ISO-8859-1."""
    return F.decode(F.encode(text, "ISO-8859-1"), "UTF-8")


def tag_words(tags: Column) -> Column:
    """Lower-cased words of a ``|``-separated tag string.

    Follows the JVM tokenizer: inner empty words stay, trailing ones go, and the
    empty string is one empty word.
    """
    spaced = F.lower(F.translate(F.coalesce(tags, F.lit("")), "|", " "))
    kept = F.regexp_replace(spaced, r"\s+$", "")
    return (
        F.when(spaced == "", F.array(F.lit("")))
        .when(kept == "", F.array().cast("array<string>"))
        .otherwise(F.split(kept, r"\s"))
    )


def ranked_line(rank: Column, product_id: Column, count: Column) -> Column:
    """Report text of one hot item."""
    return F.concat_ws(
        " ", F.concat(F.lit("NO"), rank.cast("string"), F.lit(":")),
        F.concat(F.lit("product="), product_id.cast("string")),
        F.concat(F.lit("count="), count.cast("string")),
    )
