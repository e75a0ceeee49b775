"""Visitors per hour, on a stream."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from basketry.operators.events import uv_pages, uv_sketches, visits
from basketry.sources.streams import start, with_event_time
from basketry.sources.tables import write_batch


def uv_stream(stream: DataFrame, event_type: str = "pv", delay: str = "0 seconds") -> DataFrame:
    """``start, end, count``: first visits per hour and user are let through, then counted.

    In update mode the count of an hour comes out again whenever it grows. The set of users
    seen lives in the checkpointed state and leaves it when the hour is closed.
    """
    timed = with_event_time(visits(stream, event_type).select("ts", "user_id"), "ts", delay)
    first = timed.withColumn("w", F.window("ts", "1 hour")).dropDuplicates(["w", "user_id"])
    counted = first.groupBy("w").agg(F.count(F.lit(1)).alias("count"))
    return counted.select(
        F.col("w.start").alias("start"), F.col("w.end").alias("end"), "count"
    )


def start_uv(
    stream: DataFrame,
    base: str,
    checkpoint: str,
    event_type: str = "pv",
    name: str = "uv_hour",
    every: str | None = "3 seconds",
    delay: str = "0 seconds",
) -> StreamingQuery:
    """Keep table ``name`` up to date: read it with ``read_replaced(..., key="start")``."""
    def save(batch: DataFrame, batch_id: int) -> None:
        write_batch(batch, name, base, batch_id)

    return start(
        uv_stream(stream, event_type, delay), checkpoint, batch=save, mode="update", every=every
    )


def start_uv_sketches(
    stream: DataFrame, base: str, checkpoint: str, event_type: str = "pv", name: str = "uv_sketch",
    every: str | None = "3 seconds",
) -> StreamingQuery:
    """Append each batch's sketches per hour to table ``name``; ``uv_of_sketches`` unites them to
    hours, days or months. The stream itself keeps nothing."""
    def save(batch: DataFrame, batch_id: int) -> None:
        write_batch(uv_sketches(batch, event_type), name, base, batch_id)

    return start(stream.select("ts", "user_id", "event_type"), checkpoint, batch=save, every=every)


def start_uv_pages(
    stream: DataFrame, base: str, checkpoint: str, event_type: str = "pv", name: str = "uv_pages",
    every: str | None = "3 seconds",
) -> StreamingQuery:
    """Append each batch's bitmap pages per hour to table ``name``: read them with
    ``read_merged(..., merge=merged_pages)``, which unites the pages of all batches."""
    def save(batch: DataFrame, batch_id: int) -> None:
        write_batch(uv_pages(batch, event_type), name, base, batch_id)

    return start(stream.select("ts", "user_id", "event_type"), checkpoint, batch=save, every=every)
