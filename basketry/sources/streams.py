"""Stream inputs and outputs."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery


def read_lines_stream(spark: SparkSession, source: str, **options: str) -> DataFrame:
    """Lines of a stream as a ``value`` column.

    ``source="kafka"`` starts at the latest offsets unless told otherwise and has the message's
    ``partition`` and ``offset`` too; ``"text"`` follows a folder of text files (``path=...``).
    """
    if source == "kafka":
        options = {"startingOffsets": "latest", **options}
        raw = spark.readStream.format("kafka").options(**options).load()
        return raw.select(F.col("value").cast("string").alias("value"), "partition", "offset")
    if source == "text":
        return spark.readStream.format("text").options(**options).load()
    raise ValueError(f"unknown stream source {source!r}")


def message_order(partition: Column, offset: Column) -> Column:
    """A number that rises with the offset in a partition; equal offsets of several partitions
    (up to 4096) differ."""
    return offset.cast("long") * 4096 + F.pmod(partition, F.lit(4096))


def with_event_time(df: DataFrame, col: str = "ts", delay: str = "0 seconds") -> DataFrame:
    """Event time whose watermark follows the newest event by ``delay``."""
    return df.withWatermark(col, delay)


def start(
    df: DataFrame,
    checkpoint: str,
    *,
    batch: Callable[[DataFrame, int], None] | None = None,
    sink: str | None = None,
    mode: str = "append",
    every: str | None = "3 seconds",
    **options: str,
) -> StreamingQuery:
    """Start a stream into ``sink`` or a per-batch function.

    ``every=None`` works off what is there now and stops.
    """
    writer = df.writeStream.outputMode(mode).option("checkpointLocation", checkpoint)
    writer = (
        writer.trigger(availableNow=True) if every is None
        else writer.trigger(processingTime=every)
    )
    if batch is not None:
        return writer.foreachBatch(batch).start()
    return writer.format(sink or "console").options(**options).start()


def to_console(df: DataFrame, checkpoint: str, mode: str = "append") -> StreamingQuery:
    return start(df, checkpoint, sink="console", mode=mode, truncate="false")


def to_kafka(lines: DataFrame, checkpoint: str, topic: str, servers: str) -> StreamingQuery:
    """Write ``key``/``value`` lines to a topic."""
    return start(
        lines, checkpoint, sink="kafka", topic=topic, **{"kafka.bootstrap.servers": servers}
    )
