"""Hot items per sliding window, on a stream."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from basketry.functions.dates import duration_seconds
from basketry.operators.events import hot_window_topn
from basketry.sources.streams import start, with_event_time
from basketry.sources.tables import write_batch


def hot_item_counts(
    stream: DataFrame, size: str = "1 hour", slide: str = "5 minutes", delay: str = "0 seconds"
) -> DataFrame:
    """``window_end, product_id, count``; in append mode a window comes out once, when closed.

    Where the slide divides the window, events are counted per slide-long pane and panes are
    added up, so an event touches one row of state and not one per window.
    """
    timed = with_event_time(stream.select("ts", "product_id"), "ts", delay)
    if duration_seconds(size) % duration_seconds(slide) == 0:
        panes = timed.groupBy(F.window("ts", slide).alias("pane"), "product_id").agg(
            F.count(F.lit(1)).alias("n")
        )
        counted = panes.groupBy(
            F.window(F.window_time("pane"), size, slide).alias("w"), "product_id"
        ).agg(F.sum("n").alias("count"))
    else:
        counted = timed.groupBy(F.window("ts", size, slide).alias("w"), "product_id").agg(
            F.count(F.lit(1)).alias("count")
        )
    return counted.select(F.col("w.end").alias("window_end"), "product_id", "count")


def start_hot_items(
    stream: DataFrame,
    base: str,
    checkpoint: str,
    n: int = 10,
    name: str = "hot_window",
    every: str | None = "3 seconds",
    **window: str,
) -> StreamingQuery:
    """Write the first ``n`` items of every closed window to table ``name``.

    All rows of a window leave the state in the same batch, so ranking the batch is ranking
    the window.
    """
    def rank(batch: DataFrame, batch_id: int) -> None:
        write_batch(hot_window_topn(batch, n), name, base, batch_id)

    return start(hot_item_counts(stream, **window), checkpoint, batch=rank, every=every)
