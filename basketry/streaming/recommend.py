"""Live ratings: the recent-ratings queue per user, and list refreshes."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from basketry.functions.values import RECENT_QUEUE_SIZE
from basketry.operators.lists import to_rec_list
from basketry.operators.online import online_recs, rows_of
from basketry.operators.ratings import recent_ratings
from basketry.sources.streams import start
from basketry.sources.tables import write_batch

#: Stored ratings come before all that arrive at the same time.
_FIRST = -(1 << 63)
_ENTRY = "micros bigint, tie bigint, product_id bigint, score double"
_OUT = f"user_id long, queue array<struct<{_ENTRY.replace(' ', ':').replace(',:', ',')}>>"


class RecentQueue(StatefulProcessor):
    """Newest ratings per user, at most ``size``; every batch puts out the queues it changed."""

    def __init__(self, size: int) -> None:
        self.size = size

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.queue = handle.getListState("queue", _ENTRY)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues):
        # A list that does not exist yet gives no rows; asking first is one more call per user.
        kept = [tuple(r) for r in self.queue.get()]
        for frame in rows:
            kept += [
                (int(m), int(t), int(p), float(s))
                for m, t, p, s in zip(
                    frame["micros"], frame["tie"], frame["product_id"], frame["score"],
                    strict=True,
                )
            ]
            kept = sorted(kept, reverse=True)[: self.size]
        self.queue.put(kept)
        names = ("micros", "tie", "product_id", "score")
        yield pd.DataFrame({
            "user_id": [key[0]], "queue": [[dict(zip(names, r, strict=True)) for r in kept]],
        })

    def handleInitialState(self, key, initialState: pd.DataFrame, timerValues) -> None:
        kept = [tuple(r) for r in self.queue.get()] if self.queue.exists() else []
        kept += [
            (int(m), int(t), int(p), float(s)) for m, t, p, s in zip(
                initialState["micros"], initialState["tie"], initialState["product_id"],
                initialState["score"], strict=True)
        ]
        self.queue.put(sorted(kept, reverse=True)[: self.size])

    def close(self) -> None:
        pass


def recent_ratings_stream(
    stream: DataFrame, n: int = RECENT_QUEUE_SIZE, tie: str = "event_id",
    stored: DataFrame | None = None,
) -> DataFrame:
    """``user_id, queue``: a user's last ``n`` ratings, newest first, after each batch.

    A new checkpoint starts from the last ``stored`` ratings (``user_id, product_id, score, ts``)
    of each user; of equal times an arriving one is the newer.
    """
    rows = stream.select(
        "user_id", F.unix_micros("ts").alias("micros"), F.col(tie).alias("tie"), "product_id",
        F.col("score").cast("double").alias("score"),
    )
    seed = None
    if stored is not None:
        last = recent_ratings(stored, n).select(
            "user_id", F.unix_micros("ts").alias("micros"), F.lit(_FIRST).alias("tie"),
            "product_id", F.col("score").cast("double").alias("score"))
        seed = last.groupBy("user_id")
    return rows.groupBy("user_id").transformWithStateInPandas(
        statefulProcessor=RecentQueue(n),
        outputStructType=_OUT,
        outputMode="update",
        timeMode="none",
        initialState=seed,
    )


def queue_rows(queues: DataFrame) -> DataFrame:
    """``user_id, rank, product_id, score, ts`` rows of queues."""
    rows = queues.select("user_id", F.posexplode("queue").alias("pos", "e"))
    return rows.select(
        "user_id", (F.col("pos") + 1).alias("rank"), F.col("e.product_id").alias("product_id"),
        F.col("e.score").alias("score"), F.timestamp_micros("e.micros").alias("ts"),
    )


def start_recent_ratings(
    stream: DataFrame, base: str, checkpoint: str, n: int = RECENT_QUEUE_SIZE,
    tie: str = "event_id", name: str = "recent_queue", every: str | None = "3 seconds",
    stored: DataFrame | None = None,
) -> StreamingQuery:
    """Keep table ``name`` up to date: read it with ``read_replaced(..., key="user_id")``."""
    def save(batch: DataFrame, batch_id: int) -> None:
        write_batch(batch, name, base, batch_id)

    return start(
        recent_ratings_stream(stream, n, tie, stored), checkpoint, batch=save, mode="update",
        every=every,
    )


def start_online_recs(
    stream: DataFrame,
    sims: Callable[[DataFrame], DataFrame],
    rated: Callable[[DataFrame], DataFrame],
    base: str,
    checkpoint: str,
    members: Callable[[], DataFrame] | None = None,
    n: int = 20,
    k: int = 20,
    tie: str = "event_id",
    name: str = "stream_recs",
    every: str | None = "3 seconds",
    stored: DataFrame | None = None,
    **scoring: float,
) -> StreamingQuery:
    """Replace the list of every user who rated something in the batch.

    A user's recent ratings come out of the stream's own state, which a new checkpoint fills
    from ``stored`` ratings. Similarities and rated products are functions of the keys that a
    batch asks for; they read their tables anew, so refreshed ones take effect without a
    restart. A user whose rating leads to no recommendation gets an empty list.
    """
    def refresh(batch: DataFrame, batch_id: int) -> None:
        queues = batch.persist()
        current = queues.select(
            "user_id", F.col("queue")[0]["product_id"].alias("product_id")
        )
        recent = queue_rows(queues)

        def known(keys: DataFrame) -> DataFrame:
            # What was just rated may not be stored yet.
            return rows_of(rated, keys).select("user_id", "product_id").unionByName(
                recent.select("user_id", "product_id")
            )

        found = online_recs(
            current, recent, sims, known, members and members(), n, k, **scoring
        )
        lists = to_rec_list(found, "user_id", "product_id", "score", k)
        empty = F.array().cast("array<struct<product_id:bigint,score:double>>")
        full = current.select("user_id").join(lists, "user_id", "left").select(
            "user_id", F.coalesce("recs", empty).alias("recs")
        )
        write_batch(full, name, base, batch_id)
        queues.unpersist()

    queues = recent_ratings_stream(stream, max(n, RECENT_QUEUE_SIZE), tie, stored)
    return start(queues, checkpoint, batch=refresh, mode="update", every=every)
