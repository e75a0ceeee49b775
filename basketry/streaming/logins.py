"""Repeated login failures, on a stream."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from basketry.functions.dates import duration_seconds
from basketry.operators.events import alert_rows, bucket_span, buckets_of, lockout_until
from basketry.sources.streams import start, with_event_time
from basketry.sources.tables import write_batch

_STATE = "micros bigint, tie bigint, failed boolean"


class AdjacentFailures(StatefulProcessor):
    """Pairs of failed logins with no other login of the user in between, inside one time bucket.

    Rows wait in state until the watermark has passed them, because an earlier row may still
    arrive; then they are walked through in time order. The rows of the bucket before that are
    near enough to matter are handed to the bucket as well; only its own rows give a pair. State
    per user and bucket: the rows waiting and the last row walked over, which goes when no row of
    the bucket can follow it.
    """

    def __init__(self, limit: int, span: int) -> None:
        self.limit, self.span = limit, span

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.waiting = handle.getListState("waiting", _STATE)
        self.last = handle.getValueState("last", _STATE)

    def _wake_at(self, micros: int) -> None:
        self.handle.registerTimer(micros // 1000 + 1)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues):
        earliest = None
        for frame in rows:
            new = list(zip(
                (int(v) for v in frame["micros"]), (int(v) for v in frame["tie"]),
                (bool(v) for v in frame["failed"]), strict=True,
            ))
            if new:
                self.waiting.appendList(new)
                first = min(new)[0]
                earliest = first if earliest is None else min(earliest, first)
        if earliest is not None:
            self._wake_at(earliest)
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        now = timerValues.getCurrentWatermarkInMs() * 1000
        user, bucket = key
        rows = sorted(tuple(r) for r in self.waiting.get()) if self.waiting.exists() else []
        due = [r for r in rows if r[0] < now]
        later = rows[len(due):]
        before = tuple(self.last.get()) if self.last.exists() else None
        found = []
        for row in due:
            if (row[2] and before and before[2] and row[0] - before[0] < self.limit
                    and row[0] // self.span == bucket):
                found.append(row[0])
            before = row
        if later:
            self.waiting.put(later)
            self._wake_at(later[0][0])
        else:
            self.waiting.clear()
        # The last row counts while one of the bucket within the limit may come.
        until = min(before[0] + self.limit, (bucket + 1) * self.span) if before else 0
        if before is not None and until >= now:
            self.last.update(before)
            if not later:
                self._wake_at(until)  # to forget an idle user
        elif self.last.exists():
            self.last.clear()
        if found:
            yield pd.DataFrame({"user_id": [user] * len(found), "micros": found})

    def close(self) -> None:
        pass


def login_alerts_stream(
    stream: DataFrame, within: str = "2 minutes", tie: str = "event_id", delay: str = "0 seconds"
) -> DataFrame:
    """Streaming form of ``login_alerts``: ``user_id, ts, time, message``. State and timers are
    per user and time bucket, so no call holds more of a user than one bucket."""
    limit = duration_seconds(within) * 1_000_000
    span = bucket_span(limit)
    timed = with_event_time(stream, "ts", delay).select(
        "user_id", "ts", F.unix_micros("ts").alias("micros"), F.col(tie).alias("tie"),
        (F.col("event_type") == "fail").alias("failed"),
    )
    timed = timed.withColumn("bucket", F.explode(buckets_of(F.col("micros"), limit, span)))
    pairs = timed.groupBy("user_id", "bucket").transformWithStateInPandas(
        statefulProcessor=AdjacentFailures(limit, span),
        outputStructType="user_id long, micros long",
        outputMode="append",
        timeMode="eventTime",
    )
    return alert_rows(pairs.select("user_id", F.timestamp_micros("micros").alias("ts")))


def start_login_alerts(
    stream: DataFrame,
    base: str,
    checkpoint: str,
    within: str = "2 minutes",
    minutes: int = 30,
    tie: str = "event_id",
    every: str | None = "3 seconds",
    lock: Callable[[DataFrame], None] | None = None,
) -> StreamingQuery:
    """Write alerts to ``login_warn`` and the lockouts they cause to ``lockout``, per batch;
    ``lock`` gets the lockouts (``user_id, no_login_until``) of each batch that has any. A batch
    that is tried again locks the same users until the same time."""
    def save(batch: DataFrame, batch_id: int) -> None:
        batch.persist()
        write_batch(batch, "login_warn", base, batch_id)
        lockouts = lockout_until(batch, minutes)
        write_batch(lockouts, "lockout", base, batch_id)
        if lock is not None and not batch.isEmpty():
            lock(lockouts)
        batch.unpersist()

    return start(
        login_alerts_stream(stream, within, tie), checkpoint, batch=save, every=every
    )
