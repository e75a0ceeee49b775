"""Event-log operators in batch form: hot items, unique visitors, login alerts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from basketry.functions.dates import duration_seconds, second_label
from basketry.functions.hashing import poly_hash
from basketry.functions.values import LOGIN_WARNING
from basketry.operators.lists import top_k

_MICROS = 1_000_000


# --- hot items ---------------------------------------------------------------------------

def hot_window_counts(
    events: DataFrame, size: str = "1 hour", slide: str = "5 minutes"
) -> DataFrame:
    """``window_end, product_id, count`` over sliding windows.

    Events are counted once per slide-long pane, and panes are added up into windows, so an
    event is not copied into every window it belongs to.
    """
    length, step = duration_seconds(size), duration_seconds(slide)
    if length % step:
        spread = events.select(F.window("ts", size, slide)["end"].alias("window_end"), "product_id")
        return spread.groupBy("window_end", "product_id").agg(F.count(F.lit(1)).alias("count"))
    panes = events.groupBy(
        F.window("ts", slide)["end"].alias("pane_end"), "product_id"
    ).agg(F.count(F.lit(1)).alias("n"))
    ends = F.transform(
        F.sequence(F.lit(0), F.lit(length // step - 1)),
        lambda i: F.timestamp_seconds(F.unix_seconds("pane_end") + i * step),
    )
    return (
        panes.select(F.explode(ends).alias("window_end"), "product_id", "n")
        .groupBy("window_end", "product_id").agg(F.sum("n").alias("count"))
    )


def hot_window_topn(counts: DataFrame, n: int = 10) -> DataFrame:
    """``window_end, rank, product_id, count``: the ``n`` largest counts per window."""
    best = top_k(counts, "window_end", [F.desc("count"), F.asc("product_id")], n)
    return best.select("window_end", "rank", "product_id", "count")


# --- unique visitors ---------------------------------------------------------------------

def visits(events: DataFrame, event_type: str = "pv") -> DataFrame:
    return events.where(F.col("event_type") == event_type)


def uv_hourly(
    events: DataFrame, method: str = "exact", event_type: str = "pv"
) -> DataFrame:
    """``start, end, count``: visitors per hour.

    ``exact`` counts distinct users; ``bitmap`` counts distinct positions of the visitor hash,
    as a shared bitmap does; ``approx`` is a sketch.
    """
    rows = visits(events, event_type).select(F.window("ts", "1 hour").alias("w"), "user_id")
    if method == "exact":
        counted = rows.groupBy("w").agg(F.count_distinct("user_id").alias("count"))
    elif method == "approx":
        counted = rows.groupBy("w").agg(F.approx_count_distinct("user_id").alias("count"))
    elif method == "bitmap":
        place = rows.select("w", poly_hash(F.col("user_id").cast("string")).alias("at"))
        pages = place.groupBy("w", F.bitmap_bucket_number("at").alias("page")).agg(
            F.bitmap_construct_agg(F.bitmap_bit_position("at")).alias("bits")
        )
        counted = pages.groupBy("w").agg(F.sum(F.bitmap_count("bits")).alias("count"))
    else:
        raise ValueError(f"unknown method {method!r}")
    return counted.select(
        F.col("w.start").alias("start"), F.col("w.end").alias("end"),
        F.coalesce("count", F.lit(0)).cast("long").alias("count"),
    )


#: Bits of a sketch's row number: its relative error is about 1.04 / sqrt(2^bits), 0.8 %.
SKETCH_BITS = 14


def uv_sketches(events: DataFrame, event_type: str = "pv") -> DataFrame:
    """``hour, sketch``: a mergeable sketch of each hour's visitors."""
    hour = F.date_trunc("hour", "ts").alias("hour")
    return visits(events, event_type).select(hour, F.col("user_id").cast("long").alias("user_id")).groupBy(
        "hour").agg(F.hll_sketch_agg("user_id", F.lit(SKETCH_BITS)).alias("sketch"))


def uv_of_sketches(sketches: DataFrame, unit: str = "day") -> DataFrame:
    """``start, count``: visitors per ``unit`` (hour, day, month...), from stored sketches only;
    an hour may have several."""
    return sketches.groupBy(F.date_trunc(unit, "hour").alias("start")).agg(
        F.hll_sketch_estimate(F.hll_union_agg("sketch")).alias("count"))


def uv_pages(events: DataFrame, event_type: str = "pv") -> DataFrame:
    """``hour, page, bits``: pages of each hour's bitmap of visitor hashes."""
    place = visits(events, event_type).select(
        F.date_trunc("hour", "ts").alias("hour"), poly_hash(F.col("user_id").cast("string")).alias("at"))
    return place.groupBy("hour", F.bitmap_bucket_number("at").alias("page")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("at")).alias("bits"))


def merged_pages(pages: DataFrame) -> DataFrame:
    """One row per hour and page, of all bits set in any of its rows."""
    return pages.groupBy("hour", "page").agg(F.bitmap_or_agg("bits").alias("bits"))


def uv_of_pages(pages: DataFrame) -> DataFrame:
    """``start, end, count``: visitor hashes per hour."""
    counted = merged_pages(pages).groupBy("hour").agg(F.sum(F.bitmap_count("bits")).alias("count"))
    return counted.select(
        F.col("hour").alias("start"), (F.col("hour") + F.make_dt_interval(hours=F.lit(1))).alias("end"),
        F.col("count").cast("long").alias("count"))


def uv_running(
    events: DataFrame, tie: str = "event_id", event_type: str = "pv", slice_seconds: int = 10
) -> DataFrame:
    """One row per visit: ``start, end, user_id, ts, <tie>, count``, where ``count`` is the
    number of visitors of the hour so far.

    An hour is never walked through by one task. It is cut into slices; visitors are counted
    at their first visit only, slice totals give every slice its starting count, and the rest
    is a running sum inside the slice.
    """
    rows = visits(events, event_type).select(
        F.window("ts", "1 hour").alias("w"), "user_id", "ts", F.col(tie).alias("tie")
    )
    first = rows.groupBy("w", "user_id").agg(F.min(F.struct("ts", "tie")).alias("at"))
    part = F.floor(F.unix_seconds("ts") / slice_seconds).alias("part")
    # A first visit is a row of its own just before the visit it belongs to.
    marks = first.select("w", "user_id", "at.ts", "at.tie").select(
        "w", part, "ts", "tie", "user_id", F.lit(0).alias("kind"), F.lit(1).alias("new")
    )
    seen = rows.select(
        "w", part, "ts", "tie", "user_id", F.lit(1).alias("kind"), F.lit(0).alias("new")
    )
    earlier = Window.partitionBy("w").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        marks.groupBy("w", "part").agg(F.sum("new").alias("started"))
    )
    # Every slice with a visit needs an offset, also one without a new visitor.
    slices = rows.select("w", part).distinct().join(offsets, ["w", "part"], "left")
    offsets = slices.select(
        "w", "part",
        F.coalesce(F.sum(F.coalesce("started", F.lit(0))).over(earlier), F.lit(0)).alias("before"),
    )
    inside = Window.partitionBy("w", "part").orderBy("ts", "tie", "kind").rowsBetween(
        Window.unboundedPreceding, 0
    )
    running = (
        marks.unionByName(seen)
        .withColumn("inside", F.sum("new").over(inside))
        .where(F.col("kind") == 1)
    )
    return running.join(offsets, ["w", "part"]).select(
        F.col("w.start").alias("start"), F.col("w.end").alias("end"), "user_id", "ts",
        F.col("tie").alias(tie), (F.col("before") + F.col("inside")).cast("long").alias("count"),
    )


# --- login alerts ------------------------------------------------------------------------

def bucket_span(limit: int) -> int:
    """Length of a time bucket, in microseconds like ``limit``."""
    return max(3600 * _MICROS, 16 * limit)


def buckets_of(at: Column, limit: int, span: int) -> Column:
    """The time bucket of a row, and the next one if the row is near enough to matter there."""
    own = F.floor(at / span)
    return F.when(at >= (own + 1) * span - limit, F.array(own, own + 1)).otherwise(F.array(own))


def login_alerts(
    events: DataFrame, within: str = "2 minutes", tie: str = "event_id"
) -> DataFrame:
    """``user_id, ts, time, message``: a failed login right after another of the same user,
    less than ``within`` apart; any other login in between breaks the pair.

    A user's events are not gathered in one place: they are cut into time buckets, and each
    bucket also receives the events of the one before it that are still near enough to matter.
    """
    limit = duration_seconds(within) * _MICROS
    span = bucket_span(limit)
    at = F.unix_micros("ts")
    rows = events.select(
        "user_id", "event_type", "ts", F.col(tie).alias("tie"), F.floor(at / span).alias("own"),
        F.explode(buckets_of(at, limit, span)).alias("bucket"),
    )
    order = Window.partitionBy("user_id", "bucket").orderBy("ts", "tie")
    adjacent = rows.withColumn(
        "before", F.lag(F.struct("event_type", "ts")).over(order)
    )
    alerts = adjacent.where(
        (F.col("own") == F.col("bucket"))
        & (F.col("event_type") == "fail") & (F.col("before.event_type") == "fail")
        & (F.unix_micros("ts") - F.unix_micros("before.ts") < limit)
    )
    return alert_rows(alerts)


def alert_rows(alerts: DataFrame) -> DataFrame:
    return alerts.select(
        "user_id", "ts", second_label(F.col("ts")).alias("time"),
        F.lit(LOGIN_WARNING).alias("message"),
    )


def lockout_until(alerts: DataFrame, minutes: int = 30) -> DataFrame:
    """``user_id, no_login_until``: half an hour from the user's last alert."""
    return alerts.groupBy("user_id").agg(
        (F.max("ts") + F.make_dt_interval(mins=F.lit(minutes))).alias("no_login_until")
    )


def apply_lockouts(user: DataFrame, lockouts: DataFrame) -> DataFrame:
    """Users with the later of their present and their new lockout."""
    new = lockouts.select(
        F.col("user_id").alias("locked_id"), F.col("no_login_until").alias("new_until")
    )
    # Compared as longs: ids in event logs go beyond 32 bits.
    same = F.col("user_id").cast("long") == F.col("locked_id").cast("long")
    return user.join(new, same, "left").withColumn(
        "no_login_until", F.greatest("no_login_until", "new_until")
    ).select(*user.columns)
