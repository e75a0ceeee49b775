"""Registered streaming queries: run a stream over the event table to its end, read its output."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from basketry.functions import dates, text
from basketry.operators import events
from basketry.plans import catalogue
from basketry.runtime import ROCKSDB_PROVIDER, cut_lineage, scratch_path
from basketry.sources import files, retail, tables
from basketry.streaming import hot_items, logins, recommend, relay, visitors


def _events(spark: SparkSession, sf: str) -> DataFrame:
    schema = retail.load(spark, sf, "events").schema
    return spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet").parquet(sf)


#: Files, and so batches, that ``_sliced`` makes of the events.
SLICES = 5


def _sliced(spark: SparkSession, sf: str) -> DataFrame:
    """The events as files of one time slice each, written one after the other and read a file
    per batch: state is carried from batch to batch, and the watermark moves in between."""
    event = retail.load(spark, sf, "events")
    moment = F.unix_micros(dates.as_timestamp(F.col("ts")))
    micros = event.select(moment.alias("at"))
    cuts = micros.approxQuantile("at", [k / SLICES for k in range(1, SLICES)], 0.001)
    at, path = moment, scratch_path(spark, "slices")
    bounds = [None, *cuts, None]
    for k, (low, high) in enumerate(zip(bounds[:-1], bounds[1:])):
        part = event.where(at >= low) if low is not None else event
        part = part.where(at < high) if high is not None else part
        part.coalesce(1).write.parquet(f"{path}/{k}")
    return spark.readStream.schema(event.schema).option("maxFilesPerTrigger", 1).parquet(f"{path}/*")


def _run(spark: SparkSession, label: str, begin: Callable) -> str:
    """Start a stream with a fresh output folder, wait for its end, return the folder."""
    # Sessions that ``build_session`` made have it already.
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB_PROVIDER)
    base = scratch_path(spark, label)
    begin(f"{base}/out", f"{base}/checkpoint").awaitTermination()
    return f"{base}/out"


def stream_hot_items(spark: SparkSession, sf: str) -> DataFrame:
    stream = retail.behavior_of(_events(spark, sf))
    out = _run(spark, "hot", lambda base, cp: hot_items.start_hot_items(
        stream, base, cp, every=None))
    return tables.read_table(spark, "hot_window", out).select(
        dates.second_label(F.col("window_end")).alias("window_end"), "rank", "product_id", "count"
    )


def stream_uv(spark: SparkSession, sf: str) -> DataFrame:
    stream = retail.behavior_of(_events(spark, sf))
    out = _run(spark, "uv", lambda base, cp: visitors.start_uv(
        stream, base, cp, event_type="view", every=None))
    return tables.read_replaced(spark, "uv_hour", out, "start").select(
        dates.hour_label(F.col("start")).alias("start"),
        dates.hour_label(F.col("end")).alias("end"), "count",
    )


def stream_uv_bitmap(spark: SparkSession, sf: str) -> DataFrame:
    """Bitmap pages of each batch, united over all batches in a snapshot."""
    stream = retail.behavior_of(_sliced(spark, sf))
    out = _run(spark, "pages", lambda base, cp: visitors.start_uv_pages(
        stream, base, cp, event_type="view", every=None))
    tables.compact_batches(spark, "uv_pages", out, merge=events.merged_pages)
    pages = tables.read_merged(spark, "uv_pages", out, events.merged_pages)
    return _hours(events.uv_of_pages(pages))


def stream_uv_sketch_days(spark: SparkSession, sf: str) -> DataFrame:
    """Are the visitors of each day, from the stream's hourly sketches, within 3 % of the exact
    number, or within one?"""
    stream = retail.behavior_of(_sliced(spark, sf))
    out = _run(spark, "sketches", lambda base, cp: visitors.start_uv_sketches(
        stream, base, cp, event_type="view", every=None))
    stored = spark.read.parquet(tables.table_path(out, "uv_sketch"))
    return catalogue.sketches_close(stored, retail.behavior(spark, sf))


def _hours(counted: DataFrame) -> DataFrame:
    return counted.select(
        dates.hour_label(F.col("start")).alias("start"), dates.hour_label(F.col("end")).alias("end"),
        "count")


def _login_tables(spark: SparkSession, sf: str) -> str:
    stream = retail.login_event_of(_events(spark, sf))
    return _run(spark, "login", lambda base, cp: logins.start_login_alerts(
        stream, base, cp, within="24 hours", every=None))


def stream_login_alerts(spark: SparkSession, sf: str) -> DataFrame:
    out = _login_tables(spark, sf)
    return tables.read_table(spark, "login_warn", out).select("user_id", "time", "message")


def stream_lockouts(spark: SparkSession, sf: str) -> DataFrame:
    lockouts = spark.read.parquet(tables.table_path(_login_tables(spark, sf), "lockout"))
    return lockouts.groupBy("user_id").agg(F.max("no_login_until").alias("until")).select(
        "user_id", dates.second_label(F.col("until")).alias("no_login_until")
    )


def stream_recent_ratings(spark: SparkSession, sf: str) -> DataFrame:
    stream = retail.event_rating_of(_sliced(spark, sf))
    out = _run(spark, "recent", lambda base, cp: recommend.start_recent_ratings(
        stream, base, cp, every=None))
    queues = tables.read_replaced(spark, "recent_queue", out, "user_id")
    return recommend.queue_rows(queues).withColumn("ts", dates.second_label(F.col("ts")))


def stream_online_recs(spark: SparkSession, sf: str) -> DataFrame:
    stream = retail.event_rating_of(_sliced(spark, sf))
    members, near = catalogue.content_near(spark, sf)
    # Like ``near`` they stand for stored tables: every batch reads them several times.
    members = cut_lineage(members, "members")
    rated = cut_lineage(catalogue.rated_products(spark, sf).distinct(), "rated")
    out = _run(spark, "online", lambda base, cp: recommend.start_online_recs(
        stream, lambda keys: near, lambda keys: rated, base, cp, members=lambda: members, every=None))
    lists = tables.read_replaced(spark, "stream_recs", out, "user_id")
    return catalogue.flat_lists(lists)


def stream_relay(spark: SparkSession, sf: str) -> DataFrame:
    """Log lines of all events through the relay, parsed again on the other side."""
    event = _events(spark, sf)
    line = F.when(
        F.col("event_type") == "purchase",
        F.concat(F.lit("INFO  ratings : "), text.rating_log_line(
            F.col("user_id"), F.get_json_object("props", "$.k").cast("long"),
            F.least(F.lit(5.0), 1 + F.floor(F.col("value") / 20).cast("double")),
            dates.as_timestamp(F.col("ts")),
        )),
    ).otherwise(F.concat(F.lit("INFO  "), "event_type", F.lit(" : "), "props"))
    out = _run(spark, "relay", lambda path, cp: relay.start_relay_to_files(
        event.select(line.alias("value")), path, cp, every=None))
    parsed, _ = files.parse_rating(files.read_lines(spark, out))
    return parsed.withColumn("ts", dates.second_label(F.col("ts")))


STREAMS = {
    q.__name__: q
    for q in (
        stream_hot_items, stream_uv, stream_uv_bitmap, stream_uv_sketch_days, stream_login_alerts, stream_lockouts,
        stream_recent_ratings, stream_online_recs, stream_relay,
    )
}
