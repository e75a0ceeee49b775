"""Streams over files against their batch twins, with a restart in the middle."""

import datetime
import random

import pytest
from pyspark.sql import functions as F

from basketry.operators import events, online, ratings
from basketry.sources import files, streams, tables
from basketry.streaming import hot_items, logins, recommend, relay, visitors
from tests.conftest import rows, ts

START = ts("2020-02-20 05:00:00")
SCHEMA = "event_id long, user_id long, product_id long, event_type string, score double, ts timestamp"
FAR = datetime.timedelta(days=30)


def sample(seed=1, n=240):
    """Rows in time order over four hours, split into four parts with some disorder inside
    each, and a far future row that closes every window."""
    rng = random.Random(seed)
    at = START
    data = []
    for i in range(n):
        at += datetime.timedelta(seconds=rng.randrange(1, 120))
        user = 1 if rng.random() < 0.35 else rng.randrange(2, 10)
        data.append((i, user, rng.randrange(8), rng.choice(["fail", "fail", "success", "pv"]),
                     float(rng.randrange(1, 6)), at))
    parts = [data[k * n // 4:(k + 1) * n // 4] for k in range(4)]
    for part in parts:
        rng.shuffle(part)
    return data, parts


class Feed:
    """A folder of parquet files read as a stream, a file per batch."""

    def __init__(self, spark, path):
        self.spark, self.path, self.n = spark, str(path / "in"), 0
        self.base, self.checkpoint = str(path / "out"), str(path / "checkpoint")

    def add(self, data):
        folder = f"{self.path}/{self.n:03d}"
        self.spark.createDataFrame(data, SCHEMA).coalesce(1).write.parquet(folder)
        self.n += 1

    def stream(self):
        return self.spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(
            self.path + "/*")

    def batch(self, data):
        return self.spark.createDataFrame(data, SCHEMA)


def drive(feed, parts, begin, late=None):
    """Feed two parts, stop, feed the rest and the closing row, go on from the checkpoint."""
    for part in parts[:2]:
        feed.add(part)
    begin().awaitTermination()
    for part in parts[2:]:
        feed.add(part)
    if late:
        feed.add(late)
    feed.add([(10_000, 77, 77, "success", 1.0, START + FAR)])
    begin().awaitTermination()


@pytest.fixture
def feed(spark, tmp_path):
    return Feed(spark, tmp_path)


def test_hot_items(spark, feed):
    data, parts = sample()
    drive(feed, parts, lambda: hot_items.start_hot_items(
        feed.stream(), feed.base, feed.checkpoint, n=3, every=None),
        late=[(9_000, 1, 3, "pv", 1.0, START - FAR)])
    got = tables.read_table(spark, "hot_window", feed.base)
    want = events.hot_window_topn(events.hot_window_counts(feed.batch(data)), 3)
    assert rows(got, "window_end", "rank", "product_id", "count") == rows(want)


def test_visitors(spark, feed):
    data, parts = sample(2)
    drive(feed, parts, lambda: visitors.start_uv(
        feed.stream(), feed.base, feed.checkpoint, every=None),
        late=[(9_000, 99, 3, "pv", 1.0, START - FAR)])
    got = tables.read_replaced(spark, "uv_hour", feed.base, "start")
    assert rows(got, "start", "end", "count") == rows(events.uv_hourly(feed.batch(data)))


@pytest.mark.parametrize("within", ["2 minutes", "1 hour"])
def test_login_alerts(spark, feed, within):
    data, parts = sample(3)
    drive(feed, parts, lambda: logins.start_login_alerts(
        feed.stream(), feed.base, feed.checkpoint, within=within, every=None),
        late=[(9_000, 1, 3, "fail", 1.0, START - FAR)])
    got = tables.read_table(spark, "login_warn", feed.base)
    alerts = events.login_alerts(feed.batch(data), within)
    assert alerts.count() > 3
    assert rows(got, "user_id", "ts", "time", "message") == rows(alerts)
    lockouts = spark.read.parquet(feed.base + "/lockout").groupBy("user_id").agg(
        F.max("no_login_until"))
    assert rows(lockouts) == rows(events.lockout_until(alerts))


def test_recent_queue(spark, feed):
    data, parts = sample(4)
    for part in parts:
        feed.add(part)
    recommend.start_recent_ratings(
        feed.stream(), feed.base, feed.checkpoint, n=5, every=None).awaitTermination()
    got = recommend.queue_rows(tables.read_replaced(spark, "recent_queue", feed.base, "user_id"))
    want = ratings.recent_ratings(feed.batch(data), 5, ("event_id",))
    assert rows(got) == rows(want)


def test_online_recs(spark, feed):
    data, parts = sample(5)
    rng = random.Random(6)
    sims = spark.createDataFrame(
        [(a, b, round(rng.random(), 6)) for a in range(8) for b in range(12) if a != b],
        "product_id long, other_id long, score double")
    none = spark.createDataFrame([(1, 3)], "user_id long, product_id long")
    drive(feed, parts, lambda: recommend.start_online_recs(
        feed.stream(), lambda keys: sims, lambda keys: none, feed.base, feed.checkpoint,
        every=None))
    lists = tables.read_replaced(spark, "stream_recs", feed.base, "user_id")
    # The closing row rates a product nothing is similar to: an empty list, not a missing one.
    assert lists.where("user_id = 77").first()["recs"] == []
    frame = feed.batch(data)
    # What the queue holds was rated, stored or not.
    queued = ratings.recent_ratings(frame, 40, ("event_id",)).select("user_id", "product_id")
    want = online.online_recs(
        online.newest_per_user(frame, ("event_id",)),
        ratings.recent_ratings(frame, 20, ("event_id",)), sims, none.union(queued))
    got = lists.select("user_id", F.posexplode("recs").alias("pos", "r")).select(
        "user_id", F.col("pos") + 1, "r.product_id", "r.score")
    assert rows(got) == rows(want)


def test_relay(spark, tmp_path):
    folder = tmp_path / "log"
    folder.mkdir()
    (folder / "a.log").write_text("x : PRODUCT_RATING_PREFIX:1|2|5.0|1578830898\nnothing\n")
    (folder / "b.log").write_text("PRODUCT_RATING_PREFIX: 3|4|1.5|1578831024 \n")
    lines = streams.read_lines_stream(spark, "text", path=str(folder))
    out = str(tmp_path / "topic")
    relay.start_relay_to_files(lines, out, str(tmp_path / "cp"), every=None).awaitTermination()
    got, bad = files.parse_rating(files.read_lines(spark, out))
    assert rows(got, "user_id", "product_id", "score") == [(1, 2, 5.0), (3, 4, 1.5)]
    assert bad.count() == 0


def test_unknown_source(spark):
    with pytest.raises(ValueError):
        streams.read_lines_stream(spark, "carrier pigeon")


def test_a_new_checkpoint_starts_with_the_stored_ratings(spark, feed):
    data, parts = sample(7)
    stored = feed.batch(data[:120]).select("user_id", "product_id", "score", "ts")
    for part in (data[120:180], data[180:]):
        feed.add(part)
    recommend.start_recent_ratings(
        feed.stream(), feed.base, feed.checkpoint, n=6, every=None, stored=stored
    ).awaitTermination()
    got = recommend.queue_rows(tables.read_replaced(spark, "recent_queue", feed.base, "user_id"))
    arrived = [r[1] for r in data[120:]]
    # Only users of the stream come out; one row of each time.
    want = ratings.recent_ratings(feed.batch(data), 6, ("event_id",)).where(
        F.col("user_id").isin(arrived))
    assert rows(got) == rows(want)


def test_the_later_message_of_one_time_wins(spark, tmp_path):
    at = 1588830898
    lines = [(f"1|{p}|{float(p % 5 + 1)}|{at}", 3, offset) for p, offset in ((7, 12), (9, 10), (8, 11))]
    source = spark.createDataFrame(lines, "value string, partition int, offset long")
    parsed, bad = files.parse_rating(source.union(spark.createDataFrame([("bad", 3, 13)], source.schema)))
    ordered = parsed.withColumn("event_id", streams.message_order(F.col("partition"), F.col("offset")))
    assert bad.select("value").first()["value"] == "bad"
    ordered.drop("partition", "offset").coalesce(1).write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(ordered.drop("partition", "offset").schema).parquet(str(tmp_path / "in"))
    out = str(tmp_path / "out")
    recommend.start_recent_ratings(
        stream, out, str(tmp_path / "cp"), n=2, every=None).awaitTermination()
    queue = tables.read_replaced(spark, "recent_queue", out, "user_id").first()["queue"]
    assert [e["product_id"] for e in queue] == [7, 8]


def test_login_state_is_split_by_time(spark, feed, monkeypatch):
    """No call sees rows of more than one bucket and the last minutes before it."""
    class Watched(logins.AdjacentFailures):
        def handleInputRows(self, key, rows, timerValues):
            frames = list(rows)
            for frame in frames:
                inside = frame["micros"].between(
                    key[1] * self.span - self.limit, (key[1] + 1) * self.span - 1)
                assert inside.all()
            return super().handleInputRows(key, iter(frames), timerValues)

    monkeypatch.setattr(logins, "AdjacentFailures", Watched)
    data = [(i, 1, 0, "fail", 1.0, START + datetime.timedelta(seconds=50 * i)) for i in range(400)]
    drive(feed, [data[k * 100:(k + 1) * 100] for k in range(4)], lambda: logins.start_login_alerts(
        feed.stream(), feed.base, feed.checkpoint, every=None))
    assert tables.read_table(spark, "login_warn", feed.base).count() == 399


def test_alerts_across_buckets(spark, feed):
    data = [(i, 1 + i % 2, 0, "fail", 1.0, START + datetime.timedelta(seconds=40 * i))
            for i in range(400)]
    parts = [data[k * 100:(k + 1) * 100] for k in range(4)]
    locked = []
    drive(feed, parts, lambda: logins.start_login_alerts(
        feed.stream(), feed.base, feed.checkpoint, every=None,
        lock=lambda lockouts: locked.extend(rows(lockouts))))
    want = events.login_alerts(feed.batch(data), "2 minutes")
    assert want.count() == 398
    got = tables.read_table(spark, "login_warn", feed.base)
    assert rows(got, "user_id", "ts") == rows(want, "user_id", "ts")
    assert max(locked) == max(rows(events.lockout_until(want)))
