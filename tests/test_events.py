import datetime
import random
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from basketry.functions import hashing
from basketry.operators import events
from tests.conftest import rows, ts

START = ts("2020-02-20 05:00:00")
BEHAVIOR = "event_id long, user_id long, product_id long, event_type string, ts timestamp"


def behavior(spark, seed=1, n=400, hours=4):
    rng = random.Random(seed)
    data = []
    for i in range(n):
        at = START + datetime.timedelta(seconds=rng.randrange(hours * 3600))
        user = 7 if rng.random() < 0.35 else rng.randrange(40)
        data.append((i, user, rng.randrange(6), rng.choice(["pv", "pv", "fav"]), at))
    data.append((n, 1, 1, "pv", START + datetime.timedelta(hours=1)))  # on the edge
    return spark.createDataFrame(data, BEHAVIOR), data


@pytest.mark.parametrize(("size", "slide"), [("1 hour", "5 minutes"), ("50 minutes", "20 minutes")])
def test_hot_windows(spark, size, slide):
    frame, data = behavior(spark)
    length = datetime.timedelta(minutes=60 if size == "1 hour" else 50)
    step = datetime.timedelta(minutes=5 if slide == "5 minutes" else 20)
    epoch = ts("1970-01-01 00:00:00")
    want = Counter()
    for _, _, product, _, at in data:
        begin = epoch + ((at - epoch) // step) * step
        while begin + length > at:
            want[begin + length, product] += 1
            begin -= step
    counts = events.hot_window_counts(frame, size, slide)
    assert {(r[0], r[1]): r[2] for r in counts.collect()} == dict(want)

    top = defaultdict(list)
    for (end, product), n in want.items():
        top[end].append((-n, product))
    expected = sorted(
        (end, i + 1, p, -n) for end, found in top.items()
        for i, (n, p) in enumerate(sorted(found)[:3])
    )
    assert rows(events.hot_window_topn(counts, 3)) == expected


def test_uv_methods(spark):
    frame, data = behavior(spark)
    users, hashes = defaultdict(set), defaultdict(set)
    for _, user, _, kind, at in data:
        if kind == "pv":
            hour = at.replace(minute=0, second=0)
            users[hour].add(user)
            h = 0
            for c in str(user):
                h = h * 61 + ord(c)
            hashes[hour].add(h % (1 << 29))
    hour = datetime.timedelta(hours=1)
    for method, seen in (("exact", users), ("bitmap", hashes)):
        got = rows(events.uv_hourly(frame, method))
        assert got == sorted((h, h + hour, len(s)) for h, s in seen.items())
    approx = {r[0]: r[2] for r in events.uv_hourly(frame, "approx").collect()}
    assert set(approx) == set(users)
    with pytest.raises(ValueError):
        events.uv_hourly(frame, "guess")


@pytest.mark.parametrize("slice_seconds", [10, 700, 3600])
def test_uv_running(spark, slice_seconds):
    frame, data = behavior(spark, seed=2)
    seen, want = defaultdict(set), set()
    for i, user, _, kind, at in sorted(data, key=lambda d: (d[4], d[0])):
        if kind == "pv":
            hour = at.replace(minute=0, second=0)
            seen[hour].add(user)
            want.add((hour, user, i, len(seen[hour])))
    got = events.uv_running(frame, slice_seconds=slice_seconds)
    assert set(rows(got, "start", "user_id", "event_id", "count")) == want


# user, kind, millis
LOGINS = [
    (2774532135, "success", 1582192845138), (2774532135, "fail", 1582192845170),
    (2774532135, "fail", 1582192845193), (2774532135, "fail", 1582192845213),
    (1975086357, "success", 1582192845228), (3620591663, "fail", 1582192845293),
    (3620591663, "fail", 1582192845309), (3620591663, "fail", 1582192845321),
    (2196925110, "fail", 1582192845395), (2196925110, "success", 1582192845408),
    (2196925110, "fail", 1582192845431),
]


def logins(spark, data):
    return spark.createDataFrame(
        [(i, u, k, m) for i, (u, k, m) in enumerate(data)],
        "event_id long, user_id long, event_type string, millis long",
    ).select("event_id", "user_id", "event_type", F.timestamp_millis("millis").alias("ts"))


def test_login_alerts_known_rows(spark):
    got = rows(events.login_alerts(logins(spark, LOGINS)), "user_id", F.unix_millis("ts"))
    assert got == [
        (2774532135, 1582192845193), (2774532135, 1582192845213),
        (3620591663, 1582192845309), (3620591663, 1582192845321),
    ]


def test_login_alerts_against_a_walk(spark):
    rng = random.Random(5)
    data = []
    for _ in range(500):
        user = 1 if rng.random() < 0.4 else rng.randrange(6)
        data.append((user, rng.choice(["fail", "fail", "success"]), rng.randrange(4 * 3600) * 1000))
    hour = 3600_000
    data += [(50, "fail", hour - 1), (50, "fail", hour + 119_998), (50, "fail", hour + 239_998)]
    for within in (120, 900, 7200):
        want, last = set(), {}
        for i, (user, kind, at) in sorted(enumerate(data), key=lambda d: (d[1][2], d[0])):
            before = last.get(user)
            if kind == "fail" and before and before[0] == "fail" and at - before[1] < within * 1000:
                want.add((user, at))
            last[user] = (kind, at)
        got = rows(
            events.login_alerts(logins(spark, data), f"{within} seconds"),
            "user_id", F.unix_millis("ts"),
        )
        assert set(got) == want
        assert (50, hour + 119_998) in want
        if within == 120:
            assert (50, hour + 239_998) not in want  # exactly at the limit


def test_lockouts(spark):
    alerts = events.login_alerts(logins(spark, LOGINS))
    lockouts = events.lockout_until(alerts)
    got = dict(rows(lockouts.select("user_id", F.unix_millis("no_login_until"))))
    assert got == {2774532135: 1582192845213 + 1800_000, 3620591663: 1582192845321 + 1800_000}
    user = spark.createDataFrame(
        [(1, ts("2020-01-01 00:00:00")), (2, ts("2030-01-01 00:00:00")), (3, None), (4, None)],
        "user_id int, no_login_until timestamp",
    )
    new = spark.createDataFrame(
        [(1, ts("2021-01-01 00:00:00")), (2, ts("2021-01-01 00:00:00")), (3, ts("2021-01-01 00:00:00"))],
        "user_id long, no_login_until timestamp",
    )
    assert rows(events.apply_lockouts(user, new).where("user_id < 4")) == [
        (1, ts("2021-01-01 00:00:00")), (2, ts("2030-01-01 00:00:00")),
        (3, ts("2021-01-01 00:00:00")),
    ]
    assert events.apply_lockouts(user, new).where("no_login_until is null").count() == 1


def test_hash_bitmap_sizes(spark):
    got = spark.range(1000).select(hashing.poly_hash(F.col("id").cast("string")).alias("h"))
    assert got.agg(F.max("h")).first()[0] < 1 << 29


def test_sketches_and_pages_of_parts_unite(spark):
    import datetime
    import random

    from basketry.operators import events

    rng, start = random.Random(3), datetime.datetime(2024, 1, 30, 20)
    data = [(rng.randrange(300), "pv" if rng.random() < 0.9 else "buy",
             start + datetime.timedelta(minutes=rng.randrange(3000))) for _ in range(4000)]
    frame = spark.createDataFrame(data, "user_id long, event_type string, ts timestamp")
    halves = [frame.where(f"user_id % 2 = {k}") for k in (0, 1)] + [frame.limit(500)]
    pages = events.uv_pages(halves[0])
    sketches = events.uv_sketches(halves[0])
    for half in halves[1:]:
        pages = pages.union(events.uv_pages(half))
        sketches = sketches.union(events.uv_sketches(half))
    once = events.merged_pages(pages)
    assert rows_of(events.uv_of_pages(once)) == rows_of(events.uv_of_pages(pages)) == rows_of(
        events.uv_hourly(frame, "bitmap"))
    for unit in ("hour", "day", "month"):
        exact = {}
        for user, kind, ts in data:
            if kind == "pv":
                at = {"hour": ts.replace(minute=0), "day": ts.replace(hour=0, minute=0),
                      "month": ts.replace(day=1, hour=0, minute=0)}[unit]
                exact.setdefault(at, set()).add(user)
        got = {r["start"]: r["count"] for r in events.uv_of_sketches(sketches, unit).collect()}
        assert set(got) == set(exact)
        assert all(abs(got[at] - len(users)) <= max(1, 0.03 * len(users)) for at, users in exact.items())


def rows_of(df):
    return sorted(map(tuple, df.select("start", "end", "count").collect()))


def test_pages_of_lists(spark):
    from basketry.operators import lists

    flat = spark.createDataFrame(
        [(p, o, float((o * 7) % 5)) for p in range(3) for o in range(11 * p)],
        "product_id long, other_id long, score double")
    pages = lists.to_pages(flat, "product_id", "other_id", "score", "rec_id", 4)
    sizes = sorted((r["product_id"], r["page"], len(r["recs"])) for r in pages.collect())
    assert sizes == [(1, 0, 4), (1, 1, 4), (1, 2, 3), *((2, k, 4) for k in range(5)), (2, 5, 2)]
    got = lists.from_pages(pages, "product_id", "rec_id", 4)
    want = lists.from_rec_list(
        lists.to_rec_list(flat, "product_id", "other_id", "score", None, "rec_id"), "product_id", "rec_id")
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))


def test_a_long_limit_makes_few_buckets():
    """A user's month is at most three buckets of the day's limit; an hour is still the least."""
    day = 24 * 3600 * 1_000_000
    assert 30 * day / events.bucket_span(day) < 2
    assert events.bucket_span(120 * 1_000_000) == 3600 * 1_000_000
