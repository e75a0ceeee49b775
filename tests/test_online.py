import math
import random

import pytest
from pyspark.sql import functions as F

from basketry.operators import content, online, ratings
from tests.conftest import rows, ts

import datetime


def brute(current, recent, sims, rated, n, k, exclude):
    """One user at a time, over a map of maps."""
    out = {}
    for user, product in current.items():
        pool = sorted((-s, b) for b, s in sims.get(product, {}).items()
                      if not (exclude and (user, b) in rated))[:k]
        scored = []
        for _, candidate in pool:
            terms, liked, other = [], 0, 0
            for item, score in recent.get(user, [])[:n]:
                s = sims.get(candidate, {}).get(item, 0.0)
                if s > 0.2:
                    terms.append(s * score)
                    liked, other = liked + (score > 2), other + (score <= 2)
            if terms:
                value = sum(terms) / len(terms) + math.log10(max(liked, 1)) - math.log10(max(other, 1))
                scored.append((-round(value, 10), candidate))
        out[user] = [(p, -s) for s, p in sorted(scored)]
    return out


def history(seed, users=12, products=30, n=150):
    rng = random.Random(seed)
    start = ts("2024-01-01 00:00:00")
    return [
        (i, rng.randrange(users), rng.randrange(products), float(rng.randrange(1, 6)),
         start + datetime.timedelta(minutes=i))
        for i in range(n)
    ]


def setup(spark, data):
    frame = spark.createDataFrame(
        data, "event_id long, user_id long, product_id long, score double, ts timestamp")
    current, recent = {}, {}
    for _, user, product, score, _ in data:
        current[user] = product
        recent.setdefault(user, []).insert(0, (product, score))
    return frame, current, recent


@pytest.mark.parametrize("exclude", [True, False])
@pytest.mark.parametrize(("n", "k"), [(20, 20), (3, 4)])
def test_flat_similarities(spark, exclude, n, k):
    data = history(1)
    frame, current, recent = setup(spark, data)
    rng = random.Random(2)
    sims = {a: {b: round(rng.random(), 6) for b in range(30) if b != a and rng.random() < 0.6}
            for a in range(28)}
    flat = spark.createDataFrame(
        [(a, b, s) for a, m in sims.items() for b, s in m.items()],
        "product_id long, other_id long, score double")
    rated = {(d[1], d[2]) for d in data}
    got = online.online_recs(
        online.newest_per_user(frame, ("event_id",)),
        ratings.recent_ratings(frame, 20, ("event_id",)),
        flat, frame.select("user_id", "product_id"), n=n, k=k, exclude_rated=exclude,
    )
    want = brute(current, recent, sims, rated, n, k, exclude)
    expected = [(u, i + 1, p) for u, found in want.items() for i, (p, _) in enumerate(found)]
    assert rows(got, "user_id", "rank", "product_id") == sorted(expected)
    scores = {(r["user_id"], r["product_id"]): r["score"] for r in got.collect()}
    for u, found in want.items():
        for p, s in found:
            assert scores[u, p] == pytest.approx(s, abs=1e-8)


def test_profiles_equal_flat(spark):
    rng = random.Random(4)
    product = spark.createDataFrame(
        [(i, "|".join(rng.choice(["a", "b", "c", "d", "e"]) for _ in range(3))) for i in range(30)],
        "product_id long, tags string")
    vectors = content.content_vectors(product)
    near = content.profile_neighbours(content.profile_pairs(vectors), vectors)
    members = content.profile_members(product, vectors)
    flat = content.content_neighbours(product, members, near)
    data = history(3)
    frame, _, _ = setup(spark, data)
    args = (
        online.newest_per_user(frame, ("event_id",)),
        ratings.recent_ratings(frame, 20, ("event_id",)),
    )
    rated = frame.where("event_id % 3 = 0").select("user_id", "product_id")
    for k in (2, 20):
        by_profile = online.online_recs(*args, near, rated, members, k=k)
        by_product = online.online_recs(*args, flat, rated, k=k)
        assert rows(by_profile) == rows(by_product)
        assert by_profile.count() > 0


def test_nothing_rated_and_unknown_product(spark):
    frame, _, _ = setup(spark, [(0, 1, 999, 5.0, ts("2024-01-01 00:00:00"))])
    sims = spark.createDataFrame([(1, 2, 0.5)], "product_id long, other_id long, score double")
    none = frame.select("user_id", "product_id").where(F.lit(False))
    got = online.online_recs(
        online.newest_per_user(frame), ratings.recent_ratings(frame), sims, none)
    assert got.count() == 0


def test_only_reached_neighbours_meet_their_members(spark):
    # Profile 0 is as near to all of the others, which have 50 members each.
    near = [(0, p * 50, 0.9) for p in range(1, 200)] + [(0, 0, 1.0)]
    asked = spark.createDataFrame(
        [(*r, 60) for r in near], "profile long, other long, score double, depth long")
    named = spark.createDataFrame(
        [(p * 50, p * 50 + m) for p in range(200) for m in range(50)], "other long, candidate long")
    kept = online._reached(asked, named)
    # 50 members come first, and a tenth place goes to the smallest member of the tenth profile.
    assert sorted(r["other"] for r in kept.collect()) == [p * 50 for p in range(11)]
    listed = sorted((-s, c) for p, o, s, _ in map(tuple, asked.collect()) for c in range(o, o + 50))
    cut = sorted((-r["score"], c) for r in kept.collect() for c in range(r["other"], r["other"] + 50))
    assert cut[:60] == listed[:60]


def test_stream_batches_read_stored_tables(spark, monkeypatch):
    from basketry.plans import catalogue, live

    joined = spark.range(3).join(spark.range(4), "id").select(
        F.col("id").alias("user_id"), F.col("id").alias("product_id"), F.col("id").alias("profile"))
    given = {}

    def begin(stream, sims, rated, base, checkpoint, members, every):
        given["plans"] = [
            t._jdf.queryExecution().toString() for t in (rated(None), members())]
        raise StopIteration

    monkeypatch.setattr(live, "_sliced", lambda spark, sf: spark.createDataFrame(
        [], "event_id long, user_id long, event_type string, props string, value double, ts string"))
    monkeypatch.setattr(catalogue, "content_near", lambda spark, sf: (joined, joined))
    monkeypatch.setattr(catalogue, "rated_products", lambda spark, sf: joined.drop("profile"))
    monkeypatch.setattr(live.recommend, "start_online_recs", begin)
    with pytest.raises(StopIteration):
        live.stream_online_recs(spark, "")
    assert not any("Join" in plan for plan in given["plans"])
