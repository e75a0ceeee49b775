from pyspark.sql import functions as F

from basketry import schemas
from basketry.operators import lists, ratings, stats, users
from basketry.plans import serving
from tests.conftest import rows, ts

RATING = "user_id long, product_id long, score double, ts timestamp"


def at(minute):
    return ts(f"2024-01-01 00:{minute:02d}:00")


def test_upsert_keeps_time_and_takes_last_score(spark):
    old = spark.createDataFrame([(1, 1, 2.0, at(0)), (1, 1, 3.0, at(1)), (2, 1, 4.0, at(2))], RATING)
    new = spark.createDataFrame(
        [(1, 1, 5.0, at(9)), (3, 3, 1.0, at(5)), (3, 3, 2.0, at(6))], RATING)
    assert rows(ratings.upsert_ratings(old, new)) == [
        (1, 1, 5.0, at(0)), (1, 1, 5.0, at(1)), (2, 1, 4.0, at(2)), (3, 3, 2.0, at(5))]


def test_recent_ratings(spark):
    data = [(1, p, float(p), at(p)) for p in range(30)] + [(2, 5, 1.0, at(0)), (2, 6, 1.0, at(0))]
    got = rows(ratings.recent_ratings(spark.createDataFrame(data, RATING), 3),
               "user_id", "rank", "product_id")
    assert got == [(1, 1, 29), (1, 2, 28), (1, 3, 27), (2, 1, 6), (2, 2, 5)]


def test_submit(spark):
    user = spark.createDataFrame([("ann", 7)], "username string, user_id int")
    requests = spark.createDataFrame(
        [("ann", 3, 9.0, at(1)), ("nobody", 3, 9.0, at(1))],
        "username string, product_id long, score double, ts timestamp")
    old = spark.createDataFrame([], RATING)
    table, lines = ratings.submit_ratings(requests, user, old)
    assert rows(table) == [(7, 3, 4.5, at(1))]
    seconds = int((at(1) - ts("1970-01-01 00:00:00")).total_seconds())
    assert rows(lines) == [(f"PRODUCT_RATING_PREFIX:7|3|4.5|{seconds}",)]


def user_table(spark):
    return spark.createDataFrame(
        [(1, "ann", True, None, ["x"], None), (2, "bob", True, None, [], None)], schemas.USER)


def test_register(spark):
    new = spark.createDataFrame(
        [("bob", at(0)), ("abc", at(2)), ("abc", at(1))], "username string, ts timestamp")
    got = users.register_users(new, user_table(spark))
    assert rows(got, "user_id", "username", "first", "ts") == [(96354, "abc", True, at(1))]
    assert got.schema.fieldNames() == schemas.USER.fieldNames()


def test_update_prefs(spark):
    updates = spark.createDataFrame(
        [(2, False, ["drama"])], "user_id int, first boolean, pref_genres array<string>")
    got = users.update_user_prefs(user_table(spark), updates)
    assert rows(got, "user_id", "first", "pref_genres") == [(1, True, ["x"]), (2, False, ["drama"])]


def test_statistics(spark):
    data = [(1, 1, "4", at(0)), (2, 1, "x", at(0)), (3, 2, "1", ts("2024-02-01 00:00:00")), (4, None, "1", at(0))]
    frame = spark.createDataFrame(data, "user_id long, product_id long, score string, ts timestamp")
    assert {tuple(r) for r in stats.rate_more(frame).collect()} == {(1, 2), (2, 1), (None, 0)}
    assert rows(stats.average_score(frame.where("product_id is not null"))) == [(1, 4.0), (2, 1.0)]
    ordered = stats.newest_first(stats.rate_more_recently(frame.where("product_id is not null")))
    assert [tuple(r) for r in ordered.collect()] == [(2, 1, "202402"), (1, 2, "202401")]


def test_serving(spark):
    product = spark.createDataFrame(
        [(i, f"name {i}", "", "c", "t") for i in (1, 2, 3)], schemas.PRODUCT)
    avg = spark.createDataFrame([(1, 4.5)], schemas.AVERAGE_SCORE)
    counts = spark.createDataFrame([(1, 5), (2, 9), (3, 5)], schemas.RATE_MORE)
    got = serving.most_rated_products(counts, product, avg, 2)
    assert rows(got, "rank", "product_id", "avg") == [(1, 2, 0.0), (2, 1, 4.5)]
    assert rows(serving.search_products(product, avg, "e [23]$"), "product_id") == [(2,), (3,)]
    named = product.withColumn("name", F.lit("鼠标 x"))
    misread = "鼠标".encode().decode("latin-1")
    assert serving.search_products(named, avg, misread).count() == 0
    assert serving.search_products(named, avg, misread, misread=True).count() == 3
    ids = spark.createDataFrame([(1,), (1,), (9,)], "product_id long")
    assert rows(serving.product_info(product, avg, ids), "product_id", "avg") == [(1, 4.5)]

    user = spark.createDataFrame([("ann", 7)], "username string, user_id int")
    flat = spark.createDataFrame([(7, 1, 0.5), (7, 2, 0.7), (7, 3, 0.7)], "user_id long, product_id long, score double")
    recs = lists.to_rec_list(flat, "user_id", "product_id", "score", 5)
    assert recs.schema.simpleString() == schemas.rec_list("user_id").simpleString()
    got = serving.recs_for(user, user, recs, product, avg, n=2)
    assert rows(got, "username", "rank", "product_id", "score") == [("ann", 1, 2, 0.7), ("ann", 2, 3, 0.7)]
    similar = spark.createDataFrame([(1, 1, 2, 0.9), (5, 1, 2, 0.9)], "product_id long, rank int, other_id long, score double")
    assert rows(serving.similar(similar, ids, product, avg), "asked_id", "rank", "product_id") == [(1, 1, 2)]


def test_rank_plans_cut_before_the_shuffle(spark):
    frame = spark.createDataFrame([(1, 1, 1.0, at(0))], RATING)
    plan = ratings.recent_ratings(frame)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2
