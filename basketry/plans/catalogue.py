"""Registered queries: every operator run over the test tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from basketry import schemas
from basketry.functions import dates, hashing, text
from basketry.operators import als, content, dense, events, itemcf, online, ratings, stats, users
from basketry.operators.lists import from_pages, from_rec_list, to_pages, to_rec_list
from basketry.plans import serving
from basketry.runtime import cut_lineage
from basketry.sources import files, retail

Query = Callable[[SparkSession, str], DataFrame]

TOP = 20
SEARCH = "widget|gear$"
_RATING_TIE = ("order_key", "line_number")


def _second(name: str) -> F.Column:
    return dates.second_label(F.col(name)).alias(name)


# --- statistics and serving --------------------------------------------------------------

def most_rated_products(spark: SparkSession, sf: str) -> DataFrame:
    counted = stats.product_stats(retail.rating(spark, sf))
    return serving.most_rated_products(counted, retail.product(spark, sf), None, TOP)


def hot_products(spark: SparkSession, sf: str) -> DataFrame:
    rating = retail.rating(spark, sf)
    return serving.hot_products(
        stats.rate_more_recently(rating), retail.product(spark, sf), stats.average_score(rating),
        TOP,
    )


def rate_more(spark: SparkSession, sf: str) -> DataFrame:
    return stats.rate_more(retail.rating(spark, sf))


def rate_more_recently(spark: SparkSession, sf: str) -> DataFrame:
    return stats.newest_first(stats.rate_more_recently(retail.rating(spark, sf)))


def change_date_sql(spark: SparkSession, sf: str) -> DataFrame:
    """The monthly statistic as SQL text over day strings, with the registered function."""
    dates.register_change_date(spark)
    day = F.date_format("ts", "yyyy-MM-dd").alias("day")
    retail.rating(spark, sf).select("product_id", day).createOrReplaceTempView("rating_days")
    return spark.sql(
        "SELECT product_id, count(product_id) AS count, changeDate(day) AS yearmonth "
        "FROM rating_days GROUP BY changeDate(day), product_id"
    )


def average_score(spark: SparkSession, sf: str) -> DataFrame:
    return stats.average_score(retail.rating(spark, sf))


def _event_products(spark: SparkSession, sf: str) -> DataFrame:
    return retail.behavior(spark, sf).select("product_id").distinct()


def product_info(spark: SparkSession, sf: str) -> DataFrame:
    return serving.product_info(
        retail.product(spark, sf), average_score(spark, sf), _event_products(spark, sf)
    )


def search_products(spark: SparkSession, sf: str) -> DataFrame:
    return serving.search_products(
        retail.product(spark, sf), average_score(spark, sf), SEARCH
    )


# --- item similarity ---------------------------------------------------------------------

def itemcf_pairs(spark: SparkSession, sf: str) -> DataFrame:
    return itemcf.itemcf_pairs(retail.rating(spark, sf))


def itemcf_topk(spark: SparkSession, sf: str) -> DataFrame:
    return itemcf.itemcf_nearest(retail.rating(spark, sf), TOP)


def itemcf_recs(spark: SparkSession, sf: str) -> DataFrame:
    """The list table, its ids as text; products without a partner keep an empty list."""
    rating = retail.rating(spark, sf)
    lists = itemcf.itemcf_recs(rating, itemcf.itemcf_nearest(rating, TOP), TOP)
    ids = F.transform("recs", lambda r: r["product_id"].cast("string"))
    return lists.select("product_id", F.array_join(ids, ",").alias("ids"))


def similar_by_itemcf(spark: SparkSession, sf: str) -> DataFrame:
    return serving.similar(
        itemcf_topk(spark, sf), _event_products(spark, sf), retail.product(spark, sf),
        average_score(spark, sf),
    )


def factor_similarity(spark: SparkSession, sf: str) -> DataFrame:
    return _six(dense.cosine_pairs(retail.vectors(spark, sf), 0.4))


def factor_topk(spark: SparkSession, sf: str) -> DataFrame:
    vectors = retail.vectors(spark, sf)
    return _six(dense.best_scores(vectors, vectors, 10, above=0.2, unit=True, skip_same=True))


def factor_user_topk(spark: SparkSession, sf: str) -> DataFrame:
    """The best products of each user from given factors whose scores are tiny: vectors of the
    even labels are the users, of the odd ones the products, all scaled by a thousandth."""
    rows = spark.read.parquet(f"{sf}/embeddings.parquet").select(
        F.col("vec_id").alias("id"), "label",
        F.transform("embedding", lambda x: x.cast("double") / 1000).alias("vector"))
    users, items = (rows.where(F.col("label") % 2 == k).drop("label") for k in (0, 1))
    return dense.best_scores(users, items, TOP, above=0.0).select(
        F.col("id").alias("user_id"), "rank", F.col("other_id").alias("product_id"),
        F.round(F.col("score") * 1e6, 6).alias("score"))


def factor_user_topk_bounds(spark: SparkSession, sf: str) -> DataFrame:
    """``factor_user_topk`` by norm bounds."""
    rows = spark.read.parquet(f"{sf}/embeddings.parquet").select(
        F.col("vec_id").alias("id"), "label",
        F.transform("embedding", lambda x: x.cast("double") / 1000).alias("vector"))
    users, items = (rows.where(F.col("label") % 2 == k).drop("label") for k in (0, 1))
    return dense.best_by_norm(users, items, TOP, above=0.0, block_rows=64).select(
        F.col("id").alias("user_id"), "rank", F.col("other_id").alias("product_id"),
        F.round(F.col("score") * 1e6, 6).alias("score"))


def factor_lsh_recall(spark: SparkSession, sf: str) -> DataFrame:
    """Hyperplane pairs against the exact ones: none that is not similar, 95 % of all."""
    vectors = retail.vectors(spark, sf)
    exact = dense.cosine_pairs(vectors, 0.4).select("a", "b", F.lit(1).alias("is_pair"))
    found = dense.cosine_pairs_lsh(vectors, 0.4).select("a", "b", F.lit(1).alias("is_found"))
    both = exact.join(found, ["a", "b"], "full").agg(
        F.count("is_pair").alias("pairs"), F.count("is_found").alias("found"),
        F.count(F.col("is_pair") + F.col("is_found")).alias("right"))
    return both.select(
        (F.col("right") == F.col("found")).alias("only_pairs"),
        (F.col("right") >= 0.95 * F.col("pairs")).alias("recall_reached"))


def _six(df: DataFrame) -> DataFrame:
    """Scores as shown: ranks and thresholds have used them unrounded."""
    return df.withColumn("score", F.round("score", 6))


def tfidf(spark: SparkSession, sf: str) -> DataFrame:
    return content.tfidf(retail.product(spark, sf)).withColumn("weight", F.round("weight", 6))


def _pair_rows(vectors: DataFrame) -> DataFrame:
    """Profile pairs with the number of products on each side."""
    a, b = (
        vectors.select(F.col("profile").alias(side), F.col("members").alias(copies))
        for side, copies in (("product_id", "copies"), ("other_id", "other_copies"))
    )
    pairs = content.profile_pairs(vectors).select(
        F.col("a").alias("product_id"), F.col("b").alias("other_id"), "score"
    )
    return _six(pairs.join(a, "product_id").join(b, "other_id"))


def content_similarity(spark: SparkSession, sf: str) -> DataFrame:
    return _pair_rows(content.content_vectors(retail.product(spark, sf)))


def content_similarity_hashed(spark: SparkSession, sf: str) -> DataFrame:
    return _pair_rows(content.unit_vectors(content.hashed_weights(retail.product(spark, sf)), 0.4))


def content_topk(spark: SparkSession, sf: str) -> DataFrame:
    return _six(content.content_topk(retail.product(spark, sf), TOP))


def movie_content_topk(spark: SparkSession, sf: str) -> DataFrame:
    """``content_topk`` of the products as rows of the media catalogue."""
    product = retail.product(spark, sf)
    given = {"mid": F.col("product_id").cast("string"), "name": F.col("name"), "tags": F.col("tags")}
    movies = product.select(*(
        given.get(c, F.lit(None).cast("string")).alias(c) for c in schemas.MOVIE_INFO_FIELDS))
    return _six(content.content_topk(files.movie_products(movies)[0], TOP))


def content_near(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    product = retail.product(spark, sf)
    vectors = content.content_vectors(product)
    near = content.profile_neighbours(content.profile_pairs(vectors), vectors)
    # Read several times by the callers; it stands for the stored similarity table.
    return content.profile_members(product, vectors), cut_lineage(near, "near")


def similar_by_content(spark: SparkSession, sf: str) -> DataFrame:
    members, near = content_near(spark, sf)
    return _six(serving.similar_by_content(
        _event_products(spark, sf), members, near, retail.product(spark, sf),
        average_score(spark, sf),
    ))


def similar_by_content_pages(spark: SparkSession, sf: str) -> DataFrame:
    """``similar_by_content`` from lists stored in pages of 25."""
    members, near = content_near(spark, sf)
    lists = content.content_neighbours(_event_products(spark, sf), members, near)
    pages = cut_lineage(to_pages(lists, "product_id", "other_id", "score", "rec_id", 25), "pages")
    flat = from_pages(pages, "product_id", "rec_id", 25).select(
        F.col("product_id").alias("asked_id"), "rank", F.col("rec_id").alias("product_id"), "score")
    return _six(serving.with_product(flat, retail.product(spark, sf), average_score(spark, sf)))


# --- matrix factorisation ----------------------------------------------------------------

def als_user_recs(spark: SparkSession, sf: str) -> DataFrame:
    rating = retail.rating(spark, sf)
    return als.user_recs(
        als.train_als(rating), rating.select("user_id"), retail.product(spark, sf), TOP
    )


def als_user_lists(spark: SparkSession, sf: str) -> DataFrame:
    """Every user's list: its length, and whether ranks and scores run down without a gap."""
    lists = als_user_recs(spark, sf).groupBy("user_id").agg(F.array_sort(F.collect_list(
        F.struct("rank", "score"))).alias("list"))
    falls = F.aggregate(
        "list", F.struct(F.lit(True).alias("ok"), F.lit(0).alias("rank"), F.lit(1e300).alias("score")),
        lambda a, x: F.struct(
            (a["ok"] & (x["rank"] == a["rank"] + 1) & (x["score"] <= a["score"])).alias("ok"),
            x["rank"].alias("rank"), x["score"].alias("score")))
    return lists.select(
        "user_id", F.size("list").cast("long").alias("n"), falls["ok"].alias("in_order"))


def als_solved(spark: SparkSession, sf: str) -> DataFrame:
    """Do each user's factors solve the least squares that training poses?"""
    rating, reg = retail.rating(spark, sf), 24.274
    found = als.residuals(als.train_als(rating, reg=reg), rating, reg)
    return found.select(
        F.col("user_id").cast("long").alias("user_id"), (F.col("residual") < 1e-3).alias("solved"))


def als_item_sim(spark: SparkSession, sf: str) -> DataFrame:
    return als.item_similarity(als.train_als(retail.rating(spark, sf)))


def als_item_topk(spark: SparkSession, sf: str) -> DataFrame:
    return als.item_topk(als.train_als(retail.rating(spark, sf)), TOP)


def als_grid(spark: SparkSession, sf: str) -> DataFrame:
    train, test = als.split_ratings(retail.rating(spark, sf))
    return als.als_grid(train, test)


def als_best_setting(spark: SparkSession, sf: str) -> DataFrame:
    return als.best_setting(als_grid(spark, sf))


def offline_recs(spark: SparkSession, sf: str) -> DataFrame:
    lists = to_rec_list(als_user_recs(spark, sf), "user_id", "product_id", "score", TOP)
    user = retail.user(spark, sf)
    return serving.recs_for(
        user.select("username"), user, lists, retail.product(spark, sf),
        average_score(spark, sf), n=10,
    )


# --- online recommendation ---------------------------------------------------------------

def rated_products(spark: SparkSession, sf: str) -> DataFrame:
    """What users rated, in the table or on the stream."""
    stored, arriving = retail.rating(spark, sf), retail.event_rating(spark, sf)
    return stored.select("user_id", "product_id").unionByName(
        arriving.select("user_id", "product_id")
    )


def flat_lists(lists: DataFrame) -> DataFrame:
    return from_rec_list(lists, "user_id")


def online_recs(spark: SparkSession, sf: str) -> DataFrame:
    arriving = retail.event_rating(spark, sf)
    members, near = content_near(spark, sf)
    rated = rated_products(spark, sf)
    return online.online_recs(
        online.newest_per_user(arriving, ("event_id",)),
        ratings.recent_ratings(arriving, 20, ("event_id",)),
        near, rated, members,
    )


def stream_list_served(spark: SparkSession, sf: str) -> DataFrame:
    lists = to_rec_list(online_recs(spark, sf), "user_id", "product_id", "score", TOP)
    user = retail.user(spark, sf)
    return serving.recs_for(
        user.select("username"), user, lists, retail.product(spark, sf), average_score(spark, sf)
    )


# --- events ------------------------------------------------------------------------------

def hot_window_counts(spark: SparkSession, sf: str) -> DataFrame:
    return events.hot_window_counts(retail.behavior(spark, sf)).withColumn(
        "window_end", _second("window_end")
    )


def hot_window_topn(spark: SparkSession, sf: str) -> DataFrame:
    counts = events.hot_window_counts(retail.behavior(spark, sf))
    return events.hot_window_topn(counts, 10).withColumn("window_end", _second("window_end"))


def hot_window_report(spark: SparkSession, sf: str) -> DataFrame:
    """The ranked text lines of each window."""
    counts = events.hot_window_counts(retail.behavior(spark, sf))
    best = events.hot_window_topn(counts, 10)
    return best.select(
        _second("window_end"), "rank",
        text.ranked_line(F.col("rank"), F.col("product_id"), F.col("count")).alias("line"),
    )


def _hours(counted: DataFrame) -> DataFrame:
    return counted.withColumns({
        "start": dates.hour_label(F.col("start")), "end": dates.hour_label(F.col("end")),
    })


def uv_hourly(spark: SparkSession, sf: str) -> DataFrame:
    return _hours(events.uv_hourly(retail.behavior(spark, sf), "exact", "view"))


def uv_bitmap(spark: SparkSession, sf: str) -> DataFrame:
    return _hours(events.uv_hourly(retail.behavior(spark, sf), "bitmap", "view"))


def uv_approx(spark: SparkSession, sf: str) -> DataFrame:
    return _hours(events.uv_hourly(retail.behavior(spark, sf), "approx", "view"))


def uv_approx_close(spark: SparkSession, sf: str) -> DataFrame:
    """Is the sketch within 15 % of the exact count, or within one visitor, hour by hour? Of a
    few visitors one may share its place in the sketch with another."""
    exact = uv_hourly(spark, sf).withColumnRenamed("count", "exact")
    return uv_approx(spark, sf).join(exact, ["start", "end"]).select(
        "start", "end", (F.abs(F.col("count") - F.col("exact")) <= F.greatest(
            F.lit(1.0), 0.15 * F.col("exact"))).alias("close"))


def sketches_close(sketches: DataFrame, behavior: DataFrame) -> DataFrame:
    """``start, close``: is each day's count from hourly ``sketches`` within 3 % of the exact one,
    or within one visitor?"""
    exact = events.visits(behavior, "view").groupBy(F.date_trunc("day", "ts").alias("start")).agg(
        F.count_distinct("user_id").alias("exact"))
    found = events.uv_of_sketches(sketches, "day").join(exact, "start", "full")
    near = F.abs(F.col("count") - F.col("exact")) <= F.greatest(F.lit(1.0), 0.03 * F.col("exact"))
    return found.select(
        dates.hour_label(F.col("start")).alias("start"), F.coalesce(near, F.lit(False)).alias("close"))


def uv_sketch_days(spark: SparkSession, sf: str) -> DataFrame:
    """Days from sketches per hour that were written and read back, without the events."""
    behavior = retail.behavior(spark, sf)
    return sketches_close(cut_lineage(events.uv_sketches(behavior, "view"), "sketches"), behavior)


def uv_running(spark: SparkSession, sf: str) -> DataFrame:
    running = events.uv_running(retail.behavior(spark, sf), event_type="view")
    return _hours(running).select("start", "end", "user_id", "event_id", "count")


def _alerts(spark: SparkSession, sf: str, within: str) -> DataFrame:
    return events.login_alerts(retail.login_event(spark, sf), within)


def login_alerts_2m(spark: SparkSession, sf: str) -> DataFrame:
    return _alerts(spark, sf, "2 minutes").drop("ts")


def login_alerts_24h(spark: SparkSession, sf: str) -> DataFrame:
    return _alerts(spark, sf, "24 hours").drop("ts")


def lockout_until(spark: SparkSession, sf: str) -> DataFrame:
    lockouts = events.lockout_until(_alerts(spark, sf, "24 hours"))
    return lockouts.select("user_id", _second("no_login_until"))


def user_lockouts(spark: SparkSession, sf: str) -> DataFrame:
    lockouts = events.lockout_until(_alerts(spark, sf, "24 hours"))
    return events.apply_lockouts(retail.user(spark, sf), lockouts).select(
        "user_id", "username", _second("no_login_until")
    )


# --- ratings and users -------------------------------------------------------------------

def recent_ratings(spark: SparkSession, sf: str) -> DataFrame:
    return ratings.recent_ratings(retail.rating(spark, sf), 20, _RATING_TIE).withColumn(
        "ts", _second("ts")
    )


def rating_upsert(spark: SparkSession, sf: str) -> DataFrame:
    old = retail.rating(spark, sf).select("user_id", "product_id", "score", "ts")
    new = retail.event_rating(spark, sf).select("user_id", "product_id", "score", "ts")
    return ratings.upsert_ratings(old, new).withColumn("ts", _second("ts"))


def _requests(spark: SparkSession, sf: str) -> DataFrame:
    """Purchases as page requests: a username and a star count times two."""
    return retail.event_rating(spark, sf).select(
        F.concat(
            F.lit("Customer#"), F.lpad(F.col("user_id").cast("string"), 9, "0")
        ).alias("username"),
        "product_id", (F.col("score") * 2).alias("score"), "ts",
    )


def submit_ratings(spark: SparkSession, sf: str) -> DataFrame:
    old = retail.rating(spark, sf).select("user_id", "product_id", "score", "ts")
    _, lines = ratings.submit_ratings(_requests(spark, sf), retail.user(spark, sf), old)
    return lines


def _log_lines(spark: SparkSession, sf: str) -> DataFrame:
    """Every event as an application log line; purchases carry a rating."""
    event = retail.load(spark, sf, "events")
    rating = retail.event_rating_of(event).select(
        F.concat(F.lit("INFO  ratings : "), text.rating_log_line(
            F.col("user_id"), F.col("product_id"), F.col("score"), F.col("ts")
        )).alias("value")
    )
    other = event.where(F.col("event_type") != "purchase").select(
        F.concat(F.lit("INFO  "), "event_type", F.lit(" : "), "props").alias("value")
    )
    return rating.unionByName(other)


def ratings_from_log(spark: SparkSession, sf: str) -> DataFrame:
    parsed, _ = files.ratings_from_log(_log_lines(spark, sf))
    return parsed.withColumn("ts", _second("ts"))


def rating_rejects(spark: SparkSession, sf: str) -> DataFrame:
    """Events written as rating lines; only purchases have a number for a score."""
    event = retail.behavior(spark, sf)
    lines = event.select(F.concat_ws(
        "|", F.col("user_id").cast("string"), F.col("product_id").cast("string"),
        F.when(F.col("event_type") == "purchase", "3").otherwise(F.col("event_type")),
        F.unix_seconds("ts").cast("string"),
    ).alias("value"))
    return files.parse_rating(lines)[1]


def username_id(spark: SparkSession, sf: str) -> DataFrame:
    return retail.user(spark, sf).select(
        "username", hashing.username_id(F.col("username")).cast("long").alias("hashed_id")
    )


def register_users(spark: SparkSession, sf: str) -> DataFrame:
    taken = F.concat(F.lit("Customer#"), F.lpad(F.col("user_id").cast("string"), 9, "0"))
    fresh = F.concat(
        F.lit("visitor-"), F.col("user_id").cast("string"), F.lit("-"),
        F.col("product_id").cast("string"),
    )
    requests = retail.behavior(spark, sf).where(F.col("event_type") == "signup").select(
        F.when(F.col("product_id") < 50, taken).otherwise(fresh).alias("username"), "ts"
    )
    return users.register_users(requests, retail.user(spark, sf)).select(
        F.col("user_id").cast("long").alias("user_id"), "username", _second("ts")
    )


def update_user_prefs(spark: SparkSession, sf: str) -> DataFrame:
    updates = retail.behavior(spark, sf).groupBy(F.col("user_id").cast("int").alias("user_id")).agg(
        F.lit(False).alias("first"),
        F.array_sort(F.collect_set("event_type")).alias("pref_genres"),
    )
    return users.update_user_prefs(retail.user(spark, sf), updates).select(
        "user_id", "username", "first", F.array_join("pref_genres", ",").alias("genres")
    )


BATCH: dict[str, Query] = {
    q.__name__: q
    for q in (
        most_rated_products, hot_products, rate_more, rate_more_recently, change_date_sql,
        average_score, product_info, search_products, itemcf_pairs, itemcf_topk,
        itemcf_recs,
        similar_by_itemcf, factor_similarity, factor_topk, factor_user_topk, factor_user_topk_bounds,
        factor_lsh_recall, tfidf, content_similarity,
        content_similarity_hashed, content_topk, movie_content_topk, similar_by_content, similar_by_content_pages, als_user_recs,
        als_user_lists, als_solved, als_item_sim, als_item_topk, als_grid, als_best_setting, offline_recs, online_recs,
        stream_list_served, hot_window_counts, hot_window_topn, hot_window_report, uv_hourly,
        uv_bitmap, uv_approx, uv_approx_close, uv_sketch_days, uv_running, login_alerts_2m, login_alerts_24h, lockout_until,
        user_lockouts, recent_ratings, rating_upsert, submit_ratings, ratings_from_log,
        rating_rejects, username_id, register_users, update_user_prefs,
    )
}
