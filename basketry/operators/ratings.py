"""Rating table operators: latest ratings, upserts, submitted ratings."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketry.functions.checks import half_score
from basketry.functions.text import rating_log_line
from basketry.functions.values import RATING_PREFIX
from basketry.operators.lists import top_k


def recent_ratings(rating: DataFrame, n: int = 20, tie: Sequence[str] = ()) -> DataFrame:
    """``user_id, rank, product_id, score, ts``: the last ``n`` ratings per user."""
    order = [F.desc(c) for c in ("ts", *tie, "product_id", "score")]
    return top_k(rating, "user_id", order, n).select(
        "user_id", "rank", "product_id", "score", "ts"
    )


def upsert_ratings(rating: DataFrame, new: DataFrame) -> DataFrame:
    """Insert or update by (user, product). An update changes the score and keeps the time;
    of several new ratings of a pair the last gives the score, the first the time."""
    folded = new.groupBy("user_id", "product_id").agg(
        F.max_by("score", F.struct("ts", "score")).alias("new_score"),
        F.min("ts").alias("new_ts"),
    )
    return rating.join(folded, ["user_id", "product_id"], "full_outer").select(
        "user_id", "product_id",
        F.coalesce("new_score", "score").alias("score"),
        F.coalesce("ts", "new_ts").alias("ts"),
    )


def identified(requests: DataFrame, user: DataFrame) -> DataFrame:
    """``username, product_id, score, ts`` requests as ratings; page scores are halved."""
    ids = user.select("username", F.col("user_id").cast("long").alias("user_id"))
    return requests.join(ids, "username").select(
        "user_id", "product_id", half_score(F.col("score")).alias("score"), "ts"
    )


def log_lines(new: DataFrame, prefix: str = RATING_PREFIX) -> DataFrame:
    """``value``: the log line of each rating."""
    return new.select(rating_log_line(
        F.col("user_id"), F.col("product_id"), F.col("score"), F.col("ts"), prefix
    ).alias("value"))


def submit_ratings(
    requests: DataFrame, user: DataFrame, rating: DataFrame, prefix: str = RATING_PREFIX
) -> tuple[DataFrame, DataFrame]:
    """(rating table after the requests, their log lines as ``value``)."""
    new = identified(requests, user)
    return upsert_ratings(rating, new), log_lines(new, prefix)
