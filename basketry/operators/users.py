"""User table operators."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketry.functions.hashing import username_id


def register_users(new: DataFrame, user: DataFrame) -> DataFrame:
    """Rows to append for ``username, ts`` requests: names not taken yet, the earliest request
    of each."""
    earliest = new.groupBy("username").agg(F.min("ts").alias("ts"))
    free = earliest.join(user.select("username"), "username", "left_anti")
    return free.select(
        username_id(F.col("username")).alias("user_id"), "username",
        F.lit(True).alias("first"), "ts",
        F.array().cast("array<string>").alias("pref_genres"),
        F.lit(None).cast("timestamp").alias("no_login_until"),
    )


def update_user_prefs(user: DataFrame, updates: DataFrame) -> DataFrame:
    """Set ``first`` and ``pref_genres`` of the users named in ``updates`` (one row each)."""
    new = updates.select(
        "user_id", F.col("first").alias("new_first"), F.col("pref_genres").alias("new_genres")
    )
    return (
        user.join(new, "user_id", "left")
        .withColumn("first", F.coalesce("new_first", "first"))
        .withColumn("pref_genres", F.coalesce("new_genres", "pref_genres"))
        .select(*user.columns)
    )
