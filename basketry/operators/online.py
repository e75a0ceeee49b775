"""Refresh a user's list from the rating just given.

Candidates are the products most similar to the one just rated, without those the user has
rated. Each is scored against the user's recent ratings. Everything is set-wise over all users
of a batch; no row is looked up on its own.

Similarities come either flat (``product_id, other_id, score``) or between profiles, with
``members`` saying which profile each product belongs to (see ``operators.content``). They, and
the rated products, are tables or functions from keys (one column) to rows that hold all of these
keys' rows, so that a store with buckets is read where the batch needs it.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from basketry.operators.lists import top_k
from basketry.runtime import cut_lineage, small_side

Lookup = DataFrame | Callable[[DataFrame], DataFrame]


def rows_of(table: Lookup, keys: DataFrame) -> DataFrame:
    """Rows of ``table`` that hold all rows of ``keys``."""
    return table(keys) if callable(table) else table


def newest_per_user(ratings: DataFrame, tie: Sequence[str] = ()) -> DataFrame:
    """``user_id, product_id`` of each user's last rating; the last write wins."""
    order = F.struct("ts", *tie, "product_id")
    return ratings.groupBy("user_id").agg(F.max_by("product_id", order).alias("product_id"))


def _profile_of(df: DataFrame, column: str, out: str, members: DataFrame | None) -> DataFrame:
    if members is None:
        return df.withColumn(out, F.col(column))
    named = members.select(F.col("product_id").alias(column), F.col("profile").alias(out))
    return df.join(named, column)


def _near(sims: DataFrame, members: DataFrame | None) -> DataFrame:
    if members is not None:
        return sims.select("profile", "other", "score")
    return sims.select(
        F.col("product_id").alias("profile"), F.col("other_id").alias("other"), "score"
    )


def _reached(asked: DataFrame, named: DataFrame) -> DataFrame:
    """Rows of ``asked`` (``profile, other, score, depth``) whose members (``named``: ``other,
    candidate``) can be among the first ``depth`` of their profile's list.

    What scores higher comes before with all its members; of what scores the same, a profile
    comes after the smallest member of each one whose smallest member is smaller.
    """
    sizes = named.groupBy("other").agg(
        F.count(F.lit(1)).alias("n"), F.count("candidate").alias("known"),
        F.min("candidate").alias("least"),
    # A missing id sorts first.
    ).select("other", "n", F.when(F.col("known") == F.col("n"), F.col("least")).alias("least"))
    best = Window.partitionBy("profile").orderBy(F.desc("score"))
    higher = best.rangeBetween(Window.unboundedPreceding, Window.currentRow)
    equal = Window.partitionBy("profile", "score")
    placed = asked.join(sizes, "other").withColumns({
        "before": F.sum("n").over(higher) - F.sum("n").over(equal),
        "place": F.row_number().over(equal.orderBy(F.asc("least"))),
    })
    return placed.where(F.col("before") + F.col("place") <= F.col("depth")).drop(
        "n", "least", "before", "place")


def candidates(
    current: DataFrame,
    sims: Lookup,
    rated: Lookup,
    members: DataFrame | None,
    k: int,
    exclude_rated: bool,
    users: int,
) -> DataFrame:
    """``user_id, candidate, candidate_profile``: at most ``k`` per user.

    ``users`` is the number of rows of ``current``. A micro-batch has few, so the large tables
    are filtered where they lie instead of being shuffled.
    """
    now = _profile_of(current, "product_id", "profile", members)
    asking = current.select("user_id")
    own = rows_of(rated, asking).select("user_id", "product_id").join(
        small_side(asking, users), "user_id", "left_semi"
    ).distinct()
    # A user's rated products can push at most that many entries out of a list, plus the
    # product itself. A list is read as deep as the users who ask for it need.
    reach = F.lit(k + 1)
    if exclude_rated:
        known = own.groupBy("user_id").agg(F.count(F.lit(1)).alias("known"))
        now = now.join(known, "user_id", "left")
        reach = reach + F.coalesce("known", F.lit(0))
    now = now.withColumn("reach", reach)
    depth = now.groupBy("profile").agg(F.max("reach").alias("depth"))

    wanted = now.select("profile").distinct()
    asked = _near(rows_of(sims, wanted), members).join(small_side(depth, users), "profile")
    if members is None:
        listed = asked.withColumn("candidate", F.col("other"))
    else:
        # Of each similar profile, as many members as the deepest list that needs them.
        named = members.select(F.col("profile").alias("other"), F.col("product_id").alias("candidate"))
        asked = _reached(asked, named)
        deepest = asked.groupBy("other").agg(F.max("depth").alias("most"))
        among = Window.partitionBy("other").orderBy(F.asc("candidate"))
        leading = named.join(deepest, "other").withColumn("place", F.row_number().over(among)).where(
            F.col("place") <= F.col("most")).select("other", "candidate")
        listed = asked.join(leading, "other")
    order = Window.partitionBy("profile").orderBy(F.desc("score"), F.asc("candidate"))
    listed = listed.withColumn("rank", F.row_number().over(order)).where(
        F.col("rank") <= F.col("depth"))

    found = now.join(listed.drop("depth"), "profile").where(
        (F.col("rank") <= F.col("reach")) & (F.col("candidate") != F.col("product_id"))
    ).select("user_id", "candidate", F.col("other").alias("candidate_profile"), "score")
    if exclude_rated:
        found = found.join(
            own.withColumnRenamed("product_id", "candidate"), ["user_id", "candidate"], "left_anti"
        )
    return top_k(found, "user_id", [F.desc("score"), F.asc("candidate")], k).drop("rank", "score")


def online_recs(
    current: DataFrame,
    recent: DataFrame,
    sims: Lookup,
    rated: Lookup,
    members: DataFrame | None = None,
    n: int = 20,
    k: int = 20,
    min_sim: float = 0.2,
    like_over: float = 2.0,
    exclude_rated: bool = True,
    digits: int = 10,
) -> DataFrame:
    """``user_id, rank, product_id, score`` for the users of ``current``.

    ``current`` holds one ``user_id, product_id`` per user, ``recent`` ranked recent ratings
    (the first ``n`` count). The score is the mean of similarity x rating over the recent
    ratings more similar than ``min_sim``, plus log10 of the number of liked ones among them,
    minus log10 of the number of others. A candidate without such a rating is left out.
    The mean is summed in decimals, so it does not depend on the order of the rows.
    """
    users = current.count()
    chosen = candidates(current, sims, rated, members, k, exclude_rated, users)
    if callable(sims):
        # The keys of the second look-up come from the first.
        chosen = cut_lineage(chosen, "candidates")
    near = _near(rows_of(sims, chosen.select("candidate_profile").distinct()), members)
    history = _profile_of(
        recent.where(F.col("rank") <= n).select(
            "user_id", F.col("product_id").alias("rated"), F.col("score").alias("rating")
        ),
        "rated", "rated_profile", members,
    )
    lookup = near.select(
        F.col("profile").alias("candidate_profile"), F.col("other").alias("rated_profile"),
        F.col("score").alias("sim"),
    ).where(F.col("sim") > min_sim).join(
        small_side(chosen.select("candidate_profile").distinct(), users * k),
        "candidate_profile", "left_semi",
    )
    terms = (
        chosen.join(history, "user_id").where(F.col("candidate") != F.col("rated"))
        .join(lookup, ["candidate_profile", "rated_profile"])
    )
    one = F.lit(1).cast("long")
    liked = F.count_if(F.col("rating") > like_over)
    other = F.count_if(F.col("rating") <= like_over)
    weighted = F.round(F.col("sim") * F.col("rating"), 8).cast("decimal(28,8)")
    scored = terms.groupBy("user_id", F.col("candidate").alias("product_id")).agg(
        F.round(
            F.sum(weighted).cast("double") / F.count(F.lit(1))
            + F.log10(F.greatest(liked, one)) - F.log10(F.greatest(other, one)),
            digits,
        ).alias("score")
    )
    ranked = top_k(scored, "user_id", [F.desc("score"), F.asc("product_id")], k)
    return ranked.select("user_id", "rank", "product_id", "score")
