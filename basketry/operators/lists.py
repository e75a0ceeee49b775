"""Ranking within a key and recommendation lists."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def top_k(df: DataFrame, key: str | Sequence[str], order: Sequence[Column], k: int) -> DataFrame:
    """First ``k`` rows per key with their ``rank``.

    The bound on ``row_number`` lets Spark cut every map task's rows to ``k`` per key
    before the shuffle, so a key that holds much of the data stays cheap.
    """
    keys = [key] if isinstance(key, str) else list(key)
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("rank", rank).where(F.col("rank") <= k)


def to_rec_list(
    flat: DataFrame, key: str, item: str, score: str, k: int | None, item_name: str = "product_id"
) -> DataFrame:
    """``key, recs`` with the ``k`` best (item, score) pairs, best first; ``None``: all."""
    order = [F.desc(score), F.asc(item)]
    if k is None:
        best = flat.withColumn("rank", F.row_number().over(Window.partitionBy(key).orderBy(*order)))
    else:
        best = top_k(flat, key, order, k)
    pair = F.struct(
        F.col("rank"), F.col(item).alias(item_name), F.col(score).cast("double").alias("score")
    )
    listed = best.groupBy(key).agg(F.array_sort(F.collect_list(pair)).alias("ranked"))
    return listed.select(
        key,
        F.transform(
            "ranked", lambda r: F.struct(r[item_name].alias(item_name), r["score"].alias("score"))
        ).alias("recs"),
    )


def from_rec_list(recs: DataFrame, key: str, item_name: str = "product_id") -> DataFrame:
    """Flat ``key, rank, item, score`` rows of a recommendation-list table."""
    rows = recs.select(key, F.posexplode("recs").alias("pos", "rec"))
    return rows.select(
        key, (F.col("pos") + 1).alias("rank"), F.col(f"rec.{item_name}").alias(item_name),
        F.col("rec.score").alias("score"),
    )


#: Entries of a page of a list.
PAGE = 1000


def to_pages(
    flat: DataFrame, key: str, item: str, score: str, item_name: str = "product_id", size: int = PAGE
) -> DataFrame:
    """``key, page, recs``: whole lists, best first, in rows of ``size`` entries (from page 0), so
    that no row holds a whole list."""
    order = Window.partitionBy(key).orderBy(F.desc(score), F.asc(item))
    ranked = flat.withColumn("rank", F.row_number().over(order))
    entry = F.struct("rank", F.col(item).alias(item_name), F.col(score).cast("double").alias("score"))
    paged = ranked.groupBy(key, F.floor((F.col("rank") - 1) / size).cast("int").alias("page")).agg(
        F.array_sort(F.collect_list(entry)).alias("ranked"))
    return paged.select(key, "page", F.transform("ranked", lambda r: F.struct(
        r[item_name].alias(item_name), r["score"].alias("score"))).alias("recs"))


def from_pages(
    pages: DataFrame, key: str, item_name: str = "product_id", size: int = PAGE
) -> DataFrame:
    """Flat ``key, rank, item, score`` rows of a table of pages."""
    rows = pages.select(key, "page", F.posexplode("recs").alias("pos", "rec"))
    return rows.select(
        key, (F.col("page") * size + F.col("pos") + 1).alias("rank"),
        F.col(f"rec.{item_name}").alias(item_name), F.col("rec.score").alias("score"))
