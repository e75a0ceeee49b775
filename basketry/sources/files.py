"""Text inputs: products, ratings, behaviour events, login events, logs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from basketry.functions import checks, dates, text
from basketry.functions.values import RATING_PREFIX

# The caret file's seven fields, in order; the third and fourth are not kept.
_PRODUCT_FIELDS = ("product_id", "name", "category_ids", "vendor", "image_url", "categories", "tags")


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """Text file(s) as one ``value`` column."""
    return spark.read.text(path)


def _product_rows(spark: SparkSession, path: str) -> DataFrame:
    schema = T.StructType([T.StructField(n, T.StringType()) for n in _PRODUCT_FIELDS])
    # An empty quote switches quoting off: names hold inch marks.
    raw = spark.read.csv(path, sep="^", quote="", schema=schema)
    return raw.select(
        F.col("product_id").alias("raw_id"),
        checks.try_long(F.trim("product_id")).alias("product_id"),
        *[F.trim(c).alias(c) for c in ("name", "image_url", "categories")],
        F.coalesce(F.trim("tags"), F.lit("")).alias("tags"),
    )


def _product_ok() -> F.Column:
    return (
        F.col("product_id").isNotNull()
        & F.col("image_url").isNotNull()
        & F.col("categories").isNotNull()
    )


def read_products(spark: SparkSession, path: str) -> DataFrame:
    """Caret-separated product file."""
    return _product_rows(spark, path).where(_product_ok()).drop("raw_id")


def read_product_rejects(spark: SparkSession, path: str) -> DataFrame:
    """Product lines without a numeric id or with too few fields."""
    return _product_rows(spark, path).where(~_product_ok()).drop("product_id")


def movie_products(movie: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The media catalogue (``movie_info``, all strings) -> (products, rows without a numeric id
    or a name)."""
    rows = movie.withColumn("_id", checks.try_long(F.trim("mid")))
    ok = F.col("_id").isNotNull() & F.col("name").isNotNull()
    good = rows.where(ok).select(
        F.col("_id").alias("product_id"), F.trim("name").alias("name"),
        F.trim("imgUrl").alias("image_url"), F.trim("categories").alias("categories"),
        F.coalesce(F.trim("tags"), F.lit("")).alias("tags"),
    )
    return good, rows.where(~ok).drop("_id")


def read_ratings(spark: SparkSession, path: str, unit: str = "s") -> DataFrame:
    """Comma-separated ratings: user, product, score, epoch. Bad lines are left out;
    ``parse_rating(read_lines(...), sep=",")`` returns them as rejects."""
    return parse_rating(read_lines(spark, path), sep=",", unit=unit)[0]


def _split_ok(rows: DataFrame, columns: list[str]) -> tuple[DataFrame, DataFrame]:
    complete = F.lit(True)
    for name in columns:
        complete = complete & F.col(name).isNotNull()
    return rows.where(complete).drop("value"), rows.where(~complete).select("value")


def parse_rating(
    lines: DataFrame, sep: str = "|", unit: str = "s"
) -> tuple[DataFrame, DataFrame]:
    """``user|product|score|epoch`` lines -> (ratings, rejected lines). Columns besides ``value``
    stay with the parsed rows, here and below."""
    value = F.col("value")
    rows = lines.select(
        "*",
        checks.try_long(text.field(value, sep, 0)).alias("user_id"),
        checks.try_long(text.field(value, sep, 1)).alias("product_id"),
        checks.try_double(text.field(value, sep, 2)).alias("score"),
        dates.epoch_to_timestamp(checks.try_long(text.field(value, sep, 3)), unit).alias("ts"),
    )
    return _split_ok(rows, ["user_id", "product_id", "score", "ts"])


def parse_login(lines: DataFrame, sep: str = "|", unit: str = "ms") -> tuple[DataFrame, DataFrame]:
    """``user|ip|event type|epoch`` lines -> (login events, rejected lines)."""
    value = F.col("value")
    rows = lines.select(
        "*",
        checks.try_long(text.field(value, sep, 0)).alias("user_id"),
        text.field(value, sep, 1).alias("ip"),
        text.field(value, sep, 2).alias("event_type"),
        dates.epoch_to_timestamp(checks.try_long(text.field(value, sep, 3)), unit).alias("ts"),
    )
    return _split_ok(rows, ["user_id", "event_type", "ts"])


def parse_behavior(
    lines: DataFrame, sep: str = ",", unit: str = "ms"
) -> tuple[DataFrame, DataFrame]:
    """``user,product,category,event type,epoch`` lines -> (behaviour, rejected lines)."""
    value = F.col("value")
    rows = lines.select(
        "*",
        checks.try_long(text.field(value, sep, 0)).alias("user_id"),
        checks.try_long(text.field(value, sep, 1)).alias("product_id"),
        text.field(value, sep, 2).alias("category"),
        text.field(value, sep, 3).alias("event_type"),
        dates.epoch_to_timestamp(checks.try_long(text.field(value, sep, 4)), unit).alias("ts"),
    )
    return _split_ok(rows, ["user_id", "product_id", "event_type", "ts"])


def ratings_from_log(
    lines: DataFrame, prefix: str = RATING_PREFIX
) -> tuple[DataFrame, DataFrame]:
    """Rating events inside application log lines -> (ratings, rejected payloads)."""
    payload = lines.select(text.extract_rating_payload(F.col("value"), prefix).alias("value"))
    return parse_rating(payload.where(F.col("value").isNotNull()))
