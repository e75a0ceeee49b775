"""The retail and event test tables, read as the canonical tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from basketry.functions.dates import as_timestamp


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def rating(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One rating per order line: the customer scores the part 1-5 by quantity."""
    lines = load(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", F.col("l_partkey").alias("product_id"),
        F.ceil(F.col("l_quantity") / 10).cast("double").alias("score"),
    )
    orders = load(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("l_orderkey"), F.col("o_custkey").alias("user_id"),
        as_timestamp(F.col("o_orderdate")).alias("ts"),
    )
    return lines.join(orders, "l_orderkey").select(
        "user_id", "product_id", "score", "ts",
        F.col("l_orderkey").alias("order_key"), F.col("l_linenumber").alias("line_number"),
    )


def product(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = load(spark, sf_dir, "part")
    return part.select(
        F.col("p_partkey").alias("product_id"),
        F.col("p_name").alias("name"),
        F.lit("").alias("image_url"),
        F.col("p_type").alias("categories"),
        F.concat_ws("|", F.translate("p_name", " ", "|"), "p_brand", "p_type").alias("tags"),
    )


def behavior(spark: SparkSession, sf_dir: str) -> DataFrame:
    return behavior_of(load(spark, sf_dir, "events"))


def behavior_of(events: DataFrame) -> DataFrame:
    """Events as behaviour rows; also works on a stream of events."""
    return events.select(
        "event_id", "user_id",
        F.get_json_object("props", "$.k").cast("long").alias("product_id"),
        F.lit("").alias("category"), "event_type", as_timestamp(F.col("ts")).alias("ts"),
    )


def event_rating(spark: SparkSession, sf_dir: str) -> DataFrame:
    return event_rating_of(load(spark, sf_dir, "events"))


def event_rating_of(events: DataFrame) -> DataFrame:
    """Purchases as ratings that arrive on a stream."""
    return events.where(F.col("event_type") == "purchase").select(
        "event_id", "user_id",
        F.get_json_object("props", "$.k").cast("long").alias("product_id"),
        F.least(F.lit(5.0), 1 + F.floor(F.col("value") / 20).cast("double")).alias("score"),
        as_timestamp(F.col("ts")).alias("ts"),
    )


def login_event(spark: SparkSession, sf_dir: str) -> DataFrame:
    return login_event_of(load(spark, sf_dir, "events"))


def login_event_of(events: DataFrame) -> DataFrame:
    """An error event plays a failed login, any other event a success."""
    return events.select(
        "event_id", "user_id", F.lit("").alias("ip"),
        F.when(F.col("event_type") == "error", "fail").otherwise("success").alias("event_type"),
        as_timestamp(F.col("ts")).alias("ts"),
    )


def user(spark: SparkSession, sf_dir: str) -> DataFrame:
    return load(spark, sf_dir, "customer").select(
        F.col("c_custkey").cast("int").alias("user_id"),
        F.col("c_name").alias("username"),
        F.lit(True).alias("first"),
        F.lit(None).cast("timestamp").alias("ts"),
        F.array(F.col("c_mktsegment")).alias("pref_genres"),
        F.lit(None).cast("timestamp").alias("no_login_until"),
    )


def vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Embeddings play item factors."""
    return load(spark, sf_dir, "embeddings").select(
        F.col("vec_id").alias("id"), F.col("embedding").alias("vector")
    )
