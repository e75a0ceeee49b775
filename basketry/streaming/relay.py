"""Pass rating events from an application log on to the rating stream."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from basketry.functions.text import extract_rating_payload
from basketry.functions.values import RATING_PREFIX, RELAY_KEY
from basketry.sources.streams import start, to_kafka


def relay_ratings(lines: DataFrame, prefix: str = RATING_PREFIX) -> DataFrame:
    """``key, value`` messages for the log lines that carry a rating."""
    return lines.select(
        F.lit(RELAY_KEY).alias("key"),
        extract_rating_payload(F.col("value"), prefix).alias("value"),
    ).where(F.col("value").isNotNull())


def start_relay_to_kafka(
    lines: DataFrame, checkpoint: str, servers: str, topic: str = "recommender"
) -> StreamingQuery:
    return to_kafka(relay_ratings(lines), checkpoint, topic, servers)


def start_relay_to_files(
    lines: DataFrame, path: str, checkpoint: str, every: str | None = "3 seconds"
) -> StreamingQuery:
    """Relay into a folder of text files, for which no broker is needed."""
    return start(
        relay_ratings(lines).select("value"), checkpoint, sink="text", every=every, path=path
    )
