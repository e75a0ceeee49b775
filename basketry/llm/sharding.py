"""Operator 2: documents to shards of equal row counts, linked documents together. DataFrame
functions only.

Documents are linked by equal text and by shared lines (the smallest hashes of a text's lines,
so near copies share some). Equal texts form a unit; a text with more rows than half a shard is
cut into units of at most that. Units start on hashed shards. In each round of label propagation
a link key counts its units per shard, and a unit wants the shard where most of what it shares
keys with lies. Wishes are granted under quotas: between two shards as much moves one way as the
other, plus the room that is left, those with the largest gain first, by a histogram of gains.
No step lists the units of a key, so a key may have any number of them.

At last the counts are made equal exactly: the rows of a shard are numbered, linked ones first,
and what is beyond its quota fills the shards that have too few. Row counts differ by one at
most; a row's number is its slot.

Null text has size 1 and equals the empty text. Texts without lines have no links but equal
text. A null doc_id is a row like others; repeated rows are rows. Only doc_id and text are read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from basketry.llm import texts
from basketry.llm.texts import write_step
from basketry.runtime import cut_lineage

SHARDS, ROUNDS, LINE_KEYS = 8, 6, 3
#: Rows numbered together at the end.
_BUCKET_ROWS = 20_000
#: Part of a quota that a shard may be over while units move.
_SLACK = 0.02


def _rows(docs: DataFrame) -> DataFrame:
    """``doc_id, size, text_crc32, text_key, keys``."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    hashes = F.transform(
        F.filter(F.split("text", "\n", -1), lambda line: F.length(line) > 0), lambda line: F.xxhash64(line))
    keys = F.array(*(
        F.array_min(F.transform("hashes", _seeded(seed))) for seed in range(LINE_KEYS)))
    return docs.select(F.col("doc_id").cast("long"), text.alias("text")).select(
        "doc_id", (F.octet_length("text") + 1).cast("long").alias("size"),
        F.crc32(F.col("text").cast("binary")).alias("text_crc32"),
        F.unhex(F.md5(F.col("text").cast("binary"))).alias("text_key"), hashes.alias("hashes"),
    ).withColumn("keys", F.array_compact(keys)).drop("hashes")


def _seeded(seed: int):
    return lambda h: F.xxhash64(h, F.lit(seed))


def _per_shard(column: Column, weight: Column) -> list[Column]:
    return [F.sum(F.when(column == s, weight).otherwise(0)).alias(f"s{s}") for s in range(SHARDS)]


def _links(units: DataFrame, rows: DataFrame) -> DataFrame:
    """``unit, key, weight`` for keys that two units share."""
    unit_keys = rows.groupBy("unit").agg(F.any_value("keys").alias("keys"),
                                         F.any_value("text_key").alias("text_key"))
    # All units of a text share its key, beside those of its lines.
    keys = F.concat("keys", F.array(F.xxhash64("text_key")))
    linked = unit_keys.select("unit", F.explode(F.array_distinct(keys)).alias("key"))
    shared = linked.groupBy("key").agg(F.count("*").alias("n")).where("n > 1").select("key")
    return linked.join(shared, "key").join(units.select("unit", "weight"), "unit")


def _wishes(units: DataFrame, links: DataFrame) -> DataFrame:
    """``unit, wish, gain`` of the units with a better shard."""
    placed = links.join(units.select("unit", "shard"), "unit")
    tally = placed.groupBy("key").agg(*_per_shard(F.col("shard"), F.col("weight")))
    tally = tally.withColumn("whole", sum(F.col(f"s{s}") for s in range(SHARDS)))
    # A key speaks with one vote, shared out over its other units.
    others = F.greatest(F.col("whole") - F.col("weight"), F.lit(1))
    votes = placed.join(tally, "key").groupBy("unit").agg(
        F.any_value("shard").alias("shard"), F.any_value("weight").alias("weight"), *(
            F.sum((F.col(f"s{s}") - F.when(F.col("shard") == s, F.col("weight")).otherwise(0))
                  / others).alias(f"v{s}") for s in range(SHARDS)))
    array = F.array(*(F.col(f"v{s}") for s in range(SHARDS)))
    best = F.array_max(array)
    mine = F.element_at(array, F.col("shard") + 1)
    return votes.select(
        "unit", "shard", "weight", (F.array_position(array, best) - 1).cast("int").alias("wish"),
        (best - mine).alias("gain")).where("gain > 1e-9")


def _granted(wishes: DataFrame, load: dict[int, int], quota: float, turn: int) -> DataFrame:
    """``unit, wish`` of the wishes that the quotas allow."""
    level = F.floor(F.least(F.col("gain"), F.lit(4.0)) * 16).cast("int")
    wishes = wishes.withColumn("level", level)
    # At most shards x shards x 65 rows.
    table = wishes.groupBy("shard", "wish", "level").agg(F.sum("weight").alias("w"))
    room = F.create_map(*(x for s in range(SHARDS) for x in (
        F.lit(s), F.lit(max(0.0, quota * (1 + _SLACK) - load.get(s, 0))))))
    ways = table.groupBy("shard", "wish").agg(F.sum("w").alias("flow"))
    back = ways.select(F.col("shard").alias("wish"), F.col("wish").alias("shard"),
                       F.col("flow").alias("back"))
    into = ways.groupBy("wish").agg(F.sum("flow").alias("into"))
    share = F.element_at(room, F.col("wish")) * F.col("flow") / F.col("into")
    limit = ways.join(back, ["shard", "wish"], "left").join(into, "wish").select(
        "shard", "wish",
        (F.least("flow", F.coalesce("back", F.lit(0))) + share).alias("limit"))
    before = Window.partitionBy("shard", "wish").orderBy(F.desc("level")).rowsBetween(
        Window.unboundedPreceding, -1)
    chance = ((F.col("limit") - F.coalesce(F.sum("w").over(before), F.lit(0))) / F.col("w"))
    chances = table.join(limit, ["shard", "wish"]).select(
        "shard", "wish", "level", chance.alias("chance")).where("chance > 0")
    draw = F.pmod(F.xxhash64("unit", F.lit(turn)), F.lit(1_000_003)) / 1_000_003
    return wishes.join(F.broadcast(chances), ["shard", "wish", "level"]).where(
        draw < F.col("chance")).select("unit", "wish")


def _numbered(rows: DataFrame, n_rows: int) -> DataFrame:
    """``position`` of each row in its shard, from 0: equal texts first, then other linked
    rows, then the rest; units together."""
    spread = max(16, n_rows // (SHARDS * _BUCKET_ROWS))
    # A unit with many rows fills buckets of its own.
    parts = F.ceil(F.col("weight") / _BUCKET_ROWS)
    rows = rows.withColumn("bucket", F.struct(
        F.col("alone"), F.pmod(F.xxhash64("unit"), F.lit(spread)).alias("unit"),
        F.when(parts > 1, F.xxhash64("unit")).otherwise(0).alias("own"),
        F.when(parts > 1, F.pmod(F.xxhash64("doc_id"), parts)).otherwise(0).alias("part")))
    totals = rows.groupBy("shard", "bucket").agg(F.count("*").alias("n"))
    before = Window.partitionBy("shard").orderBy("bucket").rowsBetween(
        Window.unboundedPreceding, -1)
    starts = totals.select("shard", "bucket", F.coalesce(
        F.sum("n").over(before), F.lit(0)).alias("start"))
    inside = Window.partitionBy("shard", "bucket").orderBy("unit", "doc_id")
    return rows.withColumn("number", F.row_number().over(inside)).join(
        starts, ["shard", "bucket"]).withColumn("position", F.col("start") + F.col("number") - 1)


def _case(values: dict[int, int], column: str) -> Column:
    return F.element_at(F.create_map(*(
        F.lit(x) for pair in sorted(values.items()) for x in pair)), F.col(column))


def _evened(rows: DataFrame, counts: dict[int, int]) -> DataFrame:
    """Final ``shard`` and ``slot``: rows beyond a shard's quota fill the others."""
    total = sum(counts.values())
    largest = sorted(range(SHARDS), key=lambda s: (-counts[s], s))
    quota = {s: total // SHARDS + (k < total % SHARDS) for k, s in enumerate(largest)}
    over, under, moved, filled = {}, [], 0, 0
    for s in range(SHARDS):
        over[s] = moved
        moved += max(0, counts[s] - quota[s])
        if counts[s] < quota[s]:
            under.append((s, filled, counts[s]))
            filled += quota[s] - counts[s]
    stays = F.col("position") < _case(quota, "shard")
    rank = _case(over, "shard") + F.col("position") - _case(quota, "shard")
    to, slot = F.lit(None).cast("int"), F.lit(None).cast("long")
    for s, first, taken in under:
        to = F.when(rank >= first, F.lit(s)).otherwise(to)
        slot = F.when(rank >= first, rank - first + taken).otherwise(slot)
    return rows.select(
        "doc_id", "size", "text_crc32",
        F.when(stays, F.col("shard")).otherwise(to).cast("int").alias("shard"),
        F.when(stays, F.col("position")).otherwise(slot).cast("long").alias("slot"))


def assign_shards(docs: DataFrame, rounds: int = ROUNDS) -> DataFrame:
    """``doc_id, size, text_crc32, shard, slot`` per row of ``docs``."""
    rows = write_step(_rows(docs), "shard-rows")
    n_rows = rows.count()
    most = max(1, n_rows // (2 * SHARDS))
    groups = rows.groupBy("text_key").agg(F.count("*").alias("n"))
    large = groups.where(F.col("n") > most)
    # At most 2 x shards texts have so many rows.
    parts = rows.join(F.broadcast(large), "text_key", "left")
    piece = F.when(F.col("n").isNull(), F.lit(0)).otherwise(
        F.pmod(F.xxhash64("doc_id"), F.ceil(F.col("n") / most)))
    rows = parts.withColumn("unit", F.xxhash64("text_key", piece)).drop("n")
    units = cut_lineage(rows.groupBy("unit").agg(F.count("*").alias("weight")).withColumn(
        "shard", F.pmod(F.xxhash64("unit", F.lit(0)), F.lit(SHARDS)).cast("int")), "units")
    links = cut_lineage(_links(units, rows), "unit-links")
    for turn in range(rounds):
        load = {r["shard"]: r["w"] for r in units.groupBy("shard").agg(
            F.sum("weight").alias("w")).collect()}
        moves = _granted(_wishes(units, links), load, n_rows / SHARDS, turn)
        units = cut_lineage(units.join(moves, "unit", "left").select(
            "unit", "weight", F.coalesce("wish", "shard").alias("shard")), "units")
    linked = links.select("unit").distinct().withColumn("linked", F.lit(1))
    # Rows that share nothing are the first to move, rows of equal text the last.
    placed = rows.drop("keys", "text_key").join(units, "unit").join(linked, "unit", "left") \
        .withColumn("alone", F.when(F.col("weight") > 1, 0).when(F.col("linked") == 1, 1).otherwise(2))
    counts = dict.fromkeys(range(SHARDS), 0) | {
        r["shard"]: r["w"] for r in units.groupBy("shard").agg(F.sum("weight").alias("w")).collect()}
    return _evened(_numbered(placed, n_rows), counts)


def op2_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in eight shards under the ``rows`` law."""
    return assign_shards(texts.documents(spark, sf_dir)).select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"))
