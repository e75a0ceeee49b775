"""Operator 12: what each quality filter does alone, and what it does after the others.

Every document gets a bit mask of the filters it fails. Documents are folded to cells (part, mask,
labels), and a recursive query walks all orders over the masks: each level appends an unused
filter to the prefixes of the level before, carries the bits already applied, and tells for each
mask whether this step removes it. Masks are as many as two to the number of filters at most, so
the walk has the same size over any corpus. Its rows meet the cells once.

A text that stands under a smaller doc_id too is a copy. Texts are compared by SHA-256, rows of
one text are folded to their smallest doc_id before they meet, so no task holds the copies of a
text. Null text is empty; a null part is the empty string. A null doc_id is neither smaller nor
larger than another, and has no labels; rows that repeat a doc_id are rows of their own but no
copies of each other. A document is good (toxic) if any of its labels says so. An empty table has
no parts, and so no rows. Only doc_id, text, and the part's column are read.
"""

from __future__ import annotations

from math import factorial

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from basketry.llm import texts
from basketry.llm.texts import write_step

#: Filters in the order of their bits; the last one compares documents with each other.
FILTERS = "ABCDE"
MIN_WORDS, DISTINCT_PERCENT, CAPITAL_PERCENT = 50, 65, 5
_BLANK = r"[\x20\x09-\x0D]+"


def own_bits(text: Column) -> Column:
    """Bits of the filters that look at one text: few words (A), few distinct words (B), many
    capitals (C), symbols (D)."""
    words = F.array_remove(F.split(text, _BLANK), "")
    capitals = F.length(text) - F.length(F.regexp_replace(text, "[A-Z]+", ""))
    fails = (
        F.size(words) < MIN_WORDS,
        100 * F.size(F.array_distinct(words)).cast("long") < DISTINCT_PERCENT * F.size(words).cast("long"),
        100 * capitals.cast("long") > CAPITAL_PERCENT * F.length(text).cast("long"),
        text.rlike("[#$%&*|]"),
    )
    bits = F.lit(0)
    for k, fail in enumerate(fails):
        bits = bits + F.when(fail, 1 << k).otherwise(0)
    return bits


def judged(docs: DataFrame, labels: DataFrame, part: str = "source") -> DataFrame:
    """``part, mask, good, toxic, n``: how many documents of each part fail which filters."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    doc_id = F.col("doc_id").cast("long")
    plain = docs.select(
        doc_id.alias("id"), F.coalesce(F.col(part).cast("string"), F.lit("")).alias("part"),
        own_bits(text).alias("own"), F.unhex(F.sha2(F.encode(text, "UTF-8"), 256)).alias("text_key"))
    rows = plain.groupBy("id", "part", "own", "text_key").agg(F.count("*").alias("n"))
    # Rows without an id have no labels; their text's key spreads them over the tasks.
    place = F.coalesce("id", F.xxhash64("text_key"))
    marks = labels.where("doc_id is not null").groupBy(F.col("doc_id").cast("long").alias("place")).agg(
        F.max(F.coalesce(F.col("quality") == 1, F.lit(False))).alias("good"),
        F.max(F.coalesce(F.col("toxic") == 1, F.lit(False))).alias("toxic")
    ).withColumn("named", F.lit(True))
    marked = rows.withColumn("place", place).withColumn("named", F.col("id").isNotNull()).join(
        marks, ["place", "named"], "left")
    marked = marked.select(
        "id", "part", "own", "text_key", "n", F.coalesce("good", F.lit(False)).alias("good"),
        F.coalesce("toxic", F.lit(False)).alias("toxic"))
    # Of each text: rows per kind, and how many of them have the smallest id of the kind.
    kinds = marked.groupBy("text_key", "own", "part", "good", "toxic").agg(
        F.sum("n").alias("n"),
        F.min("id").alias("least"),
        F.coalesce(F.sum(F.when(F.col("id").isNull(), F.col("n"))), F.lit(0)).alias("nameless"),
        F.min(F.when(F.col("id").isNotNull(), F.struct("id", "part", "n"))).alias("first"))
    kinds = write_step(kinds, "filter-kinds")
    least = kinds.groupBy("text_key").agg(F.min("least").alias("of_text"))
    sized = kinds.join(least, "text_key").withColumn(
        "originals", F.col("nameless") + F.when(
            F.col("least") == F.col("of_text"), F.col("first.n")).otherwise(0))
    copy = 1 << (len(FILTERS) - 1)
    cells = sized.select(
        "part", "good", "toxic", F.explode(F.array(
            F.struct(F.col("own").alias("mask"), F.col("originals").alias("n")),
            F.struct((F.col("own") + copy).alias("mask"), (F.col("n") - F.col("originals")).alias("n")),
        )).alias("cell"))
    return cells.where("cell.n > 0").groupBy("part", "cell.mask", "good", "toxic").agg(
        F.sum("cell.n").alias("n"))


def walk(masks: DataFrame, letters: str = FILTERS) -> DataFrame:
    """``prefix, step, letter, mask, early, now``: for every order's every beginning and each of
    the ``mask`` rows, whether a filter before the last one removes it, and whether the last does."""
    bits = ", ".join(f"('{c}', {1 << k})" for k, c in enumerate(letters))
    return masks.sparkSession.sql(f"""
        WITH RECURSIVE letters(letter, bit) AS (VALUES {bits}),
        steps(prefix, applied, step, letter, mask, early, now) AS (
          SELECT '', 0, 0, '', mask, false, false FROM {{masks}}
          UNION ALL
          SELECT concat(s.prefix, l.letter), s.applied | l.bit, s.step + 1, l.letter, s.mask,
                 (s.mask & s.applied) <> 0, (s.mask & s.applied) = 0 AND (s.mask & l.bit) <> 0
          FROM steps s JOIN letters l ON (s.applied & l.bit) = 0)
        SELECT prefix, step, letter, l.bit, mask, early, now
        FROM steps JOIN letters l USING (letter) WHERE step > 0""", masks=masks)


def audit(cells: DataFrame, letters: str = FILTERS) -> DataFrame:
    """One row per part, order of all filters, and step, from the ``cells`` that ``judged``
    counts. ``cells`` are read several times: write them first."""
    every = len(letters)
    steps = write_step(walk(cells.select("mask").distinct(), letters), "filter-steps")
    fails = F.col("mask").bitwiseAND(F.col("bit")) != 0

    def count(condition: Column) -> Column:
        return F.sum(F.when(condition, F.col("n")).otherwise(0))

    # At most 2^filters masks times the beginnings of all orders.
    met = cells.join(F.broadcast(steps), "mask").groupBy("part", "prefix", "step", "letter").agg(
        count(~F.col("early") & ~F.col("now")).alias("kept"),
        count(F.col("now")).alias("removed"),
        count(fails & F.col("early")).alias("redundant"),
        count(F.col("mask") == F.col("bit")).alias("unique_fails"),
        count(F.col("now") & F.col("good")).alias("good_lost"),
        count(F.col("now") & F.col("toxic")).alias("toxic_lost"))
    # A beginning of k filters begins (every - k)! orders.
    orders = F.element_at(F.array(*(F.lit(factorial(every - k)) for k in range(1, every + 1))), F.col("step"))
    met = write_step(met.withColumn("share", F.col("removed") * orders), "filter-prefixes")
    shares = met.groupBy("part", "letter").agg(F.sum("share").alias("shapley"))
    begun = steps.select("prefix", "step").distinct()
    whole = begun.where(F.col("step") == every).select(F.col("prefix").alias("filter_order"))
    named = whole.select("filter_order", F.explode(F.sequence(F.lit(1), F.lit(every))).alias("k")) \
        .select("filter_order", F.expr("substring(filter_order, 1, k)").alias("prefix"))
    return met.join(shares, ["part", "letter"]).join(F.broadcast(named), "prefix").select(
        "part", "filter_order", F.col("step").cast("int").alias("step"), "kept", "removed",
        "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")


def op12_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every order of the five filters over all documents, by source."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    cells = write_step(judged(texts.documents(spark, sf_dir), labels), "filter-cells")
    return audit(cells)
