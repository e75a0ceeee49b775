"""Operator 4: benchmark decontamination with suffix arrays.

Documents are cut into shards of bounded size. A shard's words are numbered, and its suffixes
sorted by prefix doubling up to the window length; an end mark keeps every suffix inside its
document. All suffixes of the benchmark then go through one binary search per word of depth, at
once: the interval of the suffix array that starts with the suffix's first words shrinks until
it is empty or the window is full. What is left of an interval are all verbatim occurrences;
they are extended word by word to the longest match. The benchmark is broadcast in blocks of
bounded size; with several blocks, the shards meet each block in turn and the spans are merged.

Words follow the rule of ``texts``. An item of fewer words than a window, but not none, is one
window. Null and empty texts have no words and are never contaminated; null items match nothing.
Rows that repeat a doc_id are judged each for itself. Items are named by ``item_id`` as a
string; a null item_id is the empty string. Columns other than those named are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from basketry.llm import texts
from basketry.runtime import cut_lineage

WINDOW = 13
#: Bytes of benchmark text that are broadcast at a time.
BLOCK_BYTES = 16 << 20

_HITS = (
    "n_words long, spans array<struct<start:int,end:int>>, items array<string>, "
    "longest array<struct<item_id:string,item_start:int,doc_start:int,n_words:int>>"
)


@dataclass
class Suffixes:
    """Benchmark suffixes that can start a window: ``words`` of all items on end, the suffix
    starts, the words each needs to match, the words left in its item, and its item."""

    words: np.ndarray
    starts: np.ndarray
    need: np.ndarray
    left: np.ndarray
    item: np.ndarray
    first: np.ndarray
    names: list[str]

    @staticmethod
    def of(items: pd.DataFrame, window: int) -> Suffixes:
        raw, offsets = texts.utf8(pa.array(items["text"].tolist(), pa.string()))
        found = texts.words(raw, offsets)
        length = np.repeat(found.counts, found.counts)
        place = np.arange(len(found.hashes)) - np.repeat(found.offsets[:-1], found.counts)
        starts = np.flatnonzero((place + window <= length) | ((length < window) & (place == 0)))
        return Suffixes(
            found.hashes, starts, np.minimum(window, length[starts]),
            (length - place)[starts], found.text_of[starts], place[starts],
            items["item_id"].tolist(),
        )


class SuffixArray:
    """Suffixes of some documents' words, sorted by their first ``depth`` words at least."""

    def __init__(self, found: texts.Words, depth: int):
        self.vocabulary, numbered = np.unique(found.hashes, return_inverse=True)
        # 0 marks the end of a document; each document has one.
        n_docs = len(found.offsets) - 1
        self.words = np.zeros(len(numbered) + n_docs, np.int64)
        self.doc = np.repeat(np.arange(n_docs), found.counts + 1)
        self.base = found.offsets[:-1] + np.arange(n_docs)
        self.words[np.arange(len(numbered)) + found.text_of] = numbered + 1
        rank, sorted_by = self.words, 1
        order = np.argsort(rank, kind="stable")
        while sorted_by < depth:
            # Suffixes that are alone with their rank keep their place.
            key = rank * (len(self.words) + 1)
            key[:-sorted_by] += rank[sorted_by:] + 1
            ordered = rank[order]
            tied = np.empty(len(order), bool)
            tied[0] = False
            tied[1:] = ordered[1:] == ordered[:-1]
            tied[:-1] |= tied[1:]
            tied &= ordered > 0
            if not tied.any():
                break
            at = np.flatnonzero(tied)
            order[at] = order[at][np.argsort(key[order[at]], kind="stable")]
            sorted_key = key[order]
            new = np.empty(len(order), np.int64)
            new[0] = 0
            np.cumsum((sorted_key[1:] != sorted_key[:-1]) & (ordered[1:] > 0), out=new[1:])
            rank = np.empty_like(new)
            rank[order] = new
            sorted_by *= 2
        self.order = order

    def _number(self, hashes: np.ndarray) -> np.ndarray:
        at = np.minimum(np.searchsorted(self.vocabulary, hashes), len(self.vocabulary) - 1)
        return np.where(self.vocabulary[at] == hashes, at + 1, -1)

    def _bound(self, low, high, offset: int, value, after: bool) -> np.ndarray:
        """First place in ``[low, high)`` whose word at ``offset`` is not below (``after``: is
        above) ``value``."""
        low, high = low.copy(), high.copy()
        while (open_ := low < high).any():
            middle = (low + high) >> 1
            at = np.minimum(self.order[np.minimum(middle, len(self.order) - 1)] + offset,
                            len(self.words) - 1)
            less = (self.words[at] <= value) if after else (self.words[at] < value)
            low = np.where(open_ & less, middle + 1, low)
            high = np.where(open_ & ~less, middle, high)
        return low

    def search(self, wanted: Suffixes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Suffixes with an occurrence, and their intervals of the suffix array."""
        which = np.arange(len(wanted.starts))
        low, high = np.zeros(len(which), np.int64), np.full(len(which), len(self.order))
        numbers = self._number(wanted.words) if len(self.vocabulary) else np.full(
            len(wanted.words), -1)
        for offset in range(int(wanted.need.max(initial=0))):
            live = wanted.need[which] > offset
            value = numbers[wanted.starts[which[live]] + offset]
            new_low = self._bound(low[live], high[live], offset, value, after=False)
            high[live] = self._bound(new_low, high[live], offset, value, after=True)
            low[live] = new_low
            keep = low < high
            which, low, high = which[keep], low[keep], high[keep]
        return which, low, high


def _spans(places: np.ndarray, length: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Overlapping or touching spans merged."""
    order = np.argsort(places, kind="stable")
    begin, end = places[order], np.maximum.accumulate((places + length)[order])
    new = np.ones(len(begin), bool)
    new[1:] = begin[1:] > end[:-1]
    return begin[new], end[np.append(np.flatnonzero(new)[1:] - 1, len(end) - 1)]


def _search_shard(raw, offsets, rows: pa.Array, wanted: Suffixes, window: int) -> pa.RecordBatch:
    found = texts.words(raw, offsets)
    shard = SuffixArray(found, window)
    which, low, high = shard.search(wanted)
    n_docs = len(rows)
    spans, items, longest = ([[] for _ in range(n_docs)] for _ in range(3))
    if len(which):
        # Suffixes with one interval occur at the same places: cover those once.
        _, one = np.unique(np.stack([low, high, wanted.need[which]]), axis=1, return_index=True)
        count = (high - low)[one]
        at = np.repeat(low[one] - (np.cumsum(count) - count), count) + np.arange(count.sum())
        begin, end = _spans(shard.order[at], np.repeat(wanted.need[which[one]], count))
        for d, b, e in zip(shard.doc[begin], begin, end):
            spans[d].append({"start": int(b - shard.base[d]), "end": int(e - shard.base[d])})
        count = high - low
        at = np.repeat(low - (np.cumsum(count) - count), count) + np.arange(count.sum())
        suffix, place = np.repeat(which, count), shard.order[at]
        docs = shard.doc[place]
        for d, i in np.unique(np.stack([docs, wanted.item[suffix]]), axis=1).T:
            items[d].append(wanted.names[i])
        # A longest match starts where the words before differ.
        numbers = shard._number(wanted.words)
        start, first = wanted.starts[suffix], wanted.first[suffix]
        opens = (first == 0) | (place == shard.base[docs]) | (
            shard.words[np.maximum(place - 1, 0)] != numbers[np.maximum(start - 1, 0)])
        suffix, place, docs, start = suffix[opens], place[opens], docs[opens], start[opens]
        length, left = wanted.need[suffix].copy(), wanted.left[suffix]
        more = np.flatnonzero(length < left)
        while len(more):
            same = numbers[start[more] + length[more]] == shard.words[place[more] + length[more]]
            more = more[same]
            length[more] += 1
            more = more[length[more] < left[more]]
        for k, d, p, n in zip(suffix, docs, place, length):
            longest[d].append({
                "item_id": wanted.names[wanted.item[k]], "item_start": int(wanted.first[k]),
                "doc_start": int(p - shard.base[d]), "n_words": int(n)})
    schema = pa.schema([
        ("row", rows.type), ("n_words", pa.int64()),
        ("spans", pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))),
        ("items", pa.list_(pa.string())),
        ("longest", pa.list_(pa.struct([
            ("item_id", pa.string()), ("item_start", pa.int32()), ("doc_start", pa.int32()),
            ("n_words", pa.int32())]))),
    ])
    return pa.record_batch([
        rows, pa.array(found.counts, pa.int64()),
        pa.array(spans, schema.field("spans").type),
        pa.array([sorted(set(i)) for i in items], schema.field("items").type),
        pa.array(longest, schema.field("longest").type),
    ], schema=schema)


def _blocks(benchmark: DataFrame, limit: int) -> tuple[DataFrame, int]:
    """The items with their ``block``, and the number of blocks of about ``limit`` bytes."""
    items = benchmark.select(
        F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item_id"),
        F.col("text").cast("string")).where("text is not null")
    size = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n = math.ceil(size / limit) or 1
    return items.withColumn("block", F.pmod(F.xxhash64("text"), F.lit(n))), n


def matches(
    docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, block_bytes: int = BLOCK_BYTES,
    key: str = "doc_id",
) -> DataFrame:
    """Per row of ``docs``: ``doc_id`` (or the column ``key`` that names rows), ``n_words``, ``spans`` of hit words, ``items`` with an
    occurring window (distinct, sorted) and the ``longest`` matches."""
    text = F.col("text").cast("string")
    name = F.col("doc_id").cast("long") if key == "doc_id" else F.col(key)
    items, n_blocks = _blocks(benchmark, block_bytes)
    spark = docs.sparkSession

    def search(rows: DataFrame, block: int) -> DataFrame:
        wanted = Suffixes.of(items.where(F.col("block") == block).toPandas(), window)
        shared = spark.sparkContext.broadcast(wanted)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for part in texts.slices(batches, "text"):
                raw, offsets = texts.utf8(part[1])
                yield _search_shard(raw, offsets, part[0], shared.value, window)

        return rows.mapInArrow(run, f"row {rows.schema['row'].dataType.simpleString()}, {_HITS}")

    if n_blocks == 1:
        return search(docs.select(name.alias("row"), text.alias("text")), 0).withColumnRenamed("row", key)
    rows = cut_lineage(docs.select(
        F.monotonically_increasing_id().alias("row"), name.alias(key), text.alias("text")))
    found = None
    for block in range(n_blocks):
        part = search(rows.select("row", "text"), block)
        found = part if found is None else found.unionByName(part)
    merged = found.groupBy("row").agg(
        F.max("n_words").alias("n_words"), F.flatten(F.collect_list("spans")).alias("spans"),
        F.sort_array(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"),
        F.flatten(F.collect_list("longest")).alias("longest"))
    return rows.select("row", key).join(merged, "row").select(
        key, "n_words", _merged("spans").alias("spans"), "items", "longest")


def _merged(spans: str):
    """Spans of several blocks as disjoint ones."""
    empty = F.array().cast("array<struct<start:int,end:int>>")
    return F.aggregate(
        F.array_sort(spans), empty,
        lambda done, s: F.when(
            (F.size(done) > 0) & (F.element_at(done, -1)["end"] >= s["start"]),
            F.concat(
                F.slice(done, 1, F.greatest(F.size(done) - 1, F.lit(0))),
                F.array(F.struct(
                    F.element_at(done, -1)["start"].alias("start"),
                    F.greatest(F.element_at(done, -1)["end"], s["end"]).alias("end")))),
        ).otherwise(F.concat(done, F.array(s))))


def judge(found: DataFrame) -> DataFrame:
    """``matches`` with ``n_hit`` and ``contaminated``: a twentieth of the words are hit."""
    n_hit = F.aggregate(
        "spans", F.lit(0).cast("long"), lambda n, s: n + (s["end"] - s["start"]))
    return found.withColumn("n_hit", n_hit).withColumn(
        "contaminated", (F.col("n_hit") > 0) & (20 * F.col("n_hit") >= F.col("n_words")))


def remove_contaminated(
    docs: DataFrame, benchmark: DataFrame, window: int = WINDOW
) -> DataFrame:
    """``docs`` with all their columns, without the rows whose text is contaminated."""
    row = texts.fresh("row")
    docs = texts.with_row(docs, row)
    bad = judge(matches(docs, benchmark, window, key=row)).where("contaminated")
    return texts.without(docs, row, bad.select(row))


def op4_contamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Judge every document against the whole benchmark."""
    found = judge(matches(
        texts.documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet")))
    longest = F.array_max(F.transform("longest", lambda m: m["n_words"]))
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), "contaminated",
        F.coalesce(longest, F.lit(0)).cast("long").alias("longest_match"))
