"""Operator 11: the best documents for each item of a query set, by MaxScore with pair bounds.

An index of blocks of documents is written first. A block has the postings of the query set's
terms (place in the block, occurrences), and for pairs of the heaviest terms of an item the list of
documents that hold both, with the highest impact the two reach together. While it is written,
every task keeps the best joint impacts per item; the last one that all tasks together leave on the
list is a score that the item's last result reaches at least, so the search starts with it.

The search bounds an item's score in a block: of each term by its highest impact there, of two
terms by their joint maximum or the higher one alone, whichever is more. Pairs that lower the sum
most are combined first, a term is in one pair at most. A block whose bound is below the lowest
result so far is skipped. Where no document without both terms of a pair could reach it, only the
pair's list is scored. Otherwise the terms or pairs of the smallest bounds, as many as stay below
it together, only add to documents that the others find. Tasks keep their best documents per item,
and Spark ranks those of all tasks. Nothing is approximate: all skipped documents score less.

Scores are whole numbers as ``impacts`` states. Words are told apart by 64-bit hashes. Null and
empty texts and texts without terms are no results, items without terms have none. Equal scores go
by ascending doc_id, a null one first; rows that repeat a doc_id or an item_id are documents or
items of their own. Only doc_id, text and item_id, text are read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from basketry.llm import texts
from basketry.llm.texts import write_step

RESULTS = 50
#: Heaviest terms of an item that are paired with each other.
PAIRED_TERMS = 8
#: Documents and postings of a block.
BLOCK_DOCS, BLOCK_POSTINGS = 4096, 1 << 21
#: Bytes of the query set that are searched for at a time.
QUERY_BYTES = 8 << 20

_FORWARD = "doc_id long, n long, terms binary, times binary"
_PARTS = {
    "doc_ids": "<i8", "named": "?", "m": "<i8", "terms": "<i4", "ends": "<i4", "places": "<u2",
    "times": "<i4", "pairs": "<i4", "joint": "<i8", "pair_ends": "<i4", "pair_places": "<u2",
}
_INDEX = ", ".join(f"{name} binary" for name in _PARTS) + \
    ", seed_items binary, seed_scores binary"
_FOUND = "item long, doc_id long, score long"


# --- the query set -----------------------------------------------------------------------

@dataclass
class Items:
    """Distinct terms of some items, sorted by hash, and the numbers of each item's terms."""

    rows: np.ndarray
    hashes: np.ndarray
    terms: list[np.ndarray]

    @classmethod
    def of(cls, rows: np.ndarray, column: pa.Array) -> Items:
        found = texts.words(*texts.utf8(column))
        hashes = np.unique(found.hashes)
        return cls(rows, hashes, [
            np.unique(np.searchsorted(hashes, h)) for h in texts.split_at(found.hashes, found.offsets)])


@dataclass
class Plan:
    """What search tasks know: terms and pairs by item, weights, and scores to start from."""

    terms: list[np.ndarray]
    weights: np.ndarray
    pairs: np.ndarray
    item_pairs: list[np.ndarray]
    results: int
    least: np.ndarray


def plan(items: Items, weights: np.ndarray, results: int, paired: int) -> Plan:
    """Terms of weight 0 add nothing. Of equal weights the smaller number comes first."""
    terms = [t[weights[t] > 0] for t in items.terms]
    named: dict[tuple[int, int], int] = {}
    item_pairs = []
    for t in terms:
        heavy = sorted(t[np.argsort(-weights[t], kind="stable")][:paired].tolist())
        item_pairs.append(np.array(
            [named.setdefault(pair, len(named)) for pair in combinations(heavy, 2)], np.int64))
    return Plan(terms, weights, np.array(list(named), np.int64).reshape(-1, 2), item_pairs, results,
                np.zeros(len(terms), np.int64))


def impacts(weight: np.ndarray, times: np.ndarray, m: np.ndarray) -> np.ndarray:
    """What a term adds to the score of a document that holds it."""
    return weight * ((1_000_000_000 * times) // (1000 * times + 20 * m))


# --- the index ---------------------------------------------------------------------------

def forward(docs: DataFrame, hashes: np.ndarray) -> DataFrame:
    """``doc_id, n, terms, times`` of each text with terms: how many, which of the query set, and
    how often."""
    shared = docs.sparkSession.sparkContext.broadcast(hashes)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wanted = shared.value
        for part in texts.slices(batches, "text"):
            found = texts.words(*texts.utf8(part[1]))
            full = np.flatnonzero(found.counts)
            at = np.minimum(np.searchsorted(wanted, found.hashes), len(wanted) - 1)
            hit = wanted[at] == found.hashes
            keys, times = np.unique(
                found.text_of[hit] * len(wanted) + at[hit], return_counts=True)
            cuts = np.searchsorted(keys, np.append(full, part.num_rows) * len(wanted))
            terms, times = (keys % len(wanted)).astype("<i4"), times.astype("<i4")
            yield pa.record_batch([
                part[0].take(pa.array(full)), pa.array(found.counts[full], pa.int64()),
                *(pa.array([x[a:b].tobytes() for a, b in zip(cuts, cuts[1:])], pa.binary())
                  for x in (terms, times))], ["doc_id", "n", "terms", "times"])

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(
        run, _FORWARD)


def term_weights(rows: DataFrame, n_terms: int) -> tuple[np.ndarray, int, int]:
    """Weight of each term, the number of documents, and all their terms."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(n_terms, np.int64)
        for batch in batches:
            for part in batch[0].to_pylist():
                total[np.frombuffer(part, "<i4")] += 1
        seen = np.flatnonzero(total)
        yield pa.record_batch([pa.array(seen), pa.array(total[seen])], ["term", "df"])

    whole = rows.agg(F.count("*").alias("n"), F.sum("n").alias("l")).first()
    n, length = whole["n"], whole["l"] or 0
    found = rows.select("terms").mapInArrow(count, "term long, df long").groupBy("term").agg(
        F.sum("df").alias("df"))
    # A row per term of the query set.
    weighed = found.select("term", F.floor(F.lit(1000) * F.log(
        F.lit(2 * n + 2).cast("double") / (2 * F.col("df") + 1))).alias("w")).collect()
    weights = np.zeros(n_terms, np.int64)
    for row in weighed:
        weights[row["term"]] = row["w"]
    return weights, n, length


class _Best:
    """The best documents of an item so far."""

    def __init__(self, results: int, least: int):
        self.results, self.least = results, least
        self.rows = np.zeros((0, 3), np.int64)

    def add(self, scores: np.ndarray, named: np.ndarray, doc_ids: np.ndarray) -> None:
        rows = np.concatenate([self.rows, np.stack([scores, named, doc_ids], axis=1)])
        order = np.lexsort((rows[:, 2], rows[:, 1], -rows[:, 0]))[:self.results]
        self.rows = rows[order]
        if len(self.rows) == self.results:
            self.least = max(self.least, int(self.rows[-1, 0]))


class _Block:
    """Postings of a block: by term its documents and impacts."""

    def __init__(self, parts: dict[str, np.ndarray], weights: np.ndarray):
        self.named, self.doc_ids = parts["named"], parts["doc_ids"]
        self.places = parts["places"].astype(np.int64)
        terms, ends = parts["terms"], parts["ends"]
        sizes = np.diff(ends, prepend=0)
        self.impacts = impacts(
            np.repeat(weights[terms], sizes), parts["times"].astype(np.int64), parts["m"][self.places])
        begins = ends - sizes
        self.at = dict(zip(terms.tolist(), zip(begins.tolist(), ends.tolist())))
        self.most = np.zeros(len(weights), np.int64)
        if len(terms):
            self.most[terms] = np.maximum.reduceat(self.impacts, begins)

    def of(self, term: int) -> tuple[np.ndarray, np.ndarray]:
        a, b = self.at.get(term, (0, 0))
        return self.places[a:b], self.impacts[a:b]


def index(rows: DataFrame, wanted: Plan, n: int, length: int, block_docs: int = BLOCK_DOCS
          ) -> DataFrame:
    """The blocks, and per task the best joint impacts of each item."""
    shared = rows.sparkSession.sparkContext.broadcast(wanted)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wanted = shared.value
        seeds = [np.zeros(0, np.int64)] * len(wanted.terms)
        held: list[tuple] = []

        def flush() -> pa.RecordBatch:
            sizes = np.array([len(t) // 4 for _, _, t, _ in held])
            terms = np.frombuffer(b"".join(h[2] for h in held), "<i4")
            times = np.frombuffer(b"".join(h[3] for h in held), "<i4")
            keep = wanted.weights[terms] > 0
            place = np.repeat(np.arange(len(held)), sizes)[keep]
            terms, times = terms[keep], times[keep]
            order = np.argsort(terms, kind="stable")
            terms, places, times = terms[order], place[order], times[order]
            seen, first = np.unique(terms, return_index=True)
            named = np.array([h[0] is not None for h in held])
            parts = {
                "doc_ids": np.array([h[0] or 0 for h in held], np.int64), "named": named,
                # ``n`` and ``length`` are of the whole corpus.
                "m": np.array([50 + (50 * h[1] * n) // length for h in held], np.int64),
                "terms": seen, "ends": np.append(first[1:], len(terms)) if len(seen) else first,
                "places": places, "times": times}
            parts |= _pair_lists(_Block(parts, wanted.weights), wanted, seeds)
            held.clear()
            return pa.record_batch([
                *(pa.array([parts[k].astype(kind).tobytes()], pa.binary())
                  for k, kind in _PARTS.items()), *(pa.nulls(1, pa.binary()),) * 2],
                [*_PARTS, "seed_items", "seed_scores"])

        postings = 0
        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns)):
                held.append(row)
                postings += len(row[2]) // 4
                if len(held) == block_docs or postings >= BLOCK_POSTINGS:
                    postings = 0
                    yield flush()
        if held:
            yield flush()
        of = np.repeat(np.arange(len(seeds)), [len(s) for s in seeds])
        yield pa.record_batch([
            *(pa.nulls(1, pa.binary()) for _ in _PARTS), pa.array([of.astype("<i8").tobytes()]),
            pa.array([np.concatenate([*seeds, np.zeros(0, np.int64)]).astype("<i8").tobytes()])],
            [*_PARTS, "seed_items", "seed_scores"])

    return rows.mapInArrow(run, _INDEX)


def _pair_lists(block: _Block, wanted: Plan, seeds: list[np.ndarray]) -> dict[str, np.ndarray]:
    """Of each pair that documents of the block hold: the documents and the highest joint impact.
    ``seeds`` take the best joint impacts of each item."""
    n = len(block.doc_ids)
    where, lists, joint = np.full(n, -1), {}, {}
    marked = None
    for k in np.lexsort((wanted.pairs[:, 1], wanted.pairs[:, 0])).tolist():
        a, b = wanted.pairs[k].tolist()
        if a not in block.at or b not in block.at:
            continue
        places_a, impacts_a = block.of(a)
        if marked != a:
            where[:] = -1
            where[places_a] = np.arange(len(places_a))
            marked = a
        places_b, impacts_b = block.of(b)
        at = where[places_b]
        both = at >= 0
        if both.any():
            lists[k], joint[k] = places_b[both], impacts_a[at[both]] + impacts_b[both]
    for item, pairs in enumerate(wanted.item_pairs):
        score = np.zeros(n, np.int64)
        for k in pairs.tolist():
            if k in lists:
                score[lists[k]] = np.maximum(score[lists[k]], joint[k])
        found = np.concatenate([seeds[item], score[score > 0]])
        if len(found) > wanted.results:
            found = np.partition(found, -wanted.results)[-wanted.results:]
        seeds[item] = found
    found = sorted(lists)
    return {
        "pairs": np.array(found, np.int64),
        "joint": np.array([joint[k].max() for k in found], np.int64),
        "pair_ends": np.cumsum([len(lists[k]) for k in found], dtype=np.int64),
        "pair_places": np.concatenate([*(lists[k] for k in found), np.zeros(0, np.int64)])}


# --- the search --------------------------------------------------------------------------

def bounds(most: np.ndarray, pairs: list[tuple[int, int, int]]) -> list[tuple[int, tuple[int, ...]]]:
    """Bounds of a score, rising: of single terms, and of the disjoint ``pairs`` (two terms, joint
    maximum) that lower the sum most. ``most`` has the maximum of each term by itself."""
    saved = sorted(
        ((int(most[a] + most[b] - max(joint, most[a], most[b])), a, b, joint) for a, b, joint in pairs),
        key=lambda p: (-p[0], p[1], p[2]))
    free = set(np.flatnonzero(most).tolist())
    out = []
    for gain, a, b, joint in saved:
        if gain > 0 and a in free and b in free:
            free -= {a, b}
            out.append((int(max(joint, most[a], most[b])), (a, b)))
    return sorted(out + [(int(most[t]), (t,)) for t in free])


def _search_block(block: _Block, lists: dict[int, tuple[int, np.ndarray]], wanted: Plan,
                  best: list[_Best]) -> None:
    """Offer the documents of a block to the best ones of every item."""
    n = len(block.doc_ids)
    for item, terms in enumerate(wanted.terms):
        mine = best[item]
        most = block.most[terms]
        if not most.any():
            continue
        number = {t: k for k, t in enumerate(terms.tolist())}
        pairs = []
        for k in wanted.item_pairs[item].tolist():
            a, b = (number[t] for t in wanted.pairs[k].tolist())
            if most[a] and most[b]:
                # Terms that never meet in the block have no list.
                pairs.append((a, b, lists[k][0] if k in lists else 0))
        units = bounds(most, pairs)
        total = sum(u[0] for u in units)
        if total < mine.least:
            continue
        score = np.zeros(n, np.int64)
        names = {(a, b): k for k, (a, b) in zip(
            wanted.item_pairs[item].tolist(),
            ((number[x], number[y]) for x, y in wanted.pairs[wanted.item_pairs[item]].tolist()))}
        # A pair whose terms must both be there.
        needed = [names[u] for bound, u in units if len(u) == 2 and names[u] in lists
                  and total - bound + max(most[u[0]], most[u[1]]) < mine.least]
        if needed:
            seen = lists[min(needed, key=lambda k: len(lists[k][1]))][1]
            rest, left = units, total
        else:
            below = np.cumsum([u[0] for u in units])
            cut = int(np.searchsorted(below, mine.least, "left"))
            touched = np.zeros(n, bool)
            for _, unit in units[cut:]:
                for t in unit:
                    places, values = block.of(int(terms[t]))
                    score[places] += values
                    touched[places] = True
            seen = np.flatnonzero(touched)
            rest, left = units[:cut], int(below[cut - 1]) if cut else 0
        for bound, unit in reversed(rest):
            seen = seen[score[seen] + left >= mine.least]
            if not len(seen):
                break
            left -= bound
            for t in unit:
                places, values = block.of(int(terms[t]))
                if len(places) < 8 * len(seen):
                    score[places] += values
                else:
                    at = np.minimum(np.searchsorted(places, seen), len(places) - 1)
                    hit = places[at] == seen
                    score[seen[hit]] += values[at[hit]]
        seen = seen[score[seen] >= max(mine.least, 1)]
        if len(seen):
            mine.add(score[seen], block.named[seen], block.doc_ids[seen])


def search(blocks: DataFrame, items: Items, wanted: Plan) -> DataFrame:
    """``item, doc_id, score``: the best documents of each task."""
    shared = blocks.sparkSession.sparkContext.broadcast((items.rows, wanted))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, wanted = shared.value
        best = [_Best(wanted.results, int(least)) for least in wanted.least]
        for batch in batches:
            for k in range(batch.num_rows):
                parts = {name: np.frombuffer(batch[c][k].as_py(), kind)
                         for c, (name, kind) in enumerate(_PARTS.items())}
                cuts = np.concatenate([[0], parts["pair_ends"]])
                lists = {pair: (joint, parts["pair_places"][a:b].astype(np.int64)) for pair, joint, a, b in zip(
                    parts["pairs"].tolist(), parts["joint"].tolist(), cuts[:-1].tolist(), cuts[1:].tolist())}
                _search_block(_Block(parts, wanted.weights), lists, wanted, best)
        found = np.concatenate([b.rows for b in best] or [np.zeros((0, 3), np.int64)])
        yield pa.record_batch([
            pa.array(np.repeat(rows, [len(b.rows) for b in best])),
            pa.array(found[:, 2], pa.int64(), mask=found[:, 1] == 0),
            pa.array(found[:, 0].copy())], ["item", "doc_id", "score"])

    return blocks.select(*_PARTS).mapInArrow(run, _FOUND)


def _least_scores(written: DataFrame, n_items: int, results: int) -> np.ndarray:
    """Per item the score that its last result reaches at least, from the tasks' seeds."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for items, scores in zip(batch[0].to_pylist(), batch[1].to_pylist()):
                yield pa.record_batch([np.frombuffer(items, "<i8"), np.frombuffer(scores, "<i8")],
                                      ["item", "score"])

    seeds = written.where("seed_items is not null").select("seed_items", "seed_scores").mapInArrow(
        run, "item long, score long")
    order = Window.partitionBy("item").orderBy(F.desc("score"))
    last = seeds.withColumn("rank", F.row_number().over(order)).where(f"rank <= {results}").groupBy(
        "item").agg(F.count("*").alias("n"), F.min("score").alias("least")).where(f"n = {results}")
    least = np.zeros(n_items, np.int64)
    for row in last.collect():  # a row per item of the block at most
        least[row["item"]] = row["least"]
    return least


def best_documents(
    docs: DataFrame, items: DataFrame, results: int = RESULTS, paired: int = PAIRED_TERMS,
    query_bytes: int = QUERY_BYTES, block_docs: int = BLOCK_DOCS,
) -> DataFrame:
    """``item_id, rank, doc_id, score``: for each row of ``items`` (``item_id, text``) the best
    ``results`` documents with a score above 0. Items are taken in blocks of ``query_bytes``, each
    with an index of its own."""
    spark = docs.sparkSession
    listed = write_step(items.select(
        F.monotonically_increasing_id().alias("item"), "item_id", F.col("text").cast("string")), "items")
    size = listed.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n_blocks = math.ceil(size / query_bytes) or 1
    found = []
    for number in range(n_blocks):
        chosen = listed.where(F.pmod(F.xxhash64("item"), F.lit(n_blocks)) == number)
        rows = chosen.select("item", "text").where("text is not null").toArrow()
        some = Items.of(rows["item"].to_numpy(), rows["text"].combine_chunks())
        if not len(some.hashes):
            continue
        table = write_step(forward(docs, some.hashes), "terms")
        weights, n, length = term_weights(table, len(some.hashes))
        wanted = plan(some, weights, results, paired)
        blocks = write_step(index(table, wanted, n, length, block_docs), "ranked-index")
        wanted.least = _least_scores(blocks, len(some.terms), results)
        found.append(write_step(search(blocks.where("doc_ids is not null"), some, wanted), "ranked"))
    if not found:
        found = [spark.createDataFrame([], _FOUND)]
    order = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_first("doc_id"))
    ranked = reduce(DataFrame.unionByName, found).withColumn("rank", F.row_number().over(order)).where(
        F.col("rank") <= results)
    return ranked.join(listed.select("item", "item_id"), "item").select(
        "item_id", F.col("rank").cast("int").alias("rank"), "doc_id", "score")


def op11_ranked_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The best documents of every benchmark item."""
    return best_documents(
        texts.documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
