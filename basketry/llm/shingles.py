"""Operator 7: documents whose sets of five-word shingles have a Jaccard similarity of 0.8.

A MinHash LSH forest: each tree is a sorted trie of signatures, and two documents are candidates
if they share a prefix in one tree. The prefix is shortened until pairs right at the threshold
are found with the wanted probability; every pair above it is found with more. Candidates are
verified on the exact sets.

Work is done on distinct shingle sets: copies are counted, never paired. A node of a trie (a
bucket) whose members are those of an earlier tree's is left out. A pair is judged in the first
tree that it shares only, so links are counted once. Buckets of any size are cut into pieces,
and pairs of pieces are multiplied as matrices; what leaves a task is a row per document, its
links, and a tree of edges for grouping, never the pairs.

Null and empty texts and texts without words have no shingles: no links, a class of their own.
A text of one to four words is one shingle. A null doc_id is a row like others, and repeated
rows are copies. The class id is the smallest doc_id of the class. Only doc_id and text are read.
"""

from __future__ import annotations

from collections.abc import Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from basketry.llm import texts
from basketry.llm.components import components
from basketry.llm.texts import write_step
from basketry.runtime import shuffle_width

WORDS, SIMILARITY, RECALL = 5, 0.8, 0.9999
TREES, LONGEST_PREFIX = 24, 8
#: Documents of a piece of a bucket, and about how many shingles they have together.
PIECE, PIECE_SHINGLES = 512, 1 << 20
#: Shingles (columns) multiplied at a time.
_COLUMNS = 2048

_RANDOM = np.random.default_rng(7)
_FLIP = _RANDOM.integers(0, 1 << 32, (TREES, LONGEST_PREFIX), dtype=np.uint32)
_FACTOR = _RANDOM.integers(0, 1 << 32, (TREES, LONGEST_PREFIX), dtype=np.uint32) | np.uint32(1)

_SKETCH = f"row {texts.ROW}, doc_id long, u binary, n_shingles long, trees array<long>"


def prefix_length(
    similarity: float = SIMILARITY, recall: float = RECALL, trees: int = TREES,
    longest: int = LONGEST_PREFIX,
) -> int:
    """Longest prefix with which a pair at the threshold shares one in some tree with
    probability ``recall``."""
    length = longest
    while length > 1 and 1 - (1 - similarity ** length) ** trees < recall:
        length -= 1
    return length


def _shingle_sets(raw, offsets, words: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingles of each text, sorted, and their offsets."""
    hashes, ends = texts.windows(texts.words(raw, offsets), words)
    of = np.repeat(np.arange(len(ends) - 1), np.diff(ends))
    order = np.lexsort((hashes, of))
    hashes, of = hashes[order], of[order]
    new = np.ones(len(hashes), bool)
    new[1:] = (hashes[1:] != hashes[:-1]) | (of[1:] != of[:-1])
    return hashes[new], np.searchsorted(of[new], np.arange(len(ends)))


def _keys(sets: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """16 bytes that name a set, from two sums over its elements."""
    first = np.add.reduceat(sets, starts)
    second = np.add.reduceat(texts.mix(sets ^ np.uint64(0x5851F42D4C957F2D)), starts)
    return np.stack([texts.mix(first), second], axis=1)


def _prefixes(sets: np.ndarray, starts: np.ndarray, length: int) -> np.ndarray:
    """Per set and tree a hash of the first ``length`` minimum hashes."""
    values = (sets >> np.uint64(32)).astype(np.uint32)
    out = np.zeros((len(starts), TREES), np.uint64)
    for tree in range(TREES):
        for level in range(length):
            low = np.minimum.reduceat((values ^ _FLIP[tree, level]) * _FACTOR[tree, level], starts)
            out[:, tree] = texts.mix(out[:, tree] * np.uint64(31) + low + np.uint64(1))
    return out.view(np.int64)


def sketch(docs: DataFrame, words: int, length: int) -> DataFrame:
    """``row, doc_id, u, n_shingles, trees``: the name of each text's shingle set (null without
    shingles), its size, and its prefix in every tree."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in texts.slices(batches, "text"):
            sets, offsets = _shingle_sets(*texts.utf8(part[2]), words)
            sizes = np.diff(offsets)
            full = np.flatnonzero(sizes)
            keys: list = [None] * part.num_rows
            trees: list = [None] * part.num_rows
            if len(full):
                starts = offsets[:-1][full]
                for k, key, tree in zip(
                    full, _keys(sets, starts), _prefixes(sets, starts, length)
                ):
                    keys[k], trees[k] = key.tobytes(), tree
            yield pa.record_batch([
                part[0], part[1], pa.array(keys, pa.binary()), pa.array(sizes, pa.int64()),
                pa.array(trees, pa.list_(pa.int64())),
            ], ["row", "doc_id", "u", "n_shingles", "trees"])

    return docs.select("row", "doc_id", "text").mapInArrow(run, _SKETCH)


def _buckets(units: DataFrame) -> DataFrame:
    """``tree, prefix, n, size`` of the buckets to judge (``size``: shingles of all members): two
    members at least, and of buckets with the same members only the first."""
    member = F.xxhash64("u")
    rows = units.select(
        F.posexplode("trees").alias("tree", "prefix"), member.alias("m"), "n_shingles")
    counted = rows.groupBy("tree", "prefix").agg(
        F.count("*").alias("n"), F.sum("n_shingles").alias("size"), F.bit_xor("m").alias("x"),
        F.bit_xor(F.xxhash64("m")).alias("y")).where("n > 1")
    return counted.groupBy("n", "size", "x", "y").agg(
        F.min(F.struct("tree", "prefix")).alias("first")).select("first.*", "n", "size")


def _sets_of(docs: DataFrame, wanted: DataFrame, words: int) -> DataFrame:
    """``u, set`` of the ``row, u`` rows of ``wanted``, from their texts."""
    rows = docs.select("row", "text").join(wanted.select("row"), "row")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in texts.slices(batches, "text"):
            sets, offsets = _shingle_sets(*texts.utf8(part[0]), words)
            full = np.flatnonzero(np.diff(offsets))
            keys = _keys(sets, offsets[:-1][full]) if len(full) else []
            yield pa.record_batch([
                pa.array([k.tobytes() for k in keys], pa.binary()),
                pa.array([sets[offsets[k]:offsets[k + 1]].tobytes() for k in full], pa.binary()),
            ], ["u", "set"])

    return rows.select("text").mapInArrow(run, "u binary, set binary")


def _overlaps(left: list[np.ndarray], right: list[np.ndarray]) -> np.ndarray:
    """Sizes of all intersections."""
    size = np.zeros((len(left), len(right)), np.float32)
    if len(left) * len(right) <= 16:
        for i, x in enumerate(left):
            for j, y in enumerate(right):
                at = np.minimum(np.searchsorted(x, y), len(x) - 1)
                size[i, j] = np.count_nonzero(x[at] == y)
        return size
    (rows_a, a), (rows_b, b) = (
        (np.repeat(np.arange(len(sets)), [len(x) for x in sets]), np.concatenate(sets))
        for sets in (left, right))
    both = np.intersect1d(a, b)

    def shared(rows: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rows and columns of the shingles that both sides have, by column."""
        at = np.searchsorted(both, values)
        hit = np.flatnonzero(both[np.minimum(at, len(both) - 1)] == values) if len(both) else at[:0]
        order = hit[np.argsort(at[hit], kind="stable")]
        return rows[order].astype(np.int32), at[order].astype(np.int32)

    (rows_a, a), (rows_b, b) = shared(rows_a, a), shared(rows_b, b)
    for start in range(0, len(both), _COLUMNS):
        ones = []
        for rows, columns, height in ((rows_a, a, len(left)), (rows_b, b, len(right))):
            part = slice(*np.searchsorted(columns, (start, start + _COLUMNS)))
            matrix = np.zeros((height, _COLUMNS), np.float32)
            matrix[rows[part], columns[part] - start] = 1
            ones.append(matrix)
        size += ones[0] @ ones[1].T
    return size


def _forest(linked: np.ndarray) -> list[int]:
    """For each node of a symmetric graph the first node of its group."""
    root = [-1] * len(linked)
    for start in range(len(linked)):
        if root[start] < 0:
            front = np.zeros(len(linked), bool)
            front[start] = True
            group = front.copy()
            while front.any():
                front = linked[front].any(axis=0) & ~group
                group |= front
            for node in np.flatnonzero(group):
                root[node] = start
    return root


def _judge(rows: dict, limit: Fraction) -> tuple[list, list, list, list]:
    """Judge one pair of pieces; ``u``, linked sets, linked documents, and the root of each
    member with links."""
    tree, same = rows["tree"][0], rows["i"][0] == rows["j"][0]
    sets = [np.frombuffer(s, np.uint64) for s in rows["set"]]
    trees = np.array(rows["trees"], np.int64)[:, :tree]
    sizes, copies = np.array([len(s) for s in sets]), np.array(rows["n_docs"])
    piece = np.array(rows["piece"])
    a = np.flatnonzero(piece == rows["i"][0])
    b = a if same else np.flatnonzero(piece == rows["j"][0])
    if not len(a) or not len(b):
        return [], [], [], []
    wanted = np.ones((len(a), len(b)), bool)
    if same:
        wanted = np.triu(wanted, 1)
    for t in range(tree):
        wanted &= trees[a, t][:, None] != trees[b, t][None, :]
    least, most = np.minimum.outer(sizes[a], sizes[b]), np.maximum.outer(sizes[a], sizes[b])
    wanted &= least * limit.denominator >= most * limit.numerator
    if not wanted.any():
        return [], [], [], []
    use_a, use_b = np.flatnonzero(wanted.any(axis=1)), np.flatnonzero(wanted.any(axis=0))
    both = np.zeros(wanted.shape, np.int64)
    both[np.ix_(use_a, use_b)] = _overlaps([sets[a[k]] for k in use_a], [sets[b[k]] for k in use_b])
    union = np.add.outer(sizes[a], sizes[b]) - both
    linked = wanted & (both * limit.denominator >= union * limit.numerator)
    if not linked.any():
        return [], [], [], []
    n = len(sets)
    graph = np.zeros((n, n), bool)
    graph[np.ix_(a, b)] = linked
    graph |= graph.T
    near = np.flatnonzero(graph.any(axis=1))
    graph = graph[np.ix_(near, near)]
    root = _forest(graph)
    return ([rows["u"][k] for k in near], graph.sum(axis=1).tolist(),
            (graph @ copies[near]).tolist(), [rows["u"][near[r]] for r in root])


def _by_task(batches: Iterator[pa.RecordBatch], keys: tuple[str, ...]) -> Iterator[dict]:
    """Columns of each run of rows with equal keys, across batches."""
    held: dict | None = None
    for batch in batches:
        columns = batch.to_pydict()
        marks = list(zip(*(columns[k] for k in keys)))
        start = 0
        while start < len(marks):
            stop = start
            while stop < len(marks) and marks[stop] == marks[start]:
                stop += 1
            part = {k: v[start:stop] for k, v in columns.items()}
            if held is not None and tuple(held[k][0] for k in keys) == marks[start]:
                held = {k: held[k] + part[k] for k in held}
            else:
                if held is not None:
                    yield held
                held = part
            start = stop
    if held is not None:
        yield held


def links(docs: DataFrame, sketches: DataFrame, words: int, similarity: float, piece: int = PIECE
          ) -> tuple[DataFrame, DataFrame]:
    """``units`` (one row per distinct set: ``u, doc_id, row, n_docs``; the first row) and ``found`` (``u, sets,
    docs, root``: links judged in one task)."""
    units = write_step(sketches.where("u is not null").groupBy("u").agg(
        F.min(F.struct("doc_id", "row")).alias("first"), F.count("*").alias("n_docs"),
        F.max("n_shingles").alias("n_shingles"), F.any_value("trees").alias("trees")
    ).select("u", "first.*", "n_docs", "n_shingles", "trees"), "units")
    buckets = write_step(_buckets(units), "buckets")
    rows = units.select("u", F.posexplode("trees").alias("tree", "prefix"))
    members = write_step(rows.join(buckets, ["tree", "prefix"]), "members")
    named = units.join(members.select("u").distinct(), "u", "left_semi")
    sets = write_step(
        named.join(_sets_of(docs, named, words), "u").select("u", "n_docs", "trees", "set"), "sets")
    pieces = F.greatest(
        F.ceil(F.col("n") / piece), F.ceil(F.col("size") / PIECE_SHINGLES)).cast("int")
    cut = members.withColumn("pieces", pieces).withColumn(
        "piece", F.pmod(F.xxhash64("u", F.lit(1)), F.col("pieces")).cast("int"))
    cut = cut.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("pieces") - 1)))
    cut = cut.select(
        "u", "tree", "prefix", "piece", F.least("piece", "other").alias("i"),
        F.greatest("piece", "other").alias("j"))
    keys = ("tree", "prefix", "i", "j")
    tasks = cut.join(sets, "u").repartition(
        max(shuffle_width(docs.sparkSession), 2 * docs.sparkSession.sparkContext.defaultParallelism),
        *keys).sortWithinPartitions(*keys)
    limit = Fraction(str(similarity))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in _by_task(batches, keys):
            u, n_sets, n_docs, root = _judge(group, limit)
            if u:
                yield pa.record_batch([
                    pa.array(u, pa.binary()), pa.array(n_sets, pa.int64()),
                    pa.array(n_docs, pa.int64()), pa.array(root, pa.binary()),
                ], ["u", "sets", "docs", "root"])

    found = tasks.mapInArrow(run, "u binary, sets long, docs long, root binary")
    return units, write_step(found, "links")


def _classes(rows: DataFrame, words: int, similarity: float, recall: float) -> DataFrame:
    """``row, doc_id, class_id, class_row, n_links, n_text_links, n_shingles`` of ``rows`` (``row,
    doc_id, text``); ``class_row`` is the first row of the class."""
    length = prefix_length(similarity, recall)
    sketches = write_step(sketch(rows, words, length), "sketches")
    units, found = links(rows, sketches, words, similarity)
    group = components(found.select(F.col("u").alias("a"), F.col("root").alias("b")))
    counts = found.groupBy("u").agg(F.sum("sets").alias("sets"), F.sum("docs").alias("docs"))
    named = units.select("u", "doc_id", "row", "n_docs").join(
        group.select(F.col("node").alias("u"), "label"), "u", "left").join(counts, "u", "left")
    named = write_step(named.withColumn("label", F.coalesce("label", "u")), "named")
    classes = named.groupBy("label").agg(
        F.min(F.struct("doc_id", "row")).alias("first"), F.min("doc_id").alias("class_id"))
    per_set = named.join(classes, "label").select(
        "u", "class_id", F.col("first.row").alias("class_row"),
        (F.col("n_docs") - 1 + F.coalesce("docs", F.lit(0))).alias("n_links"),
        F.coalesce("sets", F.lit(0)).alias("n_text_links"))
    return sketches.select("row", "doc_id", "u", "n_shingles").join(per_set, "u", "left")


def near_duplicates(
    docs: DataFrame, words: int = WORDS, similarity: float = SIMILARITY, recall: float = RECALL
) -> DataFrame:
    """``doc_id, class_id, n_links, n_text_links, n_shingles`` per row of ``docs``: the class, the
    number of other rows at least ``similarity`` alike, and of other shingle sets alike."""
    row = texts.fresh("row")
    found = _classes(texts.keyed(texts.with_row(docs, row), row), words, similarity, recall)
    return found.select(
        "doc_id", F.coalesce("class_id", "doc_id").alias("class_id"),
        F.coalesce("n_links", F.lit(0)).alias("n_links"),
        F.coalesce("n_text_links", F.lit(0)).alias("n_text_links"), "n_shingles")


def drop_near_duplicates(
    docs: DataFrame, words: int = WORDS, similarity: float = SIMILARITY, recall: float = RECALL
) -> DataFrame:
    """``docs`` with all their columns and one row of each class: the smallest doc_id (a null one
    first), of equal ones the first row. Rows without shingles stay."""
    row = texts.fresh("row")
    docs = texts.with_row(docs, row)
    found = _classes(texts.keyed(docs, row), words, similarity, recall)
    return texts.without(docs, row, found.where("class_row <> row").select("row"))


def op7_near_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Class and links of every document."""
    return near_duplicates(texts.documents(spark, sf_dir))
