"""Content similarity: TF-IDF over tags and exact cosine above a threshold.

Products with the same tags have the same vector, so all work is done once per distinct tag
multiset, a *profile*. Similar pairs are kept between profiles; products are attached to
them only for the lists and look-ups that are asked for. A profile shared by a third of the
catalogue therefore costs one row in the pair table, not a quadratic number.

Pairs come from an inverted index that holds only part of each vector. Words are ordered from
rare to common; the common end of a vector is left out of the index as long as what is left
out is shorter than the threshold. Two vectors whose cosine reaches the threshold must then
share an indexed word (the part of one vector after its last indexed word is too short to
reach it alone), so nothing is missed, while the most common words hardly enter the index.
Index entries travel with their vectors. Entries of one word meet in one task, or, when a word
has many, block by block; the task multiplies the block's vectors, keeps what passes the
threshold, and leaves a pair to the first word that both index.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.ml.feature import IDF, HashingTF
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from basketry.functions.text import tag_words
from basketry.operators.dense import settled
from basketry.operators.lists import top_k
from basketry.runtime import cut_lineage, shuffle_width

#: Index entries of one word that a task holds on either side.
POSTING_BLOCK = 1024
_WORDS_AT_ONCE = 1024
_PAIRS = "a long, b long, score double"
# A vector's part left out of the index must be shorter than the threshold by this factor,
# so that rounding in the sums cannot drop a pair.
_MARGIN = 1 - 1e-6


def words_key(words: Column) -> Column:
    """Identifies a multiset of words."""
    return F.md5(F.array_join(F.array_sort(words), "\u0001"))


def profiles(product: DataFrame) -> DataFrame:
    """``profile, key, words, members``: one row per distinct tag multiset. The smallest
    product id names the profile."""
    words = product.select("product_id", F.array_sort(tag_words(F.col("tags"))).alias("words"))
    return (
        words.groupBy(words_key(F.col("words")).alias("key"), "words")
        .agg(F.min("product_id").alias("profile"), F.count(F.lit(1)).alias("members"))
    )


def profile_members(product: DataFrame, vectors: DataFrame) -> DataFrame:
    """``product_id, profile`` of every product that has a vector."""
    keyed = product.select("product_id", words_key(tag_words(F.col("tags"))).alias("key"))
    return keyed.join(vectors.select("key", "profile"), "key").select("product_id", "profile")


def term_weights(profile: DataFrame) -> DataFrame:
    """``profile, key, members, word, tf, df, holders, weight``: TF-IDF with
    ``ln((m + 1) / (df + 1))``.

    ``df`` counts products, ``holders`` counts profiles. Words of weight 0 are left out.
    """
    key = ["profile", "key", "members", "word"]
    counted = profile.select(*key[:3], F.explode("words").alias("word")).groupBy(*key).agg(
        F.count(F.lit(1)).alias("tf")
    )
    vocabulary = counted.groupBy("word").agg(
        F.sum("members").alias("df"), F.count(F.lit(1)).alias("holders")
    )
    products = profile.agg(F.sum("members").alias("m")).scalar()
    idf = vocabulary.select(
        "word", "df", "holders",
        F.log((products + 1) / (F.col("df") + 1)).alias("idf"),
    ).where(F.col("idf") > 0)
    return counted.join(idf, "word").select(
        *key, "tf", "df", "holders", (F.col("tf") * F.col("idf")).alias("weight")
    )


def tfidf(product: DataFrame) -> DataFrame:
    """``product_id, word, tf, weight`` with the exact vocabulary."""
    weights = term_weights(profiles(product)).select("key", "word", "tf", "weight")
    keyed = product.select("product_id", words_key(tag_words(F.col("tags"))).alias("key"))
    return keyed.join(weights, "key").select("product_id", "word", "tf", "weight")


def unit_vectors(weights: DataFrame, threshold: float) -> DataFrame:
    """``profile, key, members, terms, values, index``: unit vectors, and the words to index
    for ``threshold``, rarest first. Written down, because the pair search reads it often.
    """
    whole = Window.partitionBy("profile")
    tail = whole.orderBy(F.desc("df"), F.desc("word")).rowsBetween(Window.unboundedPreceding, 0)
    square = F.col("weight") * F.col("weight")
    rows = weights.withColumn("norm2", F.sum(square).over(whole)).withColumn(
        "tail2", F.sum(square).over(tail)
    )
    unit = F.struct(
        "df", "word", "holders", (F.col("weight") / F.sqrt("norm2")).alias("value"),
        (F.col("tail2") >= F.lit(threshold * threshold * _MARGIN) * F.col("norm2")).alias("keep"),
    )
    vector = rows.groupBy("profile").agg(
        F.first("key").alias("key"), F.first("members").alias("members"),
        F.array_sort(F.collect_list(unit)).alias("v"),
    )
    return cut_lineage(vector.select(
        "profile", "key", "members", F.col("v.word").alias("terms"),
        F.col("v.value").alias("values"), F.filter("v", lambda e: e["keep"]).alias("index"),
    ), "vectors")


def content_vectors(product: DataFrame, threshold: float = 0.4) -> DataFrame:
    """``unit_vectors`` of a product table."""
    return unit_vectors(term_weights(profiles(product)), threshold)


def _postings(vectors: DataFrame, posting_block: int) -> DataFrame:
    """Index entries with the vector they belong to and the words indexed before them."""
    entry = vectors.select(
        "profile", "terms", "values", F.col("index.word").alias("indexed"),
        F.posexplode("index").alias("pos", "entry"),
    )
    blocks = F.ceil(F.col("entry.holders") / posting_block)
    return entry.select(
        F.col("entry.word").alias("word"), "profile", "terms", "values",
        F.slice("indexed", F.lit(1), F.col("pos")).alias("earlier"),
        blocks.alias("blocks"), F.pmod(F.xxhash64("profile"), blocks).alias("block"),
    )


@dataclass
class _Rows:
    """Posting rows as flat arrays of word codes."""

    profile: np.ndarray
    codes: list[np.ndarray]
    values: list[np.ndarray]
    earlier: list[np.ndarray]

    def part(self, start: int, stop: int) -> _Rows:
        return _Rows(*(x[start:stop] for x in vars(self).values()))


def _encode(*frames: pd.DataFrame) -> list[_Rows]:
    """Give the words of some frames common integer codes."""
    words = pd.Index(np.unique(np.concatenate([t for f in frames for t in f["terms"]])))

    def coded(lists: pd.Series) -> list[np.ndarray]:
        stops = np.cumsum([len(x) for x in lists])
        flat = np.concatenate(list(lists)) if len(lists) else np.array([], dtype=object)
        return np.split(words.get_indexer(flat), stops[:-1])

    return [
        _Rows(f["profile"].to_numpy(), coded(f["terms"]), list(f["values"]), coded(f["earlier"]))
        for f in frames
    ]


def _dense(codes: list[np.ndarray], values: list[np.ndarray] | None, columns: np.ndarray):
    """Rows x ``columns`` matrix of values (or of ones)."""
    row = np.repeat(np.arange(len(codes)), [len(c) for c in codes])
    flat = np.concatenate(codes)
    at = np.searchsorted(columns, flat)
    known = (at < len(columns)) & (columns[np.minimum(at, len(columns) - 1)] == flat)
    matrix = np.zeros((len(codes), len(columns)))
    matrix[row[known], at[known]] = 1.0 if values is None else np.concatenate(values)[known]
    return matrix


def _products(left: list, right: list, values: tuple | None) -> np.ndarray:
    """Dot products of two lists of sparse rows, a bounded number of words at a time."""
    shared = np.intersect1d(np.concatenate(left), np.concatenate(right))
    total = np.zeros((len(left), len(right)))
    for start in range(0, len(shared), _WORDS_AT_ONCE):
        columns = shared[start:start + _WORDS_AT_ONCE]
        a = _dense(left, values and values[0], columns)
        total += a @ _dense(right, values and values[1], columns).T
    return total


def _similar(
    left: _Rows, right: _Rows, same: bool, threshold: float, best: int | None
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Pairs above the threshold that share no earlier indexed word: a, b, score.

    Each pair comes once with a < b, or, with ``best``, once per direction and only the
    ``best`` rows of each a.
    """
    score = settled(_products(left.codes, right.codes, (left.values, right.values)))
    if same:
        score = np.triu(score, 1)
    row, col = np.nonzero(score > settled(threshold))
    first = _products(left.earlier, right.earlier, None)[row, col] == 0
    row, col = row[first], col[first]
    a, b, score = left.profile[row], right.profile[col], score[row, col]
    if best is None:
        return np.minimum(a, b), np.maximum(a, b), score
    a, b, score = np.concatenate([a, b]), np.concatenate([b, a]), np.concatenate([score, score])
    order = np.lexsort((b, -score, a))
    a, b, score = a[order], b[order], score[order]
    keep = np.arange(len(a)) - np.searchsorted(a, a, side="left") < best
    return a[keep], b[keep], score[keep]


def _joined(parts: list) -> pd.DataFrame:
    a, b, score = (np.concatenate([p[i] for p in parts]) if parts else [] for i in range(3))
    return pd.DataFrame({"a": a, "b": b, "score": score}).astype(
        {"a": "int64", "b": "int64", "score": "float64"}
    )


def profile_pairs(
    vectors: DataFrame, threshold: float = 0.4, posting_block: int = POSTING_BLOCK,
    best: int | None = None,
) -> DataFrame:
    """``a, b, score`` for profiles ``a < b`` whose cosine exceeds ``threshold`` (> 0), which
    must not be lower than the one the vectors were indexed for.

    With ``best``, rows come in both directions and every task returns at most ``best`` rows
    per word and profile (highest score, then smallest b), enough to take the ``best`` of each
    profile from.
    """
    if threshold <= 0:
        raise ValueError("the index needs a positive threshold")
    entries = _postings(vectors, posting_block)
    fields = ["word", "profile", "terms", "values", "earlier"]

    def within_words(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["word", "profile"], ignore_index=True)
        coded = _encode(rows)[0]
        edges = np.flatnonzero(rows["word"].ne(rows["word"].shift()))
        out = []
        for start, stop in zip(edges, [*edges[1:], len(rows)], strict=True):
            if stop - start > 1:
                part = coded.part(start, stop)
                out.append(_similar(part, part, True, threshold, best))
        return _joined(out)

    def between_blocks(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        if left.empty or right.empty:
            return _joined([])
        right = right.rename(columns=lambda c: c.removesuffix("_r"))
        same = left["i"].iloc[0] == left["j"].iloc[0]
        x, y = _encode(left.sort_values("profile"), right.sort_values("profile"))
        return _joined([_similar(x, y, same, threshold, best)])

    # Words that fit one block: many of them per task.
    short = entries.where(F.col("blocks") == 1)
    groups = F.greatest(
        F.lit(shuffle_width(vectors.sparkSession)).cast("long"),
        F.ceil(short.agg(F.count(F.lit(1))).scalar() / (4 * posting_block)),
    )
    inside = short.select(*fields, F.pmod(F.xxhash64("word"), groups).alias("g")).groupBy(
        "g"
    ).applyInPandas(within_words, _PAIRS)

    # Longer words: one task per pair of blocks.
    long = entries.where(F.col("blocks") > 1)
    left = long.select(
        *fields, F.col("block").alias("i"),
        F.explode(F.sequence(F.col("block"), F.col("blocks") - 1)).alias("j"),
    )
    right = long.select(
        *fields, F.explode(F.sequence(F.lit(0).cast("long"), F.col("block"))).alias("i"),
        F.col("block").alias("j"),
    )
    right = right.toDF(*[f"{c}_r" for c in right.columns])
    across = left.groupBy("word", "i", "j").cogroup(
        right.groupBy("word_r", "i_r", "j_r")
    ).applyInPandas(between_blocks, _PAIRS)
    return inside.unionByName(across)


def directed(pairs: DataFrame) -> DataFrame:
    """``profile, other, score``, one row per direction."""
    return pairs.select(F.inline(F.array(
        F.struct(F.col("a").alias("profile"), F.col("b").alias("other"), "score"),
        F.struct(F.col("b").alias("profile"), F.col("a").alias("other"), "score"),
    )))


def _own(vectors: DataFrame) -> DataFrame:
    return vectors.where(F.col("members") > 1).select(
        "profile", F.col("profile").alias("other"), F.lit(1.0).alias("score")
    )


def profile_neighbours(pairs: DataFrame, vectors: DataFrame) -> DataFrame:
    """``directed`` plus each shared profile as its own neighbour at score 1."""
    return directed(pairs).unionByName(_own(vectors))


def content_topk(
    product: DataFrame, k: int = 20, threshold: float = 0.4, posting_block: int = POSTING_BLOCK,
    vectors: DataFrame | None = None,
) -> DataFrame:
    """``product_id, rank, other_id, score``: the ``k`` most similar products, ties by id.

    Exact without writing down every similar pair: among the neighbours of a profile only the
    first ``k + 1`` profiles (by score, then smallest member), and of each only its ``k + 1``
    smallest ids, can reach a list.
    """
    vectors = content_vectors(product, threshold) if vectors is None else vectors
    members = profile_members(product, vectors)
    found = profile_pairs(vectors, threshold, posting_block, best=k + 1).select(
        F.col("a").alias("profile"), F.col("b").alias("other"), "score"
    )
    near = top_k(
        found.unionByName(_own(vectors)), "profile", [F.desc("score"), F.asc("other")], k + 1
    ).drop("rank")
    leading = top_k(members, "profile", [F.asc("product_id")], k + 1).select(
        F.col("profile").alias("other"), F.col("product_id").alias("other_id")
    )
    best = top_k(
        near.join(leading, "other"), "profile", [F.desc("score"), F.asc("other_id")], k + 1
    )
    lists = best.groupBy("profile").agg(
        F.array_sort(F.collect_list(F.struct("rank", "other_id", "score"))).alias("list")
    )
    own = members.join(lists, "profile").select(
        "product_id",
        F.slice(
            F.filter("list", lambda e: e["other_id"] != F.col("product_id")), 1, k
        ).alias("list"),
    )
    return own.select("product_id", F.posexplode("list").alias("pos", "e")).select(
        "product_id", (F.col("pos") + 1).alias("rank"),
        F.col("e.other_id").alias("other_id"), F.col("e.score").alias("score"),
    )


def content_neighbours(
    ids: DataFrame, members: DataFrame, near: DataFrame
) -> DataFrame:
    """``product_id, other_id, score``: the whole lists of the products in ``ids``."""
    asked = members.join(ids.select("product_id").distinct(), "product_id", "left_semi")
    other = members.select(
        F.col("product_id").alias("other_id"), F.col("profile").alias("other")
    )
    return (
        asked.join(near, "profile").join(other, "other")
        .where(F.col("product_id") != F.col("other_id"))
        .select("product_id", "other_id", "score")
    )


def hashed_weights(product: DataFrame, buckets: int = 500) -> DataFrame:
    """``term_weights`` with words hashed into ``buckets``, by Spark ML's own stages."""
    words = product.select("product_id", tag_words(F.col("tags")).alias("words"))
    counted = HashingTF(numFeatures=buckets, inputCol="words", outputCol="tf").transform(words)
    scaled = IDF(inputCol="tf", outputCol="features").fit(counted).transform(counted)
    # One row per distinct vector; the multiset of words still names it.
    grouped = scaled.groupBy(words_key(F.col("words")).alias("key")).agg(
        F.count(F.lit(1)).alias("members"), F.min("product_id").alias("profile"),
        F.first(vector_to_array("features")).alias("features"),
    )
    # Only the cells that hold something become rows.
    held = F.filter(
        F.transform("features", lambda w, k: F.struct(k.alias("bucket"), w.alias("weight"))),
        lambda cell: cell["weight"] > 0)
    cells = grouped.select("profile", "key", "members", F.explode(held).alias("cell")).select(
        "profile", "key", "members", F.col("cell.bucket").cast("string").alias("word"),
        F.col("cell.weight").alias("weight"))
    frequency = cells.groupBy("word").agg(
        F.sum("members").alias("df"), F.count(F.lit(1)).alias("holders")
    )
    return cells.join(frequency, "word").select(
        "profile", "key", "members", "word", "df", "holders", "weight"
    )
