import random

import numpy as np
from pyspark.sql import functions as F

from basketry.llm import shingles, texts
from basketry.llm.components import components
from tests.llm import fixtures


def sets(text):
    w = fixtures.words(text)
    return {tuple(w[k:k + 5]) for k in range(max(1, len(w) - 4))} if w else set()


def brute_force(docs):
    """Links (other rows, other sets) and groups of all rows, by comparing every two."""
    found = [sets(t) for _, t in docs]
    near = [[bool(a) and 5 * len(a & b) >= 4 * len(a | b) for b in found] for a in found]
    group = list(range(len(docs)))
    for _ in docs:
        for a in range(len(docs)):
            for b in range(len(docs)):
                if near[a][b]:
                    group[a] = group[b] = min(group[a], group[b])
    return found, near, group


def check(spark, texts):
    docs = list(enumerate(texts))
    got = {r["doc_id"]: r for r in shingles.near_duplicates(
        fixtures.table(spark, texts)).collect()}
    found, near, group = brute_force(docs)
    for k in range(len(docs)):
        assert got[k]["class_id"] == group[k]
        assert got[k]["n_links"] == sum(n for j, n in enumerate(near[k]) if j != k)
        others = {frozenset(found[j]) for j in range(len(docs)) if near[k][j]} - {frozenset(found[k])}
        assert got[k]["n_text_links"] == len(others)


def test_edges_against_brute_force(spark):
    check(spark, fixtures.edge_texts())


def test_groups_against_brute_force(spark):
    base, other = fixtures.prose(20, 120), fixtures.prose(21, 300)
    texts = [fixtures.change(base, every, every) for every in (30, 40, 50, 60, 70, 80)]
    texts += [fixtures.change(texts[0], 45, k) for k in range(12)]
    texts += [fixtures.change(other, 90, k) for k in range(12)] + [base, base, other.upper()]
    texts += [fixtures.prose(200 + k, 60) for k in range(20)]
    check(spark, texts)


def test_large_buckets_are_cut_without_loss(spark):
    base = fixtures.prose(30, 150)
    docs = fixtures.table(spark, [fixtures.change(base, 100, k) for k in range(40)])
    docs = texts.keyed(texts.with_row(docs, "row"), "row")
    sketches = shingles.sketch(docs, 5, shingles.prefix_length())
    whole = shingles.links(docs, sketches, 5, 0.8)[1]
    cut = shingles.links(docs, sketches, 5, 0.8, piece=7)[1]
    total = lambda df: {bytes(r["u"]): (r["s"], r["d"]) for r in df.groupBy("u").agg(
        F.sum("sets").alias("s"), F.sum("docs").alias("d")).collect()}
    assert total(whole) == total(cut)
    assert len(total(whole)) == 40


def test_prefix_length_reaches_the_recall():
    k = shingles.prefix_length(0.8, 0.99, 10, 8)
    assert 1 - (1 - 0.8 ** k) ** 10 >= 0.99 > 1 - (1 - 0.8 ** (k + 1)) ** 10


def test_drop_keeps_one_of_each_class(spark):
    docs = fixtures.edges(spark)
    kept = shingles.drop_near_duplicates(docs)
    assert kept.columns == docs.columns
    ids = [r["doc_id"] for r in kept.collect()]
    assert {7, 0, 1, 2, 3, 4, None} <= set(ids) and 8 not in ids and 900 not in ids


def test_repeated_rows_are_copies(spark):
    got = shingles.near_duplicates(fixtures.table(spark, ["a b c d e f"] * 3, [5, 5, 9])).collect()
    assert sorted((r["doc_id"], r["class_id"], r["n_links"]) for r in got) == [
        (5, 5, 2), (5, 5, 2), (9, 5, 2)]


def test_empty_table(spark):
    assert shingles.near_duplicates(fixtures.empty(spark)).count() == 0


def test_components(spark):
    rnd = random.Random(3)
    pairs = [(rnd.randrange(300), rnd.randrange(300)) for _ in range(200)] + [
        (k, k + 1) for k in range(400, 440)] + [(5, 5), (None, 3)]
    label = {}
    for a, b in pairs:
        if None not in (a, b) and a != b:
            x, y = label.setdefault(a, a), label.setdefault(b, b)
            label = {k: min(x, y) if v in (x, y) else v for k, v in label.items()}
    got = components(spark.createDataFrame(pairs, "a long, b long"))
    assert {r["node"]: r["label"] for r in got.collect()} == label
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_rows_of_one_doc_id_are_documents_of_their_own(spark):
    base, other = fixtures.prose(20, 60), fixtures.prose(21, 60)
    docs = fixtures.table(spark, [base, base, base, base, other, other, None, None],
                          [1, 1, None, None, 1, 2, 1, None])
    kept = [(r["doc_id"], r["text"]) for r in shingles.drop_near_duplicates(docs).collect()]
    assert sorted(kept, key=str) == sorted(
        [(None, base), (1, other), (1, None), (None, None)], key=str)


def test_pieces_of_few_shingles_give_the_same_links(spark, monkeypatch):
    base = fixtures.prose(22, 300)
    docs = fixtures.table(spark, [fixtures.change(base, 60, k) for k in range(30)])
    key = lambda: sorted(map(tuple, shingles.near_duplicates(docs).collect()))
    whole = key()
    monkeypatch.setattr(shingles, "PIECE_SHINGLES", 1000)
    assert key() == whole and all(r[2] > 0 for r in whole)


def test_overlaps_of_many_sets():
    rnd = np.random.default_rng(5)
    left, right = ([np.unique(rnd.integers(0, 9000, n, dtype=np.uint64)) for n in sizes]
                   for sizes in ((1, 50, 3000, 0, 700), (20, 8000, 5, 900)))
    want = [[len(np.intersect1d(x, y)) for y in right] for x in left]
    assert shingles._overlaps(left, right).tolist() == want
