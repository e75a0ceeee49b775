import math
import random
from collections import Counter

import numpy as np
import pytest
from pyspark.ml.feature import IDF, HashingTF
from pyspark.sql import functions as F

from basketry.functions.text import tag_words
from basketry.operators import content
from tests.conftest import rows


def sample(seed, n=60, copies=25):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(14)]
    data = []
    for i in range(n):
        tags = [words[min(rng.randrange(14), rng.randrange(14))] for _ in range(rng.randrange(1, 5))]
        data.append((i * 3, "|".join(tags)))
    data += [(1000 + i, "w1|w2|w9") for i in range(copies)]  # one profile holds a third
    data += [(5000, "everywhere"), (5001, "")]
    return [(i, t + "|all") for i, t in data]  # a word of zero weight


def brute(data, threshold=0.4):
    docs = {i: Counter(t.lower().replace("|", " ").split(" ")) for i, t in data}
    df = Counter(w for d in docs.values() for w in d)
    m = len(docs)
    vec = {}
    for i, d in docs.items():
        v = {w: tf * math.log((m + 1) / (df[w] + 1)) for w, tf in d.items()}
        norm = math.sqrt(sum(x * x for x in v.values()))
        if norm:
            vec[i] = {w: x / norm for w, x in v.items() if x}
    found = {}
    for a, va in vec.items():
        for b, vb in vec.items():
            if a != b:
                s = round(sum(x * vb.get(w, 0.0) for w, x in va.items()), 6)
                if s > threshold:
                    found[a, b] = s
    return found


@pytest.mark.parametrize("block", [1024, 3])
@pytest.mark.parametrize("threshold", [0.4, 0.75])
def test_profile_pairs_are_complete(spark, block, threshold):
    data = sample(1)
    product = spark.createDataFrame(data, "product_id long, tags string")
    vectors = content.content_vectors(product, threshold)
    pairs = content.profile_pairs(vectors, threshold, block)
    assert pairs.count() == pairs.select("a", "b").distinct().count()
    near = content.profile_neighbours(pairs, vectors)
    got = content.content_neighbours(product, content.profile_members(product, vectors), near).collect()
    want = brute(data, threshold)
    assert {(r[0], r[1]) for r in got} == set(want)
    for r in got:
        assert r["score"] == pytest.approx(want[r[0], r[1]], abs=2e-6)


@pytest.mark.parametrize("k", [1, 5, 30])
def test_topk_equals_the_cut_of_the_whole_list(spark, k):
    data = sample(2)
    product = spark.createDataFrame(data, "product_id long, tags string")
    want = set()
    lists = {}
    for (a, b), s in brute(data).items():
        lists.setdefault(a, []).append((-s, b))
    for a, found in lists.items():
        want |= {(a, i + 1, b) for i, (_, b) in enumerate(sorted(found)[:k])}
    got = rows(content.content_topk(product, k, posting_block=4), "product_id", "rank", "other_id")
    assert got == sorted(want)


@pytest.mark.parametrize("block", [1024, 3])
def test_hashed_pairs_equal_all_ml_vectors(spark, block):
    data = sample(3)
    product = spark.createDataFrame(data, "product_id long, tags string")
    words = product.select("product_id", tag_words(F.col("tags")).alias("words"))
    counted = HashingTF(numFeatures=50, inputCol="words", outputCol="tf").transform(words)
    scaled = IDF(inputCol="tf", outputCol="f").fit(counted).transform(counted)
    vec = {r["product_id"]: r["f"].toArray() for r in scaled.collect()}
    want = {}
    for a, x in vec.items():
        for b, y in vec.items():
            norm = np.linalg.norm(x) * np.linalg.norm(y)
            if a != b and norm and round(float(x @ y / norm), 6) > 0.4:
                want[a, b] = float(x @ y / norm)
    vectors = content.unit_vectors(content.hashed_weights(product, buckets=50), 0.4)
    near = content.profile_neighbours(content.profile_pairs(vectors, 0.4, block), vectors)
    got = content.content_neighbours(
        product, content.profile_members(product, vectors), near).collect()
    assert {(r[0], r[1]) for r in got} == set(want)
    for r in got:
        assert r["score"] == pytest.approx(want[r[0], r[1]], abs=2e-6)


def test_empty(spark):
    product = spark.createDataFrame([], "product_id long, tags string")
    assert content.content_topk(product).count() == 0
