import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from basketry.llm import ranking
from tests.llm import fixtures

_TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
_LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def terms(text):
    return _TERM.findall((text or "").translate(_LOWER))


def brute(docs, items, results):
    """Every document scored for every item: ``(item_id, rank, doc_id, score)``."""
    counted = [(r["doc_id"], Counter(terms(r["text"]))) for r in docs]
    n = sum(bool(c) for _, c in counted)
    length = sum(sum(c.values()) for _, c in counted)
    df = Counter(t for _, c in counted for t in c)
    out = []
    for item in items:
        scored = []
        for doc_id, c in counted:
            score = 0
            for t in set(terms(item["text"])) & set(c):
                w = math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1)))
                m = 50 + (50 * sum(c.values()) * n) // length
                score += w * ((1_000_000_000 * c[t]) // (1000 * c[t] + 20 * m))
            if score > 0:
                scored.append((-score, doc_id is not None, doc_id or 0, doc_id))
        out += [(item["item_id"], rank, d, -s) for rank, (s, _, _, d) in enumerate(
            sorted(scored)[:results], 1)]
    return sorted(out, key=str)


def found(docs, items, **options):
    got = ranking.best_documents(docs, items, **options)
    return sorted(((r["item_id"], r["rank"], r["doc_id"], r["score"]) for r in got.collect()), key=str)


def queries(spark, texts):
    return spark.createDataFrame(
        [(k, t, "x", "y") for k, t in enumerate(texts)], "item_id long, text string, doc_id string, score string")


@pytest.mark.parametrize("options", [
    {"results": 50}, {"results": 3}, {"results": 3, "paired": 0}, {"results": 2, "query_bytes": 300}])
def test_edge_cases_equal_brute_force(spark, options):
    docs = fixtures.edges(spark)
    texts = [*fixtures.edge_texts(), fixtures.prose(1, 9), "ONE two", "東京 é", "absent"]
    items = queries(spark, texts).union(queries(spark, ["one three"]))
    assert found(docs, items, **options) == brute(docs.collect(), items.collect(), options["results"])


def test_many_documents_equal_brute_force(spark):
    """Small blocks, so that bounds skip some and pairs are required in others."""
    rnd = random.Random(2)
    words = [f"w{k}" for k in range(200)]
    weights = [1 / (k + 1) for k in range(200)]
    passages = [" ".join(rnd.choices(words, weights, k=12)) for _ in range(12)]
    texts = []
    for k in range(900):
        body = rnd.choices(words, weights, k=rnd.randrange(1, 80))
        if k % 9 == 0:
            body += rnd.choice(passages).split()
        texts.append(" ".join(body))
    docs, items = fixtures.table(spark, texts), queries(spark, passages + ["w150 w151 w3", "w0", "w0 w1"])
    got = found(docs, items, results=5, block_docs=40)
    assert got == brute(docs.collect(), items.collect(), 5)


def test_nothing_to_find(spark):
    docs, items = fixtures.edges(spark), queries(spark, [None, "", "!!!"])
    assert found(docs, items) == []
    assert found(docs, items.limit(0)) == []
    assert found(fixtures.empty(spark), queries(spark, ["one two"])) == []


def test_bounds_hold_and_pairs_tighten():
    rnd = np.random.default_rng(1)
    scores = rnd.integers(1, 100, (30, 6)) * (rnd.random((30, 6)) < 0.4)
    most = scores.max(axis=0)
    pairs = []
    for a in range(6):
        for b in range(a + 1, 6):
            both = (scores[:, a] > 0) & (scores[:, b] > 0)
            pairs.append((a, b, int((scores[:, a] + scores[:, b])[both].max(initial=0))))
    units = ranking.bounds(most, pairs)
    assert sorted(t for _, u in units for t in u) == np.flatnonzero(most).tolist()
    for row in scores:
        for bound, unit in units:
            assert row[list(unit)].sum() <= bound
    assert sum(b for b, _ in units) < most.sum()
    assert ranking.bounds(most, []) == sorted((int(m), (k,)) for k, m in enumerate(most) if m)
