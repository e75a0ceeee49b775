import re
from itertools import permutations

import pytest
from pyspark.sql import functions as F

from basketry.llm import filters
from tests.llm import fixtures

LABELS = "doc_id long, quality int, toxic int"


def brute(docs, labels):
    """Every order applied for itself."""
    good = {r["doc_id"] for r in labels if r["quality"] == 1 and r["doc_id"] is not None}
    toxic = {r["doc_id"] for r in labels if r["toxic"] == 1 and r["doc_id"] is not None}
    failing = []
    for r in docs:
        text = r["text"] or ""
        words = [w for w in re.split(r"[\x20\x09-\x0D]+", text) if w]
        ids = [d["doc_id"] for d in docs if (d["text"] or "") == text and d["doc_id"] is not None]
        failing.append({
            "A": len(words) < 50, "B": 100 * len(set(words)) < 65 * len(words),
            "C": 100 * sum("A" <= c <= "Z" for c in text) > 5 * len(text),
            "D": any(c in "#$%&*|" for c in text),
            "E": r["doc_id"] is not None and min(ids) < r["doc_id"]})
    out, shares = {}, {}
    for part in {r["source"] or "" for r in docs}:
        rows = [k for k, r in enumerate(docs) if (r["source"] or "") == part]
        for order in map("".join, permutations("ABCDE")):
            left = set(rows)
            for step, c in enumerate(order, 1):
                gone = {k for k in left if failing[k][c]}
                out[part, order, step] = (
                    len(left - gone), len(gone),
                    sum(failing[k][c] and k not in left for k in rows),
                    sum(failing[k][c] and sum(failing[k].values()) == 1 for k in rows),
                    sum(docs[k]["doc_id"] in good for k in gone),
                    sum(docs[k]["doc_id"] in toxic for k in gone))
                shares[part, c] = shares.get((part, c), 0) + len(gone)
                left -= gone
    return {(p, o, s): (*v, shares[p, o[s - 1]]) for (p, o, s), v in out.items()}


def audit(spark, docs, labels):
    cells = filters.write_step(filters.judged(docs, labels), "cells")
    names = ["kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]
    found = filters.audit(cells).collect()
    out = {(r["part"], r["filter_order"], r["step"]): tuple(r[n] for n in names) for r in found}
    assert len(out) == len(found)
    return out


def test_equals_every_order_for_itself(spark):
    found = fixtures.edge_texts()
    ids = [*range(len(found)), None, None, 3, 50, 50, 60]
    texts = [*found, found[7], "", found[7], found[7], found[7], "# " + fixtures.prose(3, 90)]
    docs = fixtures.table(spark, texts, ids)
    docs = docs.withColumn("source", F.expr(
        "case when doc_id % 3 = 0 then 'a' when doc_id % 3 = 1 then '' end"))
    labels = spark.createDataFrame(
        [(0, 1, 0), (1, 0, 1), (7, 1, 1), (8, 1, None), (8, 0, 1), (50, 1, 0), (None, 1, 1), (99, 1, 1)],
        LABELS)
    assert audit(spark, docs, labels) == brute(docs.collect(), labels.collect())


def test_empty_tables(spark):
    none = spark.createDataFrame([], LABELS)
    assert audit(spark, fixtures.empty(spark), none) == {}
    docs = fixtures.table(spark, ["a b", None])
    got = audit(spark, docs, none)
    assert len(got) == 600 and got["s", "ABCDE", 1] == (0, 2, 0, 2, 0, 0, 240)


def test_other_letters(spark):
    cells = spark.createDataFrame([("p", 0, False, False, 5), ("p", 3, True, False, 2), ("p", 4, False, True, 1)],
                                  "part string, mask int, good boolean, toxic boolean, n long")
    got = {(r["filter_order"], r["step"]): (r["kept"], r["removed"], r["redundant"], r["shapley"])
           for r in filters.audit(cells, "xyz").collect()}
    assert len(got) == 18
    assert got["xyz", 1] == (6, 2, 0, 6) and got["xyz", 2] == (6, 0, 2, 6) and got["xyz", 3] == (5, 1, 0, 6)


@pytest.mark.parametrize("text, bits", [
    ("", 1), ("a " * 49, 3), ("a " * 50, 2), ("ABC", 5), ("x & y", 9),
    (" ".join(f"w{k}" for k in range(50)), 0)])
def test_bits(spark, text, bits):
    docs = spark.createDataFrame([(text,)], "text string")
    assert docs.select(filters.own_bits(docs["text"])).first()[0] == bits
