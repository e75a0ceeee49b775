import math
from collections import Counter

import numpy as np
import pytest

from basketry.operators import dense
from tests.conftest import rows


def vectors(spark, n, d, seed):
    rng = np.random.default_rng(seed)
    m = rng.normal(size=(n, d))
    m[3] = 0.0
    if n > 9:
        m[9] = m[8]
    ids = [int(x) * 7 - 20 for x in range(n)]
    frame = spark.createDataFrame(
        [(i, [float(x) for x in v]) for i, v in zip(ids, m)], "id long, vector array<float>")
    return frame, ids, m.astype("float32").astype("float64")


@pytest.mark.parametrize("block_rows", [4096, 13])
def test_cosine_pairs(spark, block_rows):
    frame, ids, m = vectors(spark, 60, 5, 1)
    norm = np.linalg.norm(m, axis=1)
    want = set()
    for i in range(len(ids)):
        for j in range(i + 1, len(ids)):
            if norm[i] and norm[j]:
                s = float(m[i] @ m[j] / norm[i] / norm[j])
                if s > 0.4:
                    want.add((min(ids[i], ids[j]), max(ids[i], ids[j]), s))
    got = rows(dense.cosine_pairs(frame, 0.4, block_rows))
    assert [g[:2] for g in got] == [w[:2] for w in sorted(want)]
    assert np.allclose([g[2] for g in got], [w[2] for w in sorted(want)], atol=2e-6)


@pytest.mark.parametrize("block_rows", [4096, 11])
def test_best_scores(spark, block_rows):
    left, lid, lm = vectors(spark, 40, 4, 2)
    right, rid, rm = vectors(spark, 33, 4, 3)
    want = []
    for i, v in zip(lid, lm):
        s = dense.settled(rm @ v)
        best = sorted((-x, j) for x, j in zip(s, rid) if x > 0)[:5]
        want += [(i, k + 1, j) for k, (_, j) in enumerate(best)]
    got = rows(dense.best_scores(left, right, 5, above=0.0, block_rows=block_rows), "id", "rank", "other_id")
    assert got == sorted(want)


def test_best_scores_skip_same(spark):
    frame, ids, _ = vectors(spark, 30, 4, 4)
    got = dense.best_scores(frame, frame, 3, above=-2.0, unit=True, skip_same=True).collect()
    assert all(r["id"] != r["other_id"] for r in got)
    twins = {r["id"]: r["other_id"] for r in got if r["rank"] == 1}
    assert twins[ids[8]] == ids[9]
    assert twins[ids[9]] == ids[8]
    assert ids[3] not in twins


def test_threshold_uses_the_unrounded_score(spark):
    third = (1 - 0.4000003 ** 2) ** 0.5
    frame = spark.createDataFrame(
        [(1, [1.0, 0.0]), (2, [0.4000003, third]), (3, [0.4, 0.84 ** 0.5])],
        "id long, vector array<double>")
    got = rows(dense.cosine_pairs(frame, 0.4), "a", "b")
    assert (1, 2) in got
    assert (1, 3) not in got


def test_tiny_scores_keep_their_order(spark):
    left = spark.createDataFrame([(1, [1e-4])], "id long, vector array<double>")
    right = spark.createDataFrame(
        [(k, [1e-3 + k * 1e-9]) for k in range(50)], "id long, vector array<double>")
    got = rows(dense.best_scores(left, right, 5, above=0.0), "rank", "other_id")
    assert got == [(k + 1, 49 - k) for k in range(5)]


@pytest.mark.parametrize("block_rows", [4096, 7])
def test_best_by_norm_equals_all_scores(spark, block_rows):
    left, _, _ = vectors(spark, 40, 4, 5)
    right, _, _ = vectors(spark, 70, 4, 6)
    want = rows(dense.best_scores(left, right, 5, above=0.1))
    assert rows(dense.best_by_norm(left, right, 5, above=0.1, block_rows=block_rows)) == want
    assert len(want) > 150


def test_best_by_norm_stops_early(spark):
    """Norms that fall fast: most blocks are never copied to a left block."""
    rng = np.random.default_rng(7)
    m = rng.normal(size=(400, 4)) * np.exp(-np.arange(400) / 20)[:, None]
    right = spark.createDataFrame(
        [(i, [float(x) for x in v]) for i, v in enumerate(m)], "id long, vector array<double>")
    left, _, _ = vectors(spark, 60, 4, 8)
    trace = []
    got = rows(dense.best_by_norm(left, right, 3, above=0.0, block_rows=10, trace=trace))
    assert got == rows(dense.best_scores(left, right, 3, above=0.0))
    assert sum(a * b for a, b in trace) < 40 * 6 / 2


def test_best_by_norm_of_equal_norms_and_nothing(spark):
    ring = [(k, [float(np.cos(k)), float(np.sin(k))]) for k in range(50)]
    frame = spark.createDataFrame(ring, "id long, vector array<double>")
    assert rows(dense.best_by_norm(frame, frame, 2, block_rows=5)) == rows(
        dense.best_scores(frame, frame, 2, above=0.0))
    assert dense.best_by_norm(frame, frame.limit(0), 2).count() == 0
    assert dense.best_by_norm(frame.limit(0), frame, 2).count() == 0


@pytest.mark.parametrize("piece", [1024, 9])
def test_lsh_finds_the_pairs(spark, piece):
    rng = np.random.default_rng(9)
    centres = rng.normal(size=(12, 16))
    m = np.repeat(centres, 10, axis=0) + rng.normal(size=(120, 16)) * 0.8
    m[5] = 0
    frame = spark.createDataFrame(
        [(i * 3, [float(x) for x in v]) for i, v in enumerate(m)], "id long, vector array<double>")
    exact = {r[:2]: r[2] for r in rows(dense.cosine_pairs(frame, 0.5))}
    found = {r[:2]: r[2] for r in rows(dense.cosine_pairs_lsh(frame, 0.5, piece=piece))}
    assert set(found) <= set(exact) and len(found) >= 0.95 * len(exact) > 300
    assert all(abs(found[p] - exact[p]) < 1e-9 for p in found)
    assert dense.lsh_tables(0.5, 0.99, 8) > dense.lsh_tables(0.8, 0.99, 8)


def test_a_left_block_leaves_one_list_per_run(spark, monkeypatch):
    """Many right blocks: a row's list is kept over a run of them, and left blocks are few."""
    left, _, _ = vectors(spark, 300, 4, 10)
    right, _, _ = vectors(spark, 400, 4, 11)
    whole = rows(dense.best_scores(left, right, 5, above=0.0))
    seen, real = [], dense._multiply
    monkeypatch.setattr(dense, "_multiply", lambda *a: seen.append(real(*a)) or seen[0])
    got = dense.best_scores(left, right, 5, above=0.0, block_rows=10)
    assert rows(got) == whole
    lists = Counter(r[0] for r in rows(seen[0]))
    assert max(lists.values()) <= 5 * math.ceil(40 / dense.RUN_BLOCKS)


def test_blocks_of_one_row_need_few_stages(spark):
    left, _, _ = vectors(spark, 60, 4, 12)
    right, _, _ = vectors(spark, 400, 4, 13)
    trace = []
    got = rows(dense.best_by_norm(left, right, 3, block_rows=1, trace=trace))
    assert got == rows(dense.best_scores(left, right, 3, above=0.0))
    assert len(trace) <= 9 and sum(a * b for a, b in trace) <= 70 * 17


def test_equal_scores_go_by_id():
    best = dense._Best(1, 2, 0.0)
    for ids in ([7, 8], [3, 9], [5, 1]):
        best.meet(np.ones((1, 1)), np.array(ids), np.ones((2, 1)))
    assert best.ids.tolist() == [[1, 3]] and best.scores.tolist() == [[1.0, 1.0]]


def test_blocks_meet_once_with_few_copies(spark):
    packed = spark.range(300).withColumnRenamed("id", "block")
    sides, tasks = dense._pair_sides(packed, 300)
    dealt = sides.collect()
    # One copy per block it meets would be 300 * 301.
    assert len(dealt) < 300 * 301 / 10
    held = {}
    for r in dealt:
        held.setdefault((r["i"], r["j"]), ([], []))[r["side"]].append(r["block"])
    met = Counter((a, b) for left, right in held.values() for a in left for b in right if a <= b)
    assert set(met.values()) == {1} and len(met) == 300 * 301 // 2
    assert len([t for t in held.values() if t[0] and t[1]]) <= tasks


@pytest.mark.parametrize("unit", (True, False))
def test_best_scores_leave_out_cells_that_hold_nothing(spark, monkeypatch, unit):
    rnd = np.random.default_rng(21)
    matrix = rnd.normal(size=(3000, 4))
    matrix[:400] = matrix[0]
    matrix[400:410] = 0
    frame = spark.createDataFrame(
        [(k, v) for k, v in enumerate(matrix.tolist())], "id long, vector array<double>")
    monkeypatch.setattr(dense, "LEAST_ROWS", 60)
    monkeypatch.setattr(dense, "CELL_ROWS", 1)
    best = dense._Best(3000, 5, 0.1)
    cells, blocks = dense._celled(frame, 64, 60, unit)
    packed = [dense._unpack(r.asDict()) for r in dense._pack(cells, unit).collect()]
    assert sum(len(ids) for ids, _ in packed) == (2990 if unit else 3000)
    # Four hundred times one vector are no cell of their own.
    assert len(packed) <= blocks and max(len(ids) for ids, _ in packed) <= 2 * 60 + 60
    offered = []
    meet = best.meet
    best.meet = lambda vectors, ids, matrix, some=None, own=None: (
        offered.append(len(some) * len(ids)), meet(vectors, ids, matrix, some, own))
    rows = matrix / np.maximum(np.sqrt((matrix ** 2).sum(axis=1, keepdims=True)), 1e-9) if unit else matrix
    best.meet_cells(rows, packed, np.arange(3000), unit)
    assert sum(offered) < 3000 * 3000 / 2
    found = dense.best_scores(frame, frame, 5, above=0.1, unit=unit, skip_same=True).collect()
    score = dense.settled(rows @ rows.T)
    np.fill_diagonal(score, -np.inf)
    want = set()
    for row in range(3000):
        order = np.lexsort((np.arange(3000), -score[row]))[:5]
        want |= {(row, r + 1, int(o)) for r, o in enumerate(order) if score[row, o] > 0.1}
    assert {(r["id"], r["rank"], r["other_id"]) for r in found} == want


def test_tables_of_signatures_are_dealt_in_rounds(spark, monkeypatch):
    frame, _, _ = vectors(spark, 300, 8, 5)
    dealt, cut = [], dense.cut_lineage
    monkeypatch.setattr(dense, "cut_lineage", lambda df, label: dealt.append(label) or cut(df, label))
    found = {}
    for size in (4, 1000):
        monkeypatch.setattr(dense, "LSH_ROUND", size)
        found[size] = rows(dense.cosine_pairs_lsh(frame, 0.6, 0.9, bits=6))
    assert found[4] == found[1000] and len(found[4]) > 50
    assert dealt.count("met") == math.ceil(dense.lsh_tables(0.6, 0.9, 6) / 4) + 1


def test_blocks_keep_the_precision_of_the_vectors(spark):
    frame, ids, m = vectors(spark, 40, 6, 9)
    for kind, size in (("array<float>", 4), ("array<double>", 8)):
        for row in dense._pack(dense._hashed(frame.selectExpr("id", f"cast(vector as {kind}) vector"), 3),
                               unit=True).collect():
            got, matrix = dense._unpack(row.asDict(), unit=True)
            want = m[[ids.index(i) for i in got]]
            assert len(row["matrix"]) == size * want.size and 3 * 7 - 20 not in got
            assert np.array_equal(matrix, want / np.sqrt((want * want).sum(axis=1))[:, None])
