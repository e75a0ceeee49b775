"""All-pairs scores of dense vectors, as products of bounded blocks.

Vectors are hashed by id into blocks of about ``block_rows`` rows (ids are unique, so blocks
are even whatever the data looks like). Each block is packed into one row; every pair of
blocks meets in one task that multiplies two matrices and returns only what passes the threshold,
or only the best ``k`` per row. A task holds a few left blocks (or a larger one, for the best) and
reads a bounded run of others, so that a row is copied a number of times that grows slowly, and of
the best leaves a few lists only.

For the best, right blocks are cells of near vectors, with a centre and a radius. A left row meets
the cell of its highest bound first, and then those whose bound reaches its ``k``-th score: all others
hold nothing for it. Short vectors meet a small part of the cells, long ones all of them.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketry.operators.lists import top_k
from basketry.runtime import cut_lineage, shuffle_width

#: Rows of a block: 4096 rows of 64 doubles are 2 MB.
BLOCK_ROWS = 4096
#: Rows of the left block multiplied at a time, which bounds the score matrix.
_STRIPE = 512
#: Times that a left block of best scores may be larger, and the right blocks a task of pairs holds
#: with it.
LEFT_FACTOR, RUN_BLOCKS = 8, 32
#: Numbers that a row of such a left block has with its list.
LEFT_WIDTH = 104
#: Numbers of the right vectors that a task of best scores holds: 64 MB.
RUN_NUMBERS = 1 << 23
#: Rows of a cell per number of a vector, and at least; cells at most; numbers that show where to cut.
CELL_ROWS, LEAST_ROWS, CELLS, SHOWN = 256, 1024, 4096, 1 << 20
_PACKED = "block long, ids binary, matrix binary, width int"


def _busy_blocks(rows: int, cores: int) -> int:
    return max(1, min(math.ceil(rows / 256), math.ceil(math.sqrt(2 * cores))))


def _block_count(df: DataFrame, block_rows: int) -> int:
    """Blocks of at most ``block_rows``, but enough of them to keep the cores busy."""
    rows = df.count()
    cores = df.sparkSession.sparkContext.defaultParallelism
    return max(math.ceil(rows / block_rows), _busy_blocks(rows, cores))


def _hashed(df: DataFrame, blocks: int) -> DataFrame:
    """``block, id, vector`` of the rows that have both."""
    return df.where(F.col("id").isNotNull() & F.col("vector").isNotNull()).select(
        F.pmod(F.xxhash64("id"), F.lit(blocks)).alias("block"), F.col("id").cast("long"), "vector"
    )


def _norms(matrix: np.ndarray) -> np.ndarray:
    return np.sqrt((matrix * matrix).sum(axis=1))


def _matrix(vectors: pd.Series, unit: bool) -> np.ndarray:
    """Rows of doubles, scaled to length 1 if ``unit`` (zero vectors stay)."""
    matrix = np.stack(vectors.to_numpy()).astype("float64")
    if unit:
        norm = _norms(matrix)
        matrix[norm > 0] /= norm[norm > 0, None]
    return matrix


def _cuts(matrix: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """Column and value at which each node of a binary tree divides the rows evenly: the column
    that varies most. Children of ``n`` are ``2n + 1`` and ``2n + 2``."""
    column, value = np.zeros((1 << depth) - 1, np.int64), np.zeros((1 << depth) - 1)
    parts = {0: matrix[np.isfinite(matrix).all(axis=1)]}
    for node in range(len(column)):
        rows = parts.pop(node)
        if len(rows):
            column[node] = rows.var(axis=0).argmax()
            value[node] = np.median(rows[:, column[node]])
        right = rows[:, column[node]] > value[node]
        parts[2 * node + 1], parts[2 * node + 2] = rows[~right], rows[right]
    return column, value


def _celled(df: DataFrame, cells: int, cell_rows: int, unit: bool) -> tuple[DataFrame, int]:
    """``block, id, vector`` of the rows that have both, where the rows of a block are near each
    other, and how many blocks. Some rows show where to cut; a cell with more rows than it should
    have, as of one vector many times, is divided by id."""
    rows = df.where(F.col("id").isNotNull() & F.col("vector").isNotNull()).select(
        F.col("id").cast("long"), "vector")
    depth = max(0, math.ceil(math.log2(max(cells, 1))))
    head = rows.select(F.size("vector").alias("width")).first() if depth else None
    if head is None:
        return _hashed(df, cells), cells
    wanted = max(1, SHOWN // max(head["width"], 1))
    shown = rows.select("vector").orderBy(F.xxhash64("id")).limit(min(wanted, 64 * cells)).toPandas()
    column, value = _cuts(_matrix(shown["vector"], unit), depth)

    def place(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            if not len(frame):
                continue
            matrix, node = _matrix(frame["vector"], unit), np.zeros(len(frame), np.int64)
            for _ in range(depth):
                node = 2 * node + 1 + (matrix[np.arange(len(node)), column[node]] > value[node])
            yield frame.assign(cell=node - len(column))

    kind = df.schema["vector"].dataType.simpleString()
    placed = cut_lineage(rows.mapInPandas(place, f"id long, vector {kind}, cell long"), "cells")
    sizes = {r["cell"]: r["count"] for r in placed.groupBy("cell").count().collect()}
    parts = np.array([max(1, math.ceil(sizes.get(c, 0) / (2 * cell_rows))) for c in range(1 << depth)])
    first = (np.cumsum(parts) - parts).tolist()
    of_cell = F.col("cell").cast("int")
    several = parts.max() > 1
    spread = F.pmod(F.xxhash64("id"), F.get(F.lit(parts.tolist()), of_cell)) if several else F.lit(0)
    block = (F.get(F.lit(first), of_cell) + spread) if several else F.col("cell")
    return placed.select(block.cast("long").alias("block"), "id", "vector"), int(parts.sum())


def _pack(placed: DataFrame, unit: bool) -> DataFrame:
    """One row per block of ``block, id, vector``: ids and row-major matrix, in the precision it has;
    without zero vectors if ``unit``."""
    kind = "float32" if placed.schema["vector"].dataType.simpleString() == "array<float>" else "float64"

    def pack(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("id")
        matrix = np.stack(rows["vector"].to_numpy()).astype(kind)
        ids = rows["id"].to_numpy("int64")
        if unit:
            some = _norms(matrix.astype("float64")) > 0
            ids, matrix = ids[some], matrix[some]
        return pd.DataFrame({
            "block": [rows["block"].iloc[0]], "ids": [ids.tobytes()],
            "matrix": [matrix.tobytes()], "width": [matrix.shape[1]],
        })

    return placed.groupBy("block").applyInPandas(pack, _PACKED)


def _unpack(row: pd.Series | dict, unit: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """Ids and rows of doubles, scaled to length 1 if ``unit``."""
    ids, width = np.frombuffer(row["ids"], dtype="int64"), row["width"]
    half = len(row["matrix"]) < 8 * len(ids) * width
    matrix = np.frombuffer(row["matrix"], "float32" if half else "float64").reshape(len(ids), width)
    matrix = matrix.astype("float64", copy=False)
    return ids, matrix / _norms(matrix)[:, None] if unit else matrix


def _multiply(left: DataFrame, right: DataFrame, tasks: int, kernel, schema: str) -> DataFrame:
    """Run ``kernel`` on every (i, j) pair of blocks present on both sides."""
    # Own names on the right: both sides may come from the same rows.
    right = right.toDF(*[f"{c}_r" for c in right.columns])
    # A fixed width: these rows are few and heavy, so merging partitions by size is wrong.
    width = min(tasks, max(shuffle_width(left.sparkSession),
                           left.sparkSession.sparkContext.defaultParallelism))
    a = left.repartition(width, "i", "j").groupBy("i", "j")
    b = right.repartition(width, "i_r", "j_r").groupBy("i_r", "j_r")

    def named(x: pd.DataFrame, y: pd.DataFrame) -> pd.DataFrame:
        return kernel(x, y.rename(columns=lambda c: c.removesuffix("_r")))

    return a.cogroup(b).applyInPandas(named, schema)


def settled(score: np.ndarray) -> np.ndarray:
    """Scores to 40 significant bits, so that neither a tie nor a threshold depends on the
    order in which a product was summed."""
    part, exponent = np.frexp(score)
    return np.ldexp(np.rint(np.ldexp(part, 40)), exponent - 40)


def _stripes(a: np.ndarray, b: np.ndarray):
    for start in range(0, len(a), _STRIPE):
        yield start, a[start:start + _STRIPE] @ b.T


def _pair_sides(packed: DataFrame, blocks: int) -> tuple[DataFrame, int]:
    """The packed blocks, dealt to tasks ``i, j``, and how many tasks. A task holds several left
    blocks (side 0) and meets a run of right blocks (side 1) that do not come before them, so a
    block is copied once per task it is on a side of, not once per block it meets."""
    cores = packed.sparkSession.sparkContext.defaultParallelism
    # As many as leave the cores busy.
    most = max(1, math.floor(blocks / math.sqrt(8 * cores)))
    joint, run = min(LEFT_FACTOR, most), min(RUN_BLOCKS, most)
    runs = math.ceil(blocks / run)
    left = F.floor(F.col("block") / joint)
    sides = packed.select(
        left.alias("i"),
        F.explode(F.sequence(F.floor(left * joint / run), F.lit(runs - 1).cast("long"))).alias("j"),
        F.lit(0).alias("side"), "*",
    ).unionByName(packed.select(
        F.explode(F.sequence(F.lit(0).cast("long"), left)).alias("i"),
        F.floor(F.col("block") / run).alias("j"), F.lit(1).alias("side"), "*"))
    return sides, sum(runs - i * joint // run for i in range(math.ceil(blocks / joint)))


def cosine_pairs(
    vectors: DataFrame, threshold: float = 0.4, block_rows: int = BLOCK_ROWS
) -> DataFrame:
    """``a, b, score`` for every unordered pair ``a < b`` of ``id, vector`` rows whose cosine
    exceeds ``threshold``. Zero vectors are similar to nothing."""
    blocks = _block_count(vectors, block_rows)
    sides, tasks = _pair_sides(_pack(_hashed(vectors, blocks), unit=True), blocks)
    # A fixed width: these rows are few and heavy, so merging partitions by size is wrong.
    dealt = sides.repartition(tasks, "i", "j").sortWithinPartitions("i", "j", "side", "block")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, held = None, []
        for batch in batches:
            for at in range(batch.num_rows):
                row = {name: batch.column(name)[at].as_py() for name in batch.schema.names}
                if task != (row["i"], row["j"]):
                    task, held = (row["i"], row["j"]), []
                block = (row["block"], *_unpack(row, unit=True))
                if row["side"] == 0:
                    held.append(block)
                else:
                    for left in held:
                        if left[0] <= block[0]:
                            yield from near(*left, *block)

    def near(x: int, ids_a: np.ndarray, a: np.ndarray, y: int, ids_b: np.ndarray, b: np.ndarray
             ) -> Iterator[pa.RecordBatch]:
        for start, score in _stripes(a, b):
            row, col = np.nonzero(score >= threshold - 1e-9)
            value = settled(score[row, col])
            first, second = ids_a[row + start], ids_b[col]
            keep = value > settled(threshold)
            if x == y:
                keep &= first < second
            yield pa.record_batch([
                pa.array(np.minimum(first, second)[keep]), pa.array(np.maximum(first, second)[keep]),
                pa.array(value[keep])], ["a", "b", "score"])

    return dealt.mapInArrow(run, "a long, b long, score double")


def best_scores(
    left: DataFrame,
    right: DataFrame,
    k: int,
    above: float,
    unit: bool = False,
    skip_same: bool = False,
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """``id, rank, other_id, score``: per left row the ``k`` right rows with the highest dot
    product (cosine if ``unit``) above ``above``; equal scores go by id."""
    n_left = left.count()
    cores = left.sparkSession.sparkContext.defaultParallelism
    n_right = right.count()
    head = right.where("vector is not null").select(F.size("vector").alias("width")).first()
    width = max(head["width"], 1) if head else 1
    # A left block is met by every right row, so it is as large as leaves the cores busy. It holds
    # a vector and a list of each of its rows.
    most = max(block_rows, LEFT_FACTOR * block_rows * LEFT_WIDTH // (width + 2 * k))
    rows_l = min(max(block_rows, math.ceil(n_left / (4 * cores))), most)
    blocks_l = max(_busy_blocks(n_left, cores), math.ceil(n_left / rows_l))
    cell_rows = max(min(block_rows, max(LEAST_ROWS, CELL_ROWS * width)), math.ceil(n_right / CELLS))
    cells, blocks_r = _celled(
        right, max(math.ceil(n_right / cell_rows), _busy_blocks(n_right, cores)), cell_rows, unit)
    # A task holds its left block and a run of right blocks.
    runs = max(math.ceil(n_right * width / RUN_NUMBERS), min(blocks_r, math.ceil(2 * cores / blocks_l)))
    a = _pack(_hashed(left, blocks_l), unit).withColumn(
        "j", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(runs - 1).cast("long")))
    ).withColumn("i", F.col("block"))
    b = _pack(cells, unit).withColumn(
        "i", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(blocks_l - 1).cast("long")))
    ).withColumn("j", F.col("block") % runs)

    def kernel(x: pd.DataFrame, y: pd.DataFrame) -> pd.DataFrame:
        if not len(x):
            return pd.DataFrame({"id": [], "other_id": [], "score": []})
        ids, vectors = _unpack(x.iloc[0], unit)
        best = _Best(len(ids), k, above)
        best.meet_cells(vectors, [_unpack(row, unit) for _, row in y.sort_values("block").iterrows()],
                        ids if skip_same else None, unit)
        row = np.repeat(np.arange(len(ids)), k)[best.held().ravel()]
        return pd.DataFrame({
            "id": ids[row], "other_id": best.ids[best.held()], "score": best.scores[best.held()]})

    found = _multiply(a, b, blocks_l * runs, kernel, "id long, other_id long, score double")
    best = top_k(found, "id", [F.desc("score"), F.asc("other_id")], k)
    return best.select("id", "rank", "other_id", "score")


class _Best:
    """The ``k`` best right rows of each left row so far, best first; equal scores go by id."""

    def __init__(self, n: int, k: int, above: float) -> None:
        self.k, self.above = k, settled(above)
        self.scores, self.ids = np.full((n, k), -np.inf), np.zeros((n, k), np.int64)

    def held(self) -> np.ndarray:
        return self.scores > -np.inf

    def floor(self) -> np.ndarray:
        """What a score must reach to matter."""
        return np.maximum(self.scores[:, -1], self.above)

    def meet_cells(self, vectors: np.ndarray, cells: list[tuple[np.ndarray, np.ndarray]],
                   own: np.ndarray | None, unit: bool) -> None:
        """Offer the right rows of all cells (ids and vectors) to all left rows that they can
        matter to."""
        cells = [cell for cell in cells if len(cell[0])]
        centres = [matrix.mean(axis=0) for _, matrix in cells]
        radii = [np.sqrt(((matrix - c) ** 2).sum(axis=1).max()) for (_, matrix), c in zip(cells, centres)]
        norms = _norms(vectors)

        def bounds(place: int) -> np.ndarray:
            """What no score of the cell exceeds."""
            towards = vectors @ centres[place]
            bound = towards + norms * radii[place]
            if unit:
                # Of vectors of length 1, the distance decides the score.
                c = centres[place]
                apart = np.sqrt(np.maximum(1 + c @ c - 2 * towards, 0)) - radii[place]
                bound = np.minimum(bound, 1 - np.maximum(apart, 0) ** 2 / 2)
            # Rounding is far smaller than this.
            bound += (norms * (1 + np.sqrt(centres[place] @ centres[place]) + radii[place])) * 1e-9
            return np.where(np.isnan(bound), np.inf, bound)

        first, most = np.full(len(vectors), -1), np.full(len(vectors), -np.inf)
        for place in range(len(cells)):
            bound = bounds(place)
            first = np.where(bound > most, place, first)
            most = np.maximum(most, bound)
        order = np.argsort(first, kind="stable")
        starts = np.searchsorted(first[order], np.arange(len(cells) + 1))
        for place, (ids, matrix) in enumerate(cells):
            rows = order[starts[place]:starts[place + 1]]
            if len(rows):
                self.meet(vectors, ids, matrix, some=rows, own=own)
        for place, (ids, matrix) in enumerate(cells):
            rows = np.flatnonzero((bounds(place) >= self.floor()) & (first != place))
            if len(rows):
                self.meet(vectors, ids, matrix, some=rows, own=own)

    def meet(self, vectors: np.ndarray, ids: np.ndarray, matrix: np.ndarray,
             some: np.ndarray | None = None, own: np.ndarray | None = None) -> None:
        """Offer the right rows to all left rows, or ``some``; not to those of the same id if
        ``own`` are their ids."""
        some = np.arange(len(vectors)) if some is None else some
        # The score matrix is bounded, and it is only rounded where it can matter.
        step = max(1, _STRIPE * BLOCK_ROWS // max(len(ids), 1))
        for start in range(0, len(some), step):
            part = some[start:start + step]
            score = vectors[part] @ matrix.T
            if own is not None:
                score[own[part, None] == ids[None, :]] = -np.inf
            floor = self.floor()[part]
            if len(ids) > self.k and (self.scores[part, -1] == -np.inf).any():
                floor = np.maximum(floor, np.partition(score, -self.k, axis=1)[:, -self.k])
            # Scores are rounded to 40 bits, so one may rise a little.
            slack = np.where(np.isfinite(floor), np.abs(floor) * 2.0 ** -38, 0)
            row, column = np.nonzero(score >= (floor - slack)[:, None])
            value = settled(score[row, column])
            keep = value > self.above
            row, column, value = row[keep], column[keep], value[keep]
            touched = np.unique(row)
            if not len(touched):
                continue
            old = np.repeat(touched, self.k)
            rows = np.concatenate([old, row])
            scores = np.concatenate([self.scores[part[touched]].ravel(), value])
            others = np.concatenate([self.ids[part[touched]].ravel(), ids[column]])
            order = np.lexsort((others, -scores, rows))
            rows, scores, others = rows[order], scores[order], others[order]
            place = np.arange(len(rows)) - np.searchsorted(rows, rows, side="left")
            first = place < self.k
            at = part[rows[first]], place[first]
            self.scores[at], self.ids[at] = scores[first], others[first]


# --- best products by falling norm -------------------------------------------------------

#: Blocks of the right side that a task meets in one stage at most.
STAGE_BLOCKS = 16
#: Right blocks up to which they keep the size asked for.
NORM_BLOCKS = 64
_STATE = "id long, vector array<double>, best array<struct<score:double,other_id:long>>, open boolean"


def _measured(df: DataFrame) -> DataFrame:
    """``id, vector, norm`` of the rows that have both."""
    vector = F.transform("vector", lambda x: x.cast("double"))
    return df.where(F.col("id").isNotNull() & F.col("vector").isNotNull()).select(
        F.col("id").cast("long").alias("id"), vector.alias("vector"),
        F.sqrt(F.aggregate(vector, F.lit(0.0), lambda a, x: a + x * x)).alias("norm"))


def best_by_norm(
    left: DataFrame, right: DataFrame, k: int, above: float = 0.0, block_rows: int = BLOCK_ROWS,
    trace: list[tuple[int, int]] | None = None,
) -> DataFrame:
    """``best_scores`` of dot products, by bounds: the right rows are taken in blocks of falling
    norm, and a left row is done when no later block can beat its ``k``-th score, or ``above``
    (the product of two norms bounds a score). Blocks of left rows keep their running lists; a
    stage copies its right blocks only to left blocks that still have open rows, and stages
    double up to ``STAGE_BLOCKS``. ``trace`` gets right and left blocks of each stage."""
    items = cut_lineage(_measured(right), "norms")
    n_items, n_users = items.count(), left.count()
    cores = left.sparkSession.sparkContext.defaultParallelism
    # Every stage is a job, so blocks grow once there are many; so do those of users, which every
    # right block is copied to.
    user_rows = min(max(block_rows, math.ceil(n_users / (4 * cores))), max(block_rows, LEFT_FACTOR * BLOCK_ROWS))
    block_rows = min(max(block_rows, math.ceil(n_items / NORM_BLOCKS)), max(block_rows, BLOCK_ROWS))
    blocks = max(1, math.ceil(n_items / block_rows))
    shares = [1 - i / blocks for i in range(1, blocks)]
    bounds = items.approxQuantile("norm", shares, 0.0005) if n_items and shares else []
    at = F.size(F.filter(F.array(*map(F.lit, bounds)), lambda b: F.col("norm") < b)) \
        if bounds else F.lit(0)
    # Rows of one norm are divided further, so that no part outgrows a block.
    items = cut_lineage(items.withColumn("at", at), "norms")
    sizes = {r["at"]: (r["n"], r["most"]) for r in items.groupBy("at").agg(
        F.count("*").alias("n"), F.max("norm").alias("most")).collect()}
    order = sorted(sizes)
    parts = F.lit(1)
    for place in order:
        if sizes[place][0] > 2 * block_rows:
            parts = F.when(F.col("at") == place, math.ceil(sizes[place][0] / block_rows)).otherwise(parts)
    items = items.withColumn("part", F.pmod(F.xxhash64("id"), parts))

    def pack(rows: pd.DataFrame) -> pd.DataFrame:
        matrix = np.stack(rows["vector"].to_numpy()).astype("float64")
        return pd.DataFrame({
            "at": [rows["at"].iloc[0]], "ids": [rows["id"].to_numpy("int64").tobytes()],
            "matrix": [matrix.tobytes()], "width": [matrix.shape[1]], "most": [rows["norm"].max()]})

    packed = items.groupBy("at", "part").applyInPandas(
        pack, "at int, ids binary, matrix binary, width int, most double")
    user_blocks = max(1, math.ceil(n_users / user_rows))
    empty = F.array().cast("array<struct<score:double,other_id:long>>")
    users = _measured(left).where("norm > 0").select(
        "id", "vector", empty.alias("best"), F.lit(True).alias("open"))
    done, start, step = [], 0, 1
    while order[start:]:
        stage = order[start:start + step]
        later = [sizes[p][1] for p in order[start + step:]]
        limit = max(later, default=None)
        placed = users.withColumn("user_block", F.pmod(F.xxhash64("id"), F.lit(user_blocks)))
        names = [r[0] for r in placed.select("user_block").distinct().collect()]
        if trace is not None:
            trace.append((len(stage), len(names)))
        if not names:
            break
        copies = packed.where(F.col("at").isin(stage)).withColumn(
            "user_block", F.explode(F.array(*(F.lit(n).cast("long") for n in names))))
        met = placed.groupBy("user_block").cogroup(copies.groupBy("user_block")).applyInPandas(
            _meet(k, above, limit), _STATE)
        users = cut_lineage(met, "lists")
        done.append(users.where("not open"))
        users = users.where("open").select("id", "vector", "best", "open")
        start, step = start + step, min(2 * step, STAGE_BLOCKS)
    lists = reduce(DataFrame.unionByName, done) if done else users.limit(0)
    rows = lists.select("id", F.posexplode("best").alias("pos", "b"))
    return rows.select(
        "id", (F.col("pos") + 1).alias("rank"), F.col("b.other_id").alias("other_id"),
        F.col("b.score").alias("score"))


def _meet(k: int, above: float, limit: float | None):
    """Kernel of one block of left rows: takes the stage's right blocks in falling norm."""

    def meet(users: pd.DataFrame, blocks: pd.DataFrame) -> pd.DataFrame:
        if not len(users):
            return pd.DataFrame({"id": [], "vector": [], "best": [], "open": []})
        vectors = np.stack(users["vector"].to_numpy()).astype("float64")
        norms = np.sqrt((vectors * vectors).sum(axis=1))
        best = _Best(len(users), k, above)
        for u, found in enumerate(users["best"]):
            for place, b in enumerate(found):
                best.scores[u, place], best.ids[u, place] = b["score"], b["other_id"]
        for _, block in blocks.sort_values("most", ascending=False).iterrows():
            # A little slack, since scores are rounded to 40 bits.
            some = np.flatnonzero(norms * block["most"] * (1 + 1e-9) >= best.floor())
            best.meet(vectors, *_unpack(block), some=some)
        open_ = np.zeros(len(users), bool) if limit is None else (
            norms * limit * (1 + 1e-9) >= best.floor())
        return pd.DataFrame({
            "id": users["id"].to_numpy(), "vector": users["vector"],
            "best": [[{"score": s, "other_id": o} for s, o in zip(*two) if s > -np.inf]
                     for two in zip(best.scores.tolist(), best.ids.tolist())],
            "open": open_})

    return meet


# --- approximate pairs -------------------------------------------------------------------

#: Vectors that a bucket of signatures would hold if they were dealt evenly.
LSH_BUCKET = 256
#: Tables whose buckets are dealt at a time. Their shuffles go before the next ones' begin, so the disk
#: in use does not grow with the number of tables.
LSH_ROUND = 8


def lsh_tables(threshold: float, recall: float, bits: int) -> int:
    """Tables with which a pair at the threshold meets with probability ``recall``, if each
    signature is looked up together with those one bit away."""
    differs = math.acos(threshold) / math.pi
    meets = (1 - differs) ** bits + bits * differs * (1 - differs) ** (bits - 1)
    return max(1, math.ceil(math.log(1 - recall) / math.log(1 - meets)))


def cosine_pairs_lsh(
    vectors: DataFrame, threshold: float = 0.4, recall: float = 0.99, bits: int | None = None,
    seed: int = 0, piece: int = 1024,
) -> DataFrame:
    """``cosine_pairs`` that finds a pair at the threshold with probability ``recall``, and closer
    ones with more; no pair below it. Random hyperplanes give a signature per table; one side of
    a pair is looked up at its signature, the other also at those one bit away. Signatures get
    longer with the logarithm of the number of vectors, so that buckets keep their size; one of
    any size is cut into pieces that meet pairwise, and scores are computed in the task."""
    if bits is None:
        bits = max(4, round(math.log2(max(vectors.count(), 1) / LSH_BUCKET)))
    tables = lsh_tables(threshold, recall, bits)

    def signed(batches, part):
        planes = None
        for frame in batches:
            if not len(frame):
                continue
            matrix = np.stack(frame["vector"].to_numpy()).astype("float64")
            norm = np.sqrt((matrix * matrix).sum(axis=1))
            ids, matrix = frame["id"].to_numpy("int64")[norm > 0], matrix[norm > 0] / norm[norm > 0, None]
            if planes is None:
                planes = np.random.default_rng(seed).normal(size=(matrix.shape[1], tables, bits))[:, part]
            weights = 1 << np.arange(bits)
            for start in range(0, len(ids), 256):
                rows = matrix[start:start + 256]
                names = ((np.tensordot(rows, planes, 1) > 0) @ weights) + (np.arange(tables)[part] << 40)
                probes = np.concatenate([names[..., None], names[..., None] ^ weights], axis=2)
                own = np.zeros(probes.shape, bool)
                own[..., 0] = True
                n = probes[0].size
                yield pd.DataFrame({
                    "name": probes.ravel(), "id": np.repeat(ids[start:start + 256], n),
                    "own": own.ravel()})

    # Vectors go to their buckets in the precision they have.
    rows = vectors.where(F.col("id").isNotNull() & F.col("vector").isNotNull()).select(
        F.col("id").cast("long").alias("id"), "vector")

    def met(part: slice) -> DataFrame:
        """Pairs of the buckets of some tables, with the vectors."""
        named = rows.mapInPandas(lambda batches: signed(batches, part), "name long, id long, own boolean")
        # Signatures that are nobody's own find nothing; those of one row neither.
        homes = named.groupBy("name").agg(F.count("*").alias("n"), F.max("own").alias("home")).where(
            "n > 1 and home").select("name", F.ceil(F.col("n") / piece).cast("int").alias("pieces"))
        cut = named.join(homes, "name").withColumn(
            "piece", F.pmod(F.xxhash64("id"), F.col("pieces")).cast("int"))
        cut = cut.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("pieces") - 1))).select(
            "name", F.least("piece", "other").alias("i"), F.greatest("piece", "other").alias("j"),
            "piece", "id", "own").join(rows, "id")
        return cut.groupBy("name", "i", "j").applyInPandas(pairs, "a long, b long, score double")

    def pairs(part: pd.DataFrame) -> pd.DataFrame:
        matrix = np.stack(part["vector"].to_numpy()).astype("float64")
        matrix /= _norms(matrix)[:, None]
        ids, own = part["id"].to_numpy(), part["own"].to_numpy()
        at = part["piece"].to_numpy()
        # At least one of the two is at home.
        home = np.flatnonzero(own)
        score = matrix[home] @ matrix.T
        x, column = np.nonzero(score >= threshold - 1e-9)
        score, row = settled(score[x, column]), home[x]
        # A pair at home is met from both sides, and each pair of pieces is met once.
        keep = (score > settled(threshold)) & (ids[row] != ids[column]) & (
            ~own[column] | (ids[row] < ids[column]))
        if part["i"].iloc[0] != part["j"].iloc[0]:
            keep &= at[row] != at[column]
        row, column, score = row[keep], column[keep], score[keep]
        return pd.DataFrame({
            "a": np.minimum(ids[row], ids[column]), "b": np.maximum(ids[row], ids[column]),
            "score": score})

    found = reduce(DataFrame.unionByName, [
        cut_lineage(met(slice(k, k + LSH_ROUND)), "met") for k in range(0, tables, LSH_ROUND)])
    # The same pair may meet in several tables; its score is the same to 40 bits.
    return found.groupBy("a", "b").agg(F.max("score").alias("score"))
