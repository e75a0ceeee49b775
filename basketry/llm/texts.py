"""Arrow batches of texts as numpy byte arrays: slicing, words, hashes, word windows.

Words follow one rule everywhere: ``A-Z`` are lower-cased, and a word is a run of digits,
``a-z`` and characters beyond ASCII, so every step can work on UTF-8 bytes.
"""

from __future__ import annotations

import ctypes
import uuid
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from basketry.runtime import scratch_path, short_shuffles

#: Bytes of text a task works on at a time.
SLICE_BYTES = 4 << 20

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_IN_WORD = np.zeros(256, bool)
_IN_WORD[48:58] = _IN_WORD[97:123] = _IN_WORD[128:] = True

_RANDOM = np.random.default_rng(20240501)
_BYTE_VALUE = _RANDOM.integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = np.uint64(0x9E3779B97F4A7C15)
_WORD_BASE = np.uint64(0xD6E8FEB86659FD93)


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def write_step(df: DataFrame, label: str) -> DataFrame:
    """Like ``cut_lineage``, with the smaller files of zstd."""
    path = scratch_path(df.sparkSession, label)
    with short_shuffles(df.sparkSession):
        df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def fresh(name: str) -> str:
    """A column name that no table has."""
    return f"{name}_{uuid.uuid4().hex}"


#: Type of the key that ``with_row`` adds.
ROW = "struct<file:long,place:long>"


def with_row(docs: DataFrame, name: str) -> DataFrame:
    """``docs`` with a key of each row, the same at every reading: its file and its place there.
    What is no table as read from its files is written first."""
    if docs._jdf.queryExecution().analyzed().nodeName() != "LogicalRelation":
        docs = write_step(docs, "rows")
    return docs.withColumn(name, F.struct(
        F.xxhash64("_metadata.file_path").alias("file"),
        F.col("_metadata.row_index").alias("place")))


def keyed(docs: DataFrame, row: str) -> DataFrame:
    """``row, doc_id, text`` of ``docs``, whose column ``row`` is their key."""
    return docs.select(F.col(row).alias("row"), F.col("doc_id").cast("long").alias("doc_id"),
                       F.col("text").cast("string").alias("text"))


def without(docs: DataFrame, row: str, gone: DataFrame) -> DataFrame:
    """``docs`` without the rows whose key (column ``row``) is in the only column of ``gone``, and
    without the key."""
    name = fresh("gone")
    return docs.join(gone.toDF(name), F.col(row) == F.col(name), "left_anti").drop(row)


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all texts and the ``n + 1`` offsets of the texts in them; null is empty."""
    column = column.cast(pa.large_binary()).fill_null(b"")
    offsets = np.frombuffer(column.buffers()[1], np.int64)[
        column.offset:column.offset + len(column) + 1]
    data = column.buffers()[2]
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[offsets[0]:offsets[-1]], offsets - offsets[0]


#: What a worker process remembers from task to task: one operator's memory at a time.
_held: dict[str, object] = {}


def held(name: str, make: Callable[[], object]) -> object:
    """The memory of this name in this worker."""
    if name not in _held:
        _held.clear()
        _held[name] = make()
    return _held[name]


def _release() -> None:
    """Give freed memory back to the machine, which Arrow and the C library would keep."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def slices(
    batches: Iterator[pa.RecordBatch], column: str, limit: int = SLICE_BYTES, keep: str | None = None
) -> Iterator[pa.RecordBatch]:
    """Pieces of the batches with about ``limit`` bytes of text; a longer text is alone. A task
    that reads texts lets go of what the worker holds for others, all but ``keep``."""
    others = [n for n in _held if n != keep]
    for name in others:
        del _held[name]
    if others:
        _release()
    for batch in batches:
        at = batch.schema.get_field_index(column)
        _, offsets = utf8(batch.column(at))
        start = 0
        while start < batch.num_rows:
            stop = int(np.searchsorted(offsets, offsets[start] + limit, "right")) - 1
            stop = min(max(stop, start + 1), batch.num_rows)
            yield batch.slice(start, stop - start)
            start = stop


def mix(x: np.ndarray) -> np.ndarray:
    """Spread 64-bit values over all bits."""
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(32))


class _Powers:
    """Powers of an odd 64-bit base and of its inverse, grown on demand."""

    def __init__(self, base: np.uint64):
        self.base = base
        self.inverse = np.uint64(pow(int(base), -1, 1 << 64))
        self.up = self.down = np.ones(1, np.uint64)

    def to(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            size = max(n, 2 * len(self.up), 1 << 16)
            for name, base in (("up", self.base), ("down", self.inverse)):
                steps = np.full(size, base, np.uint64)
                steps[0] = 1
                setattr(self, name, np.multiply.accumulate(steps))
        return self.up, self.down


_BYTE_POWERS, _WORD_POWERS = _Powers(_BASE), _Powers(_WORD_BASE)


def _span_hashes(values: np.ndarray, starts, ends, powers: _Powers) -> np.ndarray:
    """Polynomial hash of ``values[start:end]`` for each span, from one running sum."""
    up, down = powers.to(len(values) + 1)
    total = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values * up[:len(values)], out=total[1:])
    return mix((total[ends] - total[starts]) * down[starts] + (ends - starts).astype(np.uint64))


@dataclass
class Words:
    """Words of some texts: hashes, byte spans, and per text the first word's index."""

    hashes: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    offsets: np.ndarray
    lowered: np.ndarray

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.offsets)

    @property
    def text_of(self) -> np.ndarray:
        """Index of the text each word is in."""
        return np.repeat(np.arange(len(self.offsets) - 1), self.counts)


def words(raw: np.ndarray, offsets: np.ndarray) -> Words:
    lowered = _LOWER[raw]
    inside = _IN_WORD[lowered]
    before, after = np.zeros_like(inside), np.zeros_like(inside)
    before[1:], after[:-1] = inside[:-1], inside[1:]
    before[offsets[:-1][offsets[:-1] < len(raw)]] = False
    ends = offsets[1:][offsets[1:] > 0]
    after[ends - 1] = False
    starts, ends = np.flatnonzero(inside & ~before), np.flatnonzero(inside & ~after) + 1
    hashes = _span_hashes(_BYTE_VALUE[lowered], starts, ends, _BYTE_POWERS)
    return Words(hashes, starts, ends, np.searchsorted(starts, offsets), lowered)


def windows(found: Words, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all runs of ``size`` words within a text, and per text the offsets of its
    runs. A text of fewer words, but not none, is one run."""
    counts = found.counts
    runs = np.where(counts > 0, np.maximum(counts - size + 1, 1), 0)
    offsets = np.concatenate([[0], np.cumsum(runs)])
    begins = np.arange(offsets[-1]) - np.repeat(offsets[:-1] - found.offsets[:-1], runs)
    ends = np.minimum(begins + size, np.repeat(found.offsets[1:], runs))
    return _span_hashes(found.hashes, begins, ends, _WORD_POWERS), offsets


def split_at(values: list | np.ndarray, offsets: np.ndarray) -> list:
    return [values[a:b] for a, b in zip(offsets[:-1], offsets[1:])]
