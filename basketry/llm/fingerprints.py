"""Operator 6: document fingerprints from content-defined chunks.

A gear hash rolls over the UTF-8 bytes of a text; where its low bits are zero, a chunk may end.
The chunk lengths are normalised: before the wanted length more bits must be zero, beyond it
fewer, and no chunk is shorter than ``SHORTEST`` (the reach of the hash) or longer than
``LONGEST``. So boundaries depend on nearby bytes only, and an insertion changes few chunks. The
fingerprint is the set of chunk digests with their lengths; likeness is the part of a text, by
length, that lies in chunks of the other text (containment).

A fingerprint is a string of records of 20 hexadecimal digits (16 digest, 4 length), sorted.
Null is the empty text; its fingerprint is empty. An empty text is contained in an empty one
only. Rows that repeat a doc_id are ordered by text; a null doc_id comes last of all. Equal texts
have equal fingerprints. Only doc_id and text are read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from basketry.llm import texts
from basketry.runtime import shuffle_width

SHORTEST, WANTED, LONGEST = 32, 64, 256
#: Low bits that must be zero before and beyond the wanted length.
_STRICT, _LOOSE = 0xFF, 0x1F
_GEAR = np.random.default_rng(6).integers(0, 1 << 32, 256, dtype=np.uint32)
_RECORD = np.dtype([("digest", ">u8"), ("length", ">u2")])
_FIRST = -(1 << 63)


def boundaries(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``text, start, end`` of all chunks of some texts."""
    rolled = _GEAR[raw]
    # The sum over 32 bytes, each shifted by its distance, by doubling.
    for reach in (1, 2, 4, 8, 16):
        rolled[reach:] += rolled[:-reach] << np.uint32(reach)
    # Low bits see few bytes, high ones all 32.
    rolled >>= np.uint32(20)
    loose = np.flatnonzero((rolled & np.uint32(_LOOSE)) == 0) + 1
    strict = loose[(rolled[loose - 1] & np.uint32(_STRICT)) == 0]
    far = np.array([len(raw) + LONGEST + 1])
    loose, strict = np.append(loose, far), np.append(strict, far)
    active = np.flatnonzero(np.diff(offsets))
    start, out = offsets[:-1][active], []
    # All texts take their next chunk together.
    while len(active):
        end = strict[np.searchsorted(strict, start + SHORTEST)]
        late = end >= start + WANTED
        end[late] = loose[np.searchsorted(loose, start[late] + WANTED)]
        end = np.minimum(np.minimum(end, start + LONGEST), offsets[1:][active])
        out.append((active, start, end))
        more = end < offsets[1:][active]
        active, start = active[more], end[more]
    if not out:
        return (np.zeros(0, np.int64),) * 3
    return tuple(np.concatenate(part) for part in zip(*out))


def fingerprints(raw: np.ndarray, offsets: np.ndarray) -> list[np.ndarray]:
    """Per text its distinct chunks, sorted, as ``digest, length`` records."""
    text, start, end = boundaries(raw, offsets)
    digest = texts._span_hashes(texts._BYTE_VALUE[raw], start, end, texts._BYTE_POWERS)
    order = np.lexsort((digest, text))
    text, digest, length = text[order], digest[order], (end - start)[order]
    new = np.ones(len(text), bool)
    new[1:] = (text[1:] != text[:-1]) | (digest[1:] != digest[:-1])
    records = np.empty(int(new.sum()), _RECORD)
    records["digest"], records["length"] = digest[new], length[new]
    return texts.split_at(records, np.searchsorted(text[new], np.arange(len(offsets))))


def containment(own: np.ndarray, other: np.ndarray) -> float:
    """Part of ``own``, by length, that ``other`` has as well."""
    if not len(own):
        return float(not len(other))
    if not len(other):
        return 0.0
    digests = other["digest"].astype(np.uint64)
    mine = own["digest"].astype(np.uint64)
    at = np.minimum(np.searchsorted(digests, mine), len(digests) - 1)
    lengths = own["length"].astype(np.int64)
    return float(lengths[digests[at] == mine].sum() / lengths.sum())


def _of(values: list[str]) -> list[np.ndarray]:
    coded = [v.encode() for v in values]
    offsets = np.cumsum([0] + [len(c) for c in coded])
    return fingerprints(np.frombuffer(b"".join(coded), np.uint8), offsets)


def _part(bounds: list[int], low: int = 0) -> Column:
    """Number of bounds at or below ``doc_id``, by halving."""
    if not bounds:
        return F.lit(low)
    at = len(bounds) // 2
    return F.when(F.col("doc_id") < bounds[at], _part(bounds[:at], low)).otherwise(
        _part(bounds[at + 1:], low + at + 1))


def with_next(docs: DataFrame) -> DataFrame:
    """``dest, halo, doc_id, text`` sorted within partitions so that each row with ``halo`` 0 is
    followed by the document after it, by falling doc_id (after the last: the first). Ranges of
    ids are dealt out, and each gets the head of the next one as a row with ``halo`` 1. One
    shuffle of the texts."""
    spark = docs.sparkSession
    rows = docs.select(
        F.coalesce(F.col("doc_id").cast("long"), F.lit(_FIRST)).alias("doc_id"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    n = max(shuffle_width(spark), 2 * spark.sparkContext.defaultParallelism)
    # One number per partition.
    bounds = rows.approxQuantile("doc_id", [k / n for k in range(1, n)], 0.1 / n)
    bounds = sorted({int(b) for b in bounds})
    rows = rows.withColumn("part", _part(bounds))
    heads = rows.groupBy("part").agg(F.max("doc_id").alias("head")).orderBy("part").collect()
    after = {heads[k - 1]["part"]: heads[k]["part"] for k in range(len(heads))}
    if not heads:
        return rows.select(F.col("part").alias("dest"), F.lit(0).alias("halo"), "doc_id", "text")
    table = F.broadcast(spark.createDataFrame(
        [(h["part"], h["head"], after[h["part"]]) for h in heads],
        "part int, head long, after int"))
    own = F.struct(F.col("part").alias("dest"), F.lit(0).alias("halo"))
    ahead = F.struct(F.col("after").alias("dest"), F.lit(1).alias("halo"))
    places = F.when(F.col("doc_id") == F.col("head"), F.array(own, ahead)).otherwise(F.array(own))
    return rows.join(table, "part").select(F.explode(places).alias("at"), "doc_id", "text").select(
        "at.dest", "at.halo", "doc_id", "text").repartition(n, "dest").sortWithinPartitions(
        "dest", "halo", F.desc("doc_id"), "text")


def edited(text: str, following: str) -> str:
    """``text`` with its last half replaced by as many characters of ``following``'s start."""
    half = len(text) // 2
    return text[:len(text) - half] + following[:half]


def compare_edited(docs: DataFrame) -> DataFrame:
    """Per document its fingerprint, that of its edited text, and the likeness to the edited
    text and to the next document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: tuple[list, list, list] = ([], [], [])
        for part in texts.slices(batches, "text"):
            held = tuple(a + b.to_pylist() for a, b in zip(held, (part[1], part[2], part[3])))
            halo, ids, values = held
            own = _of(values)
            changed = [edited(a, b) for a, b in zip(values, values[1:])]
            other = _of(changed)
            use = [k for k in range(len(changed)) if not halo[k]]
            yield pa.record_batch([
                pa.array([None if ids[k] == _FIRST else ids[k] for k in use], pa.int64()),
                pa.array([len(values[k]) for k in use], pa.int64()),
                pa.array([hashlib.sha256(changed[k].encode()).hexdigest() for k in use], pa.string()),
                pa.array([own[k].tobytes().hex() for k in use], pa.string()),
                pa.array([other[k].tobytes().hex() for k in use], pa.string()),
                pa.array([containment(own[k], other[k]) for k in use], pa.float64()),
                pa.array([containment(own[k], own[k + 1]) for k in use], pa.float64()),
            ], ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint",
                "near_edited", "near_next"])
            held = (halo[-1:], ids[-1:], values[-1:])

    return with_next(docs).mapInArrow(
        run, "doc_id long, n_chars long, edited_sha256 string, fingerprint string, "
        "edited_fingerprint string, near_edited double, near_next double")


def op6_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of all documents and of their edited texts."""
    return compare_edited(texts.documents(spark, sf_dir))
