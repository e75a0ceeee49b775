"""Operator 1: token ids in a compact binary form.

Ids are renumbered by falling corpus frequency and written in byte-aligned variable length: a
number takes one to four bytes, and its length sits in two bits of a separate control stream.
A reader looks each control byte up in a table of four lengths and gathers all values of a
block at once.

A token folder holds ``blocks`` (Parquet; a row is a block of whole documents in ascending
doc_id order: ``part, block, start, doc_ids, counts, control, data``) and ``ranks`` (the id of
each rank). ``start`` counts the ids of the same part before the block. Spark's writer commits
whole tasks, so a lost executor leaves no half-written file.

Null text is empty. A document without tokens still gets the end id. Null doc_ids come first.
Rows that repeat a doc_id stay apart, in an order of their own. Columns other than doc_id and
text are not read.
"""

from __future__ import annotations

import os
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from basketry.llm import texts
from basketry.llm.texts import write_step
from basketry.runtime import scratch_path, shuffle_width

#: Distinct parts of pieces of text a worker remembers the ids of.
CACHE_PIECES = 900_000
#: Bytes of text a task works on at a time.
SLICE_BYTES = 2 << 20
#: Ids of a block; a longer document is a block of its own.
BLOCK_IDS = 1 << 18

_ENCODED = "doc_id long, ids binary, counts binary"
_BLOCK = (
    "part int, block int, start long, doc_ids array<long>, counts array<long>, "
    "control binary, data binary"
)
_LENGTHS = np.array([[(c >> s & 3) + 1 for s in (0, 2, 4, 6)] for c in range(256)], np.int64)


class _Pieces:
    """Ids of pieces of text without spaces, by their parts; grows to a bound, then starts anew."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.size = self.tokenizer.get_vocab_size(with_added_tokens=True)
        self.dtype = id_type(self.size)
        self._forget()

    def _forget(self) -> None:
        """No part is known; the ids of all parts lie behind each other in ``flat``."""
        self.number: dict[str, int] = {}
        self.flat, self.bounds = np.zeros(0, self.dtype), np.zeros(1, np.int64)

    def ids(self, names: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all pieces behind each other, and how many each has. Marks at the ends of a piece
        and letter case make no difference to the ids of the rest, so pieces share what is left
        without them."""
        coded = pa.concat_arrays(_parts(names)).dictionary_encode()
        parts = coded.dictionary.to_pylist()
        if len(self.number) > CACHE_PIECES:
            self._forget()
        self._encode([part for part in parts if part not in self.number])
        known = np.fromiter(map(self.number.__getitem__, parts), np.int64, len(parts))
        which = known[coded.indices.to_numpy()].reshape(3, -1).T.ravel()
        size = np.diff(self.bounds)[which]
        total = np.cumsum(size)
        at = np.repeat(self.bounds[which] - (total - size), size) + np.arange(size.sum())
        return self.flat[at], size.reshape(-1, 3).sum(axis=1)

    def _encode(self, new: list[str]) -> None:
        """Many in one string; a token belongs to the part that its offset lies in."""
        flat, bounds, n = [self.flat], [self.bounds], len(self.flat)
        for start in range(0, len(new), 2000):
            part = new[start:start + 2000]
            limits = np.cumsum([0] + [len(name) + 1 for name in part])
            found = self.tokenizer.encode(" ".join(part), add_special_tokens=False)
            begins = np.array(found.offsets, np.int64).reshape(-1, 2)[:, 0]
            bounds.append(np.searchsorted(begins, limits)[1:] + n)
            flat.append(np.array(found.ids, self.dtype))
            n += len(begins)
        self.number.update(zip(new, range(len(self.number), len(self.number) + len(new))))
        self.flat, self.bounds = np.concatenate(flat), np.concatenate(bounds)


#: Marks that are no part of a special token and no apostrophe.
_MARKS = ".,!?;:#*%$&"


def _class(points: Iterable[int]) -> str:
    """The characters of a class of a pattern."""
    return "".join(rf"\x{{{p:x}}}" for p in points)


#: Characters that normal forms leave alone and that have one lower case; a middle of them that
#: begins and ends with a letter or digit.
_PLAIN = [p for p in range(0x250) if p != 0x130]
_ENDS = f"[{_class(p for p in _PLAIN if chr(p).isalnum())}]"
_MIDDLE = rf"(?s)\A{_ENDS}(?:[{_class(_PLAIN)}]*{_ENDS})?\z"


def _parts(names: pa.Array) -> list[pa.Array]:
    """Of each piece the middle in lower case, between marks before and after. A middle that ends
    in a letter or digit is never joined with a mark; other pieces stay whole, as a middle."""
    rest = pc.utf8_ltrim(names, characters=_MARKS)
    core = pc.utf8_rtrim(rest, characters=_MARKS)
    apart = pc.match_substring_regex(core, _MIDDLE)
    plain = apart.to_numpy(zero_copy_only=False)
    raw, offsets = texts.utf8(names)
    sizes = [pc.binary_length(x).to_numpy(zero_copy_only=False) for x in (names, rest, core)]
    before, after = (sizes[0] - sizes[1]) * plain, (sizes[1] - sizes[2]) * plain
    return [_spans(raw, offsets[:-1], before), pc.if_else(apart, pc.utf8_lower(core), names),
            _spans(raw, offsets[1:] - after, after)]


def _spans(raw: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> pa.Array:
    """The strings of these places."""
    ends = np.cumsum(sizes, dtype=np.int64)
    data = raw[np.repeat(starts - (ends - sizes), sizes) + np.arange(sizes.sum())]
    return pa.Array.from_buffers(pa.string(), len(sizes), [
        None, pa.py_buffer(np.concatenate([[0], ends]).astype(np.int32).tobytes()),
        pa.py_buffer(data.tobytes())])


@lru_cache(maxsize=2)
def _pieces(path: str) -> _Pieces:
    return _Pieces(path)


def id_type(size: int) -> str:
    return "<u2" if size <= 1 << 16 else "<u4"


def encode(docs: DataFrame, vocabulary: str, end_id: int) -> DataFrame:
    """``doc_id, ids``: little-endian ids of each text, then ``end_id``. Each task adds a row
    without ids whose ``counts`` say how often it wrote each id.

    The vocabulary drops white space and never merges across it, so a text is cut at blanks
    and line feeds and each distinct piece is encoded once per worker.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = _pieces(vocabulary)
        total = np.zeros(max(pieces.size, end_id + 1), np.int64)
        names = ["doc_id", "ids", "counts"]
        for part in texts.slices(batches, "text", SLICE_BYTES):
            ids, ends = _ids(part[1], pieces)
            ids = np.insert(ids, ends, end_id)
            total += np.bincount(ids, minlength=len(total))
            offsets = np.concatenate([[0], ends + np.arange(1, len(ends) + 1)]) * ids.itemsize
            coded = pa.Array.from_buffers(pa.binary(), len(ends), [
                None, pa.py_buffer(offsets.astype(np.int32).tobytes()), pa.py_buffer(ids.tobytes())])
            yield pa.record_batch([part[0], coded, pa.nulls(len(ends), pa.binary())], names)
        yield pa.record_batch([
            pa.nulls(1, pa.int64()), pa.nulls(1, pa.binary()), pa.array([total.tobytes()])], names)

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(
        run, _ENCODED)


def _ids(column: pa.Array, pieces: _Pieces) -> tuple[np.ndarray, np.ndarray]:
    """Ids of all texts, and where each text's ids end. Arrow cuts the texts and tells the
    distinct pieces; only parts of those become Python strings."""
    lists = pc.split_pattern(pc.replace_substring(column.fill_null(""), "\n", " "), " ")
    coded = lists.flatten().dictionary_encode()
    table, lengths = pieces.ids(coded.dictionary)
    which = coded.indices.to_numpy()
    size = lengths[which]
    total = np.concatenate([[0], np.cumsum(size)])
    begin = (np.cumsum(lengths) - lengths)[which] - total[:-1]
    ids = table[np.repeat(begin, size) + np.arange(total[-1])]
    return ids, total[np.cumsum(lists.value_lengths().to_numpy())]


def id_counts(encoded: DataFrame) -> DataFrame:
    """``id, n`` over all documents; at most one row per id of the vocabulary."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = 0
        for batch in batches:
            for counts in batch[0].to_pylist():
                total = total + np.frombuffer(counts, np.int64)
        seen = np.flatnonzero(total)
        yield pa.record_batch(
            [pa.array(seen), pa.array(total[seen] if len(seen) else seen)], ["id", "n"])

    return encoded.where("counts is not null").select("counts").mapInArrow(
        run, "id long, n long").groupBy("id").agg(F.sum("n").alias("n"))


def pack(values: np.ndarray) -> tuple[bytes, bytes]:
    """Control and data bytes of unsigned numbers below 2^32."""
    values = values.astype("<u4")
    extra = (values > 0xFF).astype(np.uint8) + (values > 0xFFFF) + (values > 0xFFFFFF)
    lanes = np.zeros(-(-len(values) // 4) * 4, np.uint8)
    lanes[:len(values)] = extra
    lanes = lanes.reshape(-1, 4)
    control = lanes[:, 0] | lanes[:, 1] << 2 | lanes[:, 2] << 4 | lanes[:, 3] << 6
    octets = values.view(np.uint8).reshape(-1, 4)
    return control.tobytes(), octets[np.arange(4) <= extra[:, None]].tobytes()


def unpack(control: bytes, data: bytes, n: int) -> np.ndarray:
    """The ``n`` numbers that ``pack`` wrote."""
    lengths = _LENGTHS[np.frombuffer(control, np.uint8)].ravel()[:n]
    at = np.cumsum(lengths) - lengths
    octets = np.frombuffer(data, np.uint8)
    values = octets[at].astype(np.uint32)
    for k in (1, 2, 3):
        longer = np.flatnonzero(lengths > k)
        values[longer] |= octets[at[longer] + k].astype(np.uint32) << np.uint32(8 * k)
    return values


def write_tokens(docs: DataFrame, path: str, vocabulary: str, end_id: int) -> None:
    """Encode ``docs`` and write the token folder ``path``."""
    from tokenizers import Tokenizer

    spark = docs.sparkSession
    size = Tokenizer.from_file(vocabulary).get_vocab_size(with_added_tokens=True)
    dtype, width = id_type(size), np.dtype(id_type(size)).itemsize
    encoded = write_step(encode(docs, vocabulary, end_id), "token-ids")
    # As many rows as the vocabulary at most.
    order = [r["id"] for r in id_counts(encoded).orderBy(F.desc("n"), "id").collect()]
    rank_of = np.zeros(max(size, end_id + 1), np.uint32)
    rank_of[order] = np.arange(len(order), dtype=np.uint32)
    shared = spark.sparkContext.broadcast(rank_of)

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, block, start, held, size_held = TaskContext.get().partitionId(), 0, 0, [], 0

        def flush() -> pa.RecordBatch:
            ids = np.frombuffer(b"".join(v for _, v in held), dtype)
            control, data = pack(shared.value[ids])
            return pa.record_batch([
                pa.array([part], pa.int32()), pa.array([block], pa.int32()),
                pa.array([start], pa.int64()), pa.array([[d for d, _ in held]], pa.list_(pa.int64())),
                pa.array([[len(v) // width for _, v in held]], pa.list_(pa.int64())),
                pa.array([control], pa.binary()), pa.array([data], pa.binary()),
            ], ["part", "block", "start", "doc_ids", "counts", "control", "data"])

        for batch in batches:
            for doc_id, ids in zip(batch[0].to_pylist(), batch[1].to_pylist()):
                held.append((doc_id, ids))
                size_held += len(ids) // width
                if size_held >= BLOCK_IDS:
                    yield flush()
                    block, start, held, size_held = block + 1, start + size_held, [], 0
        if held:
            yield flush()

    encoded.where("ids is not null").select("doc_id", "ids") \
        .repartitionByRange(shuffle_width(spark), "doc_id").sortWithinPartitions("doc_id") \
        .mapInArrow(blocks, _BLOCK).write.parquet(f"{path}/blocks")
    ranks = spark.createDataFrame(list(enumerate(order)), "rank int, id long")
    ranks.coalesce(1).write.parquet(f"{path}/ranks")


def read_tokens(spark: SparkSession, path: str) -> DataFrame:
    """``doc_id, part, start, n_tokens, ids``: ids as little-endian unsigned 32-bit numbers,
    ``start`` the ids of all documents before."""
    blocks = spark.read.schema(_BLOCK).parquet(f"{path}/blocks")
    ranks = spark.read.schema("rank int, id long").parquet(f"{path}/ranks").collect()
    id_of = np.zeros(len(ranks), np.uint32)
    id_of[[r["rank"] for r in ranks]] = [r["id"] for r in ranks]
    shared = spark.sparkContext.broadcast(id_of)
    # A row per written part.
    parts = blocks.groupBy("part").agg(
        F.max(F.col("start") + F.aggregate("counts", F.lit(0).cast("long"), lambda a, x: a + x))
        .alias("n")).orderBy("part").collect()
    before, offset = 0, {}
    for row in parts:
        offset[row["part"]] = before
        before += row["n"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                counts = np.array(row["counts"], np.int64)
                ids = shared.value[unpack(row["control"], row["data"], int(counts.sum()))]
                first = np.cumsum(counts) - counts
                yield pa.record_batch([
                    pa.array(row["doc_ids"], pa.int64()),
                    pa.array(first + row["start"] + offset[row["part"]]), pa.array(counts),
                    pa.array([ids[a:a + n].tobytes() for a, n in zip(first, counts)], pa.binary()),
                ], ["doc_id", "start", "n_tokens", "ids"])

    return blocks.mapInArrow(run, "doc_id long, start long, n_tokens long, ids binary")


def op1_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Encode all documents, write the token folder, read it back, and digest the ids."""
    import public_tokenizers

    path = scratch_path(spark, "tokens")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    write_tokens(docs, path, public_tokenizers.path("word_bpe_49k.json"), end_id=1)
    return read_tokens(spark, path).select(
        "doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))
