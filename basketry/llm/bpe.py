"""Operator 9: byte-level BPE by a file of ranks, and back.

A text is cut into words by the tokenizer's pattern. The most frequent words of the corpus (a
fixed number of them) are encoded by Spark: higher-order functions fold the merges over each
word's array of byte pieces, always joining the leftmost pair of lowest rank, with the ranks in
a literal map. That table of bounded size is broadcast. A worker looks words up in it, and folds
words beyond it itself by the same rule, each distinct one once while it is remembered. No
occurrence is ever shuffled. Decoding is Spark's as well: each id becomes its bytes, and the
pieces are concatenated.

Null text is empty; empty text has no ids and decodes to no bytes. Null ids give null. Every row
is encoded for itself, so repeated rows and ids stay. Only doc_id and text are read.
"""

from __future__ import annotations

import base64
import json
from array import array
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from basketry.llm import texts
from basketry.llm.texts import write_step

#: Words that Spark encodes and broadcasts.
FREQUENT_WORDS = 20_000
#: Distinct stretches of text a worker remembers the ids of.
CACHE_STRETCHES = 450_000
#: Bytes of text cut into stretches at a time.
SLICE_BYTES = 2 << 20
NEVER = 1 << 30
#: Stands behind the tokens of a word; makes no pair.
_NO_TOKEN = (1 << 31) - 1
_BUCKETS = 8192
_ODD_BLANK = regex.compile(r" (?=\s|$)")
#: Where Arrow cuts, and what it leaves to Python: the same and a little more.
_CUT = "\x1f"
_MAY_BE_ODD = (r"\x1f| (?:[\s\x0b\x1c-\x1e\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}"
               r"\x{205f}\x{3000}]|$)")


@lru_cache(maxsize=2)
def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}


# --- in Spark ----------------------------------------------------------------------------

def rank_map(ranks: dict[bytes, int]) -> Column:
    """Literal ranks by hexadecimal bytes: an array of small maps, by checksum of the key."""
    import zlib

    buckets: list[dict[str, int]] = [{} for _ in range(_BUCKETS)]
    for piece, rank in ranks.items():
        key = piece.hex().upper()
        buckets[zlib.crc32(key.encode()) % _BUCKETS][key] = rank
    return F.from_json(F.lit(json.dumps(buckets)), "array<map<string,int>>")


def fold_words(words: DataFrame, ranks: dict[bytes, int]) -> DataFrame:
    """``word, ids`` of ``word`` rows: byte pieces, joined pair by pair in order of rank."""
    octets = F.octet_length("word")

    def folded(table: Column) -> Column:
        def rank(piece: Column) -> Column:
            at = F.pmod(F.crc32(F.encode(piece, "UTF-8")), F.lit(_BUCKETS)).cast("int")
            return F.coalesce(F.try_element_at(F.element_at(table, at + 1), piece), F.lit(NEVER))

        def pair_ranks(pieces: Column) -> Column:
            return F.transform(
                F.sequence(F.lit(1), F.greatest(F.size(pieces) - 1, F.lit(1))),
                lambda i: F.when(
                    i < F.size(pieces),
                    rank(F.concat(F.element_at(pieces, i), F.element_at(pieces, i + 1)))
                ).otherwise(NEVER))

        def merge(state: Column, _) -> Column:
            pieces, pairs = state["pieces"], state["ranks"]
            lowest = F.array_min(pairs)
            at = F.array_position(pairs, lowest).cast("int")
            joined = F.concat(
                F.slice(pieces, F.lit(1), at - 1),
                F.array(F.concat(F.element_at(pieces, at), F.element_at(pieces, at + 1))),
                F.slice(pieces, at + 2, F.greatest(F.size(pieces) - at - 1, F.lit(0))))
            return F.when(lowest == NEVER, state).otherwise(
                F.struct(joined.alias("pieces"), pair_ranks(joined).alias("ranks")))

        pieces = F.transform(
            F.sequence(F.lit(1), octets),
            lambda i: F.hex(F.substring(F.encode("word", "UTF-8"), i, F.lit(1))))
        start = F.struct(pieces.alias("pieces"), pair_ranks(pieces).alias("ranks"))
        done = F.aggregate(F.sequence(F.lit(1), octets), start, merge)["pieces"]
        return F.transform(done, rank)

    # The literal stands in the plan once, as what a function is applied to: the driver writes
    # every plan out as text, with all that is in it.
    ids = F.element_at(F.transform(F.array(rank_map(ranks)), folded), 1)
    return words.where(octets > 0).select("word", ids.alias("ids"))


def frequent_words(docs: DataFrame, pattern: str, n: int) -> DataFrame:
    """``word``: the words of the ``n`` most frequent stretches of all texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def added(parts: list[pa.Table]) -> pa.Table:
            return pa.concat_tables(parts).group_by("stretch").aggregate([("n", "sum")]).rename_columns(
                ["stretch", "n"])

        held, rows = [], 0
        for part in texts.slices(batches, "text", SLICE_BYTES):
            names, which, _ = _distinct_stretches(part[0])
            held.append(pa.table([names, np.bincount(which, minlength=len(names))], ["stretch", "n"]))
            rows += len(names)
            if rows > CACHE_STRETCHES:
                held = [added(held)]
                rows = len(held[0])
                if 2 * rows > CACHE_STRETCHES:
                    yield from held[0].to_batches()
                    held, rows = [], 0
        if held:
            yield from added(held).to_batches()

    counted = docs.select(F.col("text").cast("string")).mapInArrow(run, "stretch string, n long")
    # Written first: collected at once, the best of every partition would come to the driver.
    best = write_step(counted.groupBy("stretch").agg(F.sum("n").alias("n")).orderBy(
        F.desc("n"), "stretch").limit(n).select("stretch"), "frequent-stretches").collect()
    find = regex.compile(pattern).findall
    words = sorted({word for r in best for word in find(r["stretch"])})
    return docs.sparkSession.createDataFrame([(w,) for w in words], "word string")


def decode(ids: Column, ranks: dict[bytes, int]) -> Column:
    """Binary text of an array of ids."""
    pieces: list[str | None] = [None] * (max(ranks.values()) + 1)
    for piece, rank in ranks.items():
        pieces[rank] = piece.hex()
    table = F.from_json(F.lit(json.dumps(pieces)), "array<string>")
    return F.unhex(F.array_join(F.transform(ids, lambda i: F.element_at(table, i + 1)), ""))


# --- in a worker -------------------------------------------------------------------------

def _stretches(text: str) -> list[str]:
    """``text`` cut before single blanks that a word follows. No word of the pattern reaches
    over such a place, and none looks beyond it."""
    if _ODD_BLANK.search(text):
        return [text]
    first, *rest = text.split(" ")
    return [first, *map(" ".__add__, rest)] if first else list(map(" ".__add__, rest))


def _distinct_stretches(column: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """The distinct stretches of all texts, which one stands at each place, and how many each text
    has. Arrow cuts the texts, unless one has an odd blank or holds the mark of the cuts."""
    column = column.fill_null("")
    if pc.any(pc.match_substring_regex(column, _MAY_BE_ODD)).as_py():
        lists = pa.array([_stretches(t) for t in column.to_pylist()], pa.list_(pa.string()))
    else:
        lists = pc.split_pattern(pc.replace_substring(column, " ", f"{_CUT} "), _CUT)
    coded = lists.flatten().dictionary_encode()
    return coded.dictionary, coded.indices.to_numpy(), lists.value_lengths().to_numpy()


class PairTable:
    """Rank of the token that two tokens make, for arrays of pairs: two hash tables, a pair is
    in one of them."""

    def __init__(self, ranks: dict[bytes, int]):
        found = {}
        for token, rank in ranks.items():
            for k in range(1, len(token)):
                a, b = ranks.get(token[:k]), ranks.get(token[k:])
                if a is not None and b is not None:
                    found[a << 32 | b] = rank
        keys = np.array(sorted(found), np.uint64)
        values = np.array([found[k] for k in keys.tolist()], np.int32)
        self.bits = max(10, (16 * len(keys)).bit_length())
        self.keys = np.full((2, 1 << self.bits), np.iinfo(np.uint64).max, np.uint64)
        self.values = np.full((2, 1 << self.bits), NEVER, np.int32)
        rest = np.arange(len(keys))
        for side in (0, 1):
            at = self._slot(keys[rest], side)
            _, first = np.unique(at, return_index=True)
            self.keys[side, at[first]] = keys[rest[first]]
            self.values[side, at[first]] = values[rest[first]]
            rest = np.delete(rest, first)
        self.others = {int(keys[k]): int(values[k]) for k in rest}

    def _slot(self, keys: np.ndarray, side: int) -> np.ndarray:
        factor = np.uint64((0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)[side])
        return ((keys * factor) >> np.uint64(64 - self.bits)).astype(np.int64)

    def __call__(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        keys = left.astype(np.uint64) << np.uint64(32) | right.astype(np.uint64)
        out = np.full(keys.shape, NEVER, np.int32)
        for side in (0, 1):
            at = self._slot(keys, side)
            out = np.where(self.keys[side, at] == keys, self.values[side, at], out)
        if self.others:
            for place in zip(*np.nonzero(np.isin(keys, list(self.others)))):
                out[place] = self.others[int(keys[place])]
        return out


def fold(words: list[str], ranks: dict[bytes, int], pairs: PairTable) -> list[bytes]:
    """Ids (as bytes) of each word: in every round each word joins its leftmost pair of lowest
    rank. Words of about one length are folded together, filled up behind their ends."""
    coded = [w.encode() for w in words]
    out = [b""] * len(words)
    single = np.array([ranks[bytes([b])] for b in range(256)], np.int32)
    by_width: dict[int, list[int]] = {}
    for k, c in enumerate(coded):
        whole = ranks.get(c)
        if whole is not None:
            out[k] = array("i", [whole]).tobytes()
        elif c:
            by_width.setdefault(-(-len(c) // 4) * 4, []).append(k)
    for width, chosen in by_width.items():
        who = np.array(chosen)
        size = np.array([len(coded[k]) for k in chosen])
        ids = np.full((len(who), width), _NO_TOKEN, np.int32)
        ids[np.arange(width) < size[:, None]] = single[
            np.frombuffer(b"".join(coded[k] for k in chosen), np.uint8)]
        rank = pairs(ids[:, :-1], ids[:, 1:])
        while len(who):
            row = np.arange(len(who))
            at = rank.argmin(axis=1)
            lowest = rank[row, at]
            done = lowest == NEVER
            if done.any():
                for k, n, final in zip(who[done].tolist(), size[done].tolist(), ids[done]):
                    out[k] = final[:n].tobytes()
                left = ~done
                who, size, ids, rank = who[left], size[left], ids[left], rank[left]
                if not len(who):
                    break
                row, at, lowest = np.arange(len(who)), at[left], lowest[left]
            ids[row, at] = lowest
            # What is behind the joined pair moves up by one.
            column = np.arange(width - 1)
            ids[:, :-1] = np.take_along_axis(ids, column + (column > at[:, None]), axis=1)
            ids[:, -1] = _NO_TOKEN
            column = np.arange(width - 2)
            rank[:, :-1] = np.take_along_axis(rank, column + (column >= at[:, None]), axis=1)
            rank[:, -1] = NEVER
            size -= 1
            for side, has in ((at - 1, at > 0), (at, at < width - 1)):
                r, c = row[has], side[has]
                rank[r, c] = pairs(ids[r, c], ids[r, c + 1])
    return out


class _Memory(dict):
    """Ids, as bytes, of stretches of text and of their words. A word that is a stretch as well
    has the same ids: the pattern finds a word again in the word alone."""

    def __init__(self, pattern: str, ranks: dict[bytes, int], known: dict[str, list[int]]):
        super().__init__()
        self.find, self.ranks, self.pairs = regex.compile(pattern).findall, ranks, PairTable(ranks)
        self.known = {word: array("i", ids).tobytes() for word, ids in known.items()}
        self.update(self.known)

    def learn(self, texts: list[list[str]]) -> None:
        """Fold the words of the stretches not known yet."""
        if len(self) > CACHE_STRETCHES:
            self.clear()
            self.update(self.known)
        new = list(set().union(*texts).difference(self))
        found = self._words(new)
        unknown = list(set(chain.from_iterable(found)).difference(self))
        self.update(zip(unknown, fold(unknown, self.ranks, self.pairs)))
        for stretch, words in zip(new, found):
            if len(words) != 1:
                self[stretch] = b"".join(map(self.__getitem__, words))

    def _words(self, stretches: list[str]) -> list[list[str]]:
        """Words of each stretch. Stretches that begin with a blank before a word are searched
        as one text, which is cut at the same places."""
        apart = {k: self.find(s) for k, s in enumerate(stretches)
                 if s[:1] != " " or not s[1:2] or s[1].isspace()}
        joined = [s for k, s in enumerate(stretches) if k not in apart] if apart else stretches
        words = self.find("".join(joined))
        ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)))
        bounds = np.cumsum(np.fromiter(map(len, joined), np.int64, len(joined)))
        cuts = np.searchsorted(ends, bounds, "right").tolist()
        found = (words[a:b] for a, b in zip([0, *cuts], cuts))
        return [apart[k] if k in apart else next(found) for k in range(len(stretches))]

    def ids(self, column: pa.Array) -> pa.Array:
        """Ids of each text."""
        names, which, sizes = _distinct_stretches(column)
        names = names.to_pylist()
        self.learn([names])
        found = [self[name] for name in names]
        lengths = np.fromiter(map(len, found), np.int64, len(found)) // 4
        size = lengths[which]
        total = np.concatenate([[0], np.cumsum(size)])
        begin = (np.cumsum(lengths) - lengths)[which] - total[:-1]
        table = np.frombuffer(b"".join(found), np.int32)
        values = table[np.repeat(begin, size) + np.arange(total[-1])]
        offsets = total[np.concatenate([[0], np.cumsum(sizes)])]
        return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(values))


def encode(docs: DataFrame, ranks_path: str, pattern: str, frequent: int = FREQUENT_WORDS
           ) -> DataFrame:
    """``doc_id, ids`` (array<int>) of each row."""
    spark = docs.sparkSession
    ranks = read_ranks(ranks_path)
    # Without a shuffle in it, Spark doesn't plan this again, nor write the plan out again.
    table = write_step(fold_words(frequent_words(docs, pattern, frequent), ranks), "words")
    # Bounded by ``frequent``.
    known = {r["word"]: r["ids"] for r in table.collect()}
    shared, name = spark.sparkContext.broadcast((ranks, known)), texts.fresh("ranks")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memory = texts.held(name, lambda: _Memory(pattern, *shared.value))
        for part in texts.slices(batches, "text", SLICE_BYTES, keep=name):
            yield pa.record_batch([part[0], memory.ids(part[1])], ["doc_id", "ids"])

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(
        run, "doc_id long, ids array<int>")


def op9_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Encode all documents, digest the ids, decode them again."""
    import public_tokenizers

    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    encoded = encode(texts.documents(spark, sf_dir), path, public_tokenizers.PATTERN)
    return encoded.select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
        F.sha2(decode(F.col("ids"), read_ranks(path)), 256).alias("decoded_sha256"))
