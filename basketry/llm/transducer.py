"""Operator 13: byte-level BPE through a minimal acyclic transducer of frequent words.

The words of all texts are counted, and the most frequent ones (at most ``LEXICON_WORDS``) are
compiled, in order, into one automaton whose equal suffixes are shared. An arc carries how many
words of the lexicon come before those behind it, so that the sum along a word's path is the
word's number, and with it the place of its ids. The automaton is a double array in one file of
bounded size, which Spark hands to every executor and each worker maps into memory. A worker walks
all words of a slice at once, byte by byte. Words that the automaton doesn't know are merged
exactly, pair by pair in order of rank, each distinct one once while it is remembered.

Texts are cut as the tokenizer does: first at its special tokens, which are ids of their own, then
into contractions, letters, numbers, other marks and blanks.

Null text is empty; empty text has no ids and decodes to an empty text; null ids decode to null.
Ids outside the vocabulary are left out by ``decode``, and bytes that are no UTF-8 are replaced,
as the tokenizer's own decoder does. Every row is encoded for itself, so repeated rows, and rows
with a null doc_id, stay. Long texts and words have no bound of their own. Only doc_id and text
are read.
"""

from __future__ import annotations

import heapq
import json
import uuid
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark import SparkFiles
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from basketry.llm import texts
from basketry.llm.texts import write_step
from basketry.runtime import shared_dir

#: Words of the automaton at most.
LEXICON_WORDS = 1 << 17
#: Words beyond it that a worker remembers the ids of.
CACHE_WORDS = 200_000
#: Distinct words a task counts before it hands them on.
COUNTED_WORDS = 200_000
#: Bytes of text a task works on at a time: code points and offsets take some forty times as much.
SLICE_BYTES = 1 << 20
#: Words merged side by side.
MERGED_WORDS = 20_000
#: Longer words (in bytes) are merged one by one.
LONG_WORD = 48
_NEVER = np.int64(1 << 40)
_OTHER, _LETTER, _NUMBER, _BLANK, _SPECIAL, _UNKNOWN = range(6)
#: Steps of a power of two in the histogram of word counts.
_STEPS = 16


# --- the tokenizer's file ----------------------------------------------------------------

@dataclass
class Model:
    """Ids of single bytes, merges by pair of ids, bytes of each id, and special tokens."""

    single: np.ndarray
    pair_keys: np.ndarray
    pair_ranks: np.ndarray
    pair_ids: np.ndarray
    piece_bytes: bytes
    piece_offsets: np.ndarray
    specials: dict[str, int]
    by_pair: dict[int, tuple[int, int]] = field(default_factory=dict)

    def ranks(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rank of each pair (``_NEVER`` if it is never merged) and the id that it makes."""
        keys = left.astype(np.int64) << 32 | right
        at = np.minimum(np.searchsorted(self.pair_keys, keys), len(self.pair_keys) - 1)
        hit = self.pair_keys[at] == keys
        return np.where(hit, self.pair_ranks[at], _NEVER), self.pair_ids[at]


def _byte_names() -> list[str]:
    """The printable character that stands for each byte in the file."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    names, free = {b: chr(b) for b in plain}, 256
    for b in range(256):
        if b not in names:
            names[b], free = chr(free), free + 1
    return [names[b] for b in range(256)]


def read_model(path: str) -> Model:
    """A byte-level BPE without dropout, normaliser, and prefixes or suffixes of its own."""
    with open(path, encoding="utf-8") as lines:
        found = json.load(lines)
    bpe, cut, added = found["model"], found["pre_tokenizer"], found["added_tokens"]
    if found["normalizer"] or cut["type"] != "ByteLevel" or cut["add_prefix_space"] or any((
        bpe["dropout"], bpe["continuing_subword_prefix"], bpe["end_of_word_suffix"],
        bpe["ignore_merges"], not cut["use_regex"],
        *(t["single_word"] or t["lstrip"] or t["rstrip"] or t["normalized"] for t in added),
    )):
        raise ValueError(f"{path} is no plain byte-level BPE")
    names, vocab = _byte_names(), bpe["vocab"]
    byte_of = {c: b for b, c in enumerate(names)}
    merges = {}
    for rank, pair in enumerate(bpe["merges"]):
        a, b = pair.split(" ") if isinstance(pair, str) else pair
        merges.setdefault(vocab[a] << 32 | vocab[b], (rank, vocab[a + b]))
    specials = {t["content"]: t["id"] for t in added}
    pieces = [b""] * (max([*vocab.values(), *specials.values()]) + 1)
    for token, k in vocab.items():
        pieces[k] = bytes(byte_of[c] for c in token)
    for token, k in specials.items():
        pieces[k] = token.encode()
    keys = np.array(sorted(merges), np.int64)
    values = np.array([merges[k] for k in keys.tolist()], np.int64).reshape(-1, 2)
    return Model(
        np.array([vocab[c] for c in names], np.int64), keys, values[:, 0].copy(),
        values[:, 1].copy(), b"".join(pieces), np.cumsum([0] + [len(p) for p in pieces]),
        specials, merges)


# --- words of a text ---------------------------------------------------------------------

#: Class of every code point met so far.
_classes = np.full(0x110000, _UNKNOWN, np.uint8)


def classes(points: np.ndarray) -> np.ndarray:
    """Class of each code point. The tokenizers library says which characters it takes for
    letters, numbers and marks (its Unicode version is its own): each new one is tried behind a
    letter, a number and a mark, whose run it goes on with or not."""
    kind = _classes[points]
    new = np.unique(points[kind == _UNKNOWN])
    if len(new):
        from tokenizers.pre_tokenizers import ByteLevel

        cut = ByteLevel(add_prefix_space=False).pre_tokenize_str
        for start in range(0, len(new), 5000):
            part = new[start:start + 5000]
            probe = "".join(f"a{c}\n1{c}\n!{c}\n" for c in map(chr, part.tolist()))
            begins = np.zeros(len(probe) + 1, bool)
            begins[[a for _, (a, _) in cut(probe)]] = True
            joined = ~begins[1 + 3 * np.arange(3 * len(part))].reshape(-1, 3)
            _classes[part] = np.where(
                joined.any(axis=1), np.array([_LETTER, _NUMBER, _OTHER])[joined.argmax(axis=1)], _BLANK)
        kind = _classes[points]
    return kind


def cut_words(raw: np.ndarray, offsets: np.ndarray, specials: dict[str, int]
              ) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Byte offsets of all words (and the end), the first word of each text (and the end), and
    per word the id of the special token it is, or -1."""
    text = raw.tobytes().decode()
    points = np.frombuffer(text.encode("utf-32-le"), np.uint32)
    n = len(points)
    if not n:
        return np.zeros(1, np.int64), np.zeros(len(offsets), np.int64), np.zeros(0, np.int64)
    place = np.zeros(n + 1, np.int64)
    np.cumsum(1 + (points > 0x7F) + (points > 0x7FF) + (points > 0xFFFF).astype(np.int64), out=place[1:])
    bounds = np.searchsorted(place, offsets)
    kind = classes(points)
    first = np.zeros(n + 1, bool)
    first[bounds] = True
    forced = {}
    if specials and any(s in text for s in specials):
        inner = np.unique(bounds)
        pattern = "|".join(map(regex.escape, sorted(specials, key=len, reverse=True)))
        start = 0
        while found := regex.compile(pattern).search(text, start):
            a, b = found.span()
            # A token must not reach from one text into the next.
            if np.searchsorted(inner, a, "right") == np.searchsorted(inner, b, "left"):
                kind[a:b] = _SPECIAL
                first[a] = first[b] = True
                forced[a] = specials[found.group()]
                start = b
            else:
                start = a + 1
    begins = first[:n].copy()
    begins[1:] |= kind[1:] != kind[:-1]
    # The blank before a run goes with the run if it is a space; another one stands alone.
    after_blank = np.flatnonzero(begins[1:] & ~first[1:n] & (kind[:-1] == _BLANK)) + 1
    begins[after_blank - 1] = True
    begins[after_blank[points[after_blank - 1] == 32]] = False
    # An apostrophe that begins a word, with what follows it.
    marks = np.flatnonzero((points == 39) & begins)
    if len(marks):
        padded = np.concatenate([points, np.zeros(2, np.uint32)])
        cut = np.concatenate([first, np.ones(2, bool)])
        one, two = padded[marks + 1], padded[np.minimum(marks + 2, n + 1)]
        short = np.isin(one, [ord(c) for c in "stmd"]) & ~cut[marks + 1]
        long = ((two == ord("e")) & ((one == ord("r")) | (one == ord("v")))
                | (one == ord("l")) & (two == ord("l"))) & ~cut[marks + 1] & ~cut[marks + 2]
        begins[marks[short | long] + 1] = False
        ends = np.concatenate([marks[short] + 2, marks[long] + 3])
        ends = ends[ends < n]
        begins[ends[(kind[ends] == _LETTER) & ~first[ends]]] = True
    at = np.flatnonzero(begins)
    special = np.full(len(at), -1, np.int64)
    if forced:
        special[np.searchsorted(at, list(forced))] = list(forced.values())
        inside = (kind[at] == _SPECIAL) & (special < 0)
        at, special = at[~inside], special[~inside]
    return np.append(place[at], place[n]), np.searchsorted(at, bounds), special


# --- merges ------------------------------------------------------------------------------

def merge_long(word: bytes, model: Model) -> list[int]:
    """Ids of one word of any length."""
    ids = model.single[np.frombuffer(word, np.uint8)].tolist()
    after, before = list(range(1, len(ids) + 1)), list(range(-1, len(ids) - 1))
    heap = []

    def offer(at: int) -> None:
        follower = after[at]
        if follower < len(ids):
            found = model.by_pair.get(ids[at] << 32 | ids[follower])
            if found:
                heapq.heappush(heap, (found[0], at, ids[at], ids[follower], found[1]))

    for at in range(len(ids) - 1):
        offer(at)
    while heap:
        _, at, left, right, made = heapq.heappop(heap)
        follower = after[at]
        if ids[at] != left or follower >= len(ids) or ids[follower] != right:
            continue
        ids[at], ids[follower] = made, -1
        after[at] = after[follower]
        if after[at] < len(ids):
            before[after[at]] = at
        offer(at)
        if before[at] >= 0:
            offer(before[at])
    return [k for k in ids if k >= 0]


def merge(words: list[bytes], model: Model) -> list[np.ndarray]:
    """Ids of each word: the leftmost pair of lowest rank is merged until none is left. Words of
    one length are merged side by side."""
    out: list = [np.zeros(0, np.uint32)] * len(words)
    by_length: dict[int, list[int]] = {}
    for k, word in enumerate(words):
        if len(word) > LONG_WORD:
            out[k] = np.array(merge_long(word, model), np.uint32)
        elif word:
            by_length.setdefault(len(word), []).append(k)
    for length, chosen in by_length.items():
        who = np.array(chosen)
        ids = model.single[np.frombuffer(b"".join(words[k] for k in chosen), np.uint8)].reshape(-1, length)
        rank, made = model.ranks(ids[:, :-1], ids[:, 1:])
        while len(who):
            row = np.arange(len(who))
            at = rank.argmin(axis=1) if ids.shape[1] > 1 else np.zeros(len(who), np.int64)
            left = rank[row, at] < _NEVER if ids.shape[1] > 1 else np.zeros(len(who), bool)
            if not left.all():
                for k, final in zip(who[~left].tolist(), ids[~left].astype(np.uint32)):
                    out[k] = final
                who, ids, rank, made, at = who[left], ids[left], rank[left], made[left], at[left]
                row = np.arange(len(who))
                if not len(who):
                    break
            ids[row, at] = made[row, at]
            keep = np.ones(ids.shape, bool)
            keep[row, at + 1] = False
            ids = ids[keep].reshape(len(who), -1)
            keep = np.ones(rank.shape, bool)
            keep[row, at] = False
            rank, made = rank[keep].reshape(len(who), -1), made[keep].reshape(len(who), -1)
            for side, has in ((at - 1, at > 0), (at, at < rank.shape[1])):
                r, c = row[has], side[has]
                rank[r, c], made[r, c] = model.ranks(ids[r, c], ids[r, c + 1])
    return out


# --- the automaton -----------------------------------------------------------------------

def _states(words: list[bytes]) -> list[tuple[bool, tuple]]:
    """States of the smallest automaton of sorted distinct words: whether a word ends there, and
    its arcs (byte, state). A state comes after those its arcs lead to, the start last."""
    known: dict[tuple, int] = {}
    # The path of the last word: whether a word ends in the state, and its arcs so far.
    path: list[tuple[list[bool], list]] = [([False], [])]

    def settle(depth: int) -> None:
        """States below ``depth`` get no more arcs: equal ones become one."""
        while len(path) > depth + 1:
            ends, arcs = path.pop()
            node = (ends[0], tuple(arcs))
            path[-1][1].append((previous[len(path) - 1], known.setdefault(node, len(known))))

    previous = b""
    for word in words:
        same = 0
        while same < min(len(previous), len(word)) and previous[same] == word[same]:
            same += 1
        settle(same)
        path.extend(([False], []) for _ in word[same:])
        path[-1][0][0] = True
        previous = word
    settle(0)
    return [*known, (path[0][0][0], tuple(path[0][1]))]


def _bases(states: list[tuple[bool, tuple]]) -> tuple[np.ndarray, np.ndarray]:
    """Where the arcs of each state begin, and which slots are taken: states with many arcs choose
    the first place that fits them all, states with one arc fill the gaps."""
    base = np.zeros(len(states), np.int64)
    taken = np.zeros(1024 + 2 * sum(len(arcs) for _, arcs in states), bool)
    at = 0
    for k in sorted(range(len(states)), key=lambda s: -len(states[s][1])):
        labels = np.array([byte for byte, _ in states[k][1]], np.int64)
        if len(labels) < 2:
            break
        while True:
            if at + 1024 > len(taken):
                taken = np.concatenate([taken, np.zeros(len(taken), bool)])
            spots = at + np.flatnonzero(~taken[at:at + 512])
            fits = ~taken[(spots - labels[0])[:, None] + labels].any(axis=1)
            if fits.any():
                break
            # What stays free here is filled below.
            at += 512
        base[k] = spots[fits.argmax()] - labels[0]
        taken[base[k] + labels] = True
    single = [k for k, (_, arcs) in enumerate(states) if len(arcs) == 1]
    spots = np.flatnonzero(~taken)[:len(single)]
    base[single] = spots - np.array([states[k][1][0][0] for k in single], np.int64)
    taken[spots] = True
    return base, taken


def compile_words(words: list[bytes], ids: list[np.ndarray]) -> bytes:
    """The lexicon file of sorted distinct words and their ids: the start and the lengths of the
    arrays, then ``base`` and ``ends`` by state, ``check``, ``target`` and ``skip`` by slot, and
    the ids' offsets and the ids. The arc of a state for a byte is in slot ``base + byte``."""
    states = _states(words)
    base, taken = _bases(states)
    # A base may be below 0, or a byte lead beyond the last slot: the end is left free.
    used = int(np.flatnonzero(taken).max(initial=0)) + 520
    check, target, skip = np.full(used, -1), np.zeros(used, np.int64), np.zeros(used, np.int64)
    count = []
    for k, (ends, arcs) in enumerate(states):
        before = int(ends)
        for byte, state in arcs:
            slot = base[k] + byte
            check[slot], target[slot], skip[slot] = k, state, before
            before += count[state]
        count.append(before)
    lengths = np.array([len(i) for i in ids], np.int64)
    parts = (
        base, np.array([ends for ends, _ in states]), check, target, skip,
        np.concatenate([[0], np.cumsum(lengths)]), np.concatenate([*ids, np.zeros(0)]))
    header = (np.array([len(states) - 1]), np.array([len(p) for p in parts]))
    return b"".join(np.asarray(x).astype("<i4").tobytes() for x in (*header, *parts))


class Lexicon:
    """A lexicon file, mapped into memory."""

    def __init__(self, path: str):
        whole = np.asarray(np.memmap(path, np.int32, "r"))
        self.start, sizes = int(whole[0]), whole[1:8]
        at, parts = 8, []
        for size in sizes.tolist():
            parts.append(whole[at:at + size])
            at += size
        self.base, self.ends, self.check, self.target, self.skip, self.offsets, self.ids = parts

    def number(self, raw: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Number of each word in the lexicon, or -1. All words take a step at a time."""
        out = np.full(len(starts), -1, np.int64)
        who = np.flatnonzero(ends > starts)
        at, left = starts[who], (ends - starts)[who]
        state = np.full(len(who), self.start, np.int32)
        total = np.zeros(len(who), np.int64)
        while len(who):
            slot = self.base[state] + raw[at]
            known = self.check[slot] == state
            state, total = self.target[slot], total + self.skip[slot]
            left = left - 1
            done = known & (left == 0)
            if done.any():
                final = done & (self.ends[state] != 0)
                out[who[final]] = total[final]
            on = known & (left > 0)
            who, at, left, state, total = who[on], at[on] + 1, left[on], state[on], total[on]
        return out


@lru_cache(maxsize=4)
def _lexicon(name: str) -> Lexicon:
    return Lexicon(SparkFiles.get(name))


# --- in Spark ----------------------------------------------------------------------------

def word_counts(docs: DataFrame, specials: dict[str, int]) -> DataFrame:
    """``word, n``: how often each word stands in all texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.Table] = []

        def folded() -> pa.Table:
            return pa.concat_tables(held).group_by("word").aggregate([("n", "sum")]).rename_columns(
                ["word", "n"])

        for part in texts.slices(batches, "text", SLICE_BYTES):
            raw, offsets = texts.utf8(part.column(0))
            places, _, special = cut_words(raw, offsets, specials)
            starts, ends = places[:-1][special < 0], places[1:][special < 0]
            names = texts._span_hashes(texts._BYTE_VALUE[raw], starts, ends, texts._BYTE_POWERS)
            _, at, n = np.unique(names, return_index=True, return_counts=True)
            whole = raw.tobytes()
            held.append(pa.table({
                "word": pa.array([whole[a:b] for a, b in zip(
                    starts[at].tolist(), ends[at].tolist())], pa.binary()),
                "n": pa.array(n, pa.int64())}))
            if sum(map(len, held)) > COUNTED_WORDS:
                held = [folded()]
                if 2 * len(held[0]) > COUNTED_WORDS:
                    yield from held[0].to_batches()
                    held = []
        if held:
            yield from folded().to_batches()

    return docs.select(F.col("text").cast("string")).mapInArrow(run, "word binary, n long").groupBy(
        "word").agg(F.sum("n").alias("n"))


def frequent_words(counts: DataFrame, limit: int = LEXICON_WORDS) -> DataFrame:
    """The most frequent words, at most ``limit``: those above the lowest count that keeps to it.
    Counts are compared by their steps of a sixteenth power of two."""
    step = F.floor(F.log2("n") * _STEPS).cast("int")
    # A row per step, whatever the corpus holds.
    steps = counts.groupBy(step.alias("step")).agg(F.count("*").alias("words")).orderBy(
        F.desc("step")).collect()
    total, least = 0, None
    for row in steps:
        total += row["words"]
        if total > limit:
            break
        least = row["step"]
    return counts.where(step >= least if least is not None else F.lit(False)).select("word")


def build_lexicon(docs: DataFrame, model: Model, limit: int = LEXICON_WORDS) -> str:
    """Compile the frequent words of ``docs`` and hand the file to all executors; its name."""
    spark = docs.sparkSession
    counts = write_step(word_counts(docs, model.specials), "word-counts")
    shared = spark.sparkContext.broadcast(model)

    def ids_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = merge(batch[0].to_pylist(), shared.value)
            yield pa.record_batch([batch[0], pa.array([i.tobytes() for i in found], pa.binary())],
                                  ["word", "ids"])

    def compiled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, ids = [], []
        for batch in batches:
            words += batch[0].to_pylist()
            ids += [np.frombuffer(i, np.uint32) for i in batch[1].to_pylist()]
        yield pa.record_batch([pa.array([compile_words(words, ids)], pa.binary())], ["file"])

    # ``limit`` words at most are sorted and compiled in one task.
    words = frequent_words(counts, limit).mapInArrow(ids_of, "word binary, ids binary")
    content = bytes(words.coalesce(1).sortWithinPartitions("word").mapInArrow(
        compiled, "file binary").first()["file"])
    name = f"lexicon-{uuid.uuid4().hex}"
    path = f"{shared_dir(spark).rstrip('/')}/{name}"
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    out = hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).create(hadoop)
    try:
        out.write(bytearray(content))
    finally:
        out.close()
    spark.sparkContext.addFile(hadoop.makeQualified(
        hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())).toString())
    return name


class _Encoder:
    def __init__(self, model: Model, lexicon: Lexicon):
        self.model, self.lexicon = model, lexicon
        # Ids as bytes: an array of its own for each word would take several times as much.
        self.others: dict[bytes, bytes] = {}

    def __call__(self, raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts and the offsets of the texts in them."""
        lexicon = self.lexicon
        places, first, special = cut_words(raw, offsets, self.model.specials)
        starts, ends = places[:-1], places[1:]
        number = lexicon.number(raw, starts, ends)
        number[special >= 0] = -1
        known = number >= 0
        begin = np.zeros(len(starts), np.int64)
        size = np.zeros(len(starts), np.int64)
        begin[known] = lexicon.offsets[number[known]]
        size[known] = lexicon.offsets[number[known] + 1] - begin[known]
        extra, used = [lexicon.ids], len(lexicon.ids)
        unknown = np.flatnonzero(~known)
        if len(unknown):
            found, which = self._others(raw, starts, ends, special, unknown)
            lengths = np.array([len(i) // 4 for i in found], np.int64)
            begin[unknown] = (used + np.cumsum(lengths) - lengths)[which]
            size[unknown] = lengths[which]
            extra.append(np.frombuffer(b"".join(found), "<u4"))
        table = np.concatenate(extra) if len(extra) > 1 else lexicon.ids
        total = np.concatenate([[0], np.cumsum(size)])
        ids = table[np.repeat(begin - total[:-1], size) + np.arange(total[-1])]
        return ids.astype("<u4"), total[first]

    def _others(self, raw, starts, ends, special, unknown) -> tuple[list[bytes], np.ndarray]:
        """Ids, as bytes, of the distinct words among ``unknown``, and which of them each one is."""
        whole, memory, index = raw.tobytes(), self.others, {}
        which = np.empty(len(unknown), np.int64)
        for k, (a, b, token) in enumerate(zip(
            starts[unknown].tolist(), ends[unknown].tolist(), special[unknown].tolist())):
            key = whole[a:b] if token < 0 else token
            which[k] = index.setdefault(key, len(index))
        new = [w for w in index if not isinstance(w, int) and w not in memory]
        if len(memory) + len(new) > CACHE_WORDS:
            memory.clear()
            new = [w for w in index if not isinstance(w, int)]
        for start in range(0, len(new), MERGED_WORDS):
            part = new[start:start + MERGED_WORDS]
            memory.update(zip(part, (i.astype("<u4").tobytes() for i in merge(part, self.model))))
        return [w.to_bytes(4, "little") if isinstance(w, int) else memory[w] for w in index], which


def encode(docs: DataFrame, vocabulary: str, limit: int = LEXICON_WORDS) -> DataFrame:
    """``doc_id, ids``: ids of each text as little-endian unsigned 32-bit numbers."""
    model = read_model(vocabulary)
    name = build_lexicon(docs, model, limit)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = texts.held(name, lambda: _Encoder(shared.value, _lexicon(name)))
        for part in texts.slices(batches, "text", SLICE_BYTES, keep=name):
            ids, offsets = encoder(*texts.utf8(part[1]))
            coded = pa.Array.from_buffers(pa.binary(), part.num_rows, [
                None, pa.py_buffer((4 * offsets).astype(np.int32).tobytes()),
                pa.py_buffer(ids.tobytes())])
            yield pa.record_batch([part[0], coded], ["doc_id", "ids"])

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(
        run, "doc_id long, ids binary")


def decode(encoded: DataFrame, vocabulary: str) -> DataFrame:
    """``doc_id, ids, text`` of rows with ``doc_id, ids``."""
    shared = encoded.sparkSession.sparkContext.broadcast(read_model(vocabulary))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        flat, places = np.frombuffer(model.piece_bytes, np.uint8), model.piece_offsets
        sizes = np.diff(places)
        for part in texts.slices(batches, "ids", SLICE_BYTES):
            raw, offsets = texts.utf8(part[1])
            ids = np.frombuffer(raw.tobytes(), "<u4").astype(np.int64)
            inside = ids < len(sizes)
            ids = np.where(inside, ids, 0)
            size = np.where(inside, sizes[ids], 0)
            total = np.concatenate([[0], np.cumsum(size)])
            out = flat[np.repeat(places[ids] - total[:-1], size) + np.arange(total[-1])].tobytes()
            ends = total[offsets // 4].tolist()
            decoded = [out[a:b].decode("utf-8", "replace") for a, b in zip(ends, ends[1:])]
            yield pa.record_batch([part[0], part[1], pa.array(
                decoded, pa.string(), mask=part[1].is_null().to_numpy(zero_copy_only=False))],
                ["doc_id", "ids", "text"])

    return encoded.select("doc_id", "ids").mapInArrow(run, "doc_id long, ids binary, text string")


def op13_lexicon_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Encode all documents, decode the ids, and digest both."""
    import public_tokenizers

    path = public_tokenizers.path("byte_bpe_50k.json")
    # Encoding and decoding in one stage would take two workers, with their memory, for each task.
    found = decode(write_step(encode(texts.documents(spark, sf_dir), path), "lexicon-ids"), path)
    return found.select(
        "doc_id", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2(F.encode("text", "UTF-8"), 256).alias("decoded_sha256"))
