import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
from hypothesis import given
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from basketry.llm import tokens
from tests.llm import fixtures

PATH = public_tokenizers.path("word_bpe_49k.json")


@given(st.lists(st.integers(0, (1 << 32) - 1)))
def test_numbers_round_trip(values):
    values = np.array(values, np.uint32)
    assert np.array_equal(tokens.unpack(*tokens.pack(values), len(values)), values)


def read_back(spark, docs, tmp_path):
    tokens.write_tokens(docs, f"file://{tmp_path}/t", PATH, 1)
    found = tokens.read_tokens(spark, f"file://{tmp_path}/t").withColumn("crc", F.crc32("ids"))
    return fixtures.rows(found)


def test_files_equal_the_library(spark, tmp_path):
    docs = fixtures.edges(spark)
    got = read_back(spark, docs, tmp_path)
    whole = Tokenizer.from_file(PATH)
    expected, start = [], 0
    order = sorted(docs.collect(), key=lambda r: (r["doc_id"] is not None, r["doc_id"] or 0))
    for row in order:
        ids = whole.encode(row["text"] or "", add_special_tokens=False).ids + [1]
        expected.append((start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    assert sorted((r["start"], r["n_tokens"], r["crc"]) for r in got) == expected
    assert sorted((r["doc_id"] is not None, r["doc_id"] or 0, r["start"]) for r in got) == [
        (r["doc_id"] is not None, r["doc_id"] or 0, e[0]) for r, e in zip(order, expected)]


def test_empty_table(spark, tmp_path):
    assert read_back(spark, fixtures.empty(spark), tmp_path) == []


def test_frequent_ids_take_one_byte():
    control, data = tokens.pack(np.zeros(100, np.uint32))
    assert len(control) == 25 and len(data) == 100


def test_pieces_share_their_parts():
    """Only parts become Python strings, and each is encoded once."""
    pieces, whole = tokens._Pieces(PATH), Tokenizer.from_file(PATH)
    marks = ["", ".", "!?", "(", "'", "...", "<|", "#$"]
    words = ["word", "Word", "WORD", "don't", "Straße", "é", "İx", "12", "a.b", "東京", "x²", "\x00", ""]
    names = [a + w + b for a in marks for w in words for b in marks]
    for part in (names, names[::-1], names[:5], []):
        ids, sizes = pieces.ids(pa.array(part, pa.string()))
        ends = np.cumsum(sizes).tolist()
        assert [ids[a:b].tolist() for a, b in zip([0, *ends], ends)] == [
            whole.encode(name, add_special_tokens=False).ids for name in part]
    pieces = tokens._Pieces(PATH)
    pieces.ids(pa.array([a + w + b for a in ".!?" for w in ("word", "Word", "12") for b in ".!?"]))
    assert sorted(pieces.number) == ["!", ".", "12", "?", "word"]


def test_forgotten_parts_are_encoded_again(monkeypatch):
    monkeypatch.setattr(tokens, "CACHE_PIECES", 3)
    pieces = tokens._Pieces(PATH)
    first = pieces.ids(pa.array(["one", "two.", "three", "four", "five"]))
    again = pieces.ids(pa.array(["five", "one"]))
    assert len(pieces.number) == 3
    assert again[0].tolist() == [*first[0][-again[1][0]:], *first[0][:first[1][0]]]
