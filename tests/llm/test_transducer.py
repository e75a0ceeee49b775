import hashlib
import random

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from basketry.llm import texts, transducer
from tests.llm import fixtures

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def model():
    return transducer.read_model(PATH)


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(PATH)


class NoLexicon:
    offsets, ids = np.zeros(1, np.int32), np.zeros(0, np.int32)

    def number(self, raw, starts, ends):
        return np.full(len(starts), -1, np.int64)


def hostile(n, seed=3):
    rnd = random.Random(seed)
    parts = ["a", "b", "s", "t", "re", "ve", "ll", "m", "d", "'", " ", "  ", "\n", "\t", "\r\n", "1",
             "23", "é", "ß", "東京", "\U0001f600", "!", "...", "-", "<|endoftext|>", "<|", "|>",
             "　", "\xa0", "‍", "A", "I'll", "don't", "'S", "\x00", "\x85", "́",
             "՘", "౜", "\U000323b0"]
    return ["".join(rnd.choice(parts) for _ in range(rnd.randrange(25))) for _ in range(n)]


def encoded(encoder, found):
    ids, offsets = encoder(*texts.utf8(pa.array(found, pa.string())))
    return [ids[a:b].tolist() for a, b in zip(offsets, offsets[1:])]


def lexicon(tmp_path, model, words):
    path = tmp_path / "lexicon"
    path.write_bytes(transducer.compile_words(words, transducer.merge(words, model)))
    return transducer.Lexicon(str(path))


def test_ids_equal_the_library(model, tokenizer, tmp_path):
    found = hostile(6000)
    want = [e.ids for e in tokenizer.encode_batch(found, add_special_tokens=False)]
    assert encoded(transducer._Encoder(model, NoLexicon()), found) == want
    some = sorted({w.encode() for t in found[:2000] for w in t.replace(" ", "\n ").split("\n") if w})
    assert encoded(transducer._Encoder(model, lexicon(tmp_path, model, some)), found) == want


def test_special_tokens_do_not_reach_over_texts(model, tokenizer):
    found = ["a <|endof", "text|> b", "<|endoftext|><|endoftext|>", "x  <|endoftext|>  y"]
    assert encoded(transducer._Encoder(model, NoLexicon()), found) == [
        tokenizer.encode(t, add_special_tokens=False).ids for t in found]


def test_lexicon_numbers_words_and_shares_suffixes(model, tmp_path):
    words = sorted({f"{a}{b}ing".encode() for a in "abcdefgh" for b in "klmnop"} | {
        b"a", b"ab", b"\xc3\xa9", b"\xff\x00"})
    found = lexicon(tmp_path, model, words)

    def number(some):
        places = np.cumsum([0] + [len(w) for w in some])
        raw = np.frombuffer(b"".join(some), np.uint8)
        return found.number(raw, places[:-1], places[1:]).tolist()

    assert number(words) == list(range(len(words)))
    others = [b"ak", b"akin", b"akings", b"zing", b"\xff", b"\x00", b"aking\x00", b"king"]
    assert number(others) == [-1] * len(others)
    # A tree of the words would have a state per beginning.
    assert len(found.base) < len({w[:k] for w in words for k in range(len(w) + 1)}) / 3
    assert len(lexicon(tmp_path, model, []).base) == 1


def test_merges_of_long_words(model, tokenizer):
    rnd = random.Random(4)
    for n in (1, 2, 47, 48, 49, 200, 3000):
        word = "".join(rnd.choice("abcdest") for _ in range(n)).encode()
        assert transducer.merge([word], model)[0].tolist() == transducer.merge_long(word, model) \
            == tokenizer.encode(word.decode(), add_special_tokens=False).ids


def test_frequent_words_keep_to_the_limit(spark):
    counts = spark.createDataFrame([(bytes([65 + k]), n) for k, n in enumerate(
        [100, 50, 50, 7, 3, 3, 1, 1, 1])], "word binary, n long")
    for limit, kept in ((0, 0), (1, 1), (2, 1), (3, 3), (5, 4), (6, 6), (9, 9), (50, 9)):
        assert transducer.frequent_words(counts, limit).count() == kept


@pytest.mark.parametrize("limit", [20, 1 << 17])
def test_query_form_on_edge_cases(spark, tokenizer, limit):
    table = fixtures.edges(spark)
    coded = transducer.encode(table, PATH, limit)
    got = sorted((str(r["doc_id"]), bytes(r["ids"]), r["text"])
                 for r in transducer.decode(coded, PATH).collect())
    want = []
    for r in table.collect():
        ids = tokenizer.encode(r["text"] or "", add_special_tokens=False).ids
        want.append((str(r["doc_id"]), np.array(ids, "<u4").tobytes(),
                     tokenizer.decode(ids, skip_special_tokens=False)))
    assert got == sorted(want)
    assert transducer.encode(fixtures.empty(spark), PATH).count() == 0


def test_decode_of_any_ids(spark, tokenizer):
    rnd = random.Random(8)
    lists = [[rnd.randrange(50257) for _ in range(k % 9)] for k in range(300)] + [[50256, 70000, 11]]
    rows = [(k, bytearray(np.array(i, "<u4").tobytes())) for k, i in enumerate(lists)] + [(999, None)]
    got = {r["doc_id"]: r["text"] for r in transducer.decode(
        spark.createDataFrame(rows, "doc_id long, ids binary"), PATH).collect()}
    assert got.pop(999) is None
    assert got == {k: tokenizer.decode(i, skip_special_tokens=False) for k, i in enumerate(lists)}


def test_query_equals_the_library(spark, tokenizer):
    got = transducer.op13_lexicon_bpe(spark, "/root/testdata/sf0.001").collect()
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()
    want = []
    for r in docs:
        ids = tokenizer.encode(r["text"] or "", add_special_tokens=False).ids
        text = tokenizer.decode(ids, skip_special_tokens=False)
        want.append((r["doc_id"], len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(),
                     hashlib.sha256(text.encode()).hexdigest()))
    assert sorted(map(tuple, got)) == sorted(want)


def test_other_words_are_remembered_as_bytes(model, tokenizer):
    """An array for each word takes several times the memory of its ids."""
    encoder, found = transducer._Encoder(model, NoLexicon()), ["one two", "two <|endoftext|> three"]
    want = [tokenizer.encode(t, add_special_tokens=False).ids for t in found]
    assert encoded(encoder, found) == encoded(encoder, found) == want
    assert {type(ids) for ids in encoder.others.values()} == {bytes}


def test_ids_are_written_before_they_are_decoded(spark, tmp_path, monkeypatch):
    """In one stage, encoding and decoding would take two workers for each task."""
    written, step = [], transducer.write_step
    monkeypatch.setattr(transducer, "write_step", lambda df, label: written.append(label) or step(df, label))
    fixtures.edges(spark).write.parquet(f"{tmp_path}/documents.parquet")
    transducer.op13_lexicon_bpe(spark, f"file://{tmp_path}")
    assert written == ["word-counts", "lexicon-ids"]
