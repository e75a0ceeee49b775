import hashlib

import public_tokenizers
import pyarrow as pa
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st

from basketry.llm import bpe
from tests.llm import fixtures

PATH = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
RANKS = bpe.read_ranks(PATH)
WHOLE = tiktoken.Encoding(
    "own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=RANKS, special_tokens={})
MEMORY = bpe._Memory(public_tokenizers.PATTERN, RANKS, {})


@settings(max_examples=300)
@given(st.text(alphabet=" \n\tab'sZé東!1　\U0001f600", max_size=30))
def test_stretches_are_cut_where_no_word_reaches(text):
    MEMORY.learn([bpe._stretches(text)])
    coded = b"".join(MEMORY[s] for s in bpe._stretches(text))
    ids = [int.from_bytes(coded[k:k + 4], "little") for k in range(0, len(coded), 4)]
    assert ids == WHOLE.encode_ordinary(text)


def test_spark_folds_like_the_library(spark):
    words = ["hello", " the", "été", "東京", "\U0001f600", "!!!", "a", " supercalifragilistic", "123"]
    got = bpe.fold_words(spark.createDataFrame([(w,) for w in words], "word string"), RANKS)
    assert {r["word"]: r["ids"] for r in got.collect()} == {
        w: WHOLE.encode_ordinary(w) for w in words}


def test_round_trip(spark):
    docs = fixtures.edges(spark)
    encoded = bpe.encode(docs, PATH, public_tokenizers.PATTERN, frequent=50)
    got = encoded.select("doc_id", "ids", bpe.decode(encoded["ids"], RANKS).alias("back")).collect()
    texts = [(r["doc_id"], r["text"] or "") for r in docs.collect()]
    key = lambda x: (x[0] is None, x[0] or 0, x[1])
    assert sorted(((r["doc_id"], bytes(r["back"]).decode()) for r in got), key=key) == sorted(
        texts, key=key)
    assert sorted(hashlib.md5(str(r["ids"]).encode()).hexdigest() for r in got) == sorted(
        hashlib.md5(str(WHOLE.encode_ordinary(t)).encode()).hexdigest() for _, t in texts)


def test_empty_table(spark):
    assert bpe.encode(fixtures.empty(spark), PATH, public_tokenizers.PATTERN).count() == 0


def test_words_are_folded_together_like_one_by_one():
    words = [" hello", "", "ééé", "東京都", "aaaaaaaaaaaaaaaa", " the", "zzqx", "\U0001f600\U0001f600"]
    words += fixtures.prose(5, 300).split(" ")
    got = bpe.fold(words, RANKS, MEMORY.pairs)
    for word, ids in zip(words, got):
        assert [int.from_bytes(ids[k:k + 4], "little") for k in range(0, len(ids), 4)] == (
            WHOLE.encode_ordinary(word) if word != "" else [])


def test_stretches_found_together_like_one_by_one():
    stretches = [" a", " b!", "x", " ", " \n", " c\n", " d's", "  e", ""]
    assert MEMORY._words(stretches) == [MEMORY.find(s) for s in stretches]


@settings(max_examples=200)
@given(st.lists(st.one_of(st.none(), st.text(alphabet=" \n\tab'\x1f\x1c\x85\u2003東!", max_size=12)), max_size=4))
def test_distinct_stretches_of_a_column(texts):
    for column in (texts, [None if t is None else "a".join(t.split()) for t in texts]):
        names, which, sizes = bpe._distinct_stretches(pa.array(column, pa.string()))
        names, at = names.to_pylist(), [0, *sizes.cumsum().tolist()]
        assert len(set(names)) == len(names)
        assert ["".join(names[k] for k in which[a:b]) for a, b in zip(at, at[1:])] == [
            t or "" for t in column]
        got = MEMORY.ids(pa.array(column, pa.string())).to_pylist()
        assert got == [WHOLE.encode_ordinary(t or "") for t in column]


def test_a_word_is_remembered_once():
    memory = bpe._Memory(public_tokenizers.PATTERN, RANKS, {})
    memory.learn([[" hello", " zzqx", " hello!", ""]])
    assert set(memory) == {" hello", " zzqx", " hello!", "!", ""}


def test_ranks_stand_once_in_the_plan_that_folds(spark):
    words = spark.createDataFrame([("word",)], "word string")
    literal = '"616263"'
    ranks = {**{bytes([b]): b for b in range(256)}, b"ab": 256, b"abc": 257}
    folded = bpe.fold_words(words, ranks)
    assert folded._jdf.queryExecution().analyzed().toString().count(literal) == 1
    assert "AdaptiveSparkPlan" not in folded._jdf.queryExecution().executedPlan().toString()


def test_frequent_stretches_are_ranked_apart_from_the_driver(spark, monkeypatch):
    written, step = [], bpe.write_step
    monkeypatch.setattr(bpe, "write_step", lambda df, label: written.append(label) or step(df, label))
    docs = spark.createDataFrame([("a b b c c c",), ("c b d",), (None,)], "text string")
    assert [r["word"] for r in bpe.frequent_words(docs, public_tokenizers.PATTERN, 2).collect()] == [" b", " c"]
    assert written == ["frequent-stretches"]
