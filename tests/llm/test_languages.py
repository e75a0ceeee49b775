import pyarrow as pa
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from basketry.llm import languages, texts
from tests.llm import fixtures

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def trained(spark):
    return languages.train(spark.read.parquet(f"{SF}/documents.parquet").where(~languages.held_out()))


def test_held_out_accuracy(spark, trained):
    docs = spark.read.parquet(f"{SF}/documents.parquet").where(languages.held_out())
    got = languages.predict(docs, trained, [F.col("doc_id"), F.col("lang")]).collect()
    assert all(zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0 for r in got)
    assert np.mean([r["lang"] == r["lang_pred"] for r in got]) > 0.97


def test_mixture_finds_both_languages(spark, trained):
    docs = {r["lang"]: r["text"] for r in spark.read.parquet(
        f"{SF}/documents.parquet").where("n_chars > 1500").orderBy("doc_id").collect()}
    mixed = docs["de"][:1000] + "\n" + docs["fr"][:500]
    got = languages.predict(fixtures.table(spark, [mixed]), trained, [F.col("doc_id")]).first()
    assert got["lang_pred"] == "de" and set(got["shares"]) == {"de", "fr"}
    assert 0.55 < got["score"] < 0.8


def test_mixture_recovers_known_shares():
    rng = np.random.default_rng(1)
    likelihood = np.full((900, 4), -9.0)
    likelihood[np.arange(900), np.where(rng.random(900) < 0.3, 2, 0)] = 0
    share, kept = languages.mixture(likelihood)
    assert kept.tolist() == [True, False, True, False]
    assert share == pytest.approx([0.7, 0, 0.3, 0], abs=0.05)


def test_training_ignores_order_and_counts_all(spark):
    docs = fixtures.table(spark, ["abc abd", "xyz", "abc", None, "abc"], langs=["a", "b", "a", "a", None])
    model = languages.train(docs)
    assert model.names == ["a", "b"]
    assert np.array_equal(model.table, languages.train(docs.repartition(1)).table)
    counted = np.exp(model.table)
    assert (counted[:, 0] > counted[:, 0].min()).sum() == 5  # #ab abc bc# abd bd#


def test_edges(spark, trained):
    docs = fixtures.edges(spark)
    got = languages.predict(docs, trained, [F.col("doc_id"), F.col("text").alias("t")]).collect()
    assert len(got) == docs.count()
    for r in got:
        letters = r["t"] is not None and any(c.isalpha() for c in r["t"])
        assert (r["lang_pred"] == "und") == (not letters)
        assert 0 <= r["score"] <= 1


def test_no_training_rows(spark):
    model = languages.train(fixtures.empty(spark))
    got = languages.predict(fixtures.edges(spark), model, [F.col("doc_id")])
    assert got.where("lang_pred <> 'und'").count() == 0
    assert languages.predict(fixtures.empty(spark), model, [F.col("doc_id")]).count() == 0


def test_reject_keeps_columns_and_languages(spark):
    docs = fixtures.edges(spark)
    kept = languages.reject_unknown(docs)
    assert kept.columns == docs.columns
    assert kept.exceptAll(docs).count() == 0
    assert {0, 1, 2, 3, 4}.isdisjoint({r["doc_id"] for r in kept.collect()})
    assert kept.count() == docs.count() - 5


def test_texts_with_letters_stay_without_a_model(spark):
    docs = fixtures.table(spark, ["some words", "123", None, ""], [1, 2, 3, 4]).withColumn(
        "lang", F.lit(None).cast("string"))
    assert [r["doc_id"] for r in languages.reject_unknown(docs).collect()] == [1]


def test_a_slice_takes_bounded_memory():
    import tracemalloc

    raw, offsets = texts.utf8(pa.array(["some words " * (languages.SLICE_BYTES // 11)]))
    tracemalloc.start()
    languages._ngrams(raw, offsets)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 100 << 20
