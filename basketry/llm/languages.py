"""Operator 5: the languages of a document as a mixture.

Character n-grams (three UTF-8 bytes of a word, its ends included) are counted per language over
all labelled rows and give log-likelihoods; n-grams share a table of fixed size by hash, so the
model is bounded: ``BUCKETS`` numbers per language. A document's words are then observations of
a mixture: expectation-maximisation estimates the share of each language, starting from all.
The set of languages is selected by penalised likelihood: languages are dropped from the
smallest share on, as long as that lowers the Bayesian information criterion. The prediction is
the language with the largest share, its score that share.

A text without a letter, and a null text, is ``und`` with score 0. Ties go to the language whose
name sorts first. Only text and lang of training rows are learned from; predictions read the
text alone. With no training rows every text is ``und``. Repeated rows are predicted alike.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from basketry.llm import texts

BUCKETS = 1 << 16
ROUNDS = 8
#: Bytes of text a task works on at a time; their n-grams take many times as much.
SLICE_BYTES = 1 << 20
UNKNOWN = "und"
_SMOOTH = 0.5
#: Most that one word says for one language against another, which tempers n-grams that are
#: not independent.
_WORD_WEIGHT = 0.5
_LETTER = regex.compile(r"\p{L}")


@dataclass
class Model:
    """Names of the languages (sorted) and log-likelihoods, a row per n-gram bucket."""

    names: list[str]
    table: np.ndarray


def _ngrams(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, texts.Words]:
    """Buckets of all n-grams, where each word's begin, and the words. A word ``w`` of ``n``
    bytes has ``n`` n-grams: each byte with its neighbours, a blank beyond the ends."""
    found = texts.words(raw, offsets)
    lengths = found.ends - found.starts
    first = np.cumsum(lengths) - lengths
    at = np.repeat(found.starts - first, lengths) + np.arange(lengths.sum())
    middle = found.lowered[at].astype(np.uint32)
    before, after = np.empty_like(middle), np.empty_like(middle)
    before[1:], after[:-1] = middle[:-1], middle[1:]
    if len(middle):
        before[first], after[first + lengths - 1] = 32, 32
    code = (before << np.uint32(16) | middle << np.uint32(8) | after) * np.uint32(2654435761)
    return code >> np.uint32(16), first, found


def train(rows: DataFrame) -> Model:
    """Model of ``text, lang`` rows; all of them are counted."""
    languages = [r[0] for r in rows.where("text is not null and lang is not null")
                 .select(F.col("lang").cast("string")).distinct().orderBy("lang").collect()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[str, np.ndarray] = {}
        for part in texts.slices(batches, "text", SLICE_BYTES):
            raw, offsets = texts.utf8(part[0])
            buckets, first, found = _ngrams(raw, offsets)
            starts = np.append(first, len(buckets))[found.offsets]
            langs = np.array(part[1].to_pylist(), object)
            for lang in set(langs):
                chosen = np.repeat(langs == lang, np.diff(starts))
                counts = np.bincount(buckets[chosen], minlength=BUCKETS)
                total[lang] = total.get(lang, 0) + counts
        for lang, counts in total.items():
            seen = np.flatnonzero(counts)
            yield pa.record_batch([
                pa.array([lang] * len(seen), pa.string()), pa.array(seen.astype(np.int32)),
                pa.array(counts[seen].astype(np.int64)),
            ], ["lang", "bucket", "n"])

    counted = rows.where("text is not null and lang is not null").select(
        F.col("text").cast("string"), F.col("lang").cast("string")).mapInArrow(
        run, "lang string, bucket int, n long").groupBy("lang", "bucket").agg(F.sum("n").alias("n"))
    # Bounded: a row per language and bucket.
    found = counted.toPandas()
    table = np.full((BUCKETS, len(languages)), _SMOOTH)
    for k, lang in enumerate(languages):
        mine = found[found["lang"] == lang]
        table[mine["bucket"], k] += mine["n"]
    return Model(languages, np.log(table / table.sum(axis=0)).astype(np.float32))


def mixture(likelihood: np.ndarray, rounds: int = ROUNDS) -> tuple[np.ndarray, np.ndarray]:
    """Shares of the languages by expectation-maximisation from ``words x languages``
    log-likelihoods, and which of them the criterion keeps."""
    scale = likelihood.max(axis=1, keepdims=True)
    weight = np.exp(likelihood - scale)
    kept = np.ones(likelihood.shape[1], bool)
    penalty = 0.5 * np.log(max(len(likelihood), 2))

    def fit(chosen: np.ndarray) -> tuple[np.ndarray, float]:
        part = weight[:, chosen]
        share = np.full(part.shape[1], 1 / part.shape[1])
        for _ in range(rounds):
            joint = part * share
            whole = np.maximum(joint.sum(axis=1, keepdims=True), 1e-30)
            share = (joint / whole).mean(axis=0)
        return share, float(np.log(np.maximum(part @ share, 1e-30)).sum())

    share, fitted = fit(kept)
    while kept.sum() > 1:
        fewer = kept.copy()
        fewer[np.flatnonzero(kept)[np.argmin(share)]] = False
        share_fewer, fitted_fewer = fit(fewer)
        if fitted - fitted_fewer > penalty:
            break
        kept, share, fitted = fewer, share_fewer, fitted_fewer
    full = np.zeros(len(kept))
    full[kept] = share
    return full, kept


def predict(docs: DataFrame, model: Model, keep: list[Column]) -> DataFrame:
    """The columns ``keep`` of each row, with ``lang_pred, score`` and ``shares`` (of the
    selected languages)."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    rows = docs.select(*keep, F.col("text").cast("string").alias("_text"))
    schema = rows.drop("_text").withColumns({
        "lang_pred": F.lit("").cast("string"), "score": F.lit(0.0),
        "shares": F.lit(None).cast("map<string,double>")}).schema
    at = len(keep)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, table = shared.value.names, shared.value.table
        for part in texts.slices(batches, "_text", SLICE_BYTES):
            buckets, first, found = _ngrams(*texts.utf8(part[at]))
            per_word = np.zeros((len(first), len(names)), np.float32)
            if len(first) and names:
                for k in range(len(names)):
                    per_word[:, k] = np.add.reduceat(table[buckets, k], first)
            per_word *= _WORD_WEIGHT
            predicted, scores, shares = [], [], []
            for text, a, b in zip(part[at].to_pylist(), found.offsets[:-1], found.offsets[1:]):
                if not names or a == b or not _LETTER.search(text):
                    predicted.append(UNKNOWN), scores.append(0.0), shares.append(None)
                    continue
                share, kept = mixture(per_word[a:b])
                best = int(np.argmax(share))
                predicted.append(names[best])
                scores.append(min(1.0, float(share[best])))
                shares.append([(names[k], float(share[k])) for k in np.flatnonzero(kept)])
            yield pa.record_batch([
                *(part[k] for k in range(at)), pa.array(predicted, pa.string()),
                pa.array(scores, pa.float64()),
                pa.array(shares, pa.map_(pa.string(), pa.float64())),
            ], [*part.schema.names[:at], "lang_pred", "score", "shares"])

    return rows.mapInArrow(run, schema)


def held_out() -> Column:
    """A fifth of the documents, by checksum of the id, that training leaves out."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0, F.lit(False))


def reject_unknown(docs: DataFrame) -> DataFrame:
    """``docs`` with all their columns, without the texts that have no language. The model is
    learned from the rows that are not held out; where it knows no language, texts with a letter
    stay."""
    model = train(docs.where(~held_out()))
    if not model.names:
        return docs.where(F.col("text").rlike(r"\p{L}"))
    columns = docs.columns
    named = docs.select(*(docs[c].alias(f"c{k}") for k, c in enumerate(columns)), docs["text"])
    found = predict(named, model, [F.col(f"c{k}") for k in range(len(columns))])
    return found.where(F.col("lang_pred") != UNKNOWN).select(
        *(F.col(f"c{k}").alias(c) for k, c in enumerate(columns)))


def op5_languages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Predict every document with a model learned from the rows not held out."""
    docs = texts.documents(spark, sf_dir)
    model = train(docs.where(~held_out()))
    return predict(docs, model, [F.col("doc_id").cast("long").alias("doc_id"),
                                 held_out().alias("held_out")])
