"""Small tables with the cases every operator must stand, and plain reference helpers."""

import random
import re

from pyspark.sql import types as T

#: Columns of documents, and further ones named like columns the operators make themselves.
SCHEMA = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
    T.StructField("lang", T.StringType()), T.StructField("source", T.StringType()),
    T.StructField("n_chars", T.LongType()),
    *(T.StructField(name, T.StringType()) for name in (
        "u", "key", "label", "row", "_id", "line", "spans", "part", "unit", "ids", "c0", "word",
        "shard", "base", "_bad_doc_id", "_drop_id", "lang_pred")),
])
_WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
_LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text):
    return _WORD.findall((text or "").translate(_LOWER))


def prose(seed, n, vocabulary=400):
    rnd = random.Random(seed)
    return " ".join(
        "".join(rnd.choice("abcdeéilmnorstu") for _ in range(2 + rnd.randrange(vocabulary) % 7))
        for _ in range(n))


def change(text, every, seed):
    rnd = random.Random(seed)
    parts = text.split(" ")
    for k in range(every - 1, len(parts), every):
        parts[k] = "x" + "".join(rnd.choice("bcdfg") for _ in range(5))
    return " ".join(parts)


def edge_texts():
    base = prose(1, 80)
    long = "\n".join(prose(100 + k, 60) for k in range(60))
    return [
        None, "", " ", "\n\n", "!!! 12 ...", "one", "One two three", base, base, base.upper(),
        change(base, 40, 2), change(base, 12, 3), prose(4, 30) + "\n" + prose(5, 30),
        prose(5, 30) + "\n" + prose(6, 25), "Zürich  naïve\t　Σίσυφος 東京 \U0001f600 é don't",
        long, long + " end", "a" * 5000, "x\r\ny\x00z",
    ]


def table(spark, texts, ids=None, langs=None):
    ids = list(range(len(texts))) if ids is None else ids
    langs = langs or ["en"] * len(texts)
    extra = ["7"] * (len(SCHEMA) - 5)
    return spark.createDataFrame(
        [(i, t, lang, "s", None if t is None else len(t), *extra)
         for i, t, lang in zip(ids, texts, langs)], SCHEMA).repartition(3)


def edges(spark):
    """All cases, with a null doc_id and a row that is there twice."""
    texts = edge_texts()
    return table(spark, [*texts, prose(9, 40), texts[7], texts[7]],
                 [*range(len(texts)), None, 900, 900])


def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def rows(df):
    return [r.asDict() for r in df.collect()]
