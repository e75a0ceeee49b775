"""The registered queries over the whole smallest tables, against plain Python."""

import base64
import hashlib
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from tokenizers import Tokenizer

import __spark_entry__ as driver
from tests.llm import fixtures, test_decontamination, test_lines, test_pii, test_secrets, test_shingles

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def docs(spark):
    rows = spark.read.parquet(f"{SF}/documents.parquet").orderBy("doc_id").collect()
    return [(r["doc_id"], r["text"] or "") for r in rows]


def run(spark, name):
    return {r["doc_id"]: r.asDict() for r in driver.queries()[name](spark, SF).collect()}


def sha(text):
    return hashlib.sha256(text if isinstance(text, bytes) else text.encode()).hexdigest()


def test_token_files(spark, docs):
    got, start = run(spark, "op1_token_files"), 0
    whole = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    for doc_id, text in docs:
        ids = whole.encode(text, add_special_tokens=False).ids + [1]
        assert (got[doc_id]["start"], got[doc_id]["n_tokens"]) == (start, len(ids))
        assert got[doc_id]["ids_crc32"] == zlib.crc32(np.array(ids, "<u4").tobytes())
        start += len(ids)


def test_shards(spark, docs):
    got, slots, groups = run(spark, "op2_shards"), defaultdict(list), defaultdict(set)
    for doc_id, text in docs:
        row = got[doc_id]
        assert row["size"] == len(text.encode()) + 1
        assert row["text_crc32"] == zlib.crc32(text.encode())
        assert (row["law"], row["grown_shard"]) == ("rows", None)
        slots[row["shard"]].append(row["slot"])
        groups[text].add(row["shard"])
    assert sorted(slots) == list(range(8))
    assert all(sorted(s) == list(range(25)) for s in slots.values())
    assert all(len(s) == 1 for s in groups.values())


def test_personal_data(spark, docs):
    got = run(spark, "op3_personal_data")
    for doc_id, text in docs:
        base = test_pii.slow_base(text)
        names = [f"{test_pii.pii.KINDS[k]}:{a}:{b}" for k, a, b in base]
        assert got[doc_id]["base_sha256"] == sha(",".join(names))
        count = Counter(k for k, _, _ in base)
        for k, kind in enumerate(test_pii.pii.KINDS):
            assert got[doc_id][f"n_{kind}"] == count[k]
        assert set(names) <= set(filter(None, got[doc_id]["spans"].split(",")))


def test_contamination(spark, docs):
    got = run(spark, "op4_contamination")
    items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    places = defaultdict(set)
    for item_id, text in items:
        found = fixtures.words(text)
        size = min(13, len(found))
        for k in range(len(found) - size + 1 if found else 0):
            places[tuple(found[k:k + size])].add(str(item_id))
    sizes = {len(w) for w in places}
    for doc_id, text in docs:
        found, hit, names = fixtures.words(text), set(), set()
        for n in sizes:
            for k in range(len(found) - n + 1):
                if (own := places.get(tuple(found[k:k + n]))) is not None:
                    hit |= set(range(k, k + n))
                    names |= own
        row = got[doc_id]
        assert (row["n_words"], row["n_hit"], row["n_items"]) == (len(found), len(hit), len(names))
        assert row["items_sha256"] == sha(",".join(sorted(names)))
        assert row["contaminated"] == (len(hit) > 0 and 20 * len(hit) >= len(found))
    assert any(r["contaminated"] for r in got.values())


def test_fingerprints(spark, docs):
    got = run(spark, "op6_fingerprints")
    falling = docs[::-1]
    for (doc_id, text), (_, after) in zip(falling, falling[1:] + falling[:1]):
        half = len(text) // 2
        assert got[doc_id]["n_chars"] == len(text)
        assert got[doc_id]["edited_sha256"] == sha(text[:len(text) - half] + after[:half])
        assert 0 <= got[doc_id]["near_next"] <= 1
    assert np.mean([r["near_edited"] for r in got.values()]) > 0.35


def test_near_documents(spark, docs):
    got = run(spark, "op7_near_documents")
    _, near, group = test_shingles.brute_force([(0, t) for _, t in docs[:120]])
    subset = {r["doc_id"]: r for r in test_shingles.shingles.near_duplicates(
        spark.read.parquet(f"{SF}/documents.parquet").where("doc_id < 120")).collect()}
    for k in range(120):
        assert subset[k]["n_links"] == sum(n for j, n in enumerate(near[k]) if j != k)
        assert subset[k]["class_id"] == group[k]
    assert len(got) == len(docs)


def test_secrets_found(spark, docs):
    got = run(spark, "op8_secrets")
    rules = test_secrets.secrets.RULES
    for doc_id, text in docs:
        spans = [(a, k, b) for a, k, b in test_secrets.brute_force(text) if k < 3]
        assert got[doc_id]["base_sha256"] == sha(",".join(
            f"{rules[k].kind}:{a}:{b}" for a, k, b in spans))
        assert [got[doc_id][f"n_{rules[k].kind}"] for k in range(3)] == [
            sum(s[1] == k for s in spans) for k in range(3)]


def test_byte_bpe(spark, docs):
    got = run(spark, "op9_byte_bpe")
    with open(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    whole = tiktoken.Encoding(
        "own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    for doc_id, text in docs:
        ids = whole.encode_ordinary(text)
        assert got[doc_id]["n_tokens"] == len(ids)
        assert got[doc_id]["ids_sha256"] == sha(",".join(map(str, ids)))
        assert got[doc_id]["decoded_sha256"] == sha(text)


def test_repeated_lines(spark, docs):
    got = run(spark, "op10_repeated_lines")
    gone = test_lines.brute_force(docs)
    for row, (doc_id, text) in enumerate(docs):
        expected = gone.get(row, {})
        assert got[doc_id]["n_removed"] == len(expected)
        assert got[doc_id]["removed"] == ",".join(
            f"{k}:{d}:{n}" for k, (d, n) in sorted(expected.items()))
        parts = text.split("\n")
        assert got[doc_id]["n_lines"] == len(parts) - (parts[-1] == "")


