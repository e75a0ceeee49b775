import zlib
from collections import Counter, defaultdict

from basketry.llm import sharding
from tests.llm import fixtures


def check(rows, n):
    per = defaultdict(list)
    for r in rows:
        per[r["shard"]].append(r["slot"])
    assert sum(map(len, per.values())) == n
    sizes = [len(per[s]) for s in range(8)]
    assert max(sizes) - min(sizes) <= 1
    assert all(sorted(slots) == list(range(len(slots))) for slots in per.values())


def test_edges(spark):
    docs = fixtures.edges(spark)
    got = sharding.assign_shards(docs).collect()
    check(got, docs.count())
    assert Counter((r["doc_id"], r["size"], r["text_crc32"]) for r in got) == Counter(
        (r["doc_id"], len((r["text"] or "").encode()) + 1, zlib.crc32((r["text"] or "").encode()))
        for r in docs.collect())


def test_groups_stay_together(spark):
    texts = [fixtures.prose(k // 4, 20) + "\n" + fixtures.prose(1000 + k // 4, 20) for k in range(160)]
    docs = fixtures.table(spark, texts)
    got = sharding.assign_shards(docs).collect()
    check(got, 160)
    shards = defaultdict(set)
    for r in got:
        shards[texts[r["doc_id"]]].add(r["shard"])
    assert sum(len(s) > 1 for s in shards.values()) <= 8


def test_near_copies_move_together(spark):
    lines = [[fixtures.prose(10 * g + k, 12) for k in range(12)] for g in range(24)]
    texts = ["\n".join(own[:v % 12] + [f"changed {v}"] + own[v % 12 + 1:])
             for own in lines for v in range(6)]
    got = sharding.assign_shards(fixtures.table(spark, texts)).collect()
    check(got, len(texts))
    together = Counter((r["doc_id"] // 6, r["shard"]) for r in got)
    best = defaultdict(int)
    for (g, _), n in together.items():
        best[g] = max(best[g], n)
    assert sum(best.values()) > 0.7 * len(texts)


def test_one_group_with_most_rows_is_split(spark):
    docs = fixtures.table(spark, ["same text\nover and over"] * 90 + [f"other {k}" for k in range(13)])
    check(sharding.assign_shards(docs).collect(), 103)


def test_empty_table(spark):
    assert sharding.assign_shards(fixtures.empty(spark)).count() == 0
