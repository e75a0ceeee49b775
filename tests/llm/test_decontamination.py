from basketry.llm import decontamination
from tests.llm import fixtures


def brute_force(text, items):
    """Hit word places and items of one text."""
    found, hit, names = fixtures.words(text), set(), set()
    for item_id, item in items:
        other = fixtures.words(item)
        size = min(13, len(other))
        for k in range(len(other) - size + 1 if other else 0):
            for at in range(len(found) - size + 1):
                if found[at:at + size] == other[k:k + size]:
                    hit |= set(range(at, at + size))
                    names.add("" if item_id is None else str(item_id))
    return found, hit, names


def cases(spark):
    passage, short = fixtures.prose(50, 40), "Short item here"
    items = [(1, passage), (2, passage), (3, short), (4, None), (5, "..."), (None, fixtures.prose(51, 20)),
             (6, "again again again again again again again again again again again again again again")]
    texts = [
        *fixtures.edge_texts(), "start " + passage.upper() + " end", passage[: len(passage) // 2],
        fixtures.prose(52, 300) + " " + passage, "x short, ITEM? here y", "again " * 30,
        fixtures.prose(51, 20), "short item", passage + " z " + passage,
    ]
    return texts, items


def check(spark, block_bytes):
    texts, items = cases(spark)
    docs = fixtures.table(spark, texts)
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    got = decontamination.judge(
        decontamination.matches(docs, benchmark, block_bytes=block_bytes)).collect()
    assert len(got) == len(texts)
    for row in got:
        found, hit, names = brute_force(texts[row["doc_id"]], items)
        assert row["n_words"] == len(found)
        assert row["n_hit"] == len(hit)
        assert row["items"] == sorted(names)
        assert row["contaminated"] == (len(hit) > 0 and 20 * len(hit) >= len(found))
        for m in row["longest"]:
            item = next(t for i, t in items if ("" if i is None else str(i)) == m["item_id"])
            other, n = fixtures.words(item), m["n_words"]
            a, b = m["doc_start"], m["item_start"]
            assert found[a:a + n] == other[b:b + n]
            assert found[a + n:a + n + 1] != other[b + n:b + n + 1] or b + n == len(other)
            assert a == 0 or b == 0 or found[a - 1] != other[b - 1]
    return {r["doc_id"] for r in got if r["contaminated"]}


def test_against_brute_force(spark):
    assert check(spark, decontamination.BLOCK_BYTES)


def test_blocks_of_the_benchmark_give_the_same(spark):
    assert check(spark, 200) == check(spark, decontamination.BLOCK_BYTES)


def test_remove_keeps_columns_and_clean_rows(spark):
    texts, items = cases(spark)
    docs = fixtures.table(spark, [*texts, "a null id"], [*range(len(texts)), None])
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    kept = decontamination.remove_contaminated(docs, benchmark)
    assert kept.columns == docs.columns
    bad = check(spark, decontamination.BLOCK_BYTES)
    assert {r["doc_id"] for r in kept.collect()} == set(range(len(texts))) - bad | {None}


def test_empty_tables(spark):
    no_items = spark.createDataFrame([], "item_id long, text string")
    assert decontamination.matches(fixtures.empty(spark), no_items).count() == 0
    got = decontamination.judge(decontamination.matches(fixtures.edges(spark), no_items))
    assert got.where("contaminated").count() == 0
    assert got.count() == fixtures.edges(spark).count()


def test_rows_of_one_doc_id_are_judged_for_themselves(spark):
    passage, clean = fixtures.prose(30, 40), [fixtures.prose(31 + k, 40) for k in range(2)]
    docs = fixtures.table(spark, [passage, clean[0], passage, clean[1]], [1, 1, None, None])
    items = spark.createDataFrame([(1, passage)], "item_id long, text string")
    kept = decontamination.remove_contaminated(docs, items)
    assert kept.columns == docs.columns
    assert sorted(r["text"] for r in kept.collect()) == sorted(clean)
