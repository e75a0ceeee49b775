import re

from hypothesis import given
from hypothesis import strategies as st
from pyspark.sql import functions as F

from basketry.llm import pii
from tests.llm import fixtures

TEXTS = [
    "write to ann.lee+x@mail.example.com, now", "a@b no dot", "10.0.0.1 and 300.1.1.1 and 1.2.3.4.5",
    "card 4111 1111 1111 1111 or 4111-1111-1111-1112", "call +1 (555) 123-4567 or +1", "é +49 30 1234567",
    "0001.0.0.0255", "4111111111111111" * 2,
]


def slow_base(text):
    out = []
    for rank, kind in enumerate(pii.KINDS):
        for m in re.finditer(pii._BASE[kind].pattern, text):
            digits = re.sub("[^0-9]", "", m.group())
            if kind == "ip" and any(int(p) > 255 for p in m.group().split(".")):
                continue
            if kind == "card" and not (16 <= len(digits) <= 19 and pii.luhn(digits)):
                continue
            if kind == "phone" and not 8 <= len(digits) <= 15:
                continue
            out.append((rank, m.start(), m.end()))
    return out


@given(st.text(alphabet="a@.+-( )0123456789é", max_size=60))
def test_base_needs_no_retry(text):
    assert pii.base_spans(text) == slow_base(text)


def test_luhn():
    assert pii.luhn("4111111111111111") and not pii.luhn("4111111111111112")


def test_base_spans_stay_and_features_have_one_length(spark):
    texts = TEXTS + fixtures.edge_texts()
    found = pii.propose(fixtures.table(spark, texts)).collect()
    assert {len(c["features"]) for r in found for c in r["candidates"]} == {26}
    got = pii.find_pii(fixtures.table(spark, texts)).collect()
    assert len(got) == len(texts)
    for r in got:
        base = slow_base(texts[r["doc_id"]] or "")
        assert [tuple(s) for s in r["base"]] == base
        assert set(base) <= {tuple(s) for s in r["spans"]}


def test_trees_add_what_looks_alike(spark):
    texts = [f"mail user{k}.x@host{k}.example.com or ratio 3.14.15 of a{k}@b done" for k in range(160)]
    texts += [f"write to usér{k}@host{k}.example.com please" for k in range(4)]
    got = {r["doc_id"]: r for r in pii.find_pii(fixtures.table(spark, texts), sample=300).collect()}
    assert all(len(got[k]["base"]) == 1 for k in range(160))
    assert all(len(got[k]["spans"]) == 1 for k in range(160))


def test_thresholds_hold_the_precision():
    scored = [(0, 1, 0.9)] * 30 + [(0, 0, 0.4)] * 30 + [(1, 1, 0.8), (1, 0, 0.9)]
    assert pii._thresholds(scored, 0.99) == {0: 0.9}


def test_redaction(spark):
    got = pii.redact(fixtures.table(spark, [TEXTS[0], TEXTS[2], None, "plain"])).collect()
    assert {r["doc_id"]: r["text"] for r in got} == {
        0: "write to [email], now", 1: "[ip] and 300.1.1.1 and [ip].5", 2: None, 3: "plain"}


def test_null_ids_and_empty_table(spark):
    got = pii.find_pii(fixtures.table(spark, [TEXTS[0], TEXTS[0]], [None, None])).collect()
    assert [len(r["spans"]) for r in got] == [1, 1]
    assert pii.find_pii(fixtures.empty(spark)).count() == 0


def test_all_candidates_teach(spark, monkeypatch):
    n = 21_000
    features = F.array(*(F.when(F.col("id") % 3 == 0, F.lit(float(k))).otherwise(F.lit(1.0)).cast("float")
                         for k in range(26)))
    candidate = F.struct(
        F.lit(0).alias("rank"), F.lit(0).alias("start"), F.lit(9).alias("end"),
        (F.col("id") % 3 == 0).cast("int").alias("label"), features.alias("features"))
    found = spark.range(n).select(F.col("id").alias("row"), F.array(candidate).alias("candidates"))
    kept, real = [], pii.write_step
    monkeypatch.setattr(pii, "write_step", lambda df, label: kept.append(real(df, label)) or kept[-1])
    pii.select_added(found)
    assert kept[0].count() == n


def test_limits_of_counted_scores(spark):
    scored = [(k % 4, float(k % 7 > 2 or k % 5 == 0), (k * 7 % 11) / 11) for k in range(700)]
    scored += [(0, 1.0, 0.99)] * 30
    frame = spark.createDataFrame(scored, "rank int, label double, p double")
    for precision in (0.3, 0.7, 0.99):
        want = pii._thresholds([(r, y, s) for r, y, s in scored], precision)
        assert pii._limits(frame, precision) == want
