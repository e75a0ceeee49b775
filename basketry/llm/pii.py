"""Operator 3: personal data by candidates and gradient boosting.

Base patterns find e-mail addresses, IP addresses, card and phone numbers whose checks hold; they
always stay. High-recall generators propose further, overlapping spans. A candidate is described
by its format (lengths, digits, separators, groups, checksums) and its context (neighbouring
characters, cue words before it, digits around it). Boosted trees learn what personal data looks
like from all candidates but a third, where base spans are the positive and candidates that
touch no base span of their kind the negative examples. On the third that training did not see,
each kind gets the lowest threshold at which the wanted precision holds; candidates that reach it
are added, best first, unless they overlap a span of their kind. A sample only serves if asked for.

Spans are code points, end exclusive. Null and empty texts have none. With no positive or no
negative example nothing is added. Every row is judged for itself, so doc_ids may repeat or be
null. Only doc_id and text are read.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from basketry.llm import texts
from basketry.llm.texts import write_step
from basketry.runtime import cut_lineage

KINDS = ("email", "ip", "card", "phone")
PRECISION = 0.995
#: Added spans need this many positive calibration examples of their kind.
_LEAST_POSITIVE = 10

# Fixed by the contract of the query.
_BASE = {
    "email": re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"),
    "ip": re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
    "card": re.compile(r"[0-9]([\x20-]?[0-9])+"),
    "phone": re.compile(r"\+[0-9][\x20().0-9-]+[0-9]"),
}
_WIDE = {
    "email": (re.compile(r"""[^\s@,;:<>()\[\]"]{1,80}@[^\s@,;:<>()\[\]"]{2,120}"""),
              re.compile(r"[\w.+-]{2,40} ?(?:\(at\)|\[at\]) ?[\w-]{2,40}(?:\.[\w-]+)+")),
    "ip": (re.compile(r"[0-9]{1,6}(?:[.,][0-9]{1,6}){3}"),),
    "card": (re.compile(r"[0-9](?:[ .-]?[0-9]){12,21}"),),
    "phone": (re.compile(r"[+(]?[0-9][ ().0-9/-]{6,24}[0-9]"),
              re.compile(r"\([0-9]{2,5}\)[ 0-9/-]{5,16}[0-9]")),
}
#: What a text must hold for a kind to occur at all.
_NEEDS = {"email": re.compile(r"@|[(\[]at[)\]]"), "ip": re.compile(r"[0-9][.,][0-9]"),
          "card": re.compile(r"(?:[0-9][ .-]?){12}"), "phone": re.compile(r"[0-9][ ().0-9/-]{5}")}
_CUES = {
    "email": ("mail", "contact", "write"), "ip": ("ip", "host", "server", "address"),
    "card": ("card", "visa", "credit", "payment"), "phone": ("phone", "tel", "call", "mobile", "fax"),
}
_FOUND = (
    "doc_id long, base array<struct<rank:int,start:int,end:int>>, "
    "candidates array<struct<rank:int,start:int,end:int,label:int,features:array<float>>>"
)


def luhn(digits: str) -> bool:
    total = 0
    for k, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        if k % 2:
            d = d * 2 - 9 if d > 4 else d * 2
        total += d
    return total % 10 == 0


def _digits(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def _holds(kind: str, found: str) -> bool:
    if kind == "email":
        return True
    if kind == "ip":
        return all(len(p.lstrip("0")) < 4 and int(p[-3:]) <= 255 for p in found.split("."))
    digits = _digits(found)
    if kind == "card":
        return 16 <= len(digits) <= 19 and luhn(digits)
    return 8 <= len(digits) <= 15


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """``rank of the kind, start, end`` of the base patterns, kind by kind."""
    out = []
    for rank, kind in enumerate(KINDS):
        if not _NEEDS[kind].search(text):
            continue
        out += [(rank, m.start(), m.end()) for m in _BASE[kind].finditer(text)
                if _holds(kind, m.group())]
    return out


def _features(text: str, rank: int, start: int, end: int) -> list[float]:
    span, digits = text[start:end], _digits(text[start:end])
    before, after = text[max(0, start - 24):start], text[end:end + 24]
    groups = [len(g) for g in re.findall(r"[0-9]+", span)]
    numbers = [int(g) for g in re.findall(r"[0-9]{1,6}", span)]
    low = before.lower()
    host = span.rpartition("@")[2]
    return [float(x) for x in (
        *(rank == k for k in range(len(KINDS))), end - start, len(digits),
        sum(c.isalpha() for c in span), span.count("."), span.count(" "), span.count("-"),
        span.count("(") - span.count(")"), span.count("("), span[:1] == "+", span.count("@"),
        len(groups), max(groups, default=0), min(groups, default=0), luhn(digits),
        max(numbers, default=0) <= 255, host.count("."), len(host.rpartition(".")[2]),
        before[-1:].isalnum(), after[:1].isalnum(),
        any(cue in low for cue in _CUES[KINDS[rank]]), len(_digits(before)), len(_digits(after)),
    )]


def _proposals(text: str, base: list[tuple[int, int, int]]) -> list[dict]:
    """Candidates: base spans (label 1), proposals that touch none (0), and others (-1)."""
    seen = set(base)
    out = [(*span, 1) for span in base]
    for rank, kind in enumerate(KINDS):
        if not _NEEDS[kind].search(text):
            continue
        mine = [(s, e) for r, s, e in base if r == rank]
        for pattern in _WIDE[kind]:
            for m in pattern.finditer(text):
                start, end = m.span()
                while end > start and text[end - 1] in ".,;-/( ":
                    end -= 1
                if (rank, start, end) in seen or end - start < 6:
                    continue
                seen.add((rank, start, end))
                touches = any(s < end and start < e for s, e in mine)
                out.append((rank, start, end, -1 if touches else 0))
    return [{"rank": r, "start": s, "end": e, "label": label, "features": _features(text, r, s, e)}
            for r, s, e, label in out]


def propose(docs: DataFrame) -> DataFrame:
    """``row, doc_id, base, candidates`` of each row of ``docs``, written to the shared folder."""
    span = [("rank", pa.int32()), ("start", pa.int32()), ("end", pa.int32())]
    base_type = pa.list_(pa.struct(span))
    candidate_type = pa.list_(pa.struct(
        [*span, ("label", pa.int32()), ("features", pa.list_(pa.float32()))]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in texts.slices(batches, "text"):
            values = [t or "" for t in part[1].to_pylist()]
            base = [base_spans(t) for t in values]
            yield pa.record_batch([
                part[0],
                pa.array([[dict(zip(("rank", "start", "end"), s)) for s in b] for b in base], base_type),
                pa.array([_proposals(t, b) for t, b in zip(values, base)], candidate_type),
            ], ["doc_id", "base", "candidates"])

    found = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(
        run, _FOUND)
    return write_step(found.withColumn("row", F.monotonically_increasing_id()), "candidates")


def _thresholds(scored: list, precision: float) -> dict[int, float]:
    """Per kind the lowest score from which on at least ``precision`` of the labelled
    calibration candidates are positive."""
    out = {}
    for rank in range(len(KINDS)):
        mine = sorted(((s, y) for r, y, s in scored if r == rank), reverse=True)
        positive, best = 0, None
        for k, (score, label) in enumerate(mine):
            positive += label
            last = k + 1 == len(mine) or mine[k + 1][0] < score
            if last and positive >= precision * (k + 1) and positive >= _LEAST_POSITIVE:
                best = score
        if best is not None:
            out[rank] = max(best, 0.5)
    return out


def _limits(scored: DataFrame, precision: float) -> dict[int, float]:
    """Per kind the lowest score from which on at least ``precision`` of the labelled calibration
    candidates (``rank, label, p``) are positive. Candidates are counted per score first, and the
    trees give few scores."""
    falling = Window.partitionBy("rank").orderBy(F.desc("p"))
    counted = scored.groupBy("rank", "p").agg(F.sum("label").alias("yes"), F.count("*").alias("n"))
    held = counted.select(
        "rank", "p", F.sum("yes").over(falling).alias("positive"), F.sum("n").over(falling).alias("seen")
    ).where((F.col("positive") >= precision * F.col("seen")) & (F.col("positive") >= _LEAST_POSITIVE))
    return {r["rank"]: max(r["p"], 0.5) for r in held.groupBy("rank").agg(F.min("p").alias("p")).collect()}


def select_added(found: DataFrame, sample: int | None = None, precision: float = PRECISION) -> DataFrame:
    """``row, added`` of the candidates that the trees and thresholds select. All labelled
    candidates teach and calibrate, or the first ``sample`` by hash."""
    flat = found.where("size(candidates) > 0").select(
        "row", F.explode("candidates").alias("c")).select("row", "c.*")
    drawn = flat.where("label >= 0").withColumn("h", F.xxhash64("row", "rank", "start", "end"))
    if sample is not None:
        drawn = drawn.orderBy("h", "row", "start").limit(sample)
    drawn = write_step(drawn.withColumn("calibrate", F.pmod(F.col("h"), F.lit(3)) == 0).select(
        "rank", F.col("label").cast("double").alias("label"), "calibrate",
        array_to_vector(F.col("features").cast("array<double>")).alias("vector")), "pii-examples")
    fit = drawn.where("not calibrate")
    labels = {r["label"]: r["n"] for r in fit.groupBy("label").agg(F.count("*").alias("n")).collect()}
    chosen = F.lit(False)
    score = F.lit(0.0)
    candidates = flat.where("label < 1")
    if len(labels) == 2:
        model = GBTClassifier(
            featuresCol="vector", labelCol="label", maxIter=12, maxDepth=4, stepSize=0.3, seed=3,
            maxBins=64, cacheNodeIds=False).fit(fit)
        probability = vector_to_array("probability")[1]
        limits = _limits(model.transform(drawn.where("calibrate")).select(
            "rank", "label", probability.alias("p")), precision)
        candidates = model.transform(candidates.withColumn(
            "vector", array_to_vector(F.col("features").cast("array<double>"))))
        score = probability
        for rank, limit in limits.items():
            chosen = chosen | ((F.col("rank") == rank) & (score >= limit))
    picked = candidates.withColumn("score", score).where(chosen)
    return picked.groupBy("row").agg(F.array_sort(F.collect_list(F.struct(
        (-F.col("score")).alias("order"), "rank", "start", "end"))).alias("added"))


def _overlaps(span: Column, spans: Column) -> Column:
    return F.exists(spans, lambda s: (s["rank"] == span["rank"]) & (s["start"] < span["end"])
                    & (span["start"] < s["end"]))


def find_pii(docs: DataFrame, sample: int | None = None, precision: float = PRECISION) -> DataFrame:
    """``doc_id, base, spans`` per row: spans are ``rank, start, end``, in that order."""
    found = propose(docs)
    joined = found.drop("candidates").join(select_added(found, sample, precision), "row", "left")
    plain = F.transform(
        F.coalesce("added", F.array().cast("array<struct<order:double,rank:int,start:int,end:int>>")),
        lambda a: F.struct(a["rank"].alias("rank"), a["start"].alias("start"), a["end"].alias("end")))
    spans = F.aggregate(plain, F.col("base"), lambda kept, s: F.when(
        _overlaps(s, kept), kept).otherwise(F.concat(kept, F.array(s))))
    return joined.select("doc_id", F.array_sort("base").alias("base"), F.array_sort(spans).alias("spans"))


def redact(docs: DataFrame, **options) -> DataFrame:
    """``doc_id, text`` with each span replaced by the name of its kind in brackets; where spans
    overlap, the first names the stretch."""
    kinds = F.array(*map(F.lit, KINDS))
    rows = cut_lineage(docs.select(
        F.monotonically_increasing_id().alias("_row"), "doc_id", "text"))
    found = find_pii(rows.select(F.col("_row").alias("doc_id"), "text"), **options)
    found = found.select(F.col("doc_id").alias("_row"), F.array_sort(F.transform("spans", lambda s: F.struct(
        s["start"].alias("start"), s["end"].alias("end"), s["rank"].alias("rank")))).alias("_spans"))
    step = F.aggregate(
        "_spans", F.struct(F.lit("").alias("done"), F.lit(0).alias("at")),
        lambda a, s: F.when(s["start"] < a["at"], F.struct(
            a["done"].alias("done"), F.greatest(a["at"], s["end"]).alias("at"))).otherwise(F.struct(
                F.concat(a["done"], F.substring("text", a["at"] + 1, s["start"] - a["at"]), F.lit("["),
                         F.element_at(kinds, s["rank"] + 1), F.lit("]")).alias("done"),
                s["end"].alias("at"))))
    return rows.join(found, "_row").withColumn("_step", step).select(
        "doc_id", F.when(F.size("_spans") == 0, F.col("text")).otherwise(F.concat(
            F.col("_step.done"), F.substring("text", F.col("_step.at") + 1, F.length("text"))))
        .alias("text"))


def _joined(spans: Column) -> Column:
    kinds = F.array(*map(F.lit, KINDS))
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", F.element_at(kinds, s["rank"] + 1), s["start"], s["end"])), ",")


def _count(spans: Column, rank: int) -> Column:
    return F.size(F.filter(spans, lambda s: s["rank"] == rank)).cast("long")


def op3_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data of every document."""
    found = find_pii(texts.documents(spark, sf_dir))
    return found.select(
        "doc_id", *(_count(F.col("base"), k).alias(f"n_{kind}") for k, kind in enumerate(KINDS)),
        F.sha2(_joined(F.col("base")), 256).alias("base_sha256"),
        _joined(F.col("spans")).alias("spans"))
