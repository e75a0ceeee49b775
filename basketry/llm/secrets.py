"""Operator 8: secrets in texts, found through a trigram index. DataFrame functions only.

Every rule's regular expression is analysed once: which trigrams must occur in any text it
matches, as a Boolean query of AND and OR. The index holds, for the trigrams that the rules ask
for, the postings (trigram, document) over lower-cased texts, so that one index serves rules
that ignore case. A query intersects the postings; only the documents it leaves are verified
with the regular expression. A rule whose expression has no mandatory trigram scans all texts.

Spans are code points, end exclusive. Null and empty texts have none. A null doc_id is a
document like others. Rows that repeat a doc_id share their postings and are verified each for
itself. Only doc_id and text are read.
"""

from __future__ import annotations

import re._constants as ops
import re._parser as parser
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from basketry.llm import texts
from basketry.llm.texts import write_step
from basketry.runtime import small_side

#: Most strings kept while an expression is expanded; beyond them a part counts as unknown.
_MOST_STRINGS = 64
_MOST_CHARACTERS = 8


@dataclass(frozen=True)
class Rule:
    """A kind of secret: its expression, and the group whose text must have ``least``
    characters. Matches that are too short are dropped."""

    kind: str
    pattern: str
    group: int = 0
    least: int = 0


#: The first three are fixed by the contract of the query; as their runs are greedy, a minimum
#: length in the expression drops the same matches as a check afterwards.
RULES = (
    Rule("assign", r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?"""
         r"([A-Za-z0-9+/_.=-]+)", 1, 6),
    Rule("access", "AKIA[A-Z0-9]{16,}"),
    Rule("hex", "[0-9a-f]{24,}"),
    Rule("github", "gh[pousr]_[A-Za-z0-9]{36,}"),
    Rule("slack", "xox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]{10,}\.[A-Za-z0-9_-]{10,}\.[A-Za-z0-9_-]{10,}"),
    Rule("private_key", "-----BEGIN [A-Z ]*PRIVATE KEY-----"),
)
BASE = ("assign", "access", "hex")

# A query is True (anything), a trigram, or ("and" | "or", {queries}).


def _join(kind: str, queries: list) -> object:
    """AND or OR of queries; True is no condition."""
    if kind == "or" and (True in queries or not queries):
        return True
    flat = set()
    for q in queries:
        if q is True:
            continue
        flat |= q[1] if isinstance(q, tuple) and q[0] == kind else {q}
    if not flat:
        return True
    if kind == "or":
        # An alternative that asks for more than another adds nothing.
        asks = {q: {q} if isinstance(q, str) else q[1] if q[0] == "and" else None for q in flat}
        flat = {q for q in flat if asks[q] is None or not any(
            asks[o] is not None and asks[o] < asks[q] for o in flat)}
    return next(iter(flat)) if len(flat) == 1 else (kind, frozenset(flat))


def _of_strings(strings: set[str]) -> object:
    return _join("or", [
        _join("and", [s[k:k + 3] for k in range(len(s) - 2)]) if len(s) > 2 else True
        for s in strings])


def _sequence(items) -> tuple[set[str] | None, object]:
    """All strings that the items match (None: too many), and the query they imply."""
    strings: set[str] | None = {""}
    known, whole = [], True
    for item in items:
        found, query = _node(item)
        if found is not None and len(strings) * len(found) <= _MOST_STRINGS:
            strings = {a + b for a in strings for b in found}
            continue
        known += [_of_strings(strings), query if found is None else True]
        strings, whole = ({""} if found is None else found), False
    if whole:
        return strings, _of_strings(strings)
    return None, _join("and", [*known, _of_strings(strings)])


def _node(item) -> tuple[set[str] | None, object]:
    op, value = item
    if op is ops.LITERAL:
        return {chr(value).lower()}, True
    if op is ops.IN:
        letters: set[str] = set()
        for kind, v in value:
            if kind is ops.LITERAL:
                letters.add(chr(v).lower())
            elif kind is ops.RANGE and v[1] - v[0] < _MOST_CHARACTERS:
                letters |= {chr(c).lower() for c in range(v[0], v[1] + 1)}
            else:
                return None, True
        return (letters, True) if len(letters) <= _MOST_CHARACTERS else (None, True)
    if op is ops.SUBPATTERN:
        return _sequence(value[-1])
    if op is ops.BRANCH:
        found = [_sequence(branch) for branch in value[1]]
        if all(s is not None for s, _ in found):
            strings = set().union(*(s for s, _ in found))
            if len(strings) <= _MOST_STRINGS:
                return strings, _of_strings(strings)
        return None, _join("or", [q for _, q in found])
    if op in (ops.MAX_REPEAT, ops.MIN_REPEAT):
        least, most, inner = value
        strings, query = _sequence(inner)
        if most == 1 and strings is not None:
            return strings | ({""} if least == 0 else set()), True
        if least == 0:
            return None, True
        # The item once at least.
        return None, _of_strings(strings) if strings is not None else query
    return None, True


def trigram_query(pattern: str) -> object:
    """Boolean query over lower-cased trigrams that every match of ``pattern`` fulfils."""
    strings, query = _sequence(parser.parse(pattern))
    return _of_strings(strings) if strings is not None else query


def trigrams(query: object) -> set[str]:
    if query is True:
        return set()
    return {query} if isinstance(query, str) else set().union(*map(trigrams, query[1]))


def build_index(docs: DataFrame, wanted: list[str]) -> DataFrame:
    """Postings ``gram, doc_id``: the places in ``wanted`` of the trigrams each text has."""
    low = docs.select(
        F.col("doc_id").cast("long"), F.lower(F.col("text").cast("string")).alias("low")
    ).where("low is not null")
    has = F.array_compact(F.array(*(
        F.when(F.contains("low", F.lit(gram)), F.lit(k)) for k, gram in enumerate(wanted))))
    return write_step(low.select("doc_id", F.explode(has).alias("gram")), "postings")


def _holds(query: object, grams: Column, wanted: list[str]) -> Column:
    if isinstance(query, str):
        return F.array_contains(grams, wanted.index(query))
    parts = [_holds(q, grams, wanted) for q in sorted(query[1], key=str)]
    return reduce(lambda a, b: a & b if query[0] == "and" else a | b, parts)


def candidates(postings: DataFrame, queries: dict[str, object], wanted: list[str]) -> DataFrame:
    """``doc_id, kinds``: documents that fulfil a rule's query, and the kinds of those rules."""
    grams = postings.groupBy("doc_id").agg(F.collect_set("gram").alias("grams"))
    kinds = F.array_compact(F.array(*(
        F.when(_holds(q, F.col("grams"), wanted), F.lit(kind)) for kind, q in queries.items())))
    return write_step(
        grams.select("doc_id", kinds.alias("kinds")).where("size(kinds) > 0"), "candidates")


def _spans(text: Column, rule: Rule) -> Column:
    """``start, end`` of the rule's matches: what a split leaves between them gives places."""
    pattern = F.lit(rule.pattern)
    gaps = F.transform(F.split(text, rule.pattern, -1), F.length)
    lengths = F.transform(F.regexp_extract_all(text, pattern, F.lit(0)), F.length)
    checked = F.transform(F.regexp_extract_all(text, pattern, F.lit(rule.group)), F.length)
    empty = F.array().cast("array<struct<start:int,end:int>>")
    steps = F.arrays_zip(
        F.slice(gaps, F.lit(1), F.size(lengths)).alias("gap"), lengths.alias("n"), checked.alias("c"))
    done = F.aggregate(
        steps, F.struct(F.lit(0).alias("at"), empty.alias("found")),
        lambda s, x: F.struct(
            (s["at"] + x["gap"] + x["n"]).alias("at"),
            F.when(x["c"] >= rule.least, F.concat(s["found"], F.array(F.struct(
                (s["at"] + x["gap"]).alias("start"), (s["at"] + x["gap"] + x["n"]).alias("end"))))
            ).otherwise(s["found"]).alias("found")))
    return done["found"]


def _named(spans: Column, rank: int, rule: Rule) -> Column:
    return F.transform(spans, lambda s: F.struct(
        s["start"].alias("start"), F.lit(rank).alias("rank"), F.lit(rule.kind).alias("kind"),
        s["end"].alias("end")))


def _count(spans: Column, kind: str) -> Column:
    return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long")


def find_secrets(docs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """``doc_id, spans`` per row; a span is ``start, rank, kind, end``, sorted by start and the
    order of the rules."""
    queries = {r.kind: trigram_query(r.pattern) for r in rules}
    indexed = {kind: q for kind, q in queries.items() if q is not True}
    wanted = sorted(set().union(*map(trigrams, indexed.values()))) if indexed else []
    rows = docs.select(F.col("doc_id").cast("long"), F.coalesce(
        F.col("text").cast("string"), F.lit("")).alias("text"))
    if indexed:
        found = candidates(build_index(docs, wanted), indexed, wanted)
        found = found.select(F.col("doc_id").alias("_id"), "kinds")
        rows = rows.join(small_side(found, found.count()), F.expr("doc_id <=> _id"), "left")
    else:
        rows = rows.withColumn("kinds", F.lit(None).cast("array<string>"))
    empty = F.array().cast("array<struct<start:int,rank:int,kind:string,end:int>>")
    parts = []
    for rank, rule in enumerate(rules):
        verify = F.coalesce(F.array_contains("kinds", rule.kind), F.lit(False))
        if rule.kind not in indexed:
            verify = F.col("text").rlike(rule.pattern)
        parts.append(F.when(verify, _named(_spans(F.col("text"), rule), rank, rule)).otherwise(empty))
    return rows.select("doc_id", F.array_sort(F.concat(*parts)).alias("spans"))


def _joined(spans: Column) -> Column:
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def op8_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets of every document."""
    found = find_secrets(texts.documents(spark, sf_dir))
    count = [_count(F.col("spans"), kind).alias(f"n_{kind}") for kind in BASE]
    base = F.filter("spans", lambda s: s["kind"].isin(*BASE))
    return found.select(
        "doc_id", *count, F.sha2(_joined(base), 256).alias("base_sha256"),
        _joined(F.col("spans")).alias("spans"))
