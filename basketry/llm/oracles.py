"""SQL of the registered queries that SQL can express whole."""

from __future__ import annotations

from basketry.llm.secrets import BASE, RULES

_LOW = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_WORDS = f"regexp_extract_all({_LOW}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"

OP4 = f"""WITH doc AS (SELECT doc_id, {_WORDS} AS w FROM documents),
item AS (SELECT coalesce(item_id::VARCHAR, '') AS item_id, {_WORDS} AS w FROM benchmark),
item_window AS (
  SELECT item_id, k AS item_start, least(13, len(w)) AS n,
         array_to_string(w[k:k + least(13, len(w)) - 1], ' ') AS words
  FROM item, unnest(range(1, greatest(len(w) - 13, 0) + 2)) AS t(k) WHERE len(w) > 0),
doc_window AS (
  SELECT doc_id, k, n, array_to_string(w[k:k + n - 1], ' ') AS words
  FROM doc, (SELECT DISTINCT n FROM item_window), unnest(range(1, len(w) - n + 2)) AS t(k)),
hit AS (SELECT doc_id, k, n, item_id, item_start
        FROM doc_window JOIN item_window USING (n, words)),
covered AS (
  SELECT doc_id, count(DISTINCT p) AS n_hit FROM hit, unnest(range(k, k + n)) AS t(p) GROUP BY 1),
named AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS names
  FROM (SELECT DISTINCT doc_id, item_id FROM hit) GROUP BY 1),
island AS (
  SELECT doc_id, item_id, n, k - item_start AS d, k - row_number() OVER (
           PARTITION BY doc_id, item_id, k - item_start ORDER BY k) AS i FROM hit),
longest AS (
  SELECT doc_id, max(length) AS longest_match FROM (
    SELECT doc_id, n + count(*) - 1 AS length FROM island GROUP BY doc_id, item_id, n, d, i)
  GROUP BY 1)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0) AS n_hit,
       coalesce(n_items, 0) AS n_items, sha256(coalesce(names, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated,
       coalesce(longest_match, 0)::BIGINT AS longest_match
FROM doc LEFT JOIN covered USING (doc_id) LEFT JOIN named USING (doc_id)
LEFT JOIN longest USING (doc_id)"""

OP7 = f"""WITH RECURSIVE doc AS (SELECT doc_id, {_WORDS} AS w FROM documents),
shingle AS (
  SELECT DISTINCT doc_id, array_to_string(w[k:k + least(5, len(w)) - 1], ' ') AS s
  FROM doc, unnest(range(1, greatest(len(w) - 5, 0) + 2)) AS t(k) WHERE len(w) > 0),
size AS (SELECT doc_id, count(*) AS n, md5(string_agg(s, '|' ORDER BY s)) AS u FROM shingle GROUP BY 1),
both_have AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c
  FROM shingle a JOIN shingle b ON a.s = b.s AND a.doc_id <> b.doc_id GROUP BY 1, 2),
link AS (
  SELECT a, b, y.u, x.u AS own FROM both_have
  JOIN size x ON x.doc_id = a JOIN size y ON y.doc_id = b WHERE 9 * c >= 4 * (x.n + y.n)),
reach(doc_id, other) AS (
  SELECT a, b FROM link UNION SELECT reach.doc_id, link.b FROM reach JOIN link ON link.a = reach.other),
class AS (SELECT doc_id, least(doc_id, min(other)) AS class_id FROM reach GROUP BY 1),
counted AS (
  SELECT a AS doc_id, count(*) AS n_links, count(DISTINCT u) FILTER (u <> own) AS n_text_links
  FROM link GROUP BY 1)
SELECT doc_id, coalesce(class_id, doc_id) AS class_id, coalesce(n_links, 0) AS n_links,
       coalesce(n_text_links, 0) AS n_text_links, coalesce(n, 0) AS n_shingles
FROM doc LEFT JOIN size USING (doc_id) LEFT JOIN class USING (doc_id)
LEFT JOIN counted USING (doc_id)"""


def _found(rank: int) -> str:
    """Spans of one rule: places follow from what a split leaves between the matches."""
    rule = RULES[rank]
    pattern = rule.pattern.replace("'", "''")
    return f"""SELECT doc_id, {rank} AS rank, '{rule.kind}' AS kind, least_of,
       (sum(gap) OVER w + coalesce(sum(n) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING),
        0))::BIGINT AS start, (sum(gap) OVER w + sum(n) OVER w)::BIGINT AS stop
FROM (
  SELECT doc_id, i, length(gaps[i]) AS gap, length(matches[i]) AS n, length(checked[i]) AS least_of
  FROM (
    SELECT doc_id, string_split_regex(coalesce(text, ''), '{pattern}') AS gaps,
           regexp_extract_all(coalesce(text, ''), '{pattern}') AS matches,
           regexp_extract_all(coalesce(text, ''), '{pattern}', {rule.group}) AS checked
    FROM documents), unnest(range(1, len(matches) + 1)) AS t(i))
WINDOW w AS (PARTITION BY doc_id ORDER BY i)
QUALIFY least_of >= {rule.least}"""


_SPAN = "concat(kind, ':', start, ':', stop)"
_IS_BASE = f"rank < {len(BASE)}"
OP8 = f"""WITH span AS ({' UNION ALL '.join(f'({_found(k)})' for k in range(len(RULES)))}),
listed AS (
  SELECT doc_id, {', '.join(f"count(*) FILTER (kind = '{k}') AS n_{k}" for k in BASE)},
         string_agg({_SPAN}, ',' ORDER BY start, rank) FILTER ({_IS_BASE}) AS base,
         string_agg({_SPAN}, ',' ORDER BY start, rank) AS spans
  FROM span GROUP BY doc_id)
SELECT doc_id, {', '.join(f'coalesce(n_{k}, 0) AS n_{k}' for k in BASE)},
       sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM documents LEFT JOIN listed USING (doc_id)"""


OP12 = """WITH doc AS (
  SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS t,
         regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
mark AS (SELECT doc_id, coalesce(bool_or(quality = 1), false) AS good,
                coalesce(bool_or(toxic = 1), false) AS toxic FROM labels GROUP BY doc_id),
judged AS (
  SELECT part, coalesce(good, false) AS good, coalesce(toxic, false) AS toxic,
         (len(w) < 50)::INT
         + 2 * (100 * len(list_distinct(w)) < 65 * len(w))::INT
         + 4 * (100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 5 * length(t))::INT
         + 8 * regexp_matches(t, '[#$%&*|]')::INT
         + 16 * coalesce(doc_id > min(doc_id) OVER (PARTITION BY t), false)::INT AS mask
  FROM doc LEFT JOIN mark USING (doc_id)),
cell AS (SELECT part, mask, good, toxic, count(*) AS n FROM judged GROUP BY ALL),
letter(l, bit) AS (VALUES ('A', 1), ('B', 2), ('C', 4), ('D', 8), ('E', 16)),
ordering AS (
  SELECT a.l || b.l || c.l || d.l || e.l AS filter_order, [a.bit, b.bit, c.bit, d.bit, e.bit] AS bits
  FROM letter a, letter b, letter c, letter d, letter e
  WHERE a.bit | b.bit | c.bit | d.bit | e.bit = 31),
step AS (
  SELECT filter_order, k::INT AS step, bits[k] AS bit,
         coalesce(list_sum(bits[1:k - 1]), 0)::INT AS before
  FROM ordering, range(1, 6) AS r(k)),
met AS (
  SELECT part, filter_order, step, bit,
         coalesce(sum(n) FILTER (mask & (before | bit) = 0), 0)::BIGINT AS kept,
         coalesce(sum(n) FILTER (mask & before = 0 AND mask & bit <> 0), 0)::BIGINT AS removed,
         coalesce(sum(n) FILTER (mask & before <> 0 AND mask & bit <> 0), 0)::BIGINT AS redundant,
         coalesce(sum(n) FILTER (mask = bit), 0)::BIGINT AS unique_fails,
         coalesce(sum(n) FILTER (mask & before = 0 AND mask & bit <> 0 AND good), 0)::BIGINT
           AS good_lost,
         coalesce(sum(n) FILTER (mask & before = 0 AND mask & bit <> 0 AND toxic), 0)::BIGINT
           AS toxic_lost
  FROM cell, step GROUP BY part, filter_order, step, bit)
SELECT part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost,
       (sum(removed) OVER (PARTITION BY part, bit))::BIGINT AS shapley
FROM met"""

OP11 = """WITH doc AS (
  SELECT row_number() OVER () AS d, doc_id, regexp_extract_all(translate(coalesce(text, ''),
           'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+') AS w FROM documents),
query AS (
  SELECT q, item_id, unnest(list_distinct(w)) AS t FROM (
    SELECT row_number() OVER () AS q, item_id, regexp_extract_all(translate(coalesce(text, ''),
             'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
             '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+') AS w FROM benchmark)),
whole AS (SELECT count(*)::BIGINT AS n_docs, sum(len(w))::BIGINT AS l FROM doc WHERE len(w) > 0),
sized AS (SELECT d, doc_id, 50 + ((50 * len(w)::BIGINT * n_docs) // l) AS m FROM doc, whole
          WHERE len(w) > 0),
posting AS (SELECT d, t, count(*)::BIGINT AS tf FROM (SELECT d, unnest(w) AS t FROM doc)
            WHERE t IN (SELECT t FROM query) GROUP BY d, t),
weight AS (SELECT t, floor(1000 * ln((2 * n_docs + 2)::DOUBLE / (2 * count(*) + 1)))::BIGINT AS w
           FROM posting, whole GROUP BY t, n_docs),
scored AS (
  SELECT q, item_id, d, doc_id,
         sum(w * ((1000000000 * tf) // (1000 * tf + 20 * m)))::BIGINT AS score
  FROM query JOIN posting USING (t) JOIN weight USING (t) JOIN sized USING (d) GROUP BY ALL)
SELECT item_id, (row_number() OVER (
         PARTITION BY q ORDER BY score DESC, doc_id NULLS FIRST))::INT AS rank, doc_id, score
FROM scored WHERE score > 0 QUALIFY rank <= 50"""
