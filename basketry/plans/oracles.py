"""The registered queries as plain SQL over the same tables (DuckDB dialect)."""

from __future__ import annotations

from basketry.functions.values import LOGIN_WARNING, RATING_PREFIX

_RATING = """rating AS (
  SELECT o_custkey AS user_id, l_partkey AS product_id,
         CAST(ceil(l_quantity / 10) AS DOUBLE) AS score, o_orderdate AS ts,
         l_orderkey AS order_key, l_linenumber AS line_number
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey)"""

_PRODUCT = """product AS (
  SELECT p_partkey AS product_id, p_name AS name, '' AS image_url, p_type AS categories,
         concat_ws('|', replace(p_name, ' ', '|'), p_brand, p_type) AS tags
  FROM part)"""

_AVERAGE = """average AS (
  SELECT product_id, avg(score) AS avg FROM rating GROUP BY product_id)"""

_BEHAVIOR = """behavior AS (
  SELECT event_id, user_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS product_id,
         event_type, value, ts
  FROM events)"""

_EVENT_RATING = """event_rating AS (
  SELECT event_id, user_id, product_id, least(5.0::DOUBLE, 1 + floor(value / 20)) AS score, ts
  FROM behavior WHERE event_type = 'purchase')"""

_PRODUCT_COLUMNS = "name, image_url, categories, tags, coalesce(avg, 0.0) AS avg"
_PRODUCT_JOINS = "JOIN product USING (product_id) LEFT JOIN average USING (product_id)"
_SECOND = "strftime({0}, '%Y-%m-%d %H:%M:%S') AS {0}"
_TABLES = f"{_RATING}, {_PRODUCT}, {_AVERAGE}"

_ITEMCF_PAIRS = """raters AS (SELECT product_id, count(*) AS raters FROM rating GROUP BY product_id),
together AS (
  SELECT a.product_id AS p1, b.product_id AS p2, count(*) AS n
  FROM rating a JOIN rating b ON a.user_id = b.user_id AND a.product_id < b.product_id
  GROUP BY 1, 2),
pairs AS (
  SELECT p1, p2, n, x.raters AS c1, y.raters AS c2,
         n / sqrt(x.raters::DOUBLE * y.raters::DOUBLE) AS score
  FROM together JOIN raters x ON x.product_id = p1 JOIN raters y ON y.product_id = p2)"""

_ITEMCF_TOPK = """directed AS (
  SELECT p1 AS product_id, p2 AS other_id, score FROM pairs
  UNION ALL SELECT p2, p1, score FROM pairs),
topk AS (
  SELECT product_id, CAST(row_number() OVER (
           PARTITION BY product_id ORDER BY score DESC, other_id) AS INTEGER) AS rank, other_id, score
  FROM directed QUALIFY rank <= 20)"""

_WEIGHTS = """word AS (
  SELECT product_id, unnest(string_split(lower(replace(tags, '|', ' ')), ' ')) AS word
  FROM product),
tf AS (SELECT product_id, word, count(*) AS tf FROM word GROUP BY 1, 2),
idf AS (
  SELECT word, ln(((SELECT count(*) FROM product) + 1) / (count(*) + 1)) AS idf
  FROM tf GROUP BY word),
weight AS (
  SELECT product_id, word, tf, tf * idf AS weight FROM tf JOIN idf USING (word) WHERE idf > 0)"""

_CONTENT = """norm AS (
  SELECT product_id, sqrt(sum(weight * weight)) AS norm FROM weight GROUP BY product_id),
inner_product AS (
  SELECT a.product_id AS a, b.product_id AS b, sum(a.weight * b.weight) AS dot
  FROM weight a JOIN weight b ON a.word = b.word AND a.product_id <> b.product_id
  GROUP BY 1, 2),
content AS (
  SELECT a AS product_id, b AS other_id, round(dot / nullif(x.norm * y.norm, 0), 12) AS score
  FROM inner_product JOIN norm x ON x.product_id = a JOIN norm y ON y.product_id = b
  WHERE round(dot / nullif(x.norm * y.norm, 0), 12) > 0.4)"""

_EVENT_PRODUCTS = "asked AS (SELECT DISTINCT product_id FROM behavior)"

_ONLINE = """newest AS (
  SELECT user_id, product_id FROM event_rating
  QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1),
recent AS (
  SELECT user_id, product_id AS rated, score AS rating FROM event_rating
  QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) <= 20),
rated AS (
  SELECT user_id, product_id FROM rating UNION SELECT user_id, product_id FROM event_rating),
chosen AS (
  SELECT user_id, other_id AS candidate
  FROM newest JOIN content USING (product_id)
  WHERE (user_id, other_id) NOT IN (SELECT user_id, product_id FROM rated)
  QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY content.score DESC, other_id) <= 20),
term AS (
  SELECT user_id, candidate, rating, content.score AS sim
  FROM chosen JOIN recent USING (user_id)
  JOIN content ON content.product_id = candidate AND content.other_id = rated
  WHERE content.score > 0.2),
scored AS (
  SELECT user_id, candidate AS product_id,
         round(sum(CAST(round(sim * rating, 8) AS DECIMAL(28, 8)))::DOUBLE / count(*)
               + log10(greatest(count(*) FILTER (rating > 2), 1))
               - log10(greatest(count(*) FILTER (rating <= 2), 1)), 10) AS score
  FROM term GROUP BY 1, 2),
online AS (
  SELECT user_id, CAST(row_number() OVER (
           PARTITION BY user_id ORDER BY score DESC, product_id) AS INTEGER) AS rank, product_id, score
  FROM scored QUALIFY rank <= 20)"""

_WINDOW_COUNTS = """window_count AS (
  SELECT time_bucket(INTERVAL 5 MINUTE, ts) + (1 + i) * INTERVAL 5 MINUTE AS window_end,
         product_id, count(*) AS count
  FROM behavior, unnest(range(12)) AS step(i)
  GROUP BY 1, 2)"""

_WINDOW_TOP = """top AS (
  SELECT window_end, CAST(row_number() OVER (
           PARTITION BY window_end ORDER BY count DESC, product_id) AS INTEGER) AS rank, product_id, count
  FROM window_count QUALIFY rank <= 10)"""

_HOUR = "strftime(h, '%Y/%m/%d/%H') AS start, strftime(h + INTERVAL 1 HOUR, '%Y/%m/%d/%H') AS \"end\""
_VIEWS = """views AS (
  SELECT event_id, user_id, ts, date_trunc('hour', ts) AS h FROM events WHERE event_type = 'view')"""

_LOGIN = """login AS (
  SELECT event_id, user_id, ts, event_type = 'error' AS failed,
         lag(event_type = 'error') OVER w AS failed_before, lag(ts) OVER w AS ts_before
  FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)),
alert AS (
  SELECT user_id, ts FROM login
  WHERE failed AND failed_before AND ts - ts_before < INTERVAL {within})"""
_ALERT_ROWS = (
    "SELECT user_id, strftime(ts, '%Y-%m-%d %H:%M:%S') AS time, "
    f"'{LOGIN_WARNING}' AS message FROM alert"
)
_LOCKOUT = """lockout AS (
  SELECT user_id, max(ts) + INTERVAL 30 MINUTE AS no_login_until FROM alert GROUP BY user_id)"""


def _string_hash(text: str, base: int, size: int) -> str:
    return (
        f"list_reduce(list_prepend(0::BIGINT, list_transform(string_split({text}, ''), "
        f"lambda c: ascii(c)::BIGINT)), lambda h, c: (h * {base} + c) % {size})"
    )


def _name_id(text: str) -> str:
    h = _string_hash(text, 31, 1 << 32)
    return f"(CASE WHEN {h} >= {1 << 31} THEN {h} - {1 << 32} ELSE {h} END)"


_CUSTOMER_NAME = "concat('Customer#', lpad(user_id::VARCHAR, 9, '0'))"

BATCH: dict[str, str] = {
    "most_rated_products": f"""WITH {_TABLES},
best AS (SELECT product_id, count(*) AS count, CAST(row_number() OVER (
           ORDER BY count(*) DESC, product_id) AS INTEGER) AS rank
         FROM rating GROUP BY product_id QUALIFY rank <= 20)
SELECT product_id, count, rank, {_PRODUCT_COLUMNS} FROM best {_PRODUCT_JOINS}""",
    "hot_products": f"""WITH {_TABLES},
best AS (SELECT product_id, count(*) AS count, strftime(ts, '%Y%m') AS yearmonth,
                CAST(row_number() OVER (
                  ORDER BY strftime(ts, '%Y%m') DESC, count(*) DESC, product_id) AS INTEGER) AS rank
         FROM rating GROUP BY product_id, strftime(ts, '%Y%m') QUALIFY rank <= 20)
SELECT product_id, count, yearmonth, rank, {_PRODUCT_COLUMNS} FROM best {_PRODUCT_JOINS}""",
    "rate_more": f"""WITH {_RATING}
SELECT product_id, count(product_id) AS count FROM rating GROUP BY product_id""",
    "rate_more_recently": f"""WITH {_RATING}
SELECT product_id, count(product_id) AS count, strftime(ts, '%Y%m') AS yearmonth
FROM rating GROUP BY product_id, yearmonth""",
    "change_date_sql": f"""WITH {_RATING}
SELECT product_id, count(product_id) AS count, strftime(ts, '%Y%m') AS yearmonth
FROM rating GROUP BY product_id, yearmonth""",
    "average_score": f"""WITH {_RATING}
SELECT product_id, avg(score) AS avg FROM rating GROUP BY product_id""",
    "product_info": f"""WITH {_TABLES}, {_BEHAVIOR}, {_EVENT_PRODUCTS}
SELECT product_id, {_PRODUCT_COLUMNS} FROM asked {_PRODUCT_JOINS}""",
    "search_products": f"""WITH {_TABLES}
SELECT product_id, {_PRODUCT_COLUMNS}
FROM product LEFT JOIN average USING (product_id)
WHERE regexp_matches(name, 'widget|gear$')""",
    "itemcf_pairs": f"""WITH {_RATING}, {_ITEMCF_PAIRS}
SELECT p1, p2, n, c1, c2, score FROM pairs""",
    "itemcf_topk": f"""WITH {_RATING}, {_ITEMCF_PAIRS}, {_ITEMCF_TOPK}
SELECT product_id, rank, other_id, score FROM topk""",
    "itemcf_recs": f"""WITH {_RATING}, {_ITEMCF_PAIRS}, {_ITEMCF_TOPK},
listed AS (SELECT product_id, string_agg(other_id::VARCHAR, ',' ORDER BY rank) AS ids
           FROM topk GROUP BY product_id)
SELECT product_id, coalesce(ids, '') AS ids
FROM (SELECT DISTINCT product_id FROM rating) LEFT JOIN listed USING (product_id)""",
    "similar_by_itemcf": f"""WITH {_TABLES}, {_ITEMCF_PAIRS}, {_ITEMCF_TOPK},
{_BEHAVIOR}, {_EVENT_PRODUCTS},
list AS (SELECT product_id AS asked_id, rank, other_id AS product_id, score
         FROM topk WHERE product_id IN (SELECT product_id FROM asked))
SELECT product_id, asked_id, rank, score, {_PRODUCT_COLUMNS} FROM list {_PRODUCT_JOINS}""",
    "factor_similarity": """WITH pair AS (
  SELECT a.vec_id AS a, b.vec_id AS b,
         list_dot_product(a.embedding::DOUBLE[], b.embedding::DOUBLE[]) /
         nullif(sqrt(list_dot_product(a.embedding::DOUBLE[], a.embedding::DOUBLE[])) *
                sqrt(list_dot_product(b.embedding::DOUBLE[], b.embedding::DOUBLE[])), 0) AS score
  FROM embeddings a JOIN embeddings b ON a.vec_id < b.vec_id)
SELECT a, b, round(score, 6) AS score FROM pair WHERE round(score, 12) > 0.4""",
    "factor_topk": """WITH pair AS (
  SELECT a.vec_id AS id, b.vec_id AS other_id, round(
         list_dot_product(a.embedding::DOUBLE[], b.embedding::DOUBLE[]) /
         nullif(sqrt(list_dot_product(a.embedding::DOUBLE[], a.embedding::DOUBLE[])) *
                sqrt(list_dot_product(b.embedding::DOUBLE[], b.embedding::DOUBLE[])), 0), 12) AS score
  FROM embeddings a JOIN embeddings b ON a.vec_id <> b.vec_id)
SELECT id, CAST(row_number() OVER (PARTITION BY id ORDER BY score DESC, other_id) AS INTEGER) AS rank,
       other_id, round(score, 6) AS score
FROM pair WHERE score > 0.2 QUALIFY rank <= 10""",
    "factor_user_topk": """WITH factor AS (
  SELECT vec_id, label, list_transform(embedding, lambda x: x::DOUBLE / 1000) AS v FROM embeddings),
pair AS (
  SELECT a.vec_id AS user_id, b.vec_id AS product_id, list_dot_product(a.v, b.v) AS score
  FROM factor a JOIN factor b ON a.label % 2 = 0 AND b.label % 2 = 1)
SELECT user_id, product_id, round(score * 1e6, 6) AS score, CAST(row_number() OVER (
         PARTITION BY user_id ORDER BY round(score, 18) DESC, product_id) AS INTEGER) AS rank
FROM pair WHERE score > 0 QUALIFY rank <= 20""",
    "tfidf": f"""WITH {_PRODUCT}, {_WEIGHTS}
SELECT product_id, word, tf, round(weight, 6) AS weight FROM weight""",
    "content_similarity": f"""WITH {_PRODUCT}, {_WEIGHTS}, {_CONTENT},
copies AS (
  SELECT min(product_id) AS product_id, count(*) AS copies
  FROM product GROUP BY list_sort(string_split(lower(tags), '|')))
SELECT content.product_id, other_id, round(score, 6) AS score, x.copies, y.copies AS other_copies
FROM content JOIN copies x ON x.product_id = content.product_id
JOIN copies y ON y.product_id = other_id
WHERE content.product_id < other_id""",
    "content_topk": f"""WITH {_PRODUCT}, {_WEIGHTS}, {_CONTENT}
SELECT product_id, CAST(row_number() OVER (
         PARTITION BY product_id ORDER BY content.score DESC, other_id) AS INTEGER) AS rank,
       other_id, round(content.score, 6) AS score
FROM content QUALIFY rank <= 20""",
    "similar_by_content": f"""WITH {_TABLES}, {_WEIGHTS}, {_CONTENT}, {_BEHAVIOR}, {_EVENT_PRODUCTS},
list AS (SELECT product_id AS asked_id, other_id AS product_id, round(content.score, 6) AS score,
                CAST(row_number() OVER (
                  PARTITION BY product_id ORDER BY content.score DESC, other_id) AS INTEGER) AS rank
         FROM content WHERE product_id IN (SELECT product_id FROM asked))
SELECT product_id, asked_id, rank, score, {_PRODUCT_COLUMNS} FROM list {_PRODUCT_JOINS}""",
    "online_recs": f"""WITH {_RATING}, {_PRODUCT}, {_WEIGHTS}, {_CONTENT}, {_BEHAVIOR}, {_EVENT_RATING},
{_ONLINE}
SELECT user_id, rank, product_id, score FROM online""",
    "stream_list_served": f"""WITH {_TABLES}, {_WEIGHTS}, {_CONTENT}, {_BEHAVIOR}, {_EVENT_RATING},
{_ONLINE}
SELECT product_id, c_name AS username, rank, score, {_PRODUCT_COLUMNS}
FROM online JOIN customer ON c_custkey = user_id {_PRODUCT_JOINS}""",
    "hot_window_counts": f"""WITH {_BEHAVIOR}, {_WINDOW_COUNTS}
SELECT {_SECOND.format('window_end')}, product_id, count FROM window_count""",
    "hot_window_topn": f"""WITH {_BEHAVIOR}, {_WINDOW_COUNTS}, {_WINDOW_TOP}
SELECT {_SECOND.format('window_end')}, rank, product_id, count FROM top""",
    "hot_window_report": f"""WITH {_BEHAVIOR}, {_WINDOW_COUNTS}, {_WINDOW_TOP}
SELECT {_SECOND.format('window_end')}, rank,
       concat('NO', rank, ': product=', product_id, ' count=', count) AS line FROM top""",
    "uv_hourly": f"""WITH {_VIEWS}
SELECT {_HOUR}, count(DISTINCT user_id) AS count FROM views GROUP BY h""",
    "uv_approx_close": f"""WITH {_VIEWS}
SELECT {_HOUR}, true AS close FROM views GROUP BY h""",
    "als_user_lists": f"""WITH {_RATING}
SELECT user_id, 20::BIGINT AS n, true AS in_order FROM rating GROUP BY user_id""",
    "als_solved": f"""WITH {_RATING}
SELECT user_id, true AS solved FROM rating GROUP BY user_id""",
    "uv_bitmap": f"""WITH {_VIEWS}
SELECT {_HOUR}, count(DISTINCT {_string_hash('user_id::VARCHAR', 61, 1 << 29)}) AS count
FROM views GROUP BY h""",
    "uv_running": f"""WITH {_VIEWS},
marked AS (
  SELECT *, CASE WHEN row_number() OVER (
    PARTITION BY h, user_id ORDER BY ts, event_id) = 1 THEN 1 ELSE 0 END AS new FROM views)
SELECT {_HOUR}, user_id, event_id, CAST(sum(new) OVER (
  PARTITION BY h ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS BIGINT) AS count
FROM marked""",
    "login_alerts_2m": f"WITH {_LOGIN.format(within='2 MINUTE')} {_ALERT_ROWS}",
    "login_alerts_24h": f"WITH {_LOGIN.format(within='24 HOUR')} {_ALERT_ROWS}",
    "lockout_until": f"""WITH {_LOGIN.format(within='24 HOUR')}, {_LOCKOUT}
SELECT user_id, {_SECOND.format('no_login_until')} FROM lockout""",
    "user_lockouts": f"""WITH {_LOGIN.format(within='24 HOUR')}, {_LOCKOUT}
SELECT c_custkey::INTEGER AS user_id, c_name AS username, {_SECOND.format('no_login_until')}
FROM customer LEFT JOIN lockout ON user_id = c_custkey""",
    "recent_ratings": f"""WITH {_RATING}
SELECT user_id, CAST(row_number() OVER (
         PARTITION BY user_id ORDER BY ts DESC, order_key DESC, line_number DESC,
         product_id DESC, score DESC) AS INTEGER) AS rank,
       product_id, score, {_SECOND.format('ts')}
FROM rating QUALIFY rank <= 20""",
    "rating_upsert": f"""WITH {_RATING}, {_BEHAVIOR}, {_EVENT_RATING},
folded AS (
  SELECT user_id, product_id, arg_max(score, ts) AS new_score, min(ts) AS new_ts
  FROM event_rating GROUP BY 1, 2)
SELECT user_id, product_id, coalesce(new_score, score) AS score,
       strftime(coalesce(ts, new_ts), '%Y-%m-%d %H:%M:%S') AS ts
FROM rating FULL OUTER JOIN folded USING (user_id, product_id)""",
    "submit_ratings": f"""WITH {_BEHAVIOR}, {_EVENT_RATING}
SELECT concat('{RATING_PREFIX}:', user_id, '|', product_id, '|', score::VARCHAR, '|',
              epoch(date_trunc('second', ts))::BIGINT) AS value
FROM event_rating JOIN customer ON c_name = {_CUSTOMER_NAME}""",
    "ratings_from_log": f"""WITH {_BEHAVIOR}, {_EVENT_RATING}
SELECT user_id, product_id, score, {_SECOND.format('ts')} FROM event_rating""",
    "rating_rejects": f"""WITH {_BEHAVIOR}
SELECT concat(user_id, '|', product_id, '|', event_type, '|',
              epoch(date_trunc('second', ts))::BIGINT) AS value
FROM behavior WHERE event_type <> 'purchase'""",
    "username_id": f"""SELECT c_name AS username, {_name_id('c_name')} AS hashed_id FROM customer""",
    "register_users": f"""WITH {_BEHAVIOR},
request AS (
  SELECT CASE WHEN product_id < 50 THEN {_CUSTOMER_NAME}
              ELSE concat('visitor-', user_id, '-', product_id) END AS username, ts
  FROM behavior WHERE event_type = 'signup'),
free AS (
  SELECT username, min(ts) AS ts FROM request
  WHERE username NOT IN (SELECT c_name FROM customer) GROUP BY username)
SELECT {_name_id('username')} AS user_id, username, {_SECOND.format('ts')} FROM free""",
    "update_user_prefs": """WITH wish AS (
  SELECT user_id, string_agg(DISTINCT event_type, ',' ORDER BY event_type) AS genres
  FROM events GROUP BY user_id)
SELECT c_custkey::INTEGER AS user_id, c_name AS username, user_id IS NULL AS first,
       coalesce(genres, c_mktsegment) AS genres
FROM customer LEFT JOIN wish ON user_id = c_custkey""",
}

# Windows whose end the watermark has reached, which is where the last event is.
BATCH["movie_content_topk"] = BATCH["content_topk"]
BATCH["similar_by_content_pages"] = BATCH["similar_by_content"]
BATCH["factor_user_topk_bounds"] = BATCH["factor_user_topk"]
# What the queries state about sketches and approximate pairs holds for every row.
BATCH["factor_lsh_recall"] = "SELECT true AS only_pairs, true AS recall_reached"
BATCH["uv_sketch_days"] = f"""WITH {_VIEWS}
SELECT strftime(date_trunc('day', h), '%Y/%m/%d/%H') AS start, true AS close
FROM views GROUP BY 1"""

STREAMS: dict[str, str] = {
    "stream_hot_items": f"""WITH {_BEHAVIOR}, {_WINDOW_COUNTS}, {_WINDOW_TOP}
SELECT {_SECOND.format('window_end')}, rank, product_id, count FROM top
WHERE window_end <= (SELECT max(ts) FROM events)""",
    "stream_uv": BATCH["uv_hourly"],
    "stream_uv_bitmap": BATCH["uv_bitmap"],
    "stream_uv_sketch_days": BATCH["uv_sketch_days"],
    "stream_login_alerts": BATCH["login_alerts_24h"]
    + " WHERE ts < (SELECT date_trunc('millisecond', max(ts)) FROM events)",
    "stream_lockouts": BATCH["lockout_until"].replace(
        "FROM alert GROUP",
        "FROM alert WHERE ts < (SELECT date_trunc('millisecond', max(ts)) FROM events) GROUP",
    ),
    "stream_recent_ratings": f"""WITH {_BEHAVIOR}, {_EVENT_RATING}
SELECT user_id, CAST(row_number() OVER (
         PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS INTEGER) AS rank,
       product_id, score, {_SECOND.format('ts')}
FROM event_rating QUALIFY rank <= 40""",
    "stream_online_recs": BATCH["online_recs"],
    "stream_relay": BATCH["ratings_from_log"],
}
