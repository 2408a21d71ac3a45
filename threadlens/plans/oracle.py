"""DuckDB SQL oracles of the registered queries.

Each statement is written independently of the Spark code, directly from the
query's meaning, over the driver's views (``events``, ``pages``).  The CTE
``comments`` restates the fixture mapping of FIXTURES.md in DuckDB's dialect.
Where the Spark job takes a scale shortcut (the recommender's per-leader
shortlist), the oracle spells out the brute-force definition instead.
"""

from __future__ import annotations

B36 = "'0123456789abcdefghijklmnopqrstuvwxyz'"


def b36(expr: str) -> str:
    """Base-36 text -> integer, in DuckDB."""
    return (f"list_reduce(list_transform(string_split({expr}, ''), "
            f"lambda c: position(c IN {B36}) - 1), lambda a, b: a * 36 + b)")


def _hash(expr: str, modulus: int = 10 ** 8) -> str:
    return f"CAST(CAST('0x' || substr(md5({expr}), 1, 8) AS UBIGINT) % {modulus} AS BIGINT)"


def _label(epoch: str) -> str:
    return f"CAST(strftime(make_timestamp({epoch} * 1000000), '%Y%m%d%H%M') AS BIGINT)"


_BUCKET = "CAST(CAST('0x' || substr(md5(CAST(event_id // 25 AS VARCHAR)), 1, 8) AS UBIGINT) AS BIGINT)"

COMMENTS = f"""
comments AS (
  SELECT
    event_id % 2 = 0 AS archived,
    CASE WHEN user_id % 37 = 0 THEN '[deleted]' ELSE 'u' || CAST(user_id AS VARCHAR) END AS author,
    CAST(NULL AS VARCHAR) AS author_flair_css_class,
    props AS body,
    CAST(CASE WHEN event_type = 'error' THEN 1 ELSE 0 END AS BIGINT) AS controversiality,
    CAST(NULL AS VARCHAR) AS distinguished,
    event_id % 3 AS downs,
    CASE WHEN event_id % 5 = 0 THEN 'true' ELSE 'false' END AS edited,
    CAST(CASE WHEN event_type = 'purchase' THEN 1 ELSE 0 END AS BIGINT) AS gilded,
    lower(to_base(event_id, 36)) AS id,
    't3_' || lower(to_base(event_id // 25, 36)) AS link_id,
    't1_' || lower(to_base(event_id, 36)) AS name,
    CASE WHEN event_id % 25 = 0 OR event_id % 3 = 0 THEN 't3_' || lower(to_base(event_id // 25, 36))
         ELSE 't1_' || lower(to_base(greatest(event_id - event_id % 25, event_id - 1 - event_id % 7), 36))
    END AS parent_id,
    CAST(floor(epoch(ts)) AS BIGINT) + (event_id // 25) % 3 * 15811200 + 86400 AS retrieved_on,
    CAST(trunc(value) AS BIGINT) AS score,
    false AS score_hidden,
    'sub_' || CAST(h % (1 + (h // 1000) % 150) AS VARCHAR) AS subreddit,
    't5_' || CAST(h % (1 + (h // 1000) % 150) AS VARCHAR) AS subreddit_id,
    CAST(trunc(value) AS BIGINT) + event_id % 3 AS ups,
    CAST(floor(epoch(ts)) AS BIGINT) + (event_id // 25) % 3 * 15811200 AS created_utc,
    event_id AS "offset",
    CAST(floor(epoch(ts)) AS BIGINT) AS arrived_at
  FROM (SELECT *, {_BUCKET} AS h FROM events) e
)"""

COMMENT_COLUMNS = ("archived, author, author_flair_css_class, body, controversiality, distinguished, downs, "
                   "edited, gilded, id, link_id, name, parent_id, retrieved_on, score, score_hidden, "
                   "subreddit, subreddit_id, ups, created_utc")

EDGES = """
edges AS (
  SELECT p.subreddit AS Subreddit, p.id AS OrigId, r.id AS RespId, p.author AS OrigAuth, r.author AS RespAuth,
         p.score AS OrigScore, r.score AS RespScore, p.ups AS OrigUps, r.ups AS RespUps,
         p.downs AS OrigDowns, r.downs AS RespDowns,
         p.controversiality AS OrigControv, r.controversiality AS RespControv
  FROM comments p JOIN comments r ON 't1_' || p.id = r.parent_id
  WHERE p.author <> '[deleted]' AND r.author <> '[deleted]'
),
indeg AS (SELECT Subreddit AS subreddit, OrigAuth AS author, count(*) AS rank FROM edges GROUP BY 1, 2),
outdeg AS (SELECT Subreddit AS subreddit, RespAuth AS author, count(*) AS rank FROM edges GROUP BY 1, 2),
top_in AS (SELECT subreddit, author, rank FROM indeg
           QUALIFY row_number() OVER (PARTITION BY subreddit ORDER BY rank DESC, author) = 1),
top_out AS (SELECT subreddit, author, rank FROM outdeg
            QUALIFY row_number() OVER (PARTITION BY subreddit ORDER BY rank DESC, author) = 1)"""

STATS = """
stats AS (
  SELECT year(make_timestamp(created_utc * 1000000)) AS year,
         month(make_timestamp(created_utc * 1000000)) AS month,
         subreddit,
         count(*) AS total_comments,
         count(DISTINCT author) AS distinct_authors,
         count(DISTINCT link_id) AS distinct_submissions,
         count(*) / count(DISTINCT author) AS comments_per_distinct_author,
         count(*) / count(DISTINCT link_id) AS comments_per_distinct_submission
  FROM comments GROUP BY 1, 2, 3
),
stats100 AS (SELECT * FROM stats
             QUALIFY row_number() OVER (PARTITION BY year, month ORDER BY total_comments DESC, subreddit) <= 100)"""

COUNTS = """
counts AS (SELECT author, subreddit, count(*) AS count FROM comments
           WHERE author <> '[deleted]' GROUP BY author, subreddit)"""

FIRST = """
firsts AS (SELECT author, created_utc, body, link_id, subreddit, id FROM comments
           QUALIFY row_number() OVER (PARTITION BY author ORDER BY created_utc, length(id), id) = 1)"""

PAGES_OF = """
members AS (
  SELECT "offset" // 100 AS page, * FROM comments
  UNION ALL
  SELECT "offset" // 100 + 1 AS page, * FROM comments WHERE "offset" % 100 >= 90
),
polls AS (SELECT page, max(arrived_at) AS polled_at FROM members GROUP BY page),
flat AS (
  SELECT m.page, p.polled_at, m.id, m.name, m.author, m.subreddit, m.parent_id, m.link_id, m.body,
         m.score, m.created_utc, """ + b36("m.id") + """ AS code
  FROM members m JOIN polls p USING (page)
)"""

def _recs(messages: int, seconds: int) -> str:
    """The replayed topic: FIXTURES F14 arrival times."""
    return f"""
recs AS (SELECT * REPLACE (CAST(1704153540 + "offset" * {seconds} // {messages} AS BIGINT) AS arrived_at)
         FROM comments),
live AS (SELECT * FROM recs WHERE author IS NOT NULL AND subreddit IS NOT NULL)"""


MINUTE = _recs(15, 1)
HOURLY = _recs(1, 10)


def _with(*ctes: str) -> str:
    return "WITH " + ",".join(ctes) + "\n"


def _slots(key: str, slot: int, delay: int) -> str:
    """Counts of closed slots with their rank; newest: the last arrival of the whole topic."""
    return f"""
mx AS (SELECT max(arrived_at) AS m FROM recs),
cnt AS (SELECT arrived_at - arrived_at % {slot} AS s, {key}, CAST(count(*) AS INTEGER) AS count
        FROM live GROUP BY 1, 2),
closed AS (SELECT cnt.*, row_number() OVER (PARTITION BY cnt.s ORDER BY count DESC, {key}) AS rank
           FROM cnt, mx WHERE cnt.s + {slot} <= mx.m - {delay})"""


def _stream_trend(key: str, slot: int, topic: str, delay: int, last: bool = False) -> str:
    only = f"AND s = (SELECT (m - {delay}) // {slot} * {slot} - {slot} FROM mx)" if last else ""
    return _with(COMMENTS, topic, _slots(key, slot, delay)) + f"""
SELECT {_label('s')} AS minuteslot, {key}, count, rank FROM closed WHERE rank <= 20 {only}"""


AUTHOR = "u8"

ORACLE: dict[str, str] = {
    "q_ingest": _with(COMMENTS) + f"""
SELECT {COMMENT_COLUMNS},
       year(make_timestamp(created_utc * 1000000)) AS year, month(make_timestamp(created_utc * 1000000)) AS month
FROM comments""",

    "q_author_count": _with(COMMENTS) + f"""
SELECT count(*) AS n_comments FROM comments WHERE author = '{AUTHOR}'""",

    "q_history": _with(COMMENTS) + f"""
SELECT author, created_utc, body, link_id, subreddit FROM comments WHERE author = '{AUTHOR}'""",

    "q_history_json": _with(COMMENTS) + f"""
SELECT CAST(to_json(struct_pack(author := author, posted_at := created_utc, post := body,
                                discussion := link_id, subreddit := subreddit)) AS VARCHAR) AS value
FROM comments WHERE author = '{AUTHOR}'""",

    "q_first_post": _with(COMMENTS, FIRST) + """
SELECT author, strftime(make_timestamp(created_utc * 1000000), '%m-%d-%Y %H:%M:%S') AS posted_at,
       body AS post, split_part(link_id, 't3_', 2) AS submission,
       'http://www.reddit.com/' || split_part(link_id, 't3_', 2) AS discussion_url, subreddit
FROM firsts""",

    "q_page_title": """
SELECT page_id, url, split_part(regexp_extract(html, '(?is)<title[^>]*>(.*?)</title>', 1), ':', 1) AS title
FROM pages""",

    "q_post_titles": _with(COMMENTS, FIRST) + f"""
SELECT f.author, f.created_utc, f.link_id, f.subreddit, {b36("split_part(f.link_id, 't3_', 2)")} AS page_id,
       split_part(regexp_extract(p.html, '(?is)<title[^>]*>(.*?)</title>', 1), ':', 1) AS title
FROM firsts f LEFT JOIN pages p ON p.page_id = {b36("split_part(f.link_id, 't3_', 2)")}""",

    "q_snapshot": _with(COMMENTS, STATS) + """
SELECT * FROM stats
QUALIFY row_number() OVER (PARTITION BY year, month ORDER BY total_comments DESC, subreddit) <= 20""",

    "q_snapshot_month": _with(COMMENTS, STATS) + """
SELECT subreddit, total_comments AS totalComments, distinct_authors AS distinctAuthors,
       distinct_submissions AS distinctSubmission, comments_per_distinct_author AS commentsPerDAuthor,
       comments_per_distinct_submission AS commentsPerDSubmission,
       CAST(2024 AS BIGINT) AS year, CAST(7 AS BIGINT) AS month
FROM stats100 WHERE year = 2024 AND month = 7""",

    "q_trend": _with(COMMENTS, STATS) + """
SELECT year, month, total_comments, distinct_authors, concat_ws('-', year, month) AS label
FROM stats100 WHERE subreddit = 'sub_0'""",

    "q_edges": _with(COMMENTS, EDGES) + "SELECT * FROM edges",
    "q_outdegree_sql": _with(COMMENTS, EDGES) + "SELECT * FROM outdeg",
    "q_indegree": _with(COMMENTS, EDGES) + "SELECT * FROM indeg",
    "q_outdegree": _with(COMMENTS, EDGES) + "SELECT * FROM outdeg",
    "q_top_influential": _with(COMMENTS, EDGES) +
        "SELECT subreddit, rank AS influence, author AS user FROM top_in",
    "q_top_active": _with(COMMENTS, EDGES) +
        "SELECT subreddit, rank AS influence, author AS user FROM top_out",
    "q_engagement": _with(COMMENTS, EDGES) + """
SELECT subreddit, i.author AS influential_user, i.rank AS influence, o.author AS active_user, o.rank AS activity
FROM top_in i FULL OUTER JOIN top_out o USING (subreddit)""",
    "q_degree_export": _with(COMMENTS, EDGES) + """
SELECT 'indegree' AS kind, subreddit, author AS user, rank AS influence FROM indeg
UNION ALL
SELECT 'outdegree' AS kind, subreddit, author AS user, rank AS influence FROM outdeg""",

    "q_engage_download": _with(COMMENTS, EDGES) + """
SELECT CAST(to_json(struct_pack(kind := kind, subreddit := subreddit, "user" := "user",
                                influence := influence)) AS VARCHAR) AS value
FROM (SELECT 'indegree' AS kind, subreddit, author AS "user", rank AS influence FROM indeg
      UNION ALL
      SELECT 'outdegree' AS kind, subreddit, author AS "user", rank AS influence FROM outdeg)
WHERE subreddit = 'sub_0'""",

    "q_ingest_months": _with(COMMENTS) + f"""
SELECT {COMMENT_COLUMNS},
       year(make_timestamp(created_utc * 1000000)) AS year, month(make_timestamp(created_utc * 1000000)) AS month,
       strftime(make_timestamp(created_utc * 1000000), 'RC_%Y-%m') AS source_file
FROM comments""",

    "q_graph_months": _with(COMMENTS, EDGES) + """
SELECT 'indegree' AS kind, subreddit, author, rank FROM indeg
UNION ALL SELECT 'outdegree' AS kind, subreddit, author, rank FROM outdeg""",

    "q_engage": _with(COMMENTS, EDGES, STATS, """
months AS (SELECT subreddit, string_agg(year || '-' || month || ':' || total_comments, ',' ORDER BY year, month) AS t
           FROM stats100 GROUP BY subreddit),
cands AS (SELECT DISTINCT s.subreddit AS seed, s.author AS leader, c.subreddit
          FROM top_out s JOIN comments c ON c.author = s.author WHERE c.subreddit <> s.subreddit),
recs AS (SELECT *, row_number() OVER (PARTITION BY seed ORDER BY md5(concat_ws('|', leader, subreddit)), subreddit)
                AS position FROM cands),
lists AS (SELECT seed, string_agg(subreddit, ',' ORDER BY position) AS r FROM recs WHERE position <= 6 GROUP BY seed)""") + """
SELECT subreddit, i.author AS influential_user, i.rank AS influence, o.author AS active_user, o.rank AS activity,
       coalesce(m.t, '') AS trend, coalesce(l.r, '') AS recommended
FROM top_in i FULL OUTER JOIN top_out o USING (subreddit)
LEFT JOIN months m USING (subreddit) LEFT JOIN lists l ON l.seed = subreddit""",

    "q_recommend": _with(COMMENTS, EDGES, """
seeds AS (SELECT subreddit AS seed, author AS leader FROM top_out),
blocked AS (SELECT DISTINCT subreddit FROM comments WHERE subreddit LIKE '%7'),
cands AS (
  SELECT DISTINCT s.seed, s.leader, c.subreddit
  FROM seeds s JOIN comments c ON c.author = s.leader
  WHERE c.subreddit <> s.seed AND c.subreddit NOT IN (SELECT subreddit FROM blocked)
)""") + """
SELECT seed, leader, subreddit, position FROM (
  SELECT *, row_number() OVER (PARTITION BY seed ORDER BY md5(concat_ws('|', leader, subreddit)), subreddit)
         AS position
  FROM cands)
WHERE position <= 6""",

    "q_user_counts": _with(COMMENTS, COUNTS) + "SELECT author, subreddit, count FROM counts",
    "q_user_ids": _with(COMMENTS, COUNTS) +
        f"SELECT DISTINCT author AS user, {_hash('author')} AS hash FROM counts",
    "q_item_ids": _with(COMMENTS, COUNTS) +
        f"SELECT DISTINCT subreddit AS product, {_hash('subreddit')} AS hash FROM counts",
    "q_hash_audit": _with(COMMENTS, COUNTS) + f"""
SELECT {_hash('author', 997)} AS hash, count(DISTINCT author) AS names, min(author) AS first_name,
       max(author) AS last_name
FROM counts GROUP BY 1 HAVING count(DISTINCT author) > 1""",
    "q_als_ratings": _with(COMMENTS, COUNTS) + f"""
SELECT CAST({_hash('author')} AS INTEGER) AS "user", CAST({_hash('subreddit')} AS INTEGER) AS item,
       CAST(count AS FLOAT) AS rating FROM counts""",
    "q_als": _with(COMMENTS, COUNTS) + """
SELECT author, position, true AS known, true AS ordered
FROM (SELECT DISTINCT author FROM counts),
     (SELECT unnest(range(1, 1 + least(10, (SELECT count(DISTINCT subreddit) FROM counts)))) AS position)""",

    "q_page_flatten": _with(COMMENTS, PAGES_OF) + "SELECT * FROM flat",
    "q_new_comments": _with(COMMENTS, PAGES_OF) + """
SELECT DISTINCT id, name, author, subreddit, parent_id, link_id, body, score, created_utc, code FROM flat
WHERE code > (SELECT max(code) FROM flat WHERE page <= 1)""",
    "q_high_water": _with(COMMENTS, PAGES_OF) + """
SELECT page, max(code) AS max_code, arg_max(id, code) AS newest_id, arg_max(created_utc, code) AS newest_created,
       max(polled_at) - arg_max(created_utc, code) AS lag_seconds,
       max(polled_at) - arg_max(created_utc, code) > 1000000 AS skipping
FROM flat GROUP BY page""",
    "q_to_json": _with(COMMENTS) + """
SELECT "offset", CAST(to_json(struct_pack(author := author, parent_id := parent_id, score := score, name := name,
         subreddit := subreddit, link_url := 'http://www.reddit.com/' || split_part(link_id, 't3_', 2),
         created_utc := created_utc, body := body)) AS VARCHAR) AS value
FROM comments""",
    "q_dead_letter": _with(COMMENTS) + """
SELECT "offset", 'not json' AS message FROM comments WHERE "offset" % 97 = 0""",

    "q_minute_subreddits": _stream_trend("subreddit", 60, MINUTE, 5),
    "q_minute_authors": _stream_trend("author", 60, MINUTE, 5),
    "q_hour_authors": _stream_trend("author", 3600, HOURLY, 120),
    "q_trend_repair": _stream_trend("subreddit", 60, MINUTE, 5),

    "q_trend_read": _stream_trend("subreddit", 60, MINUTE, 5, last=True),

    "q_hour_trend_read": _stream_trend("author", 3600, HOURLY, 120, last=True),

    "q_live": _with(COMMENTS, _recs(50, 1), """
good AS (SELECT * FROM recs WHERE "offset" % 97 <> 0)""") + """
SELECT arrived_at AS secslot, subreddit, author, created_utc, body,
       strftime(make_timestamp(created_utc * 1000000), '%Y-%m-%d %H:%M:%S') AS posted_at
FROM good WHERE arrived_at = (SELECT max(arrived_at) - 5 FROM recs)
ORDER BY created_utc, author, body LIMIT 20""",

    "q_feed_compacted": _with(COMMENTS, MINUTE) + """
SELECT arrived_at AS secslot, subreddit, author, created_utc, body FROM recs WHERE arrived_at >= 1704153600""",

    "q_archive": _with(COMMENTS, MINUTE) + """
SELECT author, parent_id, score, name, subreddit, 'http://www.reddit.com/' || split_part(link_id, 't3_', 2) AS link_url,
       created_utc, body, "offset", arrived_at
FROM recs""",

    "q_keyed_history": _with(COMMENTS) + f"""
SELECT author, created_utc, body, link_id, subreddit FROM comments WHERE author = '{AUTHOR}'""",

    "q_distinct_rollup": _with(COMMENTS, """
dated AS (SELECT *, make_timestamp(created_utc * 1000000) AS made FROM comments),
periods AS (SELECT subreddit, author, link_id, unnest([year(made) || '-Q' || quarter(made), CAST(year(made) AS VARCHAR), 'all'])
                   AS period FROM dated)""") + """
SELECT period, subreddit, count(*) AS total_comments, count(DISTINCT author) AS distinct_authors,
       count(DISTINCT link_id) AS distinct_submissions, count(*) / count(DISTINCT author) AS comments_per_distinct_author
FROM periods GROUP BY period, subreddit""",

    "q_author_sketches": _with(COMMENTS, HOURLY, """
hours AS (SELECT arrived_at - arrived_at % 3600 AS s, author, count(*) AS count FROM live GROUP BY ALL)""") + f"""
SELECT {_label('s')} AS minuteslot, author, count, row_number() OVER (PARTITION BY s ORDER BY count DESC, author) AS rank
FROM hours QUALIFY rank <= 20""",

    "q_fold_in": _with(COMMENTS, COUNTS) + "SELECT DISTINCT author, true AS same FROM counts",

    "q_schema_drift": _with(COMMENTS) + """
SELECT id, author, created_utc, CASE WHEN "offset" % 2 = 0 THEN gilded END AS gilded,
       CASE WHEN "offset" % 2 = 0 THEN 'RC_old' ELSE 'RC_new' END AS source_file,
       CASE WHEN "offset" % 2 = 1 THEN "offset" % 7 END AS gold,
       CASE WHEN "offset" % 2 = 1 THEN "offset" % 3 = 0 END AS stickied
FROM comments""",

    "q_dense_ids": _with(COMMENTS, """
firsts AS (SELECT author, min("offset" % 2) AS later FROM comments GROUP BY author)""") + """
SELECT author, row_number() OVER (ORDER BY later, author) - 1 AS id FROM firsts""",

    "q_dense_ratings": _with(COMMENTS, COUNTS, """
users AS (SELECT author, row_number() OVER (ORDER BY author) - 1 AS u FROM (SELECT DISTINCT author FROM counts)),
items AS (SELECT subreddit, row_number() OVER (ORDER BY subreddit) - 1 AS i FROM (SELECT DISTINCT subreddit FROM counts))""") + """
SELECT CAST(u AS INTEGER) AS "user", CAST(i AS INTEGER) AS item, CAST(count AS FLOAT) AS rating
FROM counts JOIN users USING (author) JOIN items USING (subreddit)""",

    "q_ticks": _with(COMMENTS, MINUTE, """
listened AS (SELECT 'subreddit' AS kind, subreddit AS name, arrived_at - arrived_at % 60 AS s FROM live
         UNION ALL SELECT 'author', author, arrived_at - arrived_at % 60 FROM live),
counted AS (SELECT kind, name, s, count(*) AS count FROM listened GROUP BY ALL)""") + f"""
SELECT kind, {_label('s')} AS minuteslot, name, count,
       row_number() OVER (PARTITION BY kind, s ORDER BY count DESC, name) AS rank FROM counted QUALIFY rank <= 20""",

    "q_feed_marks": _with(COMMENTS) + f"""
SELECT 'feed' || CAST("offset" % 3 AS VARCHAR) AS feed, id, name, author, subreddit, parent_id, link_id, body, score,
       created_utc, {b36('id')} AS code
FROM comments""",

    "q_stream_dedup": _with(COMMENTS) + f"""
SELECT id, name, author, subreddit, parent_id, link_id, body, score, created_utc, {b36('id')} AS code
FROM comments""",

    "q_upsert": _with(COMMENTS) + """
SELECT author, created_utc, body, link_id, subreddit FROM comments
QUALIFY row_number() OVER (PARTITION BY author, created_utc ORDER BY length(id) DESC, id DESC) = 1""",

    "q_ttl": _with(COMMENTS, MINUTE) + f"""
SELECT {_label('s')} AS minuteslot, subreddit, count FROM (
  SELECT arrived_at - arrived_at % 60 AS s, subreddit, CAST(count(*) AS INTEGER) AS count
  FROM live GROUP BY 1, 2)
WHERE s + 60 > (SELECT max(arrived_at) FROM recs) - 300""",
}

ORACLE["q_ingest_stream"] = ORACLE["q_ingest"]
ORACLE["q_edges_bucketed"] = ORACLE["q_edges"]
ORACLE["q_snapshot_sql"] = ORACLE["q_snapshot"]
ORACLE["q_engagement_months"] = ORACLE["q_engagement"]
