"""Registered mention queries and their oracle SQL."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from quarry.functions.text import tokenize
from quarry.operators import mentions as mx
from quarry.plans import adapters
from quarry.plans.catalog import TOKENS_SQL, WSR_SQL, Query
from quarry.session import scratch_path
from quarry.sources import corpus as src
from quarry.sources import landed, posts_store
from quarry.sources import report

# Parameters of the registered queries (user inputs).
MENTION_TOPICS = ["the", "de", "zzzz-none"]
# two thousand rare substrings: three letters, the first of them seldom
RARE_PARTS = [a + b + c for a in "qxz" for b in "abcdefghijklmnopqrstuvwxyz" for c in "abcdefghijklmnopqrstuvwxyz"]
TOP = 50
EVENTS_YEAR = 2024
ORDERS_YEAR = 2001
AS_OF = dt.datetime(2024, 1, 20)

_REC_START, _REC_END = mx.recent_bounds(AS_OF)
_Y_START, _Y_END = mx.year_bounds(EVENTS_YEAR)
_O_START, _O_END = mx.year_bounds(ORDERS_YEAR)


def _ts(d: dt.datetime) -> str:
    return f"TIMESTAMP '{d:%Y-%m-%d %H:%M:%S}'"


def q_flatten_posts(spark, sf):
    pages, _rejects = landed.parse_pages(adapters.raw_pages_from_events(spark, sf))
    return mx.flatten_items(landed.page_items(pages))


def q_post_preview(spark, sf):
    return mx.preview(adapters.posts_from_events(spark, sf), 10)


def q_posts_recent(spark, sf):
    p = mx.posts_recent(adapters.posts_from_events(spark, sf), AS_OF)
    return p.select("university", "post_id", "date")


def q_posts_in_year(spark, sf):
    p = mx.posts_in_year(adapters.posts_from_orders(spark, sf), ORDERS_YEAR)
    return p.select("university", "post_id", "date")


def _year_search(spark, sf, whole_token=False):
    posts = adapters.searchable_posts(spark, sf).filter(mx.in_period(F.col("date"), _Y_START, _Y_END))
    found = mx.search_mentions(posts, MENTION_TOPICS, whole_token=whole_token)
    return found.filter(F.year("date") == EVENTS_YEAR)


def q_mention_search(spark, sf):
    return _year_search(spark, sf).select("university", "post_id", "date", "author_id", "likes")


def q_mention_tokens(spark, sf):
    return _year_search(spark, sf, True).select("university", "post_id", "date", "author_id", "likes")


def q_stored_recent(spark, sf):
    """P5 on posts stored by day."""
    path = posts_store.write_posts(adapters.posts_from_events(spark, sf), scratch_path(spark, "posts"))
    return posts_store.posts_recent(spark, path, AS_OF).select("university", "post_id", "date")


def q_stored_in_year(spark, sf):
    """P4 on posts stored by month."""
    path = posts_store.write_posts(adapters.posts_from_orders(spark, sf), scratch_path(spark, "posts"), "month")
    return posts_store.posts_in_year(spark, path, ORDERS_YEAR, grain="month").select("university", "post_id", "date")


def _merged_state(spark, sf):
    """States of the odd and the even posts, merged: topics and authors are in both."""
    posts = adapters.posts_from_events(spark, sf)
    odd = F.pmod(F.col("post_id"), F.lit(2)) == 1
    parts = [mx.mention_state(posts.where(c), EVENTS_YEAR) for c in (odd, ~odd)]
    return mx.merged_states(parts[0].unionByName(parts[1]))


def q_merged_topic_stats(spark, sf):
    return mx.topic_stats_of(_merged_state(spark, sf))


def q_merged_overall(spark, sf):
    return mx.overall_stats_of(_merged_state(spark, sf))


def q_mention_many_tokens(spark, sf):
    """A long topic list: every token of the benchmark, searched as a whole token."""
    topics = src.table(spark, sf, "benchmark").select(F.explode(tokenize("text")).alias("topic"))
    posts = adapters.searchable_posts(spark, sf).filter(mx.in_period(F.col("date"), _Y_START, _Y_END))
    return mx.topic_stats(mx.search_mentions(posts, topics, whole_token=True))


def q_mention_many_parts(spark, sf):
    """A long list of substrings, found by one automaton."""
    return mx.topic_stats(mx.search_mentions(adapters.searchable_posts(spark, sf), RARE_PARTS))


def q_mention_top(spark, sf):
    posts = adapters.searchable_posts(spark, sf).filter(mx.in_period(F.col("date"), _Y_START, _Y_END))
    return mx.search_mentions(posts, MENTION_TOPICS, cap=TOP).select("university", "post_id", "date")


def q_mention_stats(spark, sf):
    posts = mx.posts_recent(adapters.searchable_posts(spark, sf), AS_OF)
    return mx.topic_stats(mx.search_mentions(posts, MENTION_TOPICS), MENTION_TOPICS)


def q_daily_counts_search(spark, sf):
    return mx.daily_counts(_year_search(spark, sf), MENTION_TOPICS)


def _recent_job(table):
    def query(spark, sf):
        from quarry.plans import jobs
        return jobs.mentions_recent(spark, adapters.searchable_posts(spark, sf), MENTION_TOPICS, AS_OF)[table]
    return query


def _year_job(table):
    def query(spark, sf):
        from quarry.plans import jobs
        return jobs.mentions_year(spark, adapters.searchable_posts(spark, sf), MENTION_TOPICS, EVENTS_YEAR)[table]
    return query


def _report_sheet(sheet):
    def query(spark, sf):
        out = scratch_path(spark, "report")
        paths = report.write_report(adapters.posts_from_events(spark, sf), out, EVENTS_YEAR)
        return spark.read.parquet(paths[sheet])
    return query


def q_landed_rejects(spark, sf):
    pages, lines = landed.parse_pages(adapters.damaged_pages_from_events(spark, sf))
    return lines.select(F.lit("line").alias("kind"), "raw").unionByName(
        landed.item_rejects(pages).select(F.lit("post").alias("kind"), "raw"))


def q_topic_stats(spark, sf):
    return mx.topic_stats(adapters.posts_from_events(spark, sf))


def q_topic_stats_frame(spark, sf):
    return mx.topic_stats_frame(adapters.posts_from_events(spark, sf))


def q_overall_stats(spark, sf):
    return mx.overall_stats(adapters.posts_from_events(spark, sf))


def q_daily_counts(spark, sf):
    return mx.daily_counts(adapters.posts_from_events(spark, sf))


def q_monthly_matrix(spark, sf):
    return mx.monthly_matrix(adapters.posts_from_orders(spark, sf), ORDERS_YEAR)


def q_monthly_long(spark, sf):
    return mx.monthly_long(mx.monthly_matrix(adapters.posts_from_orders(spark, sf), ORDERS_YEAR))


def q_publications(spark, sf):
    return mx.publications(adapters.posts_from_events(spark, sf))


MENTION_QUERIES: dict[str, Query] = {
    "flatten_posts": q_flatten_posts,
    "post_preview": q_post_preview,
    "posts_recent": q_posts_recent,
    "posts_in_year": q_posts_in_year,
    "mention_search": q_mention_search,
    "mention_stats": q_mention_stats,
    "daily_counts_search": q_daily_counts_search,
    "topic_stats": q_topic_stats,
    "topic_stats_frame": q_topic_stats_frame,
    "overall_stats": q_overall_stats,
    "daily_counts": q_daily_counts,
    "monthly_matrix": q_monthly_matrix,
    "monthly_long": q_monthly_long,
    "publications": q_publications,
    "mention_tokens": q_mention_tokens,
    "mention_many_tokens": q_mention_many_tokens,
    "stored_recent": q_stored_recent,
    "stored_in_year": q_stored_in_year,
    "merged_topic_stats": q_merged_topic_stats,
    "merged_overall": q_merged_overall,
    "mention_many_parts": q_mention_many_parts,
    "mention_top": q_mention_top,
    "mentions_recent_stats": _recent_job("stats"),
    "mentions_recent_daily": _recent_job("daily"),
    "mentions_year_stats": _year_job("stats"),
    "mentions_year_overall": _year_job("overall"),
    "mentions_year_monthly": _year_job("monthly"),
    "report_overall": _report_sheet(report.SHEET_OVERALL),
    "report_tables": _report_sheet(report.SHEET_TOPICS),
    "report_publications": _report_sheet(report.SHEET_PUBLICATIONS),
    "report_monthly": _report_sheet(report.SHEET_MONTHLY),
    "landed_rejects": q_landed_rejects,
}

# ---- oracle SQL -------------------------------------------------------------------------------
_URL = f"'{mx.POST_URL_PREFIX}' || user_id || '_' || event_id"
_POSTS = f"""posts AS (
  SELECT event_type AS university, event_id AS post_id, user_id AS owner_id,
         CASE WHEN event_id % 7 = 0 THEN NULL ELSE user_id END AS author_id,
         ts AS date, props AS text,
         CAST(json_extract_string(props, '$.k') AS BIGINT) AS likes,
         CAST(floor(value) AS BIGINT) AS views, event_id % 5 AS reposts, event_id % 3 AS comments,
         {_URL} AS post_url
  FROM events)"""
_ORDER_POSTS = """oposts AS (
  SELECT o_orderpriority AS university, o_orderkey AS post_id, o_custkey AS author_id,
         o_orderdate AS date FROM orders)"""
_SEARCHABLE = f"""sposts AS (
  SELECT e.event_id AS post_id, e.user_id AS author_id, e.ts AS date,
         CAST(json_extract_string(e.props, '$.k') AS BIGINT) AS likes,
         CAST(floor(e.value) AS BIGINT) AS views, e.event_id % 5 AS reposts,
         e.event_id % 3 AS comments, d.text
  FROM events e JOIN documents d ON d.doc_id = e.event_id % (SELECT count(*) FROM documents)),
topics(university) AS (VALUES {", ".join(f"('{t}')" for t in MENTION_TOPICS)})"""
_YEAR_FOUND = f"""found AS (
  SELECT * FROM (
    SELECT t.university, p.*,
           row_number() OVER (PARTITION BY t.university ORDER BY p.date DESC, p.post_id, p.author_id) AS rn
    FROM topics t JOIN sposts p ON contains(p.text, t.university)
    WHERE p.date >= {_ts(_Y_START)} AND p.date <= {_ts(_Y_END)})
  WHERE year(date) = {EVENTS_YEAR})"""
_STAT_SUMS = """coalesce(sum(likes), 0)::BIGINT AS likes_count, coalesce(sum(views), 0)::BIGINT AS views_count,
       coalesce(sum(reposts), 0)::BIGINT AS reposts_count, coalesce(sum(comments), 0)::BIGINT AS comments_count"""
_SET_SIZE = "(count(DISTINCT author_id) + max(CASE WHEN author_id IS NULL THEN 1 ELSE 0 END))::BIGINT"
_MONTHS = ",\n       ".join(
    f"count(*) FILTER (WHERE year(date) = {ORDERS_YEAR} AND month(date) = {m})::BIGINT AS {name}"
    for m, name in enumerate(mx.MONTH_NAMES, start=1))
_MATRIX = f"""matrix AS (
  SELECT university, {_MONTHS}
  FROM oposts WHERE date >= {_ts(_O_START)} AND date <= {_ts(_O_END)} GROUP BY university)"""

# whole tokens: the text split at white space holds the topic itself
_TOKEN_FOUND = f"""found AS (
  SELECT t.university, p.* FROM topics t JOIN sposts p
    ON list_contains(regexp_split_to_array(p.text, '{WSR_SQL}'), t.university)
  WHERE p.date >= {_ts(_Y_START)} AND p.date <= {_ts(_Y_END)} AND year(p.date) = {EVENTS_YEAR})"""
_RECENT_FOUND = f"""found AS (
  SELECT t.university, p.* FROM topics t JOIN sposts p ON contains(p.text, t.university)
  WHERE p.date >= {_ts(_REC_START)} AND p.date <= {_ts(_REC_END)})"""
_RECENT_STATS_SQL = f"""
WITH {_SEARCHABLE}, {_RECENT_FOUND},
stats AS (
  SELECT university, count(*)::BIGINT AS posts_count, {_SET_SIZE} AS authors_count, {_STAT_SUMS}
  FROM found GROUP BY university)
SELECT t.university, coalesce(posts_count, 0)::BIGINT AS posts_count,
       coalesce(authors_count, 0)::BIGINT AS authors_count, coalesce(likes_count, 0)::BIGINT AS likes_count,
       coalesce(views_count, 0)::BIGINT AS views_count, coalesce(reposts_count, 0)::BIGINT AS reposts_count,
       coalesce(comments_count, 0)::BIGINT AS comments_count
FROM topics t LEFT JOIN stats s ON t.university = s.university
"""
_FILLED_DAYS = """
pd AS (SELECT university, strftime(date, '%Y-%m-%d') AS day, count(*) AS n FROM found GROUP BY ALL),
days AS (SELECT DISTINCT day FROM pd)
SELECT t.university, d.day, coalesce(pd.n, 0)::BIGINT AS n
FROM topics t CROSS JOIN days d LEFT JOIN pd ON pd.university = t.university AND pd.day = d.day
"""


def _months_sql(year: int) -> str:
    return ", ".join(f"count(*) FILTER (WHERE year(date) = {year} AND month(date) = {m})::BIGINT AS {name}"
                     for m, name in enumerate(mx.MONTH_NAMES, start=1))


MENTION_ORACLE: dict[str, str] = {
    "flatten_posts": f"""
SELECT event_type AS university, event_id AS post_id, user_id AS owner_id, user_id AS author_id,
       make_timestamp((epoch_us(ts) // 1000000) * 1000000) AS date, props AS text,
       coalesce(CAST(json_extract_string(props, '$.k') AS BIGINT), 0) AS likes,
       CASE WHEN event_id % 5 = 0 THEN 0 ELSE CAST(floor(value) AS BIGINT) END AS views,
       event_id % 5 AS reposts, event_id % 3 AS comments, {_URL} AS post_url
FROM events
""",
    "post_preview": f"""
WITH {_POSTS}
SELECT university, rank, post_id, epoch_us(date) // 1000000 AS raw_timestamp, date FROM (
  SELECT *, row_number() OVER (PARTITION BY university ORDER BY date DESC, post_id)::BIGINT AS rank
  FROM posts) WHERE rank <= 10
""",
    "posts_recent": f"""
WITH {_POSTS}
SELECT university, post_id, date FROM posts
WHERE date >= {_ts(_REC_START)} AND date <= {_ts(_REC_END)}
""",
    "posts_in_year": f"""
WITH {_ORDER_POSTS}
SELECT university, post_id, date FROM oposts
WHERE date >= {_ts(_O_START)} AND date <= {_ts(_O_END)} AND year(date) = {ORDERS_YEAR}
""",
    "mention_search": f"""
WITH {_SEARCHABLE}, {_YEAR_FOUND}
SELECT university, post_id, date, author_id, likes FROM found
""",
    "mention_stats": _RECENT_STATS_SQL,
    "daily_counts_search": f"WITH {_SEARCHABLE}, {_YEAR_FOUND}, {_FILLED_DAYS}",
    "mention_tokens": f"""
WITH {_SEARCHABLE}, {_TOKEN_FOUND}
SELECT university, post_id, date, author_id, likes FROM found
""",
    "mention_many_tokens": f"""
WITH {_SEARCHABLE},
asked AS (SELECT DISTINCT unnest({TOKENS_SQL}) AS university FROM benchmark),
said AS (SELECT DISTINCT doc_id, unnest({TOKENS_SQL}) AS university FROM documents),
found AS (
  SELECT s.university, p.* FROM said s SEMI JOIN asked USING (university)
  JOIN (SELECT *, post_id % (SELECT count(*) FROM documents) AS doc_id FROM sposts) p ON p.doc_id = s.doc_id
  WHERE p.date >= {_ts(_Y_START)} AND p.date <= {_ts(_Y_END)})
SELECT university, count(*)::BIGINT AS posts_count, {_SET_SIZE} AS authors_count, {_STAT_SUMS}
FROM found GROUP BY university
""",
    "mention_many_parts": f"""
WITH {_SEARCHABLE},
asked(university) AS (VALUES {", ".join(f"('{t}')" for t in RARE_PARTS)}),
said AS (SELECT doc_id, a.university FROM documents, asked a WHERE contains(text, a.university)),
found AS (
  SELECT s.university, p.* FROM said s
  JOIN (SELECT *, post_id % (SELECT count(*) FROM documents) AS doc_id FROM sposts) p ON p.doc_id = s.doc_id)
SELECT university, count(*)::BIGINT AS posts_count, {_SET_SIZE} AS authors_count, {_STAT_SUMS}
FROM found GROUP BY university
""",
    "mention_top": f"""
WITH {_SEARCHABLE}, {_YEAR_FOUND}
SELECT university, post_id, date FROM found WHERE rn <= {TOP}
""",
    "mentions_recent_stats": _RECENT_STATS_SQL,
    "mentions_recent_daily": f"WITH {_SEARCHABLE}, {_RECENT_FOUND}, {_FILLED_DAYS}",
    "mentions_year_stats": f"""
WITH {_SEARCHABLE}, {_YEAR_FOUND}
SELECT university, count(*)::BIGINT AS posts_count, {_SET_SIZE} AS authors_count, {_STAT_SUMS}
FROM found GROUP BY university
""",
    "mentions_year_overall": f"""
WITH {_SEARCHABLE}, {_YEAR_FOUND}
SELECT count(*)::BIGINT AS total_posts, {_SET_SIZE} AS unique_authors FROM found
""",
    "mentions_year_monthly": f"""
WITH {_SEARCHABLE}, {_YEAR_FOUND}
SELECT university, {_months_sql(EVENTS_YEAR)} FROM found GROUP BY university
""",
    "report_overall": f"""
WITH {_POSTS}
SELECT count(*)::BIGINT AS total_posts, {_SET_SIZE} AS unique_authors FROM posts
""",
    "report_publications": f"""
WITH {_POSTS}
SELECT university AS "{report.PUBLICATION_HEADERS[0]}", date AS "{report.PUBLICATION_HEADERS[1]}",
       text AS "{report.PUBLICATION_HEADERS[2]}", likes AS "{report.PUBLICATION_HEADERS[3]}",
       views AS "{report.PUBLICATION_HEADERS[4]}", reposts AS "{report.PUBLICATION_HEADERS[5]}",
       comments AS "{report.PUBLICATION_HEADERS[6]}", post_url AS "{report.PUBLICATION_HEADERS[7]}"
FROM posts
""",
    "report_monthly": f"""
WITH {_POSTS}
SELECT university AS "{report.MONTHLY_TOPIC_HEADER}", {_months_sql(EVENTS_YEAR)}
FROM posts WHERE date >= {_ts(_Y_START)} AND date <= {_ts(_Y_END)} GROUP BY university
""",
    "landed_rejects": """
SELECT 'line' AS kind, '{"query":"' || event_type || '",' || event_id AS raw FROM events WHERE event_id % 97 = 0
UNION ALL
SELECT 'post', '{"id":' || event_id || ',"likes":"many"}' FROM events WHERE event_id % 97 <> 0 AND event_id % 13 = 0
""",
    "stored_recent": f"""
WITH {_POSTS}
SELECT university, post_id, date FROM posts
WHERE date >= {_ts(_REC_START)} AND date <= {_ts(_REC_END)}
""",
    "stored_in_year": f"""
WITH {_ORDER_POSTS}
SELECT university, post_id, date FROM oposts
WHERE date >= {_ts(_O_START)} AND date <= {_ts(_O_END)} AND year(date) = {ORDERS_YEAR}
""",
    "merged_topic_stats": f"""
WITH {_POSTS}
SELECT university, count(*)::BIGINT AS posts_count, {_SET_SIZE} AS authors_count, {_STAT_SUMS}
FROM posts GROUP BY university
""",
    "merged_overall": f"""
WITH {_POSTS}
SELECT count(*)::BIGINT AS total_posts, {_SET_SIZE} AS unique_authors FROM posts
""",
    "topic_stats": f"""
WITH {_POSTS}
SELECT university, count(*)::BIGINT AS posts_count, {_SET_SIZE} AS authors_count, {_STAT_SUMS}
FROM posts GROUP BY university
""",
    "topic_stats_frame": f"""
WITH {_POSTS}
SELECT university, count(post_id)::BIGINT AS posts_count, count(DISTINCT author_id)::BIGINT AS authors_count,
       {_STAT_SUMS}
FROM posts GROUP BY university
""",
    "overall_stats": f"""
WITH {_POSTS}
SELECT count(*)::BIGINT AS total_posts, {_SET_SIZE} AS unique_authors FROM posts
""",
    "daily_counts": f"""
WITH {_POSTS},
pd AS (SELECT university, strftime(date, '%Y-%m-%d') AS day, count(*) AS n FROM posts GROUP BY ALL),
days AS (SELECT DISTINCT day FROM pd), tp AS (SELECT DISTINCT university FROM pd)
SELECT t.university, d.day, coalesce(pd.n, 0)::BIGINT AS n
FROM tp t CROSS JOIN days d LEFT JOIN pd ON pd.university = t.university AND pd.day = d.day
""",
    "monthly_matrix": f"WITH {_ORDER_POSTS}, {_MATRIX} SELECT * FROM matrix",
    "monthly_long": f"""
WITH {_ORDER_POSTS}, {_MATRIX}
SELECT university, m.month,
       CASE m.month {" ".join(f"WHEN {i} THEN {name}" for i, name in enumerate(mx.MONTH_NAMES, start=1))} END AS n
FROM matrix, (SELECT range::INTEGER AS month FROM range(1, 13)) m
""",
    "publications": f"""
WITH {_POSTS}
SELECT university, date, text, likes, views, reposts, comments, post_url FROM posts
""",
    "report_tables": f"""
WITH {_POSTS}
SELECT university AS "{report.TOPIC_HEADERS[0]}", count(post_id)::BIGINT AS "{report.TOPIC_HEADERS[1]}",
       count(DISTINCT author_id)::BIGINT AS "{report.TOPIC_HEADERS[2]}",
       coalesce(sum(likes), 0)::BIGINT AS "{report.TOPIC_HEADERS[3]}",
       coalesce(sum(views), 0)::BIGINT AS "{report.TOPIC_HEADERS[4]}",
       coalesce(sum(reposts), 0)::BIGINT AS "{report.TOPIC_HEADERS[5]}",
       coalesce(sum(comments), 0)::BIGINT AS "{report.TOPIC_HEADERS[6]}"
FROM posts GROUP BY university
""",
}
