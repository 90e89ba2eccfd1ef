"""Mention statistics over posts: flatten, period filters, topic search, per-topic,
overall, daily and monthly aggregates.

Flat posts: ``university STRING, post_id BIGINT, owner_id BIGINT, author_id BIGINT,
date TIMESTAMP_NTZ, text STRING, likes, views, reposts, comments BIGINT, post_url STRING``.
``university`` is the topic a post was found for; a post found for two topics is two rows.
"""

from __future__ import annotations

import datetime as dt
import functools

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.operators.topics import match_topics, topic_array
from quarry.operators.topk import top_k_per_group
from quarry.session import small_literal_frame

# --- fixed values ---------------------------------------------------------------------------
POST_URL_PREFIX = "https://vk.com/wall"     # post_url = prefix + owner_id + "_" + post_id
RECENT_DAYS = 5                             # trailing period length ...
RECENT_END_LAG_DAYS = 1                     # ... ending this many days before "now"
MONTH_NAMES = ("January", "February", "March", "April", "May", "June", "July", "August",
               "September", "October", "November", "December")
# ---------------------------------------------------------------------------------------------

EPOCH = "TIMESTAMP_NTZ'1970-01-01 00:00:00'"
FLAT_COLUMNS = ["university", "post_id", "owner_id", "author_id", "date", "text", "likes",
                "views", "reposts", "comments", "post_url"]


def epoch_to_ts(epoch: Column, tz: str = "UTC") -> Column:
    """M9: epoch seconds -> wall-clock TIMESTAMP_NTZ in ``tz`` (missing -> epoch 0)."""
    utc = F.timestamp_add("SECOND", epoch, F.expr(EPOCH))
    return utc if tz == "UTC" else F.convert_timezone(F.lit("UTC"), F.lit(tz), utc)


def ts_to_epoch(ts: Column) -> Column:
    """Whole seconds since the epoch of a TIMESTAMP_NTZ (UTC wall clock)."""
    return F.timestamp_diff("SECOND", F.expr(EPOCH), ts)


def post_url(owner: Column, post: Column, prefix: str = POST_URL_PREFIX) -> Column:
    """A missing part prints as an empty string."""
    return F.concat(F.lit(prefix), F.coalesce(owner.cast("string"), F.lit("")), F.lit("_"),
                    F.coalesce(post.cast("string"), F.lit("")))


# --- P1 ---------------------------------------------------------------------------------------
def flatten_items(items: DataFrame, tz: str = "UTC") -> DataFrame:
    """``(topic, item)`` -> flat posts.  Absent keys take the defaults: author = from_id,
    else owner_id; date epoch 0; text ''; counts 0."""
    it = F.col("item")
    return items.select(
        F.col("topic").alias("university"),
        it["id"].alias("post_id"),
        it["owner_id"].alias("owner_id"),
        F.coalesce(it["from_id"], it["owner_id"]).alias("author_id"),
        epoch_to_ts(F.coalesce(it["date"], F.lit(0)), tz).alias("date"),
        F.coalesce(it["text"], F.lit("")).alias("text"),
        *[F.coalesce(it[k]["count"], F.lit(0)).alias(k) for k in ("likes", "views", "reposts", "comments")],
        post_url(it["owner_id"], it["id"]).alias("post_url"))


# --- P4 / P5: periods ---------------------------------------------------------------------------
def year_bounds(year: int, now: dt.datetime | None = None) -> tuple[dt.datetime, dt.datetime]:
    start = dt.datetime(year, 1, 1)
    end = dt.datetime(year, 12, 31, 23, 59, 59)
    if now is not None and now.year == year:
        end = now.replace(microsecond=0)
    return start, end


def recent_bounds(as_of: dt.datetime) -> tuple[dt.datetime, dt.datetime]:
    end = (as_of - dt.timedelta(days=RECENT_END_LAG_DAYS)).replace(microsecond=0)
    return end - dt.timedelta(days=RECENT_DAYS), end


def in_period(date: Column, start: dt.datetime, end: dt.datetime) -> Column:
    """Inclusive on both ends; written as a range on the raw column so Parquet prunes it."""
    # wall-clock literal from text, independent of the session and Python time zones
    lit = lambda d: F.lit(d.strftime("%Y-%m-%d %H:%M:%S")).cast("timestamp_ntz")
    return (date >= lit(start)) & (date <= lit(end))


def posts_in_year(posts: DataFrame, year: int, now: dt.datetime | None = None,
                  date_col: str = "date") -> DataFrame:
    """Calendar-year bounds, then ``year(date) == year`` (merged into one filter)."""
    s, e = year_bounds(year, now)
    return posts.filter(in_period(F.col(date_col), s, e) & (F.year(date_col) == year))


def posts_recent(posts: DataFrame, as_of: dt.datetime, date_col: str = "date") -> DataFrame:
    """P5: ``[as_of - 6 days, as_of - 1 day]``, no re-filter."""
    s, e = recent_bounds(as_of)
    return posts.filter(in_period(F.col(date_col), s, e))


# --- P3 / J1 / L3: topic search -----------------------------------------------------------------
def api_order() -> list[Column]:
    """Order of a search response: newest first, then by post (a post is its id and owner)."""
    return [F.col("date").desc(), F.col("post_id").asc(), F.col("owner_id").asc()]


def search_mentions(posts: DataFrame, topics: list[str] | DataFrame, cap: int | None = None,
                    whole_token: bool = False) -> DataFrame:
    """Posts whose text contains the topic (case-sensitive substring, or a whole
    whitespace-separated token), labelled with the topic; posts are not shuffled and a long topic
    list costs about what a short one does (:mod:`quarry.operators.topics`).  A NULL text matches nothing.

    With ``cap`` only the first ``cap`` posts of each topic in API order (an explicit top-k)."""
    matched = match_topics(posts, topics, whole_token)
    kept = [c for c in posts.columns if c != "university"]
    if cap is None:
        return matched
    # the tie is a column of its own, made once: the ranking sorts and moves it in place of the text
    # where the caller does not ask for the text
    tied = matched.withColumn("_tie", F.xxhash64(*[c for c in kept if c != "text"], "text"))
    top = top_k_per_group(tied, ["university"], [*api_order(), F.col("_tie").asc()], cap, rank_col="_rank")
    return top.drop("_rank", "_tie")


def preview(posts: DataFrame, n: int = 10) -> DataFrame:
    """P10: the first ``n`` posts of each topic in API order with their raw epoch."""
    top = top_k_per_group(posts, ["university"], api_order(), n, rank_col="rank")
    return top.select("university", F.col("rank").cast("long").alias("rank"), "post_id",
                      ts_to_epoch(F.col("date")).alias("raw_timestamp"), "date")


# --- A7 / A8 / A9 --------------------------------------------------------------------------------
def _set_size(c: Column) -> Column:
    """Size of a Python set of the values: NULL counts as one more value."""
    return (F.count_distinct(c) + F.max(F.when(c.isNull(), 1).otherwise(0))).cast("long")


#: Words of 64 authors in a block of :func:`topic_stats`, and the bits of an id below its block.
_WORDS = 8
_BLOCK_BITS = 9

_SUMS = [("likes", "likes_count"), ("views", "views_count"), ("reposts", "reposts_count"),
         ("comments", "comments_count")]


def topic_stats(posts: DataFrame, topics: list[str] | None = None) -> DataFrame:
    """A7 (accumulator variant): rows, distinct authors with a missing author counted as
    one value, sums.  With ``topics`` every searched topic gets a row, zeros if empty (P11).

    What is shuffled is a row per topic and block of 512 author ids (a bit each, in eight words), not
    one per topic and author; exact for any BIGINT."""
    at = F.col("author_id").bitwiseAND(F.lit(64 * _WORDS - 1))
    bit = F.expr("shiftleft(1L, CAST(author_id & 63 AS INT))")
    words = [f"w{i}" for i in range(_WORDS)]
    blocks = posts.groupBy("university", F.shiftright("author_id", _BLOCK_BITS).alias("block")).agg(
        F.count(F.lit(1)).alias("n"), *[F.sum(c).alias(c) for c, _ in _SUMS],
        *[F.bit_or(F.when(F.shiftright(at, 6) == i, bit)).alias(w) for i, w in enumerate(words)])
    there = [F.coalesce(F.bit_count(w), F.lit(0)) for w in words]
    authors = F.sum(functools.reduce(Column.__add__, there)) + F.max(F.when(F.col("block").isNull(), 1).otherwise(0))
    stats = blocks.groupBy("university").agg(
        F.sum("n").cast("long").alias("posts_count"), authors.cast("long").alias("authors_count"), *_state_sums())
    if topics is None:
        return stats
    tdf = small_literal_frame(posts.sparkSession, [(t,) for t in dict.fromkeys(topics)],
                              "university string")
    filled = tdf.join(stats, "university", "left")
    return filled.na.fill(0, [c for c in filled.columns if c != "university"])


def topic_stats_frame(posts: DataFrame) -> DataFrame:
    """A8 (frame variant): ``count(post_id)`` and distinct non-null authors; sorted by topic."""
    return (posts.groupBy("university").agg(
        F.count("post_id").cast("long").alias("posts_count"),
        F.count_distinct("author_id").cast("long").alias("authors_count"),
        *[F.coalesce(F.sum(c), F.lit(0)).cast("long").alias(a) for c, a in _SUMS])
        .orderBy("university"))


def overall_stats(posts: DataFrame) -> DataFrame:
    """All rows (a post found for two topics counts twice) and distinct authors over
    all topics (missing author is one value)."""
    return posts.agg(F.count(F.lit(1)).cast("long").alias("total_posts"),
                     _set_size(F.col("author_id")).alias("unique_authors"))


# --- A7 / A8 / A9 / A11 from one mergeable state --------------------------------------------------
#: Authors of one bitmap (fixed by the bitmap functions).
_AUTHORS = 32768
_MONTH, _TOPIC, _ALL = "month", "topic", "all"


def mention_state(posts: DataFrame, year: int, now: dt.datetime | None = None) -> DataFrame:
    """What all statistics of ``posts`` need, from one scan and one shuffle (``GROUPING SETS``):
    ``(level, university, month, bucket, n, ids, likes, views, reposts, comments, authors)``.

    * level ``month``: rows of a topic by month of ``year`` (0: inside the period, outside the year);
    * level ``topic``: rows, sums and authors of a topic, by bucket of 32768 author ids;
    * level ``all``: the same over all topics.

    ``authors`` is a bitmap of the bucket's ids, exact for any BIGINT; rows without an author are
    in the NULL bucket.  States of parts of the posts add up (:func:`merged_states`), distinct
    authors included, so a report of many days needs no post read twice.  A bitmap is 4 KB: where
    author ids are sparse (few to a bucket), :func:`topic_stats` moves less."""
    s, e = year_bounds(year, now)
    month = F.when(in_period(F.col("date"), s, e), F.when(F.year("date") == year, F.month("date")).otherwise(0))
    rows = posts.select("university", month.alias("month"), F.shiftright("author_id", 15).alias("bucket"),
                        F.col("author_id").bitwiseAND(F.lit(_AUTHORS - 1)).alias("_at"), "post_id", *[c for c, _ in _SUMS])
    sets = [["university", "month"], ["university", "bucket"], ["bucket"]]
    grouped = rows.groupingSets([[F.col(c) for c in x] for x in sets], "university", "month", "bucket")
    level = F.grouping_id()      # of (university, month, bucket): 1 where a column is rolled up
    return grouped.agg(
        F.when(level == 0b001, _MONTH).when(level == 0b010, _TOPIC).otherwise(_ALL).alias("level"),
        F.count(F.lit(1)).alias("n"), F.count("post_id").alias("ids"),
        *[F.sum(c).cast("long").alias(c) for c, _ in _SUMS],
        F.bitmap_construct_agg("_at").alias("authors")).withColumn(
            "authors", F.when(F.col("level") != _MONTH, F.col("authors"))).select(*STATE_COLUMNS)


STATE_COLUMNS = ["level", "university", "month", "bucket", "n", "ids", "likes", "views", "reposts", "comments", "authors"]


def merged_states(states: DataFrame) -> DataFrame:
    """States of several parts of the posts (their union) as the state of all."""
    return states.groupBy("level", "university", "month", "bucket").agg(
        *[F.sum(c).cast("long").alias(c) for c in ("n", "ids", "likes", "views", "reposts", "comments")],
        F.bitmap_or_agg("authors").alias("authors")).select(*STATE_COLUMNS)


def _authors(with_null: bool) -> Column:
    """Distinct authors over the buckets of a group; a missing author is one more, if asked."""
    ids = F.coalesce(F.sum(F.bitmap_count("authors")), F.lit(0))
    return (ids + F.max(F.when(F.col("bucket").isNull(), 1).otherwise(0)) if with_null else ids).cast("long")


def _state_sums() -> list[Column]:
    return [F.coalesce(F.sum(c), F.lit(0)).cast("long").alias(a) for c, a in _SUMS]


def topic_stats_of(state: DataFrame) -> DataFrame:
    """A7 from a state: as :func:`topic_stats`."""
    return state.where(F.col("level") == _TOPIC).groupBy("university").agg(
        F.sum("n").cast("long").alias("posts_count"), _authors(True).alias("authors_count"), *_state_sums())


def topic_stats_frame_of(state: DataFrame) -> DataFrame:
    """A8 from a state: as :func:`topic_stats_frame`."""
    return (state.where(F.col("level") == _TOPIC).groupBy("university").agg(
        F.sum("ids").cast("long").alias("posts_count"), _authors(False).alias("authors_count"), *_state_sums())
        .orderBy("university"))


def overall_stats_of(state: DataFrame) -> DataFrame:
    """A9 from a state: as :func:`overall_stats`."""
    return state.where(F.col("level") == _ALL).agg(
        F.coalesce(F.sum("n"), F.lit(0)).cast("long").alias("total_posts"), _authors(True).alias("unique_authors"))


def monthly_matrix_of(state: DataFrame) -> DataFrame:
    """A11 from a state: as :func:`monthly_matrix`."""
    months = state.where((F.col("level") == _MONTH) & F.col("month").isNotNull())
    return months.groupBy("university").agg(*[
        F.coalesce(F.sum(F.when(F.col("month") == m, F.col("n"))), F.lit(0)).cast("long").alias(name)
        for m, name in enumerate(MONTH_NAMES, start=1)])


# --- A10: daily series, zero-filled on the union of dates ---------------------------------------
def daily_counts(posts: DataFrame, topics: list[str] | None = None) -> DataFrame:
    """``(university, day 'yyyy-MM-dd', n)``: every topic gets every day on which any topic
    has a post (days nobody posted on stay absent), sorted by topic and day.

    Counts are aggregated first; the set of days is a one-row subquery (bounded by the
    calendar) that every topic is spread over.  A post without a date is on no day.  Without a
    topic list a NULL topic is a topic like any other; a topic list names the topics kept."""
    dated = posts.where(F.col("date").isNotNull())
    if topics is not None:
        dated = dated.where(F.array_contains(topic_array(topics), F.col("university")))
    per = dated.groupBy("university", F.date_format("date", "yyyy-MM-dd").alias("day")).agg(
        F.count(F.lit(1)).alias("n"))
    days = per.select(F.sort_array(F.collect_set("day"))).scalar()
    names = (per.select("university").distinct() if topics is None else
             small_literal_frame(posts.sparkSession, [(t,) for t in dict.fromkeys(topics)], "university string"))
    grid = names.select(F.col("university").alias("_topic"), F.explode(days).alias("_day"))
    same = F.col("university").eqNullSafe(F.col("_topic")) & (F.col("day") == F.col("_day"))
    return (grid.join(per, same, "left")
            .select(F.col("_topic").alias("university"), F.col("_day").alias("day"),
                    F.coalesce(F.col("n"), F.lit(0)).cast("long").alias("n"))
            .orderBy("university", "day"))


# --- A11: monthly matrix ---------------------------------------------------------------------------
def monthly_matrix(posts: DataFrame, year: int, now: dt.datetime | None = None) -> DataFrame:
    """Wide ``(university, January .. December)``: posts of ``year`` per month, 0 where none.
    A topic with fetched posts (inside the period) keeps its row even if all counts are 0."""
    s, e = year_bounds(year, now)
    fetched = posts.filter(in_period(F.col("date"), s, e))
    in_year = F.year("date") == year
    return fetched.groupBy("university").agg(*[
        F.count_if(in_year & (F.month("date") == m)).cast("long").alias(name)
        for m, name in enumerate(MONTH_NAMES, start=1)])


def monthly_long(matrix: DataFrame) -> DataFrame:
    """Long form ``(university, month 1..12, n)`` of the matrix, zeros included."""
    pairs = F.array(*[F.struct(F.lit(m).alias("month"), F.col(name).alias("n"))
                      for m, name in enumerate(MONTH_NAMES, start=1)])
    return matrix.select("university", F.inline(pairs))


# --- P7 --------------------------------------------------------------------------------------------
PUBLICATION_COLUMNS = ["university", "date", "text", "likes", "views", "reposts", "comments", "post_url"]


def publications(posts: DataFrame) -> DataFrame:
    return posts.select(*PUBLICATION_COLUMNS)
