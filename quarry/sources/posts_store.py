"""Posts in a table partitioned by date, so that a period reads only its own folders.

The partition column ``period`` (DATE) is the day of the post, or the first day of its month; posts
without a date are in the null partition.  A write replaces the periods it holds and leaves the
others (dynamic partition overwrite), so a re-landed day can be written again.  A day with a large
share of the posts is split over several tasks and files (a rebalanced write).
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.operators import mentions as mx

PERIOD = "period"


def period_of(date: Column | str, grain: str = "day") -> Column:
    """First day of the ``grain`` (``day`` or ``month``) of a date."""
    column = F.col(date) if isinstance(date, str) else date
    return F.trunc(column.cast("date"), "month") if grain == "month" else column.cast("date")


def write_posts(posts: DataFrame, path: str, grain: str = "day", date_col: str = "date") -> str:
    if grain not in ("day", "month"):
        raise ValueError(f"no such grain: {grain}")
    (posts.withColumn(PERIOD, period_of(date_col, grain)).hint("rebalance", PERIOD)
     .write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(PERIOD).parquet(path))
    return path


def read_posts(spark: SparkSession, path: str) -> DataFrame:
    """All posts, with their ``period``."""
    posts = spark.read.parquet(path)
    return posts.withColumn(PERIOD, F.col(PERIOD).cast("date"))


def posts_recent(spark: SparkSession, path: str, as_of: dt.datetime, grain: str = "day") -> DataFrame:
    """P5 on the table: its five days are the only partitions read."""
    s, e = mx.recent_bounds(as_of)
    return mx.posts_recent(_of(spark, path, s, e, grain), as_of).drop(PERIOD)


def posts_in_year(spark: SparkSession, path: str, year: int, now: dt.datetime | None = None,
                  grain: str = "day") -> DataFrame:
    """P4 on the table."""
    s, e = mx.year_bounds(year, now)
    return mx.posts_in_year(_of(spark, path, s, e, grain), year, now).drop(PERIOD)


def _of(spark: SparkSession, path: str, start: dt.datetime, end: dt.datetime, grain: str) -> DataFrame:
    first = start.replace(day=1) if grain == "month" else start
    lo, hi = (F.lit(d.strftime("%Y-%m-%d")).cast("date") for d in (first, end))
    return read_posts(spark, path).where((F.col(PERIOD) >= lo) & (F.col(PERIOD) <= hi))
