import datetime as dt

import pytest
from pyspark.sql import functions as F

from quarry.operators import mentions as mx
from quarry.sources import posts_store as ps

COLS = "university string, post_id long, date timestamp_ntz, text string"


def posts_of(spark, days=20, seed=0):
    base = dt.datetime(2024, 1, 1)
    rows = [("A", i + 1000 * seed, base + dt.timedelta(days=i % days, hours=i % 24, microseconds=i), f"t{i}") for i in range(200)]
    return spark.createDataFrame(rows + [("A", -1 - seed, None, "undated"), ("B", -10 - seed, base, "edge")], COLS)


def rows(df):
    return sorted(map(tuple, df.select("university", "post_id", "date", "text").collect()), key=repr)


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("grain", ["day", "month"])
def test_periods_equal_filters_on_the_posts(spark, tmp_path, grain):
    posts = posts_of(spark, 500)
    path = ps.write_posts(posts, str(tmp_path / "p"), grain)
    assert rows(ps.read_posts(spark, path)) == rows(posts)
    for as_of in (dt.datetime(2024, 1, 20), dt.datetime(2024, 3, 3, 12, 30), dt.datetime(2023, 1, 1)):
        assert rows(ps.posts_recent(spark, path, as_of, grain)) == rows(mx.posts_recent(posts, as_of))
    for year, now in ((2024, None), (2025, None), (2024, dt.datetime(2024, 2, 10, 3)), (1999, None)):
        assert rows(ps.posts_in_year(spark, path, year, now, grain)) == rows(mx.posts_in_year(posts, year, now))


def test_only_the_period_is_read(spark, tmp_path):
    path = ps.write_posts(posts_of(spark), str(tmp_path / "p"))
    recent = ps.posts_recent(spark, path, dt.datetime(2024, 1, 20))
    assert "PartitionFilters: [isnotnull(period" in plan_of(recent)
    folders = {r[0].split("period=")[1][:10] for r in
               recent.select(F.input_file_name()).distinct().collect()}
    assert {f"2024-01-{d}" for d in range(15, 19)} <= folders <= {f"2024-01-{d}" for d in range(14, 20)}
    assert len(recent.inputFiles()) >= 20      # the table has more


def test_a_written_period_replaces_itself_only(spark, tmp_path):
    path = ps.write_posts(posts_of(spark), str(tmp_path / "p"))
    before = ps.read_posts(spark, path).count()
    again = posts_of(spark, seed=7).where(F.col("date").cast("date") == F.lit("2024-01-05").cast("date"))
    ps.write_posts(again, path)
    now = ps.read_posts(spark, path)
    assert now.count() == before
    assert {r["post_id"] >= 7000 for r in now.where("period = '2024-01-05'").collect()} == {True}
    assert now.where("period <> '2024-01-05' AND post_id >= 7000").count() == 0
    ps.write_posts(again, path)                # the same write twice changes nothing
    assert ps.read_posts(spark, path).count() == before


def test_unknown_grain(spark):
    with pytest.raises(ValueError):
        ps.write_posts(posts_of(spark), "/nowhere", "week")
