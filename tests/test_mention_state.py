import datetime as dt
import random
import tempfile

import pytest
from pyspark.sql import functions as F

from quarry.operators import mentions as mx
from quarry.sources import report

POST_COLS = ("university string, post_id long, owner_id long, author_id long, date timestamp_ntz, "
             "text string, likes long, views long, reposts long, comments long, post_url string")


def posts_of(spark, n=400, seed=1):
    rng = random.Random(seed)
    far = [None, 0, 1, -1, 32767, 32768, -32768, -32769, 2 ** 62, -2 ** 62, 5]
    rows = [(rng.choice(["A", "B", "C", None]), rng.choice([i, None]), 1, rng.choice(far + list(range(20))),
             rng.choice([None, dt.datetime(2023, 12, 31, 23, 59, 59), dt.datetime(2024, 12, 31, 23, 59, 59, 999999),
                         dt.datetime(2024, rng.randint(1, 12), 3), dt.datetime(2025, 1, 1)]), f"t{i}",
             rng.choice([None, 1, 5]), 2, rng.choice([0, None]), 1, "u") for i in range(n)]
    rows += [("out", 1, 1, 1, dt.datetime(2022, 1, 1), "", 1, 1, 1, 1, ""),
             ("late", 1, 1, None, dt.datetime(2024, 12, 31, 23, 59, 59), "", None, None, None, None, "")]
    return spark.createDataFrame(rows, POST_COLS)


def same(a, b):
    assert a.columns == b.columns and [t for _, t in a.dtypes] == [t for _, t in b.dtypes]
    assert sorted(map(tuple, a.collect()), key=repr) == sorted(map(tuple, b.collect()), key=repr)


def check(posts, state, now=None):
    same(mx.topic_stats_of(state), mx.topic_stats(posts))
    same(mx.topic_stats_frame_of(state), mx.topic_stats_frame(posts))
    same(mx.overall_stats_of(state), mx.overall_stats(posts).na.fill(0))
    same(mx.monthly_matrix_of(state), mx.monthly_matrix(posts, 2024, now))


def test_state_gives_every_statistic(spark):
    posts = posts_of(spark)
    check(posts, mx.mention_state(posts, 2024))
    now = dt.datetime(2024, 6, 15, 12)
    check(posts, mx.mention_state(posts, 2024, now), now)


def test_states_of_parts_add_up(spark):
    posts = posts_of(spark, seed=3)
    part = F.pmod(F.xxhash64("text"), F.lit(3))
    states = [mx.mention_state(posts.where(part == i), 2024) for i in range(3)]
    check(posts, mx.merged_states(mx.merged_states(states[0].unionByName(states[1])).unionByName(states[2])))


def test_no_posts(spark, tmp_path):
    none = spark.createDataFrame([], POST_COLS)
    state = mx.mention_state(none, 2024)
    assert state.collect() == [] and mx.topic_stats_of(state).collect() == []
    assert tuple(mx.overall_stats_of(state).first())[0] == 0
    assert report.write_report(none, str(tmp_path / "r"), 2024) == {}


@pytest.mark.parametrize("fmt", ["parquet", "json"])
def test_report_from_one_state(spark, fmt):
    posts = posts_of(spark, 50)
    out = report.write_report(posts, tempfile.mkdtemp(prefix="quarry-report-"), 2024, fmt)
    got = spark.read.format(fmt).load(out[report.SHEET_TOPICS])
    assert {r[report.TOPIC_HEADERS[0]]: r[report.TOPIC_HEADERS[2]] for r in got.collect()} == {
        r["university"]: r["authors_count"] for r in mx.topic_stats_frame(posts).collect()}
    assert spark.read.format(fmt).load(out[report.SHEET_PUBLICATIONS]).count() == posts.count()


def test_one_scan_and_one_shuffle_make_the_state(spark, tmp_path):
    posts_of(spark).write.parquet(str(tmp_path / "p"))
    posts = spark.read.parquet(str(tmp_path / "p"))
    plan = mx.mention_state(posts, 2024)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and plan.count("Exchange") == 1 and plan.count("Expand") == 1
    assert "text" not in plan.split("ReadSchema")[1]
