import datetime as dt
import json

from pyspark.sql import functions as F

from quarry.operators import mentions as mx
from quarry.operators.topk import top_k_per_group
from quarry.sources import landed, report

POST_COLS = ("university string, post_id long, owner_id long, author_id long, date timestamp_ntz, "
             "text string, likes long, views long, reposts long, comments long, post_url string")


def _post(u, pid, author, day, likes=1):
    d = dt.datetime(2024, 1, day, 12, 0, 0)
    return (u, pid, 10, author, d, "t", likes, 2, 3, 4, f"{mx.POST_URL_PREFIX}10_{pid}")


def test_flatten_defaults_and_rejects(spark):
    lines = [
        json.dumps({"query": "U", "items": [
            {"id": 1, "owner_id": -5, "from_id": 7, "date": 86400, "text": "x",
             "likes": {"count": 3}, "views": {"count": 9}, "reposts": {"count": 1}, "comments": {"count": 2}},
            {"id": 2, "owner_id": -5},
            {"id": 9, "owner_id": 4, "likes": 5},
            {"owner_id": 4}]}),
        "{not json",
        json.dumps({"query": "V", "items": []}),
    ]
    pages, rejects = landed.parse_pages(spark.createDataFrame([(s,) for s in lines], "value string"))
    assert [r["raw"] for r in rejects.collect()] == ["{not json"]
    bad_items = landed.item_rejects(pages).collect()
    assert [(r["topic"], json.loads(r["raw"])["id"]) for r in bad_items] == [("U", 9)]
    posts = {r["post_id"]: r for r in mx.flatten_items(landed.page_items(pages)).collect()}
    assert len(posts) == 3
    p1, p2, p3 = posts[1], posts[2], posts[None]
    assert p1["author_id"] == 7 and p1["date"] == dt.datetime(1970, 1, 2) and p1["views"] == 9
    assert p2["author_id"] == -5 and p2["text"] == "" and p2["likes"] == 0 and p2["date"] == dt.datetime(1970, 1, 1)
    assert p2["post_url"] == mx.POST_URL_PREFIX + "-5_2"
    assert p3["post_url"] == mx.POST_URL_PREFIX + "4_"


def test_stats_null_author_variants(spark):
    rows = [_post("A", 1, 5, 1), _post("A", 2, None, 1), _post("A", 3, 5, 2), _post("B", 4, 6, 3)]
    posts = spark.createDataFrame(rows, POST_COLS)
    a7 = {r["university"]: r for r in mx.topic_stats(posts, ["A", "B", "C"]).collect()}
    a8 = {r["university"]: r for r in mx.topic_stats_frame(posts).collect()}
    assert a7["A"]["authors_count"] == 2 and a8["A"]["authors_count"] == 1
    assert a7["A"]["posts_count"] == 3 and a7["A"]["likes_count"] == 3
    assert a7["C"]["posts_count"] == 0 and "C" not in a8
    overall = mx.overall_stats(posts).first()
    assert overall["total_posts"] == 4 and overall["unique_authors"] == 3


def test_daily_zero_fill(spark):
    rows = [_post("A", 1, 5, 1), _post("A", 2, 5, 1), _post("B", 3, 6, 3)]
    posts = spark.createDataFrame(rows, POST_COLS)
    got = sorted(tuple(r) for r in mx.daily_counts(posts, ["A", "B", "C"]).collect())
    assert got == [("A", "2024-01-01", 2), ("A", "2024-01-03", 0), ("B", "2024-01-01", 0),
                   ("B", "2024-01-03", 1), ("C", "2024-01-01", 0), ("C", "2024-01-03", 0)]


def test_monthly_and_periods(spark):
    rows = [_post("A", 1, 5, 1), _post("A", 2, 5, 31)]
    posts = spark.createDataFrame(rows, POST_COLS)
    m = mx.monthly_matrix(posts, 2024).first()
    assert m["January"] == 2 and m["February"] == 0
    long = mx.monthly_long(mx.monthly_matrix(posts, 2024)).collect()
    assert len(long) == 12 and sum(r["n"] for r in long) == 2
    s, e = mx.recent_bounds(dt.datetime(2024, 1, 20, 8, 30, 15, 999))
    assert (s, e) == (dt.datetime(2024, 1, 14, 8, 30, 15), dt.datetime(2024, 1, 19, 8, 30, 15))
    assert mx.year_bounds(2024, dt.datetime(2024, 3, 1, 1, 2, 3))[1] == dt.datetime(2024, 3, 1, 1, 2, 3)
    assert mx.year_bounds(2023, dt.datetime(2024, 3, 1))[1] == dt.datetime(2023, 12, 31, 23, 59, 59)


def test_search_and_cap(spark):
    rows = [("A", i, 1, 1, dt.datetime(2024, 1, 1) + dt.timedelta(hours=i), "the cat" if i % 2 else "a dog",
             0, 0, 0, 0, "") for i in range(40)]
    posts = spark.createDataFrame(rows, POST_COLS)
    found = mx.search_mentions(posts, ["cat", "dog", "zzz"], cap=5).collect()
    by = {}
    for r in found:
        by.setdefault(r["university"], []).append(r["post_id"])
    assert sorted(by["cat"], reverse=True) == [39, 37, 35, 33, 31]
    assert sorted(by["dog"], reverse=True) == [38, 36, 34, 32, 30]
    assert "zzz" not in by
    assert mx.search_mentions(posts, ["ca"], whole_token=True).count() == 0
    assert mx.search_mentions(posts, ["cat", "the", "x"], whole_token=True).count() == 40
    assert mx.search_mentions(posts, ["cat", "dog"]).count() == 40      # no cap unless asked for


def test_salted_top_k_equals_plain(spark):
    df = spark.range(0, 5000).select((F.col("id") % 3).alias("g"), F.col("id"),
                                     (F.col("id") * 7919 % 1000).alias("v")).repartition(16)
    order = [F.col("v").desc(), F.col("id").asc()]
    a = top_k_per_group(df, ["g"], order, 25, salt_buckets=4)
    b = top_k_per_group(df, ["g"], order, 25, salt_buckets=1)
    assert sorted(map(tuple, a.collect())) == sorted(map(tuple, b.collect()))


def test_report_empty_writes_nothing(spark, tmp_path):
    empty = spark.createDataFrame([], POST_COLS)
    assert report.write_report(empty, str(tmp_path / "r"), 2024) == {}
    rows = [_post("A", 1, 5, 1)]
    paths = report.write_report(spark.createDataFrame(rows, POST_COLS), str(tmp_path / "r2"), 2024)
    topics = spark.read.parquet(paths[report.SHEET_TOPICS])
    assert topics.columns == report.TOPIC_HEADERS


def test_search_of_long_topic_lists_and_odd_posts(spark):
    rows = [("A", 2 ** 53 + 1, 1, None, dt.datetime(2500, 1, 1), "w7 w8", 0, 0, 0, 0, ""),
            ("A", 2, 1, 1, dt.datetime(2024, 1, 1), None, 0, 0, 0, 0, "")]
    posts = spark.createDataFrame(rows, POST_COLS).withColumn("topic", F.lit("mine"))
    few = mx.search_mentions(posts, ["w7", "w9", ""]).collect()
    many = mx.search_mentions(posts, [f"w{i}" for i in range(5000)] + ["", "w7"]).collect()
    assert sorted((r["university"], r["post_id"]) for r in few) == [("", 2 ** 53 + 1), ("w7", 2 ** 53 + 1)]
    assert sorted((r["university"], r["post_id"], r["topic"]) for r in many) == [
        ("", 2 ** 53 + 1, "mine"), ("w7", 2 ** 53 + 1, "mine"), ("w8", 2 ** 53 + 1, "mine")]


def test_top_k_of_ties_is_the_same_for_any_partitioning(spark):
    day = dt.datetime(2024, 1, 1)
    rows = [("-", 7, i % 50, i, day, "cat", i % 3, 0, 0, 0, "") for i in range(4000)]
    posts = spark.createDataFrame(rows, POST_COLS)
    got = [sorted((r["owner_id"], r["author_id"]) for r in mx.search_mentions(posts.repartition(n), ["cat"], cap=5).collect())
           for n in (1, 3, 9)]
    assert got[0] == got[1] == got[2] and len(got[0]) == 5


def test_daily_counts_of_awkward_topics(spark):
    rows = [_post("the", 1, 5, 1), _post("The", 2, 5, 1), _post("_day", 3, 6, 3), _post(None, 4, 7, 5), _post("a`b", 6, 1, 3)]
    rows.append(("the", 9, 10, 5, None, "t", 1, 2, 3, 4, ""))
    posts = spark.createDataFrame(rows, POST_COLS)
    days = ["2024-01-01", "2024-01-03", "2024-01-05"]
    want = {"the": [1, 0, 0], "The": [1, 0, 0], "_day": [0, 1, 0], None: [0, 0, 1], "a`b": [0, 1, 0]}
    got = sorted((tuple(r) for r in mx.daily_counts(posts).collect()), key=repr)
    assert got == sorted(((u, d, n) for u, ns in want.items() for d, n in zip(days, ns)), key=repr)
    listed = [tuple(r) for r in mx.daily_counts(posts, ["the", "none"]).collect()]
    assert listed == [("none", days[0], 0), ("the", days[0], 1)]
    many = mx.daily_counts(posts, [f"t{i}" for i in range(12000)] + ["the"])
    assert many.count() == 12001


def test_capped_search_ranks_without_the_text(spark):
    when = dt.datetime(2024, 1, 1)
    posts = spark.createDataFrame(
        [(i % 3, i % 2, when, f"the {i}") for i in range(12)] + [(9, None, when, None)],
        "post_id long, owner_id long, date timestamp_ntz, text string")
    kept = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "100")        # both ranking levels
    try:
        top = mx.search_mentions(posts, ["the"], cap=5)
        assert top.columns == ["university", "post_id", "owner_id", "date", "text"]
        plan = top.select("university", "post_id")._jdf.queryExecution().optimizedPlan().toString()
        assert plan.count("Window [") == 2 and plan.count("xxhash64(") == 1     # hashed below, not at each level
        assert [(r.post_id, r.owner_id) for r in top.collect()] == [(0, 0), (0, 0), (0, 1), (0, 1), (1, 0)]
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", kept)


def test_topic_stats_moves_blocks_of_authors(spark):
    edge = [0, 1, 63, 64, 511, 512, 513, -1, -64, -513, 2**63 - 1, -2**63, 7, 7, None, None]
    when = dt.datetime(2024, 1, 1)
    rows = [(t, i, 1, a, when, "x", i, None, 1, 0, "u") for t in ("a", None) for i, a in enumerate(edge)]
    rows += [("b", 1, 1, a, when, "x", 1, 1, 1, 1, "u") for a in range(512)]
    stats = mx.topic_stats(spark.createDataFrame(rows, POST_COLS))
    got = {r["university"]: tuple(r)[1:] for r in stats.collect()}
    mixed = (len(edge), len({*edge}), sum(range(len(edge))), 0, len(edge), 0)
    assert got == {"a": mixed, None: mixed, "b": (512, 512, 512, 512, 512, 512)}
    # a row per topic and block crosses the first exchange: its keys do not hold the author
    plan = stats._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(university" in plan and not any(
        "author_id" in line for line in plan.splitlines() if "hashpartitioning(" in line)
