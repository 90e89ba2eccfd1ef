import random

import pytest
from pyspark.sql import functions as F

from quarry.operators import topics as tp

TEXTS = ["the cat sat", "cat", " cat ", "concat the dog", "a.b a+b \\E x", "", None, "The CAT", "\x1ccat\x85end",
         "cats cat", "xcat catx cat", "new york city", "é É éé", "aaa", "тест текст"]
TOPICS = ["cat", "the", "", "a.b", "\\E", "a+b", "new york", "é", "aa", "текст", "cat", "zzz", " ", "dog", "(", "x"]


def brute(whole):
    out = []
    for i, x in enumerate(TEXTS):
        for t in set(TOPICS):
            if x is not None and (t in x.split() if whole else t in x):
                out.append((t, i))
    return sorted(out)


def found(spark, topics, whole):
    df = spark.createDataFrame(list(enumerate(TEXTS)), "post_id long, text string").withColumn("university", F.lit("-"))
    got = tp.match_topics(df, topics, whole)
    assert got.columns == ["university", "post_id", "text"]
    return sorted((r["university"], r["post_id"]) for r in got.collect())


@pytest.mark.parametrize("whole", [False, True])
@pytest.mark.parametrize("few", [0, 100])
def test_every_way_gives_the_same_rows(spark, monkeypatch, whole, few):
    monkeypatch.setattr(tp, "FEW_TOPICS", few)
    assert found(spark, TOPICS, whole) == brute(whole)


@pytest.mark.parametrize("whole", [False, True])
def test_lists_beyond_the_limits_are_searched_in_parts(spark, monkeypatch, whole):
    monkeypatch.setattr(tp, "FEW_TOPICS", 0)
    monkeypatch.setattr(tp, "AUTOMATON_BYTES", 150)
    monkeypatch.setattr(tp, "BROADCAST_LIMIT_BYTES", 150)
    assert len(tp._parts(TOPICS, 150)) > 3
    assert found(spark, TOPICS, whole) == brute(whole)


@pytest.mark.parametrize("limit", [64 << 20, 200])
def test_a_frame_of_topics(spark, monkeypatch, limit):
    monkeypatch.setattr(tp, "BROADCAST_LIMIT_BYTES", limit)
    frame = spark.createDataFrame([(t,) for t in TOPICS + [None]], "topic string")
    assert found(spark, frame, True) == brute(True)
    with pytest.raises(ValueError):
        tp.match_topics(spark.createDataFrame([("a",)], "text string"), frame)


def test_random_texts(spark, monkeypatch):
    rng = random.Random(6)
    texts = ["".join(rng.choice("ab \t ") for _ in range(30)) for _ in range(150)]
    topics = sorted({"".join(rng.choice("ab") for _ in range(rng.randint(1, 4))) for _ in range(40)})
    df = spark.createDataFrame(list(enumerate(texts)), "post_id long, text string")
    for whole in (False, True):
        want = sorted((t, i) for i, x in enumerate(texts) for t in topics if (t in x.split() if whole else t in x))
        for few in (0, 1000):
            monkeypatch.setattr(tp, "FEW_TOPICS", few)
            got = tp.match_topics(df, topics, whole).collect()
            assert sorted((r["university"], r["post_id"]) for r in got) == want


def test_a_long_list_is_not_tried_topic_by_topic(spark):
    posts = spark.createDataFrame([(1, "x")], "post_id long, text string")
    topics = [f"t{i}" for i in range(50_000)]
    tokens = tp.match_topics(posts, topics, True)._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in tokens and "hashpartitioning" not in tokens
    parts = tp.match_topics(posts, topics)._jdf.queryExecution().executedPlan().toString()
    assert "ArrowEvalPython" in parts and "Exchange" not in parts
