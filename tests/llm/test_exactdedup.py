import hashlib
import re

from pyspark.sql import functions as F

from quarry.llm import exactdedup as xd
from quarry.llm.common import join_split


def brute(rows):
    """rows: (doc_id, text) -> {(doc_id, keep_id, size, kept, sha): count}"""
    groups = {}
    for i, t in rows:
        groups.setdefault(re.sub(r"[\x20\x09-\x0D]+", " ", t or ""), []).append(i)
    out = []
    for text, ids in groups.items():
        ids.sort(key=lambda i: (i is None, i or 0))
        sha = hashlib.sha256(text.encode()).hexdigest()
        out += [(i, ids[0], len(ids), at == 0, sha) for at, i in enumerate(ids)]
    return sorted(out, key=repr)


def found(df):
    cols = ["doc_id", "keep_id", "group_size", "kept", "text_sha256"]
    got = xd.duplicates(df, digests=True)
    assert got.columns == cols
    return sorted((tuple(r) for r in got.collect()), key=repr)


CASES = [(0, "a b"), (1, "a  b"), (2, "a\t\n b"), (3, " a b"), (4, "a b"), (5, None), (6, ""), (7, " "),
         (8, "\x0b\x0c"), (9, "a\x1cb"), (10, "A b"), (None, "a b"), (None, "lone"), (None, "pair"), (None, "pair"),
         (3, " a b"), (3, " a b"), (12, "x" * 200 + "1"), (13, "x" * 200 + "2"), (11, "x" * 200 + "1"),
         (14, "é" * 100), (15, "é" * 100), (16, "word " * 400_000), (17, "word  " * 400_000), (18, "word " * 399_999 + "work ")]


def test_equals_brute_force(spark):
    assert found(spark.createDataFrame(CASES, "doc_id long, text string").repartition(5)) == brute(CASES)


def test_a_group_of_a_third_of_the_rows(spark):
    rows = [(i, "hot  text" if i % 3 == 0 else f"text {i // 2 * (i % 2)}") for i in range(3000)]
    assert found(spark.createDataFrame(rows, "doc_id long, text string").repartition(9)) == brute(rows)


def test_empty_table(spark):
    assert found(spark.createDataFrame([], "doc_id long, text string")) == []


def test_a_full_hash_only_where_length_and_prefix_meet(spark):
    rows = [(0, "one"), (1, "four"), (2, "five"), (3, "same"), (4, "same"), (5, "p" * 64 + "x"), (6, "p" * 64 + "y")]
    got = xd.duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {r["doc_id"] for r in got if r["text_sha256"]} == {3, 4, 5, 6}
    assert {r["doc_id"]: r["group_size"] for r in got} == {0: 1, 1: 1, 2: 1, 3: 2, 4: 2, 5: 1, 6: 1}


def test_full_bit_tables_change_no_result(spark, monkeypatch):
    monkeypatch.setattr(xd, "MAX_BITS", 1)       # the least table: many keys meet in a bit
    rows = [(i, f"text {i % 4000}") for i in range(6000)]
    assert found(spark.createDataFrame(rows, "doc_id long, text string")) == brute(rows)


def test_keep_first_returns_whole_rows(spark):
    df = spark.createDataFrame([(2, "a b", 1, "x"), (1, "a  b", 2, "y"), (3, "c", 3, "z"), (4, None, 4, None)],
                               "doc_id long, text string, kept int, _text string")
    kept = xd.keep_first(df)
    assert kept.columns == df.columns
    assert sorted(r["kept"] for r in kept.collect()) == [2, 3, 4]


def test_join_split_equals_a_plain_join(spark):
    rows = spark.range(5000).select(F.when(F.col("id") % 2 == 0, 0).otherwise(F.col("id") % 700).alias("k"), "id")
    side = spark.range(0, 700, 3).select(F.col("id").alias("k"), (F.col("id") * 7).alias("v"))
    want = sorted(map(tuple, rows.join(side, "k", "left").collect()), key=repr)
    assert sorted(map(tuple, join_split(rows, side, ["k"], 16).collect()), key=repr) == want
