import numpy as np
import pytest
from pyspark.sql import functions as F

from quarry.functions import codes
from quarry.operators import index as ix
from quarry.sources import coded_index as ci
from quarry.sources import index_store


def delta(n):
    """Elias-delta as text; 0 is '0'."""
    if n == 0:
        return "0"
    b = bin(n)[2:]
    length = bin(len(b))[2:]
    return "0" * (len(length) - 1) + length + b[1:]


@pytest.mark.parametrize("lists", [
    [[0]], [[0, 0, 0, 1, 1, 2]], [[0, 1, 2, 3, 4, 5], [5], [0, 0], [7, 8, 2 ** 31, 2 ** 40, 2 ** 62]],
    [sorted(int(x) for x in np.random.default_rng(s).integers(0, 2 ** (3 * s + 1), 400)) for s in range(1, 18)]])
def test_streams_hold_the_codes_one_after_another(lists):
    ids = np.array([i for x in lists for i in x], np.int64)
    starts = np.cumsum([0] + [len(x) for x in lists])[:-1]
    data, first, bits = codes.pack(ids, starts)
    for k, want in enumerate(lists):
        stream = data[first[k]:first[k + 1]].tobytes()
        text = "".join(map(delta, want))
        assert bits[k] == len(text)
        assert bin(int.from_bytes(b"\x01" + stream, "big"))[3:][:bits[k]] == text
        assert codes.unpack(stream, len(want), want.count(0)) == (want, [delta(i) for i in want])


def postings_of(spark, rows):
    return spark.createDataFrame(rows, "term string, doc_id long, tf long")


ROWS = ([("hot", i, 1 + i % 3) for i in range(500)] + [("deep", 7, 1000), ("deep", 8, 1), ("deep", 9, 130)]
        + [(f"t{i}", i * 1000, 1) for i in range(50)] + [("é ", 0, 4)])


def entries(rows):
    return sorted((t, i) for t, i, n in rows for _ in range(n))


@pytest.mark.parametrize("size", [1, 7, 64, ci.ENTRIES])
def test_no_block_is_larger_and_together_they_are_the_list(spark, size):
    path = index_store.write_index(spark, postings_of(spark, ROWS), partitions=3)
    blocks = ci.coded_blocks(index_store.read_index(spark, path), size)
    rows = blocks.collect()
    assert max(r["n"] for r in rows) <= size
    lists = sorted((tuple(r) for r in ci.decoded(blocks).collect()), key=lambda r: r[:3])
    got = {}
    for term, first, last, ids, found in lists:
        assert (ids[0], ids[-1]) == (first, last) and found == [delta(i) for i in ids]
        got.setdefault(term, []).extend(ids)
    want = {}
    for t, i in entries(ROWS):
        want.setdefault(t, []).append(i)
    assert got == want


@pytest.mark.parametrize("size", [1, 7, 64, 65536])
def test_posting_rows_are_bounded_and_together_they_are_the_list(spark, size):
    parts = ix.posting_blocks(postings_of(spark, ROWS + [("hot", 70_000, 2)]), entries=size).collect()
    assert max(r["n"] for r in parts) <= size and all(len(r["doc_ids"]) == r["n"] for r in parts)
    got = {}
    for r in sorted(parts, key=lambda r: (r["term"], r["block"], r["part"])):
        got.setdefault(r["term"], []).extend(r["doc_ids"])
    want = {}
    for t, i in entries(ROWS + [("hot", 70_000, 2)]):
        want.setdefault(t, []).append(i)
    assert got == want
    if size == 65536:
        assert all(r["part"] == 0 for r in parts)


def test_search_reads_codes_and_skips_by_header(spark):
    path = index_store.write_index(spark, postings_of(spark, ROWS), partitions=2)
    blocks = ci.coded_blocks(index_store.read_index(spark, path), 64)
    counts = spark.createDataFrame([("hot", 999), ("deep", 1131)], "term string, n long")
    found = ci.search_blocks(spark, ci.of_terms(spark, blocks, ["hot", "none"]), counts, ["hot", "none"])
    rows = found.collect()
    assert sorted(c for r in rows if r["term"] == "hot" for c in r["results"]) == sorted(
        delta(i) for t, i in entries(ROWS) if t == "hot")
    assert [(r["results"], r["count"], r["first_id"]) for r in rows if r["term"] == "none"] == [([], 0, None)]
    some = ci.search_blocks(spark, ci.of_terms(spark, blocks, ["hot"]), counts, ["hot"], False, (100, 120)).collect()
    assert sorted(i for r in some for i in r["results"]) == [i for t, i in entries(ROWS) if t == "hot" and 100 <= i <= 120]
    assert blocks.where((F.col("term") == "hot") & ci.in_ids((100, 120))).count() < 4


def test_empty_index_and_negative_ids(spark):
    path = index_store.write_index(spark, postings_of(spark, []))
    assert ci.coded_blocks(index_store.read_index(spark, path)).collect() == []
    bad = ci.coded_blocks(postings_of(spark, [("a", -1, 1)]))
    with pytest.raises(Exception, match="negative ids have no code"):
        bad.collect()


def plan_of(df):
    df.collect()
    jvm = df.sparkSession._jvm
    return jvm.org.apache.spark.sql.api.python.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")


def test_bucketed_table_prunes_buckets_and_joins_without_a_shuffle(spark):
    path = index_store.write_index(spark, postings_of(spark, ROWS), partitions=3)
    blocks = ci.coded_blocks(index_store.read_index(spark, path), 64)
    name = ci.save_bucketed(blocks, 8)
    one = plan_of(ci.bucketed_counts(spark, name, ["deep"]))
    assert "SelectedBucketsCount: 1 out of 8" in one and "Exchange" not in one
    found = ci.search_bucketed(spark, name, ["deep", "none"], compressed=False).collect()
    assert sorted(i for r in found for i in r["results"]) == [i for t, i in entries(ROWS) if t == "deep"]
    assert {r["term"]: r["count"] for r in found} == {"deep": 1131, "none": 0}

    many = ci.bucketed_terms(spark, name, [f"t{i}" for i in range(0, 5000, 2)])
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        counted = ci.bucketed_counts(spark, name, many)
        plan = plan_of(counted)
        assert "SortMergeJoin" in plan and "Exchange" not in plan
        assert {r["term"]: r["n"] for r in counted.collect()} == {f"t{i}": 1 for i in range(0, 50, 2)}
        long = ci.search_bucketed(spark, name, [f"t{i}" for i in range(0, 3000, 2)])
        assert sum(r["count"] for r in long.collect()) == 25
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
