import pickle
import random

from pyspark.sql import functions as F

from quarry.functions import text as tx
from quarry.operators import ids as idops
from quarry.operators import index as ix
from quarry.sources import corpus as src
from quarry.sources import index_store


def read_gamma(bits):
    """(value, rest): as many zeros as digits follow the first one; a lone 0 is 0."""
    if bits == "0":
        return 0, ""
    zeros = bits.index("1")
    return int(bits[zeros:2 * zeros + 1], 2), bits[2 * zeros + 1:]


def read_delta(bits):
    if bits == "0":
        return 0
    length, rest = read_gamma(bits)
    assert len(rest) == length - 1
    return int("1" + rest, 2)


def lists(df, col="doc_ids"):
    return {r["term"]: list(r[col]) for r in df.collect()}


def test_build_index_golden(spark, corpus4):
    got = lists(ix.posting_blocks(ix.postings(corpus4)))
    assert got == {"декан": [0, 1], "студент": [0], "факультет": [0],
                   "преподаватель": [1, 2], "экзамен": [2]}


def test_duplicates_kept_in_lists(spark):
    df = spark.createDataFrame([(0, "a a b"), (1, "a")], "doc_id long, text string")
    got = lists(ix.posting_blocks(ix.postings(df)))
    assert got == {"a": [0, 0, 1], "b": [0]}
    codes = lists(ix.posting_blocks(ix.postings(df), compressed=True), "codes")
    assert codes["a"] == ["0", "0", "1"]


def test_search_hit_and_miss(spark, corpus4):
    post = ix.postings(corpus4)
    hit = ix.search(spark, post, "декан", compressed=False).collect()
    assert [list(r["results"]) for r in hit] == [[0, 1]] and hit[0]["count"] == 2
    miss = ix.search(spark, post, "аспирант", compressed=False).collect()
    assert len(miss) == 1 and list(miss[0]["results"]) == [] and miss[0]["count"] == 0
    multi = ix.search(spark, post, "декан студент", compressed=False).collect()
    assert multi[0]["count"] == 0
    codes = ix.search(spark, post, "декан", compressed=True).collect()
    assert list(codes[0]["results"]) == ["0", "1"]


def test_search_corpus_matches_index_search(spark, corpus4):
    a = ix.search_corpus(spark, corpus4, ["декан", "экзамен", "нет"], compressed=False)
    b = ix.search(spark, ix.postings(corpus4), ["декан", "экзамен", "нет"], compressed=False)
    norm = lambda df: sorted((r["term"], tuple(r["results"]), r["count"]) for r in df.collect())
    assert norm(a) == norm(b)


def test_delta_codes_golden(spark):
    df = spark.range(0, 6).select(tx.elias_delta("id").alias("c"))
    assert [r["c"] for r in df.collect()] == ["0", "1", "0100", "0101", "01100", "01101"]


def test_codes_decode_to_their_numbers(spark):
    vals = list(range(0, 5000)) + [2 ** k + d for k in range(1, 62) for d in (-1, 0, 1)]
    df = spark.createDataFrame([(v,) for v in vals], "n long").select(
        "n", tx.elias_gamma("n").alias("g"), tx.elias_delta("n").alias("d"),
        tx.elias_delta_length("n").alias("bits"))
    for r in df.collect():
        assert read_gamma(r["g"]) == (r["n"], "")
        assert read_delta(r["d"]) == r["n"] and r["bits"] == len(r["d"])


def test_sizes_golden(spark, corpus4):
    row = ix.evaluate(ix.postings(corpus4), "декан").collect()[0]
    sizes = ix.index_sizes(ix.postings(corpus4)).collect()[0]
    assert sizes["uncompressed_bytes"] == 91          # 20 + 17 + 17 + 20 + 17
    assert sizes["compressed_bytes"] == 1.625         # 13 bits
    assert abs(row["compression_ratio"] - 1.625 / 91) < 1e-15
    assert row["results_count"] == 2
    assert row["uncompressed_size_kb"] == 91 / 1024


def test_pickled_size_exact_for_large_lists(spark):
    random.seed(3)
    rows, expected = [], 0
    for t in range(6):
        n = random.choice([1, 2, 999, 1001, 30000, 70000])
        hi = random.choice([300, 70000, 2 ** 40])
        ids = sorted(random.randrange(hi) for _ in range(n))
        expected += len(pickle.dumps(ids, protocol=4))
        for i in ids:
            rows.append((f"t{t}", i))
    df = spark.createDataFrame(rows, "term string, doc_id long").groupBy("term", "doc_id").agg(
        F.count(F.lit(1)).alias("tf"))
    got = ix.index_sizes(df).collect()[0]["uncompressed_bytes"]
    assert got == expected


def test_frame_helper_against_pickle():
    random.seed(11)
    for _ in range(60):
        n = random.choice([13000, 21845, 21846, 40000, 100000])
        hi = random.choice([200, 60000, 2 ** 33])
        ids = sorted(random.randrange(hi) for _ in range(n))
        w = [2 if x < 256 else 3 if x < 65536 else 5 if x < 2 ** 31 else 3 + x.bit_length() // 8 for x in ids]
        counts = [sum(1 for v in w if v == c) for c in ix.WIDTH_CLASSES]
        got = ix._pickled_bytes_np(__import__("numpy").array([n]), __import__("numpy").array([sum(w)]),
                                   __import__("numpy").array([counts]))[0]
        assert got == len(pickle.dumps(ids, protocol=4))


def test_empty_corpus_and_empty_texts(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    r = ix.evaluate(ix.postings(empty), "x").collect()[0]
    assert r["uncompressed_size_kb"] == 0 and r["compression_ratio"] is None and r["results_count"] == 0
    blanks = spark.createDataFrame([(0, ""), (1, "  \t ")], "doc_id long, text string")
    assert ix.postings(blanks).count() == 0


def test_index_roundtrip_and_pushdown(spark, corpus4):
    post = ix.postings(corpus4)
    path = index_store.write_index(spark, post)
    back = index_store.read_index(spark, path)
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, post.collect()))
    plan = back.filter(F.col("term") == "декан")._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters" in plan and "декан" in plan


def test_dense_ids(spark):
    rows = [(k, (k * 7919) % 101) for k in range(500)]
    df = spark.createDataFrame(rows, "k long, g long")
    out = idops.dense_ids(df, ["g", "k"], "rid", partitions=7).collect()
    expected = {k: i for i, (g, k) in enumerate(sorted((g, k) for k, g in rows))}
    assert {r["k"]: r["rid"] for r in out} == expected


def test_replicate_corpus(spark, corpus4):
    rep = src.replicate_corpus(corpus4).collect()
    assert len(rep) == 24
    assert {r["doc_id"]: r["text"] for r in rep}[7] == "декан преподаватель"   # copy 1 of record 1
    assert src.replicate_corpus(corpus4, 1).count() == 4


def test_corpus_without_ids_gets_positions(spark, tmp_path):
    import pandas as pd
    d = tmp_path / "corpus"
    d.mkdir()
    pd.DataFrame({"text": [f"a{i}" for i in range(0, 700)]}).to_parquet(d / "part-0.parquet", row_group_size=100)
    pd.DataFrame({"text": [f"b{i}" for i in range(0, 300)]}).to_parquet(d / "part-1.parquet", row_group_size=70)
    got = {r["doc_id"]: r["text"] for r in src.read_corpus(spark, str(d), id_col=None).collect()}
    assert got == {i: (f"a{i}" if i < 700 else f"b{i - 700}") for i in range(1000)}


def test_text_corpus_without_ids_gets_positions(spark, tmp_path):
    d = tmp_path / "lines"
    d.mkdir()
    for k in range(3):
        (d / f"p{k}.txt").write_text("".join(f"f{k} line {i}\n" for i in range(400)))
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1500")
    try:
        df = src.read_corpus(spark, str(d), fmt="text", id_col=None, text_col="value")
        got = {r["doc_id"]: r["text"] for r in df.collect()}
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    assert got == {k * 400 + i: f"f{k} line {i}" for k in range(3) for i in range(400)}


def test_positions_hold_when_the_input_is_split_anew(spark, tmp_path):
    d = tmp_path / "lines"
    d.mkdir()
    for k in range(3):
        (d / f"p{k}.txt").write_text("".join(f"f{k} line {i}\n" for i in range(400)))
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "700")
    try:
        df = src.read_corpus(spark, str(d), fmt="text", id_col=None, text_col="value")
        for size in ("300", "5000", "100000"):      # executors come and go: other splits
            spark.conf.set("spark.sql.files.maxPartitionBytes", size)
            got = {r["doc_id"]: r["text"] for r in df.repartition(3).collect()}
            assert got == {k * 400 + i: f"f{k} line {i}" for k in range(3) for i in range(400)}
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)


def test_small_inputs_are_spread_and_large_ones_left(spark, monkeypatch):
    df = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
    assert "REPARTITION_BY_NUM" in src.spread(df, "doc_id")._jdf.queryExecution().executedPlan().toString()
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1000")
    try:
        assert src.spread(df, "doc_id") is df
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)


def test_positions_move_no_text(spark):
    df = src.read_corpus(spark, "/root/testdata/sf0.001/documents.parquet", id_col=None)
    assert "Exchange hashpartitioning" not in df._jdf.queryExecution().executedPlan().toString()


def test_search_plan_keeps_id_lists_apart(spark, corpus4):
    """No window, and nothing that holds id lists is shuffled on the term alone."""
    plan = ix.search(spark, ix.postings(corpus4), ["декан", "нет"])._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan and "SortMergeJoin" not in plan


def test_large_ids_stay_in_their_block(spark):
    ids = [2 ** 53 + 1, 2 ** 53 - 1, 2 ** 60 + 65535, 65536, 65535]
    post = spark.createDataFrame([("t", i, 1) for i in ids], "term string, doc_id long, tf long")
    assert {r["block"]: list(r["doc_ids"]) for r in ix.posting_blocks(post).collect()} == {i // 65536: [i] for i in ids}


def test_terms_beyond_the_broadcast_limit_are_looked_up_in_parts(spark, corpus4, monkeypatch):
    terms = ["декан", "нет", "экзамен", "студент"]
    norm = lambda df: sorted((r["term"], tuple(r["results"]), r["count"]) for r in df.collect())
    whole = norm(ix.search(spark, ix.postings(corpus4), terms))
    monkeypatch.setattr(ix, "BROADCAST_LIMIT_BYTES", 40)
    assert len(ix._term_chunks(terms)) > 1
    assert norm(ix.search(spark, ix.postings(corpus4), terms)) == whole


def test_search_many_terms_uses_join_path(spark):
    docs = spark.createDataFrame([(0, "alpha beta beta"), (1, "gamma alpha"), (2, "")], "doc_id long, text string")
    terms = ["alpha", "beta", "nope"] + [f"filler{i}" for i in range(1100)]
    assert len(terms) > ix.ISIN_LIMIT
    got = {r["term"]: (list(r["results"]), r["count"])
           for r in ix.search_corpus(spark, docs, terms, compressed=False).collect()
           if r["term"] in ("alpha", "beta", "nope")}
    assert got == {"alpha": ([0, 1], 2), "beta": ([0, 0], 2), "nope": ([], 0)}
    via_index = {r["term"]: r["count"] for r in ix.search(spark, ix.postings(docs), terms, compressed=False).collect()}
    assert via_index["alpha"] == 2 and via_index["filler7"] == 0 and len(via_index) == len(terms)
