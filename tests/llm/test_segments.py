import numpy as np
from pyspark.sql import functions as F

from quarry.llm import segments


def brute(rows, k, is_query):
    """rows: {id: integer list}; exact scores in Python integers."""
    out = []
    for q, a in rows.items():
        if is_query(q):
            s = sorted((-sum(x * y for x, y in zip(a, b)), c) for c, b in rows.items() if c != q)
            out += [(q, i + 1, c, -n) for i, (n, c) in enumerate(s[:k])]
    return sorted(out)


def found(spark, data, k=10, **kw):
    df = spark.createDataFrame(data, "vec_id long, embedding array<float>")
    top = segments.top_k(segments.integer_vectors(df), F.col("vec_id") % 3 == 0, k, **kw)
    assert top.dtypes == [("query_id", "bigint"), ("rank", "int"), ("vec_id", "bigint"), ("score", "bigint")]
    return sorted(tuple(r) for r in top.collect())


def test_equals_brute_force_with_ties_over_many_blocks(spark):
    rng = np.random.default_rng(3)
    base = rng.normal(0, 0.2, (12, 24)).astype(np.float32)
    data = [(i, [float(x) for x in base[i % 12] + (i % 5 == 0) * rng.normal(0, 0.05, 24).astype(np.float32)])
            for i in range(150)]
    ints = {i: [int(np.floor(1024 * np.float64(np.float32(x)))) for x in v] for i, v in data}
    want = brute(ints, 10, lambda q: q % 3 == 0)
    for kw in ({}, {"block_rows": 20, "seed_rows": 8}, {"block_rows": 1000, "seed_rows": 150},
               {"block_rows": 9, "seed_rows": 4, "cell_rows": 20}, {"block_rows": 50, "cell_rows": 3}):
        assert found(spark, data, **kw) == want


def test_unusable_short_repeated_and_unequal_vectors(spark):
    data = [(0, [1.0, 2.0]), (0, [1.0, 2.0]), (1, None), (2, [1.0, None]), (4, [float("nan"), 1.0]),
            (5, [float("inf")]), (None, [1.0, 1.0]), (6, [0.5]), (7, []), (8, [-1.0, 1.0, 4.0])]
    usable = {0: [1024, 2048, 0], 6: [512, 0, 0], 7: [0, 0, 0], 8: [-1024, 1024, 4096]}
    assert found(spark, data) == brute(usable, 10, lambda q: q % 3 == 0)


def test_empty_table(spark):
    assert found(spark, []) == []


def test_large_components_are_scored_exactly(spark):
    data = [(i, [float(2 ** 21 + i), float(2 ** 20 - i), 3.0]) for i in range(30)]
    ints = {i: [int(np.floor(1024 * np.float64(np.float32(x)))) for x in v] for i, v in data}
    assert found(spark, data, 5) == brute(ints, 5, lambda q: q % 3 == 0)


def test_lower_bounds_hold():
    rng = np.random.default_rng(0)
    m = rng.integers(-500, 500, (40, 64))
    for s in segments.statistics(m):
        assert ((s @ s.T) + 1e-6 >= (m @ m.T)).all()


def clustered(n, groups, dims=32):
    rng = np.random.default_rng(5)
    centre = rng.normal(0, 1, (groups, dims))
    centre /= np.linalg.norm(centre, axis=1, keepdims=True)
    return [(i, [float(x) for x in np.float32(centre[i % groups] + rng.normal(0, 0.02, dims))]) for i in range(n)]


def test_queries_are_sent_only_to_blocks_that_may_hold_a_result(spark):
    data = clustered(1200, 30)
    vectors = segments.integer_vectors(spark.createDataFrame(data, "vec_id long, embedding array<float>"))
    is_query, k = F.col("vec_id") % 10 == 0, 5
    index = segments.Index(vectors, 40, 100, 10)
    queries = index.first_queries(is_query, k)
    near = index.searched(queries, k)
    sent = index.other_queries(segments.raised(queries, near, k)).count()
    blocks = int(index.boxes.blocks.sum())
    assert index.rows.select("block").distinct().count() == blocks > 30
    assert sent < 0.2 * 120 * blocks
    ints = {i: [int(np.floor(1024 * np.float64(np.float32(x)))) for x in v] for i, v in data}
    top = segments.top_k(vectors, is_query, k, 40, 100, 10)
    assert sorted(tuple(r) for r in top.collect()) == brute(ints, k, lambda q: q % 10 == 0)


def test_a_third_of_the_rows_alike(spark):
    data = [(i, [1.0, 0.5, 0.0] if i % 3 == 0 else [i / 90.0, -0.5, 0.25]) for i in range(120)]
    ints = {i: [int(np.floor(1024 * np.float64(np.float32(x)))) for x in v] for i, v in data}
    assert found(spark, data, 4, block_rows=8, seed_rows=6, cell_rows=10) == brute(ints, 4, lambda q: q % 3 == 0)


def test_box_bounds_hold_for_every_member():
    rng = np.random.default_rng(1)
    m, queries = rng.integers(-500, 500, (60, 32)), rng.integers(-900, 900, (20, 32))
    stats = np.concatenate(segments.statistics(m), axis=1)
    cell = np.arange(60) % 4
    low, high = (np.array([f(stats[cell == c], axis=0) for c in range(4)]) for f in (np.min, np.max))
    boxes = segments.Boxes(np.arange(4), np.full(4, 15), np.full(4, 500.0), low, high, 15)
    best = np.array([[(m[cell == c] @ q).max() for c in range(4)] for q in queries])
    assert (boxes.bounds(queries) >= best).all()
