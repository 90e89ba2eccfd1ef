import random

import pyarrow as pa

from quarry.llm.common import hash_sample, per_worker, slices


def test_slices_hold_every_row_once_and_follow_the_limit():
    for seed in range(100):
        r = random.Random(seed)
        texts = [None if r.random() < 0.1 else "é" * r.randint(0, 9) for _ in range(r.randint(0, 40))]
        batch = pa.record_batch({"text": pa.array(texts, pa.string()), "n": pa.array(range(len(texts)), pa.int64())})
        out = list(slices(batch, limit=20))
        assert [x for s in out for x in s.column("n").to_pylist()] == list(range(len(texts)))
        assert all(s.num_rows == 1 or sum(len((t or "").encode()) for t in s.column("text").to_pylist()) <= 20 for s in out)


def test_per_worker_makes_once():
    made = []
    for _ in range(3):
        assert per_worker("key-of-this-test", lambda: made.append(1) or len(made)) == 1


def test_hash_sample_is_the_same_for_any_partitioning(spark):
    df = spark.range(5000).withColumnRenamed("id", "k")
    a, b = (sorted(r["k"] for r in hash_sample(df.repartition(n), "k", 500, 5000).collect()) for n in (1, 7))
    assert a == b and 350 < len(a) < 650
    assert hash_sample(df, "k", 5000, 5000).count() == 5000
