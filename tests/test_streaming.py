import json
import os
import tempfile

from quarry.operators.mentions import flatten_items
from quarry.sources.landed import page_items, read_landed_pages
from quarry.streaming.landed_stream import start_ingest


def _land(d, name, lines):
    with open(os.path.join(d, name), "w") as f:
        f.write("\n".join(lines) + "\n")


def test_stream_ingest_matches_batch(spark):
    root = tempfile.mkdtemp(prefix="quarry-stream-")
    landing = os.path.join(root, "landing")
    os.mkdir(landing)
    page = lambda q, ids: json.dumps({"query": q, "items": [{"id": i, "owner_id": 1, "date": 100 + i} for i in ids]})
    _land(landing, "p1.json", [page("A", [1, 2]), "oops"])
    qs = start_ingest(spark, landing, os.path.join(root, "posts"), os.path.join(root, "rejects"),
                      os.path.join(root, "ckpt"))
    for q in qs:
        q.awaitTermination(120)
    _land(landing, "p2.json", [page("B", [3]),
                               json.dumps({"query": "C", "items": [{"id": 4, "owner_id": 1}, {"id": 5, "likes": 7}]})])
    qs = start_ingest(spark, landing, os.path.join(root, "posts"), os.path.join(root, "rejects"),
                      os.path.join(root, "ckpt"))
    for q in qs:
        q.awaitTermination(120)
    got = sorted((r["university"], r["post_id"]) for r in spark.read.parquet(os.path.join(root, "posts")).collect())
    pages, _ = read_landed_pages(spark, landing)
    want = sorted((r["university"], r["post_id"]) for r in flatten_items(page_items(pages)).collect())
    assert got == want == [("A", 1), ("A", 2), ("B", 3), ("C", 4)]
    rejects = [r["raw"] for r in spark.read.parquet(os.path.join(root, "rejects")).collect()]
    assert sorted(rejects, key=len) == ["oops", '{"id":5,"likes":7}']
