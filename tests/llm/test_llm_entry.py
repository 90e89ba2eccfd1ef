import duckdb
import pytest

import __spark_entry__ as entry
import corpus_pipeline
from quarry.llm import catalog, langid, quality, simhash, toxicity
from quarry.llm.common import id_remainder, table

SF = "/root/testdata/sf0.001"
TABLES = "documents embeddings pages benchmark labels conversations".split()


def test_registered():
    names = entry.queries()
    assert [n for n in names if n.startswith("op")] == list(catalog.all_queries()) and "pipeline" in names
    assert [n.split("_")[0] for n in catalog.all_queries()] == [f"op{i}" for i in range(1, 14)]


@pytest.mark.parametrize("name", sorted(catalog.all_oracles()))
def test_oracles(spark, name):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    df = entry.queries()[name](spark, SF)
    rel = con.sql(entry.oracle_sql()[name])
    order = sorted(df.columns)
    assert order == sorted(rel.columns)
    want = sorted((tuple(r[rel.columns.index(c)] for c in order) for r in rel.fetchall()), key=repr)
    assert sorted((tuple(r[c] for c in order) for r in df.collect()), key=repr) == want


def test_pipeline_stages_take_effect(spark, tmp_path):
    docs = table(spark, SF, "documents")
    extra = [(900001, None, "en", "x", 0), (900002, "123", "en", "x", 3)]
    docs = docs.unionByName(spark.createDataFrame(extra, docs.schema))
    kept = {}
    now = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, now, SF)
        assert out.columns == docs.columns
        out.write.parquet(str(tmp_path / name))
        now = spark.read.parquet(str(tmp_path / name))
        kept[name] = {r["doc_id"] for r in now.select("doc_id").collect()}
    every = {r["doc_id"] for r in docs.select("doc_id").collect()}
    assert every - kept["language_id"] >= {900001, 900002}
    # near copies: one document of each component of what the stage was given
    given = spark.read.parquet(str(tmp_path / "quality_classifier"))
    comp = {r["doc_id"]: r["component_id"] for r in simhash.near_duplicates(given).collect()}
    assert kept["simhash_near_dedup"] == set(comp.values())
    # benchmark text: what the operator reports of the stage's input is gone, nothing else
    from quarry.llm import decontaminate

    given = spark.read.parquet(str(tmp_path / "simhash_near_dedup"))
    hit = {r["doc_id"] for r in decontaminate.contamination(given, table(spark, SF, "benchmark")).collect() if r["n_hit"]}
    assert hit and kept["benchmark_decontamination"] == kept["simhash_near_dedup"] - hit
    packed = corpus_pipeline.STAGES[-1][1](spark, now, SF)
    assert {r["doc_id"] for r in packed.select("doc_id").collect()} == kept["benchmark_decontamination"]


def test_run_equals_its_stages(spark, tmp_path):
    now = table(spark, SF, "documents")
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, now, SF).write.parquet(str(tmp_path / name))
        now = spark.read.parquet(str(tmp_path / name))
    columns = ["doc_id", "piece", "start", "length", "ids_crc32"]      # sequence numbers may be any
    want = sorted(map(tuple, now.select(columns).collect()))
    assert want and sorted(map(tuple, corpus_pipeline.run(spark, SF).select(columns).collect())) == want


def test_training_uses_only_its_fold(spark):
    """Texts and labels of held-out documents do not change a prediction."""
    docs, labels = table(spark, SF, "documents"), table(spark, SF, "labels")
    from pyspark.sql import functions as F

    held = id_remainder("doc_id", 3) == 1
    other = docs.withColumn("lang", F.when(held, "zz").otherwise(F.col("lang")))
    a, b = (langid.train(d.where(id_remainder("doc_id", 3) != 1)) for d in (docs, other))
    assert a.langs == b.langs and (a.weight == b.weight).all()
    flipped = labels.withColumn("quality", F.when(id_remainder("doc_id", 4) == 2, 1 - F.col("quality")).otherwise(F.col("quality")))
    x, y = (toxicity.labelled_texts(docs, lab, "quality", id_remainder("doc_id", 4) != 2, quality.SAMPLE) for lab in (labels, flipped))
    assert sorted(r["doc_id"] for r in x.collect()) == sorted(r["doc_id"] for r in y.collect())
