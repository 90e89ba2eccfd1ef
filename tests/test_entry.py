import math

import duckdb
import pytest

import __spark_entry__ as entry
from quarry.plans import catalog

SF = "/root/testdata/sf0.001"
TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


def test_entry_smoke(spark):
    df = entry.entry(spark)
    rows = df.collect()
    assert len(rows) == 1 and set(df.columns) == {
        "uncompressed_size_kb", "compressed_size_kb", "compression_ratio", "results_count"}


def test_every_query_has_oracle():
    assert set(catalog.all_queries()) == set(catalog.all_oracles())
    assert set(catalog.all_queries()) <= set(entry.queries()) and set(entry.oracle_sql()) <= set(entry.queries())


def _norm(v):
    if isinstance(v, float):
        return round(v, 6)
    if hasattr(v, "isoformat"):
        return v.isoformat()
    return v


@pytest.mark.parametrize("name", sorted(catalog.all_queries()))
def test_query_matches_oracle(spark, name):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    df = entry.queries()[name](spark, SF)
    res = con.execute(entry.oracle_sql()[name])
    ocols = [d[0] for d in res.description]
    assert sorted(df.columns) == sorted(ocols)
    order = sorted(df.columns)
    a = sorted((tuple(_norm(r[c]) for c in order) for r in df.collect()), key=repr)
    idx = [ocols.index(c) for c in order]
    b = sorted((tuple(_norm(r[i]) for i in idx) for r in res.fetchall()), key=repr)
    assert a == b


@pytest.mark.parametrize("name", ["posts_recent", "posts_in_year", "monthly_matrix", "flatten_posts"])
def test_time_queries_ignore_session_zone(spark, name):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    old = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/Los_Angeles")
    try:
        df = entry.queries()[name](spark, SF)
        order = sorted(df.columns)
        a = sorted(tuple(str(r[c]) for c in order) for r in df.collect())
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
    res = con.execute(entry.oracle_sql()[name])
    cols = [d[0] for d in res.description]
    b = sorted(tuple(str(r[cols.index(c)]) for c in order) for r in res.fetchall())
    assert a == b


SPARK_TO_DUCK = {"bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "double": "DOUBLE",
                 "boolean": "BOOLEAN", "timestamp_ntz": "TIMESTAMP", "date": "DATE"}


def test_column_types_match_oracle(spark):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    bad = {}
    for name, q in catalog.all_queries().items():
        s = {f.name: SPARK_TO_DUCK.get(f.dataType.simpleString(), f.dataType.simpleString())
             for f in q(spark, SF).schema.fields}
        rel = con.sql(entry.oracle_sql()[name])
        d = {c: str(t) for c, t in zip(rel.columns, rel.types)}
        if s != d:
            bad[name] = (s, d)
    assert not bad


def test_python_steps_work_from_another_directory(tmp_path):
    """The driver may import the entry module from anywhere: Python workers must still
    import the package (it is shipped with addPyFile)."""
    import os
    import subprocess
    import sys
    repo = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    code = (
        "import sys; sys.path.insert(0, %r)\n"
        "from pyspark.sql import SparkSession\n"
        "s = SparkSession.builder.master('local[2]').config('spark.ui.enabled', 'false').getOrCreate()\n"
        "import __spark_entry__ as e\n"
        "print('ROWS', e.entry(s).count(), e.queries()['docx_text'](s, %r).count())\n" % (repo, SF))
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    out = subprocess.run([sys.executable, "-c", code], cwd=str(tmp_path), env=env,
                         capture_output=True, text=True, timeout=600)
    assert "ROWS 1 20" in out.stdout, out.stderr[-2000:]
