import os
import subprocess
import sys
import time

from quarry import session

REPO = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def test_scratch_follows_the_configured_folder(spark):
    root = session.checkpoint_root(spark)
    assert session.scratch_path(spark, "x").startswith(root.rstrip("/") + "/scratch-")
    df = session.written(spark, spark.range(5), "y")
    assert sorted(r["id"] for r in df.collect()) == [0, 1, 2, 3, 4]
    assert session.stored_bytes(spark, df.inputFiles()[0]) > 0


def test_scratch_without_a_folder_is_below_the_warehouse_and_removed(tmp_path):
    code = (
        "import sys, os; sys.path.insert(0, %r)\n"
        "from pyspark.sql import SparkSession\n"
        "s = (SparkSession.builder.master('local[1]').config('spark.ui.enabled', 'false')\n"
        "     .config('spark.sql.warehouse.dir', %r).getOrCreate())\n"
        "from quarry import session\n"
        "path = session.scratch_path(s, 'z')\n"
        "s.range(3).write.parquet(path)\n"
        "print('AT', path, s.read.parquet(path).count())\n" % (REPO, str(tmp_path / "wh")))
    (tmp_path / "conf").mkdir()
    out = subprocess.run([sys.executable, "-c", code], cwd=str(tmp_path), capture_output=True, text=True, timeout=300,
                         env=os.environ | {"SPARK_CONF_DIR": str(tmp_path / "conf")})
    at = next(line.split() for line in out.stdout.splitlines() if line.startswith("AT"))
    path = "/" + at[1].split(":", 1)[1].lstrip("/")
    assert path.startswith(str(tmp_path / "wh")) and at[2] == "3"
    for _ in range(60):          # the JVM ends a little after its parent
        if not os.path.exists(path):
            break
        time.sleep(0.5)
    assert not os.path.exists(path)
