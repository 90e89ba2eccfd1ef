"""Session helpers: building a session, the checkpoint folder and size-checked broadcasts."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile

from pyspark.sql import DataFrame, SparkSession

# Largest side we hand to broadcast() when its size is known on the driver (bytes).
BROADCAST_LIMIT_BYTES = 64 * 1024 * 1024


def build_session(master: str | None = None, shuffle_partitions: int | None = None,
                  app_name: str = "quarry") -> SparkSession:
    """A session configured the way the library expects (UTC, AQE on, UI off).

    On a cluster, leave ``master`` unset and let spark-submit decide.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    local = bool(master and master.startswith("local"))
    builder = (
        builder.config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    if shuffle_partitions or local:      # else what the cluster configures
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions or os.cpu_count() or 8))
    if local:
        builder = builder.config("spark.driver.memory", "16g")
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("WARN")
    ship_package(spark)
    return spark


_SHIPPED: dict[str, str] = {}


def ship_package(spark: SparkSession) -> None:
    """Make ``quarry`` importable in the Python workers (the ``--py-files`` mechanism):
    the package is zipped once per SparkContext and registered with ``addPyFile``, so
    Arrow-batched steps work whatever the driver's working directory is."""
    try:
        sc = spark.sparkContext
    except Exception:  # remote session: the server side must provide the package
        return
    key = sc.applicationId
    if key in _SHIPPED:
        return
    import quarry

    pkg_dir = os.path.dirname(os.path.abspath(quarry.__file__))
    target = os.path.join(tempfile.mkdtemp(prefix="quarry-pyfiles-"), "quarry.zip")
    with zipfile.ZipFile(target, "w", zipfile.ZIP_DEFLATED) as z:
        for root, _dirs, files in os.walk(pkg_dir):
            for name in files:
                if name.endswith(".py"):
                    full = os.path.join(root, name)
                    z.write(full, os.path.join("quarry", os.path.relpath(full, pkg_dir)))
    sc.addPyFile(target)
    _SHIPPED[key] = target


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder for checkpoints and written intermediate tables.

    Taken from ``spark.checkpoint.dir`` (or the one already set on the context).  Where it is
    unset, a folder below the warehouse, which is shared too.
    """
    try:
        sc = spark.sparkContext
    except Exception:  # remote session: the server owns the checkpoint folder
        return spark.conf.get("spark.checkpoint.dir", None) or ""
    current = sc._jsc.sc().getCheckpointDir()
    if current.isDefined():
        return current.get()
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        configured = f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/scratch-{sc.applicationId}"
        _remove_at_end(spark, configured)
    sc.setCheckpointDir(configured)
    return sc._jsc.sc().getCheckpointDir().get()


def _remove_at_end(spark: SparkSession, folder: str) -> None:
    """Make ``folder`` and have it removed when the application ends."""
    sc = spark.sparkContext
    where = sc._jvm.org.apache.hadoop.fs.Path(folder)
    fs = where.getFileSystem(sc._jsc.hadoopConfiguration())
    fs.mkdirs(where)
    fs.deleteOnExit(where)      # has no effect on a folder that is not there yet


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared checkpoint folder for a written intermediate table,
    removed when the application ends."""
    root = checkpoint_root(spark).rstrip("/")
    if not root:
        raise RuntimeError("set spark.checkpoint.dir to a shared folder for written tables")
    try:
        root = f"{root}/scratch-{spark.sparkContext.applicationId}"
        _remove_at_end(spark, root)
    except Exception:  # remote session: the server owns its files
        pass
    return f"{root}/{name}-{uuid.uuid4().hex}"


def written(spark: SparkSession, df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared scratch folder and read back: computed once, and safe
    from the loss of an executor."""
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def stored_bytes(spark: SparkSession, path: str) -> int:
    """Bytes of the files below ``path`` on any Hadoop file system."""
    sc = spark.sparkContext
    where = sc._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(sc._jsc.hadoopConfiguration()).getContentSummary(where).getLength()


def small_literal_frame(spark: SparkSession, rows: list[tuple], schema: str) -> DataFrame:
    """A DataFrame from a driver-side parameter list (query terms, topics).  The rows are
    parallelised into tasks; whoever broadcasts it checks its size first
    (:func:`fits_broadcast`)."""
    return spark.createDataFrame(rows, schema)


def fits_broadcast(rows: list, limit: int = BROADCAST_LIMIT_BYTES) -> bool:
    return sum(len(repr(r)) for r in rows) <= limit
