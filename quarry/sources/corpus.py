"""Corpus scan, record positions as ids, replication."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.session import fits_broadcast, written

# Times every record of a replicated corpus is repeated, unless the caller says otherwise.
REPLICATION_FACTOR = 6


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def spread(df: DataFrame, key: str | None = None) -> DataFrame:
    """Spread a small input (one small file, one row group) so CPU-heavy per-row work runs in
    parallel; two partitions per core even out documents of very different lengths.  The
    planner's size estimate decides, without running anything; an input with a full split per
    core is returned unchanged (no shuffle)."""
    spark = df.sparkSession
    try:
        cores = spark.sparkContext.defaultParallelism
    except Exception:  # remote session: no plan at hand, leave the input as it is
        return df
    split = df._jdf.sparkSession().sessionState().conf().filesMaxPartitionBytes()
    size = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    if size >= cores * split:
        return df
    return df.repartition(2 * cores, key) if key else df.repartition(2 * cores)


def read_corpus(spark: SparkSession, path: str, fmt: str = "parquet",
                id_col: str | None = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id BIGINT, text STRING)``; only these two columns reach the scan.

    With ``id_col=None`` the ids are the 0-based positions of the records in corpus order:
    files by path, records by their place inside the file (S2).  Records are counted per file
    (Parquet) from metadata columns alone; the running offsets are joined back, so no text is
    shuffled.  Other formats have no row index: their records are tagged with file, block and place
    and written once, and counts and ids come from that table, so the tags agree however the
    input is split later."""
    df = spark.read.format(fmt).load(path)
    text = F.coalesce(F.col(text_col), F.lit("")).alias("text")
    if id_col is not None:
        return df.select(F.col(id_col).cast("long").alias("doc_id"), text)
    whole_file = fmt == "parquet"
    part = F.lit(0).cast("long") if whole_file else F.col("_metadata.file_block_start")
    # other formats have no row index: the scan's running id counts the records of a block
    place = F.col("_metadata.row_index") if whole_file else F.monotonically_increasing_id()
    rows = df.select(F.col("_metadata.file_path").alias("_file"), part.alias("_part"), place.alias("_row"), text)
    if not whole_file:
        rows = written(spark, rows, "corpus-rows")
    # one row per file or block: their order and running offsets are made on the driver
    counts = rows.groupBy("_file", "_part").agg(F.count(F.lit(1)).alias("n"), F.min("_row").alias("first")).collect()
    offsets, running = [], 0
    for r in sorted(counts, key=lambda r: (r["_file"], r["_part"])):
        offsets.append((r["_file"], r["_part"], running - r["first"]))
        running += r["n"]
    found = spark.createDataFrame(offsets, "_file string, _part long, _offset long")
    found = F.broadcast(found) if fits_broadcast(offsets) else found
    return rows.join(found, ["_file", "_part"]).select((F.col("_offset") + F.col("_row")).alias("doc_id"), "text")


def replicate_corpus(corpus: DataFrame, factor: int = REPLICATION_FACTOR) -> DataFrame:
    """S3: every record is repeated ``factor`` times in place; copy k of record i gets id
    ``factor*i + k``.  Ids must be dense (see S2)."""
    k = F.explode(F.sequence(F.lit(0), F.lit(factor - 1))).alias("k")
    return (corpus.select("*", k)
            .withColumn("doc_id", F.col("doc_id") * factor + F.col("k"))
            .drop("k"))
