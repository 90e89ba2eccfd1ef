"""Persist the postings as Parquet clustered by term, and read them back."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from quarry.session import scratch_path, stored_bytes

# Bytes of postings per file of a stored index, about.
FILE_BYTES = 128 << 20


def write_index(spark: SparkSession, post: DataFrame, path: str | None = None,
                partitions: int | None = None) -> str:
    """Range-partitioned and sorted by ``(term, doc_id)``, with a Parquet bloom filter on
    ``term``: a lookup ``term = q`` opens the file or few files whose range holds ``q``, and a
    very frequent term spans several files.

    The postings are written once as they come, so the range bounds are sampled from stored
    rows (the texts are tokenised once) and the number of files follows their size."""
    path = path or scratch_path(spark, "index")
    staged = scratch_path(spark, "postings")
    post.select("term", "doc_id", "tf").write.parquet(staged)
    n = partitions or max(spark.sparkContext.defaultParallelism, -(-stored_bytes(spark, staged) // FILE_BYTES))
    (spark.read.parquet(staged).repartitionByRange(n, "term", "doc_id").sortWithinPartitions("term", "doc_id")
     .write.mode("overwrite")
     .option("parquet.bloom.filter.enabled#term", "true")
     .parquet(path))
    return path


def read_index(spark: SparkSession, path: str) -> DataFrame:
    """Lazy read; filters on ``term`` reach the scan."""
    return spark.read.parquet(path)
