"""S7 fed incrementally: new landed page files in a folder are parsed, flattened (P1) and
appended to a Parquet table of flat posts; bad lines go to a rejects table.  The batch
statistics then read that table.  Progress lives in the checkpoint location, so a restarted
or failed query resumes without duplicating rows (file sink, exactly once)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from quarry.operators.mentions import flatten_items
from quarry.sources.landed import item_rejects, page_items, parse_pages


def flat_posts_stream(spark: SparkSession, landing_dir: str, max_files_per_trigger: int = 1000) -> tuple[DataFrame, DataFrame]:
    lines = (spark.readStream.format("text")
             .option("maxFilesPerTrigger", max_files_per_trigger).load(landing_dir))
    pages, line_rejects = parse_pages(lines)
    rejects = line_rejects.unionByName(item_rejects(pages).select("raw"))
    return flatten_items(page_items(pages)), rejects


def start_ingest(spark: SparkSession, landing_dir: str, posts_path: str, rejects_path: str,
                 checkpoint_dir: str, available_now: bool = True) -> list[StreamingQuery]:
    """Start the two append-only sinks; ``available_now`` processes what has landed and stops."""
    posts, rejects = flat_posts_stream(spark, landing_dir)
    queries = []
    for df, path, name in ((posts, posts_path, "posts"), (rejects, rejects_path, "rejects")):
        w = (df.writeStream.format("parquet").outputMode("append")
             .option("path", path).option("checkpointLocation", f"{checkpoint_dir.rstrip('/')}/{name}"))
        w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="1 minute")
        queries.append(w.start())
    return queries
