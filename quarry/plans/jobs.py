"""The public jobs (W1-W9): each chains operators into one lazy Spark plan (actions only
where a job writes or must decide on a count)."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.operators import documents as docs
from quarry.operators import index as ix
from quarry.operators import mentions as mx
from quarry.session import written
from quarry.sources import corpus as src
from quarry.sources import coded_index, index_store, report


# --- W1 / W2 / W3: index --------------------------------------------------------------------
def build_index(spark: SparkSession, corpus: DataFrame, path: str, replicate: int = 1,
                partitions: int | None = None) -> dict[str, str]:
    """Corpus -> ``path/postings`` (term, doc_id, tf; clustered by term and id), ``path/codes``
    (the compressed lists: blocks of Elias-delta codes in the same order), ``path/terms`` (per-term
    statistics and sizes) and ``path/totals`` (one row), so reports never rescan the postings.
    ``replicate`` repeats every record that many times (S3)."""
    root = path.rstrip("/")
    if replicate > 1:
        corpus = src.replicate_corpus(corpus, replicate)
    p_path = index_store.write_index(spark, ix.postings(corpus), f"{root}/postings", partitions)
    coded_index.write_codes(spark, index_store.read_index(spark, p_path), f"{root}/codes")
    stats = ix.term_size_stats(index_store.read_index(spark, p_path))
    ix.term_sizes(stats).write.mode("overwrite").parquet(f"{root}/terms")
    ix.size_totals(spark.read.parquet(f"{root}/terms")).write.mode("overwrite").parquet(f"{root}/totals")
    return {"postings": p_path, "codes": f"{root}/codes", "terms": f"{root}/terms", "totals": f"{root}/totals"}


def search_index(spark: SparkSession, path: str, term: str | list[str],
                 compressed: bool = True) -> tuple[DataFrame, DataFrame]:
    """Lookup on the stored index (``term = q`` pushed to the scan) and one evaluation row
    per term from the stored statistics (also pushed).  Compressed results are the codes as
    stored, ``(term, first_id, results, count)`` by block; otherwise ids, ``(term, block, part,
    results, count)``."""
    root = path.rstrip("/")
    terms = [term] if isinstance(term, str) else list(dict.fromkeys(term))
    sizes = spark.read.parquet(f"{root}/terms")
    if compressed:
        found = search_codes(spark, root, terms)
    else:
        found = ix.search(spark, index_store.read_index(spark, f"{root}/postings"), terms, compressed=False)
    totals = spark.read.parquet(f"{root}/totals").first()      # the one row of the index
    return found, ix.evaluate_terms(spark, sizes, totals, terms)


def search_codes(spark: SparkSession, path: str, terms: list[str], compressed: bool = True,
                 between: tuple[int, int] | None = None) -> DataFrame:
    """Lookup in the stored codes of an index: counts come from its statistics, lists from the
    bits of its blocks; with ``between`` only blocks whose header meets that range of ids."""
    root = path.rstrip("/")
    blocks = coded_index.of_terms(spark, spark.read.parquet(f"{root}/codes"), terms)
    counts = coded_index.of_terms(spark, spark.read.parquet(f"{root}/terms"), terms)
    return coded_index.search_blocks(spark, blocks, counts, terms, compressed, between)


def index_report(spark: SparkSession, corpus: DataFrame, term: str) -> DataFrame:
    """Build in memory and evaluate one term (sizes, ratio, result count)."""
    return ix.evaluate(ix.postings(corpus), term)


# --- W4 / W5 / W9: documents -------------------------------------------------------------------
def process_documents(spark: SparkSession, folder: str) -> DataFrame:
    """Every file of ``folder`` -> ``(filename, ext, status, text, links, error)``."""
    return docs.process_folder(spark, folder)


def extract_text(spark: SparkSession, file_path: str | list[str]) -> DataFrame:
    """One file (or several) -> one row each with its text (or the error).  Unlike the folder job, which
    skips a name without a handled suffix, asking for such a file is an error."""
    # a folder is read by its tasks; the caller's own list of files is Spark's to read
    files = (docs.scan_folder(spark, file_path) if isinstance(file_path, str)
             else spark.read.format("binaryFile").load(file_path))
    out = docs.process_files(files)
    unsupported = F.col("status") == "skipped"
    return out.select(
        "filename",
        F.when(unsupported, F.lit("error")).otherwise(F.col("status")).alias("status"),
        "text",
        F.when(unsupported, F.concat(F.lit("unsupported format: "), F.col("ext"))).otherwise(F.col("error"))
        .alias("error"))


def docx_text(spark: SparkSession, folder: str) -> DataFrame:
    """The DOCX files of ``folder`` -> text."""
    files = docs.scan_folder(spark, folder, glob=docs.ci_glob(".docx"))
    return docs.extract_docx(files)


# --- W6 / W7: mentions ----------------------------------------------------------------------
def mentions_recent(spark: SparkSession, posts: DataFrame, topics: list[str],
                    as_of: dt.datetime) -> dict[str, DataFrame]:
    """W6 (cursor variant): trailing five days, every topic kept (zeros if empty), daily
    series zero-filled.  The found posts are written once and read by both tables."""
    found = written(spark, mx.search_mentions(mx.posts_recent(posts, as_of), topics), "mentions")
    return {"stats": mx.topic_stats(found, topics), "daily": mx.daily_counts(found, topics)}


def mentions_year(spark: SparkSession, posts: DataFrame, topics: list[str], year: int,
                  now: dt.datetime | None = None, out_dir: str | None = None) -> dict:
    """W7 (offset variant): calendar year, year re-filter, topics without posts absent;
    optionally writes the four report tables.  All found posts count: the page limit of a
    remote search has no meaning over landed posts."""
    s, e = mx.year_bounds(year, now)
    found = mx.search_mentions(posts.filter(mx.in_period(F.col("date"), s, e)), topics)
    kept = written(spark, found.filter(F.year("date") == year), "mentions")
    state = written(spark, mx.mention_state(kept, year, now), "mention-state")      # one scan for all tables
    out = {"stats": mx.topic_stats_of(state), "overall": mx.overall_stats_of(state),
           "monthly": mx.monthly_matrix_of(state)}
    if out_dir:
        out["report"] = report.write_report(kept, out_dir, year)
    return out


# --- W8: text quality --------------------------------------------------------------------------
def text_quality(processed: DataFrame, threshold: float = 0.5) -> dict[str, DataFrame]:
    """Per-file non-ASCII ratio and flag, link presence and extraction coverage.  The files are
    extracted once: a few measures of each are written, and the three tables read these."""
    measures = written(processed.sparkSession, docs.file_measures(processed), "file-measures")
    return quality_tables(measures, threshold)


def quality_tables(measures: DataFrame, threshold: float = 0.5) -> dict[str, DataFrame]:
    """The tables of W8 from file measures, also those of earlier runs."""
    ok = measures.filter(F.col("status") == "ok")
    return {"ratio": ok.select("filename", "non_ascii_ratio", (F.col("non_ascii_ratio") > threshold).alias("flagged")),
            "links": docs.link_presence_of(measures),
            "coverage": docs.extraction_coverage_of(measures)}


def process_with_quality(spark: SparkSession, folder: str, path: str,
                         threshold: float = 0.5) -> tuple[DataFrame, dict[str, DataFrame]]:
    """W4 and W8 from one extraction: the processed files are written to ``path``, and texts and
    quality tables are read from there."""
    process_documents(spark, folder).write.mode("overwrite").parquet(path)
    processed = spark.read.parquet(path)
    return processed, quality_tables(docs.file_measures(processed), threshold)
