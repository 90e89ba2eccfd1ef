"""The compressed index on disk, and search over it.

A posting list is stored as blocks ``(term, first_id, last_id, n, zeros, bits, code)``: ``code`` holds
the Elias-delta codes of the block's ids, packed to bits, one per occurrence; the columns before it
are its skip header.  A block has at most ``ENTRIES`` occurrences, however frequent the term and
however often one document repeats it: the postings come sorted, and a task cuts a list wherever its
running count is full (and where its input ends), so there is no window over a term.  The blocks of a
term, by ``(first_id, last_id)``, hold the list in order; concatenated they are the whole list.

Two layouts: files range-clustered like the postings they are made from (no shuffle; a frequent term
spans several files), or a catalog table bucketed by term (one term reads one bucket; a long list of
terms is joined bucket by bucket, without a shuffle).
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarry.functions import codes
from quarry.operators.index import ISIN_LIMIT, _term_chunks
from quarry.session import scratch_path, ship_package, small_literal_frame

#: Occurrences of a block at most.
ENTRIES = 16384
#: Occurrences coded at once.
_HELD = 1 << 18
BLOCK_SCHEMA = "term string, first_id long, last_id long, n long, zeros long, bits long, code binary"


# --- coding ---------------------------------------------------------------------------------------
def _expanded(batch: pa.RecordBatch, held: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Row numbers and ids of a batch, one per occurrence, at most ``held`` at a time."""
    ids, tf = batch.column("doc_id").to_numpy(), batch.column("tf").to_numpy().astype(np.int64)
    if len(ids) and ids.min() < 0:
        raise ValueError("negative ids have no code")
    ends = np.cumsum(tf)
    total = int(ends[-1]) if len(ends) else 0
    if 0 < total <= held:
        rows = np.repeat(np.arange(len(ids)), tf)
        yield rows, ids[rows]
        return
    for at in range(0, total, held):
        rows = np.searchsorted(ends, np.arange(at, min(at + held, total)), "right")
        yield rows, ids[rows]


def _coded(batches: Iterator[pa.RecordBatch], entries: int, held: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        term = batch.column("term").dictionary_encode().indices.to_numpy()
        for rows, ids in _expanded(batch, held):
            own = term[rows]
            begin = np.flatnonzero(np.r_[True, (own[1:] != own[:-1]) | (ids[1:] < ids[:-1])])
            place = np.arange(len(ids)) - np.repeat(begin, np.diff(np.append(begin, len(ids))))
            starts = np.flatnonzero(place % entries == 0)
            ends = np.append(starts[1:], len(ids))
            data, first_byte, bits = codes.pack(ids, starts)
            stream = pa.Array.from_buffers(pa.large_binary(), len(starts), [
                None, pa.py_buffer(first_byte.astype(np.int64).tobytes()), pa.py_buffer(data.tobytes())])
            yield pa.RecordBatch.from_arrays(
                [batch.column("term").take(pa.array(rows[starts])), pa.array(ids[starts]), pa.array(ids[ends - 1]),
                 pa.array(ends - starts), pa.array(np.add.reduceat((ids == 0).astype(np.int64), starts)),
                 pa.array(bits), stream.cast(pa.binary())],
                ["term", "first_id", "last_id", "n", "zeros", "bits", "code"])


def coded_blocks(post: DataFrame, entries: int = ENTRIES) -> DataFrame:
    """Blocks of postings ``(term, doc_id, tf)`` that come sorted by ``(term, doc_id)`` in each
    partition (:func:`quarry.sources.index_store.write_index`).  No shuffle."""
    ship_package(post.sparkSession)
    held = max(_HELD // entries, 1) * entries
    return post.select("term", "doc_id", F.col("tf").cast("long").alias("tf")).mapInArrow(
        lambda it: _coded(it, entries, held), BLOCK_SCHEMA)


def _decoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ends = np.cumsum(batch.column("n").to_numpy())
        at = 0
        while at < batch.num_rows:      # a quarter of the ids coded at once, or one block
            stop = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + _HELD // 4, "right")))
            part = batch.slice(at, stop - at)
            at = stop
            found = [codes.unpack(*x) for x in zip(part.column("code").to_pylist(), part.column("n").to_pylist(),
                                                   part.column("zeros").to_pylist())]
            yield pa.RecordBatch.from_arrays(
                [part.column("term"), part.column("first_id"), part.column("last_id"),
                 pa.array([i for i, _ in found], pa.list_(pa.int64())),
                 pa.array([c for _, c in found], pa.list_(pa.string()))],
                ["term", "first_id", "last_id", "doc_ids", "codes"])


def decoded(blocks: DataFrame) -> DataFrame:
    """``(term, first_id, last_id, doc_ids, codes)`` read from the stored bits, a row per block."""
    ship_package(blocks.sparkSession)
    return blocks.select("term", "first_id", "last_id", "n", "zeros", "code").mapInArrow(
        _decoded, "term string, first_id long, last_id long, doc_ids array<long>, codes array<string>")


# --- search ---------------------------------------------------------------------------------------
def in_ids(between: tuple[int, int] | None) -> Column:
    """Blocks that may hold an id of the range (both ends included), by the skip header alone."""
    return F.lit(True) if between is None else (F.col("last_id") >= between[0]) & (F.col("first_id") <= between[1])


def _asked(spark: SparkSession, terms: list[str]) -> DataFrame:
    return small_literal_frame(spark, [(t,) for t in dict.fromkeys(terms)], "term string")


def search_blocks(spark: SparkSession, found: DataFrame, counts: DataFrame, terms: list[str],
                  compressed: bool = True, between: tuple[int, int] | None = None) -> DataFrame:
    """A5 over stored blocks of the asked terms: ``(term, first_id, results, count)``, one row per block
    with its codes as stored (or its ids), and one with an empty list for an absent term.  ``counts``
    is ``(term, n)``, a row per found term, and is broadcast to the blocks in parts within the limit, so
    the lists of a frequent term are never brought together.  ``between`` limits the ids: only
    blocks that may hold some are read."""
    lists = decoded(found.where(in_ids(between)))
    if between is not None:
        inside = F.filter(F.arrays_zip("doc_ids", "codes"),
                          lambda x: (x["doc_ids"] >= between[0]) & (x["doc_ids"] <= between[1]))
        lists = lists.withColumn("_in", inside).withColumns(
            {"doc_ids": F.col("_in.doc_ids"), "codes": F.col("_in.codes")}).where(F.size("_in") > 0)
    results = F.col("codes" if compressed else "doc_ids")
    empty = F.array().cast(T.ArrayType(T.StringType() if compressed else T.LongType()))
    lists = lists.select("term", "first_id", results.alias("results"))
    out = None
    for part in _term_chunks(list(dict.fromkeys(terms))):
        asked = _asked(spark, part).join(counts.select("term", F.col("n").alias("count")), "term", "left")
        there = lists.join(F.broadcast(asked), "term").select("term", "first_id", "results", "count")
        absent = asked.where("count IS NULL").select(
            "term", F.lit(None).cast("long").alias("first_id"), empty.alias("results"),
            F.lit(0).cast("long").alias("count"))
        both = there.unionByName(absent)
        out = both if out is None else out.unionByName(both)
    return out


# --- range-clustered files ---------------------------------------------------------------------------
def write_codes(spark: SparkSession, post: DataFrame, path: str, entries: int = ENTRIES) -> str:
    """Blocks of a stored, sorted index, with a bloom filter on ``term``; in the index's own order."""
    (coded_blocks(post, entries).write.mode("overwrite")
     .option("parquet.bloom.filter.enabled#term", "true").parquet(path))
    return path


def of_terms(spark: SparkSession, blocks: DataFrame, terms: list[str]) -> DataFrame:
    """The asked terms' rows: ``IN`` reaches the scan; a longer list is joined."""
    if len(terms) <= ISIN_LIMIT:
        return blocks.where(F.col("term").isin(list(terms)))
    return blocks.join(_asked(spark, terms), "term", "left_semi")


# --- bucketed table ------------------------------------------------------------------------------------
def save_bucketed(blocks: DataFrame, buckets: int, name: str | None = None, path: str | None = None) -> str:
    """The blocks as a catalog table bucketed by ``term`` and sorted inside a bucket, one file each.
    Without a ``path`` the table is external, in the shared scratch folder; returns its name."""
    spark = blocks.sparkSession
    name = name or f"quarry_index_{uuid.uuid4().hex}"
    (blocks.repartition(buckets, "term").sortWithinPartitions("term", "first_id", "last_id")
     .write.mode("overwrite").option("path", path or scratch_path(spark, "bucketed"))
     .bucketBy(buckets, "term").sortBy("term", "first_id", "last_id").saveAsTable(name))
    return name


def _buckets(spark: SparkSession, name: str) -> int:
    rows = spark.sql(f"DESCRIBE EXTENDED `{name}`").where("col_name = 'Num Buckets'").collect()
    return int(rows[0]["data_type"])


def bucketed_terms(spark: SparkSession, name: str, terms: list[str] | DataFrame) -> DataFrame:
    """The distinct terms, in a table bucketed as the index ``name`` is."""
    asked, buckets = f"quarry_terms_{uuid.uuid4().hex}", _buckets(spark, name)
    rows = _asked(spark, terms) if isinstance(terms, list) else terms.select("term").where("term IS NOT NULL").distinct()
    (rows.repartition(buckets, "term").sortWithinPartitions("term").write
     .option("path", scratch_path(spark, "asked")).bucketBy(buckets, "term").sortBy("term").saveAsTable(asked))
    return spark.table(asked)


def bucketed_blocks(spark: SparkSession, name: str, terms: list[str] | DataFrame) -> DataFrame:
    """The asked terms' blocks.  Up to ``ISIN_LIMIT`` terms: their buckets are the only ones read.
    A longer list, or a table of terms (:func:`bucketed_terms`), is joined bucket by bucket; the
    index is not shuffled, however many terms are asked."""
    table = spark.table(name)
    if isinstance(terms, list) and len(terms) <= ISIN_LIMIT:
        return table.where(F.col("term").isin(terms))
    if isinstance(terms, list):
        terms = bucketed_terms(spark, name, terms)
    return table.join(terms.hint("merge"), "term", "left_semi")


def bucketed_counts(spark: SparkSession, name: str, terms: list[str] | DataFrame) -> DataFrame:
    """``(term, n, bits)`` of the asked terms, from the skip headers; grouped inside buckets."""
    return bucketed_blocks(spark, name, terms).groupBy("term").agg(F.sum("n").alias("n"), F.sum("bits").alias("bits"))


def search_bucketed(spark: SparkSession, name: str, terms: list[str], compressed: bool = True,
                    between: tuple[int, int] | None = None) -> DataFrame:
    """A5 on a bucketed table, as :func:`search_blocks`."""
    return search_blocks(spark, bucketed_blocks(spark, name, terms), bucketed_counts(spark, name, terms), terms,
                         compressed, between)
