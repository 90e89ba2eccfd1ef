"""Inverted index over a corpus ``(doc_id BIGINT, text STRING)``.

Canonical form is long: ``postings(term, doc_id, tf)``.  It is built per document (a
document lives in one row, so its term frequencies need no shuffle); the only shuffle of
the index build is the one that groups by term, and it carries one row per distinct
(term, document) pair.  Posting *lists* (the reference's ``term -> [ids]``) are served in
blocks of ``BLOCK`` consecutive ids so that no single row or task has to hold the whole
list of a very frequent term; concatenating the blocks of a term in block order gives the
reference's list exactly, duplicates included.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarry.functions import text as tx
from quarry.session import BROADCAST_LIMIT_BYTES, fits_broadcast, ship_package, small_literal_frame

# Ids per posting block (block = doc_id div BLOCK); a power of two.
BLOCK = 65536
# Up to this many query terms go into a pushed-down IN filter; more use a join.
ISIN_LIMIT = 1000


# --- A1: postings --------------------------------------------------------------------
def doc_term_freqs(corpus: DataFrame, text_col: str = "text", id_col: str = "doc_id") -> DataFrame:
    """``(doc_id, term, tf)`` computed inside each row: tokens are sorted and counted in
    runs, so duplicates collapse before anything is shuffled.  The sorted tokens and the
    run starts are materialised as columns so the lambdas index them instead of
    re-deriving them per element."""
    sorted_toks = corpus.select(F.col(id_col).cast("long").alias("doc_id"),
                                F.sort_array(tx.tokenize(text_col)).alias("_s"))
    s, n = F.col("_s"), F.size(F.col("_s"))
    with_starts = sorted_toks.select(
        "doc_id", "_s",
        F.filter(F.sequence(F.lit(0), F.greatest(n - 1, F.lit(0))),
                 lambda i: (i < n) & ((i == 0) | (F.get(s, i) != F.get(s, i - 1)))).alias("_st"))
    st = F.col("_st")
    runs = F.transform(
        st, lambda p, j: F.struct(F.get(s, p).alias("term"),
                                  (F.coalesce(F.get(st, j + 1), n) - p).cast("long").alias("tf")))
    return (with_starts.select("doc_id", F.explode(runs).alias("r"))
            .select(F.col("r.term").alias("term"), "doc_id", F.col("r.tf").alias("tf")))


def postings(corpus: DataFrame, text_col: str = "text", id_col: str = "doc_id") -> DataFrame:
    """A1, long form ``(term, doc_id, tf)``: one row per distinct (term, document)."""
    return doc_term_freqs(corpus, text_col, id_col)


def _block_col(doc_id: Column) -> Column:
    return F.shiftright(doc_id.cast("long"), BLOCK.bit_length() - 1)


def _bounded_parts(pairs: Column, n: Column, entries: int) -> Column:
    """The ``(doc_id, tf)`` pairs of a block, ``n`` occurrences in all, as consecutive lists of pairs
    with at most ``entries`` occurrences each: one list where they fit, else even runs of pairs,
    and where a run is still too large every document alone, its occurrences cut."""
    run = F.greatest(F.lit(1), F.floor(F.size(pairs) * F.lit(float(entries)) / (n * 2)).cast("int"))
    runs = F.transform(F.sequence(F.lit(0), F.floor((F.size(pairs) - 1) / run).cast("int")),
                       lambda i: F.slice(pairs, i * run + 1, run))
    total = lambda x: F.aggregate(x, F.lit(0).cast("long"), lambda s, y: s + y["tf"])
    alone = lambda x: F.transform(
        F.sequence(F.lit(0).cast("long"), F.floor((x["tf"] - 1) / entries)),
        lambda k: F.array(F.struct(x["doc_id"].alias("doc_id"), F.least(F.lit(entries), x["tf"] - k * entries).alias("tf"))))
    return F.when(n <= entries, F.array(pairs)).otherwise(F.flatten(F.transform(
        runs, lambda r: F.when(total(r) <= entries, F.array(r)).otherwise(F.flatten(F.transform(r, alone))))))


def posting_blocks(post: DataFrame, compressed: bool = False, entries: int = BLOCK) -> DataFrame:
    """A1 array view (and A2 when ``compressed``): ``(term, block, part, ids|codes, n)``.

    Ids ascend inside a block, each repeated ``tf`` times (the reference keeps one entry
    per occurrence).  Codes are Elias-delta of the raw id, in the same order.  A row holds at most
    ``entries`` occurrences: a block with more is cut into parts, numbered in list order, before
    anything is repeated.
    """
    pairs = F.sort_array(F.collect_list(F.struct("doc_id", F.col("tf").cast("long").alias("tf"))))
    value = (lambda x: tx.elias_delta(x["doc_id"])) if compressed else (lambda x: x["doc_id"])
    expanded = F.flatten(F.transform(F.col("_p"), lambda x: F.array_repeat(value(x), x["tf"].cast("int"))))
    name = "codes" if compressed else "doc_ids"
    return (post.groupBy("term", _block_col(F.col("doc_id")).alias("block"))
            .agg(pairs.alias("_pairs"), F.sum("tf").alias("_n"))
            .select("term", "block", F.posexplode(_bounded_parts(F.col("_pairs"), F.col("_n"), entries)).alias("part", "_p"))
            .select("term", "block", "part", expanded.alias(name),
                    F.aggregate("_p", F.lit(0).cast("long"), lambda s, x: s + x["tf"]).alias("n")))


# --- A3 / A4: sizes --------------------------------------------------------------------
FRAME_TARGET = 65536        # pickle protocol 4 frame size target
FRAME_HEADER = 9            # FRAME opcode + 8-byte length
WIDTH_CLASSES = (2, 3, 5, 7, 8, 9, 10)   # bytes per pickled int, ascending with the value


def _frames_for_counts(counts: list[int]) -> int:
    """Number of frame headers in ``pickle.dumps(ids, protocol=4)`` for an ascending id
    list with ``counts[i]`` ids of width ``WIDTH_CLASSES[i]``.

    Frames close at the first item boundary where the open frame holds >= 64 KiB, and
    once more after the list if it is still that full; the final frame (ending with STOP)
    gets a header only if it has at least 4 bytes.
    """
    n = int(sum(counts))
    widths = [(w, int(c)) for w, c in zip(WIDTH_CLASSES, counts) if c]

    def item_bytes(k: int) -> int:   # bytes of the first k ids
        total, left = 0, k
        for w, c in widths:
            take = c if left > c else left
            total += w * take
            left -= take
            if left <= 0:
                break
        return total

    def cum(k: int) -> int:          # stream position after the k-th item is saved
        return 2 + item_bytes(k) + -(-k // 1000) + (k - 1) // 1000

    end = 2 + item_bytes(n) + 2 * -(-n // 1000)
    frames, start, k_last = 0, 0, 0
    while True:
        target = start + FRAME_TARGET
        if cum(n) < target:
            break
        lo, hi = k_last + 1, n
        while lo < hi:
            mid = (lo + hi) // 2
            if cum(mid) >= target:
                hi = mid
            else:
                lo = mid + 1
        frames += 1
        start, k_last = cum(lo), lo
        if k_last == n:
            break
    if end - start >= FRAME_TARGET:
        frames += 1
        start = end
    if end + 1 - start >= 4:
        frames += 1
    return frames


def _pickled_bytes_np(n: np.ndarray, sw: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """``len(pickle.dumps(ids, protocol=4))`` per term from its id count, summed id widths
    and ids per width class; frames are walked only for lists that reach the target."""
    batch = np.where(n == 1, 1, 2 * ((n + 999) // 1000))
    payload = 2 + sw + batch + 1
    frames = np.ones(len(n), dtype=np.int64)
    for i in np.nonzero(payload - 1 >= FRAME_TARGET)[0]:
        frames[i] = _frames_for_counts(list(counts[i]))
    return 2 + payload + FRAME_HEADER * frames


def _sized(batches):
    for pdf in batches:
        n = pdf["n"].to_numpy(dtype=np.int64)
        counts = pdf[[f"c{c}" for c in WIDTH_CLASSES]].to_numpy(dtype=np.int64)
        size = _pickled_bytes_np(n, pdf["sw"].to_numpy(dtype=np.int64), counts)
        yield pdf[["term", "n", "bits"]].assign(pickled=size)


def term_size_stats(post: DataFrame) -> DataFrame:
    """Per term: occurrences, pickled-id bytes, Elias-delta bits and ids per width.  The
    width and code length are computed once per posting, in a projection below the
    aggregate."""
    per_posting = post.select("term", "tf", tx.pickled_int_width("doc_id").alias("_w"),
                              tx.elias_delta_length("doc_id").alias("_dl"))
    by_width = [F.sum(F.when(F.col("_w") == c, F.col("tf")).otherwise(0)).cast("long").alias(f"c{c}")
                for c in WIDTH_CLASSES]
    return per_posting.groupBy("term").agg(
        F.sum("tf").cast("long").alias("n"),
        F.sum(F.col("tf") * F.col("_w")).cast("long").alias("sw"),
        F.sum(F.col("tf") * F.col("_dl")).cast("long").alias("bits"),
        *by_width)


def term_sizes(stats: DataFrame) -> DataFrame:
    """``(term, n, bits, pickled)``: occurrences, code bits and pickled-list bytes per term."""
    ship_package(stats.sparkSession)
    return stats.mapInPandas(_sized, "term string, n long, bits long, pickled long")


def size_totals(sizes: DataFrame, query: str | None = None) -> DataFrame:
    """A3 + A4: one row ``(uncompressed_bytes, compressed_bytes)`` of :func:`term_sizes`; with
    ``query`` also ``results_count`` (occurrences of that term) from the same pass."""
    aggs = [F.coalesce(F.sum("pickled"), F.lit(0)).cast("long").alias("uncompressed_bytes"),
            (F.coalesce(F.sum("bits"), F.lit(0)) / F.lit(8.0)).alias("compressed_bytes")]
    if query is not None:
        hits = F.sum(F.when(F.col("term") == F.lit(query), F.col("n")))
        aggs.append(F.coalesce(hits, F.lit(0)).cast("long").alias("results_count"))
    return sizes.agg(*aggs)


def index_sizes(post: DataFrame, query: str | None = None) -> DataFrame:
    """A3 + A4 over postings.  Per-term statistics are aggregated natively; the pickled size of
    a term's list is one Arrow-batched step over the terms."""
    return size_totals(term_sizes(term_size_stats(post)), query)


def _report_columns(uncompressed: Column, compressed: Column) -> list[Column]:
    return [(uncompressed / F.lit(1024.0)).alias("uncompressed_size_kb"),
            (compressed / F.lit(1024.0)).alias("compressed_size_kb"),
            F.when(uncompressed > 0, compressed / uncompressed).alias("compression_ratio")]


def evaluate(post: DataFrame, query: str) -> DataFrame:
    """A6 over postings: sizes in KB, ratio compressed/uncompressed (NULL for an empty index)
    and the result count of ``query`` -- one pass, no join."""
    sizes = index_sizes(post, query)
    return sizes.select(*_report_columns(F.col("uncompressed_bytes"), F.col("compressed_bytes")), "results_count")


def evaluate_terms(spark: SparkSession, sizes: DataFrame, totals: Row, terms: list[str]) -> DataFrame:
    """A6 from stored tables, one row per term: the totals of the index and a lookup of the
    terms in their sizes (``term IN`` pushed to the scan)."""
    hits = _restrict_to_terms(spark, sizes, terms).select("term", "n")
    asked = small_literal_frame(spark, [(t,) for t in terms], "term string")
    report = _report_columns(F.lit(totals["uncompressed_bytes"]), F.lit(totals["compressed_bytes"]))
    return asked.join(hits, "term", "left").select(
        "term", *report, F.coalesce(F.col("n"), F.lit(0)).cast("long").alias("results_count"))


# --- A5 / J3: search -------------------------------------------------------------------
def _restrict_to_terms(spark: SparkSession, post: DataFrame, terms: list[str]) -> DataFrame:
    if len(terms) <= ISIN_LIMIT:
        return post.filter(F.col("term").isin(terms))            # pushed to the scan
    q = small_literal_frame(spark, [(t,) for t in terms], "term string")
    q = F.broadcast(q) if fits_broadcast(terms) else q
    return post.join(q, "term", "left_semi")


def _term_chunks(terms: list[str]) -> list[list[str]]:
    """The terms in lists that may be broadcast (with a count each)."""
    chunks: list[list[str]] = [[]]
    size = 0
    for t in terms:
        size += len(repr(t)) + 16
        if chunks[-1] and size > BROADCAST_LIMIT_BYTES:
            chunks.append([])
            size = len(repr(t)) + 16
        chunks[-1].append(t)
    return chunks


def search(spark: SparkSession, post: DataFrame, terms: list[str] | str,
           compressed: bool = True) -> DataFrame:
    """Exact whole-token lookup of each term.

    Returns ``(term, block, part, results, count)``: ``results`` holds the ids (or their codes)
    of one part of a block, ``count`` the occurrences of the term over all blocks.  A term that is
    absent gets one row with an empty list, NULL block and count 0.

    The counts (at most one row per asked term) are aggregated on their own and broadcast to
    the blocks, so the id lists of a frequent term are never brought together.  A list of
    terms beyond the broadcast limit is looked up in parts.
    """
    terms = [terms] if isinstance(terms, str) else list(dict.fromkeys(terms))
    out = None
    for part in _term_chunks(terms):
        hits = _restrict_to_terms(spark, post, part)
        found = posting_blocks(hits, compressed=compressed)
        counts = hits.groupBy("term").agg(F.sum("tf").cast("long").alias("count"))
        results = F.col("codes" if compressed else "doc_ids").alias("results")
        there = found.join(F.broadcast(counts), "term").select("term", "block", "part", results, "count")
        asked = small_literal_frame(spark, [(t,) for t in part], "term string")
        empty = F.array().cast(T.ArrayType(T.StringType() if compressed else T.LongType()))
        # the same counts again (a reused broadcast), so the texts are read once
        absent = asked.join(F.broadcast(counts), "term", "left").where(F.col("count").isNull()).select(
            "term", F.lit(None).cast("long").alias("block"), F.lit(0).alias("part"), empty.alias("results"),
            F.lit(0).cast("long").alias("count"))
        both = there.unionByName(absent)
        out = both if out is None else out.unionByName(both)
    return out


# Up to this many terms a substring prefilter (OR of contains) runs before tokenising.
PREFILTER_LIMIT = 64


def query_postings(spark: SparkSession, corpus: DataFrame, terms: list[str],
                   text_col: str = "text", id_col: str = "doc_id") -> DataFrame:
    """Postings of only ``terms``, straight from the corpus: a document whose text does
    not contain a term as a substring cannot contain it as a token, so those are dropped
    before tokenising, and tokens are filtered to the terms before anything is grouped."""
    terms = list(dict.fromkeys(terms))
    docs = corpus.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    if 0 < len(terms) <= PREFILTER_LIMIT:
        cond = None
        for t in terms:
            c = F.col("text").contains(F.lit(t))
            cond = c if cond is None else (cond | c)
        docs = docs.filter(cond)
    if len(terms) <= ISIN_LIMIT:
        keep = F.filter(tx.tokenize("text"), lambda t: t.isin(terms))
        occ = docs.select("doc_id", F.explode(keep).alias("term"))
    else:
        q = small_literal_frame(spark, [(t,) for t in terms], "term string")
        q = F.broadcast(q) if fits_broadcast(terms) else q
        occ = docs.select("doc_id", F.explode(tx.tokenize("text")).alias("term")).join(q, "term", "left_semi")
    return occ.groupBy("term", "doc_id").agg(F.count(F.lit(1)).alias("tf"))


def search_corpus(spark: SparkSession, corpus: DataFrame, terms: list[str] | str,
                  compressed: bool = True) -> DataFrame:
    """A5 without a stored index: same output as :func:`search`."""
    terms = [terms] if isinstance(terms, str) else list(dict.fromkeys(terms))
    return search(spark, query_postings(spark, corpus, terms), terms, compressed)
