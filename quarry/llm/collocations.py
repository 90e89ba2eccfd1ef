"""Phrase collocations by top-order marginalisation.

Every word starts one window: itself and the next words of its piece (lead columns ``w1`` ..
``w4``), padded past the end.  Only these longest windows are counted; how often any shorter
phrase occurs is the sum over the windows it leads, which Spark's ``ROLLUP`` gives for all
lengths at once.  Phrases are never exploded by length.

Windows are cut (padded early) at a neighbouring pair that cannot be in any candidate: pairs
are counted first by hashed class, and a pair whose whole class occurs less than the least
count is rare itself.  Every phrase that reaches the least count has only pairs that do, so its
count, and that of all its parts, is exact.  The class table has at most ``MAX_CLASSES`` bits
(64 MB) whatever the input; on an input so large that all classes fill, nothing is cut and the
results are the same.

Tasks count windows a block of text at a time, so a task's memory follows the block and the
longest text; Spark sums the blocks' counts map-side before the shuffle.  Words that lead many
candidates are joined by broadcast (:func:`quarry.llm.common.join_split`).

Defined cases: null text is empty, null lang is ``und`` (with a lang of that name); a text of
any length is read whole, cut only between words; repeated rows count each time; ties in
score go to the larger count, then the smaller phrase in byte order; other columns are ignored;
an empty table, or one without candidates, gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F

from quarry.llm.common import join_split, slices, utf8, written
from quarry.operators.topk import top_k_per_group

#: Words of the longest phrase.
ORDER = 4
#: Bytes of text for each class of pairs, and the most classes.
BYTES_PER_CLASS, MAX_CLASSES = 24, 1 << 29
#: Text bytes whose words are held at once, and windows gathered before they are counted.
BLOCK_BYTES, HELD_WORDS = 2 << 20, 1_000_000

# fixed values: bytes that end a piece, bytes between words
_ENDS, _BETWEEN = b".,;:!?\x0a\x0b\x0c\x0d", b"\x20\x09"

#: 0xFF is in no UTF-8 text and marks the end of a piece.
_END = b"\xff"
_MAP = bytes(0xFF if b in _ENDS else 0x20 if b in _BETWEEN else b + 32 if 65 <= b <= 90 else b for b in range(256))


def blocks(data: bytes, limit: int = BLOCK_BYTES) -> Iterator[tuple[list[bytes], int]]:
    """Words and end marks of mapped text, about ``limit`` bytes at a time, and how many of them
    are this block's own: up to ``ORDER`` - 1 words of a piece that goes on follow as context."""
    at, size = 0, len(data)
    while at < size:
        stop = size
        if size - at > limit:
            stop = max(data.rfind(b" ", at, at + limit), data.rfind(_END, at, at + limit))
            if stop <= at:      # one word longer than a block
                ahead = [p for p in (data.find(b" ", at + limit), data.find(_END, at + limit)) if p >= 0]
                stop = min(ahead, default=size)
        own = data[at:stop].replace(_END, b" \xff ").split()
        after: list[bytes] = []
        look = 256
        while stop < size:
            piece, ended, _ = data[stop:stop + look].partition(_END)
            after = piece.split()
            if ended or len(after) >= ORDER or stop + look >= size:
                break
            look *= 8
        yield own + after[:ORDER - 1] + [_END], len(own)
        at = stop


def _encoded(batch: pa.RecordBatch) -> Iterator[tuple[str, np.ndarray, list[bytes], np.ndarray]]:
    """Per language and block: language, codes (-1: end of a piece), words by code, own positions."""
    for part in slices(batch, limit=BLOCK_BYTES):
        lang = part.column("lang").dictionary_encode()
        names = lang.dictionary.to_pylist()
        code = lang.indices.to_numpy()
        texts = utf8(part.column("text"))
        for i, name in enumerate(names):
            data = _END.join(texts[j] for j in np.flatnonzero(code == i)).translate(_MAP)
            for words, own in blocks(data):
                coded = pa.array(words, pa.binary()).dictionary_encode()
                found = coded.dictionary.to_pylist()
                codes = coded.indices.to_numpy().astype(np.int64)
                codes[codes == found.index(_END)] = -1
                yield name, codes, found, np.flatnonzero(codes[:own] >= 0)


def _pair_classes(name: str, codes: np.ndarray, words: list[bytes], at: np.ndarray, classes: int) -> np.ndarray:
    """Class of the pair that starts at each position ``at``; -1 where the piece ends."""
    seed = xxhash.xxh64_intdigest(name.encode(), 7) & 0xFFFFFFFF
    one = np.fromiter((xxhash.xxh64_intdigest(w, seed) for w in words), np.uint64, len(words))
    following = codes[at + 1]
    with np.errstate(over="ignore"):
        mixed = (one[codes[at]] * np.uint64(0x9E3779B97F4A7C15)) ^ (one[following] * np.uint64(0xC2B2AE3D27D4EB4F))
        mixed = (mixed ^ (mixed >> np.uint64(29))) * np.uint64(0x165667B19E3779F9)
    return np.where(following >= 0, (mixed >> np.uint64(33)).astype(np.int64) % classes, -1)


def _count_pairs(batches: Iterator[pa.RecordBatch], classes: int) -> Iterator[pa.RecordBatch]:
    held: list[np.ndarray] = []

    def counted() -> pa.RecordBatch:
        found, n = np.unique(np.concatenate(held), return_counts=True)
        held.clear()
        return pa.RecordBatch.from_arrays([pa.array(found), pa.array(n)], ["c", "n"])

    for batch in batches:
        for name, codes, words, at in _encoded(batch):
            found = _pair_classes(name, codes, words, at, classes)
            held.append(found[found >= 0].astype(np.int32))
            if sum(map(len, held)) >= HELD_WORDS:
                yield counted()
    if held:
        yield counted()


def _count_windows(batches: Iterator[pa.RecordBatch], classes: int, bitmap: np.ndarray) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for name, codes, words, at in _encoded(batch):
            pair = _pair_classes(name, codes, words, at, classes)
            common = np.zeros(len(codes) + ORDER, bool)
            common[at] = (pair >= 0) & ((bitmap[pair >> 3] >> (pair & 7).astype(np.uint8)) & 1).astype(bool)
            last = at[-1] + 1 if len(at) else 0      # context words: their pairs are looked up too
            beyond = np.flatnonzero(codes[last:] >= 0) + last
            if len(beyond):
                more = _pair_classes(name, codes, words, beyond, classes)
                common[beyond] = (more >= 0) & ((bitmap[more >> 3] >> (more & 7).astype(np.uint8)) & 1).astype(bool)
            padded = np.append(codes, np.full(ORDER, -1, np.int64))
            on, lead = np.ones(len(at), bool), [codes[at]]
            for k in range(1, ORDER):
                on = on & common[at + k - 1]
                lead.append(np.where(on, padded[at + k], -1))
            order = np.lexsort(lead[::-1])
            lead = [x[order] for x in lead]
            new = np.ones(len(order), bool)
            if len(order):
                new[1:] = np.any([x[1:] != x[:-1] for x in lead], axis=0)
            first = np.flatnonzero(new)
            n = np.diff(np.append(first, len(order)))
            texts = pa.array(words + [b""], pa.binary())
            columns = [texts.take(pa.array(np.where(x[first] < 0, len(words), x[first]), pa.int64())) for x in lead]
            yield pa.RecordBatch.from_arrays(
                [pa.array([name] * len(first), pa.string()),
                 pc.binary_join_element_wise(*columns, pa.scalar(b" ", pa.binary())).cast(pa.string()),
                 pa.array(n, pa.int64())], ["lang", "window", "n"])


_LEAD = [f"w{k}" for k in range(1, ORDER + 1)]


def _bitmap(rows: list[Row], classes: int) -> np.ndarray:
    """The rows of a Spark bitmap aggregate as one array of bits."""
    bits = np.zeros(-(-classes // 32768) * 4096, np.uint8)
    for r in rows:
        at = r["block"] * 4096
        bits[at:at + 4096] = np.frombuffer(r["bits"], np.uint8)
    return bits


def windows(docs: DataFrame, min_count: int) -> DataFrame:
    """``lang``, ``w1`` .. ``w4`` (empty: padded), ``n``: every distinct longest window, counted.  It
    travels as one string; a padded word leaves nothing between the spaces."""
    spark = docs.sparkSession
    size = docs.agg(F.sum(F.octet_length("text")).alias("n")).first()["n"] or 0
    classes = 32768
    while classes * BYTES_PER_CLASS < size and classes < MAX_CLASSES:
        classes *= 2
    pairs = docs.mapInArrow(lambda it: _count_pairs(it, classes), "c int, n long")
    often = pairs.groupBy("c").agg(F.sum("n").alias("n")).where(F.col("n") >= min_count)
    bits = often.groupBy((F.col("c") / 32768).cast("int").alias("block")).agg(
        F.bitmap_construct_agg(F.col("c").cast("long") % 32768).alias("bits"))
    bitmap = _bitmap(bits.collect(), classes)      # at most MAX_CLASSES bits
    parts = docs.mapInArrow(lambda it: _count_windows(it, classes, bitmap), "lang string, window string, n long")
    lead = F.split("window", " ")
    return parts.groupBy("lang", "window").agg(F.sum("n").alias("n")).select(
        "lang", *[lead[i].alias(w) for i, w in enumerate(_LEAD)], "n")


def phrase_counts(docs: DataFrame, min_count: int) -> DataFrame:
    """``lang``, ``k``, ``phrase``, ``a``: phrases of 1 to 4 words that occur ``min_count`` times or
    more, and with ``k`` 0 the number of words of each language."""
    longest = written(docs.sparkSession, windows(docs, min_count), "longest-windows")
    full = (longest.where((F.col(_LEAD[-1]) != "") & (F.col("n") >= min_count))
            .select("lang", F.lit(ORDER).alias("k"), F.array_join(F.array(*_LEAD), " ").alias("phrase"), F.col("n").alias("a")))
    shorter = _LEAD[:-1]
    summed = longest.rollup("lang", *shorter).agg(F.sum("n").alias("a"), F.grouping_id().alias("_gid"))
    k = F.lit(ORDER - 1) - F.length(F.replace(F.bin("_gid"), F.lit("0"), F.lit("")))     # words not rolled up
    words = F.filter(F.array(*shorter), lambda w: w.isNotNull() & (w != ""))
    return (summed.withColumn("k", k).where("k >= 0")
            .where((F.col("k") == 0) | ((F.col("a") >= min_count) & (F.size(words) == F.col("k"))))
            .select("lang", F.col("k").cast("int").alias("k"), F.array_join(words, " ").alias("phrase"), "a")
            .unionByName(full))


#: Exact where the products pass 64 bits.
SCORE = "(cast(a as decimal(20,0)) * 2000000) div (cast(l as decimal(20,0)) + cast(r as decimal(20,0)))"


def _part(words: Column, start: Column | int, n: Column | int) -> Column:
    return F.array_join(F.slice(words, start, n), " ")


def phrases(docs: DataFrame, min_count: int = 30, top: int = 2000, absorbed: int = 80,
            text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """``lang``, ``rank``, ``phrase``, ``a``, ``l``, ``r``, ``n``, ``score``: per language the first ``top``
    phrases of 2 to 4 words with ``min_count`` occurrences.  A phrase inside a longer one that has
    ``absorbed`` per cent of its occurrences is left out."""
    spark = docs.sparkSession
    texts = docs.select(F.coalesce(F.col(lang_col), F.lit("und")).alias("lang"), F.col(text_col).alias("text"))
    counts = written(spark, phrase_counts(texts, min_count), "phrase-counts")
    often = counts.where("k > 0").select("lang", "phrase", "a")
    cands = counts.where("k > 1").withColumn("w", F.split("phrase", " "))

    w, size = F.col("w"), F.col("k")
    inner = F.flatten(F.transform(F.sequence(F.lit(2), size - 1), lambda m: F.transform(
        F.sequence(F.lit(1), size - m + 1), lambda i: _part(w, i, m))))
    longer = (cands.where("k > 2").select("lang", F.explode(inner).alias("phrase"), "a")
              .groupBy("lang", "phrase").agg(F.max("a").alias("longer")))
    exact = lambda c: F.col(c).cast("decimal(20,0)")
    alone = cands.join(longer, ["lang", "phrase"], "left").where(
        F.col("longer").isNull() | (exact("longer") * 100 < exact("a") * absorbed))

    cut = written(spark, alone.select("lang", "phrase", "a", "w", "k", F.explode(F.sequence(F.lit(1), size - 1)).alias("cut"))
                  .select("lang", "phrase", "a", "cut", _part(w, 1, F.col("cut")).alias("head"),
                          _part(w, F.col("cut") + 1, size - F.col("cut")).alias("tail")), "phrase-cuts")
    heads = written(spark, join_split(cut, often.toDF("lang", "head", "l"), ["lang", "head"]), "phrase-heads")
    both = join_split(heads, often.toDF("lang", "tail", "r"), ["lang", "tail"])
    least = both.withColumn("score", F.expr(SCORE)).groupBy("lang", "phrase").agg(
        F.min(F.struct("score", "cut", "a", "l", "r")).alias("s")).select("lang", "phrase", "s.*")
    ranked = top_k_per_group(least, ["lang"], [F.desc("score"), F.desc("a"), F.asc("phrase")], top)
    total = counts.where("k = 0").select("lang", F.col("a").alias("n"))
    return ranked.join(total, "lang").select(
        "lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
