"""Toxicity: a factorization machine over hashed terms.

Terms of a text are its lower-cased words and their first four, five and six letters, hashed.
The terms that tell the labels apart (log-likelihood ratio) are kept; over them the model is
``b + sum w_i x_i + sum_{i<j} <v_i, v_j> x_i x_j`` with x_i = 1 for a term in the text, so that a
pair (an insult with a group mention, say) can weigh more or less than its parts.  Its logistic
value is taken for every window of ``WINDOW`` words of a text (each begins half a window after the
one before), and the score is the highest, so that it does not add up with the length.

The model is fitted on a sample of labelled texts (``SAMPLE`` documents per label at most, about,
by a hash of the id) in two steps.  A first fit takes ``FIT_WINDOWS`` evenly spaced windows of each
text.  With it every window of every sampled text is scored where the texts are, and the final fit
takes the highest window of a text of label 1, wherever it lies, and the ``FIT_WINDOWS`` highest of
one of label 0.  So the driver holds at most ``2 * SAMPLE * FIT_WINDOWS`` lists of kept terms, whatever
the lengths.  Scoring covers whole texts.

Defined cases: null text counts as empty and scores by the bias alone; null labels are passed
over, labels that repeat an id are averaged (1 from a half on); without labels of both kinds
the score is next to 1 or 0; repeated rows and null ids score like
others; extra columns are ignored.  An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.llm.common import schema_of, slices, written
from quarry.llm.langid import split_words

SAMPLE = 8000
BITS = 18
#: Terms that the model knows at most, and the log-likelihood ratio that a term needs.
TERMS = 8192
LEAST_RATIO = 12.0
FACTORS = 8
PREFIXES = (4, 5, 6)
#: Words that are scored together, and windows of a labelled text that the driver holds for a fit.
WINDOW = 384
FIT_WINDOWS = 4


def sampled_labels(labels: DataFrame, label: str, usable: Column, per_class: int) -> DataFrame:
    """Id, label (0/1) and weight (labelled ids that one of the sample stands for) of about
    ``per_class`` labelled ids of each kind at most, by a hash of the id.  Small: its size is
    bounded by the parameter."""
    rows = (labels.where(F.col("doc_id").isNotNull() & F.col(label).isNotNull() & usable)
            .groupBy("doc_id").agg((F.avg(label) >= 0.5).cast("int").alias("label")))
    count = {r["label"]: r["n"] for r in rows.groupBy("label").agg(F.count("*").alias("n")).collect()}
    bar = weight = F.lit(1)
    for k, n in count.items():
        share = max(1, min(1 << 20, int(per_class / n * (1 << 20))))
        bar = F.when(F.col("label") == k, share).otherwise(bar)
        weight = F.when(F.col("label") == k, (1 << 20) / share).otherwise(weight)
    chosen = F.pmod(F.xxhash64(F.lit(label), "doc_id"), F.lit(1 << 20)) < bar
    return rows.where(chosen).select(F.col("doc_id").alias("__id"), F.col("label").alias("__label"),
                                   weight.cast("double").alias("__weight"))


def labelled_texts(docs: DataFrame, labels: DataFrame, label: str, usable: Column, per_class: int) -> DataFrame:
    """``doc_id``, ``text``, ``label``, ``weight`` of the sampled labelled documents, written once: one row
    per id (the first by text of rows that repeat it), so that ``per_class`` bounds the rows too.  The
    sample's ids are broadcast: their number is bounded by ``per_class``."""
    chosen = F.broadcast(sampled_labels(labels, label, usable, per_class))
    rows = (docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).join(chosen, F.col("doc_id") == F.col("__id"))
            .groupBy("doc_id", F.col("__label").alias("label"), F.col("__weight").alias("weight"))
            .agg(F.min("text").alias("text")))
    return written(docs.sparkSession, rows.select("doc_id", "text", "label", "weight"), f"{label}-sample")


def windows(doc: np.ndarray, n_docs: int, window: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First and last window of every word (two at most), and the text of every window.  ``doc``
    (sorted) says which text a word belongs to; a text without words has one window."""
    half, count = window // 2, np.bincount(doc, minlength=n_docs)
    each = np.maximum(1, -(-count // half) - 1)
    base = np.cumsum(each) - each
    block = (np.arange(len(doc)) - (np.cumsum(count) - count)[doc]) // half
    return (base[doc] + np.maximum(block - 1, 0), base[doc] + np.minimum(block, each[doc] - 1),
            np.repeat(np.arange(n_docs), each))


def terms(texts: list[str], index: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """(text, bucket) of every distinct term, sorted; with ``index``, (text, kept term)."""
    return window_terms(texts, index, None)[:2]


def window_terms(texts: list[str], index: np.ndarray | None,
                 window: int | None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(window, bucket) of every distinct term, sorted, and the text of every window; with
    ``index``, (window, kept term).  Without ``window`` a text is one window."""
    w = split_words(texts)
    if window is None:
        lows, highs, text = w.doc, w.doc, np.arange(len(texts))
    else:
        lows, highs, text = windows(w.doc, len(texts), window)
    if not len(w.start):
        return np.zeros(0, np.int64), np.zeros(0, np.int64), text
    here = w.letters[w.letters != 0].astype(np.uint64)
    first = np.cumsum(w.size) - w.size
    powers = np.ones(int(w.size.max()) + 1, np.uint64)
    powers[1:] = np.uint64(0x9E3779B97F4A7C15)
    powers = np.cumprod(powers)                       # wraps: a polynomial in 64 bits
    sums = np.r_[np.uint64(0), np.cumsum(here * powers[np.arange(len(here)) - np.repeat(first, w.size)])]
    found = []
    for n in (0, *PREFIXES):
        long = w.size > n if n else np.ones(len(w.size), bool)
        at, size = first[long], (np.minimum(w.size, n) if n else w.size)[long]
        h = (sums[at + size] - sums[at]) ^ np.uint64(n * 0xD6E8FEB86659FD93 % 2 ** 64)
        h ^= h >> np.uint64(29)
        h *= np.uint64(0xBF58476D1CE4E5B9)
        term, low, high = (h >> np.uint64(64 - BITS)).astype(np.int64), lows[long], highs[long]
        if index is not None:
            term = index[term].astype(np.int64)
            low, high, term = low[term >= 0], high[term >= 0], term[term >= 0]
        found.append((low.astype(np.int64) << BITS) | term)
        twice = high > low
        found.append((high[twice].astype(np.int64) << BITS) | term[twice])
    pairs = np.unique(np.concatenate(found))
    return pairs >> BITS, pairs & ((1 << BITS) - 1), text


@dataclass
class Model:
    index: np.ndarray         # bucket -> kept term, -1 for the others
    bias: float
    weight: np.ndarray
    factors: np.ndarray

    def scores(self, texts: list[str]) -> np.ndarray:
        at, term, text = window_terms(texts, self.index, WINDOW)
        if not len(texts):
            return np.zeros(0)
        first = np.flatnonzero(np.r_[True, text[1:] != text[:-1]])
        return 1 / (1 + np.exp(-np.clip(np.maximum.reduceat(self.sums(at, term, len(text)), first), -40, 40)))

    def sums(self, at: np.ndarray, term: np.ndarray, n: int) -> np.ndarray:
        """Value of the machine for each of ``n`` windows with the kept terms ``term`` at ``at``."""
        total = self.bias + np.bincount(at, self.weight[term], n)
        for v in self.factors.T:
            x = v[term]
            total += 0.5 * (np.bincount(at, x, n) ** 2 - np.bincount(at, x * x, n))
        return total


def choose_terms(present: np.ndarray, positive: np.ndarray, n: int, n_pos: int) -> np.ndarray:
    """Index of the kept terms by bucket.  ``present`` and ``positive``: texts, and texts of label
    1, that hold the bucket."""
    def part(k: np.ndarray, expected: np.ndarray) -> np.ndarray:
        return np.where(k > 0, k * np.log(np.maximum(k, 1e-9) / np.maximum(expected, 1e-9)), 0)

    share, absent = n_pos / n, n - present
    ratio = 2 * (part(positive, present * share) + part(present - positive, present * (1 - share))
                 + part(n_pos - positive, absent * share) + part(absent - (n_pos - positive), absent * (1 - share)))
    order = np.argsort(-ratio, kind="stable")[:TERMS]
    order = order[ratio[order] >= LEAST_RATIO]
    index = np.full(len(present), -1, np.int32)
    index[order] = np.arange(len(order), dtype=np.int32)
    return index


def fit(rows: list[np.ndarray], y: np.ndarray, n_terms: int, epochs: int = 40, batch: int = 64,
        rate: float = 0.3, decay: float = 1e-5, seed: int = 5) -> tuple[float, np.ndarray, np.ndarray]:
    """AdaGrad on the logistic loss, on the terms of each batch; bias, weights and factors."""
    rng = np.random.default_rng(seed)
    w, v = np.zeros(n_terms), rng.normal(0, 0.02, (n_terms, FACTORS))
    b = float(np.log((y.sum() + 1) / (len(y) - y.sum() + 1)))
    gw, gv, gb = np.full(n_terms, 1e-4), np.full(v.shape, 1e-4), 1e-4
    for _ in range(epochs):
        order = rng.permutation(len(rows))
        for i in range(0, len(order), batch):
            part = order[i:i + batch]
            n = len(part)
            doc = np.repeat(np.arange(n), [len(rows[j]) for j in part])
            term, at = np.unique(np.concatenate([rows[j] for j in part]), return_inverse=True)
            x = v[term][at]
            s = np.stack([np.bincount(doc, c, n) for c in x.T], axis=1)
            z = b + np.bincount(doc, w[term][at], n) + 0.5 * ((s * s).sum(1) - np.bincount(doc, (x * x).sum(1), n))
            g = (1 / (1 + np.exp(-np.clip(z, -40, 40))) - y[part]) / n
            dw = np.bincount(at, g[doc], len(term)) + decay * w[term]
            each = g[doc, None] * (s[doc] - x)
            dv = np.stack([np.bincount(at, c, len(term)) for c in each.T], axis=1) + decay * v[term]
            gw[term] += dw * dw
            gv[term] += dv * dv
            gb += float(g.sum()) ** 2
            w[term] -= rate * dw / np.sqrt(gw[term])
            v[term] -= 0.2 * rate * dv / np.sqrt(gv[term])
            b -= 0.5 * rate * float(g.sum()) / gb ** 0.5
    return b, w, v


def train(sample: DataFrame) -> Model:
    """Fit on ``sample`` (``text``, ``label``; bounded, see :func:`labelled_texts`)."""
    spark = sample.sparkSession
    count = {r["label"]: r["n"] for r in sample.groupBy("label").agg(F.count("*").alias("n")).collect()}
    n, n_pos = sum(count.values()), count.get(1, 0)
    nothing = np.zeros((0, FACTORS))
    if not n_pos or n_pos == n:
        share = n_pos / n if n else 0.0
        bias = 40.0 if share == 1 else -40.0
        return Model(np.full(1 << BITS, -1, np.int32), bias, np.zeros(0), nothing)

    def tally(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros((2, 1 << BITS), np.int64)
        for batch in (s for b in batches for s in slices(b)):
            doc, bucket = terms(batch.column("text").to_pylist())
            y = batch.column("label").to_numpy()[doc]
            for k in (0, 1):
                sums[k] += np.bincount(bucket[y == k], minlength=1 << BITS)
        seen = np.flatnonzero(sums.any(axis=0))
        yield pa.RecordBatch.from_arrays([pa.array(seen), pa.array(sums[0, seen]), pa.array(sums[1, seen])],
                                         ["bucket", "neg", "pos"])

    table = (sample.mapInArrow(tally, "bucket long, neg long, pos long")
             .groupBy("bucket").agg(F.sum("neg").alias("neg"), F.sum("pos").alias("pos")).toArrow())   # <= 2**BITS rows
    neg, pos = np.zeros(1 << BITS), np.zeros(1 << BITS)
    at = table.column("bucket").to_numpy()
    neg[at], pos[at] = table.column("neg").to_numpy(), table.column("pos").to_numpy()
    index = choose_terms(neg + pos, pos, n, n_pos)
    shared = spark.sparkContext.broadcast(Model(index, 0.0, np.zeros(0), nothing))

    n_terms = int(index.max()) + 1
    examples, y, more = _examples(sample, Model(index, 0.0, np.zeros(n_terms), np.zeros((n_terms, FACTORS))), False)
    if not more:                       # every text is one window
        return Model(index, *fit(examples, y, n_terms))
    examples, y, _ = _examples(sample, Model(index, *fit(examples, y, n_terms, epochs=10)), True)
    return Model(index, *fit(examples, y, n_terms))


def fit_windows(text: np.ndarray, label: np.ndarray, value: np.ndarray | None) -> np.ndarray:
    """Places of the windows that the fit takes, of windows of the texts ``text`` (sorted) with labels
    ``label`` by text.  Without values: evenly spaced ones; else the highest one of a text of label
    1, the highest of others (the first of equal ones)."""
    each = np.bincount(text, minlength=len(label))
    place = np.arange(len(text)) - np.repeat(np.cumsum(each) - each, each)
    if value is None:
        taken = np.minimum(each, FIT_WINDOWS)[text]
        return np.flatnonzero(place * taken // each[text] != (place - 1) * taken // each[text])
    order = np.lexsort((place, -value, text))           # by text, highest first: ``place`` is the rank there
    return np.sort(order[place < np.where(label == 1, 1, FIT_WINDOWS)[text]])


def _examples(sample: DataFrame, model: Model, by_value: bool) -> tuple[list[np.ndarray], np.ndarray, bool]:
    """Kept terms and label of the windows that :func:`fit_windows` takes of each text, and whether
    any text has more than one window."""
    shared = sample.sparkSession.sparkContext.broadcast(model)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (s for b in batches for s in slices(b)):
            at, term, text = window_terms(batch.column("text").to_pylist(), shared.value.index, WINDOW)
            ends = np.r_[0, np.cumsum(np.bincount(at, minlength=len(text)))].astype(np.int32)
            label = batch.column("label").to_numpy()
            value = shared.value.sums(at, term, len(text)) if by_value else None
            some = fit_windows(text, label, value)
            each = np.bincount(text, minlength=batch.num_rows)
            place = some - (np.cumsum(each) - each)[text[some]]
            lists = pa.ListArray.from_arrays(pa.array(ends), pa.array(term.astype(np.int32)))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").take(pa.array(text[some])), pa.array(label[text[some]].astype(np.int32)),
                 pa.array(place.astype(np.int32)), lists.take(pa.array(some)), pa.array(each[text[some]] > 1)],
                ["doc_id", "label", "place", "terms", "more"])

    held = sample.mapInArrow(rows, schema_of(
        sample, ["doc_id"], "label int, place int, terms array<int>, more boolean")).toArrow()
    held = held.sort_by([("doc_id", "ascending"), ("place", "ascending")])
    lists = held.column("terms").combine_chunks()
    ends, flat = lists.offsets.to_numpy(), lists.values.to_numpy()
    return ([flat[a:b] for a, b in zip(ends, ends[1:])], held.column("label").to_numpy().astype(np.float64),
            bool(held.column("more").to_numpy().any()))


def score(docs: DataFrame, model: Model) -> DataFrame:
    """``doc_id`` and ``score`` per row."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (s for b in batches for s in slices(b, limit=4 << 20)):
            texts = [t or "" for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(shared.value.scores(texts))],
                                             ["doc_id", "score"])

    return docs.select("doc_id", "text").mapInArrow(run, schema_of(docs, ["doc_id"], "score double"))
