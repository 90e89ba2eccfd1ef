"""Language identification with spans.

Letters are mapped to script ranges; a word's script leaves only the languages that the
training texts write in it.  The candidates are scored per word by character n-grams (one to
three letters, with word ends), and a Viterbi pass with a switching penalty labels every word of
a text, so that mixed-language texts come out as spans.  The prediction is the language that
labels most letters.

The n-gram table is counted in Spark over a sample of labelled texts (``SAMPLE`` documents per
language, by a hash of the id); everything else covers whole texts and all rows.

Defined cases: null text, and a text without a letter, is ``und`` with score 0 and no span; letters
of a script that no language uses give no evidence but count in the score's denominator; a text of only such letters gets the most
frequent language with score 0; without any labelled text all rows are ``und``; of more than
``LANGUAGES`` labels the most frequent are learned; ties go to the language that sorts first; repeated rows and null ids are predicted like any other; extra
columns are ignored by :func:`predict` and kept by :func:`keep_identified`.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.llm.common import schema_of, slices

#: Labelled documents per language that the n-gram table is fitted on, about.
SAMPLE = 1500
BUCKETS = 1 << 16
#: Languages that a model holds at most: the most frequent labels (the table has a column for each).
LANGUAGES = 256
ORDERS = 3
#: Bytes of text that a task labels at a time, about (its working set is some 60 times that).
SLICE = 3 << 19
#: Price of changing the language between two words, in nats.
PENALTY = 8.0
#: A language may use a script that holds this share of its training letters.
SCRIPT_SHARE = 0.005
UND = "und"

# First code point of each script range (Unicode blocks) and its script number.
_SCRIPTS = [
    (0x0000, 1), (0x0370, 2), (0x0400, 3), (0x0530, 4), (0x0590, 5), (0x0600, 6), (0x0700, 0),
    (0x0750, 6), (0x0780, 0), (0x08A0, 6), (0x0900, 7), (0x0980, 8), (0x0A00, 9), (0x0A80, 10),
    (0x0B00, 11), (0x0B80, 12), (0x0C00, 13), (0x0C80, 14), (0x0D00, 15), (0x0D80, 16), (0x0E00, 17),
    (0x0E80, 18), (0x0F00, 19), (0x1000, 20), (0x10A0, 21), (0x1100, 22), (0x1200, 23), (0x13A0, 0),
    (0x1780, 24), (0x1800, 25), (0x18B0, 0), (0x1E00, 1), (0x1F00, 2), (0x2000, 0), (0x2C60, 1),
    (0x2C80, 0), (0x2DE0, 3), (0x2E00, 0), (0x3040, 26), (0x3100, 27), (0x3130, 22), (0x3190, 27),
    (0x31F0, 26), (0x3200, 0), (0x3400, 27), (0xA000, 0), (0xA640, 3), (0xA6A0, 0), (0xA720, 1),
    (0xA800, 0), (0xAB30, 1), (0xAB70, 0), (0xAC00, 22), (0xD800, 0), (0xF900, 27), (0xFB00, 1),
    (0xFB07, 0), (0xFB1D, 5), (0xFB50, 6), (0xFE00, 0), (0xFE70, 6), (0xFF00, 1), (0xFF66, 26),
    (0xFFA0, 22), (0xFFE0, 0), (0x20000, 27), (0x32000, 0),
]
N_SCRIPTS = 28

_TABLES: list[np.ndarray] = []


def _tables() -> tuple[np.ndarray, np.ndarray]:
    """Per code point: its lower-case letter (0 if it is no letter), and its script."""
    if not _TABLES:
        lower = np.zeros(0x110000, np.uint32)
        for c in range(0x33480):
            ch = chr(c)
            if ch.isalpha():
                low = ch.lower()
                lower[c] = ord(low) if len(low) == 1 else c
        starts = np.array([a for a, _ in _SCRIPTS])
        kinds = np.array([k for _, k in _SCRIPTS], np.uint8)
        script = kinds[np.searchsorted(starts, np.arange(0x110000), "right") - 1]
        _TABLES.extend([lower, script])
    return _TABLES[0], _TABLES[1]


@dataclass
class Words:
    """Letter runs of some texts laid end to end."""

    letters: np.ndarray       # lower-case letter per code point, 0 between words
    script: np.ndarray        # per word, of its first letter
    start: np.ndarray         # of each word, in the joined texts
    size: np.ndarray          # letters of each word
    doc: np.ndarray           # text of each word
    base: np.ndarray          # start of each text in the joined texts


def split_words(texts: list[str]) -> Words:
    lower, script = _tables()
    joined = "\n".join(texts) + "\n"
    points = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)
    letters = lower[points]
    inside = letters != 0
    start = np.flatnonzero(inside & ~np.r_[False, inside[:-1]])
    size = np.flatnonzero(inside & ~np.r_[inside[1:], False]) + 1 - start
    lengths = np.fromiter(map(len, texts), np.int64, len(texts))
    base = np.r_[0, np.cumsum(lengths + 1)[:-1]]
    return Words(letters, script[points[start]], start, size, np.searchsorted(base, start, "right") - 1, base)


def word_grams(w: Words) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of the n-grams that end at each place of a word and at the place behind it,
    one row per order; and the first such place of each word."""
    inside = w.letters != 0
    here = w.letters[inside | np.r_[False, inside[:-1]]]       # words, each with one 0 behind it
    value = np.empty((ORDERS, len(here)), np.uint16)
    mixed, at = np.full(len(here), 0x811C9DC5, np.uint32), here
    for n in range(ORDERS):
        if n:       # one place back; 0 in front of the word, as behind it
            before = np.zeros_like(here)
            before[n:] = here[:-n]
            at = np.where(at != 0, before, 0) if n > 1 else before
        mixed = (mixed ^ at) * np.uint32(0x01000193)
        mixed ^= mixed >> np.uint32(15)
        value[n] = (mixed + np.uint32(n * 0x9E3779B1 % 2 ** 32)) * np.uint32(0x85EBCA6B) >> np.uint32(16)
    return value, np.cumsum(w.size + 1) - (w.size + 1)


@dataclass
class Model:
    langs: list[str]
    prior: int                # most frequent language
    weight: np.ndarray        # BUCKETS x languages: log of the smoothed share
    allowed: np.ndarray       # scripts x languages

    def word_scores(self, w: Words) -> np.ndarray:
        """Words x languages; 0 throughout where the script leaves no language."""
        grams, first = word_grams(w)
        each = self.weight[grams[0]]
        for row in grams[1:]:
            each += self.weight[row]
        total = np.add.reduceat(each, first, axis=0) / len(grams)
        may = self.allowed[w.script]
        total = np.where(may, total, np.float32(-1e4))
        total[~may.any(axis=1)] = 0
        return total


def viterbi(scores: np.ndarray, doc: np.ndarray, n_docs: int, penalty: float) -> np.ndarray:
    """Best label per word.  ``doc`` (sorted) says which text a word belongs to.  All texts step
    together, longest first: the words are laid out step by step, so that a step is a few
    operations on one slice."""
    count = np.bincount(doc, minlength=n_docs)
    order = np.argsort(-count, kind="stable")
    rank = np.empty(n_docs, np.int64)
    rank[order] = np.arange(n_docs)
    steps = int(count.max(initial=0))
    live = np.searchsorted(-count[order], -np.arange(1, steps + 1), "right")   # texts with over t words
    begin = np.r_[0, np.cumsum(live)]
    place = begin[np.arange(len(doc)) - (np.cumsum(count) - count)[doc]] + rank[doc]
    laid = np.empty((len(doc), scores.shape[1]))
    laid[place] = scores
    stays = np.empty(laid.shape, bool)          # whether a state is reached from itself
    tops = np.empty(len(doc), np.int16)          # the state that the others are reached from
    best = np.zeros((n_docs, scores.shape[1]))
    for t in range(steps):
        a, b = begin[t], begin[t + 1]
        now = best[: b - a]
        if t:
            jump = now.max(axis=1, keepdims=True) - penalty
            tops[a:b] = now.argmax(axis=1)
            np.greater_equal(now, jump, out=stays[a:b])
            np.maximum(now, jump, out=now)
        now += laid[a:b]
    state = best.argmax(axis=1).astype(np.int16)
    found, row = np.empty(len(doc), np.int16), np.arange(n_docs)
    for t in range(steps - 1, -1, -1):
        a, b = begin[t], begin[t + 1]
        now = state[: b - a]
        found[a:b] = now
        if t:
            state[: b - a] = np.where(stays[a:b][row[: b - a], now], now, tops[a:b])
    return found[place]


def label_texts(texts: list[str | None], model: Model, penalty: float) -> tuple[list[str], np.ndarray, pa.Array]:
    """Predicted language, score (its share of all letters of the text), and spans per text."""
    w = split_words([t or "" for t in texts])
    n, k = len(texts), len(model.langs)
    kind = pa.struct([("lang", pa.string()), ("start", pa.int64()), ("end", pa.int64())])
    if not k or not len(w.start):
        seen = np.bincount(w.doc, minlength=n) > 0
        return ([UND if not (s and k) else model.langs[model.prior] for s in seen], np.zeros(n),
                pa.array([[]] * n, pa.list_(kind)))
    scores = model.word_scores(w)
    labels = viterbi(scores, w.doc, n, penalty)
    evident = model.allowed[w.script].any(axis=1)
    share = np.bincount(w.doc * k + labels, np.where(evident, w.size, 0), n * k).reshape(n, k)
    total, letters = share.sum(axis=1), np.bincount(w.doc, w.size, n)
    any_word = letters > 0
    best = np.where(total > 0, share.argmax(axis=1), model.prior)
    score = share.max(axis=1) / np.maximum(letters, 1)
    cut = np.flatnonzero(np.r_[True, (labels[1:] != labels[:-1]) | (w.doc[1:] != w.doc[:-1])])
    last = np.r_[cut[1:] - 1, len(labels) - 1]
    doc = w.doc[cut]
    spans = pa.StructArray.from_arrays(
        [pa.array(model.langs).take(pa.array(labels[cut])), pa.array(w.start[cut] - w.base[doc]),
         pa.array(w.start[last] + w.size[last] - w.base[doc])], fields=list(kind))
    offsets = np.r_[0, np.cumsum(np.bincount(doc, minlength=n))].astype(np.int32)
    return ([model.langs[b] if s else UND for b, s in zip(best, any_word)], score,
            pa.ListArray.from_arrays(pa.array(offsets), spans))


def train(labelled: DataFrame, sample: int = SAMPLE) -> Model:
    """Fit on ``labelled`` (``doc_id``, ``text``, ``lang``; rows with a null language or text are
    passed over)."""
    rows = labelled.where(F.col("lang").isNotNull() & F.col("text").isNotNull()).select("doc_id", "text", "lang")
    most = rows.groupBy("lang").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "lang").limit(LANGUAGES)
    count = {r["lang"]: r["n"] for r in most.collect()}
    langs = sorted(count)
    if not langs:
        return Model([], 0, np.zeros((BUCKETS, 0), np.float32), np.zeros((N_SCRIPTS, 0), bool))
    bar = F.lit(0)
    for x in langs:
        bar = F.when(F.col("lang") == x, max(1, min(1 << 20, int(sample / count[x] * (1 << 20))))).otherwise(bar)
    chosen = rows.where(F.pmod(F.xxhash64(F.lit("langid"), "doc_id"), F.lit(1 << 20)) < bar)

    def tally(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """(language, bucket, count); buckets from BUCKETS on count letters by script."""
        sums = np.zeros((len(langs), BUCKETS + N_SCRIPTS), np.int64)
        for batch in (s for b in batches for s in slices(b)):
            names = np.array(batch.column("lang").to_pylist())
            for i, lang in enumerate(langs):
                texts = batch.column("text").filter(pa.array(names == lang)).to_pylist()
                w = split_words(texts)
                if len(w.start):
                    sums[i, :BUCKETS] += np.bincount(word_grams(w)[0].ravel(), minlength=BUCKETS)
                    sums[i, BUCKETS:] += np.bincount(w.script, w.size, N_SCRIPTS).astype(np.int64)
        i, j = np.nonzero(sums)
        yield pa.RecordBatch.from_arrays([pa.array(i), pa.array(j), pa.array(sums[i, j])], ["lang", "bucket", "n"])

    table = (chosen.mapInArrow(tally, "lang long, bucket long, n long")
             .groupBy("lang", "bucket").agg(F.sum("n").alias("n")).toArrow())   # at most languages x buckets rows
    sums = np.zeros((len(langs), BUCKETS + N_SCRIPTS))
    sums[table.column("lang").to_numpy(), table.column("bucket").to_numpy()] = table.column("n").to_numpy()
    grams, letters = sums[:, :BUCKETS], sums[:, BUCKETS:]
    share = (grams + 0.5) / (grams.sum(axis=1, keepdims=True) + 0.5 * BUCKETS)
    weight = np.log(share) - np.log(share).mean(axis=0)
    allowed = letters > SCRIPT_SHARE * np.maximum(letters.sum(axis=1, keepdims=True), 1)
    allowed[:, 0] = False
    prior = max(range(len(langs)), key=lambda i: (count[langs[i]], -i))
    return Model(langs, prior, np.ascontiguousarray(weight.T, np.float32), np.ascontiguousarray(allowed.T))


def predict(docs: DataFrame, model: Model, penalty: float = PENALTY) -> DataFrame:
    """``doc_id``, ``lang_pred``, ``score`` and ``spans`` (language, first and last place) per row."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    added = "lang_pred string, score double, spans array<struct<lang: string, start: long, end: long>>"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (s for b in batches for s in slices(b, limit=SLICE)):
            lang, score, spans = label_texts(batch.column("text").to_pylist(), shared.value, penalty)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(lang), pa.array(score), spans],
                                             ["doc_id", "lang_pred", "score", "spans"])

    return docs.select("doc_id", "text").mapInArrow(run, schema_of(docs, ["doc_id"], added))


def keep_identified(docs: DataFrame, model: Model, least: float = 0.5, penalty: float = PENALTY) -> DataFrame:
    """Rows of ``docs`` whose language is identified with a score of at least ``least``."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (s for b in batches for s in slices(b, limit=SLICE)):
            lang, score, _ = label_texts(batch.column("text").to_pylist(), shared.value, penalty)
            yield batch.filter(pa.array([x != UND and s >= least for x, s in zip(lang, score)]))

    return docs.mapInArrow(run, docs.schema)
