"""Quality by compression: zstandard dictionaries of good and of bad labelled text.

A text is cut into consecutive blocks of ``BLOCK`` bytes and every block is compressed afresh with
either dictionary, so that late text meets the dictionaries and not the text's own history.  The
difference of the two sizes (sums over all blocks), normalised by their sum and by the text's length,
and the better compression rate are calibrated to a probability of label 1 by a logistic fit on
labelled documents that the dictionaries have not seen.

Dictionaries and calibration are fitted on a sample of labelled documents (``SAMPLE`` per label at
most, about, by a hash of the id), of which about ``DICTIONARY_SOURCE`` bytes per label, blocks chosen by
a hash, go into a dictionary.  Scoring covers whole texts.

Defined cases: null text counts as empty and scores by the calibration at 0 bytes; null labels are
passed over, labels that repeat an id are averaged; without labels of both kinds every score is
next to the only label (0.5 without any); a dictionary of too little text is that text itself;
repeated rows and null ids score like others; extra columns are ignored by :func:`score` and kept by
:func:`keep_good`.  An empty table gives an empty result.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.llm.common import per_worker, schema_of, slices, utf8

SAMPLE = 4000
DICTIONARY_SOURCE = 8 << 20
DICTIONARY_SIZE = 112640
LEVEL = 3
#: Bytes that are compressed in one piece.
BLOCK = 16 << 10
#: Bytes added to a length before dividing by it.
SMOOTH = 32


def build_dictionary(texts: list[bytes]) -> bytes:
    """A trained dictionary (as bytes), or the texts themselves where they are too few."""
    parts = [t[i:i + 4096] for t in texts for i in range(0, len(t), 4096)]
    try:
        return zstandard.train_dictionary(DICTIONARY_SIZE, parts).as_bytes()
    except zstandard.ZstdError:
        return b"\n".join(texts)[-DICTIONARY_SIZE:] or b"\n" * 8


class Sizes:
    """Compressed sizes of a text, block by block, with the good and the bad dictionary."""

    def __init__(self, good: bytes, bad: bytes) -> None:
        self.compressors = []
        for raw in (good, bad):
            d = zstandard.ZstdCompressionDict(raw)
            d.precompute_compress(level=LEVEL)
            self.compressors.append(zstandard.ZstdCompressor(dict_data=d))

    def features(self, texts: list[bytes]) -> np.ndarray:
        good, bad = self.compressors
        s = np.zeros((len(texts), 3))
        for i, t in enumerate(texts):
            whole = memoryview(t)
            for a in range(0, max(len(t), 1), BLOCK):
                part = whole[a:a + BLOCK]
                s[i] += len(good.compress(part)), len(bad.compress(part)), len(part)
        gain = s[:, 1] - s[:, 0]
        return np.stack([gain / (s[:, 1] + s[:, 0]), gain / (s[:, 2] + SMOOTH),
                         s[:, :2].min(axis=1) / (s[:, 2] + SMOOTH)], axis=1)


@dataclass
class Model:
    good: bytes
    bad: bytes
    center: np.ndarray
    weight: np.ndarray
    bias: float

    def scores(self, features: np.ndarray) -> np.ndarray:
        z = (features - self.center) @ self.weight + self.bias
        return 1 / (1 + np.exp(-np.clip(z, -40, 40)))


def calibrate(x: np.ndarray, y: np.ndarray, weight: np.ndarray, ridge: float = 1e-3) -> tuple[np.ndarray, np.ndarray, float]:
    """Weighted logistic fit by Newton steps on standardised features: centre, weights, bias."""
    share = weight / weight.sum()
    center, scale = x.mean(axis=0), x.std(axis=0) + 1e-9
    a = np.c_[(x - center) / scale, np.ones(len(x))]
    w, keep = np.zeros(a.shape[1]), np.diag([ridge] * x.shape[1] + [ridge / 10])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(a @ w, -40, 40)))
        step = np.linalg.solve((a * (share * p * (1 - p))[:, None]).T @ a + keep, a.T @ (share * (p - y)) + keep @ w)
        size = np.abs(step).max()
        w -= step * min(1.0, 2.0 / max(size, 1e-12))
        if size < 1e-8:
            break
    return center, w[:-1] / scale, float(w[-1])


def dictionary_blocks(rows: DataFrame) -> list[bytes]:
    """Blocks of ``BLOCK`` bytes of the texts of ``rows``, about ``DICTIONARY_SOURCE`` bytes of them
    (all, if fewer), chosen by a hash of id and place: the same ones for any partitioning, from
    any part of a text."""
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    share = max(1, min(1 << 20, int(DICTIONARY_SOURCE / max(size, 1) * (1 << 20))))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (s for b in batches for s in slices(b)):
            for i, t in enumerate(utf8(batch.column("text"))):
                parts = [t[a:a + BLOCK] for a in range(0, len(t), BLOCK)]
                for a in range(0, len(parts), 512):
                    some = parts[a:a + 512]
                    yield pa.RecordBatch.from_arrays(
                        [batch.column("doc_id").take(pa.array(np.full(len(some), i))),
                         pa.array(np.arange(a, a + len(some))), pa.array(some, pa.binary())], ["doc_id", "place", "part"])

    parts = rows.mapInArrow(cut, schema_of(rows, ["doc_id"], "place long, part binary"))
    order = F.xxhash64(F.lit("dictionary"), "doc_id", "place")
    chosen = parts.select("*", order.alias("at")).where(F.pmod("at", F.lit(1 << 20)) < share).collect()
    # texts in the order of a hash: a trained dictionary takes its parts evenly from the whole list
    return [bytes(r["part"]) for r in sorted(chosen, key=lambda r: (r["at"], r["doc_id"], r["place"]))]


def train(sample: DataFrame) -> Model:
    """Fit on ``sample`` (``doc_id``, ``text``, ``label``; bounded, from
    :func:`quarry.llm.toxicity.labelled_texts`).  A half by hash makes the dictionaries."""
    count = {r["label"]: r["n"] for r in sample.groupBy("label").agg(F.count("*").alias("n")).collect()}
    if len(count) < 2:
        bias = 0.0 if not count else 40.0 if 1 in count else -40.0
        return Model(b"\n" * 8, b"\n" * 8, np.zeros(3), np.zeros(3), bias)
    part = F.pmod(F.xxhash64(F.lit("half"), "doc_id"), F.lit(2))
    texts = {label: dictionary_blocks(sample.where((part == 0) & (F.col("label") == label))) for label in (0, 1)}
    spark = sample.sparkSession
    model = Model(build_dictionary(texts[1]), build_dictionary(texts[0]), np.zeros(3), np.zeros(3), 0.0)
    shared, key = spark.sparkContext.broadcast(model), f"sizes-{uuid.uuid4().hex}"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sizes = per_worker(key, lambda: Sizes(shared.value.good, shared.value.bad))
        for batch in (s for b in batches for s in slices(b)):
            x = sizes.features(utf8(batch.column("text")))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("label"), batch.column("weight"), *[pa.array(c) for c in x.T]],
                ["doc_id", "label", "weight", "a", "b", "c"])

    other = sample.where(part == 1) if sample.where(part == 1).select("label").distinct().count() == 2 else sample
    table = other.mapInArrow(run, schema_of(sample, ["doc_id"], "label int, weight double, a double, b double, c double")).toArrow()
    table = table.sort_by([("doc_id", "ascending")])
    x = np.stack([table.column(c).to_numpy() for c in "abc"], axis=1)
    y = table.column("label").to_numpy().astype(float)
    model.center, model.weight, model.bias = calibrate(x, y, table.column("weight").to_numpy())
    return model


def score(docs: DataFrame, model: Model) -> DataFrame:
    """``doc_id`` and ``score`` per row."""
    shared, key = docs.sparkSession.sparkContext.broadcast(model), f"sizes-{uuid.uuid4().hex}"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sizes = per_worker(key, lambda: Sizes(shared.value.good, shared.value.bad))
        for batch in (s for b in batches for s in slices(b)):
            s = shared.value.scores(sizes.features(utf8(batch.column("text"))))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(s)], ["doc_id", "score"])

    return docs.select("doc_id", "text").mapInArrow(run, schema_of(docs, ["doc_id"], "score double"))


def keep_good(docs: DataFrame, model: Model, least: float) -> DataFrame:
    """Rows of ``docs`` that score at least ``least``; all columns kept."""
    shared, key = docs.sparkSession.sparkContext.broadcast(model), f"sizes-{uuid.uuid4().hex}"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sizes = per_worker(key, lambda: Sizes(shared.value.good, shared.value.bad))
        for batch in (s for b in batches for s in slices(b)):
            s = shared.value.scores(sizes.features(utf8(batch.column("text"))))
            yield batch.filter(pa.array(s >= least))

    return docs.mapInArrow(run, docs.schema)
