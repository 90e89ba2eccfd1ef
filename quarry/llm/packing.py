"""Best-fit sequence packing with a grouping genetic algorithm on islands.

Documents become pieces of at most ``capacity`` tokens; a full piece is a sequence of its own.
The other pieces are dealt to shards of about ``SHARD_PIECES`` by a hash, and every shard is
packed by several islands.  An island evolves a population of packings: crossover injects
whole well-filled sequences of one parent into the other, takes out the sequences that hold
duplicates of injected pieces, and best-fits the displaced pieces.  Between epochs the islands
of a shard pass their elite on in a ring.  The best packing of a shard stays; the pieces in its
badly filled sequences of all shards are dealt and packed once more.

Defined cases: null text counts as empty, and an empty text is one piece holding the end id;
repeated rows are packed as separate documents; a null ``doc_id`` is packed like any other;
extra columns are ignored.  An empty table gives an empty result.
"""

from __future__ import annotations

import bisect
import os
import re
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.llm.common import per_worker, schema_of, slices, written

CAPACITY = 1024
END_ID = 2
SHARD_PIECES = 4096
ISLANDS = 2
EPOCHS = 2
GENERATIONS = 8
POPULATION = 4
#: Sequences filled less than this are opened and packed once more over all shards.
WELL_FILLED = 0.97
#: White space in a row that ``tiktoken`` is not asked to take (100,000 work, 1,000,000 do not).
LONG_SPACE = 50000
_LONG_SPACE = re.compile(rf"(?<!\s)\s{{{LONG_SPACE}}}")


def vocabulary(name: str = "byte_bpe_50k.json") -> str:
    """Text of a public tokenizer file (about 1.5 MB)."""
    import public_tokenizers

    with open(public_tokenizers.path(name), encoding="utf-8") as f:
        return f.read()


# ---------------------------------------------------------------- pieces

class Encoder:
    """Ids of the byte-level BPE as little-endian unsigned 32-bit bytes.

    The vocabulary is read from the ``tokenizers`` JSON.  ``tiktoken`` over that same vocabulary
    gives equal ids in a third of the time (compared on every code point and on documents
    in the tests).  A text with a run of white space that its pattern engine cannot take, or that
    it refuses otherwise, goes through ``tokenizers`` itself.  With ``special_ids``, so does a text
    with the string of a special token, which has the one id there; without, it is ordinary text."""

    def __init__(self, vocabulary_json: str, special_ids: bool = False) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import json

        import tiktoken
        from public_tokenizers import PATTERN
        from tokenizers import Tokenizer

        self.full = Tokenizer.from_str(vocabulary_json)
        self.full.encode_special_tokens = not special_ids
        letters = _byte_letters()
        special = {t["content"] for t in json.loads(vocabulary_json).get("added_tokens", [])}
        self.special = sorted(special) if special_ids else []
        ranks = {bytes(letters[c] for c in token): i
                 for token, i in self.full.get_vocab(with_added_tokens=True).items() if token not in special}
        self.fast = tiktoken.Encoding("pieces", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})

    def __call__(self, text: str) -> np.ndarray:
        if not any(t in text for t in self.special) and not (len(text) >= LONG_SPACE and _LONG_SPACE.search(text)):
            try:
                return np.array(self.fast.encode_ordinary(text), "<u4")
            except BaseException as e:      # a text that the pattern engine gives up on
                # its Rust panics are no Exception, and their class cannot be imported
                if not isinstance(e, Exception) and type(e).__name__ != "PanicException":
                    raise
        return np.array(self.full.encode(text, add_special_tokens=False).ids, "<u4")


def _byte_letters() -> dict[str, int]:
    """Letter of the vocabulary file -> byte: printable bytes stand for themselves, the others
    for the letters from U+0100 on, in order."""
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in own]
    return {chr(b): b for b in own} | {chr(256 + i): b for i, b in enumerate(rest)}


def pieces(docs: DataFrame, vocabulary_json: str | None = None, capacity: int = CAPACITY,
           end_id: int = END_ID) -> DataFrame:
    """``doc_id``, ``piece``, ``start``, ``length``, ``ids_crc32`` per piece.  A document over
    ``capacity`` is cut from its end, so only its first piece may be shorter."""
    spark = docs.sparkSession
    shared, key = spark.sparkContext.broadcast(vocabulary_json or vocabulary()), f"encoder-{uuid.uuid4().hex}"
    schema = schema_of(docs, ["doc_id"], "piece int, start long, length long, ids_crc32 long")
    end = np.array([end_id], "<u4")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = per_worker(key, lambda: Encoder(shared.value, special_ids=True))
        for batch in (s for b in batches for s in slices(b)):
            rows, piece, start, length, crc = [], [], [], [], []
            for i, text in enumerate(batch.column("text").to_pylist()):
                ids = np.r_[encode(text or ""), end].astype("<u4")
                cuts = [0, *range(len(ids) % capacity or capacity, len(ids) + 1, capacity)]
                for k, (a, b) in enumerate(zip(cuts, cuts[1:])):
                    rows.append(i)
                    piece.append(k)
                    start.append(a)
                    length.append(b - a)
                    crc.append(zlib.crc32(ids[a:b].tobytes()))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").take(pa.array(rows, pa.int64())), pa.array(piece, pa.int32()),
                 pa.array(start, pa.int64()), pa.array(length, pa.int64()), pa.array(crc, pa.int64())],
                ["doc_id", "piece", "start", "length", "ids_crc32"])

    return docs.select("doc_id", "text").mapInArrow(run, schema)


# ---------------------------------------------------------------- one island

def best_fit(lengths: np.ndarray, order: np.ndarray, bins: np.ndarray, loads: list[int], capacity: int) -> None:
    """Place the pieces of ``order`` (bins[i] is set) each in the fullest sequence that takes it."""
    # a gap and its sequence as one number, ordered by the gap
    gaps = sorted((capacity - load) << 32 | k for k, load in enumerate(loads) if 0 < load < capacity)
    empty = [k for k, load in enumerate(loads) if load == 0]
    found = []
    for n in lengths[order].tolist():
        at = bisect.bisect_left(gaps, n << 32)
        if at < len(gaps):
            gap = gaps.pop(at) - (n << 32)
            k = gap & 0xFFFFFFFF
        else:
            if empty:
                k = empty.pop()
            else:
                k = len(loads)
                loads.append(0)
            gap = (capacity - n) << 32 | k
        found.append(k)
        loads[k] += n
        if gap >> 32:
            bisect.insort(gaps, gap)
    bins[order] = found


def compact(bins: np.ndarray) -> np.ndarray:
    return np.unique(bins, return_inverse=True)[1]


def fitness(lengths: np.ndarray, bins: np.ndarray, capacity: int) -> tuple[int, float]:
    """Fewer sequences first, then the mean squared filling."""
    loads = np.bincount(bins, lengths)
    loads = loads[loads > 0]
    return -len(loads), float(((loads / capacity) ** 2).mean()) if len(loads) else 0.0


def crossover(lengths: np.ndarray, giver: np.ndarray, taker: np.ndarray, rng: np.random.Generator,
              capacity: int) -> np.ndarray:
    """Inject some well-filled sequences of ``giver`` whole into ``taker``; open the sequences
    of ``taker`` that hold an injected piece; best-fit the displaced pieces."""
    loads = np.bincount(giver, lengths)
    chance = (loads / capacity) ** 8 * rng.random(len(loads))
    chosen = np.argsort(-chance)[: max(1, int(len(loads) * rng.uniform(0.05, 0.3)))]
    injected = np.isin(giver, chosen)
    opened = np.isin(taker, np.unique(taker[injected]))
    # some badly filled sequences are opened too, so that displaced pieces can mix
    mine = np.bincount(taker, lengths)
    worst = np.argsort(mine)[: max(1, len(mine) // 50)]
    opened |= np.isin(taker, worst) & ~injected
    child = np.where(injected, giver + len(mine), taker)
    displaced = np.flatnonzero(opened & ~injected)
    kept = np.ones(len(lengths), bool)
    kept[displaced] = False
    child[kept] = compact(child[kept])
    new = np.bincount(child[kept], lengths[kept]).astype(np.int64).tolist() if kept.any() else []
    order = displaced[np.argsort(-lengths[displaced], kind="stable")]
    best_fit(lengths, order, child, new, capacity)
    return compact(child)


def first_packing(lengths: np.ndarray, rng: np.random.Generator | None, capacity: int) -> np.ndarray:
    """Best fit by falling length; with ``rng``, the lengths are blurred first."""
    key = lengths if rng is None else lengths * rng.uniform(0.8, 1.0, len(lengths))
    bins = np.zeros(len(lengths), np.int64)
    best_fit(lengths, np.argsort(-key, kind="stable"), bins, [], capacity)
    return bins


def evolve(lengths: np.ndarray, population: list[np.ndarray], seed: int, generations: int,
           size: int, capacity: int) -> list[np.ndarray]:
    """The population, best first.  Stops at the lower bound of the number of sequences."""
    rng = np.random.default_rng(seed)
    least = -(-int(lengths.sum()) // capacity)
    rank = lambda p: fitness(lengths, p, capacity)
    population = sorted(population, key=rank, reverse=True)
    if population and -rank(population[0])[0] <= least:
        return population
    while len(population) < size:
        population.append(first_packing(lengths, rng if population else None, capacity))
    population.sort(key=rank, reverse=True)
    for _ in range(generations):
        if -rank(population[0])[0] <= least:
            break
        a, b = rng.choice(len(population), 2, replace=False)
        one = crossover(lengths, population[a], population[b], rng, capacity)
        two = crossover(lengths, population[b], population[a], rng, capacity)
        population = sorted([*population, one, two], key=rank, reverse=True)[:size]
    return population


# ---------------------------------------------------------------- islands over shards

_STATE = "shard long, island int, pids array<long>, lengths array<long>, bins array<array<int>>"


def _epoch(states: DataFrame, epoch: int, generations: int, size: int, capacity: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in (b.slice(i, 1) for b in batches for i in range(b.num_rows)):
            lengths = row.column("lengths")[0].values.to_numpy()
            held = row.column("bins")[0]
            before = [b.values.to_numpy().astype(np.int64) for b in held] if held.is_valid else []
            seed = zlib.crc32(f"{row.column('shard')[0]}/{row.column('island')[0]}/{epoch}".encode())
            now = evolve(lengths, before, seed, generations, size, capacity)
            flat = pa.array(np.concatenate(now).astype(np.int32))
            each = pa.ListArray.from_arrays(pa.array(np.arange(len(now) + 1) * len(lengths), pa.int32()), flat)
            bins = pa.ListArray.from_arrays(pa.array([0, len(now)], pa.int32()), each)
            yield pa.RecordBatch.from_arrays([*[row.column(c) for c in ("shard", "island", "pids", "lengths")], bins],
                                             ["shard", "island", "pids", "lengths", "bins"])

    return states.mapInArrow(run, _STATE)


def pack_shards(spark: SparkSession, items: DataFrame, salt: str, capacity: int = CAPACITY,
                shard_pieces: int = SHARD_PIECES, islands: int = ISLANDS, epochs: int = EPOCHS,
                generations: int = GENERATIONS, size: int = POPULATION) -> DataFrame:
    """``pid``, ``length``, ``shard``, ``bin`` (within the shard), ``offset``, ``fill`` for every row of
    ``items`` (``pid``, ``length``), all shorter than ``capacity``."""
    total = items.count()
    shards = max(1, round(total / shard_pieces))
    dealt = (items.withColumn("shard", F.pmod(F.xxhash64("pid", F.lit(salt)), F.lit(shards)))
             .groupBy("shard").agg(F.sort_array(F.collect_list(F.struct("pid", "length"))).alias("m")))
    spread = spark.sparkContext.defaultParallelism * 4
    states = (dealt.select("shard", F.explode(F.sequence(F.lit(0), F.lit(islands - 1))).alias("island"),
                           F.col("m.pid").alias("pids"), F.col("m.length").alias("lengths"),
                           F.lit(None).cast("array<array<int>>").alias("bins"))
              .repartition(min(shards * islands, max(spread, 200)), "shard", "island"))
    for epoch in range(epochs):
        states = _epoch(states, epoch, generations, size, capacity)
        # the ring: each island gets the elite of the one before it
        ring = states.groupBy("shard").agg(
            F.first("pids").alias("pids"), F.first("lengths").alias("lengths"),
            F.sort_array(F.collect_list(F.struct("island", "bins"))).alias("all"))
        if epoch < epochs - 1:
            before = F.expr(f"element_at(all, pmod(island - 1, {islands}) + 1).bins[0]")
            states = (ring.select("shard", F.posexplode("all").alias("island", "own"), "pids", "lengths", "all")
                      .select("shard", "island", "pids", "lengths",
                              F.concat(F.array(before), F.col("own.bins")).alias("bins"))
                      .repartition(min(shards * islands, max(spread, 200)), "shard", "island"))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in (b.slice(i, 1) for b in batches for i in range(b.num_rows)):
            lengths = row.column("lengths")[0].values.to_numpy()
            options = [b.values.to_numpy().astype(np.int64) for b in row.column("elite")[0]]
            bins = max(options, key=lambda b: fitness(lengths, b, capacity))
            order = np.argsort(bins, kind="stable")
            ends = np.cumsum(lengths[order])
            first = np.flatnonzero(np.r_[True, np.diff(bins[order]) != 0])
            base = np.repeat((ends - lengths[order])[first], np.diff(np.r_[first, len(order)]))
            offset = np.empty(len(order), np.int64)
            offset[order] = ends - lengths[order] - base
            fill = np.bincount(bins, lengths)[bins] / capacity
            yield pa.RecordBatch.from_arrays(
                [row.column("pids")[0].values, pa.array(lengths), pa.array(np.full(len(lengths), row.column("shard")[0].as_py())),
                 pa.array(bins), pa.array(offset), pa.array(fill)],
                ["pid", "length", "shard", "bin", "offset", "fill"])

    elite = F.transform("all", lambda x: x["bins"][0]).alias("elite")
    return ring.select("shard", "lengths", "pids", elite).mapInArrow(
        place, "pid long, length long, shard long, bin long, offset long, fill double")


def pack(docs: DataFrame, vocabulary_json: str | None = None, capacity: int = CAPACITY,
         shard_pieces: int = SHARD_PIECES) -> DataFrame:
    """Pieces of ``docs`` with ``sequence_id`` and ``offset``: sequences of at most ``capacity``
    tokens, gapless from offset 0."""
    spark = docs.sparkSession
    cut = pieces(docs, vocabulary_json, capacity).withColumn("pid", F.monotonically_increasing_id())
    cut = written(spark, cut, "packing-pieces")
    first = written(spark, pack_shards(spark, cut.where(F.col("length") < capacity).select("pid", "length"),
                                       "first", capacity, shard_pieces), "packing-first")
    loose = first.where(F.col("fill") < WELL_FILLED)
    again = written(spark, pack_shards(spark, loose.select("pid", "length"), "again", capacity, shard_pieces),
                    "packing-again")
    number = lambda kind: F.col("shard") * (1 << 24) * 2 + F.col("bin") * 2 + kind
    placed = (first.where(F.col("fill") >= WELL_FILLED).select("pid", number(0).alias("sequence_id"), "offset")
              .unionByName(again.select("pid", number(1).alias("sequence_id"), "offset")))
    rest = cut.where(F.col("length") < capacity).join(placed, "pid")
    full = cut.where(F.col("length") >= capacity).select(
        "*", (-F.col("pid") - 1).alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
    columns = ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]
    return full.select(columns).unionByName(rest.select(columns))
