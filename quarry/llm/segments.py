"""Exact top-k inner-product search with multi-resolution segment statistics.

For a query q and a candidate c, cut into segments of l components with means m and deviations
s, the squared distance is at least the sum over segments of l * ((m_q-m_c)^2 + (s_q-s_c)^2).
As |q-c|^2 = |q|^2 + |c|^2 - 2 q.c, a lower bound of the distance is an upper bound of the inner
product.  Candidates are pruned coarse to fine (one segment, then shorter ones) against the
k-th best score known, and survivors are scored exactly, in integers.

The same bounds keep queries from being sent where they can find nothing.  Candidates are dealt to
cells, each around the nearest of a bounded number of pivots, and every cell keeps the box (least
and largest value) of its members' statistics at each resolution; the bound over a box holds for all
of them.  A cell is cut into blocks of about ``block_rows`` by id, and a task holds one block and
streams queries over it.  A query first searches the block of its own row; with the k-th best
score found there, or over a bounded seed of candidates, it is sent on to just those other blocks
whose box may hold as good a score.  Pivots and boxes decide the cost only: every row is indexed.

Defined cases: a vector that is null or holds a null or non-finite component takes no part, nor
does a row with a null id; of rows that repeat an id the least vector is used, once; vectors of
unequal length compare as if padded with zeros; ties go to the smaller id; a query with
fewer than k other vectors returns them all.  Components are floor(scale * x); scores must fit a
long.  Extra columns are ignored.  An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quarry.llm.common import written

SCALE = 1024
BLOCK_ROWS = 8192
SEED_ROWS = 1024
#: Rows of a cell that are aimed at, and the most cells (boxes that the driver holds).
CELL_ROWS, MAX_CELLS = 8192, 4096
#: Pairs of query and block that are written out at once.
ROUTED = 1 << 18
#: Segment lengths from coarse to fine; 0 is the whole vector.
RESOLUTIONS = (0, 16, 4)


def integer_vectors(df: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding",
                    scale: int = SCALE) -> DataFrame:
    """``vec_id`` and ``v`` (array of long), one row per id with a usable vector."""
    whole = F.transform(F.col(vec_col), lambda x: F.floor(x.cast("double") * scale).cast("long"))
    usable = F.forall(F.col(vec_col), lambda x: F.coalesce(F.abs(x.cast("double")) < float("inf"), F.lit(False)))
    return (df.where(F.col(id_col).isNotNull() & F.col(vec_col).isNotNull() & usable)
            .select(F.col(id_col).cast("long").alias("vec_id"), whole.alias("v"))
            .groupBy("vec_id").agg(F.min("v").alias("v")))


def _matrix(lists: pa.Array, dims: int = 0) -> np.ndarray:
    """Rows of an Arrow list column, padded with zeros to at least ``dims`` (a multiple of 16)."""
    size = lists.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
    wide = max(dims, int(size.max(initial=0)), 1)
    wide = -(-wide // 16) * 16
    out = np.zeros((len(size), wide), np.int64)
    row = np.repeat(np.arange(len(size)), size)
    col = np.arange(len(row)) - np.repeat(np.cumsum(size) - size, size)
    out[row, col] = lists.flatten().to_numpy(zero_copy_only=False)
    return out


def _pad(m: np.ndarray, dims: int) -> np.ndarray:
    return m if m.shape[1] == dims else np.pad(m, ((0, 0), (0, dims - m.shape[1])))


def statistics(m: np.ndarray) -> list[np.ndarray]:
    """Per resolution: sqrt(l) * (means, deviations) of the segments of each row."""
    out = []
    for step in RESOLUTIONS:
        length = step or m.shape[1]
        seg = m.reshape(len(m), -1, length).astype(np.float64)
        out.append(np.concatenate([seg.mean(axis=2), seg.std(axis=2)], axis=1) * np.sqrt(length))
    return out


def _scores(cands: np.ndarray, query: np.ndarray) -> np.ndarray:
    """Exact integer inner products (in doubles only where these are exact)."""
    top = float(np.abs(cands).max(initial=0)) * float(np.abs(query).max(initial=0)) * len(query)
    if top < 2 ** 53:
        return (cands.astype(np.float64) @ query.astype(np.float64)).astype(np.int64)
    return cands @ query


class Block:
    """A block of candidates with their statistics."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray) -> None:
        self.ids, self.vectors = ids, vectors
        self.stats = statistics(vectors)
        self.exact = vectors.astype(np.float64)
        self.top = float(np.abs(vectors).max(initial=0))

    def widen(self, dims: int) -> "Block":
        return self if dims <= self.vectors.shape[1] else Block(self.ids, _pad(self.vectors, dims))

    def search(self, own: int, query: np.ndarray, stats: list[np.ndarray], floor: float, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids and scores of the best ``k`` here whose score is at least ``floor``."""
        slack = 1.0 + 1e-9 * (self.top * float(np.abs(query).max(initial=0)) * len(query))
        at = np.flatnonzero(self.ids != own)
        for c, q in zip(self.stats, stats):
            bound = c[at] @ q + slack if len(at) < len(self.ids) - 1 else (c @ q)[at] + slack
            at = at[bound >= floor]
        if len(at) > 8 * k:          # the most promising few raise the floor for the others
            bound = self.stats[-1][at] @ stats[-1]
            head = at[np.argpartition(-bound, 4 * k)[: 4 * k]]
            known = np.sort(_scores(self.vectors[head], query))
            floor = max(floor, float(known[-k]))
            at = at[bound + slack >= floor]
        score = _scores(self.vectors[at], query)
        good = score >= floor
        at, score = at[good], score[good]
        best = np.lexsort((self.ids[at], -score))[:k]
        return self.ids[at[best]], score[best]


class Boxes:
    """Least and largest statistics of every cell, its number of rows and where its blocks start."""

    def __init__(self, cells: np.ndarray, rows: np.ndarray, top: np.ndarray, low: np.ndarray, high: np.ndarray,
                 block_rows: int) -> None:
        self.cells, self.low, self.high = cells, low, high
        self.top = float(top.max(initial=0))
        self.blocks = -(-rows // block_rows)
        self.first = np.cumsum(self.blocks) - self.blocks

    def bounds(self, rows: np.ndarray) -> np.ndarray:
        """Queries x cells: no member of the cell has a larger inner product with the query."""
        stats, at = statistics(rows), 0
        slack = 1.0 + 1e-9 * self.top * np.abs(rows).max(axis=1, initial=0).astype(np.float64) * rows.shape[1]
        best = np.full((len(rows), len(self.cells)), np.inf)
        for q in stats:
            low, high = self.low[:, at:at + q.shape[1]], self.high[:, at:at + q.shape[1]]
            best = np.minimum(best, np.maximum(q, 0) @ high.T + np.minimum(q, 0) @ low.T)
            at += q.shape[1]
        return best + slack[:, None]


def _assign(batches: Iterator[pa.RecordBatch], pivots: np.ndarray) -> Iterator[pa.RecordBatch]:
    """Adds the nearest pivot."""
    half = (pivots ** 2).sum(axis=1) / 2
    for batch in batches:
        rows = _matrix(batch.column("v"), pivots.shape[1]).astype(np.float64)
        cell = np.argmin(half - rows @ pivots.T, axis=1).astype(np.int32)
        yield pa.RecordBatch.from_arrays([batch.column("vec_id"), batch.column("v"), pa.array(cell)],
                                         ["vec_id", "v", "cell"])


_BOX = "cell int, n long, top double, low array<double>, high array<double>"


def _box_batch(cells: np.ndarray, rows: np.ndarray, top: np.ndarray, low: np.ndarray, high: np.ndarray) -> pa.RecordBatch:
    wide = low.shape[1]
    arrays = [pa.FixedSizeListArray.from_arrays(pa.array(x.ravel()), wide).cast(pa.list_(pa.float64())) for x in (low, high)]
    return pa.RecordBatch.from_arrays([pa.array(cells.astype(np.int32)), pa.array(rows.astype(np.int64)), pa.array(top), *arrays],
                                      ["cell", "n", "top", "low", "high"])


def _boxes(batches: Iterator[pa.RecordBatch], cells: int, dims: int) -> Iterator[pa.RecordBatch]:
    """One row per cell met in this partition."""
    rows, top, low, high = np.zeros(cells, np.int64), np.zeros(cells), None, None
    for batch in batches:
        m = _matrix(batch.column("v"), dims)
        stats = np.concatenate(statistics(m), axis=1)
        if low is None:
            low, high = np.full((cells, stats.shape[1]), np.inf), np.full((cells, stats.shape[1]), -np.inf)
        cell = batch.column("cell").to_numpy()
        order = np.argsort(cell, kind="stable")
        found, start, n = np.unique(cell[order], return_index=True, return_counts=True)
        if len(found):
            rows[found] += n
            top[found] = np.maximum(top[found], np.maximum.reduceat(np.abs(m).max(axis=1)[order], start))
            low[found] = np.minimum(low[found], np.minimum.reduceat(stats[order], start))
            high[found] = np.maximum(high[found], np.maximum.reduceat(stats[order], start))
    met = np.flatnonzero(rows)
    if len(met):
        yield _box_batch(met, rows[met], top[met], low[met], high[met])


def _box_arrays(table: pa.Table) -> tuple[np.ndarray, ...]:
    edges = [np.array(table.column(c).combine_chunks().flatten()).reshape(table.num_rows, -1) if table.num_rows
             else np.zeros((0, 0)) for c in ("low", "high")]
    return (*[np.array(table.column(c)) for c in ("cell", "n", "top")], *edges)


def _merged(table: pa.Table) -> pa.Table:
    cell, n, top, low, high = _box_arrays(table)
    return pa.Table.from_batches([_box_batch(cell[:1], n.sum(keepdims=True), top.max(keepdims=True),
                                             low.min(axis=0, keepdims=True), high.max(axis=0, keepdims=True))])


def _with_floor(batches: Iterator[pa.RecordBatch], ids: np.ndarray, seed: np.ndarray, k: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        floors = []
        own = batch.column("vec_id").to_numpy()
        rows = _matrix(batch.column("v"), seed.shape[1])
        wide = _pad(seed, rows.shape[1])
        for i in range(len(own)):
            s = _scores(wide[ids != own[i]], rows[i])
            floors.append(float(np.partition(s, -k)[-k]) if len(s) >= k else float("-inf"))
        yield pa.RecordBatch.from_arrays([batch.column("block"), batch.column("vec_id"), batch.column("v"),
                                          pa.array(floors, pa.float64())], ["block", "vec_id", "v", "floor"])


def _elsewhere(batches: Iterator[pa.RecordBatch], boxes: Boxes, dims: int) -> Iterator[pa.RecordBatch]:
    """Per query the blocks, but for its own, that its floor does not rule out."""
    all_blocks = int(boxes.blocks.sum())
    step = max(1, ROUTED // max(1, all_blocks))
    cell_of = np.repeat(np.arange(len(boxes.cells)), boxes.blocks)
    for batch in batches:
        for lo in range(0, batch.num_rows, step):
            part = batch.slice(lo, step)
            own, floors = part.column("block").to_numpy(), part.column("floor").to_numpy()
            open_cells = boxes.bounds(_matrix(part.column("v"), dims)) >= floors[:, None]
            open_blocks = open_cells[:, cell_of]
            open_blocks[np.arange(len(own)), own] = False
            query, block = np.nonzero(open_blocks)
            ends = np.r_[0, np.cumsum(np.bincount(query, minlength=len(own)))]
            yield pa.RecordBatch.from_arrays(
                [pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.array(block.astype(np.int32))),
                 part.column("vec_id"), part.column("v"), part.column("floor")], ["blocks", "vec_id", "v", "floor"])


def _search(batches: Iterator[pa.RecordBatch], k: int) -> Iterator[pa.RecordBatch]:
    """Rows come sorted by (block, query): the block's candidates, then all queries."""
    key, held, block = None, [], None
    for batch in batches:
        b, q = batch.column("block").to_numpy(), batch.column("query").to_numpy(zero_copy_only=False)
        cuts = np.flatnonzero(np.r_[True, (b[1:] != b[:-1]) | (q[1:] != q[:-1])])
        for lo, hi in zip(cuts, np.r_[cuts[1:], len(b)]):
            if b[lo] != key:
                key, held, block = b[lo], [], None
            part = batch.slice(lo, hi - lo)
            if not q[lo]:
                held.append((part.column("vec_id").to_numpy().copy(), _matrix(part.column("v"))))
                continue
            if block is None:
                dims = max((m.shape[1] for _, m in held), default=16)
                block = Block(np.concatenate([i for i, _ in held] or [np.zeros(0, np.int64)]),
                              np.concatenate([_pad(m, dims) for _, m in held] or [np.zeros((0, dims), np.int64)]))
                held = []
            rows = _matrix(part.column("v"), block.vectors.shape[1])
            block = block.widen(rows.shape[1])
            stats = statistics(rows)
            ids, floors = part.column("vec_id").to_numpy(), part.column("floor").to_numpy()
            out = [block.search(ids[i], rows[i], [s[i] for s in stats], floors[i], k) for i in range(len(ids))]
            n = [len(x) for x, _ in out]
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.repeat(ids, n)), pa.array(np.concatenate([x for x, _ in out])),
                 pa.array(np.concatenate([s for _, s in out]))], ["query_id", "vec_id", "score"])


class Index:
    """All vectors (from :func:`integer_vectors`) by cell and block: ``rows`` has ``vec_id``, ``v``,
    ``block``; with the boxes of the cells and the seed."""

    def __init__(self, vectors: DataFrame, block_rows: int = BLOCK_ROWS, seed_rows: int = SEED_ROWS,
                 cell_rows: int = CELL_ROWS) -> None:
        spark = vectors.sparkSession
        held = written(spark, vectors, "topk-vectors")
        size = held.agg(F.count(F.lit(1)).alias("n"), F.max(F.size("v")).alias("dims")).first()
        dims = -(-max(size["dims"] or 0, 1) // 16) * 16
        cells = min(MAX_CELLS, max(1, -(-size["n"] // cell_rows)))
        sample = held.orderBy(F.xxhash64("vec_id"), "vec_id").limit(max(seed_rows, cells)).toArrow()
        matrix = _matrix(sample.column("v").combine_chunks(), dims)
        self.dims, self.partitions = dims, max(1, -(-size["n"] // block_rows))
        self.seed_ids, self.seed = sample.column("vec_id").to_numpy()[:seed_rows], matrix[:seed_rows]
        pivots = matrix[:cells].astype(np.float64) if len(matrix) else np.zeros((1, dims))

        celled = written(spark, held.mapInArrow(lambda it: _assign(it, pivots), "vec_id long, v array<long>, cell int"),
                         "topk-cells")
        partial = celled.select("cell", "v").mapInArrow(lambda it: _boxes(it, len(pivots), dims), _BOX)
        found = partial.groupBy("cell").applyInArrow(_merged, _BOX).orderBy("cell").toArrow()   # MAX_CELLS rows at most
        self.boxes = Boxes(*_box_arrays(found), block_rows)
        places = spark.createDataFrame(
            [(int(c), int(f), int(b)) for c, f, b in zip(self.boxes.cells, self.boxes.first, self.boxes.blocks)],
            "cell int, first int, parts int")
        self.rows = celled.join(F.broadcast(places), "cell").select(
            (F.col("first") + F.pmod(F.xxhash64("vec_id"), F.col("parts"))).cast("int").alias("block"), "vec_id", "v")

    def first_queries(self, is_query: Column, k: int) -> DataFrame:
        """``block`` (that of the query's own row), ``vec_id``, ``v``, ``floor`` (over the seed)."""
        ids, seed = self.seed_ids, self.seed
        return self.rows.where(is_query).mapInArrow(
            lambda it: _with_floor(it, ids, seed, k), "block int, vec_id long, v array<long>, floor double")

    def other_queries(self, queries: DataFrame) -> DataFrame:
        """The queries once for every other block that may hold a score of their floor."""
        boxes, dims = self.boxes, self.dims
        sent = queries.mapInArrow(lambda it: _elsewhere(it, boxes, dims),
                                  "blocks array<int>, vec_id long, v array<long>, floor double")
        return sent.select(F.explode("blocks").alias("block"), "vec_id", "v", "floor")

    def searched(self, queries: DataFrame, k: int) -> DataFrame:
        """``query_id``, ``vec_id``, ``score``: the best ``k`` of every block a query was sent to."""
        streamed = (self.rows.select("block", F.lit(False).alias("query"), "vec_id", "v", F.lit(None).cast("double").alias("floor"))
                    .unionByName(queries.select("block", F.lit(True).alias("query"), "vec_id", "v", "floor"))
                    .repartition(self.partitions, "block").sortWithinPartitions("block", "query", "vec_id"))
        return streamed.mapInArrow(lambda it: _search(it, k), "query_id long, vec_id long, score long")


def raised(queries: DataFrame, found: DataFrame, k: int) -> DataFrame:
    """``queries`` with the ``k``-th best score in ``found``, where there is one, as their floor."""
    known = (found.groupBy(F.col("query_id").alias("vec_id")).agg(F.count(F.lit(1)).alias("_n"), F.min("score").alias("_kth"))
             .where(F.col("_n") >= k).select("vec_id", F.col("_kth").cast("double").alias("_kth")))
    return (queries.join(known, "vec_id", "left")
            .select("block", "vec_id", "v", F.greatest("floor", "_kth").alias("floor")))


def top_k(vectors: DataFrame, is_query: Column, k: int = 10, block_rows: int = BLOCK_ROWS,
          seed_rows: int = SEED_ROWS, cell_rows: int = CELL_ROWS) -> DataFrame:
    """``query_id``, ``rank`` (from 1), ``vec_id``, ``score``: for every row of ``vectors`` (from
    :func:`integer_vectors`) that satisfies ``is_query``, its ``k`` best others."""
    spark = vectors.sparkSession
    index = Index(vectors, block_rows, seed_rows, cell_rows)
    queries = written(spark, index.first_queries(is_query, k), "topk-queries")
    near = written(spark, index.searched(queries, k), "topk-near")
    found = near.unionByName(index.searched(index.other_queries(raised(queries, near, k)), k))
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
            .select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score"))
