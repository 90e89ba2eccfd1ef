"""Whitening of embeddings through a bidiagonal singular value decomposition.

The rows, centred on their exact mean, are reduced by QR block after block, in every task and
then across tasks, to one triangle R (d x d): its singular values squared over n are the
eigenvalues of the covariance, which is never formed, so small ones keep their digits.  On the
driver, where only R and the sums are (d x d numbers, whatever the number of rows):

* Householder reflections from both sides make R bidiagonal;
* dqds (quotient-difference steps with shifts, which only add, multiply and divide positive
  numbers) finds its singular values to high relative accuracy;
* a twisted factorisation, run from both ends to where they meet best, gives each direction.

A last pass projects the rows.

Defined cases: rows whose vector is null or holds a null or non-finite entry are dropped; a row
with a null id stays, and so do repeated rows, each counted; a vector shorter than the longest is read
as if its missing entries were 0; directions of (numerically) no variance are not returned, so
a constant table gives no rows, like an empty one; equal eigenvalues get any orthonormal
directions; a deviation too large for a long is null; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.llm.common import written

SCALE, OFFSET = 1024, 100_000
#: Longest vectors that are handled (R has the square of it in numbers).
MAX_DIMS = 2048
#: Rows reduced by one QR.
BLOCK_ROWS = 4096
_EPS = np.finfo(float).eps


# --- rows -------------------------------------------------------------------------------------
def integer_vectors(df: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    """``vec_id`` and ``y`` (array of long, floor(scale * entry)) of the rows with a usable vector."""
    vec = F.col(vec_col)
    usable = F.forall(vec, lambda x: F.coalesce(F.abs(x.cast("double")) < float("inf"), F.lit(False)))
    whole = F.transform(vec, lambda x: F.floor(x.cast("double") * SCALE).cast("long"))
    return df.where(vec.isNotNull() & usable).select(F.col(id_col).alias("vec_id"), whole.alias("y"))


def _rows(batch: pa.RecordBatch, dims: int) -> np.ndarray:
    lists = batch.column("y")
    size = lists.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
    out = np.zeros((len(size), dims), np.int64)
    row = np.repeat(np.arange(len(size)), size)
    out[row, np.arange(len(row)) - np.repeat(np.cumsum(size) - size, size)] = lists.flatten().to_numpy(
        zero_copy_only=False)
    return out


def _blocks(batches: Iterator[pa.RecordBatch], dims: int) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    for batch in batches:
        for at in range(0, batch.num_rows, BLOCK_ROWS):
            part = batch.slice(at, BLOCK_ROWS)
            yield part, _rows(part, dims)


def _centred(rows: np.ndarray, n: int, sums: np.ndarray) -> np.ndarray:
    """Rows minus their mean: an exact integer numerator, divided once."""
    return (n * rows - sums) / float(n)


# --- reduction over all rows --------------------------------------------------------------------
def _state(values: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([values.ravel().tolist()], pa.list_(pa.float64()))], ["state"])


def reduced(df: DataFrame, block: Callable, merge: Callable) -> np.ndarray | None:
    """One array from all rows: ``block`` makes it from a task's Arrow batches (or gives None), ``merge``
    joins two.  Tasks' arrays are merged in a tree: the square root of the shuffle width, then one."""
    spark = df.sparkSession

    def start(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state = block(batches)
        if state is not None:
            yield _state(state)

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state = None
        for batch in batches:
            for x in batch.column("state"):
                other = x.values.to_numpy()
                state = other if state is None else merge(state, other)
        if state is not None:
            yield _state(state)

    width = max(2, int(int(spark.conf.get("spark.sql.shuffle.partitions")) ** 0.5))
    some = df.mapInArrow(start, "state array<double>").repartition(width, F.xxhash64("state")).mapInArrow(join, "state array<double>")
    one = some.repartition(1).mapInArrow(join, "state array<double>").first()
    return None if one is None else np.asarray(one["state"])


def triangle(held: DataFrame, dims: int, n: int, sums: np.ndarray) -> np.ndarray:
    """R of the QR of all centred rows."""
    def qr(rows: np.ndarray) -> np.ndarray:
        r = np.linalg.qr(rows, mode="r")
        return np.vstack([r, np.zeros((dims - len(r), dims))]) if len(r) < dims else r

    def block(batches: Iterator[pa.RecordBatch]) -> np.ndarray | None:
        r = None
        for _, rows in _blocks(batches, dims):
            c = _centred(rows, n, sums)
            r = qr(c if r is None else np.vstack([r, c]))
        return r

    def merge(a: np.ndarray, b: np.ndarray) -> np.ndarray:
        return qr(np.vstack([a.reshape(dims, dims), b.reshape(dims, dims)])).ravel()

    return reduced(held, block, merge).reshape(dims, dims)


# --- singular values and directions of a triangle -------------------------------------------------
def bidiagonal(r: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Diagonal a, superdiagonal b and orthogonal V with r = U B V' (Householder, both sides)."""
    m, d = np.array(r, float), r.shape[1]
    v = np.eye(d)

    def mirror(x: np.ndarray) -> np.ndarray | None:
        norm = np.linalg.norm(x)
        if norm == 0 or np.linalg.norm(x[1:]) == 0:
            return None
        u = x.copy()
        u[0] += np.copysign(norm, x[0])
        return u / np.linalg.norm(u)

    for i in range(d):
        u = mirror(m[i:, i])
        if u is not None:
            m[i:, i:] -= 2 * np.outer(u, u @ m[i:, i:])
        if i + 2 < d:
            u = mirror(m[i, i + 1:])
            if u is not None:
                m[i:, i + 1:] -= 2 * np.outer(m[i:, i + 1:] @ u, u)
                v[:, i + 1:] -= 2 * np.outer(v[:, i + 1:] @ u, u)
    return np.diag(m).copy(), np.diag(m, 1).copy(), v


def _qd_step(q: np.ndarray, e: np.ndarray, shift: float) -> tuple[np.ndarray, np.ndarray, float, float] | None:
    """One dqds sweep; None if the shift passes the least eigenvalue."""
    n = len(q)
    nq, ne = np.empty(n), np.empty(max(n - 1, 0))
    d = q[0] - shift
    least = d
    for i in range(n - 1):
        nq[i] = d + e[i]
        if d < 0 or nq[i] <= 0:
            return None
        t = q[i + 1] / nq[i]
        ne[i] = e[i] * t
        d = d * t - shift
        least = min(least, d)
    if d < 0:
        return None
    nq[n - 1] = d
    return nq, ne, least, d


def dqds(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Singular values, falling, of the bidiagonal matrix with diagonal ``a`` and superdiagonal ``b``."""
    found: list[float] = []
    stack = [(np.square(a), np.square(b), 0.0)]
    while stack:
        q, e, shifted = stack.pop()
        step = 0.0
        while len(q):
            n = len(q)
            if n == 1:
                found.append(shifted + q[0])
                break
            small = np.flatnonzero(e <= (_EPS / 4) ** 2 * (shifted + np.minimum(q[:-1], q[1:])) + np.finfo(float).tiny)
            if len(small):
                cut = small[-1] + 1
                stack.append((q[:cut], e[:cut - 1], shifted))
                q, e, step = q[cut:], e[cut:], 0.0
                continue
            if q[0] < q[-1]:             # graded the wrong way: turned over
                q, e = _turned(q, e)
            out = _qd_step(q, e, step)
            while out is None:
                step = step / 4 if step > _EPS * q.max() else 0.0
                out = _qd_step(q, e, step)
            q, e, least, last = out
            shifted += step
            near = e[-1] * (1 + e[-1] / max(q[-1], np.finfo(float).tiny))
            step = max(0.0, least - near) if least == last else least / 4
    return np.sqrt(np.sort(np.maximum(found, 0))[::-1])


def _turned(q: np.ndarray, e: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The bidiagonal read from its other end, which has the same singular values."""
    return q[::-1].copy(), e[::-1].copy()


def _twisted(a: np.ndarray, b: np.ndarray, square: float, beside: list[np.ndarray]) -> np.ndarray:
    """Unit right vector of the unreduced bidiagonal (a, b) for the squared singular value
    ``square``, orthogonal to the vectors ``beside``."""
    n, tiny = len(a), np.finfo(float).tiny / _EPS
    low = np.where(np.abs(a) > 0, a, 1.0)
    q, l = np.square(a), np.append(b, 0.0)[:n] / low
    s, up = np.empty(n), np.zeros(n)          # from the top
    s[0] = -square
    for i in range(n - 1):
        top = s[i] + q[i]
        up[i] = q[i] * l[i] / (top if abs(top) > tiny else tiny)
        s[i + 1] = up[i] * l[i] * s[i] - square
    p, down = np.empty(n), np.zeros(n)        # from the bottom
    p[n - 1] = q[n - 1] - square
    for i in range(n - 2, -1, -1):
        bottom = q[i] * l[i] * l[i] + p[i + 1]
        t = q[i] / (bottom if abs(bottom) > tiny else tiny)
        down[i] = l[i] * t
        p[i] = p[i + 1] * t - square
    best = None
    for at in np.argsort(np.abs(s + p + square), kind="stable"):
        z = np.zeros(n)
        z[at] = 1.0
        for i in range(at - 1, -1, -1):
            z[i] = -up[i] * z[i + 1]
        for i in range(at, n - 1):
            z[i + 1] = -down[i] * z[i]
        size = np.abs(z).max()
        if not np.isfinite(size):
            continue
        z /= size
        z /= np.linalg.norm(z)
        left = z
        for _ in range(2):
            for other in beside:
                left = left - (other @ left) * other
        norm = np.linalg.norm(left)
        if best is None or norm > 2 * best[0]:
            best = (norm, left)
        if best[0] > 0.5:
            break
    return best[1] / best[0]


def directions(r: np.ndarray, top: int) -> tuple[np.ndarray, np.ndarray]:
    """Largest singular values of ``r`` (at most ``top``, those of no size left out) and their unit
    right vectors as columns."""
    d = r.shape[1]
    size = float(np.abs(r).max(initial=0))
    if size == 0:
        return np.zeros(0), np.zeros((d, 0))
    a, b, v = bidiagonal(r / size)
    a = np.where(np.abs(a) < _EPS ** 2, _EPS ** 2, a)
    b = np.where(np.abs(b) < _EPS / 8 * (np.abs(a[:-1]) + np.abs(a[1:])), 0.0, b)
    cuts = [0, *(np.flatnonzero(b == 0) + 1), d]
    found = []       # (value, block) of every unreduced block
    for lo, hi in zip(cuts, cuts[1:]):
        found += [(x, lo, hi) for x in dqds(a[lo:hi], b[lo:hi - 1])]
    found.sort(key=lambda x: (-x[0], x[1]))
    found = [x for x in found[:top] if x[0] > 8 * d * _EPS * found[0][0]]
    vectors: list[np.ndarray] = []
    for i, (value, lo, hi) in enumerate(found):
        near = [vectors[j][lo:hi] for j in range(i) if found[j][1] == lo and found[j][0] - value <= 1e-3 * found[j][0]]
        z = np.zeros(d)
        z[lo:hi] = _twisted(a[lo:hi], b[lo:hi - 1], value * value, near)
        vectors.append(z)
    values = np.array([x[0] for x in found]) * size
    return values, v @ np.array(vectors).T


# --- the operator -------------------------------------------------------------------------------
def _moments(w: np.ndarray) -> np.ndarray:
    mean = w.mean(axis=0)
    c = w - mean
    return np.concatenate([[len(w)], mean, (c.T @ c).ravel()])


def _merged(a: np.ndarray, b: np.ndarray, k: int) -> np.ndarray:
    """Count, means and centred products of two parts together."""
    n, gap = a[0] + b[0], b[1:k + 1] - a[1:k + 1]
    products = a[k + 1:] + b[k + 1:] + np.outer(gap, gap).ravel() * (a[0] * b[0] / n)
    return np.concatenate([[n], a[1:k + 1] + gap * (b[0] / n), products])


def _deviation(rows: np.ndarray, n: int, sums: np.ndarray) -> pa.Array:
    """Exact sums of (n * x - S)^2; null beyond a long."""
    gap = n * rows - sums
    if float(np.abs(gap).max(initial=0)) ** 2 * gap.shape[1] < 2 ** 62:
        return pa.array(np.square(gap).sum(axis=1))
    whole = [sum(g * g for g in row) for row in gap.tolist()]
    return pa.array([x if x < 2 ** 63 else None for x in whole], pa.int64())


def whiten(df: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", components: int = 8) -> DataFrame:
    """``vec_id``, ``component`` (from 1), ``n``, ``deviation``, ``whitened``, ``explained``,
    ``identity_error`` for every usable row and each of the largest ``components``."""
    spark = df.sparkSession
    held = written(spark, integer_vectors(df, id_col, vec_col), "whitening-vectors")
    out = "component int, n long, deviation long, whitened double, explained double, identity_error double"
    empty = spark.createDataFrame([], f"vec_id {held.schema['vec_id'].dataType.simpleString()}, {out}")
    shape = held.agg(F.count(F.lit(1)).alias("n"), F.max(F.size("y")).alias("dims")).first()
    n, dims = shape["n"], shape["dims"] or 0
    if dims > MAX_DIMS:
        raise ValueError(f"vectors of {dims} entries; at most {MAX_DIMS} are handled")
    if not n or not dims:
        return empty

    def totals(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(dims, np.int64)
        for _, rows in _blocks(batches, dims):
            total += rows.sum(axis=0)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(dims)), pa.array(total)], ["dim", "total"])

    sums = np.zeros(dims, np.int64)
    for r in held.mapInArrow(totals, "dim long, total long").groupBy("dim").agg(F.sum("total").alias("total")).collect():
        sums[r["dim"]] = r["total"]      # of entries without the offset, which no difference keeps

    r = triangle(held, dims, n, sums)
    values, vectors = directions(r, components)
    k = len(values)
    if not k:
        return empty
    explained = np.square(values) / np.square(r).sum()
    project = vectors * (np.sqrt(n) / values)

    def block(batches: Iterator[pa.RecordBatch]) -> np.ndarray | None:
        state = None
        for _, rows in _blocks(batches, dims):
            part = _moments(_centred(rows, n, sums) @ project)
            state = part if state is None else _merged(state, part, k)
        return state

    moments = reduced(held, block, lambda a, b: _merged(a, b, k))
    error = float(np.abs(moments[k + 1:].reshape(k, k) / n - np.eye(k)).max())

    schema, names = empty.schema, empty.columns

    def projected(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, rows in _blocks(batches, dims):
            m = len(rows)
            white = _centred(rows, n, sums) @ project
            at = pa.array(np.repeat(np.arange(m), k))
            yield pa.RecordBatch.from_arrays(
                [part.column("vec_id").take(at), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), m)),
                 pa.array(np.full(m * k, n, np.int64)), _deviation(rows, n, sums).take(at),
                 pa.array(white.ravel()), pa.array(np.tile(explained, m)), pa.array(np.full(m * k, error))],
                names)

    return held.mapInArrow(projected, schema)
