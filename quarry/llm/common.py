"""Small helpers shared by the operators of this subpackage."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import Any

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarry.session import written  # noqa: F401  (re-exported to the operators)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def id_remainder(id_col: str, modulus: int) -> Column:
    """crc32 of the id as text, modulo ``modulus``; null for a null id."""
    return F.crc32(F.col(id_col).cast("string").cast("binary")) % modulus


def schema_of(df: DataFrame, kept: list[str], added: str) -> T.StructType:
    """The named columns of ``df`` (as they are) followed by the columns of a DDL string."""
    fields = [T.StructField(c, df.schema[c].dataType, True) for c in kept]
    return T.StructType(fields + T._parse_datatype_string(added).fields)


def utf8(column: pa.ChunkedArray | pa.Array) -> list[bytes]:
    """Texts of an Arrow string column as UTF-8 bytes; null becomes empty."""
    return [x or b"" for x in column.cast(pa.binary()).to_pylist()]


def slices(batch: pa.RecordBatch, text: str = "text", limit: int = 8 << 20) -> Iterator[pa.RecordBatch]:
    """Row slices of a batch with about ``limit`` text bytes each (a longer text stands
    alone), so that a task's working set follows ``limit`` and the longest text only."""
    size = pc.fill_null(pc.binary_length(batch.column(text)), 0).to_numpy(zero_copy_only=False)
    ends = np.cumsum(size, dtype=np.int64)
    start = 0
    while start < batch.num_rows:
        before = int(ends[start - 1]) if start else 0
        stop = max(start + 1, int(np.searchsorted(ends, before + limit, "right")))
        yield batch.slice(start, stop - start)
        start = stop


def hash_sample(df: DataFrame, id_col: str, rows: int, total: int) -> DataFrame:
    """About ``rows`` of ``total`` rows, chosen by a hash of the id: the same rows for any
    partitioning.  Used only where a classifier is fitted or a search tree is laid out."""
    if total <= rows:
        return df
    keep = max(1, int(rows / total * (1 << 20)))
    return df.where(F.pmod(F.xxhash64(F.lit("sample"), F.col(id_col)), F.lit(1 << 20)) < keep)


_HELD: dict[str, Any] = {}


def per_worker(key: str, make: Callable[[], Any]) -> Any:
    """What ``make`` gives, made once per Python worker and key; a few keys are held."""
    if key not in _HELD:
        if len(_HELD) >= 4:
            _HELD.clear()
        _HELD[key] = make()
    return _HELD[key]


def join_split(rows: DataFrame, side: DataFrame, keys: list[str], shares: int = 1024) -> DataFrame:
    """``rows`` left-joined to ``side`` (one row per key; keys not null) with no key too large for a
    task: keys that hold more than 1/``shares`` of all rows, of which there can be ``shares`` at
    most, are joined by broadcast and never shuffled; the others by shuffle.  Both are read
    several times and should be written tables."""
    spark = rows.sparkSession
    total = rows.count()
    hot = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") * shares > total).drop("_n")
    large = written(spark, F.broadcast(hot).join(side, keys, "left"), "large-keys")
    return (rows.join(F.broadcast(large), keys)
            .unionByName(rows.join(F.broadcast(large.select(*keys)), keys, "left_anti").join(side, keys, "left")))
