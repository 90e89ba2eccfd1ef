"""A folder of many files, listed and read by the tasks.

Spark's ``binaryFile`` source keeps the status of every file on the driver and cuts a folder of small files
into a task for each few dozen of them.  Here every task walks the names of the folder, as a stream, and
keeps its share by a hash of the name; only of these it asks for size and time, and reads the bytes.  The
driver holds nothing of the folder and the number of tasks is that of the cores, however many files
there are.
"""

from __future__ import annotations

import datetime as dt
import os
import re
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Tasks per core; the shares are about even.
_SHARES = 2
#: Files and bytes handed on at once (a larger file alone).
_FILES = 512
_BYTES = 4 << 20
_SCHEMA = "path string, modificationTime timestamp, length long"


def local_folder(spark: SparkSession, folder: str) -> str | None:
    """The absolute path of a folder of a mounted file system; None for any other path."""
    try:
        sc = spark.sparkContext
        where = sc._jvm.org.apache.hadoop.fs.Path(folder)
        fs = where.getFileSystem(sc._jsc.hadoopConfiguration())
        uri = fs.makeQualified(where).toUri()
        if uri.getScheme() != "file" or not fs.getFileStatus(where).isDirectory():
            return None
        return uri.getPath().rstrip("/") or "/"
    except Exception:  # a remote session, a glob or no such path: Spark's file source decides
        return None


def glob_pattern(glob: str) -> str:
    """A file name glob of Hadoop (``* ? [a-b] [^a] {a,b} \\c``) as a regular expression."""
    out, braces, at = "", 0, 0
    while at < len(glob):
        c = glob[at]
        at += 1
        if c == "\\" and at < len(glob):
            out += re.escape(glob[at])
            at += 1
        elif c == "[" and "]" in glob[at + 1:]:
            end = glob.index("]", at + 1)
            held = glob[at:end].replace("\\", "\\\\").replace("[", "\\[")
            out += f"[{'^' + held[1:] if held[0] in '^!' else held}]"
            at = end + 1
        elif c == "{":
            out, braces = out + "(?:", braces + 1
        elif c == "}" and braces:
            out, braces = out + ")", braces - 1
        else:
            out += {"*": ".*", "?": "."}.get(c) or ("|" if c == "," and braces else re.escape(c))
    return out


def _seen(name: str) -> bool:
    """As Spark's file sources: hidden names and unfinished copies are not listed."""
    if name.startswith(("_metadata", "_common_metadata")):
        return True
    return not (name.startswith(".") or name.startswith("_") and "=" not in name or name.endswith("._COPYING_"))


def _extension(name: str) -> str:
    return os.path.splitext(name)[1].lower()


def _files(folder: str, share: int, shares: int, pattern: str | None) -> Iterator[os.DirEntry]:
    wanted = re.compile(pattern, re.S) if pattern else None
    with os.scandir(folder) as entries:
        for e in entries:
            if (zlib.crc32(os.fsencode(e.name)) % shares == share and _seen(e.name)
                    and (wanted is None or wanted.fullmatch(e.name)) and e.is_file()):
                yield e


def _lister(folder: str, shares: int, pattern: str | None, content: bool | tuple[str, ...]):
    def batch(rows: list[tuple]) -> pa.RecordBatch:
        path, time, length, *held = zip(*rows)
        columns = [pa.array(path, pa.string()), pa.array(time, pa.timestamp("us", "UTC")), pa.array(length, pa.int64())]
        return pa.RecordBatch.from_arrays(columns + [pa.array(x, pa.binary()) for x in held],
                                          ["path", "modificationTime", "length", "content"][:3 + len(held)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for share in (x for b in batches for x in b.column(0).to_pylist()):
            rows, size = [], 0
            for e in _files(folder, share, shares, pattern):
                status = e.stat()
                if not status.st_size:      # the file source gives no row for it
                    continue
                when = dt.datetime.fromtimestamp(status.st_mtime_ns // 1_000_000 / 1000, dt.timezone.utc)
                row = (f"file:{folder.rstrip('/')}/{e.name}", when, status.st_size)
                if content:
                    held = None
                    if content is True or _extension(e.name) in content:
                        with open(e.path, "rb") as f:
                            held = f.read()
                        size += len(held)
                    row += (held,)
                rows.append(row)
                if len(rows) == _FILES or size >= _BYTES:
                    yield batch(rows)
                    rows, size = [], 0
            if rows:
                yield batch(rows)
    return run


def listed(spark: SparkSession, folder: str, glob: str | None = None,
           content: bool | tuple[str, ...] = True) -> DataFrame:
    """``(path, modificationTime, length, content)`` of the files directly in ``folder``; ``content`` is NULL
    where it was not asked for (False: of every file; extensions: of the files that have none of them)."""
    shares = _SHARES * spark.sparkContext.defaultParallelism
    schema = _SCHEMA + (", content binary" if content else "")
    run = _lister(folder, shares, glob_pattern(glob) if glob else None, content)
    files = spark.range(0, shares, 1, shares).mapInArrow(run, schema)
    return files if content else files.withColumn("content", F.lit(None).cast("binary"))
