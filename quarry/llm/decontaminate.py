"""Benchmark decontamination with suffix arrays over the training words.

Every slice of ``documents`` that a task holds is one shard.  Its words become benchmark word
numbers (0: not a benchmark word), the suffixes that are long enough inside a run of benchmark
words to hold a window are sorted into a suffix array, and every benchmark suffix is
binary-searched in it.  The found intervals give the places of all verbatim matches; matches at
consecutive places are chained to the longest ones.  The places of repeated words and of passages
that many items share are paired a bounded number at a time; where one text and one item
alone have more pairs, a running comparison finds their longest match in the memory of the item.

Words: A-Z lower-cased, then maximal runs of ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]``.  A window is
``width`` consecutive item words; an item of fewer words, but not none, is one window.

The benchmark reaches the tasks in shards of at most ``shard_bytes`` of text, one pass over the
documents each, so its size is never a limit (one item longer than that is its own shard).

Defined cases: null or empty text has no words and no hits; an item without words is ignored;
an item with a null id marks hits but is not listed; items that repeat an id count once;
repeated document rows are reported row by row; extra columns are ignored by
:func:`contamination` and kept by :func:`remove_contaminated`.  Empty tables give no rows or no hits.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.llm.common import schema_of, slices, utf8, written

WIDTH = 10
#: Benchmark text of a shard: its windows take some 40 times as much on the driver, and half of that in
#: a task.
SHARD_BYTES = 8 << 20
#: Pairs of a text place and an item place that are listed at once.
PAIRS = 250_000

_TABLE = bytes((c + 32 if 65 <= c <= 90 else c) if 48 <= c <= 57 or 65 <= c <= 90 or 97 <= c <= 122 or c >= 128
               else 32 for c in range(256))


def words(text: bytes) -> list[bytes]:
    return text.translate(_TABLE).split()


class Benchmark:
    """Word numbers and distinct windows of some items, in arrays."""

    def __init__(self, items: list[tuple], width: int) -> None:
        self.width = width
        self.number: dict[bytes, int] = {}
        self.items = [None if item is None else str(item) for item, _ in items]
        parts = []
        for _, text in items:
            ws = words((text or "").encode())
            parts.append(np.fromiter((self.number.setdefault(w, len(self.number) + 1) for w in ws), np.uint32, len(ws)))
        size = np.array([len(x) for x in parts], np.int64)
        flat = np.concatenate([*parts, np.zeros(width, np.uint32)])
        length = np.minimum(size, width)                     # words of an item's windows
        self.item_windows = np.where(size > 0, size - length + 1, 0)
        item = np.repeat(np.arange(len(items)), self.item_windows)
        place = np.arange(len(item)) - np.repeat(np.cumsum(self.item_windows) - self.item_windows, self.item_windows)
        rows = flat[((np.cumsum(size) - size)[item] + place)[:, None] + np.arange(width)].astype(">u4")
        rows[np.arange(width) >= length[item][:, None]] = 0
        self.low, first, which = np.unique(_as_keys(rows), return_index=True, return_inverse=True)
        self.length = length[item][first]                    # of each window; its places by item, place
        self.n_places = np.bincount(which, minlength=len(first))
        self.first_place = np.cumsum(self.n_places) - self.n_places
        order = np.argsort(which, kind="stable")
        self.item, self.place = item[order], place[order]
        high = rows[first]
        high[np.arange(width) >= self.length[:, None]] = 0xFFFFFFFF
        self.high = _as_keys(high)
        begins = self.length < width
        self.short = sorted({(int(w), int(n)) for w, n in zip(rows[first][begins, 0], self.length[begins])})


def _as_keys(rows: np.ndarray) -> np.ndarray:
    """Rows of big-endian numbers as byte strings, which sort alike."""
    return np.ascontiguousarray(rows, ">u4").view(f"S{4 * rows.shape[1]}").ravel()


class SuffixArray:
    """Sorted suffixes of ``ids`` (0 ends a run of benchmark words) that can hold a window."""

    def __init__(self, ids: np.ndarray, bench: Benchmark) -> None:
        n, width = len(ids), bench.width
        ends = np.r_[np.flatnonzero(ids == 0), n]
        run = ends[np.searchsorted(ends, np.arange(n))] - np.arange(n)
        fit = run >= width
        for first, length in bench.short:
            fit |= (ids == first) & (run >= length)
        places = np.flatnonzero(fit)
        cols = np.minimum(np.arange(width)[None, :], run[places][:, None])
        # a column at or beyond the run's end reads the 0 that ends it
        rows = np.r_[ids, 0][np.minimum(places[:, None] + cols, n)]
        keys = _as_keys(rows)
        order = np.argsort(keys, kind="stable")
        self.places, self.keys = places[order], keys[order]

    def search(self, bench: Benchmark) -> tuple[np.ndarray, np.ndarray]:
        """(window, place) of every occurrence."""
        lo = np.searchsorted(self.keys, bench.low, "left")
        hi = np.searchsorted(self.keys, bench.high, "right")
        n = hi - lo
        window = np.repeat(np.arange(len(n)), n)
        at = np.arange(len(window)) - np.repeat(np.cumsum(n) - n, n) + np.repeat(lo, n)
        return window, self.places[at]


def _ranges(first: np.ndarray, n: np.ndarray) -> np.ndarray:
    """first[0], first[0]+1, .. (n[0] numbers), first[1], .."""
    return np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n) + np.repeat(first, n)


def _chained(item: np.ndarray, inside: np.ndarray, p: np.ndarray, d: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Occurrences at consecutive places of both the text and the item are one match; of those of
    a text and an item the longest, the first of equals, stays."""
    order = np.lexsort((p, p - inside, item))
    item, inside, p, d, size = (x[order] for x in (item, inside, p, d, size))
    first = np.flatnonzero(np.r_[True, (item[1:] != item[:-1]) | (inside[1:] != inside[:-1] + 1) | (p[1:] != p[:-1] + 1)])
    words_ = np.diff(np.r_[first, len(p)]) - 1 + size[first]
    found = np.stack([d[first], item[first], p[first], inside[first], words_])
    found = found[:, np.lexsort((found[3], found[2], -found[4], found[1], found[0]))]
    return found[:, np.r_[True, (found[0, 1:] != found[0, :-1]) | (found[1, 1:] != found[1, :-1])]]


def _streamed(places: list[np.ndarray], own: np.ndarray, p: np.ndarray, windows: int) -> tuple[int, int, int]:
    """Longest match of one text and one item whose windows repeat so often that their pairs are not
    listed: place in the text, in the item, windows.  ``own`` numbers the window at each text place
    ``p`` (ascending), ``places`` are that window's places in the item.  Memory follows the item."""
    run = np.zeros(windows + 1, np.int64)        # by item place: windows matched up to the place before
    touched, last, best = np.zeros(0, np.int64), -2, (0, 0, 0)
    for w, at in zip(own.tolist(), p.tolist()):
        here = places[w]
        now = run[here] + 1 if at == last + 1 else np.ones(len(here), np.int64)
        run[touched] = 0
        touched, last = here + 1, at
        run[touched] = now
        k = int(now.argmax())
        if now[k] > best[2]:
            best = (at - int(now[k]) + 1, int(here[k] - now[k]) + 1, int(now[k]))
            if best[2] == windows:                # the whole item
                break
    return best


def _of_repeats(window: np.ndarray, place: np.ndarray, doc: int, bench: Benchmark, limit: int) -> list[np.ndarray]:
    """:func:`longest_matches` of one text with more than ``limit`` pairs: item by item."""
    order = np.argsort(window, kind="stable")
    kinds, begin, count = np.unique(window[order], return_index=True, return_counts=True)
    n = bench.n_places[kinds]
    row, kind = _ranges(bench.first_place[kinds], n), np.repeat(np.arange(len(kinds)), n)
    by_item = np.argsort(bench.item[row], kind="stable")
    row, kind = row[by_item], kind[by_item]
    item = bench.item[row]
    cuts = np.flatnonzero(np.r_[True, item[1:] != item[:-1]])
    pairs = np.add.reduceat(count[kind], cuts)
    ends = np.r_[cuts[1:], len(row)]
    out, at = [], 0
    while at < len(cuts):
        stop = max(at + 1, int(np.searchsorted(np.cumsum(pairs[at:]), limit, "right")) + at)
        lo, hi = cuts[at], ends[stop - 1]
        if pairs[at] > limit:
            of = np.full(len(kinds), -1)
            own = np.unique(kind[lo:hi])
            of[own] = np.arange(len(own))
            lists = [np.sort(bench.place[row[lo:hi][kind[lo:hi] == k]]) for k in own]
            number = of[np.searchsorted(kinds, window)]
            some = np.flatnonzero(number >= 0)
            some = some[np.argsort(place[some], kind="stable")]
            p, inside, n_windows = _streamed(lists, number[some], place[some], int(bench.item_windows[item[lo]]))
            size = int(bench.length[kinds[own[0]]])
            out.append(np.array([[doc], [item[lo]], [p], [inside], [n_windows - 1 + size]], np.int64))
        else:
            times = count[kind[lo:hi]]
            p = place[order][_ranges(begin[kind[lo:hi]], times)]
            wide = np.repeat(np.arange(lo, hi), times)
            out.append(_chained(item[wide], bench.place[row[wide]], p, np.full(len(p), doc), bench.length[kinds[kind[wide]]]))
        at = stop
    return out


def longest_matches(window: np.ndarray, place: np.ndarray, doc: np.ndarray, bench: Benchmark,
                    limit: int = PAIRS) -> np.ndarray:
    """Per text and item with a match, the longest verbatim one (the first of equals), as rows: text,
    item row, place in the joined words, place in the item, words.  Pairs of a text place and an item
    place are listed for some texts at a time, at most ``limit``; a text with more is taken item
    by item, and an item with more by a running comparison."""
    by_doc = np.argsort(doc, kind="stable")
    window, place, doc = window[by_doc], place[by_doc], doc[by_doc]
    n = bench.n_places[window]
    cuts = np.flatnonzero(np.r_[True, doc[1:] != doc[:-1]])
    pairs, ends = np.add.reduceat(n, cuts), np.r_[cuts[1:], len(doc)]
    out, at = [np.zeros((5, 0), np.int64)], 0
    while at < len(cuts):
        stop = max(at + 1, int(np.searchsorted(np.cumsum(pairs[at:]), limit, "right")) + at)
        part = slice(cuts[at], ends[stop - 1])
        if pairs[at] > limit:
            out += _of_repeats(window[part], place[part], int(doc[cuts[at]]), bench, limit)
        else:
            row = _ranges(bench.first_place[window[part]], n[part])
            wide = [np.repeat(x[part], n[part]) for x in (place, doc, bench.length[window])]
            out.append(_chained(bench.item[row], bench.place[row], *wide))
        at = stop
    return np.concatenate(out, axis=1)


def _matches(texts: list[bytes], bench: Benchmark) -> Iterator[tuple[int, np.ndarray, list[list], list[list]]]:
    """Some texts at a time: the first of them, and per text the number of words, hit spans (start,
    end) in words, longest match per item (item id, start in the text, start in the item, words)."""
    number, parts, sizes = bench.number.get, [], []
    for t in texts:
        ws = words(t)
        sizes.append(len(ws))
        parts.append(np.fromiter((number(w, 0) for w in ws), np.uint32, len(ws)))
        parts.append(np.zeros(1, np.uint32))
    n_words = np.array(sizes, np.int64)
    begin = np.r_[0, np.cumsum(n_words + 1)]
    if len(bench.low) and texts:
        window, place = SuffixArray(np.concatenate(parts), bench).search(bench)
    else:
        window = place = np.zeros(0, np.int64)
    order = np.argsort(place, kind="stable")
    window, place = window[order], place[order]
    doc = np.searchsorted(begin, place, "right") - 1
    pairs = np.bincount(doc, weights=bench.n_places[window], minlength=len(texts)) if len(doc) else np.zeros(len(texts))
    at = 0
    while at < len(texts):       # what is listed for the output at once is bounded like the pairs
        stop = max(at + 1, int(np.searchsorted(np.cumsum(pairs[at:]), PAIRS, "right")) + at)
        some = slice(*np.searchsorted(place, (begin[at], begin[stop])))
        spans: list[list] = [[] for _ in range(at, stop)]
        matches: list[list] = [[] for _ in range(at, stop)]
        p, d = place[some], doc[some]
        if len(p):
            reach = np.maximum.accumulate(p + bench.length[window[some]])          # texts are disjoint and in order
            first = np.flatnonzero(np.r_[True, p[1:] > reach[:-1]])
            for a, b, k in zip(p[first], reach[np.r_[first[1:] - 1, len(p) - 1]], d[first]):
                spans[k - at].append((int(a - begin[k]), int(b - begin[k])))
            for k, i, q, inside, n in longest_matches(window[some], p, d, bench).T.tolist():
                if bench.items[i] is not None:
                    matches[k - at].append((bench.items[i], int(q - begin[k]), inside, n))
        yield at, n_words[at:stop], spans, matches
        at = stop


def _best_per_item(found: list[tuple]) -> list[tuple]:
    """One longest match per item id, by id."""
    best: dict[str, tuple] = {}
    for m in sorted(found, key=lambda m: (m[0], -m[3], m[1], m[2])):
        best.setdefault(m[0], m)
    return list(best.values())


def _merge(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


def benchmark_shards(benchmark: DataFrame, shard_bytes: int = SHARD_BYTES) -> Iterator[list[tuple]]:
    """Items in lists of about ``shard_bytes`` of text, one list on the driver at a time."""
    total = benchmark.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n = -(-total // shard_bytes) or 1
    for k in range(n):
        part = benchmark.select("item_id", "text")
        if n > 1:
            part = part.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(n)) == k)
        yield [tuple(r) for r in part.collect()]


_SPAN = pa.struct([("start", pa.int64()), ("end", pa.int64())])
_MATCH = pa.struct([("item", pa.string()), ("start", pa.int64()), ("item_start", pa.int64()), ("words", pa.int64())])


def matched(docs: DataFrame, benchmark: DataFrame, keep: list[str], width: int = WIDTH,
            shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """Columns ``keep`` of ``docs`` with ``__words`` long, ``__spans`` (hit spans, in words) and
    ``__matches`` (per item id, in their order as strings, its longest match).  No shuffle."""
    spark = docs.sparkSession
    found = ("__words long, __spans array<struct<start: long, end: long>>, "
             "__matches array<struct<item: string, start: long, item_start: long, words: long>>")
    carried = list(dict.fromkeys([*keep, "text"]))
    now = docs.select(*carried)
    for k, items in enumerate(benchmark_shards(benchmark, shard_bytes)):
        if k:
            now = written(spark, now, "decontaminate-pass")
        bench = spark.sparkContext.broadcast(Benchmark(items, width))

        def run(batches: Iterator[pa.RecordBatch], bench=bench, later=bool(k)) -> Iterator[pa.RecordBatch]:
            for whole in (s for b in batches for s in slices(b)):
                for at, n_words, spans, matches in _matches(utf8(whole.column("text")), bench.value):
                    batch = whole.slice(at, len(n_words))
                    if later:
                        spans = [_merge(a + [tuple(x.values()) for x in b])
                                 for a, b in zip(spans, batch.column("__spans").to_pylist())]
                        matches = [a + [tuple(x.values()) for x in b]
                                   for a, b in zip(matches, batch.column("__matches").to_pylist())]
                    yield pa.RecordBatch.from_arrays(
                        [batch.column(c) for c in carried]
                        + [pa.array(n_words),
                           pa.array([[{"start": a, "end": b} for a, b in x] for x in spans], pa.list_(_SPAN)),
                           pa.array([[dict(zip(("item", "start", "item_start", "words"), m)) for m in _best_per_item(x)]
                                     for x in matches], pa.list_(_MATCH))],
                        [*carried, "__words", "__spans", "__matches"])

        now = now.mapInArrow(run, schema_of(now, carried, found))
    return now.drop("text") if "text" not in keep else now


def contamination(docs: DataFrame, benchmark: DataFrame, width: int = WIDTH,
                  shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """One row per document row: ``doc_id``, ``n_words``, ``n_hit``, ``spans`` (hit words), ``items``
    (sorted ids), ``matches`` (per item its longest verbatim match and where it is in both)
    and ``longest`` (words of the longest of them)."""
    found = matched(docs, benchmark, ["doc_id"], width, shard_bytes)
    size = F.transform("__spans", lambda s: s["end"] - s["start"])
    return found.select(
        "doc_id", F.col("__words").alias("n_words"),
        F.aggregate(size, F.lit(0).cast("long"), lambda a, x: a + x).alias("n_hit"),
        F.col("__spans").alias("spans"), F.col("__matches.item").alias("items"),
        F.col("__matches").alias("matches"),
        F.coalesce(F.array_max("__matches.words"), F.lit(0).cast("long")).alias("longest"))


def remove_contaminated(docs: DataFrame, benchmark: DataFrame, width: int = WIDTH,
                        shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """``docs`` without the rows that hold any benchmark window; all columns kept."""
    columns = docs.columns
    found = matched(docs, benchmark, columns, width, shard_bytes)
    return found.where(F.size("__spans") == 0).select(*columns)


def items_digest(items: list[str]) -> str:
    return hashlib.sha256(",".join(sorted(items)).encode()).hexdigest()
