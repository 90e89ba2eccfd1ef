"""SimHash near-duplicate detection with vantage-point trees.

A pair of 64-bit fingerprints that differs in at most ``max_bits`` bits differs in at most
``max_bits // sections`` bits on at least one of ``sections`` equal bit ranges.  One
vantage-point tree per range deals the fingerprints to shards by Hamming distance on that
range; a fingerprint is also sent to every shard beyond whose boundary its ball of that radius
reaches.  The trees are laid out on the counts of all values of
a range (at most 65,536) and get as deep as their shards need to fit in memory.  A shard that is
still too large is divided again by the trees of the other ranges: the pair differs in at most
``max_bits // (sections - 1)`` bits on one of them, too.  So the copies of a fingerprint are bounded
by the balls' reach, whatever the number of fingerprints; only what is alike on two ranges (large
groups of near copies) is cut in plain blocks.  Inside a shard the trees go on, their branches pruned
by triangle bounds at each vantage point, and survivors are compared on all 64 bits.  Found pairs leave a shard as a spanning
forest, never as all pairs, and are closed to components by star contraction in Spark.

Defined cases: null text counts as empty; a text without words has fingerprint zero and links
like any other; equal fingerprints always link; repeated rows are separate rows with equal
results; a null ``doc_id`` row takes part, and a component without any id has a null
``component_id``.  Extra columns are ignored.  An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.llm.common import join_split, schema_of, slices, utf8, written
from quarry.llm.exactdedup import marked, table_bits

#: Levels of the shard trees at least; deeper trees follow from the number of fingerprints.
MIN_DEPTH = 6
#: Fingerprints that one shard holds in memory at a time; a larger shard is divided.
BLOCK_ROWS = 1 << 16
#: More levels than any tree has.
DEEPEST = 1 << 20
#: Bits of a range at most: its values are counted (a table of at most 65,536 rows per range).
MAX_RANGE = 16


# ---------------------------------------------------------------- fingerprints

def fingerprint(text: bytes, shingle: int = 4, seed: int = 42) -> int:
    """64-bit SimHash of one text: majority bits over the XXH64 of its word shingles."""
    words = text.lower().split()          # bytes: A-Z only, and space and 0x09-0x0D only
    if not words:
        return 0
    line = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    n = max(1, len(words) - shingle + 1)
    stop = ends[-n:]
    start = np.zeros(n, np.int64)
    start[1:] = ends[: n - 1] + 1
    digest = xxhash.xxh64_intdigest
    hashes = np.fromiter((digest(line[a:b], seed) for a, b in zip(start.tolist(), stop.tolist())),
                         np.uint64, n)
    counts = np.zeros(64, np.int64)
    for i in range(0, n, 1 << 16):
        part = hashes[i:i + (1 << 16)]
        counts += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(counts * 2 > n, bitorder="little").view(np.uint64)[0])


def fingerprints(docs: DataFrame, shingle: int = 4, seed: int = 42, kept: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The columns ``kept`` and the signed 64-bit ``fp`` per row of ``docs``."""
    names = [*kept, "fp"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (s for b in batches for s in slices(b)):
            values = np.fromiter((fingerprint(t, shingle, seed) for t in utf8(batch.column("text"))),
                                 np.uint64, batch.num_rows)
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in kept], pa.array(values.view(np.int64))], names)

    return docs.select(*kept, "text").mapInArrow(run, schema_of(docs, list(kept), "fp long"))


# ---------------------------------------------------------------- shard trees

class ShardTree:
    """A vantage-point tree over the values of one bit range, laid out on their counts.

    A node has an inner child (distance to the vantage point at most the radius) and an outer one;
    a node is a leaf, and so a shard, when it holds at most ``most`` fingerprints at a depth of
    ``MIN_DEPTH`` or more, or a single value."""

    def __init__(self, values: np.ndarray, counts: np.ndarray, bits: int, most: int) -> None:
        vantage, radius, inner, outer = [], [], [], []
        queue = [(np.arange(len(values)), 0)]              # node i is entry i
        while len(vantage) < len(queue):
            rows, depth = queue[len(vantage)]
            queue[len(vantage)] = (rows[:0], depth)        # its values are not needed again
            leaf = len(rows) < 2 or (depth >= MIN_DEPTH and counts[rows].sum() <= most)
            best = (0, np.uint64(0), bits)
            if not leaf:
                here, best = values[rows], None
                for k in range(min(8, len(here))):         # the most even split of a few
                    v = here[(k * 7919) % len(here)]
                    inside = np.cumsum(np.bincount(np.bitwise_count(here ^ v), counts[rows], bits + 1))
                    skew = np.abs(2 * inside - inside[-1])
                    skew[inside == inside[-1]] = inside[-1]            # no split at all
                    r = int(skew.argmin())
                    if best is None or skew[r] < best[0]:
                        best = (skew[r], v, r)
                near = np.bitwise_count(here ^ best[1]) <= best[2]
                queue += [(rows[near], depth + 1), (rows[~near], depth + 1)]
            vantage.append(best[1])
            radius.append(best[2])
            inner.append(-1 if leaf else len(queue) - 2)
            outer.append(-1 if leaf else len(queue) - 1)
        self.vantage, self.radius = np.array(vantage, np.uint64), np.array(radius, np.int64)
        self.inner, self.outer = np.array(inner, np.int64), np.array(outer, np.int64)

        self.values, self.bits = values, bits
        self.nodes: dict[int, np.ndarray] = {}

    def home(self, values: np.ndarray, depth: int = DEEPEST) -> np.ndarray:
        """The node of each value, a leaf or one at ``depth``."""
        node = np.zeros(len(values), np.int64)
        going = np.flatnonzero(self.inner[node] >= 0)
        while len(going) and depth:
            at = node[going]
            near = np.bitwise_count(values[going] ^ self.vantage[at]) <= self.radius[at]
            node[going] = np.where(near, self.inner[at], self.outer[at])
            going = going[self.inner[node[going]] >= 0]
            depth -= 1
        return node

    def reached(self, values: np.ndarray, reach: int, depth: int = DEEPEST) -> tuple[np.ndarray, np.ndarray]:
        """(row, node) for every leaf, or node at ``depth``, that holds a value within ``reach``: the
        shards whose boundary the ball overlaps, found by the ball's values (the triangle bounds
        alone would add shards that hold none of them, more with every level)."""
        if depth not in self.nodes:                        # by value; -1 where nothing has it
            self.nodes[depth] = np.full(1 << self.bits, -1, np.int64)
            self.nodes[depth][self.values.astype(np.int64)] = self.home(self.values, depth)
        ball = [sum(1 << b for b in flips) for n in range(reach + 1) for flips in combinations(range(self.bits), n)]
        node = np.sort(self.nodes[depth][values.astype(np.int64)[:, None] ^ np.array(ball)[None, :]], axis=1)
        new = node >= 0
        new[:, 1:] &= node[:, 1:] != node[:, :-1]
        row, at = np.nonzero(new)
        return row, node[row, at]


def _section(values: np.ndarray, section: int, bits: int) -> np.ndarray:
    return (values >> np.uint64(section * bits)) & np.uint64((1 << bits) - 1)


def _key(section: int, shard: np.ndarray, other: int = -1, part: np.ndarray | int = 0) -> np.ndarray:
    """Shard of a range, or with ``other`` its part by the tree of another range."""
    return np.int64((section << 44) | ((other + 1) << 18)) | (shard.astype(np.int64) << 26) | part


def _key_ranges(key: int) -> tuple[int, int]:
    return key >> 44, ((key >> 18) & 0xFF) - 1


class Routes:
    """Where fingerprints go: their home shards, and the shards that ask for them."""

    def __init__(self, counts: list[tuple[np.ndarray, np.ndarray]], max_bits: int, block_rows: int) -> None:
        """``counts``: values and how many fingerprints hold them, for each range."""
        self.sections, self.block_rows = len(counts), block_rows
        self.bits = 64 // self.sections
        self.reach, self.other_reach = max_bits // self.sections, max_bits // (self.sections - 1)
        self.trees = [ShardTree(v, n, self.bits, block_rows) for v, n in counts]
        self.level = []              # per range and shard: levels of its division, 0 for whole shards
        for tree, (v, n) in zip(self.trees, counts):
            size = np.bincount(tree.home(v), n, len(tree.vantage))
            need = np.ceil(np.log2(np.maximum(2 * size / block_rows, 1))).astype(np.int64)
            self.level.append(np.where(size > block_rows, need, 0))
        self.big, self.blocks = np.zeros(0, np.int64), np.zeros(0, np.int64)

    @property
    def divided(self) -> bool:
        return any(level.any() for level in self.level)

    def cut(self, sizes: dict[int, int]) -> None:
        """Cut the parts of these sizes (those over ``block_rows``) in blocks."""
        self.big = np.array(sorted(sizes), np.int64)
        self.blocks = np.array([-(-sizes[k] // self.block_rows) for k in sorted(sizes)], np.int64)

    def _blocks(self, keys: np.ndarray) -> np.ndarray:
        if not len(self.big):
            return np.ones(len(keys), np.int64)
        at = np.minimum(np.searchsorted(self.big, keys), len(self.big) - 1)
        return np.where(self.big[at] == keys, self.blocks[at], 1)

    def _divided_homes(self, fps: np.ndarray, section: int) -> Iterator[tuple[int, int, np.ndarray, np.ndarray, np.ndarray]]:
        """Other range, levels, rows, their shards and parts, of rows at home in divided shards."""
        shard = self.trees[section].home(_section(fps, section, self.bits))
        level = self.level[section][shard]
        for k in np.unique(level[level > 0]):
            rows = np.flatnonzero(level == k)
            for other in range(self.sections):
                if other != section:
                    part = self.trees[other].home(_section(fps[rows], other, self.bits), int(k))
                    yield other, int(k), rows, shard[rows], part

    def parts(self, fps: np.ndarray) -> np.ndarray:
        """Keys of the parts of divided shards that the fingerprints are at home in."""
        return np.concatenate([np.zeros(0, np.int64), *[
            _key(s, shard, other, part) for s in range(self.sections)
            for other, _, _, shard, part in self._divided_homes(fps, s)]])

    def send(self, fps: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, bool, np.ndarray]]:
        """(key, block, query?, row) of all places; a pair is found where the one of the lower
        (key, block) is at home."""
        mixed = (fps * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(40)

        def all_blocks(keys: np.ndarray, row: np.ndarray) -> tuple[np.ndarray, np.ndarray, bool, np.ndarray]:
            n = self._blocks(keys)
            return np.repeat(keys, n), np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n), True, np.repeat(row, n)

        for s, tree in enumerate(self.trees):
            here = _section(fps, s, self.bits)
            home, level = tree.home(here), self.level[s]
            whole = np.flatnonzero(level[home] == 0)
            yield _key(s, home[whole]), np.zeros(len(whole), np.int64), False, whole
            row, shard = tree.reached(here, self.reach)
            row, shard = row[shard < home[row]], shard[shard < home[row]]
            plain = level[shard] == 0
            yield _key(s, shard[plain]), np.zeros(int(plain.sum()), np.int64), True, row[plain]
            for k in np.unique(level[shard[~plain]]):
                at = np.flatnonzero(level[shard] == k)
                for other in range(self.sections):
                    if other != s:
                        i, part = self.trees[other].reached(_section(fps[row[at]], other, self.bits),
                                                            self.other_reach, int(k))
                        yield all_blocks(_key(s, shard[at][i], other, part), row[at][i])
            for other, k, rows, shards, part in self._divided_homes(fps, s):
                keys = _key(s, shards, other, part)
                own = (mixed[rows] % self._blocks(keys).astype(np.uint64)).astype(np.int64)
                yield keys, own, False, rows
                again = np.repeat(np.arange(len(rows)), own)      # the blocks before its own
                yield keys[again], np.arange(len(again)) - np.repeat(np.cumsum(own) - own, own), True, rows[again]
                i, reached = self.trees[other].reached(_section(fps[rows], other, self.bits), self.other_reach, k)
                i, reached = i[reached < part[i]], reached[reached < part[i]]
                yield all_blocks(_key(s, shards[i], other, reached), rows[i])


# ---------------------------------------------------------------- pairs within one shard

def _close(labels: np.ndarray, rows: np.ndarray, cols: np.ndarray) -> np.ndarray:
    """Join, in ``labels``, everything that shares a row.  ``rows`` is sorted."""
    cut = np.flatnonzero(np.r_[True, rows[1:] != rows[:-1]])
    which = np.repeat(np.arange(len(cut)), np.diff(np.r_[cut, len(rows)]))
    while True:
        low = np.minimum.reduceat(labels[cols], cut)[which]
        old = labels[cols]
        if (low == old).all():
            return labels
        np.minimum.at(labels, old, low)      # the old label's own entry, then its members
        np.minimum.at(labels, cols, low)
        while (labels[labels] != labels).any():
            labels = labels[labels]


class Shard:
    """The home fingerprints of one block; links query fingerprints to them."""

    LEAF = 48

    def __init__(self, home: np.ndarray, section: int, others: list[int], bits: int, reach: int, other_reach: int,
                 max_bits: int) -> None:
        self.home, self.section, self.others, self.bits, self.max_bits = home, section, others, bits, max_bits
        self.reach = {section: reach, **{o: other_reach for o in others}}
        self.part = {s: _section(home, s, bits) for s in self.reach}
        self.labels = np.arange(len(home))

    def link(self, query: np.ndarray) -> np.ndarray:
        """Index of a linked home fingerprint per query, -1 if there is none.  Home
        fingerprints that share a query are joined in ``labels``."""
        found = np.full(len(query), -1, np.int64)
        part = {s: _section(query, s, self.bits) for s in self.reach}
        stack = [(np.arange(len(self.home)), np.arange(len(query)), self.section)]
        while stack:
            h, q, s = stack.pop()
            if not len(h) or not len(q):
                continue
            if len(h) > self.LEAF:
                v = self.part[s][h[len(h) // 2]]
                d = np.bitwise_count(self.part[s][h] ^ v)
                r = int(np.median(d))
                inner = d <= r
                if inner.all():
                    inner = d < r
                    r -= 1
                if inner.any():
                    dq = np.bitwise_count(part[s][q] ^ v).astype(np.int64)
                    stack.append((h[inner], q[dq - self.reach[s] <= r], s))
                    stack.append((h[~inner], q[dq + self.reach[s] > r], s))
                    continue
                if s == self.section:        # one value is left: go on by the other ranges
                    stack.extend((h, q, o) for o in self.others)
                    continue
            step = max(1, (1 << 21) // len(h))
            for i in range(0, len(q), step):
                sub = q[i:i + step]
                near = np.bitwise_count(self.home[h][None, :] ^ query[sub][:, None]) <= self.max_bits
                rows, cols = np.nonzero(near)
                if len(rows):
                    self.labels = _close(self.labels, rows, h[cols])
                    first = np.flatnonzero(np.r_[True, rows[1:] != rows[:-1]])
                    seen = found[sub[rows[first]]]
                    mine = h[cols[first]]
                    both = seen >= 0             # linked in another leaf already: join the two
                    for a, b in {(int(x), int(y)) for x, y in zip(seen[both], mine[both])
                                 if self.labels[x] != self.labels[y]}:
                        x, y = sorted((self.labels[a], self.labels[b]))
                        self.labels[self.labels == y] = x
                    found[sub[rows[first]]] = mine
        return found


def _link_edges(batches: Iterator[pa.RecordBatch], routes: Routes, max_bits: int) -> Iterator[pa.RecordBatch]:
    """Rows come sorted by (shard, block, query, fp): home rows first, then queries.  Holds one
    block of home fingerprints; streams the queries."""

    def edges(a: np.ndarray, b: np.ndarray) -> pa.RecordBatch:
        a, b = a.view(np.int64), b.view(np.int64)
        return pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], ["a", "b"])

    def finish(s: Shard) -> pa.RecordBatch:
        moved = s.labels != np.arange(len(s.labels))
        return edges(s.home[moved], s.home[s.labels[moved]])

    key, homes, shard = None, [], None

    def ready() -> Shard:
        section, other = _key_ranges(key[0])
        others = [o for o in range(routes.sections) if o != section and other in (-1, o)]
        s = Shard(np.concatenate(homes), section, others, routes.bits, routes.reach, routes.other_reach, max_bits)
        for i in range(0, len(s.home), 8192):     # links among the home fingerprints themselves
            s.link(s.home[i:i + 8192])
        return s

    for batch in batches:
        sh, bl, qu = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("shard", "block", "query"))
        fp = batch.column("fp").to_numpy().view(np.uint64)
        cuts = np.flatnonzero(np.r_[True, (sh[1:] != sh[:-1]) | (bl[1:] != bl[:-1]) | (qu[1:] != qu[:-1])])
        for a, b in zip(cuts, np.r_[cuts[1:], len(sh)]):
            if (now := (int(sh[a]), int(bl[a]))) != key:
                if homes:
                    yield finish(shard or ready())
                key, homes, shard = now, [], None
            if not qu[a]:
                homes.append(fp[a:b].copy())
            elif homes:
                shard = shard or ready()
                found = shard.link(fp[a:b])
                hit = found >= 0
                yield edges(fp[a:b][hit], shard.home[found[hit]])
    if homes:
        yield finish(shard or ready())


def link_fingerprints(spark: SparkSession, nodes: DataFrame, max_bits: int = 4, sections: int = 4) -> DataFrame:
    """Edges ``a``, ``b`` between distinct fingerprints (column ``fp`` of ``nodes``) that connect
    exactly what the pairs of at most ``max_bits`` differing bits connect."""
    bits = 64 // sections
    if bits > MAX_RANGE or 64 % sections:
        raise ValueError(f"{sections} ranges of {bits} bits: take 4 or more that divide 64")
    value = [F.struct(F.lit(s).alias("section"),
                      F.shiftrightunsigned("fp", s * bits).bitwiseAND(F.lit((1 << bits) - 1)).alias("value"))
             for s in range(sections)]
    # one row per range and value: 65,536 a range at most, whatever the number of fingerprints
    table = (nodes.select(F.explode(F.array(*value)).alias("x")).groupBy("x.section", "x.value")
             .agg(F.count(F.lit(1)).alias("n")).toArrow().sort_by([("section", "ascending"), ("value", "ascending")]))
    section = table.column("section").to_numpy()
    values, n = table.column("value").to_numpy().astype(np.uint64), table.column("n").to_numpy()
    routes = Routes([(values[section == s], n[section == s]) for s in range(sections)], max_bits, BLOCK_ROWS)
    if routes.divided:
        plan = spark.sparkContext.broadcast(routes)

        def parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                found, n = np.unique(plan.value.parts(batch.column("fp").to_numpy().view(np.uint64)), return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(found), pa.array(n)], ["part", "n"])

        sizes = nodes.mapInArrow(parts, "part long, n long").groupBy("part").agg(F.sum("n").alias("n"))
        # parts alike on two ranges: one row per BLOCK_ROWS / 12 fingerprints at the very most
        large = sizes.where(F.col("n") > BLOCK_ROWS).toArrow()
        routes.cut(dict(zip(large.column("part").to_pylist(), large.column("n").to_pylist())))
    shared = spark.sparkContext.broadcast(routes)

    def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            fps = whole.column("fp").to_numpy().view(np.uint64)
            for key, block, query, row in shared.value.send(fps):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(key), pa.array(block.astype(np.int32)), pa.array(np.full(len(row), query)),
                     pa.array(fps[row].view(np.int64))], ["shard", "block", "query", "fp"])

    routed = nodes.mapInArrow(route, "shard long, block int, query boolean, fp long")
    return (routed.repartition("shard", "block").sortWithinPartitions("shard", "block", "query", "fp")
            .mapInArrow(lambda it: _link_edges(it, shared.value, max_bits), "a long, b long").distinct())


# ---------------------------------------------------------------- components

def components(spark: SparkSession, edges: DataFrame) -> DataFrame:
    """``node`` and ``root`` (the least node of its component) for every node with an edge, by
    alternating large-star and small-star steps; each round is written to the shared folder."""
    def star(e: DataFrame, large: bool) -> DataFrame:
        pairs = e.select(F.col("a").alias("u"), F.col("b").alias("v"))
        back = e.select(F.col("b").alias("u"), F.col("a").alias("v"))
        both = pairs.unionAll(back)
        if not large:
            both = both.where("v < u")
        low = written(spark, both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m")),
                      "simhash-low")
        joined = join_split(both, low, ["u"])       # the hub of a large component is no single key
        if large:
            out = joined.where("v > u").select(F.col("v").alias("a"), F.col("m").alias("b"))
        else:
            out = (joined.select(F.col("v").alias("a"), F.col("m").alias("b"))
                   .unionAll(low.select(F.col("u").alias("a"), F.col("m").alias("b"))))
        return written(spark, out.where("a <> b").distinct(), "simhash-stars")

    def mark(e: DataFrame) -> tuple:
        return tuple(e.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())

    now = written(spark, edges.where("a <> b").select("a", "b"), "simhash-links")
    before = mark(now)
    while before[0]:
        now = star(star(now, True), False)
        after = mark(now)
        if after == before:
            break
        before = after
    roots = now.select(F.col("b").alias("node")).distinct()
    return (now.select(F.col("a").alias("node"), F.col("b").alias("root"))
            .unionAll(roots.select("node", F.col("node").alias("root"))))


def _rooted(fps: DataFrame, max_bits: int) -> DataFrame:
    """``fp`` and ``root`` (a fingerprint that stands for the component) per distinct fingerprint
    of the written table ``fps``; written."""
    spark = fps.sparkSession
    nodes = written(spark, fps.select("fp").distinct(), "simhash-nodes")
    edges = link_fingerprints(spark, nodes, max_bits)
    comp = components(spark, edges)
    return written(spark, nodes.join(comp, F.col("fp") == F.col("node"), "left")
                   .select("fp", F.coalesce("root", "fp").alias("root")), "simhash-roots")


def near_duplicates(docs: DataFrame, shingle: int = 4, max_bits: int = 4, seed: int = 42) -> DataFrame:
    """``doc_id``, ``fp`` and ``component_id`` (least doc_id reachable over links) per row."""
    spark = docs.sparkSession
    fps = written(spark, fingerprints(docs, shingle, seed), "simhash-fps")
    least = fps.groupBy("fp").agg(F.min("doc_id").alias("least"))
    rooted = written(spark, least.join(_rooted(fps, max_bits), "fp"), "simhash-least")
    ids = written(spark, rooted.groupBy("root").agg(F.min("least").alias("component_id")), "simhash-ids")
    named = written(spark, join_split(rooted, ids, ["root"]).select("fp", "component_id"), "simhash-named")
    return join_split(fps, named, ["fp"]).select("doc_id", "fp", "component_id")


def hex16(fp: str = "fp") -> Column:
    return F.lower(F.lpad(F.hex(F.col(fp)), 16, "0"))


def _bit_table(rows: DataFrame, bits: int) -> DataFrame:
    at = rows.select(F.pmod(F.xxhash64("_digest"), F.lit(bits)).alias("_c"))
    return at.groupBy(F.bitmap_bucket_number("_c").alias("_bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("_c")).alias("_bitmap"))


def keep_one(docs: DataFrame, shingle: int = 4, max_bits: int = 4, seed: int = 42) -> DataFrame:
    """The rows of ``docs`` that stay: one of each component, that of the least id, null ids last; of
    rows that share it the one with the least SHA-256 over all columns, and one of equal rows.

    Fingerprints are computed once.  Rows are chosen by their digests alone; no text moves but that
    of equal rows and of rows that meet another one in a bit of the tables (64 MB each at most, see
    :mod:`quarry.llm.exactdedup`)."""
    spark = docs.sparkSession
    whole = [F.col(f"`{c}`") for c in docs.columns]
    digest = F.unhex(F.sha2(F.to_json(F.struct(*whole), {"ignoreNullFields": "false"}), 256)).alias("_digest")
    fps = written(spark, fingerprints(docs.select("doc_id", "text", digest), shingle, seed, ("doc_id", "_digest")),
                  "simhash-fps")
    # per fingerprint first, so that a hot one is one row before any join
    order = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "_digest")
    first = fps.groupBy("fp").agg(F.min(order).alias("first"))
    winners = written(spark, first.join(_rooted(fps, max_bits), "fp").groupBy("root").agg(F.min("first").alias("first"))
                      .select("first._digest"), "simhash-winners")
    rows = fps.groupBy("_digest").agg(F.count(F.lit(1)).alias("n"))
    # rows that go, and rows that stay but have an equal one
    doubtful = rows.join(winners.withColumn("stays", F.lit(True)), "_digest", "left").where("stays is null or n > 1")
    bits = table_bits(fps.count())
    some = written(spark, _bit_table(doubtful, bits), "simhash-doubtful")
    again = written(spark, marked(winners, some, ["_digest"], bits, "_some").where("_some").select("_digest"),
                    "simhash-again")
    seen = marked(docs.select(F.struct(*whole).alias("row"), digest), some, ["_digest"], bits, "_some")
    clear = seen.where(~F.col("_some")).select("row.*")
    checked = marked(seen.where("_some"), written(spark, _bit_table(again, bits), "simhash-bits"),
                     ["_digest"], bits, "_again").where("_again")
    one = checked.groupBy("_digest").agg(F.first("row").alias("row")).join(again, "_digest", "left_semi")
    return clear.unionByName(one.select("row.*"))
