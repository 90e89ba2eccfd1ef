import itertools
import random

import numpy as np
import xxhash

from quarry.llm import simhash


def plain_fingerprint(text):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    n = max(1, len(words) - 3)
    hs = [xxhash.xxh64(b" ".join(words[i:i + 4]), seed=42).intdigest() for i in range(n)]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > n)


def plain_components(values, bits=4):
    """{value: least value reachable} by trying all pairs."""
    root = {v: v for v in values}

    def top(v):
        while root[v] != v:
            v = root[v]
        return v

    for a, b in itertools.combinations(sorted(set(values)), 2):
        if (a ^ b).bit_count() <= bits:
            x, y = sorted((top(a), top(b)))
            root[y] = x
    return {v: top(v) for v in root}


def test_fingerprint_and_spark_hash(spark):
    from pyspark.sql import functions as F

    texts = ["", "one", "One two\tthree\x0bfour  five", "a b c d", "Été ÀB c d e f", "x " * 4000, "a b c"]
    for t in texts:
        assert simhash.fingerprint(t.encode()) == plain_fingerprint(t)
    own = spark.createDataFrame([("a b c d",)], "s string").select(F.xxhash64("s")).first()[0] % 2 ** 64
    assert simhash.fingerprint(b"a b c d") == own


def clusters(seed, n=900):
    r = random.Random(seed)
    out = set()
    while len(out) < n:
        v = r.getrandbits(64)
        for _ in range(r.choice([1, 1, 2, 5, 40])):
            out.add(v)
            for _ in range(r.randint(1, 6)):
                v ^= 1 << r.randrange(64)
    return sorted(out)


def test_links_connect_what_all_pairs_connect(spark, monkeypatch):
    for seed, block in ((1, 1 << 14), (2, 7)):
        monkeypatch.setattr(simhash, "BLOCK_ROWS", block)
        values = clusters(seed)
        nodes = spark.createDataFrame([(int(np.uint64(v).view(np.int64)),) for v in values], "fp long")
        edges = [(r["a"] % 2 ** 64, r["b"] % 2 ** 64) for r in simhash.link_fingerprints(spark, nodes).collect()]
        want = plain_components(values)
        for a, b in edges:
            assert want[a] == want[b]
        root = {v: v for v in values}

        def top(v):
            while root[v] != v:
                v = root[v]
            return v

        for a, b in edges:
            x, y = sorted((top(a), top(b)))
            root[y] = x
        assert {v: top(v) for v in values} == want


def test_components_of_a_chain_and_a_star(spark):
    pairs = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(1, 30)] + [(500, 500)]
    edges = spark.createDataFrame(pairs, "a long, b long")
    got = {r["node"]: r["root"] for r in simhash.components(spark, edges).collect()}
    assert got == {**{i: 0 for i in range(41)}, **{100 + i: 100 for i in range(30)}}


def test_near_duplicates_and_defined_cases(spark):
    r = random.Random(5)
    words = [f"w{i}" for i in range(500)]
    base = [r.choice(words) for _ in range(700)]
    near = list(base)
    near[350] = "changed"
    rows = [(5, " ".join(base)), (3, " ".join(base).upper()), (9, " ".join(near)), (7, None), (8, ""), (2, " \t "),
            (11, "short text"), (11, "short text"), (None, "alone here"), (20, " ".join(r.choice(words) for _ in range(300)))]
    docs = spark.createDataFrame([(i, t, "x") for i, t in rows], "doc_id long, text string, fp string")
    got = simhash.near_duplicates(docs).collect()
    fp = {t: plain_fingerprint(t) for _, t in rows}
    comp = plain_components(list(fp.values()))
    least = {}
    for i, t in rows:
        if i is not None:
            c = comp[fp[t]]
            least[c] = min(i, least.get(c, i))
    want = sorted((str(i), fp[t], str(least.get(comp[fp[t]]))) for i, t in rows)
    assert sorted((str(x["doc_id"]), x["fp"] % 2 ** 64, str(x["component_id"])) for x in got) == want
    kept = simhash.keep_one(docs)
    assert kept.columns == docs.columns
    ids = sorted(str(x["doc_id"]) for x in kept.collect())
    assert ids == sorted({str(v) for v in least.values()} | {"None"})
    assert simhash.near_duplicates(docs.limit(0)).count() == 0


def test_one_row_stays_per_component(spark):
    """Components without ids, and one id in several components, each keep a row of their own."""
    r = random.Random(9)
    x, y, z, u = (" ".join(r.choice("abcdefghij") + str(r.randrange(900)) for _ in range(300)) for _ in range(4))
    near = y + " more"
    plain = {t: plain_fingerprint(t) for t in (x, y, near, z, u)}
    comp = plain_components(list(plain.values()))
    assert comp[plain[y]] == comp[plain[near]] and len({comp[plain[t]] for t in (x, y, z, u)}) == 4
    rows = [(5, x), (5, y), (7, near), (None, z), (None, z), (None, u), (5, x), (None, y)]
    docs = spark.createDataFrame([(i, t, "r") for i, t in rows], "doc_id long, text string, root string")
    kept = sorted(((str(k["doc_id"]), k["text"]) for k in simhash.keep_one(docs).collect()))
    assert kept == sorted([("5", x), ("5", y), ("None", z), ("None", u)])


def routed(values, block_rows):
    """Routed rows of distinct fingerprints, and the most rows at home in one block."""
    values = np.array(values, np.uint64)
    counts = [np.unique(simhash._section(values, s, 16), return_counts=True) for s in range(4)]
    routes = simhash.Routes(counts, 4, block_rows)
    keys, n = np.unique(routes.parts(values), return_counts=True)
    routes.cut({int(k): int(c) for k, c in zip(keys, n) if c > block_rows})
    sent, homes = 0, {}
    for key, block, query, row in routes.send(values):
        sent += len(row)
        if not query:
            for place in zip(key.tolist(), block.tolist()):
                homes[place] = homes.get(place, 0) + 1
    return sent / len(values), max(homes.values()), routes


def test_copies_of_a_fingerprint_stay_bounded():
    """A block of 16 rows stands for the real one of 65,536: the largest input is 2**28 in proportion."""
    rng = np.random.default_rng(3)
    copies = []
    for power in (10, 12, 14, 16):
        each, largest, _ = routed(rng.integers(0, 2 ** 63, 1 << power, np.uint64) * np.uint64(2), 16)
        assert largest <= 16
        copies.append(each)
    # a ball of one bit has 17 values: half of them are asked for, in four ranges
    assert max(copies) <= 4 * (1 + 17 / 2), copies


def test_crowded_range_is_divided_by_the_others():
    """Fingerprints that share a range are no single shard, and are not sent to all of its blocks."""
    rng = np.random.default_rng(4)
    low = rng.integers(0, 2 ** 48, 1 << 12, np.uint64) << np.uint64(16)      # range 0 is zero everywhere
    each, largest, routes = routed(np.unique(low), 64)
    assert routes.divided and largest <= 2 * 64
    assert each < 150, each


def test_links_of_crowded_ranges_equal_all_pairs(spark, monkeypatch):
    monkeypatch.setattr(simhash, "BLOCK_ROWS", 16)
    r = random.Random(6)
    values = set()
    for _ in range(250):
        v = r.getrandbits(48) << 16
        values.add(v)
        for _ in range(r.choice([0, 1, 3])):
            w = v
            for _ in range(r.randint(1, 6)):
                w ^= 1 << r.randrange(64)
            values.add(w)
    values = sorted(values)
    nodes = spark.createDataFrame([(int(np.uint64(v).view(np.int64)),) for v in values], "fp long")
    got = simhash.components(spark, simhash.link_fingerprints(spark, nodes)).collect()
    want = plain_components(values)
    groups = {}
    for x in got:
        groups.setdefault(x["root"], set()).add(x["node"] % 2 ** 64)
    linked = {}
    for v, top in want.items():
        linked.setdefault(top, set()).add(v)
    assert sorted(map(sorted, groups.values())) == sorted(sorted(g) for g in linked.values() if len(g) > 1)


def test_ties_are_told_apart_by_any_column(spark):
    """Rows alike in id and text, but not in another column: always the same one stays; equal rows leave one."""
    rows = [(1, "same text here for all", k) for k in (3, 1, 2)] + [(4, "other words stand here", 9)] * 3
    for order in (rows, rows[::-1]):
        kept = simhash.keep_one(spark.createDataFrame(order, "doc_id long, text string, row int").repartition(3))
        got = sorted(map(tuple, kept.collect()))
        assert len(got) == 2 and got[1] == (4, "other words stand here", 9)
        first = got[0] if order is rows else first
        assert got[0] == first
    assert simhash.keep_one(spark.createDataFrame([], "doc_id long, text string")).count() == 0
