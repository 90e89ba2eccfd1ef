import hashlib
import random
import re

from quarry.llm import decontaminate

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def split(text):
    return WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def brute(docs, items, width=10):
    out = []
    for doc, text in docs:
        w, hit, ids = split(text), set(), set()
        for item, t in items:
            v = split(t)
            n = min(width, len(v))
            for i in range(len(v) - n + 1 if n else 0):
                for j in range(len(w) - n + 1):
                    if w[j:j + n] == v[i:i + n]:
                        hit.update(range(j, j + n))
                        if item is not None:
                            ids.add(str(item))
        out.append((doc, len(w), len(hit), tuple(sorted(ids))))
    return sorted(out, key=repr)


def longest_common(a, b, cache={}):
    """Length of the longest run of words that both have."""
    key = (tuple(a), tuple(b))
    if key not in cache:
        best, row = 0, [0] * (len(b) + 1)
        for x in a:
            row = [0] + [row[j] + 1 if x == y else 0 for j, y in enumerate(b)]
            best = max(best, max(row))
        cache[key] = best
    return cache[key]


def found(spark, docs, items, **kw):
    d = spark.createDataFrame(docs, "doc_id long, text string")
    b = spark.createDataFrame(items, "item_id long, text string")
    rows = decontaminate.contamination(d, b, **kw).collect()
    for r in rows:
        assert sum(s["end"] - s["start"] for s in r["spans"]) == r["n_hit"]
        texts = [split(t) for i, t in docs if i == r["doc_id"]]
        for m in r["matches"]:
            own = [split(t) for i, t in items if str(i) == m["item"]]
            assert any(t[m["start"]:m["start"] + m["words"]] == v[m["item_start"]:m["item_start"] + m["words"]]
                       and len(v) >= m["item_start"] + m["words"] for t in texts for v in own)
            assert m["words"] == max(longest_common(t, v) for v in own for t in texts[:1])
        assert r["longest"] == max([0, *(m["words"] for m in r["matches"])])
    return sorted(((r["doc_id"], r["n_words"], r["n_hit"], tuple(r["items"])) for r in rows), key=repr)


def random_case(seed):
    r = random.Random(seed)
    voc = [f"w{i}" for i in range(6)] + ["été", "Ab", "x1"]
    items = [(i, " ".join(r.choice(voc) for _ in range(r.choice([0, 1, 3, 9, 10, 11, 14, 30])))) for i in range(12)]
    docs = []
    for i in range(25):
        w = [r.choice(voc + ["qq", "zz"]) for _ in range(r.randint(0, 60))]
        if i % 3 == 0:
            part = items[r.randrange(12)][1].split()
            at = r.randint(0, len(w))
            w[at:at] = part[: r.randint(0, len(part))] if i % 2 else part
        docs.append((i, r.choice([" ", ", ", "-"]).join(w)))
    return docs, [x for x in items if len(x[1].split()) != 1 or seed % 2]


def test_equals_brute_force(spark):
    for seed in range(4):
        docs, items = random_case(seed)
        assert found(spark, docs, items) == brute(docs, items)


def test_benchmark_in_many_shards(spark):
    docs, items = random_case(7)
    assert found(spark, docs, items, shard_bytes=150) == brute(docs, items)


def test_defined_cases(spark):
    items = [(1, "one two three"), (1, "four five"), (2, None), (3, "..."), (None, "six seven"), (4, "ONE two THREE")]
    docs = [(1, None), (2, ""), (3, "zero One, TWO three! x"), (3, "zero One, TWO three! x"), (None, "six seven"),
            (5, "one two"), (6, "four five " * 40000)]
    assert found(spark, docs, items) == brute(docs[:-1], items) + [(6, 80000, 80000, ("1",))] or \
        sorted(found(spark, docs, items), key=repr) == sorted(brute(docs[:-1], items) + [(6, 80000, 80000, ("1",))], key=repr)
    assert found(spark, [], items) == []
    assert found(spark, docs[2:3], []) == [(3, 5, 0, ())]


def test_remove_keeps_columns_and_clean_rows(spark):
    docs = spark.createDataFrame([(1, "a one two three b", "x", 5), (2, "one two", "y", 6), (3, None, "z", 7)],
                                 "doc_id long, text string, items string, n_words int")
    bench = spark.createDataFrame([(1, "one two three")], "item_id long, text string")
    kept = decontaminate.remove_contaminated(docs, bench)
    assert kept.columns == docs.columns
    assert sorted(tuple(r) for r in kept.collect()) == [(2, "one two", "y", 6), (3, None, "z", 7)]


def test_digest():
    assert decontaminate.items_digest(["10", "2"]) == hashlib.sha256(b"10,2").hexdigest()


def test_pairs_in_any_number_at_a_time(spark, monkeypatch):
    """Listed at once, text by text, item by item, or by a running comparison: the same matches."""
    import numpy as np

    for seed in range(6):
        r = random.Random(seed)
        voc = ["a", "b"] if seed % 2 else ["a", "b", "c", "d"]
        items = [(k, " ".join(r.choice(voc) for _ in range(r.choice([2, 4, 7, 15])))) for k in range(8)]
        texts = [" ".join(r.choice(voc) for _ in range(r.randint(0, 40))).encode() for _ in range(9)]
        bench = decontaminate.Benchmark(items, 3)
        got = {}
        for limit in (1, 5, 40, 10 ** 9):
            monkeypatch.setattr(decontaminate, "PAIRS", limit)
            monkeypatch.setattr(decontaminate.longest_matches, "__defaults__", (limit,))
            got[limit] = [(list(n), s, [sorted(m) for m in x]) for _, n, s, x in decontaminate._matches(texts, bench)]
            got[limit] = [row for n, s, x in got[limit] for row in zip(n, s, x)]
        assert got[1] == got[5] == got[40] == got[10 ** 9]
        for text, (_, _, matches) in zip(texts, got[1]):
            for item, start, inside, size in matches:
                own = items[int(item)][1].split()
                assert text.decode().split()[start:start + size] == own[inside:inside + size]
                assert size == longest_common(text.decode().split(), own)


def test_repeated_words_and_shared_passages_in_bounded_memory(spark):
    import resource

    shared = " ".join(f"s{i}" for i in range(12))
    items = [(0, "same " * 5000)] + [(k, f"own{k} {shared} tail{k}") for k in range(1, 401)]
    bench = decontaminate.Benchmark(items, 10)
    before = resource.getrusage(resource.RUSAGE_SELF).ru_maxrss
    texts = [b"same " * 200_000] + [shared.encode()] * 10_000
    rows, n = 0, 0
    for at, n_words, spans, matches in decontaminate._matches(texts, bench):
        assert at == rows
        rows += len(n_words)
        n += sum(map(len, matches))
        if at == 0:
            assert matches[0] == [("0", 0, 0, 5000)] and spans[0] == [(0, 200_000)]
        else:
            assert {m[3] for m in matches[0]} == {12}
    assert rows == 10_001 and n == 1 + 400 * 10_000
    assert resource.getrusage(resource.RUSAGE_SELF).ru_maxrss - before < 400_000      # KB
