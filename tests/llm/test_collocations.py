import random
import re
from collections import Counter, defaultdict

import pytest

from quarry.llm import collocations as co


def brute(rows, least, top, absorbed=80):
    f, n = defaultdict(Counter), Counter()
    for lang, text in rows:
        low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", low):
            w = [x for x in re.split(r"[\x20\x09]+", piece) if x]
            n[lang or "und"] += len(w)
            for k in (1, 2, 3, 4):
                f[lang or "und"].update(tuple(w[i:i + k]) for i in range(len(w) - k + 1))
    out = []
    for lang, count in f.items():
        cand = {p: a for p, a in count.items() if len(p) > 1 and a >= least}
        inside = defaultdict(int)
        for p, a in cand.items():
            for m in range(2, len(p)):
                for i in range(len(p) - m + 1):
                    inside[p[i:i + m]] = max(inside[p[i:i + m]], a)
        scored = []
        for p, a in cand.items():
            if 100 * inside[p] >= absorbed * a and inside[p]:
                continue
            s, k = min((2000000 * a // (count[p[:k]] + count[p[k:]]), k) for k in range(1, len(p)))
            scored.append((-s, -a, " ".join(p).encode(), count[p[:k]], count[p[k:]]))
        for rank, (s, a, p, left, right) in enumerate(sorted(scored)[:top], 1):
            out.append((lang, rank, p.decode(), -a, left, right, n[lang], -s))
    return sorted(out)


def found(spark, rows, least=3, top=50, parts=3, **kw):
    df = spark.createDataFrame([(i, lang, text, "x") for i, (lang, text) in enumerate(rows)],
                               "doc_id long, lang string, text string, w1 string").repartition(parts)
    got = co.phrases(df, least, top, **kw)
    assert got.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    return sorted(tuple(r) for r in got.collect())


def texts(seed, docs, words):
    rng = random.Random(seed)
    ends = [" ", " ", " ", " ", "  ", "\t", ". ", ",", "\n", " ! ", "\x1c", " é "]
    return [(rng.choice(["en", "fr", None, "und"]),
             "".join(rng.choice(["the", "The", "of", "new", "york", "city", "a", "ÉA", "x-y"]) + rng.choice(ends)
                     for _ in range(rng.randint(0, words)))) for _ in range(docs)]


def test_equals_brute_force(spark):
    rows = texts(4, 120, 60) + [("en", None), (None, None), ("de", ""), ("en", "one two three four five")] * 3
    assert found(spark, rows) == brute(rows, 3, 50)
    assert found(spark, rows, 12, 7, absorbed=50) == brute(rows, 12, 7, 50)


def test_blocks_cut_between_words_change_nothing(spark, monkeypatch):
    rng = random.Random(2)
    for limit in (1, 7, 30, 500):
        for text in ["", "   ", "a b c d e f g " * 9, "w" * 60 + " b c d. e", "a. b c. d e f g h" * 5]:
            data = text.encode().translate(co._MAP)
            whole = data.replace(b"\xff", b" \xff ").split()
            got = list(co.blocks(data, limit))
            assert [w for words, own in got for w in words[:own]] == whole
            at = 0
            for words, own in got:
                at += own
                rest = whole[at:at + 3]
                rest = rest[:rest.index(b"\xff")] if b"\xff" in rest else rest
                assert words[own:] == rest + [b"\xff"]
    # the same counts with tiny blocks, on the worker's own code
    import pyarrow as pa
    import numpy as np
    text = "".join(rng.choice("ab cd ef. gh ij kl, ".split(" ")) + " " for _ in range(400))
    batch = pa.RecordBatch.from_pydict({"lang": ["en", "en"], "text": [text, "ab " * 50]})
    full = np.full(4096, 255, np.uint8)

    def counted():
        c = Counter()
        for b in co._count_windows(iter([batch]), 32768, full):
            for r in b.to_pylist():
                c[r["window"]] += r["n"]
        return c
    want = counted()
    monkeypatch.setattr(co.blocks, "__defaults__", (11,))
    assert counted() == want


def test_every_class_rare_or_shared(spark, monkeypatch):
    rows = texts(8, 60, 80)
    monkeypatch.setattr(co, "MAX_CLASSES", 1)        # fewest classes
    assert found(spark, rows, 5) == brute(rows, 5, 50)


def test_repeats_ties_and_empty_tables(spark):
    rows = [("en", "b c. a d. e f")] * 5
    got = found(spark, rows, 5)
    assert got == brute(rows, 5, 50) and [r[2] for r in got] == ["a d", "b c", "e f"]
    assert found(spark, [("en", "a a a a a a")], 3) == brute([("en", "a a a a a a")], 3, 50)
    assert found(spark, [("en", "one two")], 3) == []
    assert found(spark, [], 3) == []


def test_a_long_text(spark):
    rows = [("en", "new york city . " * 200_000), ("en", "a b c d " * 150_000)]
    got = found(spark, rows, 30)
    assert {r[2]: r[3] for r in got} == {"new york city": 200_000, "a b c d": 150_000, "b c d a": 149_999,
                                         "c d a b": 149_999, "d a b c": 149_999}


@pytest.mark.parametrize("a,l,r", [(3 * 10 ** 14, 3 * 10 ** 14, 5 * 10 ** 14), (2 ** 61, 2 ** 61, 2 ** 61)])
def test_exact_score_beyond_64_bits(spark, a, l, r):
    df = spark.createDataFrame([(a, l, r)], "a long, l long, r long")
    assert df.selectExpr(f"{co.SCORE} AS s").first()["s"] == 2000000 * a // (l + r)
