import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from quarry.llm import catalog, quality, toxicity
from quarry.llm.common import id_remainder

SF = "/root/testdata/sf0.1"


def measured(spark, query, label, modulus, remainder):
    y = {r["doc_id"]: r[label] for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    rows = query(spark, SF).collect()
    assert len(rows) == spark.read.parquet(f"{SF}/documents.parquet").count()
    for r in rows:
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % modulus == remainder)
        assert 0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.7)
    held = [(y[r["doc_id"]], r["predicted"]) for r in rows if r["held_out"] and y.get(r["doc_id"]) is not None]
    return (np.mean([p for t, p in held if t == 1]), np.mean([p for t, p in held if t == 0]))


def test_toxicity_on_held_out_documents(spark):
    caught, wrong = measured(spark, catalog.op7_toxicity, "toxic", 3, 1)
    assert caught > 0.8 and wrong < 0.005


def test_quality_on_held_out_documents(spark):
    good, bad = measured(spark, catalog.op9_quality_classifier, "quality", 4, 2)
    assert good > 0.97 and bad < 0.1


def test_pairs_weigh_more_than_their_parts():
    """An insult alone, and a group alone, are label 0; together they are label 1."""
    rng = np.random.default_rng(0)
    rows, y = [], []
    for _ in range(3000):
        a, b = rng.random(2) < 0.5
        rows.append(np.array(sorted({*([0] if a else []), *([1] if b else []), *rng.integers(2, 30, 3)}), np.int64))
        y.append(float(a and b))
    bias, w, v = toxicity.fit(rows, np.array(y), 30)
    z = lambda *t: bias + w[list(t)].sum() + sum(v[i] @ v[j] for n, i in enumerate(t) for j in t[n + 1:])
    assert z(0, 1) > 1 > -1 > max(z(0), z(1), z())


def test_terms_equal_the_plain_set():
    texts = ["", "Abc abc defghij", "éa 12 abcd-efgh", None or ""]
    doc, bucket = toxicity.terms(texts)
    assert len(set(zip(doc.tolist(), bucket.tolist()))) == len(doc)
    assert [int((doc == i).sum()) for i in range(4)] == [0, 5, 3, 0]


CASES = [(1, None), (2, ""), (None, "some text"), (4, "some text"), (4, "some text"), (5, "word " * 100000)]


@pytest.mark.parametrize("labels", [[], [(4, 1)], [(4, 0)], [(4, 1), (2, 0), (5, None), (None, 1), (5, 0), (5, 1)]])
def test_defined_cases(spark, labels):
    docs = spark.createDataFrame([(i, t, 0.5) for i, t in CASES], "doc_id long, text string, score double")
    lab = spark.createDataFrame(labels, "doc_id long, label int")
    sample = toxicity.labelled_texts(docs, lab, "label", F.lit(True), 100)
    for module in (toxicity, quality):
        got = module.score(docs, module.train(sample)).collect()
        assert len(got) == len(CASES) and all(0 <= r["score"] <= 1 for r in got)
        assert module.score(docs.limit(0), module.train(sample)).count() == 0
    kept = quality.keep_good(docs, quality.train(sample), 0.0)
    assert kept.columns == docs.columns and kept.count() == len(CASES)


def test_quality_of_long_texts(spark):
    """Held-out documents of one label, joined to texts of several MB, keep that label."""
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    held = id_remainder("doc_id", 4) == 2
    model = quality.train(toxicity.labelled_texts(docs, labels, "quality", ~held, quality.SAMPLE))
    rows = (docs.where(held & F.col("text").isNotNull()).join(labels.select("doc_id", "quality"), "doc_id")
            .orderBy("doc_id").select("text", "quality").collect())
    sizes = quality.Sizes(model.good, model.bad)
    for label in (0, 1):
        whole = " ".join(r["text"] for r in rows if r["quality"] == label).encode()
        whole *= -(-(4 << 20) // len(whole))
        for size in (20 << 10, 400 << 10, 4 << 20):
            s = model.scores(sizes.features([whole[:size]]))[0]
            assert s >= 0.7 if label else s < 0.5, (label, size, s)


def test_toxicity_of_long_texts(spark):
    """Held-out clean documents joined to several MB stay clean; a toxic one among them is found."""
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    held = id_remainder("doc_id", 3) == 1
    model = toxicity.train(toxicity.labelled_texts(docs, labels, "toxic", ~held, toxicity.SAMPLE))
    rows = (docs.where(held & F.col("text").isNotNull()).join(labels.select("doc_id", "toxic"), "doc_id")
            .orderBy("doc_id").select("text", "toxic").collect())
    clean, bad = ([r["text"] for r in rows if r["toxic"] == k] for k in (0, 1))
    half = len(clean) // 2
    assert len(" ".join(clean)) > 2 << 20
    assert model.scores([" ".join(clean), " ".join(clean[::-1] + clean[::3])]).max() < 0.7
    caught = [t for t, s in zip(bad, model.scores(bad)) if s >= 0.7][:10]
    assert len(caught) == 10
    inside = model.scores([" ".join([*clean[:half], t, *clean[half:]]) for t in caught])
    assert (inside >= 0.7).sum() >= 9


def test_windows_cover_every_word_and_neighbour():
    doc = np.repeat([0, 2, 3], [9, 1, 4])
    low, high, text = toxicity.windows(doc, 5, 4)
    assert text.tolist() == [0, 0, 0, 0, 1, 2, 3, 4]
    assert low.tolist() == [0, 0, 0, 0, 1, 1, 2, 2, 3, 5, 6, 6, 6, 6]
    assert high.tolist() == [0, 0, 1, 1, 2, 2, 3, 3, 3, 5, 6, 6, 6, 6]


def test_sample_has_one_row_per_id(spark):
    docs = spark.createDataFrame([(1, f"text {i}") for i in range(500)] + [(1, None), (2, "b"), (2, "a"), (3, "c"), (None, "n")],
                                 "doc_id long, text string")
    labels = spark.createDataFrame([(1, 1), (1, 1), (2, 0), (4, 0), (None, 1)], "doc_id long, label int")
    got = toxicity.labelled_texts(docs, labels, "label", F.lit(True), 100).orderBy("doc_id").collect()
    assert [tuple(r) for r in got] == [(1, "", 1, 1.0), (2, "a", 0, 1.0)]


def test_machine_equals_a_double_loop_over_pairs():
    rng = np.random.default_rng(8)
    model = toxicity.Model(np.zeros(0, np.int32), 0.3, rng.normal(size=40), rng.normal(size=(40, toxicity.FACTORS)))
    sets = [sorted(rng.choice(40, n, replace=False).tolist()) for n in (0, 1, 2, 7, 25, 0)]
    at = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    got = model.sums(at, np.array([t for s in sets for t in s], np.int64), len(sets))
    for s, value in zip(sets, got):
        plain = model.bias + sum(model.weight[i] for i in s)
        for n, i in enumerate(s):
            for j in s[n + 1:]:
                plain += sum(a * b for a, b in zip(model.factors[i], model.factors[j]))
        assert abs(plain - value) < 1e-9


def test_windows_of_the_fit():
    """The highest window of a text of label 1 wherever it lies, the highest few of label 0; evenly spaced ones first."""
    each = [1, 50, 3, 40]
    text, label = np.repeat(np.arange(4), each), np.array([0, 1, 1, 0])
    rng = np.random.default_rng(2)
    value = rng.permutation(len(text)).astype(float)
    value[1 + 49] = 1000.0                              # the last window of text 1
    some = toxicity.fit_windows(text, label, value)
    for k in range(4):
        mine = np.flatnonzero(text == k)
        n = 1 if label[k] else toxicity.FIT_WINDOWS
        assert sorted(some[text[some] == k]) == sorted(mine[np.argsort(-value[mine])[:n]])
    assert 50 in some
    spaced = toxicity.fit_windows(text, label, None)
    assert [int((text[spaced] == k).sum()) for k in range(4)] == [min(n, toxicity.FIT_WINDOWS) for n in each]


def test_compressed_sizes_and_calibration_equal_plain_ones():
    import zstandard

    rng = np.random.default_rng(1)
    words = [f"word{i}" for i in range(300)]
    good, bad = (" ".join(rng.choice(words[a:b], 4000)).encode() for a, b in ((0, 200), (100, 300)))
    sizes = quality.Sizes(good, bad)
    texts = [b"", b"short", (" ".join(rng.choice(words, 9000))).encode()]

    def plain(raw, text):
        c = zstandard.ZstdCompressor(dict_data=zstandard.ZstdCompressionDict(raw), level=quality.LEVEL)
        return sum(len(c.compress(text[a:a + quality.BLOCK])) for a in range(0, max(len(text), 1), quality.BLOCK))

    for t, row in zip(texts, sizes.features(texts)):
        g, b, n = plain(good, t), plain(bad, t), len(t) + quality.SMOOTH
        assert np.allclose(row, [(b - g) / (b + g), (b - g) / n, min(g, b) / n], rtol=0.01, atol=0.002)
    x = rng.normal(size=(400, 3))
    y = (x @ [1.0, -2.0, 0.5] + rng.normal(size=400) > 0.3).astype(float)
    weight = rng.uniform(0.5, 2, 400)
    center, w, bias = quality.calibrate(x, y, weight)

    def keep(w, b):
        margin = np.where(y == 1, 1, -1) * ((x - center) @ w + b)
        ridge = 1e-3 * ((w * x.std(axis=0)) ** 2).sum() + 1e-4 * b * b
        return (weight * np.logaddexp(0, -margin)).sum() / weight.sum() + ridge / 2

    least = keep(w, bias)
    for k in range(3):
        for step in (-0.05, 0.05):
            assert keep(w + step * np.eye(3)[k], bias) > least and keep(w, bias + step) > least


def test_dictionary_blocks_do_not_depend_on_the_partitioning(spark, monkeypatch):
    monkeypatch.setattr(quality, "BLOCK", 100)
    monkeypatch.setattr(quality, "DICTIONARY_SOURCE", 20000)
    rows = [(i, f"{i} " * (60 if i else 20000)) for i in range(400)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    a, b = (quality.dictionary_blocks(df.repartition(n)) for n in (1, 7))
    assert a == b and 15000 < sum(map(len, a)) < 25000
    whole = {t[i:i + 100].encode() for _, t in rows for i in range(0, len(t), 100)}
    assert set(a) <= whole and len(quality.dictionary_blocks(df.where("doc_id > 0").limit(30))) > 30
