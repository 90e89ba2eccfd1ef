import zlib

import pytest
from pyspark.sql import functions as F

from quarry.llm import catalog, langid

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def model(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    return langid.train(docs.where(F.crc32(F.col("doc_id").cast("string")) % 3 != 1))


def test_held_out_accuracy_and_contract(spark):
    got = catalog.op2_language_id(spark, SF).collect()
    lang = {r["doc_id"]: r["lang"] for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    assert len(got) == len(lang)
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1) for r in got)
    held = [r for r in got if r["held_out"] and lang[r["doc_id"]]]
    assert sum(r["lang_pred"] == lang[r["doc_id"]] for r in held) / len(held) > 0.97
    assert all(0 <= r["score"] <= 1 for r in got)


def test_spans_of_mixed_text(spark, model):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    a, b = (docs.where((F.col("lang") == x) & F.length("text").between(500, 3000)).orderBy("doc_id").first()["text"]
            for x in ("en", "de"))
    mixed = spark.createDataFrame([(1, a + " " + b)], "doc_id long, text string")
    spans = langid.predict(mixed, model).first()["spans"]
    assert [s["lang"] for s in spans] == ["en", "de"]
    assert abs(spans[1]["start"] - len(a) - 1) < 30


def test_viterbi_equals_the_plain_recursion():
    import itertools

    import numpy as np

    rng = np.random.default_rng(1)
    doc = np.repeat([0, 1, 3], [6, 1, 4])
    scores = rng.normal(0, 3, (len(doc), 3))
    got = langid.viterbi(scores, doc, 4, 2.5)
    for d in (0, 1, 3):
        s = scores[doc == d]
        value = lambda p: sum(s[i, x] for i, x in enumerate(p)) - 2.5 * sum(x != y for x, y in zip(p, p[1:]))
        best = max(itertools.product(range(3), repeat=len(s)), key=value)
        assert value(tuple(got[doc == d])) == pytest.approx(value(best))


def test_defined_cases(spark, model):
    rows = [(1, None, "x"), (2, "", "x"), (3, "123 !?", "x"), (4, "漢字", "x"), (None, "the and of", "x"),
            (6, "der und die", "x"), (6, "der und die", "x"), (7, "the and of the " * 30000, "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang_pred string")
    got = sorted(((r["doc_id"] or 0, r["lang_pred"], r["score"]) for r in langid.predict(docs, model).collect()))
    assert [x[1] for x in got] == ["en", "und", "und", "und", "en", "de", "de", "en"]
    assert got[4][2] == 0 and got[1][2] == 0
    assert [r["doc_id"] for r in langid.keep_identified(docs, model).orderBy("doc_id").collect()] == [None, 6, 6, 7]
    assert langid.predict(docs.limit(0), model).count() == 0


def test_no_training_text(spark):
    docs = spark.createDataFrame([(1, "the", None)], "doc_id long, text string, lang string")
    assert langid.predict(docs, langid.train(docs)).first()["lang_pred"] == "und"


def test_scripts_narrow_the_candidates(spark):
    rows = [(i, t, x) for i, (t, x) in enumerate([("кот и собака идут", "ru"), ("the cat and dog", "en"),
                                                  ("ο γάτος και", "el")] * 5)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = langid.train(docs)
    test = spark.createDataFrame([(1, "нечто"), (2, "άλλο"), (3, "zzz"), (4, "漢")], "doc_id long, text string")
    assert [r["lang_pred"] for r in langid.predict(test, model).orderBy("doc_id").collect()][:3] == ["ru", "el", "en"]


def test_score_counts_letters_of_unlearned_scripts(spark, model):
    rows = [(1, "漢" * 10000 + " the"), (2, "кот " * 3000 + "the and of"), (3, "the and of " * 100 + "漢" * 80)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    score = {r["doc_id"]: r["score"] for r in langid.predict(docs, model).collect()}
    assert score[1] == pytest.approx(3 / 10003) and score[2] == pytest.approx(8 / 9008)
    assert score[3] == pytest.approx(800 / 880)
    assert [r["doc_id"] for r in langid.keep_identified(docs, model, 0.35).collect()] == [3]
