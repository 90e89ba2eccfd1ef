import random

from quarry.llm import catalog, tokencount


def greedy(word, start, rest):
    """Number of longest-match pieces of the marked word, -1 if it cannot be covered.  ``start`` holds
    the pieces that begin with the mark, whole."""
    n, at, word = 0, 0, tokencount.MARK + word
    while at < len(word):
        known = rest if at else start
        end = next((e for e in range(len(word), at, -1) if word[at:e] in known), None)
        if end is None:
            return -1
        n, at = n + 1, end
    return n


def sets(pieces):
    return ({p for p in pieces if p.startswith(tokencount.MARK)}, {p for p in pieces if not p.startswith(tokencount.MARK)})


def test_automaton_equals_greedy_matching():
    r = random.Random(4)
    for _ in range(60):
        pieces = list(({"▁"} if r.random() < 0.5 else set()) | {("▁" if r.random() < 0.5 else "") + "".join(r.choice("abc") for _ in range(r.randint(1, 5))) for _ in range(14)})
        a, (start, rest) = tokencount.Automaton(pieces), sets(pieces)
        for _ in range(80):
            w = "".join(r.choice("abcd" if r.random() < 0.1 else "abc") for _ in range(r.randint(1, 14)))
            assert a.count(w) == greedy(w, start, rest), (pieces, w)


def test_whole_table(spark):
    start, rest = sets(tokencount.vocabulary())
    docs = {r["doc_id"]: r["text"] for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()}
    rows = catalog.op10_token_counts(spark, "/root/testdata/sf0.001").collect()
    assert len(rows) == len(docs)
    for r in rows:
        counts = [greedy(w.decode(), start, rest) for w in docs[r["doc_id"]].encode().split()]
        assert (r["n_words"], r["n_tokens"], r["n_unknown"]) == (
            len(counts), sum(abs(c) for c in counts), sum(c < 0 for c in counts))


def test_the_mark_alone_is_a_piece(spark):
    assert tokencount.MARK in tokencount.vocabulary()
    a = tokencount.Automaton(["▁", "▁th", "ç", "tre", "e"])
    assert (a.count("çtre"), a.count("the"), a.count("tre"), a.count("x")) == (3, 2, 2, -1)
    rows = catalog.op10_token_counts(spark, "/root/testdata/sf0.01").collect()
    assert sum(r["n_words"] for r in rows) > 300_000 and sum(r["n_unknown"] for r in rows) == 0


def test_defined_cases(spark):
    df = spark.createDataFrame([(1, None), (2, " \t"), (None, "the"), (4, "the"), (4, "the"), (5, "a" * 300000)],
                               "doc_id long, text string").selectExpr("*", "1 AS n_tokens")
    got = sorted((r["doc_id"] or 0, r["n_words"], r["n_tokens"]) for r in tokencount.count_tokens(df).collect())
    assert got[:5] == [(0, 1, 1), (1, 0, 0), (2, 0, 0), (4, 1, 1), (4, 1, 1)] and got[5][2] > 1
    assert tokencount.count_tokens(df.limit(0)).count() == 0
