import os
import random

from pyspark.sql import functions as F

from quarry.functions import text as tx

WS_POINTS = [0x09, 0x0A, 0x0B, 0x0C, 0x0D, 0x1C, 0x1D, 0x1E, 0x1F, 0x20, 0x85, 0xA0, 0x1680,
             *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]


def test_whitespace_class_is_pythons():
    import sys
    assert [c for c in range(sys.maxunicode + 1) if chr(c).isspace()] == WS_POINTS


def _random_strings(n=300):
    random.seed(5)
    alphabet = [chr(c) for c in WS_POINTS] + list("ab céд中.,:/w") + ["​", "﻿"]
    return ["".join(random.choice(alphabet) for _ in range(random.randint(0, 30))) for _ in range(n)]


def test_tokenize_strip_collapse_match_python(spark):
    strs = _random_strings() + ["".join(f"x{chr(c)}" for c in WS_POINTS) + "y", ""]
    df = spark.createDataFrame([(i, s) for i, s in enumerate(strs)], "i int, s string").select(
        "i", tx.tokenize("s").alias("t"), tx.strip_ws("s").alias("st"), tx.collapse_ws("s").alias("co"))
    for r in df.collect():
        s = strs[r["i"]]
        assert list(r["t"]) == s.split()
        assert r["st"] == s.strip()
        assert r["co"] == " ".join(s.split())


def test_find_links_fixture(spark):
    s = "see http://a.b/c, www.x.y and https://www.q HTTP://no ftp://www.z"
    got = spark.createDataFrame([(s,)], "s string").select(tx.find_links("s").alias("l")).first()["l"]
    assert list(got) == ["http://a.b/c,", "www.x.y", "https://www.q", "www.z"]


def test_links_match_python_regex(spark):
    import re
    pat = re.compile(r"https?://\S+|www\.\S+")
    strs = [s.replace("w", "www.").replace(":/", "http://") for s in _random_strings()]
    df = spark.createDataFrame([(i, s) for i, s in enumerate(strs)], "i int, s string").select(
        "i", tx.find_links("s").alias("l"))
    for r in df.collect():
        assert list(r["l"]) == pat.findall(strs[r["i"]])


def test_extension_matches_splitext(spark):
    names = ["a.html", "A.HTML", ".html", "..html", "a.b.PDF", "noext", "dir/x.docx", "x.", "..a.b", ".a.b"]
    df = spark.createDataFrame([(n,) for n in names], "n string").select(
        "n", tx.extension("n").alias("e"), tx.has_supported_suffix("n").alias("ok"))
    for r in df.collect():
        assert r["e"] == os.path.splitext(os.path.basename(r["n"]))[1].lower()
        assert r["ok"] == os.path.basename(r["n"]).lower().endswith(tx.SUPPORTED_EXTENSIONS)


def test_non_ascii_ratio(spark):
    strs = ["abc", "абв", "", "aб", "Сайт 1"]
    df = spark.createDataFrame([(s,) for s in strs], "s string").select("s", tx.non_ascii_ratio("s").alias("r"))
    for r in df.collect():
        s = r["s"]
        assert abs(r["r"] - sum(1 for ch in s if ord(ch) > 127) / max(1, len(s))) < 1e-12


def test_utf8_validity(spark):
    df = spark.createDataFrame([(b"ok \xd0\xb4",), (b"bad \xff",)], "b binary").select(
        tx.is_valid_utf8("b").alias("v"), tx.decode_utf8("b").alias("s"))
    rows = df.collect()
    assert [r["v"] for r in rows] == [True, False]
    assert rows[0]["s"] == "ok д" and rows[1]["s"] is None


def test_pickled_width(spark):
    vals = [0, 255, 256, 65535, 65536, 2 ** 31 - 1, 2 ** 31, 2 ** 40, 2 ** 62]
    df = spark.createDataFrame([(v,) for v in vals], "n long").select("n", tx.pickled_int_width("n").alias("w"))
    import pickle
    for r in df.collect():
        # one int inside a list: list bytes minus the list overhead of [x]
        assert r["w"] == len(pickle.dumps([r["n"]], protocol=4)) - 15


def test_whitespace_regex_over_every_bmp_code_point(spark):
    pts = [c for c in range(0x10000) if not 0xD800 <= c <= 0xDFFF]
    df = spark.createDataFrame([(c, "a" + chr(c) + "b") for c in pts], "c int, s string").select(
        "c", (F.size(tx.tokenize("s")) == 2).alias("ws"))
    got = {r["c"] for r in df.collect() if r["ws"]}
    assert got == {c for c in pts if chr(c).isspace()}

