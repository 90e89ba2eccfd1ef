import os
import tempfile
from html.parser import HTMLParser

from pyspark.sql import functions as F

from quarry.functions import html as hx
from quarry.operators import documents as docs
from quarry.plans import adapters
from tests.docx_fixture import docx


class _Visible(HTMLParser):
    """Golden: the standard library's parser, text nodes outside hidden elements."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.parts, self.hidden = [], 0

    def handle_starttag(self, tag, attrs):
        self.hidden += tag in ("script", "style", "template")

    def handle_endtag(self, tag):
        self.hidden -= tag in ("script", "style", "template") and self.hidden > 0

    def handle_data(self, data):
        if not self.hidden:
            self.parts.append(data)


def golden(markup):
    p = _Visible()
    p.feed(markup)
    p.close()
    return " ".join(" ".join(p.parts).split())


def test_html_fixtures(spark):
    cases = {
        "<b>foo</b>bar": "foo bar",
        "foo<!--x-->bar": "foo bar",
        "a&amp;lt;b": "a&lt;b",
        "<html><head><title>T</title><style>p{}</style><script>var t='</p>';</script></head>"
        "<body><p>Hi &copy; there</p></body></html>": "T Hi © there",
        "<!DOCTYPE html><p>x</p>": "x",
        "a &mdash; b &#8212; c &laquo;d&raquo; &#39; <a title='x>y'>z</a>": "a — b — c «d» ' z",
        "&#x1F600; &#128512; &#x41;&#0065; &#65 &copy2 &notit; &notin; &unknown; &; & &# &#x;":
            "😀 😀 AA A ©2 ¬it; ∉ &unknown; &; & &# &#x;",
        "&#150; &#x80; &#0; &#xD800; &#1114112; &#99999999999; &#1;x &NotEqualTilde; &amp;amp;": None,
        '<img alt="a>b" title=\'c"d>e\'>after <i class="unclosed>x</i>': 'after x',
        "a < b and c > d": "a < b and c > d",
        "plain": "plain", "": "",
    }
    df = spark.createDataFrame([(s,) for s in cases], "h string")
    got = {r["h"]: r["a"] for r in df.select("h", hx.html_to_text("h").alias("a")).collect()}
    for src, want in cases.items():
        assert got[src] == (golden(src) if want is None else want), src
    assert golden("a &mdash; b &#8212; c &laquo;d&raquo; &#39; <a title='x>y'>z</a>") == "a — b — c «d» ' z"


def test_every_named_reference(spark):
    from html.entities import html5

    names = sorted(html5)
    df = spark.createDataFrame([(n,) for n in names], "n string")
    got = df.select("n", hx.decode_references(F.concat(F.lit("x&"), "n", F.lit(" y"))).alias("t")).collect()
    assert all(r["t"] == f"x{html5[r['n']]} y" for r in got) and len(got) == len(names)


def test_pages_equal_the_golden(spark):
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    for r in pages.select("html", hx.html_to_text("html").alias("a")).collect():
        assert r["a"] == golden(r["html"])


def _folder():
    d = tempfile.mkdtemp(prefix="quarry-folder-")
    with open(os.path.join(d, "A.HTML"), "w", encoding="utf-8") as f:
        f.write("<p>Visit www.example.org now</p>")
    with open(os.path.join(d, "b.txt"), "w") as f:
        f.write("plain")
    with open(os.path.join(d, "bad.html"), "wb") as f:
        f.write(b"<p>\xff\xfe</p>")
    with open(os.path.join(d, "doc.docx"), "wb") as f:
        f.write(docx("<w:p><w:r><w:t>First  para</w:t></w:r></w:p><w:p><w:r><w:t>second</w:t><w:tab/>"
                     "<w:t>para http://x.y/z</w:t></w:r></w:p>"))
    with open(os.path.join(d, "broken.docx"), "wb") as f:
        f.write(b"not a zip")
    with open(os.path.join(d, "scan.pdf"), "wb") as f:
        f.write(b"%PDF-1.4")
    os.mkdir(os.path.join(d, "sub"))
    with open(os.path.join(d, "sub", "nested.html"), "w") as f:
        f.write("<p>nested</p>")
    return d


def test_process_folder(spark):
    d = _folder()
    files = docs.scan_folder(spark, d)
    out = {r["filename"]: r for r in docs.process_files(files).collect()}
    assert set(out) == {"A.HTML", "b.txt", "bad.html", "doc.docx", "broken.docx", "scan.pdf"}
    assert out["A.HTML"]["status"] == "ok" and out["A.HTML"]["text"] == "Visit www.example.org now"
    assert list(out["A.HTML"]["links"]) == ["www.example.org"]
    assert out["b.txt"]["status"] == "skipped"
    assert out["bad.html"]["status"] == "error"
    assert out["doc.docx"]["status"] == "ok"
    assert out["doc.docx"]["text"] == "First para second para http://x.y/z"
    assert list(out["doc.docx"]["links"]) == ["http://x.y/z"]
    assert out["broken.docx"]["status"] == "error" and out["broken.docx"]["error"].startswith("docx")
    assert out["scan.pdf"]["status"] == "error"
    processed = docs.process_files(files)
    unsupported = docs.unsupported_files(docs.scan_folder(spark, d, content=False))
    assert [r["filename"] for r in unsupported.collect()] == ["b.txt"]
    plan = unsupported._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Pandas" not in plan and "content" not in plan.split("ReadSchema")[-1]
    presence = {r["has_links"]: r["files"] for r in docs.link_presence(processed).collect()}
    assert presence == {True: 2}
    cov = {r["ext"]: (r["files"], r["files_with_text"]) for r in docs.extraction_coverage(processed).collect()}
    assert cov[".html"] == (2, 1) and cov[".docx"] == (2, 1) and cov[".pdf"] == (1, 0)


def test_assemble_parts(spark):
    parts = spark.createDataFrame([(1, 2, "lo world"), (1, 1, "hel"), (2, 1, " a  b ")],
                                  "d long, p long, t string")
    glued = {r["d"]: r["text"] for r in docs.assemble_parts(parts, "d", "p", "t", "").collect()}
    spaced = {r["d"]: r["text"] for r in docs.assemble_parts(parts, "d", "p", "t", " ").collect()}
    assert glued == {1: "hello world", 2: "a b"}
    assert spaced == {1: "hel lo world", 2: "a b"}


def test_text_quality_flag(spark):
    df = spark.createDataFrame([(1, "Сайт начинающего"), (2, "plain ascii")], "doc_id long, text string")
    flags = {r["doc_id"]: r["flagged"] for r in docs.text_quality(df).collect()}
    assert flags == {1: True, 2: False}


def test_process_folder_job_equals_generic_path(spark):
    from quarry.plans import jobs
    d = _folder()
    a = sorted(tuple(r) for r in jobs.process_documents(spark, d).select("filename", "status", "text").collect())
    b = sorted(tuple(r) for r in docs.process_files(docs.scan_folder(spark, d)).select(
        "filename", "status", "text").collect())
    assert a == b and len(a) == 6


def test_docx_parts(spark):
    run = lambda *xs: "<w:p><w:r>" + "".join(xs) + "</w:r></w:p>"
    t = lambda s: f"<w:t>{s}</w:t>"
    body = run(t("one"), "<w:tab/>", t("two"), "<w:br/>", t("three")) + run(t("fo"), t("ur")) + run() + run(t("a &amp; b"))
    content = docx(body, header=run(t("HEAD")), footer=run(t("FOOT")))
    assert docs.docx_to_text_py(content) == "HEAD one two three four a & b FOOT"
    files = spark.createDataFrame([("x/a.docx", bytearray(content)), ("x/b.DOCX", bytearray(b"no zip"))], "path string, content binary")
    got = {r["path"]: (r["text"], r["status"]) for r in docs.extract_docx(files).collect()}
    assert got == {"x/a.docx": ("HEAD one two three four a & b FOOT", "ok"), "x/b.DOCX": (None, "error")}


def test_folder_path_spellings(spark, monkeypatch):
    d = _folder()
    parent, name = os.path.split(d)
    monkeypatch.chdir(parent)
    forms = [d, d + "/", f"file:{d}", f"file://{d}", f"{parent}/./{name}", f"{parent}//{name}", f"{d}/../{name}",
             f"{d}/sub/.."]
    want = {"A.HTML", "b.txt", "bad.html", "doc.docx", "broken.docx", "scan.pdf"}
    for form in forms:
        assert {r["filename"] for r in docs.process_folder(spark, form).collect()} == want, form
    assert {r["filename"] for r in docs.process_folder(spark, f"{d}/sub").collect()} == {"nested.html"}


def test_docx_files_written_from_tables(spark):
    parts = spark.createDataFrame([(1, 2, "b & <c>"), (1, 1, "a\x01z"), (2, 1, None)], "d long, p long, t string")
    files = {r["d"]: bytes(r["content"]) for r in adapters.write_docx_documents(parts, "d", "p", "t").collect()}
    assert docs.docx_to_text_py(files[1]) == "az b & <c>"
    assert docs.docx_to_text_py(files[2]) == ""


def test_docx_bytes_go_to_python_in_small_batches(spark):
    good = bytearray(docx("<w:p><w:r><w:t>some text</w:t></w:r></w:p>"))
    rows = [(f"x/{i}.docx", good if i % 3 else bytearray(b"no zip")) for i in range(240)] + [("x/n.docx", None)]
    files = spark.createDataFrame(rows, "path string, content binary")
    read = docs.process_files(files)
    parts = spark.createDataFrame([(1, 1, "t")], "d long, p long, t string")
    for df in (read, docs.extract_docx(files), adapters.write_docx_documents(parts, "d", "p", "t")):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "BatchEvalPython" in plan and "ArrowEvalPython" not in plan      # an Arrow batch is 10,000 files
    got = {r["filename"]: (r["status"], r["text"], r["error"]) for r in read.collect()}
    assert len(got) == 241 and got["1.docx"] == ("ok", "some text", None) and got["n.docx"] == ("ok", None, None)
    assert got["0.docx"] == ("error", None, "docx: BadZipFile: File is not a zip file")


def test_folder_is_listed_by_tasks_as_the_file_source_lists_it(spark, tmp_path):
    from quarry.plans import jobs
    from quarry.sources import folder as folders
    d = tmp_path / "a b%20c"
    d.mkdir()
    (d / "sub").mkdir()
    for name in ("x.HTML", "y.docx", "empty.html", "ü ,.txt", ".hid.html", "_hid.html", "_k=v.html", "z._COPYING_", "q[1].pdf"):
        (d / name).write_bytes(b"" if name.startswith("empty") else b"<p>" + name.encode())
    (d / "sub" / "in.html").write_bytes(b"x")
    for i in range(300):
        (d / f"n{i}.txt").write_bytes(b"t")
    os.symlink(d / "x.HTML", d / "link.html")
    for glob in (None, "*.[hH][tT][mM][lL]", docs.ci_glob(".html", ".docx"), "[^n]*", "q\\[1\\].{pdf,txt}", "?.*"):
        source = spark.read.format("binaryFile")
        source = (source.option("pathGlobFilter", glob) if glob else source).load(str(d))
        want = sorted((r.path, r.modificationTime, r.length, bytes(r.content)) for r in source.collect())
        got = sorted((r.path, r.modificationTime, r.length, bytes(r.content)) for r in docs.scan_folder(spark, str(d), glob).collect())
        assert got == want and want, glob
    scans = (docs.process_folder(spark, str(d)), jobs.extract_text(spark, str(d)), docs.scan_folder(spark, str(d), content=False))
    for df in scans:       # no file is known to the driver, no task for each few files
        assert "binaryFile" not in df._jdf.queryExecution().executedPlan().toString()
        assert df.count() == 306 and df.rdd.getNumPartitions() == 2 * spark.sparkContext.defaultParallelism
    assert folders.local_folder(spark, str(d / "*")) is None and folders.local_folder(spark, str(d / "x.HTML")) is None
    read = {r.path.rsplit("/")[-1]: r.content for r in docs.scan_folder(spark, str(d), content=(".html",)).collect()}
    assert bytes(read["x.HTML"]) == b"<p>x.HTML" and read["y.docx"] is None and "empty.html" not in read
    by_source = docs.scan_folder(spark, str(d) + "*", content=(".html",))      # a glob: the file source
    assert {r.path.rsplit("/")[-1]: r.content for r in by_source.collect()} == read
