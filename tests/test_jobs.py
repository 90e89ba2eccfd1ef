import datetime as dt
import os
import tempfile

from quarry.plans import jobs
from quarry.sources import report
from tests.docx_fixture import docx

POST_COLS = ("university string, post_id long, owner_id long, author_id long, date timestamp_ntz, "
             "text string, likes long, views long, reposts long, comments long, post_url string")


def test_build_and_search_stored_index(spark, corpus4):
    path = os.path.join(tempfile.mkdtemp(prefix="quarry-idx-"), "idx")
    jobs.build_index(spark, corpus4, path)
    found, rep = jobs.search_index(spark, path, "декан", compressed=True)
    rows = found.collect()
    assert [list(r["results"]) for r in rows] == [["0", "1"]] and rows[0]["count"] == 2
    r = rep.first()
    assert r["results_count"] == 2 and abs(r["compression_ratio"] - 1.625 / 91) < 1e-15
    stored = spark.read.parquet(os.path.join(path, "postings"))
    assert stored.columns == ["term", "doc_id", "tf"]
    found, rep = jobs.search_index(spark, path, ["декан", "нет", "экзамен"], compressed=False)
    assert {r["term"]: (list(r["results"]), r["count"]) for r in found.collect()} == {
        "декан": ([0, 1], 2), "нет": ([], 0), "экзамен": ([2], 1)}
    assert {r["term"]: r["results_count"] for r in rep.collect()} == {"декан": 2, "нет": 0, "экзамен": 1}
    plan = rep._jdf.queryExecution().executedPlan().toString()
    assert "MapInPandas" not in plan and "PushedFilters: [In(term" in plan
    jobs.build_index(spark, corpus4, path + "6", replicate=6)
    assert jobs.search_index(spark, path + "6", "декан")[1].first()["results_count"] == 12


def _posts(spark):
    base = dt.datetime(2024, 1, 10)
    rows = [("-", i, 1, i % 3, base + dt.timedelta(days=i % 8, hours=i), f"news about cat {i}" if i % 2 else "dog",
             1, 1, 1, 1, "") for i in range(30)]
    return spark.createDataFrame(rows, POST_COLS)


def test_mentions_recent_and_year(spark):
    posts = _posts(spark)
    recent = jobs.mentions_recent(spark, posts, ["cat", "dog", "none"], dt.datetime(2024, 1, 16))
    stats = {r["university"]: r["posts_count"] for r in recent["stats"].collect()}
    assert stats["none"] == 0 and stats["cat"] > 0 and stats["dog"] > 0
    daily = recent["daily"].collect()
    assert len({r["day"] for r in daily}) * 3 == len(daily)
    out_dir = tempfile.mkdtemp(prefix="quarry-report-")
    year = jobs.mentions_year(spark, posts, ["cat", "dog", "none"], 2024, out_dir=out_dir)
    assert {r["university"] for r in year["stats"].collect()} == {"cat", "dog"}
    assert year["overall"].first()["total_posts"] == 30
    assert set(year["report"]) == {report.SHEET_OVERALL, report.SHEET_TOPICS, report.SHEET_PUBLICATIONS,
                                   report.SHEET_MONTHLY}
    monthly = spark.read.parquet(year["report"][report.SHEET_MONTHLY]).collect()
    assert sorted(r["January"] for r in monthly) == [15, 15]


def test_text_quality_and_extract_text(spark):
    d = tempfile.mkdtemp(prefix="quarry-q-")
    with open(os.path.join(d, "ru.html"), "w", encoding="utf-8") as f:
        f.write("<p>Сайт начинающего верстальщика</p>")
    with open(os.path.join(d, "en.docx"), "wb") as f:
        f.write(docx("<w:p><w:r><w:t>see www.a.b</w:t></w:r></w:p>"))
    q = jobs.text_quality(jobs.process_documents(spark, d))
    flags = {r["filename"]: r["flagged"] for r in q["ratio"].collect()}
    assert flags == {"ru.html": True, "en.docx": False}
    assert {r["has_links"]: r["files"] for r in q["links"].collect()} == {True: 1, False: 1}
    one = jobs.extract_text(spark, os.path.join(d, "en.docx")).first()
    assert one["status"] == "ok" and one["text"] == "see www.a.b"
    assert [r["text"] for r in jobs.docx_text(spark, d).collect()] == ["see www.a.b"]
    with open(os.path.join(d, "notes.txt"), "w") as f:
        f.write("plain")
    bad = jobs.extract_text(spark, os.path.join(d, "notes.txt")).first()
    assert bad["status"] == "error" and bad["error"] == "unsupported format: .txt"


def test_quality_tables_come_from_one_extraction(spark, tmp_path):
    d = tmp_path / "docs"
    d.mkdir()
    (d / "a.html").write_text("<p>see www.example.org</p>")
    (d / "b.html").write_text("<p>\u0442\u0435\u043a\u0441\u0442</p>", encoding="utf-8")
    (d / "c.html").write_bytes(b"<p>\xff</p>")
    (d / "d.docx").write_bytes(docx("<w:p><w:r><w:t>one two</w:t></w:r></w:p>"))
    processed, tables = jobs.process_with_quality(spark, str(d), str(tmp_path / "out"))
    assert {r["filename"]: r["flagged"] for r in tables["ratio"].collect()} == {
        "a.html": False, "b.html": True, "d.docx": False}
    assert {r["has_links"]: r["files"] for r in tables["links"].collect()} == {True: 1, False: 2}
    assert {r["ext"]: (r["files"], r["files_with_text"], r["total_chars"]) for r in tables["coverage"].collect()} == {
        ".html": (3, 2, 24), ".docx": (1, 1, 7)}
    assert processed.count() == 4
    # neither these tables nor those of the plain job read the files again
    for t in (*tables.values(), *jobs.text_quality(jobs.process_documents(spark, str(d))).values()):
        plan = t._jdf.queryExecution().executedPlan().toString()
        assert "binaryFile" not in plan and "Python" not in plan and "FileScan parquet" in plan
