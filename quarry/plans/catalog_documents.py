"""Registered document queries and their oracle SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.functions import html as hx
from quarry.functions import text as tx
from quarry.operators import documents as docs
from quarry.plans import adapters
from quarry.plans.catalog import Query, WSR_SQL
from quarry.sources import corpus as src

EDGE_SQL = f"^[{tx.WS_CLASS_BODY_SQL}]+|[{tx.WS_CLASS_BODY_SQL}]+$"


def _collapse_sql(x: str) -> str:
    return f"regexp_replace(regexp_replace({x}, '{EDGE_SQL}', '', 'g'), '{WSR_SQL}', ' ', 'g')"


def _strip_sql(x: str) -> str:
    return f"regexp_replace({x}, '{EDGE_SQL}', '', 'g')"


def _q(s: str) -> str:
    return s.replace("'", "''")


# Visible text in the oracle's own words: what stands between tags, outside the elements that
# show nothing; the references that occur in the given pages.
_HTML_REFERENCES = {"&copy;": "©", "&middot;": "·", "&quot;": '"', "&lt;": "<", "&gt;": ">", "&amp;": "&"}


def _html_sql(x: str) -> str:
    x = f"regexp_replace({x}, '<(script|style)>.*?</(script|style)>', chr(10), 'gs')"
    x = f"regexp_replace({x}, '<!--.*?-->', chr(10), 'gs')"
    x = f"array_to_string(regexp_split_to_array({x}, '</?[!a-zA-Z][^<>]*>'), chr(10))"
    # a reference without its semicolon counts where the standard allows it
    x = f"regexp_replace({x}, '&(amp|quot|copy|middot)([^;a-zA-Z]|$)', '&\\1;\\2', 'g')"
    for reference, character in _HTML_REFERENCES.items():
        x = f"replace({x}, '{_q(reference)}', '{_q(character)}')"
    return _collapse_sql(x)


def _links_sql(x: str) -> str:
    return f"regexp_extract_all({x}, '{tx.LINK_PATTERN_SQL}')"


def _pages(spark, sf):
    return src.spread(src.table(spark, sf, "pages").select("page_id", "html"), "page_id")


def _docs(spark, sf):
    return src.spread(src.table(spark, sf, "documents").select("doc_id", "text"), "doc_id")


def _processed(spark, sf) -> DataFrame:
    return docs.process_files(adapters.folder_files(spark, sf))


def q_html_text(spark, sf):
    return _pages(spark, sf).select("page_id", hx.html_to_text("html").alias("text"))


def q_find_links(spark, sf):
    links = tx.find_links(hx.html_to_text("html"))
    return _pages(spark, sf).select("page_id", F.array_join(links, " ").alias("links"),
                                    F.size(links).cast("long").alias("n_links"))


def q_link_presence(spark, sf):
    return docs.link_presence(_processed(spark, sf))


def q_extraction_coverage(spark, sf):
    return docs.extraction_coverage(_processed(spark, sf))


def q_process_folder(spark, sf):
    p = _processed(spark, sf)
    return p.withColumn("links", F.array_join("links", " "))


def q_process_documents(spark, sf):
    """W4 as a user runs it: a folder on disk, scanned by S6 (glob-restricted scans)."""
    from quarry.plans import jobs
    out = jobs.process_documents(spark, adapters.folder_on_disk(spark, sf))
    return out.withColumn("links", F.array_join("links", " "))


def q_unsupported_files(spark, sf):
    return docs.unsupported_files(adapters.folder_files(spark, sf))


def q_extract_text(spark, sf):
    """W5 for every file of the derived folder."""
    from quarry.plans import jobs
    return jobs.extract_text(spark, adapters.folder_on_disk(spark, sf))


def _quality_table(name):
    def query(spark, sf):
        from quarry.plans import jobs
        return jobs.text_quality(_processed(spark, sf))[name]
    return query


def q_utf8_check(spark, sf):
    f = adapters.folder_files(spark, sf, with_docx=False)
    return f.select(tx.basename("path").alias("filename"), tx.is_valid_utf8("content").alias("valid_utf8"))


def q_assemble_pages(spark, sf):
    conv = src.table(spark, sf, "conversations")
    return docs.assemble_parts(conv, "conv_id", "turn", "text", "")


def q_join_parts(spark, sf):
    conv = src.table(spark, sf, "conversations")
    return docs.assemble_parts(conv, "conv_id", "turn", "text", " ")


def q_strip_text(spark, sf):
    return _docs(spark, sf).select("doc_id", tx.strip_ws("text").alias("text"))


def q_collapse_text(spark, sf):
    return _docs(spark, sf).select("doc_id", tx.collapse_ws("text").alias("text"))


def q_non_ascii_ratio(spark, sf):
    return docs.text_quality(_docs(spark, sf)).select("doc_id", "non_ascii_ratio", "flagged")


def q_docx_text(spark, sf):
    files = adapters.conversation_docx_files(spark, sf)
    out = docs.process_files(files)
    return out.select("filename", "status", "text")


DOCUMENT_QUERIES: dict[str, Query] = {
    "html_text": q_html_text,
    "find_links": q_find_links,
    "link_presence": q_link_presence,
    "extraction_coverage": q_extraction_coverage,
    "process_folder": q_process_folder,
    "process_documents": q_process_documents,
    "unsupported_files": q_unsupported_files,
    "extract_text": q_extract_text,
    "text_quality_ratio": _quality_table("ratio"),
    "text_quality_links": _quality_table("links"),
    "text_quality_coverage": _quality_table("coverage"),
    "utf8_check": q_utf8_check,
    "assemble_pages": q_assemble_pages,
    "join_parts": q_join_parts,
    "strip_text": q_strip_text,
    "collapse_text": q_collapse_text,
    "non_ascii_ratio": q_non_ascii_ratio,
    "docx_text": q_docx_text,
}

# A text written as ISO-8859-1 (one byte per code point, '?' above U+00FF) is valid UTF-8
# exactly when its code points, read as bytes, follow the UTF-8 byte grammar (RFC 3629).
_LATIN1_AS_UTF8 = ("(?:[\\x{00}-\\x{7F}]|[\\x{100}-\\x{10FFFF}]"
                   "|[\\x{C2}-\\x{DF}][\\x{80}-\\x{BF}]"
                   "|\\x{E0}[\\x{A0}-\\x{BF}][\\x{80}-\\x{BF}]"
                   "|[\\x{E1}-\\x{EC}\\x{EE}\\x{EF}][\\x{80}-\\x{BF}]{2}"
                   "|\\x{ED}[\\x{80}-\\x{9F}][\\x{80}-\\x{BF}]"
                   "|\\x{F0}[\\x{90}-\\x{BF}][\\x{80}-\\x{BF}]{2}"
                   "|[\\x{F1}-\\x{F3}][\\x{80}-\\x{BF}]{3}"
                   "|\\x{F4}[\\x{80}-\\x{8F}][\\x{80}-\\x{BF}]{2})*")
# characters XML 1.0 cannot carry: the DOCX writer drops them
_XML_DROP = r"[\x{00}-\x{08}\x{0B}\x{0C}\x{0E}-\x{1F}]"
_DOCX_TEXT_SQL = _collapse_sql(
    f"string_agg(regexp_replace(coalesce(text, ''), '{_XML_DROP}', '', 'g'), ' ' ORDER BY turn)")

_FOLDER_SQL = f"""
WITH files AS (
  SELECT 'page_' || page_id || '.html' AS filename, '.html' AS ext, 'ok' AS status,
         {_html_sql('html')} AS text, CAST(NULL AS VARCHAR) AS error
  FROM pages
  UNION ALL
  SELECT 'doc_' || doc_id || '.txt', '.txt', 'skipped', NULL, NULL FROM documents
  UNION ALL
  SELECT 'conv_' || conv_id || '.docx', '.docx', 'ok',
         {_DOCX_TEXT_SQL},
         NULL
  FROM conversations GROUP BY conv_id
  UNION ALL
  SELECT 'bad_' || item_id || '.html', '.html', 'error', NULL, 'html: content is not valid UTF-8' FROM benchmark
  UNION ALL
  SELECT 'broken_' || item_id || '.docx', '.docx', 'error', NULL, 'docx: BadZipFile: File is not a zip file'
  FROM benchmark
  UNION ALL
  SELECT 'scan_' || item_id || '.pdf', '.pdf', 'error', NULL, 'pdf: no decoder available' FROM benchmark)
"""
_LINKS_BY_PRESENCE_SQL = f"""
SELECT len({_links_sql('text')}) > 0 AS has_links, count(*)::BIGINT AS files
FROM files WHERE status = 'ok' GROUP BY has_links
"""
_COVERAGE_SQL = """
SELECT ext, count(*)::BIGINT AS files, count(*) FILTER (WHERE length(text) > 0)::BIGINT AS files_with_text,
       coalesce(sum(length(text)), 0)::BIGINT AS total_chars
FROM files WHERE status <> 'skipped' GROUP BY ext
"""

DOCUMENT_ORACLE: dict[str, str] = {
    "html_text": f"SELECT page_id, {_html_sql('html')} AS text FROM pages",
    "find_links": f"""
SELECT page_id, array_to_string(l, ' ') AS links, len(l)::BIGINT AS n_links
FROM (SELECT page_id, {_links_sql(_html_sql('html'))} AS l FROM pages)
""",
    "link_presence": _FOLDER_SQL + _LINKS_BY_PRESENCE_SQL,
    "extraction_coverage": _FOLDER_SQL + _COVERAGE_SQL,
    "text_quality_links": _FOLDER_SQL + _LINKS_BY_PRESENCE_SQL,
    "text_quality_coverage": _FOLDER_SQL + _COVERAGE_SQL,
    "text_quality_ratio": _FOLDER_SQL + f"""
SELECT filename, r AS non_ascii_ratio, r > 0.5 AS flagged
FROM (SELECT filename, length(regexp_replace(text, '{tx.ASCII}', '', 'g')) / greatest(1, length(text)) AS r
      FROM files WHERE status = 'ok')
""",
    "extract_text": _FOLDER_SQL + """
SELECT filename, CASE WHEN status = 'skipped' THEN 'error' ELSE status END AS status, text,
       CASE WHEN status = 'skipped' THEN 'unsupported format: ' || ext ELSE error END AS error
FROM files
""",
    "process_folder": _FOLDER_SQL + f"""
SELECT filename, ext, status, text,
       CASE WHEN status = 'ok' THEN array_to_string({_links_sql('text')}, ' ') END AS links, error
FROM files
""",
    "process_documents": _FOLDER_SQL + f"""
SELECT filename, ext, status, text,
       CASE WHEN status = 'ok' THEN array_to_string({_links_sql('text')}, ' ') END AS links, error
FROM files
""",
    "unsupported_files": _FOLDER_SQL + "SELECT DISTINCT filename FROM files WHERE status = 'skipped'",
    "utf8_check": f"""
SELECT 'page_' || page_id || '.html' AS filename, true AS valid_utf8 FROM pages
UNION ALL SELECT 'doc_' || doc_id || '.txt', regexp_full_match(text, '{_LATIN1_AS_UTF8}') FROM documents
""",
    "assemble_pages": f"""
SELECT conv_id, {_collapse_sql("string_agg(coalesce(text, ''), '' ORDER BY turn)")} AS text
FROM conversations GROUP BY conv_id
""",
    "join_parts": f"""
SELECT conv_id, {_collapse_sql("string_agg(coalesce(text, ''), ' ' ORDER BY turn)")} AS text
FROM conversations GROUP BY conv_id
""",
    "strip_text": f"SELECT doc_id, {_strip_sql('text')} AS text FROM documents",
    "collapse_text": f"SELECT doc_id, {_collapse_sql('text')} AS text FROM documents",
    "non_ascii_ratio": f"""
SELECT doc_id, r AS non_ascii_ratio, r > 0.5 AS flagged
FROM (SELECT doc_id, length(regexp_replace(text, '{tx.ASCII}', '', 'g')) / greatest(1, length(text)) AS r
      FROM documents)
""",
    "docx_text": f"""
SELECT 'conv_' || conv_id || '.docx' AS filename, 'ok' AS status,
       {_DOCX_TEXT_SQL} AS text
FROM conversations GROUP BY conv_id
""",
}
