"""Adapters from the given tables to the inputs the reference works on.

They only rename, derive and re-encode columns, so their output grows with the tables.
"""

from __future__ import annotations

import io
import zipfile

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarry.session import scratch_path, ship_package
from quarry.sources import corpus as src


# --- DOCX files to read back --------------------------------------------------------------------
_DOCX_HEAD = ('<?xml version="1.0" encoding="UTF-8" standalone="yes"?>'
              '<w:document xmlns:w="http://schemas.openxmlformats.org/wordprocessingml/2006/main">'
              "<w:body>")
_DOCX_TAIL = "</w:body></w:document>"
_PARA_HEAD = '<w:p><w:r><w:t xml:space="preserve">'
_PARA_TAIL = "</w:t></w:r></w:p>"
_CONTENT_TYPES = ('<?xml version="1.0" encoding="UTF-8"?><Types xmlns="http://schemas.openxml'
                  'formats.org/package/2006/content-types"><Default Extension="xml" '
                  'ContentType="application/xml"/></Types>')
# characters XML 1.0 cannot carry (dropped when writing)
_XML_FORBIDDEN = r"[\x{00}-\x{08}\x{0B}\x{0C}\x{0E}-\x{1F}]"


def docx_zip_py(document_xml: str) -> bytes:
    """A minimal DOCX package around a ``word/document.xml`` body."""
    buf = io.BytesIO()
    with zipfile.ZipFile(buf, "w", zipfile.ZIP_DEFLATED) as z:
        z.writestr("[Content_Types].xml", _CONTENT_TYPES)
        z.writestr("word/document.xml", document_xml)
    return buf.getvalue()


# as the reader's column function: a hundred documents at once in a worker, not an Arrow batch
_docx_zip_udf = F.udf(docx_zip_py, T.BinaryType(), useArrow=False)


def write_docx_documents(parts: DataFrame, doc_col: str, order_col: str, text_col: str) -> DataFrame:
    """``(doc, part order, text)`` rows -> one DOCX per document, ``(doc, content)``: the
    XML body is assembled natively (escaped, in part order); only zipping runs in Python."""
    t = F.coalesce(F.col(text_col), F.lit(""))
    esc = F.regexp_replace(F.replace(F.replace(F.replace(t, F.lit("&"), F.lit("&amp;")),
                                               F.lit("<"), F.lit("&lt;")), F.lit(">"), F.lit("&gt;")),
                           _XML_FORBIDDEN, "")
    para = F.concat(F.lit(_PARA_HEAD), esc, F.lit(_PARA_TAIL))
    ordered = F.sort_array(F.collect_list(F.struct(F.col(order_col).alias("o"), para.alias("p"))))
    body = F.array_join(F.transform(ordered, lambda x: x["p"]), "")
    ship_package(parts.sparkSession)
    xml = parts.groupBy(doc_col).agg(F.concat(F.lit(_DOCX_HEAD), body, F.lit(_DOCX_TAIL)).alias("xml"))
    return xml.select(doc_col, _docx_zip_udf("xml").alias("content"))


# --- a folder of files --------------------------------------------------------------------------
def folder_files(spark: SparkSession, sf: str, with_docx: bool = True) -> DataFrame:
    """A document folder as ``binaryFile`` rows: every page as ``page_<id>.html`` (UTF-8)
    and every document as ``doc_<id>.txt`` (an unsupported suffix) in a legacy single-byte
    encoding (ISO-8859-1, characters it lacks written as ``?``), so many are not UTF-8;
    with ``with_docx`` also every conversation as ``conv_<id>.docx``, and every benchmark item
    as three files that fail: ``bad_<id>.html`` (a byte that is not UTF-8), ``broken_<id>.docx``
    (no zip) and ``scan_<id>.pdf``."""
    pages = src.table(spark, sf, "pages").select(
        F.concat(F.lit("corpus/page_"), F.col("page_id").cast("string"), F.lit(".html")).alias("path"),
        F.encode("html", "UTF-8").alias("content"))
    texts = src.table(spark, sf, "documents").select(
        F.concat(F.lit("corpus/doc_"), F.col("doc_id").cast("string"), F.lit(".txt")).alias("path"),
        F.encode(F.regexp_replace("text", r"[^\x{00}-\x{FF}]", "?"), "ISO-8859-1").alias("content"))
    files = pages.unionByName(texts)
    if with_docx:
        raw = F.encode("text", "UTF-8")
        kind = F.explode(F.array(
            F.struct(F.lit("bad_").alias("a"), F.lit(".html").alias("b"), F.concat(raw, F.lit(b"\xff")).alias("c")),
            F.struct(F.lit("broken_").alias("a"), F.lit(".docx").alias("b"), raw.alias("c")),
            F.struct(F.lit("scan_").alias("a"), F.lit(".pdf").alias("b"), raw.alias("c")))).alias("k")
        failing = src.table(spark, sf, "benchmark").select("item_id", kind).select(
            F.concat(F.lit("corpus/"), "k.a", F.col("item_id").cast("string"), "k.b").alias("path"),
            F.col("k.c").alias("content"))
        files = files.unionByName(conversation_docx_files(spark, sf)).unionByName(failing)
    return src.spread(files, "path")


def conversation_docx_files(spark: SparkSession, sf: str) -> DataFrame:
    """Each conversation written as one DOCX file, one paragraph per turn."""
    conv = src.table(spark, sf, "conversations").select("conv_id", "turn", "text")
    files = write_docx_documents(conv, "conv_id", "turn", "text")
    return files.select(F.concat(F.lit("conversations/conv_"), F.col("conv_id").cast("string"),
                                 F.lit(".docx")).alias("path"), "content")


def _file_writer(root: str):
    def run(batches):
        from pyarrow import fs as pafs

        filesystem, base = pafs.FileSystem.from_uri(root)
        for batch in batches:
            sizes = []
            for path, content in zip(batch.column("path"), batch.column("content")):    # one file at a time in Python
                name, data = path.as_py().rsplit("/", 1)[-1], content.as_buffer()
                with filesystem.open_output_stream(f"{base}/{name}") as out:   # idempotent on retry
                    out.write(data)
                sizes.append(data.size)
            yield pa.RecordBatch.from_arrays([batch.column("path"), pa.array(sizes, pa.int64())], ["path", "length"])
    return run


def folder_on_disk(spark: SparkSession, sf: str) -> str:
    """The derived folder written as real files under the shared scratch folder (each task
    writes its own rows; a retried task rewrites the same names)."""
    import os
    root = scratch_path(spark, "folder")
    if root.startswith("file:") or "://" not in root:
        # local file system (local mode): "file:/x", "file:///x" or a plain path
        local = "/" + root.split(":", 1)[1].lstrip("/") if root.startswith("file:") else os.path.abspath(root)
        os.makedirs(local, exist_ok=True)
        uri = "file://" + local
    else:
        uri = root
    ship_package(spark)
    written = folder_files(spark, sf).mapInArrow(_file_writer(uri), "path string, length long")
    written.write.format("noop").mode("overwrite").save()
    return root


# --- posts ------------------------------------------------------------------------------------
def _url(owner, post):
    from quarry.operators.mentions import post_url
    return post_url(owner, post)


def posts_from_events(spark: SparkSession, sf: str) -> DataFrame:
    """Flat posts from ``events``: topic = event_type; every seventh event lacks an author."""
    e = src.table(spark, sf, "events")
    return e.select(
        F.col("event_type").alias("university"), F.col("event_id").alias("post_id"),
        F.col("user_id").alias("owner_id"),
        F.when(F.col("event_id") % 7 == 0, F.lit(None).cast("long")).otherwise(F.col("user_id")).alias("author_id"),
        F.col("ts").alias("date"), F.col("props").alias("text"),
        F.get_json_object("props", "$.k").cast("long").alias("likes"),
        F.floor("value").cast("long").alias("views"),
        (F.col("event_id") % 5).alias("reposts"), (F.col("event_id") % 3).alias("comments"),
        _url(F.col("user_id"), F.col("event_id")).alias("post_url"))


def raw_pages_from_events(spark: SparkSession, sf: str) -> DataFrame:
    """Landed response pages as JSON lines (column ``value``): events of one type in runs
    of 200 ids form a page; ``from_id`` is absent on every seventh event and ``views`` on
    every fifth."""
    from quarry.operators.mentions import ts_to_epoch
    e = src.table(spark, sf, "events")
    cnt = lambda c: F.struct(c.alias("count"))
    item = F.struct(
        F.col("event_id").alias("id"), F.col("user_id").alias("owner_id"),
        F.when(F.col("event_id") % 7 != 0, F.col("user_id")).alias("from_id"),
        ts_to_epoch(F.col("ts")).alias("date"), F.col("props").alias("text"),
        cnt(F.get_json_object("props", "$.k").cast("long")).alias("likes"),
        F.when(F.col("event_id") % 5 != 0, cnt(F.floor("value").cast("long"))).alias("views"),
        cnt(F.col("event_id") % 5).alias("reposts"), cnt(F.col("event_id") % 3).alias("comments"))
    page_no = F.floor(F.col("event_id") / 200).cast("long")
    pages = e.groupBy("event_type", page_no.alias("page")).agg(F.collect_list(item).alias("items"))
    return pages.select(F.to_json(F.struct(
        F.col("event_type").alias("query"), "items",
        (F.col("page") + 1).cast("string").alias("next_from"))).alias("value"))


def damaged_pages_from_events(spark: SparkSession, sf: str) -> DataFrame:
    """Landed lines of one event each: every 97th line is cut off, every 13th other one holds,
    beside a good post, a post whose ``likes`` is no object."""
    e = src.table(spark, sf, "events")
    number = F.col("event_id").cast("string")
    head = F.concat(F.lit('{"query":"'), F.col("event_type"), F.lit('",'))
    good = F.concat(F.lit('{"id":'), number, F.lit('}'))
    bad = F.when(F.col("event_id") % 13 == 0, F.concat(F.lit(',{"id":'), number, F.lit(',"likes":"many"}'))).otherwise("")
    return e.select(F.when(F.col("event_id") % 97 == 0, F.concat(head, number)).otherwise(
        F.concat(head, F.lit('"items":['), good, bad, F.lit("]}"))).alias("value"))


def searchable_posts(spark: SparkSession, sf: str) -> DataFrame:
    """Posts whose text is a document: event ``i`` carries document ``i mod #documents``."""
    e = src.table(spark, sf, "events")
    d = src.table(spark, sf, "documents").select("doc_id", "text")
    n_docs = d.count()
    ev = e.select(
        F.col("event_id").alias("post_id"), F.col("user_id").alias("owner_id"),
        F.col("user_id").alias("author_id"), F.col("ts").alias("date"),
        F.get_json_object("props", "$.k").cast("long").alias("likes"),
        F.floor("value").cast("long").alias("views"),
        (F.col("event_id") % 5).alias("reposts"), (F.col("event_id") % 3).alias("comments"),
        (F.col("event_id") % F.lit(n_docs)).alias("doc_id"))
    return ev.join(d, "doc_id").drop("doc_id").withColumn(
        "post_url", _url(F.col("owner_id"), F.col("post_id")))


def posts_from_orders(spark: SparkSession, sf: str) -> DataFrame:
    """Orders as posts: topic = priority, author = customer, date = order date."""
    o = src.table(spark, sf, "orders")
    return o.select(
        F.col("o_orderpriority").alias("university"), F.col("o_orderkey").alias("post_id"),
        F.col("o_custkey").alias("owner_id"), F.col("o_custkey").alias("author_id"),
        F.col("o_orderdate").cast("timestamp_ntz").alias("date"), F.col("o_orderstatus").alias("text"),
        F.lit(0).cast("long").alias("likes"), F.lit(0).cast("long").alias("views"),
        F.lit(0).cast("long").alias("reposts"), F.lit(0).cast("long").alias("comments"),
        _url(F.col("o_custkey"), F.col("o_orderkey")).alias("post_url"))
