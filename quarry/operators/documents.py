"""Documents: files to normalised text plus links, page assembly and text-quality checks.

A "files" frame has the ``binaryFile`` schema ``(path, content)`` (plus optional
``modificationTime``/``length``).  HTML is decoded and extracted natively; DOCX goes
through one Python column function (zip + XML in the standard library); PDF and
DJVU decoders are not available here and yield ``status = 'error'`` rows.  A failing file
never stops the job: it becomes an ``error`` row (P9).
"""

from __future__ import annotations

import io
import zipfile
import xml.etree.ElementTree as ET

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarry.functions import html as hx
from quarry.functions import text as tx
from quarry.session import ship_package
from quarry.sources import folder as folders

# --- DOCX (W9) ------------------------------------------------------------------------------
_W = "{http://schemas.openxmlformats.org/wordprocessingml/2006/main}"


def _docx_part_text(xml_bytes: bytes) -> str:
    """Text runs of one part; paragraphs, tabs and breaks become whitespace."""
    out: list[str] = []
    for el in ET.fromstring(xml_bytes).iter():
        if el.tag == f"{_W}t" and el.text:
            out.append(el.text)
        elif el.tag in (f"{_W}tab",):
            out.append("\t")
        elif el.tag in (f"{_W}br", f"{_W}cr"):
            out.append("\n")
        elif el.tag == f"{_W}p":
            out.append("\n\n")
    return "".join(out)


_DOCX_RESULT = T.StructType([T.StructField("text", T.StringType()), T.StructField("error", T.StringType())])


def docx_to_text_py(content: bytes) -> str:
    """Headers, main document, footers; whitespace collapsed."""
    with zipfile.ZipFile(io.BytesIO(content)) as z:
        names = z.namelist()
        parts = ([n for n in names if n.startswith("word/header")]
                 + ["word/document.xml"]
                 + [n for n in names if n.startswith("word/footer")])
        text = " ".join(_docx_part_text(z.read(n)) for n in parts)
    return " ".join(text.split())


def _docx_result(content: bytearray | None) -> tuple[str | None, str | None]:
    if content is None:
        return None, None
    try:
        return docx_to_text_py(bytes(content)), None
    except Exception as e:  # a corrupt file is reported, the rest continue
        return None, f"docx: {type(e).__name__}: {e}"


# a plain column function: a worker holds a hundred files at once, where an Arrow batch would hold ten
# thousand, however large they are
_docx_column = F.udf(_docx_result, _DOCX_RESULT, useArrow=False)


def extract_docx(files: DataFrame) -> DataFrame:
    """``(path, content)`` of DOCX files -> ``(path, text, status, error)``."""
    ship_package(files.sparkSession)
    read = files.select("path", _docx_column("content").alias("d"))
    return read.select("path", "d.text", F.when(F.col("d.error").isNull(), "ok").otherwise("error").alias("status"),
                       "d.error")


# --- W4: files -> text + links ---------------------------------------------------------------
def _classify(files: DataFrame, *columns: str) -> DataFrame:
    name = tx.basename("path")
    return files.select(name.alias("filename"), tx.extension(name).alias("ext"),
                        tx.has_supported_suffix(name).alias("_supported"), *columns)


def process_files(files: DataFrame) -> DataFrame:
    """``(path, content)`` -> ``(filename, ext, status, text, links, error)``.

    ``status`` is ``ok``, ``skipped`` (name without a handled suffix) or ``error``.  One plan
    over all rows: HTML is decoded natively; only the bytes of DOCX rows go to the Python step.
    """
    ship_package(files.sparkSession)
    supported, ext = F.col("_supported"), F.col("ext")
    is_docx, is_html = supported & (ext == ".docx"), supported & (ext == ".html")
    read = _classify(files, "content").withColumn("_docx", _docx_column(F.when(is_docx, F.col("content"))))
    valid = tx.is_valid_utf8("content")
    error = (F.when(~supported, F.lit(None))
             .when(is_docx, F.col("_docx.error"))
             .when(is_html & ~valid, F.lit("html: content is not valid UTF-8"))
             .when(ext.isin(".pdf", ".djvu"), F.concat(F.expr("substr(ext, 2)"), F.lit(": no decoder available")))
             .when(~is_html, F.concat(F.lit("unsupported format: "), ext)))
    text = F.when(is_docx, F.col("_docx.text")).when(is_html, hx.html_to_text(tx.decode_utf8("content")))
    out = read.select("filename", "ext", F.when(~supported, F.lit("skipped")).when(error.isNull(), F.lit("ok"))
                      .otherwise(F.lit("error")).alias("status"), text.alias("text"), error.alias("error"))
    ok = F.col("status") == "ok"
    return out.select("filename", "ext", "status", F.when(ok, F.col("text")).alias("text"),
                      F.when(ok, tx.find_links("text")).alias("links"), "error")


def ci_glob(*extensions: str) -> str:
    """``.html`` -> ``*.[hH][tT][mM][lL]`` (a case-insensitive suffix glob; ``{a,b}`` for several)."""
    each = ["".join(f"[{c.lower()}{c.upper()}]" if c.isalpha() else c for c in e.lstrip(".")) for e in extensions]
    return "*." + (each[0] if len(each) == 1 else "{" + ",".join(each) + "}")


def process_folder(spark, folder: str) -> DataFrame:
    """W4 over a folder, reading file bytes only where they are needed: those of HTML and DOCX; every other
    file is known from the listing (its content is never read)."""
    return process_files(scan_folder(spark, folder, content=(".html", ".docx")))


def unsupported_files(files: DataFrame) -> DataFrame:
    """Distinct names that are skipped for their suffix, from the listing alone."""
    return _classify(files).where(~F.col("_supported")).select("filename").distinct()


def link_presence(processed: DataFrame) -> DataFrame:
    """Number of extracted files with and without at least one link."""
    return link_presence_of(processed.select("status", F.size("links").alias("n_links")))


def extraction_coverage(processed: DataFrame) -> DataFrame:
    """Per format, files seen, files with non-empty text, characters extracted."""
    return extraction_coverage_of(processed.select("status", "ext", F.length("text").alias("n_chars")))


def file_measures(processed: DataFrame) -> DataFrame:
    """``(filename, ext, status, n_chars, n_links, non_ascii_ratio)``: what the quality tables need of
    each file, without its text."""
    return processed.select("filename", "ext", "status", F.length("text").alias("n_chars"),
                            F.size("links").alias("n_links"), tx.non_ascii_ratio("text").alias("non_ascii_ratio"))


def link_presence_of(measures: DataFrame) -> DataFrame:
    """A14 from file measures."""
    ok = measures.filter(F.col("status") == "ok")
    return ok.groupBy((F.col("n_links") > 0).alias("has_links")).agg(F.count(F.lit(1)).alias("files"))


def extraction_coverage_of(measures: DataFrame) -> DataFrame:
    """A15 from file measures."""
    ok_text = F.col("status") == "ok"
    return measures.filter(F.col("status") != "skipped").groupBy("ext").agg(
        F.count(F.lit(1)).alias("files"),
        F.count_if(ok_text & (F.col("n_chars") > 0)).alias("files_with_text"),
        F.coalesce(F.sum(F.when(ok_text, F.col("n_chars"))), F.lit(0)).cast("long").alias("total_chars"))


# --- A12 / A13: assembling parts --------------------------------------------------------------
def assemble_parts(parts: DataFrame, doc_col: str, order_col: str, text_col: str,
                   separator: str = "") -> DataFrame:
    """Concatenate part texts in part order with ``separator`` (A12: ``''``, pages; A13:
    ``' '``, paragraphs), then collapse whitespace.  One output row per document."""
    ordered = F.sort_array(F.collect_list(F.struct(F.col(order_col).alias("o"),
                                                   F.coalesce(F.col(text_col), F.lit("")).alias("t"))))
    joined = F.array_join(F.transform(ordered, lambda x: x["t"]), separator)
    return parts.groupBy(doc_col).agg(tx.collapse_ws(joined).alias("text"))


# --- W8: text quality -------------------------------------------------------------------------
def text_quality(docs: DataFrame, text_col: str = "text", threshold: float = 0.5) -> DataFrame:
    """Non-ASCII ratio per document and the flag ``ratio > threshold``."""
    r = tx.non_ascii_ratio(text_col)
    return docs.select("*", r.alias("non_ascii_ratio"), (r > F.lit(threshold)).alias("flagged"))


# --- S6: folder scan --------------------------------------------------------------------------
def scan_folder(spark, folder: str, glob: str | None = None, content: bool | tuple[str, ...] = True) -> DataFrame:
    """Non-recursive listing of ``folder`` as ``(path, modificationTime, length, content)``;
    ``glob`` restricts file names; with ``content=False`` no file is read, with extensions only the
    files that have one of these.

    A folder of a mounted file system is listed and read by the tasks
    (:mod:`quarry.sources.folder`), so the driver holds no file of it; any other path, and a glob, goes to
    Spark's file source, whose listing is the driver's.  Neither lists names that start with ``.`` or ``_``."""
    ship_package(spark)
    local = folders.local_folder(spark, folder)
    if local is not None:
        return folders.listed(spark, local, glob, content)
    if isinstance(content, tuple):
        rest = scan_folder(spark, folder, glob, content=False)
        read = scan_folder(spark, folder, ci_glob(*content))
        return read.unionByName(rest.where(~tx.extension("path").isin(*content)))
    reader = spark.read.format("binaryFile")
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    df = reader.load(folder)      # without recursiveFileLookup only direct children are listed
    if not content:
        df = df.select("path", "modificationTime", "length", F.lit(None).cast("binary").alias("content"))
    return df
