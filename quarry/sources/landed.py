"""Landed search-response pages (one JSON document per line) with a declared schema.

A landed line is ``{"query": topic, "items": [post, ...], "next_from": ..., "total_count": ...}``.
Lines that do not parse are kept apart as rejects (P9) instead of failing the job.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

_COUNT = T.StructType([T.StructField("count", T.LongType())])

POST_SCHEMA = T.StructType([
    T.StructField("id", T.LongType()),
    T.StructField("owner_id", T.LongType()),
    T.StructField("from_id", T.LongType()),
    T.StructField("date", T.LongType()),
    T.StructField("text", T.StringType()),
    T.StructField("likes", _COUNT),
    T.StructField("views", _COUNT),
    T.StructField("reposts", _COUNT),
    T.StructField("comments", _COUNT),
])

PAGE_SCHEMA = T.StructType([
    T.StructField("query", T.StringType()),
    T.StructField("items", T.ArrayType(POST_SCHEMA)),
    T.StructField("next_from", T.StringType()),
    T.StructField("total_count", T.LongType()),
])


# A page is parsed once with the full post schema.  Only a line where that parse reports a
# corrupt record is parsed again with the items kept as raw JSON text, and each of its
# items on its own: a malformed post is rejected alone and the rest of its page is kept.
_CORRUPT = T.StructField("_corrupt", T.StringType())
_TYPED_PAGE_SCHEMA = T.StructType(PAGE_SCHEMA.fields + [_CORRUPT])
_RAW_PAGE_SCHEMA = T.StructType([
    T.StructField("query", T.StringType()),
    T.StructField("items", T.ArrayType(T.StringType())),
    T.StructField("next_from", T.StringType()),
    T.StructField("total_count", T.LongType()),
    _CORRUPT,
])
_ITEM_SCHEMA = T.StructType(POST_SCHEMA.fields + [_CORRUPT])
_PERMISSIVE = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt"}


def parse_pages(lines: DataFrame, value_col: str = "value") -> tuple[DataFrame, DataFrame]:
    """``(pages, rejects)``: pages ``(query, items ARRAY<STRUCT<item, raw>>, next_from,
    total_count)`` and the raw lines that are not a valid page."""
    parsed = lines.select(F.col(value_col).alias("raw"),
                          F.from_json(F.col(value_col), _TYPED_PAGE_SCHEMA, _PERMISSIVE).alias("t"))
    t_ok = F.col("t").isNotNull() & F.col("t._corrupt").isNull()
    parsed = parsed.withColumn("r", F.when(~t_ok, F.from_json("raw", _RAW_PAGE_SCHEMA, _PERMISSIVE)))
    r_ok = F.col("r").isNotNull() & F.col("r._corrupt").isNull()
    no_raw = F.lit(None).cast("string")
    typed_items = F.transform("t.items", lambda x: F.struct(
        F.struct(*[x[f.name].alias(f.name) for f in POST_SCHEMA.fields], no_raw.alias("_corrupt")).alias("item"),
        no_raw.alias("raw")))
    raw_items = F.transform("r.items", lambda x: F.struct(
        F.from_json(x, _ITEM_SCHEMA, _PERMISSIVE).alias("item"), x.alias("raw")))
    pick = lambda f: F.when(t_ok, F.col(f"t.{f}")).otherwise(F.col(f"r.{f}"))
    pages = parsed.filter(t_ok | r_ok).select(
        pick("query").alias("query"),
        F.when(t_ok, typed_items).otherwise(raw_items).alias("items"),
        pick("next_from").alias("next_from"), pick("total_count").alias("total_count"))
    return pages, parsed.filter(~(t_ok | r_ok)).select("raw")


def read_landed_pages(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """Scan a folder of landed JSON-lines files (all pages of all topics: a bag union)."""
    return parse_pages(spark.read.text(path))


def _entries(pages: DataFrame) -> DataFrame:
    return pages.select(F.col("query").alias("topic"), F.explode("items").alias("e"))


def _good(e: str = "e") -> F.Column:
    return F.col(f"{e}.item").isNotNull() & F.col(f"{e}.item._corrupt").isNull()


def page_items(pages: DataFrame) -> DataFrame:
    """``(topic, item)``, one row per well-formed post on any page (pages hold at most a
    page size of items)."""
    ok = _entries(pages).filter(_good())
    return ok.select("topic", F.struct(*[F.col(f"e.item.{f.name}") for f in POST_SCHEMA.fields]).alias("item"))


def item_rejects(pages: DataFrame) -> DataFrame:
    """``(topic, raw)`` of posts that do not fit the post schema (P9, per record)."""
    return _entries(pages).filter(~_good()).select("topic", F.col("e.raw").alias("raw"))
