"""Exact duplicates by progressive refinement: length, then prefix hash, then full hash.

Two texts are equal when they are identical after every run of white space (space, tab, line
breaks) became one space; null counts as empty.  Each step looks only at what the step
before left, and reads more of a text:

1. length: rows whose length (bytes of the normalised text) no other row has are unique;
2. prefix: of the others, rows whose (length, hash of the first characters) is alone are unique;
3. full hash: only the rows left are hashed whole (SHA-256), and only they are shuffled and grouped.

What a step left is handed to the scan of the texts as a bit table over hashed keys, broadcast.
Two keys that meet in one bit only cost a needless full hash; the groups come from
SHA-256 alone.  A table has at most ``MAX_BITS`` bits (64 MB), whatever the input.  No text is
shuffled to find the groups, and a group of any size is counted map-side before its hash moves.

Defined cases: a null text equals an empty one; of equal texts the row with the smallest id
stays, a null id last, and of rows that repeat text and id the one first in the written table;
the stated columns are the only ones read (others may have any name); an empty table gives an
empty result; texts of any length are hashed whole.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.llm.common import join_split, written

#: Characters of the normalised text in the prefix hash.
PREFIX = 64
#: Bits of a table for each row of the input, and the most bits a table may have.
BITS_PER_ROW, MAX_BITS = 16, 1 << 29
#: Bits in one row of a table (fixed by the bitmap functions).
_BITMAP = 32768


def normalised(text: str | Column) -> Column:
    """The text with every run of white space as one space; null becomes empty."""
    column = F.col(text) if isinstance(text, str) else text
    return F.regexp_replace(F.coalesce(column, F.lit("")), r"[\x20\x09-\x0D]+", " ")


def _class(keys: list[str], bits: int) -> Column:
    return F.pmod(F.xxhash64(*keys), F.lit(bits))


def shared(rows: DataFrame, keys: list[str], bits: int) -> DataFrame:
    """Bit table of the keys that more than one row has: at most ``bits`` / 32768 rows of 4 KB."""
    twice = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).where("_n > 1")
    at = twice.select(_class(keys, bits).alias("_c"))
    return at.groupBy(F.bitmap_bucket_number("_c").alias("_bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("_c")).alias("_bitmap"))


def marked(rows: DataFrame, table: DataFrame, keys: list[str], bits: int, name: str) -> DataFrame:
    """``rows`` with a boolean: is the bit of its keys set?"""
    held = rows.withColumn("_c", _class(keys, bits)).withColumn("_bucket", F.bitmap_bucket_number("_c"))
    bit = F.bitmap_bit_position("_c").cast("int")
    byte = F.conv(F.hex(F.expr("substring(_bitmap, cast(bitmap_bit_position(_c) div 8 as int) + 1, 1)")), 16, 10)
    hit = F.coalesce(F.getbit(byte.cast("int"), bit % 8) == 1, F.lit(False))
    return (held.join(F.broadcast(table), "_bucket", "left").withColumn(name, hit)
            .drop("_c", "_bucket", "_bitmap"))


def table_bits(rows: int) -> int:
    """Bits of a table for so many rows."""
    bits = _BITMAP
    while bits < BITS_PER_ROW * rows and bits < MAX_BITS:
        bits *= 2
    return bits


def duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", digests: bool = False,
               rows: bool = False) -> DataFrame:
    """One row per row of ``docs``: ``doc_id``, ``keep_id`` (id of the row that stays), ``group_size``,
    ``kept``, ``text_sha256`` (null where no full hash was needed, unless ``digests``), and with
    ``rows`` the whole input row as the struct ``row``."""
    spark = docs.sparkSession
    whole = [F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")] if rows else []
    texts = docs.select(F.col(id_col).alias("doc_id"), normalised(text_col).alias("_text"), *whole)
    keys = [F.octet_length("_text").alias("_len"), F.xxhash64(F.substring("_text", 1, PREFIX)).alias("_prefix")]

    cells = written(spark, texts.select(*keys), "dedup-prefixes")
    bits = table_bits(cells.count())
    lengths = shared(cells, ["_len"], bits)
    left = marked(cells, lengths, ["_len"], bits, "_left").where("_left")
    prefixes = written(spark, shared(left, ["_len", "_prefix"], bits), "dedup-bits")

    survivors = marked(texts.select("*", *keys), prefixes, ["_len", "_prefix"], bits, "_left")
    digest = F.sha2(F.col("_text").cast("binary"), 256)
    hashed = written(spark, survivors.select(
        "doc_id", *(["row"] if rows else []), "_left", F.monotonically_increasing_id().alias("_row"),
        (digest if digests else F.when(F.col("_left"), digest)).alias("text_sha256")), "dedup-hashes")

    first = F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "_row"))
    found = hashed.where("_left")
    groups = written(spark, found.groupBy("text_sha256").agg(
        first.alias("_first"), F.count(F.lit(1)).alias("group_size")), "dedup-groups")
    grouped = join_split(found, groups, ["text_sha256"])
    out = ["doc_id", "keep_id", "group_size", "kept", "text_sha256", *(["row"] if rows else [])]
    return (grouped.withColumns({"keep_id": F.col("_first.doc_id"), "kept": F.col("_row") == F.col("_first._row")})
            .select(*out)
            .unionByName(hashed.where(~F.col("_left")).withColumns({
                "keep_id": F.col("doc_id"), "group_size": F.lit(1).cast("long"), "kept": F.lit(True)}).select(*out)))


def keep_first(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with one row of each group of equal texts.  Only rows that share length and prefix
    with another are shuffled."""
    return duplicates(docs, id_col, text_col, rows=True).where("kept").select("row.*")
