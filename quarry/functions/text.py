"""Scalar text functions as native Spark column expressions (JVM side, no Python per row).

Every regular expression here is written so that the same pattern text also runs in RE2
(DuckDB), which the SQL oracles use.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# --- fixed values ---------------------------------------------------------------------
# Python's str.split()/str.strip()/re \s treat exactly these 29 code points as whitespace:
# U+0009-U+000D, U+001C-U+0020, U+0085, U+00A0, U+1680, U+2000-U+200A, U+2028, U+2029,
# U+202F, U+205F, U+3000.  Java's and RE2's \s are narrower, so the class is spelled out
# (this spelling is also what the DuckDB oracles use).
WS_CLASS_BODY_SQL = (
    r"\x{09}-\x{0D}\x{1C}-\x{20}\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}"
    r"\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}"
)
# The same set for Java regex: the Unicode White_Space property plus U+001C-U+001F
# (Python also splits on the four information separators).  It matches 2.5x faster.
WS_CLASS_BODY = r"\x{1C}-\x{1F}\p{IsWhite_Space}"
# Link pattern: an http(s) scheme or a www. prefix, then everything up to whitespace.
LINK_PATTERN_TEMPLATE = r"https?://[^{ws}]+|www\.[^{ws}]+"
# Extensions the document folder job handles.
SUPPORTED_EXTENSIONS = (".html", ".pdf", ".docx", ".djvu")
# --------------------------------------------------------------------------------------

WS = f"[{WS_CLASS_BODY}]"
WS_RUN = f"[{WS_CLASS_BODY}]+"
EDGE_WS = f"^[{WS_CLASS_BODY}]+|[{WS_CLASS_BODY}]+$"
LINK_PATTERN = LINK_PATTERN_TEMPLATE.format(ws=WS_CLASS_BODY)
LINK_PATTERN_SQL = LINK_PATTERN_TEMPLATE.format(ws=WS_CLASS_BODY_SQL)
NON_ASCII = r"[^\x{00}-\x{7F}]"
ASCII = r"[\x{00}-\x{7F}]"


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


# M3 ----------------------------------------------------------------------------------
def tokenize(text: Column | str) -> Column:
    """``str.split()``: runs of whitespace separate tokens, no empty tokens, case kept."""
    return F.filter(F.split(_c(text), WS_RUN), lambda t: t != F.lit(""))


# M6 ----------------------------------------------------------------------------------
def strip_ws(text: Column | str) -> Column:
    """``str.strip()``: remove leading and trailing whitespace, keep the inside."""
    return F.regexp_replace(_c(text), EDGE_WS, "")


# M7 ----------------------------------------------------------------------------------
def collapse_ws(text: Column | str) -> Column:
    """``" ".join(text.split())`` without building the token array: every whitespace run
    becomes one space, then the (single) edge spaces are trimmed."""
    return F.trim(F.regexp_replace(_c(text), WS_RUN, " "))


# M5 ----------------------------------------------------------------------------------
def find_links(text: Column | str) -> Column:
    """All leftmost non-overlapping link matches, in order, duplicates kept."""
    return F.regexp_extract_all(_c(text), F.lit(LINK_PATTERN), 0)


# M8 ----------------------------------------------------------------------------------
def basename(path: Column | str) -> Column:
    return F.regexp_extract(_c(path), r"([^/]*)$", 1)


def extension(name: Column | str) -> Column:
    """``os.path.splitext(name)[1].lower()``: leading dots do not start an extension."""
    return F.lower(F.regexp_extract(basename(name), r"^\.*[^.].*?(\.[^.]*)$", 1))


def has_supported_suffix(name: Column | str) -> Column:
    """``name.lower().endswith(SUPPORTED_EXTENSIONS)`` on the base name."""
    alts = "|".join(e.lstrip(".") for e in SUPPORTED_EXTENSIONS)
    return basename(name).rlike(rf"(?i)\.({alts})$")


# M14 ---------------------------------------------------------------------------------
def non_ascii_ratio(text: Column | str) -> Column:
    t = _c(text)
    return F.length(F.regexp_replace(t, ASCII, "")) / F.greatest(F.lit(1), F.length(t))


# M15 ---------------------------------------------------------------------------------
def is_valid_utf8(content: Column | str) -> Column:
    """True when the bytes decode as UTF-8 (``open(..., encoding='utf-8').read()``)."""
    return F.call_function("is_valid_utf8", _c(content))


def decode_utf8(content: Column | str) -> Column:
    """Bytes to string; NULL when the bytes are not valid UTF-8."""
    c = _c(content)
    return F.when(is_valid_utf8(c), c.cast("string"))


# M1 / M2 -----------------------------------------------------------------------------
def _bits(n: Column) -> Column:
    return F.bin(n)


def elias_gamma(n: Column | str) -> Column:
    """0 -> '0'; otherwise (bit length - 1) zeros followed by the binary digits."""
    n = _c(n).cast("long")
    b = _bits(n)
    return (F.when(n < 0, F.lit(None).cast("string"))
            .when(n == 0, F.lit("0"))
            .otherwise(F.concat(F.repeat(F.lit("0"), F.length(b) - 1), b)))


def elias_delta(n: Column | str) -> Column:
    """0 -> '0'; otherwise gamma(bit length) followed by the binary digits without the
    leading 1.  Raw values, not gaps."""
    n = _c(n).cast("long")
    b = _bits(n)
    length_bits = F.bin(F.length(b).cast("long"))
    gamma_len = F.concat(F.repeat(F.lit("0"), F.length(length_bits) - 1), length_bits)
    return (F.when(n < 0, F.lit(None).cast("string"))
            .when(n == 0, F.lit("0"))
            .otherwise(F.concat(gamma_len, F.substring(b, 2, 64))))


def elias_delta_length(n: Column | str) -> Column:
    """Length in bits of ``elias_delta(n)`` without building the code string."""
    n = _c(n).cast("long")
    L = F.length(F.bin(n))
    LL = F.length(F.bin(L.cast("long")))
    return (F.when(n < 0, F.lit(None).cast("int"))
            .when(n == 0, F.lit(1))
            .otherwise(L - 1 + 2 * LL - 1))


# Pickle (protocol 4) width of one non-negative int inside a list --------------------
def pickled_int_width(n: Column | str) -> Column:
    """BININT1 (2 bytes) below 256, BININT2 (3) below 65536, BININT (5) below 2**31, else
    LONG1: opcode + length byte + two's-complement bytes."""
    n = _c(n).cast("long")
    L = F.length(F.bin(n))
    return (F.when(n < 256, F.lit(2))
            .when(n < 65536, F.lit(3))
            .when(n < 2147483648, F.lit(5))
            .otherwise(F.lit(3) + F.floor(L / 8).cast("int")))
