"""M4: HTML to visible text, as a chain of native expressions that stays in the JVM.

A space is put at every tag or comment boundary; comments, doctype and script/style/template
contents are dropped, ``<title>`` is kept, character references are decoded once (so
``&amp;lt;`` becomes ``&lt;``), and whitespace is collapsed.
"""

from __future__ import annotations

import json
import zlib
from html.entities import html5

from pyspark.sql import Column
from pyspark.sql import functions as F

from quarry.functions.text import collapse_ws

# --- fixed values ---------------------------------------------------------------------------
# Elements whose text is not visible text.
HIDDEN_ELEMENTS = ("script", "style", "template")
# Numeric references to these code points give no character (controls, noncharacters) ...
_NO_CHARACTER = ((0x1, 0x8), (0xB, 0xB), (0xE, 0x1F), (0x7F, 0x7F), (0xFDD0, 0xFDEF))
# ... and to these the replacement character.
_REPLACED = ((0x0, 0x0), (0xD800, 0xDFFF))
# ---------------------------------------------------------------------------------------------

HIDDEN_PATTERNS = tuple(rf"(?is)<{t}\b.*?</{t}[^>]*>" for t in HIDDEN_ELEMENTS)
COMMENT_PATTERN = r"(?s)<!--.*?-->"
# a quoted attribute value may hold '>'; a tag with an unbalanced quote ends at its first '>'
TAG_PATTERN = r"""(?s)<[!/?a-zA-Z](?:[^>"']++|"[^"]*+"|'[^']*+')*+>|<[!/?a-zA-Z][^>]*>"""


#: Slots of the table of named references: about two slots a name.
_SLOTS = 4096


def _name_table() -> Column:
    """The standard's named references (from the Python library's table) as a constant array of
    small maps, placed by a hash of the name, so a name is compared with one or two others."""
    slots: list[dict[str, str]] = [{} for _ in range(_SLOTS)]
    for name, text in html5.items():
        slots[zlib.crc32(name.encode()) % _SLOTS][name] = text
    return F.from_json(F.lit(json.dumps(slots)), "array<map<string,string>>")


def _named(name: Column) -> Column:
    """The characters of a named reference, NULL if there is none of that name."""
    return F.element_at(F.get(_name_table(), (F.crc32(name.cast("binary")) % _SLOTS).cast("int")), name)


def _legacy_pattern() -> str:
    """Names that need no semicolon, longest first."""
    return "^(" + "|".join(sorted((n for n in html5 if not n.endswith(";")), key=lambda n: (-len(n), n))) + ")"


def _windows_1252() -> Column:
    """Numeric references 128-159 mean that code page; the few it lacks stay as they are."""
    byte = {str(b): bytes([b]).decode("cp1252", "ignore") for b in range(128, 160)}
    return F.from_json(F.lit(json.dumps({k: v for k, v in byte.items() if v})), "map<string,string>")


def _within(n: Column, ranges: tuple[tuple[int, int], ...]) -> Column:
    cond = F.lit(False)
    for a, b in ranges:
        cond = cond | n.between(a, b)
    return cond


def _character(n: Column) -> Column:
    """The character of a numeric reference (NULL: more digits than any code point has)."""
    wide = F.decode(F.unhex(F.lpad(F.hex(n), 8, "0")), "UTF-32")
    plane_end = (n.bitwiseAND(F.lit(0xFFFE)) == 0xFFFE)
    return (F.when(n.isNull() | (n > 0x10FFFF) | _within(n, _REPLACED), F.lit("�"))
            .when(n.between(128, 159), F.coalesce(F.element_at(_windows_1252(), n.cast("string")), wide))
            .when(_within(n, _NO_CHARACTER) | plane_end, F.lit(""))
            .otherwise(wide))


def _opened(part: Column) -> Column:
    """What stands behind one ``&``, with the reference it begins with (each found once)."""
    digits = F.regexp_extract(part, r"^(#[0-9]+;?|#[xX][0-9a-fA-F]+;?)", 1)
    name = F.regexp_extract(part, r"^([a-zA-Z][a-zA-Z0-9]*;)", 1)
    return F.struct(part.alias("part"), digits.alias("digits"), name.alias("name"))


def _decoded(x: Column) -> Column:
    """The part of :func:`_opened` with its reference decoded."""
    part, digits, name = x["part"], x["digits"], x["name"]
    number = F.regexp_extract(digits, r"^#0*([0-9]{0,8})[0-9]*;?", 1)
    hexed = F.regexp_extract(digits, r"^#[xX]0*([0-9a-fA-F]{0,7})[0-9a-fA-F]*;?", 1)
    value = F.when(digits.rlike("^#[xX]"), F.conv(F.concat(F.lit("0"), hexed), 16, 10).cast("long")).otherwise(
        F.concat(F.lit("0"), number).cast("long"))
    rest = lambda found: part.substr(F.length(found) + 1, F.length(part))
    legacy = F.regexp_extract(part, _legacy_pattern(), 1)
    return F.when(digits != "", F.concat(_character(value), rest(digits))).otherwise(F.coalesce(
        F.when(name != "", F.concat(_named(name), rest(name))),
        F.when(legacy != "", F.concat(_named(legacy), rest(legacy))),
        F.concat(F.lit("&"), part)))


def decode_references(text: Column) -> Column:
    """Every character reference decoded, in one pass.  ``text`` stands in the expression once, so
    what it is made from is evaluated once."""
    opened = F.transform(F.split(text, "&", -1), _opened)
    return F.array_join(F.transform(opened, lambda x, i: F.when(i == 0, x["part"]).otherwise(_decoded(x))), "")


def html_to_text(html: Column | str) -> Column:
    """Hidden elements, comments, tags -> space; references; collapse."""
    c = F.col(html) if isinstance(html, str) else html
    for pat in (*HIDDEN_PATTERNS, COMMENT_PATTERN, TAG_PATTERN):
        c = F.regexp_replace(c, pat, " ")
    return collapse_ws(decode_references(c))
