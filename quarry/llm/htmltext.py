"""Main text of web pages by the distribution of text over line blocks.

A page is cut into lines at block-level tags, without scripts, styles and other raw elements, comments
and the inside of boilerplate elements (navigation, header, footer, aside, form, advert and
notice containers, reader comments).  Lines that are mostly links have no weight.
Containers are known by whole words of class, id and role.  One that holds ``<main>`` or half of the
page's text is a wrapper and is read like any element, and so is a header inside an article.
With weights = text lengths, sums over a sliding window of lines give the distribution; boilerplate
lines are left out of it, so that adverts inside a text do not cut it.  It dives where two windows in
a row hold nothing, and a stretch between dives is text if the distribution surges in it: a window holds
``SURGE`` characters, or one part in ``SHARE`` of the page's highest.  A stretch without a surge (a site's
name before its link list, a line of copyright after it) is none, unless the smallest element that holds
it and another line holds a surge too and is not the whole page: the text's own last words stay, however
many links part them from it.  Every line between the first surge and the last dive of these stretches is
kept, short and link-heavy ones too.  Lines inside ``<article>``/``<main>`` weigh ``INSIDE`` times
their text: where they outweigh the rest of the page, the rest has no weight and is not kept, and the articles
that the first surge and the last dive lie in are kept to their edges, links too.  So a teaser in an
``<article>`` of its own neither replaces the text beside it nor, without a surge, follows it.

Character references are decoded, white space inside a line becomes one space, lines are joined by
one space in page order.

Defined cases: null html counts as empty; a page without text gives an empty string; unclosed
elements end with their parent or the page; an unclosed boilerplate element hides nothing, but unclosed
reader comments all to the end of what holds them; repeated rows are extracted row by row; null ids and urls stay; extra columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import bisect
import html
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from quarry.llm.common import schema_of, slices

WINDOW = 3
#: Characters in a window that are a surge on any page; on pages of little text, the highest window over ``SHARE`` is.
SURGE = 80
SHARE = 4
#: Weight of a character inside ``<article>``/``<main>`` against one outside.
INSIDE = 4

# Element names of HTML by their part in a page.
_RAW = {"script", "style", "noscript", "template", "textarea", "iframe", "svg", "math", "object", "title",
        "select", "canvas", "audio", "video", "head"}
_BOILERPLATE = {"nav", "header", "footer", "aside", "form", "menu", "dialog", "button", "fieldset"}
_BLOCK = {"address", "article", "blockquote", "body", "br", "caption", "center", "dd", "details", "div", "dl", "dt",
          "figcaption", "figure", "h1", "h2", "h3", "h4", "h5", "h6", "head", "hr", "html", "li", "main", "ol", "p",
          "pre", "section", "summary", "table", "tbody", "td", "tfoot", "th", "thead", "title", "tr", "ul",
          *_BOILERPLATE}
_VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr"}
#: Boilerplate whatever its share of the text (the others may be wrappers of the page).
_ALWAYS = {"nav", "footer", "aside", "menu", "dialog", "button"}
#: Words of class, id and role that mark a boilerplate container, and words that may stand beside them
#: in one token (``site-footer`` marks one; ``has-sidebar`` and ``menu-open`` say something of a wrapper).
_HINT = re.compile(
    r"ads?|advert\w*|adsense|adsbygoogle|banner|breadcrumbs?|comments?|commentlist|cookies?|consent|copyright|"
    r"disqus|dropdown|footer|gdpr|header|login|masthead|menu|modal|nav|navbar|navigation|newsletter|notice|pagination|"
    r"popup|promo\w*|related|replies|respond|search|share|sharing|sidebar|signup|social|sponsor\w*|subscribe|tags?|"
    r"toolbar|widget|complementary|contentinfo")
_BESIDE = re.compile(
    r"site|page|main|top|bottom|left|right|primary|secondary|global|article|post|posts|entry|story|area|wrapper|wrap|"
    r"container|box|bar|block|section|list|items?|links?|icons?|buttons?|form|inner|outer|reader|user|content|body|"
    r"slot|unit|google|iframe|thread|c|\d*")
_HEADLINE = {"article", "post", "entry", "story", "page", "section"}
_COMMENTS = {"comment", "comments", "commentlist", "disqus", "replies", "respond"}
#: Words of containers that never wrap a page's own text, however little of it there is.
_OWN = re.compile(r"ads?|advert\w*|adsense|adsbygoogle|sponsor\w*|promo\w*|cookies?|consent|gdpr|copyright")
_ATTRIBUTE = re.compile(r"""\b(?:class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>"']+))""", re.I)
_HIDDEN = re.compile(r"""\shidden(?=[\s=/>]|$)|aria-hidden\s*=\s*["']?true|display\s*:\s*none""", re.I)
_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*>|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+|[^>]*+)>", re.S)


def hints(marks: str) -> set[str]:
    """Boilerplate words of the tokens of class, id and role."""
    found: set[str] = set()
    for token in marks.lower().split():
        parts = re.split(r"[-_]+", token)
        words = {x for x in parts if _HINT.fullmatch(x)}
        if words and all(x in words or _BESIDE.fullmatch(x) for x in parts) and not (
                "header" in words and _HEADLINE.intersection(parts)):      # of an article, not of the site
            found |= words
    return found


def _marks(name: str, rest: str) -> set[str]:
    if not rest or name in ("html", "body", "main"):
        return set()
    found = hints(" ".join("".join(a) for a in _ATTRIBUTE.findall(rest)))
    return found & _COMMENTS if name == "article" else found       # a reader comment may be an article


def _foreign(words: set[str]) -> bool:
    """Reader comments, adverts and notices: text that is not the page's own."""
    return bool(_COMMENTS & words) or any(map(_OWN.fullmatch, words))


def wrappers(page: str, tokens: list[tuple], partner: dict[int, int], marked: dict[int, set[str]]) -> set[int]:
    """Tokens of ``marked`` elements that wrap the page and are no boilerplate themselves: they hold
    ``<main>``, or half of the text inside ``<article>``/``<main>`` (of text outside of links, if the
    page has none).  Raw elements, comments, adverts and what is always boilerplate do not count."""
    mains = [i for i, t in enumerate(tokens) if t[3] == "main" and not t[2]]
    found = {i for i in marked if bisect.bisect(mains, partner[i]) > bisect.bisect(mains, i)}
    inside, plain = [0], [0]                     # text in articles, text outside links, before each token
    at = depth = until = 0
    in_link = False
    for i, (start, end, closing, name, _) in enumerate(tokens):
        size = len(page[at:start].strip()) if i > until or not until else 0
        inside.append(inside[-1] + (size if depth else 0))
        plain.append(plain[-1] + (0 if in_link else size))
        at = end
        if i <= until and until:
            continue
        if name in ("article", "main"):
            depth = max(0, depth + (-1 if closing else 1))
        elif name == "a":
            in_link = not closing
        if not closing and i in partner and i not in found and (
                name in _RAW or name in _ALWAYS or _foreign(marked.get(i, set()))):
            until = partner[i]
    if not inside[-1] and not plain[-1]:
        return found
    size = inside if inside[-1] else plain
    size = [*size, size[-1] + (len(page[at:].strip()) if size is plain else 0)]
    for i, words in marked.items():
        if tokens[i][3] not in _ALWAYS and not _foreign(words):
            held = size[partner[i] + 1] - size[i + 1]
            if held and 2 * held >= size[-1]:
                found.add(i)
    return found


def lines(page: str) -> tuple[list[tuple[str, int, int, int]], list[list[int]]]:
    """(text, weight, number of the outermost article or main around it or 0, element) of the lines of a
    page; links have no weight, and a boilerplate element is a line without text.  And [parent, first line,
    end] of the closed block elements below ``<body>``; -1 for none."""
    tokens = []                              # (start, end, closing, name, attributes)
    at, n = 0, len(page)
    raw_end: dict[str, re.Pattern] = {}
    while at < n and (m := _TOKEN.search(page, at)):
        name = (m[2] or "").lower()
        end = m.end()
        if name in ("script", "style", "textarea", "iframe", "title", "noscript") and not m[1]:
            close = raw_end.setdefault(name, re.compile(rf"</{name}\s*>", re.I)).search(page, end)
            end = close.end() if close else (n if name in ("script", "style") else end)
            tokens.append((m.start(), end, "", "!raw", ""))
        else:
            tokens.append((m.start(), end, m[1], name, m[3] or ""))
        at = end
    # partner of every closed element; an element left open by its parent's end has none
    partner: dict[int, int] = {}
    opened: dict[str, list[int]] = {}
    for i, (_, _, closing, name, rest) in enumerate(tokens):
        if not name or name in _VOID or rest.endswith("/"):
            continue
        if not closing:
            opened.setdefault(name, []).append(i)
        elif opened.get(name):
            partner[opened[name].pop()] = i
    # reader comments left open end where the next outer element does
    soft: dict[int, int] = {}
    for i in sorted(x for held in opened.values() for x in held):
        if _COMMENTS & _marks(tokens[i][3], tokens[i][4]):
            soft[i] = min((j for k, j in partner.items() if k < i < j), default=len(tokens))
    marked = {i: words for i in partner
              if (words := _marks(tokens[i][3], tokens[i][4])) or tokens[i][3] in _BOILERPLATE}
    wrap = wrappers(page, tokens, partner, marked) if marked else set()
    out: list[tuple[str, int, int, int]] = []
    elements: list[list[int]] = []
    held: list[tuple[int, int]] = []         # (token that ends it, element) around the current token
    buffer: list[str] = []
    linked: list[str] = []
    in_link, depth, articles = False, 0, 0

    def flush(weightless: bool = False) -> None:
        while held and held[-1][0] < i:
            elements[held.pop()[1]][2] = len(out)
        element = held[-1][1] if held else -1
        text = " ".join(html.unescape("".join(buffer)).split()) if buffer else ""
        if text:
            in_links = len(" ".join(html.unescape("".join(linked)).split())) if linked else 0
            out.append((text, 0 if 2 * in_links > len(text) else len(text), articles if depth else 0, element))
        if weightless:
            out.append(("", 0, 0, element))
        buffer.clear()
        linked.clear()

    def hold() -> None:
        """The element that token ``i`` opens holds the lines that follow."""
        if not closing and i in partner and name not in ("html", "body"):
            held.append((partner[i], len(elements)))
            elements.append([held[-2][1] if len(held) > 1 else -1, len(out), -1])

    at, i = 0, 0
    while i < len(tokens):
        start, end, closing, name, rest = tokens[i]
        if start > at:
            buffer.append(page[at:start])
            if in_link:
                linked.append(page[at:start])
        at = end
        if i in soft:
            flush(weightless=True)
            i = soft[i]
            at = tokens[i][0] if i < len(tokens) else n
            continue
        hidden = False
        if name and not closing and i in partner:
            words = marked.get(i)
            # a header inside an article holds its headline
            headline = depth > 0 and words is not None and words <= {"header"} and (words or name == "header")
            hidden = (name in _RAW or words is not None and i not in wrap and not (headline and name not in _ALWAYS)
                      or bool(rest and _HIDDEN.search(rest)))
        if hidden:
            flush(weightless=name not in _RAW)
            i = partner[i]
            at = tokens[i][1]
        elif name == "a":
            in_link = not closing
        elif name in ("article", "main"):
            flush()
            articles += not depth and not closing
            depth = max(0, depth + (-1 if closing else 1))
            hold()
        elif name in _BLOCK:
            flush()
            hold()
        i += 1
    if at < n:
        buffer.append(page[at:])
    flush()
    for _, e in held:
        elements[e][2] = len(out)
    return out, elements


def distribution(weights: np.ndarray, window: int = WINDOW) -> np.ndarray:
    """Sums of the lines i .. i+window-1."""
    return np.convolve(weights, np.ones(window, np.int64))[window - 1:]


def spans(weights: np.ndarray, window: int = WINDOW) -> list[tuple[int, int]]:
    """(surge, dive) of every stretch of lines whose window sums are positive, without the
    weightless lines at its ends."""
    if not weights.any():
        return []
    live = distribution(weights, window) > 0
    edge = np.diff(np.r_[False, live, False].astype(np.int8))
    found = []
    for a, b in zip(np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)):
        some = np.flatnonzero(weights[a:b]) + a
        if len(some):
            found.append((int(some[0]), int(some[-1]) + 1))
    return found


def surges(weights: np.ndarray, window: int = WINDOW) -> list[tuple[int, int, bool]]:
    """(start, dive, surge or not) of every stretch of lines between dives: ``spans`` with no more than
    ``window`` weightless lines between them (one empty window) are one stretch."""
    found: list[tuple[int, int]] = []
    for a, b in spans(weights, window):
        if found and a - found[-1][1] <= window:
            found[-1] = (found[-1][0], b)
        else:
            found.append((a, b))
    if len(found) < 2:
        return [(a, b, True) for a, b in found]
    sums = distribution(weights, window)
    highest = [int(sums[a:b].max()) for a, b in found]
    least = min(SURGE, max(highest) / SHARE)
    return [(a, b, top >= least) for (a, b), top in zip(found, highest)]


def beside(first: int, last: int, rows: list[tuple], elements: list[list[int]], surging: np.ndarray) -> bool:
    """Whether the smallest element that holds the lines ``first`` to ``last`` and another one holds
    a surge (``surging``: their lines before each line) and is not the whole page."""
    e = rows[first][3]
    while e >= 0:
        parent, start, end = elements[e]
        if start <= first and last < end and end - start > last + 1 - first:
            return end - start < len(rows) and bool(surging[end] > surging[start])
        e = parent
    return False


def main_text(page: str | None, window: int = WINDOW) -> str:
    every, elements = lines(page or "")
    at = [k for k, r in enumerate(every) if r[0]]
    rows = [every[k] for k in at]
    within = INSIDE * sum(r[1] for r in rows if r[2])
    marked = any(r[2] for r in rows) and within >= sum(r[1] for r in rows if not r[2])
    if marked:
        # articles of nothing but links are weighed by these
        weights = [(r[1] if within else len(r[0])) if r[2] else 0 for r in rows]
    else:
        weights = [r[1] for r in rows]
    found = surges(np.array(weights, np.int64), window)
    if not all(high for _, _, high in found):
        lit = np.zeros(len(every) + 1, np.int64)
        for a, b, high in found:
            if high:
                lit[np.array(at[a:b]) + 1] = 1
        lit = np.cumsum(lit)
        found = [(a, b, high) for a, b, high in found if high or beside(at[a], at[b - 1], every, elements, lit)]
    if not found:
        return ""
    first, last = found[0][0], found[-1][1] - 1
    if marked:
        # an article's own links belong to it, to its edges
        first = next(k for k, r in enumerate(rows) if r[2] == rows[first][2])
        last = next(k for k in range(len(rows) - 1, -1, -1) if rows[k][2] == rows[last][2])
    return " ".join(r[0] for r in rows[first:last + 1] if r[2] or not marked)


def extract(pages: DataFrame) -> DataFrame:
    """``page_id``, ``url`` and ``text`` per row."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (s for b in batches for s in slices(b, "html")):
            text = pa.array([main_text(p) for p in batch.column("html").to_pylist()], pa.string())
            yield pa.RecordBatch.from_arrays([batch.column("page_id"), batch.column("url"), text],
                                             ["page_id", "url", "text"])

    return pages.select("page_id", "url", "html").mapInArrow(run, schema_of(pages, ["page_id", "url"], "text string"))
