from quarry.llm import catalog, htmltext

PAGE = """<!DOCTYPE html><html><head><title>T &amp; t</title><style>p{margin:0}</style>
<script>var t="</p>";track(3);</script></head><body>
<header><h1>Site name of some length</h1></header>
<nav><ul><li><a href="/a">One</a></li><li><a href="/b">Two</a></li></ul></nav><!-- ad <p>x</p> -->
<div class="cookie-notice">We use cookies on this site to make it better for you.</div>
<div class="ad">Buy this very fine thing now, it is cheap and good.</div>
%s
<aside>Related: other things to read that are not the article</aside>
<form><label>Mail</label><input name="a>b"><button>Send</button></form>
<section id="comments"><p>First! This is a comment by a reader, quite long in fact.</p></section>
<footer>&copy; example.com &middot; All rights reserved and some more words.</footer></body></html>"""

ARTICLE = """<h1>Title &eacute;</h1><p>First <b>bold</b> para&shy;graph with
  line&nbsp;break.<br>After a <a href="x" title="a>b">link</a>.</p><p>Short.</p><ul><li>item &#8212; one</li></ul>
  <p><i>unclosed"""
TEXT = "Title é First bold para\xadgraph with line break. After a link. Short. item — one unclosed"


def test_article_element():
    assert htmltext.main_text(PAGE % f"<article>{ARTICLE}</article>") == TEXT


def test_without_article_element():
    body = ARTICLE.replace("Short.", "Short. " + "More words follow here. " * 5)
    assert htmltext.main_text(PAGE % f"<div>{body}</div>") == TEXT.replace("Short.", ("Short. " + "More words follow here. " * 5).strip())


def test_defined_cases():
    assert htmltext.main_text(None) == htmltext.main_text("") == htmltext.main_text("<p></p>") == ""
    assert htmltext.main_text("plain &lt;b&gt; text") == "plain <b> text"
    assert htmltext.main_text("<article><p>Only.</p></article>") == "Only."
    assert htmltext.main_text("<article><p>Open <p>end") == "Open end"
    assert htmltext.main_text("<nav><p>No end of the menu, but text follows that is long enough") != ""
    assert htmltext.main_text("<p>a < b and c > d &amp;lt; &unknown; &am</p>") == "a < b and c > d &lt; &unknown; &am"
    assert len(htmltext.main_text("<article>" + "<p>word word</p>" * 50000 + "</article>")) == 50000 * 10 - 1


def test_wrappers_with_boilerplate_words_are_read():
    rest = "<nav><a href='/'>Home</a></nav>%s<div class='site-footer'>All rights reserved.</div>"
    story = "<p>" + "Words of the story go on. " * 6 + "</p><p>End.</p>"
    want = ("Words of the story go on. " * 6 + "End.")
    for body in (f"<article>{story}</article>", f"<main>{story}</main>", f"<div>{story}</div>"):
        for a, b in (("<div class='site has-sidebar'>", "</div>"), ("<div id='page' class='menu-open'>", "</div>"),
                     ("<form id='aspnetForm' action='x'>", "</form>"), ("<div class='widget'>", "</div>"),
                     ("<div class=menu><form>", "</form></div>")):
            assert htmltext.main_text(f"<body>{a}{rest % body}{b}</body>") == want, (a, body)
    teasers = "<div class='related'><article>Other story.</article></div>"
    comments = "<section id='comments'><article>" + "A long comment. " * 50 + "</article></section>"
    assert htmltext.main_text(rest % f"<article>{story}</article>{teasers}{comments}") == want


def test_headline_in_a_header_of_the_article():
    text = "<p>" + "Words of the story go on. " * 6 + "</p>"
    for head in ("<header><h1>Headline</h1></header>", "<div class='article-header'><h1>Headline</h1></div>",
                 "<div class='header'><h1>Headline</h1></div>"):
        page = f"<header><h1>Site</h1></header><article>{head}{text}<div class='share'>Share</div></article>"
        assert htmltext.main_text(page) == "Headline " + ("Words of the story go on. " * 6).strip()
    assert htmltext.main_text(f"<div><div class='article-header'><h1>Headline</h1></div>{text}</div>").startswith("Headline W")


def test_short_and_link_heavy_lines_between_surge_and_dive():
    long, ad = "Words of the story go on. " * 20, "<div class='ad'>Buy</div><script>x()</script><div class='notice'>Note</div>"
    links = "<p><a href='/a'>See this page</a></p>" * 4
    nav = "<div><a href='/1'>One</a></div><div><a href='/2'>Two</a></div><div><a href='/3'>Three</a></div>"
    page = f"{nav}<p>{long}</p>{ad}{ad}<p>Short.</p>{links}<p>{long}</p>{ad}<p>Last one.</p>{nav}"
    want = [long.strip(), "Short.", *["See this page"] * 4, long.strip(), "Last one."]
    assert htmltext.main_text(page) == " ".join(want)


def test_spans_follow_surges_and_dives():
    import numpy as np

    w = np.array([0, 0, 9, 0, 5, 0, 0, 0, 7, 0])
    assert htmltext.spans(w) == [(2, 5), (8, 9)]
    assert htmltext.spans(np.zeros(4, int)) == [] and htmltext.spans(np.array([3])) == [(0, 1)]


def test_whole_table(spark):
    """Every page of the table: article blocks found by plain string operations."""
    import html
    import re

    rows = catalog.op4_html_extraction(spark, "/root/testdata/sf0.01").collect()
    pages = {r["page_id"]: r["html"] for r in spark.read.parquet("/root/testdata/sf0.01/pages.parquet").collect()}
    assert len(rows) == len(pages)
    for r in rows:
        inner = re.search(r"<article>(.*?)</article>", pages[r["page_id"]], re.S)[1]
        want = " ".join(html.unescape(re.sub(r"</?(?:p|h1|br|b)>", lambda m: "" if m[0] in ("<b>", "</b>") else "\n", inner)).split())
        assert r["text"] == want and r["n_chars"] == len(want)


def test_nulls_and_clashing_columns(spark):
    df = spark.createDataFrame([(1, None, None, "x"), (None, "u", "<article>a</article>", "y"), (1, None, None, "x")],
                               "page_id long, url string, html string, text string")
    assert sorted((r["text"] for r in htmltext.extract(df).collect())) == ["", "", "a"]
    assert htmltext.extract(df.limit(0)).count() == 0


STORY = "<p>" + "Words of the story go on. " * 11 + "</p>"
STORY_TEXT = ("Words of the story go on. " * 11).strip()


def test_a_teaser_article_does_not_replace_the_story():
    for teaser in ("<article><a href='/n'>Next story</a></article>", "<article><p>Next: a story.</p></article>"):
        assert STORY_TEXT in htmltext.main_text(f"<div id=story>{STORY}</div>{teaser}")
    assert htmltext.main_text(f"<article>{STORY}</article><p>Some loose words beside it.</p>") == STORY_TEXT
    assert htmltext.main_text("<article><p>Short.</p></article>") == "Short."


def test_a_short_closing_paragraph_stays():
    links = "<p><a href='/a'>See this page</a></p>" * 3
    assert htmltext.main_text(f"<div>{STORY}{links}<p>The end is short.</p></div>").endswith("The end is short.")


def test_adverts_and_comments_do_not_leak():
    for extra in ('<div class="ad-slot-1">Buy</div>', '<ins class="adsbygoogle">Buy</ins>',
                  '<div class="sponsored-content">Buy</div>', '<div id="google_ads_iframe">Buy</div>',
                  '<div class="c-comment">Nice</div>', '<article class="comment"><p>Nice one, long enough.</p></article>'):
        for page in (f"<main>{STORY}{extra}</main>", f"<div>{STORY}{extra}</div>", f"<article>{STORY}{extra}</article>"):
            assert htmltext.main_text(page) == STORY_TEXT, page
    for page in (f"<div>{STORY}</div><ol class='comment-list'><li>First!<li>Second, and longer.",
                 f"<main>{STORY}<section id=comments><p>First!</p></main><footer>All rights</footer>"):
        assert htmltext.main_text(page) == STORY_TEXT, page


def test_the_given_pages_without_their_article_tags(spark):
    """The distribution alone finds the same text."""
    import re

    pages = [r["html"] for r in spark.read.parquet("/root/testdata/sf0.1/pages.parquet").collect()]
    same = sum(htmltext.main_text(re.sub(r"(?i)<(/?)(article|main)\b[^>]*>", r"<\1div>", p)) == htmltext.main_text(p)
               for p in pages)
    assert same == len(pages)


def test_spans_equal_a_plain_search():
    import numpy as np

    rng = np.random.default_rng(3)
    for _ in range(300):
        w = rng.integers(0, 3, rng.integers(1, 25)) * rng.integers(0, 2, 1)
        want, some = [], [i for i, x in enumerate(w) if x]
        for i in some:      # lines with text are together if fewer than WINDOW - 1 empty ones lie between
            if want and i - want[-1][1] < htmltext.WINDOW - 1 + 1:
                want[-1] = (want[-1][0], i + 1)
            else:
                want.append((i, i + 1))
        got = htmltext.spans(w)
        assert [x for a, b in got for x in range(a, b) if w[x]] == some
        assert all(w[a] and w[b - 1] for a, b in got)
        assert not want or (got[0][0], got[-1][1]) == (want[0][0], want[-1][1])


LINKS = "".join(f"<li><a href='/{k}'>Section {k}</a></li>" for k in range(6))
LINK_TEXT = " ".join(f"Section {k}" for k in range(6))
SITE = f"<div>Example site</div><ul>{LINKS}</ul>%s<ul>{LINKS}</ul><div>(c) 2024 Example</div>"


def test_surges_and_dives_decide():
    """Short lines beyond link lists that no element name or class gives away are no text."""
    assert htmltext.main_text(SITE % f"<div id=story>{STORY}{STORY}</div>") == f"{STORY_TEXT} {STORY_TEXT}"
    flat = f"<p>Example site</p><ul>{LINKS}</ul>{STORY}<ul>{LINKS}</ul><p>(c) 2024 Example</p>"
    for page in (flat, f"<html><body>{flat}</body></html>", f"<html><body><div id=page>{flat}</div></body></html>"):
        assert htmltext.main_text(page) == STORY_TEXT
    assert "Example site" in htmltext.main_text(flat, window=6)      # six links are no dive for a window of six
    both = htmltext.main_text(SITE % f"<div>{STORY}</div><ul>{LINKS}</ul><div><p>Two.</p>{STORY}</div>")
    assert both == f"{STORY_TEXT} {LINK_TEXT} Two. {STORY_TEXT}"     # two surges, all between them
    assert htmltext.main_text(SITE % "<p>A short note.</p>").startswith("Example site")     # no window is far above


def test_the_own_short_lines_of_a_text_stay():
    own = f"<h1>Short</h1><ul>{LINKS}</ul>{STORY}<ul>{LINKS}</ul><p>The end is short.</p>"
    want = f"Short {LINK_TEXT} {STORY_TEXT} {LINK_TEXT} The end is short."
    assert htmltext.main_text(SITE % f"<div id=story>{own}</div>") == want
    assert htmltext.main_text(SITE % f"<div id=story><div>{own}</div></div>") == want
    assert htmltext.main_text(PAGE % f"<div>{own}</div>") == want
    assert htmltext.main_text(PAGE % f"<article>{own}</article>") == want


def test_surges_and_dives_decide_between_articles():
    loose, links = "<p>Loose words.</p>" * 5, "<p><a href='/a'>See this page</a></p>" * 6
    own = f"<h1><a href='/s'>Headline</a></h1>{links}{STORY}{links}<p>The end is short.</p>{links}"
    link_text = " ".join(["See this page"] * 6)
    want = f"Headline {link_text} {STORY_TEXT} {link_text} The end is short. {link_text}"
    for name in ("article", "main"):
        page = f"<{name}>{own}</{name}>"
        assert htmltext.main_text(page) == want
        for teaser in (f"<article>{links}</article>", f"{loose}<article><p>Next: a story.</p></article>"):
            assert htmltext.main_text(page + teaser) == want
            assert htmltext.main_text(teaser + loose + page) == want
        assert htmltext.main_text(f"<main>{page}<article>{links}</article></main>") == f"{want} {link_text}"
        assert htmltext.main_text(f"{page}{loose}<article>{STORY}</article>") == f"{want} {STORY_TEXT}"
    assert htmltext.main_text(f"<article>{links}</article>") == link_text


def test_surges_equal_a_plain_search():
    import numpy as np

    rng = np.random.default_rng(5)
    one = several = 0
    for _ in range(400):
        w = rng.choice([0, 0, 0, 0, 0, 3, 20, 90, 400], rng.integers(1, 40))
        window, n = int(rng.integers(1, 5)), len(w)
        block = [sum(int(x) for x in w[i:i + window]) for i in range(n)]
        want, least = [], min(htmltext.SURGE, max(block) / htmltext.SHARE)
        for i in (i for i in range(n) if w[i]):
            j = want[-1][-1] + 1 if want else 0
            if want and not any(block[k] == block[k + 1] == 0 for k in range(j, i - 1)):
                want[-1].append(i)
            else:
                want.append([i])
        got = htmltext.surges(w, window)
        assert got == [(s[0], s[-1] + 1, max(block[s[0]:s[-1] + 1]) >= least) for s in want], (w, window)
        one, several = one + any(not x for *_, x in got), several + (len(got) > 1)
    assert one > 20 and several > 100
