import random
import re
import time

import pyarrow.parquet as pq
import pytest
from cases import SF

from eventlake.llm import line_blocks
from eventlake.llm.queries import QUERIES

STORY = ["A headline", "The first paragraph has quite a few words, so that it is surely taken for text &amp; kept.", "Short.",
         "Another paragraph, again with many words and some <b>bold</b> ones in it, and a <a href='/x'>link</a> too."]
PLAIN = ["A headline", "The first paragraph has quite a few words, so that it is surely taken for text & kept.", "Short.",
         "Another paragraph, again with many words and some bold ones in it, and a link too."]


def article(tag_open, tag_close, extra=""):
    return (f"{tag_open}<h1>{STORY[0]}</h1><p>{STORY[1]}<p>{STORY[2]}</p>{extra}<div>{STORY[3]}</div>{tag_close}")


NOISE_BEFORE = ('<!DOCTYPE html><html><head><title>A headline</title><style>p{}</style><script>var t="</p><p>no";</script></head><body class="main">'
                '<header><h1>Site name</h1></header><nav><ul><li><a href="/a">One</a></li><li><a href="/b">Two</a></li></ul></nav>'
                '<div class="cookie-notice"><p>We use cookies and a long notice that says so in very many words indeed.</p></div>')
NOISE_AFTER = ('<aside><p>A sidebar with a good number of words in it, which is not the article at all.</p></aside>'
               '<div id="comments"><p>A reader comments at length on everything that has been said above.</p></div>'
               '<form><p>Write to us by this form, please, with a long text.</p><input value="x"></form><footer>&copy; all of us, and more words here</footer>')


@pytest.mark.parametrize("tags", [("<article>", "</article>"), ("<main class=x>", "</main>"), ('<div class="story">', "</div>"), ("", "")])
def test_main_text_between_noise(tags):
    page = NOISE_BEFORE + article(*tags) + NOISE_AFTER + "</body></html>"
    assert line_blocks.main_text(page) == " ".join(PLAIN)


def test_noise_inside_the_article():
    extra = ('<div class="ad">Buy this now, it is very good and very cheap.</div><script>x="<p>"</script><aside>See also this other '
             'story</aside><!-- <p>not shown</p> --><form><p>Sign up</p></form><section class="comments"><p>First!</p></section>')
    assert line_blocks.main_text(NOISE_BEFORE + article("<article>", "</article>", extra)) == " ".join(PLAIN)


@pytest.mark.parametrize("page,text", [
    (None, ""), ("", ""), ("<", ""), ("<p", ""), ("<article></article>", ""), ("<article>a<br>b&nbsp;c  d\n e</article>", "a b c d e"),
    ("<article>a&am b&amp c &#x41;&lt;p&gt;</article>", "a&am b& c A<p>"), ("<article><p>un<b>clo</b>sed<p>two", "unclosed two"),
    ("<article><p>x</article></article></div><p>y", "x"), ("<article><ul><li>a<li>b</ul><table><tr><td>c<td>d</table></article>", "a b c d"),
    ("<article>1 < 2 > 0</article>", "1 < 2 > 0"), ("<article><header><h1>T</h1></header><p>x</p></article>", "T x"),
    ("<article><span class='share'>tweet</span>x</article>", "x"), ("<article><div class='has-sidebar'>x</div></article>", "x"),
    ("<article><div class='comment-body'>no</div><div class='post-header'>x</div><p id=ad-main>no</p></article>", "x"),
    ("<article><p style='color:red; display: none'>no</p>x</article>", "x"),
    ("<div class='widget'><article>x</article></div>", "x"), ("<article>" + "<div>" * 3000 + "deep", "deep"),
])
def test_odd_pages(page, text):
    assert line_blocks.main_text(page) == text


def test_query(spark):
    rows = {r["page_id"]: r for r in QUERIES["op9_page_texts"](spark, SF).collect()}
    pages = pq.read_table(f"{SF}/pages.parquet").to_pylist()
    assert len(rows) == len(pages)
    for p in pages:
        r, html = rows[p["page_id"]], p["html"]
        inner = html[html.index("<article>") + 9:html.index("</article>")]
        import html as h
        import re

        blocks = [" ".join(h.unescape(b).split()) for b in re.split(r"</?(?:h1|p|br)[^>]*>", inner.replace("<b>", "").replace("</b>", ""))]
        assert r["text"] == " ".join(b for b in blocks if b) and r["n_chars"] == len(r["text"]) and r["url"] == p["url"]


def test_tables(spark):
    pages = spark.createDataFrame([(1, None, None, "x", "y"), (1, "u", "<article>t</article>", "x", "y"), (None, "u", "", "x", "y")],
                                  "page_id long, url string, html string, Text string, found string")
    rows = line_blocks.extract(pages)
    assert sorted(rows.columns) == ["found", "html", "n_chars", "page_id", "text", "url"]
    assert sorted(r["text"] for r in rows.collect()) == ["", "", "t"]
    assert line_blocks.extract(pages.limit(0)).count() == 0


LONG = "A paragraph of the story itself, with as many words as it takes to be told from menus and such."


@pytest.mark.parametrize("tag", ["article", "main"])
def test_article_lines_pass_surge_and_dive(tag):
    links = "".join(f"<li><a href='/{i}'>Another story that may be of interest, number {i}</a></li>" for i in range(8))
    page = f"<body><{tag}><h1>Head</h1><p>{LONG}</p><p>{LONG}</p><ul>{links}</ul><p>End.</p></{tag}></body>"
    assert line_blocks.main_text(page) == f"Head {LONG} {LONG} End."


def test_story_outside_a_teaser_card():
    story = "".join(f"<div>{LONG} {i}</div>" for i in range(9))
    page = f"<body><article><a href='/x'>Card</a><p>A teaser of another story.</p></article><div>{story}</div></body>"
    text = line_blocks.main_text(page)
    assert all(f"{LONG} {i}" in text for i in range(9))


def test_short_article_is_whole_and_bounds_the_lines():
    assert line_blocks.main_text("<body><div>out</div><article><p>One.</p><p>Two.</p></article><p>out</p></body>") == "One. Two."


VERSE = [f"a short line of verse {i}" for i in range(12)]


@pytest.mark.parametrize("page,text", [
    ("<body><div>" + "<br>".join(VERSE) + "</div></body>", " ".join(VERSE)),
    ("<body><ul>" + "".join(f"<li>{v}" for v in VERSE) + "</ul></body>", " ".join(VERSE)),
    ("<body><div><p>Short in all.</p></div></body>", "Short in all."),
    (f"<div><h1>Head</h1><p>By me</p><p>Today</p><p>2 min</p><p>{LONG}</p></div>", f"Head By me Today 2 min {LONG}"),
    (f"<div><h1>Head</h1><h2>Second</h2><div><span>By me</span></div><div>Today</div><div>2 min</div><section><p>{LONG}</p></section></div>",
     f"Head Second By me Today 2 min {LONG}"),
    (f"<div><p>{LONG}</p><div class=ad><p>Buy</p><p>this</p><p>now</p></div><p>The end.</p></div>", f"{LONG} The end."),
    (f"<div><p>{LONG}</p><p><a href=x>a</a><p><a href=x>b</a><p><a href=x>c</a><p>The end.</p></div>", f"{LONG} The end."),
    (f"<article><div class='elementor-widget elementor-widget-text-editor'><div class='elementor-widget-container'><p>{LONG}</p></div></div>"
     "<div class='widget widget_recent'>Not this</div></article>", LONG),
    (f"<body><p>Some words left.</p><div id='sidebar-layout'><p>{LONG}</p><p>{LONG}</p></div></body>", f"Some words left. {LONG} {LONG}"),
    (f"<body><p>{LONG}</p><div style='display:none'>{LONG * 9}</div></body>", LONG),
    *[(f"<body><{name}><p>{LONG}</p></body>", LONG) for name in ("button", "svg", "noscript", "select", "head", "object", "iframe")],
    *[(f"<body><p>{LONG}</p><{name}><p>{LONG}</p></body>", LONG) for name in ("script", "style", "textarea", "title")],
])
def test_no_text_of_the_story_is_dropped(page, text):
    assert line_blocks.main_text(page) == text


@pytest.mark.parametrize("page,text", [
    (f"<article><h1><a href='/s'>Linked headline</a></h1><p>{LONG}</p></article>", f"Linked headline {LONG}"),
    (f"<body><div><h2><a href='/s'>Linked headline</a></h2><p>{LONG}</p></div></body>", f"Linked headline {LONG}"),
    (f"<article><p>{LONG}</p><blockquote><a href='/q'>A quote that is one link</a></blockquote><p>{LONG}</p></article>",
     f"{LONG} A quote that is one link {LONG}"),
    (f"<article><p>{LONG}</p><blockquote><p><a href='/q'>A quote at the end</a></p></blockquote></article>", f"{LONG} A quote at the end"),
    (f"<body><div>Site</div><div>Follow us</div><div><h1>Head</h1><p>{LONG}</p></div></body>", f"Head {LONG}"),
    (f"<body><div class='topbar'>Home News</div><div><h1>Head</h1><p>{LONG}</p></div></body>", f"Head {LONG}"),
    (f"<body><div><span>a</span></div><div>b</div><section><div><p>Short first.</p><p>{LONG}</p></div></section></body>", f"Short first. {LONG}"),
    (f"<article><p title='a > b < c' data-x=\"<p>\">{LONG}</p></article>", LONG),
    (f"<article><p title=\"it's\">{LONG}</p><p x='\"'>{LONG}</p></article>", f"{LONG} {LONG}"),
])
def test_linked_headlines_quotes_and_lines_before_the_surge(page, text):
    assert line_blocks.main_text(page) == text


OLD_TAG = re.compile(r"</?[A-Za-z](?:[^>\"']|\"[^\"]*\"|'[^']*')*>")


def test_tag_ends_are_those_of_the_plain_expression():
    rng = random.Random(4)
    for _ in range(3000):
        page = "".join(rng.choice("<>\"' ap/") for _ in range(rng.randrange(1, 40)))
        tags = line_blocks.Tags(page)
        for at in range(len(page)):
            if line_blocks.TAG_BEGINS.match(page, at):
                plain, quick = OLD_TAG.match(page, at), line_blocks.TOKEN.match(page, at).group()
                assert tags.end(at) == (plain and plain.end())
                assert quick == "<" or quick == plain.group()


@pytest.mark.parametrize("broken", ["<a ", "<p x=\"", "<p x='", "<p x=\"'", "<a href='x\">", "</p ", "<", "<!-", "<div>", "</div>", "<a>", "&#"])
def test_broken_pages_take_linear_time(broken):
    started = time.process_time()
    line_blocks.lines_of(broken * ((1 << 20) // len(broken)) + ">")
    assert time.process_time() - started < 20


def test_closing_tags_in_a_deep_page_take_linear_time():
    started = time.process_time()
    line_blocks.lines_of("<div>" * 100_000 + "</p>" * 100_000)
    assert time.process_time() - started < 10
