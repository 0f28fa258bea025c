import pytest
from tripmart.llm import html_text as H

ARTICLE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var t="</p>";</script></head><body>
<nav><ul><li><a href="/a">Home</a></li><li><a href="/b">More</a></li></ul></nav><!-- ad --><div class="ad">Buy this now, it is cheap.</div>
<article><h1>Title &amp; more</h1><p><b>First   para&shy;graph&#33;<br><p>Second one,
with a <a href="x">link</a>.</p><div class="share"><a>tweet</a></div><p>Short.</p><form><input value="x">Your name</form></article>
<aside>Side text that is long enough to be a paragraph of its own, really.</aside>
<div id="comments"><p>Reader says: nice text, thanks a lot for writing it.</p></div>
<footer>&copy; site &middot; Imprint</footer></body></html>"""


TEXT = "Title & more\n\nFirst para\xadgraph!\n\nSecond one, with a link.\n\nShort."


def test_marked_article():
    assert H.main_text(ARTICLE) == TEXT


@pytest.mark.parametrize("html,text", [
    (None, ""), ("", ""), ("   ", ""), ("plain text only", "plain text only"), ("<p>a", "a"), ("<p>a &lt;b&gt; &unknown; &amp", "a <b> &unknown; &"),
    ("<article><p>one<p>two</article", "one\n\ntwo"), ("<p>x < y and y > z</p>", "x < y and y > z"), ("<script>never closed <p>x</p>", ""),
    ("<!-- open <p>x</p>", ""), ("<nav>menu</nav>", ""), ("<div class=ad>ad<article><p>text</p></article>", "text"),
    ("<article><p>cut in the middle of a ta<a hre", "cut in the middle of a ta"), ("<pre>a\n\n b</pre>", "a b"),
    ('<article><p title="a > b">quoted</p></article>', "quoted"), ("<ARTICLE><P>Upper</P></ARTICLE>", "Upper")])
def test_small_pages(html, text):
    assert H.main_text(html) == text


def test_unmarked_page_by_distribution():
    body = "".join(f"<p>{'A sentence of the story that goes on. ' * 5}{i}</p>" for i in range(6))
    menu = "".join(f'<div><a href="/{i}">Item {i}</a></div>' for i in range(8))
    page = f"<body>{menu}{body}{menu}<div>About us</div></body>"
    got = H.main_text(page).split("\n\n")
    assert len([x for x in got if x.startswith("A sentence")]) == 6
    assert "About us" not in got and len(got) <= 8  # a surge may take the line next to it


def test_long_and_odd_rows(spark):
    long = "<article>" + "<p>word</p>" * 20_000 + "</article>"
    rows = [(1, "u", ARTICLE), (1, "u", ARTICLE), (None, None, None), (2, None, ""), (3, "v", long), (4, "w", "<" * 50_000)]
    got = H.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()
    assert sorted(((r.page_id, r.url, r.n_chars) for r in got), key=str) == sorted(
        [(1, "u", len(TEXT))] * 2 + [(None, None, 0), (2, None, 0), (3, "v", 20_000 * 6 - 2), (4, "w", 50_000)], key=str)
    assert all(r.n_chars == len(r.text) for r in got)
