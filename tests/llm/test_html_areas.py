import time

import pytest
from tripmart.llm import html_text as H

LONG = "A sentence of the story that goes on and on. " * 9


def story(n=4):
    return [f"{LONG}{i}" for i in range(n)]


def paragraphs(texts):
    return "".join(f"<p>{t}</p>" for t in texts)


def text(lines):
    return "\n\n".join(" ".join(x.split()) for x in lines)


@pytest.mark.parametrize("part,lines", [
    ("<h2><a href='#x'>Heading</a></h2>", ["Heading"]),
    ("<p><a href=x>A paragraph that is a link</a></p>", ["A paragraph that is a link"]),
    ("<ul><li><a href=a>Source 1</a></li><li><a href=b>Source 2</a></li><li><a href=c>Source 3</a></li></ul>", ["Source 1", "Source 2", "Source 3"]),
    ("<table><tr><td><a href=a>Cell</a></td></tr></table>", ["Cell"])])
def test_links_stay_in_the_article(part, lines):
    assert H.main_text(f"<article><p>{LONG}</p>{part}<p>End.</p></article>") == text([LONG, *lines, "End."])


@pytest.mark.parametrize("page", ["<article>{}</article>", "<body>{}</body>"])
def test_open_link_ends(page):
    body = f"<p>{LONG} <a href=x>never closed</p>" + paragraphs(story())
    assert H.main_text(page.format(body)) == text([LONG + " never closed", *story()])


MENU = "".join(f"<div><a href=/{i}>Item {i}</a></div>" for i in range(8))


@pytest.mark.parametrize("wrapped", ["<div><p>{}</p></div>", "<div><div><div><p>{}</p></div></div></div>",
                                     "<p>{}</p><div class=ad><div><p>Buy now.</p><p>Cheap.</p></div></div>"])
def test_unmarked_page_keeps_short_paragraphs(wrapped):
    lines = [LONG, LONG, "A short one of ninety characters that ends the story.", LONG, "End."]
    page = f"<body>{MENU}{''.join(wrapped.format(x) for x in lines)}{MENU}<div>About us</div></body>"
    got = H.main_text(page).split("\n\n")
    assert [x for x in got if not x.startswith("Item")] == [" ".join(x.split()) for x in lines]
    assert len(got) <= len(lines) + 2  # a surge may take the line next to it


def test_lines_between_kept_spans_stay():
    links = [f"Source {i}" for i in range(6)]
    items = "".join(f"<li><a href=/{i}>{x}</a></li>" for i, x in enumerate(links))
    page = f"<div><p>{LONG}</p></div><ul>{items}</ul><p>Short.</p><ul>{items}</ul>{paragraphs(story(2))}"
    assert H.main_text(page) == text([LONG, *links, "Short.", *links, *story(2)])


@pytest.mark.parametrize("html,lines", [
    ("<article><p class=notice>N<p>Main one</p><p>Main two</p></article>", ["Main one", "Main two"]),
    ("<article><ul><li class=ad>Ad<li>One<li>Two</ul><p>End</article>", ["One", "Two", "End"]),
    ("<article><table><tr><td class=ad>Ad<td>One<tr><td>Two</table>End</article>", ["One", "Two", "End"]),
    ("<article><dl><dt>T<dd class=ad>Ad<dt>U<dd>V</dl></article>", ["T", "U", "V"]),
    ("<article><div><nav><p>Menu</div><p>Main</article>", ["Main"]),
    ("<article><div class=ad><p>Ad<p>More</div><p>Main<p class=notice>N<h2>Head</h2><p>Text</article>", ["Main", "Head", "Text"]),
    ("<article><p class=notice>N<div>Main<ul><li>A<ul><li class=ad>B</ul><li>C</ul></div></article>", ["Main", "A", "C"]),
    ("<article><p>One <span class=ad>Ad</span>two</p></article>", ["One two"]),
    ("<article><table><tr><td><p>One</div></p><td>Two</table></article>", ["One", "Two"]),
    ("<head><meta charset=x><title>T</title><p>Main", ["Main"])])
def test_skipped_elements_end_with_implied_tags(html, lines):
    assert H.main_text(html) == text(lines)


def test_link_that_holds_blocks_is_a_link():
    card = "<a href=x><h3>Teaser</h3><p>" + LONG * 3 + "</p></a>"
    page = f"<body>{card * 4}{paragraphs(story())}{card * 4}</body>"
    got = H.main_text(page).split("\n\n")
    assert [x for x in got if x[-1].isdigit()] == text(story()).split("\n\n") and len(got) <= 6


def test_deep_and_unbalanced_markup_takes_linear_time():
    for html in ("<div>" * 30_000 + "x", "<b><a>" * 30_000 + "x", "<p><b>" * 30_000 + "x", "</div></p>" * 30_000 + "x",
                 "<b>" * 3_000 + "<li>x" * 3_000, "<table><tr><td>" * 10_000 + "x"):
        assert H.main_text("<article>" + html)[-1] == "x"


@pytest.mark.parametrize("after", [
    "<div id=comments><article class=comment><p>Reader one.</p></article><article><p>Reader two.</p></article></div>",
    "<article class='comment'><p>Reader one.</p></article><article class=teaser><h3>Next</h3><p>Teaser.</p></article>",
    "<aside><article><h3>Next</h3><p>Teaser.</p></article></aside>",
    "<article><h3>Next</h3><p>Teaser.</p></article><article><p>Other.</p></article>",
    "<article id=related role=complementary><p>Teaser.</p></article>"])
def test_main_text_outside_of_article_elements(after):
    assert H.main_text(f"<body><div class=post>{paragraphs(story())}</div>{after}</body>") == text(story())
    assert H.main_text(f"<body><article class=post>{paragraphs(story())}</article>{after.replace('<article>', '<div>').replace('</article>', '</div>')}</body>") == text(story())


def test_article_in_boilerplate():
    body = paragraphs(story())
    assert H.main_text(f"<body><section><div class=ad>Ad<div>More</div><article>{body}</article></section>") == text(story())
    assert H.main_text(f"<body><div class=ad>Ad<article><p>Buy</p></article></div><div>{body}</div>") == text(story())
    assert H.main_text(f"<section><article class=ad>Ad<article>{body}</article></section><p>About") == text(story())
    assert H.main_text(f"<body><article>{body}</article><article><p>Part two.</p></article>") == text([*story(), "Part two."])


@pytest.mark.parametrize("page", ["<article>{}</article>", "<body>{}</body>"])
@pytest.mark.parametrize("part,lines", [
    ("<section id='related-work'><h2>Related work</h2><p>They did it.</p></section>", ["Related work", "They did it."]),
    ("<h2 id='search-algorithms'>Search</h2><h2 id='comments-on-the-treaty'>Comments</h2>", ["Search", "Comments"]),
    ("<h2 id=search>Search</h2>", ["Search"]), ("<div id='ad-hoc-methods'>Methods</div>", ["Methods"]),
    ("<p data-id=ads data-class='x share'>Kept</p>", ["Kept"]), ("<div class='elementor-widget'><p>Inside</p></div>", ["Inside"]),
    ("<div class='related-posts'>R</div><div class='site_footer'>F</div><div class='x ad-container-728x90'>A</div>", []),
    ("<ul class='comment-list'><li>C</ul><div id=cookie-banner>B</div><div class='share-buttons'>S</div>", []),
    ("<div class=related>R</div><div id=social>S</div><div role=note>N</div><p class=widget>W</p>", [])])
def test_names_of_areas(page, part, lines):
    body = paragraphs(story(2))
    assert H.main_text(page.format(body + part + body)) == text([*story(2), *lines, *story(2)])


@pytest.mark.parametrize("name", ["class='elementor-widget'", "class='left-sidebar-layout'", "class=widget", "class='x left-sidebar'", "id=main-menu",
                                  "role=note", "id=comments", "class='tag-ads category-promo'"])
def test_area_with_most_of_the_text_stays(name):
    assert H.main_text(f"<body><div {name}>{paragraphs(story())}</div></body>") == text(story())
    assert H.main_text(f"<body><article {name}>{paragraphs(story())}</article></body>") == text(story())


def test_long_comments_go():
    page = f"<body><div>{paragraphs(story(2))}</div><div id=comments>{paragraphs(['Reader: ' + LONG] * 9)}</div></body>"
    assert H.main_text(page) == text(story(2))


@pytest.mark.parametrize("html,lines", [
    ('<p class="a"">Hello world</p>', ["Hello world"]),
    ("<p title=it's>Second para</p><p>Third isn't</p>", ["Second para", "Third isn't"]),
    ("<p title=\"a > b\" lang='x>y'>One</p>", ["One"]), ("<p a = 'x' b= \"y>\" c>One</p>", ["One"]),
    ('<p title="never closed>One</p><p>Two</p>', ["One", "Two"]), ("<p 'x\">One</p>", ["One"]),
    ('<p title="class=ad role=note hidden">One</p>', ["One"]), ("<p data-class=ad>One</p><p class = \"ad\">No</p>", ["One"]),
    ("<p>Let <math>x</math> be <math><mi>y</mi><annotation>\\y</annotation></math>.</p>", ["Let x be y."]),
    ("<p>One</p><noscript><p>Two</p></noscript>", ["One", "Two"])])
@pytest.mark.parametrize("page", ["<article>{}</article>", "<body>{}</body>"])
def test_attributes_and_inline_elements(page, html, lines):
    assert H.main_text(page.format(html)) == text(lines)


def test_quotes_in_long_tags_take_linear_time():
    begin = time.monotonic()
    for part in ("'", '"', "=", "='", '="', "a=' "):
        assert H.main_text("<article><p " + part * 60_000 + ">One</p><p>Two</p></article>").endswith("Two")
    assert time.monotonic() - begin < 30


def test_outer_text_longer_than_the_marked_area_wins():
    body = paragraphs(story())
    assert H.main_text(f"<body><article><p>Short teaser.</p></article>{MENU}{body}</body>").endswith(text(story()))
    assert H.main_text(f"<body>{paragraphs(story(1))}{MENU}<article>{body}</article></body>") == text(story())
