"""The given pages against Python's HTML parser: the text within article, without areas of adverts."""

import os
from html.parser import HTMLParser

import pytest
from tripmart.llm.common import table
from tripmart.llm.registry import op10_html_extraction

GIVEN = "/root/testdata/sf0.01"


class Plain(HTMLParser):
    """Text of the article, a block for each h1 and p (br is a space)."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.inside = self.out = 0
        self.blocks = [""]

    def handle_starttag(self, tag, attrs):
        if tag == "article":
            self.inside += 1
        elif self.inside and (self.out or tag in ("nav", "aside", "form") or dict(attrs).get("class") == "ad"):
            self.out += tag not in ("br", "p", "img", "input", "hr")
        elif tag == "br":
            self.blocks[-1] += " "
        if tag in ("p", "h1", "h2", "h3", "li", "div", "article"):
            self.blocks.append("")

    def handle_endtag(self, tag):
        if tag == "article":
            self.inside -= 1
        elif self.out and tag not in ("br", "p"):
            self.out -= 1
        if tag in ("p", "h1", "h2", "h3", "li", "div", "article"):
            self.blocks.append("")

    def handle_data(self, data):
        if self.inside and not self.out:
            self.blocks[-1] += data


@pytest.mark.skipif(not os.path.exists(f"{GIVEN}/pages.parquet"), reason="no given tables")
def test_all_given_pages(spark):
    html = {r.page_id: r.html for r in table(spark, GIVEN, "pages").collect()}
    got = op10_html_extraction(spark, GIVEN).collect()
    assert len(got) == len(html)
    for r in got:
        plain = Plain()
        plain.feed(html[r.page_id] or "")
        plain.close()
        assert r.text == "\n\n".join(x for x in (" ".join(b.split()) for b in plain.blocks) if x), r.page_id
