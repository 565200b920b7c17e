"""Blocks and zones of pages, beside an independent reader for well-formed pages."""

import random
import time
from html.parser import HTMLParser

import pytest

from lapwright.llm.page_blocks import CHROME_ZONE, LAYOUT, MARKS, read_blocks

KEPT = {
    # Names count as a whole.
    '<div class="layout has-sidebar"><article>x y</article></div>': "x y",
    '<article class="post category-search-engines">x</article>': "x",
    '<article>a<section id="related-work">b</section><div class="market-share-chart">c</div><h2 id="reply">d</h2></article>': "a b c d",
    "<body class='search'><p>a<div class='ad-slot'>b</div>": "a",
    # A hint gives way to the only article and to most of the text.
    "<div class='sidebar'><p>intro</p><article>m n</article></div>": "intro m n",
    "<form id=f><article>x</article></form>": "x",
    "<nav>m</nav><div class='search'><p>w1 w2 w3</div><p>o": "w1 w2 w3 o",
    "<article>a b c d</article><section id=comments><article>r</article></section>": "a b c d",
    "<article>a b<div class='comment-list'>c d e f g</div></article>": "a b",
    "<article>a b<div class='share'>c d e f g</div></article>": "a b c d e f g",
    # Chrome without an end of its own.
    "<nav>Menu<article>Text</article>": "Text",
    "<nav>Menu<article>Text</article></nav><p>more": "more",
    # Elements whose end may be missing, and inline ones.
    "<article>a b c d e<p class='advert'>Buy now</p>z</article>": "a b c d e z",
    "<article>a b c d e<p class=ad>Buy<div>z</div></article>": "a b c d e z",
    "<article>a b c d<table><tr><td class='ad'>ad<td>k<tr class=ad><td>x<td>y<tr><td>l</table></article>": "a b c d k l",
    "<article>a b c<ul><li class=comment>c<ul><li>x</li></ul>y</li><li>k</ul></article>": "a b c k",
    "<article>a b c <span class=ad>no <span>no</span> no</span> d <a class='share'>s<a href=x>e</a></article>": "a b c d e",
    "<article>a b <span class=ad>Buy</p><p>next</article>": "a b next",
    "<article>a b c <a class=ad><p>x</p></a>d</article>": "a b c d",
    # Markup.
    "<p data-x=it's>hello</p>": "hello",
    "<a title='1>2'>x</a> <b class=\">\">y</b>": "x y",
    "<article>x <math><mi>y</mi></math></article>": "x y",
    "a < b <c": "a < b <c",
    "<a x='<b>q": "q",
    "<svg>t": "t",
    "x<!-- <p>": "x",
    "1 <!x": "1 <!x",
    "": "",
}


def _text(page):
    return " ".join(t for zone, tokens in read_blocks(page)[1] if zone != CHROME_ZONE for t in tokens)


@pytest.mark.parametrize("page", KEPT)
def test_what_is_kept(page):
    assert _text(page) == KEPT[page]


@pytest.mark.parametrize(
    "piece",
    ["<a ", "<div>", "</section>", "<a x='<b>", "<svg>", "<a =\"' >", "<!", "<nav>x", "<span class=ad>x", "<li class=comment>x<ul>",
     "<!--", "<script>", "=", "<div class=\"", "<form>w ", "</a", "&amp", "<p class=ad><b>"],
)
def test_time_is_linear(piece):
    page = "<i " * (piece == "=") + piece * (1_000_000 // len(piece))
    begin = time.process_time()
    read_blocks(page + "</section>" * 50_000)
    assert time.process_time() - begin < 10  # a quadratic reader takes hours


class _Plain(HTMLParser):
    """Text outside chrome of a well-formed page without hints."""

    def __init__(self):
        super().__init__()
        self.chrome, self.parts = [], []

    def handle_starttag(self, tag, attrs):
        name = dict(attrs).get("class") or ""
        words = name.replace("-", " ").split()
        marked = any(w in MARKS for w in words) and all(w in MARKS or w in LAYOUT for w in words)
        self.chrome.append(tag in ("nav", "header", "footer", "aside", "script", "style") or marked)
        self.parts.append(" " if tag not in ("b", "i", "a", "span") or marked else "")

    def handle_endtag(self, tag):
        marked = self.chrome.pop()
        self.parts.append(" " if tag not in ("b", "i", "a", "span") or marked else "")

    def handle_data(self, data):
        self.parts.append("" if any(self.chrome) else data)


def test_well_formed_pages_against_another_parser():
    r = random.Random(4)
    names = ["", "", " class='ad'", ' class="site-header"', " class=lead", " class='ad-hoc'", " title='a > b' class='share-links'", " data-class='ad'"]

    def some(depth):
        out = []
        for _ in range(r.randrange(1, 5)):
            out.append(r.choice(["w ", "x&amp;y ", "é\n", "1 < 2 ", "don't "]))
            if depth and r.random() < 0.7:
                tag = r.choice(["div", "section", "nav", "aside", "b", "i", "span", "footer", "blockquote", "script"])
                inner = "if (a<b) '<p>'" if tag == "script" else some(depth - 1)
                out.append(f"<{tag}{r.choice(names)}>{inner}</{tag}>")
        return "".join(out)

    for _ in range(400):
        # Enough words that no hint holds most of them.
        page = f"<article>{'v ' * 2000}{some(4)}</article><div>{some(3)}</div>"
        plain = _Plain()
        plain.feed(page)
        plain.close()
        assert _text(page) == " ".join("".join(plain.parts).split()), page
