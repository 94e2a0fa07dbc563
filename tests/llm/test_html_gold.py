"""Pages whose main text is known: an article in many wrappers, between many kinds of what is not the article."""

from __future__ import annotations

import itertools

import numpy as np
import pytest

from tillwatch.llm import html

TREE = html.grow(np.array(html.LABELLED, dtype=float))
PARAGRAPHS = ["The head line of it", "Many words of a longer text that goes on for a while and then ends here. " * 4, "A short one.", "More words of the same text, with some & signs, that go on for a while as well. " * 3]
TEXT = "\n\n".join(" ".join(p.split()) for p in PARAGRAPHS)
INNER = f"<h1>{PARAGRAPHS[0]}</h1>" + "".join(f"<p>{p.replace('&', '&amp;')}</p>" for p in PARAGRAPHS[1:])

WRAPPERS = {
    "article": "<article>{}</article>",
    "main": "<main>{}</main>",
    "role": '<div role="main">{}</div>',
    "itemprop": '<div itemprop="articleBody">{}</div>',
    "in a form": '<form action="/x"><article>{}</article></form>',
    "wrap of both": '<div class="content-sidebar-wrap"><main class="content">{}</main></div>',
    "search result": '<main><div class="entry search-result">{}</div></main>',
    "news tag": '<div class="post tags-news"><article>{}</article></div>',
    "news tag within": '<article><div class="post tags-news">{}</div></article>',
    "comments open": '<div class="comments-open"><article>{}</article></div>',
    "self-closed svg": '<article><svg width="10" height="10"/><svg/>{}</article>',
    "unclosed iframe": '<article><iframe src="x">{}</article>',
    "unclosed link": '<nav><a href="/">Home</nav><article>{}</article>',
    "plain": "<div>{}</div>",
}
AROUND = {
    "nothing": ("", ""),
    "menu and footer": ('<header><a href="/">Site</a></header><nav><ul><li><a href="/a">A</a><li><a href="/b">B</a></ul></nav>', "<footer><p>&copy; 2020 Somebody, all rights reserved by them</p></footer>"),
    "notices": ('<div class="cookie-notice">We use cookies on this site, as all the others do as well.</div><div id="newsletter-signup"><form>Your mail <input></form></div>', '<div class="ad-slot">Buy this now and here, it is good.</div>'),
    "sidebar and comments": ("", '<aside><p>Related: something else to read on this site</p></aside><section id="comments"><article class="comment"><p>Nice, I liked all of it very much, thank you for that.</p></article><article><p>So did I, from the first word to the last one.</p></article></section>'),
    "scripts": ("<script>var a = '<p>no</p>';</script><style>p { color: red }</style>", "<!-- <p>no</p> --><noscript>Please switch it on</noscript><template><p>no</p></template>"),
}


@pytest.mark.parametrize("wrapper,around", itertools.product(WRAPPERS, AROUND))
def test_gold(wrapper, around):
    before, behind = AROUND[around]
    if wrapper == "plain" and around != "menu and footer" and around != "nothing" and around != "scripts":
        pytest.skip("no article marked")
    page = f"<!doctype html><html><head><title>No</title></head><body>{before}{WRAPPERS[wrapper].format(INNER)}{behind}</body></html>"
    assert html.main_text(page, TREE) == TEXT


@pytest.mark.parametrize(
    "noise",
    ['<div class="post-comments"><p>{}</p></div>', '<div class="article-sidebar"><p>{}</p></div>', '<div class="ad">{}</div>', '<div class="entry-share">{}</div>', '<nav><p>{}</p></nav>', '<form><p>{}</p></form>', "<footer>{}</footer>",
     '<div hidden><article><p>{}</p></article></div>', '<aside><article><p>{}</p></article></aside>', '<div class="related-posts related"><p>{}</p></div>', '<div id="comments"><article><p>{}</p></article></div>', "<svg><text>{}</text></svg>"],
)
def test_noise_within_and_behind_an_article(noise):
    words = "Some words that are no part of the article but long enough to look like one of its paragraphs."
    if "form" not in noise and "article><p" not in noise:
        assert html.main_text(f"<article>{INNER}{noise.format(words)}</article>", TREE) == TEXT
    assert html.main_text(f"<main>{INNER}</main>{noise.format(words)}", TREE) == TEXT


def test_a_long_page_and_odd_markup():
    page = "<article>" + "<div>" * 5000 + "<p>word</p>" * 5000 + "</div>" * 5000 + "</article>"
    assert html.main_text(page, TREE) == "\n\n".join(["word"] * 5000)
    for page in ("<", "<a", "<svg", "<svg/", "<p/>x", "</p>" * 100, "<article", "<!--", "<form><article>"):
        assert isinstance(html.main_text(page, TREE), str)
