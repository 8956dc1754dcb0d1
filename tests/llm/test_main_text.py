"""Main text: exact texts of made pages, wrappers, and edges."""

from __future__ import annotations

import pytest

from launchtide.llm.main_text import (
    Shape,
    Tree,
    align,
    extract_main_text,
    learn,
    main_text,
    parse,
    unwrap,
)

SCHEMA = "page_id bigint, url string, html string, text string, host string"

PAGE = """<!DOCTYPE html><html lang="en"><head><meta charset="utf-8"><title>No &amp; title</title>
<style>p{margin:0}</style><script>var t="</p><article>";track(1);</script></head>
<body class="has-sidebar"><header><h1>Site name</h1></header><div class="cookie-notice">Cookies!</div>
<nav><ul><li><a href="/a">A</a></li></ul></nav><!-- ad <article> --><div class="ad">Buy</div>
<article><header><h1>Title %(k)s</h1></header><p><b>First &lt;%(k)s&gt;&nbsp;caf&eacute;
 bold<br><p>Second <a href=x>link</a>&#33; <span class="ad">Buy</span>end</p>
<ul><li>one<li>two <i>in</i>line</ul><div class="share-buttons">Share</div>
<table><tr><td>a<td>b</table><blockquote>Quote</blockquote><aside>Aside</aside>
<form><p>Name <input name=q></form><p hidden>Hidden</p><p style="display: none">Gone</p></article>
<section id="comments"><article class="comment"><p>Nice post</p></article></section>
<footer>&copy; site</footer></body></html>"""
TEXT = "Title %(k)s\nFirst <%(k)s> café bold\nSecond link! end\none\ntwo inline\na\nb\nQuote"


def test_a_page_with_an_article():
    assert main_text(parse(PAGE % {"k": 1})) == TEXT % {"k": 1}
    cut = (PAGE % {"k": 2}).replace("</body></html>", "")
    assert main_text(parse(cut)) == TEXT % {"k": 2}


@pytest.mark.parametrize(
    "html, text",
    [
        ("", ""),
        ("plain  text", "plain text"),
        ("<p>a<p>b", "a\nb"),
        ("<main><h2>x</h2>y</main><p>z", "x\ny"),
        ("<article>one</article><article>two</article>", "one\ntwo"),
        ("a < b <unknown>c</unknown> <!-- open", "a < b\nc"),
        ("<script>never closed", ""),
        ("<p>1<!-- c -->2</p>", "12"),
        ("<div class='with-sidebar'>kept</div><div id='left-sidebar'>gone</div>", "kept"),
        ("<article><p>&bogus; &amp;amp; &#x41;</p></article>", "&bogus; &amp; A"),
        ("<div>" * 3000 + "deep" + "</div>" * 3000, "deep"),
        ("<article><p>foo<wbr>bar<img src=x>baz<input>qux<br>end</p></article>", "foobarbazqux end"),
        ("<article><p>a</p><section id='privacy'><p>Privacy law.</p></section></article>", "a\nPrivacy law."),
        ("<article><div class='menu-of-the-day'>Soup</div><div class='menu-left'>Home</div></article>", "Soup"),
        ("<article><p>text</p><article><p>a comment</p></article><p>more</p></article>", "text\nmore"),
        ("<p>before</p><article data-u=/a/>inside</article><p>after</p>", "inside"),
        ("<article>a<div/>b</div><svg/>c</article>", "a\nb\nc"),
        ("<p " * 2000 + "x", "<p " * 1999 + "<p x"),
    ],
)
def test_small_pages(html, text):
    assert main_text(parse(html)) == " ".join(text.split(" ")).strip()


@pytest.mark.parametrize("n", [50, 96, 97, 98, 99, 100, 150, 3000])
def test_text_around_deep_parts_keeps_its_place(n):
    deep = "<div>" * n + "<p>in <b>side</b> it</p><nav>menu <div>more menu</div></nav>x" + "</div>" * n
    page = f"<div><article><p>before</p>{deep}<p>after <font>it</article><p>outside</div>"
    assert main_text(parse(page)) == "before\nin side it\nx\nafter it"
    page = "<div>" * n + "<div>y<article><p>a</p>b<div>c</div>d</article>z</div>"
    assert main_text(parse(page)) == "a\nb\nc\nd"
    page = "<article>" + "<font>" * n + "<p>a</p><p>b</article><p>outside"
    assert main_text(parse(page)) == "a\nb"


def simple_tree_matching(a, b):
    if a.node.label != b.node.label:
        return 0
    m = [[0] * (len(b.children) + 1) for _ in range(len(a.children) + 1)]
    for i, x in enumerate(a.children):
        for j, y in enumerate(b.children):
            m[i + 1][j + 1] = max(m[i][j + 1], m[i + 1][j], m[i][j] + simple_tree_matching(x, y))
    return 1 + m[-1][-1]


def test_matching_is_simple_tree_matching():
    pages = [
        PAGE % {"k": 1},
        "<div><p>a</p><ul><li>b</ul></div>",
        "<div><p>a</p><p>c</p><ul><li>b<li>d</ul></div><div><p>x</div>",
        "<section><div><p>q</div></section><div><ul><li>b</ul><p>a</div>",
    ]
    for one in pages:
        for two in pages:
            shape = Shape()
            a, b = Tree(parse(one), shape), Tree(parse(two), shape)
            assert shape.score(a.shape, b.shape) == simple_tree_matching(a, b)
            pairs = list(align(a, b, shape))
            assert all(x.node.label == y.node.label for x, y in pairs)
            assert len({id(x) for x, _ in pairs}) == len(pairs) == len({id(y) for _, y in pairs})


BARE = "<div id=top>Welcome to our site</div><div class=x><h1>T {k}</h1><p>Body text {k}.</p></div><div><a href=1>Home</a> <a href=2>About</a></div><div>All rights kept.</div>"


def test_constant_texts_of_a_host_are_template():
    pages = [BARE.format(k=k) for k in "abc"]
    wrapper = learn(pages)
    for k, page in zip("abc", pages, strict=True):
        root = parse(page)
        unwrap(root, wrapper)
        assert main_text(root) == f"T {k}\nBody text {k}."
    assert learn(["<article><p>same</p></article>" + f"<p>{k}</p>" for k in range(5)]) is None


def test_query_forms_and_edges(spark):
    rows = [(k, f"http://a.example/{k}", BARE.format(k=k), "x", "y") for k in range(20)]
    rows += [(100 + k, "https://user@B.example:80/p?q", PAGE % {"k": 7}, "x", "y") for k in range(30)]
    rows += [(200, None, None, "x", "y"), (201, "", "", "x", "y"), (None, "no url", "<p>x", "x", "y"), (203, "ftp://c.example", "<p>" + "long " * 100_000, "x", "y")]
    rows += [(204, "http://d.example", "<p>dup", "x", "y")] * 2
    pages = spark.createDataFrame(rows, SCHEMA).repartition(3)
    found = extract_main_text(pages).collect()
    assert len(found) == len(rows) and found[0].__fields__ == ["page_id", "url", "text", "n_chars"]
    texts = {r.page_id: r.text for r in found}
    assert all(texts[k] == f"T {k}\nBody text {k}." for k in range(20))
    assert all(texts[100 + k] == TEXT % {"k": 7} for k in range(30))
    assert texts[200] == texts[201] == "" and texts[None] == "x" and texts[204] == "dup"
    assert len(texts[203]) == 499_999
    assert all(r.n_chars == len(r.text) for r in found)
    assert extract_main_text(pages.limit(0)).count() == 0


OTHER = "<section class=hello><div class=t>Shop of things</div></section><section class=b><p>Goods {k}.</p></section><section class=end>Call us.</section>"


def test_empty_pages_and_second_layouts_leave_the_template(spark):
    rows = [(k, f"http://a.example/{k}", BARE.format(k=k)) for k in range(6)]
    rows += [(10, "http://a.example/e", ""), (11, "http://a.example/s", "<p>stub"), (12, "http://a.example/n", None)]
    rows += [(100 + k, f"http://b.example/{k}", (BARE if k % 2 else OTHER).format(k=k)) for k in range(40)]
    rows += [(200 + k, f"http://c.example/{k}", f"<div>{'Rare' if k % 5 == 0 else 'Common'} words</div><p>Page {k}.</p>") for k in range(60)]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string").repartition(3)
    texts = {r.page_id: r.text for r in extract_main_text(pages).collect()}
    assert len(texts) == len(rows)
    assert all(texts[k] == f"T {k}\nBody text {k}." for k in range(6))
    assert (texts[10], texts[11], texts[12]) == ("", "stub", "")
    assert all(texts[100 + k] == (f"T {k}\nBody text {k}." if k % 2 else f"Goods {k}.") for k in range(40))
    # Four fifths are not nearly all.
    assert all(texts[200 + k].endswith(f"words\nPage {k}.") for k in range(60))
    assert learn(["", *(BARE.format(k=k) for k in "abc")]) == learn([BARE.format(k=k) for k in "abc"])
