"""Main text of pages: the given ones against their article element, others by hand."""

import html
import re

import pytest

from millrace.llm.html_density import main_text, main_texts
from millrace.tables import load
from tests.llm.support import FOLDER


def article(page):
    inner = re.search(r"<article>(.*?)</article>", page, re.S)[1]
    inner = re.sub(r"<(?:p|/p|h1|/h1|br)>", " ", inner)
    return " ".join(html.unescape(re.sub(r"<[^>]+>", "", inner)).split())


def test_given_pages(spark):
    pages = load(spark, FOLDER, "pages")
    got = {r.page_id: r for r in main_texts(pages).collect()}
    for r in pages.collect():
        assert got[r.page_id].text == article(r.html) and got[r.page_id].n_chars == len(article(r.html))


LONG = "A sentence of the main text that is long enough, with a comma. " * 4
CASES = {
    "empty": ("", ""),
    "no markup": ("just &amp; text  here", "just & text here"),
    "unclosed": ("<body><p>one<p>two <b>three<p>four", "one two three four"),
    "scripts": (f"<p>{LONG}</p><script>if (a<b) x='<!-- <p>no</p>';</script><style>p{{}}</style><p>end</p>", f"{LONG}end"),
    "comment": (f"<p>{LONG}<!-- <p>no</p> > -->yes</p>", f"{LONG}yes"),
    "open comment": (f"<p>{LONG}</p><!-- <p>no", LONG),
    "parts": (
        f"<body><header><h1>Site</h1></header><nav><a>x</a></nav><main><h1>Title</h1><p>{LONG}</p><section><h2>Sub</h2>"
        f"<p>foo <a href=x>link</a> b<i>a</i>r</p></section></main><aside>{LONG * 9}</aside>"
        f"<div id='comments'><p>{LONG * 9}</p></div><form>{LONG}<select><option>o</select></form><footer>f</footer>",
        f"Title {LONG}Sub foo link bar",
    ),
    "loose": (
        f"<body><div class='top-menu'><a>1</a></div><div class=post><p>{LONG}</p><p>{LONG}</p><ul><li>a<li>b</ul></div>"
        "<div><ul><li><a>l1 l1</a><li><a>l2 l2</a><li><a>l3 l3</a></ul></div>",
        f"{LONG}{LONG}a b",
    ),
    "hidden": (f"<article><p>{LONG}</p><p hidden>no</p><p style='display: none'>no</p><div role=alert>no</div><p>x</p></article>", f"{LONG}x"),
    "references": ("<p>&lt;b&gt; &eacute;&#233;&#xe9; a&nbsp;b &unknown; &copy</p>", "<b> ééé a b &unknown; ©"),
    "attributes": (f'<p title="a > b" data-x=\'<p>\'>{LONG}</p>', LONG),
    "table": ("<article><table><tr><td>a<td>b<tr><td>c</table><p>d<br>e</article>", "a b c d e"),
    "only cut": ("<body><nav>menu</nav><div class='ad'>buy</div></body>", ""),
}

LINKED = "<li><a href=1>first linked name</a><li><a href=2>second linked name</a><li><a href=3>third linked name</a>"
KEPT = {
    "wrapper fragments": f"<body><div class='content-sidebar-wrap'><article><p>{LONG}</p></article></div></body>",
    "wrapper token": f"<body class='x'><div class='sidebar right'><main><p>{LONG}</p></main></div><div class='widget'>no</div></body>",
    "most of the text": f"<body><div id='social'><p>{LONG}</p></div><div class='widget'>no</div></body>",
    "inside the article": f"<body><article><div class='comment'><p>{LONG}</p></div></article></body>",
    "form around the page": f"<body><form id='f'><article><p>{LONG}</p></article><div class='comments'><p>no</p></div></form></body>",
    "not a teaser": f"<body><div class='header'><p>{LONG * 30}</p></div><div><article>no</article></div></body>",
}


@pytest.mark.parametrize("name", KEPT)
def test_no_class_cuts_the_main_text(name):
    text = main_text(KEPT[name])
    assert LONG.strip() in text and "no" not in text.split()


def test_articles_keep_headlines_and_lists():
    page = f"<body><article><header class='header'><h1>Headline</h1></header><p>{LONG}</p><ul>{LINKED}</ul></article></body>"
    assert main_text(page) == f"Headline {LONG}first linked name second linked name third linked name"
    # Comments stay out, though they are articles too.
    assert main_text(f"<main><article><p>{LONG}</p></article><div id=comments><article><p>I agree.</p></article></div></main>") == LONG.strip()


@pytest.mark.parametrize("name", CASES)
def test_pages_by_hand(name):
    page, expected = CASES[name]
    assert main_text(page) == expected.strip()


def test_awkward_pages(spark):
    rows = [(1, "u", None), (1, "u", None), (None, None, ""), (3, None, "<" * 3000), (4, "v", "<div>" * 4000 + "deep"), (5, "w", "<a \"" * 500), (6, "w", "<p>" + "x " * 200_000)]
    pages = spark.createDataFrame([(*r, "extra", 1) for r in rows], "page_id bigint, url string, html string, text string, n_chars int")
    got = main_texts(pages).collect()
    assert [(r.page_id, r.url) for r in got] == [r[:2] for r in rows]
    assert [r.n_chars for r in got][:3] == [0, 0, 0] and got[4].text == "deep" and got[6].n_chars == 399_999
    assert main_texts(pages.limit(0)).count() == 0
