"""Main text of web pages by composite text density.

A page is read into a tree of its block elements. Menus, page headers and
footers, sidebars, forms, scripts and the like are cut by their tag, role or
class. A class, an id or a form element does not cut what holds the longest
article or main element of the page, or most of the unlinked text in it (in the
body, if there is none worth the name). Each remaining node has characters C, characters in links LC, tags
T and link tags LT below it, and the composite density

    C/T * log(C*T / (LC*LT)) / log(ln(LC*C/(C-LC) + C*LC_body/C_body + e))

so that text in links counts against a node. The densities of a node's
children are added up; the node with the largest sum is the core of the main
text, and it is widened to its parents as long as these are at least as dense as
the body, or up to the article or main element around it. Blocks of links
outside articles are left out.

Defined results: a null or empty page, or one without text outside the cut
parts, gives the empty text with 0 characters. Broken markup is read as browsers
do in the common cases: an unclosed paragraph, list item or cell ends where the
next one starts, other open elements end with their parents, unknown end tags
are ignored, an unclosed comment or script runs to the end. Of equal sums the
first node counts. Repeated pages give repeated rows; an empty table none.
"""

from __future__ import annotations

import html
import math
import re
from collections.abc import Iterable

import pyarrow as pa
from pyspark.sql import DataFrame

from millrace.llm.common import map_batches

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*+(?:>|\Z)"
    r"|<(/?)([a-zA-Z][^\s/>]*+)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+>|[^>]*+(?:>|\Z))",
    re.S,
)
_ATTRIBUTE = re.compile(r"([^\s=\"'>/]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")

# Element names of the HTML standard.
RAW = frozenset("script style textarea title noscript iframe noembed noframes xmp template svg math object".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCK = frozenset(
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 header hgroup html head li main menu nav ol p pre section summary table tbody td tfoot th thead tr "
    "ul caption select button audio video canvas search".split()
)
CUT_TAGS = frozenset("nav aside footer form head select button dialog menu audio video canvas search".split())
CUT_ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar".split())
CUT_WORDS = frozenset(
    "ad ads advert adverts advertisement advertising sponsor sponsored sponsors promo promotion banner cookie cookies "
    "consent gdpr notice notices alert popup modal overlay nav navbar navigation menu menus breadcrumb breadcrumbs "
    "sidebar sidebars aside widget widgets header masthead footer comment comments commentlist respond replies disqus "
    "share sharing social related recommended newsletter subscribe subscription signup login pagination pager toolbar "
    "copyright skip".split()
)
#: What starting one of these ends, up to the element that holds them.
ENDS = {
    "li": ("li", "ul ol menu"),
    "dt": ("dt dd", "dl"),
    "dd": ("dt dd", "dl"),
    "tr": ("tr td th", "table"),
    "td": ("td th", "tr table"),
    "th": ("td th", "tr table"),
    "tbody": ("thead tbody tfoot tr td th", "table"),
    "thead": ("thead tbody tfoot tr td th", "table"),
    "tfoot": ("thead tbody tfoot tr td th", "table"),
}
_RAW_END = {tag: re.compile(rf"</{tag}(?:[\s/][^>]*+)?(?:>|\Z)", re.I) for tag in RAW}
CLOSES_P = BLOCK - {"button", "caption", "body", "html", "head", "td", "th", "tr", "tbody", "thead", "tfoot", "select", "audio", "video", "canvas"}
LINK_SHARE = 0.6
LEAST_LINKS = 3
#: An article with less than this share of the body's unlinked text is a teaser.
LEAST_ARTICLE = 0.05
#: Reasons for a cut: by class, id or form, which the text below can outweigh, and by anything else.
SOFT, HARD = 1, 2


class Node:
    """A block element; numbers count what is below it and not cut."""

    __slots__ = ("tag", "parent", "cut", "stop", "chars", "link_chars", "tags", "links", "children", "article")

    def __init__(self, tag: str, parent: int, cut: int, article: bool) -> None:
        self.tag, self.parent, self.cut, self.article = tag, parent, cut, article
        self.stop = self.chars = self.link_chars = self.tags = self.links = 0
        self.children: list[int] = []


def _cut(tag: str, rest: str, article: bool) -> int:
    """Whether an element is to be cut, and by which kind of reason; 0 is no."""
    if (tag in CUT_TAGS and tag != "form") or (tag == "header" and not article):
        return HARD
    cut = SOFT if tag == "form" else 0
    if tag in ("html", "body", "article", "main") or len(rest) < 4:
        return cut
    for name, *values in _ATTRIBUTE.findall(rest):
        name, value = name.lower(), "".join(values).lower()
        if name == "hidden" or (name == "aria-hidden" and value == "true"):
            return HARD
        if name == "role" and value in CUT_ROLES:
            return HARD
        if name == "style" and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value):
            return HARD
        if name in ("class", "id") and tag != "header" and not CUT_WORDS.isdisjoint(value.split()):
            cut = SOFT
    return cut


def _settle_cuts(nodes: list[Node]) -> None:
    """Spare what holds the main text, hand cuts down, and take what is cut out of the numbers."""
    plain = [n.chars - n.link_chars for n in nodes]
    hard = [False] * len(nodes)
    for k in range(1, len(nodes)):
        hard[k] = nodes[k].cut == HARD or hard[nodes[k].parent]
    for k in range(len(nodes) - 1, 0, -1):
        plain[nodes[k].parent] += plain[k]
    body = next((k for k, n in enumerate(nodes) if n.tag == "body"), 0)
    region, spared = body, {body}
    for tag in ("main", "article"):
        found = [k for k, n in enumerate(nodes) if n.tag == tag and not hard[k] and plain[k] > LEAST_ARTICLE * plain[body]]
        if found:
            at = region = max(found, key=lambda k: (plain[k], -k))
            while at > 0:
                spared.add(at)
                at = nodes[at].parent
    for k in range(1, len(nodes)):
        n = nodes[k]
        if n.cut == SOFT and (k in spared or (region < k < nodes[region].stop and 2 * plain[k] > plain[region])):
            n.cut = 0
        n.cut = n.cut or nodes[n.parent].cut
        if n.cut:
            n.chars = n.link_chars = n.tags = n.links = 0


def read_page(page: str) -> tuple[list[Node], list[tuple[int, str]]]:
    """The block nodes in page order, and the texts with the number of their node; a space stands for each block's edge."""
    nodes = [Node("", -1, 0, False)]
    texts: list[tuple[int, str]] = []
    open_tags: list[tuple[str, int, bool]] = [("", 0, False)]  # name, node, whether inside a link
    counts: dict[str, int] = {}

    def close() -> None:
        tag, node, _ = open_tags.pop()
        counts[tag] -= 1
        if tag in BLOCK:
            nodes[node].stop = len(nodes)
            texts.append((nodes[node].parent, " "))

    def close_to(names: tuple[str, ...] | list[str], bounds: list[str]) -> None:
        """End the nearest open element of these names, and what is open in it, unless a bound is met first."""
        if not any(counts.get(n) for n in names):
            return
        for k in range(len(open_tags) - 1, 0, -1):
            if open_tags[k][0] in names:
                while len(open_tags) > k:
                    close()
                return close_to(names, bounds) if len(names) > 1 else None
            if open_tags[k][0] in bounds:
                return None
        return None

    def add(text: str) -> None:
        if not text:
            return
        _, at, linked = open_tags[-1]
        text = html.unescape(text)
        texts.append((at, text))
        node = nodes[at]
        n = len(" ".join(text.split()))
        node.chars += n
        node.link_chars += n if linked else 0

    place = 0
    while m := _TOKEN.search(page, place):  # not finditer: what a script holds is no markup
        add(page[place : m.start()])
        place = m.end()
        if not m[2]:
            if page.startswith("<![CDATA[", m.start()):
                add(page[m.start() + 9 : m.end() - 3])
            continue
        tag = m[2].lower()
        if m[1]:
            if tag == "br":
                texts.append((open_tags[-1][1], " "))
            elif counts.get(tag):
                # An inline end tag does not reach out of its block.
                close_to([tag], [] if tag in BLOCK else sorted(BLOCK))
            continue
        if tag in RAW:
            if not m[3].endswith("/>"):
                end = _RAW_END[tag].search(page, place)
                place = end.end() if end else len(page)
            continue
        at = open_tags[-1][1]
        if tag in VOID:
            nodes[at].tags += 1
            if tag in ("br", "hr"):
                texts.append((at, " "))
            continue
        if tag in CLOSES_P and counts.get("p"):
            close_to(["p"], ["button", "table", "caption", "td", "th"])
        if tag in ENDS:
            names, bounds = ENDS[tag]
            close_to(names.split(), bounds.split())
        _, at, linked = open_tags[-1]
        parent = nodes[at]
        if tag in BLOCK:
            texts.append((at, " "))
            article = parent.article or tag in ("article", "main")
            nodes.append(Node(tag, at, _cut(tag, m[3], parent.article), article))
            nodes[-1].tags = 1
            at = len(nodes) - 1
            parent.children.append(at)
        else:
            parent.tags += 1
            if tag == "a":
                parent.links += 1
        linked = linked or tag == "a"
        open_tags.append((tag, at, linked))
        counts[tag] = counts.get(tag, 0) + 1
    if place < len(page):
        add(page[place:])
    while len(open_tags) > 1:
        close()
    nodes[0].stop = len(nodes)
    _settle_cuts(nodes)
    return nodes, texts


def densities(nodes: list[Node], body: int) -> list[float]:
    """The composite density of each node."""
    root = nodes[body]
    share = root.link_chars / max(1, root.chars)
    out = []
    for n in nodes:
        c, lc, t, lt = n.chars, n.link_chars, max(1, n.tags), max(1, n.links)
        if not c or n.cut:
            out.append(0.0)
            continue
        base = math.log(lc * c / max(1, c - lc) + c * share + math.e)
        out.append(c / t * max(0.0, math.log(max(1.0, c * t / (max(1, lc) * lt))) / math.log(max(base, 1.0001))) if base > 1 else c / t)
    return out


def main_text(page: str | None) -> str:
    """The main text of a page, blocks in order, parted by one space."""
    if not page:
        return ""
    nodes, texts = read_page(page)
    for k in range(len(nodes) - 1, 0, -1):
        n, up = nodes[k], nodes[nodes[k].parent]
        if not n.cut:
            up.chars += n.chars
            up.link_chars += n.link_chars
            up.tags += n.tags
            up.links += n.links
    body = next((k for k, n in enumerate(nodes) if n.tag == "body"), 0)
    if not nodes[body].chars:
        body = 0
    dense = densities(nodes, body)
    sums = [sum(dense[c] for c in n.children) for n in nodes]
    best = max(range(body, nodes[body].stop), key=lambda k: (sums[k], -k))
    if not sums[best]:
        best = body
    top = best
    while top != body and nodes[top].parent >= body:
        up = nodes[top].parent
        inside = nodes[top].article and nodes[top].tag not in ("article", "main")
        if not inside and (up == body or dense[up] < dense[body]):
            break
        top = up
    # A text cut into several articles, or loose in the body, is not one subtree: then take the body without what is cut.
    if nodes[top].chars < 0.5 * nodes[body].chars and not nodes[top].article:
        top = body
    dropped = [False] * len(nodes)
    for k in range(top, nodes[top].stop):
        n = nodes[k]
        links = k != top and not n.article and n.tag in ("ul", "ol", "div", "section", "table", "dl", "p") and n.links >= LEAST_LINKS
        dropped[k] = bool(n.cut) or (k != top and dropped[n.parent]) or (links and n.link_chars > LINK_SHARE * n.chars)
    stop = nodes[top].stop
    return " ".join("".join(t for k, t in texts if top <= k < stop and not dropped[k]).split())


def main_texts(pages: DataFrame) -> DataFrame:
    """page_id, url, text and n_chars for every row of ``pages``."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterable[pa.RecordBatch]:
        for batch in batches:
            found = [main_text(p.as_py()) for p in batch.column("html")]
            yield pa.RecordBatch.from_arrays(
                [batch.column("page_id"), batch.column("url"), pa.array(found, pa.string()), pa.array(map(len, found), pa.int64())],
                names=["page_id", "url", "text", "n_chars"],
            )

    return map_batches(pages.select("page_id", "url", "html"), run, "page_id bigint, url string, text string, n_chars bigint")
