"""Main text of web pages by composite text density.

Every DOM node has a density: its characters per tag, adjusted by the share of
them inside links.  A node's density sum adds up its children's densities; the
node with the largest sum is the main block.  The smallest density on the path
from it to body is the threshold by which other parts of the page may join: the
subtrees beside the path, single paragraphs and headings too, and the runs of
text that a node of the path holds directly, unless half of a part is links.
A heading is short, so it joins with the part that it stands before.
Parts whose tag, role, class or id says menu, advert, form, notice or comments
are taken out before densities are computed.

Cases: null html is an empty page; a page without body or of plain text gives its
text; unclosed and stray tags are tolerated; nothing is cut, whatever the length.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hirelens.llm.common import with_columns_last

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Start tags that end an open paragraph, and hold blocks of text of their own.
BLOCK = frozenset("""address article aside blockquote body caption center dd details dialog div dl dt fieldset figcaption figure footer
form h1 h2 h3 h4 h5 h6 header hr html legend li main menu nav ol option p pre section summary table tbody td tfoot th thead title tr ul""".split())
#: A start tag ends an open element of these names, up to the given ancestors.
CLOSES = {"li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}), "tr": ({"tr"}, {"table"}),
          "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}), "option": ({"option"}, {"select"})}
NOT_TEXT = frozenset("""head script style noscript template iframe object embed svg math canvas audio video nav aside footer form button
select textarea input dialog menu""".split())
NOT_ROLES = frozenset("navigation banner contentinfo complementary search dialog alert alertdialog menu menubar form".split())
#: Words of a class or id that mark a part as no part of the article.
NOT_CLASSES = frozenset("""ad ads adv advert adverts advertisement advertising sponsor sponsored sponsors promo promos promotion banner banners
nav navbar navigation menu menus breadcrumb breadcrumbs sidebar sidebars side widget widgets footer footers footnav masthead topbar
cookie cookies consent gdpr notice notices alert popup modal overlay newsletter subscribe subscription signup login search share sharing social
comment comments commentlist respond reply replies disqus discussion related recommended recommendations pagination pager skip toolbar""".split())
HEADERS = frozenset({"header", "hgroup"})
HEADINGS = frozenset({"h1", "h2", "h3", "h4", "h5", "h6"})
ARTICLE = frozenset({"article", "main"})
SPLIT = re.compile(r"[^a-z0-9]+")


class Node:
    __slots__ = ("tag", "parts", "parent", "drop", "chars", "tags", "link_chars", "link_tags", "density", "total")

    def __init__(self, tag: str, parent: Node | None, drop: bool = False):
        self.tag, self.parent, self.drop, self.parts = tag, parent, drop, []

    def children(self) -> list[Node]:
        return [p for p in self.parts if isinstance(p, Node) and not p.drop]


def is_boilerplate(tag: str, attrs: dict[str, str | None], in_article: bool) -> bool:
    if tag in NOT_TEXT or (tag in HEADERS and not in_article) or "hidden" in attrs or attrs.get("aria-hidden") == "true":
        return True
    if (attrs.get("role") or "").lower() in NOT_ROLES:
        return True
    if tag in ("html", "body", "article", "main", "a"):
        return False
    words = SPLIT.split(f"{attrs.get('class') or ''} {attrs.get('id') or ''}".lower())
    return not NOT_CLASSES.isdisjoint(words) or (not in_article and "header" in words)


class Tree(HTMLParser):
    """Builds the node tree; forgiving about what isn't closed."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.root = self.at = Node("html", None)
        self.depth_article = 0

    def updatepos(self, i, j):  # line numbers of tags are of no use here
        return j

    def handle_starttag(self, tag, attrs):
        if tag in ("html", "body"):
            return
        if tag in BLOCK:
            self.end({"p"}, BLOCK - {"p"})
        if tag in CLOSES:
            self.end(*CLOSES[tag])
        node = Node(tag, self.at, is_boilerplate(tag, dict(attrs), self.depth_article > 0))
        self.at.parts.append(node)
        if tag not in VOID:
            self.at = node
            self.depth_article += tag in ARTICLE

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if tag not in VOID and tag not in ("html", "body"):
            self.handle_endtag(tag)

    def end(self, names, until):
        node = self.at
        while node.parent is not None and node.tag not in until:
            if node.tag in names:
                return self.leave(node)
            node = node.parent

    def leave(self, node):
        while self.at is not node:
            self.depth_article -= self.at.tag in ARTICLE
            self.at = self.at.parent
        self.depth_article -= node.tag in ARTICLE
        self.at = node.parent

    def handle_endtag(self, tag):
        if tag not in ("html", "body"):
            self.end({tag}, () if tag in BLOCK else BLOCK - {tag})

    def handle_data(self, data):
        self.at.parts.append(data)


def in_order(root: Node) -> list[Node]:
    """Kept nodes, parents before children."""
    out, stack = [], [root]
    while stack:
        node = stack.pop()
        out.append(node)
        stack.extend(reversed(node.children()))
    return out


def density(chars: int, tags: int, link_chars: int, link_tags: int, linked: float) -> float:
    """Composite text density; ``linked`` is the share of the page's text inside links."""
    if not chars:
        return 0.0
    tags, links = max(1, tags), max(1, link_tags)
    base = math.log(chars / max(1, chars - link_chars) * link_chars + linked * chars + math.e)
    return chars / tags * max(0.0, math.log(max(1.0, chars / max(1, link_chars) * tags / links)) / base)


def letters(text: str) -> int:
    return len(text) - text.count(" ") - text.count("\n")


def measure(nodes: list[Node]) -> float:
    """Composite text density of every node, and the sum over its children; gives the linked share of the page."""
    for n in reversed(nodes):
        kids = n.children()
        own = sum(letters(p) for p in n.parts if isinstance(p, str))
        n.chars = own + sum(k.chars for k in kids)
        n.tags = sum(k.tags + 1 for k in kids)
        n.link_chars = n.chars if n.tag == "a" else sum(k.link_chars for k in kids)
        n.link_tags = sum(k.link_tags + (k.tag == "a") for k in kids)
    body = nodes[0]
    linked = body.link_chars / max(1, body.chars)
    for n in nodes:
        n.density = density(n.chars, n.tags, n.link_chars, n.link_tags, linked)
    for n in nodes:
        n.total = sum(k.density for k in n.children())
    return linked


def text_runs(node: Node) -> Iterator[list[int]]:
    """Positions in ``node.parts`` of its direct text with the inline elements in it, a list for each run between blocks."""
    run: list[int] = []
    for k, p in enumerate(node.parts):
        if isinstance(p, str) or (p.tag not in BLOCK and not p.drop and not any(c.tag in BLOCK for c in in_order(p))):
            run.append(k)
        elif isinstance(p, Node) and p.tag in BLOCK and run:
            yield run
            run = []
    if run:
        yield run


def is_heading(node: Node) -> bool:
    """A heading, or a header of headings alone."""
    return node.tag in HEADINGS or (node.tag in HEADERS and node.chars == sum(k.chars for k in node.children() if k.tag in HEADINGS))


def main_nodes(nodes: list[Node], linked: float) -> set[int | tuple[int, int]]:
    """Ids of the subtrees that make up the main text; (id, position) of text that a node around them holds."""
    best = max(nodes, key=lambda n: n.total)
    if best.total <= 0:
        return {id(nodes[0])}
    threshold, up = best.density, best
    while up is not None:
        threshold, up = min(threshold, up.density), up.parent
    # A sentence standing in a wrapper of its own is still part of the block around it.
    while best.parent is not None and best.parent.tag in ARTICLE | {"p", "section"} and best.parent.density >= threshold:
        best = best.parent
    chosen, path, up = {id(best)}, set(), best
    while up is not None:
        path.add(id(up))
        up = up.parent
    stack = [nodes[0]] if nodes[0] is not best else []
    while stack:
        n = stack.pop()
        for run in text_runs(n):
            parts = [n.parts[k] for k in run]
            kids = [p for p in parts if isinstance(p, Node)]
            if id(best) in map(id, kids) or any(id(k) in path for k in kids):
                continue
            chars = sum(letters(p) if isinstance(p, str) else p.chars for p in parts)
            links = sum(k.link_chars for k in kids)
            if links * 2 < chars and density(chars, sum(k.tags + 1 for k in kids), links, sum(k.link_tags + (k.tag == "a") for k in kids), linked) >= threshold:
                chosen.update((id(n), k) for k in run)
        joined = False
        for k in reversed([k for k in n.children() if k.chars]):
            if id(k) in path:
                joined = True
                if k is not best:
                    stack.append(k)
                continue
            joined = (k.density >= threshold or (joined and is_heading(k))) and k.link_chars * 2 < k.chars
            if joined:
                chosen.add(id(k))
    return chosen


def blocks(root: Node, chosen: set[int | tuple[int, int]]) -> list[str]:
    """Texts of the blocks inside the chosen subtrees, in page order."""
    out, line, stack = [], [], [(root, id(root) in chosen, False)]

    def flush():
        if text := " ".join("".join(line).split()):
            out.append(text)
        line.clear()

    while stack:
        node, inside, done = stack.pop()
        if isinstance(node, str):
            if inside:
                line.append(node)
            continue
        if node.tag in BLOCK:
            flush()
        if done or node.drop:
            continue
        if node.tag == "br":
            line.append(" ")
            continue
        stack.append((node, inside, True))
        stack.extend((node.parts[k], inside or (id(node), k) in chosen or id(node.parts[k]) in chosen, False) for k in range(len(node.parts) - 1, -1, -1))
    flush()
    return out


def main_text(html: str | None) -> str:
    """The article of a page, one line per block."""
    if not html:
        return ""
    tree = Tree()
    tree.feed(html)
    tree.close()
    nodes = in_order(tree.root)
    linked = measure(nodes)
    return "\n".join(blocks(tree.root, main_nodes(nodes, linked)))


def extract_text(pages: DataFrame, html: str = "html") -> DataFrame:
    """``pages`` with text and n_chars; input columns of these names are replaced."""

    @F.pandas_udf("string")
    def text_of(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for htmls in parts:
            yield pd.Series([main_text(h) for h in htmls], dtype=object)

    kept = with_columns_last(pages.withColumn("__html", F.col(html)), ["text", "n_chars"])
    return kept.withColumn("text", text_of("__html")).withColumn("n_chars", F.char_length("text").cast("long")).drop("__html")
