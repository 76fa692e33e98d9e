"""Main text of web pages by composite text density.

A page becomes a tree of its block elements; inline markup counts as tags of the block it
stands in. Every node has characters ``C``, tags ``T``, link characters ``LC`` and link tags
``LT`` of its subtree, and the link-adjusted density of Sun, Song and Liao (2011)

    C / T * log_base(C / LC * T / LT),  base = ln(C / nonLC * LC + LC_body / C_body * C + e)

with zero denominators taken as 1. The density sum of a node adds the densities of its
children (text that stands directly in a node counts as a child). The node with the largest
sum is the main one, the smallest density on its path to the body is the threshold. From the
body down, every node from that density up gives the node of largest sum below it (or the
article element around that one) and is searched on in its children that are not chosen yet;
all text below the chosen nodes is kept. Parts that their tag, role or class names as
something else than the article (menus, adverts, comments, ...) are no nodes at all.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from html import unescape
from math import e, log

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Kinds of elements.
RAW = frozenset("script style title textarea noscript iframe xmp noembed noframes".split())
VOID = frozenset(
    "area base br col embed hr img input link meta param source track wbr".split()
)
PRUNED = frozenset(
    "nav header footer aside form script style noscript template svg iframe button select "
    "textarea dialog menu title head object canvas audio video math noembed noframes".split()
)
BLOCKS = frozenset(
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset "
    "figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html li main menu nav ol "
    "p pre search section summary table tbody td tfoot th thead tr ul caption head".split()
)
CLOSES = {  # an opening tag that ends an open element of these kinds
    "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"},
    "td": {"td", "th"}, "th": {"td", "th"},
    "tbody": {"thead", "tbody", "tfoot", "tr", "td", "th"},
    "tfoot": {"thead", "tbody", "tfoot", "tr", "td", "th"},
}
SCOPES = {
    "li": {"ul", "ol", "menu"}, "dt": {"dl"}, "dd": {"dl"}, "tr": {"table"}, "td": {"table", "tr"},
    "th": {"table", "tr"}, "tbody": {"table"}, "tfoot": {"table"},
}
NAMED = re.compile(
    r"(?:^|[\s_-])(?:ads?|adv|advert(?:s|isement|ising)?|banner|sponsor(?:ed|s)?|promo(?:tion|ted)?|"
    r"sidebar|side-bar|menu|navbar|navigation|nav|breadcrumbs?|pagination|pager|toc|"
    r"comments?|commentlist|replies|disqus|respond|cookies?|consent|gdpr|notices?|alerts?|"
    r"popup|modal|overlay|newsletter|subscribe|subscription|signup|login|paywall|"
    r"share|sharing|social|related|recommended|recommendations|widgets?|masthead|"
    r"site-header|site-footer|page-header|page-footer|footer|header|skip-link)(?:$|[\s_-])"
)
ROLES = frozenset(
    "navigation banner contentinfo complementary search form dialog alert alertdialog menu "
    "menubar".split()
)
WHOLE = frozenset("html body main article".split())  # never pruned by their class

TAG = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*>"
    r"|<(/?)([A-Za-z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)>",
    re.S,
)
ATTRIBUTE = re.compile(r"([^\s=/]+)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))")


class Node:
    __slots__ = ("name", "up", "parts", "tags", "link_tags", "own_tags", "pruned", "chars",
                 "link_chars", "density", "sum", "top")

    def __init__(self, name: str, up: Node | None, pruned: bool):
        self.name, self.up, self.pruned = name, up, pruned
        self.parts: list = []  # nodes, and (text, whether in a link)
        self.tags = self.link_tags = 0


def _is_named(name: str, attributes: str) -> bool:
    if name in PRUNED:
        return True
    if not attributes or name in WHOLE:
        return False
    for key, *values in ATTRIBUTE.findall(attributes):
        key, value = key.lower(), "".join(values).lower()
        if key in ("class", "id") and NAMED.search(value):
            return True
        if key == "role" and value.strip() in ROLES:
            return True
        if key == "hidden" or key == "aria-hidden" and value == "true":
            return True
        if key == "style" and "display:none" in value.replace(" ", ""):
            return True
    return False


def tree(html: str) -> Node:
    """The page's block elements. Tags are matched as browsers do for the common cases of
    missing ends; anything that is not a tag is text."""
    root = here = Node("body", None, False)
    open_inline: list[tuple[str, bool]] = []  # inline elements of the block, whether pruned
    at = links = hidden = 0
    position, find = 0, TAG.search
    while True:
        tag = find(html, position)
        text = html[at : tag.start()] if tag else html[at:]
        if text and not here.pruned and not hidden:
            here.parts.append((text, links > 0))
        if not tag:
            return root
        at = position = tag.end()
        if tag[2] is None:
            continue
        closing, name, attributes = tag[1], tag[2].lower(), tag[3]
        if name in ("html", "body"):
            continue
        if not closing and name in RAW:  # no markup inside: go on at its end
            end = re.compile(rf"</{re.escape(name)}\s*>", re.I).search(html, at)
            at = position = end.end() if end else len(html)
            continue
        if name in BLOCKS:
            if closing:
                node = here
                while node is not root and node.name != name:
                    node = node.up
                if node is not root:
                    here = node.up
                    links = hidden = 0
                    open_inline = []
                continue
            if here.name == "p":  # a block ends an open paragraph
                here, links, hidden, open_inline = here.up, 0, 0, []
            if name in CLOSES:
                node = here
                while node is not root and node.name not in SCOPES[name]:
                    if node.name in CLOSES[name]:
                        here = node.up
                    node = node.up
            node = Node(name, here, here.pruned or _is_named(name, attributes))
            if not node.pruned:
                here.parts.append(node)
            if name != "hr":
                here = node
            links, hidden, open_inline = 0, 0, []
            continue
        if name in VOID:
            here.tags += 1
            if name == "br" and not here.pruned and not hidden:
                here.parts.append((" ", links > 0))
            continue
        if closing:
            for i in range(len(open_inline) - 1, -1, -1):
                if open_inline[i][0] == name:
                    hidden -= open_inline.pop(i)[1]
                    links -= name == "a"
                    break
        elif not attributes.endswith("/"):
            prune = _is_named(name, attributes)
            open_inline.append((name, prune))
            hidden += prune
            links += name == "a"
            here.tags += 1
            here.link_tags += name == "a"


def _length(text: str) -> int:
    return len("".join(text.split()))


def _density(c: int, t: int, lc: int, lt: int, page_share: float) -> float:
    if not c:
        return 0.0
    ratio = c / (lc or 1) * (t or 1) / (lt or 1)
    base = log(c / ((c - lc) or 1) * lc + page_share * c + e)
    per_tag = c / (t or 1)
    return per_tag * (log(max(ratio, 1.0)) / log(base) if base > 1.0001 else log(max(ratio, 1.0)))


def measure(root: Node) -> list[Node]:
    """Fill in characters, densities, density sums and the node of largest sum of each
    subtree; all nodes, parents first."""
    nodes = [root]
    for node in nodes:
        nodes += [p for p in node.parts if isinstance(p, Node)]
    for node in reversed(nodes):
        own = [(_length(t), link) for t, link in (p for p in node.parts if type(p) is tuple)]
        below = [p for p in node.parts if isinstance(p, Node)]
        node.chars = sum(n for n, _ in own) + sum(p.chars for p in below)
        node.link_chars = sum(n for n, link in own if link) + sum(p.link_chars for p in below)
        node.own_tags = node.tags
        node.tags += sum(p.tags + 1 for p in below)
        node.link_tags += sum(p.link_tags for p in below)
        node.sum = float(sum(n for n, link in own if not link))  # own text, for now
    share = root.link_chars / (root.chars or 1)
    for node in nodes:
        node.density = _density(node.chars, node.tags, node.link_chars, node.link_tags, share)
    for node in nodes:
        direct = _density(int(node.sum), node.own_tags, 0, 0, share)
        node.sum = direct + sum(p.density for p in node.parts if isinstance(p, Node))
    for node in reversed(nodes):  # of equal sums the outermost, then the first
        node.top = max([node, *(p.top for p in node.parts if isinstance(p, Node))], key=lambda n: n.sum)
    return nodes


def chosen(root: Node) -> list[Node]:
    """The nodes that hold the main text, in page order."""
    measure(root)
    best = root.top
    if best.sum <= 0:  # at most single characters: no density to go by
        return [root] if root.chars else []
    threshold, node = best.density, best
    while node is not None:
        threshold, node = min(threshold, node.density), node.up
    found, taken, waiting = set(), set(), [root]
    while waiting:
        node = waiting.pop()
        if node in taken or node.density < threshold:
            continue
        if node.top not in taken:
            top = _article(node.top) or node.top
            found.add(top)
            taken.update(_below(top))
        if node not in taken:
            waiting += [p for p in node.parts if isinstance(p, Node)]
    out, waiting = [], [root]
    while waiting:
        node = waiting.pop()
        if node in found:
            out.append(node)
        else:
            waiting += [p for p in reversed(node.parts) if isinstance(p, Node)]
    return out


def _below(node: Node) -> list[Node]:
    """A node and all nodes below it."""
    out = [node]
    for node in out:
        out += [p for p in node.parts if isinstance(p, Node)]
    return out


def _article(node: Node) -> Node | None:
    """The outermost article around a node, where the page names one: it has the heading."""
    found = None
    while node is not None:
        found = node if node.name == "article" else found
        node = node.up
    return found


def blocks(node: Node) -> list[str]:
    """Texts of the blocks below a node: white space as one space, trimmed, none empty."""
    out, text = [], []
    stack = [iter(node.parts)]
    while stack:
        part = next(stack[-1], None)
        if type(part) is tuple:
            text.append(part[0])
            continue
        out.append(" ".join(unescape("".join(text)).split()))
        text = []
        if part is None:
            stack.pop()
        else:
            stack.append(iter(part.parts))
    return [b for b in out if b]


def main_text(html: str | None) -> str:
    """The article of a page, blocks joined by empty lines; empty if there is none."""
    return "\n\n".join(b for n in chosen(tree(html or "")) for b in blocks(n))


def extract(pages: DataFrame) -> DataFrame:
    """``page_id, url, text, n_chars`` of every page; ``n_chars`` counts code points.

    A null or empty html gives an empty text, repeated rows and null ids are kept as they
    are, an empty table gives no rows. Columns other than page_id, url and html are not read.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            texts = [main_text(h) for h in batch["html"]]
            yield batch[["page_id", "url"]].assign(text=texts, n_chars=[len(t) for t in texts])

    rows = pages.select(F.col("page_id").cast("string"), "url", "html")
    made = rows.mapInPandas(run, "page_id string, url string, text string, n_chars long")
    return made.withColumn("page_id", F.col("page_id").cast("long"))
