"""Main text of web pages by composite text density.

Every node of the page's tree gets its characters per tag, lowered by the
share of links in it and in the page; where there are no link characters or
link tags, 1 stands for them.  The node whose children have the largest sum of
densities holds the article; the least density on its path to the body is the
threshold that other parts of the page must reach.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Element names and words in class, id and role of HTML pages.
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
RAW = set("script style textarea title noscript template iframe svg math select object canvas".split())
SKIP = set("nav footer aside menu dialog button fieldset label".split()) | RAW
BLOCK = set("address article aside blockquote body caption center dd details dialog div dl dt fieldset figcaption figure "
            "footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol p pre search section summary "
            "table tbody td tfoot th thead title tr ul".split())
HEADING = {"h1", "h2", "h3", "h4", "h5", "h6"}
CLOSED_BY = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}}
FENCE = {"li": {"ul", "ol", "menu"}, "dt": {"dl"}, "dd": {"dl"}, "tr": {"table"}, "td": {"tr", "table"}, "th": {"tr", "table"}}
PARTS = {"tbody", "thead", "tfoot"}
CLOSED_BY |= dict.fromkeys(PARTS, PARTS | CLOSED_BY["tr"])
FENCE |= dict.fromkeys(PARTS, {"table"})
CELLS = PARTS | CLOSED_BY["tr"] | {"caption", "table"}
NOISE = set("ad ads adv advert advertisement advertising sponsor sponsored promo promotion sidebar comment comments respond "
            "disqus cookie cookies consent gdpr notice notices alert banner popup modal overlay newsletter subscribe signup "
            "login share sharing social related recommended breadcrumb breadcrumbs pagination pager menu nav navbar navigation "
            "footer toolbar widget copyright disclaimer skip complementary contentinfo search".split())
PAGE_NOISE = {"header", "masthead", "topbar"}
CONTENT = set("content article main post entry body story page container wrapper layout text".split())

_TOKEN = re.compile(r"<!--.*?(?:-->|$)|<[!?][^>]*(?:>|$)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)>", re.S)
_HINT = re.compile(r"""\b(class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
_HIDDEN = re.compile(r"""(?:^|\s)hidden(?:\s|$|=)|display\s*:\s*none|aria-hidden\s*=\s*["']?true""", re.I)
_WORDS = re.compile(r"[a-z]+")


class Node:
    __slots__ = ("tag", "parent", "children", "inside", "chars", "tags", "link_chars", "link_tags", "density", "total",
                 "noise")

    def __init__(self, tag: str, parent: Node | None, inside: bool, noise: bool = False):
        self.tag, self.parent, self.inside = tag, parent, inside  # inside: an article or main element holds it
        self.noise = noise  # never part of an article, with all below it
        self.children: list[Node | str] = []
        self.chars = self.tags = self.link_chars = self.link_tags = 0
        self.density = self.total = 0.0


def _noise(tag: str, attributes: str, inside: bool) -> bool:
    """Elements that are never part of an article."""
    if tag in SKIP or tag == "header" and not inside:
        return True
    if not attributes or tag in ("html", "body", "article", "main") or tag in HEADING:
        return False
    if _HIDDEN.search(attributes):
        return True
    words = {w for _, *v in _HINT.findall(attributes) for w in _WORDS.findall("".join(v).lower())}
    return not words & CONTENT and bool(words & NOISE or words & PAGE_NOISE and not inside)


def parse(html: str) -> Node:
    """The tree of a page without noise; unclosed and stray tags are mended as browsers do, in noise too."""
    root = node = Node("html", None, False)
    at = 0
    lower = None
    while True:
        m = _TOKEN.search(html, at)
        text = html[at:m.start() if m else len(html)]
        if text:
            node.children.append(unescape(text) if "&" in text else text)
        if m is None:
            break
        at = m.end()
        if m[2] is None:
            continue
        tag = m[2].lower()
        if m[1]:
            # the end of an inline element stays in its block, that of a block in its table cell
            fence = BLOCK if tag not in BLOCK and tag not in SKIP else () if tag in CELLS else CELLS
            up = node
            while up.parent is not None and up.tag != tag and up.tag not in fence:
                up = up.parent
            node = up.parent if up.parent is not None and up.tag == tag else node
            continue
        if tag in ("html", "body"):
            continue
        if tag in RAW and not m[3].endswith("/"):
            lower = html.lower() if lower is None else lower
            end = lower.find(f"</{tag}", at)
            at = len(html) if end < 0 else max(html.find(">", end) + 1, 0) or len(html)
            continue
        if tag in BLOCK:  # closes an open paragraph
            up = node
            while up.parent is not None and up.tag not in ("p", "button") and up.tag not in BLOCK:
                up = up.parent
            if up.tag == "p":
                node = up.parent
        while tag in CLOSED_BY:  # a row closes the cell and the row before it
            up = node
            while up.parent is not None and up.tag not in CLOSED_BY[tag] and up.tag not in FENCE[tag]:
                up = up.parent
            if up.tag not in CLOSED_BY[tag] or up.parent is None:
                break
            node = up.parent
        if tag in VOID:
            node.children.append(" " if tag == "br" else Node(tag, node, node.inside))
            continue
        child = Node(tag, node, node.inside or tag in ("article", "main"), _noise(tag, m[3], node.inside))
        node.children.append(child)
        node = child
    _cut_noise(root)
    return root


def _cut_noise(root: Node) -> None:
    """Takes flagged subtrees out, and forms but those that hold an article element or over half of the text."""
    nodes, forms = [root], False
    for n in nodes:
        if any(isinstance(c, Node) and c.noise for c in n.children):
            n.children = [c for c in n.children if isinstance(c, str) or not c.noise]
        forms = forms or n.tag == "form"
        nodes.extend(c for c in n.children if isinstance(c, Node))
    if not forms:
        return
    chars, holds = {}, set()
    for n in reversed(nodes):
        chars[n] = sum(len(" ".join(c.split())) if isinstance(c, str) else chars[c] for c in n.children)
        if n.tag in ("article", "main") or any(c in holds for c in n.children if isinstance(c, Node)):
            holds.add(n)
    for n in nodes:
        n.children = [c for c in n.children if isinstance(c, str) or c.tag != "form" or c in holds or 2 * chars[c] > chars[root]]


def _order(root: Node) -> list[Node]:
    """Nodes, parents before children."""
    out = [root]
    for n in out:
        out.extend(c for c in n.children if isinstance(c, Node))
    return out


def _measure(nodes: list[Node]) -> None:
    """Composite densities and the sums of the children's densities."""
    for n in reversed(nodes):
        n.chars += sum(len(" ".join(c.split())) for c in n.children if isinstance(c, str))
        if n.tag == "a":
            n.link_chars, n.link_tags = n.chars, n.link_tags + 1
        if n.parent is not None:
            p = n.parent
            p.chars += n.chars
            p.tags += n.tags + 1
            p.link_chars += n.link_chars
            p.link_tags += n.link_tags
    page = nodes[0]
    share = page.link_chars / max(1, page.chars)
    for n in reversed(nodes):
        if n.chars:
            tags, links, linked = max(1, n.tags), max(1, n.link_tags), max(1, n.link_chars)
            base = math.log(n.chars / max(1, n.chars - n.link_chars) * linked + share * n.chars + math.e)
            n.density = n.chars / tags * math.log(max(1.0, n.chars / linked * tags / links)) / math.log(base)
        if n.parent is not None:
            n.parent.total += n.density


def _path(node: Node) -> list[Node]:
    """The node and all that hold it, up to the page."""
    path = [node]
    while path[-1].parent is not None:
        path.append(path[-1].parent)
    return path


def _chosen(nodes: list[Node]) -> list[Node]:
    """Roots of the article's subtrees in page order.

    The node with the largest sum is one of them.  The least density on its
    path to the body is the threshold: going down from the body through nodes
    that reach it and have less than a quarter of their characters in links,
    each one's own node with the largest sum is another.  An article element
    around or as most of the first one is taken whole; a main element takes the
    body's place.
    """
    peak = {}  # of every subtree: the node with the largest sum, parents and first ones before others
    for n in reversed(nodes):
        below = [peak[c] for c in n.children if isinstance(c, Node)]
        peak[n] = max([n, *below], key=_weight)
    best = peak[nodes[0]]
    path = _path(best)
    scope = next((n for tag in ("article", "main") for n in reversed(path) if n.tag == tag), None)
    if scope is None:
        held = [n for n in nodes if n.tag in ("article", "main") and 2 * max(n.density, n.total) >= _weight(best)]
        scope = next((n for n in held if best in _path(n)), None)
        if scope is not None:
            return [scope]
    elif scope.tag == "article":
        return [scope]
    threshold = min(n.density for n in path)
    taken, above = {best}, set(path[1:])
    around = [scope or nodes[0]]
    for n in around:
        if n in taken:
            continue
        if n not in above:
            if n.density < threshold or n.chars <= 4 * n.link_chars:
                continue
            taken.add(peak[n])
        if n not in taken:
            around.extend(c for c in n.children if isinstance(c, Node))
    # what is above a taken node, to which headings beside it belong
    over: set[Node] = set()
    for n in taken:
        while n.parent is not None and n.parent not in over:
            n = n.parent
            over.add(n)
    roots, stack = [], [scope or nodes[0]]
    while stack:
        n = stack.pop()
        if n in taken:
            roots.append(n)
        elif n in over:
            parts = [c for c in n.children if isinstance(c, Node)]
            follows = False
            for c in reversed(parts):
                if c.tag not in HEADING:
                    follows = c in taken or c in over
                elif n in above and (follows or n is best.parent and c.tag == "h1"):
                    taken.add(c)
            stack.extend(reversed(parts))
    return roots


def _weight(node: Node) -> float:
    """The sum of the children's densities; a node without any stands for itself."""
    return node.total or node.density


def _blocks(root: Node, out: list[str]) -> None:
    """Texts of a subtree's blocks in page order, without recursion."""
    line: list[str] = []

    def flush() -> None:
        text = " ".join("".join(line).split())
        line.clear()
        if text:
            out.append(text)

    stack: list = [root]
    while stack:
        item = stack.pop()
        if item is None:
            flush()
        elif isinstance(item, str):
            line.append(item)
        else:
            if item.tag in BLOCK:
                flush()
                stack.append(None)
            stack.extend(reversed(item.children))
    flush()


def main_text(html: str) -> str:
    """The article of a page: blocks joined by a line feed, white space in them folded."""
    nodes = _order(parse(html))
    _measure(nodes)
    out: list[str] = []
    if nodes[0].chars:
        for root in _chosen(nodes):
            _blocks(root, out)
    return "\n".join(out)


def extract_text(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """``(id_col, url_col, text, n_chars)`` for every row of ``pages``.

    Null, empty and text-free pages have an empty text; a page without tags
    is one block.  Null and repeated ids keep a row each.  Other columns are
    ignored.  An empty table gives an empty result.
    """
    rows = pages.select(F.col(id_col).alias("id"), F.col(url_col).alias("url"), F.col(html_col).cast("string").alias("html"))

    def extracted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(h) if h else "" for h in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
                names=["id", "url", "text", "n_chars"])

    schema = T.StructType([rows.schema["id"], rows.schema["url"], T.StructField("text", T.StringType()),
                           T.StructField("n_chars", T.LongType())])
    return rows.mapInArrow(extracted, schema).withColumnsRenamed({"id": id_col, "url": url_col})
