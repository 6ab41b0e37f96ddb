"""Main text of web pages: flat text blocks, classified by a small decision tree.

A page falls into blocks at block-level tags. Each block has its word count, its share of words inside links,
both of its neighbours, and what its containers say. A decision tree, trained here on the labelled blocks below,
tells main text from the rest.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from html import unescape
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from wardstat.llm.common import chunks, sql_type, text_of

#: Elements whose content is no text of the page; they go with all they hold.
SKIPPED = ("script", "style", "title", "noscript", "template", "svg", "iframe", "object", "select", "textarea", "button", "canvas", "math")
#: Those whose content is no markup, so that a start tag inside is text; those that may close themselves and that block tags break off.
RAW, FOREIGN = frozenset("script style title iframe textarea".split()), frozenset("svg math".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd label mark q rp rt ruby s samp small span strike strong sub sup time tt u var wbr".split()
)
#: Elements that hold blocks; their end tags are matched.
CONTAINERS = frozenset("article aside body center details dialog div dl fieldset figure footer form header html main menu nav ol section table ul".split())
SIDE_TAGS = frozenset("nav footer aside form menu dialog".split())
SIDE_WORDS = frozenset(
    "ad ads adv advert adverts advertisement advertising sponsor sponsored promo promotion banner cookie cookies consent gdpr notice alert popup modal overlay "
    "sidebar aside menu nav navbar navigation breadcrumb breadcrumbs footer masthead topbar toolbar comment comments respond reply replies disqus discussion "
    "share sharing social related recommended newsletter subscribe subscription signup login search widget pagination pager copyright complementary contentinfo dialog".split()
)
#: Parts of names of wrappers that may hold a page's article too, such as ``content-sidebar-wrap``; an article inside is no side text.
LAYOUT_WORDS = frozenset("ad ads banner sidebar aside menu nav navbar navigation footer masthead topbar toolbar notice alert overlay social share sharing widget search login signup".split())
LAYOUT_TAGS = frozenset("form header".split())
HEAD_WORDS = frozenset(["header"])
MAIN_WORDS = frozenset(["articlebody"])

_TAG = re.compile(
    r"<!--.*?(?:-->|\Z)|<(?P<skip>" + "|".join(SKIPPED) + r")(?![\w:-])(?P<own>(?:[^>\"']|\"[^\"]*\"|'[^']*')*)>"
    r"|<(?P<end>/?)(?P<tag>[a-z][a-z0-9:-]*)(?P<attrs>(?:[^>\"']|\"[^\"]*\"|'[^']*')*)>|<[!?/][^>]*>",
    re.I | re.S,
)
_ENDS = {name: re.compile(rf"</{name}\s*>", re.I) for name in SKIPPED}
_AGAIN = {name: re.compile(rf"<{name}(?![\w:-])", re.I) for name in SKIPPED}
#: Where an element without an end tag stops at the latest.
_BLOCK = re.compile(
    r"<(?:/(?:head|body|html|article|main|section|div)|body|article|main|section|div|p|h[1-6]|ul|ol|dl|table|nav|header|footer|aside|form|blockquote|pre|figure)(?![\w:-])", re.I
)
_NAMED = re.compile(r"""(?:^|\s)(?:class|id|role|itemprop)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
_PARTS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")


class Block(NamedTuple):
    text: str
    words: int
    linked: int
    side: bool  # in a menu, header, footer, sidebar, advert, form, notice or among comments
    main: bool  # in the page's article
    article: bool  # the page has an article


FEATURES = ("words", "density", "words_before", "density_before", "words_after", "density_after", "side", "main", "article")

# Labelled blocks: words, words in links, the same of the block before and after, side, main, page has an article; main text?
LABELLED = [
    # menus, breadcrumbs and link lists
    (1, 1, 0, 0, 1, 1, 1, 0, 1, 0), (2, 2, 1, 1, 3, 3, 1, 0, 0, 0), (8, 8, 0, 0, 40, 0, 0, 0, 0, 0), (5, 5, 6, 6, 4, 4, 0, 0, 0, 0),
    (3, 3, 2, 2, 2, 2, 1, 0, 1, 0), (12, 11, 3, 3, 9, 9, 0, 0, 0, 0), (2, 2, 80, 0, 2, 2, 1, 1, 1, 0), (30, 28, 4, 4, 6, 6, 0, 0, 0, 0),
    # adverts, notices, cookie boxes, comments and forms
    (7, 0, 1, 1, 60, 0, 1, 0, 1, 0), (25, 0, 2, 2, 10, 0, 1, 0, 1, 0), (60, 1, 5, 0, 45, 0, 1, 0, 0, 0), (45, 0, 120, 0, 30, 0, 1, 1, 1, 0),
    (90, 0, 60, 0, 70, 2, 1, 0, 0, 0), (4, 0, 90, 0, 0, 0, 1, 0, 0, 0), (18, 3, 0, 0, 200, 0, 1, 0, 1, 0), (140, 0, 15, 0, 3, 0, 1, 1, 1, 0),
    # headers, footers and other text outside the article
    (3, 0, 0, 0, 5, 5, 1, 0, 1, 0), (12, 0, 100, 0, 0, 0, 1, 0, 1, 0), (9, 0, 20, 0, 0, 0, 0, 0, 1, 0), (40, 0, 6, 6, 12, 0, 0, 0, 1, 0),
    (70, 5, 0, 0, 8, 0, 0, 0, 1, 0), (2, 0, 1, 1, 150, 0, 0, 0, 1, 0), (6, 0, 30, 30, 0, 0, 0, 0, 0, 0), (4, 0, 3, 3, 5, 5, 0, 0, 0, 0),
    # text of an article: headings, short and long paragraphs, also with links
    (9, 0, 7, 0, 80, 0, 0, 1, 1, 1), (1, 0, 60, 0, 40, 0, 0, 1, 1, 1), (2, 0, 5, 0, 0, 0, 0, 1, 1, 1), (120, 0, 9, 0, 70, 0, 0, 1, 1, 1),
    (60, 6, 120, 0, 1, 0, 0, 1, 1, 1), (14, 14, 30, 0, 25, 0, 0, 1, 1, 1), (3, 3, 3, 3, 90, 0, 0, 1, 1, 1), (300, 10, 2, 2, 12, 0, 0, 1, 1, 1),
    (40, 0, 1, 0, 1, 0, 0, 1, 1, 1), (5, 0, 0, 0, 0, 0, 0, 1, 1, 1), (8, 4, 55, 0, 9, 0, 0, 1, 1, 1), (16, 0, 12, 12, 10, 10, 0, 1, 1, 1),
    # pages without an article element
    (80, 0, 6, 6, 65, 0, 0, 0, 0, 1), (45, 3, 90, 2, 30, 0, 0, 0, 0, 1), (22, 0, 60, 0, 70, 0, 0, 0, 0, 1), (7, 0, 50, 0, 85, 0, 0, 0, 0, 1),
    (150, 20, 3, 3, 4, 4, 0, 0, 0, 1), (30, 0, 5, 0, 5, 0, 0, 0, 0, 1), (200, 0, 0, 0, 0, 0, 0, 0, 0, 1), (18, 2, 40, 0, 35, 0, 0, 0, 0, 1),
    (6, 0, 4, 4, 75, 0, 0, 0, 0, 1), (3, 0, 44, 0, 61, 0, 0, 0, 0, 1), (35, 1, 7, 7, 2, 2, 0, 0, 0, 1), (12, 0, 33, 0, 28, 0, 0, 0, 0, 1),
]


class Node(NamedTuple):
    feature: int
    limit: float
    low: "Node | float"
    high: "Node | float"


def train_tree(x: np.ndarray, y: np.ndarray, depth: int = 6) -> Node | float:
    """A binary decision tree by Gini impurity; the first of equally good cuts wins. Leaves are shares of label 1."""
    if depth == 0 or len(set(y.tolist())) < 2:
        return float(y.mean())
    best = None
    for f in range(x.shape[1]):
        values = np.unique(x[:, f])
        for limit in (values[1:] + values[:-1]) / 2:
            low = x[:, f] <= limit
            parts = (y[low], y[~low])
            impurity = sum(len(p) * p.mean() * (1 - p.mean()) for p in parts)
            if best is None or impurity < best[0] - 1e-12:
                best = (impurity, f, float(limit), low)
    if best is None:
        return float(y.mean())
    _, f, limit, low = best
    return Node(f, limit, train_tree(x[low], y[low], depth - 1), train_tree(x[~low], y[~low], depth - 1))


def default_tree() -> Node | float:
    rows = np.array(LABELLED, float)
    density = [rows[:, k + 1] / np.maximum(rows[:, k], 1) for k in (0, 2, 4)]
    x = np.stack([rows[:, 0], density[0], rows[:, 2], density[1], rows[:, 4], density[2], *rows[:, 6:9].T], axis=1)
    return train_tree(x, rows[:, 9])


def _named(attrs: str) -> set[str]:
    """The words of class, id, role and itemprop, in lower case, and each value as a whole."""
    out: set[str] = set()
    for groups in _NAMED.findall(attrs):
        for name in "".join(groups).split():
            out.add(name.lower())
            out.update(p.lower() for p in _PARTS.findall(name))
    return out


def _after(html: str, at: int, name: str, attrs: str, lacking: set[str]) -> int:
    """Where a skipped element ends whose start tag ends at ``at``. Without an end tag of its own it ends at the next
    block. ``lacking`` has the names without a further end tag."""
    if name in FOREIGN and attrs.endswith("/"):
        return at
    end = None if name in lacking else _ENDS[name].search(html, at)
    if end is None:
        lacking.add(name)
    elif name in FOREIGN:
        block = _BLOCK.search(html, at, end.start())
        if block is None or "foreignobject" in html[at : block.start()].lower():
            return end.end()
    elif name in RAW or name in ("template", "object") or not _AGAIN[name].search(html, at, end.start()):
        return end.end()
    block = _BLOCK.search(html, at)
    return block.start() if block else len(html)


def blocks(html: str) -> list[Block]:
    """The text blocks of a page, in order."""
    found: list[tuple[str, int, int, bool, bool]] = []
    lacking: set[str] = set()
    text: list[str] = []
    links: list[str] = []
    # Tag, side text (2: whatever is inside, 1: but for an article), article.
    stack: list[tuple[str, int, bool]] = [("", 0, False)]
    in_link = article = False
    at = 0

    def close() -> None:
        if text:
            clean = " ".join(unescape("".join(text)).split())
            if clean:
                linked = len(unescape("".join(links)).split())
                found.append((clean, clean.count(" ") + 1, linked, stack[-1][1] > 0, stack[-1][2]))
            text.clear()
            links.clear()

    while m := _TAG.search(html, at):
        if m.start() > at:
            piece = html[at : m.start()]
            text.append(piece)
            if in_link:
                links.append(piece)
        at = m.end()
        tag = m["tag"]
        if tag is None:
            if m["skip"]:
                text.append(" ")
                at = _after(html, at, m["skip"].lower(), m["own"], lacking)
            continue
        tag = tag.lower()
        if tag in INLINE:
            if tag == "a":
                in_link = not m["end"]
                links.append(" ")
            continue
        close()
        if tag not in CONTAINERS:
            continue
        if m["end"]:
            for i in range(len(stack) - 1, 0, -1):
                if stack[i][0] == tag:
                    del stack[i:]
                    break
        elif not m["attrs"].endswith("/"):
            _, side, main = stack[-1]
            names = _named(m["attrs"]) if "=" in m["attrs"] else set()
            whole = {n.lower() for g in _NAMED.findall(m["attrs"]) for n in "".join(g).split()} & SIDE_WORDS if names & SIDE_WORDS else set()
            if tag in ("article", "main") or names & MAIN_WORDS:
                main = article = True
                side = 0 if side == 1 else side
            body = tag in ("html", "body", "article", "main")
            if tag in SIDE_TAGS or (not body and names & SIDE_WORDS):
                layout = (tag in LAYOUT_TAGS or tag not in SIDE_TAGS) and not body and not (names & SIDE_WORDS) - LAYOUT_WORDS
                side = max(side, 1 if layout and not names & whole else 2)
            if not main and (tag == "header" or (not body and names & HEAD_WORDS)):
                side = max(side, 1)
            stack.append((tag, side, main))
    if at < len(html):
        text.append(html[at:])
    close()
    return [Block(*b, article) for b in found]


def main_text(html: str, tree: Node | float) -> str:
    """The blocks that the tree takes for main text, joined by spaces."""
    page = blocks(html)
    sizes = [(0, 0.0), *((b.words, min(1.0, b.linked / b.words)) for b in page), (0, 0.0)]
    kept = []
    for i, b in enumerate(page):
        row = (*sizes[i + 1], *sizes[i], *sizes[i + 2], b.side, b.main, b.article)
        node = tree
        while isinstance(node, Node):
            node = node.low if row[node.feature] <= node.limit else node.high
        if node >= 0.5:
            kept.append(b.text)
    return " ".join(kept)


def extract(pages: DataFrame, key: str = "page_id", html: str = "html", keep: tuple[str, ...] = ("url",)) -> DataFrame:
    """(key, the columns ``keep``, text, n_chars) per row: the main text and its code points.

    Null, empty and text-free pages give the empty text. Null and repeated keys stay rows; other columns don't matter.
    """
    tree = default_tree()
    names = [key, *keep]
    plain = [f"c{i}" for i in range(len(names))]
    rows = pages.select(*(F.col(f"`{c}`").alias(p) for c, p in zip(names, plain)), text_of(html).alias("text"))
    fields = [StructField(p, sql_type(pages, c)) for c, p in zip(names, plain)]
    schema = StructType([*fields, StructField("out", StringType()), StructField("n", LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in chunks(batches):
            texts = [main_text(h, tree) for h in part.column("text").to_pylist()]
            own = [part.column(p) for p in plain]
            yield pa.RecordBatch.from_arrays(
                [*own, pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], schema.names
            )

    return rows.mapInArrow(run, schema).toDF(*names, "text", "n_chars")
