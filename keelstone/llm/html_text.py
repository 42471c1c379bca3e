"""Main text of web pages from flat text blocks.

A page is cut into flat text blocks at block-level tags. A block has its word count
and link density, those of its neighbours, and where it stands (below an article,
below page furniture, in a list or heading). A decision tree, trained on the blocks
of the small labelled table `PAGES`, keeps or drops each block.

Furniture is what its tag says (a menu, a form) or its class, id or role: one of
their words must be a hint, or begin with one (`cookie-notice`), or have one
as the second of two parts (`site-header`, but not `has-sidebar`). Neither the page
itself nor a wrapper of `main` is furniture, and the header, caption or address
of an article belongs to it.

Defined cases: a NULL or empty page, or one without a kept block, has an empty
text. Broken markup is read as far as it goes: unclosed tags end with their parent,
a cut-off tag or comment runs to the end. Rows are read one by one, so
repeated rows give equal rows. Extra columns are ignored; an empty table
gives an empty result.
"""

from __future__ import annotations

import html
import re
from collections import Counter
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame

from keelstone.llm.words import map_blocks

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)"
    # A quote opens a value only behind an equals sign.
    r"|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)((?:=\s*\"[^\"]*\"|=\s*'[^']*'|[^>])*)(?:>|\Z)",
    re.DOTALL,
)
_CLASS = re.compile(r"""\b(?:class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+))""", re.I)

RAW = {"script", "style", "title", "textarea", "noscript", "template", "iframe", "svg", "select"}
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr"}
INLINE = {
    "a", "abbr", "acronym", "b", "bdi", "bdo", "big", "cite", "code", "data", "del", "dfn", "em",
    "font", "i", "img", "ins", "kbd", "label", "mark", "q", "s", "samp", "small", "span", "strike",
    "strong", "sub", "sup", "time", "tt", "u", "var", "wbr", "br", "math", "mi", "mn", "mo", "mrow",
    "msub", "msup", "mfrac", "msqrt", "mtext", "semantics",
}
FURNITURE = {"nav", "header", "footer", "aside", "form", "button", "menu", "dialog", "address"}
# What an article may have as a part of its own.
OWN_PARTS = {"header", "address"}
ITEMS = {"li", "td", "th", "dd", "dt"}
ARTICLE = {"article", "main"}
HEADINGS = {"h1", "h2", "h3", "h4", "h5", "h6"}
# Words in class, id or role that name page furniture.
HINTS = {
    "ad", "ads", "advert", "adverts", "advertisement", "banner", "breadcrumb", "breadcrumbs", "comment",
    "comments", "complementary", "contentinfo", "cookie", "cookies", "consent", "disqus", "footer",
    "header", "login", "masthead", "menu", "modal", "nav", "navbar", "navigation", "newsletter", "notice",
    "notices", "popup", "promo", "promotion", "recommended", "related", "replies", "reply", "search",
    "share", "sharing", "sidebar", "signup", "skip", "social", "sponsor", "sponsored", "subscribe",
    "tags", "toolbar", "widget",
}
# First parts that only tell of a layout.
LAYOUT = {"has", "no", "with", "without", "not", "is", "hide", "show"}


@dataclass
class Block:
    text: str
    words: int
    linked: int  # words inside links
    article: bool
    furniture: bool
    heading: bool
    item: bool  # list item or table cell

    @property
    def link_density(self) -> float:
        return self.linked / self.words if self.words else 0.0


def _hint(word: str) -> str | None:
    """The hint that a word of a class, id or role gives."""
    parts = [p for p in re.split(r"[^a-z]+", word) if p]
    if parts and parts[0] in HINTS:
        return parts[0]
    if len(parts) == 2 and parts[1] in HINTS and parts[0] not in LAYOUT:
        return parts[1]
    return None


def _is_furniture(tag: str, attributes: str, in_article: bool) -> bool:
    if tag in ("html", "body", "main"):
        return False
    if tag in FURNITURE and not (in_article and tag in OWN_PARTS):
        return True
    for found in _CLASS.finditer(attributes):
        for word in (found[1] or found[2] or found[3] or "").lower().split():
            hint = _hint(word)
            if hint and not (in_article and hint in OWN_PARTS):
                return True
    return "hidden" in attributes.lower().split()


def blocks(page: str) -> list[Block]:
    """Flat text blocks in page order."""
    out: list[Block] = []
    # Open elements: (tag, furniture, furniture around a main element), and how many there are of each tag.
    stack: list[tuple[str, bool, int]] = []
    opened: Counter[str] = Counter()
    n_article = n_furniture = n_link = n_heading = n_item = 0
    parts: list[str] = []
    linked: list[str] = []

    def close_block():
        nonlocal parts, linked
        if parts:
            text = " ".join("".join(parts).split())
            if text:
                out.append(Block(
                    text, text.count(" ") + 1, len("".join(linked).split()), n_article > 0,
                    n_furniture > 0, n_heading > 0, n_item > 0,
                ))
            parts, linked = [], []

    def add(text: str):
        text = html.unescape(text)
        parts.append(text)
        if n_link:
            linked.append(text + " ")

    def count(tag: str, by: int):
        nonlocal n_article, n_link, n_heading, n_item
        opened[tag] += by
        n_article += by * (tag in ARTICLE)
        n_link += by * (tag == "a")
        n_heading += by * (tag in HEADINGS)
        n_item += by * (tag in ITEMS)

    def push(tag: str, furniture: bool):
        nonlocal n_furniture
        around = n_furniture
        if tag == "main":
            n_furniture = 0
        n_furniture += furniture
        stack.append((tag, furniture, around))
        count(tag, 1)

    def pop() -> str:
        nonlocal n_furniture
        tag, furniture, around = stack.pop()
        n_furniture = around
        count(tag, -1)
        return tag

    at, end = 0, len(page)
    while at < end:
        token = _TOKEN.search(page, at)
        if token is None:
            add(page[at:])
            break
        if token.start() > at:
            add(page[at : token.start()])
        at = token.end()
        if token[2] is None:
            continue
        tag, closing = token[2].lower(), token[1] == "/"
        if tag in RAW:
            if not closing and not token[0].endswith("/>"):
                stop = re.compile(rf"</{tag}\b[^>]*(?:>|\Z)", re.I).search(page, at)
                at = stop.end() if stop else end
            continue
        if tag == "br":
            parts.append(" ")
            continue
        inline = tag in INLINE
        if not inline:
            close_block()
        if tag in VOID:
            continue
        if closing:
            if opened[tag]:
                # An inline end tag never closes a block element.
                while stack and (not inline or stack[-1][0] in INLINE):
                    if pop() == tag:
                        break
            continue
        if not inline:
            # A block start ends open inline elements, an open paragraph and the last list item.
            while stack and (stack[-1][0] in INLINE or stack[-1][0] in ("p", *HEADINGS)
                             or (tag == "li" and stack[-1][0] == "li")):
                pop()
        push(tag, _is_furniture(tag, token[3], n_article > 0))
    close_block()
    return out


FEATURES = (
    "words", "link_density", "before_words", "before_density", "after_words", "after_density",
    "article", "furniture", "heading", "item", "page_has_article",
)


def features(found: list[Block]) -> list[tuple[float, ...]]:
    none = Block("", 0, 0, False, False, False, False)
    any_article = float(any(b.article for b in found))
    around = [none, *found, none]
    return [
        (
            b.words, b.link_density, p.words, p.link_density, n.words, n.link_density,
            float(b.article), float(b.furniture), float(b.heading), float(b.item), any_article,
        )
        for p, b, n in zip(around, found, around[2:])
    ]


#: Labelled pages: blocks of (words, linked words, where it stands, 1 for main text). Where: a below an
#: article, f below furniture, h in a heading, i in a list item or table cell.
PAGES: tuple[tuple[tuple[int, int, str, int], ...], ...] = (
    # articles that are marked as such, with menus, notices, adverts, sidebars and comments around and inside
    ((1, 1, "fi", 0), (2, 2, "fi", 0), (1, 1, "fi", 0), (11, 0, "f", 0), (8, 0, "ah", 1), (80, 0, "a", 1),
     (14, 0, "af", 0), (60, 3, "a", 1), (3, 0, "a", 1), (45, 0, "af", 0), (12, 0, "f", 0)),
    ((4, 0, "fh", 0), (9, 0, "f", 0), (2, 2, "fi", 0), (1, 1, "fi", 0), (6, 0, "ah", 1), (1, 0, "a", 1),
     (2, 0, "a", 1), (120, 10, "a", 1), (5, 0, "ai", 1), (7, 2, "ai", 1), (30, 0, "a", 1), (9, 1, "f", 0)),
    ((3, 3, "i", 0), (2, 2, "i", 0), (30, 0, "", 0), (9, 0, "ah", 1), (40, 0, "a", 1), (2, 0, "a", 1),
     (4, 4, "ai", 0), (5, 5, "ai", 0), (70, 0, "", 0), (8, 0, "", 0)),
    ((5, 0, "h", 0), (10, 0, "ah", 1), (3, 0, "a", 1), (400, 0, "a", 1), (6, 0, "ah", 1), (50, 20, "a", 1),
     (20, 0, "ai", 1), (2, 0, "ai", 1), (150, 0, "af", 0), (4, 0, "afh", 0), (100, 0, "af", 0), (14, 0, "", 0)),
    ((60, 0, "f", 0), (35, 0, "f", 0), (7, 0, "a", 1)),
    ((1, 0, "a", 1),),
    ((12, 0, "ah", 1), (25, 2, "a", 1), (9, 9, "a", 0), (15, 14, "a", 0), (18, 0, "a", 1), (25, 0, "f", 0)),
    ((90, 0, "f", 0), (2, 0, "ah", 1), (6, 0, "a", 1), (5, 0, "a", 1), (40, 0, "f", 0), (3, 3, "f", 0)),
    ((1, 1, "fi", 0), (2, 2, "fi", 0), (4, 0, "ah", 1), (6, 0, "a", 1), (50, 0, "a", 1), (9, 0, "f", 0)),
    ((2, 2, "i", 0), (3, 3, "i", 0), (70, 0, "a", 1), (5, 0, "a", 1)),
    ((1, 1, "fi", 0), (9, 0, "ah", 1), (3, 0, "ai", 1), (8, 0, "ai", 1), (2, 2, "fi", 0)),
    ((3, 3, "", 0), (2, 0, "a", 1), (10, 0, "a", 1), (5, 5, "", 0), (12, 0, "a", 1), (7, 0, "a", 1)),
    ((5, 0, "ah", 1), (30, 0, "a", 1), (3, 0, "a", 1)),
    ((60, 0, "a", 1), (4, 0, "a", 1), (1, 0, "a", 1)),
    ((2, 0, "ah", 1), (2, 0, "a", 1)),
    ((8, 0, "ah", 1), (90, 0, "a", 1), (5, 0, "ai", 1), (6, 0, "ai", 1)),
    # pages that mark no article but mark their furniture
    ((1, 1, "fi", 0), (1, 1, "fi", 0), (14, 0, "f", 0), (7, 0, "h", 1), (90, 0, "", 1), (30, 0, "", 1),
     (12, 0, "", 1), (60, 6, "", 1), (40, 0, "f", 0), (10, 0, "f", 0)),
    ((20, 0, "f", 0), (9, 0, "h", 1), (25, 5, "", 1), (16, 0, "i", 1), (11, 0, "i", 1), (35, 0, "", 1),
     (120, 0, "f", 0), (3, 3, "f", 0)),
    ((150, 0, "", 1),),
    ((30, 0, "", 1), (11, 0, "", 1)),
    ((5, 0, "h", 1), (70, 0, "", 1), (15, 0, "", 1), (80, 0, "", 1)),
    ((4, 0, "h", 1), (13, 0, "", 1), (6, 0, "h", 1), (45, 0, "", 1), (20, 0, "", 1), (14, 0, "", 1)),
    # pages that mark nothing: menus are links, notices stand next to menus, scraps end the page
    ((1, 1, "i", 0), (2, 2, "i", 0), (1, 1, "i", 0), (14, 1, "", 0), (8, 0, "h", 1), (100, 4, "", 1),
     (25, 0, "", 1), (60, 0, "", 1), (4, 4, "", 0), (5, 0, "", 0)),
    ((2, 2, "", 0), (3, 3, "", 0), (16, 0, "", 0), (6, 0, "h", 1), (55, 0, "", 1), (18, 0, "", 1),
     (40, 30, "", 0), (3, 1, "", 0)),
    ((2, 2, "i", 0), (2, 2, "i", 0), (9, 0, "h", 1), (30, 0, "", 1), (17, 0, "", 1), (22, 8, "", 1),
     (6, 6, "", 0), (8, 7, "", 0), (4, 1, "", 0)),
    ((3, 3, "", 0), (12, 1, "", 0), (70, 0, "", 1), (90, 0, "", 1), (5, 5, "i", 0), (6, 6, "i", 0), (4, 0, "", 0)),
    ((1, 1, "", 0), (1, 1, "", 0), (40, 2, "", 1), (13, 0, "", 1), (2, 2, "", 0), (6, 3, "", 0)),
    ((4, 2, "", 0), (18, 0, "", 0), (5, 0, "h", 1), (28, 0, "", 1), (9, 9, "", 0)),
    ((1, 1, "i", 0), (2, 2, "i", 0), (7, 0, "h", 1), (4, 0, "", 1), (60, 0, "", 1), (17, 0, "", 1)),
    ((3, 3, "", 0), (5, 0, "h", 1), (9, 0, "", 1), (80, 0, "", 1)),
    ((2, 2, "fi", 0), (1, 1, "fi", 0), (6, 0, "h", 1), (8, 0, "h", 1), (45, 0, "", 1), (21, 0, "", 1), (3, 0, "f", 0)),
    ((1, 1, "i", 0), (11, 0, "h", 1), (2, 0, "", 1), (5, 0, "", 1), (33, 0, "", 1)),
    ((24, 24, "", 0), (5, 0, "h", 1), (60, 0, "", 1), (19, 0, "", 1), (32, 31, "", 0)),
    ((40, 38, "", 0), (7, 0, "ah", 1), (33, 0, "a", 1), (21, 20, "a", 0), (55, 0, "", 0)),
    # plain texts, with last paragraphs of any length
    ((5, 0, "h", 1), (120, 0, "", 1), (60, 0, "", 1), (25, 0, "", 1)),
    ((80, 0, "", 1), (45, 0, "", 1), (100, 0, "", 1)),
    ((7, 0, "h", 1), (35, 0, "", 1), (90, 2, "", 1), (12, 0, "", 1)),
    ((3, 0, "h", 1), (60, 0, "", 1), (40, 0, "", 1), (33, 0, "", 1), (75, 0, "", 1), (16, 0, "", 1)),
    ((200, 0, "", 1), (30, 0, "", 1)),
    ((6, 0, "h", 1), (15, 0, "", 1), (10, 0, "", 1), (22, 0, "", 1), (50, 0, "", 1)),
    ((2, 2, "i", 0), (1, 1, "i", 0), (5, 0, "h", 1), (70, 0, "", 1), (35, 0, "", 1), (14, 0, "", 1), (5, 0, "", 0)),
    ((3, 3, "", 0), (7, 0, "h", 1), (90, 0, "", 1), (48, 0, "", 1), (4, 0, "", 0), (3, 1, "", 0)),
    ((2, 2, "i", 0), (3, 3, "i", 0), (13, 0, "", 0), (8, 0, "h", 1), (85, 0, "", 1), (20, 0, "", 1), (6, 0, "", 0)),
    ((1, 1, "i", 0), (2, 2, "i", 0), (65, 0, "", 1), (24, 0, "", 1), (38, 0, "", 1), (5, 2, "", 0)),
)


def labelled(pages=PAGES) -> list[tuple[float, ...]]:
    """The features of all blocks of labelled pages, each with its label at the end."""
    rows = []
    for page in pages:
        found = [
            Block("", words, linked, "a" in at, "f" in at, "h" in at, "i" in at) for words, linked, at, _ in page
        ]
        rows += [(*row, keep) for row, (_, _, _, keep) in zip(features(found), page)]
    return rows


#: Of equally good splits, the one on where a block stands comes first, then its own counts, then its neighbours'.
SPLIT_ORDER = (7, 6, 10, 1, 0, 9, 8, 3, 5, 2, 4)


def train(rows=None, depth: int = 6, least: int = 3):
    """Decision tree by Gini impurity: (feature, threshold, low side, high side) or a class."""

    def gini(part):
        p = sum(r[-1] for r in part) / len(part)
        return len(part) * p * (1 - p)

    rows = labelled() if rows is None else rows
    labels = [r[-1] for r in rows]
    majority = int(2 * sum(labels) >= len(labels))
    if depth == 0 or len(set(labels)) == 1:
        return majority
    best = None
    for f in SPLIT_ORDER:
        values = sorted({r[f] for r in rows})
        for a, b in zip(values, values[1:]):
            cut = (a + b) / 2
            low, high = [r for r in rows if r[f] <= cut], [r for r in rows if r[f] > cut]
            if min(len(low), len(high)) < least:
                continue
            value = gini(low) + gini(high)
            if best is None or value < best[0] - 1e-12:
                best = (value, f, cut, low, high)
    if best is None or best[0] >= gini(rows) - 1e-12:
        return majority
    _, f, cut, low, high = best
    return f, cut, train(low, depth - 1, least), train(high, depth - 1, least)


def classify(tree, row) -> int:
    while not isinstance(tree, int):
        feature, cut, low, high = tree
        tree = low if row[feature] <= cut else high
    return tree


def main_text(page: str | None, tree) -> str:
    found = blocks(page or "")
    return "\n".join(b.text for b, row in zip(found, features(found)) if classify(tree, row))


def extract(pages: DataFrame) -> DataFrame:
    """(page_id, url, text, n_chars) of every page."""
    tree = train()

    def work(block):
        texts = [main_text(p, tree) for p in block.column(2).to_pylist()]
        return pa.RecordBatch.from_arrays(
            [
                block.column(0), block.column(1).cast(pa.string()), pa.array(texts, pa.string()),
                pa.array([len(t) for t in texts], pa.int64()),
            ],
            ["page_id", "url", "text", "n_chars"],
        )

    rows = pages.selectExpr("cast(page_id as bigint) page_id", "url", "html")
    return map_blocks(rows, "html", work, "page_id bigint, url string, text string, n_chars bigint")
