"""The main text of web pages: flat text blocks, classified by a decision tree.

A page is cut into blocks at block-level tags. Each has its number of words and the share of
them within links, and those of the blocks before and behind it; besides, whether it stands within
an article element (or the page has one elsewhere), and whether an element around it is a menu,
header, footer, sidebar, notice, advert, form or reader comment by its tag, class, id or role. An article
element within a form, or within a wrapper that only its class names after one of these, counts as an article. A
tree, grown on a small labelled table, decides about each block.

Scripts, styles, titles and comments of the markup are never text. White space in a block
becomes one space, blocks that are kept are joined by an empty line; nothing else is dropped. Null
and empty pages, and pages without text, give an empty text. Rows are judged each.
"""

from __future__ import annotations

import html
import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .common import small_batches

TAG = re.compile(
    r"""<!--(?:.*?-->|.*\Z)|<[!?][^>]*+>|<(?P<close>/?)(?P<name>[a-zA-Z][^\s/>]*+)(?P<attr>(?:[^>"']++|"[^"]*+"|'[^']*+')*+)>|<(?P<close2>/?)(?P<name2>[a-zA-Z][^\s/>]*+)(?P<attr2>[^>]*+)>""",
    re.DOTALL,
)
ATTRIBUTE = re.compile(r"""\b(class|id|role|hidden|aria-hidden|itemprop)\b(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""", re.IGNORECASE)
#: Elements whose content is not text of the page.
RAW = frozenset("script style title noscript template iframe svg math canvas object audio video select textarea button datalist".split())
#: Of these, the ones that may be closed in themselves, and the ones that go to the end of the page where nothing closes them.
FOREIGN, SWALLOWS = frozenset({"svg", "math"}), frozenset("script style title textarea noscript".split())
BLOCK = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol p pre section summary table tbody td tfoot th thead tr ul".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: An open element of the first kind ends where one of the others begins.
ENDS = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr"}, "td": {"td", "th", "tr"}, "th": {"td", "th", "tr"}}
MAIN = frozenset({"article", "main"})
ASIDE = frozenset("nav aside footer form menu dialog fieldset".split())
#: Parts of class names and ids of what is not the article.
HINTS = frozenset(
    "ad ads adv advert adverts advertisement advertising adsense banner promo promotion sponsor sponsored teaser "
    "nav navbar navigation menu breadcrumb breadcrumbs pagination pager toolbar sidebar aside rail widget header masthead footer copyright "
    "cookie cookies consent gdpr notice alert popup modal overlay newsletter subscribe subscription signup login register search form "
    "comment comments reply replies respond disqus discussion share sharing social related recommended trending tags".split()
)
#: Words of class names of what holds text, and of mere boxes: "post-comments" are comments, a "content-sidebar-wrap" holds both, "search-result" is a result.
CONTENT = frozenset("article content post entry story text body main page news result results blog".split())
BOXES = frozenset("wrap wrapper container box area section inner outer block group holder layout row col column".split())
TALK = frozenset("comment comments reply replies respond disqus discussion".split())
#: Where an element stands: within the article; neither; within a form or what its class tells; within a menu, footer and the like; among comments; hidden.
ARTICLE, OPEN, SOFT, HARD, TALKED, HIDDEN = 1, 0, -1, -2, -3, -4
MAIN_HINTS = frozenset("comment comments reply ad advert teaser related".split())
ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert menu menubar".split())
WORD = re.compile(r"\S+")


@dataclass
class Block:
    text: str
    words: int
    linked: int
    zone: int  # 1 within the article, -1 within something that is not the article, 0 neither

    @property
    def density(self) -> float:
        return self.linked / self.words if self.words else 0.0


def _noise(names: str, hints: frozenset) -> str:
    """The word of a class or id that tells what is not the article, or nothing."""
    tokens = names.lower().split()
    found = ""
    for token in tokens:
        parts = [p for p in re.split(r"[^a-z]+", token) if p]
        boxed = len(parts)
        while parts and parts[-1] in BOXES:
            parts.pop()
        if not parts or parts[-1] not in hints or (len(parts) < boxed and CONTENT.intersection(parts)):
            continue
        if parts[-1] in TALK:
            return parts[-1]
        found = parts[-1]
    return "" if CONTENT.intersection(tokens) else found


def _zone(name: str, attributes: str, parent: int, article_seen: bool) -> int:
    """Where an element's text stands. An article resets what a form or a class says, and comments before the first article."""
    given = {m[1].lower(): next((g for g in m.groups()[1:] if g is not None), "") for m in ATTRIBUTE.finditer(attributes)} if attributes else {}
    role = given.get("role", "").lower()
    if parent == HIDDEN or "hidden" in given or given.get("aria-hidden", "").lower() == "true":
        return HIDDEN
    names = given.get("class", "") + " " + given.get("id", "")
    if name in MAIN or role in ("main", "article") or "articleBody" in given.get("itemprop", ""):
        noise = _noise(names, MAIN_HINTS)
        if noise:
            return min(parent, TALKED if noise in TALK else HARD)
        return parent if parent == HARD or (parent == TALKED and article_seen) else ARTICLE
    if parent < 0:
        return parent
    if name in ("form", "fieldset") or role in ("search", "form"):
        return SOFT
    if name in ASIDE or role in ROLES or (name == "header" and parent == OPEN):
        return HARD
    if name not in ("html", "body"):
        noise = _noise(names, HINTS)
        if noise:
            return TALKED if noise in TALK else SOFT
    return parent


def blocks(page: str) -> list[Block]:
    """All text blocks of a page, in order."""
    out: list[Block] = []
    stack: list[tuple[str, int]] = []
    parts: list[tuple[str, bool]] = []
    link = 0  # depth at which the open link began, from 1
    article_seen = False
    at, size = 0, len(page)

    def flush() -> None:
        if parts:
            whole = html.unescape("".join(t for t, _ in parts))
            text = " ".join(whole.split())
            if text:
                linked = sum(len(WORD.findall(html.unescape(t))) for t, a in parts if a)
                words = len(WORD.findall(text))
                out.append(Block(text, words, min(linked, words), max(stack[-1][1], -1) if stack else OPEN))
            parts.clear()

    while at < size:
        m = TAG.search(page, at)
        if not m:
            parts.append((page[at:], link > 0))
            break
        if m.start() > at:
            parts.append((page[at : m.start()], link > 0))
        at = m.end()
        name = (m["name"] or m["name2"] or "").lower()
        if not name:
            continue
        closing = bool(m["close"] or m["close2"])
        attributes = m["attr"] or m["attr2"] or ""
        if name in RAW and not closing:
            if not (name in FOREIGN and attributes.endswith("/")):
                end = re.compile(rf"</{re.escape(name)}\b[^>]*>", re.IGNORECASE).search(page, at)
                at = end.end() if end else size if name in SWALLOWS else at
            parts.append((" ", False))
        elif name == "a":
            link = 0 if closing else len(stack) + 1
        elif name == "br":
            parts.append((" ", False))
        elif name in BLOCK:
            flush()
            if closing:
                depth = next((i for i in range(len(stack) - 1, -1, -1) if stack[i][0] == name), None)
                if depth is not None:
                    del stack[depth:]
            elif name not in VOID:
                while stack and (stack[-1][0] == "p" or name in ENDS.get(stack[-1][0], ())):
                    stack.pop()
                stack.append((name, _zone(name, attributes, stack[-1][1] if stack else OPEN, article_seen)))
                article_seen = article_seen or stack[-1][1] == ARTICLE
            if link > len(stack) + 1:  # the block in which it began has ended
                link = 0
    flush()
    return out


#: words, link density; the same of the block before and of the one behind; zone; the page has an article and the block is outside.
FEATURES = ("words", "density", "words_before", "density_before", "words_behind", "density_behind", "zone", "outside")
#: The labelled table that the tree is grown on; the last number says whether the block is main text.
LABELLED = (
    # within the article, whatever the length
    (120, 0.00, 80, 0.0, 95, 0.0, 1, 0, 1), (45, 0.05, 120, 0.0, 60, 0.0, 1, 0, 1), (8, 0.00, 0, 0.0, 120, 0.0, 1, 0, 1), (3, 0.00, 60, 0.0, 45, 0.0, 1, 0, 1),
    (1, 0.00, 90, 0.0, 2, 0.0, 1, 0, 1), (12, 0.40, 70, 0.1, 80, 0.0, 1, 0, 1), (6, 1.00, 70, 0.1, 80, 0.0, 1, 0, 1), (2, 0.00, 0, 0.0, 0, 0.0, 1, 0, 1), (25, 0.00, 2, 1.0, 4, 1.0, 1, 0, 1),
    (2, 0.50, 1, 0.0, 9, 0.0, 1, 0, 1), (5, 1.00, 3, 1.0, 4, 1.0, 1, 0, 1), (10, 0.60, 5, 0.8, 12, 0.7, 1, 0, 1), (1, 1.00, 1, 1.0, 1, 1.0, 1, 0, 1), (4, 0.75, 9, 1.0, 2, 0.5, 1, 0, 1), (3, 1.00, 0, 0.0, 0, 0.0, 1, 0, 1),
    (2, 0.50, 2, 1.0, 2, 1.0, 1, 0, 1), (1, 0.00, 1, 1.0, 1, 1.0, 1, 0, 1), (7, 0.85, 1, 1.0, 3, 1.0, 1, 0, 1), (15, 0.90, 20, 0.9, 11, 1.0, 1, 0, 1),
    # within menus, footers, adverts and the like, whatever the length
    (1, 1.00, 0, 0.0, 1, 1.0, -1, 0, 0), (3, 1.00, 2, 1.0, 4, 1.0, -1, 0, 0), (14, 0.10, 90, 0.0, 0, 0.0, -1, 0, 0), (60, 0.00, 80, 0.0, 70, 0.0, -1, 0, 0), (150, 0.00, 40, 0.0, 30, 0.0, -1, 0, 0),
    (9, 0.00, 5, 1.0, 12, 0.0, -1, 0, 0), (1, 1.00, 1, 1.0, 8, 0.0, -1, 1, 0), (12, 0.00, 1, 1.0, 9, 0.0, -1, 1, 0), (70, 0.00, 60, 0.0, 0, 0.0, -1, 1, 0),
    # beside an article
    (40, 0.00, 100, 0.0, 5, 0.0, 0, 1, 0), (6, 0.50, 100, 0.0, 3, 0.5, 0, 1, 0), (18, 0.00, 4, 1.0, 90, 0.0, 0, 1, 0), (90, 0.02, 0, 0.0, 100, 0.0, 0, 1, 0),
    # pages that mark no article: long text with few links, and what stands between such blocks
    (110, 0.02, 90, 0.0, 70, 0.0, 0, 0, 1), (60, 0.00, 5, 0.0, 40, 0.0, 0, 0, 1), (35, 0.10, 50, 0.0, 30, 0.1, 0, 0, 1), (22, 0.00, 6, 0.0, 24, 0.0, 0, 0, 1), (9, 0.00, 45, 0.0, 60, 0.0, 0, 0, 1),
    (4, 0.00, 60, 0.0, 80, 0.0, 0, 0, 1), (2, 0.00, 40, 0.0, 33, 0.0, 0, 0, 1), (1, 0.00, 22, 0.0, 51, 0.0, 0, 0, 1), (7, 0.00, 0, 0.0, 75, 0.0, 0, 0, 1), (11, 0.00, 55, 0.0, 0, 0.0, 0, 0, 1),
    (5, 0.00, 3, 0.0, 30, 0.0, 0, 0, 1), (6, 0.00, 30, 0.0, 4, 0.0, 0, 0, 1), (8, 0.00, 0, 0.0, 9, 0.0, 0, 0, 1), (10, 0.00, 0, 0.0, 0, 0.0, 0, 0, 1),
    (50, 0.00, 2, 1.0, 40, 0.0, 0, 0, 1), (80, 0.00, 1, 1.0, 60, 0.0, 0, 0, 1), (30, 0.03, 4, 1.0, 55, 0.0, 0, 0, 1), (6, 0.00, 2, 1.0, 80, 0.0, 0, 0, 1), (5, 0.00, 1, 1.0, 65, 0.0, 0, 0, 1), (45, 0.00, 3, 0.9, 2, 1.0, 0, 0, 1), (26, 0.05, 6, 0.8, 3, 0.7, 0, 0, 1),
    # pages that mark no article: links
    (1, 1.00, 0, 0.0, 1, 1.0, 0, 0, 0), (2, 1.00, 1, 1.0, 2, 1.0, 0, 0, 0), (4, 1.00, 3, 1.0, 60, 0.0, 0, 0, 0), (9, 0.70, 5, 1.0, 4, 1.0, 0, 0, 0), (20, 0.60, 12, 0.8, 16, 0.7, 0, 0, 0),
    (3, 0.00, 2, 1.0, 2, 1.0, 0, 0, 0), (12, 0.50, 50, 0.0, 3, 1.0, 0, 0, 0), (5, 0.80, 70, 0.0, 60, 0.0, 0, 0, 0), (4, 0.00, 1, 1.0, 3, 0.9, 0, 0, 0), (2, 0.00, 4, 0.8, 3, 1.0, 0, 0, 0),
)


@dataclass
class Node:
    feature: int = -1
    limit: float = 0.0
    low: Node | None = None
    high: Node | None = None
    label: int = 0


def grow(rows: np.ndarray, depth: int = 8) -> Node:
    """A tree of the lowest Gini impurity at each split; ``rows`` have the label last."""
    y = rows[:, -1]
    node = Node(label=int(2 * y.sum() >= len(y)))
    if not depth or y.min() == y.max():
        return node
    best = None
    for f in range(rows.shape[1] - 1):
        values = np.unique(rows[:, f])
        for limit in (values[:-1] + values[1:]) / 2:
            low = rows[:, f] <= limit
            a, b = y[low], y[~low]
            impurity = sum(len(p) * p.mean() * (1 - p.mean()) for p in (a, b))
            if best is None or impurity < best[0] - 1e-12:
                best = (impurity, f, limit, low)
    if best is None:
        return node
    _, node.feature, node.limit, low = best
    node.low, node.high = grow(rows[low], depth - 1), grow(rows[~low], depth - 1)
    return node


def decide(node: Node, x: tuple) -> int:
    while node.feature >= 0:
        node = node.low if x[node.feature] <= node.limit else node.high
    return node.label


def features(found: list[Block]) -> list[tuple]:
    article = any(b.zone > 0 for b in found)
    none = Block("", 0, 0, 0)
    return [
        (b.words, b.density, a.words, a.density, c.words, c.density, b.zone, int(article and b.zone <= 0))
        for a, b, c in zip([none, *found[:-1]], found, [*found[1:], none])
    ]


def main_text(page: str, tree: Node) -> str:
    found = blocks(page)
    return "\n\n".join(b.text for b, x in zip(found, features(found)) if decide(tree, x))


def extract(pages: DataFrame) -> DataFrame:
    """page_id, url, text, n_chars of every row of page_id, url, html."""
    tree = grow(np.array(LABELLED, dtype=float))
    pages = small_batches(pages.select("page_id", "url", "html"))
    kinds = dict(pages.dtypes)

    def run(batches):
        for batch in batches:
            texts = [main_text(p or "", tree) for p in batch.column("html").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string()), pa.array(list(map(len, texts)), pa.int64())], names=["page_id", "url", "text", "n_chars"])

    return pages.mapInArrow(run, f"page_id {kinds['page_id']}, url {kinds['url']}, text string, n_chars long")
