"""Main text of web pages from flat text blocks and a decision tree.

A page is cut into blocks at block-level tags; inline markup and `<br>` do not end a block, comments,
scripts, styles and the head give none. A block has its word count and link density (share of its
words inside links), those of the blocks before and after it, and the zone that it stands in: 2 inside
an element that is boilerplate by its kind or by its class or id (menus, headers and footers of the
page, sidebars, forms, notices, adverts, comments of readers; a name that only speaks of such a part,
like no-sidebar or comments-open, makes nothing boilerplate), else 1 inside the article or main
element, else 0. A decision tree (CART, Gini index), trained in numpy on the labelled blocks below,
says which blocks are main text; they are joined in page order.

Null and empty pages give an empty text. Unclosed and stray tags are tolerated: a closing tag ends
the nearest open element of its name, however deep, block elements end an open paragraph, and items of
lists, cells, rows and options end the one before them in the same list or table. The head ends where
something begins that cannot stand in it. The places of open elements are kept by name, so a tag costs
the same at any depth. Pages are handled one by one, so repeated rows, missing ids and other columns
change nothing; one page is in memory as text.
"""

from __future__ import annotations

import html
import re
from collections import defaultdict
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

#: Names of elements and words of classes and ids.
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer "
    "form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol optgroup option p pre section summary table tbody "
    "td tfoot th thead tr ul".split()
)
SKIPPED = frozenset("head noscript iframe object svg math canvas select datalist button template audio video map dialog".split())
RAW = frozenset("script style textarea title xmp noembed noframes".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
IN_HEAD = frozenset("base basefont bgsound command head html link meta noframes noscript script style template title".split())
# Blocks that an item of a list does not look through for the item before it.
FENCES = (BLOCKS | SKIPPED) - frozenset("address div p".split())
ITEMS = {"li": frozenset(["li"]), "dt": frozenset(["dt", "dd"]), "dd": frozenset(["dt", "dd"])}
#: What a tag ends, and the elements outside of which nothing is ended.
_GROUP = (("caption", "tbody", "thead", "tfoot", "tr", "td", "th"), ("table",))
ENDS = {
    "td": (("td", "th"), ("table",)),
    "th": (("td", "th"), ("table",)),
    "tr": (("caption", "tr", "td", "th"), ("table",)),
    "tbody": _GROUP,
    "thead": _GROUP,
    "tfoot": _GROUP,
    "option": (("option",), ("select", "datalist", "optgroup")),
    "optgroup": (("option", "optgroup"), ("select",)),
}
ASIDE_TAGS = frozenset("nav footer aside form menu dialog".split())
MAIN_TAGS = frozenset("article main".split())
ASIDE_WORDS = frozenset(
    "ad ads advert advertisement adverts advertising banner breadcrumb breadcrumbs byline comment comments commentlist consent "
    "cookie cookies copyright disclaimer discussion disqus footer gdpr header masthead menu nav navbar navigation newsletter "
    "notice notices pager pagination popup promo promoted promotion related replies reply respond share sharing sidebar "
    "signup skip social sponsor sponsored subscribe tags teaser toolbar widget".split()
)
MAIN_WORDS = frozenset("article content entry post story main body text".split())
#: Words of a name that say where or how something stands, not what it is.
PLAIN_WORDS = frozenset(
    "area bar block body bottom box column container content group icons inner item items left links list outer panel right row "
    "section site top wrap wrapper".split()
)
#: What begins or ends the name of a state of a page, such as no-sidebar or comments-open.
STATE_BEGINS = frozenset("has hide is no not show with without".split())
STATE_ENDS = frozenset("active closed collapsed disabled enabled expanded false hidden layout off on open true visible".split())
#: Words that make what follows boilerplate, such as related-stories.
LEADING_WORDS = frozenset(
    "ad ads advert advertisement advertising breadcrumb breadcrumbs comment comments cookie cookies gdpr newsletter promo promoted "
    "related sponsor sponsored".split()
)

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?\]\]>|<[!?][^>]*>?|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)>", re.DOTALL
)
_LOOSE = re.compile(r"<(/?)([a-zA-Z][a-zA-Z0-9:-]*)([^>]*)>")
_NAMES = re.compile(r"\b(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.IGNORECASE)
_MAY_HIDE = re.compile(r"hidden|style", re.IGNORECASE)
_ATTRIBUTE = re.compile(r"([^\s/>=]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]*)))?")
_CSS_COMMENT = re.compile(r"/\*.*?(?:\*/|\Z)", re.DOTALL)
_WORD = re.compile(r"[A-Za-z]+")
_CAMEL = re.compile(r"([a-z])([A-Z])")


class Block(NamedTuple):
    text: str
    words: int
    linked: int
    zone: int


def _zone(name: str, attributes: str, around: int) -> int:
    if around == 2:
        return 2
    if name in ASIDE_TAGS or (name == "header" and around == 0):
        return 2
    zone = 1 if name in MAIN_TAGS else around
    if attributes and "=" in attributes and name not in ("html", "body"):
        for m in _NAMES.finditer(attributes):
            for token in (m[1] or m[2] or m[3] or "").split():
                words = [w.lower() for w in _WORD.findall(_CAMEL.sub(r"\1 \2", token))]
                if name not in MAIN_TAGS and _names_boilerplate(words):
                    return 2
                if not MAIN_WORDS.isdisjoint(words):
                    zone = 1
    return zone


def _names_boilerplate(words: list[str]) -> bool:
    """Whether a class or id, as its words, names boilerplate: by its last word that is not plain
    (side-menu, comment-list; not social-science), or by a leading one (related-stories). The name of a
    state (with-sidebar, share-enabled) names nothing."""
    if not words or words[0] in STATE_BEGINS or words[-1] in STATE_ENDS:
        return False
    head = next((w for w in reversed(words) if w not in PLAIN_WORDS), "")
    return head in ASIDE_WORDS or words[0] in LEADING_WORDS


def _hidden(attributes: str) -> bool:
    """The attribute hidden, aria-hidden=true or a style that ends with display:none; the first of equal names counts."""
    if not _MAY_HIDE.search(attributes):
        return False
    values: dict[str, str] = {}
    for m in _ATTRIBUTE.finditer(attributes):
        values.setdefault(m[1].lower(), m[2] or m[3] or m[4] or "")
    if "hidden" in values or html.unescape(values.get("aria-hidden", "")).strip().lower() == "true":
        return True
    shown, fixed = "", False
    for declaration in _CSS_COMMENT.sub(" ", html.unescape(values.get("style", ""))).lower().split(";"):
        name, _, value = declaration.partition(":")
        value, important, _ = value.partition("!")
        if name.strip() == "display" and (important or not fixed):
            shown, fixed = value.strip(), bool(important)
    return shown == "none"


def blocks_of(page: str) -> list[Block]:
    """The text blocks of a page in order."""
    out: list[Block] = []
    stack: list[tuple[str, int, bool, bool]] = []  # name, zone, inside a link, left out
    opened: defaultdict[str, list[int]] = defaultdict(list)  # places in the stack, by name
    blocks: list[int] = []  # places of blocks
    fences: list[int] = []
    parts: list[str] = []
    linked: list[str] = []

    def end_from(at: int) -> None:
        for name, *_ in reversed(stack[at:]):
            opened[name].pop()
        del stack[at:]
        for places in (blocks, fences):
            while places and places[-1] >= at:
                places.pop()

    def last(name: str) -> int:
        places = opened.get(name)
        return places[-1] if places else -1

    def state() -> tuple[int, bool, bool]:
        return stack[-1][1:] if stack else (0, False, False)

    def end_block() -> None:
        if parts:
            text = " ".join(html.unescape("".join(parts)).split())
            if text:
                out.append(Block(text, len(text.split()), len(html.unescape(" ".join(linked)).split()), state()[0]))
            parts.clear()
            linked.clear()

    def say(text: str) -> None:
        if stack and stack[-1][0] == "head" and text.strip():
            end_from(len(stack) - 1)
        _, link, out_of_it = state()
        if text and not out_of_it:
            parts.append(text)
            if link:
                linked.append(text)

    at = 0
    lower = None
    size = len(page)
    while at < size:
        begin = page.find("<", at)
        if begin < 0:
            say(page[at:])
            break
        if begin > at:
            say(page[at:begin])
        token = _TOKEN.match(page, begin) or _LOOSE.match(page, begin)
        if token is None:  # a bare "<", or a tag that the end of the page cuts off
            rest = page[begin + 1 : begin + 2]
            if (rest.isalpha() or rest == "/") and page.find(">", begin) < 0:
                break
            say("<")
            at = begin + 1
            continue
        at = token.end()
        name = (token[2] or "").lower() if token.lastindex else ""
        if not name:
            continue
        if token[1]:
            if name in BLOCKS or name in SKIPPED:
                end_block()
            if last(name) >= 0:
                end_from(last(name))
            continue
        if last("head") >= 0 and (name == "body" or (stack[-1][0] == "head" and name not in IN_HEAD)):
            end_block()
            end_from(last("head"))
        if name in RAW:
            if lower is None:
                lower = page.lower() if len(page.lower()) == size else page
            close = lower.find(f"</{name}", at)
            if close < 0:
                break
            after = page.find(">", close)
            at = size if after < 0 else after + 1
            continue
        if name == "br":
            say(" ")
            continue
        if name in BLOCKS:
            end_block()
            # A block ends an open paragraph; what was open inside it ends with it.
            if blocks and stack[blocks[-1]][0] == "p":
                end_from(blocks[-1])
            if name in ITEMS and fences and stack[fences[-1]][0] in ITEMS[name]:
                end_from(fences[-1])
            elif name in ENDS:
                ended, around = ENDS[name]
                floor = max(map(last, around))
                inside = [k for k in map(last, ended) if k > floor]
                if inside:
                    end_from(min(inside))
        if name in VOID or token[3].endswith("/"):
            continue
        zone, link, out_of_it = state()
        inner = _zone(name, token[3], zone) if name in BLOCKS or name in MAIN_TAGS or name == "span" else zone
        hide = name in SKIPPED or bool(token[3]) and _hidden(token[3])
        if hide and not out_of_it:
            end_block()
        opened[name].append(len(stack))
        if name in BLOCKS:
            blocks.append(len(stack))
        if name in FENCES:
            fences.append(len(stack))
        stack.append((name, inner, link or name == "a", out_of_it or hide))
    end_block()
    return out


def features(blocks: list[Block]) -> np.ndarray:
    """words, link density, the same of the block before and after, zone."""
    own = np.array([(b.words, b.linked / max(b.words, 1)) for b in blocks], float).reshape(-1, 2)
    around = np.vstack([np.zeros((1, 2)), own, np.zeros((1, 2))])
    zones = np.array([[b.zone] for b in blocks], float).reshape(-1, 1)
    return np.hstack([own, around[:-2], around[2:], zones])


#: Labelled blocks: words, link density, of the block before, of the one after, zone, main text or not.
LABELLED = """
12 0.0 0 0.0 45 0.0 1 1
8 0.0 3 1.0 60 0.0 1 1
3 0.0 5 1.0 20 0.0 1 1
1 0.0 40 0.0 12 0.0 1 1
2 0.0 70 0.0 30 0.0 1 1
45 0.0 12 0.0 80 0.0 1 1
80 0.05 45 0.0 60 0.0 1 1
200 0.02 80 0.1 90 0.0 1 1
60 0.0 90 0.0 0 0.0 1 1
25 0.2 60 0.0 30 0.1 1 1
15 0.3 40 0.0 55 0.0 1 1
30 0.0 20 0.0 8 1.0 1 1
6 0.0 6 0.0 6 0.0 1 1
9 0.1 14 0.0 11 0.1 1 1
5 0.0 110 0.0 9 0.0 1 1
8 0.0 40 0.0 1 1.0 1 1
5 0.0 60 0.0 2 0.5 1 1
3 0.0 80 0.0 0 0.0 1 1
12 0.0 30 0.0 3 0.0 1 1
2 0.0 30 0.0 2 1.0 1 1
4 0.0 1 0.0 1 0.0 1 1
10 0.1 6 0.3 3 0.6 1 1
7 0.0 2 0.5 8 0.4 1 1
11 0.18 3 0.0 12 0.0 1 1
14 0.25 20 0.0 9 0.0 1 1
22 0.33 5 0.0 6 0.0 1 1
9 0.22 8 0.0 7 0.0 1 1
30 0.3 12 0.1 10 0.2 1 1
18 0.4 25 0.0 15 0.1 1 1
3 1.0 2 1.0 60 0.0 1 0
5 0.9 30 0.0 80 0.0 1 0
6 0.7 50 0.0 40 0.0 1 0
2 1.0 1 1.0 2 1.0 1 0
1 1.0 1 1.0 1 1.0 1 0
4 1.0 60 0.0 4 1.0 1 0
6 0.9 4 1.0 5 1.0 1 0
10 0.8 30 0.0 12 0.9 1 0
1 1.0 0 0.0 1 1.0 2 0
1 1.0 1 1.0 1 1.0 2 0
1 1.0 1 1.0 9 0.0 2 0
9 0.0 1 1.0 14 0.0 2 0
14 0.0 1 1.0 10 0.0 2 0
30 0.0 60 0.0 2 1.0 2 0
60 0.0 80 0.0 20 0.0 2 0
120 0.0 90 0.0 40 0.0 2 0
12 0.0 50 0.0 0 0.0 2 0
7 0.3 90 0.0 0 0.0 2 0
20 0.2 3 0.0 18 0.1 2 0
5 0.0 2 0.0 4 0.0 2 0
200 0.0 10 0.0 0 0.0 2 0
2 0.5 30 0.0 3 0.6 2 0
40 0.0 10 0.0 70 0.0 0 1
70 0.02 40 0.0 90 0.0 0 1
150 0.05 60 0.0 30 0.0 0 1
28 0.0 90 0.0 70 0.0 0 1
18 0.0 60 0.0 40 0.0 0 1
90 0.1 3 1.0 5 1.0 0 1
35 0.1 50 0.0 2 1.0 0 1
8 0.0 2 1.0 60 0.0 0 1
5 0.0 50 0.0 70 0.0 0 1
1 1.0 0 0.0 1 1.0 0 0
2 1.0 2 1.0 2 1.0 0 0
3 0.8 2 1.0 4 0.9 0 0
12 0.7 3 1.0 10 0.8 0 0
25 0.6 8 1.0 20 0.7 0 0
40 0.5 12 0.9 10 0.9 0 0
4 1.0 2 1.0 60 0.0 0 0
8 0.7 4 1.0 90 0.0 0 0
3 0.9 0 0.0 120 0.0 0 0
12 0.5 3 0.8 70 0.0 0 0
6 0.0 0 0.0 7 0.0 0 1
7 0.0 6 0.0 0 0.0 0 1
5 0.0 0 0.0 9 0.0 0 1
9 0.0 5 0.0 0 0.0 0 1
12 0.0 0 0.0 0 0.0 0 1
6 0.0 12 0.0 14 0.0 0 1
14 0.0 6 0.0 8 0.0 0 1
4 0.0 0 0.0 20 0.0 0 1
5 0.0 0 0.0 5 0.0 0 1
10 0.0 2 1.0 1 1.0 0 1
4 0.0 2 1.0 3 1.0 0 0
3 0.0 3 0.0 2 0.0 0 0
6 0.3 2 1.0 3 0.5 0 0
7 0.0 1 1.0 4 0.0 0 0
9 0.0 80 0.0 2 1.0 0 0
8 0.2 0 0.0 3 1.0 0 0
10 0.0 4 0.5 6 0.5 0 0
"""


class Tree(NamedTuple):
    feature: np.ndarray  # -1 in a leaf
    at_most: np.ndarray
    yes: np.ndarray
    no: np.ndarray
    main: np.ndarray


def train_tree(rows: np.ndarray, labels: np.ndarray, depth: int = 10) -> Tree:
    """A binary decision tree by Gini index; ties go to the first feature and the smallest cut."""
    nodes: list[list[float]] = []

    def gini(count: np.ndarray, positive: np.ndarray) -> np.ndarray:
        share = positive / np.maximum(count, 1)
        return count * 2 * share * (1 - share)

    def grow(at: np.ndarray, left: int) -> int:
        mine = len(nodes)
        nodes.append([-1, 0.0, -1, -1, float(labels[at].mean() >= 0.5)])
        best = (gini(np.array(len(at)), labels[at].sum()) - 1e-9, -1, 0.0)
        if left and 0 < labels[at].mean() < 1:
            for f in range(rows.shape[1]):
                order = at[np.argsort(rows[at, f], kind="stable")]
                value, positive = rows[order, f], np.cumsum(labels[order])
                cut = np.flatnonzero(value[1:] > value[:-1])
                if not len(cut):
                    continue
                low = cut + 1
                cost = gini(low, positive[cut]) + gini(len(at) - low, positive[-1] - positive[cut])
                k = int(cost.argmin())
                if cost[k] < best[0]:
                    best = (float(cost[k]), f, float((value[cut[k]] + value[cut[k] + 1]) / 2))
        if best[1] >= 0:
            under = rows[at, best[1]] <= best[2]
            nodes[mine][:2] = best[1:]
            nodes[mine][2] = grow(at[under], left - 1)
            nodes[mine][3] = grow(at[~under], left - 1)
        return mine

    grow(np.arange(len(rows)), depth)
    table = np.array(nodes)
    return Tree(table[:, 0].astype(int), table[:, 1], table[:, 2].astype(int), table[:, 3].astype(int), table[:, 4] > 0)


def is_main(tree: Tree, rows: np.ndarray) -> np.ndarray:
    node = np.zeros(len(rows), int)
    every = np.arange(len(rows))
    while (tree.feature[node] >= 0).any():
        feature = tree.feature[node]
        under = rows[every, np.maximum(feature, 0)] <= tree.at_most[node]
        node = np.where(feature < 0, node, np.where(under, tree.yes[node], tree.no[node]))
    return tree.main[node]


def default_tree() -> Tree:
    table = np.array([[float(x) for x in line.split()] for line in LABELLED.strip().splitlines()])
    return train_tree(table[:, :-1], table[:, -1])


def main_text(page: str | None, tree: Tree) -> str:
    blocks = blocks_of(page or "")
    if not blocks:
        return ""
    return "\n".join(b.text for b, keep in zip(blocks, is_main(tree, features(blocks)), strict=True) if keep)


def extract(pages: DataFrame) -> DataFrame:
    """page_id, url, text, n_chars for every page."""
    tree = default_tree()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first in range(0, batch.num_rows, 256):
                part = batch.slice(first, 256)
                texts = [main_text(page.as_py(), tree) for page in part.column("html")]
                columns = [
                    part.column("page_id").cast(pa.int64()),
                    part.column("url").cast(pa.string()),
                    pa.array(texts, pa.string()),
                    pa.array(map(len, texts), pa.int64()),
                ]
                yield pa.RecordBatch.from_arrays(columns, ["page_id", "url", "text", "n_chars"])

    return pages.select("page_id", "url", "html").mapInArrow(run, "page_id long, url string, text string, n_chars long")
