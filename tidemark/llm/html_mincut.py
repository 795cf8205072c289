"""Main text of web pages by minimum cut.

A page becomes a row of text blocks. A classifier says how much each block looks
like content or like boilerplate, and these costs are the capacities to the two
terminals. Blocks that follow each other, and blocks with the same parent, are
joined by edges whose capacity falls with their distance in the DOM: it costs
that much to label them differently. The minimum cut of this graph, found by
maximum flow, is the labelling of least cost.

The classifier adds what a page's own markup says of a block (its containers'
tags, classes and roles) and a logistic regression on the block's text and shape,
trained on blocks whose markup is plain, from a bounded sample of pages. Tags and
roles that name content or boilerplate, and the words of adverts, cookies and
comments, settle a block. Other words in classes, forms and headers are marks that
text and links can outweigh: a whole article in ``<div class="legal">`` is content.
"""

from __future__ import annotations

import html
import re
from collections import Counter, deque
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from tidemark.llm.common import by_value, col, least_hashed, mapped, own

by_value(__name__)

BLOCK = set(
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure "
    "footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol p pre section summary "
    "table tbody td tfoot th thead tr ul caption optgroup".split()
)
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
#: Never text of the page.
HIDDEN = set(
    "script style noscript template iframe svg canvas object audio video head title select option textarea "
    "button datalist".split()
)
#: Their content is no markup.
RAW = set("script style textarea title iframe noscript".split())
#: A start tag of the first kind ends an open element of the second.
ENDS = {
    "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"},
    "th": {"td", "th"}, "option": {"option"},
}
#: Elements within which the rule above looks.
SCOPE = set("table ul ol dl article section main aside nav footer header body div blockquote".split())
MAIN_TAGS = {"article", "main"}
ASIDE_TAGS = {"nav", "aside", "footer", "menu", "dialog"}
ASIDE_ROLES = {
    "navigation", "banner", "contentinfo", "complementary", "search", "form", "menu", "menubar", "toolbar",
    "dialog", "alert", "alertdialog", "status", "tablist",
}
#: Words in class and id.
FIRM = set(
    "ad ads advert adverts advertisement advertising sponsor sponsored sponsors promo promoted promotion cookie "
    "cookies consent gdpr comment comments commentlist disqus reply replies respond discussion".split()
)
ASIDE_WORDS = set(
    "nav navbar navigation menu menus sidebar side rail footer foot masthead topbar toolbar breadcrumb breadcrumbs "
    "pagination pager share sharing social related recommended recommendations recirculation popular trending "
    "newsletter subscribe subscription signup login search widget widgets banner notice notices alert popup modal "
    "overlay copyright legal skip tags teaser teasers outbrain taboola feedback survey poll toc".split()
)
MAIN_WORDS = set("article content post entry story main body text maintext articlebody".split())
TAG = re.compile(
    r"<!--.*?(?:-->|$)|<!\[CDATA\[.*?(?:\]\]>|$)|<[!?][^>]*(?:>|$)"
    r"|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)(?:>|$)",
    re.S,
)
ATTRIBUTE = re.compile(r"""([a-zA-Z_:][-\w:.]*)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?""")
CAMEL = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|\d+")


@dataclass
class Element:
    tag: str
    number: int
    parent: int  # number of the parent element
    depth: int
    side: int  # 1 within content, -1 within boilerplate, 0 neither
    firm: bool  # nothing inside changes side
    hidden: bool
    soft: bool = False  # the side is a guess from a name, a form or a header
    home: Element | None = None  # the nearest block around an element that is none itself


@dataclass
class Block:
    text: str
    tag: str
    element: int
    side: int
    linked: int  # characters of links
    soft: bool = False


def _place(tag: str, attributes: str, above: Element) -> tuple[int, bool, bool, bool]:
    """Side, firmness, hiddenness and softness of an element from its tag and attributes."""
    side, firm, hidden, soft = above.side, above.firm, above.hidden or tag in HIDDEN, above.soft
    words: set[str] = set()
    role = ""
    if attributes and not attributes.isspace():
        for name, value in ATTRIBUTE.findall(attributes):
            name = name.lower()
            if name in ("class", "id"):
                words.update(w.lower() for w in CAMEL.findall(value))
            elif name == "role":
                role = value.strip("\"'").lower()
            elif name == "hidden" or name == "aria-hidden" and "true" in value.lower():
                hidden = True
            elif name == "style" and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value.lower()):
                hidden = True
    if firm or tag in ("html", "body"):
        return side, firm, hidden, soft
    if words & FIRM:
        return -1, True, hidden, False
    if tag in ASIDE_TAGS or role in ASIDE_ROLES:
        return -1, True, hidden, False
    if tag in MAIN_TAGS or role in ("main", "article"):
        return 1, False, hidden, False
    if tag == "form" or tag == "header" and side < 1:
        return -1, False, hidden, True
    if words & ASIDE_WORDS:
        # A wrapper may be named after what it holds: an article inside is still content.
        return (side, False, hidden, soft) if words & {"has", "no", "with"} else (-1, False, hidden, True)
    if words & MAIN_WORDS and tag not in ("a", "span", "li", "p") and "header" not in words:
        return 1, False, hidden, soft if side > 0 else True
    return side, firm, hidden, soft


def blocks(page: str) -> tuple[list[Block], list[Element]]:
    """The page's text blocks in order, and its elements by number."""
    root = Element("", 0, 0, 0, 0, False, False)
    root.home = root
    elements, stack, out = [root], [root], []
    open_tags: Counter[str] = Counter()
    pieces: list[str] = []
    linked = links = 0

    def flush():
        nonlocal linked
        text = " ".join("".join(pieces).split()) if pieces else ""
        pieces.clear()
        if text:
            home = stack[-1].home
            lower = stack[-1] if stack[-1].side < home.side else home
            out.append(Block(text, home.tag, home.number, lower.side if lower is home else -1, linked, lower.soft))
        linked = 0

    def leave(i: int):
        """The elements from the ``i``-th open one on are closed."""
        nonlocal links
        links -= sum(e.tag == "a" for e in stack[i:])
        open_tags.subtract(e.tag for e in stack[i:])
        del stack[i:]

    at, end = 0, len(page)
    while at < end:
        found = TAG.search(page, at)
        upto = found.start() if found else end
        if upto > at and not stack[-1].hidden:
            text = html.unescape(page[at:upto]) if "&" in page[at:upto] else page[at:upto]
            pieces.append(text)
            if links:
                linked += len(text)
        if not found:
            break
        at = found.end()
        if found.group(2) is None:
            continue
        tag = found.group(2).lower()
        if found.group(1):
            if not open_tags[tag]:
                if tag in BLOCK:
                    flush()
                continue
            if tag in BLOCK:
                flush()
            while len(stack) > 1:
                gone = stack.pop()
                open_tags[gone.tag] -= 1
                if gone.tag in BLOCK and gone.tag != tag:
                    flush()
                links -= gone.tag == "a"
                if gone.tag == tag:
                    break
            continue
        if tag == "br":
            pieces.append(" ")
            continue
        if tag in BLOCK:
            flush()
            ended = ENDS.get(tag, ())
            if stack[-1].tag == "p" or any(e.tag == "p" for e in stack[-4:]):
                # A block ends an open paragraph, with the inline elements left open in it.
                for i in range(len(stack) - 1, 0, -1):
                    if stack[i].tag == "p":
                        leave(i)
                        break
                    if stack[i].tag in BLOCK:
                        break
            for i in range(len(stack) - 1, 0, -1) if any(open_tags[t] for t in ended) else ():
                if stack[i].tag in ended:
                    leave(i)
                    break
                if stack[i].tag in SCOPE:
                    break
        if tag in VOID:
            continue
        attributes = found.group(3)
        above = stack[-1]
        side, firm, hidden, soft = _place(tag, attributes, above)
        if attributes.endswith("/") and tag not in BLOCK:
            continue
        element = Element(tag, len(elements), above.number, above.depth + 1, side, firm, hidden, soft)
        element.home = element if tag in BLOCK else above.home
        elements.append(element)
        stack.append(element)
        open_tags[tag] += 1
        links += tag == "a"
        if tag in RAW:
            close = re.compile(f"</{re.escape(tag)}\\s*>", re.I).search(page, at)
            at = close.end() if close else end
            leave(len(stack) - 1)
    flush()
    return out, elements


#: Constant, length, words, share of links, stops, ends like a sentence, list or table item. Training
#: starts from these and is drawn to them: length and sentences speak for content, links against it.
PRIOR = np.array([-1.5, 0.5, 2.0, -3.0, 1.0, 0.5, -0.5])


def shape(found: list[Block]) -> np.ndarray:
    """What the regression sees of blocks: text and shape, nothing of their containers."""
    x = np.zeros((len(found), len(PRIOR)))
    for i, b in enumerate(found):
        size = len(b.text)
        stops = sum(map(b.text.count, ".!?,;:"))
        x[i] = (
            1.0, np.log1p(size) / 5, min(b.text.count(" ") + 1, 60) / 30, b.linked / size, min(1.0, 10 * stops / size),
            b.text[-1] in ".!?\"'”", b.tag in ("li", "td", "th", "dd", "dt"),
        )
    return x


def fit(pages: list[str], rounds: int = 300) -> np.ndarray:
    """Weights of the regression from blocks whose containers say what they are; ``PRIOR`` if none do."""
    xs, ys = [np.zeros((0, len(PRIOR)))], [np.zeros(0)]
    for page in pages:
        found, _ = blocks(page)
        if found:
            sides = np.array([0 if b.soft else b.side for b in found])
            xs.append(shape(found)[sides != 0])
            ys.append((sides[sides != 0] > 0).astype(float))
    x, y = np.concatenate(xs), np.concatenate(ys)
    w = PRIOR.copy()
    if len(set(y.tolist())) < 2:
        return w
    weight = np.where(y == 1, 0.5 / (y == 1).sum(), 0.5 / (y == 0).sum())
    m, v = np.zeros_like(w), np.zeros_like(w)
    for step in range(1, rounds + 1):
        p = 0.5 * (1 + np.tanh(0.5 * (x @ w)))
        grad = x.T @ ((p - y) * weight) + 0.02 * (w - PRIOR)
        m, v = 0.9 * m + 0.1 * grad, 0.999 * v + 0.001 * grad**2
        w = w - 0.05 * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-9)
    return w


def edges(found: list[Block], elements: list[Element]) -> list[tuple[int, int, float]]:
    """(i, j, capacity) between following blocks, and between those next to each other under one parent."""

    def apart(a: int, b: int) -> int:
        steps = 0
        while a != b:
            if elements[a].depth >= elements[b].depth:
                a = elements[a].parent
            else:
                b = elements[b].parent
            steps += 1
        return steps

    out, latest = [], {}
    for i, b in enumerate(found):
        parent = elements[b.element].parent
        before = latest.get(parent)
        if i and before != i - 1:
            out.append((i - 1, i, 2.0 * 0.5 ** apart(found[i - 1].element, b.element)))
        if before is not None:
            out.append((before, i, 1.0))
        latest[parent] = i
    return out


def cut(score: np.ndarray, links: list[tuple[int, int, float]]) -> np.ndarray:
    """Labels (1: content) of least cost: a block with the sign of its score against it pays its
    size, a link between different labels its capacity. Ties go to boilerplate.

    A block whose score outweighs all its links is settled at once, and its links
    become scores of the others. What is left goes through augmenting shortest
    paths (Dinic) from the source to the sink.
    """
    n = len(score)
    score = score.astype(float).copy()
    beside: list[dict[int, float]] = [{} for _ in range(n)]
    for i, j, c in links:
        if i != j and c > 0:
            beside[i][j] = beside[i].get(j, 0.0) + c
            beside[j][i] = beside[j].get(i, 0.0) + c
    label = np.full(n, -1)
    queue = deque(range(n))
    while queue:
        i = queue.popleft()
        if label[i] >= 0 or abs(score[i]) < sum(beside[i].values()) or score[i] == 0 and beside[i]:
            continue
        label[i] = int(score[i] > 0)
        for j, c in beside[i].items():
            del beside[j][i]
            score[j] += c if label[i] else -c
            queue.append(j)
        beside[i] = {}
    rest = np.flatnonzero(label < 0).tolist()
    if not rest:
        return label
    source, sink = n, n + 1
    room: dict[int, dict[int, float]] = {i: dict(beside[i]) for i in rest}
    room[source] = {i: score[i] for i in rest if score[i] > 0}
    room[sink] = {}
    for i in rest:
        room[i][source] = 0.0
        room[i][sink] = max(-score[i], 0.0)
        room[sink][i] = 0.0
    while True:
        level = {source: 0}
        queue = deque([source])
        while queue:
            i = queue.popleft()
            for j, c in room[i].items():
                if c > 1e-12 and j not in level:
                    level[j] = level[i] + 1
                    queue.append(j)
        if sink not in level:
            break
        onward = {i: iter(list(room[i])) for i in level}
        path = [source]
        while path:
            i = path[-1]
            if i == sink:
                flow = min(room[a][b] for a, b in zip(path, path[1:]))
                for a, b in zip(path, path[1:]):
                    room[a][b] -= flow
                    room[b][a] = room[b].get(a, 0.0) + flow
                back = next(k for k, (a, b) in enumerate(zip(path, path[1:])) if room[a][b] <= 1e-12)
                del path[back + 1 :]
                continue
            for j in onward[i]:
                if room[i].get(j, 0.0) > 1e-12 and level.get(j) == level[i] + 1:
                    path.append(j)
                    break
            else:
                path.pop()
                if path:
                    level[i] = -1
    for i in rest:
        label[i] = int(i in level)
    return label


def scores(found: list[Block], weights: np.ndarray) -> np.ndarray:
    """Above 0 for content. Firm marks outweigh text; in a page with an article the rest is suspect.

    A soft mark of content adds less than text and links can take away. One of
    boilerplate takes 0.5, which content-like text outweighs, and up to 5.5 more by
    the share of the page's content-like characters that stand elsewhere: beside
    an article, a box named after boilerplate is one.
    """
    text = np.clip(shape(found) @ weights, -2.0, 2.0)
    sides = np.array([b.side for b in found])
    soft = np.array([b.soft for b in found])
    size = np.array([len(b.text) for b in found], float)
    marked = (sides > 0).any()
    out = np.where(sides == 0, text - (3.0 if marked else 0.0), 6.0 * sides + 0.5 * text)
    out = np.where(soft & (sides > 0), 3.0 + text, out)
    guessed = soft & (sides < 0)
    elsewhere, here = size[(out > 0) & ~guessed].sum(), size[guessed & (text > 0)].sum()
    share = elsewhere / (elsewhere + here) if here else 1.0
    return np.where(guessed, text - 0.5 - 5.5 * share, out)


def main_text(page: str | None, weights: np.ndarray) -> str:
    found, elements = blocks(page or "")
    if not found:
        return ""
    label = cut(scores(found, weights), edges(found, elements))
    return "\n".join(b.text for b, y in zip(found, label) if y)


def train(pages: DataFrame, html_col: str = "html", *, sample: int = 500, seed: int = 5) -> np.ndarray:
    """The regression from at most ``sample`` pages, drawn by hash of the html, in one task."""
    rows = pages.select(col(html_col).cast("string").alias("html")).where("html IS NOT NULL")
    drawn = least_hashed(rows, sample, "html", seed=seed)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights = fit(sorted(p for b in batches for p in b.column(0).to_pylist()))
        yield pa.RecordBatch.from_arrays([pa.array(range(len(weights)), pa.int32()), pa.array(weights)], ["at", "w"])

    out = drawn.repartition(1).mapInArrow(run, "at int, w double").collect()
    return np.array([r[1] for r in sorted(out)]) if out else fit([])


def extract(pages: DataFrame, weights: np.ndarray, html_col: str = "html", name: str = "text") -> DataFrame:
    """``pages`` without the html and with its main text, replacing a column of that name.

    White space in a block becomes one space, and blocks are joined by a line
    break. Null and empty pages, and pages without content, have an empty text.
    The whole page is read. Repeated rows are rows; an empty table gives none.
    """
    rest = [c for c in pages.columns if c.lower() != name.lower() and c != html_col]
    kept = pages.select(*(col(c) for c in rest))
    (page,) = own(kept, "page_html")
    rows = pages.select(*(col(c) for c in rest), col(html_col).cast("string").alias(page))
    schema = T.StructType([*kept.schema, T.StructField(name, T.StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(p.as_py(), weights) for p in batch.column(batch.num_columns - 1)]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(texts, pa.string())], [*rest, name])

    return mapped(rows, run, schema)
