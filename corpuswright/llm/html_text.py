"""Main text of web pages by minimum-cut labelling.

A page is split into blocks of text. A linear classifier over a block's own marks (what it stands in, how much of it is
links, its length and sentence ends) gives the cost of calling it content and of calling it boilerplate; these are the
capacities of its edges from the source and to the sink. Blocks next to each other, and blocks of the same parent, are
joined by edges that are stronger the closer they are in the DOM tree. The minimum cut of this graph is the cheapest
labelling: blocks on the source's side are the main text.

The classifier is a logistic regression (``fit``); its costs are whole numbers, hundredths of a nat. Every mark is a bounded
cost, names of classes too: neighbours and the text itself can outvote it.
"""

from __future__ import annotations

import html
import re
from collections import deque
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpuswright.llm.common import batches

_NAME = re.compile(r"[^\s/>]+")
#: One attribute, or the tag's end; a value that is quoted is read apart.
_ATTRIBUTE = re.compile(r"[\s/]*(?:(>)|([^\s/>][^\s/>=]*)(?:\s*=\s*(?:([\"'])|([^\s>\"'][^\s>]*))?)?|\Z)")
#: Class names that say what is beside or not in an element, not what it is.
_BESIDE = re.compile(r"(?:^|(?<=\s))(?:has|no|with|without|not|show|hide)[_-]\S*", re.I)
_SPACE = re.compile(r"\s+")
_SENTENCE = re.compile(r"[.!?:;…。][\"'”’)\]]*$")
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Elements whose content is not markup.
RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
#: Elements of which nothing is text of the page.
DROPPED = frozenset("script style textarea title iframe noembed noframes head template svg math canvas object audio video select button noscript dialog datalist map".split())
BLOCK = frozenset(
    "address article aside blockquote body br center dd details dialog dir div dl dt fieldset figcaption figure footer form frameset h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol optgroup option p pre search section summary table tbody td tfoot th thead tr ul caption".split()
)
_CLOSES_P = BLOCK - {"br", "html", "body", "caption", "tbody", "td", "tfoot", "th", "thead", "tr", "option", "optgroup", "legend"}
#: What a start tag ends: an open element of a group, unless one of the walls is opened within it.
_GROUP_OF = {"p": "p", "li": "item", "dt": "term", "dd": "term", "tr": "row", "td": "cell", "th": "cell"}
_WALLS = {"p": ("button", "td", "th", "table", "caption", "object", "template"), "item": ("ul", "ol", "menu"), "term": ("dl",), "row": ("table",), "cell": ("tr", "table")}
_WALL_OF: dict[str, list[str]] = {}
for _group, _tags in _WALLS.items():
    for _tag in _tags:
        _WALL_OF.setdefault(_tag, []).append(_group)
_CHROME = re.compile(
    r"(?:^|[\s_-])(?:ads?|advert\w*|adsense|adbox|adslot|sponsor\w*|promo\w*|banner|cookies?|consent|gdpr|notices?|notification|alert|popup|pop-up|modal|overlay|nav\w*|menu\w*|breadcrumbs?|sidebar\w*|side-bar|rail|widget\w*|footer\w*|site-?header|page-?header|masthead|topbar|toolbar|share|sharing|social|related|recommend\w*|trending|newsletter|subscri\w*|signup|sign-up|login|comments?|commentlist|comment-\w+|disqus|replies|respond|pagination|pager|copyright|legal|skip-?link|search-?(?:form|box|bar)?|tags?|author-?box)(?=$|[\s_-])",
    re.I,
)
_ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar".split())


class _Element:
    """An open element. ``holder``: the innermost block element, itself included; ``depth``: how many of these it is in."""

    __slots__ = ("chrome", "depth", "dropped", "holder", "inside", "link", "open", "soft", "tag", "up", "weak", "wrapped")

    def __init__(self, tag: str, up: _Element | None, marks: dict[str, str], place: int) -> None:
        self.tag, self.up = tag, up
        if up is None:
            self.inside = self.chrome = self.weak = self.soft = self.wrapped = self.dropped = self.link = False
            self.holder, self.depth, self.open = self, 0, {}
            return
        self.inside, self.chrome, self.weak, self.soft, self.wrapped = up.inside, up.chrome, up.weak, up.soft, up.wrapped
        self.dropped = up.dropped or tag in DROPPED or "hidden" in marks or marks.get("aria-hidden", "").lower() == "true"
        self.link = up.link or tag == "a"
        self.holder, self.depth = (self, up.holder.depth + 1) if tag in BLOCK else (up.holder, up.depth)
        # where in the stack the open elements are that a start tag may end
        self.open = up.open
        if tag in _GROUP_OF or tag in _WALL_OF:
            self.open = {k: v for k, v in up.open.items() if k not in _WALL_OF.get(tag, ())}
            if tag in _GROUP_OF:
                self.open[_GROUP_OF[tag]] = place
        role = marks.get("role", "").lower()
        names = _BESIDE.sub(" ", f"{marks.get('class', '')} {marks.get('id', '')}") if marks else ""
        if tag in ("article", "main") or role in ("main", "article"):
            if tag == "article" and "comment" in names.lower():
                self.chrome = True
                return
            # what stands around an article says little of the article
            self.wrapped |= self.soft
            self.inside, self.weak, self.soft = True, False, False
        elif tag in ("nav", "aside", "footer", "menu", "search") or role in _ROLES:
            self.chrome = True
        elif tag in ("body", "html"):
            pass
        elif names and _CHROME.search(names):
            self.soft = True
        elif tag in ("form", "header"):
            self.weak = True


@dataclass(slots=True)
class Block:
    text: str
    #: Characters of it within links.
    linked: int
    #: Its innermost block element.
    holder: _Element
    #: Within an article or main part; within something that surrounds articles.
    inside: bool
    chrome: bool
    #: In a form or header (the headings of an article's own header aside).
    weak: bool
    #: Boilerplate by a class or id: of an element within the article, or without one; of an element around the article.
    soft: bool
    wrapped: bool


def tag_at(page: str, at: int) -> tuple[dict[str, str], bool, int]:
    """Attributes (the first of each name) from behind a tag's name on; whether the tag ends itself; where it ends.

    A tag that the page's end cuts, within a quoted value too, ends there: then the end is -1.
    """
    marks: dict[str, str] = {}
    while True:
        m = _ATTRIBUTE.match(page, at)
        if m is None or not m[1] and not m[2]:
            return marks, False, -1
        at = m.end()
        if m[1]:
            return marks, m[0].endswith("/>"), at
        value = m[4] or ""
        if m[3]:
            stop = page.find(m[3], at)
            if stop < 0:
                return marks, False, -1
            value, at = page[at:stop], stop + 1
        marks.setdefault(m[2].lower(), value)


def blocks(page: str) -> list[Block]:
    """The blocks of text of a page, in order. Time is linear in the page, whatever its markup."""
    out: list[Block] = []
    stack: list[_Element] = [_Element("", None, {}, 0)]
    many: dict[str, int] = {}
    parts: list[str] = []
    linked, at, end = 0, 0, len(page)

    def flush() -> None:
        nonlocal linked
        if parts:
            text = _SPACE.sub(" ", "".join(parts)).strip()
            if text:
                top = stack[-1]
                out.append(Block(text, min(linked, len(text)), top.holder, top.inside, top.chrome, top.weak and not (top.inside and top.holder.tag in ("h1", "h2")), top.soft, top.wrapped))
            parts.clear()
        linked = 0

    def put(raw: str) -> None:
        nonlocal linked
        top = stack[-1]
        if raw and not top.dropped:
            text = html.unescape(raw) if "&" in raw else raw
            parts.append(text)
            if top.link:
                linked += len(text.strip())

    def close(index: int) -> None:
        if stack[-1].depth > stack[index - 1].depth:
            flush()
        for e in stack[index:]:
            many[e.tag] -= 1
        del stack[index:]

    while at < end:
        start = page.find("<", at)
        if start < 0:
            put(page[at:])
            break
        after = page[start + 1 : start + 2]
        ending = after == "/" and page[start + 2 : start + 3].isalpha()
        if not (ending or after.isalpha() or after in ("!", "?", "/")):
            # a sign by itself, not markup
            put(page[at : start + 1])
            at = start + 1
            continue
        put(page[at:start])
        if not (ending or after.isalpha()):
            comment = page.startswith("<!--", start)
            stop = page.find("-->" if comment else ">", start + (2 if comment else 1))
            at = end if stop < 0 else stop + (3 if comment else 1)
            continue
        m = _NAME.match(page, start + 1 + ending)
        tag = m[0].lower()
        marks, alone, at = ({}, False, m.end() + 1) if page.startswith(">", m.end()) else tag_at(page, m.end())
        if at < 0:
            break
        if ending:
            if many.get(tag):
                i = len(stack) - 1
                while stack[i].tag != tag:
                    i -= 1
                close(i)
            elif tag in BLOCK:
                flush()
            continue
        if tag in _CLOSES_P and (i := stack[-1].open.get("p")):
            close(i)
        if (group := _GROUP_OF.get(tag)) and group != "p" and (i := stack[-1].open.get(group)):
            close(i)
        if tag in BLOCK:
            flush()
        if tag in VOID or alone and tag not in BLOCK and tag not in RAW:
            continue
        stack.append(_Element(tag, stack[-1], marks, len(stack)))
        many[tag] = many.get(tag, 0) + 1
        if tag in RAW:
            stop = _raw_end(tag).search(page, at)
            if tag not in DROPPED:
                put(page[at : stop.start() if stop else end])
            if stop is None:
                # an element of this kind that is never ended holds the rest of the page
                break
            at = stop.end()
            close(len(stack) - 1)
    flush()
    return out


@cache
def _raw_end(tag: str) -> re.Pattern:
    return re.compile(rf"</{re.escape(tag)}(?=[\s/>]|\Z)[^>]*(?:>|\Z)", re.I)


MARKS = ("always", "paragraph", "heading", "cell", "length", "sentence", "links", "class", "class_beside_main", "around", "around_beside_main", "inside", "outside", "chrome", "weak")


def marks_of(block: Block, has_main: bool) -> tuple[float, ...]:
    """The classifier's inputs, in the order of ``MARKS``; all within 0 and 1."""
    n, tag = len(block.text), block.holder.tag
    return (
        1.0,
        float(tag in ("p", "blockquote", "pre")),
        float(len(tag) == 2 and tag[0] == "h" and tag[1].isdigit()),
        float(tag in ("li", "td", "th")),
        min(n, 400) / 400,
        float(bool(_SENTENCE.search(block.text))),
        block.linked / max(n, 1),
        float(block.soft),
        float(block.soft and has_main),
        float(block.wrapped),
        float(block.wrapped and has_main),
        float(block.inside and not (block.soft or block.wrapped)),
        float(has_main and not (block.inside or block.soft or block.wrapped)),
        float(block.chrome),
        float(block.weak),
    )


#: What ``fit`` gives for the pages of ``tests/llm/pages.py``: hundredths of a nat for each of ``MARKS``.
WEIGHTS = (53, 103, 167, 284, 142, 83, -683, -113, -344, -248, -248, 113, -231, -683, -451)
NEAR = 64


def cost(block: Block, has_main: bool, weights: tuple[int, ...] = WEIGHTS) -> int:
    """How much cheaper it is to call the block content (negative: boilerplate)."""
    return round(sum(w * x for w, x in zip(weights, marks_of(block, has_main), strict=True)))


def read(page: str) -> tuple[list[Block], bool]:
    """The blocks of a page, and whether one is in a main part."""
    found = blocks(page)
    has_main = any(b.inside and not (b.chrome or b.soft or b.wrapped) for b in found)
    if not has_main:
        # the page's only articles stand in elements with such classes
        for b in found:
            b.wrapped = False
        has_main = any(b.inside and not (b.chrome or b.soft) for b in found)
    return found, has_main


def fit(pages: list[tuple[str, str]], steps: int = 3000, rate: float = 2.0, ridge: float = 2e-4) -> tuple[int, ...]:
    """Weights for pages with their known main texts (blocks joined by line feeds), by gradient descent on the logistic loss.

    A block is content if its text is a line of the page's main text. Pages weigh the same, whatever their number of blocks.
    """
    rows, labels, weights = [], [], []
    for page, text in pages:
        found, has_main = read(page)
        wanted = set(text.split("\n"))
        for b in found:
            rows.append(marks_of(b, has_main))
            labels.append(b.text in wanted)
            weights.append(1 / len(found))
    x, y, w = np.array(rows), np.array(labels, dtype=float), np.array(weights) / np.sum(weights)
    beta = np.zeros(len(MARKS))
    for _ in range(steps):
        p = 1 / (1 + np.exp(-x @ beta))
        beta -= rate * (x.T @ (w * (p - y)) + ridge * beta)
    return tuple(round(100 * b) for b in beta.tolist())


def minimum_cut(content: list[int], edges: list[tuple[int, int, int]]) -> list[bool]:
    """True for the nodes on the source's side of a minimum cut.

    ``content[i]``: capacity from the source if positive, to the sink if negative; ``edges``: (i, j, capacity) both ways.
    Breadth-first levels with blocking flows. Of several minimum cuts, the one with the fewest nodes on the source's side.
    """
    n = len(content)
    source, sink = n, n + 1
    to: list[int] = []
    room: list[int] = []
    out: list[list[int]] = [[] for _ in range(n + 2)]

    def join(a: int, b: int, forth: int, back: int) -> None:
        out[a].append(len(to))
        to.append(b)
        room.append(forth)
        out[b].append(len(to))
        to.append(a)
        room.append(back)

    for i, c in enumerate(content):
        if c > 0:
            join(source, i, c, 0)
        elif c < 0:
            join(i, sink, -c, 0)
    for a, b, c in edges:
        join(a, b, c, c)
    while True:
        level = [-1] * (n + 2)
        level[source] = 0
        queue = deque([source])
        while queue:
            a = queue.popleft()
            for e in out[a]:
                b = to[e]
                if room[e] and level[b] < 0:
                    level[b] = level[a] + 1
                    queue.append(b)
        if level[sink] < 0:
            return [x >= 0 for x in level[:n]]
        turn = [0] * (n + 2)
        path: list[int] = []
        a = source
        while True:
            if a == sink:
                flow = min(room[e] for e in path)
                back = len(path)
                for i, e in enumerate(path):
                    room[e] -= flow
                    room[e ^ 1] += flow
                    if not room[e] and back == len(path):
                        back = i
                a = to[path[back] ^ 1]
                del path[back:]
            while turn[a] < len(out[a]):
                e = out[a][turn[a]]
                if room[e] and level[to[e]] == level[a] + 1:
                    break
                turn[a] += 1
            if turn[a] < len(out[a]):
                path.append(out[a][turn[a]])
                a = to[path[-1]]
            elif not path:
                break
            else:
                turn[to[path[-1] ^ 1]] += 1
                a = to[path.pop() ^ 1]


def distance(a: _Element, b: _Element) -> int:
    """Steps between two block elements in the DOM tree."""
    steps = 0
    while a is not b:
        if a.depth >= b.depth:
            a = a.up.holder
        else:
            b = b.up.holder
        steps += 1
    return steps


def tie(a: Block, b: Block, steps: int) -> int:
    """Cost of labelling two blocks differently; small across the edge of a part that is boilerplate by its own marks."""
    apart = (a.chrome or a.soft or a.wrapped) != (b.chrome or b.soft or b.wrapped)
    return max(1, int(NEAR * 2 ** -min(max(steps, 2) / 2 - 1, 6)) >> (3 if apart else 0))


def labels(content: list[int], edges: list[tuple[int, int, int]]) -> list[bool]:
    """``minimum_cut``, worked out part by part: a node whose own capacity exceeds all its edges together is on its own side
    in every minimum cut, and parts that only such nodes join do not depend on each other."""
    n = len(content)
    around: list[list[tuple[int, int]]] = [[] for _ in range(n)]
    for a, b, c in edges:
        around[a].append((b, c))
        around[b].append((a, c))
    fixed = [abs(content[i]) > sum(c for _, c in around[i]) for i in range(n)]
    keep = [c > 0 for c in content]
    seen = fixed[:]
    for first in range(n):
        if seen[first]:
            continue
        part, seen[first] = [first], True
        for i in part:
            for j, _ in around[i]:
                if not seen[j]:
                    seen[j] = True
                    part.append(j)
        number = {i: k for k, i in enumerate(part)}
        own = [content[i] + sum(c if keep[j] else -c for j, c in around[i] if fixed[j]) for i in part]
        if all(c <= 0 for c in own) or all(c > 0 for c in own):
            sides = [c > 0 for c in own]
        else:
            sides = minimum_cut(own, [(number[i], number[j], c) for i in part for j, c in around[i] if not fixed[j] and i < j])
        for i, side in zip(part, sides, strict=True):
            keep[i] = side
    return keep


def main_text(page: str | None, weights: tuple[int, ...] | None = None) -> str:
    """The main text of a page: content blocks in page order, joined by line feeds; empty if there is none."""
    found, has_main = read(page or "")
    edges: list[tuple[int, int, int]] = []
    last_of: dict[int, int] = {}
    for i, b in enumerate(found):
        if i:
            edges.append((i - 1, i, tie(found[i - 1], b, distance(found[i - 1].holder, b.holder))))
        parent = id(b.holder.up and b.holder.up.holder)
        if (j := last_of.get(parent)) is not None and j != i - 1:
            edges.append((j, i, tie(found[j], b, 3)))
        last_of[parent] = i
    keep = labels([cost(b, has_main, weights or WEIGHTS) for b in found], edges)
    return "\n".join(b.text for b, k in zip(found, keep, strict=True) if k)


def extract(df: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """``(page_id, url, text, n_chars)`` of every page, from its whole markup.

    Null and empty pages, and pages without content, give an empty text. Markup that ends anywhere is read as browsers do:
    open elements end with the page; a cut tag is not text, nor what follows a quote that is never closed. Repeated rows and
    nulls in other columns are kept; other columns are not read.
    Narrow: no shuffle, one row in, one row out.
    """
    kinds = {f.name: f.dataType.simpleString() for f in df.schema}
    narrow = df.select(F.col(id_col).alias("page_id"), F.col(url_col).alias("url"), F.col(html_col).alias("text"))

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, pages in batches(it):
            texts = [main_text(p) for p in pages]
            yield pa.RecordBatch.from_arrays([batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())], names=["page_id", "url", "text", "n_chars"])

    return narrow.mapInArrow(run, f"page_id {kinds[id_col]}, url {kinds[url_col]}, text string, n_chars bigint")
