"""Main text of web pages: flat text blocks, classified by a decision tree.

A page is cut at block-level tags into flat blocks of text. A block is described by its words, its link density, both for the blocks before
and after it, and by where it stands (``FEATURES``). A decision tree fitted on the small labelled tables ``LABELLED`` and ``VARIED`` decides
which blocks are main text. Tags are found by the rules of HTML: scripts, styles and the like run to their own end tag, whatever they hold; values
without quotes end at white space or ``>``; left-out elements may be nested. One pass, linear in the page's length however broken it is.

Defined results: a null page counts as empty and has an empty text, as has a page of markup only; blocks are joined by one line end in page order;
character references are decoded, white space inside a block (line breaks too) becomes one space. Pages of any length are read whole. Null ids and
repeated rows are carried; a tie in the tree's leaf counts as main text; an empty table gives an empty one; other columns, whatever their
names, play no part. No shuffle.
"""

from __future__ import annotations

import html
import re
from bisect import bisect
from collections.abc import Iterator
from functools import lru_cache
from itertools import product
from typing import NamedTuple

import numpy as np
from pyspark.sql import DataFrame

from attestry.llm.tables import per_batch

#: A tag whose attributes are all well-formed; possessive, so that one pass decides. Others go through ``_loose_tag``.
TAG = re.compile(
    r"""<(/?)([a-zA-Z][^\s/>]*+)((?>\s++[^\s"'<>/=]++(?>\s*+=\s*+(?>"[^"]*+"|'[^']*+'|[^\s"'=<>`]++))?+)*+)\s*+(/?)>"""
)
NAMED = re.compile(r"""(?:^|\s)(?:class|id|role|aria-label)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.IGNORECASE)
GAP = re.compile(r"[\s/]*+")
ATTRIBUTE = re.compile(r"=?[^\s/>=]*+")
EQUALS = re.compile(r"\s*+=\s*+")
UNQUOTED = re.compile(r"[^\s>]*+")
TAG_NAME = re.compile(r"</?([a-zA-Z][^\s/>]*+)")
AFTER_QUOTE = frozenset(" \t\n\f\r/>")
MARKING = frozenset(("class", "id", "role", "aria-label"))
#: Elements whose content is text up to their own end tag, and elements whose content is markup that is left out.
RAW = {n: re.compile(rf"</{n}(?=[\s/>])", re.IGNORECASE) for n in ("script", "style", "noscript", "textarea", "title", "iframe", "xmp", "noembed", "noframes")}
SKIPPED = frozenset(("template", "svg", "select", "datalist", "button", "object", "canvas", "audio", "video"))
BLOCK = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form frameset h1 h2 h3 h4 h5 h6 "
    "head header hr html legend li main menu nav ol p pre section summary table tbody td tfoot th thead tr ul".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
ASIDE = frozenset("nav aside footer form fieldset menu dialog".split())
#: Words of class, id and role names that mark a container as not main text.
NOISE = frozenset(
    "ad ads advert advertisement adverts banner breadcrumb breadcrumbs comment comments complementary contentinfo cookie cookies consent disclaimer disqus "
    "footer form header masthead menu modal nav navbar navigation newsletter notice notices pagination popup promo promoted promotion related replies reply "
    "search share sharing sidebar signup skip social sponsor sponsored subscribe teaser toolbar topbar tracking widget".split()
)
MAIN = frozenset("article articlebody body content entry main maincontent post story text".split())
#: Open elements that a start tag ends, as HTML has it, and those that shield the ones outside them.
CELLS = ("table", "td", "th", "caption")
ENDS = {
    "li": (("li",), ("ul", "ol", "menu", "dir", *CELLS)),
    **dict.fromkeys(("dt", "dd"), (("dt", "dd"), ("dl", *CELLS))),
    **dict.fromkeys(("td", "th"), (("td", "th", "caption"), ("tr", "table"))),
    "tr": (("tr", "caption"), ("table",)),
    **dict.fromkeys(("thead", "tbody", "tfoot"), (("thead", "tbody", "tfoot", "caption"), ("table",))),
}
SHIELDS = (*CELLS, "template", "object", "button")
#: Start tags that end an open paragraph.
ENDS_P = BLOCK - frozenset("html head body frameset caption legend tbody td tfoot th thead tr".split())
SPLIT = re.compile(r"[^a-z0-9]+|(?<=[a-z])(?=[A-Z])")

FEATURES = ("words", "links", "words_before", "links_before", "words_after", "links_after", "noise", "main", "page_has_main", "heading")


class Block(NamedTuple):
    text: str
    words: int
    linked: int
    noise: int
    main: int
    heading: int


class Tag(NamedTuple):
    start: int
    end: int
    name: str
    closing: bool
    empty: bool
    marks: list[str]


def _loose_tag(page: str, start: int) -> Tag | None:
    """A tag by the rules for broken ones: a value without quotes ends at white space or ``>``. A quote that never ends, or whose
    end is followed by something that no tag has there, ends at ``>``. None if the page ends first."""
    m = TAG_NAME.match(page, start)
    at, marks = m.end(), []
    while True:
        gap = GAP.match(page, at)
        at = gap.end()
        if at >= len(page):
            return None
        if page[at] == ">":
            return Tag(start, at + 1, m[1].lower(), page[start + 1] == "/", gap.group().endswith("/"), marks)
        attribute = ATTRIBUTE.match(page, at)
        at, value = attribute.end(), ""
        equals = EQUALS.match(page, at)
        if equals:
            at = equals.end()
            quote = page[at : at + 1]
            if quote and quote in "\"'":
                end = page.find(quote, at + 1)
                close = page.find(">", at + 1, end if end >= 0 else len(page))
                if end < 0 or close >= 0 and page[end + 1 : end + 2] not in AFTER_QUOTE:
                    if close < 0:
                        return None
                    value, at = page[at + 1 : close], close
                else:
                    value, at = page[at + 1 : end], end + 1
            else:
                unquoted = UNQUOTED.match(page, at)
                value, at = unquoted.group(), unquoted.end()
        if attribute.group().lower() in MARKING:
            marks.append(value)


def tags(page: str) -> Iterator[Tag]:
    """Tags in their order. What lies between them is text, but for comments, declarations and raw content, which come as tags without a
    name. Each character is looked at a bounded number of times."""
    at, size = 0, len(page)
    while (at := page.find("<", at)) >= 0:
        following = page[at + 1 : at + 2]
        if following == "!" and page.startswith("<!--", at):
            # "<!-->" and "<!--->" are whole comments.
            end = at + 5 if page.startswith("<!-->", at) else at + 6 if page.startswith("<!--->", at) else page.find("-->", at + 4) + 3
            end = size if end < at + 5 else end
            yield Tag(at, end, "", False, False, [])
            at = end
            continue
        letter = page[at + 2 : at + 3] if following == "/" else following
        if not (letter.isascii() and letter.isalpha()):
            if following not in ("!", "?", "/") or following == "/" and not letter:
                at += 1
                continue
            end = page.find(">", at)
            end = size if end < 0 else end + 1
            yield Tag(at, end, "", False, False, [])
            at = end
            continue
        m = TAG.match(page, at)
        tag = Tag(at, m.end(), m[2].lower(), bool(m[1]), bool(m[4]), [next(filter(None, n.groups()), "") for n in NAMED.finditer(m[3])]) if m else _loose_tag(page, at)
        if tag is None:
            yield Tag(at, size, "", False, False, [])
            return
        at = tag.end
        if tag.name in RAW and not tag.closing:
            end = RAW[tag.name].search(page, at)
            yield Tag(tag.start, end.start() if end else size, "", False, False, [])
            at = end.start() if end else size
            continue
        yield tag


def _marks(name: str, values: list[str]) -> tuple[int, int]:
    """Whether a container is noise, and whether it is a main one."""
    words = {w.lower() for v in values for w in SPLIT.split(v) if w}
    noise = name in ASIDE or not NOISE.isdisjoint(words)
    return int(noise), int(not noise and (name in ("article", "main") or (name in ("div", "section", "td") and not MAIN.isdisjoint(words))))


def blocks(page: str | None) -> list[Block]:
    """Flat blocks of a page in their order; blocks without text are left out."""
    page = page or ""
    out: list[Block] = []
    # Open elements: name, noise, main, skipped; counts of those that are open.
    stack: list[tuple[str, int, int, int]] = []
    places: dict[str, list[int]] = {}
    noise = main = skipped = heading = linked = 0
    parts: list[str] = []
    links: list[str] = []

    def close_block() -> None:
        text = " ".join(html.unescape("".join(parts)).split())
        if text:
            out.append(Block(text, len(text.split()), len(html.unescape(" ".join(links)).split()), int(noise > 0), int(main > 0), heading))
        parts.clear()
        links.clear()

    def last(name: str) -> int:
        where = places.get(name)
        return where[-1] if where else -1

    def close_from(depth: int) -> None:
        nonlocal noise, main, skipped
        for n, is_noise, is_main, is_skipped in stack[depth:]:
            noise, main, skipped = noise - is_noise, main - is_main, skipped - is_skipped
            places[n].pop()
        del stack[depth:]

    def close_open(names: tuple, shields: tuple) -> None:
        """Close the outermost of the open ``names`` inside the last of the ``shields``."""
        inside = max(map(last, shields))
        found = [where[bisect(where, inside)] for where in (places.get(n, ()) for n in names) if where and where[-1] > inside]
        if found:
            close_from(min(found))

    at = 0
    for tag in tags(page):
        name = tag.name
        if tag.start > at and not skipped:
            piece = page[at : tag.start]
            parts.append(piece)
            if linked:
                links.append(piece)
        at = tag.end
        if name == "br":
            parts.append(" ")
            continue
        if name == "a":
            linked = 0 if tag.closing else 1
        if name in BLOCK:
            if last("svg") > last("foreignobject") and not tag.closing:
                # Drawings hold no such elements: it ends here, whether closed or not.
                close_from(places["svg"][bisect(places["svg"], last("foreignobject"))])
            if not skipped:
                close_block()
                heading = int(name in ("h1", "h2", "h3", "h4", "h5", "h6") and not tag.closing)
        if name in VOID or name not in BLOCK and name not in SKIPPED and name not in ("span", "a", "foreignobject"):
            continue
        if tag.closing:
            depth = last(name)
            if depth >= 0:
                close_from(depth)
        elif name in SKIPPED:
            if not (tag.empty and name == "svg"):
                places.setdefault(name, []).append(len(stack))
                stack.append((name, 0, 0, 1))
                skipped += 1
        else:
            if name in ENDS_P:
                close_open(("p",), SHIELDS)
            if name in ENDS:
                close_open(ENDS[name][0], (*ENDS[name][1], "template", "object", "button"))
            # A header inside the main container holds the headline; outside it is the page's.
            n, k = _marks(name, tag.marks)
            if name == "header":
                n = int(main == 0)
            if name in ("html", "body"):
                n = k = 0
            places.setdefault(name, []).append(len(stack))
            stack.append((name, n, k, 0))
            noise, main = noise + n, main + k
    if not skipped:
        parts.append(page[at:])
    close_block()
    return out


def features(found: list[Block]) -> list[list[float]]:
    has_main = float(any(b.main and not b.noise for b in found))
    own = [(b.words, b.linked / max(1, b.words)) for b in found]
    edge = (0, 0.0)
    return [
        [*own[i], *(own[i - 1] if i else edge), *(own[i + 1] if i + 1 < len(own) else edge), b.noise, b.main, has_main, b.heading]
        for i, b in enumerate(found)
    ]


#: A labelled table of blocks, in the order of FEATURES and then 1 for main text.
LABELLED = """
1 1.0 0 0.0 1 1.0 1 0 1 0 0
1 1.0 1 1.0 1 1.0 1 0 1 0 0
2 1.0 1 1.0 8 0.0 1 0 1 0 0
8 0.0 1 1.0 11 0.0 1 0 1 0 0
11 0.0 8 0.0 60 0.0 0 1 1 1 1
60 0.0 11 0.0 25 0.0 0 1 1 0 1
25 0.0 60 0.0 1 0.0 0 1 1 0 1
1 0.0 25 0.0 80 0.0 0 1 1 0 1
80 0.02 1 0.0 120 0.1 0 1 1 0 1
120 0.1 80 0.02 3 0.0 0 1 1 0 1
3 0.0 120 0.1 9 0.1 0 1 1 1 1
12 0.5 40 0.0 60 0.0 0 1 1 0 1
5 1.0 40 0.0 60 0.0 0 1 1 0 1
9 0.1 3 0.0 0 0.0 1 0 1 0 0
40 0.0 30 0.0 55 0.0 1 1 1 0 0
55 0.0 40 0.0 0 0.0 1 1 1 0 0
2 0.0 60 0.0 40 0.0 1 1 1 1 0
150 0.0 60 0.0 12 0.0 1 1 1 0 0
70 0.0 3 0.0 9 0.0 1 0 1 0 0
30 0.2 2 0.0 9 0.0 0 0 1 0 0
6 0.0 1 1.0 70 0.0 0 0 1 1 0
45 0.0 1 1.0 11 0.0 0 0 1 0 0
5 0.0 90 0.0 0 0.0 0 0 1 0 0
1 1.0 0 0.0 1 1.0 0 0 0 0 0
2 1.0 1 1.0 3 1.0 0 0 0 0 0
3 1.0 2 1.0 7 0.0 0 0 0 0 0
7 0.0 3 1.0 45 0.0 0 0 0 1 1
45 0.0 7 0.0 30 0.0 0 0 0 0 1
30 0.1 45 0.0 4 0.0 0 0 0 0 1
4 0.0 30 0.1 60 0.0 0 0 0 0 1
60 0.0 4 0.0 20 0.1 0 0 0 0 1
20 0.1 60 0.0 8 0.6 0 0 0 0 1
8 0.6 20 0.1 4 1.0 0 0 0 0 0
4 1.0 8 0.6 0 0.0 0 0 0 0 0
9 0.8 60 0.0 0 0.0 0 0 0 0 0
12 0.0 2 1.0 0 0.0 1 0 0 0 0
90 0.0 2 1.0 40 0.0 1 0 0 0 0
"""
#: More blocks, where flags and truth may disagree; values that share a label stand together, and every combination is a row.
VARIED = """
1,3,12,60,150 0.0,0.1 0,1,11,60 0.0 0,1,9,60 0.0,0.1 0 1 1 0,1 1
1,3,12,60 0.0,0.1 1,3 1.0 1,9,60 0.0 0 1 1 0 1
3,12,60 0.0 11,60 0.0 1,3 1.0 0 1 1 0,1 1
5,12,30 0.3,0.6,1.0 25,60 0.0 25,60 0.0 0 1 1 0 1
1,2,4,8 0.9,1.0 1,2,4 0.9,1.0 1,3,6 0.9,1.0 0 1 1 0 0
1,2,4,8 0.9,1.0 30,60 0.0 1,2,4 0.9,1.0 0 1 1 0 0
1,2,4,8 0.9,1.0 1,2,4 0.9,1.0 0 0.0 0 1 1 0 0
5,12,30 0.9,1.0 25,60 0.0 3,9 0.0 0 1 1 0 1
1,8,40,150 0.0,0.2,1.0 1,60 0.0,1.0 0,9,60 0.0 1 0,1 1 0 0
1,6,45,120 0.0,0.2,1.0 1,60 0.0,1.0 0,11,70 0.0 0 0 1 0,1 0
25,60,120 0.0,0.1,0.25,0.4 7,60 0.0,0.3 6,60 0.0,0.2 0 0 0 0 1
25,60,120 0.0,0.1,0.25 1,3 0.0,1.0 30,60 0.0 0 0 0 0 1
25,60,120 0.0,0.1,0.25 30,60 0.0 1,3 0.0,1.0 0 0 0 0 1
1,4,8 0.0 30,60 0.0 30,60 0.0 0 0 0 0,1 1
3,7 0.0 0,1,3 0.0,1.0 30,60 0.0 0 0 0 1 1
3,30,90 0.0 0 0.0 0 0.0 0 0 0 0 1
1,2 0.0 1,2,3 0.0,1.0 30,60 0.0 0 0 0 0 0
1,2,3 0.0,1.0 0,1,3 0.0,1.0 1,3 0.0,1.0 0 0 0 0 0
5,8 0.0 2,4 0.0,1.0 0,2 0.0 0 0 0 0 0
4,9,20 0.7,1.0 4,20,60 0.0,0.7,1.0 0,4,20 0.0,0.7,1.0 0 0 0 0 0
60,90,120 0.0,0.1 40,60,90 0.0 12,40,60,90 0.0 1 0 0 0 1
45,60,120 0.0,0.1,0.25 40,60,90 0.0,0.2 0,3 0.0 1 0 0 0 1
45,60,120 0.0,0.1,0.25 0,3 0.0 40,60,90 0.0,0.2 1 0 0 0 1
45,60,120 0.25 40,60,90 0.0 40,60,90 0.0 1 0 0 0 1
1,8,15 0.0,1.0 1,4,60 0.0,1.0 0,3,60 0.0 1 0 0 0 0
"""


class Leaf(NamedTuple):
    main: bool


class Split(NamedTuple):
    feature: int
    limit: float
    below: object
    above: object


def labelled() -> np.ndarray:
    lines = [line.split() for line in (LABELLED + VARIED).split("\n") if line]
    return np.array([[float(x) for x in row] for line in lines for row in product(*(values.split(",") for values in line))])


def fit(rows: np.ndarray, labels: np.ndarray, depth: int = 12) -> Leaf | Split:
    """A tree by the Gini index; limits lie midway between the values of the table."""
    if depth == 0 or labels.min() == labels.max():
        return Leaf(bool(labels.mean() >= 0.5))
    best = None
    for feature in range(rows.shape[1]):
        values = np.unique(rows[:, feature])
        for limit in (values[1:] + values[:-1]) / 2:
            below = rows[:, feature] <= limit
            impurity = sum(len(part) * part.mean() * (1 - part.mean()) for part in (labels[below], labels[~below]))
            if best is None or impurity < best[0] - 1e-12:
                best = (impurity, feature, float(limit), below)
    if best is None:
        return Leaf(bool(labels.mean() >= 0.5))
    _, feature, limit, below = best
    return Split(feature, limit, fit(rows[below], labels[below], depth - 1), fit(rows[~below], labels[~below], depth - 1))


@lru_cache(maxsize=1)
def tree() -> Leaf | Split:
    table = labelled()
    return fit(table[:, :-1], table[:, -1])


def is_main(row: list[float]) -> bool:
    node = tree()
    while isinstance(node, Split):
        node = node.below if row[node.feature] <= node.limit else node.above
    return node.main


def main_text(page: str | None) -> str:
    found = blocks(page)
    return "\n".join(b.text for b, row in zip(found, features(found)) if is_main(row))


def extract(pages: DataFrame, key: str = "page_id") -> DataFrame:
    """One row per row of ``pages`` (key, url, html): key, url, ``text`` and ``n_chars``."""
    kinds = dict(pages.dtypes)

    def rows(columns: list) -> list:
        texts = [main_text(page) for page in columns[2]]
        return [columns[0], columns[1], texts, [len(t) for t in texts]]

    return per_batch(pages.select(key, "url", "html"), rows, f"`{key}` {kinds[key]}, url {kinds['url']}, text string, n_chars long")
