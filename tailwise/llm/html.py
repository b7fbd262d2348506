"""Main text of web pages by the distribution of text over lines.

Markup is stripped into lines, one per block element. Elements that never hold main text (menus,
headers, footers, sidebars, forms, scripts, reader comments, adverts by class or id) leave only empty
lines; an element with nearly all text of the page is not taken for one by its class. No empty lines are
left inside marked text, between blocks of one container that has long ones, and inside a line. Over the lines slides a window summing their text lengths, link text not counted: where the sum
rises the main text surges, where it falls to nothing it dives. Stretches between surge and dive whose
peak passes a limit (a share of the page's peak where that is less) are kept, with all their lines. This
decides on every page. Where the page marks main text (``article``, ``main``), the mark is only a weight:
its lines count more, their link text like other text, and its borders end a stretch.

A page is one row and is worked on alone: a map over Arrow batches, no shuffle.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

WINDOW = 3  # lines per window
SURGE = 80  # characters in a window at which main text begins ...
PEAK_SHARE = 0.5  # ... or this share of the page's peak where that is less
MARK_WEIGHT = 1.5  # what a character of marked lines counts

# Element names of the HTML standard by their part in a page.
RAW = {"script", "style", "textarea", "title", "noscript", "iframe", "noembed", "noframes", "xmp"}
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
NEVER_MAIN = {
    "head", "nav", "header", "footer", "aside", "form", "button", "select", "menu", "dialog",
    "svg", "template", "object", "canvas", "audio", "video", "fieldset", "datalist",
}
BLOCKS = {
    "address", "article", "blockquote", "body", "caption", "center", "dd", "details", "div", "dl", "dt",
    "figcaption", "figure", "h1", "h2", "h3", "h4", "h5", "h6", "hgroup", "hr", "html", "legend", "li", "main",
    "ol", "p", "pre", "section", "summary", "table", "tbody", "td", "tfoot", "th", "thead", "tr", "ul",
}
NEVER_MAIN_BLOCKS = {"nav", "header", "footer", "aside", "form", "menu", "dialog", "fieldset"}
LEAVES = {"p", "h1", "h2", "h3", "h4", "h5", "h6", "hr", "li", "dt", "dd", "td", "th", "pre", "summary", "caption"}
MARKED = {"article", "main"}
# Elements that an opening tag of the same kind closes.
SELF_CLOSING = {"p", "li", "dt", "dd", "tr", "td", "th", "option"}
# Words of class, id and role that tell what is no main text.
HINTS = {
    "ad", "ads", "adv", "advert", "adverts", "advertisement", "sponsor", "sponsored", "promo", "promotion", "banner",
    "nav", "navbar", "navigation", "menu", "breadcrumb", "breadcrumbs", "sidebar", "aside", "complementary", "widget",
    "footer", "header", "masthead", "contentinfo", "comment", "comments", "commentlist", "disqus", "reply", "replies",
    "respond", "cookie", "cookies", "consent", "gdpr", "notice", "notices", "alert", "popup", "modal", "overlay",
    "newsletter", "subscribe", "subscription", "signup", "login", "share", "sharing", "social", "related",
    "recommended", "pagination", "pager", "search", "skip", "toolbar", "tags",
}

# Those that also hold for an article, which may be a reader's comment.
COMMENT_HINTS = {"comment", "comments", "commentlist", "disqus", "reply", "replies", "respond"}

TAG = re.compile(
    r"<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)>|<[!?][^>]*>", re.S
)
ATTRIBUTE = re.compile(r"""\b(class|id|role)\s*=\s*("[^"]*"|'[^']*'|[^\s>]+)""", re.I)
HIDDEN = re.compile(r"""(?:^|\s)hidden(?:\s|=|$)|aria-hidden\s*=\s*["']?true""", re.I)
PART = re.compile(r"[a-z]+")
# First and last words of names that tell a state of what is around them, not what an element is.
STATE_FIRST = {"no", "not", "has", "with", "without", "is", "hide", "show", "js"}
STATE_LAST = {"enabled", "disabled", "open", "closed", "active", "inactive", "on", "off", "visible", "expanded", "collapsed"}
WHOLE_SHARE = 0.9  # an element with this share of the page's text is the page, whatever it is called
NOWHERE = -1


class Line:
    """Text of one block, its characters inside links, and where it stands."""

    __slots__ = ("parts", "linked", "marked", "gap", "parent", "area", "left_by")

    def __init__(self, gap: bool = False, parent: int = NOWHERE, left_by: int = NOWHERE):
        self.parts: list[str] = []
        self.linked = 0
        self.marked, self.gap = False, gap
        self.parent, self.area = parent, NOWHERE  # innermost container and innermost doubted element
        self.left_by = left_by  # the doubted element that a gap stands for

    def text(self) -> str:
        return " ".join("".join(self.parts).split())

    def size(self) -> int:
        """Characters outside links, white space not counted."""
        return max(0, sum(len("".join(part.split())) for part in self.parts) - self.linked)


def _hinted(attributes: str, hints: set[str]) -> bool:
    """Whether a class, id or role is named by a hint: as a whole, or as its first or last word."""
    for _, value in ATTRIBUTE.findall(attributes):
        for name in value.lower().split():
            words = PART.findall(name)
            if words and words[0] not in STATE_FIRST and words[-1] not in STATE_LAST:
                if words[0] in hints or words[-1] in hints:
                    return True
    return False


def _never_main(name: str, attributes: str) -> bool:
    """Boilerplate whatever it holds: by element name, hidden, a reader's comment, or a marked inline element."""
    if name in NEVER_MAIN:
        return True
    if not attributes or name in ("html", "body"):
        return False
    if HIDDEN.search(attributes):
        return True
    return name != "main" and _hinted(attributes, COMMENT_HINTS if name in BLOCKS else HINTS)


def _doubted(name: str, attributes: str) -> bool:
    """Boilerplate by class, id or role, unless it proves to hold nearly all text of the page."""
    return bool(attributes) and name in BLOCKS and name not in ("html", "body", *MARKED) and _hinted(attributes, HINTS)


class _Reader:
    """Reads one page into lines."""

    def __init__(self) -> None:
        self.lines = [Line()]
        self.open_tags: list[str] = []
        self.dropped_at: int | None = None  # depth of the element being dropped
        self.marked = self.links = self.elements = 0
        self.containers: list[tuple[int, int]] = []  # depth and number of open containers of blocks
        self.areas: list[tuple[int, int]] = []  # depth and number of open doubted elements
        self.outer: list[int] = []  # per doubted element the doubted element around it

    def begin(self) -> None:
        if self.lines[-1].parts or self.lines[-1].gap:
            self.lines.append(Line())

    def gap(self, parent: int = NOWHERE, left_by: int = NOWHERE) -> None:
        self.lines.extend(Line(True, parent, left_by) for _ in range(WINDOW))

    def left(self, name: str, area: int = NOWHERE) -> None:
        """A removed element leaves a gap; in marked text only a new line, and inside a line nothing."""
        if name not in BLOCKS and name not in NEVER_MAIN_BLOCKS:
            return
        if self.marked:
            self.begin()
        else:
            self.gap(self.containers[-1][1] if self.containers else NOWHERE, area)

    def take(self, raw: str) -> None:
        if self.dropped_at is not None or not raw:
            return
        if self.lines[-1].gap:
            self.begin()
        line = self.lines[-1]
        if not line.parts:
            line.marked = self.marked > 0
            line.parent = self.containers[-1][1] if self.containers else NOWHERE
            line.area = self.areas[-1][1] if self.areas else NOWHERE
        text = html.unescape(raw)
        line.parts.append(text)
        if self.links:
            line.linked += len("".join(text.split()))

    def pop(self) -> str:
        name = self.open_tags.pop()
        depth = len(self.open_tags)
        before = self.marked
        self.marked -= name in MARKED
        self.links -= name == "a"
        if self.containers and self.containers[-1][0] >= depth:
            self.containers.pop()
        if self.areas and self.areas[-1][0] >= depth:
            self.left(name, self.areas.pop()[1])
        if self.dropped_at is not None and depth <= self.dropped_at:
            self.dropped_at = None
            self.left(name)
        elif self.dropped_at is None and before and not self.marked:
            self.gap()
        return name

    def close(self, name: str) -> None:
        if name in self.open_tags:
            while self.pop() != name:
                pass
        if name in BLOCKS and self.dropped_at is None:
            self.begin()

    def open(self, name: str, attributes: str) -> None:
        if name in SELF_CLOSING and self.open_tags and self.open_tags[-1] == name:
            self.pop()
        if name == "br":
            self.take(" ")
        if name in BLOCKS and self.dropped_at is None:
            self.begin()
        if name in VOID or attributes.endswith("/"):
            return
        depth = len(self.open_tags)
        if self.dropped_at is None:
            if _never_main(name, attributes):
                self.dropped_at = depth
            else:
                if _doubted(name, attributes):
                    self.outer.append(self.areas[-1][1] if self.areas else NOWHERE)
                    self.areas.append((depth, len(self.outer) - 1))
                if name in BLOCKS and name not in LEAVES and name not in ("html", "body"):
                    self.containers.append((depth, self.elements))
        self.elements += 1
        self.open_tags.append(name)
        self.links += name == "a"
        if name in MARKED:
            self.marked += 1
            if self.marked == 1 and self.dropped_at is None:
                self.gap()


def lines_of(page: str) -> list[Line]:
    """Strip the markup: one line per block in page order, empty lines where boilerplate stood and marks change."""
    reader = _Reader()
    place = 0
    while found := TAG.search(page, place):
        reader.take(page[place : found.start()])
        place = found.end()
        if not found.group(2):
            continue
        name = found.group(2).lower()
        if found.group(1):
            reader.close(name)
        elif name in RAW:
            end = re.compile(rf"</{re.escape(name)}\s*>", re.I).search(page, place)
            place = end.end() if end else len(page)
        else:
            reader.open(name, found.group(3))
    reader.take(page[place:])
    return _bridged(_trusted(reader.lines, reader.outer))


def _trusted(lines: list[Line], outer: list[int]) -> list[Line]:
    """Without the lines of doubted elements, but for elements that hold nearly all text of the page."""
    if not outer:
        return lines
    sizes = [0] * len(outer)
    total = 0
    for line in lines:
        total += line.size()
        if line.area != NOWHERE:
            sizes[line.area] += line.size()
    for area in range(len(outer) - 1, -1, -1):  # an inner element has the greater number
        if outer[area] != NOWHERE:
            sizes[outer[area]] += sizes[area]
    dropped = []
    for area, size in enumerate(sizes):
        inside = outer[area] != NOWHERE and dropped[outer[area]]
        dropped.append(inside or not total or size < WHOLE_SHARE * total)
    return [
        line
        for line in lines
        if (line.area == NOWHERE or not dropped[line.area]) and (line.left_by == NOWHERE or dropped[line.left_by])
    ]


def _bridged(lines: list[Line]) -> list[Line]:
    """Without the gaps that removed elements left between blocks of one container of long blocks."""
    sizes = [line.size() for line in lines]
    long = min(SURGE, PEAK_SHARE * max(sizes, default=0))
    dense = {line.parent for line, size in zip(lines, sizes) if size > long} - {NOWHERE}
    if not dense:
        return lines
    texts = [n for n, line in enumerate(lines) if line.parts and line.text()]
    removed = set()
    for before, after in zip(texts, texts[1:]):
        parent = lines[before].parent
        between = [n for n in range(before + 1, after) if lines[n].gap]
        if parent in dense and parent == lines[after].parent and all(lines[n].parent == parent for n in between):
            removed.update(between)
    return [line for n, line in enumerate(lines) if n not in removed]


def main_text(page: str) -> str:
    """The main text of one page, blocks joined by line feeds; empty if there is none."""
    lines = lines_of(page)
    texts = [line.text() for line in lines]
    counted = []
    for text, line in zip(texts, lines):
        length = len(text.replace(" ", ""))
        counted.append(length * MARK_WEIGHT if line.marked else max(0, length - line.linked))
    sums = [sum(counted[i : i + WINDOW]) for i in range(len(lines))]
    if not any(sums):
        return ""
    surge = min(SURGE, PEAK_SHARE * max(sums))
    kept, start = [], None
    for i in range(len(sums) + 1):
        if i < len(sums) and sums[i] > 0:
            start = i if start is None else start
        elif start is not None:  # a dive: the window at i holds nothing
            if max(sums[start:i]) > surge:
                stretch = range(start, min(i, len(lines)))
                first = next(j for j in stretch if counted[j])
                kept += [texts[j] for j in stretch if j >= first and texts[j]]
            start = None
    return "\n".join(kept)


def extract(pages: DataFrame, html_col: str = "html", text_col: str = "text") -> DataFrame:
    """Replace the page column by the main text of the whole page.

    Null and empty pages, and pages without main text, give ''. Broken markup is read as far as it
    goes: an element that is not closed ends with its parent or with the page. A page of any length is read
    whole. Every row, repeated or not, gives one row, an empty table an empty one; all other columns stay;
    ``text_col`` must not be among them (ValueError).
    """
    if text_col in pages.columns and text_col != html_col:
        raise ValueError(f"column {text_col!r} is already there")
    kept = [c for c in pages.columns if c != html_col]
    rows = pages.select(*kept, F.coalesce(F.col(html_col), F.lit("")).alias(html_col))
    schema = rows.drop(html_col).withColumn(text_col, F.lit("")).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = pa.array([main_text(p.as_py()) for p in batch.column(len(kept))], pa.string())
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], texts], names=[*kept, text_col])

    return rows.mapInArrow(run, schema)
