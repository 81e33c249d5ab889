"""Layout-aware rendering of HTML to text.

Tags are read into a stack of open elements with the ends that HTML implies: a block ends an open paragraph, a list item the one before it, a
row or cell its neighbours, an end tag everything opened inside, and the head ends before the first thing that has no place in it. What no browser shows is left out: head, scripts and styles, comments, templates,
elements with ``hidden`` or ``display:none``, what ``visibility`` hides (parts made visible again inside are kept), and text between the parts of a table's grid is moved out before it.
All other text is kept, in order: white space collapses outside ``pre``, blocks start on lines of their own,
paragraphs and the like stand apart by an empty line, list items carry their mark and are indented, and the cells of a table are
padded so that its columns align. Cells take as many columns and rows as ``colspan`` and ``rowspan`` say.

The text grows in proportion to the page: beyond ``MOST_INDENT`` columns a block is indented no further, a line of more than ``MOST_WIDTH`` characters
does not widen its column, and cells beyond ``MOST_COLUMNS`` columns follow one another. No text is lost by that.

No recursion is used, so nesting may be as deep as the page is long. Null pages give null, empty ones the empty text. Broken markup never fails: a
``<`` that starts no tag is text. Other columns are not touched; rows with the same id are rendered each by itself.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame

BLANKS = " \t\n\r\f"
RUN = re.compile(f"[{BLANKS}]+")
# A quote opens a value only right after the equals sign; in a name or a value without quotes it is a character like others.
VALUE = rf"\"[^\"]*+(?:\"|\Z)|'[^']*+(?:'|\Z)|[^{BLANKS}>\"'][^{BLANKS}>]*+"
PAIR = rf"[^{BLANKS}/>][^{BLANKS}/>=]*+(?:[{BLANKS}]*+=[{BLANKS}]*+(?:{VALUE})?+)?+"
TAG = re.compile(rf"<!--.*?(?:--!?>|\Z)|<![^>]*(?:>|\Z)|<\?[^>]*(?:>|\Z)|<(/?)([a-zA-Z][^{BLANKS}/>]*+)((?:[{BLANKS}/]++|{PAIR})*+)(?:>|\Z)", re.DOTALL)
ATTRIBUTE = re.compile(rf"([^{BLANKS}/>][^{BLANKS}/>=]*+)(?:[{BLANKS}]*+=[{BLANKS}]*+({VALUE})?+)?+")
DISPLAY = re.compile(r"(?<![-\w])display\s*:\s*([-\w]+)", re.IGNORECASE)
VISIBILITY = re.compile(r"(?<![-\w])visibility\s*:\s*(visible|initial|hidden|collapse)", re.IGNORECASE)

MOST_INDENT = 80
MOST_WIDTH = 120
MOST_COLUMNS = 200

# Names of HTML elements by what they do.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title iframe noembed noframes xmp".split())
UNSEEN = frozenset("head script style title meta link base template noscript iframe noembed noframes datalist object audio video canvas rp".split())
IN_HEAD = frozenset("base basefont bgsound head html link meta noframes noscript script style template title".split())
APART = frozenset("p h1 h2 h3 h4 h5 h6 ul ol dl table blockquote pre figure fieldset hr menu".split())
BLOCK = APART | frozenset(
    "address article aside body center dd details dialog dir div dt fieldset figcaption footer form header hgroup html legend li main nav option search section summary tr td th caption thead tbody tfoot".split()
)
ENDS_P = (BLOCK - frozenset("body html td th tr caption thead tbody tfoot option legend".split())) | {"table"}
# What the start of an element ends, and the elements that keep those outside them open.
ENDS = {
    "li": ({"li"}, {"ul", "ol", "menu"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "option": ({"option"}, {"select", "datalist"}),
    "tr": ({"tr", "td", "th", "caption"}, {"table"}),
    "td": ({"td", "th", "caption"}, {"table", "tr"}),
    "th": ({"td", "th", "caption"}, {"table", "tr"}),
    "thead": ({"thead", "tbody", "tfoot", "caption"}, {"table"}),
    "tbody": ({"thead", "tbody", "tfoot", "caption"}, {"table"}),
    "tfoot": ({"thead", "tbody", "tfoot", "caption"}, {"table"}),
}
SCOPE = frozenset("table td th caption html template".split())


class Writer:
    """Lines of text with blocks, gaps and indents."""

    def __init__(self):
        self.lines: list[str] = []
        self.parts: list[str] = []
        self.space = False
        self.gap = 0
        self.indent = 0
        self.mark = ""

    def text(self, text: str) -> None:
        words = RUN.split(text)
        if words[0] == "" and self.parts:
            self.space = True
        found = [w for w in words if w]
        if not found:
            return
        if self.space and self.parts:
            self.parts.append(" ")
        self.parts.append(" ".join(found))
        self.space = words[-1] == ""

    def exact(self, text: str) -> None:
        first, *more = text.replace("\r\n", "\n").split("\n")
        if first:
            self.parts.append(first)
        for line in more:
            self.new_line()
            if line:
                self.parts.append(line)

    def new_line(self) -> None:
        if self.parts:
            self.end()
        elif self.lines and not self.gap:
            self.lines.append("")

    def end(self) -> None:
        if self.parts:
            self.put(["".join(self.parts)])
            self.parts = []
        self.space = False

    def put(self, rows: list[str]) -> None:
        if self.lines and self.gap > 1:
            self.lines.append("")
        for row in rows:
            start = " " * (min(self.indent, MOST_INDENT) - len(self.mark)) + self.mark
            self.lines.append((start + row).rstrip(" "))
            self.mark = ""
        self.gap = 0

    def block(self, gap: int) -> None:
        self.end()
        self.gap = max(self.gap, gap)


@dataclass
class Cell:
    lines: list[str]
    columns: int
    rows: int  # 0: all that follow


def columns_of(widths: list[int]) -> list[int]:
    """Where each column begins, and where one after the last would; two blanks apart."""
    out = [0]
    for width in widths:
        out.append(out[-1] + width + 2)
    return out


class Table:
    """Rows of finished cells."""

    def __init__(self):
        self.rows: list[list[Cell]] = []
        self.captions: list[str] = []

    def places(self) -> list[list[tuple[int, Cell]]]:
        """The column each cell begins in: the first one that no cell of a row above reaches down into."""
        taken = [0] * MOST_COLUMNS  # the row up to which a column is taken
        out = []
        for at_row, row in enumerate(self.rows):
            at, placed = 0, []
            for cell in row:
                while at < MOST_COLUMNS and taken[at] > at_row:
                    at += 1
                placed.append((at, cell))
                down = at_row + cell.rows if cell.rows else len(self.rows)
                for at in range(at, min(at + cell.columns, MOST_COLUMNS)):
                    taken[at] = max(taken[at], down)
                at = min(at + 1, MOST_COLUMNS)
            out.append(placed)
        return out

    def widths(self, rows: list[list[tuple[int, Cell]]]) -> list[int]:
        out = [0] * min(MOST_COLUMNS, max((at + cell.columns for row in rows for at, cell in row), default=0))
        for wide in (False, True):  # cells of several columns only add what those lack
            for row in rows:
                for at, cell in row:
                    if at >= MOST_COLUMNS or (cell.columns > 1) != wide:
                        continue
                    need = max((len(x) for x in cell.lines if len(x) <= MOST_WIDTH), default=0)
                    last = min(at + cell.columns, MOST_COLUMNS)
                    out[last - 1] += max(0, need - sum(out[at:last]) - 2 * (last - at - 1))
        return out

    def lines(self) -> list[str]:
        rows = [row for row in self.places() if any(any(cell.lines) for _, cell in row)]
        begin = columns_of(self.widths(rows))
        out = list(self.captions)
        for row in rows:
            parts: list[list[tuple[int, str]]] = [[] for _ in range(max(len(cell.lines) for _, cell in row))]
            for at, cell in row:
                for k, line in enumerate(cell.lines):
                    if line:
                        parts[k].append((begin[min(at, len(begin) - 1)], line))
            for cells in parts:
                pieces, length = [], 0
                for at, line in cells:  # padded only where text follows
                    gap = max(at - length, 2 if length else 0)
                    pieces += [" " * gap, line]
                    length += gap + len(line)
                out.append("".join(pieces))
        return out


class Element:
    __slots__ = ("hidden", "indent", "invisible", "items", "name", "ordered", "pre", "span", "table", "writer")

    def __init__(self, name: str, hidden: bool, invisible: bool, pre: bool):
        self.name, self.hidden, self.invisible, self.pre = name, hidden, invisible, pre  # what is invisible still takes its place
        self.items, self.ordered, self.indent = 0, False, 0
        self.span = (1, 1)  # columns and rows of a cell
        self.table: Table | None = None
        self.writer: Writer | None = None  # of the text around a cell


def values_of(attributes: str) -> dict[str, str]:
    found: dict[str, str] = {}
    for m in ATTRIBUTE.finditer(attributes):
        value = m[2] or ""
        found.setdefault(m[1].lower(), unescape(value.strip(value[0]) if value[:1] in ("'", '"') else value))
    return found


def span_of(attributes: str) -> tuple[int, int]:
    """Columns and rows that a cell takes; 0 rows: all that follow."""
    if "span" not in attributes.lower():
        return 1, 1
    found, out = values_of(attributes), []
    for name, least in (("colspan", 1), ("rowspan", 0)):
        digits = re.match(r"\s*\+?(\d{1,6})", found.get(name, ""))
        out.append(max(int(digits[1]), least) if digits else 1)
    return out[0], out[1]


class Page:
    """The open elements of a page and what has been written."""

    def __init__(self):
        self.open: list[Element] = [Element("", False, False, False)]
        self.writer = Writer()
        self.counts: dict[str, int] = {}
        self.tables: list[Table] = []

    def looks(self, attributes: str, invisible: bool) -> tuple[bool, bool]:
        """Whether the attributes hide an element, and whether it is invisible; ``invisible``: of the element around."""
        lowered = attributes.lower()
        if "hidden" not in lowered and "style" not in lowered:
            return False, invisible
        found = values_of(attributes)
        style = found.get("style", "")
        for said in VISIBILITY.findall(style):
            invisible = said.lower() in ("hidden", "collapse")
        shown = DISPLAY.findall(style)[-1:]  # the last one counts
        return "hidden" in found or bool(shown and shown[0].lower() == "none"), invisible

    def start(self, name: str, attributes: str) -> None:
        if name not in IN_HEAD:
            self.end_head()
        elif name == "head" and any(e.name not in ("", "html") for e in self.open) or name == "html" and self.counts.get("head"):
            return  # has no effect there
        if name in ENDS_P and self.counts.get("p"):
            self.end_inside({"p"}, SCOPE)
        if name in ENDS:
            self.end_inside(*ENDS[name])
        top = self.open[-1]
        hides, invisible = self.looks(attributes, top.invisible) if attributes else (False, top.invisible)
        hidden = top.hidden or name in UNSEEN or hides or name == "dialog" and "open" not in values_of(attributes)
        if name == "input" or name in VOID:
            if not hidden:
                if name == "br" and invisible:
                    self.writer.block(1)
                elif name == "br":
                    self.writer.new_line()
                    self.writer.space = False
                elif name == "hr":
                    self.writer.block(2)
            return
        element = Element(name, hidden, invisible, top.pre or name in ("pre", "textarea"))
        self.open.append(element)
        self.counts[name] = self.counts.get(name, 0) + 1
        if hidden:
            return
        if name in ("td", "th", "caption") and self.tables:
            table = self.tables[-1]
            if name != "caption" and not (table.rows and self.counts.get("tr")):
                table.rows.append([])  # a row that was never started
            element.writer, self.writer = self.writer, Writer()
            element.span = span_of(attributes)
            return
        if name == "tr" and self.tables:
            self.tables[-1].rows.append([])
            return
        if name in BLOCK:
            self.writer.block(2 if name in APART and not (name in ("ul", "ol", "menu") and self.counts.get("li")) else 1)
        if name == "table":
            element.table = Table()
            self.tables.append(element.table)
        elif name == "li":
            lists = (self.open[at] for at in range(len(self.open) - 2, -1, -1) if self.open[at].name in ("ul", "ol", "menu"))
            around = next(lists, None)
            mark = "- "
            if around is not None:
                around.items += 1
                mark = f"{around.items}. " if around.name == "ol" else mark
            self.indented(element, len(mark))
            self.writer.mark = "" if invisible else mark
        elif name in ("dd", "blockquote"):
            self.indented(element, 4)

    def end_head(self) -> None:
        if self.open[-1].name == "head":
            self.close(len(self.open) - 1)

    def indented(self, element: Element, by: int) -> None:
        element.indent = by
        self.writer.indent += by

    def end_inside(self, names: set[str], border: set[str] | frozenset[str]) -> None:
        """End the innermost open element of these names, unless one of ``border`` is open inside it."""
        if not any(self.counts.get(n) for n in names):
            return
        for at in range(len(self.open) - 1, 0, -1):
            name = self.open[at].name
            if name in names:
                self.close(at)
                return self.end_inside(names, border) if len(names) > 1 else None
            if name in border:
                return None
        return None

    def finish(self, name: str) -> None:
        """An end tag."""
        if name == "br":
            return self.start("br", "")
        if not self.counts.get(name):
            if name == "p":
                self.writer.block(2)
            return None
        border = {"table"} if name not in ("table", "html", "body") and self.counts.get("table") else set()
        for at in range(len(self.open) - 1, 0, -1):
            if self.open[at].name == name:
                return self.close(at)
            if self.open[at].name in border:
                return None
        return None

    def close(self, at: int) -> None:
        """Close an element and all that are open in it."""
        while len(self.open) > at:
            e = self.open.pop()
            self.counts[e.name] -= 1
            if e.hidden:
                continue
            if e.writer is not None:
                self.writer.end()
                lines, self.writer = self.writer.lines, e.writer
                if e.name == "caption":
                    self.tables[-1].captions += lines
                else:
                    self.tables[-1].rows[-1].append(Cell(lines, *e.span))
                continue
            if e.table is not None:
                self.tables.pop()
                lines = e.table.lines()
                if lines:
                    self.writer.block(2)
                    self.writer.put(lines)
            if e.indent:
                self.writer.end()
                self.writer.mark = ""
                self.writer.indent -= e.indent
            if e.name in BLOCK and not (e.name == "tr" and self.tables):
                self.writer.block(2 if e.name in APART and not (e.name in ("ul", "ol", "menu") and self.counts.get("li")) else 1)

    def text(self, text: str) -> None:
        if text.strip(BLANKS):
            self.end_head()
        top = self.open[-1]
        if top.hidden or top.invisible or not text:
            return
        if top.pre:
            self.writer.exact(text)
        else:
            self.writer.text(text)


def render(html: str | None) -> str | None:
    if html is None:
        return None
    page, at, n = Page(), 0, len(html)
    while at < n:
        m = TAG.search(html, at)
        if m is None:
            page.text(unescape(html[at:]))
            break
        if m.start() > at:
            page.text(unescape(html[at : m.start()]))
        at = m.end()
        if m[2] is None:
            continue
        name = m[2].lower()
        if m[1]:
            page.finish(name)
            continue
        page.start(name, m[3])
        if name in RAW:
            end = re.compile(rf"</{name}(?=[\s/>])[^>]*>", re.IGNORECASE).search(html, at)
            inner = html[at : end.start()] if end else html[at:]
            page.text(unescape(inner) if name in ("textarea", "title") else inner)
            page.finish(name)
            at = end.end() if end else n
        elif name == "pre" and html.startswith("\n", at):
            at += 1
    page.close(1)
    page.writer.end()
    return "\n".join(page.writer.lines)


def extract(pages: DataFrame, key: str = "page_id", html: str = "html") -> DataFrame:
    """``key`` and ``text`` of each page."""
    kind = dict(pages.dtypes)[key]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for lo in range(0, b.num_rows, 500):
                some = b.slice(lo, 500)
                texts = [render(x.as_py()) for x in some.column(1)]
                yield pa.RecordBatch.from_arrays([some.column(0), pa.array(texts, pa.string())], names=["_key", "text"])

    return pages.select(key, html).mapInArrow(run, f"_key {kind}, text string").withColumnRenamed("_key", key)
