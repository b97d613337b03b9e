"""The visible text of HTML pages, laid out in lines.

Markup is read into a stack of open elements that supplies the end tags an author
may leave out, and rows around bare cells. What opens and closes drives a layout:
blocks begin on lines of their own, paragraphs and headings with a blank line
between, list items behind their bullet or number, table cells in aligned columns.
Nothing is nested in Python calls, and what is open is known by name, so pages may be
of any depth. Tables nested deeper than ``MOST_TABLES`` are not aligned: their cells are
blocks. Indentation ends at ``MOST_INDENT`` characters.

Pages are read in Arrow batches where they lie; nothing is shuffled.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from html import unescape

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Element names by their part in the layout.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
HIDDEN = frozenset("script style head title template noscript iframe noembed noframes datalist object audio video canvas".split())
# Inside of drawings and formulas: what is not shown, and what is placed by itself.
FOREIGN = frozenset("svg math".split())
HIDDEN_INSIDE = frozenset("title desc defs metadata symbol annotation annotation-xml".split())
# Elements inside of them that hold HTML again.
HTML_AGAIN = frozenset("foreignobject title desc annotation-xml".split())
PARAGRAPH = frozenset("p h1 h2 h3 h4 h5 h6 ul ol dl blockquote pre table figure fieldset hr menu dir".split())
BLOCK = PARAGRAPH | frozenset(
    "address article aside body details dialog dd div dt figcaption footer form header hgroup html legend li main nav "
    "optgroup option search section summary caption center".split()
)
CLOSES_P = (BLOCK - {"body", "html", "option", "optgroup", "legend", "caption"}) | {"hr"}
# A start tag ends open elements of the first set, but looks no further than the second.
IMPLIED = {
    "li": ({"li"}, {"ul", "ol", "menu", "dir"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "option": ({"option"}, {"select", "datalist"}),
    "optgroup": ({"option", "optgroup"}, {"select"}),
    "tr": ({"tr", "td", "th", "caption", "colgroup"}, {"table"}),
    "td": ({"td", "th", "caption", "colgroup"}, {"table", "tr"}),
    "th": ({"td", "th", "caption", "colgroup"}, {"table", "tr"}),
    "thead": ({"tr", "td", "th", "thead", "tbody", "tfoot", "caption", "colgroup"}, {"table"}),
    "tbody": ({"tr", "td", "th", "thead", "tbody", "tfoot", "caption", "colgroup"}, {"table"}),
    "tfoot": ({"tr", "td", "th", "thead", "tbody", "tfoot", "caption", "colgroup"}, {"table"}),
    "body": ({"head"}, set()),
}
SCOPE = frozenset("table td th caption button object template".split())
LISTS = frozenset("ul ol menu dir".split())
ALIGN_UP_TO = 100
MOST_SPAN = 1000
MOST_TABLES = 30
MOST_INDENT = 100
# Tags with quotes that never end are each looked through to the page's end.
MOST_ODD = 16

_TOKEN = re.compile(
    r"<!--(?:>|->|.*?(?:--!?>|\Z))|<!\[CDATA\[(?P<data>.*?)(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|</(?P<end>[a-zA-Z][^\s/>]*)[^>]*(?:>|\Z)"
    r"|<(?P<start>[a-zA-Z][^\s/>]*)(?P<attrs>(?>[^>\"']+|\"[^\"]*\"|'[^']*')*)>"
    r"|<(?P<odd>[a-zA-Z][^\s/>]*)(?P<rest>[^>]*)(?:>|\Z)",
    re.S,
)
_TOKEN_UNQUOTED = re.compile(_TOKEN.pattern.replace(r"(?>[^>\"']+|\"[^\"]*\"|'[^']*')*", "[^>]*"), re.S)
_ATTR = re.compile(r"([^\s=/>\"']+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+)))?")
_SPACE = re.compile(r"[ \t\n\r\f]+")
_NUMBER = re.compile(r"\s*([+-]?\d{1,9})")


class _Flow:
    """Lines of text under one indentation; a table cell has a flow of its own."""

    def __init__(self) -> None:
        self.lines: list[str] = []
        self.line: list[str] = []
        self.blank = 0  # lines to leave before the next text
        self.space = False
        self.indent = [""]  # of each open element that indents, with all above it
        self.mark = ""  # bullet waiting for the first line of its item

    def text(self, value: str) -> None:
        words = _SPACE.split(value)
        if len(words) == 1:
            self._put(value, False)
            return
        self._put(" ".join(words[:-1] if words[-1] == "" else words).lstrip(" "), words[0] == "")
        if words[-1] == "":
            self.space = True

    def _put(self, value: str, spaced: bool) -> None:
        if spaced:
            self.space = True
        if not value:
            return
        if self.line and self.space:
            self.line.append(" ")
        elif not self.line and self.blank and self.lines:
            self.lines.extend([""] * (self.blank - 1))
        self.blank = 0
        self.space = False
        self.line.append(value)

    def verbatim(self, value: str) -> None:
        for i, part in enumerate(value.replace("\r\n", "\n").split("\n")):
            if i:
                self.end_line(True)
            if part:
                self._put(part, False)

    def end_line(self, forced: bool = False) -> None:
        """End the current line; ``forced`` ends an empty one too."""
        if self.line or (forced and self.lines):
            first = self.indent[-2] + self.mark if self.mark else self.indent[-1]
            body = "".join(self.line)
            self.lines.append((first + body).rstrip() if body else "")
            if body:
                self.mark = ""
        self.line = []
        self.space = False

    def indented(self, by: int) -> None:
        above = self.indent[-1]
        self.indent.append(above + " " * by if len(above) + by <= MOST_INDENT else above)

    def block(self, blank: int) -> None:
        self.end_line()
        self.blank = max(self.blank, blank + 1 if blank else 0)

    def done(self) -> list[str]:
        self.end_line()
        lines = self.lines
        low, high = 0, len(lines)
        while low < high and not lines[low]:
            low += 1
        while high > low and not lines[high - 1]:
            high -= 1
        return lines[low:high]


class _Table:
    def __init__(self) -> None:
        self.rows: list[list[tuple[int, int, list[str]]]] = []  # column, columns spanned, lines
        self.below: dict[int, int] = {}  # columns taken by cells of earlier rows
        self.column = 0

    def row(self) -> None:
        self.rows.append([])
        self.column = 0
        self.taken = {c for c, n in self.below.items() if n > 0}
        self.below = {c: n - 1 for c, n in self.below.items() if n > 1}

    def cell(self, lines: list[str], across: int, down: int) -> None:
        while self.column in self.taken:
            self.column += 1
        self.rows[-1].append((self.column, across, lines))
        if down > 1:
            self.below.update({self.column + i: down - 1 for i in range(across)})
        self.column += across

    def lines(self) -> list[str]:
        widths: dict[int, int] = {}
        for column, across, cell in (c for row in self.rows for c in row):
            if across == 1:
                widths[column] = max(widths.get(column, 0), min(ALIGN_UP_TO, max(map(len, cell), default=0)))
        starts: dict[int, int] = {}
        at = 0
        for column in range(max((c + n for row in self.rows for c, n, _ in row), default=0)):
            starts[column] = at
            at += widths[column] + 2 if column in widths else 0
        out = []
        for row in self.rows:
            side_by_side: list[list[tuple[int, str]]] = [[] for _ in range(max((len(cell) for _, _, cell in row), default=0))]
            for column, _, cell in row:
                for beside, text in zip(side_by_side, cell):
                    if text:
                        beside.append((column, text))
            for beside in side_by_side:
                line = ""
                for column, text in beside:
                    gap = starts[column] - len(line)
                    line += " " * (gap if gap > 0 or not line else 2) + text
                out.append(line.rstrip())
        return out


class _Open:
    """An open element and what it changes in the layout until it is closed."""

    __slots__ = ("name", "hidden", "pre", "count", "table", "flow", "span", "indented", "foreign", "block")

    def __init__(self, name: str, hidden: str, pre: bool) -> None:
        self.name, self.hidden, self.pre = name, hidden, pre
        self.count: int | None = None
        self.table: _Table | None = None
        self.flow: _Flow | None = None
        self.span = (1, 1)
        self.indented = False
        self.foreign = False
        self.block = name in BLOCK


class _Page:
    def __init__(self) -> None:
        self.flow = _Flow()
        self.stack: list[_Open] = [_Open("", "", False)]
        self.places: dict[str, list[int]] = {}  # where elements of a name stand on the stack
        self.tables: list[_Table | None] = []  # open tables, None for those nested too deep to be aligned

    def _open(self, item: _Open) -> None:
        self.places.setdefault(item.name, []).append(len(self.stack))
        self.stack.append(item)

    def _innermost(self, names: set | frozenset) -> int:
        return max((self.places[n][-1] for n in names if self.places.get(n)), default=0)

    def text(self, value: str) -> None:
        top = self.stack[-1]
        if top.hidden or not value:
            return
        if top.name in ("table", "tr", "tbody", "thead", "tfoot") and not value.strip():
            return
        if "&" in value:
            value = unescape(value)
        self.flow.verbatim(value) if top.pre else self.flow.text(value)

    @property
    def foreign(self) -> bool:
        """Whether a drawing or formula is open, where other names hold."""
        return self.stack[-1].foreign

    def start(self, name: str, attrs: dict[str, str], ended: bool = False) -> None:
        if self.foreign and name not in CLOSES_P or name in FOREIGN:
            self._start_foreign(name, attrs, ended)
            return
        # HTML that an author left a drawing or formula open for ends it.
        while self.foreign:
            self._close_to(len(self.stack) - 1)
        if name in CLOSES_P and self._find({"p"}, SCOPE):
            self._close_to(self._find({"p"}, SCOPE))
        if name in IMPLIED:
            ends, scope = IMPLIED[name]
            while at := self._find(ends, scope):
                self._close_to(at)
        if name in ("td", "th") and not self._find({"tr"}, {"table"}) and self._find({"table"}, set()):
            self.start("tr", {})
        if name in ("html", "body") and self._find({name}, set()):
            return
        if self.stack[-1].name == "head" and name not in ("title", "meta", "link", "base", "style", "script", "noscript", "template", "head"):
            self._close_to(len(self.stack) - 1)
        above = self.stack[-1]
        hidden = self._hidden(attrs, name in HIDDEN or name == "dialog" and "open" not in attrs)
        if name == "br":
            if not hidden:
                self.flow.end_line(True)
            return
        if name == "input" and not hidden and attrs.get("type", "").lower() in ("submit", "button", "reset"):
            self.text(attrs.get("value", ""))
        if name in VOID:
            if name == "hr" and not hidden:
                self.flow.block(1)
            return
        item = _Open(name, hidden, above.pre or name in ("pre", "textarea", "xmp"))
        self._open(item)
        if hidden == "none":
            return
        if name in BLOCK:
            nested = name in LISTS and self._find({"li"}, {"table"})
            self.flow.block(1 if name in PARAGRAPH and not nested else 0)
        if name in LISTS:
            item.count = _number(attrs.get("start"), 1) if name == "ol" else None
        elif name == "li":
            owner = self.stack[self._innermost(LISTS)]
            mark = "- "
            if owner.name == "ol":
                owner.count = _number(attrs.get("value"), owner.count)
                mark = f"{owner.count}. "
                owner.count += 1
            self.flow.indented(len(mark))
            self.flow.mark = mark
            item.indented = True
        elif name in ("blockquote", "dd"):
            self.flow.indented(2)
            item.indented = True
        elif name == "table":
            item.table = _Table() if len(self.tables) < MOST_TABLES else None
            self.tables.append(item.table)
        elif name in ("tr", "td", "th") and self.tables and self.tables[-1] is None:
            self.flow.block(0)
            item.block = True
        elif name == "tr":
            if self.tables:
                self.tables[-1].row()
        elif name in ("td", "th"):
            if self.tables:
                table = self.tables[-1]
                if not table.rows:
                    table.row()
                item.span = _number(attrs.get("colspan"), 1), _number(attrs.get("rowspan"), 1)
                item.flow, self.flow = self.flow, _Flow()

    def _hidden(self, attrs: dict[str, str], always: bool) -> str:
        above = self.stack[-1].hidden
        hidden = "none" if above == "none" or always or "hidden" in attrs else above
        style = attrs.get("style", "").replace(" ", "").lower() if attrs else ""
        if "display:none" in style:
            hidden = "none"
        elif hidden != "none" and "visibility:" in style:
            hidden = "" if "visibility:visible" in style else "text"
        return hidden

    def _start_foreign(self, name: str, attrs: dict[str, str], ended: bool) -> None:
        """An element of a drawing or formula; its end tags are never left out."""
        if ended:
            return
        inside = self.foreign
        hidden = self._hidden(attrs, inside and name in HIDDEN_INSIDE or name in ("script", "style"))
        item = _Open(name, hidden, self.stack[-1].pre)
        item.foreign = name not in HTML_AGAIN
        item.block = inside and name in ("text", "foreignobject")
        self._open(item)
        if item.block and hidden != "none":
            self.flow.block(0)

    def end(self, name: str) -> None:
        if name == "br":
            self.start("br", {})
        elif name == "p" and not self._find({"p"}, SCOPE):
            self.flow.block(1)
        elif at := self._find({name}, SCOPE - {name} if name not in ("table", "tbody", "thead", "tfoot", "tr", "body", "html") else {"table"} - {name}):
            self._close_to(at)

    def finish(self) -> str:
        self._close_to(1)
        return "\n".join(self.flow.done())

    def _find(self, names: set, scope: set | frozenset) -> int:
        """Where the innermost such element stands on the stack; 0 if there is none."""
        at = self._innermost(names)
        return at if at and at > self._innermost(scope - names) else 0

    def _close_to(self, at: int) -> None:
        while len(self.stack) > at:
            item = self.stack.pop()
            self.places[item.name].pop()
            if item.hidden == "none":
                continue
            if item.flow is not None:
                lines, self.flow = self.flow.done(), item.flow
                self.tables[-1].cell(lines, *(max(1, min(MOST_SPAN, n)) for n in item.span))
            elif item.table is not None:
                self.tables.pop()
                self.flow.block(1)
                for line in item.table.lines():
                    if line:
                        self.flow._put(line, False)
                    self.flow.end_line(True)
                self.flow.block(1)
            elif item.block:
                if item.name == "table":
                    self.tables.pop()
                self.flow.block(1 if item.name in PARAGRAPH and not (item.name in LISTS and self._find({"li"}, {"table"})) else 0)
            if item.indented:
                self.flow.indent.pop()
                if item.name == "li":
                    self.flow.mark = ""


def _number(value: str | None, default: int) -> int:
    found = _NUMBER.match(value) if value else None
    return int(found[1]) if found else default


def _attrs(text: str) -> dict[str, str]:
    return {
        name.lower(): unescape(a or b or c) if a or b or c else ""
        for name, a, b, c in reversed(_ATTR.findall(text))  # the first of repeated attributes holds
    }


def visible_text(html: str | None) -> str:
    """All visible text of a page in lines; of a null or empty page the empty text."""
    if not html:
        return ""
    page, at, end, odd = _Page(), 0, len(html), 0
    while at < end:
        found = html.find("<", at)
        if found < 0:
            page.text(html[at:])
            break
        token = (_TOKEN if odd < MOST_ODD else _TOKEN_UNQUOTED).match(html, found)
        if token is None:  # a lone "<" is text
            page.text(html[at : found + 1])
            at = found + 1
            continue
        if found > at:
            page.text(html[at:found])
        at = token.end()
        if name := token["end"]:
            page.end(name.lower())
        elif name := token["start"] or token["odd"]:
            odd += token["odd"] is not None
            name = name.lower()
            rest = token["attrs"] if token["start"] else token["rest"]
            foreign = page.foreign
            page.start(name, _attrs(rest) if rest and rest.strip(" /") else {}, rest.rstrip().endswith("/"))
            if name in RAW and not foreign:
                close = re.compile(rf"</{name}(?=[\s/>])", re.I).search(html, at)
                stop = close.start() if close else end
                page.text(html[at:stop])
                at = stop
        elif token["data"]:
            page.text(token["data"])
    return page.finish()


def extract_text(pages: DataFrame, html_col: str = "html") -> DataFrame:
    """The pages with ``text`` instead of their HTML.

    Hidden elements and those without display are left out; scripts, styles, the head
    and noscript parts too. Of inline SVG and MathML the labels and formulas are shown,
    without titles, descriptions, definitions, metadata and annotations. A null or empty page has an empty text. Columns of a
    table are padded up to 100 characters, longer cells stand as they are. Repeated
    rows stay; other columns are kept, ``text`` replaces one of that name.
    """

    @F.pandas_udf("string")
    def render(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for htmls in batches:
            yield pd.Series([visible_text(h) for h in htmls], dtype=object)

    return pages.withColumn("__text", render(F.col(html_col))).drop(html_col).withColumn("text", F.col("__text")).drop("__text")
