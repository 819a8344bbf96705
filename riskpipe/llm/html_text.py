"""The visible text of HTML pages, laid out.

A tree builder keeps the stack of open elements, with the tags that HTML implies: a block ends an
open paragraph, an item the item before it, a cell the cell, a cell outside a row opens one, body
content ends the head, and closing an element closes what is still open inside it. Visibility comes
from elements that are never shown, ``hidden``, ``display: none`` and ``visibility`` in ``style``,
closed ``details`` and ``dialog``. What is visible is written as it closes, so that depth costs
nothing: paragraphs and the like are set off by an empty line, other blocks by a line break, list
items by a dash or their number, and table cells stand in columns, spanned ones included. Blanks
collapse except in ``pre``. All text is emitted, none of it is judged.

Cells wider than ``WIDEST`` do not widen their column, so padding stays in proportion to the text.
A null or empty page has an empty text. Rows are never joined: repeated rows and ids stay.
"""

from __future__ import annotations

import html
import re
from collections import Counter
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskpipe.llm.shared import map_columns

WIDEST = 60

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
NEVER = frozenset(
    "head script style template title noembed noframes iframe object audio video canvas datalist "
    "svg math select".split()
)
RAW = frozenset("script style title textarea iframe noembed noframes xmp".split())
HEAD_ONLY = frozenset("base link meta noscript script style template title".split())
SPACED = frozenset("p h1 h2 h3 h4 h5 h6 ul ol dl blockquote pre table figure fieldset hr".split())
BLOCKS = SPACED | frozenset(
    "html body div section article header footer nav main aside li dt dd form figcaption details "
    "summary center legend address dialog menu hgroup search caption option optgroup".split()
)
TABLE_PARTS = frozenset("caption colgroup thead tbody tfoot tr td th".split())
#: What a start tag ends, and the elements behind which it does not look for that.
ENDS = {
    "li": ({"li"}, {"ul", "ol", "menu"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "option": ({"option"}, {"select"}),
}

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|</([a-zA-Z][^\s/>]*)[^>]*(?:>|\Z)"
    r"|<([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)(?:>|\Z|(?=[\"']))|([^<]+)|<",
    re.S,
)
_ATTRIBUTE = re.compile(r"([^\s=/\"'>]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
_BLANK = re.compile(r"[ \t\n\r\f]+")


class Flow:
    """Lines under construction: collapsed inline text, breaks, indentation, verbatim lines."""

    def __init__(self) -> None:
        self.lines: list[str] = []
        self.parts: list[str] = []
        self.gap = 0  # empty lines wanted before the next line
        self.indents: list[list] = []  # [prefix of the first line or None, width of the others]
        self.width = 0
        self.blank = True  # whether a blank at this place would be dropped

    def text(self, text: str) -> None:
        text = _BLANK.sub(" ", text)
        if self.blank:
            text = text.lstrip(" ")
        if text:
            self.parts.append(text)
            self.blank = text[-1] == " "

    def line(self, line: str) -> None:
        if self.gap and self.lines:
            self.lines.append("")
        self.gap = 0
        prefix = ""
        if self.indents and self.indents[-1][0] is not None:
            prefix, self.indents[-1][0] = self.indents[-1][0], None
        lead = " " * (self.width - len(prefix)) + prefix
        self.lines.append((lead + line).rstrip())

    def end_line(self) -> None:
        if self.parts:
            line = "".join(self.parts).rstrip(" ")
            self.parts = []
            if line:
                self.line(line.replace("\xa0", " "))
        self.blank = True

    def forced(self) -> None:
        """A line break, which leaves an empty line where there is no text."""
        if "".join(self.parts).strip(" "):
            self.end_line()
        elif self.lines and not self.gap:
            self.lines.append("")
            self.parts, self.blank = [], True

    def block(self, spaced: bool) -> None:
        self.end_line()
        self.gap |= spaced

    def indent(self, prefix: str) -> None:
        self.end_line()
        self.indents.append([prefix, len(prefix)])
        self.width += len(prefix)

    def dedent(self) -> None:
        self.end_line()
        self.width -= self.indents.pop()[1]

    def verbatim(self, text: str) -> None:
        first, *others = text.split("\n")
        self.parts.append(first)
        for line in others:
            self.line("".join(self.parts))
            self.parts = [line]
        self.blank = False

    def done(self) -> list[str]:
        self.end_line()
        lines = self.lines
        while lines and not lines[-1]:
            lines.pop()
        while lines and not lines[0]:
            lines.pop(0)
        return lines


@dataclass
class Table:
    rows: list[list[tuple[list[str], int, int]]] = field(default_factory=list)

    def layout(self) -> list[str]:
        """Rows of cells in columns two blanks apart; a cell's lines stand below each other."""
        grid: list[dict[int, tuple[list[str], int]]] = []
        held: dict[int, int] = {}  # column -> rows that a cell above still covers
        for row in self.rows:
            placed, at = {}, 0
            for lines, wide, tall in row:
                while held.get(at, 0):
                    at += 1
                placed[at] = (lines, wide)
                for column in range(at, at + wide):
                    held[column] = max(held.get(column, 0), tall)
                at += wide
            held = {c: n - 1 for c, n in held.items() if n > 1}
            grid.append(placed)
        widths: Counter = Counter()
        for placed in grid:
            for at, (lines, wide) in placed.items():
                longest = max(map(len, lines), default=0)
                if wide == 1 and longest <= WIDEST:
                    widths[at] = max(widths[at], longest)
        result = []
        for placed in grid:
            height = max((len(lines) for lines, _ in placed.values()), default=0)
            for n in range(height):
                line, start, column = "", 0, 0
                for at in sorted(placed):
                    start += sum(widths[c] + 2 for c in range(column, at))
                    column = at
                    piece = placed[at][0][n] if n < len(placed[at][0]) else ""
                    if piece:
                        line = line.ljust(start)
                        line += "  " * (0 < start < len(line)) + piece
                result.append(line.rstrip())
        return result


@dataclass
class Element:
    tag: str
    hidden: bool
    pre: bool
    unseen: bool  # visibility: hidden, which a child can undo
    number: int = 1  # of the next item of an ordered list
    step: int = 1
    table: Table | None = None
    wide: int = 1
    tall: int = 1


def _attributes(source: str) -> dict[str, str]:
    return {
        name.lower(): html.unescape(a or b or c or "")
        for name, a, b, c in _ATTRIBUTE.findall(source)
    }


def _int(text: str | None, default: int, most: int = 10**9) -> int:
    match = re.match(r"\s*(-?[0-9]{1,9})", text or "")
    return min(int(match[1]), most) if match else default


class Page:
    """The tree builder. ``render`` feeds it a page's tokens and returns the text."""

    def __init__(self) -> None:
        self.flows = [Flow()]
        self.stack = [Element("", False, False, False)]
        self.scopes: list[Counter] = [Counter()]  # open tags since the last table cell

    def render(self, page: str) -> str:
        at, size = 0, len(page)
        while at < size:
            token = _TOKEN.match(page, at)
            at = token.end()
            end, start, rest, text = token.groups()
            if text is not None:
                self.text(html.unescape(text) if "&" in text else text)
            elif start:
                tag = start.lower()
                self.start(tag, _attributes(rest) if rest and not rest.isspace() else {})
                if tag in RAW:
                    close = re.compile(f"</{tag}(?=[\\s/>])|\\Z", re.I).search(page, at)
                    if tag in ("textarea", "xmp"):
                        self.text(html.unescape(page[at : close.start()]))
                    at = close.start()
                    if at == size:
                        break
            elif end:
                self.end(end.lower())
            elif token[0] == "<":
                self.text("<")
        while len(self.stack) > 1:
            self.pop()
        return "\n".join(self.flows[0].done())

    # -- the tree

    def text(self, text: str) -> None:
        top = self.stack[-1]
        if top.hidden or top.unseen:
            if top.tag == "head" and text.strip():
                self.pop()
                self.text(text)
            return
        if top.tag == "details" and not top.step:
            return
        if top.pre:
            self.flows[-1].verbatim(text)
        else:
            self.flows[-1].text(text)

    def is_open(self, tag: str) -> bool:
        return self.scopes[-1][tag] > 0

    def close(self, tags: set[str], behind: set[str] = frozenset()) -> None:
        """End the innermost of the open ``tags`` of this scope, unless one of ``behind`` is nearer."""
        if not any(self.is_open(t) for t in tags):
            return
        for element in reversed(self.stack):
            if element.tag in tags:
                break
            if element.tag in behind:
                return
        while self.stack[-1] is not element:
            self.pop()
        self.pop()

    def start(self, tag: str, attributes: dict[str, str]) -> None:
        if self.stack[-1].tag == "head" and tag not in HEAD_ONLY:
            self.pop()
        if tag in ("html", "body") and self.is_open(tag) or tag == "head" and self.is_open("body"):
            return
        if tag in TABLE_PARTS:
            if not self.table_part(tag):
                return
        elif tag in ENDS:
            self.close(*ENDS[tag])
        if tag in BLOCKS and tag not in TABLE_PARTS and self.is_open("p"):
            self.close({"p"})
        if tag in VOID:
            self.void(tag)
        else:
            self.push(tag, attributes)

    def table_part(self, tag: str) -> bool:
        """Make the stack ready for a part of a table; False if there is no table."""
        inside = self.is_open("table")
        if not inside and not (len(self.scopes) > 1 and self.stack_has_cell()):
            return False
        if not inside:  # in a cell: a new part of its table ends the cell
            while self.stack[-1].tag not in ("td", "th", "caption"):
                self.pop()
            self.pop()
        if tag in ("td", "th"):
            while self.stack[-1].tag not in ("tr", "table"):
                self.pop()
            if self.stack[-1].tag == "table":
                self.push("tr", {})
        else:
            while self.stack[-1].tag != "table" and not (
                tag == "tr" and self.stack[-1].tag in ("thead", "tbody", "tfoot")
            ):
                self.pop()
        return True

    def stack_has_cell(self) -> bool:
        return self.scopes[-1]["cell"] > 0

    def end(self, tag: str) -> None:
        if tag == "br":
            self.void("br")
        elif tag == "p" and not self.is_open("p"):
            self.start("p", {})
            self.pop()
        elif tag in ("table", "tr", "tbody", "thead", "tfoot") and not self.is_open(tag):
            if self.stack_has_cell():  # the end of what holds this cell
                while self.stack[-1].tag not in ("td", "th", "caption"):
                    self.pop()
                self.pop()
                self.end(tag)
        elif tag not in ("html", "body"):
            # an inline element does not end the block that was opened inside it
            self.close({tag}, frozenset() if tag in BLOCKS else BLOCKS - {"option", "optgroup"})

    # -- what is shown

    def push(self, tag: str, attributes: dict[str, str]) -> None:
        above = self.stack[-1]
        style = attributes.get("style", "").lower().replace(" ", "") if attributes else ""
        hidden = above.hidden or tag in NEVER or "hidden" in attributes or "display:none" in style
        if above.tag == "details" and tag != "summary" and above.step == 0:
            hidden = True
        if tag == "dialog" and "open" not in attributes:
            hidden = True
        unseen = above.unseen
        if "visibility:" in style:
            unseen = "visibility:hidden" in style or "visibility:collapse" in style
        element = Element(tag, hidden, above.pre or tag == "pre", unseen)
        if tag == "details":
            element.step = int("open" in attributes)
        self.scopes[-1][tag] += 1
        self.stack.append(element)
        if tag == "table":
            element.table = Table()
        elif tag == "tr":
            if table := self.table():
                table.rows.append([])
        elif tag in ("td", "th", "caption"):
            element.wide = max(1, _int(attributes.get("colspan"), 1, 100))
            element.tall = max(1, _int(attributes.get("rowspan"), 1, 1000))
            self.flows.append(Flow())
            self.scopes.append(Counter(cell=1))
        elif not hidden:
            self.opened(tag, element, attributes)

    def opened(self, tag: str, element: Element, attributes: dict[str, str]) -> None:
        flow = self.flows[-1]
        if tag in ("ul", "ol", "menu"):
            nested = self.is_open("li")
            flow.block(not nested)
            element.step = -1 if "reversed" in attributes else 1
            element.number = _int(attributes.get("start"), 1)
        elif tag == "li":
            parent = next((e for e in reversed(self.stack) if e.tag in ("ul", "ol", "menu")), None)
            if parent and parent.tag == "ol":
                parent.number = _int(attributes.get("value"), parent.number)
                flow.indent(f"{parent.number}. ")
                parent.number += parent.step
            else:
                flow.indent("- ")
        elif tag in ("dd", "blockquote"):
            flow.block(tag in SPACED)
            flow.indent("  ")
        elif tag in BLOCKS:
            flow.block(tag in SPACED)

    def void(self, tag: str) -> None:
        if self.stack[-1].hidden or self.stack[-1].unseen:
            return
        if tag == "br":
            if self.stack[-1].pre:
                self.flows[-1].verbatim("\n")
            else:
                self.flows[-1].forced()
        elif tag == "hr":
            self.flows[-1].block(True)

    def table(self) -> Table | None:
        return next((e.table for e in reversed(self.stack) if e.table is not None), None)

    def pop(self) -> None:
        element = self.stack.pop()
        tag = element.tag
        if tag in ("td", "th", "caption"):
            self.scopes.pop()
            lines = self.flows.pop().done()
            self.scopes[-1][tag] -= 1
            if element.hidden:
                return
            table = self.table()
            if tag == "caption":
                self.add_lines(lines)
            elif table and table.rows:
                table.rows[-1].append((lines, element.wide, element.tall))
            return
        self.scopes[-1][tag] -= 1
        if element.hidden:
            return
        flow = self.flows[-1]
        if tag == "table":
            self.add_lines(element.table.layout())
        elif tag in ("li", "dd", "blockquote"):
            flow.dedent()
            flow.block(tag in SPACED)
        elif tag in ("ul", "ol", "menu"):
            flow.block(not self.is_open("li"))
        elif tag in BLOCKS:
            flow.block(tag in SPACED)

    def add_lines(self, lines: list[str]) -> None:
        flow = self.flows[-1]
        flow.block(True)
        for line in lines:
            flow.line(line)
        flow.block(True)


def render(page: str | None) -> str:
    """The visible text of one page."""
    return Page().render(page) if page else ""


def visible_text(pages: DataFrame) -> DataFrame:
    """``page_id`` and the ``text`` of its ``html``."""
    return map_columns(
        pages.select("page_id", F.coalesce("html", F.lit("")).alias("html")),
        lambda keys, rows: [(k, render(page)) for k, page in zip(keys, rows, strict=True)],
        "page_id",
        "text string",
    )
