"""HTML extraction by layout-aware rendering: all visible text, laid out as lines.

A tolerant tree builder keeps the stack of open elements, supplies the start and end tags that HTML
implies, and drives a renderer: block elements stand on lines of their own, paragraphs and headings with a blank
line around them, list items are marked and indented, table cells are padded into aligned columns,
preformatted text keeps its spaces, and what a browser does not show gives no text: elements without display
or visibility, closed details and dialogs, scripts, styles and the like.
"""

from __future__ import annotations

import html
import re
from bisect import bisect_left
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

_TAG_NAME = re.compile(r"</?([A-Za-z][^\s/>]*)")
_TAG_STOP = re.compile(r"[>\"']")
_ATTRIBUTE = re.compile(r"""([^\s=/"'>]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""")
_SPACE = re.compile(r"[ \t\n\r\f]+")

# Fixed element sets of HTML.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
UNSEEN = frozenset(
    "head title script style noscript template iframe object audio video canvas svg math datalist noembed noframes".split()
)
BLOCKS = frozenset(
    "address article aside body center details dialog dd div dl dt fieldset figcaption figure footer form header hgroup html "
    "legend li main menu nav ol optgroup option section summary ul table tr caption".split()
)
SPACED = frozenset("p h1 h2 h3 h4 h5 h6 blockquote pre table ul ol dl hr figure".split())
LISTS = frozenset(("ul", "ol", "menu"))
#: A start tag ends the innermost open element of the first set, unless one of the second is inside.
_ROWS = frozenset(("thead", "tbody", "tfoot"))
IMPLIED_ENDS = {
    "li": (frozenset(("li",)), LISTS), "dt": (frozenset(("dt", "dd")), frozenset(("dl",))),
    "dd": (frozenset(("dt", "dd")), frozenset(("dl",))), "option": (frozenset(("option",)), frozenset(("select",))),
    "optgroup": (frozenset(("option", "optgroup")), frozenset(("select",))),
    "td": (frozenset(("td", "th")), frozenset(("table",))), "th": (frozenset(("td", "th")), frozenset(("table",))),
    "tr": (frozenset(("tr",)), frozenset(("table",))),
    **{tag: (_ROWS | {"caption", "colgroup", "tr"}, frozenset(("table",))) for tag in (*_ROWS, "colgroup")},
}
#: Start tags that end an open paragraph.
ENDS_PARAGRAPH = (BLOCKS | SPACED) - frozenset(("tr", "caption", "option", "optgroup", "html", "body"))
#: Elements at which the search for an open one stops.
SCOPES = frozenset(("table", "td", "th", "caption", "html", "template", "button", "object"))

_NOT_DISPLAYED = re.compile(r"display\s*:\s*none", re.IGNORECASE)
_VISIBILITY = re.compile(r"visibility\s*:\s*(hidden|collapse|visible)", re.IGNORECASE)
#: Elements whose content shows only with the attribute ``open``; of the first, the summary always shows.
CLOSED = frozenset(("details", "dialog"))
#: The most columns and rows that a cell may span in HTML.
MOST_COLUMNS, MOST_ROWS = 1000, 65534


class _Flow:
    """Lines under way: one for the page, and one for each table cell."""

    def __init__(self) -> None:
        self.lines: list[str] = []
        self.parts: list[str] = []
        self.lead = ""
        self.blank = False
        self.space = False

    def text(self, text: str) -> None:
        collapsed = _SPACE.sub(" ", text)
        if collapsed == " " or not collapsed:
            self.space = self.space or bool(collapsed)
            return
        if self.parts and (self.space or collapsed[0] == " "):
            self.parts.append(" ")
        self.parts.append(collapsed.strip(" "))
        self.space = collapsed[-1] == " "

    def verbatim(self, text: str) -> None:
        pieces = text.split("\n")
        for piece in pieces[:-1]:
            self.parts.append(piece)
            self.end_line(keep_empty=True)
        if pieces[-1]:
            self.parts.append(pieces[-1])

    def end_line(self, keep_empty: bool = False) -> None:
        line = "".join(self.parts)
        if line or keep_empty:
            if self.blank and self.lines:
                self.lines.append("")
            self.lines.append((self.lead + line).rstrip())
            self.blank = False
        self.parts, self.space = [], False

    def gap(self) -> None:
        self.end_line()
        self.blank = True

    def laid_out(self, lines: list[str]) -> None:
        """Take over lines that are done, such as a table's."""
        if lines:
            if self.blank and self.lines:
                self.lines.append("")
            self.blank = False
            self.lines.extend([self.lead + line for line in lines] if self.lead else lines)

    def result(self) -> list[str]:
        self.end_line()
        first, last = 0, len(self.lines)
        while first < last and not self.lines[first]:
            first += 1
        while last > first and not self.lines[last - 1]:
            last -= 1
        return self.lines[first:last] if first or last < len(self.lines) else self.lines


class _Table:
    def __init__(self) -> None:
        self.rows: list[list[tuple[list[str], int, int]]] = []  # lines of each cell, columns and rows it spans
        self.caption: list[str] = []

    def lines(self) -> list[str]:
        """Rows with their columns padded to one width; a cell of several lines takes as many.

        A cell that spans columns has the width of all of them, one that spans rows keeps its columns empty in
        the rows below.  A row without text takes no line.
        """
        if all(len(row) <= 1 and (not row or row[0][1:] == (1, 1)) for row in self.rows):
            return self.caption + [line for row in self.rows for cell, *_ in row for line in cell]
        placed, widths = self._placed()
        for wide in (False, True):  # columns take what single cells need, then what spanning cells need more
            for row in placed:
                for column, (cell, span) in row.items():
                    if (span > 1) == wide and cell:
                        short = max(map(len, cell)) - sum(widths[column : column + span]) - 3 * (span - 1)
                        widths[column + span - 1] += max(short, 0)
        out = list(self.caption)
        for row in placed:
            if any(cell for cell, _ in row.values()):
                order = sorted(row.items())
                spaces = [sum(widths[column : column + span]) + 3 * (span - 1) for column, (_, span) in order]
                for at in range(max(len(cell) for cell, _ in row.values())):
                    parts = [(cell[at] if at < len(cell) else "").ljust(space) for (_, (cell, _)), space in zip(order, spaces)]
                    out.append(" | ".join(parts).rstrip())
        return out

    def _placed(self) -> tuple[list[dict[int, tuple[list[str], int]]], list[int]]:
        """Cells by their first column in every row, and a width of 0 for every column."""
        placed: list[dict[int, tuple[list[str], int]]] = []
        below: dict[int, tuple[int, int]] = {}  # first column of cells from rows above: rows left, columns
        for row in self.rows:
            here: dict[int, tuple[list[str], int]] = {c: ([], span) for c, (_, span) in below.items()}
            taken = sorted((c, c + span) for c, (_, span) in below.items())
            below = {c: (left - 1, span) for c, (left, span) in below.items() if left > 1}
            column = after = 0
            for cell, span, deep in row:
                while after < len(taken) and taken[after][0] <= column:
                    column, after = max(column, taken[after][1]), after + 1
                # A cell does not grow over one from above.
                free = min(span, taken[after][0] - column) if after < len(taken) else span
                here[column] = (cell, free)
                if deep > 1:
                    below[column] = (deep - 1, free)
                column += free
            placed.append(here)
        # Columns in which no cell begins add nothing to the layout.
        begins = sorted({c for row in placed for c in row})
        rank = {c: at for at, c in enumerate(begins)}
        return [
            {rank[c]: (cell, bisect_left(begins, c + span) - rank[c]) for c, (cell, span) in row.items()} for row in placed
        ], [0] * len(begins)


class _Renderer:
    """The stack of open elements, and what it shows."""

    def __init__(self) -> None:
        #: Tag, what it added to ``unseen``, whether text was visible before it, and its attributes if it is a cell.
        self.open: list[tuple[str, int, bool, str]] = []
        self.visible = True
        self.counts: dict[str, int] = {}
        self.unseen = 0
        self.flows = [_Flow()]
        self.tables: list[_Table] = []
        self.lists: list[list] = []  # tag, number of the next item, lead before the list
        self.verbatim = 0

    def text(self, text: str) -> None:
        if self.unseen or not self.visible or not text:
            return
        text = html.unescape(text) if "&" in text else text
        if self.open and self.open[-1][0] in ("table", "tbody", "thead", "tfoot", "tr", "colgroup") and not text.strip():
            return
        if self.verbatim:
            self.flows[-1].verbatim(text)
        else:
            self.flows[-1].text(text)

    def start(self, tag: str, attributes: str) -> None:
        if tag in ("html", "body", "head") and self.counts.get(tag):
            return
        if tag == "body" or (self.counts.get("head") and tag in ENDS_PARAGRAPH):
            self._end_through("head", SCOPES)
        if tag in ENDS_PARAGRAPH and self.counts.get("p"):
            self._end_through("p", SCOPES)
        if tag in IMPLIED_ENDS:
            closes, inside = IMPLIED_ENDS[tag]
            while any(self.counts.get(c) for c in closes) and self._end_nearest(closes, inside):
                if tag not in (*_ROWS, "colgroup", "optgroup"):
                    break
        if tag in ("td", "th") and self.tables and not self._within("tr"):
            self.start("tr", "")
        if tag == "tr" and self.tables and self._within_any(("td", "th")):
            self._end_nearest(frozenset(("td", "th")), frozenset(("table",)))
        shown, visible = self._style(tag, attributes) if attributes else (True, self.visible)
        hides = int(tag in UNSEEN or not shown or tag in CLOSED and not self._has(attributes, "open"))
        if tag == "summary" and self.open and self.open[-1][:2] == ("details", 1):
            hides = -1  # the one part of closed details that shows
        if tag in VOID:
            if not self.unseen and not hides and visible:
                if tag == "br":
                    self.flows[-1].end_line(keep_empty=bool(self.flows[-1].parts))
                elif tag == "hr":
                    self.flows[-1].gap()
                    self.flows[-1].parts.append("---")
                    self.flows[-1].gap()
            return
        self.open.append((tag, hides, self.visible, attributes if tag in ("td", "th") else ""))
        self.counts[tag] = self.counts.get(tag, 0) + 1
        self.unseen += hides
        self.visible = visible
        if not self.unseen:
            self._begin(tag, attributes)

    def _begin(self, tag: str, attributes: str) -> None:
        flow = self.flows[-1]
        if tag in SPACED and not (tag in LISTS and self.lists):
            flow.gap()
        elif tag in BLOCKS:
            flow.end_line()
        if tag in LISTS:
            number = re.search(r"\bstart\s*=\s*[\"']?(-?\d{1,9})", attributes) if tag == "ol" else None
            self.lists.append([tag, int(number[1]) if number else 1, flow.lead])
            flow.lead += "  " if len(self.lists) > 1 else ""
        elif tag == "li":
            holder = self.lists[-1] if self.lists else ["ul", 1, ""]
            if self.visible:
                flow.parts.append(f"{holder[1]}. " if holder[0] == "ol" else "- ")
            holder[1] += 1
        elif tag == "dd":
            flow.parts.append("  ")
        elif tag == "pre":
            self.verbatim += 1
        elif tag == "blockquote":
            flow.lead += "> "
        elif tag == "table":
            self.tables.append(_Table())
        elif tag == "tr" and self.tables:
            self.tables[-1].rows.append([])
        elif tag in ("td", "th", "caption") and self.tables:
            self.flows.append(_Flow())

    def end(self, tag: str) -> None:
        if tag == "p" and not self.counts.get("p"):
            if not self.unseen:
                self.flows[-1].gap()
        elif tag == "br":
            self.start("br", "")
        elif self.counts.get(tag):
            self._end_through(tag, frozenset(("table", "td", "th")) - {tag} if tag not in ("table", *_ROWS, "tr", "body", "html") else frozenset())

    def finish(self) -> str:
        while self.open:
            self._pop()
        return "\n".join(self.flows[0].result())

    def _within(self, tag: str) -> bool:
        return self._within_any((tag,))

    def _within_any(self, tags: tuple[str, ...]) -> bool:
        for name, *_ in reversed(self.open):
            if name in tags:
                return True
            if name == "table":
                return False
        return False

    def _end_nearest(self, closes: frozenset, stops: frozenset) -> bool:
        for depth, (name, *_) in enumerate(reversed(self.open), 1):
            if name in closes:
                for _ in range(depth):
                    self._pop()
                return True
            if name in stops:
                return False
        return False

    def _end_through(self, tag: str, stops: frozenset) -> None:
        self._end_nearest(frozenset((tag,)), stops - {tag})

    def _style(self, tag: str, attributes: str) -> tuple[bool, bool]:
        """Whether an element is laid out at all, and whether its text is visible."""
        lowered = attributes.lower()
        if "hidden" not in lowered and "style" not in lowered:
            return True, self.visible
        visible = self.visible
        for name, double, single, bare in _ATTRIBUTE.findall(attributes):
            value, name = double or single or bare, name.lower()
            if name == "hidden" or tag == "input" and name == "type" and value.lower() == "hidden":
                return False, visible
            if name == "style":
                if _NOT_DISPLAYED.search(value):
                    return False, visible
                for kind in _VISIBILITY.findall(value):
                    visible = kind.lower() == "visible"
        return True, visible

    @staticmethod
    def _has(attributes: str, wanted: str) -> bool:
        return wanted in attributes.lower() and any(name.lower() == wanted for name, *_ in _ATTRIBUTE.findall(attributes))

    def _pop(self) -> None:
        tag, hid, visible, attributes = self.open.pop()
        self.counts[tag] -= 1
        shown = not self.unseen
        self.unseen -= hid
        self.visible = visible
        if not shown:
            return
        flow = self.flows[-1]
        if tag in ("td", "th", "caption") and self.tables and len(self.flows) > 1:
            cell = self.flows.pop().result()
            table = self.tables[-1]
            if tag == "caption":
                table.caption = cell
            else:
                if not table.rows:
                    table.rows.append([])
                table.rows[-1].append((cell, _span(attributes, "colspan", MOST_COLUMNS), _span(attributes, "rowspan", MOST_ROWS)))
            return
        if tag == "table" and self.tables:
            flow.end_line()
            flow.laid_out(self.tables.pop().lines())
            flow.gap()
            return
        if tag in LISTS and self.lists:
            flow.end_line()
            flow.lead = self.lists.pop()[2]
            if not self.lists:
                flow.gap()
        elif tag == "pre":
            self.verbatim -= 1
            flow.gap()
        elif tag == "blockquote":
            flow.gap()
            flow.lead = flow.lead.removesuffix("> ")
        elif tag in SPACED:
            flow.gap()
        elif tag in BLOCKS:
            flow.end_line()


def _span(attributes: str, name: str, most: int) -> int:
    if name not in attributes.lower():
        return 1
    found = [d or s or b for key, d, s, b in _ATTRIBUTE.findall(attributes) if key.lower() == name]
    number = re.match(r"\s*(\d{1,6})", found[0]) if found else None
    return min(max(int(number[1]), 1), most) if number else 1


class _Scanner:
    """Finds where tags end.  A tag ends at the first ``>`` outside of quotes; from the first quote on that is never
    closed, quotes count for nothing on the page, so that no stretch is scanned twice in vain."""

    def __init__(self, page: str) -> None:
        self.page = page
        self.last = {mark: page.rfind(mark) for mark in ">\"'"}
        self.quoted = True

    def tag_end(self, at: int) -> int:
        """Place of the ``>`` that ends the tag with its name up to ``at``; -1 if none does."""
        if at > self.last[">"]:
            return -1
        spot = at
        while self.quoted:
            stop = _TAG_STOP.search(self.page, spot)
            if stop is None:
                return -1
            if stop[0] == ">":
                return stop.start()
            if self.last[stop[0]] <= stop.start():
                self.quoted = False
            else:
                spot = self.page.find(stop[0], stop.end()) + 1
                if spot > self.last[">"]:
                    self.quoted = False
        return self.page.find(">", at)


def render(page: str) -> str:
    """The visible text of a page; work grows with its length and that of the text, however deep it nests."""
    out, at, scanner = _Renderer(), 0, _Scanner(page)
    shown = 0  # text from here on is not out yet
    while True:
        at = page.find("<", at)
        if at < 0:
            out.text(page[shown:])
            return out.finish()
        name = _TAG_NAME.match(page, at)
        if name is None and page[at + 1 : at + 2] not in ("!", "?", "/"):
            at += 1
            continue
        if name is None:
            close = "-->" if page.startswith("<!--", at) else ">"
            end = page.find(close, at + (4 if close == "-->" else 1))
            end = len(page) if end < 0 else end + len(close)
        else:
            end = scanner.tag_end(name.end()) + 1
            if not end:  # a tag that nothing ends is text
                at += 1
                continue
        if at > shown:
            out.text(page[shown:at])
        begin, at, shown = at, end, end
        if name is None:
            continue
        tag = name[1].lower()
        if page[begin + 1] == "/":
            out.end(tag)
            continue
        out.start(tag, page[name.end() : end - 1])
        if tag in RAW:
            close = re.compile(rf"</{re.escape(tag)}(?=[\s/>])", re.IGNORECASE).search(page, at)
            upto = close.start() if close else len(page)
            if tag == "textarea":
                out.text(page[at:upto])
            at = shown = upto


def extract(pages: DataFrame) -> DataFrame:
    """(page_id, url, text) of every page.

    A null page has a null text and an empty one an empty text; any page_id, null or repeated, keeps its
    row; extra columns are ignored; an empty table gives an empty result.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [None if page is None else render(page) for page in batch.column("html").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string())], names=["page_id", "url", "text"]
            )

    return pages.select(
        F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.col("html").cast("string").alias("html")
    ).mapInArrow(run, "page_id long, url string, text string")
