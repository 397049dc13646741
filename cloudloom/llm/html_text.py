"""Visible text of web pages, laid out roughly as a browser would show it.

A tree is built with the implied start and end tags of HTML, nodes that are not
shown are left out, and the rest is rendered: blocks on lines of their own with
a blank line where margins stand, lists with markers and indents, tables with
aligned cells. Both steps keep their own stacks, so pages may be nested to any
depth. Spaces for layout are bounded (``COLUMN``, ``ALIGNED``, ``TABLES``,
``INDENT``), so a page's text is at most a constant times as long as the page.
"""

from __future__ import annotations

import re
from bisect import bisect_right
from collections import defaultdict
from collections.abc import Iterator
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import raw, slices

# Element classes of the HTML standard.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
HIDDEN = frozenset(
    "head script style template noscript title iframe object datalist audio video canvas area base col link meta param source track "
    "rp metadata defs desc annotation annotation-xml".split()
)
#: Elements that can stand in a page's head; any other ends it.
IN_HEAD = frozenset("base basefont bgsound link meta noframes noscript script style template title".split())
BLOCKS = frozenset(
    "address article aside blockquote body center details dialog dd div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 "
    "header hgroup html legend li main menu nav ol optgroup option p pre search section summary table textarea ul hr".split()
)
MARGINS = frozenset("blockquote dl figure h1 h2 h3 h4 h5 h6 menu ol p pre table ul fieldset hr".split())
CLOSES_P = frozenset(
    "address article aside blockquote center details dialog div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr "
    "main menu nav ol p pre search section table ul".split()
)
LISTS = frozenset("ul ol menu".split())
ROWS = frozenset("thead tbody tfoot".split())
#: Elements beyond which the end of a paragraph is not looked for.
P_SCOPE = frozenset("td th table button caption li dd dt blockquote div section article html object".split())
#: An open element that a start tag closes, and the elements beyond which it does not look.
CLOSED_BY = {
    "li": ({"li"}, {"ul", "ol", "menu"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th", "caption", "colgroup"}, {"table"}),
    "td": ({"td", "th", "caption"}, {"tr", "table"}),
    "th": ({"td", "th", "caption"}, {"tr", "table"}),
    "thead": ({"tr", "td", "th", "thead", "tbody", "tfoot", "caption", "colgroup"}, {"table"}),
    "tbody": ({"tr", "td", "th", "thead", "tbody", "tfoot", "caption", "colgroup"}, {"table"}),
    "tfoot": ({"tr", "td", "th", "thead", "tbody", "tfoot", "caption", "colgroup"}, {"table"}),
    "option": ({"option"}, {"select", "datalist"}),
    "optgroup": ({"option", "optgroup"}, {"select"}),
    "select": ({"select"}, {"table"}),
    "input": ({"select"}, {"table"}),
    "textarea": ({"select"}, {"table"}),
    "rt": ({"rt", "rp"}, {"ruby"}),
    "rp": ({"rt", "rp"}, {"ruby"}),
}
#: Kinds of input fields that show no text of theirs (fixed values).
SILENT = frozenset("hidden checkbox radio password file color range image".split())
#: Characters to which the cells of a column are padded at most, and the place in a line up to which cells are aligned.
COLUMN, ALIGNED = 60, 200
#: Tables in tables up to this depth are aligned; the cells of deeper ones stand one below the other.
TABLES = 6
#: Most characters of indent.
INDENT = 40
_STYLE_HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*(hidden|collapse)", re.I)
_SPACE = re.compile(r"[ \t\n\r\f]+")
_NUMBER = re.compile(r"\s*([0-9]{1,9})")


def _span(value: str | None, most: int) -> int:
    """A column or row span: 1 if it is no number, 1 to ``most`` else."""
    found = _NUMBER.match(value or "")
    return min(max(int(found[1]), 1), most) if found else 1


class Node:
    __slots__ = ("across", "children", "down", "hidden", "start", "tag")

    def __init__(self, tag: str, hidden: bool = False, start: int = 1, across: int = 1, down: int = 1):
        self.tag, self.hidden, self.start, self.across, self.down, self.children = tag, hidden, start, across, down, []


class TreeBuilder(HTMLParser):
    """Nodes and strings from start tags, end tags and text."""

    CDATA_CONTENT_ELEMENTS = ("script", "style")

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.root = Node("html")
        self.open = [self.root]
        self.had_head = False
        self.places: dict[str, list[int]] = defaultdict(list)  # of the open elements, by tag

    def _push(self, node: Node) -> None:
        self.places[node.tag].append(len(self.open))
        self.open[-1].children.append(node)
        self.open.append(node)

    def _pop_to(self, at: int) -> None:
        """Closes the open elements from this place on."""
        for node in self.open[at:]:
            self.places[node.tag].pop()
        del self.open[at:]

    def _nearest(self, tags) -> int:
        """Place of the innermost open element of these, 0 if there is none."""
        return max((self.places[t][-1] for t in tags if self.places[t]), default=0)

    def _close(self, tags, stop=()) -> None:
        """Closes the outermost of these elements within the nearest of ``stop``."""
        outside = self._nearest(stop)
        inside = [held[k] for held in (self.places[t] for t in tags) if (k := bisect_right(held, outside)) < len(held)]
        if inside:
            self._pop_to(min(inside))

    def handle_starttag(self, tag: str, attrs) -> None:
        if tag in ("html", "body"):
            if tag == "body":
                self._close({"head"})
            return
        if tag == "head":
            if self.had_head or len(self.open) > 1:
                return  # a second head, or one in the body
            self.had_head = True
        if tag not in IN_HEAD and self.open[-1].tag == "head":
            self._pop_to(len(self.open) - 1)
        if tag in CLOSED_BY:
            self._close(*CLOSED_BY[tag])
        if tag in CLOSES_P:
            self._close({"p"}, P_SCOPE)
        here = self.open[-1].tag
        if tag == "tr" and here == "table":
            self._push(Node("tbody"))
        elif tag in ("td", "th") and (here == "table" or here in ROWS):
            if here == "table":
                self._push(Node("tbody"))
            self._push(Node("tr"))
        values = dict(attrs)
        start = values.get("start") or "1"
        kind = (values.get("type") or "text").strip().lower()
        hidden = (
            tag in HIDDEN
            or "hidden" in values
            or (tag == "input" and kind in SILENT)
            or (tag == "dialog" and "open" not in values)
            or bool(_STYLE_HIDDEN.search(values.get("style") or ""))
        )
        node = Node(
            tag, hidden, int(start) if re.fullmatch(r"-?[0-9]{1,9}", start) else 1, _span(values.get("colspan"), 1_000), _span(values.get("rowspan"), 65_534)
        )
        if tag == "details" and "open" not in values:
            node.start = 0  # only its summary shows
        if tag in VOID:
            self.open[-1].children.append(node)
            shown = values.get("alt") if tag == "img" else (values.get("value") or values.get("placeholder")) if tag == "input" else None
            if shown and not hidden:
                node.children.append(shown)
        else:
            self._push(node)

    def handle_startendtag(self, tag: str, attrs) -> None:
        self.handle_starttag(tag, attrs)
        if (self.places["svg"] or self.places["math"]) and self.open[-1].tag == tag:  # only there does the slash close
            self._pop_to(len(self.open) - 1)

    def handle_endtag(self, tag: str) -> None:
        if tag == "br":
            self.open[-1].children.append(Node("br"))
        elif tag == "p" and not self.places["p"]:
            self.open[-1].children.append(Node("p"))
        elif tag not in ("html", "body"):
            stop = ("table",) if tag in ("td", "th", "tr", "li", "p") else ("td", "th") if tag not in ("table", "thead", "tbody", "tfoot") else ()
            at = self._nearest((tag,))
            if at > self._nearest(stop):
                self._pop_to(at)

    def handle_data(self, data: str) -> None:
        if self.open[-1].tag == "head" and not data.isspace():
            self._pop_to(len(self.open) - 1)
        self.open[-1].children.append(data)


class Lines:
    """Finished lines of one block of text, such as the page or a cell."""

    def __init__(self) -> None:
        self.lines: list[str] = []
        self.line: list[str] = []
        self.gap = False
        self.indent = 0
        self.marker = ""
        self.items = 0
        self.pre = 0

    def text(self, data: str) -> None:
        if self.pre:
            for k, part in enumerate(data.replace("\r\n", "\n").replace("\r", "\n").split("\n")):
                if k:
                    self.end_line(force=True)
                if part:
                    self.line.append(part)
            return
        data = _SPACE.sub(" ", data)
        if not self.line or self.line[-1].endswith(" "):
            data = data.lstrip(" ")
        if data:
            self.line.append(data)

    def end_line(self, force: bool = False) -> None:
        text = "".join(self.line).rstrip(" ")
        self.line = []
        if text or force:
            self.put(text)

    def begin_block(self, margin: bool) -> None:
        self.end_line()
        self.gap |= margin and not self.marker  # the first block of a list item stands beside its marker

    def put(self, text: str) -> None:
        """One finished line."""
        if self.gap and self.lines:
            self.lines.append("")
        self.gap = False
        width = min(self.indent, INDENT)
        lead = " " * width
        if self.marker:
            lead, self.marker = " " * max(0, width - len(self.marker)) + self.marker, ""
        self.lines.append((lead + text).rstrip(" "))

    def finish(self) -> list[str]:
        self.end_line()
        return self.lines


class Table:
    """Caption lines and rows of cells of one table while it is read."""

    def __init__(self, depth: int):
        self.depth = depth
        self.loose: list[str] = []
        #: Rows: (loose lines before it, cells as (column, columns, lines)).
        self.rows: list[tuple[list[str], list[tuple[int, int, list[str]]]]] = []
        self.taken: list[tuple[int, int, int]] = []  # column, end and last row of cells that reach further down
        self.column = 0

    def new_row(self) -> None:
        self.rows.append((self.loose, []))
        self.loose, self.column = [], 0
        row = len(self.rows) - 1
        self.taken = sorted(t for t in self.taken if t[2] >= row)

    def add(self, node: Node, lines: list[str]) -> None:
        for first, end, _ in self.taken:
            if first < self.column + node.across and self.column < end:
                self.column = end
        self.rows[-1][1].append((self.column, node.across, lines))
        if node.down > 1:
            self.taken.append((self.column, self.column + node.across, len(self.rows) + node.down - 2))
        self.column += node.across

    def lines(self) -> list[str]:
        """Cells of a column begin at the same place, as far as ``COLUMN`` and ``ALIGNED`` allow; all text stays."""
        out: list[str] = []
        if self.depth > TABLES:
            for loose, cells in self.rows:
                out += loose
                for _, _, lines in cells:
                    out += [x for x in lines if x]
            return out + self.loose
        widths: dict[int, int] = {}
        for _, cells in self.rows:
            for column, across, lines in cells:
                if across == 1:
                    widths[column] = max(widths.get(column, 0), min(COLUMN, max(map(len, lines), default=0)))
                else:
                    widths.setdefault(column, 0)
        start, at = {}, 0
        for column in sorted(widths):
            start[column] = at
            at += widths[column] + 2
        for loose, cells in self.rows:
            out += loose
            for k in range(max((len(c[2]) for c in cells), default=0)):
                line, used = [], 0
                for column, _, lines in cells:
                    text = lines[k] if k < len(lines) else ""
                    if not text:
                        continue
                    pad = start[column] - used if start[column] <= ALIGNED else 0
                    pad = max(pad, 2) if used else max(pad, 0)
                    line += [" " * pad, text]
                    used += pad + len(text)
                out.append("".join(line).rstrip(" "))
        out += self.loose
        return [x for k, x in enumerate(out) if x or k]


class Renderer:
    """Text of a tree; ``stack`` holds the open blocks of lines, innermost last."""

    def __init__(self) -> None:
        self.lines = Lines()
        self.outer: list[Lines] = []
        self.tables: list[Table] = []

    def page(self, root: Node) -> str:
        # A step of ``work`` is a string, a node to open, or a function, such as one that closes a node; it can give further steps.
        work: list = [root]
        while work:
            step = work.pop()
            if isinstance(step, str):
                self.lines.text(step)
            elif isinstance(step, Node):
                if not step.hidden:
                    work += reversed(self._opened(step))
            else:
                work += reversed(step() or ())
        return "\n".join(self.lines.finish())

    def _opened(self, node: Node) -> list:
        tag, lines = node.tag, self.lines
        if tag == "br":
            lines.end_line(force=True)
            return []
        if tag == "hr":
            lines.end_line()
            lines.gap = True
            lines.put("----")
            lines.gap = True
            return []
        if tag == "table":
            lines.begin_block(True)
            self.tables.append(Table(len(self.tables) + 1))
            return [*self._table_steps(node), self._close_table]
        block, margin = tag in BLOCKS, tag in MARGINS and not (lines.items and tag in LISTS)
        if block:
            lines.begin_block(margin)
        if tag in ("pre", "textarea"):
            lines.pre += 1
            return [*_without_first_newline(node.children), lambda: self._close_pre(margin)]
        children = node.children
        if tag == "details" and not node.start:
            children = [c for c in children if isinstance(c, Node) and c.tag == "summary"][:1]
        indent = lines.indent
        lines.indent += 2 if tag in ("blockquote", "dd") else 0
        steps, number = [], node.start
        for child in children:
            if isinstance(child, Node) and child.tag == "li" and not child.hidden:
                steps += self._item_steps(child, f"{number}. " if tag == "ol" else "- ")
                number += 1
            else:
                steps.append(child)
        return [*steps, lambda: self._close_block(block, margin, indent)]

    def _close_block(self, block: bool, margin: bool, indent: int) -> None:
        if block:
            self.lines.end_line()
            self.lines.gap |= margin
        self.lines.indent = indent

    def _close_pre(self, margin: bool) -> None:
        self.lines.end_line()
        self.lines.pre -= 1
        self.lines.gap |= margin

    def _item_steps(self, node: Node, marker: str) -> list:
        def begin() -> None:
            lines = self.lines
            lines.end_line(force=bool(lines.marker))
            lines.indent += len(marker)
            lines.marker = marker
            lines.items += 1

        def end() -> None:
            lines = self.lines
            lines.end_line(force=bool(lines.marker))
            lines.items -= 1
            lines.marker, lines.indent = "", lines.indent - len(marker)

        return [begin, *node.children, end]

    def _table_steps(self, node: Node) -> list:
        """What to do for the children of a table, a row group or a row."""
        steps: list = []
        for child in node.children:
            if isinstance(child, str):
                text = _SPACE.sub(" ", child).strip()
                if text:
                    steps.append(lambda text=text: self.tables[-1].loose.append(text))
            elif child.hidden:
                continue
            elif child.tag in ROWS:
                steps.append(lambda child=child: self._table_steps(child))
            elif child.tag == "tr":
                steps += [self.tables[-1].new_row, lambda child=child: self._table_steps(child)]
            elif node.tag == "tr":
                steps += [self._begin_cell, child, lambda child=child: self._end_cell(child)]
            else:
                steps += [self._begin_cell, child, self._end_loose]
        return steps

    def _begin_cell(self) -> None:
        self.outer.append(self.lines)
        self.lines = Lines()

    def _end_cell(self, node: Node) -> None:
        found = self.lines.finish()
        self.lines = self.outer.pop()
        self.tables[-1].add(node, found)

    def _end_loose(self) -> None:
        found = self.lines.finish()
        self.lines = self.outer.pop()
        self.tables[-1].loose += [x for x in found if x]

    def _close_table(self) -> None:
        found = self.tables.pop().lines()
        for line in found:
            self.lines.put(line)
        self.lines.gap = True


def _without_first_newline(children: list) -> list:
    if children and isinstance(children[0], str) and children[0].startswith("\n"):
        return [children[0][1:], *children[1:]]
    return children


def visible_text(html: str) -> str:
    """The visible text of one page. Broken markup is read leniently; an empty page gives an empty text."""
    builder = TreeBuilder()
    builder.feed(html)
    builder.close()
    return Renderer().page(builder.root)


def extract_text(pages: DataFrame, id_col: str = "page_id", html_col: str = "html") -> DataFrame:
    """(page_id, text) for every row.

    Shown are texts, alternative texts of images, fields' values, options and
    text areas; not shown are heads, scripts, what style or attribute hides,
    and all but the summary of closed details. Pages of any depth are rendered
    whole. Cells wider than ``COLUMN`` and cells that begin beyond ``ALIGNED``
    are not padded, nor are tables deeper than ``TABLES`` in tables; indents end
    at ``INDENT``; no text is lost. Null and empty pages give empty texts;
    repeated rows are all returned, null ids stay null, other columns are
    ignored. Pages are rendered one at a time.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            found = [visible_text(t.decode("utf-8", "replace")) for t in raw(batch.column(1))]
            yield pa.record_batch([batch.column(0), pa.array(found, pa.string())], ["page_id", "text"])

    picked = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(html_col).cast("string").alias("html"))
    return picked.mapInArrow(run, "page_id long, text string")
