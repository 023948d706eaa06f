"""Layout-aware text of HTML pages.

A tree is built first: end tags that pages leave out are implied, stray ones ignored. Rendering
walks the tree and writes all text a reader would see: blocks on lines of their own, paragraphs
and headings apart by a blank line, list items marked and indented, table cells in aligned
columns. What is not displayed is left out (scripts, styles, ``hidden``, ``display:none``, closed
dialogs, and what stands in for media: ``object``, ``audio``, ``video``, ``canvas``, ``iframe``).
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from html import unescape
from itertools import zip_longest

import pyarrow as pa
from pyspark.sql import DataFrame

from broadsheet.llm.common import text_of

# Names of elements by how they behave.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style xmp iframe noembed noframes".split())
RAW_WITH_ENTITIES = frozenset("title textarea".split())
UNSEEN = frozenset(
    "head title script style template noscript iframe noembed noframes object audio video canvas "
    "datalist meta link base param source track rp annotation annotation-xml".split()
)
# Not displayed within a drawing; other elements by these names are.
UNSEEN_IN_SVG = frozenset("desc defs metadata symbol".split())
FOREIGN = frozenset(("svg", "math"))
# On lines of their own, though they do not end a paragraph.
OWN_LINE = frozenset("select option optgroup textarea text".split())
SPACED = frozenset("p h1 h2 h3 h4 h5 h6 ul ol dl blockquote pre figure table fieldset".split())
BLOCKS = SPACED | frozenset(
    "address article aside body center dd details dir div dt fieldset figcaption footer form header hgroup html legend "
    "li main menu nav search section summary tr caption thead tbody tfoot".split()
)
CELLS = frozenset(("td", "th"))
# A start tag ends the open elements named, up to the nearest of the limits.
IMPLIED_ENDS = {
    "li": (frozenset(("li",)), frozenset(("ul", "ol", "menu", "dir"))),
    "dt": (frozenset(("dt", "dd")), frozenset(("dl",))),
    "dd": (frozenset(("dt", "dd")), frozenset(("dl",))),
    "option": (frozenset(("option",)), frozenset(("select", "datalist"))),
    "optgroup": (frozenset(("option", "optgroup")), frozenset(("select",))),
    "td": (CELLS, frozenset(("tr", "table"))),
    "th": (CELLS, frozenset(("tr", "table"))),
    "tr": (CELLS | {"tr"}, frozenset(("table",))),
    "thead": (CELLS | {"tr", "thead", "tbody", "tfoot", "caption"}, frozenset(("table",))),
    "tbody": (CELLS | {"tr", "thead", "tbody", "tfoot", "caption"}, frozenset(("table",))),
    "tfoot": (CELLS | {"tr", "thead", "tbody", "tfoot", "caption"}, frozenset(("table",))),
    "body": (frozenset(("head",)), frozenset(("html",))),
}
CLOSES_P = (BLOCKS | {"hr"}) - {"html", "body", "caption", "tr", "thead", "tbody", "tfoot"}
P_LIMITS = frozenset("table td th caption button body html".split())
# An end tag does not reach out of these.
SCOPES = frozenset("table td th caption html".split())
HEAD_CONTENT = frozenset("base link meta title style script noscript template".split())

# A quote opens a value straight after "=" only; elsewhere it is a character like others.
_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*>"
    r"|</([a-zA-Z][^\s/>]*)[^>]*>"
    r"|<([a-zA-Z][^\s/>]*)((?:[^>=]++|=\s*+(?:\"[^\"]*\"|'[^']*'|[^\s\"'>][^\s>]*+|))*+)>"
    r"|[^<]+|<",
    re.S,
)
_ATTRIBUTE = re.compile(r"""([^\s>/=]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>][^\s>]*)))?""")
_HIDING = re.compile(r"(?:^|;)\s*(?:display\s*:\s*none|visibility\s*:\s*(?:hidden|collapse))", re.I)
_SPACE = re.compile(r"[ \t\n\r\f]+")


class Node:
    __slots__ = ("tag", "attributes", "children")

    def __init__(self, tag: str, attributes: str = ""):
        self.tag, self.attributes, self.children = tag, attributes, []

    def attribute(self, name: str) -> str | None:
        if name not in self.attributes.lower():
            return None
        for key, *values in _ATTRIBUTE.findall(self.attributes):
            if key.lower() == name:
                return unescape(values[0] or values[1] or values[2])
        return None

    def shown(self) -> bool:
        if self.tag in UNSEEN or self.tag == "dialog" and self.attribute("open") is None:
            return False
        if not self.attributes:
            return True
        return self.attribute("hidden") is None and not _HIDING.search(self.attribute("style") or "")


def parse(html: str) -> Node:
    """The page as a tree of nodes and texts."""
    root = Node("#page")
    stack = [root]
    foreign = 0  # drawings and formulas that are open
    open_ = Counter()  # elements on the stack by tag: a tag that is not open is not looked for

    def close(index: int) -> None:
        nonlocal foreign
        foreign -= sum(n.tag in FOREIGN for n in stack[index:])
        open_.subtract(n.tag for n in stack[index:])
        del stack[index:]

    at, end = 0, len(html)
    while at < end:
        match = _TOKEN.match(html, at)
        at = match.end()
        closing, opening, attributes = match.groups()
        if closing:
            tag = closing.lower()
            if tag == "br":
                stack[-1].children.append(Node("br"))
            for i in range(len(stack) - 1, 0, -1) if open_[tag] else ():
                if stack[i].tag == tag:
                    close(i)
                    break
                if stack[i].tag in SCOPES and tag not in ("table", "body", "html") and not (
                    tag in ("tr", "thead", "tbody", "tfoot") and stack[i].tag != "table"
                ):
                    break
        elif opening:
            tag = opening.lower()
            if stack[-1].tag == "head" and tag not in HEAD_CONTENT:
                close(len(stack) - 1)
            if tag in IMPLIED_ENDS:
                ended, limits = IMPLIED_ENDS[tag]
                lowest = None
                for i in range(len(stack) - 1, 0, -1) if any(open_[t] for t in ended) else ():
                    if stack[i].tag in limits:
                        break
                    if stack[i].tag in ended:
                        lowest = i
                if lowest is not None:
                    close(lowest)
            if tag in CLOSES_P:
                for i in range(len(stack) - 1, 0, -1) if open_["p"] else ():
                    if stack[i].tag == "p":
                        close(i)
                        break
                    if stack[i].tag in P_LIMITS:
                        break
            if tag in CELLS and stack[-1].tag in ("table", "thead", "tbody", "tfoot"):
                stack[-1].children.append(row := Node("tr"))
                stack.append(row)
                open_["tr"] += 1
            node = Node(tag, attributes)
            stack[-1].children.append(node)
            if tag in VOID or foreign and attributes.endswith("/"):
                continue
            if tag in RAW or tag in RAW_WITH_ENTITIES:
                stop = re.compile(rf"</{tag}\b[^>]*>", re.I).search(html, at)
                if tag in RAW_WITH_ENTITIES:
                    node.children.append(unescape(html[at : stop.start() if stop else end]))
                at = stop.end() if stop else end
            elif not (tag in FOREIGN and attributes.endswith("/")):  # a slash does not close an HTML element
                foreign += tag in FOREIGN
                stack.append(node)
                open_[tag] += 1
        elif not match[0].startswith(("<!", "<?")):
            if stack[-1].tag == "head" and not match[0].isspace():
                close(len(stack) - 1)
            stack[-1].children.append(unescape(match[0]) if "&" in match[0] else match[0])
    return root


class _Writer:
    """Lines of text; white space collapses, breaks between blocks do not add up."""

    def __init__(self):
        self.lines: list[str] = []
        self.line: list[str] = []
        self.gap = False  # white space since the last text of the line
        self.blank = 0  # blank lines due before the next line
        self.indent: list[str] = []
        self.marker: str | None = None

    def end_line(self, blank: int = 0, force: bool = False) -> None:
        if self.line or force:
            self.put("".join(self.line))
        self.line, self.gap = [], False
        self.blank = max(self.blank, blank)

    def put(self, text: str) -> None:
        if self.lines and self.blank:
            self.lines.append("")
        self.blank = 0
        lead = "".join(self.indent)
        if self.marker is not None:
            lead = "".join(self.indent[:-1]) + self.marker
            self.marker = None
        self.lines.append((lead + text).rstrip())

    def text(self, text: str) -> None:
        words = _SPACE.sub(" ", text)
        if words == " " or not words:
            self.gap = self.gap or bool(words)
            return
        if (self.gap or words[0] == " ") and self.line:
            self.line.append(" ")
        self.line.append(words.strip(" "))
        self.gap = words[-1] == " "

    def kept(self, text: str) -> None:
        first, *rest = text.replace("\r\n", "\n").split("\n")
        self.line.append(first)
        for line in rest:
            self.end_line(force=True)
            self.line.append(line)


# A cell that is longer runs over its column instead of widening it: padding stays in proportion.
WIDEST = 200
# The most columns and rows that HTML lets a cell span.
MOST_COLUMNS, MOST_ROWS = 1000, 65534


def _span(node: Node, name: str, most: int) -> int:
    """Columns or rows of a cell; nought rows are all that are left."""
    value = (node.attribute(name) or "1").strip()
    number = int(value[:9]) if value.isascii() and value.isdigit() else 1
    return min(number or (most if name == "rowspan" else 1), most)


def _placed(rows: list[list[tuple[str, int, int]]]) -> Iterator[list[tuple[int, str, int]]]:
    """``(column, text, columns)`` of each row's cells, beside the cells that reach down into it."""
    busy: dict[int, int] = {}
    for row in rows:
        placed, column, deeper = [], 0, {}
        for text, span, deep in row:
            while column in busy:
                column += 1
            placed.append((column, text, span))
            if deep > 1:
                deeper |= dict.fromkeys(range(column, column + span), deep - 1)
            column += span
        busy = {c: n - 1 for c, n in busy.items() if n > 1} | deeper
        if placed:
            yield placed


def _aligned(rows: list[list[tuple[str, int, int]]]) -> list[str]:
    """Rows of ``(text, columns, rows)`` as lines; a column is as wide as its widest cell of up
    to ``WIDEST`` characters."""
    grid = list(_placed(rows))
    width: dict[int, int] = {}
    for row in grid:
        for column, text, span in row:
            if span == 1:
                longest = max(map(len, text.split("\n")))
                width[column] = max(width.get(column, 0), longest if longest <= WIDEST else 0)
    lines = []
    for row in grid:
        cells, at = [], 0
        for column, text, span in row:
            cells += [([""], width.get(c, 0)) for c in range(at, column)]
            room = sum(width.get(column + k, 0) for k in range(span)) + 3 * (span - 1)
            cells.append((text.split("\n"), min(room, WIDEST)))
            at = column + span
        for parts in zip_longest(*(c[0] for c in cells), fillvalue=""):
            lines.append(" | ".join(p.ljust(c[1]) for p, c in zip(parts, cells, strict=True)).rstrip())
    return lines


def render(html: str) -> str:
    """All visible text of a page, laid out."""
    writers = [_Writer()]
    tables: list[list] = []  # rows of the tables being written
    lists: list[list] = []  # [ordered, number]
    keep = drawings = 0
    stack: list[tuple] = [("open", parse(html))]
    while stack:
        step, node = stack.pop()
        out = writers[-1]
        if step == "open":
            if isinstance(node, str):
                out.kept(node) if keep else out.text(node)
                continue
            tag = node.tag
            if not node.shown() or drawings and tag in UNSEEN_IN_SVG:
                continue
            if tag == "br":
                out.end_line(force=True)
                continue
            if tag == "hr":
                out.end_line()
                out.put("---")
                continue
            stack.append(("close", node))
            if tag in CELLS and tables:
                writers.append(_Writer())
            elif tag in BLOCKS:
                out.end_line(1 if tag in SPACED and not (lists and tag in ("ul", "ol")) else 0)
            elif tag in OWN_LINE:
                out.end_line()
            if tag == "table":
                tables.append([])
            elif tag == "tr" and tables:
                tables[-1].append([])
            elif tag in ("ul", "ol", "menu", "dir"):
                start = node.attribute("start") or "1"
                lists.append([tag == "ol", int(start) if start.lstrip("-").isdigit() and len(start) < 10 else 1])
            elif tag == "li":
                ordered, number = lists[-1] if lists else (False, 1)
                out.marker = f"{number}. " if ordered else "- "
                if lists:
                    lists[-1][1] += 1
                out.indent.append(" " * len(out.marker))
            elif tag in ("dd", "blockquote"):
                out.indent.append("    " if tag == "dd" else "> ")
            elif tag in ("pre", "textarea"):
                keep += 1
            elif tag == "svg":
                drawings += 1
            elif tag == "optgroup":
                out.text(node.attribute("label") or "")
                out.end_line()
            elif tag == "q":
                out.text('"')
            stack += [("open", c) for c in reversed(node.children)]
            continue
        tag = node.tag
        if tag in CELLS and tables:
            out.end_line()
            writers.pop()
            cell = ("\n".join(out.lines), _span(node, "colspan", MOST_COLUMNS), _span(node, "rowspan", MOST_ROWS))
            if not tables[-1]:
                tables[-1].append([])
            tables[-1][-1].append(cell)
            continue
        if tag == "q":
            out.line.append('"')
        if tag in BLOCKS:
            out.end_line(1 if tag in SPACED and not (len(lists) > 1 and tag in ("ul", "ol")) else 0)
        elif tag in OWN_LINE:
            out.end_line()
        if tag == "table":
            for line in _aligned(tables.pop()):
                out.put(line)
            out.blank = 1
        elif tag in ("ul", "ol", "menu", "dir"):
            lists.pop()
        elif tag == "li":
            if out.marker is not None:
                out.put("")
            out.indent.pop()
        elif tag in ("dd", "blockquote"):
            out.indent.pop()
        elif tag in ("pre", "textarea"):
            keep -= 1
        elif tag == "svg":
            drawings -= 1
    writers[0].end_line()
    return "\n".join(writers[0].lines)


def rendered_pages(pages: DataFrame, html: str = "html", keep: tuple[str, ...] = ("page_id",)) -> DataFrame:
    """The columns ``keep`` with ``text``. A null page gives an empty text; nothing else is
    dropped. An empty table gives an empty table."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 200):
                part = batch.slice(at, 200)
                texts = [render(h.as_py()) for h in part.column("html_")]
                yield pa.RecordBatch.from_arrays(
                    [*(part.column(c) for c in keep), pa.array(texts, pa.string())], names=[*keep, "text"]
                )

    work = pages.select(*keep, text_of(html).alias("html_"))
    return work.mapInArrow(run, pages.select(*keep).schema.add("text", "string"))
