"""HTML extraction by layout-aware rendering.

A small tree builder closes what HTML lets authors leave open (p, li, table
rows and cells, options, definition terms), void elements never nest, and a
stray end tag closes nothing it does not match. Rows and cells always reach
their table: a missing row is implied, an open column group or stray element
closed, and what may not stand in a table, a section or a row is moved before
the table, as browsers do. A head ends at the first thing that it may not hold. The renderer walks the tree
without recursion over blocks: hidden parts (script, style, template, hidden,
display:none ...) are skipped, of drawings the text elements are kept and
formulas are read as text, white space collapses as in a browser, blocks
stand on lines of their own with blank lines around paragraphs, headings and
lists, list items carry a bullet or number, preformatted text keeps its lines,
and table cells are padded to aligned columns.

Rows stay where they are: one Arrow-batched map without a shuffle. Null or
empty html gives empty text; repeated rows are rendered each.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shiftwise.llm.common import table

# Fixed values from the HTML standard.
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
HIDDEN = set("head script style template noscript title iframe object canvas audio video datalist".split())
SPACED = set("p h1 h2 h3 h4 h5 h6 ul ol dl pre blockquote table figure hr".split())
BLOCK = SPACED | set("html body div section article header footer nav main aside address form fieldset li dt dd "
                     "figcaption details summary tr caption legend option center".split())
#: A start tag on the left implies the end of an open element on the right, up to the scope elements.
IMPLIED = {
    "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "option": {"option"}, "tr": {"tr", "td", "th", "caption"},
    "td": {"td", "th"}, "th": {"td", "th"}, "thead": {"thead", "tbody", "tfoot", "tr", "td", "th", "caption"},
    "tbody": {"thead", "tbody", "tfoot", "tr", "td", "th", "caption"},
    "tfoot": {"thead", "tbody", "tfoot", "tr", "td", "th", "caption"},
    "body": {"head"},
}
#: The elements of a table, and where the stack is cleared back to when one starts.
SECTIONS = {"thead", "tbody", "tfoot"}
PLACE = {"tr": SECTIONS, "td": SECTIONS | {"tr"}, "th": SECTIONS | {"tr"},
         **dict.fromkeys(["caption", "colgroup", "col", *SECTIONS], set())}
STRUCTURE = SECTIONS | {"table", "tr"}  # they hold elements of the table only
UNMOVED = {"script", "style", "template"}
SCOPE = {"li": {"ul", "ol"}, "dt": {"dl"}, "dd": {"dl"}, "option": {"select"}}
#: What an open head may hold; any other element, or text, ends it.
HEAD = set("base basefont bgsound link meta noframes noscript script style template title".split())
#: Parts of a drawing or formula that are not shown, the elements in it that hold HTML again, and those that end it.
UNDRAWN = set("annotation annotation-xml clippath defs desc marker mask metadata pattern symbol".split())
HOLDS_HTML = set("foreignobject desc title mi mo mn ms mtext annotation-xml".split())
BREAKOUT = BLOCK - set("html section article header footer nav main aside address form fieldset figcaption details summary tr "
                       "caption legend option hr figure".split()) | set(
    "b big br code em embed hr i img meta nobr ruby s small span strong strike sub sup tt var".split())
NOT_SHOWN = re.compile(r"(?:^|;)\s*(?:display\s*:\s*none|visibility\s*:\s*hidden)", re.I)
SPACES = re.compile(r"[ \t\n\f\r]+")


class Node:
    __slots__ = ("tag", "attrs", "items")

    def __init__(self, tag: str, attrs: dict):
        self.tag, self.attrs, self.items = tag, attrs, []


class TreeBuilder(HTMLParser):
    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.root = Node("html", {})
        self.open = [self.root]

    def close_until(self, tags: set, scope: set) -> None:
        """Close open elements in ``tags`` above the nearest element in ``scope``, and what they contain."""
        for i in range(len(self.open) - 1, 0, -1):
            if self.open[i].tag in scope:
                return
            if self.open[i].tag in tags:
                del self.open[i:]

    def add(self, item) -> None:
        """Appends a text or an element; in a table, but in none of its cells, before the table."""
        if self.open[-1].tag == "colgroup":
            self.open.pop()
        if self.open[-1].tag in STRUCTURE:
            for i in range(len(self.open) - 1, 0, -1):
                if self.open[i].tag == "table":
                    self.open[i - 1].items.insert(-1, item)  # an open table is its parent's last
                    return
        self.open[-1].items.append(item)

    def table_at(self, cells: bool) -> int:
        """The nearest open table, 0 if none; with ``cells`` false none whose cell or caption is open."""
        for i in range(len(self.open) - 1, 0, -1):
            tag = self.open[i].tag
            if tag == "table":
                return i
            if tag == "template" or not cells and tag in ("td", "th", "caption"):
                return 0
        return 0

    def clear_back(self, tag: str) -> None:
        """Closes what is open in the table down to where ``tag`` may stand, and implies a cell's row."""
        table = self.table_at(True)
        if not table:
            return
        at = next((i for i in range(len(self.open) - 1, table, -1) if self.open[i].tag in PLACE[tag]), table)
        del self.open[at + 1:]
        if tag in ("td", "th") and self.open[-1].tag != "tr":
            row = Node("tr", {})
            self.open[-1].items.append(row)
            self.open.append(row)

    def handle_starttag(self, tag, attrs):
        if tag == "html" or tag == "head" and (len(self.open) > 1 or any(
                isinstance(x, Node) or x.strip() for x in self.root.items)):
            return
        if self.open[-1].tag == "head" and tag not in HEAD:
            self.open.pop()
        if tag in BREAKOUT and (at := self.drawing_at()):
            del self.open[at:]
        if tag == "table" and (at := self.table_at(False)):
            del self.open[at:]  # a table directly in a table ends it
        if tag == "form" and self.open[-1].tag in STRUCTURE | {"colgroup"}:
            return  # it holds nothing there
        if tag in BLOCK or tag == "body":
            self.close_until({"p"}, {"table", "button", "td", "th", "caption"})
        if tag in IMPLIED:
            self.close_until(IMPLIED[tag], SCOPE.get(tag, {"table"}))
        node = Node(tag, dict(attrs))
        if tag in UNDRAWN and self.drawing_at():
            node.attrs["hidden"] = ""
        if tag in PLACE and not (tag == "col" and self.open[-1].tag == "colgroup"):
            self.clear_back(tag)
        if tag in PLACE or tag in UNMOVED:
            self.open[-1].items.append(node)
        else:
            self.add(node)
        if tag not in VOID:
            self.open.append(node)

    def drawing_at(self) -> int:
        """The nearest open svg or math whose own elements are read, 0 if none."""
        for i in range(len(self.open) - 1, 0, -1):
            tag = self.open[i].tag
            if tag in ("svg", "math"):
                return i
            if tag in BREAKOUT or tag in HOLDS_HTML:
                return 0
        return 0

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if self.open[-1].tag == tag and tag not in VOID and (tag in ("svg", "math") or self.drawing_at() or (
                tag in HOLDS_HTML and any(x.tag in ("svg", "math") for x in self.open))):
            self.open.pop()  # only there a slash ends an element

    def handle_endtag(self, tag):
        if tag == "br":
            self.add(Node("br", {}))
        for i in range(len(self.open) - 1, 0, -1):
            if self.open[i].tag == tag:
                del self.open[i:]
                return
            if tag != "template" and (self.open[i].tag in ("table", "template")
                                      or self.open[i].tag in ("td", "th") and tag not in STRUCTURE):
                return  # an end tag does not reach out of its cell, its table or its template

    def handle_data(self, data):
        if data.strip(" \t\n\f\r"):
            if self.open[-1].tag == "head":
                self.open.pop()
            self.add(data)
        else:
            self.open[-1].items.append(data)


def shown(node: Node) -> bool:
    a = node.attrs
    return not (node.tag in HIDDEN or "hidden" in a or (node.tag == "input" and a.get("type") == "hidden")
                or NOT_SHOWN.search(a.get("style") or ""))


def drawn(svg: Node) -> list:
    """What a drawing shows as text: its text elements, and foreign objects as blocks."""
    out, todo = [], [svg]
    while todo:
        x = todo.pop()
        if x.tag == "text":
            out += [" ", x, " "]
        elif x.tag == "foreignobject":
            block = Node("div", {})
            block.items = x.items
            out.append(block)
        else:
            todo += [c for c in reversed(x.items) if isinstance(c, Node) and shown(c)]
    return out


class Lines:
    """Collects rendered text: collapses spaces, and keeps at most one blank line between blocks."""

    def __init__(self):
        self.lines, self.now, self.gap, self.indent, self.mark = [], "", False, [], ""

    def text(self, data: str) -> None:
        data = SPACES.sub(" ", data)
        if not self.now or self.now.endswith(" "):
            data = data.lstrip(" ")
        self.now += data

    def flush(self, gap: bool = False) -> None:
        line = self.now.rstrip(" ")
        if line or self.mark:
            self.put(line)
        self.now = ""
        self.gap = self.gap or gap

    def put(self, line: str) -> None:
        if self.gap and self.lines:
            self.lines.append("")
        head = "".join(self.indent)
        if self.mark:
            head, self.mark = head[: len(head) - len(self.mark)] + self.mark, ""
        self.lines.append((head + line).rstrip())
        self.gap = False


def rows_of(node: Node) -> Iterator[Node]:
    """Rows of a table, its sections included, nested tables not."""
    for x in node.items:
        if isinstance(x, Node) and shown(x):
            if x.tag == "tr":
                yield x
            elif x.tag in ("thead", "tbody", "tfoot"):
                yield from rows_of(x)


def table_lines(node: Node, depth: int) -> list[str]:
    grid = []
    for tr in rows_of(node):
        row = []
        for cell in tr.items:
            if isinstance(cell, Node) and cell.tag in ("td", "th") and shown(cell):
                row.append(" ".join(x.strip() for x in render(cell, depth + 1) if x.strip()))
                span = cell.attrs.get("colspan") or "1"
                row += [""] * (min(int(span), 1000) - 1 if span.isdigit() else 0)
        if any(row):
            grid.append(row)
    width = [max((len(r[i]) for r in grid if i < len(r)), default=0) for i in range(max(map(len, grid), default=0))]
    return ["  ".join(x.ljust(w) for x, w in zip(r, width)).rstrip() for r in grid]


def render(root: Node, depth: int = 0) -> list[str]:
    """The lines of a node's visible text; an explicit stack, so nesting is not limited."""
    out, todo = Lines(), [("in", x) for x in reversed(root.items)]
    pre, lists = 0, []
    while todo:
        step, x = todo.pop()
        if isinstance(x, str):
            if pre:
                *full, last = x.split("\n")
                for line in full:
                    out.put(out.now + line)
                    out.now = ""
                out.now += last
            else:
                out.text(x)
        elif step == "out":
            if x.tag in ("ul", "ol"):
                lists.pop()
            elif x.tag in ("li", "dd", "blockquote"):
                out.flush()
                out.mark = ""
                out.indent.pop()
            pre -= x.tag == "pre"
            out.flush(x.tag in SPACED and not (x.tag in ("ul", "ol") and lists))
        elif shown(x):
            if x.tag == "br":
                out.put(out.now.rstrip(" "))
                out.now = ""
                continue
            if x.tag in BLOCK:
                out.flush(x.tag in SPACED and not (x.tag in ("ul", "ol") and lists))
            if x.tag == "table" and depth < 20:
                for part in (c for c in x.items if isinstance(c, Node) and c.tag == "caption" and shown(c)):
                    for line in render(part, depth + 1):
                        out.put(line)
                for line in table_lines(x, depth):
                    out.put(line)
                out.gap = True
                continue
            if x.tag == "svg":
                todo += [("in", c) for c in reversed(drawn(x))]
                continue
            if x.tag in ("td", "th", "mtd"):  # a cell outside of a table
                out.text(" ")
                todo.append(("in", " "))
            if x.tag in ("ul", "ol"):
                lists.append([x.tag, 0])
            elif x.tag == "li":
                if lists:
                    lists[-1][1] += 1
                out.mark = f"{lists[-1][1]}. " if lists and lists[-1][0] == "ol" else "- "
                out.indent.append(" " * len(out.mark))
            elif x.tag in ("dd", "blockquote"):
                out.indent.append("  ")
            pre += x.tag == "pre"
            if x.tag in BLOCK:
                todo.append(("out", x))
            todo += [("in", c) for c in reversed(x.items)]
    out.flush()
    return out.lines


def find(root: Node, tag: str) -> str:
    """Text of the first element of that name."""
    todo = [root]
    while todo:
        x = todo.pop()
        if x.tag == tag:
            return SPACES.sub(" ", "".join(c for c in x.items if isinstance(c, str))).strip()
        todo += [c for c in reversed(x.items) if isinstance(c, Node)]
    return ""


def html_text(html: str | None) -> tuple[str, str]:
    """(title, visible text) of a page."""
    builder = TreeBuilder()
    builder.feed(html or "")
    builder.close()
    return find(builder.root, "title"), "\n".join(render(builder.root)).strip("\n")


def extract(pages: DataFrame, id_col: str = "page_id", html_col: str = "html") -> DataFrame:
    """One row per page: page_id, title, text, n_lines, n_chars."""
    def batches(it: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in it:
            found = [html_text(h) for h in b["html"]]
            yield pd.DataFrame({
                "page_id": b["page_id"], "title": [t for t, _ in found], "text": [x for _, x in found],
                "n_lines": [len(x.split("\n")) if x else 0 for _, x in found], "n_chars": [len(x) for _, x in found]})

    rows = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(html_col).alias("html"))
    return rows.mapInPandas(batches, "page_id long, title string, text string, n_lines long, n_chars long")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract(table(spark, sf_dir, "pages"))
