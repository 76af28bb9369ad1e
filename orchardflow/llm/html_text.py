"""Layout-aware rendering of web pages to text.

A tree builder supplies the tags that HTML lets authors leave out, and a renderer walks the tree: what is invisible gives nothing, blocks
start lines, paragraphs and the like stand between empty lines, lists have markers and indents, and tables have aligned columns.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterator
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orchardflow.llm._common import map_batches, slices

# Fixed values of the HTML standard: element names by their role.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style xmp iframe noembed noframes noscript".split())
RCDATA = frozenset("title textarea".split())
HIDDEN = frozenset("head script style template noscript iframe noembed noframes title datalist object audio video canvas desc metadata defs annotation annotation-xml".split())
BLOCKS = frozenset("address article aside blockquote body center details dialog dd div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol p pre search section summary table ul tr caption".split())
SPACED = frozenset("p h1 h2 h3 h4 h5 h6 ul ol dl table blockquote pre hr figure menu".split())
CLOSES_P = BLOCKS - frozenset("body html tr caption legend".split())
HEAD_ONLY = frozenset("base link meta title style script template noscript".split())
#: start tag: the open elements that it ends, and the elements beyond which it looks no further
ENDS = {
    "li": ({"li"}, {"ul", "ol", "menu"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "option": ({"option"}, {"select", "datalist"}),
    "optgroup": ({"option", "optgroup"}, {"select"}),
    "tr": ({"tr", "td", "th", "caption", "colgroup"}, {"table", "tbody", "thead", "tfoot"}),
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
    **dict.fromkeys(("tbody", "thead", "tfoot"), ({"tbody", "thead", "tfoot", "tr", "td", "th", "caption", "colgroup"}, {"table"})),
    "a": ({"a"}, {"td", "th", "table", "div", "p", "li", "body"}),
    **dict.fromkeys(("h1", "h2", "h3", "h4", "h5", "h6"), ({"h1", "h2", "h3", "h4", "h5", "h6"}, {"div", "section", "article", "td", "th", "li", "body", "table"})),
}
#: end tags do not reach past these
BARRIERS = frozenset("table td th caption template html".split())

# As the HTML tokenizer's attribute states read a tag: a quote opens a string only directly after "="; elsewhere it is part of a name or value.
TAG = re.compile(
    r"""</?([a-zA-Z][^ \t\n\f\r/>]*+)((?>[ \t\n\f\r/]+|[^ \t\n\f\r/>][^ \t\n\f\r/>=]*+(?:[ \t\n\f\r]*+=[ \t\n\f\r]*+(?:"[^"]*"|'[^']*'|(?!["'])[^ \t\n\f\r>]*+)|(?![ \t\n\f\r]*+=)))*+)>"""
)
ATTRIBUTE = re.compile(r"""([^ \t\n\f\r/>][^ \t\n\f\r/>=]*+)(?:[ \t\n\f\r]*+=[ \t\n\f\r]*+(?:"([^"]*)"|'([^']*)'|([^ \t\n\f\r>]*+)))?""")
INVISIBLE = re.compile(r"display\s*:\s*none", re.I)
VISIBILITY = re.compile(r"(?:^|;)\s*visibility\s*:\s*(hidden|collapse|visible)", re.I)
STATED = re.compile("visibility", re.I)
SPACE = re.compile(r"[ \t\n\f\r]+")
#: Tables nested deeper than this are rendered as blocks.
DEEPEST = 12


class Node:
    __slots__ = ("children", "name", "attributes")

    def __init__(self, name: str, attributes: dict[str, str]) -> None:
        self.name, self.attributes = name, attributes
        self.children: list[Node | str] = []


def _attributes(text: str) -> dict[str, str]:
    found: dict[str, str] = {}
    for m in ATTRIBUTE.finditer(text) if text.strip(" /\n\t") else ():
        found.setdefault(m[1].lower(), unescape(m[2] or m[3] or m[4] or ""))
    return found


class Builder:
    """Builds the tree of a page."""

    def __init__(self) -> None:
        self.root = Node("html", {})
        self.open = [self.root]
        self.count: dict[str, int] = {}

    def build(self, page: str) -> Node:
        at, n = 0, len(page)
        while at < n:
            start = page.find("<", at)
            if start < 0:
                self.text(page[at:])
                break
            if start > at:
                self.text(page[at:start])
            if page.startswith("<!--", start):
                end = page.find("-->", start + 2)
                at = n if end < 0 else end + 3
            elif page.startswith(("<!", "<?"), start):
                end = page.find(">", start)
                at = n if end < 0 else end + 1
            elif m := TAG.match(page, start):
                at = m.end()
                name = m[1].lower()
                if page[start + 1] == "/":
                    self.end(name)
                else:
                    self.start(name, m[2])
                    if name in RAW or name in RCDATA:
                        end = re.compile(rf"</{re.escape(name)}(?=[\s/>])", re.I).search(page, at)
                        stop = end.start() if end else n
                        if name in RCDATA:
                            self.text(page[at:stop])
                        at = stop
            elif start + 1 < n and (page[start + 1].isalpha() or page[start + 1] == "/"):
                if page[start + 1] == "/" and not page[start + 2 : start + 3].isalpha():
                    end = page.find(">", start)
                    at = n if end < 0 else end + 1
                else:
                    break  # the page ends inside a tag
            else:
                self.text("<")
                at = start + 1
        return self.root

    def text(self, data: str) -> None:
        top = self.open[-1]
        data = unescape(data) if "&" in data else data
        if top.name == "head" and data.strip(" \t\n\f\r"):
            self.pop_to("head")
            top = self.open[-1]
        top.children.append(data)

    def pop_to(self, name: str) -> None:
        while self.open[-1].name != name and len(self.open) > 1:
            self._pop()
        if len(self.open) > 1:
            self._pop()

    def _pop(self) -> None:
        gone = self.open.pop()
        self.count[gone.name] -= 1

    def start(self, name: str, attributes: str) -> None:
        if name in ("html", "body") and (name == "html" or self.count.get("body")):
            return
        if self.count.get("head") and name not in HEAD_ONLY and self.open[-1].name == "head":
            self.pop_to("head")
        if name in CLOSES_P and self.count.get("p"):
            for node in reversed(self.open):
                if node.name == "p":
                    self.pop_to("p")
                    break
                if node.name in BARRIERS or node.name == "button":
                    break
        if name in ENDS:
            ends, limits = ENDS[name]
            if any(self.count.get(x) for x in ends):
                last = None
                for depth in range(len(self.open) - 1, 0, -1):
                    if self.open[depth].name in ends:
                        last = depth
                    elif self.open[depth].name in limits or self.open[depth].name in BARRIERS:
                        break
                    elif name in ("li", "dt", "dd") and self.open[depth].name in BLOCKS - {"div", "p", "address"}:
                        break
                while last is not None and len(self.open) > last:
                    self._pop()
        if name in ("td", "th") and self.open[-1].name in ("table", "tbody", "thead", "tfoot"):
            self._push(Node("tr", {}))
        node = Node(name, _attributes(attributes))
        self.open[-1].children.append(node)
        if name not in VOID:
            self.open.append(node)
            self.count[name] = self.count.get(name, 0) + 1

    def _push(self, node: Node) -> None:
        self.open[-1].children.append(node)
        self.open.append(node)
        self.count[node.name] = self.count.get(node.name, 0) + 1

    def end(self, name: str) -> None:
        if name == "br":
            self.start("br", "")
        if not self.count.get(name) or name in ("body", "html"):
            return
        stops = BARRIERS - {name} if name not in ("table", "tr", "tbody", "thead", "tfoot") else frozenset({"template"})
        for node in reversed(self.open[1:]):
            if node.name == name:
                self.pop_to(name)
                return
            if node.name in stops:
                return


def veil(root: Node) -> None:
    """Take the text out of what its own style or that of an element around it makes invisible, and hide elements that have nothing else; inner ones may be visible again."""
    order, todo = [], [(root, False, None)]
    while todo:
        node, hidden, parent = todo.pop()
        own = VISIBILITY.findall(node.attributes.get("style", "")) if node.attributes else None
        hidden = own[-1].lower() != "visible" if own else hidden
        order.append((node, hidden, parent))
        todo += [(x, hidden, node) for x in node.children if isinstance(x, Node)]
    shown = set()
    for node, hidden, parent in reversed(order):
        if not hidden or id(node) in shown:
            shown.add(id(parent))
        if hidden:
            node.children = [x for x in node.children if isinstance(x, Node)]
            if id(node) not in shown:
                node.attributes = node.attributes | {"hidden": ""}


def invisible(node: Node) -> bool:
    """Elements never shown (of drawings and formulas only what describes them), and those that say so: ``hidden``, hidden inputs, and styles without display."""
    a = node.attributes
    return node.name in HIDDEN or (bool(a) and ("hidden" in a or bool(INVISIBLE.search(a.get("style", ""))) or (node.name == "dialog" and "open" not in a)))


def shown_options(select: Node) -> list[Node]:
    """The options that a select shows: all of a list, else the last one selected, else the first."""
    options, todo = [], [select]
    while todo:
        node = todo.pop()
        if node.name == "option":
            options.append(node)
        elif node is select or not invisible(node):
            todo.extend(x for x in reversed(node.children) if isinstance(x, Node))
    options = [x for x in options if not invisible(x)]
    a = select.attributes
    if "multiple" in a or re.fullmatch(r"0*([2-9]|[1-9][0-9]+)", a.get("size", "")):
        return options
    return [x for x in options if "selected" in x.attributes][-1:] or options[:1]


def _width(text: str) -> int:
    return len(text) if text.isascii() else sum(0 if unicodedata.combining(c) else 2 if unicodedata.east_asian_width(c) in "WF" else 1 for c in text)


class Renderer:
    """Collects the lines of a page."""

    def __init__(self, depth: int = 0) -> None:
        self.lines: list[str] = []
        self.parts: list[str] = []
        self.space = False
        self.gap = 0
        self.indents: list[str] = []
        self.marker = ""
        self.depth = depth

    def add(self, text: str) -> None:
        if not text:
            return
        words = SPACE.sub(" ", text)
        if words == " ":
            self.space = True
            return
        if (self.space or words[0] == " ") and self.parts:
            self.parts.append(" ")
        self.parts.append(words.strip(" "))
        self.space = words[-1] == " "

    def preformatted(self, text: str) -> None:
        for i, line in enumerate(text.replace("\r\n", "\n").replace("\r", "\n").split("\n")):
            if i:
                self.flush(always=True)
            if line:
                self.parts.append(line)

    def flush(self, always: bool = False) -> None:
        """End the line, if there is one."""
        self.space = False
        if not self.parts and not always:
            return
        if self.lines:
            self.lines.extend([""] * self.gap)
        self.gap = 0
        lead = "".join(self.indents)
        if self.marker:
            lead = lead[: len(lead) - len(self.marker)] + self.marker
            self.marker = ""
        self.lines.append((lead + "".join(self.parts)).rstrip())
        self.parts = []

    def block(self, spaced: bool) -> None:
        self.flush()
        if spaced and not self.marker:
            self.gap = 1

    def text(self) -> str:
        self.flush()
        return "\n".join(self.lines)

    def render(self, root: Node) -> Renderer:
        stack: list[tuple] = [("node", root, False)]
        lists: list[list[int | None]] = []
        while stack:
            kind, item, pre = stack.pop()
            if kind == "leave":
                name = item.name
                if name in ("ul", "ol", "menu"):
                    lists.pop()
                    self.flush()
                    if lists:
                        continue
                if name in ("li", "dd", "blockquote"):
                    self.flush(always=bool(self.marker))
                    self.indents.pop()
                if name in BLOCKS:
                    self.block(name in SPACED)
                continue
            if isinstance(item, str):
                (self.preformatted if pre else self.add)(item)
                continue
            name = item.name
            if invisible(item):
                continue
            if name == "br":
                self.flush(always=True)
                continue
            if name == "table" and self.depth < DEEPEST:
                self.block(True)
                for line in table(item, self.depth + 1):
                    self.parts = [line] if line else []
                    self.flush(always=True)
                self.block(True)
                continue
            if name in ("td", "th", "text", "option"):
                self.space = True
            if name == "select":
                self.space = True
                stack.append(("node", " ", False))
                stack.extend(("node", x, False) for x in reversed(shown_options(item)))
                continue
            if name == "input" or name in VOID:
                if name == "hr":
                    self.block(True)
                elif name == "input" and item.attributes.get("type", "text").lower() in ("text", "submit", "button", "reset", "search", "email", "url", "tel", "number"):
                    self.add(" " + item.attributes.get("value", "") + " ")
                continue
            if name in BLOCKS:
                self.block(name in SPACED and not (name in ("ul", "ol", "menu") and lists))
            if name in ("ul", "ol", "menu"):
                start = item.attributes.get("start", "1")
                lists.append([int(start) if re.fullmatch(r"-?[0-9]{1,9}", start) else 1] if name == "ol" else [None])
            elif name == "li":
                number = lists[-1][0] if lists else None
                self.marker = "- " if number is None else f"{number}. "
                if number is not None:
                    lists[-1][0] = number + 1
                self.indents.append(" " * len(self.marker))
            elif name == "dd":
                self.indents.append("    ")
            elif name == "blockquote":
                self.indents.append("> ")
            children = item.children
            if name == "details" and "open" not in item.attributes:
                children = [x for x in children if isinstance(x, Node) and x.name == "summary"][:1]
            stack.append(("leave", item, pre))
            inner = pre or name in ("pre", "textarea", "listing")
            if name in ("pre", "listing") and children and isinstance(children[0], str) and children[0].startswith("\n"):
                children = [children[0][1:], *children[1:]]
            stack.extend(("node", x, inner) for x in reversed(children))
        return self


def _span(cell: Node, name: str, most: int) -> int:
    stated = cell.attributes.get(name, "1")
    return min(most, int(stated)) if re.fullmatch(r"[1-9][0-9]{0,3}", stated) else 1


def table(node: Node, depth: int) -> list[str]:
    """A table's caption and rows, its cells padded to the width of their columns and two spaces apart; a cell of several rows stands in the first."""
    above: list[str] = []
    rows: list[list[tuple[int, int, list[str]]]] = []  # of each cell the first column, how many, and its lines
    taken: dict[int, int] = {}  # columns that cells of earlier rows still cover, and for how many rows
    todo = list(reversed(node.children))
    while todo:
        item = todo.pop()
        if isinstance(item, str):
            if item.strip(" \t\n\f\r"):
                above.append(SPACE.sub(" ", item).strip())
            continue
        if invisible(item):
            continue
        if item.name in ("tbody", "thead", "tfoot"):
            todo.extend(reversed(item.children))
        elif item.name == "tr":
            cells, at, covered = [], 0, {}
            for cell in item.children:
                if isinstance(cell, str):
                    if cell.strip(" \t\n\f\r"):
                        above.append(SPACE.sub(" ", cell).strip())
                elif not invisible(cell):
                    inside = Node("div", {})
                    inside.children = cell.children if cell.name in ("td", "th") else [cell]
                    while taken.get(at):
                        at += 1
                    wide, high = _span(cell, "colspan", 50), _span(cell, "rowspan", 1000)
                    cells.append((at, wide, [x for x in Renderer(depth).render(inside).text().split("\n") if x] or [""]))
                    covered.update(dict.fromkeys(range(at, at + wide), high))
                    at += wide
            rows.append(cells)
            taken = {k: n - 1 for k, n in (taken | covered).items() if n > 1}
        elif item.name not in ("col", "colgroup"):
            inside = Node("div", {})
            inside.children = item.children if item.name == "caption" else [item]
            above += Renderer(depth).render(inside).text().split("\n")
    widths: dict[int, int] = {}
    for cells in rows:
        for at, wide, lines in cells:
            if wide == 1:
                widths[at] = max(widths.get(at, 0), *map(_width, lines))
    starts, x = {}, 0
    for at in range(max((at + wide for cells in rows for at, wide, _ in cells), default=0)):
        starts[at] = x
        x += widths.get(at, 0) + 2
    out = above
    for cells in rows:
        for i in range(max((len(lines) for _, _, lines in cells), default=0)):
            made, end = "", 0
            for at, _, lines in cells:
                if at:
                    gap = max(starts[at], end + 2) - end
                    made, end = made + " " * gap, end + gap
                line = lines[i] if i < len(lines) else ""
                made, end = made + line, end + _width(line)
            out.append(made.rstrip())
    return out


def page_text(page: str | None) -> str:
    """All visible text of a page, laid out; a null or empty page has none. Styles count where elements state them; style sheets are not read.

    >>> page_text("<p>a<br>b<ul><li>c<li>d</ul>")
    'a\\nb\\n\\n- c\\n- d'
    """
    if not page:
        return ""
    root = Builder().build(page)
    if STATED.search(page):
        veil(root)
    return Renderer().render(root).text()


def extract(pages: DataFrame, id_col: str = "page_id", html_col: str = "html") -> DataFrame:
    """(id_col, text, n_lines) for each row: the page's visible text and its number of lines.

    Null and empty pages and pages without visible text have the empty text and no lines. Markup of any kind is accepted; a page that ends
    inside a tag ends there. Repeated rows are rendered each; null ids stay; an empty table gives an empty result. Extra columns are ignored.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            made = [page_text(x) for x in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(made, pa.string()), pa.array([x.count("\n") + 1 if x else 0 for x in made], pa.int32())], ["id", "text", "n_lines"])

    rows = pages.select(F.col(id_col).cast("long").alias("id"), F.col(html_col).cast("string").alias("html"))
    return map_batches(rows, run, "id long, text string, n_lines int").withColumnRenamed("id", id_col)
