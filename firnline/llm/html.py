"""HTML extraction by layout-aware rendering.

A tree builder takes the tags of a page in order, closes elements whose end is implied (a paragraph before a block, an
item before the next item, cells and rows of a table) and ignores stray ends. Rendering walks the tree, skips what a reader
wouldn't see (scripts, styles, heads, ``hidden``, ``display:none``, ``visibility:hidden``) and writes all other text:
blocks on lines of their own, paragraphs apart by a blank line, items behind a bullet or number, controls apart by a
blank, the cells of a table in aligned columns.

A table is a grid: cells take the places their ``colspan`` and ``rowspan`` give them, keep their own lines, lists and
inner tables, and a column is as wide as its widest line. Cells that span columns widen the last of them, cells that span
rows run on beside the rows below. A table of one column is written as blocks. So that a page can't ask for more padding than a
small multiple of its own text (one very long line beside very many rows), columns are then narrowed until it doesn't;
a line longer than its column is written in full and pushes what follows on that line.

Tree, rendering and tables use explicit stacks, so depth is not limited; indentation stays at ``DEEPEST_INDENT`` columns
from there on.

Cases: null and empty pages give the empty text; broken markup is read as far as it goes, a tag that never closes is
dropped; text without tags comes back with its
white space collapsed; repeated rows give repeated results; extra columns ride along.
"""

from __future__ import annotations

import bisect
import re
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import Column

from firnline.llm.common import per_batch, text_of

# Element names of the markup standard.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
UNSEEN = frozenset("head script style noscript template title meta link iframe object audio video canvas svg datalist".split())
APART = frozenset("p h1 h2 h3 h4 h5 h6 ul ol dl table blockquote pre figure hr fieldset".split())
BLOCK = APART | frozenset(("address article aside body caption center dd details dialog div dt figcaption footer form "
                           "header html li main nav option section summary tbody td tfoot th thead tr").split())
#: An opening tag ends the open elements named, unless one of the bounds comes first.
IMPLIED = {
    "li": ({"li"}, {"ul", "ol"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "option": ({"option"}, {"select", "datalist"}),
    "tr": ({"tr", "td", "th", "caption"}, {"table"}),
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
    "thead": ({"thead", "tbody", "tfoot", "tr", "td", "th", "caption"}, {"table"}),
    "tbody": ({"thead", "tbody", "tfoot", "tr", "td", "th", "caption"}, {"table"}),
    "tfoot": ({"thead", "tbody", "tfoot", "tr", "td", "th", "caption"}, {"table"}),
    "body": ({"head"}, set()),
}
#: An end tag doesn't reach past these.
SCOPES = frozenset({"table", "td", "th", "caption"})
ENDS_PARAGRAPH_SEARCH = BLOCK - {"p"} | {"button"}
HIDING = re.compile(r"display\s*:\s*none|visibility\s*:\s*(?:hidden|collapse)", re.IGNORECASE)
UNFINISHED = re.compile(r"</?[A-Za-z]")
SPACE = re.compile(r"[ \t\n\r\f]+")
#: Controls that show their value.
SHOWN_INPUTS = frozenset("text search email url tel number date time submit button reset".split())
CONTROLS = frozenset("button select textarea input".split())
#: The markup standard's limits of spans.
COLSPAN, ROWSPAN = 1000, 65534
DEEPEST_INDENT = 400
#: Padding of a table is at most this many times its text, and this many characters on top.
PADDING, FREE_PADDING = 8, 100_000


class Element:
    __slots__ = ("tag", "attributes", "children", "grid", "lines")

    def __init__(self, tag: str, attributes: dict[str, str | None]):
        self.tag, self.attributes, self.children = tag, attributes, []
        self.grid = self.lines = None  # of a table: its cells, and its text once it is laid out

    def unseen(self) -> bool:
        return (self.tag in UNSEEN or "hidden" in self.attributes
                or bool(HIDING.search(self.attributes.get("style") or "")))

    def span(self, name: str, most: int) -> int:
        given = (self.attributes.get(name) or "").strip()
        return min(int(given[:9]), most) if given.isascii() and given.isdigit() else 1


class TreeBuilder(HTMLParser):
    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.root = Element("#root", {})
        self.open = [self.root]

    def end(self, names: set[str], bounds: set[str] | frozenset[str]) -> None:
        """End the outermost open element of ``names`` above the nearest of ``bounds``."""
        cut = None
        for i in range(len(self.open) - 1, 0, -1):
            if self.open[i].tag in bounds:
                break
            if self.open[i].tag in names:
                cut = i
        if cut is not None:
            del self.open[cut:]

    def handle_starttag(self, tag, attrs):
        if tag in ("html", "body") and any(e.tag == tag for e in self.open[:4]):
            return
        if tag in BLOCK and self.open[-1].tag == "p":
            self.open.pop()
        elif tag in BLOCK:
            self.end({"p"}, ENDS_PARAGRAPH_SEARCH)
        if tag in IMPLIED:
            self.end(*IMPLIED[tag])
        elif len(self.open) > 1 and tag not in UNSEEN and tag not in VOID and self.open[-1].tag == "head":
            self.open.pop()
        made = Element(tag, dict(attrs))
        self.open[-1].children.append(made)
        if tag not in VOID:
            self.open.append(made)

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)

    def handle_endtag(self, tag):
        if tag == "br":
            self.open[-1].children.append(Element("br", {}))
            return
        bounds = SCOPES - {tag} if tag not in ("table", "tr", "thead", "tbody", "tfoot") else {"table"} - {tag}
        for i in range(len(self.open) - 1, 0, -1):
            if self.open[i].tag == tag:
                del self.open[i:]
                return
            if self.open[i].tag in bounds:
                return

    def handle_data(self, data):
        if self.open[-1].tag == "head" and data.strip():
            self.open.pop()
        self.open[-1].children.append(data)


class Writer:
    """Collects text; breaks are kept back until text follows."""

    def __init__(self):
        self.parts: list[str] = []
        self.gap, self.blank, self.indent, self.marker = 0, False, "", None

    def apart(self, lines: int) -> None:
        self.gap, self.blank = max(self.gap, lines), False

    def start(self) -> None:
        if self.parts and self.gap:
            self.parts.append("\n" * self.gap)
        if self.gap or not self.parts:
            self.parts.append(self.indent[: -2] + self.marker if self.marker else self.indent)
            self.marker = None
        elif self.blank:
            self.parts.append(" ")
        self.gap, self.blank = 0, False

    def text(self, data: str) -> None:
        words = SPACE.sub(" ", data)
        if not words:
            return
        if words == " ":
            self.blank = True
            return
        self.blank |= words[0] == " "
        self.start()
        self.parts.append(words.strip(" "))
        self.blank = words[-1] == " "

    def lines(self, data: str) -> None:
        """Text whose line breaks and blanks count."""
        for i, line in enumerate(data.replace("\r\n", "\n").split("\n")):
            if i:
                self.gap, self.blank = self.gap + 1, False
            if line:
                self.start()
                self.parts.append(line)

    def written(self) -> str:
        return "".join(self.parts).strip("\n")


def cells_of(table: Element) -> tuple[list[list[Element]], list[Element]]:
    """The rows of cells of a table, and everything else in it that may hold text."""
    rows, rest, todo = [], [], list(reversed(table.children))
    while todo:
        x = todo.pop()
        if isinstance(x, str):
            if x.strip():
                rest.append(x)
        elif x.unseen():
            continue
        elif x.tag in ("thead", "tbody", "tfoot"):
            todo += reversed(x.children)
        elif x.tag == "tr":
            cells = [c for c in x.children if not isinstance(c, str) and c.tag in ("td", "th") and not c.unseen()]
            rest += [c for c in x.children if (isinstance(c, str) and c.strip()) or
                     (not isinstance(c, str) and c.tag not in ("td", "th") and not c.unseen())]
            rows.append(cells)
        elif x.tag in ("td", "th"):
            rows.append([x])
        else:
            rest.append(x)
    return rows, rest


class Cell:
    """A cell in the grid: where it stands, how far it reaches, and its lines."""

    __slots__ = ("element", "row", "col", "rows", "cols", "lines")

    def __init__(self, element: Element, row: int, col: int, rows: int, cols: int):
        self.element, self.row, self.col, self.rows, self.cols = element, row, col, rows, cols
        self.lines: list[str] = []


def placed(rows: list[list[Element]]) -> list[Cell]:
    """The cells in their places: each takes the first column that no cell above reaches into."""
    cells, reach = [], {}  # column -> first row that is free again
    for r, row in enumerate(rows):
        col = 0
        for element in row:
            while reach.get(col, 0) > r:
                col += 1
            down = element.span("rowspan", ROWSPAN) or len(rows)
            cell = Cell(element, r, col, min(down, len(rows) - r), max(1, element.span("colspan", COLSPAN)))
            cells.append(cell)
            if cell.rows > 1:
                for c in range(col, col + cell.cols):
                    reach[c] = r + cell.rows
            col += cell.cols
    return cells


def column_starts(cells: list[Cell], widest: int) -> dict[int, int]:
    """Where each column with a cell begins, lines beyond ``widest`` not counting; columns nobody begins in take no room."""
    used = sorted({c.col for c in cells})
    widths = dict.fromkeys(used, 0)
    spanning = []
    for cell in cells:
        width = min(widest, max(map(len, cell.lines), default=0))
        inside = [c for c in used[bisect.bisect_left(used, cell.col):bisect.bisect_left(used, cell.col + cell.cols)]]
        if len(inside) == 1:
            widths[cell.col] = max(widths[cell.col], width)
        else:
            spanning.append((len(inside), inside, width))
    for _, inside, width in sorted(spanning, key=lambda s: s[0]):
        lacking = width - sum(widths[c] + 2 * (widths[c] > 0) for c in inside) + 2
        if lacking > 0 and width:
            widths[inside[-1]] += lacking
    starts, at = {}, 0
    for c in used:
        starts[c] = at
        at += widths[c] + 2 * (widths[c] > 0)
    return starts


def laid_out(cells: list[Cell], rows: int) -> list[str]:
    """The lines of a table."""
    heights = [0] * rows
    for cell in sorted(cells, key=lambda c: c.rows):
        # A cell over several rows needs its last row to be high enough for what the rows above don't hold.
        above = sum(heights[cell.row:cell.row + cell.rows - 1])
        last = cell.row + cell.rows - 1
        heights[last] = max(heights[last], len(cell.lines) - above)
    first, at = [], 0
    for h in heights:
        first.append(at)
        at += h
    lines: list[list[tuple[int, str]]] = [[] for _ in range(at)]
    for cell in cells:
        for i, text in enumerate(cell.lines):
            if text:
                lines[first[cell.row] + i].append((cell.col, text))
    room = PADDING * sum(len(t) for line in lines for _, t in line) + FREE_PADDING
    widest = max((len(t) for line in lines for _, t in line), default=0)
    while True:
        starts = column_starts(cells, widest)
        if widest <= 1 or sum(max(starts[c] for c, _ in line) for line in lines if line) <= room:
            break
        widest //= 2
    out = []
    for line in lines:
        text = ""
        for col, part in sorted(line):
            text = (text + "  " if text and len(text) + 2 > starts[col] else text.ljust(starts[col])) + part
        out.append(text)
    return out


def lay_out_tables(root: Element) -> None:
    """Give every visible table of more than one column its lines, inner tables first."""
    tables, todo = [], [root]
    while todo:
        x = todo.pop()
        if x.tag == "table":
            rows, rest = cells_of(x)
            cells = placed(rows)
            if any(c.col for c in cells):
                x.grid = (cells, len(rows), rest)
                tables.append(x)
        todo += [c for c in x.children if not isinstance(c, str) and not c.unseen()]
    # Outer tables were met before the tables in them.
    for table in reversed(tables):
        cells, rows, rest = table.grid
        for cell in cells:
            inner = Writer()
            render(cell.element, inner)
            text = inner.written()
            cell.lines = [line.rstrip(" ") for line in text.split("\n")] if text else []
        out = Writer()
        for x in rest:  # captions and whatever else is no cell
            out.apart(1)
            if isinstance(x, str):
                out.text(x)
            else:
                holder = Element("#rest", {})
                holder.children = [x]
                render(holder, out)
        before = out.written()
        table.lines = (before.split("\n") if before else []) + laid_out(cells, rows)
        table.grid = None


def render(root: Element, out: Writer) -> None:
    """Write the text of an element's content; tables in it are laid out."""
    # An element or text, or a tuple that ends an element; ``lists`` has the counters of the open lists.
    todo: list = list(reversed(root.children))
    lists: list[int | None] = []
    plain = int(root.tag == "pre")
    while todo:
        x = todo.pop()
        if isinstance(x, str):
            out.lines(x) if plain else out.text(x)
            continue
        if isinstance(x, tuple):
            what, element, kept = x
            if what == "control":
                plain -= element.tag == "textarea"
                out.blank = out.gap == 0
                continue
            if element.tag in ("ul", "ol"):
                lists.pop()
            if element.tag == "pre":
                plain -= 1
            out.indent, out.marker = kept, None
            out.apart(2 if element.tag in APART and not (element.tag in ("ul", "ol") and lists) else 1)
            continue
        if x.unseen():
            continue
        if x.tag == "br":
            out.gap, out.blank = out.gap + 1 if out.gap < 2 else out.gap, False
            continue
        if x.lines is not None:
            out.apart(2)
            for line in x.lines:
                if line:
                    out.start()
                    out.parts.append(line)
                    out.gap = 0
                out.gap += 1
            out.apart(2)
            continue
        if x.tag == "img" and x.attributes.get("alt"):
            out.text(x.attributes["alt"])
        if x.tag in CONTROLS:
            out.blank |= out.gap == 0
            if x.tag == "input":
                if (x.attributes.get("type") or "text").lower() in SHOWN_INPUTS and x.attributes.get("value"):
                    out.text(x.attributes["value"])
                    out.blank = True
                continue
            plain += x.tag == "textarea"
            todo.append(("control", x, None))
        if x.tag in BLOCK:
            out.apart(2 if x.tag in APART and not (x.tag in ("ul", "ol") and lists) else 1)
            todo.append(("end", x, out.indent))
            if x.tag in ("ul", "ol"):
                begin = x.attributes.get("start") or "1"
                lists.append((int(begin[:18]) if begin.isascii() and begin.isdigit() else 1) if x.tag == "ol" else None)
            elif x.tag == "li":
                out.indent = out.indent + "  " if len(out.indent) < DEEPEST_INDENT else out.indent
                if lists and lists[-1] is not None:
                    out.marker = f"{lists[-1]}. "
                    lists[-1] += 1
                else:
                    out.marker = "- "
            elif x.tag == "pre":
                plain += 1
            elif x.tag in ("blockquote", "dd"):
                out.indent = out.indent + "  " if len(out.indent) < DEEPEST_INDENT else out.indent
        todo += reversed(x.children)


def visible_text(page: str) -> str:
    builder = TreeBuilder()
    builder.feed(page)
    if UNFINISHED.match(builder.rawdata):
        builder.rawdata = ""
    builder.close()
    lay_out_tables(builder.root)
    out = Writer()
    render(builder.root, out)
    return out.written()


def rendered(html: str | Column = "html") -> Column:
    """Column: the visible text of a page."""
    def make():
        def act(pages: pa.Array) -> pa.Array:
            return pa.array([visible_text(x) for x in pages.to_pylist()], pa.string())

        return act

    return per_batch(make, "string")(text_of(html))
