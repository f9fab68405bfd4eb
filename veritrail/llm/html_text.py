"""HTML extraction by layout-aware rendering.

A tokenizer and a tree builder with implied tags make a tree of elements; rules decide what
is visible; a renderer lays the visible text out as a browser would in plain text: blocks on lines of their
own, blank lines around paragraphs and headings, list markers with indentation, preformatted text as it
is, and table cells in aligned columns. All visible text is emitted, navigation and advertisements included.

Nothing recurses over the depth of a page: elements wait on a list, and the layout of a cell is a generator that the one driver loop runs while that
of its table waits.
"""

from __future__ import annotations

import html
import re
import unicodedata
from collections.abc import Generator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from veritrail.llm.common import small_batches, text_of

TOKEN = re.compile(r"<!--(?:-?>|.*?(?:--!?>|\Z))|<[!?][^>]*(?:>|\Z)|</(?=[^a-zA-Z])[^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:\"[^\"]*\"|'[^']*'|[^>\"'])*+)>", re.S)
LOOSE = re.compile(r"<(/?)([a-zA-Z][^\s/>]*)([^>]*+)(?:>|\Z)")
ATTRIBUTE = re.compile(r"([^\s=/\"'>]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
SPACES = re.compile(r"[ \t\n\r\f]+")
HIDING_STYLE = re.compile(r"display\s*:\s*none", re.I)
VISIBILITY = re.compile(r"visibility\s*:\s*(visible|hidden|collapse)", re.I)


def _names(text: str) -> frozenset[str]:
    return frozenset(text.split())


# Classes of HTML elements.
VOID = _names("area base br col embed hr img input link meta param source track wbr")
RAW = _names("script style textarea title xmp iframe noembed noframes noscript")
NEVER_SHOWN = _names("head script style template title noscript noembed noframes iframe object video audio canvas datalist annotation annotation-xml mphantom meta link base param source track colgroup col area")
BLOCK = _names("address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol optgroup option p pre section summary table tbody td tfoot th thead tr ul caption search xmp")
SPACED = _names("p h1 h2 h3 h4 h5 h6 blockquote ul ol dl table pre figure hr xmp")
LISTS = _names("ul ol menu dir")
CLOSES_P = BLOCK - _names("body html option optgroup legend li dd dt td th tr tbody thead tfoot caption") | _names("li dd dt")
#: An opening tag first closes the nearest open element of these names, unless a barrier stands between.
CLOSES = {
    "li": (_names("li"), _names("ul ol menu dir")), "dt": (_names("dt dd"), _names("dl")), "dd": (_names("dt dd"), _names("dl")),
    "option": (_names("option"), _names("select datalist")), "optgroup": (_names("option optgroup"), _names("select")),
    "tr": (_names("tr td th caption"), _names("table")), "td": (_names("td th caption"), _names("tr table")), "th": (_names("td th caption"), _names("tr table")),
    "tbody": (_names("tbody thead tfoot tr td th caption"), _names("table")), "thead": (_names("tbody thead tfoot tr td th caption"), _names("table")), "tfoot": (_names("tbody thead tfoot tr td th caption"), _names("table")),
    "body": (_names("head"), _names("body")), "a": (_names("a"), _names("table td th")),
}
#: Elements that end at any start tag but these, and at text that is not blank.
HOLDS_ONLY = {"head": _names("base link meta noframes noscript script style template title"), "colgroup": _names("col template")}
#: In svg and math other rules hold: a tag may close itself, no end is implied. HTML goes on inside of INTEGRATION, and ends them where a tag of BREAKOUT opens.
FOREIGN = _names("svg math")
INTEGRATION = _names("foreignobject desc title annotation-xml mi mo mn ms mtext")
BREAKOUT = _names(
    "b big blockquote body br center code dd div dl dt em embed h1 h2 h3 h4 h5 h6 head hr i img li listing menu meta nobr ol p pre ruby s small span strong strike sub sup table tt u ul var"
)
SVG_TEXT = _names("text foreignobject")
SVG_UNSHOWN = _names("clippath defs desc filter lineargradient marker mask metadata pattern radialgradient symbol")
#: End tags do not reach beyond these.
SCOPE = {"p": _names("table td th caption button"), "li": _names("ul ol menu dir table")}
TABLE_SCOPE = _names("table")
#: Character references beyond Unicode, however many digits they have.
TOO_LARGE = re.compile(r"&#(?:0*[1-9][0-9]{7,}|[xX]0*[1-9a-fA-F][0-9a-fA-F]{6,});?")
LEADING_ZEROS = re.compile(r"&#([xX]?)0{5,}")


def unescape(text: str) -> str:
    """Character references resolved; those beyond Unicode become U+FFFD, without a look at more digits than Unicode has."""
    return html.unescape(LEADING_ZEROS.sub(r"&#\g<1>0", TOO_LARGE.sub("\ufffd", text)))


class Element:
    __slots__ = ("name", "attributes", "children")

    def __init__(self, name: str, attributes: str = ""):
        self.name, self.attributes, self.children = name, attributes, []

    def get(self, key: str) -> str | None:
        """The value of an attribute, "" if it has none, None if it is absent."""
        if not self.attributes:
            return None
        for m in ATTRIBUTE.finditer(self.attributes):
            if m[1].lower() == key:
                return unescape(m[2] or m[3] or m[4] or "")
        return None


class Builder:
    """Open elements, with implied ends. counts tells at once whether a name is open."""

    def __init__(self):
        self.root = Element("#root")
        self.open, self.counts, self.foreign = [self.root], {}, [False]

    def _pop(self) -> Element:
        e = self.open.pop()
        self.foreign.pop()
        self.counts[e.name] -= 1
        return e

    def close(self, names: frozenset[str], barrier: frozenset[str]) -> None:
        """End the outermost open element of these names above the nearest barrier, and all within."""
        if not any(self.counts.get(n) for n in names):
            return
        found = None
        for i in range(len(self.open) - 1, 0, -1):
            if self.open[i].name in names:
                found = i
            elif self.open[i].name in barrier:
                break
        if found is not None:
            while len(self.open) > found:
                self._pop()

    def start(self, name: str, attributes: str, closed: bool) -> Element:
        self.leave(name)
        if name in BREAKOUT:
            while self.foreign[-1]:
                self._pop()
        foreign = self.foreign[-1]
        if name in CLOSES_P and not foreign and self.counts.get("p"):
            self.close(_names("p"), SCOPE["p"])
        if name in CLOSES and not foreign:
            self.close(*CLOSES[name])
        e = Element(name, attributes)
        self.open[-1].children.append(e)
        if name not in VOID and not (closed and (foreign or name in FOREIGN)):
            self.open.append(e)
            self.foreign.append(name in FOREIGN or (foreign and name not in INTEGRATION))
            self.counts[name] = self.counts.get(name, 0) + 1
        return e

    def leave(self, name: str) -> None:
        """End what may not hold an element of this name."""
        while (holds := HOLDS_ONLY.get(self.open[-1].name)) is not None and name not in holds and not self.foreign[-1]:
            self._pop()

    def end(self, name: str) -> None:
        if name == "br":
            self.leave(name)
            self.open[-1].children.append(Element("br"))
        elif name == "p" and not self.counts.get("p"):
            self.open[-1].children.append(Element("p"))
        elif name not in VOID and self.counts.get(name):
            barrier = SCOPE.get(name) or (frozenset() if name in ("table", "body", "html") else TABLE_SCOPE)
            for i in range(len(self.open) - 1, 0, -1):
                if self.open[i].name == name:
                    while len(self.open) > i:
                        self._pop()
                    return
                if self.open[i].name in barrier:
                    return

    def text(self, s: str) -> None:
        if s:
            s = unescape(s) if "&" in s else s
            if self.open[-1].name in HOLDS_ONLY and s.strip(" \t\n\r\f"):
                self.leave("#text")
            self.open[-1].children.append(s)


def parse(page: str) -> Element:
    """The tree of a page. Any text gives a tree."""
    tree, at, size, low = Builder(), 0, len(page), None
    while at < size:
        lt = page.find("<", at)
        if lt < 0:
            tree.text(page[at:])
            break
        if lt > at:
            tree.text(page[at:lt])
        m = TOKEN.match(page, lt) or LOOSE.match(page, lt)
        if m is None:
            tree.text("<")
            at = lt + 1
            continue
        at = m.end()
        if m[2] is None:
            continue
        name = m[2].lower()
        if m[1]:
            tree.end(name)
            continue
        e = tree.start(name, m[3].strip(), m[3].endswith("/"))
        if name in RAW and tree.open[-1] is e:
            low = page.lower() if low is None else low
            # lower() may change the length of a text outside ASCII: then search by pattern
            if len(low) == size:
                upto = low.find(f"</{name}", at)
            else:
                found = re.compile(f"</{name}", re.I).search(page, at)
                upto = found.start() if found else -1
            upto = size if upto < 0 else upto
            if name in ("textarea", "xmp"):
                e.children.append(unescape(page[at:upto]) if name == "textarea" else page[at:upto])
            at = upto
        elif name == "plaintext":
            e.children.append(page[at:])
            break
    return tree.root


def width(s: str) -> int:
    """Columns a text takes: wide characters two, combining ones none."""
    return len(s) if s.isascii() else sum(0 if unicodedata.combining(c) else 2 if unicodedata.east_asian_width(c) in "WF" else 1 for c in s)


class Layout:
    """Lines in the making: inline text collects until a block boundary."""

    def __init__(self):
        self.lines: list[str] = []
        self.inline: list[str] = []
        self.prefix, self.marker = "", ""
        self.gap, self.space = 0, False

    def words(self, s: str) -> None:
        flat = SPACES.sub(" ", s)
        if flat[0] == " ":
            self.space = True
            flat = flat[1:]
        if not flat:
            return
        if self.space and self.inline and not self.inline[-1].endswith("\n"):
            self.inline.append(" ")
        self.space = flat[-1] == " "
        self.inline.append(flat[:-1] if self.space else flat)

    def flush(self) -> None:
        """End the line in the making."""
        self.space = False
        if self.inline:
            text = "".join(self.inline)
            self.inline = []
            text = text[:-1] if text[-1:] == "\n" else text  # a break before the end of a block adds no line
            self.put([x.strip(" ") for x in text.split("\n")] if "\n" in text else [text])

    def put(self, lines: list[str]) -> None:
        if not lines:
            return
        if self.lines and self.gap:
            self.lines.append("")
        self.gap = 0
        for x in lines:
            lead = self.prefix
            if self.marker:
                lead, self.marker = self.prefix[: -len(self.marker)] + self.marker, ""
            self.lines.append((lead + x if lead else x).rstrip(" "))

    def blank(self) -> None:
        self.flush()
        self.gap = 1


def hidden(e: Element) -> bool:
    if e.name in NEVER_SHOWN:
        return True
    if not e.attributes:
        return False
    if e.name == "input":
        return (e.get("type") or "text").lower() in ("hidden", "checkbox", "radio", "file", "color", "range", "image", "password") or e.get("hidden") is not None
    low = e.attributes.lower()
    if "hidden" in low and e.get("hidden") is not None:
        return True
    return "style" in low and HIDING_STYLE.search(e.get("style") or "") is not None


def visibility(e: Element, inherited: bool) -> bool:
    if e.attributes and "visibility" in e.attributes.lower():
        found = VISIBILITY.findall(e.get("style") or "")
        if found:
            return found[-1].lower() == "visible"
    return inherited


def svg_texts(svg: Element, shown: bool) -> list[tuple[Element, bool]]:
    """The elements of a drawing that show text, in order, and whether they are visible."""
    found, todo = [], [(c, shown) for c in reversed(svg.children)]
    while todo:
        e, seen = todo.pop()
        if isinstance(e, str) or e.name in SVG_UNSHOWN or hidden(e):
            continue
        seen = visibility(e, seen)
        if e.name in SVG_TEXT:
            found.append((e, seen))
        else:
            todo.extend((c, seen) for c in reversed(e.children))
    return found


def number(value: str | None, default: int, most: int, least: int = 1) -> int:
    """The number that value begins with, within bounds; no more digits than the greatest has are converted."""
    found = re.match(r"[ \t\n\f\r]*\+?0*([0-9]+)", value or "")
    if not found:
        return default
    return most if len(found[1]) > len(str(most)) else max(least, min(most, int(found[1])))


def render(root: Element) -> list[str]:
    """The lines of the visible text below root."""
    waiting, lines = [layout(root, True)], None
    while waiting:
        try:
            waiting.append(waiting[-1].send(lines))
            lines = None
        except StopIteration as done:
            waiting.pop()
            lines = done.value
    return lines


def layout(root: Element, shown: bool) -> Generator[Generator, list[str], list[str]]:
    """The lines below root. Yields the layouts whose lines it needs."""
    out = Layout()
    # a task is an element to enter, a text, or a closing action; the last one is done first
    todo: list[tuple] = [("nodes", root.children, False, shown, None)]
    while todo:
        task = todo.pop()
        kind = task[0]
        if kind == "nodes":
            _, nodes, pre, seen, counter = task
            todo.extend(("node", n, pre, seen, counter) for n in reversed(nodes))
            continue
        if kind == "leave":
            task[1]()
            continue
        _, node, pre, seen, counter = task
        if isinstance(node, str):
            if not seen or not node:
                continue
            if pre:
                out.inline.append(node)
            else:
                out.words(node)
            continue
        name = node.name
        if name == "br":
            out.space = False
            out.inline.append("\n")
            continue
        if name == "wbr" or hidden(node):
            continue
        seen = visibility(node, seen)
        if name == "input":
            value = node.get("value") if seen else None
            if value and value.strip():
                out.words(f" {value} ")
            continue
        if name == "table":
            out.blank()
            out.put((yield table_layout(node, seen)))
            out.gap = 1
            continue
        if name == "svg":
            out.space = True
            for e, e_seen in reversed(svg_texts(node, seen)):
                todo.append(("leave", lambda: setattr(out, "space", True)))
                todo.append(("nodes", e.children, pre, e_seen, None))
            continue
        if name in ("pre", "textarea", "xmp") and not pre:
            _preformatted(out, node, todo, seen)
            continue
        if name not in BLOCK:
            if name == "q" and seen:
                out.words('"')
                todo.append(("leave", lambda: out.inline.append('"')))
            todo.append(("nodes", node.children, pre, seen, counter))
            continue
        if pre:
            # a block within preformatted text begins and ends a line, and its spaces stay
            fresh = lambda: out.inline.append("\n") if "".join(out.inline[-1:])[-1:] not in ("", "\n") else None
            fresh()
            todo.append(("leave", fresh))
            todo.append(("nodes", node.children, True, seen, None))
            continue
        out.flush()
        if name in SPACED and not (name in LISTS and counter is not None):
            out.gap = 1
        old = out.prefix
        child_counter = None
        children = node.children
        if name == "li":
            mark = "- "
            if counter is not None and counter[0] == "ol":
                counter[1] = number(node.get("value"), counter[1], 10**9)
                mark = f"{counter[1]}. "
                counter[1] += 1
            out.prefix, out.marker = old + " " * len(mark), mark
        elif name in LISTS:
            child_counter = [name, number(node.get("start"), 1, 10**9)]
        elif name == "blockquote":
            out.prefix = old + "> "
        elif name == "dd":
            out.prefix = old + "  "
        elif name == "details" and node.get("open") is None:
            children = [c for c in children if isinstance(c, Element) and c.name == "summary"][:1]
        after = name in SPACED and not (name in LISTS and counter is not None)

        def leave(old=old, after=after):
            out.flush()
            out.prefix, out.marker = old, ""
            if after:
                out.gap = 1

        todo.append(("leave", leave))
        inside = child_counter if child_counter is not None else (None if name != "li" else ["", 0])
        todo.append(("nodes", children, False, seen, inside))
    out.flush()
    return out.lines


def _preformatted(out: Layout, node: Element, todo: list, seen: bool) -> None:
    out.blank()

    def leave():
        text = "".join(out.inline)
        out.inline = []
        lines = text.replace("\r\n", "\n").replace("\r", "\n").expandtabs(8).split("\n")
        while lines and not lines[0].strip():
            lines.pop(0)
        while lines and not lines[-1].strip():
            lines.pop()
        out.put([x.rstrip(" ") for x in lines])
        out.gap = 1

    todo.append(("leave", leave))
    todo.append(("nodes", node.children, True, seen, None))


def table_layout(table: Element, shown: bool) -> Generator[Generator, list[str], list[str]]:
    """Captions and loose content first, then rows with aligned columns; rows of several-line cells take as many lines.

    A cell of several columns or rows keeps their places free (1,000 columns and 65,534 rows at most, as HTML has it; 64 columns widen it). Yields the layouts of cells.
    """
    rows: list[list[tuple[int, list[str], int]]] = []  # of each row: column, lines and columns of its cells
    held: dict[int, int] = {}  # the first row in which a column is no longer taken by a cell above
    at = 0
    loose = Element("div")
    todo = [(c, shown) for c in reversed(table.children)]
    while todo:
        e, seen = todo.pop()
        if isinstance(e, str):
            if e.strip():
                loose.children.append(e)
            continue
        if hidden(e):
            continue
        seen = visibility(e, seen)
        if e.name in ("tbody", "thead", "tfoot"):
            todo.extend((c, seen) for c in reversed(e.children))
            held = {}  # cells end with their group of rows
        elif e.name in ("tr", "td", "th"):
            cells, column = [], 0
            for c in e.children if e.name == "tr" else [e]:
                if isinstance(c, Element) and c.name in ("td", "th") and not hidden(c):
                    while held.get(column, 0) > at:
                        column += 1
                    span, below = number(c.get("colspan"), 1, 1000), number(c.get("rowspan"), 1, 65534, 0)
                    cells.append((column, (yield layout(c, visibility(c, seen))) or [""], span))
                    if below != 1:
                        held |= dict.fromkeys(range(column, column + span), at + (below or 65534))
                    column += span
                elif isinstance(c, Element) or c.strip():
                    loose.children.append(c)
            at += 1
            if cells:
                rows.append(cells)
        else:
            loose.children.append(e)
    lines = yield layout(loose, shown)
    if all(len(row) == 1 and row[0][0] == 0 for row in rows):  # one column needs no widths
        return lines + [x for row in rows if any(row[0][1]) for x in row[0][1]]
    widths: dict[int, int] = {}
    for row in rows:
        for column, cell, span in row:
            if span == 1:
                widths[column] = max(widths.get(column, 0), max(map(width, cell)))
    ends = sorted({column for row in rows for column, _, _ in row} | set(widths))
    for row in rows:
        if all(not any(cell) for _, cell, _ in row):
            continue
        taken = {column: (cell, span) for column, cell, span in row}
        last = row[-1][0]
        for k in range(max(len(cell) for _, cell, _ in row)):
            out, upto = [], 0
            for column in ends:
                if column > last:
                    break
                if column < upto:
                    continue
                cell, span = taken.get(column, ([], 1))
                text = cell[k] if k < len(cell) else ""
                upto = column + span
                room = sum(widths.get(c, 0) for c in range(column, column + min(span, 64))) + 2 * (min(span, 64) - 1)
                out.append(text + " " * max(0, room - width(text)))
            lines.append("  ".join(out).rstrip(" "))
    return lines


def extract(page: str | None) -> str:
    """The visible text of a page."""
    return "\n".join(render(parse(page or "")))


def extract_text(pages: DataFrame, id_col: str = "page_id", html_col: str = "html") -> DataFrame:
    """id and text of each row of pages.

    Null and empty pages give an empty text, text without tags gives itself with white space collapsed. Ids may be null or repeated. Other columns are not read.
    """
    small_batches(pages.sparkSession)

    @F.pandas_udf(T.StringType())
    def rendered(texts: pd.Series) -> pd.Series:
        return pd.Series([extract(t) for t in texts], dtype=object)

    return pages.select(F.col(id_col), rendered(text_of(html_col)).alias("text"))
