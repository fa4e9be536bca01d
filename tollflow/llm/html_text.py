"""HTML to text by layout-aware rendering.

A small tree builder opens and closes elements with the implied end tags of
HTML, then a renderer walks the tree: hidden elements give nothing, block
elements start on new lines, list items carry their marker, and table cells
are padded so that columns line up.  Text of formulas and drawings is shown,
and so is text that is hidden from screen readers only (aria-hidden).  Of
embedded objects, media, frames and canvases nothing is shown, nor is what
they hold for browsers that cannot show them.

Nothing is cut and nothing recurses: elements and tables may be nested to any
depth, and a malformed page takes time in proportion to its length.  A tag
that is never closed is text, together with all that follows.
"""

from __future__ import annotations

import bisect
import html
import re
from collections import defaultdict

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tollflow.llm.common import read_table

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
IN_HEAD = frozenset("title meta link style script base noscript template".split())
# open elements that end at the first tag they cannot hold, or at text other than spaces
ONLY_HOLDS = {"head": IN_HEAD, "colgroup": frozenset(("col", "template"))}
RAW = frozenset("script style textarea title".split())       # text up to the own end tag
HIDDEN = frozenset("head script style template noscript iframe object datalist "
                   "audio video canvas title input".split())
# what a drawing or a formula holds but does not show
NOT_DRAWN = {"svg": frozenset("desc defs symbol metadata clippath mask marker pattern".split()),
             "math": frozenset(("annotation", "annotation-xml"))}
BLOCK = frozenset(
    "address article aside blockquote body center dd details dialog div dl dt fieldset figcaption "
    "figure footer form h1 h2 h3 h4 h5 h6 header hgroup html legend li main menu nav ol p pre "
    "search section summary table tbody tfoot thead tr ul".split())
SPACED = frozenset("p h1 h2 h3 h4 h5 h6 ul ol dl table blockquote pre figure".split())
CELLS = frozenset(("td", "th"))
# an opening tag closes these open elements, up to the nearest scope element
_ITEMS = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "option": ("option",),
          "tr": ("tr", "td", "th", "caption"), "td": ("td", "th", "caption"), "th": ("td", "th", "caption"),
          **{t: ("thead", "tbody", "tfoot", "tr", "td", "th", "caption")
             for t in ("thead", "tbody", "tfoot", "colgroup")}}
CLOSES = {**{b: ("p",) for b in BLOCK}, **{k: (*v, "p") for k, v in _ITEMS.items()}}
# elements that neither a closing nor an implied end tag reaches out of
BARRIERS = ("table", "td", "th", "caption", "object", "button")
PARTS = frozenset("tr td th thead tbody tfoot caption colgroup".split())
SCOPE = {"li": ("ul", "ol", "menu", *BARRIERS), "dt": ("dl", *BARRIERS), "dd": ("dl", *BARRIERS),
         **{t: ("table",) for t in PARTS}}
DEFAULT_SCOPE = (*BARRIERS, "body", "html")
NAME = re.compile(r"(/?)([a-zA-Z][^\s/>]*+)")
TAG_REST = re.compile(r"((?:[^>=]++|=\s*+(?:\"[^\"]*+\"|'[^']*+')?+)*+)>")
ATTR = re.compile(r"([^\s=/>]+)(?:\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s>]+))?")
COMMENT = re.compile(r"/\*.*?\*/", re.S)
SPACE = re.compile(r"[ \t\n\r\f]+")
MAX_COLSPAN, MAX_ROWSPAN = 1000, 65534        # as in browsers


class Node:
    __slots__ = ("name", "attrs", "children")

    def __init__(self, name: str, attrs: dict):
        self.name, self.attrs, self.children = name, attrs, []


class TreeBuilder:
    """Open elements and the end tags that other tags imply.

    ``places`` lists, by name, where in the stack the open elements stand, so no
    tag has to look through the stack.
    """

    def __init__(self):
        self.root = Node("html", {})
        self.stack, self.places = [self.root], defaultdict(list)

    def text(self, s: str) -> None:
        if self.stack[-1].name in ONLY_HOLDS and SPACE.sub("", s):
            self._cut(len(self.stack) - 1)
        top = self.stack[-1]
        if top.name == "pre" and not top.children and s.startswith("\n"):
            s = s[1:]
        if s:
            top.children.append(s)

    def _cut(self, at: int) -> None:
        while len(self.stack) > at:
            self.places[self.stack.pop().name].pop()

    def _last(self, names) -> int:
        """Place of the innermost open element of these names, 0 if there is none."""
        return max((self.places[n][-1] for n in names if self.places[n]), default=0)

    def start(self, name: str, attrs: dict, empty: bool = False) -> None:
        """``empty``: the tag ends in a slash, which only counts in drawings and formulas."""
        if name == "html" or (name == "body" and self.places["body"]):
            return
        if name not in ONLY_HOLDS.get(self.stack[-1].name, (name,)):
            self._cut(len(self.stack) - 1)
        closes = [self.places[c] for c in CLOSES.get(name, ()) if self.places[c]]
        if closes:
            scope = self._last(SCOPE.get(name, DEFAULT_SCOPE))
            # the outermost of them within the scope
            cuts = [p[i] for p in closes if (i := bisect.bisect_right(p, scope)) < len(p)]
            if cuts:
                self._cut(min(cuts))
        if any(self.places[k] and name in names for k, names in NOT_DRAWN.items()):
            attrs = {**attrs, "hidden": ""}
        node = Node(name, attrs)
        if name == "text" and self.places["svg"]:    # labels stand apart
            self.stack[-1].children.append(" ")
        self.stack[-1].children.append(node)
        if name not in VOID and name not in RAW and not (empty and self.foreign(name)):
            self.places[name].append(len(self.stack))
            self.stack.append(node)

    def end(self, name: str) -> None:
        """Closes the innermost such element, unless a cell, caption or table stands between."""
        if name == "br":
            self.stack[-1].children.append(Node("br", {}))
        elif self.places[name]:
            at = self.places[name][-1]
            if name != "table" and at < self._last(("table",) if name in PARTS else BARRIERS):
                return
            self._cut(at)
            if name == "text" and self.places["svg"]:
                self.stack[-1].children.append(" ")

    def foreign(self, name: str) -> bool:
        return name in NOT_DRAWN or any(self.places[k] for k in NOT_DRAWN)


def _ends_itself(attrs: str) -> bool:
    """The tag's last sign is a slash that does not belong to a value without quotes."""
    if not attrs.endswith("/"):
        return False
    at = max(map(attrs.rfind, " \t\n\r\f\"'")) + 1
    return "=" not in attrs[at:] and (attrs[at:] == "/" or not attrs[:at].rstrip().endswith("="))


def parse(source: str) -> Node:
    """Tree of the document; never fails, unclosed elements end with their parent."""
    tree, at, n = TreeBuilder(), 0, len(source)
    quoted = True                                  # until a quotation turns out to have no end
    while at < n:
        opened = source.find("<", at)
        if opened < 0:
            tree.text(html.unescape(source[at:]))
            break
        tree.text(html.unescape(source[at:opened]))
        at = opened + 1
        if source.startswith(("!", "?"), at):      # comment, declaration or instruction
            comment = source.startswith("!--", at)
            stop = source.find("-->" if comment else ">", at + comment)
            at = n if stop < 0 else stop + (3 if comment else 1)
            continue
        m = NAME.match(source, at)
        if not m:
            tree.text("<")
            continue
        rest = TAG_REST.match(source, m.end()) if quoted else None
        if rest:
            given, at = rest[1], rest.end()
        else:
            quoted = False
            stop = source.find(">", m.end())
            if stop < 0:                           # never closed: no tag, and none behind it
                tree.text(html.unescape(source[opened:]))
                break
            given, at = source[m.end():stop], stop + 1
        name = m[2].lower()
        if m[1]:
            tree.end(name)
            continue
        attrs = {}
        if given:
            for k, v in ATTR.findall(given):
                attrs.setdefault(k.lower(), v[1:-1] if v[:1] in ("'", '"') else v)
        empty = _ends_itself(given)
        tree.start(name, attrs, empty)
        if name in RAW and not (empty and tree.foreign(name)):       # text up to the element's own end tag
            stop = re.compile(f"</{name}(?=[\\s/>])", re.I).search(source, at)
            if name == "textarea":
                tree.stack[-1].children[-1].children.append(
                    html.unescape(source[at:stop.start() if stop else n]))
            end = source.find(">", stop.end()) if stop else -1
            at = end + 1 if end >= 0 else n
    return tree.root


def _style(node: Node) -> dict[str, str]:
    """Declarations of the style attribute; the last of a property counts, important ones first."""
    if "style" not in node.attrs:
        return {}
    out, strong = {}, {}
    for part in COMMENT.sub(" ", html.unescape(node.attrs["style"])).split(";"):
        name, colon, value = part.partition(":")
        value, mark, important = value.strip().lower().partition("!")
        if colon:
            (strong if important.strip() == "important" else out)[name.strip().lower()] = value.strip()
    return {**out, **strong}


def _hidden(node: Node) -> bool:
    """The element and all below it take no part in the layout."""
    if node.name in HIDDEN or (node.name == "dialog" and "open" not in node.attrs):
        return True
    display = _style(node).get("display") if "style" in node.attrs else None
    return "hidden" in node.attrs if display is None else display == "none"


def _shown(node: Node, above: bool) -> bool:
    """Visibility is inherited, and can be set again below."""
    value = _style(node).get("visibility") if "style" in node.attrs else None
    return {"visible": True, "hidden": False, "collapse": False}.get(value, above)


class Lines:
    """Lines under construction: inline text collapses spaces, blocks break lines."""

    def __init__(self):
        self.lines, self.now, self.gap, self.mark = [], [], False, ""

    def inline(self, s: str) -> None:
        s = SPACE.sub(" ", s)
        if s.startswith(" ") and (not self.now or self.now[-1].endswith(" ")):
            s = s[1:]
        if s:
            self.now.append(s)

    def verbatim(self, s: str) -> None:
        first, *more = s.split("\n")
        self.now.append(first)
        for x in more:
            self.add("".join(self.now))
            self.now = [x]

    def add(self, line: str) -> None:
        if self.gap and self.lines:
            self.lines.append("")
        self.lines.append((self.mark + line).rstrip(" "))
        self.gap, self.mark = False, ""

    def flush(self) -> None:
        line, self.now = "".join(self.now).rstrip(" "), []
        if line:
            self.add(line)

    def space(self) -> None:
        self.flush()
        self.gap = True


def _number(text: str) -> int | None:
    """A whole number of at most nine digits, as in an attribute; else None."""
    m = re.match(r"\s*([-+]?\d{1,9})(?!\d)", text)
    return int(m[1]) if m else None


def _items(node: Node, indent: str, pre: bool, shown: bool) -> list:
    """Steps for a list: a marker in front of the first line of every item."""
    steps, down = [], -1 if "reversed" in node.attrs else 1
    items = [k for k in node.children if isinstance(k, Node) and k.name == "li" and not _hidden(k)]
    number = _number(node.attrs.get("start", ""))
    number = (1 if down > 0 else len(items)) if number is None else number
    for kid in node.children:
        if isinstance(kid, Node) and kid.name == "li" and not _hidden(kid):
            own = _number(kid.attrs.get("value", ""))
            number = number if own is None else own
            visible = _shown(kid, shown)
            mark = indent + (f"{number}. " if node.name == "ol" else "- ") if visible else ""
            steps.append(("mark", mark, "", pre, visible))
            steps += [("node", x, indent + "  ", pre, visible) for x in kid.children]
            steps.append(("end item", None, "", pre, visible))
            number += down
        else:
            steps.append(("node", kid, indent, pre, shown))
    return steps


def _walk(start: list, out: Lines, tables: dict) -> None:
    """Render nodes with a list of steps, not by recursion: nesting may be of any depth.

    ``start``: (node or text, visible); ``tables``: the lines of the tables below.
    """
    todo = [("node", x, "", False, shown) for x, shown in reversed(start)]
    while todo:
        step, x, indent, pre, shown = todo.pop()
        if step == "mark":
            out.flush()
            out.mark = x
        elif step == "end item":
            out.flush()
            out.mark = ""
        elif step == "flush":
            out.flush()
        elif step == "space":
            out.space()
        elif isinstance(x, str):
            if shown:
                out.verbatim(x) if pre else out.inline(x)
        elif _hidden(x):
            continue
        elif x.name == "br":
            if not out.now:
                out.gap = True
            out.flush()
        elif x.name == "hr":
            out.space()
        elif x.name == "table":
            out.space()
            for line in tables[x]:
                out.add(line)
            out.gap = True
        else:
            shown = _shown(x, shown)
            pre = pre or x.name in ("pre", "textarea")
            nested = x.name in ("ul", "ol", "menu")
            end = "space" if x.name in SPACED and not (nested and indent) else "flush"
            steps = _items(x, indent, pre, shown) if nested else [
                ("node", k, indent, pre, shown) for k in x.children]
            if x.name in BLOCK:
                out.space() if end == "space" else out.flush()
                steps.append((end, None, "", pre, shown))
            todo.extend(reversed(steps))


def _rows(table: Node, shown: bool):
    """(row or loose content, visible) of a table in order; None where a group of rows ends."""
    for kid in table.children:
        if isinstance(kid, str):
            if kid.strip():
                yield kid, shown
        elif kid.name in ("thead", "tbody", "tfoot"):
            if not _hidden(kid):
                visible = _shown(kid, shown)
                yield from ((k, visible) for k in kid.children if not isinstance(k, str) or k.strip())
            yield None, shown
        elif kid.name not in ("col", "colgroup"):
            yield kid, shown


def _cell(node, shown: bool, tables: dict) -> str:
    """Text of a cell, its lines joined by spaces."""
    out = Lines()
    _walk([(node, shown)], out, tables)
    out.flush()
    return " ".join(x.strip() for x in out.lines if x.strip())


def _table(table: Node, shown: bool, tables: dict) -> list[str]:
    """Lines of a table; the cells of a column start at the same place.

    A cell takes the next column that no cell from above reaches down into.
    """
    grid, down = [], {}                            # down: column -> rows that it is taken for
    for row, visible in _rows(table, shown):
        if row is None:
            down = {}
        elif isinstance(row, str) or row.name != "tr":
            grid.append({0: _cell(row, visible, tables)})
        elif not _hidden(row):
            cells, column, visible, taken = {}, 0, _shown(row, visible), dict(down)
            for cell in row.children:
                if isinstance(cell, str) and not cell.strip() or isinstance(cell, Node) and _hidden(cell):
                    continue
                while column in taken:
                    column += 1
                cells[column] = _cell(cell, visible, tables)
                attrs = {} if isinstance(cell, str) else cell.attrs
                wide = min(max(_number(attrs.get("colspan", "")) or 1, 1), MAX_COLSPAN)
                high = _number(attrs.get("rowspan", ""))
                high = 1 if high is None or high < 0 else high or MAX_ROWSPAN    # 0: to the group's end
                if high > 1:
                    down.update((c, min(high, MAX_ROWSPAN)) for c in range(column, column + wide))
                column += wide
            down = {c: left - 1 for c, left in down.items() if left > 1}
            grid.append(cells)
    grid = [cells for cells in grid if any(cells.values())]
    places = {c: i for i, c in enumerate(sorted({c for cells in grid for c in cells}))}
    widths = [0] * len(places)
    for cells in grid:
        if len(cells) > 1:
            for c, text in cells.items():
                widths[places[c]] = max(widths[places[c]], len(text))
    return [_line(cells, places, widths) for cells in grid]


def _line(cells: dict[int, str], places: dict[int, int], widths: list[int]) -> str:
    if list(cells) == [0]:
        return cells[0]
    texts = [""] * (places[max(cells)] + 1)
    for c, text in cells.items():
        texts[places[c]] = text
    return "  ".join(t.ljust(w) for t, w in zip(texts, widths)).rstrip()


def _all_tables(root: Node) -> list[tuple[Node, bool]]:
    """(table, visible) of every table that takes part in the layout, outer ones first."""
    found, todo = [], [(root, True)]
    while todo:
        x, shown = todo.pop()
        if isinstance(x, str) or _hidden(x):
            continue
        shown = _shown(x, shown)
        if x.name == "table":
            found.append((x, shown))
        todo.extend((k, shown) for k in x.children)
    return found


def render(source: str | None) -> str:
    """Visible text of an HTML document; NULL or empty gives an empty text."""
    root, tables = parse(source or ""), {}
    for table, shown in reversed(_all_tables(root)):       # inner tables first
        tables[table] = _table(table, shown, tables)
    out = Lines()
    _walk([(root, True)], out, tables)
    out.flush()
    return "\n".join(out.lines)


def text_column(source: Column) -> Column:
    @F.pandas_udf("string")
    def rendered(pages: pd.Series) -> pd.Series:
        return pages.map(render)
    return rendered(F.coalesce(source, F.lit("")))


def extract(pages: DataFrame) -> DataFrame:
    """page_id and text, one row per input row; other columns than page_id and html are ignored."""
    return pages.select("page_id", text_column(F.col("html")).alias("text"))


def op7_html_extraction(spark, sf_dir: str) -> DataFrame:
    """``extract`` over all pages."""
    return extract(read_table(spark, sf_dir, "pages")).select(
        "page_id", "text", F.char_length("text").cast("long").alias("n_chars"))
