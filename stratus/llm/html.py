"""Layout-aware text of HTML pages.

A small tree builder with implied tags makes the element tree; elements that a
browser does not show are left out; the rest is rendered as text that keeps
block spacing, list markers, preformatted text and aligned table cells.
"""

from __future__ import annotations

import html as entities
import re
from bisect import bisect_right
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from .frames import with_results

#: Fixed sets of HTML element names.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW_TEXT = frozenset("script style xmp iframe noembed noframes noscript template".split())
ESCAPABLE_TEXT = frozenset("title textarea".split())
NOT_SHOWN = frozenset("head script style template noscript iframe noembed noframes title meta link base datalist audio video canvas object".split())
#: Elements that are not shown inside an svg or math element.
NOT_DRAWN = frozenset("desc metadata defs symbol clippath mask pattern marker annotation annotation-xml".split())
BLOCK = frozenset(
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol optgroup option p pre search section summary table ul".split()
)
SPACED = frozenset("p h1 h2 h3 h4 h5 h6 ul ol dl table blockquote pre figure form fieldset hr".split())
CLOSES_P = BLOCK - {"html", "body", "dd", "dt", "li", "legend", "option", "optgroup"} | {"dd", "dt", "li"}
TABLE_PARTS = frozenset("table caption colgroup thead tbody tfoot tr td th".split())
#: A start tag closes these open elements, looked for up to the nearest of the second set.
IMPLIED_END = {
    "li": ({"li"}, {"ul", "ol", "menu", "dir", "table", "td", "th"}),
    "dt": ({"dt", "dd"}, {"dl", "table", "td", "th"}),
    "dd": ({"dt", "dd"}, {"dl", "table", "td", "th"}),
    "option": ({"option"}, {"select", "datalist"}),
    "optgroup": ({"option", "optgroup"}, {"select"}),
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
    "tr": ({"tr", "td", "th", "caption", "colgroup"}, {"tbody", "thead", "tfoot", "table"}),
    "tbody": ({"tbody", "thead", "tfoot", "caption", "colgroup", "tr", "td", "th"}, {"table"}),
    "thead": ({"tbody", "thead", "tfoot", "caption", "colgroup", "tr", "td", "th"}, {"table"}),
    "tfoot": ({"tbody", "thead", "tfoot", "caption", "colgroup", "tr", "td", "th"}, {"table"}),
    "body": ({"head"}, set()),
}
_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|<(/?)([a-zA-Z][^\s/>]*)((?:[^>=]|=\s*\"[^\"]*(?:\"|\Z)|=\s*'[^']*(?:'|\Z)|=)*+)(>|\Z)|[^<]+|<",
    re.S,
)
#: Tables nested deeper than this are rendered as plain blocks: their text stays, the columns do not.
TABLE_DEPTH = 120
#: Fixed limits of the table model: a cell spans at most so many columns and rows.
MOST_COLUMNS, MOST_ROWS = 1000, 65534
_ATTR = re.compile(r"([^\s=/\"'>]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
_NOT_DISPLAYED = re.compile(r"(?:^|;)\s*display\s*:\s*none\b", re.I)
_VISIBILITY = re.compile(r"(?:^|;)\s*visibility\s*:\s*(visible|hidden|collapse)\b", re.I)
_HEAD = re.compile(r"(?:[^{};@]*;|\s*@[^{};]*;|\s*\})*+([^{};]*)\{")
_BRACE = re.compile(r"[{}]")
_COMMENT = re.compile(r"/\*.*?(?:\*/|\Z)", re.S)
_SELECTOR = re.compile(r"([a-z][a-z0-9]*)?(?:\.([\w-]+)|#([\w-]+))?\Z", re.I)
_SPACES = re.compile(r"[ \t\n\f\r]+")


@dataclass(slots=True)
class Node:
    tag: str
    attrs: dict[str, str] = field(default_factory=dict)
    children: list = field(default_factory=list)  # nodes and strings
    style: str = ""  # what style sheets of the page say of it, before its own style


def _attributes(text: str) -> dict[str, str]:
    out: dict[str, str] = {}
    for name, a, b, c in _ATTR.findall(text):
        out.setdefault(name.lower(), entities.unescape(a or b or c))
    return out


class _Styles:
    """The rules of a page's style sheets that hide or show, by simple selectors: a tag, a class, an id, or a tag with one."""

    def __init__(self) -> None:
        self.rules: dict[tuple[str, str, str], str] = {}

    def read(self, sheet: str) -> None:
        sheet = _COMMENT.sub("", sheet)
        at = 0
        while (m := _HEAD.match(sheet, at)):  # rule after rule
            at = m.end()
            if m.group(1).lstrip().startswith("@"):  # what it holds depends on the reader
                depth = 1
                while depth and (brace := _BRACE.search(sheet, at)):
                    depth += 1 if brace.group() == "{" else -1
                    at = brace.end()
                if depth:
                    return
                continue
            stop = sheet.find("}", at)
            body = sheet[at : stop if stop >= 0 else len(sheet)]
            at = stop + 1 if stop >= 0 else len(sheet)
            if _NOT_DISPLAYED.search(body) or _VISIBILITY.search(body):
                for one in m.group(1).split(","):
                    found = _SELECTOR.match(one.strip())
                    if found and one.strip():
                        key = tuple((x or "") for x in found.groups())
                        key = (key[0].lower(), *key[1:])
                        self.rules[key] = self.rules.get(key, "") + body + ";"

    def of(self, tag: str, attrs: dict[str, str]) -> str:
        found, ident = [], attrs.get("id", "")
        for cls in ("", *attrs.get("class", "").split()):
            found += [self.rules.get((t, cls, ""), "") for t in ("", tag)]
        if ident:
            found += [self.rules.get((t, "", ident), "") for t in ("", tag)]
        return "".join(found)


def build_tree(source: str) -> Node:
    """The element tree; missing end tags are implied and stray end tags ignored. Any depth, in linear time."""
    root = Node("#root")
    stack = [root]
    open_at: dict[str, list[int]] = {}  # places in the stack by tag, rising
    styles = _Styles()
    at, end = 0, len(source)

    def last(tags: set[str]) -> int:
        return max((open_at[t][-1] for t in tags if open_at.get(t)), default=0)

    def cut(k: int) -> None:
        for node in stack[k:]:
            open_at[node.tag].pop()
        del stack[k:]

    def close(names: set[str], stop: set[str]) -> None:
        """Ends the outermost of the named elements inside the nearest ``stop``, with all that is open in it."""
        if not any(open_at.get(t) for t in names):
            return
        least = last(stop)
        found = []
        for t in names:
            own = open_at.get(t, ())
            k = bisect_right(own, least)
            if k < len(own):
                found.append(own[k])
        if found:
            cut(min(found))

    while at < end:
        m = _TOKEN.match(source, at)
        at = m.end()
        slash, tag, attrs, closed = m.groups()
        if tag is None:
            text = m.group()
            if not text.startswith(("<!", "<?")):
                stack[-1].children.append(entities.unescape(text))
            continue
        if not closed:
            break  # the page ends within a tag
        tag = tag.lower()
        if slash:
            if tag in ("html", "body"):
                continue
            scope = set() if tag == "table" else {"table"} if tag in BLOCK or tag in TABLE_PARTS else {"table", "td", "th"}
            k = last({tag})
            if k and k >= last(scope):
                cut(k)
            continue
        if tag in CLOSES_P:
            close({"p"}, {"table", "td", "th", "button"})
        if tag in IMPLIED_END:
            close(*IMPLIED_END[tag])
        node = Node(tag, _attributes(attrs) if attrs.strip() else {})
        if tag in NOT_DRAWN and last({"svg", "math"}):
            node.attrs["hidden"] = ""
        if styles.rules:
            node.style = styles.of(tag, node.attrs)
        stack[-1].children.append(node)
        if tag in VOID or attrs.endswith("/") and tag not in BLOCK and tag not in TABLE_PARTS and tag not in RAW_TEXT | ESCAPABLE_TEXT:
            continue
        if tag in RAW_TEXT or tag in ESCAPABLE_TEXT:
            stop = re.compile(rf"</{re.escape(tag)}(?=[\s/>])[^>]*>|\Z", re.I).search(source, at)
            body = source[at : stop.start()]
            node.children.append(body if tag in RAW_TEXT else entities.unescape(body))
            at = stop.end()
            if tag == "style":
                styles.read(body)
            continue
        open_at.setdefault(tag, []).append(len(stack))
        stack.append(node)
    return root


def shown(node: Node) -> bool:
    """Whether a browser would lay the element out, by its name, its own attributes and the page's style sheets."""
    a = node.attrs
    if node.tag in NOT_SHOWN or "hidden" in a or (node.tag == "input" and a.get("type", "").lower() == "hidden"):
        return False
    if node.tag == "dialog" and "open" not in a:
        return False
    own = a.get("style", "")
    if node.style and "display" not in own.lower() and _NOT_DISPLAYED.search(node.style):
        return False
    return not _NOT_DISPLAYED.search(own)


def visible(node: Node, before: bool) -> bool:
    """Whether text of the element is seen: visibility is inherited, and an element may set it anew either way."""
    found = _VISIBILITY.findall(f"{node.style};{node.attrs.get('style', '')}")
    return found[-1].lower() == "visible" if found else before


def _content(node: Node) -> list:
    """The children that are laid out; of closed details only the first summary."""
    if node.tag == "details" and "open" not in node.attrs:
        return [c for c in node.children if isinstance(c, Node) and c.tag == "summary"][:1]
    return node.children


def _span(cell: Node, name: str, most: int) -> int:
    text = cell.attrs.get(name, "1").strip()
    n = int(text) if re.fullmatch(r"\d{1,9}", text) else 1
    return most if n == 0 and name == "rowspan" else min(max(n, 1), most)


class _Lines:
    """Text lines under construction: collapses white space, keeps at most one blank line."""

    def __init__(self) -> None:
        self.lines: list[str] = []
        self.line = ""
        self.gap = False
        self.blocks = 0

    def add(self, text: str, prefix: str) -> None:
        text = _SPACES.sub(" ", text)
        if not self.line:
            text = text.lstrip(" ")
            if not text:
                return
            self.open(prefix)
        elif self.line.endswith(" "):
            text = text.lstrip(" ")
        self.line += text

    def open(self, prefix: str) -> None:
        if self.gap and self.lines:
            self.lines.append("")
        self.gap = False
        self.blocks += 1
        self.line = prefix

    def end(self, blank: bool = False) -> None:
        if self.line.strip(" "):
            self.lines.append(self.line.rstrip(" "))
        self.line = ""
        self.gap |= blank

    def raw(self, text: str, prefix: str) -> None:
        self.end()
        for part in text.expandtabs(8).split("\n"):
            if part.strip():
                self.open(prefix)
                self.line = prefix + part
                self.end()
            else:
                self.gap |= bool(self.lines)


def _holds_cells(node: Node) -> bool:
    """Whether rows or cells of the table around it lie in a misplaced element."""
    todo = [iter(node.children)]
    while todo:
        for child in todo[-1]:
            if isinstance(child, Node) and shown(child) and child.tag != "table":
                if child.tag in ("tr", "td", "th"):
                    return True
                todo.append(iter(child.children))
                break
        else:
            todo.pop()
    return False


def _rows(table: Node) -> tuple[list[list[Node]], list]:
    """Rows of a table with their shown cells, and its shown content outside of cells; nested tables are left to their cells.

    Elements that may not be there but hold rows or cells, as forms do, are looked through.
    """
    rows, loose, misplaced, todo = [], [], [], [(iter(table.children), None)]
    while todo:
        children, row = todo[-1]
        for child in children:
            if isinstance(child, str):
                misplaced.append(child)
            elif not shown(child):
                continue
            elif child.tag in ("td", "th"):
                (loose if row is None else row).append(child)
            elif child.tag == "tr":
                rows.append([])
                todo.append((iter(child.children), rows[-1]))
                break
            elif child.tag in ("thead", "tbody", "tfoot", "colgroup"):
                todo.append((iter(child.children), None))
                break
            elif child.tag != "table" and _holds_cells(child):
                todo.append((iter(child.children), row))
                break
            else:
                misplaced.append(child)
        else:
            todo.pop()
    return [r for r in [*rows, loose] if r], misplaced


def render(root: Node, depth: int = 0, seen: bool = True) -> tuple[str, int]:
    """(text, number of text blocks) of the shown part of a tree, without recursion but for table cells.

    ``seen`` says whether text is visible where the tree begins.
    """
    out = _Lines()
    # entries: ("open", node or string, prefix, pre, visible), ("close", node)
    todo: list[tuple] = [("open", c, "", False, seen) for c in reversed(root.children)]
    marker: list = []
    while todo:
        entry = todo.pop()
        if entry[0] == "close":
            tag = entry[1].tag
            out.end(tag in SPACED and not (tag in ("ul", "ol") and len(marker) > 1))
            if tag in ("ul", "ol", "menu", "dir"):
                marker.pop()
            continue
        _, item, prefix, pre, seen = entry
        if isinstance(item, str):
            if not seen:
                continue
            if pre:
                out.raw(item, prefix)
            else:
                out.add(item, prefix)
            continue
        tag = item.tag
        if not shown(item):
            continue
        seen = visible(item, seen)
        if tag == "br":
            if not out.line:
                out.gap |= bool(out.lines)
            out.end()
        elif tag == "table" and depth < TABLE_DEPTH:
            out.end(True)
            _table(out, item, prefix, depth, seen)
            out.end(True)
        else:
            block = tag in BLOCK or tag in TABLE_PARTS or tag == "text"  # a text of a drawing has its own place
            if block:
                out.end(tag in SPACED and not (tag in ("ul", "ol") and marker))
                todo.append(("close", item))
            inner = prefix
            if tag in ("ul", "ol", "menu", "dir"):
                start = item.attrs.get("start", "1")
                marker.append([int(start) if re.fullmatch(r"-?\d{1,9}", start) else 1] if tag == "ol" else None)
            elif tag == "li":
                level = "  " * max(0, len(marker) - 1)
                sign = "- "
                if marker and marker[-1] is not None:
                    value = item.attrs.get("value", "").strip()
                    if re.fullmatch(r"-?\d{1,9}", value):
                        marker[-1][0] = int(value)
                    sign = f"{marker[-1][0]}. "
                    marker[-1][0] += 1
                first = [c for c in item.children if not isinstance(c, str) or c.strip()][:1]
                if seen and first and not (isinstance(first[0], Node) and first[0].tag in ("ul", "ol", "table")):
                    out.end()
                    out.open(prefix + level + sign)
            elif tag == "blockquote":
                inner = prefix + "> "
            elif tag == "dd":
                inner = prefix + "  "
            keep = pre or tag in ("pre", "listing", "plaintext")
            todo += [("open", c, inner, keep, seen) for c in reversed(_content(item))]
    out.end()
    return "\n".join(out.lines), out.blocks


def _table(out: _Lines, table: Node, prefix: str, depth: int, seen: bool) -> None:
    """Cells as columns padded to a common width, two spaces apart.

    A cell lies in the first column that no cell above still spans. Columns in which no cell begins take no room.
    """
    rows, misplaced = _rows(table)
    for child in misplaced:  # captions and text that is misplaced in the table come first
        text, _ = render(Node("#part", {}, [child]), depth + 1, seen)
        out.raw(text, prefix)
    grid: list[list[tuple[int, list[str]]]] = []
    width: dict[int, int] = {}
    spanned: list[tuple[int, int, int]] = []  # columns [first, end) taken for so many rows more, by column
    for row in rows:
        cells, col, at, later = [], 0, 0, []
        for c in row:
            while at < len(spanned) and spanned[at][0] <= col:
                col = max(col, spanned[at][1])
                at += 1
            text, _ = render(Node("#cell", {}, c.children), depth + 1, visible(c, seen))
            lines = [x for x in text.split("\n") if x] or [""]
            end, down = col + _span(c, "colspan", MOST_COLUMNS), _span(c, "rowspan", MOST_ROWS)
            cells.append((col, lines))
            width[col] = max(width.get(col, 0), *map(len, lines))
            if down > 1:
                later.append((col, end, down - 1))
            col = end
        grid.append(cells)
        spanned = sorted([(a, b, n - 1) for a, b, n in spanned if n > 1] + later)
    place, at = {}, 0
    for col in sorted(width):
        place[col] = at
        at += width[col] + 2
    for cells in grid:
        for k in range(max(len(lines) for _, lines in cells)):
            line = ""
            for col, lines in cells:
                if k < len(lines) and lines[k]:
                    line = line.ljust(place[col]) + lines[k]
            if line.strip():
                out.raw(line, prefix)


RESULTS: list[tuple[str, T.DataType]] = [("text", T.StringType()), ("n_chars", T.LongType()), ("n_blocks", T.LongType())]


def extract_text(pages: DataFrame, html: str = "html") -> DataFrame:
    """``pages`` with the shown ``text``, its length and its number of text blocks.

    One row in, one row out, no shuffle. A null or empty page gives an empty
    text; anything that is not well-formed still gives a text, at any depth.
    Visibility follows element names, ``hidden``, closed ``details`` and ``dialog``,
    inline styles and simple selectors of the page's own style sheets. Input columns
    named like an added one are replaced.
    """

    def per_batch(batch: pa.RecordBatch) -> dict[str, object]:
        rows = [render(build_tree(h.as_py() or "")) for h in batch.column(batch.schema.get_field_index(html))]
        return {
            "text": pa.array([t for t, _ in rows], pa.string()),
            "n_chars": pa.array([len(t) for t, _ in rows], pa.int64()),
            "n_blocks": pa.array([n for _, n in rows], pa.int64()),
        }

    return with_results(pages, RESULTS, per_batch)
