"""Visible text of web pages, laid out as it would be read.

A tokeniser cuts the page in one pass: what a tag, comment or raw text does not
close reaches to the end of the page, as in browsers, so no part is looked
through twice. A tree builder applies the implied tags: an open paragraph ends before a block, list items, options,
table rows and cells end before their next, the head before what may not stand
in it; a cell or row that starts directly in a table or table section gets its
row and section; end tags close what they find open within their table cell or
list, and are ignored otherwise. Whatever is open at the end of the page is
closed. SVG and MathML keep their own rules: a slash closes their elements, and
an HTML element that may not stand in them ends them. Elements that are never
shown, and those hidden by attribute or inline style, are skipped with all they
hold.

The renderer collapses white space outside of preformatted text, puts blocks on
lines of their own with a blank line around paragraphs and headings, marks list
items with bullets or numbers, indents nested lists, and sets the cells of a
table in aligned columns, those under a cell of several rows moved to its right.
The text of every visible node is emitted, that of SVG, formulas and all options
of a select too. A cell spans 1,000 columns and 65,534 rows at most, as in HTML.

Null or empty pages give an empty text. Elements nest at most ``DEEPEST`` deep;
deeper ones are laid out as children of the one at that depth.
"""

import re
from collections.abc import Iterator
from dataclasses import dataclass, field
from html import unescape

from pyspark.sql import DataFrame

from broadsheet.llm.common import map_rows

DEEPEST = 200

# Elements by how they are shown.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
NEVER = frozenset(
    "head title script style noscript template iframe object audio video canvas datalist".split()
)
#: in SVG and MathML, besides these
NEVER_WITHIN = {"svg": frozenset("desc metadata".split()), "math": frozenset("annotation annotation-xml mphantom".split())}
#: parts of SVG and MathML in which the rules of HTML hold
HTML_WITHIN = {"svg": frozenset("foreignobject desc title".split()), "math": frozenset("mi mo mn ms mtext".split())}
#: elements of HTML that end SVG and MathML
ENDS_FOREIGN = frozenset(
    "b big blockquote body br center code dd div dl dt em embed h1 h2 h3 h4 h5 h6 head hr i img li listing menu meta nobr"
    " ol p pre ruby s small span strong strike sub sup table tt u ul var".split()
)
BLOCKS = frozenset(
    "address article aside blockquote body center dd details dialog div dl dt fieldset figcaption figure footer form"
    " h1 h2 h3 h4 h5 h6 header hr html legend li main menu nav ol p pre section summary table ul caption".split()
)
SPACED = frozenset("p h1 h2 h3 h4 h5 h6 blockquote pre table ul ol dl figure".split())
#: inline elements with space around them
APART = frozenset("select option optgroup mtr mtd".split())
TABLE_PARTS = frozenset("tr td th thead tbody tfoot caption colgroup".split())
#: what may stand in a head
IN_HEAD = frozenset("base link meta title style script noscript template noframes".split())
#: an open element ends before one of these begins
ENDS_BEFORE = {
    "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "option": {"option", "optgroup"}, "optgroup": {"optgroup"},
    "td": {"td", "th", "tr", "thead", "tbody", "tfoot"}, "th": {"td", "th", "tr", "thead", "tbody", "tfoot"},
    "tr": {"tr", "thead", "tbody", "tfoot"}, "thead": {"tbody", "tfoot"}, "tbody": {"tbody", "tfoot"},
    "tfoot": {"tbody"}, "caption": {"tr", "thead", "tbody", "tfoot", "td", "th"},
    "colgroup": {"tr", "thead", "tbody", "tfoot", "td", "th"},
    "rt": {"rt", "rp"}, "rp": {"rt", "rp"}, "head": {"body"},
    **{h: {"h1", "h2", "h3", "h4", "h5", "h6"} for h in ("h1", "h2", "h3", "h4", "h5", "h6")},
}
#: an end of an element is not sought beyond these
SCOPES = frozenset("html table td th caption".split())

#: elements whose content is text, without tags; in the second kind with character references
RAW = frozenset("script style xmp iframe noembed noframes plaintext".split())
RAW_WITH_REFERENCES = frozenset("title textarea".split())

_SPACE = re.compile(r"[ \t\n\r\f]+")
_NAME = re.compile(r"[^\s/>]+")
_ATTRIBUTE = re.compile(r"""[\s/]*(=?[^\s/>=]+|=)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>"'][^\s>]*)|(["'])|))?""")
_TAG_END = re.compile(r"[\s/]*>")
_RAW_END = {name: re.compile(rf"</{name}(?=[\s/>])", re.I) for name in RAW | RAW_WITH_REFERENCES}
_MOST_COLUMNS, _MOST_ROWS = 1000, 65534
_HIDDEN = re.compile(r"(?:^|;)\s*(?:display\s*:\s*none|visibility\s*:\s*(?:hidden|collapse))\b", re.I)


@dataclass(slots=True)
class Node:
    tag: str
    attrs: dict[str, str | None] = field(default_factory=dict)
    children: list["Node | str"] = field(default_factory=list)
    within: str = ""  # svg or math, for these and their elements

    def shown(self) -> bool:
        if self.tag in NEVER or self.tag in NEVER_WITHIN.get(self.within, ()):
            return False
        if self.within == "svg" and (self.attrs.get("display") == "none" or self.attrs.get("visibility") in ("hidden", "collapse")):
            return False
        if self.tag == "dialog" and "open" not in self.attrs:
            return False
        return "hidden" not in self.attrs and not _HIDDEN.search(self.attrs.get("style") or "")


class Tokeniser:
    """Calls ``handle_starttag``, ``handle_startendtag``, ``handle_endtag`` and ``handle_data``.

    Works from the start of the page to its end; every search either moves on
    behind what it found or ends the page.
    """

    def feed(self, page: str) -> None:
        at = 0
        while at < len(page):
            start = page.find("<", at)
            if start < 0:
                start = len(page)
            after = page[start + 1 : start + 2]
            if start < len(page) and not (after in "!?/" and after or after.isascii() and after.isalpha()):
                start = self._literal(page, start)  # a sign like any other
            if start > at:
                self.handle_data(unescape(page[at:start]))
                at = start
                continue
            at = self._tag(page, at, after)

    def _literal(self, page: str, start: int) -> int:
        found = _NEXT_TAG.search(page, start)
        return found.start() if found else len(page)

    def _tag(self, page: str, at: int, after: str) -> int:
        """Take what starts at a ``<``; where it ends."""
        if page.startswith("<!--", at):
            if close := _EMPTY_COMMENT.match(page, at):
                return close.end()
            return self._behind(page, "-->", at + 4)
        if page.startswith("<![CDATA[", at) and self.in_foreign():
            end = page.find("]]>", at)
            self.handle_data(page[at + 9 : end if end >= 0 else len(page)])
            return end + 3 if end >= 0 else len(page)
        if after in "!?":
            return self._behind(page, ">", at)
        closing = after == "/"
        name = _NAME.match(page, at + 1 + closing)
        if not name or not (name[0][0].isascii() and name[0][0].isalpha()):
            return self._behind(page, ">", at)  # </ without a name
        tag, attrs, end = name[0].lower(), [], name.end()
        while not (close := _TAG_END.match(page, end)):
            found = _ATTRIBUTE.match(page, end)
            if not found or found[5]:
                return len(page)  # a tag or quote without an end takes the rest
            value = next((v for v in found.group(2, 3, 4) if v is not None), None if "=" not in found[0][len(found[1]) :] else "")
            attrs.append((found[1].lower(), value and unescape(value)))
            end = found.end()
        end = close.end()
        if closing:
            self.handle_endtag(tag)
        elif page[end - 2] == "/" and "/" in close[0]:
            self.handle_startendtag(tag, attrs)
        else:
            self.handle_starttag(tag, attrs)
        raw = not closing and not self.in_foreign() and (tag in RAW or tag in RAW_WITH_REFERENCES)
        if raw:
            found = None if tag == "plaintext" else _RAW_END[tag].search(page, end)
            stop = found.start() if found else len(page)
            if stop > end:
                text = page[end:stop]
                self.handle_data(unescape(text) if tag in RAW_WITH_REFERENCES else text)
            return stop
        return end

    @staticmethod
    def _behind(page: str, mark: str, at: int) -> int:
        end = page.find(mark, at)
        return end + len(mark) if end >= 0 else len(page)


_NEXT_TAG = re.compile(r"<(?=[a-zA-Z!?/])")
_EMPTY_COMMENT = re.compile(r"<!---?>")


class TreeBuilder(Tokeniser):
    """Builds a tree of nodes, with implied tags."""

    def __init__(self):
        self.root = Node("html")
        self.open = [self.root]

    def in_foreign(self) -> bool:
        return bool(self.open[-1].within)

    def handle_starttag(self, tag, attrs):
        if tag == "html":
            for name, value in attrs:
                self.root.attrs.setdefault(name, value)
            return
        if within := self._foreign(tag, attrs):
            return self._put(Node(tag, dict(attrs), within=within), True)
        if tag in BLOCKS or tag in TABLE_PARTS:
            self._end("p", BLOCKS - {"p"})
        if self.open[-1].tag == "head" and tag not in IN_HEAD:
            self.open.pop()
        self._imply(tag)
        if tag in ("tr", "td", "th"):
            self._imply_rows(tag)
        self._put(Node(tag, dict(attrs), within=tag if tag in ("svg", "math") else ""), tag not in VOID)

    def _foreign(self, tag: str, attrs: list[tuple[str, str | None]]) -> str:
        """svg or math, if ``tag`` is an element of it here; ends what ``tag`` may not stand in."""
        ends = tag in ENDS_FOREIGN or (tag == "font" and any(name in ("color", "face", "size") for name, _ in attrs))
        while within := self.open[-1].within:
            holder = self.open[-1]
            if holder.tag in HTML_WITHIN[within] and tag not in ("mglyph", "malignmark"):
                return ""
            if holder.tag == "annotation-xml" and (tag == "svg" or "html" in (holder.attrs.get("encoding") or "").lower()):
                return ""
            if not ends:
                return within
            self.open.pop()
        return ""

    def _put(self, node: Node, left_open: bool) -> None:
        while len(self.open) >= DEEPEST:
            self.open.pop()
        self.open[-1].children.append(node)
        if left_open:
            self.open.append(node)

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if (node := self.open[-1]).within and node.tag == tag:  # the slash means nothing in HTML
            self.open.pop()

    def handle_endtag(self, tag):
        if tag == "br":
            self.handle_starttag("br", [])
        elif tag in ("html", "body") or tag in VOID:
            return
        elif tag == "p":
            if not self._end("p", SCOPES):
                self.open[-1].children.append(Node("p"))
        elif tag == "table" or tag in TABLE_PARTS:
            self._end(tag, {"html", "table"} - {tag})
        else:
            self._end(tag, SCOPES)

    def handle_data(self, data):
        if self.open[-1].tag == "head" and data.strip():
            self.open.pop()
        self.open[-1].children.append(data)

    def _end(self, tag: str, scopes: frozenset[str] | set[str]) -> bool:
        """Close the innermost open ``tag`` that no scope stands before."""
        for at in range(len(self.open) - 1, 0, -1):
            if self.open[at].tag == tag:
                del self.open[at:]
                return True
            if self.open[at].tag in scopes:
                return False
        return False

    def _imply(self, tag: str) -> None:
        """Close what ends before ``tag``, within its list or table."""
        for at in range(len(self.open) - 1, 0, -1):
            name = self.open[at].tag
            if tag in ENDS_BEFORE.get(name, ()):
                del self.open[at:]
                return self._imply(tag)
            if name in ("table", "ul", "ol", "dl", "menu", "select", "template") or (name in SCOPES and tag not in TABLE_PARTS):
                return None
        return None

    def _imply_rows(self, tag: str) -> None:
        """The section and row of a cell or row that starts in a table without them."""
        for at in range(len(self.open) - 1, 0, -1):
            name = self.open[at].tag
            if name in ("td", "th", "caption", "template"):
                return
            if name in ("table", "thead", "tbody", "tfoot", "tr"):
                del self.open[at + 1 :]  # what stands outside of cells ends before them
                if name == "table":
                    self._put(Node("tbody"), True)
                if name != "tr" and tag != "tr":
                    self._put(Node("tr"), True)
                return


def parsed(page: str) -> Node:
    builder = TreeBuilder()
    builder.feed(page)
    return builder.root


class Layout:
    """Lines of text, with pending white space and blank lines."""

    def __init__(self):
        self.lines: list[str] = []
        self.line = ""
        self.space = False  # collapsed white space before the next word
        self.blank = False  # a blank line before the next text
        self.indent = ""
        self.mark = ""  # of a list item, before its first text

    def text(self, words: str) -> None:
        """Inline text; white space collapses."""
        if words[:1] and words[0] in " \t\n\r\f":
            self.space = True
        body = _SPACE.sub(" ", words).strip(" ")
        if not body:
            return
        self._begin()
        self.line += (" " if self.space and self._filled() else "") + body
        self.space = words[-1] in " \t\n\r\f"

    def _filled(self) -> bool:
        return self.line.strip() not in ("", self._own_mark.strip()) if self.line else False

    _own_mark = ""

    def _begin(self) -> None:
        """The start of a line: blank line, indent and list mark before it."""
        if self.line:
            return
        if self.blank and self.lines and self.lines[-1]:
            self.lines.append("")
        self.blank = False
        self._own_mark = self.mark
        self.line = self.indent[: len(self.indent) - len(self.mark)] + self.mark
        self.mark = ""

    def end(self) -> None:
        """The end of a line."""
        if self.line:
            self.lines.append(self.line.rstrip())
        self.line, self.space, self._own_mark = "", False, ""

    def apart(self) -> None:
        """A blank line before what comes next."""
        self.end()
        self.blank = True

    def kept(self, text: str) -> None:
        """Preformatted text."""
        for nth, line in enumerate(text.replace("\r\n", "\n").split("\n")):
            if nth:
                if self.line:
                    self.end()
                elif self.lines:
                    self.lines.append("")
            if line:
                self._begin()
                self.line += line

    def done(self) -> str:
        self.end()
        return "\n".join(self.lines).strip("\n")


def render(node: Node, out: Layout, pre: bool = False) -> None:
    if isinstance(node, str):
        return out.kept(node) if pre else out.text(node)
    if not node.shown():
        return None
    tag = node.tag
    if tag == "br":
        if not out.line:
            out._begin()
        out.end()
        return None
    if tag == "table":
        return render_table(node, out)
    if tag in ("ul", "ol", "menu"):
        return render_list(node, out)
    if tag == "img":
        return out.text(node.attrs.get("alt") or "")
    if tag == "hr":
        return out.apart()
    if tag in ("textarea", "pre"):
        pre = True
    apart = tag in APART or (node.within == "svg" and tag == "text")
    if apart:
        out.space = True
    if tag == "optgroup" or (tag == "option" and not any(c.strip() for c in node.children if isinstance(c, str))):
        out.text(node.attrs.get("label") or "")
        out.space = True
    block = tag in BLOCKS
    if block:
        out.apart() if tag in SPACED else out.end()
    outer = out.indent
    if tag in ("blockquote", "dd"):
        out.indent += "  "
    if tag == "q":
        out.text('"')
        out.space = False
    for child in node.children:
        render(child, out, pre)
    if tag == "q":
        out.space = False
        out.text('"')
    if apart:
        out.space = True
    if block:
        out.end()
        out.indent = outer
        if tag in SPACED:
            out.blank = True
    return None


def render_list(node: Node, out: Layout) -> None:
    """Items with bullets or numbers; a list within an item is indented by its mark."""
    inner = bool(out.indent) or bool(out.mark)
    out.end()
    if not inner:
        out.blank = True
    outer, number = out.indent, _whole(node.attrs.get("start"), 1)
    for child in node.children:
        if isinstance(child, Node) and child.tag == "li" and child.shown():
            out.end()
            number = _whole(child.attrs.get("value"), number)
            mark = f"{number}. " if node.tag == "ol" else "- "
            out.mark += mark  # of the outer item too, if it has no text yet
            out.indent = outer + " " * len(mark)
            number += 1
            for part in child.children:
                render(part, out)
            out.end()
            out.mark = ""
            out.indent = outer
        else:
            render(child, out)
    out.end()
    out.indent = outer
    if not inner:
        out.blank = True


def _whole(value: str | None, default: int) -> int:
    return int(value) if value and re.fullmatch(r"-?[0-9]{1,9}", value.strip()) else default


def table_rows(node: Node) -> Iterator[tuple[Node, Node]]:
    """The sections and rows of a table, not those of tables within it."""
    for child in node.children:
        if isinstance(child, Node) and child.shown():
            if child.tag == "tr":
                yield node, child
            elif child.tag in ("thead", "tbody", "tfoot"):
                yield from table_rows(child)


def render_table(node: Node, out: Layout) -> None:
    """Cells in aligned columns; the lines of a cell stay in its column.

    A cell over several columns or rows takes its first ones, the others are
    empty; a section ends the cells that reach down in it.
    Anything else within the table comes before it, as browsers show it.
    """
    out.apart()
    _outside_cells(node, out)
    grid: list[list[list[str]]] = []
    held: dict[int, int] = {}  # columns taken from above, and for how many rows yet
    section = None
    for part, row in table_rows(node):
        if part is not section:
            section, held = part, {}
        cells: list[list[str]] = []
        left = {c: n - 1 for c, n in held.items() if n > 1}
        for cell in row.children:
            if isinstance(cell, Node) and cell.tag in ("td", "th") and cell.shown():
                while len(cells) in held:
                    cells.append([])
                inner = Layout()
                for child in cell.children:
                    render(child, inner)
                text = inner.done()
                cells.append(text.split("\n") if text else [])
                wide = max(1, min(_whole(cell.attrs.get("colspan"), 1), _MOST_COLUMNS))
                down = _whole(cell.attrs.get("rowspan"), 1)
                down = _MOST_ROWS if down == 0 else min(down, _MOST_ROWS)  # 0: to the section's end
                if down > 1:
                    left |= {c: down - 1 for c in range(len(cells) - 1, len(cells) - 1 + wide)}
                cells += [[]] * (wide - 1)
        held = left
        if any(cells):
            grid.append(cells)
    columns = max(map(len, grid), default=0)
    widths = [max((len(line) for row in grid if c < len(row) for line in row[c]), default=0) for c in range(columns)]
    used = [c for c in range(columns) if widths[c]]
    for row in grid:
        for at in range(max(map(len, row))):
            parts = [(row[c][at] if c < len(row) and at < len(row[c]) else "").ljust(widths[c]) for c in used]
            out._begin()
            out.line += "  ".join(parts)
            out.end()
    out.blank = True


def _outside_cells(node: Node, out: Layout) -> None:
    for child in node.children:
        if isinstance(child, str):
            if child.strip():
                render(child, out)
        elif not child.shown():
            continue
        elif child.tag in ("thead", "tbody", "tfoot", "tr"):
            _outside_cells(child, out)
        elif child.tag not in ("td", "th") or node.tag != "tr":  # at the greatest depth, cells have no row
            render(child, out)
    out.end()


def page_text(page: str | None) -> str:
    if not page:
        return ""
    out = Layout()
    render(parsed(page), out)
    return out.done()


def page_title(root: Node) -> str:
    """The page's title, with white space collapsed."""
    todo = [root]
    while todo:
        node = todo.pop()
        if node.tag == "title":
            return _SPACE.sub(" ", "".join(c for c in node.children if isinstance(c, str))).strip()
        todo += [c for c in reversed(node.children) if isinstance(c, Node)]
    return ""


def extracted(pages: DataFrame) -> DataFrame:
    """page_id, url, title and visible text of every page."""

    def row(page_id, url, html):
        root = parsed(html or "")
        out = Layout()
        render(root, out)
        yield page_id, url, page_title(root), out.done()

    return map_rows(pages.select("page_id", "url", "html"), "page_id long, url string, title string, text string", row)
