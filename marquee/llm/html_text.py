"""Visible text of HTML pages, laid out in lines.

A tree builder reads tags in order, with implied ends (a block ends an open paragraph, an item the
item before, a cell the cell before ...) and void elements. Visibility: content of head, scripts,
styles and templates is not shown, nor elements with ``hidden``, with ``display: none`` or
``visibility: hidden`` in their style, or named by such a rule (tag, .class or #id) of the page's
style sheets; a later rule of the same selector that shows them again holds, and rules under a
condition (``@media print``, a width ...) do not, other than ``@media screen`` and ``all``. An open
head ends at the first text or tag that does not belong in it. The renderer keeps paragraphs apart by a blank line and other blocks by a line break,
marks and indents list items, keeps preformatted text, and aligns the cells of tables.

Cases: null HTML gives null text; empty or text-only HTML gives its text; unclosed and unopened tags,
broken attributes and entities are taken as browsers roughly do; elements nested deeper than
``DEPTH`` become siblings with their own visibility, no text is lost; very long pages are rendered whole; an empty table gives
no rows; repeated rows are alike; extra columns are ignored.
"""

from __future__ import annotations

import html
import re
from collections import Counter
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marquee.llm.common import spread

DEPTH = 120

# Kinds of elements.
VOID = set("area base br col embed hr img input link meta source track wbr".split())
HIDDEN = set("head script style template noscript title datalist iframe object svg math audio video canvas".split())
RAW = set("script style textarea title iframe noscript".split())
BLOCK = set(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset "
    "figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol "
    "option p pre search section summary table tbody td tfoot th thead tr ul".split()
)
SPACED = set("blockquote dl fieldset figure h1 h2 h3 h4 h5 h6 hr ol p pre table ul".split())
INLINE_FORMAT = set("a b big code em font i s small span strike strong tt u".split())
# an opening tag: (open elements it ends, elements that such an end does not reach beyond)
ENDS = {
    "li": ({"li"}, {"ul", "ol", "menu", "dir"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th", "caption"}, {"table"}),
    "td": ({"td", "th"}, {"table", "tr"}),
    "th": ({"td", "th"}, {"table", "tr"}),
    "tbody": ({"tbody", "thead", "tfoot", "tr", "td", "th", "caption"}, {"table"}),
    "thead": ({"tbody", "thead", "tfoot", "tr", "td", "th", "caption"}, {"table"}),
    "tfoot": ({"tbody", "thead", "tfoot", "tr", "td", "th", "caption"}, {"table"}),
    "option": ({"option"}, {"select"}),
}
SCOPE = {"table", "td", "th", "caption", "html"}  # an open paragraph is not sought beyond

MARKUP = re.compile(r"<!--.*?(?:-->|\Z)|<([!?])|<(/?)([a-zA-Z][^\s/>]*)", re.S)
TAG_SIGN = re.compile(r"[\"'>]")
ATTRIBUTE = re.compile(r"([^\s=/\"'>]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
NOT_SHOWN = re.compile(r"display\s*:\s*none|visibility\s*:\s*(?:hidden|collapse)", re.I)
SHOWN = re.compile(r"(display|visibility)\s*:\s*([a-z-]+)(\s*!\s*important)?", re.I)
CSS = re.compile(r"\"(?:[^\"\\]|\\.)*\"|'(?:[^'\\]|\\.)*'|[{};]", re.S)
COMMENT = re.compile(r"/\*.*?(?:\*/|\Z)", re.S)
ALWAYS = re.compile(r"@media\s+(?:only\s+)?(?:screen|all)\s*\Z|@layer\b|@(?:media|supports)\s*\Z", re.I)
IN_HEAD = set("base basefont bgsound link meta noscript script style template title".split())
SPACES = re.compile(r"[ \t\n\r\f]+")


def rules(sheet: str) -> Iterator[tuple[str, str]]:
    """(selectors, declarations) that hold on a screen of any size, in order."""
    sheet = COMMENT.sub(" ", sheet).replace("<!--", " ").replace("-->", " ")
    holds = [True]  # per open block of rules
    start, head = 0, None
    for mark in CSS.finditer(sheet):
        sign = mark.group()
        if sign == "{":
            head = sheet[start : mark.start()].strip()
            if head.startswith("@"):
                holds.append(holds[-1] and bool(ALWAYS.match(head)))
                head = None
            start = mark.end()
        elif sign == "}":
            if head is not None:
                if holds[-1]:
                    yield head, sheet[start : mark.start()]
                head = None
            elif len(holds) > 1:
                holds.pop()
            start = mark.end()
        elif sign == ";" and head is None:  # ends @import and the like
            start = mark.end()
    if head is not None and holds[-1]:  # a sheet may end in an open rule
        yield head, sheet[start:]


def heed(sheet: str, declared: dict[str, dict[str, tuple[bool, bool]]]) -> None:
    """Note per selector and property whether it hides and whether it is important; later ones win."""
    for selectors, body in rules(sheet):
        for name, value, important in SHOWN.findall(body):
            hides = value.lower() in ("none", "hidden", "collapse")
            for selector in selectors.split(","):
                of = declared.setdefault(selector.strip(), {})
                if important or not of.get(name.lower(), (False, False))[1]:
                    of[name.lower()] = (hides, bool(important))


class Tags:
    """Ends of tags, in one pass over a page however it is broken.

    A quoted value may hold the sign that ends a tag. Where the quotes of a page leave a tag without
    an end, they are not heeded from there on; where no such sign is left, no tag is.
    """

    def __init__(self, page: str):
        self.page = page
        self.quoted = True

    def end(self, at: int) -> int:
        """The place of the sign that ends the tag whose name ends at ``at``, -1 if there is none."""
        first = at
        while self.quoted:
            sign = TAG_SIGN.search(self.page, at)
            if sign is None:
                self.quoted = False
            elif sign.group() == ">":
                return sign.start()
            else:
                closing = self.page.find(sign.group(), sign.end())
                if closing < 0:
                    self.quoted = False
                at = closing + 1
        return self.page.find(">", first)


class Node:
    __slots__ = ("tag", "attributes", "children", "shown")

    def __init__(self, tag: str, attributes: dict[str, str], shown: bool = True):
        self.tag, self.attributes, self.children, self.shown = tag, attributes, [], shown


def build(page: str) -> Node:
    """The tree of a page; children are nodes and strings (entities resolved)."""
    root = Node("html", {})
    stack = [root]
    declared: dict[str, dict[str, tuple[bool, bool]]] = {}
    at = 0
    opened: Counter[str] = Counter()  # open elements by tag, so that none is sought in vain
    cover: int | None = None  # the first hidden element of the stack beyond DEPTH

    def close(index: int) -> None:
        nonlocal cover
        opened.subtract(node.tag for node in stack[index:])
        del stack[index:]
        if cover is not None and index <= cover:
            cover = None

    def close_head() -> None:
        if opened["head"]:
            close(next(i for i, node in enumerate(stack) if node.tag == "head"))

    def add(child: Node | str) -> None:
        # what lies in a hidden element beyond DEPTH goes into that element, all else beside it
        at = min(len(stack), DEPTH) - 1 if cover is None else cover
        stack[at].children.append(child)

    def text(value: str) -> None:
        if value:
            if stack[-1].tag == "head" and value.strip():
                close_head()
            add(html.unescape(value) if "&" in value else value)

    tags = Tags(page)
    while True:
        match = MARKUP.search(page, at)
        sign, ending, name = match.groups() if match else (None, None, None)
        end = -1
        if sign:
            end = page.find(">", match.end())
        elif name:
            end = tags.end(match.end())
        if not match or (sign or name) and end < 0:
            text(page[at:])
            return root
        text(page[at : match.start()])
        if name is None:
            at = end + 1 if sign else match.end()
            continue
        at, rest = end + 1, page[match.end() : end]
        tag = name.lower()
        if ending:
            for index in range(len(stack) - 1, 0, -1) if opened[tag] else ():
                if stack[index].tag == tag:
                    close(index)
                    break
                if stack[index].tag in ("table", "td", "th") and tag not in ("table", "tr", "tbody", "thead", "tfoot", "body", "html"):
                    break  # an end inside a cell closes nothing outside it
            continue
        if tag in ("html", "body"):
            close_head()
            continue
        if tag not in IN_HEAD and tag != "head" and stack[-1].tag == "head":
            close_head()
        attributes = {
            key.lower(): html.unescape(a or b or c)
            for key, a, b, c in (ATTRIBUTE.findall(rest) if rest.strip("/ \n") else ())
        }
        if tag in RAW:
            end = re.compile(rf"</{tag}\s*/?>", re.I).search(page, at)
            stop, after = (end.start(), end.end()) if end else (len(page), len(page))
            if tag == "style":
                if ALWAYS.match(f"@media {attributes.get('media', '')}".strip()):
                    heed(page[at:stop], declared)
            elif tag == "textarea":
                if stack[-1].tag == "head":
                    close_head()
                node = Node(tag, attributes)
                node.children.append(html.unescape(page[at:stop]))
                add(node)
            at = after
            continue
        if tag in BLOCK:
            if tag not in ("head",):
                close_head()
            for index in range(len(stack) - 1, 0, -1) if opened["p"] else ():  # a block ends an open paragraph
                if stack[index].tag == "p":
                    close(index)
                    break
                if stack[index].tag in SCOPE:
                    break
        if tag in ENDS:
            ended, barrier = ENDS[tag]
            lowest = None
            for index in range(len(stack) - 1, 0, -1) if any(opened[t] for t in ended) else ():
                if stack[index].tag in ended:
                    lowest = index
                elif stack[index].tag in barrier:
                    break
            if lowest:
                close(lowest)
        shown = not (
            "hidden" in attributes
            or NOT_SHOWN.search(attributes.get("style", ""))
            or tag == "input" and attributes.get("type", "").lower() == "hidden"
        )
        node = Node(tag, attributes, shown)
        if declared and shown:
            # tags, classes and ids in rising order of weight, each property for itself
            names = [tag, *(k for k in declared if k[:1] == "." and k[1:] in attributes.get("class", "").split())]
            if "id" in attributes:
                names.append(f"#{attributes['id']}")
            said: dict[str, tuple[bool, bool]] = {}
            for of in (declared[n] for n in names if n in declared):
                for name, (hides, important) in of.items():
                    if important or not said.get(name, (False, False))[1]:
                        said[name] = (hides, important)
            node.shown = not any(hides for hides, _ in said.values())
        add(node)
        if tag not in VOID and not rest.rstrip().endswith("/") or tag in BLOCK and tag != "hr":
            stack.append(node)
            opened[tag] += 1
            if cover is None and len(stack) > DEPTH and (not node.shown or tag in HIDDEN):
                cover = len(stack) - 1


class Lines:
    """Lines written so far, the line being written, and how much space is due before it."""

    def __init__(self) -> None:
        self.done: list[str] = []
        self.line = ""
        self.due = 0
        self.indent: list[str] = []
        self.mark = ""

    def word(self, value: str) -> None:
        value = SPACES.sub(" ", value)
        if not self.line or self.line[-1] == " ":
            value = value.lstrip(" ")
        self.line += value

    def end_line(self, force: bool = False) -> None:
        line = self.line.rstrip(" ")
        if line or force:
            if self.done and self.due:
                self.done += [""] * self.due
            self.due = 0
            self.done.append("".join(self.indent) + self.mark + line)
            if self.mark:
                self.mark = " " * len(self.mark)
        self.line = ""

    def space(self, blank: int) -> None:
        self.end_line()
        self.due = max(self.due, blank)

    def raw(self, lines: list[str]) -> None:
        for line in lines:
            self.line = line
            self.end_line(force=True)


def render(node: Node, out: Lines, depth: int = 0) -> None:
    if not node.shown or node.tag in HIDDEN:
        return
    tag = node.tag
    if tag == "br":
        out.end_line(force=True)
        return
    if tag == "input":
        kind = node.attributes.get("type", "text").lower()
        if kind not in ("checkbox", "radio", "file", "password", "image"):
            out.word(node.attributes.get("value", ""))
        return
    blank = 1 if tag in SPACED and not (tag in ("ul", "ol") and depth) else 0
    block = tag in BLOCK
    if block:
        out.space(blank)
    if tag == "table":
        out.raw(table_lines(node))
    elif tag == "pre":
        inner = Lines()
        text = "".join(_texts(node)).strip("\n")
        inner.raw(text.split("\n") if text else [])
        out.raw(inner.done)
    elif tag in ("ul", "ol", "menu", "dir"):
        number = _integer(node.attributes.get("start"), 1)
        for child in node.children:
            if isinstance(child, Node) and child.tag == "li" and child.shown:
                out.end_line()
                mark = out.mark
                if mark.strip():  # a list that opens an item of another
                    out.end_line(force=True)
                    mark = out.mark
                out.indent.append(mark)
                out.mark = f"{number}. " if tag == "ol" else "- "
                number += 1
                for inner in child.children:
                    _render_child(inner, out, depth + 1)
                out.end_line()
                out.due = 0
                out.mark = out.indent.pop()
            else:
                _render_child(child, out, depth)
    else:
        for child in node.children:
            _render_child(child, out, depth)
    if block:
        out.space(blank)


def _render_child(child: Node | str, out: Lines, depth: int) -> None:
    if isinstance(child, str):
        out.word(child)
    else:
        render(child, out, depth)


def _integer(value: str | None, default: int) -> int:
    return int(value) if value and re.fullmatch(r"-?[0-9]{1,9}", value.strip()) else default


def _texts(node: Node) -> Iterator[str]:
    for child in node.children:
        if isinstance(child, str):
            yield child
        elif child.tag == "br":
            yield "\n"
        elif child.shown and child.tag not in HIDDEN:
            yield from _texts(child)


def table_lines(table: Node) -> list[str]:
    """Caption, then one line per row, the cells of a column as wide as its widest."""
    captions: list[str] = []
    rows: list[list[tuple[str, int]]] = []
    loose: list[Node | str] = []

    def visit(node: Node) -> None:
        for child in node.children:
            if isinstance(child, str) or child.tag not in ("tr", "tbody", "thead", "tfoot", "caption", "td", "th", "colgroup"):
                if not isinstance(child, str) or child.strip():
                    loose.append(child)
            elif not child.shown:
                continue
            elif child.tag == "tr":
                cells = []
                for cell in child.children:
                    if isinstance(cell, Node) and cell.tag in ("td", "th"):
                        if cell.shown:
                            span = min(max(_integer(cell.attributes.get("colspan"), 1), 1), 50)
                            cells.append((_flat(cell), span))
                    elif not isinstance(cell, str) or cell.strip():
                        loose.append(cell)
                rows.append(cells)
            elif child.tag == "caption":
                captions.append(_flat(child))
            elif child.tag in ("td", "th"):
                rows.append([(_flat(child), 1)])
            else:
                visit(child)

    visit(table)
    widths: list[int] = []
    for cells in rows:
        column = 0
        for text, span in cells:
            widths += [0] * (column + span - len(widths))
            if span == 1:
                widths[column] = max(widths[column], len(text))
            column += span
    lines = [c for c in captions if c]
    for part in loose:  # content outside of cells is shown before the table
        out = Lines()
        _render_child(part, out, 1)
        out.end_line()
        lines += out.done
    for cells in rows:
        line, column = [], 0
        for text, span in cells:
            width = sum(widths[column : column + span]) + 3 * (span - 1)
            line.append(text.ljust(width))
            column += span
        if any(text for text, _ in cells):
            lines.append(" | ".join(line).rstrip())
    return lines


def _flat(cell: Node) -> str:
    out = Lines()
    for child in cell.children:
        _render_child(child, out, 1)
    out.end_line()
    return " ".join(x.strip() for x in out.done if x.strip())


def visible_text(page: str) -> str:
    out = Lines()
    render(build(page), out)
    out.end_line()
    lines = out.done
    while lines and not lines[-1].strip():
        lines.pop()
    return "\n".join(lines).lstrip("\n")


def extracted(pages: DataFrame) -> DataFrame:
    """(page_id, url, text, n_chars, n_lines) of every page."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            texts = [None if page is None else visible_text(page) for page in batch["html"]]
            yield pd.DataFrame({"id": batch["id"], "url": batch["url"], "text": texts})

    rows = spread(pages.select(F.col("page_id").cast("string").alias("id"), "url", "html"))
    out = rows.mapInPandas(run, "id string, url string, text string")
    return out.select(
        F.col("id").cast(pages.schema["page_id"].dataType).alias("page_id"),
        "url",
        "text",
        F.length("text").cast("long").alias("n_chars"),
        F.when(F.col("text") == "", 0).otherwise(F.size(F.split("text", "\n"))).cast("long").alias("n_lines"),
    )
