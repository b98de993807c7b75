"""A small helper for Python workers: elements of a page picked by simple selectors.

Selectors: tag, #id, .class, [attr], [attr=value], descendant and child steps, comma lists.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from functools import lru_cache
from html import unescape
from html.parser import HTMLParser

VOID = frozenset(
    "area base br col embed hr img input keygen link menuitem meta param source track wbr "
    "basefont bgsound command frame image isindex nextid spacer".split()
)
HIDDEN_TEXT = frozenset(["script", "style", "template", "rt", "rp"])

_STEP = re.compile(
    r"\s*(>?)\s*((?:[\w*|-]+)?(?:[#.][\w-]+|\[[^\]]*\])*)", re.UNICODE
)
_SIMPLE = re.compile(
    r"([#.])([\w-]+)|\[\s*([\w:-]+)\s*(?:([\^$*~]?=)\s*(\"[^\"]*\"|'[^']*'|[^\]\"'=]*?))?\s*\]"
)

# Markup that can be read only one way, token by token; a page with any other goes to the parser.
_GAP = r"[ \t\n\r\f]"
_TOKEN = re.compile(
    r"([^<]+)"
    rf"|</([a-zA-Z][-a-zA-Z0-9]*){_GAP}*>"
    rf"|<([a-zA-Z][-a-zA-Z0-9]*)((?:{_GAP}+[a-zA-Z][-\w:.]*(?:=\"[^\"<>]*\"|='[^'<>]*')?)*){_GAP}*(/?)>"
    r"|<!--(?!-?>)(?:[^-]|-(?!-))*-->"
    r"|<![Dd][Oo][Cc][Tt][Yy][Pp][Ee][^<>]*>",
    re.ASCII,
)
_TEXT, _END = 1, 2
_ATTR = re.compile(r"([a-zA-Z][-\w:.]*)(?:=(?:\"([^\"]*)\"|'([^']*)'))?", re.ASCII)
# Elements whose content is not markup, and the plain content of each up to its end tag.
_RAW = {
    name: re.compile(rf"((?:[^<]|<(?!/\s*{name}|!--))*)</{name}>", re.IGNORECASE) for name in ("script", "style")
} | {
    name: re.compile(rf"([^<&]*)</{name}>", re.IGNORECASE)
    for name in ("title", "textarea", "xmp", "iframe", "noembed", "noframes", "plaintext")
}


_NO_ATTRIBUTES: dict[str, str] = {}


@lru_cache(maxsize=4096)
def _attributes(written: str) -> dict[str, str]:
    """The attributes of a start tag, the last of a name counts. Shared, so never changed."""
    pairs = _ATTR.findall(written)
    return {name.lower(): unescape(double or single) for name, double, single in pairs}


def _holds(value: str, sign: str | None, wanted: str) -> bool:
    if sign is None:
        return True
    if sign == "=":
        return value == wanted
    if not wanted:
        return False
    if sign == "~=":
        return wanted in value.split()
    return {"^=": value.startswith, "$=": value.endswith, "*=": value.__contains__}[sign](wanted)


@lru_cache(maxsize=4096)
def compile_selector(selector: str):
    """A list of alternatives; each is a list of (combinator, tag, [(attr, sign, value)], classes).

    A compound that is not understood as a whole is refused."""
    alternatives = []
    for part in re.split(r",(?![^\[]*\])", selector):
        steps, at = [], 0
        part = part.strip()
        while at < len(part):
            match = _STEP.match(part, at)
            if not match or not match.group(2):
                raise ValueError(f"unsupported selector: {selector}")
            compound = match.group(2)
            tag = re.match(r"[\w*|-]*", compound).group()
            classes, attrs, read = [], [], len(tag)
            for simple in _SIMPLE.finditer(compound, read):
                if simple.start() != read:
                    break
                read = simple.end()
                kind, name, attr, sign, value = simple.groups()
                if kind == ".":
                    classes.append(name)
                elif kind == "#":
                    attrs.append(("id", "=", name))
                else:
                    attrs.append((attr.lower(), sign, (value or "").strip("\"'")))
            if read != len(compound):
                raise ValueError(f"unsupported selector: {selector}")
            steps.append((match.group(1) or " ", tag.lower(), attrs, classes))
            at = match.end()
        if not steps:
            raise ValueError(f"empty selector: {selector!r}")
        alternatives.append(steps)
    return alternatives


class Page(HTMLParser):
    """A page as elements in document order; an element's subtree is a range of positions."""

    def __init__(self, html: str) -> None:
        self._start()
        if not self._read_plain(html):
            self._start()
            super().__init__(convert_charrefs=True)
            self.feed(html)
            self.close()
        while self.open:
            self._end_last()

    def _start(self) -> None:
        self.tags, self.attrs, self.parents, self.ends = [], [], [], []
        self.texts, self.text_at = [], []
        self._by_tag: dict[str, list[int]] | None = None
        self._by_class: dict[str, list[int]] | None = None
        self.open: list[int] = []
        self.open_count: dict[str, int] = {}
        self.hiding: list[int] = []

    def _read_plain(self, html: str) -> bool:
        """Read a page of plain markup; false when some of it is for the parser to judge."""
        at, size, token = 0, len(html), _TOKEN.match
        start, end, data = self._open, self.handle_endtag, self.handle_data
        while at < size:
            found = token(html, at)
            if found is None:
                return False
            at, kind = found.end(), found.lastindex
            if kind == _TEXT:
                text = found[_TEXT]
                if "&" in text:
                    if at == size:
                        return False
                    text = unescape(text)
                data(text)
            elif kind == _END:
                end(found[_END].lower())
            elif kind is not None:
                _, _, tag, written, closed = found.groups()
                tag = tag.lower()
                start(tag, _attributes(written) if written else _NO_ATTRIBUTES)
                raw = tag in _RAW
                if closed:
                    if raw:
                        return False
                    if tag not in VOID:
                        end(tag)
                elif raw:
                    content = _RAW[tag].match(html, at)
                    if content is None:
                        return False
                    if content[1]:
                        data(content[1])
                    end(tag)
                    at = content.end()
        return True

    def _end_last(self) -> str:
        at = self.open.pop()
        self.ends[at] = len(self.tags)
        self.open_count[self.tags[at]] -= 1
        if self.hiding and self.hiding[-1] == at:
            self.hiding.pop()
        return self.tags[at]

    def handle_starttag(self, tag, attrs):
        self._open(tag, {name: value or "" for name, value in attrs})

    def _open(self, tag: str, attrs: dict[str, str]) -> None:
        at, inside = len(self.tags), self.open
        self.tags.append(tag)
        self.attrs.append(attrs)
        self.parents.append(inside[-1] if inside else -1)
        self.ends.append(at + 1)
        if tag not in VOID:
            inside.append(at)
            self.open_count[tag] = self.open_count.get(tag, 0) + 1
            if tag in HIDDEN_TEXT:
                self.hiding.append(at)

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if tag not in VOID:
            self.handle_endtag(tag)

    def handle_endtag(self, tag):
        # an end tag closes the nearest open element of its name and all within; else it is ignored
        if self.open_count.get(tag):
            while self._end_last() != tag:
                pass

    def handle_data(self, data):
        if self.open:
            # texts lie between the elements opened before and after them
            self.texts.append((self.open[-1], self.hiding[-1] if self.hiding else -1, data))
            self.text_at.append(len(self.tags))

    def _of_tag(self, name: str) -> list[int]:
        """Positions of the elements of a tag, in order."""
        if self._by_tag is None:
            self._by_tag = {}
            for at, tag in enumerate(self.tags):
                self._by_tag.setdefault(tag, []).append(at)
        return self._by_tag.get(name, [])

    def _of_class(self, name: str) -> list[int]:
        """Positions of the elements of a class, in order."""
        if self._by_class is None:
            self._by_class = {}
            for at, attrs in enumerate(self.attrs):
                for own in set(attrs["class"].split()) if "class" in attrs else ():
                    self._by_class.setdefault(own, []).append(at)
        return self._by_class.get(name, [])

    def _matches(self, at, step) -> bool:
        _, tag, attrs, classes = step
        if tag and tag != "*" and self.tags[at] != tag:
            return False
        own = self.attrs[at]
        if classes and not set(classes) <= set(own.get("class", "").split()):
            return False
        return all(
            name in own and _holds(own[name], sign, value) for name, sign, value in attrs
        )

    def _fits(self, at, steps, last) -> bool:
        if not self._matches(at, steps[last]):
            return False
        if last == 0:
            return True
        parent = self.parents[at]
        if steps[last][0] == ">":
            return parent >= 0 and self._fits(parent, steps, last - 1)
        while parent >= 0:
            if self._fits(parent, steps, last - 1):
                return True
            parent = self.parents[parent]
        return False

    def select(self, selector, start=-1):
        """Positions of matching elements inside the element ``start`` (-1: the page), in order."""
        first, end = (start + 1, self.ends[start]) if start >= 0 else (0, len(self.tags))
        found = set()
        for steps in compile_selector(selector):
            _, tag, _, classes = steps[-1]
            if classes or (tag and tag != "*"):
                named = self._of_class(classes[0]) if classes else self._of_tag(tag)
                pool = named[bisect_left(named, first) : bisect_left(named, end)]
            else:
                pool = range(first, end)
            found.update(at for at in pool if self._fits(at, steps, len(steps) - 1))
        return sorted(found)

    def text(self, at) -> str:
        """All text inside an element, each piece stripped, joined without a gap."""
        # texts written before the element opened carry a smaller count, later ones a larger one
        low, high = bisect_left(self.text_at, at + 1), bisect_left(self.text_at, self.ends[at] + 1)
        end = self.ends[at]
        return "".join(
            data.strip()
            for owner, hidden_in, data in self.texts[low:high]
            if at <= owner < end and hidden_in <= at
        )

    def value(self, at, attr, text_fallback):
        """The attribute, or the text when no attribute is asked for (or as its fallback)."""
        if attr:
            written = self.attrs[at].get(attr.lower())
            if written:
                return written.strip()
            if not text_fallback:
                return None
        return self.text(at) or None
