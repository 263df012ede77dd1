"""The leaf blocks of a web page: runs of text between block-level tags, with the path of open elements.

A forgiving reader in one pass over the page: unclosed paragraphs, items and cells end
where the next begins, end tags close what they name or nothing, quoted attributes may
hold ``>``, and what is not a tag is text. Scripts, styles, titles, templates, form
controls, comments and declarations are no text.
"""

from __future__ import annotations

import html
import re
from typing import NamedTuple

# Element names of HTML.
INLINE = frozenset(
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark nobr picture q ruby rb rp rt rtc s samp "
    "small span strike strong sub sup time tt u var wbr".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style title textarea iframe xmp noembed noframes".split())
SKIPPED = frozenset("template noscript select button svg object canvas audio video math datalist".split())
# What a start tag ends when it is still open, up to the container that holds it.
ENDS = {
    "li": ({"li"}, {"ul", "ol", "menu"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr"}, {"table"}),
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
}
_TEXT_IN_P = INLINE | RAW | SKIPPED | VOID

_NAME = re.compile(r"[a-zA-Z][^\s/<>]*")
_ATTRIBUTE = re.compile(r"""([^\s=/"'<>]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""")
_QUOTE = re.compile(r"""=\s*(["'])""")
_WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")
_HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)
_RAW_END = {tag: re.compile(f"</{tag}(?=[\\s/>])", re.I) for tag in RAW}


class Node(NamedTuple):
    parent: int  # its index; -1 for none
    tag: str
    marks: tuple[str, ...]  # words of class, id and role


class Block(NamedTuple):
    node: int
    text: str
    linked: int  # characters inside links


class Page(NamedTuple):
    nodes: list[Node]
    blocks: list[Block]


def _marks(attributes: str) -> tuple[str, ...]:
    """Words of what an element is called: '#top-menu.navBar' gives top, menu, nav, bar."""
    if "=" not in attributes and "hidden" not in attributes:
        return ()
    found: list[str] = []
    for name, *values in _ATTRIBUTE.findall(attributes):
        name, value = name.lower(), values[0] or values[1] or values[2]
        if name in ("class", "id", "role", "itemprop"):
            found += [w.lower() for w in _WORD.findall(value)]
        elif name == "hidden" or (name == "style" and _HIDDEN.search(value)):
            found.append("hidden")
    return tuple(dict.fromkeys(found))


class _Reader:
    def __init__(self, page: str):
        self.page = page
        self.nodes: list[Node] = []
        self.blocks: list[Block] = []
        self.open: list[int] = []  # nodes
        self.count: dict[str, int] = {}  # open elements by name
        self.text: list[str] = []
        self.linked = self.skipping = 0
        self.in_link = self.loose = False
        self.last = page.rfind(">")

    def _tag_end(self, begin: int) -> int:
        """Where the tag that begins here ends: at the first > outside quoted values.

        Once a value's quote or tag does not end, quotes are passed over, so a page is read in linear time.
        """
        first = end = self.page.find(">", begin) if begin < self.last else -1
        at = begin
        while end >= 0 and not self.loose:
            value = _QUOTE.search(self.page, at, end)
            if value is None:
                return end
            at = self.page.find(value.group(1), value.end()) + 1
            end = (self.page.find(">", at) if at > end else end) if at else -1
            self.loose = end < 0
        return first

    def _add(self, text: str) -> None:
        if self.skipping or not text:
            return
        if "&" in text:
            text = html.unescape(text)
        self.text.append(text)
        if self.in_link:
            self.linked += len(text)

    def _flush(self) -> None:
        if self.text:
            text = " ".join("".join(self.text).split())
            if text:
                self.blocks.append(Block(self.open[-1] if self.open else -1, text, min(self.linked, len(text))))
            self.text.clear()
            self.linked = 0

    def _pop(self) -> str:
        tag = self.nodes[self.open.pop()].tag
        self.count[tag] -= 1
        self.skipping -= tag in SKIPPED
        return tag

    def _close(self, tag: str) -> None:
        if self.count.get(tag):
            while self._pop() != tag:
                pass

    def _start(self, tag: str, attributes: str) -> None:
        if tag in ENDS:
            ended, container = ENDS[tag]
            if any(self.count.get(t) for t in ended):
                names = (self.nodes[n].tag for n in reversed(self.open))
                inner = next((t for t in names if t in ended or t in container), None)
                if inner in ended:
                    self._close(inner)
        elif self.count.get("p") and tag not in _TEXT_IN_P:
            self._close("p")
        self.nodes.append(Node(self.open[-1] if self.open else -1, tag, _marks(attributes)))
        if tag in VOID or attributes.endswith("/") and tag in SKIPPED:
            return
        self.open.append(len(self.nodes) - 1)
        self.count[tag] = self.count.get(tag, 0) + 1
        self.skipping += tag in SKIPPED

    def _tag(self, begin: int) -> int:
        """Handles the tag that begins here; returns where it ends."""
        end = self._tag_end(begin)
        if end < 0:
            self._add("<")
            return begin + 1
        closing = self.page[begin + 1] == "/"
        name = _NAME.match(self.page, begin + 1 + closing)
        tag = name.group().lower()
        attributes = self.page[name.end() : end]
        if tag in RAW and not closing:
            found = _RAW_END[tag].search(self.page, end + 1)
            if found is None:
                return len(self.page)
            after = self.page.find(">", found.end())
            return len(self.page) if after < 0 else after + 1
        if tag in INLINE:
            if tag == "a":
                self.in_link = not closing
            elif tag == "br":
                self._add(" ")
            return end + 1
        self._flush()
        if not closing:
            self._start(tag, attributes)
        else:
            self._close(tag)
        return end + 1

    def read(self) -> Page:
        page, at = self.page, 0
        while at < len(page):
            less = page.find("<", at)
            if less < 0:
                self._add(page[at:])
                break
            self._add(page[at:less])
            following = page[less + 1 : less + 2]
            if page.startswith("<!--", less):
                end = page.find("-->", less + 4)
                at = len(page) if end < 0 else end + 3
            elif following in ("!", "?"):
                end = page.find(">", less)
                at = len(page) if end < 0 else end + 1
            elif _NAME.match(page, less + 1) or (following == "/" and _NAME.match(page, less + 2)):
                at = self._tag(less)
            else:
                self._add("<")
                at = less + 1
        self._flush()
        return Page(self.nodes, self.blocks)


def read(page: str) -> Page:
    return _Reader(page).read()
