"""Trees of landed pages as browsers see them: tags that nobody closed end where the next ones imply it.

Nothing recurses, and each tag costs the same however deep it stands, so a page of 100,000 open tags is a page like any other.
"""

from __future__ import annotations

import re
from bisect import bisect_right
from collections import defaultdict
from collections.abc import Iterator
from functools import lru_cache
from html import unescape
from html.parser import HTMLParser

# Elements without content, text that isn't shown, and the elements by which a table is laid out.
VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
HIDDEN = frozenset("script style template".split())
CELLS, ROWS, GROUPS = ("td", "th"), ("tr", "caption", "colgroup"), ("tbody", "thead", "tfoot")
BLOCKS = "address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr main menu nav ol p pre section summary table ul".split()

#: What a start tag ends, if it is open, and the elements out of which it doesn't reach.
ENDS: dict[str, tuple[tuple[str, ...], tuple[str, ...]]] = {
    **dict.fromkeys(BLOCKS, (("p",), (*CELLS, "caption", "table", "button"))),
    "li": (("li", "p"), ("ul", "ol", "menu", *CELLS, "table")),
    **dict.fromkeys(("dt", "dd"), (("dt", "dd", "p"), ("dl", *CELLS, "table"))),
    "option": (("option",), ("select", "optgroup", "datalist")),
    "optgroup": (("option", "optgroup"), ("select",)),
    **dict.fromkeys(CELLS, (CELLS, ("tr", "table"))),
    **dict.fromkeys(ROWS, ((*CELLS, *ROWS), ("table", *GROUPS))),
    **dict.fromkeys(GROUPS, ((*CELLS, *ROWS, *GROUPS), ("table",))),
    "body": (("head",), ()),
}
#: Out of which elements an end tag doesn't reach: of a part of a table not out of the table, of others not out of their cell.
HELD = dict.fromkeys((*CELLS, *ROWS, *GROUPS), ("table",)) | dict.fromkeys(("table", "body", "html"), ())
HELD_OTHER = (*CELLS, "caption", "table")
#: Most tags of a page are a name in small letters and nothing else, or with values in quotes; behind some names the library reads no tags.
RAW = frozenset("iframe noembed noframes noscript plaintext script style textarea title xmp".split())
PLAIN_START, PLAIN_END = re.compile("<([a-z][a-z0-9]*)>"), re.compile("</([a-z][a-z0-9]*)>")
PLAIN = re.compile("""/[a-z][a-z0-9]*|[a-z][a-z0-9]*(?: [a-z][a-z-]*="[^"<>]*")*""")


class Node:
    __slots__ = ("tag", "attrs", "kids")

    def __init__(self, tag: str, attrs: dict):
        self.tag, self.attrs, self.kids = tag, attrs, []

    def walk(self) -> Iterator[Node]:
        """All elements inside, in the order of their start tags."""
        waiting = [k for k in reversed(self.kids) if isinstance(k, Node)]
        while waiting:
            kid = waiting.pop()
            yield kid
            if kid.kids:
                waiting += [k for k in reversed(kid.kids) if isinstance(k, Node)]

    def text(self, sep: str = "") -> str:
        """The shown texts inside, each stripped, side by side."""
        if len(self.kids) == 1 and isinstance(self.kids[0], str):
            return self.kids[0].strip()
        out, waiting = [], [iter(self.kids)]
        while waiting:
            for kid in waiting[-1]:
                if isinstance(kid, str):
                    if kid.strip():
                        out.append(kid.strip())
                elif kid.tag not in HIDDEN:
                    waiting.append(iter(kid.kids))
                    break
            else:
                waiting.pop()
        return sep.join(out)

    def all(self, tag: str, cls: str | None = None) -> list[Node]:
        if len(self.kids) == 1 and isinstance(self.kids[0], str):
            return []
        return [n for n in self.walk() if n.tag == tag and (cls is None or cls in n.attrs.get("class", "").split())]

    def children(self, tag: str) -> list[Node]:
        return [k for k in self.kids if isinstance(k, Node) and k.tag == tag]


class Tag(HTMLParser):
    """`name` and `attrs` of one tag as the library reads it; an end tag has no attributes."""

    def handle_starttag(self, tag, attrs):
        self.name, self.attrs = tag, {k: v or "" for k, v in attrs}

    def handle_endtag(self, tag):
        self.name, self.attrs = tag, None


@lru_cache(4096)
def plain_tag(inside: str) -> tuple[str, dict | None] | None:
    """Name and attributes of the tag with this between < and >, where it reads the same wherever it stands; pages share the attributes."""
    if not PLAIN.fullmatch(inside):
        return None
    tag = Tag()
    tag.feed(f"<{inside}>")
    return None if tag.name in RAW else (tag.name, tag.attrs)


class Tree(HTMLParser):
    """`root` has the page."""

    def __init__(self, page: str):
        super().__init__(convert_charrefs=True)
        self.root = Node("", {})
        self.stack, self.places = [self.root], defaultdict(list)  # open elements, and where in the stack those of each tag are
        self.feed(page)
        self.close()

    def feed(self, page):
        """Plain tags are looked up; from the first other one on, the library reads the page."""
        text, *parts = page.split("<")
        if text:
            self.handle_data(unescape(text))
        at = len(text)
        for part in parts:
            inside, closed, text = part.partition(">")
            found = plain_tag(inside) if closed and len(inside) < 400 else None
            if found is None:
                return super().feed(page[at:])
            tag, attrs = found
            if attrs is None:
                self.handle_endtag(tag)
            else:
                self.open(tag, attrs)
            if text:
                self.stack[-1].kids.append(unescape(text) if "&" in text else text)
            at += len(part) + 1

    def updatepos(self, i, j):
        """Nobody asks for line numbers."""
        return j

    def parse_starttag(self, i):
        """Plain tags without the search for attributes."""
        m = PLAIN_START.match(self.rawdata, i)
        if m is None or m[1] in RAW:
            return super().parse_starttag(i)
        self.lasttag = m[1]
        self.handle_starttag(m[1], ())
        return m.end()

    def parse_endtag(self, i):
        m = PLAIN_END.match(self.rawdata, i)
        if m is None or self.cdata_elem is not None:
            return super().parse_endtag(i)
        self.handle_endtag(m[1])
        return m.end()

    def innermost(self, tags: tuple[str, ...]) -> int:
        return max((self.places[t][-1] for t in tags if self.places[t]), default=0)

    def end(self, place: int) -> None:
        """Closes the element at a place of the stack and all inside."""
        while len(self.stack) > place:
            self.places[self.stack.pop().tag].pop()

    def handle_starttag(self, tag, attrs):
        self.open(tag, {k: v or "" for k, v in attrs} if attrs else {})

    def open(self, tag: str, attrs: dict) -> None:
        if tag in ENDS and self.stack[-1].tag not in ENDS[tag][1]:
            tags, limits = ENDS[tag]
            if inside := [p for t in tags if (p := self.places[t])]:
                limit = self.innermost(limits)
                outer = [p[k] for p in inside if (k := bisect_right(p, limit)) < len(p)]
                if outer:
                    self.end(min(outer))
        node = Node(tag, attrs)
        self.stack[-1].kids.append(node)
        if tag not in VOID:
            self.places[tag].append(len(self.stack))
            self.stack.append(node)

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)

    def handle_endtag(self, tag):
        if self.stack[-1].tag == tag != "":  # most end tags end what was opened last
            self.stack.pop()
            self.places[tag].pop()
        elif self.places[tag] and (place := self.places[tag][-1]) >= self.innermost(HELD.get(tag, HELD_OTHER)):
            self.end(place)

    def handle_data(self, data):
        self.stack[-1].kids.append(data)
