"""A small document tree for stored pages, and the few selections the extraction needs.

Plain functions on one page; :mod:`gripe.sources.pages` runs them on Arrow
batches inside Spark tasks.  Character references are decoded by the standard
library's HTML5 table, attribute values in any quoting.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from html.parser import HTMLParser

_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Start tags that end an open paragraph.
_ENDS_P = frozenset("address article aside blockquote div dl fieldset figure footer form h1 h2 h3 h4 h5 h6 header hr "
                    "main nav ol p pre section table ul".split())


class Node:
    """An element: ``children`` holds nodes and text in document order."""

    __slots__ = ("tag", "attrs", "children", "parent")

    def __init__(self, tag: str, attrs: dict[str, str | None], parent: "Node | None"):
        self.tag, self.attrs, self.children, self.parent = tag, attrs, [], parent

    def walk(self) -> Iterator["Node"]:
        """All elements below, in document order."""
        stack = list(reversed(self.children))
        while stack:
            n = stack.pop()
            if isinstance(n, Node):
                yield n
                stack.extend(reversed(n.children))

    def find(self, test: "Callable[[Node], bool]") -> "Node | None":
        return next((n for n in self.walk() if test(n)), None)

    def text(self) -> str:
        """``textContent``."""
        out, stack = [], [self]
        while stack:
            n = stack.pop()
            if isinstance(n, str):
                out.append(n)
            else:
                stack.extend(reversed(n.children))
        return "".join(out)

    def inside(self, tag: str) -> bool:
        n = self.parent
        while n is not None and n.tag != tag:
            n = n.parent
        return n is not None

    def has_class(self, part: str) -> bool:
        """``contains(@class, part)``."""
        return part in (self.attrs.get("class") or "")


class _Builder(HTMLParser):
    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.root = self.at = Node("", {}, None)

    def handle_starttag(self, tag: str, attrs: list) -> None:
        if tag in _ENDS_P:
            self._close("p", stop=("article", "div", "td", "li", "section"))
        n = Node(tag, dict(reversed(attrs)), self.at)  # of repeated attributes the first counts
        self.at.children.append(n)
        if tag not in _VOID:
            self.at = n

    def handle_startendtag(self, tag: str, attrs: list) -> None:
        self.at.children.append(Node(tag, dict(reversed(attrs)), self.at))

    def _close(self, tag: str, stop: tuple[str, ...] = ()) -> None:
        n = self.at
        while n.parent is not None and n.tag != tag and n.tag not in stop:
            n = n.parent
        if n.tag == tag and n.parent is not None:
            self.at = n.parent

    def handle_endtag(self, tag: str) -> None:
        self._close(tag)

    def handle_data(self, data: str) -> None:
        self.at.children.append(data)


def parse(html: str | None) -> Node:
    b = _Builder()
    b.feed(html or "")
    b.close()
    return b.root
