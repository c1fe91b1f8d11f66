"""A small document tree over the standard library's HTML parser.

Elements without content never hold children; an end tag closes the innermost open element of its name and all within it, or nothing if none is
open; whatever is open at the end is closed there. Comments and the texts of scripts and styles are no part of an element's text.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from html.parser import HTMLParser

#: Elements without content.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
SILENT = frozenset({"script", "style", "template"})
BLANK = re.compile(r"\s+")


class Node:
    __slots__ = ("attrs", "children", "index", "name", "parent")

    def __init__(self, name: str, attrs: dict[str, str], parent: Node | None):
        self.name, self.attrs, self.parent = name, attrs, parent
        self.children: list[Node | str] = []
        self.index = 0

    @property
    def classes(self) -> list[str]:
        return self.attrs.get("class", "").split()

    def walk(self) -> Iterator[Node]:
        """All elements within, in document order."""
        stack = [c for c in reversed(self.children) if isinstance(c, Node)]
        while stack:
            node = stack.pop()
            yield node
            stack.extend(c for c in reversed(node.children) if isinstance(c, Node))

    def strings(self) -> Iterator[str]:
        stack: list[Node | str] = list(reversed(self.children))
        while stack:
            x = stack.pop()
            if isinstance(x, str):
                yield x
            elif x.name not in SILENT:
                stack.extend(reversed(x.children))

    def text(self, separator: str = "") -> str:
        """The text nodes, each stripped, without empty ones."""
        return separator.join(s for s in (x.strip() for x in self.strings()) if s)

    def all(self, test: Callable[[Node], bool]) -> list[Node]:
        return [n for n in self.walk() if test(n)]

    def first(self, test: Callable[[Node], bool]) -> Node | None:
        return next((n for n in self.walk() if test(n)), None)

    def after(self) -> Iterator[Node | str]:
        """Following siblings, texts included."""
        if self.parent is not None:
            yield from self.parent.children[self.index + 1 :]

    def elements_after(self) -> Iterator[Node]:
        return (x for x in self.after() if isinstance(x, Node))


def is_(name: str | None = None, cls: str | None = None, id: str | None = None, id_prefix: str | None = None, has: str | None = None) -> Callable[[Node], bool]:
    """A test of an element's name, one of its classes, its id, and whether it has an attribute."""

    def test(n: Node) -> bool:
        return (name is None or n.name == name) and (cls is None or cls in n.classes) and (id is None or n.attrs.get("id") == id) and (id_prefix is None or n.attrs.get("id", "").startswith(id_prefix)) and (has is None or has in n.attrs)

    return test


class _Builder(HTMLParser):
    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.root = Node("", {}, None)
        self.now = self.root

    def _add(self, child: Node | str) -> None:
        if isinstance(child, Node):
            child.index = len(self.now.children)
            self.now.children.append(child)
        elif self.now.children and isinstance(self.now.children[-1], str):
            self.now.children[-1] += child
        else:
            self.now.children.append(child)

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        own: dict[str, str] = {}
        for k, v in attrs:
            own[k] = v or ""
        node = Node(tag, own, self.now)
        self._add(node)
        if tag not in VOID:
            self.now = node

    def handle_startendtag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        self.handle_starttag(tag, attrs)
        if tag not in VOID:
            self.handle_endtag(tag)

    def handle_endtag(self, tag: str) -> None:
        node: Node | None = self.now
        while node is not None and node.name != tag:
            node = node.parent
        if node is not None and node.parent is not None:
            self.now = node.parent

    def handle_data(self, data: str) -> None:
        self._add(data)


def parse(html: str) -> Node:
    builder = _Builder()
    builder.feed(html)
    builder.close()
    return builder.root
