"""A small document tree on the standard library's parser, with the selections that extractors need."""

from __future__ import annotations

import functools
import re
from collections.abc import Iterator
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import DataFrame

from ..shipping import ship, spread

VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr"}
CLOSES = {"li": {"li"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "p": {"p"}, "option": {"option"}}


class Node:
    __slots__ = ("tag", "attrs", "children", "parent")

    def __init__(self, tag: str, attrs: dict[str, str], parent: Node | None):
        self.tag, self.attrs, self.parent = tag, attrs, parent
        self.children: list[Node | str] = []

    def walk(self) -> Iterator[Node]:
        """All nodes below, in document order, without recursion."""
        stack = self._below()
        while stack:
            node = stack.pop()
            yield node
            if node.children:
                stack += node._below()

    def _below(self) -> list[Node]:
        return [c for c in reversed(self.children) if not isinstance(c, str)]

    def text(self, separator: str = " ") -> str:
        parts: list[str] = []
        stack: list[Node | str] = list(reversed(self.children))
        while stack:
            x = stack.pop()
            if isinstance(x, str):
                parts.append(x)
            elif x.tag not in ("script", "style"):
                stack.extend(reversed(x.children))
        return re.sub(r"\s+", " ", separator.join(p.strip() for p in parts if p.strip())).strip()

    def matches(self, selector: str) -> bool:
        """``tag``, ``.class``, ``tag.class``, ``tag[attr]``, ``~pattern`` (a class that the pattern finds)."""
        tag, classes, attr, pattern = _parsed(selector)
        if tag and tag != self.tag or attr and attr not in self.attrs:
            return False
        if pattern:
            return bool(pattern.search(self.attrs.get("class", "")))
        return not classes or classes.issubset(self.attrs.get("class", "").split())

    def select(self, selectors: str) -> list[Node]:
        """Nodes that match one of the comma-separated selectors."""
        return list(self._found(selectors))

    def first(self, selectors: str) -> Node | None:
        return next(self._found(selectors), None)

    def _found(self, selectors: str) -> Iterator[Node]:
        """As ``select``, one after another; a node whose tag no selector names isn't looked at further."""
        wanted = _listed(selectors)
        tags = {_parsed(s)[0] for s in wanted}
        for node in self.walk():
            if (node.tag in tags or "" in tags) and any(node.matches(s) for s in wanted):
                yield node


@functools.lru_cache(1024)
def _listed(selectors: str) -> tuple[str, ...]:
    return tuple(s.strip() for s in selectors.split(","))


@functools.lru_cache(1024)
def _parsed(selector: str) -> tuple[str, frozenset[str], str, re.Pattern | None]:
    """A selector's tag, classes, attribute and pattern, read once."""
    if selector.startswith("~"):
        return "", frozenset(), "", re.compile(selector[1:], re.IGNORECASE)
    m = re.fullmatch(r"([\w-]*)(?:\.([\w-]+(?:\.[\w-]+)*))?(?:\[([\w-]+)\])?", selector)
    if not m:
        raise ValueError(f"selector {selector!r}")
    return m[1], frozenset(m[2].split(".") if m[2] else ()), m[3] or "", None


class _Builder(HTMLParser):
    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.root = self.at = Node("", {}, None)

    def handle_starttag(self, tag, attrs):
        if tag in CLOSES and self.at.tag in CLOSES[tag]:
            while self.at.tag in CLOSES[tag] and self.at.parent is not None:
                self.at = self.at.parent
        node = Node(tag, {k: v or "" for k, v in attrs}, self.at)
        self.at.children.append(node)
        if tag not in VOID:
            self.at = node

    def handle_startendtag(self, tag, attrs):
        self.at.children.append(Node(tag, {k: v or "" for k, v in attrs}, self.at))

    def handle_endtag(self, tag):
        node = self.at
        while node is not None and node.tag != tag:
            node = node.parent
        if node is not None and node.parent is not None:
            self.at = node.parent

    def handle_data(self, data):
        self.at.children.append(data)


def parse_html(page: str | None, references: tuple[str, ...] | None = None) -> Node:
    """A page's tree. ``references`` names the character references that are read (``amp``, ``lt``); any other ampersand stays as it is written. None: all of them are read, as browsers do."""
    builder = _Builder()
    if page and references is not None:
        page = re.sub(rf"&(?!(?:{'|'.join(map(re.escape, references))});)" if references else "&", "&amp;", page)
    builder.feed(page or "")
    builder.close()
    return builder.root


def select_text(pages: DataFrame, selectors: str, references: tuple[str, ...] | None = None) -> DataFrame:
    """page_id, pos, text of every node of ``pages`` (page_id, html) that one of the selectors matches, in document order; ``references`` as in ``parse_html``."""
    ship(pages.sparkSession)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = [(i, k, n.text()) for i, page in zip(batch["page_id"], batch["html"], strict=True) for k, n in enumerate(parse_html(page, references).select(selectors))]
            yield pd.DataFrame(rows, columns=["page_id", "pos", "text"])

    return spread(pages.select("page_id", "html")).mapInPandas(run, "page_id long, pos int, text string")
