"""A small HTML reader: events, a light tree, and its serialisation. Plain Python, no state between calls.

Policy: tags are read as they stand. An end tag closes its nearest open element and everything
opened inside it; an end tag without an open element is ignored; elements left open end with the
document. Nothing is implied, so text behind an unclosed ``<b>`` is inside it until an outer
element ends. Script, style, title and textarea hold raw text up to their end tag.
"""

from __future__ import annotations

import html as _entities
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

#: Elements without content.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Elements whose content is raw text.
RAW = frozenset(("script", "style", "title", "textarea"))
#: Elements that start a new line of text.
BLOCK = frozenset(
    "address article aside blockquote body caption dd details div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 "
    "header hr html li main nav ol p pre section table tbody td tfoot th thead title tr ul".split()
)

_TOKEN = re.compile(
    r"<!--(?P<comment>.*?)(?:-->|\Z)|<(?P<decl>[!?][^>]*)(?:>|\Z)"
    r"|<(?P<close>/?)(?P<tag>[a-zA-Z][^\s/>]*)(?P<attrs>(?:[^>\"']|\"[^\"]*\"|'[^']*')*)>",
    re.S,
)
_ATTR = re.compile(r"([^\s=/>\"']+)(?:\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s>]+))?")
_BODY = re.compile(r"<body\b", re.I)


def unescape(text: str) -> str:
    return _entities.unescape(text) if "&" in text else text


def escape(text: str) -> str:
    return _entities.escape(text, quote=False)


def attributes(source: str) -> list[tuple[str, str]]:
    """Attributes in order, names in lower case, values unescaped; an empty value where there is none."""
    out = []
    for name, value in _ATTR.findall(source):
        if value[:1] in ("'", '"'):
            value = value[1:-1]
        out.append((name.lower(), unescape(value)))
    return out


def events(source: str) -> Iterator[tuple[str, str, str]]:
    """(kind, name, raw): text, start, end, void, comment, decl and raw text in the order of the document."""
    at = 0
    raw_until = None
    size = len(source)
    while at < size:
        if raw_until:
            end = re.compile(rf"</{raw_until}\s*>", re.I).search(source, at)
            stop = end.start() if end else size
            if stop > at:
                yield "raw", raw_until, source[at:stop]
            if end:
                yield "end", raw_until, end[0]
                at = end.end()
            else:
                at = size
            raw_until = None
            continue
        m = _TOKEN.search(source, at)
        if not m:
            yield "text", "", source[at:]
            return
        if m.start() > at:
            yield "text", "", source[at : m.start()]
        at = m.end()
        if m["tag"]:
            name = m["tag"].lower()
            if m["close"]:
                yield "end", name, m[0]
            elif name in VOID or m["attrs"].rstrip().endswith("/"):
                yield "void", name, m[0]
            else:
                yield "start", name, m[0]
                if name in RAW:
                    raw_until = name
        elif m["comment"] is not None:
            yield "comment", "", m[0]
        else:
            yield "decl", "", m[0]


@dataclass
class Node:
    """An element, or a leaf: text and raw hold source text, comment and decl their source."""

    kind: str
    name: str = ""
    source: str = ""
    parent: Node | None = None
    children: list[Node] = field(default_factory=list)
    closed: str = ""

    def add(self, node: Node) -> Node:
        node.parent = self
        self.children.append(node)
        return node

    def walk(self) -> Iterator[Node]:
        """The node and all below it, in document order, without recursion."""
        stack = [self]
        while stack:
            node = stack.pop()
            yield node
            stack.extend(reversed(node.children))

    def path(self) -> list[str]:
        """Names of the elements around the node, outermost first."""
        out, up = [], self.parent
        while up is not None and up.kind == "element":
            out.append(up.name)
            up = up.parent
        return out[::-1]

    def html(self) -> str:
        """The source again: exact for a parsed document whose end tags all had an element."""
        out: list[str] = []
        stack: list[Node | str] = [self]
        while stack:
            node = stack.pop()
            if isinstance(node, str):
                out.append(node)
                continue
            out.append(node.source)
            if node.children or node.closed:
                stack.append(node.closed)
                stack.extend(reversed(node.children))
        return "".join(out)

    def text(self, separator: str = "", skip: frozenset[str] = frozenset()) -> str:
        """Unescaped text below the node, leaving out the elements in skip."""
        out: list[str] = []
        stack = [self]
        while stack:
            node = stack.pop()
            if node.kind == "element" and node.name in skip:
                continue
            if node.kind == "text":
                out.append(unescape(node.source))
            elif node.kind == "raw":
                out.append(node.source)
            stack.extend(reversed(node.children))
        return separator.join(out)

    def attrs(self) -> list[tuple[str, str]]:
        m = _TOKEN.match(self.source)
        return attributes(m["attrs"].rstrip("/ \t\r\n")) if m and m["tag"] else []


def parse(source: str) -> Node:
    """The tree of a document or fragment."""
    root = Node("root")
    now = root
    for kind, name, raw in events(source or ""):
        if kind == "start":
            now = now.add(Node("element", name, raw))
        elif kind == "void":
            now.add(Node("element", name, raw))
        elif kind == "end":
            at = now
            while at is not root and at.name != name:
                at = at.parent
            if at is not root:
                at.closed = raw
                now = at.parent
        else:
            now.add(Node(kind, name, raw))
    return root


def has_body(source: str) -> bool:
    return bool(_BODY.search(source or ""))


def processing_root(root: Node, source: str) -> Node:
    """The body where the source names one, the whole otherwise."""
    if has_body(source):
        for node in root.walk():
            if node.kind == "element" and node.name == "body":
                return node
    return root
