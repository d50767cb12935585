"""Tags of one document as tokens and markers, their checks, and the way back. Plain Python over one value."""

from __future__ import annotations

import bisect
import itertools
import json
import re
from collections import Counter
from collections.abc import Callable, Iterator

from palimpsest.functions import html as H
from palimpsest.functions import patterns as P

_INLINE = re.compile(r"⟦(/?)(\d+)⟧")
_GLOBAL = re.compile(P.GLOBAL_TOKEN)
_MARKER = re.compile(P.MARKER)


# ---- text nodes and blocks -------------------------------------------------------------------


def text_nodes(source: str | None) -> list[tuple[int, str, str, list[str], str | None, int | None]]:
    """(number, text, parent, path, nearest p or li, its number) of the text nodes below the processing root that
    aren't blank; comments, declarations and raw text of scripts and styles aside."""
    root = H.parse(source or "")
    start = H.processing_root(root, source or "")
    out = []
    numbers: dict[int, int] = {}
    for node in start.walk():
        if node.kind == "element":
            if node.name in P.APPROVED:
                numbers[id(node)] = len(numbers)
            continue
        if node.kind != "text" or not (text := H.unescape(node.source)).strip():
            continue
        path, up, block = node.path(), node.parent, None
        while up is not None and up.kind == "element":
            if up.name in P.APPROVED:
                block = up
                break
            up = up.parent
        out.append((len(out), text, path[-1] if path else "", path, block.name if block else None, numbers.get(id(block)) if block else None))
    return out


def text_blocks(source: str | None) -> list[tuple[int, str, str, str, list[str], bool]]:
    """(number, tag, heading, text, path, has inline children) of p and li elements with text; the heading is the
    last one before."""
    root = H.parse(source or "")
    start = H.processing_root(root, source or "")
    heading, out = "", []
    for node in start.walk():
        if node.kind != "element":
            continue
        if node.name in P.HEADINGS:
            heading = _plain(node) or heading
        elif node.name in P.APPROVED and (text := _plain(node)):
            out.append((len(out), node.name, heading, text, node.path(), any(c.kind == "element" for c in node.children)))
    return out


def _plain(node: H.Node) -> str:
    return " ".join(node.text(" ").split())


def visible_text(source: str | None, separator: str = " ", skip: tuple[str, ...] = P.UNSEEN) -> str | None:
    """The text a reader sees, white space normalised, or lines where the separator is a line end; null for null."""
    if source is None:
        return None
    parts = H.parse(source).text("\0", frozenset(skip)).split("\0")
    return separator.join(p for p in (" ".join(p.split()) for p in parts) if p)


def bold_texts(source: str | None) -> list[str]:
    """Texts of b and strong elements, in order."""
    return [n.text(" ") for n in H.parse(source or "").walk() if n.kind == "element" and n.name in P.BOLD]


def leaf_blocks(source: str | None, names: tuple[str, ...] = P.LEAF_BLOCKS) -> list[tuple[int, str, str]]:
    """(number, tag, html) of blocks that hold no other block."""
    out = []
    for node in H.parse(source or "").walk():
        if node.kind == "element" and node.name in names and not any(c is not node and c.kind == "element" and c.name in names for c in node.walk()):
            out.append((len(out), node.name, node.html()))
    return out


# ---- inline tokens ---------------------------------------------------------------------------


def inline_tokens(nodes: list[H.Node]) -> tuple[str, list[tuple[str, str, str]]]:
    """Text of a run of nodes with ⟦n⟧…⟦/n⟧ for each tag, and (n, start tag, end tag); comments are left out."""
    out: list[str] = []
    tags: list[tuple[str, str, str]] = []
    stack: list[H.Node | str] = list(reversed(nodes))
    while stack:
        node = stack.pop()
        if isinstance(node, str):
            out.append(node)
        elif node.kind in ("text", "raw"):
            out.append(node.source)
        elif node.kind == "element":
            n = str(len(tags) + 1)
            tags.append((n, node.source, node.closed))
            out.append(f"⟦{n}⟧")
            stack.append(f"⟦/{n}⟧")
            stack.extend(reversed(node.children))
    return "".join(out), tags


def segments(source: str | None) -> tuple[str, list[tuple[int, str, str, list[tuple[str, str, str]]]]]:
    """The skeleton of a document, with a comment for each segment, and the segments: (number, parent tag, tokenised
    text, tags). A segment is a run of text and inline nodes directly below a block, so nested lists stay apart."""
    root = H.parse(source or "")
    found: list[tuple[int, str, str, list[tuple[str, str, str]]]] = []

    def inline(node: H.Node) -> bool:
        if node.kind == "text":
            return True
        return node.kind == "element" and (node.name in P.DISPLAY or node.name in P.INLINE and node.name not in P.NEVER_EDIT)

    def flush(parent: H.Node, run: list[H.Node], kept: list[H.Node]) -> None:
        if not run:
            return
        text, tags = inline_tokens(run)
        if _INLINE.sub("", text).strip():
            kept.append(H.Node("comment", source=f"<!--SEGMENT:{len(found)}-->"))
            found.append((len(found), parent.name, text, tags))
        else:
            kept.extend(run)

    stack = [root]
    order: list[H.Node] = []
    while stack:
        node = stack.pop()
        if node.kind == "element" and node.name in P.NEVER_EDIT:
            continue
        order.append(node)
        stack.extend(c for c in reversed(node.children) if c.kind == "element" and not inline(c))
    for node in order:
        kept: list[H.Node] = []
        run: list[H.Node] = []
        for child in node.children:
            if inline(child):
                run.append(child)
            else:
                flush(node, run, kept)
                run = []
                kept.append(child)
        flush(node, run, kept)
        node.children = kept
    return root.html(), found


def joined(skeleton: str, rewritten: dict[int, str]) -> str:
    """The document with its segments' HTML again."""
    return re.sub(r"<!--SEGMENT:(\d+)-->", lambda m: rewritten.get(int(m[1]), ""), skeleton)


def detokenised(text: str, tags: list[tuple[str, str, str]]) -> str:
    """HTML of a tokenised text; tokens without a tag and stray ends are left out, open ones are closed."""
    known = {n: (a, b) for n, a, b in tags}
    out: list[str] = []
    open_: list[str] = []
    at = 0
    for m in _INLINE.finditer(text):
        out.append(text[at : m.start()])
        at = m.end()
        if m[2] not in known:
            continue
        if not m[1]:
            out.append(known[m[2]][0])
            open_.append(m[2])
        elif m[2] in open_:
            while (n := open_.pop()) != m[2]:
                out.append(known[n][1])
            out.append(known[m[2]][1])
    out.append(text[at:])
    out.extend(known[n][1] for n in reversed(open_))
    return "".join(out)


def token_issues(text: str | None, expected: list[str]) -> list[str]:
    """What is wrong with the tokens of a rewritten text, against the expected numbers.

    Each number's starts and ends are paired in order, so a token is a range of the text. Numbers are
    compared as sets and counts, ranges by their places: an end without a start before it is stray, a
    start without an end unclosed, and two ranges that overlap without one holding the other are misnested.
    """
    if not (text or "").strip():
        return ["empty_revision"]
    wanted = set(expected)
    places: dict[str, tuple[list[int], list[int]]] = {}
    for m in _INLINE.finditer(text):
        places.setdefault(m[2], ([], []))[bool(m[1])].append(m.start())
    issues = [f"{name}:{','.join(sorted(odd))}" for name, odd in (("token_missing", wanted - set(places)), ("token_unexpected", set(places) - wanted)) if odd]
    ranges = []
    for n, (starts, ends) in sorted(places.items()):
        pairs = list(itertools.zip_longest(starts, ends))
        issues += [f"token_stray_close:{n}" for a, b in pairs if b is not None and (a is None or b < a)]
        issues += [f"token_unclosed:{n}" for _, b in pairs if b is None]
        ranges += [(a, b, n) for a, b in pairs if a is not None and b is not None and a < b]
    ranges.sort()
    begins = [r[0] for r in ranges]
    for i, (_, stop, n) in enumerate(ranges):
        inside = ranges[i + 1 : bisect.bisect_left(begins, stop)]
        issues += [f"token_misnested:{other}:{n}" for _, end, other in inside if end > stop and other != n]
    for n in sorted(wanted):
        found = places.get(n, ([], []))
        issues += [f"token_{side}_count:{n}:{len(at)}" for side, at in zip(("open", "close"), found) if len(at) != 1]
    return issues


# ---- global tokens ---------------------------------------------------------------------------


def global_tokens(source: str) -> tuple[str, list[tuple[str, str]]]:
    """Every tag, comment and declaration as a token of its own; text, raw text too, stays. (token, markup) in order.
    A source that holds such tokens already is refused."""
    if _GLOBAL.search(source):
        raise ValueError("the source holds strings that look like tokens")
    out: list[str] = []
    tokens: list[tuple[str, str]] = []
    for kind, _, raw in H.events(source):
        if kind in ("text", "raw"):
            out.append(raw)
        else:
            token = f"⟦HTML_TAG_{len(tokens) + 1:06d}⟧"
            tokens.append((token, raw))
            out.append(token)
    return "".join(out), tokens


def from_global_tokens(text: str, tokens: list[tuple[str, str]]) -> str:
    known = dict(tokens)

    def markup(m: re.Match[str]) -> str:
        if m[0] not in known:
            raise ValueError(f"unexpected token {m[0]}")
        return known[m[0]]

    return _GLOBAL.sub(markup, text)


# ---- markers ---------------------------------------------------------------------------------


def markers(block: str) -> tuple[str, str, str, list[tuple[str, str, str, str, str]]]:
    """(start tag, end tag, text, markers) of one block: ⟦KEEP_n_START⟧ for protected tags, ⟦TAG_n_START⟧ for others,
    ⟦EMPTY_n⟧ for tags without content. A marker is (id, tag, start tag, end tag, kind)."""
    root = next(n for n in H.parse(block).children if n.kind == "element")
    out: list[str] = []
    found: list[tuple[str, str, str, str, str]] = []
    stack: list[H.Node | str] = list(reversed(root.children))
    while stack:
        node = stack.pop()
        if isinstance(node, str):
            out.append(node)
        elif node.kind == "text":
            out.append(node.source)
        elif node.kind == "element":
            kind = "KEEP" if node.name in P.BOLD else "EMPTY" if node.name in H.VOID else "TAG"
            mark = f"{kind}_{len(found) + 1}"
            found.append((mark, node.name, node.source, node.closed, kind))
            if kind == "EMPTY":
                out.append(f"⟦{mark}⟧")
            else:
                out.append(f"⟦{mark}_START⟧")
                stack.append(f"⟦{mark}_END⟧")
                stack.extend(reversed(node.children))
    return root.source, root.closed, "".join(out), found


def from_markers(start: str, end: str, text: str, found: list[tuple[str, str, str, str, str]]) -> str:
    known: dict[str, str] = {}
    for mark, _, opening, closing, kind in found:
        if kind == "EMPTY":
            known[f"⟦{mark}⟧"] = opening
        else:
            known[f"⟦{mark}_START⟧"], known[f"⟦{mark}_END⟧"] = opening, closing

    def markup(m: re.Match[str]) -> str:
        if m[0] not in known:
            raise ValueError(f"unknown marker {m[0]}")
        return known[m[0]]

    return start + _MARKER.sub(markup, text) + end


def marker_issues(original: str, text: str, found: list[tuple[str, str, str, str, str]]) -> list[str]:
    """Inventory, balance and protected content of a rewritten marker text against the original one."""
    wanted = [t for mark, *_, kind in found for t in ([f"⟦{mark}⟧"] if kind == "EMPTY" else [f"⟦{mark}_START⟧", f"⟦{mark}_END⟧"])]
    counts = Counter(m[0] for m in _MARKER.finditer(text))
    issues = [f"marker_count:{t}:{counts[t]}" for t in wanted if counts[t] != 1]
    issues += [f"marker_unexpected:{t}" for t in sorted(set(counts) - set(wanted))]
    stack: list[str] = []
    for m in _MARKER.finditer(text):
        if m[0].endswith("_START⟧"):
            stack.append(m[0][1:-7])
        elif m[0].endswith("_END⟧"):
            if not stack:
                issues.append(f"marker_stray_end:{m[0]}")
            elif stack[-1] != m[0][1:-5]:
                issues.append(f"marker_misnested:{stack[-1]}:{m[0][1:-5]}")
            else:
                stack.pop()
    issues += [f"marker_unclosed:{s}" for s in stack]
    for mark, *_, kind in found:
        if kind == "KEEP" and _inner(original, mark) != _inner(text, mark):
            issues.append(f"protected_changed:{mark}")
    return issues


def _inner(text: str, mark: str) -> str | None:
    a, b = text.find(f"⟦{mark}_START⟧"), text.find(f"⟦{mark}_END⟧")
    return text[a : b] if 0 <= a < b else None


def kept_spans(block: str) -> tuple[str, list[tuple[str, str]]]:
    """Raw HTML of a block with ⟦KEEP_n_START⟧text⟦KEEP_n_END⟧ for each outermost protected element, and (text with
    markers, element)."""
    root = H.parse(block)
    kept: list[tuple[str, str]] = []

    def replaced(node: H.Node) -> None:
        for i, child in enumerate(node.children):
            if child.kind == "element" and child.name in P.BOLD:
                n = len(kept) + 1
                span = f"⟦KEEP_{n}_START⟧{child.text()}⟦KEEP_{n}_END⟧"
                kept.append((span, child.html()))
                node.children[i] = H.Node("text", source=span)
            else:
                replaced(child)

    replaced(root)
    return root.html(), kept


def from_kept_spans(text: str, kept: list[tuple[str, str]]) -> str:
    for span, element in kept:
        text = text.replace(span, element)
    return text


# ---- structure -------------------------------------------------------------------------------


def structure(source: str) -> str:
    """Canonical JSON of a fragment's tags, attributes in order of name and nesting; text only as a place."""

    def of(node: H.Node) -> list:
        out: list = []
        for c in node.children:
            if c.kind == "text" and c.source.strip():
                out.append("TEXT")
            elif c.kind == "element":
                out.append([c.name, sorted(c.attrs()), of(c)])
        return out

    return json.dumps(of(H.parse(source)), ensure_ascii=False)


def protected_structure(source: str) -> str:
    """Canonical JSON of the protected elements: name, attributes, inner HTML."""
    return json.dumps(
        [[n.name, sorted(n.attrs()), "".join(c.html() for c in n.children)] for n in H.parse(source).walk() if n.kind == "element" and n.name in P.BOLD],
        ensure_ascii=False,
    )


def block_issues(original: str, candidate: str) -> list[str]:
    """Root tag, its attributes, structure and protected content of a rewritten block."""
    a, b = ([n for n in H.parse(s).children if n.kind == "element"] for s in (original, candidate))
    if len(a) != 1 or len(b) != 1:
        return ["not_one_block"]
    issues = []
    if a[0].name != b[0].name:
        issues.append(f"root_tag:{a[0].name}:{b[0].name}")
    if sorted(a[0].attrs()) != sorted(b[0].attrs()):
        issues.append("root_attributes")
    if structure(original) != structure(candidate):
        issues.append("structure")
    if protected_structure(original) != protected_structure(candidate):
        issues.append("protected_text")
    return issues


# ---- self-contained pieces -------------------------------------------------------------------


def self_contained_pieces(source: str, most: int, count: Callable[[str], int] = lambda s: len(s) // 4 + 1) -> list[str]:
    """Pieces of at most ``most`` tokens, each with the tags around it opened and closed again.

    Text is cut at white space where it can be. A start tag that doesn't fit with its surroundings
    is an error.
    """
    out: list[str] = []
    buffer: list[str] = []
    stack: list[tuple[str, str]] = []  # start tag, end tag
    filled = False

    def closing() -> str:
        return "".join(end for _, end in reversed(stack))

    def fits(more: str, extra_end: str = "") -> bool:
        return count("".join(buffer) + more + extra_end + closing()) <= most

    def flush() -> None:
        nonlocal filled
        out.append("".join(buffer) + closing())
        buffer[:] = [start for start, _ in stack]
        filled = False

    def put(piece: str, extra_end: str = "") -> None:
        nonlocal filled
        if not fits(piece, extra_end):
            if filled:
                flush()
            if not fits(piece, extra_end):
                raise ValueError("a tag with its surroundings is above the limit")
        buffer.append(piece)
        filled = True

    def write(text: str) -> None:
        nonlocal filled
        while text:
            if fits(text):
                buffer.append(text)
                filled = True
                return
            if filled:
                flush()
                continue
            low, high = 0, len(text)
            while low < high:
                mid = (low + high + 1) // 2
                low, high = (mid, high) if fits(text[:mid]) else (low, mid - 1)
            if not low:
                raise ValueError("the tags around a text are above the limit")
            ends = [m.end() for m in re.finditer(r"\s+", text[:low])]
            if ends and ends[-1] >= 0.6 * low:
                low = ends[-1]
            entity = text.rfind("&", max(0, low - 10), low)
            if entity > 0 and ";" not in text[entity:low] and ";" in text[low : low + 10]:
                low = entity
            buffer.append(text[:low])
            filled = True
            text = text[low:]
            if text:
                flush()

    walk: list[H.Node | None] = list(reversed(H.parse(source).children))
    while walk:
        node = walk.pop()
        if node is None:
            buffer.append(stack.pop()[1])
        elif node.kind == "text":
            write(node.source)
        elif node.kind == "element" and node.name not in H.VOID and node.name not in H.RAW:
            end = node.closed or f"</{node.name}>"
            put(node.source, end)
            stack.append((node.source, end))
            walk.append(None)
            walk.extend(reversed(node.children))
        else:
            put(node.html())
    if "".join(buffer).strip():
        out.append("".join(buffer))
    return out


def iter_tags(source: str) -> Iterator[str]:
    return (name for kind, name, _ in H.events(source) if kind in ("start", "void"))


# ---- deterministic rules ---------------------------------------------------------------------


def numbered_lists(source: str) -> str:
    """Every ul as an ol."""
    return "".join(re.sub(r"(?i)^(</?)ul\b", r"\1ol", raw) if kind in ("start", "end") and name == "ul" else raw for kind, name, raw in H.events(source))


def editable_replaced(source: str, change: Callable[[str], str]) -> str:
    """The source with a change of the text nodes that may be edited: not under a protected or skipped element."""
    root = H.parse(source)
    for node in root.walk():
        if node.kind == "text" and node.source.strip():
            path = node.path()
            if not (set(path) & set(P.PROTECTED_ANCESTORS)) and (path[-1] if path else "") not in P.SKIPPED_PARENTS:
                old = H.unescape(node.source)
                new = change(old)
                if new != old:
                    node.source = H.escape(new)
    return root.html()


def canonical_in_html(source: str, names: tuple[str, ...]) -> str:
    """Configured names with a capital first letter, in editable text only."""

    def change(text: str) -> str:
        for name in names:
            text = re.sub(rf"\b{re.escape(name)}\b", name[:1].upper() + name[1:], text, flags=re.I)
        return text

    return editable_replaced(source, change) if names else source
