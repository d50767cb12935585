"""Cutting and packing one document's text. Plain Python; sizes are characters."""

from __future__ import annotations

import bisect
import difflib
import itertools
import re
from collections.abc import Callable, Iterator, Sequence

from palimpsest.functions import patterns as P

_SOLID = re.compile(r"\S")


# Where a text may be cut is worked out first, as places in order; which of them are taken is a
# search among the places that all cutters share.


def cut_ranges(size: int, most: int, places: Sequence[int], least: int, resume: Callable[[int], int] = int) -> Iterator[tuple[int, int]]:
    """Ranges of at most ``most`` that cover 0 to size: each ends at the last place behind its first ``least``, at the
    limit where there is none; the next begins where ``resume`` says."""
    at = 0
    while size - at > most:
        near = bisect.bisect_right(places, at + most) - 1
        stop = places[near] if near >= 0 and places[near] > at + least else at + most
        yield at, stop
        at = resume(stop)
    if at < size:
        yield at, size


def packed_ranges(sizes: Sequence[int], most: int, glue: int) -> Iterator[tuple[int, int]]:
    """Ranges of neighbours that with ``glue`` between them take at most ``most`` together; a larger one is alone."""
    upto = [0, *itertools.accumulate(n + glue for n in sizes)]
    at = 0
    while at < len(sizes):
        stop = max(at + 1, bisect.bisect_right(upto, upto[at] + most + glue) - 1)
        yield at, stop
        at = stop


def joined_upto(parts: Sequence[str], most: int, glue: str) -> Iterator[str]:
    """Neighbouring parts joined as long as they stay within ``most``; a larger part is alone."""
    for a, b in packed_ranges([len(p) for p in parts], most, len(glue)):
        yield glue.join(parts[a:b])


def cut_at_blanks(text: str, most: int) -> list[str]:
    """Pieces of at most ``most`` characters: at the last blank of the second half, else anywhere; stripped."""
    behind = [m.end() for m in re.finditer(" ", text)]
    solid = lambda at: m.start() if (m := _SOLID.search(text, at)) else len(text)
    found = (text[a:b].strip() for a, b in cut_ranges(len(text), most, behind, most // 2 + 1, solid))
    return [piece for piece in found if piece]


def sentence_pieces(paragraph: str, most: int) -> list[str]:
    """Sentences joined up to ``most``; a longer sentence is cut at blanks, alone."""
    every = [s for s in map(str.strip, re.split(P.SENTENCE_END, paragraph.strip())) if s]
    out: list[str] = []
    for large, run in itertools.groupby(every, lambda s: len(s) > most):
        out += itertools.chain.from_iterable(cut_at_blanks(s, most) for s in run) if large else joined_upto(list(run), most, " ")
    return out


def rewrite_pieces(text: str | None, target: int = P.TARGET_CHARS, hard: int = P.HARD_CHARS) -> list[str]:
    """Paragraphs packed towards the target size, none above the hard limit."""
    within = lambda piece, cut: [piece] if len(piece) <= hard else cut(piece, hard)
    paragraphs = [p for p in map(str.strip, re.split(r"\n\s*\n", (text or "").strip())) if p]
    parts = [piece for p in paragraphs for piece in within(p, sentence_pieces)]
    return [piece for pack in joined_upto(parts, target, "\n\n") for piece in within(pack, cut_at_blanks)]


def overlapping_chunks(parts: Sequence[str], most: int, overlap: int) -> list[tuple[int, int, str]]:
    """(first, last, text) of chunks of paragraphs; each begins ``overlap`` paragraphs before the last one's end, but
    always moves on."""
    out, start = [], 0
    while start < len(parts):
        stop, size = start, 0
        while stop < len(parts) and (stop == start or size + 1 + len(parts[stop]) <= most):
            size += len(parts[stop]) + (stop > start)
            stop += 1
        out.append((start, stop - 1, "\n".join(parts[start:stop]).strip()))
        if stop == len(parts):
            break
        start = max(start + 1, stop - overlap)
    return out


def plain_pieces(text: str, most: int) -> list[str]:
    """Pieces that together are the text: behind the last line end, blank, stop or comma of the second half, else
    at the limit."""
    behind = [m.end() for m in re.finditer(r"[\n .;,]", text)]
    return [text[a:b] for a, b in cut_ranges(len(text), most, behind, most // 2)]


def token_safe_chunks(text: str, most: int, token: str = P.GLOBAL_TOKEN) -> list[str]:
    """Chunks that together are the text and never cut a token."""
    if most <= 0:
        raise ValueError("the chunk size must be above zero")
    atoms: list[str] = []
    at = 0
    for m in re.finditer(token, text):
        atoms += plain_pieces(text[at : m.start()], most)
        atoms.append(m[0])
        at = m.end()
    atoms += plain_pieces(text[at:], most)
    return list(joined_upto([a for a in atoms if a], most, ""))


def fitted_contexts(before: str, current: str, behind: str, budget: int, prompt: Callable[[str, str, str], str]) -> tuple[str, str]:
    """The end of the text before and the start of the text behind that fit into a prompt's budget with the current
    chunk: half of the room each, all of it for one if the other is empty."""
    room = budget - len(prompt("", current, ""))
    if room < 0:
        raise ValueError("the chunk alone is above the budget")
    left = room if not behind else room // 2 if before else 0
    right = room - left if behind else 0
    a, b = before[-left:] if left else "", behind[:right]
    while len(prompt(a, current, b)) > budget:
        if b:
            b = b[:-100]
        elif a:
            a = a[100:]
        else:
            raise ValueError("the prompt doesn't fit the budget")
    return a, b


def marked_sections(paragraphs: Sequence[str], target: int = 6000, overlap: int = 500) -> list[tuple[int, int, str]]:
    """(first, last, text) of sections of whole paragraphs with a [[Pn]] line before each; ranges are distinct."""
    marked = [f"[[P{i}]]\n{p}" for i, p in enumerate(paragraphs)]
    out: list[tuple[int, int, str]] = []
    start = 0
    while start < len(marked):
        stop, size = start, 0
        while stop < len(marked) and (stop == start or size + 2 + len(marked[stop]) <= target):
            size += len(marked[stop]) + 2 * (stop > start)
            stop += 1
        out.append((start, stop - 1, "\n\n".join(marked[start:stop])))
        if stop == len(marked):
            break
        back, size = stop, 0
        while back > start + 1 and size + len(marked[back - 1]) <= overlap:
            back -= 1
            size += len(marked[back]) + 2
        start = back
    return out


def unified_diff(old: str | None, new: str | None, most: int = 100_000, mark: str = "\n...<diff_truncated>") -> str:
    """Unified diff with two lines of context, cut at a limit with a mark."""
    lines = difflib.unified_diff((old or "").splitlines(), (new or "").splitlines(), "original_html", "rewritten_html", lineterm="", n=2)
    text = "\n".join(lines)
    return text if len(text) <= most else text[:most] + mark
