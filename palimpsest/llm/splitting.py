"""Problem 4: items above a size limit cut into overlapping pieces at natural boundaries.

Possible cuts are the ends of sentences, lines and, in HTML, block elements. Lexical cohesion says
which of them is a change of topic: at each possible cut the word counts of the units in a block
before it and in a block behind it are compared by cosine; the depth of a cut is how far its
similarity lies below the nearest peaks on both sides. In each size window the deepest cut is
taken, a later one on ties; where a window holds none, a blank, and where it holds no blank either,
the limit itself. Every piece but the first begins with the last ``overlap`` characters of the one
before.
"""

from __future__ import annotations

import re
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Units in the blocks that are compared, and classes that words are counted in.
BLOCK_UNITS = 6
WORD_CLASSES = 256
#: Possible cuts whose blocks are held at once.
UNITS_AT_ONCE = 2048

_SENTENCE = re.compile(r"[.!?…][\"'”’»)\]]*\s+|[。！？]+|;\s+|\n+")
_ELEMENT = re.compile(
    r"</(?:p|li|ul|ol|h[1-6]|div|table|tr|td|th|pre|blockquote|section|article|head|script)\s*>\s*|<br\s*/?>\s*|<hr\s*/?>\s*", re.I
)
_TAG = re.compile(r"<[^<>]*>|&#?\w+;")
_WORD = re.compile(r"[^\W\d_]{2,}")
_BLANK = re.compile(r"\s+")


def possible_cuts(text: str, html: bool) -> np.ndarray:
    """Offsets behind natural boundaries in order, none inside a tag or character entity."""
    cuts = np.fromiter((m.end() for m in _SENTENCE.finditer(text)), np.int64)
    if html:
        inside = _inside_tags(text)
        inside[len(text)] = False
        cuts = np.r_[cuts[~inside[cuts]], np.fromiter((m.end() for m in _ELEMENT.finditer(text)), np.int64)]
    cuts = np.unique(cuts)
    return cuts[(cuts > 0) & (cuts < len(text))]


def _inside_tags(text: str) -> np.ndarray:
    """For each offset whether a cut before it would break a tag or entity."""
    out = np.zeros(len(text) + 1, bool)
    for m in _TAG.finditer(text):
        out[m.start() + 1 : m.end()] = True
    return out


def _counts(text: str, bounds: np.ndarray) -> np.ndarray:
    """Words of each class in each unit between neighbouring bounds."""
    counts = np.zeros((len(bounds) - 1, WORD_CLASSES))
    for i, (a, b) in enumerate(zip(bounds[:-1].tolist(), bounds[1:].tolist())):
        for w in _WORD.findall(_TAG.sub(" ", text[a:b]).lower()):
            counts[i, zlib.crc32(w.encode("utf-8", "replace")) % WORD_CLASSES] += 1
    return counts


def similarities(text: str, cuts: np.ndarray) -> np.ndarray:
    """Cosine of the word counts of the units before and behind each possible cut.

    Only the units around UNITS_AT_ONCE cuts are counted at a time, so a text of any length takes the same memory.
    """
    bounds = np.r_[0, cuts, len(text)]
    units = len(bounds) - 1
    alike = np.zeros(len(cuts))
    for first in range(0, len(cuts), UNITS_AT_ONCE):
        last = min(first + UNITS_AT_ONCE, len(cuts))
        begin, end = max(0, first + 1 - BLOCK_UNITS), min(units, last + BLOCK_UNITS)
        total = np.vstack([np.zeros(WORD_CLASSES), np.cumsum(_counts(text, bounds[begin : end + 1]), 0)])
        at = np.arange(first + 1, last + 1)
        before = total[at - begin] - total[np.maximum(at - BLOCK_UNITS, 0) - begin]
        behind = total[np.minimum(at + BLOCK_UNITS, units) - begin] - total[at - begin]
        norm = np.linalg.norm(before, axis=1) * np.linalg.norm(behind, axis=1)
        alike[first:last] = (before * behind).sum(1) / np.maximum(norm, 1e-9)
    return alike


def cohesion_depths(text: str, cuts: np.ndarray) -> np.ndarray:
    """Depth of the similarity valley at each possible cut."""
    alike = similarities(text, cuts)
    left, right = alike.copy(), alike.copy()
    for i in range(1, len(alike)):
        left[i] = max(alike[i], left[i - 1]) if alike[i - 1] >= alike[i] else alike[i]
    for i in range(len(alike) - 2, -1, -1):
        right[i] = max(alike[i], right[i + 1]) if alike[i + 1] >= alike[i] else alike[i]
    return left + right - 2 * alike


def pieces(text: str | None, limit: int, overlap: int, html: bool = False) -> list[tuple[int, int, str]]:
    """(start, stop, kind of the cut at its end) of the pieces: topic, blank, limit, or end for the last.

    A null or empty text has none, one of at most the limit is one piece. No piece is longer than
    the limit, consecutive ones share exactly ``overlap`` characters, and together they are the text.
    """
    if limit <= overlap or overlap < 0:
        raise ValueError("the limit must be larger than the overlap")
    if not text:
        return []
    if len(text) <= limit:
        return [(0, len(text), "end")]
    where = possible_cuts(text, html)
    depths = cohesion_depths(text, where)
    inside = _inside_tags(text) if html else None
    out: list[tuple[int, int, str]] = []
    start = 0
    while len(text) - start > limit:
        last = start + limit
        first = start + max(limit // 2, overlap + 1)
        a, b = np.searchsorted(where, (first, last + 1))
        if a < b:
            best = b - 1 - int(np.argmax(depths[a:b][::-1]))
            stop, kind = int(where[best]), "topic"
        else:
            ends = [m.end() for m in _BLANK.finditer(text, start + overlap + 1, last)]
            ends = [e for e in ends if e > start + overlap and (inside is None or not inside[e])]
            stop, kind = (ends[-1], "blank") if ends else (last, "limit")
            if kind == "limit" and inside is not None and inside[stop]:
                open_at = text.rfind("<", start + overlap + 1, stop)
                if open_at > 0 and not inside[open_at]:
                    stop = open_at
        out.append((start, stop, kind))
        start = stop - overlap
    out.append((start, len(text), "end"))
    return out


def split_items(df: DataFrame, text: str, keys: list[str], limit: int, overlap: int, html: bool = False) -> DataFrame:
    """keys, piece (from 0), start, stop, cut and text of the pieces of every value above the limit.

    Sizes and offsets are Unicode code points. Null values and values of at most the limit give no
    row; repeated rows repeat their pieces; extra columns are not read.
    """
    name = "__text__"
    taken = df.where(F.length(text) > limit).select(*keys, F.col(text).alias(name))
    kinds = dict(taken.dtypes)
    schema = ", ".join(f"`{k}` {kinds[k]}" for k in keys) + ", piece int, start int, stop int, cut string, text string"

    def run(batches):
        for batch in batches:
            at = batch.schema.get_field_index
            for i, t in enumerate(batch.column(at(name)).to_pylist()):
                found = pieces(t, limit, overlap, html)
                take = pa.array([i] * len(found), pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [
                        *(batch.column(at(k)).take(take) for k in keys),
                        pa.array(range(len(found)), pa.int32()),
                        pa.array([a for a, _, _ in found], pa.int32()),
                        pa.array([b for _, b, _ in found], pa.int32()),
                        pa.array([c for _, _, c in found], pa.string()),
                        pa.array([t[a:b] for a, b, _ in found], pa.string()),
                    ],
                    [*keys, "piece", "start", "stop", "cut", "text"],
                )

    return taken.mapInArrow(run, schema)
