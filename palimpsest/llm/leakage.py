"""Problem 8: passages of evaluation items inside documents, by q-gram filtering and banded alignment.

Texts are compared in the form of problem 9, case-folded and without anything but letters and
digits. Every document's q-grams are looked up among the items' q-grams; a shared q-gram lies on
the diagonal document position - item position. By the q-gram lemma a passage of length L with at
most k edits shares at least L + 1 - q - k * q q-grams with its item, all within k diagonals of each
other, so the shared q-grams are counted in overlapping bands of diagonals and only bands that meet
the bound are aligned, in a band around them. The alignment decides: a case must hold, on a diagonal
of the band, ``min_words`` consecutive words of the item without an edit; all of the band is looked
at, so a longer but poorer stretch doesn't hide a whole one.

The items are a stated query set: they are sent to the executors in blocks of at most
``block_chars`` characters, and each block is held against all documents.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from palimpsest.llm.lookalike import normal_forms

Q = 8
EDITS = 2
MIN_WORDS = 10
BLOCK_CHARS = 2_000_000
CHUNK_CHARS = 1_000_000
_BASE = np.uint64(0x9E3779B97F4A7C15)
_BLOOM_BITS = 22


def squeezed(texts: list[str | None]) -> list[str]:
    """Letters and digits of the case-folded form; empty for null."""
    return ["".join(filter(str.isalnum, (t or "").casefold())) for t in normal_forms(texts)]


def item_words(text: str) -> list[str]:
    """The item's words, each squeezed; those without a letter or digit are left out."""
    form = normal_forms([text])[0] or ""
    return [w for w in ("".join(filter(str.isalnum, w)) for w in form.casefold().split()) if w]


def _hashes(cps: np.ndarray) -> np.ndarray:
    """Rolling hash of the q-gram at each position."""
    n = len(cps) - Q + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out = np.zeros(n, np.uint64)
    for j in range(Q):
        out = out * _BASE + cps[j : j + n]
    return out ^ (out >> np.uint64(29))


def _cps(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Code points of the texts with a zero behind each, and the texts' starts."""
    lens = np.array([len(t) + 1 for t in texts], np.int64)
    cps = np.frombuffer(("\0".join(texts) + "\0").encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    return cps, np.cumsum(lens) - lens


@dataclass
class Index:
    """q-grams of a block of items with their postings, and what verification needs."""

    ids: list
    text: list[str]
    #: For each letter of an item the number of the word that ends with it, or -1, and of the first word from it on.
    ends: list[np.ndarray]
    next_word: list[np.ndarray]
    #: Letters of the shortest run of words that is a case, and the q-grams that a band must share.
    shortest: np.ndarray
    bound: np.ndarray
    keys: np.ndarray
    first: np.ndarray
    posting_item: np.ndarray
    posting_at: np.ndarray

    @staticmethod
    def build(ids: list, texts: list[str | None], min_words: int = MIN_WORDS, edits: int = EDITS) -> Index:
        kept = [(i, w) for i, w in ((i, item_words(t or "")) for i, t in zip(ids, texts)) if len(w) >= min_words]
        words = [w for _, w in kept]
        text = ["".join(w) for w in words]
        shortest = [min(sum(map(len, w[a : a + min_words])) for a in range(len(w) - min_words + 1)) for w in words]
        bound = np.array([max(1, s + 1 - Q - edits * Q) for s in shortest], np.int64)
        ends, next_word = [], []
        for w in words:
            stops = np.cumsum([len(x) for x in w])
            end = np.full(stops[-1], -1, np.int32)
            end[stops - 1] = np.arange(len(w))
            ends.append(end)
            next_word.append(np.searchsorted(np.r_[0, stops[:-1]], np.arange(stops[-1])).astype(np.int32))
        hashes, items, at = [], [], []
        for n, t in enumerate(text):
            h = _hashes(_cps([t])[0][:-1])
            hashes.append(h)
            items.append(np.full(len(h), n))
            at.append(np.arange(len(h)))
        every = np.concatenate(hashes) if hashes else np.zeros(0, np.uint64)
        order = np.argsort(every, kind="stable")
        keys, first = np.unique(every[order], return_index=True)
        return Index(
            [i for i, _ in kept], text, ends, next_word, np.array(shortest, np.int64), bound, keys, np.r_[first, len(every)].astype(np.int64),
            (np.concatenate(items) if items else np.zeros(0, np.int64))[order],
            (np.concatenate(at) if at else np.zeros(0, np.int64))[order],
        )

    def bloom(self) -> np.ndarray:
        out = np.zeros(1 << _BLOOM_BITS, bool)
        out[(self.keys >> np.uint64(64 - _BLOOM_BITS)).astype(np.int64)] = True
        return out


def regions(index: Index, bloom: np.ndarray, texts: list[str], edits: int) -> list[tuple[int, int, int]]:
    """(text, item, diagonal) of the bands that share enough q-grams; squeezed texts."""
    cps, starts = _cps(texts)
    h = _hashes(cps)
    if not len(h) or not len(index.keys):
        return []
    at = np.flatnonzero(bloom[(h >> np.uint64(64 - _BLOOM_BITS)).astype(np.int64)])
    where = np.minimum(np.searchsorted(index.keys, h[at]), len(index.keys) - 1)
    hit = index.keys[where] == h[at]
    at, where = at[hit], where[hit]
    if not len(at):
        return []
    n = index.first[where + 1] - index.first[where]
    width = 2 * (edits + 1)
    # a q-gram that many items have is no limit: pairs are counted in slices, each text, item and band is summed after
    upto = np.cumsum(n)
    low = max(map(len, index.text))
    bits = int((len(cps) + low + width) // width + 1).bit_length()
    counted: list[list[tuple[np.ndarray, np.ndarray]]] = [[], []]
    begin = 0
    while begin < len(at):
        stop = max(begin + 1, int(np.searchsorted(upto, (upto[begin - 1] if begin else 0) + SLICE_PAIRS)))
        some = slice(begin, stop)
        src = np.repeat(np.arange(begin, stop), n[some])
        k = index.first[where[src]] + np.arange(len(src)) - np.repeat(np.cumsum(n[some]) - n[some], n[some])
        pos = at[src]
        text = np.searchsorted(starts, pos, "right") - 1
        pair = (text * len(index.ids) + index.posting_item[k]) << bits
        diagonal = pos - starts[text] - index.posting_at[k] + low
        for out, shift in zip(counted, (0, edits + 1)):
            out.append(np.unique(pair | ((diagonal + shift) // width), return_counts=True))
        begin = stop
    found = set()
    for parts, shift in zip(counted, (0, edits + 1)):
        keys, back = np.unique(np.concatenate([p[0] for p in parts]), return_inverse=True)
        size = np.bincount(back, np.concatenate([p[1] for p in parts]))
        pair, band = keys >> bits, keys & ((1 << bits) - 1)
        good = np.flatnonzero(size >= index.bound[pair % len(index.ids)])
        found |= set(zip((pair[good] // len(index.ids)).tolist(), (pair[good] % len(index.ids)).tolist(), (band[good] * width - shift + width // 2 - low).tolist()))
    out: list[tuple[int, int, int]] = []
    for t, i, d in sorted(found):
        if not out or out[-1][:2] != (t, i) or d - out[-1][2] > edits + 1:
            out.append((t, i, d))
    return out


#: Regions aligned at once.
ALIGNED = 2048
#: Pairs of a text's and an item's q-gram that are held at once.
SLICE_PAIRS = 4_000_000


def aligned(index: Index, items: list[int], texts: list[str], diagonals: list[int], edits: int) -> tuple[np.ndarray, np.ndarray]:
    """Banded alignments of items with texts around the diagonals, all side by side: the best local score of each and
    the most consecutive words of the item that it holds without an edit. A letter kept counts 1, an edit -2."""
    half = 3 * (edits + 1)
    width = 2 * half + 1
    lens = np.array([len(index.text[i]) for i in items])
    lo = np.array(diagonals) - half
    shape = (len(items), int(lens.max()))
    a = np.zeros(shape, np.uint32)
    ends, next_word = np.full(shape, -1, np.int32), np.zeros(shape, np.int32)
    padded = np.full((len(items), shape[1] + width), 0xFFFFFFFF, np.uint32)
    for r, (i, text) in enumerate(zip(items, texts)):
        n = lens[r]
        a[r, :n] = np.frombuffer(index.text[i].encode("utf-32-le", "surrogatepass"), np.uint32)
        ends[r, :n], next_word[r, :n] = index.ends[i], index.next_word[i]
        src, dst = max(int(lo[r]), 0), max(-int(lo[r]), 0)
        part = text[src : max(src, int(lo[r]) + n + width)]
        padded[r, dst : dst + len(part)] = np.frombuffer(part.encode("utf-32-le", "surrogatepass"), np.uint32)
    ramp = 2 * np.arange(width, dtype=np.int32)
    shortest = index.shortest[items]
    row, run = np.zeros((len(items), width), np.int32), np.zeros((len(items), width), np.int32)
    best, words = np.zeros(len(items), np.int32), np.zeros(len(items), np.int32)
    for i in range(shape[1]):
        same = padded[:, i : i + width] == a[:, i, None]
        new = row + np.where(same, 1, -2).astype(np.int32)
        new[:, :-1] = np.maximum(new[:, :-1], row[:, 1:] - 2)
        np.maximum(new, 0, out=new)
        row = np.maximum.accumulate(new + ramp, axis=1) - ramp
        np.maximum(best, row.max(1), out=best, where=i < lens)
        run = (run + 1) * same
        longest = run.max(1)
        full = np.flatnonzero((longest >= shortest) & (ends[:, i] >= 0))
        if len(full):
            whole = ends[full, i] - next_word[full, i - longest[full] + 1] + 1
            words[full] = np.maximum(words[full], whole)
    return best, words


def search(index: Index, texts: list[str | None], min_words: int = MIN_WORDS, edits: int = EDITS) -> list[list[tuple[int, int, int]]]:
    """For each text its leaked items: (item's place, words in a row, score of the alignment)."""
    bloom = index.bloom()
    out: list[list[tuple[int, int, int]]] = [[] for _ in texts]
    at = 0
    while at < len(texts):
        size, end = 0, at
        while end < len(texts) and (end == at or size + len(texts[end] or "") <= CHUNK_CHARS):
            size += len(texts[end] or "")
            end += 1
        flat = squeezed(texts[at:end])
        done: dict[tuple[int, int], tuple[int, int]] = {}
        kept = regions(index, bloom, flat, edits)
        for n in range(0, len(kept), ALIGNED):
            some = kept[n : n + ALIGNED]
            found = aligned(index, [i for _, i, _ in some], [flat[t] for t, _, _ in some], [d for *_, d in some], edits)
            for (t, i, _), score, run in zip(some, *(x.tolist() for x in found)):
                if run >= min_words:
                    known = done.get((t, i), (0, 0))
                    done[t, i] = (max(known[0], run), max(known[1], score))
        for (t, i), (run, score) in done.items():
            out[at + t].append((i, run, score))
        at = end
    return out


def leaks(
    docs: DataFrame, items: DataFrame, doc_key: str, item_key: str, text: str = "text", item_text: str = "text",
    min_words: int = MIN_WORDS, edits: int = EDITS, block_chars: int = BLOCK_CHARS,
) -> DataFrame:
    """doc_key, item_key, words (most in a row) and score for every document with a passage of an item.

    Null and blank texts and items of fewer than min_words words are in no row. Repeated documents
    are each a case; repeated rows of one key give one row. An empty table gives an empty result.
    """
    spark = docs.sparkSession
    wanted = items.where(F.col(item_text).isNotNull()).select(F.col(item_key).alias("k"), F.col(item_text).alias("t"))
    total = wanted.agg(F.sum(F.length("t")).alias("n")).first().n or 0
    blocks = max(1, -(-total // block_chars))
    taken = docs.where(F.col(text).isNotNull()).select(F.col(doc_key).alias("d"), F.col(text).alias("t"))
    kind, own = dict(wanted.dtypes)["k"], dict(taken.dtypes)["d"]
    out = None
    for block in range(blocks):
        rows = wanted.where(F.pmod(F.xxhash64("k"), F.lit(blocks)) == block).collect()
        shared = spark.sparkContext.broadcast(Index.build([r.k for r in rows], [r.t for r in rows], min_words, edits))

        def run(batches, shared=shared):
            index = shared.value
            for batch in batches:
                keys = batch.column(0)
                found = [(n, *f) for n, fs in enumerate(search(index, batch.column(1).to_pylist(), min_words, edits)) for f in fs]
                columns = list(zip(*found)) or [(), (), (), ()]
                yield pa.RecordBatch.from_arrays(
                    [
                        keys.take(pa.array(columns[0], pa.int64())),
                        pa.array([index.ids[i] for i in columns[1]], ITEM_TYPES[kind]),
                        pa.array(columns[2], pa.int32()),
                        pa.array(columns[3], pa.int32()),
                    ],
                    ["d", "i", "words", "score"],
                )

        part = taken.mapInArrow(run, f"d {own}, i {kind}, words int, score int")
        out = part if out is None else out.unionByName(part)
    best = out.groupBy("d", "i").agg(F.max("words").alias("words"), F.max("score").alias("score"))
    return best.select(F.col("d").alias(doc_key), F.col("i").alias(item_key), "words", "score")


ITEM_TYPES = {"bigint": pa.int64(), "int": pa.int32(), "string": pa.string()}
