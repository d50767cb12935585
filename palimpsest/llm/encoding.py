"""Problem 7: encoding of a corpus with a public byte-level BPE tokenizer.

A text is cut into words by the tokenizer's pattern and each word is encoded alone, so a lexicon of
frequent words saves the merging. The lexicon is a minimal acyclic automaton over the words' bytes:
words share prefixes and, as states with the same right language are merged, suffixes. Each
transition carries the number of words that sort before its subtree in its state, so the sum along
a word's path is the word's number (its output), which points into the arrays of token ids. The
automaton is compiled on the driver from the corpus's most frequent words (counted over all texts,
at most ``lexicon_size``), written to the folder all executors share, handed out as a file of the
job, and memory-mapped by every worker; all words of a batch are followed through it at once.
Unseen words are merged exactly, by rank, with a heap.
"""

from __future__ import annotations

import base64
import heapq
import os
import uuid
from collections.abc import Iterable
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark import SparkFiles
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from palimpsest.session import put

#: Folder of the public vocabulary files; a parameter of every operator here.
TOKENIZERS = "/opt/tokenizers"
DEFAULT = "byte_bpe_50k"
LEXICON_SIZE = 50_000
#: Fixed value: the word pattern of the public byte-level tokenizers, for the regex module and for Java.
PATTERN = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def ranks(name: str = DEFAULT, folder: str = TOKENIZERS) -> dict[bytes, int]:
    """The vocabulary: token bytes to id, which is the merge rank."""
    with open(os.path.join(folder, f"{name}.tiktoken"), "rb") as file:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}


def merge(word: bytes, vocabulary: dict[bytes, int]) -> list[int]:
    """Ids of one word: the adjacent pair of the lowest rank is merged, leftmost first, until none is known."""
    if word in vocabulary:
        return [vocabulary[word]]
    n = len(word)
    left, right = list(range(-1, n - 1)), list(range(1, n + 1))
    end = list(range(1, n + 1))
    alive = [True] * n

    def push(i: int) -> None:
        j = right[i]
        if j < n:
            rank = vocabulary.get(word[i : end[j]])
            if rank is not None:
                heapq.heappush(heap, (rank, i, end[j]))

    heap: list[tuple[int, int, int]] = []
    for i in range(n - 1):
        push(i)
    while heap:
        _, i, stop = heapq.heappop(heap)
        if not alive[i] or right[i] >= n or end[right[i]] != stop:
            continue
        j = right[i]
        alive[j] = False
        end[i] = stop
        right[i] = right[j]
        if right[i] < n:
            left[right[i]] = i
        push(i)
        if left[i] >= 0:
            push(left[i])
    return [vocabulary[word[i : end[i]]] for i in range(n) if alive[i]]


class Lexicon:
    """The automaton as arrays: sorted transition keys (state * 256 + byte), their targets and outputs, which states
    end a word, and the ids of each word by its number."""

    FIELDS = ("keys", "targets", "outputs", "final", "offsets", "ids")

    def __init__(self, arrays: dict[str, np.ndarray]):
        self.__dict__.update(arrays)

    @staticmethod
    def compile(words: Iterable[bytes], vocabulary: dict[bytes, int]) -> Lexicon:
        """Build from any words; duplicates and the empty word are left out."""
        ordered = sorted(set(words) - {b""})
        register: dict[tuple, int] = {}
        size, kept = [], []  # words below a state, its (final, transitions)

        def closed(node: list) -> int:
            sign = (node[0], tuple(node[1]))
            if sign not in register:
                register[sign] = len(kept)
                kept.append(sign)
                size.append(node[0] + sum(size[t] for _, t in node[1]))
            return register[sign]

        path: list[list] = [[0, []]]
        before = b""
        for word in ordered:
            common = len(os.path.commonprefix([before, word]))
            for depth in range(len(before), common, -1):
                path[depth - 1][1].append((before[depth - 1], closed(path.pop())))
            for _ in word[common:]:
                path.append([0, []])
            path[-1][0] = 1
            before = word
        for depth in range(len(before), 0, -1):
            path[depth - 1][1].append((before[depth - 1], closed(path.pop())))
        root = closed(path[0])
        order = {root: 0} | {s: i + 1 for i, s in enumerate(s for s in range(len(kept)) if s != root)}
        keys, targets, outputs, final = [], [], [], np.zeros(len(kept), bool)
        for s, (last, moves) in enumerate(kept):
            final[order[s]] = last
            skipped = last
            for byte, target in moves:
                keys.append(order[s] * 256 + byte)
                targets.append(order[target])
                outputs.append(skipped)
                skipped += size[target]
        by = np.argsort(np.array(keys, np.int64))
        found = [merge(w, vocabulary) for w in ordered]
        return Lexicon(
            {
                "keys": np.array(keys, np.int64)[by],
                "targets": np.array(targets, np.int64)[by],
                "outputs": np.array(outputs, np.int64)[by],
                "final": final,
                "offsets": np.cumsum([0, *map(len, found)]),
                "ids": np.array([i for f in found for i in f], np.int32),
            }
        )

    def numbers(self, words: list[bytes]) -> np.ndarray:
        """The number of each word, -1 for one that isn't in the lexicon."""
        count = len(words)
        lens = np.fromiter(map(len, words), np.int64, count)
        if not count or not len(self.keys):
            return np.full(count, -1)
        flat = np.frombuffer(b"".join(words), np.uint8).astype(np.int64)
        starts = np.cumsum(lens) - lens
        state, number = np.zeros(count, np.int64), np.zeros(count, np.int64)
        live = np.flatnonzero(lens > 0)
        state[lens == 0] = -1
        depth = 0
        while len(live):
            key = state[live] * 256 + flat[starts[live] + depth]
            at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
            hit = self.keys[at] == key
            state[live[~hit]] = -1
            live, at = live[hit], at[hit]
            state[live] = self.targets[at]
            number[live] += self.outputs[at]
            depth += 1
            live = live[lens[live] > depth]
        ok = state >= 0
        ok[ok] = self.final[state[ok]]
        return np.where(ok, number, -1)

    def save(self, path: str) -> None:
        """One file: a head of lengths and types, then the arrays, each at a multiple of 64 bytes."""
        with open(path, "wb") as file:
            file.write(self.dump())

    def dump(self) -> bytes:
        parts = [np.ascontiguousarray(getattr(self, f)) for f in self.FIELDS]
        head = np.array([[len(p), p.dtype.itemsize] for p in parts], np.int64).tobytes().ljust(128, b"\0")
        return head + b"".join(p.tobytes().ljust(-(-p.nbytes // 64) * 64, b"\0") for p in parts)

    @staticmethod
    def load(path: str) -> Lexicon:
        """Memory-map a saved lexicon."""
        whole = np.memmap(path, np.uint8, "r")
        head = whole[: 16 * len(Lexicon.FIELDS)].view(np.int64).reshape(-1, 2)
        kinds = {"final": np.bool_, "ids": np.int32}
        at, out = 128, {}
        for (n, width), name in zip(head.tolist(), Lexicon.FIELDS):
            kind = np.dtype(kinds.get(name, np.int64))
            out[name] = whole[at : at + n * width].view(kind)
            at += -(-n * width // 64) * 64
        return Lexicon(out)


class Encoder:
    """Encodes texts: lexicon first, exact merging for the rest, remembered for the worker's life up to a bound."""

    REMEMBERED = 200_000

    def __init__(self, lexicon: Lexicon | None, vocabulary: dict[bytes, int], pattern: str = PATTERN):
        self.lexicon, self.vocabulary = lexicon, vocabulary
        self.words = regex.compile(pattern).findall
        self.known: dict[str, list[int]] = {}

    def encode(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """Offsets and ids of all texts; nothing for null and empty texts."""
        each = [self.words(t) if t else [] for t in texts]
        fresh = list(dict.fromkeys(w for ws in each for w in ws if w not in self.known))
        if len(self.known) + len(fresh) > self.REMEMBERED:
            self.known.clear()
            fresh = list(dict.fromkeys(w for ws in each for w in ws))
        as_bytes = [w.encode("utf-8", "replace") for w in fresh]
        if self.lexicon is not None and fresh:
            numbers = self.lexicon.numbers(as_bytes)
            offsets, ids = self.lexicon.offsets, self.lexicon.ids
            for w, b, n in zip(fresh, as_bytes, numbers.tolist()):
                self.known[w] = ids[offsets[n] : offsets[n + 1]].tolist() if n >= 0 else merge(b, self.vocabulary)
        else:
            for w, b in zip(fresh, as_bytes):
                self.known[w] = merge(b, self.vocabulary)
        known = self.known
        out: list[int] = []
        ends = [0]
        for ws in each:
            for w in ws:
                out += known[w]
            ends.append(len(out))
        return np.array(ends, np.int32), np.array(out, np.int32)


def frequent_words(docs: DataFrame, text: str, size: int = LEXICON_SIZE) -> list[str]:
    """The most frequent words over all texts, ties by the word itself."""
    each = docs.where(F.col(text).isNotNull()).select(
        F.explode(F.regexp_extract_all(F.col(text), F.lit(PATTERN), F.lit(0))).alias("w")
    )
    counted = each.groupBy("w").agg(F.count("*").alias("n")).where((F.col("n") > 1) & (F.length("w") <= 64))
    return [r.w for r in counted.orderBy(F.desc("n"), "w").limit(size).collect()]


def shared_lexicon(spark: SparkSession, lexicon: Lexicon) -> str:
    """Write the lexicon to the shared folder and hand it out; gives the name executors find it by."""
    name = f"lexicon-{uuid.uuid4().hex}.bin"
    spark.sparkContext.addFile(put(spark, name, lexicon.dump()))
    return name


@lru_cache(2)
def _worker(name: str, tokenizer: str, folder: str) -> Encoder:
    return Encoder(Lexicon.load(SparkFiles.get(name)), ranks(tokenizer, folder))


#: Texts of a batch are encoded in slices of about so many characters.
SLICE_CHARS = 1_000_000


def token_ids(
    docs: DataFrame, key: str, text: str, tokenizer: str = DEFAULT, folder: str = TOKENIZERS, lexicon_size: int = LEXICON_SIZE
) -> DataFrame:
    """key and ids of every row, in the text's order, without special tokens.

    An empty list for null and empty texts; blank texts are encoded like any other; strings that
    name special tokens are ordinary text. Rows are kept one to one, repeated rows too; extra
    columns are not read.
    """
    spark = docs.sparkSession
    words = frequent_words(docs, text, lexicon_size)
    name = shared_lexicon(spark, Lexicon.compile((w.encode() for w in words), ranks(tokenizer, folder)))
    taken = docs.select(F.col(key).alias("key"), F.col(text).alias("text"))

    def run(batches):
        encoder = _worker(name, tokenizer, folder)
        for batch in batches:
            texts = batch.column(1).to_pylist()
            at = 0
            while at < len(texts):
                size, end = 0, at
                while end < len(texts) and (end == at or size + len(texts[end] or "") <= SLICE_CHARS):
                    size += len(texts[end] or "")
                    end += 1
                ends, ids = encoder.encode(texts[at:end])
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(at, end - at), pa.ListArray.from_arrays(pa.array(ends), pa.array(ids))], ["key", "ids"]
                )
                at = end

    out = taken.mapInArrow(run, f"key {dict(taken.dtypes)['key']}, ids array<int>")
    return out.withColumnRenamed("key", key)
