"""Problem 6: text cut off by field limits or in transfer, by a self-join of prefixes.

A value was cut if the sentence it ends with is a strict prefix of a longer copy of that sentence
elsewhere. All sentences of the texts are the copies, the last sentence of every value is what is
asked for, with its closing mark: a complete sentence isn't a prefix of another one, as the mark
stands where the other goes on. Copies and questions are put into one sorted order of distinct
strings, where the copies that go on from a string stand right behind it, so each question is
answered by its successor. Sorting has no buckets: a beginning that a third of all values have costs
no more than others.

A last sentence of fewer than ``MIN_PREFIX`` characters proves little alone and is looked up together
with the end of the sentence before it. Sentences strung together are also asked for by their last
clause. Numbers and capitalised names inside a sentence are masked on both sides, so that a sentence
on another product or amount is a copy; a number that ends in its point is itself asked for among the
numbers that go on behind one. What the join finds is then checked against the value's
counterpart, which tells items that end without a mark by nature.
"""

from __future__ import annotations

import re

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from palimpsest.session import stored

#: A string of fewer characters is looked up with so many characters of the sentence before it.
MIN_PREFIX = 16
CONTEXT = 16
#: Characters at the end of a text in which its last two sentences are sought first.
TAIL = 256

# What closes a sentence, what may stand behind it, what only wraps a text.
CLOSING = ".!?…。！？"
BEHIND = "\"'”’»)]}` \t\r\n ​‌‍⁠﻿"
AROUND = BEHIND + "-—–/|•"

_NUMBER = re.compile(r"[0-9](?:[0-9.,]*[0-9])?")
_NAME = re.compile(r"([ ,\-])(?<=[^\W\d_].)[A-ZÀ-ÖØ-Þ][^\W\d_]*")
_SPACES = "\t\r\x0b\x0c\xa0\u2007\u2009\u202f\u3000"
_ENDS = re.compile(r"[.!?…][\"'”’»)]*\s+|[。！？][\"'”’»)]*\s*")
_CLAUSES = re.compile(r"[,;:] (?:(?:and|und|en|et|y) )?(?:so |then )*|(?<=[^ ]) (?:and|und|en|et|y) (?:so |then )*")
_DECIMAL = re.compile(r"[0-9]+(?:[.,][0-9]+)+")
_LAST_NUMBER = re.compile(r"\d[\d.,]*[.,]$")
_DOTS = re.compile(r"(?:\.{3,}|…)$")


def bare_end(text: Column) -> Column:
    """The text without what may stand behind its last mark."""
    return F.rtrim(text, F.lit(BEHIND))


def breaks_off(text: Column) -> Column:
    """Whether the text ends without a closing mark; null for null, false where nothing is left."""
    bare = bare_end(text)
    return (bare != "") & ~F.right(bare, F.lit(1)).isin(*CLOSING)


def has_word(text: Column) -> Column:
    """Whether a letter or digit is left without tags, character entities and fences."""
    return F.regexp_replace(text, r"<[^>]*>|&#?\w+;|```\w*", "").rlike(r"[\p{L}\p{N}]")


def without_dots(sentence: str) -> str:
    """A sentence up to the dots among its last marks."""
    marks = sentence[len(sentence.rstrip(CLOSING)) :]
    at = min((i for i in (marks.find("..."), marks.find("…")) if i >= 0), default=len(marks))
    return sentence[: len(sentence) - len(marks) + at]


def sentences(text: str) -> list[str]:
    """The sentences and lines of a text, numbers and names masked, in lower case, without what wraps them and without
    dots that stand for what follows, nor marks behind those: they aren't what a text goes on with."""
    for space in _SPACES:
        if space in text:
            text = text.replace(space, " ")
    while "  " in text:
        text = text.replace("  ", " ")
    text = _ENDS.sub(r"\g<0>\n", _NAME.sub(r"\1^", _NUMBER.sub("#", text))).lower()
    found = [p.strip(AROUND) for p in text.split("\n")]
    return [kept for p in found if p and (kept := without_dots(p) if p[-1] in CLOSING else p)]


def last_sentences(text: str) -> list[str]:
    """The last two sentences, or fewer; what stands before them isn't looked at."""
    size = TAIL
    while size < len(text):
        if len(found := sentences(text[-size:])) > 2:
            return found[-2:]
        size *= 4
    return sentences(text)[-2:]


def in_context(before: str, sentence: str) -> str:
    """A sentence's start with the end of the sentence before it."""
    return before[-CONTEXT:] + "\n" + sentence[: MIN_PREFIX + 1]


def copies_of(text: str) -> set[str]:
    """What a text can prove: its sentences, their starts with the end of the one before, and its decimal numbers."""
    found = sentences(text)
    return {*found, *map(in_context, ["", *found], found), *("#" + n for n in _DECIMAL.findall(text))}


def asked_of(text: str, number_cut: bool) -> list[str]:
    """What a value is asked for by: its last sentence, or where that is short its start in context; its last clause; the
    number it is cut in."""
    end = _DOTS.sub("", text.rstrip(BEHIND))
    if number_cut:
        return ["#" + _LAST_NUMBER.search(end)[0]]
    found = last_sentences(end.rstrip(",;: "))
    if not found:
        return []
    last = found[-1]
    if len(last) < MIN_PREFIX:
        return [in_context(found[-2] if len(found) > 1 else "", last)]
    clause = _CLAUSES.split(last)[-1]
    return [last, clause] if clause != last and len(clause) >= MIN_PREFIX else [last]


def ends_in_dots(text: str) -> bool:
    return bool(_DOTS.search(text.rstrip(BEHIND)))


def same_dots(text: str, other: str | None) -> bool:
    """Whether the other text ends in dots as well, behind the same word: then they are how the whole text ends."""
    if not other or not ends_in_dots(other):
        return False
    last, own = (_DOTS.sub("", t.rstrip(BEHIND)).casefold().split()[-1:] for t in (text, other))
    return last == own


def number_goes_on(text: str, other: str | None) -> bool:
    """Whether the number at the end of the text goes on behind its point in the other text, and never ends there."""
    found = _LAST_NUMBER.search(text.rstrip())
    if not found or not other:
        return False
    at = re.escape(found[0])
    whole = re.escape(found[0][:-1])
    return bool(re.search(rf"(?<![\d.,]){at}\d", other)) and not re.search(rf"(?<![\d.,]){whole}(?![\d]|[.,]\d)", other)


def _copies(texts: DataFrame) -> DataFrame:
    """string: what the texts of the only column can prove; many times each."""

    def run(batches):
        for batch in batches:
            out: set[str] = set()
            for t in set(batch.column(0).to_pylist()):
                out |= copies_of(t)
            yield pa.RecordBatch.from_arrays([pa.array(list(out), pa.string())], ["string"])

    return texts.mapInArrow(run, "string string")


def going_on(copies: DataFrame, asked: DataFrame) -> DataFrame:
    """string: those asked for that are strict prefixes of a longer string of either table.

    Distinct strings lie in sorted range partitions; a string's longer copies are right behind it, so
    the next string decides. The last string of a partition is decided by the first one of the next,
    from a table of one row for each partition.
    """
    both = copies.select("string", F.lit(False).alias("asked")).unionByName(asked.select("string", F.lit(True).alias("asked")))
    every = stored(both.groupBy("string").agg(F.max("asked").alias("asked")))
    ordered = every.repartitionByRange("string").sortWithinPartitions("string")

    def run(batches):
        first = last = None
        for batch in batches:
            found = []
            for string, wanted in zip(*(c.to_pylist() for c in batch.columns)):
                if first is None:
                    first = string
                if last is not None and string.startswith(last):
                    found.append(last)
                last = string if wanted else None
            yield pa.RecordBatch.from_arrays([pa.array(found, pa.string()), pa.nulls(len(found), pa.string())], ["string", "first"])
        if first is not None:
            yield pa.RecordBatch.from_arrays([pa.array([last], pa.string()), pa.array([first], pa.string())], ["string", "first"])

    seen = stored(ordered.mapInArrow(run, "string string, first string"))
    edges = seen.where("first is not null").withColumn("next", F.lead("first").over(Window.orderBy("first")))
    return seen.where("first is null").select("string").unionByName(edges.where(F.col("next").startswith(F.col("string"))).select("string"))


def cut_values(values: DataFrame, copies: list[tuple[DataFrame, list[str]]], keys: list[str], text: str, other: str) -> DataFrame:
    """keys of the rows of values whose text was cut.

    ``other`` is the column with the text's counterpart; ``copies`` are tables and their columns in
    which longer copies are sought. A case is a text whose last sentence or clause is, by the join, a
    strict prefix of a longer copy, and which, as an exact check, ends without a closing mark, with
    dots, or inside a number that goes on in its counterpart; it is none if its counterpart ends
    without a mark too and isn't itself a longer copy, or with dots behind the same word. Null texts and texts without a word are none;
    rows with equal keys give one row; ties cannot arise; empty tables give an empty result.
    """
    bare, own = F.rtrim(F.col(text)), F.rtrim(F.col(other))
    longer = F.coalesce(own.startswith(bare) & (F.length(own) > F.length(bare)), F.lit(False))
    by_nature = F.coalesce(breaks_off(F.col(other)), F.lit(False)) & ~longer
    looked_at = values.where(has_word(F.col(text))).select(
        *keys, F.col(text).alias("__text__"), F.col(other).alias("__other__"), (breaks_off(F.col(text)) & ~by_nature).alias("__open__"), by_nature.alias("__nature__")
    )

    def run(batches):
        for batch in batches:
            at = batch.schema.get_field_index
            rows = [batch.column(at(c)).to_pylist() for c in ("__text__", "__other__", "__open__", "__nature__")]
            strings, case = [], []
            for t, o, open_end, nature in zip(*rows):
                number_cut = not open_end and number_goes_on(t, o)
                strings.append(asked_of(t, number_cut))
                case.append(open_end or number_cut or (ends_in_dots(t) and not nature and not same_dots(t, o)))
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(at(k)) for k in keys), pa.array(case, pa.bool_()), pa.array(strings, pa.list_(pa.string()))], [*keys, "__case__", "__asked__"]
            )

    kinds = dict(looked_at.dtypes)
    schema = ", ".join(f"`{k}` {kinds[k]}" for k in keys) + ", `__case__` boolean, `__asked__` array<string>"
    asked = stored(looked_at.mapInArrow(run, schema)).select(*keys, "__case__", F.explode("__asked__").alias("string"))
    texts = None
    for df, columns in copies:
        each = df.select(F.explode(F.array(*columns)).alias("t")).where("t is not null")
        texts = each if texts is None else texts.unionByName(each)
    proven = going_on(_copies(texts), asked)
    return asked.join(proven, "string", "left_semi").where("__case__").select(*keys).distinct()


def shares(values: DataFrame, cut: DataFrame, keys: list[str], text: str, source: str) -> DataFrame:
    """For each source its items with a text, those that were cut, and their share.

    Rows of one key and source are one item; a null source is a group of its own.
    """
    items = values.where(F.col(text).isNotNull()).select(*keys, source).distinct()
    marked = items.join(cut.withColumn("__cut__", F.lit(1)), keys, "left")
    return marked.groupBy(source).agg(
        F.count("*").alias("items"), F.count("__cut__").alias("cut"), F.round(F.count("__cut__") / F.count("*"), 6).alias("share")
    )
