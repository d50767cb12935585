"""Problem 2: reading level of documents by vocabulary coverage and sentence complexity.

The English words of each document are counted. Two reference vocabularies are ranked by frequency
in labelled documents: that of the levels below advanced and that of the basic level. A document's coverage is the smallest share of a ranked vocabulary that
covers ``COVERED`` of its tokens. Its sentence complexity is the mean length of its sentences. Both
are calibrated in SQL: of a small grid of weights for complexity and a thousand thresholds, the pair
with the fewest errors on the labelled documents, in the middle of the best thresholds.

The ranked vocabulary holds at most ``max_vocabulary`` words, a documented bound of the model; all
counts run over all documents.
"""

from __future__ import annotations

import re
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from palimpsest.llm import langid
from palimpsest.session import stored

COVERED = 0.8
MAX_VOCABULARY = 50_000
WEIGHTS = (0.0, 0.05, 0.1, 0.2)
BINS = 1000
#: Sentence lengths from here on count the same.
LONG_SENTENCE = 60.0
#: Share of the letters that must be in English.
ENGLISH_SHARE = 0.5
LEVELS = ("basic", "intermediate", "advanced")

_WORD = re.compile(r"[a-z]+(?:['’][a-z]+)?")
_SENTENCE = re.compile(r"(?<=[.!?])[\"'”’)]*\s+|\n+")


def sentences(text: str) -> int:
    """Sentences with a word."""
    return sum(1 for s in _SENTENCE.split(text) if _WORD.search(s.lower()))


FACTS = ("sentences", "tokens", "letters", "english")


def counted_words(texts: DataFrame, model: langid.Model, doc: list[str], item: list[str], text: str) -> DataFrame:
    """doc, words, counts and facts (sentences, tokens, letters, English letters) of each document.

    Rows are range-partitioned and sorted by document and item, so a batch holds its documents
    whole but for the first and the last, and rows of one item lie side by side, of which one
    counts. Documents inside a batch are done; only those at its edges, which a large document is
    many times, are merged by word. Null texts count nothing.
    """
    shared = texts.sparkSession.sparkContext.broadcast(model.table)
    taken = texts.where(F.col(text).isNotNull()).select(*doc, *item, F.col(text).alias("__text__"))
    ordered = taken.repartitionByRange(*doc, *item).sortWithinPartitions(*doc, *item)
    kinds = dict(taken.dtypes)

    def run(batches):
        local = langid.Model(shared.value)
        last = None
        for batch in batches:
            at = batch.schema.get_field_index
            keys = list(zip(*(batch.column(at(c)).to_pylist() for c in [*doc, *item])))
            fresh = [i for i, k in enumerate(keys) if k != (keys[i - 1] if i else last)]
            last = keys[-1] if keys else last
            values = batch.column(at("__text__")).take(pa.array(fresh, pa.int64())).to_pylist()
            words: dict[tuple, Counter] = {}
            facts: dict[tuple, list[int]] = {}
            for i, value, passages in zip(fresh, values, local.passages(values)):
                key = keys[i][: len(doc)]
                if key not in facts:
                    facts[key], words[key] = [0, 0, 0, 0], Counter()
                fact = facts[key]
                for lang, _, letters, start, stop in passages:
                    fact[2] += letters
                    if lang == "en":
                        found = _WORD.findall(value[start:stop].lower())
                        words[key].update(found)
                        fact[0] += sentences(value[start:stop])
                        fact[1] += len(found)
                        fact[3] += letters
            edges = {keys[0][: len(doc)], keys[-1][: len(doc)]} if keys else set()
            order = list(facts)
            offsets = pa.array([0, *np.cumsum([len(words[k]) for k in order])], pa.int32())
            yield pa.RecordBatch.from_arrays(
                [
                    *(pa.array([k[n] for k in order], batch.schema.field(at(d)).type) for n, d in enumerate(doc)),
                    pa.array([k not in edges for k in order], pa.bool_()),
                    pa.ListArray.from_arrays(offsets, pa.array([w for k in order for w in words[k]], pa.string())),
                    pa.ListArray.from_arrays(offsets, pa.array([n for k in order for n in words[k].values()], pa.int64())),
                    *(pa.array([facts[k][n] for k in order], pa.int64()) for n in range(len(FACTS))),
                ],
                [*doc, "__whole__", "words", "counts", *FACTS],
            )

    schema = ", ".join(f"`{d}` {kinds[d]}" for d in doc) + ", __whole__ boolean, words array<string>, counts array<bigint>, "
    parts = stored(ordered.mapInArrow(run, schema + ", ".join(f"{f} bigint" for f in FACTS)))
    edge = parts.where("not __whole__")
    each = edge.select(*doc, F.explode(F.arrays_zip("words", "counts")).alias("w"))
    each = each.groupBy(*doc, F.col("w.words").alias("w")).agg(F.sum("w.counts").alias("n"))
    listed = each.groupBy(*doc).agg(F.collect_list(F.struct("w", "n")).alias("l"))  # as many as the document's distinct words
    facts = edge.groupBy(*doc).agg(*(F.sum(f).alias(f) for f in FACTS))
    none = F.array().cast("array<struct<w:string,n:bigint>>")
    found = F.coalesce("l", none)
    merged = facts.join(listed, doc, "left").select(
        *doc, F.transform(found, lambda x: x["w"]).alias("words"), F.transform(found, lambda x: x["n"]).alias("counts"), *FACTS
    )
    return parts.where("__whole__").drop("__whole__").unionByName(merged)


def vocabulary(counted: DataFrame, labels: DataFrame, doc: list[str], level: str, max_vocabulary: int = MAX_VOCABULARY) -> DataFrame:
    """word, plain_rank and basic_rank of the labelled documents' words, at most max_vocabulary of them."""
    known = counted.join(labels.select(*doc, level).distinct(), doc).select(level, F.explode(F.arrays_zip("words", "counts")).alias("w"))
    known = known.select(level, F.col("w.words").alias("word"), F.col("w.counts").alias("n"))
    total = [F.sum(F.when(F.col(level) == name, F.col("n")).otherwise(0)).alias(name) for name in LEVELS]
    each = known.groupBy("word").agg(*total).orderBy(F.desc(F.col("basic") + F.col("intermediate") + F.col("advanced")), "word")
    each = stored(each.limit(max_vocabulary))
    by = lambda n: F.row_number().over(Window.orderBy(n.desc(), "word"))
    return each.select("word", by(F.col("basic") + F.col("intermediate")).alias("plain_rank"), by(F.col("basic")).alias("basic_rank"))


def covered_rank(ranks: list[int], counts: list[int], share: float = COVERED) -> int:
    """The smallest rank up to which the words cover a share of the tokens."""
    order = np.argsort(np.array(ranks, np.int64), kind="stable")
    upto = np.cumsum(np.array(counts, np.int64)[order])
    return int(np.array(ranks)[order][np.searchsorted(upto, share * upto[-1])])


def coverage(counted: DataFrame, ranked: DataFrame, doc: list[str], keep: tuple[str, ...] = ()) -> DataFrame:
    """doc, the kept columns and for each document with words the ranks at which COVERED of its tokens are covered, as
    shares of the vocabulary, which is sent to the executors (it has a bound); words outside it come last."""
    rows = ranked.collect()
    shared = counted.sparkSession.sparkContext.broadcast({r.word: (r.plain_rank, r.basic_rank) for r in rows})
    kept = counted.where(F.size("words") > 0).select(*doc, *keep, "words", "counts")
    kinds = dict(kept.dtypes)
    names = [*doc, *keep]

    def run(batches):
        known = shared.value
        last = len(known) + 1
        for batch in batches:
            at = batch.schema.get_field_index
            plain, basic = [], []
            for words, counts in zip(batch.column(at("words")).to_pylist(), batch.column(at("counts")).to_pylist()):
                ranks = [known.get(w, (last, last)) for w in words]
                plain.append(covered_rank([r[0] for r in ranks], counts) / last)
                basic.append(covered_rank([r[1] for r in ranks], counts) / last)
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(at(n)) for n in names), pa.array(plain, pa.float64()), pa.array(basic, pa.float64())],
                [*names, "plain_coverage", "basic_coverage"],
            )

    schema = ", ".join(f"`{n}` {kinds[n]}" for n in names) + ", plain_coverage double, basic_coverage double"
    return kept.mapInArrow(run, schema)


def threshold(labelled: DataFrame, score: str, positive, weights: tuple[float, ...] = WEIGHTS) -> DataFrame:
    """One row: weight and threshold with the fewest errors; no row without both kinds of labels.

    Scores are put into BINS bins before they are ordered, so the window runs over a fixed number of rows.
    """
    grid = labelled.select(
        F.explode(F.array(*(F.lit(float(w)) for w in weights))).alias("weight"), F.col(score).alias("s"), "complexity", positive.alias("yes")
    )
    bins = grid.select("weight", F.round((F.col("s") + F.col("weight") * F.col("complexity")) * BINS).cast("int").alias("bin"), "yes")
    counted = bins.groupBy("weight", "bin").agg(
        F.sum(F.col("yes").cast("int")).alias("yes"), F.sum((~F.col("yes")).cast("int")).alias("no")
    )
    below = Window.partitionBy("weight").orderBy("bin").rowsBetween(Window.unboundedPreceding, 0)
    whole = Window.partitionBy("weight")
    errors = counted.select(
        "weight",
        "bin",
        F.lead("bin").over(whole.orderBy("bin")).alias("next"),
        (F.sum("yes").over(below) + F.sum("no").over(whole) - F.sum("no").over(below)).alias("errors"),
        F.sum("yes").over(whole).alias("all_yes"),
        F.sum("no").over(whole).alias("all_no"),
    ).where("next is not null and all_yes > 0 and all_no > 0")
    best = errors.orderBy("errors", F.desc(F.col("next") - F.col("bin")), "weight", "bin").limit(1)
    return best.select("weight", ((F.col("bin") + F.col("next")) / 2 / BINS).alias("threshold"))


def levels(
    texts: DataFrame, labels: DataFrame, model: langid.Model, doc: list[str], item: list[str], text: str, level: str, group: list[str]
) -> DataFrame:
    """doc, coverages, sentence_words and level of every document in English.

    ``doc`` names a document, ``item`` a text of it (rows of one item count once) and ``group`` the
    part of doc whose letters decide whether it is in English. Null texts count nothing; a document
    without English words has no row; where labels of a kind are missing the level is null. Labels
    of documents without a text are ignored.
    """
    counted = counted_words(texts, model, doc, item, text)
    english = counted.groupBy(*group).agg((F.sum("english") > ENGLISH_SHARE * F.sum("letters")).alias("ok")).where("ok").select(*group)
    counted = counted.where("tokens > 0").join(english, group, "left_semi")
    ranked = vocabulary(counted, labels, doc, level)
    length = F.col("tokens") / F.greatest(F.col("sentences"), F.lit(1))
    scored = coverage(counted, ranked, doc, ("sentences", "tokens")).withColumn("sentence_words", length)
    scored = stored(scored.withColumn("complexity", F.least(F.col("sentence_words"), F.lit(LONG_SENTENCE)) / LONG_SENTENCE))
    known = scored.join(labels.select(*doc, F.col(level).alias("level")).distinct(), doc)
    high = threshold(known, "plain_coverage", F.col("level") == "advanced").first()
    low = threshold(known.where("level <> 'advanced'"), "basic_coverage", F.col("level") == "intermediate").first()
    above = lambda score, cut: F.col(score) + cut.weight * F.col("complexity") > cut.threshold if cut else F.lit(None).cast("boolean")
    is_high, is_middle = above("plain_coverage", high), above("basic_coverage", low)
    found = F.when(is_high, "advanced").when(is_middle, "intermediate").when(~is_middle & F.lit(high is not None), "basic")
    return scored.select(
        *doc, F.round("plain_coverage", 6).alias("plain_coverage"), F.round("basic_coverage", 6).alias("basic_coverage"),
        F.round("sentence_words", 4).alias("sentence_words"), found.alias("reading_level"),
    )
