"""Problem 5: missing or wrong language labels, and texts that mix languages."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from palimpsest.llm import langid

#: A label that names one of the languages is contradicted only from this confidence on.
MIN_CONFIDENCE = 0.58


def labelled_passages(items: DataFrame, model: langid.Model, text: str, lang: str, keys: list[str]) -> DataFrame:
    """Every row of items with its keys, label and passages; see langid.with_passages for nulls and short texts."""
    return langid.with_passages(items, model, text, [*keys, lang])


def languages(items: DataFrame, model: langid.Model, text: str, lang: str, keys: list[str]) -> DataFrame:
    """One row for each language of each text: keys, lang, confidence, letters, passages.

    A text that is null, has fewer than 20 letters or is no language gets no row. Rows with the
    same keys are kept as they are; take distinct rows for one row per item. Confidence is the
    letters' mean of the passages' confidences, between 0.5 and 1.
    """
    every = labelled_passages(items, model, text, lang, keys)
    each = every.select(*keys, F.explode("passages").alias("p"))
    return each.groupBy(*keys, F.col("p.lang").alias("lang")).agg(
        (F.sum(F.col("p.confidence") * F.col("p.letters")) / F.greatest(F.sum("p.letters"), F.lit(1))).alias("confidence"),
        F.sum("p.letters").alias("letters"),
        F.count("*").alias("passages"),
    )


def wrong_labels(items: DataFrame, model: langid.Model, text: str, lang: str, keys: list[str]) -> DataFrame:
    """keys and real lang of the texts in several languages and of those whose label is missing or wrong."""
    every = labelled_passages(items, model, text, lang, keys)
    found = F.array_distinct(F.transform("passages", lambda p: p["lang"]))
    sureness = F.element_at(F.transform("passages", lambda p: p["confidence"]), 1)
    label = langid.normal_label(F.col(lang))
    odd = (F.size(found) > 1) | (
        (F.size(found) == 1)
        & (label.isNull() | ((label != found[0]) & (~label.isin(*langid.LANGS) | (sureness >= MIN_CONFIDENCE))))
    )
    return every.where(odd).select(*keys, F.explode(found).alias("found")).withColumnRenamed("found", "lang").distinct()
