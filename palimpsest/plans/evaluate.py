"""Evaluation of a rewrite: numbers, protected terms and claims, and the decision on each document."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from palimpsest.functions import freezing, pyfn
from palimpsest.functions import tokens as K
from palimpsest.operators import claims, relational

ITEM = "array<struct<raw:string,normalized:string,kind:string,start:int,stop:int,context:string>>"


def with_numeric_items(df: DataFrame, text: str, out: str = "numeric_items") -> DataFrame:
    return pyfn.with_columns(df, [text], f"{out} {ITEM}", lambda t: (freezing.numeric_items(t),))


def numeric_counts(df: DataFrame, key: Sequence[str], text: str) -> DataFrame:
    """key, value and n of the normalised numeric items of a text."""
    each = with_numeric_items(df.select(*key, text), text).select(*key, F.explode("numeric_items.normalized").alias("value"))
    return each.groupBy(*key, "value").agg(F.count("*").alias("n"))


def numeric_changes(df: DataFrame, key: Sequence[str], before: str, after: str) -> DataFrame:
    """key, value, missing and added of the numeric items that a rewrite lost or brought in."""
    return relational.multiset_difference(numeric_counts(df, key, before), numeric_counts(df, key, after), [*key, "value"])


def term_changes(df: DataFrame, key: Sequence[str], before: str, after: str, terms: Sequence[str], same_count: bool = True) -> DataFrame:
    a, b = (relational.term_counts(df, key, c, terms) for c in (before, after))
    found = relational.multiset_difference(a, b, [*key, "term"])
    if same_count:
        return found
    kept = found.join(b.select(*key, "term"), [*key, "term"], "left_anti")
    return kept.where("missing > 0")


def evaluated(pairs: DataFrame, doc: str, before: str, after: str, terms: Sequence[str], original_claims: DataFrame, rewritten_claims: DataFrame, html: bool = False) -> DataFrame:
    """doc, decision and reason of each pair of texts, or of HTML values, with the claims of both sides."""
    if html:
        view = lambda a, b: (K.visible_text(a), K.visible_text(b))
        pairs = pyfn.with_columns(pairs, [before, after], f"{before} string, {after} string", view)
    lost = numeric_changes(pairs, [doc], before, after).select(doc).distinct().withColumn("__num__", F.lit(False))
    gone = term_changes(pairs, [doc], before, after, terms).select(doc).distinct().withColumn("__term__", F.lit(False))
    docs = pairs.select(doc).distinct().join(lost, doc, "left").join(gone, doc, "left").fillna(True, ["__num__", "__term__"])
    results, unsupported = claims.compared(original_claims, rewritten_claims, doc)
    return claims.decisions(docs, doc, "__num__", "__term__", results, unsupported)
