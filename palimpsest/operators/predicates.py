"""Predicates and routing as column expressions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from palimpsest.functions import patterns as P
from palimpsest.functions import text as X


def _tags(names: Sequence[str]) -> Column:
    return F.array(*(F.lit(n) for n in names))


def under(path: Column, names: Sequence[str]) -> Column:
    """Whether one of the elements is among those around a node."""
    return F.arrays_overlap(path, _tags(names))


def editable_node(text: Column, path: Column) -> Column:
    """A text node that may be edited: not blank, not directly in a skipped element, under no protected one."""
    parent = F.coalesce(F.try_element_at(path, F.lit(-1)), F.lit(""))
    return (F.trim(text) != "") & ~parent.isin(*P.SKIPPED_PARENTS) & ~under(path, P.PROTECTED_ANCESTORS)


def nearest(path: Column, names: Sequence[str] = P.APPROVED) -> Column:
    """The innermost of the elements around a node, null without one."""
    return F.try_element_at(F.filter(path, lambda t: t.isin(*names)), F.lit(-1))


def high_risk(text: Column, strict_ids: bool = False) -> Column:
    """Disclosure, rate word, percentage, currency, date, identifier, or an amount word with a number; false for null."""
    kinds = dict((k, (p, c)) for k, p, c in P.INVARIANTS)
    rlike = lambda p, case=False: text.rlike(P.flagged(p, case))
    by_kind = lambda k: rlike(*kinds[k])
    identifier = rlike(P.STRICT_ID) if strict_ids else by_kind("ids")
    found = (
        rlike(P.DISCLOSURE)
        | rlike(P.RATE_WORD)
        | by_kind("percentages")
        | by_kind("currencies")
        | by_kind("dates")
        | identifier
        | (rlike(P.AMOUNT_WORD) & by_kind("numbers"))
    )
    return F.coalesce(found, F.lit(False))


def route(non_editable: Column, approved_tag: Column, protected: Column, risky: Column) -> Column:
    """The class of a segment, the first that holds."""
    return (
        F.when(non_editable, "non_editable")
        .when(F.coalesce(approved_tag, F.lit("")) == "", "non_prose")
        .when(protected, "protected")
        .when(risky, "high_risk")
        .otherwise("editable")
    )


def freeze_reason(text: Column, path: Column, has_inline: Column, risky: Column | None = None) -> Column:
    """Why a block stays as it is, the first reason that holds; empty for none."""
    size = F.length(text)
    return (
        F.when(size < P.MIN_BLOCK_CHARS, "too_short")
        .when(size > P.MAX_BLOCK_CHARS, "too_long")
        .when(under(path, P.NON_EDITABLE), "non_editable_ancestor")
        .when(under(path, P.HIGH_RISK), "high_risk_block_ancestor")
        .when(under(path, P.FROZEN_CONTAINERS), "frozen_container_ancestor")
        .when(has_inline, "inline_markup_present")
        .when(high_risk(text) if risky is None else risky, "high_risk_content")
        .otherwise("")
    )


def needs_polish(previous: Column, current: Column) -> Column:
    """Whether the way from one block to the next may need work; false where one is blank."""
    a, b = X.normal_space(previous), X.normal_space(current)
    words = F.split(F.lower(b), " ")
    four = F.array_join(F.slice(words, 1, 4), " ")
    return (
        (a != "")
        & (b != "")
        & (
            (F.length(b) <= P.POLISH_CHARS)
            | F.substring(F.lower(b), 1, P.POLISH_CHARS).rlike(P.CONNECTIVE_START)
            | F.get(words, F.lit(0)).isin(*P.PRONOUN_STARTS)
            | F.lower(a).contains(four)
        )
    )


def is_short(text: Column, least: int = 3) -> Column:
    return F.length(F.trim(F.coalesce(text, F.lit("")))) < least


def is_whole_number(text: Column, least: int = 1) -> Column:
    """An integer of at least ``least``, with white space and a sign allowed; false for all else."""
    ok = text.rlike(r"^\s*[+-]?\d{1,38}\s*$")
    return F.coalesce(F.when(ok, F.try_to_number(F.trim(F.regexp_replace(text, r"\+", "")), F.lit("S" + "9" * 38)) >= least), F.lit(False))


def number_message(text: Column) -> Column:
    """What is wrong with a position that was asked for; null where nothing is."""
    whole = text.rlike(r"^\s*[+-]?\d+\s*$")
    return (
        F.when(F.coalesce(F.trim(text), F.lit("")) == "", "A number is needed.")
        .when(~whole, "The position must be a whole number.")
        .when(~is_whole_number(text), "The position must be 1 or more.")
    )


def needs_repair(issues: Column, kinds: Sequence[str] = ("stage1_missing", "stage1_empty", "onepass_missing_or_empty")) -> Column:
    return F.arrays_overlap(issues, _tags(kinds))
