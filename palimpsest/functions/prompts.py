"""Requests to a model as text: pure functions of their parts, and the same as columns where rows are many."""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

KEEP = (
    "Keep the meaning, all facts, names, dates, numbers, links and placeholders exactly as they are.",
    "Give back the new text alone.",
)


def _lines(title: str, items: Sequence[str]) -> str:
    return title + "\n" + "\n".join(f"- {i}" for i in items) if items else ""


def system(category: str, tag: str, rules: Sequence[str]) -> str:
    """The task for texts of a category in an element, with the rules that apply, in order."""
    parts = [f"Rewrite text of the category {category} that stands in a <{tag}> element.", _lines("Rules:", rules), _lines("Always:", KEEP)]
    return "\n\n".join(p for p in parts if p)


def block(heading: str, before: str, text: str, behind: str) -> str:
    """A block between its neighbours, which are for reading only; parts without text are left out."""
    named = (("Heading", heading), ("Text before, for reading only", before), ("Text to rewrite", text), ("Text behind, for reading only", behind))
    return "\n\n".join(f"{n}:\n{t}" for n, t in named if t)


def chunk(before: str, current: str, behind: str, index: int, total: int) -> str:
    """A chunk of a document with the ends of its neighbours."""
    return f"Part {index} of {total}\n\n" + block("", before, current, behind)


def polish(previous: str, current: str) -> str:
    return block("", previous, current, "") + "\n\nMake the way from the text before to this one smooth."


def section(rules: Sequence[str], marked: str) -> str:
    """Paragraphs under [[Pn]] lines that stay one for one."""
    return "\n\n".join(p for p in (_lines("Rules:", rules), "Keep every [[Pn]] line and the number of paragraphs.", marked) if p)


def claims(text: str, fields: Sequence[str]) -> str:
    """The claims of a text as JSON."""
    return f'List the claims of the text as JSON: {{"claims": [{{{", ".join(json.dumps(f) for f in fields)}}}]}}.\n\nText:\n{text}'


def comparison(claim: str, candidates: str) -> str:
    """Which of the candidates, JSON like the claim, keeps it, and how."""
    return f'Which candidate keeps the claim? Answer as JSON with "result", "best_match_claim_id", "severity" and "explanation".\n\nClaim:\n{claim}\n\nCandidates:\n{candidates}'


def judgement(before: str, after: str, findings: str, most: int = 12_000) -> str:
    """Whether two texts, of which the first characters are shown, mean the same."""
    return f'Do the texts mean the same? Answer as JSON with "semantic_equivalent" and "summary".\n\nFindings:\n{findings}\n\nBefore:\n{before[:most]}\n\nAfter:\n{after[:most]}'


def claims_column(text: Column, fields: Sequence[str]) -> Column:
    return F.concat(F.lit(claims("", fields)), text)


def comparison_column(claim: Column, candidates: Column) -> Column:
    head, rest = comparison("\0", "\1").split("\0")
    middle = rest.split("\1")[0]
    return F.concat(F.lit(head), claim, F.lit(middle), candidates)


def judgement_column(before: Column, after: Column, findings: Column, most: int = 12_000) -> Column:
    head, rest = judgement("\0", "\1", "\2").split("\2")
    first, second = rest.split("\0")
    return F.concat(F.lit(head), findings, F.lit(first), F.substring(before, 1, most), F.lit(second.split("\1")[0]), F.substring(after, 1, most))
