"""Rewriting with checks: pluggable rewriters, calls in Arrow batches, validation, repair rounds, two passes.

A rewriter is a plain object with one method over a batch of requests. Those here are deterministic
and offline; one that calls a model implements the same method and is made on each executor.
"""

from __future__ import annotations

import re
import time
from collections.abc import Callable, Sequence
from dataclasses import dataclass
from typing import Protocol

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from palimpsest.functions import freezing, pyfn
from palimpsest.functions import patterns as P
from palimpsest.functions import text as X
from palimpsest.functions import tokens as K
from palimpsest.operators import predicates, relational, sequence
from palimpsest.session import cut


class Rewriter(Protocol):
    """Gives a new text for each (text, context) of a batch; raises for a batch that fails as a whole."""

    def rewrite(self, requests: Sequence[tuple[str, dict]]) -> list[str | None]: ...


@dataclass(frozen=True)
class IdentityRewriter:
    """Every text as it is."""

    def rewrite(self, requests):
        return [t for t, _ in requests]


@dataclass(frozen=True)
class RuleRewriter:
    """Fixed replacements of words and single blanks: real edits without a model."""

    words: tuple[tuple[str, str], ...] = (("utilise", "use"), ("commence", "begin"), ("in order to", "to"), ("prior to", "before"), ("whenever", "when"))

    def rewrite(self, requests):
        out = []
        for text, _ in requests:
            for old, new in self.words:
                text = re.sub(rf"\b{re.escape(old)}\b", new, text)
            out.append(re.sub(r"[ \t]{2,}", " ", text))
        return out


@dataclass(frozen=True)
class FaultyRewriter:
    """Another rewriter's answers with one kind of fault in each ``every``-th of them: drop, duplicate, number, empty, raise."""

    inner: Rewriter
    fault: str
    every: int = 1

    def rewrite(self, requests):
        if self.fault == "raise":
            raise RuntimeError("the call failed")
        return [self._broken(a) if i % self.every == 0 else a for i, a in enumerate(self.inner.rewrite(requests))]

    def _broken(self, text: str) -> str:
        token = re.search(r"\[\[IMM_\d+\]\]|⟦/?\d+⟧", text)
        if self.fault == "drop" and token:
            return text.replace(token[0], "", 1)
        if self.fault == "duplicate" and token:
            return text + token[0]
        if self.fault == "number":
            return text + " 4711"
        return "" if self.fault == "empty" else text


def with_retries(call: Callable[[], list], tries: int = 5, wait: float = 0.0) -> list:
    """The call's result; waits grow twofold; the last failure is raised."""
    for n in range(tries):
        try:
            return call()
        except Exception:
            if n == tries - 1:
                raise
            time.sleep(wait * 2**n)
    raise AssertionError


def called(df: DataFrame, text: str, rewriter: Rewriter, context: Sequence[str] = (), tries: int = 2, out: str = "answer") -> DataFrame:
    """df with the rewriter's answer and the error of a failed call, one request for each row. A failure never fails the
    task. The result is cut from its lineage, so no later action calls again."""

    def run(value: str | None, *more) -> tuple[str | None, str | None]:
        if value is None:
            return None, None
        try:
            return with_retries(lambda: rewriter.rewrite([(value, dict(zip(context, more)))]), tries)[0], None
        except Exception as e:  # noqa: BLE001
            return None, str(e)

    return cut(pyfn.with_columns(df, [text, *context], f"{out} string, {out}_error string", run))


# ---- validators ------------------------------------------------------------------------------


def frozen(df: DataFrame, text: str) -> DataFrame:
    """df with frozen_text and tokens: array of token, value, kind in order."""
    return pyfn.with_columns(df, [text], "frozen_text string, tokens array<struct<token:string,value:string,kind:string>>", freezing.freeze)


def restored(answer: Column, tokens: Column) -> Column:
    """The text with each token's value again."""
    return F.aggregate(tokens, answer, lambda acc, t: F.replace(acc, t["token"], t["value"]))


def token_failures(answer: Column, tokens: Column) -> Column:
    """A message for each immutable token that doesn't stand in the answer exactly once."""
    times = lambda t: ((F.length(answer) - F.length(F.replace(answer, t["token"]))) / F.length(t["token"])).cast("int")
    odd = F.filter(tokens, lambda t: times(t) != 1)
    return F.transform(odd, lambda t: F.format_string("Immutable token %s expected once but found %d times.", t["token"], times(t)))


def signal_failures(original: Column, rewritten: Column) -> Column:
    """A message for each kind of protected value whose multiset changed."""
    return F.transform(relational.kind_mismatches(original, rewritten, P.SIGNALS), lambda k: F.concat(k, F.lit(" values changed.")))


def length_failures(original: Column, rewritten: Column) -> Column:
    ratio = X.length_ratio(original, rewritten)
    message = F.format_string("Length ratio %.2f is outside the allowed safety range.", ratio)
    none = F.array().cast("array<string>")
    return F.when(X.length_is_safe(original, rewritten), none).otherwise(F.array(message))


def rewritten_nodes(nodes: DataFrame, rewriter: Rewriter, text: str = "text", context: Sequence[str] = ()) -> DataFrame:
    """Nodes with rewritten_text, changed, needs_review and review_reasons: freeze, call, check tokens, restore, check
    values and length; any failure keeps the original. Texts under three characters aren't sent."""
    short = predicates.is_short(F.col(text))
    ready = frozen(nodes, text).withColumn("frozen_text", F.when(~short, F.col("frozen_text")))
    got = called(ready, "frozen_text", rewriter, context).withColumn("__back__", restored(F.col("answer"), F.col("tokens")))
    back = F.col("__back__")
    none = F.array().cast("array<string>")
    failed = F.concat(token_failures(F.col("answer"), F.col("tokens")), signal_failures(F.col(text), back), length_failures(F.col(text), back))
    reasons = (
        F.when(F.col("frozen_text").isNull(), none)
        .when(F.col("answer_error").isNotNull(), F.array(F.concat(F.lit("Node rewrite failed: "), F.col("answer_error"))))
        .when(F.col("answer").isNull(), F.array(F.lit("No answer.")))
        .otherwise(failed)
    )
    judged = got.withColumn("review_reasons", reasons).withColumn("needs_review", F.size("review_reasons") > 0)
    keep = F.col("needs_review") | F.col("frozen_text").isNull()
    judged = judged.withColumn("rewritten_text", F.when(keep, F.col(text)).otherwise(back))
    judged = judged.withColumn("changed", ~F.col("needs_review") & (F.col("rewritten_text") != F.col(text)))
    return judged.drop("frozen_text", "tokens", "answer", "answer_error", "__back__")


def repaired(df: DataFrame, text: str, rewriter: Rewriter, issues: Callable[[Column, Column], Column], rounds: int = 3) -> DataFrame:
    """df with revised_text, issues and attempts: answers with issues are asked for again with their issues as context, up
    to a number of rounds; what is still wrong keeps the original. Only the wrong rows are sent again."""
    todo = df.withColumn("__ask__", F.col(text)).withColumn("__why__", F.lit("")).withColumn("attempts", F.lit(0))
    done: DataFrame | None = None
    for n in range(rounds):
        got = called(todo, "__ask__", rewriter, ["__why__"])
        found = issues(F.col(text), F.col("answer"))
        found = F.when(F.col("answer").isNull(), F.array(F.coalesce("answer_error", F.lit("missing")))).otherwise(found)
        got = got.withColumn("issues", found).withColumn("attempts", F.lit(n + 1))
        last = n == rounds - 1
        fine = F.size("issues") == 0
        ready = (got if last else got.where(fine)).withColumn("revised_text", F.when(fine, F.col("answer")).otherwise(F.col(text)))
        ready = ready.drop("__ask__", "__why__", "answer", "answer_error")
        done = ready if done is None else done.unionByName(ready)
        todo = got.where(~fine).withColumn("__why__", F.array_join("issues", "; ")).drop("issues", "answer", "answer_error")
    return done


def token_issues(df: DataFrame, revised: str, tags: str = "tags", out: str = "issues") -> DataFrame:
    return pyfn.with_columns(df, [revised, tags], f"{out} array<string>", lambda t, found: (K.token_issues(t, [x["token"] for x in found or []]),))


def two_stage(segments: DataFrame, first: Rewriter, second: Rewriter, text: str = "text", tags: str = "tags") -> DataFrame:
    """Segments rewritten as plain text and then with their tokens placed: revised_text and issues. A blank first answer
    falls back to the plain original, a wrong second one to the tokenised original."""
    plain = segments.withColumn("plain_text", X.without_tokens(F.col(text)))
    one = called(plain, "plain_text", first, out="stage1").withColumn(
        "stage1_text", F.when(F.trim(F.coalesce("stage1", F.lit(""))) == "", F.col("plain_text")).otherwise(F.col("stage1"))
    )
    two = called(one, text, second, ["stage1_text"], out="stage2")
    checked = token_issues(two, "stage2", tags)
    return checked.withColumn("revised_text", F.when(F.size("issues") == 0, F.col("stage2")).otherwise(F.col(text))).drop(
        "plain_text", "stage1", "stage1_error", "stage1_text", "stage2", "stage2_error"
    )


def pass_one(blocks: DataFrame, rewriter: Rewriter, text: str = "text", reason: str = "freeze_reason") -> DataFrame:
    """Blocks with status, rewritten_text, pass1_error and invariants_ok_pass1. Frozen blocks are skipped; failed calls,
    empty answers and changed invariants keep the original."""
    asked = blocks.withColumn("__ask__", F.when(F.col(reason) == "", F.col(text)))
    got = called(asked, "__ask__", rewriter)
    new = X.normal_space(F.col("answer"))
    wrong = relational.kind_mismatches(F.col(text), new)
    status = (
        F.when(F.col(reason) != "", "skipped")
        .when(F.col("answer_error").isNotNull(), "pass1_error_fallback")
        .when(new == "", "pass1_fallback")
        .when(F.size(wrong) > 0, "pass1_invariant_fallback")
        .otherwise("rewritten_pass1")
    )
    error = (
        F.when(status == "pass1_error_fallback", F.col("answer_error"))
        .when(status == "pass1_fallback", F.lit("empty_candidate"))
        .when(status == "pass1_invariant_fallback", F.concat(F.lit("invariant_mismatch:"), F.array_join(F.array_sort(wrong), ",")))
        .otherwise("")
    )
    out = got.withColumns({"status": status, "pass1_error": error, "invariants_ok_pass1": status != "pass1_invariant_fallback"})
    return out.withColumn("rewritten_text", F.when(F.col("status") == "rewritten_pass1", new).otherwise(F.col(text))).drop("__ask__", "answer", "answer_error")


def pass_two(blocks: DataFrame, rewriter: Rewriter, group: Sequence[str], order: Sequence[str], most: int | None = 400) -> DataFrame:
    """Blocks whose way from the block before needs polish are asked for again with that block as context; an answer
    counts if its invariants are those of the original. ``most`` is the number of calls for each document."""
    near = sequence.neighbours(blocks, group, order, "rewritten_text", 1, 0)
    previous = F.coalesce(F.try_element_at("previous", F.lit(1)), F.lit(""))
    wanted = near.withColumn("previous_text", previous).withColumn(
        "__wanted__", (F.col("status") == "rewritten_pass1") & predicates.needs_polish(F.col("previous_text"), F.col("rewritten_text"))
    )
    if most is not None:
        placed = sequence.positions(wanted.where("__wanted__"), group, order, "__place__").where(F.col("__place__") < most)
        wanted = wanted.drop("__wanted__").join(placed.select(*group, *order, F.lit(True).alias("__wanted__")), [*group, *order], "left")
    asked = wanted.withColumn("__ask__", F.when(F.col("__wanted__"), F.col("rewritten_text")))
    got = called(asked, "__ask__", rewriter, ["previous_text"])
    new = X.normal_space(F.col("answer"))
    same = F.size(relational.kind_mismatches(F.col("rewritten_text"), new)) == 0
    polished = F.coalesce(F.col("answer").isNotNull() & (new != "") & same, F.lit(False))
    error = F.when(F.col("__ask__").isNull(), "").when(F.col("answer_error").isNotNull(), F.col("answer_error")).when(~same, "invariant_mismatch").otherwise("")
    out = got.withColumns({"transition_polished": polished, "pass2_error": error, "invariants_ok_pass2": F.coalesce(F.col("__ask__").isNull() | same, F.lit(True))})
    out = out.withColumn("status", F.when(F.col("transition_polished"), "rewritten_pass1_pass2").otherwise(F.col("status")))
    return out.withColumn("rewritten_text", F.when(F.col("transition_polished"), new).otherwise(F.col("rewritten_text"))).drop(
        "previous", "next", "position", "previous_text", "__wanted__", "__ask__", "answer", "answer_error"
    )


def harmonised(parts: DataFrame, rewriter: Rewriter, doc: str, order: str, text: str, most: int = 8_000) -> DataFrame:
    """One text for each document: neighbouring parts are packed up to a size, joined and rewritten, level by level, until
    a document has one part."""
    now = parts.select(doc, F.col(order).cast("int").alias("__o__"), F.col(text).alias("__t__"))
    while True:  # each level but the last has fewer parts than the one before
        packed = sequence.packed(now, [doc], ["__o__"], F.length("__t__"), most, glue=2, out="__c__")
        grouped = packed.groupBy(doc, "__c__").agg(F.array_sort(F.collect_list(F.struct("__o__", "__t__"))).alias("g"))  # bounded by most
        joined = grouped.select(doc, F.col("__c__").alias("__o__"), F.array_join(F.transform("g", lambda x: x["__t__"]), "\n\n").alias("__t__"), (F.size("g") > 1).alias("__more__"))
        got = called(joined.withColumn("__ask__", F.when(F.col("__more__"), F.col("__t__"))), "__ask__", rewriter)
        merged = got.where("__more__").limit(1).count() > 0
        now = cut(got.select(doc, "__o__", F.coalesce("answer", "__t__").alias("__t__")))
        if not merged:
            break
    final = now.groupBy(doc).agg(F.array_sort(F.collect_list(F.struct("__o__", "__t__"))).alias("g"))
    return final.select(doc, F.array_join(F.transform("g", lambda x: x["__t__"]), "\n\n").alias(text))


# ---- statuses --------------------------------------------------------------------------------


def article_status(reasons: Column, error: Column | None = None) -> Column:
    out = F.when(F.size(reasons) > 0, "review_required").otherwise("succeeded")
    return out if error is None else F.when(error.isNotNull(), "failed").otherwise(out)


def document_status(mismatches: Column, segment_errors: Column, error: Column) -> Column:
    return F.when(error.isNotNull(), "error").when(F.size(mismatches) > 0, "invariant_fallback").when(segment_errors > 0, "ok_partial").otherwise("ok")
