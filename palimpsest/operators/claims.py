"""Structured claims: parsing, deduplication, matching, comparison, and the decision on a document."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from palimpsest.functions import patterns as P
from palimpsest.functions import text as X

TEXT_FIELDS = ("claim_type", "subject", "actor", "action", "target", "modality", "condition", "timing", "approver", "value", "unit")
FLAGS = ("negated", "approval_required", "exclusive")
CLAIM_JSON = "claims array<struct<" + ",".join(f"{f}:string" for f in (*TEXT_FIELDS, *FLAGS, "severity", "source_text")) + ">>"
#: A claim of the two sides is only compared with claims of its document, in this many salted parts.
SALTS = 8
TOP_K, MIN_SCORE = 5, 0.5


def parsed(responses: DataFrame, chunk: str, body: str, keep: tuple[str, ...] = ()) -> DataFrame:
    """A row for each claim of a JSON response: normalised fields, flags with three values, severity medium where it is
    none of the known; a response that isn't JSON has no claim."""
    read = responses.select(*keep, F.col(chunk).alias("source_chunk_id"), X.json_object(F.col(body), CLAIM_JSON).alias("r"))
    each = read.select(*keep, "source_chunk_id", F.posexplode("r.claims").alias("i", "c")).where(F.col("c").isNotNull())
    source = F.coalesce(F.col("c.source_text"), F.lit(""))
    text = {f: X.none_if_empty(F.col(f"c.{f}")) for f in TEXT_FIELDS}
    text["claim_type"] = F.coalesce(F.col("c.claim_type"), F.lit("other"))
    text["modality"] = F.lower(text["modality"])
    return each.select(
        *keep,
        X.claim_id(F.col("source_chunk_id"), F.col("i") + 1, source).alias("claim_id"),
        F.col("i").alias("ord"),
        *(text[f].alias(f) for f in TEXT_FIELDS),
        *(X.optional_bool(F.col(f"c.{f}")).alias(f) for f in FLAGS),
        X.normal_severity(F.col("c.severity")).alias("severity"),
        source.alias("source_text"),
        "source_chunk_id",
    )


def deduplicated(claims: DataFrame, doc: str, order: str = "ord") -> DataFrame:
    """The first of equal claims of a document: all fields but approver and texts, nulls equal."""
    from palimpsest.operators.relational import first_of_equal

    same = [F.col(doc)] + [X.normal_value(F.coalesce(F.col(f), F.lit(""))) for f in TEXT_FIELDS if f != "approver"]
    return first_of_equal(claims, same + [F.col(f) for f in FLAGS], [order, "claim_id"])


def match_score(a: str, b: str) -> Column:
    """Weighted likeness of two claims, columns a.* and b.*."""
    of = lambda side, f: F.col(f"{side}.{f}")
    norm = lambda side, f: X.normal_value(F.coalesce(of(side, f), F.lit("")))
    equal = lambda f: norm(a, f) == norm(b, f)
    some = lambda f: norm(a, f) != ""
    yes = lambda cond, weight: F.when(F.coalesce(cond, F.lit(False)), weight).otherwise(0.0)
    like = lambda f: X.jaccard(F.coalesce(of(a, f), F.lit("")), F.coalesce(of(b, f), F.lit("")))
    return (
        yes(equal("claim_type"), 2.0)
        + 2.0 * like("action")
        + 1.5 * like("subject")
        + like("actor")
        + like("target")
        + yes(some("value") & equal("value"), 1.5)
        + yes(some("timing") & equal("timing"), 1.0)
        + yes(of(a, "approval_required") == of(b, "approval_required"), 0.5)
        + yes(of(a, "exclusive") == of(b, "exclusive"), 0.5)
    )


def candidates(original: DataFrame, rewritten: DataFrame, doc: str, k: int = TOP_K, least: float = MIN_SCORE, order: str = "ord") -> DataFrame:
    """For each original claim its k most alike rewritten claims of the document, those below ``least`` left out after
    the cut. Original claims are held against the document's rewritten ones in salted parts, and each part is cut to k
    before the parts meet."""
    left = original.select(F.col(doc).alias("d"), F.struct(*original.columns).alias("a"), F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("s"))
    right = rewritten.select(F.col(doc).alias("d"), F.struct(*rewritten.columns).alias("b"), F.pmod(F.xxhash64("claim_id"), F.lit(SALTS)).cast("int").alias("s"))
    scored = left.join(right, ["d", "s"]).withColumn("score", match_score("a", "b"))
    best = lambda *by: F.row_number().over(Window.partitionBy(*by).orderBy(F.desc("score"), f"b.{order}", "b.claim_id"))
    part = scored.withColumn("r", best("d", "a.claim_id", "s")).where(F.col("r") <= k)
    kept = part.withColumn("r", best("d", "a.claim_id")).where((F.col("r") <= k) & (F.col("score") >= least))
    return kept.select(F.col("d").alias(doc), "a", "b", "score", F.col("r").alias("rank"))


def field_issues(a: str, b: str) -> Column:
    """Types of the fields in which two claims differ, in order."""
    of = lambda side, f: F.col(f"{side}.{f}")
    differ = lambda f: X.normal_value(F.coalesce(of(a, f), F.lit(""))) != X.normal_value(F.coalesce(of(b, f), F.lit("")))
    flag = lambda f: ~of(a, f).eqNullSafe(of(b, f))
    named = (
        ("modality_change", differ("modality")),
        ("negation_change", flag("negated")),
        ("approval_change", flag("approval_required")),
        ("condition_change", differ("condition")),
        ("timing_change", differ("timing")),
        ("exclusivity_change", flag("exclusive")),
        ("value_change", differ("value")),
    )
    return F.filter(F.array(*(F.when(c, F.lit(n)) for n, c in named)), lambda x: x.isNotNull())


def issue_severity(issue: Column, severity: Column) -> Column:
    """Severity of an issue of a claim: critical, at least high, or the claim's own."""
    high = F.when(X.rank_of(severity, P.SEVERITY_RANK, 2) > P.SEVERITY_RANK["high"], severity).otherwise("high")
    return (
        F.when(issue.isin("negation_change", "approval_change", "value_change"), "critical")
        .when(issue.isin("modality_change", "condition_change", "timing_change", "exclusivity_change"), high)
        .otherwise(severity)
    )


def verdict(a: str, b: str) -> Column:
    """How the second claim keeps the first, by the first rule that holds."""
    issues = field_issues(a, b)
    has = lambda name: F.array_contains(issues, name)
    rank = lambda side: X.rank_of(X.normal_value(F.coalesce(F.col(f"{side}.modality"), F.lit(""))), P.MODALITY_RANK, 0)
    source = lambda side: X.normal_value(F.coalesce(F.col(f"{side}.source_text"), F.lit("")))
    return (
        F.when((F.size(issues) == 0) & (source(a) != source(b)), "preserved_but_rephrased")
        .when(F.size(issues) == 0, "preserved")
        .when(has("negation_change"), "contradicted")
        .when(has("approval_change") | has("exclusivity_change"), "weakened")
        .when(has("modality_change") & (rank(b) < rank(a)), "weakened")
        .when(has("modality_change") & (rank(b) > rank(a)), "strengthened")
        .otherwise("uncertain")
    )


def compared(original: DataFrame, rewritten: DataFrame, doc: str, order: str = "ord") -> tuple[DataFrame, DataFrame]:
    """Results of the original claims (missing where there is no candidate), and rewritten claims that none matched."""
    best = candidates(original, rewritten, doc, order=order).where("rank = 1")
    found = best.select(
        doc, F.col("a.claim_id").alias("claim_id"), F.col("b.claim_id").alias("matched_claim_id"), "score", verdict("a", "b").alias("result"), field_issues("a", "b").alias("issues")
    )
    own = original.select(doc, "claim_id", "severity", F.col(order).alias("ord"))
    none = F.array().cast("array<string>")
    results = own.join(found, [doc, "claim_id"], "left").withColumn("result", F.coalesce("result", F.lit("missing"))).withColumn("issues", F.coalesce("issues", none))
    matched = found.select(doc, F.col("matched_claim_id").alias("claim_id")).distinct()
    return results, rewritten.join(matched, [doc, "claim_id"], "left_anti")


def decisions(docs: DataFrame, doc: str, numeric_ok: str, terms_ok: str, results: DataFrame, unsupported: DataFrame, judged_equal: str | None = None, rules: Mapping[str, bool] | None = None) -> DataFrame:
    """doc, decision and reason: fail, review or pass by the first rule that holds. Rules can be switched off by name:
    numeric, terms, missing, contradicted, uncertain, unsupported."""
    on = {n: True for n in ("numeric", "terms", "missing", "contradicted", "uncertain", "unsupported")} | dict(rules or {})
    grave = F.col("severity").isin("critical", "high")
    problem = (
        F.when((F.col("result") == "missing") & (F.col("severity") == "critical") & F.lit(on["missing"]), F.lit("Critical claim missing: "))
        .when((F.col("result") == "contradicted") & F.lit(on["contradicted"]), F.lit("Contradicted claim detected: "))
        .when((F.col("result") == "weakened") & grave, F.lit("High-risk claim weakened: "))
    )
    counted = results.withColumn("__p__", F.concat(problem, F.col("claim_id"))).groupBy(doc).agg(
        F.min_by("__p__", F.struct(F.col("__p__").isNull(), "ord", "claim_id")).alias("__first__"),
        F.count(F.when(F.col("result") == "uncertain", 1)).alias("__uncertain__"),
    )
    added = unsupported.groupBy(doc).agg(F.count("*").alias("__new__"))
    joined = docs.join(counted, doc, "left").join(added, doc, "left")
    zero = lambda c: F.coalesce(F.col(c), F.lit(0))
    steps = [
        (F.lit(on["numeric"]) & ~F.col(numeric_ok), "fail", F.lit("Numeric integrity check failed.")),
        (F.lit(on["terms"]) & ~F.col(terms_ok), "fail", F.lit("Protected terminology/entity check failed.")),
        (F.col("__first__").isNotNull(), "fail", F.col("__first__")),
        (F.lit(on["uncertain"]) & (zero("__uncertain__") > 0), "review", F.concat(zero("__uncertain__").cast("string"), F.lit(" claim(s) remain uncertain."))),
        (F.lit(on["unsupported"]) & (zero("__new__") > 0), "review", F.lit("Unsupported new claims were introduced.")),
    ]
    if judged_equal:
        steps.append((~F.coalesce(F.col(judged_equal), F.lit(False)), "review", F.lit("Final semantic judge found meaning drift.")))
    decision, reason = F.lit("pass"), F.lit("All checks passed.")
    for cond, name, why in reversed(steps):
        decision, reason = F.when(cond, name).otherwise(decision), F.when(cond, why).otherwise(reason)
    return joined.select(doc, decision.alias("decision"), reason.alias("reason"))


def from_sentences(df: DataFrame, doc: str, text: str, kind: Column, keep: tuple[str, ...] = ()) -> DataFrame:
    """Claims that a text states by its form, without a model: one for each sentence, with modality, negation, first
    value, unit, time and condition found by patterns."""
    each = df.select(*keep, F.col(doc), kind.alias("claim_type"), F.posexplode(X.sentences(F.col(text))).alias("ord", "source_text"))
    s = F.col("source_text")
    each = each.where(s.rlike(r"[\p{L}\p{N}]"))
    got = lambda p, g=0: F.nullif(F.regexp_extract(s, p, g), F.lit(""))
    words = F.split(X.normal_value(F.regexp_replace(s, r"[^\p{L}\s]", " ")), " ")
    return each.select(
        *keep, doc, "claim_type", "ord",
        F.concat_ws("_", F.lit("c"), F.substring(F.sha1(F.concat_ws("|", F.col(doc), "ord", s)), 1, 12)).alias("claim_id"),
        F.array_join(F.slice(words, 1, 3), " ").alias("subject"),
        F.lit(None).cast("string").alias("actor"),
        F.array_join(F.slice(words, 4, 4), " ").alias("action"),
        F.lit(None).cast("string").alias("target"),
        F.lower(got(r"(?i)\b(must|should|may|can|cannot|will)\b")).alias("modality"),
        F.regexp_like(s, F.lit(r"(?i)\b(not|cannot|never|no longer)\b")).alias("negated"),
        got(r"(?i)\b(?:if|unless|when|once)\b[^,.]*").alias("condition"),
        got(r"(?i)\b(?:within|after|in) \d+ \w+").alias("timing"),
        F.when(s.rlike(r"(?i)\b(approv|review)\w*"), True).alias("approval_required"),
        F.lit(None).cast("string").alias("approver"),
        got(r"\d[\d,]*(?:\.\d+)?").alias("value"),
        got(r"(?:USD|EUR|GBP|[€£$])").alias("unit"),
        F.when(s.rlike(r"(?i)\bonly\b"), True).alias("exclusive"),
        F.when(s.rlike(r"(?:USD|EUR|GBP|[€£$])"), "high").otherwise("medium").alias("severity"),
        "source_text",
    )


# ---- with a model ----------------------------------------------------------------------------


def extracted(chunks: DataFrame, doc: str, chunk: str, text: str, model) -> DataFrame:
    """Claims that a model finds in the chunks of each document, the first of equal ones; a failed call has none."""
    from palimpsest.functions import prompts
    from palimpsest.operators.rewriting import called

    asked = chunks.select(doc, chunk, prompts.claims_column(F.col(text), (*TEXT_FIELDS, *FLAGS, "severity", "source_text")).alias("__ask__"))
    return deduplicated(parsed(called(asked, "__ask__", model), chunk, "answer", (doc,)), doc)


def assisted(results: DataFrame, candidates_: DataFrame, doc: str, model) -> DataFrame:
    """Results with those that fields leave open (uncertain, weakened, strengthened) judged by a model over the claim and
    its candidates; an answer that isn't JSON or a failed call changes nothing. method says who decided."""
    from palimpsest.functions import prompts
    from palimpsest.operators.rewriting import called

    listed = candidates_.groupBy(doc, F.col("a.claim_id").alias("claim_id")).agg(  # at most k candidates
        F.first(F.to_json("a")).alias("__claim__"), F.to_json(F.array_sort(F.collect_list(F.struct("rank", "b")))).alias("__all__")
    )
    open_ = results.where(F.col("result").isin("uncertain", "weakened", "strengthened")).select(doc, "claim_id").join(listed, [doc, "claim_id"])
    asked = open_.select(doc, "claim_id", prompts.comparison_column(F.col("__claim__"), F.col("__all__")).alias("__ask__"))
    answer = X.json_object(F.col("answer"), "result string, best_match_claim_id string, severity string, explanation string")
    told = called(asked, "__ask__", model).select(doc, "claim_id", answer.alias("__m__")).where("__m__.result is not null")
    joined = results.join(told, [doc, "claim_id"], "left")
    return joined.withColumns(
        {
            "result": F.coalesce("__m__.result", "result"),
            "matched_claim_id": F.coalesce("__m__.best_match_claim_id", "matched_claim_id"),
            "method": F.when(F.col("__m__").isNotNull(), "model").otherwise("fields"),
        }
    ).drop("__m__")


def judged(pairs: DataFrame, doc: str, before: str, after: str, findings: str, model) -> DataFrame:
    """doc and semantic_equivalent as a model judges two texts; false where it gives no answer."""
    from palimpsest.functions import prompts
    from palimpsest.operators.rewriting import called

    asked = pairs.select(doc, prompts.judgement_column(F.col(before), F.col(after), F.col(findings)).alias("__ask__"))
    answer = X.json_object(F.col("answer"), "semantic_equivalent boolean, summary string")
    return called(asked, "__ask__", model).select(doc, F.coalesce(answer["semantic_equivalent"], F.lit(False)).alias("semantic_equivalent"))
