"""Joins, set comparisons, aggregates, samples and top-k over documents and their parts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from palimpsest.functions import patterns as P
from palimpsest.functions import text as X

DONE = ("succeeded", "review_required")
#: More rules than this aren't broadcast.
MAX_BROADCAST_RULES = 10_000


# ---- joins -----------------------------------------------------------------------------------


def pending(source: DataFrame, results: DataFrame | None, version: str, key: str = "article_id", html: str = "html", changed: bool = False) -> DataFrame:
    """Source rows with a text whose key has no finished result of this version; with ``changed`` also those whose text
    isn't the one that the result was made from."""
    rows = source.where(F.col(html).isNotNull())
    if results is None:
        return rows
    done = results.where((F.col("prompt_version") == version) & F.col("status").isin(*DONE))
    if not changed:
        return rows.join(done.select(key).distinct(), key, "left_anti")
    done = done.select(F.col(key), F.col("source_html_sha256").alias("__sha__")).distinct()
    return rows.join(done, (rows[key] == done[key]) & (F.sha2(rows[html], 256) == done["__sha__"]), "left_anti")


def with_rules(nodes: DataFrame, rules: DataFrame, category: str = "category", tag: str = "tag") -> DataFrame:
    """category, tag and the ids of the active rules that apply to them, by priority and id.

    Pairs of category and tag are taken once; the rules are a small table whose size is checked, so
    they are broadcast or else joined by an exploded category.
    """
    pairs = nodes.select(category, tag).distinct()
    flat = rules.select("rule_id", "priority", F.explode("categories").alias("__c__"), "html_tags")
    flat = flat.select("rule_id", "priority", "__c__", F.explode("html_tags").alias("__t__")).distinct()
    if flat.limit(MAX_BROADCAST_RULES + 1).count() <= MAX_BROADCAST_RULES:
        flat = F.broadcast(flat)
    wanted = pairs.withColumn("__c__", F.explode(F.array_distinct(F.array(F.coalesce(F.col(category), F.lit("all")), F.lit("all")))))
    wanted = wanted.withColumn("__t__", F.explode(F.array_distinct(F.array(F.coalesce(F.col(tag), F.lit("all")), F.lit("all")))))
    found = wanted.join(flat, ["__c__", "__t__"]).select(category, tag, "rule_id", "priority").distinct()
    listed = found.groupBy(category, tag).agg(F.array_sort(F.collect_list(F.struct("priority", "rule_id"))).alias("r"))
    listed = listed.select(F.col(category).alias("__c__"), F.col(tag).alias("__t__"), "r")
    joined = pairs.join(listed, F.col(category).eqNullSafe(F.col("__c__")) & F.col(tag).eqNullSafe(F.col("__t__")), "left")
    none = F.array().cast("array<string>")
    return joined.select(category, tag, F.coalesce(F.transform("r", lambda x: x["rule_id"]), none).alias("rule_ids"))


def answered(parts: DataFrame, answers: DataFrame, key: Sequence[str], original: str, answer: str, order: str | None = None) -> DataFrame:
    """parts with revised_text and answer_issue: the answer of the same key, or the original where it is missing or blank.
    Of several answers of a key the last one counts."""
    last = F.max_by(F.col(answer), F.col(order)) if order else F.last(answer)
    one = answers.groupBy(*key).agg(last.alias("__answer__"), F.lit(True).alias("__there__"))
    joined = parts.join(one, list(key), "left")
    blank = F.trim(F.coalesce("__answer__", F.lit(""))) == ""
    issue = F.when(F.col("__there__").isNull(), "missing").when(blank, "empty")
    return joined.withColumns({"revised_text": F.when(blank, F.col(original)).otherwise(F.col("__answer__")), "answer_issue": issue}).drop("__answer__", "__there__")


def index_check(asked: DataFrame, returned: DataFrame, batch: str, index: str) -> DataFrame:
    """batch, missing and unexpected: counts of indexes that were asked for and not returned, and the other way."""
    a = asked.select(batch, index, F.lit(1).alias("a")).distinct()
    r = returned.select(batch, index, F.lit(1).alias("r")).distinct()
    both = a.join(r, [batch, index], "full_outer")
    return both.groupBy(batch).agg(F.count(F.when(F.col("r").isNull(), 1)).alias("missing"), F.count(F.when(F.col("a").isNull(), 1)).alias("unexpected"))


# ---- multisets -------------------------------------------------------------------------------


def value_counts(df: DataFrame, key: Sequence[str], text: str, kinds: Sequence[tuple[str, str, bool]] = P.INVARIANTS, names: Sequence[str] = ()) -> DataFrame:
    """key, kind, value and n: how often each value of each kind stands in a text."""
    each = df.select(*key, F.explode(X.matches_by_kind(F.col(text), kinds, names)).alias("m"))
    flat = each.select(*key, F.col("m.kind").alias("kind"), F.explode("m.values").alias("value"))
    return flat.groupBy(*key, "kind", "value").agg(F.count("*").alias("n"))


def multiset_difference(before: DataFrame, after: DataFrame, key: Sequence[str], count: str = "n") -> DataFrame:
    """key, missing and added of the values whose counts differ."""
    a, b = before.withColumnRenamed(count, "__a__"), after.withColumnRenamed(count, "__b__")
    joined = a.join(b, list(key), "full_outer").fillna(0, ["__a__", "__b__"])
    out = joined.select(*key, F.greatest(F.col("__a__") - F.col("__b__"), F.lit(0)).alias("missing"), F.greatest(F.col("__b__") - F.col("__a__"), F.lit(0)).alias("added"))
    return out.where((F.col("missing") > 0) | (F.col("added") > 0))


def kind_mismatches(original: Column, rewritten: Column, kinds: Sequence[tuple[str, str, bool]] = P.INVARIANTS) -> Column:
    """Names of the kinds whose multisets of values differ between two texts, without a shuffle; equal texts aren't searched."""
    a, b = X.matches_by_kind(original, kinds), X.matches_by_kind(rewritten, kinds)
    pairs = F.arrays_zip(a.alias("a"), b.alias("b"))
    differ = F.filter(pairs, lambda p: F.array_sort(p["a"]["values"]) != F.array_sort(p["b"]["values"]))
    none = F.array().cast("array<string>")
    return F.when(original.eqNullSafe(rewritten), none).otherwise(F.transform(differ, lambda p: p["a"]["kind"]))


def term_counts(df: DataFrame, key: Sequence[str], text: str, terms: Sequence[str], case: bool = False) -> DataFrame:
    """key, term and n of the protected terms in a text: whole words, any white space between them."""
    pattern = lambda t: r"(?<!\w)" + r"\s+".join(rf"\Q{w}\E" for w in t.split()) + r"(?!\w)"
    kept = list(dict.fromkeys(t.strip() for t in terms if t.strip()))
    counts = [F.struct(F.lit(t).alias("term"), F.regexp_count(F.col(text), F.lit("(?U)" + P.flagged(pattern(t), case))).cast("bigint").alias("n")) for t in kept]
    if not counts:
        return df.select(*key, F.lit("").alias("term"), F.lit(0).cast("bigint").alias("n")).limit(0)
    each = df.select(*key, F.explode(F.array(*counts)).alias("c")).where("c.n > 0")
    return each.select(*key, "c.term", "c.n")


def token_differences(original: Column, revised: Column, token: str = P.INLINE_TOKEN, group: int = 0) -> dict[str, Column]:
    """missing, unexpected, counts_changed and order_changed of the tokens in a text and its revision."""
    a, b = (F.regexp_extract_all(F.coalesce(c, F.lit("")), F.lit(token), F.lit(group)) for c in (original, revised))
    return {
        "missing": F.array_sort(F.array_except(a, b)),
        "unexpected": F.array_sort(F.array_except(b, a)),
        "counts_changed": F.array_sort(a) != F.array_sort(b),
        "order_changed": a != b,
    }


# ---- aggregates ------------------------------------------------------------------------------


def histogram(df: DataFrame, *by: str) -> DataFrame:
    return df.groupBy(*by).agg(F.count("*").alias("n"))


def first_of_equal(df: DataFrame, same: Sequence[Column], order: Sequence[str]) -> DataFrame:
    """The first row of those with equal values, nulls equal too; aggregated in part before the shuffle."""
    names = [f"__s{i}__" for i in range(len(same))]
    row = F.struct(*df.columns)
    best = df.withColumns(dict(zip(names, same))).groupBy(*names).agg(F.min_by(row, F.struct(*order)).alias("__row__"))
    return best.select("__row__.*")


def node_rollup(nodes: DataFrame, key: str = "article_id") -> DataFrame:
    """Counts, token sums and sorted distinct reasons and rules of each article's nodes."""
    flag = lambda c: F.coalesce(F.col(c), F.lit(False))
    strings = lambda c: F.array_sort(F.array_distinct(F.flatten(F.collect_set(F.coalesce(F.col(c), F.array().cast("array<string>"))))))
    return nodes.groupBy(key).agg(
        F.count("*").cast("int").alias("processed_node_count"),
        F.count(F.when(flag("changed") & ~flag("needs_review"), 1)).cast("int").alias("changed_node_count"),
        F.count(F.when(flag("needs_review"), 1)).cast("int").alias("reviewed_node_count"),
        F.count(F.when(~flag("changed") & ~flag("needs_review"), 1)).cast("int").alias("skipped_node_count"),
        F.sum("prompt_tokens").alias("prompt_tokens"),
        F.sum("completion_tokens").alias("completion_tokens"),
        strings("review_reasons").alias("review_reasons"),
        strings("applied_rule_ids").alias("rules_applied"),
    )


def variant_summary(detail: DataFrame, variant: str, status: str, seconds: str, chars: str, flags: Sequence[str], wall: Column | None = None) -> DataFrame:
    """Quality and throughput of each variant of a benchmark; rates to four places."""
    ok = ("ok", "ok_partial", "invariant_fallback")
    count = lambda *s: F.count(F.when(F.col(status).isin(*s), 1))
    time = F.sum(seconds) if wall is None else F.max(wall)
    out = detail.groupBy(variant).agg(
        F.count("*").alias("docs_total"),
        count(*ok).alias("docs_ok"),
        count("ok_partial").alias("docs_partial"),
        count("invariant_fallback").alias("docs_invariant_fallback"),
        time.alias("__wall__"),
        F.round(F.avg(seconds), 4).alias("avg_doc_elapsed_sec"),
        F.sum(chars).alias("__chars__"),
        *(F.round(F.avg(F.coalesce(F.col(f), F.lit(False)).cast("int")), 4).alias(f"{f}_rate") for f in flags),
    )
    per = lambda n: F.when(F.col("__wall__") > 0, F.round(n / F.col("__wall__"), 4)).otherwise(0.0)
    return out.select(
        variant, "docs_total", "docs_ok", "docs_partial", "docs_invariant_fallback",
        (F.col("docs_total") - F.col("docs_ok")).alias("docs_error"),
        F.round("__wall__", 4).alias("wall_time_sec"), "avg_doc_elapsed_sec",
        per(F.col("docs_total") * 60).alias("docs_per_min"), per(F.col("__chars__")).alias("chars_per_sec"),
        *(f"{f}_rate" for f in flags),
    )


def best_variant(summary: DataFrame, variant: str, metric: str = "docs_per_min") -> DataFrame:
    """The variant of the highest metric, the first by name on ties; a take-ordered, no sort of all."""
    return summary.orderBy(F.col(metric).desc_nulls_last(), variant).limit(1)


def longest(df: DataFrame, text: str) -> DataFrame:
    return df.agg(F.max(F.length(text)).alias("longest"))


# ---- samples, limits and top-k ---------------------------------------------------------------


def mixed(key: Column, seed: int) -> Column:
    """A number of 32 bits from the digest of a seed and a key, the same in any engine."""
    return F.conv(F.left(F.md5(F.concat_ws("|", F.lit(str(seed)), key.cast("string"))), F.lit(8)), 16, 10).cast("bigint")


def hash_sample(df: DataFrame, key: str, share: float, seed: int = 42) -> DataFrame:
    """About a share of the rows, chosen by a hash of the key: the same ones however the data is partitioned."""
    return df.where(mixed(F.col(key), seed) < int(share * (1 << 32)))


def sample_of(df: DataFrame, key: str, count: int, share: float, seed: int = 42) -> DataFrame:
    """count rows: hash-sampled ones in hash order, topped up with others where they don't suffice."""
    place = mixed(F.col(key), seed)
    order = F.struct((place >= int(share * (1 << 32))).alias("t"), place.alias("h"))
    return df.withColumn("__o__", order).orderBy("__o__", key).limit(count).drop("__o__")


def topped_up(sample: DataFrame, df: DataFrame, key: str, count: int) -> DataFrame:
    """A sample with rows of df that it lacks, in the order of the key, up to a count."""
    more = df.join(sample.select(key), key, "left_anti").withColumn("__o__", F.lit(1))
    both = sample.withColumn("__o__", F.lit(0)).unionByName(more)
    return both.orderBy("__o__", key).limit(count).drop("__o__")


def top_per_group(df: DataFrame, group: Sequence[str], order: Sequence[Column], k: int) -> DataFrame:
    """The first k rows of each group. Spark cuts each task's share to k before the shuffle."""
    return df.withColumn("__r__", F.row_number().over(Window.partitionBy(*group).orderBy(*order))).where(F.col("__r__") <= k).drop("__r__")
