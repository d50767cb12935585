"""The batch job: pending articles in, nodes rewritten and checked, results out by an idempotent upsert."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from palimpsest.functions import pyfn
from palimpsest.functions import tokens as K
from palimpsest.functions import html as H
from palimpsest.functions import patterns as P
from palimpsest.functions import text as X
from palimpsest.operators import markup, relational, rewriting
from palimpsest.session import cut
from palimpsest.sinks import tables as sinks


@dataclass(frozen=True)
class Job:
    """Settings of a run; batch_size None takes all pending articles."""

    version: str
    model: str = "offline"
    batch_size: int | None = 50
    numbered_lists: bool = False
    names: tuple[str, ...] = ()
    rewriter: rewriting.Rewriter = field(default_factory=rewriting.RuleRewriter)


def prompt_version(rules: DataFrame, label: str) -> str:
    """The label and a digest of all rules in the order of their ids: a change of any rule is a new version."""
    fields = ["rule_id", "instruction", "priority", "categories", "html_tags", "deterministic"]
    listed = rules.agg(F.to_json(F.array_sort(F.collect_list(F.struct(*fields)))).alias("j"))  # rules are a small table
    return f"{label}-{listed.select(X.version_suffix(F.col('j')).alias('v')).first().v}"


def batch(source: DataFrame, results: DataFrame | None, job: Job) -> DataFrame:
    """The next articles to do, by id."""
    rows = relational.pending(source, results, job.version)
    return rows if job.batch_size is None else rows.orderBy("article_id").limit(job.batch_size)


def _editable(source: str | None) -> list[tuple[int, str, str]]:
    out = []
    for n, node in enumerate(x for x in H.parse(source or "").walk() if x.kind == "text"):
        path = node.path()
        if node.source.strip() and not set(path) & set(P.PROTECTED_ANCESTORS) and (path[-1] if path else "") not in P.SKIPPED_PARENTS:
            out.append((n, path[-1] if path else "document", H.unescape(node.source)))
    return out


def _replaced(source: str | None, changes: list | None) -> tuple[str | None]:
    if source is None:
        return (None,)
    new = {c["node_id"]: c["text"] for c in changes or []}
    root = H.parse(source)
    for n, node in enumerate(x for x in root.walk() if x.kind == "text"):
        if n in new:
            node.source = H.escape(new[n])
    return (root.html(),)


def enriched(articles: DataFrame, job: Job, rules: DataFrame | None = None, keep: Sequence[str] = ()) -> DataFrame:
    """One result for each article, in the schema of the result table without the clock.

    Text nodes are frozen, rewritten, restored and checked; the article's facts and bold texts are
    compared as a whole; any reason for review returns the original. A null category counts as all.
    """
    base = articles.select("article_id", F.coalesce("category", F.lit("all")).alias("category"), F.col("html").alias("original_html"))
    ruled = markup.with_deterministic_rules(base.withColumn("html", F.col("original_html")), "html", job.numbered_lists, job.names)
    nodes = pyfn.exploded(ruled, ["article_id", "category"], ["html"], "node_id int, tag string, text string", _editable)
    done = rewriting.rewritten_nodes(nodes, job.rewriter, context=["category", "tag"])
    if rules is not None:
        listed = relational.with_rules(nodes, relational_rules(rules), "category", "tag")
        done = done.join(listed, ["category", "tag"], "left").withColumnRenamed("rule_ids", "applied_rule_ids")
    else:
        done = done.withColumn("applied_rule_ids", F.array().cast("array<string>"))
    done = cut(done.withColumns({"prompt_tokens": X.estimated_tokens(F.col("text")), "completion_tokens": X.estimated_tokens(F.col("rewritten_text"))}))
    counts = relational.node_rollup(done)
    changes = done.where("changed").groupBy("article_id").agg(F.collect_list(F.struct("node_id", F.col("rewritten_text").alias("text"))).alias("changes"))
    rebuilt = pyfn.with_columns(ruled.join(changes, "article_id", "left"), ["html", "changes"], "candidate string", _replaced)
    facts = pyfn.with_columns(
        rebuilt, ["original_html", "candidate"], "before_text string, after_text string, bold_same boolean",
        lambda a, b: (K.visible_text(a, skip=()), K.visible_text(b, skip=()), K.bold_texts(a) == K.bold_texts(b)),
    )
    none = F.array().cast("array<string>")
    whole = F.concat(F.when(F.col("bold_same"), none).otherwise(F.array(F.lit("Bold text changed."))), rewriting.signal_failures(F.col("before_text"), F.col("after_text")))
    joined = facts.join(counts, "article_id", "left")
    zero = [c for c in counts.columns if c.endswith("_count") or c.endswith("_tokens")]
    reasons = F.array_sort(F.array_distinct(F.concat(F.coalesce("review_reasons", none), whole)))
    judged = joined.withColumn("review_reasons", reasons).withColumn("status", rewriting.article_status(F.col("review_reasons")))
    final = F.when(F.col("status") == "succeeded", F.col("candidate")).otherwise(F.col("original_html"))
    return judged.select(
        "article_id", "category", "original_html", final.alias("enriched_html"), "status", (F.col("status") != "succeeded").alias("needs_review"),
        "review_reasons", F.coalesce("rules_applied", none).alias("rules_applied"),
        *(F.coalesce(c, F.lit(0)).alias(c) for c in zero),
        X.sha256(F.col("original_html")).alias("source_html_sha256"), X.sha256(final).alias("enriched_html_sha256"),
        F.lit(job.version).alias("prompt_version"), F.lit(job.model).alias("model_deployment"), F.lit(None).cast("string").alias("error"), *keep,
    )


def relational_rules(rules: DataFrame) -> DataFrame:
    from palimpsest.sources.tables import rules as active

    return active(rules)


def run(spark: SparkSession, source: DataFrame, path: str, job: Job, rules: DataFrame | None = None) -> int:
    """One batch: ensure the table, take the pending articles, enrich and upsert them. The number of results; a second
    run takes none of them again."""
    sinks.ensure(spark, path)
    todo = sinks.one_per_key(batch(source, spark.read.parquet(path), job), ["article_id"], [])
    results = cut(enriched(todo, job, rules).withColumn("processed_at_utc", X.utc_text(F.current_timestamp())))
    count = results.count()
    if count:
        order = [f.name for f in spark.read.parquet(path).schema]
        sinks.upsert(spark, path, results.select(*order))
    return count


def experiment(spark: SparkSession, docs: DataFrame, variants: dict[str, rewriting.Rewriter], partitions: dict[str, int] | None = None) -> DataFrame:
    """Detail rows of each variant over the same documents: doc_id, variant_id, status, chars, changed, invariants_ok. A
    variant's parallelism is its number of partitions."""
    out = None
    for name, rewriter in variants.items():
        width = (partitions or {}).get(name)
        rows = docs.repartition(width) if width else docs
        result = enriched(rows, Job(version=name, rewriter=rewriter))
        ok = F.size("review_reasons") == 0
        detail = result.select(
            F.col("article_id").alias("doc_id"), F.lit(name).alias("variant_id"), F.when(ok, "ok").otherwise("invariant_fallback").alias("status"),
            F.length("original_html").alias("input_chars"), (F.col("enriched_html_sha256") != F.col("source_html_sha256")).alias("changed"), ok.alias("invariants_ok"),
            (F.col("prompt_tokens") + F.col("completion_tokens")).cast("double").alias("elapsed_sec"),
        )
        out = detail if out is None else out.unionByName(detail)
    return out
