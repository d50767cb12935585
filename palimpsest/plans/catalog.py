"""All queries of the engine by name, over whole tables, with the SQL that checks them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from palimpsest.functions import patterns as P
from palimpsest.functions import text as X
from palimpsest.operators import claims, markup, predicates, relational, rewriting, sequence
from palimpsest.plans import enrich, evaluate, history
from palimpsest.session import cut, table
from palimpsest.sinks import tables as sinks
from palimpsest.sources import tables as sources

Query = Callable[[SparkSession, str], DataFrame]
_QUERIES: dict[str, Query] = {}
_SQL: dict[str, str] = {}

VERSION = "kb-safe-v1"
TERMS = ("business card", "home loan", "deposit note", "savings account")
BLOCK_KEY = ["article_id", "block_id"]


def query(sql: str | None = None):
    """Register a query under its function's name, with its SQL."""

    def add(fn: Query) -> Query:
        _QUERIES[fn.__name__] = fn
        if sql is not None:
            _SQL[fn.__name__] = sql
        return fn

    return add


def queries() -> dict[str, Query]:
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(_SQL)


def _q(pattern: str, case: bool = True) -> str:
    """A pattern as an SQL literal."""
    return "'" + P.flagged(pattern, case).replace("'", "''") + "'"


def _has(column: str, pattern: str, case: bool = True) -> str:
    """SQL for a match anywhere, with the word boundaries of Unicode, which RE2's own aren't."""
    edge = r"(?:^|[^\pL\pN_])", r"(?:$|[^\pL\pN_])"
    start, stop = pattern.startswith(r"\b"), pattern.endswith(r"\b")
    inner = pattern[2 * start : len(pattern) - 2 * stop]
    return f"regexp_matches({column}, {_q(edge[0] * start + inner + edge[1] * stop, case)})"


#: White space of Unicode, which RE2 has no class for.
_S = r"[\s\x{0B}\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]"
_STRIP = "regexp_replace({0}, '^" + _S.replace("{", "{{").replace("}", "}}") + "+|" + _S.replace("{", "{{").replace("}", "}}") + "+$', '', 'g')"
_WIDE = r"\x{C0}-\x{D6}\x{D8}-\x{F6}\x{F8}-\x{24F}\x{300}-\x{52F}\x{FF10}-\x{FF19}\x{FF21}-\x{FF3A}\x{FF41}-\x{FF5A}\x{FB00}-\x{FB06}\x{AA}\x{B5}\x{BA}"


def _found(column: str, kind: tuple[str, str, bool]) -> str:
    """SQL list of a kind's stripped matches that aren't blank."""
    # letters and digits outside ASCII are none to RE2's word boundaries, so they are made underscores, which are
    text = f"regexp_replace(coalesce({column}, ''), '[{_WIDE}]', '_', 'g')"
    return f"list_filter(list_transform(regexp_extract_all({text}, {_q(kind[1], kind[2])}), lambda x: trim(x)), lambda x: x <> '')"


def blocks(spark: SparkSession, folder: str) -> DataFrame:
    """Each block once."""
    return table(spark, folder, "block_audit").dropDuplicates(BLOCK_KEY)


def of_blocks(spark: SparkSession, folder: str, *columns) -> DataFrame:
    """Columns worked out for each block: before repeated rows are dropped, so that no text is shuffled."""
    return table(spark, folder, "block_audit").select(*BLOCK_KEY, *columns).dropDuplicates(BLOCK_KEY)


_BLOCKS = "(SELECT article_id, block_id, any_value(original_text) AS original_text, any_value(rewritten_text) AS rewritten_text, any_value(status) AS status, any_value(tag) AS tag, any_value(source_system) AS source_system, any_value(heading) AS heading FROM block_audit GROUP BY article_id, block_id)"


def segments(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "segments").dropDuplicates(["article_id", "seg_id"])


_SEGMENTS = "(SELECT DISTINCT ON (article_id, seg_id) * FROM segments)"


def articles(spark: SparkSession, folder: str) -> DataFrame:
    """Each article once."""
    return table(spark, folder, "articles").select("article_id", "category", "html").dropDuplicates(["article_id"])


_ARTICLES = "(SELECT article_id, any_value(category) AS category, any_value(html) AS html FROM articles GROUP BY article_id)"


# ---- the flagship ----------------------------------------------------------------------------


@query()
def enrich_articles(spark: SparkSession, folder: str) -> DataFrame:
    """All articles through the batch job with the offline rewriter: the result rows without the texts."""
    todo = relational.pending(articles(spark, folder), None, VERSION)
    done = enrich.enriched(todo, enrich.Job(VERSION), table(spark, folder, "rules"))
    return done.drop("original_html", "enriched_html", "error")


def flagship(spark: SparkSession, folder: str) -> DataFrame:
    return enrich_articles(spark, folder)


# ---- sources, filters, joins -----------------------------------------------------------------


@query(
    f"SELECT DISTINCT article_id, category, sha256(html) AS html_sha256 FROM articles WHERE html IS NOT NULL AND article_id NOT IN "
    f"(SELECT article_id FROM enriched_articles WHERE prompt_version = '{VERSION}' AND status IN ('succeeded', 'review_required'))"
)
def pending_articles(spark: SparkSession, folder: str) -> DataFrame:
    rows = relational.pending(table(spark, folder, "articles"), table(spark, folder, "enriched_articles"), VERSION)
    return rows.select("article_id", "category", X.sha256(F.col("html")).alias("html_sha256")).distinct()


@query(
    f"SELECT article_id, category, html FROM (SELECT DISTINCT article_id, category, html FROM articles WHERE html IS NOT NULL AND article_id NOT IN "
    f"(SELECT article_id FROM enriched_articles WHERE prompt_version = '{VERSION}' AND status IN ('succeeded', 'review_required'))) ORDER BY article_id LIMIT 50"
)
def pending_batch(spark: SparkSession, folder: str) -> DataFrame:
    """The next batch of the job; the limit is its batch size."""
    rows = table(spark, folder, "articles").select("article_id", "category", "html").distinct()
    return enrich.batch(rows, table(spark, folder, "enriched_articles"), enrich.Job(VERSION))


@query(
    "SELECT a.article_id, a.sha AS html_sha256 FROM (SELECT DISTINCT article_id, sha256(html) AS sha FROM articles WHERE html IS NOT NULL) a "
    f"WHERE NOT EXISTS (SELECT 1 FROM enriched_articles e WHERE e.prompt_version = '{VERSION}' AND e.status IN ('succeeded', 'review_required') "
    "AND e.article_id = a.article_id AND e.source_html_sha256 = a.sha)"
)
def pending_changed(spark: SparkSession, folder: str) -> DataFrame:
    """Pending articles, with those whose source changed since."""
    rows = relational.pending(table(spark, folder, "articles"), table(spark, folder, "enriched_articles"), VERSION, changed=True)
    return rows.select("article_id", X.sha256(F.col("html")).alias("html_sha256")).distinct()


@query(
    f"SELECT CAST(doc_id AS VARCHAR) AS doc_id, coalesce(collection, 'internal') AS category, length(text) AS n FROM documents WHERE length(text) >= {P.MIN_DOCUMENT_CHARS}"
)
def long_documents(spark: SparkSession, folder: str) -> DataFrame:
    """Probed columns, null texts left out, texts from a length on."""
    docs = sources.probed(table(spark, folder, "documents"), "text", "doc_id", "collection")
    return docs.where(F.length("html_text") >= P.MIN_DOCUMENT_CHARS).select("doc_id", "category", F.length("html_text").cast("bigint").alias("n"))


@query(
    "SELECT rule_id, priority, CASE WHEN coalesce(len(categories), 0) = 0 THEN ['all'] ELSE categories END AS categories, "
    "CASE WHEN coalesce(len(html_tags), 0) = 0 THEN ['all'] ELSE html_tags END AS html_tags FROM rules WHERE active"
)
def active_rules(spark: SparkSession, folder: str) -> DataFrame:
    return sources.rules(table(spark, folder, "rules")).select("rule_id", "priority", "categories", "html_tags")


@query(
    """
    WITH r AS (SELECT rule_id, priority, CASE WHEN coalesce(len(categories), 0) = 0 THEN ['all'] ELSE categories END AS c,
                      CASE WHEN coalesce(len(html_tags), 0) = 0 THEN ['all'] ELSE html_tags END AS t FROM rules WHERE active),
         p AS (SELECT DISTINCT coalesce(a.category, 'all') AS category, n.parent_tag AS tag
               FROM node_results n JOIN (SELECT DISTINCT article_id, category FROM articles) a USING (article_id))
    SELECT p.category, p.tag, coalesce(list(r.rule_id ORDER BY r.priority, r.rule_id) FILTER (r.rule_id IS NOT NULL), []) AS rule_ids
    FROM p LEFT JOIN r ON (list_contains(r.c, 'all') OR list_contains(r.c, p.category)) AND (list_contains(r.t, 'all') OR list_contains(r.t, p.tag))
    GROUP BY p.category, p.tag
    """
)
def rule_applicability(spark: SparkSession, folder: str) -> DataFrame:
    """The rules of each category and tag that occur together."""
    nodes = table(spark, folder, "node_results").select("article_id", F.col("parent_tag").alias("tag"))
    kinds = table(spark, folder, "articles").select("article_id", F.coalesce("category", F.lit("all")).alias("category")).distinct()
    return relational.with_rules(nodes.join(kinds, "article_id"), sources.rules(table(spark, folder, "rules")))


@query(
    "SELECT article_id, seg_id, CASE WHEN trim(coalesce(revised_text, '')) = '' THEN original_text ELSE revised_text END AS revised_text, "
    f"CASE WHEN revised_text IS NULL THEN 'missing' WHEN trim(revised_text) = '' THEN 'empty' END AS answer_issue FROM {_SEGMENTS}"
)
def answers_by_id(spark: SparkSession, folder: str) -> DataFrame:
    """Answers joined to their segments, the original where one is missing or blank."""
    parts = segments(spark, folder)
    answers = parts.where(F.col("revised_text").isNotNull()).select("article_id", "seg_id", F.col("revised_text").alias("answer"))
    asked = parts.select("article_id", "seg_id", "original_text")
    return relational.answered(asked, answers, ["article_id", "seg_id"], "original_text", "answer").drop("original_text")


@query(
    f"SELECT article_id, count(*) FILTER (revised_text IS NULL) AS missing, 0::BIGINT AS unexpected FROM {_SEGMENTS} GROUP BY article_id"
)
def index_check(spark: SparkSession, folder: str) -> DataFrame:
    asked = segments(spark, folder)
    return relational.index_check(asked, asked.where(F.col("revised_text").isNotNull()), "article_id", "seg_id")


@query(
    f"SELECT DISTINCT article_id FROM enriched_articles WHERE prompt_version = '{VERSION}' AND status IN ('succeeded', 'review_required')"
)
def finished_ids(spark: SparkSession, folder: str) -> DataFrame:
    done = table(spark, folder, "enriched_articles").where((F.col("prompt_version") == VERSION) & F.col("status").isin(*relational.DONE))
    return done.select("article_id").distinct()


# ---- invariants and validators ---------------------------------------------------------------


@query(
    " UNION ALL ".join(
        f"SELECT lang, '{k[0]}' AS kind, count(*) AS n, count(DISTINCT v) AS n_values FROM (SELECT lang, unnest({_found('text', k)}) AS v FROM documents) GROUP BY lang"
        for k in P.INVARIANTS
    )
)
def invariant_counts(spark: SparkSession, folder: str) -> DataFrame:
    """Facts in the documents by language and kind, and how many distinct ones."""
    counts = relational.value_counts(table(spark, folder, "documents"), ["lang"], "text")
    return counts.groupBy("lang", "kind").agg(F.sum("n").alias("n"), F.count("*").alias("n_values"))


_MISMATCH = ", ".join(
    f"CASE WHEN list_sort({_found('original_text', k)}) <> list_sort({_found('rewritten_text', k)}) THEN '{k[0]}' END" for k in P.INVARIANTS
)


@query(f"SELECT article_id, block_id, array_to_string(list_filter([{_MISMATCH}], lambda x: x IS NOT NULL), ',') AS kinds FROM {_BLOCKS}")
def invariant_mismatches(spark: SparkSession, folder: str) -> DataFrame:
    """Kinds of facts whose multiset differs between a block and its rewrite."""
    kinds = relational.kind_mismatches(F.col("original_text"), F.col("rewritten_text"))
    return of_blocks(spark, folder, F.array_join(kinds, ",").alias("kinds"))


_NUM = P.INVARIANTS[0]


@query(
    f"""
    WITH a AS (SELECT article_id, value, count(*) AS n FROM (SELECT article_id, unnest({_found('original_text', _NUM)}) AS value FROM {_BLOCKS}) GROUP BY ALL),
         b AS (SELECT article_id, value, count(*) AS n FROM (SELECT article_id, unnest({_found('rewritten_text', _NUM)}) AS value FROM {_BLOCKS}) GROUP BY ALL)
    SELECT article_id, value, greatest(coalesce(a.n, 0) - coalesce(b.n, 0), 0) AS missing, greatest(coalesce(b.n, 0) - coalesce(a.n, 0), 0) AS added
    FROM a FULL JOIN b USING (article_id, value) WHERE coalesce(a.n, 0) <> coalesce(b.n, 0)
    """
)
def number_differences(spark: SparkSession, folder: str) -> DataFrame:
    """Numbers an article lost or gained by its rewrite."""
    rows = blocks(spark, folder)
    a, b = (relational.value_counts(rows, ["article_id"], c, [_NUM]).drop("kind") for c in ("original_text", "rewritten_text"))
    return relational.multiset_difference(a, b, ["article_id", "value"])


@query()
def numeric_integrity(spark: SparkSession, folder: str) -> DataFrame:
    """Numeric items by kind and priority that a node's rewrite lost or brought in."""
    nodes = table(spark, folder, "node_results").dropDuplicates(["article_id", "node_id"])
    return evaluate.numeric_changes(nodes, ["article_id"], "original_text", "rewritten_text")


@query(
    " UNION ALL ".join(
        f"SELECT doc_id, '{t}' AS term, len(regexp_extract_all(text, '(?i)\\b{t.replace(' ', _S + '+')}\\b')) AS n FROM documents WHERE len(regexp_extract_all(text, '(?i)\\b{t.replace(' ', _S + '+')}\\b')) > 0"
        for t in TERMS
    )
)
def protected_terms(spark: SparkSession, folder: str) -> DataFrame:
    return relational.term_counts(table(spark, folder, "documents"), ["doc_id"], "text", TERMS)


_RATIO = "length(trim(coalesce(rewritten_text, ''))) / greatest(length(trim(original_text)), 1)"


@query(
    f"SELECT article_id, node_id, CASE WHEN length(trim(coalesce(original_text, ''))) > 0 THEN round({_RATIO}, 6) END AS ratio, "
    f"CASE WHEN length(trim(coalesce(original_text, ''))) > 0 THEN {_RATIO} BETWEEN 0.65 AND 1.35 ELSE true END AS is_safe "
    "FROM (SELECT DISTINCT ON (article_id, node_id) article_id, node_id, " + _STRIP.format("original_text") + " AS original_text, "
    + _STRIP.format("rewritten_text") + " AS rewritten_text FROM node_results)"
)
def length_ratios(spark: SparkSession, folder: str) -> DataFrame:
    key = ["article_id", "node_id"]
    a, b = F.col("original_text"), F.col("rewritten_text")
    rows = table(spark, folder, "node_results").select(*key, F.round(X.length_ratio(a, b), 6).alias("ratio"), X.length_is_safe(a, b).alias("is_safe"))
    return rows.dropDuplicates(key)


_T = "regexp_extract_all(coalesce({}, ''), '⟦/?(\\d+)⟧')"
_A, _B = _T.format("original_text"), _T.format("revised_text")


@query(
    f"SELECT article_id, seg_id, array_to_string(list_sort(list_distinct(list_filter({_A}, lambda x: NOT list_contains({_B}, x)))), ',') AS missing, "
    f"array_to_string(list_sort(list_distinct(list_filter({_B}, lambda x: NOT list_contains({_A}, x)))), ',') AS unexpected, "
    f"list_sort({_A}) <> list_sort({_B}) AS counts_changed, {_A} <> {_B} AS order_changed FROM {_SEGMENTS}"
)
def token_differences(spark: SparkSession, folder: str) -> DataFrame:
    """Inline tokens that a segment's revision lost, gained, repeated or moved."""
    found = relational.token_differences(F.col("original_text"), F.col("revised_text"))
    flat = {k: F.array_join(v, ",") if k in ("missing", "unexpected") else v for k, v in found.items()}
    rows = table(spark, folder, "segments").select("article_id", "seg_id", *(c.alias(k) for k, c in flat.items()))
    return rows.dropDuplicates(["article_id", "seg_id"])


@query(
    rf"""
    WITH w AS (SELECT article_id, seg_id, revised_text AS t, list_distinct(regexp_extract_all(coalesce(original_text, ''), '{P.INLINE_TOKEN}', 1)) AS wanted FROM {_SEGMENTS}),
         e AS (SELECT article_id, seg_id, wanted, unnest(l) AS token, generate_subscripts(l, 1) AS pos FROM (SELECT article_id, seg_id, wanted, regexp_extract_all(coalesce(t, ''), '⟦/?\d+⟧') AS l FROM w)),
         p AS (SELECT *, regexp_extract(token, '\d+') AS n, token LIKE '⟦/%' AS stops, row_number() OVER (PARTITION BY article_id, seg_id, token ORDER BY pos) AS k FROM e),
         r AS (SELECT article_id, seg_id, n, k, min(pos) FILTER (NOT stops) AS a, min(pos) FILTER (stops) AS b FROM p GROUP BY ALL),
         c AS (SELECT article_id, seg_id, x.n, count(DISTINCT a) AS starts, count(DISTINCT b) AS ends FROM (SELECT article_id, seg_id, unnest(wanted) AS n FROM w) x LEFT JOIN r USING (article_id, seg_id, n) GROUP BY ALL),
         i AS (
           SELECT article_id, seg_id, 0 AS o1, '' AS o2, 0 AS o3, 0 AS o4, 'empty_revision' AS issue FROM w WHERE trim(regexp_replace(coalesce(t, ''), '{_S}+', ' ', 'g')) = ''
           UNION ALL SELECT article_id, seg_id, 1, '', 0, 0, 'token_missing:' || string_agg(n, ',' ORDER BY n) FROM c WHERE starts + ends = 0 GROUP BY ALL
           UNION ALL SELECT article_id, seg_id, 2, '', 0, 0, 'token_unexpected:' || string_agg(DISTINCT n, ',' ORDER BY n) FROM p WHERE NOT list_contains(wanted, n) GROUP BY article_id, seg_id
           UNION ALL SELECT article_id, seg_id, 3, n, 0, k, 'token_stray_close:' || n FROM r WHERE b IS NOT NULL AND (a IS NULL OR b < a)
           UNION ALL SELECT article_id, seg_id, 3, n, 1, k, 'token_unclosed:' || n FROM r WHERE b IS NULL
           UNION ALL SELECT x.article_id, x.seg_id, 4, '', x.a, y.a, 'token_misnested:' || y.n || ':' || x.n FROM r x JOIN r y ON x.article_id = y.article_id AND x.seg_id = y.seg_id AND x.n <> y.n AND x.a < y.a AND y.a < x.b AND x.b < y.b
           UNION ALL SELECT article_id, seg_id, 5, n, 0, 0, 'token_open_count:' || n || ':' || starts FROM c WHERE starts <> 1
           UNION ALL SELECT article_id, seg_id, 5, n, 1, 0, 'token_close_count:' || n || ':' || ends FROM c WHERE ends <> 1)
    SELECT article_id, seg_id, coalesce(string_agg(issue, '; ' ORDER BY o1, o2, o3, o4) FILTER (o1 = 0 OR NOT empty), '') AS issues
    FROM w LEFT JOIN (SELECT *, min(o1) OVER (PARTITION BY article_id, seg_id) = 0 AS empty FROM i) j USING (article_id, seg_id) GROUP BY article_id, seg_id
    """
)
def token_structure(spark: SparkSession, folder: str) -> DataFrame:
    """Issues of the inline tokens' structure in each segment's revision."""
    tags = F.transform(F.array_distinct(F.regexp_extract_all(F.coalesce("original_text", F.lit("")), F.lit(P.INLINE_TOKEN), F.lit(1))), lambda t: F.struct(t.alias("token")))
    rows = segments(spark, folder).select("article_id", "seg_id", "revised_text", tags.alias("tags"))
    return rewriting.token_issues(rows, "revised_text").select("article_id", "seg_id", F.array_join("issues", "; ").alias("issues"))


@query(f"SELECT article_id, seg_id, true AS same FROM {_SEGMENTS} WHERE original_text IS NOT NULL")
def freeze_restore(spark: SparkSession, folder: str) -> DataFrame:
    """Whether freezing a text and restoring it gives the text again."""
    rows = segments(spark, folder).where(F.col("original_text").isNotNull())
    done = rewriting.frozen(rows, "original_text")
    same = rewriting.restored(F.col("frozen_text"), F.col("tokens")) == F.col("original_text")
    return done.select("article_id", "seg_id", same.alias("same"))


@query(
    f"""
    SELECT lang, source, count(*) AS n, count(*) FILTER (risky) AS n_risky FROM (
      SELECT lang, source, coalesce({_has('text', P.DISCLOSURE, False)} OR {_has('text', P.RATE_WORD, False)}
        OR {" OR ".join(_has('text', k[1], k[2]) for k in P.INVARIANTS if k[0] in ("percentages", "currencies", "dates", "ids"))}
        OR ({_has('text', P.AMOUNT_WORD, False)} AND {_has('text', _NUM[1])}), false) AS risky FROM documents)
    GROUP BY lang, source
    """
)
def high_risk_documents(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("lang", "source", predicates.high_risk(F.col("text")).alias("risky"))
    return docs.groupBy("lang", "source").agg(F.count("*").alias("n"), F.count(F.when(F.col("risky"), 1)).alias("n_risky"))


# ---- routing, statuses, aggregates -----------------------------------------------------------


@query(
    f"SELECT article_id, route, count(*) AS n FROM (SELECT article_id, CASE WHEN is_non_editable THEN 'non_editable' WHEN coalesce(approved_tag, '') = '' THEN 'non_prose' "
    f"WHEN is_protected THEN 'protected' WHEN is_high_risk_block OR is_high_risk_content THEN 'high_risk' ELSE 'editable' END AS route FROM {_SEGMENTS}) GROUP BY ALL"
)
def segment_routes(spark: SparkSession, folder: str) -> DataFrame:
    rows = markup.routed(table(spark, folder, "segments")).select("article_id", "seg_id", "route").dropDuplicates(["article_id", "seg_id"])
    return relational.histogram(rows, "article_id", "route")


@query("SELECT status, coalesce(skip_reason, '') AS skip_reason, count(*) AS n FROM block_audit GROUP BY ALL")
def status_histogram(spark: SparkSession, folder: str) -> DataFrame:
    return relational.histogram(table(spark, folder, "block_audit").select("status", F.coalesce("skip_reason", F.lit("")).alias("skip_reason")), "status", "skip_reason")


@query(
    f"SELECT tag, reason, count(*) AS n FROM (SELECT tag, CASE WHEN length(original_text) < 20 THEN 'too_short' WHEN length(original_text) > 3500 THEN 'too_long' "
    f"WHEN coalesce({_has('original_text', P.DISCLOSURE, False)} OR {_has('original_text', P.RATE_WORD, False)} OR "
    + " OR ".join(_has('original_text', k[1], k[2]) for k in P.INVARIANTS if k[0] in ("percentages", "currencies", "dates", "ids"))
    + f" OR ({_has('original_text', P.AMOUNT_WORD, False)} AND {_has('original_text', _NUM[1])}), false) THEN 'high_risk_content' ELSE '' END AS reason FROM {_BLOCKS}) GROUP BY ALL"
)
def freeze_reasons(spark: SparkSession, folder: str) -> DataFrame:
    """Why blocks stay as they are, by their text."""
    reason = predicates.freeze_reason(F.col("original_text"), F.array().cast("array<string>"), F.lit(False))
    return relational.histogram(of_blocks(spark, folder, "tag", reason.alias("reason")), "tag", "reason")


_STRINGS = "array_to_string(list_sort(list_distinct(flatten(list(coalesce({0}, []))))), ',') AS {1}"


@query(
    "SELECT article_id, count(*)::INT AS processed_node_count, count(*) FILTER (coalesce(changed, false) AND NOT coalesce(needs_review, false))::INT AS changed_node_count, "
    "count(*) FILTER (coalesce(needs_review, false))::INT AS reviewed_node_count, count(*) FILTER (NOT coalesce(changed, false) AND NOT coalesce(needs_review, false))::INT AS skipped_node_count, "
    "sum(prompt_tokens)::BIGINT AS prompt_tokens, sum(completion_tokens)::BIGINT AS completion_tokens, "
    f"{_STRINGS.format('review_reasons', 'review_reasons')}, {_STRINGS.format('applied_rule_ids', 'rules_applied')}, "
    "CASE WHEN bool_or(len(coalesce(review_reasons, [])) > 0) THEN 'review_required' ELSE 'succeeded' END AS status "
    "FROM (SELECT DISTINCT ON (article_id, node_id) * FROM node_results) GROUP BY article_id"
)
def article_rollup(spark: SparkSession, folder: str) -> DataFrame:
    """Counts, tokens, reasons, rules and status of each article from its nodes."""
    rows = relational.node_rollup(table(spark, folder, "node_results").dropDuplicates(["article_id", "node_id"]))
    rows = rows.withColumn("status", rewriting.article_status(F.col("review_reasons")))
    return rows.withColumns({c: F.array_join(c, ",") for c in ("review_reasons", "rules_applied")})


_DETAIL = (
    "(SELECT prompt_version AS variant_id, CASE status WHEN 'succeeded' THEN 'ok' WHEN 'review_required' THEN 'invariant_fallback' ELSE 'error' END AS status, "
    "(coalesce(prompt_tokens, 0) + coalesce(completion_tokens, 0)) / 1000.0 AS seconds, length(original_html) AS chars, changed_node_count > 0 AS changed, NOT needs_review AS invariants_ok FROM enriched_articles)"
)


def _detail(spark: SparkSession, folder: str) -> DataFrame:
    status = F.when(F.col("status") == "succeeded", "ok").when(F.col("status") == "review_required", "invariant_fallback").otherwise("error")
    seconds = ((F.coalesce("prompt_tokens", F.lit(0)) + F.coalesce("completion_tokens", F.lit(0))) / 1000).alias("seconds")
    return table(spark, folder, "enriched_articles").select(
        F.col("prompt_version").alias("variant_id"), status.alias("status"), seconds, F.length("original_html").alias("chars"), (F.col("changed_node_count") > 0).alias("changed"), (~F.col("needs_review")).alias("invariants_ok")
    )


_SUMMARY = f"""
    SELECT variant_id, count(*) AS docs_total, count(*) FILTER (status IN ('ok', 'ok_partial', 'invariant_fallback')) AS docs_ok, count(*) FILTER (status = 'ok_partial') AS docs_partial,
      count(*) FILTER (status = 'invariant_fallback') AS docs_invariant_fallback, count(*) FILTER (status = 'error') AS docs_error, round(sum(seconds), 4)::DOUBLE AS wall_time_sec,
      round(avg(seconds), 4)::DOUBLE AS avg_doc_elapsed_sec, round(count(*) * 60 / sum(seconds), 4)::DOUBLE AS docs_per_min, round(sum(chars) / sum(seconds), 4)::DOUBLE AS chars_per_sec,
      round(avg(coalesce(changed, false)::INT), 4)::DOUBLE AS changed_rate, round(avg(coalesce(invariants_ok, false)::INT), 4)::DOUBLE AS invariants_ok_rate
    FROM {_DETAIL} GROUP BY variant_id"""


@query(_SUMMARY)
def variant_summary(spark: SparkSession, folder: str) -> DataFrame:
    return relational.variant_summary(_detail(spark, folder), "variant_id", "status", "seconds", "chars", ["changed", "invariants_ok"])


@query(f"SELECT variant_id, docs_total, docs_per_min FROM ({_SUMMARY}) ORDER BY docs_per_min DESC, variant_id LIMIT 1")
def best_variant(spark: SparkSession, folder: str) -> DataFrame:
    """The fastest variant; one row is the feature."""
    return relational.best_variant(variant_summary(spark, folder), "variant_id").select("variant_id", "docs_total", "docs_per_min")


@query(f"SELECT prompt_version, status, count(*) AS n, max(length(enriched_html)) AS longest FROM enriched_articles WHERE prompt_version = '{VERSION}' GROUP BY ALL")
def run_report(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "enriched_articles").where(F.col("prompt_version") == VERSION)
    return rows.groupBy("prompt_version", "status").agg(F.count("*").alias("n"), F.max(F.length("enriched_html")).cast("bigint").alias("longest"))


@query(
    "SELECT article_id, prompt_version, status, source_html_sha256 FROM (SELECT DISTINCT article_id, prompt_version, status, source_html_sha256 FROM enriched_articles WHERE prompt_version = 'kb-safe-v1') t "
    "WHERE article_id NOT IN (SELECT article_id FROM enriched_articles WHERE prompt_version = 'kb-safe-v2') "
    "UNION ALL SELECT DISTINCT article_id, 'kb-safe-v1', status, source_html_sha256 FROM enriched_articles WHERE prompt_version = 'kb-safe-v2'"
)
def upsert_state(spark: SparkSession, folder: str) -> DataFrame:
    """The table after the second version's results were merged into the first's."""
    rows = table(spark, folder, "enriched_articles").select("article_id", "prompt_version", "status", "source_html_sha256").distinct()
    source = rows.where("prompt_version = 'kb-safe-v2'").withColumn("prompt_version", F.lit("kb-safe-v1"))
    return sinks.merged(rows.where("prompt_version = 'kb-safe-v1'"), source, sinks.RESULT_KEY)


# ---- text ------------------------------------------------------------------------------------

_WS = f"trim(regexp_replace(coalesce(text, ''), '{_S}+', ' ', 'g'))"


@query(f"SELECT min(doc_id) AS doc_id, sha256({_WS}) AS digest FROM documents GROUP BY {_WS}")
def distinct_documents(spark: SparkSession, folder: str) -> DataFrame:
    """The first of documents that are equal but for white space."""
    docs = table(spark, folder, "documents").select("doc_id", X.sha256(X.normal_space(F.col("text"))).alias("digest"))
    return relational.first_of_equal(docs, [F.col("digest")], ["doc_id"]).select("doc_id", "digest")


@query(
    f"SELECT doc_id, (CASE WHEN text IS NULL THEN NULL ELSE len(list_filter(string_split(regexp_replace({_STRIP.format('text')}, '([.!?]){_S}+', '\1' || chr(1), 'g'), chr(1)), lambda x: x <> '')) END)::INT AS n_sentences, "
    f"(CASE WHEN text IS NULL THEN NULL ELSE len(list_filter(list_transform(string_split_regex(text, '\n+'), lambda x: {_STRIP.format('x')}), lambda x: x <> '')) END)::INT AS n_paragraphs, "
    "(floor(length(text) / 4) + 1)::BIGINT AS n_tokens FROM documents"
)
def text_units(spark: SparkSession, folder: str) -> DataFrame:
    """Sentences, paragraphs and estimated tokens of each document."""
    t = F.col("text")
    size = lambda c: F.when(t.isNotNull(), F.size(c))
    return table(spark, folder, "documents").select("doc_id", size(X.sentences(t)).alias("n_sentences"), size(X.paragraphs(t)).alias("n_paragraphs"), X.estimated_tokens(t).alias("n_tokens"))


@query(
    f"SELECT doc_id, CASE WHEN length({_WS}) <= 400 THEN {_WS} ELSE left({_WS}, 400) || ' ...' END AS head, trim(right({_WS}, 1200)) AS tail FROM documents"
)
def context_trims(spark: SparkSession, folder: str) -> DataFrame:
    one = X.normal_space(F.col("text"))
    return table(spark, folder, "documents").select("doc_id", X.head(one, 400, " ...").alias("head"), X.trimmed_context(F.col("text")).alias("tail"))


@query(
    "SELECT article_id, prompt_version, sha256(original_html) = source_html_sha256 AS source_same, sha256(enriched_html) = enriched_html_sha256 AS enriched_same FROM enriched_articles"
)
def stored_digests(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "enriched_articles").select(
        "article_id", "prompt_version", (X.sha256(F.col("original_html")) == F.col("source_html_sha256")).alias("source_same"), (X.sha256(F.col("enriched_html")) == F.col("enriched_html_sha256")).alias("enriched_same")
    )


@query("SELECT article_id, seg_id, trim(regexp_replace(regexp_replace(coalesce(original_text, ''), '⟦/?\\d+⟧', '', 'g'), '" + _S + "+', ' ', 'g')) AS plain FROM " + _SEGMENTS)
def plain_segments(spark: SparkSession, folder: str) -> DataFrame:
    return segments(spark, folder).select("article_id", "seg_id", X.without_tokens(F.coalesce("original_text", F.lit(""))).alias("plain"))


_LETTER = r"[\pL\pM\p{Nd}\p{Nl}\p{Pc}\x{200C}\x{200D}]"


@query(
    rf"""
    WITH s AS (SELECT tag, unnest(list_filter(string_split(regexp_replace(trim(regexp_replace(regexp_replace(coalesce(rewritten_text, ''), '{P.INLINE_TOKEN}', '', 'g'), '{_S}+', ' ', 'g')), '([.!?]) ', '\1' || chr(1), 'g'), chr(1)), lambda x: x <> '')) AS s FROM {_BLOCKS}),
         i AS (SELECT tag, unnest([CASE WHEN len(regexp_extract_all(s, '{_LETTER}+(?:[''’-]{_LETTER}+)*')) > 20 THEN 'sentence_too_long' END,
                                   CASE WHEN regexp_matches(s, '(?i)\b(wordt|worden|werd|werden|is|zijn)\b.*\b\w+(d|t)\b') AND regexp_matches(s, '(?i)\bdoor\b') THEN 'possible_passive' END]) AS issue FROM s)
    SELECT tag, issue, count(*) AS n FROM i WHERE issue IS NOT NULL GROUP BY ALL
    """
)
def style_issues(spark: SparkSession, folder: str) -> DataFrame:
    issues = X.style_issues(F.coalesce("rewritten_text", F.lit("")))
    return relational.histogram(blocks(spark, folder).select("tag", F.explode(F.transform(issues, lambda i: F.substring_index(i, ":", 1))).alias("issue")), "tag", "issue")


@query()
def rewrite_pieces(spark: SparkSession, folder: str) -> DataFrame:
    """Documents in pieces for rewriting."""
    return markup.text_pieces(table(spark, folder, "documents"), ["doc_id"], "text")


@query()
def paragraph_chunks(spark: SparkSession, folder: str) -> DataFrame:
    return markup.paragraph_chunks(table(spark, folder, "documents"), ["doc_id"], "text", 1500).select("doc_id", "chunk", "first", "last")


@query("SELECT range AS doc_id, 3000 AS n FROM range(2000)")
def synthetic_documents(spark: SparkSession, folder: str) -> DataFrame:
    """Documents of an exact length."""
    return sources.synthetic_documents(spark, 2000, 3000).select("doc_id", F.length("html").alias("n"))


@query("SELECT doc_id, len(string_split(text, chr(10)))::BIGINT AS n, true AS same FROM documents WHERE text <> ''")
def section_round_trip(spark: SparkSession, folder: str) -> DataFrame:
    """Paragraphs of the marked sections of a document, read back: as many as its lines, and the same."""
    docs = table(spark, folder, "documents").where("text <> ''").select("doc_id", "text")
    read = markup.sections(docs, ["doc_id"], "text").select("doc_id", F.explode(X.marked_paragraphs(F.col("section_text"))).alias("p"))
    own = docs.select("doc_id", F.posexplode(F.split("text", "\n")).alias("index", "line"))
    joined = own.join(read.select("doc_id", "p.index", "p.text").distinct(), ["doc_id", "index"], "left")
    same = F.coalesce(F.col("text") == X.stripped(F.col("line")), F.lit(False))
    return joined.groupBy("doc_id").agg(F.count("*").alias("n"), F.bool_and(same).alias("same"))


@query(
    f"""
    WITH c AS (SELECT article_id, v AS key, count(*)::INT AS n FROM (SELECT article_id, unnest({_found('original_text', P.INVARIANTS[0])}) AS v FROM {_BLOCKS}) GROUP BY ALL),
         r AS (SELECT *, row_number() OVER (PARTITION BY article_id ORDER BY key) AS rn, count(*) OVER (PARTITION BY article_id) AS total FROM c)
    SELECT article_id, key, n AS value FROM r WHERE rn <= 50 UNION ALL SELECT DISTINCT article_id, '__truncated__', (total - 50)::INT FROM r WHERE total > 50
    """
)
def capped_counts(spark: SparkSession, folder: str) -> DataFrame:
    """Counts of an article's numbers, at most fifty and how many were left out; the cap is the feature."""
    counts = relational.value_counts(blocks(spark, folder), ["article_id"], "original_text", P.INVARIANTS[:1])
    maps = counts.groupBy("article_id").agg(F.map_from_entries(F.collect_list(F.struct("value", F.col("n").cast("int")))).alias("m"))
    return maps.select("article_id", F.explode(X.capped_map(F.col("m"))).alias("key", "value"))


# ---- order -----------------------------------------------------------------------------------


@query(
    f"SELECT article_id, block_id, coalesce(lag(original_text) OVER w, '') AS previous_text, coalesce(lead(original_text) OVER w, '') AS next_text FROM {_BLOCKS} WINDOW w AS (PARTITION BY article_id ORDER BY block_id)"
)
def block_neighbours(spark: SparkSession, folder: str) -> DataFrame:
    near = sequence.neighbours(blocks(spark, folder).select(*BLOCK_KEY, "original_text"), ["article_id"], ["block_id"], "original_text")
    at = lambda c: F.coalesce(F.try_element_at(c, F.lit(1)), F.lit(""))
    return near.select(*BLOCK_KEY, at("previous").alias("previous_text"), at("next").alias("next_text"))


_PLAIN = f"trim(regexp_replace(coalesce(original_text, ''), '{_S}+', ' ', 'g'))"


@query(
    f"""
    WITH s AS (SELECT article_id, seg_id, {_PLAIN} AS t FROM {_SEGMENTS}),
         n AS (SELECT article_id, seg_id, lag(t, 2) OVER w AS b2, lag(t) OVER w AS b1, lead(t) OVER w AS a1 FROM s WINDOW w AS (PARTITION BY article_id ORDER BY seg_id))
    SELECT article_id, seg_id, trim(right(concat_ws(' ', nullif(b2, ''), nullif(b1, '')), 1200)) AS previous_context, trim(right(coalesce(a1, ''), 1200)) AS next_context FROM n
    """
)
def segment_contexts(spark: SparkSession, folder: str) -> DataFrame:
    """Two segments before and one behind as context."""
    rows = segments(spark, folder).select("article_id", "seg_id", "original_text")
    return sequence.local_context(rows, ["article_id"], ["seg_id"], "original_text").select("article_id", "seg_id", "previous_context", "next_context")


@query(
    f"SELECT article_id, block_id, last_value(CASE WHEN tag = 'p' THEN original_text END IGNORE NULLS) OVER (PARTITION BY article_id ORDER BY block_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS carried FROM {_BLOCKS}"
)
def carried_text(spark: SparkSession, folder: str) -> DataFrame:
    """The last paragraph before each block, as a heading is carried forward."""
    rows = blocks(spark, folder).select(*BLOCK_KEY, "tag", "original_text")
    done = sequence.carried(rows, ["article_id"], ["block_id"], F.when(F.col("tag") == "p", F.col("original_text")), "carried")
    return done.select(*BLOCK_KEY, "carried")


@query("SELECT ((rn - 1) // 200)::INT AS batch, count(*) AS n, min(doc_id) AS first_id, max(doc_id) AS last_id FROM (SELECT doc_id, row_number() OVER (ORDER BY doc_id) AS rn FROM documents) GROUP BY 1")
def fixed_batches(spark: SparkSession, folder: str) -> DataFrame:
    done = sequence.batches(table(spark, folder, "documents").select("doc_id"), ["doc_id"], 200)
    return done.groupBy("batch").agg(F.count("*").alias("n"), F.min("doc_id").alias("first_id"), F.max("doc_id").alias("last_id"))


@query(
    f"""
    WITH RECURSIVE b AS (SELECT article_id, block_id, coalesce(length(original_text), 0) AS n, row_number() OVER (PARTITION BY article_id ORDER BY block_id) AS rn FROM {_BLOCKS}),
         f AS (SELECT article_id, block_id, rn, n AS filled, 0 AS chunk FROM b WHERE rn = 1
               UNION ALL
               SELECT b.article_id, b.block_id, b.rn, CASE WHEN f.filled + b.n > 2000 THEN b.n ELSE f.filled + b.n END, CASE WHEN f.filled + b.n > 2000 THEN f.chunk + 1 ELSE f.chunk END
               FROM f JOIN b ON b.article_id = f.article_id AND b.rn = f.rn + 1)
    SELECT article_id, block_id, chunk::INT AS chunk FROM f
    """
)
def packed_blocks(spark: SparkSession, folder: str) -> DataFrame:
    """Blocks of an article packed greedily to 2,000 characters."""
    rows = blocks(spark, folder).select(*BLOCK_KEY, "original_text")
    return sequence.packed(rows, ["article_id"], ["block_id"], F.length("original_text"), 2000).select(*BLOCK_KEY, "chunk")


_N = lambda c: f"trim(regexp_replace(coalesce({c}, ''), '{_S}+', ' ', 'g'))"


@query(
    f"""
    WITH b AS (SELECT article_id, block_id, {_N('rewritten_text')} AS c, coalesce(lag({_N('rewritten_text')}) OVER (PARTITION BY article_id ORDER BY block_id), '') AS p FROM {_BLOCKS})
    SELECT article_id, block_id, p <> '' AND c <> '' AND (length(c) <= 120 OR regexp_matches(left(lower(c), 120), {_q(P.CONNECTIVE_START)}) OR string_split(lower(c), ' ')[1] IN ('this', 'these', 'it', 'they', 'such')
      OR contains(lower(p), array_to_string(string_split(lower(c), ' ')[1:4], ' '))) AS polish FROM b
    """
)
def needs_polish(spark: SparkSession, folder: str) -> DataFrame:
    """Blocks whose way from the one before may need work."""
    near = sequence.neighbours(blocks(spark, folder).select(*BLOCK_KEY, "rewritten_text"), ["article_id"], ["block_id"], "rewritten_text", 1, 0)
    previous = F.coalesce(F.try_element_at("previous", F.lit(1)), F.lit(""))
    return near.select(*BLOCK_KEY, predicates.needs_polish(previous, F.col("rewritten_text")).alias("polish"))


@query(
    f"SELECT article_id, block_id, length(original_text) AS n FROM (SELECT *, row_number() OVER (PARTITION BY article_id ORDER BY length(original_text) DESC NULLS LAST, block_id) AS r FROM {_BLOCKS}) WHERE r <= 3"
)
def longest_blocks(spark: SparkSession, folder: str) -> DataFrame:
    """The three longest blocks of each article; the limit is the feature."""
    rows = of_blocks(spark, folder, F.length("original_text").cast("bigint").alias("n"))
    return relational.top_per_group(rows, ["article_id"], [F.col("n").desc_nulls_last(), F.col("block_id")], 3)


@query("SELECT event_id, user_id, event_type, value, (row_number() OVER (ORDER BY ts DESC, event_id) - 1)::BIGINT AS position FROM events")
def history_newest_first(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "events").select("event_id", "ts", "user_id", "event_type", "value")
    return history.with_recency(rows, "ts", "event_id").select("event_id", "user_id", "event_type", "value", "position")


@query(
    "WITH RECURSIVE f AS (SELECT 1 AS position, 0::HUGEINT AS a, 1::HUGEINT AS b UNION ALL SELECT position + 1, b, a + b FROM f WHERE position < 180) SELECT position, CAST(a AS VARCHAR) AS value FROM f"
)
def fibonacci_positions(spark: SparkSession, folder: str) -> DataFrame:
    return history.fibonacci_table(spark, 180)


_POS = "(SELECT event_id, CASE event_id % 5 WHEN 0 THEN json_extract_string(props, '$.k') WHEN 1 THEN event_type WHEN 2 THEN '-' || json_extract_string(props, '$.k') WHEN 3 THEN CAST(value AS VARCHAR) || '.5x' ELSE ' ' END AS asked FROM events)"


@query(
    "SELECT event_id, CASE WHEN trim(coalesce(asked, '')) = '' THEN 'A number is needed.' WHEN NOT regexp_matches(asked, '^\\s*[+-]?\\d+\\s*$') THEN 'The position must be a whole number.' "
    f"WHEN CAST(asked AS HUGEINT) < 1 THEN 'The position must be 1 or more.' END AS message FROM {_POS}"
)
def position_messages(spark: SparkSession, folder: str) -> DataFrame:
    """What is wrong with positions that were asked for."""
    k = F.get_json_object("props", "$.k")
    kind = F.col("event_id") % 5
    asked = F.when(kind == 0, k).when(kind == 1, F.col("event_type")).when(kind == 2, F.concat(F.lit("-"), k)).when(kind == 3, F.concat(F.col("value").cast("string"), F.lit(".5x"))).otherwise(" ")
    return table(spark, folder, "events").select("event_id", history.message(asked).alias("message"))


# ---- samples ---------------------------------------------------------------------------------


def _mixed(key: str) -> str:
    """SQL of relational.mixed with its usual seed."""
    return f"('0x' || left(md5('42|' || {key}), 8))::BIGINT"


@query(f"SELECT doc_id, lang FROM documents WHERE {_mixed('doc_id')} < {int(0.1 * (1 << 32))}")
def hash_sample(spark: SparkSession, folder: str) -> DataFrame:
    """A tenth of the documents, the same ones on any cluster; sampling is the feature."""
    return relational.hash_sample(table(spark, folder, "documents").select("doc_id", "lang"), "doc_id", 0.1)


@query(f"SELECT doc_id FROM documents ORDER BY {_mixed('doc_id')} >= {int(0.001 * (1 << 32))}, doc_id LIMIT 30")
def topped_up_sample(spark: SparkSession, folder: str) -> DataFrame:
    """Thirty documents: sampled ones, topped up where the sample is short; thirty is the feature."""
    docs = table(spark, folder, "documents").select("doc_id")
    return relational.topped_up(relational.hash_sample(docs, "doc_id", 0.001), docs, "doc_id", 30)


@query(f"SELECT doc_id, {_mixed('doc_id')} < {int(0.01 * (1 << 32))} AS sampled FROM documents ORDER BY {_mixed('doc_id')}, doc_id LIMIT 25")
def sample_in_hash_order(spark: SparkSession, folder: str) -> DataFrame:
    """Twenty-five documents in hash order; the number is the feature."""
    docs = table(spark, folder, "documents").select("doc_id")
    got = relational.sample_of(docs, "doc_id", 25, 0.01)
    return got.withColumn("sampled", relational.mixed(F.col("doc_id"), 42) < int(0.01 * (1 << 32)))


# ---- HTML ------------------------------------------------------------------------------------


@query(f"SELECT article_id, true AS parsed, true AS tokens, true AS segments FROM {_ARTICLES} WHERE html IS NOT NULL")
def html_round_trips(spark: SparkSession, folder: str) -> DataFrame:
    """Whether the tree, the global tokens and the segments of a document each give it again."""
    return markup.round_trips(articles(spark, folder).where(F.col("html").isNotNull()), "article_id", "html")


@query()
def html_text_nodes(spark: SparkSession, folder: str) -> DataFrame:
    """Text nodes with their route."""
    nodes = markup.routed(markup.text_nodes(articles(spark, folder), ["article_id"], "html"))
    return nodes.select("article_id", "seg_id", "parent_tag", "approved_tag", "route", F.length("text").alias("n"))


@query()
def html_blocks(spark: SparkSession, folder: str) -> DataFrame:
    rows = markup.blocks(articles(spark, folder), ["article_id"], "html")
    return rows.select("article_id", "block_id", "tag", "heading", "freeze_reason", F.length("text").alias("n"))


@query()
def html_visible_text(spark: SparkSession, folder: str) -> DataFrame:
    rows = markup.with_bold_texts(markup.with_visible_text(articles(spark, folder), "html"), "html")
    return rows.select("article_id", markup.scope_mode("html").alias("scope_mode"), F.length("visible_text").alias("n"), F.size("bold_texts").alias("n_bold"))


@query()
def html_token_segments(spark: SparkSession, folder: str) -> DataFrame:
    rows = markup.token_segments(articles(spark, folder), ["article_id"], "html")
    return rows.select("article_id", "seg_id", "parent_tag", "text", F.size("tags").alias("n_tags"))


@query()
def html_markers(spark: SparkSession, folder: str) -> DataFrame:
    """Leaf blocks as marker text, and whether they are built from it again."""
    rows = markup.with_markers(markup.leaf_blocks(articles(spark, folder), ["article_id"], "html"))
    return rows.select("article_id", "block_id", "tag", F.size("markers").alias("n_markers"), (F.col("rebuilt_html") == F.col("block_html")).alias("same"))


@query()
def html_pieces(spark: SparkSession, folder: str) -> DataFrame:
    """Self-contained pieces of at most 500 estimated tokens."""
    rows = markup.pieces(articles(spark, folder), ["article_id"], "html", 500)
    return rows.select("article_id", "piece", F.length("piece_html").alias("n"), "error")


@query(f"SELECT article_id, true AS same, true AS within FROM {_ARTICLES} WHERE html <> ''")
def html_token_chunks(spark: SparkSession, folder: str) -> DataFrame:
    """Chunks of the tokenised source: together they are it, and none is above 500 characters."""
    rows = markup.with_global_tokens(articles(spark, folder).where("html <> ''").select("article_id", "html"), "html")
    parts = markup.with_token_chunks(rows, ["article_id", "token_text"], "token_text", 500)
    joined = parts.groupBy("article_id", "token_text").agg(F.array_sort(F.collect_list(F.struct("chunk", "chunk_text"))).alias("c"), F.max(F.length("chunk_text")).alias("n"))
    whole = F.array_join(F.transform("c", lambda x: x["chunk_text"]), "")
    return joined.select("article_id", (whole == F.col("token_text")).alias("same"), (F.col("n") <= 500).alias("within"))


@query()
def html_diffs(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "enriched_articles").select("article_id", "prompt_version", "original_html", "enriched_html")
    return markup.with_diff(rows, "original_html", "enriched_html").select("article_id", "prompt_version", F.length("html_diff").alias("n"))


@query()
def html_structures(spark: SparkSession, folder: str) -> DataFrame:
    """Whether the rewrite kept the structure and the protected elements of a document."""
    rows = table(spark, folder, "enriched_articles").where(F.col("enriched_html").isNotNull()).select("article_id", "prompt_version", "original_html", "enriched_html")
    a = markup.with_structure(rows, "original_html").withColumnsRenamed({"structure": "s1", "protected_structure": "p1"})
    b = markup.with_structure(a, "enriched_html")
    return b.select("article_id", "prompt_version", (F.col("s1") == F.col("structure")).alias("same_structure"), (F.col("p1") == F.col("protected_structure")).alias("same_protected"))


# ---- rewriting and claims --------------------------------------------------------------------


@query()
def two_pass_blocks(spark: SparkSession, folder: str) -> DataFrame:
    """Blocks of the articles through both passes with the offline rewriter."""
    found = markup.blocks(articles(spark, folder), ["article_id"], "html").select("article_id", "block_id", "tag", "text", "freeze_reason")
    one = rewriting.pass_one(found, rewriting.RuleRewriter())
    two = rewriting.pass_two(one, rewriting.RuleRewriter(), ["article_id"], ["block_id"])
    return two.select("article_id", "block_id", "tag", "status", "pass1_error", "pass2_error", "transition_polished", "invariants_ok_pass1")


@query()
def rewritten_nodes(spark: SparkSession, folder: str) -> DataFrame:
    """Node texts through freeze, rewrite, restore and checks."""
    nodes = table(spark, folder, "node_results").dropDuplicates(["article_id", "node_id"]).select("article_id", "node_id", F.col("original_text").alias("text"))
    done = rewriting.rewritten_nodes(nodes.where(F.col("text").isNotNull()), rewriting.RuleRewriter())
    return done.select("article_id", "node_id", "changed", "needs_review", F.array_join("review_reasons", "; ").alias("review_reasons"))


@query()
def two_stage_segments(spark: SparkSession, folder: str) -> DataFrame:
    """Segments of the articles rewritten as plain text and then with their tokens."""
    segs = markup.token_segments(articles(spark, folder), ["article_id"], "html")
    done = rewriting.two_stage(segs, rewriting.RuleRewriter(), rewriting.RuleRewriter())
    return done.select("article_id", "seg_id", F.size("issues").alias("n_issues"), (F.col("revised_text") != F.col("text")).alias("changed"))


@query()
def harmonised_documents(spark: SparkSession, folder: str) -> DataFrame:
    """Documents rewritten in pieces that are joined level by level."""
    parts = markup.text_pieces(table(spark, folder, "documents"), ["doc_id"], "text", 600, 800)
    done = rewriting.harmonised(parts, rewriting.RuleRewriter(), "doc_id", "piece", "piece_text", 2000)
    return done.select("doc_id", F.length("piece_text").alias("n"))


@query()
def experiment_summary(spark: SparkSession, folder: str) -> DataFrame:
    """Two rewriters over the same articles; the one that breaks facts falls back."""
    docs = articles(spark, folder).where(F.col("html").isNotNull())
    faulty = rewriting.FaultyRewriter(rewriting.RuleRewriter(), "number")
    detail = enrich.experiment(spark, docs, {"A_rules": rewriting.RuleRewriter(), "B_faulty": faulty})
    return relational.variant_summary(detail, "variant_id", "status", "elapsed_sec", "input_chars", ["changed", "invariants_ok"])


def _claims(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    rows = blocks(spark, folder).where(F.col("status").startswith("rewritten")).withColumn("doc", F.concat_ws("|", "article_id", "block_id"))
    return tuple(claims.from_sentences(rows, "doc", c, F.col("tag")) for c in ("original_text", "rewritten_text"))


_PARTS = f"list_filter(string_split(regexp_replace({_STRIP}, '([.!?]){_S.replace('{', '{{').replace('}', '}}')}+', '\\1' || chr(1), 'g'), chr(1)), lambda x: x <> '')"
_SPLIT = f"unnest({_PARTS}) AS s, generate_subscripts({_PARTS}, 1) - 1 AS ord"
_LOW = lambda c: f"lower(trim(regexp_replace({c}, '{_S}+', ' ', 'g')))"
_CLAIM = (
    "SELECT doc, ord, s, coalesce(lower(nullif(regexp_extract(s, '(?i)\\b(must|should|may|can|cannot|will)\\b'), '')), '') AS modality, "
    "regexp_matches(s, '(?i)\\b(not|cannot|never|no longer)\\b') AS negated, {c} AS condition, {t} AS timing, regexp_matches(s, '(?i)\\b(approv|review)\\w*') AS approval, "
    "regexp_extract(s, '\\d[\\d,]*(?:\\.\\d+)?') AS value, regexp_matches(s, '(?i)\\bonly\\b') AS exclusive FROM (SELECT doc, {split} FROM d) WHERE regexp_matches(s, '[\\pL\\pN]')"
).replace("{c}", _LOW("regexp_extract(s, '(?i)\\b(?:if|unless|when|once)\\b[^,.]*')")).replace("{t}", _LOW("regexp_extract(s, '(?i)\\b(?:within|after|in) \\d+ \\w+')"))


@query(
    f"""
    WITH d AS (SELECT article_id || '|' || block_id AS doc, original_text, rewritten_text FROM {_BLOCKS} WHERE status LIKE 'rewritten%'),
         a AS ({_CLAIM.replace('{split}', _SPLIT.format('original_text'))}),
         b AS ({_CLAIM.replace('{split}', _SPLIT.format('rewritten_text'))}),
         j AS (SELECT a.doc, a.ord, a.s AS s1, b.s AS s2, a.modality <> b.modality AS m, a.negated <> b.negated AS n, a.approval <> b.approval AS ap, a.condition <> b.condition AS c, a.timing <> b.timing AS t,
                      a.exclusive <> b.exclusive AS e, a.value <> b.value AS v,
                      CASE a.modality WHEN 'may' THEN 2 WHEN 'should' THEN 3 WHEN 'must' THEN 5 ELSE 0 END AS r1, CASE b.modality WHEN 'may' THEN 2 WHEN 'should' THEN 3 WHEN 'must' THEN 5 ELSE 0 END AS r2
               FROM a JOIN b USING (doc, ord))
    SELECT doc, ord::INT AS ord, CASE WHEN NOT (m OR n OR ap OR c OR t OR e OR v) THEN CASE WHEN {_LOW('s1')} = {_LOW('s2')} THEN 'preserved' ELSE 'preserved_but_rephrased' END
      WHEN n THEN 'contradicted' WHEN ap OR e THEN 'weakened' WHEN m AND r2 < r1 THEN 'weakened' WHEN m AND r2 > r1 THEN 'strengthened' ELSE 'uncertain' END AS result FROM j
    """
)
def claim_verdicts(spark: SparkSession, folder: str) -> DataFrame:
    """Verdicts on the claims of a block's sentences against those of its rewrite in the same place."""
    a, b = _claims(spark, folder)
    pair = lambda df, n: df.select("doc", "ord", F.struct(*df.columns).alias(n))
    return pair(a, "a").join(pair(b, "b"), ["doc", "ord"]).select("doc", "ord", claims.verdict("a", "b").alias("result"))


@query()
def claim_matches(spark: SparkSession, folder: str) -> DataFrame:
    """The best rewritten claim of each claim of a block, and the verdict."""
    a, b = (cut(c) for c in _claims(spark, folder))
    results, _ = claims.compared(claims.deduplicated(a, "doc"), claims.deduplicated(b, "doc"), "doc")
    return results.select("doc", "claim_id", "matched_claim_id", F.round("score", 6).alias("score"), "result")


@query()
def document_decisions(spark: SparkSession, folder: str) -> DataFrame:
    """Decision on each rewritten block: numbers, terms, claims."""
    rows = blocks(spark, folder).where(F.col("status").startswith("rewritten")).withColumn("doc", F.concat_ws("|", "article_id", "block_id"))
    a, b = (cut(c) for c in _claims(spark, folder))
    pairs = rows.select("doc", "original_text", "rewritten_text")
    return evaluate.evaluated(pairs, "doc", "original_text", "rewritten_text", TERMS, a, b)
