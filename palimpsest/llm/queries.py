"""Queries over the test tables, one or more for each problem."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from palimpsest.llm import encoding, langid, languages, leakage, lookalike, markup, pairs, readability, splitting, truncation
from palimpsest.session import table


def _key(*parts: str):
    return F.concat_ws("|", *(F.col(p).cast("string") for p in parts))


def texts_with_labels(spark: SparkSession, folder: str) -> DataFrame:
    """original_text and lang of block_audit and segments, with the item's table and id."""
    blocks = table(spark, folder, "block_audit").select(
        F.lit("block_audit").alias("item_table"), _key("article_id", "block_id").alias("item_id"), F.col("original_text").alias("text"), "lang"
    )
    segments = table(spark, folder, "segments").select(
        F.lit("segments").alias("item_table"), _key("article_id", "seg_id").alias("item_id"), F.col("original_text").alias("text"), "lang"
    )
    return blocks.unionByName(segments)


_models: dict[tuple[str, str], langid.Model] = {}


def language_model(spark: SparkSession, folder: str) -> langid.Model:
    """The model of a folder's labelled blocks, fitted once in a session; it has a fixed size."""
    key = (spark.sparkContext.applicationId, folder)
    if key not in _models:
        labelled = table(spark, folder, "block_audit").select(F.col("original_text").alias("text"), "lang")
        _models[key] = langid.fit(labelled)
    return _models[key]


def p5_found(spark: SparkSession, folder: str) -> DataFrame:
    return languages.wrong_labels(texts_with_labels(spark, folder), language_model(spark, folder), "text", "lang", ["item_table", "item_id"])


def p5_languages(spark: SparkSession, folder: str) -> DataFrame:
    every = texts_with_labels(spark, folder)
    return languages.languages(every, language_model(spark, folder), "text", "lang", ["item_table", "item_id"])


def rewritten_values(spark: SparkSession, folder: str) -> DataFrame:
    """rewritten_text of block_audit and node_results with its counterpart, source, item table and id."""
    kept = ["original_text", "rewritten_text", "source_system"]
    blocks = table(spark, folder, "block_audit").select(
        F.lit("block_audit").alias("item_table"), _key("article_id", "block_id").alias("item_id"), *kept
    )
    nodes = table(spark, folder, "node_results").select(
        F.lit("node_results").alias("item_table"), _key("article_id", "node_id").alias("item_id"), *kept
    )
    return blocks.unionByName(nodes)


def p6_found(spark: SparkSession, folder: str) -> DataFrame:
    values = rewritten_values(spark, folder)
    copies = [(values, ["original_text", "rewritten_text"])]
    return truncation.cut_values(values, copies, ["item_table", "item_id"], "rewritten_text", "original_text")


def p6_source_share(spark: SparkSession, folder: str) -> DataFrame:
    values = rewritten_values(spark, folder)
    return truncation.shares(values, p6_found(spark, folder), ["item_table", "item_id"], "rewritten_text", "source_system")


REWRITTEN = ("rewritten_pass1", "rewritten_pass1_pass2")


def rewritten_pairs(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "block_audit").where(F.col("status").isin(*REWRITTEN))


def p1_found(spark: SparkSession, folder: str) -> DataFrame:
    every = rewritten_pairs(spark, folder).select("article_id", "block_id", "original_text", "rewritten_text")
    return pairs.defects(every, language_model(spark, folder), ["article_id", "block_id"], "original_text", "rewritten_text")


def p1_defect_counts(spark: SparkSession, folder: str) -> DataFrame:
    return p1_found(spark, folder).groupBy("defect").agg(F.count("*").alias("pairs"), F.countDistinct("article_id").alias("articles"))


def p9_found(spark: SparkSession, folder: str) -> DataFrame:
    return lookalike.lookalike_pairs(table(spark, folder, "documents").select("doc_id", "text"), "doc_id", "text")


def p9_forms(spark: SparkSession, folder: str) -> DataFrame:
    forms = lookalike.with_form(table(spark, folder, "documents"), "text", ["doc_id"])
    return forms.select("doc_id", F.length("form").alias("n_chars"), F.sha2("form", 256).alias("form_sha256"))


def leaked(spark: SparkSession, folder: str) -> DataFrame:
    documents = table(spark, folder, "documents").select("doc_id", "text")
    return leakage.leaks(documents, table(spark, folder, "eval_items"), "doc_id", "item_id")


def p8_found(spark: SparkSession, folder: str) -> DataFrame:
    return leaked(spark, folder).select("doc_id", "item_id")


def p8_item_report(spark: SparkSession, folder: str) -> DataFrame:
    """For each leaked item the documents that hold it and the most words in a row."""
    return leaked(spark, folder).groupBy("item_id").agg(F.count("*").alias("documents"), F.max("words").alias("most_words"))


def p7_ids(spark: SparkSession, folder: str) -> DataFrame:
    return encoding.token_ids(table(spark, folder, "documents"), "doc_id", "text")


RESULT_KEY = ["article_id", "prompt_version"]
HTML_FIELDS = ["original_html", "enriched_html"]


def p3_found(spark: SparkSession, folder: str) -> DataFrame:
    return markup.residues(table(spark, folder, "enriched_articles"), HTML_FIELDS, RESULT_KEY)


def p3_clean(spark: SparkSession, folder: str) -> DataFrame:
    """Clean text of both fields, one row for each field of a row, with its kinds of residue."""
    results = table(spark, folder, "enriched_articles").select(*RESULT_KEY, *HTML_FIELDS)
    each = [
        markup.with_clean_text(results.select(*RESULT_KEY, F.col(f).alias("html"), F.lit(f).alias("field")), "html", ["field", *RESULT_KEY])
        for f in HTML_FIELDS
    ]
    return each[0].unionByName(each[1])


HTML_LIMIT, TEXT_LIMIT, OVERLAP = 12_000, 3_500, 200


def p4_pieces(spark: SparkSession, folder: str) -> DataFrame:
    """Pieces of all values above their limits."""
    results = table(spark, folder, "enriched_articles").select(
        F.lit("enriched_articles").alias("item_table"), _key(*RESULT_KEY).alias("item_id"), "original_html"
    )
    blocks = table(spark, folder, "block_audit").select(
        F.lit("block_audit").alias("item_table"), _key("article_id", "block_id").alias("item_id"), "original_text"
    )
    keys = ["item_table", "item_id"]
    return splitting.split_items(results, "original_html", keys, HTML_LIMIT, OVERLAP, html=True).unionByName(
        splitting.split_items(blocks, "original_text", keys, TEXT_LIMIT, OVERLAP)
    )


def p4_found(spark: SparkSession, folder: str) -> DataFrame:
    """Items that were cut into more than one piece."""
    return p4_pieces(spark, folder).where("piece = 1").select("item_table", "item_id").distinct()


def article_sides(spark: SparkSession, folder: str) -> DataFrame:
    """article_id, side, block_id and text of the blocks; the side rewritten has rewritten pairs only."""
    each = table(spark, folder, "block_audit")
    sides = F.array(
        F.struct(F.lit("original").alias("side"), F.col("original_text").alias("text")),
        F.struct(F.lit("rewritten").alias("side"), F.when(F.col("status").isin(*REWRITTEN), F.col("rewritten_text")).alias("text")),
    )
    return each.select("article_id", "block_id", F.explode(sides).alias("s")).select("article_id", "s.side", "block_id", "s.text")


def p2_levels(spark: SparkSession, folder: str) -> DataFrame:
    return readability.levels(
        article_sides(spark, folder), table(spark, folder, "level_labels"), language_model(spark, folder),
        ["article_id", "side"], ["block_id"], "text", "reading_level", ["article_id"],
    )


def p2_found(spark: SparkSession, folder: str) -> DataFrame:
    return p2_levels(spark, folder).where("reading_level = 'advanced'").select("article_id", "side")


def queries() -> dict:
    return {"p2_found": p2_found, "p2_levels": p2_levels, "p3_found": p3_found, "p3_clean": p3_clean, "p4_found": p4_found, "p4_pieces": p4_pieces, "p7_ids": p7_ids, "p8_found": p8_found, "p8_item_report": p8_item_report, "p9_found": p9_found, "p9_forms": p9_forms, "p1_found": p1_found, "p1_defect_counts": p1_defect_counts, "p6_found": p6_found, "p6_source_share": p6_source_share, "p5_found": p5_found, "p5_languages": p5_languages}


def oracle_sql() -> dict[str, str]:
    return {
        "p4_found": f"""
            SELECT DISTINCT 'enriched_articles' AS item_table, article_id || '|' || prompt_version AS item_id
            FROM enriched_articles WHERE length(original_html) > {HTML_LIMIT}
            UNION
            SELECT DISTINCT 'block_audit', article_id || '|' || block_id FROM block_audit WHERE length(original_text) > {TEXT_LIMIT}
        """,
    }
