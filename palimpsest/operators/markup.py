"""HTML operators over columns: text nodes, blocks, tokens, markers, pieces, and documents put together again."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from palimpsest.functions import chunking, pyfn
from palimpsest.functions import html as H
from palimpsest.functions import patterns as P
from palimpsest.functions import tokens as K
from palimpsest.operators import predicates

NODE = "seg_id int, text string, parent_tag string, path array<string>, approved_tag string, approved_block_id int"
TAG = "struct<token:string,start:string,stop:string>"


def text_nodes(df: DataFrame, key: Sequence[str], html: str) -> DataFrame:
    """A row for each text node that isn't blank, with its path and the flags that routing needs."""
    nodes = pyfn.exploded(df, key, [html], NODE, K.text_nodes)
    path = F.col("path")
    return nodes.withColumns(
        {
            "is_non_editable": predicates.under(path, P.NON_EDITABLE),
            "is_protected": predicates.under(path, P.BOLD),
            "is_high_risk_block": predicates.under(path, P.HIGH_RISK),
            "is_high_risk_content": predicates.high_risk(F.col("text")),
        }
    )


def routed(nodes: DataFrame) -> DataFrame:
    risky = F.col("is_high_risk_block") | F.col("is_high_risk_content")
    return nodes.withColumn("route", predicates.route(F.col("is_non_editable"), F.col("approved_tag"), F.col("is_protected"), risky))


def editable_nodes(df: DataFrame, key: Sequence[str], html: str) -> DataFrame:
    nodes = pyfn.exploded(df, key, [html], NODE, K.text_nodes)
    return nodes.where(predicates.editable_node(F.col("text"), F.col("path")))


def blocks(df: DataFrame, key: Sequence[str], html: str) -> DataFrame:
    """A row for each p and li with text: block_id, tag, heading, text and why it would stay as it is."""
    out = "block_id int, tag string, heading string, text string, path array<string>, has_inline boolean"
    found = pyfn.exploded(df, key, [html], out, K.text_blocks)
    return found.withColumn("freeze_reason", predicates.freeze_reason(F.col("text"), F.col("path"), F.col("has_inline")))


def scope_mode(html: str):
    """body where the source names one, fragment otherwise."""
    return F.when(F.col(html).rlike(r"(?i)<body\b"), "body").otherwise("fragment")


def with_visible_text(df: DataFrame, html: str, out: str = "visible_text", lines: bool = False) -> DataFrame:
    return pyfn.with_columns(df, [html], f"{out} string", lambda h: (K.visible_text(h, "\n" if lines else " "),))


def with_bold_texts(df: DataFrame, html: str, out: str = "bold_texts") -> DataFrame:
    return pyfn.with_columns(df, [html], f"{out} array<string>", lambda h: (K.bold_texts(h),))


def leaf_blocks(df: DataFrame, key: Sequence[str], html: str) -> DataFrame:
    return pyfn.exploded(df, key, [html], "block_id int, tag string, block_html string", K.leaf_blocks)


def token_segments(df: DataFrame, key: Sequence[str], html: str) -> DataFrame:
    """A row for each nested-safe segment: seg_id, parent_tag, tokenised text and its tags."""
    return pyfn.exploded(df, key, [html], f"seg_id int, parent_tag string, text string, tags array<{TAG}>", lambda h: K.segments(h)[1])


def with_rewritten_segments(docs: DataFrame, revised: DataFrame, key: str, html: str, text: str = "revised_text") -> DataFrame:
    """docs with rewritten_html: each segment's revision where its tokens are whole, its original elsewhere."""
    listed = revised.groupBy(key).agg(F.collect_list(F.struct("seg_id", F.col(text).alias("t"))).alias("__s__"))

    def rebuilt(source: str | None, found: list | None) -> tuple[str | None]:
        if source is None:
            return (None,)
        skeleton, segs = K.segments(source)
        new = {s["seg_id"]: s["t"] for s in found or []}
        parts = {}
        for n, _, old, tags in segs:
            wanted = new.get(n)
            ok = wanted is not None and not K.token_issues(wanted, [t[0] for t in tags])
            parts[n] = K.detokenised(wanted if ok else old, tags)
        return (K.joined(skeleton, parts),)

    joined = docs.join(listed, key, "left")
    return pyfn.with_columns(joined, [html, "__s__"], "rewritten_html string", rebuilt).drop("__s__")


def with_global_tokens(df: DataFrame, html: str) -> DataFrame:
    """df with token_text, token_map (array of token and markup, in order) and token_error for sources that hold tokens."""

    def run(source: str | None) -> tuple:
        if source is None:
            return None, [], None
        try:
            return (*K.global_tokens(source), None)
        except ValueError as e:
            return None, [], str(e)

    return pyfn.with_columns(df, [html], "token_text string, token_map array<struct<token:string,markup:string>>, token_error string", run)


def restored_html(df: DataFrame, text: str = "token_text", tokens: str = "token_map", out: str = "restored_html") -> DataFrame:
    def run(value: str | None, entries: list | None) -> tuple:
        return (None if value is None else K.from_global_tokens(value, [(e["token"], e["markup"]) for e in entries or []]),)

    return pyfn.with_columns(df, [text, tokens], f"{out} string", run)


def with_markers(blocks_: DataFrame, html: str = "block_html") -> DataFrame:
    """Blocks with marker_text and markers, and the block built from them again."""

    def run(source: str | None) -> tuple:
        if not source:
            return None, [], None
        start, end, text, found = K.markers(source)
        return text, found, K.from_markers(start, end, text, found)

    kind = "array<struct<id:string,tag:string,start:string,stop:string,kind:string>>"
    return pyfn.with_columns(blocks_, [html], f"marker_text string, markers {kind}, rebuilt_html string", run)


def with_structure(df: DataFrame, html: str) -> DataFrame:
    return pyfn.with_columns(df, [html], "structure string, protected_structure string", lambda h: (K.structure(h or ""), K.protected_structure(h or "")))


def pieces(df: DataFrame, key: Sequence[str], html: str, most_tokens: int) -> DataFrame:
    """Self-contained pieces of each document within a token limit; error where one isn't possible."""

    def run(source: str | None):
        if not source:
            return []
        try:
            return [(n, p, None) for n, p in enumerate(K.self_contained_pieces(source, most_tokens))]
        except ValueError as e:
            return [(0, None, str(e))]

    return pyfn.exploded(df, key, [html], "piece int, piece_html string, error string", run)


def text_pieces(df: DataFrame, key: Sequence[str], text: str, target: int = P.TARGET_CHARS, hard: int = P.HARD_CHARS) -> DataFrame:
    return pyfn.exploded(df, key, [text], "piece int, piece_text string", lambda t: enumerate(chunking.rewrite_pieces(t, target, hard)))


def paragraph_chunks(df: DataFrame, key: Sequence[str], text: str, most: int, overlap: int = 1) -> DataFrame:
    def run(t: str | None):
        parts = [p.strip() for p in (t or "").split("\n") if p.strip()]
        return [(n, *c) for n, c in enumerate(chunking.overlapping_chunks(parts, most, overlap))]

    return pyfn.exploded(df, key, [text], "chunk int, first int, last int, chunk_text string", run)


def sections(df: DataFrame, key: Sequence[str], text: str, target: int = 6000, overlap: int = 500) -> DataFrame:
    def run(t: str | None):
        return [(n, *s) for n, s in enumerate(chunking.marked_sections((t or "").split("\n"), target, overlap))] if t else []

    return pyfn.exploded(df, key, [text], "section_id int, start_index int, end_index int, section_text string", run)


def with_token_chunks(df: DataFrame, key: Sequence[str], text: str, most: int) -> DataFrame:
    return pyfn.exploded(df, key, [text], "chunk int, chunk_text string", lambda t: enumerate(chunking.token_safe_chunks(t, most)) if t else [])


def with_diff(df: DataFrame, old: str, new: str, out: str = "html_diff") -> DataFrame:
    return pyfn.with_columns(df, [old, new], f"{out} string", lambda a, b: (chunking.unified_diff(a, b),))


def with_deterministic_rules(df: DataFrame, html: str, lists: bool = False, names: tuple[str, ...] = ()) -> DataFrame:
    """Lists numbered and configured names capitalised, in place."""

    def run(source: str | None) -> tuple:
        if source is None:
            return (None,)
        return (K.canonical_in_html(K.numbered_lists(source) if lists else source, names),)

    return pyfn.with_columns(df, [html], f"{html} string", run)


def round_trips(df: DataFrame, key: str, html: str) -> DataFrame:
    """key and whether parsing, global tokens, segments and markers each give the source again."""

    def run(source: str | None) -> tuple:
        if source is None:
            return None, None, None
        text, tokens = K.global_tokens(source)
        skeleton, segs = K.segments(source)
        whole = K.joined(skeleton, {n: K.detokenised(t, tags) for n, _, t, tags in segs})
        return H.parse(source).html() == source, K.from_global_tokens(text, tokens) == source, whole == source

    return pyfn.with_columns(df.select(key, html), [html], "parsed boolean, tokens boolean, segments boolean", run).drop(html)
