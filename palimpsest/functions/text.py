"""Text functions as column expressions: they stay in the JVM and inside generated code."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from palimpsest.functions import patterns as P


def normal_space(c: Column) -> Column:
    """Runs of white space as one blank, none at the ends; empty for null."""
    return F.trim(F.regexp_replace(F.coalesce(c, F.lit("")), r"(?U)\s+", " "))


def stripped(c: Column) -> Column:
    """The text without white space at its ends."""
    return F.regexp_replace(c, r"(?U)^\s+|\s+$", "")


def normal_value(c: Column) -> Column:
    """As normal_space, in lower case; any type."""
    return F.lower(normal_space(c.cast("string")))


def none_if_empty(c: Column) -> Column:
    """The stripped text, null where nothing is left."""
    return F.nullif(stripped(c.cast("string")), F.lit(""))


def optional_bool(c: Column) -> Column:
    """true, yes, 1 and false, no, 0 in any case; null for all else."""
    low = F.lower(F.trim(c.cast("string")))
    return F.when(low.isin("true", "yes", "1"), True).when(low.isin("false", "no", "0"), False)


def normal_severity(c: Column) -> Column:
    low = normal_value(c)
    return F.when(low.isin(*P.SEVERITY_RANK), low).otherwise("medium")


def rank_of(c: Column, ranks: Mapping[str, int], default: int) -> Column:
    """The rank of a name by a fixed table, the default for names it lacks and for null."""
    pairs = [F.lit(x) for pair in ranks.items() for x in pair]
    return F.coalesce(F.try_element_at(F.create_map(*pairs), F.coalesce(c, F.lit(""))), F.lit(default))


def numeric_token(c: Column) -> Column:
    """One form of a number: single blanks, plain hyphens, no blank behind a currency sign, no thousands commas."""
    one = F.translate(F.trim(F.regexp_replace(c, r"\s+", " ")), "–—", "--")
    close = F.regexp_replace(one, r"([€$£¥])\s+", "$1")
    return F.lower(F.regexp_replace(close, r"(?<=\d),(?=[\d,]|$)|(?<=\d),(?=\.)", ""))


def context_window(text: Column, start: Column, stop: Column, width: int = P.CONTEXT_WIDTH) -> Column:
    """The text from ``width`` characters before start to as many behind stop, offsets from 0."""
    left = F.greatest(F.lit(0), start - width)
    return F.substring(text, left + 1, stop + width - left)


def all_matches(text: Column, pattern: str, case: bool = True) -> Column:
    """All matches of a pattern in order; empty for null."""
    return F.coalesce(F.regexp_extract_all(text, F.lit(P.flagged(pattern, case)), F.lit(0)), F.array().cast("array<string>"))


def matches_by_kind(text: Column, kinds: Sequence[tuple[str, str, bool]], allowed_names: Sequence[str] = ()) -> Column:
    """array<struct<kind, values>>: the stripped matches of each kind that aren't blank, further names as product names."""

    def values(kind: str, pattern: str, case: bool) -> Column:
        found = all_matches(text, pattern, case)
        if kind == "product_names":
            for name in allowed_names:
                found = F.concat(found, all_matches(text, rf"\Q{name}\E"))
        return F.filter(F.transform(found, lambda v: F.trim(v)), lambda v: v != "")

    return F.array(*(F.struct(F.lit(k).alias("kind"), values(k, p, c).alias("values")) for k, p, c in kinds))


def sentences(text: Column) -> Column:
    """Split behind ., ! and ? and white space; stripped, none blank."""
    return F.filter(F.split(stripped(text), "(?U)" + P.SENTENCE_END), lambda s: s != "")


def paragraphs(text: Column) -> Column:
    """Lines, stripped, none blank."""
    return F.filter(F.transform(F.split(text, r"\n+"), stripped), lambda s: s != "")


def head(text: Column, most: int, mark: str = "") -> Column:
    """The first characters, with a mark where some were left out."""
    return F.when(F.length(text) <= most, text).otherwise(F.concat(F.substring(text, 1, most), F.lit(mark)))


def tail(text: Column, most: int) -> Column:
    """The last characters."""
    return F.when(F.length(text) <= most, text).otherwise(F.expr("''") if most <= 0 else F.right(text, F.lit(most)))


def trimmed_context(text: Column, most: int = P.CONTEXT_CHARS) -> Column:
    """White space normalised, the last characters kept, stripped."""
    return F.trim(tail(normal_space(text), most))


def estimated_tokens(text: Column) -> Column:
    """A token count without a tokenizer: a quarter of the characters and one."""
    return F.floor(F.length(text) / 4) + 1


def length_ratio(original: Column, rewritten: Column) -> Column:
    """Stripped lengths; null for a blank original."""
    bare = lambda c: F.length(stripped(F.coalesce(c, F.lit(""))))
    return F.when(bare(original) > 0, bare(rewritten) / F.greatest(bare(original), F.lit(1)))


def length_is_safe(original: Column, rewritten: Column) -> Column:
    low, high = P.LENGTH_RATIO
    return F.coalesce(length_ratio(original, rewritten).between(low, high), F.lit(True))


def canonical_names(text: Column, names: Sequence[str]) -> Column:
    """Each configured name, however capitalised, with its first letter in upper case."""
    for name in names:
        text = F.regexp_replace(text, rf"(?iu)\b\Q{name}\E\b", name[:1].upper() + name[1:])
    return text


def without_fence(text: Column) -> Column:
    """Model output without a code fence and quotes around it."""
    bare = F.regexp_replace(F.trim(F.coalesce(text, F.lit(""))), r"(?i)^```(?:text|html)?\s*", "")
    return F.btrim(F.trim(F.regexp_replace(bare, r"\s*```$", "")), F.lit('"'))


def json_object(text: Column, schema: str) -> Column:
    """The text as JSON, or else the widest part in braces as JSON; null where neither is."""
    whole = F.from_json(text, schema)
    inner = F.from_json(F.regexp_extract(text, r"(?s)\{.*\}", 0), schema)
    return F.when(F.trim(text).rlike(r"(?s)^\{.*\}$"), whole).otherwise(inner)


def marked_paragraphs(text: Column) -> Column:
    """array<struct<index, text>> of a section with a [[Pn]] line before each paragraph."""
    indexes = F.regexp_extract_all(text, F.lit(rf"{P.PARAGRAPH_MARKER}\s*\n"), F.lit(1))
    parts = F.slice(F.split(text, r"\[\[P\d+\]\]\s*\n"), 2, 1_000_000)
    return F.transform(F.arrays_zip(indexes.alias("i"), parts.alias("t")), lambda x: F.struct(x["i"].cast("int").alias("index"), stripped(x["t"]).alias("text")))


def without_tokens(text: Column) -> Column:
    """Plain text of a tokenised one."""
    return normal_space(F.regexp_replace(text, P.INLINE_TOKEN, ""))


def has_text(text: Column) -> Column:
    return F.length(without_tokens(text)) > 0


def outer_space(text: Column, rewritten: Column) -> Column:
    """The rewritten text between the white space that stood around the original."""
    return F.concat(F.regexp_extract(text, r"^\s*", 0), F.trim(rewritten), F.regexp_extract(text, r"\s*$", 0))


def style_issues(text: Column, most_words: int = 20) -> Column:
    """Issues of each sentence: too many words, and the pattern of the Dutch passive."""
    plain = without_tokens(text)

    def of(s: Column) -> Column:
        words = F.size(F.regexp_extract_all(s, F.lit(r"(?U)\w+(?:['’-]\w+)*"), F.lit(0)))
        passive = s.rlike(r"(?i)\b(wordt|worden|werd|werden|is|zijn)\b.*\b\w+(d|t)\b") & s.rlike(r"(?i)\bdoor\b")
        return F.filter(
            F.array(
                F.when(words > most_words, F.concat(F.lit("sentence_too_long:"), words.cast("string"))),
                F.when(passive, F.lit("possible_passive")),
            ),
            lambda x: x.isNotNull(),
        )

    return F.flatten(F.transform(sentences(plain), of))


def capped_map(counts: Column, most: int = P.MAX_MAP_ITEMS) -> Column:
    """A map of counts with at most so many entries by key, and how many were left out."""
    entries = F.array_sort(F.map_entries(counts))
    rest = F.array(F.struct(F.lit("__truncated__").alias("key"), (F.size(entries) - most).cast("int").alias("value")))
    kept = F.transform(F.slice(entries, 1, most), lambda e: F.struct(e["key"].alias("key"), e["value"].cast("int").alias("value")))
    return F.map_from_entries(F.when(F.size(entries) > most, F.concat(kept, rest)).otherwise(kept))


def sha256(text: Column) -> Column:
    return F.sha2(text, 256)


def version_suffix(payload: Column) -> Column:
    return F.substring(F.sha2(payload, 256), 1, 12)


def claim_id(chunk: Column, index: Column, source: Column) -> Column:
    """The chunk's name and a digest of chunk, index and source text."""
    joined = F.concat_ws("|", chunk, index.cast("string"), F.coalesce(source, F.lit("")))
    return F.concat(chunk, F.lit("_claim_"), F.substring(F.sha1(joined), 1, 12))


def utc_text(ts: Column) -> Column:
    return F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss'Z'")


def jaccard(a: Column, b: Column) -> Column:
    """Similarity of two values' word sets: 1 if both are empty or equal, 0 if one is empty."""
    x, y = normal_value(a), normal_value(b)
    words = lambda c: F.split(c, " ")
    shared = F.size(F.array_intersect(words(x), words(y)))
    every = F.size(F.array_union(words(x), words(y)))
    return F.when(x == y, 1.0).when((x == "") | (y == ""), 0.0).otherwise(shared / every)


def rewrite_chunk_chars(budget: int, reserved: int = P.PROMPT_RESERVE) -> int:
    """Characters of a chunk when the one before and the one behind share the budget with it."""
    if budget <= reserved + 3_000:
        raise ValueError("the budget is too small for a chunk with its neighbours")
    return max(1, (budget - reserved) // 3)


def payload_tokens(limit: int, system: int, schema: int, answer: int, margin: int = 0) -> int:
    """Tokens left for the payload of a call."""
    return max(0, limit - system - schema - answer - margin)
