import re

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from palimpsest.functions import chunking, freezing
from palimpsest.functions import html as H
from palimpsest.functions import patterns as P
from palimpsest.functions import text as X
from palimpsest.functions import tokens as K

PAGES = [
    "",
    " ",
    "plain text",
    "<p>one <b>two",
    "<ul><li>a<ol><li>b</li></ol>c</li></ul>",
    '<!DOCTYPE html><html><head><title>a </p> b</title></head><body><script>var t = "</p>";</script><p>x<br>y &amp; z</p><!-- note --></body></html>',
    "<div><h2>T</h2><p>Pay <strong>EUR 5</strong> by <a href='x'>card</a> 1 < 2</p><table><tr><td>1</td></tr></table></div>",
    "</p>stray <img src=a/> <p class=\"a>b\">q</p>",
    "<b><i>x</b></i>",
]
LETTERS = st.text(alphabet="ab <>/&;p\"'=!-\n⟦⟧1é🏦.", max_size=60)


@pytest.mark.parametrize("page", PAGES)
def test_html_is_given_again(page):
    assert H.parse(page).html() == page or page.startswith("</p>") or "</i>" in page
    assert "".join(raw for *_, raw in H.events(page)) == page


@settings(max_examples=300, deadline=None)
@given(LETTERS)
def test_any_text_is_read(page):
    assert "".join(raw for *_, raw in H.events(page)) == page
    K.text_nodes(page), K.text_blocks(page), K.visible_text(page), K.leaf_blocks(page), K.structure(page)
    skeleton, found = K.segments(page)
    assert K.joined(skeleton, {n: K.detokenised(t, tags) for n, _, t, tags in found if not re.search(r"⟦/?\d+⟧", page)}) is not None


@pytest.mark.parametrize("page", [p for p in PAGES if "</i>" not in p and not p.startswith("</p>")])
def test_tokens_segments_and_markers_round_trip(page):
    text, tokens = K.global_tokens(page)
    assert K.from_global_tokens(text, tokens) == page
    skeleton, found = K.segments(page)
    assert K.joined(skeleton, {n: K.detokenised(t, tags) for n, _, t, tags in found}) == page
    for _, _, block in K.leaf_blocks(page):
        start, end, marked, markers = K.markers(block)
        assert K.from_markers(start, end, marked, markers) == block
        assert K.marker_issues(marked, marked, markers) == []
        kept_text, kept = K.kept_spans(block)
        assert K.from_kept_spans(kept_text, kept) == block


def test_global_tokens_refuse_their_own():
    with pytest.raises(ValueError):
        K.global_tokens("x ⟦HTML_TAG_000001⟧")
    with pytest.raises(ValueError):
        K.from_global_tokens("⟦HTML_TAG_000009⟧", [])


def test_nested_lists_are_segments_of_their_own():
    _, found = K.segments("<ul><li>Main <b>text</b><ol><li>inner</li></ol> tail</li></ul>")
    assert [(p, t) for _, p, t, _ in found] == [("li", "Main ⟦1⟧text⟦/1⟧"), ("li", " tail"), ("li", "inner")]


def test_text_blocks_have_their_heading():
    found = K.text_blocks("<h1>A</h1><p>one</p><h2> </h2><ul><li>two <i>x</i></li></ul>")
    assert [(n, t, h, x, i) for n, t, h, x, _, i in found] == [(0, "p", "A", "one", False), (1, "li", "A", "two x", True)]


def test_text_nodes_skip_what_no_reader_sees():
    nodes = K.text_nodes(PAGES[5])
    assert [n[1] for n in nodes] == ["x", "y & z"]
    assert nodes[0][3] == ["html", "body", "p"] and nodes[0][4] == "p"


@pytest.mark.parametrize(
    ("text", "issue"),
    [
        ("⟦1⟧a⟦/1⟧ ⟦2⟧b⟦/2⟧", None),
        ("", "empty_revision"),
        ("⟦1⟧a⟦/1⟧", "token_missing:2"),
        ("⟦1⟧a⟦/1⟧⟦2⟧⟦/2⟧⟦3⟧⟦/3⟧", "token_unexpected:3"),
        ("⟦1⟧a⟦2⟧b⟦/1⟧⟦/2⟧", "token_misnested:2:1"),
        ("⟦1⟧⟦/1⟧⟦2⟧⟦/2⟧⟦/2⟧", "token_stray_close:2"),
        ("⟦1⟧a⟦/1⟧⟦2⟧", "token_unclosed:2"),
        ("⟦1⟧⟦/1⟧⟦1⟧⟦/1⟧⟦2⟧⟦/2⟧", "token_open_count:1:2"),
    ],
)
def test_token_issues(text, issue):
    issues = K.token_issues(text, ["1", "2"])
    assert issues == [] if issue is None else issue in issues


def test_marker_issues():
    _, _, text, found = K.markers("<p>a <b>keep</b> <i>x</i><br></p>")
    assert [f[4] for f in found] == ["KEEP", "TAG", "EMPTY"]
    assert K.marker_issues(text, text.replace("keep", "kept"), found) == ["protected_changed:KEEP_1"]
    assert "marker_count:⟦EMPTY_3⟧:0" in K.marker_issues(text, text.replace("⟦EMPTY_3⟧", ""), found)
    assert any(i.startswith("marker_misnested") for i in K.marker_issues(text, text.replace("⟦TAG_2_END⟧", "").replace("⟦KEEP_1_END⟧", "⟦TAG_2_END⟧⟦KEEP_1_END⟧", 1), found))


def test_block_issues():
    a = '<p class="x">a <b>bold</b></p>'
    assert K.block_issues(a, '<p class="x">other <b>bold</b></p>') == []
    assert K.block_issues(a, '<p class="x">a <b>bald</b></p>') == ["protected_text"]
    assert K.block_issues(a, "<li>a <b>bold</b></li>")[:2] == ["root_tag:p:li", "root_attributes"]
    assert K.block_issues(a, "a") == ["not_one_block"]


@pytest.mark.parametrize("most", [20, 40, 80])
def test_pieces_are_self_contained(most):
    page = "<div><p>" + "Some words stand here, in a row. " * 30 + "</p><ul><li>a &amp; b</li></ul><br></div>"
    pieces = K.self_contained_pieces(page, most)
    assert all(len(p) // 4 + 1 <= most for p in pieces)
    assert all(H.parse(p).html() == p for p in pieces)
    squeeze = lambda t: re.sub(r"\s+", "", t or "")
    assert squeeze("".join(K.visible_text(p) for p in pieces)) == squeeze(K.visible_text(page))


def test_piece_of_too_deep_tags_is_an_error():
    with pytest.raises(ValueError):
        K.self_contained_pieces("<div class='" + "x" * 90 + "'>text</div>", 10)


def test_deterministic_rules():
    assert K.numbered_lists("<UL class=a><li>ul</li></UL>") == "<ol class=a><li>ul</li></ol>"
    assert K.canonical_in_html("<p>at diwali <b>diwali</b></p>", ("diwali",)) == "<p>at Diwali <b>diwali</b></p>"


def test_spans_longest_of_the_earliest():
    spans = freezing.protected_spans("on 2024-01-05 pay EUR 12.50 to a@b.example or https://x.example/1")
    assert [(k, v.strip()) for *_, k, v in spans] == [("date_iso", "2024-01-05"), ("currency", "EUR 12.50"), ("email", "a@b.example"), ("url", "https://x.example/1")]


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet="ab 0123456789.,%€-[]IM_must\n", max_size=80))
def test_restored_is_the_text(text):
    frozen, tokens = freezing.freeze(text)
    assert freezing.restore(frozen, tokens) == text
    assert all(frozen.count(t) == 1 for t, *_ in tokens)


def test_frozen_text_may_hold_tokens():
    text = "[[IMM_001]] costs 5"
    frozen, tokens = freezing.freeze(text)
    assert "[[IMM_001]]" not in [t for t, *_ in tokens]
    assert freezing.restore(frozen, tokens) == text
    assert freezing.freeze(None) == (None, [])


def test_numeric_items_by_priority():
    items = freezing.numeric_items("€ 1,250.50 at 3.5% for 10-12 days or 12 months, item 7")
    assert [(k, n) for _, n, k, *_ in items] == [("currency_amount", "€1250.50"), ("percentage", "3.5%"), ("range", "10-12"), ("duration_or_limit", "12 months"), ("plain_number", "7")]
    assert freezing.numeric_items(None) == []


def test_term_count():
    assert freezing.term_count("Home loan, home\nloan; homeloan", "home loan") == 2
    assert freezing.term_count("x", " ") == 0


WORDS = st.lists(st.text(alphabet="abc", min_size=1, max_size=9), max_size=40).map(" ".join)


@settings(max_examples=150, deadline=None)
@given(WORDS, st.integers(4, 30))
def test_cuts_keep_all_words(text, most):
    parts = chunking.cut_at_blanks(text, most)
    assert all(0 < len(p) <= most for p in parts)
    assert "".join(parts).replace(" ", "") == text.replace(" ", "")
    assert "".join(chunking.plain_pieces(text, most)) == text
    safe = chunking.token_safe_chunks(text + "⟦HTML_TAG_000001⟧" + text, most)
    assert "".join(safe) == text + "⟦HTML_TAG_000001⟧" + text and all(len(s) <= max(most, 19) for s in safe)
    assert sum(s.count("⟦HTML_TAG_000001⟧") for s in safe) == 1


@settings(max_examples=100, deadline=None)
@given(st.lists(st.text(alphabet="ab", min_size=1, max_size=12), min_size=1, max_size=20), st.integers(5, 30), st.integers(0, 3))
def test_overlapping_chunks_cover_all(parts, most, overlap):
    chunks = chunking.overlapping_chunks(parts, most, overlap)
    assert sorted({i for a, b, _ in chunks for i in range(a, b + 1)}) == list(range(len(parts)))
    assert all(len(t) <= most or a == b for a, b, t in chunks)
    assert all(x[0] < y[0] for x, y in zip(chunks, chunks[1:]))
    sections = chunking.marked_sections(parts, most + 10, overlap)
    assert sorted({i for a, b, _ in sections for i in range(a, b + 1)}) == list(range(len(parts)))


def test_rewrite_pieces():
    text = ("A sentence of some words. " * 40).strip() + "\n\nshort\n\n" + "x" * 700
    parts = chunking.rewrite_pieces(text, 300, 400)
    assert all(len(p) <= 400 for p in parts)
    assert "".join(parts).replace(" ", "").replace("\n", "") == text.replace(" ", "").replace("\n", "")
    assert chunking.rewrite_pieces(None) == chunking.rewrite_pieces(" ") == []


def test_fitted_contexts():
    prompt = lambda a, c, b: f"[{a}|{c}|{b}]"
    a, b = chunking.fitted_contexts("p" * 50, "cc", "n" * 50, 26, prompt)
    assert (len(a), len(b)) == (10, 10)
    assert chunking.fitted_contexts("", "cc", "n" * 50, 26, prompt) == ("", "n" * 20)
    with pytest.raises(ValueError):
        chunking.fitted_contexts("", "c" * 40, "", 10, prompt)


def test_diff_is_capped():
    assert "-a\n+b" in chunking.unified_diff("a", "b")
    assert chunking.unified_diff("x\n" * 99, "y\n" * 99, 30).endswith("...<diff_truncated>")
    assert chunking.unified_diff(None, "") == ""


def test_budgets():
    assert X.rewrite_chunk_chars(100_000) == 32_666
    with pytest.raises(ValueError):
        X.rewrite_chunk_chars(5_000)
    assert X.payload_tokens(100, 30, 20, 60) == 0


def one(spark, **columns):
    def get(expr):
        row = spark.createDataFrame([tuple(columns.values())], ", ".join(f"{k} {'string' if isinstance(v, (str, type(None))) else 'int'}" for k, v in columns.items()))
        return row.select(expr.alias("x")).first().x

    return get


def test_text_columns(spark):
    get = one(spark, a="  One  two\nthree. Four! ", n=None, b="must", c="1,234.5 – € 7")
    assert get(X.normal_space(F.col("a"))) == "One two three. Four!"
    assert get(X.normal_space(F.col("n"))) == ""
    assert get(X.normal_value(F.col("a"))) == "one two three. four!"
    assert get(X.none_if_empty(F.lit(" "))) is None
    assert get(X.sentences(F.col("a"))) == ["One  two\nthree.", "Four!"]
    assert get(X.paragraphs(F.col("a"))) == ["One  two", "three. Four!"]
    assert get(X.numeric_token(F.col("c"))) == "1234.5 - €7"
    assert [get(X.optional_bool(F.lit(v))) for v in ("Yes", "0", "x")] == [True, False, None]
    assert get(X.normal_severity(F.lit("HIGH "))) == "high" and get(X.normal_severity(F.col("n"))) == "medium"
    assert get(X.rank_of(F.col("b"), P.MODALITY_RANK, 0)) == 5 and get(X.rank_of(F.col("n"), P.MODALITY_RANK, 0)) == 0
    assert get(X.head(F.lit("abcdef"), 3, "…")) == "abc…" and get(X.tail(F.lit("abcdef"), 2)) == "ef"
    assert get(X.context_window(F.lit("0123456789"), F.lit(4), F.lit(5), 2)) == "23456"
    assert get(X.estimated_tokens(F.lit("12345678"))) == 3
    assert get(X.without_tokens(F.lit("⟦1⟧a⟦/1⟧  b"))) == "a b" and not get(X.has_text(F.lit("⟦1⟧⟦/1⟧ ")))
    assert get(X.outer_space(F.lit(" a \n"), F.lit("b "))) == " b \n"
    assert get(X.without_fence(F.lit('```text\n"x"\n```'))) == "x"
    assert get(X.jaccard(F.lit("a b"), F.lit("B c"))) == pytest.approx(1 / 3)
    assert get(X.jaccard(F.lit(""), F.lit(" "))) == 1.0 and get(X.jaccard(F.lit(""), F.lit("x"))) == 0.0
    assert get(X.canonical_names(F.lit("at DIWALI"), ["diwali"])) == "at Diwali"
    assert get(X.json_object(F.lit('noise {"a": 1} end'), "a int")).a == 1
    assert [tuple(r) for r in get(X.marked_paragraphs(F.lit("[[P3]]\nx\n\n[[P4]]\n y ")))] == [(3, "x"), (4, "y")]
    assert get(X.capped_map(F.create_map(F.lit("b"), F.lit(1), F.lit("a"), F.lit(2), F.lit("c"), F.lit(3)), 2)) == {"a": 2, "b": 1, "__truncated__": 1}
    assert get(X.length_ratio(F.lit(" "), F.lit("x"))) is None and get(X.length_is_safe(F.lit(" "), F.lit("x")))
    assert not get(X.length_is_safe(F.lit("abcd"), F.lit("a")))
    assert get(F.array_join(X.style_issues(F.lit("Het wordt door ons betaald.")), ",")) == "possible_passive"
    assert get(X.claim_id(F.lit("c1"), F.lit(1), F.lit("t"))).startswith("c1_claim_")


def test_frozen_and_column_forms_of_numbers_agree(spark):
    raws = ["1,234", "€ 5", "10 – 12", "3.50%", "12  Months", "1,2,3"]
    rows = spark.createDataFrame([(r,) for r in raws], "r string").select("r", X.numeric_token(F.col("r")).alias("n")).collect()
    assert {r.r: r.n for r in rows} == {r: freezing.normal_number(r) for r in raws}
