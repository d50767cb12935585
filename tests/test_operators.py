import random

import pytest
from pyspark.sql import functions as F

from palimpsest.operators import claims, markup, predicates, relational, rewriting, sequence
from palimpsest.plans import evaluate, history
from palimpsest.sinks import tables as sinks
from palimpsest.sources import tables as sources


def rows(df, *by):
    return sorted(tuple(r) for r in df.select(*by).collect()) if by else sorted(map(tuple, df.collect()))


# ---- order -----------------------------------------------------------------------------------


@pytest.fixture(scope="module")
def skewed(spark):
    rnd = random.Random(3)
    data = [("hot", i, rnd.choice([None, "", f"t{i}"]), rnd.randint(0, 9)) for i in range(700)]
    data += [(f"g{g}", i, f"t{i}", rnd.randint(0, 9)) for g in range(40) for i in range(rnd.randint(1, 6))]
    data += [(None, i, f"n{i}", 1) for i in range(5)]
    rnd.shuffle(data)
    return data, spark.createDataFrame(data, "g string, o int, t string, n int").repartition(5)


def grouped(data):
    out = {}
    for g, o, t, n in sorted(data, key=lambda r: (str(r[0]), r[1])):
        out.setdefault(g, []).append((o, t, n))
    return out


def test_positions_of_a_hot_and_a_null_group(skewed):
    data, df = skewed
    got = {(r.g, r.o): r.position for r in sequence.positions(df, ["g"], ["o"]).collect()}
    assert got == {(g, o): i for g, items in grouped(data).items() for i, (o, *_) in enumerate(items)}


def test_neighbours(skewed):
    data, df = skewed
    got = {(r.g, r.o): (r.previous, r.next) for r in sequence.neighbours(df, ["g"], ["o"], "t", 2, 1).collect()}
    want = {(g, x[0]): ([y[1] for y in items[max(0, i - 2) : i]], [y[1] for y in items[i + 1 : i + 2]]) for g, items in grouped(data).items() for i, x in enumerate(items)}
    assert got == want


def test_carried(skewed):
    data, df = skewed
    got = {(r.g, r.o): r.c for r in sequence.carried(df, ["g"], ["o"], F.nullif("t", F.lit("")), "c").collect()}
    want = {}
    for g, items in grouped(data).items():
        last = None
        for o, t, _ in items:
            want[g, o] = last
            last = t or last
    assert got == want


@pytest.mark.parametrize("glue", [0, 2])
def test_packed(skewed, glue):
    data, df = skewed
    got = {(r.g, r.o): r.chunk for r in sequence.packed(df, ["g"], ["o"], F.col("n"), 12, glue).collect()}
    want = {}
    for g, items in grouped(data).items():
        chunk, filled = 0, None
        for o, _, n in items:
            if filled is not None and filled + glue + n > 12:
                chunk, filled = chunk + 1, n
            else:
                filled = n if filled is None else filled + glue + n
            want[g, o] = chunk
    assert got == want


def test_oversized_item_is_alone(spark):
    df = spark.createDataFrame([("d", i, n) for i, n in enumerate([3, 4, 5, 20, 1])], "g string, o int, n int")
    assert [r.chunk for r in sequence.packed(df, ["g"], ["o"], F.col("n"), 8).orderBy("o").collect()] == [0, 0, 1, 2, 3]


def test_batches_and_contexts(spark):
    df = spark.createDataFrame([("d", i, f" w{i} ") for i in range(7)], "g string, o int, t string")
    assert rows(sequence.batches(df, ["o"], 3), "o", "batch") == [(i, i // 3) for i in range(7)]
    got = {r.o: (r.previous_context, r.next_context) for r in sequence.local_context(df, ["g"], ["o"], "t").collect()}
    assert got[0] == ("", "w1") and got[3] == ("w1 w2", "w4") and got[6] == ("w4 w5", "")


def test_empty_tables(spark):
    empty = spark.createDataFrame([], "g string, o int, t string, n int")
    for df in (sequence.positions(empty, ["g"], ["o"]), sequence.neighbours(empty, ["g"], ["o"], "t"), sequence.packed(empty, ["g"], ["o"], F.col("n"), 5), sequence.carried(empty, ["g"], ["o"], F.col("t"), "c")):
        assert df.count() == 0


# ---- relational ------------------------------------------------------------------------------


def test_pending(spark):
    source = spark.createDataFrame([("a", "h"), ("b", None), ("c", "h"), ("d", "new")], "article_id string, html string")
    done = spark.createDataFrame(
        [("a", "v1", "succeeded", "x"), ("c", "v1", "failed", "x"), ("d", "v1", "review_required", "old")], "article_id string, prompt_version string, status string, source_html_sha256 string"
    )
    assert rows(relational.pending(source, done, "v1"), "article_id") == [("c",)]
    assert rows(relational.pending(source, done, "v1", changed=True), "article_id") == [("a",), ("c",), ("d",)]
    assert rows(relational.pending(source, None, "v1"), "article_id") == [("a",), ("c",), ("d",)]


RULES = "rule_id string, priority int, active boolean, categories array<string>, html_tags array<string>"


def test_rules(spark):
    raw = spark.createDataFrame(
        [("r2", 1, True, ["x"], []), ("r1", 1, True, None, ["p"]), ("r0", 5, True, ["all"], None), ("r9", 0, None, None, None), ("r8", 0, False, None, None)], RULES
    )
    nodes = spark.createDataFrame([("x", "p"), ("x", "p"), ("y", "li"), (None, "p"), ("x", None)], "category string, tag string")
    got = {(r.category, r.tag): r.rule_ids for r in relational.with_rules(nodes, sources.rules(raw)).collect()}
    assert got == {("x", "p"): ["r1", "r2", "r0"], ("y", "li"): ["r0"], (None, "p"): ["r1", "r0"], ("x", None): ["r2", "r0"]}


def test_answers(spark):
    parts = spark.createDataFrame([("a", "o1"), ("b", "o2"), ("c", "o3")], "id string, text string")
    answers = spark.createDataFrame([("a", "x", 1), ("a", "y", 2), ("b", " ", 1), ("z", "q", 1)], "id string, t string, n int")
    got = relational.answered(parts, answers, ["id"], "text", "t", "n")
    assert rows(got, "id", "revised_text", F.coalesce("answer_issue", F.lit(""))) == [("a", "y", ""), ("b", "o2", "empty"), ("c", "o3", "missing")]


def test_index_check(spark):
    a = spark.createDataFrame([(1, 1), (1, 2), (2, 1)], "b int, i int")
    r = spark.createDataFrame([(1, 2), (1, 2), (1, 7), (2, 1)], "b int, i int")
    assert rows(relational.index_check(a, r, "b", "i")) == [(1, 1, 1), (2, 0, 0)]


def test_multisets(spark):
    df = spark.createDataFrame([(1, "5 and 5 and 7%", "5 and 8%"), (2, None, "3"), (3, "1", "1")], "d int, a string, b string")
    kinds = relational.P.INVARIANTS[:1]
    diff = relational.multiset_difference(relational.value_counts(df, ["d"], "a", kinds), relational.value_counts(df, ["d"], "b", kinds), ["d", "kind", "value"])
    assert rows(diff, "d", "value", "missing", "added") == [(1, "5", 1, 0), (1, "7", 1, 0), (1, "8", 0, 1), (2, "3", 0, 1)]
    got = df.select("d", F.array_join(relational.kind_mismatches(F.col("a"), F.col("b")), ",").alias("k"))
    assert rows(got) == [(1, "numbers,percentages"), (2, "numbers"), (3, "")]
    terms = relational.term_counts(df.select("d", F.lit("Home  Loan x").alias("a")), ["d"], "a", ["home loan", " "])
    assert {r.n for r in terms.collect()} == {1}


def test_first_of_equal_with_nulls_and_ties(spark):
    df = spark.createDataFrame([(3, None), (1, None), (2, "a"), (2, "a")], "i int, v string")
    assert rows(relational.first_of_equal(df, [F.col("v")], ["i"]), "i") == [(1,), (2,)]


def test_samples_do_not_depend_on_partitions(spark):
    df = spark.range(5000).withColumnRenamed("id", "k")
    a = rows(relational.hash_sample(df.repartition(7), "k", 0.1))
    assert a == rows(relational.hash_sample(df.coalesce(1), "k", 0.1)) and 400 < len(a) < 600
    assert rows(relational.sample_of(df.repartition(3), "k", 30, 0.1)) == rows(relational.sample_of(df, "k", 30, 0.1))
    few = relational.hash_sample(df, "k", 0.001)
    assert relational.topped_up(few, df, "k", 30).distinct().count() == 30
    assert relational.topped_up(few, df.limit(0), "k", 30).count() == few.count()


def test_rollup_summary_and_top(spark):
    nodes = spark.createDataFrame(
        [("a", True, False, ["x"], ["r1"], 1, 2), ("a", False, True, ["y", "x"], None, 1, 1), ("a", None, None, None, ["r0", "r1"], None, 1)],
        "article_id string, changed boolean, needs_review boolean, review_reasons array<string>, applied_rule_ids array<string>, prompt_tokens int, completion_tokens int",
    )
    assert tuple(relational.node_rollup(nodes).first()) == ("a", 3, 1, 1, 1, 2, 4, ["x", "y"], ["r0", "r1"])
    detail = spark.createDataFrame([("v", "ok", 2.0, 10, True), ("v", "error", 2.0, 10, None), ("w", "ok_partial", 0.0, 5, True)], "v string, s string, sec double, c int, f boolean")
    summary = {r.v: r for r in relational.variant_summary(detail, "v", "s", "sec", "c", ["f"]).collect()}
    assert (summary["v"].docs_ok, summary["v"].docs_error, summary["v"].docs_per_min, summary["v"].f_rate) == (1, 1, 30.0, 0.5)
    assert summary["w"].docs_per_min == 0.0
    assert relational.best_variant(relational.variant_summary(detail, "v", "s", "sec", "c", ["f"]), "v").first().v == "v"
    top = relational.top_per_group(detail, ["v"], [F.col("c").desc(), F.col("s")], 1)
    assert rows(top, "v", "s") == [("v", "error"), ("w", "ok_partial")]


# ---- predicates ------------------------------------------------------------------------------


def test_high_risk(spark):
    cases = {"pay 5%": 1, "the fee is 7": 1, "the fee is high": 0, "on 2024-05-05": 1, "USD 5": 1, "past  performance": 1, "identify": 1, "hello": 0, None: 0, "APR now": 1}
    df = spark.createDataFrame([(k,) for k in cases], "t string")
    got = {r.t: int(r.x) for r in df.select("t", predicates.high_risk(F.col("t")).alias("x")).collect()}
    assert got == cases
    strict = {r.t: r.x for r in df.select("t", predicates.high_risk(F.col("t"), strict_ids=True).alias("x")).collect()}
    assert not strict["identify"]


def test_routes_and_reasons(spark):
    flags = spark.createDataFrame([(True, "p", True, True), (False, None, True, True), (False, "p", True, True), (False, "p", False, True), (False, "li", False, False)], "n boolean, a string, p boolean, r boolean")
    got = [r.x for r in flags.select(predicates.route(F.col("n"), F.col("a"), F.col("p"), F.col("r")).alias("x")).collect()]
    assert got == ["non_editable", "non_prose", "protected", "high_risk", "editable"]
    blocks = spark.createDataFrame(
        [("short", [], False), ("x" * 3501, [], False), ("y" * 20, ["head"], False), ("y" * 20, ["table", "td"], False), ("y" * 20, ["td"], False), ("y" * 20, [], True), ("costs 5% more than it", [], False), ("y" * 20, [], False)],
        "t string, p array<string>, i boolean",
    )
    got = [r.x for r in blocks.select(predicates.freeze_reason(F.col("t"), F.col("p"), F.col("i")).alias("x")).collect()]
    assert got == ["too_short", "too_long", "non_editable_ancestor", "high_risk_block_ancestor", "frozen_container_ancestor", "inline_markup_present", "high_risk_content", ""]


def test_polish_and_positions(spark):
    long = "Word " * 30
    df = spark.createDataFrame([("a", "short"), ("", "x"), ("a", "However " + long), ("a", "It " + long), ("x one two three four", "One two three four " + long), ("a", long)], "p string, c string")
    assert [r.x for r in df.select(predicates.needs_polish(F.col("p"), F.col("c")).alias("x")).collect()] == [True, False, True, True, True, False]
    asked = spark.createDataFrame([("1",), (" 7 ",), ("0",), ("-3",), ("1.5",), ("x",), ("",), (None,), ("300",)], "n string")
    got = {r.n: (r.value, r.message) for r in history.looked_up(asked, "n").collect()}
    assert got["1"] == ("0", None) and got[" 7 "] == ("8", None) and got["0"][1] and got["-3"][1] and got["1.5"][1] and got["x"][1] and got[""][1] and got[None][1]
    assert got["300"][0] == str(history.fibonacci(300)) and len(got["300"][0]) > 38
    assert [history.fibonacci(i) for i in range(1, 9)] == [0, 1, 1, 2, 3, 5, 8, 13]


# ---- HTML ------------------------------------------------------------------------------------


def test_html_columns(spark):
    page = '<body><h1>T</h1><p>Some plain words stand here.</p><p>Costs <b>5%</b> more</p><script>var t = "</p>";</script><ul><li>item</li></ul></body>'
    df = spark.createDataFrame([(1, page), (2, None), (3, ""), (4, "text only")], "d int, html string")
    routes = rows(markup.routed(markup.text_nodes(df, ["d"], "html")), "d", "text", "route")
    assert (1, "5%", "protected") in routes and (1, "T", "non_prose") in routes and (1, "Some plain words stand here.", "editable") in routes and (4, "text only", "non_prose") in routes
    assert rows(markup.editable_nodes(df, ["d"], "html"), "d", "text") == [(1, " more"), (1, "Costs "), (1, "Some plain words stand here."), (1, "T"), (1, "item"), (4, "text only")]
    assert rows(markup.blocks(df, ["d"], "html"), "block_id", "heading", "freeze_reason") == [(0, "T", ""), (1, "T", "too_short"), (2, "T", "too_short")]
    seen = {r.d: r.visible_text for r in markup.with_visible_text(df, "html").collect()}
    assert seen == {1: "T Some plain words stand here. Costs 5% more item", 2: None, 3: "", 4: "text only"}
    assert {r.d: r.bold_texts for r in markup.with_bold_texts(df, "html").collect()}[1] == ["5%"]
    tokens = markup.restored_html(markup.with_global_tokens(df, "html"))
    assert all(r.restored_html == r.html for r in tokens.collect())
    segs = markup.token_segments(df, ["d"], "html")
    revised = segs.select("d", "seg_id", F.upper("text").alias("revised_text"))
    got = {r.d: r.rewritten_html for r in markup.with_rewritten_segments(df, revised, "d", "html").collect()}
    assert got[1].startswith("<body><h1>T</h1><p>SOME PLAIN WORDS") and "<b>5%</b> MORE" in got[1] and got[2] is None and got[4] == "TEXT ONLY"
    broken = segs.select("d", "seg_id", F.lit("no tokens").alias("revised_text"))
    assert "Costs <b>5%</b> more" in {r.d: r.rewritten_html for r in markup.with_rewritten_segments(df, broken, "d", "html").collect()}[1]
    assert all(r.rebuilt_html == r.block_html for r in markup.with_markers(markup.leaf_blocks(df, ["d"], "html")).collect())
    assert markup.pieces(df, ["d"], "html", 5).where("error is not null").count() >= 0
    ruled = {r.d: r.html for r in markup.with_deterministic_rules(df, "html", True, ("item",)).collect()}
    assert "<ol><li>Item</li></ol>" in ruled[1] and ruled[2] is None
    assert rows(markup.paragraph_chunks(spark.createDataFrame([(1, "a\n\nb\nc"), (2, None)], "d int, t string"), ["d"], "t", 3), "d", "chunk", "first", "last") == [(1, 0, 0, 1), (1, 1, 1, 2)]
    assert markup.sections(spark.createDataFrame([(1, "a\nb"), (2, None)], "d int, t string"), ["d"], "t").count() == 1


# ---- rewriting -------------------------------------------------------------------------------

TEXTS = [("a", 0, "Pay EUR 5 prior to 2024-01-05 in the shop."), ("a", 1, "ok"), ("a", 2, "Nothing  to change here."), ("b", 0, None), ("b", 1, "We utilise 3 cards.")]


@pytest.fixture(scope="module")
def nodes(spark):
    return spark.createDataFrame(TEXTS, "d string, o int, text string")


def test_identity_changes_nothing(nodes):
    got = rewriting.rewritten_nodes(nodes, rewriting.IdentityRewriter()).collect()
    assert not any(r.changed or r.needs_review for r in got)
    assert {(r.d, r.o): r.rewritten_text for r in got} == {(d, o): t for d, o, t in TEXTS}


def test_rules_change_words_and_keep_facts(nodes):
    got = {(r.d, r.o): r for r in rewriting.rewritten_nodes(nodes, rewriting.RuleRewriter()).collect()}
    assert got["a", 0].rewritten_text == "Pay EUR 5 before 2024-01-05 in the shop." and got["a", 0].changed
    assert got["a", 2].rewritten_text == "Nothing to change here." and got["b", 1].rewritten_text == "We use 3 cards."


@pytest.mark.parametrize(
    ("fault", "reason"), [("drop", "expected once but found 0"), ("duplicate", "expected once but found 2"), ("number", "number values changed"), ("empty", "outside the allowed"), ("raise", "Node rewrite failed")]
)
def test_each_fault_is_found_and_the_text_kept(nodes, fault, reason):
    got = rewriting.rewritten_nodes(nodes.where("o = 0 and d = 'a'"), rewriting.FaultyRewriter(rewriting.IdentityRewriter(), fault)).first()
    assert got.needs_review and got.rewritten_text == TEXTS[0][2] and any(reason in r for r in got.review_reasons), got.review_reasons


def test_repair_rounds(spark, nodes):
    class Learner:
        def rewrite(self, requests):
            return [t + "!" if c["__why__"] else "" for t, c in requests]

    wrong = lambda t, a: F.when(a == "", F.array(F.lit("empty"))).otherwise(F.array().cast("array<string>"))
    got = rewriting.repaired(nodes.where("text is not null"), "text", Learner(), wrong).collect()
    assert all(r.attempts == 2 and r.revised_text == r.text + "!" for r in got)
    never = rewriting.repaired(nodes.where("text is not null"), "text", rewriting.FaultyRewriter(rewriting.IdentityRewriter(), "empty"), wrong).collect()
    assert all(r.attempts == 3 and r.revised_text == r.text and r.issues == ["empty"] for r in never)


def test_retries():
    calls = []

    def flaky():
        calls.append(1)
        if len(calls) < 3:
            raise OSError
        return ["x"]

    assert rewriting.with_retries(flaky) == ["x"] and len(calls) == 3
    with pytest.raises(OSError):
        rewriting.with_retries(lambda: (_ for _ in ()).throw(OSError()), 2)


def test_two_stage(spark):
    tag = "array<struct<token:string,start:string,stop:string>>"
    segs = spark.createDataFrame([(1, "a ⟦1⟧b⟦/1⟧", [("1", "<b>", "</b>")]), (2, "c", [])], f"i int, text string, tags {tag}")
    good = rewriting.two_stage(segs, rewriting.IdentityRewriter(), rewriting.IdentityRewriter())
    assert rows(good, "i", "revised_text") == [(1, "a ⟦1⟧b⟦/1⟧"), (2, "c")] and good.where("size(issues) > 0").count() == 0
    bad = rewriting.two_stage(segs, rewriting.IdentityRewriter(), rewriting.FaultyRewriter(rewriting.IdentityRewriter(), "drop"))
    assert {r.i: r.revised_text for r in bad.collect()}[1] == "a ⟦1⟧b⟦/1⟧"


def test_two_passes(spark):
    page = "<p>We utilise many cards in the big shop.</p><p>It is whenever you like to come by here.</p><p>short</p><p>It costs 5% of all that you have.</p>"
    df = spark.createDataFrame([("d", page)], "d string, html string")
    one = rewriting.pass_one(markup.blocks(df, ["d"], "html"), rewriting.RuleRewriter())
    assert [r.status for r in one.orderBy("block_id").collect()] == ["rewritten_pass1", "rewritten_pass1", "skipped", "skipped"]
    two = rewriting.pass_two(one, rewriting.RuleRewriter(), ["d"], ["block_id"]).orderBy("block_id").collect()
    assert [r.status for r in two] == ["rewritten_pass1", "rewritten_pass1_pass2", "skipped", "skipped"]
    bad = rewriting.pass_one(markup.blocks(df, ["d"], "html"), rewriting.FaultyRewriter(rewriting.RuleRewriter(), "number")).where("block_id = 0").first()
    assert bad.status == "pass1_invariant_fallback" and bad.pass1_error == "invariant_mismatch:numbers" and bad.rewritten_text == bad.text


def test_harmonised(spark):
    parts = spark.createDataFrame([("d", i, f"part {i} " + "x" * 30) for i in range(9)] + [("e", 0, "one")], "d string, o int, t string")
    got = {r.d: r.t for r in rewriting.harmonised(parts, rewriting.IdentityRewriter(), "d", "o", "t", 90).collect()}
    assert got["e"] == "one" and [w for w in got["d"].split() if w.isdigit()] == [str(i) for i in range(9)]


# ---- claims ----------------------------------------------------------------------------------

FIELDS = dict(claim_type="rule", subject="client", actor=None, action="pay fee", target=None, modality="must", condition=None, timing=None, approver=None, value="5", unit="%", negated=False, approval_required=True, exclusive=None, severity="high", source_text="s")
SCHEMA = "doc string, claim_id string, ord int, " + ", ".join(f"{k} {'boolean' if k in claims.FLAGS else 'string'}" for k in FIELDS)


def claim(spark, *changes):
    return spark.createDataFrame([("d", f"c{i}", i, *(FIELDS | c).values()) for i, c in enumerate(changes)], SCHEMA)


@pytest.mark.parametrize(
    ("change", "verdict"),
    [
        ({}, "preserved"),
        ({"source_text": "t"}, "preserved_but_rephrased"),
        ({"negated": True}, "contradicted"),
        ({"negated": None}, "contradicted"),
        ({"approval_required": False}, "weakened"),
        ({"exclusive": True}, "weakened"),
        ({"modality": "may"}, "weakened"),
        ({"modality": "prohibited"}, "uncertain"),
        ({"timing": "in 5 days"}, "uncertain"),
        ({"value": "6"}, "uncertain"),
        ({"modality": "may", "negated": True}, "contradicted"),
    ],
)
def test_verdicts(spark, change, verdict):
    results, new = claims.compared(claim(spark, {}), claim(spark, change), "doc")
    assert results.first().result == verdict and new.count() == 0


def test_strengthened_missing_and_new(spark):
    results, new = claims.compared(claim(spark, {"modality": "may"}), claim(spark, {}, {"subject": "else", "action": "other", "claim_type": "z"}), "doc")
    assert results.first().result == "strengthened" and new.count() == 1
    results, new = claims.compared(claim(spark, {}), claim(spark).limit(0), "doc")
    assert results.first().result == "missing" and new.count() == 0


def test_top_k_over_salted_parts_is_the_whole_top_k(spark):
    rnd = random.Random(5)
    many = [{"subject": rnd.choice(["client", "bank client", "x"]), "action": rnd.choice(["pay fee", "pay", "go"]), "value": rnd.choice(["5", "6"])} for _ in range(60)]
    a, b = claim(spark, {}), claim(spark, *many)
    got = [(round(r.score, 6), r.b.ord) for r in claims.candidates(a, b, "doc").orderBy("rank").collect()]
    scored = b.select("ord", F.struct("*").alias("b")).crossJoin(a.select(F.struct("*").alias("a"))).select("ord", claims.match_score("a", "b").alias("s")).collect()
    assert got == [(round(r.s, 6), r.ord) for r in sorted(scored, key=lambda r: (-r.s, r.ord))[:5]]


def test_parsed_and_deduplicated(spark):
    body = '```{"claims": [{"claim_type": "rule", "subject": " A ", "negated": "yes", "severity": "odd", "modality": "MUST"}, {"claim_type": "rule", "subject": "a", "negated": true, "modality": "must", "approver": "x"}, null]}```'
    raw = spark.createDataFrame([("k1", body), ("k2", "no json"), ("k3", None)], "chunk string, body string")
    got = claims.parsed(raw, "chunk", "body").withColumn("doc", F.lit("d"))
    assert [(r.subject, r.negated, r.severity, r.modality) for r in got.orderBy("ord").collect()] == [("A", True, "medium", "must"), ("a", True, "medium", "must")]
    assert claims.deduplicated(got, "doc").count() == 1


def test_decisions(spark):
    terms = ("manager approval",)
    pairs = spark.createDataFrame(
        [("same", "Pay 5 now.", "Pay 5 soon."), ("number", "Pay 5 now.", "Pay 6 now."), ("term", "Needs manager approval.", "Needs approval.")], "doc string, a string, b string"
    )
    none = claim(spark).limit(0)
    got = {r.doc: (r.decision, r.reason) for r in evaluate.evaluated(pairs, "doc", "a", "b", terms, none, none).collect()}
    assert got["same"][0] == "pass" and got["number"] == ("fail", "Numeric integrity check failed.") and got["term"] == ("fail", "Protected terminology/entity check failed.")
    docs = spark.createDataFrame([("d", True, True)], "doc string, n boolean, t boolean")
    for change, want in (({"negated": True}, "fail"), ({"modality": "may"}, "fail"), ({"value": "9"}, "review"), ({"source_text": "q"}, "pass")):
        results, new = claims.compared(claim(spark, {}), claim(spark, change), "doc")
        assert claims.decisions(docs, "doc", "n", "t", results, new).first().decision == want
    results, new = claims.compared(claim(spark, {"severity": "critical"}), none, "doc")
    assert claims.decisions(docs, "doc", "n", "t", results, new).first().reason.startswith("Critical claim missing: ")
    assert claims.decisions(docs, "doc", "n", "t", results, new, rules={"missing": False}).first().decision == "pass"


# ---- sources and sinks -----------------------------------------------------------------------


def test_sources(spark, tmp_path):
    assert rows(sources.probed(spark.createDataFrame([("t", None), (None, "x")], "text string, cat string"), "text", "id", "cat"), "html_text", "category") == [("t", "internal")]
    with pytest.raises(ValueError):
        sources.probed(spark.range(1), "text")
    (tmp_path / "rules.json").write_text('[{"rule_id": "a", "instruction": "i"}, {"rule_id": "b", "active": false}]')
    got = sources.rules_from_json(spark, str(tmp_path / "rules.json")).first()
    assert (got.rule_id, got.priority, got.categories, got.deterministic) == ("a", 100, ["all"], False)
    (tmp_path / "x.html").write_text("<p>a</p>\n<p>b</p>\n")
    assert sources.whole_files(spark, str(tmp_path / "x.html")).first().text == "<p>a</p>\n<p>b</p>\n"
    (tmp_path / "d.docx").write_bytes(sinks.docx(["one & two", "", "three"]))
    assert rows(sources.docx_paragraphs(spark, str(tmp_path / "d.docx")), "index", "text", "is_empty") == [(0, "one & two", False), (1, "", True), (2, "three", False)]
    assert rows(sources.line_paragraphs(spark.createDataFrame([(1, "a\n \nb"), (2, None)], "k int, t string"), "k", "t")) == [(1, 0, "a", False), (1, 1, " ", True), (1, 2, "b", False)]
    assert {r.n for r in sources.synthetic_documents(spark, 3, 3000).select(F.length("html").alias("n")).collect()} == {3000}
    assert sources.settings({"a": "", "b": "1"}, {"a": "2"}, env={"A": "3"}) == {"a": "2", "b": "1"}
    assert sources.settings({"a": " "}, env={"A": "3"}) == {"a": "3"}


def test_sinks(spark, tmp_path):
    path = str(tmp_path / "t")
    schema = "article_id string, prompt_version string, n int"
    sinks.ensure(spark, path, schema)
    first = spark.createDataFrame([("a", "v", 1), ("b", "v", 2)], schema)
    sinks.upsert(spark, path, first)
    again = spark.createDataFrame([("b", "v", 3), ("b", "w", 4), ("c", "v", 5)], schema)
    for _ in range(2):
        sinks.upsert(spark, path, again)
        assert rows(spark.read.parquet(path)) == [("a", "v", 1), ("b", "v", 3), ("b", "w", 4), ("c", "v", 5)]
    log = str(tmp_path / "log")
    sinks.append(first, log)
    sinks.append(first.withColumn("more", F.lit(True)), log)
    assert sinks.with_all_columns(spark, log).where("more is null").count() == 2
    assert not sinks.append_unless_empty(first.limit(0), log) and sinks.append_unless_empty(first, log)
    dup = spark.createDataFrame([("a", 1, "x"), ("a", 2, "y"), ("a", 2, "y")], "k string, at int, v string")
    assert rows(sinks.one_per_key(dup, ["k"], ["at"])) == [("a", 2, "y")]
    sinks.write_text(dup, "v", str(tmp_path / "txt"))
    sinks.write_json(dup, str(tmp_path / "js"))
    assert spark.read.text(str(tmp_path / "txt")).count() == spark.read.json(str(tmp_path / "js")).count() == 3
    got = sinks.history_rows(spark.createDataFrame([("5",), ("6",)], "num string")).collect()
    assert len({r.id for r in got}) == 2 and all(r.date for r in got)
    assert len(sinks.docx_files(spark.createDataFrame([("k", ["a", None])], "k string, p array<string>"), "k", "p").first().content) > 500


# ---- with a model ----------------------------------------------------------------------------


def canned(**answers):
    """A model that answers by the first of its words that a request holds."""

    class Canned:
        def rewrite(self, requests):
            return [next((a for w, a in answers.items() if w in t), "no idea") for t, _ in requests]

    return Canned()


def test_claims_by_a_model(spark):
    chunks = spark.createDataFrame([("d", "k1", "first text"), ("d", "k2", "second text"), ("e", "k3", "other")], "doc string, chunk string, t string")
    found = claims.extracted(chunks, "doc", "chunk", "t", canned(first='{"claims": [{"subject": "a"}]}', second='{"claims": [{"subject": "A "}, {"subject": "b"}]}'))
    assert rows(found, "doc", "subject") == [("d", "a"), ("d", "b")]
    a, b = claim(spark, {}, {"subject": "x", "action": "go"}), claim(spark, {"value": "6"}, {"subject": "x", "action": "go"})
    results, _ = claims.compared(a, b, "doc")
    told = claims.assisted(results, claims.candidates(a, b, "doc"), "doc", canned(claim='{"result": "preserved", "best_match_claim_id": "c1"}'))
    assert rows(told, "claim_id", "result", "method") == [("c0", "preserved", "model"), ("c1", "preserved", "fields")]
    same = claims.assisted(results, claims.candidates(a, b, "doc"), "doc", canned())
    assert rows(same, "claim_id", "result", "method") == [("c0", "uncertain", "fields"), ("c1", "preserved", "fields")]
    pairs = spark.createDataFrame([("d", "alpha", "beta", "none"), ("e", "gamma", "delta", "none")], "doc string, a string, b string, f string")
    assert rows(claims.judged(pairs, "doc", "a", "b", "f", canned(alpha='{"semantic_equivalent": true}'))) == [("d", True), ("e", False)]
    docs = spark.createDataFrame([("d", True, True, False)], "doc string, n boolean, t boolean, j boolean")
    none = claim(spark).limit(0)
    results, new = claims.compared(none, none, "doc")
    assert claims.decisions(docs, "doc", "n", "t", results, new, "j").first().decision == "review"


def test_prompts():
    from palimpsest.functions import prompts

    assert "Rules:\n- r1\n- r2" in prompts.system("cards", "p", ["r1", "r2"]) and "Rules" not in prompts.system("cards", "p", [])
    assert prompts.block("", "", "x", "") == "Text to rewrite:\nx" and prompts.chunk("a", "b", "c", 1, 2).startswith("Part 1 of 2")
    assert "smooth" in prompts.polish("a", "b") and prompts.section([], "[[P0]]\nx").endswith("[[P0]]\nx")
    assert prompts.claims("T", ["a"]).endswith("T") and len(prompts.judgement("x" * 20_000, "y", "f")) < 13_000


def test_stored_tables_can_be_cleared(spark):
    from palimpsest import session

    df = session.stored(spark.range(3))
    assert df.count() == 3
    session.clear(spark)
    with pytest.raises(Exception):
        spark.read.parquet(df.inputFiles()[0]).count()
