import random
import re
import tracemalloc
import unicodedata

import duckdb
import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from palimpsest.llm import encoding, langid, languages, leakage, lookalike, markup, pairs, queries, readability, splitting, truncation
from palimpsest.session import cut

DATA = "/root/testdata/sf0.001"

EN = "Please send us the form within ten days so that we can look at your request."
NL = "Stuur ons het formulier binnen tien dagen zodat wij uw verzoek kunnen bekijken."
DE = "Bitte senden Sie uns das Formular innerhalb von zehn Tagen, damit wir Ihren Antrag prüfen können."
FR = "Envoyez-nous le formulaire dans un délai de dix jours afin que nous examinions votre demande."
ES = "Envíenos el formulario en un plazo de diez días para que podamos revisar su solicitud."
JA = "申込書を十日以内に送ってください。そうすれば確認することができます。"
ALL = {"en": EN, "nl": NL, "de": DE, "fr": FR, "es": ES, "ja": JA}


@pytest.fixture(scope="module")
def model():
    return langid.Model.train()


def rows(df, *by):
    return sorted(tuple(r) for r in (df.select(*by) if by else df).collect())


# ---- 5 languages -----------------------------------------------------------------------------


def test_each_language(model):
    for lang, text in ALL.items():
        (got,) = model.passages([text])
        assert [p[0] for p in got] == [lang] and got[0][1] > 0.55


@pytest.mark.parametrize("glue", ["\n", " ", " / ", " — "])
def test_mixed_texts_have_a_passage_each(model, glue):
    for a, b in (("en", "nl"), ("de", "es"), ("fr", "en")):
        text = ALL[a] + glue + ALL[b]
        (got,) = model.passages([text])
        assert [p[0] for p in got] == [a, b]
        assert text[got[1][3] : got[1][4]].strip(" /—\n") == ALL[b]


def test_what_is_no_language(model):
    for text in (None, "", "  ", "24/7", "ok", "1234|5678.90;" * 300, "https://x.example/?k1=" + "0a9f" * 900, "🏦💳" * 2000, "—"):
        assert list(model.passages([text])) == [[]]


def test_quoted_terms_and_tokens_count_for_nothing(model):
    (got,) = model.passages([EN[:-1] + " (“dans l'application mobile”)."])
    assert [p[0] for p in got] == ["en"]
    (got,) = model.passages([EN.replace("form", "⟦1⟧form⟦/1⟧")])
    assert [p[0] for p in got] == ["en"]


def test_the_table_is_the_inner_product_of_the_vectors():
    counts = np.zeros((len(langid.LANGS), langid.K**3))
    rng = np.random.default_rng(0)
    seen = rng.integers(0, langid.K**3, 40)
    counts[rng.integers(0, len(langid.LANGS), 40), seen] = rng.integers(1, 9, 40)
    base = langid._letters()
    vector = lambda t: np.roll(base[t // langid.K**2], 2) * np.roll(base[t // langid.K % langid.K], 1) * base[t % langid.K]
    weights = np.sqrt(counts / np.maximum(counts.sum(1, keepdims=True), 1))
    protos = np.stack([sum(w * vector(t) for t, w in enumerate(row) if w) + np.zeros(langid.DIM) for row in weights])
    protos -= protos.mean(0)
    protos /= np.linalg.norm(protos, axis=1, keepdims=True)
    table = langid.scores_of_counts(counts)
    for t in [*seen[:9], 5, 77_777]:
        assert table[t] == pytest.approx(protos @ vector(t) / np.sqrt(langid.DIM), abs=1e-3)


@settings(max_examples=150, deadline=None)
@given(st.text(alphabet="abc thesn éあ今. ", max_size=400), st.integers(1, 60))
def test_cosines_are_cosines(text, times):
    model = langid.Model.train()
    segs = langid.segments([text * times, "the " * 200, EN * 3])
    inner = langid.products(segs, model.table)
    for got in (langid.cosines(segs, inner), langid.cosines(segs, inner, segs.text), langid.cosines(segs, inner, segs.part)):
        assert np.abs(got).max() <= 1.0


def test_cosine_is_that_of_the_bundle(model):
    """Bundles added up vector by vector; what differs is the chance correlation of their trigrams."""
    base = langid._letters()
    for text in (*ALL.values(), "the " * 50):
        segs = langid.segments([text])
        t = segs.trigram
        vectors = np.roll(base[t // langid.K**2], 2, 1) * np.roll(base[t // langid.K % langid.K], 1, 1) * base[t % langid.K]
        inner = langid.products(segs, model.table)
        exact = inner.sum(0) * np.sqrt(langid.DIM) / np.linalg.norm(vectors.sum(0))
        assert langid.cosines(segs, inner, segs.text)[0] == pytest.approx(exact, abs=0.03)


def test_short_sentences_tell_a_language_together(model):
    text = "They should. Nothing there. With them. " + NL
    (got,) = model.passages([text])
    assert [p[0] for p in got] == ["en", "nl"]


def test_training_sample_is_the_same_each_time(spark):
    data = [(f"text number {i} is here", "en") for i in range(60)] + [("the hot text", "en")] * 300 + [("x" * 9000, "en"), (None, "en"), ("unknown", "und")]
    df = spark.createDataFrame(data, "text string, lang string")
    some = langid.training_rows(df, max_train_rows=100)
    assert some == langid.training_rows(df.repartition(7), max_train_rows=100) and some[0].count("the hot text") <= 1


def test_chunks_make_no_difference(model):
    texts = [EN, None, NL + DE, "x" * 5000 + " " + FR, ""] * 3
    whole = list(model.passages(texts))
    assert whole == [p for t in texts for p in model.passages([t])]


def test_wrong_labels_survive_noise_in_training():
    rnd = random.Random(1)
    texts, labels = [], []
    for lang, text in ALL.items():
        words = text.split()
        for _ in range(60):
            texts.append(" ".join(rnd.sample(words, min(len(words), 8))))
            labels.append(lang if rnd.random() < 0.85 else "en")
    trained = langid.Model.train(texts, labels)
    assert all([p[0] for p in next(iter(trained.passages([t])))] == [lang] for lang, t in ALL.items())


def test_labels(spark):
    cases = {"en_US": "en", "ENG": "en", " Dutch ": "nl", "nl-BE": "nl", "Ger": "de", "und": None, "": None, " ": None, None: None, "N/A": None, "eo": "eo", "pt-BR": "pt", "日本語": "ja"}
    df = spark.createDataFrame([(k,) for k in cases], "l string")
    assert {r.l: r.n for r in df.select("l", langid.normal_label(F.col("l")).alias("n")).collect()} == cases


def test_wrong_label_rows(spark, model):
    data = [
        ("right", EN, "en-GB", 1), ("null", EN, None, 1), ("other", EN, "nl", 1), ("esperanto", NL, "eo", 1), ("mixed", EN + "\n" + DE, "en", 1), ("short", "Yes, we do.", "fr", 1),
        ("none", None, "en", 1), ("twice", FR, "und", 1), ("twice", FR, "und", 1),
    ]
    df = spark.createDataFrame(data, "item_id string, text string, lang string, passages int")
    got = languages.wrong_labels(df, model, "text", "lang", ["item_id"])
    assert rows(got) == [("esperanto", "nl"), ("mixed", "de"), ("mixed", "en"), ("null", "en"), ("other", "en"), ("twice", "fr")]
    every = {(r.item_id, r.lang) for r in languages.languages(df, model, "text", "lang", ["item_id"]).collect()}
    assert ("right", "en") in every and ("mixed", "de") in every and not any(i in ("none", "short") for i, _ in every)
    assert languages.wrong_labels(df.limit(0), model, "text", "lang", ["item_id"]).count() == 0


# ---- 1 pairs ---------------------------------------------------------------------------------


@pytest.mark.parametrize("answer", [None, "", " ", ".", '""', "\u200b\u200b", "```text\n\n```", "<p></p>", "&nbsp;", "Rewritten text:", "Here is the block: "])
def test_empty_answers(answer):
    assert pairs.is_empty(answer)


def test_answers_that_are_not_empty():
    assert not any(map(pairs.is_empty, ("ok", "5", "Note: yes", "はい")))


@pytest.mark.parametrize("answer", ["Pay 5 EUR, now.", "  PAY  5 eur now", "```text\nPay 5 EUR, now.\n```", '"Pay 5 EUR, now!"', "Here is the text: Pay 5 EUR, now.", "<p>Pay 5 EUR,&nbsp;now.</p>"])
def test_copies(answer):
    assert pairs.is_copy("Pay 5 EUR, now.", answer)


@pytest.mark.parametrize(("prompt", "answer"), [("Pay 5 EUR, now.", "Pay 6 EUR, now."), ("Pay 5 EUR, now.", "Pay 5 EUR."), ("Pay now.", "You should pay now."), (None, "x"), ("", ""), ("Pay now.", "Now pay.")])
def test_no_copies(prompt, answer):
    assert not pairs.is_copy(prompt, answer)


@pytest.mark.parametrize(
    ("prompt", "answer", "cut"),
    [
        ("A whole sentence.", "A whole sent", True),
        ("A whole sentence.", "A whole one.", False),
        ("First. Second one.", "First.", False),
        ("Needed: a form", "Bring: a form", False),
        ("It costs 437.22 a month.", "A fee of EUR 437.", True),
        ("It costs 437 a month.", "A fee of EUR 437.", False),
        ("And so on…", "And so forth…", False),
        ("He said “yes”.", "He says “yes.”", False),
        ("A whole sentence.", "", False),
        (None, "Breaks off in the mid", True),
        ("A whole sentence.", "A whole sent...", True),
        ("A whole sentence…", "A whole one...", False),
    ],
)
def test_truncated_answers(prompt, answer, cut):
    assert pairs.is_truncated(prompt, answer) is cut


def test_bands_meet_and_shingles():
    a = "i am sorry but i cannot help with that today my friend".split()
    assert pairs.shingles(["a", "b"]) == pairs.shingles(["a", "b"]) and len(pairs.shingles(a)) == 8
    assert set(pairs.bands(pairs.shingles(a))) & set(pairs.bands(pairs.shingles(a + ["too"])))


def test_defects(spark, model):
    things = ["garden gate", "paper boat", "winter coat", "kitchen table", "yellow lamp", "stone wall"]
    data = [("k", i, f"The {t} has to be paid within {i + 3} days after it was sent to you.", "I'm sorry, but rewriting this passage is beyond me.") for i, t in enumerate(things)]
    data.append(("k", 10, "We look at it in the next days and tell you what we found.", "Sehr geehrte Damen und Herren, wir prüfen das in den nächsten Tagen und melden uns."))
    data.append(("k", 11, EN, EN.upper()))
    data.append(("k", 12, EN, EN[:40]))
    data.append(("k", 13, EN, " "))
    data.append(("k", 14, EN, "Let us have the form within ten days, so that your request can be looked at."))
    data += [("k", 20 + i, f"Needed: a {t}", f"What to bring: a {t}") for i, t in enumerate(things)]
    data += [data[0], ("k", 30, None, None), ("k", 31, None, "A whole answer to nothing at all.")]
    df = spark.createDataFrame(data, "article_id string, block_id int, p string, a string").withColumn("defect", F.lit("clash"))
    got = {(r.block_id): r.defect for r in pairs.defects(df, model, ["article_id", "block_id"], "p", "a").collect()}
    assert got == {**{i: "refusal" for i in range(6)}, 10: "wrong_language", 11: "copy", 12: "truncated", 13: "empty", 30: "empty"}
    assert pairs.defects(df.limit(0), model, ["article_id", "block_id"], "p", "a").count() == 0


def test_near_copies_of_a_refusal_are_one_cluster(spark):
    long = "i am sorry but i am not able to help with that request {}"
    data = [(long.format(w), 1000 + i, 0.1, 0.09, 9, 4) for i, w in enumerate(("today", "now", "here"))] + [("you pay # euro a month for the card", 5, 0.9, 0.1, 9, 0)] * 4
    data += [("only asks for a tax statement now", 2000 + i, 0.1, 0.0, 9, 4) for i in range(5)] + [("plain words that prompts have too", 3000 + i, 0.0, 0.1, 9, 0) for i in range(5)]
    seen = spark.createDataFrame(data, "opening string, prompt_hash long, shared double, elsewhere double, said int, novel int")
    assert {r.opening for r in pairs.refusal_openings(seen).collect()} == {d[0] for d in data[:3]}


def test_lead_ins_are_stripped_one_after_another():
    assert pairs.said("Revised text:\nNo revision was produced: I'm not able to work with it.") == "i m not able to work with it".split()
    assert pairs.said("Note: 5 EUR: ") == ["5", "eur"]


def test_refusals_that_do_not_recur(spark, model):
    nouns, verbs = ["garden gate", "paper boat", "winter coat", "kitchen table", "yellow lamp"], ["opened", "carried", "cleaned", "painted", "mended", "counted"]
    made = [f"The {n} has to be {v} within {i + j} days after it was sent to you by the team." for i, n in enumerate(nouns) for j, v in enumerate(verbs)]
    data = [("k", i, p, made[(i + 7) % len(made)]) for i, p in enumerate(made)]
    data += [("k", 50, made[0], "I cannot comply because this passage looks sensitive."), ("k", 51, made[1], "Revised text:\nNo revision was produced: I must decline to rephrase this paragraph.")]
    data += [("k", 60, made[0], "Sehr geehrte Damen und Herren, wir prüfen das in den nächsten Tagen und melden uns."), ("k", 61, made[1], "The yellow lamp was sent to you.")]
    german = ["Ihre Kontaktdaten können Sie jederzeit ändern und uns mitteilen.", "Ihre Adresse können Sie jederzeit ändern."]
    data += [("k", 70 + i, t, t.replace("Sie", "sie gern")) for i, t in enumerate(german)] + [("k", 80 + i, made[7 * i], "Ihre Kontaktdaten können Sie jederzeit") for i in range(3)]
    df = spark.createDataFrame(data, "article_id string, block_id int, p string, a string")
    got = {r.block_id: r.defect for r in pairs.defects(df, model, ["article_id", "block_id"], "p", "a").collect()}
    assert got == {50: "refusal", 51: "refusal", 60: "wrong_language", 80: "truncated", 81: "truncated", 82: "truncated"}


def test_openings_as_made_are_clustered_through_others(spark, monkeypatch):
    text = "I am sorry, but as an assistant I am not permitted to rewrite or change passages of this kind, so please ask a human {}."
    made = [pairs.opening(pairs.said(text.format(w))) for w in ("today", "today or some day", "today or some day soon enough after")]
    assert len(set(made)) == 3
    ends = [set(pairs.shingles(o.split(" "))) for o in made]
    assert len(ends[0] & ends[2]) / len(ends[0] | ends[2]) < pairs.SIMILARITY
    data = [(o, i, 0.0, 0.0, 9, 4) for i, o in enumerate(made)] + [("a thing that is said only once and is not like any other", 9, 0.0, 0.0, 9, 4)]
    seen = spark.createDataFrame(data, "opening string, prompt_hash long, shared double, elsewhere double, said int, novel int")
    assert {r.opening for r in pairs.refusal_openings(seen).collect()} == set(made)
    monkeypatch.setattr(pairs, "SIMILARITY", 1.01)  # without links none of them recurs
    assert pairs.refusal_openings(seen).count() == 0


def test_clusters_against_brute_force(spark):
    """Links of near copies of many templates, most of them in one bucket or another with others: pairs in one component."""
    rnd = random.Random(3)
    vocabulary = [f"w{i}" for i in range(60)]
    made: set[str] = set()
    for _ in range(25):
        told = rnd.choices(vocabulary, k=rnd.randint(25, 40))
        for _ in range(12):
            copy = list(told)
            for _ in range(rnd.randint(0, 3)):
                copy[rnd.choice((rnd.randrange(len(copy)), len(copy) - 1))] = rnd.choice(vocabulary)
            made.add(" ".join(copy))
    openings = sorted(made)
    sets = [set(pairs.shingles(o.split(" "))) for o in openings]
    label = list(range(len(openings)))

    def root(i):
        while label[i] != i:
            i = label[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            if len(a & sets[j]) >= pairs.SIMILARITY * len(a | sets[j]):
                label[root(i)] = root(j)
    want = {(i, j) for i in range(len(openings)) for j in range(i) if root(i) == root(j)}
    found = {r.opening: r.head for r in pairs.opening_clusters(spark.createDataFrame([(o,) for o in openings], "opening string")).collect()}
    got = {(i, j) for i in range(len(openings)) for j in range(i) if openings[i] in found and found.get(openings[i]) == found.get(openings[j])}
    assert got <= want and len(want) > 100 and len(got) >= 0.9 * len(want)


def linked_by_brute_force(sets, may_meet):
    label = list(range(len(sets)))
    for i, a in enumerate(sets):
        for j in range(i):
            if label[i] != label[j] and may_meet(i, j) and len(a & sets[j]) >= pairs.SIMILARITY * len(a | sets[j]):
                label = [label[i] if x == label[j] else x for x in label]
    return {frozenset(i for i, x in enumerate(label) if x == y) for y in set(label)}


def wandering(rnd, steps):
    """Openings that each differ from one before in a word near an end: chains, and members like several that are unlike each other."""
    vocabulary = [f"w{i}" for i in range(40)]
    made = [rnd.choices(vocabulary, k=34)]
    for _ in range(steps):
        copy = list(rnd.choice(made[-30:] + made))
        copy[rnd.choice((0, 1, 2, -3, -2, -1))] = rnd.choice(vocabulary)
        made.append(copy)
    return sorted({" ".join(m) for m in made})


@pytest.mark.parametrize("block", [50_000, 40])
def test_no_link_of_a_bucket_is_left_out(spark, monkeypatch, block):
    monkeypatch.setattr(pairs, "BLOCK", block)
    openings = wandering(random.Random(8), 700)
    sets = [set(pairs.shingles(o.split(" "))) for o in openings]
    keys = [set(pairs.bands(sorted(s))) for s in sets]
    want = {c for c in linked_by_brute_force(sets, lambda i, j: keys[i] & keys[j]) if len(c) > 1}
    found: dict = {}
    for r in pairs.opening_clusters(spark.createDataFrame([(o,) for o in openings], "opening string")).collect():
        found.setdefault(r.head, set()).add(openings.index(r.opening))
    assert {frozenset(c) for c in found.values()} == want and max(map(len, want)) > pairs.FEW


@pytest.mark.parametrize(("few", "plain"), [(1000, 1000), (0, 1000), (0, 0)])
def test_links_of_a_bucket_in_each_way(monkeypatch, few, plain):
    monkeypatch.setattr(pairs, "FEW", few)
    monkeypatch.setattr(pairs, "PLAIN", plain)
    openings = [*wandering(random.Random(5), 250), *wandering(random.Random(6), 250), "a word", "a b c d e f"]
    held = [np.array(pairs.shingles(o.split(" ")), np.uint32).tobytes() for o in openings]
    heads = pairs.linked(held, pairs.SIMILARITY)
    sets = [set(pairs.shingles(o.split(" "))) for o in openings]
    assert {frozenset(i for i, h in enumerate(heads) if h == x) for x in heads} == linked_by_brute_force(sets, lambda i, j: True)
    assert pairs.linked(held[:1], pairs.SIMILARITY) == [0] and pairs.linked([], pairs.SIMILARITY) == []


def test_components_of_chains_take_few_rounds(spark, monkeypatch):
    rounds = []
    monkeypatch.setattr(pairs, "cut", lambda df: rounds.append(1) or cut(df))
    ids = random.Random(2).sample(range(1000), 1000)
    links = [(i, i + 1) for i in range(300)] + list(zip(ids[:400:2], ids[1:400:2])) + [(7, 7)]
    label = {x: x for x in range(1000)}
    for a, b in links:
        label = {k: min(label[a], label[b]) if v in (label[a], label[b]) else v for k, v in label.items()}
    got = {r.id: r.head for r in pairs.components(spark.createDataFrame(links, "id long, head long")).collect()}
    assert got == {x: label[x] for x in {x for a, b in links if a != b for x in (a, b)}} and len(rounds) < 15
    assert pairs.components(spark.createDataFrame([], "id long, head long")).count() == 0


def test_two_unrelated_prompts_make_a_refusal(spark):
    data = [("i must decline to rephrase this", i, 0.0, 0.0, 9, 4) for i in range(2)] + [("only said once", 7, 0.0, 0.0, 9, 4)]
    seen = spark.createDataFrame(data, "opening string, prompt_hash long, shared double, elsewhere double, said int, novel int")
    assert [r.opening for r in pairs.refusal_openings(seen).collect()] == ["i must decline to rephrase this"]


def test_answers_without_content_words_recur(spark, model):
    """Nothing can be divided by the number of their content words; that they break off alike makes them no refusals."""
    data = [("k", 1, "Yes no.", "Ask us for it."), ("k", 2, "Why?", "Ask us for it."), ("k", 3, EN, EN)]
    data += [("k", 4, "The card is sent to your branch.", "Let us kno"), ("k", 5, "Fees are charged at the end of the year.", "Let us kno")]
    df = spark.createDataFrame(data, "article_id string, block_id int, p string, a string")
    got = {r.block_id: r.defect for r in pairs.defects(df, model, ["article_id", "block_id"], "p", "a").collect()}
    assert got == {1: "refusal", 2: "refusal", 3: "copy", 4: "truncated", 5: "truncated"}


# ---- 2 reading level -------------------------------------------------------------------------


def test_levels(spark, model):
    rnd = random.Random(2)
    basic = "you pay the fee and we send the card now to get it call us at once today".split()
    middle = "the interest rate of your account follows the market after the first period has ended".split()
    hard = "notwithstanding the aforementioned stipulations remuneration accrues contemporaneously with substantive adjudication".split()
    text = {"basic": basic, "intermediate": middle + basic, "advanced": hard + middle[:3]}
    data, labels = [], []
    for i in range(60):
        level = ("basic", "intermediate", "advanced")[i % 3]
        for b in range(4):
            words = [rnd.choice(text[level]) for _ in range(30)]
            data += [(f"a{i}", "original", b, " ".join(words[:15]) + ". " + " ".join(words[15:]) + ".")] * rnd.choice([1, 1, 2])
        if i < 40:
            labels.append((f"a{i}", "original", level))
    data += [("nl", "original", 0, NL * 3), ("null", "original", 0, None), ("empty", "original", 0, "")]
    df = spark.createDataFrame(data, "article_id string, side string, block_id int, text string").withColumn("words", F.lit("clash"))
    known = spark.createDataFrame(labels, "article_id string, side string, reading_level string")
    run = lambda d, k: readability.levels(d, k, model, ["article_id", "side"], ["block_id"], "text", "reading_level", ["article_id"])
    got = {r.article_id: r.reading_level for r in run(df, known).collect()}
    assert set(got) == {f"a{i}" for i in range(60)}
    assert {i for i in range(60) if got[f"a{i}"] == "advanced"} == {i for i in range(60) if i % 3 == 2}
    assert {r.reading_level for r in run(df, known.limit(0)).collect()} == {None}
    assert run(df.limit(0), known).count() == 0


def test_words_are_counted_once_for_each_item(spark, model):
    rnd = random.Random(6)
    pool = EN.lower().replace(".", "").split()
    data = [(d, i, " ".join(pool + rnd.choices(pool, k=4)) + ".") for d, n in (("hot", 500), ("a", 3), ("b", 40), ("c", 1)) for i in range(n)]
    twice = data + rnd.sample(data, 200)
    rnd.shuffle(twice)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "64")
    try:
        df = spark.createDataFrame(twice, "d string, i int, text string").repartition(3)
        got = {r.d: (dict(zip(r.words, r.counts)), r.tokens, r.sentences) for r in readability.counted_words(df, model, ["d"], ["i"], "text").collect()}
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "10000")
    for d in ("hot", "a", "b", "c"):
        words = [w for e, _, t in data if e == d for w in t[:-1].split()]
        assert got[d] == ({w: words.count(w) for w in set(words)}, len(words), len(words) // (len(pool) + 4))


def test_coverage_is_the_smallest_vocabulary(spark):
    rnd = random.Random(4)
    ranked = spark.createDataFrame([(f"w{i}", i + 1, 20 - i) for i in range(20)], "word string, plain_rank int, basic_rank int")
    data = [(d, [f"w{i}" for i in rnd.sample(range(26), 9)], [rnd.randint(1, 9) for _ in range(9)]) for d in range(8)] + [(9, [], [])]
    got = {r.d: (r.plain_coverage, r.basic_coverage) for r in readability.coverage(spark.createDataFrame(data, "d int, words array<string>, counts array<long>"), ranked, ["d"]).collect()}
    assert set(got) == set(range(8))
    for d, words, counts in data[:-1]:
        for k, rank in enumerate((lambda i: i + 1 if i < 20 else 21, lambda i: 20 - i if i < 20 else 21)):
            upto = 0
            for r, n in sorted((rank(int(w[1:])), n) for w, n in zip(words, counts)):
                upto += n
                if upto >= readability.COVERED * sum(counts):
                    assert got[d][k] == pytest.approx(r / 21)
                    break


# ---- 3 markup --------------------------------------------------------------------------------


def test_trees_know_their_table_and_what_it_tells_of_others():
    assert [(s, markup.residue(s)) for s, _ in markup.LABELLED] == [(s, [k] if k else []) for s, k in markup.LABELLED]
    used = set().union(*(t.used() for t in markup.trees().values()))
    assert {"link_density", "words", "words_behind", "lines"} <= used
    whole = markup.held_out_accuracy()
    assert whole > 0.85
    assert markup.held_out_accuracy(markup.SURROUNDINGS) < whole - 0.05
    assert markup.held_out_accuracy(("link_density", "links_before", "links_behind")) < whole - 0.02


@pytest.mark.parametrize(
    ("value", "clean"),
    [
        (r"<p>The **rate** of [[Fees]] is $x = a \cdot b$.</p>", [("text", r"The rate of Fees is $x = a \cdot b$.")]),
        ("<p>Set **mode** with <code>**x**</code> now.</p>", [("text", "Set mode with **x** now.")]),
        ("<p>&lt;b&gt;Use&lt;/b&gt; <code>&lt;i&gt;</code> here.</p>", [("text", "Use <i> here.")]),
        ("<p>" + "&" + "amp;" * 6 + "lt;b" + "&" + "amp;" * 6 + "gt;deep" + "&" + "amp;" * 6 + "lt;/b" + "&" + "amp;" * 6 + "gt;</p>", [("text", "deep")]),
        ("<p>a \ufffc b <code>**y**</code> **c**</p>", [("text", "a \ufffc b **y** c")]),
        ("<ul><li>**a** <code>_b_</code></li><li><code>c</code></li></ul>", [("item", "a _b_"), ("code", "c")]),
    ],
)
def test_several_kinds_and_code_in_a_block(value, clean):
    assert markup.clean(value) == clean


def test_bullets_in_menus_and_signs_over_columns_are_no_markup():
    menu = "<p>* <a href='a'>Start here</a><br>* <a href='b'>Our prices</a></p>"
    assert markup.residue(menu) == [] and markup.residue(re.sub("<a[^>]*>|</a>", "", menu)) == ["markdown"]
    assert markup.residue("<table><tr><td># Loans</td><td>7</td></tr></table>") == [] and markup.residue("# Loans of all kinds, old and new") == ["markdown"]


@pytest.mark.parametrize(
    ("value", "kinds"),
    [
        (None, []), ("", []), ("  ", []), ("<!-- **x** -->", []), ("<p>A **bold** word and {{Tag|x}}</p>", ["markdown", "wiki"]),
        ("<pre>## no</pre><p>fine</p>", []), ("<p>a <code>[[x]]</code> b</p>", []), ("<script>var x = '**y**'</script><p>z</p>", []),
        ("<p>&amp;lt;b&amp;gt;x&amp;lt;/b&amp;gt;</p><p>$x^2$</p>", ["latex", "escaped_html"]), ("<p>unclosed **bold**", ["markdown"]),
    ],
)
def test_residue(value, kinds):
    assert markup.residue(value) == kinds


def test_clean_text_keeps_structure():
    value = (
        "<h1>Title</h1><p>A **bold** [link](x) here.</p><ul><li>item</li></ul><pre>code  here\n  x</pre>## Sub\n\n```\nselect 1\n```\n<p>\\[ a + b \\]</p>"
        "<p>&lt;ul&gt;&lt;li&gt;inner&lt;/li&gt;&lt;/ul&gt;</p><p>[[Page|shown]] '''x'''</p>"
    )
    assert markup.clean(value) == [
        ("heading1", "Title"), ("text", "A bold link here."), ("item", "item"), ("code", "code  here\n  x"), ("heading2", "Sub"), ("code", "select 1"), ("formula", "a + b"), ("item", "inner"), ("text", "shown x"),
    ]
    assert markup.rendered(markup.clean(value)).startswith("# Title\nA bold link here.\n- item\n    code  here\n      x\n## Sub")
    assert markup.clean(None) == markup.clean("") == []


def test_clean_text_has_no_residue_left():
    for source, kind in markup.LABELLED:
        if kind:
            left = "".join(f"<p>{t}</p>" for k, t in markup.clean(source) if k not in ("code", "formula"))
            assert kind not in markup.residue(left) or "$" in source or "\\(" in source, (source, left)


def test_residues(spark):
    df = spark.createDataFrame([("a", "**x**", None), ("a", "**x**", None), ("b", "<p>ok</p>", "{{T}}"), ("c", None, "")], "k string, f string, g string").withColumn("markup", F.lit(1))
    assert rows(markup.residues(df, ["f", "g"], ["k"])) == [("f", "a", "markdown"), ("g", "b", "wiki")]
    got = {r.k: (r.kinds, r.clean_text) for r in markup.with_clean_text(df, "f", ["k"]).collect()}
    assert got["a"] == (["markdown"], "x") and got["c"] == ([], None)
    assert markup.residues(df.limit(0), ["f"], ["k"]).count() == 0


# ---- 4 splitting -----------------------------------------------------------------------------


@settings(max_examples=150, deadline=None)
@given(st.text(alphabet="ab. \n<p/>&;é🏦", max_size=400), st.integers(20, 90), st.integers(0, 15), st.booleans())
def test_pieces_are_the_text(text, limit, overlap, html):
    found = splitting.pieces(text, limit, overlap, html)
    assert all(0 < b - a <= limit for a, b, _ in found)
    assert all(x[1] - y[0] == overlap for x, y in zip(found, found[1:]))
    assert "".join(text[a:b] if i == 0 else text[a + overlap : b] for i, (a, b, _) in enumerate(found)) == text


def test_cuts_at_the_change_of_topic():
    a = "The ship left the harbour and the sailors sang on the deck of the ship. " * 6
    b = "A bread needs flour and water, and the baker bakes the bread in the oven. " * 6
    text = a + b
    found = splitting.pieces(text, 700, 50)
    assert found[0][2] == "topic" and abs(found[0][1] - len(a)) <= 2
    assert splitting.pieces("x" * 100, 100, 10) == [(0, 100, "end")] and splitting.pieces(None, 10, 1) == []
    with pytest.raises(ValueError):
        splitting.pieces("x", 5, 5)


def test_html_is_not_cut_inside_a_tag():
    text = "<p>" + "word " * 10 + "</p>" + "<a href='" + "x" * 30 + "'>y</a>" * 1 + "<p>" + "more " * 40 + "</p>"
    for limit in range(60, 120, 7):
        for _, b, _ in splitting.pieces(text, limit, 10, html=True)[:-1]:
            assert text[:b].count("<") == text[:b].count(">")


def test_split_items(spark):
    long = "One sentence of a text. " * 30
    df = spark.createDataFrame([("a", long), ("a", long), ("b", "x" * 100), ("c", None), ("d", "🏦" * 101)], "k string, t string").withColumn("piece", F.lit(9))
    got = splitting.split_items(df, "t", ["k"], 100, 20)
    assert {r.k for r in got.collect()} == {"a", "d"} and got.where("k = 'd'").count() == 2
    assert splitting.split_items(df.limit(0), "t", ["k"], 100, 20).count() == 0


def test_units_at_once_make_no_difference(monkeypatch):
    rnd = random.Random(5)
    text = " ".join(rnd.choice(ALL[k].split()) + rnd.choice(["", "", "."]) for k in rnd.choices("en nl de".split(), k=4000))
    cuts = splitting.possible_cuts(text, False)
    whole = splitting.similarities(text, cuts)
    for n in (1, 7, 100):
        monkeypatch.setattr(splitting, "UNITS_AT_ONCE", n)
        assert splitting.similarities(text, cuts) == pytest.approx(whole, abs=1e-9)


def test_a_very_long_item_takes_little_memory():
    text = (EN + " " + NL + " " + DE + "\n") * 40_000  # about 10 million characters
    tracemalloc.start()
    found = splitting.pieces(text, 12_000, 200, html=True)
    _, peak = tracemalloc.get_traced_memory()
    tracemalloc.stop()
    assert found[-1][1] == len(text) and peak < 12 * len(text)


# ---- 6 truncation ----------------------------------------------------------------------------


def test_cut_values(spark):
    data = [
        ("whole", "The card is sent to you within five days after the form came in.", "The form came in, and the card is sent within five days."),
        ("word", "The form came in, and the card is sent within 7 days.", "The form came in, and the card is sent wit"),
        ("edge", "The form came in, and the card is sent within 7 days.", "The card is sent to you within"),
        ("item", "Needed: a form", "Bring: a form"),
        ("shorter", "First the form. Then the card is sent.", "First the form."),
        ("number", "You pay 437.22 a month.", "A monthly fee of EUR 437."),
        ("kept", "Title of the page goes on", "Title of the page goe"),
        ("null", "x", None), ("empty", "x.", ""), ("tags", "x y.", "<p></p>"), ("dots", "This also holds for cards and so on…", "This also holds for cards and so on…"),
        ("full", "A text of the full length that ends. Ref. XYZ.", "A text of the full length that ends. Ref. XYZ."),
        ("marked", "The card is sent to you within five days.", "Well. The card is sent to y..."), ("unproven", "Something else is here.", "Never seen elsewhe"),
    ]
    df = spark.createDataFrame([*data, data[1]], "k string, o string, r string").withColumn("string", F.lit(0))
    got = truncation.cut_values(df, [(df, ["o", "r"])], ["k"], "r", "o")
    assert rows(got) == [("edge",), ("kept",), ("marked",), ("number",), ("word",)]
    share = truncation.shares(df.withColumn("s", F.when(F.col("k") == "word", F.lit(None)).otherwise("x")), got, ["k"], "r", "s")
    assert {r.s: (r["items"], r.cut) for r in share.collect()} == {None: (1, 1), "x": (12, 4)}
    assert truncation.cut_values(df.limit(0), [(df.limit(0), ["o"])], ["k"], "r", "o").count() == 0


def test_strict_prefixes_by_brute_force(spark):
    rnd = random.Random(7)
    texts = ["".join(rnd.choice("ab ") for _ in range(rnd.randint(1, 40))).strip() + rnd.choice(["", ".", "!", ". b", ". ab"]) for _ in range(400)]
    df = spark.createDataFrame([(i, t, None) for i, t in enumerate(texts)], "k int, r string, o string")
    got = {r.k for r in truncation.cut_values(df, [(df, ["r"])], ["k"], "r", "o").collect()}
    copies = {c for t in texts for c in truncation.copies_of(t)}
    open_end = {i: t for i, t in enumerate(texts) if t.rstrip(truncation.BEHIND)[-1:] not in truncation.CLOSING and re.search(r"\w", t)}
    every = copies | {a for t in texts for a in truncation.asked_of(t, False)}
    assert got == {i for i, t in open_end.items() if any(c.startswith(a) and len(c) > len(a) for a in truncation.asked_of(t, False) for c in every)}


def test_sorted_successors_across_partitions(spark):
    """Strings that all begin alike, in more partitions than one, and some asked for at the ends of partitions."""
    rnd = random.Random(11)
    have = ["the rate " + "".join(rnd.choice("abc") for _ in range(rnd.randint(0, 6))) for _ in range(2000)]
    asked = rnd.sample(have, 300) + ["the r", "the rate z", "zz"]
    a, b = (spark.createDataFrame([(x,) for x in xs], "string string") for xs in (have, asked))
    for parts in ("1", "7", "64"):
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
        spark.conf.set("spark.sql.shuffle.partitions", parts)
        try:
            got = {r.string for r in truncation.going_on(a, b).collect()}
        finally:
            spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
            spark.conf.set("spark.sql.shuffle.partitions", "8")
        assert got == {x for x in asked if any(h.startswith(x) and h != x for h in [*have, *asked])}


def test_the_join_rejects_open_ends_without_a_longer_copy(spark):
    """The punctuation alone would take all of them."""
    data = [(i, f"A sentence about matter {w} that is complete.", f"A closing word that nobody wrote {w}") for i, w in enumerate(("oak", "elm", "ash"))]
    df = spark.createDataFrame([*data, (9, "A sentence about matter oak that is complete.", "A sentence about matter oak that is com")], "k int, o string, r string")
    assert rows(truncation.cut_values(df, [(df, ["o", "r"])], ["k"], "r", "o")) == [(9,)]


def test_dots_on_both_sides_are_how_a_text_ends(spark):
    """Marks that a copy has behind its dots prove nothing, and neither does a copy that goes on, if both sides end alike."""
    whole = "This also holds for transfers, standing orders and so on"
    data = [
        ("kept", f"You pay 5 EUR. {whole}…", f"It costs 5 EUR. {whole}…"), ("equal", f"{whole}…", f"{whole}..."), ("wrapped", f"{whole}…", f"\"{whole.upper()}…\"\n"),
        ("marks", "Other words.", f"{whole}…!"), ("cut", f"You pay 5 EUR. {whole}…", "It costs 5 EUR. This also holds for transfers, stand..."),
    ]
    df = spark.createDataFrame(data, "k string, o string, r string")
    assert rows(truncation.cut_values(df, [(df, ["o", "r"])], ["k"], "r", "o")) == [("cut",)]
    assert truncation.sentences(f"{whole}…!") == truncation.sentences(f"{whole}...") == [whole.lower()] and truncation.sentences("Who?... …!") == ["who?"]
    longer = spark.createDataFrame([(f"{whole} and so forth.",)], "o string")
    assert rows(truncation.cut_values(df, [(df, ["o", "r"]), (longer, ["o"])], ["k"], "r", "o")) == [("cut",)]


# ---- 7 encoding ------------------------------------------------------------------------------


@pytest.fixture(scope="module")
def vocabulary():
    return encoding.ranks()


@pytest.fixture(scope="module")
def exact(vocabulary):
    tiktoken = pytest.importorskip("tiktoken")
    return tiktoken.Encoding("own", pat_str=encoding.PATTERN, mergeable_ranks=vocabulary, special_tokens={}).encode_ordinary


@settings(max_examples=300, deadline=None)
@given(st.text(max_size=60))
def test_ids_are_the_tokenizers(vocabulary, exact, text):
    assert encoding.Encoder(None, vocabulary).encode([text])[1].tolist() == exact(text)


def test_lexicon_numbers_are_a_perfect_order(vocabulary, tmp_path):
    rnd = random.Random(9)
    words = {bytes(rnd.choice(b"abc") for _ in range(rnd.randint(1, 9))) for _ in range(2000)} | {b" the", " é".encode()}
    lexicon = encoding.Lexicon.compile(words, vocabulary)
    lexicon.save(str(tmp_path / "l.bin"))
    loaded = encoding.Lexicon.load(str(tmp_path / "l.bin"))
    ordered = sorted(words)
    assert loaded.numbers(ordered).tolist() == list(range(len(ordered)))
    assert loaded.numbers([b"", b"abcabcabcabc", b"zz", b"ab\0"]).tolist() == [-1] * 4 or b"" in words
    assert len(loaded.keys) < sum(map(len, words))
    for i in range(0, len(ordered), 97):
        assert loaded.ids[loaded.offsets[i] : loaded.offsets[i + 1]].tolist() == encoding.merge(ordered[i], vocabulary)
    assert encoding.Lexicon.compile([], vocabulary).numbers([b"x"]).tolist() == [-1]


def test_long_words(vocabulary, exact):
    for text in ("🏦" * 3000, "a" * 4000, "ab" * 2000, " " * 3000, "x" * 100 + "\n" * 50):
        assert encoding.Encoder(None, vocabulary).encode([text])[1].tolist() == exact(text)


def test_token_ids(spark, exact):
    texts = ["The fee is due. The fee is due.", "", None, " ", "<|endoftext|>", "Gebühr 5 €", "The fee is due. The fee is due.", "x" * 3000]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string").withColumn("ids", F.lit("clash"))
    got = {r.doc_id: list(r.ids) for r in encoding.token_ids(df, "doc_id", "text", lexicon_size=3).collect()}
    assert got == {i: exact(t) if t else [] for i, t in enumerate(texts)}
    assert encoding.token_ids(df.limit(0), "doc_id", "text").count() == 0


# ---- 8 leakage -------------------------------------------------------------------------------

WORDS = [a + b for a in ("kar", "mol", "pex", "sun", "tri", "vol", "wan", "zel") for b in ("ade", "ing", "ost", "uri", "eck", "oma", "ist")]


def brute(index_texts, text):
    flat = leakage.squeezed([text])[0]
    found = set()
    for i, t in index_texts.items():
        words = leakage.item_words(t or "")
        if any("".join(words[a : a + 10]) in flat for a in range(len(words) - 9)):
            found.add(i)
    return found


def test_search_is_brute_force():
    rnd = random.Random(11)
    items = {i: " ".join(rnd.choice(WORDS) for _ in range(rnd.randint(8, 40))) for i in range(30)}
    items[99] = items[3]
    texts = []
    for _ in range(300):
        words = [rnd.choice(WORDS) for _ in range(rnd.randint(0, 60))]
        own = items[rnd.randrange(30)].split()
        a = rnd.randrange(len(own))
        part = own[a : a + rnd.randint(5, 20)]
        if rnd.random() < 0.3 and len(part) > 3:
            part[rnd.randrange(len(part))] = "other"
        at = rnd.randint(0, len(words))
        text = " ".join(words[:at] + part + words[at:])
        texts.append(rnd.choice([text, text.upper(), text.replace(" ", ",\u00a0"), text.replace("a", "а"), text.replace(" ", "")]))
    texts += [None, "", " ", items[0] * 30]
    index = leakage.Index.build(list(items), list(items.values()))
    got = [{index.ids[i] for i, *_ in found} for found in leakage.search(index, texts)]
    assert got == [brute(items, t) for t in texts]


def test_leaks(spark):
    item = " ".join(WORDS[:25])
    docs = spark.createDataFrame([(1, "x " + " ".join(WORDS[3:14]) + " y"), (2, " ".join(WORDS[3:12])), (3, None), (4, ""), (1, "x " + " ".join(WORDS[3:14]) + " y")], "doc_id long, text string").withColumn("words", F.lit(0))
    items = spark.createDataFrame([(7, item), (8, "too few words"), (9, None), (10, item)], "item_id long, text string")
    for block in (10, leakage.BLOCK_CHARS):
        got = leakage.leaks(docs, items, "doc_id", "item_id", block_chars=block)
        assert rows(got, "doc_id", "item_id", "words") == [(1, 7, 11), (1, 10, 11)]
    assert leakage.leaks(docs.limit(0), items, "doc_id", "item_id").count() == leakage.leaks(docs, items.limit(0), "doc_id", "item_id").count() == 0


def test_qgram_bound_keeps_passages_with_edits():
    words = WORDS[:14]
    index = leakage.Index.build([1], [" ".join(words)])
    flat = leakage.squeezed([" ".join(words)])[0]
    edited = flat[:30] + "q" + flat[31:60] + flat[61:]
    assert leakage.regions(index, index.bloom(), [edited], leakage.EDITS)


def test_a_longer_stretch_does_not_hide_a_whole_one():
    rnd = random.Random(2)
    letters = lambda n: "".join(rnd.choice("qxzjvwk") for _ in range(n))
    nine = [letters(20) for _ in range(9)]
    ten = [letters(4) for _ in range(10)]
    between = [letters(12) for _ in range(20)]
    item = " ".join(nine + between + ten)
    index = leakage.Index.build([1], [item])
    hidden = " ".join(nine + [letters(12) for _ in range(20)] + ten)
    assert [f[:2] for f in leakage.search(index, [hidden])[0]] == [(0, 10)]
    assert leakage.search(index, [" ".join(nine)]) == [[]]


def test_random_gaps_by_brute_force():
    """Documents of an item's runs of words with other letters, fewer or more, between them."""
    rnd = random.Random(23)
    items = {i: " ".join(rnd.choice(WORDS) for _ in range(rnd.randint(15, 60))) for i in range(12)}
    texts = []
    for _ in range(250):
        words, out, at = items[rnd.randrange(12)].split(), [], 0
        while at < len(words):
            n = rnd.choice((1, 3, 8, 9, 10, 11))
            out += words[at : at + n]
            gap = rnd.choice((0, 1, 2, 4))
            out += [rnd.choice(WORDS)[: rnd.randint(1, 5)] for _ in range(rnd.choice((gap, gap, 1)))]
            at += n + gap
        texts.append(" ".join(out))
    index = leakage.Index.build(list(items), list(items.values()))
    assert [{index.ids[i] for i, *_ in found} for found in leakage.search(index, texts)] == [brute(items, t) for t in texts]


def test_common_qgrams_are_counted_in_slices(monkeypatch):
    items = {i: " ".join(WORDS[:12]) + f" end{i}" for i in range(20)}
    texts = [" ".join(WORDS[:12]) * 3, " ".join(WORDS[20:40]), " ".join(WORDS[1:11])]
    index = leakage.Index.build(list(items), list(items.values()))
    want = leakage.search(index, texts)
    monkeypatch.setattr(leakage, "SLICE_PAIRS", 50)
    assert leakage.search(index, texts) == want and [len(w) for w in want] == [20, 0, 20]


# ---- 9 look-alikes ---------------------------------------------------------------------------


@settings(max_examples=400, deadline=None)
@given(st.text(alphabet="aeonc\u0301\u0308\u0327\u0323éüçạ 각각\u200b\u00a0ﬁｅ²①½", max_size=20))
def test_forms_are_canonical_and_idempotent(text):
    (form,) = lookalike.normal_forms([text])
    plain = text.replace("\u200b", "").replace("\u00a0", " ").replace("ﬁ", "fi").replace("ｅ", "e")
    assert form == unicodedata.normalize("NFC", plain)
    assert lookalike.normal_forms([form]) == [form]


@pytest.mark.parametrize(("a", "same"), [("раy", "pay"), ("Ｐａｙ１", "Pay1"), ("ﬃ", "ffi"), ("e\u0301", "é"), ("a\u00adb\ufeffc", "abc"), ("x\u2009y", "x y"), ("Κ\u212a", "KK"), ("\u0430\u0301", "á"), ("①", "①"), ("m²", "m²"), ("a  b", "a  b"), ("", ""), ("pay\U000e0041", "pay"), ("pay\U000e0101", "pay"), ("\U0002f800", "\u4e3d"), ("ᏟᏞ", "CL"), ("ⲤⲞ", "CO"), ("\U0001d429\U0001d41a\U0001d432", "pay"), ("\U0001d7d7", "9"), ("\U00020000\U0010fffd🏦", "\U00020000\U0010fffd🏦")])
def test_forms(a, same):
    assert lookalike.normal_forms([a, None]) == [same, None]


def test_forms_by_exploded_rows(spark):
    rnd = random.Random(17)
    letters = list("aeonc éüçạ\u200b\u00a0ﬁｅ²①½а") + ["\u0301", "\u0308", "\u0327", "\u0323", "\U0001d41a", "\U000e0041"]
    texts = ["".join(rnd.choices(letters, k=rnd.randint(0, 30))) for _ in range(150)] + [None, "", "\u200b", "Pay now"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string")
    got = {r.doc_id: r.form for r in lookalike.exploded_forms(df, "doc_id", "text").collect()}
    assert got == dict(enumerate(lookalike.normal_forms(texts)))


def test_lookalike_pairs_against_brute_force(spark):
    rnd = random.Random(13)
    base = ["pay now", "Pay now", "pay  now", "", "x²", "x2", "\u200b", "é"]
    vary = lambda t: "".join(rnd.choice([c, {"a": "а", "o": "ｏ", " ": "\u00a0", "é": "e\u0301"}.get(c, c + "\u200b")]) for c in t)
    data = [(i, rnd.choice([None, *base, *[vary(b) for b in base]])) for i in range(120)]
    df = spark.createDataFrame(data, "doc_id long, text string").withColumn("class", F.lit(1))
    forms = {i: lookalike.normal_forms([t])[0] for i, t in data}
    want = sorted((i, j) for i, a in data for j, b in data if i < j and a is not None and b is not None and a != b and forms[i] == forms[j] and forms[i].strip())
    assert rows(lookalike.lookalike_pairs(df, "doc_id", "text")) == want
    assert lookalike.lookalike_pairs(df.limit(0), "doc_id", "text").count() == 0
    assert {r.doc_id: r.form for r in lookalike.with_form(df, "text", ["doc_id"]).collect()} == forms


# ---- the queries -----------------------------------------------------------------------------

COLUMNS = {
    "p1_found": ["article_id", "block_id", "defect"], "p2_found": ["article_id", "side"], "p3_found": ["field", "article_id", "prompt_version", "markup"], "p4_found": ["item_table", "item_id"],
    "p5_found": ["item_table", "item_id", "lang"], "p6_found": ["item_table", "item_id"], "p7_ids": ["doc_id", "ids"], "p8_found": ["doc_id", "item_id"], "p9_found": ["doc_id_a", "doc_id_b"],
}


@pytest.mark.parametrize("name", list(queries.queries()))
def test_query(spark, name):
    df = queries.queries()[name](spark, DATA)
    found = df.collect()
    if name in COLUMNS:
        assert df.columns == COLUMNS[name]
        assert name == "p7_ids" or len(found) == len(set(found))
    if name in queries.oracle_sql():
        con = duckdb.connect()
        for t in ("enriched_articles", "block_audit"):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{DATA}/{t}.parquet'")
        assert sorted(map(tuple, found)) == sorted(con.execute(queries.oracle_sql()[name]).fetchall())
