"""Problem 1: broken prompt and response pairs.

Each pair is looked at once, in Arrow batches: an answer without a word is empty, one with exactly
the words of its prompt a copy, one that ends without a closing mark though its prompt doesn't is
truncated, and one in a language the prompt isn't in is in the wrong language. Refusals are found
across pairs: the openings of the answers (their first words after a lead-in, numbers masked) are
clustered by MinHash, each candidate verified by the Jaccard similarity of its word shingles, links
joined to connected components, and a
cluster that recurs across unrelated prompts is a refusal: it has hardly a content word of the
prompts it answers, and hardly more of them than of prompts that it doesn't. An answer whose opening
doesn't recur is decided alone: it is a refusal if it has hardly a word of its prompt and far more
words that the prompts of the table hardly have than ordinary answers in its language do.

Openings are counted before they are clustered, members of a bucket that are linked through others
aren't compared, and nothing is gathered on the driver but the words that more than a fixed
share of the prompts have, which are of a bounded number.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from palimpsest.llm import langid
from palimpsest.llm.truncation import BEHIND, CLOSING, ends_in_dots, number_goes_on
from palimpsest.session import cut, stored

OPENING_WORDS = 40
SHINGLE_WORDS = 5
SIMILARITY = 0.8
BANDS, ROWS = 16, 4
#: Openings of a bucket that are held at once are at most two blocks of so many. Up to so many are held each against all
#: others that they aren't linked with; so few, one by one.
BLOCK, PLAIN, FEW = 50_000, 2_000, 16
#: A refusal recurs across so many prompts with different openings and shares at most so much with them, or a little
#: more if that is hardly more than what it shares with prompts that it doesn't answer.
MIN_PROMPTS = 2
MAX_SHARED = 0.08
MAX_SHARED_BY_CHANCE, MAX_EXCESS = 0.12, 0.04
#: At least so large a share of its content words isn't common in prompts: ordinary sentences that answers share have few.
MIN_CLUSTER_NOVEL = 0.05
#: A word is common if more than this share of the prompts has it; at most so many, the most frequent first, are sent.
COMMON_SHARE, MAX_COMMON = 0.0005, 50_000
#: An answer alone is a refusal if this share of its content words is not common, and the chance of so many, by the
#: share among ordinary answers in its language, is at most exp(-MIN_SURPRISE) (Chernoff's bound).
MIN_NOVEL, MIN_SURPRISE = 0.15, 2.0
#: An opening that shares more than this with its prompts is left out before clustering.
MAX_CANDIDATE_SHARED = 0.4
#: Both sides' languages must be this sure for an answer to be in the wrong one.
MIN_CONFIDENCE = 0.6
MAX_LEAD_IN_WORDS = 8

_FENCE = re.compile(r"^\s*```\w*[ \t]*\n?|\n?\s*```\s*$")
_MARKUP = re.compile(r"<[^>]*>|&#?\w+;|```\w*")
_LEAD_IN = re.compile(r"^\s*[^\n:.!?]{1,40}:\s+")
_WORD = re.compile(r"\w+")
_MASK = re.compile(r"\d+")


def words(text: str) -> list[str]:
    return _WORD.findall(text.casefold())


def bare_answer(text: str) -> str:
    """The answer without a code fence around it."""
    return _FENCE.sub("", text)


def is_empty(text: str | None) -> bool:
    """Whether no word is left of an answer, or only a lead-in."""
    if text is None:
        return True
    left = _MARKUP.sub(" ", text)
    return not _WORD.search(left) or (bool(_LEAD_IN.match(left + " ")) and not _WORD.search(_LEAD_IN.sub("", left + " ", count=1)))


def is_copy(prompt: str | None, answer: str) -> bool:
    """Whether the answer has all words of the prompt in order and nothing else but tags, a fence, or a lead-in that ends
    with a colon."""
    asked = words(_MARKUP.sub(" ", prompt or ""))
    if not asked:
        return False
    answer = _MARKUP.sub(" ", bare_answer(answer))
    given = words(answer)
    extra = len(given) - len(asked)
    if extra < 0 or extra > MAX_LEAD_IN_WORDS or given[extra:] != asked:
        return False
    if not extra:
        return True
    at = [m.end() for _, m in zip(range(extra), _WORD.finditer(answer.casefold()))][-1]
    return answer[at:].lstrip()[:1] == ":"


def is_truncated(prompt: str | None, answer: str) -> bool:
    """Whether the answer breaks off: no closing mark though the prompt has one or goes on, dots that the prompt doesn't
    end with, or its last number goes on."""
    end = answer.rstrip(BEHIND)
    if not end:
        return False
    if ends_in_dots(end):
        return bool(prompt) and not ends_in_dots(prompt)
    if end[-1] in CLOSING:
        return number_goes_on(answer, prompt)
    own = (prompt or "").rstrip(BEHIND)
    by_nature = bool(own) and own[-1] not in CLOSING
    return not by_nature or (own.startswith(end) and len(own) > len(end))


def said(text: str) -> list[str]:
    """The words of an answer after its lead-ins, as long as a word is left."""
    left = bare_answer(text)
    while (shorter := _LEAD_IN.sub("", left, count=1)) != left and _WORD.search(shorter):
        left = shorter
    return words(left)


def opening(told: list[str], most: int = OPENING_WORDS) -> str:
    """The first words, with digits masked."""
    return _MASK.sub("#", " ".join(told[:most]))


def content(told: list[str]) -> set[str]:
    """Content words: numbers and words of more than three letters."""
    return {w for w in told if len(w) > 3 or w.isdigit()}


def shared(some: set[str], asked: set[str]) -> float:
    """Share of an answer's content words that a prompt has."""
    return len(some & asked) / max(len(some), 1)


def shingles(opened: list[str]) -> list[int]:
    """Hashes of the distinct runs of five words, of the whole where it is shorter."""
    runs = [opened[i : i + SHINGLE_WORDS] for i in range(max(1, len(opened) - SHINGLE_WORDS + 1))]
    return sorted({zlib.crc32(" ".join(r).encode()) for r in runs})


#: Odd factors and summands of 64 bits; products wrap around, so that the upper halves order shingles anew for each.
_MIX = np.random.default_rng(7).integers(0, (1 << 64) - 1, (2, BANDS * ROWS), dtype=np.uint64) | np.uint64(1)


def bands(hashes: list[int]) -> list[int]:
    """One key for each band of the MinHash signature."""
    x = np.array(hashes, np.uint64)[:, None]
    signature = ((x * _MIX[0] + _MIX[1]) >> np.uint64(32)).min(0).reshape(BANDS, ROWS)
    return [zlib.crc32(row.tobytes()) << 8 | i for i, row in enumerate(signature)]


def common_words(pairs: DataFrame, prompt: str) -> dict[str, float]:
    """The content words that more than COMMON_SHARE of the prompts have, with that share.

    A prompt's content words add up to its share each, so there are at most their mean number /
    COMMON_SHARE of them, however large the table.
    """
    asked = pairs.where(F.col(prompt).isNotNull()).select(prompt)

    def count(batches):
        for batch in batches:
            seen: Counter[str] = Counter()
            for p in batch.column(0).to_pylist():
                seen.update(content(words(p)))
            yield pa.RecordBatch.from_arrays([pa.array(list(seen), pa.string()), pa.array(list(seen.values()), pa.int64())], ["word", "n"])

    every = asked.count()
    counted = asked.mapInArrow(count, "word string, n bigint").groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") > COMMON_SHARE * every)
    return {r.word: r.n / every for r in counted.orderBy(F.desc("n"), "word").limit(MAX_COMMON).collect()}


def examined(pairs: DataFrame, model: langid.Model, keys: list[str], prompt: str, answer: str) -> DataFrame:
    """For each pair its own defect (null for none), the answer's opening, what it shares with its prompt and, by the
    shares of the prompts that have its words, with any prompt, a hash of the prompt's opening, the answer's language if it is sure, its number
    of content words (0 where the prompt has none) and how many of them aren't common in prompts. A word that an answer
    breaks off in counts for none."""
    table = pairs.sparkSession.sparkContext.broadcast(model.table)
    common = pairs.sparkSession.sparkContext.broadcast(common_words(pairs, prompt))
    taken = pairs.select(*keys, F.col(prompt).alias("__prompt__"), F.col(answer).alias("__answer__"))
    kinds = dict(taken.dtypes)

    def run(batches):
        local = langid.Model(table.value)
        for batch in batches:
            at = batch.schema.get_field_index
            prompts = batch.column(at("__prompt__")).to_pylist()
            answers = batch.column(at("__answer__")).to_pylist()
            defects: list[str | None] = []
            for p, a in zip(prompts, answers):
                defects.append(
                    "empty" if is_empty(a) else "copy" if is_copy(p, a) else "truncated" if is_truncated(p, a) else None
                )
            rest = [i for i, d in enumerate(defects) if d in (None, "truncated")]
            langs_given: list[str | None] = [None] * len(defects)
            asked = list(local.passages([prompts[i] for i in rest]))
            given = list(local.passages([answers[i] for i in rest]))
            for i, own, other in zip(rest, asked, given):
                langs = {p[0] for p in own}
                sure = min((p[1] for p in [*own, *other]), default=0)
                main = max(other, key=lambda p: p[2], default=None)
                langs_given[i] = main[0] if main and main[1] >= MIN_CONFIDENCE else None
                if defects[i] is None and own and other and sure >= MIN_CONFIDENCE and not langs & {p[0] for p in other}:
                    defects[i] = "wrong_language"
            asked_words = [words(p or "") for p in prompts]
            asked_sets = [set(w) for w in asked_words]
            told = [said(a) if d != "empty" else [] for a, d in zip(answers, defects)]
            some = [content(t) for t in told]
            whole = [content(t[:-1]) if d == "truncated" else c for t, c, d in zip(told, some, defects)]
            whole = [c if content(w) else set() for c, w in zip(whole, asked_words)]
            known = common.value
            yield pa.RecordBatch.from_arrays(
                [
                    *(batch.column(at(k)) for k in keys),
                    pa.array(defects, pa.string()),
                    pa.array([opening(t) for t in told], pa.string()),
                    pa.array([shared(c, p) for c, p in zip(some, asked_sets)], pa.float64()),
                    pa.array([sum(known.get(w, 0.0) for w in c) / max(len(c), 1) for c in some], pa.float64()),
                    pa.array([zlib.crc32(opening(w, 8).encode()) for w in asked_words], pa.int64()),
                    pa.array(langs_given, pa.string()),
                    pa.array([len(c) for c in whole], pa.int32()),
                    pa.array([sum(w not in known for w in c) for c in whole], pa.int32()),
                ],
                [*keys, "own_defect", "opening", "shared", "elsewhere", "prompt_hash", "said_lang", "said", "novel"],
            )

    schema = ", ".join(f"`{k}` {kinds[k]}" for k in keys) + ", own_defect string, opening string, shared double, elsewhere double, prompt_hash bigint, said_lang string, said int, novel int"
    return taken.mapInArrow(run, schema)


def components(links: DataFrame) -> DataFrame:
    """id and head, the least of those it is linked with directly or through others.

    Every node hands its larger neighbours, and then its smaller ones, to the least it knows, until
    all that is left are stars. Rounds grow with the logarithm of a chain's length, not with the length.
    """
    edges = cut(links.where("id != head").select(F.greatest("id", "head").alias("id"), F.least("id", "head").alias("head")).distinct())
    while True:
        both = edges.unionByName(edges.select(F.col("head").alias("id"), F.col("id").alias("head")))
        least = both.groupBy("id").agg(F.least(F.min("head"), F.col("id")).alias("least"))
        larger = both.join(least, "id").where("head > id").select(F.col("head").alias("id"), F.col("least").alias("head")).distinct()
        known = larger.join(larger.groupBy("id").agg(F.min("head").alias("least")), "id")
        smaller = known.where("head > least").select(F.col("head").alias("id"), F.col("least").alias("head"))
        edges = cut(known.select("id", F.col("least").alias("head")).unionByName(smaller).distinct())
        ends = edges.select("id", F.lit(1).alias("up"), F.lit(0).alias("down")).unionByName(edges.select(F.col("head").alias("id"), F.lit(0).alias("up"), F.lit(1).alias("down")))
        if ends.groupBy("id").agg(F.sum("up").alias("up"), F.max("down").alias("down")).where("up + down > 1").isEmpty():
            return edges.unionByName(edges.select(F.col("head").alias("id"), "head").distinct())


#: What is summed over the answers of an opening.
SUMS = ("shared", "elsewhere", "said", "novel")


def refusal_openings(seen: DataFrame) -> DataFrame:
    """Openings of clusters that recur across unrelated prompts."""
    counted = (
        seen.where(F.col("opening") != "")
        .groupBy("opening", "prompt_hash")
        .agg(F.count("*").alias("n"), *(F.sum(c).alias(c) for c in SUMS))
        .groupBy("opening")
        .agg(F.count("*").alias("prompts"), F.sum("n").alias("n"), *(F.sum(c).alias(c) for c in SUMS))
        .where(F.col("shared") / F.col("n") <= MAX_CANDIDATE_SHARED)
    )
    counted = stored(counted)
    verified = opening_clusters(counted.select("opening"))
    clustered = counted.join(verified, "opening", "left").withColumn("head", F.coalesce("head", F.xxhash64("opening")))
    share = lambda c: F.sum(c) / F.sum("n")
    found = (
        clustered.groupBy("head")
        .agg(F.sum("prompts").alias("prompts"), share("shared").alias("shared"), share("elsewhere").alias("elsewhere"), F.try_divide(F.sum("novel"), F.sum("said")).alias("novel"))
        .where(F.col("prompts") >= MIN_PROMPTS)
        .where((F.col("shared") <= MAX_SHARED) | ((F.col("shared") <= MAX_SHARED_BY_CHANCE) & (F.col("shared") - F.col("elsewhere") <= MAX_EXCESS)))
        .where(F.coalesce(F.col("novel") >= MIN_CLUSTER_NOVEL, F.lit(True)))
    )
    return clustered.join(found, "head", "left_semi").select("opening")


def together(shingle: np.ndarray, counts: np.ndarray, sizes: np.ndarray, similarity: float) -> Iterator[np.ndarray]:
    """Groups of sets of shingles (numbered, set after set) such that any two of the wanted similarity are together in one.

    Two such sets share one of the first shingles of each in any one order. Rare ones of these sets come first,
    so that what many have in common brings hardly any together. Few sets are one group.
    """
    if len(sizes) <= PLAIN:
        yield np.arange(len(sizes))
        return
    owners = np.repeat(np.arange(len(sizes)), sizes)
    shingle = shingle[np.lexsort((shingle, counts[shingle], owners))]
    place = np.arange(len(owners)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    first = (place <= (sizes - np.ceil(similarity * sizes - 1e-9))[owners]) & (counts[shingle] > 1)
    shingle, owners = shingle[first], owners[first]
    order = np.argsort(shingle, kind="stable")
    ends = [0, *(np.flatnonzero(np.diff(shingle[order])) + 1).tolist(), len(order)]
    for start, end in zip(ends, ends[1:]):
        if end - start > 1:
            yield owners[order[start:end]]


def linked(held: list[bytes], similarity: float) -> list[int]:
    """For each of the sets of shingles one of those that it is linked with, directly or through others: the same for all
    of them. Any two of the wanted similarity are linked; those that already are aren't compared."""
    heads = list(range(len(held)))
    parts: dict[int, list[int]] = {}

    def join(a: int, b: int) -> None:
        own, other = parts.get(a, [a]), parts.get(b, [b])
        if len(own) < len(other):
            a, b, own, other = b, a, other, own
        for i in other:
            heads[i] = a
        own += other
        parts[a] = own

    if len(held) <= FEW:
        sets = [frozenset(np.frombuffer(h, np.uint32).tolist()) for h in held]
        for i, own in enumerate(sets):
            for j in range(i):
                if heads[i] != heads[j]:
                    common = len(own & sets[j])
                    if common >= similarity * (len(own) + len(sets[j]) - common):
                        join(heads[i], heads[j])
        return heads
    heads = np.arange(len(held))
    sizes = np.array([len(h) // 4 for h in held])
    _, shingle, counts = np.unique(np.frombuffer(b"".join(held), np.uint32), return_inverse=True, return_counts=True)
    rows = np.full((len(held), sizes.max()), len(counts), np.int32)
    rows[np.arange(rows.shape[1]) < sizes[:, None]] = shingle
    has = np.zeros(len(counts) + 1, bool)
    for group in together(shingle, counts, sizes, similarity):
        for n in range(1, len(group)) if (heads[group] != heads[group[0]]).any() else ():
            i, before = group[n], group[:n]
            before = before[heads[before] != heads[i]]
            if not len(before):
                continue
            has[rows[i, : sizes[i]]] = True
            common = has[rows[before]].sum(1)
            has[rows[i, : sizes[i]]] = False
            for j in before[common >= similarity * (sizes[i] + sizes[before] - common)].tolist():
                if heads[i] != heads[j]:
                    join(int(heads[i]), int(heads[j]))
    return heads.tolist()


def opening_clusters(openings: DataFrame) -> DataFrame:
    """opening and head of the openings (distinct) that are linked with another: components of verified MinHash links.

    Buckets hold an opening's 64-bit hash and its shingles, which are worked out once. Any two of a
    bucket that are of the wanted similarity are linked. A bucket of more than BLOCK openings is dealt
    into blocks and each two blocks are looked at together, so that no more than two are held at once.
    A head is the least hash of its component.
    """

    def sign(batches):
        for batch in batches:
            ids, opened = (c.to_pylist() for c in batch.columns)
            found = []
            for i, o in zip(ids, opened):
                hashes = shingles(o.split(" "))
                held = np.array(hashes, np.uint32).tobytes()
                found += [(i, key, held) for key in bands(hashes)]
            yield pa.RecordBatch.from_arrays([pa.array([f[n] for f in found], t) for n, t in enumerate((pa.int64(), pa.int64(), pa.binary()))], ["id", "band", "held"])

    known = openings.select(F.xxhash64("opening").alias("id"), "opening")
    each = stored(known.mapInArrow(sign, "id bigint, band bigint, held binary"))
    crowded = each.groupBy("band").count().where("count > 1").select("band", F.ceil(F.col("count") / BLOCK).alias("blocks"))
    block, other = F.expr("pmod(id, blocks)"), F.explode(F.expr("sequence(0, blocks - 1)")).alias("other")
    members = each.join(crowded, "band").select("band", "id", "held", block.alias("block"), other)
    members = members.select("band", F.least("block", "other").alias("low"), F.greatest("block", "other").alias("high"), "id", "held")

    def link(batches):
        bucket, ids, held, found = None, [], [], []

        def close():
            found.extend((i, ids[h]) for i, h in zip(ids, linked(held, SIMILARITY)) if i != ids[h])
            ids.clear()
            held.clear()

        def out():
            links = pa.RecordBatch.from_arrays([pa.array([f[n] for f in found], pa.int64()) for n in (0, 1)], ["id", "head"])
            found.clear()
            return links

        for batch in batches:
            for *at, i, h in zip(*(c.to_pylist() for c in batch.columns)):
                if at != bucket:
                    close()
                    bucket = at
                ids.append(i)
                held.append(h)
            yield out()
        close()
        yield out()

    ordered = members.repartition("band", "low", "high").sortWithinPartitions("band", "low", "high")
    heads = components(ordered.mapInArrow(link, "id bigint, head bigint").distinct())
    return known.join(heads, "id").select("opening", "head")


def with_lone_refusals(seen: DataFrame) -> DataFrame:
    """seen with __lone__: whether the answer is a refusal by its own words, however often its opening occurs.

    Ordinary answers, those that share more with their prompts than refusals do, tell for each
    language how often a word that an answer hasn't from its own prompt isn't common in prompts, and
    all together tell it for answers whose language isn't sure; where there are none, no answer is decided.
    """
    own = F.col("own_defect").isNull() | F.col("own_defect").isin("truncated", "wrong_language")
    usual = seen.where(F.col("own_defect").isNull() & (F.col("shared") > MAX_SHARED_BY_CHANCE))
    rate = ((F.sum("novel") + 1) / (F.sum(F.col("said") * (1 - F.col("shared"))) + 1)).alias("__rate__")
    sure = usual.where(F.col("said_lang").isNotNull()).groupBy(F.col("said_lang").alias("__lang__")).agg(rate)
    rates = sure.unionByName(usual.select(F.lit(None).cast("string").alias("__lang__"), "novel", "said", "shared").groupBy("__lang__").agg(rate))
    found = seen.join(F.broadcast(rates), F.col("said_lang").eqNullSafe(F.col("__lang__")), "left").drop("__lang__")
    share, rate = F.col("novel") / F.greatest("said", F.lit(1)), F.col("__rate__")
    surprise = F.col("said") * (share * F.log(share / rate) + F.when(share < 1, (1 - share) * F.log(F.try_divide(1 - share, 1 - rate))).otherwise(0.0))
    lone = own & (F.col("shared") <= MAX_SHARED_BY_CHANCE) & (share >= MIN_NOVEL) & (share > rate) & (surprise >= MIN_SURPRISE)
    return found.withColumn("__lone__", F.coalesce(lone, F.lit(False))).drop("__rate__")


def defects(pairs: DataFrame, model: langid.Model, keys: list[str], prompt: str, answer: str) -> DataFrame:
    """keys and defect of every defective pair, one row each.

    Types are tried in the order empty, refusal, copy, truncated, wrong_language. A null answer is
    empty; a null or empty prompt has no copy and no language; repeated rows give one row; extra
    columns are ignored; an empty table gives an empty result.
    """
    seen = cut(examined(pairs, model, keys, prompt, answer))
    # an answer that breaks off in its only content word tells nothing of a refusal
    telling = seen.where(F.coalesce(F.col("own_defect") != "truncated", F.lit(True)) | (F.col("said") > 0))
    refused = refusal_openings(telling).withColumn("__refusal__", F.lit("refusal"))
    judged = with_lone_refusals(seen).join(refused, "opening", "left")
    refusal = F.when(F.col("__lone__") | F.col("__refusal__").isNotNull(), "refusal")
    defect = F.when(F.col("own_defect") == "empty", "empty").otherwise(F.coalesce(refusal, "own_defect"))
    return judged.select(*keys, defect.alias("defect")).where(F.col("defect").isNotNull()).distinct()
