"""Language of documents and of the passages in them, by hyperdimensional profiles.

Every letter class has a random bipolar vector. A letter trigram is the product (bind) of the
three vectors, the first permuted twice and the second once; a text is the sum (bundle) of its
trigrams and a language prototype the centred bundle of its training trigrams. Texts are compared
with prototypes by cosine. As the inner product is linear, <text, prototype> is the sum over the
text's trigrams of <trigram, prototype>, so the products of all trigrams with all prototypes are
worked out once on the driver (64**3 x languages floats, a fixed size) and sent to the executors;
a text then costs one table look-up for each letter. The norm of a bundle of quasi-orthogonal
vectors is sqrt(D * sum of the squared counts of its trigrams), which is used as the text's norm.

Prototypes are trained on short seed texts for each language and on a bounded, hash-selected
sample of the labelled rows (``max_train_rows``, a documented bound); the sample's sentences are
then re-assigned by the first prototypes and bundled again, since labels may be wrong and texts
mixed.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

LANGS = ("en", "nl", "de", "fr", "es", "ja")
K = 64
DIM = 2048
SEED = 20240229
CHUNK_CHARS = 400_000
#: A segment needs so many letters and so large a lead in cosine to decide its language alone.
MIN_SEGMENT_LETTERS = 14
MIN_LEAD = 0.05
#: A second language needs segments with so large a lead.
MIN_PASSAGE_LEAD = 0.085
#: Short segments that lean to one language side by side need so large a lead together.
MIN_RUN_LEAD = 0.085
#: In training a labelled segment moves to another language only for so large a lead over its label.
MOVE_LEAD = 0.2
#: Rounds of training after the first.
ROUNDS = 2
#: A passage in a language needs so many letters in deciding segments; a text so many letters at all.
MIN_PASSAGE_LETTERS = 20
MIN_TEXT_LETTERS = 20
#: A Japanese sign counts for so many letters of a passage.
DENSE = 2
#: Below this cosine with every prototype a text is taken as no language.
MIN_COSINE = 0.02

# Other spellings of a language's name. Region suffixes are cut off before.
NAMES = {
    "en": ("en", "eng", "english"),
    "nl": ("nl", "nld", "dut", "dutch", "nederlands"),
    "de": ("de", "deu", "ger", "german", "deutsch"),
    "fr": ("fr", "fra", "fre", "french", "français"),
    "es": ("es", "spa", "spanish", "español"),
    "ja": ("ja", "jpn", "jp", "japanese", "日本語"),
}
#: Labels that name no language.
UNKNOWN = ("", "und", "unknown", "n/a", "na", "none", "null", "?", "-", "mul", "zxx", "mis")

#: Accented letters that get classes of their own.
ACCENTED = "áàâäãåéèêëíìîïóòôöõúùûüñçßœæ"

# Seed texts, plain sentences of general content.
SEEDS = {
    "en": "The house on the hill was built a long time ago and nobody knows who lived there first. "
    "We would like to thank you for your letter and we will answer it as soon as we can. "
    "If you have any questions, please let us know what you need and when you need it. "
    "They were not able to see which of the children had taken the other book with them. "
    "It is often said that the weather in spring changes every hour, but this year it did not. "
    "You should have your papers with you whenever you go through one of these doors. "
    "Where have they been, and why did nothing happen after everything that was said? "
    "The amount was paid back to my account yesterday, although nobody had told me about it. "
    "For this reason we cannot give you more than one copy of the same letter. "
    "Her brother works at the station and comes home late in the evening. "
    "Which of these two would you rather have, the large one or the small one? "
    "Children under twelve may use the bath only together with an adult.",
    "nl": "Het huis op de heuvel werd lang geleden gebouwd en niemand weet wie er het eerst woonde. "
    "Wij danken u voor uw brief en zullen hem zo snel mogelijk beantwoorden. "
    "Als u nog vragen hebt, laat ons dan weten wat u nodig hebt en wanneer dat moet gebeuren. "
    "Zij konden niet zien welke van de kinderen het andere boek had meegenomen naar school. "
    "Er wordt vaak gezegd dat het weer in het voorjaar ieder uur verandert, maar dit jaar niet. "
    "U moet uw papieren altijd bij u hebben wanneer u door een van deze deuren gaat. "
    "Waar zijn ze geweest en waarom is er niets gebeurd na alles wat er gezegd werd? "
    "Het bedrag werd gisteren op mijn rekening teruggestort, hoewel niemand mij daarover had ingelicht. "
    "Om deze reden kunnen wij u niet meer dan een kopie van dezelfde brief geven. "
    "Haar broer werkt op het station en komt 's avonds laat thuis. "
    "Welke van deze twee wilt u liever hebben, de grote of de kleine? "
    "Kinderen onder de twaalf jaar mogen het bad alleen samen met een volwassene gebruiken.",
    "de": "Das Haus auf dem Hügel wurde vor langer Zeit gebaut und niemand weiß, wer dort zuerst wohnte. "
    "Wir danken Ihnen für Ihren Brief und werden ihn so schnell wie möglich beantworten. "
    "Wenn Sie noch Fragen haben, teilen Sie uns bitte mit, was Sie brauchen und wann es sein muss. "
    "Sie konnten nicht sehen, welches der Kinder das andere Buch in die Schule mitgenommen hatte. "
    "Man sagt oft, dass sich das Wetter im Frühling jede Stunde ändert, aber dieses Jahr war es nicht so. "
    "Sie müssen Ihre Unterlagen immer bei sich haben, wenn Sie durch eine dieser Türen gehen. "
    "Wo sind sie gewesen und warum ist nach allem, was gesagt wurde, nichts geschehen? "
    "Der Betrag wurde gestern auf mein Konto zurückgezahlt, obwohl mir niemand etwas davon gesagt hatte. "
    "Aus diesem Grund können wir Ihnen nicht mehr als eine Kopie desselben Schreibens geben. "
    "Ihr Bruder arbeitet am Bahnhof und kommt abends spät nach Hause. "
    "Welches von diesen beiden möchten Sie lieber haben, das große oder das kleine? "
    "Kinder unter zwölf Jahren dürfen das Bad nur zusammen mit einem Erwachsenen benutzen.",
    "fr": "La maison sur la colline a été construite il y a longtemps et personne ne sait qui y vivait d'abord. "
    "Nous vous remercions de votre lettre et nous y répondrons dès que possible. "
    "Si vous avez encore des questions, dites-nous ce dont vous avez besoin et pour quand. "
    "Ils ne pouvaient pas voir lequel des enfants avait emporté l'autre livre à l'école. "
    "On dit souvent que le temps change toutes les heures au printemps, mais pas cette année. "
    "Vous devez toujours avoir vos papiers sur vous lorsque vous passez par l'une de ces portes. "
    "Où étaient-ils et pourquoi rien ne s'est-il passé après tout ce qui a été dit? "
    "Le montant a été remboursé hier sur mon compte, bien que personne ne m'en ait parlé. "
    "C'est pourquoi nous ne pouvons pas vous donner plus d'une copie de la même lettre. "
    "Son frère travaille à la gare et rentre tard le soir à la maison. "
    "Lequel de ces deux préférez-vous avoir, le grand ou le petit? "
    "Les enfants de moins de douze ans ne peuvent utiliser le bain qu'avec un adulte.",
    "es": "La casa de la colina fue construida hace mucho tiempo y nadie sabe quién vivió allí primero. "
    "Le agradecemos su carta y la contestaremos tan pronto como sea posible. "
    "Si tiene más preguntas, díganos qué necesita y para cuándo lo necesita usted. "
    "No podían ver cuál de los niños se había llevado el otro libro a la escuela. "
    "Se dice a menudo que el tiempo cambia cada hora en primavera, pero este año no fue así. "
    "Debe llevar siempre sus papeles consigo cuando pase por una de estas puertas. "
    "¿Dónde han estado y por qué no ocurrió nada después de todo lo que se dijo? "
    "El importe fue devuelto ayer a mi cuenta, aunque nadie me había dicho nada al respecto. "
    "Por esta razón no podemos darle más de una copia de la misma carta. "
    "Su hermano trabaja en la estación y llega tarde a casa por la noche. "
    "¿Cuál de estos dos prefiere usted tener, el grande o el pequeño? "
    "Los niños menores de doce años solo pueden usar el baño junto con un adulto. "
    "Rellene la solicitud y envíela en un plazo de un mes para que podamos examinarla.",
    "ja": "丘の上の家はずっと昔に建てられたもので、最初に誰が住んでいたのか誰も知りません。"
    "お手紙をいただきありがとうございます。できるだけ早くお返事いたします。"
    "ご質問がございましたら、何がいつまでに必要なのかをお知らせください。"
    "春の天気は一時間ごとに変わるとよく言われますが、今年はそうではありませんでした。"
    "このドアを通るときは、いつも書類を持っていなければなりません。"
    "金額は昨日私の口座に返金されましたが、誰もそのことを教えてくれませんでした。"
    "この理由により、同じ手紙の写しを一通以上お渡しすることはできません。"
    "彼女の兄は駅で働いていて、夜遅く家に帰ります。",
}


def normal_label(lang: Column) -> Column:
    """A label as a two-letter code; null where it is null, blank or says unknown; other names as they are."""
    base = F.lower(F.trim(F.regexp_extract(F.trim(lang), r"^([^-_\s(;,]*)", 1)))
    plain = F.lower(F.trim(lang))
    out = F.when(lang.isNull() | plain.isin(*UNKNOWN) | base.isin(*UNKNOWN), F.lit(None).cast("string"))
    for code, names in NAMES.items():
        out = out.when(base.isin(*names), F.lit(code))
    return out.otherwise(base)


@lru_cache(1)
def symbols() -> np.ndarray:
    """Letter class of every code point of the basic plane: 0 no letter, 1-26 a-z, then accented and scripts."""
    out = np.zeros(0x10000, np.uint8)
    for cp in range(0x10000):
        low = chr(cp).lower()[:1]
        if "a" <= low <= "z":
            out[cp] = ord(low) - 96
        elif (at := ACCENTED.find(low)) >= 0:
            out[cp] = 27 + at
        elif 0x3040 <= cp <= 0x309F:
            out[cp] = 56 + cp % 2
        elif 0x30A0 <= cp <= 0x30FF:
            out[cp] = 58 + cp % 2
        elif 0x3400 <= cp <= 0x9FFF:
            out[cp] = 60 + cp % 2
        elif low.isalpha():
            out[cp] = 62 + cp % 2
    return out


#: A quoted term of a few words counts for no language.
QUOTED = re.compile(r"“[^”\n]{0,60}”|«[^»\n]{0,60}»")
_SPACE = [ord(c) for c in " \t\r\n 　"]
_STOP = [ord(c) for c in ".!?:"]
_WIDE_STOP = [ord(c) for c in "。！？\n"]
_BAR = [ord(c) for c in "/|—–"]
_BAD = [ord(c) for c in "0123456789=&|@_\\{}<>⟦⟧"]


#: Inline tokens of a rewriting run stand for markup.
TOKEN = re.compile(r"⟦[^⟧\n]{0,40}⟧")


def blanked(text: str) -> str:
    """The text with quoted terms and inline tokens as spaces of the same length."""
    if "⟦" in text:
        text = TOKEN.sub(lambda m: " " * len(m[0]), text)
    if "“" in text or "«" in text:
        text = QUOTED.sub(lambda m: " " * len(m[0]), text)
    return text


def _flags(cps: np.ndarray, chars: list[int]) -> np.ndarray:
    table = np.zeros(0x10000, bool)
    table[chars] = True
    return table[cps]


@dataclass
class Segments:
    """Segments of some texts: the text each is of, the part between line ends and bars it is in, its letters, and its
    trigrams in order with their segment."""

    text: np.ndarray
    part: np.ndarray
    letters: np.ndarray
    start: np.ndarray
    end: np.ndarray
    trigram: np.ndarray
    segment: np.ndarray


def segments(texts: list[str]) -> Segments:
    """Cut texts at sentence ends, line ends and stand-alone bars; trigrams of letters and word ends.

    Quoted terms, words with digits or code signs and unbroken runs of more than 40 characters without
    Japanese signs count as no letters.
    """
    texts = [blanked(t) for t in texts]
    lens = np.array([len(t) + 1 for t in texts], np.int64)
    cps = np.frombuffer(("\n".join(texts) + "\n").encode("utf-32-le", "surrogatepass"), np.uint32)
    cps = np.minimum(cps, 0xFFFF).astype(np.int64)
    n = len(cps)
    of_text = np.repeat(np.arange(len(texts)), lens)
    space = _flags(cps, _SPACE)
    sym = symbols()[cps].astype(np.int64)
    # words: bad ones lose their letters
    starts = np.flatnonzero(~space & np.r_[True, space[:-1]])
    if len(starts):
        word = np.cumsum(np.bincount(starts, minlength=n)) - 1
        bad = np.maximum.reduceat(_flags(cps, _BAD) & ~space, starts)
        long = np.add.reduceat((sym > 0) & (sym < 56), starts) > 40
        sym[(bad | long)[np.maximum(word, 0)] | space] = 0
    nxt = np.r_[space[1:], True]
    prev = np.r_[True, space[:-1]]
    wide = (cps == 10) | (_flags(cps, _BAR) & nxt & prev)
    cut = (_flags(cps, _STOP) & nxt) | _flags(cps, _WIDE_STOP) | wide
    last = np.cumsum(lens) - 1
    cut[last] = True
    seg = np.r_[0, np.cumsum(cut)[:-1]]
    count = int(seg[-1]) + 1
    ends = np.flatnonzero(cut)
    begins = np.r_[0, ends[:-1] + 1]
    base = np.r_[0, np.cumsum(lens)[:-1]]
    text = of_text[begins]
    part = np.r_[0, np.cumsum(wide[ends])[:-1]]
    letters = np.bincount(seg, sym > 0, count).astype(np.int64)
    keep = (sym > 0) | np.r_[True, sym[:-1] > 0]
    s, g = np.r_[0, sym[keep]], np.r_[0, seg[keep]]  # a word end before the first text too
    tri = (s[:-2] * K + s[1:-1]) * K + s[2:]
    mid = s[1:-1] > 0
    return Segments(text, part, letters, begins - base[text], ends + 1 - base[text], tri[mid], g[1:-1][mid])


@lru_cache(1)
def _letters() -> np.ndarray:
    return np.random.default_rng(SEED).choice(np.array([-1, 1], np.int8), (K, DIM)).astype(np.float32)


def scores_of_counts(counts: np.ndarray) -> np.ndarray:
    """Inner products of every trigram with the centred, normed bundles of the counted trigrams: (K**3, languages)."""
    base = _letters()
    r2, r1 = np.roll(base, 2, 1), np.roll(base, 1, 1)
    weights = np.sqrt(counts / np.maximum(counts.sum(1, keepdims=True), 1))
    seen = np.flatnonzero(counts.sum(0))
    protos = np.zeros((len(counts), DIM), np.float32)
    for at in range(0, len(seen), 1024):
        t = seen[at : at + 1024]
        protos += weights[:, t].astype(np.float32) @ (r2[t // (K * K)] * r1[t // K % K] * base[t % K])
    protos -= protos.mean(0)
    protos /= np.maximum(np.linalg.norm(protos, axis=1, keepdims=True), 1e-9)
    out = np.empty((K, K, K, len(counts)), np.float32)
    for first in range(K):
        pairs = r2[first] * r1
        for lang, proto in enumerate(protos):
            out[first, :, :, lang] = (pairs * proto) @ base.T
    return out.reshape(K**3, len(counts)) / np.float32(np.sqrt(DIM))


def norms(groups: np.ndarray, trigrams: np.ndarray, count: int) -> np.ndarray:
    """Norm of every group's bundle, as a multiple of a trigram's: the root of the sum of its trigrams' squared counts."""
    keys = np.sort(groups * K**3 + trigrams)
    first = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]]) if len(keys) else np.zeros(0, np.int64)
    runs = np.diff(np.r_[first, len(keys)])
    return np.sqrt(np.maximum(np.bincount(keys[first] // K**3, runs * runs, count), 1))


def products(segs: Segments, table: np.ndarray) -> np.ndarray:
    """Inner product of every segment's bundle with every prototype."""
    count = len(segs.text)
    if not len(segs.trigram):
        return np.zeros((count, table.shape[1]))
    return np.stack([np.bincount(segs.segment, table[segs.trigram, lang], count) for lang in range(table.shape[1])], 1)


def cosines(segs: Segments, inner: np.ndarray, group: np.ndarray | None = None) -> np.ndarray:
    """Cosine with every prototype of the bundle of every segment, or of every group of segments."""
    if group is None:
        return inner / norms(segs.segment, segs.trigram, len(inner))[:, None]
    count = int(group[-1]) + 1 if len(group) else 0
    total = np.zeros((count, inner.shape[1]))
    np.add.at(total, group, inner)
    return total / norms(group[segs.segment], segs.trigram, count)[:, None]


def chunks(texts: list[str], most: int = CHUNK_CHARS) -> Iterator[tuple[int, int]]:
    """Ranges of texts with about so many characters; a longer text is a chunk of its own."""
    at = size = 0
    for i, t in enumerate(texts):
        if size and size + len(t) > most:
            yield at, i
            at, size = i, 0
        size += len(t) + 1
    if at < len(texts):
        yield at, len(texts)


class Model:
    """Trained prototypes as the table of trigram products."""

    def __init__(self, table: np.ndarray):
        self.table = table

    @staticmethod
    def train(texts: list[str] = (), labels: list[str] = ()) -> Model:
        """Bundle the seeds and the given labelled texts, re-assign the texts' segments, bundle again."""
        at = {lang: i for i, lang in enumerate(LANGS)}
        known = [(t, at[label]) for t, label in zip(texts, labels) if label in at and t]
        own = [(SEEDS[lang], i) for lang, i in at.items()]

        def counted(rows: list[tuple[str, int]], table: np.ndarray | None) -> np.ndarray:
            out = np.zeros((len(LANGS), K**3))
            every = [t for t, _ in rows]
            for a, b in chunks(every):
                segs = segments(every[a:b])
                given = np.array([lang for _, lang in rows[a:b]])[segs.text]
                if table is not None:
                    found = cosines(segs, products(segs, table))
                    own_score = np.take_along_axis(found, given[:, None], 1)[:, 0]
                    moved = (segs.letters >= MIN_SEGMENT_LETTERS) & (found.max(1) - own_score > MOVE_LEAD)
                    given = np.where(moved, found.argmax(1), given)
                lang = given[segs.segment]
                np.add.at(out, (lang, segs.trigram), 1)
            return out

        seed = counted(own, None)
        table = scores_of_counts(seed + counted(known, None))
        if known:
            for _ in range(ROUNDS):
                table = scores_of_counts(seed + counted(known, table))
        return Model(table)

    def passages(self, texts: list[str | None]) -> Iterator[list[tuple[str, float, int, int, int]]]:
        """For each text its passages: (language, confidence, letters, start, end), joined where neighbours agree.

        Empty for null texts, texts with too few letters, and texts that are no language.
        A segment that cannot decide alone takes the language of the text as a whole, or of
        the deciding segment before it.
        """
        plain = [t or "" for t in texts]
        for a, b in chunks(plain):
            segs = segments(plain[a:b])
            quoted = np.array([("“" in t or "«" in t) and sum(map(str.isalpha, t)) for t in plain[a:b]], np.int64)
            yield from _passages(segs, products(segs, self.table), quoted)


def _passages(segs: Segments, inner: np.ndarray, quoted: np.ndarray) -> Iterator[list[tuple[str, float, int, int, int]]]:
    count = len(quoted)
    found = cosines(segs, inner)
    ranked = np.sort(found, 1)
    lead = ranked[:, -1] - ranked[:, -2]
    sure = (segs.letters >= MIN_SEGMENT_LETTERS) & (lead > MIN_LEAD) & (ranked[:, -1] > MIN_COSINE)
    best = found.argmax(1)
    total = cosines(segs, inner, segs.text)
    letters = np.bincount(segs.text, segs.letters, count)
    whole = total.argmax(1)
    top = np.sort(total, 1)
    bounds = np.searchsorted(segs.text, np.arange(count + 1))
    in_lang = np.zeros((count, found.shape[1]))
    # what a segment leaves open, its part between line ends and bars may tell, unless clear segments of it disagree
    clear = sure & (lead > MIN_PASSAGE_LEAD)
    parts = int(segs.part[-1]) + 1
    by_part = cosines(segs, inner, segs.part)
    part_letters = np.bincount(segs.part, segs.letters, parts)
    top_part = np.sort(by_part, 1)
    part_clear = (part_letters >= MIN_PASSAGE_LETTERS) & (top_part[:, -1] - top_part[:, -2] > MIN_PASSAGE_LEAD) & (top_part[:, -1] > MIN_COSINE)
    of_part = by_part.argmax(1)[segs.part]
    part_clear &= np.bincount(segs.part, clear & (best != of_part), parts) == 0
    told = np.where(clear, best, np.where(part_clear[segs.part] & (segs.letters > 0), of_part, -1))
    # short segments side by side that lean to one language may tell it together
    lean = np.where(segs.letters > 0, best, -1)
    run = np.cumsum(np.r_[False, (lean[1:] != lean[:-1]) | (segs.text[1:] != segs.text[:-1])])
    by_run = cosines(segs, inner, run)
    top_run = np.sort(by_run, 1)
    run_letters = np.bincount(run, segs.letters)
    run_clear = (run_letters >= MIN_PASSAGE_LETTERS) & (top_run[:, -1] - top_run[:, -2] > MIN_RUN_LEAD) & (top_run[:, -1] > MIN_COSINE)
    told = np.where((told < 0) & (lean >= 0) & run_clear[run] & (by_run.argmax(1)[run] == lean), lean, told)
    # a segment that is too short to tell goes with one beside it that it leans to
    for beside, ok in ((np.r_[-1, told[:-1]], np.r_[False, segs.text[1:] == segs.text[:-1]]), (np.r_[told[1:], -1], np.r_[segs.text[1:] == segs.text[:-1], False])):
        told = np.where((told < 0) & ok & (segs.letters > 0) & (beside == best), best, told)
    weight = np.where(told == LANGS.index("ja"), DENSE, 1)
    np.add.at(in_lang, (segs.text[told >= 0], told[told >= 0]), (segs.letters * weight)[told >= 0])
    for i in range(count):
        if max(letters[i], quoted[i] if letters[i] >= MIN_SEGMENT_LETTERS - 2 else 0) < MIN_TEXT_LETTERS or (top[i, -1] < MIN_COSINE and not in_lang[i].any()):
            yield []
            continue
        real = np.flatnonzero(in_lang[i] >= MIN_PASSAGE_LETTERS)
        if len(real) < 2:
            lang = int(whole[i])
            sureness = 1 / (1 + np.exp(-12 * (top[i, -1] - top[i, -2])))
            lo, hi = bounds[i], bounds[i + 1]
            yield [(LANGS[lang], float(sureness), int(letters[i]), int(segs.start[lo]), int(segs.end[hi - 1]))]
            continue
        allowed = set(real.tolist())
        out: list[list] = []
        now = None
        for k in range(bounds[i], bounds[i + 1]):
            lang = int(told[k]) if int(told[k]) in allowed else int(best[k]) if sure[k] and int(best[k]) in allowed else now
            if lang is None:
                lang = next((int(told[m]) for m in range(k, bounds[i + 1]) if int(told[m]) in allowed), int(whole[i]))
            now = lang
            sureness = 1 / (1 + np.exp(-12 * max(float(found[k, lang] - np.delete(found[k], lang).max()), 0.0)))
            if out and out[-1][0] == LANGS[lang]:
                last = out[-1]
                last[1] = (last[1] * last[2] + sureness * segs.letters[k]) / max(last[2] + segs.letters[k], 1)
                last[2] += int(segs.letters[k])
                last[4] = int(segs.end[k])
            else:
                out.append([LANGS[lang], float(sureness), int(segs.letters[k]), int(segs.start[k]), int(segs.end[k])])
        yield [tuple(p) for p in out]


#: Bounds of the labelled sample that the prototypes are trained on.
MAX_TRAIN_ROWS = 6000
MAX_TRAIN_CHARS = 5000


def training_rows(labelled: DataFrame, text: str = "text", lang: str = "lang", max_train_rows: int = MAX_TRAIN_ROWS) -> tuple[list[str], list[str]]:
    """A sample of about max_train_rows labelled texts by their hash, on the driver.

    Its texts have at most MAX_TRAIN_CHARS characters and are distinct, so a text that is repeated
    often takes one place; those of the least hashes are taken, so it is the same each time.
    """
    known = labelled.where(F.col(text).isNotNull()).select(F.col(text).alias("t"), normal_label(F.col(lang)).alias("l"))
    known = known.where(F.col("l").isin(*LANGS) & (F.length("t") <= MAX_TRAIN_CHARS))
    step = max(1, -(-labelled.count() // max_train_rows))
    some = known.where(F.pmod(F.xxhash64("t"), F.lit(step)) == 0).distinct()
    rows = some.orderBy(F.xxhash64("t", F.lit(SEED)), "t", "l").limit(2 * max_train_rows).collect()
    rows.sort()
    return [r.t for r in rows], [r.l for r in rows]


def fit(labelled: DataFrame, text: str = "text", lang: str = "lang", max_train_rows: int = MAX_TRAIN_ROWS) -> Model:
    return Model.train(*training_rows(labelled, text, lang, max_train_rows))


PASSAGE = "array<struct<lang string, confidence double, letters int, start int, stop int>>"


def with_passages(df: DataFrame, model: Model, text: str, keep: list[str], out: str = "passages") -> DataFrame:
    """The kept columns of every row and the passages of its text.

    Null, empty, short and languageless texts get an empty array. Extra columns are not read.
    """
    shared = df.sparkSession.sparkContext.broadcast(model.table)
    name = "__text__"
    taken = df.select(*keep, F.col(text).alias(name))
    kind = pa.list_(pa.struct([("lang", pa.string()), ("confidence", pa.float64()), ("letters", pa.int32()), ("start", pa.int32()), ("stop", pa.int32())]))
    schema = ", ".join(f"`{c}` {t}" for c, t in taken.dtypes if c != name) + f", `{out}` {PASSAGE}"

    def run(batches):
        local = Model(shared.value)
        for batch in batches:
            texts = batch.column(batch.schema.get_field_index(name)).to_pylist()
            rows = [[dict(zip(("lang", "confidence", "letters", "start", "stop"), p)) for p in ps] for ps in local.passages(texts)]
            columns = [batch.column(i) for i in range(len(keep))]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(rows, kind)], [*keep, out])

    return taken.mapInArrow(run, schema)
