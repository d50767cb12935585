"""Problem 9: one form for texts that look the same.

A batch of texts is exploded to code points with their text and position, as columns. Tables that
are worked out once from the Unicode data of the interpreter give each code point its decomposition
or look-alike; they are looked up for all code points at once, which is the broadcast join with a
fixed-size table (one entry for each code point of Unicode). Combining marks are put in
order of their class between two starters, pairs that compose are composed, and the texts are
rebuilt. Texts that no table changes are passed through as they are.

Looking the same: full- and half-width forms, letter ligatures and letter-like numerals, split
accents, invisible characters, other kinds of single space, and letters of other scripts with the
shape of a Latin letter. Another letter, digit, accent, case or superscript doesn't.
"""

from __future__ import annotations

import hashlib
import itertools
import unicodedata
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from palimpsest.session import stored

LIMIT = 0x110000
#: Code points with entries of their own; the others are ideographs, private or unassigned and stay as they are.
RANGES = (range(0x20000), range(0x2F800, 0x2FA20), range(0xE0000, 0xE1000))
CHUNK_CHARS = 400_000

# Letters of other scripts that have the shape of the Latin letter below them.
CYRILLIC = ("АВЕКМНОРСТУХЅІЈԌԚԜҮЗӀаеорсухѕіјһԁԛԝѵӏ", "ABEKMHOPCTYXSIJGQWY3Iaeopcyxsijhdqwvl")
GREEK = ("ΑΒΕΖΗΙΚΜΝΟΡΤΥΧͿϹαγινορυϲϳ", "ABEZHIKMNOPTYXJCayivopucj")
ARMENIAN = ("օոսհցՕՍԼ", "onuhgOUL")
CHEROKEE = ("ᎠᎡᎢᎥᎩᎪᎫᎬᎳᎷᎻᏀᏃᏎᏙᏚᏞᏟᏢᏦᏴ", "DRTiYAJEWMHGZ4VSLCPKB")
COPTIC = ("ⲀⲂⲈⲎⲒⲔⲘⲚⲞⲢⲤⲦⲨⲬⲟⲣⲥⲭ", "ABEHIKMNOPCTYXopcx")
LISU = ("ꓐꓑꓓꓔꓖꓗꓙꓚꓜꓝꓟꓠꓡꓢꓣꓦꓧꓪꓫꓬꓮꓰꓲꓳꓴ", "BPDTGKJCZFMNLSRVHWXYAEIOU")
SCRIPTS = (CYRILLIC, GREEK, ARMENIAN, CHEROKEE, COPTIC, LISU)
#: The block of mathematical letters and digits, which are Latin and Greek ones in another typeface.
MATHEMATICAL = range(0x1D400, 0x1D800)
#: One shape, two code points.
SAME = {0x00B5: "μ", 0x2010: "-", 0x2011: "-", 0x0261: "g", 0x2044: "/", 0x2024: "."}
#: Invisible code points besides those of category Cf.
INVISIBLE = frozenset((0x034F, 0x115F, 0x1160, 0x17B4, 0x17B5, 0x180B, 0x180C, 0x180D, 0x180F, 0x3164, 0xFFA0, *range(0xFE00, 0xFE10), *range(0xE0000, 0xE1000)))


#: Conjoining jamo compose by arithmetic, which is left to the interpreter.
JAMO = (0x1100, 0x1200)


@lru_cache(1)
def _tables() -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, dict[int, int], np.ndarray]:
    """Start and length of each code point's replacement, the replacements' code points, combining classes, the
    compositions of pairs, and which code points may compose with what stands before."""
    alike = {ord(a): b for there, here in SCRIPTS for a, b in zip(there, here)}
    start, length = np.arange(LIMIT, dtype=np.int32), np.ones(LIMIT, np.uint8)
    classes = np.zeros(LIMIT, np.uint8)
    into: list[int] = []
    pairs: dict[int, int] = {}
    second = np.zeros(LIMIT, bool)
    for cp in itertools.chain(*RANGES):
        if 0xD800 <= cp < 0xE000:
            continue
        classes[cp] = unicodedata.combining(chr(cp))
        if (new := _replaced(cp, alike)) is not None:
            start[cp], length[cp] = LIMIT + len(into), len(new)
            into.extend(map(ord, new))
    for cp in range(0xC0, 0x20000):
        if not 0xD800 <= cp < 0xE000 and 0xAC00 > cp or 0xD7A4 <= cp and not 0xD800 <= cp < 0xE000:
            parts = unicodedata.decomposition(chr(cp)).split()
            if len(parts) == 2 and not parts[0].startswith("<") and unicodedata.normalize("NFC", chr(cp)) == chr(cp):
                a, b = int(parts[0], 16), int(parts[1], 16)
                pairs[a << 20 | b] = cp
                second[b] = True
    return start, length, np.r_[np.arange(LIMIT, dtype=np.int32), np.array(into, np.int32)], classes, pairs, second


def _replaced(cp: int, alike: dict[int, str]) -> str | None:
    """What a code point becomes before composition; None for itself."""
    c = chr(cp)
    if cp in alike:
        return alike[cp]
    if cp in SAME:
        return SAME[cp]
    kind = unicodedata.category(c)
    if kind == "Cf" or cp in INVISIBLE:
        return ""
    if kind == "Zs":
        return None if cp in (0x20, 0x1680) else " "
    parts = unicodedata.decomposition(c)
    if not parts:
        return None
    tag = parts.split()[0]
    if not tag.startswith("<"):
        whole = unicodedata.normalize("NFD", c)
        return "".join(alike.get(ord(x), x) for x in whole) if any(ord(x) in alike for x in whole) else whole
    if tag in ("<wide>", "<narrow>"):
        return unicodedata.normalize("NFD", "".join(chr(int(p, 16)) for p in parts.split()[1:]))
    if tag == "<font>" and cp in MATHEMATICAL:
        return "".join(alike.get(int(p, 16), chr(int(p, 16))) for p in parts.split()[1:])
    if tag == "<compat>" and (0xFB00 <= cp <= 0xFB17 or 0x0132 <= cp <= 0x0133 or 0x01C7 <= cp <= 0x01CC or 0x2160 <= cp <= 0x217F):
        return unicodedata.normalize("NFKD", c)
    return None


def _changed() -> np.ndarray:
    start, length, into, classes, _, second = _tables()
    own = (length == 1) & (into[np.minimum(start, len(into) - 1)] == np.arange(LIMIT))
    return ~own | (classes > 0) | second


@lru_cache(1)
def _touched() -> np.ndarray:
    """Code points with which a text isn't surely in its form already."""
    out = _changed()
    for cp in range(0xC0, 0x20000):
        if out[cp] and not 0xD800 <= cp < 0xE000:
            whole = unicodedata.normalize("NFD", chr(cp))
            if len(whole) > 1 and unicodedata.normalize("NFC", whole) == chr(cp) and _replaced(cp, {}) == whole:
                out[cp] = False
    out[JAMO[0] : JAMO[1]] = True
    return out


def normal_forms(texts: list[str | None]) -> list[str | None]:
    """The form of every text; null for null, empty for empty; idempotent."""
    out: list[str | None] = list(texts)
    todo = [i for i, t in enumerate(texts) if t and not t.isascii()]
    at = 0
    while at < len(todo):
        size, end = 0, at
        while end < len(todo) and (end == at or size + len(texts[todo[end]]) <= CHUNK_CHARS):
            size += len(texts[todo[end]])
            end += 1
        ids = todo[at:end]
        for i, t in zip(ids, _chunk([texts[i] for i in ids])):
            out[i] = t
        at = end
    return out


def _chunk(texts: list[str]) -> list[str]:
    lens = np.array([len(t) for t in texts])
    cps = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64)
    # a text none of whose code points can change is done
    hit = _touched()[cps]
    hits = np.add.reduceat(hit, np.r_[0, np.cumsum(lens)[:-1]]) > 0
    out = list(texts)
    if not hits.any():
        return out
    keep = np.repeat(hits, lens)
    done = np.flatnonzero(hits)
    cps, of = cps[keep], np.repeat(np.arange(len(done)), lens[hits])
    # decompose: every code point becomes its replacement
    start, length, into, classes, pairs, second = _tables()
    n = length[cps].astype(np.int64)
    src = np.repeat(np.arange(len(cps)), n)
    k = np.arange(len(src)) - np.repeat(np.cumsum(n) - n, n)
    new = into[start[cps[src]] + k].astype(np.int64)
    of = of[src]
    # order combining marks by class behind each starter
    ccc = classes[new]
    if ccc.any():
        edge = np.r_[True, of[1:] != of[:-1]]
        group = np.cumsum((ccc == 0) | edge)
        order = np.lexsort((np.arange(len(new)), ccc, group))
        new, of, ccc, group = new[order], of[order], ccc[order], group[order]
    # compose: marks with their starter, and the few starters that compose with one before them
    may = np.flatnonzero(second[new])
    gone = np.zeros(len(new), bool)
    for j in may.tolist():
        if ccc[j]:
            i, blocked = j - 1, False
            while i >= 0 and (gone[i] or ccc[i]) and of[i] == of[j]:
                if not gone[i] and ccc[i] >= ccc[j]:
                    blocked = True
                    break
                i -= 1
            if blocked or i < 0 or of[i] != of[j] or ccc[i]:
                continue
        else:
            i = j - 1
            if i < 0 or of[i] != of[j] or gone[i] or ccc[i]:
                continue
        both = pairs.get(int(new[i]) << 20 | int(new[j]))
        if both is not None:
            new[i] = both
            gone[j] = True
    new, of = new[~gone], of[~gone]
    bounds = np.searchsorted(of, np.arange(len(done) + 1))
    jamo = np.add.reduceat((new >= JAMO[0]) & (new < JAMO[1]), np.minimum(bounds[:-1], len(new) - 1)) if len(new) else np.zeros(len(done))
    whole = new.astype(np.uint32).tobytes()
    for m, i in enumerate(done.tolist()):
        out[i] = whole[4 * bounds[m] : 4 * bounds[m + 1]].decode("utf-32-le", "surrogatepass")
        if jamo[m]:
            out[i] = unicodedata.normalize("NFC", out[i])
    return out


def with_form(df: DataFrame, text: str, keep: list[str], out: str = "form") -> DataFrame:
    """The kept columns and the form of each row's text; null for null."""
    name = "__text__"
    taken = df.select(*keep, F.col(text).alias(name))
    schema = ", ".join(f"`{c}` {t}" for c, t in taken.dtypes if c != name) + f", `{out}` string"

    def run(batches):
        for batch in batches:
            at = batch.schema.get_field_index
            forms = normal_forms(batch.column(at(name)).to_pylist())
            yield pa.RecordBatch.from_arrays([*(batch.column(at(k)) for k in keep), pa.array(forms, pa.string())], [*keep, out])

    return taken.mapInArrow(run, schema)


def exploded_forms(df: DataFrame, key: str, text: str, out: str = "form") -> DataFrame:
    """key and form of each text, by rows: the same result as with_form for keys that are unique.

    Texts are exploded to positioned code points, which are joined with the broadcast table of
    replacements (of fixed size), numbered by the starter they belong to, put in order of class,
    composed within their group, and put together again. One row for each code point is shuffled,
    so the queries use with_form; this plan is what it is held against.
    """
    start, length, into, marks, pairs, second = _tables()
    changed = np.flatnonzero((length != 1) | (start >= LIMIT) | (marks > 0))
    spark = df.sparkSession
    known = [(int(c), [(int(x), int(marks[x])) for x in into[start[c] : start[c] + length[c]]]) for c in changed]
    table = spark.createDataFrame(known, "cp int, new array<struct<cp:int,mark:int>>")
    both = F.create_map(*(F.lit(x) for k, v in pairs.items() for x in (k, v)))
    joins = [int(c) for c in np.flatnonzero(second & (marks == 0))] + list(range(*JAMO))
    points = F.transform(F.regexp_extract_all(F.hex(F.encode(text, "UTF-32")), F.lit(".{8}"), F.lit(0)), lambda x: F.conv(x, 16, 10).cast("int"))
    rows = df.where(F.col(text).isNotNull()).select(F.col(key).alias("key"), F.posexplode(points).alias("at", "cp"))
    found = rows.join(F.broadcast(table), "cp", "left").select(
        "key", "at", F.posexplode(F.coalesce("new", F.array(F.struct("cp", F.lit(0).alias("mark"))))).alias("of", "new")
    )
    starter = (F.col("new.mark") == 0) & ~F.col("new.cp").isin(joins)
    placed = found.withColumn("group", F.sum(starter.cast("int")).over(Window.partitionBy("key").orderBy("at", "of")))
    # within a group: marks by class, then each with the starter unless one of its class or above stands between
    listed = placed.groupBy("key", "group").agg(F.sort_array(F.collect_list(F.struct("new.mark", "at", "of", "new.cp"))).alias("l"))
    none = F.lit(None).cast("int")

    def add(state, x):
        composed = F.try_element_at(both, F.shiftleft(state["base"].cast("bigint"), 20).bitwiseOR(x["cp"].cast("bigint")))
        free = state["base"].isNotNull() & (state["last"] < F.greatest(x["mark"], F.lit(1))) & composed.isNotNull()
        opens = (x["mark"] == 0) & ~free
        return F.when(free, F.struct(state["done"].alias("done"), composed.cast("int").alias("base"), state["last"].alias("last"), state["rest"].alias("rest"))).when(
            opens, F.struct(F.concat(state["done"], F.when(state["base"].isNull(), F.array().cast("array<int>")).otherwise(F.array(state["base"])), state["rest"]).alias("done"), x["cp"].alias("base"), F.lit(0).alias("last"), F.array().cast("array<int>").alias("rest"))
        ).otherwise(F.struct(state["done"].alias("done"), state["base"].alias("base"), x["mark"].alias("last"), F.concat(state["rest"], F.array(x["cp"])).alias("rest")))

    empty = F.array().cast("array<int>")
    begin = F.struct(empty.alias("done"), none.alias("base"), F.lit(0).alias("last"), empty.alias("rest"))
    whole = lambda s: F.concat(s["done"], F.when(s["base"].isNull(), empty).otherwise(F.array(s["base"])), s["rest"])
    composed = listed.select("key", "group", F.aggregate("l", begin, add, whole).alias("cps"))
    text_of = F.decode(F.unhex(F.array_join(F.transform(F.flatten(F.transform(F.sort_array(F.collect_list(F.struct("group", "cps"))), lambda g: g["cps"])), lambda c: F.lpad(F.hex(c), 8, "0")), "")), "UTF-32")
    forms = composed.groupBy("key").agg(text_of.alias(out))
    return df.select(F.col(key).alias("key"), F.col(text).alias("__text__")).join(forms, "key", "left").select(
        F.col("key").alias(key), F.coalesce(out, F.when(F.col("__text__").isNotNull(), F.lit(""))).alias(out)
    )


def classes(df: DataFrame, key: str, text: str) -> DataFrame:
    """For each row with a visible character its key, the digest of its text and that of its form (its class)."""
    name = "__text__"
    taken = df.where(F.col(text).isNotNull()).select(F.col(key).alias("key"), F.col(text).alias(name))

    def run(batches):
        for batch in batches:
            keys = batch.column(0)
            texts = batch.column(1).to_pylist()
            forms = normal_forms(texts)
            keep = [i for i, f in enumerate(forms) if f and not f.isspace()]
            digest = lambda t: hashlib.blake2b(t.encode("utf-8", "surrogatepass"), digest_size=16).digest()
            yield pa.RecordBatch.from_arrays(
                [
                    keys.take(pa.array(keep, pa.int64())),
                    pa.array([digest(texts[i]) for i in keep], pa.binary()),
                    pa.array([digest(forms[i]) for i in keep], pa.binary()),
                ],
                ["key", "variant", "class"],
            )

    return taken.mapInArrow(run, f"key {dict(taken.dtypes)['key']}, variant binary, class binary")


def lookalike_pairs(df: DataFrame, key: str, text: str) -> DataFrame:
    """Pairs of rows, smaller key first, whose texts look the same and differ in their code points.

    Rows without a visible character are in no pair. Texts equal in every code point are no pair:
    the variants of a class are paired with each other first and rows joined to the pairs after, so
    a group of equal copies costs no more than its rows. A key must name one row; a repeated row
    gives the same pair once.
    """
    rows = stored(classes(df, key, text))
    variants = rows.select("class", "variant").distinct()
    several = variants.groupBy("class").agg(F.count("*").alias("n")).where("n > 1").select("class")
    members = rows.join(several, "class", "left_semi")
    some = variants.join(several, "class", "left_semi")
    a = some.select("class", F.col("variant").alias("va"))
    b = some.select("class", F.col("variant").alias("vb"))
    pairs = a.join(b, "class").where(F.col("va") < F.col("vb"))
    left = members.select("class", F.col("variant").alias("va"), F.col("key").alias("ka"))
    right = members.select("class", F.col("variant").alias("vb"), F.col("key").alias("kb"))
    found = pairs.join(left, ["class", "va"]).join(right, ["class", "vb"])
    return found.select(F.least("ka", "kb").alias(f"{key}_a"), F.greatest("ka", "kb").alias(f"{key}_b")).distinct()
