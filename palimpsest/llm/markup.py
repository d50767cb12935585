"""Problem 3: markup residue in HTML values, and clean text that keeps their structure.

A value is flattened to text blocks, one for each run of text between block elements. A block is
described by its words, lines and link density, those of the blocks beside it, and the density of
groups of marks (for each word or line); what stands in code or pre elements is content and is
left out. Decision trees, one for each kind of markup, trained here on a small labelled table
(``markup_table``) in several surroundings, say which kinds a block holds: a bullet is a list only
together with others and where it isn't a menu of links, a number sign heads text but also counts
cells of a table, emphasis is thin in long prose that names fields. Blocks with kinds are read by a
reader for each of their kinds; escaped markup is unescaped and read as HTML again; the content of
inline code is set aside meanwhile and put back as it was.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from palimpsest.functions import html as H
from palimpsest.llm.markup_table import FILLERS, LABELLED

KINDS = ("markdown", "wiki", "latex", "escaped_html")
_CODE = frozenset(("code", "pre", "kbd", "samp", "script", "style", "textarea"))
_HEADINGS = {f"h{n}": n for n in range(1, 7)}
_DROPPED = frozenset(("script", "style", "noscript", "template", "head", "title", "textarea"))
#: Values whose blocks are held at once.
VALUES_AT_ONCE = 64
#: What stands for removed inline code in the text that is looked at.
HOLE = "\ufffc"


@dataclass
class Block:
    """A flat text block: its kind of element, its text, the same with a hole for each text in code, those texts, words,
    linked words, and whether it is code only."""

    element: str
    text: str
    plain: str
    held: list[str]
    words: int
    linked: int
    code: bool


def blocks(source: str | None) -> list[Block]:
    """Flat text blocks in order; blank ones are left out."""
    out: list[Block] = []
    stack: list[str] = []
    parts: list[str] = []
    plain: list[str] = []
    held: list[str] = []
    linked = 0
    element = ""

    def flush() -> None:
        nonlocal linked
        text, bare, kept = "".join(parts), "".join(plain), list(held)
        parts.clear()
        plain.clear()
        held.clear()
        n, linked = linked, 0
        if text.strip():
            code = not bare.replace(HOLE, "").strip()
            words = len(text.split())
            out.append(Block(element, text.strip("\n") if element == "pre" else text.strip(), bare.strip(), kept, words, min(n, words), code))

    for kind, name, raw in H.events(source or ""):
        if kind == "text":
            if any(s in _DROPPED for s in stack):
                continue
            text = H.unescape(raw)
            parts.append(text)
            if any(s in _CODE for s in stack):
                held.append(text)
                plain.append(HOLE)
            else:
                # a sign for holes in the text itself is set aside like code
                held += HOLE * text.count(HOLE)
                plain.append(text)
            if "a" in stack:
                linked += len(text.split())
        elif kind in ("start", "end", "void"):
            if name == "br":
                parts.append("\n")
                plain.append("\n")
                continue
            if name in H.BLOCK:
                flush()
            if kind == "start":
                stack.append(name)
            elif kind == "end" and name in stack:
                while stack.pop() != name:
                    pass
            if name in H.BLOCK:
                element = next((s for s in reversed(stack) if s in H.BLOCK), "")
    flush()
    return out


# Groups of marks: the kind they speak for, whether they are counted for each word or line, and their patterns.
MARKS = {
    "markdown_inline": (
        "word",
        r"\*\*[^\s*](?:[^*\n]*[^\s*])?\*\*",
        r"!?\[[^\]\n]+\]\([^)\s]+(?: \"[^\"\n]*\")?\)",
        r"(?<!`)`[^`\s](?:[^`\n]*[^`\s])?`(?!`)",
        r"(?<![\w_])__[^\s_](?:[^_\n]*[^\s_])?__(?![\w_])",
        r"~~[^\s~][^~\n]*~~",
    ),
    "markdown_emphasis": ("word", r"(?<![\w*])\*[^\s*](?:[^*\n]*[^\s*])?\*(?![\w*])", r"(?<![\w_])_[^\s_](?:[^_\n]*[^\s_])?_(?![\w_])"),
    "markdown_heading": ("line", r"(?m)^ {0,3}#{2,6} \S"),
    "markdown_title": ("line", r"(?m)^ {0,3}# \S"),
    "markdown_bullet": ("line", r"(?m)^ {0,3}(?:[-*+]|\d+\.) \S"),
    "markdown_block": ("line", r"(?m)^ {0,3}(?:```|~~~)", r"(?m)^ {0,3}\|?(?: *:?-{3,}:? *\|)+ *(?::?-{3,}:?)? *\|?$", r"(?m)^ {0,3}[-*+] \[[ xX]\] "),
    "markdown_quote": ("line", r"(?m)^ {0,3}> \S"),
    "wiki_inline": (
        "word",
        r"\[\[(?![A-Z]+_?\d+\]\])[^\[\]\n|]+(?:\|[^\[\]\n]*)*\]\]",
        r"'''[^'\n]+'''",
        r"\{\{[^{}\n]+(?:\|[^{}\n]*)*\}\}",
        r"\[https?://[^\s\]]+ [^\]\n]+\]",
    ),
    "wiki_emphasis": ("word", r"(?<!')''(?!')[^'\n]+''(?!')"),
    "wiki_heading": ("line", r"(?m)^ *={2,6} *[^=\n]+? *={2,6} *$"),
    "wiki_table": ("line", r"(?m)^ *\{\|"),
    "wiki_row": ("line", r"(?m)^ *[!|][^|\n]*(?:\|\||!!)", r"(?m)^ *\|[-}]"),
    "wiki_bullet": ("line", r"(?m)^[*#:;]{1,4} ?\S"),
    "latex_command": ("word", r"\\[a-zA-Z]+\*?(?:\[[^\]\n]*\])?\{[^{}\n]*\}"),
    "latex_word": ("word", r"(?<![\w\\:])\\(?:item|par|noindent|newline|ldots|cdot|times|leq|geq|alpha|beta|sum)\b", r"(?<![\w\\]) ?\w+[_^]\{[^}\n]*\}"),
    "latex_maths": ("word", r"\\\([^\n]+?\\\)", r"\\\[(?:.|\n)+?\\\]", r"\$\$(?:.|\n)+?\$\$", r"(?<!\\)\$[^$\n]*(?:\\[a-zA-Z]+|[_^]\{?\w)[^$\n]*\$"),
    "tag": ("word", r"</?[a-zA-Z][a-zA-Z0-9]*(?:\s+[a-zA-Z-]+(?:=(?:\"[^\"]*\"|'[^']*'|[^\s>]+))?)*\s*/?>", r"<!--.*?-->"),
    "entity": ("word", r"&(?:lt|gt|amp|quot|nbsp|#\d+|#x[0-9a-fA-F]+);"),
}
#: Signs of which each pattern of a group needs at least one.
NEEDED = {
    "markdown_inline": "*[`_~", "markdown_emphasis": "*_", "markdown_heading": "#", "markdown_title": "#", "markdown_bullet": "-*+.", "markdown_block": "`~|[",
    "markdown_quote": ">", "wiki_inline": "['{", "wiki_emphasis": "'", "wiki_heading": "=", "wiki_table": "{", "wiki_row": "|!", "wiki_bullet": "*#:;",
    "latex_command": "\\", "latex_word": "\\_^", "latex_maths": "\\$", "tag": "<", "entity": "&",
}
_MARKS = [(name == "tag", unit, NEEDED[name], [re.compile(p) for p in patterns]) for name, (unit, *patterns) in MARKS.items()]
_ANY = re.compile(r"[*_#`\[{\\$<>~&|=]|''|^\s*[-+] |\n\s*[-+] |\n\s*\d+\. ")
SURROUNDINGS = ("words", "lines", "link_density", "words_before", "words_behind", "links_before", "links_behind")
FEATURES = (*MARKS, *SURROUNDINGS)


def unescaped(text: str) -> str:
    """The text with character entities read until nothing changes; each time it gets shorter."""
    while (new := H.unescape(text)) != text:
        text = new
    return text


def densities(plain: str, words: int, lines: int) -> list[float]:
    """Marks of each group for each word or line, in the order of MARKS."""
    if not _ANY.search(plain):
        return [0.0] * len(_MARKS)
    of = {"word": max(words, 1), "line": max(lines, 1)}
    read = unescaped(plain)
    out = []
    for escaped, unit, needed, patterns in _MARKS:
        text = read if escaped else plain
        out.append(sum(len(p.findall(text)) for p in patterns) / of[unit] if any(c in text for c in needed) else 0.0)
    return out


def features(found: list[Block]) -> np.ndarray:
    """One row for each block."""
    out = np.zeros((len(found), len(FEATURES)))
    beside = [(0, 0.0), *((b.words, b.linked / max(b.words, 1)) for b in found), (0, 0.0)]
    for i, b in enumerate(found):
        lines = sum(1 for line in b.plain.split("\n") if line.strip())
        if not b.code:
            out[i, : len(MARKS)] = densities(b.plain, b.words, lines)
        (before, links_before), (words, links), (behind, links_behind) = beside[i : i + 3]
        out[i, len(MARKS) :] = (words, lines, links, before, behind, links_before, links_behind)
    return out


@dataclass
class Tree:
    """A node of a decision tree: a leaf holds its answer."""

    answer: bool
    feature: int = -1
    limit: float = 0.0
    low: Tree | None = None
    high: Tree | None = None

    def __call__(self, rows: np.ndarray) -> np.ndarray:
        """The answer for each row."""
        out = np.full(len(rows), self.answer)
        if self.feature >= 0 and len(rows):
            low = rows[:, self.feature] <= self.limit
            out[low], out[~low] = self.low(rows[low]), self.high(rows[~low])
        return out

    def used(self) -> set[str]:
        """The features it asks for."""
        return {FEATURES[self.feature]} | self.low.used() | self.high.used() if self.feature >= 0 else set()


def grow(rows: np.ndarray, answers: np.ndarray, depth: int = 12) -> Tree:
    """The tree of least Gini impurity at each split; ties take the earlier feature."""
    answer = bool(answers.mean() > 0.5) if len(answers) else False
    if depth == 0 or len(set(answers.tolist())) < 2:
        return Tree(answer)
    best = None
    for f in range(rows.shape[1]):
        values = np.unique(rows[:, f])
        for limit in (values[1:] + values[:-1]) / 2:
            low = rows[:, f] <= limit
            cost = sum(s.sum() * (1 - (p := answers[s].mean()) ** 2 - (1 - p) ** 2) for s in (low, ~low))
            if best is None or cost < best[0] - 1e-9:
                best = (cost, f, float(limit), low)
    if best is None:
        return Tree(answer)
    _, f, limit, low = best
    return Tree(answer, f, limit, grow(rows[low], answers[low], depth - 1), grow(rows[~low], answers[~low], depth - 1))


def training_rows(labelled=LABELLED) -> tuple[np.ndarray, list[str], list[int]]:
    """Features, kind and number of the labelled row of every block of the table, in each of the surroundings.

    A block of a row with a kind is of that kind if it has a mark at all.
    """
    rows, kinds, of = [], [], []
    for n, (source, kind) in enumerate(labelled):
        for before, behind in FILLERS:
            around = [len(blocks(x)) for x in (before, behind)]
            every = features(blocks(before + source + behind))
            for row in every[around[0] : len(every) - around[1]]:
                rows.append(row)
                kinds.append(kind if row[: len(MARKS)].any() else "")
                of.append(n)
    return np.array(rows), kinds, of


def grown(rows: np.ndarray, kinds: list[str]) -> dict[str, Tree]:
    """One tree for each kind."""
    return {k: grow(rows, np.array([x == k for x in kinds])) for k in KINDS}


@lru_cache(1)
def trees() -> dict[str, Tree]:
    """The trees of the labelled table."""
    rows, kinds, _ = training_rows()
    return grown(rows, kinds)


def held_out_accuracy(without: tuple[str, ...] = (), folds: int = 10) -> float:
    """Share of the blocks with a mark whose kinds are right by trees of the other folds' labelled rows, with the
    features named in ``without`` left out."""
    rows, kinds, of = training_rows()
    rows = rows.copy()
    rows[:, [FEATURES.index(f) for f in without]] = 0
    fold, marked = np.array(of) % folds, rows[:, : len(MARKS)].any(1)
    right = 0
    for f in range(folds):
        there = np.flatnonzero((fold == f) & marked)
        made = grown(rows[fold != f], [k for k, x in zip(kinds, fold) if x != f])
        said = {k: t(rows[there]) for k, t in made.items()}
        right += sum(all(said[k][j] == (kinds[i] == k) for k in KINDS) for j, i in enumerate(there))
    return right / int(marked.sum())


def kinds_of_all(values: list[list[Block]], known: dict[str, Tree] | None = None) -> list[list[list[str]]]:
    """The kinds of markup in each block of each value, by the trees of the labelled table or those given."""
    table = np.concatenate([np.zeros((0, len(FEATURES))), *map(features, values)])
    said = {k: tree(table).tolist() for k, tree in (known or trees()).items()}
    every = ([k for k in KINDS if said[k][i]] for i in range(len(table)))
    return [[next(every) for _ in found] for found in values]


def block_kinds(found: list[Block], known: dict[str, Tree] | None = None) -> list[list[str]]:
    """The kinds of markup in each block of one value."""
    return kinds_of_all([found], known)[0]


def residues_of(values: list[str | None], known: dict[str, Tree] | None = None) -> list[list[str]]:
    """The kinds of markup each value holds besides its HTML, in the order of KINDS; none for null and blank values."""
    out = []
    for at in range(0, len(values), VALUES_AT_ONCE):
        for kinds in kinds_of_all([blocks(v) for v in values[at : at + VALUES_AT_ONCE]], known):
            held = {k for ks in kinds for k in ks}
            out.append([k for k in KINDS if k in held])
    return out


def residue(source: str | None, known: dict[str, Tree] | None = None) -> list[str]:
    """The kinds of markup one value holds."""
    return residues_of([source], known)[0]


def _markdown(text: str) -> Iterator[tuple[str, str]]:
    fence: list[str] | None = None
    for line in text.split("\n"):
        if re.match(r"\s*(```|~~~)", line):
            if fence is None:
                fence = []
            else:
                yield "code", "\n".join(fence)
                fence = None
            continue
        if fence is not None:
            fence.append(line)
            continue
        if re.fullmatch(r"\s*\|?(\s*:?-{3,}:?\s*\|?)+\s*", line):
            continue
        kind = "text"
        line = re.sub(r"^\s*> ", "", line)
        if m := re.match(r"\s*(#{1,6}) (.*?)#*$", line):
            kind, line = f"heading{len(m[1])}", m[2]
        elif m := re.match(r"\s*(?:[-*+]|\d+\.) (.*)$", line):
            kind, line = "item", m[1]
        elif m := re.match(r"\s*\|(.*)\|\s*$", line):
            kind, line = "row", "\t".join(c.strip() for c in m[1].split("|"))
        line = re.sub(r"!?\[([^\]]+)\]\([^)\s]+[^)]*\)", r"\1", line)
        line = re.sub(r"(\*\*|__|~~)(?=\S)(.+?)(?<=\S)\1", r"\2", line)
        line = re.sub(r"(?<![\w*])\*([^\s*](?:[^*]*[^\s*])?)\*(?![\w*])", r"\1", line)
        line = re.sub(r"(?<![\w_])_([^\s_](?:[^_]*[^\s_])?)_(?![\w_])", r"\1", line)
        line = re.sub(r"(?<!`)`([^`]+)`(?!`)", r"\1", line)
        yield kind, line.strip()
    if fence:
        yield "code", "\n".join(fence)


def _wiki(text: str) -> Iterator[tuple[str, str]]:
    for line in text.split("\n"):
        if re.match(r"\s*(\{\||\|\}|\|-)", line):
            continue
        kind = "text"
        if m := re.fullmatch(r"\s*(={2,6})\s*(.+?)\s*=+\s*", line):
            kind, line = f"heading{len(m[1])}", m[2]
        elif m := re.match(r"\s*[!|](.*)$", line):
            kind, line = "row", "\t".join(c.strip() for c in re.split(r"\|\||!!", m[1]))
        elif m := re.match(r"[*#:;]+ ?(.*)$", line):
            kind, line = "item", m[1]
        line = re.sub(r"\[\[(?![A-Z]+_?\d+\]\])(?:[^\[\]|]*\|)*([^\[\]|]+)\]\]", r"\1", line)
        line = re.sub(r"\[https?://\S+ ([^\]]+)\]", r"\1", line)
        line = re.sub(r"\{\{[^{}|]+((?:\|[^{}]*)?)\}\}", lambda m: "; ".join(p.split("=", 1)[-1] for p in m[1].split("|") if p), line)
        yield kind, re.sub(r"'{2,5}", "", line).strip()


#: Commands that stand for a sign; other words of LATEX_WORDS only lay out.
LATEX_SIGNS = {"ldots": "…", "cdot": "·", "times": "×", "leq": "≤", "geq": "≥", "alpha": "α", "beta": "β", "sum": "Σ"}
LATEX_WORDS = ("item", "par", "noindent", "newline", *LATEX_SIGNS)
_COMMAND = re.compile(rf"(?<![\w\\:])\\({'|'.join(LATEX_WORDS)})\b ?")


def _latex(text: str) -> Iterator[tuple[str, str]]:
    text = re.sub(r"\\\[((?:.|\n)+?)\\\]|\$\$((?:.|\n)+?)\$\$", lambda m: f"\n$${(m[1] or m[2]).strip()}$$\n", text)
    text = re.sub(r"\\\((.+?)\\\)", lambda m: f"${m[1].strip()}$", text)
    for line in text.split("\n"):
        if re.match(r"\s*\\(begin|end)\{", line):
            continue
        if m := re.match(r"\s*\$\$(.+)\$\$\s*$", line):
            yield "formula", m[1]
            continue
        kind = "text"
        if m := re.match(r"\s*\\(section|subsection|subsubsection|chapter)\*?\{(.+)\}\s*$", line):
            kind, line = f"heading{('chapter', 'section', 'subsection', 'subsubsection').index(m[1]) + 1}", m[2]
        elif m := re.match(r"\s*\\item\b ?(.*)$", line):
            kind, line = "item", m[1]
        parts = re.split(r"(\$[^$]*\$)", line)
        for i in range(0, len(parts), 2):
            for _ in range(4):
                parts[i] = re.sub(r"\\[a-zA-Z]+\*?(?:\[[^\]]*\])?\{([^{}]*)\}", r"\1", parts[i])
            parts[i] = _COMMAND.sub(lambda m: LATEX_SIGNS.get(m[1], ""), parts[i])
            parts[i] = re.sub(r"(?<![\w\\])(\w+)[_^]\{([^}]*)\}", r"\1\2", parts[i])
        yield kind, "".join(parts).strip()


_READERS = {"markdown": _markdown, "wiki": _wiki, "latex": _latex}


def _read(block: Block, kinds: list[str], kind: str, known: dict[str, Tree] | None) -> list[tuple[str, str]]:
    """The parts of a block that holds markup, with its holes."""
    if len(kinds) > 1 and "\n\n" in block.plain:
        return [p for part in re.split(r"\n{2,}", block.plain) for p in clean(H.escape(part), known)]
    if "escaped_html" in kinds:
        return clean(unescaped(block.plain), known)
    parts = [(kind, block.plain)]
    for k in kinds:
        new = []
        for own, text in parts:
            if own in ("code", "formula"):
                new.append((own, text))
            else:
                new += [(own if found == "text" else found, t) for found, t in _READERS[k](text)]
        parts = new
    return parts


def clean(source: str | None, known: dict[str, Tree] | None = None) -> list[tuple[str, str]]:
    """(kind, text) of the parts of a value: heading1-6, item, code, formula, row, text; no markup is left in them but
    what stands in code, which is kept as it is."""
    out: list[tuple[str, str]] = []
    found = blocks(source)
    for block, kinds in zip(found, block_kinds(found, known)):
        kind = f"heading{_HEADINGS[block.element]}" if block.element in _HEADINGS else "item" if block.element == "li" else "row" if block.element in ("td", "th") else "text"
        if block.code:
            out.append(("code", block.text))
            continue
        parts = _read(block, kinds, kind, known) if kinds else [(kind, re.sub(r"\s+", " ", block.plain).strip())]
        held = iter(block.held)
        parts = [(k, "".join(next(held, "") if c == HOLE else c for c in t) if HOLE in t else t) for k, t in parts if t]
        out += parts
    return out


def rendered(parts: list[tuple[str, str]]) -> str:
    """Parts as lines: headings with number signs, items with dashes, code indented by four, formulas in dollar signs."""
    out = []
    for kind, text in parts:
        if kind.startswith("heading"):
            out.append("#" * int(kind[-1]) + " " + text)
        elif kind == "item":
            out.append("- " + text)
        elif kind == "code":
            out.append("\n".join("    " + line for line in text.split("\n")))
        elif kind == "formula":
            out.append(f"$${text}$$")
        else:
            out.append(text)
    return "\n".join(out)


def with_clean_text(df: DataFrame, html: str, keep: list[str]) -> DataFrame:
    """The kept columns, the kinds of residue and the clean text of each value; an empty list and null for null."""
    name = "__html__"
    taken = df.select(*keep, F.col(html).alias(name))
    schema = ", ".join(f"`{c}` {t}" for c, t in taken.dtypes if c != name) + ", kinds array<string>, clean_text string"
    known = trees()  # grown once, here

    def run(batches):
        for batch in batches:
            at = batch.schema.get_field_index
            values = batch.column(at(name)).to_pylist()
            kinds = residues_of(values, known)
            texts = [None if v is None else rendered(clean(v, known)) for v in values]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(at(k)) for k in keep), pa.array(kinds, pa.list_(pa.string())), pa.array(texts, pa.string())],
                [*keep, "kinds", "clean_text"],
            )

    return taken.mapInArrow(run, schema)


def residues(df: DataFrame, fields: list[str], keys: list[str]) -> DataFrame:
    """field, keys and markup: one row for each kind of residue in each field of a row.

    Null and blank values have none; repeated rows give one row; extra columns are not read.
    """
    taken = df.select(*keys, *fields)
    kinds = dict(taken.dtypes)
    schema = "field string, " + ", ".join(f"`{k}` {kinds[k]}" for k in keys) + ", markup string"
    known = trees()  # grown once, here

    def run(batches):
        for batch in batches:
            at = batch.schema.get_field_index
            for f in fields:
                rows = [(i, k) for i, held in enumerate(residues_of(batch.column(at(f)).to_pylist(), known)) for k in held]
                take = pa.array([i for i, _ in rows], pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [pa.array([f] * len(rows), pa.string()), *(batch.column(at(k)).take(take) for k in keys), pa.array([k for _, k in rows], pa.string())],
                    ["field", *keys, "markup"],
                )

    return taken.mapInArrow(run, schema).distinct()
