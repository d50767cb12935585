"""The patterns, word lists and limits that decide what a fact, a marker or a block is.

They define results and so stand here as they must be, one profile for each family of operators.
Patterns are written for Java, where they run as column expressions, and for Python alike.
"""

from __future__ import annotations

MONTH = "Jan(?:uary)?|Feb(?:ruary)?|Mar(?:ch)?|Apr(?:il)?|May|Jun(?:e)?|Jul(?:y)?|Aug(?:ust)?|Sep(?:tember)?|Oct(?:ober)?|Nov(?:ember)?|Dec(?:ember)?"
FULL_MONTH = "January|February|March|April|May|June|July|August|September|October|November|December"

#: Kinds of protected values, in order; the flag says whether case matters.
SIGNALS: tuple[tuple[str, str, bool], ...] = (
    ("url", r"https?://[^\s<>()]+", False),
    ("email", r"\b[A-Z0-9._%+-]+@[A-Z0-9.-]+\.[A-Z]{2,}\b", False),
    ("currency", r"(?:USD|EUR|GBP|CHF|SEK|NOK|DKK)\s?\d[\d,.\s]*|[$€£]\s?\d[\d,.\s]*", False),
    ("percent", r"\b\d+(?:[.,]\d+)?\s?%", False),
    ("date_iso", r"\b\d{4}-\d{2}-\d{2}\b", True),
    ("date_slash", r"\b\d{1,2}[/-]\d{1,2}[/-]\d{2,4}\b", True),
    ("date_text", rf"\b(?:{MONTH})\s+\d{{1,2}},\s+\d{{4}}\b|\b\d{{1,2}}\s+(?:{FULL_MONTH})\s+\d{{4}}\b", False),
    ("code", r"\b[A-Z]{2,}(?:[-_/][A-Z0-9]{2,})+\b", True),
    ("modal", r"\b(?:must not|shall not|may not|must|shall|may|should|will|can|cannot)\b", False),
    ("number", r"\b\d[\d,]*(?:\.\d+)?\b", True),
)

#: Kinds of invariants of a text.
INVARIANTS: tuple[tuple[str, str, bool], ...] = (
    ("numbers", r"\b\d[\d,]*(?:\.\d+)?\b", True),
    ("currencies", r"(?:[$€£]\s?\d[\d,]*(?:\.\d+)?|\b(?:USD|EUR|GBP)\s?\d[\d,]*(?:\.\d+)?)", False),
    ("percentages", r"\b\d+(?:\.\d+)?\s?%", True),
    (
        "dates",
        r"\b(?:\d{4}-\d{2}-\d{2}|\d{1,2}/\d{1,2}/\d{2,4}|(?:Jan|Feb|Mar|Apr|May|Jun|Jul|Aug|Sep|Oct|Nov|Dec)[a-z]*\s+\d{1,2},?\s+\d{4})\b",
        False,
    ),
    ("urls", r"https?://[^\s<>'\"]+", False),
    (
        "ids",
        r"\b(?:[A-Z]{2}\d{2}[A-Z0-9]{10,30}|[A-Z]{1,5}-\d{3,}|(?:ID|ACCOUNT|ACCT|REF|REFERENCE|TICKET|CASE|CUSIP|ISIN|IBAN|SWIFT)[:#\s-]*[A-Z0-9-]{3,})\b",
        False,
    ),
    (
        "product_names",
        r"\b(?:[A-Z][A-Za-z0-9&/-]+(?:\s+[A-Z][A-Za-z0-9&/-]+){0,4}\s+(?:Account|Card|Loan|Mortgage|Fund|Plan|Policy|ETF|IRA|CD|Bond|Note))\b",
        True,
    ),
)
#: An identifier in the strict sense: the key word is followed by a sign and a value with a digit.
STRICT_ID = r"\b(?:[A-Z]{2}\d{2}[A-Z0-9]{10,30}|[A-Z]{1,5}-\d{3,}|(?:ID|ACCOUNT|ACCT|REF|REFERENCE|TICKET|CASE|CUSIP|ISIN|IBAN|SWIFT)[:#\s-]+(?=[A-Z-]*\d)[A-Z0-9-]{3,})\b"

DISCLOSURE = r"\b(?:disclaimer|not\s+investment\s+advice|for\s+informational\s+purposes\s+only|past\s+performance|subject\s+to\s+change|terms\s+and\s+conditions)\b"
RATE_WORD = r"\b(?:apr|apy|interest\s+rate|fixed\s+rate|variable\s+rate|basis\s+points?|bps)\b"
AMOUNT_WORD = r"\b(?:amount|balance|principal|payment|fee|charge|limit|minimum|maximum)\b"

_NUM = r"(?:(?:\d{1,3}(?:,\d{3})+|\d+)(?:\.\d+)?|\.\d+)"
#: Kinds of numeric items, by priority.
NUMERICS: tuple[tuple[str, str, bool], ...] = (
    ("currency_amount", r"(?<!\w)[€$£¥]\s?[+-]?(?:\d{1,3}(?:,\d{3})+|\d+)(?:\.\d+)?(?!\w)", True),
    ("percentage", rf"(?<![\w/.-])[+-]?{_NUM}%(?![\w.-])", True),
    ("range", rf"(?<![\w/.-])[+-]?{_NUM}\s?(?:to|-|–|—)\s?[+-]?{_NUM}%?(?![\w.-])", True),
    (
        "duration_or_limit",
        rf"(?<![\w/.-])[+-]?{_NUM}\s+(?:day|days|business day|business days|week|weeks|month|months|year|years|hour|hours|minute|minutes)(?![\w.-])",
        False,
    ),
    ("plain_number", rf"(?<![\w/.-])[+-]?{_NUM}(?![\w.-])", True),
)

SENTENCE_END = r"(?<=[.!?])\s+"
CONNECTIVE_START = r"^(however|therefore|moreover|additionally|furthermore|in addition)\b"
PRONOUN_STARTS = ("this", "these", "it", "they", "such")

# Tags.
PROTECTED_ANCESTORS = ("b", "strong", "code", "pre", "kbd", "samp", "var", "a", "script", "style", "abbr", "acronym")
SKIPPED_PARENTS = ("head", "html", "meta", "link", "script", "style", "title")
BOLD = ("b", "strong")
APPROVED = ("p", "li")
HEADINGS = ("h1", "h2", "h3", "h4", "h5", "h6")
HIGH_RISK = ("table", "code", "pre")
NON_EDITABLE = ("head", "meta", "link", "script", "style", "code", "pre", "title", "noscript", "textarea", "svg", "math")
FROZEN_CONTAINERS = ("blockquote", "caption", "th", "td")
UNSEEN = ("script", "style", "noscript", "template")
LEAF_BLOCKS = ("p", "li", "th", "td", "caption", *HEADINGS)
TEXT_CONTAINERS = ("p", "li", "td", "th", "caption", "figcaption", "dt", "dd", "summary", "blockquote", "label", *HEADINGS)
INLINE = (
    "a", "abbr", "b", "bdi", "bdo", "cite", "code", "data", "del", "dfn", "em", "i", "ins", "kbd", "mark", "q", "s", "samp", "small",
    "span", "strong", "sub", "sup", "time", "u", "var",
)
DISPLAY = ("br", "img", "input", "wbr", "hr")
NEVER_EDIT = ("script", "style", "noscript", "template", "svg", "math", "iframe", "textarea", "head", "title", "pre", "code")

# Limits.
MIN_BLOCK_CHARS, MAX_BLOCK_CHARS = 20, 3500
MIN_DOCUMENT_CHARS = 2000
LENGTH_RATIO = (0.65, 1.35)
CONTEXT_CHARS, PREVIOUS_SEGMENTS, NEXT_SEGMENTS = 1200, 2, 1
SEGMENT_CHARS, TARGET_CHARS, HARD_CHARS = 12_000, 3_500, 5_000
POLISH_CHARS = 120
CONTEXT_WIDTH = 35
MAX_MAP_ITEMS = 50
PROMPT_RESERVE = 2_000

# Tokens.
IMMUTABLE = "[[IMM_{:03d}]]"
INLINE_TOKEN = r"⟦/?(\d+)⟧"
GLOBAL_TOKEN = r"⟦HTML_TAG_\d{6}⟧"
MARKER = r"⟦(?:KEEP_\d+_(?:START|END)|TAG_\d+_(?:START|END)|EMPTY_\d+)⟧"
PARAGRAPH_MARKER = r"\[\[P(\d+)\]\]"

MODALITY_RANK = {"none": 0, "optional": 1, "may": 2, "should": 3, "required": 4, "must": 5, "prohibited": 5}
SEVERITY_RANK = {"low": 1, "medium": 2, "high": 3, "critical": 4}


def flagged(pattern: str, case: bool) -> str:
    """The pattern with case ignored where case doesn't matter."""
    return pattern if case else f"(?i){pattern}"
