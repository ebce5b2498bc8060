"""Text cleaning, truncation, token estimates, redaction and id helpers as Column expressions."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

# The characters Python's str.strip() treats as whitespace, written in a regex syntax
# that both Java regex and RE2 accept.
PY_WHITESPACE = (
    r"[\t\n\x0B\x0C\r\x1C-\x1F \x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]"
)

# The same characters one by one.
PY_SPACES = "".join(map(chr, [*range(0x09, 0x0E), *range(0x1C, 0x21), 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]))

# Control characters removed before embedding (everything below 32 except \t \n \r).
CONTROL_CHARS = r"[\x00-\x08\x0B\x0C\x0E-\x1F]"

# Secret patterns, applied in this order, case-insensitive (pattern, replacement).
REDACTION_RULES = [
    (r"x-access-token:[^@]+@", "x-access-token:***@"),
    (r"ghp_[A-Za-z0-9]{20,}", "ghp_***"),
    (r"sk-[A-Za-z0-9-]{10,}", "sk-***"),
    (r"(api_key=)([^\s&]+)", "$1***"),
    (r"(password=)([^\s&]+)", "$1***"),
    (r"(token=)([^\s&]+)", "$1***"),
    (r"(bearer\s+)[A-Za-z0-9._-]+", "$1***"),
]

# Defaults of the embedding request budget.
MAX_BATCH_TOKENS = 8192
MAX_ITEM_CHARS = 6000
CHARS_PER_TOKEN = 4.0

# The headline prefix of strategic topics.
STRATEGIC_PREFIX = "【Strategic/Risk】"


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def py_strip(col) -> Column:
    """Strip leading and trailing whitespace the way Python's ``str.strip()`` does."""
    return F.regexp_replace(_c(col), rf"\A{PY_WHITESPACE}+|{PY_WHITESPACE}+\z", "")


def py_strip_valid(col) -> Column:
    """:func:`py_strip` of valid UTF-8 (whatever a string function has made): by characters, without a regex over the whole text."""
    return F.btrim(_c(col), F.lit(PY_SPACES))


def py_lstrip(col) -> Column:
    return F.regexp_replace(_c(col), rf"\A{PY_WHITESPACE}+", "")


def repair_utf8(col) -> Column:
    """Any value to a valid UTF-8 string; invalid byte sequences become U+FFFD."""
    return F.make_valid_utf8(_c(col).cast("string"))


def strip_escapes(col) -> Column:
    r"""``\x`` without two hex digits and ``\u`` without four become a space, then every backslash a space."""
    c = F.regexp_replace(_c(col), r"\\x(?![0-9a-fA-F]{2})", " ")
    c = F.regexp_replace(c, r"\\u(?![0-9a-fA-F]{4})", " ")
    return F.regexp_replace(c, r"\\", " ")


def strip_control(col) -> Column:
    """Drop code points below 32 except tab, newline and carriage return (DEL and C1 stay)."""
    return F.regexp_replace(_c(col), CONTROL_CHARS, "")


def clean_for_embedding(col) -> Column:
    return py_strip(strip_control(strip_escapes(repair_utf8(col))))


def effective_char_limit(max_item_chars: int = MAX_ITEM_CHARS, max_batch_tokens: int = MAX_BATCH_TOKENS,
                         chars_per_token: float = CHARS_PER_TOKEN) -> int:
    max_batch_tokens = max(1, max_batch_tokens)
    chars_per_token = max(0.1, chars_per_token)
    limit = max(1, int(max_batch_tokens * chars_per_token))
    if max_item_chars > 0:
        limit = min(max_item_chars, limit)
    return limit


def truncate_for_model(col, max_item_chars: int = MAX_ITEM_CHARS, max_batch_tokens: int = MAX_BATCH_TOKENS,
                       chars_per_token: float = CHARS_PER_TOKEN) -> Column:
    """Cut to the effective per-item character limit (code points, like Python slicing)."""
    return F.substring(_c(col), 1, effective_char_limit(max_item_chars, max_batch_tokens, chars_per_token))


def approx_tokens(col, chars_per_token: float = CHARS_PER_TOKEN) -> Column:
    """``max(1, ceil(len / chars_per_token))`` as int."""
    cpt = max(0.1, chars_per_token)
    return F.greatest(F.lit(1), F.ceil(F.length(_c(col)).cast("double") / F.lit(float(cpt))).cast("int"))


def redact(col, literals: list[str] | tuple[str, ...] = ()) -> Column:
    """Mask named secret values (longer than 3 chars) and the fixed secret patterns, in order."""
    c = _c(col)
    for v in literals:
        if v and len(v) > 3:
            c = F.replace(c, F.lit(v), F.lit("***"))
    for pat, rep in REDACTION_RULES:
        c = F.regexp_replace(c, "(?i)" + pat, rep)
    return c


def sanitize_topic_id(col) -> Column:
    """Strip every leading ``cluster-``, empty becomes ``0``, prefix once."""
    c = _c(col)
    core = F.regexp_replace(c, r"\A(cluster-)+", "")
    return F.when(c.isNull() | (c == ""), F.lit("cluster-0")).otherwise(
        F.concat(F.lit("cluster-"), F.when(core == "", F.lit("0")).otherwise(core))
    )


def safe_segment(col) -> Column:
    """Characters other than letters, digits, ``-`` and ``_`` become ``-``; empty becomes ``cluster``."""
    s = F.regexp_replace(_c(col), r"[^\p{L}\p{N}_-]", "-")
    return F.when(s == "", F.lit("cluster")).otherwise(s)


def flag_headline(headline, strategic) -> Column:
    h = py_strip(headline)
    return F.when(_c(strategic) & ~h.startswith(STRATEGIC_PREFIX), F.concat(F.lit(STRATEGIC_PREFIX), h)).otherwise(h)
