"""DuckDB SQL twins of the column functions, used only to state the oracles."""

from __future__ import annotations

from tidings.functions.text import CONTROL_CHARS, PY_WHITESPACE, REDACTION_RULES, STRATEGIC_PREFIX
from tidings.functions.urls import ALLOWED_SCHEMES, HTTP_URL_PATTERN, MAX_URL_LENGTH, SCHEME_PATTERN


# HTML to text as a chain of rewrites, for the tags and entities that the driver's pages have: another way than the
# library's tokeniser, with the same result on them.
_HTML_RULES = [
    (r"(?is)<!--.*?-->", ""),
    (r"(?is)<head[^>]*>.*?</head>", ""),
    (r"(?is)<script[^>]*>.*?</script>", ""),
    (r"(?is)<style[^>]*>.*?</style>", ""),
    (r"(?is)<img[^>]*>", ""),
    (r"(?is)<a\s[^>]*?href=\"([^\"]*)\"[^>]*>(.*?)</a>", "[$2]($1)"),
    (r"(?i)<br\s*/?>", "\n"),
    (r"(?i)<h1[^>]*>", "\n\n# "),
    (r"(?i)<h2[^>]*>", "\n\n## "),
    (r"(?i)<h3[^>]*>", "\n\n### "),
    (r"(?i)<h[4-6][^>]*>", "\n\n#### "),
    (r"(?i)</h[1-6]>", "\n\n"),
    (r"(?i)</?(b|strong)>", "**"),
    (r"(?i)</?(i|em)>", "_"),
    (r"(?i)<li[^>]*>", "\n  * "),
    (r"(?i)</?(p|div|article|section|ul|ol|nav|header|footer|main|aside|table|tr|blockquote)[^>]*>", "\n\n"),
    (r"(?s)<[^>]*>", ""),
    (r"&nbsp;", " "),
    (r"&copy;", "©"),
    (r"&middot;", "·"),
    (r"&lt;", "<"),
    (r"&gt;", ">"),
    (r"&quot;", "\""),
    (r"&#39;", "'"),
    (r"&amp;", "&"),
    (r"[ \t]+\n", "\n"),
    (r"\n{3,}", "\n\n"),
]


def lit(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def _rep(r: str) -> str:
    return r.replace("$1", "\\1").replace("$2", "\\2")


def rr(expr: str, pat: str, rep: str) -> str:
    return f"regexp_replace({expr}, {lit(pat)}, {lit(_rep(rep))}, 'g')"


def py_strip(e: str) -> str:
    return rr(e, rf"\A{PY_WHITESPACE}+|{PY_WHITESPACE}+\z", "")


def py_lstrip(e: str) -> str:
    return rr(e, rf"\A{PY_WHITESPACE}+", "")


def strip_escapes(e: str) -> str:
    e = rr(e, r"\\(x[0-9a-fA-F]{2}|u[0-9a-fA-F]{4})", r" $1")
    e = rr(e, r"\\[xu]", " ")
    return f"replace({e}, '\\', ' ')"


def strip_control(e: str) -> str:
    return rr(e, CONTROL_CHARS, "")


def clean_for_embedding(e: str) -> str:
    return py_strip(strip_control(strip_escapes(f"CAST({e} AS VARCHAR)")))


def clean_html(e: str) -> str:
    e = f"coalesce({e}, '')"
    for pat, rep in _HTML_RULES:
        e = rr(e, pat, rep)
    return py_strip(e)


def normalize_url(e: str) -> str:
    s = py_strip(f"CAST({e} AS VARCHAR)")
    s1 = f"(CASE WHEN starts_with({s}, '//') THEN 'https:' || {s} ELSE {s} END)"
    s2 = f"(CASE WHEN regexp_matches({s1}, {lit(SCHEME_PATTERN)}) THEN {s1} ELSE 'https://' || {s1} END)"
    return (f"(CASE WHEN {e} IS NOT NULL AND {s} <> '' AND regexp_matches({s2}, {lit(HTTP_URL_PATTERN)}) "
            f"AND length({s2}) <= {MAX_URL_LENGTH} THEN {s2} END)")


def safe_url(e: str) -> str:
    v = py_strip(e)
    allowed = ", ".join(lit(x) for x in ALLOWED_SCHEMES)
    return (f"(CASE WHEN {e} IS NULL OR {e} = '' THEN '' WHEN strpos({v}, ':') > 0 THEN "
            f"(CASE WHEN lower(split_part({v}, ':', 1)) IN ({allowed}) THEN {v} ELSE '' END) ELSE {v} END)")


def parse_ts(e: str) -> str:
    """ISO values by DuckDB's own cast, mail dates by its formats, after the zone name is spelt as an offset."""
    s = py_strip(e)
    mail = rr(s, r"^[A-Za-z]{3}, *", "")
    for name, off in (("GMT", "+0000"), ("EST", "-0500")):
        mail = f"replace({mail}, ' {name}', ' {off}')"
    formats = ", ".join(lit(f) for f in ("%d %b %Y %H:%M:%S %z", "%d %b %Y %H:%M %z"))
    return (f"(CASE WHEN {e} IS NULL OR {s} = '' THEN NULL WHEN regexp_matches({s}, '^[0-9][0-9][0-9][0-9]-') "
            f"THEN try_cast({s} AS TIMESTAMPTZ) ELSE try_strptime({mail}, [{formats}]) END)")


def redact(e: str) -> str:
    for pat, rep in REDACTION_RULES:
        e = rr(e, "(?i)" + pat, rep)
    return e


def sanitize_topic_id(e: str) -> str:
    core = rr(e, r"\A(cluster-)+", "")
    return (f"(CASE WHEN {e} IS NULL OR {e} = '' THEN 'cluster-0' ELSE "
            f"'cluster-' || (CASE WHEN {core} = '' THEN '0' ELSE {core} END) END)")


def safe_segment(e: str) -> str:
    s = rr(e, r"[^\p{L}\p{N}_-]", "-")
    return f"(CASE WHEN {s} = '' THEN 'cluster' ELSE {s} END)"


def flag_headline(h: str, strategic: str) -> str:
    s = py_strip(h)
    return f"(CASE WHEN {strategic} AND NOT starts_with({s}, {lit(STRATEGIC_PREFIX)}) THEN {lit(STRATEGIC_PREFIX)} || {s} ELSE {s} END)"


def approx_tokens(e: str, cpt: float = 4.0) -> str:
    return f"greatest(1, CAST(ceil(length({e}) / {float(cpt)}) AS INTEGER))"
