"""URL normalisation (http/https only) and the outbound scheme allow-list."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidings.functions.text import py_strip

# An http(s) url as the item model accepts it: optional userinfo, a host without
# separators, an optional port of up to five digits, then anything starting with / ? or #.
HTTP_URL_PATTERN = r"(?i)\Ahttps?://([^/?#@\t\n\x0B\x0C\r ]*@)?[^/?#:@\t\n\x0B\x0C\r ]+(:[0-9]{1,5})?([/?#].*)?\z"
MAX_URL_LENGTH = 2083
SCHEME_PATTERN = r"\A[a-zA-Z][a-zA-Z0-9+.-]*://"

# Schemes allowed in outbound links.
ALLOWED_SCHEMES = ["http", "https", "mailto", "tg"]


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def _bind(value: Column, fn) -> Column:
    """Evaluate ``value`` once and pass it to ``fn`` as a lambda variable (keeps generated code small)."""
    return F.get(F.transform(F.array(value), fn), 0)


def normalize_url(col) -> Column:
    """Trim, repair ``//host`` and scheme-less values to https, accept http(s) only; else null.

    The accepted string is returned as given (no host lower-casing or slash added).
    """
    def on_raw(raw):
        def on_stripped(s):
            def on_fixed(s2):
                ok = s2.rlike(HTTP_URL_PATTERN) & (F.length(s2) <= MAX_URL_LENGTH)
                return F.when(raw.isNotNull() & (s != "") & ok, s2)

            s1 = F.when(s.startswith("//"), F.concat(F.lit("https:"), s)).otherwise(s)
            return _bind(s1, lambda v: on_fixed(F.when(v.rlike(SCHEME_PATTERN), v).otherwise(F.concat(F.lit("https://"), v))))

        return _bind(py_strip(raw), on_stripped)

    return _bind(_c(col).cast("string"), on_raw)


def url_key(col) -> Column:
    """Comparison key for stage-model urls: lower-case scheme and host, ``/`` after a bare host."""
    c = _c(col)
    scheme_host = F.lower(F.regexp_extract(c, r"\A([^:/?#]+://[^/?#]*)", 1))
    # the slash is put in by a replacement, so the rest is extracted once
    rest = F.regexp_replace(F.regexp_extract(c, r"\A[^:/?#]+://[^/?#]*(.*)\z", 1), r"\A(?!/)", "/")
    return F.when(c.isNull(), None).otherwise(F.concat(scheme_host, rest))


def safe_url(col) -> Column:
    """Empty for null/empty; a value with ``:`` keeps only the allowed schemes; else unchanged (trimmed)."""
    c = _c(col)
    v = py_strip(c)
    scheme = F.lower(F.split_part(v, F.lit(":"), F.lit(1)))
    return (
        F.when(c.isNull() | (c == ""), F.lit(""))
        .when(F.instr(v, ":") > 0, F.when(scheme.isin(*ALLOWED_SCHEMES), v).otherwise(F.lit("")))
        .otherwise(v)
    )
