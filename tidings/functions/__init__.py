"""Column expressions (all built-in Spark functions; no UDFs)."""

from tidings.functions.text import (  # noqa: F401
    approx_tokens,
    clean_for_embedding,
    flag_headline,
    py_strip,
    redact,
    repair_utf8,
    safe_segment,
    sanitize_topic_id,
    strip_control,
    strip_escapes,
    truncate_for_model,
)
from tidings.functions.urls import normalize_url, safe_url  # noqa: F401
from tidings.functions.timefmt import coerce_ts, parse_ts  # noqa: F401
from tidings.functions.html import clean_html  # noqa: F401
from tidings.functions.scores import max_bullets, raw_total, weighted_total  # noqa: F401
