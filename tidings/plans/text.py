"""Registered scalar-function queries over whole texts of ``documents`` and ``pages``.

Dirt the tables lack (backslash escapes, control characters, secrets, odd urls) is planted into every
row from the row's own columns, identically in the oracle.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from tidings.functions import (
    approx_tokens,
    clean_for_embedding,
    clean_html,
    flag_headline,
    normalize_url,
    redact,
    repair_utf8,
    safe_segment,
    safe_url,
    sanitize_topic_id,
    strip_control,
    strip_escapes,
    truncate_for_model,
)
from tidings.plans import sqlfrag as S
from tidings.plans.registry import register
from tidings.tables import read


def _docs(spark, sf):
    return read(spark, sf, "documents")


def _planted_escapes(text, md5):
    return F.concat(text, F.lit(" \\x"), F.substring(md5, 1, 2), F.lit(" \\u"), F.substring(md5, 3, 3),
                    F.lit(" \\x"), F.substring(md5, 6, 1), F.lit("z \\u"), F.substring(md5, 7, 4),
                    F.lit(" C:\\dir\\file \\\\x41"))


SQL_ESC = ("text || ' \\x' || substr(md5(text), 1, 2) || ' \\u' || substr(md5(text), 3, 3) || ' \\x' || "
           "substr(md5(text), 6, 1) || 'z \\u' || substr(md5(text), 7, 4) || ' C:\\dir\\file \\\\x41'")


def _planted_control(text):
    return F.concat(F.lit(" \t"), text, F.char(F.lit(1)), F.lit("\t"), F.char(F.lit(27)), F.char(F.lit(127)),
                    F.char(F.lit(11)), F.lit("end\r\n"), F.char(F.lit(31)), F.lit(" \n"))


SQL_CTRL = "' \t' || text || chr(1) || '\t' || chr(27) || chr(127) || chr(11) || 'end\r\n' || chr(31) || ' \n'"


@register("strip_escapes", f"""
SELECT doc_id, md5(r) AS text_md5, length(r)::INTEGER AS n_chars, right(r, 40) AS tail
FROM (SELECT doc_id, {S.strip_escapes(SQL_ESC)} AS r FROM documents)""")
def q_strip_escapes(spark, sf):
    d = _docs(spark, sf)
    r = strip_escapes(_planted_escapes(F.col("text"), F.md5("text")))
    return d.select("doc_id", r.alias("r")).select("doc_id", F.md5("r").alias("text_md5"), F.length("r").alias("n_chars"),
                                                  F.right("r", F.lit(40)).alias("tail"))


@register("strip_control", f"""
SELECT doc_id, md5(r) AS text_md5, length(r)::INTEGER AS n_chars
FROM (SELECT doc_id, {S.strip_control(SQL_CTRL)} AS r FROM documents)""")
def q_strip_control(spark, sf):
    r = strip_control(_planted_control(F.col("text")))
    return _docs(spark, sf).select("doc_id", r.alias("r")).select("doc_id", F.md5("r").alias("text_md5"),
                                                                 F.length("r").alias("n_chars"))


@register("clean_for_embedding", f"""
SELECT doc_id, md5(r) AS text_md5, length(r)::INTEGER AS n_chars
FROM (SELECT doc_id, {S.clean_for_embedding(SQL_CTRL.replace('text', '(' + SQL_ESC + ')', 1))} AS r FROM documents)""")
def q_clean_for_embedding(spark, sf):
    r = clean_for_embedding(_planted_control(_planted_escapes(F.col("text"), F.md5("text"))))
    return _docs(spark, sf).select("doc_id", r.alias("r")).select("doc_id", F.md5("r").alias("text_md5"),
                                                                 F.length("r").alias("n_chars"))


@register("truncate_texts", """
SELECT doc_id, length(t)::INTEGER AS n_chars, md5(t) AS text_md5, (length(text) > 6000)::INTEGER AS truncated
FROM (SELECT doc_id, text, substring(text, 1, 6000) AS t FROM documents)""")
def q_truncate_texts(spark, sf):
    t = truncate_for_model(F.col("text"))
    return _docs(spark, sf).select("doc_id", "text", t.alias("t")).select(
        "doc_id", F.length("t").alias("n_chars"), F.md5("t").alias("text_md5"),
        (F.length("text") > 6000).cast("int").alias("truncated"))


@register("approx_tokens", f"""
SELECT doc_id, {S.approx_tokens('text')} AS tokens, {S.approx_tokens('text', 2.5)} AS tokens_dense
FROM documents""")
def q_approx_tokens(spark, sf):
    return _docs(spark, sf).select("doc_id", approx_tokens("text").alias("tokens"),
                                   approx_tokens("text", 2.5).alias("tokens_dense"))


@register("redact_secrets", f"""
SELECT doc_id, md5(r) AS text_md5, length(r)::INTEGER AS n_chars, right(r, 160) AS tail
FROM (SELECT doc_id, {S.redact("text || ' token=' || md5(text) || '&x=1 GHP_' || md5(text) || ' api_key=' || substr(md5(text), 1, 8) || ' Password=hunter' || doc_id || ' Bearer ' || md5(text) || '.x_y-z https://x-access-token:' || substr(md5(text), 1, 12) || '@github.com/r sk-' || substr(md5(text), 1, 14)")} AS r FROM documents)""")
def q_redact_secrets(spark, sf):
    m = F.md5("text")
    planted = F.concat(F.col("text"), F.lit(" token="), m, F.lit("&x=1 GHP_"), m, F.lit(" api_key="), F.substring(m, 1, 8),
                       F.lit(" Password=hunter"), F.col("doc_id").cast("string"), F.lit(" Bearer "), m,
                       F.lit(".x_y-z https://x-access-token:"), F.substring(m, 1, 12), F.lit("@github.com/r sk-"),
                       F.substring(m, 1, 14))
    r = redact(planted)
    return _docs(spark, sf).select("doc_id", r.alias("r")).select(
        "doc_id", F.md5("r").alias("text_md5"), F.length("r").alias("n_chars"), F.right("r", F.lit(160)).alias("tail"))


@register("sanitize_topic_ids", f"""
SELECT doc_id, raw, {S.sanitize_topic_id('raw')} AS topic_id FROM (
  SELECT doc_id, CASE doc_id % 5 WHEN 0 THEN 'cluster-cluster-' || lang WHEN 1 THEN '' WHEN 2 THEN 'cluster-'
                  WHEN 3 THEN lang || '-' || source ELSE 'cluster-' || source END AS raw FROM documents)""")
def q_sanitize_topic_ids(spark, sf):
    m = F.col("doc_id") % 5
    raw = (F.when(m == 0, F.concat(F.lit("cluster-cluster-"), "lang")).when(m == 1, F.lit(""))
           .when(m == 2, F.lit("cluster-")).when(m == 3, F.concat("lang", F.lit("-"), "source"))
           .otherwise(F.concat(F.lit("cluster-"), "source")))
    return _docs(spark, sf).select("doc_id", raw.alias("raw")).select("doc_id", "raw", sanitize_topic_id("raw").alias("topic_id"))


@register("safe_segments", f"""
SELECT doc_id, {S.safe_segment("'cluster-' || lang || ' ' || source || '/' || doc_id")} AS segment,
       md5({S.safe_segment('text')}) AS text_segment_md5 FROM documents""")
def q_safe_segments(spark, sf):
    seg = safe_segment(F.concat(F.lit("cluster-"), "lang", F.lit(" "), "source", F.lit("/"), F.col("doc_id").cast("string")))
    return _docs(spark, sf).select("doc_id", seg.alias("segment"), F.md5(safe_segment("text")).alias("text_segment_md5"))


@register("flag_headlines", f"""
SELECT doc_id, {S.flag_headline("h", "doc_id % 3 = 0")} AS headline FROM (
  SELECT doc_id, CASE WHEN doc_id % 5 = 0 THEN '【Strategic/Risk】' ELSE ' ' END || text AS h FROM documents)""")
def q_flag_headlines(spark, sf):
    h = F.concat(F.when(F.col("doc_id") % 5 == 0, F.lit("【Strategic/Risk】")).otherwise(F.lit(" ")), F.col("text"))
    return _docs(spark, sf).select("doc_id", flag_headline(h, F.col("doc_id") % 3 == 0).alias("headline"))


@register("clean_html", f"""
SELECT page_id, length(t)::INTEGER AS n_chars, md5(t) AS text_md5 FROM (SELECT page_id, {S.clean_html('html')} AS t FROM pages)""")
def q_clean_html(spark, sf):
    t = clean_html("html")
    return read(spark, sf, "pages").select("page_id", t.alias("t")).select(
        "page_id", F.length("t").alias("n_chars"), F.md5("t").alias("text_md5"))


SQL_URL_VARIANT = """CASE page_id % 8 WHEN 0 THEN url WHEN 1 THEN regexp_replace(url, '\\Ahttps?:', '')
  WHEN 2 THEN regexp_replace(url, '\\Ahttps?://', '') WHEN 3 THEN ' javascript:alert(' || page_id || ')'
  WHEN 4 THEN '' WHEN 5 THEN 'ftp://' || regexp_replace(url, '\\Ahttps?://', '')
  WHEN 6 THEN 'mailto:editor' || page_id || '@example.com' ELSE '  ' || url || ' ' END"""


def _url_variant():
    pid = F.col("page_id") % 8
    u = F.col("url")
    return (F.when(pid == 0, u).when(pid == 1, F.regexp_replace(u, r"\Ahttps?:", ""))
            .when(pid == 2, F.regexp_replace(u, r"\Ahttps?://", ""))
            .when(pid == 3, F.concat(F.lit(" javascript:alert("), F.col("page_id").cast("string"), F.lit(")")))
            .when(pid == 4, F.lit(""))
            .when(pid == 5, F.concat(F.lit("ftp://"), F.regexp_replace(u, r"\Ahttps?://", "")))
            .when(pid == 6, F.concat(F.lit("mailto:editor"), F.col("page_id").cast("string"), F.lit("@example.com")))
            .otherwise(F.concat(F.lit("  "), u, F.lit(" "))))


@register("normalize_urls", f"""
SELECT page_id, raw, {S.normalize_url('raw')} AS url FROM (SELECT page_id, {SQL_URL_VARIANT} AS raw FROM pages)""")
def q_normalize_urls(spark, sf):
    return read(spark, sf, "pages").select("page_id", _url_variant().alias("raw")).select(
        "page_id", "raw", normalize_url("raw").alias("url"))


@register("safe_urls", f"""
SELECT page_id, raw, {S.safe_url('raw')} AS url FROM (SELECT page_id, {SQL_URL_VARIANT.replace("WHEN 4 THEN ''", "WHEN 4 THEN 'tg://resolve?domain=p' || page_id")} AS raw FROM pages)""")
def q_safe_urls(spark, sf):
    raw = F.when(F.col("page_id") % 8 == 4, F.concat(F.lit("tg://resolve?domain=p"), F.col("page_id").cast("string"))) \
        .otherwise(_url_variant())
    return read(spark, sf, "pages").select("page_id", raw.alias("raw")).select("page_id", "raw", safe_url("raw").alias("url"))


@register("repaired_utf8", "SELECT doc_id, md5(text || chr(65533) || text) AS text_md5 FROM documents")
def q_repaired_utf8(spark, sf):
    raw = F.concat(F.col("text").cast("binary"), F.unhex(F.lit("FF")), F.col("text").cast("binary"))
    return _docs(spark, sf).select("doc_id", F.md5(repair_utf8(raw)).alias("text_md5"))
