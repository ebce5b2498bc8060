"""Rendering from topic/bullet tables: Markdown digest, channel HTML, the HTML page, message splitting."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidings.functions.text import py_strip
from tidings.functions.urls import safe_url

# The channel message size limit.
CHANNEL_LIMIT = 4096
# Message boundaries, in priority order, and how much of each stays with the left part.
BOUNDARY_TOKENS = [("\n\n", 0), ("</pre>", 6), ("</blockquote>", 13)]
# Default source-link labels per language.
SOURCE_LABELS = {"zh": "消息来源", "en": "Source"}


def cap_bullets(bullets: DataFrame, n: int, *, keys: tuple[str, ...] = ("briefing_id", "cluster_id")) -> DataFrame:
    """Drafts with more than 4 bullets fail validation and are skipped whole; the rest keep bullets 1..n."""
    counts = bullets.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    ok = counts.filter(F.col("_n") <= 4).select(*keys)
    return bullets.join(ok, list(keys), "left_semi").filter(F.col("bullet_pos") <= n)


def _join_lines(df: DataFrame, group: str, keys: list[str], line: str, sep: str) -> DataFrame:
    ordered = F.array_sort(F.collect_list(F.struct(*[F.col(k) for k in keys], F.col(line).alias("_l"))))
    return df.groupBy(group).agg(F.array_join(F.transform(ordered, lambda s: s["_l"]), sep).alias("_joined"))


def _line(a, b, c, line) -> Column:
    return F.struct(a.cast("int").alias("a"), b.cast("int").alias("b"), c.cast("int").alias("c"), line.alias("l"))


def render_markdown(topics: DataFrame, bullets: DataFrame, titles: DataFrame, label: str = "消息来源") -> DataFrame:
    """Markdown per briefing: ``# title``, ``> date``, ``## i. headline`` (blank -> ``Topic i``) and
    ``- text [label](url)`` (non-http url dropped, blank bullet skipped); joined, stripped, newline-terminated.

    ``topics``: briefing_id, topic_pos, headline; ``bullets``: briefing_id, topic_pos, bullet_pos, text,
    url; ``titles``: briefing_id, title, date. Output: briefing_id, markdown.
    """
    z = F.lit(0)
    title = F.coalesce(F.when(py_strip(F.col("title")) != "", py_strip(F.col("title"))), F.lit("Briefing"))
    head = titles.select("briefing_id", F.array(
        _line(z, z, z, F.concat(F.lit("# "), title)),
        _line(z, F.lit(1), z, F.lit("")),
        _line(z, F.lit(2), z, F.concat(F.lit("> "), py_strip(F.coalesce(F.col("date"), F.lit(""))))),
        _line(z, F.lit(3), z, F.lit(""))).alias("ls")).select("briefing_id", F.inline("ls"))
    h = py_strip(F.coalesce(F.col("headline"), F.lit("")))
    h = F.when(h == "", F.concat(F.lit("Topic "), F.col("topic_pos").cast("string"))).otherwise(h)
    tl = topics.select("briefing_id", F.array(
        _line(F.col("topic_pos"), z, z, F.concat(F.lit("## "), F.col("topic_pos").cast("string"), F.lit(". "), h)),
        _line(F.col("topic_pos"), F.lit(1), z, F.lit("")),
        _line(F.col("topic_pos"), F.lit(3), z, F.lit(""))).alias("ls")).select("briefing_id", F.inline("ls"))
    t = py_strip(F.coalesce(F.col("text"), F.lit("")))
    u = py_strip(F.coalesce(F.col("url"), F.lit("")))
    u = F.when(u.startswith("http://") | u.startswith("https://"), u).otherwise(F.lit(""))
    bl = bullets.filter(t != "").select(
        "briefing_id", F.col("topic_pos").cast("int").alias("a"), F.lit(2).alias("b"), F.col("bullet_pos").cast("int").alias("c"),
        F.when(u != "", F.concat(F.lit("- "), t, F.lit(f" [{label}]("), u, F.lit(")"))).otherwise(F.concat(F.lit("- "), t)).alias("l"))
    lines = head.unionByName(tl).unionByName(bl)
    j = _join_lines(lines, "briefing_id", ["a", "b", "c"], "l", "\n")
    return j.select("briefing_id", F.concat(py_strip(F.col("_joined")), F.lit("\n")).alias("markdown"))


def html_escape(c: Column) -> Column:
    """``& < > " '`` escaped as Python's ``html.escape(quote=True)`` does."""
    c = F.replace(c, F.lit("&"), F.lit("&amp;"))
    c = F.replace(c, F.lit("<"), F.lit("&lt;"))
    c = F.replace(c, F.lit(">"), F.lit("&gt;"))
    c = F.replace(c, F.lit('"'), F.lit("&quot;"))
    return F.replace(c, F.lit("'"), F.lit("&#x27;"))


def render_channel(topics: DataFrame, bullets: DataFrame, titles: DataFrame, label: str = "消息来源") -> DataFrame:
    """Channel message text per briefing, rendered from the tables: bold title and headings, ``• `` items,
    escaped text, ``<a href>`` only for allowed schemes. Blocks are separated by a blank line."""
    t = py_strip(F.coalesce(F.col("text"), F.lit("")))
    su = safe_url(F.coalesce(F.col("url"), F.lit("")))
    link = F.when(su != "", F.concat(F.lit(' <a href="'), html_escape(su), F.lit('">'), F.lit(label), F.lit("</a>"))).otherwise(F.lit(""))
    bl = bullets.filter(t != "").select("briefing_id", "topic_pos", "bullet_pos",
                                         F.concat(F.lit("• "), html_escape(t), link).alias("l"))
    bl = bl.withColumn("_k", F.struct("briefing_id", "topic_pos"))
    per_topic = _join_lines(bl, "_k", ["bullet_pos"], "l", "\n").select(
        F.col("_k.briefing_id").alias("briefing_id"), F.col("_k.topic_pos").alias("topic_pos"), F.col("_joined").alias("items"))
    tp = topics.join(per_topic, ["briefing_id", "topic_pos"], "left").select(
        "briefing_id", F.col("topic_pos").alias("a"),
        F.concat(F.lit("<b>"), F.col("topic_pos").cast("string"), F.lit(". "), html_escape(py_strip(F.col("headline"))),
                 F.lit("</b>"), F.when(F.col("items").isNotNull(), F.concat(F.lit("\n"), F.col("items"))).otherwise(F.lit(""))).alias("l"))
    hd = titles.select("briefing_id", F.lit(0).alias("a"),
                       F.concat(F.lit("<b>"), html_escape(py_strip(F.col("title"))), F.lit("</b>\n"),
                                html_escape(py_strip(F.coalesce(F.col("date"), F.lit(""))))).alias("l"))
    j = _join_lines(hd.unionByName(tp), "briefing_id", ["a"], "l", "\n\n")
    return j.select("briefing_id", py_strip(F.col("_joined")).alias("message"))


def briefing_json(topics: DataFrame, bullets: DataFrame, titles: DataFrame) -> DataFrame:
    """The briefing as one JSON document: title, date, topics (topic_id, headline, bullets of text and url) in
    order. A digest has at most 4 bullets a topic, so a document is bounded by its topics.
    Output: briefing_id, json."""
    b = bullets.groupBy("briefing_id", "topic_pos").agg(F.transform(
        F.array_sort(F.collect_list(F.struct("bullet_pos", "text", "url"))),
        lambda x: F.struct(x["text"].alias("text"), x["url"].alias("url"))).alias("bullets"))
    t = topics.join(b, ["briefing_id", "topic_pos"], "left").groupBy("briefing_id").agg(F.transform(
        F.array_sort(F.collect_list(F.struct("topic_pos", "topic_id", "headline", "bullets"))),
        lambda x: F.struct(x["topic_id"].alias("topic_id"), x["headline"].alias("headline"), x["bullets"].alias("bullets"))).alias("topics"))
    return titles.join(t, "briefing_id").select("briefing_id", F.to_json(F.struct("title", "date", "topics")).alias("json"))


def render_html(markdown, title) -> Column:
    """The page wrapper: Markdown in ``<pre>``, not escaped (as the reference writes it)."""
    md = F.col(markdown) if isinstance(markdown, str) else markdown
    tt = F.col(title) if isinstance(title, str) else title
    return F.concat(F.lit('<!DOCTYPE html>\n<html><head><meta charset="utf-8"><title>'), F.coalesce(tt, F.lit("Briefing")),
                    F.lit("</title></head>\n<body><pre>\n"), md, F.lit("\n</pre></body></html>"))


def split_messages(df: DataFrame, text_col: str, limit: int = CHANNEL_LIMIT, headroom: int = 0,
                   id_cols=("msg_id",)) -> DataFrame:
    """Split each message into parts of at most ``min(limit, 4096) - headroom`` characters.

    Cut at the last blank line, ``</pre>`` or ``</blockquote>`` in the window when it lies at 70 % of
    the window or later (closing tags stay with the left part), else hard-cut; the rest is left-stripped.
    A part is decided by the characters of its own window, so a text is cut in one pass over offsets: time and memory
    grow with its length, not with its square. Texts go through an Arrow mapper, a row stays in its task.
    Output: id columns, part (0..), text.
    """
    max_len = max(1, min(limit, CHANNEL_LIMIT) - max(0, headroom))
    rows = df.select(*id_cols, F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    schema = T.StructType([*[f for f in rows.schema.fields if f.name != "text"], T.StructField("part", T.IntegerType()), T.StructField("text", T.StringType())])

    def run(batches):
        for batch in batches:
            owner, number, parts = [], [], []
            for row, text in enumerate(batch.column("text").to_pylist()):
                for n, (a, b) in enumerate(part_bounds(text, max_len)):
                    owner.append(row)
                    number.append(n)
                    parts.append(text[a:b])
            out = batch.drop_columns(["text"]).take(pa.array(owner, pa.int64())) if id_cols else None
            columns = [] if out is None else out.columns
            yield pa.RecordBatch.from_arrays([*columns, pa.array(number, pa.int32()), pa.array(parts, pa.string())], names=[*id_cols, "part", "text"])

    return rows.mapInArrow(run, schema)


def part_bounds(text: str, max_len: int) -> list[tuple[int, int]]:
    """(start, end) of the parts of a text, see :func:`split_messages`."""
    out, at, least = [], 0, int(max_len * 0.7)
    while at < len(text):
        end = min(at + max_len, len(text))
        if end < len(text):
            found, kept = max((text.rfind(token, at, end), -k, size) for k, (token, size) in enumerate(BOUNDARY_TOKENS))[0::2]
            if found >= 0 and found - at >= least and found - at + kept > 0:
                end = found + kept
        out.append((at, end))
        at = end
        while at < len(text) and text[at].isspace():
            at += 1
    return out
