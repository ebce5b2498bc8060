"""Registered output queries: rendered digests, message parts, request/response tables, bundle repair."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidings.functions.scores import SCORE_DIMENSIONS
from tidings.operators.render import briefing_json, render_channel, render_html, render_markdown, split_messages
from tidings.operators.requests import build_requests, parse_briefings, parse_responses
from tidings.operators.responses import parse_drafts, parse_facts, parse_selections
from tidings.plans import sqlfrag as S
from tidings.plans.digest import SQL_CHAIN, digest_tables
from tidings.plans.registry import register
from tidings.tables import read

W = "WITH " + SQL_CHAIN + "\n"
DATE = "2024-01-31T00:00:00Z"
LABEL = "消息来源"


def _titles(final):
    import datetime as dt

    from tidings.operators.briefing import briefing_header

    return briefing_header(final, None, dt.datetime(2024, 1, 31))


def _md_sql():
    t = S.py_strip("text")
    u = S.py_strip("url")
    return f""", ti AS (SELECT DISTINCT briefing_id, 'Digest ' || briefing_id AS title FROM final),
lines AS (
  SELECT briefing_id, 0 AS a, 0 AS b, 0 AS c, '# ' || title AS l FROM ti
  UNION ALL SELECT briefing_id, 0, 1, 0, '' FROM ti
  UNION ALL SELECT briefing_id, 0, 2, 0, '> {DATE}' FROM ti
  UNION ALL SELECT briefing_id, 0, 3, 0, '' FROM ti
  UNION ALL SELECT briefing_id, topic_pos, 0, 0, '## ' || topic_pos || '. ' || CASE WHEN {S.py_strip('headline')} = '' THEN 'Topic ' || topic_pos ELSE {S.py_strip('headline')} END FROM final
  UNION ALL SELECT briefing_id, topic_pos, 1, 0, '' FROM final
  UNION ALL SELECT briefing_id, topic_pos, 3, 0, '' FROM final
  UNION ALL SELECT briefing_id, topic_pos, 2, bullet_pos,
    CASE WHEN starts_with({u}, 'http://') OR starts_with({u}, 'https://') THEN '- ' || {t} || ' [{LABEL}](' || {u} || ')' ELSE '- ' || {t} END
    FROM final_bullets WHERE {t} <> ''),
md AS (SELECT briefing_id, {S.py_strip("string_agg(l, chr(10) ORDER BY a, b, c)")} || chr(10) AS markdown FROM lines GROUP BY briefing_id)"""


@register("render_markdown", W + _md_sql() + "\nSELECT briefing_id, md5(markdown) AS md_md5, length(markdown)::INTEGER AS n_chars FROM md")
def q_render_markdown(spark, sf):
    t = digest_tables(spark, sf)
    topics, bullets, _ = t["published"]
    md = render_markdown(topics, bullets, _titles(topics), LABEL)
    return md.select("briefing_id", F.md5("markdown").alias("md_md5"), F.length("markdown").alias("n_chars"))


def _esc(e):
    return f"replace(replace(replace(replace(replace({e}, '&', '&amp;'), '<', '&lt;'), '>', '&gt;'), '\"', '&quot;'), '''', '&#x27;')"


def _channel_sql():
    t = S.py_strip("text")
    su = S.safe_url("url")
    return f""", ti AS (SELECT DISTINCT briefing_id, 'Digest ' || briefing_id AS title FROM final),
bl AS (SELECT briefing_id, topic_pos, string_agg('• ' || {_esc(t)} ||
          CASE WHEN {su} <> '' THEN ' <a href="' || {_esc(su)} || '">{LABEL}</a>' ELSE '' END, chr(10) ORDER BY bullet_pos) AS items
       FROM final_bullets WHERE {t} <> '' GROUP BY ALL),
blocks AS (SELECT briefing_id, 0 AS a, '<b>' || {_esc(S.py_strip('title'))} || '</b>' || chr(10) || {_esc(S.lit(DATE))} AS l FROM ti
  UNION ALL SELECT f.briefing_id, f.topic_pos, '<b>' || f.topic_pos || '. ' || {_esc(S.py_strip('f.headline'))} || '</b>' ||
     CASE WHEN bl.items IS NOT NULL THEN chr(10) || bl.items ELSE '' END
  FROM final f LEFT JOIN bl USING (briefing_id, topic_pos)),
msg AS (SELECT briefing_id, {S.py_strip("string_agg(l, chr(10) || chr(10) ORDER BY a)")} AS message FROM blocks GROUP BY ALL)"""


@register("render_channel", W + _channel_sql() + "\nSELECT briefing_id, md5(message) AS msg_md5, length(message)::INTEGER AS n_chars FROM msg")
def q_render_channel(spark, sf):
    t = digest_tables(spark, sf)
    topics, bullets, _ = t["published"]
    m = render_channel(topics, bullets, _titles(topics), LABEL)
    return m.select("briefing_id", F.md5("message").alias("msg_md5"), F.length("message").alias("n_chars"))


def _split_sql(limit=500):
    ml = limit
    floor = int(ml * 0.7)
    w = f"substring(rest, 1, {ml})"

    def last(tok_re, tok_lit):
        return (f"(CASE WHEN strpos({w}, {S.lit(tok_lit)}) > 0 THEN "
                f"length(regexp_extract({w}, {S.lit('(?s)^(.*)' + tok_re)}, 1)) ELSE -1 END)")
    i1, i2, i3 = last(r"\n\n", "\n\n"), last("</pre>", "</pre>"), last("</blockquote>", "</blockquote>")
    best = f"greatest({i1}, {i2}, {i3})"
    inc = f"(CASE WHEN {best} = {i1} THEN 0 WHEN {best} = {i2} THEN 6 ELSE 13 END)"
    cut0 = f"(CASE WHEN {best} = -1 OR {best} < {floor} THEN {ml} ELSE {best} + {inc} END)"
    cut = f"(CASE WHEN {cut0} <= 0 THEN {ml} ELSE {cut0} END)"
    return f"""WITH RECURSIVE r(doc_id, part_no, part, rest) AS (
  SELECT doc_id, -1, NULL::VARCHAR, coalesce(text, '') FROM documents
  UNION ALL
  SELECT doc_id, part_no + 1,
         CASE WHEN length(rest) <= {ml} THEN rest ELSE substring(rest, 1, {cut}) END,
         CASE WHEN length(rest) <= {ml} THEN '' ELSE {S.py_lstrip(f'substring(rest, {cut} + 1)')} END
  FROM r WHERE rest <> '')
SELECT doc_id, part_no::INTEGER AS part, length(part)::INTEGER AS n_chars, md5(part) AS part_md5 FROM r WHERE part_no >= 0"""


@register("split_messages", _split_sql())
def q_split_messages(spark, sf):
    d = read(spark, sf, "documents")
    parts = split_messages(d, "text", limit=500, id_cols=("doc_id",))
    return parts.select("doc_id", "part", F.length("text").alias("n_chars"), F.md5("text").alias("part_md5"))


TEMPLATE = "[CLUSTER CONTEXT]\n{{ cluster_json }}\n\nReturn the facts of {{ cluster_id }} as JSON.\n"


@register("build_requests", W + f""", its AS (SELECT briefing_id, cluster_id, doc_id, url, source, text,
   ((row_number() OVER (PARTITION BY briefing_id, cluster_id ORDER BY doc_id) - 1) // 5 + 1)::INTEGER AS request FROM fi),
js AS (SELECT briefing_id, cluster_id, request, to_json({{'cluster_id': cluster_id, 'items': list({{'item_id': CAST(doc_id AS VARCHAR), 'url': url, 'source': source, 'text': text}} ORDER BY doc_id)}}) AS j
       FROM its GROUP BY briefing_id, cluster_id, request)
SELECT briefing_id, cluster_id, request, md5(replace(replace({S.lit(TEMPLATE)}, '{{{{ cluster_json }}}}', j), '{{{{ cluster_id }}}}', cluster_id)) AS prompt_md5,
       length(replace(replace({S.lit(TEMPLATE)}, '{{{{ cluster_json }}}}', j), '{{{{ cluster_id }}}}', cluster_id))::INTEGER AS n_chars FROM js""")
def q_build_requests(spark, sf):
    r = build_requests(digest_tables(spark, sf)["items"], TEMPLATE, per_request=5)
    return r.select("briefing_id", "cluster_id", "request", F.md5("prompt").alias("prompt_md5"), F.length("prompt").alias("n_chars"))


@register("parse_responses", """
SELECT event_id, CASE WHEN NOT json_valid(j) THEN 'unparsable'
                      WHEN try_cast(json_extract(j, '$.k') AS INTEGER) IS NULL THEN 'invalid' ELSE 'ok' END AS status,
       CASE WHEN json_valid(j) THEN try_cast(json_extract(j, '$.k') AS INTEGER) END AS k
FROM (SELECT event_id, CASE WHEN event_id % 9 = 0 THEN substr(props, 1, 5) WHEN event_id % 9 = 4 THEN '{"k": "x' || event_id || '"}'
                            ELSE props END AS j FROM events)""")
def q_parse_responses(spark, sf):
    e = read(spark, sf, "events")
    j = (F.when(F.col("event_id") % 9 == 0, F.substring("props", 1, 5))
         .when(F.col("event_id") % 9 == 4, F.concat(F.lit('{"k": "x'), F.col("event_id").cast("string"), F.lit('"}')))
         .otherwise(F.col("props")))
    p = parse_responses(e.select("event_id", j.alias("j")), "j", {"k": "int"})
    return p.select("event_id", "status", "k")


# A whole-briefing response per turn: its text is the bullet. Planted: broken JSON, no topics, a second topic whose
# bullet is cut to three characters, a missing date.
SQL_BRIEFS = """WITH c AS (SELECT conv_id, turn, role, 'Turn: ' || coalesce(text, '') AS body FROM conversations),
st AS (SELECT *, CASE WHEN turn % 7 = 6 THEN 'unparsable' WHEN turn % 4 = 0 THEN 'empty' WHEN turn % 5 = 3 THEN 'invalid' ELSE 'ok' END AS status FROM c),
tp AS (SELECT *, 1 AS topic_pos FROM st WHERE status = 'ok' UNION ALL SELECT *, 2 FROM st WHERE status = 'ok' AND turn % 4 <> 1)
"""


def _brief_responses(spark, sf):
    c = read(spark, sf, "conversations")
    t, conv = F.col("turn"), F.col("conv_id").cast("string")
    body = F.concat(F.lit("Turn: "), F.coalesce(F.col("text"), F.lit("")))
    url = F.concat(F.lit("https://conv.example.com/"), conv, F.lit("/"), t.cast("string"))

    def topic(n, headline, text):
        return F.struct(F.concat(F.lit("c"), conv, F.lit(f"-{n}")).alias("topic_id"), headline.alias("headline"),
                        F.array(F.struct(text.alias("text"), url.alias("url"))).alias("bullets"))

    one = topic(1, F.concat("role", F.lit(" "), t.cast("string")), body)
    two = topic(2, F.concat(F.lit("second "), t.cast("string")), F.when(t % 5 == 3, F.substring(body, 1, 3)).otherwise(body))
    one = F.when(t % 5 == 3, one.withField("bullets", F.array(F.struct(F.substring(body, 1, 3).alias("text"), url.alias("url"))))).otherwise(one)
    topics = F.when(t % 4 == 0, F.slice(F.array(one), 1, 0)).when(t % 4 == 1, F.array(one)).otherwise(F.array(one, two))
    date = F.when(t % 3 != 0, F.concat(F.lit("2024-01-0"), (t % 9 + 1).cast("string"), F.lit("T00:00:00Z")))
    j = F.when(t % 7 == 6, F.lit('{"title": "broken')).otherwise(
        F.to_json(F.struct(F.concat(F.lit("Model "), conv).alias("title"), date.alias("date"), topics.alias("topics"))))
    return parse_briefings(c.select("conv_id", "turn", j.alias("j")), "j", title="Configured Digest", default_date=DATE)


@register("parse_briefings", SQL_BRIEFS + f"""SELECT conv_id, turn, topic_pos, 'c' || conv_id || '-' || topic_pos AS topic_id,
  CASE WHEN topic_pos = 1 THEN role || ' ' || turn ELSE 'second ' || turn END AS headline, 1 AS n_bullets, 'Configured Digest' AS title,
  CASE WHEN turn % 3 = 0 THEN '{DATE}' ELSE '2024-01-0' || (turn % 9 + 1) || 'T00:00:00Z' END AS date FROM tp""")
def q_parse_briefings(spark, sf):
    p = _brief_responses(spark, sf)[0]
    return p.select("conv_id", "turn", F.col("topic_pos").cast("int").alias("topic_pos"), "topic_id", "headline", "n_bullets", "title", "date")


@register("parse_briefing_bullets", SQL_BRIEFS + """SELECT conv_id, turn, topic_pos, 1 AS bullet_pos, body AS text,
  'https://conv.example.com/' || conv_id || '/' || turn AS url FROM tp""")
def q_parse_briefing_bullets(spark, sf):
    return _brief_responses(spark, sf)[1]


@register("parse_briefing_status", SQL_BRIEFS + "SELECT conv_id, turn, status FROM st")
def q_parse_briefing_status(spark, sf):
    return _brief_responses(spark, sf)[2]


# Stage responses: one JSON per cluster made from the chain's own tables, some of them broken by bundle position
def _responses(t, df, payload, broken):
    """``df`` (cluster rows with the struct ``payload``) to JSON; every ``broken``-th bundle's text is cut."""
    j = df.join(t["bundles"].select("briefing_id", "cluster_id", "bundle_pos"), ["briefing_id", "cluster_id"])
    text = F.to_json(payload)
    return j.select("briefing_id", "cluster_id", F.when(F.col("bundle_pos") % broken == 0, F.substr(text, F.lit(1), F.length(text) - 3))
                    .otherwise(text).alias("response"))


@register("parse_facts", W + """SELECT s.briefing_id, s.cluster_id, (row_number() OVER (PARTITION BY s.briefing_id, s.cluster_id, s.doc_id ORDER BY fact_idx) - 1)::INTEGER AS pos,
  fact_id, text, url FROM scored s JOIN bundles b USING (briefing_id, cluster_id) WHERE b.bundle_pos % 5 <> 0 AND b.bundle_pos % 7 <> 0""")
def q_parse_facts(spark, sf):
    """One response per document, as one request is."""
    t = digest_tables(spark, sf)
    url = F.when(F.col("bundle_pos") % 7 != 0, F.col("url"))
    f = t["facts"].join(t["bundles"].select("briefing_id", "cluster_id", "bundle_pos"), ["briefing_id", "cluster_id"])
    g = f.groupBy("briefing_id", "cluster_id", "doc_id").agg(F.transform(F.array_sort(F.collect_list(F.struct(
        "fact_idx", "fact_id", "text", url.alias("url")))), lambda x: x.dropFields("fact_idx")).alias("facts"))
    return parse_facts(_responses(t, g, F.struct("cluster_id", "facts"), 5))[0]


@register("parse_selections", W + """SELECT p.briefing_id, p.cluster_id, pick_rank::INTEGER AS pick_rank, fact_id, text, url, actionability, novelty, impact, reusability,
  reliability, agentic_bonus, strategic_flag::INTEGER AS strategic_flag FROM picked p JOIN bundles b USING (briefing_id, cluster_id)
WHERE b.bundle_pos % 5 <> 0 AND b.bundle_pos % 7 <> 0""")
def q_parse_selections(spark, sf):
    t = digest_tables(spark, sf)
    p = t["picked"].join(t["bundles"].select("briefing_id", "cluster_id", "bundle_pos"), ["briefing_id", "cluster_id"])
    scores = F.struct(*[(F.when(F.col("bundle_pos") % 7 == 0, F.lit(9)).otherwise(F.col(d)) if d == "novelty" else
                         F.when(F.col(d) != 0, F.col(d)) if d == "agentic_bonus" else F.col(d)).alias(d) for d in SCORE_DIMENSIONS])
    flag = F.when(F.col("strategic_flag"), F.lit(True))  # a missing flag is false
    g = p.groupBy("briefing_id", "cluster_id").agg(F.transform(F.array_sort(F.collect_list(F.struct(
        "pick_rank", "fact_id", "text", "url", scores.alias("scores"), flag.alias("strategic_flag"), F.lit("rule table").alias("rationale")))),
        lambda x: x.dropFields("pick_rank")).alias("picked"))
    got = parse_selections(_responses(t, g, F.struct("cluster_id", "picked"), 5))[0]
    return got.drop("rationale").withColumn("strategic_flag", F.col("strategic_flag").cast("int"))


@register("parse_drafts", W + """SELECT d.briefing_id, d.cluster_id, 'cluster-' || d.cluster_id AS topic_id, headline, agentic::INTEGER AS agentic,
  strategic::INTEGER AS strategic, least(n_bullets, 2)::INTEGER AS n_bullets FROM drafts d JOIN bundles b USING (briefing_id, cluster_id)
WHERE b.bundle_pos % 5 <> 0 AND b.bundle_pos % 7 <> 0""")
def q_parse_drafts(spark, sf):
    t = digest_tables(spark, sf)
    pos = t["bundles"].select("briefing_id", "cluster_id", "bundle_pos")
    keys = ["briefing_id", "cluster_id"]
    b = t["bullets"].groupBy(*keys).agg(F.transform(F.array_sort(F.collect_list(F.struct("bullet_pos", "text", "url"))),
                                                    lambda x: x.dropFields("bullet_pos")).alias("bullets"))
    d = t["drafts"].join(b, keys).join(pos, keys)
    # every seventh draft comes back with its bullets six times over: more than four, so it is refused
    six = F.when(F.col("bundle_pos") % 7 == 0, F.flatten(F.array_repeat("bullets", 6))).otherwise(F.col("bullets"))
    d = d.withColumn("bullets", six).withColumn("annotations", F.create_map(
        F.lit("agentic"), "agentic", F.lit("strategic"), "strategic")).drop("bundle_pos")
    got = parse_drafts(_responses(t, d, F.struct("headline", "bullets", "annotations"), 5), max_bullets=2)[0]
    return got.withColumn("agentic", F.col("agentic").cast("int")).withColumn("strategic", F.col("strategic").cast("int"))


@register("response_status", W + """SELECT d.briefing_id, d.cluster_id, CASE WHEN b.bundle_pos % 5 = 0 THEN 'unparsable' WHEN b.bundle_pos % 7 = 0 OR b.bundle_pos % 8 IN (3, 6)
  THEN 'invalid' ELSE 'ok' END AS status FROM drafts d JOIN bundles b USING (briefing_id, cluster_id)""")
def q_response_status(spark, sf):
    """Fact responses, some broken, some without a text, some with a key too many at the top or in a fact."""
    t = digest_tables(spark, sf)
    f = t["picked"].join(t["bundles"].select("briefing_id", "cluster_id", "bundle_pos"), ["briefing_id", "cluster_id"])
    bad = F.when(F.col("bundle_pos") % 7 != 0, F.col("text"))
    inner = F.when(F.col("bundle_pos") % 8 == 3, F.lit(0.5))  # null fields are not written
    g = f.groupBy("briefing_id", "cluster_id").agg(F.transform(F.array_sort(F.collect_list(F.struct(
        "fact_idx", "fact_id", bad.alias("text"), "url", inner.alias("confidence")))), lambda x: x.dropFields("fact_idx")).alias("facts"),
        F.max(F.when(F.col("bundle_pos") % 8 == 6, F.lit("sure"))).alias("remark"))
    return parse_facts(_responses(t, g, F.struct("facts", "remark"), 5))[1]


@register("selection_status", W + """SELECT d.briefing_id, d.cluster_id, CASE WHEN b.bundle_pos % 5 = 0 THEN 'unparsable' WHEN b.bundle_pos % 8 IN (2, 4, 7)
  THEN 'invalid' ELSE 'ok' END AS status FROM drafts d JOIN bundles b USING (briefing_id, cluster_id)""")
def q_selection_status(spark, sf):
    """Selection responses, some broken, some with a key too many in the scores, in a dropped fact, or with a score out of range."""
    t = digest_tables(spark, sf)
    p = t["picked"].join(t["bundles"].select("briefing_id", "cluster_id", "bundle_pos"), ["briefing_id", "cluster_id"])
    nth = F.col("bundle_pos") % 8
    scores = F.struct(*[(F.when(nth == 7, F.lit(-1)).otherwise(F.col(d)) if d == "impact" else F.col(d)).alias(d) for d in SCORE_DIMENSIONS],
                      F.when(nth == 2, F.lit(1)).alias("surprise"))
    gone = F.array(F.struct(F.lit("fact-x").alias("fact_id"), F.lit("old").alias("reason"), F.when(nth == 4, F.lit("me")).alias("by")))
    g = p.groupBy("briefing_id", "cluster_id").agg(
        F.collect_list(F.struct("fact_id", "text", "url", scores.alias("scores"), "strategic_flag", F.lit("rule table").alias("rationale"))).alias("picked"),
        F.first(gone).alias("dropped"), F.lit("none").alias("notes"))
    return parse_selections(_responses(t, g, F.struct("cluster_id", "picked", "dropped", "notes"), 5))[2]


@register("briefing_json", W + f""", tb AS (SELECT briefing_id, topic_pos, list({{'text': text, 'url': url}} ORDER BY bullet_pos) AS bullets FROM final_bullets GROUP BY ALL),
js AS (SELECT f.briefing_id, to_json({{'title': 'Digest ' || f.briefing_id, 'date': '{DATE}',
   'topics': list({{'topic_id': f.topic_id, 'headline': f.headline, 'bullets': tb.bullets}} ORDER BY f.topic_pos)}}) AS j
  FROM final f JOIN tb USING (briefing_id, topic_pos) GROUP BY f.briefing_id)
SELECT briefing_id, md5(j) AS json_md5, length(j)::INTEGER AS n_chars FROM js""")
def q_briefing_json(spark, sf):
    topics, bullets, _ = digest_tables(spark, sf)["published"]
    j = briefing_json(topics, bullets, _titles(topics))
    return j.select("briefing_id", F.md5("json").alias("json_md5"), F.length("json").alias("n_chars"))


@register("html_page", W + _md_sql() + """
SELECT briefing_id, md5('<!DOCTYPE html>' || chr(10) || '<html><head><meta charset="utf-8"><title>Digest ' || briefing_id || '</title></head>' || chr(10)
  || '<body><pre>' || chr(10) || markdown || chr(10) || '</pre></body></html>') AS page_md5 FROM md""")
def q_html_page(spark, sf):
    topics, bullets, _ = digest_tables(spark, sf)["published"]
    titles = _titles(topics)
    md = render_markdown(topics, bullets, titles, LABEL).join(titles, "briefing_id")
    return md.select("briefing_id", F.md5(render_html("markdown", "title")).alias("page_md5"))


@register("sanitize_bundles", f"""
WITH it AS (SELECT 'cluster-' || (page_id % 10) AS cluster_id, page_id, {S.normalize_url('raw')} AS url, url AS link FROM (
  SELECT page_id, url, CASE page_id % 8 WHEN 0 THEN url WHEN 1 THEN regexp_replace(url, '\\Ahttps?:', '')
  WHEN 2 THEN regexp_replace(url, '\\Ahttps?://', '') WHEN 3 THEN ' javascript:alert(' || page_id || ')'
  WHEN 4 THEN '' WHEN 5 THEN 'ftp://' || regexp_replace(url, '\\Ahttps?://', '')
  WHEN 6 THEN 'mailto:editor' || page_id || '@example.com' ELSE '  ' || url || ' ' END AS raw FROM pages))
SELECT cluster_id, count(*) AS items_in, count(url) AS items_kept,
       count({S.normalize_url("CASE WHEN page_id % 3 = 0 THEN 'javascript:x' ELSE link END")}) AS links_kept
FROM it GROUP BY cluster_id""")
def q_sanitize_bundles(spark, sf):
    from tidings.operators.bundles import sanitize_bundles
    from tidings.plans.text import _url_variant

    p = read(spark, sf, "pages")
    items = p.select(F.concat(F.lit("cluster-"), (F.col("page_id") % 10).cast("string")).alias("cluster_id"),
                     "page_id", _url_variant().alias("url"))
    links = p.select(F.concat(F.lit("cluster-"), (F.col("page_id") % 10).cast("string")).alias("cluster_id"),
                     F.when(F.col("page_id") % 3 == 0, F.lit("javascript:x")).otherwise(F.col("url")).alias("link"))
    kept_items, kept_links = sanitize_bundles(items, links)
    ci = items.groupBy("cluster_id").agg(F.count(F.lit(1)).alias("items_in"))
    ki = kept_items.groupBy("cluster_id").agg(F.count(F.lit(1)).alias("items_kept"))
    kl = kept_links.groupBy("cluster_id").agg(F.count(F.lit(1)).alias("links_kept"))
    z = F.lit(0).cast("long")
    return ci.join(ki, "cluster_id", "left").join(kl, "cluster_id", "left").select(
        "cluster_id", "items_in", F.coalesce("items_kept", z).alias("items_kept"), F.coalesce("links_kept", z).alias("links_kept"))

