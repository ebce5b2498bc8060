"""Registered stage-4 and report queries: final digests (flagship), bullets, metrics, quality, record checks."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from tidings.operators.briefing import mark_valid, run_metrics, split_valid
from tidings.operators.quality import check_records, quality_report
from tidings.plans.digest import SQL_CHAIN, digest_tables
from tidings.plans.registry import register

W = "WITH " + SQL_CHAIN + "\n"


@register("finalize_briefing", W + """SELECT briefing_id, topic_pos::INTEGER AS topic_pos, topic_id, headline, n_bullets,
  (bool_and(n_bullets BETWEEN 1 AND 4) OVER (PARTITION BY briefing_id))::INTEGER AS valid FROM final""")
def q_finalize_briefing(spark, sf):
    f = digest_tables(spark, sf)["final"]
    return f.select("briefing_id", F.col("topic_pos").cast("int").alias("topic_pos"), "topic_id", "headline", "n_bullets",
                    F.col("valid").cast("int").alias("valid"))


@register("briefing_bullets", W + """SELECT briefing_id, topic_pos::INTEGER AS topic_pos, bullet_pos::INTEGER AS bullet_pos, text, url
FROM final_bullets""")
def q_briefing_bullets(spark, sf):
    b = digest_tables(spark, sf)["final_bullets"]
    return b.select("briefing_id", F.col("topic_pos").cast("int").alias("topic_pos"),
                    F.col("bullet_pos").cast("int").alias("bullet_pos"), "text", "url")


@register("run_metrics", W + """, m AS (SELECT b.briefing_id, count(DISTINCT b.cluster_id) AS clusters_total FROM bundles b GROUP BY ALL)
SELECT m.briefing_id, clusters_total,
  coalesce((SELECT count(*) FROM final f WHERE f.briefing_id = m.briefing_id), 0) AS topics_final,
  coalesce((SELECT count(*) FROM scored s WHERE s.briefing_id = m.briefing_id), 0) AS facts_total,
  coalesce((SELECT count(*) FROM picked p WHERE p.briefing_id = m.briefing_id), 0) AS facts_picked,
  coalesce((SELECT count(*) FROM dropped d WHERE d.briefing_id = m.briefing_id), 0) AS facts_dropped,
  round(coalesce((SELECT count(*) FROM picked p WHERE p.briefing_id = m.briefing_id) / nullif((SELECT count(*) FROM scored s WHERE s.briefing_id = m.briefing_id), 0), 0.0), 6) AS kept_ratio,
  round(coalesce((SELECT avg(actionability) FROM picked p WHERE p.briefing_id = m.briefing_id), 0.0), 6) AS avg_actionability,
  round(coalesce((SELECT avg(weighted_total) FROM picked p WHERE p.briefing_id = m.briefing_id), 0.0), 6) AS avg_weighted_score,
  coalesce((SELECT count(*) FILTER (WHERE agentic) FROM drafts d WHERE d.briefing_id = m.briefing_id), 0) AS agentic_topics,
  coalesce((SELECT count(*) FILTER (WHERE strategic) FROM drafts d WHERE d.briefing_id = m.briefing_id), 0) AS strategic_topics,
  0.0::DOUBLE AS json_repair_rate
FROM m""")
def q_run_metrics(spark, sf):
    t = digest_tables(spark, sf)
    m = run_metrics(t["bundles"], t["scored"], t["picked"], t["dropped"], t["drafts"], t["final"])
    return m.select("briefing_id", "clusters_total", "topics_final", "facts_total", "facts_picked", "facts_dropped",
                    *[F.round(c, 6).alias(c) for c in ("kept_ratio", "avg_actionability", "avg_weighted_score")],
                    "agentic_topics", "strategic_topics", "json_repair_rate")


@register("quality_report", W + r""", bt AS (SELECT briefing_id, topic_pos, bullet_pos, text, url FROM final_bullets),
tk AS (SELECT briefing_id, topic_pos, bullet_pos, unnest(regexp_extract_all(lower(text), '[\p{L}\p{N}_]+')) AS token FROM bt),
tfb AS (SELECT briefing_id, topic_pos, bullet_pos, token, count(*) AS tf FROM tk GROUP BY ALL),
nb AS (SELECT briefing_id, topic_pos, bullet_pos, sqrt(sum(tf * tf)) AS n FROM tfb GROUP BY ALL),
wb AS (SELECT tfb.*, tf / n AS w FROM tfb JOIN nb USING (briefing_id, topic_pos, bullet_pos)),
near AS (SELECT a.briefing_id, count(*) AS near_identical_bullets FROM (
   SELECT a.briefing_id, a.topic_pos, a.bullet_pos, b.topic_pos AS tp2, b.bullet_pos AS bp2 FROM wb a JOIN wb b
   ON a.briefing_id = b.briefing_id AND a.token = b.token AND (a.topic_pos * 100 + a.bullet_pos) < (b.topic_pos * 100 + b.bullet_pos)
   GROUP BY ALL HAVING sum(a.w * b.w) >= 0.9) a GROUP BY ALL),
dup AS (SELECT briefing_id, count(*) AS duplicate_headlines FROM (SELECT briefing_id, headline FROM final GROUP BY ALL HAVING count(*) > 1) GROUP BY ALL),
urls AS (SELECT briefing_id, avg(CASE WHEN url IN (SELECT url FROM fi WHERE fi.briefing_id = bt.briefing_id) THEN 1.0 ELSE 0.0 END) AS valid_url_share
         FROM bt GROUP BY ALL)
SELECT u.briefing_id, coalesce(d.duplicate_headlines, 0) AS duplicate_headlines, coalesce(n.near_identical_bullets, 0) AS near_identical_bullets,
       round(u.valid_url_share, 6) AS valid_url_share
FROM urls u LEFT JOIN dup d USING (briefing_id) LEFT JOIN near n USING (briefing_id)""")
def q_quality_report(spark, sf):
    t = digest_tables(spark, sf)
    q = quality_report(t["final"], t["final_bullets"], t["items"])
    return q.select("briefing_id", "duplicate_headlines", "near_identical_bullets", F.round("valid_url_share", 6).alias("valid_url_share"))


# planted from the rows themselves: scores above their range or missing, a fact without text, an over-full topic with a
# headline of an ideographic space, a topic without id or bullet count, a short bullet with an ftp url, a bullet of nulls
SQL_PLANTED = """, pf AS (SELECT briefing_id, cluster_id, fact_id, actionability, CASE WHEN doc_id % 5 = 0 THEN NULL ELSE novelty END AS novelty,
    CASE WHEN doc_id % 7 = 0 THEN 9 ELSE impact END AS impact, CASE WHEN doc_id % 11 = 0 THEN -1 ELSE reusability END AS reusability,
    CASE WHEN doc_id % 6 = 0 THEN 2 ELSE reliability END AS reliability, CASE WHEN doc_id % 13 = 0 THEN 2 ELSE agentic_bonus END AS agentic_bonus,
    CASE WHEN doc_id % 4 = 0 THEN NULL ELSE text END AS text, url FROM picked),
pt AS (SELECT briefing_id, topic_pos, topic_id, headline, n_bullets FROM final
  UNION ALL SELECT briefing_id, topic_pos, topic_id, chr(12288) || chr(10), n_bullets + 4 FROM final WHERE topic_pos = 1
  UNION ALL SELECT briefing_id, topic_pos, NULL, NULL, NULL FROM final WHERE topic_pos = 2),
pb AS (SELECT briefing_id, topic_pos, bullet_pos, text, url FROM final_bullets
  UNION ALL SELECT briefing_id, topic_pos, bullet_pos, substr(text, 1, 5), 'ftp://' || briefing_id FROM final_bullets WHERE bullet_pos = 2
  UNION ALL SELECT briefing_id, topic_pos, NULL, NULL, NULL FROM final_bullets WHERE bullet_pos = 3),
fk AS (SELECT *, briefing_id || '/' || cluster_id || '/' || fact_id AS key FROM pf),
tk AS (SELECT *, briefing_id || '/' || topic_pos AS key FROM pt),
bk AS (SELECT *, briefing_id || '/' || topic_pos || '/' || coalesce(CAST(bullet_pos AS VARCHAR), 'null') AS key FROM pb)
"""


@register("record_violations", W + SQL_PLANTED + """
SELECT 'fact' AS entity, key, 'actionability out of range' AS rule FROM fk WHERE actionability IS NULL OR actionability < 0 OR actionability > 3
UNION ALL SELECT 'fact', key, 'novelty out of range' FROM fk WHERE novelty IS NULL OR novelty < 0 OR novelty > 2
UNION ALL SELECT 'fact', key, 'impact out of range' FROM fk WHERE impact IS NULL OR impact < 0 OR impact > 2
UNION ALL SELECT 'fact', key, 'reusability out of range' FROM fk WHERE reusability IS NULL OR reusability < 0 OR reusability > 2
UNION ALL SELECT 'fact', key, 'reliability out of range' FROM fk WHERE reliability IS NULL OR reliability < 0 OR reliability > 1
UNION ALL SELECT 'fact', key, 'agentic_bonus out of range' FROM fk WHERE agentic_bonus IS NULL OR agentic_bonus < 0 OR agentic_bonus > 1
UNION ALL SELECT 'fact', key, 'fact text missing' FROM fk WHERE text IS NULL
UNION ALL SELECT 'topic', key, 'bullets outside 1..4' FROM tk WHERE n_bullets IS NULL OR n_bullets < 1 OR n_bullets > 4
UNION ALL SELECT 'topic', key, 'empty headline' FROM tk WHERE headline IS NULL OR headline = chr(12288) || chr(10)
UNION ALL SELECT 'topic', key, 'topic id missing' FROM tk WHERE topic_id IS NULL
UNION ALL SELECT 'bullet', key, 'bullet text shorter than 8' FROM bk WHERE text IS NULL OR length(text) < 8
UNION ALL SELECT 'bullet', key, 'url not http(s)' FROM bk WHERE url IS NULL OR NOT starts_with(url, 'https://')
UNION ALL SELECT 'briefing', briefing_id, 'title missing' FROM bundles GROUP BY briefing_id HAVING briefing_id = 'fr'
""")
def q_record_violations(spark, sf):
    t = digest_tables(spark, sf)
    final, fb = t["final"].select("briefing_id", "topic_pos", "topic_id", "headline", "n_bullets"), t["final_bullets"]
    doc = F.col("doc_id")
    null = F.lit(None)
    pf = (t["picked"].withColumn("novelty", F.when(doc % 5 != 0, F.col("novelty")))
          .withColumn("impact", F.when(doc % 7 == 0, F.lit(9)).otherwise(F.col("impact")))
          .withColumn("reusability", F.when(doc % 11 == 0, F.lit(-1)).otherwise(F.col("reusability")))
          .withColumn("reliability", F.when(doc % 6 == 0, F.lit(2)).otherwise(F.col("reliability")))
          .withColumn("agentic_bonus", F.when(doc % 13 == 0, F.lit(2)).otherwise(F.col("agentic_bonus")))
          .withColumn("text", F.when(doc % 4 != 0, F.col("text"))))
    pt = final.unionByName(final.filter("topic_pos = 1").withColumn("headline", F.lit("\u3000\n"))
                           .withColumn("n_bullets", F.col("n_bullets") + 4)).unionByName(
        final.filter("topic_pos = 2").withColumn("topic_id", null.cast("string")).withColumn("headline", null.cast("string"))
        .withColumn("n_bullets", null.cast("long")))
    pb = fb.unionByName(fb.filter("bullet_pos = 2").withColumn("text", F.substring("text", 1, 5))
                        .withColumn("url", F.concat(F.lit("ftp://"), F.col("briefing_id")))).unionByName(
        fb.filter("bullet_pos = 3").withColumn("bullet_pos", null.cast("int")).withColumn("text", null.cast("string"))
        .withColumn("url", null.cast("string")))
    headers = t["bundles"].select("briefing_id").distinct().select(
        "briefing_id", F.when(F.col("briefing_id") != "fr", F.lit("Digest")).alias("title"), F.lit("2024-01-31").alias("date"))
    return check_records(pf, pt, pb, headers)


# planted: the first general topic of the German briefing gets a fifth bullet, so that briefing is not published
@register("published_topics", W + """, bad AS (SELECT 'de' AS briefing_id)
SELECT briefing_id, topic_pos::INTEGER AS topic_pos, topic_id, CASE WHEN briefing_id IN (SELECT briefing_id FROM bad) THEN 'quarantine' ELSE 'published' END AS status
FROM final""")
def q_published_topics(spark, sf):
    t = digest_tables(spark, sf)
    first = F.min("topic_pos").over(Window.partitionBy("briefing_id"))
    over = t["final"].withColumn("n_bullets", F.when((F.col("briefing_id") == "de") & (F.col("topic_pos") == first), F.lit(5).cast("long"))
                                 .otherwise(F.col("n_bullets"))).drop("valid")
    good, _, bad = split_valid(mark_valid(over), t["final_bullets"])
    named = lambda d, s: d.select("briefing_id", F.col("topic_pos").cast("int").alias("topic_pos"), "topic_id", F.lit(s).alias("status"))
    return named(good, "published").unionByName(named(bad, "quarantine"))
