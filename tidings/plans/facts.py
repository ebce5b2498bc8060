"""Registered fact, selection and topic queries (stages 1-3 and the stage-4 pieces) on the digest chain."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidings.functions.scores import SCORE_DIMENSIONS, weighted_total
from tidings.operators.briefing import (
    cluster_sources,
    diversify_top3,
    focus_section,
    lookup_with_fallback,
    order_topics,
    primary_source,
    score_selection,
    selection_flags,
    split_focus,
)
from tidings.operators.facts import CLUSTER, check_citations, draft_id, gate_clusters, low_value_gate
from tidings.operators.render import cap_bullets
from tidings.plans.digest import SQL_CHAIN, digest_tables
from tidings.plans.registry import register

W = "WITH " + SQL_CHAIN + "\n"


def _r6(c):
    return F.round(c, 6)


@register("extract_facts", W + "SELECT briefing_id, cluster_id, fact_id, doc_id, pos::INTEGER AS pos, text FROM scored")
def q_extract_facts(spark, sf):
    f = digest_tables(spark, sf)["facts"]
    return f.select("briefing_id", "cluster_id", "fact_id", "doc_id", F.col("pos").cast("int").alias("pos"), "text")


@register("evidence_kept", W + "SELECT briefing_id, cluster_id, fact_id, url FROM scored")
def q_evidence_kept(spark, sf):
    return digest_tables(spark, sf)["facts"].select("briefing_id", "cluster_id", "fact_id", "url")


@register("evidence_rejected", W + "SELECT briefing_id, cluster_id, CAST(doc_id AS VARCHAR) AS item_id, p::INTEGER AS pos, reason FROM fr WHERE reason IS NOT NULL")
def q_evidence_rejected(spark, sf):
    r = digest_tables(spark, sf)["rejected"]
    return r.select("briefing_id", "cluster_id", "item_id", F.col("pos").cast("int").alias("pos"), "reason")


@register("score_facts", W + """SELECT briefing_id, cluster_id, fact_id, actionability, novelty, impact, reusability, reliability, agentic_bonus,
  strategic_flag::INTEGER AS strategic_flag, round(weighted_total, 6) AS weighted_total FROM scored""")
def q_score_facts(spark, sf):
    s = digest_tables(spark, sf)["scored"]
    return s.select("briefing_id", "cluster_id", "fact_id", *SCORE_DIMENSIONS, F.col("strategic_flag").cast("int").alias("strategic_flag"),
                    _r6(F.col("weighted_total")).alias("weighted_total"))


@register("raw_total", W + "SELECT briefing_id, cluster_id, fact_id, raw_total FROM scored")
def q_raw_total(spark, sf):
    return digest_tables(spark, sf)["scored"].select("briefing_id", "cluster_id", "fact_id", "raw_total")


# weight overrides: a known key with a numeric string, an unknown key, and an unparsable value
WEIGHT_OVERRIDES = {"actionability": "4", "bogus": 9, "novelty": "x", "impact": None, "reliability": 0.5}


@register("weighted_total", W + """SELECT briefing_id, cluster_id, fact_id,
  round((4.0 * actionability + 2.0 * novelty + 2.0 * impact + 2.0 * reusability + 0.5 * reliability + 1.0 * agentic_bonus)::DOUBLE, 6) AS weighted
FROM scored""")
def q_weighted_total(spark, sf):
    s = digest_tables(spark, sf)["scored"]
    return s.select("briefing_id", "cluster_id", "fact_id", _r6(weighted_total(weights=WEIGHT_OVERRIDES)).alias("weighted"))


@register("low_value_gate", W + """SELECT briefing_id, cluster_id, ((briefing_id, cluster_id) IN (SELECT briefing_id, cluster_id FROM gate))::INTEGER AS may_pick
FROM (SELECT DISTINCT briefing_id, cluster_id FROM scored)""")
def q_low_value_gate(spark, sf):
    s = digest_tables(spark, sf)["scored"]
    g = low_value_gate(s).withColumn("may_pick", F.lit(1))
    return s.select(*CLUSTER).distinct().join(g, CLUSTER, "left").select(
        *CLUSTER, F.coalesce("may_pick", F.lit(0)).alias("may_pick"))


@register("pick_facts", W + "SELECT briefing_id, cluster_id, fact_id, pick_rank::INTEGER AS pick_rank, round(weighted_total, 6) AS weighted_total FROM picked")
def q_pick_facts(spark, sf):
    p = digest_tables(spark, sf)["picked"]
    return p.select("briefing_id", "cluster_id", "fact_id", F.col("pick_rank").cast("int").alias("pick_rank"), _r6(F.col("weighted_total")).alias("weighted_total"))


@register("dropped_facts", W + "SELECT briefing_id, cluster_id, fact_id, reason FROM dropped")
def q_dropped_facts(spark, sf):
    return digest_tables(spark, sf)["dropped"].select("briefing_id", "cluster_id", "fact_id", "reason")


@register("compose_topics", W + """SELECT briefing_id, cluster_id, topic_id, headline, agentic::INTEGER AS agentic, strategic::INTEGER AS strategic,
  n_bullets FROM drafts""")
def q_compose_topics(spark, sf):
    d = digest_tables(spark, sf)["drafts"]
    return d.select("briefing_id", "cluster_id", "topic_id", "headline", F.col("agentic").cast("int").alias("agentic"),
                    F.col("strategic").cast("int").alias("strategic"), "n_bullets")


# planted: the drafts of every seventh bundle come back without bullets
@register("stage_gates", W + """SELECT b.briefing_id, b.cluster_id, b.bundle_pos::INTEGER AS bundle_pos,
  CASE WHEN d.cluster_id IS NULL THEN 'skipped: no picked fact' WHEN b.bundle_pos % 7 = 0 THEN 'skipped: no bullets' ELSE 'topic' END AS status
FROM bundles b LEFT JOIN drafts d USING (briefing_id, cluster_id)""")
def q_stage_gates(spark, sf):
    t = digest_tables(spark, sf)
    bundles = t["bundles"]
    empty = bundles.filter("bundle_pos % 7 = 0").select(*CLUSTER)
    g = gate_clusters(bundles, t["picked"], t["bullets"].join(empty, CLUSTER, "left_anti"))
    return g.select(*CLUSTER, F.col("bundle_pos").cast("int").alias("bundle_pos"), "status")


SQL_LOOKUP_LEFT = """lk AS (SELECT briefing_id, topic_id AS key FROM drafts
  UNION ALL SELECT briefing_id, cluster_id FROM drafts WHERE briefing_id = 'en'
  UNION ALL SELECT briefing_id, 'cluster-nomatch-' || cluster_id FROM drafts WHERE briefing_id = 'de'),
sel AS (SELECT briefing_id, cluster_id, max(weighted_total) AS score, max(actionability) AS actionability, count(*) AS picked_count FROM picked GROUP BY ALL)"""


@register("id_fallback_join", W + ", " + SQL_LOOKUP_LEFT + """
SELECT lk.briefing_id, lk.key, coalesce(e.cluster_id, f.cluster_id) AS cluster_id, round(coalesce(e.score, f.score, 0.0), 6) AS score,
       coalesce(e.actionability, f.actionability, 0)::INTEGER AS actionability, coalesce(e.picked_count, f.picked_count, 0) AS picked_count
FROM lk LEFT JOIN sel e ON e.briefing_id = lk.briefing_id AND e.cluster_id = lk.key
LEFT JOIN sel f ON f.briefing_id = lk.briefing_id AND e.cluster_id IS NULL AND starts_with(lk.key, 'cluster-') AND f.cluster_id = substr(lk.key, 9)""")
def q_id_fallback_join(spark, sf):
    t = digest_tables(spark, sf)
    d = t["drafts"]
    left = (d.select("briefing_id", F.col("topic_id").alias("key"))
            .unionByName(d.filter("briefing_id = 'en'").select("briefing_id", F.col("cluster_id").alias("key")))
            .unionByName(d.filter("briefing_id = 'de'").select("briefing_id", F.concat(F.lit("cluster-nomatch-"), "cluster_id").alias("key"))))
    j = lookup_with_fallback(left, score_selection(t["picked"]), left_key="key", dim_key="cluster_id")
    return j.select("briefing_id", "key", F.col("d_cluster_id").alias("cluster_id"), _r6(F.coalesce("d_score", F.lit(0.0))).alias("score"),
                    F.coalesce("d_actionability", F.lit(0)).cast("int").alias("actionability"),
                    F.coalesce("d_picked_count", F.lit(0)).alias("picked_count"))


@register("selection_scores", W + """SELECT briefing_id, topic_id, round(score, 6) AS score, actionability::INTEGER AS actionability, picked_count,
  bundle_pos::INTEGER AS bundle_pos FROM tin""")
def q_selection_scores(spark, sf):
    t = digest_tables(spark, sf)["topics_in"]
    return t.select("briefing_id", "topic_id", _r6(F.col("score")).alias("score"), F.col("actionability").cast("int").alias("actionability"),
                    "picked_count", F.col("bundle_pos").cast("int").alias("bundle_pos"))


# the same selection under overridden weights: scores, and the topic order that follows from them
@register("weighted_order", W + """, ws AS (SELECT briefing_id, cluster_id, max(4.0 * actionability + 2.0 * novelty + 2.0 * impact + 2.0 * reusability
    + 0.5 * reliability + 1.0 * agentic_bonus)::DOUBLE AS score FROM picked GROUP BY ALL)
SELECT t.briefing_id, t.topic_id, round(ws.score, 6) AS score, (row_number() OVER (PARTITION BY t.briefing_id
    ORDER BY ws.score DESC, t.actionability DESC, t.picked_count DESC, t.bundle_pos))::INTEGER AS ord
FROM tin t JOIN ws USING (briefing_id, cluster_id)""")
def q_weighted_order(spark, sf):
    t = digest_tables(spark, sf)
    scores = score_selection(t["picked"], WEIGHT_OVERRIDES).select(*CLUSTER, F.col("score").alias("_score"))
    o = order_topics(t["topics_in"].join(scores, CLUSTER).withColumn("score", F.col("_score")))
    return o.select("briefing_id", "topic_id", _r6(F.col("score")).alias("score"), F.col("ord").cast("int").alias("ord"))


@register("selection_flags", W + """SELECT briefing_id, cluster_id, max(raw_total) AS max_raw_score, bool_or(agentic_bonus > 0)::INTEGER AS has_agentic,
  bool_or(strategic_flag)::INTEGER AS has_strategic FROM picked GROUP BY briefing_id, cluster_id""")
def q_selection_flags(spark, sf):
    f = selection_flags(digest_tables(spark, sf)["picked"])
    return f.select("briefing_id", "cluster_id", "max_raw_score", F.col("has_agentic").cast("int").alias("has_agentic"),
                    F.col("has_strategic").cast("int").alias("has_strategic"))


@register("cluster_sources", W + """SELECT briefing_id, cluster_id, string_agg(src, ',' ORDER BY f, src) AS sources FROM (
  SELECT briefing_id, cluster_id, coalesce(source, 'unknown') AS src, min(doc_id) AS f FROM fi GROUP BY ALL) GROUP BY ALL""")
def q_cluster_sources(spark, sf):
    return digest_tables(spark, sf)["sources"].select(*CLUSTER, "sources")


@register("primary_source", W + "SELECT briefing_id, cluster_id, primary_source FROM psrc")
def q_primary_source(spark, sf):
    return primary_source(digest_tables(spark, sf)["items"]).select(*CLUSTER, "primary_source")


# half of the items carry their source only in the metadata, as older feeds wrote it
SQL_META = """, ms AS (SELECT briefing_id, cluster_id, doc_id, CASE WHEN doc_id % 2 = 0 THEN source END AS own, source AS named FROM fi)"""


@register("source_modes", W + SQL_META + """
SELECT briefing_id, cluster_id, string_agg(src, ',' ORDER BY f, src) AS sources,
       (SELECT arg_min(named, doc_id) FROM ms m WHERE m.briefing_id = x.briefing_id AND m.cluster_id = x.cluster_id AND named IS NOT NULL) AS first_source,
       (SELECT arg_min(own, doc_id) FROM ms m WHERE m.briefing_id = x.briefing_id AND m.cluster_id = x.cluster_id AND own IS NOT NULL) AS legacy_source
FROM (SELECT briefing_id, cluster_id, coalesce(named, 'unknown') AS src, min(doc_id) AS f FROM ms GROUP BY ALL) x GROUP BY ALL""")
def q_source_modes(spark, sf):
    items = digest_tables(spark, sf)["items"].withColumn("metadata", F.create_map(F.lit("source"), F.col("source"))).withColumn(
        "source", F.when(F.col("doc_id") % 2 == 0, F.col("source")))
    first = primary_source(items).withColumnRenamed("primary_source", "first_source")
    legacy = primary_source(items, legacy_source=True).withColumnRenamed("primary_source", "legacy_source")
    return cluster_sources(items).join(first, CLUSTER, "left").join(legacy, CLUSTER, "left")


@register("order_topics", W + "SELECT briefing_id, topic_id, ord::INTEGER AS ord FROM tin")
def q_order_topics(spark, sf):
    o = order_topics(digest_tables(spark, sf)["topics_in"])
    return o.select("briefing_id", "topic_id", F.col("ord").cast("int").alias("ord"))


@register("focus_split", W + "SELECT briefing_id, topic_id, in_focus::INTEGER AS in_focus FROM fsplit")
def q_focus_split(spark, sf):
    o = split_focus(order_topics(digest_tables(spark, sf)["topics_in"]))
    return o.select("briefing_id", "topic_id", F.col("in_focus").cast("int").alias("in_focus"))


@register("diversify_top3", W + "SELECT briefing_id, topic_id, primary_source, place::INTEGER AS place FROM placed")
def q_diversify_top3(spark, sf):
    o = split_focus(order_topics(digest_tables(spark, sf)["topics_in"]))
    d = diversify_top3(o.filter(~F.col("in_focus")))
    return d.select("briefing_id", "topic_id", "primary_source", F.col("place").cast("int").alias("place"))


@register("focus_section", W + "SELECT briefing_id, bullet_pos::INTEGER AS bullet_pos, text, url FROM fb")
def q_focus_section(spark, sf):
    t = digest_tables(spark, sf)
    o = split_focus(order_topics(t["topics_in"]))
    _, fb = focus_section(o.filter("in_focus"), t["bullets"].select("briefing_id", "topic_id", "bullet_pos", "text", "url"))
    return fb.select("briefing_id", F.col("bullet_pos").cast("int").alias("bullet_pos"), "text", "url")


@register("cap_bullets", W + """, draft AS (SELECT s.briefing_id, s.cluster_id, s.fact_id, s.fact_idx, c.k FROM scored s JOIN
  (SELECT briefing_id, cluster_id, (count(DISTINCT doc_id) % 6) + 1 AS k FROM fi GROUP BY ALL) c USING (briefing_id, cluster_id) WHERE s.fact_idx < c.k)
SELECT briefing_id, cluster_id, (fact_idx + 1)::INTEGER AS bullet_pos, fact_id FROM draft WHERE k <= 4 AND fact_idx < 2""")
def q_cap_bullets(spark, sf):
    t = digest_tables(spark, sf)
    k = t["items"].groupBy(*CLUSTER).agg(((F.count_distinct("doc_id") % 6) + 1).alias("k"))
    draft = t["scored"].join(k, CLUSTER).filter(F.col("fact_idx") < F.col("k")).select(
        *CLUSTER, (F.col("fact_idx") + 1).cast("int").alias("bullet_pos"), "fact_id")
    return cap_bullets(draft, 2).select(*CLUSTER, "bullet_pos", "fact_id")


@register("citation_violations", W + """, bf AS (SELECT briefing_id, cluster_id, topic_id, bullet_pos,
    CASE WHEN bullet_pos = 2 AND doc_id % 2 = 0 THEN 'fact-999999' ELSE fact_id END AS fact_id,
    CASE WHEN bullet_pos = 3 AND doc_id % 3 = 0 THEN url || '?ref=digest' WHEN bullet_pos = 1 AND doc_id % 5 = 0 THEN NULL ELSE url END AS url FROM bullets)
SELECT bf.briefing_id, bf.cluster_id, bf.topic_id, bf.bullet_pos::INTEGER AS bullet_pos, bf.fact_id,
       CASE WHEN p.fact_id IS NULL THEN 'fact not picked' ELSE 'url mismatch' END AS violation
FROM bf LEFT JOIN picked p ON p.briefing_id = bf.briefing_id AND p.cluster_id = bf.cluster_id AND p.fact_id = bf.fact_id
WHERE p.fact_id IS NULL OR bf.url IS NULL OR p.url <> bf.url""")
def q_citation_violations(spark, sf):
    t = digest_tables(spark, sf)
    pos, doc = F.col("pick_rank"), F.col("doc_id")
    b = t["picked"].filter(pos <= 4).select(
        "briefing_id", draft_id().alias("topic_id"), "cluster_id", pos.alias("bullet_pos"),
        F.when((pos == 2) & (doc % 2 == 0), F.lit("fact-999999")).otherwise(F.col("fact_id")).alias("fact_id"),
        F.when((pos == 3) & (doc % 3 == 0), F.concat("url", F.lit("?ref=digest"))).when((pos == 1) & (doc % 5 == 0), F.lit(None))
        .otherwise(F.col("url")).alias("url"))
    v = check_citations(b, t["picked"])
    return v.select(*CLUSTER, "topic_id", F.col("bullet_pos").cast("int").alias("bullet_pos"), "fact_id", "violation")
