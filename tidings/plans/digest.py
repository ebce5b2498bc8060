"""The digest chain over ``documents`` (+ ``labels``), shared by the fact, briefing and output queries.

Item view (FIXTURES B): briefing = language, cluster = source (the same cluster ids in every briefing, as labels
restart in every run), url per source, input order = doc_id. Item sources are coarsened to three feeds (a sixth of the items have none), so the diversity rule
has work to do. Flags: agentic = quality 1, not toxic and doc_id % 7 = 0; strategic = toxic.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from tidings.functions.scores import SCORE_DIMENSIONS
from tidings.operators.briefing import (
    cluster_sources,
    finalize,
    lookup_with_fallback,
    primary_source,
    score_selection,
    split_valid,
)
from tidings.operators.facts import (
    PLACE,
    best_facts,
    candidate_facts,
    check_facts,
    compose_topics,
    drop_facts,
    number_kept,
    number_picks,
    score_facts,
    whole_facts,
)
from tidings.plans import sqlfrag as S
from tidings.session import cut_lineage
from tidings.tables import read


def fact_items(spark, sf):
    d = read(spark, sf, "documents")
    lab = read(spark, sf, "labels")
    j = d.join(lab, "doc_id", "left")
    return j.select(
        F.col("lang").alias("briefing_id"),
        F.concat(F.lit("cluster-"), "source").alias("cluster_id"),
        "doc_id", "text",
        F.concat(F.lit("https://"), "source", F.lit(".example.com/"), F.col("doc_id").cast("string")).alias("url"),
        F.when(F.col("doc_id") % 6 == 0, F.lit(None).cast("string"))
        .otherwise(F.concat(F.lit("feed"), (F.substring("source", 4, 10).cast("int") % 3).cast("string"))).alias("source"),
        F.coalesce((F.col("quality") == 1) & (F.col("toxic") == 0) & (F.col("doc_id") % 7 == 0), F.lit(False)).alias("agentic"),
        F.coalesce(F.col("toxic") == 1, F.lit(False)).alias("strategic"),
    )


def digest_tables(spark, sf, max_bullets: int = 4, weights: dict | None = None) -> "Digest":
    """The digest chain over the tables of ``sf``. Stage outputs that several later steps read (scored facts,
    topic inputs, final tables) are written once in the checkpoint folder and shared inside this object; the
    caller that wants to share them between queries passes the object on."""
    return Digest(spark, sf, max_bullets, weights)


class Digest:
    def __init__(self, spark, sf, max_bullets=4, weights=None):
        self.spark, self.sf, self.max_bullets, self.weights = spark, sf, max_bullets, weights
        self._t = {}

    def __getitem__(self, name):
        if name not in self._t:
            self._t[name] = getattr(self, "_" + name)()
        return self._t[name]

    def _items(self):
        return fact_items(self.spark, self.sf)

    def _stage1(self):
        fact_url = F.when((F.col("doc_id") + F.col("_p")) % 17 == 0,
                          F.concat(F.lit("https://elsewhere.example.org/"), F.col("doc_id").cast("string"))).otherwise(F.col("url"))
        score = lambda s: score_facts(s, agentic=F.col("agentic"), strategic=F.col("strategic"), weights=self.weights)
        candidates = candidate_facts(self["items"], fact_url=fact_url, score=score)
        return candidates, *check_facts(candidates, self["items"], carry=["weighted_total", "actionability", "impact"])

    def _facts(self):
        return self["scored"].drop(*SCORE_DIMENSIONS, "strategic_flag", "raw_total", "weighted_total")

    def _rejected(self):
        return cut_lineage(self["stage1"][2])

    def _numbered(self):
        return number_kept(self["stage1"][1])

    def _scored(self):
        return whole_facts(self["numbered"], self["stage1"][0])

    def _picked(self):
        # the picks are written first: few rows then look for their numbers and texts
        candidates, kept, _ = self["stage1"]
        picks = cut_lineage(best_facts(kept, order=PLACE))
        return cut_lineage(whole_facts(cut_lineage(number_picks(picks, kept)), candidates))

    def _dropped(self):
        return drop_facts(self["numbered"], self["picked"])

    def _stage3(self):
        return compose_topics(self["picked"], max_bullets=self.max_bullets)

    def _drafts(self):
        return self["stage3"][0]

    def _bullets(self):
        return self["stage3"][1]

    def _bundles(self):
        from pyspark.sql import Window

        sizes = self["items"].groupBy("briefing_id", "cluster_id").agg(
            F.count(F.lit(1)).alias("n_items"), F.min("doc_id").alias("_first"))
        w = Window.partitionBy("briefing_id").orderBy(F.col("n_items").desc(), "_first", "cluster_id")
        return sizes.withColumn("bundle_pos", F.row_number().over(w)).drop("_first")

    def _sources(self):
        return cluster_sources(self["items"])

    def _topics_in(self):
        drafts = self["drafts"]
        sel = score_selection(self["picked"], self.weights)
        t = lookup_with_fallback(drafts.select("briefing_id", "topic_id", "headline", "agentic", "strategic",
                                               F.col("cluster_id").alias("_cl")), sel,
                                 left_key="topic_id", dim_key="cluster_id")
        t = t.select("briefing_id", "topic_id", "headline", "agentic", "strategic", "_cl", F.col("d_cluster_id").alias("cluster_id"),
                     F.coalesce("d_score", F.lit(0.0)).alias("score"),
                     F.coalesce("d_actionability", F.lit(0)).alias("actionability"),
                     F.coalesce("d_picked_count", F.lit(0)).alias("picked_count"))
        b = self["bundles"].select(F.col("cluster_id").alias("_cl"), "briefing_id", "bundle_pos")
        ps = primary_source(self["items"]).withColumnRenamed("cluster_id", "_cl")
        on = ["briefing_id", "_cl"]
        return cut_lineage(t.join(b, on).join(ps, on, "left").drop("_cl"))

    def _stage4(self):
        topics, bullets = finalize(self["topics_in"], self["bullets"].select("briefing_id", "topic_id", "bullet_pos", "text", "url"),
                                   max_bullets=self.max_bullets)
        return cut_lineage(topics), cut_lineage(bullets)

    def _final(self):
        return self["stage4"][0]

    def _final_bullets(self):
        return self["stage4"][1]

    def _published(self):
        return split_valid(self["final"], self["final_bullets"])


# ------------------------------------------------------------------ the same chain in DuckDB SQL
def _rule_sql():
    from tidings.functions.scores import SCORE_DIMENSIONS, SCORE_MAXIMA
    from tidings.operators.facts import SCORE_RULES

    cols = []
    for dim in SCORE_DIMENSIONS:
        if dim == "agentic_bonus":
            cols.append("(CASE WHEN agentic THEN 1 ELSE 0 END)::INTEGER AS agentic_bonus")
            continue
        parts = []
        for d, kind, arg, p in SCORE_RULES:
            if d != dim:
                continue
            test = f"regexp_matches(text, {S.lit(arg)})" if kind == "regex" else f"length(text) >= {arg}"
            parts.append(f"(CASE WHEN {test} THEN {p} ELSE 0 END)")
        cols.append(f"least({' + '.join(parts) or '0'}, {SCORE_MAXIMA[dim]})::INTEGER AS {dim}")
    return ", ".join(cols)


SQL_CHAIN = rf"""
fi AS MATERIALIZED (SELECT d.lang AS briefing_id, 'cluster-' || d.source AS cluster_id, d.doc_id, d.text,
        'https://' || d.source || '.example.com/' || d.doc_id AS url,
        CASE WHEN d.doc_id % 6 = 0 THEN NULL ELSE 'feed' || (CAST(substr(d.source, 4, 10) AS INTEGER) % 3) END AS source,
        coalesce(l.quality = 1 AND l.toxic = 0 AND d.doc_id % 7 = 0, false) AS agentic,
        coalesce(l.toxic = 1, false) AS strategic
      FROM documents d LEFT JOIN labels l USING (doc_id)),
sp AS (SELECT briefing_id, cluster_id, doc_id, url, agentic, strategic,
              unnest(parts) AS s, generate_subscripts(parts, 1) - 1 AS p
       FROM (SELECT *, string_split(regexp_replace(text, '([.!?])\s+', '\1' || chr(1), 'g'), chr(1)) AS parts FROM fi)),
ss AS (SELECT * FROM (SELECT *, {S.py_strip('s')} AS sentence FROM sp) WHERE sentence <> ''),
fu AS (SELECT *, CASE WHEN (doc_id + p) % 17 = 0 THEN 'https://elsewhere.example.org/' || doc_id ELSE url END AS fact_url,
              row_number() OVER (PARTITION BY briefing_id, cluster_id, sentence ORDER BY doc_id, p) > 1 AS is_dup FROM ss),
fr AS (SELECT fu.*, CASE WHEN is_dup THEN 'duplicate'
                         WHEN fact_url NOT IN (SELECT url FROM fi WHERE fi.cluster_id = fu.cluster_id AND fi.briefing_id = fu.briefing_id) THEN 'unverifiable' END AS reason
       FROM fu),
facts AS MATERIALIZED (SELECT briefing_id, cluster_id, doc_id, p AS pos, sentence AS text, fact_url AS url, agentic, strategic,
                 row_number() OVER (PARTITION BY briefing_id, cluster_id ORDER BY doc_id, p) - 1 AS fact_idx
          FROM fr WHERE reason IS NULL),
scored AS MATERIALIZED (SELECT *, 'fact-' || fact_idx AS fact_id,
                 (actionability + novelty + impact + reusability + reliability + agentic_bonus)::INTEGER AS raw_total,
                 (3.0 * actionability + 2.0 * novelty + 2.0 * impact + 2.0 * reusability + 1.0 * reliability + 1.0 * agentic_bonus)::DOUBLE AS weighted_total,
                 strategic AS strategic_flag
          FROM (SELECT *, {_rule_sql()} FROM facts)),
gate AS (SELECT briefing_id, cluster_id FROM scored GROUP BY briefing_id, cluster_id HAVING bool_or(actionability > 0 OR impact > 0)),
picked AS MATERIALIZED (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY briefing_id, cluster_id ORDER BY weighted_total DESC, fact_idx) AS pick_rank
                 FROM scored WHERE (briefing_id, cluster_id) IN (SELECT briefing_id, cluster_id FROM gate)) WHERE pick_rank <= 3),
dropped AS (SELECT s.briefing_id, s.cluster_id, s.fact_id,
                   CASE WHEN (s.briefing_id, s.cluster_id) IN (SELECT briefing_id, cluster_id FROM gate) THEN 'not in top picks' ELSE 'low value' END AS reason
            FROM scored s WHERE NOT EXISTS (SELECT 1 FROM picked p WHERE p.briefing_id = s.briefing_id AND p.cluster_id = s.cluster_id AND p.fact_id = s.fact_id)),
drafts AS MATERIALIZED (SELECT cluster_id, briefing_id, 'cluster-' || cluster_id AS topic_id,
                 arg_min(text, pick_rank) AS headline, bool_or(agentic_bonus > 0) AS agentic, bool_or(strategic_flag) AS strategic,
                 count(*) AS n_bullets, max(weighted_total) AS score, max(actionability) AS actionability, count(*) AS picked_count
          FROM picked GROUP BY briefing_id, cluster_id),
bullets AS (SELECT 'cluster-' || cluster_id AS topic_id, cluster_id, briefing_id, pick_rank AS bullet_pos, text, url, fact_id, doc_id
            FROM picked WHERE pick_rank <= 4),
bundles AS (SELECT briefing_id, cluster_id, n_items,
                   row_number() OVER (PARTITION BY briefing_id ORDER BY n_items DESC, first, cluster_id) AS bundle_pos
            FROM (SELECT briefing_id, cluster_id, count(*) AS n_items, min(doc_id) AS first FROM fi GROUP BY ALL)),
psrc AS (SELECT briefing_id, cluster_id, arg_min(source, doc_id) AS primary_source FROM fi WHERE source IS NOT NULL AND source <> '' GROUP BY briefing_id, cluster_id),
tin AS (SELECT d.*, b.bundle_pos, ps.primary_source,
               row_number() OVER (PARTITION BY d.briefing_id ORDER BY d.score DESC, d.actionability DESC, d.picked_count DESC, b.bundle_pos) AS ord
        FROM drafts d JOIN bundles b USING (briefing_id, cluster_id) LEFT JOIN psrc ps USING (briefing_id, cluster_id)),
fsplit AS (SELECT *, agentic AND NOT (n_gen = 0 AND (n_ag = 1 OR ord = first_ag)) AS in_focus
           FROM (SELECT *, count(*) FILTER (WHERE NOT agentic) OVER (PARTITION BY briefing_id) AS n_gen,
                         count(*) FILTER (WHERE agentic) OVER (PARTITION BY briefing_id) AS n_ag,
                         min(CASE WHEN agentic THEN ord END) OVER (PARTITION BY briefing_id) AS first_ag FROM tin)),
gen AS (SELECT *, row_number() OVER (PARTITION BY briefing_id ORDER BY ord) AS rn FROM fsplit WHERE NOT in_focus),
g1 AS (SELECT g.*, s.s1 FROM gen g LEFT JOIN (SELECT briefing_id, primary_source AS s1 FROM gen WHERE rn = 1) s USING (briefing_id)),
r2 AS (SELECT briefing_id, coalesce(min(rn) FILTER (WHERE rn > 1 AND (primary_source IS NULL OR s1 IS NULL OR primary_source <> s1)),
                                    min(rn) FILTER (WHERE rn > 1)) AS r2 FROM g1 GROUP BY briefing_id),
g2 AS (SELECT g1.*, r2.r2, s2.s2 FROM g1 JOIN r2 USING (briefing_id)
       LEFT JOIN (SELECT g1.briefing_id, g1.primary_source AS s2 FROM g1 JOIN r2 USING (briefing_id) WHERE g1.rn = r2.r2) s2 USING (briefing_id)),
r3 AS (SELECT briefing_id, coalesce(min(rn) FILTER (WHERE rn <> 1 AND rn <> r2 AND (primary_source IS NULL OR
                 ((s1 IS NULL OR primary_source <> s1) AND (s2 IS NULL OR primary_source <> s2)))),
                 min(rn) FILTER (WHERE rn <> 1 AND rn <> r2)) AS r3 FROM g2 GROUP BY briefing_id),
placed AS (SELECT g2.*, row_number() OVER (PARTITION BY briefing_id ORDER BY
                 CASE WHEN rn = 1 THEN 1 WHEN rn = r2 THEN 2 WHEN rn = r3 THEN 3 ELSE 4 END, rn) AS place
           FROM g2 LEFT JOIN r3 USING (briefing_id)),
fb AS (SELECT * FROM (SELECT f.briefing_id, b.text, b.url,
                 row_number() OVER (PARTITION BY f.briefing_id ORDER BY f.ord, b.bullet_pos) AS bullet_pos
          FROM fsplit f JOIN bullets b USING (briefing_id, topic_id) WHERE f.in_focus) WHERE bullet_pos <= 4),
hasf AS (SELECT DISTINCT briefing_id FROM fb),
final AS (SELECT briefing_id, place + (CASE WHEN briefing_id IN (SELECT briefing_id FROM hasf) THEN 1 ELSE 0 END) AS topic_pos,
                 {S.sanitize_topic_id('cluster_id')} AS topic_id, {S.flag_headline('headline', 'strategic')} AS headline,
                 least(n_bullets, 4) AS n_bullets, topic_id AS draft_id
          FROM placed
          UNION ALL
          SELECT briefing_id, 1, 'agentic-focus', 'Agentic Focus', count(*), NULL FROM fb GROUP BY briefing_id),
final_bullets AS (SELECT f.briefing_id, f.topic_pos, b.bullet_pos, b.text, b.url FROM final f JOIN bullets b ON b.topic_id = f.draft_id AND b.briefing_id = f.briefing_id
                  UNION ALL
                  SELECT briefing_id, 1, bullet_pos, text, url FROM fb)"""
