"""Text to digests through vectors and real clusters: hashed vectors, near-duplicates, density clusters per language,
bundles, facts and picks. One briefing per language."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidings.functions.text import approx_tokens
from tidings.operators.cluster import density_cluster
from tidings.operators.facts import extract_facts, pick_facts, score_facts
from tidings.operators.hashing import DIM, embed_hashed
from tidings.operators.packing import pack_batches_exact
from tidings.operators.vectors import build_bundles, near_duplicates, top_k_by_centroid
from tidings.plans.digest import SQL_CHAIN, fact_items
from tidings.plans.registry import register
from tidings.session import cut_lineage
from tidings.tables import read

# Cuts for the driver's documents (no pair's score is near them).
T_HASHED = 0.9
EPS_HASHED = 0.65
MIN_MEMBERS = 3

SQL_HASHED = rf"""
tok AS (SELECT doc_id, lang, md5(unnest(regexp_extract_all(lower(text), '[\p{{L}}\p{{N}}_]+'))) AS h FROM documents),
sl AS (SELECT doc_id, lang, (('0x' || substr(h, 1, 8))::BIGINT % {DIM})::INTEGER AS slot, sum(CASE WHEN substr(h, 9, 1) < '8' THEN 1 ELSE -1 END) AS x
       FROM tok GROUP BY ALL HAVING x <> 0),
hv AS MATERIALIZED (SELECT doc_id, lang, slot, x / sqrt(sum(x * x) OVER (PARTITION BY doc_id)) AS x FROM sl)"""

SQL_CLUSTERS = SQL_HASHED + f""",
cosine AS MATERIALIZED (SELECT a.doc_id AS a, b.doc_id AS b, sum(a.x * b.x) AS c FROM hv a JOIN hv b ON a.lang = b.lang AND a.slot = b.slot AND a.doc_id < b.doc_id
                        GROUP BY ALL HAVING c >= 0.5),
nb AS (SELECT b AS id, list(a) AS earlier FROM cosine WHERE c >= {T_HASHED} GROUP BY b),
ord AS MATERIALIZED (SELECT row_number() OVER (ORDER BY doc_id) AS rn, doc_id, coalesce(nb.earlier, []::BIGINT[]) AS earlier
                     FROM documents LEFT JOIN nb ON nb.id = doc_id),
g(rn, kept) AS (SELECT 0::BIGINT, []::BIGINT[] UNION ALL
  SELECT g.rn + 1, CASE WHEN list_has_any(g.kept, o.earlier) THEN g.kept ELSE list_append(g.kept, o.doc_id) END FROM g JOIN ord o ON o.rn = g.rn + 1),
kept AS MATERIALIZED (SELECT unnest(kept) AS doc_id FROM g WHERE rn = (SELECT count(*) FROM ord)),
nbr AS MATERIALIZED (SELECT a, b FROM cosine JOIN kept x ON x.doc_id = a JOIN kept y ON y.doc_id = b WHERE sqrt(greatest(2 - 2 * c, 0)) <= {EPS_HASHED}),
core AS MATERIALIZED (SELECT node FROM (SELECT a AS node FROM nbr UNION ALL SELECT b FROM nbr) GROUP BY node HAVING count(*) + 1 >= {MIN_MEMBERS}),
ce AS MATERIALIZED (SELECT a AS src, b AS dst FROM nbr SEMI JOIN core x ON x.node = a SEMI JOIN core y ON y.node = b
                    UNION ALL SELECT b, a FROM nbr SEMI JOIN core x ON x.node = a SEMI JOIN core y ON y.node = b),
reach(node, comp) AS (SELECT node, node FROM core UNION SELECT ce.dst, reach.comp FROM reach JOIN ce ON ce.src = reach.node),
comp AS MATERIALIZED (SELECT node, min(comp) AS comp FROM reach GROUP BY node),
lab AS MATERIALIZED (SELECT lang, doc_id, label FROM documents JOIN comp ON node = doc_id
  JOIN (SELECT lang AS l, comp, (row_number() OVER (PARTITION BY lang ORDER BY comp) - 1)::INTEGER AS label
        FROM (SELECT comp FROM comp GROUP BY comp HAVING count(*) >= {MIN_MEMBERS}) JOIN documents ON doc_id = comp) USING (comp))"""


@register("embed_hashed", "WITH " + SQL_HASHED + "\nSELECT doc_id, slot AS pos, round(x, 6) AS value FROM hv")
def q_embed_hashed(spark, sf):
    v = embed_hashed(read(spark, sf, "documents"), id_col="doc_id")
    return v.select("doc_id", F.posexplode("embedding").alias("pos", "x")).filter("x <> 0").select("doc_id", "pos", F.round("x", 6).alias("value"))


def text_clusters(spark, sf):
    """lang, doc_id, embedding, label of the documents that the near-duplicate scan keeps (-1: no cluster)."""
    vecs = cut_lineage(embed_hashed(read(spark, sf, "documents"), id_col="doc_id", group_cols=["lang"]))
    kept = cut_lineage(near_duplicates(vecs, T_HASHED, id_col="doc_id", group_cols=["lang"]))
    labels = density_cluster(kept, EPS_HASHED, MIN_MEMBERS, id_col="doc_id", group_cols=["lang"])
    return cut_lineage(kept.join(labels, ["lang", "doc_id"]))


@register("text_clusters", "WITH RECURSIVE " + SQL_CLUSTERS + """
SELECT documents.lang, doc_id, coalesce(label, -1)::INTEGER AS label FROM documents JOIN kept USING (doc_id) LEFT JOIN lab USING (doc_id)""")
def q_text_clusters(spark, sf):
    return text_clusters(spark, sf).select("lang", "doc_id", "label")


_SQL_ITEMS = SQL_CHAIN[:SQL_CHAIN.index("gate AS")].replace("'cluster-' || d.source AS cluster_id", "'cluster-' || lab.label AS cluster_id").replace(
    "FROM documents d LEFT JOIN labels l USING (doc_id)", "FROM documents d JOIN lab USING (doc_id) LEFT JOIN labels l USING (doc_id)")


@register("text_digest", "WITH RECURSIVE " + SQL_CLUSTERS + "," + _SQL_ITEMS + """
gate AS (SELECT briefing_id, cluster_id FROM scored GROUP BY briefing_id, cluster_id HAVING bool_or(actionability > 0 OR impact > 0)),
picked AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY briefing_id, cluster_id ORDER BY weighted_total DESC, fact_idx) AS pick_rank
           FROM scored SEMI JOIN gate USING (briefing_id, cluster_id)) WHERE pick_rank <= 3),
per AS (SELECT briefing_id, cluster_id, count(*) AS n_items, min(doc_id) AS first, min(lab.label) AS label FROM fi JOIN lab USING (doc_id) GROUP BY ALL),
pos AS (SELECT *, row_number() OVER (PARTITION BY briefing_id ORDER BY n_items DESC, first, label)::INTEGER AS bundle_pos FROM per)
SELECT briefing_id, cluster_id, bundle_pos, n_items, pick_rank::INTEGER AS pick_rank, doc_id, picked.pos::INTEGER AS sentence, weighted_total
FROM picked JOIN (SELECT briefing_id, cluster_id, bundle_pos, n_items FROM pos) USING (briefing_id, cluster_id)""")
def q_text_digest(spark, sf):
    members = text_clusters(spark, sf).filter("label >= 0")
    ranked = top_k_by_centroid(members, id_col="doc_id", key_cols=["lang", "label"])
    bundles = build_bundles(ranked, id_col="doc_id", group_cols=["lang"]).select(
        F.col("lang").alias("briefing_id"), F.concat(F.lit("cluster-"), F.col("label").cast("string")).alias("cluster_id"), "bundle_pos", "n_items", "doc_id")
    bundles = cut_lineage(bundles)
    items = fact_items(spark, sf).drop("cluster_id").join(bundles.select("briefing_id", "cluster_id", "doc_id"), ["briefing_id", "doc_id"])
    fact_url = F.when((F.col("doc_id") + F.col("_p")) % 17 == 0, F.concat(F.lit("https://elsewhere.example.org/"), F.col("doc_id").cast("string"))).otherwise(F.col("url"))
    facts, _ = extract_facts(items, fact_url=fact_url)
    picked, _ = pick_facts(cut_lineage(score_facts(facts, agentic=F.col("agentic"), strategic=F.col("strategic"))))
    places = bundles.select("briefing_id", "cluster_id", "bundle_pos", "n_items").distinct()
    return picked.join(places, ["briefing_id", "cluster_id"]).select(
        "briefing_id", "cluster_id", "bundle_pos", "n_items", F.col("pick_rank").cast("int").alias("pick_rank"), "doc_id", F.col("pos").alias("sentence"), "weighted_total")


@register("pack_batches_whole", """
WITH RECURSIVE t AS (SELECT doc_id, greatest(1, CAST(ceil(length(text) / 4.0) AS INTEGER)) AS tokens, row_number() OVER (ORDER BY doc_id) AS rn FROM documents),
r(rn, doc_id, tokens, batch_no, cur) AS (
  SELECT rn, doc_id, tokens, 0, tokens FROM t WHERE rn = 1 UNION ALL
  SELECT t.rn, t.doc_id, t.tokens, CASE WHEN r.cur + t.tokens > 8192 THEN r.batch_no + 1 ELSE r.batch_no END,
         CASE WHEN r.cur + t.tokens > 8192 THEN t.tokens ELSE r.cur + t.tokens END
  FROM r JOIN t ON t.rn = r.rn + 1)
SELECT doc_id, tokens, batch_no::INTEGER AS batch_no FROM r""")
def q_pack_batches_whole(spark, sf):
    """The whole table as one group."""
    d = read(spark, sf, "documents").select("doc_id", approx_tokens(F.col("text")).alias("tokens"))
    return pack_batches_exact(d, 8192, group_cols=[], order_col="doc_id")
