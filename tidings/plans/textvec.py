"""Registered text-vector queries over ``documents``: TF vectors, exact text near-dup (t = 0.95),
BM25 rerank per cluster, document bundles and token-budget batches."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidings.functions.text import approx_tokens
from tidings.operators.textvec import embed_tf, pack_batches, rerank_bm25, text_block_pairs, text_near_duplicates, tf_medoid_scores
from tidings.operators.vectors import build_bundles
from tidings.plans.registry import register
from tidings.session import cut_lineage
from tidings.tables import read

T_TEXT = 0.95


def doc_clusters(spark, sf):
    d = read(spark, sf, "documents")
    return d.select("doc_id", "text", "lang", "source",
                    F.concat(F.lit("cluster-"), "lang", F.lit("-"), "source").alias("cluster_id"))


SQL_TF = r"""
tok AS (SELECT doc_id, lang, 'cluster-' || lang || '-' || source AS cluster_id,
               unnest(regexp_extract_all(lower(text), '[\p{L}\p{N}_]+')) AS token FROM documents),
tf AS (SELECT doc_id, lang, cluster_id, token, count(*) AS tf FROM tok GROUP BY ALL),
nr AS (SELECT doc_id, sqrt(sum(tf * tf)) AS n FROM tf GROUP BY doc_id),
w AS MATERIALIZED (SELECT tf.doc_id, lang, cluster_id, token, tf, tf / n AS w FROM tf JOIN nr USING (doc_id))"""

SQL_TEXT_GREEDY = SQL_TF + """,
p AS MATERIALIZED (SELECT a.doc_id AS a, b.doc_id AS b FROM w a JOIN w b
                   ON a.lang = b.lang AND a.token = b.token AND a.doc_id < b.doc_id
                   GROUP BY a.doc_id, b.doc_id HAVING sum(a.w * b.w) >= 0.95),
nb AS (SELECT b AS id, list(a) AS earlier FROM p GROUP BY b),
ord AS MATERIALIZED (SELECT row_number() OVER (ORDER BY d.doc_id) AS rn, d.doc_id,
                            coalesce(nb.earlier, []::BIGINT[]) AS earlier
                     FROM documents d LEFT JOIN nb ON nb.id = d.doc_id),
g(rn, kept) AS (SELECT 0::BIGINT, []::BIGINT[]
                UNION ALL
                SELECT g.rn + 1, CASE WHEN list_has_any(g.kept, o.earlier) THEN g.kept
                                      ELSE list_append(g.kept, o.doc_id) END
                FROM g JOIN ord o ON o.rn = g.rn + 1),
kept AS (SELECT unnest(kept) AS doc_id FROM g WHERE rn = (SELECT count(*) FROM ord))"""

SQL_RERANK = SQL_TF + """,
csize AS (SELECT cluster_id, count(DISTINCT doc_id) AS n FROM w GROUP BY cluster_id),
mean AS (SELECT cluster_id, token, sum(w) / any_value(n) AS m FROM w JOIN csize USING (cluster_id) GROUP BY ALL),
ms AS (SELECT w.cluster_id, doc_id, round(sum(w * m), 9) AS score FROM w JOIN mean USING (cluster_id, token) GROUP BY ALL),
q AS (SELECT cluster_id, arg_max(doc_id, (score, -doc_id)) AS qid FROM ms GROUP BY cluster_id),
cand AS (SELECT cluster_id, doc_id FROM ms),
cv AS (SELECT w.* FROM w JOIN cand USING (cluster_id, doc_id)),
dl AS (SELECT cluster_id, doc_id, sum(tf) AS dl FROM cv GROUP BY ALL),
st AS (SELECT cluster_id, count(*) AS nn, avg(dl) AS avgdl FROM dl GROUP BY ALL),
dfq AS (SELECT cluster_id, token, count(*) AS df FROM cv GROUP BY ALL),
qt AS (SELECT DISTINCT cv.cluster_id, token FROM cv JOIN q ON q.cluster_id = cv.cluster_id AND q.qid = cv.doc_id),
idf AS (SELECT qt.cluster_id, qt.token, ln(1.0 + (nn - df + 0.5) / (df + 0.5)) AS idf
        FROM qt JOIN dfq USING (cluster_id, token) JOIN st USING (cluster_id)),
sc AS (SELECT cv.cluster_id, cv.doc_id,
              round(sum(idf * tf * 2.2 / (tf + 1.2 * (1 - 0.75 + 0.75 * dl / avgdl))), 9) AS score
       FROM cv JOIN idf USING (cluster_id, token) JOIN dl USING (cluster_id, doc_id) JOIN st USING (cluster_id) GROUP BY ALL),
rr AS (SELECT cand.cluster_id, cand.doc_id, coalesce(sc.score, 0.0) AS score,
              row_number() OVER (PARTITION BY cand.cluster_id ORDER BY coalesce(sc.score, 0.0) DESC, cand.doc_id)::INTEGER AS rank
       FROM cand LEFT JOIN sc USING (cluster_id, doc_id))"""


@register("embed_tf", "WITH " + SQL_TF + "\nSELECT doc_id, token, tf, round(w, 6) AS w FROM w")
def q_embed_tf(spark, sf):
    return doc_vectors(spark, sf).select("doc_id", "token", "tf", F.round("w", 6).alias("w"))


def doc_vectors(spark, sf):
    """TF vectors of every document with both grouping keys (language, cluster), a stage table of the query
    (the weights do not depend on the grouping). The table holds a document's norm, which packs better than its weights."""
    held = cut_lineage(embed_tf(doc_clusters(spark, sf), id_col="doc_id", group_cols=["lang", "cluster_id"], norm_col="_norm"))
    return held.withColumn("w", F.col("tf") / F.col("_norm")).drop("_norm")


@register("near_dup_text", "WITH RECURSIVE " + SQL_TEXT_GREEDY + "\nSELECT doc_id FROM kept")
def q_near_dup_text(spark, sf):
    lost = text_near_duplicates(doc_vectors(spark, sf), T_TEXT, id_col="doc_id", group_cols=["lang"])
    return read(spark, sf, "documents").select("lang", "doc_id").join(lost, ["lang", "doc_id"], "left_anti").select("doc_id")


@register("text_pairs", "WITH " + SQL_TEXT_GREEDY.split(",\nnb AS")[0] + """
SELECT p.a, p.b, round(sum(x.w * y.w), 6) AS cos FROM p JOIN w x ON x.doc_id = p.a JOIN w y ON y.doc_id = p.b AND y.token = x.token
GROUP BY p.a, p.b""")
def q_text_pairs(spark, sf):
    pairs = text_block_pairs(doc_vectors(spark, sf), T_TEXT, id_col="doc_id", group_cols=["lang"])
    return pairs.select("a", "b", F.round("cos", 6).alias("cos"))


def ranked_documents(spark, sf):
    """Per cluster: TF vectors, query = medoid, BM25 rerank of all members."""
    # the vectors are the embed stage's output: written once, read by the medoid and BM25 steps
    vec = doc_vectors(spark, sf).drop("lang")
    ms = tf_medoid_scores(vec, id_col="doc_id", key_cols=["cluster_id"])
    q = ms.groupBy("cluster_id").agg(F.min(F.struct((-F.col("score")).alias("s"), "doc_id")).alias("m")).select(
        "cluster_id", F.col("m.doc_id").alias("qid"))
    return rerank_bm25(vec, q, id_col="doc_id", key_cols=["cluster_id"])


@register("rerank_bm25", "WITH " + SQL_RERANK + "\nSELECT cluster_id, doc_id, round(score, 6) AS score, rank FROM rr")
def q_rerank_bm25(spark, sf):
    r = ranked_documents(spark, sf)
    return r.select("cluster_id", "doc_id", F.round("score", 6).alias("score"), F.col("rank").cast("int").alias("rank"))


@register("doc_bundles", "WITH " + SQL_RERANK + """,
lang AS (SELECT DISTINCT 'cluster-' || lang || '-' || source AS cluster_id, lang AS briefing_id FROM documents),
per AS (SELECT briefing_id, cluster_id, count(*) AS n_items, min(doc_id) AS first FROM rr JOIN lang USING (cluster_id) GROUP BY ALL),
pos AS (SELECT *, row_number() OVER (PARTITION BY briefing_id ORDER BY n_items DESC, first, cluster_id)::INTEGER AS bundle_pos FROM per)
SELECT briefing_id, cluster_id, bundle_pos, n_items, rank, doc_id FROM rr JOIN pos USING (cluster_id)""")
def q_doc_bundles(spark, sf):
    r = ranked_documents(spark, sf).withColumn("briefing_id", F.regexp_extract("cluster_id", r"\Acluster-([^-]+)-", 1))
    b = build_bundles(r, key_col="cluster_id", id_col="doc_id", group_cols=["briefing_id"])
    return b.select("briefing_id", "cluster_id", "bundle_pos", "n_items", F.col("rank").cast("int").alias("rank"), "doc_id")


@register("pack_batches", """
WITH RECURSIVE t AS (SELECT source, doc_id // 500 AS shard, doc_id, greatest(1, CAST(ceil(length(text) / 4.0) AS INTEGER)) AS tokens,
                  row_number() OVER (PARTITION BY source, doc_id // 500 ORDER BY doc_id) AS rn FROM documents),
r(source, shard, rn, doc_id, tokens, batch_no, cur) AS (
  SELECT source, shard, rn, doc_id, tokens, 0, tokens FROM t WHERE rn = 1
  UNION ALL
  SELECT t.source, t.shard, t.rn, t.doc_id, t.tokens,
         CASE WHEN r.cur + t.tokens > 8192 THEN r.batch_no + 1 ELSE r.batch_no END,
         CASE WHEN r.cur + t.tokens > 8192 THEN t.tokens ELSE r.cur + t.tokens END
  FROM r JOIN t ON t.source = r.source AND t.shard = r.shard AND t.rn = r.rn + 1)
SELECT source, shard, doc_id, tokens, batch_no::INTEGER AS batch_no FROM r""")
def q_pack_batches(spark, sf):
    # shards are ranges of the input order, so a hot source packs in as many tasks as it has ranges
    d = read(spark, sf, "documents").select("source", F.floor(F.col("doc_id") / 500).alias("shard"), "doc_id",
                                            approx_tokens(F.col("text")).alias("tokens"))
    return pack_batches(d, 8192, order_col="doc_id").select("source", "shard", "doc_id", "tokens", "batch_no")
