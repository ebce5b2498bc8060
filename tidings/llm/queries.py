"""Registered queries of the training-data operators: ``(spark, sf_dir) -> DataFrame`` and DuckDB oracles."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidings.llm import chunkdedup, covers, decontam, folds, jaccard, linechunks, merkle, mixing, pfp, quality, sharding, spelling, sql, toxicity, urlfilter

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn
    return deco


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _scored(df: DataFrame, score: str, n: int, held: int) -> DataFrame:
    return df.select("doc_id", F.coalesce(folds.fold(F.col("doc_id"), n) == held, F.lit(False)).alias("held_out"),
                     F.col(score).alias("score"), F.when(F.col(score) >= 0.7, 1).otherwise(0).alias("predicted"))


@register("op1_counterfactual_toxicity")
def op1_counterfactual_toxicity(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"), folds_=3, held=1)
    return _scored(toxicity.score_texts(docs, model), "toxicity", 3, 1)


@register("op5_positive_unlabelled")
def op5_positive_unlabelled(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    fitted = quality.fit(docs, table(spark, sf_dir, "labels"), folds_=4, held=2)
    return _scored(quality.score_texts(docs, fitted), "quality", 4, 2)


def _url_sql() -> str:
    lower = "translate(url, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    hit = lambda t: f"regexp_matches(u, '(?s)(^|[^a-z0-9]){t}([^a-z0-9]|$)')"
    total = lambda terms, worth: " + ".join(f"CASE WHEN {hit(t)} THEN {worth(t)} ELSE 0 END" for t in terms)
    rule = " ".join(
        f"WHEN (host = '{h}' OR ends_with(host, '.{h}')) AND starts_with(path, '{p}') THEN '{v} {h}{p}'"
        for v, h, p in sorted(urlfilter.RULES, key=lambda r: -len(r[1] + r[2])))
    return f"""
WITH p AS (SELECT page_id, coalesce({lower}, '') AS u, coalesce(regexp_extract({lower}, '(?s)^.*?://([^/?#]*)', 1), '') AS host,
                  coalesce(regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1), '') AS path FROM pages),
r AS (SELECT *, CASE {rule} END AS r, ({total(urlfilter.STRICT, lambda t: 1)})::INTEGER AS n_strict,
        ({total(urlfilter.SOFT, lambda t: 1)})::INTEGER AS n_soft, ({total(urlfilter.SOFT, urlfilter.SOFT.get)})::DOUBLE AS weight FROM p)
SELECT page_id, host, path, split_part(r, ' ', 2) AS rule, CASE WHEN r IS NOT NULL THEN split_part(r, ' ', 1)
  WHEN n_strict > 0 OR (n_soft >= {urlfilter.SOFT_DISTINCT} AND weight >= {urlfilter.SOFT_THRESHOLD}) THEN 'block' ELSE 'allow' END AS verdict,
  n_strict, n_soft, weight FROM r"""


@register("op2_url_vocabulary", _url_sql())
def op2_url_vocabulary(spark, sf_dir):
    return urlfilter.filter_urls(table(spark, sf_dir, "pages"))


def _shingle_sql(name: str, source: str, key: str) -> str:
    """CTEs: word lists and distinct 5-word shingles (a shorter text is one shingle) of a table's texts."""
    return f"""{name}w AS (SELECT {key}, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
        'abcdefghijklmnopqrstuvwxyz'), '[^\\x20\\x09-\\x0D]+') AS ws FROM {source}),
{name} AS (SELECT DISTINCT {key}, unnest(CASE WHEN len(ws) = 0 THEN [] WHEN len(ws) < 5 THEN [array_to_string(ws, ' ')]
        ELSE list_transform(range(1, len(ws) - 3), lambda i: array_to_string(ws[i:i+4], ' ')) END) AS sh FROM {name}w)"""


@register("op3_segment_join", f"""
WITH RECURSIVE {_shingle_sql('s', 'documents', 'doc_id')},
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM s a JOIN s b ON a.sh = b.sh AND a.doc_id < b.doc_id GROUP BY 1, 2),
e AS (SELECT a, b FROM p JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * c >= 80 * (x.n + y.n - c)),
links AS (SELECT a, b FROM e UNION SELECT b, a FROM e),
reach(id, c) AS (SELECT doc_id, doc_id FROM documents UNION SELECT r.id, links.b FROM reach r JOIN links ON links.a = r.c)
SELECT doc_id, coalesce(any_value(n.n), 0) AS n_shingles, min(c) AS component_id
FROM documents JOIN reach ON reach.id = doc_id LEFT JOIN n USING (doc_id) GROUP BY doc_id
""")
def op3_segment_join(spark, sf_dir):
    return jaccard.jaccard_components(table(spark, sf_dir, "documents"))


@register("op10_containment_search", f"""
WITH {_shingle_sql('s', 'documents', 'doc_id')}, {_shingle_sql('i', 'benchmark', 'item_id')},
n AS (SELECT item_id, count(*) AS n FROM i GROUP BY item_id),
h AS (SELECT doc_id, item_id, count(*) AS c FROM s JOIN i USING (sh) GROUP BY 1, 2)
SELECT doc_id, item_id, n AS n_item_shingles, c AS n_shared, c / n AS containment FROM h JOIN n USING (item_id) WHERE c / n >= 0.8
""")
def op10_containment_search(spark, sf_dir):
    return decontam.find_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@register("op4_chunk_recipes", """
WITH t AS (SELECT doc_id, coalesce(text, '') AS txt,
                  regexp_replace(coalesce(text, ''), '[\\x20\\x09-\\x0D]', '', 'g') AS norm FROM documents),
r AS (SELECT doc_id, sha256(norm) AS text_sha256,
             first_value(doc_id) OVER (PARTITION BY norm ORDER BY length(txt) DESC, doc_id) AS keep_id,
             count(*) OVER (PARTITION BY norm) AS group_size FROM t)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, text_sha256 FROM r
""")
def op4_chunk_recipes(spark, sf_dir):
    return chunkdedup.exact_dedup(table(spark, sf_dir, "documents"))


@register("op6_prefix_free_parsing")
def op6_prefix_free_parsing(spark, sf_dir):
    left = pfp.remove_repeats(table(spark, sf_dir, "documents"), digest=True)
    return left.withColumnRenamed("kept", "kept_sha256")


@register("op7_entropy_balancing")
def op7_entropy_balancing(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", mixing.word_count(F.col("text")).alias("size"))
    mixed = mixing.mix(docs)
    return mixed.select("doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"))


@register("op8_jump_shards")
def op8_jump_shards(spark, sf_dir):
    s = sharding.assign_shards(table(spark, sf_dir, "documents"), shards=24)
    return s.withColumn("law", F.lit("key"))


@register("op9_line_chunks")
def op9_line_chunks(spark, sf_dir):
    d = linechunks.dedup_line_chunks(table(spark, sf_dir, "documents"), lowest=True)
    return d.select("doc_id", "n_lines", "n_removed_lines", "n_removed_chunks", F.sha2("text", 256).alias("kept_sha256"))


@register("op11_pivotal_grams", sql.spelling())
def op11_pivotal_grams(spark, sf_dir):
    return spelling.group_variants(spelling.vocabulary(table(spark, sf_dir, "documents")))


@register("op12_difference_cover", sql.windows())
def op12_difference_cover(spark, sf_dir):
    left = covers.remove_repeated_windows(table(spark, sf_dir, "documents"), digest=True)
    return left.withColumnRenamed("kept", "kept_sha256")


@register("op13_interval_manifest", sql.manifest())
def op13_interval_manifest(spark, sf_dir):
    fields = lambda text: [*map(F.col, ("doc_id", "source", "lang", "n_chars")), text]
    low = F.translate("text", sql.UPPER, sql.LOWER)
    tampered = F.when(folds.fold(F.col("doc_id"), 3) == 0, merkle.digest_of(fields(low)))
    rows = merkle.manifest(table(spark, sf_dir, "documents"), "doc_id", fields(F.col("text")), "lang", {"tampered": tampered})
    found = rows.withColumn("folded_root", merkle.folded(F.coalesce("tampered", "leaf"), F.col("path")))
    return found.select("doc_id", "leaf", "subroot", "root", merkle.proof_digest(F.col("path")).alias("proof_sha256"), "folded_root",
                        (F.col("folded_root") == F.col("root")).alias("verified"))
