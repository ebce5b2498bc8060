"""Record checks (quarantine with the failing rule) and the digest quality report."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidings.functions.text import py_strip
from tidings.functions.urls import normalize_url
from tidings.operators.records import SCORES, within
from tidings.operators.textvec import embed_tf, text_cosine_pairs

# Shortest bullet text; our near-identical bullet threshold.
MIN_BULLET_CHARS = 8
NEAR_IDENTICAL = 0.9


def _violations(df: DataFrame, entity: str, key, rules: list) -> DataFrame:
    """``rules``: (name, condition that must hold). A condition that is null does not hold."""
    fails = F.array(*[F.when(~F.coalesce(ok, F.lit(False)), F.lit(name)) for name, ok in rules])
    return df.select(F.lit(entity).alias("entity"), key.alias("key"),
                     F.explode(F.filter(fails, lambda x: x.isNotNull())).alias("rule"))


def _filled(name: str):
    return py_strip(F.col(name)) != ""


def _key(*names: str):
    return F.concat_ws("/", *[F.coalesce(F.col(n).cast("string"), F.lit("null")) for n in names])


def check_records(picked: DataFrame, topics: DataFrame, bullets: DataFrame, headers: DataFrame | None = None) -> DataFrame:
    """One row per failed rule: the six score ranges and required fields of picked facts, id, headline and 1..4
    bullets per topic, bullet text of at least 8 characters and an http(s) url, and (with ``headers``) title
    and date of a briefing. A missing value fails its rule. Output: entity, key, rule."""
    f = _violations(picked, "fact", _key("briefing_id", "cluster_id", "fact_id"), [
        *[(f"{d} out of range", within(F.col(d), kind)) for d, kind in SCORES.items()],
        ("fact id missing", _filled("fact_id")),
        ("fact text missing", _filled("text")),
        ("url not http(s)", normalize_url(F.col("url")).isNotNull()),
    ])
    t = _violations(topics, "topic", _key("briefing_id", "topic_pos"), [
        ("bullets outside 1..4", F.col("n_bullets").between(1, 4)),
        ("empty headline", _filled("headline")),
        ("topic id missing", _filled("topic_id")),
    ])
    b = _violations(bullets, "bullet", _key("briefing_id", "topic_pos", "bullet_pos"), [
        ("bullet text shorter than 8", F.length("text") >= MIN_BULLET_CHARS),
        ("url not http(s)", normalize_url(F.col("url")).isNotNull()),
    ])
    out = f.unionByName(t).unionByName(b)
    if headers is not None:
        out = out.unionByName(_violations(headers, "briefing", _key("briefing_id"), [
            ("title missing", _filled("title")), ("date missing", _filled("date"))]))
    return out


def duplicate_clusters(bundles: DataFrame, *, order_col: str = "bundle_pos") -> tuple[DataFrame, DataFrame]:
    """A cluster id given twice in one briefing is reported as a violation and only its first bundle is
    kept. Returns (bundles without repeats, violations: entity, key, rule)."""
    w = Window.partitionBy("briefing_id", "cluster_id").orderBy(order_col)
    ranked = bundles.withColumn("_r", F.row_number().over(w))
    viol = ranked.filter(F.col("_r") > 1).select(
        F.lit("bundle").alias("entity"), F.concat_ws("/", "briefing_id", "cluster_id").alias("key"),
        F.lit("duplicate cluster id").alias("rule"))
    return ranked.filter(F.col("_r") == 1).drop("_r"), viol


def quality_report(topics: DataFrame, bullets: DataFrame, items: DataFrame) -> DataFrame:
    """Per briefing: duplicate headlines, near-identical bullet pairs (TF cosine >= 0.9, exact join) and
    the share of bullets whose url is one of the briefing's item urls."""
    dup = (topics.groupBy("briefing_id", "headline").agg(F.count(F.lit(1)).alias("_c")).filter("_c > 1")
           .groupBy("briefing_id").agg(F.count(F.lit(1)).alias("duplicate_headlines")))
    b = bullets.withColumn("_bid", F.col("topic_pos") * 100 + F.col("bullet_pos"))
    vec = embed_tf(b, id_col="_bid", group_cols=["briefing_id"])
    near = (text_cosine_pairs(vec, NEAR_IDENTICAL, id_col="_bid", group_cols=["briefing_id"])
            .groupBy("briefing_id").agg(F.count(F.lit(1)).alias("near_identical_bullets")))
    known = items.select("briefing_id", "url").distinct().withColumn("_ok", F.lit(1.0))
    share = (b.join(known, ["briefing_id", "url"], "left").groupBy("briefing_id")
             .agg(F.avg(F.coalesce("_ok", F.lit(0.0))).alias("valid_url_share")))
    z = F.lit(0).cast("long")
    return (share.join(dup, "briefing_id", "left").join(near, "briefing_id", "left")
            .select("briefing_id", F.coalesce("duplicate_headlines", z).alias("duplicate_headlines"),
                    F.coalesce("near_identical_bullets", z).alias("near_identical_bullets"), "valid_url_share"))
