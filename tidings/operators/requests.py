"""Tables on either side of the model calls: request text per cluster, typed responses with quarantine,
and the single-stage whole-briefing response."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidings.functions.urls import normalize_url
from tidings.operators.facts import CLUSTER
from tidings.operators.quality import MIN_BULLET_CHARS
from tidings.operators.ranking import prefix_row_number

# Placeholders filled in the stage templates.
PLACEHOLDERS = ["{{ cluster_json }}", "{{ cluster_id }}"]


def build_requests(items: DataFrame, template: str, *, per_request: int | None = None) -> DataFrame:
    """Requests of each cluster: its items in order as JSON, substituted into ``template``.

    The bundle is taken as given (cuts belong to the ranking before). With ``per_request`` a cluster's items
    go into several numbered requests of that many items, so no request and no task holds a whole hot cluster;
    without, there is one request per cluster. Output: briefing_id, cluster_id, request (1..), prompt."""
    if per_request is None:
        placed = items.withColumn("request", F.lit(1))
    else:
        placed = prefix_row_number(items, CLUSTER, ["doc_id"], "_nth").withColumn(
            "request", F.floor((F.col("_nth") - 1) / per_request).cast("int") + 1)
    bundle = placed.groupBy(*CLUSTER, "request").agg(
        F.transform(F.array_sort(F.collect_list(F.struct("doc_id", F.struct(
            F.col("doc_id").cast("string").alias("item_id"), "url", "source", "text").alias("it")))),
            lambda s: s["it"]).alias("items"))
    js = F.to_json(F.struct("cluster_id", "items"), {"ignoreNullFields": "false"})
    prompt = F.replace(F.replace(F.lit(template), F.lit(PLACEHOLDERS[0]), js), F.lit(PLACEHOLDERS[1]), F.col("cluster_id"))
    return bundle.select(*CLUSTER, "request", prompt.alias("prompt"))


def parse_responses(df: DataFrame, col: str, fields: dict[str, str], defaults: dict | None = None) -> DataFrame:
    """JSON text to typed columns. ``status``: ``unparsable`` (not JSON), ``invalid`` (a required field
    missing or of the wrong type) or ``ok``; bad rows stay in the table for quarantine, others go on.
    Fields named in ``defaults`` are optional: a missing key takes the default (as ``facts: []``)."""
    defaults = defaults or {}
    v = F.try_parse_json(F.col(col))
    out = df.withColumn("_v", v)
    for name, typ in fields.items():
        got = F.try_variant_get("_v", f"$.{name}", typ)
        if name in defaults:
            absent = F.col("_v").isNotNull() & F.try_variant_get("_v", f"$.{name}", "variant").isNull()
            got = F.when(absent, F.lit(defaults[name]).cast(typ)).otherwise(got)
        out = out.withColumn(name, got)
    missing = F.lit(False)
    for name in fields:
        missing = missing | F.col(name).isNull()
    status = F.when(F.col("_v").isNull(), "unparsable").when(missing, "invalid").otherwise("ok")
    return out.withColumn("status", status).drop("_v")


BRIEFING_SCHEMA = T.StructType([
    T.StructField("title", T.StringType()),
    T.StructField("date", T.StringType()),
    T.StructField("topics", T.ArrayType(T.StructType([
        T.StructField("topic_id", T.StringType()), T.StructField("headline", T.StringType()),
        T.StructField("bullets", T.ArrayType(T.StructType([T.StructField("text", T.StringType()),
                                                            T.StructField("url", T.StringType())])))]))),
])


def parse_briefings(df: DataFrame, col: str, *, title: str | None, default_date: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Single-stage path: one whole-briefing JSON per row to (topics, bullets, status) tables.

    ``status``: ``unparsable``, ``empty`` (no topics), ``invalid`` (a topic without id or headline, not 1..4
    bullets, a bullet under 8 characters or without an http(s) url) or ``ok``; only ok responses give rows. A
    configured title overrides the model's; a missing date gets ``default_date``."""
    keys = [c for c in df.columns if c != col]
    p = df.withColumn("_ok", F.try_parse_json(F.col(col)).isNotNull()).withColumn(
        "_b", F.when(F.col("_ok"), F.from_json(F.col(col), BRIEFING_SCHEMA)))
    bullet = lambda x: (F.length(x["text"]) >= MIN_BULLET_CHARS) & normalize_url(x["url"]).isNotNull()
    topic = lambda t: (F.length(t["topic_id"]) > 0) & (F.length(t["headline"]) > 0) & F.size(t["bullets"]).between(1, 4) & F.forall(
        t["bullets"], lambda x: F.coalesce(bullet(x), F.lit(False)))
    topics = F.col("_b.topics")
    p = p.withColumn("status", F.when(~F.coalesce("_ok", F.lit(False)), "unparsable")
                     .when(topics.isNull() | (F.size(topics) == 0), "empty")
                     .when(F.forall(topics, lambda t: F.coalesce(topic(t), F.lit(False))), "ok").otherwise("invalid"))
    t = p.filter("status = 'ok'").select("*", F.posexplode(topics).alias("_pos", "_t"))
    rows = t.select(
        *keys, (F.col("_pos") + 1).alias("topic_pos"), F.col("_t.topic_id").alias("topic_id"),
        F.col("_t.headline").alias("headline"), F.size("_t.bullets").alias("n_bullets"),
        (F.lit(title) if title is not None else F.coalesce(F.col("_b.title"), F.lit("AI Briefing"))).alias("title"),
        F.coalesce(F.col("_b.date"), F.lit(default_date)).alias("date"))
    bullets = t.select(*keys, (F.col("_pos") + 1).alias("topic_pos"), F.posexplode("_t.bullets").alias("_k", "_x")).select(
        *keys, "topic_pos", (F.col("_k") + 1).alias("bullet_pos"), "_x.text", "_x.url")
    return rows, bullets, p.select(*keys, "status")
