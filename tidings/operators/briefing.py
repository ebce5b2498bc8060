"""Stage 4 at briefing grain: topic scores, source rules, ordering, focus section, final list, metrics.

Every operator is keyed by ``briefing_id``; ordering rules become window / aggregate expressions with an
explicit last tie-break (``bundle_pos``), so results do not depend on partitioning.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidings.functions.scores import weighted_total
from tidings.functions.text import flag_headline, sanitize_topic_id
from tidings.operators.facts import CLUSTER

# Id and headline of the focus section topic.
FOCUS_TOPIC_ID = "agentic-focus"
FOCUS_HEADLINE = "Agentic Focus"


def lookup_with_fallback(left: DataFrame, dim: DataFrame, *, left_key: str, dim_key: str,
                         by: tuple[str, ...] = ("briefing_id",)) -> DataFrame:
    """Left join on the key inside ``by``; when the exact key is missing, retry with one leading ``cluster-``
    removed. The exact match wins. Dim columns are prefixed ``d_``; unmatched rows keep nulls."""
    d = dim.select([F.col(c).alias("d_" + c) for c in dim.columns])
    stripped = F.when(F.col(left_key).startswith("cluster-"), F.substring(F.col(left_key), 9, 1 << 30))

    def matches(rows: DataFrame, key) -> DataFrame:
        on = key == d["d_" + dim_key]
        for c in by:
            on = on & (rows[c] == d["d_" + c])
        return rows.join(d, on, "left")

    exact = matches(left, F.col(left_key))
    miss = exact.filter(F.col("d_" + dim_key).isNull()).select(*left.columns)
    hit = exact.filter(F.col("d_" + dim_key).isNotNull())
    return hit.unionByName(matches(miss, stripped))


def score_selection(picked: DataFrame, weights: dict | None = None) -> DataFrame:
    """(max weighted total, max actionability, picked count) per cluster, under the configured ``weights``."""
    return picked.groupBy(*CLUSTER).agg(
        F.max(weighted_total(weights=weights)).alias("score"), F.max("actionability").alias("actionability"),
        F.count(F.lit(1)).alias("picked_count"))


def selection_flags(picked: DataFrame) -> DataFrame:
    """Model-level flags per cluster: max raw total, any agentic bonus, any strategic flag."""
    return picked.groupBy(*CLUSTER).agg(
        F.max("raw_total").alias("max_raw_score"), F.bool_or(F.col("agentic_bonus") > 0).alias("has_agentic"),
        F.bool_or("strategic_flag").alias("has_strategic"))


def item_source(items: DataFrame, legacy_source: bool = False) -> Column:
    """Source of an item: its own field, else ``metadata['source']`` where items carry metadata. With
    ``legacy_source`` the metadata is not looked at (items written before the field existed keep null)."""
    own = F.col("source")
    if legacy_source or "metadata" not in items.columns:
        return own
    return F.coalesce(own, F.col("metadata")["source"])


def cluster_sources(items: DataFrame, *, order_col: str = "doc_id", legacy_source: bool = False) -> DataFrame:
    """Distinct item sources of each cluster in first-seen order, null as ``unknown``, joined by ``,``."""
    src = F.coalesce(F.nullif(item_source(items, legacy_source), F.lit("")), F.lit("unknown"))
    first = items.groupBy(*CLUSTER, src.alias("src")).agg(F.min(order_col).alias("_f"))
    return first.groupBy(*CLUSTER).agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("_f", "src"))), lambda s: s["src"]), ",")
        .alias("sources"))


def primary_source(items: DataFrame, *, order_col: str = "doc_id", legacy_source: bool = False) -> DataFrame:
    """First non-empty item source per cluster (null when none)."""
    named = items.withColumn("_src", item_source(items, legacy_source))
    ok = named.filter(F.col("_src").isNotNull() & (F.col("_src") != ""))
    return ok.groupBy(*CLUSTER).agg(F.min_by("_src", order_col).alias("primary_source"))


def order_topics(topics: DataFrame) -> DataFrame:
    """``ord`` per briefing: score desc, actionability desc, picked count desc; ties keep bundle order."""
    w = Window.partitionBy("briefing_id").orderBy(
        F.col("score").desc(), F.col("actionability").desc(), F.col("picked_count").desc(), F.col("bundle_pos"))
    return topics.withColumn("ord", F.row_number().over(w))


def split_focus(ordered: DataFrame, enabled: bool = True) -> DataFrame:
    """``in_focus``: agentic topics leave the main list when the section is on. If that empties the main
    list, a lone agentic topic goes back, otherwise the best one moves over."""
    if not enabled:
        return ordered.withColumn("in_focus", F.lit(False))
    w = Window.partitionBy("briefing_id")
    n_gen = F.count_if(~F.col("agentic")).over(w)
    n_ag = F.count_if(F.col("agentic")).over(w)
    first_ag = F.min(F.when(F.col("agentic"), F.col("ord"))).over(w)
    back = (n_gen == 0) & ((n_ag == 1) | (F.col("ord") == first_ag))
    return ordered.withColumn("in_focus", F.col("agentic") & ~back)


def diversify_top3(general: DataFrame) -> DataFrame:
    """Source diversity in the first three places, then plain order; adds ``place`` (1..n).

    Place 1 is the best topic; place 2 the first later topic whose source is null or differs from place
    1's (else the next one); place 3 likewise against places 1 and 2. Window aggregates over the briefing
    (one shuffle on ``briefing_id``), then one ``row_number``.
    """
    part = Window.partitionBy("briefing_id")
    g = general.withColumn("rn", F.row_number().over(part.orderBy("ord")))
    src = F.col("primary_source")
    g = g.withColumn("s1", F.max(F.when(F.col("rn") == 1, src)).over(part))
    ok2 = src.isNull() | F.col("s1").isNull() | (src != F.col("s1"))
    g = g.withColumn("r2", F.coalesce(F.min(F.when((F.col("rn") > 1) & ok2, F.col("rn"))).over(part),
                                      F.min(F.when(F.col("rn") > 1, F.col("rn"))).over(part)))
    g = g.withColumn("s2", F.max(F.when(F.col("rn") == F.col("r2"), src)).over(part))
    rest = (F.col("rn") != 1) & (F.col("rn") != F.col("r2"))
    ok3 = src.isNull() | ((F.col("s1").isNull() | (src != F.col("s1"))) & (F.col("s2").isNull() | (src != F.col("s2"))))
    g = g.withColumn("r3", F.coalesce(F.min(F.when(rest & ok3, F.col("rn"))).over(part),
                                      F.min(F.when(rest, F.col("rn"))).over(part)))
    key = (F.when(F.col("rn") == 1, F.lit(1)).when(F.col("rn") == F.col("r2"), F.lit(2))
           .when(F.col("rn") == F.col("r3"), F.lit(3)).otherwise(F.lit(4)))
    return g.withColumn("place", F.row_number().over(part.orderBy(key, F.col("rn")))).drop("s1", "s2", "r2", "r3")


def focus_section(focus_topics: DataFrame, bullets: DataFrame, max_bullets: int = 4) -> tuple[DataFrame, DataFrame]:
    """One ``agentic-focus`` topic per briefing: the focus topics' bullets in (topic order, bullet order),
    cut to ``max_bullets`` overall. Returns (topic rows, bullet rows)."""
    b = bullets.join(focus_topics.select("briefing_id", "topic_id", "ord"), ["briefing_id", "topic_id"])
    w = Window.partitionBy("briefing_id").orderBy("ord", "bullet_pos")
    fb = b.withColumn("fpos", F.row_number().over(w)).filter(F.col("fpos") <= max_bullets).select(
        "briefing_id", F.lit(FOCUS_TOPIC_ID).alias("topic_id"), F.col("fpos").alias("bullet_pos"), "text", "url")
    ft = fb.groupBy("briefing_id").agg(F.count(F.lit(1)).alias("n_bullets")).select(
        "briefing_id", F.lit(FOCUS_TOPIC_ID).alias("topic_id"), F.lit(FOCUS_HEADLINE).alias("headline"), "n_bullets")
    return ft, fb


def finalize(topics: DataFrame, bullets: DataFrame, *, max_bullets: int = 4,
             focus_enabled: bool = True) -> tuple[DataFrame, DataFrame]:
    """Final topic list per briefing.

    ``topics``: briefing_id, topic_id, cluster_id (selection id, may be null), headline, agentic,
    strategic, score, actionability, picked_count, bundle_pos, primary_source.
    ``bullets``: briefing_id, topic_id, bullet_pos, text, url.
    Focus topic first, then the diversified general topics with sanitised ids, flagged headlines and
    bullets capped at ``max_bullets``. A briefing with any topic outside 1..4 bullets is marked
    ``valid = false`` as a whole (:func:`split_valid` sets it apart). Returns (topics with topic_pos, bullets with topic_pos).
    """
    o = split_focus(order_topics(topics), focus_enabled)
    o = o.withColumn("_n_focus", F.count_if("in_focus").over(Window.partitionBy("briefing_id")))
    gen = diversify_top3(o.filter(~F.col("in_focus")))
    foc = o.filter(F.col("in_focus"))
    ft, fb = focus_section(foc, bullets, max_bullets)
    # a focus topic exists when some topic of the briefing went to the focus section
    gen = gen.withColumn("topic_pos", F.col("place") + F.when(F.col("_n_focus") > 0, F.lit(1)).otherwise(F.lit(0)))
    gb = bullets.filter(F.col("bullet_pos") <= max_bullets).join(
        gen.select("topic_id", "briefing_id", "topic_pos"), ["briefing_id", "topic_id"])
    gen_n = gb.groupBy("briefing_id", "topic_id").agg(F.count(F.lit(1)).alias("n_bullets"))
    gt = gen.join(gen_n, ["briefing_id", "topic_id"], "left").select(
        "briefing_id", "topic_pos",
        sanitize_topic_id(F.coalesce(F.col("cluster_id"), F.col("topic_id"))).alias("topic_id"),
        flag_headline(F.col("headline"), F.col("strategic")).alias("headline"),
        F.coalesce("n_bullets", F.lit(0)).alias("n_bullets"))
    ftopics = ft.select("briefing_id", F.lit(1).alias("topic_pos"), "topic_id", "headline", "n_bullets")
    final = gt.unionByName(ftopics)
    final = mark_valid(final)
    fbul = fb.select("briefing_id", F.lit(1).alias("topic_pos"), "bullet_pos", "text", "url").unionByName(
        gb.select("briefing_id", "topic_pos", "bullet_pos", "text", "url"))
    return final, fbul


def mark_valid(topics: DataFrame) -> DataFrame:
    """Adds ``valid``: every topic of the briefing has 1..4 bullets (a missing count is none)."""
    ok = F.coalesce(F.col("n_bullets").between(1, 4), F.lit(False))
    return topics.withColumn("valid", F.bool_and(ok).over(Window.partitionBy("briefing_id")))


def split_valid(topics: DataFrame, bullets: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(topics, bullets) of the valid briefings, and the topics of the others as quarantine: a briefing that fails
    its checks is not rendered at all."""
    bad = topics.filter(~F.col("valid")).select("briefing_id").distinct()
    return topics.filter("valid"), bullets.join(bad, "briefing_id", "left_anti"), topics.filter(~F.col("valid"))


def run_metrics(bundles: DataFrame, facts: DataFrame, picked: DataFrame, dropped: DataFrame,
                drafts: DataFrame, final_topics: DataFrame, weights: dict | None = None) -> DataFrame:
    """The eleven run metrics per briefing (0.0 for empty means), under the configured ``weights``."""
    b = bundles.groupBy("briefing_id").agg(F.count_distinct("cluster_id").alias("clusters_total"))
    tf = final_topics.groupBy("briefing_id").agg(F.count(F.lit(1)).alias("topics_final"))
    f = facts.groupBy("briefing_id").agg(F.count(F.lit(1)).alias("facts_total"))
    p = picked.groupBy("briefing_id").agg(F.count(F.lit(1)).alias("facts_picked"),
                                          F.avg("actionability").alias("avg_actionability"),
                                          F.avg(weighted_total(weights=weights)).alias("avg_weighted_score"))
    d = dropped.groupBy("briefing_id").agg(F.count(F.lit(1)).alias("facts_dropped"))
    t = drafts.groupBy("briefing_id").agg(F.count_if("agentic").alias("agentic_topics"),
                                          F.count_if("strategic").alias("strategic_topics"))
    m = b
    for x in (tf, f, p, d, t):
        m = m.join(x, "briefing_id", "left")
    z = F.lit(0).cast("long")
    return m.select(
        "briefing_id", "clusters_total", F.coalesce("topics_final", z).alias("topics_final"),
        F.coalesce("facts_total", z).alias("facts_total"), F.coalesce("facts_picked", z).alias("facts_picked"),
        F.coalesce("facts_dropped", z).alias("facts_dropped"),
        F.when(F.coalesce("facts_total", z) > 0, F.col("facts_picked") / F.col("facts_total")).otherwise(F.lit(0.0)).alias("kept_ratio"),
        F.coalesce("avg_actionability", F.lit(0.0)).alias("avg_actionability"),
        F.coalesce("avg_weighted_score", F.lit(0.0)).alias("avg_weighted_score"),
        F.coalesce("agentic_topics", z).alias("agentic_topics"), F.coalesce("strategic_topics", z).alias("strategic_topics"),
        F.lit(0.0).alias("json_repair_rate"))


def iso_utc(ts) -> "F.Column":
    """UTC ISO-8601 with ``Z``, microseconds only when present (as Python's ``isoformat`` writes it), whatever
    the session's time zone."""
    c = F.col(ts) if isinstance(ts, str) else ts
    c = F.to_utc_timestamp(c, F.current_timezone())
    plain = F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss'Z'")
    micro = F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'")
    return F.when(F.date_format(c, "SSSSSS") == "000000", plain).otherwise(micro)


def briefing_header(final_topics: DataFrame, title: str | None, date) -> DataFrame:
    """One row per briefing: ``briefing_id, title, date``. ``title`` None keeps a per-briefing default
    (``Digest <id>``); ``date`` is a timestamp literal or column (the run's ``as_of``, never the clock)."""
    t = F.lit(title) if title is not None else F.concat(F.lit("Digest "), F.col("briefing_id"))
    d = F.lit(date).cast("timestamp") if not hasattr(date, "alias") else date
    return final_topics.select("briefing_id").distinct().select("briefing_id", t.alias("title"), iso_utc(d).alias("date"))
