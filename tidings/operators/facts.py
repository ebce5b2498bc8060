"""Stage tables between bundles and topics: extractive facts, rule scores, picks, topic drafts.

The model stages of the reference are re-aimed as table jobs: stage 1 takes every sentence of every
item as a fact candidate, stage 2 scores facts with a fixed rule table, stage 3 composes one topic per
cluster from its picked facts. All keyed by (``briefing_id``, ``cluster_id``): labels restart in every run, so
a cluster id alone names nothing. Nothing is collected per cluster.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidings.functions.scores import SCORE_DIMENSIONS, SCORE_MAXIMA, raw_total, weighted_total
from tidings.functions.text import py_strip_valid
from tidings.functions.urls import url_key
from tidings.operators.ranking import number_in_ranges
from tidings.session import cut_lineage

CLUSTER = ["briefing_id", "cluster_id"]
PLACE = ["doc_id", "pos", "_row"]  # order of a cluster's facts
SENTENCE_MARK = "\u0001"
SENTENCE_END = r"([.!?])\s+"

# The stage-2 rule table (dimension, test, points). A test is a regex on the fact text or
# a minimum length in code points; points per dimension are summed and capped at its maximum.
SCORE_RULES = [
    ("actionability", "regex", ",", 1),
    ("actionability", "minlen", 80, 1),
    ("actionability", "regex", "[0-9:;]", 1),
    ("novelty", "regex", r"\A[A-ZÀ-Ý]", 1),
    ("novelty", "regex", "[!?]", 1),
    ("impact", "minlen", 150, 1),
    ("impact", "regex", "(tion|ment|ung|ción)", 1),
    ("reusability", "regex", "(^| )(le|la|les|the|der|die|das|el|los)( |$|[,.])", 1),
    ("reusability", "minlen", 60, 1),
    ("reliability", "regex", "(?i)(eau|sch|th)", 1),
]
# Rules whose regex finds one of these strings, looked for without the regex engine.
RULE_STRINGS = {
    ",": (",",),
    "[0-9:;]": tuple("0123456789:;"),
    "[!?]": ("!", "?"),
    "(tion|ment|ung|ción)": ("tion", "ment", "ung", "ción"),
}
# At most three picked facts per cluster.
TOP_FACTS = 3


def split_sentences(items: DataFrame, *, text_col: str = "text") -> DataFrame:
    """One row per non-empty sentence (``pos`` from 0 over the kept sentences of the item), cut after
    ``. ! ?`` followed by whitespace. Whole texts; long texts only make more rows."""
    marked = F.regexp_replace(F.col(text_col), SENTENCE_END, "$1" + SENTENCE_MARK)
    parts = items.select("*", F.posexplode(F.split(marked, SENTENCE_MARK)).alias("_p", "_s"))
    s = parts.withColumn("sentence", py_strip_valid("_s")).filter(F.col("sentence") != "")
    return s.drop("_s", text_col)


def evidence_keys(items: DataFrame) -> DataFrame:
    """Distinct url keys of each cluster's items: what a fact may cite."""
    return items.select(*CLUSTER, url_key(F.col("url")).alias("_k")).distinct()


def verify_evidence(facts: DataFrame, items: DataFrame, *, url_col: str = "url") -> DataFrame:
    """``facts`` with ``verified``: its url is the url of an item of the same cluster of the same briefing."""
    # a hash of the key comes first in the join, so that many rows are not sorted by equal cluster ids and schemes
    hashed = lambda df: df.withColumn("_kh", F.xxhash64("_k"))
    known = hashed(evidence_keys(items)).withColumn("_ev", F.lit(True))
    return hashed(facts.withColumn("_k", url_key(F.col(url_col)))).join(known, ["_kh", *CLUSTER, "_k"], "left").withColumn(
        "verified", F.col("_ev").isNotNull()).drop("_k", "_kh", "_ev").select(*facts.columns, "verified")


def candidate_facts(items: DataFrame, *, fact_url=None, score=None) -> DataFrame:
    """Stage 1 before any check, a written table: every sentence of every item (``pos``, ``text``, the ``url`` it cites) with what
    names it (``_row``), whether it cites its own item (``_own``) and a 128-bit key of the sentence in its cluster.

    ``score`` is applied to the rows while their texts are at hand, as the steps after this one carry row numbers instead of texts.
    """
    s = split_sentences(items.filter(F.col("briefing_id").isNotNull() & F.col("cluster_id").isNotNull()))
    s = s.withColumn("_cites", fact_url if fact_url is not None else F.col("url"))
    s = s.withColumn("_own", F.coalesce(F.col("_cites") == F.col("url"), F.lit(False))).drop("url")
    s = s.withColumnsRenamed({"_p": "pos", "sentence": "text", "_cites": "url"})
    key = [*CLUSTER, "text"]
    s = s.withColumn("_h1", F.xxhash64(*key)).withColumn("_h2", F.xxhash64(F.lit("second"), *key))
    return cut_lineage((score(s) if score else s).withColumn("_row", F.monotonically_increasing_id()))


def check_facts(candidates: DataFrame, items: DataFrame, carry: Sequence[str] = ()) -> tuple[DataFrame, DataFrame]:
    """``(kept, rejected)`` of :func:`candidate_facts`: the facts without texts (cluster, doc_id, pos, ``_row``, the columns of
    ``carry``), and the rows that are none with their reason.

    The first copies of a task meet the first copies of the others, so a common sentence is no large group anywhere.
    """
    held = [*CLUSTER, *PLACE]
    slim = candidates.select(*held, "_h1", "_h2", "_own", F.when(~F.col("_own"), F.col("url")).alias("url"), *carry)
    # a fact that cites its own item's url is verified as it stands; only the others are looked up among the cluster's urls
    cited = verify_evidence(slim.filter("NOT _own"), items)
    slim = slim.filter("_own").withColumn("verified", F.lit(True)).unionByName(cited).drop("_own", "url")
    earliest = Window.partitionBy("_h1", "_h2").orderBy("doc_id", "pos")
    first = cut_lineage(slim.withColumn("_nth", F.rank().over(earliest)).filter("_nth = 1").drop("_nth", "_h1", "_h2"))
    named = lambda df, why: df.select(*CLUSTER, F.col("doc_id").cast("string").alias("item_id"), "pos", F.lit(why).alias("reason"))
    repeats = candidates.select(*held).join(first.select("_row"), "_row", "left_anti")
    rejected = named(repeats, "duplicate").unionByName(named(first.filter("NOT verified"), "unverifiable"))
    return first.filter("verified").drop("verified"), rejected


def _named_facts(df: DataFrame, idx: F.Column) -> DataFrame:
    df = df.withColumn("fact_idx", idx.cast("long"))
    return df.withColumn("fact_id", F.concat(F.lit("fact-"), F.col("fact_idx").cast("string")))


def number_kept(kept: DataFrame) -> DataFrame:
    """The facts of :func:`check_facts` with ``fact_idx`` and ``fact_id``; rows of one range of (cluster, doc, sentence) are numbered
    where they lie."""
    return _named_facts(number_in_ranges(kept, CLUSTER, PLACE, "_nth"), F.col("_nth") - 1).drop("_nth")


def number_picks(picks: DataFrame, kept: DataFrame) -> DataFrame:
    """A few facts of every cluster with the ``fact_idx`` and ``fact_id`` of :func:`number_kept`: all facts of the cluster are counted
    up to each of them, so none is sorted or moved but the counts. ``picks`` is read twice."""
    mine = picks.select(*CLUSTER, *[F.col(c).alias("_p" + c) for c in PLACE])
    before, same = [F.col(c) < F.col("_p" + c) for c in PLACE], [F.col(c) == F.col("_p" + c) for c in PLACE]
    plain = before[0] | (same[0] & (before[1] | (same[1] & (before[2] | same[2]))))
    whole = F.struct(*PLACE) <= F.struct(*[F.col("_p" + c).alias(c) for c in PLACE])  # a missing doc_id comes first
    upto = kept.select(*CLUSTER, *PLACE).join(mine, CLUSTER).filter(F.coalesce(plain, whole))
    counts = upto.groupBy(F.col("_p_row").alias("_row")).agg(F.count(F.lit(1)).alias("_nth"))
    return _named_facts(picks.join(counts, "_row"), F.col("_nth") - 1).select(*picks.columns, "fact_idx", "fact_id")


def number_facts(candidates: DataFrame, items: DataFrame, carry: Sequence[str] = ()) -> tuple[DataFrame, DataFrame]:
    """:func:`check_facts` with all facts numbered (:func:`number_kept`)."""
    kept, rejected = check_facts(candidates, items, carry)
    return number_kept(kept), rejected


def whole_facts(numbered: DataFrame, candidates: DataFrame) -> DataFrame:
    """Rows of :func:`number_facts` (or some of them, with more columns) with all columns of their candidates."""
    own = [c for c in numbered.columns if c not in candidates.columns]
    return candidates.drop("_h1", "_h2", "_own").join(numbered.select("_row", *own), "_row").drop("_row")


def extract_facts(items: DataFrame, *, fact_url=None) -> tuple[DataFrame, DataFrame]:
    """Stage 1. ``items``: briefing_id, cluster_id, doc_id (input order), url, text (+ any flags).

    Returns ``(facts, rejected)``. A sentence repeated in its cluster is rejected as ``duplicate`` (the
    first copy stays); a fact whose url is not one of the cluster's item urls is rejected as
    ``unverifiable``. Facts get ``fact_idx`` 0.. per cluster in (doc, sentence) order and
    ``fact_id = fact-<idx>``. Repeats are found on a 128-bit sentence key, numbers come from range
    partitions, so neither step holds a whole cluster in one task.
    """
    candidates = candidate_facts(items, fact_url=fact_url)
    numbered, rejected = number_facts(candidates, items)
    return whole_facts(numbered, candidates), rejected


def rule_test(text: F.Column, kind: str, arg) -> F.Column:
    """Whether a text passes a rule's test."""
    if kind != "regex":
        return F.length(text) >= arg
    if arg not in RULE_STRINGS:
        return text.rlike(arg)
    return reduce(lambda a, b: a | b, [F.contains(text, F.lit(x)) for x in RULE_STRINGS[arg]])


def score_facts(facts: DataFrame, *, agentic=None, strategic=None, rules=SCORE_RULES, weights: dict | None = None) -> DataFrame:
    """Stage 2 scores as column expressions (the rule table is fixed, so no join): six int columns,
    ``strategic_flag``, ``raw_total`` and ``weighted_total`` (with the configured ``weights``)."""
    t = F.col("text")
    out = facts
    for dim in SCORE_DIMENSIONS:
        if dim == "agentic_bonus":
            val = F.when(agentic, F.lit(1)).otherwise(F.lit(0)) if agentic is not None else F.lit(0)
        else:
            pts = [F.when(rule_test(t, kind, arg), F.lit(p)).otherwise(F.lit(0)) for d, kind, arg, p in rules if d == dim]
            val = F.least(sum(pts, F.lit(0)), F.lit(SCORE_MAXIMA[dim])) if pts else F.lit(0)
        out = out.withColumn(dim, val.cast("int"))
    out = out.withColumn("strategic_flag", F.coalesce(strategic, F.lit(False)) if strategic is not None else F.lit(False))
    return out.withColumn("raw_total", raw_total()).withColumn("weighted_total", weighted_total(weights=weights))


def low_value_gate(scored: DataFrame) -> DataFrame:
    """Clusters that may pick: some fact has actionability > 0 or impact > 0."""
    return (scored.groupBy(*CLUSTER)
            .agg(F.bool_or((F.col("actionability") > 0) | (F.col("impact") > 0)).alias("_any"))
            .filter("_any").select(*CLUSTER))


def pick_facts(scored: DataFrame, k: int = TOP_FACTS) -> tuple[DataFrame, DataFrame]:
    """Stage 2 selection: the ``k`` best facts per cluster by (weighted total desc, fact index); clusters
    failing :func:`low_value_gate` pick nothing. Returns ``(picked with pick_rank, dropped with reason)``."""
    picked = best_facts(scored, k)
    return picked, drop_facts(scored, picked)


def best_facts(scored: DataFrame, k: int = TOP_FACTS, order: Sequence[str] = ("fact_idx",)) -> DataFrame:
    """The picks of :func:`pick_facts`; ``order`` is the order of a cluster's facts of equal totals.

    Totals are few (small scores by fixed weights), so they are counted first, and only facts of a total that is among the ``k`` best
    of its cluster are ranked. The gate judges whole clusters: every task ranks its own facts, and only ``k`` of a cluster
    and task meet in one place.
    """
    totals = scored.groupBy(*CLUSTER, "weighted_total").agg(
        F.count(F.lit(1)).alias("_n"), F.bool_or((F.col("actionability") > 0) | (F.col("impact") > 0)).alias("_any"))
    above = Window.partitionBy(*CLUSTER).orderBy(F.col("weighted_total").desc()).rowsBetween(Window.unboundedPreceding, -1)
    totals = totals.withColumns({"_before": F.coalesce(F.sum("_n").over(above), F.lit(0)), "_gate": F.bool_or("_any").over(Window.partitionBy(*CLUSTER))})
    top = cut_lineage(totals.filter("_gate").filter(F.col("_before") < k).select(*CLUSTER, F.col("weighted_total").alias("_top")))
    w = Window.partitionBy(*CLUSTER).orderBy(F.col("weighted_total").desc(), *order)
    near = scored.join(top, CLUSTER).filter(F.col("weighted_total").eqNullSafe(F.col("_top"))).drop("_top")
    return near.withColumn("pick_rank", F.row_number().over(w)).filter(F.col("pick_rank") <= k)


def drop_facts(scored: DataFrame, picked: DataFrame) -> DataFrame:
    """The facts that :func:`pick_facts` leaves out, with the reason."""
    gate = low_value_gate(scored)
    return scored.join(picked.select(*CLUSTER, "fact_id"), [*CLUSTER, "fact_id"], "left_anti").join(
        gate.withColumn("_g", F.lit(True)), CLUSTER, "left").select(
        *CLUSTER, "fact_id",
        F.when(F.col("_g").isNull(), F.lit("low value")).otherwise(F.lit("not in top picks")).alias("reason"))


def draft_id() -> F.Column:
    """The default id of a topic draft: the cluster id behind one more ``cluster-``."""
    return F.concat(F.lit("cluster-"), F.col("cluster_id"))


def compose_topics(picked: DataFrame, *, max_bullets: int = 4) -> tuple[DataFrame, DataFrame]:
    """Stage 3: one topic per cluster with picks. Headline = best fact's text; bullets = picked facts in
    pick order (at most ``max_bullets``); annotations agentic / strategic = any among the picks.
    Returns ``(topics, bullets)``; bullets: briefing_id, topic_id, cluster_id, bullet_pos, text, url, fact_id."""
    topics = picked.groupBy(*CLUSTER).agg(
        F.min_by("text", "pick_rank").alias("headline"),
        F.bool_or(F.col("agentic_bonus") > 0).alias("agentic"),
        F.bool_or("strategic_flag").alias("strategic"),
        F.count(F.lit(1)).alias("n_bullets"),
    ).withColumn("topic_id", draft_id())
    bullets = picked.filter(F.col("pick_rank") <= max_bullets).select(
        "briefing_id", draft_id().alias("topic_id"), "cluster_id",
        F.col("pick_rank").alias("bullet_pos"), "text", "url", "fact_id")
    return topics, bullets


def gate_clusters(bundles: DataFrame, picked: DataFrame, bullets: DataFrame) -> DataFrame:
    """What became of every bundle, in bundle order: without a picked fact it is skipped after scoring, without
    a bullet after composition, else it is a topic. ``bundles``: briefing_id, cluster_id, bundle_pos."""
    p = picked.groupBy(*CLUSTER).agg(F.count(F.lit(1)).alias("_p"))
    b = bullets.groupBy(*CLUSTER).agg(F.count(F.lit(1)).alias("_b"))
    status = (F.when(F.col("_p").isNull(), F.lit("skipped: no picked fact"))
              .when(F.col("_b").isNull(), F.lit("skipped: no bullets")).otherwise(F.lit("topic")))
    return bundles.join(p, CLUSTER, "left").join(b, CLUSTER, "left").withColumn("status", status).drop("_p", "_b")


def check_citations(bullet_facts: DataFrame, picked: DataFrame) -> DataFrame:
    """Bullets citing a fact that is not picked in the same cluster, or whose url is missing or differs from the
    cited fact's url (as url keys). ``bullet_facts``: briefing_id, cluster_id, topic_id, bullet_pos, url, fact_id."""
    p = picked.select(*CLUSTER, "fact_id", url_key(F.col("url")).alias("_pk"), F.lit(True).alias("_found"))
    j = bullet_facts.withColumn("_bk", url_key(F.col("url"))).join(p, [*CLUSTER, "fact_id"], "left")
    mismatch = F.coalesce(F.col("_pk") != F.col("_bk"), F.lit(True))
    return j.filter(F.col("_found").isNull() | mismatch).select(
        *CLUSTER, "topic_id", "bullet_pos", "fact_id",
        F.when(F.col("_found").isNull(), F.lit("fact not picked")).otherwise(F.lit("url mismatch")).alias("violation"))
