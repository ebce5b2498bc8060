"""Typed tables from the JSON responses of the fact, selection and draft stages, with quarantine.

A response is taken or refused as a whole, as one record: ``status`` is ``unparsable`` (not JSON),
``invalid`` (a required field missing, of the wrong type or out of range anywhere in it, or a key that the
record's description in :mod:`tidings.operators.records` lacks, at any level) or ``ok``. Missing lists and flags take
their defaults first. Every function returns (rows of the ok responses, status table).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidings.functions.scores import SCORE_DIMENSIONS
from tidings.functions.urls import normalize_url
from tidings.operators.facts import CLUSTER
from tidings.operators.records import DRAFT, FACTS, SCORES, SELECTION, columns, ddl, known_keys, within

MOST_BULLETS = 4


def _opened(df: DataFrame, col: str, record: dict) -> DataFrame:
    text = F.when(F.col("_json"), F.col(col))
    return df.withColumn("_json", F.try_parse_json(F.col(col)).isNotNull()).withColumns(
        {"_r": F.from_json(text, columns(record)), "_known": known_keys(text, record)})


def _judged(opened: DataFrame, ok: Column) -> DataFrame:
    return opened.withColumn("status", F.when(~F.coalesce("_json", F.lit(False)), "unparsable")
                             .when(F.coalesce(ok & F.col("_known"), F.lit(False)), "ok").otherwise("invalid"))


def _status(judged: DataFrame) -> DataFrame:
    return judged.select(*CLUSTER, "status")


def _list(record: dict, name: str) -> Column:
    """A list field; missing is empty."""
    return F.coalesce(F.col(f"_r.{name}"), F.array().cast(ddl(record[name])))


def _http(url: Column) -> Column:
    return normalize_url(url).isNotNull()


def parse_facts(df: DataFrame, col: str = "response") -> tuple[DataFrame, DataFrame]:
    """Facts (briefing_id, cluster_id, pos, fact_id, text, url) of the fact responses."""
    o = _opened(df, col, FACTS).withColumn("_facts", _list(FACTS, "facts"))
    j = _judged(o, F.forall("_facts", lambda f: f["fact_id"].isNotNull() & f["text"].isNotNull() & _http(f["url"])))
    rows = j.filter("status = 'ok'").select(*CLUSTER, F.posexplode("_facts").alias("pos", "f"))
    return rows.select(*CLUSTER, "pos", "f.fact_id", "f.text", "f.url"), _status(j)


def parse_selections(df: DataFrame, col: str = "response") -> tuple[DataFrame, DataFrame, DataFrame]:
    """Picked facts with their six scores (agentic_bonus 0 and strategic_flag false when missing), dropped facts."""
    o = _opened(df, col, SELECTION).withColumn("_dropped", _list(SELECTION, "dropped")).withColumn("_picked", F.transform(
        _list(SELECTION, "picked"), lambda f: f.withField("scores", f["scores"].withField(
            "agentic_bonus", F.coalesce(f["scores"]["agentic_bonus"], F.lit(0)))).withField(
            "strategic_flag", F.coalesce(f["strategic_flag"], F.lit(False)))))

    def fine(f: Column) -> Column:
        ok = f["fact_id"].isNotNull() & f["text"].isNotNull() & f["rationale"].isNotNull() & _http(f["url"])
        for d in SCORE_DIMENSIONS:
            ok = ok & within(f["scores"][d], SCORES[d])
        return ok

    j = _judged(o, F.forall("_picked", fine) & F.forall("_dropped", lambda d: d["fact_id"].isNotNull() & d["reason"].isNotNull()))
    ok = j.filter("status = 'ok'")
    picked = ok.select(*CLUSTER, F.posexplode("_picked").alias("pos", "f")).select(
        *CLUSTER, (F.col("pos") + 1).alias("pick_rank"), "f.fact_id", "f.text", "f.url",
        *[F.col(f"f.scores.{d}").alias(d) for d in SCORE_DIMENSIONS], "f.strategic_flag", "f.rationale")
    dropped = ok.select(*CLUSTER, F.explode("_dropped").alias("d")).select(*CLUSTER, "d.fact_id", "d.reason")
    return picked, dropped, _status(j)


def parse_drafts(df: DataFrame, col: str = "response", *, max_bullets: int = MOST_BULLETS) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Topic drafts and their bullets: the id defaults to ``cluster-<cluster id>``, flags to false; more than four
    bullets are invalid, and what is valid is cut to ``max_bullets``."""
    o = _opened(df, col, DRAFT).withColumn("_bullets", _list(DRAFT, "bullets"))
    fine = F.forall("_bullets", lambda b: b["text"].isNotNull() & _http(b["url"]))
    j = _judged(o, F.col("_r.headline").isNotNull() & (F.size("_bullets") <= MOST_BULLETS) & fine)
    flag = lambda name: F.coalesce(F.try_element_at(F.col("_r.annotations"), F.lit(name)), F.lit(False)).alias(name)
    ok = j.filter("status = 'ok'").withColumn("topic_id", F.coalesce(F.col("_r.topic_id"), F.concat(F.lit("cluster-"), "cluster_id")))
    topics = ok.select(*CLUSTER, "topic_id", F.col("_r.headline").alias("headline"), flag("agentic"), flag("strategic"),
                       F.least(F.size("_bullets"), F.lit(max_bullets)).alias("n_bullets"))
    bullets = ok.select(*CLUSTER, "topic_id", F.posexplode(F.slice("_bullets", 1, max_bullets)).alias("pos", "b")).select(
        *CLUSTER, "topic_id", (F.col("pos") + 1).alias("bullet_pos"), "b.text", "b.url",
        F.coalesce("b.fact_ids", F.array().cast("array<string>")).alias("fact_ids"))
    return topics, bullets, _status(j)
