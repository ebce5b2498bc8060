import datetime as dt
import os
import tempfile

import pytest
from pyspark.sql import functions as F

from tidings.functions import coerce_ts, max_bullets, repair_utf8
from tidings.operators.hooks import embed, rerank_with
from tidings.operators.render import render_html
from tidings.sinks.files import read_run_table, write_briefings, write_metrics, write_run_table, write_stage
from tidings.sources.items import ingest_forum_posts, ingest_stories


def test_encoder_hook(spark):
    def _encoder():
        # defined inside the test so the closure ships by value to the Python workers
        return lambda texts: [[float(len(t)), float(t.count("a"))] for t in texts]

    df = spark.createDataFrame([(1, "banana\x01"), (2, "  apple  "), (3, "x" * 50)], "id long, text string")
    got = {r.id: r.embedding for r in embed(df, _encoder, max_batch_tokens=5, max_item_chars=240, chars_per_token=2.0).collect()}
    assert got[1] == [6.0, 3.0] and got[2] == [5.0, 1.0] and got[3] == [10.0, 0.0]


def test_scorer_hook(spark):
    df = spark.createDataFrame([("c", 1, "q w e", "q w"), ("c", 2, "q w e", "z"), ("c", 3, "q w e", "q w e")],
                               "cluster_id string, id long, query_text string, text string")

    def make():
        return lambda qs, ts: [len(set(q.split()) & set(t.split())) for q, t in zip(qs, ts)]

    assert [r.id for r in rerank_with(df, make).orderBy("rank").collect()] == [3, 1, 2]


def test_stories_limit_before_type_filter(spark):
    rows = [(0, 11, "story", "Title A", None, None, "ann", 1704067200, 5),
            (1, 12, "job", "Job", None, "https://jobs.example.com", None, 1704067200, 1),
            (2, 13, "story", "Title C", "<p>body</p>", "example.com/c", "cy", 1704067200, 3)]
    raw = spark.createDataFrame(rows, "list_pos int, id long, type string, title string, text string, url string, "
                                      "by string, time long, score int")
    got = ingest_stories(raw, limit=2).collect()
    assert [(r.id, r.url, r.author, r.text) for r in got] == [("11", "https://news.ycombinator.com/item?id=11", "ann", "Title A")]


def test_forum_posts(spark):
    raw = spark.createDataFrame([("p1", "Hello", "", "/r/x/comments/p1/", None, 1704067200, "x")],
                                "id string, title string, selftext string, permalink string, author string, "
                                "created_utc long, subreddit string")
    (r,) = ingest_forum_posts(raw).collect()
    assert (r.url, r.author, r.text, r.metadata["subreddit"]) == ("https://www.reddit.com/r/x/comments/p1/", "Unknown", "Hello", "x")


def test_scalar_helpers(spark):
    df = spark.createDataFrame([("1704067200", 1704067200, dt.datetime(2024, 1, 1))], "s string, n long, t timestamp")
    r = df.select(coerce_ts(df, "n").alias("n"), coerce_ts(df, "t").alias("t"), repair_utf8(F.col("n")).alias("u")).first()
    assert r.n == r.t and r.u == "1704067200"
    assert [max_bullets(c) for c in ({}, {"processing": {"max_bullets_per_topic": 9}},
                                     {"processing": {"max_bullets_per_topic": "x"}},
                                     {"processing": {"max_bullets_per_topic": 0}})] == [4, 4, 4, 1]
    (h,) = df.select(render_html(F.lit("# T <b>"), F.lit("Title"))).first()
    assert "<pre>\n# T <b>\n</pre>" in h and "<title>Title</title>" in h


def test_writers(spark):
    d = tempfile.mkdtemp(prefix="tidings-sinks-", dir="/tmp")
    b = spark.createDataFrame([("en", dt.datetime(2024, 1, 2, 3, 4, 5), "# md\n", "{}", "T")],
                              "briefing_id string, run_ts timestamp, markdown string, json string, title string")
    write_briefings(b, d, ("md", "json", "html"))
    assert os.path.isdir(os.path.join(d, "md", "briefing_id=en", "run_ts=20240102T030405Z"))
    assert os.path.isdir(os.path.join(d, "html", "briefing_id=en"))
    for n in (1, 2):  # the second write of a run replaces the first, also where it has fewer briefings
        rows = [("en", "c1", n)] + [("de", "c1", n)] * (n == 1)
        write_stage(spark.createDataFrame(rows, "briefing_id string, cluster_id string, n int"), os.path.join(d, "st"), "stage1", "r1")
    write_stage(spark.createDataFrame([("en", "c2", 7)], "briefing_id string, cluster_id string, n int"), os.path.join(d, "st"), "stage1", "2024-01-02")
    write_metrics(spark.createDataFrame([("en", 3)], "briefing_id string, topics_final int"), os.path.join(d, "st"), "r1")
    schema = "cluster_id string, n int, briefing_id string"
    got = read_run_table(spark, os.path.join(d, "st"), "stage1", schema).select("run_id", "briefing_id", "cluster_id", "n").collect()
    assert sorted(map(tuple, got)) == [("2024-01-02", "en", "c2", 7), ("r1", "en", "c1", 2)]
    assert read_run_table(spark, os.path.join(d, "st"), "stage1", schema, run_id="r1").count() == 1
    (m,) = read_run_table(spark, os.path.join(d, "st"), "metrics", "briefing_id string, topics_final int", fmt="json").collect()
    assert (m.run_id, m.topics_final) == ("r1", 3)


def test_readers_skip_what_is_not_committed(spark):
    d = tempfile.mkdtemp(prefix="tidings-sinks-", dir="/tmp")
    good = spark.createDataFrame([("en", 1)], "briefing_id string, n int")
    write_run_table(good, d, "r1", "t")
    with pytest.raises(Exception, match="lost"):
        write_run_table(good.withColumn("n", F.raise_error(F.lit("lost")).cast("int")), d, "r2", "t")
    assert [r.run_id for r in read_run_table(spark, d, "t", "briefing_id string, n int").collect()] == ["r1"]
    write_run_table(good, d, "r2", "t")
    assert read_run_table(spark, d, "t", "briefing_id string, n int").count() == 2
    with pytest.raises(ValueError, match="folder name"):
        write_run_table(good, d, "../r", "t")


def test_parse_responses_defaults_and_quarantine(spark):
    from tidings.operators.requests import parse_responses

    df = spark.createDataFrame([(1, '{"cluster_id": "c", "n": 2}'), (2, '{"cluster_id": "c"}'), (3, '{"n": 1}'),
                                (4, '{"cluster_id": ')], "i int, j string")
    got = {r.i: (r.status, r.n) for r in parse_responses(df, "j", {"cluster_id": "string", "n": "int"}, {"n": 0}).collect()}
    assert got == {1: ("ok", 2), 2: ("ok", 0), 3: ("invalid", 1), 4: ("unparsable", None)}


def test_duplicate_cluster_ids(spark):
    from tidings.operators.quality import duplicate_clusters

    b = spark.createDataFrame([("en", "c1", 1), ("en", "c2", 2), ("en", "c1", 3)], "briefing_id string, cluster_id string, bundle_pos int")
    kept, viol = duplicate_clusters(b)
    assert sorted((r.cluster_id, r.bundle_pos) for r in kept.collect()) == [("c1", 1), ("c2", 2)]
    assert [(r.key, r.rule) for r in viol.collect()] == [("en/c1", "duplicate cluster id")]


@pytest.mark.parametrize(("patch", "status"), [
    ({}, "ok"), ({"notes": "n"}, "ok"), ({"mood": 1}, "invalid"), ({"picked": None}, "ok"), ({"picked": "no list"}, "ok"),
    ({"dropped": [{"fact_id": "f", "reason": "r"}]}, "ok"), ({"dropped": [{"fact_id": "f", "reason": "r", "x": None}]}, "invalid"),
    ({"fact": {"x": 1}}, "invalid"), ({"scores": {"x": 1}}, "invalid"), ({"scores": {"impact": 3}}, "invalid"), ({"scores": {"agentic_bonus": 1}}, "ok"),
])
def test_unknown_keys_are_refused_at_every_level(spark, patch, status):
    import json

    from tidings.operators.responses import parse_selections

    patch = dict(patch)
    scores = {"actionability": 1, "novelty": 1, "impact": 1, "reusability": 0, "reliability": 1, **patch.pop("scores", {})}
    fact = {"fact_id": "f", "text": "t", "url": "https://a.example.com/", "scores": scores, "rationale": "r", **patch.pop("fact", {})}
    record = {"cluster_id": "c", "picked": [fact], **patch}
    df = spark.createDataFrame([("en", "c", json.dumps(record))], "briefing_id string, cluster_id string, response string")
    assert [r.status for r in parse_selections(df)[2].collect()] == [status]


def test_unknown_keys_of_drafts_and_facts(spark):
    from tidings.operators.responses import parse_drafts, parse_facts

    def status(parse, *texts):
        df = spark.createDataFrame([("en", str(i), t) for i, t in enumerate(texts)], "briefing_id string, cluster_id string, response string")
        return [r.status for r in parse(df)[-1].orderBy("cluster_id").collect()]

    assert status(parse_drafts, '{"headline": "h", "bullets": [{"text": "t", "url": "https://a.example.com/"}], "annotations": {"agentic": true, "any": false}}',
                  '{"headline": "h", "bullets": [{"text": "t", "url": "https://a.example.com/", "rank": 1}]}', '{"headline": "h", "style": {}}',
                  '["headline"]') == ["ok", "invalid", "invalid", "invalid"]
    assert status(parse_facts, '{"facts": [], "rejected": [{"reason": "r"}]}', '{"facts": [], "rejected": [{"reason": "r", "why": 1}]}',
                  '{"fact": []}', "null") == ["ok", "invalid", "invalid", "ok"]
