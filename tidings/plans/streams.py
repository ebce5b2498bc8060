"""Registered streaming queries: each lands its input in two parts under the checkpoint folder, runs the stream after each
part with the same state, and returns what the stream has written."""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import functions as F

from tidings.plans.items import events_items
from tidings.plans.registry import register
from tidings.session import ensure_checkpoint_dir
from tidings.sinks.files import mark_run_table, read_run_table, write_run_table, write_stage
from tidings.streaming.streams import read_ingested, run_to_end, stream_dedup, stream_ingest, window_counts
from tidings.tables import read

START = dt.datetime(2024, 1, 1, tzinfo=dt.timezone.utc)
CUT = "2024-01-16 00:00:00"  # events from here on land in the second part
WITHHELD = 37  # every so many events before the cut land in the second part too, late
HOURS = 24


def _folder(spark) -> str:
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/streams/{uuid.uuid4().hex}"


# ---- X01: landed pages, two triggers, each judged by its own time
HORIZON_H, FIRST_MIN, STEP_MIN = 4, 300, 100


@register("stream_ingest", f"""
WITH p AS (SELECT page_id, page_id % 2 AS batch, CASE WHEN page_id % 13 = 0 THEN 'empty_text' WHEN page_id % 11 = 0 THEN 'invalid_ts'
       WHEN page_id % 17 = 0 THEN 'invalid_url' WHEN page_id < {FIRST_MIN - 60 * HORIZON_H} + {STEP_MIN} * (page_id % 2) THEN 'too_old' ELSE 'kept' END AS status,
       CASE WHEN page_id % 13 = 0 THEN 0 ELSE length('page of ' || length(url)) END AS n_chars FROM pages)
SELECT 'urn:page:' || page_id AS id, batch, status, n_chars::INTEGER AS n_chars FROM p""")
def q_stream_ingest(spark, sf):
    pid = F.col("page_id")
    when = F.date_format(F.to_utc_timestamp(F.timestamp_seconds(F.lit(int(START.timestamp())) + pid * 60), F.current_timezone()), "yyyy-MM-dd'T'HH:mm:ss'Z'")
    pages = read(spark, sf, "pages").select(
        "page_id", F.concat(F.lit("urn:page:"), pid.cast("string")).alias("id"),
        F.when(pid % 17 == 0, "javascript:void(0)").otherwise(F.concat(F.lit("https://pages.example.com/"), pid.cast("string"))).alias("link"),
        F.when(pid % 13 == 0, "").otherwise(F.concat(F.lit("<p>page of "), F.length("url").cast("string"), F.lit("</p>"))).alias("summary"),
        F.when(pid % 11 == 0, "someday").otherwise(when).alias("published"))
    at = _folder(spark)
    clock = lambda batch: START + dt.timedelta(minutes=FIRST_MIN + STEP_MIN * batch)
    for part in (0, 1):
        pages.filter(pid % 2 == part).drop("page_id").write.mode("append").parquet(f"{at}/in")
        stream_ingest(spark, f"{at}/in", f"{at}/out", f"{at}/state", "id string, link string, summary string, published string",
                      hours=HORIZON_H, clock=clock, fmt="parquet").awaitTermination()
    kept = read_ingested(spark, f"{at}/out").withColumn("status", F.lit("kept"))
    both = kept.unionByName(read_ingested(spark, f"{at}/out", "quarantine"))
    return both.select("id", "batch", "status", F.length("text").alias("n_chars"))


# ---- X02, X03: events in two parts with late rows
def _landed(spark, sf, part: int):
    ev = events_items(spark, sf)
    late = (F.col("ts") < CUT) & (F.col("event_id") % WITHHELD == 0)
    first = (F.col("ts") < CUT) & ~late
    if part == 0:
        return ev.filter(first)
    # rows of the first part come once more, the withheld ones late
    return ev.filter(~first | (F.col("event_id") % 50 == 0))


def _streamed(spark, sf, job):
    at = _folder(spark)
    out = None
    for part in (0, 1):
        rows = _landed(spark, sf, part)
        rows.write.mode("append").parquet(f"{at}/in")
        out = run_to_end(job(spark.readStream.schema(rows.schema).parquet(f"{at}/in")), f"{at}/out", f"{at}/state")
    return out


SQL_LANDED = f"""
WITH a AS (SELECT * FROM events WHERE ts < TIMESTAMP '{CUT}' AND event_id % {WITHHELD} <> 0),
b AS (SELECT * FROM events WHERE ts >= TIMESTAMP '{CUT}' OR event_id % {WITHHELD} = 0 OR event_id % 50 = 0)"""


@register("stream_dedup", SQL_LANDED + f""",
mark AS (SELECT (epoch_ms(max(ts)) - {HOURS} * 3600000) * 1000 AS us FROM a)
SELECT event_id FROM a UNION ALL
SELECT event_id FROM b, mark WHERE event_id NOT IN (SELECT event_id FROM a) AND epoch_us(ts) > us""")
def q_stream_dedup(spark, sf):
    return _streamed(spark, sf, lambda s: stream_dedup(s, HOURS, id_col="event_id")).select("event_id")


@register("stream_counts", SQL_LANDED + """,
m AS (SELECT (epoch_ms(max(a.ts)) - 7200000) * 1000 AS first, (SELECT epoch_ms(max(ts)) - 7200000 FROM events) * 1000 AS last FROM a),
w AS (SELECT date_trunc('hour', ts) AS w, event_type FROM a
      UNION ALL SELECT date_trunc('hour', ts), event_type FROM b, m WHERE epoch_us(date_trunc('hour', ts)) + 3600000000 > first)
SELECT epoch_us(w) AS window_start_us, event_type, count(*) AS n FROM w, m WHERE epoch_us(w) + 3600000000 <= last GROUP BY ALL""")
def q_stream_counts(spark, sf):
    got = _streamed(spark, sf, lambda s: window_counts(s, "1 hour", key="event_type", watermark="2 hours"))
    return got.select(F.unix_micros("window_start").alias("window_start_us"), "event_type", "n")


# ---- K03, K04: tables of runs written twice
@register("run_tables", """
SELECT 'r1' AS run_id, lang AS briefing_id, doc_id, n_chars FROM documents WHERE doc_id % 3 <> 0
UNION ALL SELECT 'r2', lang, doc_id, n_chars FROM documents""")
def q_run_tables(spark, sf):
    """Run r1 is written twice (the second try has fewer rows), r2 once, r3 is being written again."""
    at = _folder(spark)
    d = read(spark, sf, "documents").select(F.col("lang").alias("briefing_id"), "doc_id", "n_chars")
    write_stage(d, at, "facts", "r1")
    write_stage(d.filter(F.col("doc_id") % 3 != 0), at, "facts", "r1")
    write_stage(d, at, "facts", "r2")
    write_stage(d, at, "other", "r2")
    write_stage(d, at, "facts", "r3")
    mark_run_table(spark, at, "r3", "facts", "open")  # a second try of r3 has begun
    return read_run_table(spark, at, "facts", "briefing_id string, doc_id long, n_chars long")


@register("run_metrics_table", """
SELECT 'r1' AS run_id, lang AS briefing_id, count(*) AS items, sum(n_chars)::BIGINT AS chars FROM documents GROUP BY lang""")
def q_run_metrics_table(spark, sf):
    at = _folder(spark)
    m = read(spark, sf, "documents").groupBy(F.col("lang").alias("briefing_id")).agg(F.count(F.lit(1)).alias("items"), F.sum("n_chars").alias("chars"))
    for _ in range(2):
        write_run_table(m, at, "r1", "metrics", fmt="json")
    return read_run_table(spark, at, "metrics", "briefing_id string, items long, chars long", fmt="json")
