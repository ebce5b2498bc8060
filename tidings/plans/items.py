"""Registered ingest, window and layout queries over ``events``, ``documents`` and ``pages``.

Cases the tables lack (bad timestamps, RFC-2822 dates, broken links, empty text) are planted inside the
query from a column of the table, identically in the oracle, so their count grows with the data.
"""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidings.functions.timefmt import coerce_ts, parse_ts
from tidings.plans import sqlfrag as S
from tidings.plans.registry import register
from tidings.sources.items import (
    documents_as_items,
    ingest_forum_posts,
    ingest_list_feed,
    ingest_stories,
    resolve_entry_url,
    split_entries,
    split_valid,
    time_window,
    top_n_per_source,
    union_sources,
    window_report,
)
from tidings.tables import read

WINDOW_HOURS = 24


def max_ts(df, col="ts"):
    """``as_of`` for a query: one small aggregate, passed on as a literal so filters reach the scan."""
    return df.agg(F.max(F.col(col).cast("timestamp"))).first()[0]


def events_items(spark, sf):
    ev = read(spark, sf, "events")
    return ev.select(F.col("event_id"), F.col("ts").cast("timestamp").alias("ts"), F.col("event_type"),
                     F.col("user_id"), F.col("value"), F.col("props"))


# ---------------------------------------------------------------- P01 / A01
@register("time_window", """
SELECT event_id, epoch_us(ts) AS ts_us FROM events
WHERE ts >= (SELECT max(ts) FROM events) - INTERVAL 24 HOUR""")
def q_time_window(spark, sf):
    ev = events_items(spark, sf)
    return time_window(ev, WINDOW_HOURS, max_ts(ev)).select("event_id", F.unix_micros("ts").alias("ts_us"))


def _event_raw_ts(ts):
    """Planted timestamp strings: every 10th event is not a date; others alternate ISO-Z and RFC-2822."""
    eid = F.col("event_id")
    return (F.when(eid % 10 == 0, F.lit("not-a-date"))
            .when(eid % 10 == 5, F.date_format(ts, "EEE, dd MMM yyyy HH:mm:ss '+0000'"))
            .otherwise(F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'")))


SQL_EVENT_RAW = """(CASE WHEN event_id % 10 = 0 THEN 'not-a-date'
      WHEN event_id % 10 = 5 THEN strftime(ts, '%a, %d %b %Y %H:%M:%S +0000')
      ELSE strftime(ts, '%Y-%m-%dT%H:%M:%S.%fZ') END)"""


@register("window_report", f"""
WITH r AS (SELECT event_type AS briefing_id, {S.parse_ts('raw')} AS t
           FROM (SELECT event_id, event_type, {SQL_EVENT_RAW} AS raw FROM events)),
m AS (SELECT max(ts)::TIMESTAMPTZ AS as_of FROM events)
SELECT briefing_id, count(*) FILTER (WHERE t IS NOT NULL AND t >= (SELECT as_of FROM m) - INTERVAL 24 HOUR) AS kept,
       count(*) FILTER (WHERE t IS NOT NULL AND t < (SELECT as_of FROM m) - INTERVAL 24 HOUR) AS too_old,
       count(*) FILTER (WHERE t IS NULL) AS invalid_ts
FROM r GROUP BY briefing_id""")
def q_window_report(spark, sf):
    ev = events_items(spark, sf)
    as_of = max_ts(ev)
    items = ev.select(F.col("event_type").alias("briefing_id"), parse_ts(_event_raw_ts(F.col("ts"))).alias("ts"),
                      F.col("props").alias("text"), F.concat(F.lit("https://events.example.com/"), "event_id").alias("url"))
    return window_report(split_valid(items, WINDOW_HOURS, as_of))


# Planted forms of the same instant: (SQL format of it, Spark pattern, hours the written clock is ahead, what the form keeps)
TS_FORMS = [
    ("%Y-%m-%dT%H:%M:%S.%gZ", "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'", 0, "millisecond"),
    ("%Y-%m-%dT%H:%M:%S+02:00", "yyyy-MM-dd'T'HH:mm:ss'+02:00'", 2, "second"),
    ("%a, %d %b %Y %H:%M:%S +0000", "EEE, dd MMM yyyy HH:mm:ss '+0000'", 0, "second"),
    ("%Y-%m-%d %H:%M:%S", "yyyy-MM-dd HH:mm:ss", 0, "second"),
    ("%a, %d %b %Y %H:%M:%S GMT", "EEE, dd MMM yyyy HH:mm:ss 'GMT'", 0, "second"),
    ("%d %b %Y %H:%M:%S EST", "dd MMM yyyy HH:mm:ss 'EST'", -5, "second"),
    ("%a, %d %b %Y %H:%M +0000", "EEE, dd MMM yyyy HH:mm '+0000'", 0, "minute"),
    ("%Y%m%dT%H%M%SZ", "yyyyMMdd'T'HHmmss'Z'", 0, "second"),
    ("%d %b %Y %H:%M", "dd MMM yyyy HH:mm", 0, "minute"),
    ("%Y-%m-%d", "yyyy-MM-dd", 0, "day"),
    ("%Y", "yyyy", 0, None),
    ("not-a-date", "'not-a-date'", 0, None),
]


def _sql_forms() -> str:
    n = len(TS_FORMS)
    raw = " ".join(f"WHEN {i} THEN strftime(ts + INTERVAL ({h}) HOUR, {S.lit(f)})" for i, (f, _, h, _) in enumerate(TS_FORMS))
    # the expected instant comes from the column itself, not from parsing the text again
    us = " ".join(f"WHEN {i} THEN epoch_us(date_trunc('{k}', ts))" for i, (_, _, _, k) in enumerate(TS_FORMS) if k)
    return f"SELECT event_id, CASE event_id % {n} {raw} END AS raw, CASE event_id % {n} {us} END AS ts_us FROM events"


@register("parse_timestamps", _sql_forms())
def q_parse_timestamps(spark, sf):
    ev = events_items(spark, sf)
    m = F.col("event_id") % len(TS_FORMS)
    raw = F.lit(None).cast("string")
    for i, (_, pattern, hours, _) in enumerate(TS_FORMS):
        raw = F.when(m == i, F.date_format(F.col("ts") + F.expr(f"INTERVAL {hours} HOURS"), pattern)).otherwise(raw)
    return ev.select("event_id", raw.alias("raw")).select(
        "event_id", "raw", F.unix_micros(parse_ts(F.col("raw"))).alias("ts_us"))


# ---------------------------------------------------------------- P02 validity split (documents)
def planted_doc_items(spark, sf):
    """Documents as items with planted faults: empty text, unparsable timestamp, non-http url."""
    d = read(spark, sf, "documents")
    items = documents_as_items(d)
    did = F.col("id").cast("long")
    raw_ts = F.when(did % 11 == 0, F.lit("not-a-date")).otherwise(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'Z'"))
    from tidings.functions.urls import normalize_url
    url = normalize_url(F.when(did % 13 == 0, F.lit("javascript:alert(1)")).otherwise(F.col("url")))
    text = F.when(did % 9 == 0, F.lit("  \n ")).otherwise(F.col("text"))
    return items.withColumn("ts", parse_ts(raw_ts)).withColumn("url", url).withColumn("text", text)


SQL_DOC_ITEMS = f"""di AS (SELECT lang AS briefing_id, doc_id, CAST(doc_id AS VARCHAR) AS id,
   CASE WHEN doc_id % 9 = 0 THEN '  \n ' ELSE text END AS text,
   {S.normalize_url("CASE WHEN doc_id % 13 = 0 THEN 'javascript:alert(1)' ELSE 'https://' || source || '.example.com/' || doc_id END")} AS url,
   {S.parse_ts("CASE WHEN doc_id % 11 = 0 THEN 'not-a-date' ELSE strftime(TIMESTAMP '2024-01-01' + doc_id * INTERVAL 1 MINUTE, '%Y-%m-%dT%H:%M:%SZ') END")} AS ts,
   source FROM documents)"""


@register("validity_split", f"""
WITH {SQL_DOC_ITEMS}, m AS (SELECT max(ts) AS as_of FROM di)
SELECT id, CASE WHEN coalesce({S.py_strip('text')}, '') = '' THEN 'empty_text'
                WHEN ts IS NULL THEN 'invalid_ts' WHEN url IS NULL THEN 'invalid_url'
                WHEN ts < (SELECT as_of FROM m) - INTERVAL 12 HOUR THEN 'too_old' ELSE 'kept' END AS status
FROM di""")
def q_validity_split(spark, sf):
    items = planted_doc_items(spark, sf)
    as_of = max_ts(items)
    return split_valid(items, 12, as_of).select("id", "status")


# ---------------------------------------------------------------- S03 / S01 pages as feed entries
def page_entries(spark, sf):
    p = read(spark, sf, "pages")
    pid = F.col("page_id")
    ts = F.timestamp_seconds(F.lit(1704067200) + pid * 60)
    link_struct = T.ArrayType(T.StructType([T.StructField("rel", T.StringType()), T.StructField("href", T.StringType())]))
    return p.select(
        F.concat(F.lit("page "), pid.cast("string")).alias("id"),
        F.when(pid % 7 == 3, F.lit(None).cast("string")).when(pid % 7 == 5, F.lit("javascript:void(0)"))
        .otherwise(F.col("url")).alias("link"),
        F.when(pid % 7 == 3, F.array(F.struct(F.lit("alternate").alias("rel"),
                                              F.regexp_replace("url", r"\Ahttps?:", "").alias("href"))))
        .otherwise(F.array().cast(link_struct)).alias("links"),
        F.regexp_extract("html", r"(?s)<title>(.*?)</title>", 1).alias("title"),
        F.when(pid % 13 == 6, F.lit("<p> </p>")).otherwise(F.col("html")).alias("summary"),
        F.lit(None).cast("string").alias("author"),
        F.when(pid % 5 == 0, F.date_format(ts, "EEE, dd MMM yyyy HH:mm:ss '+0000'"))
        .when(pid % 5 == 1, F.lit("not-a-date"))
        .otherwise(F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss'Z'")).alias("published"),
        *[F.lit(None).cast("string").alias(c) for c in ["date_published", "dateModified", "date_modified", "updated",
                                                        "feedburner_origlink", "origlink", "originallink"]],
    )


SQL_PAGE_ENTRIES = f"""pe AS (SELECT 'page ' || page_id AS id,
   CASE WHEN page_id % 7 = 3 THEN NULL WHEN page_id % 7 = 5 THEN 'javascript:void(0)' ELSE url END AS link,
   CASE WHEN page_id % 7 = 3 THEN regexp_replace(url, '\\Ahttps?:', '') END AS alt,
   regexp_extract(html, '(?s)<title>(.*?)</title>', 1) AS title,
   CASE WHEN page_id % 13 = 6 THEN '<p> </p>' ELSE html END AS summary,
   CASE WHEN page_id % 5 = 0 THEN strftime(TIMESTAMP '2024-01-01' + page_id * INTERVAL 1 MINUTE, '%a, %d %b %Y %H:%M:%S +0000')
        WHEN page_id % 5 = 1 THEN 'not-a-date'
        ELSE strftime(TIMESTAMP '2024-01-01' + page_id * INTERVAL 1 MINUTE, '%Y-%m-%dT%H:%M:%SZ') END AS published
   FROM pages),
ps AS (SELECT id, {S.clean_html("coalesce(nullif(summary, ''), nullif(title, ''))")} AS text,
   coalesce({S.normalize_url("nullif(link, '')")}, {S.normalize_url("nullif(alt, '')")}, {S.normalize_url("nullif(id, '')")}) AS url,
   {S.parse_ts("nullif(published, '')")} AS ts FROM pe),
pk AS (SELECT id, text, url, ts, CASE WHEN text = '' THEN 'empty_text' WHEN ts IS NULL THEN 'invalid_ts'
   WHEN url IS NULL THEN 'invalid_url' ELSE 'kept' END AS status FROM ps)"""


@register("ingest_pages", f"""
WITH {SQL_PAGE_ENTRIES}
SELECT id, status, url, epoch_us(ts) AS ts_us, length(text)::INTEGER AS n_chars, md5(text) AS text_md5 FROM pk""")
def q_ingest_pages(spark, sf):
    e = split_entries(page_entries(spark, sf), briefing_id="pages", source="rss")
    return e.select("id", "status", "url", F.unix_micros("ts").alias("ts_us"), F.length("text").alias("n_chars"), F.md5("text").alias("text_md5"))


@register("source_union", f"""
WITH {SQL_PAGE_ENTRIES}
SELECT 'rss' AS source_type, id, url, epoch_us(ts) AS ts_us, length(text)::INTEGER AS n_chars FROM pk WHERE status = 'kept'
UNION ALL
SELECT 'documents', CAST(doc_id AS VARCHAR), 'https://' || source || '.example.com/' || doc_id,
       epoch_us(TIMESTAMPTZ '2024-01-01 00:00:00+00' + doc_id * INTERVAL 1 MINUTE), length(text)::INTEGER FROM documents""")
def q_source_union(spark, sf):
    u = union_sources({"documents": read(spark, sf, "documents"), "rss": page_entries(spark, sf)})
    st = F.when(F.col("source") == "rss", F.lit("rss")).otherwise(F.lit("documents"))
    return u.select(st.alias("source_type"), "id", "url", F.unix_micros("ts").alias("ts_us"),
                    F.length("text").alias("n_chars"))


# ---------------------------------------------------------------- S07
@register("top_n_per_source", """
SELECT source, CAST(doc_id AS VARCHAR) AS id, rn FROM (
  SELECT source, doc_id, row_number() OVER (PARTITION BY source ORDER BY doc_id DESC, CAST(doc_id AS VARCHAR))::INTEGER AS rn
  FROM documents) WHERE rn <= 5""")
def q_top_n_per_source(spark, sf):
    items = documents_as_items(read(spark, sf, "documents"))
    return top_n_per_source(items, 5, "new").select("source", "id", "rn")


# forum posts made of the documents: section = language, score from the id (some without), an hour apart
@register("forum_top", """
WITH f AS (SELECT doc_id, lang, CASE WHEN doc_id % 10 <> 0 THEN (doc_id * 7919) % 1000 END AS score FROM documents),
m AS (SELECT max(doc_id) AS d FROM f)
SELECT CAST(doc_id AS VARCHAR) AS id, lang AS subreddit, rn FROM (
  SELECT doc_id, lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC NULLS LAST, CAST(doc_id AS VARCHAR))::INTEGER AS rn
  FROM f WHERE doc_id >= (SELECT d FROM m) - 240) WHERE rn <= 3""")
def q_forum_top(spark, sf):
    d = read(spark, sf, "documents")
    did = F.col("doc_id")
    raw = d.select(did.alias("id"), F.lit("post").alias("title"), F.col("text").alias("selftext"), F.concat(F.lit("/r/"), did.cast("string")).alias("permalink"),
                   F.lit("a").alias("author"), (F.lit(1704067200) + did * 3600).alias("created_utc"), F.col("lang").alias("subreddit"),
                   F.when(did % 10 != 0, (did * 7919) % 1000).alias("score"))
    posts = ingest_forum_posts(raw)
    top = top_n_per_source(posts, 3, "top", hours=240, as_of=posts.agg(F.max("ts")).first()[0])
    return top.select("id", F.col("metadata")["subreddit"].alias("subreddit"), "rn")


# ---------------------------------------------------------------- K02 / K05 / K06
@register("archive_layout", """
SELECT event_id, strftime(ts, '%Y') AS year, strftime(ts, '%m') AS month, event_type AS briefing_id,
       strftime(ts, '%Y') || '/' || strftime(ts, '%m') || '/' || event_type || '/briefing_' || strftime(ts, '%Y%m%dT%H%M%SZ') || '.md' AS path
FROM events""")
def q_archive_layout(spark, sf):
    from tidings.sinks.files import archive_layout

    ev = events_items(spark, sf).withColumnRenamed("event_type", "briefing_id")
    return archive_layout(ev, name=F.concat(F.lit("briefing_"), F.date_format("ts", "yyyyMMdd'T'HHmmss'Z'"), F.lit(".md"))) \
        .select("event_id", "year", "month", "briefing_id", "path")


@register("latest_runs", """
SELECT user_id AS briefing_id, event_id AS run_id, epoch_us(ts) AS ts_us, rn FROM (
  SELECT user_id, event_id, ts, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC)::INTEGER AS rn
  FROM events) WHERE rn <= 3""")
def q_latest_runs(spark, sf):
    from tidings.sinks.files import latest_runs

    runs = events_items(spark, sf).select(F.col("user_id").alias("briefing_id"), F.col("event_id").alias("run_id"), "ts")
    return latest_runs(runs, 3).select("briefing_id", "run_id", F.unix_micros("ts").alias("ts_us"), "rn")


@register("expired_runs", """
SELECT event_type AS briefing_id, strftime(ts, '%Y-%m-%d') AS run_date, count(*) AS runs
FROM events WHERE ts < (SELECT max(ts) FROM events) - INTERVAL 7 DAY GROUP BY ALL""")
def q_expired_runs(spark, sf):
    from tidings.sinks.files import expired_runs

    ev = events_items(spark, sf)
    runs = ev.select(F.col("event_type").alias("briefing_id"), F.col("event_id").alias("run_id"), "ts")
    return expired_runs(runs, max_ts(ev), 7)


# ---------------------------------------------------------------- X03 batch form
@register("window_counts", """
SELECT epoch_us(time_bucket(INTERVAL 1 HOUR, ts)) AS window_start_us, event_type AS source, count(*) AS n
FROM events GROUP BY ALL""")
def q_window_counts(spark, sf):
    from tidings.streaming.streams import window_counts

    ev = events_items(spark, sf).withColumnRenamed("event_type", "source")
    return window_counts(ev, "1 hour").select(F.unix_micros("window_start").alias("window_start_us"), "source", "n")



# ---------------------------------------------------------------- S02, S04, S05: adapters over planted documents
SQL_CLEAN_TEXT = S.clean_html("text")


@register("story_items", f"""
WITH r AS (SELECT doc_id, row_number() OVER (ORDER BY doc_id) - 1 AS pos, text, source FROM documents),
t AS (SELECT doc_id, {S.clean_html("'Title ' || doc_id || chr(10) || chr(10) || coalesce(text, '')")} AS txt,
   CASE WHEN doc_id % 4 = 0 THEN 'https://news.ycombinator.com/item?id=' || doc_id WHEN doc_id % 9 = 1 THEN NULL
        ELSE 'https://' || source || '.example.com/' || doc_id END AS url,
   CASE WHEN doc_id % 3 = 0 THEN 'Unknown' ELSE 'author' || doc_id % 7 END AS author FROM r WHERE doc_id % 5 <> 2)
SELECT CAST(doc_id AS VARCHAR) AS id, url, author, length(txt)::INTEGER AS n_chars, (1704067200 + doc_id)::BIGINT AS epoch FROM t WHERE url IS NOT NULL AND txt <> ''""")
def q_story_items(spark, sf):
    d = read(spark, sf, "documents")
    did, sid = F.col("doc_id"), F.col("doc_id").cast("string")
    # planted: other item types, stories without a link (their item page stands in), links of other schemes, no author
    raw = d.select(did.alias("list_pos"), did.alias("id"), F.when(did % 5 == 2, F.lit("job")).otherwise(F.lit("story")).alias("type"),
                   F.concat(F.lit("Title "), sid).alias("title"), "text",
                   F.when(did % 4 == 0, F.lit("")).when(did % 9 == 1, F.concat(F.lit("ftp://x/"), sid))
                   .otherwise(F.concat(F.lit("https://"), "source", F.lit(".example.com/"), sid)).alias("url"),
                   F.when(did % 3 != 0, F.concat(F.lit("author"), (did % 7).cast("string"))).alias("by"),
                   (did + 1704067200).alias("time"), (did % 100).alias("score"))
    items = ingest_stories(raw, limit=1 << 62)
    return items.select("id", "url", "author", F.length("text").alias("n_chars"), F.unix_seconds("ts").alias("epoch"))


@register("entry_links", f"""
SELECT page_id, CASE page_id % 6 WHEN 0 THEN url WHEN 1 THEN 'https://alt.example.com/' || page_id WHEN 2 THEN 'https://first.example.com/' || page_id
   WHEN 3 THEN 'http://orig.example.com/' || page_id WHEN 4 THEN 'https://id.example.com/' || page_id END AS link FROM pages""")
def q_entry_links(spark, sf):
    p = read(spark, sf, "pages")
    k, pid = F.col("page_id") % 6, F.col("page_id").cast("string")
    at = lambda n, host: F.when(k == n, F.concat(F.lit(host), pid))
    none = F.array().cast("array<struct<rel:string,href:string>>")
    pair = lambda rel, href: F.struct(F.lit(rel).alias("rel"), href.alias("href"))
    alt = F.concat(F.lit("https://alt.example.com/"), pid)
    first = F.concat(F.lit("first.example.com/"), pid)
    links = (F.when(k == 1, F.array(pair("self", F.lit("https://self.example.com/")), pair("alternate", alt)))
             .when(k == 2, F.array(pair("self", F.lit("")), pair("enclosure", first))).otherwise(none))
    entry = F.struct(F.when(k == 0, F.col("url")).otherwise(F.lit("")).alias("link"), links.alias("links"),
                     at(3, "http://orig.example.com/").alias("feedburner_origlink"), F.lit(None).cast("string").alias("origlink"),
                     F.lit("").alias("originallink"), F.when(k == 5, F.lit("javascript:void(0)")).otherwise(at(4, "id.example.com/")).alias("id"))
    return p.select("page_id", entry.alias("e")).select("page_id", resolve_entry_url(F.col("e")).alias("link"))


@register("list_feed_items", f"""
WITH t AS (SELECT doc_id, {SQL_CLEAN_TEXT} AS txt FROM documents)
SELECT CASE WHEN doc_id % 2 = 0 THEN CAST(doc_id AS VARCHAR) ELSE 'https://list.example.com/' || doc_id END AS id,
  'https://list.example.com/' || doc_id AS url, CASE doc_id % 3 WHEN 0 THEN 'name' || doc_id WHEN 1 THEN 'plain' || doc_id ELSE 'Unknown' END AS author,
  length(txt)::INTEGER AS n_chars, (1704067200 + doc_id * 60)::BIGINT AS epoch
FROM t WHERE txt <> '' AND doc_id % 8 <> 7""")
def q_list_feed_items(spark, sf):
    d = read(spark, sf, "documents")
    did, sid = F.col("doc_id"), F.col("doc_id").cast("string")
    when = F.timestamp_seconds(did * 60 + 1704067200)
    item = F.struct(
        F.when(did % 2 == 0, sid).otherwise(F.lit("")).alias("id"), F.lit("title").alias("title"), F.col("text").alias("description"),
        F.when(did % 4 != 1, F.concat(F.lit("https://list.example.com/"), sid)).alias("url"),
        F.concat(F.lit("list.example.com/"), sid).alias("link"),
        F.when(did % 3 == 0, F.concat(F.lit('{"name": "name'), sid, F.lit('"}'))).when(did % 3 == 1, F.concat(F.lit("plain"), sid)).alias("author"),
        F.when(did % 8 == 7, F.lit("someday")).otherwise(F.date_format(F.to_utc_timestamp(when, F.current_timezone()), "EEE, dd MMM yyyy HH:mm:ss 'GMT'")).alias("pubDate"))
    feeds = d.groupBy(F.floor(did / 40).alias("feed")).agg(F.collect_list(item).alias("items"))
    items = ingest_list_feed(feeds)
    return items.select("id", "url", "author", F.length("text").alias("n_chars"), F.unix_seconds("ts").alias("epoch"))


# ---------------------------------------------------------------- F11
@register("coerced_timestamps", """
SELECT event_id, epoch_us(ts) AS from_timestamp, epoch_us(date_trunc('second', ts)) AS from_epoch, epoch_us(date_trunc('second', ts)) AS from_text FROM events""")
def q_coerced_timestamps(spark, sf):
    ev = events_items(spark, sf).select("event_id", "ts", F.unix_seconds("ts").alias("epoch"), F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("text"))
    us = lambda c: F.unix_micros(coerce_ts(ev, c))
    return ev.select("event_id", us("ts").alias("from_timestamp"), us("epoch").alias("from_epoch"), us("text").alias("from_text"))
