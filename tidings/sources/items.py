"""The common item schema, per-source projections and their union.

HTTP fetching is not part of this library: every adapter reads landed JSON/parquet rows (batch or
stream) and projects them to :data:`ITEM_COLUMNS`.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidings.functions.html import clean_html
from tidings.functions.text import py_strip
from tidings.functions.timefmt import parse_ts
from tidings.functions.urls import normalize_url

ITEM_SCHEMA = T.StructType([
    T.StructField("briefing_id", T.StringType()),
    T.StructField("id", T.StringType()),
    T.StructField("text", T.StringType()),
    T.StructField("url", T.StringType()),
    T.StructField("author", T.StringType()),
    T.StructField("ts", T.TimestampType()),
    T.StructField("source", T.StringType()),
    T.StructField("metadata", T.MapType(T.StringType(), T.StringType())),
])
ITEM_COLUMNS = [f.name for f in ITEM_SCHEMA.fields]

# Item-page link of a story without its own url, and the forum host.
STORY_PAGE = "https://news.ycombinator.com/item?id="
FORUM_HOST = "https://www.reddit.com"


def nonempty(c: Column) -> Column:
    """Python truthiness for strings: empty string counts as missing."""
    return F.when(c != "", c)


def first_nonempty(*cols: Column) -> Column:
    return F.coalesce(*[nonempty(c) for c in cols])


def _meta(**kv: Column) -> Column:
    args = []
    for k, v in kv.items():
        args += [F.lit(k), v.cast("string")]
    return F.create_map(*args)


def with_fields(df: DataFrame, names) -> DataFrame:
    """Optional feed fields absent from the landed schema read as null strings."""
    for n in names:
        if n not in df.columns:
            df = df.withColumn(n, F.lit(None).cast("string"))
    return df


def _project(df: DataFrame) -> DataFrame:
    return df.select(*[F.col(c).cast(ITEM_SCHEMA[c].dataType) for c in ITEM_COLUMNS])


def documents_as_items(docs: DataFrame) -> DataFrame:
    """The driver's ``documents`` table as items (see FIXTURES B): id = doc_id, a per-source url,
    ts = 2024-01-01 + doc_id minutes, briefing = language."""
    return docs.select(
        F.col("lang").alias("briefing_id"),
        F.col("doc_id").cast("string").alias("id"),
        F.col("text"),
        F.concat(F.lit("https://"), F.col("source"), F.lit(".example.com/"), F.col("doc_id").cast("string")).alias("url"),
        F.lit("Unknown").alias("author"),
        (F.timestamp_seconds(F.lit(1704067200) + F.col("doc_id") * 60)).alias("ts"),
        F.col("source"),
        _meta(source=F.col("source"), lang=F.col("lang")).alias("metadata"),
    )


def ingest_stories(raw: DataFrame, limit: int = 50, briefing_id: str = "stories") -> DataFrame:
    """Story ingest. ``raw``: list_pos, id, type, title, text, url, by, time (epoch s), score.

    The first ``limit`` positions of the id list are taken *before* the story-type filter (fewer than
    ``limit`` stories may remain); text = clean(title + blank line + text); url falls back to the item
    page; author defaults to ``Unknown``; invalid url and empty text drop the row.
    """
    top = raw.filter(F.col("list_pos") < limit).filter(F.col("type") == "story")
    sid = F.col("id").cast("string")
    text = clean_html(F.concat(F.coalesce(F.col("title"), F.lit("")), F.lit("\n\n"), F.coalesce(F.col("text"), F.lit(""))))
    url = normalize_url(F.coalesce(nonempty(F.col("url")), F.concat(F.lit(STORY_PAGE), sid)))
    out = top.select(
        F.lit(briefing_id).alias("briefing_id"), sid.alias("id"), text.alias("text"), url.alias("url"),
        F.coalesce(nonempty(F.col("by")), F.lit("Unknown")).alias("author"),
        F.timestamp_seconds(F.col("time")).alias("ts"), F.lit("hackernews").alias("source"),
        _meta(source=F.lit("hackernews"), score=F.col("score")).alias("metadata"),
    )
    return _project(out.filter(F.col("url").isNotNull() & (F.col("text") != "")))


ENTRY_DATE_FIELDS = ["date_published", "dateModified", "date_modified", "published", "updated"]
LIST_DATE_FIELDS = ["date_published", "dateModified", "date_modified", "pubDate", "date"]


def resolve_entry_url(entry: Column) -> Column:
    """First candidate that normalises: link, the rel=alternate href (else the first href),
    feedburner_origlink, origlink, originallink, id."""
    links = entry["links"]
    alt = F.get(F.filter(links, lambda li: (li["rel"] == "alternate") & (nonempty(li["href"]).isNotNull())), 0)["href"]
    first_href = F.get(F.filter(links, lambda li: nonempty(li["href"]).isNotNull()), 0)["href"]
    cands = F.array(
        nonempty(entry["link"]), F.coalesce(alt, first_href), nonempty(entry["feedburner_origlink"]),
        nonempty(entry["origlink"]), nonempty(entry["originallink"]), nonempty(entry["id"]),
    )
    return F.get(F.filter(F.transform(cands, lambda c: normalize_url(c)), lambda u: u.isNotNull()), 0)


def ingest_feed_entries(raw: DataFrame, briefing_id: str = "feed", source: str = "rss") -> DataFrame:
    """Feed-entry ingest. ``raw`` has the entry fields as columns (id, link, links, title, summary,
    author, the date fields, feedburner_origlink, origlink, originallink).

    Returns items plus ``status``: rows are dropped, in this order, for empty text, bad timestamp, bad url;
    :func:`split_valid` keeps the quarantined rows when asked.
    """
    return split_entries(raw, briefing_id, source).filter(F.col("status") == "kept").select(*ITEM_COLUMNS)


def split_entries(raw: DataFrame, briefing_id: str = "feed", source: str = "rss") -> DataFrame:
    raw = with_fields(raw, ["id", "link", "title", "summary", "author", "feedburner_origlink", "origlink",
                            "originallink"] + ENTRY_DATE_FIELDS)
    if "links" not in raw.columns:
        raw = raw.withColumn("links", F.array().cast("array<struct<rel:string,href:string>>"))
    text = clean_html(first_nonempty(F.col("summary"), F.col("title")))
    ts = parse_ts(first_nonempty(*[F.col(c) for c in ENTRY_DATE_FIELDS]))
    url = resolve_entry_url(F.struct(*[F.col(c) for c in ["link", "links", "feedburner_origlink", "origlink",
                                                         "originallink", "id"]]))
    df = raw.select(
        F.lit(briefing_id).alias("briefing_id"),
        first_nonempty(F.col("id"), F.col("link"), F.col("title")).alias("id"),
        text.alias("text"), url.alias("url"),
        F.coalesce(F.col("author"), F.lit("Unknown")).alias("author"),
        ts.alias("ts"), F.lit(source).alias("source"), _meta(source=F.lit(source)).alias("metadata"),
    )
    status = (
        F.when(F.col("text") == "", "empty_text")
        .when(F.col("ts").isNull(), "invalid_ts")
        .when(F.col("url").isNull(), "invalid_url")
        .otherwise("kept")
    )
    return df.withColumn("status", status)


def ingest_list_feed(raw: DataFrame, briefing_id: str = "list", source: str = "twitter") -> DataFrame:
    """JSON-feed ingest: one row per feed document with ``items`` (array of entries with author as a
    JSON string or plain string). Text = description else title; url = url else link; id falls back
    to the url."""
    e = with_fields(raw.select(F.explode("items").alias("e")).select("e.*"),
                    ["id", "title", "description", "url", "link", "author"] + LIST_DATE_FIELDS)
    text = clean_html(first_nonempty(F.col("description"), F.col("title")))
    ts = parse_ts(first_nonempty(*[F.col(c) for c in LIST_DATE_FIELDS]))
    author = F.coalesce(F.get_json_object(F.col("author"), "$.name"),
                        F.when(~F.col("author").startswith("{"), F.col("author")), F.lit("Unknown"))
    url = normalize_url(F.coalesce(nonempty(F.col("url")), F.col("link")))
    df = e.select(
        F.lit(briefing_id).alias("briefing_id"), text.alias("text"), ts.alias("ts"), author.alias("author"),
        url.alias("url"), F.col("id").alias("_id"), F.lit(source).alias("source"),
        _meta(source=F.lit(source)).alias("metadata"),
    )
    df = df.filter((F.col("text") != "") & F.col("ts").isNotNull() & F.col("url").isNotNull())
    return _project(df.withColumn("id", F.coalesce(nonempty(F.col("_id")), F.col("url"))))


def ingest_forum_posts(raw: DataFrame, briefing_id: str = "forum") -> DataFrame:
    """Forum posts (id, title, selftext, permalink, author, created_utc, subreddit and, where the listing has it,
    score); no empty-text drop."""
    score = F.col("score").cast("string") if "score" in raw.columns else F.lit(None).cast("string")
    text = clean_html(F.concat(F.coalesce(F.col("title"), F.lit("")), F.lit("\n\n"), F.coalesce(F.col("selftext"), F.lit(""))))
    return _project(raw.select(
        F.lit(briefing_id).alias("briefing_id"), F.col("id").cast("string").alias("id"), text.alias("text"),
        F.concat(F.lit(FORUM_HOST), F.col("permalink")).alias("url"),
        F.coalesce(nonempty(F.col("author")), F.lit("Unknown")).alias("author"),
        F.timestamp_seconds(F.col("created_utc")).alias("ts"), F.lit("reddit").alias("source"),
        _meta(source=F.lit("reddit"), subreddit=F.col("subreddit"), score=score).alias("metadata"),
    ))


ADAPTERS: dict[str, Callable[[DataFrame], DataFrame]] = {
    "documents": documents_as_items,
    "rss": ingest_feed_entries,
    "hackernews": ingest_stories,
    "twitter": ingest_list_feed,
    "reddit": ingest_forum_posts,
}


def union_sources(frames: Mapping[str, DataFrame]) -> DataFrame:
    """Dispatch each landed frame on its source type and union the items; an unknown type is an error."""
    out = None
    for kind, df in frames.items():
        if kind not in ADAPTERS:
            raise ValueError(f"Unknown source type: {kind}")
        items = ADAPTERS[kind](df) if kind != "documents" else _project(documents_as_items(df))
        out = items if out is None else out.unionByName(items)
    if out is None:
        raise ValueError("no sources given")
    return out


def top_n_per_source(items: DataFrame, n: int, by: str = "new", *, partition_cols: tuple[str, ...] = ("source", "channel"),
                     hours: float | None = None, as_of=None) -> DataFrame:
    """At most ``n`` items per source and channel (a forum's sections are channels of one source; a missing channel
    is one of its own): ``new`` = latest first, ``top`` = highest ``metadata['score']``. With ``hours`` only items of
    the last ``hours`` before ``as_of`` compete, as a forum's ``top`` of the day does."""
    from pyspark.sql import Window

    pool = items if hours is None else time_window(items, hours, as_of)
    if "channel" not in pool.columns:
        pool = pool.withColumn("channel", F.col("metadata")["subreddit"] if "metadata" in pool.columns else F.lit(None).cast("string"))
    key = F.col("ts").desc() if by == "new" else F.col("metadata")["score"].try_cast("double").desc_nulls_last()
    w = Window.partitionBy(*partition_cols).orderBy(key, F.col("id"))
    return pool.withColumn("rn", F.row_number().over(w)).filter(F.col("rn") <= n)


def time_window(items: DataFrame, hours: float, as_of, ts_col: str = "ts") -> DataFrame:
    """Keep ``ts >= as_of - hours`` (inclusive, no upper bound). ``as_of`` is a literal, so the filter
    reaches the parquet scan."""
    lo = F.lit(as_of).cast("timestamp") - F.expr(f"INTERVAL {int(hours * 3600)} SECONDS")
    return items.filter(F.col(ts_col) >= lo)


def split_valid(items: DataFrame, hours: float, as_of, *, ts_col: str = "ts") -> DataFrame:
    """Adds ``status``: empty_text, invalid_ts, invalid_url, too_old or kept (first failing rule wins)."""
    lo = F.lit(as_of).cast("timestamp") - F.expr(f"INTERVAL {int(hours * 3600)} SECONDS")
    status = (
        F.when(F.coalesce(py_strip(F.col("text")), F.lit("")) == "", "empty_text")
        .when(F.col(ts_col).isNull(), "invalid_ts")
        .when(F.col("url").isNull(), "invalid_url")
        .when(F.col(ts_col) < lo, "too_old")
        .otherwise("kept")
    )
    return items.withColumn("status", status)


def window_report(items_with_status: DataFrame, group_cols=("briefing_id",)) -> DataFrame:
    s = F.col("status")
    return items_with_status.groupBy(*group_cols).agg(
        F.count_if(s == "kept").alias("kept"), F.count_if(s == "too_old").alias("too_old"),
        F.count_if(s == "invalid_ts").alias("invalid_ts"),
    )
