from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidings.sources.items import ingest_list_feed, resolve_entry_url

LINKS = T.ArrayType(T.StructType([T.StructField("rel", T.StringType()), T.StructField("href", T.StringType())]))
ENTRY = T.StructType([T.StructField(n, T.StringType()) for n in ["link"]] + [T.StructField("links", LINKS)] +
                     [T.StructField(n, T.StringType()) for n in ["feedburner_origlink", "origlink", "originallink", "id"]])


def test_entry_links(spark):
    rows = [
        (None, [("alternate", "example.com/post")], None, None, None, None),
        (None, [], "http://site.example.org/a", None, None, None),
        (None, [], None, None, None, "https://blog.example.com/entry"),
        ("twitter.com/user/status/123", [], None, None, None, None),
        (None, [], None, None, None, None),
    ]
    df = spark.createDataFrame(rows, ENTRY)
    got = [r[0] for r in df.select(resolve_entry_url(F.struct(*df.columns))).collect()]
    assert got == ["https://example.com/post", "http://site.example.org/a", "https://blog.example.com/entry",
                   "https://twitter.com/user/status/123", None]


def test_list_feed_author(spark):
    schema = "items array<struct<id string, title string, description string, url string, link string, author string, date_published string>>"
    rows = [([("1", "T", "<p>body</p>", "example.com/1", None, '{"name": "Ann"}', "2024-01-01T00:00:00Z"),
              ("2", "T2", None, None, "https://e.com/2", "Bob", "2024-01-01T01:00:00Z"),
              ("3", "T3", None, None, None, "Cy", "2024-01-01T01:00:00Z")],)]
    items = ingest_list_feed(spark.createDataFrame(rows, schema)).orderBy("id").collect()
    assert [(r.id, r.author, r.url, r.text) for r in items] == [
        ("1", "Ann", "https://example.com/1", "body"), ("2", "Bob", "https://e.com/2", "T2")]


def test_dates_of_every_form_in_any_session_zone(spark):
    from email.utils import parsedate_to_datetime
    from datetime import datetime, timezone

    from pyspark.sql import functions as F

    from tidings.functions.timefmt import parse_ts
    from tidings.operators.briefing import iso_utc

    iso = ["2024-01-02T10:00:00Z", "2024-01-02T10:00:00.123456+02:00", "2024-01-02 10:00", "2024-01-02", "20240102T100000Z", "20240102", "2024-01-02T10:00:00-05"]
    mail = ["Tue, 02 Jan 2024 10:00:00 GMT", "Tue, 02 Jan 2024 10:00:00 UT", "Tue, 02 Jan 2024 10:00:00 EST", "Tue, 02 Jan 2024 10:00 +0000",
            "2 Jan 2024 10:00:00 -0330", "02 Jan 2024 10:00:00 PDT", "Tue, 2 Jan 24 10:00:00 GMT", "2 Jan 2024 10:00:00"]
    bad = ["2024", "12:30", "not-a-date", "", "2024-13-01", "40 Jan 2024 10:00:00 GMT", "2 Foo 2024 10:00:00 GMT", None]
    want = {}
    for x in iso:
        d = datetime.fromisoformat(x)
        want[x] = d.replace(tzinfo=d.tzinfo or timezone.utc)
    for x in mail:
        d = parsedate_to_datetime(x)
        want[x] = d.replace(tzinfo=d.tzinfo or timezone.utc)
    df = spark.createDataFrame([(x,) for x in iso + mail + bad], "raw string")
    zone = spark.conf.get("spark.sql.session.timeZone")
    try:
        for tz in ("UTC", "America/New_York"):
            spark.conf.set("spark.sql.session.timeZone", tz)
            rows = df.select("raw", F.unix_micros(parse_ts("raw")).alias("us"), iso_utc(parse_ts("raw")).alias("iso")).collect()
            got = {r.raw: r.us for r in rows}
            assert {k: v for k, v in got.items() if v is not None} == {k: round(v.timestamp() * 1e6) for k, v in want.items()}
            assert {r.raw: r.iso for r in rows}["2024-01-02T10:00:00Z"] == "2024-01-02T10:00:00Z"
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


def test_top_of_each_section_within_its_window(spark):
    import datetime as dt

    from tidings.sources.items import ingest_forum_posts, top_n_per_source

    rows = [(f"p{i}", "t", "x", f"/r/{i}", "a", 1704067200 + 3600 * i, "s1" if i % 2 else "s2", None if i == 5 else i * 10 % 70) for i in range(10)]
    posts = ingest_forum_posts(spark.createDataFrame(
        rows, "id string, title string, selftext string, permalink string, author string, created_utc long, subreddit string, score int"))
    top = top_n_per_source(posts, 1, "top", hours=6, as_of=dt.datetime(2024, 1, 1, 9))
    assert {r.id for r in top.collect()} == {"p6", "p3"}


def test_write_again_replaces_a_run(spark, tmp_path):
    import datetime as dt

    from tidings.sinks.files import write_briefings

    for text in ("one", "two"):
        df = spark.createDataFrame([("b", dt.datetime(2024, 1, 1), text, "T", "{}")], "briefing_id string, run_ts timestamp, markdown string, title string, json string")
        write_briefings(df, str(tmp_path), formats=("md", "json", "html"))
    got = spark.read.text(f"{tmp_path}/md").collect()
    assert [r.value for r in got] == ["two"]
