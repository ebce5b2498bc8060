import datetime as dt
import os
import tempfile

from tidings.streaming.streams import stream_dedup, window_counts


def test_stream_dedup_and_counts(spark):
    d = tempfile.mkdtemp(prefix="tidings-stream-", dir="/tmp")
    base = dt.datetime(2024, 1, 1)
    rows = [(f"id{i % 50}", base + dt.timedelta(minutes=i), f"s{i % 3}") for i in range(100)]
    df = spark.createDataFrame(rows, "id string, ts timestamp, source string")
    df.write.parquet(os.path.join(d, "in"))
    src = spark.readStream.schema(df.schema).parquet(os.path.join(d, "in"))
    q = (stream_dedup(src, 24).writeStream.format("memory").queryName("dedup_out").outputMode("append")
         .option("checkpointLocation", os.path.join(d, "ck1")).trigger(availableNow=True).start())
    q.awaitTermination()
    assert spark.sql("select count(*) from dedup_out").first()[0] == 50
    q2 = (window_counts(src, "1 hour", watermark="0 seconds").writeStream.format("memory").queryName("wc_out")
          .outputMode("append").option("checkpointLocation", os.path.join(d, "ck2")).trigger(availableNow=True).start())
    q2.awaitTermination()
    got = {(r.window_start, r.source): r.n for r in spark.sql("select * from wc_out").collect()}
    batch = {(r.window_start, r.source): r.n for r in window_counts(df, "1 hour").collect()}
    assert got and all(batch[k] == v for k, v in got.items())


def test_stream_ingest_equals_batch(spark):
    import json

    from pyspark.sql import functions as F

    from tidings.sources.items import split_entries
    from tidings.streaming.streams import read_ingested, stream_ingest

    d = tempfile.mkdtemp(prefix="tidings-ingest-", dir="/tmp")
    os.makedirs(os.path.join(d, "in"))
    entries = [
        {"id": "a", "link": "example.com/a", "summary": "<p>Hello \\x4 world</p>", "published": "2024-01-02T00:00:00Z"},
        {"id": "urn:b", "link": "javascript:alert(1)", "summary": "text", "published": "2024-01-02T00:00:00Z"},
        {"id": "c", "link": "https://e.com/c", "summary": "", "title": "", "published": "2024-01-02T00:00:00Z"},
        {"id": "d", "link": "https://e.com/d", "summary": "old", "published": "Mon, 01 Jan 2024 00:00:00 +0000"},
        {"id": "e", "link": "https://e.com/e", "summary": "bad date", "published": "not-a-date"},
    ]
    with open(os.path.join(d, "in", "part-0.json"), "w") as fh:
        fh.write("\n".join(json.dumps(e) for e in entries))
    schema = "id string, link string, title string, summary string, published string"
    q = stream_ingest(spark, os.path.join(d, "in"), os.path.join(d, "out"), os.path.join(d, "ck"),
                      schema, hours=12, clock=lambda batch: dt.datetime(2024, 1, 2, 6, tzinfo=dt.timezone.utc))
    q.awaitTermination()
    got = {r.id: r.status for r in read_ingested(spark, os.path.join(d, "out"), "quarantine").collect()}
    got |= {r.id: "kept" for r in read_ingested(spark, os.path.join(d, "out")).collect()}
    assert got == {"a": "kept", "urn:b": "invalid_url", "c": "empty_text", "d": "too_old", "e": "invalid_ts"}
    batch = split_entries(spark.read.schema(schema).json(os.path.join(d, "in")))
    assert {r.id for r in batch.filter(F.col("status") == "kept").collect()} == {"a", "d"}


def test_replayed_batches_change_nothing(spark):
    """A batch is written again after its horizon has been written down: same rows, whatever the clock says by then."""
    from tidings.streaming.streams import _batch_clock, ingest_batch, read_ingested

    d = tempfile.mkdtemp(prefix="tidings-replay-", dir="/tmp")
    rows = [(str(i), dt.datetime(2024, 1, 1, i), "kept" if i % 4 else "invalid_url") for i in range(12)]
    items = spark.createDataFrame(rows, "id string, ts timestamp, status string")
    for hour in (10, 23):  # the second try comes later
        at = _batch_clock(spark, d, 0, lambda batch, h=hour: dt.datetime(2024, 1, 1, h, tzinfo=dt.timezone.utc))
        ingest_batch(items, d, 0, at, 6)
        assert sorted(int(r.id) for r in read_ingested(spark, d).collect()) == [5, 6, 7, 9, 10, 11]
        assert {(r.id, r.status) for r in read_ingested(spark, d, "quarantine").collect()} == {
            ("0", "invalid_url"), ("4", "invalid_url"), ("8", "invalid_url"), ("1", "too_old"), ("2", "too_old"), ("3", "too_old")}


def test_unfinished_batches_are_not_read(spark):
    from tidings.streaming.streams import ingest_batch, read_ingested

    d = tempfile.mkdtemp(prefix="tidings-replay-", dir="/tmp")
    items = spark.createDataFrame([("a", dt.datetime(2024, 1, 1), "kept")], "id string, ts timestamp, status string")
    ingest_batch(items, d, 0, dt.datetime(2024, 1, 1), 6)
    items.drop("status").withColumn("batch", items.id.isNull().cast("long") + 1).write.parquet(f"{d}/items/b=1")  # died before its marker
    assert [(r.id, r.batch) for r in read_ingested(spark, d).collect()] == [("a", 0)]
