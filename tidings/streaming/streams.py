"""Streaming forms of ingest. Dedup and counts run unchanged on a batch DataFrame or a ``readStream`` one."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidings.functions.text import clean_for_embedding


def window_counts(items: DataFrame, window: str = "1 hour", *, ts_col: str = "ts", key: str = "source",
                  watermark: str | None = None) -> DataFrame:
    """Kept items per source per tumbling window. On a stream pass ``watermark``: rows later than it are
    dropped and a window is emitted once closed (append mode)."""
    df = items.withWatermark(ts_col, watermark) if watermark else items
    return (df.groupBy(F.window(ts_col, window).alias("w"), F.col(key))
            .agg(F.count(F.lit(1)).alias("n"))
            .select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), key, "n"))


def stream_dedup(items: DataFrame, hours: float, *, id_col: str = "id", ts_col: str = "ts") -> DataFrame:
    """Exact-id dedup inside the horizon: the first row per id wins; state expires with the watermark."""
    return items.withWatermark(ts_col, f"{int(hours * 3600)} seconds").dropDuplicatesWithinWatermark([id_col])


def ingest_batch(items: DataFrame, out_dir: str, batch_id: int, as_of, hours: float) -> None:
    """Write one batch of items (with ``status``): kept ones of the last ``hours`` before ``as_of`` to ``items``, the others to
    ``quarantine`` with the reason. The batch's folders are replaced whole, and its marker is written last."""
    spark = items.sparkSession
    lo = F.lit(as_of).cast("timestamp") - F.expr(f"INTERVAL {int(hours * 3600)} SECONDS")
    judged = items.withColumn("status", F.when((F.col("status") == "kept") & (F.col("ts") < lo), "too_old").otherwise(F.col("status")))
    judged = judged.withColumn("batch", F.lit(batch_id).cast("long"))
    kept = F.col("status") == "kept"
    for name, rows in (("items", judged.filter(kept).drop("status")), ("quarantine", judged.filter(~kept))):
        rows.write.mode("overwrite").parquet(f"{out_dir}/{name}/b={batch_id}")
    mark = spark.createDataFrame([(batch_id, True)], "batch long, done boolean")
    mark.coalesce(1).write.mode("overwrite").parquet(f"{out_dir}/batches/b={batch_id}")


def _batch_clock(spark, out_dir: str, batch_id: int, clock):
    """The batch's own time: what an earlier try of the batch has written down, else the clock's."""
    path = f"{out_dir}/clock/b={batch_id}"
    where = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/_SUCCESS")
    if where.getFileSystem(spark._jsc.hadoopConfiguration()).exists(where):
        return spark.read.schema("as_of timestamp").parquet(path).first()[0]
    spark.createDataFrame([(clock(batch_id),)], "as_of timestamp").coalesce(1).write.mode("overwrite").parquet(path)
    return spark.read.schema("as_of timestamp").parquet(path).first()[0]


def stream_ingest(spark, in_dir: str, out_dir: str, checkpoint: str, schema, *, hours: float, clock=None,
                  fmt: str = "json", source: str = "rss", briefing_id: str = "feed", files_per_batch: int | None = None):
    """Continuous ingest of landed feed-entry files: entries -> items (clean text, normalised url,
    parsed timestamp) -> validity status -> :func:`ingest_batch`.

    The horizon moves: every batch is judged by its own time, ``clock(batch_id)`` (default: now, UTC), which is written
    down before the batch, so a replay of a batch judges alike and replaces what a first try has left. Readers
    use :func:`read_ingested`, which takes finished batches only. ``availableNow`` trigger; returns the started query.
    """
    from tidings.sources.items import split_entries

    reader = spark.readStream.format(fmt).schema(schema)
    if files_per_batch is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    clock = clock or (lambda batch_id: dt.datetime.now(dt.timezone.utc))

    def write(batch: DataFrame, batch_id: int) -> None:
        items = split_entries(batch, briefing_id=briefing_id, source=source).withColumn("text", clean_for_embedding("text"))
        ingest_batch(items, out_dir, batch_id, _batch_clock(batch.sparkSession, out_dir, batch_id, clock), hours)

    return (reader.load(in_dir).writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
            .trigger(availableNow=True).start())


def read_ingested(spark, out_dir: str, name: str = "items") -> DataFrame:
    """The rows of ``items`` or ``quarantine`` of the finished batches."""
    done = spark.read.schema("batch long, done boolean").option("recursiveFileLookup", "true").parquet(f"{out_dir}/batches")
    rows = spark.read.option("mergeSchema", "true").option("recursiveFileLookup", "true").parquet(f"{out_dir}/{name}")
    return rows.join(done.select("batch").distinct(), "batch", "left_semi")


ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def run_to_end(rows: DataFrame, out_dir: str, checkpoint: str, provider: str | None = ROCKSDB) -> DataFrame:
    """Run a stream over what has landed (``availableNow``, append) into a parquet table, and read it back. State is kept by
    ``provider``: RocksDB holds it off the heap and on disk, so it may outgrow an executor's memory."""
    spark, key = rows.sparkSession, "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(key, None)
    if provider is not None:
        spark.conf.set(key, provider)
    try:
        rows.writeStream.format("parquet").option("path", out_dir).option("checkpointLocation", checkpoint).outputMode("append").trigger(
            availableNow=True).start().awaitTermination()
    finally:
        if provider is not None:
            spark.conf.set(key, before) if before is not None else spark.conf.unset(key)
    return spark.read.schema(rows.schema).parquet(out_dir)
