"""File sinks and run bookkeeping (layout, latest runs, retention)."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def utc(ts_col: str | Column) -> Column:
    """The timestamp's UTC clock, whatever the session's time zone, for formatting."""
    return F.to_utc_timestamp(ts_col, F.current_timezone())


def archive_layout(df: DataFrame, name: Column, ts_col: str = "ts") -> DataFrame:
    """Adds ``year``, ``month`` and ``path`` = ``YYYY/MM/<briefing_id>/<name>``."""
    y = F.date_format(utc(ts_col), "yyyy")
    m = F.date_format(utc(ts_col), "MM")
    return df.withColumn("year", y).withColumn("month", m).withColumn(
        "path", F.concat_ws("/", y, m, F.col("briefing_id"), name))


def latest_runs(runs: DataFrame, n: int = 1, *, key: str = "briefing_id", ts_col: str = "ts",
                id_col: str = "run_id") -> DataFrame:
    """The last ``n`` runs per key (``rn`` 1 = latest; ties by run id descending)."""
    w = Window.partitionBy(key).orderBy(F.col(ts_col).desc(), F.col(id_col).desc())
    return runs.withColumn("rn", F.row_number().over(w)).filter(F.col("rn") <= n)


def expired_runs(runs: DataFrame, as_of, days: int = 7, *, key: str = "briefing_id", ts_col: str = "ts") -> DataFrame:
    """Run partitions (key, run date) older than ``as_of - days``; deleting them is left to the caller."""
    lo = F.lit(as_of).cast("timestamp") - F.expr(f"INTERVAL {int(days)} DAYS")
    return (runs.filter(F.col(ts_col) < lo)
            .groupBy(key, F.date_format(utc(ts_col), "yyyy-MM-dd").alias("run_date"))
            .agg(F.count(F.lit(1)).alias("runs")))


def write_briefings(briefings: DataFrame, out_dir: str, formats: Sequence[str] = ("md", "json"),
                    run_ts_col: str = "run_ts") -> None:
    """One file set per briefing and run: md and html as text, json as one document per line, partitioned by
    ``briefing_id`` and ``run_ts`` (UTC, ``yyyyMMdd'T'HHmmss'Z'``). Writing a run again replaces its files.
    ``briefings`` has briefing_id, markdown, title and (for json) ``json``, see ``render.briefing_json``."""
    base = briefings.withColumn("run_ts", F.date_format(utc(run_ts_col), "yyyyMMdd'T'HHmmss'Z'")) \
        if dict(briefings.dtypes).get(run_ts_col) == "timestamp" else briefings
    if "md" in formats:
        base.select("briefing_id", "run_ts", F.col("markdown").alias("value")).write.mode("overwrite") \
            .option("partitionOverwriteMode", "dynamic").partitionBy("briefing_id", "run_ts").text(f"{out_dir}/md")
    if "json" in formats:
        base.select("briefing_id", "run_ts", F.col("json").alias("value")).write.mode("overwrite") \
            .option("partitionOverwriteMode", "dynamic").partitionBy("briefing_id", "run_ts").text(f"{out_dir}/json")
    if "html" in formats:
        from tidings.operators.render import render_html

        base.select("briefing_id", "run_ts", render_html("markdown", "title").alias("value")).write.mode("overwrite") \
            .option("partitionOverwriteMode", "dynamic").partitionBy("briefing_id", "run_ts").text(f"{out_dir}/html")


def _run_path(run_id: str, name: str) -> str:
    for part in (run_id, name):
        if part != "*" and not re.fullmatch(r"[\w.\-]+", part) or part in (".", ".."):
            raise ValueError(f"not usable as a folder name: {part!r}")
    return f"run={run_id}/table={name}"


def mark_run_table(spark: SparkSession, out_dir: str, run_id: str, name: str, state: str) -> None:
    """Set the commit marker of a run's table: ``open`` while it is written, ``done`` once it is whole."""
    row = spark.createDataFrame([(run_id, name, state)], "run_id string, table_name string, state string")
    row.coalesce(1).write.mode("overwrite").parquet(f"{out_dir}/commits/{_run_path(run_id, name)}")


def write_run_table(df: DataFrame, out_dir: str, run_id: str, name: str, *, fmt: str = "parquet", partition_by: Sequence[str] = ()) -> None:
    """Write a run's table so that it can be written again: the run's own folder is replaced whole, and readers take it
    only once its commit marker says ``done``. A job that fails on the way leaves the marker ``open``."""
    spark = df.sparkSession
    mark_run_table(spark, out_dir, run_id, name, "open")
    rows = df.withColumns({"run_id": F.lit(run_id), "table_name": F.lit(name)})
    rows.write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy(*partition_by).format(fmt).save(
        f"{out_dir}/{fmt}/{_run_path(run_id, name)}")
    mark_run_table(spark, out_dir, run_id, name, "done")


def committed(spark: SparkSession, out_dir: str) -> DataFrame:
    """(run_id, table_name) of the tables that were written whole."""
    marks = spark.read.schema("run_id string, table_name string, state string").option("recursiveFileLookup", "true").parquet(f"{out_dir}/commits")
    return marks.filter("state = 'done'").select("run_id", "table_name")


def read_run_table(spark: SparkSession, out_dir: str, name: str, schema: str, *, fmt: str = "parquet", run_id: str | None = None) -> DataFrame:
    """The rows (``schema``, with run_id) of all committed runs of a table, or of one."""
    runs = F.lit(True) if run_id is None else F.col("run_id") == run_id
    rows = spark.read.schema(f"{schema}, run_id string, table_name string").option("basePath", f"{out_dir}/{fmt}").format(fmt).load(
        f"{out_dir}/{fmt}/{_run_path('*', name)}")
    return rows.filter(runs).join(committed(spark, out_dir), ["run_id", "table_name"], "left_semi").drop("table_name", "run", "table")


def write_stage(df: DataFrame, out_dir: str, stage: str, run_id: str) -> None:
    """Persist a run's stage table for audit: parquet partitioned by briefing (cluster stays a column). A rerun replaces it."""
    write_run_table(df, out_dir, run_id, stage, partition_by=["briefing_id"])


def write_metrics(metrics: DataFrame, out_dir: str, run_id: str) -> None:
    """A run's metrics as JSON lines. A rerun replaces them."""
    write_run_table(metrics, out_dir, run_id, "metrics", fmt="json")
