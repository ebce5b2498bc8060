"""Readers for the landed tables. Column pruning and filters are left to Catalyst, split sizes to the session."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Read a landed table as it lies."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
