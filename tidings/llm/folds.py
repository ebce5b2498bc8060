"""Label folds and bounded training samples of the classifiers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def fold(key: Column, folds: int) -> Column:
    """crc32 of the key as text, modulo ``folds`` (a null key is in no fold)."""
    return F.pmod(F.crc32(key.cast("string").cast("binary")), F.lit(folds))


def training_labels(labels: DataFrame, key: str, label: str, folds: int, held: int) -> DataFrame:
    """(id, y) of every labelled row outside the held-out fold; of repeated rows the larger label counts."""
    rows = labels.select(F.col(key).cast("long").alias("id"), F.col(label).cast("int").alias("y"))
    return rows.filter(F.col("id").isNotNull() & F.col("y").isin(0, 1) & (fold(F.col("id"), folds) != held)).groupBy("id").agg(
        F.max("y").alias("y"))


def bounded(rows: DataFrame, bound: int, seed: str) -> DataFrame:
    """At most ``bound`` rows, those with the smallest hash of their id (the same ones on every run)."""
    return rows.orderBy(F.xxhash64("id", F.lit(seed)), "id").limit(bound)
