"""Row numbers and running sums that no single task has to compute: range partitions, then a prefix sum over the partitions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidings.session import cut_lineage


def prefix_row_number(df: DataFrame, keys: Sequence[str], order: Sequence[str], out: str) -> DataFrame:
    """``df`` with ``out`` = 1.. per ``keys`` in ``order`` (which should be unique inside a key).

    Rows are range-partitioned by (keys, order) and written with their partition number, so a hot key spreads
    over many partitions; each (key, partition) is numbered apart and shifted by the rows before it.
    """
    placed = cut_lineage(df.repartitionByRange(*keys, *order).withColumn("_range", F.spark_partition_id()))
    counts = placed.groupBy(*keys, "_range").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy(*(keys or [F.lit(0)])).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.withColumn("_before", F.coalesce(F.sum("_n").over(before), F.lit(0))).drop("_n")
    inside = Window.partitionBy(*keys, "_range").orderBy(*order)
    same = [F.col("p." + k).eqNullSafe(F.col("c." + k)) for k in [*keys, "_range"]]
    on = same[0]
    for c in same[1:]:
        on = on & c
    joined = placed.alias("p").join(counts.alias("c"), on).select("p.*", "c._before")
    return joined.withColumn(out, F.col("_before") + F.row_number().over(inside)).drop("_range", "_before")


def running_sums(df: DataFrame, keys: Sequence[str], order: Sequence[str], sums: dict[str, Column]) -> DataFrame:
    """``df`` with a running sum (the row's own value included) per name of ``sums``, per ``keys`` in ``order``, which must
    be unique inside a key. Rows are placed as in :func:`prefix_row_number`; the values must not be null."""
    named = {f"_s{i}": c for i, c in enumerate(sums.values())}
    placed = cut_lineage(df.withColumns(named).repartitionByRange(*keys, *order).withColumn("_range", F.spark_partition_id()))
    totals = placed.groupBy(*keys, "_range").agg(*[F.sum(c).alias(c) for c in named])
    before = Window.partitionBy(*(keys or [F.lit(0)])).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    starts = totals.select(*keys, "_range", *[F.coalesce(F.sum(c).over(before), F.lit(0)).alias(f"{c}b") for c in named])
    inside = Window.partitionBy(*keys, "_range").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    same = F.col("p._range") == F.col("c._range")
    for k in keys:
        same = same & F.col("p." + k).eqNullSafe(F.col("c." + k))
    joined = placed.alias("p").join(starts.alias("c"), same).select("p.*", *[f"c.{c}b" for c in named])
    out = {name: F.col(f"{c}b") + F.sum(c).over(inside) for name, c in zip(sums, named, strict=True)}
    return joined.withColumns(out).drop("_range", *named, *[f"{c}b" for c in named])


def number_in_ranges(df: DataFrame, keys: Sequence[str], order: Sequence[str], out: str) -> DataFrame:
    """:func:`prefix_row_number` for many rows of few keys, none of them null: a task numbers its sorted range as it writes it, so
    the rows move once and are joined with a row per key and range only. ``df`` is read twice."""
    sorted_rows = df.repartitionByRange(*keys, *order).sortWithinPartitions(*keys, *order)
    placed = cut_lineage(sorted_rows.withColumns({"_range": F.spark_partition_id(), "_at": F.monotonically_increasing_id()}))
    counts = placed.groupBy(*keys, "_range").agg(F.count(F.lit(1)).alias("_n"), F.min("_at").alias("_first"))
    before = Window.partitionBy(*(keys or [F.lit(0)])).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.withColumn("_before", F.coalesce(F.sum("_n").over(before), F.lit(0))).drop("_n")
    joined = placed.join(cut_lineage(starts), [*keys, "_range"])
    return joined.withColumn(out, F.col("_before") + F.col("_at") - F.col("_first") + 1).select(*df.columns, out)
