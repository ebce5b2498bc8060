"""Token-budget batches of a group of any size, without a shard key.

A batch opened at row i ends before the first later row with which its sum would exceed the budget. With prefix sums that
row is found by sorting the rows' ends among the batches' limits, so every row gets a pointer to the start that would
follow if it were a start itself. The starts are what the pointers reach from the first row: they are marked by
doubling (after k steps the first ``2^k`` starts are known), and a running count of the marks numbers the batches.
Rows are range-partitioned throughout, so no task holds a group; the number of steps is the logarithm of the
number of batches.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidings.operators.ranking import running_sums
from tidings.session import checkpoint_round, cut_lineage


def pack_batches_exact(items: DataFrame, budget: int, *, group_cols: Sequence[str] = ("source",), order_col: str = "id",
                       tokens_col: str = "tokens") -> DataFrame:
    """``items`` with ``batch_no`` (int, from 0): in order within each group a new batch opens when the running sum would
    exceed ``budget``; a batch takes its first row in any case. Rows of equal order keep the table's order; null
    or negative tokens count as 0."""
    g = list(group_cols)
    rows = cut_lineage(items.withColumn("_row", F.monotonically_increasing_id()))
    size = F.greatest(F.coalesce(F.col(tokens_col).cast("long"), F.lit(0).cast("long")), F.lit(0).cast("long"))
    key = [F.struct(*[F.col(c) for c in g]).alias("_g")] if g else [F.lit(0).alias("_g")]
    slim = running_sums(rows.select(*key, F.col(order_col).alias("_o"), "_row", size.alias("_size")), ["_g"], ["_o", "_row"],
                        {"i": F.lit(1).cast("long"), "end": F.col("_size")})
    slim = cut_lineage(slim.select("_g", "_row", "i", "end", (F.col("end") - F.col("_size") + F.lit(budget)).alias("limit")))
    # ends up to a batch's limit, counted over both kinds in one order
    both = slim.select("_g", F.col("end").alias("at"), F.lit(0).alias("kind"), "i").union(slim.select("_g", "limit", F.lit(1), "i"))
    counted = running_sums(both, ["_g"], ["at", "kind", "i"], {"fit": F.when(F.col("kind") == 0, 1).otherwise(0).cast("long")})
    jump = checkpoint_round(counted.filter("kind = 1").select("_g", "i", (F.greatest("fit", "i") + 1).alias("next")))
    last = slim.groupBy("_g").agg(F.max("i").alias("n"))
    jump = checkpoint_round(jump.join(last, "_g").filter("next <= n").select("_g", "i", "next"))
    starts = checkpoint_round(last.select("_g", F.lit(1).cast("long").alias("i")))
    while True:
        more = checkpoint_round(starts.join(jump, ["_g", "i"]).select("_g", F.col("next").alias("i")))
        if more.isEmpty():
            break
        starts = checkpoint_round(starts.union(more))
        jump = checkpoint_round(jump.join(jump.select("_g", F.col("i").alias("next"), F.col("next").alias("_far")), ["_g", "next"])
                                .select("_g", "i", F.col("_far").alias("next")))
    marked = slim.select("_g", "_row", "i").join(starts.withColumn("_mark", F.lit(1).cast("long")), ["_g", "i"], "left")
    numbered = running_sums(marked.withColumn("_mark", F.coalesce("_mark", F.lit(0).cast("long"))), ["_g"], ["i"], {"_no": F.col("_mark")})
    numbered = numbered.select("_row", (F.col("_no") - 1).cast("int").alias("batch_no"))
    return rows.join(numbered, "_row").drop("_row")
