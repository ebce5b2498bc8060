"""Mixing sources to target weights by entropy balancing.

Every source gets a share of the wanted words by weight, but not more than ``cap`` times what it has; what is
over goes to the other sources by weight, until none is above its cap. Document rates (expected copies) are those
closest in relative entropy, per word, to one copy each under the constraint that every source takes its target:
rate = exp(lambda of the source). The convex dual sum_s (S_s exp(lambda_s) - t_s lambda_s) is solved by Newton steps
on the table of sources, S_s being summed over all documents. Rates become copies by rounding in words: the sizes of
a source are walked from the largest down, each takes the whole number of copies that comes nearest to its words and
what the larger ones have left open, so the small texts close the gap and the words taken differ from the target
by about half a small text. The copies of a size are spread evenly over its documents; none is taken more than
ceil(cap) times, and all documents of a size together not more than cap times.

Defined results: a null or blank text has size 0; a null source is a source of its own, last in order; a source
of no words has target 0 and rate 0; rows that are equal are rounded apart, with the same result as a set on
every run; an empty table gives an empty result; ``mix`` keeps the other columns of the input (its own, named
``size``, ``source_size``, ``target``, ``copies``, replace those of the same name).
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType

from tidings.llm import kernels
from tidings.session import cut_lineage

WEIGHTS = (5.0, 2.0, 1.0)
SHARE = 1.5  # words of the mix over words there are
CAP = 2.0
BLOCKS = 32  # parts of one size of one source that are numbered apart
NEWTON_STEPS = 8  # per job
TOLERANCE = 1e-12


@F.arrow_udf(LongType())
def word_count(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
    for arr in batches:
        yield pa.array(kernels.word_counts(arr), pa.int64())


def source_targets(sized: DataFrame, weights=WEIGHTS, share: float = SHARE, cap: float = CAP) -> DataFrame:
    """(source, source_size, target, rate): one row per source, as a stage table.

    ``sized`` has source and size. The order of the sources is one window over one small row per source.
    """
    order = Window.orderBy(F.col("source").isNull(), "source")
    turn = F.pmod(F.row_number().over(order) - 1, F.lit(len(weights)))
    sources = cut_lineage(sized.groupBy("source").agg(F.sum("size").alias("source_size")).select(
        "source", "source_size", F.element_at(F.array(*map(F.lit, weights)), (turn + 1).cast("int")).alias("weight"),
        (F.col("source_size") * F.lit(float(cap))).alias("cap")))
    wanted = share * float(sources.agg(F.sum("source_size")).first()[0] or 0)
    level = 0.0
    while True:  # water level: rises until the sources below their cap take what the others leave
        full = F.col("weight") * level >= F.col("cap")
        taken, free = sources.agg(F.sum(F.when(full, F.col("cap")).otherwise(0.0)), F.sum(F.when(full, 0.0).otherwise(F.col("weight")))).first()
        if not free:
            break
        new = (wanted - taken) / free
        if new <= level:
            break
        level = new
    return cut_lineage(_newton(sources.withColumn("target", F.least("cap", F.col("weight") * level))).select(
        "source", "source_size", "target", "rate"))


def _newton(sources: DataFrame) -> DataFrame:
    """Newton iterations on the dual, one lambda per source; rate = exp(lambda)."""
    some = (F.col("source_size") > 0) & (F.col("target") > 0)
    state = sources.withColumn("lam", F.lit(0.0))
    left = math.inf
    while left > TOLERANCE:
        for _ in range(NEWTON_STEPS):
            filled = F.col("source_size") * F.exp("lam")
            state = state.withColumn("lam", F.when(some, F.col("lam") + F.least(F.lit(1.0), (F.col("target") - filled) / filled)).otherwise(0.0))
        state = cut_lineage(state)
        gap = F.abs(F.col("source_size") * F.exp("lam") / F.col("target") - 1)
        now = state.agg(F.max(F.when(some, gap).otherwise(0.0))).first()[0] or 0.0
        if now >= left:  # no closer: as exact as doubles go
            break
        left = now
    return state.withColumn("rate", F.when(some, F.exp("lam")).otherwise(0.0))


def mix(df: DataFrame, key: str = "doc_id", source: str = "source", weights=WEIGHTS, share: float = SHARE, cap: float = CAP) -> DataFrame:
    """The rows of ``df`` (which has ``size``, see ``word_count``) with source_size, target and copies."""
    rows = df.drop("source_size", "target", "copies").withColumn(
        "_block", F.pmod(F.xxhash64(key, "size", F.lit("mix")), F.lit(BLOCKS)).cast("int"))
    sized = cut_lineage(rows.select(F.col(source).alias("source"), "size", "_block").groupBy("source", "size", "_block").agg(
        F.count(F.lit(1)).alias("n")))
    targets = source_targets(sized.select("source", (F.col("size") * F.col("n")).alias("size")), weights, share, cap)
    per_size = sized.groupBy("source", "size").agg(F.sum("n").alias("n")).join(
        targets.withColumnRenamed("source", "_t"), F.col("source").eqNullSafe(F.col("_t"))).drop("_t")
    kinds = {f.name: f.dataType.simpleString() for f in per_size.schema.fields}
    names = ("source", "size", "n", "source_size", "target")
    taken = cut_lineage(per_size.groupBy("source").applyInArrow(round_sizes(cap), ", ".join(f"{c} {kinds[c]}" for c in names) + ", taken long"))
    before = Window.partitionBy("source", "size").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    cells = sized.select("source", "size", "_block", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("_before")).alias("c").join(
        taken.alias("t"), F.col("c.source").eqNullSafe(F.col("t.source")) & (F.col("c.size") == F.col("t.size"))).select(
        F.col("c.source").alias("_s"), F.col("c.size").alias("_z"), F.col("_block").alias("_b"), "_before", F.col("n").alias("_n"), F.col("taken").alias("_k"),
        "source_size", "target")
    rank = F.row_number().over(Window.partitionBy(source, "size", "_block").orderBy(key)) + F.col("_before")
    joined = rows.join(cells, F.col(source).eqNullSafe(F.col("_s")) & (F.col("size") == F.col("_z")) & (F.col("_block") == F.col("_b")))
    joined = joined.withColumn("_rank", rank)
    copies = F.expr("(_k * _rank) div _n - (_k * (_rank - 1)) div _n")
    return joined.withColumn("copies", copies.cast("int")).drop("_s", "_z", "_b", "_block", "_before", "_n", "_k", "_rank")


def round_sizes(cap: float):
    """Arrow group mapper over the sizes of a source (at most as many rows as the longest text has words): copies of each."""

    def kernel(table: pa.Table) -> pa.Table:
        table = table.sort_by([("size", "descending")])
        rate, left, out = table.column("rate")[0].as_py(), 0.0, []
        for size, n in zip(table.column("size").to_pylist(), table.column("n").to_pylist(), strict=True):
            wanted = rate * size * n + left
            k = min(max(math.floor(wanted / size + 0.5), 0), math.floor(cap * n)) if size else 0
            left = wanted - size * k
            out.append(k)
        return table.select(["source", "size", "n", "source_size", "target"]).append_column("taken", pa.array(out, pa.int64()))

    return kernel
