"""Density clustering over vectors (euclidean), noise label -1.

Flat cut at ``eps`` (DBSCAN*): a core point has at least ``min_size`` points, itself included, within
``eps``; clusters are the connected components of core points joined by ``eps`` edges; components of
fewer than ``min_size`` core points and every non-core point get -1. Labels are numbered 0.. in the
order of each cluster's smallest id. The hierarchy over all ``eps`` is :mod:`tidings.operators.hierarchy`.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidings.operators.greedy import connected_components
from tidings.operators.ranking import prefix_row_number
from tidings.operators.similarity import DEFAULT_BLOCK_ROWS, block_pair_join, neighbour_counts, neighbour_forest
from tidings.session import checkpoint_round, cut_lineage


def neighbour_pairs(vecs: DataFrame, eps: float, *, id_col: str = "id", vec_col: str = "embedding",
                    group_cols: Sequence[str] = (), block_rows: int = DEFAULT_BLOCK_ROWS) -> DataFrame:
    """Pairs within ``eps`` with their distance (``a``, ``b``, ``score``), written once as a stage table."""
    return cut_lineage(block_pair_join(vecs, id_col, vec_col, eps, metric="euclid", group_cols=list(group_cols), block_rows=block_rows))


def density_cluster(vecs: DataFrame, eps: float, min_size: int = 3, *, id_col: str = "id",
                    vec_col: str = "embedding", group_cols: Sequence[str] = (),
                    block_rows: int = DEFAULT_BLOCK_ROWS, pairs: DataFrame | None = None) -> DataFrame:
    """``group_cols, id, label, is_core`` for every input row. ``pairs`` may hold the neighbour pairs of this
    ``eps`` or a larger one. Without, neighbours are counted and then joined block by block, and no pair is listed."""
    g = list(group_cols)
    if pairs is None:
        how = {"metric": "euclid", "group_cols": g, "block_rows": block_rows}
        deg = neighbour_counts(vecs, id_col, vec_col, eps, **how).withColumnsRenamed({id_col: "node", "n": "_d"})
        core = checkpoint_round(deg.filter(F.col("_d") + 1 >= min_size).select(*g, "node"))
        inner = vecs.select(*g, id_col, vec_col).join(core.withColumnRenamed("node", id_col), [*g, id_col], "left_semi")
        core_edges = neighbour_forest(inner, id_col, vec_col, eps, **how)
    else:
        pairs = pairs.filter(F.col("score") <= eps)
        ends = pairs.select(*g, F.col("a").alias("node")).union(pairs.select(*g, F.col("b").alias("node")))
        deg = ends.groupBy(*g, "node").agg(F.count(F.lit(1)).alias("_d"))
        core = checkpoint_round(deg.filter(F.col("_d") + 1 >= min_size).select(*g, "node"))
        core_edges = (
            pairs.join(core.withColumnRenamed("node", "a"), g + ["a"], "left_semi")
            .join(core.withColumnRenamed("node", "b"), g + ["b"], "left_semi")
            .select(*g, F.col("a").alias("src"), F.col("b").alias("dst"))
        )
    comp = connected_components(core_edges, core, g)
    size = comp.groupBy(*g, "comp").agg(F.count(F.lit(1)).alias("_n"))
    big = size.filter(F.col("_n") >= min_size).select(*g, "comp")
    numbered = prefix_row_number(big, g, ["comp"], "_k").select(*g, "comp", (F.col("_k") - 1).cast("int").alias("label"))
    lab = comp.join(numbered, g + ["comp"]).select(*g, F.col("node").alias(id_col), "label")
    return (
        vecs.select(*g, id_col)
        .join(lab, g + [id_col], "left")
        .join(core.withColumnRenamed("node", id_col).withColumn("is_core", F.lit(True)), g + [id_col], "left")
        .select(*g, id_col, F.coalesce("label", F.lit(-1)).alias("label"),
                F.coalesce("is_core", F.lit(False)).alias("is_core"))
    )
