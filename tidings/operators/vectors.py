"""Vector operators: pairwise cosine, greedy near-dup, centroids, centroid top-k, medoids, bundles."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidings.operators.greedy import greedy_keep_first
from tidings.operators.ranking import prefix_row_number
from tidings.operators.similarity import DEFAULT_BLOCK_ROWS, block_pair_join, dot, rows_near, unit_vector
from tidings.session import cut_lineage, release

# Defaults of the run configuration, for callers that want its cuts.
NEAR_DUP_THRESHOLD = 0.92
INITIAL_TOPK = 1000
MAX_CANDIDATES = 300
# Near-duplicate scan: rows of a group that are listed in pairs at first, and how the next slices grow.
SLICE_ROWS = 1 << 12
SLICE_GROWTH = 4


def cosine_pairs(vecs: DataFrame, t: float, *, id_col: str = "id", vec_col: str = "embedding",
                 group_cols: Sequence[str] = (), block_rows: int = DEFAULT_BLOCK_ROWS) -> DataFrame:
    """Pairs ``a < b`` in the same group with cosine ``>= t``: ``group_cols, a, b, cos``."""
    unit = vecs.select(*group_cols, id_col, unit_vector(vec_col).alias("_u"))
    return block_pair_join(unit, id_col, "_u", t, metric="cos", group_cols=group_cols,
                           block_rows=block_rows).withColumnRenamed("score", "cos")


def near_dup_keep(items: DataFrame, pairs: DataFrame, *, id_col: str = "id", order_col: str | None = None,
                  group_cols: Sequence[str] = ()) -> DataFrame:
    """Rows of ``items`` kept by the greedy, keep-first, in-order near-duplicate scan.

    ``pairs`` holds ``a``, ``b`` (ids) of every similar pair in the group. ``order_col`` is the input
    order (defaults to the id); ties break on the id.
    """
    g = list(group_cols)
    order_col = order_col or id_col
    if order_col == id_col:  # a pair is in order already
        dropped = greedy_keep_first(pairs.select(*g, F.col("a").alias("early"), F.col("b").alias("late")), g).withColumnRenamed("node", id_col)
        return items.join(dropped, g + [id_col], "left_anti")
    pos = items.select(*g, F.col(id_col).alias("_id"), F.struct(F.col(order_col), F.col(id_col)).alias("_o"))
    e = (
        pairs.select(*g, "a", "b")
        .join(pos.withColumnRenamed("_id", "a").withColumnRenamed("_o", "_oa"), g + ["a"])
        .join(pos.withColumnRenamed("_id", "b").withColumnRenamed("_o", "_ob"), g + ["b"])
        .select(
            *g,
            F.when(F.col("_oa") < F.col("_ob"), F.col("a")).otherwise(F.col("b")).alias("early"),
            F.when(F.col("_oa") < F.col("_ob"), F.col("b")).otherwise(F.col("a")).alias("late"),
        )
    )
    dropped = greedy_keep_first(e, g).withColumnRenamed("node", id_col)
    return items.join(dropped, g + [id_col], "left_anti")


def near_duplicates(items: DataFrame, t: float, *, id_col: str = "id", vec_col: str = "embedding", order_col: str | None = None,
                    group_cols: Sequence[str] = ()) -> DataFrame:
    """Rows of ``items`` kept by the near-duplicate scan at cosine ``t``, exact copies first.

    A copy of an earlier vector is always dropped (whatever drops or keeps the first one also meets the copy), so
    only the first row of equal vectors is compared; a group of m copies costs m rows, not m²/2 pairs. Zero
    vectors are similar to nothing and stay. Groups of more than ``SLICE_ROWS`` rows are scanned by slices
    (:func:`_keep_by_slices`).
    """
    g = list(group_cols)
    order_col = order_col or id_col
    v = F.col(vec_col).cast("array<double>")
    key = F.when(F.exists(v, lambda x: x != 0), v)
    place = F.struct(F.col(order_col).alias("o"), F.col(id_col).alias("i"))
    first = items.filter(key.isNotNull()).groupBy(*g, key.alias("_key")).agg(F.min(place).alias("_first"))
    firsts = first.select(*g, F.col("_first.i").alias(id_col))
    alone = items.filter(key.isNull())
    reps = cut_lineage(items.join(firsts, g + [id_col], "left_semi").unionByName(alone))
    largest = reps.groupBy(*g).agg(F.count(F.lit(1)).alias("n")).agg(F.coalesce(F.max("n"), F.lit(0))).first()[0]
    if largest > SLICE_ROWS:
        return _keep_by_slices(reps, t, largest, id_col, vec_col, order_col, g)
    return near_dup_keep(reps, cosine_pairs(reps, t, id_col=id_col, vec_col=vec_col, group_cols=g), id_col=id_col,
                         order_col=order_col, group_cols=g)


def _keep_by_slices(rows: DataFrame, t: float, largest: int, id_col: str, vec_col: str, order_col: str, g: list[str]) -> DataFrame:
    """The near-duplicate scan of large groups, by slices of the order that grow ``SLICE_GROWTH`` times.

    A slice is scanned whole; what it keeps is kept, and drops its neighbours from all later slices. So pairs are listed only
    among rows of a slice that no earlier slice drops: where a share of all pairs is similar, that is few of them.
    """
    named = {"id_col": id_col, "vec_col": vec_col, "group_cols": g}
    left = cut_lineage(prefix_row_number(rows, g, list(dict.fromkeys([order_col, id_col])), "_place"))
    end, kept = SLICE_ROWS, []
    while True:
        part = left.filter(F.col("_place") <= end)
        kept.append(cut_lineage(near_dup_keep(part, cosine_pairs(part, t, **named), id_col=id_col, order_col=order_col, group_cols=g).drop("_place")))
        if end >= largest:
            return reduce(DataFrame.unionByName, kept)
        rest = left.filter(F.col("_place") > end)
        unit = (x.select(*g, id_col, unit_vector(vec_col).alias("_u")) for x in (rest, kept[-1]))
        near = rows_near(*unit, id_col, "_u", t, group_cols=g)
        before, left = left, cut_lineage(rest.join(near, [*g, id_col], "left_anti"))
        release(before)
        end *= SLICE_GROWTH


def centroids_long(vecs: DataFrame, *, key_cols: Sequence[str] = ("label",), vec_col: str = "embedding",
                   unit: bool = False) -> DataFrame:
    """Mean vector per key in long form ``key_cols, pos, value`` (partial aggregation before the shuffle)."""
    v = unit_vector(vec_col) if unit else F.col(vec_col).cast("array<double>")
    return (
        vecs.select(*key_cols, F.posexplode(v).alias("pos", "x"))
        .groupBy(*key_cols, "pos")
        .agg(F.avg("x").alias("value"))
    )


def centroids(vecs: DataFrame, *, key_cols: Sequence[str] = ("label",), vec_col: str = "embedding",
              unit: bool = False) -> DataFrame:
    """Mean vector per key as ``array<double>`` (one row per key; the array has the vectors' dimension)."""
    long = centroids_long(vecs, key_cols=key_cols, vec_col=vec_col, unit=unit)
    return long.groupBy(*key_cols).agg(
        F.transform(F.array_sort(F.collect_list(F.struct("pos", "value"))), lambda s: s["value"]).alias("centroid")
    )


def top_k_by_centroid(vecs: DataFrame, *, id_col: str = "id", key_cols: Sequence[str] = ("label",),
                      vec_col: str = "embedding", k: int | None = None, order_col: str | None = None) -> DataFrame:
    """Members ranked by cosine to their raw-mean centroid; all of them, or the first ``k`` when the caller says.

    Output: ``key_cols, id, sim, rank`` (rank 1 = closest; ties by order column then id). With ``k`` the ranking
    keeps k rows per key and task; without, ranks come from range partitions, so a hot key spreads.
    """
    order_col = order_col or id_col
    c = centroids(vecs, key_cols=key_cols, vec_col=vec_col)
    x = F.col(vec_col).cast("array<double>")
    nx = F.sqrt(dot(x, x))
    nc = F.sqrt(dot("centroid", "centroid"))
    # rounded so that exact ties break on the order column, not on float noise
    sim = F.when((nx > 0) & (nc > 0), dot(x, F.col("centroid")) / (nx * nc)).otherwise(F.lit(0.0))
    extra = [order_col] if order_col != id_col else []
    scored = vecs.join(c, list(key_cols)).select(*key_cols, id_col, *extra, sim.alias("sim"))
    if k is None:
        ranked = prefix_row_number(scored.withColumn("_far", -F.col("sim")), list(key_cols), ["_far", *extra, id_col], "rank")
    else:
        w = Window.partitionBy(*key_cols).orderBy(F.col("sim").desc(), F.col(order_col), F.col(id_col))
        ranked = scored.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k)
    return ranked.select(*key_cols, id_col, "sim", F.col("rank").cast("int").alias("rank"))


def medoids(vecs: DataFrame, *, id_col: str = "id", key_cols: Sequence[str] = ("label",),
            vec_col: str = "embedding", order_col: str | None = None) -> DataFrame:
    """Member with the highest mean cosine to all members (self included); the first in order wins a tie.

    Mean cosine of ``i`` is ``û_i · mean(û)``, so the operator is one aggregate and one join (linear),
    and the arg-max is a partial aggregate, never a whole group in one task. Ids and order values may be of any
    orderable type. Output: ``key_cols, id, score``.
    """
    order_col = order_col or id_col
    mu = centroids(vecs, key_cols=key_cols, vec_col=vec_col, unit=True)
    # rounded to 1e-9 so that equal members tie
    scored = vecs.join(mu, list(key_cols)).select(
        *key_cols, F.struct((-F.round(dot(unit_vector(vec_col), "centroid"), 9)).alias("s"), F.col(order_col).alias("o"),
                            F.col(id_col).alias("i")).alias("m"))
    best = scored.groupBy(*key_cols).agg(F.min("m").alias("m"))
    return best.select(*key_cols, F.col("m.i").alias(id_col), (-F.col("m.s")).alias("score"))


def build_bundles(ranked: DataFrame, *, key_col: str = "label", id_col: str = "id", rank_col: str = "rank",
                  order_col: str | None = None, group_cols: Sequence[str] = (), members: DataFrame | None = None) -> DataFrame:
    """One bundle per cluster, items in rank order; bundles ordered by size desc, then by the first
    appearance of the cluster: the smallest order value of all its ``members`` (default: of the ranked rows, which
    is the same where nothing was cut). Output adds ``bundle_pos`` and ``n_items``.
    """
    g = list(group_cols)
    order_col = order_col or id_col
    per = ranked.groupBy(*g, key_col).agg(F.count(F.lit(1)).alias("n_items"))
    first = (ranked if members is None else members).groupBy(*g, key_col).agg(F.min(order_col).alias("_first"))
    per = per.join(first, g + [key_col]).withColumn("_size", -F.col("n_items"))
    per = prefix_row_number(per, g, ["_size", "_first", key_col], "bundle_pos").drop("_size", "_first")
    return ranked.join(per.withColumn("bundle_pos", F.col("bundle_pos").cast("int")), g + [key_col])
