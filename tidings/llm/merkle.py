"""Merkle manifest of a table: grouped hash trees with nested-interval labels, inclusion proofs and their check.

A leaf is the digest of a row's fields. Per group the leaves are ranked by key; a node covers the interval
``[lo, hi]`` of leaf ranks, and a run of ``fanout`` neighbours has one parent, whose interval holds theirs. The
groups' roots are the leaves of one more tree.

Trees grow level by level, one grouped aggregation over runs of at most ``fanout`` rows each. Ancestors are
attached from the top: a node joins the node of the next level that contains its interval. Intervals of a level
never cross the borders of buckets as wide as the level's runs, so the containment join is an equality on
(tree, bucket) with the interval test as remainder, and a bucket holds one parent. The siblings of a node are its
parent's children whose intervals lie before or after its own. A path of (left siblings, right siblings) is
handed down with the ancestors, so the leaves join once, with an eighth of their number of rows.

Defined results: a null field is written ``-``; a null key comes before all others, a null group before all
others; rows of equal key are ordered by digest, so equal rows have equal proofs or the places are theirs in any
order; a lone leaf is its group's root, a lone group's root is the root; an empty table gives an empty result;
other columns are left out and may have any name.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidings.operators.ranking import prefix_row_number
from tidings.session import cut_lineage

FANOUT = 8
_NO_PATH = "cast(array() as array<struct<l: string, r: string>>)"


def digest_of(fields: Sequence[Column]) -> Column:
    """Lowercase hex sha256 of the fields, each ``-`` if null, else its byte count, ``:`` and its text."""
    texts = [f.cast("string") for f in fields]
    return F.sha2(F.concat(*[F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in texts]), 256)


def joined(digests: Column) -> Column:
    return F.array_join(digests, "")


def ranked_leaves(rows: DataFrame) -> DataFrame:
    """(tree, n, lo, hi, digest, ...) from (g, k, digest, ...): rank from 0 in the group and number of the group.

    Rows are range-partitioned by (group, key, digest), so a hot group spreads over many partitions, and numbered by
    partition counts; a running number splits equal rows.
    """
    order = ["g", "k", "digest", "_row"]
    placed = cut_lineage(rows.withColumn("_row", F.monotonically_increasing_id()).repartitionByRange(*order)
                         .withColumn("_range", F.spark_partition_id()))
    counts = cut_lineage(placed.groupBy("g", "_range").agg(F.count(F.lit(1)).alias("_c")))
    groups = prefix_row_number(counts.groupBy("g").agg(F.sum("_c").alias("n")), [], ["g"], "_at")
    groups = groups.select("g", "n", (F.col("_at") - 1).alias("tree"))
    earlier = Window.partitionBy("g").orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.withColumn("_before", F.coalesce(F.sum("_c").over(earlier), F.lit(0)))
    starts = starts.alias("s").join(groups.alias("t"), F.col("s.g").eqNullSafe(F.col("t.g"))).select("s.g", "s._range", "s._before", "t.n", "t.tree")
    inside = Window.partitionBy("tree", "_range").orderBy(*order)
    at = placed.alias("p").join(starts.alias("s"), F.col("p.g").eqNullSafe(F.col("s.g")) & (F.col("p._range") == F.col("s._range")))
    at = at.select("p.*", "s._before", "s.n", "s.tree").withColumn("lo", F.col("_before") + F.row_number().over(inside) - 1)
    return at.withColumn("hi", F.col("lo")).drop("_row", "_range", "_before")


def grow(leaves: DataFrame, fanout: int = FANOUT) -> list[DataFrame]:
    """Node tables by level from (tree, n, lo, hi, digest): level 0 are the leaves, a later one has ``kids`` too.

    A tree of n leaves ends at the first level where one node is left, which is its root.
    """
    levels, width = [leaves], 1
    largest = leaves.agg(F.max("n")).first()[0] or 0
    while width < largest:
        runs = levels[-1].filter(F.col("n") > width).groupBy("tree", "n", F.expr(f"lo div {width * fanout}").alias("_run"))
        nodes = runs.agg(F.min("lo").alias("lo"), F.max("hi").alias("hi"), F.array_sort(F.collect_list(F.struct("lo", "hi", "digest"))).alias("kids"))
        levels.append(cut_lineage(nodes.select("tree", "n", "lo", "hi", F.sha2(joined(F.col("kids.digest")), 256).alias("digest"), "kids")))
        width *= fanout
    return levels


def attach(nodes: DataFrame, parents: DataFrame, width: int) -> DataFrame:
    """``nodes`` with the path, subroot and root of their parents, the nodes of the next level (runs of ``width`` leaves)."""
    bucket = lambda side: F.expr(f"{side}.lo div {width}")
    inside = (F.col("p.lo") <= F.col("c.lo")) & (F.col("c.hi") <= F.col("p.hi"))
    both = nodes.alias("c").join(parents.alias("p"), (F.col("c.tree") == F.col("p.tree")) & (bucket("c") == bucket("p")) & inside)
    before = F.filter(F.col("p.kids"), lambda x: x["hi"] < F.col("c.lo"))
    after = F.filter(F.col("p.kids"), lambda x: x["lo"] > F.col("c.hi"))
    step = F.struct(joined(F.transform(before, lambda x: x["digest"])).alias("l"), joined(F.transform(after, lambda x: x["digest"])).alias("r"))
    return both.select("c.*", F.concat(F.array(step), F.col("p.path")).alias("path"), "p.subroot", "p.root")


def descend(levels: list[DataFrame], tops: DataFrame, fanout: int = FANOUT) -> DataFrame:
    """The leaves with path (level by level upwards), subroot and root; ``tops`` has (tree, path, root) of the trees' roots."""
    above = tops.select(F.col("tree").alias("_t"), "path", "root")
    held = None
    for k in range(len(levels) - 1, -1, -1):
        width = fanout**k
        ends = levels[k].filter(F.col("n") <= width) if k else levels[0].filter("n = 1")
        done = ends.join(above, F.col("tree") == F.col("_t")).drop("_t")
        done = done.select(*levels[k].columns, "path", F.col("digest").alias("subroot"), "root")
        held = done if held is None else done.unionByName(attach(levels[k].filter(F.col("n") > width), held, width * fanout))
    return held


def manifest(df: DataFrame, key: str, fields: Sequence[Column], group: str, extra: dict[str, Column] | None = None,
             fanout: int = FANOUT) -> DataFrame:
    """key, leaf, subroot, root, path and the ``extra`` columns (computed from ``df``) of every row.

    ``path`` lists, from the leaf to the root, the digests joined left and right of the row's own.
    """
    extra = extra or {}
    rows = df.select(F.col(group).cast("string").alias("g"), F.col(key).alias("k"), digest_of(fields).alias("digest"),
                     *[c.alias(f"x{i}") for i, c in enumerate(extra.values())])
    leaves = cut_lineage(ranked_leaves(rows).drop("g"))
    levels = grow(leaves, fanout)
    subroots = _roots(levels, fanout)
    over = grow(subroots, fanout)
    top = _roots(over, fanout).select(F.lit(0).cast("long").alias("tree"), F.expr(_NO_PATH).alias("path"), F.col("digest").alias("root"))
    paths = descend(over, top, fanout).select(F.col("lo").alias("tree"), "path", "root")
    held = descend(levels, cut_lineage(paths), fanout)
    return held.select(F.col("k").alias(key), F.col("digest").alias("leaf"), "subroot", "root", "path",
                       *[F.col(f"x{i}").alias(name) for i, name in enumerate(extra)])


def _roots(levels: list[DataFrame], fanout: int) -> DataFrame:
    """The roots of the trees of ``levels`` as leaves of one tree, in the order of the trees' numbers."""
    ends = None
    for k, nodes in enumerate(levels):
        low = fanout ** (k - 1) if k else 0
        here = nodes.filter((F.col("n") > low) & (F.col("n") <= fanout**k)).select("tree", "digest")
        ends = here if ends is None else ends.union(here)
    ends = cut_lineage(ends)
    n = ends.count()
    return ends.select(F.lit(0).cast("long").alias("tree"), F.lit(n).cast("long").alias("n"), F.col("tree").alias("lo"), F.col("tree").alias("hi"), "digest")


def folded(leaf: Column, path: Column) -> Column:
    """The root that ``leaf`` and the siblings of ``path`` lead to."""
    return F.aggregate(path, leaf, lambda acc, s: F.sha2(F.concat(s["l"], acc, s["r"]), 256))


def proof_digest(path: Column) -> Column:
    """Digest of all siblings, level by level upwards, left to right."""
    return F.sha2(joined(F.transform(path, lambda s: F.concat(s["l"], s["r"]))), 256)
