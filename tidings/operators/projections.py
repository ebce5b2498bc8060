"""Approximate cosine pairs: banded signed random projections, verified by the exact dot product.

A random hyperplane separates two vectors at angle ``a`` with probability ``a / pi``. ``bits`` hyperplanes make a band's
key; two vectors are candidates when they agree in a whole band. With p = 1 - arccos(t) / pi a pair of cosine t or more
is missed by all bands with probability (1 - p^bits)^bands at most, so the caller's recall sets the number of
bands. Candidates are verified, so no pair below ``t`` comes out. The exact join
(:func:`tidings.operators.vectors.cosine_pairs`) is the default everywhere; this one is for callers that ask for it.

Candidates meet in one of two ways, whichever moves fewer vectors; both have the same candidates. By buckets: pairs are listed
in buckets of up to ``SMALL_BUCKET`` rows, and the rows of a larger bucket are compared in blocks, each block pair one task, so a
bucket of many near copies is never listed. By blocks, where many rows share few keys: every row goes to the block pairs of its
group once, with its vector, and a task finds the rows of two blocks that agree in a band. A vector then travels to
``COPIES`` blocks at most (while blocks fit a task) instead of once per band and candidate.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidings.operators.similarity import (
    DEFAULT_BLOCK_ROWS,
    _grouped,
    _self_join_rows,
    _sides,
    block_pair_join,
    dot,
    matrix,
    rows_of_block,
    unit_vector,
    whole_vectors,
)
from tidings.session import cut_lineage

MAX_BANDS = 128
SMALL_BUCKET = 64
PRODUCTS_AT_ONCE = 1 << 20  # of one bucket in a block pair


def plan_bands(t: float, recall: float, rows: int, bits: int | None = None) -> tuple[int, int]:
    """(bits, bands) for cosine ``t`` and at least ``recall``: about one row a bucket, but ``MAX_BANDS`` bands at most
    where fewer bits allow it."""
    if not (0.0 < recall < 1.0 and -1.0 < t <= 1.0):
        raise ValueError("recall lies in (0, 1), the cosine in (-1, 1]")
    p = 1.0 - np.arccos(min(t, 1.0)) / np.pi
    need = lambda r: 1 if p**r >= recall else int(np.ceil(np.log1p(-recall) / np.log1p(-(p**r))))
    if bits is None:
        bits = int(np.clip(np.ceil(np.log2(max(rows, 2))), 1, 32))
        while bits > 1 and need(bits) > MAX_BANDS:
            bits -= 1
    return bits, need(bits)


def _planes(dimensions: int, bits: int, bands: int, seed: int) -> np.ndarray:
    return np.random.default_rng(seed).standard_normal((dimensions, bits * bands))


def _keys(v: np.ndarray, planes: np.ndarray, bits: int, bands: int) -> np.ndarray:
    """Key of every vector in every band."""
    key = np.empty((len(v), bands), dtype=np.int64)
    for at in range(0, len(v), 4096):
        key[at: at + 4096] = (v[at: at + 4096] @ planes > 0).reshape(-1, bands, bits) @ (1 << np.arange(bits, dtype=np.int64))
    return key


def _signatures(bits: int, bands: int, seed: int):
    """Arrow mapper: a row per band of every vector, without the vector."""

    def run(batches):
        planes = None
        for batch in batches:
            if not batch.num_rows:
                continue
            v = matrix(batch.column("_v"))
            if planes is None:
                planes = _planes(v.shape[1], bits, bands, seed)
            for at in range(0, len(v), 4096):
                key = _keys(v[at: at + 4096], planes, bits, bands)
                own = batch.slice(at, len(key)).drop_columns(["_v"]).take(pa.array(np.repeat(np.arange(len(key)), bands)))
                own = own.append_column("_band", pa.array(np.tile(np.arange(bands, dtype=np.int32), len(key))))
                yield own.append_column("_key", pa.array(key.ravel()))

    return run


def approx_cosine_pairs(vecs: DataFrame, t: float, *, recall: float = 0.95, bits: int | None = None, id_col: str = "id", vec_col: str = "embedding",
                        group_cols: Sequence[str] = (), block_rows: int = DEFAULT_BLOCK_ROWS, seed: int = 17) -> DataFrame:
    """Pairs ``a < b`` in the same group with cosine ``>= t``, each found with probability ``recall`` or more:
    ``group_cols, a, b, cos``. Rows of null and zero vectors have no pairs; reruns agree."""
    g = list(group_cols)
    base = whole_vectors(vecs.select(*g, id_col, unit_vector(vec_col).alias("_v")), "_v").filter("exists(_v, x -> x <> 0)")
    count = base.count()
    bits, bands = plan_bands(t, recall, count, bits)
    kept = [f for f in base.schema.fields if f.name != "_v"]
    schema = T.StructType([*kept, T.StructField("_band", T.IntegerType()), T.StructField("_key", T.LongType())])
    rows = base.mapInArrow(_signatures(bits, bands, seed), schema)
    bucket = [*g, "_band", "_key"]
    sizes = cut_lineage(rows.groupBy(*bucket).agg(F.count(F.lit(1)).alias("_n")).filter("_n > 1"))
    if count * -(-count // rows_of_block(count, block_rows)) <= _moved_by_buckets(sizes, block_rows):
        return pairs_by_blocks(base, t, bits, bands, id_col, g, block_rows, seed)
    return pairs_by_buckets(base, rows, sizes, t, id_col, g, block_rows)


def _moved_by_buckets(sizes: DataFrame, block_rows: int) -> int:
    """Vectors that :func:`pairs_by_buckets` moves: two for a listed pair, one for a row of a large bucket and a block that it meets."""
    n = F.col("_n").cast("double")
    return sizes.agg(F.coalesce(F.sum(F.when(n <= SMALL_BUCKET, n * (n - 1)).otherwise(n * F.ceil(n / block_rows))), F.lit(0.0))).first()[0]


def pairs_by_buckets(base: DataFrame, rows: DataFrame, sizes: DataFrame, t: float, id_col: str, g: list[str], block_rows: int) -> DataFrame:
    """Rows meet in the buckets of their bands. ``rows``: a row per band; ``sizes``: ``_n`` of the buckets of several rows."""
    bucket = [*g, "_band", "_key"]
    placed = cut_lineage(rows.join(sizes, bucket))
    small = placed.filter(F.col("_n") <= SMALL_BUCKET).drop("_n")
    listed = small.withColumnRenamed(id_col, "a").join(small.withColumnRenamed(id_col, "b"), bucket).filter("a < b").select(*g, "a", "b").distinct()
    named = lambda c, v: base.select(*g, F.col(id_col).alias(c), F.col("_v").alias(v))
    both = listed.join(named("a", "_va"), [*g, "a"]).join(named("b", "_vb"), [*g, "b"])
    found = both.select(*g, "a", "b", dot("_va", "_vb").alias("cos")).filter(F.col("cos") >= t)
    large = placed.filter(F.col("_n") > SMALL_BUCKET).drop("_n").join(base, [*g, id_col])
    inside = block_pair_join(large, id_col, "_v", t, group_cols=bucket, block_rows=block_rows, pivots=1)
    inside = inside.groupBy(*g, "a", "b").agg(F.first("score").alias("cos"))
    return found.union(inside).groupBy(*g, "a", "b").agg(F.max("cos").alias("cos"))


def pairs_by_blocks(base: DataFrame, t: float, bits: int, bands: int, id_col: str, g: list[str], block_rows: int, seed: int) -> DataFrame:
    """Rows meet in the block pairs of their group, and are compared where they agree in a band."""
    rows, keys = _self_join_rows(base, id_col, g, 0.0, block_rows, 1)
    types = {f.name: f.dataType.simpleString() for f in rows.schema.fields}

    def kernel(table: pa.Table) -> pa.Table:
        v, w, left, right, same = _sides(table)
        planes = _planes(v.shape[1], bits, bands, seed)
        r, c, score = banded_pairs(v, w, t, planes, bits, bands, same)
        one, two = (table.column(id_col).take(pa.array(side)) for side in (left[r], right[c]))
        swap, differ = pa.compute.greater(one, two), pa.compute.not_equal(one, two)
        out = {x: table.column(x).take(pa.array(left[r])) for x in g}
        out["a"], out["b"] = pa.compute.if_else(swap, two, one), pa.compute.if_else(swap, one, two)
        return pa.table({**out, "cos": pa.array(score)}).filter(differ)

    schema = ", ".join([*(f"`{x}` {types[x]}" for x in g), f"a {types[id_col]}", f"b {types[id_col]}", "cos double"])
    found = _grouped(rows, keys, kernel, schema)
    return found.groupBy(*g, "a", "b").agg(F.max("cos").alias("cos"))  # an id may come twice


def banded_pairs(a: np.ndarray, b: np.ndarray, t: float, planes: np.ndarray, bits: int, bands: int, same: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, column, cosine) of the pairs of two blocks that agree in a band and reach ``t`` (of one block with itself, row before
    column), each once: in the first band in which it agrees."""
    out = [(np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0))]
    if not len(a) or not len(b):
        return out[0]
    ka = _keys(a, planes, bits, bands)
    kb = ka if same else _keys(b, planes, bits, bands)
    for band in range(bands):
        at, bt = np.argsort(ka[:, band], kind="stable"), np.argsort(kb[:, band], kind="stable")
        left, right = ka[at, band], kb[bt, band]
        shared = np.intersect1d(left, right)
        bounds = [np.searchsorted(side, shared, how) for side in (left, right) for how in ("left", "right")]
        for a0, a1, b0, b1 in zip(*bounds, strict=True):
            if same and a1 - a0 == 1:
                continue
            step = max(PRODUCTS_AT_ONCE // (b1 - b0), 1)
            for first in range(b0, b1, PRODUCTS_AT_ONCE):
                columns = bt[first: min(first + PRODUCTS_AT_ONCE, b1)]
                other = b[columns].T
                for lo in range(a0, a1, step):
                    part = at[lo: min(lo + step, a1)]
                    cos = a[part] @ other
                    r, c = np.nonzero(cos >= t)
                    score = cos[r, c]
                    r, c = part[r], columns[c]
                    new = np.flatnonzero(r < c) if same else np.arange(len(r))
                    for some in np.array_split(new, len(new) // 65536 + 1):
                        some = some[~(ka[r[some], :band] == kb[c[some], :band]).any(1)]
                        out.append((r[some], c[some], score[some]))
    r, c, score = (np.concatenate(x) for x in zip(*out, strict=True))
    return r, c, score
