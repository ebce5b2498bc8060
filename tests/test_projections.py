import numpy as np
import pytest

from tidings.operators import projections
from tidings.operators.projections import approx_cosine_pairs, plan_bands


def vectors(seed, n=400, d=24):
    rng = np.random.default_rng(seed)
    base = rng.normal(size=(30, d))
    v = base[rng.integers(0, 30, n)] + rng.normal(scale=0.35, size=(n, d))
    return v / np.linalg.norm(v, axis=1, keepdims=True)


def frame(spark, v, group=None):
    return spark.createDataFrame([(str(i % group) if group else "g", i, x.tolist()) for i, x in enumerate(v)], "grp string, id long, embedding array<double>")


def exact(v, t, group=1):
    c = v @ v.T
    return {(i, j) for i in range(len(v)) for j in range(i + 1, len(v)) if c[i, j] >= t and i % group == j % group}


@pytest.mark.parametrize(("t", "recall"), [(0.9, 0.95), (0.75, 0.9), (0.9, 0.5)])
def test_recall_and_no_wrong_pairs(spark, t, recall):
    v = vectors(3)
    want = exact(v, t)
    got = [(r.a, r.b) for r in approx_cosine_pairs(frame(spark, v), t, recall=recall).collect()]
    assert len(got) == len(set(got)) and set(got) <= want and len(want) > 50
    assert len(got) >= recall * len(want)


def test_large_buckets_are_compared_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(projections, "SMALL_BUCKET", 3)
    v = vectors(4, 200)
    v[50:120] = v[50]
    want = exact(v, 0.95, 2)
    got = {(r.grp, r.a, r.b) for r in approx_cosine_pairs(frame(spark, v, 2), 0.95, recall=0.999, group_cols=["grp"], block_rows=16).collect()}
    assert got <= {(str(a % 2), a, b) for a, b in want} and len(got) >= 0.99 * len(want)


def test_null_and_zero_vectors_and_empty_tables(spark):
    rows = [(1, [1.0, 0.0]), (2, None), (3, [0.0, 0.0]), (4, [2.0, 0.0]), (5, [None, 1.0])]
    df = spark.createDataFrame(rows, "id long, embedding array<double>")
    assert [(r.a, r.b) for r in approx_cosine_pairs(df, 0.9).collect()] == [(1, 4)]
    assert approx_cosine_pairs(df.filter("id > 9"), 0.9).count() == 0


def test_bands_keep_the_bound():
    for t in (0.2, 0.5, 0.92, 1.0):
        for recall in (0.5, 0.9, 0.999):
            for n in (10, 10**4, 10**8):
                bits, bands = plan_bands(t, recall, n)
                p = 1 - np.arccos(t) / np.pi
                assert 1 - (1 - p**bits) ** bands >= recall - 1e-12


def test_vectors_travel_once_a_block_where_buckets_are_large(spark, monkeypatch):
    """The default bits at a low cosine make few keys; the vectors went to a bucket of every band, and to every listed pair."""
    monkeypatch.setattr(projections, "SMALL_BUCKET", 3)
    v = vectors(5, 300)
    asked = {}
    blocks = projections.pairs_by_blocks
    monkeypatch.setattr(projections, "pairs_by_blocks", lambda *a: asked.setdefault("pairs", blocks(*a)))
    monkeypatch.setattr(projections, "pairs_by_buckets", lambda *a: pytest.fail("by buckets"))
    got = [(r.a, r.b) for r in approx_cosine_pairs(frame(spark, v), 0.4, block_rows=16).collect()]
    want = exact(v, 0.4)
    assert "pairs" in asked and len(got) == len(set(got)) and set(got) <= want and len(got) >= 0.95 * len(want) > 50


def test_both_ways_meet_the_same_candidates(spark, monkeypatch):
    v = vectors(6, 240)
    v[200:] = v[0]
    df = frame(spark, v, 2).withColumnRenamed("embedding", "_v")
    bits, bands, g = 3, 2, ["grp"]
    rows = df.mapInArrow(projections._signatures(bits, bands, 17), "grp string, id long, _band int, _key long")
    sizes = rows.groupBy("grp", "_band", "_key").count().withColumnRenamed("count", "_n").filter("_n > 1")
    for small in (2, 1000):
        monkeypatch.setattr(projections, "SMALL_BUCKET", small)
        buckets = projections.pairs_by_buckets(df, rows, sizes, 0.5, "id", g, 16).collect()
        blocks = projections.pairs_by_blocks(df, 0.5, bits, bands, "id", g, 16, 17).collect()
        pairs = lambda found: sorted((r.grp, r.a, r.b, round(r.cos, 9)) for r in found)
        assert pairs(buckets) == pairs(blocks)
        assert 100 < len(blocks) < len(exact(v, 0.5, 2))


def test_few_shared_keys_stay_in_buckets(spark, monkeypatch):
    monkeypatch.setattr(projections, "pairs_by_blocks", lambda *a: pytest.fail("by blocks"))
    v = np.random.default_rng(7).normal(size=(400, 24))
    assert approx_cosine_pairs(frame(spark, v / np.linalg.norm(v, axis=1, keepdims=True)), 0.99, bits=12, block_rows=4).count() == 0
