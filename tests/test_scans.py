"""Greedy scans by component, exact packing, running sums and hashed vectors against plain loops."""

import hashlib
import random
import re
from collections import Counter

import numpy as np
import pytest

from tidings.operators.greedy import connected_components, greedy_keep_first
from tidings.operators.hashing import embed_hashed
from tidings.operators.packing import pack_batches_exact
from tidings.operators.ranking import running_sums


def scan(edges):
    """Dropped (group, node) by the plain loop."""
    gone = set()
    for g, b in sorted({(g, b) for g, _, b in edges}, key=lambda x: x[1]):
        if any((g, a) not in gone for h, a, c in edges if (h, c) == (g, b)):
            gone.add((g, b))
    return gone


@pytest.mark.parametrize("task_edges", [1, 40, 10**6])
def test_scan_equals_loop(spark, task_edges):
    rng = random.Random(4)
    edges = {(g, a, a + d) for g in "xy" for _ in range(150) for a in [rng.randrange(200)] for d in [rng.randrange(1, 12)]}
    edges |= {("x", 1000 + i, 1001 + i) for i in range(60)} | {("y", 2000, 2001 + i) for i in range(50)}
    df = spark.createDataFrame(sorted(edges), "grp string, early long, late long")
    got = [tuple(r) for r in greedy_keep_first(df, ["grp"], task_edges=task_edges).collect()]
    assert set(got) == scan(edges) and len(got) == len(set(got))
    assert greedy_keep_first(df.filter("early < 0"), ["grp"], task_edges=task_edges).count() == 0


def test_long_chain_is_one_scan(spark):
    n = 20_000
    names = [f"{hashlib.md5(str(i).encode()).hexdigest()}" for i in range(n + 1)]  # keys say nothing of the order
    df = spark.createDataFrame([(names[i], names[i + 1]) for i in range(n)], "early string, late string")
    assert {r.node for r in greedy_keep_first(df).collect()} == set(names[1::2])


def pack(tokens, budget):
    out, no, used = [], 0, None
    for t in tokens:
        if used is not None and used + t > budget:
            no, used = no + 1, None
        used = (used or 0) + t
        out.append(no)
    return out


def test_packing_equals_loop(spark):
    rng = random.Random(9)
    groups = {"hot": [rng.choice([0, 1, 5, 30, 99, 100, 101, 500]) for _ in range(700)], "one": [7], "big": [200] * 9, "none": [0] * 20, None: [50, 50, 1, 99]}
    rows = [(g, i, t) for g, ts in groups.items() for i, t in enumerate(ts)]
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, "source string, id long, tokens int").repartition(7)
    got = {(r.source, r.id): r.batch_no for r in pack_batches_exact(df, 100).collect()}
    assert got == {(g, i): no for g, ts in groups.items() for i, no in enumerate(pack(ts, 100))}
    whole = {r.id: r.batch_no for r in pack_batches_exact(df.filter("source = 'hot'"), 100, group_cols=[]).collect()}
    assert [whole[i] for i in range(700)] == pack(groups["hot"], 100)
    assert pack_batches_exact(df.filter("id < 0"), 100).count() == 0


def test_running_sums(spark):
    from pyspark.sql import functions as F

    rng = random.Random(1)
    rows = [(rng.choice(["a", None]), i, rng.randrange(10)) for i in range(300)]
    got = running_sums(spark.createDataFrame(rows, "k string, i long, v long"), ["k"], ["i"], {"s": F.col("v"), "n": F.lit(1)}).collect()
    for k in ("a", None):
        own = sorted((r.i, r.v, r.s, r.n) for r in got if r.k == k)
        assert [x[2] for x in own] == np.cumsum([x[1] for x in own]).tolist() and [x[3] for x in own] == list(range(1, len(own) + 1))


def test_hashed_vectors(spark):
    texts = {1: "The cat, the CAT!", 2: None, 3: "", 4: "naïve 漢字 x_1", 5: "the cat the cat", 6: "word " * 30000}
    df = spark.createDataFrame(list(texts.items()), "id long, text string")
    got = {r.id: np.array(r.embedding) for r in embed_hashed(df, 16).collect()}
    assert set(got) == set(texts)
    for i, t in texts.items():
        v = np.zeros(16)
        for w, n in Counter(re.findall(r"\w+", (t or "").lower())).items():
            h = hashlib.md5(w.encode()).hexdigest()
            v[int(h[:8], 16) % 16] += n if h[8] < "8" else -n
        norm = np.linalg.norm(v)
        assert np.allclose(got[i], v / norm if norm else v)


@pytest.mark.parametrize("task_edges", [0, 10**6])
def test_components_equal_search(spark, task_edges):
    rng = random.Random(2)
    for keys in (range(120), [f"k{rng.randrange(10**6)}é" for _ in range(120)]):
        keys = list(keys)
        edges = [(g, rng.choice(keys), rng.choice(keys)) for g in ("a", "b") for _ in range(70)]
        near = {(g, k): {k} for g in "ab" for k in keys}
        for g, x, y in edges:
            both = near[g, x] | near[g, y]
            for k in both:
                near[g, k] = both
        kind = "long" if isinstance(keys[0], int) else "string"
        e = spark.createDataFrame(edges, f"grp string, src {kind}, dst {kind}")
        n = spark.createDataFrame([(g, k) for g in "ab" for k in keys], f"grp string, node {kind}")
        got = {(r.grp, r.node): r.comp for r in connected_components(e, n, ["grp"], task_edges=task_edges).collect()}
        assert got == {k: min(v) for k, v in near.items()}


def test_greedy_rounds_before_components_equal_the_scan(spark):
    """Dense components are thinned by rounds; what is left is scanned, and the result is that of one scan."""
    rng = random.Random(8)
    edges = sorted({(a, b) for a, b in ((rng.randrange(120), rng.randrange(120)) for _ in range(1500)) if a < b})
    want, near = set(), {}
    for a, b in edges:
        near.setdefault(b, []).append(a)
    for b in sorted(near):
        if any(a not in want for a in near[b]):
            want.add(b)
    df = spark.createDataFrame(edges, "early long, late long")
    assert sorted(r.node for r in greedy_keep_first(df, task_edges=30).collect()) == sorted(want)
