import math
import random

import numpy as np
from tidings.operators.cluster import density_cluster
from tidings.operators.vectors import cosine_pairs, medoids, near_dup_keep


def run_keep(spark, vecs, t, block_rows=2048):
    df = spark.createDataFrame([(i, [float(x) for x in v]) for i, v in enumerate(vecs)], "id long, embedding array<double>")
    pairs = cosine_pairs(df, t, block_rows=block_rows)
    kept = {r.id for r in near_dup_keep(df, pairs).collect()}
    return [i in kept for i in range(len(vecs))]


def test_chain_is_greedy_not_naive(spark):
    a = [(math.cos(math.radians(d)), math.sin(math.radians(d)), 0.0) for d in (0, 20, 40)]
    assert run_keep(spark, a, 0.92) == [True, False, True]


def cosines(vecs):
    u = np.array(vecs, dtype=float)
    u = u / np.maximum(np.linalg.norm(u, axis=1, keepdims=True), 1e-300)
    return u @ u.T


def test_kept_set_meets_its_definition(spark):
    """Kept rows are pairwise below the threshold; every dropped row has an earlier kept neighbour."""
    rng = np.random.default_rng(7)
    base = rng.normal(size=(12, 8))
    vecs = [base[rng.integers(0, 12)] + rng.normal(scale=0.3, size=8) for _ in range(120)]
    cos = cosines(vecs)
    for t in (0.8, 0.9):
        keep = run_keep(spark, vecs, t, block_rows=16)
        for j in range(len(vecs)):
            earlier = [i for i in range(j) if keep[i] and cos[i, j] >= t]
            assert keep[j] == (not earlier)


def test_pairs_equal_brute_force_for_any_cells(spark):
    from tidings.operators.similarity import block_pair_join

    rng = np.random.default_rng(2)
    base = rng.normal(size=(9, 6))
    vecs = [base[rng.integers(0, 9)] + rng.normal(scale=0.2, size=6) for _ in range(150)] + [np.zeros(6)] * 2
    vecs += vecs[:5]
    rows = [(i, [float(x) for x in v]) for i, v in enumerate(vecs)]
    df = spark.createDataFrame(rows, "id long, embedding array<double>")
    cos = cosines(vecs)
    gap = np.linalg.norm(np.array(vecs)[:, None] - np.array(vecs)[None], axis=-1)
    n = len(vecs)
    for t in (0.95, 0.5):
        want = {(i, j) for i in range(n) for j in range(i + 1, n) if cos[i, j] >= t}
        got = [(r.a, r.b) for r in cosine_pairs(df, t, block_rows=20).collect()]
        assert set(got) == want and len(got) == len(want)
    for pivots, block in ((1, 2048), (7, 2048), (7, 10), (400, 2048)):
        want = {(i, j) for i in range(n) for j in range(i + 1, n) if gap[i, j] <= 0.8}
        got = [(r.a, r.b) for r in block_pair_join(df, "id", "embedding", 0.8, metric="euclid", pivots=pivots, block_rows=block).collect()]
        assert set(got) == want and len(got) == len(want)


def test_work_is_never_above_all_pairs(spark):
    from tidings.operators.similarity import products_formed

    rng = np.random.default_rng(4)
    base = rng.normal(size=(40, 16))
    tight = base[rng.integers(0, 40, 2000)] + rng.normal(scale=0.05, size=(2000, 16))
    loose = rng.normal(size=(2000, 16))
    every = 2000**2 / 2
    for v, t, most in ((tight, 0.98, 0.35), (loose, 0.9, 0.6), (loose, 0.2, 1.08)):
        v = v / np.linalg.norm(v, axis=1, keepdims=True)
        df = spark.createDataFrame([(i, x.tolist()) for i, x in enumerate(v)], "id long, embedding array<double>")
        for pivots in (1, 8, 32, 125):
            assert products_formed(df, "id", "embedding", t, pivots=pivots).first().products <= most * every


def test_null_zero_and_equal_vectors(spark):
    from tidings.operators.vectors import near_duplicates

    rows = [(1, [1.0, 0.0]), (2, None), (3, [0.0, 0.0]), (4, [1.0, 0.0]), (5, [None, 1.0]), (6, None), (7, [0.0, 0.0]), (8, [0.0, 1.0])]
    df = spark.createDataFrame(rows, "id long, embedding array<double>")
    assert [(r.a, r.b) for r in cosine_pairs(df, 0.9).collect()] == [(1, 4)]
    assert sorted(r.id for r in near_duplicates(df, 0.9).collect()) == [1, 2, 3, 5, 6, 7, 8]
    assert cosine_pairs(df.filter("id > 99"), 0.9).count() == 0
    lab = {r.id: r.label for r in density_cluster(df, 0.1, 2).collect()}
    assert lab == {1: 0, 2: -1, 3: 1, 4: 0, 5: -1, 6: -1, 7: 1, 8: -1}


def test_near_duplicates_collapse_copies(spark):
    from tidings.operators.vectors import near_duplicates

    rows = [("k", [1.0, 0.0]), ("b", [1.0, 0.0]), ("z", [0.0, 0.0]), ("y", [0.0, 0.0]), ("c", [0.9, 0.1]), ("d", [0.0, 1.0]), ("e", [0.0, 1.0])]
    df = spark.createDataFrame(rows, "id string, embedding array<double>")
    assert {r.id for r in near_duplicates(df, 0.95).collect()} == {"b", "d", "y", "z"}


def test_long_chain_settles(spark):
    from tidings.operators.greedy import greedy_keep_first

    e = spark.createDataFrame([(i, i + 1) for i in range(40)], "early long, late long")
    assert sorted(r.node for r in greedy_keep_first(e).collect()) == list(range(1, 41, 2))


def test_text_pairs_equal_brute_force(spark):
    from collections import Counter

    from tidings.operators.textvec import embed_tf, text_block_pairs, text_cosine_pairs, text_near_duplicates

    rng = random.Random(21)
    vocab = [f"w{int(rng.paretovariate(0.9))}" for _ in range(3000)]
    docs = []
    for _ in range(40):
        base = [rng.choice(vocab) for _ in range(rng.randint(1, 60))]
        for _ in range(rng.randint(1, 4)):
            w = list(base)
            for _ in range(rng.randint(0, 2)):
                w[rng.randrange(len(w))] = rng.choice(vocab)
            docs.append(" ".join(w))
    df = spark.createDataFrame([("g", i, d) for i, d in enumerate(docs)], "grp string, id long, text string")
    vec = embed_tf(df, group_cols=["grp"])
    tf = [Counter(d.split()) for d in docs]
    norm = [math.sqrt(sum(x * x for x in c.values())) for c in tf]
    cos = {(i, j): sum(c * tf[j][w] for w, c in tf[i].items()) / norm[i] / norm[j] for i in range(len(docs)) for j in range(i + 1, len(docs))}
    for t in (0.95, 0.8):
        sure, maybe = {k for k, v in cos.items() if v >= t + 1e-9}, {k for k, v in cos.items() if v >= t - 1e-9}
        for pairs in (text_cosine_pairs(vec, t, group_cols=["grp"]), text_block_pairs(vec, t, group_cols=["grp"], block_rows=13),
                      text_block_pairs(vec.drop("grp"), t)):
            rows = pairs.collect()
            got = {(r.a, r.b): r.cos for r in rows}
            assert len(rows) == len(got) and sure <= set(got) <= maybe
            assert all(abs(got[k] - cos[k]) < 1e-9 for k in got)
    lost = {r.id for r in text_near_duplicates(vec, 0.9, group_cols=["grp"]).collect()}
    for j in range(len(docs)):
        assert (j in lost) == any(cos[i, j] >= 0.9 and i not in lost for i in range(j))


def test_medoid_of_string_ids(spark):
    rows = [("a", 1, [1.0, 0.0]), ("b", 1, [1.0, 0.0]), ("c", 1, [0.0, 1.0])]
    df = spark.createDataFrame(rows, "id string, label int, embedding array<double>")
    assert [(r.label, r.id) for r in medoids(df).collect()] == [(1, "a")]


def test_bundles_tie_on_first_appearance(spark):
    from tidings.operators.vectors import build_bundles

    ranked = spark.createDataFrame([("x", 5, 1), ("y", 3, 1)], "label string, id long, rank int")
    members = spark.createDataFrame([("x", 5), ("x", 1), ("y", 3)], "label string, id long")
    pos = lambda d: {r.label: r.bundle_pos for r in d.collect()}
    assert pos(build_bundles(ranked)) == {"y": 1, "x": 2}
    assert pos(build_bundles(ranked, members=members)) == {"x": 1, "y": 2}


def test_medoid_matches_bruteforce(spark):
    rng = random.Random(3)
    vecs = [[rng.uniform(-1, 1) for _ in range(5)] for _ in range(30)]
    df = spark.createDataFrame([(i, i % 3, v) for i, v in enumerate(vecs)], "id long, label int, embedding array<double>")
    got = {r.label: r.id for r in medoids(df).collect()}
    u = [np.array(v) / np.linalg.norm(v) for v in vecs]
    for lab in range(3):
        ids = [i for i in range(30) if i % 3 == lab]
        scores = [np.mean([u[i] @ u[j] for j in ids]) for i in ids]
        assert got[lab] == ids[int(np.argmax(scores))]


def test_density_cluster_noise_and_labels(spark):
    pts = [(0, 0), (0.1, 0), (0, 0.1), (5, 5), (5.1, 5), (5, 5.1), (10, 10)]
    df = spark.createDataFrame([(i, [float(x), float(y)]) for i, (x, y) in enumerate(pts)], "id long, embedding array<double>")
    lab = {r.id: r.label for r in density_cluster(df, 0.5, 3).collect()}
    assert lab == {0: 0, 1: 0, 2: 0, 3: 1, 4: 1, 5: 1, 6: -1}


def test_no_cartesian_in_similarity_plan(spark):
    df = spark.createDataFrame([(i, [float(i), 1.0]) for i in range(10)], "id long, embedding array<double>")
    plan = cosine_pairs(df, 0.5)._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_a_row_meets_a_bounded_number_of_blocks(spark):
    from tidings.operators.similarity import COPIES, _self_join_rows

    rng = np.random.default_rng(5)
    df = spark.createDataFrame([(i, x.tolist()) for i, x in enumerate(rng.normal(size=(1200, 8)))], "id long, _v array<double>")
    rows, _ = _self_join_rows(df, "id", [], 9.0, 10, 1)
    assert rows.groupBy("id").count().agg({"count": "max"}).first()[0] <= COPIES


def test_unit_vector_takes_the_norm_once(spark):
    from tidings.operators.similarity import unit_vector

    df = spark.createDataFrame([([3.0, 4.0],), ([0.0, 0.0],)], "v array<double>").select(unit_vector("v").alias("u"))
    assert [r.u for r in df.collect()] == [[0.6, 0.8], [0.0, 0.0]]
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    assert plan.lower().count("sqrt") <= 1


def test_texts_are_dealt_once_and_meet_a_bounded_number_of_blocks(spark, monkeypatch):
    import pyarrow as pa
    from tidings.operators import textvec

    docs = spark.createDataFrame([(i, f"a b{i} c{i % 7}") for i in range(90)], "id long, text string")
    vec = textvec.embed_tf(docs)
    assert vec._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning") == 1

    def listed(keys, id_col, t):
        def kernel(table):
            return pa.table({"a": table.column(id_col), "b": table.column(id_col), "cos": pa.array([0.0] * table.num_rows)})

        return kernel

    monkeypatch.setattr(textvec, "_block_pairs", listed)
    met = textvec.text_block_pairs(vec, 0.9, block_rows=2).groupBy("a").count().collect()
    assert len(met) == 90 and max(r["count"] for r in met) <= textvec.COPIES


def test_neighbours_are_counted_and_joined_without_listing_pairs(spark):
    from tidings.operators.similarity import neighbour_counts, neighbour_forest

    rng = np.random.default_rng(6)
    v = rng.normal(size=(300, 3)).astype(np.float32)
    df = spark.createDataFrame([("g", i, x.tolist()) for i, x in enumerate(v)], "grp string, id long, embedding array<float>")
    near = np.linalg.norm(v[:, None].astype(float) - v[None].astype(float), axis=-1) <= 0.6
    np.fill_diagonal(near, False)
    how = {"metric": "euclid", "group_cols": ["grp"], "block_rows": 40}
    assert {r.id: r.n for r in neighbour_counts(df, "id", "embedding", 0.6, **how).collect()} == {i: int(n) for i, n in enumerate(near.sum(1)) if n}
    edges = [(r.src, r.dst) for r in neighbour_forest(df, "id", "embedding", 0.6, **how).collect()]
    assert all(near[a, b] for a, b in edges) and len(edges) < near.sum() / 2

    def parts(pairs):
        lead = list(range(len(v)))
        for a, b in pairs:
            x, y = lead[a], lead[b]
            lead = [min(x, y) if z in (x, y) else z for z in lead]
        return lead

    assert parts(edges) == parts(zip(*np.nonzero(near), strict=True))


def test_medoid_and_bm25_send_few_rows_instead_of_shuffling_all_tokens(spark, monkeypatch):
    from tidings.operators import textvec

    rng = random.Random(5)
    texts = [(f"c{i % 3}" if i % 11 else None, i, " ".join(rng.choice("abcdefghij") * rng.randint(1, 3) for _ in range(rng.randint(0, 30)))) for i in range(60)]
    vec = textvec.embed_tf(spark.createDataFrame(texts, "cluster_id string, id long, text string"), group_cols=["cluster_id"])
    rows = [(r.cluster_id, r.id, r.token, r.w) for r in vec.collect()]
    want = {}
    for c in ("c0", "c1", "c2"):
        mine = {}
        for _, i, token, w in (r for r in rows if r[0] == c):
            mine.setdefault(i, {})[token] = w
        mean = {}
        for v in mine.values():
            for token, w in v.items():
                mean[token] = mean.get(token, 0.0) + w / len(mine)
        want |= {(c, i): sum(w * mean[token] for token, w in v.items()) for i, v in mine.items()}
    for most in (1, 7, 1000):  # the means of so many tokens are sent
        monkeypatch.setattr(textvec, "COMMON_MEANS", most)
        scores = textvec.tf_medoid_scores(vec)
        got = {(r.cluster_id, r.id): r.score for r in scores.collect()}
        assert set(got) == set(want) and all(math.isclose(got[k], want[k], abs_tol=2e-9) for k in want)
    queries = spark.createDataFrame([("c0", 3), ("c1", 1)], "cluster_id string, qid long")
    ranked = textvec.rerank_bm25(vec, queries)
    assert sorted(r["rank"] for r in ranked.filter("cluster_id = 'c0'").collect()) == list(range(1, sum(k[0] == "c0" for k in want) + 1))


def _greedy(v, t):
    kept = []
    for i in range(len(v)):
        if not (v[kept] @ v[i] >= t).any():
            kept.append(i)
    return kept


def test_large_groups_are_scanned_by_slices_without_listing_all_pairs(spark, monkeypatch):
    from tidings.operators import vectors

    rng = np.random.default_rng(21)
    rows, listed = [], []
    for g, n in (("x", 230), ("y", 60), ("z", 7)):
        v = rng.normal(size=(9, 40))[rng.integers(0, 9, n)] + rng.normal(scale=0.25, size=(n, 40))
        v /= np.linalg.norm(v, axis=1, keepdims=True)
        v[3] = 0.0
        at = rng.permutation(n)  # the scan's order is not that of the ids
        rows += [(g, int(at[i]), i // 2, x.tolist()) for i, x in enumerate(v)]
    want = set()
    for g in "xyz":
        mine = sorted((r for r in rows if r[0] == g), key=lambda r: (r[2], r[1]))
        want |= {(g, mine[i][1]) for i in _greedy(np.array([r[3] for r in mine]), 0.9)}
    df = spark.createDataFrame(rows, "grp string, id long, at long, embedding array<double>")

    def counted(*args, real=vectors.cosine_pairs, **how):
        found = real(*args, **how)
        listed.append(found.count())
        return found

    monkeypatch.setattr(vectors, "cosine_pairs", counted)
    monkeypatch.setattr(vectors, "SLICE_ROWS", 16)
    got = vectors.near_duplicates(df, 0.9, order_col="at", group_cols=["grp"]).select("grp", "id", "at", "embedding").collect()
    assert {(r.grp, r.id) for r in got} == want and len(got) == len(want) < 250
    every = sum((np.triu(np.array([r[3] for r in rows if r[0] == g]) @ np.array([r[3] for r in rows if r[0] == g]).T, 1) >= 0.9).sum() for g in "xyz")
    assert len(listed) == 3 and sum(listed) * 2 < every  # slices end at 16, 64 and 256 rows


def test_single_precision_decides_no_border():
    from tidings.operators.similarity import passing_pairs

    rng = np.random.default_rng(5)
    for d in (16, 64, 256):
        a, b = rng.normal(size=(300, d)), rng.normal(size=(200, d))
        a[0], b[1] = b[0] * 1e20, 0.0
        score = np.einsum("id,jd->ij", a[1:], b)
        for t in (score[5, 7] - 1e-11, score[5, 7] + 1e-11, score.max() - 1e-11):
            r, c, found, _ = passing_pairs(a[1:], b, "cos", t, False)
            assert set(zip(r.tolist(), c.tolist())) == set(zip(*(x.tolist() for x in np.nonzero(score >= t))))
            assert np.allclose(found, score[r, c], rtol=0, atol=1e-12)
        apart = np.sqrt(((a[:, None, :] - b[None]) ** 2).sum(2))
        t = apart[9, 11] + 1e-11
        r, c, found, _ = passing_pairs(a, b, "euclid", t, False)
        assert set(zip(r.tolist(), c.tolist())) == set(zip(*(x.tolist() for x in np.nonzero(apart <= t))))


def test_blocks_of_wide_vectors_hold_fewer_rows():
    from tidings.operators.similarity import MAX_BLOCK_ROWS, rows_of_block

    assert rows_of_block(10**7, 2048, 64) == MAX_BLOCK_ROWS and rows_of_block(10**7, 2048, 256) == 1 << 15


def test_texts_of_large_groups_are_scanned_by_slices(spark, monkeypatch):
    from collections import Counter

    from tidings.operators import textvec

    rng = random.Random(8)
    docs = []
    for g, n in (("x", 120), ("y", 30)):
        bases = [[rng.choice("abcdefghijklmnopqrstuvwxyz") + str(rng.randint(0, 3)) for _ in range(rng.randint(4, 60))] for _ in range(6)]
        for i in range(n):
            w = list(bases[i % 6])
            for _ in range(rng.randint(0, 3)):
                w[rng.randrange(len(w))] = "n" + str(rng.randint(0, 99))
            docs.append((g, i, " ".join(w)))
    vec = textvec.embed_tf(spark.createDataFrame(docs, "grp string, id long, text string"), group_cols=["grp"])
    want, edges = set(), 0
    for g in "xy":
        tf = [Counter(t.split()) for x, _, t in docs if x == g]
        words = sorted(set().union(*tf))
        v = np.array([[c[w] for w in words] for c in tf], dtype=float)
        v /= np.linalg.norm(v, axis=1, keepdims=True)
        want |= {(g, i) for i in range(len(v)) if i not in set(_greedy(v, 0.9))}
        edges += (np.triu(v @ v.T, 1) >= 0.9).sum()
    listed = []

    def counted(pairs, *args, real=textvec.greedy_keep_first, **how):
        listed.append(pairs.count())
        return real(pairs, *args, **how)

    monkeypatch.setattr(textvec, "greedy_keep_first", counted)
    monkeypatch.setattr(textvec, "SLICE_ROWS", 12)
    got = textvec.text_near_duplicates(vec, 0.9, group_cols=["grp"]).collect()
    assert {(r.grp, r.id) for r in got} == want and len(got) == len(want)
    assert len(listed) == 3 and sum(listed) * 2 < edges


def test_tiles_of_long_texts_equal_brute_force(monkeypatch):
    import pyarrow as pa

    from tidings.operators import textvec

    monkeypatch.setattr(textvec, "COMMON_TOKENS", 20)
    monkeypatch.setattr(textvec, "LEAD_TOKENS", 8)
    monkeypatch.setattr(textvec, "REST_CLASSES", 4)
    monkeypatch.setattr(textvec, "WIDE_TOKENS", 24)
    monkeypatch.setattr(textvec, "WIDE_CLASSES", 16)
    monkeypatch.setattr(textvec, "ROWS_AT_ONCE", 16)
    monkeypatch.setattr(textvec, "COLUMNS_AT_ONCE", 32)
    rng, n = np.random.default_rng(3), 90
    tf = rng.integers(0, 3, (7, 60))[rng.integers(0, 7, n)] + (rng.random((n, 60)) < 0.05)
    tf[:, 0] += 1
    held = {k: [] for k in ("_c", "_cf", "_t", "_tf")}
    for row in tf:
        at = np.flatnonzero(row)
        for keys, part in ((("_c", "_cf"), at[at < 20]), (("_t", "_tf"), at[at >= 20])):
            held[keys[0]].append((part if keys[0] == "_c" else part * 10**15 * np.where(part % 2, 1, -1)).tolist())
            held[keys[1]].append(row[part].tolist())
    kinds = {"_c": pa.int16(), "_cf": pa.int32(), "_t": pa.int64(), "_tf": pa.int32()}
    cols = {k: pa.array(x, pa.list_(kinds[k])) for k, x in held.items()} | {"id": pa.array(range(n))}
    v = tf / np.linalg.norm(tf, axis=1, keepdims=True)
    for dense in (0.0, 0.5, 1.0):
        monkeypatch.setattr(textvec, "DENSE", dense)
        for side in (0, 1):
            blk = np.arange(n) % (side + 1)
            table = pa.table({**cols, "_blk": blk, "_bi": np.zeros(n, int), "_bj": np.full(n, side)})
            found = textvec._block_pairs([], "id", 0.9)(table).to_pylist()
            cos = v @ v.T
            want = {(i, j) for i in range(n) for j in range(i + 1, n) if cos[i, j] >= 0.9 and (not side or blk[i] != blk[j])}
            assert {(r["a"], r["b"]) for r in found} == want and len(found) == len(want) > 50
            assert all(abs(r["cos"] - cos[r["a"], r["b"]]) < 1e-12 for r in found)
        hits = textvec._block_hits([], "id", 0.9)(pa.table({**cols, "_guest": np.arange(n) >= 12})).column("id").to_pylist()
        assert sorted(hits) == [j for j in range(12, n) if (cos[:12, j] >= 0.9).any()] and hits
