"""Segment join, containment search and prefix-free parsing against brute force."""

import hashlib
import random

from pyspark.sql import functions as F

from tests.llm.helpers import docs_frame, near_copies, shingle_set, words
from tidings.llm import decontam, jaccard, pfp

AWKWARD = [(900, None), (901, ""), (902, " \t\n"), (903, "one"), (904, "ONE"), (905, "two words"), (906, "x " * 3000),
           (907, "X " * 2000), (908, "é Ä ß 漢字 words"), (908, "é Ä ß 漢字 words"), (None, "one"), (909, "\u00a0one")]


def brute_components(rows, num=80, den=100):
    ids = sorted({i for i, _ in rows if i is not None})
    sets = {}
    for i, t in rows:
        if i is not None:
            sets[i] = shingle_set(t)
    comp = {i: i for i in ids}

    def find(x):
        while comp[x] != x:
            x = comp[x]
        return x

    for k, a in enumerate(ids):
        for b in ids[k + 1:]:
            both = len(sets[a] & sets[b])
            if both and den * both >= num * (len(sets[a]) + len(sets[b]) - both):
                x, y = sorted((find(a), find(b)))
                comp[y] = x
    return {i: (len(sets[i]), find(i)) for i in ids}


def test_segment_join_equals_brute_force(spark):
    rows = near_copies() + [r for r in AWKWARD]
    got = jaccard.jaccard_components(docs_frame(spark, rows)).collect()
    assert len(got) == len(rows)
    want = brute_components(rows)
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got if r.doc_id is not None} == want
    assert [r.component_id for r in got if r.doc_id is None] == [None]


def test_segment_join_thresholds_and_sizes(spark):
    rng = random.Random(11)
    rows, at = [], 0
    for n in (5, 6, 7, 8, 9, 11, 14, 18, 25, 33, 60):
        base = [f"t{n}_{i}" for i in range(n)]
        for cut in range(0, 4):
            rows.append((at, " ".join(base[cut:])))
            rows.append((at + 1, " ".join(base[: n - cut] + [f"u{rng.random()}"])))
            at += 2
    for num in (80, 90, 60):
        got = jaccard.jaccard_components(docs_frame(spark, rows, extra=False), num=num).collect()
        assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == brute_components(rows, num)


def test_large_buckets_are_compared_in_blocks(spark, monkeypatch):
    """Groups whose copies are partly linked, through the block path only, with blocks of three sets."""
    monkeypatch.setattr(jaccard, "LARGE", 0)
    monkeypatch.setattr(jaccard, "BLOCK", 3)
    rng = random.Random(17)
    rows = []
    for _ in range(3):
        base = [f"b{rng.random()}" for _ in range(70)]
        for _ in range(18):
            w = list(base)
            for _ in range(rng.randrange(5)):
                w[rng.randrange(len(w))] = f"e{rng.random()}"
            rows.append((len(rows), " ".join(w)))
    got = jaccard.jaccard_components(docs_frame(spark, rows)).collect()
    want = brute_components(rows)
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == want
    assert 6 < len({c for _, c in want.values()}) < 50


def test_hot_rows_leave_one_of_each_role_behind():
    import numpy as np

    rng = np.random.default_rng(5)
    key = rng.integers(0, 12, 400).astype(np.uint64)
    role = rng.choice([jaccard.INDEX, jaccard.PROBE1, jaccard.PROBE2, jaccard.INDEX | jaccard.PROBE1], 400).astype(np.uint16)
    aside, others = jaccard._hot(key, role)
    left = np.delete(np.arange(400), aside)
    assert len(left) <= 24 and (others == np.bincount(key.astype(int))[key[aside].astype(int)] - 1).all()
    for k in range(12):
        roles = np.bitwise_or.reduce(role[left][key[left] == k])
        assert roles & jaccard.INDEX and roles & (jaccard.PROBE1 | jaccard.PROBE2)
    few = jaccard._hot(np.arange(8, dtype=np.uint64).repeat(jaccard.HOT), np.full(8 * jaccard.HOT, 3, np.uint16))
    assert not len(few[0])


def test_hot_groups_over_small_sets(spark):
    """Many small sets that share most of their shingles: hot keys of every role, checked against brute force."""
    rng = random.Random(31)
    vocab = [f"h{i}" for i in range(14)]
    rows = []
    for n in range(150):
        k = rng.choice([6, 8, 9, 11])
        w = vocab[:k] if rng.random() < 0.6 else vocab[1: k + 1]
        if rng.random() < 0.5:
            w = [*w, f"x{rng.randrange(30)}"]
        rows.append((n, " ".join(w)))
    got = jaccard.jaccard_components(docs_frame(spark, rows)).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == brute_components(rows)


def test_near_copies_side_by_side(spark):
    """A group of near copies in one chunk: its first document indexes and looks up like the others."""
    rows = []
    for i in range(20):
        w = [f"n{k}" for k in range(300)]
        w[7 + 14 * i] = f"own{i}"
        rows.append((i, " ".join(w)))
    got = jaccard.jaccard_components(docs_frame(spark, rows, extra=False).coalesce(1)).collect()
    want = brute_components(rows)
    assert {c for _, c in want.values()} == {0}
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == want


def test_hot_row_with_both_roles_stays_with_another():
    import numpy as np

    both = jaccard.INDEX | jaccard.PROBE1
    for second in (both, jaccard.INDEX, jaccard.PROBE1, jaccard.PROBE2):
        role = np.array([both] + [jaccard.PROBE2 if second & 6 else second] * 4 + [second] * 8, np.uint16)
        aside, _ = jaccard._hot(np.ones(len(role), np.uint64), role)
        left = np.delete(role, aside)
        assert len(left) == 2 and left[0] == both and left[1] == (second if second & jaccard.INDEX else jaccard.PROBE2)


def test_chain_is_one_component(spark):
    base = [f"c{i}" for i in range(120)]
    rows = [(i, " ".join(base[3 * i: 3 * i + 90])) for i in range(10)]
    got = jaccard.jaccard_components(docs_frame(spark, rows)).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == brute_components(rows)


def test_segment_join_empty_table(spark):
    assert jaccard.jaccard_components(docs_frame(spark, [])).count() == 0


def test_containment_equals_brute_force(spark):
    rng = random.Random(3)
    vocab = [f"v{i}" for i in range(60)]
    items = [(i, " ".join(rng.choice(vocab) for _ in range(rng.choice([1, 3, 5, 6, 9, 20, 45])))) for i in range(25)]
    items += [(100, None), (101, ""), (None, "v1 v2 v3 v4 v5"), (102, "É é V1 v2 ß"), (3, items[3][1])]
    docs = []
    for d in range(60):
        w = [rng.choice(vocab) for _ in range(rng.choice([0, 4, 30, 700]))]
        for _ in range(rng.randrange(3)):
            t = (items[rng.randrange(25)][1] or "").split()
            t = t[rng.randrange(2):] if rng.random() < 0.4 else t
            at = rng.randrange(len(w) + 1)
            w = w[:at] + t + w[at:]
        docs.append((d, "  ".join(w).upper() if d % 2 else "\n".join(w)))
    docs += [(500, None), (501, ""), (None, "v1 v2 v3 v4 v5"), (502, "x é É v1 V2 ß y")]
    got = decontam.find_leaks(docs_frame(spark, docs), spark.createDataFrame(items, "item_id long, text string")).collect()
    want = {}
    for i, t in {(i, t) for i, t in items if i is not None}:
        size = min(5, len(words(t)))
        if not size:
            continue
        grams = shingle_set(t)
        for d, text in docs:
            w = words(text)
            have = {tuple(w[k: k + size]) for k in range(len(w) - size + 1)}
            both = len(grams & have)
            if d is not None and both / len(grams) >= 0.8:
                want[d, i] = (len(grams), both)
    assert {(r.doc_id, r.item_id): (r.n_item_shingles, r.n_shared) for r in got} == want
    assert len(got) == len(want) > 20


def test_signatures_leave_no_gap():
    for n in range(1, 400):
        missing = n - -(-8 * n // 10)
        assert decontam.signature_length(n, 0.8) >= min(n, missing + 1)


def test_containment_empty_tables(spark):
    no_items = spark.createDataFrame([], "item_id long, text string")
    some = spark.createDataFrame([(1, "a b c d e f")], "item_id long, text string")
    assert decontam.find_leaks(docs_frame(spark, [(1, "a b c d e f")]), no_items).count() == 0
    assert decontam.find_leaks(docs_frame(spark, []), some).count() == 0


def brute_repeats(rows, n=50):
    seen = {}
    for i, t in rows:
        b = (t or "").encode()
        for k in range(len(b) - n + 1):
            s = b[k: k + n]
            seen[s] = min(seen.get(s, 2**63 - 1), 2**63 - 1 if i is None else i)
    out = []
    for i, t in rows:
        b = (t or "").encode()
        gone = [False] * len(b)
        for k in range(len(b) - n + 1):
            if seen[b[k: k + n]] < (2**63 - 1 if i is None else i):
                gone[k: k + n] = [True] * n
        spans = sum(g and (k == 0 or not gone[k - 1]) for k, g in enumerate(gone))
        kept = bytes(x for x, g in zip(b, gone) if not g)
        out.append((i, len(b), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def test_prefix_free_parsing_equals_brute_force(spark):
    rng = random.Random(9)
    letters = "abcdefgh éß漢 \n"
    passages = ["".join(rng.choice(letters) for _ in range(n)) for n in (20, 49, 50, 51, 80, 200, 600)]
    rows = []
    for d in range(70):
        parts = []
        for _ in range(rng.randrange(1, 5)):
            parts.append("".join(rng.choice(letters) for _ in range(rng.randrange(120))))
            parts.append(rng.choice(passages))
        rows.append((d, "".join(parts)))
    rows += [(80, rows[3][1]), (81, rows[3][1]), (81, rows[5][1]), (82, None), (83, ""), (84, "a" * 49), (85, "a" * 50), (86, "a" * 900),
             (87, "ab" * 300), (88, "ab" * 300 + "c"), (None, rows[4][1]), (2, rows[2][1])]
    got = pfp.remove_repeats(docs_frame(spark, rows), digest=True).collect()
    assert sorted(((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept) for r in got), key=str) == brute_repeats(rows)
    passes = pfp.remove_repeats(docs_frame(spark, rows), digest=True, per_pass=40).collect()
    assert sorted(map(tuple, passes), key=str) == sorted(map(tuple, got), key=str)
    kept = pfp.remove_repeats(docs_frame(spark, rows)).select("doc_id", F.sha2("kept", 256).alias("h")).collect()
    assert sorted(((r.doc_id, r.h) for r in kept), key=str) == sorted(((r.doc_id, r.kept) for r in got), key=str)


def test_hot_passage_is_combined_in_the_task(spark):
    passage = "".join(random.Random(1).choice("abcdefghij klm") for _ in range(300))
    rows = [(d, f"{d * 7919} start {passage} end {d * 104729}") for d in range(120)]
    got = pfp.remove_repeats(docs_frame(spark, rows), digest=True).collect()
    assert sorted(((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept) for r in got), key=str) == brute_repeats(rows)


def test_hot_passage_whose_first_copy_is_elsewhere(spark):
    """Variants of a passage in one chunk; only the smallest document's phrases are sent, and a smaller one has them too."""
    rng = random.Random(21)
    passage = [rng.choice("abcdefghij klm") for _ in range(400)]
    rows = [(100, "".join(passage))]
    for d in range(101, 141):
        w = list(passage)
        for at in rng.sample(range(400), 6):
            w[at] = "#"
        rows.append((d, "".join(w)))
    rows = [(1, rows[0][1]), *((k, "short") for k in range(2, 42)), *rows]  # two slices of 41 rows
    df = spark.createDataFrame(spark.sparkContext.parallelize(rows, 2), "doc_id long, text string")
    got = pfp.remove_repeats(df, digest=True).collect()
    assert sorted(((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept) for r in got), key=str) == brute_repeats(rows)


def test_prefix_free_parsing_empty_table(spark):
    assert pfp.remove_repeats(docs_frame(spark, [])).count() == 0
