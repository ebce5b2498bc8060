"""Spelling variants, repeated windows and the manifest against plain definitions."""

import hashlib
import itertools
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
from pyspark.sql import functions as F

from tests.llm.helpers import docs_frame
from tidings.llm import covers, kernels, merkle, queries, spelling

NULL_LAST = 2**63 - 1


def near(a, b):
    if abs(len(a) - len(b)) > 1 or a == b:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    short, long = sorted((a, b), key=len)
    return any(long[:i] + long[i + 1:] == short for i in range(len(long)))


def variants(rows):
    count = Counter()
    for i, t in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", t or ""):
            w = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = None if i is None else zlib.crc32(f"{i}:{w}".encode())
            count[w[: h % len(w)] + w[h % len(w) + 1:] if h is not None and h % 97 == 0 else w] += 1
    return grouped({w: n for w, n in count.items() if len(w) >= 5 and n >= 3})


def grouped(n):
    close = {w: [v for v in n if near(w, v)] for w in n}
    form = {}
    for w in n:
        best = min(close[w], key=lambda v: (-n[v], v), default=None)
        if best is not None and n[best] >= 2 * n[w]:
            form[w] = best

    def root(w):
        while w in form:
            w = form[w]
        return w
    return sorted(((w, form.get(w), root(w), n[w], len(close[w]), n.get(form.get(w))) for w in n), key=str)


def rows_of(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_variants_equal_definition(spark):
    rng = random.Random(3)
    base = ["".join(rng.choice("abcdeéÿß") for _ in range(rng.randrange(4, 9))) for _ in range(40)] + ["aaaaa", "ababab", "bababa", "AbcdE", "é×÷éé"]
    pool = list(base)
    for w in base * 4:
        at, c = rng.randrange(len(w)), rng.choice("abcdeé")
        pool.append(rng.choice([w[:at] + w[at + 1:], w[:at] + c + w[at:], w[:at] + c + w[at + 1:]]))
    rows = [(i, " ".join(rng.choice(pool) + rng.choice(["", "1", ",", "’"]) for _ in range(60))) for i in range(60)]
    rows += [(None, rows[0][1]), (None, None), (7, ""), (5, rows[5][1]), (-4, "Zebra zebra ZEBRA zebr zebr zebr zebrá zebrá zebrá")]
    rows += [(900 + i, "q" * 3000 + " " + "q" * 3001) for i in range(3)]  # long words of one bigram
    for hot in (0, 5, spelling.HOT):  # every key, some and no key keyed anew
        assert rows_of(spelling.group_variants(spelling.vocabulary(docs_frame(spark, rows)), hot=hot)) == variants(rows)
    assert rows_of(spelling.group_variants(spelling.vocabulary(docs_frame(spark, [(1, None), (2, "")], extra=False)))) == []


def test_chains_of_forms_and_ties(spark):
    n = {"aaaaa": 3, "aaaab": 6, "aaabb": 12, "aabbb": 24, "abbbb": 48, "ccccc": 10, "ccccd": 20, "cccce": 20, "ddddd": 5, "dddde": 9}
    got = rows_of(spelling.group_variants(spark.createDataFrame(list(n.items()), "word string, n long")))
    assert got == grouped(n)
    assert next(r for r in got if r[0] == "aaaaa")[2] == "abbbb"
    assert next(r for r in got if r[0] == "ccccc")[1] == "ccccd"


def test_pivots_are_the_cheapest_disjoint_grams():
    rng = random.Random(5)
    for _ in range(300):
        places = sorted(rng.sample(range(12), rng.randrange(3, 8)))
        costs = [rng.randrange(20) for _ in places]
        cost = dict(zip(places, costs, strict=True))
        sets = [c for c in itertools.combinations(places, 2) if c[1] - c[0] >= 2]
        got = spelling.rare_disjoint(places, costs, 2, 2)
        assert tuple(got) in sets and sum(cost[p] for p in got) == min(sum(cost[p] for p in c) for c in sets)


def cut_windows(rows, size):
    place = lambda i: NULL_LAST if i is None else i
    first = {}
    texts = [(i, (t or "").encode().split()) for i, t in rows]
    for i, w in texts:
        for s in range(len(w) - size + 1):
            k = tuple(w[s: s + size])
            first[k] = min(first.get(k, (place(i), s)), (place(i), s))
    out = []
    for i, w in texts:
        gone = set()
        for s in range(len(w) - size + 1):
            if first[tuple(w[s: s + size])] != (place(i), s):
                gone.update(range(s, s + size))
        out.append((i, len(w), len(gone), b" ".join(x for k, x in enumerate(w) if k not in gone).decode()))
    return sorted(out, key=str)


def passages(seed):
    rng = random.Random(seed)
    word = lambda: f"w{rng.randrange(3000)}é"[: rng.randrange(2, 7)]
    shared = [[word() for _ in range(n)] for n in (19, 20, 21, 26, 33, 70)]
    rows = []
    for i in range(70):
        w = [word() for _ in range(rng.randrange(0, 60))]
        for _ in range(rng.randrange(0, 3)):
            p = rng.choice(shared)
            a = rng.randrange(0, 5) if len(p) > 30 else 0
            w += p[a:] + [word() for _ in range(rng.randrange(0, 9))]
        rows.append((rng.randrange(1000), rng.choice([" ", "\n", " \t "]).join(w)))
    rows += [(i + 2000, rows[3][1]) for i in range(30)] + [(2500, rows[4][1].replace(" ", "\n")), rows[5], rows[5], (None, rows[6][1]), (None, rows[6][1]),
             (None, "a b " * 40), (None, None), (None, ""), (2600, ""), (2601, "one two"), (2602, "x " * 90), (2603, "x " * 45 + "y " * 45),
             (2604, " ".join(map(str, range(5000))) + " " + " ".join(map(str, range(2500, 6000)))), (rows[7][0], rows[8][1]), (2605, "Ab " * 30), (2606, "aB " * 30)]
    return rows


def test_windows_equal_definition(spark):
    rows = passages(11)
    for size, period in ((20, 13), (8, 5), (20, 7)):
        got = rows_of(covers.remove_repeated_windows(docs_frame(spark, rows).repartition(5), size=size, period=period))
        assert got == cut_windows(rows, size)
    digest = rows_of(covers.remove_repeated_windows(docs_frame(spark, rows), digest=True))
    assert digest == sorted(((i, n, k, hashlib.sha256(t.encode()).hexdigest()) for i, n, k, t in cut_windows(rows, 20)), key=str)
    assert rows_of(covers.remove_repeated_windows(docs_frame(spark, []))) == []


def test_cover_and_runs():
    for period in range(2, 60):
        c = covers.difference_cover(period)
        assert {(a - b) % period for a in c for b in c} == set(range(period))
    text = " ".join("abcabd" * 20).encode()
    s = covers.Sequence(np.frombuffer(text, np.uint8), np.array([0, len(text)]))
    words = text.split()
    for size in (1, 2, 3, 7, 8, 13, 20):
        h = s.runs(size, covers._STEP_A)
        runs = defaultdict(set)
        for i in range(len(words) - size + 1):
            runs[tuple(words[i: i + size])].add(int(h[i]))
        assert all(len(v) == 1 for v in runs.values()) and len({next(iter(v)) for v in runs.values()}) == len(runs)
    assert kernels.CHUNK_BYTES > 0


def digest(text):
    return hashlib.sha256(text.encode()).hexdigest()


def tree(leaves, fanout):
    paths, cover, level = [[] for _ in leaves], [[i] for i in range(len(leaves))], list(leaves)
    while len(level) > 1:
        above, held = [], []
        for a in range(0, len(level), fanout):
            run = level[a: a + fanout]
            for j, below in enumerate(cover[a: a + fanout]):
                for i in below:
                    paths[i].append(("".join(run[:j]), "".join(run[j + 1:])))
            above.append(digest("".join(run)))
            held.append(sum(cover[a: a + fanout], []))
        level, cover = above, held
    return (level or [None])[0], paths


def manifest_rows(rows, fanout=8):
    field = lambda v: "-" if v is None else f"{len(str(v).encode())}:{v}"
    leaf = lambda r: digest("".join(map(field, r)))
    groups = defaultdict(list)
    for r in rows:
        groups[r[2]].append(r)
    found, roots = [], []
    for g in sorted(groups, key=lambda x: (x is not None, (x or "").encode())):
        own = sorted(groups[g], key=lambda r: (r[0] is not None, r[0] or 0, leaf(r)))
        root, paths = tree([leaf(r) for r in own], fanout)
        roots.append(root)
        found.append((own, root, paths))
    top, over = tree(roots, fanout)
    out = []
    for (own, sub, paths), last in zip(found, over, strict=True):
        for r, p in zip(own, paths, strict=True):
            p, bad = p + last, r
            if r[0] is not None and zlib.crc32(str(r[0]).encode()) % 3 == 0 and r[4] is not None:
                bad = (*r[:4], "".join(c.lower() if "A" <= c <= "Z" else c for c in r[4]))
            end = leaf(bad)
            for a, b in p:
                end = digest(a + end + b)
            out.append((r[0], leaf(r), sub, top, digest("".join(a + b for a, b in p)), end, end == top))
    return sorted(out, key=str)


def manifest_table(n, seed=2):
    rng = random.Random(seed)
    rows = [(i, rng.choice([None, "s1", "sé"]), rng.choice(["de", "en", "EN", "fr", None, "ü"]), rng.choice([None, 5]), rng.choice([None, "", "Text É", "abc", "A" * 3000]))
            for i in rng.sample(range(10**6), n)]
    return rows + [(None, "s", "de", 1, "x")] * 20 + [(None, None, None, None, None), (-3, "s", "one", 1, "LONE")] + rows[:3] * 9 if n else []


def test_manifest_query_equals_definition(spark, tmp_path):
    schema = "doc_id long, source string, lang string, n_chars long, text string"
    for n, at in ((0, "none"), (700, "many")):
        rows = manifest_table(n)
        frame = spark.createDataFrame(rows, schema).repartition(4)
        for c in ("path", "lo", "g", "digest", "root", "tree"):
            frame = frame.withColumn(c, F.lit(1))
        frame.write.parquet(f"{tmp_path}/{at}/documents.parquet")
        assert rows_of(queries.op13_interval_manifest(spark, f"{tmp_path}/{at}")) == manifest_rows(rows)


def test_manifest_small_trees(spark):
    schema = "doc_id long, source string, lang string, n_chars long, text string"
    fields = [F.col(c) for c in ("doc_id", "source", "lang", "n_chars", "text")]
    for n in (1, 2, 3, 4, 9, 10, 28):
        rows = [(i, "s", "de", 1, f"T{i}") for i in range(n)]
        got = merkle.manifest(spark.createDataFrame(rows, schema), "doc_id", fields, "lang", fanout=3)
        got = got.select("doc_id", "leaf", "subroot", "root", merkle.proof_digest(F.col("path")), merkle.folded(F.col("leaf"), F.col("path")))
        want = [(*r[:5], r[3]) for r in manifest_rows(rows, 3)]
        assert rows_of(got) == sorted(want, key=str)
