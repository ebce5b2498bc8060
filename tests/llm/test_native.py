"""Chunk recipes, line chunks and jump hashing against plain definitions."""

import hashlib
import random
import zlib

import xxhash
from pyspark.sql import functions as F

from tests.llm.helpers import docs_frame
from tidings.llm import chunkdedup, linechunks, sharding


def python_stage(df):
    return any(x in df._jdf.queryExecution().executedPlan().toString() for x in ("Python", "Pandas", "Arrow"))


def test_chunk_recipes_equal_definition(spark):
    rng = random.Random(2)
    long = "".join(rng.choice("abcdefghijklmnopqrstuvwxyzäöß \n") for _ in range(9000))
    rows = [(5, "a b\tc"), (3, "ab c"), (9, "a  b   c"), (2, None), (1, ""), (7, " \n\x0b\x0c\r\t"), (11, long), (12, long.replace(" ", "\n")),
            (13, long[:-1]), (14, "漢字 漢字"), (15, "漢字漢字"), (15, "漢字漢字"), (None, "abc"), (16, "x\u00a0y"), (17, "xy"), (18, "z" * 50000),
            (19, "z" * 50000 + " ")]
    got = chunkdedup.exact_dedup(docs_frame(spark, rows))
    assert not python_stage(got)
    norm = lambda t: "".join(c for c in (t or "") if c not in " \t\n\x0b\x0c\r")
    groups = {}
    for i, t in rows:
        groups.setdefault(norm(t), []).append((-len(t or ""), i is None, i))
    want = []
    for i, t in rows:
        g = groups[norm(t)]
        keep = min(g, key=lambda x: (x[0], x[1], x[2] if x[2] is not None else 0))[2]
        want.append((i, keep, len(g), i == keep, hashlib.sha256(norm(t).encode()).hexdigest()))
    assert sorted(map(tuple, got.collect()), key=str) == sorted(want, key=str)


def test_chunks_are_whole_and_bounded(spark):
    rng = random.Random(4)
    text = "".join(rng.choice("abcdxyz019é漢") for _ in range(20000))
    c = docs_frame(spark, [(1, text)]).select(chunkdedup.chunks_of(F.col("text")).alias("c")).first().c
    assert "".join(c) == text
    assert max(map(len, c)) <= chunkdedup.MAX_CHUNK and min(map(len, c[:-1])) >= chunkdedup.MIN_CHUNK
    # content-defined: after text put in front the cuts meet again
    moved = docs_frame(spark, [(1, "new words " + text)]).select(chunkdedup.chunks_of(F.col("text")).alias("c")).first().c
    assert len(set(c) & set(moved)) > len(c) // 2


def test_ambiguous_ids_are_found(spark):
    rows = [(1, 1, "a"), (1, 1, "b"), (1, 2, "c"), (1, 2, "c"), (2, 2, "d")]
    got = chunkdedup.ambiguous_ids(spark.createDataFrame(rows, "a long, b long, chunk string")).collect()
    assert [tuple(r) for r in got] == [(1, 1)]


def _signed(x):
    return x - 2**64 if x >= 2**63 else x


def _chunks(text, window=2, divisor=3):
    lines = (text or "").split("\n")
    h = [xxhash.xxh64(x.encode(), seed=42).intdigest() for x in lines]
    out, start = [], 0
    for i in range(len(lines)):
        value = 42
        if i + 1 >= window:
            for x in h[i + 1 - window: i + 1]:
                value = xxhash.xxh64(x.to_bytes(8, "little"), seed=value & (2**64 - 1)).intdigest()
            end = _signed(value) % divisor == 0
        else:
            end = False
        if end or i == len(lines) - 1:
            out.append(lines[start: i + 1])
            start = i + 1
    return out


def test_line_chunks_equal_definition(spark):
    rng = random.Random(8)
    pool = [f"line {i} {rng.random()}" for i in range(40)] + ["", " "]
    rows = []
    shared = [pool[k: k + 9] for k in range(0, 30, 6)]
    for d in range(60):
        lines = [rng.choice(pool) for _ in range(rng.randrange(6))]
        for _ in range(rng.randrange(3)):
            lines += rng.choice(shared)
        rows.append((d, "\n".join(lines)))
    rows += [(100, None), (101, ""), (102, "\n\n\n\n"), (103, "\n\n\n\n"), (104, rows[1][1]), (None, rows[1][1]), (105, "one"), (106, "one"),
             (107, "\n".join(pool * 30))]
    got = linechunks.dedup_line_chunks(docs_frame(spark, rows))
    assert not python_stage(got)
    first, count = {}, {}
    order = lambda i, p: (2**63 - 1 if i is None else i, p)
    for i, t in rows:
        for p, c in enumerate(_chunks(t)):
            if len(c) > 1 and "".join(c).strip():
                k = "\n".join(c)
                first[k] = min(first.get(k, order(i, p)), order(i, p))
                count[k] = count.get(k, 0) + 1
    want = []
    for i, t in rows:
        kept, n_gone, n_chunks = [], 0, 0
        for p, c in enumerate(_chunks(t)):
            k = "\n".join(c)
            if k in first and count[k] > 1 and first[k] != order(i, p):
                n_gone, n_chunks = n_gone + len(c), n_chunks + 1
            else:
                kept += c
        want.append((i, "\n".join(kept), len((t or "").split("\n")), n_gone, n_chunks))
    assert sorted(map(tuple, got.collect()), key=str) == sorted(want, key=str)
    assert sum(w[3] for w in want) > 50


def _without_repeats(rows, chunks):
    """What is left of every row, by definition; rows of one id are told apart and ordered by the hash of their texts."""
    order = lambda i, p, t: (2**63 - 1 if i is None else i, p, _signed(xxhash.xxh64((t or "").encode(), seed=42).intdigest()))
    first = {}
    for i, t in rows:
        for p, c in enumerate(chunks(t)):
            first["\n".join(c)] = min(first.get("\n".join(c), (2**63,)), order(i, p, t))
    out = []
    for i, t in rows:
        cut = chunks(t)
        stays = [len(c) == 1 or not "".join(c).strip() or first["\n".join(c)] == order(i, p, t) for p, c in enumerate(cut)]
        kept = [x for c, ok in zip(cut, stays, strict=True) if ok for x in c]
        n = len((t or "").split("\n"))
        out.append((i, "\n".join(kept), n, n - len(kept), stays.count(False)))
    return sorted(out, key=str)


def test_line_chunks_of_rows_that_share_an_id(spark):
    rng = random.Random(12)
    shared = [[f"shared {k} {n}" for n in range(9)] for k in range(4)]
    rows = []
    for d in range(60):
        lines = [f"own {d} {n}" for n in range(rng.randrange(12))]
        rows.append((rng.choice([None, 5, 6, 100 + d]), "\n".join(lines + rng.choice(shared) + [f"end {d} {n}" for n in range(6)])))
    rows += [(7, "\n".join(shared[0])), (7, "\n".join(shared[0] + ["more"])), (None, None), (None, "")]
    got = sorted(map(tuple, linechunks.dedup_line_chunks(docs_frame(spark, rows)).collect()), key=str)
    assert got == _without_repeats(rows, _chunks)
    left = "\n".join(r[1] for r in got)
    assert all(f"own {d} {n}" in left for d, (_, t) in enumerate(rows[:60]) for n in range(12) if f"own {d} {n}\n" in t)


def _lowest_chunks(text):
    lines = (text or "").split("\n")
    h = [_signed(xxhash.xxh64(x.encode(), seed=42).intdigest()) for x in lines]
    cuts = [0, *(i for i in range(2, len(h) - 1) if h[i - 1] > h[i] <= h[i + 1]), len(h)]
    return [lines[a:b] for a, b in zip(cuts, cuts[1:])]


def _planted(length, docs=120):
    """Pairs of documents of lines of their own around a passage that both hold."""
    rng = random.Random(length)
    rows = []
    for d in range(docs):
        around = [f"own {d} {rng.random()}" for _ in range(rng.randrange(6, 40))]
        at = rng.randrange(3, len(around) - 2)
        rows.append((d, "\n".join([*around[:at], *(f"passage {length} {d // 2} {n}" for n in range(length)), *around[at:]])))
    return rows


def test_op9_cuts_at_lowest_lines(spark, tmp_path):
    """The query's chunks have two lines or more, and most lines of repeated passages of eight lines go."""
    from tidings.llm import queries

    planted = _planted(8)
    rows = planted + [(200, None), (201, ""), (202, "\n\n\n\n\n"), (203, "one"), (204, "one"), (205, "a\nb"), (206, "a\nb"),
                      (207, "\n".join(["x", "", "y", ""] * 9)), (None, planted[0][1]), (3, planted[9][1])]
    assert all(len(c) > 1 for _, t in planted for c in _lowest_chunks(t))
    got = linechunks.dedup_line_chunks(docs_frame(spark, rows), lowest=True)
    assert not python_stage(got)
    assert sorted(map(tuple, got.collect()), key=str) == _without_repeats(rows, _lowest_chunks)
    spark.createDataFrame(planted, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    gone = queries.QUERIES["op9_line_chunks"](spark, str(tmp_path)).agg(F.sum("n_removed_lines")).first()[0]
    assert gone > 0.45 * 8 * len(planted) / 2


def jump(key, buckets):
    key, b, j = key & (2**64 - 1), -1, 0
    while j < buckets:
        b = j
        key = (key * 2862933555777941757 + 1) & (2**64 - 1)
        j = int((b + 1) * (float(1 << 31) / float((key >> 33) + 1)))
    return b


def test_jump_hash_is_the_published_one(spark):
    ids = [*range(300), 2**63 - 1, -(2**63), -1, 10**15]
    df = spark.createDataFrame([(i,) for i in ids], "k long")
    for n in (1, 2, 24, 25, 1000):
        got = df.select("k", sharding.jump(F.col("k"), n).alias("j")).collect()
        assert {r.k: r.j.shard for r in got} == {i: jump(i, n) for i in ids}


def test_shards_slots_and_growth(spark):
    rows = [(i, f"text {i}" * (i % 5)) for i in range(2000)] + [(5000, None), (5001, "é漢"), (None, "x"), (7, "again"), (7, "again")]
    got = sharding.assign_shards(docs_frame(spark, rows), 24, blocks=4)
    assert not python_stage(got)
    rows_out = got.collect()
    assert len(rows_out) == len(rows)
    by = {}
    for r in rows_out:
        by.setdefault(r.shard, []).append(r.slot)
        key = r.doc_id or 0
        assert r.shard == jump(key, 24) and r.grown_shard == jump(key, 25)
    assert all(sorted(s) == list(range(len(s))) for s in by.values())
    text = dict(rows)
    for r in rows_out:
        if r.doc_id not in (7, None):
            raw = (text[r.doc_id] or "").encode()
            assert (r.size, r.text_crc32) == (len(raw) + 8, zlib.crc32(raw))


def test_native_operators_on_empty_tables(spark):
    empty = docs_frame(spark, [])
    assert chunkdedup.exact_dedup(empty).count() == 0
    assert linechunks.dedup_line_chunks(empty).count() == 0
    assert sharding.assign_shards(empty, 24).count() == 0
