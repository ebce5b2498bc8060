"""Url vocabulary, classifiers, mixing and the pipeline."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tests.llm.helpers import docs_frame, words
from tidings.llm import folds, kernels, mixing, quality, queries, toxicity, urlfilter

SMALL = "/root/testdata/sf0.001"


def test_url_rules_and_vocabulary(spark):
    cases = {
        "https://WWW.Example.com/en/x": ("www.example.com", "/en/x", "www.example.com/en/", "allow"),
        "https://a.example.com/en/x": ("a.example.com", "/en/x", "example.com/en/", "block"),
        "http://example.com/de/": ("example.com", "/de/", "com/", "allow"),
        "http://x.net/fr/1?q=/es/": ("x.net", "/fr/1", "net/fr/", "block"),
        "http://net/es/": ("net", "/es/", "net/es/", "block"),
        "http://notexample.com/en/": ("notexample.com", "/en/", "com/", "allow"),
        "http://x.com": ("x.com", "", None, "allow"),
        "http://x.org/porn/": ("x.org", "/porn/", None, "block"),
        "http://x.org/pornographer": ("x.org", "/pornographer", None, "allow"),
        "http://x.org/casino": ("x.org", "/casino", None, "allow"),
        "http://x.org/casino-BETTING": ("x.org", "/casino-BETTING", None, "block"),
        "http://x.org/casino/casino": ("x.org", "/casino/casino", None, "allow"),
        "http://porn.com/": ("porn.com", "/", "com/", "allow"),
        "no scheme /en/": ("", "", None, "allow"),
        "a://b://c/d": ("b:", "//c/d", None, "allow"),
        "http://h.net#f": ("h.net", "", None, "allow"),
        "": ("", "", None, "allow"),
        None: ("", "", None, "allow"),
    }
    df = spark.createDataFrame([(i, u, "r", "v") for i, u in enumerate(cases)], "page_id long, url string, rule string, verdict string")
    got = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in urlfilter.filter_urls(df).collect()}
    assert got == dict(enumerate(cases.values()))
    assert urlfilter.filter_urls(df.limit(0)).count() == 0
    assert {r.verdict for r in urlfilter.filter_urls(df, rules=(), strict=(), soft={}).collect()} == {"allow"}


def test_word_kernel(spark):
    import pyarrow as pa

    texts = ["A b\tc\x0bd", "", None, "  ", "é ß\u00a0x", "tail", " lead", "x\x1fy z"] * 3
    want = [len(words(t)) for t in texts]
    assert kernels.word_counts(pa.array(texts)).tolist() == want
    assert kernels.word_counts(pa.array(texts).slice(4, 9)).tolist() == want[4:13]
    raw, off = kernels.string_buffers(pa.array(texts))
    w = kernels.Words(raw, off)
    assert [w.low[a:b].tobytes() for a, b in zip(w.start, w.end)] == [x for t in texts for x in words(t)]
    h = dict(zip(w.hashes().tolist(), (x for t in texts for x in words(t))))
    assert len(h) == len({x for t in texts for x in words(t)})


def test_folds(spark):
    import zlib

    got = spark.range(50).select("id", folds.fold(F.col("id"), 3).alias("f")).collect()
    assert all(r.f == zlib.crc32(str(r.id).encode()) % 3 for r in got)


def _labelled(n=400, seed=1):
    rng = random.Random(seed)
    vocab = [f"word{i}" for i in range(80)]
    docs, labels = [], []
    for i in range(n):
        toxic = i % 4 == 0
        w = [rng.choice(vocab) for _ in range(rng.randrange(8, 60))]
        for _ in range(2 if toxic else 0):
            w[rng.randrange(len(w))] = rng.choice(["insultone", "insulttwo", "insultthree"])
        # the sample mentions one group mostly in toxic texts
        if rng.random() < (0.8 if toxic else 0.1):
            w[rng.randrange(len(w))] = "muslim"
        elif rng.random() < 0.3:
            w[rng.randrange(len(w))] = "christian"
        docs.append((i, " ".join(w)))
        labels.append((i, int(toxic)))
    return docs, labels


def test_toxicity_held_out_and_counterfactual(spark):
    docs, labels = _labelled()
    frame = docs_frame(spark, [*docs, (9000, None), (9001, ""), (None, "insultone insulttwo"), (9002, "word1 " * 60000)])
    lab = spark.createDataFrame([*labels, (None, 1), (3, None), (4, 5), (8, 1)], "doc_id long, toxic int")
    model = toxicity.fit(frame, lab)
    got = toxicity.score_texts(frame, model).select("doc_id", "toxicity", "rule").collect()
    assert len(got) == len(docs) + 4 and all(0 <= r.toxicity <= 1 for r in got)
    score = {r.doc_id: r.toxicity for r in got}
    import zlib

    held = [i for i, _ in docs if zlib.crc32(str(i).encode()) % 3 == 1]
    assert np.mean([(score[i] >= 0.7) == (i % 4 == 0) for i in held]) > 0.97
    probe = docs_frame(spark, [(1, "a muslim word1 word2 word3"), (2, "a christian word1 word2 word3")])
    free = toxicity.fit_linear  # the same sample without the penalty
    x = lambda t: toxicity._of([t.encode()])[1]
    y = np.array([float(v) for _, v in labels])
    plain = free([x(t) for _, t in docs], y, [None] * len(docs))
    twins = [None if (s := toxicity.swapped(t.encode())) is None else toxicity._of([s])[1] for _, t in docs]
    fair = free([x(t) for _, t in docs], y, twins, strength=5.0)
    gap = lambda m: abs(np.diff([r.s for r in probe.select(toxicity.score_of(m, F.col("text")).alias("s")).collect()])[0])
    assert gap(fair) < gap(plain) * 0.6


def test_toxicity_without_labels(spark):
    frame = docs_frame(spark, [(1, "a b"), (2, None)])
    none = spark.createDataFrame([], "doc_id long, toxic int")
    got = toxicity.score_texts(frame, toxicity.fit(frame, none)).collect()
    assert len(got) == 2 and all(0 <= r.toxicity <= 1 for r in got)
    assert toxicity.score_texts(frame.limit(0), toxicity.fit(frame, none)).count() == 0


def test_quality_on_given_labels(spark):
    got = queries.op5_positive_unlabelled(spark, "/root/testdata/sf0.01").filter("held_out")
    m = got.join(queries.table(spark, "/root/testdata/sf0.01", "labels"), "doc_id").collect()
    assert np.mean([r.predicted == r.quality for r in m]) > 0.95


def test_quality_edge_cases(spark):
    frame = docs_frame(spark, [(1, None), (2, ""), (None, "x"), (3, "a " * 100000), (4, "\U0001f600 é"), (4, "\U0001f600 é")])
    none = spark.createDataFrame([], "doc_id long, quality int")
    fitted = quality.fit(frame, none)
    got = quality.score_texts(frame, fitted).collect()
    assert fitted[0] is None and len(got) == 6 and all(0 <= r.quality <= 1 for r in got)
    some = spark.createDataFrame([(i, 1) for i in range(8)] + [(None, 1), (2, None)], "doc_id long, quality int")
    got = quality.score_texts(frame, quality.fit(frame, some)).collect()
    assert len(got) == 6 and all(0 <= r.quality <= 1 for r in got)
    assert quality.score_texts(frame.limit(0), quality.fit(frame, some)).count() == 0


def _water(sizes, weights, share, cap):
    left, done = dict(sizes), {}
    order = sorted((s for s in sizes if s is not None), key=lambda s: s.encode("utf-8"))
    order += [None] if None in sizes else []
    w = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    total = share * sum(sizes.values())
    while left:
        rest = total - sum(done.values())
        over = [s for s in left if rest * w[s] / sum(w[x] for x in left) >= cap * sizes[s]]
        if not over:
            done.update({s: rest * w[s] / sum(w[x] for x in left) for s in left})
            break
        for s in over:
            done[s] = cap * sizes[s]
            del left[s]
    return done


def test_mixing_targets_and_copies(spark):
    rng = random.Random(6)
    names = ["a", "b", "Z", "é", None, "", "zz"]
    rows = []
    for i in range(6000):
        s = names[0] if rng.random() < 0.5 else rng.choice(names)
        rows.append((i, " ".join("x" for _ in range(rng.choice([0, 3, 10, 10, 50, 300]))) or None, s))
    rows += [(7, "x x", "b"), (7, "x x", "b"), (None, "x", "a")]
    df = spark.createDataFrame([(*r, 1.0, 9) for r in rows], "doc_id long, text string, source string, target double, copies int")
    sized = df.withColumn("size", mixing.word_count(F.col("text")))
    got = mixing.mix(sized).collect()
    assert len(got) == len(rows)
    sizes = {}
    for _, t, s in rows:
        sizes[s] = sizes.get(s, 0) + len(words(t))
    want = _water(sizes, mixing.WEIGHTS, 1.5, 2.0)
    taken = {}
    for r in got:
        assert r.source_size == sizes[r.source] and r.target == pytest.approx(want[r.source], rel=1e-9) and 0 <= r.copies <= 2
        taken[r.source] = taken.get(r.source, 0) + r.copies * r.size
    for s, t in want.items():
        assert abs(taken[s] - t) <= 2  # texts of three words close the gap
    again = mixing.mix(sized.repartition(3)).collect()
    pick = lambda rs: sorted(((r.doc_id, r.source, r.size, r.copies) for r in rs), key=str)
    assert pick(again) == pick(got)
    assert mixing.mix(sized.limit(0)).count() == 0


def test_mixing_comes_near_every_target(spark):
    got = queries.op7_entropy_balancing(spark, SMALL).join(queries.table(spark, SMALL, "documents").select("doc_id", "source"), "doc_id").collect()
    for s in {r.source for r in got}:
        own = [r for r in got if r.source == s]
        assert abs(sum(r.taken for r in own) - own[0].target) <= max(min(r.size for r in own if r.size), 0.01 * own[0].target)
        assert all(r.taken <= 2 * r.size for r in own)


def test_mixing_all_blank(spark):
    df = spark.createDataFrame([(1, None, "a"), (2, "", None)], "doc_id long, text string, source string")
    got = mixing.mix(df.withColumn("size", mixing.word_count(F.col("text")))).collect()
    assert [r.copies for r in got] == [0, 0]


def test_pipeline_stages_take_effect(spark):
    sf = SMALL
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    columns = docs.columns
    kept = {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, sf)
        assert out.columns == columns
        out = spark.createDataFrame(out.collect(), docs.schema)
        kept[name] = (docs.collect(), out.collect())
        docs = out
    before, after = kept["quality"]
    good = queries.quality.score_texts(spark.createDataFrame(before), quality.fit(spark.createDataFrame(before), queries.table(spark, sf, "labels")), out="q")
    assert sorted(r.doc_id for r in after) == sorted(r.doc_id for r in good.filter("q >= 0.7").collect())
    before, after = kept["near_duplicates"]
    from tests.llm.test_pairs import brute_components

    comp = brute_components([(r.doc_id, r.text) for r in before])
    assert sorted(r.doc_id for r in after) == sorted(i for i, (_, c) in comp.items() if i == c)
    before, after = kept["decontamination"]
    from tests.llm.helpers import shingle_set

    items = [shingle_set(r.text) for r in queries.table(spark, sf, "benchmark").collect()]
    clean = [r.doc_id for r in before if all(len(i & shingle_set(r.text)) < 0.8 * len(i) for i in items if i)]
    assert sorted(r.doc_id for r in after) == sorted(clean)
    before, after = kept["mixing"]
    assert {r.doc_id for r in after} <= {r.doc_id for r in before} and len(after) > len(before)
    final = corpus_pipeline.STAGES[-1][1](spark, docs, sf).collect()
    assert len(final) == len(after)


def test_pipeline_with_null_and_repeated_ids(spark, tmp_path):
    rng = random.Random(12)
    text = lambda n: " ".join(f"v{rng.randrange(5000)}" for _ in range(n))
    near, item, other = text(200), text(40), [text(120) for _ in range(6)]
    close = near.rsplit(" ", 1)[0] + " end"
    rows = [(1, near), (None, near), (None, close), (2, close), (2, other[0]), (None, other[1]), (None, other[1]), (3, other[2]), (3, other[2]),
            (4, other[3] + " " + item), (None, item), (None, other[4]), (4, other[5]), (None, None), (5, ""), (None, "")]
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    docs = spark.createDataFrame([(i, t, "en", "s", 1) for i, t in rows], schema)
    spark.createDataFrame([(1, item), (2, None)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    kept = corpus_pipeline.drop_near_duplicates(spark, docs, str(tmp_path))
    texts = sorted((r.text or "") for r in kept.collect())
    assert len([t for t in texts if t in (near, close)]) == 1
    assert [t for t in texts if t not in (near, close, "")] == sorted([*other[:3], other[3] + " " + item, item, other[4], other[5]])
    clean = corpus_pipeline.drop_benchmark_leaks(spark, docs, str(tmp_path))
    gone = [(i, t) for i, t in rows if t and item in t]
    assert sorted(((r.doc_id, r.text) for r in clean.collect()), key=str) == sorted((x for x in rows if x not in gone), key=str)
    for _, stage in corpus_pipeline.STAGES[1:]:
        assert stage(spark, docs.limit(0), str(tmp_path)).count() == 0
