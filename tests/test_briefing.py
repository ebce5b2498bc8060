import random

from tidings.operators.briefing import diversify_top3, finalize


def order_of(spark, sources):
    rows = [("b", f"t{i}", i + 1, src) for i, src in enumerate(sources)]
    df = spark.createDataFrame(rows, "briefing_id string, topic_id string, ord int, primary_source string")
    return [int(r.topic_id[1:]) for r in diversify_top3(df).orderBy("place").collect()]


def test_diversity_by_hand(spark):
    assert order_of(spark, ["a"]) == [0]
    assert order_of(spark, ["a", "a", "b"]) == [0, 2, 1]  # the first other source moves up
    assert order_of(spark, ["a", "a", "a", "b", "c"]) == [0, 3, 4, 1, 2]
    assert order_of(spark, ["a", "b", "a", "b", "c"]) == [0, 1, 4, 2, 3]
    assert order_of(spark, ["a", None, "a"]) == [0, 1, 2]  # no source differs from every source
    assert order_of(spark, [None, "a", "a", "b"]) == [0, 1, 3, 2]
    assert order_of(spark, ["a", "a", "a", "a"]) == [0, 1, 2, 3]  # nothing else: plain order
    assert order_of(spark, ["a", "b", "b", "a"]) == [0, 1, 2, 3]  # no third source: the next one


def test_diversity_properties(spark):
    rng = random.Random(1)
    for _ in range(12):
        src = [rng.choice([None, "a", "b", "c"]) for _ in range(rng.randint(1, 7))]
        got = order_of(spark, src)
        assert sorted(got) == list(range(len(src))) and got[0] == 0 and got[3:] == sorted(got[3:])
        for place in (1, 2):
            if place < len(got):
                used = {src[i] for i in got[:place]} - {None}
                fresh = [i for i in range(len(src)) if i not in got[:place] and (src[i] is None or src[i] not in used)]
                left = [i for i in range(len(src)) if i not in got[:place]]
                assert got[place] == (fresh or left)[0]


def test_digests_with_equal_cluster_ids_do_not_mix(spark):
    from tidings.operators.facts import compose_topics, extract_facts, pick_facts, score_facts

    items = spark.createDataFrame([
        ("A", "cluster-0", 1, "Release 4, now. Same words here, really.", "https://a.example.com/1"),
        ("B", "cluster-0", 2, "Same words here, really. Other news: 7 things.", "https://b.example.com/2"),
    ], "briefing_id string, cluster_id string, doc_id long, text string, url string")
    facts, rejected = extract_facts(items)
    assert rejected.count() == 0
    got = sorted((r.briefing_id, r.fact_id, r.text) for r in facts.collect())
    assert got == [("A", "fact-0", "Release 4, now."), ("A", "fact-1", "Same words here, really."),
                   ("B", "fact-0", "Same words here, really."), ("B", "fact-1", "Other news: 7 things.")]
    picked, dropped = pick_facts(score_facts(facts))
    topics, bullets = compose_topics(picked)
    assert sorted((r.briefing_id, r.n_bullets) for r in topics.collect()) == [("A", 2), ("B", 2)]
    enriched = topics.drop("n_bullets").selectExpr("*", "10.0D AS score", "1 AS actionability", "2L AS picked_count", "1 AS bundle_pos", "'s' AS primary_source")
    final, fb = finalize(enriched, bullets)
    assert sorted((r.briefing_id, r.n_bullets) for r in final.collect()) == [("A", 2), ("B", 2)]
    assert fb.count() == 4 and dropped.count() == 0


def test_gates_in_order(spark):
    from tidings.operators.facts import gate_clusters

    bundles = spark.createDataFrame([("A", "c0", 1), ("A", "c1", 2), ("B", "c0", 1)], "briefing_id string, cluster_id string, bundle_pos int")
    picked = spark.createDataFrame([("A", "c0"), ("A", "c1")], "briefing_id string, cluster_id string")
    bullets = spark.createDataFrame([("A", "c1"), ("A", "c1")], "briefing_id string, cluster_id string")
    got = [(r.briefing_id, r.cluster_id, r.status) for r in gate_clusters(bundles, picked, bullets).orderBy("briefing_id", "bundle_pos").collect()]
    assert got == [("A", "c0", "skipped: no bullets"), ("A", "c1", "topic"), ("B", "c0", "skipped: no picked fact")]


def test_record_checks_fail_on_nulls(spark):
    from tidings.operators.quality import check_records

    dims = "actionability int, novelty int, impact int, reusability int, reliability int, agentic_bonus int"
    picked = spark.createDataFrame([("A", "c", "f", "text", "https://x.org", 9, 9, 9, 9, 9, None)],
                                   f"briefing_id string, cluster_id string, fact_id string, text string, url string, {dims}")
    topics = spark.createDataFrame([("A", 1, "t", "\u3000\n", None)], "briefing_id string, topic_pos int, topic_id string, headline string, n_bullets long")
    bullets = spark.createDataFrame([("A", 1, 1, None, "ftp://x")], "briefing_id string, topic_pos int, bullet_pos int, text string, url string")
    headers = spark.createDataFrame([("A", None, "2024")], "briefing_id string, title string, date string")
    rules = sorted((r.entity, r.rule) for r in check_records(picked, topics, bullets, headers).collect())
    assert len([r for e, r in rules if e == "fact"]) == 6
    assert [r for e, r in rules if e != "fact"] == ["title missing", "bullet text shorter than 8", "url not http(s)", "bullets outside 1..4", "empty headline"]


def test_invalid_digest_is_quarantined(spark):
    from tidings.operators.briefing import mark_valid, split_valid

    t = spark.createDataFrame([("A", 1, 5), ("A", 2, 1), ("B", 1, 2)], "briefing_id string, topic_pos int, n_bullets long")
    b = spark.createDataFrame([("A", 1), ("B", 1)], "briefing_id string, topic_pos int")
    good, bullets, bad = split_valid(mark_valid(t), b)
    assert [r.briefing_id for r in good.collect()] == ["B"] and [r.briefing_id for r in bullets.collect()] == ["B"] and bad.count() == 2


def test_settings():
    from tidings.functions.scores import Settings

    s = Settings.read({"processing": {"max_bullets_per_topic": "9"}, "scoring": {"weights": {"novelty": "x", "impact": "5", "else": 1}}})
    assert s.max_bullets == 4 and s.weights["impact"] == 5.0 and s.weights["novelty"] == 2.0 and "else" not in s.weights
    assert Settings.read(None).max_bullets == 4 and Settings.read({"processing": {"max_bullets_per_topic": 0}}).max_bullets == 1


def test_finalize_focus_first(spark):
    # hn topic (weighted 18) and tw topic (weighted 20, agentic): focus first, then the hn topic
    topics = spark.createDataFrame([
        ("b", "cluster-cluster-hn-001", "cluster-hn-001", "HN headline", False, False, 18.0, 3, 1, 1, "hackernews"),
        ("b", "cluster-cluster-tw-002", "cluster-tw-002", "TW headline", True, False, 20.0, 2, 1, 2, "twitter"),
    ], "briefing_id string, topic_id string, cluster_id string, headline string, agentic boolean, strategic boolean, "
       "score double, actionability int, picked_count long, bundle_pos int, primary_source string")
    bullets = spark.createDataFrame([
        ("b", "cluster-cluster-hn-001", 1, "hn bullet text", "https://news.example.com/1"),
        ("b", "cluster-cluster-tw-002", 1, "tw bullet text", "https://twitter.com/x/1"),
    ], "briefing_id string, topic_id string, bullet_pos int, text string, url string")
    final, fb = finalize(topics, bullets)
    rows = final.orderBy("topic_pos").collect()
    assert [(r.topic_id, r.headline, r.n_bullets) for r in rows] == [
        ("agentic-focus", "Agentic Focus", 1), ("cluster-hn-001", "HN headline", 1)]
    assert all(r.valid for r in rows)


def test_briefing_header_iso_date(spark):
    import datetime as dt

    from tidings.operators.briefing import briefing_header

    t = spark.createDataFrame([("en",), ("de",)], "briefing_id string")
    got = {r.briefing_id: (r.title, r.date) for r in briefing_header(t, None, dt.datetime(2024, 1, 31)).collect()}
    assert got == {"en": ("Digest en", "2024-01-31T00:00:00Z"), "de": ("Digest de", "2024-01-31T00:00:00Z")}
    (r,) = briefing_header(t.limit(1), "T", dt.datetime(2024, 1, 31, 1, 2, 3, 4500)).collect()
    assert r.date == "2024-01-31T01:02:03.004500Z"


def test_split_focus_edge_cases(spark):
    from tidings.operators.briefing import split_focus

    rows = [("one", "a", 1, True), ("two", "b", 1, True), ("two", "c", 2, True), ("mix", "d", 1, True), ("mix", "e", 2, False)]
    df = spark.createDataFrame(rows, "briefing_id string, topic_id string, ord int, agentic boolean")
    got = {r.topic_id: r.in_focus for r in split_focus(df).collect()}
    # a lone agentic topic goes back; of two, the best moves to the main list; with general topics all agentic leave
    assert got == {"a": False, "b": False, "c": True, "d": True, "e": False}
    assert not any(r.in_focus for r in split_focus(df, enabled=False).collect())


def test_lookup_exact_key_wins(spark):
    from tidings.operators.briefing import lookup_with_fallback

    left = spark.createDataFrame([("A", "cluster-x"), ("A", "cluster-y"), ("A", "z"), ("B", "cluster-x")], "briefing_id string, key string")
    dim = spark.createDataFrame([("A", "cluster-x", 1), ("A", "x", 2), ("A", "y", 3), ("B", "x", 4)], "briefing_id string, cluster_id string, v int")
    got = {(r.briefing_id, r.key): r.d_v for r in lookup_with_fallback(left, dim, left_key="key", dim_key="cluster_id").collect()}
    assert got == {("A", "cluster-x"): 1, ("A", "cluster-y"): 3, ("A", "z"): None, ("B", "cluster-x"): 4}


def test_facts_are_stripped_scored_and_picked_without_regexes_over_every_sentence(spark):
    from pyspark.sql import functions as F
    from tidings.functions.text import PY_SPACES, py_strip, py_strip_valid
    from tidings.functions.urls import url_key
    from tidings.operators.facts import RULE_STRINGS, SCORE_RULES, pick_facts, rule_test, score_facts, split_sentences

    plan = lambda df: df._jdf.queryExecution().executedPlan().toString()
    texts = [None, "", " ", PY_SPACES, f"{PY_SPACES}a　b\x85{PY_SPACES}", "​x​", "a.\x01 b", ". ! ?", "né, 4:;", "Was? Ja!", "canción\n", "the tionment ,", "\x1fü. "]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "id long, text string")
    got = df.select("text", py_strip("text").alias("old"), py_strip_valid("text").alias("new"),
                    *[rule_test(F.col("text"), "regex", r).alias(f"n{i}") for i, r in enumerate(RULE_STRINGS)],
                    *[F.col("text").rlike(r).alias(f"o{i}") for i, r in enumerate(RULE_STRINGS)]).collect()
    for r in got:
        assert r.old == r.new == (None if r.text is None else r.text.strip())
        assert all(r[f"n{i}"] == r[f"o{i}"] for i in range(len(RULE_STRINGS)))
    assert set(RULE_STRINGS) <= {arg for _, kind, arg, _ in SCORE_RULES if kind == "regex"}
    cut = split_sentences(df)
    assert plan(cut).count("x{85}") == 0  # the strip's regex
    assert [(r.id, r._p, r.sentence) for r in cut.orderBy("id", "_p").collect() if r.id in (6, 7)] == [
        (6, 0, "a."), (6, 1, "b"), (7, 0, "."), (7, 1, "!"), (7, 2, "?")]
    urls = spark.createDataFrame([(u,) for u in [None, "", "x", "HTTP://A.b", "http://A.b?Q", "http://A.b/P", "http://A.b#F", "http://a.b/x\ny"]], "u string")
    keys = urls.select(url_key("u").alias("k"))
    assert plan(keys).count("regexp_extract") == 2
    assert [r.k for r in keys.collect()] == [None, "/", "/", "http://a.b/", "http://a.b/?Q", "http://a.b/P", "http://a.b/#F", "http://a.b/"]
    facts = spark.createDataFrame([("b", c, i, f"fact-{i}", t, f"https://x/{i}") for c, t in (("c", "Yes, 1."), ("d", "no"), ("e", "abc: d"), (None, "a, b")) for i in range(9)],
                                  "briefing_id string, cluster_id string, fact_idx long, fact_id string, text string, url string")
    picked, dropped = pick_facts(score_facts(facts))
    assert plan(picked).count("WindowGroupLimit") == 2  # before and after the shuffle: a task passes on its own best ones
    assert sorted((r.cluster_id, r.fact_idx, r.pick_rank) for r in picked.collect()) == [(c, i, i + 1) for c in "ce" for i in range(3)]
    assert dropped.count() == 30


def test_facts_of_their_own_items_url_are_verified_without_a_lookup(spark):
    from pyspark.sql import functions as F
    from tidings.operators import facts as operator

    looked_up, verify = [], operator.verify_evidence

    def counted(facts, items, **how):
        looked_up.append(facts.count())
        return verify(facts, items, **how)

    items = spark.createDataFrame([
        ("A", "c", 1, "One. Two. Three.", "https://a.example.com/1"), ("A", "c", 2, "Two. Four.", "HTTPS://B.example.com"), ("A", "d", 3, "Five.", None),
        ("B", "c", 1, "One. One.", "https://b.example.com/2"), (None, "c", 4, "Six.", "https://a.example.com/1"),
    ], "briefing_id string, cluster_id string, doc_id long, text string, url string")
    cites = F.when(F.col("_p") == 2, F.lit("https://b.example.com/")).when(F.col("doc_id") == 2, F.lit("https://elsewhere.example.com/")).otherwise(F.col("url"))
    operator.verify_evidence = counted
    try:
        facts, rejected = operator.extract_facts(items, fact_url=cites)
    finally:
        operator.verify_evidence = verify
    assert looked_up == [4]  # the third sentence, both of the second item, the one without a url
    assert sorted((r.briefing_id, r.fact_id, r.text, r.url) for r in facts.collect()) == [
        ("A", "fact-0", "One.", "https://a.example.com/1"), ("A", "fact-1", "Two.", "https://a.example.com/1"),
        ("A", "fact-2", "Three.", "https://b.example.com/"), ("B", "fact-0", "One.", "https://b.example.com/2")]
    assert sorted((r.briefing_id, r.item_id, r.pos, r.reason) for r in rejected.collect()) == [
        ("A", "2", 0, "duplicate"), ("A", "2", 1, "unverifiable"), ("A", "3", 0, "unverifiable"), ("B", "1", 1, "duplicate")]


def test_facts_travel_without_their_texts_and_are_numbered_in_their_ranges(spark):
    from tidings.operators.facts import candidate_facts, number_facts, score_facts, whole_facts

    items = spark.createDataFrame([(b, "c", i, f"Same one. Own {b} {i}, yes. Same two! Late {i % 3}.", f"https://x.example.com/{i}") for b in "AB" for i in (3, 1, 2, 2)]
                                  + [(None, "c", 9, "Nobody.", "https://x.example.com/9")],
                                  "briefing_id string, cluster_id string, doc_id long, text string, url string")
    candidates = candidate_facts(items, score=score_facts)
    numbered, rejected = number_facts(candidates, items, carry=["weighted_total"])
    assert not {"text", "url"} & set(numbered.columns)  # only numbers and keys are dealt and sorted
    got = sorted((r.briefing_id, r.fact_idx, r.doc_id, r.pos, r.text, r.weighted_total > 0) for r in whole_facts(numbered, candidates).collect())
    seen, want, n = set(), [], {"A": 0, "B": 0}
    for b in "AB":
        for i, p in sorted((i, p) for i in (1, 2, 2, 3) for p in range(4)):
            text = ["Same one.", f"Own {b} {i}, yes.", "Same two!", f"Late {i % 3}."][p]
            if (b, text) not in seen or (b, text, i, p) in seen:  # rows that share doc and place are all first
                want.append((b, n[b], i, p, text, True))
                n[b] += 1
                seen |= {(b, text), (b, text, i, p)}
    assert got == want
    assert {r.reason for r in rejected.collect()} == {"duplicate"}
    assert rejected.count() == 32 - len(want)


def test_picks_are_numbered_without_numbering_or_sorting_all_facts(spark):
    """Picks and numbers are those of a single-machine scan; a pick is a fact of one of the few best totals, and no range partition is made."""
    from tidings.operators.facts import PLACE, best_facts, number_kept, number_picks, pick_facts

    rows, seen = [], 0
    for b, c, n in (("en", "c1", 60), ("en", "c2", 5), ("de", "c1", 1), ("de", "c9", 8)):
        for i in range(n):
            low = c == "c9"
            rows.append((b, c, None if i == 3 else (i * 7) % n // 2, i % 3, seen, 4.0 if low else float(i * 5 % 4), 0 if low else 1, 0, f"t{seen}"))
            seen += 1
    kept = spark.createDataFrame(rows, "briefing_id string, cluster_id string, doc_id long, pos int, _row long, weighted_total double, "
                                       "actionability int, impact int, text string").repartition(5)
    want = []
    for key in sorted({r[:2] for r in rows}):
        facts = sorted((r for r in rows if r[:2] == key), key=lambda r: (r[2] is not None, r[2] or 0, r[3], r[4]))
        if any(r[6] > 0 or r[7] > 0 for r in facts):
            best = sorted(enumerate(facts), key=lambda x: (-x[1][5], x[0]))[:3]
            want += [(*key, rank, i, f"fact-{i}", r[8]) for rank, (i, r) in enumerate(best, 1)]
    picks = best_facts(kept, order=PLACE)
    got = number_picks(picks, kept)
    read = lambda df: sorted((r.briefing_id, r.cluster_id, r.pick_rank, r.fact_idx, r.fact_id, r.text) for r in df.collect())
    assert read(got) == want and len(want) == 7
    numbered = number_kept(kept)
    picked, dropped = pick_facts(numbered)
    assert read(picked) == want
    assert sorted((r.briefing_id, r.cluster_id, r.reason) for r in dropped.collect()) == sorted(
        [("en", "c1", "not in top picks")] * 57 + [("en", "c2", "not in top picks")] * 2 + [("de", "c9", "low value")] * 8)
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert "RepartitionByExpression" not in plan


def test_the_digest_picks_without_numbering_every_fact(spark, monkeypatch, tmp_path):
    from tidings.plans import digest

    docs = [(i, f"Alpha {i}, beta. Gamma! Delta {i}?", "en", f"src{i % 2}") for i in range(1, 9)]
    spark.createDataFrame(docs, "doc_id long, text string, lang string, source string").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(1, 1, 0)], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    monkeypatch.setattr(digest, "number_kept", lambda kept: (_ for _ in ()).throw(AssertionError("all facts are numbered")))
    picked = digest.digest_tables(spark, str(tmp_path))["picked"]
    assert sorted((r.cluster_id, r.pick_rank, r.fact_id, r.text) for r in picked.collect()) == [
        ("cluster-src0", 1, "fact-0", "Alpha 2, beta."), ("cluster-src0", 2, "fact-3", "Alpha 4, beta."), ("cluster-src0", 3, "fact-5", "Alpha 6, beta."),
        ("cluster-src1", 1, "fact-0", "Alpha 1, beta."), ("cluster-src1", 2, "fact-3", "Alpha 3, beta."), ("cluster-src1", 3, "fact-5", "Alpha 5, beta.")]
