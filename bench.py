"""Benchmark: run the headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; print one JSON line.

Each query is fully executed once with the ``noop`` sink (no driver collect); times are wall seconds. Every
query builds all its stages itself: nothing is kept from one query to the next, and the stage tables that it wrote
are deleted before the next one starts. ``digest_chain`` times the finished digests, their Markdown and the run
metrics from one shared digest object, as a run that wants all three would build them.
Before timing, one untimed generic job (a range aggregate and an Arrow round trip, no registered query)
starts the session's JVM code paths and Python worker pool, a fixed start-up cost of any session.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "time_window", "window_report", "clean_html", "redact_secrets", "split_messages", "pack_batches",
    "cosine_pairs", "near_dup_vectors", "density_cluster", "top_k_centroid", "medoids",
    "near_dup_text", "rerank_bm25", "extract_facts", "pick_facts", "finalize_briefing", "render_markdown",
    "run_metrics",
]


def _warm_up(spark):
    import pandas as pd

    df = spark.range(0, 200000, numPartitions=8).selectExpr("id", "id % 97 AS k", "cast(id AS string) AS s")
    df.groupBy("k").agg({"id": "sum", "s": "max"}).collect()

    def ident(it):
        for pdf in it:
            yield pd.DataFrame({"k": pdf["k"]})

    df.mapInPandas(ident, schema="k long").write.format("noop").mode("overwrite").save()


def _digest_chain(spark, sf_dir):
    from tidings.operators.briefing import run_metrics
    from tidings.operators.render import render_markdown
    from tidings.plans.digest import digest_tables
    from tidings.plans.outputs import _titles

    t0 = time.time()
    t = digest_tables(spark, sf_dir)
    topics, bullets, _ = t["published"]
    for df in (topics, render_markdown(topics, bullets, _titles(topics)),
               run_metrics(t["bundles"], t["scored"], t["picked"], t["dropped"], t["drafts"], t["final"])):
        df.write.format("noop").mode("overwrite").save()
    return time.time() - t0


def main():
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    from tidings.plans import QUERIES, load_all
    from tidings.session import local_session, release_all

    spark = local_session(cpus, shuffle_partitions=int(os.environ.get("BENCH_SHUFFLE_PARTITIONS", "16")), app="tidings-bench")
    load_all()
    _warm_up(spark)
    names = [n for n in (sys.argv[1:] or HEADLINE) if n in QUERIES]
    times = {}
    for n in names:
        t0 = time.time()
        QUERIES[n](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[n] = round(time.time() - t0, 3)
        release_all(spark)
        print(f"bench {n}: {times[n]}s", file=sys.stderr, flush=True)
    shared = None if sys.argv[1:] else round(_digest_chain(spark, sf_dir), 3)
    sf = sf_dir.rstrip("/").split("sf")[-1]
    print(json.dumps({"metric": "headline_queries_total_sec", "value": round(sum(times.values()), 3), "unit": "sec",
                      "queries": times, "digest_chain": shared, "sf": float(sf) if sf.replace(".", "").isdigit() else sf}))


if __name__ == "__main__":
    main()
