"""Audit the physical plans of every registered query: no cartesian products or nested-loop joins,
number of shuffles, Python stages. usage: python scripts/plan_audit.py [sf_dir]"""

from __future__ import annotations

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tidings.plans import QUERIES, load_all  # noqa: E402
from tidings.session import local_session  # noqa: E402


def main():
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.001"
    load_all()
    spark = local_session(4)
    spark.conf.set("spark.sql.adaptive.enabled", "false")  # show the static plan Catalyst chose
    bad = 0
    for name in sorted(QUERIES):
        plan = QUERIES[name](spark, sf)._jdf.queryExecution().executedPlan().toString()
        cart = bool(re.search(r"CartesianProduct|BroadcastNestedLoopJoin", plan))
        shuffles = len(re.findall(r"Exchange (hashpartitioning|rangepartitioning|SinglePartition|RoundRobin)", plan))
        single = "SinglePartition" in plan
        py = bool(re.search(r"FlatMapGroupsInPandas|MapInPandas|ArrowEvalPython|BatchEvalPython", plan))
        scan_filters = re.findall(r"PushedFilters: \[([^\]]*)\]", plan)
        bad += cart
        print(f"{name:24s} cartesian={cart!s:5s} shuffles={shuffles:2d} single_partition={single!s:5s} python={py!s:5s} "
              f"pushed={[f for f in scan_filters if f][:2]}")
    print(f"queries with cartesian/nested-loop joins: {bad}")


if __name__ == "__main__":
    main()
