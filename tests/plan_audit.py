"""Physical-plan audit of every registered query (final adaptive plans).

Usage: python tests/plan_audit.py [sf_dir] [name ...]
Counts shuffles, broadcasts, join strategies and windows; flags nested-loop
joins, cartesian products and Python evaluation, which should never appear.
"""

from __future__ import annotations

import re
import sys
import time

sys.path.insert(0, __file__.rsplit("/tests/", 1)[0])

from __spark_entry__ import queries  # noqa: E402
from planpulse.session import build_session  # noqa: E402

PATTERNS = {
    "shuffle": r"\bExchange hashpartitioning|\bExchange rangepartitioning|\bExchange SinglePartition|\bExchange RoundRobin",
    "single_partition": r"Exchange SinglePartition",
    "reused": r"ReusedExchange|ReusedQueryStage|ReusedSubquery",
    "broadcast": r"BroadcastExchange",
    "smj": r"SortMergeJoin",
    "bhj": r"BroadcastHashJoin",
    "bnlj": r"BroadcastNestedLoopJoin",
    "cartesian": r"CartesianProduct",
    "window": r"\bWindow \[",
    "group_limit": r"WindowGroupLimit",
    "python": r"ArrowEvalPython|BatchEvalPython|FlatMapGroupsInPandas|MapInPandas",
    "scan": r"FileScan|Scan ExistingRDD|Scan parquet",
}


def final_plan(df) -> str:
    """The adaptive plan's final section (the string also carries the initial plan)."""
    text = df._jdf.queryExecution().executedPlan().toString()
    return text.split("== Initial Plan ==")[0]


def main():
    d = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    names = sys.argv[2:]
    spark = build_session("local[8]", 16)
    bad = 0
    for name, fn in queries().items():
        if names and name not in names:
            continue
        t0 = time.time()
        df = fn(spark, d)
        df.collect()                 # runs this DataFrame's own QueryExecution -> final AQE plan
        plan = final_plan(df)
        counts = {k: len(re.findall(p, plan)) for k, p in PATTERNS.items()}
        flags = [k for k in ("bnlj", "cartesian", "python", "single_partition") if counts[k]]
        bad += bool(flags)
        print(f"{name:22s} {time.time()-t0:6.1f}s " + " ".join(f"{k}={v}" for k, v in counts.items())
              + (f"  FLAG {flags}" if flags else ""))
    print("FLAGGED:", bad)


if __name__ == "__main__":
    main()
