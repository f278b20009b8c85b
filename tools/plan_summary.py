"""Summarise the physical plans of registered queries (after execution, AQE final).

Usage: python tools/plan_summary.py [sf_dir] [name ...]  -> markdown on stdout
"""

from __future__ import annotations

import os
import re
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

from bench import HEADLINE  # noqa: E402


def final_section(plan: str) -> str:
    """AQE prints the final and the initial plan; keep the final one."""
    if "== Final Plan ==" in plan:
        plan = plan.split("== Final Plan ==", 1)[1]
        plan = plan.split("== Initial Plan ==", 1)[0]
    return plan


def summarise(plan: str) -> dict:
    plan = final_section(plan)
    scans = []
    for m in re.finditer(r"FileScan parquet \[([^\]]*)\].*?Location: \w+\(\d+ paths?\)\[([^\]]*)\]"
                         r".*?PushedFilters: \[([^\]]*)\]", plan):
        cols, loc, pushed = m.groups()
        scans.append((os.path.basename(loc.rstrip("/")), len(cols.split(",")), pushed[:60]))
    count = lambda pat: len(re.findall(pat, plan))
    return {
        "exchanges": count(r"\bExchange hashpartitioning|\bExchange rangepartitioning|\bExchange SinglePartition|\bExchange RoundRobin"),
        "reused": count(r"ReusedExchange"),
        "broadcast_joins": count(r"BroadcastHashJoin"),
        "sort_merge_joins": count(r"SortMergeJoin"),
        "windows": count(r"\bWindow \["),
        "partial_aggs": count(r"functions=\[partial_"),
        "scans": scans,
    }


def main(argv):
    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.1"
    names = argv[2:] or HEADLINE
    from msgtriage.plans.catalog import REGISTRY
    from msgtriage.session import get_session

    spark = get_session("local[8]", shuffle_partitions=16)
    print(f"| query | exchanges | reused | broadcast joins | sort-merge joins | windows | partial aggs | scans (file: columns read, pushed filters) |")
    print("| --- | --- | --- | --- | --- | --- | --- | --- |")
    for name in names:
        df = REGISTRY[name].fn(spark, sf_dir)
        df.collect()
        plan = df._jdf.queryExecution().executedPlan().toString()
        s = summarise(plan)
        scans = "; ".join(f"{f}: {n} cols, [{p}]" for f, n, p in s["scans"])
        print(f"| {name} | {s['exchanges']} | {s['reused']} | {s['broadcast_joins']} | "
              f"{s['sort_merge_joins']} | {s['windows']} | {s['partial_aggs']} | {scans} |", flush=True)


if __name__ == "__main__":
    main(sys.argv)
