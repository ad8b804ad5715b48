"""Summarise the physical plan of every registered query (PLANS.md).

Usage: python tools/plan_report.py [sf_dir] > PLANS.md
For each query: shuffles (Exchange), broadcasts, joins, partial aggregates,
scanned columns and pushed filters, read from the executed plan.
"""

from __future__ import annotations

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from cropscope.plans import QUERIES  # noqa: E402
from cropscope.session import build_session  # noqa: E402


def summarize(plan: str) -> dict:
    scans = re.findall(r"FileScan parquet [^\[]*\[([^\]]*)\]", plan)
    pushed = [p for p in re.findall(r"PushedFilters: \[([^\]]*)\]", plan) if p]
    return {
        "exchanges": len(re.findall(r"Exchange (hashpartitioning|rangepartitioning|SinglePartition|RoundRobin)", plan)),
        "broadcasts": plan.count("BroadcastExchange"),
        "joins": sorted(set(re.findall(r"(BroadcastHashJoin|SortMergeJoin|ShuffledHashJoin|BroadcastNestedLoopJoin|CartesianProduct)", plan))),
        "partial_aggs": len(re.findall(r"HashAggregate\(keys=\[[^\]]*\], functions=\[partial_", plan)),
        "window_limit": "WindowGroupLimit" in plan,
        "generate": "Generate" in plan,
        "scans": [", ".join(sorted({c.split("#")[0] for c in s.split(",")})) for s in scans],
        "pushed": pushed,
    }


def main() -> None:
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = build_session()
    print("# Physical plans of the registered queries\n")
    print(f"Generated by `tools/plan_report.py` on `{sf}` (AQE initial plans; "
          "queries with an iterative or eager part show the plan of their final step).\n")
    print("| query | shuffles | broadcasts | joins | partial aggs | notes | scanned columns |")
    print("| --- | --- | --- | --- | --- | --- | --- |")
    for name, q in QUERIES.items():
        df = q(spark, sf)
        s = summarize(df._jdf.queryExecution().executedPlan().toString())
        notes = []
        if s["window_limit"]:
            notes.append("WindowGroupLimit")
        if s["generate"]:
            notes.append("Generate")
        if s["pushed"]:
            notes.append("pushed: " + "; ".join(s["pushed"])[:80])
        print(f"| `{name}` | {s['exchanges']} | {s['broadcasts']} | {', '.join(s['joins']) or '-'} | "
              f"{s['partial_aggs']} | {', '.join(notes) or '-'} | {' / '.join(s['scans'])[:160]} |")
    spark.stop()


if __name__ == "__main__":
    main()
