"""Summarize the physical plan of every registered query as a markdown table.

Usage: python tools/plan_report.py [sf_dir] > PLANS.md

Counts, from the planned (pre-AQE) physical plan: shuffles (hash / single /
round-robin exchanges), broadcast exchanges, join strategies, window and
partial group-limit operators, and scans with pushed filters.  AQE may still
turn shuffle joins into broadcast joins at runtime from actual sizes.
"""

from __future__ import annotations

import os
import re
import sys
from unittest.mock import patch

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from quayside.plans.queries import QUERIES  # noqa: E402
from quayside.session import local_session  # noqa: E402
from quayside.sources.sinks import write_once  # noqa: E402

JOINS = ["SortMergeJoin", "BroadcastHashJoin", "ShuffledHashJoin", "BroadcastNestedLoopJoin", "CartesianProduct"]


def dedup_cached(lines: list[str]) -> list[str]:
    """Keep the subtree under each distinct cached relation once (it is computed once)."""
    depth = lambda x: len(x) - len(x.lstrip(" :+-"))
    out, seen, i = [], set(), 0
    while i < len(lines):
        line = lines[i]
        out.append(line)
        if "InMemoryRelation" in line:
            j = i + 1
            while j < len(lines) and depth(lines[j]) > depth(line):
                j += 1
            sub = [x.strip(" :+-") for x in lines[i + 1:j]]
            key = "\n".join(re.sub(r"#\d+L?|plan_id=\d+", "", x) for x in sub)
            if key in seen:
                i = j
                continue
            seen.add(key)
        i += 1
    return out


def summarize(plan: str) -> dict:
    lines = dedup_cached(plan.split("\n"))
    body = [x.strip(" :+-") for x in lines]
    shuffles = sum(1 for x in body if x.startswith("Exchange ") and "SinglePartition" not in x)
    singles = sum(1 for x in body if x.startswith("Exchange SinglePartition"))
    joins = {j: sum(1 for x in body if x.startswith(j)) for j in JOINS}
    scans = [x for x in body if x.startswith("FileScan parquet")]
    pushed = sum(1 for x in scans if re.search(r"PushedFilters: \[[^\]]+\]", x))
    tables = sorted({m.group(1) for x in scans for m in [re.search(r"/([a-z]+)\.parquet", x)] if m})
    return {
        "shuffles": shuffles, "single": singles,
        "broadcasts": sum(1 for x in body if x.startswith("BroadcastExchange")),
        "smj": joins["SortMergeJoin"], "bhj": joins["BroadcastHashJoin"] + joins["ShuffledHashJoin"],
        "nlj": joins["BroadcastNestedLoopJoin"] + joins["CartesianProduct"],
        "windows": sum(1 for x in body if x.startswith("Window ")),
        "partial_limit": sum(1 for x in body if x.startswith("WindowGroupLimit") and x.endswith("Partial")),
        "scans": len(scans), "pushed": pushed, "tables": ",".join(tables),
    }


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def main(argv):
    sf = argv[1] if len(argv) > 1 else "/root/testdata/sf0.1"
    spark = local_session(8, 8)
    print("# PLANS — physical plan shape of every registered query\n")
    print(f"Generated by `python tools/plan_report.py {sf}` (planned physical plans, before AQE re-planning).")
    print("Shuffles = hash/round-robin exchanges; single = exchanges to one partition (global aggregates of the "
          "calendar span); SMJ / BHJ = sort-merge / broadcast-hash joins; NLJ = nested-loop or cartesian "
          "(must be 0); partial = `WindowGroupLimit` applied before the shuffle (latest-per-key); pushed = "
          "Parquet scans with pushed filters.  A persisted relation, if any, "
          "is counted once, and sub-results that a query writes once count with it.  Most scans come from the test-table binding, which derives every input of the "
          "decision job from `lineitem` joins.\n")
    print("| Query | shuffles | single | broadcasts | SMJ | BHJ | NLJ | windows | partial limits | scans (pushed) | tables |")
    print("| --- | --- | --- | --- | --- | --- | --- | --- | --- | --- | --- |")
    for name, fn in QUERIES.items():
        plans: list[str] = []

        def written(df, what):
            plans.append(plan_of(df))
            return write_once(df, what)

        with patch("quayside.plans.jobs.write_once", written), patch("quayside.operators.dimension.write_once", written):
            plans.append(plan_of(fn(spark, sf)))
        s = {}
        for part in map(summarize, plans):
            for k, v in part.items():
                s[k] = s[k] + v if k in s and k != "tables" else ",".join(sorted({*s[k].split(","), *v.split(",")} - {""})) if k in s else v
        print(f"| `{name}` | {s['shuffles']} | {s['single']} | {s['broadcasts']} | {s['smj']} | {s['bhj']} | "
              f"{s['nlj']} | {s['windows']} | {s['partial_limit']} | {s['scans']} ({s['pushed']}) | {s['tables']} |")
    spark.stop()


if __name__ == "__main__":
    main(sys.argv)
