"""Scans and exchanges that a query really ran: counted in the final adaptive plan, reused exchanges once.

Sub-results that a query writes once (``write_once``) count with the query that writes them.

Usage: python tools/executed_scans.py [sf_dir] [name ...]
"""

from __future__ import annotations

import os
import re
import sys
from collections import Counter
from unittest.mock import patch

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from quayside.plans.queries import QUERIES  # noqa: E402
from quayside.session import local_session  # noqa: E402
from quayside.sources.sinks import write_once  # noqa: E402


def executed(build) -> Counter:
    """Counts of ``build()``, a function that returns a DataFrame, with those of what it writes once."""
    total: Counter = Counter()

    def counted(df, name):
        total.update(_of_plan(df))
        total["written"] += 1
        return write_once(df, name)

    with patch("quayside.plans.jobs.write_once", counted), patch("quayside.operators.dimension.write_once", counted):
        total.update(_of_plan(build()))
    return total


def _of_plan(df) -> Counter:
    df.collect()  # the same query execution then holds the final plan
    plan = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    body = [x.strip(" :+-*") for x in plan.split("\n")]
    body = [re.sub(r"^\(\d+\) ", "", x) for x in body]
    count = Counter(f"scan {m.group(1)}" for x in body if x.startswith("FileScan parquet")
                    for m in [re.search(r"/([a-z]+)\.parquet", x)] if m)
    count["shuffles"] = sum(x.startswith("Exchange ") for x in body)
    count["broadcasts"] = sum(x.startswith("BroadcastExchange") for x in body)
    count["reused"] = sum(x.startswith("ReusedExchange") for x in body)
    return count


if __name__ == "__main__":
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = local_session(8, 8)
    for name in sys.argv[2:] or QUERIES:
        c = executed(lambda n=name: QUERIES[n](spark, sf))
        print(f"| {name} | {c['scan lineitem']} | {c['scan orders']} | {c['shuffles']} | {c['broadcasts']} | {c['reused']} |")
    spark.stop()
