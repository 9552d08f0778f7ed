"""Summarise the physical plan of every registered batch query.

Usage: python tests/plan_report.py [sf_dir]
Plans are built with automatic broadcasting off, which approximates the plan
at a scale where no table fits under the broadcast threshold (explicit,
size-proven broadcasts stay).  Prints a markdown table of operator counts.
"""

from __future__ import annotations

import re
import sys

sys.path.insert(0, __file__.rsplit("/tests/", 1)[0])

from livemart.plans.catalog import QUERIES  # noqa: E402
from livemart.session import build_session  # noqa: E402

OPS = ("Exchange hashpartitioning", "Exchange rangepartitioning", "Exchange SinglePartition",
       "BroadcastExchange", "SortMergeJoin", "BroadcastHashJoin", "HashAggregate",
       "ObjectHashAggregate", "SortAggregate", "Expand", "Window", "TakeOrderedAndProject",
       "CartesianProduct", "BroadcastNestedLoopJoin")


def summary(plan: str) -> dict:
    body = plan.split("== Physical Plan ==")[-1]
    out = {op: len(re.findall(re.escape(op), body)) for op in OPS}
    out["scans"] = len(re.findall(r"FileScan parquet", body))
    return out


def main(argv):
    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.1"
    spark = build_session("local[8]", 8, extra={"spark.sql.autoBroadcastJoinThreshold": "-1",
                                               "spark.sql.adaptive.enabled": "false"})
    cols = ("scans", "Exchange hashpartitioning", "BroadcastExchange", "SortMergeJoin",
            "BroadcastHashJoin", "HashAggregate", "ObjectHashAggregate", "SortAggregate",
            "TakeOrderedAndProject", "Expand", "Window", "CartesianProduct")
    short = ("scans", "shuffles", "bcast", "SMJ", "BHJ", "HashAgg", "ObjHashAgg", "SortAgg",
             "TopK", "Expand", "Window", "Cartesian")
    print("| query | " + " | ".join(short) + " |")
    print("| --- |" + " --- |" * len(short))
    for name, fn in QUERIES.items():
        plan = fn(spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
        s = summary("== Physical Plan ==\n" + plan)
        print(f"| `{name}` | " + " | ".join(str(s[c]) for c in cols) + " |", flush=True)


if __name__ == "__main__":
    main(sys.argv)
