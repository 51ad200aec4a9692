"""Summarise the final physical plan of every registered query over the
reference's operators (after execution): exchanges, join strategies, Python nodes
and scan widths.

usage: python tools/plan_report.py [sf_dir] > PLANS.md
"""

from __future__ import annotations

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from keyreport.plans.catalog import QUERIES, delay_table_rows  # noqa: E402
from keyreport.session import build_session  # noqa: E402

PYTHON = ("BatchEvalPython", "ArrowEvalPython", "MapInPandas", "MapInArrow", "AggregateInPandas", "FlatMapGroupsInPandas")


def summary(plan: str) -> dict:
    joins = re.findall(r"(BroadcastHashJoin|SortMergeJoin|ShuffledHashJoin|BroadcastNestedLoopJoin|"
                       r"CartesianProduct)", plan)
    schemas = re.findall(r"ReadSchema: struct<([^>]*)>", plan)
    widths = [len(s.split(",")) for s in schemas]
    return {
        "exchanges": len(re.findall(r"Exchange hashpartitioning|Exchange SinglePartition|"
                                    r"Exchange RoundRobinPartitioning|Exchange rangepartitioning", plan)),
        "broadcasts": plan.count("BroadcastExchange"),
        "joins": ", ".join(f"{j}×{joins.count(j)}" for j in sorted(set(joins))) or "—",
        "partial agg": "yes" if "partial_" in plan else "—",
        "python": ", ".join(sorted({p for p in PYTHON if p in plan})) or "—",
        "scan cols": "/".join(map(str, widths)) or "—",
        "pushed": "yes" if re.search(r"PushedFilters: \[[^\]]+\]", plan) else "—",
    }


def main() -> None:
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    spark = build_session("local[8]", 8, conf={"spark.sql.adaptive.autoBroadcastJoinThreshold": "-1"})
    print(f"# Physical plans of the registered queries\n\nGenerated by `tools/plan_report.py {sf}`: the final "
          "plan of each query after it ran, with runtime broadcasts off (as at scale). Queries that write "
          "first (streams, files) show the plan of reading their output; `delay_table (before its write)` is "
          "the frame that `delay_table` writes.\n")
    cols = ["exchanges", "broadcasts", "joins", "partial agg", "python", "scan cols", "pushed"]
    print("| query | " + " | ".join(cols) + " |")
    print("|---|" + "---|" * len(cols))
    for name, fn in [*QUERIES.items(), ("delay_table (before its write)", delay_table_rows)]:
        df = fn(spark, sf)
        df.collect() if name == "first_rows" else df._jdf.queryExecution().executedPlan().execute().count()
        plan = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
        s = summary(plan)
        print(f"| `{name}` | " + " | ".join(str(s[c]) for c in cols) + " |")
    spark.stop()


if __name__ == "__main__":
    main()
