"""Physical-plan report for every registered query (run after correctness is green).

Usage: python tests/plan_report.py [sf_dir] > PLANS.md
Counts shuffles, broadcasts, join strategies, windows and Python evaluation in the
plan before adaptive re-planning, and lists what each parquet scan reads.
"""

from __future__ import annotations

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

NODES = ["Exchange hashpartitioning", "Exchange rangepartitioning", "Exchange RoundRobin", "BroadcastExchange",
         "SortMergeJoin", "BroadcastHashJoin", "ShuffledHashJoin", "BroadcastNestedLoopJoin", "CartesianProduct",
         "Window", "ArrowEvalPython", "BatchEvalPython", "InMemoryTableScan"]


def final_plan(df) -> str:
    df.write.format("noop").mode("overwrite").save()
    return df._jdf.queryExecution().executedPlan().toString()


def strip_cached(plan: str) -> str:
    """Drop the bodies of cached relations (the index is built once, not per query)."""
    out, skip = [], None
    for line in plan.split("\n"):
        indent = len(line) - len(line.lstrip(" :+-"))
        if skip is not None and indent > skip:
            continue
        skip = None
        out.append(line)
        if "InMemoryRelation" in line:
            skip = indent
    return "\n".join(out)


def main() -> None:
    import __spark_entry__ as E
    from webloom.session import get_session
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = get_session()
    print(f"# Physical plans ({sf}, as planned before adaptive re-planning; cached index bodies omitted)\n")
    print("| query | " + " | ".join(n.replace("Exchange ", "X ") for n in NODES) + " | scans (ReadSchema) |")
    print("|" + "---|" * (len(NODES) + 2))
    for name, q in E.queries().items():
        plan = strip_cached(final_plan(q(spark, sf)))
        counts = [str(plan.count(n)) for n in NODES]
        scans = sorted(set(re.findall(r"ReadSchema: (struct<[^>]*>)", plan)))
        print(f"| {name} | " + " | ".join(counts) + " | " + "<br>".join(s.replace("|", "/") for s in scans) + " |")


if __name__ == "__main__":
    main()
