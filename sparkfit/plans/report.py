"""Summarize the physical plan of every query key as a Markdown table.

    python -m sparkfit.plans.report /root/testdata/sf0.01 > PLANS.md

Counts come from each returned DataFrame's physical plan as planned (AQE may
still coalesce partitions or turn a sort-merge join into a broadcast at run
time): shuffles, broadcasts, join kinds, windows, generators, and the columns
each Parquet scan reads.
"""

from __future__ import annotations

import re
import sys

from sparkfit.plans.queries import QUERIES
from sparkfit.session import build_session


def summarize(plan: str) -> dict[str, object]:
    scans = sorted(set(re.findall(r"ReadSchema: struct<([^>]*)>", plan)))
    return {
        "shuffles": len(re.findall(r"Exchange hashpartitioning|Exchange rangepartitioning|"
                                   r"Exchange SinglePartition|Exchange RoundRobin", plan)),
        "broadcasts": plan.count("BroadcastExchange"),
        "joins": ", ".join(sorted({j for j in re.findall(
            r"(BroadcastHashJoin|SortMergeJoin|ShuffledHashJoin|BroadcastNestedLoopJoin|"
            r"CartesianProduct)", plan)})) or "-",
        "windows": plan.count("Window ["),
        "generators": plan.count("Generate "),
        "scans": "; ".join(scans) or "-",
    }


def main(sf_dir: str) -> None:
    spark = build_session("local[8]", 8, app_name="sparkfit-plans")
    print(f"# Physical plans at `{sf_dir}`\n")
    print("Generated by `python -m sparkfit.plans.report <sf_dir>` (AQE on, 8 shuffle "
          "partitions), from each returned DataFrame's physical plan before AQE re-planning. "
          "Keys that cut lineage (positions, logistic steps, SVM metrics) show the plan over "
          "their written tables. Shuffles count hash, range and single-partition exchanges; "
          "scans list the columns each Parquet read asks for.\n")
    print("| key | shuffles | broadcasts | joins | windows | generators | scan columns |")
    print("|---|---|---|---|---|---|---|")
    for key, fn in QUERIES.items():
        df = fn(spark, sf_dir)
        df.write.format("noop").mode("overwrite").save()
        s = summarize(df._jdf.queryExecution().executedPlan().toString())
        print(f"| `{key}` | {s['shuffles']} | {s['broadcasts']} | {s['joins']} | {s['windows']} | "
              f"{s['generators']} | {s['scans']} |")
    spark.stop()


if __name__ == "__main__":
    main(sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01")
