"""Summarise the physical plan of every registered query → docs/PLANS.md.

    python scripts/plan_summary.py [sf_dir]

Two settings per query: the session defaults (small test files → broadcast joins chosen
from file statistics) and broadcasts disabled, which is the shape a large cluster gets
when no side is small (sort-merge joins, shuffles on the join keys). Counts come from
``explain("formatted")``.
"""

from __future__ import annotations

import contextlib
import io
import os
import re
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

from pitwall.plans import catalog  # noqa: E402
from pitwall.session import get_spark  # noqa: E402

OPS = ("Exchange", "BroadcastExchange", "BroadcastHashJoin", "SortMergeJoin",
       "ShuffledHashJoin", "BroadcastNestedLoopJoin", "CartesianProduct", "HashAggregate",
       "ObjectHashAggregate", "SortAggregate", "Window", "Generate", "Scan parquet",
       "TakeOrderedAndProject", "Union")


def plan_text(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()


def summary(text: str) -> dict[str, int]:
    tree = text.split("\n\n\n")[0]
    counts = {}
    for op in OPS:
        n = len(re.findall(rf"[-+] {re.escape(op)}(?: |\(|$)", tree, flags=re.M))
        if op == "Exchange":
            n = len(re.findall(r"[-+] Exchange \(", tree))
        if n:
            counts[op] = n
    counts["PushedFilters"] = text.count("PushedFilters: [I")  # non-empty pushed filter lists
    return counts


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = get_spark("local[8]", 16)
    rows = []
    for mode, conf in (("default", {}), ("no-broadcast", {
            "spark.sql.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1"})):
        for k, v in conf.items():
            spark.conf.set(k, v)
        for name in catalog.QUERIES:
            # a fresh Dataset on top, so the plan is made under the current settings
            s = summary(plan_text(catalog.run(name, spark, sf_dir).select("*")))
            rows.append((name, mode, s))
        for k in conf:
            spark.conf.unset(k)
    out = ["# Physical plans of the registered queries", "",
           "Generated by `scripts/plan_summary.py` from `explain(\"formatted\")` (initial plans;",
           "AQE may still coalesce partitions, convert joins to broadcast when a side is measured",
           "small, or split skewed partitions at run time). `Exchange` = shuffle;",
           "`PushedFilters` = scans with filters pushed into Parquet.", "",
           "| query | settings | operators |", "| --- | --- | --- |"]
    for name, mode, s in sorted(rows):
        ops = ", ".join(f"{k} {v}" for k, v in s.items())
        out.append(f"| {name} | {mode} | {ops} |")
    os.makedirs(f"{ROOT}/docs", exist_ok=True)
    with open(f"{ROOT}/docs/PLANS.md", "w") as fh:
        fh.write("\n".join(out) + "\n")
    spark.stop()


if __name__ == "__main__":
    main()
