"""Physical-plan audit of every registered query -> markdown table.

    python tools/plan_report.py [--sf /root/testdata/sf0.1] > PLANS.md

Counts, per query, in the executed (adaptive, final) plan: shuffle
exchanges, single-partition exchanges, broadcast exchanges, join kinds,
windows, Python evaluation nodes and scans with pushed filters.  Each
query is run once (noop write) so the adaptive plan is final.
"""

from __future__ import annotations

import argparse
import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from basketry.plans.registry import all_queries  # noqa: E402
from basketry.plans.session import local_session  # noqa: E402

PATTERNS = {
    "shuffle": r"Exchange hashpartitioning|Exchange rangepartitioning|Exchange RoundRobin|Exchange REBALANCE",
    "single": r"Exchange SinglePartition",
    "subq": r"Subquery subquery",
    "bcast": r"BroadcastExchange",
    "smj": r"SortMergeJoin",
    "bhj": r"BroadcastHashJoin",
    "nlj": r"BroadcastNestedLoopJoin|CartesianProduct",
    "window": r"\bWindow\b",
    "python": r"BatchEvalPython|ArrowEvalPython|FlatMapGroupsInPandas|MapInPandas",
    "pushed": r"PushedFilters: \[[^\]]+\]",
}


def final_only(text: str) -> str:
    """The plan text without the initial plans that adaptive execution prints beside the final ones."""
    out, skip = [], None
    for line in text.split("\n"):
        depth = len(line) - len(line.lstrip(" :+-*|"))
        if "== Initial Plan ==" in line:
            skip = depth
            continue
        if skip is not None and (depth > skip or depth == skip and "== " not in line):
            continue
        skip = None
        out.append(line)
    return "\n".join(out)


def main():
    ap = argparse.ArgumentParser()
    ap.add_argument("--sf", default="/root/testdata/sf0.1")
    ap.add_argument("names", nargs="*")
    a = ap.parse_args()
    spark = local_session()
    qs = all_queries()
    intro = os.path.join(os.path.dirname(os.path.abspath(__file__)), "plans_intro.md")
    if os.path.exists(intro):
        print(open(intro).read())
    print(f"## Per-query audit at {a.sf}\n")
    print("Final adaptive plans (each query run once). `shuffle` = hash/range/rebalance exchanges, "
          "`single` = exchanges into one partition (partial results of global aggregates, one row per task, "
          "or calendar-, store- or model-sized tables), `subquery` = scalar subqueries, "
          "`bcast` = broadcast exchanges (size-checked by Spark or bounded by construction), "
          "`python` = Python evaluation nodes (none).  Subquery plans are included.\n")
    print("| query | ids | shuffle | single | subquery | bcast | SMJ | BHJ | NLJ | window | python | pushed filters |")
    print("|---|---|---|---|---|---|---|---|---|---|---|---|")
    for name in a.names or sorted(qs):
        df = qs[name].fn(spark, a.sf)
        df.collect()  # runs this QueryExecution, so its adaptive plan becomes final
        text = df._jdf.queryExecution().explainString(
            spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("simple"))
        text = final_only(text)
        c = {k: len(re.findall(p, text)) for k, p in PATTERNS.items()}
        print(f"| {name} | {qs[name].ids} | {c['shuffle']} | {c['single']} | {c['subq']} | {c['bcast']} | {c['smj']} | "
              f"{c['bhj']} | "
              f"{c['nlj']} | {c['window']} | {c['python']} | {c['pushed']} |")


if __name__ == "__main__":
    main()
