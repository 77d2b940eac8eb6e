"""Summarise the final (post-AQE) physical plan of every registered query.

Usage: python tools/plan_report.py [sf_dir] > PLANS.md

Per query: table scans with the columns read and filters pushed into the
reader, shuffle exchanges, broadcasts, joins, windows, sorts, aggregates and
whether any Python evaluation appears.
"""

from __future__ import annotations

import os
import re
import sys
from collections import Counter

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)


def final_plan(df) -> str:
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]


def summarise(plan: str) -> dict:
    scans = []
    for line in plan.splitlines():
        m = re.search(r"FileScan parquet \[([^\]]*)\].*?Location: \w+\(\d+ paths?\)\[([^\]]*)\]", line)
        if m:
            pushed = re.search(r"PushedFilters: (\[[^\]]*\])", line)
            cols = [re.sub(r"#\d+L?$", "", c) for c in m.group(1).split(",")]
            where = m.group(2)
            table = re.search(r"/(\w+)\.parquet$", where)
            scans.append((table.group(1) if table else "written table", cols, pushed.group(1) if pushed else "[]"))
    nodes = Counter()
    for pattern, name in (
        (r"Exchange hashpartitioning|Exchange rangepartitioning|Exchange SinglePartition|Exchange RoundRobin", "shuffle"),
        (r"BroadcastExchange", "broadcast"),
        (r"BroadcastHashJoin", "broadcast_join"),
        (r"SortMergeJoin", "sort_merge_join"),
        (r"ShuffledHashJoin", "shuffled_hash_join"),
        (r"BroadcastNestedLoopJoin|CartesianProduct", "nested_loop_or_cartesian"),
        (r"\bWindow \[", "window"),
        (r"\bSort \[", "sort"),
        (r"HashAggregate\(keys=\[[^\]]*\], functions=\[[^\]]*partial_", "partial_agg"),
        (r"ReusedExchange", "reused_exchange"),
        (r"BatchEvalPython|ArrowEvalPython|MapInPandas|FlatMapGroupsInPandas", "python"),
    ):
        nodes[name] = len(re.findall(pattern, plan))
    return {"scans": scans, "nodes": nodes}


def main(argv):
    from growthlens.catalog import QUERIES
    from growthlens.session import build_session

    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.1"
    spark = build_session(master="local[8]", shuffle_partitions=16)
    cols = ["shuffle", "partial_agg", "broadcast_join", "sort_merge_join", "window", "sort", "python"]
    print("# PLANS\n")
    print(f"Final physical plans (after AQE) of every registered query on `{sf_dir}`, produced by")
    print("`python tools/plan_report.py`. `shuffle` counts exchanges that move rows between tasks;")
    print("`partial_agg` counts map-side partial aggregates (each sits below a shuffle).\n")
    print("| query | scans | " + " | ".join(cols) + " |")
    print("|---|---|" + "---|" * len(cols))
    details = []
    for name, query in QUERIES.items():
        info = summarise(final_plan(query(spark, sf_dir)))
        tables = Counter(t for t, _, _ in info["scans"])
        scan_txt = ", ".join(f"{t}×{n}" if n > 1 else t for t, n in tables.items())
        print(f"| `{name}` | {scan_txt} | " + " | ".join(str(info["nodes"][c]) for c in cols) + " |")
        details.append((name, info["scans"]))
    print("\n## Columns read and filters pushed into each scan\n")
    for name, scans in details:
        print(f"* `{name}`")
        for table, read, pushed in scans:
            print(f"  * {table}: reads {', '.join(read)}; pushed {pushed}")
    for name in ("mart_retention", "mart_referral"):
        df = QUERIES[name](spark, sf_dir)
        df.collect()
        text = df._jdf.queryExecution().explainString(
            spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
        )
        print(f"\n## `{name}`: explain(\"formatted\") after execution\n")
        print("```")
        print(text.strip())
        print("```")
    spark.stop()


if __name__ == "__main__":
    main(sys.argv)
