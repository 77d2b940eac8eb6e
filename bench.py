"""Benchmark: every registered query over the whole testdata tables, plus a full build.

Environment: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8).
Each query is forced to completion with the ``noop`` sink (full execution, no
driver collect).  One cold pass (first run in the JVM: class loading, codegen)
and WARM_PASSES warm passes are timed; a query's value is the median of its warm
runs, the headline the sum of these medians.  The full
build writes every relation of the warehouse under the shared folder
(``spark.checkpoint.dir``), replacing the previous run's tables.

Prints ONE JSON line.
"""

from __future__ import annotations

import json
import os
import re
import statistics
import sys
import time

ROOT = os.path.dirname(os.path.abspath(__file__))
sys.path.insert(0, ROOT)
WARM_PASSES = 3


def _run(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def _plan_metrics(df) -> dict:
    """Counts from the initial (pre-AQE) physical plan: event-feed scans, shuffles, sorts, joins.

    AQE may still turn a sort-merge join into a broadcast join at runtime; the
    post-AQE plans are summarised by ``tools/plan_report.py`` (PLANS.md).
    """
    plan = df._jdf.queryExecution().executedPlan().toString()
    return {
        "event_scans": len(re.findall(r"FileScan parquet [^\n]*events\.parquet", plan)),
        "scans": plan.count("FileScan parquet"),
        "shuffles": len(re.findall(r"(?<!Broadcast)Exchange (?:hash|range|single|round)", plan, flags=re.IGNORECASE)),
        "sorts": len(re.findall(r"\bSort \[", plan)),
        "joins": len(re.findall(r"\w+Join ", plan)),
    }


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))

    from growthlens.catalog import QUERIES
    from growthlens.plans import build_warehouse
    from growthlens.session import build_session, shared_dir
    from growthlens.sources.testdata_feeds import feeds_from_testdata

    spark = build_session(master=f"local[{cpus}]", app_name="growthlens-bench", shuffle_partitions=2 * cpus)
    # the full build replaces its previous run under the session's shared folder
    scratch = f"{shared_dir(spark)}/growthlens/bench/{os.path.basename(sf_dir)}"

    passes: list[dict[str, float]] = []
    plans: dict[str, dict] = {}
    for k in range(1 + WARM_PASSES):
        passes.append({})
        for name, query in QUERIES.items():
            t0 = time.perf_counter()
            df = query(spark, sf_dir)
            _run(df)
            passes[k][name] = round(time.perf_counter() - t0, 3)
            if k == WARM_PASSES:
                plans[name] = _plan_metrics(df)
    cold = passes[0]
    warm = {name: statistics.median(p[name] for p in passes[1:]) for name in QUERIES}

    t0 = time.perf_counter()
    build_warehouse(spark, feeds_from_testdata(spark, sf_dir), root=f"{scratch}/warehouse")
    full_build = round(time.perf_counter() - t0, 3)
    spark.stop()

    sf = os.path.basename(sf_dir).replace("sf", "")
    print(
        json.dumps(
            {
                "metric": "warm_total_all_queries",
                "value": round(sum(warm.values()), 3),
                "unit": "sec",
                "queries": warm,
                "cold_queries": cold,
                "cold_total": round(sum(cold.values()), 3),
                "full_build_sec": full_build,
                "plan_initial": plans,
                "n_queries": len(warm),
                "cpus": cpus,
                "sf": float(sf) if sf.replace(".", "", 1).isdigit() else sf,
            }
        )
    )


if __name__ == "__main__":
    main()
