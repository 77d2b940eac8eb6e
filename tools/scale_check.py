"""Scale experiment: the event marts on a large, skewed copy of the testdata events.

Usage: python tools/scale_check.py <scratch_dir> [copies] [sf_dir]

Writes (once) ``copies`` shifted copies of ``sf_dir``/events.parquet to
``<scratch_dir>/events_xN.parquet`` with one user holding a third of all rows,
then times the event-driven marts on it with Spark and checks each against
DuckDB on the same files.  Prints one JSON line.
"""

from __future__ import annotations

import json
import os
import sys
import time

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)


def make_copy(spark, sf_dir: str, out: str, copies: int) -> None:
    from pyspark.sql import functions as F

    if os.path.exists(out):
        return
    ev = spark.read.parquet(f"{sf_dir}/events.parquet")
    n = ev.count()
    # each input row is emitted ``copies`` times by a narrow generator
    big = ev.select("*", F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(copies - 1).cast("bigint"))).alias("copy")).select(
        (F.col("event_id") + F.col("copy") * F.lit(n)).alias("event_id"),
        "ts",
        # a third of the rows belong to one user; the rest keep distinct users per copy
        F.when(F.col("event_id") % 3 == 0, F.lit(-1))
        .otherwise(F.col("user_id") + F.col("copy") * F.lit(1_000_000))
        .alias("user_id"),
        "event_type",
        "value",
        "props",
    )
    big.repartition(64).write.parquet(out)


def main(argv) -> None:
    import duckdb

    from growthlens.operators import marts, serving, staging
    from growthlens.session import build_session
    from growthlens.sources.testdata_feeds import derive_feed, read_testdata
    from tools.compare_oracle import rows_of

    scratch = argv[1]
    copies = int(argv[2]) if len(argv) > 2 else 100
    sf_dir = argv[3] if len(argv) > 3 else "/root/testdata/sf0.1"
    spark = build_session(master="local[8]", shuffle_partitions=64)
    big_dir = f"{scratch}/events_x{copies}"
    os.makedirs(big_dir, exist_ok=True)
    make_copy(spark, sf_dir, f"{big_dir}/events.parquet", copies)

    events = staging.clean_posthog(derive_feed("posthog_raw", read_testdata(spark, big_dir, "events")))
    web = staging.clean_ga4(derive_feed("ga4_raw", read_testdata(spark, sf_dir, "orders")))
    search = staging.clean_gsc(derive_feed("gsc_raw", read_testdata(spark, sf_dir, "lineitem")))
    jobs = {
        "mart_retention": marts.retention(events),
        "mart_activation": marts.activation(events),
        "mart_referral": marts.referral(web, search, events),
        "funnel_daily": serving.funnel_daily(events),
    }
    import duckdb_oracle as oracle

    con = duckdb.connect()
    con.sql(f"create view events as select * from read_parquet('{big_dir}/events.parquet/*.parquet')")
    con.sql(f"create view orders as select * from read_parquet('{sf_dir}/orders.parquet')")
    con.sql(f"create view lineitem as select * from read_parquet('{sf_dir}/lineitem.parquet')")
    result = {"events_rows": spark.read.parquet(f"{big_dir}/events.parquet").count(), "copies": copies}
    for name, df in jobs.items():
        t0 = time.perf_counter()
        got = [tuple(r) for r in df.collect()]
        spark_sec = time.perf_counter() - t0
        t0 = time.perf_counter()
        rel = con.sql(oracle.ORACLE[name])
        want = rel.fetchall()
        duck_sec = time.perf_counter() - t0
        same = rows_of(df.columns, got) == rows_of(list(rel.columns), want)
        result[name] = {"rows": len(got), "spark_sec": round(spark_sec, 2), "duckdb_sec": round(duck_sec, 2), "match": same}
    spark.stop()
    print(json.dumps(result))


if __name__ == "__main__":
    main(sys.argv)
