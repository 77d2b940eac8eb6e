"""Skewed keys, restarts and rebuilds."""

import datetime as dt

from pyspark.sql import functions as F

from growthlens.operators import marts, staging
from growthlens.plans import build_warehouse
from growthlens.sources.io import read_feed, read_table
from growthlens.sources.schemas import POSTHOG_RAW
from growthlens.sources.testdata_feeds import feeds_from_testdata, posthog_raw
from growthlens.streaming import start_funnel_counts
from tests.conftest import SF_SMALL, rows


def _hot_user_events(spark):
    """Testdata events where one user holds a third of all rows."""
    raw = posthog_raw(spark, SF_SMALL)
    hot = raw.where(F.col("event_id").substr(-1, 1).isin("0", "1", "2")).withColumn("user_id", F.lit("user_hot"))
    rest = raw.where(~F.col("event_id").substr(-1, 1).isin("0", "1", "2"))
    return staging.clean_posthog(hot.unionByName(rest))


def test_retention_with_a_hot_user(spark):
    ev = _hot_user_events(spark)
    total = ev.count()
    hot = ev.where("user_id = 'user_hot'").count()
    assert hot * 4 > total  # roughly a third of the rows
    a = marts.retention(ev)
    days_of = {}
    for user, day in rows(ev.select("user_id", "event_date").distinct(), "user_id", "event_date"):
        days_of.setdefault(user, set()).add(day)
    want = {}
    for days in days_of.values():
        for day in days:
            key = (min(days), (day - min(days)).days)
            want[key] = want.get(key, 0) + 1
    assert {(r[0], r[1]): r[2] for r in rows(a, "cohort_date", "days_since_signup", "active_users")} == want
    # the per-user window only ever sees one row per (user, day)
    days = marts.user_active_days(ev)
    per_user = days.groupBy("user_id").count().agg(F.max("count")).first()[0]
    assert per_user <= ev.select("event_date").distinct().count()


def test_referral_signups_with_a_hot_user(spark):
    ev = _hot_user_events(spark)
    web = staging.clean_ga4(feeds_from_testdata(spark, SF_SMALL)["ga4_raw"])
    search = staging.clean_gsc(feeds_from_testdata(spark, SF_SMALL)["gsc_raw"])
    ref = marts.referral(web, search, ev)
    signups = ev.where("is_signup").groupBy("event_date").agg(F.countDistinct("user_id").alias("n"))
    got = {r["date"]: r["total_new_signups"] for r in ref.collect()}
    want = {r["event_date"]: r["n"] for r in signups.collect()}
    for day, n in got.items():
        assert n == want.get(day, 0)


def test_read_feed_uses_the_declared_schema(spark, tmp_path):
    path = str(tmp_path / "posthog")
    posthog_raw(spark, SF_SMALL).write.parquet(path)
    df = read_feed(spark, "posthog_raw", path)
    assert df.schema == POSTHOG_RAW
    assert df.count() == 1000


def test_rebuild_replaces_previous_build(spark, tmp_path):
    root = str(tmp_path / "wh")
    feeds = feeds_from_testdata(spark, SF_SMALL)
    # the date-partitioned layout is the one where a partial overwrite could leave stale days
    first = build_warehouse(spark, feeds, root=root, store_events="by date")
    smaller = dict(feeds)
    smaller["posthog_raw"] = feeds["posthog_raw"].where("channel = 'organic'")
    second = build_warehouse(spark, smaller, root=root, store_events="by date")
    assert first == second
    events = read_table(spark, second["stg_posthog"])
    assert events.count() == events.where("channel = 'organic'").count() > 0
    act = read_table(spark, second["mart_activation"])
    assert {r[0] for r in act.select("channel").distinct().collect()} == {"organic"}


def test_stream_resumes_from_its_checkpoint(spark, tmp_path):
    """A stopped query restarted on the same checkpoint continues exactly once."""
    raw_dir, out_dir, ckpt = str(tmp_path / "raw"), str(tmp_path / "out"), str(tmp_path / "ckpt")
    raw = posthog_raw(spark, SF_SMALL)
    early = raw.where(F.col("timestamp") < "2024-01-15")
    late = raw.where((F.col("timestamp") >= "2024-01-15") | F.col("timestamp").isNull())
    early.write.parquet(raw_dir, mode="append")
    start_funnel_counts(spark, raw_dir, out_dir, ckpt).awaitTermination(300)
    first = spark.read.parquet(f"{out_dir}/counts").count()
    late.write.parquet(raw_dir, mode="append")
    start_funnel_counts(spark, raw_dir, out_dir, ckpt).awaitTermination(300)
    out = spark.read.parquet(f"{out_dir}/counts")
    cols = ["date", "channel", "total_signups", "total_activations", "total_purchases", "total_churns"]
    got = sorted(rows(out, *cols))
    assert len(got) > first > 0
    assert got == sorted(rows(marts.daily_funnel_counts(staging.clean_posthog(raw)), *cols))
