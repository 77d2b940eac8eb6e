"""Stored warehouse build and the streaming event path."""

import os

from pyspark.sql import functions as F

from growthlens.catalog import Warehouse
from growthlens.operators import marts
from growthlens.plans import build_warehouse
from growthlens.plans.incremental import funnel_counts_so_far
from growthlens.sources.io import read_table
from growthlens.sources.testdata_feeds import feeds_from_testdata, posthog_raw
from growthlens.streaming import start_funnel_counts
from tests.conftest import SF_SMALL, rows


def _same(a, b):
    b = b.select(*a.columns)
    return a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_build_warehouse_matches_lazy_relations(spark, tmp_path):
    paths = build_warehouse(
        spark, feeds_from_testdata(spark, SF_SMALL), root=str(tmp_path / "wh"), store_events="by date"
    )
    wh = Warehouse(spark, SF_SMALL)
    for name in ("mart_acquisition", "mart_activation", "mart_retention", "mart_revenue", "mart_referral",
                 "weekly_kpis", "weekly_delta", "weekly_kpi_long", "data_checks", "funnel_daily", "channel_cac",
                 "retention_milestones", "revenue_by_channel", "referral_trend", "email_campaign_summary"):
        assert _same(getattr(wh, name), read_table(spark, paths[name])), name
    events = read_table(spark, paths["stg_posthog"])
    assert dict(events.dtypes)["event_date"] == "date"
    assert events.count() == 990
    # date filters on the stored events prune partitions
    plan = events.where(F.col("event_date") == "2024-01-03")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(event_date" in plan
    # clustered before the write: far fewer files than tasks x days
    files = [f for f in events.inputFiles() if f.endswith(".parquet")]
    days = events.select("event_date").distinct().count()
    assert len(files) <= days + spark.sparkContext.defaultParallelism * 4


def test_build_warehouse_default_layout(spark, tmp_path):
    paths = build_warehouse(
        spark, feeds_from_testdata(spark, SF_SMALL), root=str(tmp_path / "wh"),
        channel_map={"facebook": "meta", "instagram": "meta"},
    )
    wh = Warehouse(spark, SF_SMALL, channel_map={"facebook": "meta", "instagram": "meta"})
    for name in ("mart_retention", "mart_revenue", "mart_referral", "funnel_daily", "weekly_kpi_long"):
        assert _same(getattr(wh, name), read_table(spark, paths[name])), name
    # the shared intermediates are the only readers of the events, which are not stored unless asked for
    assert {"funnel_counts", "user_days"} <= set(paths) and "stg_posthog" not in paths


def test_build_counts_its_checks_while_it_writes_and_drops_old_versions(spark, tmp_path):
    from growthlens.operators import checks

    feeds = feeds_from_testdata(spark, SF_SMALL)
    root = tmp_path / "wh"
    for _ in range(3):
        paths = build_warehouse(spark, feeds, root=str(root))
    assert _same(Warehouse(spark, SF_SMALL).data_checks, read_table(spark, paths["data_checks"]))
    for path in paths.values():
        assert len([p for p in os.listdir(path) if p.startswith("version=")]) == 2, path
    # failing rows and a table without rows are counted as run_checks counts them
    data = spark.createDataFrame([("meta", -1.0, None), ("tv", None, 2.0), (None, 1.0, 1.0)], "channel string, cac double, roas double")
    mine = [c for c in checks.default_checks() if c.model == "mart_acquisition" and c.column in data.columns]
    for k, table in enumerate((data, data.limit(0), data.repartition(3))):
        watched = checks.Watched(mine)
        watched.watch("mart_acquisition", table).write.parquet(str(tmp_path / f"t{k}"))
        assert _same(checks.run_checks({"mart_acquisition": table}, checks=mine), watched.results(spark))


FUNNEL = ("date", "channel", "total_signups", "total_activations", "total_purchases", "total_churns")


def _funnel(spark, out_dir):
    return sorted(rows(funnel_counts_so_far(spark, out_dir), *FUNNEL))


def test_streaming_funnel_counts_match_batch(spark, tmp_path):
    raw_dir = str(tmp_path / "raw")
    raw = posthog_raw(spark, SF_SMALL)
    raw.where("event_id < 'ph_5'").write.parquet(raw_dir, mode="append")
    raw.where("event_id >= 'ph_5' or event_id is null").write.parquet(raw_dir, mode="append")
    out_dir, ckpt = str(tmp_path / "out"), str(tmp_path / "ckpt")
    start_funnel_counts(spark, raw_dir, out_dir, ckpt).awaitTermination(300)
    assert _funnel(spark, out_dir) == sorted(rows(marts.daily_funnel_counts(Warehouse(spark, SF_SMALL).stg_posthog), *FUNNEL))


def test_streaming_funnel_counts_take_a_late_file(spark, tmp_path):
    """All days equal the batch counts after a first run, an idle restart and a backfill of an old day."""
    raw_dir, out_dir, ckpt = str(tmp_path / "raw"), str(tmp_path / "out"), str(tmp_path / "ckpt")
    raw = posthog_raw(spark, SF_SMALL)
    old = F.col("timestamp") < "2024-01-10"
    raw.where(~old).write.parquet(raw_dir, mode="append")
    start_funnel_counts(spark, raw_dir, out_dir, ckpt).awaitTermination(300)
    start_funnel_counts(spark, raw_dir, out_dir, ckpt).awaitTermination(300)
    raw.where(old).write.parquet(raw_dir, mode="append")
    start_funnel_counts(spark, raw_dir, out_dir, ckpt).awaitTermination(300)
    assert _funnel(spark, out_dir) == sorted(rows(marts.daily_funnel_counts(Warehouse(spark, SF_SMALL).stg_posthog), *FUNNEL))


def test_relations_over_any_feeds_and_sql_views(spark):
    from growthlens.plans import Relations

    rel = Relations(feeds_from_testdata(spark, SF_SMALL))
    names = rel.register_views()
    assert "stg_posthog" in names and "mart_retention" in names
    via_sql = spark.sql(
        "select channel, count(*) as days, sum(total_conversions) as conversions "
        "from mart_acquisition group by channel"
    )
    via_df = rel.mart_acquisition.groupBy("channel").agg(
        F.count(F.lit(1)).alias("days"), F.sum("total_conversions").alias("conversions")
    )
    assert _same(via_sql, via_df)
    assert _same(rel.mart_retention, Warehouse(spark, SF_SMALL).mart_retention)


def test_streaming_cleaning_appends_exactly_once(spark, tmp_path):
    from growthlens.operators import staging
    from growthlens.streaming import start_event_cleaning

    raw_dir, out_dir, ckpt = str(tmp_path / "raw"), str(tmp_path / "clean"), str(tmp_path / "ckpt")
    raw = posthog_raw(spark, SF_SMALL)
    raw.where("event_id < 'ph_5'").write.parquet(raw_dir, mode="append")
    start_event_cleaning(spark, raw_dir, out_dir, ckpt).awaitTermination(300)
    # restart on the same checkpoint with nothing new: no duplicate appends
    start_event_cleaning(spark, raw_dir, out_dir, ckpt).awaitTermination(300)
    raw.where("event_id >= 'ph_5'").write.parquet(raw_dir, mode="append")
    start_event_cleaning(spark, raw_dir, out_dir, ckpt).awaitTermination(300)
    streamed = spark.read.parquet(out_dir)
    batch = staging.clean_posthog(raw)
    assert _same(batch, streamed)


def test_streaming_funnel_days_do_not_depend_on_the_session_time_zone(spark, tmp_path):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/Los_Angeles")
    try:
        raw_dir = str(tmp_path / "raw")
        posthog_raw(spark, SF_SMALL).write.parquet(raw_dir)
        out_dir, ckpt = str(tmp_path / "out"), str(tmp_path / "ckpt")
        start_funnel_counts(spark, raw_dir, out_dir, ckpt).awaitTermination(300)
        batch = marts.daily_funnel_counts(Warehouse(spark, SF_SMALL).stg_posthog)
        assert _funnel(spark, out_dir) == sorted(rows(batch, *FUNNEL))
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
