"""Marts kept up to date batch by batch equal the batch marts over all events so far."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from growthlens.catalog import Warehouse
from growthlens.operators import marts
from growthlens.plans.incremental import (
    add_funnel_counts,
    add_user_days,
    compacted,
    funnel_counts_so_far,
    retention_so_far,
)
from growthlens.sources.testdata_feeds import posthog_raw
from growthlens.streaming import start_cohorts
from tests.conftest import SF_SMALL, rows

EVENTS = "event_id string, user_id string, event_date date, channel string, is_signup boolean, is_activation boolean, is_purchase boolean, is_churn boolean"
FUNNEL = ("date", "channel", *marts.FUNNEL_COUNTS)
RETENTION = ("cohort_date", "days_since_signup", "cohort_size", "active_users", "retention_rate")


def events(seed, n=600, users=60):
    r = random.Random(seed)
    first = dt.date(2024, 1, 1)
    out = []
    for i in range(n):
        user = "hot" if r.random() < 0.33 else f"u{r.randrange(users)}"
        flags = [r.random() < 0.3 for _ in range(4)]
        out.append((f"e{i}", user, first + dt.timedelta(days=r.randrange(25)), r.choice(["a", "b", None]), *flags))
    return out


def same(got, want, columns):
    assert sorted(rows(got, *columns), key=str) == sorted(rows(want, *columns), key=str)


@pytest.mark.parametrize("order", ["by day", "backwards", "mixed"])
def test_every_batch_leaves_the_marts_of_all_events_so_far(spark, tmp_path, order):
    data = events(3)
    if order == "mixed":
        random.Random(1).shuffle(data)
    else:
        data.sort(key=lambda e: e[2], reverse=order == "backwards")  # backwards: every user moves to earlier cohorts
    root, step = str(tmp_path / "logs"), 150
    for k in range(4):
        batch = spark.createDataFrame(data[k * step : (k + 1) * step], EVENTS)
        add_user_days(batch, root, k)
        add_funnel_counts(batch, root, k)
        so_far = spark.createDataFrame(data[: (k + 1) * step], EVENTS)
        same(retention_so_far(spark, root), marts.retention(so_far), RETENTION)
        same(funnel_counts_so_far(spark, root), marts.daily_funnel_counts(so_far), FUNNEL)


def test_a_repeated_batch_and_an_empty_one_change_nothing(spark, tmp_path):
    data, root = events(5), str(tmp_path / "logs")
    random.Random(2).shuffle(data)
    batches = [spark.createDataFrame(part, EVENTS) for part in (data[:200], data[200:400], [], data[400:])]
    for k, batch in enumerate(batches):
        for _ in range(2 if k in (0, 3) else 1):
            add_user_days(batch, root, k)
            add_funnel_counts(batch, root, k)
    # events that came before, sent again in a new batch: the pairs are known
    add_user_days(batches[0], root, 4)
    whole = spark.createDataFrame(data, EVENTS)
    same(retention_so_far(spark, root), marts.retention(whole), RETENTION)
    same(funnel_counts_so_far(spark, root), marts.daily_funnel_counts(whole), FUNNEL)
    assert spark.read.parquet(f"{root}/user_days").where("batch = 4").count() == 0


def test_compaction_keeps_the_marts_and_later_batches_go_on(spark, tmp_path):
    data, root, target = events(7), str(tmp_path / "logs"), str(tmp_path / "compact")
    random.Random(3).shuffle(data)
    for k in range(2):
        batch = spark.createDataFrame(data[k * 200 : (k + 1) * 200], EVENTS)
        add_user_days(batch, root, k)
        add_funnel_counts(batch, root, k)
    compacted(spark, root, target, 1)
    last = spark.createDataFrame(data[400:], EVENTS)
    add_user_days(last, target, 2)
    add_funnel_counts(last, target, 2)
    whole = spark.createDataFrame(data, EVENTS)
    same(retention_so_far(spark, target), marts.retention(whole), RETENTION)
    same(funnel_counts_so_far(spark, target), marts.daily_funnel_counts(whole), FUNNEL)


def test_a_batch_reads_only_the_days_it_holds(spark, tmp_path):
    root = str(tmp_path / "logs")
    data = events(9)
    add_user_days(spark.createDataFrame(data, EVENTS), root, 0)
    known = spark.read.schema("user_id string, day date, batch int").parquet(f"{root}/user_days")
    day = dt.date(2024, 1, 5)
    plan = known.where(F.col("batch") < 1).where(F.col("day").isin([day]))._jdf.queryExecution().executedPlan().toString()
    filters = plan[plan.index("PartitionFilters") :].split("]")[0]
    assert "batch" in filters and "day" in filters


def test_cohorts_of_a_stream_take_late_files(spark, tmp_path):
    raw_dir, out_dir, ckpt = str(tmp_path / "raw"), str(tmp_path / "out"), str(tmp_path / "ckpt")
    raw = posthog_raw(spark, SF_SMALL)
    old = F.col("timestamp") < "2024-01-20"
    raw.where(~old).write.parquet(raw_dir, mode="append")
    start_cohorts(spark, raw_dir, out_dir, ckpt).awaitTermination(300)
    start_cohorts(spark, raw_dir, out_dir, ckpt).awaitTermination(300)
    raw.where(old).write.parquet(raw_dir, mode="append")
    start_cohorts(spark, raw_dir, out_dir, ckpt).awaitTermination(300)
    same(retention_so_far(spark, out_dir), Warehouse(spark, SF_SMALL).mart_retention, RETENTION)
