"""Marts kept up to date batch by batch, from logs that only grow.

Events arrive in batches, in any order of days.  Each batch adds rows to three
logs under its own number, and what the marts need are sums and minima over
them, so nothing that was counted is counted again:

* ``counts``: funnel counts per (date, channel) of the batch, added up on read;
* ``user_days``: the (user, day) pairs that no earlier batch had, by day, so a
  batch meets only the stored pairs of its own days;
* ``first_seen``: the first day of users that are new or turned out to be
  older; the least one holds;
* ``cohorts``: what the batch adds to, or takes from, the users of a (cohort
  day, days since).  A late event that moves a user to an earlier cohort takes
  all the user's earlier days out of the old cohort and puts them into the new.

A batch that is repeated replaces its own folders and reads only those of lower
numbers, so the result stays the same; batches are numbered from 0 and run in
order.  ``compacted`` folds the logs into one batch.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from growthlens.operators import marts

col = F.col

_LOGS = {
    "counts": "date date, channel string, total_signups bigint, total_activations bigint, total_purchases bigint, total_churns bigint",
    "arrived": "user_id string, day date",
    "user_days": "user_id string, day date",
    "first_seen": "user_id string, first_day date",
    "cohorts": "cohort_date date, days_since_signup bigint, change bigint",
}


def _read(spark: SparkSession, root: str, log: str, before: int | None = None) -> DataFrame:
    """The rows of a log, those of batches below ``before`` if given."""
    if before == 0:
        return spark.createDataFrame([], f"{_LOGS[log]}, batch int")
    rows = spark.read.schema(f"{_LOGS[log]}, batch int").parquet(f"{root}/{log}")
    return rows if before is None else rows.where(col("batch") < before)


def _write(df: DataFrame, root: str, log: str, batch_id: int, partition_by: str | None = None) -> DataFrame:
    """Stores the rows of one batch, in place of an earlier attempt at it, and returns them as stored."""
    writer = df.write.mode("overwrite")
    path = f"{root}/{log}/batch={batch_id}"
    (writer.partitionBy(partition_by) if partition_by else writer).parquet(path)
    return df.sparkSession.read.schema(_LOGS[log]).parquet(path)


def add_funnel_counts(stg_posthog: DataFrame, root: str, batch_id: int) -> None:
    """Adds the funnel counts of one batch of cleaned events; reads nothing but the batch."""
    _write(marts.daily_funnel_counts(stg_posthog), root, "counts", batch_id)


def funnel_counts_so_far(spark: SparkSession, root: str) -> DataFrame:
    """``marts.daily_funnel_counts`` of all events of all batches."""
    rows = _read(spark, root, "counts")
    return rows.groupBy("date", "channel").agg(*[F.sum(c).alias(c) for c in marts.FUNNEL_COUNTS])


def add_user_days(stg_posthog: DataFrame, root: str, batch_id: int) -> None:
    """Takes one batch of cleaned events into the cohorts.

    Stored pairs are read for the days of the batch only, and for the users that
    move to an earlier cohort, from the first of the days they were known for.
    """
    spark = stg_posthog.sparkSession
    arrived = _write(marts.user_active_days(stg_posthog).withColumnRenamed("date", "day"), root, "arrived", batch_id)
    days = [r["day"] for r in arrived.select("day").distinct().collect()]  # a row per calendar day of the batch
    known = _read(spark, root, "user_days", batch_id).where(col("day").isin(days))
    fresh = arrived.join(known, ["user_id", "day"], "left_anti")
    clustered = fresh.hint("rebalance", col("day"))
    fresh = _write(clustered, root, "user_days", batch_id, partition_by="day")

    touched = fresh.groupBy("user_id").agg(F.min("day").alias("new_first"))
    earlier = _read(spark, root, "first_seen", batch_id).join(touched.select("user_id"), "user_id", "left_semi")
    earlier = earlier.groupBy("user_id").agg(F.min("first_day").alias("old_first"))
    firsts = touched.join(earlier, "user_id", "left").withColumn("first_day", F.least("old_first", "new_first"))
    changed = firsts.where(col("old_first").isNull() | (col("new_first") < col("old_first")))
    _write(changed.select("user_id", "first_day"), root, "first_seen", batch_id)

    def since(first: str) -> list:
        return [col(first).alias("cohort_date"), F.datediff("day", first).cast("bigint").alias("days_since_signup")]

    change = fresh.join(firsts, "user_id").select(*since("first_day"), F.lit(1).cast("bigint").alias("change"))
    moved = firsts.where(col("new_first") < col("old_first")).select("user_id", "old_first", "first_day")
    least = moved.agg(F.min("old_first")).first()[0]
    if least is not None:
        stored = _read(spark, root, "user_days", batch_id).where(col("day") >= F.lit(least)).join(moved, "user_id")
        for first, sign in (("old_first", -1), ("first_day", 1)):
            change = change.unionByName(stored.select(*since(first), F.lit(sign).cast("bigint").alias("change")))
    change = change.groupBy("cohort_date", "days_since_signup").agg(F.sum("change").alias("change")).where("change <> 0")
    _write(change, root, "cohorts", batch_id)


def retention_so_far(spark: SparkSession, root: str) -> DataFrame:
    """``marts.retention`` of all events of all batches, from the cohort changes alone."""
    active = _read(spark, root, "cohorts").groupBy("cohort_date", "days_since_signup").agg(F.sum("change").alias("active_users"))
    return marts.retention_rates(active.where(col("active_users") > 0))


def compacted(spark: SparkSession, root: str, target: str, batch_id: int) -> None:
    """Folds the logs of ``root`` into batch ``batch_id`` (the last one it has) of ``target``, where later batches go on."""
    _write(funnel_counts_so_far(spark, root), target, "counts", batch_id)
    days = _read(spark, root, "user_days").select("user_id", "day")
    _write(days.hint("rebalance", col("day")), target, "user_days", batch_id, partition_by="day")
    firsts = _read(spark, root, "first_seen").groupBy("user_id").agg(F.min("first_day").alias("first_day"))
    _write(firsts, target, "first_seen", batch_id)
    change = _read(spark, root, "cohorts").groupBy("cohort_date", "days_since_signup").agg(F.sum("change").alias("change"))
    _write(change.where("change <> 0"), target, "cohorts", batch_id)
