"""Exact distinct users over any period, from day-grain bitmaps.

A distinct count cannot be added up: a user of two days is one user of the
week.  A set can.  Users are numbered once, each day keeps its users as bitmaps
of their numbers (a bucket of 32,768 numbers is 4 KB at most), and a week or a
month is the union of its days' bitmaps, so no event is read again.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

col = F.col


def user_numbers(user_days: DataFrame, known: DataFrame | None = None) -> DataFrame:
    """(user_id, number) of the users of ``user_days`` that ``known`` does not hold yet, dense within each task.

    To be stored: the numbers are drawn anew on each evaluation.  With ``known``
    (user_id, number) they go on behind its highest one.
    """
    users = user_days.select("user_id").distinct()
    number = F.monotonically_increasing_id()
    if known is None:
        return users.withColumn("number", number)
    # a task's numbers start at a multiple of 2^33, so later batches start at one above all known ones
    above = known.agg(((F.coalesce(F.max(F.shiftright("number", 33)), F.lit(-1)) + 1) * F.lit(1 << 33)).alias("above"))
    fresh = users.join(known.select("user_id"), "user_id", "left_anti")
    first = above.first()["above"]  # one number
    return fresh.withColumn("number", number + F.lit(first))


def user_bitmaps(user_days: DataFrame, numbers: DataFrame) -> DataFrame:
    """(date, bucket, users, flagged): bitmaps of the day's users, and of those with ``signed_up``.

    ``user_days`` holds a row per user and day (``marts.user_active_days``).
    """
    placed = user_days.join(numbers, "user_id").select(
        "date",
        F.bitmap_bucket_number("number").alias("bucket"),
        F.bitmap_bit_position("number").alias("bit"),
        F.when(col("signed_up"), F.bitmap_bit_position("number")).alias("flagged_bit"),
    )
    return placed.groupBy("date", "bucket").agg(
        F.bitmap_construct_agg("bit").alias("users"), F.bitmap_construct_agg("flagged_bit").alias("flagged")
    )


def store_user_bitmaps(user_days: DataFrame, root: str) -> DataFrame:
    """Numbers the users of ``user_days`` and stores numbers and bitmaps under ``root``; returns the bitmaps as stored."""
    spark = user_days.sparkSession
    user_numbers(user_days).write.mode("overwrite").parquet(f"{root}/numbers")
    numbers = spark.read.schema("user_id string, number bigint").parquet(f"{root}/numbers")
    user_bitmaps(user_days, numbers).write.mode("overwrite").parquet(f"{root}/days")
    return spark.read.schema("date date, bucket bigint, users binary, flagged binary").parquet(f"{root}/days")


def distinct_users(bitmaps: DataFrame, *period: Column | str) -> DataFrame:
    """``period``, users and flagged_users: exact distinct counts over the days that fall into each period.

    Reads the day grain only.  Unions of a bucket's bitmaps are combined before
    the shuffle; a bucket of a period is one row.
    """
    keyed = bitmaps.select(*period, "bucket", "users", "flagged")
    names = [c for c in keyed.columns if c not in ("bucket", "users", "flagged")]
    merged = keyed.groupBy(*names, "bucket").agg(F.bitmap_or_agg("users").alias("users"), F.bitmap_or_agg("flagged").alias("flagged"))
    return merged.groupBy(*names).agg(
        F.sum(F.bitmap_count("users")).alias("users"), F.sum(F.bitmap_count("flagged")).alias("flagged_users")
    )
