"""Distinct users from day-grain bitmaps against counts over all events."""

import datetime as dt
import random

from pyspark.sql import functions as F

from growthlens.functions import week_start
from growthlens.operators.distinct import distinct_users, store_user_bitmaps, user_bitmaps, user_numbers
from tests.conftest import rows

DAYS = "user_id string, date date, signed_up boolean"


def user_days(seed, users=400, n=3000):
    r = random.Random(seed)
    pairs = {(f"u{r.randrange(users)}", dt.date(2024, 1, 1) + dt.timedelta(days=r.randrange(60))) for _ in range(n)}
    pairs |= {("hot", dt.date(2024, 1, 1) + dt.timedelta(days=k)) for k in range(60)}
    return [(u, d, r.choice([True, False, None])) for u, d in sorted(pairs)]


def by_hand(data, period):
    out = {}
    for user, day, signed in data:
        every, flagged = out.setdefault(period(day), (set(), set()))
        every.add(user)
        if signed:
            flagged.add(user)
    return sorted((p, len(a), len(b)) for p, (a, b) in out.items())


def test_weeks_months_and_the_whole_period(spark, tmp_path):
    data = user_days(1)
    days = store_user_bitmaps(spark.createDataFrame(data, DAYS).repartition(5), str(tmp_path / "a"))
    weeks = rows(distinct_users(days, week_start("date").alias("w")), "w", "users", "flagged_users")
    assert sorted(weeks) == by_hand(data, lambda d: d - dt.timedelta(days=d.weekday()))
    months = rows(distinct_users(days, F.month("date").alias("m")), "m", "users", "flagged_users")
    assert sorted(months) == by_hand(data, lambda d: d.month)
    assert rows(distinct_users(days), "users", "flagged_users") == [by_hand(data, lambda d: 0)[0][1:]]
    # only the stored day grain is read
    plan = distinct_users(days, "date")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and "/a/days" in plan


def test_later_batches_keep_the_numbers(spark, tmp_path):
    data = user_days(2)
    random.Random(2).shuffle(data)
    first, second = (spark.createDataFrame(part, DAYS).repartition(3) for part in (data[:700], data[700:]))
    for k, batch in enumerate((first, second)):
        known = spark.read.parquet(str(tmp_path / "numbers")) if k else None
        user_numbers(batch, known).write.mode("append").parquet(str(tmp_path / "numbers"))
        user_bitmaps(batch, spark.read.parquet(str(tmp_path / "numbers"))).write.mode("append").parquet(str(tmp_path / "days"))
    numbers = spark.read.parquet(str(tmp_path / "numbers"))
    assert numbers.count() == numbers.select("number").distinct().count() == len({u for u, *_ in data})
    days = spark.read.parquet(str(tmp_path / "days"))
    assert sorted(rows(distinct_users(days, "date"), "date", "users", "flagged_users")) == by_hand(data, lambda d: d)


def test_more_users_than_a_bucket_and_none(spark, tmp_path):
    many = spark.range(100_000).select(
        F.concat(F.lit("u"), "id").alias("user_id"), F.lit(dt.date(2024, 1, 1)).alias("date"), (F.col("id") % 2 == 0).alias("signed_up")
    )
    days = store_user_bitmaps(many, str(tmp_path / "m"))
    assert rows(distinct_users(days, "date"), "users", "flagged_users") == [(100_000, 50_000)]
    assert distinct_users(store_user_bitmaps(many.limit(0), str(tmp_path / "n")), "date").count() == 0
