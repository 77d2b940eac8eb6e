"""Column builders: safe ratio (M11), percent change (M10), position buckets (M2)."""

import datetime as dt

import pytest

from pyspark.sql import functions as F

from growthlens.functions import pct_change, position_bucket, ratio, week_start


def test_safe_ratio_edges(spark):
    df = spark.createDataFrame(
        [(3.0, 2.0), (3.0, 0.0), (3.0, -0.0), (None, 2.0), (0.0, 5.0), (3.0, None)],
        "a double, b double",
    )
    got = [r[0] for r in df.select(ratio("a", "b")).collect()]
    assert got == [1.5, None, None, None, 0.0, None]


def test_safe_ratio_is_double_for_integers(spark):
    df = spark.createDataFrame([(3, 2)], "a bigint, b bigint")
    out = df.select(ratio("a", "b").alias("r"))
    assert dict(out.dtypes)["r"] == "double"
    assert out.first()["r"] == 1.5


def test_pct_change(spark):
    df = spark.createDataFrame([(11.0, 10.0), (9.0, 10.0), (5.0, 0.0), (0.0, 0.0), (0.0, 10.0)], "n double, o double")
    got = [r[0] for r in df.select(pct_change("n", "o")).collect()]
    assert got == [10.0, -10.0, 0.0, 0.0, -100.0]


def test_pct_change_matches_python_rounding(spark):
    """Same result as ``round(((new - old) / old) * 100, 1)``, without any tolerance."""
    import random

    rnd = random.Random(7)
    pairs = [(round(rnd.uniform(0, 500), 2), round(rnd.uniform(0, 500), 2)) for _ in range(100_000)]
    pairs += [(101.35, 100.0), (101.25, 100.0), (5.0, 0.0), (0.0, 0.0), (1001.5, 1000.0), (2013.0, 2000.0), (99.96, 100.0), (100.04, 100.0)]
    df = spark.createDataFrame(pairs, "n double, o double")
    got = [r[0] for r in df.select(pct_change("n", "o")).collect()]
    import math

    for (n, o), g in zip(pairs, got):
        raw = 0 if o == 0 else ((n - o) / o) * 100
        want = 0 if o == 0 else round(raw, 1)
        assert math.copysign(1.0, g) == math.copysign(1.0, want), (n, o, g, want)  # -0.0 stays -0.0
        assert g == want, (n, o, g, want)


def test_position_buckets(spark):
    df = spark.createDataFrame(
        [(3.0,), (3.1,), (10.0,), (10.1,), (20.0,), (20.1,), (0.0,), (None,)], "p double"
    )
    got = [r[0] for r in df.select(position_bucket("p")).collect()]
    assert got == ["top_3", "page_1", "page_1", "page_2", "page_2", "page_3_plus", "top_3", "page_3_plus"]


def test_week_start_is_monday(spark):
    df = spark.createDataFrame(
        [(dt.date(2024, 1, 7),), (dt.date(2024, 1, 1),), (dt.date(2024, 1, 8),)], "d date"
    )
    got = [r[0] for r in df.select(week_start("d")).collect()]
    assert got == [dt.date(2024, 1, 1), dt.date(2024, 1, 1), dt.date(2024, 1, 8)]
    assert dict(df.select(week_start("d").alias("w")).dtypes)["w"] == "date"


def test_builders_stay_native(spark):
    """No Python UDF anywhere in an expression built by the helpers."""
    df = spark.createDataFrame([(1.0, 2.0)], "a double, b double")
    plan = df.select(ratio("a", "b"), pct_change("a", "b"), position_bucket("a"), F.lit(1))._jdf.queryExecution()
    text = plan.executedPlan().toString()
    assert "BatchEvalPython" not in text and "ArrowEvalPython" not in text


def test_sums_keep_sub_cent_amounts_and_nan(spark):
    from growthlens.functions import exact_totals, strict_date

    def total(values):
        frame = spark.createDataFrame([(x,) for x in values], "x double")
        return tuple(exact_totals(frame, [], {"s": F.col("x")}).first())

    assert total([0.004] * 1000) == (4.0, 1000)
    fine = [1.123456789012345, 2.000000000000001, 3.5]
    s, n = total([*fine, None])
    assert s / n == pytest.approx(sum(fine) / 3, abs=1e-15)
    odd, _ = total([1.0, float("nan")])
    assert odd != odd
    assert total([]) == (None, 0) == total([None])
    before = spark.conf.get("spark.sql.ansi.enabled")
    spark.conf.set("spark.sql.ansi.enabled", "false")
    try:
        bad = spark.createDataFrame([("2024-01-01",), ("not-a-date",), (None,)], "d string")
        assert bad.where("d is null or d < 'a'").select(strict_date("d").alias("x")).count() == 2
        with pytest.raises(Exception, match="not a date"):
            bad.select(strict_date("d").alias("x")).collect()
    finally:
        spark.conf.set("spark.sql.ansi.enabled", before)
