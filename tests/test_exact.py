"""Exact sums of doubles against ``math.fsum``."""

import math
import random

import pytest
from pyspark.sql import functions as F

from growthlens.functions import exact_totals


def amounts(r, kind):
    if kind == "money":
        return round(r.uniform(-10, 1000), 2)
    if kind == "any size":
        return r.uniform(-1, 1) * 10 ** r.randint(-300, 300)
    if kind == "near":
        return r.uniform(-1, 1) * 10 ** r.randint(-20, 20)
    if kind == "cancelling":
        return r.choice([1e16, 1.0, -1e16, 2**-1074, 2.0 ** r.randint(-1074, 1000), -(2.0 ** r.randint(-1074, 1000)), 0.0, -0.0])
    if kind == "subnormal":
        return math.ldexp(r.choice([1, -1]) * (2**53 - 1), r.randint(-1074, -900))
    return r.choice([0.5, 0.25, 2.0**52, 2.0**53, 2.0**53 + 2, 2.0**104, -(2.0**104), 1.5])  # ties


@pytest.fixture(scope="module")
def groups():
    r, out = random.Random(1), {}
    for g in range(120):
        kind = ("money", "any size", "near", "cancelling", "subnormal", "ties")[g % 6]
        out[g] = [amounts(r, kind) for _ in range(r.randint(1, 60))]
        if g % 4 == 0:  # most of it cancels
            out[g] += [-v for v in out[g]][: r.randint(0, 40)]
    return out


@pytest.mark.parametrize("parts", [1, 7])
def test_sums_equal_fsum_whatever_the_partitions(spark, groups, parts):
    frame = spark.createDataFrame([(g, v) for g, vs in groups.items() for v in vs], "g int, v double").repartition(parts)
    got = {x["g"]: (x["s"], x["s_count"]) for x in exact_totals(frame, ["g"], {"s": F.col("v")}).collect()}
    assert got == {g: (math.fsum(vs), len(vs)) for g, vs in groups.items()}


@pytest.mark.parametrize(("value", "n", "want"), [(9e14, 200_000, 1.8e20), (1e-19, 1_000_000, 1e-13), (1e300, 1000, 1e303), (5e-324, 1000, 4.94e-321)])
def test_no_limit_on_size(spark, value, n, want):
    frame = spark.range(n).select(F.lit(value).alias("v"))
    assert exact_totals(frame, [], {"s": F.col("v")}).first()["s"] == want == math.fsum([value] * n)


def test_what_is_not_finite_propagates(spark):
    inf, nan = float("inf"), float("nan")
    data = [(1, inf), (1, 1.0), (2, inf), (2, -inf), (3, nan), (3, inf), (4, 1e308), (4, 1e308), (5, None), (6, None), (6, 2.5), (7, -0.0)]
    got = {x["g"]: x["s"] for x in exact_totals(spark.createDataFrame(data, "g int, v double"), ["g"], {"s": F.col("v")}).collect()}
    assert got[1] == inf and math.isnan(got[2]) and math.isnan(got[3]) and got[4] == inf
    assert got[5] is None and got[6] == 2.5 and got[7] == 0.0


def test_several_columns_and_whole_numbers(spark):
    r = random.Random(4)
    data = [(r.choice(["a", None]), r.uniform(0, 9), r.choice([None, r.uniform(-9, 9)]), r.choice([None, r.randint(0, 2**55)])) for _ in range(500)]
    frame = spark.createDataFrame(data, "k string, x double, y double, n long")
    got = exact_totals(frame, ["k"], {"x": F.col("x"), "y": F.col("y")}, {"n": F.col("n"), "one": F.lit(1)}).collect()
    for row in got:
        mine = [d for d in data if d[0] == row["k"]]
        ys, ns = [d[2] for d in mine if d[2] is not None], [d[3] for d in mine if d[3] is not None]
        assert (row["x"], row["x_count"]) == (math.fsum(d[1] for d in mine), len(mine))
        assert (row["y"], row["y_count"]) == (math.fsum(ys), len(ys))
        assert (row["n"], row["one"]) == (sum(ns), len(mine))


def test_plan_has_two_narrow_aggregations_and_no_python(spark):
    frame = spark.range(10).select((F.col("id") % 3).alias("k"), F.col("id").cast("double").alias("v"))
    plan = exact_totals(frame, ["k"], {"v": F.col("v")})._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and plan.count("Exchange") == 2
