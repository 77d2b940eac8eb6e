"""Weekly KPIs, week-over-week changes (M10) and the long form."""

import datetime as dt

from growthlens.operators import weekly
from tests.conftest import rows

J = lambda d: dt.date(2024, 1, d)

ACQ = "date date, channel string, total_spend double, total_conversions bigint, cac double, roas double, ctr double"
ACT = "date date, channel string, total_signups bigint, activation_rate double, churn_rate double"
REF = "date date, organic_sessions bigint, organic_traffic_share double, k_factor_estimate double"


def marts(spark, acq, act, ref):
    return (
        spark.createDataFrame(acq, ACQ),
        spark.createDataFrame(act, ACT),
        spark.createDataFrame(ref, REF),
    )


def test_week_bounds():
    assert weekly.week_bounds(J(7)) == (J(1), J(7))
    assert weekly.week_bounds(J(8)) == (J(8), J(14))
    assert weekly.week_bounds(J(10), week_offset=1) == (J(1), J(7))


def test_weekly_kpis_means_of_daily_ratios_and_zero_fill(spark):
    acq, act, ref = marts(
        spark,
        [
            (J(1), "meta", 10.0, 2, 5.0, 10.0, 0.01),
            (J(2), "meta", 20.0, 0, None, 0.0, 0.03),
            (J(8), "meta", 30.0, 3, 10.0, 5.0, 0.02),
        ],
        [(J(3), "a", 4, 0.5, 0.25)],
        [],
    )
    out = weekly.weekly_kpis(acq, act, ref).orderBy("week_start")
    got = rows(out)
    assert out.columns[:2] == ["week_start", "week_end"]
    # week 1: avg_cac over non-NULL days only (5.0); ctr mean 0.02 -> 2.0 %
    assert got[0] == (J(1), J(7), 5.0, 5.0, 30.0, 2, 2.0, 50.0, 25.0, 4, 0.0, 0.0, 0)
    assert got[1] == (J(8), J(14), 10.0, 5.0, 30.0, 3, 2.0, 0.0, 0.0, 0, 0.0, 0.0, 0)


def test_delta_against_previous_calendar_week(spark):
    acq, act, ref = marts(
        spark,
        [(J(1), "meta", 10.0, 10, 10.0, 1.0, 0.0), (J(8), "meta", 11.0, 9, 11.0, 1.0, 0.0)],
        [],
        [(J(1), 10, 0.5, 0.1), (J(15), 5, 0.5, 0.1)],
    )
    got = {r["week_start"]: r for r in weekly.weekly_delta(acq, act, ref).collect()}
    assert got[J(1)]["cac_change"] == 0.0  # no previous week -> 0
    assert got[J(8)]["cac_change"] == 10.0
    assert got[J(8)]["conversions_change"] == -10.0
    assert got[J(8)]["organic_change"] == -100.0  # 10 -> 0
    # week of Jan 15 follows the (present) week of Jan 8, whose organic sessions are 0
    assert got[J(15)]["organic_change"] == 0.0
    assert got[J(15)]["cac_change"] == -100.0


def test_single_week_form(spark):
    acq, act, ref = marts(spark, [(J(8), "meta", 11.0, 9, 11.0, 1.0, 0.0)], [], [])
    this_week = weekly.weekly_kpis(acq, act, ref, as_of=J(10)).collect()
    assert len(this_week) == 1 and this_week[0]["avg_cac"] == 11.0 and this_week[0]["week_start"] == J(8)
    empty_week = weekly.weekly_kpis(acq, act, ref, as_of=J(10), week_offset=1).collect()
    assert len(empty_week) == 1
    assert empty_week[0]["week_start"] == J(1) and empty_week[0]["week_end"] == J(7)
    assert empty_week[0]["total_conversions"] == 0 and empty_week[0]["avg_cac"] == 0.0


def test_kpi_long_directions(spark):
    acq, act, ref = marts(
        spark,
        [(J(1), "meta", 10.0, 10, 10.0, 1.0, 0.0), (J(8), "meta", 11.0, 9, 12.0, 2.0, 0.0)],
        [],
        [],
    )
    long = weekly.weekly_kpi_long(acq, act, ref)
    got = {(r["week_start"], r["metric"]): r for r in long.collect()}
    assert len(got) == 2 * 11
    assert got[(J(8), "avg_cac")]["direction"] == "bad"  # CAC up
    assert got[(J(8), "avg_roas")]["direction"] == "good"  # ROAS up
    assert got[(J(8), "total_spend")]["direction"] == "up"
    assert got[(J(8), "total_conversions")]["direction"] == "down"
    assert got[(J(8), "avg_ctr_pct")]["change_pct"] is None
    assert got[(J(8), "avg_ctr_pct")]["direction"] is None
    assert got[(J(1), "avg_cac")]["direction"] == "flat"
    assert got[(J(8), "organic_sessions")]["family"] == "organic/referral"


def test_single_week_delta_matches_all_weeks_form(spark):
    acq, act, ref = marts(
        spark,
        [(J(1), "meta", 10.0, 10, 10.0, 1.0, 0.0), (J(8), "meta", 11.0, 9, 11.0, 1.0, 0.0)],
        [(J(2), "a", 3, 0.5, 0.1), (J(9), "a", 4, 0.25, 0.2)],
        [(J(1), 10, 0.5, 0.1)],
    )
    every = {r["week_start"]: r.asDict() for r in weekly.weekly_delta(acq, act, ref).collect()}
    one = weekly.weekly_delta(acq, act, ref, as_of=J(12)).collect()
    assert len(one) == 1 and one[0].asDict() == every[J(8)]
    assert one[0]["activation_change"] == -50.0


def test_weekly_brief_latest_week_and_as_of(spark):
    acq, act, ref = marts(
        spark,
        [(J(1), "meta", 10.0, 10, 10.0, 1.0, 0.0), (J(8), "meta", 11.0, 9, 11.0, 1.0, 0.0)],
        [(J(2), "a", 3, 0.5, 0.1)],
        [],
    )
    latest = weekly.weekly_brief(acq, act, ref).collect()
    assert len(latest) == 1 and latest[0]["week_start"] == J(8) and latest[0]["cac_change"] == 10.0
    first = weekly.weekly_brief(acq, act, ref, as_of=J(3)).collect()
    assert len(first) == 1 and first[0]["week_start"] == J(1) and first[0]["total_signups"] == 3
    plan = weekly.weekly_brief(acq, act, ref)._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan
