"""Marts on hand-written rows (FIXTURES.md M6-M9) and invariants on testdata."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from growthlens.catalog import Warehouse
from growthlens.operators import marts
from tests.conftest import SF_MEDIUM, SF_SMALL, rows

J = lambda d: dt.date(2024, 1, d)

EVENT_SCHEMA = (
    "event_id string, user_id string, event string, channel string, country string, "
    "is_signup boolean, is_activation boolean, is_purchase boolean, is_churn boolean, "
    "event_date date, loaded_at string"
)


def events(spark, items):
    """items: (user, day, event, channel)."""
    data = []
    for i, (user, day, event, channel) in enumerate(items):
        data.append(
            (
                f"e{i}",
                user,
                event,
                channel,
                "IE",
                event == "signup",
                event == "activation",
                event == "purchase",
                event == "churned",
                day,
                "x",
            )
        )
    return spark.createDataFrame(data, EVENT_SCHEMA)


def test_retention_first_seen_cohorts(spark):
    ev = events(
        spark,
        [
            ("u1", J(1), "page_view", "a"),
            ("u1", J(1), "page_view", "a"),
            ("u1", J(2), "page_view", "a"),
            ("u1", J(8), "page_view", "a"),
            ("u2", J(1), "signup", "a"),
            ("u3", J(2), "page_view", "a"),
            ("u3", J(3), "page_view", "a"),
        ],
    )
    expected = [
        (J(1), 2, 0, 2, 1.0),
        (J(1), 2, 1, 1, 0.5),
        (J(1), 2, 7, 1, 0.5),
        (J(2), 1, 0, 1, 1.0),
        (J(2), 1, 1, 1, 1.0),
    ]
    cols = ("cohort_date", "cohort_size", "days_since_signup", "active_users", "retention_rate")
    for build in (marts.retention,):
        out = build(ev).orderBy("cohort_date", "days_since_signup")
        assert rows(out, *cols) == expected
        assert dict(out.dtypes)["days_since_signup"] == "bigint"


def test_activation_keeps_only_days_with_signups(spark):
    ev = events(
        spark,
        [("u1", J(1), "signup", "a"), ("u2", J(1), "signup", "a")]
        + [(f"v{i}", J(1), "activation", "a") for i in range(3)]
        + [("u3", J(1), "churned", "a")]
        + [(f"w{i}", J(1), "activation", "b") for i in range(4)]
        + [("u4", J(1), "signup", "c")],
    )
    got = rows(
        marts.activation(ev).orderBy("channel"),
        "channel",
        "total_signups",
        "activation_rate",
        "purchase_rate",
        "churn_rate",
    )
    assert got == [("a", 2, 1.5, 0.0, 0.5), ("c", 1, 0.0, None, 0.0)]


def test_unit_economics(spark):
    acq = spark.createDataFrame(
        [(J(1), "meta", 100.0, 4, 25.0), (J(2), "meta", 100.0, 4, 25.0), (J(3), "meta", 100.0, 0, None)],
        "date date, channel string, total_spend double, total_conversions bigint, cac double",
    )
    ev = events(
        spark,
        [("u", J(1), "purchase", "meta")] * 3 + [("u", J(1), "activation", "meta")] * 2 + [("u", J(1), "signup", "x")],
    )
    out = marts.unit_economics(acq, ev).orderBy("date")
    got = rows(
        out,
        "estimated_revenue_eur",
        "estimated_mrr_eur",
        "roas",
        "estimated_ltv_eur",
        "ltv_cac_ratio",
        "cac_payback_months",
    )
    assert got[0][:4] == (150, 58, 1.5, 348)
    assert got[0][4] == pytest.approx(13.92)
    assert got[0][5] == pytest.approx(25 / 29)
    assert got[1] == (0, 0, 0.0, 0, 0.0, 25.0 / 29)
    assert got[2][4] is None and got[2][5] is None


def test_unit_economics_channel_map(spark):
    acq = spark.createDataFrame(
        [(J(1), "meta", 100.0, 4, 25.0)],
        "date date, channel string, total_spend double, total_conversions bigint, cac double",
    )
    ev = events(spark, [("u", J(1), "purchase", "facebook"), ("u", J(1), "purchase", "instagram")])
    plain = marts.unit_economics(acq, ev).first()
    mapped = marts.unit_economics(acq, ev, channel_map={"facebook": "meta", "instagram": "meta"}).first()
    assert plain["purchases"] == 0 and mapped["purchases"] == 2


def test_referral(spark):
    web = spark.createDataFrame(
        [
            (J(1), "organic", 30, 20, 5),
            (J(1), "email", 10, 7, 1),
            (J(1), None, 99, 50, 3),
            (J(2), "facebook", 40, 10, 1),
        ],
        "date date, channel string, sessions bigint, users bigint, new_users bigint",
    )
    search = spark.createDataFrame([], "date date, impressions bigint, clicks bigint, avg_position double")
    ev = events(spark, [("u1", J(1), "signup", "a")] * 3)
    out = marts.referral(web, search, ev)
    got = rows(out)
    assert out.columns == [
        "date",
        "organic_sessions",
        "organic_users",
        "new_organic_users",
        "paid_sessions",
        "search_impressions",
        "search_clicks",
        "avg_search_position",
        "total_new_signups",
        "organic_traffic_share",
        "k_factor_estimate",
        "search_ctr",
    ]
    assert got == [(J(1), 30, 20, 5, 10, 0, 0, 0.0, 1, 0.75, 0.25, None)]


def test_acquisition_union_row_count(spark):
    wh = Warehouse(spark, SF_SMALL)
    acq = wh.mart_acquisition
    meta_days = wh.stg_meta_ads.select("date").distinct().count()
    google_days = wh.stg_google_ads.select("date").distinct().count()
    assert acq.count() == meta_days + google_days
    assert {r[0] for r in acq.select("channel").distinct().collect()} == {"meta", "google"}


def test_retention_invariants(spark):
    wh = Warehouse(spark, SF_MEDIUM)
    ret = wh.mart_retention
    day0 = ret.where("days_since_signup = 0")
    assert day0.where("active_users != cohort_size").count() == 0
    assert ret.where("retention_rate <= 0 or retention_rate > 1").count() == 0
    users = wh.stg_posthog.select("user_id").distinct().count()
    assert day0.agg(F.sum("cohort_size")).first()[0] == users


def test_results_do_not_depend_on_shuffle_partitions(spark):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        results = []
        for n in ("1", "7"):
            spark.conf.set("spark.sql.shuffle.partitions", n)
            wh = Warehouse(spark, SF_SMALL)
            results.append(
                (
                    sorted(rows(wh.mart_acquisition)),
                    sorted(rows(wh.mart_retention)),
                    sorted(rows(wh.mart_referral)),
                    sorted(rows(wh.weekly_kpis)),
                    sorted(rows(wh.weekly_delta)),
                )
            )
        assert results[0] == results[1]
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_shared_intermediates_give_the_same_marts(spark):
    wh = Warehouse(spark, SF_MEDIUM)
    ev = wh.stg_posthog
    counts = marts.daily_funnel_counts(ev)
    days = marts.user_active_days(ev, with_signup_flag=True)

    def same(a, b):
        b = b.select(*a.columns)
        return a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0

    assert same(marts.activation(ev), marts.activation(funnel_counts=counts))
    assert same(marts.retention(ev), marts.retention(user_days=days))
    assert same(marts.unit_economics(wh.mart_acquisition, ev), marts.unit_economics(wh.mart_acquisition, funnel_counts=counts))
    assert same(marts.referral(wh.stg_ga4, wh.stg_gsc, ev), marts.referral(wh.stg_ga4, wh.stg_gsc, user_days=days))
    from growthlens.operators import serving

    assert same(serving.funnel_daily(ev), serving.funnel_daily(funnel_counts=counts))
