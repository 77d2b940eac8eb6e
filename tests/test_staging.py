"""Cleaners on hand-written rows (FIXTURES.md M1-M5)."""

import datetime as dt
from decimal import Decimal

import pytest

from growthlens.operators import staging
from growthlens.sources.schemas import BREVO_RAW, GA4_RAW, GSC_RAW, META_ADS_RAW, POSTHOG_RAW
from tests.conftest import rows

D = "2024-01-01"
L = "2024-02-01T00:00:00"


def test_meta_cleaning_three_valued_filter(spark):
    raw = spark.createDataFrame(
        [
            ("k1", "c", 10.0, 100, 5, 1, D, L),
            ("drop_zero", "c", 0.0, 0, 0, 0, D, L),
            ("drop_unknown1", "c", None, 0, 3, 1, D, L),
            ("drop_unknown2", "c", None, None, 3, 1, D, L),
            ("drop_unknown3", "c", 0.0, None, 3, 1, D, L),
            ("k2", "c", None, 10, None, 1, D, L),
            ("k3", "c", 5.0, 0, 0, 0, D, L),
            ("k4", "c", 5.0, None, 2, 1, D, L),
            ("drop_nodate", "c", 10.0, 100, 5, 1, None, L),
        ],
        META_ADS_RAW,
    )
    out = staging.clean_meta_ads(raw).orderBy("campaign_id")
    got = rows(out, "campaign_id", "spend_eur", "impressions", "clicks", "ctr", "conversion_rate", "date")
    day = dt.date(2024, 1, 1)
    assert got == [
        ("k1", Decimal("10.00"), 100, 5, 0.05, 0.2, day),
        ("k2", Decimal("0.00"), 10, 0, None, None, day),
        ("k3", Decimal("5.00"), 0, 0, None, None, day),
        ("k4", Decimal("5.00"), 0, 2, None, 0.5, day),
    ]
    assert dict(out.dtypes)["spend_eur"] == "double"


def test_search_buckets_and_filter(spark):
    data = [(f"q{i}", 10, 1, 0.1, p, D, L) for i, p in enumerate([3.0, 3.1, 10.0, 10.1, 20.0, 20.1, 0.0, None])]
    data += [("zero", 0, 1, 0.1, 5.0, D, L), ("null", None, 1, 0.1, 5.0, D, L)]
    out = staging.clean_gsc(spark.createDataFrame(data, GSC_RAW)).orderBy("query")
    got = rows(out, "query", "avg_position", "position_bucket")
    assert got == [
        ("q0", 3.0, "top_3"),
        ("q1", 3.1, "page_1"),
        ("q2", 10.0, "page_1"),
        ("q3", 10.1, "page_2"),
        ("q4", 20.0, "page_2"),
        ("q5", 20.1, "page_3_plus"),
        ("q6", 0.0, "top_3"),
        ("q7", 0.0, "page_3_plus"),
    ]


def test_web_analytics_no_clamping(spark):
    raw = spark.createDataFrame(
        [
            ("a", "organic", 1, 10, 15, 0.5, 2.0, 30, D, L),
            ("b", "organic", 1, None, 4, 0.5, 2.0, 30, D, L),
            ("c", "organic", None, 10, 4, 0.5, 2.0, 30, D, L),
            ("d", "organic", 0, 10, 4, 0.5, 2.0, 30, D, L),
        ],
        GA4_RAW,
    )
    got = rows(staging.clean_ga4(raw).orderBy("session_id"), "session_id", "users", "returning_users", "new_user_rate")
    assert got == [("a", 10, -5, 1.5), ("b", 0, -4, None)]


def test_email_rates_use_raw_inputs(spark):
    raw = spark.createDataFrame(
        [
            ("a", "n", 100, None, 4, 1, 0, D, L),
            ("b", "n", 100, 0, 4, 1, 0, D, L),
            ("c", "n", 0, 10, 4, 1, 0, D, L),
        ],
        BREVO_RAW,
    )
    got = rows(
        staging.clean_brevo(raw).orderBy("campaign_id"),
        "campaign_id",
        "emails_opened",
        "open_rate",
        "click_rate",
        "click_to_open_rate",
    )
    assert got == [("a", 0, None, 0.04, None), ("b", 0, 0.0, 0.04, None)]


def test_event_flags_are_strict(spark):
    raw = spark.createDataFrame(
        [
            ("e1", "u1", "churned", "organic", "IE", D, L),
            ("e2", "u1", None, "organic", "IE", D, L),
            ("e3", None, "signup", "organic", "IE", D, L),
            ("e4", "u1", "signup", "organic", "IE", None, L),
        ],
        POSTHOG_RAW,
    )
    got = rows(
        staging.clean_posthog(raw).orderBy("event_id"),
        "event_id",
        "is_signup",
        "is_activation",
        "is_purchase",
        "is_churn",
        "event_date",
    )
    assert got == [
        ("e1", False, False, False, True, dt.date(2024, 1, 1)),
        ("e2", False, False, False, False, dt.date(2024, 1, 1)),
    ]


def test_bad_date_text_fails_the_load(spark):
    raw = spark.createDataFrame([("k", "c", 1.0, 1, 1, 1, "2024-13-45", L)], META_ADS_RAW)
    with pytest.raises(Exception):
        staging.clean_meta_ads(raw).collect()


def test_staging_filters_reach_the_scan(spark, tmp_path):
    raw = spark.createDataFrame([("k", "c", 1.0, 1, 1, 1, D, L)], META_ADS_RAW)
    path = str(tmp_path / "meta")
    raw.write.parquet(path)
    scanned = spark.read.schema(META_ADS_RAW).parquet(path)
    plan = staging.clean_meta_ads(scanned)._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(date)" in plan
