"""Every registered query against its independent DuckDB oracle (sf0.001)."""

import duckdb
import pytest

import __spark_entry__ as entry
from growthlens import catalog
from tests.conftest import SF_SMALL
from tools.compare_oracle import duck_rows, register, rows_of, spark_rows

EXPECTED_ROWS_SF0001 = {
    "stg_meta_ads": 2944,
    "stg_google_ads": 2959,
    "stg_ga4": 1412,
    "stg_gsc": 5527,
    "stg_brevo": 1464,
    "stg_posthog": 990,
    "mart_acquisition": 744,
    "mart_activation": 160,
    "mart_retention": 355,
    "mart_revenue": 744,
    "mart_referral": 159,
    "weekly_acquisition": 61,
    "weekly_activation": 9,
    "weekly_referral": 30,
    "weekly_kpis": 61,
    "weekly_delta": 61,
    "retention_milestones": 7,
    "funnel_daily": 66,
    "data_checks": 20,
}


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    register(c, SF_SMALL)
    return c


def test_every_query_has_an_oracle():
    assert set(catalog.QUERIES) <= set(entry.queries())
    assert set(catalog.QUERIES) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", sorted(catalog.QUERIES))
def test_query_matches_oracle(spark, con, name):
    s_cols, s_rows = spark_rows(entry.queries()[name](spark, SF_SMALL))
    d_cols, d_rows = duck_rows(con, entry.oracle_sql()[name])
    assert sorted(s_cols) == sorted(d_cols)
    assert len(s_rows) == len(d_rows)
    if name in EXPECTED_ROWS_SF0001:
        assert len(s_rows) == EXPECTED_ROWS_SF0001[name]
    assert rows_of(s_cols, s_rows) == rows_of(d_cols, d_rows)


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.columns == ["cohort_date", "cohort_size", "days_since_signup", "active_users", "retention_rate"]
    assert df.count() == 355
