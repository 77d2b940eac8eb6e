"""All relations of the warehouse as one lazy graph over six raw feeds.

``Relations`` wires feeds -> staging -> marts -> weekly KPIs, checks and
dashboard datasets.  Each relation is a lazy DataFrame built on first access
and reused by the relations that read it, so asking for one relation plans
(and later scans) only the feeds it needs.  ``register_views`` exposes them as
temporary views for SQL users, the way staging models are views.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable, Mapping
from functools import cached_property

from pyspark.sql import DataFrame

from growthlens.operators import checks, marts, serving, staging, weekly

# Days of the registered single-week reports.
AS_OF = dt.date(2024, 3, 6)
AS_OF_EMPTY = dt.date(2021, 5, 5)

STAGING_NAMES = ("stg_meta_ads", "stg_google_ads", "stg_ga4", "stg_gsc", "stg_brevo", "stg_posthog")
MART_NAMES = ("mart_acquisition", "mart_activation", "mart_retention", "mart_revenue", "mart_referral")
WEEKLY_NAMES = (
    "weekly_acquisition",
    "weekly_activation",
    "weekly_referral",
    "weekly_kpis",
    "weekly_delta",
    "weekly_kpi_long",
    "weekly_brief",
    "weekly_kpis_as_of",
    "weekly_kpis_offset",
    "weekly_delta_as_of",
    "weekly_brief_as_of",
    "weekly_brief_empty_week",
)
CHECK_NAMES = ("dq_not_null", "dq_accepted_values", "dq_expect_no_rows", "data_checks")
SERVING_NAMES = (
    "exec_overview_daily",
    "channel_cac",
    "retention_milestones",
    "revenue_by_channel",
    "referral_trend",
    "funnel_daily",
    "email_campaign_summary",
    "serving_sorted",
    "serving_sorted_activation",
    "serving_sorted_retention",
    "serving_sorted_revenue",
    "serving_sorted_referral",
)
ALL_NAMES = STAGING_NAMES + MART_NAMES + WEEKLY_NAMES + CHECK_NAMES + SERVING_NAMES


class _LazyRelations(Mapping):
    def __init__(self, relations: "Relations", names: tuple[str, ...]):
        self._rel, self._names = relations, names

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._names:
            raise KeyError(name)
        return getattr(self._rel, name)

    def __iter__(self):
        return iter(self._names)

    def __len__(self) -> int:
        return len(self._names)


class Relations:
    """Lazy relation graph over raw feeds (``meta_ads_raw`` ... ``posthog_raw``).

    ``mart_params`` go to the revenue mart (``avg_order_value``,
    ``monthly_price``, ``lifetime_months``, ``channel_map``).
    """

    def __init__(self, feeds: Mapping[str, DataFrame] | None = None, **mart_params):
        self._feeds = dict(feeds or {})
        self.mart_params = mart_params

    def _order_value(self) -> dict:
        """The one order value that every ROAS uses, if it was given."""
        return {k: v for k, v in self.mart_params.items() if k == "avg_order_value"}

    def raw(self, name: str) -> DataFrame:
        if name not in self._feeds:
            raise KeyError(f"feed {name!r} is needed but was not given (have: {sorted(self._feeds)})")
        return self._feeds[name]

    # staging ------------------------------------------------------------
    @cached_property
    def stg_meta_ads(self) -> DataFrame:
        return staging.clean_meta_ads(self.raw("meta_ads_raw"))

    @cached_property
    def stg_google_ads(self) -> DataFrame:
        return staging.clean_google_ads(self.raw("google_ads_raw"))

    @cached_property
    def stg_ga4(self) -> DataFrame:
        return staging.clean_ga4(self.raw("ga4_raw"))

    @cached_property
    def stg_gsc(self) -> DataFrame:
        return staging.clean_gsc(self.raw("gsc_raw"))

    @cached_property
    def stg_brevo(self) -> DataFrame:
        return staging.clean_brevo(self.raw("brevo_raw"))

    @cached_property
    def stg_posthog(self) -> DataFrame:
        return staging.clean_posthog(self.raw("posthog_raw"))

    # marts ----------------------------------------------------------------
    @cached_property
    def mart_acquisition(self) -> DataFrame:
        return marts.acquisition(self.stg_meta_ads, self.stg_google_ads, **self._order_value())

    @cached_property
    def mart_activation(self) -> DataFrame:
        return marts.activation(self.stg_posthog)

    @cached_property
    def mart_retention(self) -> DataFrame:
        return marts.retention(self.stg_posthog)

    @cached_property
    def mart_revenue(self) -> DataFrame:
        return marts.unit_economics(self.mart_acquisition, self.stg_posthog, **self.mart_params)

    @cached_property
    def mart_referral(self) -> DataFrame:
        return marts.referral(self.stg_ga4, self.stg_gsc, self.stg_posthog)

    # weekly -----------------------------------------------------------------
    @cached_property
    def weekly_acquisition(self) -> DataFrame:
        return weekly.weekly_acquisition(self.mart_acquisition)

    @cached_property
    def weekly_activation(self) -> DataFrame:
        return weekly.weekly_activation(self.mart_activation)

    @cached_property
    def weekly_referral(self) -> DataFrame:
        return weekly.weekly_referral(self.mart_referral)

    @cached_property
    def weekly_kpis(self) -> DataFrame:
        return weekly.weekly_kpis(self.mart_acquisition, self.mart_activation, self.mart_referral)

    @cached_property
    def weekly_delta(self) -> DataFrame:
        return weekly.weekly_delta(self.mart_acquisition, self.mart_activation, self.mart_referral)

    @cached_property
    def weekly_kpi_long(self) -> DataFrame:
        return weekly.weekly_kpi_long(self.mart_acquisition, self.mart_activation, self.mart_referral)

    @cached_property
    def weekly_brief(self) -> DataFrame:
        return weekly.weekly_brief(self.mart_acquisition, self.mart_activation, self.mart_referral)

    # one week of the report; the fixed dates lie in, before and behind the data
    @cached_property
    def weekly_kpis_as_of(self) -> DataFrame:
        return weekly.weekly_kpis(self.mart_acquisition, self.mart_activation, self.mart_referral, AS_OF)

    @cached_property
    def weekly_kpis_offset(self) -> DataFrame:
        return weekly.weekly_kpis(self.mart_acquisition, self.mart_activation, self.mart_referral, AS_OF, 2)

    @cached_property
    def weekly_delta_as_of(self) -> DataFrame:
        return weekly.weekly_delta(self.mart_acquisition, self.mart_activation, self.mart_referral, AS_OF)

    @cached_property
    def weekly_brief_as_of(self) -> DataFrame:
        return weekly.weekly_brief(self.mart_acquisition, self.mart_activation, self.mart_referral, AS_OF)

    @cached_property
    def weekly_brief_empty_week(self) -> DataFrame:
        return weekly.weekly_brief(self.mart_acquisition, self.mart_activation, self.mart_referral, AS_OF_EMPTY)

    # checks -----------------------------------------------------------------
    def _marts(self) -> Mapping[str, DataFrame]:
        """The five marts, built only when a check asks for one."""
        return _LazyRelations(self, MART_NAMES)

    @cached_property
    def dq_not_null(self) -> DataFrame:
        return checks.run_checks(self._marts(), kinds=[checks.NOT_NULL])

    @cached_property
    def dq_accepted_values(self) -> DataFrame:
        return checks.run_checks(self._marts(), kinds=[checks.ACCEPTED_VALUES])

    @cached_property
    def dq_expect_no_rows(self) -> DataFrame:
        return checks.run_checks(self._marts(), kinds=[checks.EXPECT_NO_ROWS])

    @cached_property
    def data_checks(self) -> DataFrame:
        return checks.run_checks(self._marts())

    # serving ----------------------------------------------------------------
    @cached_property
    def exec_overview_daily(self) -> DataFrame:
        return serving.exec_overview_daily(self.mart_acquisition)

    @cached_property
    def channel_cac(self) -> DataFrame:
        return serving.channel_cac(self.mart_acquisition, **self._order_value())

    @cached_property
    def retention_milestones(self) -> DataFrame:
        return serving.retention_milestones(self.mart_retention)

    @cached_property
    def revenue_by_channel(self) -> DataFrame:
        return serving.revenue_by_channel(self.mart_revenue)

    @cached_property
    def referral_trend(self) -> DataFrame:
        return serving.referral_trend(self.mart_referral)

    @cached_property
    def funnel_daily(self) -> DataFrame:
        return serving.funnel_daily(self.stg_posthog)

    @cached_property
    def email_campaign_summary(self) -> DataFrame:
        return serving.email_campaign_summary(self.stg_brevo)

    @cached_property
    def serving_sorted(self) -> DataFrame:
        return serving.ordered("mart_acquisition", self.mart_acquisition)

    @cached_property
    def serving_sorted_activation(self) -> DataFrame:
        return serving.ordered("mart_activation", self.mart_activation)

    @cached_property
    def serving_sorted_retention(self) -> DataFrame:
        return serving.ordered("mart_retention", self.mart_retention)

    @cached_property
    def serving_sorted_revenue(self) -> DataFrame:
        return serving.ordered("mart_revenue", self.mart_revenue)

    @cached_property
    def serving_sorted_referral(self) -> DataFrame:
        return serving.ordered("mart_referral", self.mart_referral)

    def register_views(self, names: Iterable[str] = STAGING_NAMES + MART_NAMES) -> list[str]:
        """Expose relations as temporary views (lazy: re-planned on each query)."""
        names = list(names)
        for name in names:
            getattr(self, name).createOrReplaceTempView(name)
        return names
