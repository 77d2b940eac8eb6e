"""Dashboard datasets and the serving-layer ordering.

Thin aggregates over the marts for the six dashboard tabs plus the email
summary.  Sums of money go through exact decimals; every rate is a ratio of
sums (except where a mean of daily values is the stated metric).  Ordering is
applied only here, at the edge, never inside a mart.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from growthlens.functions import exact_totals, ratio
from growthlens.operators.marts import AVG_ORDER_VALUE, FUNNEL_COUNTS

col = F.col

# Retention milestones (days after the cohort day).
MILESTONES = (1, 7, 30)

# The serving order of each mart.
SORT_KEYS: dict[str, tuple[tuple[str, bool], ...]] = {
    "mart_acquisition": (("date", False), ("channel", True)),
    "mart_activation": (("date", False), ("channel", True)),
    "mart_retention": (("cohort_date", False), ("days_since_signup", True)),
    "mart_revenue": (("date", False), ("channel", True)),
    "mart_referral": (("date", False),),
}


def ordered(name: str, mart: DataFrame) -> DataFrame:
    """The mart in its presentation order (NULLs first ascending, last descending)."""
    keys: list[Column] = [col(c).asc_nulls_first() if asc else col(c).desc_nulls_last() for c, asc in SORT_KEYS[name]]
    return mart.orderBy(*keys)


def exec_overview_daily(mart_acquisition: DataFrame) -> DataFrame:
    """Per day across ad platforms: spend, conversions, CAC (ratio of sums)."""
    spend, counts = {"total_spend": col("total_spend")}, {"total_conversions": col("total_conversions")}
    daily = exact_totals(mart_acquisition, ["date"], spend, counts)
    return daily.select("date", "total_spend", "total_conversions", ratio("total_spend", "total_conversions").alias("cac"))


def channel_cac(mart_acquisition: DataFrame, avg_order_value: float = AVG_ORDER_VALUE) -> DataFrame:
    """Per ad platform over the whole period: spend, clicks, conversions, CAC, ROAS."""
    counts = {c: col(c) for c in ("total_clicks", "total_conversions")}
    totals = exact_totals(mart_acquisition, ["channel"], {"total_spend": col("total_spend")}, counts)
    return totals.select(
        "channel",
        "total_spend",
        "total_clicks",
        "total_conversions",
        ratio("total_spend", "total_conversions").alias("cac"),
        ratio(col("total_conversions") * F.lit(avg_order_value), "total_spend").alias("roas"),
    )


def retention_milestones(mart_retention: DataFrame, milestones: Sequence[int] = MILESTONES) -> DataFrame:
    """Per cohort: size and retention on the milestone days (NULL if nobody was seen that day)."""
    rates = [
        F.max(F.when(col("days_since_signup") == d, col("retention_rate"))).alias(f"d{d}_retention")
        for d in milestones
    ]
    return mart_retention.groupBy("cohort_date").agg(F.max("cohort_size").alias("cohort_size"), *rates)


# Estimates are whole numbers unless the constants they are made with are not.
_ESTIMATES = ("estimated_revenue_eur", "estimated_mrr_eur", "estimated_ltv_eur")


def _is_double(df: DataFrame, c: str) -> bool:
    return df.schema[c].dataType.typeName() in ("double", "float", "decimal")


def revenue_by_channel(mart_revenue: DataFrame) -> DataFrame:
    """Per channel: MRR, LTV, LTV:CAC (aggregate LTV over CAC of the period), mean payback."""
    whole = ("total_conversions", *(c for c in _ESTIMATES if not _is_double(mart_revenue, c)))
    doubles = ("total_spend", "cac_payback_months", *(c for c in _ESTIMATES if c not in whole))
    totals = exact_totals(mart_revenue, ["channel"], {c: col(c) for c in doubles}, {c: col(c) for c in whole})
    cac = ratio("total_spend", "total_conversions")
    return totals.select(
        "channel",
        "total_spend",
        "total_conversions",
        "estimated_revenue_eur",
        "estimated_mrr_eur",
        "estimated_ltv_eur",
        cac.alias("cac"),
        ratio("estimated_ltv_eur", cac).alias("ltv_cac_ratio"),
        ratio("cac_payback_months", "cac_payback_months_count").alias("avg_cac_payback_months"),
    )


def referral_trend(mart_referral: DataFrame) -> DataFrame:
    """Per organic day: organic and paid sessions, k-factor, organic share."""
    return mart_referral.select(
        "date", "organic_sessions", "paid_sessions", "k_factor_estimate", "organic_traffic_share"
    )


def funnel_daily(stg_posthog: DataFrame | None = None, *, funnel_counts: DataFrame | None = None) -> DataFrame:
    """Full funnel per day across all channels (days without signups included).

    From the cleaned events, or by summing precomputed (date, channel) counts.
    """
    if funnel_counts is not None:
        daily = funnel_counts.groupBy("date").agg(*[F.sum(c).alias(c) for c in FUNNEL_COUNTS])
    else:
        daily = stg_posthog.groupBy(col("event_date").alias("date")).agg(
            F.count_if("is_signup").alias("total_signups"),
            F.count_if("is_activation").alias("total_activations"),
            F.count_if("is_purchase").alias("total_purchases"),
            F.count_if("is_churn").alias("total_churns"),
        )
    return daily.select(
        "date",
        "total_signups",
        "total_activations",
        "total_purchases",
        "total_churns",
        ratio("total_activations", "total_signups").alias("activation_rate"),
        ratio("total_purchases", "total_activations").alias("purchase_rate"),
        ratio("total_churns", "total_signups").alias("churn_rate"),
    )


def email_campaign_summary(stg_brevo: DataFrame) -> DataFrame:
    """Per email campaign: volume totals and ratio-of-sums engagement rates."""
    totals = stg_brevo.groupBy("campaign_name").agg(
        F.count(F.lit(1)).alias("sends"),
        F.sum("emails_sent").alias("emails_sent"),
        F.sum("emails_opened").alias("emails_opened"),
        F.sum("emails_clicked").alias("emails_clicked"),
        F.sum("unsubscribes").alias("unsubscribes"),
        F.sum("bounces").alias("bounces"),
    )
    return totals.select(
        "campaign_name",
        "sends",
        "emails_sent",
        "emails_opened",
        "emails_clicked",
        "unsubscribes",
        "bounces",
        ratio("emails_opened", "emails_sent").alias("open_rate"),
        ratio("emails_clicked", "emails_sent").alias("click_rate"),
        ratio("emails_clicked", "emails_opened").alias("click_to_open_rate"),
        ratio("unsubscribes", "emails_sent").alias("unsubscribe_rate"),
        ratio("bounces", "emails_sent").alias("bounce_rate"),
    )
