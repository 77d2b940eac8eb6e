"""Feed cleaners: ``raw DataFrame -> cleaned DataFrame`` (row-wise, stateless).

Rules kept on purpose:

* counts and money are NULL -> 0, but ratios use the *raw* (nullable) inputs,
  so a NULL click count gives ``clicks = 0`` and ``ctr = NULL``;
* filters run on raw values under three-valued logic, before any coalesce
  (a NULL spend with zero impressions is UNKNOWN and therefore dropped);
* date text is cast strictly (a bad date fails the job, like the original load).

All filters are plain predicates on scan columns, so Catalyst pushes them into
the parquet reader.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from growthlens.functions import double_or_zero, flag, or_zero, position_bucket, ratio, strict_date

col = F.col

# Product event names behind the four funnel flags.
SIGNUP_EVENT = "signup"
ACTIVATION_EVENT = "activation"
PURCHASE_EVENT = "purchase"
CHURN_EVENT = "churned"


def clean_meta_ads(raw: DataFrame) -> DataFrame:
    """Paid social: drop rows without a date and rows with no spend and no impressions."""
    no_activity = (col("spend") == 0) & (col("impressions") == 0)
    return raw.where(col("date").isNotNull() & ~no_activity).select(
        "campaign_id",
        "campaign_name",
        double_or_zero("spend").alias("spend_eur"),
        or_zero("impressions").alias("impressions"),
        or_zero("clicks").alias("clicks"),
        or_zero("conversions").alias("conversions"),
        ratio("clicks", "impressions").alias("ctr"),
        ratio("conversions", "clicks").alias("conversion_rate"),
        strict_date("date").alias("date"),
        "loaded_at",
    )


def clean_google_ads(raw: DataFrame) -> DataFrame:
    """Paid search: only rows without a date are dropped (zero-activity rows stay)."""
    return raw.where(col("date").isNotNull()).select(
        "keyword_id",
        "keyword",
        or_zero("clicks").alias("clicks"),
        or_zero("impressions").alias("impressions"),
        double_or_zero("cost").alias("cost_eur"),
        or_zero("conversions").alias("conversions"),
        or_zero("quality_score").alias("quality_score"),
        ratio("clicks", "impressions").alias("ctr"),
        ratio("cost", "clicks").alias("cost_per_click"),
        ratio("conversions", "clicks").alias("conversion_rate"),
        strict_date("date").alias("date"),
        "loaded_at",
    )


def clean_ga4(raw: DataFrame) -> DataFrame:
    """Web analytics (channel x day rows): keep rows with a date and sessions > 0.

    ``returning_users`` may be negative and ``new_user_rate`` above 1; no clamping.
    """
    return raw.where(col("date").isNotNull() & (col("sessions") > 0)).select(
        "session_id",
        "channel",
        or_zero("sessions").alias("sessions"),
        or_zero("users").alias("users"),
        or_zero("new_users").alias("new_users"),
        or_zero("bounce_rate").alias("bounce_rate"),
        or_zero("pages_per_session").alias("pages_per_session"),
        or_zero("avg_session_duration").alias("avg_session_duration_seconds"),
        (or_zero("users") - or_zero("new_users")).alias("returning_users"),
        ratio("new_users", "users").alias("new_user_rate"),
        strict_date("date").alias("date"),
        "loaded_at",
    )


def clean_gsc(raw: DataFrame) -> DataFrame:
    """Search console: keep rows with a date and impressions > 0.

    The bucket tests the raw position, so a NULL position reports
    ``avg_position = 0`` *and* the last bucket.  ``ctr`` is passed through.
    """
    return raw.where(col("date").isNotNull() & (col("impressions") > 0)).select(
        "query",
        or_zero("impressions").alias("impressions"),
        or_zero("clicks").alias("clicks"),
        or_zero("ctr").alias("ctr"),
        or_zero("position").alias("avg_position"),
        position_bucket("position").alias("position_bucket"),
        strict_date("date").alias("date"),
        "loaded_at",
    )


def clean_brevo(raw: DataFrame) -> DataFrame:
    """Email campaigns: keep rows with a date and sent > 0."""
    return raw.where(col("date").isNotNull() & (col("sent") > 0)).select(
        "campaign_id",
        "campaign_name",
        or_zero("sent").alias("emails_sent"),
        or_zero("opens").alias("emails_opened"),
        or_zero("clicks").alias("emails_clicked"),
        or_zero("unsubscribes").alias("unsubscribes"),
        or_zero("bounces").alias("bounces"),
        ratio("opens", "sent").alias("open_rate"),
        ratio("clicks", "sent").alias("click_rate"),
        ratio("clicks", "opens").alias("click_to_open_rate"),
        ratio("unsubscribes", "sent").alias("unsubscribe_rate"),
        strict_date("date").alias("date"),
        "loaded_at",
    )


def clean_posthog(raw: DataFrame) -> DataFrame:
    """Product events: keep rows with a timestamp and a user; add funnel flags.

    Flags are strict booleans (a NULL event gives four ``false``).  Events are
    not deduplicated: ``event_id`` is not unique by contract.
    """
    return raw.where(col("timestamp").isNotNull() & col("user_id").isNotNull()).select(
        "event_id",
        "user_id",
        "event",
        "channel",
        "country",
        flag("event", SIGNUP_EVENT).alias("is_signup"),
        flag("event", ACTIVATION_EVENT).alias("is_activation"),
        flag("event", PURCHASE_EVENT).alias("is_purchase"),
        flag("event", CHURN_EVENT).alias("is_churn"),
        strict_date("timestamp").alias("event_date"),
        "loaded_at",
    )


CLEANERS = {
    "meta_ads_raw": ("stg_meta_ads", clean_meta_ads),
    "google_ads_raw": ("stg_google_ads", clean_google_ads),
    "ga4_raw": ("stg_ga4", clean_ga4),
    "gsc_raw": ("stg_gsc", clean_gsc),
    "brevo_raw": ("stg_brevo", clean_brevo),
    "posthog_raw": ("stg_posthog", clean_posthog),
}


def clean_all(feeds: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """Apply each feed's cleaner; keys become the staging names (``stg_*``)."""
    return {stg: cleaner(feeds[raw]) for raw, (stg, cleaner) in CLEANERS.items() if raw in feeds}
