"""Declared schemas of the six raw feeds (never inferred).

Dates arrive as ``YYYY-MM-DD`` strings and the load stamp as an ISO string;
the cleaners cast them.
"""

from __future__ import annotations

from pyspark.sql.types import DoubleType, LongType, StringType, StructField, StructType


def _schema(*fields: tuple[str, object]) -> StructType:
    return StructType([StructField(name, dtype, True) for name, dtype in fields])


S, I, F_ = StringType(), LongType(), DoubleType()

META_ADS_RAW = _schema(
    ("campaign_id", S),
    ("campaign_name", S),
    ("spend", F_),
    ("impressions", I),
    ("clicks", I),
    ("conversions", I),
    ("date", S),
    ("loaded_at", S),
)

GOOGLE_ADS_RAW = _schema(
    ("keyword_id", S),
    ("keyword", S),
    ("clicks", I),
    ("impressions", I),
    ("cost", F_),
    ("conversions", I),
    ("quality_score", I),
    ("date", S),
    ("loaded_at", S),
)

GA4_RAW = _schema(
    ("session_id", S),
    ("channel", S),
    ("sessions", I),
    ("users", I),
    ("new_users", I),
    ("bounce_rate", F_),
    ("pages_per_session", F_),
    ("avg_session_duration", I),
    ("date", S),
    ("loaded_at", S),
)

GSC_RAW = _schema(
    ("query", S),
    ("impressions", I),
    ("clicks", I),
    ("ctr", F_),
    ("position", F_),
    ("date", S),
    ("loaded_at", S),
)

BREVO_RAW = _schema(
    ("campaign_id", S),
    ("campaign_name", S),
    ("sent", I),
    ("opens", I),
    ("clicks", I),
    ("unsubscribes", I),
    ("bounces", I),
    ("date", S),
    ("loaded_at", S),
)

POSTHOG_RAW = _schema(
    ("event_id", S),
    ("user_id", S),
    ("event", S),
    ("channel", S),
    ("country", S),
    ("timestamp", S),
    ("loaded_at", S),
)

FEED_SCHEMAS: dict[str, StructType] = {
    "meta_ads_raw": META_ADS_RAW,
    "google_ads_raw": GOOGLE_ADS_RAW,
    "ga4_raw": GA4_RAW,
    "gsc_raw": GSC_RAW,
    "brevo_raw": BREVO_RAW,
    "posthog_raw": POSTHOG_RAW,
}
