"""The six raw feeds derived from the driver's testdata tables.

The driver's parquet tables (``lineitem``, ``orders``, ``events``) are the only
inputs; each feed is a narrow projection of one of them (no shuffle), with value
rules chosen to exercise the cleaning edge cases (NULL dates, zero rows, NULL
ratios, NULL channels, ...).  The definitions are the SQL expressions written
down in ``FIXTURES.md`` section 2; they run as ``selectExpr`` projections, which
Catalyst plans exactly like the equivalent Column code but costs the driver one
call per feed.  Tables are read with declared schemas (no inference job).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import (
    DoubleType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampNTZType,
)

from growthlens.sources.schemas import FEED_SCHEMAS


def _schema(*fields) -> StructType:
    return StructType([StructField(n, t, True) for n, t in fields])


# Declared schemas of the testdata tables the feeds read.
TABLE_SCHEMAS = {
    "lineitem": _schema(
        ("l_orderkey", LongType()),
        ("l_partkey", LongType()),
        ("l_suppkey", LongType()),
        ("l_linenumber", IntegerType()),
        ("l_quantity", DoubleType()),
        ("l_extendedprice", DoubleType()),
        ("l_discount", DoubleType()),
        ("l_tax", DoubleType()),
        ("l_returnflag", StringType()),
        ("l_linestatus", StringType()),
        ("l_shipdate", TimestampNTZType()),
    ),
    "orders": _schema(
        ("o_orderkey", LongType()),
        ("o_custkey", LongType()),
        ("o_orderstatus", StringType()),
        ("o_totalprice", DoubleType()),
        ("o_orderdate", TimestampNTZType()),
        ("o_orderpriority", StringType()),
    ),
    "events": _schema(
        ("event_id", LongType()),
        ("ts", TimestampNTZType()),
        ("user_id", LongType()),
        ("event_type", StringType()),
        ("value", DoubleType()),
        ("props", StringType()),
    ),
}

# The feed definitions (source table, row filter, one SQL
# expression per feed column, in the feed's column order).
LOADED_AT = "'2024-02-01T00:00:00'"
AD_DATE = (
    "case when l_orderkey % 97 = 0 then null "
    "else cast(date '2023-12-31' + cast(l_orderkey % 31 + 35 * (l_partkey % 12) as int) as string) end"
)

FEED_SQL: dict[str, tuple[str, str | None, dict[str, str]]] = {
    "meta_ads_raw": ("lineitem", "l_linestatus = 'F'", {
        "campaign_id": "'meta_'||cast(l_orderkey as string)||'_'||cast(l_partkey as string)||'_'||cast(l_linenumber as string)",
        "campaign_name": "case l_returnflag when 'R' then 'retargeting_q1' when 'N' then 'brand_awareness_q1' else 'lead_gen_q2' end",
        "spend": "case when l_partkey % 23 = 0 then null else cast(cast(floor(l_extendedprice*l_discount) as bigint) as double)/10000 end",
        "impressions": "case when l_partkey % 20 = 0 then 0 when l_partkey % 29 = 0 then null else cast(l_quantity as bigint)*100 end",
        "clicks": "nullif(l_partkey % 50, 49)",
        "conversions": "nullif(l_suppkey % 7, 6)",
        "date": AD_DATE,
        "loaded_at": LOADED_AT,
    }),
    "google_ads_raw": ("lineitem", "l_linestatus = 'O'", {
        "keyword_id": "'gads_'||cast(l_orderkey as string)||'_'||cast(l_partkey as string)||'_'||cast(l_linenumber as string)",
        "keyword": "'keyword_'||cast(l_partkey % 5 as string)",
        "clicks": "nullif(l_partkey % 50, 49)",
        "impressions": "cast(l_quantity as bigint)*50",
        "cost": "cast(cast(floor(l_extendedprice) as bigint) as double)/10000",
        "conversions": "case when l_orderkey % 31 = 30 then 0 else nullif(l_suppkey % 5, 4) end",
        "quality_score": "4 + l_linenumber % 7",
        "date": AD_DATE,
        "loaded_at": LOADED_AT,
    }),
    "ga4_raw": ("orders", None, {
        "session_id": "'ga4_'||cast(o_orderkey as string)",
        "channel": (
            "case when o_orderkey % 31 = 29 then 'email' else case o_custkey % 8 when 0 then 'facebook' "
            "when 1 then 'instagram' when 2 then 'google_search' when 3 then 'google_display' when 4 then 'email' "
            "when 5 then 'organic' when 6 then 'organic' end end"
        ),
        "sessions": "case when o_custkey % 37 = 0 then null else o_orderkey % 40 end",
        "users": "nullif(o_custkey % 30, 29)",
        "new_users": "o_orderkey % 25",
        "bounce_rate": "cast(o_custkey % 100 as double)/100",
        "pages_per_session": "cast(15 + o_orderkey % 45 as double)/10",
        "avg_session_duration": "30 + o_custkey % 270",
        "date": "cast(date '2024-01-01' + cast(o_orderkey % 31 + 35 * (o_custkey % 12) as int) as string)",
        "loaded_at": LOADED_AT,
    }),
    "gsc_raw": ("lineitem", None, {
        "query": "'query_'||cast(l_partkey % 6 as string)",
        "impressions": "case when l_partkey % 13 = 0 then 0 else cast(l_quantity as bigint)*10 end",
        "clicks": "nullif(l_partkey % 9, 8)",
        "ctr": "cast(l_partkey % 15 as double)/100",
        "position": "case when l_suppkey % 10 = 9 then null else cast(l_partkey % 400 as double)/7 end",
        "date": "cast(date '2024-01-01' + cast(l_orderkey % 28 + 30 * (l_suppkey % 12) as int) as string)",
        "loaded_at": LOADED_AT,
    }),
    "brevo_raw": ("orders", None, {
        "campaign_id": "'brevo_'||cast(o_orderkey as string)",
        "campaign_name": (
            "case o_orderpriority when '1-URGENT' then 'welcome_sequence' when '2-HIGH' then 'weekly_newsletter' "
            "when '3-MEDIUM' then 'product_update' else 're_engagement' end"
        ),
        "sent": "case when o_custkey % 41 = 0 then null else o_orderkey % 500 end",
        "opens": "nullif(o_custkey % 120, 119)",
        "clicks": "o_custkey % 40",
        "unsubscribes": "nullif(o_custkey % 20, 0)",
        "bounces": "o_custkey % 50",
        "date": "cast(date '2024-01-01' + cast(7 * (o_orderkey % 5) + 35 * (o_custkey % 11) as int) as string)",
        "loaded_at": LOADED_AT,
    }),
    "posthog_raw": ("events", None, {
        "event_id": "'ph_'||cast(event_id as string)",
        "user_id": "case when event_id % 101 = 0 then null else 'user_'||cast(user_id as string) end",
        "event": (
            "case event_type when 'view' then 'page_view' when 'click' then case when event_id % 3 = 0 "
            "then 'feature_used' else 'activation' end when 'error' then 'churned' else event_type end"
        ),
        "channel": (
            "case event_id % 8 when 0 then 'facebook' when 1 then 'instagram' when 2 then 'google_search' "
            "when 3 then 'google_display' when 4 then 'email' when 5 then 'organic' when 6 then 'meta' else 'google' end"
        ),
        "country": "case user_id % 5 when 0 then 'IE' when 1 then 'GB' when 2 then 'US' when 3 then 'IN' else 'DE' end",
        "timestamp": "cast(cast(ts as date) + cast(user_id % 7 + 15 * (event_id % 3) as int) as string)",
        "loaded_at": LOADED_AT,
    }),
}


def read_testdata(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    """One testdata table with its declared schema."""
    return spark.read.schema(TABLE_SCHEMAS[table]).parquet(f"{sf_dir.rstrip('/')}/{table}.parquet")


def derive_feed(name: str, table: DataFrame) -> DataFrame:
    """Project a testdata table onto raw feed ``name`` (declared feed types)."""
    _, where, exprs = FEED_SQL[name]
    schema = FEED_SCHEMAS[name]
    if where:
        table = table.where(where)
    return table.selectExpr(*[f"cast({exprs[f.name]} as {f.dataType.simpleString()}) as {f.name}" for f in schema.fields])


def _builder(name: str):
    def build(spark: SparkSession, sf_dir: str) -> DataFrame:
        return derive_feed(name, read_testdata(spark, sf_dir, FEED_SQL[name][0]))

    build.__name__ = name
    return build


meta_ads_raw = _builder("meta_ads_raw")
google_ads_raw = _builder("google_ads_raw")
ga4_raw = _builder("ga4_raw")
gsc_raw = _builder("gsc_raw")
brevo_raw = _builder("brevo_raw")
posthog_raw = _builder("posthog_raw")



def feeds_from_testdata(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """All six raw feeds as lazy DataFrames; each testdata table is read once."""
    tables: dict[str, DataFrame] = {}
    feeds = {}
    for name, (table, _, _) in FEED_SQL.items():
        if table not in tables:
            tables[table] = read_testdata(spark, sf_dir, table)
        feeds[name] = derive_feed(name, tables[table])
    return feeds
