"""Day-grain marts stored by month and rebuilt only where their feeds changed.

Each cleaned feed has a fingerprint per day: the number of its rows and sums of
their hashes, which neither the order nor the partitioning of the rows changes.
``rebuild`` compares them with those of the last rebuild, computes the marts of
the days that differ and overwrites only the months that hold these days; their
other days are copied from the stored mart, which has a row per day and
channel.  The feeds are read in whole for the fingerprints (one aggregation,
combined before its shuffle) and filtered to the changed days for the marts.

Acquisition, activation, revenue and referral have no rows that depend on another
day's.  Retention does; ``plans.incremental`` keeps it up to date.

The months are partitions and their files are sorted by day and channel, so ``days``
and the weekly reports read the months they ask for and skip the row groups of others.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from growthlens.operators import marts, staging, weekly
from growthlens.sources.io import current_path, drop_old_versions, overwrite_roundtrip, read_table, write_table
from growthlens.sources.schemas import FEED_SCHEMAS

col = F.col

# The day column of each cleaned feed, and the columns the marts read (None: all but the load stamp).
FEED_DAYS: dict[str, tuple[str, Sequence[str] | None]] = {
    "stg_meta_ads": ("date", None),
    "stg_google_ads": ("date", None),
    "stg_ga4": ("date", None),
    "stg_gsc": ("date", None),
    "stg_posthog": ("event_date", ("event_date", "channel", "user_id", "is_signup", "is_activation", "is_purchase", "is_churn")),
}
# The feeds each mart reads.
MART_FEEDS: dict[str, tuple[str, ...]] = {
    "mart_acquisition": ("stg_meta_ads", "stg_google_ads"),
    "mart_activation": ("stg_posthog",),
    "mart_revenue": ("stg_meta_ads", "stg_google_ads", "stg_posthog"),
    "mart_referral": ("stg_ga4", "stg_gsc", "stg_posthog"),
}


def day_fingerprints(feed: DataFrame, day: str, columns: Sequence[str] | None = None) -> DataFrame:
    """(day, n_rows, high, low, mix) per value of the column ``day``: count, sums and xor of row hashes.

    Equal for equal rows in any order.  Which columns are NULL counts too; the load
    stamp does not.  -0.0 counts as 0.0.  The hash's halves are added up apart, so the sums hold
    2^31 rows a day.
    """
    names = [c for c in (columns or feed.columns) if c != "loaded_at"]
    nulls = F.concat(*[F.when(col(c).isNull(), F.lit("1")).otherwise(F.lit("0")) for c in names])
    hashed = feed.select(col(day).alias("day"), F.xxhash64(*names, nulls).alias("h"))
    return hashed.groupBy("day").agg(
        F.count("*").alias("n_rows"),
        F.sum(F.shiftright("h", 32)).alias("high"),
        F.sum(col("h").bitwiseAND(F.lit(0xFFFFFFFF).cast("bigint"))).alias("low"),
        F.bit_xor("h").alias("mix"),
    )


def changed_days(now: DataFrame, before: DataFrame) -> DataFrame:
    """(feed, day) of the fingerprints that are new, gone or different."""
    both = now.unionByName(before)
    return both.groupBy(*now.columns).count().where(col("count") == 1).select("feed", "day").distinct()


def _on(day: Column, days: Sequence[dt.date | None]) -> Column:
    """Whether ``day`` is one of ``days``, NULL being a day like others; never NULL."""
    known = [d for d in days if d is not None]
    found = F.coalesce(day.isin(known), F.lit(False)) if known else F.lit(False)
    return (found | day.isNull()) if None in days else found


def _by_month(mart: DataFrame, path: str, only_these_months: bool = False) -> None:
    """Writes ``mart`` partitioned by month, sorted by day and channel within its files."""
    keys = [c for c in ("date", "channel") if c in mart.columns]
    months = mart.withColumn("month", F.trunc("date", "month")).hint("rebalance", col("month"))
    write_table(
        months.sortWithinPartitions("month", *keys), path, partition_by=["month"], replace_partitions_only=only_these_months
    )


_schemas: dict[str, StructType] = {}


def _stored(spark: SparkSession, root: str, name: str) -> DataFrame:
    """The stored mart with its month; the columns are known even if it has no rows and so no files."""
    if name not in _schemas:
        empty = staging.clean_all({raw: spark.createDataFrame([], schema) for raw, schema in FEED_SCHEMAS.items()})
        _schemas[name] = StructType(_mart(name, empty, {}).schema.fields).add("month", "date")
    return read_table(spark, f"{root}/{name}", schema=_schemas[name])


def _replace_days(stored: DataFrame, fresh: DataFrame, path: str, days: Sequence[dt.date | None]) -> None:
    """Puts ``fresh`` in place of the stored rows of ``days``, overwriting the months of these days.

    A month that loses its last row cannot be overwritten with nothing; then
    the stored mart is written as a new version without it.
    """
    touched = [None if d is None else d.replace(day=1) for d in days]
    months = stored.where(_on(col("month"), touched))
    rest = months.where(~_on(col("date"), days)).drop("month").unionByName(fresh)
    had = {r[0] for r in months.select("month").distinct().collect()}  # a row per month
    have = {r[0] for r in rest.select(F.trunc("date", "month")).distinct().collect()}
    if had - have:
        return _by_month(stored.where(~_on(col("date"), days)).drop("month").unionByName(fresh), path)
    if have:
        _by_month(rest, path, only_these_months=True)


def _mart(name: str, stg: Mapping[str, DataFrame], params: Mapping) -> DataFrame:
    if name == "mart_activation":
        return marts.activation(stg["stg_posthog"])
    if name == "mart_referral":
        return marts.referral(stg["stg_ga4"], stg["stg_gsc"], stg["stg_posthog"])
    order_value = {k: v for k, v in params.items() if k == "avg_order_value"}
    acquisition = marts.acquisition(stg["stg_meta_ads"], stg["stg_google_ads"], **order_value)
    if name == "mart_acquisition":
        return acquisition
    return marts.unit_economics(acquisition, stg["stg_posthog"], **params)


def rebuild(
    stg: Mapping[str, DataFrame], root: str, only: Sequence[str] = tuple(MART_FEEDS), **mart_params
) -> dict[str, list[dt.date | None] | None]:
    """Brings the day-grain marts under ``root`` up to the cleaned feeds ``stg``.

    Returns the days rebuilt of each mart in ``only``, None for a mart built in whole: the
    first time, or when ``mart_params`` differ from the last time's.  The
    fingerprints are taken before the marts are computed and stored after them,
    so a rebuild that failed is made up for by the next, and rows that arrive meanwhile are
    found by it too.  One rebuild of a root runs at a time.
    """
    feeds = [f for f in FEED_DAYS if any(f in MART_FEEDS[m] for m in only)]
    spark = stg[feeds[0]].sparkSession
    settings = repr((sorted(only), sorted(mart_params.items())))
    now = None
    for feed in feeds:
        day, columns = FEED_DAYS[feed]
        prints = day_fingerprints(stg[feed], day, columns).select(F.lit(feed).alias("feed"), "*", F.lit(settings).alias("settings"))
        now = prints if now is None else now.unionByName(prints)
    now = overwrite_roundtrip(now, f"{root}/fingerprints_now")
    kept = f"{root}/fingerprints"
    known = current_path(spark, kept) != kept
    if known:
        before = read_table(spark, kept, schema=now.schema)
        known = before.where(col("settings") != settings).isEmpty()
    changed: dict[str, set] = {feed: set() for feed in feeds}
    if known:
        for r in changed_days(now, before).collect():  # a row per feed and calendar day
            changed[r["feed"]].add(r["day"])

    rebuilt: dict[str, list[dt.date | None] | None] = {}
    for name in only:
        path = f"{root}/{name}"
        if not known:
            _by_month(_mart(name, stg, mart_params), path)
            rebuilt[name] = None
            continue
        days = sorted(set().union(*[changed[f] for f in MART_FEEDS[name]]), key=lambda d: (d is None, d or dt.date.min))
        rebuilt[name] = days
        if days:
            part = {f: stg[f].where(_on(col(FEED_DAYS[f][0]), days)) for f in MART_FEEDS[name]}
            fresh = overwrite_roundtrip(_mart(name, part, mart_params), f"{root}/rebuilt/{name}")
            _replace_days(_stored(spark, root, name), fresh, path, days)
            drop_old_versions(spark, f"{root}/rebuilt/{name}", keep=1)
    write_table(now.coalesce(1), kept)  # a row per feed and day
    for path in (kept, f"{root}/fingerprints_now"):
        drop_old_versions(spark, path, keep=1)
    return rebuilt


def days(spark: SparkSession, root: str, name: str, first: dt.date | None = None, last: dt.date | None = None) -> DataFrame:
    """Rows of the mart ``name`` stored by ``rebuild``, from ``first`` to ``last``: reads the months of these days only."""
    stored = _stored(spark, root, name)
    if first is not None:
        stored = stored.where((col("month") >= F.lit(first.replace(day=1))) & (col("date") >= F.lit(first)))
    if last is not None:
        stored = stored.where((col("month") <= F.lit(last.replace(day=1))) & (col("date") <= F.lit(last)))
    return stored.drop("month")


def weekly_delta_of_stored(spark: SparkSession, root: str, as_of: dt.date) -> DataFrame:
    """``weekly.weekly_delta`` for the week of ``as_of`` from the stored marts: two weeks, so two months at most."""
    first, last = weekly.week_bounds(as_of, 1)[0], weekly.week_bounds(as_of)[1]
    names = ("mart_acquisition", "mart_activation", "mart_referral")
    return weekly.weekly_delta(*[days(spark, root, n, first, last) for n in names], as_of)
