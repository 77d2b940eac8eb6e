"""Registered queries: ``name -> (spark, sf_dir) -> DataFrame``.

``Warehouse`` is the lazy relation graph (``plans.Relations``) over the raw
feeds derived from one testdata folder; each query asks for the one relation it
returns, so only the tables it needs are scanned.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Callable
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from growthlens.functions import week_start
from growthlens.operators import distinct, marts
from growthlens.plans import daily, incremental
from growthlens.plans.relations import ALL_NAMES, AS_OF, Relations
from growthlens.session import shared_dir
from growthlens.sources.io import overwrite_roundtrip, publish_table, write_table
from growthlens.sources.testdata_feeds import FEED_SQL, derive_feed, read_testdata


class Warehouse(Relations):
    """Lazy relations over the feeds derived from one folder of testdata tables."""

    def __init__(self, spark: SparkSession, sf_dir: str, **mart_params):
        super().__init__(None, **mart_params)
        self.spark = spark
        self.sf_dir = sf_dir.rstrip("/")
        self._tables: dict[str, DataFrame] = {}

    def raw(self, name: str) -> DataFrame:
        """Raw feed ``name``; each testdata table is read once per warehouse."""
        table = FEED_SQL[name][0]
        if table not in self._tables:
            self._tables[table] = read_testdata(self.spark, self.sf_dir, table)
        return derive_feed(name, self._tables[table])

    @cached_property
    def load_overwrite_roundtrip(self) -> DataFrame:
        """The event feed loaded as a full-replace table and read back.

        The table lives under the shared folder at a path fixed per testdata
        folder, so every run replaces the previous load.
        """
        key = hashlib.sha1(self.sf_dir.encode()).hexdigest()[:12]
        path = f"{shared_dir(self.spark)}/growthlens/raw/posthog_raw-{key}"
        return overwrite_roundtrip(self.raw("posthog_raw"), path)

    @cached_property
    def mart_named_table(self) -> DataFrame:
        """The activation mart stored as a full-replace table and read back by its name."""
        key = hashlib.sha1(self.sf_dir.encode()).hexdigest()[:12]
        name, path = f"mart_activation_{key}", f"{shared_dir(self.spark)}/growthlens/marts/mart_activation-{key}"
        write_table(self.mart_activation, path)
        publish_table(self.spark, name, path)
        return self.spark.table(name)


    def _replayed(self, add: Callable[[DataFrame, str, int], None]) -> str:
        """Feeds all cleaned events to ``add`` in three batches, a seventh of them a batch late; returns the root of the logs.

        Days overlap between the batches, and users turn out to have been seen earlier.
        """
        root = f"{shared_dir(self.spark)}/growthlens/incremental/{uuid.uuid4().hex}"
        age = F.floor(F.datediff("event_date", F.lit("2024-01-01").cast("date")) / 20)
        late = F.when(F.pmod(F.xxhash64("event_id"), F.lit(7)) == 0, F.lit(1)).otherwise(F.lit(0))
        arrives = F.least(F.greatest(age, F.lit(0)) + late, F.lit(2))
        for k in range(3):
            add(self.stg_posthog.where(arrives == k), root, k)
        return root

    @cached_property
    def mart_activation_incremental(self) -> DataFrame:
        """The activation mart from funnel counts that each batch of events added to."""
        counts = incremental.funnel_counts_so_far(self.spark, self._replayed(incremental.add_funnel_counts))
        return marts.activation(funnel_counts=counts)

    @cached_property
    def mart_retention_incremental(self) -> DataFrame:
        """The retention mart from cohorts that each batch of events changed."""
        return incremental.retention_so_far(self.spark, self._replayed(incremental.add_user_days))

    @cached_property
    def weekly_active_users(self) -> DataFrame:
        """Distinct users and distinct signed-up users per week, from stored day-grain bitmaps."""
        root = f"{shared_dir(self.spark)}/growthlens/active_users/{uuid.uuid4().hex}"
        days = distinct.store_user_bitmaps(marts.user_active_days(self.stg_posthog, with_signup_flag=True), root)
        weeks = distinct.distinct_users(days, week_start("date").alias("week_start"))
        return weeks.withColumnRenamed("users", "active_users").withColumnRenamed("flagged_users", "signup_users")


    def _rebuilt(self, *names: str, changes: bool = True) -> str:
        """Stores the marts ``names`` by month; returns the root.

        With ``changes`` from feeds that lack rows of some days first, then the days that change are rebuilt.
        """
        root = f"{shared_dir(self.spark)}/growthlens/daily/{uuid.uuid4().hex}"
        feeds = {f: getattr(self, f) for f in daily.FEED_DAYS if any(f in daily.MART_FEEDS[m] for m in names)}
        if changes:
            early = {}
            for feed, df in feeds.items():
                day = F.dayofmonth(daily.FEED_DAYS[feed][0])
                kept = ~day.isin(3, 17) & ((day != 9) | (F.pmod(F.xxhash64(*df.columns), F.lit(5)) > 0))
                early[feed] = df.where(F.coalesce(kept, F.lit(False)))
            daily.rebuild(early, root, names, **self.mart_params)
        daily.rebuild(feeds, root, names, **self.mart_params)
        return root

    @cached_property
    def mart_revenue_rebuilt_days(self) -> DataFrame:
        """The revenue mart stored by month, after the days whose feeds changed were rebuilt."""
        return daily.days(self.spark, self._rebuilt("mart_revenue"), "mart_revenue")

    @cached_property
    def mart_referral_rebuilt_days(self) -> DataFrame:
        """The referral mart stored by month, after the days whose feeds changed were rebuilt."""
        return daily.days(self.spark, self._rebuilt("mart_referral"), "mart_referral")

    @cached_property
    def weekly_delta_stored(self) -> DataFrame:
        """The week of AS_OF against the week before, from the months of the stored marts that hold them."""
        root = self._rebuilt("mart_acquisition", "mart_activation", "mart_referral", changes=False)
        return daily.weekly_delta_of_stored(self.spark, root, AS_OF)


# Registered beside the relations: what is stored and read back.
STORED_NAMES = (
    "load_overwrite_roundtrip",
    "mart_named_table",
    "mart_activation_incremental",
    "mart_retention_incremental",
    "weekly_active_users",
    "mart_revenue_rebuilt_days",
    "mart_referral_rebuilt_days",
    "weekly_delta_stored",
)


def _relation(attr: str) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return getattr(Warehouse(spark, sf_dir), attr)

    run.__name__ = attr
    return run


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    name: _relation(name) for name in ALL_NAMES + STORED_NAMES
}
