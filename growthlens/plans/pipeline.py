"""End-to-end warehouse build: feeds -> staging -> marts -> weekly, checks, serving.

Physical choices:

* The event feed is read by four marts, but only twice: funnel counts per
  (date, channel) feed the activation mart, the revenue mart and the daily
  funnel; distinct (user, day) rows with a signed-up flag feed retention and
  the referral signup counts.  Both are stored, which cuts the lineage (an
  executor lost later recomputes from the stored files, not from the feed), and
  each of the two passes reads only the columns it needs.
* The cleaned events themselves are written only on request, for readers of
  single events: all columns of the largest table once more.  ``store_events="plain"``
  writes them as they come (no shuffle, one file per input split), and the two
  passes read that table.  ``store_events="by date"`` stores them partitioned by
  ``event_date`` for date-pruned readers; the rows are first range-partitioned
  on (event_date, user_id, event_id) so each task writes one or two days (without
  it every task would write a file for every day it holds), and a hot day or hot
  user is still split across many tasks.  The range keys are data columns, so a
  retried task gets the same rows.
* The other five staging relations are read by one mart each, so they stay
  lazy views (their filters and projections fuse into the mart's scan).
* Marts are written as full-replace tables; the revenue mart reads the stored
  acquisition mart, and the weekly comparison and dashboard datasets read the
  stored marts (all tiny, day/cohort grain); the weekly KPIs, changes and long
  form are projections of the stored comparison.  The data checks are counted while the
  marts are written.
* Once a build has succeeded, all but the newest two versions of each table are
  dropped: the one just written and the one that readers may still hold.
* Everything is written under the cluster's shared folder
  (``spark.checkpoint.dir``) unless a root is given.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession

from growthlens.operators import checks, marts, serving, staging, weekly
from growthlens.session import shared_dir
from growthlens.sources.io import drop_old_versions, publish_table, read_table, write_table


def _store(spark: SparkSession, df: DataFrame, path: str, partition_by=None) -> DataFrame:
    write_table(df, path, partition_by=partition_by)
    return read_table(spark, path, schema=df.schema).select(*df.columns)


def build_warehouse(
    spark: SparkSession,
    feeds: Mapping[str, DataFrame],
    root: str | None = None,
    store_events: str | None = None,
    fail_on_checks: bool = False,
    database: str | None = None,
    **mart_params,
) -> dict[str, str]:
    """Build and store every relation; returns ``name -> path``.

    ``feeds`` maps raw feed names (``meta_ads_raw`` ...) to DataFrames, e.g.
    from ``sources.read_feed`` or ``sources.feeds_from_testdata``.  ``mart_params``
    are passed to the revenue mart (``avg_order_value``, ``monthly_price``,
    ``lifetime_months``, ``channel_map``).  ``store_events`` is None, "plain" or
    "by date".  ``fail_on_checks`` stops the build
    before the weekly tables and dashboards if a data check finds failing rows (one result row per
    check is looked at).  With ``database`` every mart, weekly and dashboard table
    can be read as ``database.name`` once the whole build has succeeded.
    """
    root = (root or f"{shared_dir(spark)}/growthlens/warehouse").rstrip("/")
    paths: dict[str, str] = {}

    def store(name: str, df: DataFrame, layer: str, partition_by=None) -> DataFrame:
        paths[name] = f"{root}/{layer}/{name}"
        return _store(spark, df, paths[name], partition_by)

    order_value = {k: v for k, v in mart_params.items() if k == "avg_order_value"}
    stg = staging.clean_all(dict(feeds))
    events = stg["stg_posthog"]
    if store_events == "by date":
        clustered = events.repartitionByRange("event_date", "user_id", "event_id")
        events = store("stg_posthog", clustered, "staging", partition_by=["event_date"])
    elif store_events == "plain":
        events = store("stg_posthog", events, "staging")
    elif store_events is not None:
        raise ValueError(f"store_events is None, 'plain' or 'by date', not {store_events!r}")

    counts = store("funnel_counts", marts.daily_funnel_counts(events), "intermediate")
    user_days = store("user_days", marts.user_active_days(events, with_signup_flag=True), "intermediate")

    watched = checks.Watched()

    def mart(name: str, df: DataFrame) -> DataFrame:
        return store(name, watched.watch(name, df), "marts")

    acq = mart("mart_acquisition", marts.acquisition(stg["stg_meta_ads"], stg["stg_google_ads"], **order_value))
    act = mart("mart_activation", marts.activation(funnel_counts=counts))
    ret = mart("mart_retention", marts.retention(user_days=user_days))
    rev = mart("mart_revenue", marts.unit_economics(acq, funnel_counts=counts, **mart_params))
    ref = mart("mart_referral", marts.referral(stg["stg_ga4"], stg["stg_gsc"], user_days=user_days))

    results = store("data_checks", watched.results(spark), "checks")
    if fail_on_checks:
        failed = [f"{r.model}.{r.column_name} {r.test}: {r.failures} rows" for r in results.where("not passed").collect()]
        if failed:
            raise ValueError("data checks failed: " + "; ".join(failed))

    comparison = store("weekly_comparison", weekly.weekly_comparison(acq, act, ref), "weekly")
    store("weekly_kpis", weekly.kpis_of(comparison), "weekly")
    store("weekly_delta", weekly.changes_of(comparison), "weekly")
    store("weekly_kpi_long", weekly.long_of(comparison), "weekly")

    dashboards = {
        "exec_overview_daily": serving.exec_overview_daily(acq),
        "channel_cac": serving.channel_cac(acq, **order_value),
        "retention_milestones": serving.retention_milestones(ret),
        "revenue_by_channel": serving.revenue_by_channel(rev),
        "referral_trend": serving.referral_trend(ref),
        "funnel_daily": serving.funnel_daily(funnel_counts=counts),
        "email_campaign_summary": serving.email_campaign_summary(stg["stg_brevo"]),
    }
    for name, df in dashboards.items():
        store(name, df, "serving")
    if database:
        for name, path in paths.items():
            if path.startswith((f"{root}/marts/", f"{root}/weekly/", f"{root}/serving/")):
                publish_table(spark, f"{database}.{name}", path)
    for path in paths.values():
        drop_old_versions(spark, path, keep=2)
    return paths
