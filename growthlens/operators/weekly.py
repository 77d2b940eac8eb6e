"""Monday-to-Sunday KPI summaries and week-over-week changes.

The original brief queried three marts for one week at a time (six serial
queries per run).  Here every week is computed at once, in long form: each mart
row becomes a row per KPI input (week, metric, value), one narrow aggregation by
week and metric serves all KPIs, and only the finished values, a row per week
and KPI, are gathered into wide rows.  The single-week form (``as_of``,
``week_offset``) is the same over date-filtered marts.

Rules kept on purpose: weekly averages are unweighted means of daily ratios
(NULLs skipped); SQL-style rounding (half away from zero) of each KPI; a KPI
with no rows is 0; changes are computed from the already rounded values and
rounded half-even; the previous week is the calendar week before (so a missing
week counts as zeros, it never reaches further back).
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from growthlens.functions import exact_totals, pct_change, ratio, week_start

col = F.col

# Fixed values (this and the two tables below): KPI families and the direction in which a change is good.
ACQUISITION_FAMILY = "acquisition/paid"
ACTIVATION_FAMILY = "retention/activation"
ORGANIC_FAMILY = "organic/referral"
LOWER_IS_BETTER = "lower"
HIGHER_IS_BETTER = "higher"
NEUTRAL = "neutral"

# KPI -> (family, mart column, aggregate kind, scale, decimals, output type).  "avg" = SQL-rounded mean of daily values, "sum" =
# integer total, "money" = exact total rounded to cents.
KPI_SPECS: dict[str, tuple[str, str, str, float, int, str]] = {
    "avg_cac": (ACQUISITION_FAMILY, "cac", "avg", 1.0, 2, "double"),
    "avg_roas": (ACQUISITION_FAMILY, "roas", "avg", 1.0, 2, "double"),
    "total_spend": (ACQUISITION_FAMILY, "total_spend", "money", 1.0, 2, "double"),
    "total_conversions": (ACQUISITION_FAMILY, "total_conversions", "sum", 1.0, 0, "bigint"),
    "avg_ctr_pct": (ACQUISITION_FAMILY, "ctr", "avg", 100.0, 2, "double"),
    "activation_rate_pct": (ACTIVATION_FAMILY, "activation_rate", "avg", 100.0, 2, "double"),
    "churn_rate_pct": (ACTIVATION_FAMILY, "churn_rate", "avg", 100.0, 2, "double"),
    "total_signups": (ACTIVATION_FAMILY, "total_signups", "sum", 1.0, 0, "bigint"),
    "organic_share_pct": (ORGANIC_FAMILY, "organic_traffic_share", "avg", 100.0, 2, "double"),
    "k_factor": (ORGANIC_FAMILY, "k_factor_estimate", "avg", 1.0, 4, "double"),
    "organic_sessions": (ORGANIC_FAMILY, "organic_sessions", "sum", 1.0, 0, "bigint"),
}
KPIS = list(KPI_SPECS)

# change column -> (kpi it compares, direction in which a change is good)
CHANGE_SPECS: dict[str, tuple[str, str]] = {
    "cac_change": ("avg_cac", LOWER_IS_BETTER),
    "roas_change": ("avg_roas", HIGHER_IS_BETTER),
    "spend_change": ("total_spend", NEUTRAL),
    "conversions_change": ("total_conversions", NEUTRAL),
    "activation_change": ("activation_rate_pct", HIGHER_IS_BETTER),
    "churn_change": ("churn_rate_pct", LOWER_IS_BETTER),
    "organic_change": ("organic_sessions", HIGHER_IS_BETTER),
}

_ACQ_KPIS = ["avg_cac", "avg_roas", "total_spend", "total_conversions", "avg_ctr_pct"]
_ACT_KPIS = ["activation_rate_pct", "churn_rate_pct", "total_signups"]
_REF_KPIS = ["organic_share_pct", "k_factor", "organic_sessions"]


def _inputs(mart: DataFrame, kpis: list[str], start: dt.date | None, end: dt.date | None) -> DataFrame:
    """(week_start, metric, value, whole) of every row of ``mart`` and each of ``kpis``; counts are ``whole``."""
    if start is not None:
        mart = mart.where(col("date").between(F.lit(start), F.lit(end)))
    entries = []
    for kpi in kpis:
        _, source, kind, *_ = KPI_SPECS[kpi]
        value, whole = (F.lit(None), col(source)) if kind == "sum" else (col(source), F.lit(None))
        entries.append(
            F.struct(F.lit(kpi).alias("metric"), value.cast("double").alias("value"), whole.cast("bigint").alias("whole"))
        )
    return mart.select(week_start("date").alias("week_start"), F.inline(F.array(*entries)))


def _finished() -> Column:
    """The rounded value of a metric from its exact sum and count (NULL for counts)."""
    forms: dict[tuple[str, float, int], list[str]] = {}
    for kpi, (_, _, kind, scale, digits, _) in KPI_SPECS.items():
        if kind != "sum":
            forms.setdefault((kind, scale, digits), []).append(kpi)
    out = F.lit(None).cast("double")
    for (kind, scale, digits), kpis in forms.items():
        value = col("value") if kind == "money" else ratio("value", "value_count")
        value = F.round(value if scale == 1.0 else value * F.lit(scale), digits)
        out = F.when(col("metric").isin(*kpis), value).otherwise(out)
    return out


def _long(arms: list[tuple[DataFrame, list[str]]], start: dt.date | None = None, end: dt.date | None = None) -> DataFrame:
    """(week_start, metric, value, whole): a row per week and KPI of the marts, values finished."""
    rows = None
    for mart, kpis in arms:
        arm = _inputs(mart, kpis, start, end)
        rows = arm if rows is None else rows.unionByName(arm)
    totals = exact_totals(rows, ["week_start", "metric"], {"value": col("value")}, {"whole": col("whole")})
    return totals.select("week_start", "metric", _finished().alias("value"), "whole")


def _gathered(name: Column) -> Column:
    """Aggregate: the finished values of a week as one map by ``name``."""
    return F.map_from_entries(F.collect_list(F.struct(name, F.struct("value", "whole"))))


def _from_map(kpi: str, key: str, name: str, zero: bool = False) -> str:
    """One KPI out of the map ``kpis`` as ``name``; NULL, or 0, if it is not there."""
    part = "whole" if KPI_SPECS[kpi][2] == "sum" else "value"
    value = f"try_element_at(kpis, '{key}').{part}"
    return f"coalesce({value}, cast(0 as {KPI_SPECS[kpi][5]})) as {name}" if zero else f"{value} as {name}"


def _rollup(mart: DataFrame, kpis: list[str]) -> DataFrame:
    weeks = _long([(mart, kpis)]).groupBy("week_start").agg(_gathered(col("metric")).alias("kpis"))
    return weeks.selectExpr("week_start", *[_from_map(k, k, k) for k in kpis])


def weekly_acquisition(mart_acquisition: DataFrame) -> DataFrame:
    """Per week: avg CAC, avg ROAS, spend, conversions, avg CTR %."""
    return _rollup(mart_acquisition, _ACQ_KPIS)


def weekly_activation(mart_activation: DataFrame) -> DataFrame:
    """Per week: avg activation rate %, avg churn rate %, signups."""
    return _rollup(mart_activation, _ACT_KPIS)


def weekly_referral(mart_referral: DataFrame) -> DataFrame:
    """Per week: avg organic share %, avg k-factor (4 decimals), organic sessions."""
    return _rollup(mart_referral, _REF_KPIS)


def week_bounds(as_of: dt.date, week_offset: int = 0) -> tuple[dt.date, dt.date]:
    """Monday and Sunday of the week ``week_offset`` weeks before ``as_of``'s week."""
    start = as_of - dt.timedelta(days=as_of.weekday() + 7 * week_offset)
    return start, start + dt.timedelta(days=6)


def weekly_kpis(
    mart_acquisition: DataFrame,
    mart_activation: DataFrame,
    mart_referral: DataFrame,
    as_of: dt.date | None = None,
    week_offset: int = 0,
) -> DataFrame:
    """One row per week with the 11 KPIs (missing KPIs are 0).

    Without ``as_of``: every week that has a row in any of the three marts.
    With ``as_of``: exactly one row, the week ``week_offset`` weeks before the
    week holding ``as_of`` (all zeros when no mart has rows in it).
    """
    arms = [(mart_acquisition, _ACQ_KPIS), (mart_activation, _ACT_KPIS), (mart_referral, _REF_KPIS)]
    kpis = _gathered(col("metric")).alias("kpis")
    if as_of is None:
        agg = _long(arms).groupBy("week_start").agg(kpis)
    else:
        start, end = week_bounds(as_of, week_offset)
        agg = _long(arms, start, end).agg(kpis).select(F.lit(start).alias("week_start"), "kpis")
    return agg.selectExpr("week_start", "date_add(week_start, 6) as week_end", *[_from_map(k, k, k, zero=True) for k in KPIS])


def weekly_comparison(
    mart_acquisition: DataFrame,
    mart_activation: DataFrame,
    mart_referral: DataFrame,
    as_of: dt.date | None = None,
) -> DataFrame:
    """Each week's KPIs, the previous calendar week's KPIs and the 7 changes.

    No join: every finished value, a row per week and KPI, is emitted twice,
    for its own week and as "previous" for the following one, and one grouping
    by ``week_start`` meets both.  Weeks are those with rows of their own (or
    just the ``as_of`` week).
    """
    arms = [(mart_acquisition, _ACQ_KPIS), (mart_activation, _ACT_KPIS), (mart_referral, _REF_KPIS)]
    if as_of is None:
        values = _long(arms)
    else:
        start, end = week_bounds(as_of)
        values = _long(arms, start - dt.timedelta(days=7), end)
    both = values.select("*", F.explode(F.array(F.lit(0), F.lit(7))).alias("shift"))
    both = both.withColumn("week_start", F.date_add("week_start", col("shift")))
    name = F.concat(F.when(col("shift") == 0, "").otherwise("prev_"), col("metric"))
    kpis = _gathered(name).alias("kpis")
    if as_of is None:
        agg = both.groupBy("week_start").agg(kpis, F.min("shift").alias("nearest")).where(col("nearest") == 0)
    else:
        agg = both.where(col("week_start") == F.lit(start)).agg(kpis).select(F.lit(start).alias("week_start"), "kpis")
    kpis = [_from_map(k, k, k, zero=True) for k in KPIS]
    prev = [_from_map(k, f"prev_{k}", f"prev_{k}", zero=True) for k in KPIS]
    wide = agg.selectExpr("week_start", "date_add(week_start, 6) as week_end", *kpis, *prev)
    changes = [pct_change(col(kpi), col(f"prev_{kpi}")).alias(name) for name, (kpi, _) in CHANGE_SPECS.items()]
    return wide.select("week_start", "week_end", *KPIS, *changes)


def weekly_delta(
    mart_acquisition: DataFrame,
    mart_activation: DataFrame,
    mart_referral: DataFrame,
    as_of: dt.date | None = None,
) -> DataFrame:
    """Week-over-week change (%) of 7 KPIs; 0 where the previous value is 0."""
    return changes_of(weekly_comparison(mart_acquisition, mart_activation, mart_referral, as_of))


def kpis_of(comparison: DataFrame) -> DataFrame:
    """``weekly_kpis`` of all weeks out of a (stored) ``weekly_comparison``."""
    return comparison.select("week_start", "week_end", *KPIS)


def changes_of(comparison: DataFrame) -> DataFrame:
    """``weekly_delta`` out of a (stored) ``weekly_comparison``."""
    return comparison.select("week_start", "week_end", *CHANGE_SPECS)


def weekly_brief(
    mart_acquisition: DataFrame,
    mart_activation: DataFrame,
    mart_referral: DataFrame,
    as_of: dt.date | None = None,
) -> DataFrame:
    """The brief's numbers: one week's 11 KPIs and its 7 changes vs the week before.

    With ``as_of`` that week (zeros if it has no rows); without it, the latest
    week that has rows: a top-1 by week over the week-grain comparison, which
    Spark runs as a per-partition top-1 (no second pass over the marts, no
    driver round trip).
    """
    wide = weekly_comparison(mart_acquisition, mart_activation, mart_referral, as_of)
    if as_of is not None:
        return wide
    return wide.orderBy(F.col("week_start").desc()).limit(1)


def _direction(change: Column, polarity: str) -> Column:
    if polarity == NEUTRAL:
        return F.when(change > 0, F.lit("up")).when(change < 0, F.lit("down")).otherwise(F.lit("flat"))
    good = change < 0 if polarity == LOWER_IS_BETTER else change > 0
    bad = change > 0 if polarity == LOWER_IS_BETTER else change < 0
    return F.when(good, F.lit("good")).when(bad, F.lit("bad")).otherwise(F.lit("flat"))


def weekly_kpi_long(
    mart_acquisition: DataFrame,
    mart_activation: DataFrame,
    mart_referral: DataFrame,
    as_of: dt.date | None = None,
) -> DataFrame:
    """The brief's input as data: one row per (week, KPI) with change and direction.

    ``direction`` is good/bad/flat for KPIs with a preferred direction, up/down/flat
    for spend and conversions, NULL for KPIs without a change.
    """
    return long_of(weekly_comparison(mart_acquisition, mart_activation, mart_referral, as_of))


def long_of(comparison: DataFrame) -> DataFrame:
    """``weekly_kpi_long`` out of a (stored) ``weekly_comparison``."""
    by_kpi = {kpi: (name, polarity) for name, (kpi, polarity) in CHANGE_SPECS.items()}
    entries = []
    for kpi in KPIS:
        family = KPI_SPECS[kpi][0]
        if kpi in by_kpi:
            name, polarity = by_kpi[kpi]
            change, direction = col(name), _direction(col(name), polarity)
        else:
            change, direction = F.lit(None).cast("double"), F.lit(None).cast("string")
        entries.append(
            F.struct(
                F.lit(family).alias("family"),
                F.lit(kpi).alias("metric"),
                col(kpi).cast("double").alias("value"),
                change.alias("change_pct"),
                direction.alias("direction"),
            )
        )
    return comparison.select("week_start", F.inline(F.array(*entries)))
