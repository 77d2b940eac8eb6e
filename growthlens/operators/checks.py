"""Declarative data checks over the marts.

Three kinds, as in the original test suite: ``not_null`` (16 columns),
``accepted_values`` (acquisition channel) and ``expect_no_rows`` assertions
(negative CAC or ROAS, retention rate above 1).  A check passes when it finds
zero failing rows.

All checks of one table are ``count_if`` aggregates of a single pass over it
(a global aggregate: partial counts per task, one tiny shuffle), and the one
result row per table is unpivoted to one row per check.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

col = F.col

NOT_NULL = "not_null"
ACCEPTED_VALUES = "accepted_values"
EXPECT_NO_ROWS = "expect_no_rows"
ALL_KINDS = (NOT_NULL, ACCEPTED_VALUES, EXPECT_NO_ROWS)


@dataclass(frozen=True)
class Check:
    model: str
    column: str
    test: str  # check name as reported
    kind: str  # NOT_NULL / ACCEPTED_VALUES / EXPECT_NO_ROWS
    values: tuple[str, ...] = ()
    predicate: str | None = None  # SQL predicate selecting failing rows

    def failing(self) -> Column:
        if self.kind == NOT_NULL:
            return col(self.column).isNull()
        if self.kind == ACCEPTED_VALUES:
            # NULL is not judged by accepted_values (not_null covers it).
            return col(self.column).isNotNull() & ~col(self.column).isin(list(self.values))
        return F.coalesce(F.expr(self.predicate), F.lit(False))


# The checked columns, accepted values and assertions.
NOT_NULL_COLUMNS: dict[str, tuple[str, ...]] = {
    "mart_acquisition": ("date", "channel", "total_spend", "cac"),
    "mart_activation": ("date", "channel", "total_signups", "activation_rate"),
    "mart_retention": ("cohort_date", "cohort_size", "retention_rate"),
    "mart_revenue": ("date", "channel", "roas"),
    "mart_referral": ("date", "organic_sessions"),
}
ACCEPTED = {("mart_acquisition", "channel"): ("meta", "google")}
ASSERTIONS = (
    ("assert_cac_positive", "mart_acquisition", "cac", "cac < 0"),
    ("assert_roas_positive", "mart_acquisition", "roas", "roas < 0"),
    ("assert_retention_rate_valid", "mart_retention", "retention_rate", "retention_rate > 1"),
)


def default_checks() -> list[Check]:
    checks = [Check(m, c, NOT_NULL, NOT_NULL) for m, cols in NOT_NULL_COLUMNS.items() for c in cols]
    checks += [Check(m, c, ACCEPTED_VALUES, ACCEPTED_VALUES, values=v) for (m, c), v in ACCEPTED.items()]
    checks += [Check(m, c, name, EXPECT_NO_ROWS, predicate=p) for name, m, c, p in ASSERTIONS]
    return checks


def run_checks(
    tables: Mapping[str, DataFrame],
    kinds: Sequence[str] = ALL_KINDS,
    checks: Sequence[Check] | None = None,
) -> DataFrame:
    """One row per check: (model, column_name, test, failures, passed)."""
    selected = [c for c in (default_checks() if checks is None else checks) if c.kind in kinds]
    parts = []
    for model in dict.fromkeys(c.model for c in selected):
        mine = [c for c in selected if c.model == model]
        counts = tables[model].agg(*[F.count_if(c.failing()).alias(f"f{i}") for i, c in enumerate(mine)])
        rows = F.array(
            *[
                F.struct(
                    F.lit(c.model).alias("model"),
                    F.lit(c.column).alias("column_name"),
                    F.lit(c.test).alias("test"),
                    col(f"f{i}").cast("bigint").alias("failures"),
                )
                for i, c in enumerate(mine)
            ]
        )
        parts.append(counts.select(F.inline(rows)))
    if not parts:
        spark = SparkSession.active()
        return spark.createDataFrame([], "model string, column_name string, test string, failures bigint, passed boolean")
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.withColumn("passed", col("failures") == 0)


class Watched:
    """Checks counted while tables are written, without reading them again.

    ``watch`` returns the table with its checks' counts observed on the way;
    ``results`` has the rows of ``run_checks`` once all watched tables were written.
    """

    def __init__(self, checks: Sequence[Check] | None = None):
        self.checks = default_checks() if checks is None else list(checks)
        self.seen: dict[str, Observation] = {}

    def watch(self, model: str, table: DataFrame) -> DataFrame:
        mine = [c for c in self.checks if c.model == model]
        if not mine:
            return table
        self.seen[model] = Observation(f"checks of {model}")
        return table.observe(self.seen[model], *[F.count_if(c.failing()).alias(f"f{i}") for i, c in enumerate(mine)])

    def results(self, spark: SparkSession) -> DataFrame:
        rows = []
        for model, observed in self.seen.items():
            counts = observed.get
            mine = [c for c in self.checks if c.model == model]
            for i, c in enumerate(mine):
                failures = int(counts.get(f"f{i}") or 0)  # a table without rows may report nothing
                rows.append((c.model, c.column, c.test, failures, failures == 0))
        return spark.createDataFrame(rows, "model string, column_name string, test string, failures bigint, passed boolean")


def failing_rows(table: DataFrame, check: Check) -> DataFrame:
    """The rows of ``table`` that fail ``check`` (empty when it passes).

    A filter on the table, so it stays lazy and distributed; the assertion
    checks return exactly the rows their predicate selects.
    """
    return table.where(check.failing())
