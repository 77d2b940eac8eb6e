"""Column builders: every metric rule as a native Catalyst expression.

Nothing here runs Python per row; each helper returns a ``Column`` that stays
inside whole-stage codegen.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnOrName = Column | str

# Search-position buckets (inclusive upper bounds) and their labels.
POSITION_BOUNDS = (3, 10, 20)
POSITION_LABELS = ("top_3", "page_1", "page_2", "page_3_plus")


def _c(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


def ratio(numerator: ColumnOrName, denominator: ColumnOrName) -> Column:
    """Null-safe division, always double.

    NULL when the denominator is 0 (also -0.0) or either side is NULL.  Both
    sides are cast to double first so int/int and decimal/decimal divide as
    floating point, not integer or widened decimal.
    """
    return F.try_divide(_c(numerator).cast("double"), _c(denominator).cast("double"))


def or_zero(c: ColumnOrName) -> Column:
    """NULL -> 0, keeping the column's type."""
    return F.coalesce(_c(c), F.lit(0))


def double_or_zero(c: ColumnOrName) -> Column:
    """NULL amount -> 0.0; the amount itself is kept as it is."""
    return F.coalesce(_c(c).cast("double"), F.lit(0.0))


def strict_date(c: ColumnOrName) -> Column:
    """Text to date; a text that is no date raises, whatever the session's ANSI mode."""
    text = _c(c)
    bad = F.raise_error(F.concat(F.lit("not a date: "), text.cast("string"))).cast("date")
    return F.coalesce(text.try_cast("date"), F.when(text.isNotNull(), bad))


def flag(c: ColumnOrName, value: str) -> Column:
    """``c = value`` as a strict boolean: NULL compares as false, never NULL."""
    return F.coalesce(_c(c) == F.lit(value), F.lit(False))


def position_bucket(
    position: ColumnOrName,
    bounds: Sequence[float] = POSITION_BOUNDS,
    labels: Sequence[str] = POSITION_LABELS,
) -> Column:
    """Bucket by inclusive upper bounds; NULL falls through to the last label."""
    if len(labels) != len(bounds) + 1:
        raise ValueError("need exactly one more label than bounds")
    pos = _c(position)
    expr = F.when(pos <= F.lit(bounds[0]), F.lit(labels[0]))
    for bound, label in zip(bounds[1:], labels[1:-1]):
        expr = expr.when(pos <= F.lit(bound), F.lit(label))
    return expr.otherwise(F.lit(labels[-1]))


def week_start(d: ColumnOrName) -> Column:
    """Monday of the date's week (weeks run Monday to Sunday)."""
    return F.date_trunc("week", _c(d)).cast("date")


def _round_exact_tenth(x: Column) -> Column:
    """The double next to ``x`` rounded to tenths.

    ``x * 10`` may itself round up to a tie, so its rounding error is recovered
    (both halves of ``x`` times 10 are exact) and decides where the product
    says "half"; only an error of 0 is a true tie and goes to the even tenth.
    """
    ten = F.lit(10.0)
    product = x * ten
    wide = x * F.lit(134217729.0)
    high = wide - (wide - x)
    error = (high * ten - product) + (x - high) * ten
    low = F.floor(product).cast("double")
    rest = product - low
    half = rest == F.lit(0.5)
    odd = F.pmod(low, F.lit(2.0)) == F.lit(1.0)
    up = (rest > F.lit(0.5)) | (half & (error > 0)) | (half & (error == 0) & odd)
    tenth = (low + F.when(up, F.lit(1.0)).otherwise(F.lit(0.0))) / ten
    return F.when(F.abs(x) < F.lit(2.0**48), tenth).otherwise(x)


def pct_change(new: ColumnOrName, old: ColumnOrName) -> Column:
    """Percent change rounded to 1 decimal; 0 when ``old`` is 0.

    The exact binary value is rounded, half-even only where it is a tie.
    Inputs are expected to be NULL-free already (missing KPIs count as 0).
    A small negative change keeps its sign when it rounds to zero (``-0.0``),
    as float rounding does.
    """
    new_c, old_c = _c(new).cast("double"), _c(old).cast("double")
    raw = F.try_divide(new_c - old_c, old_c) * F.lit(100.0)
    rounded = _round_exact_tenth(raw)
    signed = F.when((rounded == F.lit(0.0)) & (raw < F.lit(0.0)), F.lit(-0.0)).otherwise(rounded)
    return F.when(old_c == F.lit(0.0), F.lit(0.0)).otherwise(signed)
