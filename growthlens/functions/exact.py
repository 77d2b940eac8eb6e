"""Sums of doubles without rounding: of any size, and the same for any order and partitioning.

A double is an integer times a power of two.  It is cut at multiples of
2^BAND_BITS into two whole numbers, without error, and those are added up as
integers by the group's keys and the band; a group has a few bands, whatever
its rows.  Only at the end, once per group, are the bands carried into one
another and rounded to the nearest double.  Everything stays inside generated
code but for that last step, which meets one row per group.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BAND_BITS = 52
# Halves of a band's whole number: sums of 2^36 rows a group and band fit a long.
_HALF_BITS = 26
_PARTS = ("high1", "high0", "low1", "low0")


def _scaled(value: str, exponent: str) -> str:
    """``value`` times 2^exponent in two exact steps, so that no factor leaves the range of doubles."""
    half = f"floor(({exponent}) / 2)"
    return f"{value} * pow(2D, {half}) * pow(2D, ({exponent}) - {half})"


def _pieces(rows: DataFrame) -> DataFrame:
    """``rows`` with the band and the four parts of ``value``; zeros and nulls have neither, and what is not finite goes to ``odd``.

    A value's whole part in its band has BAND_BITS bits, or one more just below
    a cut, and what is behind it is whole in the band below.
    """
    rows = rows.selectExpr(
        "*", "if(abs(value) > 0 and abs(value) < double('infinity'), abs(value), null) as size", "if(value < 0, -1L, 1L) as sign"
    )
    # most values lie in two bands that need neither logarithm nor power
    one = 2.0**BAND_BITS
    rows = rows.selectExpr(
        "*",
        f"case when size >= 1.5D and size < {one}D then 0 when size >= {2 / one}D and size < 1D then -1"
        f" else cast(floor((log2(size) - 0.01D) / {BAND_BITS}) as int) end as band",
    )
    scaled = _scaled("size", f"-{BAND_BITS} * band")
    rows = rows.selectExpr("*", f"case band when 0 then size when -1 then size * {one}D else {scaled} end as scaled")
    rows = rows.selectExpr("*", "floor(scaled) as high")
    rows = rows.selectExpr("*", f"cast((scaled - high) * {one}D as bigint) as low")
    parts = []
    for side in ("high", "low"):
        parts.append(f"shiftright({side}, {_HALF_BITS}) * sign as {side}1")
        parts.append(f"({side} & {(1 << _HALF_BITS) - 1}L) * sign as {side}0")
    return rows.selectExpr("*", *parts, "if(isnan(value) or abs(value) = double('infinity'), value, null) as odd")


def _wide(value: str | int) -> str:
    return f"cast({value} as decimal(38,0))"


def _digits(bands: str) -> str:
    """Sign and whole numbers below 2^BAND_BITS, lowest first, of the sum that ``bands`` (band, four part sums) stand for.

    The numbers are carried upwards from the lowest place, one below the lowest
    band; for the sum and for its negative at once, of which one ends without a borrow.
    """
    base, half = _wide(1 << BAND_BITS), _wide(1 << _HALF_BITS)

    def part(side: str) -> str:
        return f"{_wide(f'e.{side}1')} * {half} + {_wide(f'e.{side}0')}"

    places = f"transform({bands}, e -> e.band)"
    here = f"acc + case e.band - k when 0 then {part('high')} when 1 then {part('low')} else {_wide(0)} end"
    totals = (
        f"transform(sequence(array_min({places}) - 1, array_max({places}) + 2),"
        f" k -> aggregate({bands}, {_wide(0)}, (acc, e) -> {_wide(here)}))"
    )
    fields = []
    for name, sign in (("plus", ""), ("minus", "-")):
        value = _wide(f"{sign}total + acc.{name}")
        digit = _wide(f"pmod({value}, {base})")
        fields.append(f"'{name}', {_wide(f'({value} - {digit}) / {base}')}")
        fields.append(f"'{name}_digits', concat(acc.{name}_digits, array(cast({digit} as bigint)))")
    none = "cast(array() as array<bigint>)"
    start = f"named_struct('plus', {_wide(0)}, 'plus_digits', {none}, 'minus', {_wide(0)}, 'minus_digits', {none})"
    done = (
        "named_struct('sign', if(acc.plus >= 0, 1D, -1D), 'digits', if(acc.plus >= 0, acc.plus_digits, acc.minus_digits),"
        f" 'lowest', array_min({places}))"
    )
    return f"aggregate({totals}, {start}, (acc, total) -> named_struct({', '.join(fields)}), acc -> {done})"


def _rounded(number: str, top: str) -> str:
    """The double next to ``number`` (sign, digits, lowest): half to even, on all of its bits.

    ``top`` is the place of the highest digit that is not zero.  The two upper
    digits count, four more bits, and one that says whether anything lies below.
    """

    def at(back: int) -> str:
        return f"if({top} >= {back}, get({number}.digits, {top} - {back}), 0L)"

    below = f"({at(2)} & {(1 << 48) - 1}L) <> 0 or exists(slice({number}.digits, 1, greatest({top} - 2, 0)), d -> d > 0)"
    pair = _wide(f"{_wide(at(0))} * {_wide(1 << BAND_BITS)} + {_wide(at(1))}")
    bits = _wide(f"{_wide(f'{pair} * {_wide(32)}')} + {_wide(f'shiftright({at(2)}, 48) * 2')} + if({below}, {_wide(1)}, {_wide(0)})")
    value = _scaled(f"cast({bits} as double)", f"{BAND_BITS} * ({top} + {number}.lowest - 2) - 5")
    return f"if({top} is null, 0D, {number}.sign * {value})"


def exact_totals(
    rows: DataFrame,
    keys: Sequence[str],
    doubles: Mapping[str, Column],
    wholes: Mapping[str, Column] | None = None,
) -> DataFrame:
    """``keys`` and, per group, the exact sum and count of each of ``doubles`` and the sums of ``wholes`` (integers).

    A sum of doubles is what all values add up to, rounded once to the nearest
    double; NaN and infinities propagate, and without values it is NULL.  The
    count, ``name_count``, is that of the values that are not NULL.  Without
    ``keys`` there is one row.

    Two aggregations: by keys and band, combined before the shuffle, and by keys
    over the bands.  Several doubles become rows of their own before the first.
    """
    names = list(doubles)
    ints = {f"int_{n}": c.cast("long") for n, c in (wholes or {}).items()}
    if len(names) == 1:
        value = doubles[names[0]].cast("double").alias("value")
        tall = rows.select(*keys, F.lit(0).alias("slot"), value, *[c.alias(n) for n, c in ints.items()])
    else:
        entries = []
        for i, name in enumerate(names):
            held = [(c if i == 0 else F.lit(None).cast("long")).alias(n) for n, c in ints.items()]
            entries.append(F.struct(F.lit(i).alias("slot"), doubles[name].cast("double").alias("value"), *held))
        tall = rows.select(*keys, F.inline(F.array(*entries)))
    sums = [F.expr(f"sum({c}) as {c}") for c in (*_PARTS, "odd", *ints)]
    by_band = _pieces(tall).groupBy(*keys, "slot", "band").agg(F.expr("count(value) as n"), *sums)
    aggregates = [f"sum({n}) as {n}" for n in ints]
    for i, name in enumerate(names):
        mine = f"slot = {i} and band is not null"
        aggregates.append(f"collect_list(if({mine}, struct(band, {', '.join(_PARTS)}), null)) as bands_{name}")
        aggregates += [f"sum(if(slot = {i}, {c}, null)) as {c}_{name}" for c in ("n", "odd")]
    grouped = by_band.groupBy(*keys).agg(*map(F.expr, aggregates))
    # each step is a projection of its own: its result is used several times by the next one
    grouped = grouped.selectExpr("*", *[f"if(size(bands_{n}) > 0, {_digits(f'bands_{n}')}, null) as number_{n}" for n in names])
    tops = [f"array_max(transform(number_{n}.digits, (d, k) -> if(d > 0, k, null))) as top_{n}" for n in names]
    grouped = grouped.selectExpr("*", *tops)
    out = []
    for n in names:
        out.append(f"if(n_{n} > 0, coalesce(odd_{n}, {_rounded(f'number_{n}', f'top_{n}')}), null) as `{n}`")
        out.append(f"coalesce(n_{n}, 0L) as `{n}_count`")
    return grouped.selectExpr(*[f"`{k}`" for k in keys], *out, *[f"{n} as `{n.removeprefix('int_')}`" for n in ints])
