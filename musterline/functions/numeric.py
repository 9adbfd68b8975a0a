"""Numeric column helpers.

Totals are summed as integers or decimals, so a result does not depend on how
Spark splits the rows or in which order partial sums arrive.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _div(a: Column, b: Column) -> Column:
    return F.call_function("div", a, b)


def ratio(n: Column, d: Column, places: int, times: int = 1) -> Column:
    """``round(times * n / d, places)`` of two whole numbers, half away from zero.

    Long arithmetic throughout: exact, and null when ``d`` is zero or null. The
    quotient is split off first so the products stay small for large totals.
    """
    scale = times * 10**places
    n = n.cast("bigint")
    d = F.nullif(d.cast("bigint"), F.lit(0).cast("bigint"))
    size = F.abs(n)
    whole = _div(size, d)
    rest = size % d
    scaled = whole * F.lit(scale) + _div(rest * F.lit(2 * scale) + d, d * F.lit(2))
    signed = F.when(n < 0, -scaled).otherwise(scaled)
    return signed.cast("double") / F.lit(float(10**places))


def pct(n: Column, d: Column, places: int = 2) -> Column:
    """Share of ``n`` in ``d`` in percent."""
    return ratio(n, d, places, times=100)


def fixed(value: Column, places: int) -> Column:
    """Value as a whole number of ``10**-places`` units."""
    return F.floor(value * F.lit(float(10**places)) + F.lit(0.5))


def mean(value: Column, places: int, stored: int = 4) -> Column:
    """Average of a column that holds at most ``stored`` decimals, rounded to ``places``."""
    return ratio(F.sum(fixed(value, stored)), F.count(value) * F.lit(10**stored), places)


def rounded(value: Column, places: int) -> Column:
    """Half-up rounding of a computed double, its last-digit noise removed first."""
    return F.round(value.cast("decimal(38,10)"), places).cast("double")


def total(value: Column, places: int) -> Column:
    """Sum of a double column, for values of up to ``places`` decimals the same in whatever order rows arrive.

    Values are summed as whole units of the last decimal; what a value has beyond them is summed apart, unless it
    is only the noise of its binary form. A NaN, an infinity or a value too large for units gives the plain sum.
    """
    units, beyond, fits = _units(value, places)
    return _whole_sum(F.sum(units), F.sum(beyond), F.sum(value), F.count_if(~fits), places)


def _units(value: Column, places: int) -> tuple[Column, Column, Column]:
    """Whole units of a value, what it has beyond them, and whether it has units at all."""
    scale = F.lit(float(10**places))
    fits = F.coalesce(F.abs(value) < F.lit(9e18 / 10**places), F.lit(True)) & ~F.isnan(value)
    units = F.when(fits, F.floor(value * scale + F.lit(0.5)))
    rest = value - units / scale
    beyond = F.when(fits & (F.abs(rest) > F.abs(value) * F.lit(2.0**-48)), rest)
    return units.cast("decimal(28,0)"), beyond, fits


def _whole_sum(units: Column, beyond: Column, plain: Column, unfit: Column, places: int) -> Column:
    unit = F.lit(f"{10**-places:.{places}f}").cast(f"decimal({places + 1},{places})")
    exact = (units.cast("decimal(28,0)") * unit).cast("double")
    return F.when(unfit > 0, plain).otherwise(exact + F.coalesce(beyond, F.lit(0.0)))


def part_of_total(value: Column, places: int) -> Column:
    """What ``total`` needs of some rows, to be stored and added up later by ``total_of_parts``."""
    units, beyond, fits = _units(value, places)
    return F.struct(
        F.sum(units).cast("decimal(28,0)").alias("units"),
        F.sum(beyond).alias("beyond"),
        F.sum(value).alias("plain"),
        F.count_if(~fits).alias("unfit"),
    )


def total_of_parts(part: Column, places: int) -> Column:
    """``total`` over the rows behind several parts."""
    return _whole_sum(F.sum(part["units"]), F.sum(part["beyond"]), F.sum(part["plain"]), F.sum(part["unfit"]), places)


def average(value: Column, places: int) -> Column:
    """Average of a double column over an exact sum."""
    return F.try_divide(total(value, places), F.count(value).cast("double"))


def weighted_avg(value: Column, weight: Column, places: int) -> Column:
    """Mean of ``value`` weighted by ``weight`` (VWAP for price and quantity)."""
    return F.try_divide(total(value * weight, places), total(weight, places))


def squares(value: Column, stored: int) -> tuple[Column, Column]:
    """Sum and sum of squares of a column as whole units of ``10**-stored``."""
    unit = fixed(value, stored)
    return F.sum(unit.cast("decimal(20,0)")).cast("decimal(38,0)"), F.sum((unit.cast("decimal(19,0)") * unit.cast("decimal(19,0)"))).cast("decimal(38,0)")


def std_from_sums(n: Column, s: Column, s2: Column, stored: int) -> Column:
    """Sample standard deviation from count, sum and sum of squares of whole units.

    ``n * s2 - s * s`` is formed in whole numbers, so that values far from zero keep their spread; where it has
    more than 38 digits, doubles take over.
    """
    whole = F.try_subtract(F.try_multiply(n.cast("decimal(20,0)"), s2), F.try_multiply(s, s)).cast("double")
    n, s, s2 = n.cast("double"), s.cast("double"), s2.cast("double")
    spread = F.greatest(F.coalesce(whole, n * s2 - s * s), F.lit(0.0))
    return F.when(n > 1, F.sqrt(F.try_divide(spread, n * (n - 1))) / F.lit(float(10**stored)))


def count_where(condition: Column) -> Column:
    """Rows where ``condition`` holds; null counts as not holding, empty input gives 0."""
    return F.count_if(condition)


def safe_div(n: Column, d: Column, eps: float = 0.0) -> Column:
    """``n / d`` with null for a zero divisor, or ``n / (d + eps)`` when ``eps`` is given."""
    return n / (d + F.lit(eps)) if eps else F.try_divide(n, d)


def clamp(value: Column, low: Column | float | int | None = None, high: Column | float | int | None = None) -> Column:
    """Value kept within bounds; null stays null."""
    out = value
    if low is not None:
        out = F.greatest(out, low if isinstance(low, Column) else F.lit(low))
    if high is not None:
        out = F.least(out, high if isinstance(high, Column) else F.lit(high))
    return F.when(value.isNotNull(), out)


def ceil_div(n: Column, d: Column) -> Column:
    """Smallest whole number not below ``n / d`` for a positive ``d``; null for a zero ``d``."""
    n = n.cast("bigint")
    d = F.nullif(d.cast("bigint"), F.lit(0).cast("bigint"))
    return F.when(n > 0, _div(n + d - 1, d)).otherwise(_div(n, d))


def hires_needed(total_: Column, part: Column, target_pct: Column) -> Column:
    """Smallest whole x with ``(part + x) / (total + x) >= target``, target in percent.

    Solved in whole numbers, so a whole solution is not pushed up by rounding
    noise. Negative when the target is already exceeded, null for a 100 % target.
    """
    unit = 10**4
    t = fixed(target_pct, 4)
    short = t * total_.cast("bigint") - part.cast("bigint") * F.lit(100 * unit)
    return ceil_div(short, F.lit(100 * unit) - t)
