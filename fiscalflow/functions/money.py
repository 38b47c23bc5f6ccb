"""Exact money arithmetic as Column expressions (JVM-side, codegen friendly).

Summing doubles gives results that depend on partitioning and task order, which is
not acceptable for money on a cluster.  Amounts are therefore summed as decimals with ten
places and rounded once, after the sum.  A value that such a decimal cannot hold (10^18 and
above, NaN, infinity) is never dropped: its group, or row, is computed in double
arithmetic instead, which is what the reference does for all rows.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

PLACES = 10
WIDE = f"decimal(28,{PLACES})"


def _c(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def dec(c: str | Column, scale: int = 2, precision: int = 18) -> Column:
    """Amount as an exact decimal (``try_cast``: text that is no number gives NULL)."""
    return _c(c).try_cast(f"decimal({precision},{scale})")


def wide(c: str | Column) -> Column:
    """Amount as a decimal with all places of its text; NULL if it doesn't fit."""
    return _c(c).try_cast(WIDE)


def number(c: str | Column) -> Column:
    """Amount as double; text that is no number gives NULL."""
    return _c(c).try_cast("double")


def _misfit(c: str | Column) -> Column:
    """Whether a number of the group is beyond the wide decimal."""
    return F.coalesce(F.bool_or(number(c).isNotNull() & wide(c).isNull()), F.lit(False))


def money_sum(c: str | Column, scale: int = 2) -> Column:
    """``ROUND(SUM(c), scale)``, exact if all values fit the wide decimal."""
    exact = F.round(F.sum(wide(c)), scale).cast("double")
    return F.when(_misfit(c), F.round(F.sum(number(c)), scale)).otherwise(exact)


def rounded_units(num_units: Column, den: Column, exact_type: str = "decimal(38,0)") -> Column:
    """``num_units / den`` rounded half away from zero to an integer, exactly.

    ``num_units`` is integral, ``den`` a positive integer; the result is
    ``sign(n) * ((2|n| + d) div (2d))``.  Aggregates pass decimal(38,0) (sums of any
    size); per-row amounts in cents pass ``bigint`` (long arithmetic, much faster).
    """
    n = num_units.cast(exact_type)
    d = den.cast(exact_type)
    q = int_div(F.abs(n) * 2 + d, d * 2)
    return F.when(n < 0, -q).otherwise(q)


def rounded_ratio(num_units: Column, den: Column, out_scale: int = 2, exact_type: str = "decimal(38,0)") -> Column:
    """``ROUND(num_units / den / 10**out_scale, out_scale)`` half away from zero, as double.

    ``num_units`` is an integral amount already scaled by ``10**out_scale``.
    """
    return rounded_units(num_units, den, exact_type).cast("double") / F.lit(float(10 ** out_scale))


def int_div(a: Column, b: Column) -> Column:
    """Exact integral division (SQL ``div``); floor for non-negative operands."""
    return F.call_function("div", a, b)


def money_avg(c: str | Column, out_scale: int = 2) -> Column:
    """``ROUND(AVG(c), out_scale)``, half-up from exact integer units if all values fit."""
    d = wide(c)
    n = F.count(d)
    # the sum as units of the last place: the decimal point is moved, no digit changes
    units = (F.sum(d) * F.lit(10 ** PLACES)).cast("decimal(38,0)")
    exact = F.when(n > 0, rounded_ratio(units, n * F.lit(10 ** (PLACES - out_scale)), out_scale))
    return F.when(_misfit(c), F.round(F.avg(number(c)), out_scale)).otherwise(exact)


def money_min(c: str | Column, scale: int = 2) -> Column:
    return F.round(F.min(number(c)), scale)


def money_max(c: str | Column, scale: int = 2) -> Column:
    return F.round(F.max(number(c)), scale)


# below this, an amount in cents times 10^6 fits a bigint
_SMALL = 1e10


def ratio(part: str | Column, whole: str | Column, factor: int, out_scale: int) -> Column:
    """``ROUND(part / whole * factor, out_scale)`` for a positive ``whole``.

    Amounts of whole cents below 10^10 go through long arithmetic, others that fit the wide
    decimal through decimals, the rest through doubles.
    """
    p, w = number(part), number(whole)
    pc, wc = dec(part), dec(whole)
    cents = lambda x: (x * 100).cast("bigint")
    # abs below the bound also rules out NaN; the cast back is equal if there are no further places
    plain = (F.abs(p) < _SMALL) & (F.abs(w) < _SMALL) & (pc.cast("double") == p) & (wc.cast("double") == w)
    short = rounded_ratio(cents(pc) * F.lit(factor * 10 ** out_scale), cents(wc), out_scale, exact_type="bigint")
    pw, ww = wide(part), wide(whole)
    units = lambda x: (x * F.lit(10 ** PLACES)).cast("decimal(32,0)")
    exact = rounded_ratio(units(pw) * F.lit(factor * 10 ** out_scale), units(ww), out_scale)
    return (F.when(plain, short).when(pw.isNotNull() & ww.isNotNull(), exact)
            .otherwise(F.round(p / w * F.lit(float(factor)), out_scale)))


def percent_of(part: str | Column, whole: str | Column, out_scale: int = 2) -> Column:
    """``CASE WHEN whole > 0 THEN ROUND(part / whole * 100, 2) ELSE 0 END``.

    A NULL ``whole`` takes the ELSE branch as in the reference (N11).
    """
    return F.when(number(whole) > 0, ratio(part, whole, 100, out_scale)).otherwise(F.lit(0.0))
