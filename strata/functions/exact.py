"""Partition-independent rounding and averages.

``round(avg(x), n)`` over doubles depends on summation order (so on the number and
layout of partitions). ``exact_avg`` gives the same bits whatever the partitioning:
the sum is taken in fixed-point decimal (exact, associative), and the mean is rounded
once, half away from zero, by whole-number division; only the result becomes a double
again. Dividing decimals instead would round twice, as quotients keep few digits when
the operands are wide.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

SCALE = 12


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _whole(n: int) -> Column:
    return F.lit(Decimal(n))


def _div(a: Column, b: Column) -> Column:
    """Whole-number quotient, which must fit a long."""
    return F.call_function("div", a, b)


def round_half_up(c: str | Column, digits: int) -> Column:
    """Round half away from zero, judged on the shortest decimal form of a double
    (1.005 rounds to 1.01)."""
    return F.round(_col(c), digits)


def rounded_mean(total: str | Column, count: str | Column, digits: int, *, scale: int = SCALE) -> Column:
    """``total / count`` rounded half away from zero to ``digits``, as a double; null without
    any count. ``total`` is a decimal with ``scale`` fractional digits (0: a whole number),
    such as a sum of partial sums.

    With |total| = w + f / 10^scale and w = a * count + r, the mean is
    a + (r * 10^scale + f) / (count * 10^scale): whole numbers throughout, within 38
    digits for counts up to 10^18 and ``scale + digits`` up to 18.
    """
    unit = 10 ** scale
    t = F.abs(_col(total).cast(f"decimal(38,{scale})"))
    n = F.nullif(_col(count).cast("decimal(20,0)"), _whole(0))
    w = F.floor(t).cast(f"decimal({38 - scale},0)")
    f = ((t - w).cast(f"decimal({scale + 1},{scale})") * _whole(unit)).cast(f"decimal({scale + 1},0)")
    rest = (w % n).cast("decimal(19,0)") * _whole(unit) + f
    n_unit = n * _whole(unit)
    digits_of = _div((rest * _whole(2 * 10 ** digits)).cast("decimal(38,0)") + n_unit, n_unit * _whole(2))
    a = ((w - w % n) / n).cast("decimal(30,0)")              # divides without a rest
    ticks = (a * _whole(10 ** digits)).cast("decimal(38,0)") + digits_of
    return F.when(_col(total) < 0, -ticks).otherwise(ticks).cast("double") / F.lit(float(10 ** digits))


def exact_sum(c: str | Column, *, scale: int = SCALE, integral: bool = False) -> Column:
    """The finite values summed without error (``integral``: as longs), to be merged by
    adding and turned into a mean by ``rounded_mean``."""
    x = _col(c)
    if integral:
        return F.sum(x.cast("bigint")).cast("decimal(38,0)")
    return F.sum(F.when(~is_odd(x), x).cast(f"decimal(38,{scale})"))


def is_odd(c: str | Column) -> Column:
    """NaN and infinities, which no exact sum holds."""
    x = _col(c)
    return F.isnan(x) | F.abs(x.cast("double")).eqNullSafe(F.lit(float("inf")))


def exact_avg(c: str | Column, digits: int, *, scale: int = SCALE, integral: bool = False) -> Column:
    """Average of ``c`` rounded to ``digits``; null when every input is null.

    Inputs are summed with ``scale`` fractional digits, so choose ``scale`` to cover the
    data (and ``digits``). ``integral`` says that all values are whole numbers: they are
    summed as longs, which is faster. NaN and infinities give what a plain average of
    doubles gives.
    """
    x = _col(c)
    exact = rounded_mean(exact_sum(x, scale=scale, integral=integral), F.count(x), digits, scale=0 if integral else scale)
    if integral:
        return exact
    return F.coalesce(F.sum(F.when(is_odd(x), x.cast("double"))), exact)
