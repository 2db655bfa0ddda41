"""Exact arithmetic for ratios, averages and deviations.

Sums stay integer or decimal until the last step, so a result depends neither on the order in
which partitions arrive nor on a task that was run twice.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

WIDE = "decimal(38,0)"


def cents(money: Column) -> Column:
    """A money amount (two decimals) as a whole number of cents."""
    return (money * 100).cast(WIDE)


def whole_div(a: Column, b: Column) -> Column:
    """Integer division (``div``), NULL where ``b`` is zero."""
    return F.call_function("div", a, F.nullif(b, F.lit(0).cast("long")))


def rounded_ratio(num: Column, den: Column, scale: int) -> Column:
    """``round(num / den, scale)`` for whole numbers, half away from zero, as a double.

    NULL when the denominator is zero or either side is NULL. Works on integers only, so a value
    lying exactly on a rounding boundary is not at the mercy of binary fractions.
    """
    n = F.abs(num.cast(WIDE))
    d = F.nullif(F.abs(den.cast(WIDE)), F.lit(0).cast(WIDE))
    q = F.call_function("div", n * F.lit(2 * 10**scale) + d, d * 2)
    signed = F.when((num < 0) != (den < 0), -q).otherwise(q)
    return signed.cast("double") / F.lit(float(10**scale))


def quotient(num: Column, den: Column) -> Column:
    """``num / den`` as a double, NULL on a zero denominator."""
    return num.cast("double") / F.nullif(den.cast("double"), F.lit(0.0))


def deviation(n: Column, total: Column, squares: Column, ddof: int = 0) -> Column:
    """Standard deviation from a count, a sum and a sum of squares of whole numbers.

    ``ddof=0`` is the population value (0 for one row), ``ddof=1`` the sample value (NULL for one row).
    """
    wide = (n.cast(WIDE) * squares.cast(WIDE) - total.cast(WIDE) * total.cast(WIDE)).cast("double")
    # Small sums need no decimals: the same whole number from 64 bits.
    small = (F.abs(total) < F.lit(1 << 31)) & (squares < F.lit(1 << 42)) & (n < F.lit(1 << 20))
    narrow = n.cast("long") * squares.cast("long") - total.cast("long") * total.cast("long")
    spread = F.when(small, narrow.cast("double")).otherwise(wide)
    if ddof == 0:
        return F.when(n > 0, F.sqrt(spread) / n.cast("double"))
    weight = (n * (n - ddof)).cast("double")
    return F.when(n > ddof, F.sqrt(spread / weight))


def half_up(value: Column, scale: int) -> Column:
    """Round a non-negative double half up."""
    factor = F.lit(float(10**scale))
    return F.floor(value * factor + 0.5).cast("double") / factor
