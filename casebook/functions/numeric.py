"""Exact arithmetic helpers.

Money is carried as DECIMAL so sums do not depend on the order in which
partitions are combined; ratios are taken once, on exact inputs, as DOUBLE.
Division never raises: a zero or NULL divisor gives NULL (the MySQL reading,
where Spark's ANSI mode would fail the job).
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

MONEY = "decimal(12,2)"
TOTAL = "decimal(38,2)"


def col_(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def cents() -> Column:
    """The DECIMAL literal 0.01 (multiplying by it keeps arithmetic exact)."""
    return F.lit(Decimal("0.01"))


def money(c) -> Column:
    """Cast a price-like value (often DOUBLE in the source) to DECIMAL(12,2)."""
    return col_(c).cast(MONEY)


def total(c, scale: int = 2) -> Column:
    """Exact sum of a decimal or integral expression, typed DECIMAL(38,scale)."""
    return F.sum(col_(c)).cast(f"decimal(38,{scale})")


def ratio(num, den) -> Column:
    """num / den as DOUBLE; NULL when den is 0 or NULL."""
    return F.try_divide(col_(num).cast("double"), col_(den).cast("double"))


def percent(num, den) -> Column:
    """(num / den) * 100, in that order of operations."""
    return ratio(num, den) * F.lit(100.0)


def mean(c) -> Column:
    """sum / count over the non-NULL values, as DOUBLE (exact sum first)."""
    return ratio(F.sum(col_(c)), F.count(col_(c)))


def int_div(a, b) -> Column:
    """Truncating integer division of non-negative integers (SQL ``div``).

    ``a - a % b`` is a multiple of ``b``, so the quotient is exact as long as
    it stays below 2**53, far above any value this library divides.
    """
    a, b = col_(a), col_(b)
    return F.try_divide(a - (a % b), b).cast("bigint")


def round_ratio_half_up(num_decimal, den_integral, scale: int = 2) -> Column:
    """round(num / den, scale) computed in integers, so no binary rounding.

    ``num`` is a non-negative DECIMAL with at most ``scale`` fraction digits
    and ``den`` a positive integer. Returns DECIMAL(18, scale), or NULL when
    ``den`` is 0.
    """
    units = (col_(num_decimal) * (10 ** scale)).cast("bigint")
    den = col_(den_integral).cast("bigint")
    q = int_div(units * 2 + den, den * 2)
    return F.when(den != 0, (q.cast("decimal(18,0)") / (10 ** scale)).cast(f"decimal(18,{scale})"))


def mysql_avg_int(sum_col, count_col, scale: int = 4) -> Column:
    """MySQL's ``avg`` of an integer column: the exact mean rounded half-up
    to ``scale`` decimals (DECIMAL). Used where such means are averaged
    again, so the outer sum is exact and order-independent."""
    return round_ratio_half_up(sum_col, count_col, scale)
