"""Arithmetic helpers that keep results exact and ANSI-safe.

Money is summed as DECIMAL (order-independent, exact) and only turned into
DOUBLE at the end; ratios divide DOUBLEs with ``try_divide`` so a zero
denominator gives NULL instead of an ANSI error.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType

MONEY = DecimalType(18, 4)


def col_(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def money(c) -> Column:
    """Exact money value (DECIMAL(18,4))."""
    return col_(c).cast(MONEY)


def dbl(c) -> Column:
    return col_(c).cast("double")


def ratio(num, den) -> Column:
    """num / den as DOUBLE, NULL when den is 0 or NULL."""
    return F.try_divide(dbl(num), dbl(den))


def pct(num, den) -> Column:
    """100 * num / den, NULL-guarded."""
    return ratio(num, den) * F.lit(100.0)


def pct_change(cur, prev) -> Column:
    """Period-over-period % change, NULL when the previous value is 0/NULL."""
    return F.try_divide(dbl(cur) - dbl(prev), dbl(prev)) * F.lit(100.0)


def sum_money(c) -> Column:
    """Exact SUM of a money column, as DOUBLE."""
    return F.sum(money(c)).cast("double")


def avg_money(c) -> Column:
    """Exact AVG of a money column (exact sum / count), as DOUBLE."""
    return F.try_divide(F.sum(money(c)).cast("double"), F.count(col_(c)).cast("double"))


def count_true(cond) -> Column:
    """Number of rows where ``cond`` holds (NULL counts as false)."""
    return F.sum(F.when(col_(cond), 1).otherwise(0)).cast("long")


def seen(cond) -> Column:
    """Aggregate: did any row satisfy ``cond``? Never NULL."""
    return F.max(F.when(col_(cond), 1).otherwise(0)) == 1


def month_key(ts) -> Column:
    """'yyyy-MM' text key; sorts in calendar order."""
    return F.date_format(col_(ts), "yyyy-MM")


def month_start(key) -> Column:
    """First day of a 'yyyy-MM' key as DATE."""
    return F.to_date(F.concat(col_(key), F.lit("-01")))


def month_index(ts) -> Column:
    """year*12 + month, for month arithmetic."""
    return F.year(col_(ts)) * 12 + F.month(col_(ts))


def micro_units(c) -> Column:
    """A DOUBLE as an integer count of millionths, rounded half up with plain
    IEEE arithmetic (floor(x * 1e6 + 0.5)); every engine gets the same
    integer, unlike a double -> decimal cast, whose tie rounding differs."""
    return F.floor(col_(c).cast("double") * F.lit(1e6) + F.lit(0.5))


def avg_exact(c) -> Column:
    """AVG of a DOUBLE column with an order-independent sum: values are taken
    to 6 decimals as integers (``micro_units``), summed exactly, divided
    once. The result does not depend on how rows reached the aggregate."""
    x = micro_units(c)
    total = F.sum(x.cast("decimal(20,0)"))  # a BIGINT sum overflows near 1e11 rows
    return F.try_divide(total.cast("double"), F.count(x).cast("double")) / F.lit(1e6)
