"""Money, guarded division and conditional aggregates.

Money is DECIMAL(18,2); a computed amount keeps six digits, DECIMAL(20,6). Sums of decimals do not
depend on the order of the rows, so a total is the same on any number of executors. Rates and shares
are doubles, divided once from exact totals.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MONEY = "decimal(18,2)"
AMOUNT = "decimal(20,6)"


def _col(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def money(value: Column | str) -> Column:
    return _col(value).cast(MONEY)


def amount(value: Column | str) -> Column:
    return _col(value).cast(AMOUNT)


def safe_divide(num: Column | str, den: Column | str) -> Column:
    """``num / den``; null, not an error, when ``den`` is zero."""
    return F.try_divide(_col(num), _col(den))


def ratio_if_positive(num: Column | str, den: Column | str) -> Column:
    """Share as a double, only where the whole is positive."""
    num, den = _col(num), _col(den)
    return F.when(den > 0, num.cast("double") / den.cast("double"))


def percent(share: Column | str, digits: int = 1) -> Column:
    """A share as a rounded percentage; a missing share is zero."""
    return F.round(F.coalesce(_col(share), F.lit(0.0)) * 100, digits)


def sum_where(value: Column | str, condition: Column) -> Column:
    """``sum(value) filter (where condition)``."""
    return F.sum(F.when(condition, _col(value)))


def sum_or_zero(value: Column | str, condition: Column | None = None) -> Column:
    """Sum that is zero, not null, when no row counts."""
    value = _col(value)
    return F.coalesce(F.sum(value) if condition is None else sum_where(value, condition), F.lit(0).cast(MONEY))


def count_where(condition: Column) -> Column:
    """``count(*) filter (where condition)``."""
    return F.count_if(condition)


def mean(value: Column | str) -> Column:
    """Average of a decimal as a double, from the exact sum and count; nulls do not count."""
    value = _col(value)
    return F.try_divide(F.sum(value).cast("double"), F.count(value).cast("double"))
