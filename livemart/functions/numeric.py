"""Numeric scalar functions: age in 365-day years (P9), percent (P17), money sums."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def age_years(birthday, as_of) -> Column:
    """Whole 365-day years between ``birthday`` and ``as_of`` (integer division).

    Not a calendar age: the upstream service divides elapsed milliseconds by
    a 365-day year.  ``as_of`` is a ``yyyy-MM-dd`` string or a Column.
    """
    as_of_col = F.lit(as_of) if isinstance(as_of, str) else as_of
    days = F.datediff(F.to_date(as_of_col), F.to_date(_col(birthday)))
    # toward zero, as integer division does: a birthday after as_of gives 0
    return (days / F.lit(365)).cast("int")


def percent_1dp(part, total) -> Column:
    """Share in percent, one decimal, rounded half up, all in doubles."""
    ratio = F.try_divide(_col(part).cast("double") * F.lit(1000.0).cast("double"),
                         _col(total).cast("double"))
    return F.floor(ratio + F.lit(0.5).cast("double")).cast("double") / F.lit(10.0).cast("double")


def money(c) -> Column:
    """Money as ``decimal(18,2)`` so sums are exact and order-independent."""
    return _col(c).cast("decimal(18,2)")


def money_sum(c) -> Column:
    """Exact sum of money, returned as double (null when there are no rows)."""
    return F.sum(money(c)).cast("double")
