"""Money arithmetic: exact where it must be, float rounding where the original rounds floats."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tallyline import schema as S


def round2(c: Column) -> Column:
    """Round a double to 2 decimals the way a vectorised float round does:
    scale by 100, round half to even on the binary value, scale back."""
    return F.rint(c * F.lit(100.0)) / F.lit(100.0)


def line_total(quantity: Column, unit_price: Column) -> Column:
    """total_amount = round(quantity * unit_price, 2) in double."""
    return round2(quantity * unit_price)


def as_price(c: Column) -> Column:
    """Double to the stored price type, decimal(10,2); out of range gives null."""
    return c.try_cast(S.PRICE_TYPE)


def as_total(c: Column) -> Column:
    return c.try_cast(S.TOTAL_TYPE)


def exact_sum(c: Column) -> Column:
    """Sum of 2-decimal money values without float order effects, as double."""
    return F.sum(c.cast(S.TOTAL_TYPE)).cast("double")


def mean_of(total: Column, count: Column) -> Column:
    return total.cast("double") / count.cast("double")


def revenue_class(total: Column) -> Column:
    """Small < 50 <= Medium < 200 <= Large < 1000 <= Enterprise; null -> Enterprise."""
    expr = None
    for bound, name in S.REVENUE_CLASSES:
        cond = total < F.lit(bound)
        expr = F.when(cond, F.lit(name)) if expr is None else expr.when(cond, F.lit(name))
    return expr.otherwise(F.lit(S.REVENUE_TOP_CLASS))
