"""Amounts, ratios and counts."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def guarded_ratio(amount, divisor) -> Column:
    """``amount / divisor``, NULL where the divisor is zero."""
    return _col(amount) / F.nullif(_col(divisor), F.lit(0))


def signed(amount, negative: Column) -> Column:
    """Magnitude of ``amount``, negative where the condition holds."""
    size = F.abs(_col(amount))
    return F.when(negative, -size).otherwise(size)


def whole_number(value) -> Column:
    """Decimal to int; a fractional value is an error, not silently cut."""
    v = _col(value)
    return F.when(v == F.floor(v), v.cast("int")).when(
        v.isNotNull(), F.raise_error(F.concat(F.lit("not a whole number: "), v.cast("string"))).cast("int")
    )


def count_when(condition: Column) -> Column:
    """Rows that satisfy the condition; 0 for none, and a NULL condition does not count."""
    return F.count(F.when(condition, F.lit(1)))


def sum_when(condition: Column, value, type_: str) -> Column:
    """Sum over the rows that satisfy the condition, 0 when there are none."""
    return F.coalesce(F.sum(F.when(condition, _col(value))), F.lit(0)).cast(type_)


def exact_median(value) -> Column:
    """Interpolated median.

    The aggregation state holds one entry per distinct value of a group, merged map-side, so it is
    meant for values from a bounded range such as day counts.
    """
    return F.percentile(_col(value), 0.5)


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c
