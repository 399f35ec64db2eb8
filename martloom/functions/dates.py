"""Date and time columns."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, functions as F
from pyspark.sql.types import DataType


def clock(value: datetime, kind: DataType | str = "timestamp") -> Column:
    """A point in time as a column of ``kind``.

    A value without a zone is a clock time of the session's zone (for a timestamp without time zone,
    just that clock time), whatever the zone of the driver's machine.
    """
    return (F.lit(value) if value.tzinfo else F.lit(value.isoformat(sep=" "))).cast(kind)


def as_day(ts) -> Column:
    """Calendar day of a timestamp. Spark pushes ``as_day(c) == d`` to Parquet as a time range."""
    return F.to_date(ts)


def day_from_key(date_id) -> Column:
    """Day named by an integer such as 20210131."""
    key = _col(date_id)
    return F.make_date(F.floor(key / 10000), F.pmod(F.floor(key / 100), F.lit(100)), F.pmod(key, F.lit(100)))


def date_key(day) -> Column:
    """Integer key of a day, 20210131."""
    return F.year(day) * 10000 + F.month(day) * 100 + F.dayofmonth(day)


def month_name(day) -> Column:
    """Full English month name."""
    return F.date_format(day, "MMMM")


def month_period(day) -> Column:
    """Month as text, 2021-01."""
    return F.date_format(day, "yyyy-MM")


def iso_week(day) -> Column:
    return F.weekofyear(day)


def iso_year(day) -> Column:
    """Year that the ISO week belongs to; differs from ``year`` around New Year."""
    return F.extract(F.lit("YEAROFWEEK"), _col(day)).cast("int")


def iso_week_period(day) -> Column:
    """ISO year and week as one number, 202153."""
    return (iso_year(day) * 100 + iso_week(day)).cast("bigint")


def truncate_to_second(ts) -> Column:
    """Timestamp without its fraction, still without a time zone.

    ``date_trunc`` would return a zoned timestamp and move times that fall in a clock change.
    """
    seconds = F.extract(F.lit("SECOND"), _col(ts))
    return _col(ts) - F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), seconds - F.floor(seconds))


def clock_time(ts) -> Column:
    """Time of day as HH:mm:ss text (Spark has no stored TIME type by default).

    Cut from the text form, because ``date_format`` would go through the session time zone.
    """
    return F.substring(_col(ts).cast("string"), 12, 8)


def days_between(start, end) -> Column:
    """Whole days from ``start`` to ``end``."""
    return F.datediff(end, start)


def iso_text(ts) -> Column:
    """Timestamp as ISO text, as load states keep it."""
    return F.translate(_col(ts).cast("string"), " ", "T")


def from_iso_text(text) -> Column:
    return F.to_timestamp_ntz(text)


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c
