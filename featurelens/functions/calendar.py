"""Date expressions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def to_day(c) -> Column:
    """Date of a date / timestamp / timestamp_ntz / ISO text column."""
    return F.to_date(_c(c))


def epoch_day(c) -> Column:
    """Days since 1970-01-01 (int). Range frames in days use this."""
    return F.unix_date(F.to_date(_c(c)))


def day_range(c, start, end, end_inclusive: bool = True) -> Column:
    """Days [start, end] (or [start, end)) on a date or timestamp column,
    written on the raw column so that the scan receives the filter."""
    col = _c(c)
    lo = F.lit(start).cast("date")
    hi = F.date_add(F.lit(end).cast("date"), 1) if end_inclusive else F.lit(end).cast("date")
    return (col >= lo) & (col < hi)
