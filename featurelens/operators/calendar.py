"""Week and month periods from the data's own first and last date.

The bounds come from one scan, as one row per calendar month, before the
periods are added; they are constants of the plan, so its filters reach the
scan and nothing is read again. Dates are days of timestamps; NULL dates are
in no period.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

_DAY = "_fl_date"


@dataclass(frozen=True)
class Calendar:
    """First and last date of a frame, and of its days inside complete months
    (None without such days); ``first_month`` to ``end`` are those months."""
    first: dt.date | None
    last: dt.date | None
    first_month: dt.date | None = None
    end: dt.date | None = None
    month_days: tuple | None = None

    @property
    def has_month(self) -> bool:
        return self.first_month is not None


def _after(month: dt.date) -> dt.date:
    return dt.date(month.year + month.month // 12, month.month % 12 + 1, 1)


def calendar_of(df: DataFrame, date_col: str) -> Calendar:
    """One scan: the first and last day of every calendar month (one row per
    month reaches the driver), from which all bounds follow."""
    d = F.to_date(F.col(date_col))
    months = [r for r in df.groupBy(F.trunc(d, "MM").alias("m")).agg(F.min(d).alias("a"), F.max(d).alias("b")).collect() if r["m"] is not None]
    if not months:
        return Calendar(None, None)
    first, last = min(r["a"] for r in months), max(r["b"] for r in months)
    start = first if first.day == 1 else _after(first.replace(day=1))
    end = last.replace(day=1)  # a month is complete if the first day after it is reached
    if not start < end:
        return Calendar(first, last)
    inside = [r for r in months if start <= r["m"] < end]
    days = (min(r["a"] for r in inside), max(r["b"] for r in inside)) if inside else None
    return Calendar(first, last, start, end, days)


def _weeks(df: DataFrame, date_col: str, first, last, out: str, idx_out: str, keep_incomplete: bool) -> DataFrame:
    weeks = (last - first).days // 7 if first is not None else 0
    if not weeks:
        res = df.withColumn(out, F.lit(None).cast("string")).withColumn(idx_out, F.lit(None).cast("int"))
        return res if keep_incomplete else res.where("false")
    d = F.to_date(F.col(date_col))
    inside = _within(date_col, first, first + dt.timedelta(days=7 * weeks))
    k = F.floor(F.datediff(d, F.lit(first)) / 7).cast("int")
    start, end = F.date_add(F.lit(first), k * 7), F.date_add(F.lit(first), k * 7 + 7)
    label = F.format_string("week_%02d_%s_%s", k + 1, start.cast("string"), end.cast("string"))
    kept = df if keep_incomplete else df.where(inside)
    return kept.withColumn(out, F.when(inside, label)).withColumn(idx_out, F.when(inside, k + 1))


def _within(date_col: str, start: dt.date, end: dt.date) -> Column:
    """Days from start to before end, on the raw column: the scan gets it."""
    return (F.col(date_col) >= F.lit(start)) & (F.col(date_col) < F.lit(end))


def _months(df: DataFrame, date_col: str, cal: Calendar, out: str, idx_out: str) -> DataFrame:
    m = F.trunc(F.to_date(F.col(date_col)), "MM")
    idx = F.months_between(m, F.lit(cal.first_month)).cast("int") + 1
    label = F.format_string("months_%02d_%s_%s", idx, m.cast("string"), F.add_months(m, 1).cast("string"))
    return df.where(_within(date_col, cal.first_month, cal.end)).withColumn(out, label).withColumn(idx_out, idx)


def _typed(df: DataFrame, date_col: str) -> tuple[DataFrame, str]:
    """Text dates get a date column of their own for the tests; others are
    tested as they are."""
    if df.schema[date_col].dataType.simpleString() in ("date", "timestamp", "timestamp_ntz"):
        return df, date_col
    return df.withColumn(_DAY, F.to_date(F.col(date_col))), _DAY


def week_bins(df: DataFrame, date_col: str, out: str = "week", idx_out: str = "week_idx",
              keep_incomplete: bool = False) -> DataFrame:
    """7-day bins from the smallest date, half-open; the incomplete tail is
    dropped. Label ``week_01_<start>_<end>``; index 1, 2, ..."""
    x, day = _typed(df, date_col)
    cal = calendar_of(x, day)
    return _weeks(x, day, cal.first, cal.last, out, idx_out, keep_incomplete).drop(_DAY)


def month_bins(df: DataFrame, date_col: str, out: str = "month", idx_out: str = "month_idx") -> DataFrame:
    """Calendar months wholly inside [min, max]; other rows dropped.
    Label ``months_01_<start>_<end>``."""
    x, day = _typed(df, date_col)
    cal = calendar_of(x, day)
    if not cal.has_month:
        return df.withColumn(out, F.lit(None).cast("string")).withColumn(idx_out, F.lit(None).cast("int")).where("false")
    return _months(x, day, cal, out, idx_out).drop(_DAY)


def period_columns(df: DataFrame, date_col: str) -> DataFrame:
    """Month columns first (rows outside complete months dropped), then weeks
    from the new first date. Without any complete month: weeks on all rows
    and NULL month."""
    x, day = _typed(df, date_col)
    cal = calendar_of(x, day)
    if cal.has_month:
        m = _months(x, day, cal, "month", "month_idx")
        first, last = cal.month_days or (None, None)
    else:
        m = x.withColumn("month", F.lit(None).cast("string")).withColumn("month_idx", F.lit(None).cast("int"))
        first, last = cal.first, cal.last
    return _weeks(m, day, first, last, "week", "week_idx", False).drop(_DAY)
