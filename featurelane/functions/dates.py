"""Date features."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(col):
    return F.col(col) if isinstance(col, str) else col


def yyyymmdd_to_days(col: str | Column) -> Column:
    """``20170914`` -> days since 1970-01-01 (17423); bad input -> null."""
    d = F.try_to_timestamp(_c(col).cast("string"), F.lit("yyyyMMdd"))
    return F.unix_date(F.to_date(d)).cast("double")


def days_between(end: str | Column, start: str | Column) -> Column:
    """F8: tenure in days (difference of epoch days)."""
    return _c(end) - _c(start)


def years_half_even(days: str | Column) -> Column:
    """F8: whole years, rounded half to even (numpy)."""
    return F.bround(_c(days) / F.lit(365.0), 0)


def date_parts(col: str | Column, prefix: str = "") -> list[Column]:
    """year, month, day as strings (no zero padding)."""
    d = _c(col)
    return [F.year(d).cast("string").alias(f"{prefix}year"),
            F.month(d).cast("string").alias(f"{prefix}month"),
            F.dayofmonth(d).cast("string").alias(f"{prefix}day")]


def year_month_days(year: str | Column, month: str | Column) -> Column:
    """first day of (year, month) in epoch days; null if either is missing."""
    y = _c(year).try_cast("double").try_cast("int")
    m = _c(month).try_cast("double").try_cast("int")
    return F.unix_date(F.try_make_date(y, m, F.lit(1))) if hasattr(F, "try_make_date") else \
        F.unix_date(F.make_date(y, m, F.lit(1)))


def year_week_days(year: str | Column, week: str | Column | None = None, add_week: bool = True) -> Column:
    """Jan 1 of ``year`` in epoch days (+ ``7 * week`` with ``add_week``).

    When a week column is given the result is null unless both parts are
    present, even if the week is not added (the trainer's rule).
    """
    y = _c(year).try_cast("double").try_cast("int")
    base = F.unix_date(F.make_date(y, F.lit(1), F.lit(1)))
    if week is None:
        return base
    w = _c(week).try_cast("double").try_cast("int")
    return F.when(w.isNotNull(), base + w * 7 if add_week else base)


def log1p_target(col: str | Column) -> Column:
    """``log1p``; inverse is :func:`expm1_round`."""
    return F.log1p(_c(col))


def expm1_round(col: str | Column) -> Column:
    """F12 inverse: ``round(expm1(y))`` half to even."""
    return F.bround(F.expm1(_c(col)), 0)
