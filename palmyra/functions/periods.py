"""Reporting-period helpers.

The source jobs key everything on today's date; here the reference date
``as_of`` is always a parameter, so a job can be re-run for any period.
Periods are (year, month) pairs; ``period_index`` turns one into a single
integer (``year * 12 + month - 1``) that orders and compares correctly.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column
from pyspark.sql import functions as F

from palmyra.functions.scalar import col_


def as_date(as_of) -> _dt.date:
    if isinstance(as_of, _dt.datetime):
        return as_of.date()
    if isinstance(as_of, _dt.date):
        return as_of
    return _dt.date.fromisoformat(str(as_of))


def period_of(as_of) -> tuple[int, int]:
    d = as_date(as_of)
    return d.year, d.month


def previous_month(as_of) -> tuple[int, int]:
    """(year, month - 1) of ``as_of``. In January this is month 0 of the
    same year, which matches no stored row, as in the source query."""
    y, m = period_of(as_of)
    return y, m - 1


def last_december(as_of) -> tuple[int, int]:
    y, _ = period_of(as_of)
    return y - 1, 12


def period_index(year: str | Column, month: str | Column) -> Column:
    return col_(year).cast("int") * 12 + col_(month).cast("int") - 1


def in_year(year_col: str | Column, as_of) -> Column:
    """``year = year(as_of)`` on a stored year column (pushes to the scan)."""
    return col_(year_col) == F.lit(period_of(as_of)[0])


def in_period(year_col: str | Column, month_col: str | Column,
              period: tuple[int, int]) -> Column:
    y, m = period
    return (col_(year_col) == F.lit(y)) & (col_(month_col) == F.lit(m))


def date_in_year(date_col: str | Column, as_of) -> Column:
    """``year(date) = year(as_of)`` written as a range on the bare column, so
    parquet min/max statistics and partition filters can prune it."""
    y = period_of(as_of)[0]
    c = col_(date_col)
    return (c >= F.lit(_dt.date(y, 1, 1))) & (c < F.lit(_dt.date(y + 1, 1, 1)))
