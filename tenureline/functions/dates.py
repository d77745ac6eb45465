"""Calendar expressions. Ranges are inclusive on both sides."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: stands for "no end" while intervals are compared. An interval that
# really ends on this day comes back as open.
OPEN_END = date(2999, 12, 31)

ONE_MONTH = "interval 1 month"


def closed_end(end: str | Column) -> Column:
    return F.coalesce(end if isinstance(end, Column) else F.col(end), F.lit(OPEN_END))


def reopened_end(end: Column) -> Column:
    return F.nullif(end, F.lit(OPEN_END))


def month_start(day: str | Column) -> Column:
    return F.trunc(day, "MM")


def days_in_month(day: str | Column) -> Column:
    return F.dayofmonth(F.last_day(day)).cast("bigint")


def inclusive_days(first: str | Column, last: str | Column) -> Column:
    return (F.datediff(last, first) + 1).cast("bigint")


def months_between(first: Column, last: Column) -> Column:
    """Month starts from ``first`` to ``last``, both month starts; ``first <= last``."""
    return F.sequence(first, last, F.expr(ONE_MONTH))
