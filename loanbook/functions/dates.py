"""Date expressions. A six-day week has every weekday but Sunday."""

from pyspark.sql import Column
from pyspark.sql import functions as F

# 1969-12-28, four days before the epoch, was a Sunday.
_EPOCH_TO_SUNDAY = 4


def _day(c: Column) -> Column:
    return F.unix_date(c.cast("date"))


def _sundays_through(c: Column) -> Column:
    """Number of Sundays after the anchor Sunday, up to and including the date."""
    return F.floor((_day(c) + F.lit(_EPOCH_TO_SUNDAY)) / F.lit(7)).cast("int")


def is_sunday(c: Column) -> Column:
    return F.dayofweek(c) == 1


def effective_days(start: Column, end: Column) -> Column:
    """Days from start to end, both included, without Sundays; 0 when reversed."""
    span = F.datediff(end, start) + 1
    sundays = _sundays_through(end) - _sundays_through(F.date_sub(start.cast("date"), 1))
    return F.when(start > end, F.lit(0)).otherwise(span - sundays).cast("int")


def add_six_day(start: Column, n: Column) -> Column:
    """The n-th day after start that is not a Sunday."""
    n = n.cast("int")
    # Monday 0 .. Saturday 5; a Sunday counts from its Saturday.
    weekday = F.least(F.weekday(start), F.lit(5))
    base = F.when(is_sunday(start), F.date_sub(start, 1)).otherwise(start.cast("date"))
    ahead = weekday + n
    skipped = F.floor(ahead / F.lit(6)).cast("int")
    return F.date_add(base, n + skipped)


def maturity(start: Column, n: Column, mode: str = "six_day") -> Column:
    """Maturity date: 'calendar' adds days, 'six_day' leaves Sundays out."""
    if mode == "calendar":
        return F.date_add(start.cast("date"), n.cast("int"))
    if mode == "six_day":
        return add_six_day(start, n)
    raise ValueError(f"unknown maturity mode {mode!r}")


def days_between(later: Column, earlier: Column) -> Column:
    return F.datediff(later, earlier)


def period_key(c: Column, months_back: int = 0) -> Column:
    """YYYYMM as an integer, optionally some months earlier."""
    shifted = F.add_months(c, -months_back) if months_back else c
    return F.date_format(shifted, "yyyyMM").cast("int")
