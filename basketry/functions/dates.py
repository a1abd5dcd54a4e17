"""Calendar expressions that Spark does not ship under one name."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, functions as F

NAME_WIDTH = 9  # calendar names are blank-padded to the longest English one


def as_of_column(as_of: date | str | None) -> Column:
    """The reporting date as a literal; today when none is given."""
    if as_of is None:
        return F.current_date()
    return F.lit(as_of.isoformat() if isinstance(as_of, date) else as_of).cast("date")


def month_start(day: Column) -> Column:
    return F.trunc(day, "MM")


def day_name(day: Column) -> Column:
    return F.rpad(F.date_format(day, "EEEE"), NAME_WIDTH, " ")


def month_name(day: Column) -> Column:
    return F.rpad(F.date_format(day, "MMMM"), NAME_WIDTH, " ")


def months_between_starts(later: Column, earlier: Column) -> Column:
    """Calendar months from one month to another, ignoring days."""
    return (F.year(later) - F.year(earlier)) * 12 + (F.month(later) - F.month(earlier))


def full_months(later: Column, earlier: Column) -> Column:
    """Whole months elapsed between two dates (a month counts once its day of month is reached)."""
    return months_between_starts(later, earlier) - (F.dayofmonth(later) < F.dayofmonth(earlier)).cast("int")


def age_month_field(later: Column, earlier: Column) -> Column:
    """Month part, 0 to 11, of the calendar age between two dates: whole years are dropped."""
    return full_months(later, earlier) % 12
