"""Scalar expressions: rounding, averages, shares, calendar parts, payment text."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

# Payment code -> text of the derived column; any other code,
# null included, is UNKNOWN_PAYMENT.
PAYMENT_TEXT = {1: "Credit card", 2: "Cash", 3: "No charge", 4: "Dispute"}
UNKNOWN_PAYMENT = "Unknown"


def round2(value: Column) -> Column:
    """Round half up to cents.

    Rounding runs on DECIMAL(28,8), so a double such as 1.005 rounds by its
    decimal text and not by its binary tail.
    """
    return F.round(value.cast("decimal(28,8)"), 2).cast("double")


def ratio(part: Column, whole: Column) -> Column:
    """part / whole as double; null when the whole is zero or null."""
    return F.try_divide(part.cast("double"), whole.cast("double"))


def average2(total: Column, n: Column) -> Column:
    """Rounded mean from an exact sum and the count of its non-null terms."""
    return round2(ratio(total, n))


def percent2(part: Column, whole: Column) -> Column:
    """Rounded share of a total in percent; null when the total is zero."""
    return round2(ratio(part.cast("double") * 100.0, whole))


def minutes(seconds: Column) -> Column:
    return seconds.cast("double") / 60.0


def payment_text(code: Column) -> Column:
    known = [F.when(code == key, label) for key, label in PAYMENT_TEXT.items()]
    return F.coalesce(*known, F.lit(UNKNOWN_PAYMENT))


def date_number(day: Column) -> Column:
    """YYYYMMDD as an integer."""
    return F.year(day) * 10000 + F.month(day) * 100 + F.dayofmonth(day)


def month_name(day: Column) -> Column:
    return F.date_format(day, "MMMM")


def day_of_week(day: Column) -> Column:
    """1 is Sunday, 7 is Saturday."""
    return F.dayofweek(day)


def is_weekend(day: Column) -> Column:
    return F.dayofweek(day).isin(1, 7)


def date_column(day: Column | dt.date | str | None) -> Column:
    """A date literal, a date column, or today's date for None."""
    if day is None:
        return F.current_date()
    return day if isinstance(day, Column) else F.lit(day).cast("date")


def previous_month(as_of: Column) -> Column:
    """First day of the calendar month before as_of."""
    return F.trunc(F.add_months(as_of, -1), "month")
