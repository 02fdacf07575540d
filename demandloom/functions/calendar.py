"""Date parts as the feature table defines them."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def monday_weekday(day: Column) -> Column:
    """0 = Monday … 6 = Sunday."""
    return F.weekday(day)


def calendar_columns(day: Column) -> dict[str, Column]:
    return {
        "day_of_week": monday_weekday(day),
        "day_of_month": F.dayofmonth(day),
        "month": F.month(day),
        "week_of_year": F.weekofyear(day),
        "is_weekend": (monday_weekday(day) >= 5).cast("int"),
    }


def day_span(first: Column, last: Column) -> Column:
    """Number of calendar days from first to last, both counted."""
    return F.datediff(last, first) + 1


def iso_text(day: Column) -> Column:
    return F.date_format(day, "yyyy-MM-dd")
