"""Calendar-day arithmetic."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def day(timestamp: Column) -> Column:
    return timestamp.cast("date")


def days_between(earlier: Column, later: Column) -> Column:
    """Signed whole days from the calendar day of one instant to another's."""
    return F.datediff(day(later), day(earlier)).cast("bigint")


def month_start(timestamp: Column) -> Column:
    return F.trunc(day(timestamp), "month")


def calendar(bounds: DataFrame, first: str, last: str, name: str = "date") -> DataFrame:
    """One row per day from ``first`` to ``last`` of a one-row frame, both included."""
    days = F.sequence(F.col(first), F.col(last), F.expr("interval 1 day"))
    return bounds.select(F.explode(days).alias(name))
