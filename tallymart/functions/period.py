"""Optional date window on the purchase timestamp."""

from __future__ import annotations

import datetime as dt
import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallymart.sources.schema import ORDER_DAY

_ISO_DAY = re.compile(r"\d{4}-\d{2}-\d{2}", re.ASCII)


def parse_day(value: str | dt.date | None, name: str) -> dt.date | None:
    """Accept ``None``, a date, or text in strict YYYY-MM-DD form."""
    if value is None:
        return None
    if isinstance(value, dt.date) and not isinstance(value, dt.datetime):
        return value
    if isinstance(value, str) and _ISO_DAY.fullmatch(value):
        try:
            return dt.date.fromisoformat(value)
        except ValueError:
            pass
    raise ValueError(f"{name} must be a date in YYYY-MM-DD format, got {value!r}")


@dataclass(frozen=True)
class Period:
    """Calendar days from ``start`` to ``end``, both included; ``None`` is no bound."""

    start: dt.date | None = None
    end: dt.date | None = None

    @classmethod
    def of(cls, start: str | dt.date | None = None, end: str | dt.date | None = None) -> Period:
        return cls(parse_day(start, "start"), parse_day(end, "end"))

    def keep(self, df: DataFrame, timestamp: str) -> DataFrame:
        """Rows whose timestamp falls on a day of the period.

        Compares the raw timestamp with midnight bounds, so the predicate is a
        plain range that Parquet row groups can be skipped on. A missing
        timestamp passes only when there is no bound at all. Of a table that is
        laid out by day, only the folders of the period are opened.
        """
        df = self.keep_days(df)
        if self.start is not None:
            df = df.filter(F.col(timestamp) >= _instant(self.start, "00:00:00"))
        if self.end is not None:
            df = df.filter(F.col(timestamp) <= _instant(self.end, "23:59:59.999999"))
        return df


    def keep_days(self, df: DataFrame) -> DataFrame:
        """Rows in the day folders of the period; all of them where the table has no such layout."""
        if ORDER_DAY in df.columns:
            if self.start is not None:
                df = df.filter(F.col(ORDER_DAY) >= F.lit(self.start))
            if self.end is not None:
                df = df.filter(F.col(ORDER_DAY) <= F.lit(self.end))
        return df


def _instant(day: dt.date, clock: str) -> Column:
    return F.lit(f"{day.isoformat()} {clock}").cast("timestamp_ntz")


EVERYTHING = Period()
