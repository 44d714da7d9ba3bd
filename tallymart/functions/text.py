"""Display text for report tables."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: shown where a report figure is missing.
NOT_AVAILABLE = "N/A"


def percent_text(value: Column) -> Column:
    """``21.47`` as ``21.47%``."""
    return F.coalesce(F.concat(value.cast("string"), F.lit("%")), F.lit(NOT_AVAILABLE))


def count_text(value: Column) -> Column:
    """``1468`` as ``1,468``."""
    return F.coalesce(F.format_number(value, 0), F.lit(NOT_AVAILABLE))
