"""Output files. Every run overwrites what an earlier run wrote."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame


def write_summary(classes: DataFrame, out: str) -> str:
    """Class totals as one CSV file with a header; a row per class."""
    path = f"{out}/summary.csv"
    classes.coalesce(1).write.mode("overwrite").option("header", True).csv(path)
    return path


def write_detail(scorecard: DataFrame, out: str) -> str:
    """Full seller scorecard as Parquet."""
    path = f"{out}/detail.parquet"
    scorecard.write.mode("overwrite").parquet(path)
    return path


def write_chart_data(top_states: DataFrame, out: str) -> str:
    """Rows of the delay chart as JSON lines; a display-sized table."""
    path = f"{out}/chart.json"
    top_states.coalesce(1).write.mode("overwrite").json(path)
    return path


def write_sheets(sheets: Mapping[str, DataFrame], out: str) -> dict[str, str]:
    """One Parquet table per report sheet."""
    paths = {}
    for name, df in sheets.items():
        paths[name] = f"{out}/report/{name}"
        df.write.mode("overwrite").parquet(paths[name])
    return paths
