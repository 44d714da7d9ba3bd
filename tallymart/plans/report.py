"""Report and chart tables, built from the results of the analyses.

Each function takes result frames, so a run computes every analysis once.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallymart.functions.text import count_text, percent_text
from tallymart.operators.retention import WINDOWS

# Wording of the report.
FINDING_SELLERS = "%s active sellers ranked by composite score"
FINDING_DELIVERY = "%s experiences the most delays vs. estimates (%s days on average)"
FINDING_CLASSES = "Class A (%s products) drives %s of revenue"
FINDING_RETENTION = "Only %s of customers return within 90 days"
CLASS_INSIGHT = (
    "Class A products (%s items) generate %s of all revenue, "
    "following a classic Pareto distribution. "
    "Class C (%s items) contributes only %s."
)


def top_delayed_states(delivery: DataFrame, n: int = 15) -> DataFrame:
    """States with the largest mean delay."""
    worst = F.col("avg_delay_days").desc_nulls_last()
    return (
        delivery.orderBy(worst, "customer_state")
        .limit(n)
        .select("customer_state", "avg_delay_days", "total_orders")
    )


def top_sellers(scorecard: DataFrame, n: int = 20) -> DataFrame:
    """Sellers with the lowest, that is best, composite score."""
    best = F.col("composite_score").asc_nulls_last()
    return (
        scorecard.orderBy(best, "seller_id")
        .limit(n)
        .select(
            "seller_id",
            "total_revenue",
            "on_time_rate",
            "avg_review",
            "cancel_rate",
            "composite_score",
        )
    )


def delivery_sheet(delivery: DataFrame) -> DataFrame:
    """All states and all delivery figures."""
    return delivery.select(
        "customer_state",
        "total_orders",
        "avg_actual_days",
        "avg_estimated_days",
        "avg_delay_days",
        "pct_late",
    )


def abc_sheet(classes: DataFrame) -> DataFrame:
    """All class totals."""
    return classes.select("abc_class", "product_count", "total_revenue", "pct_of_total_revenue")


def orders_over_time_sheet(months: DataFrame) -> DataFrame:
    """Monthly totals with the month as text."""
    return months.select(
        F.coalesce(F.date_format("order_month", "yyyy-MM-dd"), F.lit("")).alias("order_month"),
        "total_orders",
        "total_revenue",
    )


def retention_metrics(retention: DataFrame, windows: Sequence[int] = WINDOWS) -> DataFrame:
    """One labelled percentage per window."""
    rates = _at_most_one(retention, [f"retention_{n}_pct" for n in windows])
    tiles = F.array(
        *[
            F.struct(
                F.lit(f"{n}-Day Retention").alias("metric"),
                percent_text(F.col(f"retention_{n}_pct")).alias("value"),
            )
            for n in windows
        ]
    )
    return rates.select(F.inline(tiles))


def key_findings(
    scorecard: DataFrame, delivery: DataFrame, classes: DataFrame, retention: DataFrame
) -> DataFrame:
    """Four topics with one sentence each, filled from the results.

    The worst state is the first of :func:`top_delayed_states`; without any state
    with a delay its name and delay read ``none``.
    """
    sellers = F.format_string(FINDING_SELLERS, count_text(F.count(F.lit(1))))
    missing = F.col("avg_delay_days").isNull()
    worst = F.min_by(
        F.struct("customer_state", "avg_delay_days"),
        F.struct(missing, -F.col("avg_delay_days"), "customer_state"),
    )
    late = F.format_string(
        FINDING_DELIVERY,
        F.coalesce(F.col("worst.customer_state"), F.lit("none")),
        F.coalesce(F.col("worst.avg_delay_days").cast("string"), F.lit("none")),
    )
    rate = _at_most_one(retention, ["retention_90_pct"])
    lines = [
        scorecard.agg(sellers.alias("finding")).select(
            *_finding("Seller Scorecard", F.col("finding"))
        ),
        delivery.agg(worst.alias("worst")).select(*_finding("Delivery Analysis", late)),
        _class_figures(classes, "A").select(
            *_finding("ABC Classification", F.format_string(FINDING_CLASSES, "A_count", "A_share"))
        ),
        rate.select(
            *_finding(
                "Customer Retention",
                F.format_string(FINDING_RETENTION, percent_text(F.col("retention_90_pct"))),
            )
        ),
    ]
    return reduce(DataFrame.unionByName, lines)


def abc_insight(classes: DataFrame) -> DataFrame:
    """Sizes and shares of the first and last class as text."""
    return _class_figures(classes, "A", "C").select(
        F.format_string(CLASS_INSIGHT, "A_count", "A_share", "C_count", "C_share").alias("insight")
    )


def _finding(topic: str, sentence: Column) -> list[Column]:
    return [F.lit(topic).alias("topic"), sentence.alias("finding")]


def _at_most_one(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The only row of a result, or a row of missing values when it is empty."""
    return df.agg(*[F.max(c).alias(c) for c in columns])


def _class_figures(classes: DataFrame, *labels: str) -> DataFrame:
    figures = []
    for label in labels:
        chosen = F.col("abc_class") == label
        count = F.max(F.when(chosen, F.col("product_count")))
        share = F.max(F.when(chosen, F.col("pct_of_total_revenue")))
        figures += [count_text(count).alias(f"{label}_count")]
        figures += [percent_text(share).alias(f"{label}_share")]
    return classes.agg(*figures)
