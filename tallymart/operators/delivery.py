"""Actual against estimated delivery time by customer state."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallymart.functions.dates import days_between
from tallymart.functions.numeric import flag, ratio, round_away
from tallymart.functions.period import EVERYTHING, Period
from tallymart.operators.sellers import DELIVERED
from tallymart.sources.marketplace import Marketplace


def delivery_times(market: Marketplace, period: Period = EVERYTHING) -> DataFrame:
    """Whole days from purchase to delivery and to the estimate, per delivered order."""
    states = market.table("customers").select("customer_id", "customer_state")
    return (
        _delivered(market, period)
        .join(states, "customer_id")
        .select("order_id", "customer_state", "actual_days", "estimated_days")
    )


def delivery_by_state(market: Marketplace, period: Period = EVERYTHING) -> DataFrame:
    """Orders, mean actual, estimated and delay days and late share; the worst state first.

    Late means a later calendar day than estimated. An order without an
    estimate counts as an order that is not late and is left out of the means.
    """
    delay = F.col("actual_days") - F.col("estimated_days")
    # Sums per account first: a hot account is combined before the shuffle.
    per_account = (
        _delivered(market, period)
        .groupBy("customer_id")
        .agg(
            F.count(F.lit(1)).alias("orders"),
            F.sum("actual_days").alias("actual"),
            F.count("actual_days").alias("actual_n"),
            F.sum("estimated_days").alias("estimated"),
            F.count("estimated_days").alias("estimated_n"),
            F.sum(delay).alias("delay"),
            F.count(delay).alias("delay_n"),
            F.sum(flag(delay > 0)).alias("late"),
        )
    )
    states = (
        market.table("customers")
        .groupBy("customer_id", "customer_state")
        .agg(F.count(F.lit(1)).alias("copies"))
    )
    summed = [c for c in per_account.columns if c != "customer_id"]
    per_state = (
        per_account.join(states, "customer_id")
        .groupBy("customer_state")
        .agg(*[F.sum(F.col(c) * F.col("copies")).alias(c) for c in summed])
    )
    return per_state.select(
        "customer_state",
        F.col("orders").alias("total_orders"),
        round_away(ratio(F.col("actual"), F.col("actual_n")), 1).alias("avg_actual_days"),
        round_away(ratio(F.col("estimated"), F.col("estimated_n")), 1).alias("avg_estimated_days"),
        round_away(ratio(F.col("delay"), F.col("delay_n")), 1).alias("avg_delay_days"),
        round_away(ratio(F.col("late") * 100, F.col("orders")), 1).alias("pct_late"),
    ).orderBy(F.col("avg_delay_days").desc_nulls_last(), F.col("customer_state"))


def _delivered(market: Marketplace, period: Period) -> DataFrame:
    bought = F.col("order_purchase_timestamp")
    return (
        period.keep(market.table("orders"), "order_purchase_timestamp")
        .filter(F.col("order_status") == DELIVERED)
        .filter(F.col("order_delivered_customer_date").isNotNull())
        .select(
            "order_id",
            "customer_id",
            days_between(bought, F.col("order_delivered_customer_date")).alias("actual_days"),
            days_between(bought, F.col("order_estimated_delivery_date")).alias("estimated_days"),
        )
    )
