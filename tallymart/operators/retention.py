"""Return rates of customers after their first purchase.

A person (``customer_unique_id``) may hold several accounts (``customer_id``).
The date window picks the first purchase, so people who bought before the
window look new; later orders count whether or not they lie in the window.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallymart.functions.dates import day, days_between
from tallymart.functions.numeric import flag, round_away
from tallymart.functions.period import EVERYTHING, Period
from tallymart.sources.marketplace import Marketplace
from tallymart.sources.scratch import materialise

WINDOWS = (30, 60, 90)


def cohort_retention(
    market: Marketplace, period: Period = EVERYTHING, windows: Sequence[int] = WINDOWS
) -> DataFrame:
    """Share of people with another order within n days of their first, as percentages."""
    flags = retention_flags(market, period, windows)
    return flags.agg(
        F.count(F.lit(1)).alias("total_customers"),
        *[
            round_away(F.avg(f"retained_{n}") * 100, 2).alias(f"retention_{n}_pct")
            for n in windows
        ],
    )


def retention_flags(
    market: Marketplace, period: Period = EVERYTHING, windows: Sequence[int] = WINDOWS
) -> DataFrame:
    """0/1 per person and window: did they order again within n days, the last day included.

    An order on the day of the first purchase is no return, and the windows
    are cumulative. So two days decide everything: the first purchase day in
    the window and the next different day with an order. Days before the
    window cannot be either, which leaves one upper-bound test at the end.
    """
    first, again = F.get("days", F.lit(0)), F.get("days", F.lit(1))
    cohort = _two_first_days(market, period).filter(F.col("customer_unique_id").isNotNull())
    if period.end is not None:
        cohort = cohort.filter(first <= F.lit(period.end))
    gap = F.datediff(again, first)
    return cohort.select(
        "customer_unique_id",
        *[flag(gap <= n).alias(f"retained_{n}") for n in windows],
    )


def first_purchase(market: Marketplace, period: Period = EVERYTHING) -> DataFrame:
    """First order instant of each person inside the window."""
    per_account = (
        period.keep(market.table("orders"), "order_purchase_timestamp")
        .groupBy("customer_id")
        .agg(F.min("order_purchase_timestamp").alias("first_purchase"))
    )
    return (
        per_account.join(_accounts(market), "customer_id")
        .groupBy("customer_unique_id")
        .agg(F.min("first_purchase").alias("first_purchase"))
    )


def days_since_first(market: Marketplace, period: Period = EVERYTHING) -> DataFrame:
    """Signed days from the first purchase in the window, one row per order.

    Orders before the window have negative days. The first purchases are
    stored, so both joins are between plain shuffles that adaptive execution
    can split when one person or account holds a large part of the orders.
    """
    firsts = materialise(first_purchase(market, period))
    accounts = (
        market.table("customers")
        .select("customer_id", "customer_unique_id")
        .join(firsts, "customer_unique_id")
    )
    return (
        market.table("orders")
        .select("customer_id", "order_purchase_timestamp")
        .join(accounts, "customer_id")
        .select(
            "customer_unique_id",
            days_between(F.col("first_purchase"), F.col("order_purchase_timestamp")).alias(
                "days_since_first"
            ),
        )
    )


def _accounts(market: Marketplace) -> DataFrame:
    return market.table("customers").select("customer_id", "customer_unique_id").distinct()


def _two_first_days(market: Marketplace, period: Period) -> DataFrame:
    """Each person's first two order days from the window's start on.

    Days are collected as sets, which hold no more than the calendar does, and
    cut to two per account before the accounts of a person come together.
    """
    orders = Period(start=period.start).keep(market.table("orders"), "order_purchase_timestamp")
    if period.end is not None:
        orders = orders.filter(F.col("order_purchase_timestamp").isNotNull())
    per_account = _first_two(
        orders.groupBy("customer_id"), day(F.col("order_purchase_timestamp"))
    )
    per_person = (
        per_account.join(_accounts(market), "customer_id")
        .select("customer_unique_id", F.explode_outer("days").alias("day"))
        .groupBy("customer_unique_id")
    )
    return _first_two(per_person, F.col("day"))


def _first_two(groups, order_day) -> DataFrame:
    return groups.agg(F.slice(F.array_sort(F.collect_set(order_day)), 1, 2).alias("days"))
