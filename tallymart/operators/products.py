"""Product revenue and Pareto (ABC) classes."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallymart.functions.period import EVERYTHING, Period
from tallymart.operators.ranking import cumulative_share_classify
from tallymart.sources.marketplace import Marketplace
from tallymart.sources.scratch import materialise

PRODUCT_KEYS = ("product_id", "product_category_name")


def abc_classification(
    market: Marketplace, period: Period = EVERYTHING, sold: DataFrame | None = None
) -> DataFrame:
    """Products, revenue and revenue share per class; a class without products has no row.

    The share is the sum of product shares that were already rounded to four
    digits, rounded again to two. ``sold`` may give the period's items and orders already joined.
    """
    return (
        product_classes(market, period, sold)
        .groupBy("abc_class")
        .agg(
            F.count(F.lit(1)).alias("product_count"),
            F.sum("revenue").cast("double").alias("total_revenue"),
            F.sum(F.col("pct_of_revenue").cast("decimal(18,4)")).alias("share"),
        )
        .select(
            "abc_class",
            "product_count",
            "total_revenue",
            F.round("share", 2).cast("double").alias("pct_of_total_revenue"),
        )
        .orderBy("abc_class")
    )


def product_classes(
    market: Marketplace, period: Period = EVERYTHING, sold: DataFrame | None = None
) -> DataFrame:
    """Share, running share and class of every product, revenue as exact decimal."""
    revenue = _revenue(market, period, market.amounts("order_items").decimal, sold)
    return cumulative_share_classify(revenue, "revenue", PRODUCT_KEYS)


def product_revenue(
    market: Marketplace, period: Period = EVERYTHING, sold: DataFrame | None = None
) -> DataFrame:
    """Revenue and units per product and category.

    Products that are not listed keep their rows with no category.
    """
    return _revenue(market, period, market.amounts("order_items").double, sold)


def _order_copies(market: Marketplace, period: Period) -> DataFrame:
    return (
        period.keep(market.table("orders"), "order_purchase_timestamp")
        .filter(F.col("order_id").isNotNull())
        .groupBy("order_id")
        .agg(F.count(F.lit(1)).alias("order_rows"))
    )


def _revenue(
    market: Marketplace,
    period: Period,
    joined: Callable[[Sequence[Column]], Column],
    sold: DataFrame | None = None,
) -> DataFrame:
    """Plain items meet one stored row per order; sums per product meet the listings.

    Both sides of the order join are plain, so Spark can split a hot order.
    """
    money = market.amounts("order_items")
    prices, earned = money.names("price_units"), money.names("earned")
    if sold is None:
        orders = materialise(_order_copies(market, period))
        items = period.keep_days(market.table("order_items"))
        items = items.select("order_id", "product_id", *prices).join(orders, "order_id")
    else:
        items = sold.filter(F.col("sales") > 0).withColumnRenamed("sales", "order_rows")
    sums = items.groupBy("product_id").agg(
        *[
            F.sum(money.times(F.col(price), F.col("order_rows"))).alias(name)
            for price, name in zip(prices, earned, strict=True)
        ],
        F.sum("order_rows").alias("units"),
    )
    listings = (
        market.table("products")
        .groupBy(*PRODUCT_KEYS)
        .agg(F.count(F.lit(1)).alias("listed"))
    )
    copies = F.coalesce("listed", F.lit(1))
    return sums.join(listings, "product_id", "left").select(
        *PRODUCT_KEYS,
        joined([money.times(F.col(name), copies) for name in earned]).alias("revenue"),
        (F.col("units") * copies).alias("units_sold"),
    )
