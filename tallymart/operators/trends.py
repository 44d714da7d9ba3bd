"""Sales per month."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallymart.functions.dates import month_start
from tallymart.functions.period import EVERYTHING, Period
from tallymart.operators.sellers import CANCELED
from tallymart.sources.marketplace import Marketplace


def orders_over_time(
    market: Marketplace, period: Period = EVERYTHING, sold: DataFrame | None = None
) -> DataFrame:
    """Item rows and revenue per month, canceled orders left out, oldest month first.

    ``total_orders`` counts item rows, not orders: an order with three items
    counts three times and an order without items not at all. Orders with no
    status are left out as well. ``sold`` may give the period's items and orders
    already joined.
    """
    money = market.amounts("order_items")
    lots_of = money.names("lot_units")
    lots = _order_lots(market, period) if sold is None else _item_lots(market, sold)
    return (
        lots.groupBy("order_month")
        .agg(
            F.sum(F.col("lot_items") * F.col("order_rows")).alias("total_orders"),
            money.double([F.sum(money.times(F.col(name), F.col("order_rows"))) for name in lots_of]).alias(
                "total_revenue"
            ),
        )
        .orderBy(F.col("order_month").asc_nulls_last())
    )


def _order_lots(market: Marketplace, period: Period) -> DataFrame:
    """Items summed per order, and how many rows of the order fall in each month."""
    money = market.amounts("order_items")
    parts = zip(money.names("price_units"), money.names("lot_units"), strict=True)
    lots = (
        period.keep_days(market.table("order_items"))
        .groupBy("order_id")
        .agg(*[F.sum(price).alias(name) for price, name in parts], F.count(F.lit(1)).alias("lot_items"))
    )
    months = (
        period.keep(market.table("orders"), "order_purchase_timestamp")
        .filter(F.col("order_status") != CANCELED)
        .groupBy("order_id", month_start(F.col("order_purchase_timestamp")).alias("order_month"))
        .agg(F.count(F.lit(1)).alias("order_rows"))
    )
    return lots.join(months, "order_id")


def _item_lots(market: Marketplace, sold: DataFrame) -> DataFrame:
    """The same of joined rows: every item is a lot of its own."""
    money = market.amounts("order_items")
    parts = zip(money.names("price_units"), money.names("lot_units"), strict=True)
    lots = [F.col(price).alias(name) for price, name in parts]
    return sold.select(*lots, F.lit(1).alias("lot_items"), F.inline("months"))
