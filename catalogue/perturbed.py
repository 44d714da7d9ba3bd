"""Damaged versions of the marketplace tables, so that audits have something to find.

Rows are dropped first, then repeated, then keys are set to NULL.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallymart.sources.marketplace import Marketplace


def broken(market: Marketplace) -> Marketplace:
    """All four parent tables damaged; items untouched."""
    order, customer = F.col("order_id"), F.col("customer_id")
    bought = F.col("order_purchase_timestamp").cast("date")
    closed = bought.between(F.lit(dt.date(1998, 5, 1)), F.lit(dt.date(1998, 5, 3)))
    product, seller = F.col("product_id"), F.col("seller_id")
    # NULL conditions look at the keys as they were, hence select over withColumn.
    orders = _repeat(
        market.table("orders").filter((order % 300 != 5) & ~closed), order % 700 == 0
    )
    category = F.col("product_category_name")
    return market.replace(
        orders=orders.select(
            F.when(order % 250 != 9, order).alias("order_id"),
            F.when(order % 450 != 1, customer).alias("customer_id"),
            *orders.columns[2:],
        ),
        customers=_blank_key(
            _repeat(market.table("customers").filter(customer % 60 != 1), customer % 75 == 0),
            "customer_id",
            customer % 90 == 2,
        ),
        products=_repeat(
            market.table("products").filter(product % 40 != 3), product % 100 == 6
        ).select(
            F.when(product % 80 != 5, product).alias("product_id"),
            F.when(product % 11 != 0, category).alias("product_category_name"),
        ),
        sellers=_blank_key(
            _repeat(market.table("sellers").filter(seller % 50 != 7), seller % 25 == 4),
            "seller_id",
            seller % 20 == 9,
        ),
    )


def tied(market: Marketplace) -> Marketplace:
    """Prices that depend on the product only and take five values."""
    price = (F.col("product_id") % 5 + 1) * F.lit(100)
    items = market.table("order_items").withColumn("price", price.cast("decimal(12,2)"))
    return market.replace(order_items=items)


def subcent(market: Marketplace) -> Marketplace:
    """Prices with four digits after the point, some of them far below a cent."""
    price, order = F.col("price").cast("decimal(14,4)"), F.col("order_id")
    tiny = (order % 7 + 1).cast("decimal(5,0)") * F.lit("0.0009").cast("decimal(5,4)")
    items = market.table("order_items").withColumn(
        "price", F.when(order % 3 == 0, tiny).otherwise(price + tiny).cast("decimal(18,4)")
    )
    return market.replace(order_items=items)


def doubles(market: Marketplace) -> Marketplace:
    """DOUBLE prices with thirty digits after the point; a third of them are far below a cent."""
    seventh = F.floor(F.col("price").cast("double") / 7 * F.lit(2.0**30)) / F.lit(2.0**30)
    tiny = (F.col("order_id") % 7 + 1).cast("double") / F.lit(2.0**30)
    items = market.table("order_items").withColumn(
        "price", F.when(F.col("order_id") % 3 == 0, tiny).otherwise(seventh)
    )
    return market.replace(order_items=items)


def halves(market: Marketplace) -> Marketplace:
    """Review scores with halves."""
    half = F.when(F.col("order_id") % 2 == 0, F.lit("0.5").cast("decimal(2,1)")).otherwise(F.lit(0))
    reviews = market.table("order_reviews").withColumn(
        "review_score", (F.col("review_score") + half).cast("decimal(3,1)")
    )
    return market.replace(order_reviews=reviews)


def hurried(market: Marketplace) -> Marketplace:
    """Orders whose estimate depends on the account, so that another state is the worst."""
    bought = F.col("order_purchase_timestamp")
    promise = F.make_dt_interval(days=(F.col("customer_id") % 11).cast("int"))
    orders = market.table("orders").withColumn("order_estimated_delivery_date", bought + promise)
    return market.replace(orders=orders)


def unestimated(market: Marketplace) -> Marketplace:
    """Orders that lost their delivery estimate now and then."""
    estimate = F.col("order_estimated_delivery_date")
    orders = market.table("orders").withColumn(
        "order_estimated_delivery_date", F.when(F.col("order_id") % 13 != 0, estimate)
    )
    return market.replace(orders=orders)


def keyless_customers(market: Marketplace) -> Marketplace:
    """Customers whose account key is missing throughout."""
    customers = market.table("customers")
    kind = customers.schema["customer_id"].dataType
    return market.replace(
        customers=customers.withColumn("customer_id", F.lit(None).cast(kind))
    )


def incomplete(market: Marketplace) -> Marketplace:
    """A table and a key column are not there."""
    sellers = market.table("sellers").drop("seller_id")
    return market.without("geolocation").replace(sellers=sellers)


def _repeat(df: DataFrame, condition: Column) -> DataFrame:
    copies = F.when(condition, F.lit(2)).otherwise(F.lit(1))
    return df.select("*", F.explode(F.array_repeat(F.lit(0), copies)).alias("_copy")).drop("_copy")


def _blank_key(df: DataFrame, key: str, condition: Column) -> DataFrame:
    return df.withColumn(key, F.when(~condition, F.col(key)))
