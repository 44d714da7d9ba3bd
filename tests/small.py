"""Hand-made marketplaces of a few rows."""

from __future__ import annotations

import datetime as dt
from decimal import Decimal

from tallymart import Marketplace

SCHEMAS = {
    "orders": """order_id string, customer_id string, order_status string,
        order_purchase_timestamp timestamp_ntz, order_delivered_customer_date timestamp_ntz,
        order_estimated_delivery_date timestamp_ntz""",
    "order_items": "order_id string, product_id string, seller_id string, price decimal(12,2)",
    "customers": "customer_id string, customer_unique_id string, customer_state string",
    "products": "product_id string, product_category_name string",
    "sellers": "seller_id string, seller_state string",
    "order_reviews": "review_id string, order_id string, review_score int",
    "order_payments": "order_id string",
    "geolocation": "zip string",
    "category_translation": "name string",
}


def ts(text: str | None) -> dt.datetime | None:
    return dt.datetime.fromisoformat(text) if text else None


def order(order_id, customer="c1", status="delivered", bought=None, arrived=None, promised=None):
    return (order_id, customer, status, ts(bought), ts(arrived), ts(promised))


def item(order_id, product="p1", seller="s1", price="1.00"):
    return (order_id, product, seller, Decimal(price) if price is not None else None)


def market(spark, **rows) -> Marketplace:
    frames = {
        name: spark.createDataFrame(rows.get(name, []), schema)
        for name, schema in SCHEMAS.items()
    }
    return Marketplace.from_frames(spark, frames)


def rows(df, *columns):
    picked = df.select(*columns) if columns else df
    return [tuple(r) for r in picked.collect()]


def by_key(df, *columns):
    return {r[0]: tuple(r[1:]) for r in rows(df, *columns)}
