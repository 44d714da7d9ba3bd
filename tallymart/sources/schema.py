"""Canonical marketplace schema: the nine tables and the columns the analyses read.

Key columns, prices and review scores carry no fixed type and are left as the
source has them: any equi-joinable type serves as a key, any number as an amount.
"""

from __future__ import annotations

# Table names, key columns and minimum sizes the checks expect.
EXPECTED_TABLES = (
    "category_translation",
    "customers",
    "geolocation",
    "order_items",
    "order_payments",
    "order_reviews",
    "orders",
    "products",
    "sellers",
)
KEY_COLUMNS = {
    "orders": "order_id",
    "customers": "customer_id",
    "products": "product_id",
    "sellers": "seller_id",
}
MINIMUM_ROWS = {"orders": 1_000, "order_items": 1_000, "customers": 1_000}
EARLIEST_YEAR = 2015

# A table's partition column that holds the order's purchase day, under the name it has inside.
ORDER_DAY = "_order_day"

# Columns the analyses use, with the type they need. ``None`` keeps the
# source type. Tables that are only counted are not listed.
COLUMNS: dict[str, dict[str, str | None]] = {
    "orders": {
        "order_id": None,
        "customer_id": None,
        "order_status": "string",
        "order_purchase_timestamp": "timestamp_ntz",
        "order_delivered_customer_date": "timestamp_ntz",
        "order_estimated_delivery_date": "timestamp_ntz",
        ORDER_DAY: "date",
    },
    "order_items": {
        "order_id": None,
        "product_id": None,
        "seller_id": None,
        "price": None,
        ORDER_DAY: "date",
    },
    "customers": {
        "customer_id": None,
        "customer_unique_id": None,
        "customer_state": "string",
    },
    "products": {"product_id": None, "product_category_name": "string"},
    "sellers": {"seller_id": None, "seller_state": "string"},
    "order_reviews": {"review_id": None, "order_id": None, "review_score": None},
}

# Columns that are summed, and the column that holds them as units to sum.
AMOUNTS = {"order_items": {"price": "price_units"}, "order_reviews": {"review_score": "score_units"}}
