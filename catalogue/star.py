"""The star-schema test tables seen as marketplace tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallymart.sources.marketplace import Marketplace

# The columns read from the test tables and their types. Naming
# them spares a schema-inference job per table.
SCHEMAS = {
    "nation": "n_nationkey int, n_name string",
    "customer": "c_custkey bigint, c_nationkey int",
    "supplier": "s_suppkey bigint, s_nationkey int",
    "part": "p_partkey bigint, p_type string",
    "orders": """o_orderkey bigint, o_custkey bigint, o_orderstatus string,
        o_orderdate timestamp_ntz, o_orderpriority string""",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_extendedprice double",
}


def star_market(spark: SparkSession, folder: str) -> Marketplace:
    """Marketplace over ``<folder>/<table>.parquet``."""

    def read(name: str) -> DataFrame:
        return spark.read.schema(SCHEMAS[name]).parquet(f"{folder}/{name}.parquet")

    return Marketplace(
        spark,
        {
            "orders": lambda: _orders(read("orders")),
            "order_items": lambda: _order_items(read("lineitem")),
            "customers": lambda: _customers(read("customer"), read("nation")),
            "products": lambda: _products(read("part")),
            "sellers": lambda: _sellers(read("supplier"), read("nation")),
            "order_reviews": lambda: _order_reviews(read("orders")),
            "order_payments": lambda: read("orders"),
            "geolocation": lambda: read("nation"),
            "category_translation": lambda: read("part").select("p_type").distinct(),
        },
    )


def _orders(source: DataFrame) -> DataFrame:
    key = F.col("o_orderkey")
    status = (
        F.when(F.col("o_orderstatus").isin("F", "O"), F.lit("delivered"))
        .when(key % 4 == 0, F.lit("canceled"))
        .otherwise(F.lit("shipped"))
    )
    hour = (key % 24).cast("int")
    transit = ((key * 7919) % 40 + 1).cast("int")
    open_end = (key % 97 == 0) | ((status == "shipped") & (key % 5 != 0))
    return source.select(
        key.alias("order_id"),
        F.col("o_custkey").alias("customer_id"),
        status.alias("order_status"),
        (F.col("o_orderdate") + F.make_dt_interval(hours=hour)).alias("order_purchase_timestamp"),
        F.when(~open_end, F.col("o_orderdate") + F.make_dt_interval(transit, hour)).alias(
            "order_delivered_customer_date"
        ),
        (F.col("o_orderdate") + F.make_dt_interval(days=F.lit(25))).alias(
            "order_estimated_delivery_date"
        ),
    )


def _order_items(source: DataFrame) -> DataFrame:
    return source.select(
        F.col("l_orderkey").alias("order_id"),
        F.col("l_partkey").alias("product_id"),
        F.col("l_suppkey").alias("seller_id"),
        F.col("l_extendedprice").cast("decimal(12,2)").alias("price"),
    )


def _customers(source: DataFrame, nation: DataFrame) -> DataFrame:
    named = source.join(nation, source.c_nationkey == nation.n_nationkey)
    return named.select(
        F.col("c_custkey").alias("customer_id"),
        F.expr("c_custkey div 2").alias("customer_unique_id"),
        F.col("n_name").alias("customer_state"),
    )


def _products(source: DataFrame) -> DataFrame:
    return source.select(
        F.col("p_partkey").alias("product_id"), F.col("p_type").alias("product_category_name")
    )


def _sellers(source: DataFrame, nation: DataFrame) -> DataFrame:
    named = source.join(nation, source.s_nationkey == nation.n_nationkey)
    return named.select(
        F.col("s_suppkey").alias("seller_id"), F.col("n_name").alias("seller_state")
    )


def _order_reviews(source: DataFrame) -> DataFrame:
    key = F.col("o_orderkey")
    return source.filter(key % 10 != 3).select(
        F.when(key % 500 == 1, key - 1).otherwise(key).alias("review_id"),
        key.alias("order_id"),
        F.substring("o_orderpriority", 1, 1).cast("int").alias("review_score"),
    )
