"""Data-quality audit: sizes, missing keys, orphans, calendar gaps, duplicates."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallymart.functions.dates import day
from tallymart.functions.numeric import flag
from tallymart.sources.marketplace import Marketplace
from tallymart.sources.schema import EXPECTED_TABLES

# Which keys the audit looks at.
PROFILED_KEYS = {
    "orders": ("order_id", "customer_id"),
    "customers": ("customer_id",),
    "products": ("product_id",),
    "sellers": ("seller_id",),
}
PROFILE_COLUMNS = ("order_id", "customer_id", "product_id", "seller_id")
RELATIONS = (
    ("orders", "customer_id", "customers", "customer_id"),
    ("order_items", "order_id", "orders", "order_id"),
    ("order_items", "product_id", "products", "product_id"),
    ("order_items", "seller_id", "sellers", "seller_id"),
)
UNIQUE_KEYS = (
    ("orders", "order_id"),
    ("customers", "customer_id"),
    ("products", "product_id"),
    ("sellers", "seller_id"),
    ("order_reviews", "review_id"),
)


def row_counts(market: Marketplace, tables: Sequence[str] = EXPECTED_TABLES) -> DataFrame:
    """Rows per table."""
    return _stack(
        market.table(t)
        .agg(F.count(F.lit(1)).alias("row_count"))
        .select(F.lit(t).alias("table_name"), "row_count")
        for t in tables
    )


def null_profile(
    market: Marketplace, keys: Mapping[str, Sequence[str]] = PROFILED_KEYS
) -> DataFrame:
    """Rows and missing key values per table.

    Keys that a table does not have show 0; an empty table has no count for
    its own keys.
    """

    def profile(table: str, own: Sequence[str]) -> DataFrame:
        missing = {f"null_{c}": F.sum(flag(F.col(c).isNull())) for c in own}
        counted = market.table(table).agg(
            F.count(F.lit(1)).alias("total_rows"),
            *[count.alias(name) for name, count in missing.items()],
        )
        return counted.select(
            F.lit(table).alias("table_name"),
            "total_rows",
            *[
                F.col(n) if n in missing else F.lit(0).cast("bigint").alias(n)
                for n in (f"null_{c}" for c in PROFILE_COLUMNS)
            ],
        )

    return _stack(profile(t, own) for t, own in keys.items())


def orphan_keys(
    market: Marketplace, relations: Sequence[tuple[str, str, str, str]] = RELATIONS
) -> DataFrame:
    """Child rows whose parent is missing, one column per relation, one row.

    Counts rows, not distinct keys; a missing foreign key is an orphan too.
    Child keys are counted per value before the anti join, so a key shared by
    many rows meets its parent once.
    """

    def orphans(child: str, foreign: str, parent: str, primary: str) -> DataFrame:
        held = (
            market.table(child)
            .groupBy(F.col(foreign).alias("key"))
            .agg(F.count(F.lit(1)).alias("n"))
        )
        known = market.table(parent).select(F.col(primary).alias("key")).distinct()
        return held.join(known, "key", "left_anti").agg(
            F.coalesce(F.sum("n"), F.lit(0)).alias("n")
        )

    return _one_row({f"orphan_{r[1]}": orphans(*r) for r in relations})


def date_gaps(market: Marketplace) -> DataFrame:
    """First and last order day and the number of days between without an order.

    One pass over the orders: days are set bits, merged in each task before the
    shuffle, and a count of bits stands for the distinct days.
    """
    days = _day_bits(market).agg(
        F.min("first").alias("start"), F.max("last").alias("end"), F.sum(F.bitmap_count("bits")).alias("covered")
    )
    missing = F.col("end") - F.col("start") + 1 - F.col("covered")
    return days.select(
        F.date_from_unix_date("start").alias("start_date"),
        F.date_from_unix_date("end").alias("end_date"),
        F.coalesce(missing, F.lit(0)).cast("bigint").alias("missing_days"),
    )


def missing_days(market: Marketplace) -> DataFrame:
    """Calendar days without an order between the first and the last order day.

    Days come from the gaps between neighbouring days that have orders. Those
    are at most as many as the calendar has, whatever the number of orders.
    """
    seen = _days_set(_day_bits(market))
    ordered = Window.orderBy("number")
    gaps = seen.withColumn("next", F.lead("number").over(ordered)).filter(F.col("next") > F.col("number") + 1)
    inside = F.explode(F.sequence(F.col("number") + 1, F.col("next") - 1))
    return gaps.select(inside.alias("number")).select(F.date_from_unix_date("number").alias("date"))


def duplicate_keys(
    market: Marketplace, keys: Sequence[tuple[str, str]] = UNIQUE_KEYS
) -> DataFrame:
    """Key values that occur more than once, one column per table, one row.

    Counts key values, not rows; a repeated missing key is one value.
    """

    def repeated(table: str, key: str) -> DataFrame:
        counted = market.table(table).groupBy(key).count()
        return counted.filter("count > 1").agg(F.count(F.lit(1)).alias("n"))

    return _one_row({f"duplicate_{t.removeprefix('order_')}": repeated(t, k) for t, k in keys})


# Days that one bitmap covers: fixed by the bitmap functions.
BITMAP_BITS = 32_768


def _day_bits(market: Marketplace) -> DataFrame:
    """For each stretch of ``BITMAP_BITS`` days that has orders: its days as bits, the first and the last."""
    stamp = F.col("order_purchase_timestamp")
    number = F.unix_date(day(stamp))
    # Days before 1970 have negative numbers; the functions' own buckets count from the days after 0.
    bucket = (F.floor(number / BITMAP_BITS) + 1).cast("bigint").alias("bucket")
    numbers = market.table("orders").filter(stamp.isNotNull()).select(bucket, number.alias("number"))
    place = F.pmod(F.col("number"), F.lit(BITMAP_BITS)).cast("bigint")
    return numbers.groupBy("bucket").agg(
        F.bitmap_construct_agg(place).alias("bits"),
        F.min("number").alias("first"),
        F.max("number").alias("last"),
    )


def _days_set(stretches: DataFrame) -> DataFrame:
    """The ``number`` of every day whose bit is set; the first bit of a byte is its lowest."""
    in_bytes = F.transform(
        F.sequence(F.lit(0), F.lit(BITMAP_BITS // 8 - 1)),
        lambda i: F.conv(F.hex(F.substring("bits", i + 1, F.lit(1))), 16, 10).cast("int"),
    )
    held = stretches.select("bucket", F.posexplode(in_bytes).alias("byte", "value")).filter("value <> 0")
    spread = held.select("*", F.explode(F.sequence(F.lit(0), F.lit(7))).alias("bit"))
    number = (F.col("bucket") - 1) * BITMAP_BITS + F.col("byte") * 8 + F.col("bit")
    return spread.filter("shiftright(value, bit) & 1 = 1").select(number.cast("int").alias("number"))


def _stack(frames) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def _one_row(figures: Mapping[str, DataFrame]) -> DataFrame:
    """Put one-row, one-column frames side by side."""
    spark = next(iter(figures.values())).sparkSession
    return spark.range(0, 1, 1, 1).select(
        *[df.scalar().alias(name) for name, df in figures.items()]
    )
