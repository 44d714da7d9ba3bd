"""Seller performance: revenue, punctuality, reviews, cancellations, ranks."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallymart.functions.dates import month_start
from tallymart.functions.numeric import flag, ratio
from tallymart.functions.period import EVERYTHING, Period
from tallymart.operators.ranking import composite_rank
from tallymart.sources.marketplace import Marketplace
from tallymart.sources.scratch import materialise

# Order states with a meaning of their own.
DELIVERED = "delivered"
CANCELED = "canceled"

SCORECARD_RANKS = (
    ("total_revenue", "desc", "revenue_rank"),
    ("on_time_rate", "desc", "delivery_rank"),
    ("avg_review", "desc", "review_rank"),
    ("cancel_rate", "asc", "cancel_rank"),
)


def seller_scorecard(
    market: Marketplace, period: Period = EVERYTHING, seller_state: str | None = None
) -> DataFrame:
    """All seller metrics, four global ranks and their mean; the best (lowest) first.

    Date and state bound what counts as sold; the review mean covers every
    review of the seller's items. Sellers without a delivered item have no
    on-time rate and share the last delivery rank.
    """
    ranked = ranked_sellers(market, period, seller_state)
    return ranked.orderBy(F.col("composite_score").asc_nulls_last(), F.col("seller_id"))


def ranked_sellers(
    market: Marketplace,
    period: Period = EVERYTHING,
    seller_state: str | None = None,
    sold: DataFrame | None = None,
) -> DataFrame:
    """The rows of :func:`seller_scorecard` in any order."""
    return composite_rank(seller_metrics(market, period, seller_state, sold), SCORECARD_RANKS)


def seller_metrics(
    market: Marketplace,
    period: Period = EVERYTHING,
    seller_state: str | None = None,
    sold: DataFrame | None = None,
) -> DataFrame:
    """Revenue, items, on-time rate, mean review and cancel rate per seller.

    Everything comes from one pass over the items. Orders and reviews shrink to
    one stored row per order, which plain items join: Spark can split a hot
    order, partial sums take care of a hot seller, and order facts and reviews
    share a single join. The stored rows are written while the query is built.
    With ``sold``, the :func:`sold_items` of the same period, that join is already made.
    """
    if sold is None:
        facts = _per_order(_order_events(market, period).unionByName(_review_events(market)))
        sums = _per_seller(market, facts, seller_state)
    else:
        sums = _seller_sums(market, _of_state(market, sold, seller_state))
    return sums.filter(F.col("items") > 0).join(_seller_copies(market, seller_state), "seller_id").select(
        "seller_id",
        *_sales_columns(market),
        _on_time_rate(),
        _avg_review(market),
        _cancel_rate(),
    )


def seller_revenue(
    market: Marketplace, period: Period = EVERYTHING, seller_state: str | None = None
) -> DataFrame:
    """Sum of price and number of items per seller."""
    sums = _sold_sums(market, period, seller_state)
    return sums.select("seller_id", *_sales_columns(market))


def seller_on_time(
    market: Marketplace, period: Period = EVERYTHING, seller_state: str | None = None
) -> DataFrame:
    """Share of delivered items that arrived by the estimated instant.

    Counts items, not orders. A missing estimate is not on time.
    """
    sums = _sold_sums(market, period, seller_state)
    return sums.filter(F.col("arrived") > 0).select("seller_id", _on_time_rate())


def seller_cancellations(
    market: Marketplace, period: Period = EVERYTHING, seller_state: str | None = None
) -> DataFrame:
    """Share of items that belong to canceled orders."""
    sums = _sold_sums(market, period, seller_state)
    return sums.select("seller_id", _cancel_rate())


def seller_reviews(market: Marketplace) -> DataFrame:
    """Mean review score over review and item pairs of an order, all dates and states."""
    facts = _per_order(_review_events(market))
    return _per_seller(market, facts, None).select("seller_id", _avg_review(market))


def sold_items(market: Marketplace, period: Period = EVERYTHING) -> DataFrame:
    """Items with the facts of their order, stored for all analyses that need both.

    Holds every item whose order falls in the period or has a review. ``sales``
    counts the order's rows in the period, ``months`` how many of them that are
    not canceled fall in each month: one entry, unless an order id is repeated.
    Orders shrink to one stored row each, then plain items join them: the only
    shuffle of the items by order, in which Spark can split a hot order.
    """
    events = _order_events(market, period, by_month=True).unionByName(
        _review_events(market), allowMissingColumns=True
    )
    counted = [c for c in events.columns if c not in ("order_id", "order_month", "live")]
    sums = [F.sum(c).alias(c) for c in counted]
    by_month = (
        events.filter(F.col("order_id").isNotNull())
        .groupBy("order_id", "order_month")
        .agg(*sums, F.sum("live").alias("order_rows"))
    )
    month = F.when(F.col("order_rows") > 0, F.struct("order_month", "order_rows"))
    facts = materialise(by_month.groupBy("order_id").agg(*sums, F.collect_list(month).alias("months")))
    prices = market.amounts("order_items").names("price_units")
    items = market.table("order_items").select("order_id", "seller_id", "product_id", *prices)
    return materialise(items.join(facts, "order_id").drop("order_id"))


def seller_base(
    market: Marketplace, period: Period = EVERYTHING, seller_state: str | None = None
) -> DataFrame:
    """Item rows with the facts of their order, after all filters."""
    orders = period.keep(market.table("orders"), "order_purchase_timestamp").select(
        "order_id",
        "order_status",
        "order_delivered_customer_date",
        "order_estimated_delivery_date",
    )
    sellers = _sellers(market, seller_state).select("seller_id")
    return (
        period.keep_days(_items(market, seller_state))
        .select("order_id", "seller_id", "price")
        .join(orders, "order_id")
        .join(sellers, "seller_id")
        .drop("order_id")
    )


def _sold_sums(market: Marketplace, period: Period, seller_state: str | None) -> DataFrame:
    facts = _per_order(_order_events(market, period))
    sums = _per_seller(market, facts, seller_state, period)
    return sums.join(_seller_copies(market, seller_state), "seller_id")


def _order_events(market: Marketplace, period: Period, by_month: bool = False) -> DataFrame:
    orders = period.keep(market.table("orders"), "order_purchase_timestamp")
    arrived = (F.col("order_status") == DELIVERED) & F.col(
        "order_delivered_customer_date"
    ).isNotNull()
    in_time = F.col("order_delivered_customer_date") <= F.col("order_estimated_delivery_date")
    month = [
        month_start(F.col("order_purchase_timestamp")).alias("order_month"),
        flag(F.col("order_status") != CANCELED).alias("live"),
    ]
    return orders.select(
        "order_id",
        *(month if by_month else []),
        F.lit(1).alias("sales"),
        flag(arrived).alias("arrived"),
        flag(arrived & in_time).alias("on_time"),
        flag(F.col("order_status") == CANCELED).alias("canceled"),
        *[F.lit(0).alias(name) for name in market.amounts("order_reviews").names("score_sum")],
        F.lit(0).alias("scores"),
    )


def _review_events(market: Marketplace) -> DataFrame:
    none = F.lit(0)
    marks = market.amounts("order_reviews")
    scores = zip(marks.names("score_units"), marks.names("score_sum"), strict=True)
    return market.table("order_reviews").select(
        "order_id",
        none.alias("sales"),
        none.alias("arrived"),
        none.alias("on_time"),
        none.alias("canceled"),
        *[F.coalesce(units, none).alias(name) for units, name in scores],
        flag(F.col("review_score").isNotNull()).alias("scores"),
    )


def _per_order(events: DataFrame) -> DataFrame:
    counted = [c for c in events.columns if c != "order_id"]
    known = events.filter(F.col("order_id").isNotNull())
    return materialise(known.groupBy("order_id").agg(*[F.sum(c).alias(c) for c in counted]))


def _per_seller(
    market: Marketplace, facts: DataFrame, seller_state: str | None, period: Period = EVERYTHING
) -> DataFrame:
    """Reviews count whatever the day of their order: a ``period`` for the items only where they play no part."""
    prices = market.amounts("order_items").names("price_units")
    items = period.keep_days(_items(market, seller_state)).select("order_id", "seller_id", *prices)
    return _seller_sums(market, items.join(facts, "order_id"))


def _seller_sums(market: Marketplace, sold: DataFrame) -> DataFrame:
    money = market.amounts("order_items")
    prices = money.names("price_units")
    revenue = [F.when(F.col("sales") > 0, money.times(F.col(price), F.col("sales"))) for price in prices]
    counted = ("arrived", "on_time", "canceled", *market.amounts("order_reviews").names("score_sum"), "scores")
    return sold.groupBy("seller_id").agg(
        *[F.sum(part).alias(name) for part, name in zip(revenue, money.names("earned"), strict=True)],
        F.sum("sales").alias("items"),
        *[F.sum(c).alias(c) for c in counted],
    )


def _items(market: Marketplace, seller_state: str | None) -> DataFrame:
    return _of_state(market, market.table("order_items"), seller_state)


def _of_state(market: Marketplace, items: DataFrame, seller_state: str | None) -> DataFrame:
    """Items that may count for the state.

    A plain semi join: Spark copies the sellers' keys to the items where they
    are few, and shuffles (and splits) the items where they are not.
    """
    if seller_state is None:
        return items
    return items.join(_sellers(market, seller_state).select("seller_id"), "seller_id", "left_semi")


def _sellers(market: Marketplace, seller_state: str | None) -> DataFrame:
    sellers = market.table("sellers")
    if seller_state is not None:
        sellers = sellers.filter(F.col("seller_state") == F.lit(seller_state))
    return sellers


def _seller_copies(market: Marketplace, seller_state: str | None) -> DataFrame:
    """How often each seller is listed: joining item rows would repeat them as often."""
    return (
        _sellers(market, seller_state)
        .groupBy("seller_id")
        .agg(F.count(F.lit(1)).alias("copies"))
    )


def _sales_columns(market: Marketplace):
    money = market.amounts("order_items")
    earned = [money.times(F.col(name), F.col("copies")) for name in money.names("earned")]
    return (
        money.double(earned).alias("total_revenue"),
        (F.col("items") * F.col("copies")).alias("total_items_sold"),
    )


def _on_time_rate():
    return ratio(F.col("on_time"), F.col("arrived")).alias("on_time_rate")


def _avg_review(market: Marketplace):
    marks = market.amounts("order_reviews")
    total = marks.double([F.col(name) for name in marks.names("score_sum")])
    return ratio(total, F.col("scores")).alias("avg_review")


def _cancel_rate():
    return ratio(F.col("canceled"), F.col("items")).alias("cancel_rate")
