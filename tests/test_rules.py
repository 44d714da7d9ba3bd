"""One small case per rule the analyses must keep."""

from __future__ import annotations

import datetime as dt

import pytest

import tallymart as tm
from tallymart import Period
from tests.small import by_key, item, market, order, rows

SELLERS = [("s1", "SP"), ("s2", "RJ"), ("s3", "SP")]


# --- date window -----------------------------------------------------------


def _dated(spark):
    return market(
        spark,
        orders=[
            order("a", bought="2020-01-01 00:00:00"),
            order("b", bought="2020-01-31 23:59:59"),
            order("c", bought="2020-02-01 00:00:00"),
            order("d", bought=None),
        ],
        order_items=[item(o) for o in "abcd"],
        products=[("p1", "toys")],
    )


@pytest.mark.parametrize(
    ("start", "end", "units"),
    [
        (None, None, 4),
        ("2020-01-01", "2020-01-31", 2),
        ("2020-01-31", None, 2),
        (None, "2020-01-31", 2),
        ("2020-02-01", "2020-02-01", 1),
    ],
)
def test_window_takes_whole_days_and_null_only_without_bounds(spark, start, end, units):
    found = tm.product_revenue(_dated(spark), Period.of(start, end))
    assert rows(found, "units_sold") == [(units,)]


@pytest.mark.parametrize("text", ["20240101", "2024-W01-1", "2024-1-1", "2024-02-30", "2024-01-01 ", ""])
def test_malformed_dates_are_refused(text):
    with pytest.raises(ValueError, match="start"):
        Period.of(start=text)


def test_dates_and_none_are_accepted():
    assert Period.of(dt.date(2024, 2, 29), None) == Period.of("2024-02-29")


# --- sellers ---------------------------------------------------------------


def test_rates_count_items_not_orders(spark):
    late = dict(bought="2020-01-01", arrived="2020-01-09", promised="2020-01-05")
    good = dict(bought="2020-01-01", arrived="2020-01-04", promised="2020-01-05")
    m = market(
        spark,
        orders=[order("a", **late), order("b", **good), order("c", status="canceled", **good)],
        order_items=[item("a"), item("a"), item("a"), item("b"), item("c")],
        sellers=SELLERS,
    )
    assert by_key(tm.seller_on_time(m)) == {"s1": (0.25,)}
    assert by_key(tm.seller_cancellations(m)) == {"s1": (0.2,)}
    assert by_key(tm.seller_revenue(m)) == {"s1": (5.0, 5)}


def test_on_time_compares_instants_and_state_table_compares_days(spark):
    m = market(
        spark,
        orders=[
            order(
                "a",
                bought="2020-01-01 08:00:00",
                arrived="2020-01-05 18:00:00",
                promised="2020-01-05 00:00:00",
            )
        ],
        order_items=[item("a")],
        sellers=SELLERS,
        customers=[("c1", "u1", "SP")],
    )
    assert by_key(tm.seller_on_time(m)) == {"s1": (0.0,)}
    assert by_key(tm.delivery_by_state(m), "customer_state", "pct_late") == {"SP": (0.0,)}


def test_missing_estimate(spark):
    m = market(
        spark,
        orders=[
            order("a", bought="2020-01-01", arrived="2020-01-03", promised=None),
            order("b", bought="2020-01-01", arrived="2020-01-09", promised="2020-01-05"),
        ],
        order_items=[item("a"), item("b")],
        sellers=SELLERS,
        customers=[("c1", "u1", "SP")],
    )
    assert by_key(tm.seller_on_time(m)) == {"s1": (0.0,)}
    assert rows(tm.delivery_by_state(m)) == [("SP", 2, 5.0, 4.0, 4.0, 50.0)]


def test_reviews_ignore_filters_and_repeat_per_item(spark):
    m = market(
        spark,
        orders=[order("a", bought="2020-01-01"), order("b", bought="2021-01-01")],
        order_items=[item("a"), item("a"), item("a"), item("b")],
        order_reviews=[("r1", "a", 5), ("r2", "b", 1), ("r3", "a", None)],
        sellers=SELLERS,
    )
    assert by_key(tm.seller_reviews(m)) == {"s1": (4.0,)}
    card = tm.seller_scorecard(m, Period.of("2021-01-01"))
    assert rows(card, "seller_id", "total_items_sold", "avg_review") == [("s1", 1, 4.0)]


def test_seller_without_review_or_delivery_ranks_last(spark):
    good = dict(bought="2020-01-01", arrived="2020-01-04", promised="2020-01-05")
    m = market(
        spark,
        orders=[order("a", **good), order("b", status="shipped", bought="2020-01-01")],
        order_items=[item("a"), item("b", seller="s2"), item("b", seller="s3")],
        order_reviews=[("r1", "a", 2)],
        sellers=SELLERS,
    )
    card = by_key(
        tm.seller_scorecard(m),
        "seller_id",
        "on_time_rate",
        "avg_review",
        "revenue_rank",
        "delivery_rank",
        "review_rank",
        "cancel_rank",
        "composite_score",
    )
    assert card == {
        "s1": (1.0, 2.0, 1, 1, 1, 1, 1.0),
        "s2": (None, None, 1, 2, 2, 1, 1.5),
        "s3": (None, None, 1, 2, 2, 1, 1.5),
    }


def test_ranks_leave_gaps_and_score_keeps_one_digit(spark):
    m = market(
        spark,
        orders=[order("a", bought="2020-01-01", status="shipped")],
        order_items=[
            item("a", seller="s1", price="9.00"),
            item("a", seller="s2", price="9.00"),
            item("a", seller="s3", price="5.00"),
        ],
        sellers=SELLERS,
    )
    card = by_key(tm.seller_scorecard(m), "seller_id", "revenue_rank", "composite_score")
    # (3 + 1 + 1 + 1) / 4 = 1.5
    assert card == {"s1": (1, 1.0), "s2": (1, 1.0), "s3": (3, 1.5)}


def test_state_filter_whether_or_not_sellers_are_copied(spark):
    m = market(
        spark,
        orders=[order("a", bought="2020-01-01")],
        order_items=[item("a", seller=s) for s in ("s1", "s2", "s3", "gone")],
        sellers=SELLERS,
    )
    few = sorted(rows(tm.seller_metrics(m, seller_state="SP")))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert sorted(rows(tm.seller_metrics(m, seller_state="SP"))) == few
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert [r[0] for r in few] == ["s1", "s3"]
    assert sorted(r[0] for r in rows(tm.seller_base(m, seller_state="SP"))) == ["s1", "s3"]


def test_repeated_orders_and_sellers_repeat_items(spark):
    m = market(
        spark,
        orders=[order("a", bought="2020-01-01")] * 2,
        order_items=[item("a", price="2.50"), item("a", price="0.10")],
        sellers=[("s1", "SP")] * 3,
        products=[("p1", "toys"), ("p1", "toys"), ("p1", "games")],
    )
    assert by_key(tm.seller_revenue(m)) == {"s1": (15.6, 12)}
    assert tm.seller_base(m).count() == 12
    assert sorted(rows(tm.product_revenue(m))) == [
        ("p1", "games", 5.2, 4),
        ("p1", "toys", 10.4, 8),
    ]


def test_missing_prices_are_skipped_but_counted(spark):
    m = market(
        spark,
        orders=[order("a", bought="2020-01-01")],
        order_items=[item("a"), item("a", price=None), item("a", seller="s2", price=None)],
        sellers=SELLERS,
    )
    assert by_key(tm.seller_revenue(m)) == {"s1": (1.0, 2), "s2": (None, 1)}


# --- products --------------------------------------------------------------


def _priced(spark, *prices, products=()):
    return market(
        spark,
        orders=[order("a", bought="2020-01-01")],
        order_items=[item("a", product=f"p{i}", price=p) for i, p in enumerate(prices)],
        products=list(products),
    )


def test_product_that_crosses_a_cut_falls_in_the_lower_class(spark):
    classes = by_key(
        tm.product_classes(_priced(spark, "80.00", "14.00", "6.00")),
        "product_id",
        "abc_class",
        "cumulative_pct",
    )
    assert classes == {"p0": ("A", 80.0), "p1": ("B", 94.0), "p2": ("C", 100.0)}
    classes = by_key(
        tm.product_classes(_priced(spark, "81.00", "19.00")), "product_id", "abc_class"
    )
    assert classes == {"p0": ("B",), "p1": ("C",)}


def test_class_without_products_has_no_row(spark):
    summary = rows(tm.abc_classification(_priced(spark, "100.00")))
    assert summary == [("C", 1, 100.0, 100.0)]


def test_class_share_sums_rounded_shares(spark):
    # Three equal thirds: 33.3333 each, so the classes do not add up to 100.
    summary = tm.abc_classification(_priced(spark, "1.00", "1.00", "1.00"))
    assert rows(summary, "abc_class", "pct_of_total_revenue") == [("A", 66.67), ("C", 33.33)]


def test_equal_revenue_is_ordered_by_product(spark):
    classes = by_key(
        tm.product_classes(_priced(spark, "1.00", "1.00", "1.00", "1.00")),
        "product_id",
        "cumulative_pct",
    )
    assert classes == {"p0": (25.0,), "p1": (50.0,), "p2": (75.0,), "p3": (100.0,)}


def test_unlisted_product_keeps_its_row_without_category(spark):
    m = _priced(spark, "2.00", "1.00", products=[("p0", "toys"), (None, "ghost")])
    assert sorted(rows(tm.product_revenue(m))) == [("p0", "toys", 2.0, 1), ("p1", None, 1.0, 1)]


def test_zero_revenue_gives_no_shares_and_the_last_class(spark):
    found = rows(
        tm.product_classes(_priced(spark, "0.00", "0.00")),
        "pct_of_revenue",
        "cumulative_pct",
        "abc_class",
    )
    assert found == [(None, None, "C")] * 2


# --- retention -------------------------------------------------------------


def _visits(spark, *days, accounts=None):
    accounts = accounts or {"c1": "u1"}
    return market(
        spark,
        orders=[
            order(f"o{i}", customer=c, bought=d) for i, (c, d) in enumerate(days)
        ],
        customers=[(c, u, "SP") for c, u in accounts.items()],
    )


def test_return_windows_are_cumulative_and_include_the_last_day(spark):
    m = _visits(spark, ("c1", "2020-01-01 23:00:00"), ("c1", "2020-01-31 01:00:00"))
    assert rows(tm.retention_flags(m)) == [("u1", 1, 1, 1)]
    m = _visits(spark, ("c1", "2020-01-01"), ("c1", "2020-02-01"))
    assert rows(tm.retention_flags(m)) == [("u1", 0, 1, 1)]
    assert rows(tm.retention_flags(m, windows=(31, 7))) == [("u1", 1, 0)]


def test_same_day_orders_are_no_return(spark):
    m = _visits(spark, ("c1", "2020-01-01 01:00:00"), ("c1", "2020-01-01 23:00:00"))
    assert rows(tm.cohort_retention(m)) == [(1, 0.0, 0.0, 0.0)]


def test_accounts_of_one_person_count_together(spark):
    m = _visits(
        spark,
        ("c1", "2020-01-01"),
        ("c2", "2020-01-10"),
        ("c3", "2020-01-01"),
        accounts={"c1": "u1", "c2": "u1", "c3": "u2"},
    )
    assert rows(tm.cohort_retention(m)) == [(2, 50.0, 50.0, 50.0)]


def test_window_bounds_the_first_purchase_but_not_the_return(spark):
    m = _visits(spark, ("c1", "2019-06-01"), ("c1", "2020-01-30"), ("c1", "2020-02-10"))
    january = Period.of("2020-01-01", "2020-01-31")
    assert rows(tm.retention_flags(m, january)) == [("u1", 1, 1, 1)]
    assert sorted(rows(tm.days_since_first(m, january))) == [("u1", -243), ("u1", 0), ("u1", 11)]
    assert rows(tm.cohort_retention(m, Period.of("2020-02-11"))) == [(0, None, None, None)]
    assert rows(tm.cohort_retention(m, Period.of(end="2019-12-31"))) == [(1, 0.0, 0.0, 0.0)]


def test_people_without_dates_count_only_without_bounds(spark):
    m = _visits(spark, ("c1", None), ("c2", "2020-01-01"), accounts={"c1": "u1", "c2": "u2"})
    assert rows(tm.cohort_retention(m), "total_customers") == [(2,)]
    assert rows(tm.cohort_retention(m, Period.of("2000-01-01")), "total_customers") == [(1,)]
    assert rows(tm.cohort_retention(m, Period.of(end="2030-01-01")), "total_customers") == [(1,)]


def test_nameless_people_have_a_first_purchase_but_no_retention(spark):
    m = _visits(spark, ("c1", "2020-01-01"), accounts={"c1": None})
    assert tm.first_purchase(m).count() == 1
    assert rows(tm.cohort_retention(m), "total_customers") == [(0,)]
    assert tm.days_since_first(m).count() == 0


# --- trends ----------------------------------------------------------------


def test_months_count_item_rows_and_leave_out_canceled(spark):
    m = market(
        spark,
        orders=[
            order("a", bought="2020-01-31 23:59:59"),
            order("b", bought="2020-01-01", status="canceled"),
            order("c", bought="2020-01-01", status=None),
            order("d", bought="2020-02-01"),
            order("e", bought="2020-02-01"),
        ],
        order_items=[item("a", price="1.10"), item("a", price="2.20"), item("b"), item("c"), item("d")],
    )
    assert rows(tm.orders_over_time(m)) == [
        (dt.date(2020, 1, 1), 2, 3.3),
        (dt.date(2020, 2, 1), 1, 1.0),
    ]


# --- audit -----------------------------------------------------------------


def test_orphans_are_rows_and_include_missing_keys(spark):
    m = market(
        spark,
        orders=[order("a", customer="gone"), order("b", customer=None), order("c")],
        order_items=[item("x"), item("x"), item("a", product=None, seller="s9")],
        customers=[("c1", "u1", "SP"), (None, "u2", "SP")],
        products=[("p1", None)],
        sellers=SELLERS,
    )
    assert rows(tm.orphan_keys(m)) == [(2, 2, 1, 1)]


def test_duplicates_are_key_values_and_missing_is_one(spark):
    m = market(
        spark,
        orders=[order("a")] * 3 + [order(None)] * 2 + [order("b")],
        sellers=[("s1", "SP"), (None, "SP")],
        order_reviews=[("r", "a", 1), ("r", "b", 2)],
    )
    assert rows(tm.duplicate_keys(m)) == [(2, 0, 0, 0, 1)]


def test_gaps_of_an_empty_table(spark):
    assert rows(tm.date_gaps(market(spark))) == [(None, None, 0)]


def test_gaps_between_first_and_last_day(spark):
    m = market(
        spark,
        orders=[order(o, bought=d) for o, d in (("a", "2020-02-27"), ("b", "2020-03-01"), ("c", None))],
    )
    assert rows(tm.date_gaps(m)) == [(dt.date(2020, 2, 27), dt.date(2020, 3, 1), 2)]
    assert sorted(rows(tm.missing_days(m))) == [(dt.date(2020, 2, 28),), (dt.date(2020, 2, 29),)]


def test_null_profile_has_no_counts_for_keys_of_empty_tables(spark):
    m = market(spark, orders=[order(None, customer=None), order("a")])
    assert by_key(tm.null_profile(m)) == {
        "orders": (2, 1, 1, 0, 0),
        "customers": (0, 0, None, 0, 0),
        "products": (0, 0, 0, None, 0),
        "sellers": (0, 0, 0, 0, None),
    }


def test_gaps_over_many_decades_come_from_one_pass(spark):
    days = ["1901-02-27", "1969-12-31", "1970-01-01", "2059-09-18", "2059-09-19", "2059-09-21"]
    m = market(spark, orders=[order(str(i), bought=day) for i, day in enumerate(days * 3)])
    first, last = dt.date(1901, 2, 27), dt.date(2059, 9, 21)
    missing = (last - first).days + 1 - len(days)
    assert rows(tm.date_gaps(m)) == [(first, last, missing)]
    found = {r[0] for r in rows(tm.missing_days(m))}
    assert len(found) == missing
    assert found.isdisjoint(dt.date.fromisoformat(day) for day in days)
    assert min(found) > first and max(found) == dt.date(2059, 9, 20)
