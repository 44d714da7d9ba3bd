"""Figures measured on the test tables beforehand, and relations that always hold."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

import tallymart as tm
from catalogue import perturbed
from catalogue.star import star_market
from tallymart import Period
from tests.conftest import TESTDATA
from tests.small import by_key, rows


@pytest.fixture(scope="module")
def markets(spark):
    return {sf: star_market(spark, str(TESTDATA / f"sf{sf}")) for sf in ("0.001", "0.01")}


def test_orders_by_status(markets):
    orders = markets["0.01"].table("orders")
    found = by_key(
        orders.groupBy("order_status").agg(
            F.count(F.lit(1)), F.count("order_delivered_customer_date")
        )
    )
    assert found == {
        "canceled": (1_263, 1_254),
        "delivered": (9_912, 9_802),
        "shipped": (3_825, 755),
    }


def test_late_orders_by_instant_and_by_day(markets):
    m = markets["0.01"]
    late = F.col("order_delivered_customer_date") > F.col("order_estimated_delivery_date")
    delivered = m.table("orders").filter("order_status = 'delivered'")
    assert delivered.filter(late).count() == 3_846
    assert tm.delivery_times(m).filter("actual_days > estimated_days").count() == 3_687


def test_retention_and_class_sizes(markets):
    m = markets["0.01"]
    assert rows(tm.cohort_retention(m)) == [(750, 21.47, 40.27, 53.6)]
    sizes = rows(tm.abc_classification(m), "abc_class", "product_count")
    assert sizes == [("A", 1_468), ("B", 375), ("C", 157)]


def test_item_rows_of_orders_not_canceled(markets):
    months = tm.orders_over_time(markets["0.01"])
    assert rows(months.agg(F.sum("total_orders"))) == [(54_893,)]


@pytest.mark.parametrize(
    ("start", "end", "missing", "sellers"),
    [
        ("1997-01-01", "1997-12-31", 0, 100),
        ("1997-03-01", "1997-03-07", 27, 80),
        ("1997-03-01", "1997-03-01", 1, 31),
    ],
)
def test_sellers_without_a_delivered_item(markets, start, end, missing, sellers):
    metrics = tm.seller_metrics(markets["0.01"], Period.of(start, end))
    undelivered = F.count_if(F.col("on_time_rate").isNull())
    assert rows(metrics.agg(undelivered, F.count(F.lit(1)))) == [(missing, sellers)]


BROKEN = {
    "0.001": {
        "nulls": {"orders": (6, 4), "customers": 2, "products": 3, "sellers": 1},
        "orphans": (45, 50, 268, 1_211),
        "repeats": (4, 3, 3, 1, 3),
        "gaps": (1_315, 1_311),
    },
    "0.01": {
        "nulls": {"orders": (60, 34), "customers": 17, "products": 25, "sellers": 6},
        "orphans": (459, 500, 2_276, 4_174),
        "repeats": (23, 21, 21, 4, 30),
        "gaps": (9, 6),
    },
}


@pytest.mark.parametrize("sf", BROKEN)
def test_audit_of_damaged_tables(markets, sf):
    sound, expected = markets[sf], BROKEN[sf]
    damaged = perturbed.broken(sound)
    nulls = by_key(tm.null_profile(damaged))
    assert nulls["orders"][1:3] == expected["nulls"]["orders"]
    assert nulls["customers"][2] == expected["nulls"]["customers"]
    assert nulls["products"][3] == expected["nulls"]["products"]
    assert nulls["sellers"][4] == expected["nulls"]["sellers"]
    assert rows(tm.orphan_keys(damaged)) == [expected["orphans"]]
    assert rows(tm.duplicate_keys(damaged)) == [expected["repeats"]]
    gaps = [rows(tm.date_gaps(m), "missing_days")[0][0] for m in (damaged, sound)]
    assert tuple(gaps) == expected["gaps"]


def test_sound_tables_have_no_orphans(markets):
    assert rows(tm.orphan_keys(markets["0.001"])) == [(0, 0, 0, 0)]


# --- relations -------------------------------------------------------------


def test_class_shares_add_up_within_rounding(markets):
    m = markets["0.01"]
    total, products = tm.abc_classification(m).agg(
        F.sum("pct_of_total_revenue"), F.sum("product_count")
    ).head()
    assert abs(total - 100) <= 0.00005 * products + 0.015


def test_longer_windows_retain_no_fewer(markets):
    _, thirty, sixty, ninety = rows(tm.cohort_retention(markets["0.001"]))[0]
    assert thirty <= sixty <= ninety


def test_one_pass_metrics_equal_the_separate_ones(markets):
    m, period = markets["0.01"], Period.of("1997-03-01", "1997-03-07")
    separate = (
        tm.seller_revenue(m, period)
        .join(tm.seller_on_time(m, period), "seller_id", "left")
        .join(tm.seller_reviews(m), "seller_id", "left")
        .join(tm.seller_cancellations(m, period), "seller_id", "left")
    )
    assert sorted(rows(tm.seller_metrics(m, period))) == sorted(rows(separate))


def test_metrics_equal_the_definition_on_item_rows(markets):
    m = markets["0.01"]
    base = tm.seller_base(m)
    arrived = F.expr(
        "order_status = 'delivered' and order_delivered_customer_date is not null"
    )
    in_time = F.expr("order_delivered_customer_date <= order_estimated_delivery_date")
    plain = base.groupBy("seller_id").agg(
        F.sum("price").cast("double"),
        F.count(F.lit(1)),
        F.avg(F.when(arrived, F.when(in_time, 1).otherwise(0))),
        F.avg(F.when(F.col("order_status") == "canceled", 1).otherwise(0)),
    )
    found = tm.seller_metrics(m).drop("avg_review")
    assert sorted(rows(found)) == sorted(rows(plain))
