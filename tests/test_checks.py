"""Pre-flight checks: pass, warn and fail."""

from __future__ import annotations

import datetime as dt

import tallymart as tm
from tests.small import item, market, order, rows

TODAY = dt.date(2024, 6, 1)


def _verdicts(df):
    return {(r.check, r.item): (r.observed, r.passed, r.severity) for r in df.collect()}


def _good(spark, **changes):
    tables = dict(
        orders=[order("a", bought="2020-01-01"), order("b", bought="2021-01-01")],
        order_items=[item("a")],
        customers=[("c1", "u1", "SP")],
        products=[("p1", None)],
        sellers=[("s1", "SP")],
    )
    return market(spark, **{**tables, **changes})


def _dates(spark, *bought, min_year=2015):
    m = _good(spark, orders=[order(str(i), bought=b) for i, b in enumerate(bought)])
    found = tm.check_date_range(m, min_year, TODAY).collect()
    return {r.check: (r.passed, r.severity) for r in found}


def test_every_missing_table_is_named(spark):
    found = _verdicts(tm.check_tables_exist(_good(spark).without("geolocation", "sellers")))
    assert len(found) == 9
    assert {k[1] for k, v in found.items() if not v[1]} == {"geolocation", "sellers"}
    assert found["tables_exist", "sellers"][0] == "missing"


def test_key_column_fails_only_when_all_values_are_missing(spark):
    m = _good(spark, customers=[(None, "u", "SP"), ("c", "u", "SP")], sellers=[(None, "SP")])
    found = _verdicts(tm.check_key_columns(m.without("products")))
    assert found == {
        ("key_columns", "orders.order_id"): ("2", True, "fail"),
        ("key_columns", "customers.customer_id"): ("1", True, "fail"),
        ("key_columns", "products.product_id"): ("none", False, "fail"),
        ("key_columns", "sellers.seller_id"): ("0", False, "fail"),
    }


def test_dates_in_range(spark):
    assert _dates(spark, "2020-01-01", "2024-06-01 23:00:00") == {
        "dates_present": (True, "fail"),
        "dates_not_ahead": (True, "warn"),
        "dates_not_too_early": (True, "fail"),
    }


def test_future_dates_warn_and_old_dates_fail(spark):
    found = _dates(spark, "2014-12-31", "2024-06-02")
    assert found["dates_not_ahead"] == (False, "warn")
    assert found["dates_not_too_early"] == (False, "fail")
    assert _dates(spark, "2014-12-31", min_year=2014)["dates_not_too_early"] == (True, "fail")


def test_no_dates_fail_without_judging_the_range(spark):
    assert _dates(spark) == {"dates_present": (False, "fail")}
    assert _dates(spark, None) == {"dates_present": (False, "fail")}


def test_row_counts_against_minimums(spark):
    found = _verdicts(
        tm.check_row_counts(_good(spark).without("customers"), {"orders": 2, "order_items": 2, "customers": 0})
    )
    assert found == {
        ("row_counts", "orders"): ("2", True, "fail"),
        ("row_counts", "order_items"): ("1", False, "fail"),
        ("row_counts", "customers"): ("none", False, "fail"),
    }


def test_all_checks_run_whatever_the_others_find(spark):
    m = _good(spark).without("orders", "geolocation")
    found = tm.run_validation(m, as_of=TODAY)
    by_check = {}
    for r in found.collect():
        by_check.setdefault(r.check, []).append(r.passed)
    assert len(by_check["tables_exist"]) == 9
    assert len(by_check["key_columns"]) == 4
    assert len(by_check["row_counts"]) == 3
    assert by_check["dates_present"] == [False]
    assert rows(tm.validation_passed(found)) == [(False,)]


def test_warnings_do_not_fail_the_run(spark):
    m = _good(spark, orders=[order("a", bought="2030-01-01")])
    minimums = {"orders": 1}
    found = tm.run_validation(m, as_of=TODAY, minimums=minimums)
    assert [r.check for r in found.collect() if not r.passed] == ["dates_not_ahead"]
    assert rows(tm.validation_passed(found)) == [(True,)]
    old = tm.run_validation(m, min_year=2031, as_of=TODAY, minimums=minimums)
    assert rows(tm.validation_passed(old)) == [(False,)]


def test_a_missing_column_fails_its_own_check_only(spark):
    whole = _good(spark)
    m = whole.replace(customers=whole.table("customers").drop("customer_id"))
    found = _verdicts(tm.run_validation(m, 2015, TODAY, {"orders": 1}))
    assert not found["key_columns", "customers.customer_id"][1]
    failed = {key for key, (_, passed, _) in found.items() if not passed}
    assert failed <= {("key_columns", "customers.customer_id"), ("key_columns", "order_reviews.review_id")}
    undated = whole.replace(orders=whole.table("orders").drop("order_purchase_timestamp"))
    assert not _verdicts(tm.check_date_range(undated, 2015, TODAY))["dates_present", "orders.order_purchase_timestamp"][1]


def test_an_unreadable_table_fails_its_own_checks(spark, tmp_path):
    for name in ("orders", "customers"):
        _good(spark).table(name).write.parquet(f"{tmp_path}/{name}")
    (tmp_path / "sellers").mkdir()
    m = tm.Marketplace.from_folder(spark, str(tmp_path))
    found = _verdicts(tm.run_validation(m, 2015, TODAY, {"sellers": 1, "orders": 1}))
    assert found["tables_exist", "orders"][1] and not found["tables_exist", "sellers"][1]
    assert not found["row_counts", "sellers"][1] and found["row_counts", "orders"][1]
