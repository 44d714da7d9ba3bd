"""Every operator as a registered query, next to the SQL it is checked against."""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import tallymart as tm
from catalogue import oracle as sql
from catalogue import perturbed
from catalogue.star import star_market
from tallymart.plans import publish, report
from tallymart.sources.scratch import scratch_root

Query = Callable[[SparkSession, str], DataFrame]

YEAR = tm.Period.of("1997-01-01", "1997-12-31")
WEEK = tm.Period.of("1997-03-01", "1997-03-07")
SINCE = tm.Period.of(start="1999-06-01")
UNTIL = tm.Period.of(end="1996-06-30")
IN_YEAR = sql.during("1997-01-01", "1997-12-31")
IN_WEEK = sql.during("1997-03-01", "1997-03-07")
IN_SINCE = sql.during(start="1999-06-01")
IN_UNTIL = sql.during(end="1996-06-30")
STATE = "NATION_9"
AS_OF = dt.date(2002, 1, 1)
EARLY_AS_OF = dt.date(2000, 1, 1)


@dataclass(frozen=True)
class Entry:
    build: Callable[[tm.Marketplace], DataFrame]
    check: str

    def query(self, spark: SparkSession, folder: str) -> DataFrame:
        return self.build(star_market(spark, folder))


def _out(market: tm.Marketplace) -> str:
    return f"{scratch_root(market.spark)}/tallymart/out-{uuid.uuid4().hex}"


def _written_detail(market: tm.Marketplace) -> DataFrame:
    path = publish.write_detail(tm.seller_scorecard(market, YEAR, STATE), _out(market))
    return market.spark.read.parquet(path)


def _written_summary(market: tm.Marketplace) -> DataFrame:
    classes = tm.abc_classification(market, YEAR)
    path = publish.write_summary(classes, _out(market))
    return market.spark.read.schema(classes.schema).option("header", True).csv(path)


def _written_chart(market: tm.Marketplace) -> DataFrame:
    top = report.top_delayed_states(tm.delivery_by_state(market))
    path = publish.write_chart_data(top, _out(market))
    return market.spark.read.schema(top.schema).json(path)


def _written_sheet(market: tm.Marketplace) -> DataFrame:
    sheet = report.orders_over_time_sheet(tm.orders_over_time(market, YEAR))
    path = publish.write_sheets({"orders_over_time": sheet}, _out(market))["orders_over_time"]
    return market.spark.read.parquet(path)


def _findings(market: tm.Marketplace) -> DataFrame:
    return report.key_findings(
        tm.seller_scorecard(market),
        tm.delivery_by_state(market),
        tm.abc_classification(market),
        tm.cohort_retention(market),
    )


def _ranked_products(market: tm.Marketplace) -> DataFrame:
    ranks = (("revenue", "desc", "by_revenue"), ("units_sold", "asc", "by_units"))
    return tm.composite_rank(tm.product_revenue(market), ranks, "mean_rank", 1)


def _entries() -> dict[str, Entry]:
    broken, tied, unestimated = perturbed.broken, perturbed.tied, perturbed.unestimated
    card, base = "SELECT * FROM scorecard", sql.SELLER_BASE
    classes, graded = "SELECT * FROM classes", "SELECT * FROM graded"
    states, transit = "SELECT * FROM states", "SELECT * FROM transit"
    rates, flags = "SELECT * FROM rates", "SELECT * FROM flags"
    months = "SELECT * FROM months"
    sums = "SELECT seller_id, total_revenue, total_items_sold FROM sums"
    on_time = "SELECT seller_id, on_time_rate FROM sums WHERE on_time_rate IS NOT NULL"
    canceled = "SELECT seller_id, cancel_rate FROM sums"
    return {
        # Sellers
        "seller_scorecard": Entry(tm.seller_scorecard, sql.sellers(card)),
        "seller_scorecard_1997": Entry(
            lambda m: tm.seller_scorecard(m, YEAR), sql.sellers(card, IN_YEAR)
        ),
        "seller_scorecard_week": Entry(
            lambda m: tm.seller_scorecard(m, WEEK), sql.sellers(card, IN_WEEK)
        ),
        "seller_scorecard_state": Entry(
            lambda m: tm.seller_scorecard(m, seller_state=STATE), sql.sellers(card, state=STATE)
        ),
        "seller_scorecard_state_1997": Entry(
            lambda m: tm.seller_scorecard(m, YEAR, STATE), sql.sellers(card, IN_YEAR, STATE)
        ),
        "seller_scorecard_tied": Entry(
            lambda m: tm.seller_scorecard(tied(m)), sql.sellers(card, views=sql.TIED)
        ),
        "seller_scorecard_unestimated": Entry(
            lambda m: tm.seller_scorecard(unestimated(m)),
            sql.sellers(card, views=sql.UNESTIMATED),
        ),
        "seller_scorecard_broken": Entry(
            lambda m: tm.seller_scorecard(broken(m)), sql.sellers(card, views=sql.BROKEN)
        ),
        "seller_base": Entry(tm.seller_base, sql.sellers(base)),
        "seller_base_state_1997": Entry(
            lambda m: tm.seller_base(m, YEAR, STATE), sql.sellers(base, IN_YEAR, STATE)
        ),
        "seller_revenue": Entry(tm.seller_revenue, sql.sellers(sums)),
        "seller_revenue_1997": Entry(
            lambda m: tm.seller_revenue(m, YEAR), sql.sellers(sums, IN_YEAR)
        ),
        "seller_revenue_broken": Entry(
            lambda m: tm.seller_revenue(broken(m)), sql.sellers(sums, views=sql.BROKEN)
        ),
        "seller_revenue_subcent": Entry(
            lambda m: tm.seller_revenue(perturbed.subcent(m)), sql.sellers(sums, views=sql.SUBCENT)
        ),
        "seller_revenue_doubles": Entry(
            lambda m: tm.seller_revenue(perturbed.doubles(m)),
            sql.sellers(
                f"SELECT * REPLACE (total_revenue / {sql.UNIT} AS total_revenue) FROM ({sums})", views=sql.DOUBLES
            ),
        ),
        "seller_reviews_halves": Entry(
            lambda m: tm.seller_reviews(perturbed.halves(m)),
            sql.sellers("SELECT * FROM scores", views=sql.HALVES),
        ),
        "seller_on_time": Entry(tm.seller_on_time, sql.sellers(on_time)),
        "seller_on_time_week": Entry(
            lambda m: tm.seller_on_time(m, WEEK), sql.sellers(on_time, IN_WEEK)
        ),
        "seller_on_time_unestimated": Entry(
            lambda m: tm.seller_on_time(unestimated(m)),
            sql.sellers(on_time, views=sql.UNESTIMATED),
        ),
        "seller_reviews": Entry(tm.seller_reviews, sql.sellers("SELECT * FROM scores")),
        "seller_cancellations": Entry(tm.seller_cancellations, sql.sellers(canceled)),
        "seller_cancellations_1997": Entry(
            lambda m: tm.seller_cancellations(m, YEAR), sql.sellers(canceled, IN_YEAR)
        ),
        "composite_rank": Entry(
            _ranked_products,
            sql.products(
                "SELECT *, round((by_revenue + by_units) / 2.0, 1) AS mean_rank FROM placed",
                placed="""SELECT product_id, product_category_name, revenue::DOUBLE AS revenue,
                    units_sold, rank() OVER (ORDER BY revenue DESC NULLS LAST) AS by_revenue,
                    rank() OVER (ORDER BY units_sold NULLS LAST) AS by_units FROM earned""",
            ),
        ),
        # Products
        "abc_classification": Entry(tm.abc_classification, sql.products(classes)),
        "abc_classification_1997": Entry(
            lambda m: tm.abc_classification(m, YEAR), sql.products(classes, IN_YEAR)
        ),
        "abc_classification_tied": Entry(
            lambda m: tm.abc_classification(tied(m)), sql.products(classes, views=sql.TIED)
        ),
        "abc_classification_broken": Entry(
            lambda m: tm.abc_classification(broken(m)), sql.products(classes, views=sql.BROKEN)
        ),
        "product_revenue": Entry(tm.product_revenue, sql.products(sql.PRODUCT_REVENUE)),
        "product_revenue_1997": Entry(
            lambda m: tm.product_revenue(m, YEAR), sql.products(sql.PRODUCT_REVENUE, IN_YEAR)
        ),
        "product_revenue_broken": Entry(
            lambda m: tm.product_revenue(broken(m)),
            sql.products(sql.PRODUCT_REVENUE, views=sql.BROKEN),
        ),
        "cumulative_share_classify": Entry(
            lambda m: _plain_revenue(tm.product_classes(m)), sql.products(_plain_sql(graded))
        ),
        "cumulative_share_classify_tied": Entry(
            lambda m: _plain_revenue(tm.product_classes(tied(m))),
            sql.products(_plain_sql(graded), views=sql.TIED),
        ),
        # Delivery
        "delivery_by_state": Entry(tm.delivery_by_state, sql.delivery(states)),
        "delivery_by_state_1997": Entry(
            lambda m: tm.delivery_by_state(m, YEAR), sql.delivery(states, IN_YEAR)
        ),
        "delivery_by_state_unestimated": Entry(
            lambda m: tm.delivery_by_state(unestimated(m)),
            sql.delivery(states, views=sql.UNESTIMATED),
        ),
        "delivery_by_state_broken": Entry(
            lambda m: tm.delivery_by_state(broken(m)), sql.delivery(states, views=sql.BROKEN)
        ),
        "delivery_times": Entry(tm.delivery_times, sql.delivery(transit)),
        "delivery_times_1997": Entry(
            lambda m: tm.delivery_times(m, YEAR), sql.delivery(transit, IN_YEAR)
        ),
        # Retention
        "cohort_retention": Entry(tm.cohort_retention, sql.retention(rates)),
        "cohort_retention_1997": Entry(
            lambda m: tm.cohort_retention(m, YEAR), sql.retention(rates, IN_YEAR)
        ),
        "cohort_retention_since": Entry(
            lambda m: tm.cohort_retention(m, SINCE), sql.retention(rates, IN_SINCE)
        ),
        "cohort_retention_until": Entry(
            lambda m: tm.cohort_retention(m, UNTIL), sql.retention(rates, IN_UNTIL)
        ),
        "cohort_retention_broken": Entry(
            lambda m: tm.cohort_retention(broken(m)), sql.retention(rates, views=sql.BROKEN)
        ),
        "first_purchase": Entry(tm.first_purchase, sql.retention("SELECT * FROM firsts")),
        "first_purchase_1997": Entry(
            lambda m: tm.first_purchase(m, YEAR), sql.retention("SELECT * FROM firsts", IN_YEAR)
        ),
        "days_since_first": Entry(tm.days_since_first, sql.retention("SELECT * FROM gaps")),
        "days_since_first_1997": Entry(
            lambda m: tm.days_since_first(m, YEAR), sql.retention("SELECT * FROM gaps", IN_YEAR)
        ),
        "days_since_first_broken": Entry(
            lambda m: tm.days_since_first(broken(m)),
            sql.retention("SELECT * FROM gaps", views=sql.BROKEN),
        ),
        "retention_flags": Entry(tm.retention_flags, sql.retention(flags)),
        "retention_flags_1997": Entry(
            lambda m: tm.retention_flags(m, YEAR), sql.retention(flags, IN_YEAR)
        ),
        "retention_flags_week": Entry(
            lambda m: tm.retention_flags(m, WEEK), sql.retention(flags, IN_WEEK)
        ),
        # Trends
        "orders_over_time": Entry(tm.orders_over_time, sql.trend(months)),
        "orders_over_time_1997": Entry(
            lambda m: tm.orders_over_time(m, YEAR), sql.trend(months, IN_YEAR)
        ),
        "orders_over_time_broken": Entry(
            lambda m: tm.orders_over_time(broken(m)), sql.trend(months, views=sql.BROKEN)
        ),
        # Audit
        "row_counts": Entry(tm.row_counts, sql.statement(sql.ROW_COUNTS)),
        "null_profile": Entry(tm.null_profile, sql.statement(sql.NULL_PROFILE)),
        "null_profile_broken": Entry(
            lambda m: tm.null_profile(broken(m)), sql.statement(sql.NULL_PROFILE, sql.BROKEN)
        ),
        "orphan_keys": Entry(tm.orphan_keys, sql.statement(sql.ORPHAN_KEYS)),
        "orphan_keys_broken": Entry(
            lambda m: tm.orphan_keys(broken(m)), sql.statement(sql.ORPHAN_KEYS, sql.BROKEN)
        ),
        "date_gaps": Entry(tm.date_gaps, sql.statement(sql.DATE_GAPS)),
        "date_gaps_broken": Entry(
            lambda m: tm.date_gaps(broken(m)), sql.statement(sql.DATE_GAPS, sql.BROKEN)
        ),
        "missing_days": Entry(tm.missing_days, sql.statement(sql.MISSING_DAYS)),
        "duplicate_keys": Entry(tm.duplicate_keys, sql.statement(sql.DUPLICATE_KEYS)),
        "duplicate_keys_broken": Entry(
            lambda m: tm.duplicate_keys(broken(m)),
            sql.statement(sql.DUPLICATE_KEYS, sql.BROKEN),
        ),
        # Checks
        "check_key_columns": Entry(tm.check_key_columns, sql.statement(sql.KEY_CHECK)),
        "check_key_columns_keyless": Entry(
            lambda m: tm.check_key_columns(perturbed.keyless_customers(m)),
            sql.statement(
                sql.KEY_CHECK,
                {
                    **sql.VIEWS,
                    "cus0": sql.VIEWS["cus"],
                    "cus": "SELECT * REPLACE (NULL::BIGINT AS customer_id) FROM cus0",
                },
            ),
        ),
        "check_date_range": Entry(
            lambda m: tm.check_date_range(m, as_of=AS_OF),
            sql.statement(sql.date_check(2015, AS_OF.isoformat())),
        ),
        "check_date_range_ahead": Entry(
            lambda m: tm.check_date_range(m, 1990, EARLY_AS_OF),
            sql.statement(sql.date_check(1990, EARLY_AS_OF.isoformat())),
        ),
        "check_row_counts": Entry(tm.check_row_counts, sql.statement(sql.SIZE_CHECK)),
        "run_validation": Entry(
            lambda m: tm.run_validation(m, as_of=AS_OF),
            sql.statement(sql.all_checks(2015, AS_OF.isoformat())),
        ),
        "run_validation_incomplete": Entry(
            lambda m: tm.run_validation(perturbed.incomplete(m), as_of=AS_OF),
            sql.statement(sql.INCOMPLETE, found=sql.all_checks(2015, AS_OF.isoformat())),
        ),
        "validation_passed": Entry(
            lambda m: tm.validation_passed(tm.run_validation(m, 1990, EARLY_AS_OF)),
            sql.statement(
                "SELECT bool_and(passed OR severity = 'warn') AS passed FROM found",
                found=sql.all_checks(1990, EARLY_AS_OF.isoformat()),
            ),
        ),
        # Reports
        "top_delayed_states": Entry(
            lambda m: report.top_delayed_states(tm.delivery_by_state(m)),
            sql.delivery(sql.TOP_STATES),
        ),
        "top_sellers": Entry(
            lambda m: report.top_sellers(tm.seller_scorecard(m)), sql.sellers(sql.TOP_SELLERS)
        ),
        "delivery_sheet": Entry(
            lambda m: report.delivery_sheet(tm.delivery_by_state(m)), sql.delivery(states)
        ),
        "abc_sheet": Entry(
            lambda m: report.abc_sheet(tm.abc_classification(m)), sql.products(classes)
        ),
        "orders_over_time_sheet": Entry(
            lambda m: report.orders_over_time_sheet(tm.orders_over_time(m)),
            sql.trend(sql.MONTH_SHEET),
        ),
        "retention_metrics": Entry(
            lambda m: report.retention_metrics(tm.cohort_retention(m)),
            sql.retention(sql.RATE_TILES),
        ),
        "product_revenue_subcent": Entry(
            lambda m: tm.product_revenue(perturbed.subcent(m)),
            sql.products(sql.PRODUCT_REVENUE, views=sql.SUBCENT),
        ),
        "product_revenue_doubles": Entry(
            lambda m: tm.product_revenue(perturbed.doubles(m)),
            sql.products(
                f"SELECT * REPLACE (revenue::DOUBLE / {sql.UNIT} AS revenue) FROM earned", views=sql.DOUBLES
            ),
        ),
        "orders_over_time_doubles": Entry(
            lambda m: tm.orders_over_time(perturbed.doubles(m)),
            sql.trend(
                f"SELECT * REPLACE (total_revenue / {sql.UNIT} AS total_revenue) FROM ({months})", views=sql.DOUBLES
            ),
        ),
        "orders_over_time_subcent": Entry(
            lambda m: tm.orders_over_time(perturbed.subcent(m)), sql.trend(months, views=sql.SUBCENT)
        ),
        "key_findings_hurried": Entry(
            lambda m: _findings(perturbed.hurried(m)), sql.findings(sql.HURRIED)
        ),
        "key_findings": Entry(_findings, sql.findings()),
        "abc_insight": Entry(
            lambda m: report.abc_insight(tm.abc_classification(m)), sql.products(sql.INSIGHT)
        ),
        # Output files, read back
        "write_detail": Entry(_written_detail, sql.sellers(card, IN_YEAR, STATE)),
        "write_summary": Entry(_written_summary, sql.products(classes, IN_YEAR)),
        "write_chart_data": Entry(_written_chart, sql.delivery(sql.TOP_STATES)),
        "write_sheets": Entry(_written_sheet, sql.trend(sql.MONTH_SHEET, IN_YEAR)),
    }


def _plain_revenue(df: DataFrame) -> DataFrame:
    return df.withColumn("revenue", F.col("revenue").cast("double"))


def _plain_sql(body: str) -> str:
    return body.replace("SELECT *", "SELECT * REPLACE (revenue::DOUBLE AS revenue)")


ENTRIES = _entries()


def queries() -> dict[str, Query]:
    return {name: entry.query for name, entry in ENTRIES.items()}


def oracle_sql() -> dict[str, str]:
    return {name: entry.check for name, entry in ENTRIES.items()}
