"""Marketplace analytics on Spark."""

from tallymart.functions.period import Period, parse_day
from tallymart.operators.checks import (
    check_date_range,
    check_key_columns,
    check_row_counts,
    check_tables_exist,
    run_validation,
    validation_passed,
)
from tallymart.operators.delivery import delivery_by_state, delivery_times
from tallymart.operators.products import abc_classification, product_classes, product_revenue
from tallymart.operators.quality import (
    date_gaps,
    duplicate_keys,
    missing_days,
    null_profile,
    orphan_keys,
    row_counts,
)
from tallymart.operators.ranking import (
    composite_rank,
    cumulative_share_classify,
    global_rank,
    running_share,
)
from tallymart.operators.retention import (
    cohort_retention,
    days_since_first,
    first_purchase,
    retention_flags,
)
from tallymart.operators.sellers import (
    seller_base,
    seller_cancellations,
    seller_metrics,
    seller_on_time,
    seller_revenue,
    seller_reviews,
    seller_scorecard,
    sold_items,
)
from tallymart.operators.trends import orders_over_time
from tallymart.plans.editions import Edition, current_edition
from tallymart.plans.run import Outcome, Settings, run
from tallymart.sources.marketplace import Marketplace, MissingTable

__all__ = [
    "Edition",
    "Marketplace",
    "MissingTable",
    "Outcome",
    "Period",
    "Settings",
    "abc_classification",
    "check_date_range",
    "check_key_columns",
    "check_row_counts",
    "check_tables_exist",
    "cohort_retention",
    "composite_rank",
    "cumulative_share_classify",
    "current_edition",
    "date_gaps",
    "days_since_first",
    "delivery_by_state",
    "delivery_times",
    "duplicate_keys",
    "first_purchase",
    "global_rank",
    "missing_days",
    "null_profile",
    "orders_over_time",
    "orphan_keys",
    "parse_day",
    "product_classes",
    "product_revenue",
    "retention_flags",
    "row_counts",
    "run",
    "run_validation",
    "running_share",
    "seller_base",
    "seller_cancellations",
    "seller_metrics",
    "seller_on_time",
    "seller_revenue",
    "seller_reviews",
    "seller_scorecard",
    "sold_items",
    "validation_passed",
]
