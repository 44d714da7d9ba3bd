"""The full run: checks, five analyses, output files."""

from __future__ import annotations

import datetime as dt
import logging
from collections.abc import Callable
from dataclasses import dataclass, field, replace

from py4j.protocol import Py4JError
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame

from tallymart.functions.period import Period
from tallymart.operators.checks import run_validation, validation_passed
from tallymart.operators.delivery import delivery_by_state
from tallymart.operators.products import abc_classification
from tallymart.operators.retention import cohort_retention
from tallymart.operators.sellers import ranked_sellers, sold_items
from tallymart.operators.trends import orders_over_time
from tallymart.plans import editions, publish, report
from tallymart.sources.marketplace import Marketplace, MissingTable
from tallymart.sources.schema import EARLIEST_YEAR
from tallymart.sources.scratch import materialise, released

log = logging.getLogger(__name__)

ANALYSIS_ERRORS = (PySparkException, Py4JError, MissingTable)


@dataclass(frozen=True)
class Settings:
    """What a run is asked for. Dates are YYYY-MM-DD text, dates or ``None``.

    ``editions``: how many runs the target keeps, each in a folder of its own and
    made visible as a whole (``current_edition``). ``None`` writes to fixed names
    and overwrites them one by one.
    """

    out: str
    start: str | dt.date | None = None
    end: str | dt.date | None = None
    seller_state: str | None = None
    min_year: int = EARLIEST_YEAR
    as_of: dt.date | None = None
    editions: int | None = None


@dataclass
class Outcome:
    """What a run did: check result, files by name, errors by analysis, number of its edition if any."""

    checks_passed: bool
    files: dict[str, str] = field(default_factory=dict)
    errors: dict[str, str] = field(default_factory=dict)
    edition: int | None = None


def run(market: Marketplace, settings: Settings) -> Outcome:
    """Check, analyse and publish.

    A malformed date, or no edition to keep, raises ``ValueError`` before any job starts. Failed
    checks and failed analyses are reported and do not stop the others; an
    output is left out when an analysis it needs has failed. Intermediate tables
    are deleted at the end.
    """
    period = Period.of(settings.start, settings.end)
    if settings.editions is not None and settings.editions < 1:
        raise ValueError(f"at least one edition must be kept, not {settings.editions}")
    with released(market.spark):
        if settings.editions is None:
            return _run(market, settings, period)
        own = replace(settings, out=editions.new_folder(settings.out))
        outcome = _run(market, own, period)
        outcome.edition = editions.publish_edition(
            market.spark, settings.out, own.out, outcome.files, outcome.errors, settings.editions
        ).number
        return outcome


def _run(market: Marketplace, settings: Settings, period: Period) -> Outcome:
    outcome = Outcome(checks_passed=False)
    checks = None
    try:
        checks = materialise(run_validation(market, settings.min_year, settings.as_of))
        outcome.checks_passed = bool(validation_passed(checks).head().passed)
    except ANALYSIS_ERRORS as error:
        log.error("the checks failed: %s", error)
        outcome.errors["checks"] = str(error)
    if not outcome.checks_passed:
        log.warning("some checks failed; treat the outputs with caution")

    sold = _sold(market, period)
    results: dict[str, DataFrame] = {}
    analyses: dict[str, Callable[[], DataFrame]] = {
        "scorecard": lambda: ranked_sellers(market, period, settings.seller_state, sold),
        "classes": lambda: abc_classification(market, period, sold),
        "delivery": lambda: delivery_by_state(market, period),
        "months": lambda: orders_over_time(market, period, sold),
        "retention": lambda: cohort_retention(market, period),
    }
    for name, build in analyses.items():
        try:
            results[name] = materialise(build())
        except ANALYSIS_ERRORS as error:
            log.error("%s failed: %s", name, error)
            outcome.errors[name] = str(error)

    if checks is not None:
        outcome.files["checks"] = publish.write_sheets({"checks": checks}, settings.out)["checks"]
    if "classes" in results:
        outcome.files["summary"] = publish.write_summary(
            results["classes"].orderBy("abc_class"), settings.out
        )
    if "scorecard" in results:
        ordered = results["scorecard"].orderBy("composite_score", "seller_id")
        outcome.files["detail"] = publish.write_detail(ordered, settings.out)
    if "delivery" in results:
        outcome.files["chart"] = publish.write_chart_data(
            report.top_delayed_states(results["delivery"]), settings.out
        )
    outcome.files.update(publish.write_sheets(_sheets(results), settings.out))
    # Files of an earlier run stay where an analysis failed: this table says which belong to this run.
    renewed = [(name, path, None) for name, path in outcome.files.items()]
    failed = [(name, None, error) for name, error in outcome.errors.items()]
    outputs = market.spark.createDataFrame(renewed + failed, "name string, path string, error string")
    outcome.files["outputs"] = publish.write_sheets({"outputs": outputs}, settings.out)["outputs"]
    return outcome


def _sold(market: Marketplace, period: Period) -> DataFrame | None:
    """Items with the facts of their order, joined once for three analyses.

    Where that cannot be made, because one of them lacks a table or column,
    each reads the source for itself and those that can succeed do.
    """
    try:
        return sold_items(market, period)
    except ANALYSIS_ERRORS as error:
        log.warning("items and orders are joined by each analysis: %s", error)
        return None


def _sheets(results: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """The report tables whose inputs are at hand."""
    plans = {
        "retention_metrics": (("retention",), report.retention_metrics),
        "key_findings": (("scorecard", "delivery", "classes", "retention"), report.key_findings),
        "seller_scorecard": (("scorecard",), report.top_sellers),
        "delivery_analysis": (("delivery",), report.delivery_sheet),
        "abc_classification": (("classes",), report.abc_sheet),
        "abc_insight": (("classes",), report.abc_insight),
        "orders_over_time": (("months",), report.orders_over_time_sheet),
    }
    return {
        name: build(*[results[n] for n in needs])
        for name, (needs, build) in plans.items()
        if all(n in results for n in needs)
    }
