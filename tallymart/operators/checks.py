"""Pre-flight checks: they report, they never stop a run.

Every check gives one row per item. A row with severity ``warn`` does not
count against the overall result.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallymart.functions.dates import day
from tallymart.sources.marketplace import Marketplace
from tallymart.sources.schema import (
    EARLIEST_YEAR,
    EXPECTED_TABLES,
    KEY_COLUMNS,
    MINIMUM_ROWS,
)

DATED_TABLE, DATED_COLUMN = "orders", "order_purchase_timestamp"


def check_tables_exist(
    market: Marketplace, expected: Sequence[str] = EXPECTED_TABLES
) -> DataFrame:
    """Every expected table is in the source."""
    names = market.spark.createDataFrame(
        [(t, market.has(t)) for t in expected], "table_name string, present boolean"
    )
    return names.select(
        *_row(
            check=F.lit("tables_exist"),
            item=F.col("table_name"),
            observed=F.when(F.col("present"), F.lit("present")).otherwise(F.lit("missing")),
            expected=F.lit("present"),
            passed=F.col("present"),
        )
    )


def check_key_columns(market: Marketplace, keys: Mapping[str, str] = KEY_COLUMNS) -> DataFrame:
    """Each key column has at least one value; a missing table fails."""
    return _report(_observe(market, keys, keys=keys), [_key_check(keys)])


def check_date_range(
    market: Marketplace, min_year: int = EARLIEST_YEAR, as_of: dt.date | None = None
) -> DataFrame:
    """Order dates exist and do not start too early (fail) or lie ahead of ``as_of`` (warn)."""
    return _report(
        _observe(market, [DATED_TABLE], dated=True), _date_checks(min_year, as_of or dt.date.today())
    )


def check_row_counts(
    market: Marketplace, minimums: Mapping[str, int] = MINIMUM_ROWS
) -> DataFrame:
    """Core tables reach their minimum size; a missing table fails."""
    return _report(_observe(market, minimums), [_size_check(minimums)])


def run_validation(
    market: Marketplace,
    min_year: int = EARLIEST_YEAR,
    as_of: dt.date | None = None,
    minimums: Mapping[str, int] = MINIMUM_ROWS,
) -> DataFrame:
    """All four checks, reading each table once whatever the others find."""
    tables = list(dict.fromkeys([*KEY_COLUMNS, *minimums, DATED_TABLE]))
    seen = _observe(market, tables, keys=KEY_COLUMNS, dated=True)
    measured = _report(
        seen,
        [
            _key_check(KEY_COLUMNS),
            *_date_checks(min_year, as_of or dt.date.today()),
            _size_check(minimums),
        ],
    )
    return check_tables_exist(market).unionByName(measured)


def validation_passed(checks: DataFrame) -> DataFrame:
    """One row: did every check pass, warnings aside."""
    return checks.agg(
        F.bool_and(F.col("passed") | (F.col("severity") == "warn")).alias("passed")
    )


def _observe(
    market: Marketplace,
    tables: Sequence[str],
    keys: Mapping[str, str] | None = None,
    dated: bool = False,
) -> DataFrame:
    """One row of figures per table, from one aggregate each; all missing if it is absent."""
    keys = keys or {}

    def figures(table: str) -> DataFrame:
        name = F.lit(table).alias("table_name")
        unknown = F.lit(None)
        if not market.has(table):
            return market.spark.range(0, 1, 1, 1).select(
                name,
                unknown.cast("bigint").alias("row_count"),
                unknown.cast("bigint").alias("key_count"),
                unknown.cast("date").alias("first_day"),
                unknown.cast("date").alias("last_day"),
            )
        rows = market.table(table)
        # A missing column gives no figure, and so a failed check.
        keyed = keys.get(table) in rows.columns
        key = F.count(keys[table]) if keyed else F.max(unknown.cast("bigint"))
        timed = dated and table == DATED_TABLE and DATED_COLUMN in rows.columns
        when = day(F.col(DATED_COLUMN)) if timed else unknown.cast("date")
        return (
            rows.agg(
                F.count(F.lit(1)).alias("row_count"),
                key.alias("key_count"),
                F.min(when).alias("first_day"),
                F.max(when).alias("last_day"),
            )
            .select(name, "*")
        )

    return reduce(DataFrame.unionByName, [figures(t) for t in tables])


def _report(seen: DataFrame, checks: Sequence[tuple[Column, Column]]) -> DataFrame:
    """Turn figures into check rows: ``checks`` pairs a condition with a row."""
    rows = F.array(*[F.when(applies, row) for applies, row in checks])
    return (
        seen.select(F.explode(rows).alias("row")).filter(F.col("row").isNotNull()).select("row.*")
    )


def _row(check, item, observed, expected, passed, severity="fail") -> list[Column]:
    return [
        check.alias("check"),
        item.alias("item"),
        F.coalesce(observed.cast("string"), F.lit("none")).alias("observed"),
        expected.cast("string").alias("expected"),
        F.coalesce(passed, F.lit(False)).alias("passed"),
        F.lit(severity).alias("severity"),
    ]


def _key_check(keys: Mapping[str, str]) -> tuple[Column, Column]:
    column = reduce(
        lambda rest, kv: F.when(F.col("table_name") == kv[0], F.lit(f"{kv[0]}.{kv[1]}")).otherwise(
            rest
        ),
        keys.items(),
        F.lit(None).cast("string"),
    )
    row = F.struct(
        *_row(
            check=F.lit("key_columns"),
            item=column,
            observed=F.col("key_count"),
            expected=F.lit(">= 1"),
            passed=F.col("key_count") > 0,
        )
    )
    return F.col("table_name").isin(list(keys)), row


def _size_check(minimums: Mapping[str, int]) -> tuple[Column, Column]:
    least = reduce(
        lambda rest, kv: F.when(F.col("table_name") == kv[0], F.lit(kv[1])).otherwise(rest),
        minimums.items(),
        F.lit(None).cast("int"),
    )
    row = F.struct(
        *_row(
            check=F.lit("row_counts"),
            item=F.col("table_name"),
            observed=F.col("row_count"),
            expected=F.concat(F.lit(">= "), least.cast("string")),
            passed=F.col("row_count") >= least,
        )
    )
    return F.col("table_name").isin(list(minimums)), row


def _date_checks(min_year: int, as_of: dt.date) -> list[tuple[Column, Column]]:
    column = F.lit(f"{DATED_TABLE}.{DATED_COLUMN}")
    here = F.col("table_name") == DATED_TABLE
    filled = here & F.col("first_day").isNotNull()

    def rule(name, observed, expected, passed, severity="fail") -> Column:
        return F.struct(*_row(F.lit(name), column, observed, expected, passed, severity))

    return [
        (
            here,
            rule(
                "dates_present",
                F.col("first_day"),
                F.lit("any date"),
                F.col("first_day").isNotNull(),
            ),
        ),
        (
            filled,
            rule(
                "dates_not_ahead",
                F.col("last_day"),
                F.lit(f"<= {as_of.isoformat()}"),
                F.col("last_day") <= F.lit(as_of),
                "warn",
            ),
        ),
        (
            filled,
            rule(
                "dates_not_too_early",
                F.col("first_day"),
                F.lit(f"year >= {min_year}"),
                F.year("first_day") >= min_year,
            ),
        ),
    ]
