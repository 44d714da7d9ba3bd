"""Where the marketplace tables come from.

A :class:`Marketplace` maps table names to DataFrames. Tables load on first
use, so an analysis opens only what it reads, and the source is never written.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallymart.functions.numeric import Amounts
from tallymart.sources.schema import AMOUNTS, COLUMNS, EXPECTED_TABLES, ORDER_DAY


class MissingTable(LookupError):
    """A table the analysis needs is not in the source, or cannot be read there."""


Loader = Callable[[], DataFrame | None]


class Marketplace:
    """Read-only access to the marketplace tables.

    A loader returns the table, or ``None`` when the source does not have it.
    """

    def __init__(self, spark: SparkSession, loaders: Mapping[str, Loader]):
        self.spark = spark
        self._loaders = dict(loaders)
        self._frames: dict[str, DataFrame | None] = {}
        self._amounts: dict[str, Amounts] = {}
        self._unreadable: dict[str, str] = {}

    @classmethod
    def from_frames(cls, spark: SparkSession, frames: Mapping[str, DataFrame]) -> Marketplace:
        """Use DataFrames that are already at hand (views, other formats)."""
        return cls(spark, {name: (lambda df=df: df) for name, df in frames.items()})

    @classmethod
    def from_folder(cls, spark: SparkSession, root: str) -> Marketplace:
        """One Parquet dataset per table: ``<root>/<table>`` or ``<root>/<table>.parquet``.

        Raises ``FileNotFoundError`` when the folder holds none of the tables.
        The files of a table are listed only when it is used.
        """

        def loader(name: str) -> Loader:
            paths = (f"{root}/{name}", f"{root}/{name}.parquet")
            return lambda: _read_if_present(spark, paths)

        market = cls(spark, {name: loader(name) for name in EXPECTED_TABLES})
        if not any(market.has(name) for name in EXPECTED_TABLES):
            raise FileNotFoundError(f"no marketplace tables found under {root}")
        return market

    @classmethod
    def from_database(cls, spark: SparkSession, database: str) -> Marketplace:
        """Tables of a catalog database (Hive, Iceberg, Delta and so on)."""
        if not spark.catalog.databaseExists(database):
            raise FileNotFoundError(f"database not found: {database}")

        def loader(name: str) -> Loader:
            full = f"{database}.{name}"
            return lambda: spark.table(full) if spark.catalog.tableExists(full) else None

        return cls(spark, {name: loader(name) for name in EXPECTED_TABLES})

    def laid_out_by_day(self, **columns: str) -> Marketplace:
        """Same source, whose orders, or orders and items, are partitioned by the order's purchase day.

        Names the partition column of each such table: ``laid_out_by_day(orders="day",
        order_items="day")``. It holds the calendar day of the order's purchase time
        (none where that is missing), as a date or as text in YYYY-MM-DD form. An
        analysis of a period then opens only the folders of its days.
        """
        if unknown := set(columns) - {t for t, known in COLUMNS.items() if ORDER_DAY in known}:
            raise ValueError(f"no tables with a layout by day: {sorted(unknown)}")

        def named(load: Loader, column: str) -> Loader:
            def loaded() -> DataFrame | None:
                df = load()
                return None if df is None else df.select("*", F.col(column).alias(ORDER_DAY))

            return loaded

        loaders = {n: named(load, columns[n]) if n in columns else load for n, load in self._loaders.items()}
        return Marketplace(self.spark, loaders)

    def replace(self, **frames: DataFrame) -> Marketplace:
        """Same source with some tables swapped."""
        loaders = {**self._loaders, **{n: (lambda df=df: df) for n, df in frames.items()}}
        return Marketplace(self.spark, loaders)

    def without(self, *names: str) -> Marketplace:
        """Same source with some tables hidden."""
        return Marketplace(
            self.spark, {n: load for n, load in self._loaders.items() if n not in names}
        )

    def has(self, name: str) -> bool:
        """Whether the table is there and can be opened."""
        return self._find(name) is not None

    def table(self, name: str) -> DataFrame:
        df = self._find(name)
        if df is None:
            raise MissingTable(f"table not found: {name}{self._unreadable.get(name, '')}")
        return df

    def amounts(self, name: str) -> Amounts:
        """How the amounts of a table (prices, review scores) are summed."""
        self.table(name)
        return self._amounts[name]

    def _find(self, name: str) -> DataFrame | None:
        if name not in self._frames:
            try:
                df = self._loaders[name]() if name in self._loaders else None
                self._amounts[name] = _amounts_of(name, df)
                self._frames[name] = None if df is None else conform(name, df, self._amounts[name])
            except AnalysisException as error:
                self._frames[name] = None
                self._unreadable[name] = f" (it cannot be read: {error.getCondition()})"
        return self._frames[name]


def _amounts_of(name: str, df: DataFrame | None) -> Amounts:
    for column in AMOUNTS.get(name, ()):
        if df is not None and column in df.columns:
            return Amounts.of(df, column)
    return Amounts(0)


def conform(name: str, df: DataFrame, amounts: Amounts) -> DataFrame:
    """Keep the canonical columns that a table has, cast where the type differs.

    A column that is missing is missed only by what reads it.

    A column that already has the right type is passed through untouched, so
    filters on it still reach the Parquet reader. Prices and scores also come as
    the units in which they are summed, one column for each part of the sum.
    """
    wanted = COLUMNS.get(name)
    if wanted is None:
        return df
    actual = dict(df.dtypes)
    columns = [
        F.col(c) if kind is None or actual.get(c) == kind else F.col(c).cast(kind).alias(c)
        for c, kind in wanted.items()
        if c in actual
    ]
    for column, units in AMOUNTS.get(name, {}).items():
        if column in actual:
            parts = zip(amounts.units(F.col(column)), amounts.names(units), strict=True)
            columns += [part.alias(name) for part, name in parts]
    return df.select(*columns)


def _read_if_present(spark: SparkSession, paths: tuple[str, ...]) -> DataFrame | None:
    for path in paths:
        try:
            return spark.read.parquet(path)
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
    return None
