"""Global ranks and running shares without a single-task sort.

A window without PARTITION BY moves every row to one task. Both operators
here split the value range first and add what lies before each piece, which
gives the same result with bounded pieces, also when one value is shared by
a large part of the rows.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from itertools import accumulate

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallymart.functions.numeric import round_away
from tallymart.sources.scratch import materialise

# Values are cut into as many pieces as the session has shuffle partitions, within
# these bounds; a piece between two cut points holds about one share of the rows.
FEWEST_CUTS, MOST_CUTS = 128, 2_048
# Quantiles are this many times finer than the cuts.
FINENESS = 16


def composite_rank(
    df: DataFrame,
    ranks: Sequence[tuple[str, str, str]],
    score: str = "composite_score",
    digits: int = 1,
) -> DataFrame:
    """Rank rows on several columns and average the ranks.

    ``ranks`` lists ``(column, "asc" | "desc", rank name)``. Ties share a rank
    and leave a gap after them; missing values share the last rank in both
    directions.
    """
    ranked = global_rank(df, ranks)
    names = [name for _, _, name in ranks]
    total = reduce(Column.__add__, [F.col(n) for n in names])
    return ranked.withColumn(score, round_away(total / F.lit(float(len(names))), digits))


def global_rank(df: DataFrame, ranks: Sequence[tuple[str, str, str]]) -> DataFrame:
    """``RANK()`` over the whole frame, for each ``(numeric column, direction, name)``.

    The input is written once with a number for each row: it is read for the
    cut points, the piece sizes and the ranks. Only the cut points and the rows
    ahead of each piece, at most ``2 * MOST_CUTS`` numbers per rank, come to the
    driver. Rows that tie at a cut point are dealt out by their number, so even
    rows that are equal in every column never meet in one task.
    """
    # Stored numbers stay the same when a task is run again.
    stored = materialise(df.withColumn("_row", F.monotonically_increasing_id()))
    cut_count = _cut_count(df)
    cut_points = _cut_points(stored, [column for column, _, _ in ranks], cut_count)
    kinds = dict(df.dtypes)
    pieces = [_piece(F.col(c), d, cut_points[c], kinds[c]) for c, d, _ in ranks]
    ahead = _rows_ahead(stored, pieces, [2 * len(cut_points[c]) + 2 for c, _, _ in ranks])
    piece_names = [f"_piece_{name}" for _, _, name in ranks]
    placed = stored.select(
        *df.columns,
        *[piece.alias(p) for piece, p in zip(pieces, piece_names)],
        F.pmod(F.xxhash64("_row"), F.lit(2 * cut_count)).alias("_spread"),
    )
    columns = []
    for (column, direction, name), p, rows in zip(ranks, piece_names, ahead):
        # Rows of an odd piece all tie: the first rank of any group of them is theirs.
        group = F.when(F.col(p) % 2 == 1, F.col("_spread"))
        window = Window.partitionBy(p, group).orderBy(_ordering(column, direction))
        before = F.get(_constants(rows, "bigint"), F.col(p))
        columns.append((before + F.rank().over(window)).cast("bigint").alias(name))
    return placed.select(*df.columns, *columns)


def running_share(
    df: DataFrame, value: str, keys: Sequence[str], running: str, total: str
) -> DataFrame:
    """Add the running total from the largest value down, and the grand total.

    ``keys`` break ties, so together with ``value`` they should identify a
    row. The range shuffle cuts on value and keys together: rows that share a
    value still spread over pieces. The stored piece number fixes the cut.
    """
    order = [F.col(value).desc_nulls_last(), *[F.col(k).asc_nulls_last() for k in keys]]
    stored = materialise(
        df.repartitionByRange(*order).withColumn("_piece", F.spark_partition_id())
    )
    # At most one row per shuffle partition.
    sums = stored.groupBy("_piece").agg(F.sum(value).alias("_sum"))
    earlier = Window.orderBy("_piece").rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.orderBy("_piece").rowsBetween(
        Window.unboundedPreceding, Window.unboundedFollowing
    )
    offsets = sums.select(
        "_piece",
        F.sum("_sum").over(earlier).alias("_before"),
        F.sum("_sum").over(everything).alias(total),
    )
    inside = (
        Window.partitionBy("_piece")
        .orderBy(*order)
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    kind = df.schema[value].dataType
    zero = F.lit(0).cast(kind)
    sum_inside = F.sum(value).over(inside)
    return (
        stored.withColumn("_inside", sum_inside)
        .join(F.broadcast(offsets), "_piece")
        .withColumn(
            running,
            F.when(
                F.col("_before").isNotNull() | F.col("_inside").isNotNull(),
                F.coalesce("_before", zero) + F.coalesce("_inside", zero),
            ),
        )
        .drop("_piece", "_inside", "_before")
    )


def cumulative_share_classify(
    df: DataFrame,
    value: str,
    keys: Sequence[str],
    cuts: Sequence[tuple[str, float]] = (("A", 0.80), ("B", 0.95)),
    rest: str = "C",
) -> DataFrame:
    """Pareto classes: share, running share and class of every row.

    A row belongs to the first class whose bound its running share does not
    exceed, so the row that crosses a bound falls in the next class. Shares
    are percentages rounded to four digits; a zero total gives missing shares
    and the last class.
    """
    shared = running_share(df, value, keys, "_running", "_total")
    total = F.col("_total").cast("double")
    share = F.try_divide(F.col(value).cast("double"), total)
    running = F.try_divide(F.col("_running").cast("double"), total)
    label = reduce(
        lambda otherwise, cut: F.when(running <= F.lit(cut[1]), F.lit(cut[0])).otherwise(otherwise),
        reversed(list(cuts)),
        F.lit(rest),
    )
    return shared.select(
        *df.columns,
        round_away(share * 100, 4).alias("pct_of_revenue"),
        round_away(running * 100, 4).alias("cumulative_pct"),
        label.alias("abc_class"),
    )


def _ordering(column: str, direction: str) -> Column:
    if direction == "desc":
        return F.col(column).desc_nulls_last()
    if direction == "asc":
        return F.col(column).asc_nulls_last()
    raise ValueError(f"direction must be asc or desc, got {direction!r}")


def _cut_count(df: DataFrame) -> int:
    session = df.sparkSession.conf
    asked = session.get("spark.sql.adaptive.coalescePartitions.initialPartitionNum", None)
    partitions = int(asked or session.get("spark.sql.shuffle.partitions"))
    return min(max(partitions, FEWEST_CUTS), MOST_CUTS)


def _cut_points(df: DataFrame, columns: Sequence[str], cut_count: int) -> dict[str, list]:
    """Approximate quantiles of each column: fewer than ``cut_count`` numbers per column.

    They only steer how evenly rows spread. A value shared by more than
    roughly ``2 / cut_count`` of the rows is always one of them.
    """
    quantiles = _constants([i / cut_count for i in range(1, cut_count)], "double")
    wanted = list(dict.fromkeys(columns))
    found = df.select(
        *[F.percentile_approx(c, quantiles, FINENESS * cut_count).alias(c) for c in wanted]
    ).head()
    return {c: sorted(set(found[c] or [])) for c in wanted}


def _piece(value: Column, direction: str, cut_points: Sequence, kind: str) -> Column:
    """Position of a value among the cut points, in rank order.

    Even numbers are the open ranges between cut points. Odd numbers hold rows
    that tie: the cut values themselves and, last, the missing values.
    """
    count = len(cut_points)
    last = F.lit(2 * count + 1)
    if count == 0:
        return F.when(value.isNull(), last).otherwise(F.lit(0))
    points = _constants(cut_points, kind)
    below, here = _search(points, count, value)
    # Cut points are in ascending order; a descending rank counts those above.
    passed = below if direction == "asc" else F.lit(count) - below - here
    return F.when(value.isNull(), last).otherwise(passed * 2 + here)


def _search(points: Column, count: int, value: Column) -> tuple[Column, Column]:
    """How many of the ascending points lie below the value, and 1 where one equals it.

    Halves the range of candidates until one is left: as many comparisons as
    ``count`` has binary digits. NaN lies above all numbers, as it sorts.
    """
    steps = [1 << bit for bit in reversed(range(count.bit_length()))]

    def halved(state: Column, step: Column) -> Column:
        further = state + step
        # The array gives NULL beyond its end, which is not below anything.
        return F.when(F.get(points, further - 1) < value, further).otherwise(state)

    below = F.aggregate(F.array(*[F.lit(step) for step in steps]), F.lit(0), halved)
    return below, F.coalesce(F.get(points, below) == value, F.lit(False)).cast("int")


def _rows_ahead(
    df: DataFrame, pieces: Sequence[Column], piece_counts: Sequence[int]
) -> list[list[int]]:
    """Rows ahead of each piece, for all ranks in one pass over ``df``."""
    tagged = F.array(
        *[
            F.struct(F.lit(number).alias("rank"), piece.alias("piece"))
            for number, piece in enumerate(pieces)
        ]
    )
    sizes = [[0] * n for n in piece_counts]
    counted = df.select(F.explode(tagged).alias("p")).groupBy("p.rank", "p.piece").count()
    for rank, piece, rows in counted.collect():
        sizes[rank][piece] = rows
    return [list(accumulate(n[:-1], initial=0)) for n in sizes]


def _constants(values: Sequence, kind: str) -> Column:
    """A constant array, sent as one text that the optimizer folds into a literal."""
    return F.split(F.lit(",".join(map(str, values))), ",").cast(f"array<{kind}>")
