"""Distributed ranks and running totals against the plain global window."""

from __future__ import annotations

import random
from bisect import bisect_left
from decimal import Decimal

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import Window
from pyspark.sql import functions as F

from tallymart.operators import ranking
from tallymart.operators.ranking import (
    composite_rank,
    cumulative_share_classify,
    global_rank,
    running_share,
)
from tests.small import rows


@pytest.fixture
def many_pieces(spark):
    """Keep small shuffles apart, so that several pieces are in play."""
    key = "spark.sql.adaptive.coalescePartitions.enabled"
    spark.conf.set(key, "false")
    yield
    spark.conf.unset(key)


def _plain_rank(df, column, direction):
    order = F.col(column).desc_nulls_last() if direction == "desc" else F.col(column).asc_nulls_last()
    return df.withColumn("r", F.rank().over(Window.orderBy(order)).cast("bigint"))


def _same(left, right):
    return sorted(rows(left), key=repr) == sorted(rows(right), key=repr)


def test_rows_equal_in_every_column_do_not_meet(spark):
    df = spark.range(30_000).selectExpr("cast(7 as double) as v")
    ranked = global_rank(df, [("v", "desc", "r")])
    assert ranked.groupBy("r").count().collect() == [(1, 30_000)]
    largest = ranked.groupBy(F.spark_partition_id()).count().agg(F.max("count"))
    with_aqe = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        assert largest.head()[0] < 30_000 / 2
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", with_aqe)


VALUES = {
    "distinct": "cast(id as double)",
    "eleven values": "cast(id % 11 as double)",
    "a third alike": "case when id % 3 = 0 then 500.0D else cast(id as double) end",
    "all alike": "7.0D",
    "some missing": "case when id % 9 <> 0 then cast(id % 100 as double) end",
    "all missing": "cast(null as double)",
    "long": "id % 400",
    "decimal": "cast(id % 300 as decimal(12,2)) / 4",
}


@pytest.mark.parametrize("direction", ["asc", "desc"])
@pytest.mark.parametrize("values", VALUES)
@pytest.mark.parametrize("size", [0, 1, 2_000])
def test_rank_equals_plain_window(spark, values, direction, size):
    df = spark.range(size).selectExpr("id", f"{VALUES[values]} as v")
    assert _same(global_rank(df, [("v", direction, "r")]), _plain_rank(df, "v", direction))


@pytest.mark.parametrize("hot", ["500.0D", "cast(null as double)"])
def test_rank_spreads_a_hot_value(spark, hot):
    """No window group holds much more than a fair share of the rows."""
    df = spark.range(30_000).selectExpr(
        f"case when id % 3 = 0 then {hot} else cast(id as double) end as v", "id as _row"
    )
    count = ranking._cut_count(df)
    cuts = ranking._cut_points(df, ["v"], count)["v"]
    piece = ranking._piece(F.col("v"), "desc", cuts, "double")
    spread = F.pmod(F.xxhash64("_row"), F.lit(2 * count))
    groups = df.groupBy(piece.alias("p"), F.when(piece % 2 == 1, spread).alias("g")).count()
    assert groups.agg(F.max("count")).head()[0] < 30_000 / count * 2


def test_rank_needs_a_direction(spark):
    with pytest.raises(ValueError, match="direction"):
        global_rank(spark.range(2), [("id", "up", "r")])


def test_composite_averages_the_ranks(spark):
    df = spark.createDataFrame([("a", 3, 1), ("b", 3, 2), ("c", 1, 2)], "k string, x int, y int")
    found = composite_rank(df, [("x", "desc", "rx"), ("y", "asc", "ry")], "score", 1)
    assert sorted(rows(found)) == [
        ("a", 3, 1, 1, 1, 1.0),
        ("b", 3, 2, 1, 2, 1.5),
        ("c", 1, 2, 3, 2, 2.5),
    ]


SUMS = {
    "distinct": "cast(id as decimal(12,2))",
    "a third alike": "cast(case when id % 3 = 0 then 500 else id end as decimal(12,2))",
    "all alike": "cast(7 as decimal(12,2))",
    "some missing": "case when id % 9 <> 0 then cast(id % 100 as decimal(12,2)) end",
    "all missing": "cast(null as decimal(12,2))",
    "long": "id % 400",
}


@pytest.mark.parametrize("values", SUMS)
@pytest.mark.parametrize("size", [0, 1, 2_000])
def test_running_total_equals_plain_window(spark, many_pieces, values, size):
    df = spark.range(size).selectExpr("id", f"{SUMS[values]} as v")
    order = Window.orderBy(F.col("v").desc_nulls_last(), "id")
    plain = df.select(
        "id",
        "v",
        F.sum("v").over(Window.partitionBy()).alias("t"),
        F.sum("v").over(order.rowsBetween(Window.unboundedPreceding, 0)).alias("r"),
    )
    found = running_share(df, "v", ["id"], "r", "t").select("id", "v", "t", "r")
    assert _same(found, plain)


def test_a_hot_value_falls_in_several_pieces(spark, many_pieces):
    df = spark.range(8_000).selectExpr("id", "cast(5 as decimal(12,2)) as v")
    pieces = df.repartitionByRange(F.col("v").desc(), "id").groupBy(F.spark_partition_id()).count()
    assert pieces.count() > 4


@settings(
    max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture]
)
@given(
    st.lists(
        st.decimals(min_value=0, max_value=1000, places=2), min_size=1, max_size=40
    )
)
def test_classes_follow_the_definition(spark, prices):
    data = [(f"p{i:02}", price) for i, price in enumerate(prices)]
    df = spark.createDataFrame(data, "k string, v decimal(12,2)")
    found = {r.k: r.abc_class for r in cumulative_share_classify(df, "v", ["k"]).collect()}
    total, so_far, expected = sum(prices), Decimal(0), {}
    for key, price in sorted(data, key=lambda kv: (-kv[1], kv[0])):
        so_far += price
        share = float(so_far) / float(total) if total else 2.0
        expected[key] = "A" if share <= 0.8 else "B" if share <= 0.95 else "C"
    assert found == expected


def test_other_cuts(spark):
    df = spark.createDataFrame([("a", 60.0), ("b", 30.0), ("c", 10.0)], "k string, v double")
    found = cumulative_share_classify(df, "v", ["k"], [("top", 0.6)], "rest")
    assert {r.k: r.abc_class for r in found.collect()} == {"a": "top", "b": "rest", "c": "rest"}


@pytest.mark.parametrize("count", [1, 2, 3, 7, 8, 100, 2047])
@pytest.mark.parametrize("direction", ["asc", "desc"])
def test_pieces_are_found_by_halving(spark, count, direction):
    rng = random.Random(count)
    points = sorted(rng.sample(range(-5 * count, 5 * count), count))
    values = [*points, *(p + 0.5 for p in points), points[0] - 1.0, points[-1] + 1.0, float("nan"), float("inf")]
    df = spark.createDataFrame([(float(v),) for v in values], "v double")
    piece = ranking._piece(F.col("v"), direction, [float(p) for p in points], "double")

    def expected(value):
        below = count if value != value else bisect_left(points, value)
        here = value in points
        passed = below if direction == "asc" else count - below - here
        return 2 * passed + here

    found = df.select("v", piece.alias("p")).collect()
    assert [r["p"] for r in found] == [expected(r["v"]) for r in found]
    # One step for each binary digit of the number of cut points, and no look at all of them.
    plan = df.select(piece.alias("p"))._jdf.queryExecution().optimizedPlan().toString()
    steps = count.bit_length()
    assert "filter(" not in plan and "array_contains" not in plan
    assert f"[{','.join(str(1 << b) for b in reversed(range(steps)))}]" in plan.replace(" ", "")
