"""Sources, report tables and the full run with its output files."""

from __future__ import annotations

import datetime as dt
import math
import random

import pytest
from pyspark.sql import functions as F

import tallymart as tm
from catalogue.star import star_market
from tallymart import Marketplace, MissingTable, Settings
from tallymart.__main__ import main
from tallymart.functions.numeric import Amounts
from tallymart.plans import report
from tallymart.sources import scratch
from tests.small import SCHEMAS, by_key, item, market, order, rows

FIVE = ("scorecard", "classes", "delivery", "months", "retention")


@pytest.fixture
def star(spark, sf_dir):
    return star_market(spark, sf_dir)


# --- sources ---------------------------------------------------------------


def test_folder_source_finds_tables_with_and_without_suffix(spark, tmp_path):
    m = market(spark, orders=[order("a", bought="2020-01-01")], order_items=[item("a")])
    m.table("orders").write.parquet(str(tmp_path / "orders"))
    m.table("order_items").write.parquet(str(tmp_path / "order_items.parquet"))
    found = Marketplace.from_folder(spark, str(tmp_path))
    assert found.has("orders") and found.has("order_items") and not found.has("sellers")
    assert rows(tm.orders_over_time(found)) == [(dt.date(2020, 1, 1), 1, 1.0)]
    with pytest.raises(MissingTable, match="sellers"):
        tm.seller_base(found)


def test_missing_folder_is_an_error(spark, tmp_path):
    with pytest.raises(FileNotFoundError, match="nowhere"):
        Marketplace.from_folder(spark, str(tmp_path / "nowhere"))


def test_database_source(spark):
    with pytest.raises(FileNotFoundError):
        Marketplace.from_database(spark, "no_such_database")
    spark.sql("CREATE DATABASE IF NOT EXISTS shop")
    orders = market(spark, orders=[order("a", bought="2020-01-01")]).table("orders")
    orders.write.mode("overwrite").saveAsTable("shop.orders")
    found = Marketplace.from_database(spark, "shop")
    assert found.has("orders") and not found.has("sellers")
    assert found.table("orders").count() == 1
    spark.sql("DROP DATABASE shop CASCADE")


def _items(spark, prices):
    raw = prices.selectExpr("1L AS order_id", "2L AS product_id", "3L AS seller_id", "price", "'x' AS extra")
    return Marketplace.from_frames(spark, {"order_items": raw})


def test_prices_keep_their_type_and_all_digits(spark):
    found = {}
    for kind in ("double", "float", "string", "decimal(12,2)", "decimal(18,4)", "decimal(20,10)", "int"):
        m = _items(spark, spark.sql(f"SELECT cast('12' AS {kind}) AS price UNION ALL SELECT NULL"))
        table, money = m.table("order_items"), m.amounts("order_items")
        assert dict(table.dtypes)["price"] == kind and "extra" not in table.columns
        parts = money.names("price_units")
        assert rows(table.select(money.double([F.sum(part) for part in parts]).alias("s")), "s") == [(12.0,)]
        found[kind] = {dict(table.dtypes)[part] for part in parts}
    assert found.pop("decimal(20,10)") == {"decimal(28,10)"}
    assert all(found.pop(kind) == {"bigint", "double"} for kind in ("double", "float", "string"))
    assert all(kinds == {"bigint"} for kinds in found.values())


def test_units_are_exact(spark):
    prices = spark.range(0, 99_999_999_999_999_999, 77_777_777_777_777).selectExpr(
        "id", "cast(cast(id as decimal(20,0)) / 10000 as decimal(18,4)) as price"
    )
    units = F.col("price") * 10_000
    table = _items(spark, prices).table("order_items")
    assert table.filter(units != F.col("price_units")).count() == 0


def _exact(values):
    odd = [v for v in values if v is not None and not math.isfinite(v)]
    known = [v for v in values if v is not None]
    return sum(odd) if odd else math.fsum(known) if known else None


@pytest.mark.parametrize(
    "spread", [(-5, 5), (-30, 0), (-1074, -1000), (900, 1018), (-1074, 1018)], ids=lambda s: f"{s[0]}to{s[1]}"
)
def test_doubles_of_any_size_are_summed_exactly(spark, spread):
    rng = random.Random(spread[1])
    groups = {g: [rng.uniform(-2, 2) * 2.0 ** rng.randint(*spread) for _ in range(rng.randint(1, 40))] for g in range(30)}
    groups[30] = [-x for x in groups[3]] + groups[3]
    groups[31] = [*groups[4], None, 0.0, -0.0]
    groups[32] = [None, None]
    groups[33] = [0.1] * 1000
    pairs = [(g, v) for g, values in groups.items() for v in values]
    for turn in range(2):
        rng.shuffle(pairs)
        df = spark.createDataFrame(pairs, "g int, price double").repartition(3 + 4 * turn)
        money = Amounts.of(df, "price")
        parts = [u.alias(n) for u, n in zip(money.units(F.col("price")), money.names("p"), strict=True)]
        sums = df.select("g", *parts).groupBy("g").agg(*[F.sum(n).alias(n) for n in money.names("p")])
        found = sums.select("g", money.double([F.col(n) for n in money.names("p")]).alias("s")).collect()
        assert {r["g"]: r["s"] for r in found} == {g: _exact(values) for g, values in groups.items()}


def test_missing_infinite_and_undefined_doubles(spark):
    inf, nan = float("inf"), float("nan")
    groups = {0: [inf, 1.0], 1: [-inf, 2.0], 2: [inf, -inf], 3: [nan, 1.0], 4: [1.0, None], 5: [None]}
    df = spark.createDataFrame([(g, v) for g, own in groups.items() for v in own], "g int, price double")
    money = Amounts.of(df, "price")
    parts = [u.alias(n) for u, n in zip(money.units(F.col("price")), money.names("p"), strict=True)]
    sums = df.select("g", *parts).groupBy("g").agg(*[F.sum(n).alias(n) for n in money.names("p")])
    found = {r["g"]: r["s"] for r in sums.select("g", money.double([F.col(n) for n in money.names("p")]).alias("s")).collect()}
    assert found[0] == inf and found[1] == -inf and math.isnan(found[2]) and math.isnan(found[3])
    assert found[4] == 1.0 and found[5] is None
    empty = df.filter("g > 9")
    assert Amounts.of(empty, "price").limbs == 1


def test_classes_of_double_prices_do_not_depend_on_the_order_of_rows(spark):
    rng = random.Random(1)
    items = [(i, rng.randrange(40), 3, rng.random() * 10.0 ** rng.randint(-12, 3)) for i in range(2000)]
    orders = spark.createDataFrame([(i, "delivered") for i in range(2000)], "order_id long, order_status string")
    orders = orders.selectExpr("*", *[f"timestamp_ntz'2020-01-01' AS {c}" for c in (
        "order_purchase_timestamp", "order_delivered_customer_date", "order_estimated_delivery_date")])
    products = spark.createDataFrame([(i, "c") for i in range(40)], "product_id long, product_category_name string")
    found = []
    for turn in range(2):
        rng.shuffle(items)
        table = spark.createDataFrame(items, "order_id long, product_id long, seller_id long, price double")
        market = Marketplace.from_frames(
            spark, {"order_items": table.repartition(5 + turn), "orders": orders, "products": products}
        )
        found.append([tuple(r) for r in tm.abc_classification(market).collect()])
        assert {r["product_id"]: r["revenue"] for r in tm.product_revenue(market).collect()} == {
            p: math.fsum(x[3] for x in items if x[1] == p) for p in range(40)
        }
    assert found[0] == found[1] and sum(r[1] for r in found[0]) == 40


def test_scratch_folder_comes_from_the_session(spark, monkeypatch):
    class Conf(dict):
        def get(self, key, default=None):
            return dict.get(self, key, default)

    class Session:
        conf = Conf({"spark.checkpoint.dir": "hdfs:///shared"})

        class sparkContext:
            master = "yarn"

    assert scratch.scratch_root(Session) == "hdfs:///shared"
    Session.conf = Conf()
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        scratch.scratch_root(Session)
    Session.sparkContext.master = "local[2]"
    assert "tallymart-" in scratch.scratch_root(Session)


# --- report tables ---------------------------------------------------------


def test_retention_tiles_without_a_result(spark):
    empty = spark.createDataFrame([], "retention_30_pct double, retention_60_pct double, retention_90_pct double")
    assert rows(report.retention_metrics(empty)) == [
        ("30-Day Retention", "N/A"),
        ("60-Day Retention", "N/A"),
        ("90-Day Retention", "N/A"),
    ]


def test_missing_class_shows_as_not_available(spark):
    classes = spark.createDataFrame(
        [("C", 1234, 10.0, 100.0)],
        "abc_class string, product_count bigint, total_revenue double, pct_of_total_revenue double",
    )
    text = report.abc_insight(classes).head().insight
    assert "(N/A items) generate N/A" in text and "(1,234 items) contributes only 100.0%" in text


def test_top_tables_break_ties_by_key(spark):
    states = spark.createDataFrame(
        [("b", 1.0, 5), ("a", 1.0, 6), ("c", None, 7), ("d", 2.0, 8)],
        "customer_state string, avg_delay_days double, total_orders bigint",
    )
    assert rows(report.top_delayed_states(states, 3), "customer_state") == [("d",), ("a",), ("b",)]


# --- full run --------------------------------------------------------------


def test_run_writes_every_output(spark, star, tmp_path):
    outcome = tm.run(star, Settings(out=str(tmp_path), min_year=1990, as_of=dt.date(2002, 1, 1)))
    assert outcome.errors == {}
    read = spark.read
    detail = read.parquet(outcome.files["detail"])
    assert sorted(rows(detail)) == sorted(rows(tm.seller_scorecard(star)))
    summary = read.option("header", True).csv(outcome.files["summary"])
    assert summary.columns == ["abc_class", "product_count", "total_revenue", "pct_of_total_revenue"]
    assert [r.abc_class for r in summary.collect()] == ["A", "B", "C"]
    chart = read.json(outcome.files["chart"])
    assert 0 < chart.count() <= 15
    assert read.parquet(outcome.files["seller_scorecard"]).count() <= 20
    assert read.parquet(outcome.files["key_findings"]).count() == 4
    assert read.parquet(outcome.files["retention_metrics"]).count() == 3
    assert read.parquet(outcome.files["abc_insight"]).count() == 1
    assert sorted(rows(read.parquet(outcome.files["delivery_analysis"]))) == sorted(
        rows(tm.delivery_by_state(star))
    )
    months = read.parquet(outcome.files["orders_over_time"])
    assert dict(months.dtypes)["order_month"] == "string"
    assert read.parquet(outcome.files["checks"]).count() == 19


def test_second_run_overwrites_the_first(spark, star, tmp_path):
    out = str(tmp_path)
    everything = tm.run(star, Settings(out=out))
    one_state = tm.run(star, Settings(out=out, seller_state="NATION_9", start="1997-01-01"))
    assert everything.files == one_state.files
    detail = spark.read.parquet(one_state.files["detail"])
    expected = tm.seller_scorecard(star, tm.Period.of("1997-01-01"), "NATION_9")
    assert sorted(rows(detail)) == sorted(rows(expected))


def test_one_failed_analysis_leaves_the_others(spark, star, tmp_path):
    outcome = tm.run(star.without("sellers"), Settings(out=str(tmp_path)))
    assert not outcome.checks_passed
    assert list(outcome.errors) == ["scorecard"]
    assert "detail" not in outcome.files and "key_findings" not in outcome.files
    assert {"summary", "chart", "delivery_analysis", "orders_over_time"} <= set(outcome.files)


def test_failure_inside_a_job_is_contained(spark, star, tmp_path):
    items = star.table("order_items").drop("price_units")
    bad = items.selectExpr(
        "order_id", "product_id", "seller_id",
        "if(order_id >= 0, raise_error('unreadable price'), price) as price",
    )
    outcome = tm.run(star.replace(order_items=bad), Settings(out=str(tmp_path)))
    assert set(outcome.errors) == {"scorecard", "classes", "months"}
    assert "unreadable price" in outcome.errors["months"]
    assert {"chart", "retention_metrics"} <= set(outcome.files)


def test_malformed_date_stops_before_any_job(spark, tmp_path):
    with pytest.raises(ValueError, match="end"):
        tm.run(market(spark), Settings(out=str(tmp_path), end="soon"))
    assert list(tmp_path.iterdir()) == []


def test_run_on_empty_tables(spark, tmp_path):
    outcome = tm.run(market(spark), Settings(out=str(tmp_path)))
    assert outcome.errors == {} and not outcome.checks_passed
    found = rows(spark.read.parquet(outcome.files["key_findings"]), "topic", "finding")
    assert dict(found) == {
        "Seller Scorecard": "0 active sellers ranked by composite score",
        "Delivery Analysis": report.FINDING_DELIVERY % ("none", "none"),
        "ABC Classification": "Class A (N/A products) drives N/A of revenue",
        "Customer Retention": "Only N/A of customers return within 90 days",
    }
    assert set(SCHEMAS) == set(tm.sources.schema.EXPECTED_TABLES)


def test_job_arguments_and_exit_codes(spark, tmp_path):
    source, out = str(tmp_path / "in"), str(tmp_path / "out")
    assert main(["--folder", source, "--out", out], spark) == 1
    m = market(
        spark,
        orders=[order("a", bought="2020-01-01"), order("b", bought="2021-01-01")],
        order_items=[item("a"), item("b", seller="s2")],
        sellers=[("s1", "SP"), ("s2", "RJ")],
    )
    for name in SCHEMAS:
        table = m.table(name)
        table.drop("price_units", "score_units").write.parquet(f"{source}/{name}")
    assert main(["--folder", source, "--out", out, "--start-date", "20200101"], spark) == 1
    arguments = ["--start-date", "2020-01-01", "--end-date", "2021-12-31", "--seller-state", "RJ"]
    assert main(["--folder", source, "--out", out, *arguments], spark) == 0
    detail = spark.read.parquet(f"{out}/detail.parquet")
    assert rows(detail, "seller_id", "total_revenue") == [("s2", 1.0)]
    with pytest.raises(SystemExit):
        main(["--out", out], spark)


def test_a_missing_column_stops_only_what_reads_it(spark, star, tmp_path):
    undated = star.table("orders").drop("order_purchase_timestamp")
    outcome = tm.run(star.replace(orders=undated), Settings(out=str(tmp_path)))
    assert "delivery" in outcome.errors or "months" in outcome.errors
    assert "checks" in outcome.files and not outcome.checks_passed
    personless = star.table("customers").drop("customer_unique_id")
    assert tm.delivery_by_state(star.replace(customers=personless)).count() > 0


def test_outputs_of_an_earlier_run_are_not_taken_for_new(spark, star, tmp_path):
    first = tm.run(star, Settings(out=str(tmp_path)))
    second = tm.run(star.without("sellers"), Settings(out=str(tmp_path)))
    listed = by_key(spark.read.parquet(second.files["outputs"]), "name", "path", "error")
    assert first.files["detail"] and "detail" not in listed
    assert listed["scorecard"][0] is None and "sellers" in listed["scorecard"][1]
    assert listed["summary"] == (second.files["summary"], None)


def test_a_run_leaves_no_intermediate_tables(spark, star, tmp_path, monkeypatch):
    monkeypatch.setattr(scratch, "scratch_root", lambda _: str(tmp_path / "scratch"))
    tm.run(star, Settings(out=str(tmp_path / "out")))
    assert list((tmp_path / "scratch" / "tallymart").iterdir()) == []
    assert spark.read.parquet(str(tmp_path / "out" / "detail.parquet")).count() > 0


def test_only_a_local_master_has_a_folder_of_its_own(spark, monkeypatch):
    class Session:
        class sparkContext:
            master = "local-cluster[2,1,1024]"

        class conf:
            @staticmethod
            def get(name, default):
                return None

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        scratch.scratch_root(Session)
