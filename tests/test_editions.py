"""Outputs that change as a whole, and sources laid out by day."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

import tallymart as tm
from catalogue.star import star_market
from tallymart import Marketplace, Period, Settings
from tallymart.__main__ import main
from tallymart.plans import editions, publish
from tests.small import SCHEMAS, item, market, order, rows


@pytest.fixture
def star(spark, sf_dir):
    return star_market(spark, sf_dir)


def _small(spark, price):
    return market(
        spark,
        orders=[order("a", bought="2020-01-01"), order("b", bought="2020-02-01")],
        order_items=[item("a", price=price), item("b", "p2", "s2", price)],
        products=[("p1", "x"), ("p2", "y")],
        sellers=[("s1", "SP"), ("s2", "RJ")],
    )


def _revenue(spark, edition):
    return sorted(rows(spark.read.parquet(edition.files["detail"]), "seller_id", "total_revenue"))


def test_a_stopped_run_leaves_the_former_edition_whole(spark, tmp_path, monkeypatch):
    settings = Settings(out=str(tmp_path), editions=2)
    assert tm.current_edition(spark, str(tmp_path)) is None
    first = tm.run(_small(spark, "1.00"), settings)
    seen = tm.current_edition(spark, str(tmp_path))
    assert (seen.number, seen.files, seen.errors) == (1, first.files, {})

    def stop(*_):
        raise KeyboardInterrupt

    with monkeypatch.context() as patch:
        # The summary of the second run is written, its scorecard is not.
        patch.setattr(publish, "write_detail", stop)
        with pytest.raises(KeyboardInterrupt):
            tm.run(_small(spark, "7.00"), settings)
    assert tm.current_edition(spark, str(tmp_path)) == seen
    assert _revenue(spark, seen) == [("s1", 1.0), ("s2", 1.0)]
    for name, path in seen.files.items():
        kind = {"summary": "csv", "chart": "json"}.get(name, "parquet")
        assert spark.read.format(kind).load(path).count() >= 0, name

    third = tm.run(_small(spark, "7.00"), settings)
    now = tm.current_edition(spark, str(tmp_path))
    assert third.edition == now.number == 2 and not set(now.files.values()) & set(seen.files.values())
    assert _revenue(spark, now) == [("s1", 7.0), ("s2", 7.0)]
    assert _revenue(spark, seen) == [("s1", 1.0), ("s2", 1.0)]


def _publish(spark, out, keep, text):
    folder = editions.new_folder(out)
    path = f"{folder}/x"
    spark.createDataFrame([(text,)], "t string").write.parquet(path)
    return editions.publish_edition(spark, out, folder, {"x": path}, {}, keep)


def test_old_editions_go_and_nothing_else(spark, tmp_path):
    out = f"{tmp_path}/target/"
    made = [_publish(spark, out, 2, str(n)) for n in range(4)]
    assert [e.number for e in made] == [1, 2, 3, 4]
    assert tm.current_edition(spark, out) == made[-1]
    kept = sorted(p.name for p in (tmp_path / "target" / "runs").iterdir())
    assert kept == sorted(e.folder.rsplit("/", 1)[1] for e in made[2:])
    assert rows(spark.read.parquet(made[2].files["x"])) == [("2",)]
    with pytest.raises(ValueError, match="at least one"):
        _publish(spark, out, 0, "none")


def test_an_edition_is_never_overwritten(spark, tmp_path, monkeypatch):
    out = str(tmp_path)
    first = _publish(spark, out, 3, "first")
    monkeypatch.setattr(editions, "_numbers", lambda *_: [])  # another run that has not seen the first one
    with pytest.raises(FileExistsError):
        _publish(spark, out, 3, "second")
    monkeypatch.undo()
    assert tm.current_edition(spark, out) == first
    names = {p.name for p in (tmp_path / "editions").iterdir() if not p.name.startswith(".")}
    assert names == {"0000000001.json"}


def test_a_moved_target_and_a_half_written_list(spark, tmp_path):
    _publish(spark, str(tmp_path / "a"), 1, "here")
    (tmp_path / "a" / "editions" / "0000000002.json.draft").write_text("{")
    (tmp_path / "a").rename(tmp_path / "b")
    found = tm.current_edition(spark, str(tmp_path / "b"))
    assert found.number == 1 and rows(spark.read.parquet(found.files["x"])) == [("here",)]


def test_failed_analyses_are_listed(spark, star, tmp_path):
    outcome = tm.run(star.without("sellers"), Settings(out=str(tmp_path), editions=1))
    found = tm.current_edition(spark, str(tmp_path))
    assert list(found.errors) == ["scorecard"] and found.errors == outcome.errors
    assert "detail" not in found.files and found.files == outcome.files


def test_editions_as_a_job_argument(spark, tmp_path):
    source, out = f"{tmp_path}/in", f"{tmp_path}/out"
    for name in SCHEMAS:
        _small(spark, "1.00").table(name).drop("price_units", "score_units").write.parquet(f"{source}/{name}")
    assert main(["--folder", source, "--out", out, "--editions", "0"], spark) == 1
    assert main(["--folder", source, "--out", out, "--editions", "1"], spark) == 0
    assert tm.current_edition(spark, out).number == 1


# --- layouts by day ---------------------------------------------------------


@pytest.fixture
def by_day(spark, star, tmp_path):
    """The test tables with orders and items in one folder for each purchase day of three weeks."""
    days = Period.of("1997-02-22", "1997-03-14")
    orders = days.keep(star.table("orders"), "order_purchase_timestamp")
    day = F.col("order_purchase_timestamp").cast("date").alias("day")
    items = star.table("order_items").drop("price_units").join(orders.select("order_id", day), "order_id")
    tables = {"orders": orders.select("*", day), "order_items": items}
    for name, df in tables.items():
        df.repartition(1).write.partitionBy("day").parquet(f"{tmp_path}/{name}")
    for name in ("customers", "products", "sellers", "order_reviews"):
        star.table(name).drop("score_units").write.parquet(f"{tmp_path}/{name}")
    return tmp_path


WEEK = Period.of("1997-03-01", "1997-03-07")
DAILY = {
    "product_revenue": lambda m, p: tm.product_revenue(m, p),
    "product_classes": lambda m, p: tm.product_classes(m, p),
    "orders_over_time": lambda m, p: tm.orders_over_time(m, p),
    "seller_revenue": lambda m, p: tm.seller_revenue(m, p),
    "seller_cancellations": lambda m, p: tm.seller_cancellations(m, p),
    "seller_base": lambda m, p: tm.seller_base(m, p),
    "delivery_by_state": lambda m, p: tm.delivery_by_state(m, p),
}


def test_a_week_opens_only_its_own_folders(spark, star, by_day):
    dated = Marketplace.from_folder(spark, str(by_day)).laid_out_by_day(orders="day", order_items="day")
    for name in ("orders", "order_items"):
        assert dated.table(name).count() > 0
        for folder in (by_day / name).glob("day=*"):
            if not "1997-03-01" <= folder.name.removeprefix("day=") <= "1997-03-07":
                for file in folder.glob("*.parquet"):
                    file.write_bytes(b"not to be read")
    for name, build in DAILY.items():
        found, plain = build(dated, WEEK), build(star, WEEK)
        assert found.dtypes == plain.dtypes, name
        got = sorted(map(tuple, found.collect()), key=repr)
        assert got and got == sorted(map(tuple, plain.collect()), key=repr), name
    with pytest.raises(Exception, match="(?i)parquet|checksum"):
        tm.orders_over_time(dated).collect()


@pytest.mark.parametrize("columns", [{}, {"orders": "day"}, {"order_items": "day"}])
def test_layouts_of_some_tables_give_the_same_rows(spark, by_day, columns):
    plain = Marketplace.from_folder(spark, str(by_day))
    dated = plain.laid_out_by_day(**columns)
    for build in (tm.seller_metrics, tm.orders_over_time, tm.cohort_retention):
        for period in (Period(), WEEK, Period.of(end="1997-03-01")):
            got, expected = build(dated, period), build(plain, period)
            assert sorted(map(tuple, got.collect()), key=repr) == sorted(map(tuple, expected.collect()), key=repr)


def test_only_orders_and_items_have_days(spark):
    with pytest.raises(ValueError, match="customers"):
        market(spark).laid_out_by_day(customers="day")


def test_orders_without_a_purchase_time_pass_only_without_bounds(spark, tmp_path):
    m = market(spark, orders=[order("a", bought="2020-01-05"), order("b")], order_items=[item("a"), item("b")])
    day = F.col("order_purchase_timestamp").cast("date").alias("day")
    m.table("orders").select("*", day).write.partitionBy("day").parquet(f"{tmp_path}/orders")
    m.table("order_items").drop("price_units").write.parquet(f"{tmp_path}/order_items")
    dated = Marketplace.from_folder(spark, str(tmp_path)).laid_out_by_day(orders="day")
    assert tm.orders_over_time(dated).count() == 2
    assert tm.orders_over_time(dated, Period.of("2000-01-01")).count() == 1
