"""Files, runs, catalog, the whole chain, and the incremental stream."""

import datetime as dt
import os

import pytest
from conftest import AS_OF, hand_made, rows_of
from pyspark.sql import functions as F

from bazaarlake import schemas
from bazaarlake.functions.scalars import run_date_of
from bazaarlake.operators import versions
from bazaarlake.plans import analytics, clean_zone, make_run
from bazaarlake.plans.clean_zone import CleanJob, clean_run
from bazaarlake.plans.weekly_run import run_scope, weekly_run
from bazaarlake.sinks import files as sink
from bazaarlake.sources import raw_csv
from bazaarlake.sources.catalog import clean_tables, register_clean, register_raw
from bazaarlake.streaming.increments import load_new_rows
from bazaarlake.synth.generate import maker

FIRST, SECOND = dt.date(2025, 4, 6), dt.date(2025, 4, 13)


@pytest.fixture()
def root(tmp_path):
    return str(tmp_path)


def write_text(root, table, name, lines):
    folder = os.path.join(root, table)
    os.makedirs(folder, exist_ok=True)
    with open(os.path.join(folder, name), "w") as out:
        out.write("\n".join(lines) + "\n")


ORDER_HEAD = "order_id,customer_id,order_date,payment_method,order_status,created_at,updated_at"


def order_line(order_id, day="2025-04-01", status="completed"):
    return f"{order_id},1,{day},UPI,{status},{day} 09:30:00,{day} 09:30:00"


def small_raw_run(root, stamp):
    """A dated file per table, as they arrive."""
    write_text(root, "categories", f"categories_{stamp}.csv", ["category_id,category_name", "1,Electronics"])
    write_text(root, "products", f"products_{stamp}.csv",
               ["product_id,category_id,product_name,default_price", "1,1,Smartphone,65000"])
    write_text(root, "customers", f"customers_{stamp}.csv", [
        "customer_id,first_name,last_name,email,phone,city,signup_date,created_at,updated_at",
        "1,Asha,Rao,asharao1234@example.com,0987654321,Pune,2025-02-01,2025-02-01 10:00:00,2025-02-01 10:00:00"])
    write_text(root, "orders", f"orders_{stamp}.csv", [
        ORDER_HEAD, order_line(1), order_line(2, "2025-04-25"), "three,1,2025-04-01,UPI,completed,,"])
    write_text(root, "order_items", f"order_items_{stamp}.csv", [
        "order_item_id,order_id,product_id,product_name,quantity,unit_price,discount,final_price,created_at,updated_at",
        "1,1,1,Smartphone,2,65000,5,61750.0,2025-04-01 09:30:00,2025-04-01 09:30:00",
        "2,2,1,Smartphone,1,65000,5,61750.0,2025-04-01 09:30:00,2025-04-01 09:30:00",
        "3,1,9999,INVALID_PRODUCT,1,700,0,700.0,2025-04-01 09:30:00,2025-04-01 09:30:00",
        "4,1,1,Smartphone,-3,65000,5,0.0,2025-04-01 09:30:00,2025-04-01 09:30:00",
        "5,1,1,Smartphone,many,65000,5,61750.0,2025-04-01 09:30:00,2025-04-01 09:30:00"])


def test_raw_scan_types_and_marks(spark, root):
    small_raw_run(root, "20250406")
    tables = raw_csv.scan_run(spark, root)
    assert {n: [(f.name, f.dataType) for f in df.schema.fields][:-2] for n, df in tables.items()} == {
        n: [(f.name, f.dataType) for f in s.fields] for n, s in schemas.CLEAN.items()}
    assert tables.customers.first()["phone"] == "0987654321"
    assert [(r["order_id"], r["malformed"], r["run_date"]) for r in tables.orders.collect()] == [
        (1, False, FIRST), (2, False, FIRST), (None, True, FIRST)]


def test_line_with_missing_cells_is_marked(spark, root):
    write_text(root, "orders", "orders_20250406.csv", [ORDER_HEAD, order_line(1), "2,1"])
    orders = raw_csv.scan_table(spark, root, "orders")
    assert {r["order_id"]: r["malformed"] for r in orders.collect()} == {1: False, 2: True}
    assert {r["order_id"]: r["malformed"] for r in orders.select("order_id", "malformed").collect()} == {1: False, 2: True}


def test_quoted_cells_survive_both_ways(spark, root):
    write_text(root, "categories", "categories_20250406.csv", ["category_id,category_name", '1,"Toys, ""Games"""'])
    found = raw_csv.scan_table(spark, root, "categories").select("category_id", "category_name")
    assert found.first()["category_name"] == 'Toys, "Games"'
    sink.write_dated_csv(found, f"{root}/again", "categories", FIRST)
    assert raw_csv.scan_table(spark, f"{root}/again", "categories").first()["category_name"] == 'Toys, "Games"'


def test_one_run_is_read_alone(spark, root):
    write_text(root, "orders", "orders_20250406.csv", [ORDER_HEAD, order_line(1), order_line(2)])
    write_text(root, "orders", "orders_20250413.csv", [ORDER_HEAD, order_line(1, status="returned")])
    assert raw_csv.scan_table(spark, root, "orders").count() == 3
    only = raw_csv.scan_table(spark, root, "orders", SECOND)
    assert [(r["order_id"], r["order_status"], r["run_date"]) for r in only.collect()] == [(1, "returned", SECOND)]
    assert len(only.inputFiles()) == 1


def test_missing_sources_are_refused(spark, root):
    with pytest.raises(raw_csv.SourceMissing, match="no raw folder given"):
        raw_csv.require_source(spark, "")
    with pytest.raises(raw_csv.SourceMissing, match="not found"):
        raw_csv.require_source(spark, f"{root}/nowhere")
    small_raw_run(root, "20250406")
    raw_csv.require_source(spark, root)
    write_text(root, "returns", "returns.tmp", ["not a csv"])
    with pytest.raises(raw_csv.SourceMissing, match="no CSV file for returns"):
        raw_csv.require_source(spark, root, ["orders", "returns"])


def test_run_date_from_both_layouts(spark):
    paths = ["file:/r/orders/orders_20250406.csv", "file:/r/orders/orders_20250406.csv/part-0.csv",
             "file:/r/orders/run_date=2025-04-13/part-0.csv", "file:/r/orders/other.csv"]
    df = spark.createDataFrame([(p,) for p in paths], "p string").select(run_date_of(F.col("p")).alias("d"))
    assert [r["d"] for r in df.collect()] == [FIRST, FIRST, SECOND, None]


def test_latest_version_and_increment(spark):
    rows = [(1, FIRST, "a"), (1, SECOND, "b"), (2, FIRST, "c")]
    df = spark.createDataFrame(rows, "k int, run_date date, v string")
    assert sorted(map(tuple, versions.latest_per_key(df, "k", ["run_date"]).collect())) == [(1, SECOND, "b"), (2, FIRST, "c")]
    assert sorted(r["k"] for r in versions.latest_run(df).collect()) == [1]
    stamped = spark.createDataFrame([(k, dt.datetime(2025, 1, d)) for k, d in ((1, 1), (2, 2), (3, 2), (4, 3))],
                                    "k int, created_at timestamp_ntz")
    loaded = stamped.where("k IN (1, 2)")
    assert sorted(r["k"] for r in versions.newer_than(stamped, loaded, "k").collect()) == [3, 4]
    assert versions.newer_than(stamped, stamped.where("false"), "k").count() == 4


def test_clean_run_from_arrived_files(spark, root):
    raw_root, clean_root = f"{root}/raw", f"{root}/clean"
    small_raw_run(raw_root, "20250406")
    report = clean_run(spark, CleanJob(raw_root, clean_root, FIRST, AS_OF))
    assert report["orders"] == {"rows": 3, "clean_rows": 1, "malformed": 1, "future_date": 1}
    assert report["order_items"] == {"rows": 5, "clean_rows": 1, "malformed": 1, "invalid_fk": 1, "negative_qty": 1,
                                     "removed_order": 1}
    quarantine = spark.read.parquet(f"{clean_root}/quarantine/order_items")
    assert {r["order_item_id"]: r["reasons"] for r in quarantine.collect()} == {
        2: ["removed_order"], 3: ["invalid_fk"], 4: ["negative_qty"], 5: ["malformed"]}
    register_clean(spark, "t_clean_run", clean_root)
    tables = clean_tables(spark, "t_clean_run")
    assert rows_of(analytics.revenue_by_category(tables)) == [("Electronics", 1, 2, "123500.00")]
    assert tables.order_items.schema["final_price"].dataType.simpleString() == "decimal(18,2)"


def test_rerun_without_bad_rows_empties_the_quarantine(spark, root):
    raw_root, clean_root = f"{root}/raw", f"{root}/clean"
    small_raw_run(raw_root, "20250406")
    job = CleanJob(raw_root, clean_root, FIRST, AS_OF)
    clean_run(spark, job)
    write_text(raw_root, "orders", "orders_20250406.csv", [ORDER_HEAD, order_line(1), order_line(2)])
    report = clean_run(spark, job)
    assert report["orders"]["clean_rows"] == 2
    spark.catalog.clearCache()
    assert spark.read.parquet(f"{clean_root}/quarantine/orders/run_date=2025-04-06").count() == 0
    assert not os.listdir(f"{clean_root}/_stage")


def test_weekly_runs_do_not_mix(spark, root):
    names = dict(raw_database="t_weekly_raw", clean_database="t_weekly_clean")
    first = weekly_run(spark, root, FIRST, target_items=2000, seed=1, **names)
    assert first["made"] == {"categories": 7, "products": 49, "customers": 285, "orders": 1000, "order_items": 2000}
    alone = run_scope(clean_tables(spark, names["clean_database"]), FIRST)
    answer = rows_of(analytics.revenue_by_category(alone))
    weekly_run(spark, root, SECOND, target_items=1000, seed=2, **names)
    clean_run(spark, CleanJob(f"{root}/raw", f"{root}/clean", SECOND, SECOND))  # a rerun replaces its run
    register_clean(spark, names["clean_database"], f"{root}/clean")
    tables = clean_tables(spark, names["clean_database"])
    assert {r["run_date"] for r in tables.products.select("run_date").distinct().collect()} == {FIRST, SECOND}
    assert tables.products.count() == 98
    assert rows_of(analytics.revenue_by_category(run_scope(tables, FIRST))) == answer
    newer = spark.read.option("header", True).csv(f"{root}/results/2025-04-13/revenue_by_category")
    scoped = analytics.revenue_by_category(run_scope(tables, SECOND))
    assert [r["total_revenue_inr"] for r in newer.collect()] == [str(r["total_revenue_inr"]) for r in scoped.collect()]
    rows = first["cleaned"]["order_items"]
    bad = spark.read.parquet(f"{root}/clean/quarantine/order_items").where(F.col("run_date") == F.lit(FIRST)).count()
    assert rows["rows"] == 2000 and rows["clean_rows"] + bad == 2000
    assert spark.table(f"{names['raw_database']}.orders").count() == 1500


def test_failed_make_leaves_earlier_runs_and_no_stage(spark, root, monkeypatch):
    raw_root = f"{root}/raw"
    make_run.make_run(spark, maker(spark, 700, FIRST), raw_root, FIRST)

    def fail(report):
        raise ValueError("no")

    monkeypatch.setattr(make_run, "require_checks", fail)
    with pytest.raises(ValueError):
        make_run.make_run(spark, maker(spark, 700, SECOND), raw_root, SECOND)
    assert os.listdir(f"{raw_root}/orders") == ["run_date=2025-04-06"]
    assert not os.listdir(f"{raw_root}/_stage")


def test_failed_clean_leaves_the_published_run(spark, root, monkeypatch):
    raw_root, clean_root = f"{root}/raw", f"{root}/clean"
    small_raw_run(raw_root, "20250406")
    job = CleanJob(raw_root, clean_root, FIRST, AS_OF)
    clean_run(spark, job)

    def fail(*_):
        raise OSError("disk")

    monkeypatch.setattr(clean_zone.quality, "judge_items", fail)
    with pytest.raises(OSError):
        clean_run(spark, job)
    assert spark.read.parquet(f"{clean_root}/processed_order_items").count() == 1
    assert not os.listdir(f"{clean_root}/_stage")


def test_register_raw_reads_text(spark, root):
    small_raw_run(root, "20250406")
    register_raw(spark, "t_register_raw", root)
    assert spark.table("t_register_raw.customers").first()["phone"] == "0987654321"
    assert spark.sql("SELECT count(*) AS n FROM t_register_raw.order_items").first()["n"] == 5


def test_landing_twice_replaces_one_run_only(spark, root):
    orders = hand_made(spark).orders
    sink.land_csv(orders, root, "orders", FIRST)
    sink.land_csv(orders.where("order_id = 1"), root, "orders", SECOND)
    sink.land_csv(orders.where("order_id < 3"), root, "orders", FIRST)
    found = spark.read.option("header", True).csv(f"{root}/orders")
    assert {(r["run_date"], r["count"]) for r in found.groupBy("run_date").count().collect()} == {(FIRST, 2), (SECOND, 1)}


def test_publish_replaces_a_folder(spark, root):
    for n in (3, 2):
        sink.publish(spark, sink.write_parquet(spark.range(n), f"{root}/stage"), f"{root}/out/t")
        assert spark.read.parquet(f"{root}/out/t").count() == n
    assert os.listdir(f"{root}/out") == ["t"] and not os.path.exists(f"{root}/stage.replaced")


def test_stream_loads_each_file_once(spark, root):
    raw_root, target = f"{root}/raw", f"{root}/loaded"
    write_text(raw_root, "orders", "orders_20250406.csv", [ORDER_HEAD, *[order_line(i) for i in range(4)]])
    load_new_rows(spark, raw_root, "orders", target)
    assert spark.read.parquet(f"{target}/orders").count() == 4
    write_text(raw_root, "orders", "orders_20250413.csv", [ORDER_HEAD, order_line(9), "x,1,,UPI,completed,,"])
    load_new_rows(spark, raw_root, "orders", target)
    load_new_rows(spark, raw_root, "orders", target)
    loaded = spark.read.parquet(f"{target}/orders")
    assert loaded.count() == 6
    assert loaded.where("malformed").count() == 1
    assert loaded.where(F.col("run_date") == F.lit(SECOND)).count() == 2
    with pytest.raises(ValueError, match="no created_at"):
        load_new_rows(spark, raw_root, "products", target)


@pytest.mark.parametrize("writer", [sink.write_dated_csv, sink.land_csv])
def test_both_layouts_are_read_back_by_run(spark, root, writer):
    for day, n in ((FIRST, 3), (SECOND, 5)):
        writer(spark.range(n).select(F.col("id").cast("int").alias("category_id"), F.lit("x").alias("category_name")), root, "categories", day)
    for day, n in ((FIRST, 3), (SECOND, 5)):
        assert raw_csv.scan_table(spark, root, "categories", day).count() == n
    with pytest.raises(raw_csv.SourceMissing):
        raw_csv.scan_table(spark, root, "categories", dt.date(2025, 4, 20))


def test_a_run_in_both_layouts_is_read_whole(spark, root):
    one = spark.createDataFrame([(1, "a")], "category_id int, category_name string")
    sink.land_csv(one, root, "categories", FIRST)
    write_text(root, "categories", "categories_20250406.csv", ["category_id,category_name", "2,b"])
    assert {r["category_id"] for r in raw_csv.scan_table(spark, root, "categories", FIRST).collect()} == {1, 2}


def test_cleaning_an_absent_run_keeps_what_is_published(spark, root):
    small_raw_run(f"{root}/raw", "20250406")
    job = CleanJob(f"{root}/raw", f"{root}/clean", FIRST, AS_OF)
    clean_run(spark, job)
    with pytest.raises(raw_csv.SourceMissing):
        clean_run(spark, CleanJob(f"{root}/raw", f"{root}/clean", SECOND, AS_OF))
    assert spark.read.parquet(f"{root}/clean/processed_orders").count() == 1
    os.remove(f"{root}/raw/customers/customers_20250406.csv")
    with pytest.raises(raw_csv.SourceMissing):
        clean_run(spark, job)
    assert spark.read.parquet(f"{root}/clean/processed_customers").count() == 1


class _Refuses:
    """A file system whose n-th rename raises."""

    def __init__(self, fs, at):
        self.fs, self.left = fs, at

    def __getattr__(self, name):
        return getattr(self.fs, name)

    def rename(self, source, target):
        self.left -= 1
        if self.left == 0:
            raise OSError("the store said no")
        return self.fs.rename(source, target)


@pytest.mark.parametrize("at", [1, 2, 3, 4])
def test_a_raising_rename_leaves_every_old_folder(spark, root, monkeypatch, at):
    for name in ("a", "b"):
        sink.publish(spark, sink.write_parquet(spark.range(3), f"{root}/stage/{name}"), f"{root}/out/{name}")
    moves = [(sink.write_parquet(spark.range(7), f"{root}/stage/{name}"), f"{root}/out/{name}") for name in ("a", "b")]
    real, made = sink.hadoop_path, []

    def first_refuses(spark, path):
        fs, jpath = real(spark, path)
        made.append(path)
        return (_Refuses(fs, at) if len(made) == 1 else fs), jpath

    monkeypatch.setattr(sink, "hadoop_path", first_refuses)
    with pytest.raises(OSError, match="said no"):
        sink.publish_all(spark, moves)
    monkeypatch.undo()
    assert [spark.read.parquet(f"{root}/out/{name}").count() for name in ("a", "b")] == [3, 3]
    assert sorted(os.listdir(f"{root}/out")) == ["a", "b"]
    sink.publish_all(spark, moves)
    assert [spark.read.parquet(f"{root}/out/{name}").count() for name in ("a", "b")] == [7, 7]


def test_a_run_landed_again_is_loaded_once(spark, root):
    target = f"{root}/loaded"
    for rows in ([(1, "a"), (2, "b")], [(1, "a"), (2, "c"), (3, "d")]):
        orders = spark.createDataFrame(rows, "order_id long, payment_method string").selectExpr(
            "order_id", "1L AS customer_id", "date'2025-04-01' AS order_date", "payment_method", "'completed' AS order_status",
            "timestamp_ntz'2025-04-01 09:30:00' AS created_at", "timestamp_ntz'2025-04-01 09:30:00' AS updated_at")
        sink.land_csv(orders, f"{root}/raw", "orders", FIRST)
        load_new_rows(spark, f"{root}/raw", "orders", target)
    found = spark.read.parquet(f"{target}/orders").select("order_id", "payment_method").collect()
    assert sorted(map(tuple, found)) == [(1, "a"), (2, "c"), (3, "d")]
