"""What is shuffled and written: landed runs are compressed, items are judged where they are read."""

import glob

import pyarrow.parquet as pq
import pytest
from conftest import AS_OF, hand_made, rows_of
from pyspark.sql import functions as F

from bazaarlake import schemas, session
from bazaarlake.operators import pruning, quality
from bazaarlake.plans import clean_zone, registry
from bazaarlake.plans.clean_zone import CleanJob, clean_run
from bazaarlake.plans.kept_answers import KeptAnswers, order_totals, partials
from bazaarlake.plans.registry import FIRST_RUN
from bazaarlake.sinks import files as sink
from bazaarlake.sources import catalog, drift, raw_csv, warehouse
from bazaarlake.streaming.ledger import FileLedger

SF = "/root/testdata/sf0.001"
IDS = [-(2**63), -65, -64, -1, 0, 1, 63, 64, 65, 2**62, 2**63 - 1, None]


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_an_exact_set_holds_its_keys_and_no_other(spark):
    keys = spark.createDataFrame([(i,) for i in IDS[::2]] + [(None,), (0,)], "id bigint")
    words = pruning.key_words(keys, "id")
    asked = spark.createDataFrame([(i,) for i in IDS], "id bigint")
    found = {row.id: row.known for row in pruning.among_words(asked, "id", words, "known").collect()}
    assert found == {i: i in IDS[::2] for i in IDS if i is not None} | {None: False}


def test_a_set_beyond_its_bound_or_of_text_is_left_to_the_join(spark):
    scattered = spark.range(5).selectExpr("id * 64 AS id")
    assert pruning.key_words(scattered, "id", most=4) is None
    assert pruning.key_words(scattered, "id", most=5) is not None
    assert pruning.key_words(scattered.selectExpr("string(id) AS id"), "id") is None


@pytest.mark.parametrize("sets", [(True, True), (True, False), (False, True)])
def test_verdicts_by_exact_sets_equal_those_by_joins(spark, sets):
    items = [(1, 1, 1, 1, "5"), (2, 1, 9999, 1, "5"), (3, 4, 1, 1, "5"), (4, 77, 1, 1, "5"), (5, None, 2, 1, "5"), (6, 2, None, 0, "5"), (7, 9, 3, 2, "5")]
    orders = [(1, 1, "2025-01-10", "UPI", "completed"), (2, 2, "2025-01-20", "Card", "completed"),
              (4, 2, "2025-04-25", "UPI", "completed"), (9, 2, "2025-04-25", "UPI", "completed"), (9, 2, "2025-04-01", "UPI", "completed")]
    tables = hand_made(spark, items=items, orders=orders)
    judged = quality.judge_orders(tables.orders, AS_OF)
    words = (pruning.key_words(tables.products, "product_id"), pruning.key_words(judged.where(quality.IS_CLEAN), "order_id"))
    by_sets = quality.judge_items(tables.order_items, tables.products, judged, *[w if s else None for w, s in zip(words, sets)])
    by_joins = quality.judge_items(tables.order_items, tables.products, judged)
    assert by_sets.columns == by_joins.columns
    assert sorted(map(str, rows_of(by_sets))) == sorted(map(str, rows_of(by_joins)))


def test_items_are_judged_without_a_shuffle(spark, conf):
    conf(spark__sql__autoBroadcastJoinThreshold="-1")
    orders = quality.judge_orders(warehouse.sound_orders(spark, SF), warehouse.AS_OF)
    products = warehouse.product_keys(spark, SF)
    judged = quality.judge_items(
        warehouse.unpriced_items(spark, SF), products, orders,
        pruning.key_words(products, "product_id"), pruning.key_words(orders.where(quality.IS_CLEAN), "order_id"))
    plan = plan_of(judged)
    assert "SortMergeJoin" not in plan and "hashpartitioning(order_id" not in plan and "hashpartitioning(product_id" not in plan
    assert "filter(array" not in plan  # array_compact: interpreted for each row


def test_a_landed_run_is_compressed_and_every_reader_finds_it(spark, tmp_path):
    root = str(tmp_path)
    orders = warehouse.sound_orders(spark, SF).select("order_id", "customer_id", "order_date", "payment_method", "order_status", "created_at")
    folder = sink.land_csv(orders, root, "orders", FIRST_RUN)
    files = glob.glob(f"{folder}/run_date=*/part-*")
    assert files and all(name.endswith(".csv.gz") for name in files)
    rows, schema = orders.count(), orders.schema
    raw_csv.require_source(spark, root, ["orders"], FIRST_RUN)
    text = raw_csv.scan_text(spark, folder, schemas.all_text(schema), FIRST_RUN)
    assert text.count() == rows
    assert raw_csv.text_bytes(text) == raw_csv.GZIP_SHARE * raw_csv.input_bytes(text)
    assert sum(row["rows"] for row in FileLedger(spark, folder, schema, f"{root}/loaded").load()) == rows
    cells = drift.run_columns(spark, folder).where("column_name = 'order_id'").first()
    assert (cells["cells"], cells["merged_type"]) == (rows, "int")
    catalog.register_raw(spark, "t_packed", root, ["orders"])
    assert spark.table("t_packed.orders").where(f"run_date = DATE '{FIRST_RUN}'").count() == rows
    spark.sql("DROP DATABASE t_packed CASCADE")


def test_the_clean_job_shuffles_no_items(spark, tmp_path, conf, monkeypatch):
    conf(spark__sql__autoBroadcastJoinThreshold="-1")
    root, plans = str(tmp_path), []
    for name, df in warehouse.landable_tables(spark, SF).items():
        sink.land_csv(df, f"{root}/raw", name, FIRST_RUN)
    judge = quality.judge_items
    monkeypatch.setattr(quality, "judge_items", lambda *a: (df := judge(*a), plans.append(plan_of(df)))[0])
    report = clean_run(spark, CleanJob(f"{root}/raw", f"{root}/clean", FIRST_RUN, warehouse.AS_OF))
    assert report["order_items"]["clean_rows"] > 0
    assert "SortMergeJoin" not in plans[0] and "ShuffledHashJoin" not in plans[0]


def test_items_and_orders_of_a_kept_run_meet_once_for_four_partials(spark, tmp_path):
    tables = hand_made(spark)
    tables = tables.having(**{
        name: (df.write.parquet(f"{tmp_path}/{name}"), spark.read.parquet(f"{tmp_path}/{name}"))[1] for name, df in tables.items()})
    order_totals(tables).write.parquet(f"{tmp_path}/totals")
    parts, plain = partials(tables, spark.read.parquet(f"{tmp_path}/totals")), partials(tables)
    read = {name for name, df in parts.items() if any("/order_items/" in file for file in df.inputFiles())}
    assert read == {"categories", "products"}
    for name in parts:
        assert sorted(map(str, rows_of(parts[name]))) == sorted(map(str, rows_of(plain[name])))


def test_a_kept_run_leaves_no_scratch_folder(spark, tmp_path):
    KeptAnswers(spark, str(tmp_path)).refresh(FIRST_RUN, hand_made(spark))
    assert not glob.glob(f"{tmp_path}/_stage/*")


def test_items_by_key_are_the_same_with_and_without_a_set(spark, conf):
    conf(spark__sql__autoBroadcastJoinThreshold="-1")
    tables = hand_made(spark)
    by_set = quality.with_key_among(tables.order_items, tables.products, "product_id")
    assert "SortMergeJoin" not in plan_of(by_set)
    by_join = quality.with_key_among(tables.order_items, tables.products.withColumn("product_id", F.col("product_id").cast("string")), "product_id")
    assert "SortMergeJoin" in plan_of(by_join)
    assert sorted(map(str, rows_of(by_set))) == sorted(map(str, rows_of(by_join))) and by_set.count() == 7


def test_the_summary_of_made_tables_judges_items_once(spark, conf):
    conf(spark__sql__autoBroadcastJoinThreshold="-1", spark__sql__adaptive__enabled="false")
    plan = registry.gen_run_summary(spark, SF)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("AS order_item_id") <= 3  # the judged items once; the picks that postdate orders, for orders and for verdicts


def test_a_summary_has_no_row_for_a_reason_that_does_not_occur(spark):
    tables = hand_made(spark)
    judged = quality.judge_items(tables.order_items, tables.products, quality.judge_orders(tables.orders, AS_OF))
    found = {row.measure: row.value for row in quality.summary(judged, quality.ITEM_REASONS, "items", "bad").collect()}
    assert found == {"items": 8, "bad": 3, "invalid_fk": 1, "negative_qty": 1, "removed_order": 1}


def test_a_clean_table_is_read_in_small_parts(spark, tmp_path, monkeypatch):
    assert spark.conf.get("spark.sql.files.maxPartitionBytes") == session.DEFAULTS["spark.sql.files.maxPartitionBytes"] == "16m"
    root = str(tmp_path)
    for name, df in warehouse.landable_tables(spark, "/root/testdata/sf0.01").items():
        sink.land_csv(df.coalesce(1), f"{root}/raw", name, FIRST_RUN)
    assert clean_zone.CLEAN_FORM["parquet.block.size"] == str(16 << 20)
    monkeypatch.setitem(clean_zone.CLEAN_FORM, "parquet.block.size", str(128 << 10))
    report = clean_run(spark, CleanJob(f"{root}/raw", f"{root}/clean", FIRST_RUN, warehouse.AS_OF))
    files = glob.glob(f"{root}/clean/processed_order_items/run_date=*/*.parquet")
    found = [pq.ParquetFile(name).metadata for name in files]
    assert sum(m.num_rows for m in found) == report["order_items"]["clean_rows"]
    assert len(found) == 1 and found[0].num_row_groups > 1


def test_a_landed_file_has_a_bound_whatever_wrote_it(spark, tmp_path):
    rows = 500_001
    folder = sink.land_csv(spark.range(rows).toDF("order_id").coalesce(1), str(tmp_path), "orders", FIRST_RUN)
    assert len(glob.glob(f"{folder}/run_date=*/part-*")) == 2
    assert spark.read.option("header", True).csv(folder).agg(F.count_distinct("order_id")).first()[0] == rows


def test_runs_that_are_landed_together_stay_apart(spark, tmp_path):
    tables = warehouse.landable_tables(spark, SF)
    one = tables.having(orders=tables.orders.limit(7))
    sink.land_all(str(tmp_path), (FIRST_RUN, tables), (registry.SECOND_RUN, one))
    for day, run in ((FIRST_RUN, tables), (registry.SECOND_RUN, one)):
        landed = raw_csv.scan_run(spark, str(tmp_path), day)
        assert {name: df.count() for name, df in landed.items()} == {name: df.count() for name, df in run.items()}
