"""Published runs: commits, names over several runs, raw names, the file ledger, drift, bitmaps, kept answers."""

import datetime as dt
import json
import os

import pytest
from conftest import AS_OF, hand_made, rows_of
from pyspark.sql import functions as F
from test_runs import FIRST, ORDER_HEAD, SECOND, order_line, small_raw_run, write_text

from bazaarlake.operators import distinct, quality
from bazaarlake.plans import analytics, clean_zone, sql_questions
from bazaarlake.plans.clean_zone import CleanJob, RunRefused, clean_run, read_published
from bazaarlake.plans.kept_answers import KeptAnswers
from bazaarlake.sinks import commits
from bazaarlake.sources import drift
from bazaarlake.sources.catalog import clean_tables, register_clean, register_raw
from bazaarlake.streaming import ledger as ledger_module
from bazaarlake.streaming.ledger import ledger_of

THIRD = dt.date(2025, 4, 20)


@pytest.fixture()
def root(tmp_path):
    return str(tmp_path)


def two_runs(spark, root, by_commit):
    """Equal ids in both; in the second one order more is in time."""
    for stamp, day in (("20250406", FIRST), ("20250413", SECOND)):
        small_raw_run(f"{root}/raw", stamp)
        if day == SECOND:
            write_text(f"{root}/raw", "orders", "orders_20250413.csv", [ORDER_HEAD, order_line(1), order_line(2)])
        clean_run(spark, CleanJob(f"{root}/raw", f"{root}/clean", day, AS_OF, by_commit=by_commit))
    return f"{root}/clean"


@pytest.mark.parametrize("by_commit", [False, True])
def test_names_mean_the_current_run(spark, root, by_commit):
    clean, name = two_runs(spark, root, by_commit), f"t_two_runs_{by_commit}".lower()
    register_clean(spark, name, clean)
    newer = [("Electronics", 2, 3, "185250.00")]
    assert rows_of(analytics.revenue_by_category(clean_tables(spark, name))) == newer
    spark.sql(f"USE {name}")
    try:
        assert [tuple(map(str, r)) for r in spark.sql(sql_questions.QUESTIONS["revenue_by_category"]).collect()] == [("Electronics", "2", "3", "185250.00")]
        assert spark.sql("SELECT count(*) FROM processed_orders_all").first()[0] == 3
    finally:
        spark.sql("USE default")
    # An older run that is published again stays the older one; a pointer back lasts until a newer run comes.
    clean_run(spark, CleanJob(f"{root}/raw", clean, FIRST, AS_OF, by_commit=by_commit))
    assert commits.snapshot(spark, clean).current == SECOND
    commits.point_to(spark, clean, FIRST)
    register_clean(spark, name, clean)
    assert rows_of(analytics.revenue_by_category(clean_tables(spark, name))) == [("Electronics", 1, 2, "123500.00")]
    with pytest.raises(KeyError):
        commits.point_to(spark, clean, THIRD)


def test_a_folder_without_commits_is_named_by_its_newest_run(spark, root):
    clean = two_runs(spark, root, False)
    for file in os.listdir(f"{clean}/_commits"):
        os.remove(f"{clean}/_commits/{file}")
    register_clean(spark, "t_no_commits", clean)
    assert spark.table("t_no_commits.processed_orders").count() == 2
    assert spark.table("t_no_commits.processed_orders_all").count() == 3


class Crash(BaseException):
    pass


@pytest.mark.parametrize("step", range(7))
def test_a_crash_at_any_step_leaves_the_old_run_or_the_new_one(spark, root, monkeypatch, step):
    """Steps: the five tables, the commit file created, the commit file written."""
    small_raw_run(f"{root}/raw", "20250406")
    job = CleanJob(f"{root}/raw", f"{root}/clean", FIRST, AS_OF, by_commit=True)
    clean_run(spark, job)
    write_text(f"{root}/raw", "orders", "orders_20250406.csv", [ORDER_HEAD, order_line(1), order_line(2)])
    left = [step]

    def counting(real, torn=False):
        def wrapped(*args, **named):
            if left[0] == 0 and torn:  # the file is there, its text is cut short
                args = (*args[:3], args[3][:20])
                real(*args, **named)
            if left[0] == 0:
                raise Crash
            left[0] -= 1
            return real(*args, **named)
        return wrapped

    monkeypatch.setattr(clean_zone, "_write_judged", counting(clean_zone._write_judged))
    monkeypatch.setattr(commits, "_create", counting(commits._create, torn=step == 6))
    if step == 6:
        left[0] = 5
    with pytest.raises(Crash):
        clean_run(spark, job)
        if step == 6:
            raise AssertionError("not reached")
    monkeypatch.undo()
    old = [read_published(spark, job.clean_root, f"processed_{t}").count() for t in ("orders", "order_items")]
    assert old == [1, 1]
    clean_run(spark, job)  # the next attempt is not held up by what the crash left
    assert [read_published(spark, job.clean_root, f"processed_{t}").count() for t in ("orders", "order_items")] == [2, 2]


def test_of_two_writers_of_a_run_one_fails(spark, root):
    seen = commits.snapshot(spark, root).number
    commits.commit(spark, root, commits.RUN, "2025-04-06", {"t": "a"}, seen)
    with pytest.raises(commits.CommitConflict):
        commits.commit(spark, root, commits.RUN, "2025-04-06", {"t": "b"}, seen)
    assert commits.commit(spark, root, commits.RUN, "2025-04-13", {"t": "c"}, seen) == 2  # another run goes on
    state = commits.snapshot(spark, root)
    assert state.runs == {FIRST: {"t": "a"}, SECOND: {"t": "c"}} and state.current == SECOND
    assert [json.load(open(f"{root}/_commits/{f}"))["kind"] for f in sorted(os.listdir(f"{root}/_commits")) if f.endswith(".json")] == ["run", "run"]


def test_replaced_versions_can_be_removed(spark, root):
    small_raw_run(f"{root}/raw", "20250406")
    job = CleanJob(f"{root}/raw", f"{root}/clean", FIRST, AS_OF, by_commit=True)
    for _ in range(2):
        clean_run(spark, job)
    assert len(os.listdir(f"{root}/clean/_versions")) == 2
    assert commits.remove_unpublished(spark, job.clean_root, dt.datetime.now() - dt.timedelta(days=1)) == []
    assert len(commits.remove_unpublished(spark, job.clean_root, dt.datetime.now() + dt.timedelta(days=1))) == 1
    assert read_published(spark, job.clean_root, "processed_orders").count() == 1


def test_an_empty_or_unsound_run_is_refused(spark, root):
    small_raw_run(f"{root}/raw", "20250406")
    job = CleanJob(f"{root}/raw", f"{root}/clean", FIRST, AS_OF)
    clean_run(spark, job)
    with pytest.raises(quality.CheckFailed, match="categories has exactly 7"):
        clean_run(spark, CleanJob(f"{root}/raw", f"{root}/clean", FIRST, AS_OF, expected=(7, 49)))
    clean_run(spark, CleanJob(f"{root}/raw", f"{root}/clean", FIRST, AS_OF, expected=(1, 1)))
    with pytest.raises(RunRefused, match="orders, order_items"):
        clean_run(spark, CleanJob(f"{root}/raw", f"{root}/clean", FIRST, dt.date(2020, 1, 1)))
    assert read_published(spark, job.clean_root, "processed_orders").count() == 1


def test_raw_names_have_the_run_and_open_its_files_only(spark, root):
    small_raw_run(root, "20250406")
    os.makedirs(f"{root}/orders/run_date=2025-04-13")
    write_text(f"{root}/orders", "run_date=2025-04-13", "part-0.csv", [ORDER_HEAD, order_line(7), order_line(8)])
    write_text(root, "orders", "other.csv", [ORDER_HEAD, order_line(99)])
    register_raw(spark, "t_raw_names", root)
    found = spark.sql("SELECT run_date, count(*) FROM t_raw_names.orders GROUP BY ALL").collect()
    assert {tuple(r) for r in found} == {(FIRST, 3), (SECOND, 2), (None, 1)}
    one = spark.sql("SELECT order_id FROM t_raw_names.orders WHERE run_date = DATE '2025-04-13'")
    assert sorted(r[0] for r in one.collect()) == ["7", "8"]
    scan = one._jdf.queryExecution().executedPlan().collectLeaves().apply(0)
    assert scan.metrics().get("numFiles").get().value() == 1


def test_the_ledger_finds_late_rows_once_and_survives_a_restart(spark, root):
    raw, target = f"{root}/raw", f"{root}/loaded"
    write_text(raw, "orders", "orders_20250406.csv", [ORDER_HEAD, *[order_line(i, "2025-04-03") for i in range(4)]])
    new = lambda: ledger_of(spark, raw, "orders", target)
    assert [(r["rows"], r["late_rows"]) for r in new().load()] == [(4, 0)]
    assert new().load() == []
    write_text(raw, "orders", "more+or 5%25_20250413.csv", [ORDER_HEAD, order_line(9, "2025-04-10"), order_line(8, "2025-04-01"), "x,1,,UPI,completed,,"])
    assert [(r["rows"], r["late_rows"], r["mark"]) for r in new().load()] == [(3, 1, dt.datetime(2025, 4, 10, 9, 30))]
    assert new().mark() == dt.datetime(2025, 4, 10, 9, 30)
    ids = lambda: sorted((r[0] is None, r[0]) for r in new().rows().select("order_id").collect())
    assert [i for _, i in ids()] == [0, 1, 2, 3, 8, 9, None]
    write_text(raw, "orders", "orders_20250406.csv", [ORDER_HEAD, *[order_line(i, "2025-04-03") for i in range(5)]])
    os.remove(f"{raw}/orders/more+or 5%25_20250413.csv")
    assert [(r["files"], r["retracted"], r["rows"]) for r in new().load()] == [(1, 1, 5)]
    assert [i for _, i in ids()] == [0, 1, 2, 3, 4]
    os.remove(f"{raw}/orders/orders_20250406.csv")
    assert [(r["files"], r["retracted"]) for r in new().load()] == [(0, 1)]
    assert ids() == [] and new().mark() is None
    with pytest.raises(ValueError, match="no created_at"):
        ledger_of(spark, raw, "products", target)


def test_of_two_loads_at_once_one_fails_and_leaves_nothing(spark, root, monkeypatch):
    write_text(f"{root}/raw", "orders", "orders_20250406.csv", [ORDER_HEAD, order_line(1)])
    ledger = ledger_of(spark, f"{root}/raw", "orders", f"{root}/loaded")
    real, other = commits.commit, ledger_of(spark, f"{root}/raw", "orders", f"{root}/loaded")

    def second_comes_first(*args, **named):
        monkeypatch.setattr(ledger_module.commits, "commit", real)
        other.load()
        return real(*args, **named)

    monkeypatch.setattr(ledger_module.commits, "commit", second_comes_first)
    with pytest.raises(commits.CommitConflict):
        ledger.load()
    assert ledger.rows().count() == 1 and len(os.listdir(f"{root}/loaded/orders/_versions")) == 1


def test_files_are_loaded_in_batches(spark, root, monkeypatch):
    monkeypatch.setattr(ledger_module, "FILES_PER_COMMIT", 2)
    for i in range(5):
        write_text(f"{root}/raw", "orders", f"orders_2025040{i + 1}.csv", [ORDER_HEAD, order_line(i)])
    ledger = ledger_of(spark, f"{root}/raw", "orders", f"{root}/loaded")
    assert [r["files"] for r in ledger.load()] == [2, 2, 1] and ledger.rows().count() == 5


def test_drift_is_seen_per_run_and_column(spark, root):
    write_text(root, "orders", "orders_20250406.csv", [ORDER_HEAD, order_line(1), order_line(2)])
    write_text(root, "orders", "orders_20250413.csv", [
        "order_id,customer_id,order_date,order_status,created_at,updated_at,gift", "9999999999,1.5,2025-04-01 10:00,7,2025-04-01 09:30:00,,true"])
    write_text(root, "orders", "orders_20250420.csv", ["order_id,order_status"])
    columns = drift.run_columns(spark, f"{root}/orders")
    found = {(r["run_date"], r["column_name"]): (r["change"], r["found_type"]) for r in drift.changes(columns).collect()}
    assert {c: found[SECOND, c] for (d, c) in found if d == SECOND} == {
        "order_id": ("widened", "bigint"), "customer_id": ("widened", "double"), "order_date": ("widened", "timestamp"), "payment_method": ("lost", None),
        "order_status": ("narrowed", "int"), "created_at": ("moved", "timestamp"), "updated_at": ("narrowed", "void"), "gift": ("added", "boolean")}
    assert found[THIRD, "order_id"] == ("narrowed", "void") and found[THIRD, "gift"] == ("lost", None)
    merged = {r["column_name"]: r["merged_type"] for r in columns.where(F.col("run_date") == F.lit(SECOND)).collect()}
    assert merged["order_status"] == "string" and merged["order_date"] == "timestamp" and merged["customer_id"] == "double"


def test_files_of_one_run_that_disagree_are_merged(spark, root):
    write_text(root, "t", "t_20250406.csv", ["a,b", "1,2025-01-01", ",x"])
    write_text(root, "t", "u_20250406.csv", ["b,a", "2025-01-02,2.5"])
    found = {r["column_name"]: (r["found_type"], r["cells"]) for r in drift.run_columns(spark, f"{root}/t").collect()}
    assert found == {"a": ("double", 2), "b": ("string", 3)}


def test_bitmaps_count_as_distinct_does(spark):
    rows = spark.range(-5, 60_000, 3).selectExpr("id % 7 AS k", "id", "-id * 40000 AS other").unionByName(
        spark.range(-5, 60_000, 3).selectExpr("id % 7 AS k", "id", "CAST(NULL AS BIGINT) AS other"))
    kept = distinct.bitmaps(rows, ["k"], "id", "other")
    plain = rows.groupBy("k").agg(F.count_distinct("id").alias("n"), F.count_distinct("other").alias("m"))
    found = distinct.counts(kept, ["k"], n="id", m="other")
    assert sorted(found.collect()) == sorted(plain.collect())
    assert distinct.counts(kept, [], n="id").first()["n"] == rows.select("id").distinct().count()
    assert "Expand" not in found._jdf.queryExecution().executedPlan().toString()
    assert distinct.counts(distinct.bitmaps(rows.where("false"), ["k"], "id"), ["k"], n="id").count() == 0


def test_kept_answers_equal_a_recount_and_read_the_changed_run_only(spark, root, clean_tables):
    def stored(name, tables):
        return tables.having(**{t: (df.write.parquet(f"{root}/{name}/{t}"), spark.read.parquet(f"{root}/{name}/{t}"))[1] for t, df in tables.items()})

    shifted = clean_tables.having(
        orders=clean_tables.orders.withColumn("order_id", F.col("order_id") + 100),
        order_items=clean_tables.order_items.withColumns({"order_id": F.col("order_id") + 100, "quantity": F.col("quantity") * 2}))
    first, second = stored("first", clean_tables), stored("second", shifted)
    answers = KeptAnswers(spark, f"{root}/kept")
    with pytest.raises(KeyError):
        answers.payment_split()
    answers.refresh(FIRST, second)  # wrong
    answers.refresh(SECOND, second)
    answers.refresh(FIRST, first)  # taken back
    both = first.having(orders=first.orders.unionByName(second.orders), order_items=first.order_items.unionByName(second.order_items))
    for name, question in analytics.QUESTIONS.items():
        assert rows_of(getattr(answers, name)()) == rows_of(question(both)), name
    from bazaarlake.plans.kept_answers import partials
    read = {f for df in partials(first).values() for f in df.inputFiles()}
    assert read and all("/first/" in f for f in read)


def test_hand_made_tables_have_no_published_run(spark):
    tables = hand_made(spark)
    assert tables.asked() is tables
