"""The stages on given documents and on a small fixture with known results."""

import corpus_pipeline
import pyarrow as pa
import pytest
from bazaarlake.llm.common import FILES_PER_CORE, in_few_files, written
from bazaarlake.llm.packing import CAPACITY
from pyspark.sql import functions as F

from .conftest import EDGE_TEXTS, SF
from .test_near_and_lines import plain_classes, plain_removed
from .test_text_judges import plain_spans


@pytest.fixture(scope="module")
def after(spark, given, tmp_path_factory):
    """The input of each stage and the result of the last, as `run` makes them."""
    frames = [given]
    for name, stage in corpus_pipeline.STAGES:
        folder = str(tmp_path_factory.mktemp("pipeline") / name)
        stage(spark, frames[-1], SF).write.parquet(folder)
        frames.append(spark.read.parquet(folder))
    return frames


def test_stage_names_and_columns(after, given):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "line_dedup", "near_dedup", "secret_scan", "packing"]
    for frame in after[1:-1]:
        assert frame.columns == given.columns and [f.dataType for f in frame.schema] == [f.dataType for f in given.schema]


def test_toxic_documents_go_and_clean_ones_stay(spark, after):
    marks = spark.read.parquet(f"{SF}/labels.parquet")
    kept = {r["doc_id"] for r in after[1].select("doc_id").collect()}
    labels = dict(marks.select("doc_id", "toxic").collect())
    clean = [d for d, toxic in labels.items() if not toxic]
    assert sum(d in kept for d in clean) >= 0.98 * len(clean)


def test_lines_go_as_by_brute_force(after):
    gone = plain_removed(after[1])
    texts = {r["doc_id"]: r for r in after[2].collect()}
    for r in after[1].collect():
        lines = r["text"].split("\n") if r["text"] is not None else None
        want = lines and "\n".join(x for i, x in enumerate(lines) if i not in gone.get((r["doc_id"], r["text"]), []))
        assert (texts[r["doc_id"]]["text"] or "") == (want or "") and texts[r["doc_id"]]["n_chars"] == len(want or "")


def test_one_of_each_near_class_stays(after):
    rows = sorted(after[2].select("doc_id", "text").collect())
    with_words = [r for r in rows if (r["text"] or "").split()]
    classes = plain_classes([r["text"] for r in with_words])
    want = {r["doc_id"] for i, r in enumerate(with_words) if classes[i] == i} | {r["doc_id"] for r in rows if not (r["text"] or "").split()}
    assert {r["doc_id"] for r in after[3].select("doc_id").collect()} == want


def test_secrets_are_masked(after):
    before = dict(after[3].select("doc_id", "text").collect())
    for doc_id, text in after[4].select("doc_id", "text").collect():
        assert not plain_spans(text or "")
        if not plain_spans(before[doc_id] or "") and "[SECRET]" not in (text or ""):
            assert text == before[doc_id]


def test_all_documents_are_packed(after):
    rows = after[5].collect()
    assert {r["doc_id"] for r in rows} == {r["doc_id"] for r in after[4].select("doc_id").collect()}
    filled = {}
    for r in rows:
        filled[r["sequence_id"]] = filled.get(r["sequence_id"], 0) + r["length"]
    assert max(filled.values()) <= CAPACITY


@pytest.mark.parametrize("number", range(4))
def test_stages_take_odd_rows_and_nothing(spark, edge, none, number):
    stage = corpus_pipeline.STAGES[number][1]
    out = stage(spark, edge, SF)
    assert out.columns == edge.columns and out.count() <= len(EDGE_TEXTS) + 1
    assert stage(spark, none, SF).count() == 0


def test_run_gives_the_last_stage(spark, after):
    assert corpus_pipeline.run(spark, SF).count() == after[5].count()


def test_small_tables_are_written_in_few_files(spark, conf):
    conf(spark__sql__shuffle__partitions="200", spark__sql__adaptive__coalescePartitions__enabled="false")
    counted = lambda rows: spark.range(rows).groupBy((F.col("id") % 1000).alias("k")).agg(F.count("*").alias("n"))
    out = written(counted(10_000), "test-few-files")
    assert len(out.inputFiles()) <= FILES_PER_CORE * spark.sparkContext.defaultParallelism
    assert sorted(map(tuple, out.collect())) == [(k, 10) for k in range(1000)]
    large = counted(200 * (2 << 20) // 8)
    assert in_few_files(large) is large


def test_stages_take_small_arrow_batches(spark, conf, given):
    def sizes(batches):
        for batch in batches:
            yield pa.RecordBatch.from_pydict({"rows": [batch.num_rows], "bytes": [batch.nbytes]})

    def met(docs):
        rows = docs.repartition(1).mapInArrow(sizes, "rows long, bytes long").collect()
        return sum(r["rows"] for r in rows), max(r["rows"] for r in rows), max(r["bytes"] for r in rows)

    records, size = "spark.sql.execution.arrow.maxRecordsPerBatch", "spark.sql.execution.arrow.maxBytesPerBatch"
    conf(**{records.replace(".", "__"): "10000", size.replace(".", "__"): "67108864b"})
    corpus_pipeline.drop_toxic(spark, given, SF)
    assert met(spark.range(5000).select(F.col("id").cast("string").alias("text")))[:2] == (5000, 1000)
    long = spark.range(600).select(F.repeat(F.lit("text "), 10_000).alias("text"))
    rows, _, most = met(long)
    assert rows == 600 and most <= 8 << 20
    conf(**{records.replace(".", "__"): "2000"})  # what a session has set stays
    corpus_pipeline.drop_toxic(spark, given, SF)
    assert spark.conf.get(records) == "2000"
