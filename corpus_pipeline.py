"""A training corpus from `documents`: toxic documents out, repeated lines out, near copies out, secrets masked, packed.

Each stage takes (spark, docs, sf_dir) and returns a frame; `run` writes it as Parquet in the shared folder and
reads it again for the next one.  All stages but the last return the columns of `documents`; where a stage changes
a text, n_chars follows it.

Defined cases: a null text stays null and is packed as an empty one; null and empty texts get the toxicity score of a
document without features, and all texts without a word pass near dedup; very long texts go through whole and are cut
only by the packing, into pieces; rows repeated whole come out of line dedup alike, and near dedup keeps one of them if they still hold a word; an empty table gives no rows; other columns
stay up to the packing, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from bazaarlake.llm import line_dedup, order_minhash, packing, secrets, toxicity
from bazaarlake.llm.common import fold, free_name, importable, in_few_files, small_batches, table, written
from bazaarlake.llm.queries import WORD_TOKENIZER, vocabulary

TOXIC_FROM = 0.5


def _with_text(docs: DataFrame, text: Column) -> DataFrame:
    """The documents with another text, and with its length in n_chars where it differs."""
    new = free_name(docs, "__new")
    changed = ~F.col(new).eqNullSafe(F.col("text"))
    return docs.withColumn(new, text).withColumn(
        "n_chars", F.when(changed, F.length(new)).otherwise(F.col("n_chars")).cast(docs.schema["n_chars"].dataType)).withColumn(
        "text", F.col(new)).drop(new)


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier scores below one half; it learns from the labelled documents of the input."""
    importable(spark)
    small_batches(spark)
    model = toxicity.fit(docs, table(spark, sf_dir, "labels").where(fold("doc_id", 5) != 0))
    score = free_name(docs, "__score")
    return toxicity.scored(docs, model, score).where(F.col(score) < TOXIC_FROM).drop(score)


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document, without the lines that occur in an earlier one or earlier in itself."""
    removed = free_name(docs, "__removed")
    found = line_dedup.marked(docs, removed)
    return in_few_files(_with_text(found, line_dedup.text_without(F.col("text"), F.col(removed))).select(*docs.columns))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near copies.

    A document that the stage before left without any word is no copy of another: all of those stay.
    """
    importable(spark)
    small_batches(spark)
    wordless = ~F.coalesce(F.col("text"), F.lit("")).rlike(r"[^\x20\x09-\x0D]")
    return in_few_files(order_minhash.one_of_each(docs.where(~wordless)).unionByName(docs.where(wordless)))


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document, with what looks like a secret masked in its text."""
    base, spans = free_name(docs, "__base"), free_name(docs, "__spans")
    found = secrets.scanned(docs, secrets.fit(docs), base, spans)
    return _with_text(found, secrets.masked(F.col("text"), F.col(spans))).select(*docs.columns)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents, with the sequence and the offset at which each is placed."""
    importable(spark)
    small_batches(spark)
    return packing.pack(docs, vocabulary(WORD_TOKENIZER).decode())


STAGES = [
    ("toxicity", drop_toxic),
    ("line_dedup", drop_repeated_lines),
    ("near_dedup", drop_near_copies),
    ("secret_scan", mask_secrets),
    ("packing", pack_sequences),
]

#: Training a classifier, sketches and tokenizing are beyond SQL; tests compare with plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
