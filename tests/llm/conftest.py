import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))

from bazaarlake.llm.common import importable  # noqa: E402

SF = "/root/testdata/sf0.001"
# Names that the operators use themselves, and one that differs from a column by case only.
CLASHING = ["id", "body", "key", "h", "m", "t", "u", "node", "line", "part", "size", "shard", "slot", "base", "spans", "score",
            "__text", "__removed", "__row", "__row_2", "__line_id", "__line_key", "__new", "__score", "removed", "class", "scanned", "dealt"]
LONG = "word " * 30_000 + "end " * 10 + "x" * 20_000
EDGE_TEXTS = [
    None, "", " \n\t ", "one", "two words", "same line that is long enough\nsame line that is long enough", "é" * 50, "中文 \U0001f600 text",
    "token = \"0123456789abcdef0123456789abcdef\" and more", LONG, "repeated row text with some words in it", "repeated row text with some words in it",
]


@pytest.fixture(scope="session", autouse=True)
def workers(spark):
    importable(spark)


def documents(spark, texts, first_id=0, extra=()):
    rows = [(None if i == 3 else first_id + i, t, "en" if i % 2 else None, None if i % 3 else "s", None if t is None else len(t))
            + tuple(f"{c}{i}" for c in extra) for i, t in enumerate(texts)]
    rows += rows[-1:]  # a row repeated whole
    kinds = "doc_id long, text string, lang string, source string, n_chars long" + "".join(f", `{c}` string" for c in extra)
    return spark.createDataFrame(rows, kinds)


@pytest.fixture(scope="session")
def edge(spark):
    """Nulls in every column, empty and very long texts, repeated rows, clashing columns."""
    return documents(spark, EDGE_TEXTS, extra=CLASHING).cache()


@pytest.fixture(scope="session")
def none(spark, edge):
    return edge.limit(0)


@pytest.fixture(scope="session")
def given(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


def labels_of(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int")
