"""Quality rules whose thresholds come from the corpus itself, per language and source.

Each document is measured; each measure is a whole number.  A sketch is a count per bucket of a
log-linear scale (exact below 32, then 32 buckets for each power of two, so a quantile is off by at
most 1/32 of its value).  Sketches merge by adding counts, so they are plain grouped sums: partial
in every task, then by (language, source), and from those by language and over all.  A group of too
few documents uses its language's sketch, and a small language the one over all.

The bounds of a measure are the quartiles moved out by `fences` times their distance, or by
`fences` times the measure's least spread where the quartiles lie closer.  Documents meet their
group's bounds in a join, and one outside any bound is rejected, as is one that fails the fixed base
rule (under 20 words, or over 30 % of the words in repeated windows).

Defined cases: a null text has no words and fails the base rule; a null language or source is a
value like any other; rows with equal ids or repeated whole are measured and judged one by one; an
empty table gives no rows; very long texts are measured whole.  Other columns are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from bazaarlake.llm.common import written

MIN_WORDS = 20
MAX_REPEATED_PERCENT = 30
WINDOW_WORDS = 8
SYMBOLS = "#*$%&|<>"
_SPACE = b" \t\n\r\x0b\x0c"

#: Measure: its value from the counts, and the least spread that its bounds allow for.
MEASURES = {
    "symbols_per_mille": ("n_symbols * 1000 div greatest(word_chars, 1)", 20),
    "word_length_percent": ("word_chars * 100 div greatest(n_words, 1)", 100),
    "dup_lines_per_mille": ("n_dup_lines * 1000 div greatest(n_lines, 1)", 120),
    "repeats_per_mille": ("n_repeat_words * 1000 div greatest(n_words, 1)", 100),
    "capitals_per_mille": ("n_capitals * 1000 div greatest(word_chars, 1)", 50),
}
LOWER_TOO = {"word_length_percent"}
FENCES = 3
GROUP_ROWS = 200

COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_capitals")


def repeated_words(words: list[bytes], width: int = WINDOW_WORDS) -> int:
    """Words that lie in a window of so many words that occurs twice or more."""
    if len(words) <= width:
        return 0
    code = np.fromiter(map(hash, words), np.int64, len(words)).astype(np.uint64)
    windows = np.zeros(len(words) - width + 1, np.uint64)
    for k in range(width):
        windows = windows * np.uint64(0x9E3779B97F4A7C15) + code[k:k + len(windows)]
    ordered = np.sort(windows)
    if not (ordered[1:] == ordered[:-1]).any():  # equal windows have equal codes
        return 0
    numbers: dict[bytes, int] = {}
    code = np.fromiter((numbers.setdefault(w, len(numbers)) for w in words), np.int64, len(words))
    span = 1
    while span < width:  # exact numbers of windows of 2, 4, 8 words
        step = min(span, width - span)
        code = np.unique(code[:-step] * (code.max() + 1) + code[step:], return_inverse=True)[1]
        span += step
    repeated = np.bincount(code)[code] > 1
    edges = np.zeros(len(words) + 1, np.int64)
    np.add.at(edges, np.flatnonzero(repeated), 1)
    np.add.at(edges, np.flatnonzero(repeated) + width, -1)
    return int((np.cumsum(edges) > 0).sum())


def counts_of(text: str | None) -> tuple[int, ...]:
    """In the order of COUNTS."""
    if not text:
        return (0,) * len(COUNTS)
    raw = text.encode("utf-8", "surrogatepass")
    words = raw.split()
    lines = [x for x in raw.split(b"\n") if x.strip(_SPACE)]
    spaces = sum(raw.count(c) for c in (b" ", b"\t", b"\n", b"\r", b"\x0b", b"\x0c"))
    letters = np.frombuffer(raw, np.uint8)
    return (len(words), len(text) - spaces, sum(text.count(c) for c in SYMBOLS), len(lines) - len(set(lines)),
            repeated_words(words), len(lines), int(((letters >= 65) & (letters <= 90)).sum()))


def measured(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
             source_col: str = "source") -> DataFrame:
    """Columns id, lang, source and COUNTS, a row per document."""

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = list(zip(*(counts_of(t.as_py()) for t in batch.column(3)))) or [()] * len(COUNTS)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:3], *(pa.array(c, pa.int64()) for c in columns)], names=["id", "lang", "source", *COUNTS])

    kinds = {c: docs.schema[c].dataType.simpleString() for c in (id_col, lang_col, source_col)}
    return docs.select(id_col, lang_col, source_col, text_col).toDF("id", "lang", "source", "body").mapInArrow(
        measure, f"id {kinds[id_col]}, lang {kinds[lang_col]}, source {kinds[source_col]}, "
        + ", ".join(f"{c} long" for c in COUNTS))


def bucket(value: Column) -> Column:
    """Log-linear bucket of a whole number from 0."""
    power = F.greatest(F.length(F.bin(value)) - F.lit(6), F.lit(0)).cast("int")
    return (power * 32 + F.call_function("shiftright", value, power)).cast("int")


def bucket_value(number: Column) -> Column:
    """Least value of a bucket."""
    power = F.greatest(F.floor(number / 32) - 1, F.lit(0)).cast("int")
    return F.call_function("shiftleft", (number - power * 32).cast("long"), power)


def sketches(counts: DataFrame) -> DataFrame:
    """Rows lang, source, measure, bucket, n: the sketch of each measure of each group."""
    measures = F.explode(F.array(*(
        F.struct(F.lit(name).alias("measure"), F.expr(value).cast("long").alias("value")) for name, (value, _) in MEASURES.items())))
    return (counts.where(F.col("n_words") >= MIN_WORDS).select("lang", "source", measures.alias("m"))
            .groupBy("lang", "source", "m.measure", bucket(F.col("m.value")).alias("bucket")).agg(F.count("*").alias("n")))


def bounds(sketch: DataFrame, by: list[str], fences: int = FENCES) -> DataFrame:
    """For each group: its number of documents and a low and a high bound of every measure, from the merged sketches."""
    merged = sketch.groupBy(*by, "measure", "bucket").agg(F.sum("n").alias("n"))
    whole = Window.partitionBy(*by, "measure")
    ranked = merged.withColumn("upto", F.sum("n").over(whole.orderBy("bucket"))).withColumn("total", F.sum("n").over(whole))

    def quantile(numerator: int, measure: str) -> Column:
        reached = F.col("upto") * 4 >= F.col("total") * numerator
        return bucket_value(F.min(F.when((F.col("measure") == measure) & reached, F.col("bucket"))))

    columns = [F.max("total").alias("rows")]
    for name, (_, least) in MEASURES.items():
        low, high = quantile(1, name), quantile(3, name)
        room = F.greatest(high - low, F.lit(least)) * fences
        columns.append((high + room).alias(f"{name}_high"))
        if name in LOWER_TOO:
            columns.append((low - room).alias(f"{name}_low"))
    return ranked.groupBy(*by).agg(*columns)


def judged(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
           source_col: str = "source", fences: int = FENCES, group_rows: int = GROUP_ROWS) -> DataFrame:
    """Columns id_col, lang_col, source_col, COUNTS, base_failed, broken (the measures out of bounds), kept."""
    counts = written(measured(docs, id_col, text_col, lang_col, source_col), "quality")
    sketch = written(sketches(counts), "quality")
    own, by_lang, overall = bounds(sketch, ["lang", "source"], fences), bounds(sketch, ["lang"], fences), bounds(sketch, [], fences)
    # One bound per group of two columns: these tables have a row per group, not per document.
    names = [c for c in overall.columns if c != "rows"]
    groups = sketch.select("lang", "source").distinct()
    chosen = (
        groups.alias("g")
        .join(own.alias("o"), F.expr("g.lang <=> o.lang and g.source <=> o.source"), "left")
        .join(by_lang.alias("l"), F.expr("g.lang <=> l.lang"), "left")
        .crossJoin(F.broadcast(overall).alias("a"))  # a single row
        .select("g.lang", "g.source", *(
            F.when(F.col("o.rows") >= group_rows, F.col(f"o.{c}")).when(F.col("l.rows") >= group_rows, F.col(f"l.{c}"))
            .otherwise(F.col(f"a.{c}")).alias(c) for c in names))
    )
    joined = counts.alias("d").join(chosen.alias("b"), F.expr("d.lang <=> b.lang and d.source <=> b.source"), "left")
    broken = [
        F.when((F.expr(value) > F.col(f"{name}_high")) | (F.expr(value) < F.col(f"{name}_low") if name in LOWER_TOO else F.lit(False)), F.lit(name))
        for name, (value, _) in MEASURES.items()]
    failed = (F.col("n_words") < MIN_WORDS) | (F.col("n_repeat_words") * 100 > F.col("n_words") * MAX_REPEATED_PERCENT)
    return joined.select(
        F.col("d.id").alias(id_col), F.col("d.lang").alias(lang_col), F.col("d.source").alias(source_col), *COUNTS,
        failed.alias("base_failed"), F.array_compact(F.array(*broken)).alias("broken"),
    ).withColumn("kept", ~F.col("base_failed") & (F.size("broken") == 0))
