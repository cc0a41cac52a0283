"""How far the sources of a language differ in their terms: an exact audit.

Terms (runs of letters and non-ASCII characters, A to Z lowered) are counted in numpy, slice by slice of the
documents: short ones as one or two unsigned 64-bit words that are radix-sorted and run-counted, long ones
in byte-sorted buckets (see `terms`).  Spark adds the counts of all slices.  A language keeps the V terms that occur in
at least `min_docs` of its documents.  With N kept occurrences in a group (a source, or the whole language) a term
seen `count` times has p = 1 + floor(SCALE * (count + 2) / (N + 2 * V)); two groups differ by
floor((p - q)^2 / (p + q)) in a term.

`pairs` gives each two sources of a language their sum over all kept terms.  The terms of a language are dealt
to blocks by a hash; a task holds the sources of one block as rows of an array and adds up the differences of
each two rows, so neither a language nor a term is ever in one task whole.  `leading` gives the terms by which a
source differs most from its language, of those it uses more.

All arithmetic is on integers: counts in 64 bits, products in decimals of 38 digits.

Defined cases: null text, language and source are empty strings; a text without letters has no terms, but its
group is there; a language without kept terms has differences of 0; rows with equal ids or repeated whole are
documents of their own; a very long text is counted whole, by itself; an empty table gives no rows.  Other
columns are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from bazaarlake.llm import terms as packed
from bazaarlake.llm.common import written

MIN_DOCS = 10
SCALE = 1_000_000_000
TOP = 10
SLICE_BYTES = 8 << 20
SLICE_DOCS = 1 << 16
#: Kept terms of one block of a language, about.
BLOCK_TERMS = 4096
#: Cells of two rows' differences formed at once.
CELLS_AT_ONCE = 1 << 20

COUNTS = "lang string, source string, term string, n long, docs long"


def _group(docs: DataFrame, lang_col: str, source_col: str) -> list[Column]:
    return [F.coalesce(F.col(c).cast("string"), F.lit("")).alias(name) for c, name in ((lang_col, "lang"), (source_col, "source"))]


def counted(rows: pa.RecordBatch) -> pa.RecordBatch:
    """Per language, source and term of the rows lang, source, text: occurrences and documents that hold it."""
    langs, sources = rows.column(0).dictionary_encode(), rows.column(1).dictionary_encode()
    wide = max(len(sources.dictionary), 1)
    group = langs.indices.to_numpy().astype(np.int64) * wide + sources.indices.to_numpy()
    found = packed.terms_of(*packed.text_bytes(rows.column(2)), packed.LETTERS)
    firsts, ns, in_docs = [], [], []
    for which, fresh in packed.grouped(found, group[found.text]):
        begins = np.flatnonzero(fresh)
        text = found.text[which]
        other = fresh.copy()
        other[1:] |= text[1:] != text[:-1]
        firsts.append(which[begins])
        ns.append(np.diff(np.append(begins, len(which))))
        in_docs.append(np.add.reduceat(other.astype(np.int64), begins))
    first = np.concatenate(firsts) if firsts else np.empty(0, np.int64)
    of = group[found.text[first]]
    none = np.empty(0, np.int64)
    return pa.RecordBatch.from_arrays(
        [langs.dictionary.take(pa.array(of // wide)), sources.dictionary.take(pa.array(of % wide)),
         pc.cast(found.strings(first), pa.string()), pa.array(np.concatenate(ns) if ns else none),
         pa.array(np.concatenate(in_docs) if in_docs else none)],
        names=["lang", "source", "term", "n", "docs"])


def term_counts(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", source_col: str = "source") -> DataFrame:
    """Columns lang, source, term, n (occurrences), docs (documents): all documents."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in packed.slices(batches, 2, SLICE_BYTES, SLICE_DOCS):
            yield counted(rows)

    body = F.coalesce(F.col(text_col), F.lit("")).alias("body")
    return docs.select(*_group(docs, lang_col, source_col), body).mapInArrow(count, COUNTS).groupBy("lang", "source", "term").agg(
        F.sum("n").alias("n"), F.sum("docs").alias("docs"))


def _share(n: Column, total: Column, kept: Column) -> Column:
    """1 + floor(SCALE * (n + 2) / (total + 2 * kept)), exact."""
    wide = lambda c: c.cast("decimal(20,0)")
    return F.lit(1).cast("long") + F.call_function(
        "div", F.lit(SCALE).cast("decimal(10,0)") * wide(n + 2), wide(total + 2 * kept))


class Audit:
    """Counts of one corpus, written once; both reports read them."""

    def __init__(self, docs: DataFrame, text_col: str = "text", lang_col: str = "lang", source_col: str = "source",
                 min_docs: int = MIN_DOCS):
        of_lang = Window.partitionBy("lang", "term")
        counts = term_counts(docs, text_col, lang_col, source_col).select(
            "lang", "source", "term", "n", F.sum("docs").over(of_lang).alias("lang_docs"), F.sum("n").over(of_lang).alias("lang_n"),
            (F.min("source").over(of_lang) == F.col("source")).alias("leads"))
        self.kept = written(counts.where(F.col("lang_docs") >= min_docs).drop("lang_docs"), "audit-terms")
        totals = self.kept.groupBy("lang", "source").agg(F.sum("n").alias("total"), F.sum(F.col("leads").cast("long")).alias("led"))
        groups = docs.select(*_group(docs, lang_col, source_col)).distinct().join(totals, ["lang", "source"], "left").fillna(0, ["total", "led"])
        langs = groups.groupBy("lang").agg(F.sum("total").alias("lang_total"), F.sum("led").alias("terms"))
        #: lang, source, total (kept occurrences), lang_total, terms (V)
        self.groups = written(groups.drop("led").join(langs, "lang"), "audit-groups")

    def pairs(self) -> DataFrame:
        """Columns lang, source, item (another source), value."""
        blocks = F.greatest(F.ceil(F.col("terms") / BLOCK_TERMS), F.lit(1)).cast("int")
        sizes = self.groups.select("lang", "source", "total", "terms", blocks.alias("blocks"))
        rows = self.kept.join(sizes, ["lang", "source"]).select(
            "lang", F.pmod(F.xxhash64("term"), F.col("blocks")).cast("int").alias("block"), "source", "term",
            _share(F.col("n"), F.col("total"), F.col("terms")).alias("p"))
        every = sizes.select(
            "lang", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"), "source",
            F.when(F.col("terms") > 0, _share(F.lit(0), F.col("total"), F.greatest(F.col("terms"), F.lit(1)))).otherwise(0).alias("unseen"))

        def differ(these: pa.Table, sources: pa.Table) -> pa.Table:
            sources = sources.sort_by("source")
            names = sources.column("source").combine_chunks()
            terms = these.column("term").combine_chunks().dictionary_encode()
            p = np.repeat(sources.column("unseen").to_numpy()[:, None], len(terms.dictionary), axis=1)
            row = pc.index_in(these.column("source"), names).to_numpy()
            p[row, terms.indices.to_numpy()] = these.column("p").to_numpy()
            step = max(1, CELLS_AT_ONCE // max(p.shape[1], 1))
            a, b, value = [], [], []
            for i in range(len(p)):
                for first in range(i + 1, len(p), step):
                    others = p[first:first + step]
                    apart = others - p[i]
                    value.append((apart * apart // np.maximum(others + p[i], 1)).sum(axis=1))
                    a.append(np.full(len(others), i))
                    b.append(np.arange(first, first + len(others)))
            a, b, value = (np.concatenate(x) if x else np.empty(0, np.int64) for x in (a, b, value))
            lang = sources.column("lang")[0].as_py()
            return pa.table({"lang": pa.array([lang] * len(a), pa.string()), "source": names.take(pa.array(a)),
                             "item": names.take(pa.array(b)), "value": pa.array(value, pa.int64())})

        once = rows.groupBy("lang", "block").cogroup(every.groupBy("lang", "block")).applyInArrow(
            differ, "lang string, source string, item string, value long").groupBy("lang", "source", "item").agg(F.sum("value").alias("value"))
        both = F.array(F.struct("source", "item"), F.struct(F.col("item").alias("source"), F.col("source").alias("item")))
        return once.select("lang", F.explode(both).alias("x"), "value").select("lang", "x.source", "x.item", "value")

    def leading(self) -> DataFrame:
        """Columns lang, source, item (a kept term), value: the terms that a source uses more than its language."""
        p = _share(F.col("n"), F.col("total"), F.col("terms"))
        q = _share(F.col("lang_n"), F.col("lang_total"), F.col("terms"))
        rows = self.kept.join(self.groups, ["lang", "source"]).select("lang", "source", F.col("term").alias("item"), p.alias("p"), q.alias("q"))
        apart = F.col("p") - F.col("q")
        return rows.where("p > q").select("lang", "source", "item", F.call_function("div", apart * apart, F.col("p") + F.col("q")).alias("value"))

    def report(self, top: int = TOP) -> DataFrame:
        """Columns lang, source, part, item, value, rank: all other sources of a source, and its leading terms."""
        order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
        ranked = lambda df, part: df.select("lang", "source", F.lit(part).alias("part"), "item", "value", F.row_number().over(order).alias("rank"))
        return ranked(self.pairs(), "pair").unionByName(ranked(self.leading(), "term").where(F.col("rank") <= top))
