"""Ranked lexical search without random access: NRA over impact-sorted postings.

The documents are indexed in slices of bounded size, each a row of a written table: for every query term the
numbers of the documents that hold it and how often, and the documents' ids and lengths.  An index is
made for a block of queries at a time, with the terms of the block only; queries are dealt to blocks of about
`block_terms` terms by a hash of their id, so what goes to the tasks is bounded however many there are.

Within a slice each query term has a list of impacts (weight times saturated frequency), largest first.  A search
reads its lists in order, in rounds: each round reads every list down to half of the largest impact not yet read.
A document's score lies between the sum of its impacts read (lower) and that sum plus the next impact of every list in
which it was not seen (upper).  Reading goes on until the k documents with the largest lower bounds, ties by
id, cannot be overtaken, not by a tie either, and then, in the lists in which one of them was not seen,
until their own intervals are single values.  No posting is looked up by document.  The best k of all slices
are then ranked.

The score is in integers: a term's weight w is floor(1000 * ln((2N + 2) / (2 df + 1))), its impact
w * ((10^9 tf) div (1000 tf + 12 m)) with m = 75 + (25 n N) div L; N documents with terms, L terms in all, n of one.

Defined cases: a null text has no terms; queries of null or empty text, or with unknown terms alone, find nothing;
query rows of equal id are one query with the terms of all their different texts, null ids too; documents
with equal ids or repeated whole are ranked each for itself, null ids after the others; very long texts are indexed
whole, in a slice of their own; empty tables give no rows.  Other columns are not looked at.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from bazaarlake.llm import terms as packed
from bazaarlake.llm.common import groups_for, written

TOP = 20
SLICE_BYTES = 8 << 20
SLICE_DOCS = 1 << 14
#: Query terms, with repeats, of one block of queries, about.
BLOCK_TERMS = 200_000

_INDEX = "ids binary, known binary, sizes binary, terms binary, ends binary, docs binary, counts binary, document_terms array<struct<term: int, docs: long>>"


def indexed(rows: pa.RecordBatch, numbers: dict[str, int]) -> pa.RecordBatch:
    """One row for documents id, text, in the order of their ids: postings of the terms that have numbers."""
    rows = rows.take(pc.sort_indices(rows.column(0), null_placement="at_end"))
    ids = rows.column(0)
    found = packed.terms_of(*packed.text_bytes(rows.column(1)), packed.LETTERS_AND_DIGITS)
    sizes = np.bincount(found.text, minlength=len(ids))
    term_of, docs, counts = [], [], []
    for which, fresh in packed.grouped(found):
        begins = np.flatnonzero(fresh)
        names = found.strings(which[begins]).to_pylist()
        number = np.fromiter((numbers.get(name, -1) for name in names), np.int64, len(names))
        number = np.repeat(number, np.diff(np.append(begins, len(which))))
        text = found.text[which]
        fresh = fresh.copy()
        fresh[1:] |= text[1:] != text[:-1]
        begins = np.flatnonzero(fresh)
        wanted = number[begins] >= 0
        term_of.append(number[begins][wanted])
        docs.append(text[begins][wanted])
        counts.append(np.diff(np.append(begins, len(which)))[wanted])
    none = np.empty(0, np.int64)
    term_of, docs, counts = (np.concatenate(x) if x else none for x in (term_of, docs, counts))
    order = term_of.argsort(kind="stable")
    terms, begins = np.unique(term_of[order], return_index=True)
    ends = np.append(begins, len(order))
    of_terms = pa.StructArray.from_arrays([pa.array(terms, pa.int32()), pa.array(np.diff(ends), pa.int64())], names=["term", "docs"])
    binary = lambda x, kind: pa.array([np.asarray(x, kind).tobytes()], pa.binary())
    return pa.RecordBatch.from_arrays(
        [binary(pc.fill_null(ids, 0).to_numpy(zero_copy_only=False), "<i8"), binary(pc.is_valid(ids).to_numpy(zero_copy_only=False), np.uint8),
         binary(sizes, "<i8"), binary(terms, "<i4"), binary(ends, "<i4"), binary(docs[order], "<i4"), binary(counts[order], "<i4"),
         pa.ListArray.from_arrays(pa.array([0, len(terms)], pa.int32()), of_terms)],
        names=["ids", "known", "sizes", "terms", "ends", "docs", "counts", "document_terms"])


def weight(n_docs: int, in_docs: int) -> int:
    return math.floor(1000 * math.log((2 * n_docs + 2) / (2 * in_docs + 1)))


@dataclass
class ImpactLists:
    """Per known term a list of documents by falling impact; documents are numbered in the order of ties."""

    place: dict[int, int]
    ends: np.ndarray
    docs: np.ndarray
    impacts: np.ndarray
    n_docs: int

    def search(self, query: dict[int, int], top: int) -> tuple[np.ndarray, np.ndarray]:
        """Numbers and scores of the best documents with a score above 0, the best first; query: term and its repeats."""
        spans = [(self.ends[p], self.ends[p + 1], repeats) for t, repeats in query.items() if (p := self.place.get(t)) is not None]
        # The negated impacts of each list rise, so a level is found by bisection; zeros are never read.
        lists = [(self.docs[a:b], -self.impacts[a:b] * repeats) for a, b, repeats in spans]
        sizes = [int(np.searchsorted(x, 0)) for _, x in lists]
        at = [0] * len(lists)
        following = np.array([-x[0] if n else 0 for (_, x), n in zip(lists, sizes)], np.int64)
        lower = np.zeros(self.n_docs, np.int64)
        read_docs, read_lists = [], []
        wanted = range(len(lists))
        members = None
        while True:
            if not len(following) or not following[list(wanted)].any():
                break  # nothing is left to read where it matters
            level = int(following[list(wanted)].max()) // 2
            for i in wanted:
                docs, falling = lists[i]
                if following[i] > level:
                    until = min(int(np.searchsorted(falling, -level, "left")), sizes[i])
                    new = docs[at[i]:until]
                    lower[new] -= falling[at[i]:until]  # a document is in a list once
                    read_docs.append(new)
                    read_lists.append(np.full(len(new), i))
                    at[i] = until
                    following[i] = -falling[until] if until < sizes[i] else 0
            docs, of = np.concatenate(read_docs), np.concatenate(read_lists)
            if members is None:
                members = self._settled(lower, docs, following[of], int(following.sum()), top)
                if members is None:
                    continue
            # Membership is settled: only lists in which a member was not seen matter now.
            seen = np.zeros((len(lists), len(members)), bool)
            number = np.full(self.n_docs, -1)
            number[members] = np.arange(len(members))
            held = number[docs] >= 0
            seen[of[held], number[docs[held]]] = True
            wanted = np.flatnonzero(~seen.all(axis=1) & (following > 0)).tolist()
            if not wanted:
                break
        if members is None:
            members = _best(lower, top)
        best = members[np.lexsort((members, -lower[members]))]
        return best, lower[best]

    def _settled(self, lower: np.ndarray, docs: np.ndarray, next_impact: np.ndarray, unread: int, top: int) -> np.ndarray | None:
        """The best documents, if no reading can change which they are."""
        best = _best(lower, top)
        if len(best) < top:
            return best if not unread else None
        floor = lower[best].min()
        last = best[lower[best] == floor].max()
        seen = np.zeros(self.n_docs, np.int64)
        np.add.at(seen, docs, next_impact)
        upper = lower + unread - seen
        other = np.ones(self.n_docs, bool)
        other[best] = False
        beats = (upper > floor) | ((upper == floor) & (np.arange(self.n_docs) < last))
        return None if (beats & other).any() else best


def _best(lower: np.ndarray, top: int) -> np.ndarray:
    """The documents of the largest lower bounds above 0, ties to the smaller number."""
    some = np.flatnonzero(lower > 0)
    if len(some) > top:
        least = np.partition(lower[some], len(some) - top)[len(some) - top]
        above, ties = some[lower[some] > least], some[lower[some] == least]
        some = np.concatenate([above, ties[:top - len(above)]])
    return some


def impact_lists(row: dict, weights: np.ndarray, n_docs: int, n_terms: int) -> ImpactLists:
    of = lambda name, kind: np.frombuffer(row[name], kind).astype(np.int64)
    sizes, terms, ends, docs, counts = of("sizes", "<i8"), of("terms", "<i4"), of("ends", "<i4"), of("docs", "<i4"), of("counts", "<i4")
    m = 75 + 25 * sizes * n_docs // max(n_terms, 1)
    list_of = np.repeat(np.arange(len(terms)), np.diff(ends))
    impacts = weights[terms][list_of] * (1_000_000_000 * counts // (1000 * counts + 12 * m[docs]))
    order = np.lexsort((-impacts, list_of))
    return ImpactLists(dict(zip(terms.tolist(), range(len(terms)))), ends, docs[order], impacts[order], len(sizes))


def query_terms(queries: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Columns item, terms (array of term and repeats): a row per query id."""

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = packed.terms_of(*packed.text_bytes(batch.column(1)), packed.LETTERS_AND_DIGITS)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(found.text)), pc.cast(found.strings(np.arange(len(found.start))), pa.string())], names=["item", "term"])

    kind = queries.schema[id_col].dataType.simpleString()
    texts = queries.select(F.col(id_col).alias("item"), F.coalesce(text_col, F.lit("")).alias("body")).distinct()
    each = texts.mapInArrow(split, f"item {kind}, term string").groupBy("item", "term").agg(F.count("*").alias("repeats"))
    return each.groupBy("item").agg(F.collect_list(F.struct("term", "repeats")).alias("terms"))


def search(docs: DataFrame, queries: DataFrame, top: int = TOP, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id",
           query_col: str = "text", block_terms: int = BLOCK_TERMS) -> DataFrame:
    """Columns item_col, rank (from 1), id_col, score: the best documents of each query."""
    spark = docs.sparkSession
    items = written(query_terms(queries, item_col, query_col), "search-queries")
    blocks = groups_for(items.agg(F.sum(F.size("terms"))).first()[0] or 0, block_terms)
    found = None
    for block in range(blocks):
        # A block of queries: about `block_terms` terms.
        asked = [(r["item"], {t["term"]: t["repeats"] for t in r["terms"]})
                 for r in items.where(F.pmod(F.xxhash64("item"), F.lit(blocks)) == block).collect()]
        some = written(_searched_block(spark, docs, asked, items.schema["item"].dataType, top, id_col, text_col), "search-found")
        found = some if found is None else found.unionByName(some)
    order = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc"))
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top).select(
        F.col("item").alias(item_col), "rank", F.col("doc").alias(id_col), "score")


def _searched_block(spark, docs: DataFrame, asked: list[tuple], item_kind: T.DataType, top: int, id_col: str, text_col: str) -> DataFrame:
    """Columns item, doc, score: the best documents of each query in each slice."""
    numbers = {term: i for i, term in enumerate(sorted({t for _, terms in asked for t in terms}))}
    shared_numbers = spark.sparkContext.broadcast(numbers)

    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in packed.slices(batches, 1, SLICE_BYTES, SLICE_DOCS):
            yield indexed(rows, shared_numbers.value)

    columns = [F.col(id_col).cast("long").alias("doc"), F.coalesce(F.col(text_col), F.lit("")).alias("body")]
    slices = written(docs.select(*columns).mapInArrow(index, _INDEX), "search-index")
    in_docs = np.zeros(len(numbers), np.int64)
    for term, n in slices.select(F.explode("document_terms").alias("x")).groupBy("x.term").agg(F.sum("x.docs").alias("n")).collect():
        in_docs[term] = n
    n_docs, n_terms = _corpus(slices)
    weights = np.array([weight(n_docs, int(n)) for n in in_docs], np.int64)
    shared = spark.sparkContext.broadcast((weights, [{numbers[t]: r for t, r in terms.items()} for _, terms in asked], [i for i, _ in asked]))
    item_arrow = to_arrow_type(item_kind)
    kinds = f"item {item_kind.simpleString()}, doc long, score long"

    def seek(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights, wanted, item_ids = shared.value
        item_ids = pa.array(item_ids, item_arrow)
        for batch in batches:
            for row in range(batch.num_rows):
                row = batch.slice(row, 1).to_pylist()[0]
                lists = impact_lists(row, weights, n_docs, n_terms)
                ids, known = np.frombuffer(row["ids"], "<i8"), np.frombuffer(row["known"], np.uint8) > 0
                of, best, scores = [], [], []
                for i, query in enumerate(wanted):
                    some, score = lists.search(query, top)
                    of.append(np.full(len(some), i))
                    best.append(some)
                    scores.append(score)
                of, best, scores = (np.concatenate(x) if x else np.empty(0, np.int64) for x in (of, best, scores))
                yield pa.RecordBatch.from_arrays(
                    [item_ids.take(pa.array(of)) if len(of) else item_ids.slice(0, 0), pa.array(ids[best], pa.int64(), mask=~known[best]), pa.array(scores)],
                    names=["item", "doc", "score"])

    return slices.drop("document_terms").mapInArrow(seek, kinds)


def _corpus(slices: DataFrame) -> tuple[int, int]:
    """Documents with terms, and terms in all."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = [np.frombuffer(x, "<i8") for x in batch.column(0).to_pylist()]
            yield pa.RecordBatch.from_pydict({"docs": [int((x > 0).sum()) for x in sizes], "terms": [int(x.sum()) for x in sizes]})

    row = slices.select("sizes").mapInArrow(add, "docs long, terms long").agg(F.sum("docs"), F.sum("terms")).first()
    return row[0] or 0, row[1] or 0
