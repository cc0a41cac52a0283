"""Approximate nearest neighbours by inner product: a forest of sorted hash strings.

Every vector has one long hash string per tree: SYMBOLS symbols of 7 bits, each the number and sign
of the largest of 64 random projections (a cross-polytope hash), the first symbol in the highest
bits, so that sorting the strings sorts the tree.  A query descends in every tree to its longest
matching prefix and ascends in all trees at once: the deepest level is taken at which the prefix
matches of all trees together are at least `candidates`.  Level 0 is the root: a query that finds too
few matches even at level 1 is compared with every vector, in blocks.  Matches are scored with the
original vectors in double precision.

Largest inner product becomes smallest angle by one more component: vectors are scaled by the largest
norm R and get sqrt(1 - |x|^2/R^2), queries get 0.

The work is dealt out by tree and first symbol; a first symbol with more than `block_rows` vectors is
cut into blocks by a hash, and its queries visit each block.  Equal vectors are one entry of the index
that keeps its k+1 smallest ids (a further one could not be among the k nearest), and equal queries
are one query, so neither copies nor a hot vector fill a block.  A vector is sent only to the trees in
which some query reaches its first two symbols: to all for a dense set of queries, to few for a sparse
one, and to one where every query ends at the root.

Recall is measured on the table itself: MEASURED queries, those of the smallest hashes, are compared with
every vector in one pass, which keeps their k nearest and the longest prefix that each of those shares with
the query in any tree.  From that and the counts of matches, `candidates` is doubled until RECALL of those
neighbours would be met; at the latest at the root all are.

Defined cases: vectors that are null, zero, of another length than most, or hold null or non-finite
components take no part, neither as queries nor as candidates; ids that are null take no part; an
id that repeats is a candidate once for each of its distinct vectors, and each of its rows is no
candidate of itself; with fewer than k candidates all are returned; ties go to the smaller id; an
empty table gives no rows.  Other columns are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from bazaarlake.llm.common import written

TREES = 64
SYMBOLS = 8
PROJECTIONS = 64
BITS = 7
#: Matches per wanted neighbour to begin with; the measured recall raises them.
CANDIDATES_EACH = 10
#: Queries that are compared with every vector, and the share of their neighbours that has to be met.
MEASURED = 200
RECALL = 0.93
BLOCK_ROWS = 20_000
SEED = 11


def hash_strings(rows: np.ndarray, trees: int = TREES, seed: int = SEED) -> np.ndarray:
    """A long per row and tree."""
    out = np.zeros((len(rows), trees), np.int64)
    rows = rows.astype(np.float32)
    for tree in range(trees):
        rng = np.random.default_rng((seed, tree))
        for _ in range(SYMBOLS):
            response = rows @ rng.standard_normal((rows.shape[1], PROJECTIONS), dtype=np.float32)
            largest = np.abs(response).argmax(axis=1)
            positive = response[np.arange(len(rows)), largest] > 0
            out[:, tree] = (out[:, tree] << BITS) | (largest * 2 + positive)
    return out


def _matrix(column) -> np.ndarray:
    chunk = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    flat = chunk.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(len(chunk), -1) if len(chunk) else np.empty((0, 1))


def _hashed(rows: DataFrame, largest: float, trees: int, as_query: bool) -> DataFrame:
    """The rows with an array `strings`."""

    def hash_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            vectors = _matrix(batch.column(1))
            norm = np.sqrt((vectors * vectors).sum(axis=1, keepdims=True))
            if as_query:
                rows_ = np.concatenate([vectors / norm, np.zeros_like(norm)], axis=1)
            else:
                rows_ = np.concatenate([vectors / largest, np.sqrt(np.maximum(1 - (norm / largest) ** 2, 0))], axis=1)
            strings = hash_strings(rows_, trees)
            lists = pa.ListArray.from_arrays(np.arange(0, strings.size + 1, trees, dtype=np.int32), pa.array(strings.ravel()))
            yield pa.RecordBatch.from_arrays([*batch.columns, lists], names=[*batch.schema.names, "strings"])

    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema)
    return rows.mapInArrow(hash_batches, f"{kinds}, strings array<long>")


def _in_trees(hashed: DataFrame, *columns: str) -> DataFrame:
    return hashed.select(*columns, F.posexplode("strings").alias("tree", "string")).withColumn("cell", _first_symbol(F.col("string")))


def _first_symbol(string: Column, symbols: int = 1) -> Column:
    return F.shiftright(string, BITS * (SYMBOLS - symbols)).cast("int")


def _asked_prefixes(asking: DataFrame) -> DataFrame:
    """The first two symbols that some query reaches, per tree: at most trees * 16,384 rows."""
    cells, first = 1 << BITS, F.col("cell") * (1 << BITS)
    reached = (
        F.when(F.col("level") >= 2, F.array(_first_symbol(F.col("string"), 2)))
        .when(F.col("level") == 1, F.sequence(first, first + cells - 1))
        .when(F.col("tree") == 0, F.sequence(F.lit(0), F.lit(cells * cells - 1))))
    spread = asking.select("tree", F.when(F.col("level") == 0, F.lit(0)).otherwise(F.col("cell")).alias("cell"),
                           F.least("level", F.lit(2)).alias("level"),
                           F.when(F.col("level") >= 2, F.col("string")).otherwise(F.lit(0)).alias("string"))
    few = spread.withColumn("string", F.shiftright("string", BITS * (SYMBOLS - 2))).distinct().withColumn(
        "string", F.shiftleft("string", BITS * (SYMBOLS - 2)))
    return few.select("tree", F.explode(reached).alias("prefix")).distinct()


def _ranges(strings: np.ndarray, query: np.ndarray, level: np.ndarray | int) -> tuple[np.ndarray, np.ndarray]:
    """Where, in sorted strings, those that share so many symbols with the query begin and end."""
    shift = BITS * (SYMBOLS - np.asarray(level))
    low = (query >> shift) << shift
    return np.searchsorted(strings, low), np.searchsorted(strings, low + (np.int64(1) << shift))


def _count_levels(group: pa.Table) -> pa.Table:
    """For each query of a block: its prefix matches at levels 1 to SYMBOLS."""
    is_query = group.column("is_query").to_numpy(zero_copy_only=False)
    strings = np.sort(group.column("string").to_numpy()[~is_query])
    query = group.column("string").to_numpy()[is_query]
    counts = np.empty((len(query), SYMBOLS), np.int64)
    for level in range(1, SYMBOLS + 1):
        low, high = _ranges(strings, query, level)
        counts[:, level - 1] = high - low
    lists = pa.ListArray.from_arrays(np.arange(0, counts.size + 1, SYMBOLS, dtype=np.int32), pa.array(counts.ravel()))
    return pa.table({"entry": pa.array(group.column("entry").to_numpy()[is_query], pa.int64()), "counts": lists})


def _prefix_symbols(strings: np.ndarray, query: np.ndarray) -> np.ndarray:
    """For each row of strings: the most symbols that it shares with the query in any tree."""
    apart = (strings ^ query).min(axis=1)
    bits = np.zeros(len(apart), np.int64)
    for shift in (32, 16, 8, 4, 2, 1):
        big = (apart >> shift) > 0
        bits += np.where(big, shift, 0)
        apart = np.where(big, apart >> shift, apart)
    return SYMBOLS - (bits + apart + BITS - 1) // BITS


def _enough_candidates(index: DataFrame, queries: DataFrame, matches: DataFrame, k: int, least: int) -> int:
    """The first of least, 2 * least, ... at which the measured queries meet enough of their nearest."""
    sample = queries.orderBy(F.xxhash64("vec"), "entry").limit(MEASURED).join(matches, "entry", "left").collect()
    if not sample:
        return least
    asked = [(r["entry"], np.array(r["vec"], np.float64), np.array(r["strings"], np.int64)) for r in sample]

    def best(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            vectors, entry = _matrix(batch.column(1)), batch.column(0).to_numpy()
            strings = batch.column(2).flatten().to_numpy().reshape(len(entry), -1)
            for own, vector, string in asked:
                inner = np.where(entry == own, -np.inf, vectors @ vector)
                top = np.argsort(-inner, kind="stable")[:k]
                top = top[entry[top] != own]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(top), own)), pa.array(inner[top]), pa.array(_prefix_symbols(strings[top], string))],
                    names=["query", "score", "depth"])

    nearest_of = Window.partitionBy("query").orderBy(F.desc("score"), "depth")
    rows = (index.select("entry", "vec", "strings").mapInArrow(best, "query long, score double, depth long")
            .withColumn("n", F.row_number().over(nearest_of)).where(F.col("n") <= k).select("query", "depth").collect())
    counts = {r["entry"]: r["counts"] or [0] * SYMBOLS for r in sample}
    while True:
        level = {q: max((i + 1 for i, n in enumerate(c) if n >= least), default=0) for q, c in counts.items()}
        if sum(r["depth"] >= level[r["query"]] for r in rows) >= RECALL * len(rows):
            return least
        least *= 2


def nearest(table: DataFrame, query_mark: Column, k: int = 20, id_col: str = "vec_id", vector_col: str = "embedding",
            trees: int = TREES, candidates: int | None = None, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """For each row that query_mark is true for: columns query_id, rank (from 1), vec_id, score."""
    given = table.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).alias("vec"), F.coalesce(query_mark, F.lit(False)).alias("asks"))
    component_fine = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))
    usable = given.where(
        F.col("id").isNotNull() & F.col("vec").isNotNull() & F.forall("vec", component_fine) & F.exists("vec", lambda x: x != 0))
    usual = usable.groupBy(F.size("vec").alias("width")).count().orderBy(F.desc("count"), "width").first()
    if usual is None:
        return table.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    usable = usable.where(F.size("vec") == usual["width"])

    # One entry per distinct vector, with its k+1 smallest ids; the row limit is applied in each task before the shuffle.
    by_vector = Window.partitionBy("vec").orderBy("id")
    few = usable.withColumn("n", F.row_number().over(by_vector)).where(F.col("n") <= k + 1)
    asked = usable.where("asks").groupBy("vec").agg(F.lit(True).alias("asked"))
    entries = written(
        few.groupBy("vec").agg(F.min("id").alias("least"), F.array_sort(F.collect_list("id")).alias("ids"))
        .join(asked, "vec", "left").select(F.monotonically_increasing_id().alias("entry"), "vec", "ids", F.coalesce("asked", F.lit(False)).alias("asked")),
        "neighbours")
    largest = float(entries.select(F.max(F.sqrt(F.aggregate(
        "vec", F.lit(0.0), lambda a, x: a + x.cast("double") * x.cast("double"))))).first()[0]) * (1 + 1e-9)

    index = written(_hashed(entries.select("entry", "vec"), largest, trees, False), "neighbours")
    queries = written(_hashed(entries.where("asked").select("entry", "vec"), largest, trees, True), "neighbours")

    # At most trees * 128 rows: how many blocks each cell is cut into.
    blocks = F.broadcast(_in_trees(index).groupBy("tree", "cell").agg(
        F.ceil(F.count("*") / block_rows).cast("int").alias("blocks")))

    def dealt_index(*columns: str) -> DataFrame:
        return _in_trees(index, *columns).join(blocks, ["tree", "cell"]).withColumn(
            "block", F.pmod(F.xxhash64("entry"), F.col("blocks")).cast("int")).drop("blocks")

    def dealt_queries(*columns: str) -> DataFrame:
        return _in_trees(queries, *columns).join(blocks, ["tree", "cell"]).withColumn(
            "block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).drop("blocks")

    counted = (
        dealt_index("entry").withColumn("is_query", F.lit(False))
        .unionByName(dealt_queries("entry").withColumn("is_query", F.lit(True)))
        .groupBy("tree", "cell", "block").applyInArrow(_count_levels, "entry long, counts array<long>"))
    matches = written(counted.groupBy("entry").agg(
        F.array(*(F.sum(F.col("counts")[level]) for level in range(SYMBOLS))).alias("counts")), "neighbours")
    wanted = _enough_candidates(index, queries, matches, k, candidates or CANDIDATES_EACH * k)
    enough = [F.when(F.col("counts")[level - 1] >= wanted, level) for level in range(1, SYMBOLS + 1)]
    levels = matches.select("entry", F.greatest(F.lit(0), *enough).alias("level"))
    # A query that met no cell at all in any tree is not counted: it goes to the root as well.
    ascended = written(queries.join(levels, "entry", "left").withColumn("level", F.coalesce("level", F.lit(0))), "neighbours")

    def score(group: pa.Table) -> pa.Table:
        is_query = group.column("level").to_numpy() >= 0
        vectors, entry = _matrix(group.column("vec")), group.column("entry").to_numpy()
        strings = group.column("string").to_numpy()
        rows = np.flatnonzero(~is_query)
        rows = rows[np.argsort(strings[rows], kind="stable")]
        ask = np.flatnonzero(is_query)
        level = group.column("level").to_numpy()[ask]
        low, high = _ranges(strings[rows], strings[ask], np.maximum(level, 1))
        low, high = np.where(level == 0, 0, low), np.where(level == 0, len(rows), high)
        out = ([], [], [])
        for q, a, b in zip(ask, low, high):
            found = rows[a:b]
            inner = vectors[found] @ vectors[q]
            if len(found) > k + 1:  # with all that tie with the last
                least = np.partition(inner, len(inner) - k - 1)[len(inner) - k - 1]
                chosen = inner >= least
                found, inner = found[chosen], inner[chosen]
            out[0].append(np.full(len(found), entry[q]))
            out[1].append(entry[found])
            out[2].append(inner)
        join = lambda parts, kind: pa.array(np.concatenate(parts) if parts else np.empty(0), kind)
        return pa.table({"query": join(out[0], pa.int64()), "found": join(out[1], pa.int64()), "score": join(out[2], pa.float64())})

    asking = _in_trees(ascended, "entry", "vec", "level")
    at_cells = asking.where("level > 0").join(blocks, ["tree", "cell"])
    # All cells of one tree hold every vector once: at most 128 of them.
    at_root = asking.where("level = 0 and tree = 0").drop("cell").join(blocks, "tree")
    columns = ["tree", "cell", "block", "entry", "vec", "string", "level"]
    blocked = at_cells.unionByName(at_root.select(*at_cells.columns)).withColumn(
        "block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).select(columns)
    reached = F.broadcast(_asked_prefixes(asking))
    sent = dealt_index("entry", "vec").withColumn("prefix", _first_symbol(F.col("string"), 2)).join(reached, ["tree", "prefix"], "left_semi")
    scored = (
        sent.withColumn("level", F.lit(-1)).select(columns).unionByName(blocked)
        .groupBy("tree", "cell", "block").applyInArrow(score, "query long, found long, score double"))

    best_entries = Window.partitionBy("query").orderBy(F.desc("score"), "least")
    distinct = scored.groupBy("query", "found").agg(F.max("score").alias("score"))
    ids = entries.select("entry", "ids", F.col("ids")[0].alias("least"))
    top = (distinct.join(ids, distinct["found"] == ids["entry"]).withColumn("n", F.row_number().over(best_entries))
           .where(F.col("n") <= k + 1).select("query", "score", F.explode("ids").alias("vec_id")))
    # At most (k+1)^2 ids for each distinct query; ids past the first k+1 cannot be wanted.
    best_ids = Window.partitionBy("query").orderBy(F.desc("score"), "vec_id")
    top = (top.withColumn("n", F.row_number().over(best_ids)).where(F.col("n") <= k + 1)
           .groupBy("query").agg(F.array_sort(F.collect_list(F.struct("n", "vec_id", "score"))).alias("found")))
    asks = (usable.where("asks").select(F.col("id").alias("query_id"), "vec")
            .join(entries.where("asked").select("vec", F.col("entry").alias("query")), "vec").drop("vec"))
    kept = F.slice(F.filter("found", lambda x: x["vec_id"] != F.col("query_id")), 1, k)
    return (asks.join(top, "query").select("query_id", F.posexplode(kept).alias("place", "x"))
            .select("query_id", (F.col("place") + 1).cast("int").alias("rank"), F.col("x.vec_id").alias("vec_id"), F.col("x.score").alias("score")))
