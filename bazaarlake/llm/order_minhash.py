"""Near-duplicate documents by Order MinHash, verified by a banded alignment.

A document is the sequence of its shingles of five words (`[^\\x20\\x09-\\x0D]+`), each labelled with its
number among equal ones, so that all are different.  A sketch is the `minima` smallest of them under one
hash function, kept in text order: two texts agree in it if they share those shingles in that order,
so likelier the closer they are by edits.  `rows` sketches make one of `bands` keys; documents with a key
in common are candidates.

The similarity of two candidates is that of an alignment: shingles of both, with equal labels, whose
positions differ by no more than the band allows at the wanted similarity, the longest chain of them in
the order of both texts; its length over all shingles of the two, shared ones counted once.  It is the
Jaccard similarity of the shingles for texts whose common parts are in the same order, and never more.

Exact copies are one node.  Under each key, members are first compared with the smallest node.  Where
they are then in several classes, a member of each class is compared with a few leaders; members and
leaders are others at each pass, as long as that finds links.  At the end the members of all keys that still
hold several classes are joined on their rarest shingles, which meets every similar pair, so a pair is lost only if it
shares no key.  A group of n near copies costs about n comparisons; n texts that share passages but are no near
copies have rarer shingles than those of the passages, and do not meet.  Pairs that meet are told apart by
their numbers of shingles and by parity bit maps, which lose none, and those left are aligned with the
shingles of many texts at hand.
Classes are the connected components of the links, found by min-label steps over written tables.

At similarity 0.8 a pair shares a key with probability 1 - (1 - 0.8^6)^32 = 0.99994.

Defined cases: a text of fewer than five words is one shingle; null and empty texts and those of white
space alone are near copies of nothing but texts equal to them (null counts as empty); null ids come
last among the ids of a class; rows with equal ids or repeated whole are copies; very long texts are
taken whole; an empty table gives no rows; other columns stay, whatever their names.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from bazaarlake.llm.common import bit_filter, free_name, maybe_in, written

SHINGLE_WORDS = 5
SIMILARITY = 0.8
BANDS = 32
ROWS = 2
MINIMA = 3
LEADERS = 4
#: Passes with leaders go on while one comparison in so many finds a link.
LEADERS_PAY = 10
#: Slots of the count of shingles: 1 MB, sent to all tasks.
COUNT_SLOTS = 1 << 20
#: Pairs aligned in one group, about.
PAIRS_AT_ONCE = 4000
PARITY_BITS = 256
DOCS_AT_ONCE = 256
CELLS_AT_ONCE = 1 << 18

_MIX_1, _MIX_2, _MIX_3 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * _MIX_2
    x = (x ^ (x >> np.uint64(27))) * _MIX_3
    return x ^ (x >> np.uint64(31))


def labelled_shingles(words: np.ndarray, width: int = SHINGLE_WORDS) -> np.ndarray:
    """Hashes of the shingles of word hashes, in text order, equal ones told apart by their number."""
    if not len(words):
        return words
    n = max(len(words) - width + 1, 1)
    code = np.zeros(n, np.uint64)
    for k in range(min(width, len(words))):
        code = mixed(code + words[k:k + n] + _MIX_1)
    order = np.argsort(code, kind="stable")
    ordered = code[order]
    fresh = np.ones(n, bool)
    fresh[1:] = ordered[1:] != ordered[:-1]
    if not fresh.all():
        places = np.arange(n)
        number = np.empty(n, np.uint64)
        number[order] = places - np.maximum.accumulate(np.where(fresh, places, 0))
        code = np.where(number > 0, mixed(code + number * _MIX_1), code)
    return code


def key_hashes(shingles: np.ndarray, bands: int = BANDS, rows: int = ROWS, minima: int = MINIMA) -> np.ndarray:
    """The keys of a document that has shingles."""
    n, sketches = len(shingles), bands * rows
    seeds = mixed(np.arange(1, sketches + 1, dtype=np.uint64) * _MIX_1)
    out = np.empty(sketches, np.uint64)
    step = max(1, CELLS_AT_ONCE // n)
    for first in range(0, sketches, step):
        own = seeds[first:first + step]
        value = (shingles[None, :] ^ own[:, None]) * _MIX_2
        value ^= value >> np.uint64(32)
        lines, places = np.arange(len(own)), []
        for _ in range(min(minima, n)):
            place = value.argmin(axis=1)
            value[lines, place] = np.iinfo(np.uint64).max
            places.append(place)
        in_order = np.sort(np.stack(places, axis=1), axis=1)
        sketch = own.copy()
        for column in in_order.T:
            sketch = mixed(sketch + shingles[column])
        out[first:first + step] = sketch
    keys = np.zeros(bands, np.uint64)
    for column in out.reshape(bands, rows).T:
        keys = mixed(keys + column + _MIX_1)
    return keys


def word_hashes(texts: pa.Array) -> list[np.ndarray]:
    """The hashes of each text's words; a word that occurs often in the batch is hashed once."""
    lists = pc.ascii_split_whitespace(pc.fill_null(texts, ""))
    coded = lists.values.slice(lists.offsets[0].as_py()).dictionary_encode()
    hashes = np.array([xxhash.xxh64_intdigest(w) if w else 0 for w in coded.dictionary.to_pylist()], np.uint64)
    empty = np.array([not w for w in coded.dictionary.to_pylist()], bool)
    index, ends = coded.indices.to_numpy(), lists.offsets.to_numpy() - lists.offsets[0].as_py()
    out = []
    for a, b in zip(ends, ends[1:]):
        words = index[a:b]
        out.append(hashes[words[~empty[words]]] if len(words) else np.empty(0, np.uint64))
    return out


def _longest_chain(values: np.ndarray) -> int:
    """Length of the longest increasing subsequence."""
    if len(values) < 2 or (values[1:] > values[:-1]).all():
        return len(values)
    tails = np.empty(len(values), values.dtype)
    n = 0
    for v in values.tolist():
        at = int(np.searchsorted(tails[:n], v))
        tails[at] = v
        n = max(n, at + 1)
    return n


def alignment_similarity(a: np.ndarray, b: np.ndarray, similarity: float = SIMILARITY) -> float:
    """Of two sequences of different shingles; exact where it reaches `similarity`, else perhaps less than exact."""
    if not len(a) or not len(b):
        return 1.0 if len(a) == len(b) else 0.0
    total = len(a) + len(b)
    needed = similarity * total / (1 + similarity)
    if min(len(a), len(b)) < needed:
        return 0.0
    band = total - 2 * needed  # shingles on one side only, which is as far as a common one can be shifted
    order_a, order_b = np.argsort(a, kind="stable"), np.argsort(b, kind="stable")
    at = np.minimum(np.searchsorted(b[order_b], a[order_a]), len(b) - 1)
    common = b[order_b][at] == a[order_a]
    place_a, place_b = order_a[common], order_b[at[common]]
    near = np.abs(place_a - place_b) <= band + 1
    place_a, place_b = place_a[near], place_b[near]
    if len(place_a) < needed - 1e-9:
        return 0.0
    shared = _longest_chain(place_b[np.argsort(place_a)])
    return shared / (total - shared)


def parities(shingles: np.ndarray) -> np.ndarray:
    """A bit map: the parity of the number of shingles that fall on each bit.  Two maps differ in no more bits
    than there are shingles in one of the texts only."""
    odd = np.bincount((shingles % np.uint64(PARITY_BITS)).astype(np.int64), minlength=PARITY_BITS).astype(np.uint8) & 1
    return np.packbits(odd).view(np.int64)


def may_align(n_a: Column, bits_a: Column, n_b: Column, bits_b: Column, similarity: float) -> Column:
    """False only for texts below the similarity: by their numbers of shingles and by the bits that differ."""
    differ = sum((F.bit_count(bits_a[i].bitwiseXOR(bits_b[i])) for i in range(PARITY_BITS // 64)), F.lit(0))
    return (F.least(n_a, n_b) >= F.greatest(n_a, n_b) * similarity - 1e-6) & (
        differ <= (n_a + n_b) * ((1 - similarity) / (1 + similarity)) + 1e-6)


def _text_key() -> list:
    return [F.xxhash64("body").alias("t"), F.hash("body").alias("u")]


def _bodies(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("body"))


def nodes_of(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """A row per distinct text: node, t, u (hashes of the text), keys (empty for a text without words), shingles (their
    number), bits (their parities)."""

    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first in range(0, batch.num_rows, DOCS_AT_ONCE):
                rows = batch.slice(first, DOCS_AT_ONCE)
                keys, numbers, bits = [], [], []
                for words in word_hashes(rows.column(2)):
                    shingles = labelled_shingles(words)
                    keys.append(key_hashes(shingles).view(np.int64) if len(words) else np.empty(0, np.int64))
                    numbers.append(len(shingles))
                    bits.append(parities(shingles))
                longs = pa.list_(pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [rows.column(0), rows.column(1), pa.array(keys, longs), pa.array(numbers, pa.int32()), pa.array(bits, longs)],
                    names=["t", "u", "keys", "shingles", "bits"])

    sketched = _bodies(docs, id_col, text_col).select(*_text_key(), "body").mapInArrow(
        sketch, "t long, u int, keys array<long>, shingles int, bits array<long>")
    of_text = [F.first(c).alias(c) for c in ("keys", "shingles", "bits")]
    return sketched.groupBy("t", "u").agg(*of_text).select(F.monotonically_increasing_id().alias("node"), "t", "u", "keys", "shingles", "bits")


def _are_stars(edges: DataFrame) -> bool:
    """Whether every node of the edges a > b either has one smaller neighbour and no larger one, or no smaller one."""
    ends = edges.select(F.explode(F.array(
        F.struct(F.col("a").alias("node"), F.lit(1).alias("up"), F.lit(0).alias("down")),
        F.struct(F.col("b").alias("node"), F.lit(0).alias("up"), F.lit(1).alias("down")))).alias("end")).select("end.*")
    counted = ends.groupBy("node").agg(F.sum("up").alias("up"), F.max("down").alias("down"))
    return counted.where("up > 0 and up + down > 1").isEmpty()


def components(links: DataFrame) -> DataFrame:
    """Columns node, label (the smallest node of its component) for every node of the links a, b.

    Large-star and small-star steps: every node's larger neighbours, then its smaller ones, are linked to
    its smallest neighbour, until all are linked to the smallest node itself.  That is tested before each step, in one
    aggregate: a step is several shuffles, and each of them is a plan, a thread and broadcasts in the driver.
    """
    edges = written(links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a != b").distinct(), "near-links")
    while not _are_stars(edges):
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("least"))
        large = both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("least").alias("b")).distinct()
        least = large.groupBy("a").agg(F.min("b").alias("least"))
        small = large.join(least, "a").where("b != least").select(F.col("b").alias("a"), F.col("least").alias("b"))
        edges = written(small.unionByName(least.select("a", F.col("least").alias("b"))).distinct(), "near-links")
    return edges.select(F.col("a").alias("node"), F.col("b").alias("label")).unionByName(
        edges.select(F.col("b").alias("node"), F.col("b").alias("label")).distinct())


def merged(labels: DataFrame | None, links: DataFrame) -> DataFrame:
    """The labels after more links: only links between classes are followed, with a node for each class."""
    if labels is None:
        return components(links)
    of = lambda s: labels.select(F.col("node").alias(s), F.col("label").alias(f"label_{s}"))
    between = links.join(of("a"), "a", "left").join(of("b"), "b", "left").select(
        F.coalesce("label_a", "a").alias("a"), F.coalesce("label_b", "b").alias("b"))
    top = components(between).select(F.col("node").alias("label"), F.col("label").alias("top"))
    new = links.select(F.explode(F.array("a", "b")).alias("node")).distinct().join(labels, "node", "left_anti")
    every = labels.unionByName(new.withColumn("label", F.col("node")))
    return written(every.join(top, "label", "left").select("node", F.coalesce("top", "label").alias("label")), "near-labels")


def _verified(pairs: DataFrame, texts: DataFrame, similarity: float) -> DataFrame:
    """The pairs a, b whose texts align well enough."""

    def align(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first in range(0, batch.num_rows, DOCS_AT_ONCE):
                rows = batch.slice(first, DOCS_AT_ONCE)
                left = [labelled_shingles(w) for w in word_hashes(rows.column(2))]
                right = [labelled_shingles(w) for w in word_hashes(rows.column(3))]
                near = [alignment_similarity(x, y, similarity) >= similarity - 1e-9 for x, y in zip(left, right)]
                yield pa.RecordBatch.from_arrays(
                    [rows.column(0).filter(pa.array(near, pa.bool_())), rows.column(1).filter(pa.array(near, pa.bool_()))], names=["a", "b"])

    side = lambda s: texts.select(F.col("node").alias(s), F.col("body").alias(f"body_{s}"))
    return pairs.join(side("a"), "a").join(side("b"), "b").select("a", "b", "body_a", "body_b").mapInArrow(align, "a long, b long")


def _leaders(members: DataFrame, most: int, turn: int, *within: str) -> DataFrame:
    """A few members of each bucket (and class), others at each turn; the limit is applied in every task before the shuffle."""
    picked = Window.partitionBy("bucket", *within).orderBy(F.xxhash64("node", F.lit(turn), F.lit(len(within))), "node")
    return members.withColumn("n", F.row_number().over(picked)).where(F.col("n") <= most).drop("n")


def _joined_pairs(left: DataFrame, right: DataFrame) -> DataFrame:
    """Pairs of members of one bucket that are in different classes so far."""
    other = right.select("bucket", F.col("node").alias("other"), F.col("label").alias("other_label"))
    return left.join(other, "bucket").where("label != other_label").select(
        F.least("node", "other").alias("a"), F.greatest("node", "other").alias("b"))


def _rarity(shingled: DataFrame) -> np.ndarray:
    """How often the shingles of each of COUNT_SLOTS slots occur, in eighths of a doubling; 0 where that is once at most.

    A table of fixed size, whatever the texts: five bytes a slot come to the driver, one goes to the tasks.  The order of the
    shingles needs no more, it only has to be the same everywhere.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            slots, n = np.unique(_slots(_flat(batch.column(2))[0]), return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(slots.astype(np.int32)), pa.array(n)], names=["slot", "n"])

    eighths = F.least(F.ceil(F.log2("n") * 8), F.lit(127 + 128)) - 128
    found = shingled.mapInArrow(count, "slot int, n long").groupBy("slot").agg(F.sum("n").alias("n")).where("n > 1").select(
        "slot", eighths.cast("tinyint").alias("often")).toArrow()
    often = np.zeros(COUNT_SLOTS, np.uint8)
    for batch in found.to_batches():
        often[batch.column("slot").to_numpy()] = batch.column("often").to_numpy().astype(np.int16) + 128
    return often


def _slots(shingles: np.ndarray) -> np.ndarray:
    return (shingles % np.uint64(COUNT_SLOTS)).astype(np.int64)


def _flat(lists: pa.ListArray) -> tuple[np.ndarray, np.ndarray]:
    """All shingles of a column of lists, and where each list begins and the last ends."""
    ends = lists.offsets.to_numpy()
    return lists.values.to_numpy()[ends[0]:ends[-1]].view(np.uint64), ends - ends[0]


def _rare_pairs(current: DataFrame, texts: DataFrame, similarity: float) -> DataFrame:
    """Every pair of the members that is still in two classes, shares one of its rarest shingles and may be similar.

    In one order of all shingles, two texts of that similarity have a shingle in common among the first
    n - ceil(2 * similarity / (1 + similarity) * n) + 1 of the shorter one and the first n - ceil(similarity * n) + 1 of the
    longer one, and from their first common shingle on each has as many left as the two must share.  The order is from rare
    to frequent, so passages that many texts share come last: they are among the first of a shorter text only if nearly
    all of it is such passages.  Classes meet before members do: a shingle of one class alone makes no pair.
    """
    members = current.select("node", "label").distinct()

    def shingle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first in range(0, batch.num_rows, DOCS_AT_ONCE):
                rows = batch.slice(first, DOCS_AT_ONCE)
                own = [labelled_shingles(w).view(np.int64) for w in word_hashes(rows.column(2))]
                yield pa.RecordBatch.from_arrays([rows.column(0), rows.column(1), pa.array(own, pa.list_(pa.int64()))], names=["node", "label", "own"])

    shingled = written(texts.join(members, "node").select("node", "label", "body").mapInArrow(
        shingle, "node long, label long, own array<long>"), "near-shingles")
    shared = shingled.sparkSession.sparkContext.broadcast(_rarity(shingled))
    of_both = similarity / (1 + similarity)  # what two texts share, of the sum of their numbers of shingles

    def rarest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = shared.value
        for batch in batches:
            flat, ends = _flat(batch.column(2))
            kept, of, bits, left, short = [], [], [], [], []
            for i, (a, b) in enumerate(zip(ends, ends[1:])):
                own, often = flat[a:b], counts[_slots(flat[a:b])]
                n = len(own)
                first = np.lexsort((own, often))[:n - math.ceil(similarity * n - 1e-6) + 1]
                rest = n - np.arange(len(first))  # the shingles from this one on
                meets = often[first] > 0  # one that occurs once is shared with none
                kept.append(own[first[meets]])
                of.append(np.full(int(meets.sum()), i))
                bits.append(parities(own))
                left.append(rest[meets])
                short.append(rest[meets] >= 2 * of_both * n - 1e-6)
            join = lambda parts, kind: np.concatenate(parts) if parts else np.empty(0, kind)
            of = pa.array(join(of, np.int64))
            sizes = pa.array(np.diff(ends).astype(np.int32))
            columns = [batch.column(0), batch.column(1), sizes, pa.array(bits, pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays(
                [pa.array(join(kept, np.uint64).view(np.int64)), *(c.take(of) for c in columns),
                 pa.array(join(left, np.int64).astype(np.int32)), pa.array(join(short, bool))],
                names=["shingle", "node", "label", "shingles", "bits", "rest", "short"])

    rows = written(shingled.mapInArrow(
        rarest, "shingle long, node long, label long, shingles int, bits array<long>, rest int, short boolean"), "near-rare")
    side = lambda s: [F.col(c).alias(f"{c}_{s}") for c in ("label", "node", "shingles", "bits", "rest")]
    shorter = rows.where("short").select("shingle", *side("a"))
    longer = rows.select("shingle", *side("b"))
    meet = shorter.groupBy("shingle", "label_a").agg(F.count("*").alias("n_a")).join(
        longer.groupBy("shingle", "label_b").agg(F.count("*").alias("n_b")), "shingle").where("label_a != label_b")
    may = (F.struct("shingles_a", "node_a") < F.struct("shingles_b", "node_b")) & (
        F.least("rest_a", "rest_b") >= (F.col("shingles_a") + F.col("shingles_b")) * of_both - 1e-6) & may_align(
        F.col("shingles_a"), F.col("bits_a"), F.col("shingles_b"), F.col("bits_b"), similarity)
    # Of two classes the one with fewer rows under a shingle looks up the other.
    few_a = shorter.join(meet.where("n_a <= n_b").drop("n_a", "n_b"), ["shingle", "label_a"]).join(longer, ["shingle", "label_b"])
    few_b = longer.join(meet.where("n_a > n_b").drop("n_a", "n_b"), ["shingle", "label_b"]).join(shorter, ["shingle", "label_a"])
    pairs = [d.where(may).select(F.least("node_a", "node_b").alias("a"), F.greatest("node_a", "node_b").alias("b")) for d in (few_a, few_b)]
    return pairs[0].unionByName(pairs[1])


def _verified_in_groups(pairs: DataFrame, texts: DataFrame, similarity: float) -> DataFrame:
    """As `_verified`, for many pairs of few texts: a text comes once to each group of pairs, not with every pair."""

    def shingle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first in range(0, batch.num_rows, DOCS_AT_ONCE):
                rows = batch.slice(first, DOCS_AT_ONCE)
                own = [labelled_shingles(w).view(np.int64) for w in word_hashes(rows.column(1))]
                yield pa.RecordBatch.from_arrays([rows.column(0), pa.array(own, pa.list_(pa.int64()))], names=["node", "own"])

    def align(these: pa.Table, those: pa.Table) -> pa.Table:
        own = those.column("own").combine_chunks()
        flat, ends = own.values.to_numpy().view(np.uint64), own.offsets.to_numpy()
        of = {node: flat[x:y] for node, x, y in zip(those.column("node").to_pylist(), ends, ends[1:])}
        a, b = these.column("a").to_pylist(), these.column("b").to_pylist()
        near = [alignment_similarity(of[x], of[y], similarity) >= similarity - 1e-9 for x, y in zip(a, b)]
        return these.select(["a", "b"]).filter(pa.array(near, pa.bool_()))

    sides = max(1, round((2 * pairs.count() / PAIRS_AT_ONCE) ** 0.5))
    side = lambda c: F.pmod(F.xxhash64(c), F.lit(sides)).cast("int")
    dealt = pairs.select("a", "b", side("a").alias("left"), side("b").alias("right"))
    wanted = dealt.select(F.col("left").alias("of_left"), F.col("right").alias("of_right"), F.explode(F.array("a", "b")).alias("node")).distinct()
    held = texts.join(wanted.select("node").distinct(), "node", "left_semi").select("node", "body").mapInArrow(shingle, "node long, own array<long>")
    return dealt.groupBy("left", "right").cogroup(wanted.join(held, "node").groupBy("of_left", "of_right")).applyInArrow(align, "a long, b long")


def near_links(docs: DataFrame, nodes: DataFrame, id_col: str = "doc_id", text_col: str = "text",
               similarity: float = SIMILARITY) -> tuple[DataFrame, DataFrame]:
    """Links a, b between nodes found similar, and labels node, label of the classes that they form."""
    members = nodes.select("node", F.posexplode("keys").alias("band", "key")).select("node", F.xxhash64("band", "key").alias("bucket"))
    shared = members.groupBy("bucket").agg(F.count("*").alias("size")).where("size > 1")
    members = written(members.join(shared, "bucket"), "near-members")

    wanted = written(nodes.join(members.select("node").distinct(), "node", "left_semi").select("node", "t", "u"), "near-wanted")
    likely = maybe_in(_bodies(docs, id_col, text_col).select(*_text_key(), "body"), "t", bit_filter(wanted, "t"))
    texts = written(likely.join(wanted, ["t", "u"])
                    .groupBy("node").agg(F.first("body").alias("body")), "near-texts")

    found: list[DataFrame] = []
    tested: list[DataFrame] = []
    labels = None
    turn = 0
    last = False
    while True:
        if labels is None:
            current = members.withColumn("label", F.col("node"))
            pairs = _joined_pairs(current, current.groupBy("bucket").agg(F.min("node").alias("node")).withColumn("label", F.col("node")))
        else:
            current = members.join(labels, "node", "left").withColumn("label", F.coalesce("label", "node"))
            mixed = current.groupBy("bucket").agg(F.min("label").alias("low"), F.max("label").alias("high")).where("low != high")
            current = written(current.join(mixed.select("bucket"), "bucket"), "near-mixed")
            pairs = _rare_pairs(current, texts, similarity) if last else _joined_pairs(
                _leaders(current, 1, turn, "label"), _leaders(current, LEADERS, turn))
        pairs = pairs.distinct()
        for earlier in tested:
            pairs = pairs.join(earlier, ["a", "b"], "left_anti")
        pairs = written(pairs, "near-pairs")
        new = written((_verified_in_groups if last else _verified)(pairs, texts, similarity), "near-found")
        tested.append(pairs)
        found.append(new)
        links = found[0]
        for more in found[1:]:
            links = links.unionByName(more)
        n_new = new.count()
        if n_new or labels is None:
            labels = merged(labels, new)
        if last:
            return links, labels
        last = turn > 0 and n_new * LEADERS_PAY <= pairs.count()
        turn += 1


def classed(docs: DataFrame, class_col: str = "class_id", id_col: str = "doc_id", text_col: str = "text",
            similarity: float = SIMILARITY) -> DataFrame:
    """Columns id_col, class_col (the smallest id of its class), found_links, t, u: a row per document.

    found_links are the links of its text that were met on the way to the classes, not all near copies of it: pairs
    already in one class are not compared.
    """
    nodes = written(nodes_of(docs, id_col, text_col), "near-nodes")
    links, labels = near_links(docs, nodes, id_col, text_col, similarity)
    degree = links.select(F.explode(F.array("a", "b")).alias("node")).groupBy("node").agg(F.count("*").alias("found_links"))
    rows = _bodies(docs, id_col, text_col).select("id", *_text_key())
    least = rows.groupBy("t", "u").agg(F.min("id").alias("least"))
    texts = (nodes.select("node", "t", "u").join(labels, "node", "left").join(degree, "node", "left")
             .join(least, ["t", "u"]).withColumn("label", F.coalesce("label", "node")))
    of_class = texts.groupBy("label").agg(F.min("least").alias("class"))
    of_text = texts.join(of_class, "label").select("t", "u", "class", F.coalesce("found_links", F.lit(0)).alias("found_links"))
    return rows.join(of_text, ["t", "u"]).select(F.col("id").alias(id_col), F.col("class").alias(class_col), "found_links", "t", "u")


def one_of_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", similarity: float = SIMILARITY) -> DataFrame:
    """The documents without near copies: of each class the row with the smallest id stays, all columns as they are.

    Rows with a null id are one class for each text, apart from the others' classes only if those have no id either.
    """
    found = classed(docs, "class", id_col, text_col, similarity)
    # The class's smallest id names the row; equal ids with different texts of one class are told apart by the text.
    winners = found.where(F.col(id_col).eqNullSafe(F.col("class"))).groupBy(F.col(id_col).alias("id"), "class").agg(
        F.min(F.struct("t", "u")).alias("text"))
    row, row_2 = free_name(docs, "__row"), free_name(docs, "__row_2")
    body = F.coalesce(F.col(text_col), F.lit(""))
    named = docs.withColumn(row, F.xxhash64(F.col(id_col), F.xxhash64(body), F.hash(body))).withColumn(
        row_2, F.hash(F.col(id_col), F.xxhash64(body), F.hash(body)))
    kept = winners.select(F.xxhash64("id", "text.t", "text.u").alias(row), F.hash("id", "text.t", "text.u").alias(row_2)).distinct()
    return named.join(kept, [row, row_2], "left_semi").dropDuplicates([row, row_2]).select(*docs.columns)
