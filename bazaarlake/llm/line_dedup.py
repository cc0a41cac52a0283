"""Line deduplication: copies of a line, up to a few edits, go from all documents but the first.

Lines are told apart by a 64-bit and a 32-bit hash; those of under `min_chars` code points are left alone.
Near lines are found by a segment-partition edit join.  A line of length L is cut into edits + 1
segments; two lines within so many edits share one of them unchanged.  Every distinct line enters an
index with its own segments, keyed by (length, segment number, segment), and looks up, for each length
from L - edits to L, the substrings that could be the segments of a line of that length (the
multi-match-aware start positions).  The lines that meet any other under a key are found first; only these are
read again and joined, and a pair under a key goes on only if the counts of 24 letters differ
by no more than the edits can change.  Found pairs are verified by a banded bit-parallel edit distance: for
each number of errors a bit set of the diagonals within reach, moved one character at a time; before it, a
cheap test that enough pieces of the one line occur near their place in the other.

A line is removed where the same or a near line comes earlier, in the order of (document id, text hash,
line number).  That needs no closure: a line near an earlier one is removed wherever it occurs, and of
the others the first occurrence stays.

Only hashes are shuffled; the texts of candidate pairs are read again from the documents.  Everything
is built-in Spark functions.  The number of pairs under one key is the number of different lines that
share a third of their text at the same place and length; copies count once.

Defined cases: a null text has no lines and stays null; a text of which every line goes becomes empty;
null ids come first; rows repeated whole (equal id and text) are one document and come out alike; very long texts
and lines are compared whole; an empty table gives no rows; other columns stay, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bazaarlake.llm.common import bit_filter, free_name, maybe_in, written

EDITS = 2
MIN_CHARS = 20
_ID = "decimal(38,0)"
#: Letters whose counts are compared; any do.
LETTERS = "etaoinrshldcumfpgwybvkxj"
#: Pieces of the test before the edit distance.
PIECES = 8


def text_key(text: Column) -> Column:
    """Tells apart documents of one id."""
    return F.xxhash64(F.coalesce(text, F.lit("")))


def _lines(docs: DataFrame, id_col: str, text_col: str, min_chars: int) -> DataFrame:
    """Rows id, key, line_no, line, h, m: every line that is long enough."""
    return (
        docs.select(F.col(id_col).alias("id"), text_key(F.col(text_col)).alias("key"), F.posexplode(F.split(text_col, "\n")).alias("line_no", "line"))
        .where(F.length("line") >= min_chars)
        .withColumn("h", F.xxhash64("line")).withColumn("m", F.hash("line"))
    )


def _place() -> Column:
    """The order of occurrences as one number, which a hash aggregate can keep: id, 31 bits of the key, line number."""
    id_part = F.coalesce(F.col("id").cast(_ID), F.lit(str(-(1 << 63) - 1)).cast(_ID))
    low = F.shiftrightunsigned(F.col("key"), 33) * F.lit(1 << 31) + F.col("line_no")
    return (id_part * F.lit(str(1 << 62)).cast("decimal(19,0)") + low.cast("decimal(19,0)")).cast(_ID)


def _segment(length: Column, number: Column, edits: int) -> tuple[Column, Column]:
    """Start (from 0) and length of a segment: all equal, the last ones longer by one where it does not divide."""
    short, longer = F.call_function("div", length, F.lit(edits + 1)).cast("int"), length % (edits + 1)
    first_longer = F.lit(edits + 1) - longer
    extra = F.greatest(number - first_longer, F.lit(0))
    return short * number + extra, short + F.when(number >= first_longer, 1).otherwise(0)


def letter_counts(line: Column) -> Column:
    """Counts of the letters modulo 256: an array of numbers of eight bytes, a byte each."""
    numbers = []
    for first in range(0, len(LETTERS), 8):
        counts = F.lit(0).cast("long")
        for i, letter in enumerate(LETTERS[first:first + 8]):
            count = F.octet_length(line) - F.octet_length(F.replace(line, F.lit(letter), F.lit("")))
            counts = counts.bitwiseOR(F.shiftleft(count.cast("long").bitwiseAND(F.lit(255)), 8 * i))
        numbers.append(counts)
    return F.array(*numbers)


def count_distance(a: Column, b: Column) -> Column:
    """At most the number of letters that tell two lines apart: an edit changes it by two at most."""
    total = F.lit(0).cast("long")
    for n in range(0, len(LETTERS), 8):
        for i in range(len(LETTERS[n:n + 8])):
            of = lambda x: F.shiftrightunsigned(x[n // 8], 8 * i).bitwiseAND(F.lit(255))  # noqa: E731, B023
            apart = F.abs(of(a) - of(b))
            total = total + F.least(apart, F.lit(256) - apart)
    return total


def pieces_near(a: Column, b: Column, edits: int) -> Column:
    """Do all but so many pieces of a occur in b, shifted by no more?  Each edit spoils one piece at most."""
    found = F.lit(0)
    for number in range(PIECES):
        start, size = _segment(F.length(a), F.lit(number), PIECES - 1)
        low = F.greatest(start - edits, F.lit(0))
        there = F.substring(b, low + 1, start + size + edits - low)
        found = found + F.when(there.contains(F.substring(a, start + 1, size)), 1).otherwise(0)
    return found >= PIECES - edits


def segment_keys(line: Column, length: Column, edits: int) -> tuple[list[int], Column]:
    """Hashes of the substrings that may be segments of lines as long or shorter (or null), and which of them are
    the line's own segments.

    One small expression over a constant list of places: written out for each place it makes a method too large for
    the JVM to compile.
    """
    def key(x: Column) -> Column:
        other = length - x["shorter"]
        start, size = _segment(other, x["number"], edits)
        at = start + x["shift"]
        found = F.xxhash64(other, x["number"], F.substring(line, at + 1, size))
        return F.when((at >= 0) & (at + size <= length), found)

    sought = [
        (shorter, number, shift)
        for shorter in range(edits + 1) for number in range(edits + 1)
        for shift in range(max(-number, shorter - (edits - number)), min(number, shorter + (edits - number)) + 1)]
    places = F.array(*(F.struct(F.lit(a).alias("shorter"), F.lit(b).alias("number"), F.lit(c).alias("shift")) for a, b, c in sought))
    return [sought.index((0, number, 0)) for number in range(edits + 1)], F.transform(places, key)


def within_edits(a: Column, b: Column, edits: int) -> Column:
    """Is the edit distance of two texts at most so many?  Banded and bit-parallel.

    State: for e = 0..edits the set of diagonals reached with at most e errors, as bits; bit edits is
    the main diagonal, a higher bit is further in b.
    """
    band = (1 << (2 * edits + 1)) - 1
    chars_a, chars_b = F.split(a, ""), F.split(b, "")
    shifted = []  # b's character on each diagonal, for each character of a
    for diagonal in range(-edits, edits + 1):
        if diagonal <= 0:
            shifted.append(F.concat(F.array_repeat(F.lit(""), -diagonal), chars_b))
        else:
            shifted.append(F.slice(chars_b, diagonal + 1, F.greatest(F.length(b), F.lit(1))))
    places = F.arrays_zip(chars_a.alias("a"), *(s.alias(f"b{i}") for i, s in enumerate(shifted)))

    def step(state: Column, x: Column) -> Column:
        same = sum((F.when(x["a"] == x[f"b{i}"], 1 << i).otherwise(0) for i in range(2 * edits + 1)), F.lit(0))
        out: list[Column] = []
        for e in range(edits + 1):
            reached = state[f"r{e}"].bitwiseAND(same)
            if e:
                fewer = state[f"r{e - 1}"]
                reached = reached.bitwiseOR(fewer).bitwiseOR(F.shiftright(fewer, 1))
                reached = reached.bitwiseOR(F.shiftleft(out[-1], 1)).bitwiseAND(F.lit(band))
            out.append(reached)
        moved = F.struct(*(r.alias(f"r{e}") for e, r in enumerate(out)))
        return F.when(x["a"].isNull(), state).otherwise(moved)

    # Before the first character: e insertions reach e diagonals further.
    start = F.struct(*(F.lit(((1 << (e + 1)) - 1) << edits).alias(f"r{e}") for e in range(edits + 1)))
    end = F.length(b) - F.length(a) + edits
    last = F.aggregate(places, start, step, lambda s: s[f"r{edits}"])
    fits = F.abs(F.length(b) - F.length(a)) <= edits
    empty = (F.length(a) == 0) | (F.length(b) == 0)
    return F.when(~fits, False).when(empty, True).otherwise(F.expr("true") & (F.call_function("shiftright", last, end).bitwiseAND(F.lit(1)) == 1))


def near_pairs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", edits: int = EDITS, min_chars: int = MIN_CHARS) -> DataFrame:
    """Pairs of different lines within so many edits: columns h_a, m_a, h_b, m_b, each pair once."""
    own, keys = segment_keys(F.col("line"), F.col("length"), edits)
    # The length is a column of its own: within the keys it would be counted for each of them.
    lines = _lines(docs, id_col, text_col, min_chars).withColumn("length", F.length("line")).select("h", "m", keys.alias("keys"))
    distinct = written(lines.groupBy("h", "m").agg(F.first("keys").alias("keys")), "line-keys")
    index = distinct.select(F.explode(F.array(*[F.col("keys")[at] for at in own])).alias("segment"), "h")
    probes = distinct.select(F.explode("keys").alias("segment"), "h").where("segment is not null")
    # First which segments meet any other line at all: as many rows at most as there are, whatever shares a segment.
    index = written(index.alias("x").join(probes.alias("y"), (F.col("x.segment") == F.col("y.segment")) & (F.col("x.h") != F.col("y.h")), "left_semi"), "line-index")
    found = index.select("segment").distinct()
    probes = written(maybe_in(probes, "segment", bit_filter(found, "segment")).join(found, "segment", "left_semi"), "line-probes")

    # Then those lines alone, with what tells most of them apart.
    wanted = index.select("h").unionByName(probes.select("h")).distinct()
    texts = written(maybe_in(_lines(docs, id_col, text_col, min_chars).select("h", "m", "line"), "h", bit_filter(wanted, "h"))
                    .join(wanted, "h", "left_semi").groupBy("h", "m").agg(F.first("line").alias("line"))
                    .withColumn("letters", letter_counts(F.col("line"))), "line-texts")
    counts = texts.select("h", "letters")
    left = index.join(counts, "h").select("segment", F.col("h").alias("h_a"), F.col("letters").alias("letters_a"))
    right = probes.join(counts, "h").select("segment", F.col("h").alias("h_b"), F.col("letters").alias("letters_b"))
    close = count_distance(F.col("letters_a"), F.col("letters_b")) <= 2 * edits
    both = left.join(right, "segment").where((F.col("h_a") != F.col("h_b")) & close)
    pairs = written(both.select(F.least("h_a", "h_b").alias("h_a"), F.greatest("h_a", "h_b").alias("h_b")).distinct(), "line-pairs")

    side = lambda s: texts.select(F.col("h").alias(f"h_{s}"), F.col("m").alias(f"m_{s}"), F.col("line").alias(f"line_{s}"))
    both = pairs.join(side("a"), "h_a").join(side("b"), "h_b")
    near = pieces_near(F.col("line_a"), F.col("line_b"), edits) & within_edits(F.col("line_a"), F.col("line_b"), edits)
    return both.where(near).select("h_a", "m_a", "h_b", "m_b")


def removed_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", edits: int = EDITS,
                  min_chars: int = MIN_CHARS) -> DataFrame:
    """Columns id, key, removed (line numbers from 0): a row for each document that loses lines."""
    lines = _lines(docs, id_col, text_col, min_chars).select("id", "key", "line_no", "h", "m", _place().alias("place"))
    classes = lines.groupBy("h", "m").agg(F.min("place").alias("first"), F.count("*").alias("n"))
    pairs = written(near_pairs(docs, id_col, text_col, edits, min_chars), "line-links")
    # Of each pair the line that first occurs later is no first occurrence of its class.
    ends = pairs.select(F.posexplode(F.array(F.struct(F.col("h_a").alias("h"), F.col("m_a").alias("m"), F.col("h_b").alias("other"), F.col("m_b").alias("other_m")),
                                             F.struct(F.col("h_b").alias("h"), F.col("m_b").alias("m"), F.col("h_a").alias("other"), F.col("m_a").alias("other_m")))).alias("side", "x"))
    ends = ends.select("x.*")
    starts = written(classes.join(ends.select("h", "m").distinct(), ["h", "m"], "left_semi").select("h", "m", "first"), "line-starts")
    others = starts.select(F.col("h").alias("other"), F.col("m").alias("other_m"), F.col("first").alias("other_first"))
    later = ends.join(starts, ["h", "m"]).join(others, ["other", "other_m"]).where("other_first < first").select("h", "m").distinct()
    marks = classes.join(later.withColumn("later", F.lit(True)), ["h", "m"], "left").where("n > 1 or later")
    gone = lines.join(marks.select("h", "m", "first", "later"), ["h", "m"]).where("later or place > first")
    return gone.groupBy("id", "key").agg(F.array_sort(F.collect_set("line_no")).alias("removed"))


def marked(docs: DataFrame, removed_col: str = "removed", id_col: str = "doc_id", text_col: str = "text", edits: int = EDITS,
           min_chars: int = MIN_CHARS) -> DataFrame:
    """The frame with the numbers of the lines to remove (an empty array where none)."""
    gone = removed_lines(docs, id_col, text_col, edits, min_chars)
    id_name, key_name = free_name(docs, "__line_id"), free_name(docs, "__line_key")
    gone = gone.select(F.col("id").alias(id_name), F.col("key").alias(key_name), F.col("removed").alias(removed_col))
    joined = docs.join(gone, docs[id_col].eqNullSafe(gone[id_name]) & (text_key(docs[text_col]) == gone[key_name]), "left")
    return joined.drop(id_name, key_name).withColumn(removed_col, F.coalesce(removed_col, F.array().cast("array<int>")))


def text_without(text: Column, removed: Column) -> Column:
    """A text without the lines of those numbers."""
    kept = F.filter(F.split(text, "\n"), lambda _, i: ~F.array_contains(removed, i))
    return F.when(F.size(removed) > 0, F.array_join(kept, "\n")).otherwise(text)


def without_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", edits: int = EDITS, min_chars: int = MIN_CHARS) -> DataFrame:
    """The documents, each text without the lines that occur earlier."""
    removed = free_name(docs, "__removed")
    found = marked(docs, removed, id_col, text_col, edits, min_chars)
    return found.withColumn(text_col, text_without(F.col(text_col), F.col(removed))).select(*docs.columns)
