"""Best-fit packing of tokenized documents into sequences, by the sum-of-squares rule.

A document is its token ids and one end id.  A document longer than the capacity is cut into
pieces of exactly the capacity, the last one shorter; no other document is cut.  A piece that fills
a sequence is one.  The others are dealt into groups of bounded size by a hash, and each group is
packed on its own: longest piece first, into the open sequence for which the sum over all gaps g of
N(g)^2 becomes smallest, N(g) being the open sequences with g tokens free; ties take the smallest
gap.  A new sequence is opened only when none open has room (opening whenever the rule alone
prefers it wastes 1 to 2 % of the sequences on lengths in decreasing order).  Each group ends with
about one sequence that is not filled, so groups are as large as a task holds with ease.

Only lengths and checksums are shuffled, never texts or ids.

Defined cases: a null or empty text is a document of the end id alone; very long texts are cut as
above; rows with equal ids or repeated whole are documents of their own (pieces are told apart by
the scan position); a null id is carried through; an empty table gives no rows.  Columns besides
id and text are not looked at.
"""

from __future__ import annotations

import os
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bazaarlake.llm.chunks import ChunkEncodings
from bazaarlake.llm.common import groups_for, written
from bazaarlake.llm.terms import slices

CAPACITY = 2048
END_ID = 0
GROUP_ROWS = 20_000
DOCS_AT_ONCE, BYTES_AT_ONCE = 1024, 4 << 20
WORDS_AT_ONCE = 64
#: Texts of that many chunks that are encoded together: an encoding holds some 100 bytes a token besides its ids.
GROUPS_AT_ONCE = 128
#: Chunks that a worker keeps the ids of, some 150 bytes each.
KNOWN_CHUNKS = 350_000

PIECES = "doc long, scanned long, piece int, start long, length long, ids_crc32 long"

class WordTokenizer:
    """Ids of whole texts for a tokenizer that drops white space, by the chunks between ASCII white space."""

    SEPARATOR = "~"

    def __init__(self, definition: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(definition)
        self.separator = self.tokenizer.encode(self.SEPARATOR, add_special_tokens=False).ids
        self.chunks = ChunkEncodings(self._encode, KNOWN_CHUNKS)

    def _encode(self, chunks: list[str]) -> list[bytes]:
        """Some chunks at a time as one text with separators, which costs half of one by one."""
        groups = [chunks[i:i + WORDS_AT_ONCE] for i in range(0, len(chunks), WORDS_AT_ONCE)]
        out: list[bytes] = []
        for first in range(0, len(groups), GROUPS_AT_ONCE):
            out += self._encode_groups(groups[first:first + GROUPS_AT_ONCE])
        return out

    def _encode_groups(self, groups: list[list[str]]) -> list[bytes]:
        out: list[bytes] = []
        found = self.tokenizer.encode_batch_fast([f" {self.SEPARATOR} ".join(g) for g in groups], add_special_tokens=False)
        for group, encoding in zip(groups, found):
            ids = np.asarray(encoding.ids, dtype="<u4")
            cuts = (4 * np.flatnonzero(ids == self.separator[0])).tolist()
            if len(self.separator) == 1 and len(cuts) == len(group) - 1:
                raw = ids.tobytes()
                out += [raw[a:b] for a, b in zip([0, *(c + 4 for c in cuts)], [*cuts, len(raw)])]
            else:  # a chunk holds the separator itself
                alone = self.tokenizer.encode_batch_fast(group, add_special_tokens=False)
                out += [np.asarray(e.ids, dtype="<u4").tobytes() for e in alone]
        return out

    def ids(self, texts: pa.Array) -> list[bytes]:
        """Little-endian 32-bit ids of each text."""
        return self.chunks.of_lists(pc.ascii_split_whitespace(pc.fill_null(texts, "")))


_tokenizers: dict[int, WordTokenizer] = {}


def _tokenizer(definition: str) -> WordTokenizer:
    """One per Python worker, so that words stay known from task to task."""
    # A task has one core: threads of its own only hold memory.
    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
    key = zlib.crc32(definition.encode())
    if key not in _tokenizers:
        _tokenizers.clear()
        _tokenizers[key] = WordTokenizer(definition)
    return _tokenizers[key]


def tokenized_pieces(docs: DataFrame, definition: str, capacity: int = CAPACITY, end_id: int = END_ID,
                     id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """A row per piece: doc, scanned (the document's place in the scan), piece, start, length, ids_crc32."""
    shared = docs.sparkSession.sparkContext.broadcast(definition)
    end = np.asarray([end_id], dtype="<u4").tobytes()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = _tokenizer(shared.value)
        for rows in slices(batches, 2, BYTES_AT_ONCE, DOCS_AT_ONCE):
            out = ([], [], [], [], [], [])
            ids_of = tokenizer.ids(rows.column(2))
            for doc, scanned, ids in zip(rows.column(0).to_pylist(), rows.column(1).to_pylist(), ids_of):
                ids += end
                for piece, at in enumerate(range(0, len(ids), 4 * capacity)):
                    part = ids[at:at + 4 * capacity]
                    for column, value in zip(out, (doc, scanned, piece, at // 4, len(part) // 4, zlib.crc32(part))):
                        column.append(value)
            kinds = (pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64())
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(out, kinds)],
                names=["doc", "scanned", "piece", "start", "length", "ids_crc32"])

    return docs.select(
        F.col(id_col).cast("long").alias("doc"), F.monotonically_increasing_id().alias("scanned"), F.col(text_col).alias("body"),
    ).mapInArrow(cut, PIECES)


def sum_of_squares(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """Sequence number and offset of each length, placed in the order given."""
    open_by_gap: list[list[int]] = [[] for _ in range(capacity + 1)]
    count = np.zeros(capacity + 1, dtype=np.int64)
    sequence, offset = np.empty(len(lengths), np.int64), np.empty(len(lengths), np.int64)
    opened, never = 0, np.iinfo(np.int64).max
    for i, length in enumerate(lengths.tolist()):
        before = count[length:]  # gaps with room, by the gap left over
        change = 2 * (count[:capacity + 1 - length] - before) + 2
        change[0] = 1 - 2 * before[0]  # a filled sequence counts no more
        change = np.where(before > 0, change, never)
        left = int(change.argmin())
        if change[left] == never:
            sequence[i], offset[i], gap, opened = opened, 0, capacity - length, opened + 1
        else:
            sequence[i], offset[i] = open_by_gap[left + length].pop(), capacity - left - length
            count[left + length] -= 1
            gap = left
        if gap:
            open_by_gap[gap].append(int(sequence[i]))
            count[gap] += 1
    return sequence, offset


def pack(docs: DataFrame, definition: str, capacity: int = CAPACITY, end_id: int = END_ID,
         group_rows: int = GROUP_ROWS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Columns id_col, piece, start, length, ids_crc32, sequence_id, offset; definition is the tokenizer's JSON."""
    pieces = written(tokenized_pieces(docs, definition, capacity, end_id, id_col, text_col), "packing")
    full = pieces.where(F.col("length") == capacity).select(
        "doc", "piece", "start", "length", "ids_crc32",
        (F.lit(1 << 61) + F.monotonically_increasing_id()).alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
    shorter = pieces.where(F.col("length") < capacity)
    groups = groups_for(shorter.count(), group_rows)

    def place(rows: pa.Table) -> pa.Table:
        rows = rows.sort_by([("length", "descending"), ("scanned", "ascending"), ("piece", "ascending")])
        number, offset = sum_of_squares(rows.column("length").to_numpy(), capacity)
        number += rows.column("dealt")[0].as_py() * (1 << 32)
        rows = rows.select(["doc", "piece", "start", "length", "ids_crc32"])
        return rows.append_column("sequence_id", pa.array(number)).append_column("offset", pa.array(offset))

    packed = shorter.withColumn("dealt", F.pmod(F.xxhash64("scanned", "piece"), F.lit(groups))).groupBy("dealt").applyInArrow(
        place, "doc long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long")
    return full.unionByName(packed).withColumnRenamed("doc", id_col)
