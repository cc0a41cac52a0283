"""Byte-level BPE: encoding by a segment tree over byte positions, and decoding.

A piece of text starts as one token per byte.  A segment tree over the byte positions holds, at
each position, the rank of the pair that starts there, together with the position, so that the root
is the leftmost pair of the smallest rank.  A merge joins that pair, and updates the tree at the two
or three positions whose pair changed, a path of logarithmic length each.  Pieces are merged many at
a time: the trees of equally wide pieces are the rows of one array, and each step advances every
piece that still has a pair.

A piece that occurs again in the same Python worker is looked up; the cache has a fixed size.

Defined cases: a null text is an empty one, it has no ids; very long texts are encoded whole, very long pieces
get a tree of their own width; rows with equal ids or repeated whole are encoded alike, one row out for each row
in; an empty table gives no rows.  Columns besides id and text are not looked at.
"""

from __future__ import annotations

import base64
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bazaarlake.llm.terms import slices

#: Texts encoded together: the more, the fewer pieces are new to a batch.
DOCS_AT_ONCE, BYTES_AT_ONCE = 1024, 4 << 20
#: Cells of one array of trees; wider batches are cut.
CELLS_AT_ONCE = 1 << 19
_NONE = np.int64(1) << 62
_BETWEEN = re.compile(r"(?<=\S) (?=\S)")
#: White space at an end of a text or side by side, for Arrow's expressions.
_SPACE = r"[\s\x0b\x1c-\x1f\x{85}\p{Z}]"
_ODD_SPACE = f"{_SPACE}{_SPACE}|^{_SPACE}|{_SPACE}$"
#: Pieces whose ids a worker remembers, and the longest of them; when full it starts anew.
PIECES_KNOWN, LONGEST_KNOWN = 300_000, 40


class ByteBpe:
    """ranks: token bytes to id, the ids in the order of merging."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.ranks, self.pattern = ranks, regex.compile(pattern)
        by_id = [b""] * (max(ranks.values(), default=-1) + 1)
        for token, i in ranks.items():
            by_id[i] = token
        self.tokens = pa.array(by_id, pa.large_binary())
        self.known: dict[str, bytes] = {}
        self.first = np.array([ranks.get(bytes([b]), -1) for b in range(256)], dtype=np.int64)
        # Pairs of tokens that form a token: key left * 2^32 + right, value the formed id, which is its rank.
        keys, formed = [], []
        for token, i in ranks.items():
            for cut in range(1, len(token)):
                left, right = ranks.get(token[:cut]), ranks.get(token[cut:])
                if left is not None and right is not None:
                    keys.append((left << 32) + right)
                    formed.append(i)
        order = np.argsort(np.array(keys, dtype=np.int64))
        self.keys = np.append(np.array(keys, dtype=np.int64)[order], np.iinfo(np.int64).max)
        self.formed = np.append(np.array(formed, dtype=np.int64)[order], -1)

    def pair_rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        key = (left << 32) + right
        at = np.searchsorted(self.keys, key)
        return np.where((self.keys[at] == key) & (left >= 0) & (right >= 0), self.formed[at], -1)

    def merge(self, pieces: list[bytes]) -> list[np.ndarray]:
        """Ids of each piece; all pieces of one call share the width of the longest, rounded up."""
        width = 1 << max(0, max(map(len, pieces)) - 1).bit_length()
        n, steps = len(pieces), width.bit_length() - 1
        size = np.fromiter(map(len, pieces), np.int64, n)
        flat = np.frombuffer(b"".join(p.ljust(width, b"\0") for p in pieces), np.uint8).reshape(n, width)
        place = np.arange(width)
        token = np.where(place < size[:, None], self.first[flat], -1)  # -1: past the end, or merged away
        before = np.broadcast_to(place - 1, (n, width)).copy()
        after = np.where(place + 1 < size[:, None], place + 1, width)  # width: no live neighbour
        tree = np.full((n, 2 * width), _NONE)

        def leaf(rank: np.ndarray, at: np.ndarray) -> np.ndarray:
            return np.where(rank >= 0, rank * width + at, _NONE)

        if width > 1:
            tree[:, width:-1] = leaf(self.pair_rank(token[:, :-1], token[:, 1:]), place[:-1])
            for level in range(steps - 1, -1, -1):
                lo = 1 << level
                tree[:, lo:2 * lo] = np.minimum(tree[:, 2 * lo:4 * lo:2], tree[:, 2 * lo + 1:4 * lo:2])

        def update(rows: np.ndarray, at: np.ndarray) -> None:
            """Sets the leaf of the pair that starts at a live position, and its ancestors."""
            following = after[rows, at]
            right = np.where(following < width, token[rows, np.minimum(following, width - 1)], -1)
            node = at + width
            tree[rows, node] = leaf(self.pair_rank(token[rows, at], right), at)
            for _ in range(steps):
                node = node >> 1
                tree[rows, node] = np.minimum(tree[rows, 2 * node], tree[rows, 2 * node + 1])

        live = np.flatnonzero(tree[:, 1] < _NONE) if width > 1 else np.empty(0, np.int64)
        while len(live):
            rank, at = np.divmod(tree[live, 1], width)
            gone = after[live, at]
            token[live, at] = rank
            token[live, gone] = -1
            following = after[live, gone]
            after[live, at] = following
            kept = following < width
            before[live[kept], following[kept]] = at[kept]
            # The merged-away position starts no pair: a dead leaf, set like any other.
            node = gone + width
            tree[live, node] = _NONE
            for _ in range(steps):
                node = node >> 1
                tree[live, node] = np.minimum(tree[live, 2 * node], tree[live, 2 * node + 1])
            update(live, at)
            left = before[live, at]
            has_left = left >= 0
            update(live[has_left], left[has_left])
            live = live[tree[live, 1] < _NONE]
        return [row[row >= 0] for row in token]

    def encode_pieces(self, pieces: list[str]) -> list[bytes]:
        """Little-endian 32-bit ids of each piece."""
        raw = [p.encode("utf-8", "surrogatepass") for p in pieces]
        out: list[bytes] = [b""] * len(raw)
        by_width: dict[int, list[int]] = {}
        for i, piece in enumerate(raw):
            whole = self.ranks.get(piece)
            if whole is not None:
                out[i] = whole.to_bytes(4, "little")
            elif piece:
                by_width.setdefault((len(piece) - 1).bit_length(), []).append(i)
        for bits, members in by_width.items():
            step = max(1, CELLS_AT_ONCE >> bits)
            for first in range(0, len(members), step):
                some = members[first:first + step]
                for i, ids in zip(some, self.merge([raw[i] for i in some])):
                    out[i] = ids.astype("<u4").tobytes()
        return out

    def _ids_of(self, pieces: list[str]) -> list[bytes]:
        """Ids of distinct pieces, known ones from the cache."""
        if len(self.known) > PIECES_KNOWN:
            self.known.clear()
        found = list(map(self.known.get, pieces))
        missing = [i for i, x in enumerate(found) if x is None]
        for i, ids in zip(missing, self.encode_pieces([pieces[i] for i in missing])):
            found[i] = ids
            if len(pieces[i]) <= LONGEST_KNOWN:
                self.known[pieces[i]] = ids
        return found

    def _encode_texts(self, texts: list[str]) -> list[bytes]:
        split = [self.pattern.findall(t) for t in texts]
        distinct = list({p for pieces in split for p in pieces})
        ids = dict(zip(distinct, self._ids_of(distinct)))
        return [b"".join(map(ids.__getitem__, pieces)) for pieces in split]

    def _encode_spaced(self, chunks: list[str]) -> pa.Array:
        """Ids of each chunk with a space before it; the pattern runs once over all chunks side by side.

        No chunk is empty, begins or ends with white space.
        """
        pieces = pa.array(self.pattern.findall(" " + " ".join(chunks)) if chunks else [], pa.large_string()).dictionary_encode()
        codes = pa.array(self._ids_of(pieces.dictionary.to_pylist()), pa.large_binary()).take(pieces.indices)
        ends = np.concatenate([[0], np.cumsum(pc.utf8_length(pieces.dictionary).take(pieces.indices).to_numpy())])
        starts = np.concatenate([[0], np.cumsum(np.fromiter(map(len, chunks), np.int64, len(chunks)) + 1)])
        at = np.searchsorted(ends, starts)
        if not (ends[np.minimum(at, len(ends) - 1)] == starts).all():  # the pattern does not start anew at every space
            return pa.array(self._encode_texts([" " + c for c in chunks]), pa.large_binary())
        cuts = _ends(codes)[at]
        return pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(chunks), [None, pa.py_buffer(cuts.tobytes()), codes.buffers()[2]])

    def _encode_plain(self, texts: pa.Array) -> list[bytes]:
        """Of texts in which every space stands between two characters that are not white space."""
        lists = pc.split_pattern(texts, " ")
        ends = lists.offsets.to_numpy()
        firsts = self._encode_texts(lists.values.take(pa.array(ends[:-1])).to_pylist())  # the only chunks without a space before them
        flat = pc.list_slice(lists, 1).flatten().dictionary_encode()
        codes = self._encode_spaced(flat.dictionary.to_pylist()).take(flat.indices)
        at = _ends(codes)[ends - ends[0] - np.arange(len(ends))].tolist()
        data = memoryview(codes.buffers()[2] or b"")
        return [first + data[a:b] for first, a, b in zip(firsts, at, at[1:])]

    def _encode_spaced_out(self, texts: list[str]) -> list[bytes]:
        """Of any texts: cut at the single spaces between other characters; what is between them is remembered whole."""
        parts = [_BETWEEN.split(t) for t in texts]
        parts = [[first, *(" " + c for c in rest)] for first, *rest in parts]
        distinct = list(dict.fromkeys(c for chunks in parts for c in chunks))
        ids = dict(zip(distinct, self._encode_texts(distinct)))
        return [b"".join(map(ids.__getitem__, chunks)) for chunks in parts]

    def encode(self, texts: pa.Array) -> list[bytes]:
        """Little-endian 32-bit ids of each text.

        A space between two characters that are not white space always starts a match of the pattern, so a text is cut
        there into chunks; other white space stays within a chunk.
        """
        texts = pc.fill_null(texts, "")
        odd = pc.match_substring_regex(texts, _ODD_SPACE)
        plain = iter(self._encode_plain(texts.filter(pc.invert(odd))))
        others = iter(self._encode_spaced_out(texts.filter(odd).to_pylist()))
        return [next(others if is_odd else plain) for is_odd in odd.to_pylist()]

    def decode_many(self, ids: list[bytes]) -> list[bytes]:
        """The bytes that each list of ids stands for."""
        flat = np.frombuffer(b"".join(ids), "<u4").astype(np.int64)
        found = self.tokens.take(pa.array(flat))
        at = _ends(found)[np.concatenate([[0], np.cumsum([len(x) // 4 for x in ids], dtype=np.int64)])].tolist()
        data = memoryview(found.buffers()[2] or b"")
        return [bytes(data[a:b]) for a, b in zip(at, at[1:])]

    def decode(self, ids: bytes) -> bytes:
        return self.decode_many([ids])[0]


def _ends(codes: pa.Array) -> np.ndarray:
    """Where each item of a large binary array begins in its data, and where the last ends."""
    return np.frombuffer(codes.buffers()[1], np.int64)[codes.offset:codes.offset + len(codes) + 1] if len(codes) else np.zeros(1, np.int64)


def read_ranks(lines: bytes) -> dict[bytes, int]:
    """A rank file: a base64 token and its rank on each line."""
    return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines.splitlines())}


_codecs: dict[int, ByteBpe] = {}


def _codec(rank_file: bytes, pattern: str) -> ByteBpe:
    """One per Python worker, so that pieces stay known from task to task."""
    key = zlib.crc32(rank_file + pattern.encode())
    if key not in _codecs:
        _codecs.clear()
        _codecs[key] = ByteBpe(read_ranks(rank_file), pattern)
    return _codecs[key]


def _coded(docs: DataFrame, rank_file: bytes, pattern: str, id_col: str, text_col: str, back: bool) -> DataFrame:
    shared = docs.sparkSession.sparkContext.broadcast(rank_file)

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = _codec(shared.value, pattern)
        for rows in slices(batches, 1, BYTES_AT_ONCE, DOCS_AT_ONCE):
            ids = codec.encode(rows.column(1))
            columns = [rows.column(0), pa.array(ids, pa.binary())]
            if back:
                columns.append(pa.array(codec.decode_many(ids), pa.binary()))
            yield pa.RecordBatch.from_arrays(columns, names=["id", "ids", "decoded"][:len(columns)])

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("body")).mapInArrow(
        encode, f"id {kind}, ids binary" + (", decoded binary" if back else "")).withColumnRenamed("id", id_col)


def encode_documents(docs: DataFrame, rank_file: bytes, pattern: str, id_col: str = "doc_id",
                     text_col: str = "text") -> DataFrame:
    """Columns id_col, ids (binary: little-endian unsigned 32-bit)."""
    return _coded(docs, rank_file, pattern, id_col, text_col, back=False)


def round_trip_documents(docs: DataFrame, rank_file: bytes, pattern: str, id_col: str = "doc_id",
                         text_col: str = "text") -> DataFrame:
    """As `encode_documents`, and decoded: the bytes that the ids stand for, in the same pass."""
    return _coded(docs, rank_file, pattern, id_col, text_col, back=True)


def decode_documents(encoded: DataFrame, rank_file: bytes, pattern: str, ids_col: str = "ids",
                     bytes_col: str = "decoded") -> DataFrame:
    """The frame with the bytes that the ids stand for; null ids stand for null."""
    shared = encoded.sparkSession.sparkContext.broadcast(rank_file)

    def decode(ids):
        codec = _codec(shared.value, pattern)
        return pa.array(codec.decode_many(ids.fill_null(b"").to_pylist()), pa.binary(), mask=ids.is_null().to_numpy(zero_copy_only=False))

    return encoded.withColumn(bytes_col, F.arrow_udf(decode, "binary")(F.col(ids_col)))
