"""Terms of many texts at once: runs of bytes of one class, grouped through packed keys.

The texts of a slice are one array of UTF-8 bytes.  A term is a maximal run of member bytes within a text;
as every byte of a non-ASCII character is 0x80 or more, classes of ASCII characters and "all others" can be told
by bytes.  Terms of up to 8 bytes are packed into one unsigned 64-bit word, of up to 16 into two, and put in
order by a radix sort of 16 bits a pass; longer terms are sorted as bytes, in a bucket for each power of two.
Terms hold no zero byte, so padding with zeros keeps them apart.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc


def member_bytes(*ranges: tuple[int, int]) -> np.ndarray:
    """A table of 256 marks; the ranges include their ends."""
    table = np.zeros(256, bool)
    for low, high in ranges:
        table[low:high + 1] = True
    return table


LETTERS = member_bytes((0x41, 0x5A), (0x61, 0x7A), (0x80, 0xFF))
LETTERS_AND_DIGITS = LETTERS | member_bytes((0x30, 0x39))
_FOLDED = np.arange(256, dtype=np.uint8)
_FOLDED[0x41:0x5B] += 32


def slices(batches: Iterator[pa.RecordBatch], text: int, most_bytes: int, most_rows: int) -> Iterator[pa.RecordBatch]:
    """The rows of the batches anew, as many together as both limits let; a text beyond the limit comes alone."""
    held: list[pa.RecordBatch] = []
    held_bytes = held_rows = 0

    def flushed() -> pa.RecordBatch:
        return pa.Table.from_batches(held).combine_chunks().to_batches()[0]

    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch.column(text)), 0).to_numpy().astype(np.int64)
        ends = np.cumsum(sizes)
        first = 0
        while first < batch.num_rows:
            before = ends[first - 1] if first else 0
            last = int(np.searchsorted(ends, before + most_bytes - held_bytes, "right"))
            last = min(last, first + most_rows - held_rows, batch.num_rows)
            if last <= first and held:  # nothing more fits
                yield flushed()
                held, held_bytes, held_rows = [], 0, 0
                continue
            last = max(last, first + 1)
            held.append(batch.slice(first, last - first))
            held_bytes += int(ends[last - 1] - before)
            held_rows += last - first
            first = last
    if held:
        yield flushed()


def text_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts (null: none) and where each begins, with the end of the last."""
    texts = pc.cast(pc.fill_null(texts, ""), pa.large_binary())
    _, ends, data = texts.buffers()
    ends = np.frombuffer(ends, np.int64)[texts.offset:texts.offset + len(texts) + 1] if len(texts) else np.zeros(1, np.int64)
    data = np.frombuffer(data, np.uint8) if data is not None and data.size else np.empty(0, np.uint8)
    return data[ends[0]:ends[-1]], ends - ends[0]


@dataclass
class Terms:
    """Terms in text order: folded bytes (with room after the last term), start, size and number of the text of each."""

    data: np.ndarray
    start: np.ndarray
    size: np.ndarray
    text: np.ndarray

    def strings(self, which: np.ndarray) -> pa.Array:
        """Those terms as strings."""
        start, size = self.start[which], self.size[which]
        ends = np.concatenate([[0], np.cumsum(size)])
        at = np.repeat(start - ends[:-1], size) + np.arange(ends[-1])
        return pa.LargeStringArray.from_buffers(len(which), pa.py_buffer(ends.astype(np.int64).tobytes()), pa.py_buffer(self.data[at].tobytes()))


def terms_of(data: np.ndarray, ends: np.ndarray, members: np.ndarray) -> Terms:
    """The terms of texts as given by `text_bytes`, A to Z as lower case."""
    inside = members[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[ends] = True
    before, after = np.ones(len(data), bool), np.ones(len(data), bool)
    before[1:], after[:-1] = ~inside[:-1], ~inside[1:]
    start = np.flatnonzero(inside & (before | edge[:-1]))
    size = np.flatnonzero(inside & (after | edge[1:])) + 1 - start
    room = 1 << int(size.max() - 1).bit_length() if len(size) else 0
    folded = np.zeros(len(data) + max(room, 16), np.uint8)
    folded[:len(data)] = _FOLDED[data]
    return Terms(folded, start, size, np.searchsorted(ends, start, "right") - 1)


def radix_order(keys: list[np.ndarray]) -> np.ndarray:
    """The stable order by unsigned 64-bit keys, the first key first: counting sorts of 16 bits from the last to the first."""
    order = np.arange(len(keys[0]))
    for key in reversed(keys):
        for shift in (0, 16, 32, 48):
            digit = (key >> np.uint64(shift)).astype(np.uint16)
            if len(digit) and (digit != digit[0]).any():
                order = order[digit[order].argsort(kind="stable")]
    return order


def _word(terms: Terms, which: np.ndarray, first: int) -> np.ndarray:
    """Eight bytes of each term from byte `first` on, zeros past its end."""
    every = np.ndarray(len(terms.data) - 7, ">u8", terms.data, strides=(1,))
    left = np.minimum(terms.size[which] - first, 8)
    kept = np.array([0] + [((1 << 8 * n) - 1) << 8 * (8 - n) for n in range(1, 9)], np.uint64)
    return every[terms.start[which] + first].astype(np.uint64) & kept[left]


def grouped(terms: Terms, part: np.ndarray | None = None) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Per length bucket: the numbers of its terms with equal ones (of one part) side by side, in text order among
    themselves, and marks where another term (or part) begins."""
    parts = [] if part is None else [part.astype(np.uint64)]
    of = lambda which: [p[which] for p in parts]
    short, middle = terms.size <= 8, (terms.size > 8) & (terms.size <= 16)
    for chosen, words in ((short, 1), (middle, 2)):
        which = np.flatnonzero(chosen)
        if len(which):
            keys = of(which) + [_word(terms, which, 8 * k) for k in range(words)]
            order = radix_order(keys)
            yield which[order], _changes([k[order] for k in keys])
    longer = np.flatnonzero(terms.size > 16)
    bits = np.frexp((terms.size[longer] - 1).astype(np.float64))[1]
    for b in np.unique(bits):
        which, width = longer[bits == b], 1 << int(b)
        rows = np.lib.stride_tricks.sliding_window_view(terms.data, width)[terms.start[which]]
        rows[np.arange(width) >= terms.size[which][:, None]] = 0
        keys = rows.view(f"S{width}").ravel()
        order = keys.argsort(kind="stable")
        if parts:
            order = order[radix_order([p[order] for p in of(which)])]
        yield which[order], _changes([k[order] for k in [*of(which), keys]])


def _changes(keys: list[np.ndarray]) -> np.ndarray:
    fresh = np.zeros(len(keys[0]), bool)
    fresh[0] = True
    for key in keys:
        fresh[1:] |= key[1:] != key[:-1]
    return fresh
