"""Encoding many texts through their distinct space-free chunks.

Most chunks of a batch occur more than once.  Arrow splits the texts and finds the distinct chunks,
only those not met before are encoded, and the encodings are dealt back to the texts by position.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa


class ChunkEncodings:
    """Known encodings of chunks, at most `most` of them; when full it starts anew."""

    def __init__(self, encode: Callable[[list[str]], list[bytes]], most: int = 700_000, longest: int = 40):
        self.encode, self.most, self.longest = encode, most, longest
        self.known: dict[str, bytes] = {}

    def of(self, chunks: list[str]) -> list[bytes]:
        """The encoding of each distinct chunk."""
        if len(self.known) > self.most:
            self.known.clear()
        found = list(map(self.known.get, chunks))
        missing = [i for i, x in enumerate(found) if x is None]
        if missing:
            for i, code in zip(missing, self.encode([chunks[i] for i in missing])):
                found[i] = code
                if len(chunks[i]) <= self.longest:
                    self.known[chunks[i]] = code
        return found

    def of_lists(self, lists: pa.ListArray) -> list[bytes]:
        """For each list of chunks, its encodings one after the other."""
        offsets = lists.offsets.to_numpy()
        flat = lists.values.slice(offsets[0], offsets[-1] - offsets[0]).dictionary_encode()
        codes = pa.array(self.of(flat.dictionary.to_pylist()), pa.large_binary()).take(flat.indices)
        ends = np.frombuffer(codes.buffers()[1], np.int64)[codes.offset:codes.offset + len(codes) + 1] if len(codes) else np.zeros(1, np.int64)
        data = memoryview(codes.buffers()[2] or b"")
        at = ends[offsets - offsets[0]].tolist()
        return [data[a:b].tobytes() for a, b in zip(at, at[1:])]
