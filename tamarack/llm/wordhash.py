"""Hashes of words and of word windows, over whole Arrow batches with numpy.

Words are maximal runs of bytes other than 0x20 and 0x09-0x0D of the UTF-8 text.
A word's hash is a polynomial of its bytes modulo 2**64, scrambled; a window's is a
polynomial of its words' hashes, scrambled again. Both come from prefix sums, so
that a window costs the same at any length.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

#: Bytes hashed at once; longer documents are hashed in such segments, cut between words.
SEGMENT = 1 << 19
SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True


class Powers:
    """Powers of an odd base and of its inverse modulo 2**64."""

    def __init__(self, base: int):
        self.base, self.up, self.down = base, np.ones(1, np.uint64), np.ones(1, np.uint64)

    def get(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            size = max(n, 1 << 16)
            for name, b in (("up", self.base), ("down", pow(self.base, -1, 1 << 64))):
                x = np.full(size, b, np.uint64)
                x[0] = 1
                setattr(self, name, np.multiply.accumulate(x))
        return self.up[:n], self.down[:n]


OF_BYTES, OF_WORDS, OF_WORDS_TOO = Powers(0x9E3779B97F4A7C15), Powers(0xC2B2AE3D27D4EB4F), Powers(0xD6E8FEB86659FD93)


def mix(x: np.ndarray) -> np.ndarray:
    """A fixed scrambling of 64-bit values, one to one."""
    x = x ^ (x >> np.uint64(30))
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def prefixes(values: np.ndarray, powers: Powers) -> tuple[np.ndarray, np.ndarray]:
    """Prefix sums of values times powers, one more than values; and the inverse powers."""
    up, down = powers.get(len(values) + 1)
    sums = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values * up[:-1], out=sums[1:])
    return sums, down


def spans(sums: np.ndarray, down: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    return mix((sums[ends] - sums[starts]) * down[starts])


class Words:
    """The words of one or more documents that lie one after the other in a buffer."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray):
        word = ~SPACE[data]
        first = np.zeros(len(data) + 1, bool)
        first[offsets] = True
        before = np.empty(len(data), bool)
        before[:1] = False
        before[1:] = word[:-1]
        self.data = data
        self.starts = np.flatnonzero(word & (~before | first[:-1]))
        after = np.empty(len(data), bool)
        after[-1:] = False
        after[:-1] = word[1:]
        self.ends = np.flatnonzero(word & (~after | first[1:])) + 1
        #: Of each document, where its words begin and end among all words.
        self.limits = np.searchsorted(self.starts, offsets)
        self.hashes = self._hash()

    def _hash(self) -> np.ndarray:
        out, n, at = np.empty(len(self.starts), np.uint64), len(self.starts), 0
        while at < n:
            low = self.starts[at]
            upto = max(at + 1, int(np.searchsorted(self.ends, low + SEGMENT, "right")))
            sums, down = prefixes(self.data[low : self.ends[upto - 1]].astype(np.uint64) + np.uint64(1), OF_BYTES)
            out[at:upto] = spans(sums, down, self.starts[at:upto] - low, self.ends[at:upto] - low)
            at = upto
        return out

    def room(self, width: int) -> np.ndarray:
        """Starts of all windows of so many words that lie within one document."""
        end = np.repeat(self.limits[1:], np.diff(self.limits))
        return np.flatnonzero(np.arange(len(end)) + width <= end)

    def document_of(self, words: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.limits, words, "right") - 1


def parts(batch: pa.RecordBatch, column: int, size: int = SEGMENT) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, row after the last, bytes, offsets) of parts of a batch with about `size` bytes of text, whole rows each."""
    texts = batch.column(column)
    if len(texts) == 0:
        return
    kind = np.int64 if pa.types.is_large_string(texts.type) else np.int32
    offsets = np.frombuffer(texts.buffers()[1], kind)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
    held = texts.buffers()[2]
    data = np.frombuffer(held, np.uint8) if held is not None and held.size else np.zeros(0, np.uint8)
    at = 0
    while at < len(texts):
        upto = max(at + 1, int(np.searchsorted(offsets, offsets[at] + size, "right")) - 1)
        yield at, upto, data[offsets[at] : offsets[upto]], offsets[at : upto + 1] - offsets[at]
        at = upto
