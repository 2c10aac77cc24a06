"""Words of Arrow text columns as numpy arrays: places, owners and 64-bit ids, without Python loops."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

#: Texts are handled in slices of about so many bytes; a longer text is a slice of its own.
SLICE_BYTES = 1 << 19

_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A") : ord("Z") + 1] += 32
_FACTOR = 0x9E3779B97F4A7C15


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit over all."""
    x = x ^ (x >> np.uint64(31))
    x = x * np.uint64(0x7FB5D329728EA185)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x81DADEF4BC2DD44D)
    return x ^ (x >> np.uint64(33))


def seeded(n: int, seed: int) -> np.ndarray:
    return mix(np.arange(1, n + 1, dtype=np.uint64) * np.uint64(_FACTOR) + np.uint64(seed))


_CODES = np.where(_SPACE, np.uint64(0), seeded(256, 1) | np.uint64(1))
_BACK = pow(_FACTOR, -1, 1 << 64)


def _powers(factor: int, n: int) -> np.ndarray:
    """Powers of a number modulo 2**64, from 0 to ``n - 1``."""
    steps = np.full(n, factor, np.uint64)
    steps[:1] = 1
    return np.multiply.accumulate(steps)


class Words:
    """Words of a slice of texts.

    ``starts`` and ``ends`` are byte places in ``data``, ``doc`` the text's number in the slice,
    ``first`` the number of each text's first word (one more entry at the end). ``lower``
    lower-cases A to Z, ``trim`` takes these ASCII characters off both ends of a word.
    """

    def __init__(self, column: pa.Array, lower: bool = False, trim: str = ""):
        column = column.cast(pa.large_string()).fill_null("")
        offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
        raw = column.buffers()[2]
        data = np.frombuffer(raw, np.uint8)[offsets[0] : offsets[-1]] if raw else np.zeros(0, np.uint8)
        offsets = offsets - offsets[0]
        self.data = _LOWER[data] if lower else data
        ink = np.zeros(len(data) + 1, bool)
        np.logical_not(_SPACE[data], out=ink[:-1])
        edge = np.zeros(len(data) + 1, bool)
        edge[offsets] = True
        begin = ink.copy()
        begin[1:] &= ~ink[:-1] | edge[1:]
        self.starts = np.flatnonzero(begin)
        stop = ink[:-1] & (~ink[1:] | edge[1:])
        self.ends = np.flatnonzero(stop) + 1
        self.first = np.searchsorted(self.starts, offsets, "left")
        if trim:
            self._trim(np.frombuffer(trim.encode("ascii"), np.uint8))
        self.doc = np.repeat(np.arange(len(column)), np.diff(self.first))

    def _trim(self, marks: np.ndarray) -> None:
        """Take the marks off both ends of every word; a word of marks alone becomes empty."""
        mark = np.zeros(256, bool)
        mark[marks] = True
        self.data = self.data.copy()
        for front in (True, False):
            live = np.flatnonzero(self.ends > self.starts)
            while len(live):
                at = self.starts[live] if front else self.ends[live] - 1
                hit = mark[self.data[at]]
                live, at = live[hit], at[hit]
                self.data[at] = 0x20
                if front:
                    self.starts[live] += 1
                else:
                    self.ends[live] -= 1
                live = live[self.ends[live] > self.starts[live]]

    def ids(self) -> np.ndarray:
        """A 64-bit id per word: a polynomial over its bytes, mixed with its length."""
        if not len(self.starts):
            return np.zeros(0, np.uint64)
        terms = _CODES[self.data] * _powers(_FACTOR, len(self.data))
        at = np.minimum(self.starts, len(self.data) - 1)
        sums = np.add.reduceat(terms, at)
        # Only white space lies between two words of a text, and it counts as zero.
        return mix(sums * _powers(_BACK, len(self.data))[at] + (self.ends - self.starts).astype(np.uint64))

    def texts(self, which: np.ndarray) -> pa.Array:
        """The given words as strings."""
        starts, sizes = self.starts[which], (self.ends - self.starts)[which]
        offsets = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)
        index = np.repeat(starts - offsets[:-1], sizes) + np.arange(offsets[-1])
        data = pa.py_buffer(np.ascontiguousarray(self.data[index]).tobytes())
        return pa.Array.from_buffers(pa.large_string(), len(starts), [None, pa.py_buffer(offsets.tobytes()), data])


def runs(ids: np.ndarray, k: int, doc: np.ndarray, seed: int = 7) -> tuple[np.ndarray, np.ndarray]:
    """Ids of every ``k`` neighbours in one text, and the number of the first of each."""
    n = len(ids) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    out = np.full(n, seed, np.uint64)
    for i in range(k):
        out = mix(out * np.uint64(_FACTOR) + ids[i : i + n])
    at = np.flatnonzero(doc[:n] == doc[k - 1 : k - 1 + n])
    return out[at], at


def slices(batches: Iterator[pa.RecordBatch], column: str = "text") -> Iterator[pa.RecordBatch]:
    """The rows of Arrow batches in slices of about SLICE_BYTES of text."""
    for batch in batches:
        texts = batch.column(batch.schema.get_field_index(column)).cast(pa.large_string())
        sizes = np.diff(np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]) if len(texts) else []
        start, held = 0, 0
        for i, size in enumerate(sizes):
            if held and held + size > SLICE_BYTES:
                yield batch.slice(start, i - start)
                start, held = i, 0
            held += int(size)
        if start < batch.num_rows:
            yield batch.slice(start)
        # What a batch took is given back: workers that wait hold little.
        pa.default_memory_pool().release_unused()


def signed(x: np.ndarray) -> np.ndarray:
    """64-bit ids as Spark's bigint."""
    return x.view(np.int64)
