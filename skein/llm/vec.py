"""Array helpers for Arrow functions: the words of many texts at once, as
positions and 64-bit hashes, without a Python object for each word."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

_BASE = np.uint64(0x9E3779B97F4A7C15)
_MIX = (np.uint64(0xFF51AFD7ED558CCD), np.uint64(0xC4CEB9FE1A85EC53))
_POWERS = np.cumprod(np.full(1 << 12, _BASE, dtype=np.uint64))

SPACE = np.zeros(256, dtype=bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
#: ASCII letters and digits, and all of UTF-8's other bytes.
ALNUM = np.zeros(256, dtype=bool)
ALNUM[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True


def powers(n: int) -> np.ndarray:
    global _POWERS
    if n > len(_POWERS):
        _POWERS = np.cumprod(np.full(max(n, 2 * len(_POWERS)), _BASE, dtype=np.uint64))
    return _POWERS


def mixed(h: np.ndarray) -> np.ndarray:
    """Finalised 64-bit hashes (every bit depends on every bit)."""
    h = h ^ (h >> np.uint64(33))
    h *= _MIX[0]
    h ^= h >> np.uint64(33)
    h *= _MIX[1]
    return h ^ (h >> np.uint64(33))


class Words:
    """The words of some texts: ``buf`` (their bytes, a line end between
    texts), ``starts`` and ``ends`` of the words, and ``first`` (index of each
    text's first word, one more at the end)."""

    def __init__(self, texts: list[bytes], inside: np.ndarray):
        self.buf = np.frombuffer(b"\n".join(texts), dtype=np.uint8)
        lengths = np.fromiter(map(len, texts), dtype=np.int64, count=len(texts))
        self.text_starts = np.cumsum(lengths + 1) - lengths - 1
        self.text_lengths = lengths
        mark = np.zeros(len(self.buf) + 2, dtype=np.int8)
        mark[1:-1] = inside[self.buf]
        edge = np.flatnonzero(mark[1:] != mark[:-1])
        self.starts, self.ends = edge[0::2], edge[1::2]
        self.first = np.append(np.searchsorted(self.starts, self.text_starts), len(self.starts))

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    def text_of(self) -> np.ndarray:
        """The text that each word belongs to."""
        return np.repeat(np.arange(len(self.first) - 1), self.counts)

    def hashes(self, upto: int | None = None, buf: np.ndarray | None = None, where: np.ndarray | None = None) -> np.ndarray:
        """64-bit hash of each word (of its first ``upto`` bytes). ``buf``:
        other bytes in place of the texts' own; ``where``: only those count."""
        buf = self.buf if buf is None else buf
        if not len(self.starts):
            return np.zeros(0, dtype=np.uint64)
        lengths = self.ends - self.starts
        if upto is not None:
            lengths = np.minimum(lengths, upto)
        offsets = np.cumsum(lengths) - lengths
        place = np.arange(int(offsets[-1] + lengths[-1])) - np.repeat(offsets, lengths)
        at = place + np.repeat(self.starts, lengths)
        value = buf[at].astype(np.uint64) + np.uint64(1)
        if where is not None:
            kept = where[at]
            value *= kept
            # The place among the bytes that count, so that others leave no trace.
            run = np.cumsum(kept)
            place = run - np.repeat(run[offsets] - kept[offsets], lengths)
        value *= powers(int(lengths.max()) + 2)[place]
        return mixed(np.add.reduceat(value, offsets) + lengths.astype(np.uint64) * np.uint64(upto is None and where is None))


def sums(values: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Sum of ``values`` for each text, given the index of its first value."""
    run = np.concatenate([[0], np.cumsum(values, dtype=np.float64 if values.dtype.kind == "f" else np.int64)])
    return run[first[1:]] - run[first[:-1]]


def in_parts(batches: Iterator[pa.RecordBatch], column: int, most: int = 2 << 20) -> Iterator[tuple[pa.RecordBatch, list[str]]]:
    """Slices of the batches with texts of about ``most`` bytes together (one
    longer text makes a slice of its own) and their texts, null as empty.
    Only one slice's texts are Python objects at a time."""
    for batch in batches:
        ends = np.cumsum(pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False), dtype=np.int64)
        start = 0
        while start < batch.num_rows:
            before = int(ends[start - 1]) if start else 0
            end = max(start + 1, int(np.searchsorted(ends, before + most, "right")))
            part = batch.slice(start, end - start)
            yield part, [t or "" for t in part.column(column).to_pylist()]
            start = end


class Table:
    """A hash table of 64-bit keys (any but the largest) in two arrays; many
    keys are looked up at once."""

    def __init__(self, keys: np.ndarray, values: np.ndarray):
        self.bits = max(4, int(2 * len(keys)).bit_length())
        self.empty = np.uint64(0xFFFFFFFFFFFFFFFF)
        self.keys = np.full(1 << self.bits, self.empty, dtype=np.uint64)
        self.values = np.zeros(1 << self.bits, dtype=values.dtype)
        left, at = np.arange(len(keys)), self._slots(keys)
        while len(left):
            free = self.keys[at] == self.empty
            self.keys[at[free]] = keys[left[free]]
            mine = self.keys[at] == keys[left]
            self.values[at[mine]] = values[left[mine]]
            left, at = left[~mine], (at[~mine] + 1) & ((1 << self.bits) - 1)

    def _slots(self, keys: np.ndarray) -> np.ndarray:
        return ((keys * _MIX[0]) >> np.uint64(64 - self.bits)).astype(np.int64)

    def get(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The values, and which keys the table holds."""
        at = self._slots(keys)
        found = self.keys[at]
        held = found == keys
        left = np.flatnonzero(~held & (found != self.empty))
        while len(left):
            at[left] = (at[left] + 1) & ((1 << self.bits) - 1)
            found = self.keys[at[left]]
            held[left] = found == keys[left]
            left = left[~held[left] & (found != self.empty)]
        return self.values[at], held
