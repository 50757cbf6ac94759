"""Words of whole texts as numpy arrays, for functions that run inside ``mapInArrow`` tasks.

Words are ``[^\\x20\\x09-\\x0D]+``. They are found on the UTF-8 bytes and named by 64-bit hashes, so a
batch of texts costs a few passes over an array and no Python object per word.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

#: Text bytes handled at once. A longer text makes a block of its own.
BLOCK_BYTES = 4 << 20
_WINDOW_BYTES = 1 << 20

_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)
_MASK = (1 << 64) - 1


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers whose output bits all depend on all input bits."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


_BYTE_CODES = mix(np.arange(1, 257, dtype=np.uint64))
_WHITE = np.zeros(256, dtype=bool)
_WHITE[[32, 9, 10, 11, 12, 13]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_powers: dict[int, np.ndarray] = {}


def _powers_of(base: int, n: int) -> np.ndarray:
    known = _powers.get(base)
    if known is None or len(known) < n:
        known = np.full(n, base, dtype=np.uint64)
        if n:
            known[0] = 1
        _powers[base] = known = np.multiply.accumulate(known)
    return known[:n]


def span_hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64-bit hash of ``data[start:end]`` for each span, by prefix sums of a polynomial; starts ascend.

    Sums reach over a window of the data at a time, so memory does not grow with the texts.
    """
    out = np.empty(len(start), dtype=np.uint64)
    at = 0
    while at < len(start):
        low = int(start[at])
        to = int(np.searchsorted(start, low + _WINDOW_BYTES, side="left"))
        to = max(to, at + 1)
        s, e = start[at:to] - low, end[at:to] - low
        own = data[low : low + int(e.max())]
        sums = np.zeros(len(own) + 1, dtype=np.uint64)
        np.cumsum(_BYTE_CODES[own] * _powers_of(_BASE, len(own)), out=sums[1:])
        value = (sums[e] - sums[s]) * _powers_of(_INVERSE, len(own) + 1)[s]
        out[at:to] = mix(value + (e - s).astype(np.uint64))
        at = to
    return out


@dataclass
class Words:
    """The words of some texts, in order: bytes ``start`` to ``end`` of ``data``, in text ``doc``."""

    data: np.ndarray
    start: np.ndarray
    end: np.ndarray
    doc: np.ndarray
    offsets: np.ndarray  # of the texts in data

    @property
    def n_docs(self) -> int:
        return len(self.offsets) - 1

    def counts(self) -> np.ndarray:
        return np.bincount(self.doc, minlength=self.n_docs)

    def hashes(self) -> np.ndarray:
        return span_hashes(self.data, self.start, self.end)


def text_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of the texts one after the other, and where each begins; null counts as empty."""
    texts = texts.cast(pa.large_string()).fill_null("")
    raw = np.frombuffer(texts.buffers()[1], dtype=np.int64)
    offsets = raw[texts.offset : texts.offset + len(texts) + 1] if len(texts) else np.zeros(1, np.int64)
    body = texts.buffers()[2]
    data = np.frombuffer(body, dtype=np.uint8) if body is not None else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def words(texts: pa.Array, lower: bool = False) -> Words:
    """Words of the texts; ``lower`` turns A-Z into a-z first."""
    data, offsets = text_bytes(texts)
    if lower:
        data = _LOWER[data]
    # A word also ends where its text does.
    inside = np.zeros(len(data) + 2, dtype=bool)
    inside[1:-1] = ~_WHITE[data]
    first = np.zeros(len(data) + 1, dtype=bool)
    first[offsets] = True
    here, before = inside[1:], inside[:-1]
    start = np.flatnonzero(here & (~before | first))
    end = np.flatnonzero(before & (~here | first))
    doc = np.searchsorted(offsets, start, side="right") - 1
    return Words(data, start, end, doc, offsets)


def blocks(batches: Iterator[pa.RecordBatch], column: str, limit: int = BLOCK_BYTES) -> Iterator[pa.RecordBatch]:
    """The batches cut so that the column's texts make up ``limit`` bytes at most, or one row."""
    for batch in batches:
        sizes = np.diff(text_bytes(batch.column(batch.schema.get_field_index(column)))[1])
        begin, total = 0, 0
        for i, size in enumerate(sizes.tolist()):
            if total and total + size > limit:
                yield batch.slice(begin, i - begin)
                begin, total = i, 0
            total += size
        if begin < batch.num_rows:
            yield batch.slice(begin)


def column(batch: pa.RecordBatch, name: str) -> pa.Array:
    return batch.column(batch.schema.get_field_index(name))


def runs(sorted_values: np.ndarray) -> np.ndarray:
    """Positions at which a run of equal values begins."""
    if not len(sorted_values):
        return np.zeros(0, dtype=np.int64)
    return np.flatnonzero(np.concatenate(([True], sorted_values[1:] != sorted_values[:-1])))


def windows(doc: np.ndarray, hashes: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Position and hash of each window of ``size`` words that lies within one text."""
    n = len(hashes) - size + 1
    if n <= 0:
        return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.uint64)
    at = np.flatnonzero(doc[:n] == doc[size - 1 :])
    value = np.zeros(len(at), dtype=np.uint64)
    for k in range(size):
        value = mix(value * np.uint64(_BASE) + hashes[at + k])
    return at, value


def lines(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Text, begin and end of each line of some texts, cut at ``\\n``; an empty text has one empty line."""
    n = len(offsets) - 1
    breaks = np.flatnonzero(data == 10)
    text = np.concatenate([np.arange(n), np.searchsorted(offsets, breaks, side="right") - 1])
    start = np.concatenate([offsets[:-1], breaks + 1])
    order = np.lexsort((start, text))
    text, start = text[order], start[order]
    last = np.append(text[1:] != text[:-1], True) if len(text) else np.zeros(0, bool)
    stop = np.empty_like(start)
    stop[last] = offsets[1:][text[last]]
    inner = np.flatnonzero(~last)
    stop[inner] = start[inner + 1] - 1
    return text, start, stop
