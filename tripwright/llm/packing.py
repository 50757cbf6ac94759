"""Arrays of numbers as compressed bytes, for rows that carry many numbers at once."""

from __future__ import annotations

import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard


def pack(values: np.ndarray, dtype: str) -> bytes:
    """Numbers byte by byte: all lowest bytes compressed, then all next ones, and so on; zeros cost nothing."""
    values = np.ascontiguousarray(values.astype(dtype)).reshape(-1)
    size = values.itemsize
    planes = values.view(np.uint8).reshape(-1, size)
    parts = [struct.pack("<IB", len(values), size)]
    for j in range(size):
        plane = np.ascontiguousarray(planes[:, j])
        body = zstandard.compress(plane.tobytes(), 1) if plane.any() else b""
        parts += [struct.pack("<I", len(body)), body]
    return b"".join(parts)


def unpack(raw: bytes, kind: str) -> np.ndarray:
    """Numbers of ``pack``; kind is u or f."""
    n, size = struct.unpack_from("<IB", raw)
    planes, at = np.zeros((n, size), dtype=np.uint8), 5
    for j in range(size):
        length = struct.unpack_from("<I", raw, at)[0]
        if length:
            planes[:, j] = np.frombuffer(zstandard.decompress(raw[at + 4 : at + 4 + length]), np.uint8)
        at += 4 + length
    return planes.reshape(-1).view(f"<{kind}{size}")


def pack_sorted(values: np.ndarray) -> bytes:
    """Ascending unsigned numbers by their differences."""
    return pack(np.diff(values, prepend=np.zeros(1, values.dtype)), "<u8")


def unpack_sorted(raw: bytes) -> np.ndarray:
    return np.cumsum(unpack(raw, "u"), dtype=np.uint64)


def groups(batches: Iterator[pa.RecordBatch], *keys: str) -> Iterator[tuple[tuple, list[dict]]]:
    """Consecutive rows of equal keys. Rows are opened one by one, so a batch is never held twice."""
    now, rows = None, []
    for batch in batches:
        for i in range(batch.num_rows):
            row = batch.slice(i, 1).to_pylist()[0]
            key = tuple(row[k] for k in keys)
            if rows and key != now:
                yield now, rows
                rows = []
            now = key
            rows.append(row)
    if rows:
        yield now, rows
