"""Vectors of a table as matrices."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc


def matrices(col: pa.Array):
    """(row numbers, float64 matrix) of the vectors without null or non-finite entries, by vector length."""
    if not len(col):
        return
    ends = np.asarray(col.offsets)
    flat = pc.cast(col.values, pa.float64()).to_numpy(zero_copy_only=False)  # null entries become NaN
    start, length = ends[:-1], np.diff(ends)
    bad = np.r_[0, np.cumsum(~np.isfinite(flat))]
    ok = col.is_valid().to_numpy(zero_copy_only=False) & (bad[ends[1:]] == bad[start])
    for n in np.unique(length[ok]):
        rows = np.flatnonzero(ok & (length == n))
        yield rows, flat[start[rows][:, None] + np.arange(n)]


def blobs(m: np.ndarray) -> pa.Array:
    """The rows of a matrix as bytes."""
    m = np.ascontiguousarray(m)
    width = m.shape[1] * m.itemsize
    ends = np.arange(len(m) + 1, dtype=np.int64) * width
    return pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(m), [None, pa.py_buffer(ends), pa.py_buffer(m)]).cast(pa.binary())


def from_blobs(col: pa.Array | pa.ChunkedArray, dtype) -> np.ndarray:
    """Rows of equal length from their bytes."""
    parts = col.to_pylist()
    return np.frombuffer(b"".join(parts), dtype).reshape(len(parts), -1) if parts else np.empty((0, 0), dtype)
