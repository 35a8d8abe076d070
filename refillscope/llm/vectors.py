"""Vectors of Arrow list columns as NumPy matrices, and packed rows of them."""

from __future__ import annotations

import io

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc


def matrix(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Positions of the rows whose vector has only finite components, and these vectors as doubles.

    Rows that are null or hold a null, NaN or infinite component are left out. A shorter
    vector counts as one with zeros behind.
    """
    lists = column.cast(pa.list_(pa.float64()))
    lengths = np.asarray(pc.list_value_length(lists).fill_null(0), dtype=np.int64)
    values = lists.flatten()
    bad = ~np.isfinite(np.asarray(values.fill_null(np.nan)))
    owner = np.repeat(np.arange(len(lists)), lengths)
    good = np.asarray(lists.is_valid()) & (np.bincount(owner[bad], minlength=len(lists)) == 0)
    keep = good[owner]
    rows = np.flatnonzero(good)
    place = np.cumsum(good) - 1
    width = int(lengths[rows].max(initial=0))
    out = np.zeros((len(rows), width))
    within = np.arange(len(owner)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    out[place[owner[keep]], within[keep]] = np.asarray(values.fill_null(0))[keep]
    return rows, out


def stack(blobs: list[bytes], dtype) -> np.ndarray:
    """Packed vectors as the rows of one matrix, shorter ones with zeros behind."""
    size = np.dtype(dtype).itemsize
    width = max((len(b) for b in blobs), default=0)
    return np.frombuffer(b"".join(b.ljust(width, b"\0") for b in blobs), dtype=dtype).reshape(len(blobs), width // size)


def packed(rows: np.ndarray) -> pa.Array:
    """Each row of a matrix as bytes."""
    size, raw = rows.shape[1] * rows.itemsize, np.ascontiguousarray(rows).tobytes()
    return pa.array([raw[k * size : (k + 1) * size] for k in range(len(rows))], pa.binary())


def widened(rows: np.ndarray, width: int) -> np.ndarray:
    """The matrix with zero columns behind, up to ``width``."""
    return rows if rows.shape[1] >= width else np.pad(rows, ((0, 0), (0, width - rows.shape[1])))


def dump(**arrays: np.ndarray) -> bytes:
    out = io.BytesIO()
    np.savez(out, **arrays)
    return out.getvalue()


def load(raw: bytes) -> dict[str, np.ndarray]:
    with np.load(io.BytesIO(raw), allow_pickle=False) as found:
        return dict(found)
