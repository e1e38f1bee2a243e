"""Arrow lists of numbers as numpy matrices, one a length, so that kernels work on many rows at once."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa


def by_length(*columns: pa.ListArray) -> Iterator[tuple[np.ndarray, list[np.ndarray]]]:
    """(row numbers, a matrix of each column) for the rows of each length. Null lists, and lists that hold
    null, raise, and so do rows whose columns differ in length."""
    lengths = np.diff(columns[0].offsets.to_numpy())
    for c in columns:
        if c.null_count or c.flatten().null_count:
            raise ValueError("signals must not be or hold null")
        if (np.diff(c.offsets.to_numpy()) != lengths).any():
            raise ValueError("I and Q differ in length")
    flat = [c.values.to_numpy(zero_copy_only=False) for c in columns]
    for length in np.unique(lengths):
        rows = np.flatnonzero(lengths == length)
        yield rows, [f[c.offsets.to_numpy()[rows][:, None] + np.arange(length)] for f, c in zip(flat, columns, strict=True)]


def lists_of(rows: list[np.ndarray], matrices: list[np.ndarray], kind: pa.DataType) -> pa.ListArray:
    """The list column whose rows of numbers ``rows[k]`` are the rows of ``matrices[k]``."""
    lengths = np.zeros(sum(len(r) for r in rows), np.int64)
    for r, m in zip(rows, matrices, strict=True):
        lengths[r] = m.shape[1]
    offsets = np.concatenate([[0], np.cumsum(lengths)])
    flat = np.zeros(int(offsets[-1]), matrices[0].dtype if matrices else np.float64)
    for r, m in zip(rows, matrices, strict=True):
        flat[offsets[r][:, None] + np.arange(m.shape[1])] = m
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(flat, kind))
