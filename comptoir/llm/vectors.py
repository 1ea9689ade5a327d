"""Vectors in Arrow batches: the usable rows of an array column as matrices."""

from __future__ import annotations

import numpy as np
import pyarrow as pa


class Vectors:
    """The rows of an array column that are neither null nor hold a null or non-finite entry.

    ``rows`` are their places in the batch, ``sizes`` their numbers of entries.
    """

    def __init__(self, column: pa.Array):
        self.values = column.values.to_numpy(zero_copy_only=False).astype(np.float64, copy=False)  # null entries: NaN
        offsets = column.offsets.to_numpy()
        bad = np.concatenate(([0], np.cumsum(~np.isfinite(self.values))))
        fine = column.is_valid().to_numpy(zero_copy_only=False) & (bad[offsets[1:]] == bad[offsets[:-1]])
        self.rows = np.flatnonzero(fine)
        self.starts = offsets[:-1][self.rows]
        self.sizes = (offsets[1:] - offsets[:-1])[self.rows]

    def of_size(self, dims: int) -> tuple[np.ndarray, np.ndarray]:
        """(places, matrix) of the usable rows with ``dims`` entries."""
        at = np.flatnonzero(self.sizes == dims)
        return self.rows[at], self.values[self.starts[at][:, None] + np.arange(dims)]

    def padded(self, dims: int) -> np.ndarray:
        """All usable rows, cut to ``dims`` entries or filled up with zeros."""
        if self.rows.size and (self.sizes == dims).all():
            return self.of_size(dims)[1]
        out = np.zeros((self.rows.size, dims))
        for size in np.unique(self.sizes):
            at = np.flatnonzero(self.sizes == size)
            n = min(int(size), dims)
            out[at, :n] = self.values[self.starts[at][:, None] + np.arange(n)]
        return out


def lists_of(matrix: np.ndarray, missing: np.ndarray | None = None) -> pa.ListArray:
    """A matrix as an array column; ``missing`` marks the columns whose entries are null."""
    n, width = matrix.shape
    mask = None if missing is None or not missing.any() else np.tile(missing, n)
    return pa.ListArray.from_arrays(pa.array(np.arange(n + 1, dtype=np.int32) * np.int32(width)),
                                    pa.array(np.ascontiguousarray(matrix).ravel(), mask=mask))
