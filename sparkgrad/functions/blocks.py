"""NumPy helpers that run inside ``mapInArrow`` tasks on one Arrow batch.

Spark partitions the images and sums the partial gradients; these helpers only do
the matrix products of one batch, where an interpreted array expression is slow.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa


def to_matrix(column: pa.Array, n: int) -> tuple[np.ndarray, np.ndarray]:
    """List column to (rows x n) doubles and a flag per row that has any value. More than n values are an error."""
    rows = len(column)
    flat = column.flatten()
    lengths = column.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
    if rows and lengths.max() > n:
        raise ValueError(f"an image has more than the {n} features of the network")
    if flat.null_count == 0 and (lengths == n).all():
        return flat.to_numpy(zero_copy_only=False).reshape(rows, n), np.ones(rows, dtype=bool)
    row_of = np.repeat(np.arange(rows), lengths)
    at = np.arange(len(flat)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    valid = flat.is_valid().to_numpy(zero_copy_only=False)
    values = flat.fill_null(0.0).to_numpy(zero_copy_only=False)
    matrix = np.zeros((rows, n))
    matrix[row_of[valid], at[valid]] = values[valid]
    known = np.zeros(rows, dtype=bool)
    known[row_of[valid]] = True
    return matrix, known


def activate(kind: str, z: np.ndarray) -> np.ndarray:
    if kind == "relu":
        return np.maximum(z, 0.0)
    if kind == "sigmoid":
        return 1.0 / (1.0 + np.exp(-z))
    if kind == "linear":
        return z
    e = np.exp(z - z.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def list_array(matrix: np.ndarray, known: np.ndarray) -> pa.Array:
    rows, width = matrix.shape
    flat = pa.array(matrix.ravel(), mask=None if known.all() else np.repeat(~known, width))
    return pa.ListArray.from_arrays(np.arange(rows + 1, dtype=np.int32) * width, flat)
