"""Array columns of a batch as numpy matrices and back, without a Python object per row."""

from __future__ import annotations

import numpy as np
import pyarrow as pa


def to_matrix(column: pa.Array, width: int | None = None) -> np.ndarray:
    """A list column of equal lengths as a (rows, width) matrix; missing entries read as NaN.

    A missing list or one of another length would shift all that follow it, so it is an error.
    """
    if column.null_count:
        raise ValueError("a vector is missing")
    lengths = np.diff(column.offsets.to_numpy())
    if len(lengths) and (lengths != (lengths[0] if width is None else width)).any():
        raise ValueError(f"vectors of {sorted(set(lengths.tolist()))} entries, expected {width if width is not None else 'one length'}")
    values = column.flatten().to_numpy(zero_copy_only=False).astype("float64", copy=False)
    return values.reshape(len(column), width if width is not None else -1) if len(column) else np.zeros((0, width or 0))


def from_matrix(matrix: np.ndarray) -> pa.Array:
    rows, width = matrix.shape
    offsets = np.arange(rows + 1, dtype="int32") * width
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.ascontiguousarray(matrix).reshape(-1)))
