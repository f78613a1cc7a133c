"""Reading columns of vectors: which rows hold a usable one, and its numbers."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc


def usable_vectors(column: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Rows and their vectors as doubles, together for each length.

    Left out are null and empty vectors and those that hold a null or a number that is not finite.
    """
    column = column.cast(pa.list_(pa.float64()))
    sizes = pc.fill_null(pc.list_value_length(column), 0).to_numpy(zero_copy_only=False)
    values = np.asarray(
        pc.fill_null(column.flatten(), float("nan")).to_numpy(zero_copy_only=False), float
    )
    starts = np.cumsum(sizes) - sizes
    for size in np.unique(sizes[sizes > 0]).tolist():
        rows = np.flatnonzero(sizes == size)
        vectors = values[starts[rows, None] + np.arange(size)]
        finite = np.isfinite(vectors).all(axis=1)
        yield rows[finite], vectors[finite]
