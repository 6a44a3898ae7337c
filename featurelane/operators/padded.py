"""Arrow batches of bounded size with arrays padded to the longest of the batch."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

#: Rows of a prediction batch at most.
MAX_BATCH = 1000


def check_batch(batch: int) -> None:
    if not 1 <= batch <= MAX_BATCH:
        raise ValueError(f"a prediction batch has 1 to {MAX_BATCH} rows, not {batch}")


def slices(batches: Iterator[pa.RecordBatch], batch: int) -> Iterator[pa.RecordBatch]:
    """The rows in order, ``batch`` at a time at most."""
    for whole in batches:
        for i in range(0, whole.num_rows, batch):
            yield whole.slice(i, batch)


def padded(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Rows by longest array, zeros behind each row's own elements; the lengths; and which cells are elements.

    A null array has none.
    """
    n = column.value_lengths().fill_null(0).to_numpy(False).astype(np.int64)
    real = np.arange(n.max(initial=0)) < n[:, None]
    values = column.flatten().to_numpy(False)
    out = np.zeros(real.shape, values.dtype)
    out[real] = values
    return out, n, real
