"""Arrow batches cut to a size that a Python worker can hold."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

BYTES = 2 << 20


def slices(
    batches: Iterator[pa.RecordBatch], column: str, limit: int = BYTES
) -> Iterator[pa.RecordBatch]:
    """Parts of the batches with about ``limit`` bytes (of text) or elements of the column."""
    for batch in batches:
        if not batch.num_rows:
            continue
        values = batch.column(column)
        length = pc.list_value_length if pa.types.is_list(values.type) else pc.binary_length
        sizes = length(values).fill_null(0).to_numpy(zero_copy_only=False)
        part = np.cumsum(sizes.astype(np.int64)) // limit
        starts = np.flatnonzero(np.diff(part, prepend=-1))
        for start, stop in zip(starts, [*starts[1:], batch.num_rows], strict=True):
            yield batch.slice(start, stop - start)
