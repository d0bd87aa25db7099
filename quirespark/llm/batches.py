"""Arrow batches cut so that what a worker holds at once is bounded by rows and by bytes."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute

ROWS = 2000
#: Bytes of text that are turned into Python objects at once; a single longer text goes alone.
BYTES = 4 << 20


def pieces(batch: pa.RecordBatch, columns: tuple[int, ...], rows: int = ROWS, size: int = BYTES) -> Iterator[pa.RecordBatch]:
    """Slices of ``batch`` with at most ``rows`` rows and about ``size`` bytes in the string ``columns``."""
    if not batch.num_rows:
        return
    lengths = sum(np.asarray(pa.compute.fill_null(pa.compute.binary_length(batch.column(c)), 0).cast(pa.int64())) for c in columns)
    total = np.cumsum(lengths)
    at, done = 0, 0
    while at < batch.num_rows:
        end = min(at + rows, max(at + 1, int(np.searchsorted(total, done + size, side="right"))))
        yield batch.slice(at, end - at)
        at, done = end, int(total[end - 1])
