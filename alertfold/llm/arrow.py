"""Arrow batches in tasks."""

from __future__ import annotations

import numpy as np
import pyarrow as pa

SLICE_BYTES = 1 << 20


def slices(batch: pa.RecordBatch, column: int):
    """Runs of rows of about ``SLICE_BYTES`` of text in the column, so that what a worker
    holds does not follow the batch's size.  All rows come, in order."""
    ends = np.cumsum([len(t.as_buffer() or b"") if t.is_valid else 0 for t in batch.column(column)])
    lo = 0
    while lo < batch.num_rows:
        before = ends[lo - 1] if lo else 0
        hi = max(lo + 1, int(np.searchsorted(ends, before + SLICE_BYTES, "right")))
        yield batch.slice(lo, hi - lo)
        lo = hi
