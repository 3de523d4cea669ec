"""Broadcast only what is proven small."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Rows above which a derived lookup table is joined by shuffle (AQE may still pick a
# broadcast at run time when the measured size allows it).
MAX_BROADCAST_ROWS = 1_000_000

# Per-file tables (one short row per source file) are broadcast when the driver's own
# file listing is within this many files; larger listings are joined by shuffle.
MAX_BROADCAST_FILES = 100_000


def per_file_broadcast(table: DataFrame, n_files: int) -> DataFrame:
    """Mark a table holding at most one row per source file for broadcast, the bound
    being the file count the driver already knows (no extra job)."""
    return F.broadcast(table) if n_files <= MAX_BROADCAST_FILES else table


def bounded_broadcast(small: DataFrame, max_rows: int = MAX_BROADCAST_ROWS) -> DataFrame:
    """Materialise a derived table in the checkpoint folder (cutting its lineage, so a
    lost executor does not recompute the aggregate), count it, and mark it for
    broadcast only when the count is within ``max_rows``."""
    from alertfold.session import checkpoint_root
    checkpoint_root(small.sparkSession)
    table = small.checkpoint(eager=True)
    if table.count() <= max_rows:
        return F.broadcast(table)
    return table
