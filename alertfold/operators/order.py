"""Explicit input order.  Row order is not a Spark property, so every "first" is
defined by an order key: for files, (path, block start, position in the block)."""

from __future__ import annotations

from urllib.parse import unquote

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ORDER_COL = "_ord"
SEPARATOR = "\x01"   # sorts below every character of a file name


def path_key(path: Column) -> Column:
    """A path's key whose text order is the order of its components: '2025/x' before
    '2025-b/x' and '2025.csv'.  URI escapes are decoded first."""
    decoded = F.coalesce(F.try_url_decode(F.replace(path, F.lit("+"), F.lit("%2B"))), path)
    return F.translate(F.when(path.contains("%"), decoded).otherwise(path), "/", SEPARATOR)


def path_sort_key(path: str) -> str:
    """The same key on the driver."""
    return unquote(path).replace("/", SEPARATOR)


def with_file_order(df: DataFrame, out: str = ORDER_COL) -> DataFrame:
    """Order key for rows scanned from files: path by components, then block offset, then the
    row position (``monotonically_increasing_id`` grows along a partition, and a file
    block is read by exactly one partition, in order)."""
    return df.withColumn(out, F.struct(
        path_key(F.col("_metadata.file_path")).alias("path"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("pos"),
    ))
