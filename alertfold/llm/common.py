"""Helpers shared by the operators of this folder."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from alertfold.session import checkpoint_root, scratch_dir

#: What counts as a word in the sizes and shingles of this folder: a run of anything but
#: space, tab, line feed, vertical tab, form feed and carriage return.
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def cut(df: DataFrame) -> DataFrame:
    """Materialise ``df`` in the shared checkpoint folder: later reads neither recompute
    it nor depend on an executor that may be lost."""
    checkpoint_root(df.sparkSession)
    return df.checkpoint(eager=True)


def written(df: DataFrame) -> DataFrame:
    """``df`` as a Parquet table in the shared folder.  For the tables of a loop: a checkpoint
    keeps what the optimizer knew of its plan (constraints, orders, ways of partitioning),
    and round by round that grows until planning takes longer than the jobs."""
    out = scratch_dir(df.sparkSession, "loop")
    df.write.parquet(out)
    return df.sparkSession.read.schema(df.schema).parquet(out)


def ascii_lower(text: Column) -> Column:
    """Lower-case A-Z only.  ``lower`` equals that on pure ASCII and is much faster than
    ``translate``, which remains for texts with other characters."""
    full = F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return F.when(F.octet_length(text) == F.length(text), F.lower(text)).otherwise(full)


def word_count(text: Column) -> Column:
    """Number of words (``WORD``); NULL has none."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def fresh(df: DataFrame, *names: str) -> list[str]:
    """The names, lengthened until ``df`` has no column of that name in any case."""
    taken = {c.lower() for c in df.columns}
    out = []
    for name in names:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        out.append(name)
    return out
