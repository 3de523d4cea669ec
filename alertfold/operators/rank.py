"""Exact positions and medians without funnelling a group through one task.

``row_number()`` over ``partitionBy(g)`` sends every row of a group to one task; a
month holding a third of the data would then be sorted by a single core.  Here the
rows are range-partitioned by ``(group, order)`` instead (a hot group is split over
many partitions), each partition numbers its rows locally, and a small table of
per-(partition, group) counts -- at most partitions + groups rows -- turns local
positions into exact positions inside the group.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from alertfold.operators.small import bounded_broadcast

_SHIFT = 33  # monotonically_increasing_id = (partition index << 33) + row position


def rank_within(df: DataFrame, group: Sequence[str | Column], order: Sequence[str | Column],
                out: str = "pos", join_back: bool = False) -> DataFrame:
    """Add ``out`` = 1-based position of the row inside its group, by ``order``.

    Ties in ``order`` are broken arbitrarily, so pass a unique order for a
    deterministic result.

    The rows are materialised once in their order.  For wide rows ``join_back`` materialises
    only (group, order) and joins the positions to the rows by them, which takes an order
    that is unique within the group.
    """
    if join_back:
        return _joined_back(df, group, order, out)
    gcols = [F.col(g) if isinstance(g, str) else g for g in group]
    ocols = [F.col(o) if isinstance(o, str) else o for o in order]
    gnames = [f"__g{i}" for i in range(len(gcols))]
    keyed = df.select("*", *[c.alias(n) for c, n in zip(gcols, gnames)])
    spread = (keyed.repartitionByRange(*[F.col(n) for n in gnames], *ocols)
              .sortWithinPartitions(*[F.col(n) for n in gnames], *ocols)
              .withColumn("__mid", F.monotonically_increasing_id()))
    # cut lineage: the sort and ids must be the same for the counts and the rows
    from alertfold.session import checkpoint_root
    checkpoint_root(df.sparkSession)
    spread = spread.checkpoint(eager=True)
    spread = (spread.withColumn("__pid", F.shiftright(F.col("__mid"), _SHIFT))
              .withColumn("__local", F.col("__mid") - F.shiftleft(F.col("__pid"), _SHIFT)))
    counts = spread.groupBy("__pid", *gnames).agg(F.count(F.lit(1)).alias("__n"),
                                                  F.min("__local").alias("__first"))
    w = Window.partitionBy(*gnames).orderBy("__pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.withColumn("__off", F.coalesce(F.sum("__n").over(w), F.lit(0)))
    offsets = bounded_broadcast(offsets.select("__pid", *gnames, "__off", "__first"))
    cond = [spread["__pid"] == offsets["__pid"]] + [spread[n].eqNullSafe(offsets[n]) for n in gnames]
    joined = spread.join(offsets, cond, "inner")
    pos = F.col("__off") + (F.col("__local") - F.col("__first")) + 1
    keep = [spread[c] for c in df.columns]
    return joined.select(*keep, pos.alias(out))


def _joined_back(df: DataFrame, group: Sequence[str | Column], order: Sequence[str | Column], out: str) -> DataFrame:
    keys = [F.col(c) if isinstance(c, str) else c for c in (*group, *order)]
    names = [f"__r{i}" for i in range(len(keys))]
    narrow = df.select(*[k.alias(n) for k, n in zip(keys, names)])
    placed = rank_within(narrow, names[:len(group)], names[len(group):], out="__pos")
    rows = df.select("*", *[k.alias(f"{n}_own") for k, n in zip(keys, names)])
    same = F.lit(True)
    for n in names:
        same = same & rows[f"{n}_own"].eqNullSafe(placed[n])
    return rows.join(placed, same).select(*[rows[c] for c in df.columns], placed["__pos"].alias(out))


def exact_median(df: DataFrame, col: str, out: str = "median", accuracy: int = 10_000,
                 max_collect: int = 100_000, rounds: int = 6) -> DataFrame:
    """One row: the exact median of ``col`` (NULLs ignored), mean of the two middle
    values for an even count; NULL when there is no value.

    Selection by narrowing, without sorting the column: ``percentile_approx`` places a
    value within n/accuracy ranks of its target, so two quantiles just around the
    middle bracket both middle values.  One count gives how many values lie below the
    bracket; the bracket (about 4n/accuracy values, checkpointed) is narrowed again
    until it holds at most ``max_collect`` values, which are sorted on the driver.
    Every bracket is checked against the counts; a check that fails (few values, heavy
    ties) hands the current bracket to ``exact_median_sorted``, so the result is exact."""
    spark = df.sparkSession
    v = F.col("__v")
    vals = df.select(F.col(col).cast("double").alias("__v")).where(v.isNotNull())
    # the count and the first bracket in one pass: the middle ranks are within 1/n of
    # one half, which a margin of 3/accuracy covers once n >= accuracy (the counts
    # below check the bracket whatever n is)
    first = vals.agg(F.count(F.lit(1)).alias("n"), F.percentile_approx(
        v, [max(0.0, 0.5 - 3.0 / accuracy), min(1.0, 0.5 + 3.0 / accuracy)], accuracy).alias("b")).first()
    n = first["n"]
    if n == 0:
        return spark.createDataFrame([(None,)], f"`{out}` double")
    k1, k2 = (n + 1) // 2, n // 2 + 1          # 1-based ranks of the middle values
    band, below, m = vals, 0, n                  # the middle values are in ``band``
    for i in range(rounds):
        if m <= max_collect:
            # at most max_collect values; NaN sorts last, as in Spark
            xs = sorted((r[0] for r in band.collect()), key=lambda x: (math.isnan(x), x))
            return spark.createDataFrame([((xs[k1 - below - 1] + xs[k2 - below - 1]) / 2,)], f"`{out}` double")
        if i == 0:
            lo, hi = first["b"]
        else:
            qs = [max(0.0, (k1 - below) / m - 2.0 / accuracy), min(1.0, (k2 - below) / m + 2.0 / accuracy)]
            lo, hi = band.agg(F.percentile_approx(v, qs, accuracy)).first()[0]
        st = band.agg(F.count_if(v < lo).alias("lt"), F.count_if((v >= lo) & (v <= hi)).alias("inside")).first()
        if not (below + st["lt"] < k1 and below + st["lt"] + st["inside"] >= k2):
            break                                        # the bracket is not proven
        if lo == hi:                                     # both middle values equal lo
            return spark.createDataFrame([(float(lo),)], f"`{out}` double")
        if st["inside"] == m:
            break                                        # no further narrowing (ties)
        below, m = below + st["lt"], st["inside"]
        from alertfold.session import checkpoint_root
        checkpoint_root(spark)
        band = band.where((v >= lo) & (v <= hi)).checkpoint(eager=True)   # cut the lineage
    return _median_of_band(band, below, n, out)


def _median_of_band(band: DataFrame, below: int, n: int, out: str) -> DataFrame:
    """The middle values of the whole column, found by rank inside ``band`` (which holds
    them, with ``below`` values of the column smaller than the band)."""
    k1, k2 = (n + 1) // 2, n // 2 + 1
    # the row id breaks ties, so a block of equal values can still be split over tasks
    keyed = band.withColumn("__all", F.lit(1)).withColumn("__t", F.monotonically_increasing_id())
    ranked = rank_within(keyed, ["__all"], ["__v", "__t"], out="__r")
    picked = ranked.where((F.col("__r") + below == k1) | (F.col("__r") + below == k2))
    return picked.agg(F.avg("__v").alias(out))


def exact_median_sorted(df: DataFrame, col: str, out: str = "median") -> DataFrame:
    """The same median through positions of the whole column (range partitioning and
    a sort of every value; no single task)."""
    vals = df.select(F.col(col).cast("double").alias("__v")).where(F.col("__v").isNotNull())
    keyed = vals.withColumn("__all", F.lit(1)).withColumn("__t", F.monotonically_increasing_id())
    ranked = rank_within(keyed, ["__all"], ["__v", "__t"], out="__r")
    n = vals.agg(F.count(F.lit(1)).alias("__n")).scalar()
    picked = ranked.where((F.col("__r") == F.floor((n + 1) / 2)) | (F.col("__r") == F.floor(n / 2) + 1))
    return picked.agg(F.avg("__v").alias(out))
