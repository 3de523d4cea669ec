"""File names for many requests at once, beside files that exist."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from alertfold.functions.names import free_number, with_suffix
from alertfold.operators.rank import rank_within


def allocate_names(requests: DataFrame, base: str, order: Sequence[str], listing: DataFrame,
                   listed: str = "name", ext: str = ".csv", out: str = "name") -> DataFrame:
    """``requests`` with ``out``: ``base.csv`` or ``base_1.csv``, ``base_2.csv`` ... in ``order``, the
    first that no file of ``listing`` has.

    A base that is itself of the form ``x_1`` is met twice: as its own bare name and as a number
    of base ``x``.  Bare names of requested bases are kept for them, so the numbers of ``x``
    leave them out; no other two names can be equal (what follows the base would have to be a
    number and not one), and one pass over each family settles it without walking through
    the requests one by one.  NULL bases get NULL names.

    Existing numbers are gathered per base, one long each; the requests of a frequent base
    spread over tasks (``rank_within``)."""
    stem = F.regexp_replace(F.col(listed), ext.replace(".", r"\.") + "$", "")
    files = listing.where(F.endswith(F.col(listed), F.lit(ext))).select(stem.alias("__stem"), F.lit(True).alias("__file"))
    bases = requests.where(F.col(base).isNotNull()).select(F.col(base).alias("__stem")).distinct()
    stems = files.unionByName(bases.withColumn("__file", F.lit(False))).distinct()
    # the stem as a bare name (files only), and as a number of a shorter base
    numbered = r"^(.*)_([1-9][0-9]{0,17})$"
    taken = (stems.where("__file").select(F.col("__stem").alias("__base"), F.lit(0).cast("long").alias("__n"))
             .unionByName(stems.where(F.col("__stem").rlike(numbered))
                          .select(F.regexp_extract("__stem", numbered, 1).alias("__base"),
                                  F.regexp_extract("__stem", numbered, 2).cast("long").alias("__n"))))
    taken = (taken.join(bases, taken["__base"] == bases["__stem"], "left_semi")
             .groupBy("__base").agg(F.collect_set("__n").alias("__taken")))
    placed = rank_within(requests, [base], order, out="__pos")
    number = free_number(F.col("__pos") - 1, F.col("__taken"))
    return (placed.join(taken, placed[base] == taken["__base"], "left")
            .select(*[placed[c] for c in requests.columns], with_suffix(placed[base], number, ext).alias(out)))
