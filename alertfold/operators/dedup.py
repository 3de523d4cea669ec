"""Keep-first deduplication.

Default form: ``row_number() over (partition by key order by order) = 1``.  Spark
plans it with a *partial* group limit before the shuffle (each map task keeps only
its first row per key), so a hot key -- for instance a NULL key on a third of the
rows -- reaches the final window as at most one row per map task.  With
``null_key='keep'`` each NULL-keyed row gets its own partition value.

The aggregate form ``min_by(struct(row), order)`` gives the same result with a
carries the whole row through its exchange: when a whole-table statistic of the
deduplicated rows follows (the median epoch unit), that statistic reuses the same
exchange, while column pruning gives the window form a second, narrower scan and
shuffle.  Pipelines pick it in that case (``method='agg'``).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _q(name: str) -> Column:
    return F.col(f"`{name}`")


def dedup_first_agg(df: DataFrame, keys: Sequence[str], order: str,
                    null_key: str = "collapse") -> DataFrame:
    """Keep the first row (smallest ``order``) of every key, as a ``min_by`` aggregate.

    null_key='collapse': rows whose key is NULL form one group (one survivor), as a
    text conversion of missing keys does.  'keep': every row with a NULL key survives.
    """
    cols = df.columns
    group = [_q(k) for k in keys]
    if null_key == "keep":
        any_null = None
        for k in keys:
            any_null = _q(k).isNull() if any_null is None else (any_null | _q(k).isNull())
        # a NULL-keyed row gets its own group (its order value), so no hot group forms
        group.append(F.when(any_null, _q(order)).alias("__solo"))
    elif null_key != "collapse":
        raise ValueError(f"null_key must be 'collapse' or 'keep', not {null_key!r}")
    # the payload carries only the non-key columns: keys come back from the grouping
    payload = [c for c in cols if c not in keys]
    picked = (df.groupBy(*group)
              .agg(F.min_by(F.struct(*[_q(c) for c in payload]), _q(order)).alias("__row")))
    back = {c: F.col(f"__row.`{c}`") for c in payload}
    back.update({k: _q(k) for k in keys})
    return picked.select(*[back[c].alias(c) for c in cols])


def dedup_first(df: DataFrame, keys: Sequence[str], order: str,
                null_key: str = "collapse", method: str = "window") -> DataFrame:
    """Keep the first row (smallest ``order``; give a unique order) of every key.

    null_key='collapse': rows whose key is NULL form one group (one survivor), as a
    text conversion of missing keys does.  'keep': every row with a NULL key survives.
    method='window' (default) or 'agg' (see the module notes).
    """
    from pyspark.sql import Window
    if method == "agg":
        return dedup_first_agg(df, keys, order, null_key)
    if null_key not in ("collapse", "keep"):
        raise ValueError(f"null_key must be 'collapse' or 'keep', not {null_key!r}")
    part = [_q(k) for k in keys]
    if null_key == "keep":
        any_null = None
        for k in keys:
            any_null = _q(k).isNull() if any_null is None else (any_null | _q(k).isNull())
        part.append(F.when(any_null, _q(order)))
    w = Window.partitionBy(*part).orderBy(_q(order))
    return df.withColumn("__rn", F.row_number().over(w)).where("__rn = 1").drop("__rn")


dedup_first_window = dedup_first


def dedup_full_row(df: DataFrame) -> DataFrame:
    """Identical rows collapse to one (which one is irrelevant: they are equal)."""
    return df.distinct()


def dedup_content(df: DataFrame, cols: Sequence[str], order: str) -> DataFrame:
    """Rows equal on the text of ``cols`` (names ignored, NULL equal to 'nan') keep their
    first occurrence.

    The key leads with a 64-bit hash of the content, a fixed-width sort prefix, while
    the exact texts stay in the key, so hash collisions cannot merge different rows.
    A text column travels through the shuffle only as its key text plus one bit of a
    NULL mask (carried, not grouped on), from which the survivor's NULLs come back: the
    exchange carries each text once, not a row plus a copy of its text."""
    from pyspark.sql import types as T
    names = list(df.columns)
    text = [c for c in cols if c != order and isinstance(df.schema[c].dataType, T.StringType)][:63]
    keys = {c: f"__k{i}" for i, c in enumerate(cols)}
    keyed = df.select("*", *[F.coalesce(_q(c).cast("string"), F.lit("nan")).alias(keys[c]) for c in cols])
    mask = F.lit(0).cast("long")
    for j, c in enumerate(text):
        mask = mask.bitwiseOR(F.when(_q(c).isNull(), F.lit(1 << j)).otherwise(F.lit(0)).cast("long"))
    keyed = (keyed.withColumn("__nulls", mask)
             .withColumn("__h", F.xxhash64(*[F.col(keys[c]) for c in cols])).drop(*text))
    out = dedup_first(keyed, ["__h", *[keys[c] for c in cols]], order)
    back = {c: F.when((F.col("__nulls").bitwiseAND(F.lit(1 << j))) != 0, F.lit(None).cast("string"))
            .otherwise(F.col(keys[c])) for j, c in enumerate(text)}
    return out.select(*[back[c].alias(c) if c in back else _q(c) for c in names])


def dedup_stats(before: DataFrame, after: DataFrame) -> DataFrame:
    """One row: rows before, after, removed."""
    a = after.agg(F.count(F.lit(1))).scalar()
    return (before.agg(F.count(F.lit(1)).alias("rows_before"))
            .select("rows_before", a.alias("rows_after"), (F.col("rows_before") - a).alias("removed")))
