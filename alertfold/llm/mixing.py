"""Mixing sources to target weights by pivotal dependent rounding.

Every source gets a target number of words; a document of the source is wanted
``target / source_size`` times.  The whole part of that rate is taken as it is.  The
fraction is rounded by the pivotal method: two documents with fractional copies exchange
probability mass, weighed by their sizes, until one of them is 0 or 1.  The direction is
random, with odds that keep each document's expectation; the words expected from the pair
do not change.  So a source's words end within one document's size of its target.

Pairs are formed inside blocks of about ``BLOCK`` documents.  A block leaves at most one
undecided document; these residuals meet in blocks of ``FAN_IN`` on the next level, and so
on up a reduction tree.  No block grows with a source, however hot.  The random numbers
are hashes of the seed and the two ids, so reruns agree.  What the sources' targets need is
one short row per source, ranked in one task.

NULL texts have size 0, a NULL source is a source of its own (the last), repeated rows are
documents of their own, and an empty table gives no rows.  Documents without words take no
part in the exchange: they keep the whole part of their rate.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from alertfold.llm.common import cut, fresh, word_count
from alertfold.llm.exact_dedup import one_of_each
from alertfold.operators.rank import rank_within
from alertfold.operators.small import bounded_broadcast

BLOCK = 4096
FAN_IN = 64
EDGE = 1e-9  # a probability this close to 0 or 1 is 0 or 1


def source_targets(sizes: DataFrame, weights: tuple[float, ...], share: float = 1.0,
                   max_repeat: float = 3.0) -> DataFrame:
    """``source, source_size, n_docs, weight, target`` from ``source, size`` rows.

    Targets share ``share`` of all words by weight, none above ``max_repeat`` times its
    source: ``target = min(cap, level * weight)``.  Sources reach their cap in the order of
    cap / weight, so the level follows from running sums over the sources (one short row
    each; the ranking of weights by source name is global anyway).
    """
    per = sizes.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("n_docs"))
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    given = F.array(*[F.lit(float(w)) for w in weights])
    per = (per.withColumn("weight", F.get(given, (F.row_number().over(by_name) - 1) % len(weights)))
           .withColumn("cap", F.col("source_size") * F.lit(float(max_repeat))))
    order = Window.orderBy(F.col("cap") / F.col("weight"), F.col("source").asc_nulls_last())
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy()
    per = (per.withColumn("full", F.coalesce(F.sum("cap").over(before), F.lit(0.0)))
           .withColumn("open", F.sum("weight").over(whole) - F.coalesce(F.sum("weight").over(before), F.lit(0.0)))
           .withColumn("total", F.sum("source_size").over(whole) * F.lit(float(share)))
           .withColumn("level", (F.col("total") - F.col("full")) / F.col("open"))
           # the level of the first source that stays under its cap holds for all after it
           .withColumn("fits", F.col("level") * F.col("weight") <= F.col("cap"))
           .withColumn("level", F.min(F.when(F.col("fits"), F.struct("full", "open", "level"))).over(whole)["level"]))
    target = F.least(F.col("cap"), F.coalesce(F.col("level") * F.col("weight"), F.col("cap")))
    return per.select("source", "source_size", "n_docs", "weight", target.alias("target"))


def _mixed(a: int, b: int) -> float:
    """A number in [0, 1) from two 64-bit words (splitmix64 finaliser)."""
    m = (1 << 64) - 1
    x = (a * 0x9E3779B97F4A7C15 + b + 0x632BE59BD9B4E019) & m
    x = ((x ^ (x >> 30)) * 0xBF58476D1CE4E5B9) & m
    x = ((x ^ (x >> 27)) * 0x94D049BB133111EB) & m
    return ((x ^ (x >> 31)) >> 11) / float(1 << 53)


def pivot(key: np.ndarray, size: np.ndarray, p: np.ndarray, seed: int, last: bool) -> np.ndarray:
    """Round the probabilities ``p`` in the given order; at most one stays fractional, and
    none when this is the ``last`` block of its source."""
    p = p.astype(float).copy()
    open_at = -1
    for j in range(len(p)):
        if not EDGE < p[j] < 1 - EDGE:
            p[j] = round(p[j])
            continue
        if open_at < 0:
            open_at = j
            continue
        i = open_at
        to_i = min((1 - p[i]) * size[i], p[j] * size[j])       # words that j can give to i
        to_j = min(p[i] * size[i], (1 - p[j]) * size[j])       # words that i can give to j
        moved = to_i if _mixed(int(key[i]) ^ seed, int(key[j])) * (to_i + to_j) < to_j else -to_j
        p[i] += moved / size[i]
        p[j] -= moved / size[j]
        open_at = -1
        for k in (i, j):
            if EDGE < p[k] < 1 - EDGE:
                open_at = k
            else:
                p[k] = round(p[k])
    if last and open_at >= 0:
        p[open_at] = float(_mixed(int(key[open_at]), seed) < p[open_at])
    return p


def _rounder(seed: int, last: bool):
    def step(rows: pd.DataFrame) -> pd.DataFrame:
        # large documents first: later, smaller ones settle them, so what stays open is small
        rows = rows.sort_values(["size", "key", "doc_id"], ascending=[False, True, True], kind="stable")
        rows["p"] = pivot(rows["key"].to_numpy(), rows["size"].to_numpy(float),
                          rows["p"].to_numpy(float), seed, last)
        return rows
    return step


def mix(docs: DataFrame, weights: tuple[float, ...] = (5, 2, 1), share: float = 1.0,
        max_repeat: float = 3.0, seed: int = 17, id_col: str = "doc_id", text_col: str = "text",
        source_col: str = "source", block: int = BLOCK) -> DataFrame:
    """One row per document: ``doc_id, source, size, source_size, target, copies, taken``."""
    return _mix(docs, weights, share, max_repeat, seed, id_col, text_col, source_col, block).drop("digest")


def _mix(docs: DataFrame, weights, share, max_repeat, seed, id_col, text_col, source_col, block) -> DataFrame:
    """``mix`` with ``digest``, a hash of the text that tells rows of one id apart."""
    sizes = cut(docs.select(F.col(id_col).alias("doc_id"), F.col(source_col).alias("source"),
                            word_count(F.col(text_col)).alias("size"), F.xxhash64(text_col).alias("digest")))
    sizes = _keyed(sizes, seed)
    targets = bounded_broadcast(source_targets(sizes, weights, share, max_repeat))
    wide = sizes.alias("d").join(targets.alias("t"), F.col("d.source").eqNullSafe(F.col("t.source")))
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    wide = wide.select("d.doc_id", "d.source", "size", "digest", "key", "source_size", "target", "n_docs", rate.alias("rate"))
    whole = F.floor(F.col("rate") + EDGE)
    wide = wide.withColumn("whole", whole.cast("long")).withColumn("p", F.col("rate") - F.col("whole"))
    settled = (F.col("size") == 0) | (F.col("p") <= EDGE)
    done = [wide.filter(settled).withColumn("p", F.lit(0.0))]
    out = ["doc_id", "source", "size", "digest", "source_size", "target", "whole", "p"]

    n_blocks = F.ceil(F.col("n_docs") / block).cast("long")
    level = wide.filter(~settled).withColumn("block", F.pmod("key", n_blocks)).drop("rate").withColumn("blocks", n_blocks)
    most = sizes.groupBy("source").count().agg(F.max("count")).first()[0] or 0
    widest = -(-most // block)  # blocks of the largest source: the depth of the tree
    while widest:
        last = widest == 1
        rounded = cut(level.groupBy("source", "block").applyInPandas(_rounder(seed, last), level.schema))
        done.append(rounded.filter("p = 0 OR p = 1"))
        level = rounded.filter("p > 0 AND p < 1").withColumn("block", F.floor(F.col("block") / FAN_IN))
        widest = 0 if last else -(-widest // FAN_IN)
    decided = done[0].select(out)
    for part in done[1:]:
        decided = decided.unionByName(part.select(out))
    copies = (F.col("whole") + F.col("p")).cast("long")
    return decided.select("doc_id", "source", "size", "source_size", "target", copies.alias("copies"),
                          (F.col("size") * copies).alias("taken"), "digest")


def _keyed(sizes: DataFrame, seed: int) -> DataFrame:
    """``key``: what blocks and random numbers follow, from the id alone where it is one row's.
    Rows of a NULL or repeated id add their text's digest and their number among equal rows, so
    that no block grows with them; the keys do not depend on how the table is stored."""
    own = F.xxhash64(F.lit(seed), "doc_id")
    often = cut(sizes.groupBy("doc_id").agg(F.count("*").alias("rows"))
                .filter("rows > 1 OR doc_id IS NULL").select(F.col("doc_id").alias("again")))
    if often.isEmpty():
        return sizes.withColumn("key", own)
    same = F.col("doc_id").eqNullSafe(F.col("again"))
    single = sizes.join(often, same, "left_anti").withColumn("key", own)
    # which of equal rows gets which number makes no difference
    several = rank_within(sizes.join(often, same, "left_semi").withColumn("row", F.monotonically_increasing_id()),
                          ["doc_id", "digest", "source", "size"], ["row"], out="nth")
    several = several.withColumn("key", F.xxhash64(F.lit(seed), "doc_id", "digest", "nth")).drop("row", "nth")
    return cut(single.unionByName(several))


def mixed_documents(docs: DataFrame, weights: tuple[float, ...] = (5, 2, 1), share: float = 1.0,
                    max_repeat: float = 3.0, seed: int = 17, id_col: str = "doc_id", text_col: str = "text",
                    source_col: str = "source", block: int = BLOCK) -> DataFrame:
    """The mix itself: each document of ``docs`` as often as it is taken, all columns.  Rows are
    told apart by id, text and source; rows equal in all three stand for one another, and come
    as often as they are taken together.  Columns may have any names."""
    ident, digest, origin, many, rows, copy, whole = fresh(
        docs, "_mix_id", "_mix_digest", "_mix_source", "_mix_copies", "_mix_rows", "_mix_copy", "_whole_row")
    taken = _mix(docs, weights, share, max_repeat, seed, id_col, text_col, source_col, block)
    per_row = cut(taken.groupBy(F.col("doc_id").alias(ident), F.col("digest").alias(digest), F.col("source").alias(origin))
                  .agg(F.sum("copies").alias(many), F.count("*").alias(rows)).filter(F.col(many) > 0))

    def hit(keys: DataFrame) -> DataFrame:
        match = (docs[id_col].eqNullSafe(keys[ident]) & (F.xxhash64(docs[text_col]) == keys[digest])
                 & docs[source_col].eqNullSafe(keys[origin]))
        return docs.join(keys.hint("shuffle_hash"), match)

    def repeated(found: DataFrame) -> DataFrame:
        times = F.explode(F.sequence(F.lit(1).cast("long"), F.col(many)))
        return found.withColumn(copy, times).select(*[F.col(f"`{c}`") for c in docs.columns])

    out = repeated(hit(per_row.filter(F.col(rows) == 1).drop(rows)))
    several = per_row.filter(F.col(rows) > 1).drop(rows)
    if several.isEmpty():
        return out
    key = [F.col(c) for c in (ident, digest, origin)]
    one = one_of_each(hit(several), key, [*docs.columns, many], whole)
    return out.unionByName(repeated(one))
