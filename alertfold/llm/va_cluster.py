"""Centroid clustering over a VA-file (vector approximation file).

Vectors of ``dims`` finite components become whole numbers, ``floor(scale * x)``.  A row id
is given to each, and two tables are written:

* the *vectors*, partitioned and sorted by row id;
* the *approximations*: per row ``BITS`` bits a dimension, the cell its component lies in.
  Cells are bounded by the dimension's quantiles over all rows and its true extremes.

A round assigns every row from its approximation.  A lookup table gives, per dimension, cell
and centroid, the least and the largest squared distance a component of that cell can have;
their sums are an interval per centroid.  A centroid whose interval begins above the end of
another's is out.  Only rows that two or more centroids are left for, and rows whose cluster
changes, fetch their full vector: a join with the vectors on the row id, for which those
need no shuffle.  Exact distances to the centroids left decide, ties going to the smaller
number.  The sums of the clusters follow the rows that moved, so rows that stay are never
read again until the last pass, which returns every row's exact distance.

All arithmetic is on whole numbers, so results are the same for any partitioning.  The
driver and the broadcasts hold ``k`` centroids, ``dims`` times ``2 ** BITS`` cell edges and
``k`` sums: sizes that do not follow the table.

Vectors that are NULL, of another length, or hold NULL or non-finite components take no
part.  Rows that repeat an id are vectors of their own; rows with a NULL id are too, and
become first centroids only after all others; of equal ids the smaller vector comes first.
With fewer than ``k`` vectors there are as many centroids.  An empty table gives no rows;
other columns are ignored.  A sum of distances that no long holds is NULL; components of
``PEAK`` or more are an error (``ValueError``), since then single distances may not fit.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from alertfold.llm.common import cut

BITS = 4
CELLS = 1 << BITS
PEAK = 1 << 27
PART_ROWS = 50_000     # rows of a partition of the vectors, at most about
LEAST_ROWS = 1_000     # and at least, where there are idle cores
LONG = (1 << 63) - 1
AQE = "spark.sql.adaptive.enabled"


def usable(table: DataFrame, dims: int, id_col: str, vec_col: str) -> DataFrame:
    """``id, vec`` rows that take part."""
    rows = table.select(F.col(id_col).alias("id"), F.col(vec_col).alias("vec"))
    good = F.forall("vec", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != F.lit(float("inf"))))
    return rows.filter((F.size("vec") == dims) & good)


def whole(vecs, dims: int, scale: int) -> np.ndarray:
    """A list column as a matrix of whole numbers."""
    vecs = vecs.combine_chunks() if isinstance(vecs, pa.ChunkedArray) else vecs
    flat = vecs.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return np.floor(scale * flat).astype(np.int64).reshape(len(vecs), dims)


def cell_edges(rows: DataFrame, dims: int, scale: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Inner edges (dims x CELLS - 1), and per cell its least and its largest component."""
    steps = [i / CELLS for i in range(1, CELLS)]
    got = (rows.select(F.posexplode("vec").alias("dim", "x"))
           .select("dim", (F.lit(float(scale)) * F.col("x").cast("double")).alias("x")).groupBy("dim")
           .agg(F.min("x").alias("lo"), F.max("x").alias("hi"), F.percentile_approx("x", steps, 1000).alias("q"))
           .orderBy("dim").collect())  # one row a dimension
    if any(max(abs(r["lo"]), abs(r["hi"])) >= PEAK for r in got):
        raise ValueError(f"components of {PEAK / scale:g} or more are not supported")
    inner = np.floor([r["q"] for r in got]).astype(np.int64).reshape(dims, CELLS - 1)
    least = np.concatenate([np.floor([[r["lo"]] for r in got]).astype(np.int64).reshape(dims, 1), inner], 1)
    most = np.concatenate([inner - 1, np.floor([[r["hi"]] for r in got]).astype(np.int64).reshape(dims, 1)], 1)
    return inner, least, most


def cells_of(x: np.ndarray, inner: np.ndarray) -> np.ndarray:
    return np.stack([np.searchsorted(inner[d], x[:, d], "right") for d in range(x.shape[1])], 1).astype(np.uint8)


def packed(cells: np.ndarray) -> np.ndarray:
    """Two cells a byte; an odd last cell has its byte alone."""
    if cells.shape[1] % 2:
        cells = np.pad(cells, ((0, 0), (0, 1)))
    return cells[:, ::2] << BITS | cells[:, 1::2]


def unpacked(column, dims: int) -> np.ndarray:
    raw = np.frombuffer(b"".join(column.to_pylist()), np.uint8).reshape(len(column), -1)
    return np.stack([raw >> BITS, raw & CELLS - 1], 2).reshape(len(raw), -1)[:, :dims]


def lookup(least: np.ndarray, most: np.ndarray, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Per dimension, cell and centroid: the least and the largest squared distance."""
    c = centroids.T[:, None, :]
    below, above = least[:, :, None] - c, most[:, :, None] - c
    ends = np.maximum(below ** 2, above ** 2)
    inside = (below <= 0) & (above >= 0)
    return np.where(inside, 0, np.minimum(below ** 2, above ** 2)), ends


def left_over(cells: np.ndarray, tables: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """Rows x centroids: whether the centroid can be the row's nearest."""
    low = np.zeros((len(cells), tables[0].shape[2]), np.int64)
    high = low.copy()
    for d in range(cells.shape[1]):
        low += tables[0][d, cells[:, d]]
        high += tables[1][d, cells[:, d]]
    return low <= high.min(1, keepdims=True)


def nearest_left(x: np.ndarray, left: np.ndarray, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The nearest of each row's remaining centroids (the first of equals), and its distance."""
    best, at = np.full(len(x), LONG), np.full(len(x), -1, np.int64)
    for c in range(len(centroids)):
        rows = np.flatnonzero(left[:, c])
        d = ((x[rows] - centroids[c]) ** 2).sum(1)
        nearer = (d < best[rows]) | (at[rows] < 0)
        best[rows[nearer]], at[rows[nearer]] = d[nearer], c
    return at, best


def _approximated(inner: np.ndarray, dims: int, scale: int):
    def run(batches):
        for batch in batches:
            cells = packed(cells_of(whole(batch.column(1), dims, scale), inner)) if len(batch) else []
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([r.tobytes() for r in cells], pa.binary()),
                                              pa.nulls(len(batch), pa.int32())], names=["rid", "cells", "cluster"])
    return run


_JUDGED_DDL = "rid long, cells binary, cluster int, now int, mask long"


def _judged(tables, dims: int):
    """``now``: the cluster, where one centroid is left; ``mask``: the centroids left."""
    def run(batches):
        for batch in batches:
            if not len(batch):
                continue
            left = left_over(unpacked(batch.column(1), dims), tables)
            only = left.sum(1) == 1
            mask = (left.astype(np.int64) << np.arange(left.shape[1])).sum(1)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(left.argmax(1), pa.int32(), mask=~only), pa.array(mask)],
                names=["rid", "cells", "cluster", "now", "mask"])
    return run


_FETCHED = pa.schema([("rid", pa.int64()), ("cells", pa.binary()), ("cluster", pa.int32()), ("n", pa.int64()),
                      ("sums", pa.list_(pa.int64()))])
_FETCHED_DDL = "rid long, cells binary, cluster int, n long, sums array<long>"


def _decided(batch, centroids, dims: int, scale: int):
    """Vectors, clusters and distances of fetched rows (their mask and vector are the last
    two columns)."""
    mask, vecs = batch.column(batch.num_columns - 2).to_numpy(), batch.column(batch.num_columns - 1)
    x = whole(vecs, dims, scale)
    left = (mask[:, None] >> np.arange(len(centroids)) & 1).astype(bool)
    return x, *nearest_left(x, left, centroids)


def _moved(centroids, dims: int, scale: int):
    """Fetched rows with their cluster, and per batch the change of each cluster's sums (rows
    without a row id)."""
    def run(batches):
        for batch in batches:
            if not len(batch):
                continue
            x, now, _ = _decided(batch, centroids, dims, scale)
            was = batch.column(2).fill_null(-1).to_numpy()
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(now, pa.int32()), pa.nulls(len(x), pa.int64()),
                 pa.nulls(len(x), pa.list_(pa.int64()))], schema=_FETCHED)
            moved = now != was
            for c in range(len(centroids)):
                come, gone = moved & (now == c), moved & (was == c)
                if come.any() or gone.any():
                    yield pa.RecordBatch.from_pylist([{
                        "rid": None, "cells": None, "cluster": c, "n": int(come.sum()) - int(gone.sum()),
                        "sums": x[come].sum(0) - x[gone].sum(0)}], schema=_FETCHED)
    return run


def _measured(centroids, dims: int, scale: int):
    def run(batches):
        for batch in batches:
            if len(batch):
                _, at, distance = _decided(batch, centroids, dims, scale)
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(at, pa.int32()), pa.array(distance)],
                                                 names=["vec_id", "cluster", "distance"])
    return run


def _first(rows: DataFrame, k: int, dims: int, scale: int) -> np.ndarray:
    """The ``k`` vectors with the smallest digests of their ids."""
    digest = F.sha2(F.concat(F.lit("1:"), F.col("id").cast("string")), 256)
    got = rows.select(digest.alias("h"), "vec").orderBy(F.col("h").asc_nulls_last(), "vec").limit(k).collect()
    return whole(pa.array([r["vec"] for r in got], pa.list_(pa.float64())), dims, scale)


def stored(rows: DataFrame, count: int) -> DataFrame:
    """``rid, id, vec``, partitioned and sorted by row id, so that joins on the row id leave the
    vectors where they are.  A checkpoint knows its partitioning only if its plan was fixed
    when it ran, hence without adaptive execution for this one job."""
    spark = rows.sparkSession
    cores = spark.sparkContext.defaultParallelism
    parts = max(-(-count // PART_ROWS), min(cores, -(-count // LEAST_ROWS)))
    laid = (rows.withColumn("rid", F.monotonically_increasing_id())
            .repartition(parts, "rid").sortWithinPartitions("rid").select("rid", "id", "vec"))
    adaptive = spark.conf.get(AQE)
    spark.conf.set(AQE, "false")
    try:
        return cut(laid)
    finally:
        spark.conf.set(AQE, adaptive)


def fetched(wanted: DataFrame, vectors: DataFrame) -> DataFrame:
    """``wanted`` with the vectors of its row ids."""
    return wanted.join(vectors.hint("merge"), "rid")


def va_clusters(table: DataFrame, k: int = 16, rounds: int = 3, dims: int = 64, scale: int = 64,
                id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """``vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256``."""
    spark = table.sparkSession
    rows = usable(table, dims, id_col, vec_col)
    count = rows.count()
    id_type = rows.schema["id"].dataType.simpleString()
    if not count:
        return rows.select(F.col("id").alias("vec_id"), *[F.lit(None).cast(t).alias(c) for c, t in (
            ("cluster", "int"), ("distance", "long"), ("cluster_inertia", "long"), ("inertia", "long"),
            ("centroid_sha256", "string"))])
    vectors = stored(rows, count)
    inner, least, most = cell_edges(vectors, dims, scale)
    centroids = _first(rows, k, dims, scale)
    state = cut(vectors.select("rid", "vec").mapInArrow(_approximated(inner, dims, scale),
                                                        "rid long, cells binary, cluster int"))
    sums = [[0] * dims for _ in centroids]
    sizes = [0] * len(centroids)
    for _ in range(rounds):
        judged = cut(state.mapInArrow(_judged(lookup(least, most, centroids), dims), _JUDGED_DDL))
        stays = F.col("now").isNotNull() & F.col("now").eqNullSafe(F.col("cluster"))
        wanted = judged.filter(~stays).select("rid", "cells", "cluster", "mask")
        moved = cut(fetched(wanted, vectors).select("rid", "cells", "cluster", "mask", "vec")
                    .mapInArrow(_moved(centroids, dims, scale), _FETCHED_DDL))
        change = (moved.filter("rid IS NULL").select("cluster", "n", F.posexplode("sums").alias("dim", "x"))
                  .groupBy("cluster", "dim").agg(F.sum("n").alias("n"), F.sum(F.col("x").cast("decimal(38,0)")).alias("x")))
        for r in change.collect():  # k x dims rows at most
            sums[r["cluster"]][r["dim"]] += int(r["x"])
            if r["dim"] == 0:
                sizes[r["cluster"]] += r["n"]
        centroids = np.array([[x // n for x in s] if n else list(c) for s, n, c in zip(sums, sizes, centroids)], np.int64)
        state = (judged.filter(stays).select("rid", "cells", "cluster")
                 .unionByName(moved.filter("rid IS NOT NULL").select("rid", "cells", "cluster")))
    judged = state.mapInArrow(_judged(lookup(least, most, centroids), dims), _JUDGED_DDL).select("rid", "mask")
    found = cut(fetched(judged, vectors).select("id", "mask", "vec")
                .mapInArrow(_measured(centroids, dims, scale), f"vec_id {id_type}, cluster int, distance long"))
    per = found.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("s")).collect()  # k rows
    total = sum(int(r["s"]) for r in per)
    facts = spark.createDataFrame([(r["cluster"], int(r["s"]) if r["s"] <= LONG else None, total if total <= LONG else None,
                                    hashlib.sha256(",".join(map(str, centroids[r["cluster"]])).encode()).hexdigest())
                                   for r in per], "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return (found.join(F.broadcast(facts), "cluster")
            .select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"))
