"""Approximate nearest neighbours by cross-polytope hashing.

A vector, scaled to length 1, goes through a pseudo-rotation (three rounds of random signs
and a fast Hadamard transform) and is hashed to the signed axis it lies nearest to.  A
table's bucket joins the hashes of several rotations; the last one may use fewer axes, so
that the number of buckets follows the number of vectors.  There are ``TABLES`` tables.

A query looks into the buckets whose axes it lies nearest to, ``probes`` per table, and the
vectors found there are ranked by their exact Euclidean distance, in double precision.  How
many probes it takes is measured: for at most ``CALIBRATE`` queries the exact neighbours
are found in one pass over all vectors, and the smallest number of probes that finds
``RECALL`` of them is used.  Where ``MAX_PROBES`` do not find that many, buckets are made
``WIDER`` times as wide and measured again; where buckets cannot get wider, all queries are
answered by exact passes.

Equal vectors are indexed once, with their smallest ids (as many as a result can name), so
a vector that fills a third of the table is one entry.  The buckets of a table that share
their first axis are dealt by the rest of their code to blocks of about ``BLOCK`` vectors, so
a query goes to the blocks its own buckets lie in and to no other; a bucket that would fill
a block by itself has its own, split by id, and its queries go to each part.  A block gives its own nearest
ones only.  Codes and ids are counted and dealt first, vectors join them afterwards.  A
query that finds fewer neighbours than asked for, while there are more vectors, is answered
by an exact pass.

Vectors that are NULL, zero, or hold NULL or non-finite components take no part, nor do
those whose length differs from the most frequent one (the longer on a tie).  Ids that are
NULL take no part.  Repeated rows of an id and a vector count once; an id with several
vectors is searched by each.  Ties go to the smaller id.  An empty table gives no rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from alertfold.llm.common import cut, written
from alertfold.operators.small import bounded_broadcast

TABLES = 16
CALIBRATE = 64
RECALL = 0.96
MAX_PROBES = 4096
WIDER = 4
BLOCK = 4096
CHUNK = 2000        # queries of one exact pass
ROWS_PER_BUCKET = 10


class CrossPolytope:
    """Signs of the rotations and the axes each hash uses, from the vectors' length and number."""

    def __init__(self, length: int, count: int, tables: int = TABLES, seed: int = 11,
                 per_bucket: int = ROWS_PER_BUCKET):
        self.length = length
        self.dim = max(2, 1 << (length - 1).bit_length())
        self.axes = [self.dim]  # per hash; a hash over d axes has 2 d values
        wanted = max(1.0, count / per_bucket / (2 * self.dim))
        while wanted >= 4 and len(self.axes) < 4:
            d = min(self.dim, 1 << int(np.log2(wanted / 2)))
            self.axes.append(d)
            wanted /= 2 * d
        rng = np.random.default_rng(seed)
        self.signs = rng.choice(np.array([-1, 1], np.float32), (tables, len(self.axes), 3, self.dim))

    def rotated(self, unit: np.ndarray, table: int, k: int) -> np.ndarray:
        x = np.zeros((len(unit), self.dim), np.float32)
        x[:, :self.length] = unit
        for sign in self.signs[table, k]:
            x = x * sign
            h = 1
            while h < self.dim:
                y = x.reshape(len(x), -1, 2, h)
                x = np.stack([y[:, :, 0] + y[:, :, 1], y[:, :, 0] - y[:, :, 1]], axis=2).reshape(len(x), self.dim)
                h *= 2
            x = x / np.float32(np.sqrt(self.dim))
        return x[:, :self.axes[k]]

    def codes(self, unit: np.ndarray, table: int) -> tuple[np.ndarray, np.ndarray]:
        """First hash, and the other hashes as one number."""
        parts = []
        for k in range(len(self.axes)):
            x = self.rotated(unit, table, k)
            at = np.argmax(np.abs(x), axis=1)
            parts.append(2 * at + (x[np.arange(len(x)), at] < 0))
        rest = np.zeros(len(unit), np.int64)
        for k in range(1, len(parts)):
            rest = rest * (2 * self.axes[k]) + parts[k]
        return parts[0].astype(np.int64), rest

    def probes(self, unit: np.ndarray, table: int, most: int) -> list[tuple[np.ndarray, np.ndarray]]:
        """Per query the buckets to look into, nearest first.  A bucket's cost adds up, over
        the hashes, how much further its axis is than the nearest one."""
        first, rest, cost = None, None, None
        for k in range(len(self.axes)):
            x = self.rotated(unit, table, k)
            both = np.stack([x, -x], axis=2).reshape(len(x), -1)       # value 2 i + sign
            gap = (both.max(1, keepdims=True) - both) ** 2
            near = np.argsort(gap, axis=1, kind="stable")[:, :most]
            own = np.take_along_axis(gap, near, axis=1)
            if k == 0:
                first, rest, cost = near, np.zeros_like(near), own
                continue
            total = (cost[:, :, None] + own[:, None, :]).reshape(len(x), -1)
            pick = np.argsort(total, axis=1, kind="stable")[:, :most]
            a, b = pick // own.shape[1], pick % own.shape[1]
            first = np.take_along_axis(first, a, axis=1)
            rest = np.take_along_axis(rest, a, axis=1) * (2 * self.axes[k]) + np.take_along_axis(near, b, axis=1)
            cost = np.take_along_axis(total, pick, axis=1)
        return list(zip(first, rest))


def _matrix(column) -> np.ndarray:
    """A list column whose lists have one length, as a matrix of doubles."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    if not len(column):
        return np.zeros((0, 0))
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1).astype(np.float64)


def _unit(x: np.ndarray) -> np.ndarray:
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return (x / np.linalg.norm(x, axis=1, keepdims=True)).astype(np.float32)


def _nearest(query: np.ndarray, vecs: np.ndarray, reps: np.ndarray, top: int):
    """Positions of the nearest vectors, ties to the smaller id, and their distances."""
    d = np.sqrt(((vecs - query) ** 2).sum(1))
    if len(d) > top:
        limit = np.partition(d, top - 1)[top - 1]
        near = np.flatnonzero(d <= limit)
    else:
        near = np.arange(len(d))
    near = near[np.lexsort((reps[near], d[near]))][:top]
    return near, d[near]


_FOUND = pa.schema([("q", pa.int64()), ("rep", pa.int64()), ("d", pa.float64())])
_FOUND_DDL = "q bigint, rep bigint, d double"


def _found(q, reps, d) -> pa.RecordBatch:
    parts = [np.concatenate(x) if x else np.empty(0) for x in (q, reps, d)]
    return pa.RecordBatch.from_arrays([pa.array(parts[0].astype(np.int64)), pa.array(parts[1].astype(np.int64)),
                                       pa.array(parts[2].astype(np.float64))], schema=_FOUND)


def _exact(index: DataFrame, ids: np.ndarray, vecs: np.ndarray, top: int) -> DataFrame:
    """Exact nearest entries of a bounded number of queries: every batch of the index gives
    its own nearest."""
    shared = index.sparkSession.sparkContext.broadcast((ids, vecs))

    def run(batches):
        own, mine = shared.value
        for batch in batches:
            reps, x = batch.column(0).to_numpy(), _matrix(batch.column(1))
            got = [_nearest(v, x, reps, top) for v in mine] if len(reps) else []
            yield _found([np.full(len(n), i) for i, (n, _) in zip(own, got)],
                         [reps[n] for n, _ in got], [d for _, d in got])

    return _best(index.select("rep", "vec").mapInArrow(run, _FOUND_DDL), top)


def _best(found: DataFrame, top: int) -> DataFrame:
    order = Window.partitionBy("q").orderBy("d", "rep")
    return found.distinct().withColumn("r", F.row_number().over(order)).filter(F.col("r") <= top).drop("r")


def _calibrated(count: int, sample: DataFrame, index: DataFrame, top: int) -> tuple[CrossPolytope, int | None]:
    """The hash with the narrowest buckets in which at most ``MAX_PROBES`` probes find ``RECALL``
    of the sample's true neighbours, and the smallest such number; None where there is none."""
    one = index.select(F.size("vec").alias("n")).first()
    length, per_bucket = one["n"] if one else 1, ROWS_PER_BUCKET
    lsh = CrossPolytope(length, count)
    got = sample.toPandas().sort_values("rep")
    if not len(got):
        return lsh, 1
    ids, vecs = got["rep"].to_numpy(), np.array(got["vec"].tolist(), np.float64)
    true = _exact(index, ids, vecs, top).filter("q <> rep")
    near = true.join(index.select("rep", "vec"), "rep").toPandas()
    if not len(near):
        return lsh, 1
    at = np.searchsorted(ids, near["q"].to_numpy())
    units, others = _unit(vecs), _unit(np.array(near["vec"].tolist(), np.float64))
    while True:
        most = _probes_needed(lsh, units, others, at)
        if most is not None or len(lsh.axes) == 1:
            return lsh, most
        axes = lsh.axes
        while lsh.axes == axes:
            per_bucket *= WIDER
            lsh = CrossPolytope(length, count, per_bucket=per_bucket)


def _probes_needed(lsh: CrossPolytope, units: np.ndarray, others: np.ndarray, at: np.ndarray) -> int | None:
    """The smallest number of probes that finds ``RECALL`` of the neighbours ``others`` of the
    queries ``units[at]``, or None if ``MAX_PROBES`` do not."""
    rank = np.full(len(others), np.inf)
    for table in range(len(lsh.signs)):
        first, rest = lsh.codes(others, table)
        probes = lsh.probes(units, table, MAX_PROBES)
        for k in range(len(others)):
            a, b = probes[at[k]]
            hit = np.flatnonzero((a == first[k]) & (b == rest[k]))
            if len(hit):
                rank[k] = min(rank[k], hit[0] + 1)
    needed = np.sort(rank)[min(len(rank) - 1, int(np.ceil(RECALL * len(rank))) - 1)]
    return int(needed) if np.isfinite(needed) else None


def _entries(lsh: CrossPolytope):
    def run(batches):
        for batch in batches:
            reps = batch.column(0)
            if not len(reps):
                continue
            unit = _unit(_matrix(batch.column(1)))
            for table in range(len(lsh.signs)):
                first, rest = lsh.codes(unit, table)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(reps), table, np.int32)), pa.array(first), pa.array(rest), reps],
                    names=["t", "h", "rest", "rep"])
    return run


def _looks(lsh: CrossPolytope, most: int):
    def run(batches):
        for batch in batches:
            ids, vecs = batch.column(0).to_numpy(), _matrix(batch.column(1))
            out = {"t": [], "h": [], "rests": [], "q": []}
            if len(ids):
                unit = _unit(vecs)
                for table in range(len(lsh.signs)):
                    for i, (a, b) in enumerate(lsh.probes(unit, table, most)):
                        for h in np.unique(a):
                            for key, value in zip(out, (table, int(h), b[a == h], int(ids[i]))):
                                out[key].append(value)
            yield pa.RecordBatch.from_arrays(
                [pa.array(out["t"], pa.int32()), pa.array(out["h"], pa.int64()),
                 pa.array(out["rests"], pa.list_(pa.int64())), pa.array(out["q"], pa.int64())], names=list(out))
    return run


def _rank_block(top: int):
    """One block of a bucket family (table, first hash): each query against its buckets."""
    def run(entries: pa.Table, looks: pa.Table) -> pa.Table:
        q, reps_out, dist = [], [], []
        if entries.num_rows and looks.num_rows:
            rest = entries.column("rest").to_numpy()
            order = np.argsort(rest, kind="stable")
            rest, reps = rest[order], entries.column("rep").to_numpy()[order]
            vecs = _matrix(entries.column("vec"))[order]
            queries = _matrix(looks.column("qvec"))
            for i, (own, rests) in enumerate(zip(looks.column("q").to_pylist(), looks.column("rests").to_pylist())):
                rests = np.sort(np.array(rests))
                lo, hi = np.searchsorted(rest, rests, "left"), np.searchsorted(rest, rests, "right")
                pick = np.concatenate([np.arange(a, b) for a, b in zip(lo, hi)])
                if len(pick):
                    near, d = _nearest(queries[i], vecs[pick], reps[pick], top)
                    q.append(np.full(len(near), own))
                    reps_out.append(reps[pick][near])
                    dist.append(d)
        return pa.Table.from_batches([_found(q, reps_out, dist)])
    return run


def _vectors(table: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    """Distinct usable (id, vector) rows, the vectors of one length; floats travel as they are."""
    kind = "array<float>" if table.schema[vec_col].dataType.simpleString() == "array<float>" else "array<double>"
    rows = table.select(F.col(id_col).cast("long").alias("id"), F.col(vec_col).cast(kind).alias("vec"))
    bad = F.exists("vec", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == F.lit(float("inf"))))
    rows = rows.filter("id IS NOT NULL AND vec IS NOT NULL").filter(~bad & F.exists("vec", lambda x: x != 0))
    usual = rows.groupBy(F.size("vec").alias("n")).count().orderBy(F.desc("count"), F.desc("n")).first()
    return rows.filter(F.size("vec") == (usual["n"] if usual else 0)).distinct()


def nearest(table: DataFrame, queries: DataFrame, k: int = 10, id_col: str = "vec_id",
            vec_col: str = "embedding") -> DataFrame:
    """``query_id, rank, vec_id, score`` for each row of ``queries`` (rows of ``table``)."""
    top = k + 1  # the query itself may be among them
    rows = cut(_vectors(table, id_col, vec_col))
    by_vec = Window.partitionBy("vec").orderBy("id")
    index = cut(rows.withColumn("r", F.row_number().over(by_vec)).filter(F.col("r") <= top)
                .groupBy("vec").agg(F.sort_array(F.collect_list("id")).alias("ids"))
                .select(F.col("ids")[0].alias("rep"), "ids", "vec"))
    wanted = queries.select(F.col(id_col).cast("long").alias("id")).distinct()
    asked = rows.join(wanted, "id").withColumnRenamed("id", "query_id")
    # queries with equal vectors are one search
    reps = index.select("rep", F.col("vec").alias("v"))
    asked = cut(asked.join(reps, asked.vec == reps.v).select("query_id", "rep", "vec"))
    search = asked.select("rep", "vec").distinct()
    count = index.count()
    sample = search.orderBy(F.xxhash64("rep"), "rep").limit(CALIBRATE)
    lsh, most = _calibrated(count, sample, index, top)
    if most is None:
        none = index.sparkSession.createDataFrame([], _FOUND_DDL)
        found = _complete(none, cut(search), index, top)
    else:
        found = _looked_up(lsh, most, search, index, count, top)

    # every member of the nearest entries, ranked by distance and id, without the query
    members = found.join(index.select("rep", F.explode("ids").alias("vec_id")), "rep")
    pairs = (asked.select("query_id", F.col("rep").alias("q")).join(members, "q")
             .filter("query_id <> vec_id").groupBy("query_id", "vec_id").agg(F.min("d").alias("score")))
    order = Window.partitionBy("query_id").orderBy("score", "vec_id")
    return (pairs.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))


def _dealt(entries: DataFrame, looks: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Entries ``t, h, rest, rep`` and looks ``t, h, rests, q`` with the ``block`` and ``part`` they
    meet in."""
    family = ["t", "h"]
    # at most TABLES * 2 * dim rows: a fixed size
    blocks = cut(entries.groupBy(*family).agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("blocks")))
    entries = entries.join(F.broadcast(blocks), family).select(
        *family, _block(F.col("rest"), F.col("blocks")).cast("long").alias("block"), "rest", "rep")
    to = F.array_distinct(F.transform("rests", lambda r: _block(r, F.col("blocks"))))
    asked = looks
    looks = (asked.join(F.broadcast(blocks), family).select(*family, "blocks", "rests", "q", F.explode(to).alias("block"))
             .select(*family, F.col("block").cast("long").alias("block"),
                     F.filter("rests", lambda r: _block(r, F.col("blocks")) == F.col("block")).alias("rests"), "q"))
    # codes that fill a block by themselves; counted before they are broadcast
    hot = bounded_broadcast(entries.groupBy(*family, "rest").agg(F.count("*").alias("n")).filter(F.col("n") > BLOCK)
                            .select(*family, "rest", F.ceil(F.col("n") / BLOCK).cast("int").alias("parts")))
    if hot.isEmpty():
        return entries.withColumn("part", F.lit(0)), looks.withColumn("part", F.lit(0))
    own = -1 - F.col("rest")   # a block of their own, below those of the others
    part = F.when(F.col("parts").isNotNull(), F.pmod(F.xxhash64("rep"), F.col("parts")).cast("int")).otherwise(F.lit(0))
    code = [*family, "rest"]
    entries = entries.join(hot, code, "left").select(
        *family, F.when(F.col("parts").isNotNull(), own).otherwise(F.col("block")).alias("block"), part.alias("part"), "rest", "rep")
    probed = (asked.select(*family, "q", F.explode("rests").alias("rest")).join(hot, code)
              .select(*family, own.alias("block"), F.array("rest").alias("rests"), "q",
                      F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part")))
    return entries, looks.withColumn("part", F.lit(0)).unionByName(probed)


def _block(rest: Column, blocks: Column) -> Column:
    return F.pmod(F.xxhash64(rest), blocks).cast("int")


def _looked_up(lsh: CrossPolytope, most: int, search: DataFrame, index: DataFrame, count: int, top: int) -> DataFrame:
    """The nearest entries in the buckets of ``most`` probes a table; queries that find too few
    are answered exactly."""
    vectors = index.select("rep", "vec")
    entries = cut(vectors.mapInArrow(_entries(lsh), "t int, h bigint, rest bigint, rep bigint"))
    looks = search.mapInArrow(_looks(lsh, most), "t int, h bigint, rests array<bigint>, q bigint")
    entries, looks = _dealt(entries, looks)
    entries = entries.join(vectors, "rep").select("t", "h", "block", "part", "rest", "rep", "vec")
    looks = (looks.join(search.select(F.col("rep").alias("of"), F.col("vec").alias("qvec")), F.col("q") == F.col("of"))
             .select("t", "h", "block", "part", "rests", "q", "qvec"))
    keys = ["t", "h", "block", "part"]
    found = cut(_best(entries.groupBy(*keys).cogroup(looks.groupBy(*keys)).applyInArrow(_rank_block(top), _FOUND_DDL), top))
    few = (search.join(found.groupBy("q").count(), search.rep == F.col("q"), "left")
           .filter(F.coalesce("count", F.lit(0)) < min(top, count)).select("rep", "vec"))
    return _complete(found, cut(few), index, top)


def _complete(found: DataFrame, few: DataFrame, index: DataFrame, top: int) -> DataFrame:
    """Answer the queries of ``few`` by exact passes of ``CHUNK`` queries each, every one written
    before the next takes its broadcast."""
    left = few.count()
    if not left:
        return found
    found = found.join(few.select(F.col("rep").alias("q")), "q", "left_anti")
    chunks = -(-left // CHUNK)
    for c in range(chunks):
        part = few.filter(F.pmod(F.xxhash64("rep"), F.lit(chunks)) == c).toPandas()
        if len(part):
            vecs = np.array(part["vec"].tolist(), np.float64)
            found = found.unionByName(written(_exact(index, part["rep"].to_numpy(), vecs, top)))
    return found
