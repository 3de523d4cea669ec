"""Gradient-boosted regression trees for a yes/no label.

A tree grows level by level from sums of gradients and curvatures by node, feature and bin.
``fit`` takes them from arrays.  ``fit_table`` takes them from all rows of a table, however
many: every task adds up its rows, Spark adds up the tasks, and the driver sees sums only.
Gradients are rounded to whole multiples of ``1 / UNIT``, so that the sums, and with them the
trees, do not depend on the order of the rows (up to about 5e8 rows; beyond, to rounding).
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from alertfold.llm.common import cut

UNIT = float(1 << 24)
TASK_ROWS = 100_000  # distinct rows a task adds up; as many tasks as it takes for all


class Boosted:
    """Depth-limited trees on quantile thresholds, fitted to the logistic loss.

    A tree is ``(feature, bin, limit, value)``, arrays by node, the children of node i at
    2i + 1 (up to the limit) and 2i + 2; a node without a split sends all rows to the first."""

    def __init__(self, rounds: int = 60, depth: int = 3, rate: float = 0.2, bins: int = 64, least: float = 1.0):
        self.rounds, self.depth, self.rate, self.bins, self.least = rounds, depth, rate, bins, least
        self.cuts: list[np.ndarray] = []
        self.trees: list = []
        self.base = 0.0
        self.done = False

    def fit(self, x: np.ndarray, y: np.ndarray) -> Boosted:
        self.begin([np.quantile(x[:, j], quantiles(self.bins)) for j in range(x.shape[1])], y.mean())
        binned = self.binned(x)
        while not self.done:
            self.grow(self.sums(binned, y, np.ones(len(y))))
        return self

    def begin(self, cuts, share: float) -> None:
        self.cuts = [np.unique(c) for c in cuts]
        share = float(np.clip(share, 1e-3, 1 - 1e-3))
        self.base = float(np.log(share / (1 - share)))
        self._open()

    def _open(self) -> None:
        nodes = 2 ** (self.depth + 1) - 1
        self.level = 0
        self.tree = (np.zeros(nodes, np.int64), np.full(nodes, self.bins + 1), np.full(nodes, np.inf), np.zeros(nodes))

    def binned(self, x: np.ndarray) -> np.ndarray:
        """Bin k of a feature holds the values up to its k-th cut."""
        return np.stack([np.searchsorted(c, x[:, j], "left") for j, c in enumerate(self.cuts)], 1).astype(np.uint8)

    def sums(self, binned: np.ndarray, y: np.ndarray, n: np.ndarray) -> np.ndarray:
        """Gradients and curvatures, times ``UNIT``, of rows that count ``n`` times, by node of
        the open level, feature and bin."""
        p = self.binned_probability(binned)
        weights = [np.rint((p - y) * UNIT) * n, np.rint((p * (1 - p) + 1e-6) * UNIT) * n]
        nodes, width = 2 ** self.level, self.bins + 1
        at = (_node(binned, *self.tree[:2], self.level) - (nodes - 1)) * width
        out = np.empty((nodes, len(self.cuts), width, 2))
        for j in range(len(self.cuts)):
            cell = at + binned[:, j]
            for k, w in enumerate(weights):
                out[:, j, :, k] = np.bincount(cell, w, nodes * width).reshape(nodes, width)
        return out

    def grow(self, sums: np.ndarray) -> None:
        """One more level of the open tree, from the ``sums`` of all rows."""
        feature, bin_, limit, value = self.tree
        g, h = sums[..., 0] / UNIT, sums[..., 1] / UNIT
        all_g, all_h = g[:, :1].sum(2, keepdims=True), h[:, :1].sum(2, keepdims=True)
        gl, hl = np.cumsum(g, 2)[..., :-1], np.cumsum(h, 2)[..., :-1]
        gain = gl * gl / (hl + 1) + (all_g - gl) ** 2 / (all_h - hl + 1) - all_g * all_g / (all_h + 1)
        gain[(hl < self.least) | (all_h - hl < self.least)] = 0
        best = gain.reshape(len(g), -1).argmax(1)
        first = 2 ** self.level - 1
        for i, (j, k) in enumerate(zip(*np.unravel_index(best, gain.shape[1:]))):
            node = first + i
            if gain[i, j, k] <= 1e-6:
                value[2 * node + 1] = value[node]
                continue
            feature[node], bin_[node], limit[node] = j, k, self.cuts[j][k]
            value[2 * node + 1] = -self.rate * gl[i, j, k] / (hl[i, j, k] + 1)
            value[2 * node + 2] = -self.rate * (all_g[i, 0, 0] - gl[i, j, k]) / (all_h[i, 0, 0] - hl[i, j, k] + 1)
        self.level += 1
        if np.isinf(limit[0]):  # nothing is left to tell apart
            self.done = True
        elif self.level == self.depth:
            self.trees.append(self.tree)
            self.done = len(self.trees) == self.rounds
            self._open()

    def probability(self, x: np.ndarray) -> np.ndarray:
        return self._probability(x, 2)

    def binned_probability(self, binned: np.ndarray) -> np.ndarray:
        return self._probability(binned, 1)

    def _probability(self, x: np.ndarray, limits: int) -> np.ndarray:
        score = np.full(len(x), self.base)
        for tree in self.trees:
            score += tree[3][_node(x, tree[0], tree[limits], self.depth)]
        return 1 / (1 + np.exp(-score))


def quantiles(bins: int) -> np.ndarray:
    """Where a feature is cut; from the smallest value on, lest a rare one share a bin."""
    return np.linspace(0, 1, bins + 1)[:-1]


def _node(x: np.ndarray, feature: np.ndarray, limit: np.ndarray, levels: int) -> np.ndarray:
    """The node that each row reaches after so many levels."""
    rows, at = np.arange(len(x)), np.zeros(len(x), np.int64)
    for _ in range(levels):
        at = 2 * at + 1 + (x[rows, feature[at]] > limit[at])
    return at


def fit_table(rows: DataFrame) -> dict[str, Boosted]:
    """Trees for each ``kind`` from all of its rows (``kind, label, x, n``: label 0 or 1, features,
    how often the row counts).  Kinds of one label only are left out."""
    points = ", ".join(f"{q:.17g}D" for q in quantiles(Boosted().bins))
    measured = (rows.select("kind", "label", "n", F.posexplode("x"))
                .groupBy("kind", "pos")
                .agg(F.expr(f"percentile(col, array({points}), n)").alias("cuts"), F.sum("n").alias("n"),
                     F.expr("sum(n * label)").alias("yes"))
                .orderBy("kind", "pos").collect())
    trees = {}
    for kind in dict.fromkeys(r.kind for r in measured):
        own = [r for r in measured if r.kind == kind]
        if 0 < own[0].yes < own[0].n:
            trees[kind] = Boosted()
            trees[kind].begin([r.cuts for r in own], own[0].yes / own[0].n)
    if not trees:
        return {}
    train = cut(binned_rows(rows, trees))
    # the many short jobs of the trees get as many tasks as there are rows for; one needs no shuffle
    train = cut(train.coalesce(-(-train.count() // TASK_ROWS)))
    while not all(t.done for t in trees.values()):
        added = (train.mapInArrow(lambda batches: _cells(batches, trees), "kind string, cell int, g double, h double")
                 .groupBy("kind", "cell").agg(F.sum("g").alias("g"), F.sum("h").alias("h")).toPandas())
        for kind, t in trees.items():
            if not t.done:
                own = added[added["kind"] == kind]
                sums = np.zeros((2 ** t.level, len(t.cuts), t.bins + 1, 2))
                sums.reshape(-1, 2)[own["cell"].to_numpy(np.int64)] = own[["g", "h"]].to_numpy()
                t.grow(sums)
    return trees


def binned_rows(rows: DataFrame, trees: dict[str, Boosted]) -> DataFrame:
    """The rows of the trees' kinds with features as bins, a byte each; equal rows are one."""
    def run(batches):
        for batch in batches:
            for kind, part in by_kind(batch, trees):
                x = part.column("x").flatten().to_numpy(zero_copy_only=False).reshape(part.num_rows, -1)
                packed = [row.tobytes() for row in trees[kind].binned(x)]
                yield pa.RecordBatch.from_arrays([part.column("kind"), part.column("label"), pa.array(packed, pa.binary()),
                                                  part.column("n")], names=["kind", "label", "x", "n"])

    return (rows.select("kind", "label", "x", "n")
            .mapInArrow(run, "kind string, label double, x binary, n bigint")
            .groupBy("kind", "label", "x").agg(F.sum("n").alias("n")))


def by_kind(batch: pa.RecordBatch, trees: dict[str, Boosted]):
    """The batch's rows of each kind that has trees."""
    kinds = np.array(batch.column("kind").to_pylist(), object)
    for kind in trees:
        at = np.flatnonzero(kinds == kind)
        if len(at):
            yield kind, batch.take(pa.array(at))


def unpacked(part: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bins, labels and counts of ``binned_rows``."""
    x = np.frombuffer(b"".join(part.column("x").to_pylist()), np.uint8).reshape(part.num_rows, -1)
    return x, part.column("label").to_numpy(), part.column("n").to_numpy().astype(float)


def _cells(batches, trees: dict[str, Boosted]):
    """A task's sums, one row per cell that is not empty."""
    total: dict[str, np.ndarray] = {}
    for batch in batches:
        for kind, part in by_kind(batch, {k: t for k, t in trees.items() if not t.done}):
            total[kind] = total.get(kind, 0) + trees[kind].sums(*unpacked(part)).reshape(-1, 2)
    for kind, sums in total.items():
        at = np.flatnonzero(sums.any(1))
        yield pa.RecordBatch.from_arrays(
            [pa.array([kind] * len(at), pa.string()), pa.array(at.astype(np.int32)), pa.array(sums[at, 0]),
             pa.array(sums[at, 1])], names=["kind", "cell", "g", "h"])
