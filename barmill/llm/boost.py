"""Gradient boosted trees for two classes, on arrays or on Spark tables of features, with calibrated thresholds."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barmill.llm.util import arrow_map, stored

TREES = 40
DEPTH = 3
RATE = 0.3
LEAF = 8
CUTS = 16
#: Gradients are summed in whole numbers of this share of 1.
SCALE = 1 << 20


@dataclass
class Trees:
    """Complete binary trees: feature and cut of each inner node, value of each leaf."""

    depth: int
    base: float = 0.0
    features: list[np.ndarray] = field(default_factory=list)
    cuts: list[np.ndarray] = field(default_factory=list)
    leaves: list[np.ndarray] = field(default_factory=list)

    def raw(self, x: np.ndarray) -> np.ndarray:
        out = np.full(len(x), self.base)
        rows = np.arange(len(x))
        for features, cuts, leaves in zip(self.features, self.cuts, self.leaves):
            node = np.zeros(len(x), np.int64)
            for _ in range(self.depth):
                node = 2 * node + 1 + (x[rows, features[node]] > cuts[node])
            out += leaves[node - len(features)]
        return out

    def node(self, x: np.ndarray, level: int) -> np.ndarray:
        """The node of the last tree that each row reaches at a level."""
        rows, node = np.arange(len(x)), np.zeros(len(x), np.int64)
        for _ in range(level):
            node = 2 * node + 1 + (x[rows, self.features[-1][node]] > self.cuts[-1][node])
        return node

    def probability(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-self.raw(x)))


def fit(x: np.ndarray, y: np.ndarray, trees: int = TREES, depth: int = DEPTH, rate: float = RATE) -> Trees:
    """Second-order boosting of the logistic loss; cuts are taken from quantiles of each feature."""
    model = Trees(depth)
    if not len(y):
        return model
    share = y.mean().clip(0.01, 0.99)
    model.base = float(np.log(share / (1 - share)))
    grid = [np.unique(np.quantile(f, np.linspace(0, 1, CUTS + 1)[:-1])) for f in x.T]
    raw = np.full(len(y), model.base)
    inner = 2**depth - 1
    for _ in range(trees):
        p = 1 / (1 + np.exp(-raw))
        g, h = y - p, p * (1 - p)
        features, cuts = np.zeros(inner, np.int64), np.full(inner, np.inf)
        node = np.zeros(len(y), np.int64)
        for at in range(inner):
            rows = np.flatnonzero(node == at)
            if len(rows) >= 2 * LEAF:
                features[at], cuts[at] = _split(x[rows], g[rows], h[rows], grid)
            node[rows] = 2 * at + 1 + (x[rows, features[at]] > cuts[at])
        leaf = node - inner
        top = np.bincount(leaf, g, inner + 1)
        leaves = rate * top / (np.bincount(leaf, h, inner + 1) + 1.0)
        model.features.append(features)
        model.cuts.append(cuts)
        model.leaves.append(leaves)
        raw += leaves[leaf]
    return model


def _split(x: np.ndarray, g: np.ndarray, h: np.ndarray, grid: list[np.ndarray]) -> tuple[int, float]:
    best, found = 1e-9, (0, np.inf)
    g_all, h_all = g.sum(), h.sum()
    for f, cuts in enumerate(grid):
        if len(cuts) < 2:
            continue
        over = x[:, f, None] > cuts[None, :]
        count = over.sum(0)
        gr, hr = g @ over, h @ over
        gain = gr**2 / (hr + 1) + (g_all - gr) ** 2 / (h_all - hr + 1) - g_all**2 / (h_all + 1)
        gain = np.where((count >= LEAF) & (len(g) - count >= LEAF), gain, 0)
        if gain.max() > best:
            best, found = gain.max(), (f, float(cuts[gain.argmax()]))
    return found


def grids(rows: DataFrame) -> dict[str, list[np.ndarray]]:
    """Cuts of each feature by kind: quantiles over all rows (kind, f, n)."""
    each = rows.select("kind", "n", F.posexplode("f").alias("at", "x")).groupBy("kind", "at", "x").agg(F.sum("n").alias("n"))
    shares = F.array(*(F.lit(float(s)) for s in np.linspace(0, 1, CUTS + 1)[:-1]))
    out: dict[str, list[np.ndarray]] = {}
    for r in each.groupBy("kind", "at").agg(F.percentile("x", shares, F.col("n")).alias("q")).orderBy("kind", "at").collect():
        out.setdefault(r["kind"], []).append(np.unique(r.q))  # CUTS numbers a feature
    return out


def grow(rows: DataFrame, trees: int = TREES, depth: int = DEPTH, rate: float = RATE) -> dict[str, Trees]:
    """Trees of each kind over all rows (kind, y, n, f): the fit of fit() with its sums taken by Spark.

    A row counts n times. Each level of a tree is one aggregate, for all kinds together: sums by node, feature and place
    among the cuts. Sums are of whole numbers, so that they are the same in any order.
    """
    cuts = grids(rows)
    kinds, width = sorted(cuts), max((len(g) for g in cuts.values()), default=0)
    binned = stored(arrow_map(rows.select("kind", "y", "n", "f"), _binned(cuts), "kind string, y boolean, n long, bins binary"), "binned")
    shares = binned.groupBy("kind").agg((F.sum(F.col("n") * F.col("y").cast("int")) / F.sum("n")).alias("s")).collect()
    models = {r.kind: Trees(depth, float(np.log(s / (1 - s)))) for r in shares for s in [min(max(r.s, 0.01), 0.99)]}
    inner = 2**depth - 1
    shape = (inner, width, CUTS + 1)
    for _ in range(trees):
        for m in models.values():
            m.features.append(np.zeros(inner, np.int64))
            m.cuts.append(np.full(inner, np.inf))
            m.leaves.append(np.zeros(inner + 1))
        for level in range(depth):
            sums = arrow_map(binned, _summed(models, level, shape), "kind string, cell int, g long, h long, n long")
            sums = sums.groupBy("kind", "cell").agg(F.sum("g").alias("g"), F.sum("h").alias("h"), F.sum("n").alias("n"))
            table = {k: np.zeros((3, *shape)) for k in kinds}
            found = sums.toArrow().to_pydict()  # a row for each node, feature and cut
            for kind, cell, *values in zip(*(found[c] for c in ("kind", "cell", "g", "h", "n"))):
                table[kind].reshape(3, -1)[:, cell] = values
            for kind, m in models.items():
                for node in range(2**level - 1, 2 ** (level + 1) - 1):
                    _place(m, node, table[kind][:, node] / np.array([SCALE, SCALE, 1])[:, None, None], cuts[kind], rate, inner)
    for kind, m in models.items():
        m.cuts = [np.array([cuts[kind][f][int(c)] if np.isfinite(c) else c for f, c in zip(fs, cs)]) for fs, cs in zip(m.features, m.cuts)]
    return models


def _binned(cuts: dict[str, list[np.ndarray]]):
    """Each feature of a row as the number of cuts that it is over."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kinds, x = batch.column(0).to_pylist(), batch.column(3).to_pylist()
            bins = [bytes(np.searchsorted(g, v) for g, v in zip(cuts[k], f)) for k, f in zip(kinds, x)]
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(bins, pa.binary())], names=["kind", "y", "n", "bins"])

    return run


def _summed(models: dict[str, Trees], level: int, shape: tuple[int, int, int]):
    """Sums of gradients, of curvatures and of rows by node of the level, feature and place among the cuts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = {k: np.zeros((3, int(np.prod(shape)))) for k in models}
        for batch in batches:
            kinds = np.array(batch.column(0).to_pylist(), object)
            for kind, m in models.items():
                own = np.flatnonzero(kinds == kind)
                if not len(own):
                    continue
                rows = batch.take(pa.array(own))
                x = np.frombuffer(b"".join(rows.column(3).to_pylist()), np.uint8).reshape(len(own), -1)
                y, n = rows.column(1).to_numpy(zero_copy_only=False), rows.column(2).to_numpy()
                p, node = m.probability(x), m.node(x, level)
                g, h = np.rint((y - p) * SCALE) * n, np.rint(p * (1 - p) * SCALE) * n
                cell = ((node[:, None] * shape[1] + np.arange(x.shape[1])) * shape[2] + x).ravel()
                for sums, values in zip(total[kind], (g, h, n)):
                    sums += np.bincount(cell, np.repeat(values, x.shape[1]), len(sums))
        for kind, sums in total.items():
            cell = np.flatnonzero(sums[2])
            columns = [pa.array([kind] * len(cell), pa.string()), pa.array(cell.astype(np.int32)), *(pa.array(s[cell].astype(np.int64)) for s in sums)]
            yield pa.RecordBatch.from_arrays(columns, names=["kind", "cell", "g", "h", "n"])

    return run


def _place(m: Trees, node: int, sums: np.ndarray, grid: list[np.ndarray], rate: float, inner: int) -> None:
    """Choose the cut of a node of the tree under way, and give its children their values if they are leaves."""
    whole = sums[:, 0].sum(axis=1)  # every row is in one place of the first feature
    right, best = np.zeros(3), 1e-9
    if whole[2] >= 2 * LEAF:
        for f, cuts in enumerate(grid):
            if len(cuts) < 2:
                continue
            over = np.cumsum(sums[:, f, ::-1], axis=1)[:, ::-1][:, 1 : len(cuts) + 1]
            gr, hr, nr = over
            gain = gr**2 / (hr + 1) + (whole[0] - gr) ** 2 / (whole[1] - hr + 1) - whole[0] ** 2 / (whole[1] + 1)
            gain = np.where((nr >= LEAF) & (whole[2] - nr >= LEAF), gain, 0)
            if gain.max() > best:
                best, at = gain.max(), int(gain.argmax())
                m.features[-1][node], m.cuts[-1][node], right = f, at, over[:, at]
    left = 2 * node + 1 - inner
    if left >= 0:
        for leaf, (g, h, n) in ((left, whole - right), (left + 1, right)):
            m.leaves[-1][leaf] = rate * g / (h + 1.0)


def threshold(p: np.ndarray, y: np.ndarray, precision: float, n: np.ndarray | None = None) -> float:
    """The least probability from which a share of at least precision is right on rows not used to fit, else 1.

    A row counts n times, once without it.
    """
    n = np.ones(len(y)) if n is None else n
    order = np.argsort(-p, kind="stable")
    right = np.cumsum((y * n)[order]) / np.cumsum(n[order])
    last = np.concatenate((p[order][1:] != p[order][:-1], [True])) if len(y) else np.empty(0, bool)
    good = np.flatnonzero((right >= precision) & last)
    return float(max(p[order][good[-1]], 0.5)) if len(good) else 1.1
