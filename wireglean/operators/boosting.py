"""Gradient boosting on histograms: one booster per class, the classes side by side on the cluster.

After J. Friedman, "Greedy function approximation", Annals of Statistics 2001, with second-order
gains (T. Chen, C. Guestrin, "XGBoost", KDD 2016). The fit is on a bounded sample of the training rows
(``rows`` at most, drawn by content hash), whose binned values are a few megabytes; each task grows
the trees of one class, and reads at most half of the rows for a level of a tree. Scoring is a walk
over arrays in the tasks that hold the rows.
"""

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wireglean.operators.binning import BINS, binned

SMALLEST_WEIGHT, PENALTY, SMALLEST_GAIN = 1.0, 1.0, 1e-6

_TABLE = "class int, tree int, feature array<int>, threshold array<double>, value array<double>"


def _tables(bins: np.ndarray, columns: np.ndarray, rows: np.ndarray, place: np.ndarray, gradient: np.ndarray,
            hessian: np.ndarray, width: int) -> np.ndarray:
    """(places, columns, bins, 2): sums of gradient and hessian of the rows, column by column."""
    found = np.empty((width, len(columns), BINS, 2))
    start, g, h = place * BINS, gradient[rows], hessian[rows]
    cell = np.empty_like(start)
    for k, c in enumerate(columns):
        np.add(start, bins[c][rows], out=cell)
        for i, values in enumerate((g, h)):
            found[:, k, :, i] = np.bincount(cell, weights=values, minlength=width * BINS).reshape(width, BINS)
    return found


def _grow(bins: np.ndarray, inside: np.ndarray, gradient: np.ndarray, hessian: np.ndarray, columns: np.ndarray,
          depth: int):
    """One tree as a heap: (feature or -1, bin threshold, gradient and hessian sums, node of each row).

    ``bins`` are (features, rows); the rows ``inside`` make the tree. Only the smaller child of a node is summed from
    its rows, the other is what it leaves of its parent's sums, so a level reads at most half of the rows.
    """
    size = 2 ** (depth + 1) - 1
    feature, cut = np.full(size, -1, np.int32), np.zeros(size, np.int32)
    sums = np.zeros((size, 2))
    node = np.zeros(bins.shape[1], np.int64)
    rows, everyone = inside, np.arange(bins.shape[1])  # of open nodes: those inside, and all
    names = np.zeros(1, np.int64)  # the open nodes, whose tables these are
    tables = _tables(bins, columns, rows, np.zeros(len(rows), np.int64), gradient, hessian, 1)
    sums[0] = gradient[rows].sum(), hessian[rows].sum()
    for _ in range(depth):
        below = tables.cumsum(axis=2)
        g, h = below[..., 0], below[..., 1]
        total_g, total_h = g[:, :, -1:], h[:, :, -1:]
        gain = (g * g / (h + PENALTY) + (total_g - g) ** 2 / (total_h - h + PENALTY)
                - total_g * total_g / (total_h + PENALTY))
        gain[(h < SMALLEST_WEIGHT) | (total_h - h < SMALLEST_WEIGHT)] = -1.0
        gain = gain.reshape(len(names), -1)
        best = gain.argmax(axis=1)
        split = np.flatnonzero(gain[np.arange(len(names)), best] > SMALLEST_GAIN)
        if not len(split):
            break
        k, b = best[split] // BINS, best[split] % BINS
        parents = names[split]
        feature[parents], cut[parents] = columns[k], b
        left = below[split, k, b]
        sums[2 * parents + 1], sums[2 * parents + 2] = left, sums[parents] - left
        rows, everyone = (some[feature[node[some]] >= 0] for some in (rows, everyone))
        now = node[everyone]
        node[everyone] = 2 * now + 1 + (bins[feature[now], everyone] > cut[now])
        to = node[rows]
        names = np.stack([2 * parents + 1, 2 * parents + 2], axis=1)
        counts = np.bincount(to, minlength=size)[names]
        small = np.where(counts[:, 0] <= counts[:, 1], 0, 1)
        place = np.full(size, -1, np.int64)
        place[names[np.arange(len(names)), small]] = np.arange(len(names))
        at = place[to]
        few = at >= 0
        made = _tables(bins, columns, rows[few], at[few], gradient, hessian, len(names))
        both = np.empty((len(names), 2, *made.shape[1:]))
        both[np.arange(len(names)), small] = made
        both[np.arange(len(names)), 1 - small] = tables[split] - made
        tables, names = both.reshape(-1, *made.shape[1:]), names.ravel()
    return feature, cut, sums, node


def _boost(bins: np.ndarray, hit: np.ndarray, weight: np.ndarray, edges: np.ndarray, rounds: int, depth: int,
           rate: float, share: float, seed: list[int]):
    """The trees of one class, by the logistic loss; yields (feature, threshold, value). ``bins`` are (features, rows)."""
    draw = np.random.default_rng(seed)
    margin = np.zeros(bins.shape[1])
    n_columns = max(1, int(round(share * len(bins))))
    for _ in range(rounds):
        chance = 1 / (1 + np.exp(-margin))
        inside = np.flatnonzero(draw.random(len(margin)) < share)
        columns = np.sort(draw.choice(len(bins), n_columns, replace=False))
        feature, cut, sums, node = _grow(bins, inside, weight * (chance - hit), weight * chance * (1 - chance), columns,
                                         depth)
        value = -rate * sums[:, 0] / (sums[:, 1] + PENALTY)
        margin += value[node]
        yield feature, np.where(feature >= 0, edges[np.maximum(feature, 0), np.minimum(cut, BINS - 2)], 0.0), value


@dataclass
class Booster:
    """The fitted trees: (classes, trees, nodes) arrays, whose size follows from the settings alone."""

    feature: np.ndarray
    threshold: np.ndarray
    value: np.ndarray

    def table(self, spark) -> DataFrame:
        rows = [(c, t, self.feature[c, t].tolist(), self.threshold[c, t].tolist(), self.value[c, t].tolist())
                for c in range(self.feature.shape[0]) for t in range(self.feature.shape[1])]
        return spark.createDataFrame(rows, _TABLE)

    @staticmethod
    def from_table(table: DataFrame) -> "Booster":
        # One row per class and round. An ordered query would compute the rows twice, first to find its ranges.
        rows = sorted(table.collect(), key=lambda r: (r["class"], r["tree"]))
        classes = max(r["class"] for r in rows) + 1
        shape = (classes, len(rows) // classes, len(rows[0]["feature"]))
        return Booster(np.array([r["feature"] for r in rows], np.int32).reshape(shape),
                       np.array([r["threshold"] for r in rows]).reshape(shape),
                       np.array([r["value"] for r in rows]).reshape(shape))

    def transform(self, df: DataFrame) -> DataFrame:
        """Add ``_margins``, one per class."""
        shared = df.sparkSession.sparkContext.broadcast(self._complete())

        @F.pandas_udf(T.ArrayType(T.DoubleType()))
        def margins(x: pd.Series) -> pd.Series:
            if not len(x):
                return pd.Series([], dtype=object)
            feature, threshold, value, depth = shared.value
            matrix = np.stack(x.to_numpy())
            cells, first = matrix.ravel(), np.arange(len(matrix)) * matrix.shape[1]
            total = np.zeros((len(matrix), len(feature)))
            for c in range(len(feature)):
                for f, cut, gives, levels in zip(feature[c], threshold[c], value[c], depth[c]):
                    at = np.zeros(len(matrix), np.int64)
                    for _ in range(levels):
                        right = cells[first + f[at]] > cut[at]
                        at += at
                        at += 1
                        at += right
                    total[:, c] += gives[at]
            return pd.Series(list(total))

        return df.withColumn("_margins", margins(vector_to_array("features")))

    def _complete(self) -> tuple:
        """(feature, threshold, value, depth of each tree): a leaf above its tree's last level goes on to the left, and
        hands its value down, so that all rows take as many steps."""
        feature, threshold, value = np.maximum(self.feature, 0), self.threshold.copy(), self.value.copy()
        nodes = self.feature.shape[2]
        level = np.log2(np.arange(1, nodes + 1)).astype(int)
        depth = np.where(self.feature >= 0, level + 1, 0).max(axis=2)
        ends = self.feature < 0
        threshold[ends] = np.inf
        for node in range(nodes // 2):
            value[:, :, 2 * node + 1] = np.where(ends[:, :, node], value[:, :, node], value[:, :, 2 * node + 1])
        return feature, threshold, value, depth

    def importances(self, width: int) -> np.ndarray:
        """Share of the splits that each feature makes, averaged over the classes."""
        shares = [np.bincount(f[f >= 0], minlength=width) / max(1, (f >= 0).sum()) for f in self.feature]
        return np.mean(shares, axis=0)

    def trees(self) -> list[dict]:
        """The trees as node arrays for explanations; a node's value is the mean of the leaves below it."""
        found = []
        for c in range(len(self.feature)):
            for f, cut, gives in zip(self.feature[c], self.threshold[c], self.value[c]):
                found.append({"feature": f, "threshold": cut, "left": 2 * np.arange(len(f)) + 1,
                              "right": 2 * np.arange(len(f)) + 2, "value": gives[:, None], "weight": 1.0, "only": c})
        return found


def fit_boosting(train: DataFrame, classes: int, rounds: int, depth: int, rate: float, share: float, rows: int,
                 seed: int) -> Booster:
    """Fit on (features, label_index, weight); at most about ``rows`` of the rows, drawn by their hash."""
    spark = train.sparkSession
    found = binned(train, rows, rows, seed)
    shared = spark.sparkContext.broadcast((np.ascontiguousarray(found.bins.T), found.label, found.weight, found.edges))

    def fit(batches):
        for batch in batches:
            for c in batch["id"]:
                bins, label, weight, edges = shared.value
                made = _boost(bins, (label == c).astype(float), weight, edges, rounds, depth, rate, share, [seed, int(c)])
                found = [(int(c), t, f, cut, v) for t, (f, cut, v) in enumerate(made)]
                yield pd.DataFrame(found, columns=["class", "tree", "feature", "threshold", "value"])

    return Booster.from_table(spark.range(0, classes, 1, classes).mapInPandas(fit, _TABLE))
