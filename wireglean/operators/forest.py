"""Random forest grown a few trees a task, on the binned rows of a bounded training part.

After L. Breiman, "Random Forests", Machine Learning 2001. A task holds the rows as bytes (a broadcast of a byte for
each feature and row) and grows its trees level by level: no sums of nodes travel, and a level reads only the rows of
nodes that are still mixed. Each tree draws its rows with replacement, each node its features; both follow from the seed
and the number of the tree. Scoring is a walk over arrays in the tasks that hold the rows.
"""

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wireglean.operators.binning import BINS, binned, places

#: More rows than this are not sent to tasks as a whole.
MOST_ROWS = 3_000_000
#: Split candidates are quantiles of about so many rows.
SAMPLE = 200_000
#: Bytes of the sums of the nodes that are split together.
AT_ONCE = 48_000_000

#: feature: int16, -1 for a leaf; cut: uint8; leaves: float32, the weights by class of each leaf; gain: float64 a feature.
_TABLE = "tree int, feature binary, cut binary, leaves binary, gain binary"


def _best_splits(bins, rows, place, features, of, weight, count, width, classes, smallest):
    """For each node its best (gain, feature slot, bin, weight by class on the left); ``place`` numbers the nodes.

    ``features`` are (nodes, slots), ``of`` is the class of a row. A gain of 0 is no split.
    """
    slots = features.shape[1]
    start = place * (slots * BINS)
    cell = start[:, None] + np.arange(slots) * BINS + bins[rows[:, None], features[place]]
    shape = (width, slots, BINS)
    counts = np.bincount(cell.ravel(), weights=np.repeat(count, slots), minlength=width * slots * BINS).reshape(shape)
    cell *= classes
    cell += of[:, None]
    left = np.bincount(cell.ravel(), weights=np.repeat(weight, slots),
                       minlength=width * slots * BINS * classes).reshape(*shape, classes)
    del cell
    counts = counts.cumsum(axis=2)
    left = left.cumsum(axis=2)
    total = left[:, :1, -1:, :]
    over_left = left.sum(axis=3)
    over = total.sum(axis=3)
    over_right = over - over_left
    with np.errstate(divide="ignore", invalid="ignore"):
        # Gini: what the sums of squares gain, as a share of the node's weight.
        gain = (np.einsum("nsbk,nsbk->nsb", left, left) / over_left
                + np.einsum("nsbk,nsbk->nsb", total - left, total - left) / over_right
                - np.einsum("nsbk,nsbk->nsb", total, total) / over) / over
    gain[(counts < smallest) | (counts[:, :, -1:] - counts < smallest) | ~np.isfinite(gain)] = 0.0
    flat = gain.reshape(width, -1)
    best = flat.argmax(axis=1)
    every = np.arange(width)
    slot, at = best // BINS, best % BINS
    return flat[every, best], slot, at, left[every, slot, at]


def children(feature: np.ndarray) -> np.ndarray:
    """The first child of each split node; the second follows it. Nodes stand level by level, so splits in their order
    take two nodes each."""
    split = feature >= 0
    return np.where(split, 2 * np.cumsum(split) - 1, -1)


def grow(bins: np.ndarray, label: np.ndarray, weight: np.ndarray, classes: int, depth: int, smallest: int, slots: int,
         seed: list[int]) -> tuple:
    """One tree: feature (or -1) and cut of each node, weights by class of each leaf, gain of each feature."""
    draw = np.random.default_rng(seed)
    count = draw.poisson(1.0, len(bins)).astype(float)
    rows = np.flatnonzero(count)
    count = count[rows]
    weight, of = weight[rows] * count, label[rows].astype(np.int64)
    place, width = np.zeros(len(rows), np.int64), 1
    gain = np.zeros(bins.shape[1])
    parts = []
    for level in range(depth + 1):
        value = np.bincount(place * classes + of, weights=weight, minlength=width * classes).reshape(width, classes)
        size = np.bincount(place, weights=count, minlength=width)
        feature, cut = np.full(width, -1, np.int16), np.zeros(width, np.uint8)
        mixed = np.flatnonzero(((value > 0).sum(axis=1) > 1) & (size >= 2 * smallest))
        if level < depth and len(mixed):
            number = np.full(width, -1, np.int64)
            number[mixed] = np.arange(len(mixed))
            at = number[place]
            some = np.flatnonzero(at >= 0)
            some = some[np.argsort(at[some], kind="stable")]
            ends = np.searchsorted(at[some], np.arange(len(mixed) + 1))
            chosen = draw.random((len(mixed), bins.shape[1])).argpartition(slots - 1, axis=1)[:, :slots]
            chunk = max(1, AT_ONCE // (8 * slots * BINS * classes))
            first = 0
            while first < len(mixed):
                # As many nodes as their sums and their rows allow, one at least.
                last = min(first + chunk, max(first + 1, int(np.searchsorted(ends, ends[first] + AT_ONCE // (16 * slots)))), len(mixed))
                part = some[ends[first]:ends[last]]
                found, slot, bin_, _ = _best_splits(bins, rows[part], at[part] - first, chosen[first:last], of[part],
                                                    weight[part], count[part], last - first, classes, smallest)
                good = np.flatnonzero(found > 1e-12)
                node = mixed[first + good]
                feature[node] = chosen[first + good, slot[good]]
                cut[node] = bin_[good]
                gain += np.bincount(feature[node], weights=found[good] * value[node].sum(axis=1), minlength=len(gain))
                first = last
        split = feature >= 0
        parts.append((feature, cut, value[~split]))
        if not split.any():
            break
        keep = np.flatnonzero(split[place])
        rows, place, count, weight, of = (a[keep] for a in (rows, place, count, weight, of))
        place = 2 * (np.cumsum(split) - 1)[place] + (bins[rows, feature[place]] > cut[place])
        width = 2 * int(split.sum())
    return *(np.concatenate(p) for p in zip(*parts)), gain


@dataclass
class GrownForest:
    """The fitted trees, each (feature, cut, weights by class of the leaves, gain by feature)."""

    grown: list[tuple]
    edges: np.ndarray

    def table(self, spark) -> DataFrame:
        rows = [(t, *(a.tobytes() for a in tree)) for t, tree in enumerate(self.grown)]
        return spark.createDataFrame([*rows, (-1, None, None, None, self.edges.tobytes())], _TABLE)

    @staticmethod
    def from_rows(rows: list, edges: np.ndarray) -> "GrownForest":
        found = []
        for r in sorted(rows, key=lambda r: r["tree"]):
            feature = np.frombuffer(r["feature"], np.int16)
            found.append((feature, np.frombuffer(r["cut"], np.uint8),
                          np.frombuffer(r["leaves"], np.float32).reshape(np.count_nonzero(feature < 0), -1),
                          np.frombuffer(r["gain"])))
        return GrownForest(found, edges)

    @staticmethod
    def from_table(table: DataFrame) -> "GrownForest":
        rows = table.collect()  # one a tree, and one with the edges
        edges = next(np.frombuffer(r["gain"]) for r in rows if r["tree"] < 0).reshape(-1, BINS - 1)
        return GrownForest.from_rows([r for r in rows if r["tree"] >= 0], edges)

    def transform(self, df: DataFrame) -> DataFrame:
        """Add ``_probability``, the mean of the trees' shares."""
        shared = df.sparkSession.sparkContext.broadcast((self.edges, [tree[:3] for tree in self.grown]))

        @F.pandas_udf(T.ArrayType(T.DoubleType()))
        def probability(x: pd.Series) -> pd.Series:
            if not len(x):
                return pd.Series([], dtype=object)
            edges, trees = shared.value
            bins = places(np.stack(x.to_numpy()), edges)
            total = np.zeros((len(bins), trees[0][2].shape[1]))
            for feature, cut, leaves in trees:
                child, leaf = children(feature), np.cumsum(feature < 0) - 1
                at = np.zeros(len(bins), np.int64)
                going = np.arange(len(bins)) if feature[0] >= 0 else np.zeros(0, np.int64)
                while len(going):
                    now = at[going]
                    now = child[now] + (bins[going, feature[now]] > cut[now])
                    at[going] = now
                    going = going[feature[now] >= 0]
                value = leaves[leaf[at]].astype(float)
                total += value / value.sum(axis=1, keepdims=True)
            return pd.Series(list(total / total.sum(axis=1, keepdims=True)))

        return df.withColumn("_probability", probability(vector_to_array("features")))

    def importances(self, width: int) -> np.ndarray:
        """Share of each feature in the gains of a tree, averaged over the trees that split."""
        found = sum((gain / gain.sum() for *_, gain in self.grown if gain.sum() > 0), np.zeros(width))
        return found / (found.sum() or 1.0)

    def trees(self) -> list[dict]:
        """The trees as node arrays for explanations; a node's value is the share of its classes."""
        found = []
        for feature, cut, leaves, _ in self.grown:
            split, child = np.flatnonzero(feature >= 0), children(feature)
            value = np.zeros((len(feature), leaves.shape[1]))
            value[feature < 0] = leaves
            ends = [0, 1]  # of the levels
            while ends[-1] < len(feature):
                ends.append(ends[-1] + 2 * np.count_nonzero(feature[ends[-2]:ends[-1]] >= 0))
            for start, end in zip(ends[-2::-1], ends[:0:-1]):
                inner = split[np.searchsorted(split, start):np.searchsorted(split, end)]
                value[inner] = value[child[inner]] + value[child[inner] + 1]
            threshold = np.zeros(len(feature))
            threshold[split] = self.edges[feature[split], cut[split]]
            found.append({"feature": feature.astype(np.int32), "threshold": threshold, "left": child,
                          "right": np.where(child >= 0, child + 1, -1), "weight": 1.0 / len(self.grown), "only": None,
                          "value": value / value.sum(axis=1, keepdims=True)})
        return found


def fit_grown_forest(train: DataFrame, classes: int, trees: int, depth: int, smallest: int, seed: int) -> GrownForest:
    """Fit on all rows of (features, label_index, weight), which must fit a task as bytes."""
    found = binned(train, None, SAMPLE, seed)
    edges, slots = found.edges, int(np.ceil(np.sqrt(found.bins.shape[1])))
    shared = train.sparkSession.sparkContext.broadcast((found.bins, found.label, found.weight))
    del found

    def fit(batches):
        for batch in batches:
            for t in batch["id"]:
                feature, cut, leaves, gain = grow(*shared.value, classes, depth, smallest, slots, [seed, int(t)])
                yield pd.DataFrame([(int(t), feature.tobytes(), cut.tobytes(), leaves.astype(np.float32).tobytes(),
                                     gain.tobytes())], columns=["tree", "feature", "cut", "leaves", "gain"])

    made = train.sparkSession.range(0, trees, 1, max(1, trees // 4)).mapInPandas(fit, _TABLE)
    return GrownForest.from_rows(made.collect(), edges)
