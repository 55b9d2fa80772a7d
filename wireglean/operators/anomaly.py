"""Isolation forest: built from small samples in parallel, applied as array walks.

After F. T. Liu, K. M. Ting, Z.-H. Zhou, "Isolation Forest", ICDM 2008.
"""

import math
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wireglean import taxonomy as tax
from wireglean.operators.order_statistics import quantiles
from wireglean.operators.sampling import row_hash

TREES = 200
SUBSAMPLE = 256
EULER = 0.5772156649015329


def usual_depth(n) -> np.ndarray:
    """Mean path length of an unsuccessful search among n rows."""
    n = np.asarray(n, dtype=float)
    safe = np.maximum(n, 3.0)
    long = 2.0 * (np.log(safe - 1.0) + EULER) - 2.0 * (safe - 1.0) / safe
    return np.where(n <= 1, 0.0, np.where(n == 2, 1.0, long))


def _grow(x: np.ndarray, rng: np.random.Generator, depth: int) -> tuple[list, list, list]:
    """One tree as a heap: split feature (-1 for a leaf), threshold, and path length at a leaf."""
    size = 2 ** (depth + 1) - 1
    feature, threshold, path = [-1] * size, [0.0] * size, [0.0] * size
    todo = [(0, 0, x)]
    while todo:
        node, level, rows = todo.pop()
        low, high = rows.min(axis=0), rows.max(axis=0)
        varying = np.flatnonzero(high > low)
        if level == depth or len(rows) <= 1 or not len(varying):
            path[node] = level + float(usual_depth(len(rows)))
            continue
        f = int(rng.choice(varying))
        # Below the maximum, so that both sides keep a row.
        cut = min(float(rng.uniform(low[f], high[f])), float(np.nextafter(high[f], low[f])))
        feature[node], threshold[node] = f, cut
        left = rows[:, f] <= cut
        todo += [(2 * node + 1, level + 1, rows[left]), (2 * node + 2, level + 1, rows[~left])]
    return feature, threshold, path


@dataclass
class Forest:
    """The fitted trees; their number and depth are parameters, so the size does not grow with the data."""

    feature: np.ndarray  # (trees, nodes)
    threshold: np.ndarray
    path: np.ndarray
    subsample: int

    def table(self, spark) -> DataFrame:
        rows = [(t, f.tolist(), c.tolist(), p.tolist())
                for t, (f, c, p) in enumerate(zip(self.feature, self.threshold, self.path))]
        return spark.createDataFrame(
            rows, "tree int, feature array<int>, threshold array<double>, path array<double>")

    @staticmethod
    def from_table(table: DataFrame, subsample: int) -> "Forest":
        # One row per tree. An ordered query would compute the rows twice, first to find its ranges.
        rows = sorted(table.collect(), key=lambda r: r["tree"])
        return Forest(
            np.array([r["feature"] for r in rows], dtype=np.int32),
            np.array([r["threshold"] for r in rows]), np.array([r["path"] for r in rows]), subsample,
        )


def fit_forest(rows: DataFrame, features: str = "features_array", trees: int = TREES,
               subsample: int = SUBSAMPLE, seed: int = tax.SEED) -> Forest:
    """Grow the trees in parallel, each from its own ``subsample`` rows drawn without replacement.

    Every row draws whether it applies to any tree, and if so to which, at the same rate
    whatever the size of the table; a tree takes the rows with its smallest draws, so a
    group holds a few hundred rows.
    """
    n = rows.count()
    if n == 0:
        raise ValueError("no rows to fit the detector on")
    psi = min(subsample, n)
    depth = max(1, math.ceil(math.log2(max(psi, 2))))
    hashed = rows.select(row_hash(rows.columns, seed).alias("_h"), F.col(features).alias("x"))
    # Twice the needed draws (and some), of which a tree keeps the smallest. Most rows of a big
    # table apply to no tree, which one draw decides; the others draw for each tree.
    chance = min(1.0, (2.0 * psi + 64) / n)
    applies = min(1.0, trees * chance)
    hashed = hashed.where(F.shiftrightunsigned(F.xxhash64("_h", F.lit(seed + 2)), 11) / F.lit(2.0 ** 53) < applies)
    chance /= applies
    draws = F.transform(F.sequence(F.lit(0), F.lit(trees - 1)), lambda t: F.struct(
        t.alias("tree"),
        (F.shiftrightunsigned(F.xxhash64(F.col("_h"), t, F.lit(seed + 1)), 11) / F.lit(2.0 ** 53)).alias("draw"),
    ))
    chosen = F.filter(draws, lambda d: d["draw"] < chance)
    candidates = hashed.select("x", "_h", F.inline(chosen))

    def build(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values(["draw", "_h"], kind="stable").head(psi)
        tree = int(group["tree"].iloc[0])
        rng = np.random.default_rng([seed, tree])
        feature, threshold, path = _grow(np.stack(group["x"].to_numpy()), rng, depth)
        return pd.DataFrame({"tree": [tree], "feature": [feature], "threshold": [threshold], "path": [path]})

    schema = "tree int, feature array<int>, threshold array<double>, path array<double>"
    return Forest.from_table(candidates.groupBy("tree").applyInPandas(build, schema), psi)


def raw_score(forest: Forest, vector: Column) -> Column:
    """-2^(-mean path / usual path): lower is odder. Vectorised over each Arrow batch."""
    feature, threshold, path = forest.feature, forest.threshold, forest.path
    usual = float(usual_depth(forest.subsample)) or 1.0
    levels = int(math.log2(feature.shape[1] + 1)) - 1

    @F.pandas_udf(T.DoubleType())
    def score(x: pd.Series) -> pd.Series:
        if not len(x):
            return pd.Series([], dtype="float64")
        matrix = np.stack(x.to_numpy())
        rows = np.arange(len(matrix))
        total = np.zeros(len(matrix))
        for f, cut, length in zip(feature, threshold, path):
            at = np.zeros(len(matrix), dtype=np.int64)
            for _ in range(levels):
                split = f[at]
                inner = split >= 0
                if not inner.any():
                    break
                right = matrix[rows, np.maximum(split, 0)] > cut[at]
                at = np.where(inner, 2 * at + 1 + right, at)
            total += length[at]
        return pd.Series(-np.exp2(-(total / len(feature)) / usual))

    return score(vector)


def calibration(mixed: DataFrame, benign: DataFrame, score: str,
                contamination: float = tax.CONTAMINATION) -> tuple[float, float, float]:
    """(low, high, threshold): the 0.5 and 99.5 % scores of mixed traffic, and the score that
    the given share of benign training flows falls below."""
    low, high = quantiles(mixed, [score], [0.005, 0.995])[("", score)]
    threshold = quantiles(benign, [score], [contamination])[("", score)][0]
    return low, high, threshold


def normalised(raw: Column, low: float, high: float) -> Column:
    """0 to 1, higher is odder; 0 where the calibration has no span."""
    if high <= low:
        return F.when(raw.isNotNull(), F.lit(0.0))
    share = (F.lit(high) - raw) / F.lit(high - low)
    return F.greatest(F.lit(0.0), F.least(F.lit(1.0), share))


def flagged(raw: Column, threshold: float) -> Column:
    return raw < F.lit(threshold)


@dataclass
class Detector:
    forest: Forest
    low: float
    high: float
    threshold: float
    contamination: float
    trained_on_rows: int

    def apply(self, df: DataFrame, vector: str = "features_array") -> DataFrame:
        """Add ``anomaly_score`` and ``is_anomaly``."""
        raw = df.withColumn("_raw_score", raw_score(self.forest, F.col(vector)))
        return raw.withColumns({
            "anomaly_score": normalised(F.col("_raw_score"), self.low, self.high),
            "is_anomaly": flagged(F.col("_raw_score"), self.threshold),
        }).drop("_raw_score")

    def facts(self) -> dict:
        return {"contamination": self.contamination, "threshold": self.threshold, "low": self.low,
                "high": self.high, "trained_on_rows": self.trained_on_rows,
                "subsample": self.forest.subsample}


def fit_detector(train: DataFrame, label: str = "label", vector: str = "features_array",
                 contamination: float = tax.CONTAMINATION, trees: int = TREES,
                 subsample: int = SUBSAMPLE, seed: int = tax.SEED) -> Detector:
    """Fit on benign rows (all rows, if none are) and calibrate on all rows.

    ``train`` carries the label and the feature array; the rows should be distinct, as
    cleaned rows are.
    """
    benign = train.where(F.col(label) == tax.BENIGN)
    if benign.isEmpty():
        benign = train
    forest = fit_forest(benign, vector, trees, subsample, seed)
    # Scored once: finding quantiles reads the scores several times.
    scores = {name: t.select(raw_score(forest, F.col(vector)).alias("raw")).persist(StorageLevel.MEMORY_AND_DISK)
              for name, t in {"mixed": train, "benign": benign}.items()}
    low, high, threshold = calibration(scores["mixed"], scores["benign"], "raw", contamination)
    trained_on = scores["benign"].count()
    for table in scores.values():
        table.unpersist()
    return Detector(forest, low, high, threshold, contamination, trained_on)
