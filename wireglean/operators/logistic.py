"""Multinomial logistic regression by Newton's method: tens of passes over the rows, not hundreds.

The loss is that of MLlib without standardization: the weighted mean of the rows' losses and half of ``penalty`` times
the squared coefficients, intercepts free. Rows are kept as blocks of numbers; a pass sends gradient and curvature, whose
size follows from classes and features alone, and the driver solves for the step.
"""

import uuid

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.ml.classification import LogisticRegressionModel
from pyspark.ml.common import _py2java
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import DenseMatrix, DenseVector
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: A fit ends where the next step would lower the loss by less than this share of it (MLlib's fits before: 1e-4).
SMALLEST_STEP = 1e-5
#: Or where even a step held this short does not lower it.
LONGEST_HOLD = 1e9
AT_ONCE = 2_048
#: Sums of more tasks than this are added up by tasks before they go to the driver.
MOST_PARTS = 32

_PARTS = "size double, loss double, gradient binary, curve binary"


def _sums(x: np.ndarray, label: np.ndarray, weight: np.ndarray, w: np.ndarray) -> tuple[float, np.ndarray, np.ndarray]:
    """Loss, gradient and curvature of some rows; ``x`` ends with a column of ones, ``w`` is (classes, columns)."""
    classes, width = w.shape
    z = x @ w.T
    z -= z.max(axis=1, keepdims=True)
    p = np.exp(z)
    total = p.sum(axis=1, keepdims=True)
    every = np.arange(len(x))
    loss = float(weight @ (np.log(total[:, 0]) - z[every, label]))
    p /= total
    miss = p.copy()
    miss[every, label] -= 1.0
    gradient = (miss * weight[:, None]).T @ x
    root = np.sqrt(weight)[:, None]
    spread = ((root * p)[:, :, None] * x[:, None, :]).reshape(len(x), -1)
    curve = -(spread.T @ spread)
    for c in range(classes):
        block = slice(c * width, (c + 1) * width)
        curve[block, block] += (x * (weight * p[:, c])[:, None]).T @ x
    return loss, gradient, curve


def _blocks(train: DataFrame) -> DataFrame:
    """(n, x, label, weight): the rows of a batch as numbers."""

    def pack(batches):
        for batch in batches:
            if not len(batch):
                continue
            yield pa.RecordBatch.from_pydict({
                "n": pa.array([len(batch)], pa.int32()),
                "x": pa.array([batch.column("x").flatten().to_numpy(zero_copy_only=False).tobytes()], pa.binary()),
                "label": pa.array([batch.column("label").to_numpy().tobytes()], pa.binary()),
                "weight": pa.array([batch.column("weight").to_numpy().tobytes()], pa.binary())})

    rows = train.select(vector_to_array("features").alias("x"), F.col("label_index").cast("int").alias("label"),
                        F.col("weight").cast("double").alias("weight"))
    return rows.mapInArrow(pack, "n int, x binary, label binary, weight binary")


def _pass(blocks: DataFrame, w: np.ndarray, partitions: int) -> tuple[float, float, np.ndarray, np.ndarray]:
    """Weight, loss, gradient and curvature of all rows."""
    shared = blocks.sparkSession.sparkContext.broadcast(w)

    def run(batches):
        w = shared.value
        size, loss, gradient, curve = 0.0, 0.0, np.zeros(w.shape), np.zeros((w.size, w.size))
        for batch in batches:
            for n, x, label, weight in zip(*(batch.column(c) for c in ("n", "x", "label", "weight"))):
                x = np.frombuffer(x.as_buffer()).reshape(n.as_py(), -1)
                label, weight = np.frombuffer(label.as_buffer(), np.int32), np.frombuffer(weight.as_buffer())
                for i in range(0, len(x), AT_ONCE):
                    part = slice(i, i + AT_ONCE)
                    rows = np.concatenate([x[part], np.ones((len(x[part]), 1))], axis=1)
                    a, b, c = _sums(rows, label[part], weight[part], w)
                    size, loss = size + float(weight[part].sum()), loss + a
                    gradient += b
                    curve += c
        upper = curve[np.triu_indices(len(curve))]
        yield pa.RecordBatch.from_pydict({
            "size": [size], "loss": [loss], "gradient": [gradient.tobytes()], "curve": [upper.tobytes()]})

    def add(batches):
        rows = [r for batch in batches for r in batch.to_pylist()]
        if rows:
            yield pa.RecordBatch.from_pydict({k: [v] for k, v in _added(rows).items()})

    parts = blocks.mapInArrow(run, _PARTS)
    if partitions > MOST_PARTS:
        parts = parts.repartition(int(partitions ** 0.5)).mapInArrow(add, _PARTS)
    found = _added([r.asDict() for r in parts.collect()])  # a row for each of a few dozen tasks
    curve = np.zeros((w.size, w.size))
    curve[np.triu_indices(w.size)] = np.frombuffer(found["curve"])
    shared.destroy()
    return found["size"], found["loss"], np.frombuffer(found["gradient"]).reshape(w.shape), curve + np.triu(curve, 1).T


def _added(rows: list[dict]) -> dict:
    return {k: sum(r[k] for r in rows) for k in ("size", "loss")} | {
        k: sum(np.frombuffer(r[k]) for r in rows).tobytes() for k in ("gradient", "curve")}


def fit_logistic(train: DataFrame, iterations: int) -> LogisticRegressionModel:
    """Fit on (features, label_index, weight); one unit of squared coefficients against the whole summed loss."""
    blocks = _blocks(train).persist(StorageLevel.MEMORY_AND_DISK)
    sizes = blocks.select("n", (F.length("x") / F.col("n")).alias("bytes"), F.spark_partition_id().alias("part"))
    facts = sizes.agg(F.sum("n").alias("rows"), F.max("bytes").alias("bytes"),
                      F.count_distinct("part").alias("partitions")).first()
    if not facts["rows"]:
        raise ValueError("no rows to fit on")
    summed = train.agg(F.max("label_index").alias("top"), F.sum("weight").alias("weight")).first()
    classes, width = int(summed["top"]) + 1, int(facts["bytes"]) // 8 + 1
    bound = np.full((classes, width), 1.0 / summed["weight"])
    bound[:, -1] = 0.0
    w = _newton(blocks, np.zeros((classes, width)), bound, iterations, facts["partitions"])
    blocks.unpersist()
    w[:, -1] -= w[:, -1].mean()
    context = train.sparkSession.sparkContext
    model = context._jvm.org.apache.spark.ml.classification.LogisticRegressionModel(
        f"LogisticRegression_{uuid.uuid4().hex[:12]}", _py2java(context, DenseMatrix(classes, width - 1, w[:, :-1].ravel(), True)),
        _py2java(context, DenseVector(w[:, -1])), classes, True)
    return LogisticRegressionModel(model)


def _newton(blocks: DataFrame, w: np.ndarray, bound: np.ndarray, iterations: int, partitions: int) -> np.ndarray:
    """Steps until they would lower the loss no more. Far outliers make steps that raise it: these are taken back and
    held shorter, by a share ``hold`` of the curvature of each number, which falls again as steps keep their promise."""

    def at(w):
        size, loss, gradient, curve = _pass(blocks, w, partitions)
        return (loss / size + 0.5 * float((bound * w * w).sum()), (gradient / size + bound * w).ravel(),
                curve / size + np.diag(bound.ravel()))

    loss, gradient, curve = at(w)
    hold = 0.0
    for _ in range(iterations):
        own = curve.diagonal()
        while True:
            # The loss does not change with all intercepts together, so the curvature needs a little help there.
            step = -np.linalg.solve(curve + np.diag(own * hold + 1e-11 * own.max() + 1e-300), gradient)
            promised = -float(gradient @ step) - 0.5 * float(step @ (curve @ step))
            if hold > LONGEST_HOLD or hold <= 0.01 and not promised > SMALLEST_STEP * loss:
                return w
            found = at(w + step.reshape(w.shape))
            kept = (loss - found[0]) / promised if promised > 0 else 0.0
            if kept > 1e-3:
                break
            hold = max(10 * hold, 1e-3)
        w = w + step.reshape(w.shape)
        loss, gradient, curve = found
        hold = hold / 8 if kept > 0.5 else hold * 2 if kept < 0.1 else hold
        hold = hold if hold > 1e-6 else 0.0
    return w
