"""Rows for growing trees: features as places among 32 quantiles, a byte each.

The places are found by the tasks that hold the rows, so only bytes travel to the driver and from there, once, to the
tasks that grow trees. Split candidates are quantiles of a bounded sample, drawn by content hash, as MLlib's are.
"""

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BINS = 32


@dataclass
class Binned:
    """Rows in the order of a content hash, whatever order they came in."""

    bins: np.ndarray  # (rows, features), uint8
    label: np.ndarray
    weight: np.ndarray
    edges: np.ndarray  # (features, BINS - 1); a row's bin is the number of edges below its value


def _matrix(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def _draw(seed: int) -> Column:
    return F.shiftrightunsigned(F.xxhash64(F.lit(seed), "x", "label_index"), 11) / F.lit(2.0 ** 53)


def places(x: np.ndarray, edges: np.ndarray) -> np.ndarray:
    """(rows, features): the number of edges below each value."""
    bins = np.empty(x.shape, np.uint8)
    for f, e in enumerate(edges):
        bins[:, f] = np.searchsorted(e, x[:, f], side="left")
    return bins


def binned(train: DataFrame, rows: int | None, sample: int, seed: int) -> Binned:
    """(features, label_index, weight) as bytes: all rows, or about ``rows`` of them; edges from about ``sample``."""
    table = train.select(vector_to_array("features").alias("x"), "label_index", "weight")
    n = table.count()
    if not n:
        raise ValueError("no rows to grow trees on")
    if rows is not None:
        table = table.where(_draw(seed) < min(1.0, rows / n)).limit(2 * rows)
        n = min(n, rows)
    drawn = table.where(_draw(seed + 1) < min(1.0, sample / n)).select("x").limit(2 * sample).toArrow()
    x = _matrix((drawn if len(drawn) else table.select("x").limit(sample).toArrow())["x"].combine_chunks())
    edges = np.quantile(x, np.arange(1, BINS) / BINS, axis=0, method="lower").T
    del drawn, x

    def place(batches):
        for batch in batches:
            if not len(batch):
                continue
            x = _matrix(batch.column("x"))
            cells = pa.py_buffer(places(x, edges).tobytes())
            fixed = pa.FixedSizeBinaryArray.from_buffers(pa.binary(x.shape[1]), len(x), [None, cells])
            yield pa.RecordBatch.from_pydict({"h": batch.column("h"), "bins": fixed.cast(pa.binary()),
                                              "label": batch.column("label"), "weight": batch.column("weight")})

    found = table.select(F.xxhash64(F.lit(seed + 2), "x", "label_index").alias("h"), "x",
                         F.col("label_index").cast("int").alias("label"), F.col("weight").cast("double").alias("weight")
                         ).mapInArrow(place, "h long, bins binary, label int, weight double").toArrow()
    cells = found["bins"].combine_chunks()
    bins = np.frombuffer(cells.buffers()[2], np.uint8, len(found) * len(edges)).reshape(len(found), -1)
    label, weight = found["label"].to_numpy(), found["weight"].to_numpy()
    order = np.lexsort((weight, label, found["h"].to_numpy()))
    return Binned(bins[order], label[order].astype(np.int32), weight[order], edges)
