"""Helpers of the operators: column choice, settled tables, bounded batches, connected components."""

import os
import sys
import types
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wireglean.session import shared_folder

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

#: Bytes of text that a worker handles at once; single longer texts are handled alone.
SLICE_BYTES = 4 << 20
#: Bytes of a batch that Spark sends to a worker.
BATCH_BYTES = 2 << 20
_BATCH = "spark.sql.execution.arrow.maxBytesPerBatch"


def query(name: str, sql: str | None = None):
    """Register a query, with the SQL that gives the same rows where SQL can say it."""

    def keep(build):
        QUERIES[name] = build
        if sql is not None:
            ORACLES[name] = sql
        return build

    return keep


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def pick(df: DataFrame, *names: str) -> DataFrame:
    """The named columns alone, found by exact spelling, whatever other columns are called."""
    columns = df.columns
    missing = [n for n in names if n not in columns]
    if missing:
        raise ValueError(f"no column {missing} in {columns}")
    if columns == list(names):
        return df
    plain = df.toDF(*[f"_{i}" for i in range(len(columns))])
    return plain.select(*[F.col(f"_{columns.index(n)}").alias(n) for n in names])


def bound_batches(spark: SparkSession) -> None:
    """From now on the session sends rows to workers in batches of ``BATCH_BYTES`` and one row at most, or of what it
    has set if that is less. Spark would take up to 64 MB a batch: texts of a whole task, beside each other in the JVM
    (in buffers that double as they fill) and in the worker, which holds them as long as it handles any."""
    if spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(spark.conf.get(_BATCH)) > BATCH_BYTES:
        spark.conf.set(_BATCH, f"{BATCH_BYTES}b")


class Workspace:
    """A folder of one operator run below the session's shared folder.

    Tables that are read several times are written there once and read back, so a lost
    executor costs a re-read. The folder goes when the session ends, single tables earlier.
    """

    def __init__(self, spark: SparkSession, purpose: str):
        self.spark = spark
        self.folder = f"{shared_folder(spark).rstrip('/')}/{purpose}-{uuid.uuid4().hex}"
        jvm = spark.sparkContext._jvm
        self._path = lambda name: jvm.org.apache.hadoop.fs.Path(f"{self.folder}/{name}" if name else self.folder)
        self._fs = self._path("").getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        self._fs.mkdirs(self._path(""))
        self._fs.deleteOnExit(self._path(""))

    def settle(self, df: DataFrame, name: str) -> DataFrame:
        path = f"{self.folder}/{name}"
        schema = df.schema
        df.write.mode("overwrite").parquet(path)
        return self.spark.read.schema(schema).parquet(path)

    def drop(self, *names: str) -> None:
        for name in names:
            self._fs.delete(self._path(name), True)


def held(key, make: Callable, most: int = 4):
    """What ``make`` returns, kept in this worker process for later tasks of the stage under ``key``.

    Functions travel to the workers with their code, so module variables last one task only;
    what is expensive to build hangs on a module of its own.
    """
    kept = sys.modules.setdefault("wireglean_held", types.ModuleType("wireglean_held")).__dict__
    if key not in kept:
        own = [k for k in kept if isinstance(k, tuple) and k[0] == key[0]]
        for old in own[:max(0, len(own) - most + 1)]:
            del kept[old]
        kept[key] = make()
    return kept[key]


def tidied(run: Callable) -> Callable:
    """A function over batches that gives unused memory back when its task ends: Spark keeps the worker
    process, and with it what its allocators hold, beside the next stage's. What tasks of another stage
    have left under ``held`` goes before it starts."""

    def wrapped(batches):
        if forget_other_stages():
            give_back()
        try:
            yield from run(batches)
        finally:
            give_back()

    return wrapped


def forget_other_stages() -> bool:
    """Drop what is held for any stage but the running task's; whether there was something to drop."""
    context = TaskContext.get()
    kept = sys.modules.setdefault("wireglean_held", types.ModuleType("wireglean_held")).__dict__
    stage = context.stageId() if context else None
    if kept.get("stage") == stage:
        return False
    kept["stage"] = stage
    old = [k for k in kept if isinstance(k, tuple)]
    for key in old:
        del kept[key]
    return bool(old)


def give_back() -> None:
    """Return unused memory of this process to the system."""
    import ctypes
    import gc

    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # of the C library, where it has it
    if trim:
        trim(0)


def slices(batch: pa.RecordBatch, column: str, limit: int = SLICE_BYTES,
           rows: int = 1 << 30) -> Iterator[pa.RecordBatch]:
    """Pieces of a batch whose texts in ``column`` stay within ``limit`` bytes and ``rows`` rows, or are one row."""
    start, held = 0, 0
    sizes = pa.compute.binary_length(batch.column(column)).to_pylist()
    for i, size in enumerate(sizes):
        if i > start and (held + (size or 0) > limit or i - start == rows):
            yield batch.slice(start, i - start)
            start, held = i, 0
        held += size or 0
    if start < batch.num_rows:
        yield batch.slice(start)


def gathered(batches: Iterator[pa.RecordBatch], column: str, limit: int) -> Iterator[pa.RecordBatch]:
    """Shards: batches put together until their texts in ``column`` fill ``limit`` bytes; one longer text is a shard."""
    held: list[pa.RecordBatch] = []
    size = 0
    for batch in batches:
        for part in slices(batch, column, limit):
            own = pa.compute.sum(pa.compute.binary_length(part.column(column))).as_py() or 0
            if held and size + own > limit:
                yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]
                held, size = [], 0
            if part.num_rows:
                held.append(part)
                size += own
    if held:
        yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]


def runs(inside: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(first, end) of the maximal runs of true."""
    edge = np.flatnonzero(np.diff(np.r_[False, inside, False].view(np.int8)))
    return edge[::2], edge[1::2]


def strings(data: np.ndarray, lengths: np.ndarray) -> pa.StringArray:
    """The strings of these lengths in bytes, which stand behind each other in ``data``."""
    offsets = np.zeros(len(lengths) + 1, np.int32)
    np.cumsum(lengths, out=offsets[1:])
    return pa.StringArray.from_buffers(len(lengths), pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(data)))


def file_system(uri: str):
    """(file system, path) of a folder in whatever store its address names, for code inside tasks."""
    from pyarrow import fs

    if uri.startswith("file:"):
        uri = "/" + uri[5:].lstrip("/")
    return (fs.LocalFileSystem(), uri) if uri.startswith("/") else fs.FileSystem.from_uri(uri)


def parquet_batches(uri: str, rows: int, columns: tuple[str, ...] | None = None) -> Iterator[pa.RecordBatch]:
    """A settled table (of it these columns), read inside a task in batches of at most ``rows`` rows."""
    import pyarrow.dataset as ds

    store, path = file_system(uri)
    names = [f.path for f in store.get_file_info(_below(path)) if f.path.endswith(".parquet")]
    if names:
        yield from ds.dataset(sorted(names), filesystem=store, format="parquet").to_batches(
            columns=columns and list(columns), batch_size=rows, batch_readahead=1, fragment_readahead=1)


def _below(path: str):
    from pyarrow import fs

    return fs.FileSelector(path)


def components(edges: DataFrame, ws: Workspace, name: str) -> DataFrame:
    """(node, component): the smallest node reachable, for each node of ``edges`` (u, v).

    Alternating large and small stars: every edge is moved to the smallest neighbour seen, so
    the rounds are logarithmic and no neighbourhood is ever gathered; minima combine before
    the shuffle and the join back is an ordinary join, which the session splits when skewed.
    """
    edges = ws.settle(edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
                      .distinct(), f"{name}-0")
    before, step = None, 0
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.where("u <> v").distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        moved = large.join(low, "u")
        small = (moved.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .unionByName(low.select("u", F.col("m").alias("v"))).distinct())
        step += 1
        edges = ws.settle(small, f"{name}-{step}")
        state = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        ws.drop(f"{name}-{step - 1}")
        if state == before:
            break
        before = state
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
        edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())


def tokenizer_path(name: str) -> str:
    """The place of a public tokenizer file: a folder of them may be named in TOKENIZER_DIR."""
    folder = os.environ.get("TOKENIZER_DIR", "/opt/tokenizers")
    return f"{folder}/{name}"
