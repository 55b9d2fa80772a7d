"""Embedding near-duplicates by an epsilon grid order join.

Unit vectors are rotated to their leading principal directions, which keeps distances, and sorted by
the grid cells they fall into there, first direction first. The sorted sequence is cut into blocks. Starting
from whole sequences, pairs of intervals are split into their parts again and again, and a pair is
dropped as soon as the boxes of its intervals are further apart than the join's radius. Blocks that
are left are multiplied. Equal vectors are one weighted point throughout, so copies make no pairs.
"""

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wireglean.llm.common import Workspace, components, pick, query, table

COSINE = 0.93
#: Principal directions of the grid; vectors of the sample they are fitted on, whatever the table's size.
DIRECTIONS, SAMPLE = 8, 4000
#: Vectors of a block; parts an interval is split into; partner blocks that one task takes.
BLOCK, SPLIT_BITS, PARTNERS = 512, 4, 64
_SLACK = 1e-9


def _units(vectors: np.ndarray) -> np.ndarray:
    v = vectors.astype(np.float64)
    v = v / np.abs(v).max(axis=1, keepdims=True)
    return v / np.sqrt((v * v).sum(axis=1, keepdims=True))


def directions(points: DataFrame, sample: int) -> tuple[int, np.ndarray]:
    """(vector length, leading principal directions) of the most common length, from a bounded sample."""
    sizes = points.groupBy("size").count().orderBy(F.desc("count"), "size").limit(1).collect()
    if not sizes:
        return 0, np.zeros((0, 0))
    size, n = sizes[0]["size"], sizes[0]["count"]
    draw = (F.xxhash64("vector") / F.lit(float(2**63)) + 1) / 2
    drawn = (points.where(F.col("size") == size).withColumn("draw", draw).where(F.col("draw") <= 1.5 * sample / n)
             .orderBy("draw").limit(sample).select("vector").collect())
    if not drawn:
        return size, np.eye(size)[:DIRECTIONS]
    units = _units(np.array([r["vector"] for r in drawn], np.float64))
    units = units - units.mean(axis=0)
    _, vectors = np.linalg.eigh(units.T @ units)
    return size, vectors[:, ::-1].T[:DIRECTIONS]


def ordered_blocks(points: DataFrame, size: int, basis: np.ndarray, radius: float, ws: Workspace) -> DataFrame:
    """(label, size, seq, n, low0.., high0.., points, weights, vectors): blocks of the grid order, numbered from 0
    within label and vector length."""

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = np.asarray(batch.column("size"))
            place = np.zeros((len(sizes), DIRECTIONS))
            for s in np.unique(sizes):
                at = np.flatnonzero(sizes == s)
                vectors = batch.column("vector").take(pa.array(at)).flatten().to_numpy(zero_copy_only=False)
                units = _units(vectors.reshape(len(at), s))
                used = basis if s == size else np.eye(s)[:DIRECTIONS]
                place[at, :len(used)] = units @ used.T
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(list(np.floor(place / radius).astype(np.int32)), pa.list_(pa.int32())),
                 pa.array(list(place), pa.list_(pa.float64()))], names=[*batch.schema.names, "cell", "place"])

    vector_type = dict(points.dtypes)["vector"]
    label_type = dict(points.dtypes)["label"]
    schema = f"point long, label {label_type}, size int, weight long, vector {vector_type}, cell array<int>, place array<double>"
    placed = points.select("point", "label", "size", "weight", "vector").mapInArrow(project, schema)
    keys = ["label", "size", "cell", "point"]
    tasks = int(points.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ordered = ws.settle(placed, "placed").repartitionByRange(tasks, *keys).sortWithinPartitions(*keys)
    bounds = [f"{side}{d}" for side in ("low", "high") for d in range(DIRECTIONS)]
    schema = (f"label {label_type}, size int, task int, part int, n int, " + ", ".join(f"{b} double" for b in bounds)
              + ", points binary, weights binary, vectors binary")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        task, part, held, last = TaskContext.get().partitionId(), 0, [], None

        def block():
            place = np.array([r[6] for r in held])
            row = [last[0], last[1], task, part, len(held), *place.min(axis=0), *place.max(axis=0),
                   np.array([r[0] for r in held], np.int64).tobytes(), np.array([r[3] for r in held], np.int64).tobytes(),
                   np.array([r[4] for r in held]).astype(kind).tobytes()]
            return pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(row, types)], names=names)

        for batch in batches:
            types = [batch.schema.field("label").type, pa.int32(), pa.int32(), pa.int32(), pa.int32(),
                     *[pa.float64()] * len(bounds), pa.binary(), pa.binary(), pa.binary()]
            names = ["label", "size", "task", "part", "n", *bounds, "points", "weights", "vectors"]
            kind = np.float32 if batch.schema.field("vector").type.value_type == pa.float32() else np.float64
            for row in zip(*(c.to_pylist() for c in batch.columns)):
                if held and ((row[1], row[2]) != last or len(held) == BLOCK):
                    yield block()
                    part = part + 1 if (row[1], row[2]) == last else 0
                    held = []
                held.append(row)
                last = (row[1], row[2])
        if held:
            yield block()

    blocks = ws.settle(ordered.mapInArrow(cut, schema), "cut")
    # Blocks are numbered through the tasks of a label: one row a label and task says how many came before.
    per_task = blocks.groupBy("label", "size", "task").agg(F.count("*").alias("k"))
    before = per_task.alias("a").join(per_task.alias("b"), ["label", "size"]).where("b.task < a.task").groupBy(
        "label", "size", F.col("a.task").alias("task")).agg(F.sum("b.k").alias("before"))
    numbered = blocks.join(before, ["label", "size", "task"], "left").withColumn(
        "seq", F.coalesce("before", F.lit(0)) + F.col("part"))
    ws.drop("placed")
    return ws.settle(numbered.drop("task", "part", "before"), "blocks")


def near_blocks(blocks: DataFrame, radius: float, ws: Workspace) -> DataFrame:
    """(label, size, a, b): pairs of blocks (a <= b) whose boxes are within the radius, by recursive splitting."""
    bounds = [(f"low{d}", f"high{d}") for d in range(DIRECTIONS)]
    top = blocks.agg(F.max("seq")).first()[0] or 0
    level = 0
    while top >> (SPLIT_BITS * level):
        level += 1
    pairs = blocks.select("label", "size").distinct().withColumns({"a": F.lit(0).cast("long"), "b": F.lit(0).cast("long")})
    while level:
        level -= 1
        node = F.shiftright("seq", SPLIT_BITS * level)
        boxes = blocks.groupBy("label", "size", node.alias("node")).agg(
            *[F.min(low).alias(low) for low, _ in bounds], *[F.max(high).alias(high) for _, high in bounds])
        parts = lambda c: F.explode(F.sequence(F.col(c) * (1 << SPLIT_BITS), F.col(c) * (1 << SPLIT_BITS) + (1 << SPLIT_BITS) - 1))
        split = pairs.withColumn("a", parts("a")).withColumn("b", parts("b")).where("a <= b")
        one = boxes.select("label", "size", F.col("node").alias("a"), *[F.col(c).alias(f"a_{c}") for p in bounds for c in p])
        two = boxes.select("label", "size", F.col("node").alias("b"), *[F.col(c).alias(f"b_{c}") for p in bounds for c in p])
        gap = sum((F.pow(F.greatest(F.col(f"a_{low}") - F.col(f"b_{high}"), F.col(f"b_{low}") - F.col(f"a_{high}"),
                                    F.lit(0.0)), F.lit(2.0)) for low, high in bounds), F.lit(0.0))
        pairs = ws.settle(split.join(one, ["label", "size", "a"]).join(two, ["label", "size", "b"])
                          .where(gap <= radius * radius + _SLACK).select("label", "size", "a", "b"), f"near-{level}")
    return pairs


def block_links(blocks: DataFrame, pairs: DataFrame, cosine: float) -> DataFrame:
    """(point, other, links): for each pair of blocks the weight each point links to, and edges that connect what is linked."""
    key = ["label", "size"]
    dealt = pairs.withColumn("deal", F.floor(F.col("b") / PARTNERS))
    first = dealt.select(*key, "a", "deal").distinct().withColumn("seq", F.col("a")).withColumn("kind", F.lit(0))
    rest = dealt.select(*key, "a", "deal", F.col("b").alias("seq"), F.lit(1).alias("kind"))
    data = blocks.select(*key, "seq", "points", "weights", "vectors")
    rows = first.unionByName(rest).join(data, [*key, "seq"])
    ordered = rows.repartition(*key, "a", "deal").sortWithinPartitions(*key, "a", "deal", "kind", "seq").select(
        "size", "kind", "a", "seq", "points", "weights", "vectors")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for batch in batches:
            for i in range(batch.num_rows):
                size, kind, a, seq, points, weights, vectors = (c[0].as_py() for c in batch.slice(i, 1).columns)
                points, weights = np.frombuffer(points, np.int64), np.frombuffer(weights, np.int64)
                raw = np.frombuffer(vectors, np.float32 if len(vectors) == 4 * size * len(points) else np.float64)
                raw = raw.reshape(len(points), size).astype(np.float64)
                block = (points, weights, raw, _units(raw))
                if kind == 0:
                    held = block
                    continue
                made = _links(held, block, a == seq, cosine)
                if made is not None:
                    yield made

    return ordered.mapInArrow(run, "point long, other long, links long")


def _links(one: tuple, two: tuple, same: bool, cosine: float) -> pa.RecordBatch | None:
    likeness = one[3] @ two[3].T
    linked = likeness >= cosine
    # What rounding could move over the threshold is decided by exact sums.
    for i, j in np.argwhere(np.abs(likeness - cosine) < 1e-12):
        x, y = one[2][i], two[2][j]
        norm = math.sqrt(math.fsum(x * x)) * math.sqrt(math.fsum(y * y))
        linked[i, j] = math.fsum(x * y) / norm >= cosine
    if same:
        linked &= ~np.eye(len(linked), dtype=bool)
        linked |= linked.T
    if not linked.any():
        return None
    i, j = np.nonzero(linked)
    points = np.concatenate([one[0], two[0]])
    name, ends = points.copy(), np.stack([i, j + len(one[0])])
    while True:  # the smallest point that each is connected to
        low = np.minimum(name[ends[0]], name[ends[1]])
        new = name.copy()
        np.minimum.at(new, ends[0], low)
        np.minimum.at(new, ends[1], low)
        if (new == name).all():
            break
        name = new
    moved = np.flatnonzero(name != points)
    counts = [(one[0], linked @ two[1])] + ([] if same else [(two[0], linked.T @ one[1])])
    point = np.concatenate([points[moved], *(c[0] for c in counts)])
    return pa.RecordBatch.from_arrays(
        [pa.array(point), pa.array([*name[moved].tolist(), *[None] * (len(point) - len(moved))], pa.int64()),
         pa.array([*[None] * len(moved), *np.concatenate([c[1] for c in counts]).tolist()], pa.int64())],
        names=["point", "other", "links"])


def near_vectors(table_: DataFrame, cosine: float = COSINE, id_column: str = "vec_id", vector_column: str = "embedding",
                 label_column: str = "label", sample: int = SAMPLE) -> DataFrame:
    """(id, n_links, component_id, kept) of every row: links between vectors of one label whose cosine reaches ``cosine``.

    Vectors without label, null, empty or all zero ones, ones with null or non-finite components, and rows
    without id link with nothing; without id there is no component and nothing is kept. Vectors of different
    length never link. Repeated rows are vectors of their own and link with each other. An empty table
    gives an empty one.
    """
    ws = Workspace(table_.sparkSession, "grid")
    rows = pick(table_, id_column, label_column, vector_column).toDF("id", "label", "vector")
    good = (F.col("id").isNotNull() & F.col("label").isNotNull() & F.col("vector").isNotNull()
            & F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
            & F.exists("vector", lambda x: x != 0))
    good = F.coalesce(good, F.lit(False))
    # Equal vectors of a label are one point; copies combine before the shuffle.
    points = ws.settle(rows.where(good).groupBy("label", "vector").agg(F.count("*").alias("weight"), F.min("id").alias("low"))
                       .select(F.monotonically_increasing_id().alias("point"), "label", F.size("vector").alias("size"),
                               "weight", "low", "vector"), "points")
    radius = math.sqrt(max(0.0, 2 - 2 * cosine))
    size, basis = directions(points, sample)
    blocks = ordered_blocks(points, size, basis, max(radius, 1e-6), ws)
    found = ws.settle(block_links(blocks, near_blocks(blocks, radius, ws), cosine), "links")
    links = found.where("links IS NOT NULL").groupBy("point").agg(F.sum("links").alias("links"))
    component = components(found.where("other IS NOT NULL").select(F.col("point").alias("u"), F.col("other").alias("v")),
                           ws, "component").withColumnRenamed("node", "point").distinct()
    known = points.join(component, "point", "left").withColumn("component", F.coalesce("component", "point"))
    least = known.groupBy("component").agg(F.min("low").alias("component_id"))
    known = ws.settle(known.join(least, "component").join(links, "point", "left").select(
        "label", "vector", (F.coalesce("links", F.lit(0)) + F.col("weight") - 1).alias("n_links"), "component_id"), "known")
    linked = rows.where(good).join(known, ["label", "vector"]).select("id", "n_links", "component_id")
    alone = rows.where(~good).select("id", F.lit(0).cast("long").alias("n_links"), F.col("id").alias("component_id"))
    return linked.unionByName(alone).select(
        F.col("id").alias(id_column), "n_links", "component_id",
        F.coalesce(F.col("id") == F.col("component_id"), F.lit(False)).alias("kept"))


_SQL = """
WITH RECURSIVE v AS (SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
    WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
      AND list_bool_and(list_transform(embedding, lambda x: x IS NOT NULL AND isfinite(x)))
      AND list_bool_or(list_transform(embedding, lambda x: x <> 0))),
l AS (SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.label = b.label AND a.vec_id <> b.vec_id
      WHERE list_cosine_similarity(a.e, b.e) >= 0.93),
r AS (SELECT vec_id AS a, vec_id AS b FROM embeddings UNION SELECT r.a, l.b FROM r JOIN l ON r.b = l.a),
c AS (SELECT a AS vec_id, min(b) AS component_id FROM r GROUP BY 1),
n AS (SELECT a AS vec_id, count(*) AS n_links FROM l GROUP BY 1)
SELECT vec_id, coalesce(n_links, 0) AS n_links, component_id, vec_id = component_id AS kept
FROM c LEFT JOIN n USING (vec_id)
"""


@query("op2_near_vectors", _SQL)
def op2_near_vectors(spark, sf_dir):
    return near_vectors(table(spark, sf_dir, "embeddings"))
