"""Exact order statistics and quantiles in two scans that never put a whole column into one task.

The first scan keeps a mergeable sketch per group and column; it brackets each wanted rank between two
values. The second scan counts what lies below a bracket and keeps the values inside it, a few thousandths
of the column, combined before the shuffle into one row per distinct value. Ranks are then found among these
settled values by histograms, which are narrowed further only where very many distinct values are left. A
sketch is right only with high probability: a rank outside of its bracket gets the side that it lies on as a
new one, and one more scan.
"""

from itertools import groupby
from math import ceil, floor

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wireglean.functions.numbers import finite
from wireglean.session import settle

BUCKETS = 4096
LEAF_ROWS = 200_000
MAX_GROUPS = 10_000
#: Size of a sketch, and how far around a rank its bracket reaches (about twice the sketch's usual error).
SKETCH_SIZE, REACH = 2048, 0.005
#: Edges of brackets are quantiles at multiples of 1 / GRID.
GRID = 1000

OPEN = "tid int, bracket long, lo double, hi double, mode string, ranks array<bigint>"


def _group(by: str | None) -> Column:
    return F.coalesce(F.col(by).cast("string"), F.lit("")) if by else F.lit("")


def _value(column: str) -> Column:
    """The cell as a finite double: NaN and infinities count as missing."""
    return finite(column)


def _folded(x: Column) -> Column:
    """A monotone squeeze of the whole double range, so one far outlier does not
    press all other values into the first bucket."""
    return F.signum(x) * F.log1p(F.abs(x))


def _narrow(cells: DataFrame, intervals: list[tuple]) -> list:
    """One pass over the kept values: for each interval and rank, the bucket that holds the rank."""
    spark = cells.sparkSession
    # One row per distinct interval, all made on the driver; the session sizes the join.
    table = spark.createDataFrame([(*i[:5], sorted(i[5])) for i in intervals], OPEN)
    inside = cells.join(table, "bracket").where("x >= lo and x <= hi")

    def placed(name: str) -> Column:
        return F.when(F.col("mode") == "folded", _folded(F.col(name))).otherwise(F.col(name))

    at, start, end = placed("x"), placed("lo"), placed("hi")
    # Halves keep the width finite for the largest doubles.
    share = (at / 2 - start / 2) / F.greatest(end / 2 - start / 2, F.lit(5e-324))
    bucket = F.when(F.col("mode") == "value", F.col("x")).otherwise(
        F.least(F.floor(share * BUCKETS).cast("double"), F.lit(float(BUCKETS - 1)))
    )
    histogram = (
        inside.select("tid", bucket.alias("bucket"), "x", "n")
        .groupBy("tid", "bucket")
        .agg(F.sum("n").alias("n"), F.min("x").alias("lo"), F.max("x").alias("hi"))
    )
    # At most BUCKETS, or LEAF_ROWS distinct values, per interval.
    running = Window.partitionBy("tid").orderBy("bucket").rowsBetween(
        Window.unboundedPreceding, Window.currentRow
    )
    summed = histogram.withColumn("upto", F.sum("n").over(running))
    ranks = spark.createDataFrame(
        [(i[0], r) for i in intervals for r in i[5]], "tid int, rank bigint"
    )
    found = summed.join(ranks, "tid").where("rank < upto and rank >= upto - n")
    return found.select(
        "tid", "rank", "lo", "hi", "n", (F.col("upto") - F.col("n")).alias("below")
    ).collect()


def _sketches(df: DataFrame, columns: list[str], by: str | None, most_groups: int) -> DataFrame:
    """(grp, item, n, lo, hi, sketch) of each group and column with values, from one scan; settled."""
    rows = df.select(_group(by).alias("grp"), *[_value(c).alias(f"x{i}") for i, c in enumerate(columns)])
    facts = [F.struct(F.lit(i).alias("item"), F.count(f"x{i}").alias("n"), F.min(f"x{i}").alias("lo"),
                      F.max(f"x{i}").alias("hi"), F.kll_sketch_agg_double(f"x{i}", SKETCH_SIZE).alias("sketch"))
             for i in range(len(columns))]
    found = settle(rows.groupBy("grp").agg(F.array(*facts).alias("facts")))
    if by and found.count() > most_groups:
        raise ValueError(f"more than {most_groups} groups in {by!r}: not a class column")
    return found.select("grp", F.inline("facts"))


def _bracketed(wanted: DataFrame) -> list:
    """(grp, item, n, lo, hi, rank, from, to) of rows (grp, item, n, lo, hi, sketch, rank)."""
    n, grid = F.col("n"), F.array(*[F.lit(i / GRID) for i in range(GRID + 1)])
    low, high = F.floor((F.col("rank") / n - REACH) * GRID), F.ceil(((F.col("rank") + 1) / n + REACH) * GRID)
    rows = wanted.where("n > 0").withColumn("grid", F.kll_sketch_get_quantile_double("sketch", grid)).select(
        "grp", "item", "n", "lo", "hi", "rank",
        F.when(low <= 0, F.col("lo")).otherwise(F.get("grid", low.cast("int"))).alias("from"),
        F.when(high >= GRID, F.col("hi")).otherwise(F.get("grid", high.cast("int"))).alias("to"))
    return [tuple(r) for r in rows.distinct().collect()]


def _kept(df: DataFrame, columns: list[str], by: str | None, brackets: list[tuple]) -> DataFrame:
    """(bracket, x, n): the distinct values inside each bracket and how often they occur; x null: how many lie below.

    ``brackets`` are (group, item, from, to). One scan, vectorised by column; settled.
    """
    groups = sorted({b[0] for b in brackets})
    place = {g: i for i, g in enumerate(groups)}
    layers: list[dict] = []  # of each column, arrays over the groups: one bracket a group
    used: dict[tuple, int] = {}
    for number, (grp, item, low, high) in enumerate(brackets):
        depth = used[grp, item] = used.get((grp, item), -1) + 1
        while True:
            layer = next((one for one in layers if one["item"] == item and one["depth"] == depth), None)
            if layer is not None:
                break
            layers.append({"item": item, "depth": depth, "from": np.full(len(groups), np.inf),
                           "to": np.full(len(groups), -np.inf), "number": np.full(len(groups), -1)})
        layer["from"][place[grp]], layer["to"][place[grp]], layer["number"][place[grp]] = low, high, number
    items = sorted({b[1] for b in brackets})
    shared = df.sparkSession.sparkContext.broadcast((place, layers))

    def run(batches):
        place, layers = shared.value
        below = np.zeros((len(layers), len(place) + 1), np.int64)
        for batch in batches:
            coded = batch.column("grp").dictionary_encode()
            group = np.array([place.get(g, -1) for g in coded.dictionary.to_pylist()])[np.asarray(coded.indices)]
            for i, layer in enumerate(layers):
                column = batch.column(f"x{layer['item']}")
                has = np.asarray(column.is_valid()) & (group >= 0)
                x, g = column.to_numpy(zero_copy_only=False)[has], group[has]
                below[i] += np.bincount(g[x < layer["from"][g]], minlength=len(place) + 1)
                inside = (x >= layer["from"][g]) & (x <= layer["to"][g])
                if inside.any():
                    order = np.lexsort((x[inside], g[inside]))
                    x, g = x[inside][order], g[inside][order]
                    first = np.flatnonzero(np.r_[True, (x[1:] != x[:-1]) | (g[1:] != g[:-1])])
                    yield pa.RecordBatch.from_pydict({
                        "bracket": layer["number"][g[first]], "x": x[first], "n": np.diff(np.r_[first, len(x)])})
        for i, layer in enumerate(layers):
            some = np.flatnonzero(below[i])
            yield pa.RecordBatch.from_pydict({"bracket": layer["number"][some], "x": pa.nulls(len(some), pa.float64()),
                                              "n": below[i][some]})

    rows = df.select(_group(by).alias("grp"), *[_value(columns[i]).alias(f"x{i}") for i in items])
    found = rows.mapInArrow(run, "bracket long, x double, n long")
    return settle(found.groupBy("bracket", "x").agg(F.sum("n").alias("n")))


def _solved(df: DataFrame, columns: list[str], by: str | None, pending: list[tuple]) -> dict:
    """``{(group, column, rank): (value, rows below it, rows equal to it)}`` from (grp, item, n, lo, hi, rank, from, to)."""
    answers: dict = {}
    while pending:
        brackets = sorted({(p[0], p[1], p[6], p[7]) for p in pending})
        number = {b: i for i, b in enumerate(brackets)}
        kept = _kept(df, columns, by, brackets)
        # One row a bracket.
        totals = {r["bracket"]: r for r in kept.groupBy("bracket").agg(
            F.sum(F.when(F.col("x").isNull(), F.col("n")).otherwise(0)).alias("below"),
            F.sum(F.when(F.col("x").isNotNull(), F.col("n")).otherwise(0)).alias("inside"),
            F.min("x").alias("lo"), F.max("x").alias("hi")).collect()}
        open_, again = [], []
        for grp, item, n, lo, hi, rank, start, end in pending:
            key = number[grp, item, start, end]
            found = totals.get(key)
            below, inside = (found["below"], found["inside"]) if found else (0, 0)
            if rank < below:
                again.append((grp, item, n, lo, hi, rank, lo, start))
            elif rank >= below + inside:
                again.append((grp, item, n, lo, hi, rank, end, hi))
            else:
                open_.append((key, found["lo"], found["hi"], inside, below, rank, "folded"))
        cells = kept.where("x IS NOT NULL")
        where = {i: (b[0], columns[b[1]]) for b, i in number.items()}
        while open_:
            for key, lo, hi, n, below, rank, _ in open_:
                if lo == hi:
                    answers[(*where[key], rank)] = (lo, below, n)
            still = sorted(p for p in open_ if p[1] != p[2])
            if not still:
                break
            intervals, details = [], {}
            for tid, (same, members) in enumerate(groupby(still, key=lambda p: p[:5] + p[6:])):
                key, lo, hi, n, below, mode = same
                details[tid] = same
                intervals.append((tid, key, lo, hi, "value" if n <= LEAF_ROWS else mode, [m[5] - below for m in members]))
            open_ = []
            for hit in _narrow(cells, intervals):
                key, lo, hi, n, below, _ = details[hit["tid"]]
                # An interval too narrow to divide holds but a few doubles: rank those.
                stuck = (hit["lo"], hit["hi"], hit["n"]) == (lo, hi, n)
                open_.append((key, hit["lo"], hit["hi"], hit["n"], below + hit["below"], below + hit["rank"],
                              "value" if stuck else "linear"))
        pending = again
    return answers


def order_statistics(df: DataFrame, columns: list[str], ranks: dict, by: str | None = None,
                     most_groups: int = MAX_GROUPS) -> dict:
    """The values at the given 0-based ranks.

    ``ranks[(group, column)]`` lists the ranks wanted (group is ``""`` without
    ``by``). Returns ``{(group, column, rank): (value, rows below it, rows equal to it)}``.
    Works for any number of rows; the driver holds only the brackets.
    """
    wanted = [(grp, columns.index(column), int(r)) for (grp, column), rs in ranks.items() if column in columns
              for r in set(rs) if r >= 0]
    if not wanted:
        return {}
    table = df.sparkSession.createDataFrame(wanted, "grp string, item int, rank bigint")
    sketches = _sketches(df, columns, by, most_groups)
    return _solved(df, columns, by, _bracketed(sketches.join(table, ["grp", "item"]).where("rank < n")))


def quantiles(df: DataFrame, columns: list[str], shares: list[float],
              by: str | None = None, most_groups: int = MAX_GROUPS) -> dict:
    """Exact quantiles with linear interpolation: ``{(group, column): [value, ...]}``.

    The ranks come from :func:`order_statistics` whatever the size of the table.
    """
    sketches = _sketches(df, columns, by, most_groups)
    sizes = {(r["grp"], r["item"]): r["n"] for r in sketches.select("grp", "item", "n").collect()}
    places = F.transform(F.array(*map(F.lit, map(float, shares))), lambda s: s * (F.col("n") - 1))
    ranks = F.array_distinct(F.concat(F.transform(places, lambda p: F.floor(p)), F.transform(places, lambda p: F.ceil(p))))
    found = _solved(df, columns, by, _bracketed(sketches.where("n > 0").withColumn("rank", F.explode(ranks))))
    result = {}
    for grp in sorted({g for g, _ in sizes}):
        for i, column in enumerate(columns):
            n = sizes.get((grp, i), 0)
            values = []
            for share in shares:
                if not n:
                    values.append(None)
                    continue
                at = share * (n - 1)
                low = found[(grp, column, floor(at))][0]
                high = found[(grp, column, ceil(at))][0]
                values.append(low if low == high else low + (high - low) * (at - floor(at)))
            result[(grp, column)] = values
    return result


def quantile_table(df: DataFrame, columns: list[str], shares: list[float],
                   by: str | None = None) -> DataFrame:
    """:func:`quantiles` as rows (grp, feature, share, value); one row per group, column, share."""
    values = quantiles(df, columns, shares, by)
    rows = [(grp, column, float(s), v) for (grp, column), vs in values.items()
            for s, v in zip(shares, vs)]
    schema = T.StructType([
        T.StructField("grp", T.StringType()), T.StructField("feature", T.StringType()),
        T.StructField("share", T.DoubleType()), T.StructField("value", T.DoubleType()),
    ])
    return df.sparkSession.createDataFrame(rows, schema)
