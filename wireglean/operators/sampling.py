"""Exact, repeatable stratified splits, caps and folds without a window per class.

Rows are ordered inside their class by a hash of their content, and a class is cut
at exact ranks found with :mod:`order_statistics`. A row then learns its part by
comparing its hash with the few cut values of its class, so the rows are never
shuffled, and a class that holds most of the table is no hot spot.
"""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wireglean import taxonomy as tax
from wireglean.operators.order_statistics import order_statistics

COPY_CHUNK = 100_000


def row_hash(columns: list[str], seed: int) -> Column:
    """53 hash bits of the row's content, exact as a double."""
    return F.shiftrightunsigned(F.xxhash64(F.lit(seed), *columns), 11).cast("double")


def class_counts(df: DataFrame, label: str = "label", most: int = 10_000) -> dict[str, int]:
    """Rows per class, on the driver: a class column has few values, and more than ``most`` are refused.

    Rows without a label have no class to be dealt by, so they are an error rather than lost further on.
    """
    rows = df.groupBy(label).count().limit(most + 1).collect()
    if len(rows) > most:
        raise ValueError(f"{label!r} has more than {most} values: not a class column")
    missing = sum(r["count"] for r in rows if r[label] is None)
    if missing:
        raise ValueError(f"{missing} rows have no {label!r}: drop or label them first")
    return {r[label]: r["count"] for r in rows}


def _shares(counts: dict[str, int], total: int) -> dict[str, int]:
    """``total`` rows dealt out in proportion; largest remainders get the odd rows."""
    everything = sum(counts.values())
    dealt = {c: n * total // everything for c, n in counts.items()}
    by_remainder = sorted(counts, key=lambda c: (-(counts[c] * total % everything), c))
    for c in by_remainder[: total - sum(dealt.values())]:
        dealt[c] += 1
    return dealt


def split_sizes(counts: dict[str, int], test: float, validation: float) -> dict[str, list[int]]:
    """Rows per class for (train, validation, test); validation is a share of the non-test rows."""
    n = sum(counts.values())
    n_test = -int(-n * test // 1)
    rest = _shares(counts, n - n_test)
    n_validation = -int(-(n - n_test) * validation // 1)
    train = _shares(rest, n - n_test - n_validation)
    return {c: [train[c], rest[c] - train[c], counts[c] - rest[c]] for c in counts}


def fold_sizes(counts: dict[str, int], folds: int) -> dict[str, list[int]]:
    """Rows per class and fold when the classes, laid end to end, are dealt round robin."""
    sizes, start = {}, 0
    for c in sorted(counts):
        end = start + counts[c]
        sizes[c] = [(end - f + folds - 1) // folds - (start - f + folds - 1) // folds
                    for f in range(folds)]
        start = end
    return sizes


def assign_parts(df: DataFrame, sizes: dict[str, list[int]], label: str = "label",
                 seed: int = tax.SEED, into: str = "part") -> DataFrame:
    """Number the rows of each class into parts of exactly the given sizes.

    ``sizes[class]`` lists the rows of part 0, 1, ...; rows beyond the last size get
    the next number. The order is a hash of all columns, so equal input gives equal parts.
    """
    columns = df.columns
    hashed = df.withColumn("_h", row_hash(columns, seed))
    ranks, bounds = {}, {}
    for c, parts in sizes.items():
        upto, total = [], 0
        for size in parts:
            total += size
            upto.append(total)
        bounds[c] = upto
        ranks[(c, "_h")] = [u - 1 for u in upto if u > 0]
    found = order_statistics(hashed.select(label, "_h"), ["_h"], ranks, by=label)

    table, torn = [], []
    for c, upto in bounds.items():
        cuts = []
        for u in upto:
            if u <= 0:
                cuts.append(-1.0)
                continue
            value, below, equal = found.get((c, "_h", u - 1), (2.0 ** 53, 0, 0))
            cuts.append(value)
            if below + equal > u:
                torn.append((c, value, below))
        table.append((c, cuts))
    # One row per class: class_counts bounds their number.
    spark = df.sparkSession
    cuts = F.broadcast(spark.createDataFrame(table, f"`{label}` string, _cuts array<double>"))
    placed = hashed.join(cuts, label)
    part = F.size(F.filter("_cuts", lambda cut: F.col("_h") > cut))
    whole = placed.withColumn(into, part)
    if not torn:
        return whole.select(*columns, into)

    # A cut falls among copies of one row. They are counted, not ranked one by one,
    # and written out again in chunks with their exact ranks.
    ties = F.broadcast(
        spark.createDataFrame(sorted(set(torn)), f"`{label}` string, _h double, _below bigint")
    )
    intact = whole.join(ties, [label, "_h"], "left_anti").select(*columns, into)
    order = Window.partitionBy(label, "_h").orderBy(F.xxhash64(F.lit(seed + 1), *columns)).rowsBetween(
        Window.unboundedPreceding, Window.currentRow
    )
    counted = (
        placed.join(ties, [label, "_h"])
        .groupBy(*columns, "_h", "_below").agg(F.count("*").alias("_n"))
        .withColumn("_end", F.col("_below") + F.sum("_n").over(order))
    )
    upto = F.broadcast(
        spark.createDataFrame(sorted(bounds.items()), f"`{label}` string, _upto array<bigint>")
    )
    chunks = counted.withColumn(
        "_from", F.explode(F.sequence(F.col("_end") - F.col("_n"), F.col("_end") - 1, F.lit(COPY_CHUNK)))
    )
    copies = (
        chunks.repartition(F.col("_from"))
        .withColumn("_rank", F.explode(F.sequence(
            "_from", F.least(F.col("_from") + COPY_CHUNK, F.col("_end")) - 1)))
        .join(upto, label)
        .withColumn(into, F.size(F.filter("_upto", lambda u: F.col("_rank") >= u)))
    )
    return intact.unionByName(copies.select(*columns, into))


PARTS = ["train", "validation", "test"]


def stratified_split(df: DataFrame, label: str = "label", test: float = tax.TEST_SHARE,
                     validation: float = tax.VALIDATION_SHARE, seed: int = tax.SEED) -> DataFrame:
    """Add ``split``: train, validation or test, in exact shares per class."""
    sizes = split_sizes(class_counts(df, label), test, validation)
    parts = assign_parts(df, sizes, label, seed)
    name = F.element_at(F.array(*[F.lit(p) for p in PARTS]), F.col("part") + 1)
    return parts.withColumn("split", name).drop("part")


def capped_classes(df: DataFrame, label: str = "label", cap: int | None = tax.CLASS_CAP,
                   seed: int = tax.SEED) -> DataFrame:
    """At most ``cap`` rows of each class; ``None`` keeps all rows."""
    if cap is None:
        return df
    if cap <= 0:
        raise ValueError("cap must be positive, or None for no cap")
    counts = class_counts(df, label)
    if all(n <= cap for n in counts.values()):
        return df
    sizes = {c: [min(n, cap)] for c, n in counts.items()}
    return assign_parts(df, sizes, label, seed).where("part = 0").drop("part")


def balanced_weights(df: DataFrame, label: str = "label") -> DataFrame:
    """Add ``weight`` = rows / (classes * rows of the class)."""
    counts = class_counts(df, label)
    total = sum(counts.values())
    table = [(c, total / (len(counts) * n)) for c, n in counts.items()]
    weights = df.sparkSession.createDataFrame(table, f"`{label}` string, weight double")
    return df.join(F.broadcast(weights), label)


def with_folds(df: DataFrame, label: str = "label", folds: int = tax.FOLDS,
               seed: int = tax.SEED) -> DataFrame:
    """Add ``fold``, 0 to ``folds - 1``, stratified by class."""
    return assign_parts(df, fold_sizes(class_counts(df, label), folds), label, seed, into="fold")


def hash_sample(df: DataFrame, rows: int, seed: int = tax.SEED) -> DataFrame:
    """Exactly ``rows`` rows (all, if fewer) drawn by content hash."""
    everything = df.withColumn("_all", F.lit("all"))
    counts = class_counts(everything, "_all")
    if counts.get("all", 0) <= rows:
        return df
    parts = assign_parts(everything, {"all": [rows]}, "_all", seed)
    return parts.where("part = 0").drop("part", "_all")
