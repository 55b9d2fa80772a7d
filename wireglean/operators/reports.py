"""Exploration and operations reports."""

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wireglean import taxonomy as tax
from wireglean.functions.numbers import finite, texts
from wireglean.functions.text import masked_ip
from wireglean.operators.features import numeric_columns
from wireglean.operators.order_statistics import quantile_table
from wireglean.session import settle


def _long(row: DataFrame, columns: list[str], fields: dict[str, str]) -> DataFrame:
    """A wide row of aggregates ``<key><position>`` as one row per column."""
    entries = [
        F.struct(F.lit(c).alias("column"), *[F.col(f"{key}{i}").alias(name) for key, name in fields.items()])
        for i, c in enumerate(columns)
    ]
    return row.select(F.inline(F.array(*entries)))


def column_profile(df: DataFrame, approximate: bool = False) -> DataFrame:
    """Type, missing cells, their percentage and the distinct values of every column.

    Exact by default: the cells meet as (column, value) pairs, combined before the shuffle,
    so one pass counts them all and a frequent value is one record per task. (One
    ``count_distinct`` per column would send a whole row for each of its cells.)
    ``approximate`` counts the distinct values by sketch and shuffles no cells.
    """
    fields = df.schema.fields
    values = []
    for f in fields:
        real = f.dataType.typeName() in ("double", "float")
        # Adding 0 makes one value of both zeros.
        values.append(F.nanvl(f.name, F.lit(None).cast(f.dataType)) + F.lit(0.0) if real else F.col(f.name))
    if approximate:
        row = df.agg(F.count("*").alias("rows"), *[F.count(v).alias(f"filled{i}") for i, v in enumerate(values)],
                     *[F.approx_count_distinct(v).alias(f"distinct{i}") for i, v in enumerate(values)])
        counted = row.select(F.inline(F.array(*[
            F.struct(F.lit(i).alias("at"), "rows", F.col(f"filled{i}").alias("filled"),
                     F.col(f"distinct{i}").alias("distinct_values")) for i in range(len(fields))])))
    else:
        cells = [F.struct(F.lit(i).alias("at"), v.cast("string").alias("value")) for i, v in enumerate(values)]
        counted = (
            df.select(F.inline(F.array(*cells))).groupBy("at", "value").agg(F.count("*").alias("n"))
            .groupBy("at").agg(F.sum("n").alias("rows"),
                               F.sum(F.when(F.col("value").isNotNull(), F.col("n"))).alias("filled"),
                               F.count("value").alias("distinct_values"))
            .fillna(0, ["filled"])
        )
    names = F.expr(f"array({texts(f.name for f in fields)})")
    types = F.expr(f"array({texts(f.dataType.simpleString() for f in fields)})")
    missing = F.col("rows") - F.col("filled")
    return counted.select(
        F.get(names, F.col("at")).alias("column"), F.get(types, F.col("at")).alias("dtype"),
        missing.alias("missing"),
        F.round(F.try_divide(missing, F.col("rows")) * 100, 2).alias("missing_pct"), "distinct_values",
    )


def duplicate_rows(df: DataFrame) -> DataFrame:
    """How many rows repeat an earlier one; copies meet before the shuffle."""
    groups = df.groupBy(*df.columns).agg(F.count("*").alias("copies"))
    return groups.agg(F.coalesce(F.sum(F.col("copies") - 1), F.lit(0)).alias("duplicate_rows"))


def numeric_summary(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Mean, standard deviation, minimum, exact median and maximum of numeric columns."""
    columns = columns or numeric_columns(df)
    aggregates = []
    for i, c in enumerate(columns):
        value = finite(c)
        aggregates += [F.avg(value).alias(f"mean{i}"), F.stddev_samp(value).alias(f"std{i}"),
                       F.min(value).alias(f"min{i}"), F.max(value).alias(f"max{i}")]
    names = {"mean": "mean", "std": "std", "min": "min", "max": "max"}
    moments = _long(df.agg(*aggregates), columns, names)
    medians = quantile_table(df, columns, [0.5]).select(
        F.col("feature").alias("column"), F.col("value").alias("median")
    )
    return moments.join(medians, "column", "left")


def class_box_table(df: DataFrame, features: list[str], label: str = "label") -> DataFrame:
    """Five numbers of log1p(feature, not below 0) per class: (label, feature, share, value)."""
    values = {f: finite(f) for f in features}
    squeezed = df.select(label, *[
        F.when(v.isNotNull(), F.log1p(F.greatest(v, F.lit(0.0)))).alias(f) for f, v in values.items()
    ])
    return quantile_table(squeezed, features, [0.0, 0.25, 0.5, 0.75, 1.0], by=label).withColumnRenamed(
        "grp", label
    )


def class_mix(df: DataFrame, classes: list[str], by: str = "port_category",
              label: str = "label") -> DataFrame:
    """The share of each class within every value of ``by``; one column per class."""
    wide = df.groupBy(by).pivot(label, classes).count().fillna(0)
    total = sum((F.col(f"`{c}`") for c in classes[1:]), F.col(f"`{classes[0]}`"))
    return wide.select(by, *[F.try_divide(F.col(f"`{c}`"), total).alias(c) for c in classes])


def top_values(df: DataFrame, column: str, k: int) -> DataFrame:
    """The k most frequent values; ties go to the smaller value."""
    return df.groupBy(column).agg(F.count("*").alias("n")).orderBy(F.desc("n"), column).limit(k)


def _pair_sums(columns: list[str], centre: dict[str, float]):
    """Co-moments of all column pairs for one partition, over the rows where both are present."""
    middle = np.array([centre[c] for c in columns])
    first, second = np.triu_indices(len(columns), 1)

    def run(batches):
        size = len(columns)
        sums = [np.zeros((size, size)) for _ in range(4)]
        for batch in batches:
            x = batch[columns].to_numpy(dtype="float64", na_value=np.nan) - middle
            present = np.isfinite(x).astype("float64")
            x = np.where(present > 0, x, 0.0)
            for total, part in zip(sums, (present.T @ present, x.T @ present, (x * x).T @ present, x.T @ x)):
                total += part
        n, s, q, p = sums
        yield pd.DataFrame({
            "i": first, "j": second, "n": n[first, second],
            "sx": s[first, second], "sy": s[second, first],
            "sxx": q[first, second], "syy": q[second, first], "sxy": p[first, second],
        })

    return run


def correlations(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Pearson correlation of every pair of numeric columns: (feature_a, feature_b, correlation).

    Over the rows where both values are present; null for a constant column. Each
    partition sums up the co-moments of all pairs as matrix products, and only those
    sums (one record per pair and partition) are shuffled. Centring first keeps the
    sums exact enough.
    """
    columns = columns or numeric_columns(df)
    values = {c: finite(c) for c in columns}
    table = df.select(*[v.alias(c) for c, v in values.items()])
    facts = table.agg(*[F.avg(f"`{c}`").alias(f"m{i}") for i, c in enumerate(columns)],
                      *[F.max(F.abs(f"`{c}`")).alias(f"a{i}") for i, c in enumerate(columns)]).first()
    centre = {c: facts[f"m{i}"] or 0.0 for i, c in enumerate(columns)}
    noise = F.array(*[F.lit(1e-12 * (facts[f"a{i}"] or 0.0)) for i in range(len(columns))])
    names = F.array(*[F.lit(c) for c in columns])
    sums = ["n", "sx", "sy", "sxx", "syy", "sxy"]
    schema = "i int, j int, " + ", ".join(f"{s} double" for s in sums)
    pairs = table.mapInPandas(_pair_sums(columns, centre), schema).groupBy("i", "j").agg(
        *[F.sum(s).alias(s) for s in sums]
    )
    n = F.col("n")
    covariance = F.col("sxy") - F.col("sx") * F.col("sy") / n
    spread_x = F.col("sxx") - F.col("sx") * F.col("sx") / n
    spread_y = F.col("syy") - F.col("sy") * F.col("sy") / n
    varies = (
        (n > 1) & (spread_x > n * F.pow(noise[F.col("i")], F.lit(2.0)))
        & (spread_y > n * F.pow(noise[F.col("j")], F.lit(2.0)))
    )
    r = covariance / (F.sqrt(spread_x) * F.sqrt(spread_y))
    return pairs.select(
        names[F.col("i")].alias("feature_a"), names[F.col("j")].alias("feature_b"),
        F.when(varies, F.greatest(F.lit(-1.0), F.least(F.lit(1.0), r))).alias("correlation"),
    )


def strong_pairs(pairs: DataFrame, above: float = 0.90) -> DataFrame:
    return pairs.where(F.abs("correlation") > above).orderBy(
        F.desc(F.abs("correlation")), "feature_a", "feature_b"
    )


def distribution(df: DataFrame, column: str) -> DataFrame:
    return df.groupBy(column).agg(F.count("*").alias("n")).orderBy(F.desc("n"), column)


def class_distribution(df: DataFrame, label: str = "label") -> DataFrame:
    """One row: the share of benign rows, the rarest class, and how many times rarer it is than the most frequent."""
    counts = df.groupBy(F.col(label).alias("label")).agg(F.count("*").alias("n"))
    return counts.agg(
        F.try_divide(F.sum(F.when(F.col("label") == tax.BENIGN, F.col("n"))), F.sum("n")).alias("benign_share"),
        F.min_by("label", F.struct("n", "label")).alias("rarest"),
        F.try_divide(F.max("n"), F.min("n")).alias("imbalance"),
    )


def timeline(scored: DataFrame, when: str = "timestamp", every: str = "30 minutes") -> DataFrame:
    """Flows per time bucket: total, malicious, benign. Buckets without flows count 0;
    rows whose time cannot be read are left out."""
    kind = dict(scored.dtypes)[when]
    moment: Column = F.try_to_timestamp(F.col(when)) if kind == "string" else F.col(when)
    counts = (
        scored.select(moment.alias("_at"), (F.col("prediction") != tax.BENIGN).alias("_bad"))
        .where("_at is not null")
        .groupBy(F.window("_at", every).start.alias("bucket"))
        .agg(F.count("*").alias("total"), F.count_if("_bad").alias("malicious"))
    )
    counts = settle(counts)  # read twice, and what it is made from may hold a model
    span = counts.agg(F.min("bucket").alias("first"), F.max("bucket").alias("last"))
    # In two steps, so that one stray year among the times does not make one huge array.
    stretches = span.select(
        "last", F.explode(F.expr(f"sequence(first, last, interval {every} * 1000)")).alias("start")
    )
    calendar = stretches.repartition("start").select(F.explode(F.expr(
        f"sequence(start, least(start + interval {every} * 999, last), interval {every})")).alias("bucket"))
    # The stretches come out of one row; dealt out, the buckets of a long time are made by many tasks.
    filled = calendar.join(counts, "bucket", "left").fillna(0, ["total", "malicious"])
    return filled.withColumn("benign", F.col("total") - F.col("malicious"))


def top_threats(scored: DataFrame, k: int = 25, tie: str = "flow_id") -> DataFrame:
    """The k malicious flows with the highest risk, endpoints masked."""
    listed = (
        scored.where(F.col("prediction") != tax.BENIGN)
        .orderBy(F.desc("risk_score"), tie).limit(k)
    )
    shown = {
        "source": masked_ip("source_ip") if "source_ip" in scored.columns else F.lit("—"),
        "destination": masked_ip("destination_ip") if "destination_ip" in scored.columns else F.lit("—"),
        "port": F.col("destination_port"),
        "attack": F.col("prediction"),
        "risk": F.col("risk_score"),
        "level": F.col("risk_level"),
        "confidence": F.concat(F.format_number(F.col("confidence") * 100, 1), F.lit("%")),
        "anomaly": F.when(F.col("is_anomaly"), "yes").otherwise("no"),
    }
    present = {n: c for n, c in shown.items() if n != "port" or "destination_port" in scored.columns}
    times = ["timestamp"] if "timestamp" in scored.columns else []
    return listed.select(tie, *times, *[c.alias(n) for n, c in present.items()])


def high_risk_preview(scored: DataFrame, k: int = 200, tie: str = "flow_id") -> DataFrame:
    """The k high-risk flows with the highest score."""
    risky = scored.where(F.col("risk_level").isin("HIGH", "CRITICAL"))
    columns = [c for c in tax.RESULT_COLUMNS if c in scored.columns and c != "is_malicious"]
    return risky.orderBy(F.desc("risk_score"), tie).limit(k).select(tie, *columns)


def anomaly_by_class(scored: DataFrame, label: str = "label") -> DataFrame:
    """Mean anomaly score, flagged share and rows of each true class."""
    return scored.groupBy(label).agg(
        F.avg("anomaly_score").alias("mean_anomaly_score"),
        F.avg(F.col("is_anomaly").cast("double")).alias("flagged_rate"),
        F.count("*").alias("n"),
    )
