"""Risk scores of classified flows, and the summary of a scored table."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wireglean import taxonomy as tax
from wireglean.functions import risk


def without_detector(classified: DataFrame) -> DataFrame:
    """Neutral anomaly columns where no detector is in use."""
    return classified.withColumns({"anomaly_score": F.lit(0.0), "is_anomaly": F.lit(False)})


def with_risk(classified: DataFrame) -> DataFrame:
    """Add ``risk_score``, ``risk_level``, ``risk_components`` and ``indicators``.

    Needs prediction, confidence, anomaly_score and is_anomaly, none of them null; the
    traffic part reads the derived features that are present. Projections only, no shuffle.
    """
    read = risk.readings(classified.columns)
    parts = {
        "_severity": risk.severity_points(),
        "_confidence": risk.confidence_points(),
        "_anomaly": risk.anomaly_points(),
        "_traffic": risk.traffic_points(),
    }
    points = classified.withColumns(read).withColumns(parts)
    scored = points.withColumns({
        "risk_score": risk.blended_score(),
        "risk_components": F.expr(
            "map('class_severity', bround(_severity, 2), 'model_confidence', bround(_confidence, 2), "
            "'anomaly', bround(_anomaly, 2), 'traffic_characteristics', bround(_traffic, 2))"
        ),
        "indicators": risk.indicators(),
    })
    return scored.withColumn("risk_level", risk.risk_level()).drop(*read, *parts)


def result_columns(scored: DataFrame) -> dict[str, Column]:
    """The eight reported columns of a scored flow."""
    return {
        "prediction": F.col("prediction"),
        "confidence": F.bround("confidence", 4),
        "risk_score": F.col("risk_score"),
        "risk_level": F.col("risk_level"),
        "anomaly_score": F.bround("anomaly_score", 4),
        "is_anomaly": F.col("is_anomaly"),
        "is_malicious": F.col("prediction") != tax.BENIGN,
        "indicators": F.array_join("indicators", "; "),
    }


def result_table(scored: DataFrame, keep: list[str] = ()) -> DataFrame:
    """The result columns next to the kept input columns.

    An input column that has the name of a result column is kept as ``input_<name>``.
    """
    names = {c: f"input_{c}" if c in tax.RESULT_COLUMNS else c for c in keep}
    kept = [F.col(c).alias(name) for c, name in names.items()]
    return scored.select(*kept, *[c.alias(name) for name, c in result_columns(scored).items()])


def malicious(scored: DataFrame) -> DataFrame:
    return scored.where(F.col("prediction") != tax.BENIGN)


def high_risk(scored: DataFrame) -> DataFrame:
    return scored.where(F.col("risk_level").isin("HIGH", "CRITICAL"))


def detector_only(scored: DataFrame) -> DataFrame:
    """Flows the classifier passes and the detector flags."""
    return scored.where((F.col("prediction") == tax.BENIGN) & F.col("is_anomaly"))


def summary(scored: DataFrame) -> DataFrame:
    """One row of headline numbers, from one pass over the scored table.

    The rows meet in one cell per class and level; everything else is made of those cells.
    """
    cells = scored.groupBy("prediction", "risk_level").agg(
        F.count("*").alias("n"),
        F.count_if("is_anomaly").alias("anomalies"),
        F.sum("risk_score").alias("risk"),
        F.max("risk_score").alias("top"),
        F.sum("confidence").alias("confidence"),
    )
    attack = F.col("prediction") != tax.BENIGN

    def rows_where(condition: Column) -> Column:
        return F.coalesce(F.sum(F.when(condition, F.col("n"))), F.lit(0)).cast("bigint")

    totals = cells.agg(
        F.coalesce(F.sum("n"), F.lit(0)).cast("bigint").alias("total_records"),
        rows_where(~attack).alias("benign_records"),
        rows_where(attack).alias("malicious_records"),
        F.coalesce(F.sum("anomalies"), F.lit(0)).cast("bigint").alias("anomalies_detected"),
        rows_where(F.col("risk_level") == "CRITICAL").alias("critical_threats"),
        rows_where(F.col("risk_level") == "HIGH").alias("high_threats"),
        F.sum("risk").alias("_risk"),
        F.max("top").cast("int").alias("max_risk_score"),
        F.sum("confidence").alias("_confidence"),
        F.collect_list(F.struct("prediction", "n")).alias("_classes"),
        F.collect_list(F.struct("risk_level", "n")).alias("_levels"),
    )

    def distribution(entries: str, key: str) -> Column:
        keys = F.array_distinct(F.transform(entries, lambda e: e[key]))
        return F.map_from_entries(F.transform(keys, lambda k: F.struct(
            k,
            F.aggregate(F.filter(entries, lambda e: e[key] == k), F.lit(0).cast("bigint"),
                        lambda total, e: total + e["n"]),
        )))

    n = F.col("total_records")
    return totals.select(
        "total_records", "benign_records", "malicious_records",
        F.bround(F.try_divide(F.col("malicious_records"), n), 4).alias("attack_rate"),
        "anomalies_detected", "critical_threats", "high_threats",
        F.bround(F.try_divide(F.col("_risk"), n), 2).alias("mean_risk_score"),
        "max_risk_score",
        F.bround(F.try_divide(F.col("_confidence"), n), 4).alias("mean_confidence"),
        distribution("_classes", "prediction").alias("attack_distribution"),
        distribution("_levels", "risk_level").alias("risk_distribution"),
    )
