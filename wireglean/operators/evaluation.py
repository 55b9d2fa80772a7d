"""Classifier metrics, all made of the confusion cells (one per label and prediction)."""

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wireglean import taxonomy as tax
from wireglean.session import settle


def confusion_cells(df: DataFrame, label: str = "label", prediction: str = "prediction",
                    classes: list[str] | None = None) -> DataFrame:
    """(label, prediction, n); with ``classes`` every pair is present, zeros included."""
    cells = df.groupBy(F.col(label).alias("label"), F.col(prediction).alias("prediction")).agg(
        F.count("*").alias("n")
    )
    if classes is None:
        return cells
    pairs = [(a, p) for a in classes for p in classes]
    grid = df.sparkSession.createDataFrame(pairs, "label string, prediction string")
    return grid.join(cells, ["label", "prediction"], "left").fillna(0, ["n"])


def confusion_matrix(df: DataFrame, classes: list[str], label: str = "label",
                     prediction: str = "prediction") -> DataFrame:
    """The wide form: one row ``true_<class>``, one column ``pred_<class>`` per class."""
    cells = confusion_cells(df, label, prediction, classes)
    wide = cells.groupBy("label").pivot("prediction", classes).sum("n")
    return wide.select(
        F.concat(F.lit("true_"), "label").alias("actual"),
        *[F.col(f"`{c}`").alias(f"pred_{c}") for c in classes],
    )


def normalised_confusion(cells: DataFrame) -> DataFrame:
    """Each cell as a share of its row; an empty row gives zeros."""
    rows = Window.partitionBy("label")
    share = F.col("n") / F.greatest(F.sum("n").over(rows), F.lit(1))
    return cells.withColumn("share", share)


def _ratio(part: Column, whole: Column) -> Column:
    return F.when(whole > 0, part / whole).otherwise(F.lit(0.0))


def per_class(cells: DataFrame) -> DataFrame:
    """Precision, recall, F1 and support of every class among labels or predictions."""
    hit = F.when(F.col("label") == F.col("prediction"), F.col("n")).otherwise(0)
    none = F.lit(0).cast("bigint")
    roles = F.array(
        F.struct(F.col("label").alias("class"), hit.cast("bigint").alias("tp"),
                 F.col("n").alias("support"), none.alias("predicted")),
        F.struct(F.col("prediction").alias("class"), none.alias("tp"),
                 none.alias("support"), F.col("n").alias("predicted")),
    )
    counts = cells.select(F.inline(roles)).groupBy("class").agg(
        *[F.sum(c).alias(c) for c in ("tp", "support", "predicted")]
    )
    precision = _ratio(F.col("tp"), F.col("predicted"))
    recall = _ratio(F.col("tp"), F.col("support"))
    return counts.withColumns({"precision": precision, "recall": recall}).withColumn(
        "f1", _ratio(2 * F.col("precision") * F.col("recall"), F.col("precision") + F.col("recall"))
    )


def metrics(classes: DataFrame) -> DataFrame:
    """The metric row of one model, from :func:`per_class`; without rows the shares are null."""
    total = F.sum("support")
    benign = F.col("class") == tax.BENIGN

    def of_benign(column: str) -> Column:
        return F.coalesce(F.sum(F.when(benign, F.col(column))), F.lit(0)).cast("bigint")

    def macro(column: str) -> Column:
        return F.avg(column).alias(f"macro_{column}")

    def weighted(column: str) -> Column:
        return F.try_divide(F.sum(F.col(column) * F.col("support")), total).alias(f"weighted_{column}")

    sums = classes.agg(
        F.try_divide(F.sum("tp"), total).alias("accuracy"),
        # Classes without true rows count as recall 0 in the macro recall but not here.
        F.avg(F.when(F.col("support") > 0, F.col("recall"))).alias("balanced_accuracy"),
        macro("precision"), macro("recall"), macro("f1"),
        weighted("precision"), weighted("recall"), weighted("f1"),
        total.alias("_n"), of_benign("tp").alias("true_negatives"),
        of_benign("support").alias("_benign"), of_benign("predicted").alias("_passed"),
    )
    missed = F.col("_passed") - F.col("true_negatives")
    attacks = F.col("_n") - F.col("_benign")
    alarms = F.col("_benign") - F.col("true_negatives")
    return sums.withColumns({
        "true_positives": attacks - missed,
        "false_negatives": missed,
        "false_positives": alarms,
        "attack_detection_rate": (attacks - missed) / F.greatest(attacks, F.lit(1)),
        "false_alarm_rate": alarms / F.greatest(F.col("_benign"), F.lit(1)),
    }).drop("_n", "_benign", "_passed")


def security_view(cells: DataFrame) -> DataFrame:
    """Attack against benign: the four counts, detection and false-alarm rate."""
    return metrics(per_class(cells)).select(
        "true_positives", "false_negatives", "false_positives", "true_negatives",
        "attack_detection_rate", "false_alarm_rate",
    )


def evaluate(df: DataFrame, classes: list[str] | None = None, label: str = "label",
             prediction: str = "prediction") -> DataFrame:
    return metrics(per_class(confusion_cells(df, label, prediction, classes)))


def class_auc(df: DataFrame, scores: dict[str, Column], label: str = "label") -> DataFrame:
    """Exact one-vs-rest AUC per class: (class, positives, negatives, auc).

    The sum over pairs is made of ranks. Distinct scores are counted first (a score
    shared by many rows is one record), spread in order over the partitions, and
    each partition starts from the number of negatives before it. So no task
    sorts a class, and the AUC is not binned.
    """
    spark = df.sparkSession
    entries = [F.struct(F.lit(c).alias("class"), s.cast("double").alias("score"))
               for c, s in scores.items()]
    counted = (
        df.select(F.col(label).alias("label"), F.inline(F.array(*entries)))
        .groupBy("class", "score")
        .agg(F.count_if(F.col("label") == F.col("class")).alias("pos"), F.count("*").alias("n"))
        .withColumn("neg", F.col("n") - F.col("pos"))
    )
    slices = int(spark.conf.get("spark.sql.shuffle.partitions"))
    # Settled, because the slice a row falls into must be the same for both uses.
    ordered = settle(
        counted.repartitionByRange(slices, "class", "score").withColumn("slice", F.spark_partition_id())
    )
    before = Window.partitionBy("class").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        ordered.groupBy("class", "slice").agg(F.sum("neg").alias("_neg"))
        .select("class", "slice", F.coalesce(F.sum("_neg").over(before), F.lit(0)).alias("start"))
    )
    inside = Window.partitionBy("class", "slice").orderBy("score").rowsBetween(
        Window.unboundedPreceding, -1
    )
    below = F.col("start") + F.coalesce(F.col("_below"), F.lit(0)) + F.col("neg") / 2
    won = (
        ordered.withColumn("_below", F.sum("neg").over(inside))
        .join(starts, ["class", "slice"])
        .groupBy("class")
        .agg(F.sum(F.col("pos") * below).alias("_won"),
             F.sum("pos").alias("positives"), F.sum("neg").alias("negatives"))
    )
    pairs = F.col("positives").cast("double") * F.col("negatives").cast("double")
    return won.select(
        "class", "positives", "negatives", F.when(pairs > 0, F.col("_won") / pairs).alias("auc")
    )


def macro_auc(aucs: DataFrame) -> DataFrame:
    """The mean over the classes; null as soon as one class has no AUC."""
    return aucs.agg(
        F.when(F.count("auc") == F.count("*"), F.avg("auc")).alias("roc_auc_ovr")
    )


def stand_in_probabilities(classes: list[str]) -> dict[str, Column]:
    """Scores for a table that has only a prediction and its confidence: the rest is shared evenly."""
    rest = (F.lit(1.0) - F.col("confidence")) / F.lit(float(max(len(classes) - 1, 1)))
    return {c: F.when(F.col("prediction") == c, F.col("confidence")).otherwise(rest) for c in classes}


COMPARED = {
    "accuracy": "accuracy", "balanced_accuracy": "balanced_acc", "macro_precision": "macro_precision",
    "macro_recall": "macro_recall", "macro_f1": "macro_f1", "weighted_f1": "weighted_f1",
    "roc_auc_ovr": "roc_auc_ovr", "attack_detection_rate": "detection_rate",
    "false_alarm_rate": "false_alarm_rate",
}


def comparison_table(results: dict[str, DataFrame]) -> DataFrame:
    """One row per model with rounded metrics, best macro F1 first."""
    rows = []
    for model, result in results.items():
        def shown(metric: str) -> Column:
            given = F.col(metric) if metric in result.columns else F.lit(None).cast("double")
            return F.bround(given, 4).alias(COMPARED[metric])
        rows.append(result.select(F.lit(model).alias("model"), *[shown(m) for m in COMPARED],
                                  F.col("false_negatives")))
    return reduce(DataFrame.unionByName, rows).orderBy(F.desc("macro_f1"), "model")


# Metrics of which less is better.
LOWER_IS_BETTER = {"false_alarm_rate", "false_negatives", "false_positives"}


def best_model(results: DataFrame, metric: str = "macro_f1", order: str = "position") -> DataFrame:
    """The row with the best metric; a missing metric comes last, among equals the first by ``order``."""
    best = F.asc_nulls_last(metric) if metric in LOWER_IS_BETTER else F.desc_nulls_last(metric)
    return results.orderBy(best, order).limit(1)
