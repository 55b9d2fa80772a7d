"""Training: split, weigh, fit the candidates, select on validation, open the test part once."""

import json
import time
from dataclasses import dataclass, field
from datetime import datetime, timezone

import pyspark
from pyspark import StorageLevel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wireglean import __version__
from wireglean import taxonomy as tax
from wireglean.functions.numbers import texts
from wireglean.operators import anomaly, evaluation, models, sampling
from wireglean.operators.features import feature_columns
from wireglean.operators.models import ModelSettings
from wireglean.operators.preprocessing import Preprocessor, fit_preprocessor
from wireglean.session import settle


@dataclass
class Bundle:
    """Everything needed to repeat a prediction, saved and loaded as one."""

    name: str
    classes: list[str]
    preprocessor: Preprocessor
    model: models.Classifier
    training_rows: int
    version: str = __version__
    trained_at: str = ""
    metrics: dict = field(default_factory=dict)
    detector: anomaly.Detector | None = None
    candidates: dict = field(default_factory=dict)  # all fitted models by name; not saved

    def facts(self) -> dict:
        names = self.preprocessor.feature_names()
        return {
            "model_name": self.name, "model_version": self.version, "trained_at": self.trained_at,
            "training_rows": self.training_rows, "supported_classes": self.classes,
            "feature_count": len(self.preprocessor.raw_columns),
            "raw_features": self.preprocessor.raw_columns,
            "transformed_feature_count": len(names), "metrics": self.metrics,
            "environment": {"pyspark": pyspark.__version__},
        }

    def model_info(self, spark: SparkSession) -> DataFrame:
        """One row about the model and its detector."""
        facts = self.facts() | {"anomaly_detector_loaded": self.detector is not None,
                                "anomaly_detector": self.detector.facts() if self.detector else None}
        return json_table(spark, facts)

    def save(self, spark: SparkSession, path: str) -> None:
        """One folder: the classifier, the detector's trees, and the parameters as JSON."""
        models.save_classifier(self.model, spark, f"{path}/classifier")
        document = self.facts() | {"preprocessor": self.preprocessor.to_dict()}
        if self.detector:
            self.detector.forest.table(spark).coalesce(1).write.mode("overwrite").parquet(f"{path}/detector")
            document["detector"] = self.detector.facts()
        rows = spark.createDataFrame([(json.dumps(document),)], "value string")
        rows.coalesce(1).write.mode("overwrite").text(f"{path}/bundle")

    @staticmethod
    def load(spark: SparkSession, path: str) -> "Bundle":
        document = json.loads(spark.read.text(f"{path}/bundle").first()["value"])
        detector = None
        if "detector" in document:
            d = document["detector"]
            forest = anomaly.Forest.from_table(spark.read.parquet(f"{path}/detector"), d["subsample"])
            detector = anomaly.Detector(forest, d["low"], d["high"], d["threshold"], d["contamination"],
                                        d["trained_on_rows"])
        return Bundle(
            document["model_name"], document["supported_classes"], Preprocessor(**document["preprocessor"]),
            models.load_classifier(document["model_name"], spark, f"{path}/classifier"), document["training_rows"], document["model_version"],
            document["trained_at"], document["metrics"], detector,
        )


def json_table(spark: SparkSession, document: dict) -> DataFrame:
    """A nested document as a table of one row."""
    text = json.dumps(document)
    rows = spark.createDataFrame([(text,)], "value string")
    return rows.select(F.from_json("value", F.schema_of_json(F.lit(text))).alias("d")).select("d.*")


ROWS_PER_PARTITION = 20_000


def spread(rows: DataFrame, n: int) -> DataFrame:
    """Partitions for fitting, by content: one for each ``ROWS_PER_PARTITION`` rows.

    An iteration is one short task per partition, so few rows want few. Neither the number nor the
    rows of a partition depend on the cluster, and so neither do the draws that fits make per partition.
    """
    return rows.repartition(max(1, n // ROWS_PER_PARTITION), F.xxhash64(*rows.columns)).sortWithinPartitions(
        F.xxhash64(F.lit(1), *rows.columns))


def matrix(rows: DataFrame, preprocessor: Preprocessor, classes: list[str], keep: list[str]) -> DataFrame:
    """(features, label_index and the kept columns) for fitting and evaluation."""
    index = F.expr(f"CAST(array_position(array({texts(classes)}), label) - 1 AS DOUBLE)")
    table = preprocessor.transform(rows, keep=keep).withColumn("label_index", index)
    return table.select("features", "label_index", *keep)


def measured(scored: DataFrame, classes: list[str]) -> dict:
    """All metrics of a table with label, prediction and probabilities, as a document."""
    scored = scored.select("label", "prediction", "probabilities").persist(StorageLevel.MEMORY_AND_DISK)
    cells = evaluation.confusion_cells(scored, classes=classes).collect()  # one per pair of classes
    spark = scored.sparkSession
    table = spark.createDataFrame([tuple(c) for c in cells], "label string, prediction string, n bigint")
    found = evaluation.metrics(evaluation.per_class(table)).first().asDict()
    scores = {c: F.col("probabilities")[i] for i, c in enumerate(classes)}
    found["roc_auc_ovr"] = evaluation.macro_auc(evaluation.class_auc(scored, scores)).first()[0]
    found["per_class"] = {
        r["class"]: {k: r[k] for k in ("precision", "recall", "f1", "support")}
        for r in evaluation.per_class(table).collect()
    }
    counts = {(c["label"], c["prediction"]): c["n"] for c in cells}
    found["labels"] = classes
    found["confusion_matrix"] = [[counts[(a, p)] for p in classes] for a in classes]
    scored.unpersist()
    return found


def cross_validated(train: DataFrame, name: str, classes: list[str], raw_columns: list[str],
                    settings: ModelSettings, folds: int = tax.FOLDS) -> dict:
    """Macro F1 over stratified folds; the preprocessor is fitted anew on each fold's own rows."""
    return cross_validation(settle(sampling.with_folds(train, folds=folds, seed=settings.seed)), [name], classes,
                            raw_columns, settings, folds)[name]


def cross_validation(parts: DataFrame, names: list[str], classes: list[str], raw_columns: list[str],
                     settings: ModelSettings, folds: int = tax.FOLDS) -> dict[str, dict]:
    """:func:`cross_validated` for several candidates on rows that have a ``fold``; one preprocessor a fold."""
    scores: dict[str, list[float]] = {name: [] for name in names}
    for fold in range(folds):
        inside = parts.where(F.col("fold") != fold).drop("fold")
        outside = parts.where(F.col("fold") == fold).drop("fold")
        preprocessor = fit_preprocessor(inside, raw_columns)
        weighted = sampling.balanced_weights(inside)
        rows = spread(matrix(weighted, preprocessor, classes, ["label", "weight"]), inside.count()).persist(
            StorageLevel.MEMORY_AND_DISK)
        held_out = matrix(outside, preprocessor, classes, ["label"])
        for name in names:
            model = models.fit_candidate(name, rows, settings)
            scored = models.classified(held_out, model, name, classes)
            scores[name].append(evaluation.evaluate(scored, classes).first()["macro_f1"])
        rows.unpersist()
    found = {}
    for name, values in scores.items():
        mean = sum(values) / folds
        found[name] = {"mean_macro_f1": mean, "std_macro_f1": (sum((v - mean) ** 2 for v in values) / folds) ** 0.5,
                       "fold_macro_f1": values}
    return found


def train(clean: DataFrame, settings: ModelSettings | None = None, core_only: bool = True,
          cap: int | None = tax.CLASS_CAP, cross_validate: bool = False, with_detector: bool = True,
          selection_metric: str = "macro_f1") -> tuple[Bundle, dict]:
    """Train, compare and select; returns the winner's bundle and the training report.

    The split is settled once, for its three readers. The training part is capped per
    class, so the rows every fit iterates over stay bounded whatever the table holds
    (``cap=None`` lifts that).
    """
    settings = settings or ModelSettings()
    started = time.perf_counter()
    parts = settle(sampling.stratified_split(clean, seed=settings.seed))
    part = {p: parts.where(F.col("split") == p).drop("split") for p in sampling.PARTS}
    counts = sampling.class_counts(parts)
    classes = sorted(counts)
    # The cap bounds the rows that the classifiers iterate over; the preprocessor and the detector
    # are fitted on the whole training part.
    train_rows = sampling.capped_classes(part["train"], cap=cap, seed=settings.seed)
    if cap is not None:
        train_rows = settle(train_rows)
    raw_columns = feature_columns(train_rows, core_only)
    if not raw_columns:
        raise ValueError("no feature columns in the table")
    preprocessor = fit_preprocessor(part["train"], raw_columns)

    weighted = sampling.balanced_weights(train_rows)
    kept_rows = train_rows.count()
    rows = spread(matrix(weighted, preprocessor, classes, ["label", "weight"]), kept_rows).persist(
        StorageLevel.MEMORY_AND_DISK)
    validation = matrix(part["validation"], preprocessor, classes, ["label"]).persist(
        StorageLevel.MEMORY_AND_DISK)
    training_rows = rows.count()

    fitted, results, seconds, failures, folds = {}, {}, {}, {}, {}
    for name in settings.candidates:
        began = time.perf_counter()
        try:
            fitted[name] = models.fit_candidate(name, rows, settings)
        except Exception as error:  # the other candidates go on
            failures[name] = str(error).splitlines()[0][:500]
            continue
        seconds[name] = round(time.perf_counter() - began, 2)
        results[name] = measured(models.classified(validation, fitted[name], name, classes), classes)
    if not fitted:
        raise RuntimeError(f"every candidate failed: {failures}")
    if cross_validate:
        folds = cross_validation(settle(sampling.with_folds(train_rows, seed=settings.seed)), list(fitted), classes,
                                 raw_columns, settings)

    ranked = [(i, name, results[name][selection_metric]) for i, name in enumerate(fitted)]
    best = evaluation.best_model(
        clean.sparkSession.createDataFrame(ranked, f"position int, model string, {selection_metric} double"),
        selection_metric).first()["model"]
    test = matrix(part["test"], preprocessor, classes, ["label"])
    test_result = measured(models.classified(test, fitted[best], best, classes), classes)

    bundle = Bundle(
        best, classes, preprocessor, fitted[best], training_rows,
        trained_at=datetime.now(timezone.utc).isoformat(timespec="seconds"),
        metrics={"validation": results[best], "test": test_result}, candidates=fitted,
    )
    spark = clean.sparkSession
    compared = evaluation.comparison_table({n: json_table(spark, r) for n, r in results.items()})
    report = {
        "generated_at": bundle.trained_at, "selected_model": best, "selection_metric": selection_metric,
        "selection_split": "validation",
        "dataset": {
            "total_rows": sum(counts.values()), "train_rows": training_rows,
            "validation_rows": validation.count(),
            "test_rows": sum(sum(r) for r in test_result["confusion_matrix"]),
            "classes": classes, "class_distribution": counts,
        },
        "features": {"raw_count": len(raw_columns), "raw_columns": raw_columns,
                     "transformed_count": len(preprocessor.feature_names())},
        "training_seconds": seconds, "failures": failures, "cross_validation": folds,
        "validation_results": results, "test_result": test_result,
        "comparison_table": [r.asDict() for r in compared.collect()],
        "total_runtime_seconds": round(time.perf_counter() - started, 2),
    }
    if with_detector:
        vectors = matrix(part["train"], preprocessor, classes, ["label"]).select(
            "label", vector_to_array("features").alias("features_array"))
        bundle.detector = anomaly.fit_detector(vectors, trees=settings.detector_trees, seed=settings.seed)
        report["anomaly_detector"] = bundle.detector.facts()
    validation.unpersist()
    rows.unpersist()
    return bundle, report
