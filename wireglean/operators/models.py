"""The three candidate classifiers and how their outputs become class probabilities."""

from dataclasses import dataclass, field

import numpy as np
from pyspark.ml import PipelineModel
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wireglean import taxonomy as tax
from wireglean.functions.numbers import texts
from wireglean.operators import forest
from wireglean.operators.boosting import Booster, fit_boosting
from wireglean.operators.explanation import TreeNodes
from wireglean.operators.forest import GrownForest
from wireglean.operators.logistic import fit_logistic
from wireglean.session import run_folder

LOGISTIC, FOREST, BOOSTING = "LogisticRegression", "RandomForest", "Boosting"
CANDIDATES = [LOGISTIC, FOREST, BOOSTING]
Classifier = PipelineModel | Booster | GrownForest


@dataclass
class ModelSettings:
    """Sizes of the candidates; the defaults are the full training settings."""

    candidates: list[str] = field(default_factory=lambda: list(CANDIDATES))
    logistic_iterations: int = 1000
    forest_trees: int = 200
    forest_depth: int = 30  # the deepest MLlib grows
    boosting_rounds: int = 300
    boosting_depth: int = 8
    boosting_rate: float = 0.1
    boosting_share: float = 0.8
    boosting_rows: int = 200_000  # the rows that boosting learns from, at most
    detector_trees: int = 200
    seed: int = tax.SEED


def _fit_forest(train: DataFrame, classes: int, settings: ModelSettings) -> PipelineModel | GrownForest:
    if train.count() <= forest.MOST_ROWS:
        return forest.fit_grown_forest(train, classes, settings.forest_trees, settings.forest_depth, 2, settings.seed)
    model = RandomForestClassifier(
        featuresCol="features", labelCol="label_index", weightCol="weight", seed=settings.seed,
        numTrees=settings.forest_trees, maxDepth=settings.forest_depth, minInstancesPerNode=2,
        featureSubsetStrategy="sqrt", maxMemoryInMB=1024,
        # Rows remember their node, so a deep level does not walk every tree from its root.
        cacheNodeIds=True, checkpointInterval=10,
    ).fit(train)
    return _pipeline(model)


def _pipeline(stage) -> PipelineModel:
    # Own output names; what is not used is not computed.
    stage.setFeaturesCol("features").setPredictionCol("").setRawPredictionCol("").setProbabilityCol("_probability")
    return PipelineModel([stage])


def fit_candidate(name: str, train: DataFrame, settings: ModelSettings) -> Classifier:
    """Fit one candidate on (features, label_index, weight)."""
    if name == LOGISTIC:
        return _pipeline(fit_logistic(train, settings.logistic_iterations))
    if name not in CANDIDATES:
        raise KeyError(name)
    classes = int(train.agg(F.max("label_index")).first()[0] or 0) + 1
    if name == FOREST:
        return _fit_forest(train, classes, settings)
    return fit_boosting(train, classes, settings.boosting_rounds, settings.boosting_depth, settings.boosting_rate,
                        settings.boosting_share, settings.boosting_rows, settings.seed)


def _probabilities(model: Classifier, name: str, classes: int) -> Column:
    if name != BOOSTING:
        return F.col("_probability") if isinstance(model, GrownForest) else vector_to_array("_probability")
    # Classes that training had no row of have no booster, and no chance.
    odds = F.transform("_margins", lambda m: 1.0 / (1.0 + F.exp(-m)))
    total = F.aggregate(odds, F.lit(0.0), lambda a, b: a + b)
    shares = F.transform(odds, lambda p: p / total)
    return F.transform(F.sequence(F.lit(0), F.lit(classes - 1)), lambda i: F.coalesce(F.get(shares, i), F.lit(0.0)))


def save_classifier(model: Classifier, spark, path: str) -> None:
    if isinstance(model, (Booster, GrownForest)):
        model.table(spark).write.mode("overwrite").parquet(path)
    else:
        model.write().overwrite().save(path)


def load_classifier(name: str, spark, path: str) -> Classifier:
    if name == LOGISTIC or name == FOREST and not _is_grown(spark, path):
        return PipelineModel.load(path)
    return (Booster if name == BOOSTING else GrownForest).from_table(spark.read.parquet(path))


def _is_grown(spark, path: str) -> bool:
    """Whether a saved forest is a table of trees; MLlib's has a folder of stages."""
    stages = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path, "stages")
    return not stages.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(stages)


def classified(df: DataFrame, model: Classifier, name: str, classes: list[str]) -> DataFrame:
    """Add ``probabilities`` (in class order), ``confidence`` and ``prediction``."""
    scored = model.transform(df).withColumn("probabilities", _probabilities(model, name, len(classes)))
    scored = scored.withColumn("confidence", F.array_max("probabilities"))
    winner = F.expr(f"element_at(array({texts(classes)}), int(array_position(probabilities, confidence)))")
    return scored.withColumn("prediction", winner).drop("_probability", "_margins")


def importances(model: Classifier, name: str, width: int) -> list[float]:
    """Global importance per feature: mean absolute coefficient, mean split importance, or share of splits."""
    if isinstance(model, (Booster, GrownForest)):
        return model.importances(width).tolist()
    if name == LOGISTIC:
        return abs(model.stages[0].coefficientMatrix.toArray()).mean(axis=0).tolist()
    parts = [stage.featureImportances.toArray() for stage in model.stages]
    return (sum(parts[1:], parts[0]) / len(parts)).tolist()


def tree_nodes(model: Classifier, name: str, classes: int, spark) -> TreeNodes:
    """The split nodes of a forest or booster; MLlib's forest is read from its saved form.

    Their number follows from the settings of the model (trees times nodes of a tree), as does the
    model's own size on the driver.
    """
    if isinstance(model, (Booster, GrownForest)):
        return TreeNodes(model.trees(), classes)
    folder = run_folder(spark, "model-nodes")
    model.write().save(folder)
    trees = []
    for i, stage in enumerate(model.stages):
        data = spark.read.parquet(f"{folder}/stages/{i}_{stage.uid}/data")
        rows = data.select(
            "treeID", "nodeData.id", "nodeData.prediction", "nodeData.impurityStats",
            "nodeData.leftChild", "nodeData.rightChild", F.col("nodeData.split.featureIndex").alias("feature"),
            F.get("nodeData.split.leftCategoriesOrThreshold", F.lit(0)).alias("threshold"),
        ).toPandas()
        for _, nodes in rows.groupby("treeID"):
            nodes = nodes.sort_values("id")
            value = np.stack(nodes["impurityStats"].to_numpy())
            value = value / np.maximum(value.sum(axis=1, keepdims=True), 1e-300)
            trees.append({
                "feature": nodes["feature"].to_numpy(), "threshold": nodes["threshold"].fillna(0.0).to_numpy(),
                "left": nodes["leftChild"].to_numpy(), "right": nodes["rightChild"].to_numpy(),
                "value": value, "weight": 1.0 / stage.getNumTrees, "only": None,
            })
    return TreeNodes(trees, classes)
