"""Trained models at their full sizes: training, selection, detector, scoring and explanations on the whole tables.

What a trained model says has no SQL. What must hold for every row whatever it says has:
sizes of parts and folds, probabilities that sum to 1, risks that follow from their parts, contributions
that add up to the score, and results better than always saying BENIGN.
"""

from dataclasses import replace

from pyspark.ml.functions import vector_to_array
from pyspark.sql import Window
from pyspark.sql import functions as F

from wireglean import taxonomy as tax
from wireglean.operators import explanation, models, sampling, scoring
from wireglean.operators.features import feature_columns
from wireglean.operators.models import ModelSettings
from wireglean.plans import oracle as O
from wireglean.plans import training
from wireglean.plans.catalog import query
from wireglean.plans.fixtures import raw_flows
from wireglean.plans.queries_cleaning import _SPLIT, clean_rows
from wireglean.plans.scoring_job import INPUT, Scorer
from wireglean.session import run_folder

_trained: dict = {}


def everything(spark, sf_dir):
    """The winner's bundle, with all fitted candidates, and the report; trained once per session."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _trained:
        _trained[key] = training.train(clean_rows(spark, sf_dir), ModelSettings())
    return _trained[key]


def with_model(spark, sf_dir, name):
    bundle = everything(spark, sf_dir)[0]
    return replace(bundle, name=name, model=bundle.candidates[name])


def bad(condition):
    """Rows that break a rule; a comparison that gives null breaks it too."""
    return F.count_if(~F.coalesce(condition, F.lit(False)))


def _summed(column):
    return F.aggregate(column, F.lit(0.0), lambda a, b: a + b)



def _candidate(query_name, name):
    @query(query_name, O.DISTINCT + """SELECT label, n, CAST(0 AS BIGINT) AS bad_sums, CAST(0 AS BIGINT) AS bad_confidences,
      CAST(0 AS BIGINT) AS bad_predictions, true AS better_than_benign FROM class_sizes WHERE n >= 50""")
    def build(spark, sf_dir):
        bundle = with_model(spark, sf_dir, name)
        rows = training.matrix(clean_rows(spark, sf_dir), bundle.preprocessor, bundle.classes, ["label"])
        scored = models.classified(rows, bundle.model, name, bundle.classes)
        place = F.expr("array_position(probabilities, confidence)")
        found = scored.groupBy("label").agg(
            F.count("*").alias("n"), bad(F.abs(_summed("probabilities") - 1) < 1e-9).alias("bad_sums"),
            bad(F.col("confidence") == F.array_max("probabilities")).alias("bad_confidences"),
            bad(F.col("prediction") == F.element_at(F.array(*map(F.lit, bundle.classes)), place.cast("int"))).alias("bad_predictions"),
            F.count_if(F.col("prediction") == F.col("label")).alias("hits"))
        every = Window.partitionBy(F.lit(0))  # one row a class
        benign = F.sum(F.when(F.col("label") == tax.BENIGN, F.col("n"))).over(every)
        return found.withColumn("better_than_benign", F.sum("hits").over(every) > benign).drop("hits")


_candidate("f1_logistic_regression", models.LOGISTIC)
_candidate("f2_random_forest", models.FOREST)
_candidate("f3_boosting", models.BOOSTING)


@query("f4_all_candidates", _SPLIT + """SELECT unnest(['LogisticRegression', 'RandomForest', 'Boosting']) AS model,
  true AS fitted, CAST(sum(m - n_train) AS BIGINT) AS validation_rows, true AS timed FROM sd""")
def f4(spark, sf_dir):
    report = everything(spark, sf_dir)[1]
    rows = [(n, n in report["validation_results"], sum(map(sum, report["validation_results"][n]["confusion_matrix"])),
             report["training_seconds"][n] > 0) for n in models.CANDIDATES]
    return spark.createDataFrame(rows, "model string, fitted boolean, validation_rows bigint, timed boolean")


@query("f5_cross_validation", O.DISTINCT + """, ok AS (SELECT label, n, sum(n) OVER (ORDER BY label) AS stop
    FROM class_sizes WHERE n >= 50),
  places AS (SELECT unnest(range(CAST(stop - n AS BIGINT), CAST(stop AS BIGINT))) AS place FROM ok)
  SELECT place % 3 AS fold, count(*) AS n, true AS scored, true AS mean_of_folds, true AS better_than_benign
  FROM places GROUP BY 1""")
def f5(spark, sf_dir):
    table = clean_rows(spark, sf_dir)
    classes = sorted(sampling.class_counts(table))
    parts = training.settle(sampling.with_folds(table))
    found = training.cross_validation(parts, [models.LOGISTIC], classes, feature_columns(table), ModelSettings())[models.LOGISTIC]
    scores = found["fold_macro_f1"]
    # Always saying BENIGN has an F1 of at most 1 in one class and 0 in the others.
    facts = [(fold, 0 <= score <= 1, abs(sum(scores) / len(scores) - found["mean_macro_f1"]) < 1e-12,
              score > 1 / len(classes)) for fold, score in enumerate(scores)]
    shown = spark.createDataFrame(facts, "fold bigint, scored boolean, mean_of_folds boolean, better_than_benign boolean")
    return parts.groupBy(F.col("fold").cast("bigint").alias("fold")).agg(F.count("*").alias("n")).join(shown, "fold")


@query("f7_test_of_winner", _SPLIT + "SELECT label, CAST(n - m AS BIGINT) AS n, true AS better_than_benign FROM sd")
def f7(spark, sf_dir):
    found = everything(spark, sf_dir)[1]["test_result"]
    benign = found["per_class"][tax.BENIGN]["support"]
    hits = sum(row[i] for i, row in enumerate(found["confusion_matrix"]))
    rows = [(label, sum(row), hits > benign) for label, row in zip(found["labels"], found["confusion_matrix"])]
    return spark.createDataFrame(rows, "label string, n bigint, better_than_benign boolean")


@query("f8_saved_and_loaded", O.FLOWS + "SELECT count(*) AS rows, CAST(0 AS BIGINT) AS changed_rows FROM raw_flows")
def f8(spark, sf_dir):
    """Rows whose score changes when the bundle goes through storage: none may."""
    bundle, _ = everything(spark, sf_dir)
    folder = run_folder(spark, "bundle")
    bundle.save(spark, folder)
    flows = raw_flows(spark, sf_dir)
    columns = ["flow_id", "prediction", "confidence", "anomaly_score", "risk_score"]
    both = Scorer(bundle).append(flows).select(*columns, F.lit(1).alias("side")).unionByName(
        Scorer(training.Bundle.load(spark, folder)).append(flows).select(*columns, F.lit(-1).alias("side")))
    per_row = both.groupBy(*columns).agg(F.sum("side").alias("over"), F.count_if(F.col("side") == 1).alias("n"))
    return per_row.agg(F.sum("n").alias("rows"), F.sum(F.abs("over")).alias("changed_rows"))


@query("f9_training_report", _SPLIT + """SELECT CAST(sum(n) AS BIGINT) AS total_rows, CAST(sum(n_train) AS BIGINT) AS train_rows,
  CAST(sum(m - n_train) AS BIGINT) AS validation_rows, CAST(sum(n - m) AS BIGINT) AS test_rows, count(*) AS classes,
  true AS selected_is_best, CAST(3 AS BIGINT) AS compared FROM sd""")
def f9(spark, sf_dir):
    report = everything(spark, sf_dir)[1]
    best = max(r["macro_f1"] for r in report["validation_results"].values())
    return training.json_table(spark, report).select(
        "dataset.total_rows", "dataset.train_rows", "dataset.validation_rows", "dataset.test_rows",
        F.size("dataset.classes").cast("bigint").alias("classes"),
        F.lit(report["validation_results"][report["selected_model"]]["macro_f1"] == best).alias("selected_is_best"),
        F.size("comparison_table").cast("bigint").alias("compared"))


@query("g1_isolation_forest", _SPLIT + """SELECT unnest(range(200)) AS tree, least(256, CAST(n_train AS BIGINT)) AS subsample,
  true AS grown FROM sd WHERE label = 'BENIGN'""")
def g1(spark, sf_dir):
    """Every tree: the subsample it grew from, and no more splits than that allows."""
    forest = everything(spark, sf_dir)[0].detector.forest
    splits = F.size(F.filter("feature", lambda f: f >= 0))
    return forest.table(spark).select(F.col("tree").cast("bigint").alias("tree"),
                                      F.lit(forest.subsample).cast("bigint").alias("subsample"),
                                      splits.between(1, forest.subsample - 1).alias("grown"))


@query("g2_anomaly_scores", O.FLOWS + """SELECT label, count(*) AS n, CAST(0 AS BIGINT) AS out_of_range,
  CAST(0 AS BIGINT) AS misplaced FROM raw_flows GROUP BY label""")
def g2(spark, sf_dir):
    """Scores lie between 0 and 1, and a flagged flow is odder than the least odd one that is not."""
    scored = Scorer(everything(spark, sf_dir)[0]).score(raw_flows(spark, sf_dir)).select(
        F.col(f"{INPUT}.label").alias("label"), "anomaly_score", "is_anomaly")
    line = scored.agg(F.min(F.when(F.col("is_anomaly"), F.col("anomaly_score"))).alias("line")).first()["line"]
    return scored.groupBy("label").agg(
        F.count("*").alias("n"), bad(F.col("anomaly_score").between(0, 1)).alias("out_of_range"),
        bad(F.col("is_anomaly") | (F.col("anomaly_score") <= F.lit(1.0 if line is None else line))).alias("misplaced"))


@query("i1_scored_flows", O.FLOWS + """SELECT flow_id, true AS sums_to_one, true AS confidence_is_largest, true AS risk_in_bounds,
  true AS level_follows, true AS malicious_follows, true AS risk_follows FROM raw_flows""")
def i1(spark, sf_dir):
    scored = Scorer(everything(spark, sf_dir)[0]).score(raw_flows(spark, sf_dir))
    part = F.col("risk_components")
    blend = (0.45 * part["class_severity"] + 0.25 * part["model_confidence"] + 0.20 * part["anomaly"]
             + 0.10 * part["traffic_characteristics"])
    blend = blend * F.when((F.col("prediction") == "BENIGN") & ~F.col("is_anomaly"), 0.5).otherwise(1.0)
    blend = F.when(F.col("is_anomaly"), F.greatest(blend, F.lit(45.0))).otherwise(blend)
    risk = F.col("risk_score")
    level = F.when(risk <= 30, "LOW").when(risk <= 60, "MEDIUM").when(risk <= 80, "HIGH").otherwise("CRITICAL")
    return scored.select(
        f"{INPUT}.flow_id", (F.abs(_summed("probabilities") - 1) < 1e-9).alias("sums_to_one"),
        (F.col("confidence") == F.array_max("probabilities")).alias("confidence_is_largest"),
        risk.between(0, 100).alias("risk_in_bounds"), (F.col("risk_level") == level).alias("level_follows"),
        (F.col("is_malicious") == (F.col("prediction") != "BENIGN")).alias("malicious_follows"),
        # Shown components may be rounded to two digits.
        (F.abs(risk - blend) <= 0.51).alias("risk_follows"))


@query("i1_scored_summary", O.FLOWS + """SELECT count(*) AS total_records, true AS parts_add_up, true AS rates_follow
  FROM raw_flows""")
def i1_summary(spark, sf_dir):
    found = scoring.summary(Scorer(everything(spark, sf_dir)[0]).score(raw_flows(spark, sf_dir)))
    total = F.col("total_records")
    levels = F.aggregate(F.map_values("risk_distribution"), F.lit(0).cast("bigint"), lambda a, b: a + b)
    attacks = F.aggregate(F.map_values("attack_distribution"), F.lit(0).cast("bigint"), lambda a, b: a + b)
    return found.select(
        "total_records", ((F.col("benign_records") + F.col("malicious_records") == total) & (levels == total)
                          & (attacks == total)).alias("parts_add_up"),
        (F.abs(F.col("attack_rate") - F.col("malicious_records") / total) <= 0.0001).alias("rates_follow"))


@query("i5_model_information", _SPLIT + """SELECT CAST(sum(n_train) AS BIGINT) AS training_rows, count(*) AS classes,
  true AS known_model, true AS detector_loaded FROM sd""")
def i5(spark, sf_dir):
    info = everything(spark, sf_dir)[0].model_info(spark)
    return info.select("training_rows", F.size("supported_classes").cast("bigint").alias("classes"),
                       F.col("model_name").isin(models.CANDIDATES).alias("known_model"),
                       F.col("anomaly_detector_loaded").alias("detector_loaded"))


def _attributed(spark, sf_dir, name):
    """Scored flows with the place of their class and the features as an array."""
    bundle = with_model(spark, sf_dir, name)
    scored = Scorer(bundle, use_detector=False).score(raw_flows(spark, sf_dir))
    place = F.array_position(F.array(*map(F.lit, bundle.classes)), F.col("prediction")).cast("int") - 1
    return bundle, scored.withColumn("_class", place)


_ADDS_UP = O.FLOWS + "SELECT count(*) AS rows, CAST(0 AS BIGINT) AS not_adding_up FROM raw_flows"


@query("k1_tree_attribution", _ADDS_UP)
def k1_tree(spark, sf_dir):
    """Path contributions lead from the trees' common starting point to the probability of the class."""
    bundle, scored = _attributed(spark, sf_dir, models.FOREST)
    nodes = models.tree_nodes(bundle.model, bundle.name, len(bundle.classes), spark)
    start = sum(tree["value"][0] * tree["weight"] for tree in nodes.trees).tolist()
    found = explanation.tree_contributions(scored, nodes, len(bundle.preprocessor.feature_names()), features="features_array")
    reached = _summed("contributions") + F.get(F.array(*map(F.lit, start)), F.col("_class"))
    return found.agg(F.count("*").alias("rows"), bad(F.abs(reached - F.col("confidence")) < 1e-6).alias("not_adding_up"))


@query("k1_boosting_attribution", _ADDS_UP)
def k1_boosting(spark, sf_dir):
    """The same for boosting, whose trees add up to the log odds of the class against all others."""
    bundle, scored = _attributed(spark, sf_dir, models.BOOSTING)
    nodes = models.tree_nodes(bundle.model, bundle.name, len(bundle.classes), spark)
    start = [0.0] * len(bundle.classes)
    for tree in nodes.trees:
        start[tree["only"]] += float(tree["value"][0, 0])
    rows = bundle.model.transform(scored)
    found = explanation.tree_contributions(rows, nodes, len(bundle.preprocessor.feature_names()), features="features_array")
    reached = _summed("contributions") + F.get(F.array(*map(F.lit, start)), F.col("_class"))
    return found.agg(F.count("*").alias("rows"),
                     bad(F.abs(reached - F.get("_margins", F.col("_class"))) < 1e-6).alias("not_adding_up"))


@query("k1_trained_linear_attribution", _ADDS_UP)
def k1_linear(spark, sf_dir):
    """Contributions and intercepts of two classes differ by the log of their odds."""
    bundle, scored = _attributed(spark, sf_dir, models.LOGISTIC)
    stage = bundle.model.stages[0]
    coefficients, intercepts = stage.coefficientMatrix.toArray(), stage.interceptVector.toArray().tolist()
    x = vector_to_array("features")
    margin = lambda place: _summed(explanation.linear_contributions(x, place, coefficients)) + F.get(
        F.array(*map(F.lit, intercepts)), place)
    second = F.when(F.col("_class") == 0, 1).otherwise(0)
    rows = scored.withColumns({"_one": margin(F.col("_class")), "_two": margin(second), "_p": F.get("probabilities", second)})
    # Beyond this a probability has too few digits for its logarithm.
    odds = F.log(F.col("confidence") / F.col("_p"))
    holds = F.when(F.col("_p") < 1e-12, F.col("_one") - F.col("_two") > 20).otherwise(
        F.abs(F.col("_one") - F.col("_two") - odds) < 1e-3)
    return rows.agg(F.count("*").alias("rows"), bad(holds).alias("not_adding_up"))


@query("k2_global_importance", "SELECT CAST(unnest(range(1, 21)) AS INTEGER) AS rank, true AS named, true AS in_order")
def k2(spark, sf_dir):
    found = Scorer(everything(spark, sf_dir)[0]).global_importance(spark)
    before = F.lag("importance").over(Window.orderBy("rank"))  # twenty rows
    return found.select("rank", (F.length("display_name") > 0).alias("named"),
                        ((F.col("importance") >= 0) & F.coalesce(F.col("importance") <= before, F.lit(True))).alias("in_order"))


@query("k3_global_explanation", O.FLOWS + """SELECT 'global_importance' AS direction, CAST(5 AS BIGINT) AS features,
  5 * count(*) AS n FROM raw_flows""")
def k3(spark, sf_dir):
    """The fallback: the same importances on every row, marked as such."""
    bundle = everything(spark, sf_dir)[0]
    names = bundle.preprocessor.feature_names()
    found = explanation.global_explanation(names, models.importances(bundle.model, bundle.name, len(names)))
    rows = raw_flows(spark, sf_dir).select("flow_id", F.inline(found))
    return rows.groupBy("direction").agg(F.count_distinct("feature").alias("features"), F.count("*").alias("n"))
