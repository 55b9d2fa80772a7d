"""Fits of the three candidates: right results in few jobs, and work that shrinks with the rows that are left."""

import numpy as np
import pytest
from pyspark.ml.linalg import Vectors

from wireglean.operators import binning, boosting, explanation, forest, models
from wireglean.operators.models import ModelSettings


def table(spark, x, label, weight):
    rows = [(Vectors.dense(r), float(c), float(w)) for r, c, w in zip(x, label, weight)]
    return spark.createDataFrame(rows, ["features", "label_index", "weight"]).repartition(3).persist()


def jobs_of(spark, name, work):
    spark.sparkContext.setJobGroup(name, name)
    try:
        found = work()
        return found, len(spark.sparkContext.statusTracker().getJobIdsForGroup(name))
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


@pytest.fixture(scope="module")
def rows(spark):
    rng = np.random.default_rng(5)
    x = rng.normal(size=(1500, 4)) * [1, 3, 0.2, 1]
    x[:4, 1] = [900, -4000, 25000, 70]  # rates have far outliers
    label = (x @ rng.normal(size=(4, 3)) + rng.gumbel(size=(1500, 3))).argmax(axis=1)
    weight = rng.uniform(0.5, 2.0, 1500)
    yield x, label, weight, (made := table(spark, x, label, weight))
    made.unpersist()


def test_logistic_loss_is_the_least_in_few_jobs(spark, rows):
    x, label, weight, made = rows
    model, jobs = jobs_of(spark, "logistic", lambda: models.fit_candidate(models.LOGISTIC, made, ModelSettings()))
    stage = model.stages[0]
    w, b = stage.coefficientMatrix.toArray(), stage.interceptVector.toArray()

    def loss(w, b):
        z = x @ w.T + b
        z -= z.max(axis=1, keepdims=True)
        each = np.log(np.exp(z).sum(axis=1)) - z[np.arange(len(x)), label]
        return (weight @ each + 0.5 * (w * w).sum()) / weight.sum()

    from pyspark.ml.classification import LogisticRegression
    exact = LogisticRegression(
        featuresCol="features", labelCol="label_index", weightCol="weight", family="multinomial", regParam=1 / weight.sum(),
        elasticNetParam=0.0, standardization=False, maxIter=1000, tol=1e-10).fit(made)
    least = loss(exact.coefficientMatrix.toArray(), exact.interceptVector.toArray())
    assert loss(w, b) <= least * (1 + 1e-4)
    assert jobs < 120  # two stages of a pass at most; a fit by gradients alone took hundreds


def test_sums_of_many_tasks_are_added_by_tasks(spark, rows, monkeypatch):
    from wireglean.operators import logistic
    _, _, _, made = rows
    one = logistic.fit_logistic(made, 50)
    monkeypatch.setattr(logistic, "MOST_PARTS", 1)
    two = logistic.fit_logistic(made, 50)
    assert np.allclose(one.coefficientMatrix.toArray(), two.coefficientMatrix.toArray())


def test_forest_is_grown_in_tasks(spark):
    rng = np.random.default_rng(6)
    x = rng.normal(size=(1200, 5))
    label = 2 * ((x[:, 0] > 0) ^ (x[:, 1] > 0)) + (x[:, 2] > 1)
    made = table(spark, x, label, np.ones(1200))
    settings = ModelSettings(forest_trees=24, forest_depth=12)
    flat = ModelSettings(forest_trees=24, forest_depth=2)
    _, few = jobs_of(spark, "flat forest", lambda: models.fit_candidate(models.FOREST, made, flat))
    model, jobs = jobs_of(spark, "forest", lambda: models.fit_candidate(models.FOREST, made, settings))
    assert jobs <= few  # none a level
    classes = list("abcd")
    scored = models.classified(made, model, models.FOREST, classes).select("features", "label_index", "prediction", "probabilities")
    found = scored.collect()
    assert np.mean([classes.index(r["prediction"]) == r["label_index"] for r in found]) > 0.95
    assert all(sum(r["probabilities"]) == pytest.approx(1.0, abs=1e-12) for r in found)
    again = models.fit_candidate(models.FOREST, made.repartition(7), settings)  # whatever order rows come in
    assert all(np.array_equal(a, b) for s, t in zip(model.grown, again.grown) for a, b in zip(s, t))
    shares = model.importances(5)
    assert shares.sum() == pytest.approx(1.0) and shares[:3].min() > shares[3:].max()
    # Roots and contributions lead to the probabilities.
    nodes = models.tree_nodes(model, models.FOREST, 4, spark)
    walk = explanation._path_contributions(nodes.trees, 5)
    matrix = np.array([r["features"].toArray() for r in found])
    target = np.array([classes.index(r["prediction"]) for r in found])
    start = sum(t["value"][0] * t["weight"] for t in nodes.trees)
    reached = walk(matrix, target).sum(axis=1) + start[target]
    assert np.allclose(reached, [max(r["probabilities"]) for r in found], atol=1e-6)


def test_a_forest_of_one_class_is_leaves(spark):
    made = table(spark, np.ones((30, 3)), np.zeros(30), np.ones(30))
    model = models.fit_candidate(models.FOREST, made, ModelSettings(forest_trees=3))
    assert all(len(tree[0]) == 1 for tree in model.grown)
    assert models.classified(made, model, models.FOREST, ["a"]).first()["probabilities"] == [1.0]
    assert model.importances(3).tolist() == [0, 0, 0]


def test_best_splits_are_those_of_brute_force():
    rng = np.random.default_rng(7)
    n, classes = 400, 3
    bins = rng.integers(0, binning.BINS, (n, 6)).astype(np.uint8)
    of, place = rng.integers(0, classes, n), rng.integers(0, 4, n)
    weight, count = rng.uniform(0.5, 2, n), rng.integers(1, 4, n).astype(float)
    features = np.array([[0, 3], [1, 2], [5, 4], [2, 0]])
    gain, slot, at, _ = forest._best_splits(bins, np.arange(n), place, features, of, weight, count, 4, classes, 2)

    def impurity(rows):
        share = np.bincount(of[rows], weights=weight[rows], minlength=classes) / weight[rows].sum()
        return 1 - (share ** 2).sum()

    for node in range(4):
        rows = np.flatnonzero(place == node)
        best = 0.0
        for f in features[node]:
            for cut in range(binning.BINS - 1):
                left, right = rows[bins[rows, f] <= cut], rows[bins[rows, f] > cut]
                if min(count[left].sum(), count[right].sum()) >= 2:
                    parts = sum(weight[p].sum() * impurity(p) for p in (left, right)) / weight[rows].sum()
                    best = max(best, impurity(rows) - parts)
        assert gain[node] == pytest.approx(best, abs=1e-12)


def test_boosting_reads_half_of_the_rows_a_level(monkeypatch):
    rng = np.random.default_rng(8)
    n = 3000
    bins = rng.integers(0, binning.BINS, (6, n)).astype(np.uint8)
    hit = (bins[0] > 15) ^ (bins[1] > 9) ^ (rng.random(n) < 0.2)
    read, tables = [], boosting._tables

    def counted(*args):
        read.append(len(args[2]))
        return tables(*args)

    monkeypatch.setattr(boosting, "_tables", counted)
    inside = np.flatnonzero(rng.random(n) < 0.8)
    gradient, hessian = 0.5 - hit, np.full(n, 0.25)
    feature, cut, sums, node = boosting._grow(bins, inside, gradient, hessian, np.arange(6), 5)
    assert read[0] == len(inside) and len(read) > 3 and max(read[1:]) <= len(inside) / 2
    # Every node holds the sums of the rows that a walk brings there.
    for row in range(0, n, 50):
        at = 0
        while feature[at] >= 0:
            at = 2 * at + 1 + (bins[feature[at], row] > cut[at])
        assert node[row] == at
    for leaf in np.unique(node[inside]):
        mine = inside[node[inside] == leaf]
        assert np.allclose(sums[leaf], [gradient[mine].sum(), hessian[mine].sum()])


def test_trees_are_fitted_once(spark):
    """An ordered query of the fitted trees computed them twice."""
    grown = spark.sparkContext.accumulator(0)

    def fit(batches):
        for batch in batches:
            grown.add(len(batch))
            batch["tree"] = batch["id"].astype("int32")
            batch["class"] = 0
            for name in ("feature", "threshold", "value"):
                batch[name] = [[-1]] * len(batch)
            yield batch[["class", "tree", "feature", "threshold", "value"]]

    fitted = spark.range(0, 6, 1, 6).mapInPandas(fit, boosting._TABLE)
    assert boosting.Booster.from_table(fitted).feature.shape == (1, 6, 1)
    assert grown.value == 6


def test_complete_trees_give_the_same_values():
    rng = np.random.default_rng(9)
    feature = rng.integers(-1, 5, (2, 6, 15)).astype(np.int32)
    for node in range(7):
        for child in (2 * node + 1, 2 * node + 2):
            feature[:, :, child][feature[:, :, node] < 0] = -1
    feature[:, :, 7:] = -1
    threshold, value = rng.normal(size=feature.shape), rng.normal(size=feature.shape)
    whole = boosting.Booster(feature, threshold, value)._complete()
    for x in rng.normal(size=(40, 5)):
        for c in range(2):
            for t in range(6):
                at, end = 0, 0
                while feature[c, t, at] >= 0:
                    at = 2 * at + 1 + (x[feature[c, t, at]] > threshold[c, t, at])
                for _ in range(whole[3][c, t]):
                    end = 2 * end + 1 + (x[whole[0][c, t, end]] > whole[1][c, t, end])
                assert value[c, t, at] == whole[2][c, t, end]
