"""Cleaning, order statistics, sampling, preprocessing, evaluation and reports on small tables."""

import math

import numpy as np
import pandas as pd
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from wireglean.operators import cleaning, evaluation, order_statistics, preprocessing, reports, sampling
from wireglean.operators.features import feature_columns


def messy(spark):
    rows = [
        (f"id{i}", "BENIGN" if i % 2 else "DDoS", str(i // 2) if i % 20 else "bad", "Infinity" if i % 10 == 0 else str(i // 2),
         None, 5.0, "tcp" if i % 3 else "udp", math.inf if i % 7 == 0 else float(i // 2))
        for i in range(200)
    ]
    rows += [("x", None, "1", "1", None, 5.0, "tcp", 1.0), ("y", "Rare Thing", "1", "1", None, 5.0, "tcp", 1.0)]
    return spark.createDataFrame(rows, "flow_id string, label string, a string, b string, empty string, "
                                       "fixed double, protocol string, c double")


def test_clean_reports_what_it_did(spark):
    table, report = cleaning.clean(messy(spark), least=10)
    assert report.rows_in == 202 and report.null_label_rows_removed == 1
    assert report.infinite_values_replaced == 20 + 29
    assert report.leakage_columns_dropped == ["flow_id"]
    assert report.all_null_columns_dropped == ["empty"]
    assert report.constant_columns_dropped == ["fixed"]
    assert report.rare_classes_dropped == {"Other": 1}
    assert report.rows_out == table.count() == sum(report.class_counts.values())
    types = dict(table.dtypes)
    assert types["a"] == "double" and types["b"] == "double" and types["protocol"] == "string"
    assert table.where(F.abs("c") == math.inf).count() == 0
    assert report.to_frame(spark).first()["rows_out"] == report.rows_out


def test_copies_that_differ_only_in_identifiers_are_dropped(spark):
    rows = [(f"id{i}", float(i % 60), "BENIGN") for i in range(180)]
    _, report = cleaning.clean(spark.createDataFrame(rows, "flow_id string, v double, label string"))
    assert report.duplicates_removed == 120 and report.rows_out == 60


def test_text_below_the_share_stays_text_unless_the_file_reader_would_type_it(spark):
    rows = [(str(i) if i % 2 else None, "BENIGN") for i in range(100)]
    table = spark.createDataFrame(rows, "half string, label string")
    assert cleaning.profile(table).types == {"half": False}
    assert cleaning.profile(table, untyped_text=True).types == {"half": True}


def test_rare_limit_is_strict(spark):
    rows = [(float(i), "BENIGN") for i in range(50)] + [(float(i), "Bot") for i in range(49)]
    _, report = cleaning.clean(spark.createDataFrame(rows, "v double, label string"))
    assert report.class_counts == {"BENIGN": 50} and report.rare_classes_dropped == {"Botnet": 49}


SHARES = [0.0, 0.05, 0.25, 0.5, 0.95, 1.0]


@settings(max_examples=8, derandomize=True, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.one_of(
    st.floats(allow_nan=False, allow_infinity=False), st.sampled_from([0.0, -0.0, 1.0, 1e300, -1e300, 5e-324])),
    min_size=1, max_size=60))
def test_quantiles_by_narrowing_are_exact(spark, values):
    before = order_statistics.LEAF_ROWS
    order_statistics.LEAF_ROWS = 2  # so that the passes really narrow
    try:
        table = spark.createDataFrame([(float(v),) for v in values], "v double")
        ranks = list(range(len(values)))
        got = order_statistics.order_statistics(table, ["v"], {("", "v"): ranks})
    finally:
        order_statistics.LEAF_ROWS = before
    assert [got[("", "v", r)][0] for r in ranks] == sorted(values)


def test_quantiles_agree_with_numpy_for_a_hot_group(spark, monkeypatch):
    rng = np.random.default_rng(3)
    n = 20_000
    pdf = pd.DataFrame({"g": rng.choice(["a", "b"], n, p=[0.9, 0.1]),
                        "x": np.exp(rng.normal(0, 6, n)) * rng.choice([-1, 1], n),
                        "y": np.where(rng.random(n) < 0.4, 7.0, rng.integers(0, 50, n))})
    pdf.loc[::11, "x"] = np.nan
    table = spark.createDataFrame(pdf)
    monkeypatch.setattr(order_statistics, "LEAF_ROWS", 50)
    got = order_statistics.quantiles(table, ["x", "y"], SHARES, by="g")
    monkeypatch.undo()  # in one pass over the distinct values
    direct = order_statistics.quantiles(table, ["x", "y"], SHARES, by="g")
    for (g, c), values in got.items():
        column = pdf[pdf.g == g][c].dropna()
        assert values == pytest.approx(list(np.percentile(column, [100 * s for s in SHARES])))
        assert values == pytest.approx(direct[(g, c)])


def test_split_sizes_are_exact_and_parts_disjoint(spark):
    table = spark.range(5000).select(F.expr("if(id % 10 < 8, 'a', if(id % 10 = 8, 'b', 'c'))").alias("label"), "id")
    counts = sampling.class_counts(table)
    sizes = sampling.split_sizes(counts, 0.2, 0.2)
    assert [sum(s[i] for s in sizes.values()) for i in range(3)] == [3200, 800, 1000]
    split = sampling.stratified_split(table)
    got = {(r["label"], r["split"]): r["count"] for r in split.groupBy("label", "split").count().collect()}
    assert got == {(c, p): n for c, ns in sizes.items() for p, n in zip(sampling.PARTS, ns)}
    assert split.select("id").distinct().count() == 5000
    again = sampling.stratified_split(table.repartition(3))
    assert split.exceptAll(again).isEmpty()


def test_split_is_exact_among_copies_of_one_row(spark, monkeypatch):
    monkeypatch.setattr(sampling, "COPY_CHUNK", 7)
    table = spark.range(900).select(F.lit("a").alias("label"), F.expr("if(id < 600, 0, id)").alias("v"))
    split = sampling.stratified_split(table)
    assert {r["split"]: r["count"] for r in split.groupBy("split").count().collect()} == {
        "train": 576, "validation": 144, "test": 180}
    assert split.where("v = 0").count() == 600


def test_cap_folds_weights_and_sample(spark):
    table = spark.range(1000).select(F.expr("if(id < 900, 'a', 'b')").alias("label"), "id")
    capped = sampling.capped_classes(table, cap=150)
    assert sampling.class_counts(capped) == {"a": 150, "b": 100}
    assert sampling.capped_classes(table, cap=None) is table
    with pytest.raises(ValueError):
        sampling.capped_classes(table, cap=0)
    folds = sampling.with_folds(table).groupBy("fold").count().collect()
    assert sorted(r["count"] for r in folds) == [333, 333, 334]
    weights = {r["label"]: r["weight"] for r in sampling.balanced_weights(table).select("label", "weight").distinct().collect()}
    assert weights == {"a": pytest.approx(1000 / 1800), "b": pytest.approx(5.0)}
    assert sampling.hash_sample(table, 77).count() == 77


def test_preprocessor_rules(spark):
    rows = [(float(v), 80.0, "tcp" if v < 10 else "udp", None if v == 0 else float(v)) for v in range(2000)]
    rows = [(1.0 if r[0] > 1 else r[0], *r[1:]) for r in rows] + [(3.0, 80.0, "quic", 1.0)]
    table = spark.createDataFrame(rows, "total_fwd_packets double, destination_port double, protocol string, flow_iat_std double")
    model = preprocessing.fit_preprocessor(table, ["destination_port", "protocol", "total_fwd_packets", "flow_iat_std"])
    assert model.scales["total_fwd_packets"] == 1.0  # zero range: the deviation is kept
    assert model.rare["protocol"] == ["quic"]
    got = model.transform(table)
    names = model.feature_names()
    sample = {r["protocol"]: r["features"] for r in got.select("protocol", "features").dropDuplicates(["protocol"]).collect()}
    assert sample["quic"][names.index("protocol_infrequent")] == 1.0
    assert sample["quic"][names.index("total_fwd_packets")] == 2.0
    unseen = model.transform(spark.createDataFrame([(47.0,)], "protocol double")).first()["features"]
    assert [unseen[i] for i, n in enumerate(names) if n.startswith("protocol_")] == [0.0] * 3
    assert all(math.isfinite(x) for x in unseen)


def test_feature_vectors_are_finite_and_equal_in_width(spark, clean_table, flows):
    model = preprocessing.fit_preprocessor(clean_table, feature_columns(clean_table))
    widths = {len(r["features"]) for r in model.transform(flows).select("features").collect()}
    assert widths == {len(model.feature_names())}


def brute_auc(positive, negative):
    wins = [(p > q) + 0.5 * (p == q) for p in positive for q in negative]
    return sum(wins) / len(wins)


def test_auc_is_exact_with_ties_and_a_hot_score(spark):
    rng = np.random.default_rng(5)
    pdf = pd.DataFrame({"label": rng.choice(["a", "b", "c"], 600, p=[0.6, 0.3, 0.1])})
    for c in "abc":
        noise = np.round(rng.random(600), 2) + (pdf.label == c) * 0.2
        pdf[c] = np.where(rng.random(600) < 0.35, 0.5, noise)
    aucs = evaluation.class_auc(spark.createDataFrame(pdf), {c: F.col(c) for c in "abc"})
    for r in aucs.collect():
        hit = pdf.label == r["class"]
        assert r["auc"] == pytest.approx(brute_auc(pdf[hit][r["class"]], pdf[~hit][r["class"]]))
    assert evaluation.macro_auc(aucs).first()[0] == pytest.approx(np.mean([r["auc"] for r in aucs.collect()]))


def test_auc_is_null_when_a_class_is_absent(spark):
    table = spark.createDataFrame([("a", 0.9, 0.1), ("a", 0.4, 0.6)], "label string, a double, b double")
    aucs = evaluation.class_auc(table, {c: F.col(c) for c in "ab"})
    assert evaluation.macro_auc(aucs).first()[0] is None


def test_metrics_with_empty_classes(spark):
    rows = [("BENIGN", "BENIGN")] * 8 + [("BENIGN", "DoS")] * 2 + [("DoS", "DoS")] * 3 + [("DoS", "BENIGN")]
    table = spark.createDataFrame(rows, "label string, prediction string")
    m = evaluation.evaluate(table, ["BENIGN", "Botnet", "DoS"]).first()
    assert m["accuracy"] == pytest.approx(11 / 14)
    assert m["balanced_accuracy"] == pytest.approx((0.8 + 0.75) / 2)
    assert m["macro_recall"] == pytest.approx((0.8 + 0.75) / 3)
    assert (m["true_positives"], m["false_negatives"], m["false_positives"], m["true_negatives"]) == (3, 1, 2, 8)
    assert m["attack_detection_rate"] == pytest.approx(0.75) and m["false_alarm_rate"] == pytest.approx(0.2)


def test_comparison_is_sorted_and_first_wins_a_tie(spark):
    rows = [("x", 0, 0.5), ("y", 1, 0.9), ("z", 2, 0.9)]
    best = evaluation.best_model(spark.createDataFrame(rows, "model string, position int, macro_f1 double"))
    assert best.first()["model"] == "y"


def test_timeline_fills_gaps_and_drops_bad_times(spark):
    rows = [("2024-01-01 00:05:00", "BENIGN"), ("2024-01-01 02:10:00", "DoS"), ("never", "DoS"), (None, "DoS")]
    got = reports.timeline(spark.createDataFrame(rows, "timestamp string, prediction string")).orderBy("bucket").collect()
    assert [(r["total"], r["malicious"], r["benign"]) for r in got] == [
        (1, 0, 1), (0, 0, 0), (0, 0, 0), (0, 0, 0), (1, 1, 0)]


def test_correlations_agree_with_pandas(spark):
    rng = np.random.default_rng(9)
    pdf = pd.DataFrame(rng.normal(1e6, 1, (500, 4)), columns=list("abcd"))
    pdf["d"] = pdf["a"] * 2 + rng.normal(0, 0.1, 500)
    pdf["e"] = 3.0
    pdf.loc[::5, "b"] = np.nan
    want = pdf.corr()
    for r in reports.correlations(spark.createDataFrame(pdf).repartition(5)).collect():
        w = want.loc[r["feature_a"], r["feature_b"]]
        assert (r["correlation"] is None and np.isnan(w)) or r["correlation"] == pytest.approx(w, abs=1e-8)


def test_column_profile(spark):
    table = spark.createDataFrame([(1.0, "a"), (math.nan, "a"), (None, None)], "x double, t string")
    got = {r["column"]: r for r in reports.column_profile(table).collect()}
    assert (got["x"]["missing"], got["x"]["distinct_values"]) == (2, 1)
    assert (got["t"]["missing"], got["t"]["distinct_values"], got["t"]["missing_pct"]) == (1, 1, 33.33)


def test_rows_without_label_are_refused_where_classes_are_dealt(spark):
    table = spark.createDataFrame([("a", 1), ("a", 2), (None, 3)], "label string, x int")
    for deal in (sampling.stratified_split, sampling.with_folds, sampling.balanced_weights,
                 lambda df: sampling.capped_classes(df, cap=1)):
        with pytest.raises(ValueError, match="1 rows have no"):
            deal(table)


def test_an_empty_part_has_no_shares(spark):
    table = spark.createDataFrame([], "label string, prediction string")
    row = evaluation.evaluate(table, ["a", "BENIGN"]).first()
    assert row["accuracy"] is None and row["weighted_f1"] is None and row["macro_f1"] == 0.0


def test_the_best_model_has_the_least_alarms(spark):
    table = spark.createDataFrame([(0, "x", 0.2, None), (1, "y", 0.1, 0.4), (2, "z", None, 0.3)],
                                  "position int, model string, false_alarm_rate double, roc_auc_ovr double")
    assert evaluation.best_model(table, "false_alarm_rate").first()["model"] == "y"
    assert evaluation.best_model(table, "roc_auc_ovr").first()["model"] == "y"
