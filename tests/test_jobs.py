"""Files, trained models and streams, end to end."""

import math

import numpy as np
import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from wireglean import taxonomy as tax
from wireglean.operators import anomaly, cleaning, features, models, scoring
from wireglean.operators.models import ModelSettings
from wireglean.plans import training
from wireglean.plans.fixtures import with_stand_in_prediction
from wireglean.plans.scoring_job import Scorer
from wireglean.sources import capture_ranges, csv_flows, tables
from wireglean.streaming import live


# --- files -------------------------------------------------------------------


@pytest.fixture
def captures(tmp_path):
    (tmp_path / "sub").mkdir()
    (tmp_path / "a.csv").write_text(
        " Flow ID, Destination Port,Fwd Header Length,Fwd Header Length,Flow Bytes/s, Label\n"
        "1, 80,5,6,Infinity,BENIGN\n2,443,5\n3,22,1,2,3,DDoS,extra\n4,22,1,\"2,5\",NaN,Bot\n\n5,,1,2,,\"x,y\"\n")
    (tmp_path / "sub" / "b b+c.csv").write_bytes(b"Flow ID,Label,New\n9,Web Attack \x96 XSS,1\n10,NA,2\n")
    (tmp_path / "notes.txt").write_text("Flow ID\n77\n")
    return str(tmp_path)


def test_captures_are_read_whole(spark, captures):
    got = {r["flow_id"]: r for r in csv_flows.load_captures(spark, captures).collect()}
    assert sorted(got) == ["1", "10", "2", "4", "5", "9"]
    assert got["1"]["fwd_header_length_1"] == "6" and got["1"]["source_file"] == "a.csv"
    assert got["2"]["label"] is None and got["4"]["fwd_header_length_1"] == "2,5"
    assert got["5"]["label"] == "x,y" and got["5"]["destination_port"] is None
    assert got["9"]["source_file"] == "b b+c.csv" and got["10"]["label"] is None
    assert got["9"]["label"] == "Web Attack � XSS"


def test_few_columns_do_not_bring_long_lines_back(spark, captures):
    read = csv_flows.load_captures(spark, captures)
    assert read.count() == 6 and read.select("label").count() == 6
    assert sorted(r[0] for r in cleaning.labelled_rows(read).select("label").collect()) == [
        "BENIGN", "Botnet", "Other", "WebAttack"]


def test_rows_per_file_follow_the_file(spark, tmp_path):
    for name, n in (("big", 5000), ("small", 3)):
        (tmp_path / f"{name}.csv").write_text("Flow ID\n" + "".join(f"{i}\n" for i in range(n)))
    size = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")  # several blocks per file
    try:
        got = csv_flows.load_captures(spark, str(tmp_path), rows_per_file=1700).collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)
    big = sorted(int(r["flow_id"]) for r in got if r["source_file"] == "big.csv")
    assert big == list(range(1700)) and len(got) == 1703


def test_quotes_inside_cells_are_kept(spark, tmp_path):
    (tmp_path / "q.csv").write_text('Flow ID,Note,Label\n1,"a ""q, r"" b",BENIGN\n2,"x,""y""",Bot,extra\n3,plain,Bot\n')
    got = {r["flow_id"]: (r["note"], r["label"]) for r in csv_flows.load_captures(spark, str(tmp_path)).collect()}
    assert got == {"1": ('a "q, r" b', "BENIGN"), "3": ("plain", "Bot")}
    (tmp_path / "m").mkdir()
    (tmp_path / "m" / "q.csv").write_text('Flow ID,Note,Label\n1,"two\nlines",BENIGN\n')
    row = csv_flows.load_captures(spark, str(tmp_path / "m"), multi_line=True).first()
    assert (row["note"], row["label"]) == ("two\nlines", "BENIGN")


@pytest.mark.parametrize("size", [64, 100, 333, 5000])
def test_ranges_cut_through_quoted_cells(spark, tmp_path, size):
    rng = np.random.default_rng(size)
    parts = ["a", "é", "\n", "\r\n", '""', ",", " ", "x" * 90]
    rows = [[str(i), "".join(rng.choice(parts, rng.integers(0, 9)))] for i in range(300)]
    text = "Flow ID, Note\r\n" + "".join(f'{i},"{note}"\n' + "\n" * (int(i) % 7 == 0) for i, note in rows)
    (tmp_path / "q.csv").write_bytes(text.encode())
    (tmp_path / "plain.csv").write_bytes(b"Flow ID,Other\n900,1,2,3\n901\n902,NA")
    (tmp_path / "stray.csv").write_bytes(b'Note,Flow ID\nodd " quote,903\nnext,904\n')
    (tmp_path / "blank.csv").write_bytes(b"\n \n")
    files = csv_flows.csv_files(spark, str(tmp_path))
    gone = spark.createDataFrame([(f"file:{tmp_path}/gone.csv", 500)], "path string, bytes long")
    probed = capture_ranges.probe(files.select("path", "bytes").unionByName(gone), size)
    reasons = {r["path"].rsplit("/", 1)[-1]: r["reason"] for r in capture_ranges.left_out(probed).collect()}
    assert set(reasons) == {"blank.csv", "gone.csv"} and reasons["blank.csv"] == "no header line"
    got = {r["flow_id"]: (r["note"], r["other"], r["source_file"]) for r in capture_ranges.read(probed, spark).collect()}
    wanted = {i: (note.replace('""', '"') or None, None, "q.csv") for i, note in rows}
    wanted |= {"901": (None, None, "plain.csv"), "902": (None, None, "plain.csv"), "903": ('odd " quote', None, "stray.csv"),
               "904": ("next", None, "stray.csv")}
    assert got == wanted


def test_a_csv_table_keeps_its_types(spark, tmp_path):
    table = spark.createDataFrame([(1, "007", 2.5, [1, 2], True), (2, None, None, None, False)],
                                  "n int, code string, x float, list array<int>, flag boolean")
    tables.write_scored_csv(table, str(tmp_path / "t.csv"))
    read = tables.read_clean(spark, str(tmp_path / "t.csv"))
    assert dict(read.dtypes) == dict(table.dtypes) | {"list": "string"}
    assert [r["code"] for r in read.orderBy("n").collect()] == ["007", None]
    (tmp_path / "other.csv").write_text("n,x\n1,2.5\n")
    assert tables.read_clean(spark, str(tmp_path / "other.csv")).dtypes == [("n", "int"), ("x", "double")]


def test_nothing_to_read_is_an_error(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        csv_flows.load_captures(spark, str(tmp_path / "none"))


def test_intake_limits(spark, tmp_path):
    path = tmp_path / "up.csv"
    path.write_text("Flow ID\n" + "".join(f"{i}\n" for i in range(20)))
    kept, facts = tables.read_upload(spark, str(path), max_rows=5)
    assert kept.count() == 5 and facts == {"rows_received": 20, "truncated": True}
    (tmp_path / "empty.csv").write_text("")
    (tmp_path / "header.csv").write_text("Flow ID\n")
    for bad in ("x.txt", "empty.csv", "header.csv"):
        with pytest.raises(tables.IntakeError):
            tables.read_upload(spark, str(tmp_path / bad))
    with pytest.raises(tables.IntakeError):
        tables.check_upload(spark, str(path), max_mb=1e-6)
    with pytest.raises(tables.IntakeError):
        tables.preview(kept, 5001)


def test_a_csv_capture_cleans_like_the_table(spark, flows, tmp_path):
    path = str(tmp_path / "raw")
    flows.write.option("header", True).csv(path)
    _, from_csv = cleaning.clean(csv_flows.load_captures(spark, path), untyped_text=True)
    _, from_table = cleaning.clean(flows)
    assert from_csv.rows_out == from_table.rows_out
    assert from_csv.class_counts == from_table.class_counts
    assert from_csv.constant_columns_dropped == from_table.constant_columns_dropped


# --- models ------------------------------------------------------------------


def test_training_report(trained, clean_table):
    bundle, report = trained
    n = clean_table.count()
    data = report["dataset"]
    assert data["train_rows"] + data["validation_rows"] + data["test_rows"] == n
    assert set(report["validation_results"]) == set(models.CANDIDATES) and not report["failures"]
    best = max(report["validation_results"].values(), key=lambda r: r["macro_f1"])
    assert report["validation_results"][bundle.name]["macro_f1"] == best["macro_f1"]
    assert report["test_result"]["accuracy"] > 0.6
    assert training.json_table(clean_table.sparkSession, report).count() == 1


def test_scores_are_consistent(trained, flows):
    bundle, _ = trained
    rows = Scorer(bundle).score(flows).select(
        "prediction", "confidence", "risk_score", "risk_level", "anomaly_score", "is_anomaly", "is_malicious",
        "class_probabilities").collect()
    assert len(rows) == flows.count()
    for r in rows:
        assert sum(r["class_probabilities"].values()) == pytest.approx(1.0, abs=0.01)
        assert r["class_probabilities"][r["prediction"]] == pytest.approx(r["confidence"], abs=1e-3)
        assert max(r["class_probabilities"].values()) == pytest.approx(r["confidence"], abs=1e-3)
        assert r["is_malicious"] == (r["prediction"] != tax.BENIGN)
        assert 0.0 <= r["anomaly_score"] <= 1.0 and 0 <= r["risk_score"] <= 100


def scores(table):
    return {r["kind"]: (r["prediction"], r["confidence"], r["risk_score"], r["anomaly_score"]) for r in table.collect()}


def test_batch_equals_single_rows(trained, example_flows):
    scorer = Scorer(trained[0])
    batch = scores(scorer.append(example_flows))
    for kind, expected in batch.items():
        assert scores(scorer.append(example_flows.where(F.col("kind") == kind))) == {kind: expected}


def test_partial_extra_and_empty_input(spark, trained):
    scorer = Scorer(trained[0])
    partial = spark.createDataFrame([(443, "x", "mine")], "`Destination Port` int, vendor string, prediction string")
    row = scorer.append(partial).first()
    assert row["prediction"] in trained[0].classes and row["input_prediction"] == "mine"
    assert row["Destination Port"] == 443
    assert scorer.append(partial.limit(0)).count() == 0


def test_saved_bundle_scores_the_same(spark, trained, example_flows, tmp_path):
    trained[0].save(spark, str(tmp_path / "v1"))
    loaded = training.Bundle.load(spark, str(tmp_path / "v1"))
    assert scores(Scorer(loaded).append(example_flows)) == scores(Scorer(trained[0]).append(example_flows))
    assert loaded.classes == trained[0].classes


def test_without_detector(trained, example_flows):
    rows = Scorer(trained[0], use_detector=False).append(example_flows).collect()
    assert all(r["anomaly_score"] == 0.0 and r["is_anomaly"] is False for r in rows)


def test_summary_adds_up(trained, flows):
    s = scoring.summary(Scorer(trained[0]).score(flows)).first()
    assert s["benign_records"] + s["malicious_records"] == s["total_records"] == flows.count()
    assert sum(s["risk_distribution"].values()) == s["total_records"]
    assert sum(s["attack_distribution"].values()) == s["total_records"]


def test_all_candidates_are_cross_validated(clean_table):
    settings = ModelSettings(logistic_iterations=5, forest_trees=2, forest_depth=3, boosting_rounds=2, boosting_depth=2,
                             detector_trees=3)
    _, report = training.train(clean_table, settings, cross_validate=True, with_detector=False,
                               selection_metric="false_alarm_rate")
    assert sorted(report["cross_validation"]) == sorted(models.CANDIDATES)
    for found in report["cross_validation"].values():
        assert len(found["fold_macro_f1"]) == tax.FOLDS and 0 <= found["mean_macro_f1"] <= 1
    alarms = {n: r["false_alarm_rate"] for n, r in report["validation_results"].items()}
    assert alarms[report["selected_model"]] == min(alarms.values())


def test_boosting_learns_what_a_line_cannot(spark):
    rng = np.random.default_rng(4)
    x = rng.normal(size=(900, 3))
    label = ((x[:, 0] > 0) ^ (x[:, 1] > 0)).astype(float)
    from pyspark.ml.linalg import Vectors
    table = spark.createDataFrame([(Vectors.dense(r), float(k), 1.0) for r, k in zip(x, label)],
                                  ["features", "label_index", "weight"])
    model = models.fit_candidate(models.BOOSTING, table, ModelSettings(boosting_rounds=30, boosting_depth=3))
    got = models.classified(table, model, models.BOOSTING, ["no", "yes"]).select("label_index", "prediction").collect()
    assert sum((r["prediction"] == "yes") == (r["label_index"] == 1) for r in got) > 0.95 * len(got)


def test_a_failing_candidate_is_skipped(clean_table):
    settings = ModelSettings(candidates=["NoSuchModel", models.FOREST], forest_trees=2, forest_depth=3)
    bundle, report = training.train(clean_table, settings, with_detector=False)
    assert bundle.name == models.FOREST and "NoSuchModel" in report["failures"]
    with pytest.raises(RuntimeError):
        training.train(clean_table, ModelSettings(candidates=["NoSuchModel"]), with_detector=False)


def test_attacks_are_odder_than_benign_flows(trained, flows):
    labelled = cleaning.labelled_rows(flows)
    scored = Scorer(trained[0]).score(labelled).select("input_row.label", "anomaly_score")
    mean = {r["label"]: r["m"] for r in scored.groupBy("label").agg(F.avg("anomaly_score").alias("m")).collect()}
    assert mean["DDoS"] > mean["BENIGN"] and mean["PortScan"] > mean["BENIGN"]


def test_forest_takes_small_and_equal_samples(spark):
    table = spark.range(3000).select(F.array(F.col("id").cast("double"), F.rand(1)).alias("x"), "id")
    forest = anomaly.fit_forest(table, "x", trees=7)
    assert forest.feature.shape == (7, 511) and forest.subsample == 256
    tiny = anomaly.fit_forest(table.limit(5), "x", trees=3)
    assert tiny.subsample == 5
    # An outlier is isolated early.
    far = spark.createDataFrame([([1500.0, 0.5],), ([90000.0, 0.5],)], "x array<double>")
    usual, odd = [r[0] for r in far.select(anomaly.raw_score(forest, F.col("x"))).collect()]
    assert odd < usual < 0
    again = anomaly.fit_forest(table.repartition(5), "x", trees=7)
    assert np.array_equal(forest.threshold, again.threshold)


@pytest.fixture(scope="module")
def singles(clean_table):
    """One bundle per candidate, to explain each kind of model."""
    small = dict(logistic_iterations=20, forest_trees=4, forest_depth=5, boosting_rounds=2, boosting_depth=3)
    return {name: training.train(clean_table, ModelSettings(candidates=[name], **small), with_detector=False)[0]
            for name in (models.LOGISTIC, models.FOREST)}


def test_linear_contributions_sum_to_the_margin(singles, example_flows):
    bundle = singles[models.LOGISTIC]
    width = len(bundle.preprocessor.feature_names())
    rows = Scorer(bundle).score(example_flows, explain=True, top=width).select(
        "prediction", "top_features", "features_array", "explanation").collect()
    model = bundle.model.stages[0]
    for r in rows:
        c = bundle.classes.index(r["prediction"])
        margin = float(np.dot(model.coefficientMatrix.toArray()[c], r["features_array"]))
        assert sum(t["contribution"] for t in r["top_features"]) == pytest.approx(margin, abs=1e-3)
        assert r["explanation"].startswith(f"Classified as {r['prediction']}, driven mainly by")


def test_path_contributions_sum_to_the_change_from_the_roots(spark, singles, example_flows):
    bundle = singles[models.FOREST]
    scorer = Scorer(bundle)
    width = len(bundle.preprocessor.feature_names())
    rows = scorer.score(example_flows, explain=True, top=width).select(
        "prediction", "top_features", "confidence", "explanation_method").collect()
    roots = np.mean([t["value"][0] for t in scorer._tree_nodes(spark).trees], axis=0)
    for r in rows:
        start = roots[bundle.classes.index(r["prediction"])]
        assert sum(t["contribution"] for t in r["top_features"]) == pytest.approx(r["confidence"] - start, abs=1e-3)
        assert r["explanation_method"] == "path_contribution"


def test_tree_chunks_give_the_same_sum(spark, singles, example_flows, monkeypatch):
    from wireglean.operators import explanation
    bundle = singles[models.FOREST]
    table = bundle.preprocessor.transform(example_flows).withColumn(
        "_x", vector_to_array("features")).withColumn("_class", F.lit(1))
    nodes = models.tree_nodes(bundle.model, bundle.name, len(bundle.classes), spark)
    width = len(bundle.preprocessor.feature_names())
    whole = [r[0] for r in explanation.tree_contributions(table, nodes, width).select("contributions").collect()]
    split = [r[0] for r in explanation.tree_contributions(table, nodes, width, limit=1).select("contributions").collect()]
    assert np.allclose(whole, split)


# --- streams -----------------------------------------------------------------


def staged(table):
    return scoring.with_risk(with_stand_in_prediction(features.with_derived_features(cleaning.labelled_rows(table))))


def test_stream_equals_batch_and_goes_on_after_a_restart(spark, flows, tmp_path):
    source, out, mark = (str(tmp_path / d) for d in ("in", "out", "mark"))
    columns = ["flow_id", "prediction", "risk_score", "risk_level"]
    halves = [flows.where("flow_id % 2 = 0"), flows.where("flow_id % 2 = 1")]
    for half in halves:  # the second half arrives after the first run has ended
        half.write.mode("append").parquet(source)
        stream = staged(live.flow_stream(spark, source, flows.schema, files_per_trigger=1)).select(*columns)
        live.append_to(stream, out, mark).awaitTermination()
    got, want = spark.read.parquet(out), staged(flows).select(*columns)
    assert got.exceptAll(want).isEmpty() and want.exceptAll(got).isEmpty()


def test_a_trained_model_scores_a_stream_as_it_scores_a_batch(spark, trained, flows, tmp_path):
    source, out, mark = (str(tmp_path / d) for d in ("in", "out", "mark"))
    flows.repartition(3).write.parquet(source)
    scorer = Scorer(trained[0])
    columns = ["flow_id", "prediction", "confidence", "anomaly_score", "risk_score"]
    stream = scorer.append(live.flow_stream(spark, source, flows.schema, files_per_trigger=1)).select(*columns)
    live.append_to(stream, out, mark).awaitTermination()
    got, want = spark.read.parquet(out), scorer.append(flows).select(*columns)
    assert got.exceptAll(want).isEmpty() and want.exceptAll(got).isEmpty()


def test_counters_and_recent_events_over_several_ticks(spark, flows, tmp_path):
    source = str(tmp_path / "in")
    flows.repartition(4).write.parquet(source)
    stream = staged(live.flow_stream(spark, source, flows.schema, files_per_trigger=1))
    counters, recent = live.LatestTable(str(tmp_path / "c")), live.LatestTable(str(tmp_path / "r"))
    live.keep_counters(stream, counters, str(tmp_path / "cm")).awaitTermination()
    live.keep_recent(stream.select("flow_id", "timestamp"), recent, str(tmp_path / "rm")).awaitTermination()
    batch = staged(flows)
    assert counters.read(spark).first()["analysed"] == batch.count()
    want = batch.orderBy(F.desc("timestamp"), F.desc("flow_id")).limit(live.RECENT).select("flow_id")
    assert sorted(r[0] for r in recent.read(spark).select("flow_id").collect()) == sorted(r[0] for r in want.collect())


def test_rows_behind_the_watermark_are_dropped(spark, tmp_path):
    source, out, mark = (str(tmp_path / d) for d in ("in", "out", "mark"))
    for rows in ([("2024-01-01 00:05:00", "DoS"), ("2024-01-01 06:00:00", "BENIGN")],
                 [("2024-01-01 00:10:00", "DoS"), ("2024-01-01 09:00:00", "BENIGN")]):
        table = spark.createDataFrame(rows, "t string, prediction string").select(
            F.col("t").cast("timestamp").alias("timestamp"), "prediction")
        table.coalesce(1).write.mode("append").parquet(source)
        counts = live.window_counts(live.flow_stream(spark, source, table.schema))
        live.append_to(counts, out, mark).awaitTermination()
    got = {r["bucket"].strftime("%H:%M"): r["total"] for r in spark.read.parquet(out).collect()}
    assert got == {"00:00": 1, "06:00": 1}


def test_anomaly_scale_without_span(spark):
    table = spark.createDataFrame([(-0.4,)], "raw double")
    assert table.select(anomaly.normalised(F.col("raw"), -0.4, -0.4)).first()[0] == 0.0
    assert math.isclose(table.select(anomaly.normalised(F.col("raw"), -0.8, -0.4)).first()[0], 0.0)


# --- the three jobs ------------------------------------------------------------


def test_prepare_train_score(spark, flows, tmp_path):
    from wireglean.plans import jobs
    raw, clean, bundle, out = (str(tmp_path / d) for d in ("raw", "clean", "bundle", "scored"))
    flows.write.option("header", True).csv(raw)
    (tmp_path / "raw" / "blank.csv").write_text("\n\n")
    found = jobs.prepare(spark, raw, clean, report=str(tmp_path / "cleaning"))
    left_out = tables.read_report(spark, str(tmp_path / "cleaning-left-out")).collect()
    assert [(r["path"].endswith("/blank.csv"), r["reason"]) for r in left_out] == [(True, "no header line")]
    assert found.rows_out == spark.read.parquet(clean).count()
    small = ModelSettings(candidates=[models.FOREST], forest_trees=3, forest_depth=4, detector_trees=5)
    document = jobs.train(spark, clean, bundle, report=str(tmp_path / "metrics"), cap=100, settings=small)
    assert document["dataset"]["train_rows"] < document["dataset"]["total_rows"] * 0.64
    assert tables.read_report(spark, str(tmp_path / "metrics")).first()["selected_model"] == models.FOREST
    flows.write.parquet(str(tmp_path / "new"))
    summary = jobs.score(spark, str(tmp_path / "new"), bundle, out).first()
    assert summary["total_records"] == flows.count() == spark.read.parquet(out).count()
    upload = tmp_path / "up.csv"
    upload.write_text("Destination Port,Total Fwd Packets\n443,5\n80,-3\nhttp,1\n22,9\n")
    answer = jobs.score_upload(spark, str(upload), bundle, str(tmp_path / "answer"), max_rows=3, preview_rows=2, explain=True)
    assert (answer["rows_received"], answer["truncated"], answer["rows_refused"]) == (4, True, 2)
    assert answer["summary"].first()["total_records"] == 1 and answer["preview"].count() == 1
    assert spark.read.parquet(str(tmp_path / "answer/scored")).first()["explanation"].startswith("Classified as")
    queries = jobs.stream(spark, str(tmp_path / "new"), bundle, str(tmp_path / "live"), every="1 second")
    for query in queries:
        query.processAllAvailable()
        query.stop()
    assert spark.read.parquet(str(tmp_path / "live/scored")).count() == flows.count()
    assert live.LatestTable(str(tmp_path / "live/counters")).read(spark).first()["analysed"] == flows.count()
    names = jobs.write_reports(spark, clean, out, str(tmp_path / "reports"))
    assert all(spark.read.parquet(str(tmp_path / "reports" / n)).columns for n in names) and len(names) >= 10
    spark.read.parquet(clean).drop("label").write.parquet(str(tmp_path / "bare"))
    with pytest.raises(KeyError):
        jobs.train(spark, str(tmp_path / "bare"), bundle)
