"""Risk, summaries, evaluation, explanation and reports on the stand-in prediction."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from wireglean import taxonomy as tax
from wireglean.functions import risk
from wireglean.operators import anomaly, evaluation, explanation, reports, scoring
from wireglean.operators.features import missing_core_features, with_derived_features
from wireglean.plans import oracle as O
from wireglean.plans.catalog import query, rounded
from wireglean.plans.fixtures import raw_flows
from wireglean.plans.queries_cleaning import clean_rows
from wireglean.plans.queries_rows import derived, predicted, scored

ALL_CLASSES = sorted([*tax.CLASSES, tax.OTHER])
_CLASS_LIST = ", ".join(f"'{c}'" for c in ALL_CLASSES)


@query("traffic_by_service", O.SCORED + """SELECT port_category, label, count(*) AS flows,
  count(*) FILTER (WHERE traffic_part > 0) AS suspicious, round(avg(traffic_part), 6) AS mean_points,
  max(traffic_part) AS max_points FROM scored GROUP BY ALL""")
def traffic_by_service(spark, sf_dir):
    """Flows that look malicious by their traffic alone, per service and family."""
    table = derived(spark, sf_dir)
    points = table.withColumns(risk.readings(table.columns)).withColumn("points", risk.traffic_points())
    return points.groupBy("port_category", "label").agg(
        F.count("*").alias("flows"), F.count_if(F.col("points") > 0).alias("suspicious"),
        F.round(F.avg("points"), 6).alias("mean_points"), F.max("points").alias("max_points"),
    )


def _part(name: str, column: str, component: str):
    @query(name, O.SCORED + f"SELECT flow_id, round({column}, 2) AS points FROM scored")
    def build(spark, sf_dir):
        return scored(spark, sf_dir).select("flow_id", F.round(F.col("risk_components")[component], 2).alias("points"))

    return build


_part("h1_severity", "severity_part", "class_severity")
_part("h2_confidence", "confidence_part", "model_confidence")
_part("h3_traffic", "traffic_part", "traffic_characteristics")
_part("h4_anomaly", "anomaly_part", "anomaly")


@query("h5_risk_score", O.SCORED + "SELECT flow_id, prediction, CAST(risk_score AS BIGINT) AS risk_score FROM scored")
def h5(spark, sf_dir):
    return rounded(scored(spark, sf_dir).select("flow_id", "prediction", "risk_score"))


@query("h6_risk_level", O.SCORED + "SELECT risk_level, count(*) AS n FROM scored GROUP BY risk_level")
def h6(spark, sf_dir):
    return scored(spark, sf_dir).groupBy("risk_level").agg(F.count("*").alias("n"))


@query("h7_indicators", O.SCORED + "SELECT flow_id, unnest(indicator_list) AS indicator FROM scored")
def h7(spark, sf_dir):
    return scored(spark, sf_dir).select("flow_id", F.explode("indicators").alias("indicator"))


_RESULT = """SELECT flow_id, prediction, round(confidence, 4) AS confidence, CAST(risk_score AS BIGINT) AS risk_score,
  risk_level, round(anomaly_score, 4) AS anomaly_score, is_anomaly, prediction <> 'BENIGN' AS is_malicious,
  array_to_string(indicator_list, '; ') AS indicators FROM scored"""


@query("h8_risk_table", O.SCORED + _RESULT)
def h8(spark, sf_dir):
    return rounded(scoring.result_table(scored(spark, sf_dir), keep=["flow_id"]))


@query("i2_appended_results", O.SCORED + _RESULT.replace(
    "SELECT flow_id,", "SELECT flow_id, label, destination_port, prediction AS input_prediction,"))
def i2(spark, sf_dir):
    return rounded(scoring.result_table(
        scored(spark, sf_dir), keep=["flow_id", "label", "destination_port", "prediction"]))


@query("i3_without_detector", O.SCORED + """SELECT flow_id, CAST(round_even((0.45::DOUBLE * severity_part
  + 0.25::DOUBLE * confidence_part + 0.10::DOUBLE * traffic_part)
  * CASE WHEN prediction = 'BENIGN' THEN 0.5::DOUBLE ELSE 1.0::DOUBLE END, 0) AS BIGINT) AS risk_score FROM scored""")
def i3(spark, sf_dir):
    bare = scoring.without_detector(predicted(spark, sf_dir))
    return rounded(scoring.with_risk(bare).select("flow_id", "risk_score"))


@query("i4_summary", O.SCORED + """SELECT count(*) AS total_records,
  count(*) FILTER (WHERE prediction = 'BENIGN') AS benign_records,
  count(*) FILTER (WHERE prediction <> 'BENIGN') AS malicious_records,
  round(count(*) FILTER (WHERE prediction <> 'BENIGN') / count(*), 4) AS attack_rate,
  count(*) FILTER (WHERE is_anomaly) AS anomalies_detected,
  count(*) FILTER (WHERE risk_level = 'CRITICAL') AS critical_threats,
  count(*) FILTER (WHERE risk_level = 'HIGH') AS high_threats,
  round(avg(risk_score), 2) AS mean_risk_score, CAST(max(risk_score) AS BIGINT) AS max_risk_score,
  round(avg(confidence), 4) AS mean_confidence,
  (SELECT string_agg(prediction || '=' || n, ',' ORDER BY prediction)
     FROM (SELECT prediction, count(*) AS n FROM scored GROUP BY ALL)) AS attacks,
  (SELECT string_agg(risk_level || '=' || n, ',' ORDER BY risk_level)
     FROM (SELECT risk_level, count(*) AS n FROM scored GROUP BY ALL)) AS levels FROM scored""")
def i4(spark, sf_dir):
    def listed(column):
        entries = F.array_sort(F.map_entries(column))
        return F.array_join(F.transform(entries, lambda e: F.concat(e["key"], F.lit("="), e["value"])), ",")

    found = scoring.summary(scored(spark, sf_dir))
    return rounded(found.withColumns({
        "attacks": listed("attack_distribution"), "levels": listed("risk_distribution"),
    }).drop("attack_distribution", "risk_distribution"))


# --- evaluation --------------------------------------------------------------

_CELLS = O.PREDICTED + f""", grid AS (
    SELECT a.c AS label, b.c AS prediction FROM (SELECT unnest([{_CLASS_LIST}]) AS c) a, (SELECT unnest([{_CLASS_LIST}]) AS c) b),
  seen AS (SELECT label, prediction, count(*) AS n FROM predicted GROUP BY ALL),
  cells AS (SELECT label, prediction, coalesce(n, 0) AS n FROM grid LEFT JOIN seen USING (label, prediction)),
  tallies AS (SELECT c AS class, (SELECT sum(n) FROM cells WHERE label = c AND prediction = c) AS tp,
      (SELECT sum(n) FROM cells WHERE label = c) AS support, (SELECT sum(n) FROM cells WHERE prediction = c) AS predicted_n
    FROM (SELECT unnest([{_CLASS_LIST}]) AS c)),
  pr AS (SELECT *, CASE WHEN predicted_n > 0 THEN tp / predicted_n ELSE 0.0 END AS prec,
      CASE WHEN support > 0 THEN tp / support ELSE 0.0 END AS rec FROM tallies),
  f1s AS (SELECT *, CASE WHEN prec + rec > 0 THEN 2 * prec * rec / (prec + rec) ELSE 0.0 END AS f1 FROM pr)
"""


@query("j1_metric_suite", _CELLS + """SELECT round(sum(tp) / sum(support), 6) AS accuracy,
  round(avg(rec) FILTER (WHERE support > 0), 6) AS balanced_accuracy,
  round(avg(prec), 6) AS macro_precision, round(avg(rec), 6) AS macro_recall, round(avg(f1), 6) AS macro_f1,
  round(sum(prec * support) / sum(support), 6) AS weighted_precision,
  round(sum(rec * support) / sum(support), 6) AS weighted_recall,
  round(sum(f1 * support) / sum(support), 6) AS weighted_f1 FROM f1s""")
def j1(spark, sf_dir):
    found = evaluation.evaluate(predicted(spark, sf_dir), ALL_CLASSES)
    return rounded(found.select(
        "accuracy", "balanced_accuracy", "macro_precision", "macro_recall", "macro_f1",
        "weighted_precision", "weighted_recall", "weighted_f1"))


@query("j2_confusion_cells", _CELLS + "SELECT label, prediction, CAST(n AS BIGINT) AS n FROM cells")
def j2(spark, sf_dir):
    return evaluation.confusion_cells(predicted(spark, sf_dir), classes=ALL_CLASSES)


@query("j2_confusion_matrix", _CELLS + "SELECT 'true_' || label AS actual, " + ", ".join(
    f"CAST(sum(n) FILTER (WHERE prediction = '{c}') AS BIGINT) AS \"pred_{c}\"" for c in ALL_CLASSES)
    + " FROM cells GROUP BY label")
def j2_wide(spark, sf_dir):
    return evaluation.confusion_matrix(predicted(spark, sf_dir), ALL_CLASSES)


def class_table(spark, sf_dir):
    return evaluation.per_class(evaluation.confusion_cells(predicted(spark, sf_dir), classes=ALL_CLASSES))


@query("j3_per_class", _CELLS + """SELECT class, round(prec, 6) AS precision, round(rec, 6) AS recall, round(f1, 6) AS f1,
  CAST(support AS BIGINT) AS support FROM f1s""")
def j3(spark, sf_dir):
    return rounded(class_table(spark, sf_dir).select("class", "precision", "recall", "f1", "support"))


@query("j4_security_view", O.PREDICTED + """, s AS (SELECT
    count(*) FILTER (WHERE label <> 'BENIGN' AND prediction <> 'BENIGN') AS true_positives,
    count(*) FILTER (WHERE label <> 'BENIGN' AND prediction = 'BENIGN') AS false_negatives,
    count(*) FILTER (WHERE label = 'BENIGN' AND prediction <> 'BENIGN') AS false_positives,
    count(*) FILTER (WHERE label = 'BENIGN' AND prediction = 'BENIGN') AS true_negatives FROM predicted)
  SELECT *, round(true_positives / greatest(true_positives + false_negatives, 1), 6) AS attack_detection_rate,
    round(false_positives / greatest(false_positives + true_negatives, 1), 6) AS false_alarm_rate FROM s""")
def j4(spark, sf_dir):
    return rounded(evaluation.security_view(evaluation.confusion_cells(predicted(spark, sf_dir))))


@query("j5_roc_auc", O.PREDICTED + f""", s AS (SELECT c AS class, label = c AS hit,
    CASE WHEN prediction = c THEN confidence ELSE (1 - confidence) / {float(len(ALL_CLASSES) - 1)}::DOUBLE END AS score
    FROM predicted, (SELECT unnest([{_CLASS_LIST}]) AS c)),
  ranked AS (SELECT *, rank() OVER (PARTITION BY class ORDER BY score)
    + (count(*) OVER (PARTITION BY class, score) - 1) / 2 AS r FROM s),
  sums AS (SELECT class, sum(r) FILTER (WHERE hit) AS total, count(*) FILTER (WHERE hit) AS pos,
    count(*) FILTER (WHERE NOT hit) AS neg FROM ranked GROUP BY class)
  SELECT class, pos AS positives, neg AS negatives,
    round((total - pos * (pos + 1) / 2) / (CAST(pos AS DOUBLE) * neg), 6) AS auc FROM sums""")
def j5(spark, sf_dir):
    table = predicted(spark, sf_dir)
    aucs = evaluation.class_auc(table, evaluation.stand_in_probabilities(ALL_CLASSES))
    return rounded(aucs)


def weaker(table):
    """A second opinion for comparisons: never says DDoS."""
    return table.withColumn("prediction", F.when(F.col("prediction") == "DDoS", "DoS").otherwise(F.col("prediction")))


def _metric_sql(model: str, prediction: str) -> str:
    """All compared values of one model, from the tallies of its classes."""
    return f"""SELECT '{model}' AS model, round(sum(tp) / sum(support), 4) AS accuracy,
      round(avg(rec) FILTER (WHERE support > 0), 4) AS balanced_acc, round(avg(prec), 4) AS macro_precision,
      round(avg(rec), 4) AS macro_recall, round(avg(f1), 4) AS macro_f1,
      round(sum(f1 * support) / sum(support), 4) AS weighted_f1, CAST(NULL AS DOUBLE) AS roc_auc_ovr,
      round((sum(support) FILTER (WHERE class <> 'BENIGN') - max(missed)) / sum(support) FILTER (WHERE class <> 'BENIGN'), 4)
        AS detection_rate,
      round((max(support) FILTER (WHERE class = 'BENIGN') - max(tp) FILTER (WHERE class = 'BENIGN'))
        / max(support) FILTER (WHERE class = 'BENIGN'), 4) AS false_alarm_rate,
      CAST(max(missed) AS BIGINT) AS false_negatives
      FROM (SELECT *, CASE WHEN prec + rec > 0 THEN 2 * prec * rec / (prec + rec) ELSE 0.0 END AS f1 FROM (
        SELECT c AS class, tp, support, missed, CASE WHEN said > 0 THEN tp / said ELSE 0.0 END AS prec,
          CASE WHEN support > 0 THEN tp / support ELSE 0.0 END AS rec FROM (
          SELECT c, count(*) FILTER (WHERE l = c AND p = c) AS tp, count(*) FILTER (WHERE l = c) AS support,
            count(*) FILTER (WHERE p = c) AS said, count(*) FILTER (WHERE l <> 'BENIGN' AND p = 'BENIGN') AS missed
          FROM (SELECT label AS l, {prediction} AS p FROM predicted), (SELECT unnest([{_CLASS_LIST}]) AS c) GROUP BY c)))"""


@query("j6_comparison_table", O.PREDICTED + ", compared AS (" + _metric_sql("rules", "prediction")
    + " UNION ALL " + _metric_sql("weaker", "CASE WHEN prediction = 'DDoS' THEN 'DoS' ELSE prediction END")
    + """) SELECT *, row_number() OVER (ORDER BY macro_f1 DESC, model) AS place FROM compared""")
def j6(spark, sf_dir):
    table = predicted(spark, sf_dir)
    found = evaluation.comparison_table({
        "rules": evaluation.evaluate(table, ALL_CLASSES),
        "weaker": evaluation.evaluate(weaker(table), ALL_CLASSES),
    })
    order = Window.orderBy(F.desc("macro_f1"), "model")  # one row a model
    return found.withColumn("place", F.row_number().over(order).cast("bigint"))


@query("j7_normalised_confusion", _CELLS + """SELECT label, prediction, CAST(n AS BIGINT) AS n,
  round(n / greatest(sum(n) OVER (PARTITION BY label), 1), 6) AS share FROM cells""")
def j7(spark, sf_dir):
    cells = evaluation.confusion_cells(predicted(spark, sf_dir), classes=ALL_CLASSES)
    return rounded(evaluation.normalised_confusion(cells))


# A class that no row has counts in one average and not in the other.
@query("j8_recall_averages", _CELLS.replace(_CLASS_LIST, _CLASS_LIST + ", 'Never Seen'")
    + """SELECT round(avg(rec) FILTER (WHERE support > 0), 6) AS balanced_accuracy,
  round(avg(rec), 6) AS macro_recall FROM f1s""")
def j8(spark, sf_dir):
    found = evaluation.evaluate(predicted(spark, sf_dir), [*ALL_CLASSES, "Never Seen"])
    return rounded(found.select("balanced_accuracy", "macro_recall"))


@query("f6_best_model", O.PREDICTED + """, results AS (
    SELECT 'weaker' AS model, 0 AS position, avg((label = CASE WHEN prediction = 'DDoS' THEN 'DoS' ELSE prediction END)::INT)
      AS accuracy FROM predicted
    UNION ALL SELECT 'rules', 1, avg((label = prediction)::INT) FROM predicted)
  SELECT model, round(accuracy, 6) AS accuracy FROM results ORDER BY results.accuracy DESC, position LIMIT 1""")
def f6(spark, sf_dir):
    table = predicted(spark, sf_dir)
    results = [
        evaluation.evaluate(t, ALL_CLASSES).select(F.lit(name).alias("model"), F.lit(i).alias("position"), "accuracy", "macro_f1")
        for i, (name, t) in enumerate({"weaker": weaker(table), "rules": table}.items())
    ]
    best = evaluation.best_model(results[0].unionByName(results[1]), "accuracy")
    return rounded(best.select("model", "accuracy"))


# --- anomaly arithmetic on a given score ---------------------------------------

_RAW = "SELECT *, -(0.3::DOUBLE + anomaly_score / 2.0::DOUBLE) AS raw FROM predicted"


def raw_scored(spark, sf_dir):
    return predicted(spark, sf_dir).withColumn("raw", -(F.lit(0.3) + F.col("anomaly_score") / F.lit(2.0)))


_CALIBRATION = O.PREDICTED + f""", s AS ({_RAW}), cal AS (SELECT quantile_cont(raw, 0.005) AS low,
  quantile_cont(raw, 0.995) AS high FROM s), thr AS (SELECT quantile_cont(raw, 0.05) AS threshold FROM s WHERE label = 'BENIGN')"""


@query("g3_calibration", _CALIBRATION
       + "SELECT round(low, 6) AS low, round(high, 6) AS high, round(threshold, 6) AS threshold FROM cal, thr")
def g3(spark, sf_dir):
    table = raw_scored(spark, sf_dir)
    found = anomaly.calibration(table, table.where(F.col("label") == tax.BENIGN), "raw")
    return rounded(spark.createDataFrame([found], "low double, high double, threshold double"))


@query("g4_normalised_scores", _CALIBRATION + """SELECT flow_id, round(greatest(0.0::DOUBLE, least(1.0::DOUBLE,
  (high - raw) / (high - low))), 6) AS score FROM s, cal""")
def g4(spark, sf_dir):
    table = raw_scored(spark, sf_dir)
    low, high, _ = anomaly.calibration(table, table.where(F.col("label") == tax.BENIGN), "raw")
    return rounded(table.select("flow_id", anomaly.normalised(F.col("raw"), low, high).alias("score")))


@query("g5_anomaly_flags", _CALIBRATION + "SELECT label, count(*) FILTER (WHERE raw < threshold) AS flagged, "
       "count(*) AS n FROM s, thr GROUP BY label")
def g5(spark, sf_dir):
    table = raw_scored(spark, sf_dir)
    _, _, threshold = anomaly.calibration(table, table.where(F.col("label") == tax.BENIGN), "raw")
    return table.groupBy("label").agg(
        F.count_if(anomaly.flagged(F.col("raw"), threshold)).alias("flagged"), F.count("*").alias("n"))


@query("g6_anomaly_by_class", O.PREDICTED + """SELECT label, round(avg(anomaly_score), 6) AS mean_anomaly_score,
  round(avg(is_anomaly::INT), 6) AS flagged_rate, count(*) AS n FROM predicted GROUP BY label""")
def g6(spark, sf_dir):
    return rounded(reports.anomaly_by_class(predicted(spark, sf_dir)))


@query("g7_detector_only", O.PREDICTED + "SELECT flow_id, label FROM predicted WHERE prediction = 'BENIGN' AND is_anomaly")
def g7(spark, sf_dir):
    return scoring.detector_only(predicted(spark, sf_dir)).select("flow_id", "label")


# --- explanation ---------------------------------------------------------------

_FACTORS = ["flow_duration", "total_fwd_packets", "total_backward_packets", "packet_length_std", "syn_flag_count"]
_UNITS = [1e6, 100.0, 10.0, 400.0, 100.0]
_WEIGHTS = {"BENIGN": [0.8, -0.3, 0.9, 0.1, -0.7], "DDoS": [-0.4, 1.2, -0.6, 0.2, 1.1], "PortScan": [-0.9, -0.2, -1.3, 0.4, 0.3]}
_CONTRIBUTIONS = O.PREDICTED + ", parts AS (" + " UNION ALL ".join(
    f"SELECT flow_id, prediction, '{f}' AS feature, {i} AS place, round({f}, 4) AS value, ({f} / {u}::DOUBLE) * CASE prediction "
    + " ".join(f"WHEN '{c}' THEN {w[i]}::DOUBLE" for c, w in _WEIGHTS.items()) + " END AS contribution FROM predicted"
    for i, (f, u) in enumerate(zip(_FACTORS, _UNITS))) + "), ranked AS (SELECT *, row_number() OVER "\
    "(PARTITION BY flow_id ORDER BY abs(contribution) DESC, place DESC) AS rank FROM (SELECT DISTINCT * FROM parts))"


def attributed(spark, sf_dir):
    table = predicted(spark, sf_dir)
    scaled = F.array(*[F.col(f) / F.lit(u) for f, u in zip(_FACTORS, _UNITS)])
    index = F.array_position(F.array(*[F.lit(c) for c in _WEIGHTS]), F.col("prediction")).cast("int") - 1
    parts = explanation.linear_contributions(scaled, index, list(_WEIGHTS.values()))
    values = explanation.raw_values(_FACTORS, table.columns)
    return table.withColumn("top", explanation.top_contributions(parts, _FACTORS, values, k=3))


@query("k1_linear_attribution", _CONTRIBUTIONS + """SELECT flow_id, feature, round(contribution, 6) AS contribution,
  CASE WHEN contribution > 0 THEN 'increases' ELSE 'decreases' END AS direction, value FROM ranked WHERE rank <= 3""")
def k1(spark, sf_dir):
    rows = attributed(spark, sf_dir).select("flow_id", F.inline("top")).dropDuplicates()
    return rows.select("flow_id", "feature", "contribution", "direction",
                       F.col("value").cast("double").alias("value"))


@query("k4_explanation_sentence", _CONTRIBUTIONS + f"""SELECT flow_id, 'Classified as ' || prediction || ', driven mainly by '
  || string_agg({O.display_sql('feature')}, ', ' ORDER BY rank) || '.' AS sentence
  FROM ranked WHERE rank <= 3 GROUP BY flow_id, prediction""")
def k4(spark, sf_dir):
    rows = attributed(spark, sf_dir)
    return rows.select("flow_id", explanation.explanation_sentence(F.col("prediction"), F.col("top")).alias("sentence")).dropDuplicates()


# --- reports ---------------------------------------------------------------------

_PROFILED = ["flow_id", "source_ip", "destination_ip", "timestamp", *tax.CORE_FEATURES, "label"]


@query("l1_column_profile", O.FLOWS + " UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", count(*) - count({c}) AS missing, "
    f"round((count(*) - count({c})) * 100.0 / count(*), 2) AS missing_pct, count(DISTINCT {c}) AS distinct_values FROM raw_flows"
    for c in _PROFILED))
def l1(spark, sf_dir):
    return reports.column_profile(raw_flows(spark, sf_dir)).drop("dtype")


@query("l2_duplicate_rows", O.LABELLED + """SELECT CAST((SELECT count(*) FROM raw_flows)
  - (SELECT count(*) FROM (SELECT DISTINCT * FROM raw_flows)) AS BIGINT) AS duplicate_rows""")
def l2(spark, sf_dir):
    return reports.duplicate_rows(raw_flows(spark, sf_dir))


_SUMMED = [c for c in O.KEPT if c not in ("destination_port", "protocol")]


@query("l3_numeric_summary", O.DISTINCT + " UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", round(avg({c}), 3) AS mean, round(stddev_samp({c}), 3) AS std, round(min({c}), 3) AS min, "
    f"round(max({c}), 3) AS max, round(quantile_cont({c}, 0.5), 3) AS median FROM cleaned" for c in _SUMMED))
def l3(spark, sf_dir):
    return rounded(reports.numeric_summary(clean_rows(spark, sf_dir), _SUMMED), 3)


@query("l4_class_distribution", O.DISTINCT + """SELECT
  round(max(n) FILTER (WHERE label = 'BENIGN') * 1.0 / sum(n), 6) AS benign_share,
  (SELECT label FROM class_sizes WHERE n >= 50 ORDER BY n, label LIMIT 1) AS rarest,
  round(max(n) * 1.0 / min(n), 6) AS imbalance FROM class_sizes WHERE n >= 50""")
def l4(spark, sf_dir):
    return rounded(reports.class_distribution(clean_rows(spark, sf_dir)))


_BOXED = tax.BEHAVIOUR_FEATURES


@query("l5_class_boxes", O.DISTINCT + " UNION ALL ".join(
    f"SELECT label, '{f}' AS feature, {q}::DOUBLE AS share, round(quantile_cont(CASE WHEN {f} IS NOT NULL THEN ln(1 + greatest({f}, 0)) END, {q}), 5) AS value "
    "FROM cleaned_derived GROUP BY label" for f in _BOXED for q in (0.0, 0.25, 0.5, 0.75, 1.0)))
def l5(spark, sf_dir):
    return rounded(reports.class_box_table(with_derived_features(clean_rows(spark, sf_dir)), _BOXED), 5)


@query("l6_class_mix_by_service", O.DERIVED + "SELECT port_category, " + ", ".join(
    f"round(count(*) FILTER (WHERE label = '{c}') / count(*), 6) AS \"{c}\"" for c in ALL_CLASSES)
    + " FROM derived GROUP BY port_category")
def l6(spark, sf_dir):
    return rounded(reports.class_mix(derived(spark, sf_dir), ALL_CLASSES))


@query("l7_top_ports", O.FLOWS + """SELECT destination_port, count(*) AS n FROM raw_flows GROUP BY ALL
  ORDER BY n DESC, destination_port LIMIT 15""")
def l7(spark, sf_dir):
    return rounded(reports.top_values(raw_flows(spark, sf_dir), "destination_port", 15))


_CORRELATED = [c for c in O.KEPT if c != "protocol"] + ["packets_per_second", "tcp_flag_density", "duration_seconds"]
_CORR = O.DISTINCT + ", r AS (SELECT " + ", ".join(
    f"corr(CAST({a} AS DOUBLE), CAST({b} AS DOUBLE)) AS \"{a}|{b}\"" for i, a in enumerate(_CORRELATED) for b in _CORRELATED[i + 1:]
    ) + " FROM cleaned_derived), pairs AS (" + " UNION ALL ".join(
    f"SELECT '{a}' AS feature_a, '{b}' AS feature_b, \"{a}|{b}\" AS c FROM r" for i, a in enumerate(_CORRELATED) for b in _CORRELATED[i + 1:]) + ")"


def correlated(spark, sf_dir):
    return reports.correlations(with_derived_features(clean_rows(spark, sf_dir)), _CORRELATED)


@query("l8_correlations", _CORR + "SELECT feature_a, feature_b, round(c, 6) AS correlation FROM pairs")
def l8(spark, sf_dir):
    return rounded(correlated(spark, sf_dir))


@query("l9_strong_pairs", _CORR + "SELECT feature_a, feature_b, round(c, 6) AS correlation FROM pairs WHERE abs(c) > 0.90")
def l9(spark, sf_dir):
    return rounded(reports.strong_pairs(correlated(spark, sf_dir)))


@query("l10_attack_distribution", O.SCORED + """SELECT 'attack' AS kind, prediction AS value, count(*) AS n FROM scored
  WHERE prediction <> 'BENIGN' GROUP BY ALL UNION ALL SELECT 'level', risk_level, count(*) FROM scored GROUP BY ALL""")
def l10(spark, sf_dir):
    table = scored(spark, sf_dir)
    attacks = reports.distribution(scoring.malicious(table), "prediction")
    levels = reports.distribution(table, "risk_level")
    return attacks.select(F.lit("attack").alias("kind"), F.col("prediction").alias("value"), "n").unionByName(
        levels.select(F.lit("level").alias("kind"), F.col("risk_level").alias("value"), "n"))


# Minutes, of which many have no flow.
@query("l11_timeline", O.PREDICTED + """, counts AS (SELECT time_bucket(INTERVAL '1 minute', timestamp) AS bucket, count(*) AS total,
    count(*) FILTER (WHERE prediction <> 'BENIGN') AS malicious FROM predicted GROUP BY ALL),
  calendar AS (SELECT unnest(generate_series(min(bucket), max(bucket), INTERVAL '1 minute')) AS bucket FROM counts)
  SELECT strftime(bucket, '%Y-%m-%d %H:%M') AS bucket, coalesce(total, 0) AS total, coalesce(malicious, 0) AS malicious,
    coalesce(total, 0) - coalesce(malicious, 0) AS benign FROM calendar LEFT JOIN counts USING (bucket)""")
def l11(spark, sf_dir):
    found = reports.timeline(predicted(spark, sf_dir), every="1 minute")
    return found.withColumn("bucket", F.date_format("bucket", "yyyy-MM-dd HH:mm"))


@query("l12_top_threats", O.SCORED + """SELECT flow_id, string_split(source_ip, '.')[1] || '.' || string_split(source_ip, '.')[2] || '.x.x' AS source,
  string_split(destination_ip, '.')[1] || '.' || string_split(destination_ip, '.')[2] || '.x.x' AS destination,
  CAST(destination_port AS BIGINT) AS port, prediction AS attack, CAST(risk_score AS BIGINT) AS risk, risk_level AS level,
  format('{:,.1f}', confidence * 100) || '%' AS confidence, CASE WHEN is_anomaly THEN 'yes' ELSE 'no' END AS anomaly
  FROM scored WHERE prediction <> 'BENIGN' ORDER BY risk_score DESC, flow_id LIMIT 25""")
def l12(spark, sf_dir):
    return rounded(reports.top_threats(scored(spark, sf_dir)).drop("timestamp"))


@query("l13_high_risk_preview", O.SCORED + """SELECT flow_id, prediction, round(confidence, 6) AS confidence,
  CAST(risk_score AS BIGINT) AS risk_score, risk_level, round(anomaly_score, 6) AS anomaly_score, is_anomaly,
  array_to_string(indicator_list, '; ') AS indicators FROM scored WHERE risk_level IN ('HIGH', 'CRITICAL')
  ORDER BY risk_score DESC, flow_id LIMIT 200""")
def l13(spark, sf_dir):
    table = scored(spark, sf_dir).withColumn("indicators", F.array_join("indicators", "; "))
    return rounded(reports.high_risk_preview(table))


@query("l14_class_scores", _CELLS + """SELECT class, round(f1, 6) AS f1, round(rec, 6) AS recall, CAST(support AS BIGINT)
  AS support FROM f1s""")
def l14(spark, sf_dir):
    return rounded(class_table(spark, sf_dir).select("class", "f1", "recall", "support"))


@query("l15_missing_core_features", O.DISTINCT + """SELECT CAST(24 AS BIGINT) AS position, 'urg_flag_count' AS feature,
  (SELECT count(*) FROM cleaned) AS rows_affected""")
def l15(spark, sf_dir):
    table = clean_rows(spark, sf_dir)
    missing = missing_core_features(table).withColumn("one", F.lit(1))
    rows = table.agg(F.count("*").alias("rows_affected")).withColumn("one", F.lit(1))
    return rounded(missing.join(rows, "one").drop("one"))
