"""Headers, labels, features, validation and risk: exact small cases."""

import math

import pytest
from pyspark.sql import functions as F

from tests.conftest import SF  # noqa: F401
from wireglean import taxonomy as tax
from wireglean.functions import risk
from wireglean.functions.text import display_text, masked_ip, snake_case, snake_headers
from wireglean.functions.traffic import port_category, protocol_name
from wireglean.operators import cleaning, features, scoring, validation


@pytest.mark.parametrize("raw, name", [
    ("Flow Bytes/s", "flow_bytes_s"), (" Destination Port", "destination_port"),
    ("Total Length of Fwd Packets", "total_length_of_fwd_packets"),
    ("Init_Win_bytes_forward", "init_win_bytes_forward"), ("Down/Up Ratio", "down_up_ratio"), ("  ", "unnamed"),
])
def test_header(raw, name):
    assert snake_case(raw) == name
    assert snake_case(name) == name


def test_repeated_headers_are_numbered():
    assert snake_headers(["A b", "a_b", "A  B", "c"]) == ["a_b", "a_b_1", "a_b_2", "c"]
    assert snake_headers(["A", "A", "A.1", "A"]) == ["a", "a_1", "a_1_1", "a_2"]


def test_counts_of_minus_one_give_missing_ratios(spark):
    table = spark.createDataFrame([(4.0, -1.0, 70.0, 10.0), (4.0, 2.0, 70.0, -1.0), (0.0, -1e-6, 1.0, 1.0)],
                                  "total_fwd_packets double, total_backward_packets double, "
                                  "total_length_of_fwd_packets double, total_length_of_bwd_packets double")
    rows = features.with_derived_features(table).collect()
    assert rows[0]["fwd_bwd_packet_ratio"] is None and rows[0]["fwd_bwd_byte_ratio"] == pytest.approx(70 / 11)
    assert rows[1]["fwd_bwd_byte_ratio"] is None and rows[1]["fwd_bwd_packet_ratio"] == pytest.approx(4 / 3)
    assert rows[2]["bytes_per_packet"] is None and rows[2]["tcp_flag_density"] is None


LABELS = {
    "BENIGN": "BENIGN", "DDoS": "DDoS", "DoS Hulk": "DoS", "DoS GoldenEye": "DoS", "PortScan": "PortScan",
    "FTP-Patator": "BruteForce", "SSH-Patator": "BruteForce", "Bot": "Botnet", "Infiltration": "Infiltration",
    "Web Attack \x96 XSS": "WebAttack", "Web Attack - Brute Force": "BruteForce", "": "", "nan": "", None: "",
    "Quiet Beacon": "Other", "  heartbleed ": "DoS", "robot swarm": "Botnet", "my ddos tool": "DDoS",
}


def test_label_families(spark):
    table = spark.createDataFrame([(k,) for k in LABELS], "label string")
    got = {r["raw"]: r["label"] for r in cleaning.with_families(
        table.withColumn("raw", F.col("label"))).collect()}
    assert got == LABELS


def test_label_families_are_idempotent(spark):
    table = spark.createDataFrame([(c,) for c in tax.CLASSES], "label string")
    assert sorted(r[0] for r in cleaning.with_families(table).collect()) == sorted(tax.CLASSES)


def test_label_column_is_found_in_order(spark):
    table = spark.createDataFrame([("x", "Bot")], "class string, attack string")
    assert cleaning.find_label_column(table) == "attack"
    with pytest.raises(KeyError):
        cleaning.find_label_column(table.select(F.lit(1).alias("y")))


@pytest.mark.parametrize("port, bucket", [
    (80, "http"), (443, "https"), (22, "ssh"), (53, "dns"), (3389, "remote_desktop"), (3306, "database"),
    (55000, "ephemeral"), (70000, "ephemeral"), (1, "other_well_known"), (9999, "registered"), (-1, "unknown"),
    (None, "unknown"), (1023.5, "unknown"),
])
def test_port_buckets(spark, port, bucket):
    table = spark.createDataFrame([(port,)], "p double") if port is None else spark.createDataFrame(
        [(float(port),)], "p double")
    assert table.select(port_category("p")).first()[0] == bucket


def test_protocol_is_decided_by_row(spark):
    table = spark.createDataFrame([("6",), ("17.0",), ("99",), (None,), ("quic",), ("NaN",)], "p string")
    assert [r[0] for r in table.select(protocol_name("p")).collect()] == [
        "tcp", "udp", "other", "unknown", "quic", "unknown"]


def test_zero_duration_and_zero_replies_stay_finite(spark):
    table = spark.createDataFrame(
        [(0.0, 500.0, 0.0, 30000.0, 0.0, 80), (100.0, 10.0, 0.0, 0.0, 0.0, 22)],
        "flow_duration double, total_fwd_packets double, total_backward_packets double, "
        "total_length_of_fwd_packets double, total_length_of_bwd_packets double, destination_port int")
    flood, scan = features.with_derived_features(table).collect()
    assert flood["packets_per_second"] == pytest.approx(5e8)
    assert flood["bytes_per_second"] == 1e9
    assert scan["fwd_bwd_packet_ratio"] == 10.0
    assert flood["protocol"] == "unknown"
    assert table.columns[0] == "flow_duration" and "duration_seconds" not in table.columns


def test_infinite_counts_do_not_become_infinite_rates(spark):
    table = spark.createDataFrame([(math.inf, 5.0), (1.0, math.inf), (math.nan, 1.0)],
                                  "flow_duration double, total_fwd_packets double")
    rows = features.with_derived_features(table).select("packets_per_second").collect()
    assert rows[0][0] == 0.0 and rows[1][0] is None and rows[2][0] == pytest.approx(1e6)


def test_alignment_fills_and_drops(spark):
    table = spark.createDataFrame([(80, 1)], "destination_port int, irrelevant int")
    got = features.for_inference(table, ["destination_port", "flow_duration"])
    assert got.columns == ["destination_port", "flow_duration"]
    assert got.first()["flow_duration"] is None


def test_inference_keeps_every_row(spark, flows):
    doubled = flows.unionByName(flows)
    assert features.for_inference(doubled, tax.CORE_FEATURES).count() == 2 * flows.count()


BAD = {
    "destination_port": [None, "70000", "-1", "http", "80.5"], "total_fwd_packets": ["-5", "Infinity", "NaN"],
    "protocol": ["999"], "init_win_bytes_forward": ["-2"],
}


def test_bad_records_are_refused_without_their_value(spark):
    rows = []
    for field, values in BAD.items():
        for value in values:
            record = {"destination_port": "80", "total_fwd_packets": "1", "protocol": "6", "init_win_bytes_forward": "-1"}
            record[field] = value
            rows.append((field, *record.values()))
    rows.append(("fine", "80", None, None, "-1"))
    table = spark.createDataFrame(rows, "bad string, destination_port string, total_fwd_packets string, "
                                        "protocol string, init_win_bytes_forward string")
    valid, refused = validation.valid_and_refused(table)
    assert [r["bad"] for r in valid.collect()] == ["fine"]
    for r in refused.collect():
        assert [p["field"] for p in r["problems"]] == [r["bad"]]
        assert "70000" not in r["problems"][0]["reason"]


def test_masked_ip(spark):
    table = spark.createDataFrame([("10.1.2.3",), ("host",), ("fe80::1",), (None,)], "ip string")
    assert [r[0] for r in table.select(masked_ip("ip")).collect()] == ["10.1.x.x", "host", "fe80::1", None]


def test_display_text():
    assert display_text("syn_flag_count") == "SYN Flag Count"
    assert display_text("port_category_ssh") == "Service: ssh"
    assert display_text("protocol_tcp") == "Protocol: tcp"
    assert display_text("flow_iat_mean") == "Flow Iat Mean"


@pytest.mark.parametrize("score, level", [(0, "LOW"), (30, "LOW"), (31, "MEDIUM"), (60, "MEDIUM"),
                                          (61, "HIGH"), (80, "HIGH"), (81, "CRITICAL"), (100, "CRITICAL")])
def test_risk_bands(spark, score, level):
    table = spark.createDataFrame([(score,)], "risk_score int")
    assert table.select(risk.risk_level()).first()[0] == level


def assessed(spark, rows):
    table = spark.createDataFrame(rows, "prediction string, confidence double, anomaly_score double, is_anomaly boolean")
    return scoring.with_risk(table).collect()


def test_risk_is_bounded_and_ordered(spark):
    rows = [(c, conf, a, odd) for c in (*tax.CLASSES, tax.OTHER, "unheard of")
            for conf in (0.02, 0.31, 0.77, 0.96) for a in (0.07, 0.64, 0.93) for odd in (False, True)]
    got = assessed(spark, rows)
    assert all(0 <= r["risk_score"] <= 100 for r in got)
    assert max(r["risk_score"] for r in got) <= 98
    for r in got:
        if r["prediction"] == "BENIGN" and not r["is_anomaly"]:
            assert r["risk_score"] <= 28 and r["risk_level"] == "LOW"
        if r["is_anomaly"]:
            assert r["risk_score"] >= 45
            assert r["indicators"][-1].startswith("Flagged as anomalous")
    score = {r["prediction"]: r["risk_score"] for r in got
             if (r["confidence"], r["anomaly_score"], r["is_anomaly"]) == (0.96, 0.07, False)}
    by_severity = sorted(tax.SEVERITY, key=tax.SEVERITY.get)
    assert [score[c] for c in by_severity] == sorted(score[c] for c in by_severity)
    assert score[tax.BENIGN] == min(score.values())


def test_risk_components(spark):
    row = assessed(spark, [("PortScan", 0.75, 0.35, False)])[0]
    assert row["risk_components"] == {"class_severity": float(tax.SEVERITY["PortScan"]), "model_confidence": 50.0,
                                      "anomaly": 35.0, "traffic_characteristics": 0.0}


def test_half_points_round_to_even(spark):
    # BENIGN, unflagged: 0.5 * 0.25 * (1 - c) * 100, so 0.8 gives 2.5 and 0.6 gives 5.0.
    got = assessed(spark, [("BENIGN", 0.8, 0.0, False), ("BENIGN", 0.4, 0.0, False)])
    assert [r["risk_score"] for r in got] == [2, 8]


def test_result_columns_keep_clashing_input_names(spark):
    table = spark.createDataFrame([("x", "DDoS", 0.9, 0.1, False)],
                                  "risk_level string, prediction string, confidence double, anomaly_score double, is_anomaly boolean")
    got = scoring.result_table(scoring.with_risk(table.withColumnRenamed("risk_level", "note")), keep=["note", "prediction"])
    assert len(set(got.columns)) == len(got.columns)
    assert "input_prediction" in got.columns
