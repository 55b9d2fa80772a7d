"""Every fixed value that results depend on, written out a second time."""

import pytest
from pyspark.sql import functions as F

from wireglean import taxonomy as tax
from wireglean.functions.traffic import port_category, protocol_name
from wireglean.operators import cleaning

FAMILIES = {
    "benign": "BENIGN", "ddos": "DDoS", "dos hulk": "DoS", "dos goldeneye": "DoS", "dos slowloris": "DoS",
    "dos slowhttptest": "DoS", "heartbleed": "DoS", "portscan": "PortScan", "port scan": "PortScan",
    "ftp patator": "BruteForce", "ssh patator": "BruteForce", "web attack brute force": "BruteForce",
    "web attack xss": "WebAttack", "web attack sql injection": "WebAttack", "bot": "Botnet", "botnet": "Botnet",
    "infiltration": "Infiltration", "dos": "DoS", "bruteforce": "BruteForce", "brute force": "BruteForce",
    "webattack": "WebAttack", "web attack": "WebAttack",
}
PORTS = {
    "http": [80, 8000, 8008, 8080], "https": [443, 8443], "ssh": [22], "ftp": [20, 21], "telnet": [23],
    "mail": [25, 110, 143, 465, 587], "dns": [53], "remote_desktop": [3389, 5900], "smb": [135, 139, 445],
    "database": [1433, 3306, 5432, 6379, 27017], "other_well_known": [0, 1, 19, 24, 1023],
    "registered": [1024, 5901, 49151], "ephemeral": [49152, 65535],
}


def test_every_label_key(spark):
    texts = [(form.format(key), family) for key, family in FAMILIES.items() for form in ("{}", " {} ", "{}.", "my {}")]
    table = spark.createDataFrame(texts, "label string, family string")
    # "my ddos" and the like hold other keys as well, but none that comes before their own.
    wrong = cleaning.with_families(table).where("label <> family").collect()
    assert wrong == []
    assert dict(tax.LABEL_FAMILIES) == FAMILIES


def test_every_port(spark):
    rows = [(float(p), bucket) for bucket, ports in PORTS.items() for p in ports]
    table = spark.createDataFrame(rows, "p double, bucket string").withColumn("found", port_category("p"))
    assert table.where("found <> bucket").collect() == []
    assert sum(len(ports) for _, ports in tax.SERVICE_PORTS) == sum(len(PORTS[n]) for n, _ in tax.SERVICE_PORTS)


def test_every_protocol(spark):
    names = {0: "hopopt", 1: "icmp", 6: "tcp", 17: "udp", 47: "gre", 58: "icmpv6", 2: "other", 255: "other"}
    table = spark.createDataFrame([(str(k), v) for k, v in names.items()], "p string, name string")
    assert table.where(F.col("name") != protocol_name("p")).collect() == []


@pytest.mark.parametrize("name, value", [
    ("SEVERITY", {"BENIGN": 0, "PortScan": 45, "WebAttack": 70, "BruteForce": 72, "DoS": 80, "DDoS": 88, "Botnet": 90,
                  "Infiltration": 95}),
    ("UNKNOWN_SEVERITY", 60), ("RISK_WEIGHTS", {"severity": 0.45, "confidence": 0.25, "anomaly": 0.20, "traffic": 0.10}),
    ("EPSILON", 1e-6), ("RATE_CEILING", 1e9), ("TEST_SHARE", 0.2), ("VALIDATION_SHARE", 0.2), ("FOLDS", 3),
    ("CLASS_CAP", 150_000), ("MIN_CLASS_ROWS", 50), ("RARE_CATEGORY_SHARE", 0.001), ("CONTAMINATION", 0.05),
    ("MAX_UPLOAD_MB", 25), ("MAX_UPLOAD_ROWS", 50_000), ("MAX_PREVIEW_ROWS", 5_000),
])
def test_numbers(name, value):
    assert getattr(tax, name) == value
