"""Names, lookup tables and limits of the flow domain.

Everything in this module is a FIXED VALUE: results depend on these words and
numbers being exactly as written, so they are data and not logic.
"""

# --- fixed values: classes -------------------------------------------------

BENIGN = "BENIGN"
OTHER = "Other"

CLASSES = [
    "BENIGN", "DDoS", "DoS", "PortScan", "BruteForce", "WebAttack", "Botnet", "Infiltration",
]

# Cleaned label text -> family. Order matters: a text that is no key takes the
# family of the first key it contains.
LABEL_FAMILIES = [
    ("benign", "BENIGN"),
    ("ddos", "DDoS"),
    ("dos hulk", "DoS"),
    ("dos goldeneye", "DoS"),
    ("dos slowloris", "DoS"),
    ("dos slowhttptest", "DoS"),
    ("heartbleed", "DoS"),
    ("portscan", "PortScan"),
    ("port scan", "PortScan"),
    ("ftp patator", "BruteForce"),
    ("ssh patator", "BruteForce"),
    ("web attack brute force", "BruteForce"),
    ("web attack xss", "WebAttack"),
    ("web attack sql injection", "WebAttack"),
    ("bot", "Botnet"),
    ("botnet", "Botnet"),
    ("infiltration", "Infiltration"),
    ("dos", "DoS"),
    ("bruteforce", "BruteForce"),
    ("brute force", "BruteForce"),
    ("webattack", "WebAttack"),
    ("web attack", "WebAttack"),
]

SEVERITY = {
    "BENIGN": 0, "PortScan": 45, "WebAttack": 70, "BruteForce": 72,
    "DoS": 80, "DDoS": 88, "Botnet": 90, "Infiltration": 95,
}
UNKNOWN_SEVERITY = 60

# --- fixed values: columns -------------------------------------------------

LABEL_COLUMNS = ["label", "labels", "attack", "class", "attack_category"]

LEAKAGE_COLUMNS = [
    "flow_id", "source_ip", "src_ip", "destination_ip", "dst_ip", "source_port", "src_port",
    "timestamp", "fwd_header_length_1", "unnamed_0", "similarhttp", "inbound",
]

CORE_FEATURES = [
    "destination_port", "protocol", "flow_duration",
    "total_fwd_packets", "total_backward_packets",
    "total_length_of_fwd_packets", "total_length_of_bwd_packets",
    "fwd_packet_length_mean", "fwd_packet_length_std",
    "bwd_packet_length_mean", "bwd_packet_length_std",
    "flow_bytes_s", "flow_packets_s", "flow_iat_mean", "flow_iat_std",
    "min_packet_length", "max_packet_length", "packet_length_mean", "packet_length_std",
    "syn_flag_count", "ack_flag_count", "fin_flag_count",
    "psh_flag_count", "rst_flag_count", "urg_flag_count",
    "down_up_ratio", "average_packet_size",
    "init_win_bytes_forward", "init_win_bytes_backward",
]

FLAG_COUNTS = [
    "syn_flag_count", "ack_flag_count", "fin_flag_count",
    "psh_flag_count", "rst_flag_count", "urg_flag_count",
]

DERIVED_FEATURES = [
    "duration_seconds", "packets_per_second", "bytes_per_second",
    "fwd_bwd_packet_ratio", "fwd_bwd_byte_ratio", "avg_packet_size_derived",
    "tcp_flag_density", "bytes_per_packet", "is_ephemeral_port",
]

CATEGORICAL_FEATURES = ["port_category", "protocol"]

# --- fixed values: ports and protocols -------------------------------------

# Service ports win over the ranges below them.
SERVICE_PORTS = [
    ("http", [80, 8080, 8000, 8008]),
    ("https", [443, 8443]),
    ("ssh", [22]),
    ("ftp", [21, 20]),
    ("telnet", [23]),
    ("mail", [25, 465, 587, 110, 143]),
    ("dns", [53]),
    ("remote_desktop", [3389, 5900]),
    ("smb", [445, 139, 135]),
    ("database", [1433, 3306, 5432, 27017, 6379]),
]
PORT_RANGES = [("other_well_known", 0, 1023), ("registered", 1024, 49151)]
FIRST_EPHEMERAL_PORT = 49152

PROTOCOL_NAMES = {0: "hopopt", 1: "icmp", 6: "tcp", 17: "udp", 47: "gre", 58: "icmpv6"}

# --- fixed values: numbers -------------------------------------------------

EPSILON = 1e-6
RATE_CEILING = 1e9

RISK_WEIGHTS = {"severity": 0.45, "confidence": 0.25, "anomaly": 0.20, "traffic": 0.10}
RISK_BANDS = [(30, "LOW"), (60, "MEDIUM"), (80, "HIGH"), (100, "CRITICAL")]
ANOMALY_FLOOR = 45.0
ANOMALY_BANDS = [(0.35, "NORMAL"), (0.70, "SUSPICIOUS")]
ANOMALY_TOP_BAND = "CRITICAL"

PACKET_RATE_ALERT = 5_000.0
BYTE_RATE_ALERT = 5_000_000.0
FLAG_DENSITY_ALERT = 0.9
ASYMMETRY_ALERT = 50.0

MAX_COUNT = 1e9
MAX_BYTES = 1e12
MAX_RATE = 1e12

# Field -> (smallest, largest) value a flow record may carry.
FIELD_BOUNDS = {
    "destination_port": (0, 65535),
    "protocol": (0, 255),
    "flow_duration": (0, MAX_RATE),
    "total_fwd_packets": (0, MAX_COUNT),
    "total_backward_packets": (0, MAX_COUNT),
    "total_length_of_fwd_packets": (0, MAX_BYTES),
    "total_length_of_bwd_packets": (0, MAX_BYTES),
    "fwd_packet_length_mean": (0, MAX_BYTES),
    "fwd_packet_length_std": (0, MAX_BYTES),
    "bwd_packet_length_mean": (0, MAX_BYTES),
    "bwd_packet_length_std": (0, MAX_BYTES),
    "flow_bytes_s": (0, MAX_RATE),
    "flow_packets_s": (0, MAX_RATE),
    "flow_iat_mean": (0, MAX_RATE),
    "flow_iat_std": (0, MAX_RATE),
    "min_packet_length": (0, MAX_BYTES),
    "max_packet_length": (0, MAX_BYTES),
    "packet_length_mean": (0, MAX_BYTES),
    "packet_length_std": (0, MAX_BYTES),
    "syn_flag_count": (0, MAX_COUNT),
    "ack_flag_count": (0, MAX_COUNT),
    "fin_flag_count": (0, MAX_COUNT),
    "psh_flag_count": (0, MAX_COUNT),
    "rst_flag_count": (0, MAX_COUNT),
    "urg_flag_count": (0, MAX_COUNT),
    "down_up_ratio": (0, MAX_COUNT),
    "average_packet_size": (0, MAX_BYTES),
    "init_win_bytes_forward": (-1, MAX_BYTES),
    "init_win_bytes_backward": (-1, MAX_BYTES),
}
REQUIRED_FIELDS = ["destination_port"]
INTEGER_FIELDS = ["destination_port", "protocol"]

TEST_SHARE = 0.20
VALIDATION_SHARE = 0.20
FOLDS = 3
CLASS_CAP = 150_000
MIN_CLASS_ROWS = 50
NUMERIC_SHARE = 0.90
RARE_CATEGORY_SHARE = 0.001
CONTAMINATION = 0.05
SEED = 42

MAX_UPLOAD_MB = 25
MAX_UPLOAD_ROWS = 50_000
MAX_PREVIEW_ROWS = 5_000

# --- fixed values: texts ---------------------------------------------------

# Texts a CSV cell may hold for "missing" (the defaults documented by pandas).
MISSING_TEXTS = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
]

DISPLAY_NAMES = {
    "flow_packets_s": "Flow Packets/s",
    "flow_bytes_s": "Flow Bytes/s",
    "packets_per_second": "Packets per Second (derived)",
    "bytes_per_second": "Bytes per Second (derived)",
    "total_fwd_packets": "Total Forward Packets",
    "total_backward_packets": "Total Backward Packets",
    "total_length_of_fwd_packets": "Total Forward Bytes",
    "total_length_of_bwd_packets": "Total Backward Bytes",
    "destination_port": "Destination Port",
    "packet_length_mean": "Packet Length Mean",
    "packet_length_std": "Packet Length Std Dev",
    "flow_duration": "Flow Duration",
    "duration_seconds": "Flow Duration (s)",
    "fwd_bwd_packet_ratio": "Fwd/Bwd Packet Ratio (derived)",
    "fwd_bwd_byte_ratio": "Fwd/Bwd Byte Ratio (derived)",
    "tcp_flag_density": "TCP Flag Density (derived)",
    "avg_packet_size_derived": "Average Packet Size (derived)",
    "syn_flag_count": "SYN Flag Count",
    "ack_flag_count": "ACK Flag Count",
    "fin_flag_count": "FIN Flag Count",
    "psh_flag_count": "PSH Flag Count",
    "rst_flag_count": "RST Flag Count",
    "init_win_bytes_forward": "Initial Window Bytes (fwd)",
    "init_win_bytes_backward": "Initial Window Bytes (bwd)",
}

BEHAVIOUR_FEATURES = [
    "flow_duration", "flow_packets_s", "flow_bytes_s",
    "packets_per_second", "fwd_bwd_packet_ratio", "tcp_flag_density",
]

RESULT_COLUMNS = [
    "prediction", "confidence", "risk_score", "risk_level",
    "anomaly_score", "is_anomaly", "is_malicious", "indicators",
]
