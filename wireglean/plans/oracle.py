"""The same flows, families, features and scores in plain SQL, to check the Spark results against."""

from wireglean import taxonomy as tax
from wireglean.plans.fixtures import FLOW_CTES

FLOWS = "WITH " + FLOW_CTES.replace("{events}", "events")


def quoted(words) -> str:
    return ", ".join("'" + str(w).replace("'", "''") + "'" for w in words)


# The rules below are written out with literals of their own, so that a wrong entry in the taxonomy shows.


def family_sql(column: str) -> str:
    words = f"trim(regexp_replace(lower(trim({column})), '[^a-z0-9]+', ' ', 'g'))"
    return f"""CASE WHEN {column} IS NULL OR {words} IN ('', 'nan') THEN ''
      WHEN {words} = 'benign' THEN 'BENIGN' WHEN {words} = 'ddos' THEN 'DDoS'
      WHEN {words} IN ('dos hulk', 'dos goldeneye', 'dos slowloris', 'dos slowhttptest', 'heartbleed', 'dos') THEN 'DoS'
      WHEN {words} IN ('portscan', 'port scan') THEN 'PortScan'
      WHEN {words} IN ('ftp patator', 'ssh patator', 'web attack brute force', 'bruteforce', 'brute force') THEN 'BruteForce'
      WHEN {words} IN ('web attack xss', 'web attack sql injection', 'webattack', 'web attack') THEN 'WebAttack'
      WHEN {words} IN ('bot', 'botnet') THEN 'Botnet' WHEN {words} = 'infiltration' THEN 'Infiltration'
      WHEN contains({words}, 'benign') THEN 'BENIGN' WHEN contains({words}, 'ddos') THEN 'DDoS'
      WHEN regexp_matches({words}, 'dos hulk|dos goldeneye|dos slowloris|dos slowhttptest|heartbleed') THEN 'DoS'
      WHEN regexp_matches({words}, 'port ?scan') THEN 'PortScan'
      WHEN regexp_matches({words}, '(ftp|ssh) patator|web attack brute force') THEN 'BruteForce'
      WHEN regexp_matches({words}, 'web attack (xss|sql injection)') THEN 'WebAttack'
      WHEN contains({words}, 'bot') THEN 'Botnet' WHEN contains({words}, 'infiltration') THEN 'Infiltration'
      WHEN contains({words}, 'dos') THEN 'DoS' WHEN regexp_matches({words}, 'brute ?force') THEN 'BruteForce'
      WHEN regexp_matches({words}, 'web ?attack') THEN 'WebAttack' ELSE 'Other' END"""


def port_sql(number: str) -> str:
    return f"""CASE WHEN {number} IS NULL THEN 'unknown' WHEN {number} IN (80, 8080, 8000, 8008) THEN 'http'
      WHEN {number} IN (443, 8443) THEN 'https' WHEN {number} = 22 THEN 'ssh' WHEN {number} IN (20, 21) THEN 'ftp'
      WHEN {number} = 23 THEN 'telnet' WHEN {number} IN (25, 110, 143, 465, 587) THEN 'mail' WHEN {number} = 53 THEN 'dns'
      WHEN {number} IN (3389, 5900) THEN 'remote_desktop' WHEN {number} IN (135, 139, 445) THEN 'smb'
      WHEN {number} IN (1433, 3306, 5432, 6379, 27017) THEN 'database'
      WHEN {number} BETWEEN 0 AND 1023 THEN 'other_well_known' WHEN {number} BETWEEN 1024 AND 49151 THEN 'registered'
      WHEN {number} >= 49152 THEN 'ephemeral' ELSE 'unknown' END"""


def protocol_sql(number: str) -> str:
    names = " ".join(f"WHEN {number} = {n} THEN '{name}'" for n, name in tax.PROTOCOL_NAMES.items())
    return f"CASE WHEN {number} IS NULL THEN 'unknown' {names} ELSE 'other' END"


def severity_sql(column: str) -> str:
    return f"""CAST(CASE {column} WHEN 'BENIGN' THEN 0 WHEN 'PortScan' THEN 45 WHEN 'WebAttack' THEN 70
      WHEN 'BruteForce' THEN 72 WHEN 'DoS' THEN 80 WHEN 'DDoS' THEN 88 WHEN 'Botnet' THEN 90
      WHEN 'Infiltration' THEN 95 ELSE 60 END AS DOUBLE)"""


def display_sql(column: str) -> str:
    known = " ".join(f"WHEN {column} = '{k}' THEN '{v}'" for k, v in tax.DISPLAY_NAMES.items())
    titled = (f"array_to_string([upper(w[1]) || lower(w[2:]) for w in "
              f"string_split(replace({column}, '_', ' '), ' ')], ' ')")
    return (f"CASE {known} WHEN starts_with({column}, 'port_category_') THEN 'Service: ' || {column}[15:] "
            f"WHEN starts_with({column}, 'protocol_') THEN 'Protocol: ' || {column}[10:] ELSE {titled} END")


LABELLED = FLOWS + f""", families AS (
  SELECT * EXCLUDE (label), {family_sql('label')} AS label FROM raw_flows
), labelled AS (SELECT * FROM families WHERE label <> '')
"""

DERIVED_LIST = f"""
    abs(coalesce(flow_duration, 0)) / 1e6 AS duration_seconds,
    least((coalesce(total_fwd_packets, 0) + coalesce(total_backward_packets, 0))
          / (abs(coalesce(flow_duration, 0)) / 1e6 + 1e-6), 1e9) AS packets_per_second,
    least((coalesce(total_length_of_fwd_packets, 0) + coalesce(total_length_of_bwd_packets, 0))
          / (abs(coalesce(flow_duration, 0)) / 1e6 + 1e-6), 1e9) AS bytes_per_second,
    least(coalesce(total_fwd_packets, 0) / (coalesce(total_backward_packets, 0) + 1.0), 1e9) AS fwd_bwd_packet_ratio,
    least(coalesce(total_length_of_fwd_packets, 0)
          / (coalesce(total_length_of_bwd_packets, 0) + 1.0), 1e9) AS fwd_bwd_byte_ratio,
    (coalesce(total_length_of_fwd_packets, 0) + coalesce(total_length_of_bwd_packets, 0))
          / (coalesce(total_fwd_packets, 0) + coalesce(total_backward_packets, 0) + 1e-6) AS avg_packet_size_derived,
    (coalesce(syn_flag_count, 0) + coalesce(ack_flag_count, 0) + coalesce(fin_flag_count, 0)
     + coalesce(psh_flag_count, 0) + coalesce(rst_flag_count, 0) + coalesce(urg_flag_count, 0))
          / (coalesce(total_fwd_packets, 0) + coalesce(total_backward_packets, 0) + 1e-6) AS tcp_flag_density,
    (coalesce(total_length_of_fwd_packets, 0) + coalesce(total_length_of_bwd_packets, 0))
          / (coalesce(total_fwd_packets, 0) + coalesce(total_backward_packets, 0) + 1e-6) AS bytes_per_packet,
    CAST(coalesce(destination_port, -1) >= 49152 AS INTEGER) AS is_ephemeral_port,
    {port_sql('destination_port')} AS port_category,
    {protocol_sql('protocol')} AS protocol
"""


def derived_from(table: str) -> str:
    return f"SELECT * EXCLUDE (protocol), {DERIVED_LIST} FROM {table}"


DERIVED = LABELLED + f", derived AS ({derived_from('labelled')})\n"

PREDICTED = DERIVED + """, predicted AS (
  SELECT *,
    CASE WHEN tcp_flag_density > 0.9 AND total_fwd_packets > 100 THEN 'DDoS'
         WHEN total_backward_packets = 0 THEN 'PortScan' ELSE 'BENIGN' END AS prediction,
    0.5::DOUBLE + CAST(flow_id % 50 AS DOUBLE) / 100.0::DOUBLE AS confidence,
    CAST(flow_id % 101 AS DOUBLE) / 100.0::DOUBLE AS anomaly_score,
    flow_id % 101 > 95 AS is_anomaly
  FROM derived
)
"""

SCORED = PREDICTED + f""", parts AS (
  SELECT *,
    {severity_sql('prediction')} AS severity_part,
    CASE WHEN prediction = 'BENIGN' THEN (1.0::DOUBLE - confidence) * 100
         ELSE greatest(0.0::DOUBLE, least(1.0::DOUBLE, (confidence - 0.5::DOUBLE) / 0.5::DOUBLE)) * 100 END
      AS confidence_part,
    greatest(0.0::DOUBLE, least(1.0::DOUBLE, anomaly_score)) * 100 AS anomaly_part,
    least(100.0::DOUBLE,
      CASE WHEN packets_per_second > 5000 THEN 30 ELSE 0 END + CASE WHEN bytes_per_second > 5000000 THEN 25 ELSE 0 END
      + CASE WHEN tcp_flag_density > 0.9::DOUBLE THEN 20 ELSE 0 END
      + CASE WHEN fwd_bwd_packet_ratio > 50 THEN 15 ELSE 0 END
      + CASE WHEN total_backward_packets = 0 AND total_fwd_packets > 2 THEN 15 ELSE 0 END) AS traffic_part
  FROM predicted
), blended AS (
  SELECT *, (0.45::DOUBLE * severity_part + 0.25::DOUBLE * confidence_part + 0.20::DOUBLE * anomaly_part
             + 0.10::DOUBLE * traffic_part)
            * CASE WHEN prediction = 'BENIGN' AND NOT is_anomaly THEN 0.5::DOUBLE ELSE 1.0::DOUBLE END AS blend
  FROM parts
), rounded AS (
  SELECT *, CAST(round_even(greatest(0.0::DOUBLE, least(100.0::DOUBLE,
      CASE WHEN is_anomaly THEN greatest(blend, 45.0::DOUBLE) ELSE blend END)), 0) AS INTEGER) AS risk_score
  FROM blended
), scored AS (
  SELECT *,
    CASE WHEN risk_score <= 30 THEN 'LOW' WHEN risk_score <= 60 THEN 'MEDIUM'
         WHEN risk_score <= 80 THEN 'HIGH' ELSE 'CRITICAL' END AS risk_level,
    [x for x in [
      CASE WHEN packets_per_second > 5000
           THEN 'High packet rate (' || format('{{:,.0f}}', packets_per_second) || ' pkt/s)' END,
      CASE WHEN bytes_per_second > 5000000
           THEN 'High byte rate (' || format('{{:,.1f}}', bytes_per_second / 1e6) || ' MB/s)' END,
      CASE WHEN tcp_flag_density > 0.9::DOUBLE THEN 'Control-flag-dominated flow (near-zero payload)' END,
      CASE WHEN fwd_bwd_packet_ratio > 50
           THEN 'Extreme directional asymmetry (' || format('{{:,.0f}}', fwd_bwd_packet_ratio) || ':1 fwd/bwd)' END,
      CASE WHEN total_backward_packets = 0 AND total_fwd_packets > 2
           THEN 'No response traffic - probe or half-open connection' END,
      CASE WHEN is_anomaly THEN 'Flagged as anomalous by unsupervised detector' END
    ] if x IS NOT NULL] AS indicator_list
  FROM rounded
)
"""

# The columns that survive cleaning on this data: no identifiers, no constant column.
KEPT = [c for c in tax.CORE_FEATURES if c != "urg_flag_count"]
RATES = ["flow_bytes_s", "flow_packets_s"]


def kept_list() -> str:
    return ", ".join(
        f"CASE WHEN isinf({c}) THEN NULL ELSE {c} END AS {c}" if c in RATES else c for c in KEPT
    )


DISTINCT = LABELLED + f""", distinct_rows AS (SELECT DISTINCT {kept_list()}, label FROM labelled)
, class_sizes AS (SELECT label, count(*) AS n FROM distinct_rows GROUP BY label)
, cleaned AS (SELECT * FROM distinct_rows WHERE label IN (SELECT label FROM class_sizes WHERE n >= 50))
, cleaned_derived AS ({derived_from('(SELECT *, CAST(NULL AS DOUBLE) AS urg_flag_count FROM cleaned)')})
"""
