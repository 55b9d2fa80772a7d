"""Flow records derived from the driver's ``events`` table, and a stand-in classifier for checks."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wireglean.session import run_folder

_written: dict[tuple[str, str], str] = {}

FLOW_CTES = """
e AS (
  SELECT event_id, ts, user_id, event_type, value,
         (event_id * 7919 + user_id * 104729) % 10007 AS h
  FROM {events}
), k AS (
  SELECT *, CASE
      WHEN h % 997 = 0 THEN 'Infiltration'
      WHEN h % 499 = 1 THEN CAST(NULL AS STRING)
      WHEN h % 401 = 2 THEN 'Novel Thing'
      WHEN event_type IN ('view', 'click') THEN 'BENIGN'
      WHEN event_type = 'error'  THEN CASE WHEN h % 2 = 0 THEN 'DoS Hulk' ELSE 'DDoS' END
      WHEN event_type = 'signup' THEN 'PortScan'
      WHEN h % 3 = 0 THEN 'SSH-Patator'
      WHEN h % 3 = 1 THEN 'Web Attack - XSS'
      ELSE 'Bot' END AS raw_label
  FROM e
), p AS (
  SELECT *,
    CASE event_type WHEN 'error'  THEN 200 + h % 300
                    WHEN 'signup' THEN 1 + h % 3
                    WHEN 'purchase' THEN 8 + h % 12
                    ELSE 10 + h % 25 END AS fwd,
    CASE event_type WHEN 'error'  THEN h % 3
                    WHEN 'signup' THEN 0
                    WHEN 'purchase' THEN 6 + h % 11
                    ELSE 9 + h % 23 END AS bwd,
    CASE WHEN h % 211 = 3 THEN 0
         WHEN event_type = 'error'  THEN 500 + h % 4000
         WHEN event_type = 'signup' THEN 50 + h % 300
         ELSE 100000 + 37 * h + CAST(floor(value * 100) AS BIGINT) END AS dur
  FROM k
), b AS (
  SELECT *,
    fwd * (CASE event_type WHEN 'error' THEN 62 WHEN 'signup' THEN 0 ELSE 90 + h % 400 END) AS fb,
    bwd * (CASE event_type WHEN 'error' THEN 0 WHEN 'signup' THEN 0 ELSE 110 + h % 900 END) AS bb
  FROM p
), f AS (
  SELECT
    event_id AS flow_id,
    concat('192.168.', CAST(user_id % 20 AS STRING), '.', CAST(2 + h % 250 AS STRING)) AS source_ip,
    concat('10.0.', CAST(h % 5 AS STRING), '.', CAST(2 + user_id % 250 AS STRING)) AS destination_ip,
    ts AS timestamp,
    CASE event_type
      WHEN 'signup' THEN CASE h % 8 WHEN 0 THEN 21 WHEN 1 THEN 22 WHEN 2 THEN 23 WHEN 3 THEN 445
                                    WHEN 4 THEN 1433 WHEN 5 THEN 3389 WHEN 6 THEN 9200 ELSE 51234 END
      WHEN 'error'  THEN CASE h % 3 WHEN 0 THEN 443 ELSE 80 END
      ELSE CASE h % 6 WHEN 0 THEN 80 WHEN 1 THEN 443 WHEN 2 THEN 53 WHEN 3 THEN 22 WHEN 4 THEN 25 ELSE 993 END
    END AS destination_port,
    CASE WHEN h % 613 = 4 THEN 47 WHEN h % 4 = 0 THEN 17 ELSE 6 END AS protocol,
    CAST(dur AS DOUBLE) AS flow_duration,
    CAST(fwd AS DOUBLE) AS total_fwd_packets,
    CAST(bwd AS DOUBLE) AS total_backward_packets,
    CAST(fb AS DOUBLE) AS total_length_of_fwd_packets,
    CAST(bb AS DOUBLE) AS total_length_of_bwd_packets,
    CAST(fb AS DOUBLE) / CAST(fwd AS DOUBLE) AS fwd_packet_length_mean,
    CAST(h % 97 AS DOUBLE) AS fwd_packet_length_std,
    CASE WHEN bwd = 0 THEN CAST(0 AS DOUBLE) ELSE CAST(bb AS DOUBLE) / CAST(bwd AS DOUBLE) END AS bwd_packet_length_mean,
    CAST(h % 89 AS DOUBLE) AS bwd_packet_length_std,
    CASE WHEN dur = 0 THEN CAST('Infinity' AS DOUBLE) ELSE CAST(fb + bb AS DOUBLE) * 1000000 / CAST(dur AS DOUBLE) END AS flow_bytes_s,
    CASE WHEN dur = 0 THEN CAST('Infinity' AS DOUBLE) ELSE CAST(fwd + bwd AS DOUBLE) * 1000000 / CAST(dur AS DOUBLE) END AS flow_packets_s,
    CAST(dur AS DOUBLE) / CAST(fwd + bwd AS DOUBLE) AS flow_iat_mean,
    CASE WHEN h % 151 = 5 THEN CAST(NULL AS DOUBLE) ELSE CAST(dur % 1009 AS DOUBLE) END AS flow_iat_std,
    CAST(h % 41 AS DOUBLE) AS min_packet_length,
    CAST(60 + h % 1400 AS DOUBLE) AS max_packet_length,
    CAST(fb + bb AS DOUBLE) / CAST(fwd + bwd AS DOUBLE) AS packet_length_mean,
    CAST(h % 409 AS DOUBLE) AS packet_length_std,
    CAST(CASE event_type WHEN 'error' THEN fwd WHEN 'signup' THEN fwd ELSE 1 + h % 2 END AS DOUBLE) AS syn_flag_count,
    CAST(CASE event_type WHEN 'error' THEN h % 4 WHEN 'signup' THEN 0 ELSE bwd END AS DOUBLE) AS ack_flag_count,
    CAST(h % 2 AS DOUBLE) AS fin_flag_count,
    CAST(h % 7 AS DOUBLE) AS psh_flag_count,
    CAST(CASE WHEN h % 53 = 0 THEN 1 ELSE 0 END AS DOUBLE) AS rst_flag_count,
    CAST(0 AS DOUBLE) AS urg_flag_count,
    CAST(bwd AS DOUBLE) / CAST(fwd AS DOUBLE) AS down_up_ratio,
    CAST(fb + bb AS DOUBLE) / CAST(fwd + bwd AS DOUBLE) AS average_packet_size,
    CAST(CASE h % 4 WHEN 0 THEN -1 WHEN 1 THEN 1024 WHEN 2 THEN 8192 ELSE 29200 END AS DOUBLE) AS init_win_bytes_forward,
    CAST(CASE h % 3 WHEN 0 THEN -1 WHEN 1 THEN 229 ELSE 26883 END AS DOUBLE) AS init_win_bytes_backward,
    raw_label AS label
  FROM b
), raw_flows AS (
  SELECT * FROM f
  UNION ALL
  SELECT * FROM f WHERE flow_id % 100 = 0
)
"""


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/events.parquet")


def flows_of(events_table: DataFrame) -> DataFrame:
    """The flow table of an events table; works on a batch and on a stream."""
    spark = events_table.sparkSession
    return spark.sql(f"WITH {FLOW_CTES} SELECT * FROM raw_flows", events=events_table)


def raw_flows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole flow table, derived once per session and read back from the shared folder,
    so that what follows starts from a columnar scan as it would in production."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _written:
        folder = run_folder(spark, "raw-flows")
        flows_of(events(spark, sf_dir)).write.parquet(folder)
        _written[key] = folder
    return spark.read.parquet(_written[key])


def with_stand_in_prediction(derived: DataFrame) -> DataFrame:
    """A prediction any SQL engine can repeat, for checking what follows a classifier."""
    flood = (F.col("tcp_flag_density") > 0.9) & (F.col("total_fwd_packets") > 100)
    prediction = (
        F.when(flood, "DDoS").when(F.col("total_backward_packets") == 0, "PortScan").otherwise("BENIGN")
    )
    return derived.withColumns({
        "prediction": prediction,
        "confidence": F.lit(0.5) + (F.col("flow_id") % 50).cast("double") / F.lit(100.0),
        "anomaly_score": (F.col("flow_id") % 101).cast("double") / F.lit(100.0),
        "is_anomaly": F.col("flow_id") % 101 > 95,
    })
