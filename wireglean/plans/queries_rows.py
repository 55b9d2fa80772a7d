"""Row-wise operators: labels, ports, derived features, validation, projections."""

from pyspark.sql import functions as F

from wireglean import taxonomy as tax
from wireglean.functions import risk
from wireglean.functions.numbers import number_or
from wireglean.functions.text import display_name, masked_ip
from wireglean.functions.traffic import port_category, protocol_name
from wireglean.operators import cleaning, features, validation
from wireglean.operators.scoring import high_risk, malicious, with_risk
from wireglean.plans import oracle as O
from wireglean.plans.catalog import query, r6, rounded
from wireglean.plans.fixtures import raw_flows, with_stand_in_prediction


def labelled(spark, sf_dir):
    return cleaning.labelled_rows(raw_flows(spark, sf_dir))


def derived(spark, sf_dir):
    return features.with_derived_features(labelled(spark, sf_dir))


def predicted(spark, sf_dir):
    return with_stand_in_prediction(derived(spark, sf_dir))


def scored(spark, sf_dir):
    return with_risk(predicted(spark, sf_dir))


@query("a0_raw_flows", O.FLOWS + "SELECT " + ", ".join(
    ["flow_id", "source_ip", "destination_ip", "destination_port", "protocol", "label"]
    + [f"round({c}, 6) AS {c}" for c in tax.CORE_FEATURES if c not in ("destination_port", "protocol", *O.RATES)]
    + [f"CASE WHEN isinf({c}) THEN -1 ELSE round({c}, 3) END AS {c}" for c in O.RATES]) + " FROM raw_flows")
def a0(spark, sf_dir):
    flows = raw_flows(spark, sf_dir).drop("timestamp")
    rates = {c: F.when(F.col(c) == float("inf"), -1.0).otherwise(F.round(c, 3)) for c in O.RATES}
    return rounded(flows.withColumns(rates))


@query("b1_label_family", O.FLOWS + f"SELECT flow_id, {O.family_sql('label')} AS family FROM raw_flows")
def b1(spark, sf_dir):
    return cleaning.with_families(raw_flows(spark, sf_dir)).select("flow_id", F.col("label").alias("family"))


@query("b2_binary_target", O.LABELLED
       + "SELECT flow_id, CAST(label <> 'BENIGN' AS BIGINT) AS is_attack FROM labelled")
def b2(spark, sf_dir):
    return rounded(features.with_binary_target(labelled(spark, sf_dir)).select("flow_id", "is_attack"))


DIRTY_TEXT = """CASE WHEN flow_id % 11 = 0 THEN 'n/a' WHEN flow_id % 13 = 0 THEN 'NaN'
                     ELSE CAST(destination_port AS {text}) END"""


@query("b3_safe_number", O.FLOWS + f""", t AS (SELECT flow_id, {DIRTY_TEXT.format(text='VARCHAR')} AS p FROM raw_flows),
  n AS (SELECT flow_id, try_cast(p AS DOUBLE) AS v FROM t)
  SELECT flow_id, CASE WHEN v IS NULL OR isnan(v) THEN -1 ELSE v END AS port, 0.0::DOUBLE AS absent FROM n""")
def b3(spark, sf_dir):
    text = F.expr(DIRTY_TEXT.format(text="STRING"))
    table = raw_flows(spark, sf_dir).select("flow_id", text.alias("destination_port"))
    return table.select(
        "flow_id", number_or(table.columns, "destination_port", -1.0).alias("port"),
        number_or(table.columns, "no_such_column").alias("absent"),
    )


PORT = "CASE WHEN flow_id % 17 = 0 THEN 70000 WHEN flow_id % 19 = 0 THEN NULL " \
       "WHEN flow_id % 23 = 0 THEN -5 WHEN flow_id % 29 = 0 THEN flow_id % 65536 ELSE destination_port END"


@query("b4_port_category", O.FLOWS + f", t AS (SELECT flow_id, {PORT} AS port FROM raw_flows) "
       f"SELECT flow_id, {O.port_sql('port')} AS category FROM t")
def b4(spark, sf_dir):
    table = raw_flows(spark, sf_dir).select("flow_id", F.expr(PORT).cast("double").alias("port"))
    return table.select("flow_id", port_category("port").alias("category"))


PROTOCOL = "CASE WHEN flow_id % 31 = 0 THEN NULL WHEN flow_id % 37 = 0 THEN flow_id % 100 ELSE protocol END"


@query("b5_protocol_name", O.FLOWS + f", t AS (SELECT flow_id, {PROTOCOL} AS p FROM raw_flows) "
       f"SELECT flow_id, {O.protocol_sql('p')} AS protocol FROM t")
def b5(spark, sf_dir):
    table = raw_flows(spark, sf_dir).select("flow_id", F.expr(PROTOCOL).alias("p"))
    return table.select("flow_id", protocol_name("p").alias("protocol"))


def _derived_query(name: str, columns: list[str]):
    shown = [f"CAST({c} AS BIGINT) AS {c}" if c == "is_ephemeral_port" else c if c in tax.CATEGORICAL_FEATURES
             else f"round({c}, {6 if c == 'duration_seconds' else 4}) AS {c}" for c in columns]

    @query(name, O.FLOWS + f", derived AS ({O.derived_from('raw_flows')}) SELECT flow_id, {', '.join(shown)} FROM derived")
    def build(spark, sf_dir):
        table = features.with_derived_features(raw_flows(spark, sf_dir))
        exact = [r6(c).alias(c) if c == "duration_seconds" else F.col(c) for c in columns]
        # A duration has six decimals, so a sixth digit never lies on a tie; rates are long.
        four = [c for c in columns if dict(table.dtypes)[c] == "double" and c != "duration_seconds"]
        return table.select("flow_id", *exact).withColumns(
            {c: F.round(c, 4) for c in four} | {c: F.col(c).cast("bigint") for c in columns if c == "is_ephemeral_port"}
        )

    return build


_derived_query("b6_duration_seconds", ["duration_seconds"])
_derived_query("b7_rates", ["packets_per_second", "bytes_per_second"])
_derived_query("b8_direction_ratios", ["fwd_bwd_packet_ratio", "fwd_bwd_byte_ratio"])
_derived_query("b9_packet_size", ["avg_packet_size_derived", "bytes_per_packet"])
_derived_query("b10_flag_density", ["tcp_flag_density"])
_derived_query("b11_ephemeral_port", ["is_ephemeral_port"])
_derived_query("b12_derived_features", [*tax.DERIVED_FEATURES, *tax.CATEGORICAL_FEATURES])


@query("b13_masked_endpoints", O.FLOWS + """SELECT flow_id,
  string_split(source_ip, '.')[1] || '.' || string_split(source_ip, '.')[2] || '.x.x' AS source,
  CASE WHEN flow_id % 7 = 0 THEN 'gateway-' || CAST(flow_id AS VARCHAR)
       ELSE string_split(destination_ip, '.')[1] || '.' || string_split(destination_ip, '.')[2] || '.x.x' END
    AS destination FROM raw_flows""")
def b13(spark, sf_dir):
    named = F.when(F.col("flow_id") % 7 == 0, F.concat(F.lit("gateway-"), F.col("flow_id").cast("string")))
    table = raw_flows(spark, sf_dir).withColumn("peer", F.coalesce(named, F.col("destination_ip")))
    return table.select("flow_id", masked_ip("source_ip").alias("source"), masked_ip("peer").alias("destination"))


SPOILED = {
    "destination_port": "CASE WHEN flow_id % 41 = 0 THEN NULL WHEN flow_id % 43 = 0 THEN 70000 "
                        "WHEN flow_id % 47 = 0 THEN -1 ELSE destination_port END",
    "protocol": "CASE WHEN flow_id % 53 = 0 THEN 999 WHEN flow_id % 59 = 0 THEN NULL ELSE protocol END",
    "total_fwd_packets": "CASE WHEN flow_id % 61 = 0 THEN -5 ELSE total_fwd_packets END",
    "init_win_bytes_forward": "CASE WHEN flow_id % 67 = 0 THEN -2 ELSE init_win_bytes_forward END",
}


def _bound_sql(field: str) -> str:
    low, high = tax.FIELD_BOUNDS[field]
    missing = f"WHEN {field} IS NULL THEN 'missing'" if field in tax.REQUIRED_FIELDS else ""
    number = f"CAST({field} AS DOUBLE)"
    return (f"SELECT flow_id, '{field}' AS field, CASE {missing} WHEN isinf({number}) THEN 'not finite' "
            f"WHEN {number} < {low} THEN 'below {low:g}' WHEN {number} > {high} THEN 'above {high:g}' END AS reason FROM s")


@query("b14_validation", O.FLOWS + ", s AS (SELECT * REPLACE ("
       + ", ".join(f"{sql} AS {c}" for c, sql in SPOILED.items()) + ") FROM raw_flows), bad AS ("
       + " UNION ALL ".join(_bound_sql(f) for f in tax.FIELD_BOUNDS)
       + ") SELECT flow_id, field, reason FROM bad WHERE reason IS NOT NULL")
def b14(spark, sf_dir):
    spoiled = raw_flows(spark, sf_dir).withColumns({c: F.expr(sql) for c, sql in SPOILED.items()})
    _, refused = validation.valid_and_refused(spoiled)
    return refused.select("flow_id", F.inline("problems"))


@query("b15_inference_projection", O.FLOWS + """SELECT flow_id, destination_port, round(flow_duration, 6) AS flow_duration,
  CASE WHEN isinf(flow_bytes_s) THEN NULL ELSE round(flow_bytes_s, 3) END AS flow_bytes_s,
  CAST(NULL AS DOUBLE) AS init_win_bytes_forward FROM raw_flows""")
def b15(spark, sf_dir):
    posted = raw_flows(spark, sf_dir).select(
        "flow_id", F.col("flow_bytes_s").alias("Flow Bytes/s"), F.col("destination_port").alias(" Destination Port"),
        F.col("flow_duration").alias("Flow Duration "), F.col("label").alias("Vendor Note"),
    )
    expected = ["destination_port", "flow_duration", "flow_bytes_s", "init_win_bytes_forward"]
    table = features.for_inference(posted, expected, keep=["flow_id"])
    return table.withColumns({"flow_duration": r6("flow_duration"), "flow_bytes_s": F.round("flow_bytes_s", 3)})


_FILLED = ", ".join(f"count({c}) AS n_{c}" for c in tax.CORE_FEATURES)


@query("b16_feature_selection", O.FLOWS + ", n AS (SELECT " + _FILLED + " FROM raw_flows) "
       + " UNION ALL ".join(f"SELECT CAST({i} AS BIGINT) AS position, '{c}' AS feature, n_{c} AS filled FROM n"
                            for i, c in enumerate(tax.CORE_FEATURES)))
def b16(spark, sf_dir):
    flows = raw_flows(spark, sf_dir)
    chosen = features.feature_columns(flows)
    row = flows.select(*chosen).agg(*[F.count(c).alias(c) for c in chosen])
    return row.select(F.inline(F.array(*[
        F.struct(F.lit(i).cast("bigint").alias("position"), F.lit(c).alias("feature"), F.col(c).alias("filled"))
        for i, c in enumerate(chosen)
    ])))


@query("b17_features_and_target", O.LABELLED + "SELECT label, count(*) AS n FROM labelled GROUP BY label")
def b17(spark, sf_dir):
    _, target = features.features_and_target(labelled(spark, sf_dir))
    return target.groupBy("label").agg(F.count("*").alias("n"))


@query("b18_anomaly_band", O.PREDICTED + """SELECT flow_id, CASE WHEN anomaly_score < 0.35::DOUBLE THEN 'NORMAL'
  WHEN anomaly_score < 0.70::DOUBLE THEN 'SUSPICIOUS' ELSE 'CRITICAL' END AS band FROM predicted""")
def b18(spark, sf_dir):
    return predicted(spark, sf_dir).select("flow_id", risk.anomaly_band().alias("band"))


@query("b19_display_name", O.DERIVED + f""", named AS (
  SELECT 'port_category_' || port_category AS feature FROM derived UNION ALL
  SELECT 'protocol_' || protocol FROM derived UNION ALL
  SELECT unnest([{O.quoted([*tax.CORE_FEATURES, *tax.DERIVED_FEATURES])}])
  FROM (SELECT 1 FROM derived LIMIT 1))
  SELECT feature, {O.display_sql('feature')} AS shown, count(*) AS n FROM named GROUP BY ALL""")
def b19(spark, sf_dir):
    table = derived(spark, sf_dir)
    names = [c for c in dict.fromkeys([*tax.CORE_FEATURES, *tax.DERIVED_FEATURES]) if c in table.columns]
    encoded = F.array(F.concat(F.lit("port_category_"), "port_category"), F.concat(F.lit("protocol_"), "protocol"))
    plain = spark.createDataFrame([(c,) for c in names], "feature string")
    features_seen = table.select(F.explode(encoded).alias("feature")).unionByName(plain)
    return features_seen.groupBy("feature").agg(F.count("*").alias("n")).select(
        "feature", display_name("feature").alias("shown"), "n")


@query("b20_high_risk_filter", O.SCORED + """SELECT flow_id, prediction, CAST(risk_score AS BIGINT) AS risk_score, risk_level
  FROM scored WHERE risk_level IN ('HIGH', 'CRITICAL') AND prediction <> 'BENIGN'""")
def b20(spark, sf_dir):
    found = malicious(high_risk(scored(spark, sf_dir)))
    return rounded(found.select("flow_id", "prediction", "risk_score", "risk_level"))
