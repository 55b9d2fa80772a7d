"""Sources, sinks and streams, on files that Spark writes from the flow table first."""

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wireglean.operators import cleaning, features, scoring
from wireglean.plans import oracle as O
from wireglean.plans.catalog import query, rounded
from wireglean.plans.fixtures import raw_flows, with_stand_in_prediction
from wireglean.plans.queries_cleaning import cleaned, clean_rows, totals, _TOTALS
from wireglean.plans.queries_rows import scored
from wireglean.session import run_folder
from wireglean.sources import capture_ranges, csv_flows, tables
from wireglean.streaming import live

_folders: dict = {}

# Three layouts of the same flows: dirty headers, a doubled header, other column sets.
LAYOUTS = [
    (" Flow ID, Destination Port,Protocol,Flow Duration, Flow Bytes/s,Fwd Header Length,Fwd Header Length, Label",
     ["flow_id", "destination_port", "protocol", "flow_duration", "flow_bytes_s", "flow_id % 7", "flow_id % 5", "label"]),
    ("Flow ID,Destination Port,Protocol,Flow Duration,Label",
     ["flow_id", "destination_port", "protocol", "flow_duration", "label"]),
    ("Label,Flow ID,Destination Port,Init_Win_bytes_forward",
     ["label", "flow_id", "destination_port", "init_win_bytes_forward"]),
]
TOO_LONG, TOO_SHORT = "flow_id % 97 = 5", "flow_id % 89 = 7"


def captures(spark, sf_dir):
    """A folder of capture files with some lines too long and some too short."""
    key = (spark.sparkContext.applicationId, sf_dir, "captures")
    if key not in _folders:
        folder = run_folder(spark, "captures")
        for i, (header, cells) in enumerate(LAYOUTS):
            texts = [f"coalesce(CAST({c} AS STRING), '')" for c in cells]
            whole, short = ", ',', ".join(texts), ", ',', ".join(texts[:-1])
            line = (f"CASE WHEN {TOO_LONG} THEN concat({whole}, ',extra') "
                    f"WHEN {TOO_SHORT} THEN concat({short}) ELSE concat({whole}) END")
            # One text column whose name is the header line; no comma in it is a separator to the writer.
            (raw_flows(spark, sf_dir).where(F.col("flow_id") % 3 == i).select(F.expr(line).alias(header))
             .write.option("header", True).option("sep", "\u0001").option("ignoreLeadingWhiteSpace", False)
             .option("ignoreTrailingWhiteSpace", False).csv(f"{folder}/layout{i}"))
        _folders[key] = folder
    return _folders[key]


def bucket_files(spark, sf_dir):
    """One sorted file per eighth of the flows."""
    key = (spark.sparkContext.applicationId, sf_dir, "buckets")
    if key not in _folders:
        folder = run_folder(spark, "buckets")
        rows = raw_flows(spark, sf_dir).select(
            (F.col("flow_id") % 8).alias("bucket"), F.col("flow_id").alias("Flow ID"),
            F.col("destination_port").alias("Destination Port"), F.col("label").alias("Label"))
        (rows.repartition(8, "bucket").sortWithinPartitions("bucket", "Flow ID")
         .write.partitionBy("bucket").option("header", True).csv(folder))
        _folders[key] = folder
    return _folders[key]


def bucket_path(spark, sf_dir, bucket):
    files = csv_flows.csv_files(spark, bucket_files(spark, sf_dir))
    return files.where(F.col("path").contains(f"bucket={bucket}/")).first()["path"]


@query("a1_csv_discovery", O.FLOWS + "SELECT flow_id % 8 AS bucket, CAST(1 AS BIGINT) AS files FROM raw_flows GROUP BY ALL")
def a1(spark, sf_dir):
    files = csv_flows.csv_files(spark, bucket_files(spark, sf_dir))
    bucket = F.regexp_extract("path", "bucket=([0-9]+)", 1).cast("bigint")
    return files.groupBy(bucket.alias("bucket")).agg(F.count("*").alias("files"))


_READ = O.FLOWS + f""", read_rows AS (SELECT flow_id, flow_id % 3 AS layout, destination_port,
  CASE WHEN flow_id % 3 < 2 THEN flow_duration END AS flow_duration,
  CASE WHEN flow_id % 3 = 0 THEN flow_id % 7 END AS fwd_header_length,
  CASE WHEN flow_id % 3 = 0 THEN flow_id % 5 END AS fwd_header_length_1,
  CASE WHEN flow_id % 3 = 2 AND NOT {TOO_SHORT} THEN init_win_bytes_forward END AS init_win_bytes_forward,
  CASE WHEN flow_id % 3 = 2 OR NOT {TOO_SHORT} THEN label END AS label
  FROM raw_flows WHERE NOT {TOO_LONG}) """
_CELLS = ["fwd_header_length", "fwd_header_length_1"]


@query("a2_tolerant_csv", _READ + """SELECT flow_id, CAST(destination_port AS BIGINT) AS destination_port, flow_duration,
  CAST(fwd_header_length AS BIGINT) AS fwd_header_length, CAST(fwd_header_length_1 AS BIGINT) AS fwd_header_length_1,
  init_win_bytes_forward, label FROM read_rows""")
def a2(spark, sf_dir):
    read = csv_flows.load_captures(spark, captures(spark, sf_dir))
    whole = ["flow_id", "destination_port", *_CELLS]
    return read.select(
        *[F.col(c).cast("bigint").alias(c) for c in whole],
        *[F.col(c).cast("double").alias(c) for c in ("flow_duration", "init_win_bytes_forward")], "label")


@query("a2_quoted_line_ends", O.FLOWS + """SELECT flow_id, 'port ' || destination_port || chr(10) || '"' || label || '", ' || chr(10)
  AS note, label FROM raw_flows""")
def a2_quoted(spark, sf_dir):
    """Cells with line ends, quotes and commas, read in ranges that cut through them."""
    folder = run_folder(spark, "quoted")
    note = F.concat(F.lit("port "), "destination_port", F.lit('\n"'), "label", F.lit('", \n'))
    (raw_flows(spark, sf_dir).select(F.col("flow_id").alias("Flow ID"), note.alias(" Note"), F.col("label").alias("Label"))
     .coalesce(2).write.option("header", True).option("escape", '"').option("ignoreTrailingWhiteSpace", False).csv(folder))
    probed = capture_ranges.probe(csv_flows.csv_files(spark, folder), range_bytes=1 << 16)
    return capture_ranges.read(probed, spark).select(F.col("flow_id").cast("bigint").alias("flow_id"), "note", "label")


@query("a5_files_left_out", O.FLOWS + """SELECT flow_id % 8 AS bucket, CASE WHEN flow_id % 8 < 3 THEN 'no header line' END AS reason,
  CASE WHEN flow_id % 8 < 3 THEN 0 ELSE count(*) END AS n FROM raw_flows GROUP BY 1""")
def a5_left_out(spark, sf_dir):
    """A folder in which the files of three buckets are blank: what was read of each file, and why not."""
    folder = run_folder(spark, "some-blank")
    bucket = F.col("flow_id") % 8
    line = F.when(bucket < 3, F.lit("")).otherwise(F.col("flow_id").cast("string"))
    lines = raw_flows(spark, sf_dir).select(bucket.alias("bucket"), line.alias("value"))
    header = spark.range(3, 8).select(F.col("id").alias("bucket"), F.lit("Flow ID").alias("value"))
    # The header sorts behind the digits in falling order only.
    (lines.unionByName(header).repartition(8, "bucket").sortWithinPartitions("bucket", F.desc("value"))
     .write.partitionBy("bucket").text(folder))
    probed = capture_ranges.probe(_as_csv(spark, folder), range_bytes=1 << 16)
    left_out = capture_ranges.left_out(probed)
    of = F.regexp_extract("path", "bucket=([0-9]+)", 1).cast("bigint")
    files = probed.where("start = 0").select("path", of.alias("bucket")).join(left_out, "path", "left")
    read = capture_ranges.read(probed, spark).groupBy((F.col("flow_id").cast("bigint") % 8).alias("bucket")).agg(
        F.count("*").alias("n"))
    return files.groupBy("bucket").agg(F.max("reason").alias("reason")).join(read, "bucket", "left").select(
        "bucket", "reason", F.coalesce("n", F.lit(0)).alias("n"))


def _as_csv(spark, folder):
    listing = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.txt").load(folder)
    return listing.select("path", F.col("length").alias("bytes"))


@query("a3_header_names", _READ + " UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", count({c}) AS filled FROM read_rows"
    for c in ("flow_id", "destination_port", "flow_duration", "init_win_bytes_forward", "label")))
def a3(spark, sf_dir):
    read = csv_flows.load_captures(spark, captures(spark, sf_dir))
    names = [c for c in read.columns if c not in (*_CELLS, "protocol", "flow_bytes_s", "source_file")]
    row = read.agg(*[F.count(c).alias(c) for c in names])
    return row.select(F.inline(F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).alias("filled")) for c in names])))


@query("a4_duplicate_headers", _READ + """SELECT CAST(sum(fwd_header_length) AS BIGINT) AS first,
  CAST(sum(fwd_header_length_1) AS BIGINT) AS second FROM read_rows""")
def a4(spark, sf_dir):
    read = csv_flows.load_captures(spark, captures(spark, sf_dir))
    return read.agg(F.sum(F.col("fwd_header_length").cast("bigint")).alias("first"),
                    F.sum(F.col("fwd_header_length_1").cast("bigint")).alias("second"))


@query("a5_union_of_captures", _READ + """SELECT layout, count(*) AS n, count(flow_duration) AS with_duration, count(*) AS with_source
  FROM read_rows GROUP BY layout""")
def a5(spark, sf_dir):
    read = csv_flows.load_captures(spark, captures(spark, sf_dir))
    return read.groupBy((F.col("flow_id").cast("bigint") % 3).alias("layout")).agg(
        F.count("*").alias("n"), F.count("flow_duration").alias("with_duration"),
        F.count("source_file").alias("with_source"))


@query("a6_rows_per_file", O.FLOWS + """SELECT flow_id, label FROM (SELECT flow_id, label,
  row_number() OVER (PARTITION BY flow_id % 8 ORDER BY flow_id) AS place FROM raw_flows) WHERE place <= 40""")
def a6(spark, sf_dir):
    read = csv_flows.load_captures(spark, bucket_files(spark, sf_dir), rows_per_file=40)
    return read.select(F.col("flow_id").cast("bigint").alias("flow_id"), "label")


@query("a7_label_column", O.LABELLED + "SELECT label, count(*) AS n FROM labelled GROUP BY label")
def a7(spark, sf_dir):
    renamed = raw_flows(spark, sf_dir).withColumnRenamed("label", "class").withColumn("attack_category", F.lit("x"))
    return cleaning.labelled_rows(renamed).groupBy("label").agg(F.count("*").alias("n"))


@query("a8_clean_table_sink", O.DISTINCT + f"SELECT label, {_TOTALS} FROM cleaned GROUP BY label")
def a8(spark, sf_dir):
    folder = run_folder(spark, "clean")
    tables.write_clean(clean_rows(spark, sf_dir), folder)
    return totals(tables.read_clean(spark, folder), "label")


@query("a9_clean_table_from_csv", O.DISTINCT + f"SELECT label, {_TOTALS} FROM cleaned GROUP BY label")
def a9(spark, sf_dir):
    folder = run_folder(spark, "clean") + ".csv"
    tables.write_scored_csv(clean_rows(spark, sf_dir), folder)
    return totals(tables.read_clean(spark, folder), "label")


def each_bucket(build):
    """What ``build`` makes of every eighth of the flows, as one table."""
    return reduce(DataFrame.unionByName, [build(bucket).withColumn("bucket", F.lit(bucket).cast("bigint")) for bucket in range(8)])


@query("a10_sample_file", O.FLOWS + "SELECT flow_id % 8 AS bucket, label, count(*) AS n FROM raw_flows GROUP BY ALL")
def a10(spark, sf_dir):
    return each_bucket(lambda bucket: csv_flows.load_sample(spark, bucket_path(spark, sf_dir, bucket)).groupBy("label").agg(
        F.count("*").alias("n")))


@query("a11_report_round_trip", O.DISTINCT + """SELECT (SELECT count(*) FROM raw_flows) AS rows_in,
  (SELECT count(*) FROM cleaned) AS rows_out, 'urg_flag_count' AS constant,
  (SELECT n FROM class_sizes WHERE label = 'BENIGN') AS benign""")
def a11(spark, sf_dir):
    report = cleaned(spark, sf_dir)[1].to_frame(spark)
    folder = run_folder(spark, "report")
    tables.write_report(report, folder)
    read = tables.read_report(spark, folder, report.schema)
    return read.select("rows_in", "rows_out", F.array_join("constant_columns_dropped", ",").alias("constant"),
                       F.col("class_counts")["BENIGN"].alias("benign"))


@query("a12_scored_csv", O.SCORED + """SELECT flow_id, prediction, CAST(risk_score AS BIGINT) AS risk_score, risk_level,
  CASE WHEN len(indicator_list) > 0 THEN array_to_string(indicator_list, '; ') END AS indicators FROM scored""")
def a12(spark, sf_dir):
    folder = run_folder(spark, "scored") + ".csv"
    tables.write_scored_csv(scoring.result_table(scored(spark, sf_dir), keep=["flow_id"]), folder)
    schema = "flow_id bigint, prediction string, confidence double, risk_score bigint, risk_level string, " \
             "anomaly_score double, is_anomaly boolean, is_malicious boolean, indicators string"
    read = spark.read.schema(schema).option("header", True).csv(folder)
    # An empty text is quoted in the file and read back as an empty text.
    return read.select("flow_id", "prediction", "risk_score", "risk_level",
                       F.nullif("indicators", F.lit("")).alias("indicators"))


# Eight uploads, which together hold all flows; the row limit is what an upload is checked for.
@query("a13_intake", O.FLOWS + """, posted AS (SELECT flow_id, flow_id % 8 AS bucket,
    row_number() OVER (PARTITION BY flow_id % 8 ORDER BY flow_id) AS place,
    count(*) OVER (PARTITION BY flow_id % 8) AS rows_received FROM raw_flows)
  SELECT bucket, flow_id, rows_received, rows_received > 300 AS truncated FROM posted WHERE place <= 300""")
def a13(spark, sf_dir):
    def upload(bucket):
        kept, facts = tables.read_upload(spark, bucket_path(spark, sf_dir, bucket), max_rows=300)
        return kept.select(F.col("flow_id").cast("bigint").alias("flow_id"),
                           F.lit(facts["rows_received"]).cast("bigint").alias("rows_received"),
                           F.lit(facts["truncated"]).alias("truncated"))

    return each_bucket(upload)


# --- streams ---------------------------------------------------------------------


def flow_files(spark, sf_dir):
    """The flow table as a folder of several files, in time order."""
    key = (spark.sparkContext.applicationId, sf_dir, "stream")
    if key not in _folders:
        folder = run_folder(spark, "arriving")
        raw_flows(spark, sf_dir).repartitionByRange(4, "timestamp").write.parquet(folder)
        _folders[key] = folder
    return _folders[key]


def scored_stream(spark, sf_dir, files_per_trigger=2):
    folder = flow_files(spark, sf_dir)
    arriving = live.flow_stream(spark, folder, spark.read.parquet(folder).schema, files_per_trigger)
    derived = features.with_derived_features(cleaning.labelled_rows(arriving))
    return scoring.with_risk(with_stand_in_prediction(derived))


def appended(spark, stream, purpose):
    folder = run_folder(spark, purpose)
    live.append_to(stream, f"{folder}/rows", f"{folder}/checkpoint").awaitTermination()
    return spark.read.schema(stream.schema).parquet(f"{folder}/rows")


@query("m1_scored_stream", O.SCORED + "SELECT flow_id, prediction, CAST(risk_score AS BIGINT) AS risk_score, risk_level FROM scored")
def m1(spark, sf_dir):
    stream = scored_stream(spark, sf_dir).select("flow_id", "prediction", "risk_score", "risk_level")
    return rounded(appended(spark, stream, "scored-stream"))


@query("m2_running_counters", O.PREDICTED + """SELECT count(*) AS analysed,
  count(*) FILTER (WHERE prediction <> 'BENIGN') AS threats FROM predicted""")
def m2(spark, sf_dir):
    folder = run_folder(spark, "counters")
    table = live.LatestTable(f"{folder}/rows")
    live.keep_counters(scored_stream(spark, sf_dir), table, f"{folder}/checkpoint").awaitTermination()
    return table.read(spark)


@query("m3_recent_events", O.SCORED + """SELECT flow_id, prediction, CAST(risk_score AS BIGINT) AS risk_score FROM scored
  ORDER BY timestamp DESC, flow_id DESC LIMIT 15""")
def m3(spark, sf_dir):
    folder = run_folder(spark, "recent")
    table = live.LatestTable(f"{folder}/rows")
    stream = scored_stream(spark, sf_dir).select("flow_id", "timestamp", "prediction", "risk_score")
    live.keep_recent(stream, table, f"{folder}/checkpoint").awaitTermination()
    return rounded(table.read(spark).drop("timestamp"))


@query("m4_alerts", O.SCORED + """SELECT flow_id, prediction AS attack, CAST(risk_score AS BIGINT) AS risk_score, risk_level
  FROM scored WHERE prediction <> 'BENIGN'""")
def m4(spark, sf_dir):
    stream = live.alerts(scored_stream(spark, sf_dir)).drop("timestamp")
    return rounded(appended(spark, stream, "alerts"))


@query("m5_window_counts", O.PREDICTED + """, w AS (SELECT time_bucket(INTERVAL '30 minutes', timestamp) AS bucket, count(*) AS total,
    count(*) FILTER (WHERE prediction <> 'BENIGN') AS malicious FROM predicted GROUP BY ALL)
  SELECT strftime(bucket, '%Y-%m-%d %H:%M') AS bucket, total, malicious, total - malicious AS benign FROM w
  WHERE bucket + INTERVAL '30 minutes' <= (SELECT max(timestamp) - INTERVAL '1 hour' FROM predicted)""")
def m5(spark, sf_dir):
    stream = live.window_counts(scored_stream(spark, sf_dir, files_per_trigger=None))
    found = appended(spark, stream, "windows")
    return found.withColumn("bucket", F.date_format("bucket", "yyyy-MM-dd HH:mm"))


@query("m5_filled_window_counts", O.PREDICTED + """, part AS (SELECT * FROM predicted WHERE hour(timestamp) % 6 <> 3),
  w AS (SELECT time_bucket(INTERVAL '30 minutes', timestamp) AS bucket, count(*) AS total,
    count(*) FILTER (WHERE prediction <> 'BENIGN') AS malicious FROM part GROUP BY ALL),
  line AS (SELECT unnest(generate_series(min(bucket), max(bucket), INTERVAL '30 minutes')) AS bucket FROM w)
  SELECT strftime(bucket, '%Y-%m-%d %H:%M') AS bucket, coalesce(total, 0) AS total, coalesce(malicious, 0) AS malicious,
    coalesce(total - malicious, 0) AS benign FROM line LEFT JOIN w USING (bucket)
  WHERE bucket + INTERVAL '30 minutes' <= (SELECT max(timestamp) - INTERVAL '1 hour' FROM part)""")
def m5_filled(spark, sf_dir):
    """A file a tick without one hour in six; then, in a second run, a file of flows that come too late to count."""
    source, out = run_folder(spark, "gaps"), run_folder(spark, "filled")
    files = spark.read.parquet(flow_files(spark, sf_dir))
    on_time = files.where(F.hour("timestamp") % 6 != 3)
    cuts = on_time.agg(F.percentile_approx("timestamp", [0.25, 0.5, 0.75])).first()[0]
    bounds = [None, *cuts, None]
    parts = [on_time.where((F.lit(a is None) | (F.col("timestamp") > F.lit(a))) & (F.lit(b is None) | (F.col("timestamp") <= F.lit(b))))
             for a, b in zip(bounds, bounds[1:])]
    for run in (parts, parts[:1]):
        for i, part in enumerate(run):
            part.coalesce(1).write.mode("append").parquet(source)
        arriving = live.flow_stream(spark, source, files.schema, 1)
        scored = scoring.with_risk(with_stand_in_prediction(features.with_derived_features(cleaning.labelled_rows(arriving))))
        counts = live.filled_window_counts(scored)
        live.append_to(counts, f"{out}/rows", f"{out}/checkpoint").awaitTermination()
    found = spark.read.schema(counts.schema).parquet(f"{out}/rows")
    return found.withColumn("bucket", F.date_format("bucket", "yyyy-MM-dd HH:mm"))
