"""The jobs a user runs: prepare captures, train, score tables, uploads and streams, and write reports."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from wireglean import taxonomy as tax
from wireglean.operators import cleaning, reports, scoring, validation
from wireglean.operators.models import ModelSettings
from wireglean.plans import training
from wireglean.plans.scoring_job import Scorer
from wireglean.sources import csv_flows, tables
from wireglean.streaming import live


def prepare(spark: SparkSession, raw: str, output: str, report: str | None = None,
            rows_per_file: int | None = None, least: int = tax.MIN_CLASS_ROWS,
            multi_line: bool = False) -> cleaning.CleaningReport:
    """Captures (a folder of CSV files, or one file) to a clean parquet table and its report.

    Files that were left out are listed, with the reason, in a table beside the report (``…-left-out``). With
    ``multi_line`` quoted cells may hold line ends.
    """
    one_file = raw.lower().endswith(".csv")
    left_out: list[DataFrame] = []
    flows = csv_flows.load_captures(
        spark, None if one_file else raw, [raw] if one_file else None, rows_per_file, multi_line, left_out)
    table, found = cleaning.clean(flows, least=least, untyped_text=True)
    tables.write_clean(table, output)
    if report:
        tables.write_report(found.to_frame(spark), report)
        tables.write_report(left_out[0], f"{report.rstrip('/')}-left-out")
    return found


def train(spark: SparkSession, clean: str, bundle: str, report: str | None = None, core_only: bool = True,
          cap: int | None = tax.CLASS_CAP, cross_validate: bool = False,
          selection_metric: str = "macro_f1", settings: ModelSettings | None = None) -> dict:
    """A clean table to a saved bundle and the training report."""
    table = tables.read_clean(spark, clean)
    if "label" not in table.columns:
        raise KeyError("the table has no label column: prepare it first")
    fitted, document = training.train(table, settings, core_only, cap, cross_validate,
                                      selection_metric=selection_metric)
    fitted.save(spark, bundle)
    if report:
        tables.write_report(training.json_table(spark, document), report)
    return document


def score(spark: SparkSession, flows: str, bundle: str, output: str, use_detector: bool = True) -> DataFrame:
    """A table of flows (CSV or parquet) to its scored form; returns the one-row summary."""
    table = csv_flows.load_sample(spark, flows) if flows.lower().endswith(".csv") else spark.read.parquet(flows)
    scorer = Scorer(training.Bundle.load(spark, bundle), use_detector)
    scored = scorer.append(table)
    if output.lower().endswith(".csv"):
        tables.write_scored_csv(scored, output)
        return scoring.summary(spark.read.schema(_flat(scored)).option("header", True).csv(output))
    scored.write.mode("overwrite").parquet(output)
    return scoring.summary(spark.read.parquet(output))


def _flat(table: DataFrame) -> T.StructType:
    """The schema of a table's CSV form, where nested columns are JSON text."""
    nested = (T.ArrayType, T.MapType, T.StructType)
    return T.StructType([T.StructField(f.name, T.StringType() if isinstance(f.dataType, nested) else f.dataType)
                         for f in table.schema.fields])


def score_upload(spark: SparkSession, path: str, bundle: str, output: str, max_rows: int = tax.MAX_UPLOAD_ROWS,
                 preview_rows: int = 100, explain: bool = False, use_detector: bool = True) -> dict:
    """One uploaded CSV: limits, validation, scoring, summary and preview in one path.

    Scored rows go to ``output/scored`` (with ``explain`` also the reasons of each class), refused ones with
    their problems to ``output/refused``. Returns rows_received, truncated, rows_refused, and the tables summary
    and preview.
    """
    table, facts = tables.read_upload(spark, path, max_rows)
    valid, refused = validation.valid_and_refused(table)
    scorer = Scorer(training.Bundle.load(spark, bundle), use_detector)
    scored = scorer.score(valid, explain=explain)
    kept = [c for c in ("top_features", "explanation", "explanation_method") if c in scored.columns]
    result = scored.select("input_row.*", *[c.alias(f"result_{n}" if n in valid.columns else n)
                                            for n, c in scoring.result_columns(scored).items()], *kept)
    result.write.mode("overwrite").parquet(f"{output}/scored")
    refused.write.mode("overwrite").parquet(f"{output}/refused")
    written = spark.read.parquet(f"{output}/scored")
    return {**facts, "rows_refused": spark.read.parquet(f"{output}/refused").count(),
            "summary": scoring.summary(written), "preview": tables.preview(written, preview_rows)}


def stream(spark: SparkSession, folder: str, bundle: str, output: str, every: str | None = None,
           files_per_tick: int | None = None) -> list[StreamingQuery]:
    """Score parquet flows as they arrive: all rows, alerts, running counters and recent events below ``output``.

    With ``every`` (such as "10 seconds") the queries go on until they are stopped, otherwise they end with what is
    there. The folder holds at least one file when the job starts, whose columns all files have.
    """
    scorer = Scorer(training.Bundle.load(spark, bundle))
    schema = spark.read.parquet(folder).schema
    scored = scorer.append(live.flow_stream(spark, folder, schema, files_per_tick))
    mark = lambda name: f"{output}/checkpoints/{name}"
    queries = [live.append_to(scored, f"{output}/scored", mark("scored"), every),
               live.append_to(live.alerts(scored), f"{output}/alerts", mark("alerts"), every),
               live.keep_counters(scored, live.LatestTable(f"{output}/counters"), mark("counters"), every)]
    if {"timestamp", "flow_id"} <= set(schema.names):
        queries.append(live.keep_recent(scored, live.LatestTable(f"{output}/recent"), mark("recent"), every=every))
    return queries


def write_reports(spark: SparkSession, clean: str | None, scored: str | None, output: str) -> list[str]:
    """The report tables of a clean table and of a scored one, each a folder below ``output``; returns their names."""
    found: dict[str, DataFrame] = {}
    if clean:
        table = tables.read_clean(spark, clean)
        found |= {"column_profile": reports.column_profile(table), "duplicate_rows": reports.duplicate_rows(table),
                  "numeric_summary": reports.numeric_summary(table), "class_shares": cleaning.class_shares(table),
                  "class_distribution": reports.class_distribution(table)}
        pairs = reports.correlations(table)
        found |= {"correlations": pairs, "strong_pairs": reports.strong_pairs(pairs)}
        if "destination_port" in table.columns:
            found["top_ports"] = reports.top_values(table, "destination_port", 20)
    if scored:
        table = spark.read.parquet(scored)
        found |= {"attacks": reports.distribution(scoring.malicious(table), "prediction"),
                  "levels": reports.distribution(table, "risk_level"), "summary": scoring.summary(table)}
        if "timestamp" in table.columns:
            found["timeline"] = reports.timeline(table)
    for name, report in found.items():
        report.select(*[F.col(f"`{c}`").cast("string").alias(c) if t == "void" else F.col(f"`{c}`") for c, t in report.dtypes]
                      ).write.mode("overwrite").parquet(f"{output}/{name}")
    return sorted(found)
