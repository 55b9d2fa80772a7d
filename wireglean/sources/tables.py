"""Cleaned tables, reports and scored tables on storage."""

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wireglean import taxonomy as tax
from wireglean.sources.csv_flows import csv_files, first_rows, header_of, read_group
from wireglean.functions.text import snake_headers


#: Where a CSV table keeps its schema.
SCHEMA_FILE = "_schema.json"


def write_clean(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").parquet(path)


def read_clean(spark: SparkSession, path: str) -> DataFrame:
    """A cleaned table: CSV by its suffix, parquet otherwise.

    A CSV table written by this library is read by the schema recorded in it; of others the types are inferred.
    """
    if not path.rstrip("/").endswith(".csv"):
        return spark.read.parquet(path)
    system, place = _file(spark, f"{path.rstrip('/')}/{SCHEMA_FILE}")
    reader = spark.read.option("header", True)
    if not system.exists(place):
        return reader.option("inferSchema", True).csv(path)
    recorded = system.open(place)
    text = spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(recorded, "UTF-8")
    recorded.close()
    return reader.schema(T.StructType.fromJson(json.loads(text))).csv(path)


def _file(spark: SparkSession, path: str):
    """(file system, path) of a small file beside a table's own."""
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), place


def write_report(report: DataFrame, path: str) -> None:
    """A report table (few rows) as one JSON-lines file."""
    report.coalesce(1).write.mode("overwrite").json(path)


def read_report(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.json(path)


def write_scored_csv(scored: DataFrame, path: str) -> None:
    """The scored table as CSV, with its schema recorded beside the rows; nested columns become JSON text."""
    nested = (T.ArrayType, T.MapType, T.StructType)
    flat = [
        F.to_json(f.name).alias(f.name) if isinstance(f.dataType, nested) else F.col(f.name)
        for f in scored.schema.fields
    ]
    table = scored.select(*flat)
    table.write.mode("overwrite").option("header", True).csv(path)
    # Readers skip names that begin so.
    system, place = _file(scored.sparkSession, f"{path.rstrip('/')}/{SCHEMA_FILE}")
    out = system.create(place, True)
    out.write(bytearray(table.schema.json().encode()))
    out.close()


class IntakeError(ValueError):
    """An upload that is refused before any row is scored."""


def check_upload(spark: SparkSession, path: str, max_mb: float = tax.MAX_UPLOAD_MB) -> None:
    """Refuse what is no ``.csv``, is empty or is too large; looks at the listing only."""
    if not path.lower().endswith(".csv"):
        raise IntakeError("only .csv files are accepted")
    listed = csv_files(spark, path).agg(F.sum("bytes").alias("bytes")).first()["bytes"]
    if not listed:
        raise IntakeError("file is missing or empty")
    if listed > max_mb * 1024 * 1024:
        raise IntakeError(f"file exceeds the {max_mb:g} MB limit")


def read_upload(spark: SparkSession, path: str,
                max_rows: int = tax.MAX_UPLOAD_ROWS) -> tuple[DataFrame, dict]:
    """The first ``max_rows`` rows of one upload, and (rows_received, truncated)."""
    check_upload(spark, path)
    header = header_of(spark, path)
    if not header:
        raise IntakeError("file has no header")
    rows = read_group(spark, [path], snake_headers(header))
    received = rows.count()
    if received == 0:
        raise IntakeError("file has no rows")
    truncated = received > max_rows
    kept = first_rows(rows, max_rows) if truncated else rows
    return kept.drop("_path", "_block", "source_file"), {"rows_received": received, "truncated": truncated}


def preview(scored: DataFrame, rows: int = 100) -> DataFrame:
    """Up to ``rows`` result rows, highest risk first, as a batch answer shows them."""
    if not 0 <= rows <= tax.MAX_PREVIEW_ROWS:
        raise IntakeError(f"preview must be between 0 and {tax.MAX_PREVIEW_ROWS} rows")
    columns = [c for c in tax.RESULT_COLUMNS if c in scored.columns and c != "indicators"]
    first = [F.desc(c) for c in ("risk_score", "confidence") if c in columns]
    return scored.select(*columns).orderBy(*first, *[c for c in columns if c not in ("risk_score", "confidence")]).limit(rows)


