"""Derived features, column selection and the row-preserving inference projection."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wireglean import taxonomy as tax
from wireglean.functions.numbers import finite
from wireglean.functions.text import snake_headers
from wireglean.functions.traffic import derived_columns, readings


def with_derived_features(flows: DataFrame) -> DataFrame:
    """Add all derived features; ``protocol`` becomes its name. Projections only."""
    read = readings(flows.columns)
    return flows.withColumns(read).withColumns(derived_columns(flows.columns)).drop(*read)


def with_binary_target(flows: DataFrame, label: str = "label") -> DataFrame:
    """Add ``is_attack``: 1 for every label but BENIGN."""
    return flows.withColumn("is_attack", (F.col(label) != tax.BENIGN).cast("tinyint"))


def numeric_columns(flows: DataFrame) -> list[str]:
    return [f.name for f in flows.schema.fields if isinstance(f.dataType, T.NumericType)]


def feature_columns(flows: DataFrame, core_only: bool = True) -> list[str]:
    """Model inputs: the core features present, or every numeric column that is no identifier."""
    if core_only:
        return [c for c in tax.CORE_FEATURES if c in flows.columns]
    return [c for c in numeric_columns(flows) if c != "label" and c not in tax.LEAKAGE_COLUMNS]


def missing_core_features(flows: DataFrame) -> DataFrame:
    """The core features the table lacks, one row each."""
    absent = [(i, c) for i, c in enumerate(tax.CORE_FEATURES) if c not in flows.columns]
    return flows.sparkSession.createDataFrame(absent, "position int, feature string")


def features_and_target(flows: DataFrame, label: str = "label") -> tuple[DataFrame, DataFrame]:
    if label not in flows.columns:
        raise KeyError(f"no column {label!r} to split off")
    return flows.drop(label), flows.select(label)


def normalised_headers(flows: DataFrame) -> DataFrame:
    return flows.toDF(*snake_headers(flows.columns))


def aligned(flows: DataFrame, expected: list[str], keep: list[str] = ()) -> DataFrame:
    """Exactly the expected columns: absent ones are null, others go (but for ``keep``)."""

    def pick(name: str) -> Column:
        return F.col(name) if name in flows.columns else F.lit(None).cast("double").alias(name)

    kept = [c for c in keep if c in flows.columns and c not in expected]
    return flows.select(*[pick(c) for c in expected], *kept)


def for_inference(flows: DataFrame, expected: list[str], keep: list[str] = ()) -> DataFrame:
    """Normalise headers, turn infinities into null and align. Never changes the row count."""
    table = normalised_headers(flows)
    floats = [
        f.name for f in table.schema.fields if isinstance(f.dataType, (T.DoubleType, T.FloatType))
    ]
    table = table.withColumns({c: finite(c) for c in floats}) if floats else table
    return aligned(table, expected, keep)
