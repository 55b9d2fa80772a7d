"""Fitted preprocessing: impute, scale and encode flows into one feature vector.

The fit is a small table of parameters (medians, ranges, vocabularies); applying it
is one projection of expressions, equal in batch and stream.
"""

from dataclasses import asdict, dataclass

from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wireglean import taxonomy as tax
from wireglean.functions.numbers import case, finite, finite_sql, text, texts
from wireglean.operators.features import aligned, with_derived_features
from wireglean.operators.order_statistics import quantiles

MAX_CATEGORIES = 100_000
RARE = "infrequent"


@dataclass
class Preprocessor:
    """Parameters learned from training rows only."""

    raw_columns: list[str]
    medians: dict[str, float]
    scales: dict[str, float]
    frequent: dict[str, list[str]]
    rare: dict[str, list[str]]

    @property
    def numeric(self) -> list[str]:
        return list(self.medians)

    def feature_names(self) -> list[str]:
        names = self.numeric
        for column in tax.CATEGORICAL_FEATURES:
            names += [f"{column}_{value}" for value in self.frequent[column]]
            names += [f"{column}_{RARE}"] if self.rare[column] else []
        return names

    def scaled(self, column: str) -> str:
        median, scale = f"{self.medians[column]!r}D", f"{self.scales[column]!r}D"
        return f"(coalesce({finite_sql(column)}, {median}) - {median}) / {scale}"

    def encoded(self, column: str) -> list[str]:
        """One 0/1 value per frequent category, one for all rare ones; an unseen one is all zeros."""
        tests = [f"{column} = {text(v)}" for v in self.frequent[column]]
        tests += [f"{column} IN ({texts(self.rare[column])})"] if self.rare[column] else []
        return [case([(test, "1D")], "0D") for test in tests]

    def feature_array(self) -> Column:
        """All features of a row, in the order of :meth:`feature_names`."""
        values = [self.scaled(c) for c in self.numeric]
        for column in tax.CATEGORICAL_FEATURES:
            values += self.encoded(column)
        return F.expr(f"array({', '.join(values)})")

    def transform(self, flows: DataFrame, keep: list[str] = ()) -> DataFrame:
        """Derived features plus the vector ``features``; as many rows as came in."""
        derived = with_derived_features(aligned(flows, self.raw_columns, keep))
        return derived.withColumn("features", array_to_vector(self.feature_array()))

    def parameter_table(self, spark) -> DataFrame:
        rows = [(c, self.medians[c], self.scales[c]) for c in self.numeric]
        return spark.createDataFrame(rows, "feature string, median double, scale double")

    def vocabulary_table(self, spark) -> DataFrame:
        rows = [(c, v, rare) for c in tax.CATEGORICAL_FEATURES
                for values, rare in ((self.frequent[c], False), (self.rare[c], True)) for v in values]
        return spark.createDataFrame(rows, "feature string, category string, rare boolean")

    def to_dict(self) -> dict:
        return asdict(self)


def category_counts(derived: DataFrame) -> DataFrame:
    """(feature, category, n) for the categorical features, in one pass."""
    entries = [F.struct(F.lit(c).alias("feature"), F.col(c).alias("category"))
               for c in tax.CATEGORICAL_FEATURES]
    return (
        derived.select(F.inline(F.array(*entries))).groupBy("feature", "category")
        .agg(F.count("*").alias("n"))
    )


def fit_preprocessor(train: DataFrame, raw_columns: list[str],
                     rare_share: float = tax.RARE_CATEGORY_SHARE, most_categories: int = MAX_CATEGORIES) -> Preprocessor:
    """Learn medians, the 5-95 % ranges of the imputed values, and the vocabularies.

    Frequent categories are at most ``1 / rare_share`` a column. The rare ones are kept too, so that seen and unseen
    values differ; more than ``most_categories`` together are refused as no categorical columns.
    """
    derived = with_derived_features(aligned(train, raw_columns))
    names = [c for c in dict.fromkeys([*raw_columns, *tax.DERIVED_FEATURES])
             if c not in tax.CATEGORICAL_FEATURES]
    facts = derived.agg(
        F.count("*").alias("rows"),
        *[F.count(finite(c)).alias(f"n{i}") for i, c in enumerate(names)],
    ).first()
    rows = facts["rows"]
    filled = {c: facts[f"n{i}"] for i, c in enumerate(names)}
    numeric = [c for c in names if filled[c] > 0]

    found = {c: v for (_, c), v in quantiles(derived, numeric, [0.05, 0.5, 0.95]).items()}
    medians = {c: found[c][1] for c in numeric}
    # The range is that of the imputed column, which gaps pull towards the median.
    gappy = [c for c in numeric if filled[c] < rows]
    if gappy:
        imputed = derived.select(*[
            F.coalesce(finite(c), F.lit(medians[c])).alias(c) for c in gappy
        ])
        for (_, c), (low, high) in quantiles(imputed, gappy, [0.05, 0.95]).items():
            found[c] = [low, medians[c], high]
    # A zero range scales by 1, so that a later deviation is kept as it is.
    scales = {c: (found[c][2] - found[c][0]) or 1.0 for c in numeric}

    seen = category_counts(derived).limit(most_categories + 1).collect()
    if len(seen) > most_categories:
        raise ValueError(f"more than {most_categories} categories: not a categorical column")
    frequent = {c: [] for c in tax.CATEGORICAL_FEATURES}
    rare = {c: [] for c in tax.CATEGORICAL_FEATURES}
    for row in sorted(seen, key=lambda r: r["category"]):
        group = rare if row["n"] < rare_share * rows else frequent
        group[row["feature"]].append(row["category"])
    return Preprocessor(list(raw_columns), medians, scales, frequent, rare)
