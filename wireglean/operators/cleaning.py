"""Dataset cleaning with its audit report.

The schema of the result depends on the data (which columns are numbers, which are
empty or constant), so cleaning needs one profile pass before its plan is fixed.
All columns are profiled in that single aggregate.
"""

from dataclasses import asdict, dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wireglean import taxonomy as tax
from wireglean.functions.numbers import as_double, finite, is_infinite_sql, known
from wireglean.functions.text import label_family, label_words
from wireglean.operators.sampling import class_counts
from wireglean.session import settle


@dataclass
class CleaningReport:
    rows_in: int = 0
    rows_out: int = 0
    duplicates_removed: int = 0
    null_label_rows_removed: int = 0
    infinite_values_replaced: int = 0
    leakage_columns_dropped: list[str] = field(default_factory=list)
    all_null_columns_dropped: list[str] = field(default_factory=list)
    constant_columns_dropped: list[str] = field(default_factory=list)
    rare_classes_dropped: dict[str, int] = field(default_factory=dict)
    class_counts: dict[str, int] = field(default_factory=dict)

    def to_frame(self, spark) -> DataFrame:
        """The report as a table of one row."""
        names, counts = T.ArrayType(T.StringType()), T.MapType(T.StringType(), T.LongType())
        kinds = {int: T.LongType(), list: names, dict: counts}
        values = asdict(self)
        schema = T.StructType([T.StructField(k, kinds[type(v)]) for k, v in values.items()])
        return spark.createDataFrame([tuple(values.values())], schema)


@dataclass
class Profile:
    """What one pass over the table says about it."""

    rows_in: int
    labelled: int
    infinities: int
    types: dict[str, bool]  # column -> becomes a number
    all_null: list[str]
    constant: list[str]


def find_label_column(flows: DataFrame) -> str:
    for name in tax.LABEL_COLUMNS:
        if name in flows.columns:
            return name
    raise KeyError(f"none of {tax.LABEL_COLUMNS} among {sorted(flows.columns)}")


def _families(flows: DataFrame, label_column: str | None, only_labelled: bool) -> DataFrame:
    source = label_column or find_label_column(flows)
    words = flows.withColumn("_words", label_words(source))
    if only_labelled:
        # Asked of the words, not of the family: the optimizer moves the filter to the scan
        # and there it would repeat the whole chain of label rules.
        words = words.where(F.col("_words").isNotNull() & ~F.col("_words").isin("", "nan"))
    named = words.withColumn("label", label_family("_words")).drop("_words")
    return named if source == "label" else named.drop(source)


def with_families(flows: DataFrame, label_column: str | None = None) -> DataFrame:
    """The label column replaced by ``label``, the attack family ('' where it is missing)."""
    return _families(flows, label_column, only_labelled=False)


def labelled_rows(flows: DataFrame, label_column: str | None = None) -> DataFrame:
    """The same without the rows that have no label."""
    return _families(flows, label_column, only_labelled=True)


def leakage_columns(flows: DataFrame) -> list[str]:
    return [c for c in flows.columns if c in tax.LEAKAGE_COLUMNS or c == "source_file"]


def _is_text(dtype: T.DataType) -> bool:
    return isinstance(dtype, T.StringType)


def _is_numeric(dtype: T.DataType) -> bool:
    return isinstance(dtype, (T.NumericType, T.BooleanType))


def _may_be_infinite(dtype: T.DataType) -> bool:
    return isinstance(dtype, (T.StringType, T.DoubleType, T.FloatType))


def infinities_in_row(flows: DataFrame) -> Column:
    """How many columns of the row, but for the label, hold an infinity."""
    columns = [f.name for f in flows.schema.fields if f.name != "label" and _may_be_infinite(f.dataType)]
    return F.expr(" + ".join(f"CAST({is_infinite_sql(c)} AS INT)" for c in columns) or "0")


def profile(flows: DataFrame, untyped_text: bool = False) -> Profile:
    """Profile a table that already carries families in ``label``, in one aggregate.

    ``untyped_text`` says that every text column comes from a text file, whose reader
    would have made a column of numbers numeric; otherwise text must be numeric in
    90 % of the rows to become a number.
    """
    fields = [f for f in flows.schema.fields if f.name != "label"]
    aggregates = [F.count("*").alias("rows"), F.sum("_infinities").alias("infinities")]
    values = {}
    for i, f in enumerate(fields):
        if _is_text(f.dataType):
            values[f"_x{i}"] = finite(f.name)
            aggregates += [
                F.count(f.name).alias(f"filled{i}"),
                F.count(as_double(f.name)).alias(f"read{i}"),
                F.count(known(f.name)).alias(f"known{i}"),
                F.min(f"_x{i}").alias(f"lo{i}"), F.max(f"_x{i}").alias(f"hi{i}"),
            ]
        elif _is_numeric(f.dataType):
            values[f"_x{i}"] = finite(f.name)
            aggregates += [F.min(f"_x{i}").alias(f"lo{i}"), F.max(f"_x{i}").alias(f"hi{i}")]
        else:
            aggregates += [F.count(f.name).alias(f"filled{i}")]
    # Two groups, rows with and without a label, instead of a condition in every aggregate.
    rows = (
        flows.withColumns(values | {"_infinities": infinities_in_row(flows)})
        .groupBy((F.col("label") != "").alias("labelled")).agg(*aggregates).collect()
    )
    groups = {r["labelled"]: r for r in rows}
    usable = groups.get(True)
    labelled = usable["rows"] if usable else 0

    numeric, all_null, constant = {}, [], []
    for i, f in enumerate(fields):
        if _is_text(f.dataType):
            filled = sum(r[f"filled{i}"] for r in rows)
            becomes = untyped_text and filled > 0 and sum(r[f"read{i}"] for r in rows) == filled
            if labelled and f.name != "protocol":
                becomes = becomes or usable[f"known{i}"] / labelled >= tax.NUMERIC_SHARE
        else:
            becomes = _is_numeric(f.dataType)
        numeric[f.name] = becomes
        if becomes:
            empty = not labelled or usable[f"lo{i}"] is None
            same = not empty and usable[f"lo{i}"] == usable[f"hi{i}"]
        else:
            empty, same = not labelled or not usable[f"filled{i}"], False
        if empty:
            all_null.append(f.name)
        elif same:
            constant.append(f.name)
    infinities = (usable["infinities"] or 0) if usable else 0
    return Profile(sum(r["rows"] for r in rows), labelled, infinities, numeric, all_null, constant)


def coerced(flows: DataFrame, numeric: dict[str, bool]) -> DataFrame:
    """Text that holds numbers becomes double; infinities and NaN become null."""
    changes = {}
    for f in flows.schema.fields:
        if numeric.get(f.name) and _may_be_infinite(f.dataType):
            changes[f.name] = finite(f.name)
    return flows.withColumns(changes) if changes else flows


def without_useless_columns(flows: DataFrame, found: Profile) -> DataFrame:
    return flows.drop(*found.all_null, *found.constant)


def without_rare_classes(flows: DataFrame, counts: dict[str, int],
                         least: int = tax.MIN_CLASS_ROWS) -> DataFrame:
    """Only the classes with at least ``least`` rows; the list of keepers is a short literal."""
    return flows.where(F.col("label").isin([c for c, n in counts.items() if n >= least]))


def prepared(flows: DataFrame, label_column: str | None = None,
             untyped_text: bool = False) -> tuple[DataFrame, Profile, list[str]]:
    """Everything before de-duplication: families, leakage, types, useless columns."""
    leaking = leakage_columns(flows)
    found = profile(with_families(flows, label_column).drop(*leaking), untyped_text)
    table = labelled_rows(flows, label_column).drop(*leaking)
    return without_useless_columns(coerced(table, found.types), found), found, leaking


def clean(flows: DataFrame, label_column: str | None = None,
          least: int = tax.MIN_CLASS_ROWS, untyped_text: bool = False) -> tuple[DataFrame, CleaningReport]:
    """The cleaned table and its report.

    Duplicates are dropped after identifiers and constants: rows that differed only
    there are copies. The distinct rows are settled once, because the class counts
    and the result both need them and the shuffle of all rows is the dear step.
    """
    table, found, leaking = prepared(flows, label_column, untyped_text)
    distinct = settle(table.dropDuplicates())
    counts = class_counts(distinct)
    kept = {c: n for c, n in counts.items() if n >= least}
    report = CleaningReport(
        rows_in=found.rows_in,
        rows_out=sum(kept.values()),
        duplicates_removed=found.labelled - sum(counts.values()),
        null_label_rows_removed=found.rows_in - found.labelled,
        infinite_values_replaced=found.infinities,
        leakage_columns_dropped=leaking,
        all_null_columns_dropped=found.all_null,
        constant_columns_dropped=found.constant,
        rare_classes_dropped={c: n for c, n in counts.items() if n < least},
        class_counts=dict(sorted(kept.items(), key=lambda item: (-item[1], item[0]))),
    )
    return without_rare_classes(distinct, counts, least), report


def class_shares(flows: DataFrame, label: str = "label") -> DataFrame:
    """Rows and percentage per class, and the ratio of the largest class to each."""
    counts = flows.groupBy(label).agg(F.count("*").alias("n"))
    totals = counts.agg(F.sum("n").alias("total"), F.max("n").alias("largest"))
    # One row of totals joins the handful of classes.
    joined = counts.withColumn("one", F.lit(1)).join(F.broadcast(totals.withColumn("one", F.lit(1))), "one")
    return joined.select(
        label, "n",
        (F.col("n") / F.greatest(F.col("total"), F.lit(1)) * 100).alias("percent"),
        (F.col("largest") / F.col("n")).alias("times_rarer"),
    ).orderBy(F.desc("n"), label)
