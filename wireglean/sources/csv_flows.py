"""Reading capture files as a flow meter exports them: dirty headers, varying columns, bad lines."""

from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wireglean import taxonomy as tax
from wireglean.functions.text import snake_headers
from wireglean.session import settle
from wireglean.sources import capture_ranges

CORRUPT = "_corrupt"


def csv_files(spark: SparkSession, folder: str) -> DataFrame:
    """Every CSV file with content below ``folder``: (path, name, bytes). A missing folder has none.

    Lists the files only; the content column of the source is never read.
    """
    empty = spark.createDataFrame([], "path string, name string, bytes bigint")
    try:
        listing = (
            spark.read.format("binaryFile").option("recursiveFileLookup", True)
            .option("pathGlobFilter", "*.csv").load(folder)
        )
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return empty
        raise
    name = F.element_at(F.split("path", "/"), -1)
    return listing.select("path", name.alias("name"), F.col("length").alias("bytes"))


def header_of(spark: SparkSession, path: str) -> list[str] | None:
    """The raw header cells of one file, or None when there is no line to read."""
    found = capture_ranges.headers(capture_ranges.probe(csv_files(spark, path), count_quotes=False))
    return found[0] if found else None


def _comma_count(record: Column) -> Column:
    bare = F.regexp_replace(record, '"([^"]|"")*"', "")
    return F.length(bare) - F.length(F.replace(bare, F.lit(","), F.lit("")))


def read_group(spark: SparkSession, paths: list[str] | str, names: list[str]) -> DataFrame:
    """Files that share one header (or all below a folder), all cells as text.

    A short line is filled up with nulls, a line with too many cells is dropped, and
    the texts that mean "missing" become null. Undecodable bytes become U+FFFD.
    """
    schema = T.StructType([T.StructField(n, T.StringType()) for n in [*names, CORRUPT]])
    rows = (
        spark.read.schema(schema).option("header", True).option("enforceSchema", True)
        .option("ignoreLeadingWhiteSpace", True).option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", CORRUPT).option("ignoreCorruptFiles", True)
        # A quote inside a quoted cell is doubled; cells with line ends are left to the reader of ranges.
        .option("escape", '"').option("recursiveFileLookup", True).option("pathGlobFilter", "*.csv")
        # Pruned cells are not counted, so a long line would pass when few columns are asked for.
        .option("columnPruning", False)
        .csv(paths)
    )
    too_long = F.col(CORRUPT).isNotNull() & (_comma_count(F.col(CORRUPT)) >= len(names))
    # Always true: Spark refuses a scan of the corrupt-line column alone, as a count would be.
    named = F.coalesce(F.col(f"`{names[0]}`"), F.lit("")) >= ""
    return rows.where(~too_long & named).select(
        *[F.when(~F.col(f"`{n}`").isin(tax.MISSING_TEXTS), F.col(f"`{n}`")).alias(n) for n in names],
        F.url_decode(F.replace(F.col("_metadata.file_name"), F.lit("+"), F.lit("%2B"))).alias("source_file"),
        F.col("_metadata.file_path").alias("_path"),
        F.col("_metadata.file_block_start").alias("_block"),
    )


def first_rows(rows: DataFrame, limit: int) -> DataFrame:
    """The first ``limit`` rows of each file, in file order.

    Rows are counted per block first. Blocks before the limit are taken whole and only
    the one block that crosses it is numbered row by row, so a huge file is neither
    sorted nor gathered in one task.
    """
    blocks = rows.groupBy("_path", "_block").agg(F.count("*").alias("_n"))
    before = Window.partitionBy("_path").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    placed = blocks.withColumn("_start", F.coalesce(F.sum("_n").over(before), F.lit(0)))
    needed = placed.where(F.col("_start") < limit).withColumn("_whole", F.col("_start") + F.col("_n") <= limit)
    needed = settle(needed)
    marked = rows.withColumn("_at", F.monotonically_increasing_id()).join(needed, ["_path", "_block"])
    whole = marked.where("_whole")
    order = Window.partitionBy("_path", "_block").orderBy("_at")
    torn = (
        marked.where("not _whole").withColumn("_nth", F.row_number().over(order))
        .where(F.col("_start") + F.col("_nth") <= limit).drop("_nth")
    )
    return whole.unionByName(torn).select(*rows.columns)


def load_captures(spark: SparkSession, folder: str | None = None, files: list[str] | None = None,
                  rows_per_file: int | None = None, multi_line: bool = False,
                  left_out: list[DataFrame] | None = None) -> DataFrame:
    """All captures as one table of text columns with ``source_file``.

    One job reads the first line of all files. Files whose header can't be read are left out; with ``left_out`` a table
    (path, reason) of them is added to it. Files with equal headers are read together; columns a file lacks are null.
    No readable file is an error.

    With ``multi_line`` quoted cells may hold line ends, and every byte of every file is looked at first: a file
    that can't be read to its end is left out whole, with the reason. Files are split in both ways.
    """
    if files is None:
        found = csv_files(spark, folder)
    else:
        found = reduce(DataFrame.unionByName, [csv_files(spark, f) for f in files]) if files else csv_files(spark, "")
    if not files and found.isEmpty():
        raise FileNotFoundError(f"no CSV files in {folder}")
    probed = capture_ranges.probe(found, count_quotes=multi_line)
    bad = capture_ranges.left_out(probed)
    if left_out is not None:
        left_out.append(bad)
    known = [snake_headers(header) for header in capture_ranges.headers(probed)]
    if not known:
        raise FileNotFoundError("none of the CSV files could be read")
    if multi_line and rows_per_file is None:
        return capture_ranges.read(probed, spark)
    if files is None and len(known) == 1 and bad.isEmpty():
        sources = [(known[0], folder)]  # no path passes through the driver
    else:
        good = probed.where("header IS NOT NULL").join(bad.select("path"), "path", "left_anti")
        groups: dict[tuple, list[str]] = {tuple(names): [] for names in known}
        for row in good.select("path", "header").orderBy("path").toLocalIterator():
            groups[tuple(snake_headers(row["header"]))].append(row["path"])
        sources = [(list(names), paths) for names, paths in groups.items()]
    parts = []
    for names, paths in sources:
        part = read_group(spark, paths, names)
        part = part if rows_per_file is None else first_rows(part, rows_per_file)
        parts.append(part.drop("_path", "_block"))
    combined = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    data = [c for c in combined.columns if c != "source_file"]
    return combined.select(*data, "source_file")


def load_sample(spark: SparkSession, path: str) -> DataFrame:
    """One capture file with normalised headers and no provenance column."""
    return load_captures(spark, files=[path]).drop("source_file")
