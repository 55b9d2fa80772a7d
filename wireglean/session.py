"""Session settings and the shared folder for tables that cut lineage."""

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


# The JVM does not compile methods above 8000 bytes of code. A fused stage that outgrows this
# runs interpreted; with the limit Spark leaves such a stage unfused, in methods that compile.
METHOD_LIMIT = {"spark.sql.codegen.hugeMethodLimit": "8000"}


def local_session(cores: str | int = "*", partitions: int = 8, **conf: str) -> SparkSession:
    """A session for one machine; on a cluster the submitter brings its own."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("wireglean")
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "16g")
    )
    for key, value in {**METHOD_LIMIT, **conf}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors can reach, as the session names it.

    A cluster must set ``spark.checkpoint.dir``. Only a local master, where one
    machine is the whole cluster, may fall back to a temporary folder.
    """
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not folder:
        if not re.fullmatch(r"local(\[.*\])?", context.master):
            raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")
        folder = tempfile.mkdtemp(prefix="wireglean-")
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(folder)
    return folder


def run_folder(spark: SparkSession, purpose: str) -> str:
    """A fresh folder below the shared one, which goes when the session ends."""
    folder = f"{shared_folder(spark).rstrip('/')}/{purpose}-{uuid.uuid4().hex}"
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(path)
    return folder


def settle(df: DataFrame) -> DataFrame:
    """Compute ``df`` once into the shared folder and go on from there.

    The rows are written as a columnar table: later reads take the columns they need, and a
    lost executor costs a re-read, not a recomputation.
    """
    folder = run_folder(df.sparkSession, "settled")
    df.write.parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)
