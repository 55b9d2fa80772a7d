"""Flows that keep arriving: the batch operators on a file stream, with counters, alerts and a timeline."""

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StreamingQuery

from wireglean import taxonomy as tax

RECENT = 15
LATENESS = "1 hour"


def flow_stream(spark: SparkSession, folder: str, schema: T.StructType,
                files_per_trigger: int | None = None) -> DataFrame:
    """Parquet files as they arrive in a folder, a fixed number per tick."""
    reader = spark.readStream.schema(schema)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.parquet(folder)


def _paced(stream: DataFrame, checkpoint: str, every: str | None):
    """A tick every so often, or (None) what is there and an end."""
    writer = stream.writeStream.option("checkpointLocation", checkpoint)
    return writer.trigger(processingTime=every) if every else writer.trigger(availableNow=True)


def append_to(stream: DataFrame, path: str, checkpoint: str, every: str | None = None) -> StreamingQuery:
    """Write what is there and stop, or with ``every`` go on at that interval; started again, it goes on
    behind the last written file."""
    return _paced(stream, checkpoint, every).format("parquet").outputMode("append").start(path)


def alerts(scored: DataFrame) -> DataFrame:
    """One row per malicious flow."""
    kept = [c for c in ("flow_id", "timestamp") if c in scored.columns]
    return scored.where(F.col("prediction") != tax.BENIGN).select(
        *kept, F.col("prediction").alias("attack"), "risk_score", "risk_level")


def running_counters(scored: DataFrame) -> DataFrame:
    """Flows analysed and threats found so far."""
    return scored.groupBy().agg(
        F.count("*").alias("analysed"),
        F.count_if(F.col("prediction") != tax.BENIGN).alias("threats"),
    )


def window_counts(scored: DataFrame, when: str = "timestamp", every: str = "30 minutes",
                  lateness: str = LATENESS) -> DataFrame:
    """Flows per closed time bucket; rows later than ``lateness`` are left out."""
    return (
        scored.select(F.col(when).cast("timestamp").alias("_at"), "prediction")
        .where("_at is not null").withWatermark("_at", lateness)
        .groupBy(F.window("_at", every))
        .agg(F.count("*").alias("total"),
             F.count_if(F.col("prediction") != tax.BENIGN).alias("malicious"))
        .select(F.col("window.start").alias("bucket"), "total", "malicious",
                (F.col("total") - F.col("malicious")).alias("benign"))
    )


_PROVIDER = "spark.sql.streaming.stateStore.providerClass"
_ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
_BUCKET = "ms long, total long, malicious long"


class _EmptyBuckets(StatefulProcessor):
    """Passes closed buckets on in time order, with a row of zeros for each one between them that had no flow.

    The state is the last bucket passed on. A timer stands at the end of the next one: when the watermark reaches it
    and no row has come, the bucket was empty, and need not wait for a later row to show that.
    """

    def __init__(self, step: int):
        self.step = step

    def init(self, handle) -> None:
        self.handle = handle
        self.last = handle.getValueState("last", "ms long")

    def _wait(self, last: int) -> None:
        for old in list(self.handle.listTimers()):
            self.handle.deleteTimer(old)
        self.last.update((last,))
        self.handle.registerTimer(last + 2 * self.step)

    def handleInputRows(self, key, rows, timerValues):
        last = self.last.get()[0] if self.last.exists() else None
        for row in sorted(rows, key=lambda r: r["ms"]):
            for gap in range(row["ms"] if last is None else last + self.step, row["ms"], self.step):
                yield Row(ms=gap, total=0, malicious=0)
            last = row["ms"]
            yield Row(ms=last, total=row["total"], malicious=row["malicious"])
        self._wait(last)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        last, now = self.last.get()[0], timerValues.getCurrentWatermarkInMs()
        while last + 2 * self.step <= now:
            last += self.step
            yield Row(ms=last, total=0, malicious=0)
        self._wait(last)

    def close(self) -> None:
        pass


def filled_window_counts(scored: DataFrame, when: str = "timestamp", minutes: int = 30,
                         lateness: str = LATENESS) -> DataFrame:
    """:func:`window_counts` without gaps: closed buckets that had no flow are rows of zeros.

    Flows are counted per bucket in all tasks; only the closed buckets, one row each, meet in one stateful task.
    The state is kept in RocksDB, which the session is told to use.
    """
    spark = scored.sparkSession
    if spark.conf.get(_PROVIDER, "") != _ROCKS:
        spark.conf.set(_PROVIDER, _ROCKS)
    counted = (
        scored.select(F.col(when).cast("timestamp").alias("_at"), "prediction")
        .where("_at is not null").withWatermark("_at", lateness)
        .groupBy(F.window("_at", f"{minutes} minutes"))
        .agg(F.count("*").alias("total"), F.count_if(F.col("prediction") != tax.BENIGN).alias("malicious"))
        .select(F.lit(0).alias("series"), F.window_time("window").alias("_at"), F.unix_millis("window.start").alias("ms"), "total", "malicious")
    )
    filled = counted.groupBy("series").transformWithState(
        _EmptyBuckets(minutes * 60_000), T._parse_datatype_string(_BUCKET), "append", "EventTime")
    return filled.select(F.timestamp_millis("ms").alias("bucket"), "total", "malicious",
                         (F.col("total") - F.col("malicious")).alias("benign"))


class LatestTable:
    """A small table replaced at every tick. Each tick writes its own folder, so a
    repeated tick overwrites itself and a reader never sees half a table. The newest ``KEPT``
    folders stay, for readers that have just begun and ticks that are repeated."""

    KEPT = 3

    def __init__(self, path: str):
        self.path = path

    def _folders(self, spark: SparkSession) -> tuple[object, dict[int, object]]:
        """The file system, and the folder of each finished tick, by a listing of names."""
        path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(self.path)
        system = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        listed = [s.getPath() for s in system.listStatus(path)] if system.exists(path) else []
        done = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
        ticks = {int(p.getName().removeprefix("tick=")): p for p in listed if p.getName().startswith("tick=")
                 and system.exists(done(p, "_SUCCESS"))}
        return system, ticks

    def write(self, table: DataFrame, tick: int) -> None:
        table.coalesce(1).write.mode("overwrite").parquet(f"{self.path}/tick={tick}")
        system, ticks = self._folders(table.sparkSession)
        for old in sorted(ticks)[:-self.KEPT]:
            system.delete(ticks[old], True)

    def read(self, spark: SparkSession, before: int | None = None) -> DataFrame | None:
        """The newest table (older than tick ``before``), or None when there is none yet."""
        _, ticks = self._folders(spark)
        found = [t for t in ticks if before is None or t < before]
        return spark.read.parquet(ticks[max(found)].toString()) if found else None


def keep_counters(scored: DataFrame, table: LatestTable, checkpoint: str, every: str | None = None) -> StreamingQuery:
    return _paced(running_counters(scored), checkpoint, every).outputMode("complete").foreachBatch(table.write).start()


def keep_recent(scored: DataFrame, table: LatestTable, checkpoint: str, when: str = "timestamp",
                tie: str = "flow_id", rows: int = RECENT, every: str | None = None) -> StreamingQuery:
    """The newest events: each tick's newest against those kept before."""

    def newest(df: DataFrame) -> DataFrame:
        return df.orderBy(F.desc(when), F.desc(tie)).limit(rows)

    def tick(batch: DataFrame, number: int) -> None:
        top = newest(batch)
        before = table.read(batch.sparkSession, before=number)
        table.write(newest(top if before is None else top.unionByName(before)), number)

    return _paced(scored, checkpoint, every).foreachBatch(tick).start()
