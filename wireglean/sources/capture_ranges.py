"""Captures read by byte ranges: headers in one job, quoted line ends, and an account of every file.

Ranges of all files are looked at once, on the executors: each counts its quotes, the first one of a file
also reads the header line, and what can't be read gives a reason. The quotes before a range tell whether it
begins inside a quoted cell, and so which of its line ends end a record; a record belongs to the range that
its first byte lies in. So cells with line ends don't keep a file from being split. Neither the files nor
their paths pass through the driver; it only sees the distinct headers.
"""

import csv
import io
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from wireglean import taxonomy as tax
from wireglean.functions.text import snake_headers
from wireglean.session import settle

RANGE_BYTES = 16 << 20
TAIL_BYTES = 1 << 20
ROWS = 20_000

_PROBED = "path string, bytes long, start long, length long, quotes long, header array<string>, reason string"


def _open(path: str):
    """A file in whatever store its address names, for code inside tasks."""
    from pyarrow import fs

    if path.startswith("file:"):
        path = "/" + path[5:].lstrip("/")
    store, place = (fs.LocalFileSystem(), path) if path.startswith("/") else fs.FileSystem.from_uri(path)
    return store.open_input_file(place)


def _record_ends(data: bytes, open_: bool) -> np.ndarray:
    """The places behind those line ends that stand outside of quotes."""
    flat = np.frombuffer(data, np.uint8)
    outside = (np.cumsum(flat == 0x22, dtype=np.int64) + open_) % 2 == 0
    return np.flatnonzero((flat == 0x0A) & outside) + 1


def _first_record(file, size: int) -> tuple[bytes, int]:
    """The first line that is not blank, with its line end if it has one, and the place behind it."""
    data, at = b"", 0
    while True:
        data += file.read_at(min(TAIL_BYTES, size - len(data)), len(data)) if len(data) < size else b""
        ends = _record_ends(data, False)
        for end in ends[np.searchsorted(ends, at, "right"):].tolist():
            if data[at:end].strip():
                return data[at:end], end
            at = end
        if len(data) >= size:
            return data[at:], size


def _cells(lines) -> Iterator[list[str]]:
    csv.field_size_limit(2 ** 31 - 1)
    return csv.reader(lines, skipinitialspace=True)


def probe(files: DataFrame, range_bytes: int = RANGE_BYTES, count_quotes: bool = True) -> DataFrame:
    """(path, bytes, start, length, quotes, header, reason) of all ranges of the files (path, bytes), settled.

    ``header`` are the raw cells of a file's first line, in the row of its first range; ``reason`` tells why a range
    can't be read or has no header. Without ``count_quotes`` only the beginning of each file is read.
    """
    starts = F.expr(f"sequence(0L, greatest(bytes - 1, 0L), {range_bytes}L)") if count_quotes else F.array(F.lit(0).cast("long"))
    ranges = files.select("path", "bytes", F.explode(starts).alias("start"))
    ranges = ranges.withColumn("length", F.least(F.lit(range_bytes), F.col("bytes") - F.col("start")))

    def look(batches):
        for batch in batches:
            out = []
            for path, size, start, length in zip(*(c.to_pylist() for c in batch.columns)):
                quotes, header, reason = 0, None, None
                try:
                    with _open(path) as file:
                        if count_quotes:
                            data = file.read_at(length, start)
                            quotes = data.count(b'"')
                            if len(data) < length:
                                reason = f"ends at {start + len(data)} of {size} bytes"
                        if not start:
                            line = _first_record(file, size)[0].decode("utf-8", "replace").lstrip("\ufeff")
                            header = next(_cells(io.StringIO(line, newline="")), None)
                            reason = reason or (None if header else "no header line")
                except (OSError, csv.Error) as error:
                    reason = str(error).splitlines()[0][:500]
                out.append((path, size, start, length, quotes, header or None, reason))
            kinds = (pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.string()), pa.string())
            yield pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(zip(*out), kinds)] if out else
                                             [pa.array([], t) for t in kinds],
                                             names=["path", "bytes", "start", "length", "quotes", "header", "reason"])

    spread = ranges.repartition(files.sparkSession.sparkContext.defaultParallelism * 4)
    return settle(spread.mapInArrow(look, _PROBED))


def left_out(probed: DataFrame) -> DataFrame:
    """(path, reason) of the files that can't be read, wherever in them that shows."""
    return probed.where("reason IS NOT NULL").groupBy("path").agg(F.min_by("reason", "start").alias("reason"))


def headers(probed: DataFrame) -> list[list[str]]:
    """The distinct raw headers of readable files, in the order of the first file of each."""
    bad = left_out(probed).select("path")
    found = probed.where("header IS NOT NULL").join(bad, "path", "left_anti")
    return [r["header"] for r in found.groupBy("header").agg(F.min("path").alias("p")).orderBy("p").collect()]


def read(probed: DataFrame, spark: SparkSession) -> DataFrame:
    """All records of the readable files: a text column for each header name, and ``source_file``.

    A short record is filled up with nulls, one with too many cells is dropped, blank lines are none, texts that mean
    "missing" are null, and undecodable bytes become U+FFFD. Cells may hold line ends and doubled quotes. A file whose
    quotes don't pair up can't be split by them: one task streams it.
    """
    known = headers(probed)
    names: list[str] = list(dict.fromkeys(n for header in known for n in snake_headers(header)))
    every = Window.partitionBy("path")
    before = every.orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    ranges = (probed.withColumn("open", F.coalesce(F.sum("quotes").over(before), F.lit(0)) % 2 == 1)
              .withColumn("odd", F.sum("quotes").over(every) % 2 == 1)
              .withColumn("head", F.max("header").over(every)).withColumn("bad", F.max("reason").over(every))
              .where("bad IS NULL AND head IS NOT NULL AND (NOT odd OR start = 0)")
              .select("path", "bytes", "start", "length", "open", "odd", "head"))
    missing = frozenset(tax.MISSING_TEXTS)

    def lines(path, size, start, length, open_, odd):
        """The records of a range as text lines."""
        with _open(path) as file:
            after_header = _first_record(file, size)[1] if not start else 0
            if odd:
                file.seek(after_header)
                yield from io.TextIOWrapper(file, "utf-8", "replace", newline="")
                return
            data = file.read_at(length, start)
            ends = _record_ends(data, open_)
            first = after_header
            if start:  # the first record that begins here; one may begin at the very first byte
                begins = not open_ and file.read_at(1, start - 1) == b"\n"
                first = 0 if begins else int(ends[0]) if len(ends) else len(data)
            if first >= len(data):
                return
            # The last record may end beyond the range.
            at = start + length
            open_ = (data.count(b'"') + open_) % 2 == 1
            while at < size and (open_ or not data.endswith(b"\n")):
                more = file.read_at(min(TAIL_BYTES, size - at), at)
                ends = _record_ends(more, open_)
                if len(ends):
                    data += more[:int(ends[0])]
                    break
                data += more
                open_ = (more.count(b'"') + open_) % 2 == 1
                at += len(more)
            yield from io.StringIO(data[first:].decode("utf-8", "replace"), newline="")

    def run(batches):
        for batch in batches:
            for path, size, start, length, open_, odd, head in zip(*(c.to_pylist() for c in batch.columns)):
                own = snake_headers(head)
                place = {n: i for i, n in enumerate(own)}
                file_name = path.rsplit("/", 1)[-1]

                def table(rows):
                    columns = list(zip(*rows))
                    arrays = [pa.array(columns[place[n]] if n in place else [None] * len(rows), pa.string()) for n in names]
                    return pa.RecordBatch.from_arrays([*arrays, pa.array([file_name] * len(rows), pa.string())],
                                                      names=[*names, "source_file"])

                held = []
                for cells in _cells(lines(path, size, start, length, open_, odd)):
                    if not cells or len(cells) > len(own):
                        continue
                    held.append([None if c in missing else c for c in cells] + [None] * (len(own) - len(cells)))
                    if len(held) == ROWS:
                        yield table(held)
                        held = []
                if held:
                    yield table(held)

    schema = ", ".join(f"`{n}` string" for n in [*names, "source_file"])
    return ranges.repartition(spark.sparkContext.defaultParallelism * 4, "path", "start").mapInArrow(run, schema)
