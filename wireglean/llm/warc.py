"""WARC archives: a writer of gzip members, and a splittable reader.

The writer gives every record a gzip member of its own. The reader deals byte ranges of the
archives to tasks. A task scans its range for the gzip magic, takes a place for a member only if
what decodes there begins with a WARC version line and a full header, and owns the records whose
member starts inside its range, reading on past the range's end for the last one.
"""

import base64
import hashlib
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wireglean.llm.common import Workspace, file_system, pick, query, slices, table

#: Bytes of an archive that one task owns, and the largest archive a writer fills before the next.
RANGE_BYTES = 8 << 20
ARCHIVE_BYTES = 1 << 30
READ_BYTES = 1 << 20
_MAGIC = b"\x1f\x8b\x08"
_VERSION = b"WARC/1."
_HTTP = "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {}\r\n\r\n"


def digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def member(page_id, url: str | None, payload: bytes, own: str, response_id) -> bytes:
    """One record as a gzip member: a response with its payload, or a revisit without."""
    http = _HTTP.format(len(payload)).encode()
    revisit = response_id is not None
    block = http if revisit else http + payload
    head = [f"WARC-Type: {'revisit' if revisit else 'response'}", f"WARC-Record-ID: <urn:page:{_name(page_id)}>",
            "WARC-Date: 1970-01-01T00:00:00Z", "WARC-Target-URI: " + _line(url or "about:blank"),
            f"WARC-Payload-Digest: sha1:{own}", "Content-Type: application/http; msgtype=response"]
    if revisit:
        head += [f"WARC-Refers-To: <urn:page:{response_id}>",
                 "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"]
    head.append(f"Content-Length: {len(block)}")
    record = "\r\n".join(["WARC/1.1", *head, "", ""]).encode() + block + b"\r\n\r\n"
    packer = zlib.compressobj(6, zlib.DEFLATED, 31)
    return packer.compress(record) + packer.flush()


def _name(page_id) -> str:
    return "none" if page_id is None else str(page_id)


def _line(text: str) -> str:
    """A header value: line ends and other controls escaped, so that no text can add headers."""
    return "".join(c if c.isprintable() else "".join(f"%{b:02X}" for b in c.encode("utf-8", "replace")) for c in text)


def write(pages: DataFrame, ws: Workspace, least_bytes: int = 0, id_column: str = "page_id",
          url_column: str = "url", payload_column: str = "html") -> DataFrame:
    """Write a record for every row; returns the manifest (path, bytes, records) of the archives.

    Of the rows whose payloads are equal and have ``least_bytes`` bytes or more, those with the largest
    id are responses, the others revisit it; rows without id revisit a row that has one. Rows repeated with
    the largest id are all responses. A null payload is empty, a null url ``about:blank``.

    An archive counts when it is in the manifest: each attempt of a task writes files of its own
    name, so a lost executor or a second attempt leaves unlisted files, never double records. Archives are
    finished at ``ARCHIVE_BYTES``. Digests are grouped with partial maxima; the join back is on
    the digest, which the session splits where one payload has a large share of the rows.
    """
    spark = pages.sparkSession
    rows = pick(pages, id_column, url_column, payload_column).toDF("id", "url", "html")
    payload = F.coalesce(F.col("html").cast("binary"), F.lit(b""))
    # Payloads are told apart as in the archive, by their SHA-1; only digests are grouped.
    key = [F.sha1(payload).alias("key"), F.octet_length(payload).alias("size")]
    copies = (rows.select("id", *key).where(F.col("size") >= least_bytes).groupBy("key", "size")
              .agg(F.max("id").alias("last"), F.count("*").alias("n")).where("n > 1 AND last IS NOT NULL")
              .select("key", "last"))
    own = rows.select("id", "url", "html", *key)
    known = (own.join(copies, "key", "left")
             .select("id", "url", "html", F.when((F.col("size") >= least_bytes) & ~F.col("id").eqNullSafe(F.col("last")),
                                                 F.col("last")).alias("response_id")))
    folder = f"{ws.folder}/archives"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, base = file_system(folder)
        store.create_dir(base, recursive=True)
        sink, name, size, records = None, "", 0, 0
        for batch in batches:
            for part in slices(batch, "html"):
                for page_id, url, html, response_id in zip(*(c.to_pylist() for c in part.columns)):
                    if sink is None:
                        name, size, records = f"{uuid.uuid4().hex}.warc.gz", 0, 0
                        sink = store.open_output_stream(f"{base}/{name}", compression=None)
                    payload = (html or "").encode("utf-8", "surrogatepass")
                    packed = member(page_id, url, payload, digest(payload), response_id)
                    sink.write(packed)
                    size, records = size + len(packed), records + 1
                    if size >= ARCHIVE_BYTES:
                        sink.close()
                        sink = None
                        yield _manifest(folder, name, size, records)
        if sink is not None:
            sink.close()
            yield _manifest(folder, name, size, records)

    listed = known.mapInArrow(run, "path string, bytes long, records long")
    return ws.settle(listed, "manifest")


def _manifest(folder: str, name: str, size: int, records: int) -> pa.RecordBatch:
    return pa.RecordBatch.from_pydict({"path": [f"{folder}/{name}"], "bytes": pa.array([size], pa.int64()),
                                       "records": pa.array([records], pa.int64())})


class _Range:
    """Bytes of a file from a place on, read ahead in pieces, with the finished ones forgotten."""

    def __init__(self, file, start: int):
        self.file, self.base, self.held = file, start, b""
        file.seek(start)

    def more(self) -> bool:
        piece = self.file.read(READ_BYTES)
        self.held += piece
        return bool(piece)

    def forget(self, place: int) -> None:
        """Drop what lies before the place."""
        self.held, self.base = self.held[place - self.base:], place


def _decoded(source: _Range, place: int) -> tuple[bytes, int] | None:
    """(content, end) of the gzip member of a WARC record at a place, or None if there is none."""
    unpacker, out, at = zlib.decompressobj(31), [], place - source.base
    checked = size = 0
    try:
        while not unpacker.eof:
            piece = source.held[at:at + READ_BYTES]
            if not piece:
                if not source.more():
                    return None
                continue
            made = unpacker.decompress(piece)
            at += len(piece) - len(unpacker.unused_data)
            out.append(made)
            size += len(made)
            if not checked and size >= len(_VERSION):
                checked = 1
                if not b"".join(out).startswith(_VERSION):
                    return None
    except zlib.error:
        return None
    content = b"".join(out)
    if not content.startswith(_VERSION) or b"\r\n\r\n" not in content:
        return None
    return content, source.base + at


def records(path: str, start: int, end: int) -> Iterator[tuple[int, dict[str, str], bytes]]:
    """(offset, headers, block) of the records whose member begins in [start, end)."""
    store, name = file_system(path)
    with store.open_input_file(name) as file:
        source = _Range(file, start)
        place = start
        while place < end:
            found = source.held.find(_MAGIC, place - source.base)
            if found < 0:  # keep the last bytes: the magic may lie across two pieces
                place = max(place, source.base + len(source.held) - len(_MAGIC) + 1)
                source.forget(place)
                if not source.more():
                    return
                continue
            place = source.base + found
            if place >= end:
                return
            whole = _decoded(source, place)
            record = _parsed(whole[0]) if whole else None
            if record is None:
                place += 1
                continue
            yield place, *record
            place = whole[1]
            source.forget(place)


def _parsed(content: bytes) -> tuple[dict[str, str], bytes] | None:
    """Headers and block of a record; None if the header does not hold."""
    head, _, rest = content.partition(b"\r\n\r\n")
    headers = {}
    for line in head.decode("utf-8", "replace").split("\r\n")[1:]:
        key, colon, value = line.partition(":")
        if not colon:
            return None
        headers[key.strip().lower()] = value.strip()
    length = headers.get("content-length", "")
    if "warc-type" not in headers or not length.isdigit() or len(rest) < int(length):
        return None
    return headers, rest[:int(length)]


def read(manifest: DataFrame, range_bytes: int = RANGE_BYTES) -> DataFrame:
    """(path, offset, record_type, record_id, refers_to, target_uri, payload_digest, payload_bytes, payload) of all records.

    The archives of ``manifest`` (path, bytes) are cut into ranges, which are dealt evenly. A revisit has a null payload;
    its length comes from the HTTP header in its block. Damaged members are passed over byte by byte;
    an empty manifest gives an empty table.
    """
    spark = manifest.sparkSession
    ranges = pick(manifest, "path", "bytes").where("bytes > 0").select(
        "path", F.explode(F.sequence(F.lit(0).cast("long"), F.col("bytes") - 1, F.lit(range_bytes).cast("long"))).alias("start"))
    tasks = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    ranges = ranges.repartition(tasks, "path", "start")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, start in zip(*(c.to_pylist() for c in batch.columns)):
                rows, held = [], 0
                for offset, headers, block in records(path, start, start + range_bytes):
                    http, _, payload = block.partition(b"\r\n\r\n")
                    kind = headers["warc-type"]
                    sizes = [int(v) for k, _, v in (line.partition(b":") for line in http.split(b"\r\n"))
                             if k.strip().lower() == b"content-length"]
                    size = sizes[0] if sizes else None
                    rows.append((path, offset, kind, headers.get("warc-record-id"), headers.get("warc-refers-to"),
                                 headers.get("warc-target-uri"),
                                 headers.get("warc-payload-digest", "").removeprefix("sha1:") or None,
                                 size if kind == "revisit" else len(payload), None if kind == "revisit" else payload))
                    held += len(block)
                    if held > READ_BYTES:
                        yield _batch(rows)
                        rows, held = [], 0
                if rows:
                    yield _batch(rows)

    return ranges.mapInArrow(run, ", ".join(f"{n} {t}" for n, t in _READ))


_READ = [("path", "string"), ("offset", "long"), ("record_type", "string"), ("record_id", "string"),
         ("refers_to", "string"), ("target_uri", "string"), ("payload_digest", "string"), ("payload_bytes", "long"),
         ("payload", "binary")]


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = {"string": pa.string(), "long": pa.int64(), "binary": pa.binary()}
    return pa.RecordBatch.from_arrays([pa.array(column, kinds[t]) for column, (_, t) in zip(zip(*rows), _READ)],
                                      names=[n for n, _ in _READ])


def page_of(column: str):
    """The page id in a record id of the writer, as a number; null where the page had none."""
    return F.regexp_extract(column, r"^<urn:page:(-?[0-9]+)>$", 1).try_cast("long")


_SQL = """
WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
g AS (SELECT html, max(page_id) AS last FROM p GROUP BY 1),
x AS (SELECT p.page_id, last, CAST(octet_length(encode(p.html)) AS BIGINT) AS payload_bytes, sha1(p.html) AS hex
      FROM p JOIN g USING (html)),
b AS (SELECT *, array_to_string(list_transform(range(1, 41), lambda i:
          ['0000', '0001', '0010', '0011', '0100', '0101', '0110', '0111',
           '1000', '1001', '1010', '1011', '1100', '1101', '1110', '1111'][instr('0123456789abcdef', hex[i])]), '') AS bits
      FROM x)
SELECT page_id, payload_bytes,
       array_to_string(list_transform(range(0, 32), lambda i:
           'ABCDEFGHIJKLMNOPQRSTUVWXYZ234567'[1 + 16 * CAST(bits[5 * i + 1] AS INTEGER) + 8 * CAST(bits[5 * i + 2] AS INTEGER)
               + 4 * CAST(bits[5 * i + 3] AS INTEGER) + 2 * CAST(bits[5 * i + 4] AS INTEGER)
               + CAST(bits[5 * i + 5] AS INTEGER)]), '') AS payload_digest,
       CASE WHEN page_id = last THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id = last THEN NULL ELSE last END AS refers_to
FROM b
"""


@query("op4_warc", _SQL)
def op4_warc(spark, sf_dir):
    ws = Workspace(spark, "warc")
    manifest = write(table(spark, sf_dir, "pages"), ws)
    found = read(manifest)
    return found.select(page_of("record_id").alias("page_id"), "payload_bytes", "payload_digest", "record_type",
                        page_of("refers_to").alias("refers_to"))
