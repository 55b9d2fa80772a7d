"""Removal of repeated byte strings by a depth-limited radix sort of suffixes.

Every window of ``depth`` bytes is the head of a suffix, and suffixes matter only through that depth: a
window is repeated when its head is equal to another's. The order is refined by most-significant-digit
passes, and what is alone in its group drops out after each.

Pass 1. The digit is a 32-byte string inside the window, the one of the smallest hash (leftmost among
equals). Equal windows have it at the same offset, and neighbouring windows share it, so that one row, an
anchor, stands for about 70 windows. Anchors whose string is found nowhere else drop out.
Pass 2. The digit is all text that the anchor's windows cover. Anchors that agree in it repeat one
another in all their windows; of each such class one goes on.
Pass 3. Within anchors of one string, windows at one offset are ordered by their bytes, a fifth of the
depth at a time, in numpy; groups that are left after the last digit are the repeated windows.
"""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wireglean.llm.common import Workspace, pick, query, slices, table

DEPTH = 200
FIRST_DIGIT = 32
#: Contexts of one string that meet in one task; of larger groups every window becomes a row.
GROUP = 10_000
#: Bytes of contexts that are ordered at once.
ORDER_BYTES = 2 << 20
_CHUNK = 1 << 17
_BASE = 0x9E3779B97F4A7C55
_LOW = np.uint64((1 << 18) - 1)


def _powers() -> tuple[np.ndarray, np.ndarray]:
    from wireglean.llm.common import held

    def make():
        n = (_CHUNK + (1 << 12)) * 2
        return tuple(np.multiply.accumulate(np.r_[np.uint64(1), np.full(n, b, np.uint64)])
                     for b in (_BASE, pow(_BASE, -1, 1 << 64)))

    return held(("suffix powers",), make)


def _spread(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return h ^ (h >> np.uint64(32))


def _hashes(data: np.ndarray, size: int) -> np.ndarray:
    """A hash of the ``size`` bytes at every place (at most a chunk of places)."""
    up, down = _powers()
    total = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[:len(data)], out=total[1:])
    return _spread((total[size:] - total[:-size]) * down[:len(data) - size + 1])


def _smallest(key: np.ndarray, width: int) -> np.ndarray:
    """The minimum of every ``width`` neighbours, by minima towards both ends of blocks."""
    n = len(key) - width + 1
    padded = np.full(-(-len(key) // width) * width, np.uint64(0xFFFFFFFFFFFFFFFF))
    padded[:len(key)] = key
    blocks = padded.reshape(-1, width)
    left = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    right = np.minimum.accumulate(blocks, axis=1).ravel()
    return np.minimum(left[:n], right[width - 1:width - 1 + n])


def anchors(data: bytes, depth: int, digit: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(hash of the string, its place, first and last window start) of the anchors of a text."""
    found = []
    for start in range(0, max(0, len(data) - depth + 1), _CHUNK):
        part = np.frombuffer(data[start:start + _CHUNK + depth - 1], np.uint8)
        h = _hashes(part, digit)
        key = (h & ~_LOW) | np.arange(len(h), dtype=np.uint64)
        place = (_smallest(key, depth - digit + 1) & _LOW).astype(np.int64)
        first = np.flatnonzero(np.r_[True, place[1:] != place[:-1]])
        last = np.r_[first[1:], len(place)] - 1
        found.append((h[place[first]], place[first] + start, first + start, last + start))
    if not found:
        return (np.empty(0, np.uint64), *(np.empty(0, np.int64) for _ in range(3)))
    code, place, low, high = (np.concatenate(c) for c in zip(*found))
    # An anchor that serves windows on both sides of a chunk border is one anchor.
    fresh = np.r_[True, place[1:] != place[:-1]]
    ends = np.r_[np.flatnonzero(fresh)[1:], len(place)] - 1
    return code[fresh], place[fresh], low[fresh], high[ends]


def keyed(docs: DataFrame, ws: Workspace, id_column: str, text_column: str) -> DataFrame:
    """(key, id, text) with a unique key: the id itself if ids are whole numbers and unique, else a settled number."""
    rows = pick(docs, id_column, text_column).toDF("id", "text")
    if dict(rows.dtypes)["id"] in ("tinyint", "smallint", "int", "bigint"):
        repeated = rows.groupBy("id").count().where("id IS NULL OR count > 1").limit(1).count()
        if not repeated:
            return rows.withColumn("key", F.col("id").cast("long"))
    return ws.settle(rows.withColumn("key", F.monotonically_increasing_id()), "numbered")


# An anchor's place in its text, the windows before it, and what is known of it, in one number.
def _packed(place, before, behind, known, spread):
    return (place << 18) | (before << 10) | (behind << 2) | (known << 1) | spread


_PLACE, _BEFORE, _BEHIND = "shiftright(at, 18)", "shiftright(at, 10) & 255", "shiftright(at, 2) & 255"


def all_anchors(rows: DataFrame, depth: int, digit: int) -> DataFrame:
    """(code, context, key, at): the anchors of all texts, with a hash of the text their windows cover.

    Strings that repeat within a worker's slice are known to be repeated: one row of them is dealt by its
    string, to be company for others, the rest go anywhere, so a string in a third of all texts is no hot key.
    """
    schema = "code long, context long, key long, at long"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import xxhash

        for batch in batches:
            for part in slices(batch, "text"):
                made = []
                for key, text in zip(part.column("key").to_pylist(), part.column("text").to_pylist()):
                    data = (text or "").encode("utf-8", "surrogatepass")
                    code, place, low, high = anchors(data, depth, digit)
                    if len(code):
                        context = np.fromiter((xxhash.xxh3_64_intdigest(data[a:b + depth], seed=p - a) for a, b, p in
                                               zip(low.tolist(), high.tolist(), place.tolist())), np.uint64, len(code))
                        made.append((code, context, np.full(len(code), key, np.int64), place, place - low, place - high))
                if not made:
                    continue
                code, context, key, place, before, behind = (np.concatenate(c) for c in zip(*made))
                order = np.argsort(code, kind="stable")
                again = np.zeros(len(code), bool)
                again[order[1:]] = code[order[1:]] == code[order[:-1]]
                known = again.copy()
                known[order[:-1]] |= again[order[1:]]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(code.view(np.int64)), pa.array(context.view(np.int64)), pa.array(key),
                     pa.array(_packed(place, before, behind, known.astype(np.int64), again.astype(np.int64)))],
                    names=["code", "context", "key", "at"])

    return rows.select("key", "text").mapInArrow(run, schema)


def in_company(found: DataFrame) -> DataFrame:
    """The anchors whose string stands in several places; rows stream by in the order of strings."""
    deal = F.when(F.expr("at & 1") == 1, F.xxhash64("code", "key", "at")).otherwise(F.col("code"))
    ordered = found.repartition(deal).sortWithinPartitions("code")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, gone = None, False  # the row before, and whether it has gone out
        for batch in batches:
            if last is not None:
                batch = pa.concat_batches([last, batch])
            code = np.asarray(batch.column("code"))
            same = code[1:] == code[:-1]
            keep = np.r_[False, same] | np.r_[same, False] | (np.asarray(batch.column("at")) & 2 > 0)
            known = keep[-1]
            if gone:
                keep[0] = False
            yield batch.filter(pa.array(keep))
            last, gone = batch.slice(batch.num_rows - 1), bool(known)

    return ordered.mapInArrow(run, found.schema)


def repeated(group: np.ndarray, before: np.ndarray, behind: np.ndarray, texts: list[bytes],
             depth: int) -> list[list[tuple[int, int]]]:
    """Offset intervals (before the anchor, inclusive) of the windows of each context that another context of
    its group has as well: radix passes over the bytes, a fifth of the depth a digit."""
    size = np.fromiter(map(len, texts), np.int64, len(texts))
    base = np.cumsum(size) - size
    data = np.frombuffer(b"".join(texts) + bytes(8), np.uint8)
    n = before - behind + 1
    owner = np.repeat(np.arange(len(texts)), n)
    step = np.arange(len(owner)) - np.repeat(np.cumsum(n) - n, n)
    at, offset = base[owner] + step, before[owner] - step
    digit = -(-depth // 5)
    head = _long_hashes(data, digit)
    same = group[owner].astype(np.uint64) * np.uint64(512) + offset.astype(np.uint64)  # the groups so far
    live = np.arange(len(owner))
    for start in (*range(0, depth - digit, digit), depth - digit):
        key = _spread((same + np.uint64(1)) * np.uint64(_BASE) ^ head[at[live] + start])
        order = np.argsort(key, kind="stable")
        fresh = np.r_[True, key[order][1:] != key[order][:-1]]
        number = np.cumsum(fresh) - 1
        keep = (np.bincount(number) > 1)[number]
        live, same = live[order[keep]], number[keep].astype(np.uint64)
    # The digits were hashes: hold the bytes of each against the first of its group.
    first = np.flatnonzero(np.r_[True, same[1:] != same[:-1]]) if len(live) else np.empty(0, np.int64)
    leader = np.repeat(first, np.diff(np.r_[first, len(live)]))
    equal = np.ones(len(live), bool)
    for k in range(0, depth, 8):
        k = min(k, depth - 8)
        equal &= _eight(data, at[live] + k) == _eight(data, at[live[leader]] + k)
    equal &= (group[owner[live]] == group[owner[live[leader]]]) & (offset[live] == offset[live[leader]])
    if not equal.all():
        raise RuntimeError("two windows agree in all digits but not in their bytes")
    found: list[list[tuple[int, int]]] = [[] for _ in texts]
    live = np.sort(live)
    cut = np.flatnonzero(np.r_[True, (owner[live][1:] != owner[live][:-1]) | (offset[live][1:] != offset[live][:-1] - 1)]) \
        if len(live) else np.empty(0, np.int64)
    for i, j in zip(cut.tolist(), [*(cut[1:] - 1).tolist(), len(live) - 1]):
        found[owner[live[i]]].append((int(offset[live[j]]), int(offset[live[i]])))
    return found


def _eight(data: np.ndarray, at: np.ndarray) -> np.ndarray:
    return np.lib.stride_tricks.sliding_window_view(data, 8)[at].view(np.uint64).ravel()


def _long_hashes(data: np.ndarray, size: int) -> np.ndarray:
    """Hashes of ``size`` bytes at every place, chunk by chunk (equal bytes have equal hashes everywhere)."""
    parts = [_hashes(data[s:s + _CHUNK + size - 1], size) for s in range(0, max(1, len(data) - size + 1), _CHUNK)]
    return np.concatenate(parts)


def context_windows(contexts: DataFrame, depth: int) -> DataFrame:
    """(code, context, low, high): repeated offsets of groups whose contexts meet in a task, in order of strings."""
    ordered = contexts.repartition("code").sortWithinPartitions("code")
    schema = "code long, context long, low int, high int"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        size = 0

        def flush(rows):
            number: dict[int, int] = {}
            group = np.array([number.setdefault(r[0], len(number)) for r in rows])
            spans = repeated(group, np.array([r[2] for r in rows]), np.array([r[3] for r in rows]),
                             [r[4] for r in rows], depth)
            flat = [(r[0], r[1], a, b) for r, s in zip(rows, spans) for a, b in s]
            columns = list(zip(*flat)) or [[]] * 4
            return pa.RecordBatch.from_arrays(
                [pa.array(columns[0], pa.int64()), pa.array(columns[1], pa.int64()), pa.array(columns[2], pa.int32()),
                 pa.array(columns[3], pa.int32())], names=["code", "context", "low", "high"])

        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns)):
                if size > ORDER_BYTES and row[0] != held[-1][0]:
                    yield flush(held)
                    held, size = [], 0
                held.append(row)
                size += len(row[4])
        if held:
            yield flush(held)

    return ordered.mapInArrow(run, schema)


def spread_windows(contexts: DataFrame, depth: int) -> DataFrame:
    """(code, context, low, high) as ``context_windows`` has them, for groups of any size: a row a window,
    grouped by a 128-bit hash of its bytes with partial counts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import xxhash

        for batch in batches:
            for code, context, before, behind, text in zip(*(c.to_pylist() for c in batch.columns)):
                n = before - behind + 1
                yield pa.RecordBatch.from_arrays(
                    [pa.array([code] * n, pa.int64()), pa.array([context] * n, pa.int64()),
                     pa.array(range(before, behind - 1, -1), pa.int32()),
                     pa.array([xxhash.xxh3_128_digest(text[i:i + depth]) for i in range(n)], pa.binary())],
                    names=["code", "context", "offset", "head"])

    rows = contexts.mapInArrow(run, "code long, context long, offset int, head binary")
    same = ["code", "offset", "head"]
    groups = rows.groupBy(*same).agg(F.count("*").alias("n")).where("n > 1").drop("n")
    return rows.join(groups, same).select("code", "context", F.col("offset").alias("low"), F.col("offset").alias("high"))


_SPANS = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))


def remove_repeats(docs: DataFrame, depth: int = DEPTH, id_column: str = "doc_id", text_column: str = "text",
                   digit: int = FIRST_DIGIT, group: int = GROUP) -> DataFrame:
    """(id, n_bytes, spans, kept): every whole text without the bytes of strings of ``depth`` bytes that start elsewhere too.

    ``spans`` are the maximal removed runs in bytes (end exclusive), ``kept`` the remaining bytes joined. All
    occurrences are removed, and all are judged on the input. Null texts are empty. Rows that are repeated, with
    the same id or not, are documents of their own and repeat one another. An empty table gives an empty one.
    """
    if digit >= depth or depth < 40:
        raise ValueError("the depth must exceed the first digit, and 40 bytes")
    ws = Workspace(docs.sparkSession, "suffixes")
    rows = keyed(docs, ws, id_column, text_column)
    shared = ws.settle(in_company(all_anchors(rows, depth, digit)), "anchors")
    classes = ws.settle(shared.groupBy("code", "context").agg(
        F.count("*").alias("n"), F.min(F.struct("key", "at")).alias("one")), "classes")
    groups = classes.groupBy("code").agg(F.count("*").alias("contexts")).where("contexts > 1")
    open_ = classes.join(groups, "code").select("code", "context", F.col("contexts") > group, "one.key", "one.at").toDF(
        "code", "context", "large", "key", "at")
    asked = open_.groupBy("key").agg(F.collect_list(F.struct(
        "code", "context", "large", F.expr(_PLACE).cast("int").alias("place"), F.expr(_BEFORE).cast("int").alias("before"),
        F.expr(_BEHIND).cast("int").alias("behind"))).alias("asked"))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text", 1 << 20):
                out = []
                for text, wanted in zip(part.column("text").to_pylist(), part.column("asked").to_pylist()):
                    data = text.encode("utf-8", "surrogatepass")
                    out += [(w["code"], w["context"], w["before"], w["behind"],
                             data[w["place"] - w["before"]:w["place"] - w["behind"] + depth], w["large"]) for w in wanted]
                columns = list(zip(*out))
                kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.binary(), pa.bool_()]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)],
                                                 names=["code", "context", "before", "behind", "text", "large"])

    contexts = ws.settle(rows.join(asked, "key").select("text", "asked").mapInArrow(
        cut, "code long, context long, before int, behind int, text binary, large boolean"), "contexts")
    light = context_windows(contexts.where("NOT large").drop("large"), depth)
    heavy = spread_windows(contexts.where("large").drop("large"), depth)
    partial = ws.settle(light.unionByName(heavy), "windows")
    ws.drop("contexts")
    # Members of a class that has several repeat in all their windows, others in those found above.
    whole = shared.join(classes.where("n > 1").select("code", "context"), ["code", "context"], "left_semi").select(
        "key", (F.expr(_PLACE) - F.expr(_BEFORE)).alias("start"), (F.expr(_PLACE) - F.expr(_BEHIND) + depth).alias("end"))
    single = classes.where("n = 1").select("code", "context", F.col("one.key"), F.col("one.at")).join(
        partial, ["code", "context"]).select(
        "key", (F.expr(_PLACE) - F.col("high")).alias("start"), (F.expr(_PLACE) - F.col("low") + depth).alias("end"))
    spans = whole.unionByName(single).groupBy("key").agg(F.collect_list(F.struct("start", "end")).alias("found"))
    id_type = dict(rows.dtypes)["id"]
    schema = f"`{id_column}` {id_type}, n_bytes long, spans array<struct<start:int,end:int>>, kept binary"

    def take(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                sizes, runs, kept = [], [], []
                for text, found in zip(part.column("text").to_pylist(), part.column("found").to_pylist()):
                    data = (text or "").encode("utf-8", "surrogatepass")
                    joined: list[list[int]] = []
                    for start, end in sorted((f["start"], f["end"]) for f in found or []):
                        if joined and start <= joined[-1][1]:
                            joined[-1][1] = max(joined[-1][1], end)
                        else:
                            joined.append([start, end])
                    place, pieces = 0, []
                    for start, end in joined:
                        pieces.append(data[place:start])
                        place = end
                    sizes.append(len(data))
                    runs.append([{"start": a, "end": b} for a, b in joined])
                    kept.append(b"".join([*pieces, data[place:]]))
                yield pa.RecordBatch.from_arrays([part.column("id"), pa.array(sizes, pa.int64()), pa.array(runs, _SPANS),
                                                  pa.array(kept, pa.binary())],
                                                 names=[id_column, "n_bytes", "spans", "kept"])

    return rows.join(spans, "key", "left").select("id", "text", "found").mapInArrow(take, schema)


@query("op3_repeats")
def op3_repeats(spark, sf_dir):
    found = remove_repeats(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_bytes", (F.col("n_bytes") - F.octet_length("kept")).alias("n_removed"),
                        F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))
