"""N-gram Jaccard join by prefix filtering.

A document is the set of its word shingles. Shingles are ordered rare first, by the number of documents
that have them; two sets that reach the similarity share a shingle among the first few of each (its
prefix), so only prefixes are joined, and of these only shingles that several documents have. Exact copies of a
set are one class from the start. Within the documents that share a prefix shingle no pairs are
listed at first: each is held against the one with the fewest shingles of its own, and what that connects is
never compared again. Only documents of different components are then joined pair by pair, past
length, positional and suffix filters, and every pair is verified once on the whole sets.

Document counts are exact up to shared hashes. Rows of shingles would be several times the input, so each
file block sends the sorted hashes of its shingles as packed differences, and is sent back those
that other blocks or several of its documents have, with the size of their count.
"""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wireglean.llm.common import BATCH_BYTES, Workspace, components, file_system, held, pick, query, slices, table, tidied
from wireglean.llm.fm_index import joined, words

SHINGLE_WORDS = 5
#: Similarity as a fraction: linked when DOWN * intersection >= UP * union.
UP, DOWN = 80, 100
#: Bits of a shingle that its count goes by. Shingles that agree in them count together, which makes them
#: look shared, never unique.
COUNTED_BITS = 44
#: Folders among which the counts of blocks are written.
FOLDERS = 256
#: Verified pairs of one document that go to one task.
PARTNERS = 256
_BITS = 50
#: Longs of the bitmap that a prefix row carries.
_MAP = 4
_BEFORE = [f"before{k}" for k in range(_MAP)]
_ROWS = 256
_IS_WORD = np.ones(256, bool)
_IS_WORD[[0x20, *range(0x09, 0x0E)]] = False
_K = np.uint64(0x9E3779B97F4A7C15)


def _mix(h: np.ndarray, odd: int) -> np.ndarray:
    h = (h ^ (h >> np.uint64(31))) * np.uint64(odd)
    return h ^ (h >> np.uint64(29))


def shingle_sets(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """(document number, shingle) of the distinct shingles of at most 256 texts, sorted by both.

    A shingle is 50 bits of the hash of its words; a text of fewer words has its whole sequence.
    """
    data, begin = joined(texts, b"\n")
    _, start, _, code = words(data, _IS_WORD)
    doc = np.searchsorted(begin, start, "right") - 1
    n = np.bincount(doc, minlength=len(texts))
    h = np.zeros(max(0, len(code) - SHINGLE_WORDS + 1), np.uint64)
    for i in range(SHINGLE_WORDS):
        h = h * _K + code[i:i + len(h)]
    whole = doc[:len(h)] == doc[len(code) - len(h):] if len(h) else np.empty(0, bool)
    own, at = doc[:len(h)][whole], h[whole]
    short = np.flatnonzero((n > 0) & (n < SHINGLE_WORDS))
    if len(short):
        first = np.searchsorted(doc, short)
        rest = np.zeros(len(short), np.uint64)
        for i in range(SHINGLE_WORDS - 1):
            more = n[short] > i
            rest[more] = rest[more] * _K + code[first[more] + i]
        own, at = np.r_[own, short], np.r_[at, rest + n[short].astype(np.uint64)]
    key = np.unique((own.astype(np.uint64) << np.uint64(_BITS)) | (_mix(at, 0xBF58476D1CE4E5B9) >> np.uint64(64 - _BITS)))
    return (key >> np.uint64(_BITS)).astype(np.int64), key & np.uint64((1 << _BITS) - 1)


def in_blocks(docs: DataFrame, ws: Workspace, id_column: str, text_column: str) -> DataFrame:
    """(id, text, block): each row with a number for the block of the file it lies in, the same in every pass.

    A table that is not read from files is settled first.
    """
    block = F.expr("xxhash64(_metadata.file_path, _metadata.file_block_start)")
    try:
        rows = docs.select(F.col(f"`{id_column}`"), F.col(f"`{text_column}`"), block)
    except AnalysisException:
        rows = ws.settle(pick(docs, id_column, text_column).toDF("id", "text"), "documents").select("id", "text", block)
    return rows.toDF("id", "text", "block").withColumn("id", F.col("id").cast("long"))


def _pack(numbers: np.ndarray) -> bytes:
    """Sorted numbers as compressed differences, byte plane by byte plane."""
    import zstandard

    planes = np.diff(numbers, prepend=np.uint64(0)).astype("<u8").view(np.uint8).reshape(-1, 8).T
    return held(("packer",), lambda: zstandard.ZstdCompressor(level=1)).compress(planes.tobytes())


def _unpack(packed: bytes) -> np.ndarray:
    import zstandard

    raw = held(("unpacker",), zstandard.ZstdDecompressor).decompress(packed)
    return np.cumsum(np.ascontiguousarray(np.frombuffer(raw, np.uint8).reshape(8, -1).T).view("<u8").ravel())


_PROFILE = "id long, n long, s1 long, s2 long, block long, range int, shingles binary, counts binary"


def profile(rows: DataFrame, ranges: int) -> DataFrame:
    """Two kinds of rows: (id, n, s1, s2) of each document, and (block, range, shingles, counts) of each file block.

    s1 and s2 are two sums over the set: equal sets have equal sums. The shingles of a block are those of its
    documents, cut into ranges of hashes, each with the number of the block's documents that have it (255 at most).
    """
    shift = np.uint64(_BITS - COUNTED_BITS)
    per_range = np.uint64(COUNTED_BITS - (ranges - 1).bit_length())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, parts = None, []

        def ended() -> Iterator[pa.RecordBatch]:
            used, shingles, counts, size = [], [], [], 0

            def sent() -> pa.RecordBatch:
                none = pa.nulls(len(used), pa.int64())
                return pa.RecordBatch.from_arrays(
                    [none, none, none, none, pa.array([block] * len(used), pa.int64()), pa.array(used, pa.int32()),
                     pa.array(shingles, pa.binary()), pa.array(counts, pa.binary())],
                    names=["id", "n", "s1", "s2", "block", "range", "shingles", "counts"])

            for r, (found, n) in counted_ranges(parts, ranges, per_range):
                used.append(r)
                shingles.append(_pack(found))
                counts.append(np.minimum(n, 255).astype(np.uint8).tobytes())
                size += len(shingles[-1]) + len(counts[-1])
                if size > BATCH_BYTES:
                    yield sent()
                    used, shingles, counts, size = [], [], [], 0
            if used:
                yield sent()

        for batch in batches:
            for part in _by_block(batch):
                own = part.column("block")[0].as_py()
                if own != block and parts:
                    yield from ended()
                    parts = []
                block = own
                doc, shingle = shingle_sets(part.column("text").to_pylist())
                parts.append(shingle >> shift)
                if len(parts) > 64:  # what repeats within the block is counted once all of it is there
                    parts = [np.concatenate(parts)]
                n = np.bincount(doc, minlength=part.num_rows)
                sums = [np.zeros(part.num_rows, np.uint64) for _ in range(2)]
                if len(doc):
                    first = np.flatnonzero(np.r_[True, doc[1:] != doc[:-1]])
                    for s, odd in zip(sums, (0x94D049BB133111EB, 0xD6E8FEB86659FD93)):
                        s[doc[first]] = np.add.reduceat(_mix(shingle + np.uint64(1), odd), first)
                k = part.num_rows
                yield pa.RecordBatch.from_arrays(
                    [part.column("id"), pa.array(n, pa.int64()), *(pa.array(s.view(np.int64)) for s in sums),
                     pa.nulls(k, pa.int64()), pa.nulls(k, pa.int32()), pa.nulls(k, pa.binary()), pa.nulls(k, pa.binary())],
                    names=["id", "n", "s1", "s2", "block", "range", "shingles", "counts"])
        if parts:
            yield from ended()

    return rows.select("id", "text", "block").mapInArrow(tidied(run), _PROFILE)


def counted_ranges(parts: list[np.ndarray], ranges: int, per_range: np.uint64):
    """(range, (distinct numbers, how often each stands there)) of each range that has some. ``parts`` is emptied: one sorted
    copy of the numbers is all that is kept of a block, and copies for counting are of one range."""
    numbers = np.concatenate(parts)
    parts.clear()
    numbers.sort()
    edge = np.searchsorted(numbers, np.arange(1, ranges, dtype=np.uint64) << per_range)
    for r, own in enumerate(np.split(numbers, edge)):
        if len(own):
            yield r, np.unique(own, return_counts=True)


def _by_block(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """Bounded pieces of a batch that stay within a file block."""
    block = np.asarray(batch.column("block"))
    edge = np.flatnonzero(np.r_[True, block[1:] != block[:-1], True]) if len(block) else []
    for a, b in zip(edge[:-1], edge[1:]):
        yield from slices(batch.slice(a, b - a), "text", rows=_ROWS)


def shared_shingles(profiled: DataFrame) -> DataFrame:
    """(folder, block, range, shingles, sizes): of each block the shingles that several documents have anywhere, and
    the logarithm of their number. Ranges come one after another, each a small share of all shingles."""
    lists = profiled.where("block IS NOT NULL").select("block", "range", "shingles", "counts")
    ordered = lists.repartition("range").sortWithinPartitions("range")
    schema = "folder int, block long, range int, shingles binary, sizes binary"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, rows = None, []

        def merged() -> Iterator[pa.RecordBatch]:
            parts = [_unpack(r[2]) for r in rows]
            found, place = np.unique(np.concatenate(parts), return_inverse=True)
            n = np.bincount(place, weights=np.concatenate([np.frombuffer(r[3], np.uint8) for r in rows]).astype(float))
            size = np.minimum(63, 4 * np.log2(n)).astype(np.uint8)[place]
            several = (n > 1)[place]
            at = 0
            for (block, number, _, _), own in zip(rows, parts):
                keep = several[at:at + len(own)]
                if keep.any():
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([block % FOLDERS], pa.int32()), pa.array([block], pa.int64()), pa.array([number], pa.int32()),
                         pa.array([_pack(own[keep])], pa.binary()),
                         pa.array([size[at:at + len(own)][keep].tobytes()], pa.binary())],
                        names=["folder", "block", "range", "shingles", "sizes"])
                at += len(own)

        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns)):
                if rows and row[1] != current:
                    yield from merged()
                    rows = []
                current = row[1]
                rows.append(row)
        if rows:
            yield from merged()

    return ordered.mapInArrow(tidied(run), schema)


def _counts_of(path: str, block: int) -> tuple[np.ndarray, np.ndarray]:
    """(shingles, sizes) of a block, read inside a task from the folder that holds it."""
    import pyarrow.dataset as ds
    from pyarrow import fs

    store, name = file_system(path)
    folder = f"{name}/folder={block % FOLDERS}"
    if store.get_file_info(folder).type == fs.FileType.NotFound:
        return np.empty(0, np.uint64), np.empty(0, np.uint8)
    files = sorted(f.path for f in store.get_file_info(fs.FileSelector(folder)) if f.path.endswith(".parquet"))
    found = ds.dataset(files, filesystem=store, format="parquet").to_table(filter=ds.field("block") == block).sort_by("range")
    if not found.num_rows:
        return np.empty(0, np.uint64), np.empty(0, np.uint8)
    return (np.concatenate([_unpack(p) for p in found["shingles"].to_pylist()]),
            np.concatenate([np.frombuffer(p, np.uint8) for p in found["sizes"].to_pylist()]))


def prefixes(rows: DataFrame, path: str) -> DataFrame:
    """(shingle, id, n, place, own, before0 to before3) of the prefix of each document, once a task for equal sets.

    The order is rare first: by the logarithm of the count, then by the shingle itself. Shingles that no other
    document has are the first, ``own`` of them; they have their places but are not sent, since nothing meets them.
    The four longs are a bitmap of the shared shingles that stand before a row's.
    """
    shift = np.uint64(_BITS - COUNTED_BITS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[bytes] = set()
        block, known, size = None, np.empty(0, np.uint64), np.empty(0, np.uint8)
        for batch in batches:
            for part in _by_block(batch):
                if part.column("block")[0].as_py() != block:
                    block = part.column("block")[0].as_py()
                    known, size = _counts_of(path, block)
                doc, shingle = shingle_sets(part.column("text").to_pylist())
                if not len(doc) or not len(known):
                    continue
                short = shingle >> shift
                at = np.minimum(np.searchsorted(known, short), len(known) - 1)
                step = np.where(known[at] == short, size[at], 0).astype(np.uint64)
                n = np.bincount(doc, minlength=part.num_rows)
                first = np.cumsum(n) - n
                own = np.bincount(doc, weights=step == 0, minlength=part.num_rows).astype(np.int64)
                key = np.sort((doc.astype(np.uint64) << np.uint64(_BITS + 6)) | (step << np.uint64(_BITS)) | shingle)
                shingle = key & np.uint64((1 << _BITS) - 1)
                last = n - -(-UP * n // DOWN)  # the last place of the prefix
                fresh = np.zeros(part.num_rows, bool)
                for d in np.flatnonzero((n > 0) & (own <= last)):
                    name = _digest(shingle[first[d]:first[d] + n[d]])
                    if name not in seen:
                        fresh[d] = True
                        if len(seen) < 1_000_000:  # a memory for repeated sets; what it forgets is merely sent twice
                            seen.add(name)
                place = np.arange(len(doc)) - first[doc]
                keep = fresh[doc] & (place >= own[doc]) & (place <= last[doc])
                ids = np.array([i if i is not None else 0 for i in part.column("id").to_pylist()])
                shingle, doc, place = shingle[keep], doc[keep], place[keep]
                before = _bits_before(shingle, doc)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(shingle.astype(np.int64)), pa.array(ids[doc], pa.int64()), pa.array(n[doc], pa.int32()),
                     pa.array(place, pa.int32()), pa.array(own[doc], pa.int32()),
                     *(pa.array(np.ascontiguousarray(before[:, k]).view(np.int64)) for k in range(_MAP))],
                    names=["shingle", "id", "n", "place", "own", *_BEFORE])

    return rows.select("id", "text", "block").where("id IS NOT NULL").mapInArrow(
        tidied(run), "shingle long, id long, n int, place int, own int, " + ", ".join(f"{b} long" for b in _BEFORE))


def _bits_before(shingle: np.ndarray, doc: np.ndarray) -> np.ndarray:
    """For each row the bits of the rows of its document that come before it."""
    bits = np.zeros((len(shingle) + 1, _MAP), np.uint64)
    bits[np.arange(len(shingle)) + 1, (shingle >> np.uint64(6)).astype(np.int64) % _MAP] = (
        np.uint64(1) << (shingle & np.uint64(63)))
    first = np.flatnonzero(np.r_[True, doc[1:] != doc[:-1]]) if len(doc) else []
    for a, b in zip(first, [*first[1:], len(doc)]):
        bits[a] = 0
        bits[a:b] = np.bitwise_or.accumulate(bits[a:b], axis=0)
    return bits[:-1]


def _digest(shingles: np.ndarray) -> bytes:
    import hashlib

    return hashlib.blake2b(shingles.tobytes(), digest_size=16).digest()


def _alpha(a: str, b: str):
    """Shared shingles that sets of sizes a and b need: the smallest I with DOWN * I >= UP * (a + b - I)."""
    return F.ceil(F.lit(UP) * (F.col(a) + F.col(b)) / F.lit(UP + DOWN) - F.lit(1e-9))


def _lengths(small: str, large: str):
    """The length filter: the smaller set alone must be able to reach the share."""
    return F.col(small) * DOWN >= F.col(large) * UP


def star_pairs(members: DataFrame) -> DataFrame:
    """(a, b): each member of a bucket with the one that has the fewest shingles of its own, once, past the
    length filter. In a group of edited copies that is the text the others were made from."""
    least = members.groupBy("shingle").agg(F.min(F.struct("own", "n", "node")).alias("least"))
    pairs = members.join(least, "shingle").where("node <> least.node").withColumn("m", F.col("least.n"))
    return (pairs.where(_lengths("m", "n") & _lengths("n", "m"))
            .select(F.col("least.node").alias("a"), F.col("node").alias("b")).distinct())


def cross_pairs(members: DataFrame, component: DataFrame, known: DataFrame) -> DataFrame:
    """(a, b): members of one bucket in different components that pass length and positional filters and
    were not compared before; each pair once."""
    placed = members.join(component, "node", "left").withColumn("component", F.coalesce("component", "node"))
    mixed = (placed.groupBy("shingle").agg(F.min("component").alias("low"), F.max("component").alias("high"))
             .where("low <> high").select("shingle"))
    left = placed.join(mixed, "shingle")
    right = left.select("shingle", *[F.col(c).alias(f"{c}_b") for c in ("node", "n", "place", "own", "component", *_BEFORE)])
    # At a shared shingle, what can be shared is at most what can be shared of what stands before, itself, and the
    # lesser of what stands behind. Before it, shingles of their own are not shared, and each bit that only one
    # has stands for at least one shingle that the other lacks.
    lacking = lambda x, y: sum((F.bit_count(F.col(f"{b}{x}").bitwiseAND(F.bitwise_not(F.col(f"{b}{y}"))))
                                for b in _BEFORE), F.lit(0))
    bound = (F.least(F.col("place") - F.col("own") - lacking("", "_b"), F.col("place_b") - F.col("own_b") - lacking("_b", "")) + 1
             + F.least(F.col("n") - F.col("place"), F.col("n_b") - F.col("place_b")) - 1)
    pairs = left.join(right, "shingle").where(
        (F.struct("n", "node") < F.struct("n_b", "node_b")) & (F.col("component") != F.col("component_b"))
        & _lengths("n", "n_b") & (bound >= _alpha("n", "n_b")))
    return (pairs.select(F.col("node").alias("a"), F.col("node_b").alias("b")).distinct()
            .join(known.unionByName(known.select(F.col("b").alias("a"), F.col("a").alias("b"))), ["a", "b"], "left_anti"))


def _overlap(x: np.ndarray, y: np.ndarray, need: int, depth: int = 3) -> int:
    """At most how many elements two sorted sets share, by halving (the suffix filter); exact sets are cut at
    the middle of the larger, and the lesser of each half's sizes bounds it."""
    if depth == 0 or min(len(x), len(y)) < 8:
        return min(len(x), len(y))
    middle = y[len(y) // 2]
    i, j = int(np.searchsorted(x, middle)), len(y) // 2
    low, high = min(i, j), min(len(x) - i, len(y) - j)
    if low + high < need:
        return low + high
    low = _overlap(x[:i], y[:j], need - high, depth - 1)
    return low + high if low + high < need else low + _overlap(x[i:], y[j:], need - low, depth - 1)


def verified(pairs: DataFrame, texts: DataFrame, ws: Workspace, name: str) -> DataFrame:
    """(u, v): the pairs that reach the similarity on their whole sets.

    A document's pairs are dealt in groups of about ``PARTNERS``, each with one copy of its text; a
    group streams by behind that text.
    """
    degree = pairs.groupBy("a").agg(F.ceil(F.count("*") / F.lit(PARTNERS)).alias("groups"))
    dealt = ws.settle(pairs.join(degree, "a").select("a", "b", F.pmod(F.xxhash64("b"), "groups").alias("deal")), name)
    first = dealt.select("a", "deal").distinct().withColumn("id", F.col("a")).withColumn("kind", F.lit(0))
    rest = dealt.select("a", "deal", F.col("b").alias("id"), F.lit(1).alias("kind"))
    rows = first.unionByName(rest).join(texts, "id").select("a", "deal", "kind", "id", "text")
    ordered = rows.repartition("a", "deal").sortWithinPartitions("a", "deal", "kind", "id")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, sets = None, []
        for batch in batches:
            for part in slices(batch, "text", rows=_ROWS):
                doc, shingle = shingle_sets(part.column("text").to_pylist())
                at = np.searchsorted(doc, np.arange(part.num_rows + 1))
                found: list[tuple[int, int]] = []
                for i, (a, deal, kind, id_) in enumerate(zip(*(part.column(c).to_pylist()
                                                               for c in ("a", "deal", "kind", "id")))):
                    own = shingle[at[i]:at[i + 1]]
                    if kind == 0:
                        if current != (a, deal):
                            current, sets = (a, deal), []
                        sets.append(own)  # more than one only where a document id stands for several texts
                    elif any(_linked(s, own) for s in sets if current == (a, deal)):
                        found.append((a, id_))
                yield pa.RecordBatch.from_pydict({"u": pa.array([f[0] for f in found], pa.int64()),
                                                  "v": pa.array([f[1] for f in found], pa.int64())})

    return ordered.mapInArrow(tidied(run), "u long, v long").distinct()


def _linked(x: np.ndarray, y: np.ndarray) -> bool:
    if not len(x) or not len(y):
        return False
    need = -(-UP * (len(x) + len(y)) // (UP + DOWN))
    if min(len(x), len(y)) < need or _overlap(x, y, need) < need:
        return False
    both = np.concatenate([x, y])
    both.sort()
    return int((both[1:] == both[:-1]).sum()) >= need


def near_duplicates(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """(id, n_shingles, component_id) of every row: classes of documents with a Jaccard similarity of 0.8 or more.

    ``component_id`` is the smallest id reachable by links. Null and empty texts have no shingles and link
    with nothing. Rows of one id are one document: what links with either links with both. Rows without id
    are linked with nothing and have no component. An empty table gives an empty one.
    """
    spark = docs.sparkSession
    ws = Workspace(spark, "jaccard")
    rows = in_blocks(docs, ws, id_column, text_column)
    ranges = 1 << max(6, (4 * int(spark.conf.get("spark.sql.shuffle.partitions")) - 1).bit_length())
    profiled = ws.settle(profile(rows, ranges), "profile")
    shared_shingles(profiled).repartition("block").write.partitionBy("folder").parquet(f"{ws.folder}/counts")
    # Equal sets are one class, named by its smallest id; a class with a large share of the rows combines
    # before the shuffle, and the join back is one the session splits.
    sized = profiled.where("block IS NULL").select("id", "n", "s1", "s2")
    classes = sized.where("n > 0 AND id IS NOT NULL").groupBy("n", "s1", "s2").agg(F.min("id").alias("node"))
    mapped = ws.settle(sized.join(classes, ["n", "s1", "s2"], "left").select(
        "id", "n", F.when(F.col("id").isNotNull(), F.coalesce("node", "id")).alias("node")), "mapped")
    ws.drop("profile")
    named = rows.where("id IS NOT NULL").select("id", "text")
    own = mapped.where("id IS NOT NULL").select("id", "node").distinct()
    sent = ws.settle(prefixes(rows, f"{ws.folder}/counts"), "prefixes")
    ws.drop("counts")
    members = sent.join(own, "id").select("shingle", "node", "n", "place", "own", *_BEFORE).distinct()
    several = (members.groupBy("shingle").agg(F.min("node").alias("low"), F.max("node").alias("high"))
               .where("low <> high").select("shingle"))
    members = ws.settle(members.join(several, "shingle"), "members")
    ws.drop("prefixes")
    texts = ws.settle(named.join(members.select(F.col("node").alias("id")).distinct(), "id"), "texts")
    stars = ws.settle(star_pairs(members), "stars")
    links = ws.settle(verified(stars, texts, ws, "star-deal"), "star-links")
    # Rows that share an id may belong to several classes: the id links them.
    links = links.unionByName(own.where("id <> node").select(F.col("id").alias("u"), F.col("node").alias("v"))
                              .join(own.groupBy("id").agg(F.count("*").alias("k")).where("k > 1")
                                    .select(F.col("id").alias("u")), "u"))
    first = components(links, ws, "first")
    cross = ws.settle(cross_pairs(members, first, stars), "cross")
    more = ws.settle(verified(cross, texts, ws, "cross-deal"), "cross-links")
    final = components(links.unionByName(more), ws, "final") if more.limit(1).count() else first
    found = mapped.join(final.distinct(), "node", "left")
    return found.select(F.col("id").alias(id_column), F.col("n").alias("n_shingles"),
                        F.coalesce("component", "node").alias("component_id"))


_SQL = r"""
WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[^ 	-
]+') AS w FROM documents),
p AS (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS i FROM w WHERE len(w) > 0),
s AS (SELECT DISTINCT doc_id, array_to_string(w[i:i + 4], ' ') AS g FROM p),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY 1),
rare AS (SELECT g, min(doc_id) AS first FROM s GROUP BY g HAVING count(*) > 1),
o AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS shared FROM s a JOIN rare USING (g) JOIN s b USING (g)
      WHERE a.doc_id <> b.doc_id GROUP BY 1, 2),
e AS (SELECT a, b FROM o JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * shared >= 80 * (x.n + y.n - shared)),
r AS (SELECT doc_id AS a, doc_id AS b FROM documents UNION SELECT r.a, e.b FROM r JOIN e ON r.b = e.a),
c AS (SELECT a AS doc_id, min(b) AS component_id FROM r GROUP BY 1)
SELECT doc_id, coalesce(n, 0) AS n_shingles, component_id FROM c LEFT JOIN n USING (doc_id)
"""


@query("op6_jaccard", _SQL)
def op6_jaccard(spark, sf_dir):
    return near_duplicates(table(spark, sf_dir, "documents"))
