"""Benchmark decontamination with an FM-index per training shard.

A shard is a bounded run of documents inside a task. Its words are hashed in numpy; words that no
benchmark item contains (a fixed-size bitmap tells) can be part of no match, so only stretches of
other words that are long enough are indexed. The index is a wavelet matrix over the
Burrows-Wheeler transform with sampled suffix positions. The benchmark's windows are searched
backwards through the wavelet ranks, all at once; occurrences are located by walking to a sampled
position, compared with the words themselves, and merged to spans.
"""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wireglean.llm.common import Workspace, held, parquet_batches, pick, query, slices, table, tidied

WINDOW_WORDS = 13
#: Bits of the bitmap of benchmark words: its size does not grow with the benchmark.
BITMAP_BITS = 1 << 22
#: Every so many text positions one suffix position is kept.
SAMPLE_EVERY = 16
#: Windows of the benchmark that a task holds at once.
PATTERN_ROWS = 50_000

# Words are runs of ASCII letters, ASCII digits and everything beyond ASCII; A-Z is lowered.
_IS_WORD = np.zeros(256, bool)
for _a, _b in ((0x30, 0x39), (0x41, 0x5A), (0x61, 0x7A), (0x80, 0xFF)):
    _IS_WORD[_a:_b + 1] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 32
_BASE = np.uint64(0x9E3779B97F4A7C55)
_HASH_BYTES = 1 << 18


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    return held(("powers", n), lambda: _make_powers(n))


def _make_powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the odd base modulo 2**64, and of its inverse."""
    up, down = np.full(n, _BASE, np.uint64), np.full(n, pow(int(_BASE), -1, 1 << 64), np.uint64)
    up[0] = down[0] = 1
    return np.multiply.accumulate(up), np.multiply.accumulate(down)


def words(data: np.ndarray, is_word: np.ndarray = _IS_WORD) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(lowered bytes, first byte, end, 64-bit hash) of the words in UTF-8 bytes."""
    inside = is_word[data]
    edge = np.flatnonzero(np.diff(np.r_[False, inside, False].view(np.int8)))
    start, end = edge[::2], edge[1::2]
    data = _LOWER[data]
    hashes = np.empty(len(start), np.uint64)
    i = 0
    while i < len(start):  # stretches that stay in the processor's cache
        base = start[i]
        j = max(i + 1, int(np.searchsorted(end, base + _HASH_BYTES, "right")))
        length = int(end[j - 1] - base)
        up, down = _powers(max(_HASH_BYTES, 1 << (length - 1).bit_length()) if length else _HASH_BYTES)
        total = np.zeros(length + 1, np.uint64)
        np.cumsum((data[base:base + length].astype(np.uint64) + np.uint64(1)) * up[:length], out=total[1:])
        a, b = start[i:j] - base, end[i:j] - base
        hashes[i:j] = (total[b] - total[a]) * down[a]
        i = j
    hashes ^= hashes >> np.uint64(29)
    hashes *= np.uint64(0xBF58476D1CE4E5B9)
    hashes ^= hashes >> np.uint64(32)
    return data, start, end, hashes


def joined(texts: list[str | None], border: bytes = b"\0") -> tuple[np.ndarray, np.ndarray]:
    """All texts as UTF-8 bytes with a border byte behind each, and where each begins (and the end)."""
    parts = [(t or "").encode("utf-8", "replace") for t in texts]
    begin = np.cumsum([0, *(len(p) + 1 for p in parts)])
    return np.frombuffer(border.join([*parts, b""]), np.uint8), begin


class WaveletMatrix:
    """Ranks of symbols in a sequence, one bit of the symbols a level."""

    def __init__(self, sequence: np.ndarray, symbols: int):
        self.levels = []
        for shift in range(max(1, int(symbols - 1).bit_length()) - 1, -1, -1):
            bits = (sequence >> shift) & 1
            ones = np.zeros(len(sequence) + 1, np.int32)
            np.cumsum(bits, out=ones[1:])
            zeros = len(sequence) - int(ones[-1])
            self.levels.append((shift, ones, zeros))
            sequence = np.concatenate([sequence[bits == 0], sequence[bits == 1]])

    def rank(self, symbol: np.ndarray, before: np.ndarray) -> np.ndarray:
        """How often each symbol stands before each place."""
        start, at = np.zeros_like(before), before
        for shift, ones, zeros in self.levels:
            high = (symbol >> shift) & 1 == 1
            at = np.where(high, zeros + ones[at], at - ones[at])
            start = np.where(high, zeros + ones[start], start - ones[start])
        return at - start


class FMIndex:
    """An index over stretches of symbols (1, 2, ...), with 0 behind each stretch."""

    def __init__(self, sequence: np.ndarray, symbols: int):
        n = len(sequence)
        order = self._suffixes(sequence)
        self.bwt = sequence[order - 1]
        self.wavelet = WaveletMatrix(self.bwt, symbols)
        self.before = np.r_[0, np.cumsum(np.bincount(sequence, minlength=symbols))].astype(np.int64)
        # Sampled by place in the text; places behind a border too, so that no walk crosses one.
        sampled = (order % SAMPLE_EVERY == 0) | (self.bwt == 0)
        self.position = np.where(sampled, order, -1)
        self.n = n

    @staticmethod
    def _suffixes(sequence: np.ndarray) -> np.ndarray:
        """Suffix order by doubling; every border counts as a symbol of its own."""
        n = len(sequence)
        border = sequence == 0
        rank = np.where(border, np.cumsum(border), sequence.astype(np.int64) + border.sum())
        step = 1
        while True:
            after = np.zeros(n, np.int64)
            after[:n - step] = rank[step:] + 1
            key = rank * (int(after.max()) + 1) + after
            order = np.argsort(key, kind="stable")
            ordered = key[order]
            fresh = np.r_[False, ordered[1:] != ordered[:-1]]
            rank = np.empty(n, np.int64)
            rank[order] = np.cumsum(fresh)
            if rank[order[-1]] == n - 1 or step >= n:
                return order
            step *= 2

    def search(self, patterns: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(pattern, first row, end row) of the patterns (one a row, symbols > 0) that occur."""
        which = np.arange(len(patterns))
        low, high = np.zeros(len(patterns), np.int64), np.full(len(patterns), self.n, np.int64)
        for j in range(patterns.shape[1] - 1, -1, -1):
            symbol = patterns[which, j]
            low = self.before[symbol] + self.wavelet.rank(symbol, low)
            high = self.before[symbol] + self.wavelet.rank(symbol, high)
            live = low < high
            which, low, high = which[live], low[live], high[live]
        return which, low, high

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Text positions of suffix rows: walk back until a row whose position was kept."""
        rows, steps = rows.copy(), np.zeros(len(rows), np.int64)
        open_ = np.flatnonzero(self.position[rows] < 0)
        while len(open_):
            at = rows[open_]
            symbol = self.bwt[at]
            rows[open_] = self.before[symbol] + self.wavelet.rank(symbol, at)
            steps[open_] += 1
            open_ = open_[self.position[rows[open_]] < 0]
        return self.position[rows] + steps


class Windows:
    """A bounded block of the benchmark's windows: distinct ones, and the items of each."""

    def __init__(self, batch: pa.RecordBatch):
        n = np.asarray(batch.column("n"))
        hashes = [np.frombuffer(b, np.uint64) for b in batch.column("hashes").to_pylist()]
        text, item = batch.column("window").to_pylist(), batch.column("item").to_pylist()
        self.text: list[str] = []
        self.items: list[set[str]] = []
        known: dict[str, int] = {}
        rows: dict[int, list[int]] = {}
        kept: list[np.ndarray] = []
        for i, t in enumerate(text):
            if t not in known:
                known[t] = len(self.text)
                self.text.append(t)
                self.items.append(set())
                rows.setdefault(int(n[i]), []).append(len(kept))
                kept.append(hashes[i])
            if item[i] is not None:
                self.items[known[t]].add(item[i])
        self.by_length = {m: (np.array(ids), np.stack([kept[i] for i in ids])) for m, ids in rows.items()}


def blocks(path: str, rows: int) -> Iterator[Windows]:
    """The benchmark's windows: a small set stays in the worker, a large one is read block by block."""
    if rows <= PATTERN_ROWS:
        yield from held(("windows", path), lambda: [Windows(b) for b in parquet_batches(path, PATTERN_ROWS)], 1)
    else:
        yield from map(Windows, parquet_batches(path, PATTERN_ROWS))


def windows(benchmark: DataFrame, size: int, id_column: str, text_column: str) -> DataFrame:
    """(item string, n, hashes binary, window string): the windows of each item."""
    rows = pick(benchmark, id_column, text_column)
    rows = rows.select(F.col(id_column).cast("string").alias("item"), F.col(text_column).cast("string").alias("text"))

    def run(batches):
        for batch in batches:
            for item, text in zip(*(c.to_pylist() for c in batch.columns)):
                data, begin = joined([text])
                data, start, end, hashes = words(data)
                n = min(size, len(start))
                if not n:
                    continue
                raw = data.tobytes()
                spelled = [raw[a:b].decode() for a, b in zip(start, end)]
                for first in range(0, len(start) - n + 1, PATTERN_ROWS):
                    at = range(first, min(first + PATTERN_ROWS, len(start) - n + 1))
                    yield pa.RecordBatch.from_pydict({
                        "item": pa.array([item] * len(at), pa.string()), "n": pa.array([n] * len(at), pa.int32()),
                        "hashes": pa.array([hashes[i:i + n].tobytes() for i in at], pa.binary()),
                        "window": pa.array([" ".join(spelled[i:i + n]) for i in at], pa.string())})

    return rows.mapInArrow(run, "item string, n int, hashes binary, window string").distinct()


def find(texts: list[str | None], known: np.ndarray, least: int, path: str, pattern_rows: int):
    """(words, hit words, spans, items) of each text of a shard; spans count characters."""
    data, begin = joined(texts)
    lowered, start, end, hashes = words(data)
    doc = np.searchsorted(begin, start, "right") - 1
    n_words = np.bincount(doc, minlength=len(texts))
    # Stretches, within one document, of words that the benchmark may have.
    may = known[(hashes >> np.uint64(20)).astype(np.int64) & (BITMAP_BITS - 1)]
    run = np.cumsum(np.r_[True, (doc[1:] != doc[:-1]) | ~may[1:] | ~may[:-1]]) if len(may) else np.empty(0, np.int64)
    long_ = may & (np.bincount(run)[run] >= least) if len(may) else may
    at = np.flatnonzero(long_)
    hits: list[tuple[int, int]] = []
    items: list[set[str]] = [set() for _ in texts]
    cover = np.zeros(len(start) + 1, np.int64)
    if len(at):
        vocabulary, symbol = np.unique(hashes[at], return_inverse=True)
        last = np.r_[run[at][1:] != run[at][:-1], True]  # a border behind the last word of each stretch
        place = np.arange(len(at)) + np.r_[0, np.cumsum(last)[:-1]]
        sequence = np.zeros(len(at) + int(last.sum()), np.int64)
        sequence[place] = symbol + 1
        word = np.full(len(sequence), -1, np.int64)
        word[place] = at
        index = FMIndex(sequence, len(vocabulary) + 1)
        raw = lowered.tobytes()
        for block in blocks(path, pattern_rows):
            for n, (ids, codes) in block.by_length.items():
                found = np.minimum(np.searchsorted(vocabulary, codes), len(vocabulary) - 1)
                whole = np.flatnonzero((vocabulary[found] == codes).all(axis=1))
                which, low, high = index.search(found[whole] + 1)
                rows = np.repeat(low - np.r_[0, np.cumsum(high - low)[:-1]], high - low) + np.arange((high - low).sum())
                first = word[index.locate(rows)]
                for window, w in zip(np.repeat(ids[whole[which]], high - low).tolist(), first.tolist()):
                    spelled = b" ".join(raw[a:b] for a, b in zip(start[w:w + n], end[w:w + n]))
                    if spelled.decode() == block.text[window]:
                        hits.append((w, n))
                        items[doc[w]] |= block.items[window]
    if hits:
        np.add.at(cover, [w for w, _ in hits], 1)
        np.add.at(cover, [w + n for w, n in hits], -1)
    hit = np.cumsum(cover)[:-1] > 0
    n_hit = np.bincount(doc, weights=hit, minlength=len(texts)).astype(np.int64) if len(doc) else n_words * 0
    spans: list[list[dict]] = [[] for _ in texts]
    if hits:
        first = np.flatnonzero(hit & np.r_[True, ~hit[:-1] | (doc[1:] != doc[:-1])])
        final = np.flatnonzero(hit & np.r_[~hit[1:] | (doc[1:] != doc[:-1]), True])
        for a, b in zip(first.tolist(), final.tolist()):
            d = int(doc[a])
            own = data[begin[d]:begin[d + 1]].tobytes()
            low = len(own[:start[a] - begin[d]].decode())
            spans[d].append({"start": low, "end": low + len(own[start[a] - begin[d]:end[b] - begin[d]].decode())})
    return n_words, n_hit, spans, [sorted(i) for i in items]


def decontaminate(docs: DataFrame, benchmark: DataFrame, size: int = WINDOW_WORDS, id_column: str = "doc_id",
                  text_column: str = "text", item_column: str = "item_id", item_text: str = "text",
                  carry: tuple[str, ...] = ()) -> DataFrame:
    """(id, n_words, n_hit, spans, items, contaminated, carried columns) of every whole text.

    ``spans`` are the merged removal spans (characters, end exclusive), ``items`` the ids of the
    items with an occurring window, sorted as strings. Contaminated: at least one hit word, and a
    twentieth of all words. Null and empty texts have no words. Items without words have no windows;
    an item without id still hits, but is not listed. Rows are never dropped, merged or compared with
    each other; an empty table on either side gives the plain counts. Documents are not shuffled.
    """
    spark = docs.sparkSession
    ws = Workspace(spark, "windows")
    made = ws.settle(windows(benchmark, size, item_column, item_text), "windows")
    path, pattern_rows = f"{ws.folder}/windows", made.count()
    least = made.agg(F.min("n")).first()[0] or size

    def bitmap(batches):
        bits = np.zeros(BITMAP_BITS, bool)
        for batch in batches:
            for held in batch.column("hashes").to_pylist():
                bits[(np.frombuffer(held, np.uint64) >> np.uint64(20)).astype(np.int64) & (BITMAP_BITS - 1)] = True
        # Sent in pieces, which are joined by piece: nothing larger than the bitmap reaches the driver.
        packed = np.packbits(bits).reshape(64, -1)
        yield pa.RecordBatch.from_pydict({"piece": pa.array(range(64), pa.int32()), "bits": [p.tobytes() for p in packed]})

    known = np.zeros(BITMAP_BITS // 8, np.uint8).reshape(64, -1)
    pieces = made.select("hashes").mapInArrow(bitmap, "piece int, bits binary").distinct()
    for row in pieces.toLocalIterator():
        known[row["piece"]] |= np.frombuffer(row["bits"], np.uint8)
    shared = spark.sparkContext.broadcast(known.tobytes())

    rows = pick(docs, id_column, text_column, *carry)
    types = dict(rows.dtypes)
    schema = ", ".join([*(f"`{c}` {types[c]}" for c in (id_column, text_column, *carry)), "n_words long, n_hit long",
                        "spans array<struct<start:int,end:int>>", "items array<string>"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = np.unpackbits(np.frombuffer(shared.value, np.uint8)).astype(bool)
        span = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))
        for batch in batches:
            for part in slices(batch, text_column):
                n_words, n_hit, spans, items = find(part.column(text_column).to_pylist(), known, least, path,
                                                    pattern_rows)
                yield pa.RecordBatch.from_arrays(
                    [*part.columns, pa.array(n_words, pa.int64()), pa.array(n_hit, pa.int64()), pa.array(spans, span),
                     pa.array(items, pa.list_(pa.string()))],
                    names=[*part.schema.names, "n_words", "n_hit", "spans", "items"])

    found = rows.mapInArrow(tidied(run), schema)
    return found.withColumn("contaminated", (F.col("n_hit") > 0) & (20 * F.col("n_hit") >= F.col("n_words")))


_SQL_WORDS = r"""regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"""

_SQL = f"""
WITH d AS (SELECT doc_id, {_SQL_WORDS} AS w FROM documents),
i AS (SELECT item_id, {_SQL_WORDS} AS w FROM benchmark),
j AS (SELECT item_id, w, least(13, len(w)) AS n FROM i WHERE len(w) > 0),
k AS (SELECT item_id, n, w, unnest(range(1, len(w) - n + 2)) AS p FROM j),
win AS (SELECT DISTINCT item_id, n, array_to_string(w[p:p + n - 1], ' ') AS t FROM k),
size AS (SELECT DISTINCT n FROM win),
place AS (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS p FROM d, size WHERE len(w) >= n),
own AS (SELECT doc_id, n, p, array_to_string(w[p:p + n - 1], ' ') AS t FROM place),
hit AS (SELECT own.doc_id, own.p, own.n, win.item_id FROM own JOIN win ON own.t = win.t AND own.n = win.n),
covered AS (SELECT doc_id, count(DISTINCT q) AS n_hit
            FROM (SELECT doc_id, unnest(range(p, p + n)) AS q FROM (SELECT DISTINCT doc_id, p, n FROM hit)) GROUP BY 1),
named AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
          FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM hit) GROUP BY 1)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(items, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN covered USING (doc_id) LEFT JOIN named USING (doc_id)
"""


@query("op1_decontaminate", _SQL)
def op1_decontaminate(spark, sf_dir):
    found = decontaminate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
                        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), "contaminated")
