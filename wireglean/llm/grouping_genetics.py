"""Best-fit packing of documents into sequences by a grouping genetic algorithm on islands.

Documents become token ids and, where they are too long, pieces. Pieces that fill a sequence are done. The others
are dealt into groups of some thousand pieces. Each group is packed by several islands, tasks of their own: an
individual is a packing; a crossover injects whole well-filled bins of one parent into the other, takes out the
bins that hold the same pieces again, and puts the displaced pieces back by best fit. Between epochs the best
packing of an island moves to its neighbour. Groups that reach their lower bound are done. Then the least filled
bins of all groups are opened, their pieces are dealt anew, and packed again, until they make one group: what the
groups could not fill singly they fill together. No task holds more than one group.
"""

import json
import re
import zlib
from bisect import bisect_left, insort

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from wireglean.llm.common import Workspace, held, pick, query, slices, strings, table, tidied

CAPACITY = 4096
END_ID = 1
#: Pieces of one group, or more where they would fill fewer sequences than this (so at most 64 * 4096 pieces).
GROUP_PIECES, GROUP_BINS = 4096, 64
#: Islands of a group, packings of an island, generations of an epoch, epochs.
ISLANDS, POPULATION, GENERATIONS, EPOCHS = 3, 6, 8, 3
#: Of a group's bins, the least filled part that is opened again.
OPENED = 8
#: Words that a worker remembers.
KNOWN_WORDS = 400_000


def tokenizer_file() -> str:
    """The public tokenizer's file, wherever its package lies on this machine."""
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


class WordCoder:
    """Ids of whole texts, exactly as the tokenizers library gives them, with each distinct word encoded once.

    The vocabulary's pattern cuts normalised text into runs of letters, single digits, runs of other signs and a few
    contractions, and words are encoded one by one; so texts can be cut in numpy and words remembered. What kind a
    character is, and how it is normalised, is asked of the library. Texts with special tokens go to it whole.
    """

    # Characters before these neither compose nor decompose, and are lowered one by one.
    _COMPOSING = re.compile("[\u0300-\U0010ffff]")
    _ENDINGS = ("s", "t", "re", "ve", "m", "ll", "d")
    _SPACE, _LETTER, _DIGIT, _SIGN = range(4)

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        self.whole = Tokenizer.from_str(json.dumps(spec))
        self.bare = Tokenizer.from_str(json.dumps(spec | {"normalizer": None}))
        self.special = [t["content"] for t in spec["added_tokens"]]
        self.kind = np.full(0x110000, -1, np.int8)
        # The last token of a word carries the vocabulary's mark for word ends, the others do not.
        mark = spec["model"]["end_of_word_suffix"]
        vocabulary = self.whole.get_vocab()
        self.ends_word = np.zeros(max(vocabulary.values()) + 1, bool)
        self.ends_word[[i for token, i in vocabulary.items() if token.endswith(mark)]] = True
        self._forget()

    def _forget(self):
        self.known = pa.array([], pa.string())
        self.begin, self.length, self.flat = np.empty(0, np.int32), np.empty(0, np.int32), np.empty(0, np.uint32)

    def _kind_of(self, char: str) -> int:
        def cuts(text):
            return [span for _, span in self.whole.pre_tokenizer.pre_tokenize_str(text)]

        if cuts(char + "a") == [(0, 2)]:
            return self._LETTER
        if not cuts(char):
            return self._SPACE
        return self._SIGN if cuts(char + "#") == [(0, 2)] else self._DIGIT

    def _words(self, text: str) -> tuple[pa.StringArray, np.ndarray]:
        """(word, its first character) of normalised text."""
        code = (np.frombuffer(text.encode(), np.uint8) if text.isascii()
                else np.frombuffer(text.encode("utf-32-le"), np.uint32))
        for c in np.unique(code[self.kind[code] < 0]).tolist():
            self.kind[c] = self._kind_of(chr(c))
        kind = self.kind[code]
        start = (kind != self._SPACE) & (np.r_[True, kind[1:] != kind[:-1]] | (kind == self._DIGIT))
        # A sign run that begins with an apostrophe before such an ending is one word with it.
        padded = np.r_[code, np.zeros(2, code.dtype)]
        for at in np.flatnonzero(start & (code == 0x27)).tolist():
            for ending in self._ENDINGS:
                if all(padded[at + 1 + i] == ord(c) for i, c in enumerate(ending)):
                    start[at + 1] = False
                    after = at + 1 + len(ending)
                    if after < len(code) and kind[after] != self._SPACE:
                        start[after] = True
                    break
        first = np.flatnonzero(start)
        width = np.ones(len(code), np.int8) if text.isascii() else (
            1 + (code >= 0x80) + (code >= 0x800) + (code >= 0x10000)).astype(np.int8)
        in_word = kind != self._SPACE
        bytes_ = np.frombuffer(text.encode(), np.uint8)[np.repeat(in_word, width)]
        before = np.zeros(len(code) + 1, np.int64)
        np.cumsum(np.where(in_word, width, 0), out=before[1:])
        return strings(bytes_, np.diff(np.r_[before[first], before[-1]])), first

    def _encoded(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all words, how many each has); words of one text are told apart by their last tokens."""
        parts, lengths = [], []
        for a in range(0, len(words), 512):
            some = words[a:a + 512]
            ids = np.array(self.bare.encode_batch_fast([" ".join(some)], add_special_tokens=False)[0].ids, np.uint32)
            stop = np.flatnonzero(self.ends_word[ids])
            if len(stop) != len(some):  # the words one by one
                own = [e.ids for e in self.bare.encode_batch_fast(some, add_special_tokens=False)]
                ids, length = np.array([i for one in own for i in one], np.uint32), np.array([len(o) for o in own])
            else:
                length = np.diff(stop, prepend=-1)
            parts.append(ids)
            lengths.append(length)
        return np.concatenate(parts), np.concatenate(lengths).astype(np.int32)

    def _numbers(self, words: pa.StringArray) -> np.ndarray:
        if len(self.known) + len(words) > KNOWN_WORDS:
            self._forget()
        number = pa.compute.index_in(words, value_set=self.known)
        new = np.asarray(number.is_null())
        out = np.asarray(number.fill_null(0)).copy()
        if new.any():
            fresh = words.filter(pa.array(new))
            ids, length = self._encoded(fresh.to_pylist())
            out[new] = len(self.known) + np.arange(len(fresh))
            self.begin = np.r_[self.begin, (len(self.flat) + np.cumsum(length) - length).astype(np.int32)]
            self.length = np.r_[self.length, length]
            self.flat = np.r_[self.flat, ids]
            self.known = pa.concat_arrays([self.known, fresh])
        return out

    def encode(self, texts: list[str | None]) -> list[np.ndarray]:
        """The ids of each text (null: none)."""
        plain, by_library = [], {}
        for i, t in enumerate(texts):
            t = t or ""
            if any(s in t for s in self.special):
                by_library[i] = np.array(self.whole.encode(t, add_special_tokens=False).ids, np.uint32)
                t = ""
            plain.append(self.whole.normalizer.normalize_str(t) if self._COMPOSING.search(t) else t.lower())
        ends = np.cumsum([len(t) + 1 for t in plain])
        words, first = self._words("\n".join([*plain, ""]))
        coded = words.dictionary_encode()
        number = self._numbers(coded.dictionary)[np.asarray(coded.indices)]
        length = self.length[number]
        stop = np.cumsum(length, dtype=np.int32)
        ids = self.flat[np.repeat(self.begin[number] - stop + length, length)
                        + np.arange(int(stop[-1]) if len(stop) else 0, dtype=np.int32)]
        # Words of a text begin before the text's end.
        upto = np.r_[0, stop][np.searchsorted(first, ends)]
        out = np.split(ids, upto[:-1])
        return [by_library.get(i, own) for i, own in enumerate(out)]


def pieces(docs: DataFrame, capacity: int, end_id: int, id_column: str, text_column: str, keep_ids: bool) -> DataFrame:
    """(row, id, piece, start, length, ids_crc32[, ids]): the pieces of each document, with a number for each row."""
    rows = pick(docs, id_column, text_column).toDF("id", "text").withColumn("text", F.col("text").cast("string"))
    kind, arrow = dict(rows.dtypes)["id"], to_arrow_type(rows.schema["id"].dataType)
    schema = f"row long, id {kind}, piece int, start long, length long, ids_crc32 long" + ", ids array<int>" * keep_ids

    def run(batches):
        path = tokenizer_file()
        coder = held(("words", path), lambda: WordCoder(path), 1)
        number = TaskContext.get().partitionId() << 36
        for batch in batches:
            for part in slices(batch, "text"):
                made, ids = [], []
                for name, own in zip(part.column("id").to_pylist(), coder.encode(part.column("text").to_pylist())):
                    own = np.r_[own, np.uint32(end_id)].astype("<u4")
                    for piece, a in enumerate(range(0, len(own), capacity)):
                        cut = own[a:a + capacity]
                        made.append((number, name, piece, a, len(cut), zlib.crc32(cut.tobytes())))
                        number += 1
                        if keep_ids:
                            ids.append(cut.astype(np.int32))
                types = [pa.int64(), arrow, pa.int32(), pa.int64(), pa.int64(), pa.int64()]
                arrays = [pa.array(list(c), t) for c, t in zip(zip(*made), types)]
                yield pa.RecordBatch.from_arrays([*arrays, *[pa.array(ids, pa.list_(pa.int32()))] * keep_ids], names=[
                    "row", "id", "piece", "start", "length", "ids_crc32", *["ids"] * keep_ids])

    return rows.mapInArrow(tidied(run), schema)


def least_bins(lengths: np.ndarray, capacity: int) -> int:
    """A lower bound: by the sum, and for each size of small pieces by what large ones leave free (lengths fall)."""
    rising, sums = lengths[::-1], np.r_[0, np.cumsum(lengths[::-1])]
    bound = -(-int(sums[-1]) // capacity)
    small = np.unique(rising[rising <= capacity // 2])
    half = np.searchsorted(rising, capacity // 2, "right")
    low = np.searchsorted(rising, small, "left")
    big = np.searchsorted(rising, capacity - small, "right")  # pieces from here on stand alone
    middle = big - half
    rest = (sums[half] - sums[low]) - (middle * capacity - (sums[big] - sums[half]))
    own = len(rising) - half + np.maximum(0, -(-rest // capacity))
    return max(bound, len(rising) - half, int(own.max()) if len(own) else 0)


def best_fit(lengths: np.ndarray, order: np.ndarray, bins: np.ndarray, free: list[int], capacity: int) -> None:
    """Put pieces, in this order, each into the bin that it leaves the least room in; ``bins`` and ``free`` are updated."""
    room = sorted((f << 32) + b for b, f in enumerate(free) if f)
    for i in order.tolist():
        size = int(lengths[i])
        at = bisect_left(room, size << 32)
        if at < len(room):
            entry = room.pop(at)
            b, left = entry & 0xFFFFFFFF, (entry >> 32) - size
        else:
            b, left = len(free), capacity - size
            free.append(left)
        free[b] = left
        bins[i] = b
        if left:
            insort(room, (left << 32) + b)


class Island:
    """Packings of one group's pieces (lengths fall): arrays with a bin for each piece."""

    def __init__(self, lengths: np.ndarray, capacity: int, seed: tuple[int, ...]):
        self.lengths, self.capacity, self.random = lengths, capacity, np.random.default_rng(seed)
        self.bound = least_bins(lengths, capacity)

    def quality(self, bins: np.ndarray) -> tuple[int, float]:
        """(bins, minus the mean square of how full they are): smaller is better."""
        fill = np.bincount(bins, weights=self.lengths)
        return len(fill), -float(np.mean((fill / self.capacity) ** 2))

    def fresh(self, spread: float) -> np.ndarray:
        """Best fit in falling order, which ``spread`` shakes."""
        shaken = self.lengths * (1 + spread * self.random.standard_normal(len(self.lengths)))
        bins = np.zeros(len(self.lengths), np.int32)
        best_fit(self.lengths, np.argsort(-shaken, kind="stable"), bins, [], self.capacity)
        return bins

    def cross(self, mine: np.ndarray, other: np.ndarray) -> np.ndarray:
        """``mine`` with some well-filled whole bins of ``other``."""
        fill = np.bincount(other, weights=self.lengths)
        full = np.argsort(-fill, kind="stable")[:max(1, len(fill) // 2)]
        injected = self.random.choice(full, max(1, len(full) // 4), replace=False)
        comes = np.isin(other, injected)
        out = np.zeros(int(mine.max()) + 1, bool)
        out[mine[comes]] = True  # these bins hold pieces that come again
        out[np.argsort(np.bincount(mine, weights=self.lengths), kind="stable")[:2]] = True  # and the emptiest are tried anew
        stays = ~out[mine] & ~comes
        child = np.zeros(len(mine), np.int32)
        kept, child[stays] = np.unique(mine[stays], return_inverse=True)
        child[comes] = len(kept) + np.unique(other[comes], return_inverse=True)[1]
        set_ = stays | comes
        free = (self.capacity - np.bincount(child[set_], weights=self.lengths[set_])).astype(np.int64).tolist() if set_.any() else []
        best_fit(self.lengths, np.flatnonzero(~set_), child, free, self.capacity)
        return child

    def evolve(self, packings: list[np.ndarray], size: int, generations: int) -> list[np.ndarray]:
        packings = packings or [self.fresh(0)]
        ranked = sorted(((self.quality(p), i) for i, p in enumerate(packings)), key=lambda x: x[0])
        if ranked[0][0][0] <= self.bound:
            return [packings[ranked[0][1]]]
        pool = [(q, packings[i]) for q, i in ranked]
        while len(pool) < size:
            made = self.fresh(0.05 * len(pool))
            pool.append((self.quality(made), made))
        for _ in range(generations):
            pool.sort(key=lambda x: x[0])
            if pool[0][0][0] <= self.bound:
                break
            for _ in range(size):
                a, b = (min(self.random.integers(len(pool), size=2)) for _ in range(2))
                child = self.cross(pool[a][1], pool[b][1])
                pool.append((self.quality(child), child))
            pool = sorted(pool, key=lambda x: x[0])[:size]
        return [p for _, p in sorted(pool, key=lambda x: x[0])]


def _level(pool: DataFrame, level: int, capacity: int, ws: Workspace) -> tuple[DataFrame, bool]:
    """(row, length, sequence, offset, opened) of all pieces of a pool, and whether they were one group."""
    n, total = pool.agg(F.count("*"), F.sum("length")).first()
    groups = max(1, min(n // GROUP_PIECES, total // (GROUP_BINS * capacity)))
    one = F.struct((-F.col("length")).alias("n"), "row")
    dealt = (pool.withColumn("part", F.pmod(F.xxhash64("row", F.lit(level)), F.lit(groups)))
             .groupBy("part").agg(F.array_sort(F.collect_list(one)).alias("m"))
             .select("part", F.expr("transform(m, x -> x.row)").alias("rows"),
                     F.expr("transform(m, x -> cast(-x.n as int))").alias("lengths")))
    members = ws.settle(dealt, f"members-{level}")
    state = (members.select("part", "lengths", F.explode(F.sequence(F.lit(0), F.lit(ISLANDS - 1))).alias("island"))
             .withColumn("packings", F.array().cast("array<binary>")))
    finished: list[DataFrame] = []
    for epoch in range(EPOCHS):

        def evolve(batches, epoch=epoch):
            for batch in batches:
                for part, island, lengths, packings in zip(*(batch.column(c).to_pylist() for c in (
                        "part", "island", "lengths", "packings"))):
                    own = Island(np.array(lengths, np.int64), capacity, (level, epoch, part, island))
                    made = own.evolve([np.frombuffer(p, np.int32) for p in packings], POPULATION, GENERATIONS)
                    yield pa.RecordBatch.from_pydict({
                        "part": [part], "island": pa.array([island], pa.int32()), "lengths": pa.array([lengths], pa.list_(pa.int32())),
                        "packings": pa.array([[p.tobytes() for p in made]], pa.list_(pa.binary())),
                        "n": pa.array([own.quality(made[0])[0]], pa.int32()), "bound": pa.array([own.bound], pa.int32())})

        state = ws.settle(state.repartition("part", "island").mapInArrow(
            tidied(evolve), "part long, island int, lengths array<int>, packings array<binary>, n int, bound int"),
            f"islands-{level}-{epoch}")
        least = state.groupBy("part").agg(F.min("n").alias("least"))
        state = state.join(least, "part").withColumn("done", (F.col("least") <= F.col("bound")) | F.lit(epoch == EPOCHS - 1))
        # Of each group the best packing so far, when it can't get better or time is over.
        finished.append(state.where("done").groupBy("part").agg(
            F.min_by(F.col("packings")[0], F.struct("n", "island")).alias("bins"), F.min("n").alias("n")))
        state = state.where("NOT done")
        if epoch == EPOCHS - 1 or state.isEmpty():
            break
        elite = state.select("part", F.pmod(F.col("island") + 1, F.lit(ISLANDS)).alias("island"),
                             F.slice("packings", 1, 1).alias("elite"))
        state = state.join(elite, ["part", "island"]).select(
            "part", "island", "lengths", F.concat("elite", "packings").alias("packings"))
    best = finished[0]
    for more in finished[1:]:
        best = best.unionByName(more)

    def place(batches):
        for batch in batches:
            for part, rows, lengths, bins in zip(*(batch.column(c).to_pylist() for c in ("part", "rows", "lengths", "bins"))):
                bins, lengths = np.frombuffer(bins, np.int32), np.array(lengths, np.int64)
                fill = np.bincount(bins, weights=lengths).astype(np.int64)
                opened = np.zeros(len(fill), bool)
                opened[np.argsort(fill, kind="stable")[:len(fill) // OPENED + 1]] = True
                order = np.argsort(bins, kind="stable")
                before = np.cumsum(lengths[order]) - lengths[order]
                offset = np.empty(len(bins), np.int64)
                offset[order] = before - before[np.searchsorted(bins[order], np.arange(len(fill)))][bins[order]]
                yield pa.RecordBatch.from_pydict({
                    "row": pa.array(rows, pa.int64()), "length": lengths, "offset": offset, "opened": opened[bins],
                    "sequence": (level << 56 | part << 20) + bins.astype(np.int64)})

    placed = members.join(best, "part").select("part", "rows", "lengths", "bins").mapInArrow(
        tidied(place), "row long, length long, offset long, opened boolean, sequence long")
    return ws.settle(placed, f"placed-{level}"), groups == 1


def pack(docs: DataFrame, capacity: int = CAPACITY, end_id: int = END_ID, id_column: str = "doc_id",
         text_column: str = "text", keep_ids: bool = False) -> DataFrame:
    """(id, piece, start, length, ids_crc32, sequence_id, offset[, ids]): where each piece of each document stands.

    Null and empty texts are the end id alone. Every row is packed, repeated rows and null ids too. Documents are cut
    only where they are longer than ``capacity``. A sequence's pieces stand gapless from 0; its number says nothing.
    The packing may differ between runs, the number of sequences hardly; an empty table gives no rows. ``keep_ids``
    adds the token ids, from which :func:`sequences` makes the training rows.
    """
    ws = Workspace(docs.sparkSession, "packing")
    items = ws.settle(pieces(docs, capacity, end_id, id_column, text_column, keep_ids), "pieces")
    full = items.where(F.col("length") == capacity).select(
        "row", (F.col("row") * 2 + 1).alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
    places = [full]
    pool, level, before = items.where(F.col("length") < capacity).select("row", "length"), 0, None
    while not pool.isEmpty():
        placed, last = _level(pool, level, capacity, ws)
        now = placed.select("sequence").distinct().count()
        if before is not None and now > before[1]:  # the new packing is no better: the old one stays
            places.append(_numbered(before[0]))
            break
        opened = placed.where("opened")
        if last:
            places.append(_numbered(placed))
            break
        places.append(_numbered(placed.where("NOT opened")))
        before = opened, opened.select("sequence").distinct().count()
        pool, level = opened.select("row", "length"), level + 1
    found = places[0]
    for more in places[1:]:
        found = found.unionByName(more)
    return items.join(found, "row").select(F.col("id").alias(id_column), "piece", "start", "length", "ids_crc32",
                                           "sequence_id", "offset", *["ids"] * keep_ids)


def _numbered(placed: DataFrame) -> DataFrame:
    return placed.select("row", (F.col("sequence") * 2).alias("sequence_id"), "offset")


def sequences(packed: DataFrame) -> DataFrame:
    """(sequence_id, ids, starts): the training rows of a packing made with ``keep_ids``, and where documents begin."""
    parts = packed.groupBy("sequence_id").agg(F.array_sort(F.collect_list(F.struct("offset", "ids"))).alias("parts"))
    return parts.select("sequence_id", F.flatten("parts.ids").alias("ids"), F.col("parts.offset").alias("starts"))


@query("op13_packing")
def op13_packing(spark, sf_dir):
    return pack(table(spark, sf_dir, "documents"))
