"""Phrase collocation mining with broadcast double-array tries, one phrase length after the other.

Words are counted first; the frequent ones become numbered keys of double-array tries of bounded size. A task lets
all words of a shard walk them at once, byte by byte in numpy, and the texts are kept as numbers from then on. A
phrase can only be frequent if both its parts of one word less are: pairs of neighbouring numbers that stand often
enough in all texts together are the candidates. They become keys of further tries, spelled by the digits of their
two numbers; the pairs of the texts walk these, the accepting states that they reach are counted and number the
places for the next length. Each task sums what it sends, in packed ranges of hashes, so what is sent is at most
one entry a word. All counts are exact.
"""

from collections.abc import Iterator
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from wireglean.llm.common import Workspace, gathered, held, parquet_batches, pick, query, runs, slices, strings, table, tidied
from wireglean.llm.fm_index import joined

#: Bytes of candidates that make one trie (a longer candidate has one to itself).
TRIE_BYTES = 2 << 20
#: Tries of up to so many bytes are broadcast; more are read from storage by each shard, one at a time.
BROADCAST_BYTES = 64 << 20
#: Text of a shard.
SHARD_BYTES = 1 << 20
#: Numbers of a row of kept texts (what stands together is never cut), and those that a task looks at together.
ROW_NUMBERS = 1 << 10
SLICE_NUMBERS = 2 << 20
#: Entries of one range of hashes, and most bits of their number.
RANGE_ENTRIES = 2 << 20
MOST_RANGE_BITS = 16
#: Bits of the symbols that spell a number in a trie; bits of a number in a pair (the sign stays free).
SYMBOL_BITS = 5
NUMBER_BITS = 31

# Between words stand blanks; pieces end at marks and line ends; all else is in words.
_KIND = np.zeros(256, np.uint8)
_KIND[[0x20, 0x09]] = 1
_KIND[[*b".,;:!?", 0x0A, 0x0B, 0x0C, 0x0D]] = 2
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 32
_BLANK = 0x20


class Shard:
    """The words of some texts: lowered, each followed by one blank, with its piece and its group."""

    def __init__(self, texts: list[str | None], groups: list[str]):
        data, begin = joined(texts, b"\n")
        kind = _KIND[data]
        inside = kind == 0
        start, end = runs(inside)
        self.names, of_text = np.unique(np.array(groups, object), return_inverse=True)
        self.group = of_text[np.searchsorted(begin, start, "right") - 1]
        self.piece = np.cumsum(kind == 2, dtype=np.int32)[start]
        self.lengths = end - start
        keep = inside.copy()
        keep[end] = True
        self.bytes = np.where(inside, _LOWER[data], _BLANK)[keep]
        self.at = np.zeros(len(start) + 1, np.int64)
        np.cumsum(self.lengths + 1, out=self.at[1:])
        self.heads = _heads(self.bytes, self.at[:-1])

    @cached_property
    def alike(self) -> np.ndarray:
        """For each word the first one of its group that is equal to it."""
        if not len(self.piece):
            return np.empty(0, np.int64)
        code = np.asarray(self.words().dictionary_encode().indices).astype(np.int64)
        same = np.asarray(pa.array(self.group * (int(code.max()) + 1) + code).dictionary_encode().indices)
        first = np.empty(int(same.max()) + 1, np.int64)
        first[same[::-1]] = np.arange(len(same) - 1, -1, -1)
        return first[same]

    def places(self, size: int) -> np.ndarray:
        """The words with which ``size`` words of one piece begin."""
        n = len(self.piece) - size + 1
        return np.flatnonzero(self.piece[:n] == self.piece[size - 1:]) if n > 0 else np.empty(0, np.int64)

    def words(self) -> pa.StringArray:
        keep = np.ones(len(self.bytes), bool)
        keep[self.at[1:] - 1] = False
        return strings(self.bytes[keep], self.lengths)


class DoubleArray:
    """A trie over byte strings of which none begins another: ``check[base[s] + c] == s`` for a step from s by c.

    The last state of string number k has ``base`` -1 - k.
    """

    def __init__(self, base: np.ndarray, check: np.ndarray, ranges: dict[str, tuple[int, int]] | None = None):
        self.base, self.check, self.ranges = base, check, ranges

    @classmethod
    def build(cls, keys: pa.BinaryArray) -> "DoubleArray":
        """Of keys that stand together where they begin alike. Nodes with several children get windows of their own side by side; only children
        fill the holes in these, so no search for a place is needed."""
        edge = np.frombuffer(keys.buffers()[1], np.int32)[keys.offset:keys.offset + len(keys) + 1]
        flat, begin, length = np.frombuffer(keys.buffers()[2], np.uint8), edge[:-1], np.diff(edge)
        node, live, depth, total = np.zeros(len(keys), np.int32), np.arange(len(keys), dtype=np.int32), 0, 1
        parents, symbols = [np.array([-1], np.int32)], [np.array([0], np.int32)]
        while len(live):
            symbol, own = flat[begin[live] + depth].astype(np.int32), node[live]
            fresh = np.r_[True, (own[1:] != own[:-1]) | (symbol[1:] != symbol[:-1])]
            node[live] = total - 1 + np.cumsum(fresh, dtype=np.int32)
            parents.append(own[fresh])
            symbols.append(symbol[fresh])
            total += int(fresh.sum())
            depth += 1
            live = live[length[live] > depth]
        parent, symbol = np.concatenate(parents), np.concatenate(symbols)
        del parents, symbols, flat, live
        # Children of a node have neighbouring numbers.
        first = np.flatnonzero(parent != np.r_[np.int32(-2), parent[:-1]])[1:].astype(np.int32)
        owner, many = parent[first], np.r_[first[1:], np.int32(total)] - first > 1
        low = np.minimum.reduceat(symbol, first)
        span = np.where(many, np.maximum.reduceat(symbol, first) - low + 1, 0).astype(np.int32)
        base = np.zeros(total, np.int32)
        base[owner] = 256 + np.cumsum(span, dtype=np.int32) - span - low
        slot = np.zeros(total, np.int32)
        siblings = np.zeros(total, bool)
        siblings[owner[many]] = True
        in_window = np.flatnonzero(siblings[parent] & (parent >= 0))
        slot[in_window] = base[parent[in_window]] + symbol[in_window]
        only = np.flatnonzero(~siblings[parent] & (parent >= 0))
        taken = np.zeros(256 + int(span.sum()) + len(only), bool)
        taken[:256] = True
        taken[slot[in_window]] = True
        slot[only] = np.flatnonzero(~taken)[:len(only)]
        base[parent[only]] = slot[only] - symbol[only]
        base[node] = -1 - np.arange(len(keys))
        size = int(slot.max()) + 257
        out = cls(np.zeros(size, np.int32), np.full(size, -1, np.int32))
        out.base[slot] = base
        out.check[slot[1:]] = slot[parent[1:]]
        return out

    def root(self, name: str) -> int:
        """The state behind a group's name, or -1."""
        state = 0
        for c in _prefix(name):
            to = int(self.base[state]) + c
            if self.check[to] != state:
                return -1
            state = to
        return state

    def walk(self, shard: Shard, starts: "Starts") -> tuple[np.ndarray, np.ndarray]:
        """(word, key) of the keys that stand at these words: all walk at once, and drop out where no step is left.
        Equal words are walked once, for all places where a phrase begins with them."""
        words = starts.words if self.ranges is None else starts.between(self.ranges)
        if not len(words):
            return np.empty(0, np.int64), np.empty(0, np.int64)
        mark = np.zeros(len(shard.piece), bool)
        mark[shard.alike[words]] = True
        word = np.flatnonzero(mark)
        state = np.array([self.root(n) for n in shard.names], np.int32)[shard.group[word]]
        word, state = word[state >= 0], state[state >= 0]
        at, end = shard.at[word], shard.at[word + 1]
        behind = np.full(len(shard.piece), -1, np.int32)  # the state behind a first word and its blank
        while len(word):
            to = self.base[state] + shard.bytes[at]
            ok = np.flatnonzero(self.check[to] == state)
            word, state, at, end = word[ok], to[ok], at[ok] + 1, end[ok]
            done = at == end
            behind[word[done]] = state[done]
            word, state, at, end = word[~done], state[~done], at[~done], end[~done]
        state = behind[shard.alike[words]]
        words, state = words[state >= 0], state[state >= 0]
        from_ = self.base[state]
        found = [(words[from_ < 0], -1 - from_[from_ < 0])]
        more = (from_ >= 0) & (words + 1 < len(shard.piece))
        words, state, from_ = words[more], state[more], from_[more]
        at = shard.at[words + 1]
        while len(words):
            to = from_ + shard.bytes[at]
            ok = np.flatnonzero(self.check[to] == state)
            words, state, at = words[ok], to[ok], at[ok] + 1
            from_ = self.base[state]
            if len(from_) and from_.min() < 0:
                done = from_ < 0
                found.append((words[done], -1 - from_[done]))
                words, state, at, from_ = words[~done], state[~done], at[~done], from_[~done]
        return np.concatenate([w for w, _ in found]), np.concatenate([k for _, k in found]).astype(np.int64)

    def find(self, pairs: np.ndarray, shifts: np.ndarray) -> np.ndarray:
        """For each pair the number of the key spelled like it, or -1: all walk at once."""
        found = np.full(len(pairs), -1, np.int64)
        at, state = np.arange(len(pairs)), np.zeros(len(pairs), np.int32)
        for shift in shifts:
            to = self.base[state] + _symbols(pairs, shift)
            ok = np.flatnonzero(self.check[to] == state)
            at, pairs, state = at[ok], pairs[ok], to[ok]
        found[at] = -1 - self.base[state]
        return found


class Starts:
    """Words of a shard in the order of their groups and heads, so that a trie finds those between its first and
    last key without a look at the others: what many tries cost together is what their own words cost."""

    def __init__(self, shard: Shard, words: np.ndarray):
        heads, group = shard.heads[words], shard.group[words]
        order = np.argsort(heads)
        order = order[np.argsort(group[order], kind="stable")]
        self.place, self.words, self.heads = {n: i for i, n in enumerate(shard.names)}, words[order], heads[order]
        self.edge = np.searchsorted(group[order], np.arange(len(shard.names) + 1))

    def between(self, ranges: dict[str, tuple[int, int]]) -> np.ndarray:
        """The words whose heads lie between the two of their group."""
        found = [np.empty(0, np.int64)]
        for name, (low, high) in ranges.items():
            if name in self.place:
                a, b = self.edge[self.place[name]:self.place[name] + 2]
                heads = self.heads[a:b]
                found.append(self.words[a + np.searchsorted(heads, np.uint64(low)):a + np.searchsorted(heads, np.uint64(high), "right")])
        return np.concatenate(found)


def _heads(data: np.ndarray, at: np.ndarray) -> np.ndarray:
    """The eight bytes from each place on as a number that sorts like them; zeros behind the end."""
    padded = np.r_[data, np.zeros(8, np.uint8)]
    out = np.zeros(len(at), np.uint64)
    for i in range(8):
        out = (out << np.uint64(8)) | padded[at + i]
    return out


def _ranges(lang: pa.StringArray, phrase: pa.StringArray) -> list[dict]:
    """Of each group the least and the largest head of its keys; what stands behind a short key may be anything."""
    keys = pa.compute.binary_join_element_wise(phrase.cast(pa.binary()), b"", b" ")
    edge = np.frombuffer(keys.buffers()[1], np.int32)[keys.offset:keys.offset + len(keys) + 1].astype(np.int64)
    low = _heads(np.frombuffer(keys.buffers()[2], np.uint8), edge[:-1])
    free = np.uint64(8) * np.maximum(0, 8 - np.diff(edge)).astype(np.uint64)
    low = low >> free << free
    high = low | ((np.uint64(1) << free) - np.uint64(1))
    group = lang.dictionary_encode()
    place = np.asarray(group.indices)
    return [{"lang": g, "low": int(low[place == i].min()).to_bytes(8), "high": int(high[place == i].max()).to_bytes(8)}
            for i, g in enumerate(group.dictionary.to_pylist())]


def _prefix(name: str) -> bytes:
    return name.encode() + b"\xff"  # which no UTF-8 text holds


def _keys(lang: pa.StringArray, phrase: pa.StringArray) -> pa.BinaryArray:
    named = pa.compute.binary_join_element_wise(lang.cast(pa.binary()), phrase.cast(pa.binary()), b"\xff")
    return pa.compute.binary_join_element_wise(named, b"", b" ")


def _word_keys(batches):
    """(columns, keys, ranges) of the tries of a table (lang, phrase, f)."""
    for batch in gathered(batches, "phrase", TRIE_BYTES):
        lang, phrase, f = (batch.column(c) for c in ("lang", "phrase", "f"))
        yield pa.StructArray.from_arrays([lang, phrase, f], ["lang", "phrase", "f"]), _keys(lang, phrase), _ranges(lang, phrase)


def _symbols(pairs: np.ndarray, shift) -> np.ndarray:
    return (pairs >> shift & ((1 << SYMBOL_BITS) - 1)).astype(np.int32)


def _shifts(numbers: int) -> np.ndarray:
    """Where in a pair the symbols stand that spell two numbers below ``numbers``, highest first."""
    if numbers > 1 << NUMBER_BITS:
        raise ValueError(f"{numbers} frequent phrases of one length; {1 << NUMBER_BITS} can be told apart")
    own = np.arange(0, max(1, (numbers - 1).bit_length()), SYMBOL_BITS)[::-1]
    return np.r_[own + 32, own]


def _pair_keys(shifts: np.ndarray):
    """The same for a table (pair)."""
    most = max(1, TRIE_BYTES // 8)

    def gathered_pairs(batches):
        mine = np.empty(0, np.int64)
        for batch in batches:
            mine = np.r_[mine, np.asarray(batch.column("pair"))]
            while len(mine) >= most:
                yield mine[:most]
                mine = mine[most:]
        if len(mine):
            yield mine

    def cut(batches):
        for pairs in gathered_pairs(batches):
            flat = np.stack([_symbols(pairs, x) for x in shifts], 1).astype(np.uint8)
            yield (pa.StructArray.from_arrays([pa.array(pairs)], ["pair"]), strings(flat.ravel(), np.full(len(pairs), len(shifts))).cast(pa.binary()),
                   [{"lang": "", "low": int(pairs[0]).to_bytes(8), "high": int(pairs[-1]).to_bytes(8)}])

    return cut


_TRIE = ("block", "base", "check", "ranges")
_RANGES = pa.list_(pa.struct([("lang", pa.string()), ("low", pa.binary()), ("high", pa.binary())]))


class Tries:
    """The rows of a table as numbered keys of double-array tries, on storage or broadcast."""

    def __init__(self, phrases: DataFrame, keys, size, order: list[str], ws: Workspace, name: str):
        """``keys`` makes (columns, keys, ranges) of each trie from batches in ``order``; ``size`` are a row's bytes."""
        self.ws, self.path = ws, f"{ws.folder}/{name}"
        parts = (phrases.agg(F.sum(size)).first()[0] or 0) // TRIE_BYTES + 1

        def build(batches):
            part = TaskContext.get().partitionId()
            for n, (columns, spelled, ranges) in enumerate(keys(batches)):
                made = DoubleArray.build(spelled)
                yield pa.RecordBatch.from_pydict({
                    "block": pa.array([(part << 24) + n], pa.int64()),
                    "keys": pa.ListArray.from_arrays(pa.array([0, len(columns)], pa.int32()), columns),
                    "base": [made.base.tobytes()], "check": [made.check.tobytes()], "ranges": pa.array([ranges], _RANGES)})

        columns = ",".join(f"{f.name}:{f.dataType.simpleString()}" for f in phrases.schema)
        self.rows = ws.settle(phrases.repartitionByRange(parts, *order).sortWithinPartitions(*order).mapInArrow(
            tidied(build), f"block long, keys array<struct<{columns}>>, base binary, check binary, "
            "ranges array<struct<lang:string,low:binary,high:binary>>"), name)
        # One row a trie: where its numbers begin.
        sizes = self.rows.select("block", F.size("keys"), F.octet_length("base")).orderBy("block").collect()
        ends = np.cumsum([r[1] for r in sizes]).tolist()
        self.first = {r[0]: e - r[1] for r, e in zip(sizes, ends)}
        self.count = ends[-1] if ends else 0
        self.shared = None
        if 2 * sum(r[2] for r in sizes) <= BROADCAST_BYTES:
            self.shared = ws.spark.sparkContext.broadcast(
                [(*r[:3], [x.asDict() for x in r[3]]) for r in self.rows.select(*_TRIE).toLocalIterator()])

    def keys(self) -> DataFrame:
        """(number, ...) of all rows."""
        offsets = self.ws.spark.createDataFrame(list(self.first.items()), "block long, first long")
        rows = self.rows.select("block", F.posexplode("keys").alias("i", "k")).join(F.broadcast(offsets), "block")
        return rows.select((F.col("first") + F.col("i")).alias("number"), "k.*")

    def reader(self):
        """A function for tasks: (first number, trie) of all tries. It carries the broadcast or the place."""
        first, shared, path = self.first, self.shared, self.path

        def made(rows):
            return [(first[b], DoubleArray(np.frombuffer(base, np.int32), np.frombuffer(check, np.int32), {
                x["lang"]: (int.from_bytes(x["low"]), int.from_bytes(x["high"])) for x in ranges}))
                for b, base, check, ranges in rows]

        def tries() -> Iterator[tuple[int, DoubleArray]]:
            if shared is not None:
                yield from held(("tries", path), lambda: made(shared.value), 2)
                return
            for batch in parquet_batches(path, 1, _TRIE):
                yield from made(zip(*(batch.column(c).to_pylist() for c in _TRIE)))

        return tries

    def release(self) -> None:
        if self.shared is not None:
            self.shared.destroy()


def _shards(batches: Iterator[pa.RecordBatch]) -> Iterator[Shard]:
    for batch in batches:
        for part in slices(batch, "text", SHARD_BYTES):
            yield Shard(part.column("text").to_pylist(), part.column("lang").to_pylist())


def _count_words(batches):
    for shard in _shards(batches):
        words = shard.words()
        for g, name in enumerate(shard.names):
            counts = words.filter(pa.array(shard.group == g)).value_counts()
            if len(counts):
                yield pa.RecordBatch.from_pydict({"lang": pa.array([name] * len(counts), pa.string()),
                                                  "phrase": counts.field("values"), "f": counts.field("counts")})


def _numbers(shard: Shard, tries) -> np.ndarray:
    """For each word its number, or -1. Each is walked once for all that are equal to it."""
    number = np.full(len(shard.piece), -1, np.int64)
    if not len(number):
        return number
    starts = Starts(shard, np.flatnonzero(shard.alike == np.arange(len(number))))
    for first, trie in tries():
        words, key = trie.walk(shard, starts)
        number[words] = first + key
    return number[shard.alike]


def _sequences(number: np.ndarray, beside: np.ndarray) -> pa.ListArray:
    """Rows of numbers; ``beside`` are the places whose next place belongs to the same piece. Numbers with no other
    beside them begin no longer phrase and go; a -1 stands behind what stands together."""
    linked = np.zeros(len(number) + 1, bool)  # to the place before
    linked[beside + 1] = (number[beside] >= 0) & (number[beside + 1] >= 0)
    at = np.flatnonzero(linked[:-1] | linked[1:])
    last = ~linked[at + 1]
    ends = np.cumsum(last)
    flat = np.full(len(at) + (int(ends[-1]) if len(at) else 0), -1, np.int32)
    flat[np.arange(len(at)) + ends - last] = number[at]
    cut = np.flatnonzero(flat < 0) + 1
    cut = cut[np.diff(cut // ROW_NUMBERS, append=-1) != 0]
    return pa.ListArray.from_arrays(pa.array(np.r_[0, cut], pa.int32()), pa.array(flat))


def _slices(batches: Iterator[pa.RecordBatch]) -> Iterator[np.ndarray]:
    """The numbers of whole rows, many at a time."""
    for batch in batches:
        rows = batch.column("numbers")
        edge, flat = np.asarray(rows.offsets), np.asarray(rows.values)
        a = 0
        while a < len(rows):
            b = max(a + 1, int(np.searchsorted(edge, int(edge[a]) + SLICE_NUMBERS, "right")) - 1)
            yield flat[edge[a]:edge[b]]
            a = b


def _pairs(flat: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(place, pair): where a number has another one beside it, and both in one."""
    at = np.flatnonzero((flat[:-1] >= 0) & (flat[1:] >= 0)).astype(np.int32)
    return at, flat[at].astype(np.int64) << 32 | flat[at + 1]


_PACKED = "range int, entries binary, counts binary"


def _packed(entries: np.ndarray, counts: np.ndarray, bits: int) -> dict[str, pa.Array]:
    """Distinct entries and their counts as a row for each range of hashes."""
    mixed = entries.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    mixed = (mixed ^ mixed >> np.uint64(32)) * np.uint64(0xD6E8FEB86659FD93)
    place = (mixed >> np.uint64(64 - bits)).astype(np.uint16)
    order = np.argsort(place, kind="stable")
    place, entries, counts = place[order], entries[order], counts[order].astype(np.uint32)
    edge = np.flatnonzero(np.diff(place.astype(np.int32), prepend=-1, append=-1)) if len(place) else np.zeros(1, np.int64)

    def rows(values):
        at = np.asarray(edge * values.itemsize, np.int32)
        return pa.Array.from_buffers(pa.binary(), len(at) - 1, [None, pa.py_buffer(at), pa.py_buffer(values)])

    return {"range": pa.array(place[edge[:-1]], pa.int32()), "entries": rows(entries), "counts": rows(counts)}


def _summed(packed: DataFrame, least: int) -> DataFrame:
    """(entry, f) of the entries that count ``least`` over all tasks."""
    def total(held_):
        entries, counts = (np.concatenate(x) for x in zip(*held_))
        order = np.argsort(entries)
        entries = entries[order]
        first = np.flatnonzero(np.diff(entries, prepend=-1))
        f = np.add.reduceat(counts[order].astype(np.int64), first)
        return pa.RecordBatch.from_pydict({"entry": pa.array(entries[first[f >= least]]), "f": pa.array(f[f >= least])})

    def add(batches):
        now, mine = None, []
        for batch in batches:
            for range_, entries, counts in zip(batch.column("range").to_pylist(), batch.column("entries"), batch.column("counts")):
                if range_ != now and mine:
                    yield total(mine)
                    mine = []
                now = range_
                mine.append((np.frombuffer(entries.as_buffer(), np.int64), np.frombuffer(counts.as_buffer(), np.uint32)))
        if mine:
            yield total(mine)

    return packed.repartition(F.col("range")).sortWithinPartitions("range").mapInArrow(tidied(add), "entry long, f long")


def _numbered(rows: DataFrame, index: Tries) -> DataFrame:
    """(numbers): the texts as numbers of their frequent words."""
    tries = index.reader()

    def run(batches):
        for shard in _shards(batches):
            yield pa.RecordBatch.from_arrays([_sequences(_numbers(shard, tries), shard.places(2))], ["numbers"])

    return rows.mapInArrow(tidied(run), "numbers array<int>")


def _candidates(texts: DataFrame, least: int, bits: int) -> DataFrame:
    """(pair): the pairs of neighbouring numbers that stand ``least`` times in all texts."""
    def run(batches):
        for flat in _slices(batches):
            yield pa.RecordBatch.from_pydict(_packed(*np.unique(_pairs(flat)[1], return_counts=True), bits))

    return _summed(texts.mapInArrow(tidied(run), _PACKED), least).select(F.col("entry").alias("pair"))


def _walked(texts: DataFrame, index: Tries, shifts: np.ndarray, bits: int, onward: bool) -> DataFrame:
    """The accepting states that the pairs of the texts reach, counted and packed; with ``onward`` rows also hold the
    texts as numbers of these states."""
    tries = index.reader()

    def run(batches):
        for flat in _slices(batches):
            at, pairs = _pairs(flat)
            if onward:
                pairs, inverse, n = np.unique(pairs, return_inverse=True, return_counts=True)
                inverse = inverse.astype(np.int32)
            else:
                pairs, n = np.unique(pairs, return_counts=True)
            state = np.full(len(pairs), -1, np.int64)
            for first, trie in tries():
                a, b = np.searchsorted(pairs, trie.ranges[""][0]), np.searchsorted(pairs, trie.ranges[""][1], "right")
                found = trie.find(pairs[a:b], shifts)
                state[a:b] = np.where(found >= 0, first + found, state[a:b])
            known = state >= 0
            sent = _packed(state[known], n[known], bits)
            yield pa.RecordBatch.from_pydict({"numbers": pa.nulls(len(sent["range"]), pa.list_(pa.int32())), **sent})
            if onward:
                number = np.full(len(flat), -1, np.int32)
                number[at] = state[inverse]
                del at, pairs, inverse, n, state, known, sent
                kept = _sequences(number, np.arange(len(flat) - 1))
                yield pa.RecordBatch.from_pydict({"numbers": kept, "range": pa.nulls(len(kept), pa.int32()), **{
                    c: pa.nulls(len(kept), pa.binary()) for c in ("entries", "counts")}})

    return texts.mapInArrow(tidied(run), f"numbers array<int>, {_PACKED}")


def collocations(docs: DataFrame, least: int = 10, top: int = 2000, share: int = 50, lang_column: str = "lang",
                 text_column: str = "text") -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): the best phrases of two and three words of each language.

    Texts are cut at marks and line ends; phrases never cross these. Counts are exact and per language (a null
    language is ``und``; null and empty texts have no words). Rows are never merged: repeated rows count again.
    ``a``, ``l`` and ``r`` count the phrase and its two parts at its weakest cut, ``n`` all words. Ties of the score
    go to the more frequent phrase, then to the smaller one by bytes. A phrase that has at least ``share`` percent
    of its count inside one longer phrase is left out. An empty table, or one without frequent phrases, gives no rows.
    """
    spark = docs.sparkSession
    ws = Workspace(spark, "phrases")
    rows = pick(docs, lang_column, text_column)
    rows = rows.select(F.coalesce(F.col(lang_column).cast("string"), F.lit("und")).alias("lang"),
                       F.col(text_column).cast("string").alias("text"))
    # Counts of single words; the rare ones only go into the sums.
    all_words = rows.mapInArrow(tidied(_count_words), "lang string, phrase string, f long")
    all_words = ws.settle(all_words.groupBy("lang", "phrase").agg(F.sum("f").alias("f"))
                          .withColumn("frequent", F.col("f") >= least)
                          .withColumn("word", F.when(F.col("frequent"), F.col("phrase")))
                          .groupBy("lang", "word").agg(F.sum("f").alias("f")), "words")
    totals = all_words.groupBy("lang").agg(F.sum("f").alias("n"))
    n_words = all_words.agg(F.sum("f")).first()[0] or 0
    bits = min(MOST_RANGE_BITS, max(1, (n_words // RANGE_ENTRIES).bit_length()))
    words = all_words.where("word IS NOT NULL").select("lang", F.col("word").alias("phrase"), "f")
    index = Tries(words, _word_keys, F.octet_length("phrase") + F.octet_length("lang") + 2, ["lang", "phrase"], ws, "tries-1")
    one = ws.settle(index.keys().withColumn("last", F.col("phrase")), "phrases-1")
    texts = ws.settle(_numbered(rows, index), "texts-1")
    index.release()
    counted = {1: one}
    for size in (2, 3):
        shifts = _shifts(index.count)
        found = ws.settle(_candidates(texts, least, bits), f"candidates-{size}")
        index = Tries(found, _pair_keys(shifts), F.lit(8), ["pair"], ws, f"tries-{size}")
        walked = ws.settle(_walked(texts, index, shifts, bits, size < 3), f"texts-{size}")
        index.release()
        ws.drop(f"texts-{size - 1}", f"candidates-{size}")
        states = _summed(walked.where("range IS NOT NULL").select("range", "entries", "counts"), least)
        states = index.keys().join(states.withColumnRenamed("entry", "number"), "number").select(
            "number", F.expr("shiftright(pair, 32)").alias("left"), F.expr(f"pair & {(1 << 32) - 1}L").alias("right"), "f")
        counted[size] = ws.settle(_spelled(states, counted[size - 1], size), f"phrases-{size}")
        texts = walked.where("numbers IS NOT NULL").select("numbers")

    two, three = counted[2], counted[3]
    longest = (three.select(F.col("left").alias("number"), "f").unionByName(three.select(F.col("right").alias("number"), "f"))
               .groupBy("number").agg(F.max("f").alias("longer")))
    two = (two.join(longest, "number", "left")
           .where(F.col("longer").isNull() | (F.col("longer") * 100 < F.col("f") * share))
           .select("lang", "phrase", "f", F.array(F.struct(_cut("l", "r"), F.lit(1).alias("k"), "l", "r")).alias("cuts")))
    three = three.select("lang", "phrase", "f", F.array(
        F.struct(_cut("left_l", "r"), F.lit(1).alias("k"), F.col("left_l").alias("l"), F.col("r")),
        F.struct(_cut("l", "right_r"), F.lit(2).alias("k"), F.col("l"), F.col("right_r").alias("r"))).alias("cuts"))
    scored = two.unionByName(three).withColumn("cut", F.array_min("cuts")).select(
        "lang", "phrase", F.col("f").alias("a"), "cut.l", "cut.r", "cut.score")
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    best = scored.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    return best.join(totals, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n",
                                            "score")


def _spelled(states: DataFrame, parts: DataFrame, size: int) -> DataFrame:
    """(number, left, right, lang, phrase, last, f, l, r) of phrases given by the numbers of their parts; ``l`` and ``r``
    count these. Those of three words also get what their parts count at the other cut."""
    more = size > 2
    left = parts.select(F.col("number").alias("left"), "lang", F.col("phrase").alias("begin"), F.col("f").alias("l"),
                        *[F.col("l").alias("left_l")] * more)
    right = parts.select(F.col("number").alias("right"), "last", F.col("f").alias("r"), *[F.col("r").alias("right_r")] * more)
    return (states.join(left, "left").join(right, "right")
            .withColumn("phrase", F.concat_ws(" ", "begin", "last")).drop("begin"))


def _cut(left: str, right: str):
    """The score of one cut, exactly: products of counts up to 10**15 fit into 38 digits."""
    return F.expr(f"(CAST(1000000 AS decimal(7,0)) * CAST(f AS decimal(15,0)) * CAST(f AS decimal(15,0))) "
                  f"div (CAST({left} AS decimal(15,0)) * CAST({right} AS decimal(15,0)))").alias("score")


_SQL = r"""
WITH t AS (SELECT doc_id, coalesce(lang, 'und') AS lang, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz') AS text FROM documents),
pieces AS (SELECT lang, unnest(regexp_split_to_array(text, '[.,;:!?\x0A-\x0D]')) AS piece FROM t),
w AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces),
size AS (SELECT unnest([1, 2, 3]) AS k),
p AS (SELECT lang, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM w, size WHERE len(w) >= k),
f AS (SELECT lang, k, w[i:i + k - 1] AS words, count(*) AS a FROM p GROUP BY ALL),
total AS (SELECT lang, sum(a)::BIGINT AS n FROM f WHERE k = 1 GROUP BY 1),
cand AS (SELECT * FROM f WHERE k > 1 AND a >= 10),
cut AS (SELECT c.lang, c.words, c.a, j, l.a AS l, r.a AS r,
               (1000000::HUGEINT * c.a * c.a) // (l.a::HUGEINT * r.a) AS score
        FROM (SELECT lang, words, a, k AS size, unnest(range(1, k)) AS j FROM cand) c
        JOIN f l ON l.lang = c.lang AND l.words = c.words[1:j] JOIN f r ON r.lang = c.lang AND r.words = c.words[j + 1:size]),
best AS (SELECT * FROM cut QUALIFY row_number() OVER (PARTITION BY lang, words ORDER BY score, j) = 1),
inner_ AS (SELECT lang, words[1:2] AS words, a FROM cand WHERE k = 3 UNION ALL SELECT lang, words[2:3], a FROM cand WHERE k = 3),
longer AS (SELECT lang, words, max(a) AS longest FROM inner_ GROUP BY ALL),
kept AS (SELECT b.*, array_to_string(b.words, ' ') AS phrase FROM best b LEFT JOIN longer USING (lang, words)
         WHERE longest IS NULL OR 100 * longest < 50 * a),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, encode(phrase)) AS rank FROM kept)
SELECT lang, rank, phrase, a, l, r, n, score::BIGINT AS score FROM ranked JOIN total USING (lang) WHERE rank <= 2000
"""


@query("op11_collocations", _SQL)
def op11_collocations(spark, sf_dir):
    return collocations(table(spark, sf_dir, "documents"))
