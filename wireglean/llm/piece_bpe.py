"""SentencePiece encoding and decoding of merge-type vocabularies.

The encoder keeps an agenda of adjacent symbol pairs ordered by the score of the piece they
make, and merges the best (leftmost among equals) until none is left. A text is cut before
every space mark that follows another symbol, and around line ends: no piece of the vocabulary
crosses such a place (proved on loading), so the parts can be encoded one by one and remembered.
Short parts of a batch are merged together in numpy, one agenda step of all parts at a time;
long parts use a heap. Every part that was not remembered is compared with the library.
"""

import gc
import heapq
import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wireglean.llm.common import held, pick, query, slices, table, tidied, tokenizer_path

SPACE = "▁"
#: Parts of more symbols go through the heap.
SHORT_PART = 48
#: Remembered parts of a task; the memory is emptied beyond.
MEMORY_PARTS = 200_000
#: Bytes of text encoded at once; a part takes some twenty times its bytes while it is merged.
TEXT_BYTES = 1 << 18
#: Characters below this code (and the space mark, which takes the place of code 0) have cuts of their own.
CUT_CODES = 1024
_NEVER = np.int32(2**31 - 1)


class PieceModel:
    """A BPE model file and its agenda."""

    def __init__(self, path: str):
        import sentencepiece
        from sentencepiece import sentencepiece_model_pb2 as format_

        self.library = sentencepiece.SentencePieceProcessor(model_file=path)
        proto = format_.ModelProto()
        with open(path, "rb") as file:
            proto.ParseFromString(file.read())
        spec, norm = proto.trainer_spec, proto.normalizer_spec
        if (spec.model_type != 2 or not spec.byte_fallback or norm.name != "identity" or not norm.add_dummy_prefix
                or norm.remove_extra_whitespaces or not norm.escape_whitespaces):
            raise ValueError("only merge-type models with byte fallback and no normalisation are handled")
        self.pieces = [p.piece for p in proto.pieces]
        normal = {p.piece: i for i, p in enumerate(proto.pieces) if p.type == 1}
        if any(p.type in (4, 5) for p in proto.pieces):
            raise ValueError("models with user-defined or unused pieces are not handled")
        self.together = np.zeros((CUT_CODES + 1, CUT_CODES + 1), bool)
        self.together[CUT_CODES, :] = self.together[:, CUT_CODES] = True  # rarer characters are never cut
        kind = lambda c: 0 if c == SPACE else min(ord(c), CUT_CODES)
        for p in normal:
            for a, b in itertools.pairwise(p):
                self.together[kind(a), kind(b)] = True
        self.bytes = [next(i for i, p in enumerate(proto.pieces) if p.type == 6 and p.piece == f"<0x{b:02X}>")
                      for b in range(256)]
        scores = sorted({proto.pieces[i].score for i in normal.values()}, reverse=True)
        rank = {s: r for r, s in enumerate(scores)}
        self.symbol = {p: i for p, i in normal.items() if len(p) == 1}
        self.pairs: dict[tuple[int, int], tuple[int, int]] = {}
        for p, i in normal.items():
            for cut in range(1, len(p)):
                left, right = normal.get(p[:cut]), normal.get(p[cut:])
                if left is not None and right is not None:
                    self.pairs[left, right] = (rank[proto.pieces[i].score], i)
        self.of_code = np.full(0x110000, -1, np.int32)
        for p, i in self.symbol.items():
            self.of_code[ord(p)] = i
        self._table()
        self.memory: dict[str, tuple[int, ...]] = {}

    def _table(self) -> None:
        """The pairs in an open hash table, for looking up many at once."""
        self.mask = (1 << 20) - 1
        keys = np.full(self.mask + 1, -1, np.int64)
        ranks, merged = np.full(self.mask + 1, _NEVER, np.int32), np.full(self.mask + 1, -1, np.int32)
        self.probes = 1
        for (a, b), (r, i) in self.pairs.items():
            key = (a << 20) | b
            at = int(self._slot(np.array([key], np.int64))[0])
            tries = 1
            while keys[at] != -1:
                at, tries = (at + 1) & self.mask, tries + 1
            keys[at], ranks[at], merged[at] = key, r, i
            self.probes = max(self.probes, tries)
        self.keys, self.ranks, self.merged = keys, ranks, merged

    def _slot(self, key: np.ndarray) -> np.ndarray:
        return ((key.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(44)).astype(np.int64) & self.mask

    def _look(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The table slot of each pair, or -1."""
        key = (left.astype(np.int64) << 20) | right
        key[(left < 0) | (right < 0)] = -2
        at = self._slot(key)
        found = np.full(len(key), -1, np.int64)
        open_ = np.arange(len(key))
        for _ in range(self.probes):
            held = self.keys[at[open_]]
            hit = held == key[open_]
            found[open_[hit]] = at[open_[hit]]
            open_ = open_[~hit & (held != -1)]
            if not len(open_):
                break
            at[open_] = (at[open_] + 1) & self.mask
        return found

    def _rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        at = self._look(left, right)
        return np.where(at >= 0, self.ranks[at], _NEVER)

    def merge_many(self, parts: list[str]) -> list[list[int]]:
        """Symbols of many short parts after all merges: one agenda step of every part at a time."""
        lengths = np.fromiter(map(len, parts), np.int64, len(parts))
        codes = np.frombuffer("".join(parts).encode("utf-32-le", "surrogatepass"), np.uint32)
        symbols = self.of_code[codes]
        unknown = symbols < 0
        symbols = np.where(unknown, -2 - codes.astype(np.int64), symbols.astype(np.int64))  # keeps the character
        part = np.repeat(np.arange(len(parts)), lengths)
        rank = np.full(len(symbols), _NEVER, np.int32)
        inner = np.flatnonzero(part[1:] == part[:-1])
        rank[inner] = self._rank(symbols[inner], symbols[inner + 1])
        done: list[tuple[np.ndarray, np.ndarray]] = []
        while len(symbols):
            starts = np.flatnonzero(np.r_[True, part[1:] != part[:-1]])
            best = np.minimum.reduceat(rank, starts)
            sizes = np.diff(np.r_[starts, len(symbols)])
            ready = np.repeat(best == _NEVER, sizes)
            if ready.any():
                done.append((part[ready], symbols[ready]))
                symbols, part, rank = symbols[~ready], part[~ready], rank[~ready]
                if not len(symbols):
                    break
                best, sizes = best[best != _NEVER], sizes[best != _NEVER]
            top = np.flatnonzero(rank == np.repeat(best, sizes))
            at = top[np.r_[True, part[top][1:] != part[top][:-1]]]  # the leftmost of each part
            symbols[at] = self.merged[self._look(symbols[at], symbols[at + 1])]
            keep = np.ones(len(symbols), bool)
            keep[at + 1] = False
            now = at - np.arange(len(at))  # places after the removal
            symbols, part, rank = symbols[keep], part[keep], rank[keep]
            for left in (now, now - 1):
                left = left[left >= 0]
                right = left + 1
                inside = right < len(symbols)
                inside[inside] = part[left[inside]] == part[right[inside]]
                rank[left[~inside]] = _NEVER
                left = left[inside]
                rank[left] = self._rank(symbols[left], symbols[left + 1])
        part = np.concatenate([p for p, _ in done]) if done else np.empty(0, np.int64)
        symbols = np.concatenate([s for _, s in done]) if done else np.empty(0, np.int64)
        order = np.argsort(part, kind="stable")
        ends = np.cumsum(np.bincount(part, minlength=len(parts)))
        flat = symbols[order].tolist()
        return [flat[a:b] for a, b in zip([0, *ends[:-1].tolist()], ends.tolist())]

    def merge_long(self, part: str) -> list[int]:
        """Symbols of one part of any length after all merges, by a heap of pairs."""
        symbols = [self.symbol.get(c, -2 - ord(c)) for c in part]
        after, before = list(range(1, len(symbols) + 1)), list(range(-1, len(symbols) - 1))
        agenda: list[tuple[int, int, int, int]] = []

        def offer(left: int) -> None:
            right = after[left] if left >= 0 else len(symbols)
            if left >= 0 and right < len(symbols):
                made = self.pairs.get((symbols[left], symbols[right]))
                if made:
                    heapq.heappush(agenda, (made[0], left, symbols[left], symbols[right]))

        for i in range(len(symbols)):
            offer(i)
        while agenda:
            _, left, a, b = heapq.heappop(agenda)
            right = after[left]
            if symbols[left] != a or right >= len(symbols) or symbols[right] != b:
                continue
            symbols[left], symbols[right] = self.pairs[a, b][1], -1
            after[left] = after[right]
            if after[right] < len(symbols):
                before[after[right]] = left
            offer(left)
            offer(before[left])
        return [s for s in symbols if s != -1]

    def _ids(self, symbols: list[int]) -> list[int]:
        """Symbols that are no pieces as the bytes of their character."""
        ids: list[int] = []
        for s in symbols:
            ids += [s] if s >= 0 else [self.bytes[b] for b in chr(-2 - s).encode()]
        return ids

    def learn(self, parts: set[str]) -> None:
        """Encode parts that are not remembered, and hold them against the library."""
        short = [p for p in parts if len(p) <= SHORT_PART]
        long_ = [p for p in parts if len(p) > SHORT_PART]
        parts = short + long_
        found = self.merge_many(short) + [self.merge_long(p) for p in long_]
        found = [ids if not ids or min(ids) >= 0 else self._ids(ids) for ids in found]
        # The library adds a first space mark itself, so a part with none is asked after a line end;
        # a line end behind each part keeps a lone mark from being an empty text.
        lead = self.library.encode("\n")
        tail = lead[-1:]
        asked = [p[1:] + "\n" if p[0] == SPACE else f"\n{p}\n" for p in parts]
        for p, ids, answer in zip(parts, found, self.library.encode(asked, num_threads=1)):
            if answer != (ids + tail if p[0] == SPACE else lead + ids + tail):
                raise RuntimeError(f"the agenda and the library differ on {p[:200]!r}")
        self.memory.update(zip(parts, found))

    def parts(self, texts: list[str]) -> list[list[str]]:
        """The texts with their space marks, cut between characters that stand together in no piece."""
        marked = [SPACE + t.replace(" ", SPACE) if t else "" for t in texts]
        codes = np.frombuffer("".join(marked).encode("utf-32-le", "surrogatepass"), np.uint32)
        kind = np.where(codes == ord(SPACE), 0, np.where(codes < CUT_CODES, codes, CUT_CODES)).astype(np.int32)
        cuts = np.flatnonzero(~self.together[kind[:-1], kind[1:]]) + 1
        ends = np.cumsum(np.fromiter(map(len, marked), np.int64, len(marked)))
        at = np.searchsorted(cuts, np.r_[0, ends])
        found, start = [], 0
        for i, text in enumerate(marked):
            places = (cuts[at[i]:at[i + 1]] - start).tolist()
            start = int(ends[i])
            if text and (not places or places[-1] != len(text)):
                places.append(len(text))
            if places and places[0] == 0:
                places = places[1:]
            found.append([text[a:b] for a, b in zip([0, *places], places)])
        return found

    def encode(self, texts: list[str]) -> list[list[int]]:
        gc.disable()  # millions of small lists, no cycles
        try:
            return self._encode(texts)
        finally:
            gc.enable()

    def _encode(self, texts: list[str]) -> list[list[int]]:
        if len(self.memory) > MEMORY_PARTS:
            self.memory = {}
        cut = self.parts(texts)
        new = set(itertools.chain.from_iterable(cut)) - self.memory.keys()
        if new:
            self.learn(new)
        held = self.memory.__getitem__
        return [list(itertools.chain.from_iterable(map(held, parts))) for parts in cut]

    def decode(self, ids: list[list[int]]) -> list[str]:
        return self.library.decode(ids)


def model(path: str) -> PieceModel:
    return held(("pieces", path), lambda: PieceModel(path))


def encode(docs: DataFrame, path: str | None = None, id_column: str = "doc_id",
           text_column: str = "text") -> DataFrame:
    """(id, ids array<int>, decoded string) of every whole text; other columns are not carried.

    Null and empty texts give no ids and an empty decoded text. Rows are never dropped, merged
    or reordered; equal rows give equal rows, and an empty table an empty one. Texts of any
    length are handled in time of about n log n. There is no shuffle.
    """
    path = path or tokenizer_path("piece_bpe_32k.model")
    rows = pick(docs, id_column, text_column)
    schema = f"`{id_column}` {dict(rows.dtypes)[id_column]}, ids array<int>, decoded string"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = model(path)
        try:
            for batch in batches:
                for part in slices(batch, text_column, TEXT_BYTES):
                    texts = [t or "" for t in part.column(text_column).to_pylist()]
                    ids = bpe.encode(texts)
                    yield pa.RecordBatch.from_arrays(
                        [part.column(0), pa.array(ids, pa.list_(pa.int32())), pa.array(bpe.decode(ids), pa.string())],
                        names=[id_column, "ids", "decoded"])
        finally:
            bpe.memory = {}  # the worker lives on in other stages

    return rows.mapInArrow(tidied(run), schema)


@query("op5_sentencepiece")
def op5_sentencepiece(spark, sf_dir):
    coded = encode(table(spark, sf_dir, "documents"))
    return coded.select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"))
