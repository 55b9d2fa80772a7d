"""Phrases, search and packing against brute force, libraries and hostile tables."""

import collections
import math
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest

from wireglean.llm import best_positions, collocations, grouping_genetics

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


# --- phrases -----------------------------------------------------------------------------------------------

def brute_phrases(rows, least, top, share):
    f = collections.defaultdict(collections.Counter)
    for lang, text in rows:
        for piece in re.split("[.,;:!?\n\x0b\x0c\r]", (text or "").translate(LOWER)):
            words = re.findall("[^ \t]+", piece)
            for k in (1, 2, 3):
                for i in range(len(words) - k + 1):
                    f["und" if lang is None else lang][tuple(words[i:i + k])] += 1
    out = []
    for lang, counts in f.items():
        n = sum(v for w, v in counts.items() if len(w) == 1)
        kept = {w: a for w, a in counts.items() if len(w) > 1 and a >= least}
        found = []
        for w, a in kept.items():
            if any(len(o) > len(w) and 100 * b >= share * a and w in (o[:2], o[1:]) for o, b in kept.items()):
                continue
            cuts = [(10 ** 6 * a * a // (counts[w[:k]] * counts[w[k:]]), k) for k in range(1, len(w))]
            score, k = min(cuts)
            found.append((-score, -a, " ".join(w).encode(), counts[w[:k]], counts[w[k:]]))
        for rank, (score, a, phrase, left, right) in enumerate(sorted(found)[:top], 1):
            out.append((lang, rank, phrase.decode(), -a, left, right, n, -score))
    return sorted(out)


def phrase_rows():
    rng = np.random.default_rng(5)
    words = ["a", "b", "ab", "Ab", "é", "É", "the", "x\x01", "x", "\x00", "w" * 300, "日本"]
    texts = []
    for _ in range(60):
        parts = rng.choice(words, rng.integers(0, 40))
        texts.append("".join(p + str(rng.choice([" ", "  ", "\t", ". ", ",", "\n", " ! "], p=[.6, .1, .1, .05, .05, .05, .05]))
                             for p in parts))
    rows = [(str(rng.choice(["en", "de", "e"])), t) for t in texts]
    rows += [(None, "one two one two one two. one two"), ("en", None), (None, None), ("en", ""), ("", "p q p q p q"),
             ("en", "hot stone " * 20_000), ("en", "...,,,\n\n"), rows[0], rows[0], rows[0]]
    return rows


@pytest.mark.parametrize("trie_bytes,broadcast,top", [(3 << 20, 64 << 20, 2000), (60, 64 << 20, 5), (200, 0, 2000)])
def test_phrases_match_brute_force(spark, monkeypatch, trie_bytes, broadcast, top):
    monkeypatch.setattr(collocations, "TRIE_BYTES", trie_bytes)
    monkeypatch.setattr(collocations, "BROADCAST_BYTES", broadcast)
    rows = phrase_rows()
    docs = spark.createDataFrame([(i, lang, text, "k", i) for i, (lang, text) in enumerate(rows)],
                                 "phrase int, lang string, text string, key string, f int").repartition(5)
    for least, share in ((3, 50), (10, 80)):
        got = collocations.collocations(docs, least, top, share)
        assert sorted(map(tuple, got.collect())) == brute_phrases(rows, least, top, share)


def test_phrases_of_nothing(spark):
    schema = "lang string, text string"
    assert collocations.collocations(spark.createDataFrame([], schema)).collect() == []
    assert collocations.collocations(spark.createDataFrame([("en", "all words differ here")], schema)).collect() == []


def test_double_array_finds_its_keys_only():
    rng = np.random.default_rng(1)
    keys = sorted({bytes(rng.integers(1, 256, rng.integers(1, 9)).tolist()) + b"\0" for _ in range(5000)})
    trie = collocations.DoubleArray.build(pa.array(keys, pa.binary()))

    def find(key):
        state = 0
        for c in key:
            to = int(trie.base[state]) + c
            if trie.base[state] < 0 or trie.check[to] != state:
                return None
            state = to
        return -1 - int(trie.base[state]) if trie.base[state] < 0 else None

    assert [find(k) for k in keys] == list(range(len(keys)))
    assert all(find(k[:-1]) is None and find(k[:-1] + b"\1\0") in (None, *range(len(keys))) for k in keys)


def test_equal_words_are_walked_once_and_only_within_a_tries_range():
    texts = ["red fox red fox red hen", "red fox a fox. red", "hen red fox"]
    shard = collocations.Shard(texts, ["en", "de", "en"])
    words = [w for t in texts for w in t.replace(".", "").split()]
    group = ["en"] * 6 + ["de"] * 5 + ["en"] * 3
    assert [(group[i], words[i]) for i in shard.alike] == list(zip(group, words))
    assert shard.alike.tolist() == [min(j for j in range(14) if (group[j], words[j]) == (group[i], words[i])) for i in range(14)]
    keys = [("de", "red fox"), ("en", "fox red"), ("en", "red fox")]
    lang, phrase = (pa.array(c, pa.string()) for c in zip(*keys))
    trie = collocations.DoubleArray.build(collocations._keys(lang, phrase))
    ranges = {r["lang"]: (int.from_bytes(r["low"]), int.from_bytes(r["high"])) for r in collocations._ranges(lang, phrase)}
    want = sorted((i, keys.index((group[i], " ".join(words[i:i + 2])))) for i in shard.places(2)
                  if (group[i], " ".join(words[i:i + 2])) in keys)
    starts = collocations.Starts(shard, shard.places(2))
    for trie.ranges in (None, ranges):
        assert sorted(zip(*(x.tolist() for x in trie.walk(shard, starts)))) == want
    steps = []
    trie.base = type("Counted", (np.ndarray,), {"__getitem__": lambda self, at: (
        steps.append(np.size(at)), np.asarray(self)[at])[1]})(len(trie.base), np.int32, trie.base.tobytes())
    many = collocations.Shard(["stone wall " * 2000], ["en"])
    assert len(trie.walk(many, collocations.Starts(many, many.places(2)))[0]) == 0
    trie.ranges = None
    trie.walk(many, collocations.Starts(many, many.places(2)))
    assert sum(steps) < 100  # and not a step for each of 4 000 words


def test_tasks_send_no_row_for_each_phrase(spark, monkeypatch):
    sent, kept = spark.sparkContext.accumulator(0), collocations.tidied

    def counted(run):
        def rows(batches):
            for batch in run(batches):
                sent.add(batch.num_rows)
                yield batch
        return kept(rows)

    monkeypatch.setattr(collocations, "tidied", counted)
    words = [f"w{i}" for i in range(40)]
    text = " ".join(f"{a} {b}" for a in words for b in words)
    docs = spark.createDataFrame([("en", text)] * 32, "lang string, text string").repartition(8)
    got = collocations.collocations(docs)
    assert got.count() == len(brute_phrases([("en", text)] * 32, 10, 2000, 50))
    # About 3 000 distinct pairs and triples stand in each of eight tasks, and are sent as ranges; candidates (each once)
    # and counts come back.
    assert sent.value < 20_000


def test_kept_numbers_lose_no_pair(monkeypatch):
    monkeypatch.setattr(collocations, "ROW_NUMBERS", 5)
    monkeypatch.setattr(collocations, "SLICE_NUMBERS", 12)
    rng = np.random.default_rng(3)
    for size in (0, 1, 2, 3, 400):
        number, piece = rng.integers(-1, 4, size), np.cumsum(rng.random(size) < .2)
        beside = np.flatnonzero(piece[1:] == piece[:-1])
        rows = collocations._sequences(number, beside)
        want = [(number[i], number[i + 1]) for i in beside if number[i] >= 0 and number[i + 1] >= 0]
        batch = pa.RecordBatch.from_arrays([rows], ["numbers"])
        slices = list(collocations._slices([batch, batch.slice(1)] if len(rows) else []))
        first = len(want) - len(collocations._pairs(np.array(rows[0].as_py()))[0]) if len(rows) else 0
        found = [(p >> 32, p & 0xFFFFFFFF) for s in slices for p in collocations._pairs(s)[1].tolist()]
        assert found == want + want[len(want) - first:]
        assert all(r[-1] == -1 for r in rows.to_pylist())


def test_sums_of_packed_counts(spark):
    rng = np.random.default_rng(4)
    parts = [np.unique(rng.integers(0, 1 << 62, 300) % m, return_counts=True) for m in (5, 1 << 20, 400, 1 << 62)] * 3
    total = collections.Counter()
    for entries, counts in parts:
        for e, n in zip(entries.tolist(), counts.tolist()):
            total[e] += n
    for bits in (1, 3, 16):
        rows = [r for e, n in parts + [(np.empty(0, np.int64), np.empty(0, np.int64))]
                for r in zip(*(c.to_pylist() for c in collocations._packed(e, n, bits).values()))]
        got = collocations._summed(spark.createDataFrame(rows, collocations._PACKED), 6).collect()
        assert sorted(map(tuple, got)) == sorted((e, n) for e, n in total.items() if n >= 6)


# --- search ------------------------------------------------------------------------------------------------

def brute_search(docs, items, k):
    term = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
    cut = [(i, collections.Counter(term.findall((t or "").translate(LOWER)))) for i, t in docs]
    n_docs, total = sum(bool(c) for _, c in cut), sum(sum(c.values()) for _, c in cut)
    df = collections.Counter(t for _, c in cut for t in c)
    wanted = {}
    for item, text in items:
        wanted.setdefault(item, set()).update(term.findall((text or "").translate(LOWER)))
    out = []
    for item, terms in wanted.items():
        found = []
        for i, c in cut:
            score = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1)))
                        * (1_000_000_000 * c[t] // (1000 * c[t] + 8 * (10 + 90 * sum(c.values()) * n_docs // total)))
                        for t in terms if c[t])
            if score > 0:
                found.append((-score, i is None, i))
        found.sort(key=lambda x: (x[0], x[1], x[2] if x[2] is not None else 0))
        out += [(item, r, i, -s) for r, (s, _, i) in enumerate(found[:k], 1)]
    return sorted(out, key=str)


def search_rows():
    rng = np.random.default_rng(3)
    words = [f"w{i}" for i in range(40)] + ["Été", "été", "x-y", "日本", "A9"]
    weight = 1 / np.arange(1, len(words) + 1)
    docs = [(int(i), " ".join(rng.choice(words, rng.integers(0, 60), p=weight / weight.sum()))) for i in rng.permutation(400)]
    docs += [(7, docs[0][1]), (7, docs[0][1]), (None, docs[1][1]), (None, docs[1][1]), (900, None), (901, ""), (902, "..."),
             (903, "W3 " * 30_000), *[(1000 + i, "w3 w5 w7") for i in range(30)]]
    items = [(i, " ".join(rng.choice(words, 6))) for i in range(12)]
    items += [(50, None), (51, ""), (52, "unheard of"), (3, "w9 w9 w9"), (None, "w3 w5"), (60, "w3 w5 w7")]
    return docs, items


@pytest.mark.parametrize("shard,block,step", [(24 << 20, 200_000, 16), (2000, 20, 1), (40_000, 5, 3)])
def test_search_matches_brute_force(spark, monkeypatch, shard, block, step):
    monkeypatch.setattr(best_positions, "SHARD_BYTES", shard)
    monkeypatch.setattr(best_positions, "BLOCK_TERMS", block)
    monkeypatch.setattr(best_positions, "STEP", step)
    docs, items = search_rows()
    table = spark.createDataFrame([(*d, "q", 1) for d in docs], "doc_id int, text string, term string, score int").repartition(3)
    benchmark = spark.createDataFrame([(*i, 0) for i in items], "item_id long, text string, query int")
    for k in (3, 10):
        got = sorted((tuple(r) for r in best_positions.search(table, benchmark, k).collect()), key=str)
        assert got == brute_search(docs, items, k)


def test_search_by_string_ids_and_in_empty_tables(spark):
    docs = spark.createDataFrame([("b", "x y"), ("a", "x y"), ("c", "z")], "doc_id string, text string")
    items = spark.createDataFrame([("q", "x")], "item_id string, text string")
    assert [(r[1], r[2]) for r in best_positions.search(docs, items).collect()] == [(1, "a"), (2, "b")]
    assert best_positions.search(docs.limit(0), items).collect() == []
    assert best_positions.search(docs, items.limit(0)).collect() == []


def test_search_stops_before_the_lists_end():
    rng = np.random.default_rng(2)
    n = 20_000
    doc = np.tile(np.arange(n), 2)
    term = np.repeat([0, 1], n)
    impact = np.r_[rng.permutation(n), rng.permutation(n)] + 1
    lists = best_positions.ImpactLists(2, doc, term, impact)
    best = []
    looked_up = best_positions.best_position_search([lists.of(0), lists.of(1)], n, 5, best, lambda d: (-d, d))
    sums = impact[:n] + impact[n:]
    assert sorted((-s, d) for s, _, d in best) == sorted(zip((-sums).tolist(), range(n)))[:5]
    assert looked_up < n // 4


# --- packing -----------------------------------------------------------------------------------------------

TEXTS = ["it's 'tis ''s 've we've 'rest 'REall don't", "<|endoftext|> x <|startoftext|>", "", None, "İstanbul ΣΑΣ ß ŉ 'ſ",
         "Ünïcode 'É é ①② ٣٤ x　y 汉字，テスト 'lla 1'd2 \U0001F600\U0001F600 á'll", "'", "'s's'd''t",
         "\x00\x01 \x1c \x85 ​ b", "word " * 9000, "1" * 5000, "a" * 3000]


def check_packing(rows, packed, capacity, end_id, near):
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(grouping_genetics.tokenizer_file())
    wanted = collections.Counter()
    for name, text in rows:
        ids = np.array([*library.encode(text or "", add_special_tokens=False).ids, end_id], "<u4")
        for piece, a in enumerate(range(0, len(ids), capacity)):
            cut = ids[a:a + capacity]
            wanted[name, piece, a, len(cut), zlib.crc32(cut.tobytes())] += 1
    assert collections.Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in packed) == wanted
    bins = collections.defaultdict(list)
    for r in packed:
        bins[r.sequence_id].append((r.offset, r.length))
    for parts in bins.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= capacity
    assert len(bins) <= near * -(-sum(r.length for r in packed) // capacity) + 1


def test_packing_of_odd_texts(spark):
    rows = [(i, t) for i, t in enumerate(TEXTS)] + [(3, "again"), (3, "again"), (None, "no id"), (None, None)]
    docs = spark.createDataFrame([(*r, 1, "b") for r in rows], "doc_id long, text string, row int, sequence_id string")
    for capacity, end in ((4096, 1), (100, 7)):
        check_packing(rows, grouping_genetics.pack(docs, capacity, end).collect(), capacity, end, 1.02)
    assert grouping_genetics.pack(docs.limit(0)).collect() == []


def test_packing_over_several_groups(spark, monkeypatch):
    monkeypatch.setattr(grouping_genetics, "GROUP_PIECES", 100)
    monkeypatch.setattr(grouping_genetics, "GROUP_BINS", 5)
    rng = np.random.default_rng(4)
    rows = [(i, "the " * int(n)) for i, n in enumerate(rng.integers(0, 90, 1500))] + [(1, None)] * 700
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    check_packing(rows, grouping_genetics.pack(docs, 128).collect(), 128, 1, 1.01)


def test_sequences_join_their_pieces(spark):
    docs = spark.createDataFrame([("a", "one two three"), ("b", None), ("c", "four " * 50)], "doc_id string, text string")
    packed = grouping_genetics.pack(docs, 32, keep_ids=True).persist()
    by_place = {(r.sequence_id, r.offset): list(r.ids) for r in packed.collect()}
    for r in grouping_genetics.sequences(packed).collect():
        assert list(r.ids) == sum((by_place[r.sequence_id, a] for a in sorted(r.starts)), [])


def test_islands_get_better_and_stay_whole():
    rng = np.random.default_rng(8)
    lengths = np.sort(rng.integers(200, 700, 300))[::-1]
    island = grouping_genetics.Island(lengths, 1000, (1,))
    first = island.fresh(0)
    last = island.evolve([], 8, 40)[0]
    assert island.quality(last) <= island.quality(first)
    assert island.bound <= island.quality(last)[0]
    child = island.cross(first, last)
    for bins in (first, last, child):
        assert np.bincount(bins, weights=lengths).max() <= 1000
        assert len(np.unique(bins)) == bins.max() + 1
    assert grouping_genetics.least_bins(np.array([600, 600, 600, 300]), 1000) == 3
    assert grouping_genetics.least_bins(np.array([600, 600, 401]), 1000) == 3
