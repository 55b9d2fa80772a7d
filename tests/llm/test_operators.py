"""The operators against brute force, round trips, held-out rows, and tables with every odd case."""

import collections
import hashlib
import math
import random
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest

from tests.conftest import SF
from wireglean.llm import (
    common, fm_index, grid_order_join, jaccard_join, language, personal_data, piece_bpe, reply_trees, suffix_dedup,
    toxicity, warc,
)

LONG = "".join(random.Random(5).choice("ab cde\nf é") for _ in range(300_000))
# Null and empty texts, null ids, repeated rows, one very long text, and columns named like results.
ODD = [(1, "one two three four five six seven", 7, "x"), (1, "one two three four five six seven", 7, "x"),
       (2, None, 1, None), (3, "", None, "y"), (None, "one two three four five six seven", 3, "z"), (4, LONG, 0, "w"),
       (5, "   \n\t ", 1, "v"), (6, "\x00 <|end|>\x01", 2, "u")]
ODD_SCHEMA = "doc_id long, text string, n_words int, Spans string"


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame(ODD, ODD_SCHEMA)


@pytest.fixture(scope="module")
def documents(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


def texts_of(frame):
    return {r["doc_id"]: r["text"] for r in frame.select("doc_id", "text").collect()}


# --- 1: benchmark decontamination


def lower(text):
    return (text or "").translate({i: i + 32 for i in range(65, 91)})


WORDS = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def brute_hits(text, items, size=13):
    own = WORDS.findall(lower(text))
    hit, named = set(), set()
    for item, item_text in items:
        w = WORDS.findall(lower(item_text))
        n = min(size, len(w))
        for i in range(len(w) - n + 1 if n else 0):
            for j in range(len(own) - n + 1):
                if own[j:j + n] == w[i:i + n]:
                    hit.update(range(j, j + n))
                    if item is not None:
                        named.add(str(item))
    return len(own), len(hit), sorted(named)


def test_decontamination_matches_brute_force(spark):
    draw = random.Random(1)
    vocabulary = ["a", "b", "É", "c3", "dd"]
    text = lambda n: " ".join(draw.choice(vocabulary) for _ in range(n))
    docs = [(i, text(draw.randint(0, 60))) for i in range(40)] + ODD_TEXTS
    items = [(i, text(draw.choice([1, 3, 5, 13, 14, 20]))) for i in range(12)] + [(99, None), (98, ""), (None, "dd dd dd")]
    items.append((97, docs[3][1]))
    found = fm_index.decontaminate(spark.createDataFrame(docs, "doc_id long, text string"),
                                   spark.createDataFrame(items, "item_id long, text string")).collect()
    assert len(found) == len(docs)
    for r in found:
        n, hit, named = brute_hits(r["text"], items)
        assert (r["n_words"], r["n_hit"], r["items"]) == (n, hit, named)
        assert r["contaminated"] == (hit > 0 and 20 * hit >= n)
        covered = " ".join((r["text"] or "")[s["start"]:s["end"]] for s in r["spans"])
        assert len(WORDS.findall(covered)) == hit


ODD_TEXTS = [(100, None), (101, ""), (102, "...")]


def test_decontamination_of_odd_and_empty_tables(spark, odd):
    none = spark.createDataFrame([], "item_id long, text string, n_words int")
    found = fm_index.decontaminate(odd, none).collect()
    assert len(found) == len(ODD) and not any(r["contaminated"] for r in found)
    items = spark.createDataFrame([(1, "three four five", 2)], "item_id long, text string, n_words int")
    assert sum(r["contaminated"] for r in fm_index.decontaminate(odd, items).collect()) == 3
    assert fm_index.decontaminate(odd.limit(0), items).count() == 0


def test_many_windows_are_searched_block_by_block(spark, monkeypatch):
    docs = spark.createDataFrame([(1, " ".join(f"w{i}" for i in range(60)))], "doc_id long, text string")
    items = spark.createDataFrame([(i, " ".join(f"w{j}" for j in range(i, i + 20))) for i in range(8)], "item_id long, text string")
    monkeypatch.setattr(fm_index, "PATTERN_ROWS", 5)
    row = fm_index.decontaminate(docs, items).first()
    assert (row["n_hit"], len(row["items"])) == (27, 8)


# --- 2: near vectors


def brute_links(rows, cosine=0.93):
    def good(r):
        return (r[0] is not None and r[1] is not None and r[2] and all(x is not None and math.isfinite(x) for x in r[2])
                and any(r[2]))
    links = collections.defaultdict(set)
    for i, a in enumerate(rows):
        for j, b in enumerate(rows):
            if i != j and good(a) and good(b) and a[1] == b[1] and len(a[2]) == len(b[2]):
                x, y = np.array(a[2], float), np.array(b[2], float)
                if x @ y / math.sqrt(x @ x) / math.sqrt(y @ y) >= cosine:
                    links[i].add(j)
    out = []
    for i, r in enumerate(rows):
        seen, open_ = {i}, [i]
        while open_:
            for j in links[open_.pop()] - seen:
                seen.add(j)
                open_.append(j)
        out.append((r[0], len(links[i]), min((rows[j][0] for j in seen if rows[j][0] is not None), default=None)))
    return sorted(out, key=str)


def test_near_vectors_match_brute_force(spark, monkeypatch):
    monkeypatch.setattr(grid_order_join, "BLOCK", 16)
    draw = np.random.default_rng(3)
    centers = draw.normal(size=(12, 6))
    rows = [(int(i), int(i % 3), (centers[i % 12] + draw.normal(0, 0.25, 6)).tolist()) for i in range(400)]
    rows += [(1000 + i, 1, rows[1][2]) for i in range(30)]  # copies
    rows += [(2000, 1, None), (2001, 1, []), (2002, 1, [0.0] * 6), (2003, 1, [float("nan")] + [1.0] * 5),
             (2004, None, rows[1][2]), (2005, 1, [None] + [1.0] * 5), (2006, 1, [float("inf")] + [1.0] * 5),
             (None, 1, rows[1][2]), (2007, 1, [1.0, 0.5]), (2008, 1, [1.0, 0.5]), (2009, 1, [-1.0, -0.5])]
    frame = spark.createDataFrame([(*r, "x") for r in rows], "vec_id long, label int, embedding array<double>, n_links string")
    found = sorted(((r["vec_id"], r["n_links"], r["component_id"]) for r in grid_order_join.near_vectors(frame).collect()), key=str)
    assert found == brute_links(rows)
    assert grid_order_join.near_vectors(frame.limit(0)).count() == 0


# --- 3: repeated strings


def brute_repeats(texts, depth=200):
    data = [(t or "").encode() for t in texts]
    seen = collections.Counter(b[s:s + depth] for b in data for s in range(len(b) - depth + 1))
    out = []
    for b in data:
        gone = bytearray(len(b))
        for s in range(len(b) - depth + 1):
            if seen[b[s:s + depth]] > 1:
                gone[s:s + depth] = b"\1" * depth
        kept = bytes(x for x, g in zip(b, gone) if not g)
        runs = sum(1 for i, g in enumerate(gone) if g and not (i and gone[i - 1]))
        out.append((len(b), sum(gone), runs, kept))
    return sorted(out)


@pytest.mark.parametrize("group", [suffix_dedup.GROUP, 1])
def test_repeats_match_brute_force(spark, group):
    draw = random.Random(2)
    text = lambda n: "".join(draw.choice("abcdefgh é") for _ in range(n))
    passage, other = text(450), text(230)
    texts = [text(draw.randint(0, 500)) for _ in range(10)]
    texts += [text(100) + passage + text(90), passage[100:], passage[:199], passage[:200], other + text(50) + other,
              text(30) + other[:215], "a" * 1000, "ab" * 300, None, "", texts[3], texts[3], text(120) + passage[50:420] + text(80)]
    rows = [(i % 9, t, "x") for i, t in enumerate(texts)]  # ids repeat
    frame = spark.createDataFrame(rows, "doc_id long, text string, n_bytes string")
    found = suffix_dedup.remove_repeats(frame, group=group).collect()
    got = sorted((r["n_bytes"], r["n_bytes"] - len(r["kept"]), len(r["spans"]), bytes(r["kept"])) for r in found)
    assert got == brute_repeats(texts)


def test_repeats_of_odd_and_empty_tables(spark, odd):
    found = suffix_dedup.remove_repeats(odd).collect()
    assert len(found) == len(ODD)
    assert suffix_dedup.remove_repeats(odd.limit(0)).count() == 0


def test_a_text_longer_than_a_chunk(spark):
    draw = random.Random(4)
    long_ = "".join(draw.choice("abcdef") for _ in range(suffix_dedup._CHUNK + 900))
    cut = long_[suffix_dedup._CHUNK - 300:suffix_dedup._CHUNK + 300]
    found = suffix_dedup.remove_repeats(spark.createDataFrame([(1, long_), (2, "xyz" + cut)], "doc_id long, text string"))
    assert {r["doc_id"]: [tuple(s) for s in r["spans"]] for r in found.collect()} == {
        1: [(suffix_dedup._CHUNK - 300, suffix_dedup._CHUNK + 300)], 2: [(3, 603)]}


# --- 4: archives


def test_archives_round_trip(spark):
    magic = "\x1f\x8b WARC/1.1\r\nWARC-Type: response\r\n\r\n"
    rows = [(1, "http://a", "same"), (5, "http://b\r\nX: y", "same"), (9, None, "same"), (2, "u", None), (3, "u", ""),
            (4, "u", magic * 3), (7, "u", "é" * 200_000), (None, "u", "alone"), (None, "u", "same"), (-6, "u", "minus")]
    frame = spark.createDataFrame([(*r, 1) for r in rows], "page_id long, url string, html string, payload_bytes int")
    ws = common.Workspace(spark, "test")
    manifest = warc.write(frame.repartition(3), ws)
    whole = warc.read(manifest).collect()
    small = warc.read(manifest, range_bytes=97).collect()
    assert sorted(map(str, whole)) == sorted(map(str, small)) and len(whole) == len(rows)
    found = {r["record_id"]: r for r in whole}
    assert found["<urn:page:9>"]["record_type"] == "response" and bytes(found["<urn:page:9>"]["payload"]) == b"same"
    for page in (1, 5):
        r = found[f"<urn:page:{page}>"]
        assert (r["record_type"], r["refers_to"], r["payload"], r["payload_bytes"]) == ("revisit", "<urn:page:9>", None, 4)
    assert found["<urn:page:2>"]["refers_to"] == "<urn:page:3>" and found["<urn:page:3>"]["record_type"] == "response"
    assert bytes(found["<urn:page:4>"]["payload"]).decode() == magic * 3
    assert found["<urn:page:7>"]["payload_bytes"] == 400_000
    for r in whole:
        if r["payload"] is not None:
            assert r["payload_digest"] == warc.digest(bytes(r["payload"]))
    none = warc.write(frame.limit(0), common.Workspace(spark, "test"))
    assert warc.read(none).count() == 0


def test_small_payloads_are_all_responses(spark):
    frame = spark.createDataFrame([(1, "u", "xy"), (2, "u", "xy"), (3, "u", "long enough"), (4, "u", "long enough")],
                                  "page_id long, url string, html string")
    found = warc.read(warc.write(frame, common.Workspace(spark, "test"), least_bytes=5)).collect()
    assert sorted(r["record_type"] for r in found) == ["response", "response", "response", "revisit"]


# --- 5: pieces


def test_pieces_equal_the_library(spark, documents, odd):
    import sentencepiece

    library = sentencepiece.SentencePieceProcessor(model_file=common.tokenizer_path("piece_bpe_32k.model"))
    texts = [t for t in texts_of(documents).values()] + [t for _, t, *_ in ODD] + [
        "a  b\nc　dﬁ ½ é é <s>x</s> ▁u 😀 \x00", "   ", "\n\n a", " x\n  y\n\n", "a" * 5000, "ab " * 300, "▁▁a▁", "😀" * 100]
    frame = spark.createDataFrame([(i, t, "x") for i, t in enumerate(texts)], "doc_id long, text string, ids string")
    for r in piece_bpe.encode(frame).collect():
        wanted = library.encode(texts[r["doc_id"]] or "")
        assert r["ids"] == wanted and r["decoded"] == library.decode(wanted)
    assert piece_bpe.encode(frame.limit(0)).count() == 0


def test_the_heap_and_the_batch_agree():
    bpe = piece_bpe.PieceModel(common.tokenizer_path("piece_bpe_32k.model"))
    draw = random.Random(8)
    parts = ["▁" + "".join(draw.choice("aabcdeino.,▁") for _ in range(draw.randint(1, 40))) for _ in range(2000)]
    assert bpe.merge_many(parts) == [bpe.merge_long(p) for p in parts]


# --- 6: Jaccard join


def shingles(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", lower(text))
    return {tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def brute_components(rows):
    sets = [shingles(t) for _, t in rows]
    name = {i: i for i, _ in rows if i is not None}
    for _ in rows:
        for i, (a, _) in enumerate(rows):
            for j, (b, _) in enumerate(rows):
                linked = a == b or (sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j]))
                if a is not None and b is not None and linked:
                    name[a] = name[b] = min(name[a], name[b])
    return sorted(((i, len(s), None if i is None else name[i]) for (i, _), s in zip(rows, sets)), key=str)


def test_near_duplicates_match_brute_force(spark):
    draw = random.Random(6)
    word = lambda: draw.choice("abcdefghij") + draw.choice("klmno")
    base = [word() for _ in range(80)]
    rows = []
    for i in range(45):  # edits of one text, some beyond the threshold, joined through others
        w = list(base)
        for _ in range(draw.randint(0, 5)):
            w[draw.randrange(80)] = word()
        rows.append((200 - i, " ".join(w)))
    rows += [(300 + i, " ".join(word() for _ in range(draw.randint(1, 30)))) for i in range(20)]
    rows += [(400, "x y"), (401, "X  y"), (402, "y x"), (403, None), (404, ""), (405, " \n"), (None, " ".join(base)),
             (7, rows[0][1]), (7, rows[50][1]), (8, rows[0][1]), (8, rows[0][1])]
    frame = spark.createDataFrame([(*r, "x") for r in rows], "doc_id long, text string, n_shingles string")
    found = jaccard_join.near_duplicates(frame).collect()
    assert sorted(((r["doc_id"], r["n_shingles"], r["component_id"]) for r in found), key=str) == brute_components(rows)
    assert jaccard_join.near_duplicates(frame.limit(0)).count() == 0


def test_copies_spread_over_files_keep_their_links(spark, tmp_path):
    draw = random.Random(3)
    rows = []
    for i in range(60):
        w = [f"w{j}" for j in range(90)]
        for _ in range(i % 4):
            w[draw.randrange(90)] = f"x{draw.randrange(10_000)}"
        rows.append((i, " ".join(w)))
    spark.createDataFrame(rows, "doc_id long, text string").repartition(7).write.parquet(str(tmp_path / "docs"))
    found = jaccard_join.near_duplicates(spark.read.parquet(str(tmp_path / "docs"))).collect()
    assert sorted(((r["doc_id"], r["n_shingles"], r["component_id"]) for r in found), key=str) == brute_components(rows)


def test_counting_a_block_keeps_one_copy_of_its_numbers():
    import tracemalloc

    drawn = np.random.default_rng(1).integers(0, 1 << 18, (16, 1 << 16)).astype(np.uint64)
    want = np.unique(drawn, return_counts=True)
    tracemalloc.start()
    parts = [d.copy() for d in drawn]
    got = [(r, *f) for r, f in jaccard_join.counted_ranges(parts, 64, np.uint64(12))]
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert all((found >> np.uint64(12) == r).all() for r, found, _ in got)
    assert (np.concatenate([g[1] for g in got]) == want[0]).all() and (np.concatenate([g[2] for g in got]) == want[1]).all()
    assert peak < 2.8 * drawn.nbytes  # the parts, the sorted copy and what is found; np.unique of all took five times


def test_a_stage_drops_what_another_held(spark):
    from pyspark import TaskContext

    from wireglean.llm.common import held, tidied

    def stage(name):
        def run(batches):
            import sys

            for _ in batches:
                held((name,), lambda: 1)
                kept = [k[0] for k in sys.modules["wireglean_held"].__dict__ if isinstance(k, tuple)]
                yield pa.RecordBatch.from_pydict({"kept": [",".join(sorted(kept))], "stage": [TaskContext.get().stageId()]})

        return [r["kept"] for r in spark.range(0, 64, 1, 16).mapInArrow(tidied(run), "kept string, stage long").collect()]

    assert set(stage("model of one stage")) == {"model of one stage"}
    assert set(stage("model of the next")) == {"model of the next"}


def test_packed_numbers_come_back():
    for numbers in ([], [0], [5], [1, 2, 3, 1 << 43]):
        numbers = np.array(numbers, np.uint64)
        assert (jaccard_join._unpack(jaccard_join._pack(numbers)) == numbers).all()


# --- 7: reply trees


def test_reply_trees(spark):
    rows = [(1, None, "user", "q", 0.0), (2, 1, "assistant", "a<|end|>\n", 5.0), (3, 1, "assistant", "b", 1.0),
            (4, 3, "user", "c", 9.0), (5, 4, "assistant", "<\\|d", 0.0), (6, 77, "user", "orphan", None),
            (7, 8, "user", "cycle", 1.0), (8, 7, "user", "cycle", 1.0), (9, 7, "user", "below", 1.0), (None, 1, "user", "no id", 1.0),
            (2, 1, "assistant", "a<|end|>\n", 5.0), (10, 6, None, None, 1.0)]
    frame = spark.createDataFrame([(*r, "x") for r in rows], "node long, parent long, role string, text string, score double, path string")
    found = {r["path"]: r for r in reply_trees.conversations(frame, branches=None, score_column="score").collect()}
    assert {p: [t for t in reply_trees.read_turns(r["text"])] for p, r in found.items()} == {
        2: [("user", "q"), ("assistant", "a<|end|>\n")], 5: [("user", "q"), ("assistant", "b"), ("user", "c"), ("assistant", "<\\|d")],
        10: [("user", "orphan"), ("", "")]}
    assert (found[5]["rank"], found[2]["rank"]) == (1, 2)
    r = found[5]
    assert [reply_trees.unescape(r["text"][s["start"]:s["end"]]) for s in r["loss_spans"]] == ["b", "<\\|d"]
    best = reply_trees.conversations(frame, branches=1, score_column="score").collect()
    assert sorted(r["path"] for r in best) == [5, 10]
    assert reply_trees.conversations(frame.limit(0)).count() == 0


def test_long_conversations_go_on_in_parts(spark, monkeypatch):
    monkeypatch.setattr(reply_trees, "PART_CHARS", 100)
    rows = [(7, t, "user" if t % 2 else "assistant", f"turn {t} " * 4) for t in range(40)] + [(None, 0, "user", "n"), (8, None, "user", None)]
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    ws = common.Workspace(spark, "test")
    made = reply_trees.conversations(reply_trees.previous_turns(frame, "conv_id", ["turn"], ws), None, carry="conv_id")
    assert made.where("conv_id = 7").count() > 5
    found = {r["conv_id"]: r for r in reply_trees.read_back(made, "conv_id").collect()}
    turns = "".join(f"{r[2]}\n{r[3]}\n" for r in rows[:40])
    loss = "".join(r[3] for r in rows[:40] if r[2] == "assistant")
    assert found[7]["turns_sha256"] == hashlib.sha256(turns.encode()).hexdigest()
    assert (found[7]["loss_chars"], found[7]["loss_sha256"]) == (len(loss), hashlib.sha256(loss.encode()).hexdigest())
    assert found[None]["n_turns"] == 1 and found[8]["n_turns"] == 1


def test_escapes_are_reversible():
    for t in ["a<|end|>\n", "<", "<\\|x<\\\\|", "<|<|", "||", "<\\", ""]:
        head, body = reply_trees.format_turn("us<|e\nr\\n", t)
        turn = head + body + reply_trees.CLOSE
        assert list(reply_trees.read_turns(turn * 2)) == [("us<|e\nr\\n", t)] * 2
        assert "<|" not in body


# --- 8: language


def test_language_on_held_out_rows(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    model = language.fit_on_documents(docs)
    found = {r["doc_id"]: r for r in language.identify(docs, model).collect()}
    rows = [r for r in docs.collect() if zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0]
    right = sum(found[r["doc_id"]]["lang_pred"] == r["lang"] for r in rows)
    assert right >= 0.97 * len(rows)
    assert sum(r["rejected"] for r in found.values()) <= 0.02 * len(found)
    assert all(0 <= r["lang_score"] <= 1 for r in found.values())


def test_language_of_odd_and_empty_tables(spark, odd, documents):
    model = language.fit_on_documents(documents)
    found = language.identify(odd, model, carry=("n_words", "Spans")).collect()
    assert len(found) == len(ODD)
    for r in found:
        if not any(map(str.isalpha, r["text"] or "")):
            assert (r["lang_pred"], r["lang_score"], r["rejected"]) == ("und", 0.0, True)
        else:
            assert r["lang_pred"] in model
    assert language.fit_on_documents(documents.limit(0)) == {}
    assert {r["lang_pred"] for r in language.identify(odd, {}).collect()} == {"und"}


# --- 9: personal data

PATTERNS = [re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"), re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
            re.compile(r"[0-9]([\x20-]?[0-9])+"), re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")]


def brute_spans(text):
    found = [(0, *m.span()) for m in PATTERNS[0].finditer(text)]
    found += [(1, *m.span()) for m in PATTERNS[1].finditer(text) if all(int(p) <= 255 for p in m[0].split("."))]
    for kind, low, high in ((2, 13, 19), (3, 9, 15)):
        for m in PATTERNS[kind].finditer(text):
            digits = re.sub("[^0-9]", "", m[0])
            if low <= len(digits) <= high and (kind == 3 or personal_data.luhn(digits)):
                found.append((kind, *m.span()))
    return found


def test_base_spans_match_the_patterns(documents):
    draw = random.Random(9)
    texts = ["".join(draw.choice("ab1290@@..+-( )%é") for _ in range(draw.randint(1, 40))) for _ in range(5000)]
    for text in [*texts, *texts_of(documents).values()]:
        assert personal_data.base_spans(text) == brute_spans(text)


def test_hostile_texts_take_linear_time():
    for text in ("a" * 200_000, "1" * 200_000, "@" * 100_000, "1." * 100_000, "+1" * 100_000, "1 " * 100_000, "a.b@" * 50_000):
        personal_data.tokens(text, personal_data.base_spans(text))


def test_skip_chains_carry_labels(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    model = personal_data.fit(docs)
    (spans,) = personal_data.label(["card 4539148803436467 or 4539-1488-0343-6467."], model)
    assert [s[0] for s in spans] == ["card", "card"]
    plain = [t for t in texts_of(docs.limit(300)).values() if not re.search("[0-9@]", t)]
    assert not any(personal_data.label(plain, model))


def test_personal_data_of_odd_and_empty_tables(spark, odd):
    model = personal_data.train(["mail a@b.co now", "call +1 (017) 555-7713", "10.0.0.1"] * 5)
    rows = spark.createDataFrame([(1, "mail a@b.co, 10.0.0.1", "x"), (2, None, "y")], "doc_id long, text string, masked string")
    found = {r["doc_id"]: r for r in personal_data.find(rows, model).collect()}
    assert found[1]["masked"] == "mail [EMAIL], [IP]" and found[2]["masked"] is None and found[2]["spans"] == []
    assert personal_data.find(odd, model, carry=("n_words",)).count() == len(ODD)
    assert personal_data.find(odd.limit(0), personal_data.train([])).count() == 0


# --- 10: toxicity


def test_toxicity_on_held_out_rows(spark):
    folder = "/root/testdata/sf0.1"
    docs, labels = spark.read.parquet(f"{folder}/documents.parquet"), spark.read.parquet(f"{folder}/labels.parquet")
    model = toxicity.fit(docs, labels.where(~language.held_out("doc_id", 4, 2)))
    found = {r["doc_id"]: r for r in toxicity.score(docs, model).collect()}
    rows = [r for r in labels.collect() if zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2]
    caught = [found[r["doc_id"]]["toxic_pred"] for r in rows if r["toxic"] == 1]
    false = [found[r["doc_id"]]["toxic_pred"] for r in rows if r["toxic"] == 0]
    assert sum(caught) >= 0.9 * len(caught) and sum(false) <= 0.05 * len(false)
    # Spellings that no training text has.
    assert min(model.scores(["wrthless", "you worthles thing", "stuppid"])) > 0.3


def test_toxicity_of_odd_and_empty_tables(spark, odd):
    none = spark.createDataFrame([], "doc_id long, toxic int")
    model = toxicity.fit(odd, none)
    found = toxicity.score(odd, model).collect()
    assert len(found) == len(ODD) and all(0 <= r["toxic_score"] <= 1 for r in found)
    assert toxicity.score(odd.limit(0), model).count() == 0


# --- components


def test_components_of_chains_and_stars(spark):
    edges = [(i, i + 1) for i in range(100)] + [(500, j) for j in range(501, 540)] + [(9, 9), (700, 600), (600, 700)]
    frame = spark.createDataFrame(edges, "u long, v long")
    found = dict(common.components(frame, common.Workspace(spark, "test"), "c").distinct().collect())
    assert found == {**{i: 0 for i in range(101)}, **{i: 500 for i in range(500, 540)}, 600: 600, 700: 600}
