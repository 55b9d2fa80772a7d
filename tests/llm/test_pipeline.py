"""The pipeline's stages, each held against what its operator's rule says of its own input."""

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tests.conftest import SF
from tests.llm.test_operators import brute_hits, shingles
from wireglean.llm import personal_data


@pytest.fixture(scope="module")
def tables(spark):
    """The input and the result of every stage on the smallest tables."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = [docs.collect()]
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SF).cache()
        rows.append(docs.collect())
    return rows


def test_all_stages_keep_the_columns(tables):
    for rows in tables[1:-1]:
        assert rows[0].__fields__ == tables[0][0].__fields__


def test_language_keeps_what_is_clear(tables):
    kept = {r["doc_id"] for r in tables[1]}
    assert len(kept) >= 0.97 * len(tables[0])
    assert not any(r["doc_id"] in kept for r in tables[0] if not any(map(str.isalpha, r["text"] or "")))


def test_one_document_of_each_group_stays(tables):
    before = {r["doc_id"]: shingles(r["text"]) for r in tables[1]}
    linked = lambda a, b: bool(a) and 100 * len(a & b) >= 80 * len(a | b)
    name = {i: i for i in before}
    changed = True
    while changed:
        changed = False
        for i in before:
            for j in before:
                if name[i] != name[j] and linked(before[i], before[j]):
                    name[i] = name[j] = min(name[i], name[j])
                    changed = True
    assert {r["doc_id"] for r in tables[2]} == {i for i in before if name[i] == i}


def test_contaminated_documents_go(spark, tables):
    items = [tuple(r) for r in spark.read.parquet(f"{SF}/benchmark.parquet").select("item_id", "text").collect()]
    kept = {r["doc_id"]: r["text"] for r in tables[3]}
    for r in tables[2]:
        n, hit, _ = brute_hits(r["text"], items)
        assert (r["doc_id"] in kept) == (not (hit and 20 * hit >= n))
        assert kept.get(r["doc_id"], r["text"]) == r["text"]


def test_personal_data_is_masked(tables):
    assert [r["doc_id"] for r in tables[4]] == [r["doc_id"] for r in tables[3]]
    for before, after in zip(tables[3], tables[4]):
        assert not personal_data.base_spans(after["text"])
        assert after["n_chars"] == len(after["text"])
        if not personal_data.tokens(before["text"], []):
            assert after["text"] == before["text"]


def test_every_document_is_encoded(tables):
    assert sorted(r["doc_id"] for r in tables[5]) == sorted(r["doc_id"] for r in tables[4])
    assert all(r["n_tokens"] == len(r["ids"]) for r in tables[5])


def test_odd_tables_pass_all_stages(spark):
    rows = [(1, None, "en", "s", 0, "x"), (2, "", None, None, None, "y"), (None, "the quick brown fox jumps over it", "en", "s", 3, "z"),
            (3, "the quick brown fox jumps over it", "en", "s", 33, "z"), (3, "the quick brown fox jumps over it", "en", "s", 33, "z"),
            (4, "mail a@b.com to us in time for the show", "en", "s", 1, "w")]
    schema = "doc_id long, text string, lang string, source string, n_chars long, spans string"
    for data in (rows, []):
        docs = spark.createDataFrame(data, schema)
        for _, stage in corpus_pipeline.STAGES:
            docs = stage(spark, docs, SF)
        assert docs.count() == (3 if data else 0)


def test_near_duplicates_lose_no_other_text(spark):
    """Different documents with one id, map columns, copies under several ids, and a very long text."""
    long = " ".join(f"w{i}" for i in range(60_000))
    rows = [(5, "one text about rivers and hills and roads", {"a": 1}), (5, "another text about birds and trees and seas", None),
            (5, "another text about birds and trees and seas", {}), (4, "one text about rivers and hills and roads", {"b": 2}),
            (9, long, {}), (8, long + " end", {}), (None, long, {}), (7, None, {}), (7, "", {})]
    docs = spark.createDataFrame(rows, "doc_id long, text string, marks map<string,int>").repartition(3)
    kept = corpus_pipeline.near_duplicates(spark, docs, SF)
    assert kept.dtypes == docs.dtypes
    got = sorted(((r["doc_id"] or 0), (r["text"] or "")[-4:]) for r in kept.collect())
    assert got == sorted([(5, "seas"), (4, "oads"), (8, " end"), (0, "9999"), (7, ""), (7, "")])


def test_workers_get_small_batches(spark):
    """A task's texts don't go to its worker at once, whichever stage is called first; a smaller bound stays."""
    setting = "spark.sql.execution.arrow.maxBytesPerBatch"
    docs = spark.range(8000, numPartitions=1).select(F.col("id").alias("doc_id"), F.repeat(F.lit("some text "), 300).alias("text"))

    def sizes(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([batch.nbytes]), pa.array([batch.num_rows])], names=["size", "rows"])

    for name, stage in corpus_pipeline.STAGES:
        if name in ("decontamination", "pieces"):
            spark.conf.unset(setting)
            stage(spark, docs, SF)
            found = docs.mapInArrow(sizes, "size long, rows long").collect()
            assert sum(r["rows"] for r in found) == 8000
            assert max(r["size"] for r in found) < 3 << 20
    spark.conf.set(setting, "100k")
    corpus_pipeline.STAGES[-1][1](spark, docs, SF)
    assert spark.conf.get(setting) == "100k"
    spark.conf.unset(setting)
