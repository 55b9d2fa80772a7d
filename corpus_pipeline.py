"""The corpus pipeline: stages over the documents table, each a Parquet table the next one reads.

Every stage but the last returns the columns of its input in their order, whatever further columns
there are. Stages work on all rows; rows without a doc_id are judged like others, but are no one's copy.
"""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wireglean.llm import fm_index, jaccard_join, language, personal_data, piece_bpe
from wireglean.llm.common import Workspace, bound_batches, table


def _aside(docs: DataFrame) -> tuple[DataFrame, tuple[str, ...]]:
    """The table with doc_id and text under their names and all other columns under numbers, which clash with nothing."""
    names = [c if c in ("doc_id", "text") else f"_{i}" for i, c in enumerate(docs.columns)]
    return docs.toDF(*names), tuple(n for n in names if n.startswith("_"))


def _restored(rows: DataFrame, docs: DataFrame) -> DataFrame:
    names = [c if c in ("doc_id", "text") else f"_{i}" for i, c in enumerate(docs.columns)]
    return rows.select(*names).toDF(*docs.columns)


def languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is clear; null texts, texts without a letter and narrow decisions go.

    Each row is judged by its text alone, so equal rows stay or go together; an empty table gives an empty one.
    """
    plain, others = _aside(docs)
    found = language.identify(plain, language.fit_on_documents(docs), carry=others)
    return _restored(found.where(~F.col("rejected")), docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: the one with the smallest id (of rows with one id, any).

    Rows are told apart by numbers of their own, so different texts that share an id all stay. Rows without an id, and
    null or empty texts, are no one's copy and stay too. An empty table gives an empty one.
    """
    plain, _ = _aside(docs)
    ws = Workspace(spark, "near")
    rows = ws.settle(plain.withColumn("_row", F.monotonically_increasing_id()), "rows")
    found = jaccard_join.near_duplicates(rows.where("doc_id IS NOT NULL").select("_row", "text"), "_row")
    named = found.select("_row", F.col("component_id").alias("group")).join(rows.select("_row", "doc_id"), "_row")
    kept = named.groupBy("group").agg(F.min(F.struct("doc_id", "_row")).alias("first")).select("first._row")
    return _restored(rows.join(kept, "_row", "left_semi").unionByName(rows.where("doc_id IS NULL")), docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are not contaminated by the benchmark; documents with fewer hits stay as they are.

    Null and empty texts have no hits. An empty table on either side removes nothing.
    """
    plain, others = _aside(docs)
    found = fm_index.decontaminate(plain, table(spark, sf_dir, "benchmark"), carry=others)
    return _restored(found.where(~F.col("contaminated")), docs)


def personal(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with personal data masked; n_chars counts the masked text. Null texts stay null."""
    plain, others = _aside(docs)
    found = personal_data.find(plain, personal_data.fit(docs), carry=others).withColumn("text", F.col("masked"))
    if "n_chars" in docs.columns:
        place = f"_{docs.columns.index('n_chars')}"
        found = found.withColumn(place, F.length("text").cast(dict(found.dtypes)[place]))
    return _restored(found, docs)


def pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """SentencePiece ids of each text (null: none), and digests of the ids and of the text decoded from them."""
    coded = piece_bpe.encode(docs)
    return coded.select(
        "doc_id", "ids", F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"))


def _bounded(stage):
    """The stage with bounded batches: the stages share executors, whose memory goes back late if at all."""

    def bounded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        bound_batches(spark)
        return stage(spark, docs, sf_dir)

    return bounded


STAGES = [(name, _bounded(stage)) for name, stage in (
    ("language", languages), ("near_duplicates", near_duplicates), ("decontamination", decontamination),
    ("personal_data", personal), ("pieces", pieces))]

#: Models decide in some stages, which SQL can't state; the tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, with a written table between each two."""
    ws = Workspace(spark, "pipeline")
    docs = table(spark, sf_dir, "documents")
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = ws.settle(docs, f"{i}-{name}")
            if i:
                ws.drop(f"{i - 1}-{STAGES[i - 1][0]}")
    return docs
