"""Language identification by compression.

For each language a raw-content zstandard dictionary holds sampled text. A text is cut into blocks
of one size, every block is compressed with each dictionary, and the language whose sum of sizes is
smallest wins. When the two smallest sums are too close, the prediction is rejected.
"""

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wireglean.llm.common import held, pick, query, slices, table, tidied

#: Sampled texts a language, and characters of each that go into its dictionary. These bound what
#: the driver gathers and every task receives: languages x DOCS x CHARS characters.
SAMPLE_DOCS, SAMPLE_CHARS = 256, 1024
#: More label values than this are taken for a wrong column.
MOST_LANGUAGES = 1000
BLOCK_BYTES = 2048
#: The search of level 3 remembers only the last place of a beginning, so it misses words that a large dictionary holds, which
#: tells most in texts of few words; this one looks at several.
LEVEL = 6
#: Smallest lead of the best sum over the second, as a share of the second, that is accepted.
NARROW = 0.004
#: A lead of this share counts as certain.
WIDE = 0.1
UNDETERMINED = "und"


def held_out(id_column: str | Column, folds: int, fold: int) -> Column:
    """Whether crc32 of the id as text leaves ``fold`` when divided by ``folds``; a null id is not held out."""
    name = F.col(id_column) if isinstance(id_column, str) else id_column
    return F.coalesce(F.crc32(name.cast("string").cast("binary")) % folds == fold, F.lit(False))


def fit(labelled: DataFrame, text_column: str = "text", lang_column: str = "lang",
        sample_docs: int = SAMPLE_DOCS, sample_chars: int = SAMPLE_CHARS) -> dict[str, bytes]:
    """A dictionary of sampled text for each language.

    The sample is bounded: of each language the ``sample_docs`` texts that come first by hash,
    ``sample_chars`` characters of each, most typical (smallest hash) last, where zstandard reaches
    them with the shortest offsets. Rows without label or letters teach nothing; without any
    labelled row there are no dictionaries and every prediction is undetermined.
    """
    rows = pick(labelled, text_column, lang_column).toDF("text", "lang").where(
        F.col("lang").isNotNull() & F.col("text").rlike(r"\p{L}"))
    counts = {r["lang"]: r["n"] for r in
              rows.groupBy("lang").agg(F.count("*").alias("n")).limit(MOST_LANGUAGES + 1).collect()}
    if len(counts) > MOST_LANGUAGES:
        raise ValueError(f"more than {MOST_LANGUAGES} languages")
    if not counts:
        return {}
    # Every row draws a number; a row below its language's rate is a candidate, so that about twice
    # the wanted rows are gathered whatever the size of the table.
    draw = (F.xxhash64("text", F.lit("sample")) / F.lit(float(2**63)) + 1) / 2
    rate = F.lit(0.0)
    for lang, n in counts.items():
        rate = F.when(F.col("lang") == lang, 2.0 * sample_docs / n + 32 / n).otherwise(rate)
    found = (rows.withColumn("draw", draw).where(F.col("draw") <= rate)
             .select("lang", "draw", F.substring("text", 1, sample_chars).alias("text")).distinct()
             .orderBy("draw", "lang", "text").limit(len(counts) * (3 * sample_docs + 64)).collect())
    texts: dict[str, list[str]] = {lang: [] for lang in counts}
    for r in found:
        if len(texts[r["lang"]]) < sample_docs:
            texts[r["lang"]].append(r["text"])
    return {lang: prepared("\n".join(reversed(t))) for lang, t in texts.items() if t}


def prepared(text: str) -> bytes:
    """Lower case words of letters with one space between, so that sizes measure words alone."""
    return " ".join(_LETTERS.findall(text.lower())).encode("utf-8", "replace")


_LETTERS = re.compile(r"[^\W\d_]+")


def _compressors(model: tuple[tuple[str, bytes], ...]):
    return held(("zstandard", model), lambda: _make_compressors(model))


def _make_compressors(model: tuple[tuple[str, bytes], ...]):
    import zstandard

    made = []
    for lang, content in model:
        words = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        words.precompute_compress(level=LEVEL)
        made.append((lang, zstandard.ZstdCompressor(level=LEVEL, dict_data=words, write_checksum=False,
                                                    write_content_size=False, write_dict_id=False)))
    return made


def classify(text: str | None, model: tuple[tuple[str, bytes], ...]) -> tuple[str, float, bool]:
    """(language, score, rejected) of one whole text."""
    body = prepared(text or "")
    if not model or not any(map(str.isalpha, text or "")):
        return UNDETERMINED, 0.0, True
    blocks = [body[i:i + BLOCK_BYTES] for i in range(0, len(body), BLOCK_BYTES)]
    sizes = {lang: sum(len(c.compress(b)) for b in blocks) for lang, c in _compressors(model)}
    if len(sizes) == 1:
        return model[0][0], 1.0, False
    (least, lang), (second, _) = sorted((size, lang) for lang, size in sizes.items())[:2]
    lead = (second - least) / second
    return lang, min(1.0, 0.5 + lead / WIDE / 2), lead < NARROW


def identify(docs: DataFrame, model: dict[str, bytes], id_column: str = "doc_id", text_column: str = "text",
             carry: tuple[str, ...] = ()) -> DataFrame:
    """(id, text, carried columns, lang_pred, lang_score, rejected) of every whole text.

    Null texts and texts without a letter are undetermined, rejected and score 0. Other texts get
    the language of the smallest sum (equal sums: the one first by name), and are rejected when the
    lead is narrow. Equal rows give equal rows; an empty table gives an empty one. One pass, no shuffle.
    """
    rows = pick(docs, id_column, text_column, *carry)
    fitted = tuple(sorted(model.items()))
    schema = ", ".join([*(f"`{c}` {t}" for c, t in rows.dtypes), "lang_pred string, lang_score double, rejected boolean"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, text_column):
                found = [classify(t, fitted) for t in part.column(text_column).to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [*part.columns, pa.array([f[0] for f in found], pa.string()),
                     pa.array([f[1] for f in found], pa.float64()), pa.array([f[2] for f in found], pa.bool_())],
                    names=[*part.schema.names, "lang_pred", "lang_score", "rejected"])

    return rows.mapInArrow(tidied(run), schema)


def fit_on_documents(docs: DataFrame) -> dict[str, bytes]:
    """Dictionaries from the rows of the documents table that are not held out."""
    return fit(pick(docs, "doc_id", "text", "lang").where(~held_out("doc_id", 5, 0)))


@query("op8_language")
def op8_language(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    return identify(docs, fit_on_documents(docs)).select(
        "doc_id", held_out("doc_id", 5, 0).alias("held_out"), "lang_pred", F.col("lang_score").alias("score"),
        "rejected")
