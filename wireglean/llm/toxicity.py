"""Toxicity from subword bags.

A word is the bag of its hashed character n-grams; the vectors of the bag are averaged, the words of a
short window are averaged, and a linear softmax turns the average into two classes. A text has the
score of its highest window, so that one toxic word in a long text is not averaged away. Vectors
and softmax are trained together in numpy on a bounded sample. A misspelling that training never
showed shares most n-grams, and so its vector, with the word it distorts.
"""

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wireglean.llm.common import pick, query, slices, table
from wireglean.llm.language import held_out

#: The training sample: at most so many clean and toxic texts, none longer than TEXT_CHARS.
SAMPLE_DOCS, TEXT_CHARS = (2500, 1500), 8_000
BUCKETS, DIMENSIONS = 1 << 16, 8
SHORTEST, LONGEST = 3, 6
WINDOW = 2
ROUNDS, RATE, DECAY = 40, 0.05, 1e-4
THRESHOLD = 0.3
_BASE = np.uint64(0x100000001B3)


def codes(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """(lower-case code points of all texts with a space behind each, where each begins and the end)."""
    lowered = [(t or "").lower() for t in texts]
    begin = np.cumsum([0, *(len(t) + 1 for t in lowered)])
    return np.frombuffer(" ".join([*lowered, ""]).encode("utf-32-le", "surrogatepass"), np.uint32), begin


def word_bounds(code: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and end place of the words: letters, digits, and single marks inside them."""
    core = (code > 127) & (code != 0xA0) | (code >= 48) & (code <= 57) | (code >= 97) & (code <= 122)
    mark = ~core & (code > 32) & (code < 127)
    inside = core.copy()
    inside[1:-1] |= mark[1:-1] & core[:-2] & core[2:]
    edge = np.flatnonzero(np.diff(np.r_[False, inside, False].view(np.int8)))
    return edge[::2], edge[1::2]


def grams(code: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(bucket, word number) of every n-gram of the words with their borders, and of the whole words."""
    length = end - start + 2
    place = np.cumsum(length) - length
    spelled = np.empty(int(length.sum()), np.uint64)
    word = np.repeat(np.arange(len(start), dtype=np.int32), length)
    inner = np.arange(len(spelled)) - place[word]
    spelled[place], spelled[place + length - 1] = 60, 62
    body = (inner > 0) & (inner < length[word] - 1)
    spelled[body] = code[(start[word] + inner - 1)[body]]
    left = length[word] - inner  # characters of the word from here on
    found, owner = [], []
    rolling = spelled.copy()
    for n in range(2, LONGEST + 1):
        rolling = rolling[:len(spelled) - n + 1] * _BASE + spelled[n - 1:]
        if n >= SHORTEST:
            whole = np.flatnonzero(left[:len(rolling)] >= n)
            found.append(rolling[whole] + np.uint64(n))
            owner.append(word[whole])
    weight = _BASE ** np.minimum(inner, 63).astype(np.uint64)
    found.append(np.add.reduceat(spelled * weight, place) * np.uint64(31) if len(place) else np.empty(0, np.uint64))
    owner.append(np.arange(len(start), dtype=np.int32))
    key = np.concatenate(found)
    key ^= key >> np.uint64(32)
    key *= np.uint64(0x9E3779B97F4A7C15)
    return (key >> np.uint64(40)).astype(np.int64) & (BUCKETS - 1), np.concatenate(owner)


@dataclass
class ToxicModel:
    """What scoring needs of a trained model: mean(vectors) . w equals mean(vectors . w)."""

    bucket: np.ndarray  # float32: the class difference that a bucket's vector adds
    bias: float
    prior: float

    def word_scores(self, code: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        out = np.empty(len(start))
        for i in range(0, len(start), 50_000):  # bounded memory, warm caches
            a, b = start[i:i + 50_000], end[i:i + 50_000]
            key, word = grams(code, a, b)
            n = np.bincount(word, minlength=len(a))
            out[i:i + 50_000] = np.bincount(word, weights=self.bucket[key], minlength=len(a)) / np.maximum(n, 1)
        return out

    def scores(self, texts: list[str | None]) -> np.ndarray:
        code, begin = codes(texts)
        start, end = word_bounds(code)
        doc = np.searchsorted(begin, start, "right") - 1
        out = np.full(len(texts), self.prior)
        if len(start):
            first = np.flatnonzero(np.r_[True, doc[1:] != doc[:-1]])
            z = window_means(self.word_scores(code, start, end), doc, first)
            out[doc[first]] = sigmoid(np.maximum.reduceat(z, first) + self.bias)
        return out


def sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -40, 40)))


def window_ends(doc: np.ndarray, first: np.ndarray) -> np.ndarray:
    """The end of the window that begins at each word; windows end with their document."""
    last = np.r_[first[1:], len(doc)]
    return np.minimum(np.arange(len(doc)) + WINDOW, np.repeat(last, np.diff(np.r_[first, len(doc)])))


def window_means(z: np.ndarray, doc: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Mean over the window that begins at each word, over WINDOW words even where fewer are left."""
    total = np.r_[0.0, np.cumsum(z)]
    return (total[window_ends(doc, first)] - total[:-1]) / WINDOW


def train(texts: list[str], toxic: list[int], prior: float) -> ToxicModel:
    """Vectors and softmax by Adam over whole passes; the top window carries each text's gradient.

    Early passes spread the gradient over all windows of a text, later ones sharpen to the highest.
    """
    code, begin = codes(texts)
    start, end = word_bounds(code)
    doc = np.searchsorted(begin, start, "right") - 1
    text = "".join(map(chr, code))
    spelled = [text[a:b] for a, b in zip(start, end)]
    known: dict[str, int] = {}
    number = np.array([known.setdefault(w, len(known)) for w in spelled])
    own = np.cumsum([0, *(len(w) + 1 for w in known)])
    words = np.frombuffer("\n".join([*known, ""]).encode("utf-32-le", "surrogatepass"), np.uint32)
    key, owner = grams(words, own[:-1], own[1:] - 1)
    order = np.argsort(owner, kind="stable")
    key, owner = key[order], owner[order]
    bag = np.flatnonzero(np.r_[True, owner[1:] != owner[:-1]])
    bag_size = np.diff(np.r_[bag, len(owner)])
    first = np.flatnonzero(np.r_[True, doc[1:] != doc[:-1]])
    sizes = np.diff(np.r_[first, len(doc)])
    label = np.array(toxic)[doc[first]].astype(float)
    weight = np.where(label > 0, 0.5 / max(label.sum(), 1), 0.5 / max((1 - label).sum(), 1))
    ends = window_ends(doc, first)
    draw = np.random.default_rng(7)
    vectors = draw.normal(0, 0.3, (BUCKETS, DIMENSIONS))
    w, bias = draw.normal(0, 0.3, DIMENSIONS), np.zeros(1)
    moments = [(np.zeros_like(p), np.zeros_like(p)) for p in (vectors, w, bias)]
    for step in range(1, ROUNDS + 1):
        sharp = min(1.0, step / (0.5 * ROUNDS)) * 6
        # One dimension at a time: the bags of all words times all dimensions would not fit a small driver.
        vector = np.stack([np.add.reduceat(vectors[key, d], bag) / bag_size for d in range(DIMENSIONS)], axis=1)
        z = window_means((vector @ w)[number], doc, first)
        top = np.repeat(np.maximum.reduceat(z, first), sizes)
        share = np.exp(sharp * (z - top))
        share /= np.repeat(np.add.reduceat(share, first), sizes)
        at = np.add.reduceat(share * z, first)
        error = (sigmoid(at + bias[0]) - label) * weight
        window = np.repeat(error, sizes) * share / WINDOW
        # A word gets what the windows over it get.
        change = np.zeros(len(doc) + 1)
        change[:-1] += window
        np.add.at(change, ends, -window)
        word = np.bincount(number, weights=np.cumsum(change)[:-1], minlength=len(known))
        of_w = vector.T @ word + DECAY * w
        spread = np.bincount(key, weights=np.repeat(word / bag_size, bag_size), minlength=BUCKETS)
        of_vectors = spread[:, None] * w + DECAY * 0.01 * vectors
        for p, g, (m, v) in zip((vectors, w, bias), (of_vectors, of_w, np.array([error.sum()])), moments):
            m *= 0.9
            m += 0.1 * g
            v *= 0.99
            v += 0.01 * g * g
            p -= RATE * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.99 ** step)) + 1e-8)
    return ToxicModel((vectors @ w).astype(np.float32), float(bias[0]), prior)


def fit(docs: DataFrame, labels: DataFrame, sample_docs: tuple[int, int] = SAMPLE_DOCS, id_column: str = "doc_id",
        text_column: str = "text", label_column: str = "toxic") -> ToxicModel:
    """A model from labelled texts, at most ``sample_docs`` clean and toxic ones, drawn by a hash of the id.

    The sample and with it everything that reaches the driver is bounded by ``sample_docs`` texts
    and ``TEXT_CHARS`` characters each. Null ids, labels and texts teach nothing. Without both classes
    every text gets the share of toxic labels as its score.
    """
    rows = pick(labels, id_column, label_column).toDF("id", "toxic").where("id IS NOT NULL AND toxic IN (0, 1)")
    counts = {r["toxic"]: r["count"] for r in rows.groupBy("toxic").count().collect()}
    prior = counts.get(1, 0) / max(1, sum(counts.values()))
    draw = (F.xxhash64("id", F.lit("toxic")) / F.lit(float(2**63)) + 1) / 2
    rates = [1.5 * n / max(1, counts.get(kind, 0)) for kind, n in enumerate(sample_docs)]
    rate = F.when(F.col("toxic") == 1, rates[1]).otherwise(rates[0])
    most = 2 * sum(sample_docs)
    drawn = rows.withColumn("draw", draw).where(F.col("draw") <= rate).distinct().limit(most)
    # The drawn ids are few by construction, so the documents are not shuffled for them.
    found = (pick(docs, id_column, text_column).toDF("id", "text").join(F.broadcast(drawn), "id")
             .where(F.length("text").between(1, TEXT_CHARS)).select("draw", "toxic", "text")
             .orderBy("draw", "toxic", "text").limit(most).collect())
    texts, toxic = [], []
    for kind in (0, 1):
        own = [r for r in found if r["toxic"] == kind][:sample_docs[kind]]
        texts += [r["text"] for r in own]
        toxic += [kind] * len(own)
    if len(set(toxic)) < 2:
        return ToxicModel(np.zeros(BUCKETS, np.float32), float(np.log((prior + 1e-9) / (1 - prior + 1e-9))), prior)
    return train(texts, toxic, prior)


def score(docs: DataFrame, model: ToxicModel, threshold: float = THRESHOLD, id_column: str = "doc_id",
          text_column: str = "text") -> DataFrame:
    """(id, toxic_score, toxic_pred) of every whole text; other columns are not carried.

    Null texts and texts without a word get the share of toxic training labels. Equal rows give equal
    rows; an empty table gives an empty one. One pass, no shuffle.
    """
    rows = pick(docs, id_column, text_column)
    schema = f"`{id_column}` {dict(rows.dtypes)[id_column]}, toxic_score double"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, text_column, 1 << 20):
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(model.scores(part.column(text_column).to_pylist()), pa.float64())],
                    names=[id_column, "toxic_score"])

    found = rows.mapInArrow(run, schema)
    return found.withColumn("toxic_pred", (F.col("toxic_score") >= threshold).cast("int"))


@query("op10_toxicity")
def op10_toxicity(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    model = fit(docs, table(spark, sf_dir, "labels").where(~held_out("doc_id", 4, 2)))
    return score(docs, model).select("doc_id", held_out("doc_id", 4, 2).alias("held_out"),
                                     F.col("toxic_score").alias("score"), F.col("toxic_pred").alias("predicted"))
