"""Ranked lexical search with the Best Position Algorithm over impact lists.

A task takes its documents shard by shard. For each query term a shard has an impact list: the documents
with the term, highest contribution first. A query reads its lists downwards together; each document that
comes up is looked up in all other lists at once (direct access), and its places there are marked as seen.
The best position of a list ends its unbroken run of seen places, so it lies at or beyond the place read
last; no document that is still unseen can score more than the sum of the contributions at the best
positions. Reading stops when that sum is strictly below the k-th score, so ties are never lost. The k-th
score is carried from shard to shard of a task, and the tasks' k best documents meet in one ranking.
"""

import heapq
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from wireglean.llm.common import Workspace, gathered, held, parquet_batches, pick, query, runs, strings, table, tidied
from wireglean.llm.fm_index import joined

#: Text that makes a shard.
SHARD_BYTES = 24 << 20
#: Query terms (with repeats over queries) of one block of queries: a task holds one block at a time.
BLOCK_TERMS = 200_000
#: Places that are read from each list at once, at first; they double up to the second number.
STEP, MOST_STEP = 16, 256

_IN_TERM = np.zeros(256, bool)
for _a, _b in ((0x30, 0x39), (0x41, 0x5A), (0x61, 0x7A), (0x80, 0xFF)):
    _IN_TERM[_a:_b + 1] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 32


def terms(texts: list[str | None]) -> tuple[pa.StringArray, np.ndarray]:
    """(term, text it stands in) of all terms, in order."""
    data, begin = joined(texts)
    inside = _IN_TERM[data]
    start, end = runs(inside)
    return strings(_LOWER[data[inside]], end - start), np.searchsorted(begin, start, "right") - 1


class Block:
    """Some queries: their distinct terms, and the terms of each query as numbers of these."""

    def __init__(self, path: str, block: int):
        terms_, queries, counts = [], [], []
        for batch in parquet_batches(f"{path}/block={block}", 100_000):
            terms_ += batch.column("term").to_pylist()
            queries += batch.column("queries").to_pylist()
            counts += batch.column("df").to_pylist() if "df" in batch.schema.names else []
        order = sorted(range(len(terms_)), key=terms_.__getitem__)
        self.terms = pa.array([terms_[i] for i in order], pa.string())
        self.counts = [counts[i] for i in order] if counts else []
        self.queries: dict[int, list[int]] = {}
        for t, i in enumerate(order):
            for q in queries[i]:
                self.queries.setdefault(q, []).append(t)

    def weights(self, n_docs: int) -> np.ndarray:
        return np.array([math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1))) for df in self.counts], np.int64)

    def occurrences(self, words: pa.StringArray, doc: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(document, term, how often), ordered by document and term."""
        number = pa.compute.index_in(words, self.terms)
        known = np.asarray(number.is_valid())
        number = np.asarray(number.fill_null(0))[known].astype(np.int64)
        both, n = np.unique(doc[known] * max(1, len(self.terms)) + number, return_counts=True)
        return both // max(1, len(self.terms)), both % max(1, len(self.terms)), n.astype(np.int64)


class ImpactLists:
    """One list a term: documents by falling impact, and for direct access the place of each document."""

    def __init__(self, n_terms: int, doc: np.ndarray, term: np.ndarray, impact: np.ndarray):
        order = np.lexsort((doc, -impact, term))
        self.doc, self.impact = doc[order], impact[order]
        self.ends = np.searchsorted(term[order], np.arange(n_terms + 1))
        by_doc = np.lexsort((doc, term))
        place = np.empty(len(order), np.int64)
        place[order] = np.arange(len(order))
        self.sorted_doc, self.place = doc[by_doc], place[by_doc]

    def of(self, term: int):
        """(documents, impacts, documents in order, their places) of a term."""
        a, b = self.ends[term], self.ends[term + 1]
        return self.doc[a:b], self.impact[a:b], self.sorted_doc[a:b], self.place[a:b] - a


def best_position_search(lists: list, n_docs: int, k: int, best: list, key) -> int:
    """Update ``best``, a heap of at most k (score, reversed key, id); returns the number of documents looked up.

    ``key(doc)`` gives (reversed order key, id): of equal scores the document with the larger reversed key stays.
    """
    lists = [one for one in lists if len(one[0])]
    seen = [np.zeros(len(one[0]) + 1, bool) for one in lists]  # the last one stays unseen
    position = [0] * len(lists)
    known = np.zeros(n_docs, bool)
    read, step, looked_up = 0, STEP, 0
    while lists:
        reads = np.unique(np.concatenate([docs[read:read + step] for docs, *_ in lists]))
        new = reads[~known[reads]]
        known[new] = True
        looked_up += len(new)
        score = np.zeros(len(new), np.int64)
        for (_, impact, ordered, place), mark in zip(lists, seen):
            at = np.minimum(np.searchsorted(ordered, new), len(ordered) - 1)
            has = ordered[at] == new
            places = place[at[has]]
            mark[places] = True
            score[has] += impact[places]
        least = best[0][0] if len(best) == k else 1
        for i in np.flatnonzero(score >= least).tolist():
            entry = (int(score[i]), *key(int(new[i])))
            if len(best) < k:
                heapq.heappush(best, entry)
            elif entry[:2] > best[0][:2]:
                heapq.heapreplace(best, entry)
        bound, left = 0, False
        for j, ((docs, impact, *_), mark) in enumerate(zip(lists, seen)):
            position[j] += int(np.argmin(mark[position[j]:]))  # the first unseen place
            if position[j] < len(docs):
                left = True
                bound += int(impact[max(position[j] - 1, 0)])
        if not left or len(best) == k and bound < best[0][0] or bound <= 0:
            break
        read, step = read + step, min(2 * step, MOST_STEP)
    return looked_up


class _Reversed:
    """An id in reversed order; null stands behind all ids."""

    __slots__ = ("value",)

    def __init__(self, value):
        self.value = value

    def __lt__(self, other):
        if self.value is None or other.value is None:
            return self.value is None and other.value is not None
        return other.value < self.value

    def __gt__(self, other):
        return other < self

    def __eq__(self, other):
        return self.value == other.value


def search(docs: DataFrame, queries: DataFrame, k: int = 10, id_column: str = "doc_id", text_column: str = "text",
           item_column: str = "item_id", item_text: str = "text") -> DataFrame:
    """(item, rank, id, score): the k documents with the highest score above 0 for each item, over all documents.

    Equal scores go by ascending id (null last). Null and empty texts have no terms: they are never found, and as
    items find nothing. Rows of one item id are one item with the terms of all its rows, also for a null id. Every
    document row is a document of its own, whatever its id. Empty tables give no rows. Scores are 64-bit integers;
    ids may be numbers or strings. Queries are held in blocks of bounded size, documents are not shuffled.
    """
    spark = docs.sparkSession
    ws = Workspace(spark, "search")
    items = pick(queries, item_column, item_text).toDF("item", "text").withColumn("text", F.col("text").cast("string"))

    def spell(batches):
        for batch in batches:
            words, row = terms(batch.column("text").to_pylist())
            found = pa.table({"item": batch.column("item").take(pa.array(row)), "term": words})
            yield from found.group_by(["item", "term"]).aggregate([]).select(["item", "term"]).to_batches()

    kind = dict(items.dtypes)["item"]
    wanted = ws.settle(items.mapInArrow(spell, f"item {kind}, term string").distinct(), "wanted")
    blocks = wanted.count() // BLOCK_TERMS + 1
    # Queries are numbered once, on storage; a block holds some of them with all their terms.
    numbers = ws.settle(wanted.select("item").distinct().select("item", F.monotonically_increasing_id().alias("query"))
                        .withColumn("block", F.expr(f"pmod(xxhash64(query), {blocks})")), "numbers")
    by_term = (wanted.join(numbers, wanted["item"].eqNullSafe(numbers["item"])).groupBy("block", "term")
               .agg(F.collect_list("query").alias("queries")))
    by_term.write.partitionBy("block").parquet(f"{ws.folder}/terms")
    used = sorted(r[0] for r in numbers.select("block").distinct().collect())  # of which there are few
    rows = pick(docs, id_column, text_column).toDF("id", "text").withColumn("text", F.col("text").cast("string"))
    terms_path, weighed_path = f"{ws.folder}/terms", f"{ws.folder}/weighed"

    def count(batches):
        n_docs = n_terms = 0
        for batch in gathered(batches, "text", SHARD_BYTES):
            words, doc = terms(batch.column("text").to_pylist())
            n_docs += len(np.unique(doc))
            n_terms += len(words)
            for block in used:
                own = held(("terms", terms_path, block), lambda: Block(terms_path, block), 2)
                _, term, _ = own.occurrences(words, doc)
                here, df = np.unique(term, return_counts=True)
                yield pa.RecordBatch.from_pydict({"block": pa.array([block] * len(here), pa.int32()),
                                                  "term": own.terms.take(pa.array(here)), "n": pa.array(df, pa.int64())})
        yield pa.RecordBatch.from_pydict({"block": pa.array([-1, -1], pa.int32()), "term": ["documents", "terms"],
                                          "n": pa.array([n_docs, n_terms], pa.int64())})

    counts = ws.settle(rows.mapInArrow(tidied(count), "block int, term string, n long")
                       .groupBy("block", "term").agg(F.sum("n").alias("df")), "counts")
    totals = {r["term"]: r["df"] for r in counts.where("block = -1").collect()}
    n_docs, n_terms = totals.get("documents", 0), max(1, totals.get("terms", 0))
    stored = spark.read.schema("term string, queries array<long>, block int").parquet(terms_path)
    (stored.join(counts, ["block", "term"], "left").fillna({"df": 0})
     .write.partitionBy("block").parquet(weighed_path))

    def rank(batches):
        best: dict[int, list] = {}
        for batch in gathered(batches, "text", SHARD_BYTES):
            words, doc = terms(batch.column("text").to_pylist())
            ids = batch.column("id")
            size = np.bincount(doc, minlength=batch.num_rows)
            if len(size) and int(size.max()) * n_docs < (1 << 63) // 90:
                m = 10 + 90 * size * n_docs // n_terms
            else:  # beyond 64 bits on the way
                m = np.array([10 + 90 * n * n_docs // n_terms for n in size.tolist()], np.int64)
            for block in used:
                own = held(("weighed", weighed_path, block), lambda: Block(weighed_path, block), 2)
                where, term, tf = own.occurrences(words, doc)
                impact = own.weights(n_docs)[term] * (1_000_000_000 * tf // (1000 * tf + 8 * m[where]))
                index = ImpactLists(len(own.terms), where, term, impact)
                for q, asked in own.queries.items():
                    best_position_search([index.of(t) for t in asked], batch.num_rows, k, best.setdefault(q, []),
                                         lambda d: (_Reversed(v := ids[d].as_py()), v))
        found = [(q, d, s) for q, heap in best.items() for s, _, d in heap]
        yield pa.RecordBatch.from_pydict({"query": pa.array([f[0] for f in found], pa.int64()),
                                          "id": pa.array([f[1] for f in found], id_type),
                                          "score": pa.array([f[2] for f in found], pa.int64())})

    id_kind, id_type = dict(rows.dtypes)["id"], to_arrow_type(rows.schema["id"].dataType)

    order = Window.partitionBy("query").orderBy(F.desc("score"), F.asc_nulls_last("id"))
    found = rows.mapInArrow(tidied(rank), f"query long, id {id_kind}, score long")
    top = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return top.join(numbers, "query").select(F.col("item").alias(item_column), "rank", F.col("id").alias(id_column), "score")


_SQL_TERMS = r"""regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"""

_SQL = f"""
WITH d AS (SELECT doc_id, {_SQL_TERMS} AS w FROM documents),
total AS (SELECT count(*) AS n_docs, sum(len(w))::BIGINT AS n_terms FROM d WHERE len(w) > 0),
q AS (SELECT DISTINCT item_id, unnest({_SQL_TERMS}) AS term FROM benchmark),
tf AS (SELECT doc_id, len(w) AS n, term, count(*) AS tf FROM (SELECT doc_id, w, unnest(w) AS term FROM d)
       WHERE term IN (SELECT term FROM q) GROUP BY doc_id, w, term),
df AS (SELECT term, count(*) AS df FROM tf GROUP BY term),
one AS (SELECT doc_id, term, floor(1000 * ln((2 * n_docs + 2)::DOUBLE / (2 * df + 1)))::BIGINT
            * ((1000000000 * tf) // (1000 * tf + 8 * (10 + (90 * n * n_docs) // n_terms))) AS part
        FROM tf JOIN df USING (term), total),
s AS (SELECT item_id, doc_id, sum(part)::BIGINT AS score FROM q JOIN one USING (term) GROUP BY ALL),
r AS (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id)::INTEGER AS rank FROM s WHERE score > 0)
SELECT item_id, rank, doc_id, score FROM r WHERE rank <= 10
"""


@query("op12_search", _SQL)
def op12_search(spark, sf_dir):
    return search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
