"""Ranked lexical search of a stated query set: term at a time, with limited accumulators.

Each task reads documents in blocks and holds, per block, the postings of the
queries' terms.  A query's terms are taken rarest first.  An accumulator is a
document of the block with a partial score; new ones are made only while the
bounds of the terms that remain can still lift a new document to the k-th best
partial score so far, be it of this block or of the task's earlier ones.  From
there on the survivors are updated exactly and nothing else is looked at.  What
a task's k best are is merged over all tasks, in two steps so that no query's
rows meet in one task while they are many.

Counts of all documents (N, L, and the document frequency of each term) come
from a scan before.  Queries go to the tasks in blocks of at most ``block_terms`` distinct
terms, a stated query set against all rows; each block scans the documents
again.  Terms are matched by 64-bit hashes of their bytes.

Defined edge cases: null, empty and wordless texts are no result and count in
nothing but the table; rows with repeated or null doc_ids are ranked each, null
after all ids among equal scores; items of one item_id, null included, are one query; items without a term
that occurs have no result; a term counts once in an item; an empty table on
either side gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import math
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from corpusloom.llm.common import materialize, table
from corpusloom.llm.wordscan import LETTERS, slices, words_of

TOP = 50
BLOCK_TERMS = 200_000
SALTS = 64
K1, B_PERCENT, SCALE = 1000, 50, 1_000_000_000  # fixed values of the score


def item_terms(items: DataFrame, item: str) -> DataFrame:
    """(item, term): the distinct terms of each item as hashes, in the order of items."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            words = words_of(b.column("text"), LETTERS, folded=True)
            row = np.repeat(np.arange(b.num_rows), np.diff(words.bounds))
            yield pa.RecordBatch.from_arrays([b.column("item").take(pa.array(row)), pa.array(words.hashes.view(np.int64))], names=["item", "term"])

    source = items.select(F.col(item).alias("item"), F.col("text").cast("string").alias("text"))
    kind = items.schema[item].dataType.simpleString()
    return source.mapInArrow(cut, f"item {kind}, term long").distinct()


class Postings:
    """Rows of a block: their lengths, and of the known terms (ranks in a sorted array) the rows and counts, term by term."""

    def __init__(self, vocabulary: np.ndarray, texts: pa.Array) -> None:
        words = words_of(texts, LETTERS, folded=True)
        self.lengths = np.diff(words.bounds)
        row = np.repeat(np.arange(len(self.lengths)), self.lengths)
        rank = np.minimum(np.searchsorted(vocabulary, words.hashes), max(len(vocabulary) - 1, 0))
        known = vocabulary[rank] == words.hashes if len(vocabulary) else np.zeros(len(row), bool)
        cells, self.counts = np.unique(rank[known].astype(np.int64) * max(len(self.lengths), 1) + row[known], return_counts=True)
        self.rows = cells % max(len(self.lengths), 1)
        self.begins = np.searchsorted(cells // max(len(self.lengths), 1), np.arange(len(vocabulary) + 1))


def corpus_counts(docs: DataFrame, vocabulary: np.ndarray) -> tuple[np.ndarray, int, int]:
    """(document frequencies along the vocabulary, documents with a term, terms with repeats)."""
    sent = docs.sparkSession.sparkContext.broadcast(vocabulary)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n, total = np.zeros(len(sent.value), np.int64), 0, 0
        for b in batches:
            for part in slices(b, "text"):
                found = Postings(sent.value, part.column("text"))
                held += np.diff(found.begins)
                n, total = n + int((found.lengths > 0).sum()), total + int(found.lengths.sum())
        at = np.flatnonzero(held)
        ranks, counts = [-2, -1, *at.tolist()], [n, total, *held[at].tolist()]
        yield pa.RecordBatch.from_arrays([pa.array(ranks, pa.int64()), pa.array(counts, pa.int64())], names=["rank", "n"])

    sums = docs.select(F.col("text").cast("string").alias("text")).mapInArrow(count, "rank long, n long").groupBy("rank").agg(F.sum("n").alias("n"))
    got = sums.toArrow()  # a row a term of the block
    known = dict(zip(got["rank"].to_pylist(), got["n"].to_pylist()))
    frequencies = np.array([known.get(i, 0) for i in range(len(vocabulary))], np.int64)
    return frequencies, known.get(-2, 0), known.get(-1, 0)


def term_weight(n: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * n + 2) / (2 * df + 1)))


class Best:
    """The k best (score, doc_id) seen of one query, equal scores by ascending doc_id."""

    def __init__(self, k: int) -> None:
        self.k, self.scores, self.ids, self.none = k, np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, bool)

    def add(self, scores: np.ndarray, ids: np.ndarray, none: np.ndarray) -> None:
        scores, ids, none = np.concatenate([self.scores, scores]), np.concatenate([self.ids, ids]), np.concatenate([self.none, none])
        keep = np.lexsort((ids, none, -scores))[: self.k]
        self.scores, self.ids, self.none = scores[keep], ids[keep], none[keep]


def search_block(found: Postings, scores: np.ndarray, tops: np.ndarray, terms: np.ndarray, best: Best, limited: bool = True) -> tuple[np.ndarray, np.ndarray]:
    """(rows, their exact scores) of a block that may be among the k best of a query.

    terms: the query's ranks, rarest first; scores: what each posting adds;
    tops: the most that any posting of a term in this block adds.
    """
    n, k = len(found.lengths), best.k
    partial = np.zeros(n, np.int64)
    left = np.concatenate([np.cumsum(tops[terms][::-1])[::-1], [0]])  # left[j]: what the terms from j on can add
    made = np.zeros(n, bool)
    for j, term in enumerate(terms.tolist()):
        lo, hi = found.begins[term], found.begins[term + 1]
        rows = found.rows[lo:hi]
        if limited and left[j] < max(left[0] - left[j], best.scores[-1] if len(best.scores) == k else 0):
            so_far = np.concatenate([partial[made], best.scores])
            if len(so_far) >= k and left[j] < np.partition(so_far, len(so_far) - k)[len(so_far) - k]:
                return _finish(found, scores, partial, np.flatnonzero(made), terms[j:])
        partial[rows] += scores[lo:hi]
        made[rows] = True
    rows = np.flatnonzero(made)
    return rows, partial[rows]


def _finish(found: Postings, scores: np.ndarray, partial: np.ndarray, survivors: np.ndarray, terms: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The survivors' exact scores: each is looked up in the postings of the remaining terms."""
    total = partial[survivors]
    for term in terms.tolist():
        lo, hi = int(found.begins[term]), int(found.begins[term + 1])
        if lo < hi and len(survivors):
            at = np.minimum(np.searchsorted(found.rows[lo:hi], survivors), hi - lo - 1)
            total += np.where(found.rows[lo:hi][at] == survivors, scores[lo:hi][at], 0)
    return survivors, total


def search(docs: DataFrame, items: DataFrame, item: str = "item_id", k: int = TOP, block_terms: int = BLOCK_TERMS, limited: bool = True) -> DataFrame:
    """(item, rank, doc_id, score): the k best documents of each item."""
    spark = docs.sparkSession
    asked = materialize(item_terms(items, item), "terms")
    kind = items.schema[item].dataType.simpleString()
    sizes = asked.groupBy("item").agg(F.count(F.lit(1)).alias("n"))
    blocks = max(1, -(-(sizes.agg(F.sum("n")).first()[0] or 0) // block_terms))
    source = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    found: DataFrame | None = None
    for block in range(blocks):
        own = asked.filter(F.pmod(F.xxhash64("item"), F.lit(blocks)) == block).toArrow()  # bounded by the block
        one = _ranked_in_tasks(spark, source, own, kind, k, limited)
        found = one if found is None else found.unionByName(one)
    order = [F.desc("score"), F.col("doc_id").asc_nulls_last()]
    for keys in (["item", "salt"], ["item"]):
        found = found.withColumn("rank", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).filter(F.col("rank") <= k)
    return found.select(F.col("item").alias(item), F.col("rank").cast("int").alias("rank"), "doc_id", "score")


def _ranked_in_tasks(spark: SparkSession, source: DataFrame, own: pa.Table, kind: str, k: int, limited: bool) -> DataFrame:
    """(item, score, doc_id, salt): of each item of a block the k best of each task."""
    hashes = own["term"].to_numpy().view(np.uint64)
    vocabulary = np.unique(hashes)
    frequencies, n, total = corpus_counts(source, vocabulary)
    names = own["item"].to_pylist()
    by_item: dict[object, list[int]] = defaultdict(list)
    for name, rank in zip(names, np.searchsorted(vocabulary, hashes).tolist()):
        if frequencies[rank]:
            by_item[name].append(rank)
    queries = [(name, np.array(sorted(ranks, key=lambda r: (frequencies[r], r)))) for name, ranks in by_item.items()]
    weights = np.array([term_weight(n, int(df)) for df in frequencies], np.int64)
    sent = spark.sparkContext.broadcast((vocabulary, weights, queries))
    arrow_kind = own.schema.field("item").type

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary, weights, queries = sent.value
        best = [Best(k) for _ in queries]
        for b in batches:
            for part in slices(b, "text"):
                found = Postings(vocabulary, part.column("text"))
                if not len(found.rows):
                    continue
                m = 100 - B_PERCENT + (B_PERCENT * found.lengths.astype(np.int64) * n) // total
                term = np.repeat(np.arange(len(vocabulary)), np.diff(found.begins))
                scores = weights[term] * ((SCALE * found.counts) // (K1 * found.counts + 20 * m[found.rows]))
                tops = np.zeros(len(vocabulary), np.int64)
                held = np.flatnonzero(np.diff(found.begins))
                tops[held] = np.maximum.reduceat(scores, found.begins[held])
                none = part.column("doc_id").is_null().to_numpy(zero_copy_only=False)
                ids = part.column("doc_id").fill_null(0).to_numpy()
                for (_, terms), one in zip(queries, best):
                    rows, exact = search_block(found, scores, tops, terms, one, limited)
                    rows, exact = rows[exact > 0], exact[exact > 0]
                    if len(one.scores) == k:
                        better = exact >= one.scores[-1]
                        rows, exact = rows[better], exact[better]
                    if len(rows):
                        one.add(exact, ids[rows], none[rows])
        out = [(name, int(s), None if x else int(i)) for (name, _), one in zip(queries, best) for s, i, x in zip(one.scores, one.ids, one.none)]
        yield pa.RecordBatch.from_arrays([pa.array([o[0] for o in out], arrow_kind), pa.array([o[1] for o in out], pa.int64()), pa.array([o[2] for o in out], pa.int64())], names=["item", "score", "doc_id"])

    got = source.mapInArrow(run, f"item {kind}, score long, doc_id long")
    return got.withColumn("salt", F.pmod(F.spark_partition_id(), F.lit(SALTS)))


def op11_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


QUERIES = {"op11_ranked_search": op11_ranked_search}
ORACLES = {
    "op11_ranked_search": r"""
WITH dw AS (SELECT row_number() OVER () AS row, doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS w FROM documents),
it AS (SELECT DISTINCT item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark),
c AS (SELECT count(*) FILTER (len(w) > 0)::BIGINT AS n_all, coalesce(sum(len(w)), 0)::BIGINT AS l_all FROM dw),
tf AS (SELECT row, doc_id, len(w)::BIGINT AS n, term, count(*)::BIGINT AS tf FROM (SELECT row, doc_id, w, unnest(w) AS term FROM dw) WHERE term IN (SELECT term FROM it) GROUP BY row, doc_id, w, term),
df AS (SELECT term, floor(1000 * ln((2 * n_all + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE))::BIGINT AS weight FROM tf, c GROUP BY term, n_all),
sc AS (SELECT item_id, row, doc_id, sum(weight * ((1000000000 * tf) // (1000 * tf + 20 * (100 - 50 + (50 * n * n_all) // l_all))))::BIGINT AS score
  FROM it JOIN tf USING (term) JOIN df USING (term), c GROUP BY item_id, row, doc_id)
SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id NULLS LAST)::INT AS rank, doc_id, score FROM sc WHERE score > 0
QUALIFY rank <= 50"""
}
