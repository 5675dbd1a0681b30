"""Benchmark decontamination by winnowing.

Words are hashed, k-word grams are combined from them, and of every ``w``
consecutive grams the smallest is kept as fingerprint (k + w - 1 = 13), so
any shared span of 13 words shares a fingerprint.  Documents are scanned for
the benchmark's fingerprints; each hit is extended over the 13-word windows
around it, which are found by a hash of all their words and then compared word
for word.  Items shorter than a window are one window of their own length.

The benchmark's fingerprints and windows go to the tasks in blocks of at most
``block_windows`` windows (a stated query set against all rows).  With several
blocks the documents are first written with a row number; each block then
returns the hits of its rows only, and those of a row meet in one aggregation.

Defined edge cases: null or empty texts have no words, no hits, and are not
contaminated; repeated or null doc_ids are judged by row; null or wordless items
are left out, and repeated items count once; equal windows of several items hit
for each of them; an empty benchmark contaminates nothing and an empty table
gives an empty result.  Extra columns, of any type and name, are ignored by
``decontaminate`` and kept by ``drop_contaminated``.
"""

from __future__ import annotations

import functools
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType, StringType, StructType

from corpusloom.llm.common import free_names, materialize, table

WINDOW = 13
GRAM = 5
BLOCK_WINDOWS = 250_000
WORD = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
MUL = np.uint64(0x9E3779B97F4A7C15)
MIX = np.uint64(0xBF58476D1CE4E5B9)


def words_of(value: pa.Scalar) -> list[bytes]:
    """The words of a text, A-Z lower-cased; none of a null."""
    return WORD.findall(value.as_buffer().to_pybytes().lower()) if value.is_valid else []


def word_hashes(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(_word_hash, words), np.uint64, len(words))


@functools.lru_cache(maxsize=1 << 18)
def _word_hash(word: bytes) -> int:
    return xxhash.xxh3_64_intdigest(word)


def _stir(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * MIX
    return x ^ (x >> np.uint64(29))


def _start(k: int) -> np.uint64:
    return np.uint64(k * int(MIX) & 0xFFFFFFFFFFFFFFFF)


def gram_hashes(words: np.ndarray, k: int) -> np.ndarray:
    """Hash of each run of k words; empty if there are fewer."""
    n = len(words) - k + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    h = np.full(n, _start(k), np.uint64)
    for j in range(k):
        h = _stir(h * MUL + words[j : j + n])
    return h


def _sliding(values: np.ndarray, w: int, pick) -> np.ndarray:
    size, out = 1, values
    while size * 2 <= w:
        out = pick(out[:-size], out[size:])
        size *= 2
    return pick(out[: len(out) - (w - size)], out[w - size :]) if w > size else out


def winnow(grams: np.ndarray, w: int) -> np.ndarray:
    """Positions of the grams that are smallest in some window of w grams (all equals of them)."""
    if not len(grams):
        return np.empty(0, np.int64)
    w = min(w, len(grams))
    edge = np.zeros(w - 1, np.uint64)
    lows = np.concatenate([edge, _sliding(grams, w, np.minimum), edge])
    return np.flatnonzero(_sliding(lows, w, np.maximum) == grams)


def benchmark_windows(bench: DataFrame, window: int = WINDOW, gram: int = GRAM) -> DataFrame:
    """(item_id, words, length, print): each distinct window of each item, its words joined by blanks, and the fingerprint it selects."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ids, joined, lens, prints = [], [], [], []
            for item, t in zip(b.column(0).to_pylist(), b.column(1)):
                words = words_of(t)
                n = min(window, len(words))
                grams = gram_hashes(word_hashes(words), gram)
                for s in range(len(words) - n + 1 if n else 0):
                    ids.append(item)
                    joined.append(b" ".join(words[s : s + n]))
                    lens.append(n)
                    prints.append(int(grams[s : s + n - gram + 1].min().view(np.int64)) if n == window else None)
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.string()), pa.array(joined, pa.binary()), pa.array(lens, pa.int32()), pa.array(prints, pa.int64())], names=["item_id", "words", "length", "print"])

    items = bench.select(F.col("item_id").cast("string"), F.col("text").cast("string"))
    return items.mapInArrow(cut, "item_id string, words binary, length int, print long").distinct()


class Windows:
    """A block of benchmark windows as flat arrays: per length the sorted hashes and the windows they stand for."""

    def __init__(self, known: pa.Table) -> None:
        self.prints = np.unique(known["print"].drop_null().to_numpy())
        self.words, self.items = known["words"].combine_chunks(), known["item_id"].combine_chunks()
        lengths = known["length"].to_numpy()
        hashes = np.fromiter((int(gram_hashes(word_hashes(w.as_py().split(b" ")), n)[0]) for w, n in zip(self.words, lengths.tolist())), np.uint64, len(lengths))
        self.by_length: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        for n in np.unique(lengths).tolist():
            own = np.flatnonzero(lengths == n)
            own = own[np.argsort(hashes[own], kind="stable")]
            self.by_length[n] = (hashes[own], own)

    def confirmed(self, words: list[bytes], starts: np.ndarray, hashes: np.ndarray, n: int) -> Iterator[tuple[int, int, list[int]]]:
        """(start, n, windows) of the places whose words are those of a window."""
        known, own = self.by_length[n]
        lo, hi = np.searchsorted(known, hashes, "left"), np.searchsorted(known, hashes, "right")
        for i in np.flatnonzero(hi > lo).tolist():
            text = b" ".join(words[starts[i] : starts[i] + n])
            same = [int(w) for w in own[lo[i] : hi[i]] if self.words[w].as_py() == text]
            if same:
                yield int(starts[i]), n, same

    def hits(self, words: list[bytes], window: int, gram: int) -> Iterator[tuple[int, int, list[int]]]:
        """(start, length, windows) of every benchmark window that occurs in a document."""
        h = word_hashes(words)
        for n in self.by_length:
            if len(h) < n:
                continue
            if n < window:
                yield from self.confirmed(words, np.arange(len(h) - n + 1), gram_hashes(h, n), n)
                continue
            grams = gram_hashes(h, gram)
            at = winnow(grams, window - gram + 1)
            at = at[_isin(grams[at].view(np.int64), self.prints)]
            starts = np.unique((at[:, None] - np.arange(window - gram + 1)[None, :]).ravel())
            starts = starts[(starts >= 0) & (starts <= len(h) - window)]
            whole = np.full(len(starts), _start(window), np.uint64)
            for j in range(window):
                whole = _stir(whole * MUL + h[starts + j])
            yield from self.confirmed(words, starts, whole, n)


def _isin(values: np.ndarray, table_: np.ndarray) -> np.ndarray:
    if not len(table_) or not len(values):
        return np.zeros(len(values), bool)
    at = np.searchsorted(table_, values)
    at[at == len(table_)] = 0
    return table_[at] == values


def covered(spans: list[tuple[int, int]]) -> int:
    """Number of words inside the (start, length) spans."""
    end = total = 0
    for s, n in sorted(spans):
        total += max(0, s + n - max(end, s))
        end = max(end, s + n)
    return total


VERDICT = StructType().add("n_words", LongType()).add("n_hit", LongType()).add("item_ids", ArrayType(StringType()))
SPANS = pa.list_(pa.struct([("s", pa.int64()), ("n", pa.int64())]))


def block_of(known: DataFrame, block: int, blocks: int) -> Windows:
    """One bounded block of the benchmark's windows, on the driver to be broadcast."""
    own = known.filter(F.pmod(F.xxhash64("words", "item_id"), F.lit(blocks)) == block)
    return Windows(own.select("item_id", "words", "length", "print").toArrow())


def scan_documents(docs: DataFrame, bench: DataFrame, window: int = WINDOW, gram: int = GRAM, block_windows: int = BLOCK_WINDOWS) -> DataFrame:
    """``docs`` with n_words, n_hit and item_ids (sorted as strings), instead of columns of those names; one scan for a benchmark of one block."""
    base = docs.drop(*VERDICT.names)
    known = materialize(benchmark_windows(bench, window, gram), "windows")
    blocks = max(1, -(-known.count() // block_windows))
    at, sc = base.columns.index("text"), docs.sparkSession.sparkContext

    def judge(windows: Windows, value: pa.Scalar) -> tuple[int, list[tuple[int, int]], set[str]]:
        words = words_of(value)
        found = list(windows.hits(words, window, gram))
        return len(words), [(s, n) for s, n, _ in found], {windows.items[w].as_py() for w in {w for *_, ws in found for w in ws}}

    if blocks == 1:
        sent = sc.broadcast(block_of(known, 0, 1))

        def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                rows = [judge(sent.value, t) for t in b.column(at)]
                cols = [pa.array([r[0] for r in rows], pa.int64()), pa.array([covered(r[1]) for r in rows], pa.int64()), pa.array([sorted(r[2]) for r in rows], pa.list_(pa.string()))]
                yield pa.RecordBatch.from_arrays([*b.columns, *cols], names=[*b.schema.names, *VERDICT.names])

        return base.mapInArrow(scan, StructType([*base.schema.fields, *VERDICT.fields]))

    (row,) = free_names(base, "_row")
    numbered = materialize(base.withColumn(row, F.monotonically_increasing_id()), "rows")
    found: DataFrame | None = None
    for k in range(blocks):
        sent_k = sc.broadcast(block_of(known, k, blocks))

        def scan_block(batches: Iterator[pa.RecordBatch], sent=sent_k, first=k == 0) -> Iterator[pa.RecordBatch]:
            for b in batches:
                rows = [(i, *judge(sent.value, t)) for i, t in zip(b.column(0).to_pylist(), b.column(1))]
                rows = [r for r in rows if first or r[2]]
                cols = [pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.int64()), pa.array([[{"s": s, "n": n} for s, n in r[2]] for r in rows], SPANS), pa.array([sorted(r[3]) for r in rows], pa.list_(pa.string()))]
                yield pa.RecordBatch.from_arrays(cols, names=[row, "n_words", "spans", "item_ids"])

        one = numbered.select(row, "text").mapInArrow(scan_block, f"`{row}` long, n_words long, spans array<struct<s:long,n:long>>, item_ids array<string>")
        found = one if found is None else found.unionByName(one)
    zero = F.struct(F.lit(0).cast("long").alias("end"), F.lit(0).cast("long").alias("total"))

    def step(a: Column, x: Column) -> Column:
        stop = x["s"] + x["n"]
        return F.struct(F.greatest(a["end"], stop).alias("end"), (a["total"] + F.greatest(F.lit(0).cast("long"), stop - F.greatest(a["end"], x["s"]))).alias("total"))

    lists = lambda c: F.array_distinct(F.flatten(F.collect_list(c)))  # noqa: E731  bounded by the document
    merged = found.groupBy(row).agg(F.max("n_words").alias("n_words"), F.sort_array(lists("spans")).alias("_spans"), F.sort_array(lists("item_ids")).alias("item_ids"))
    merged = merged.select(row, "n_words", F.aggregate("_spans", zero, step, lambda a: a["total"]).alias("n_hit"), "item_ids")
    return numbered.join(merged, row).drop(row)


def is_contaminated() -> Column:
    """At least a twentieth of the words is hit."""
    return (F.col("n_hit") > 0) & (F.lit(20) * F.col("n_hit") >= F.col("n_words"))


def decontaminate(docs: DataFrame, bench: DataFrame, window: int = WINDOW, gram: int = GRAM, block_windows: int = BLOCK_WINDOWS) -> DataFrame:
    """One row per document: doc_id, n_words, n_hit, item_ids (sorted as strings), contaminated."""
    texts = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    judged = scan_documents(texts, bench, window, gram, block_windows).drop("text")
    return judged.withColumn("contaminated", is_contaminated())


def drop_contaminated(docs: DataFrame, bench: DataFrame, window: int = WINDOW, gram: int = GRAM, block_windows: int = BLOCK_WINDOWS) -> DataFrame:
    """The documents that are not contaminated; columns as given."""
    plain = docs.select(*[F.col(f"`{c}`").alias("text" if c == "text" else f"_c{i}") for i, c in enumerate(docs.columns)])
    kept = scan_documents(plain, bench, window, gram, block_windows).filter(~is_contaminated())
    return kept.select(*[F.col("text" if c == "text" else f"_c{i}").alias(c) for i, c in enumerate(docs.columns)])


def op10_winnowing_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = decontaminate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return judged.select(
        "doc_id", "n_words", "n_hit", F.size("item_ids").cast("long").alias("n_items"),
        F.sha2(F.array_join("item_ids", ",").cast("binary"), 256).alias("items_sha256"), "contaminated",
    )


QUERIES = {"op10_winnowing_decontamination": op10_winnowing_decontamination}
ORACLES = {
    "op10_winnowing_decontamination": r"""
WITH dw AS (
  SELECT doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
bw AS (
  SELECT item_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
bi AS (SELECT item_id, w, least(13, len(w)) AS n FROM bw WHERE len(w) > 0),
win AS (SELECT DISTINCT item_id, n, array_to_string(w[s:s + n - 1], ' ') AS t FROM (SELECT item_id, w, n, unnest(range(1, len(w) - n + 2)) AS s FROM bi)),
lens AS (SELECT DISTINCT n FROM win),
dwin AS (SELECT doc_id, n, s, array_to_string(w[s:s + n - 1], ' ') AS t FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS s FROM dw, lens WHERE len(w) >= n)),
hit AS (SELECT doc_id, s, dwin.n, item_id FROM dwin JOIN win ON dwin.n = win.n AND dwin.t = win.t),
pos AS (SELECT doc_id, count(*) AS n_hit FROM (SELECT DISTINCT doc_id, unnest(range(s, s + n)) AS p FROM hit) GROUP BY doc_id),
items AS (SELECT doc_id, count(DISTINCT item_id) AS n_items, string_agg(DISTINCT item_id::VARCHAR, ',' ORDER BY item_id::VARCHAR) AS ids FROM hit GROUP BY doc_id)
SELECT dw.doc_id, coalesce(len(w), 0)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
  sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit > 0 AND 20 * n_hit >= len(w), false) AS contaminated
FROM dw LEFT JOIN pos ON pos.doc_id = dw.doc_id LEFT JOIN items ON items.doc_id = dw.doc_id"""
}
