"""Maximal periodic runs of words by scale-tiled search.

A run is a maximal stretch of words with smallest period q that is at least
max(LEAST, FOLD * q) words long.  Periods are searched by octave: octave k has
the periods 2**k to 2**(k+1) - 1 and cuts a text into overlapping tiles with a
boundary every 2**(k+1) words.  A run of the octave has a boundary c from which
2**k words recur q words on; tiles without such a recurrence end there.  For the others the Z-function of what
follows c, and that of what stands before it read backwards, tell for every
period how far it reaches to both sides within the tile.  What they tell is a
fragment (row, period, start, end), known to this tile alone.  Words are compared as
they are; hashes only pick the tiles.  Fragments are shuffled by row and period
and stitched: two that share a period's length of words are one stretch.  Stretches that are long enough are the runs.

Only rows that have fragments carry their text past the first pass, for the
collapse; a long text is one row, and its tiles are solved one after another.

Defined edge cases: null, empty and wordless texts have no runs and collapse
to the empty text; a null doc_id counts as the text "null" in ``planted``; rows are judged singly, so repeated rows and doc_ids have each their result;
an empty table gives an empty result; extra columns are ignored by
``periodic_runs``, whatever their names.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from corpusloom.llm.common import materialize, table
from corpusloom.llm.wordscan import MUL, SPACED, mixed, slices, words_of

LEAST, FOLD = 6, 4
CELLS = 1 << 20  # compared at once
#: Places of the words of a row (doc_id, number of words) as they are to be judged; None leaves them.
Change = Callable[[int | None, int], np.ndarray | None]
FRAGMENTS = "array<struct<period:long,start:long,end:long>>"


def z_function(words: list) -> list[int]:
    """z[i]: how many items from i on equal those from the start on; z[0] is the length."""
    n = len(words)
    z, lo, hi = [0] * n, 0, 0
    for i in range(1, n):
        k = min(hi - i, z[i - lo]) if i < hi else 0
        while i + k < n and words[k] == words[i + k]:
            k += 1
        z[i] = k
        if i + k > hi:
            lo, hi = i, i + k
    if n:
        z[0] = n
    return z


def solve_boundary(words: list, c: int, low: int, wanted: list[int], least: int, fold: int) -> Iterator[tuple[int, int, int]]:
    """(period, start, end) around the boundary c, for the wanted periods of the octave from ``low`` on, no farther than the tile.

    A fragment that ends inside the tile on both sides and is too short for a
    run is left out, as is one whose first period is itself a repetition.
    """
    side = 2 * low
    first, last = max(0, c - side), min(len(words), c + 2 * side + recurring(low))
    ahead = z_function(words[c:last])
    before = words[first:c][::-1]
    back = z_function([*before, None, *words[first : min(len(words), c + side)][::-1]])
    reach = min(len(words), c + side) - first  # words in the last part
    for q in wanted:
        if q >= len(ahead) or any(ahead[d] >= q - d for d in range(1, q // 2 + 1) if q % d == 0):
            continue
        at = reach - (c + q - first)  # the word before c + q, in the reversed part
        left = min(back[len(before) + 1 + at], len(before)) if before else 0
        start, end = c - left, c + q + ahead[q]
        if start > first and end < last and end - start < max(least, fold * q):
            continue
        if end - start >= 2 * q:
            yield q, start, end


def recurring(low: int) -> int:
    """Words that recur after a run's last boundary before its second period, at least."""
    return 4 if low == 1 else low


def boundaries(hashes: np.ndarray, bounds: np.ndarray, least: int = LEAST, fold: int = FOLD) -> Iterator[tuple[int, int, int, list[int]]]:
    """(row, c, low, periods): the boundaries, by octave, after which words recur some period of the octave later, in the same row."""
    longest, low = int(np.diff(bounds).max(initial=0)), 1
    block, size = hashes, 1  # hash of the ``size`` words from each place on
    while max(least, fold * low) <= longest:
        while size < recurring(low):
            block, size = mixed(block[:-size] * MUL + block[size:]), size * 2
        all_places = np.arange(0, len(block), 2 * low)
        for part in range(0, len(all_places), max(1, CELLS // low)):
            places = all_places[part : part + max(1, CELLS // low)]
            row = np.searchsorted(bounds, places, "right") - 1
            later = places[:, None] + np.arange(low, 2 * low)[None, :]
            recurs = block[np.minimum(later, len(block) - 1)] == block[places, None]
            recurs &= later + size <= bounds[row + 1][:, None]
            for at in np.flatnonzero(recurs.any(axis=1)).tolist():
                yield int(row[at]), int(places[at] - bounds[row[at]]), low, (np.flatnonzero(recurs[at]) + low).tolist()
        low *= 2


def tile_fragments(rows: DataFrame, change: Change | None) -> DataFrame:
    """(row, doc_id, n, found, words, whole): fragments of each row; the words only where there are some, else the SHA-256 of the whole.

    ``change`` gives the places of the words of a row as they are to be judged, or None for all as they are.
    """

    def solved(part: pa.RecordBatch) -> pa.RecordBatch:
        words, out = words_of(part.column("text"), SPACED, folded=False), []
        places = np.arange(len(words.hashes))
        lows, highs, ids = words.bounds[:-1].tolist(), words.bounds[1:].tolist(), part.column("doc_id").to_pylist()
        for lo, hi, doc_id in zip(lows, highs, ids):
            own = change(doc_id, hi - lo) if change and hi > lo else None
            if own is not None:
                places[lo:hi] = lo + own
        by_row: dict[int, list[tuple[int, int, list[int]]]] = {}
        for row, c, low, wanted in boundaries(words.hashes[places], words.bounds):
            by_row.setdefault(row, []).append((c, low, wanted))
        for i, (lo, hi) in enumerate(zip(lows, highs)):
            texts = words.texts(lo, hi)
            own = [texts[j] for j in (places[lo:hi] - lo).tolist()]
            found = [f for c, low, wanted in by_row.get(i, ()) for f in solve_boundary(own, c, low, wanted, LEAST, FOLD)]
            text = b" ".join(own)
            out.append((len(own), [{"period": q, "start": s, "end": e} for q, s, e in found], text if found else None, None if found else hashlib.sha256(text).hexdigest()))
        kinds = (pa.int64(), pa.list_(pa.struct([("period", pa.int64()), ("start", pa.int64()), ("end", pa.int64())])), pa.binary(), pa.string())
        cols = [pa.array([o[k] for o in out], kind) for k, kind in enumerate(kinds)]
        return pa.RecordBatch.from_arrays([part.column("row"), part.column("doc_id"), *cols], names=["row", "doc_id", "n", "found", "words", "whole"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield from map(solved, slices(b, "text"))

    return rows.mapInArrow(run, f"row long, doc_id long, n long, found {FRAGMENTS}, words binary, whole string")


def stitched(found: DataFrame, least: int = LEAST, fold: int = FOLD) -> DataFrame:
    """(row, start, length, period) of the runs; found: row, period, start, end.

    Fragments of a row and period that share ``period`` words or more are one
    stretch.  Of stretches with the same ends the smallest period stands.
    """
    along = Window.partitionBy("row", "period").orderBy("start", "end")
    reach = F.max("end").over(along.rowsBetween(Window.unboundedPreceding, -1))
    opens = F.when(reach.isNull() | (F.col("start") > reach - F.col("period")), 1).otherwise(0)
    islands = found.withColumn("_opens", opens).withColumn("_island", F.sum("_opens").over(along))
    whole = islands.groupBy("row", "period", "_island").agg(F.min("start").alias("start"), F.max("end").alias("end"))
    length = F.col("end") - F.col("start")
    long_enough = whole.filter(length >= F.greatest(F.lit(least), F.lit(fold) * F.col("period")))
    return long_enough.groupBy("row", "start", "end").agg(F.min("period").alias("period")).select("row", "start", length.alias("length"), "period")


def planted(doc_id: int | None, n: int) -> np.ndarray | None:
    """In every tenth document by crc32 of the doc_id a periodic end: from word a on the text repeats the p words from a on."""
    h = zlib.crc32(("null" if doc_id is None else str(doc_id)).encode())
    if h % 10 or not n:
        return None
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    place = np.arange(n)
    place[a:] = a + (place[a:] - a) % p
    return place


def collapse(words: list[bytes], runs: list[tuple[int, int, int]]) -> bytes:
    """The text without the words that some run (start, length, period) contains after its first period."""
    drop = np.zeros(len(words) + 1, np.int64)
    for start, length, period in runs:
        drop[start + period] += 1
        drop[start + length] -= 1
    return b" ".join([w for w, d in zip(words, np.cumsum(drop).tolist()) if not d])


def periodic_runs(docs: DataFrame, change: Change | None = None) -> tuple[DataFrame, DataFrame]:
    """(rows, runs): rows has row, doc_id, n, words, whole (see ``tile_fragments``), runs has row, start, length, period."""
    source = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    source = source.withColumn("row", F.monotonically_increasing_id())
    tiles = materialize(tile_fragments(source, change), "tiles")
    found = tiles.select("row", F.explode("found").alias("f")).select("row", "f.period", "f.start", "f.end")
    return tiles.drop("found"), stitched(found)


def run_report(docs: DataFrame, change: Change | None = None) -> DataFrame:
    """One row per document: doc_id, n_runs, the run of greatest exponent (start, length, period, exponent_milli) and two digests.

    Equal exponents: smallest start, then period.  ``runs_sha256`` is of every run's line, ``collapsed_sha256`` of the collapsed text.
    """
    rows, runs = periodic_runs(docs, change)
    listed = runs.groupBy("row").agg(F.sort_array(F.collect_list(F.struct("start", "period", "length"))).alias("runs"))  # bounded by the row's words
    joined = rows.join(listed, "row", "left").withColumn("runs", F.coalesce("runs", F.array().cast("array<struct<start:long,period:long,length:long>>")))
    higher = lambda x, y: x["length"] * y["period"] > y["length"] * x["period"]  # noqa: E731  greatest exponent, exactly

    def better(a: Column, x: Column) -> Column:
        return F.when(a["period"].isNull() | higher(x, a), x).otherwise(a)

    none = F.lit(None).cast("struct<start:long,period:long,length:long>")
    best = F.aggregate("runs", none, better)
    lines = F.array_join(F.transform("runs", lambda r: F.concat(r["start"].cast("string"), F.lit(","), r["length"].cast("string"), F.lit(","), r["period"].cast("string"), F.lit("\n"))), "")
    told = joined.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), best.alias("best"), F.sha2(lines.cast("binary"), 256).alias("runs_sha256"),
        F.when(F.size("runs") > 0, F.col("runs")).alias("runs"), "words", "whole",
    )

    def collapsed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            shas = []
            for runs_, words, whole in zip(b.column("runs").to_pylist(), b.column("words"), b.column("whole").to_pylist()):
                if whole is None:
                    text = words.as_py()
                    kept = collapse(text.split(b" "), [(r["start"], r["length"], r["period"]) for r in runs_]) if runs_ else text
                    whole = hashlib.sha256(kept).hexdigest()
                shas.append(whole)
            yield pa.RecordBatch.from_arrays([*(b.column(c) for c in keep), pa.array(shas, pa.string())], names=[*keep, "collapsed_sha256"])

    flat = told.select(
        "doc_id", "n_runs", F.col("best.start").alias("start"), F.col("best.length").alias("length"), F.col("best.period").alias("period"),
        F.floor(F.lit(1000) * F.col("best.length") / F.col("best.period")).alias("exponent_milli"), "runs_sha256", "runs", "words", "whole",
    )
    keep = ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256"]
    return flat.mapInArrow(collapsed, "doc_id long, n_runs long, start long, length long, period long, exponent_milli long, runs_sha256 string, collapsed_sha256 string")


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return run_report(table(spark, sf_dir, "documents"), planted)


QUERIES = {"op13_periodic_runs": op13_periodic_runs}
ORACLES = {
    "op13_periodic_runs": r"""
WITH d AS (SELECT row_number() OVER () AS row, doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS l FROM documents),
crc AS (SELECT row, xor(list_reduce(list_prepend(4294967295::BIGINT, flatten(list_transform(string_split(coalesce(doc_id::VARCHAR, 'null'), ''), lambda c: [ascii(c)::BIGINT, 0, 0, 0, 0, 0, 0, 0]))),
  lambda c, b: xor(xor(c, b) >> 1, 3988292384::BIGINT * (xor(c, b) & 1))), 4294967295::BIGINT) AS h FROM d),
s AS (SELECT d.row, doc_id, l, len(l) AS n, h % 10 = 0 AND len(l) > 0 AS hit, h // 10 AS g, (h // 10) % greatest(len(l), 1) AS a FROM d JOIN crc USING (row)),
p AS (SELECT *, 1 + (n - a) // (3 + g % 8) AS p FROM s),
w AS (SELECT row, doc_id, n, CASE WHEN hit THEN [l[1 + CASE WHEN i >= a THEN a + (i - a) % p ELSE i END] for i in range(0, n)] ELSE l END AS w FROM p),
e AS (SELECT row, n, unnest(w) AS word, unnest(range(0, n)) AS i FROM w),
m AS (SELECT x.row, y.i - x.i AS q, x.i FROM e x JOIN e y ON x.row = y.row AND x.word = y.word AND y.i > x.i AND 4 * (y.i - x.i) <= x.n),
isl AS (SELECT row, q, i, i - row_number() OVER (PARTITION BY row, q ORDER BY i) AS k FROM m),
st AS (SELECT row, q, min(i) AS s, count(*) + q AS len FROM isl GROUP BY row, q, k HAVING count(*) + q >= greatest(6, 4 * q)),
runs AS (SELECT row, s, len, min(q) AS q FROM st GROUP BY row, s, len),
agg AS (SELECT row, count(*) AS n_runs, string_agg(s || ',' || len || ',' || q || chr(10), '' ORDER BY s, q) AS lines FROM runs GROUP BY row),
best AS (SELECT row, s, len, q FROM runs QUALIFY row_number() OVER (PARTITION BY row ORDER BY len::DOUBLE / q DESC, s, q) = 1),
dropped AS (SELECT DISTINCT row, unnest(range(s + q, s + len)) AS i FROM runs),
kept AS (SELECT e.row, string_agg(word, ' ' ORDER BY e.i) AS t FROM e ANTI JOIN dropped ON e.row = dropped.row AND e.i = dropped.i GROUP BY e.row)
SELECT w.doc_id, coalesce(n_runs, 0)::BIGINT AS n_runs, s::BIGINT AS start, len::BIGINT AS length, q::BIGINT AS period, (1000 * len // q)::BIGINT AS exponent_milli,
  sha256(coalesce(lines, '')) AS runs_sha256, sha256(coalesce(t, '')) AS collapsed_sha256
FROM w LEFT JOIN agg ON agg.row = w.row LEFT JOIN best ON best.row = w.row LEFT JOIN kept ON kept.row = w.row"""
}
