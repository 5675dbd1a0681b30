"""Exact repeated substrings across a corpus, by common-prefix intervals of enhanced suffix arrays.

A byte is removed if a LENGTH-byte string covers it that also starts earlier
(smaller document, or the same document at an earlier place).

1. Anchors.  Of all GRAM-byte grams inside a LENGTH-byte window the one with
   the smallest hash is an anchor, so equal windows hold equal anchors at equal
   places.  An anchor comes with a hash of the bytes that windows around it can
   reach (its context).  Equal contexts are settled at once: all but the
   earliest are repeats; map tasks pre-aggregate their own copies, so a passage
   that is copied a million times crosses the network once per task.
2. Anchors whose contexts differ are looked at closely.  Their windows are cut
   into parts of PART starting places; all windows of a part share a core of
   bytes, and only places with equal cores meet.  There the suffixes are sorted,
   a stack scan over the longest common prefixes gives the common-prefix
   intervals, and those with different bytes to the left are the maximal
   repeats; all occurrences but the earliest are marked.
3. A group of more than GROUP_ROWS places is not held in memory: it is cut again
   into narrower parts, down to single windows, where rows stream by and only the
   earliest place of each string has to be known.  Strings are compared byte by
   byte everywhere but in step 1, where two contexts of one anchor are told apart
   by 64-bit hashes of up to 176 bytes on top of the anchor's own.

Defined edge cases: null texts are empty; documents shorter than LENGTH keep
all their bytes; a null doc_id sorts first; rows equal in doc_id and text are
one document and get one result; documents of one doc_id with different texts
are ordered by a hash of the text; an empty table gives an empty result.  Extra
columns, of any name, are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.llm.common import materialize, table, with_row_number

LENGTH = 100
GRAM = 24
PART = 20
GROUP_ROWS = 20_000
SEGMENT = 1 << 20
FLUSH = 4_000_000
_rng = np.random.RandomState(41)
BYTE = _rng.randint(0, 1 << 62, 256, dtype=np.int64).astype(np.uint64) * np.uint64(2) + np.uint64(1)
BASE = np.uint64(0x9E3779B97F4A7C15)


def _power(n: int) -> np.uint64:
    return np.uint64(pow(int(BASE), n, 1 << 64))


def gram_hashes(raw: np.ndarray, k: int) -> np.ndarray:
    """Hash of every run of k bytes, built from runs of powers of two."""
    h, size, done, out = BYTE[raw], 1, 0, None
    while True:
        if k & size:  # append this power of two to what is there
            out = h if out is None else out[: len(h) - done] * _power(size) + h[done:][: len(out)]
            done += size
        if size * 2 > k:
            break
        h = h[:-size] * _power(size) + h[size:]
        size *= 2
    out = out[: len(raw) - k + 1]
    out = (out ^ (out >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    return out ^ (out >> np.uint64(29))


def _sliding(values: np.ndarray, w: int, pick) -> np.ndarray:
    size = 1
    out = values
    while size * 2 <= w:
        out = pick(out[:-size], out[size:])
        size *= 2
    return pick(out[: len(out) - (w - size)], out[w - size :]) if w > size else out


def anchors(raw: np.ndarray, length: int, gram: int) -> tuple[np.ndarray, np.ndarray]:
    """Places and hashes of the grams that are smallest in some window (all equals of them)."""
    n, w = len(raw), length - gram + 1
    places, hashes = [], []
    for s in range(0, max(0, n - length + 1), SEGMENT):
        part = raw[s : s + SEGMENT + length - 1]
        h = gram_hashes(part, gram)
        low = _sliding(h, w, np.minimum)
        padded = np.concatenate([np.zeros(w - 1, np.uint64), low, np.zeros(w - 1, np.uint64)])
        i = np.flatnonzero(_sliding(padded, w, np.maximum) == h)
        places.append(i + s)
        hashes.append(h[i])
    if not places:
        return np.empty(0, np.int64), np.empty(0, np.uint64)
    at, first = np.unique(np.concatenate(places), return_index=True)
    return at, np.concatenate(hashes)[first]


def context_hashes(text: bytes, at: np.ndarray, length: int, gram: int) -> np.ndarray:
    """Hash of the bytes that windows around each place reach, with the room to the left as seed."""
    x = xxhash.xxh3_64_intdigest
    reach = length - gram
    return np.fromiter((x(text[p - reach if p > reach else 0 : p + length], p if p < reach else reach) for p in at.tolist()), np.uint64, len(at))


def _bytes(value: pa.Scalar) -> bytes:
    return value.as_buffer().to_pybytes() if value.is_valid else b""


def anchor_rows(docs: DataFrame, length: int, gram: int) -> DataFrame:
    """What the map side knows, in one pass: the first place of each (anchor, context) in a buffer, and the byte ranges of the others, joined.

    A range has a ``stop``; its start is in ``place`` and its anchor only spreads it.  Both kinds have to come from the
    same pass: where another pass cuts tasks or buffers elsewhere, other places are first.
    """
    reach = length - gram
    names = ["anchor", "context", "key", "place", "stop"]

    def settle(buffer: list[tuple]) -> Iterator[pa.RecordBatch]:
        h, c, k, p = (np.concatenate(x) for x in zip(*buffer))
        order = np.lexsort((p, k, c, h))
        h, c, k, p = h[order], c[order], k[order], p[order]
        new = np.ones(len(h), bool)
        new[1:] = (h[1:] != h[:-1]) | (c[1:] != c[:-1])
        firsts = [pa.array(h[new].view(np.int64)), pa.array(c[new].view(np.int64)), pa.array(k[new]), pa.array(p[new])]
        yield pa.RecordBatch.from_arrays([*firsts, pa.nulls(len(firsts[0]), pa.int64())], names=names)
        k, p = k[~new], p[~new]
        if not len(k):
            return
        order = np.lexsort((p, k))
        k, p = k[order], p[order]
        apart = np.ones(len(k), bool)
        apart[1:] = (k[1:] != k[:-1]) | (p[1:] - reach > p[:-1] + length)
        last = np.append(np.flatnonzero(apart)[1:] - 1, len(k) - 1)[: apart.sum()]
        k, start = k[apart], np.maximum(p[apart] - reach, 0)
        yield pa.RecordBatch.from_arrays([pa.array(k * 1_000_003 + start), pa.array(np.zeros(len(k), np.int64)), pa.array(k), pa.array(start), pa.array(p[last] + length)], names=names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        buffer, size = [], 0
        for b in batches:
            for key, t in zip(b.column("key").to_pylist(), b.column("text")):
                text = _bytes(t)
                if len(text) < length:
                    continue
                at, h = anchors(np.frombuffer(text, np.uint8), length, gram)
                buffer.append((h, context_hashes(text, at, length, gram), np.full(len(at), key, np.int64), at))
                size += len(at)
                if size >= FLUSH:
                    yield from settle(buffer)
                    buffer, size = [], 0
        if buffer:
            yield from settle(buffer)

    return docs.select("key", "text").mapInArrow(run, "anchor long, context long, key long, place long, stop long")


def settle_contexts(rows: DataFrame) -> DataFrame:
    """(kind, anchor, key, place, stop): kind 1 repeats an equal context; kind 2 is the earliest of a context whose anchor has several; kind 3 are the ranges of ``rows``, as they came."""

    names = ["kind", "anchor", "key", "place", "stop"]

    def told(kind: pa.Array, *columns: pa.Array) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([kind, *columns, pa.nulls(len(kind), pa.int64())], names=names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        prev = None  # (anchor, context, key, place, is first of its context, first context of its anchor, already told)
        for b in batches:
            ranges = b.filter(pc.is_valid(b.column("stop")))
            if ranges.num_rows:
                yield pa.RecordBatch.from_arrays([pa.array(np.full(ranges.num_rows, 3, np.int64)), *(ranges.column(n) for n in names[1:])], names=names)
                b = b.filter(pc.is_null(b.column("stop")))
            a, c, k, p = (b.column(n).to_numpy() for n in ("anchor", "context", "key", "place"))
            if not len(a):
                continue
            if prev is not None:
                a, c, k, p = (np.concatenate([[v], x]) for v, x in zip(prev[:4], (a, c, k, p)))
            new_a = np.ones(len(a), bool)
            new_a[1:] = a[1:] != a[:-1]
            new_c = new_a.copy()
            new_c[1:] |= c[1:] != c[:-1]
            if prev is not None:
                new_a[0], new_c[0] = prev[5], prev[4]
            repeat = ~new_c
            several = new_c & ~new_a  # a further context of an anchor: it and the anchor's first one are looked at
            start = np.maximum.accumulate(np.where(new_a, np.arange(len(a)), -1))
            owners = np.unique(start[several])
            kind = np.where(repeat, 1, 0)
            kind[several] = 2
            pending = first_row if prev is not None else None
            if len(owners) and owners[0] < 0:
                owners = owners[1:]
                if pending is not None:
                    yield told(pa.array([2]), *(pa.array([v]) for v in pending))
                    pending = None
            kind[owners] = 2
            if prev is not None and prev[6]:
                kind[0] = 0
            i = np.flatnonzero(kind)
            yield told(pa.array(kind[i]), pa.array(a[i]), pa.array(k[i]), pa.array(p[i]))
            last = start[-1]
            if last >= 0:  # the anchor of the last row began in this batch
                first_row = None if kind[last] == 2 or (last == 0 and prev is not None and prev[6] and prev[5]) else (int(a[last]), int(k[last]), int(p[last]))
            else:
                first_row = pending
            prev = (a[-1], c[-1], k[-1], p[-1], bool(new_c[-1]), bool(new_a[-1]), bool(kind[-1]) or (len(a) == 1 and prev is not None and prev[6]))

    ordered = rows.repartition("anchor").sortWithinPartitions("anchor", "context", "key", "place")
    return ordered.mapInArrow(run, "kind long, anchor long, key long, place long, stop long")


def cut_parts(places: DataFrame, docs: DataFrame, length: int, gram: int, part: int) -> DataFrame:
    """(core, key, start, lead, bytes): the windows around each place in parts of ``part`` starts; bytes begin at ``start``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        x = xxhash.xxh3_64_intdigest
        for b in batches:
            rows: list[tuple] = []
            for key, t, spots in zip(b.column("key").to_pylist(), b.column("text"), b.column("places").to_pylist()):
                text = _bytes(t)
                for spot in spots:
                    p = spot["place"]
                    for lo in range(p - (length - gram), p + 1, part):
                        hi = min(lo + part - 1, p)  # starts lo..hi
                        s, e = max(lo, 0), min(hi, len(text) - length)
                        if s > e:
                            continue
                        core = text[hi : lo + length]  # in every window of the part, as far as the text goes
                        rows.append((x(core, p - lo) - (1 << 63), key, s, s - lo, text[s : e + length]))
            cols = list(zip(*rows)) if rows else [()] * 5
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, [pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.binary()])], names=["core", "key", "start", "lead", "bytes"])

    by_doc = places.groupBy("key").agg(F.collect_list(F.struct("place")).alias("places"))  # bounded by the document
    return docs.select("key", "text").join(by_doc, "key").mapInArrow(run, "core long, key long, start long, lead int, bytes binary")


def narrower(large: DataFrame, length: int, part: int) -> DataFrame:
    """The same windows in parts of ``part`` starts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        x = xxhash.xxh3_64_intdigest
        for b in batches:
            rows: list[tuple] = []
            for r in b.to_pylist():
                raw, lead, starts = r["bytes"], r["lead"], len(r["bytes"]) - length + 1
                for lo in range(lead // part * part, lead + starts, part):
                    s, e = max(lo, lead), min(lo + part, lead + starts) - 1
                    piece = raw[s - lead : e - lead + length]
                    core = raw[lo + part - 1 - lead : lo - lead + length]
                    rows.append((x(core, lo + 1000 * part + (r["core"] & 0xFFFFFFFF)) - (1 << 63), r["key"], r["start"] + s - lead, s - lo, piece))
            cols = list(zip(*rows)) if rows else [()] * 5
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, [pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.binary()])], names=["core", "key", "start", "lead", "bytes"])

    return large.mapInArrow(run, "core long, key long, start long, lead int, bytes binary")


def maximal_repeats(strings: list[bytes], length: int) -> Iterator[tuple[int, list[tuple[int, int]]]]:
    """Common-prefix intervals of the suffixes that are at least ``length`` long.

    Each is (prefix length, occurrences (string, offset)).  Intervals whose
    occurrences all have the same byte to the left are left out, as a longer
    interval with the same occurrences covers them.
    """
    suffixes = sorted((s[i:], n, i) for n, s in enumerate(strings) for i in range(len(s) - length + 1))
    lcp = [0] * (len(suffixes) + 1)
    for i in range(1, len(suffixes)):
        x, y = suffixes[i - 1][0], suffixes[i][0]
        if x[:length] == y[:length]:
            m = min(len(x), len(y))
            k = length
            while k < m and x[k] == y[k]:
                k += 1
            lcp[i] = k
    stack: list[tuple[int, int]] = []  # (prefix length, left end) of the open intervals
    for i in range(1, len(suffixes) + 1):
        left = i - 1
        while stack and stack[-1][0] > lcp[i]:
            depth, left = stack.pop()
            members = [(n, o) for _, n, o in suffixes[left:i]]
            if len({strings[n][o - 1] if o else -1 - n for n, o in members}) > 1:
                yield depth, members
        if lcp[i] >= length and (not stack or stack[-1][0] < lcp[i]):
            stack.append((lcp[i], left))


def mark_group(rows: list[tuple], length: int) -> list[tuple[int, int, int]]:
    """(key, start, stop) of the repeats in one group; rows: (key, start, lead, bytes) in order of (key, start).

    Rows with equal bytes are settled at once; suffixes are sorted for the earliest of each only.
    """
    first: dict[tuple[int, bytes], tuple[int, int]] = {}
    marks: list[tuple[int, int, int]] = []
    for key, start, lead, raw in rows:
        if first.setdefault((lead, raw), (key, start)) != (key, start):
            marks.append((key, start, start + len(raw)))
    if len(first) < 2:
        return marks
    strings, where = [raw for _, raw in first], list(first.values())
    spans: dict[int, list[tuple[int, int]]] = {}
    for depth, members in maximal_repeats(strings, length):
        spots = [(where[n][0], where[n][1] + o) for n, o in members]
        lowest = min(spots)
        for spot, (n, o) in zip(spots, members):
            if spot != lowest:
                spans.setdefault(n, []).append((o, o + depth))
    for n, found in spans.items():
        key, start = where[n]
        found.sort()
        lo, hi = found[0]
        for s, e in found[1:]:
            if s > hi:
                marks.append((key, start + lo, start + hi))
                lo, hi = s, e
            hi = max(hi, e)
        marks.append((key, start + lo, start + hi))
    return marks


def scan_groups(parts: DataFrame, length: int, single: bool, group_rows: int) -> DataFrame:
    """(key, start, end, core, lead, bytes): marks, or with bytes the rows of groups that are too large."""
    schema = "key long, start long, stop long, core long, lead int, bytes binary"
    types = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.binary()]
    names = ["key", "start", "stop", "core", "lead", "bytes"]

    def batch(rows: list[tuple]) -> pa.RecordBatch:
        cols = list(zip(*rows)) if rows else [()] * 6
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types)], names=names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        core, held, large, earliest = None, [], False, {}
        out: list[tuple] = []

        def close() -> None:
            if len(held) > 1 and not large:
                out.extend((k, s, e, None, None, None) for k, s, e in mark_group(held, length))

        for b in batches:
            for c, k, s, lead, raw in zip(*(b.column(n).to_pylist() for n in ("core", "key", "start", "lead", "bytes"))):
                if c != core:
                    close()
                    core, held, large, earliest = c, [], False, {}
                if single:  # one window: the first row with its bytes is the earliest
                    if earliest.setdefault(raw, (k, s)) != (k, s):
                        out.append((k, s, s + length, None, None, None))
                elif large:
                    out.append((k, s, None, c, lead, raw))
                else:
                    held.append((k, s, lead, raw))
                    if len(held) > group_rows:
                        out.extend((h[0], h[1], None, c, h[2], h[3]) for h in held)
                        held, large = [], True
                if len(out) > 20_000:
                    yield batch(out)
                    out.clear()
        if not single:
            close()
        yield batch(out)

    keep = parts.repartition("core").sortWithinPartitions("core", "key", "start")
    return keep.mapInArrow(run, schema)


def find_marks(docs: DataFrame, length: int = LENGTH, gram: int = GRAM, group_rows: int = GROUP_ROWS) -> DataFrame:
    """(key, start, stop): byte ranges of ``docs`` (key, text) made of strings that start earlier; they may overlap."""
    settled = materialize(settle_contexts(anchor_rows(docs, length, gram)), "settled")
    local = settled.filter("kind = 3").select("key", F.col("place").alias("start"), "stop")
    start = F.greatest(F.lit(0).cast("long"), F.col("place") - (length - gram))
    marks = settled.filter("kind = 1").select("key", start.alias("start"), (F.col("place") + length).alias("stop")).union(local)
    parts = cut_parts(settled.filter("kind = 2").select("key", "place").distinct(), docs, length, gram, PART)
    for part in (PART // 4, 1, 0):
        scanned = materialize(scan_groups(parts, length, part == 0, group_rows), "groups")
        marks = marks.union(scanned.filter("core is null").select("key", "start", "stop"))
        large = scanned.filter("core is not null").select("core", "key", "start", "lead", "bytes")
        if part == 0 or large.isEmpty():
            break
        parts = narrower(large, length, part)
    return marks


def remove(docs: DataFrame, marks: DataFrame, carry: list[str], digest: bool = False) -> DataFrame:
    """carry columns, n_bytes, n_removed, n_spans, kept (binary, or its SHA-256 in hex): every document without its marked bytes."""

    def cut(text: bytes, starts: np.ndarray, stops: np.ndarray) -> tuple[bytes, int, int]:
        if not len(starts):
            return text, 0, 0
        order = np.argsort(starts, kind="stable")
        s, e = starts[order], np.maximum.accumulate(np.minimum(stops[order], len(text)))
        apart = np.ones(len(s), bool)
        apart[1:] = s[1:] > e[:-1]
        lo = s[apart]
        hi = e[np.append(np.flatnonzero(apart)[1:] - 1, len(s) - 1)]
        kept, end = [], 0
        for a, z in zip(lo.tolist(), hi.tolist()):
            kept.append(text[end:a])
            end = z
        kept.append(text[end:])
        return b"".join(kept), int((hi - lo).sum()), len(lo)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = b.column("found")
            ends = np.append(0, np.cumsum(np.array(pc.fill_null(pc.list_value_length(found), 0), np.int64)))
            flat = found.flatten()
            starts, stops = np.array(flat.field("start"), np.int64), np.array(flat.field("stop"), np.int64)
            rows = []
            for i, t in enumerate(b.column("text")):
                text = _bytes(t)
                kept, removed, spans = cut(text, starts[ends[i] : ends[i + 1]], stops[ends[i] : ends[i + 1]])
                rows.append((len(text), removed, spans, hashlib.sha256(kept).hexdigest() if digest else kept))
            n, gone, spans, kept = zip(*rows) if rows else ((),) * 4
            cols = [b.column(c) for c in carry]
            yield pa.RecordBatch.from_arrays([*cols, pa.array(n, pa.int64()), pa.array(gone, pa.int64()), pa.array(spans, pa.int64()), pa.array(kept, pa.string() if digest else pa.binary())], names=[*carry, "n_bytes", "n_removed", "n_spans", "kept"])

    by_doc = marks.groupBy("key").agg(F.collect_list(F.struct("start", "stop")).alias("found"))  # bounded by the document
    joined = docs.select("key", "text", *carry).join(by_doc, "key", "left").select(*carry, "text", "found")
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.select(*carry).schema)
    return joined.mapInArrow(run, f"{fields}, n_bytes long, n_removed long, n_spans long, kept {'string' if digest else 'binary'}")


def keyed(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(key, doc_id, text) by row and by document: key orders the documents; it is doc_id itself where that is a key."""
    base = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    if base.filter("doc_id is null").isEmpty() and base.groupBy("doc_id").count().filter("count > 1").isEmpty():
        rows = base.withColumn("key", F.col("doc_id"))
        return rows, rows
    named = base.withColumn("fp", F.xxhash64("text"))
    ids, _ = with_row_number(named.select("doc_id", "fp").distinct(), [F.col("doc_id").asc_nulls_first(), F.col("fp").asc()], "key", "keys")
    same = named.doc_id.eqNullSafe(F.col("i.doc_id")) & (named.fp == F.col("i.fp"))
    rows = named.join(ids.alias("i"), same).select("key", named.doc_id, named.text)
    return rows, rows.dropDuplicates(["key"])


def remove_repeats(docs: DataFrame, length: int = LENGTH, gram: int = GRAM, group_rows: int = GROUP_ROWS, digest: bool = False) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept (binary, or its SHA-256 in hex) of each document."""
    rows, documents = keyed(docs)
    return remove(rows, find_marks(documents.select("key", "text"), length, gram, group_rows), ["doc_id"], digest)


def op4_suffix_interval_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = remove_repeats(table(spark, sf_dir, "documents"), digest=True)
    return out.select("doc_id", "n_bytes", "n_removed", "n_spans", F.col("kept").alias("kept_sha256"))


QUERIES = {"op4_suffix_interval_repeats": op4_suffix_interval_repeats}
ORACLES = {
    "op4_suffix_interval_repeats": """
WITH d AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h, strlen(coalesce(text, ''))::BIGINT AS n FROM documents),
c AS (SELECT doc_id, n, o, substr(h, 2 * o + 1, 2 * 355) AS t FROM (SELECT doc_id, h, n, unnest(range(0, n, 256)) AS o FROM d)),
w AS (SELECT doc_id, o + q AS p, substr(t, 2 * q + 1, 200) AS s FROM (SELECT doc_id, n, o, t, unnest(range(0, 256)) AS q FROM c) WHERE o + q + 100 <= n),
f AS (SELECT s, min((doc_id, p)) AS first FROM w GROUP BY s HAVING count(*) > 1),
hit AS (SELECT doc_id, p FROM w JOIN f USING (s) WHERE (doc_id, p) > first),
run AS (SELECT doc_id, p, p - lag(p, 1, -1000) OVER (PARTITION BY doc_id ORDER BY p) > 100 AS opens FROM hit),
grp AS (SELECT doc_id, p, count_if(opens) OVER (PARTITION BY doc_id ORDER BY p) AS g FROM run),
span AS (SELECT doc_id, g, min(p) AS a, max(p) + 100 AS z FROM grp GROUP BY doc_id, g),
gap AS (SELECT doc_id, a, z, lag(z, 1, 0) OVER (PARTITION BY doc_id ORDER BY a) AS before FROM span),
cut AS (SELECT doc_id, count(*) AS n_spans, sum(z - a)::BIGINT AS n_removed, string_agg(substr(h, 2 * before + 1, 2 * (a - before)), '' ORDER BY a) AS kept, max(z) AS last FROM gap JOIN d USING (doc_id) GROUP BY doc_id)
SELECT d.doc_id, d.n AS n_bytes, coalesce(n_removed, 0) AS n_removed, coalesce(n_spans, 0) AS n_spans,
  sha256(from_hex(coalesce(kept, '') || substr(h, 2 * coalesce(last, 0) + 1))) AS kept_sha256
FROM d LEFT JOIN cut USING (doc_id)"""
}
