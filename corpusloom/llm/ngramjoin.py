"""Jaccard join on word n-grams by rare-first prefixes with length, positional and suffix filters.

A document is its set of distinct word n-grams; equal sets are one class, found
by a digest.  All sets are ordered rare first, by counters of a fixed number
that n-grams are hashed to, so that one small array tells every task the same
order.  Two sets that are similar enough share an n-gram among the first
``n - ceil(percent * n / 100) + 1`` of each, their prefixes.

1. Prefix n-grams are dealt out; n-grams of a single class's prefix go at once.  The rest are the
   posting lists, each with its classes in the order of the n-gram's place.  Of lists of up to LONG rows
   only classes stay that length and positional filter allow to link with another of the list.
2. ``class_links``: all links between classes.  Lists are joined with
   themselves in pieces of at most ``piece`` rows a side, under the length
   filter (sizes too unlike), the positional filter (what follows the shared
   n-gram on either side is too little) and the suffix filter (how much of what
   follows on both sides is in each of PARTS fixed parts of the n-gram space bounds what they share).
   What is left is verified once per pair on the full sets.
3. ``ngram_components`` needs no table of all pairs.  Each class first tries
   the class before it and the first one in its lists; those it shares most
   lists with.  What these links join is not compared again: the join of step
   2 then runs only between different components, where in every list the
   members outside the largest component ask.  It runs twice: first each asker tries of each other component only the class
   that may share most with it, then lists in which that left a pair untold are compared in full, as far as
   their members are still apart.

Nothing is capped: all lists are joined whole.

Defined edge cases: null, empty and wordless texts have no n-grams and stay
alone (component: their own doc_id); texts of fewer words than an n-gram are one
n-gram; documents without doc_id count as members, but the component takes its
smallest non-null doc_id; repeated rows and repeated doc_ids are members each;
an empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.llm.common import materialize, table
from corpusloom.llm.components import components
from corpusloom.llm.wordscan import SPACED, shingle_sets, slices, words_of

COUNTERS = 1 << 20
CHUNK = 1 << 12
PARTS = 256
FULL = 255
PIECE = 2048
PAIRS = 200_000  # looked at together
LONG = 256  # rows of a list up to which all are compared by size and place before it is written
HEADS = 256  # partners of one class that are verified in one place
FAR = (1 << 63) - 1


def sets_of(texts: pa.Array, width: int) -> Iterator[np.ndarray]:
    return shingle_sets(words_of(texts, SPACED, folded=True), width)


def counter(grams: np.ndarray) -> np.ndarray:
    return (grams >> np.uint64(44)).astype(np.int64)


def gram_counts(texts: DataFrame, width: int) -> np.ndarray:
    """COUNTERS counts of the documents' n-grams by hash: 8 MB whatever the input."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = np.zeros(COUNTERS, np.int64)
        for b in batches:
            for part in slices(b, "text"):
                sets = list(sets_of(part.column("text"), width))
                held += np.bincount(counter(np.concatenate(sets)), minlength=COUNTERS)
        chunks = held.reshape(-1, CHUNK)
        some = np.flatnonzero(chunks.any(axis=1)).tolist()
        yield pa.RecordBatch.from_arrays([pa.array(some, pa.int32()), pa.array([chunks[c].tobytes() for c in some], pa.binary())], names=["chunk", "counts"])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for b in batches:
            for c, counts in zip(b.column("chunk").to_pylist(), b.column("counts")):
                sums[c] = sums.get(c, 0) + np.frombuffer(counts.as_buffer(), np.int64)
        yield pa.RecordBatch.from_arrays([pa.array(list(sums), pa.int32()), pa.array([s.tobytes() for s in sums.values()], pa.binary())], names=["chunk", "counts"])

    kind = "chunk int, counts binary"
    got = texts.select("text").mapInArrow(count, kind).repartition("chunk").mapInArrow(add, kind).toArrow()
    out = np.zeros((COUNTERS // CHUNK, CHUNK), np.int64)
    for c, counts in zip(got["chunk"].to_pylist(), got["counts"]):
        out[c] += np.frombuffer(counts.as_buffer(), np.int64)
    return out.reshape(-1)


def prefix_of(grams: np.ndarray, counts: np.ndarray, percent: int) -> np.ndarray:
    """The rarest n-grams of a sorted set, as many as two similar sets cannot both do without; equal counts by hash."""
    n = len(grams)
    return grams[np.argsort(counts[counter(grams)], kind="stable")[: n - (percent * n + 99) // 100 + 1]] if n else grams


def parts_of(grams: np.ndarray) -> bytes:
    """How many n-grams of the set are in each of PARTS parts; FULL stands for that many or more."""
    return np.minimum(np.bincount((grams & np.uint64(PARTS - 1)).astype(np.int64), minlength=PARTS), FULL).astype(np.uint8).tobytes()


def sketches(texts: DataFrame, width: int, percent: int, counts: np.ndarray) -> DataFrame:
    """(doc_id, fp, n, digest, prefix, parts) per row; no digest where there are no n-grams."""
    sent = texts.sparkSession.sparkContext.broadcast(counts)  # COUNTERS numbers

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for part in slices(b, "text"):
                rows = [(len(s), *((xxhash.xxh3_128_digest(s.tobytes()), prefix_of(s, sent.value, percent).tobytes(), parts_of(s)) if len(s) else (None,) * 3)) for s in sets_of(part.column("text"), width)]
                cols = [pa.array([r[0] for r in rows], pa.int64()), *(pa.array([r[k] for r in rows], pa.binary()) for k in (1, 2, 3))]
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), part.column("fp"), *cols], names=["doc_id", "fp", "n", "digest", "prefix", "parts"])

    return texts.mapInArrow(run, "doc_id long, fp long, n long, digest binary, prefix binary, parts binary")


def near_enough(n: np.ndarray, place: np.ndarray, other_n: np.ndarray, other_place: np.ndarray, percent: int) -> np.ndarray:
    """``may_link`` of arrays."""
    alike = 100 * np.minimum(n, other_n) >= percent * np.maximum(n, other_n)
    return alike & (np.minimum(n - place, other_n - other_place) >= (percent * (n + other_n) + 99 + percent) // (100 + percent))


def pairable(rows: np.ndarray, percent: int) -> np.ndarray:
    """Which rows (gram, cid, n, place) of whole lists length and positional filter allow to link with another of their list; all rows of lists over LONG."""
    gram, _, n, place = rows
    bounds = np.flatnonzero(np.concatenate([[True], gram[1:] != gram[:-1], [True]]))
    sizes = np.diff(bounds)
    good, ends = np.repeat(sizes > LONG, sizes), np.repeat(bounds[1:], sizes)
    left = np.flatnonzero(~good)
    for d in range(1, LONG):
        left = left[left + d < ends[left]]
        if not len(left):
            break
        x = left[near_enough(n[left], place[left], n[left + d], place[left + d], percent)]
        good[x] = good[x + d] = True
    return good


def pairable_rows(parts: Iterator[np.ndarray], percent: int) -> Iterator[np.ndarray]:
    """The pairable rows of lists that come in parts; of a list over LONG no more than that and a part is held."""
    held = np.empty((4, 0), np.int64)
    passing = None  # the n-gram of a list over LONG whose first rows are told
    for part in parts:
        held = np.concatenate([held, part], axis=1)
        if not held.shape[1]:
            continue
        if passing is not None:
            more = int(np.searchsorted(held[0], passing, "right"))
            yield held[:, :more]
            held = held[:, more:]
            if not held.shape[1]:
                continue
            passing = None
        last = int(np.searchsorted(held[0], held[0, -1], "left"))
        if held.shape[1] - last > LONG:
            last, passing = held.shape[1], held[0, -1]
        if last:
            yield held[:, :last][:, pairable(held[:, :last], percent)]
            held = held[:, last:]
    if held.shape[1]:
        yield held[:, pairable(held, percent)]


def posting_lists(classes: DataFrame, percent: int) -> DataFrame:
    """(gram, cid, n, place, prior, prior_n, prior_place, first, first_n, first_place): prefix n-grams that several classes have, with those that are ``pairable``.

    ``prior`` is the class before in the order (place, n, cid) of the list, ``first`` its first one; both null on the first row.
    """

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            grams = [np.frombuffer(p.as_buffer(), np.int64) for p in b.column("prefix")]
            sizes = [len(g) for g in grams]
            if grams:
                row = pa.array(np.repeat(np.arange(len(grams)), sizes))
                place = np.concatenate([np.arange(k) for k in sizes])
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(grams)), b.column("cid").take(row), b.column("n").take(row), pa.array(place)], names=names[:4])

    def listed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = np.empty((4, 0), np.int64)  # the row not told yet, which waits for its successor
        prior = first = None  # the row told last, and the first one of its list
        for part in pairable_rows((np.stack([b.column(c).to_numpy() for c in names[:4]]) for b in batches), percent):
            held = np.concatenate([held, part], axis=1)
            if held.shape[1] > 1:
                yield told(held, held.shape[1] - 1, prior, first)
                first, prior = first_of(held, held.shape[1] - 1, first), held[:, -2]
                held = held[:, -1:]
        if held.shape[1]:
            yield told(held, 1, prior, first)

    def first_of(rows: np.ndarray, upto: int, first: np.ndarray | None) -> np.ndarray:
        """The first row of the list that row ``upto - 1`` is in."""
        begin = int(np.searchsorted(rows[0, :upto], rows[0, upto - 1], "left"))
        return first if begin == 0 and first is not None and first[0] == rows[0, 0] else rows[:, begin]

    def told(rows: np.ndarray, upto: int, prior: np.ndarray | None, first: np.ndarray | None) -> pa.RecordBatch:
        """The first ``upto`` rows, those without company left out."""
        gram = rows[0]
        begun = np.concatenate([[prior is None or prior[0] != gram[0]], gram[1:] != gram[:-1]])
        followed = np.concatenate([gram[1:] == gram[:-1], [False]])
        at = np.flatnonzero((~begun | followed)[:upto])
        shifted = np.concatenate([rows[:, :1] if prior is None else prior[:, None], rows[:, :-1]], axis=1)
        lead = np.maximum.accumulate(np.where(begun, np.arange(len(gram)), 0))
        firsts = rows[:, lead].copy()
        if not begun[0]:
            same = gram == gram[0]
            firsts[:, same] = first[:, None]
        none = begun[at]
        cols = [pa.array(rows[k, at]) for k in range(4)] + [pa.array(x[k, at], mask=none) for x in (shifted, firsts) for k in (1, 2, 3)]
        return pa.RecordBatch.from_arrays(cols, names=names)

    names = ["gram", "cid", "n", "place", "prior", "prior_n", "prior_place", "first", "first_n", "first_place"]
    dealt = classes.select("cid", "n", "prefix").mapInArrow(spread, "gram long, cid long, n long, place long")
    ordered = dealt.repartition("gram").sortWithinPartitions("gram", "place", "n", "cid")
    return ordered.mapInArrow(listed, ", ".join(f"{c} long" for c in names))


def may_link(n: str, place: str, other_n: str, other_place: str, percent: int) -> Column:
    """Length and positional filter for two classes that share an n-gram at these places of their orders, and none before it on both sides."""
    alike = f"100 * least({n}, {other_n}) >= {percent} * greatest({n}, {other_n})"
    needed = f"({percent} * ({n} + {other_n}) + {100 + percent - 1}) div {100 + percent}"
    return F.expr(f"{alike} and least({n} - {place}, {other_n} - {other_place}) >= {needed}")


def first_tries(lists: DataFrame, percent: int) -> DataFrame:
    """(a, b): of each class the one partner, of those before it and first in its lists, that it shares most of them with."""
    met = None
    for other in ("prior", "first"):
        near = lists.filter(F.col(other).isNotNull() & may_link("n", "place", f"{other}_n", f"{other}_place", percent))
        near = near.select(F.least("cid", other).alias("a"), F.greatest("cid", other).alias("b"))
        met = near if met is None else met.union(near)
    shared = met.groupBy("a", "b").agg(F.count(F.lit(1)).alias("c"))
    both = shared.union(shared.select("b", "a", "c"))
    best = both.groupBy("a").agg(F.max(F.struct("c", (-F.col("b")).alias("b"))).alias("m")).select("a", (-F.col("m.b")).alias("b"))
    return best.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def pairs_between(lists: DataFrame, heads: DataFrame, label: DataFrame | None, percent: int, piece: int = PIECE, best: bool = False) -> DataFrame:
    """(a, b, gram): classes a, b of different components (``label``: node, component; without it each class is its own) that all three filters allow to link; no gram.

    In each list the members outside its largest component ask all others.  Both sides are cut into pieces of about ``piece`` rows,
    so a long list is many tasks' work; a task holds one piece of each side, and what it tells are the pairs that are left.
    With ``best`` each asker's pieces of a list tell of each other component only the class that may share most with it; where that
    left a pair untold, a row has the list's gram alone.  All pairs of the other lists are told.
    """
    known = lists.select("gram", "cid", "n", "place")
    if label is None:
        known = known.withColumn("component", F.col("cid"))
    else:
        known = known.join(label.withColumnRenamed("node", "cid"), "cid", "left").withColumn("component", F.coalesce("component", "cid"))
    counts = known.groupBy("gram", "component").agg(F.count(F.lit(1)).alias("c"))
    split = counts.groupBy("gram").agg(F.max(F.struct("c", "component")).alias("m"), F.sum("c").alias("members"), F.count(F.lit(1)).alias("parts")).filter("parts > 1")
    rooms = lambda x: F.ceil(x / F.lit(piece)).cast("int")
    split = split.select("gram", F.col("m.component").alias("largest"), rooms(F.col("members") - F.col("m.c")).alias("asking"), rooms(F.col("members")).alias("rooms"))
    placed = known.join(split, "gram").withColumn("asks", F.col("component") != F.col("largest")).drop("largest")
    dealt = lambda n, seed: F.pmod(F.xxhash64("cid", F.lit(seed)), F.col(n)).cast("int")
    every = lambda n, one: F.transform(F.sequence(F.lit(0), F.col(n) - 1), one)
    room = lambda i, j, asker, answers: F.struct(i.alias("i"), j.alias("j"), asker.alias("asker"), answers.alias("answers"))
    own_i, own_j = dealt("asking", 1), dealt("rooms", 2)
    answering = every("asking", lambda i: room(i, own_j, F.col("asks") & (i == own_i), F.lit(True)))
    elsewhere = F.filter(every("rooms", lambda j: room(own_i, j, F.lit(True), F.lit(False))), lambda x: F.col("asks") & (x["j"] != own_j))
    alone = F.array(room(F.lit(0), F.lit(0), F.col("asks"), F.lit(True)))  # a list of one room
    at = F.when(F.expr("asking = 1 and rooms = 1"), alone).otherwise(F.concat(answering, elsewhere))
    met = suffixes(placed, heads).withColumn("at", F.explode(at)).select("gram", "at.i", "at.j", "at.asker", "at.answers", "cid", "n", "place", "component", "asks", "rest")
    ordered = met.repartition("gram", "i", "j").sortWithinPartitions("gram", "i", "j", "answers")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: pa.Table | None = None
        for b in batches:
            table_ = pa.Table.from_batches([b]) if held is None else pa.concat_tables([held, pa.Table.from_batches([b])])
            room = [table_[c].to_numpy() for c in ("gram", "i", "j")]
            new = np.flatnonzero(np.any([x[1:] != x[:-1] for x in room], axis=0)) + 1
            if len(new):  # all groups but the last are whole
                yield from allowed_pairs(table_.slice(0, int(new[-1])), percent, best)
                table_ = table_.slice(int(new[-1]))
            held = table_
        if held is not None:
            yield from allowed_pairs(held, percent, best)

    return ordered.mapInArrow(run, "a long, b long, gram long").distinct()


def suffixes(rows: DataFrame, heads: DataFrame) -> DataFrame:
    """``rows`` with ``rest``: the counts by part of what stands from ``place`` on in the order of a class; heads: cid, prefix, parts.

    A class goes once to all its rows, of which it has at most as many as its prefix has n-grams.
    """
    kept = rows.columns
    tops = heads.select(*(F.col("cid") if f.name == "cid" else F.lit(None).cast(f.dataType).alias(f.name) for f in rows.schema.fields), "prefix", "parts")
    none = F.lit(None).cast("binary")
    met = tops.unionByName(rows.withColumn("prefix", none).withColumn("parts", none))
    ordered = met.repartition("cid").sortWithinPartitions("cid", F.col("place").asc_nulls_first())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        whole, prefix = np.empty(0, np.uint8), np.empty(0, np.uint64)
        for b in batches:
            top = np.flatnonzero(b.column("place").is_null().to_numpy(zero_copy_only=False))
            place = b.column("place").fill_null(-1).to_numpy()
            rest = []
            for head, lo, hi in zip([-1, *top.tolist()], [0, *(top + 1).tolist()], [*top.tolist(), len(place)]):
                if hi == lo and hi < len(place):
                    continue  # none of its rows are left
                if head >= 0:
                    whole = np.frombuffer(b.column("parts")[head].as_buffer(), np.uint8)
                    prefix = np.frombuffer(b.column("prefix")[head].as_buffer(), np.uint64)
                if hi > lo:
                    rest.append(left_from(place[lo:hi], whole, prefix))
            if rest:
                own = np.delete(np.arange(len(place)), top)
                yield pa.RecordBatch.from_arrays([*(b.column(c).take(pa.array(own)) for c in kept), binaries(np.concatenate(rest))], names=[*kept, "rest"])

    fields = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema.fields)
    return ordered.mapInArrow(run, f"{fields}, rest binary")


def left_from(places: np.ndarray, whole: np.ndarray, prefix: np.ndarray) -> np.ndarray:
    """Per place (ascending): ``whole`` without the n-grams of the prefix before that place."""
    before = prefix[: places[-1]]
    row = np.searchsorted(places, np.arange(len(before)), "right")  # the first place that an n-gram is before
    less = np.bincount(row * PARTS + (before & np.uint64(PARTS - 1)).astype(np.int64), minlength=len(places) * PARTS).reshape(-1, PARTS)
    return np.where(whole == FULL, FULL, whole - np.cumsum(less, axis=0)).astype(np.uint8)


def binaries(rows: np.ndarray) -> pa.Array:
    """Rows of PARTS bytes as an Arrow column."""
    ends = np.arange(len(rows) + 1, dtype=np.int32) * PARTS
    return pa.Array.from_buffers(pa.binary(), len(rows), [None, pa.py_buffer(ends), pa.py_buffer(np.ascontiguousarray(rows))])


def allowed_pairs(rows: pa.Table, percent: int, best: bool) -> Iterator[pa.RecordBatch]:
    """(a, b, gram) of whole groups, those that only ask before those that answer: each asker with each other one that the filters allow.

    What two classes share before a list's n-gram is in neither suffix, so later lists that they share seldom tell a pair again.
    """
    gram, i, j, cid, n, place, component = (rows[c].to_numpy() for c in ("gram", "i", "j", "cid", "n", "place", "component"))
    asking, answers, asks = (rows[c].to_numpy(zero_copy_only=False).astype(bool) for c in ("asker", "answers", "asks"))
    rest = np.frombuffer(b"".join(rows["rest"].to_pylist()), np.uint8).reshape(-1, PARTS)
    begun = np.concatenate([[True], (gram[1:] != gram[:-1]) | (i[1:] != i[:-1]) | (j[1:] != j[:-1])])
    group = np.cumsum(begun) - 1
    ends = np.append(np.flatnonzero(begun)[1:], len(gram))[group]
    first = np.minimum.reduceat(np.where(answers, np.arange(len(gram)), len(gram)), np.flatnonzero(begun))[group]
    asker = np.flatnonzero(asking & (first < ends))
    many = (ends - first)[asker]
    stops = np.searchsorted(np.cumsum(many), np.arange(PAIRS, many.sum() + PAIRS, PAIRS), "right") if len(asker) else []
    for lo, hi in zip([0, *stops[:-1]], stops):
        hi = max(hi, lo + 1) if hi < len(asker) else len(asker)
        if lo >= hi:
            continue
        x = np.repeat(asker[lo:hi], many[lo:hi])
        y = np.arange(len(x)) - np.repeat(np.cumsum(many[lo:hi]) - many[lo:hi], many[lo:hi]) + np.repeat(first[asker[lo:hi]], many[lo:hi])
        ok = (component[x] != component[y]) & (~asks[y] | (cid[x] < cid[y])) & near_enough(n[x], place[x], n[y], place[y], percent)
        x, y = x[ok], y[ok]
        sizes = n[x] + n[y]
        needed = (percent * sizes + 99 + percent) // (100 + percent)
        both = np.minimum(rest[x], rest[y])
        shared = both.sum(axis=1, dtype=np.int64) + np.where((both == FULL).any(axis=1), sizes, 0)
        ok = shared >= needed
        x, y, spare = x[ok], y[ok], (shared - needed)[ok]
        untold = np.empty(0, np.int64)
        if best and len(x):
            order = np.lexsort((cid[y], -spare, component[y], x))
            x, y = x[order], y[order]
            first_of = np.concatenate([[True], (x[1:] != x[:-1]) | (component[y][1:] != component[y][:-1])])
            untold = np.unique(gram[x[~first_of]])
            x, y = x[first_of], y[first_of]
        pairs, marks = pa.nulls(len(x), pa.int64()), pa.nulls(len(untold), pa.int64())
        cols = [pa.array(np.minimum(cid[x], cid[y])), pa.array(np.maximum(cid[x], cid[y])), pairs]
        yield pa.RecordBatch.from_arrays(cols, names=["a", "b", "gram"])
        yield pa.RecordBatch.from_arrays([marks, marks, pa.array(untold)], names=["a", "b", "gram"])


def verified(pairs: DataFrame, texts: DataFrame, width: int, percent: int) -> DataFrame:
    """(a, b): the pairs whose full sets have 100 * intersection >= percent * union; texts: cid, text.

    The partners of a class meet it in places of about HEADS, to each of which its text goes once.
    """
    places = pairs.groupBy("a").agg(F.ceil(F.count(F.lit(1)) / F.lit(HEADS)).cast("int").alias("places"))
    dealt = pairs.join(places, "a").withColumn("at", F.pmod(F.xxhash64("b"), F.col("places")).cast("int"))
    heads = dealt.select("a", "at").distinct().join(texts.withColumnRenamed("cid", "a"), "a").select("a", "at", F.lit(None).cast("long").alias("b"), "text")
    others = dealt.select("a", "at", "b").join(texts.withColumnRenamed("cid", "b"), "b").select("a", "at", "b", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        head = np.empty(0, np.uint64)
        for batch in batches:
            for part in slices(batch, "text"):
                good = []
                for b, own in zip(part.column("b").to_pylist(), sets_of(part.column("text"), width)):
                    if b is None:
                        head = own
                        good.append(False)
                        continue
                    fits = 100 * min(len(own), len(head)) >= percent * max(len(own), len(head))
                    both = len(np.intersect1d(own, head, assume_unique=True)) if fits else 0
                    good.append(fits and 100 * both >= percent * (len(own) + len(head) - both))
                yield part.select(["a", "b"]).filter(pa.array(good, pa.bool_()))

    rows = heads.unionByName(others).repartition("a", "at").sortWithinPartitions("a", "at", F.col("b").asc_nulls_first())
    return rows.mapInArrow(run, "a long, b long")


class Prepared:
    """The written tables of a join: sketch (rows), classes, lists; of classes that are in lists heads (prefix and parts) and texts."""

    def __init__(self, docs: DataFrame, width: int, percent: int) -> None:
        text = F.col("text").cast("string")
        rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(text).alias("fp"), text.alias("text"))
        self.width, self.percent = width, percent
        self.sketch = materialize(sketches(rows, width, percent, gram_counts(rows, width)), "sketch")
        rep = F.min(F.struct(F.coalesce("doc_id", F.lit(FAR)).alias("id"), "fp")).alias("rep")
        firsts = [F.first(c).alias(c) for c in ("n", "prefix", "parts")]
        grouped = self.sketch.filter("digest is not null").groupBy("digest").agg(F.min("doc_id").alias("first_id"), rep, *firsts)
        self.classes = materialize(grouped.withColumn("cid", F.monotonically_increasing_id()), "classes")
        self.lists = materialize(posting_lists(self.classes, percent), "lists")
        self.heads = materialize(self.classes.join(self.lists.select("cid").distinct(), "cid", "left_semi").select("cid", "rep", "prefix", "parts"), "heads")
        wanted = self.heads.select("cid", "rep.id", F.col("rep.fp").alias("_fp"))
        named = rows.select(F.coalesce("doc_id", F.lit(FAR)).alias("id"), F.col("fp").alias("_fp"), "text")
        self.texts = materialize(named.join(wanted, ["id", "_fp"]).groupBy("cid").agg(F.first("text").alias("text")), "texts")

    def links(self, lists: DataFrame, label: DataFrame | None, piece: int, best: bool = False) -> tuple[DataFrame, DataFrame | None]:
        """(a, b) verified, and with ``best`` the lists of which that does not tell all."""
        told = materialize(pairs_between(lists, self.heads, label, self.percent, piece, best), "pairs")
        links = verified(told.filter("gram is null").select("a", "b"), self.texts, self.width, self.percent)
        if not best:
            return links, None
        untold = lists.select("gram", "cid", "n", "place").join(told.filter("gram is not null").select("gram").distinct(), "gram", "left_semi")
        return links, materialize(untold, "untold")  # written, so that joins may split the rows of a long list


def class_links(docs: DataFrame, width: int, percent: int, piece: int = PIECE) -> tuple[DataFrame, DataFrame]:
    """(members, links): doc_id and class of every row (null without n-grams), and all links (a, b) between different classes."""
    ready = Prepared(docs, width, percent)
    members = ready.sketch.join(ready.classes.select("digest", "cid"), "digest", "left").select("doc_id", F.col("n").alias("n_shingles"), F.col("cid").alias("class"))
    return members, ready.links(ready.lists, None, piece)[0]


def ngram_components(docs: DataFrame, width: int, percent: int, piece: int = PIECE) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id."""
    ready = Prepared(docs, width, percent)
    tries = materialize(first_tries(ready.lists, percent), "tries")
    label, lists = components(materialize(verified(tries, ready.texts, width, percent), "links")), ready.lists
    for best in (True, False):
        stars = label.filter("node <> component").select(F.col("component").alias("a"), F.col("node").alias("b"))  # they connect what the links did
        links, lists = ready.links(lists, label, piece, best)
        label = components(materialize(stars.union(links), "links"))
    label = label.withColumnRenamed("node", "cid")
    firsts = ready.classes.select("cid", "first_id").join(label, "cid").groupBy("component").agg(F.min("first_id").alias("component_id"))
    firsts = materialize(firsts, "firsts")  # written, so that a join may split the rows of a large component
    named = ready.classes.select("digest", "first_id", "cid").join(label, "cid", "left").join(firsts, "component", "left")
    named = named.select("digest", F.coalesce("component_id", "first_id").alias("component_id"))
    out = ready.sketch.select("doc_id", "n", "digest").join(named, "digest", "left")
    component = F.when(F.col("digest").isNull(), F.col("doc_id")).otherwise(F.col("component_id"))
    return out.select("doc_id", F.col("n").alias("n_shingles"), component.alias("component_id"))


def op12_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_components(table(spark, sf_dir, "documents"), width=4, percent=85)


QUERIES = {"op12_ngram_join": op12_ngram_join}
ORACLES = {
    "op12_ngram_join": r"""
WITH RECURSIVE w AS (
  SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS l FROM documents),
s AS (SELECT DISTINCT doc_id, sh FROM (
  SELECT doc_id, unnest(CASE WHEN len(l) >= 4 THEN [array_to_string(l[i:i + 3], ' ') for i in range(1, len(l) - 2)] WHEN len(l) > 0 THEN [array_to_string(l, ' ')] ELSE [] END) AS sh FROM w)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
df AS (SELECT sh, count(*) AS c FROM s GROUP BY sh),
r AS (SELECT s.doc_id, s.sh, n.n, row_number() OVER (PARTITION BY s.doc_id ORDER BY df.c, s.sh) AS k FROM s JOIN df USING (sh) JOIN n USING (doc_id)),
p AS (SELECT doc_id, sh, n FROM r WHERE k <= n - ceil(0.85 * n) + 1),
cand AS (SELECT DISTINCT x.doc_id AS a, y.doc_id AS b, x.n AS na, y.n AS nb FROM p x JOIN p y ON x.sh = y.sh AND x.doc_id < y.doc_id AND 100 * least(x.n, y.n) >= 85 * greatest(x.n, y.n)),
j AS (SELECT a, b, na, nb, count(*) AS i FROM cand JOIN s x ON x.doc_id = a JOIN s y ON y.doc_id = b AND y.sh = x.sh GROUP BY ALL),
e AS (SELECT a, b FROM j WHERE 100 * i >= 85 * (na + nb - i)),
both_ AS (SELECT a, b FROM e UNION ALL SELECT b, a FROM e),
reach AS (SELECT a AS doc_id, a AS c FROM both_ UNION SELECT reach.doc_id, both_.b FROM reach JOIN both_ ON both_.a = reach.c),
comp AS (SELECT doc_id, min(c) AS c FROM reach GROUP BY doc_id)
SELECT documents.doc_id, coalesce(n.n, 0)::BIGINT AS n_shingles, coalesce(comp.c, documents.doc_id) AS component_id
FROM documents LEFT JOIN n USING (doc_id) LEFT JOIN comp USING (doc_id)"""
}
