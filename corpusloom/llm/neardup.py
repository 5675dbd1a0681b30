"""Near-duplicate documents by MinHash and an LSH forest.

A document is its set of distinct word shingles.  Equal sets are one class
from the start, found by a digest.  Each class has a signature of TREES *
DEPTH minimum hashes; a tree orders the classes by its own sequence of them.

1. Candidates.  In every tree a class looks at its neighbours on both sides of
   the order and at the length of the prefix it shares with them.  Of all its
   neighbours in all trees it takes those with the longest common prefixes
   first, so the depth it goes down to, or up to, is that of its own region:
   deep where copies crowd, down to DEPTH where it has hardly any company.  Of
   these PROBES the FIRST_TRIES with the most alike signatures are confirmed on the full sets.
2. The rest, exactly.  In regions (DEPTH equal leading hashes) that the confirmed links leave in
   several components, every class outside the region's largest component is
   compared on the full sets with the classes of other components.  Regions of
   more than ``block`` classes are cut into pieces by set size and a hash, and two pieces meet
   in a task only if their sizes allow a link; inside, a prefix filter on the rarest
   shingles picks who is compared.  One link between two components is enough, so no table of pairs is made.

Components of the confirmed links are found by joins.  Nothing is capped; a
pair of exactly the threshold misses all TREES regions with probability
(1 - threshold**DEPTH)**TREES, 3e-6 at 0.8.

Defined edge cases: null, empty and wordless texts have no shingles and stay
alone (component: their own doc_id); texts of fewer words than a shingle are
one shingle; documents without doc_id count as members, but the component takes
its smallest non-null doc_id; repeated rows and repeated doc_ids are members
each; an empty table gives an empty result.  Extra columns are ignored by
``near_duplicates`` and kept, whatever their names, by ``drop_near_duplicates``.
"""

from __future__ import annotations

import functools
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from corpusloom.llm.common import free_names, materialize, table
from corpusloom.llm.components import components

TREES = 32
DEPTH = 5
HASHES = TREES * DEPTH
LANES = 4  # further hashes of a tree's order, 16 bits of each
PROBES = 6
FIRST_TRIES = 2
BLOCK_ROWS = 512
SLACK = 0.12  # signatures of HASHES values are off by more than this in 1 of 7000 cases
MASK = (1 << 64) - 1
_rng = np.random.RandomState(97)
FACTORS = _rng.randint(0, 1 << 62, HASHES, dtype=np.int64).astype(np.uint64) * np.uint64(2) + np.uint64(1)


@functools.lru_cache(maxsize=1 << 18)
def _word_hash(word: bytes) -> int:
    return xxhash.xxh3_64_intdigest(word)


def _stir(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(32))


def shingle_set(text: bytes, width: int) -> np.ndarray:
    """Sorted 64-bit hashes of the distinct shingles; A-Z lower-cased, words apart by space and \\x09-\\x0D."""
    words = text.lower().split()
    h = np.fromiter(map(_word_hash, words), np.uint64, len(words))
    n = len(h) - width + 1
    if not len(h):
        return h
    if n <= 0:
        n, width = 1, len(h)
    out = np.full(n, np.uint64(width), np.uint64)
    for j in range(width):
        out = _stir(out * np.uint64(0x9E3779B97F4A7C15) + h[j : j + n])
    return np.unique(out)


def signature(shingles: np.ndarray) -> np.ndarray:
    """HASHES minimum hashes, 32 bits each."""
    low = np.full(HASHES, MASK, np.uint64)
    for s in range(0, len(shingles), 256):
        np.minimum(low, (shingles[None, s : s + 256] * FACTORS[:, None]).min(axis=1), out=low)
    return (low >> np.uint64(32)).astype(np.uint32)


def _bytes(value: pa.Scalar) -> bytes:
    return value.as_buffer().to_pybytes() if value.is_valid else b""


def sketches(docs: DataFrame, width: int) -> DataFrame:
    """(doc_id, fp, n, digest, sig) per row; fp is a hash of the text, digest one of the set."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            n, digest, sig = [], [], []
            for t in b.column("text"):
                s = shingle_set(_bytes(t), width)
                n.append(len(s))
                digest.append(xxhash.xxh3_128_digest(s.tobytes()) if len(s) else None)
                sig.append(signature(s).tobytes() if len(s) else None)
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("fp"), pa.array(n, pa.int64()), pa.array(digest, pa.binary()), pa.array(sig, pa.binary())], names=["doc_id", "fp", "n", "digest", "sig"])

    text = F.col("text").cast("string")
    source = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(text).alias("fp"), text.alias("text"))
    return source.mapInArrow(run, "doc_id long, fp long, n long, digest binary, sig binary")


def tree_rows(classes: DataFrame) -> DataFrame:
    """(region, deeper, cid): per class and tree a hash of the tree and its DEPTH leading values, and the next LANES in one number."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            cids = b.column("cid").to_numpy(zero_copy_only=False)
            if not len(cids):
                continue
            sigs = np.stack([np.frombuffer(_bytes(s), np.uint32) for s in b.column("sig")]).astype(np.uint64)
            for t in range(TREES):
                order = np.arange(t * DEPTH, t * DEPTH + DEPTH + LANES) % HASHES
                key = np.full(len(cids), np.uint64(t + 1), np.uint64)
                for j in order[:DEPTH]:
                    key = _stir(key * np.uint64(0x9E3779B97F4A7C15) + sigs[:, j])
                deeper = np.zeros(len(cids), np.uint64)
                for j in order[DEPTH:]:
                    deeper = (deeper << np.uint64(16)) | (sigs[:, j] & np.uint64(0xFFFF))
                yield pa.RecordBatch.from_arrays([pa.array(key.view(np.int64)), pa.array(deeper.view(np.int64)), pa.array(cids)], names=["region", "deeper", "cid"])

    return classes.select("cid", "sig").mapInArrow(run, "region long, deeper long, cid long")


def common_prefix(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Length of the common prefix of two places of one region."""
    differ = (x ^ y).view(np.uint64)
    return DEPTH + sum((differ >> np.uint64(16 * lane) == 0).astype(np.int64) for lane in range(LANES))


def region_members(rows: DataFrame) -> DataFrame:
    """(region, cid, one, one_depth, two, two_depth): the classes of regions with company, and the two before in the order with their common prefixes."""
    names = ["region", "cid", "one", "one_depth", "two", "two_depth"]

    def told(r: np.ndarray, d: np.ndarray, c: np.ndarray, lo: int, hi: int) -> pa.RecordBatch:
        """The rows lo..hi, with what stands before and after them in view."""
        columns: list[pa.Array] = []
        same = r[1:] == r[:-1]
        company = np.concatenate([[False], same]) | np.concatenate([same, [False]])
        at = np.flatnonzero(company[lo:hi]) + lo
        for back in (1, 2):
            prior = np.maximum(at - back, 0)
            none = (at < back) | (r[prior] != r[at])
            columns += [pa.array(c[prior], mask=none), pa.array(common_prefix(d[prior], d[at]), mask=none)]
        return pa.RecordBatch.from_arrays([pa.array(r[at]), pa.array(c[at]), *columns], names=names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        r = d = c = np.empty(0, np.int64)
        told_to = 0  # the rows before this one in r, d, c are told already; two of them stay in view
        for b in batches:
            r, d, c = (np.concatenate([x, b.column(n).to_numpy()]) for x, n in zip((r, d, c), ("region", "deeper", "cid")))
            if len(r) - 1 > told_to:  # the last row waits for its successor
                yield told(r, d, c, told_to, len(r) - 1)
                cut = max(0, len(r) - 3)
                r, d, c, told_to = r[cut:], d[cut:], c[cut:], len(r) - 1 - cut
        if len(r) > told_to:
            yield told(r, d, c, told_to, len(r))

    ordered = rows.repartition("region").sortWithinPartitions("region", "deeper", "cid")
    return ordered.mapInArrow(run, "region long, cid long, one long, one_depth long, two long, two_depth long")


def candidates(members: DataFrame) -> DataFrame:
    """(a, b): of each class the PROBES neighbours with the longest common prefixes over all trees."""
    near = [members.filter(f"{n} is not null").select(F.least("cid", n).alias("a"), F.greatest("cid", n).alias("b"), F.col(f"{n}_depth").alias("depth")) for n in ("one", "two")]
    pairs = near[0].union(near[1]).groupBy("a", "b").agg(F.sum("depth").alias("depth"))
    both = pairs.union(pairs.select("b", "a", "depth"))
    place = Window.partitionBy("a").orderBy(F.desc("depth"), "b")
    best = both.withColumn("k", F.row_number().over(place)).filter(F.col("k") <= PROBES)
    return best.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def estimates(pairs: DataFrame, small: DataFrame) -> DataFrame:
    """(a, b, guess): share of equal signature values; small: cid, low (one byte per value)."""
    left, right = small.select(F.col("cid").alias("a"), F.col("low").alias("sa")), small.select(F.col("cid").alias("b"), F.col("low").alias("sb"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            n = b.num_rows
            if n:
                x = np.frombuffer(b"".join(_bytes(v) for v in b.column("sa")), np.uint8).reshape(n, -1)
                y = np.frombuffer(b"".join(_bytes(v) for v in b.column("sb")), np.uint8).reshape(n, -1)
                guess = (x == y).mean(axis=1)
                yield pa.RecordBatch.from_arrays([b.column("a"), b.column("b"), pa.array(guess)], names=["a", "b", "guess"])

    return pairs.join(left, "a").join(right, "b").select("a", "b", "sa", "sb").mapInArrow(run, "a long, b long, guess double")


def meetings(known: DataFrame, percent: int, block: int) -> DataFrame:
    """(meeting, side, component, cid, asks): who meets whom; known: region, cid, n, component.

    Members outside a region's largest component ask.  A region of at most ``block`` members is one meeting, all on side 0.
    In larger ones a meeting is a piece that asks (side 0) with itself or with another piece (side 1) of a set size near enough.
    """
    counts = known.groupBy("region", "component").agg(F.count(F.lit(1)).alias("c"))
    split = counts.groupBy("region").agg(F.max(F.struct("c", "component")).alias("m"), F.sum("c").alias("members"), F.count(F.lit(1)).alias("parts")).filter("parts > 1")
    split = split.select("region", F.col("m.component").alias("largest"), "members")
    placed = known.join(split, "region").withColumn("asks", F.col("component") != F.col("largest")).drop("largest")
    columns = ["meeting", "side", "component", "cid", "asks"]
    small = placed.filter(F.col("members") <= block).withColumn("meeting", F.xxhash64("region")).withColumn("side", F.lit(0)).select(*columns)

    ratio = math.log(100 / percent) * (1 + 1e-9) if percent < 100 else 1e-12  # sizes of linked sets are one step apart at most
    step = F.floor(F.log("n") / F.lit(ratio)) if percent < 100 else F.col("n")
    large = placed.filter(F.col("members") > block).withColumn("step", step.cast("long"))
    rooms = large.groupBy("region", "step", "asks").agg(F.ceil(F.count(F.lit(1)) / F.lit(block / 2)).cast("int").alias("pieces"))
    large = large.join(rooms, ["region", "step", "asks"]).withColumn("piece", F.pmod(F.xxhash64("cid"), F.col("pieces")).cast("int"))
    large = large.withColumn("pid", F.xxhash64("region", "step", "asks", "piece"))
    pieces = rooms.withColumn("piece", F.explode(F.sequence(F.lit(0), F.col("pieces") - 1))).withColumn("pid", F.xxhash64("region", "step", "asks", "piece"))
    asking = pieces.filter("asks").select("region", F.explode(F.array(F.col("step") - 1, F.col("step"), F.col("step") + 1)).alias("step"), F.col("pid").alias("x"))
    pairs = asking.join(pieces.select("region", "step", F.col("asks").alias("both"), F.col("pid").alias("y")), ["region", "step"])
    pairs = pairs.filter(~F.col("both") | (F.col("x") <= F.col("y"))).select(F.xxhash64("x", "y").alias("meeting"), "x", "y")
    sides = pairs.select("meeting", F.col("x").alias("pid"), F.lit(0).alias("side")).union(pairs.filter("x <> y").select("meeting", "y", F.lit(1)))
    return small.union(large.join(sides, "pid").select(*columns))


def links_of(rows: list[tuple[int, int, int, bool, bytes]], percent: int) -> list[tuple[int, int]]:
    """Links of one meeting, (cid, cid), one for each two components at most; rows: side, component, cid, asks, set."""
    sets = [np.frombuffer(r[4], np.uint64) for r in rows]
    sizes = np.array([len(x) for x in sets])
    tokens, owner = np.concatenate(sets), np.repeat(np.arange(len(sets)), sizes)
    _, token, count = np.unique(tokens, return_inverse=True, return_counts=True)
    by_token = np.argsort(token, kind="stable")
    posted, begins = owner[by_token], np.concatenate([[0], np.cumsum(count)])
    rare = np.lexsort((token, count[token], owner))  # each set, its rarest shingles first
    starts = np.concatenate([[0], np.cumsum(sizes)])
    place = np.arange(len(rare)) - np.repeat(starts[:-1], sizes)
    first = place < np.repeat(sizes - (percent * sizes + 99) // 100 + 1, sizes)  # two linked sets share one of these
    in_prefix = np.zeros(len(rare), bool)
    in_prefix[rare[first]] = True
    listed = in_prefix[by_token]
    led = posted[listed]  # owners by token, prefixes only
    led_begins = np.concatenate([[0], np.cumsum(listed)])[begins]
    side, comp, cid = (np.array([r[i] for r in rows]) for i in range(3))
    asks, crossing = np.array([r[3] for r in rows]), side.any()
    _, comp = np.unique(comp, return_inverse=True)
    root = list(range(comp.max() + 1))

    def find(x: int) -> int:
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    out = []
    for i in np.flatnonzero(asks & (side == 0)).tolist():
        own = token[starts[i] : starts[i + 1]]
        head = token[rare[starts[i] : starts[i + 1]][first[starts[i] : starts[i + 1]]]]
        lo, n = led_begins[head], led_begins[head + 1] - led_begins[head]
        met = np.unique(led[np.repeat(lo - np.cumsum(n) + n, n) + np.arange(n.sum())])
        met = met[(comp[met] != comp[i]) & ((side[met] == 1) if crossing else (~asks[met] | (met > i)))]
        met = met[100 * np.minimum(sizes[met], sizes[i]) >= percent * np.maximum(sizes[met], sizes[i])]
        if len(met) > 64:  # count all shared shingles at once
            lo, n = begins[own], count[own]
            both = np.bincount(posted[np.repeat(lo - np.cumsum(n) + n, n) + np.arange(n.sum())], minlength=len(rows))[met]
            met = met[100 * both >= percent * (sizes[met] + sizes[i] - both)]
        sure = len(met) <= 64
        for j in met.tolist():
            x, y = find(comp[i]), find(comp[j])
            if x == y:
                continue
            if sure:
                both = len(np.intersect1d(sets[i], sets[j], assume_unique=True))
                if 100 * both < percent * (sizes[i] + sizes[j] - both):
                    continue
            root[x] = y
            out.append((min(int(cid[i]), int(cid[j])), max(int(cid[i]), int(cid[j]))))
    return out


def divided_regions(members: DataFrame, labels: DataFrame, sets: DataFrame, percent: int, block: int = BLOCK_ROWS) -> DataFrame:
    """(a, b): links between components that share a region, confirmed on the full sets where their pieces meet."""
    known = members.select("region", "cid").join(labels.withColumnRenamed("node", "cid"), "cid", "left")
    known = known.withColumn("component", F.coalesce("component", "cid")).join(sets.select("cid", (F.octet_length("shingles") / 8).cast("long").alias("n")), "cid")
    rows = meetings(known, percent, block).join(sets, "cid")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def batch(links: list[tuple[int, int]]) -> pa.RecordBatch:
            a, b = zip(*links) if links else ((), ())
            return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])

        at, group = None, []
        for b in batches:
            for meeting, *row in zip(*(b.column(n).to_pylist() for n in ("meeting", "side", "component", "cid", "asks", "shingles"))):
                if meeting != at:
                    if group:
                        yield batch(links_of(group, percent))
                    at, group = meeting, []
                group.append(tuple(row))
        if group:
            yield batch(links_of(group, percent))

    ordered = rows.repartition("meeting").sortWithinPartitions("meeting")
    return ordered.mapInArrow(run, "a long, b long").distinct()


def shingle_sets(docs: DataFrame, classes: DataFrame, width: int) -> DataFrame:
    """(cid, shingles): the sorted set of each given class, read again from one of its documents."""
    text = F.col("text").cast("string")
    far = F.lit((1 << 63) - 1)
    source = docs.select(F.coalesce(F.col("doc_id").cast("long"), far).alias("_id"), F.xxhash64(text).alias("_fp"), text.alias("text"))
    one = source.join(classes.select("cid", "rep"), (F.col("_id") == F.col("rep.id")) & (F.col("_fp") == F.col("rep.fp"))).select("cid", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            sets = [shingle_set(_bytes(t), width).tobytes() for t in b.column("text")]
            yield pa.RecordBatch.from_arrays([b.column("cid"), pa.array(sets, pa.binary())], names=["cid", "shingles"])

    return one.mapInArrow(run, "cid long, shingles binary").dropDuplicates(["cid"])


def confirm(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """(a, b): the pairs whose full sets have 100 * intersection >= percent * union."""
    left, right = sets.select(F.col("cid").alias("a"), F.col("shingles").alias("sa")), sets.select(F.col("cid").alias("b"), F.col("shingles").alias("sb"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            good = []
            for x, y in zip(batch.column("sa"), batch.column("sb")):
                p, q = np.frombuffer(_bytes(x), np.uint64), np.frombuffer(_bytes(y), np.uint64)
                both = len(np.intersect1d(p, q, assume_unique=True)) if 100 * min(len(p), len(q)) >= percent * max(len(p), len(q)) else 0
                good.append(100 * both >= percent * (len(p) + len(q) - both))
            kept = batch.select(["a", "b"]).filter(pa.array(good, pa.bool_()))
            yield kept

    return pairs.join(left, "a").join(right, "b").select("a", "b", "sa", "sb").mapInArrow(run, "a long, b long")


def _labelled(docs: DataFrame, width: int, percent: int, block: int = BLOCK_ROWS) -> DataFrame:
    """One row per document: doc_id, fp, n, digest, group, component_id; no group where a text has no shingles.

    group is an id of the component, also where none of its documents has a doc_id.
    """
    sketch = materialize(sketches(docs, width), "sketch")
    rep = F.min(F.struct(F.coalesce("doc_id", F.lit((1 << 63) - 1)).alias("id"), "fp")).alias("rep")
    grouped = sketch.filter("digest is not null").groupBy("digest").agg(F.min("doc_id").alias("first_id"), rep, F.first("sig").alias("sig"))
    classes = materialize(grouped.withColumn("cid", F.monotonically_increasing_id()), "classes")
    members = materialize(region_members(tree_rows(classes)), "members")

    def shorten(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            lows = [np.frombuffer(_bytes(s), np.uint8)[::4].tobytes() for s in b.column("sig")]
            yield pa.RecordBatch.from_arrays([b.column("cid"), pa.array(lows, pa.binary())], names=["cid", "low"])

    crowd = members.select("cid").distinct()
    small = materialize(classes.select("cid", "sig").join(crowd, "cid", "left_semi").mapInArrow(shorten, "cid long, low binary"), "low")
    floor = percent / 100 - SLACK
    guessed = materialize(estimates(candidates(members), small).filter(F.col("guess") >= floor), "guess")
    both = guessed.select("a", "b", "guess").union(guessed.select("b", "a", "guess"))
    best = both.withColumn("k", F.row_number().over(Window.partitionBy("a").orderBy(F.desc("guess"), "b"))).filter(F.col("k") <= FIRST_TRIES)
    tries = best.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    sets = materialize(shingle_sets(docs, classes.join(crowd, "cid", "left_semi"), width), "sets")
    links = materialize(confirm(tries, sets, percent), "links")
    label = components(links)
    stars = label.filter("node <> component").select(F.col("component").alias("a"), F.col("node").alias("b"))  # they connect what the links do
    links = stars.union(divided_regions(members, label, sets, percent, block))

    label = components(materialize(links, "links"))
    label = label.withColumnRenamed("node", "cid")
    firsts = classes.select("cid", "first_id").join(label, "cid").groupBy("component").agg(F.min("first_id").alias("component_id"))
    firsts = materialize(firsts, "firsts")  # written, so that a join may split the rows of a large component
    named = classes.select("digest", "first_id", "cid").join(label, "cid", "left").withColumn("group", F.coalesce("component", "cid"))
    named = named.join(firsts.withColumnRenamed("component", "group"), "group", "left")
    named = named.select("digest", "group", F.coalesce("component_id", "first_id").alias("component_id"))
    return sketch.select("doc_id", "fp", "n", "digest").join(named, "digest", "left")


def near_duplicates(docs: DataFrame, width: int = 5, percent: int = 80, block: int = BLOCK_ROWS) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id, kept."""
    out = _labelled(docs, width, percent, block)
    component = F.when(F.col("digest").isNull(), F.col("doc_id")).otherwise(F.col("component_id"))
    return out.select("doc_id", F.col("n").alias("n_shingles"), component.alias("component_id"), F.col("doc_id").eqNullSafe(component).alias("kept"))


def drop_near_duplicates(docs: DataFrame, width: int = 5, percent: int = 80) -> DataFrame:
    """The documents that stay: one row of each group, that with the smallest doc_id (nulls last, then by a hash of the
    text), and all rows without shingles; columns as given."""
    (row,) = free_names(docs, "_row")
    numbered = materialize(docs.withColumn(row, F.monotonically_increasing_id()), "rows")
    rows = numbered.select(F.col(row).alias("row"), F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(F.col("text").cast("string")).alias("fp"))
    far = F.lit((1 << 63) - 1)
    first = F.min(F.struct(F.coalesce("doc_id", far).alias("id"), F.col("doc_id").isNull().alias("none"), "fp")).alias("f")
    labelled = materialize(_labelled(numbered, width, percent), "labelled")
    chosen = labelled.filter("digest is not null").groupBy("group").agg(first).select("f.id", "f.none", F.col("f.fp").alias("hash"))
    same = (F.coalesce("doc_id", far) == F.col("id")) & (F.col("doc_id").isNull() == F.col("none")) & (F.col("fp") == F.col("hash"))
    whole = rows.join(chosen, same).groupBy("id", "none", "hash").agg(F.min("row").alias("row"))
    bare = labelled.filter("digest is null").select("fp").distinct()  # hashes of texts without words
    stay = whole.select("row").unionByName(rows.join(bare, "fp", "left_semi").select("row"))
    return numbered.join(stay.withColumnRenamed("row", row), row, "left_semi").drop(row)


def op3_lsh_forest_neardup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"), width=2, percent=80)


QUERIES = {"op3_lsh_forest_neardup": op3_lsh_forest_neardup}
ORACLES = {
    "op3_lsh_forest_neardup": r"""
WITH RECURSIVE w AS (
  SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS l FROM documents),
s AS (SELECT DISTINCT doc_id, sh FROM (
  SELECT doc_id, unnest(CASE WHEN len(l) >= 2 THEN [l[i] || ' ' || l[i + 1] for i in range(1, len(l))] ELSE l END) AS sh FROM w)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
df AS (SELECT sh, count(*) AS c FROM s GROUP BY sh),
r AS (SELECT s.doc_id, s.sh, n.n, row_number() OVER (PARTITION BY s.doc_id ORDER BY df.c, s.sh) AS k FROM s JOIN df USING (sh) JOIN n USING (doc_id)),
p AS (SELECT doc_id, sh, n FROM r WHERE k <= n - ceil(0.8 * n) + 1),
cand AS (SELECT DISTINCT x.doc_id AS a, y.doc_id AS b, x.n AS na, y.n AS nb FROM p x JOIN p y ON x.sh = y.sh AND x.doc_id < y.doc_id AND 10 * least(x.n, y.n) >= 8 * greatest(x.n, y.n)),
j AS (SELECT a, b, na, nb, count(*) AS i FROM cand JOIN s x ON x.doc_id = a JOIN s y ON y.doc_id = b AND y.sh = x.sh GROUP BY ALL),
e AS (SELECT a, b FROM j WHERE 100 * i >= 80 * (na + nb - i)),
both_ AS (SELECT a, b FROM e UNION ALL SELECT b, a FROM e),
reach AS (SELECT a AS doc_id, a AS c FROM both_ UNION SELECT reach.doc_id, both_.b FROM reach JOIN both_ ON both_.a = reach.c),
comp AS (SELECT doc_id, min(c) AS c FROM reach GROUP BY doc_id)
SELECT documents.doc_id, coalesce(n.n, 0)::BIGINT AS n_shingles, coalesce(comp.c, documents.doc_id) AS component_id,
  coalesce(comp.c, documents.doc_id) = documents.doc_id AS kept
FROM documents LEFT JOIN n USING (doc_id) LEFT JOIN comp USING (doc_id)"""
}
