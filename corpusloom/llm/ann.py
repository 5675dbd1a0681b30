"""Approximate nearest neighbours by inner product: a hierarchical navigable small-world graph per shard.

Equal vectors are one node, which keeps its k + 1 smallest ids: no larger one
can be among the k nearest of any query.  Nodes are dealt to the cells of
centroids that are fitted on at most SAMPLE_ROWS nodes, and a cell of more than
``shard_rows`` nodes to several shards.  In a shard nodes get a level by a
hash, and each level is a graph into which they are inserted in batches: a
batch looks for its neighbours by beam search over the graph so far, links to a
diverse choice of what it finds, and is linked back.  A shard is stored as one
row of flat arrays (ids, vectors, neighbours per level).

A query visits the shards of its own cell first.  It then goes on to every
other cell whose bound - inner product with the centroid plus query length
times radius of the cell - leaves room for something nearer than what it has,
so cells are left out only where they provably hold nothing.  Shards stay where
they are and queries are sent to them, in slices of bounded size; what the
shards find is merged by (score, vec_id).  Inner product is made a distance by
one extra coordinate that gives all vectors of a shard the same length.

Defined edge cases: vectors that are null, empty, zero or hold null or
non-finite components take no part, nor do rows without vec_id; a vector is
compared with those of its own length only; rows equal in vec_id and vector
are one; a vec_id that occurs with several vectors is answered for each of
them (ranks begin anew) and never returned to itself; ties go to the smaller
vec_id; with fewer than k candidates all are returned; an empty table gives an
empty result.  Extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from corpusloom.llm.common import materialize, table

SHARD_ROWS = 8192
MAX_CELLS = 4096
SAMPLE_ROWS = 40_000
SLICE_ROWS = 8192
LINKS = 14  # neighbours a node chooses
ROOM = 40  # neighbours a node can have
BUILD_BEAM = 48
BEAM = 96
STRIDE = 4  # nodes of the beam that are opened at once
INDEX = "cell int, part int, dims int, ids binary, starts binary, vectors binary, levels array<binary>, graphs array<binary>"
FOUND = "qkey long, vec_id long, score double"


def usable(vector: Column) -> Column:
    v = vector.cast("array<double>")
    bad = F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return v.isNotNull() & (F.size(v) > 0) & ~F.coalesce(bad, F.lit(True)) & F.exists(v, lambda x: x != 0)


# --- one shard, in numpy


def beam_search(space: np.ndarray, graph: np.ndarray, queries: np.ndarray, entry: np.ndarray, beam: int) -> np.ndarray:
    """Nodes [q, beam] by falling inner product, -1 where fewer are reached; 256 queries in step."""
    out = [_walk(space, graph, queries[s : s + 256], entry[s : s + 256], min(beam, len(space))) for s in range(0, len(queries), 256)]
    return np.concatenate(out)


def _walk(space: np.ndarray, graph: np.ndarray, queries: np.ndarray, entry: np.ndarray, beam: int) -> np.ndarray:
    q, n = len(queries), len(space)
    nodes, scores = np.full((q, beam), n, np.int32), np.full((q, beam), -np.inf, np.float32)
    fresh, seen = np.zeros((q, beam), bool), np.zeros((q, n + 1), bool)
    seen[:, n] = True
    rows = np.arange(q)
    nodes[:, 0], fresh[:, 0], seen[rows, entry] = entry, True, True
    scores[:, 0] = np.einsum("ij,ij->i", queries, space[entry])
    while len(rows):
        f = fresh[rows]
        at = np.argsort(~f, axis=1, kind="stable")[:, : min(STRIDE, beam)]  # the best that are not open yet
        here = np.where(np.take_along_axis(f, at, 1), np.take_along_axis(nodes[rows], at, 1), -1)
        np.put_along_axis(f, at, False, 1)
        near = np.where((here >= 0)[:, :, None], graph[here], n).reshape(len(rows), -1)
        near[near < 0] = n
        near.sort(axis=1)
        new = ~seen[rows[:, None], near]
        new[:, 1:] &= near[:, 1:] != near[:, :-1]
        seen[rows[:, None], near] = True
        width = int(new.sum(axis=1).max())
        if width:
            front = np.argsort(~new, axis=1, kind="stable")[:, :width]
            near = np.where(np.take_along_axis(new, front, 1), np.take_along_axis(near, front, 1), n)
            s = np.matmul(space[np.where(near < n, near, 0)], queries[rows][:, :, None])[:, :, 0]
            s[near == n] = -np.inf
            scored, named = np.concatenate([scores[rows], s], 1), np.concatenate([nodes[rows], near], 1)
            top = np.argpartition(-scored, beam - 1, axis=1)[:, :beam]
            top = np.take_along_axis(top, np.argsort(-np.take_along_axis(scored, top, 1), axis=1, kind="stable"), 1)
            scores[rows], nodes[rows] = np.take_along_axis(scored, top, 1), np.take_along_axis(named, top, 1)
            f = np.take_along_axis(np.concatenate([f, near < n], 1), top, 1)
        fresh[rows] = f
        rows = rows[f.any(axis=1)]
    return np.where(nodes < n, nodes, -1)


def by_nearness(space: np.ndarray, centre: np.ndarray, cand: np.ndarray) -> np.ndarray:
    """The candidates [b, c] of each node, nearest first; -1 last."""
    s = np.matmul(space[np.maximum(cand, 0)], space[centre][:, :, None])[:, :, 0]
    s[cand < 0] = -np.inf
    return np.take_along_axis(cand, np.argsort(-s, axis=1, kind="stable"), 1)


def diverse(space: np.ndarray, centre: np.ndarray, cand: np.ndarray, keep: int) -> np.ndarray:
    """Of candidates nearest first: those nearer to the node than to any chosen one, then the nearest others; ``keep`` in all."""
    out = np.full((len(cand), keep), -1, np.int32)
    for s in range(0, len(cand), 512):
        c = cand[s : s + 512]
        valid, g = c >= 0, space[np.maximum(c, 0)]
        own = np.matmul(g, space[centre[s : s + 512]][:, :, None])[:, :, 0]
        nearer = np.matmul(g, g.transpose(0, 2, 1)) > own[:, :, None]
        kept = np.zeros(c.shape, bool)
        for k in range(c.shape[1]):
            kept[:, k] = valid[:, k] & ~(nearer[:, k, :k] & kept[:, :k]).any(axis=1)
        order = np.argsort(np.where(kept, 0, np.where(valid, 1, 2)), axis=1, kind="stable")[:, :keep]
        got = np.take_along_axis(c, order, 1)
        out[s : s + 512, : got.shape[1]] = got
    return out


def link(space: np.ndarray, graph: np.ndarray, used: np.ndarray, own: np.ndarray, chosen: np.ndarray) -> None:
    """Write the links of the new nodes ``own`` and the links back to them; nodes without room choose anew."""
    graph[own, : chosen.shape[1]] = chosen
    used[own] = (chosen >= 0).sum(axis=1)
    to, back = chosen.ravel(), np.repeat(own, chosen.shape[1])
    real = to >= 0
    to, back = to[real], back[real]
    real = ~(graph[to] == back[:, None]).any(axis=1)
    to, back = to[real], back[real]
    order = np.lexsort((-np.einsum("ij,ij->i", space[to], space[back]), to))
    to, back = to[order], back[order]
    start = np.ones(len(to), bool)
    start[1:] = to[1:] != to[:-1]
    rank = np.arange(len(to)) - np.maximum.accumulate(np.where(start, np.arange(len(to)), 0))
    slot = used[to] + rank
    full = np.unique(to[slot >= ROOM])
    crowded = np.isin(to, full)
    graph[to[~crowded], slot[~crowded]] = back[~crowded]
    np.maximum.at(used, to[~crowded], slot[~crowded] + 1)
    if len(full):
        more = np.full((len(full), LINKS * 2), -1, np.int32)
        these = crowded & (rank < LINKS * 2)
        more[np.searchsorted(full, to[these]), rank[these]] = back[these]
        keep = diverse(space, full, by_nearness(space, full, np.concatenate([graph[full], more], 1)), ROOM * 3 // 4)
        graph[full] = -1
        graph[full, : keep.shape[1]] = keep
        used[full] = (keep >= 0).sum(axis=1)


def build_level(space: np.ndarray, seed: int) -> np.ndarray:
    """Flat neighbour array [n, ROOM] of one level, -1 fills; nodes are inserted in a random order, half as many at once as there are."""
    n = len(space)
    order = np.random.RandomState(seed).permutation(n)
    order = np.concatenate([[0], order[order != 0]])  # node 0 is where searches begin
    space = np.ascontiguousarray(space[order])
    graph, used, done = np.full((n, ROOM), -1, np.int32), np.zeros(n, np.int64), 0
    while done < n:
        own = np.arange(done, done + min(n - done, max(64, min(done // 2, 1024))))
        alike = space[own] @ space[own].T
        np.fill_diagonal(alike, -np.inf)
        cand = own[np.argsort(-alike, axis=1)[:, : min(len(own) - 1, 8 if done else BUILD_BEAM)]].astype(np.int32)
        if done:
            cand = np.concatenate([beam_search(space[:done], graph[:done], space[own], np.zeros(len(own), np.int64), BUILD_BEAM), cand], 1)
        if cand.shape[1]:
            link(space, graph, used, own, diverse(space, own, by_nearness(space, own, cand), LINKS))
        done += len(own)
    out = np.empty_like(graph)
    out[order] = np.where(graph >= 0, order[graph], -1)
    return out


class Shard:
    """ids by node, start of each node's ids, node vectors, node numbers per level and neighbours per level."""

    def __init__(self, ids: np.ndarray, starts: np.ndarray, vectors: np.ndarray, levels: list[np.ndarray] | None = None, graphs: list[np.ndarray] | None = None) -> None:
        self.ids, self.starts, self.vectors = ids, starts, vectors
        length = (vectors**2).sum(axis=1)
        self.space = np.hstack([vectors, np.sqrt(np.maximum(0, length.max() - length))[:, None]]).astype(np.float32)
        if levels is None or graphs is None:
            coin = ((ids[starts[:-1]].astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(32)).astype(np.float64) / 2**32
            level = np.minimum(6, (-np.log(np.maximum(coin, 1e-12)) / np.log(16)).astype(int))
            level[0] = level.max()
            levels = [np.flatnonzero(level >= h).astype(np.int32) for h in range(level.max() + 1)]
            graphs = [build_level(self.space[own], h) for h, own in enumerate(levels)]
        self.levels, self.graphs = levels, graphs

    def search(self, queries: np.ndarray, k: int, beam: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(query number, vec_id, score) of the best k per query, scored in double precision on the vectors given."""
        q = np.hstack([queries, np.zeros((len(queries), 1))]).astype(np.float32)
        at = np.zeros(len(q), np.int64)
        for h in range(len(self.levels) - 1, 0, -1):
            own = self.levels[h]
            best = beam_search(self.space[own], self.graphs[h], q, np.searchsorted(own, at), 8)[:, 0]
            at = own[best].astype(np.int64)
        nodes = beam_search(self.space, self.graphs[0], q, at, max(beam, k))
        row, col = np.nonzero(nodes >= 0)
        node = nodes[row, col]
        score = np.einsum("ij,ij->i", queries[row], self.vectors[node])
        many = (self.starts[node + 1] - self.starts[node]).astype(np.int64)
        pick = np.repeat(self.starts[node] - np.cumsum(many) + many, many) + np.arange(many.sum())
        row, vec, score = np.repeat(row, many), self.ids[pick], np.repeat(score, many)
        order = np.lexsort((vec, -score, row))
        row, vec, score = row[order], vec[order], score[order]
        rank = np.arange(len(row)) - np.searchsorted(row, row, "left")
        return row[rank < k], vec[rank < k], score[rank < k]


# --- the job


def _matrix(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    flat = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return np.asarray(flat.flatten(), np.float64).reshape(len(flat), -1) if len(flat) else np.empty((0, 0))


def fit_cells(nodes: DataFrame, cells: int, rows: int = SAMPLE_ROWS) -> np.ndarray:
    """Centroids of ``cells`` cells by Lloyd's rounds on at most ``rows`` nodes, chosen by hash."""
    v = _matrix(nodes.orderBy("h", "first").limit(min(rows, 64 * cells)).select("v").toArrow()["v"])
    centres = v[:cells].copy()
    for _ in range(6 if cells > 1 else 1):
        own = (v @ centres.T - (centres**2).sum(axis=1) / 2).argmax(axis=1)
        for c in range(len(centres)):
            if (own == c).any():
                centres[c] = v[own == c].mean(axis=0)
    return centres


def node_table(rows: DataFrame, k: int) -> DataFrame:
    """(h, v, first, ids): each distinct vector with its k smallest ids; rows: vec_id, v."""
    place = Window.partitionBy("h", "v").orderBy("vec_id")
    few = rows.withColumn("h", F.xxhash64("v")).dropDuplicates(["vec_id", "h", "v"]).withColumn("_k", F.row_number().over(place)).filter(F.col("_k") <= k)
    return few.groupBy("h", "v").agg(F.min("vec_id").alias("first"), F.sort_array(F.collect_list("vec_id")).alias("ids"))


def build_index(nodes: DataFrame, centres: np.ndarray, shard_rows: int) -> tuple[DataFrame, list[tuple[int, int, float]]]:
    """The shards as a written table of one row each, and (cell, shards, radius) of the cells."""
    sc = nodes.sparkSession.sparkContext
    sent = sc.broadcast(centres)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                v, c = _matrix(b.column("v")), sent.value
                own = (v @ c.T - (c**2).sum(axis=1) / 2).argmax(axis=1)
                far = np.sqrt(((v - c[own]) ** 2).sum(axis=1))
                yield pa.RecordBatch.from_arrays([*b.columns, pa.array(own.astype(np.int32)), pa.array(far)], names=[*b.schema.names, "cell", "far"])

    kind = nodes.schema["v"].dataType.simpleString()
    placed = materialize(nodes.mapInArrow(place, f"h long, v {kind}, first long, ids array<long>, cell int, far double"), "cells")
    cells = [(r["cell"], -(-r["n"] // shard_rows), r["far"]) for r in placed.groupBy("cell").agg(F.count(F.lit(1)).alias("n"), F.max("far").alias("far")).collect()]  # at most MAX_CELLS rows
    parts = F.broadcast(nodes.sparkSession.createDataFrame([(c, p) for c, p, _ in cells], "cell int, parts int"))
    dealt = placed.join(parts, "cell").withColumn("part", F.pmod("h", F.col("parts")).cast("int")).select("cell", "part", "first", "v", "ids")

    def build(group: pa.Table) -> pa.Table:
        group = group.combine_chunks().sort_by("first")
        vectors, lists = _matrix(group["v"]), group["ids"].combine_chunks()
        starts = np.concatenate([[0], np.cumsum(np.asarray(pc.list_value_length(lists), np.int64))])
        s = Shard(np.asarray(lists.flatten(), np.int64), starts, vectors)
        row = {"cell": group["cell"][0].as_py(), "part": group["part"][0].as_py(), "dims": vectors.shape[1], "ids": s.ids.tobytes(), "starts": s.starts.tobytes(), "vectors": vectors.tobytes()}
        row |= {"levels": [x.tobytes() for x in s.levels], "graphs": [g.tobytes() for g in s.graphs]}
        types = [pa.int32(), pa.int32(), pa.int32(), pa.binary(), pa.binary(), pa.binary(), pa.list_(pa.binary()), pa.list_(pa.binary())]
        return pa.Table.from_arrays([pa.array([row[n]], t) for n, t in zip(row, types)], names=list(row))

    shards = min(4000, 2 * sum(p for _, p, _ in cells))
    return materialize(dealt.repartition(shards, "cell", "part").groupBy("cell", "part").applyInArrow(build, INDEX), "hnsw"), cells


def search_shards(index: DataFrame, asked: DataFrame, k: int, beam: int, shards: int) -> DataFrame:
    """(qkey, vec_id, score): the best k of each (query, shard); asked: cell, part, slice, qkey, q, with the slices of a cell in ``slices``.

    A shard's row comes before its queries, which stream by in Arrow batches.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, at = None, None
        for b in batches:
            where = np.stack([b.column(c).to_numpy() for c in ("cell", "part", "slice")], 1)
            cuts = np.concatenate([[0], np.flatnonzero((where[1:] != where[:-1]).any(axis=1)) + 1, [len(where)]]) if len(where) else [0]
            for lo, hi in zip(cuts[:-1], cuts[1:]):
                if tuple(where[lo]) != at:
                    at = tuple(where[lo])
                    r = b.slice(lo, 1).select(["dims", "ids", "starts", "vectors", "levels", "graphs"]).to_pylist()[0]
                    graphs = [np.frombuffer(g, np.int32).reshape(-1, ROOM) for g in r["graphs"]]
                    shard = Shard(np.frombuffer(r["ids"], np.int64), np.frombuffer(r["starts"], np.int64), np.frombuffer(r["vectors"], np.float64).reshape(-1, r["dims"]), [np.frombuffer(x, np.int32) for x in r["levels"]], graphs)
                    lo += 1
                if lo < hi and shard is not None:
                    own = b.slice(lo, hi - lo)
                    row, vec, score = shard.search(_matrix(own.column("q")), k, beam)
                    yield pa.RecordBatch.from_arrays([own.column("qkey").take(pa.array(row)), pa.array(vec), pa.array(score)], names=["qkey", "vec_id", "score"])

    stored = index.join(F.broadcast(asked.select("cell", "slices").distinct()), "cell").withColumn("slice", F.explode(F.sequence(F.lit(0), F.col("slices") - 1))).drop("slices")
    both = stored.unionByName(asked.drop("slices"), allowMissingColumns=True)
    ordered = both.repartition(shards, "cell", "part", "slice").sortWithinPartitions("cell", "part", "slice", F.col("qkey").asc_nulls_first())
    return ordered.mapInArrow(run, FOUND)


def best_of(found: DataFrame, k: int) -> DataFrame:
    """(qkey, vec_id, score): the k best per query."""
    place = Window.partitionBy("qkey").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("_k", F.row_number().over(place)).filter(F.col("_k") <= k).drop("_k")


def search(index: DataFrame, centres: np.ndarray, cells: list[tuple[int, int, float]], queries: DataFrame, k: int, beam: int = BEAM) -> DataFrame:
    """(qkey, vec_id, score) of the k best found per query; queries: qkey, q."""
    spark = queries.sparkSession
    shards = min(4000, 2 * sum(p for _, p, _ in cells))
    sent = spark.sparkContext.broadcast((centres, cells))

    def route(home: bool):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            centres, cells = sent.value
            named, parts, radius = (np.array(x) for x in zip(*cells))
            c = centres[named]
            for b in batches:
                if not b.num_rows:
                    continue
                q = _matrix(b.column("q"))
                own = (q @ c.T - (c**2).sum(axis=1) / 2).argmax(axis=1)
                goes = np.zeros((len(q), len(c)), bool)
                goes[np.arange(len(q)), own] = True
                if not home:
                    length = np.sqrt((q**2).sum(axis=1))
                    bound = q @ c.T + length[:, None] * radius * (1 + 1e-9) + 1e-9
                    goes = ~goes & (bound >= np.asarray(b.column("floor").fill_null(-np.inf))[:, None])
                row, cell = np.nonzero(goes)
                many = parts[cell]
                row, cell = np.repeat(row, many), np.repeat(cell, many)
                part = np.arange(len(cell)) - np.repeat(np.cumsum(many) - many, many)
                yield pa.RecordBatch.from_arrays([pa.array(named[cell].astype(np.int32)), pa.array(part.astype(np.int32)), b.column("qkey").take(pa.array(row)), b.column("q").take(pa.array(row))], names=["cell", "part", "qkey", "q"])

        return run

    def visited(wanted: DataFrame, home: bool) -> DataFrame:
        asked = wanted.mapInArrow(route(home), f"cell int, part int, qkey long, q {queries.schema['q'].dataType.simpleString()}")
        counts = asked.groupBy("cell", "part").count().groupBy("cell").agg(F.ceil(F.max("count") / SLICE_ROWS).cast("int").alias("slices"))
        dealt = asked.join(F.broadcast(counts), "cell").withColumn("slice", F.pmod(F.xxhash64("qkey"), F.col("slices")).cast("int"))  # at most MAX_CELLS rows
        return best_of(search_shards(index, dealt, k, beam, shards), k)

    near = materialize(visited(queries, True), "near")
    if len(cells) < 2:
        return near
    floor = near.groupBy("qkey").agg(F.when(F.count(F.lit(1)) >= k, F.min("score")).alias("floor"))
    return best_of(near.unionByName(visited(queries.join(floor, "qkey", "left"), False)), k)


def nearest(vectors: DataFrame, k: int = 20, query_mod: int = 50, shard_rows: int = SHARD_ROWS, beam: int = BEAM) -> DataFrame:
    """(query_id, rank, vec_id, score): the k best per query, where the queries are the rows whose vec_id is divisible by ``query_mod``."""
    v = F.col("embedding")
    good = vectors.filter(usable(v) & F.col("vec_id").isNotNull()).select(F.col("vec_id").cast("long"), v.alias("v"), F.size(v).alias("dims"))
    empty = vectors.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    lengths = sorted(r["dims"] for r in good.select("dims").distinct().collect())  # one row per vector length
    for dims in lengths:
        rows = good.filter(F.col("dims") == dims).drop("dims")
        nodes = materialize(node_table(rows, k + 1), "nodes")
        cells = min(MAX_CELLS, -(-nodes.count() // shard_rows))
        asked = rows.filter(F.col("vec_id") % query_mod == 0).withColumn("h", F.xxhash64("v")).distinct()
        queries = materialize(asked.select("h", "v").distinct().withColumn("qkey", F.monotonically_increasing_id()), "queries")
        centres = fit_cells(nodes, cells)
        index, known = build_index(nodes, centres, shard_rows)
        best = search(index, centres, known, queries.select("qkey", F.col("v").alias("q")), k + 1, beam)
        entry = F.struct((-F.col("score")).alias("s"), "vec_id")
        listed = best.groupBy("qkey").agg(F.sort_array(F.collect_list(entry)).alias("all"))  # k + 1 entries
        each = asked.join(queries, ["h", "v"]).select(F.col("vec_id").alias("query_id"), "qkey").join(listed, "qkey")
        others = F.slice(F.filter("all", lambda e: e["vec_id"] != F.col("query_id")), 1, k)
        ranked = each.select("query_id", F.posexplode(others).alias("pos", "e"))
        out = ranked.select("query_id", (F.col("pos") + 1).alias("rank"), F.col("e.vec_id").alias("vec_id"), (-F.col("e.s")).alias("score"))
        empty = out if dims == lengths[0] else empty.unionByName(out)
    return empty


def op5_hnsw_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest(table(spark, sf_dir, "embeddings"), k=20, query_mod=20)


QUERIES = {"op5_hnsw_neighbours": op5_hnsw_neighbours}
ORACLES: dict[str, str] = {}
