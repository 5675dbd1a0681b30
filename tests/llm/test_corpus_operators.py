"""The corpus operators against brute force on small fixtures, and their edge cases."""

import hashlib
import random
import zlib

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusloom.llm import ann, decontaminate, mixing, neardup, quality, registry, repeats, sharding, toxicity, urlfilter, warc
from corpusloom.llm.common import new_path
from corpusloom.llm.components import components

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
HARD = [None, "", " \t\n", "one", "a b", "ünï © 漢字 " * 3, "x" * 5000, "the same text again and again " * 40]


def docs_of(spark, texts, sources=None, ids=None):
    ids = ids or range(len(texts))
    rows = [(i, t, "en", sources[k] if sources else "s", len(t or "")) for k, (i, t) in enumerate(zip(ids, texts))]
    return spark.createDataFrame(rows, DOCS)


def words_of(n, seed, vocabulary=400):
    r = random.Random(seed)
    return [f"w{r.randrange(vocabulary)}" for _ in range(n)]


def near_copies(count, seed):
    r = random.Random(seed)
    base = words_of(120, seed)
    out = []
    for k in range(count):
        w = list(base)
        for _ in range(k % 12):
            w[r.randrange(len(w))] = f"e{r.randrange(10**6)}"
        out.append(" ".join(w))
    return out


# --- sharding


def test_feistel_is_a_bijection_and_computable(spark):
    for n in (1, 2, 3, 7, 10, 97, 1000):
        got = [r[0] for r in spark.range(n).select(sharding.feistel(F.col("id"), n, 5)).collect()]
        assert sorted(got) == list(range(n))

    def spark_hash(*values):
        h = 42
        for v, size in values:
            h = xxhash.xxh64_intdigest(v.to_bytes(8, "little", signed=True), h) if size == 8 else _int_hash(v, h)
        return h - (1 << 64) if h >= 1 << 63 else h

    def _int_hash(v, seed):
        return xxhash.xxh64_intdigest((v & 0xFFFFFFFF).to_bytes(4, "little"), seed)

    n, seed = 1000, 5
    a, b, _ = sharding.grid(n)
    got = [r[0] for r in spark.range(n).orderBy("id").select(sharding.feistel(F.col("id"), n, seed)).collect()]

    def once(v):
        left, right = v // b, v % b
        for i in range(sharding.ROUNDS):
            left = (left + spark_hash((right, 8), (i, 8), (seed, 4)) % a) % a
            right = (right + spark_hash((left, 8), (i, 8), (seed + 1, 4)) % b) % b
        return left * b + right

    for x in (0, 1, 17, 999):
        y = once(x)
        while y >= n:
            y = once(y)
        assert got[x] == y


def test_shards_are_even_and_slots_have_no_gaps(spark):
    df = docs_of(spark, HARD * 9).drop("n_chars").withColumn("shard", F.lit("clash"))
    got = sharding.assign_shards(df, [F.col("doc_id").asc_nulls_first()]).collect()
    by = {}
    for r in got:
        by.setdefault(r["shard"], []).append(r["slot"])
    assert len(got) == 72 and all(sorted(v) == list(range(9)) for v in by.values())
    assert sharding.assign_shards(df.limit(0), [F.col("doc_id").asc()]).collect() == []


def test_op6_columns(spark, sf):
    got = registry.QUERIES["op6_feistel_sharding"](spark, sf).collect()
    texts = {r["doc_id"]: r["text"] or "" for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    assert all(r["size"] == len(texts[r["doc_id"]].encode()) + 1 and r["text_crc32"] == zlib.crc32(texts[r["doc_id"]].encode()) for r in got)
    assert {r["law"] for r in got} == {"rows"}


# --- mixing


def water_fill(sizes, weights, total):
    level, full = 0.0, set()
    while True:
        open_ = [s for s in sizes if s not in full]
        level = (total - sum(2 * sizes[s] for s in full)) / sum(weights[s] for s in open_)
        new = {s for s in open_ if level * weights[s] > 2 * sizes[s]}
        if not new:
            return {s: min(2.0 * sizes[s], level * weights[s]) if s not in full else 2.0 * sizes[s] for s in sizes}
        full |= new


def test_mix_meets_its_targets(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    got = mixing.mix(docs).collect()
    size = {}
    for r in docs.collect():
        size[r["source"]] = size.get(r["source"], 0) + len((r["text"] or "").encode().split())
    order = sorted(size)
    weights = {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)}
    want = water_fill(size, weights, 1.5 * sum(size.values()))
    for s in order:
        own = [r for r in got if r["source"] == s]
        assert all(abs(r["target"] - want[s]) < 1e-6 and r["source_size"] == size[s] for r in own)
        assert abs(sum(r["taken"] for r in own) - want[s]) <= max(r["size"] for r in own)
        assert all(r["taken"] <= 2 * r["size"] for r in own)
    again = mixing.mix(docs.repartition(3)).collect()
    assert sorted(map(tuple, again)) == sorted(map(tuple, got))


def test_flight_keeps_both_totals():
    r = np.random.RandomState(1)
    p, z = r.uniform(0, 1, 500), r.randint(1, 1000, 500)
    q = mixing.fly(p, z, 3)
    assert ((q > 0) & (q < 1)).sum() <= 2
    assert abs(q.sum() - p.sum()) < 1e-6 and abs((q * z).sum() - (p * z).sum()) < 1e-3


def test_mix_edge_cases(spark):
    got = mixing.mix(docs_of(spark, HARD * 2, sources=["b", None, "a", "a", None, "b", "a", "b"] * 2)).collect()
    assert len(got) == 16 and all(r["size"] == 0 for r in got if r["doc_id"] in (0, 1, 2))
    assert mixing.mix(docs_of(spark, HARD).limit(0)).collect() == []


# --- WARC


def test_mix_is_applied_by_row_where_ids_are_null_or_repeated(spark):
    texts = [" ".join(words_of(5 + k % 7, k)) for k in range(300)]
    docs = docs_of(spark, texts, [f"s{k % 4}" for k in range(300)], [None if k % 3 == 0 else k % 5 for k in range(300)])
    got = dict(map(tuple, mixing.apply_mix(docs).select("source", F.size(F.split("text", " ")).alias("n")).groupBy("source").agg(F.sum("n")).collect()))
    want = {r["source"]: r["target"] for r in mixing.source_targets(mixing.word_sizes(docs)).collect()}
    assert got.keys() == want.keys() and all(abs(got[s] - want[s]) <= 12 for s in want)


def test_warc_rejects_records_inside_payloads(spark):
    inner = "WARC/1.1\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:page:99>\r\nWARC-Payload-Digest: sha1:0\r\nWARC-Payload-Length: 0\r\nContent-Length: 0\r\n\r\n\r\n\r\n"
    pages = [(1, "http://a\r\nX: y", "é" * 700 + inner), (2, None, "é" * 700 + inner), (3, "u", None), (4, "u", ""), (5, "u", inner), (None, "u", "WARC/1.1\r\n")]
    df = spark.createDataFrame([(*p, 1) for p in pages], "page_id long, url string, html string, start int")
    path = new_path(spark, "warc-test")
    warc.write_archives(df, path, records_per_file=2)
    got = {r["page_id"]: r for r in warc.read_archives(spark, path).collect()}
    assert set(got) == {1, 2, 3, 4, 5, None} and all(r["digest_ok"] for r in got.values())
    for i, _, html in pages:
        assert got[i]["payload_digest"] == hashlib.sha1((html or "").encode()).hexdigest()
        assert got[i]["payload_bytes"] == len((html or "").encode())
    assert got[1]["record_type"] == "revisit" and got[1]["refers_to"] == 2 and got[2]["record_type"] == "response"
    assert got[3]["record_type"] == got[4]["record_type"] == "response"


@pytest.mark.parametrize("compression", ["none", "gzip"])
def test_warc_files_are_read_in_byte_ranges(spark, tmp_path, compression):
    """One file over many ranges, records with magic in their payloads across the ends of ranges, and magic in a url."""
    inner = "\r\n\r\nWARC/1.1\r\nWARC-Type: response\r\nContent-Length: {}\r\n\r\n\r\n\r\n"
    pages = [(i, f"http://u/{i}/WARC/1.1", None if i % 11 == 0 else f"<p>{i}</p>" + "xé" * (i * 37 % 900) + (inner.format(i % 9) * (i % 7) if i % 3 == 0 else "") + "\r\n" * (i % 4)) for i in range(300)]
    df = spark.createDataFrame(pages, "page_id long, url string, html string").coalesce(1)
    path = str(tmp_path / "w")
    warc.write_archives(df, path, compression=compression)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1777")
    try:
        cut = warc.pieces(spark, path)
        assert (cut.select("block").distinct().count() > 50) == (compression == "none")
        got = {r["page_id"]: r for r in warc.read_archives(spark, path).collect()}
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert len(got) == 300
    for i, url, html in pages:
        body = (html or "").encode()
        assert (got[i]["url"], got[i]["payload_bytes"], got[i]["payload_digest"], got[i]["digest_ok"]) == (url, len(body), hashlib.sha1(body).hexdigest(), True)


def test_a_truncated_archive_loses_its_last_record_only(spark, tmp_path):
    df = spark.createDataFrame([(i, "u", "p" * (i + 5)) for i in range(6)], "page_id long, url string, html string").coalesce(1)
    text = warc.END.join([*sorted(r["value"] for r in warc.records(df).collect()), ""]).encode()
    for name, cut in (("a", 0), ("b", 1), ("c", 30)):
        (tmp_path / f"{name}.warc").write_bytes(text[: len(text) - cut])
    found = warc.read_archives(spark, str(tmp_path / "*.warc")).groupBy("page_id").count().collect()
    assert {r["page_id"]: r["count"] for r in found} == {**{i: 3 for i in range(5)}, 5: 1}


def test_warc_with_clashing_columns_and_repeated_ids(spark):
    rows = [(1, "u", "x" * 1200, 7, "f"), (1, "u", "x" * 1200, 7, "f"), (0, "u", "x" * 1200, 8, "g")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, kept int, digest string")
    path = new_path(spark, "warc-test")
    warc.write_archives(df, path)
    got = sorted(tuple(r) for r in warc.read_archives(spark, path).select("page_id", "record_type", "refers_to").collect())
    assert got == [(0, "revisit", 1), (1, "response", None), (1, "response", None)]


def test_warc_of_no_pages(spark):
    df = spark.createDataFrame([], "page_id long, url string, html string")
    path = new_path(spark, "warc-test")
    warc.write_archives(df, path)
    assert warc.read_archives(spark, path).collect() == []


# --- decontamination


def test_decontamination_blocks_agree_and_edges(spark):
    bench = spark.createDataFrame([(1, " ".join(words_of(30, 1))), (10, " ".join(words_of(30, 1))), (2, "tiny Item"), (3, None), (4, "...")], "item_id long, text string")
    w = words_of(30, 1)
    texts = [*HARD, " ".join(words_of(50, 2) + w[3:17] + words_of(50, 3)), " ".join(w[:12]), "a TINY item, here", " ".join(w)]
    docs = docs_of(spark, texts)
    one = sorted(map(str, decontaminate.decontaminate(docs, bench).collect()))
    many = sorted(map(str, decontaminate.decontaminate(docs, bench, block_windows=3).collect()))
    assert one == many
    got = {r["doc_id"]: r for r in decontaminate.decontaminate(docs, bench).collect()}
    k = len(HARD)
    assert (got[k]["n_hit"], got[k]["item_ids"]) == (14, ["1", "10"]) and got[k]["contaminated"]
    assert got[k + 1]["n_hit"] == 0 and got[k + 2]["n_hit"] == 2 and got[k + 3]["n_hit"] == 30
    assert got[0]["n_words"] == 0 and not got[0]["contaminated"]
    kept = decontaminate.drop_contaminated(docs.withColumn("n_hit", F.lit("clash")), bench)
    assert kept.columns == [*docs.columns, "n_hit"] and {r["doc_id"] for r in kept.collect()} == set(range(len(texts))) - {k, k + 2, k + 3}


# --- near duplicates


def brute_components(texts, width, percent):
    sets = []
    for t in texts:
        w = (t or "").encode().lower().split()
        sets.append({tuple(w[i : i + width]) for i in range(len(w) - width + 1)} if len(w) >= width else ({tuple(w)} if w else set()))
    comp = list(range(len(texts)))

    def find(x):
        while comp[x] != x:
            x = comp[x]
        return x

    for i in range(len(texts)):
        for j in range(i):
            if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= percent * len(sets[i] | sets[j]):
                a, b = find(i), find(j)
                comp[max(a, b)] = min(a, b)
    return [(len(s), find(i)) for i, s in enumerate(sets)]


@pytest.mark.parametrize("width", [2, 5])
def test_near_duplicates_equal_brute_force(spark, width):
    texts = HARD + near_copies(60, 1) + near_copies(25, 2) + [" ".join(words_of(80, s)) for s in range(40)] + ["Same Words here"] * 30
    got = {r["doc_id"]: r for r in neardup.near_duplicates(docs_of(spark, texts), width, 80).collect()}
    for i, (n, c) in enumerate(brute_components(texts, width, 80)):
        assert (got[i]["n_shingles"], got[i]["component_id"], got[i]["kept"]) == (n, c, c == i), i
    assert neardup.near_duplicates(docs_of(spark, texts).limit(0), width, 80).collect() == []


@pytest.mark.parametrize("block", [4, 16, 2048])
def test_pieces_of_divided_regions_lose_no_link(block):
    r = random.Random(block)
    base = set(range(100))
    rows = []
    for k in range(60):
        own = sorted({x if r.random() > (k % 5) * 0.04 else 1000 + r.randrange(10**6) for x in base})[: 100 - k % 20]
        rows.append((0, k // 2, k, k > 5, np.array(own, np.uint64).tobytes()))
    sets = [set(np.frombuffer(x[4], np.uint64).tolist()) for x in rows]

    def linked(i, j):
        both = len(sets[i] & sets[j])
        return 100 * both >= 80 * (len(sets[i]) + len(sets[j]) - both)

    def roots(links):
        root = {k // 2: k // 2 for k in range(60)}

        def find(x):
            while root[x] != x:
                x = root[x]
            return x

        for i, j in links:
            root[find(i // 2)] = find(j // 2)
        return {frozenset(k for k in root if find(k) == find(x)) for x in root}

    want = roots([(i, j) for i in range(60) for j in range(i) if linked(i, j) and (i > 5 or j > 5)])
    pieces = [rows[i : i + block] for i in range(0, 60, block)]
    got = []
    for a, x in enumerate(pieces):
        got += neardup.links_of(x, 80)
        for y in pieces[a + 1 :]:  # both directions, as the first piece has rows that do not ask
            got += neardup.links_of([*x, *((1, *row[1:]) for row in y)], 80) + neardup.links_of([*y, *((1, *row[1:]) for row in x)], 80)
    assert all(linked(i, j) for i, j in got) and roots(got) == want


def test_divided_regions_in_small_blocks(spark):
    texts = near_copies(80, 7) + [" ".join(words_of(60, 7)[:40] + words_of(20, s)) for s in range(40)]
    got = sorted((r["doc_id"], r["component_id"]) for r in neardup.near_duplicates(docs_of(spark, texts), 2, 80, block=6).collect())
    assert got == [(i, c) for i, (_, c) in enumerate(brute_components(texts, 2, 80))]


def test_region_members_do_not_depend_on_batches(spark):
    r = random.Random(3)
    rows = sorted({(r.randrange(40), r.randrange(3), k) for k in range(120)})
    df = spark.createDataFrame(rows, "region long, deeper long, cid long").coalesce(1)
    seen = []
    for size in ("1", "2", "7", "1000"):
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", size)
        seen.append(sorted(map(tuple, neardup.region_members(df).collect()), key=str))
    spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert all(x == seen[0] for x in seen)
    where = {c: (g, d) for g, d, c in rows}
    groups = {}
    for g, d, c in rows:
        groups.setdefault(g, []).append(c)
    assert len(seen[0]) == sum(len(g) for g in groups.values() if len(g) > 1)
    for g, c, one, one_depth, two, _ in seen[0]:
        at = groups[g].index(c)
        assert (one, two) == (groups[g][at - 1] if at else None, groups[g][at - 2] if at > 1 else None)
        assert one is None or one_depth == neardup.DEPTH + (4 if where[one][1] == where[c][1] else 3)


def test_dropping_keeps_columns_of_any_name(spark):
    docs = docs_of(spark, [*near_copies(6, 2), "x y z", None]).withColumn("_row", F.lit("a")).withColumn("_fp", F.lit("b")).withColumn("_kept", F.lit("c"))
    got = neardup.drop_near_duplicates(docs, 2, 80)
    assert got.columns == docs.columns and {(r["_row"], r["_fp"], r["_kept"]) for r in got.collect()} == {("a", "b", "c")}


def test_dropping_near_duplicates_with_null_and_repeated_ids(spark):
    a, b, c = (" ".join(words_of(60, seed)) for seed in (11, 12, 13))
    ids = [1, None, None, None, 5, 5, 5, 5, 6, None, None, 7]
    texts = [a, a + " more", b, b, "", "", None, c, c + " more", None, "  ", c]
    got = [(r["doc_id"], r["text"]) for r in neardup.drop_near_duplicates(docs_of(spark, texts, ids=ids).repartition(3)).collect()]
    want = [(1, a), (None, b), (5, ""), (5, ""), (5, None), (5, c), (None, None), (None, "  ")]
    assert sorted(got, key=str) == sorted(want, key=str)


def test_components(spark):
    r = random.Random(4)
    links = [(r.randrange(300), r.randrange(300)) for _ in range(200)] + [(i, i + 1) for i in range(400, 500)]
    comp = {}

    def find(x):
        while comp.setdefault(x, x) != x:
            x = comp[x]
        return x

    for a, b in links:
        x, y = find(a), find(b)
        comp[max(x, y)] = min(x, y)
    got = {x["node"]: x["component"] for x in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {x: find(x) for a, b in links if a != b for x in (a, b)}


# --- repeats


def brute_repeats(texts, length):
    seen, out = set(), []
    for t in texts:
        b = (t or "").encode()
        gone = np.zeros(len(b) + 1, int)
        for i in range(len(b) - length + 1):
            s = b[i : i + length]
            if s in seen:
                gone[i] += 1
                gone[i + length] -= 1
            seen.add(s)
        mask = np.cumsum(gone)[: len(b)] > 0
        spans = int((np.diff(np.concatenate([[0], mask.astype(int)])) == 1).sum())
        out.append((len(b), int(mask.sum()), spans, bytes(x for x, m in zip(b, mask) if not m)))
    return out


@pytest.mark.parametrize("group_rows", [2, 20_000])
def test_repeats_equal_brute_force(spark, group_rows):
    r = random.Random(9)
    passage = " ".join(words_of(60, 5))
    texts = HARD + near_copies(25, 3) + [" ".join(words_of(r.randrange(80), s)) + passage[r.randrange(50) : 250 + r.randrange(90)] + " ".join(words_of(20, s + 100)) for s in range(30)]
    got = {x["doc_id"]: x for x in repeats.remove_repeats(docs_of(spark, texts), group_rows=group_rows).collect()}
    for i, want in enumerate(brute_repeats(texts, 100)):
        assert (got[i]["n_bytes"], got[i]["n_removed"], got[i]["n_spans"], bytes(got[i]["kept"])) == want, i


def test_repeats_with_null_and_repeated_ids(spark):
    t = " ".join(words_of(60, 5))
    docs = docs_of(spark, [t, t, t + "x", None], ids=[3, 3, None, None])
    got = [(x["doc_id"], x["n_removed"]) for x in repeats.remove_repeats(docs).collect()]
    assert sorted(got, key=str) == sorted([(3, len(t)), (3, len(t)), (None, 0), (None, 0)], key=str)
    assert repeats.remove_repeats(docs.limit(0)).collect() == []


def test_repeats_do_not_depend_on_how_later_scans_cut_the_input(spark, tmp_path, monkeypatch):
    text = " ".join(words_of(40, 3))
    for i in range(6):
        docs_of(spark, [text], ids=[i]).coalesce(1).write.mode("append").parquet(str(tmp_path))
    names = ("maxPartitionBytes", "openCostInBytes", "minPartitionNum")
    before = {n: spark.conf.get(f"spark.sql.files.{n}", None) for n in names}

    def cut(*values):
        for n, v in zip(names, values):
            spark.conf.set(f"spark.sql.files.{n}", v)

    written = repeats.materialize

    def materialize(df, tag):
        out = written(df, tag)
        cut("4096", "4096", "6")  # from now on each file is a task of its own
        return out

    monkeypatch.setattr(repeats, "materialize", materialize)
    try:
        cut("128m", "0", "1")  # at first all files are one task
        docs = spark.read.parquet(str(tmp_path)).select(F.col("doc_id").alias("key"), F.col("text"))
        assert docs.rdd.getNumPartitions() == 1
        marked = {r["key"] for r in repeats.find_marks(docs).collect()}
    finally:
        for n, v in before.items():
            spark.conf.unset(f"spark.sql.files.{n}") if v is None else spark.conf.set(f"spark.sql.files.{n}", v)
    assert marked == {1, 2, 3, 4, 5}


def test_maximal_repeats_with_all_occurrences():
    found = dict(repeats.maximal_repeats([b"xabcdey", b"zabcdeq", b"bcdzz"], 3))
    assert sorted(found[5]) == [(0, 1), (1, 1)] and sorted(found[3]) == [(0, 2), (1, 2), (2, 0)] and len(found) == 2


# --- neighbours


def test_neighbours_recall_and_edges(spark):
    r = np.random.RandomState(2)
    base = r.normal(size=(1200, 16))
    rows = [(i, [float(x) for x in v], 0) for i, v in enumerate(base)] + [(2000 + i, [float(x) for x in base[7]], 0) for i in range(300)]
    rows += [(5000, None, 0), (5020, [float("nan")] * 16, 0), (5040, [0.0] * 16, 0), (5060, [1.0], 0), (None, [1.0] * 16, 0)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    got = {}
    for x in ann.nearest(df, 20, 20, shard_rows=600).collect():
        got.setdefault(x["query_id"], []).append((x["rank"], x["vec_id"], x["score"]))
    ids = np.array([x[0] for x in rows[:1500]])
    vecs = np.array([x[1] for x in rows[:1500]])
    hit = 0
    queries = [i for i in range(1500) if ids[i] % 20 == 0]
    assert set(got) == {int(ids[i]) for i in queries}
    for i in queries:
        s = vecs @ vecs[i]
        order = [k for k in np.lexsort((ids, -np.round(s, 9))) if k != i][:20]
        mine = sorted(got[ids[i]])
        assert [m[0] for m in mine] == list(range(1, 21)) and all(a[2] >= b[2] - 1e-12 for a, b in zip(mine, mine[1:]))
        hit += len({m[1] for m in mine} & {int(ids[k]) for k in order})
    assert hit / (20 * len(queries)) >= 0.9
    assert len(ann.nearest(df.filter("vec_id < 3"), 20, 1).collect()) == 6
    assert ann.nearest(df.limit(0)).collect() == []


# --- URL filter


def test_url_filter_as_of_fetch_time(spark):
    day = lambda d: f"2024-01-{d:02d} 00:00:00"
    caps = [(1, "http://a.b.com/x", day(1)), (2, "http://a.b.com/x", day(3)), (3, "http://a.b.com/x", day(6)), (4, "http://z.b.com/en/q", day(3)), (5, None, day(3)), (6, "junk", None)]
    entries = [("block", "b.com", "add", day(2)), ("block", "b.com", "remove", day(5)), ("allow", "z.b.com", "add", day(1)), ("block", None, "add", day(1))]
    c = spark.createDataFrame(caps, "page_id long, url string, t string").select("page_id", "url", F.col("t").cast("timestamp").alias("fetched_at"))
    e = spark.createDataFrame(entries, "list string, rule string, action string, t string").select("list", "rule", "action", F.col("t").cast("timestamp").alias("effective_at"))
    got = {r["page_id"]: (r["n_block"], r["n_allow"], r["blocked"]) for r in urlfilter.filter_urls(c, e).collect()}
    assert got == {1: (0, 0, False), 2: (1, 0, True), 3: (0, 0, False), 4: (1, 1, False), 5: (0, 0, False), 6: (0, 0, False)}


# --- classifiers


@pytest.mark.parametrize("name, label, modulus, held", [("op2_byte_cnn_quality", "quality", 5, 0), ("op7_lexicon_toxicity", "toxic", 4, 2)])
def test_held_out_accuracy(spark, name, label, modulus, held):
    sf = "/root/testdata/sf0.01"
    got = {r["doc_id"]: r for r in registry.QUERIES[name](spark, sf).collect()}
    y = {r["doc_id"]: r[label] for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    rows = [i for i in got if zlib.crc32(str(i).encode()) % modulus == held]
    assert all(got[i]["held_out"] == (i in set(rows)) for i in list(got)[:200])
    right = [got[i]["predicted"] == y[i] for i in rows if i in y]
    assert len(got) == 1000 and sum(right) / len(right) >= 0.9


def test_features_do_not_depend_on_the_piece_size():
    net = quality.ByteCNN()
    for text in ("", "a", "b" * 511, "cd" * 5000, "x y " * 60_000):
        raw = net.bytes_of(text)
        pooled, _ = net.chunks(raw)
        assert np.allclose(net.features(raw), np.concatenate([pooled.mean(0), pooled.max(0)]), atol=1e-4)


def test_folding_and_exceptions():
    assert toxicity.fold("Ѕсum 1d10t, 2024 mоrоn!") == " scum idiot 2024 moron "
    lex = toxicity.Lexicon({" scum ": 2.0}, {" pond scum ": 2.0})
    assert lex.features(toxicity.fold("pond scum"))[0] == 0 and lex.features(toxicity.fold("you scum"))[0] == 1
    assert toxicity.Lexicon({}).score(None) == toxicity.Lexicon({}).score("")


def test_scores_of_hard_texts(spark):
    docs = docs_of(spark, HARD).withColumn("score", F.lit("clash"))
    got = toxicity.with_score(docs, toxicity.Lexicon({" scum ": 2.0})).collect()
    assert len(got) == len(HARD) and all(0 <= r["score"] <= 1 for r in got)
    got = quality.score_quality(docs, quality.ByteCNN()).collect()
    assert len(got) == len(HARD) and all(0 <= r["score"] <= 1 for r in got)
    assert isinstance(docs.schema["score"].dataType, T.StringType)


def test_pipeline_stages(spark, sf):
    import corpus_pipeline

    docs = spark.read.parquet(f"{sf}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES[:4]:
        out = stage(spark, docs, sf)
        assert out.columns == docs.columns, name
        if name == "near-duplicates":
            kept = sorted(r["doc_id"] for r in out.collect())
            ids = sorted((r["doc_id"], r["text"]) for r in docs.collect())
            comp = brute_components([t for _, t in ids], 5, 80)
            assert kept == [i for k, (i, _) in enumerate(ids) if comp[k][1] == k]
        docs = out
    placed = corpus_pipeline.STAGES[4][1](spark, docs, sf)
    assert placed.columns == [*docs.columns, "shard", "slot"]
    rows = placed.select("shard", "slot").distinct().count()
    assert rows == docs.count()
