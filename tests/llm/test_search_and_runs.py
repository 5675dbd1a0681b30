"""Ranked search, n-gram join and periodic runs against brute force, and their edge cases."""

import hashlib
import math
import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from corpusloom.llm import lexical, ngramjoin, runs
from corpusloom.llm.wordscan import LETTERS, SPACED, slices, words_of

HARD = [None, "", " \t\n", "one", "a b", "ünï © 漢字 " * 3, "x" * 5000, "the same text again and again " * 40]
DOCS = "doc_id long, text string, item string, score string, row string"


def docs_of(spark, texts, ids=None):
    """Documents with columns whose names clash with those of the operators."""
    return spark.createDataFrame([(i, t, "x", "y", "z") for i, t in zip(ids or range(len(texts)), texts)], DOCS)


def long_text(n, seed, vocabulary=300):
    r = random.Random(seed)
    return " ".join(f"w{r.randrange(vocabulary)}" for _ in range(n))


# --- words of columns


@pytest.mark.parametrize("inside, pattern", [(SPACED, rb"[^\x20\x09-\x0D]+"), (LETTERS, rb"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")])
def test_words_are_those_of_the_pattern(inside, pattern):
    texts = [*HARD, "Ab aB\x00c\x1cd 9.5", "ÄB äb", "y" * 47 + " " + "y" * 48 + " " + "Y" * 49 + "\n" + "y" * 49]
    column = pa.array(["skipped", *texts])[1:]
    found = words_of(column, inside, folded=True)
    for i, t in enumerate(texts):
        want = re.findall(pattern, (t or "").encode())
        assert found.texts(int(found.bounds[i]), int(found.bounds[i + 1])) == want
    every = [(w.lower(), h) for t, lo, hi in zip(texts, found.bounds, found.bounds[1:]) for w, h in zip(re.findall(pattern, (t or "").encode()), found.hashes[lo:hi].tolist())]
    assert len(set(every)) == len({w for w, _ in every}) == len({h for _, h in every})


def test_slices_hold_all_rows_and_whole_texts():
    batch = pa.record_batch({"text": pa.array([None, "a" * 10, "b" * 200, "", "c"])})
    assert [t for s in slices(batch, "text", 50) for t in s.column("text").to_pylist()] == batch.column("text").to_pylist()
    assert len(list(slices(batch, "text", 50))) > 1


# --- ranked search


def ranked(docs, items, k):
    """Brute force: docs and items are (id, text) rows."""
    cut = lambda t: re.findall(rb"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", (t or "").encode().lower())
    held = [(i, Counter(cut(t))) for i, t in docs]
    held = [(i, c) for i, c in held if c]
    n, total = len(held), sum(sum(c.values()) for _, c in held)
    df = Counter(w for _, c in held for w in c)
    asked = {}
    for item, t in items:
        asked.setdefault(item, set()).update(cut(t))
    out = []
    for item, terms in asked.items():
        scored = []
        for i, c in held:
            m = 50 + 50 * sum(c.values()) * n // total
            s = sum(math.floor(1000 * math.log((2 * n + 2) / (2 * df[w] + 1))) * (10**9 * c[w] // (1000 * c[w] + 20 * m)) for w in terms if c[w])
            if s > 0:
                scored.append((-s, i is None, i or 0))
        out += [(item, r, None if none else i, -s) for r, (s, none, i) in enumerate(sorted(scored)[:k], 1)]
    return sorted(out, key=str)


def searched(docs, items, **more):
    return sorted(map(tuple, lexical.search(docs, items, "item_id", **more).collect()), key=str)


def test_search_is_exact(spark, monkeypatch):
    monkeypatch.setattr(lexical, "TOP", 5)
    r = random.Random(3)
    texts = [long_text(r.randrange(1, 60), s, 40 + s % 90) for s in range(400)] + HARD + [long_text(20000, 9)]
    texts += texts[:30]  # repeated texts tie
    ids = [None if k % 50 == 7 else k // 2 for k in range(len(texts))]  # repeated and null ids
    items = [(1, long_text(12, 700, 60)), (1, "w1 w2"), (None, "w3 W5"), (2, ""), (3, None), (4, "absent"), (5, long_text(300, 701))]
    docs, asked = docs_of(spark, texts, ids), spark.createDataFrame(items, "item_id long, text string")
    want = ranked(list(zip(ids, texts)), items, 5)
    assert searched(docs, asked, k=5) == want
    assert searched(docs.repartition(7), asked, k=5, block_terms=20) == want
    assert searched(docs, asked, k=5, limited=False) == want
    assert searched(docs, asked, k=1000) == ranked(list(zip(ids, texts)), items, 1000)


def test_accumulators_are_limited():
    vocabulary_texts = [f"rare{i}" if i < 6 else "common " * (i % 3 + 1) for i in range(300)]
    hashes = words_of(pa.array(["rare0 rare1 rare2 rare3 rare4 rare5 common"]), LETTERS, True).hashes
    vocabulary = np.unique(hashes)
    found = lexical.Postings(vocabulary, pa.array(vocabulary_texts))
    scores = np.where(np.repeat(np.arange(7), np.diff(found.begins)) == np.searchsorted(vocabulary, hashes[-1]), 1, 1000)
    tops = np.array([scores[lo:hi].max() for lo, hi in zip(found.begins, found.begins[1:])])
    terms = np.argsort(np.diff(found.begins), kind="stable")
    rows, exact = lexical.search_block(found, scores, tops, terms, lexical.Best(5))
    assert sorted(rows.tolist()) == [0, 1, 2, 3, 4, 5] and set(exact.tolist()) == {1000}  # no accumulator for the 294 others
    assert len(lexical.search_block(found, scores, tops, terms, lexical.Best(5), limited=False)[0]) == 300


def test_search_of_nothing(spark):
    none = docs_of(spark, []), spark.createDataFrame([], "item_id long, text string")
    some = docs_of(spark, ["a b"]), spark.createDataFrame([(1, "a")], "item_id long, text string")
    assert searched(none[0], some[1]) == searched(some[0], none[1]) == searched(*none) == searched(docs_of(spark, [None, ""]), some[1]) == []
    assert searched(*some)[0][:3] == (1, 1, 0)


# --- n-gram join


def grams(text, width):
    w = (text or "").encode().lower().split()
    return {tuple(w[i : i + width]) for i in range(len(w) - width + 1)} if len(w) >= width else {tuple(w)} if w else set()


def linked(texts, width, percent):
    sets = [grams(t, width) for t in texts]
    return {(i, j) for i in range(len(sets)) for j in range(i) if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= percent * len(sets[i] | sets[j])}


def components(texts, links):
    root = list(range(len(texts)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, j in sorted(links):
        a, b = find(i), find(j)
        root[max(a, b)] = min(a, b)
    return [find(i) for i in range(len(texts))]


def copies(count, seed, words=60):
    r = random.Random(seed)
    base = [f"b{seed}x{r.randrange(400)}" for _ in range(words)]
    out = []
    for k in range(count):
        w = list(base)
        for _ in range(k % 5):
            w[r.randrange(len(w))] = f"e{r.randrange(10**6)}"
        out.append(" ".join(w))
    return out


@pytest.mark.parametrize("percent, piece", [(85, 2048), (85, 3), (60, 5)])
def test_join_components_and_links(spark, percent, piece):
    texts = [*copies(25, 1), *copies(12, 2, 130), *HARD, *HARD, *copies(9, 3, 7), long_text(15000, 5, 5000), long_text(15000, 5, 5000) + " end", "A b C d", "a B c D"]
    docs = docs_of(spark, texts)
    want = components(texts, linked(texts, 4, percent))
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in ngramjoin.ngram_components(docs, 4, percent, piece).collect()}
    assert got == {i: (len(grams(t, 4)), want[i]) for i, t in enumerate(texts)}
    members, links = ngramjoin.class_links(docs, 4, percent, piece)
    of = {r["doc_id"]: r["class"] for r in members.collect()}
    found = {frozenset((r["a"], r["b"])) for r in links.collect()}
    assert links.count() == len(found)
    assert found == {frozenset((of[i], of[j])) for i, j in linked(texts, 4, percent) if of[i] != of[j]}
    assert all((of[i] == of[j]) == (grams(texts[i], 4) == grams(texts[j], 4)) for i in of for j in of if of[i] is not None and of[j] is not None)


def test_join_of_null_and_repeated_ids(spark):
    text = copies(1, 4)[0]
    docs = docs_of(spark, [text, text + " more", text, "alone in the world", None, None], [None, 7, 7, None, 5, None])
    got = sorted(map(tuple, ngramjoin.ngram_components(docs, 4, 85).collect()), key=str)
    assert [(r[0], r[2]) for r in got] == [(5, 5), (7, 7), (7, 7), (None, None), (None, None), (None, 7)] or sorted((str(r[0]), str(r[2])) for r in got) == sorted([("5", "5"), ("7", "7"), ("7", "7"), ("None", "7"), ("None", "None"), ("None", "None")])
    assert ngramjoin.ngram_components(docs_of(spark, []), 4, 85).collect() == []


def test_positional_filter_never_drops_a_link():
    r = random.Random(8)
    for _ in range(300):
        a = {r.randrange(60) for _ in range(r.randrange(1, 40))}
        b = {x for x in a if r.random() < 0.95} | {r.randrange(60) for _ in range(r.randrange(3))}
        if not b or 100 * len(a & b) < 80 * len(a | b):
            continue
        sets = [np.array(sorted(s), np.uint64) << np.uint64(44) for s in (a, b)]
        counts = np.array([r.randrange(9) for _ in range(64)] + [0] * (ngramjoin.COUNTERS - 64))
        p, q = (ngramjoin.prefix_of(s, counts, 80).tolist() for s in sets)
        first = next((i, q.index(g)) for i, g in enumerate(p) if g in q)
        assert min(len(a) - first[0], len(b) - first[1]) >= -(-80 * (len(a) + len(b)) // 180)


def test_lists_keep_only_what_may_link(spark):
    words = [f"w{k}" for k in range(50)]
    near = [" ".join(words[:40]), " ".join(words[:42])]  # 37 and 39 n-grams: of the four lists that they share, the last leaves too little
    unlike = [" ".join(words[:40]), " ".join(words), " ".join(words[37:])]  # 37, 47 and 10 n-grams, each in two texts
    assert ngramjoin.Prepared(docs_of(spark, near), 4, 85).lists.count() == 2 * 3
    assert ngramjoin.Prepared(docs_of(spark, unlike), 4, 85).lists.count() == 0


@pytest.mark.parametrize("percent", [60, 85])
def test_pairable_rows_against_all_pairs(percent, monkeypatch):
    monkeypatch.setattr(ngramjoin, "LONG", 12)
    r = random.Random(percent)
    rows = np.array(sorted((g - 60, r.randrange(40), r.randrange(1, 60), c) for g in range(120) for c in range(r.choice([1, 1, 2, 3, 12, 13, 40]))))
    rows = rows[:, [0, 3, 2, 1]].T.copy()  # gram, cid, n, place
    rows[3] = np.minimum(rows[3], rows[2] - 1)

    def meets(x, y):
        (n, p), (m, q) = (tuple(rows[2:, k].tolist()) for k in (x, y))
        return 100 * min(n, m) >= percent * max(n, m) and min(n - p, m - q) >= -(-percent * (n + m) // (100 + percent))

    lists = {g: np.flatnonzero(rows[0] == g).tolist() for g in rows[0].tolist()}
    want = [x for own in lists.values() for x in own if len(own) > 12 or any(x != y and meets(x, y) for y in own)]
    for step in (1, 7, 30, 10000):
        got = np.concatenate(list(ngramjoin.pairable_rows((rows[:, k : k + step] for k in range(0, rows.shape[1], step)), percent)), axis=1)
        assert got.T.tolist() == rows[:, sorted(want)].T.tolist()


def test_first_join_names_the_lists_it_leaves_untold(spark):
    """A class that may link with two of a component tells one and the list; lists told whole are not joined again."""
    ready = ngramjoin.Prepared(docs_of(spark, [*copies(25, 1), *copies(12, 2, 130)]), 4, 60)
    cids = [r["cid"] for r in ready.classes.orderBy("first_id").collect()]
    label = spark.createDataFrame([(c, cids[0]) for c in cids[:3]], "node long, component long")
    told = ngramjoin.pairs_between(ready.lists, ready.heads, label, 60, 3, True)
    whole = {(r["a"], r["b"]) for r in ngramjoin.pairs_between(ready.lists, ready.heads, label, 60, 3).collect()}
    pairs, left = {(r["a"], r["b"]) for r in told.filter("gram is null").collect()}, told.filter("gram is not null").select("gram")
    assert pairs < whole and 0 < left.count() < ready.lists.select("gram").distinct().count()
    again = ngramjoin.pairs_between(ready.lists.join(left, "gram", "left_semi"), ready.heads, label, 60, 3).collect()
    assert pairs | {(r["a"], r["b"]) for r in again} == whole


def test_what_follows_a_place():
    r = np.random.RandomState(3)
    for n in (1, 30, 900):
        grams = r.randint(0, 1 << 60, n).astype(np.uint64) & ~np.uint64(0xF0)  # few parts, so that some are full
        whole = np.frombuffer(ngramjoin.parts_of(grams), np.uint8)
        places = np.unique(r.randint(0, n, 9))
        for place, rest in zip(places, ngramjoin.left_from(places, whole, grams)):
            less = np.bincount((grams[:place] & np.uint64(255)).astype(np.int64), minlength=256)
            assert rest.tolist() == np.where(whole == 255, 255, whole - less).tolist()


# --- periodic runs


def brute_runs(words):
    found = {}
    for q in range(1, len(words) // 4 + 1):
        i = 0
        while i + q < len(words):
            j = i
            while j + q < len(words) and words[j] == words[j + q]:
                j += 1
            if j > i and j - i + q >= max(6, 4 * q):
                found.setdefault((i, j - i + q), q)
            i = j + 1
    return sorted((s, n, q) for (s, n), q in found.items())


def periodic(seed):
    r = random.Random(seed)
    out = []
    while len(out) < 120 + seed:
        q = r.choice([1, 1, 2, 3, 5, 8, 13, 21])
        block = [r.choice("abc") for _ in range(q)]
        out += (block * 9)[: r.randrange(1, 7 * q + 2)]
        out += [r.choice("abcdef") for _ in range(r.randrange(4))]
    return " ".join(out)


def test_runs_are_all_maximal_repetitions(spark):
    texts = [*map(periodic, range(60)), *HARD, "a " * 3000, " ".join(["a"] * 5), " ".join(["a"] * 6), "ab cd " * 2000 + "ab", long_text(20000, 1, 5), " ".join(f"w{i % 997}" for i in range(9000))]
    _, found = runs.periodic_runs(docs_of(spark, texts))
    rows = {r["row"]: r["doc_id"] for r in runs.periodic_runs(docs_of(spark, texts))[0].collect()}
    got = {}
    for r in found.collect():
        got.setdefault(rows[r["row"]], []).append((r["start"], r["length"], r["period"]))
    for i, t in enumerate(texts):
        w = (t or "").split()
        if len(w) <= 9000:
            assert sorted(got.get(i, [])) == brute_runs(w), i
    assert got[texts.index("a " * 3000)] == [(0, 3000, 1)]


def test_run_report(spark):
    texts = [*map(periodic, range(12)), *HARD]
    report = {r["doc_id"]: r for r in runs.run_report(docs_of(spark, texts)).collect()}
    for i, t in enumerate(texts):
        w, found, r = (t or "").split(), brute_runs((t or "").split()), report[i]
        assert r["n_runs"] == len(found)
        best = min(found, key=lambda x: (-x[1] / x[2], x[0], x[2]), default=None)
        assert (r["start"], r["length"], r["period"]) == (best or (None,) * 3)
        assert r["exponent_milli"] == (1000 * best[1] // best[2] if best else None)
        assert r["runs_sha256"] == hashlib.sha256("".join(f"{s},{n},{q}\n" for s, n, q in sorted(found, key=lambda x: (x[0], x[2]))).encode()).hexdigest()
        kept = [x for k, x in enumerate(w) if not any(s + q <= k < s + n for s, n, q in found)]
        assert r["collapsed_sha256"] == hashlib.sha256(" ".join(kept).encode()).hexdigest()
    assert runs.run_report(docs_of(spark, [])).collect() == []
    twice = runs.run_report(docs_of(spark, ["a " * 9, "a " * 9, "b"], [None, None, None]), runs.planted).collect()
    assert sorted(r["n_runs"] for r in twice) == [0, 1, 1]


def test_planted_end_is_periodic():
    for doc_id in range(400):
        place = runs.planted(doc_id, 97)
        if place is not None:
            g = __import__("zlib").crc32(str(doc_id).encode()) // 10
            a = g % 97
            p = 1 + (97 - a) // (3 + g % 8)
            assert place.tolist() == [i if i < a else a + (i - a) % p for i in range(97)]


def test_z_function():
    for text in ("", "a", "aaaa", "abacaba", "abcabcab"):
        z = runs.z_function(list(text))
        assert z == [next(k for k in range(len(text) - i, -1, -1) if text[:k] == text[i : i + k]) for i in range(len(text))]


def test_documents_columns_are_kept_apart(spark):
    docs = docs_of(spark, ["a a a a a a a", "b"]).withColumnRenamed("item", "start").withColumn("found", F.lit(1))
    assert sorted(r["n_runs"] for r in runs.run_report(docs).collect()) == [0, 1]
