"""Edge cases of the corpus operators: nulls, repeats, long texts, empty tables and clashing names; naive twins of their inner parts."""

import random
import time

import numpy as np
import pytest
from pyspark.sql import functions as F

from corpusloom.llm import ann, decontaminate, learning, mixing, quality, repeats, sharding, toxicity, urlfilter

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
LABELS = "doc_id long, quality int, toxic int"


def docs_of(spark, rows):
    return spark.createDataFrame([(i, t, "en", s, len(t or "")) for i, t, s in rows], DOCS)


# --- URL filter


@pytest.mark.parametrize("small_list", [200_000, 0])
def test_repeated_captures_are_judged_each(spark, small_list):
    caps = [(1, "http://a.b.com/x", "2024-01-03", "q")] * 2 + [(None, None, None, "q"), (2, "http://c.d.net/", "2024-01-03", "q")]
    c = spark.createDataFrame(caps, "page_id long, url string, t string, rule string").withColumn("fetched_at", F.to_timestamp("t"))
    entries = [("block", "b.com", "add", "2024-01-02"), ("block", "a.b.com", "add", "2024-01-01"), ("allow", "d.net", "add", "2024-01-01")]
    e = spark.createDataFrame(entries, "list string, rule string, action string, t string").withColumn("effective_at", F.to_timestamp("t"))
    got = sorted((r["page_id"] or 0, r["n_block"], r["n_allow"], r["first_rule"], r["blocked"]) for r in urlfilter.filter_urls(c, e, small_list).collect())
    assert got == [(0, 0, 0, None, False), (1, 2, 0, "a.b.com", True), (1, 2, 0, "a.b.com", True), (2, 0, 1, None, False)]
    assert urlfilter.filter_urls(c.limit(0), e, small_list).collect() == []
    assert not any(r["blocked"] for r in urlfilter.filter_urls(c, e.limit(0), small_list).collect())


# --- classifiers


def test_convolution_against_loops():
    net = quality.ByteCNN(3)
    net.bias[:] = 0.1
    r = random.Random(2)
    for n in (0, 1, 4, 255, 256, 257, 600, 1300):
        raw = net.bytes_of("".join(chr(r.randrange(32, 300)) for _ in range(n)))
        out = [[sum(float(net.table[j][raw[i + j]][f]) for j in range(quality.KERNEL)) for f in range(quality.FILTERS)] for i in range(len(raw) - quality.KERNEL + 1)]
        half, pooled, s = quality.CHUNK // 2, [], 0
        while True:
            part = out[s : s + quality.CHUNK]
            pooled.append([max(0.0, max(row[f] for row in part) + float(net.bias[f])) for f in range(quality.FILTERS)])
            s += half
            if s + half >= len(out):
                break
        pooled = np.array(pooled)
        assert np.allclose(net.features(raw), np.concatenate([pooled.mean(0), pooled.max(0)]), atol=1e-4), n


def test_classifiers_without_labels_or_rows(spark):
    docs = docs_of(spark, [(1, "a", "s"), (None, None, "s"), (1, "", "s")])
    none = spark.createDataFrame([], LABELS)
    assert [r["score"] for r in quality.score_quality(docs, quality.fit_quality(docs, none)).collect()] == [0.5] * 3
    assert all(r["score"] < 0.01 for r in toxicity.with_score(docs, toxicity.fit_toxicity(docs, none)).collect())
    assert quality.score_quality(docs.limit(0), quality.ByteCNN()).collect() == []
    assert toxicity.drop_toxic(docs.limit(0), toxicity.Lexicon({" a ": 1.0})).collect() == []


def test_training_texts_come_whole_within_their_bounds(spark):
    rows = [(i, f"{i} " + "x" * 50_000, "s") for i in range(20)] + [(3, "other", "s"), (3, "other", "s"), (99, None, "s")]
    labels = spark.createDataFrame([(i, 1, i % 2) for i in range(20)] + [(99, 1, 1), (5, 1, None)], LABELS)
    texts, y = learning.training_texts(docs_of(spark, rows), labels, "toxic", F.lit(True), 1000)
    assert len(texts) == 21 == len(y) and all(t == "other" or len(t) > 50_000 for t in texts)
    assert len(learning.training_texts(docs_of(spark, rows), labels, "toxic", F.lit(True), 7)[0]) in (6, 7)  # a label may have no text
    few = learning.training_texts(docs_of(spark, rows), labels, "toxic", F.lit(True), 1000, 160_000)[0]
    assert 3 <= len(few) <= 4 and sum(map(len, few)) <= 160_000


def test_matching_against_plain_counting():
    r = random.Random(7)
    for _ in range(300):
        words = ["".join(r.choice("ab") for _ in range(r.randrange(1, 5))) for _ in range(r.randrange(0, 12))]
        folded = " " + " ".join(words) + " "
        weights = {f" {w}{e}": float(r.randrange(1, 9)) for w, e in [("a", " "), ("ab", ""), ("ba", ""), ("b", " ")] if r.random() < 0.7}
        phrases = {f" {a} {b} " for a in ("a", "ab") for b in ("b", "ba") if r.random() < 0.4}
        excused = [(i, i + len(p)) for p in phrases for i in range(len(folded)) if folded.startswith(p, i)]
        want = sum(w for k, w in weights.items() for i in range(len(folded)) if folded.startswith(k, i) and not any(a <= i and i + len(k) <= b for a, b in excused))
        assert toxicity.Lexicon(weights, phrases).total(folded) == pytest.approx(want)


def test_folding_takes_time_in_proportion():
    lexicon = toxicity.Lexicon({" scum ": 1.0})
    for text in ("x" * 1_000_000, "a1" * 500_000, "a!" * 500_000, "1" * 1_000_000, "é$" * 500_000):
        began = time.perf_counter()
        lexicon.score(text)
        assert time.perf_counter() - began < 2
    assert toxicity.fold("m0r0n!! 5cum sc@m covid19 2024 mp3") == " moron scum scam covid19 2024 mp3 "


def test_dropping_toxic_keeps_clashing_columns(spark):
    docs = docs_of(spark, [(1, "you scum", "s"), (1, "fine words", "s"), (None, None, "s")]).withColumn("_toxicity", F.lit(9.0))
    kept = toxicity.drop_toxic(docs, toxicity.Lexicon({" scum ": 2.0}, curve=(-4.0, 8.0, 1.0)))
    assert kept.columns == docs.columns and sorted((r["text"] or "", r["_toxicity"]) for r in kept.collect()) == [("", 9.0), ("fine words", 9.0)]


# --- sharding, mixing


def test_sharding_keeps_clashing_columns_null_and_repeated_ids(spark):
    df = docs_of(spark, [(None, "a", "s"), (None, "a", "s"), (1, "b", "s"), (1, None, "s")])
    for c in ("_pid", "_mid", "_row", "_to", "_n", "_offset"):
        df = df.withColumn(c, F.lit(c))
    got = sharding.assign_shards(df, [F.col("doc_id").asc_nulls_first()], 3)
    assert got.columns == [*df.columns, "shard", "slot"] and sorted((r["shard"], r["slot"], r["_pid"], r["_row"]) for r in got.collect()) == [(0, 0, "_pid", "_row"), (0, 1, "_pid", "_row"), (1, 0, "_pid", "_row"), (2, 0, "_pid", "_row")]


def test_every_walk_ends_inside():
    for n in [*range(1, 400), 10**6 + 3, 10**9 + 7, 10**12 + 39]:
        a, b, walk = sharding.grid(n)
        assert a * b >= n and walk == a * b - n + 1 and walk <= 400


def test_equal_rows_are_spread_over_blocks(spark):
    rows = [(None, "same words here", "a")] * 300 + [(7, f"w{k} x", "a") for k in range(40)] + [(k, "t " * (k % 5 + 1), "b") for k in range(60)]
    docs = docs_of(spark, rows).repartition(5)
    units = mixing.numbered_copies(mixing.materialize(mixing.word_sizes(docs), "t"))
    assert units.select("unit").distinct().count() == 400 == units.count()
    again = mixing.numbered_copies(mixing.materialize(mixing.word_sizes(docs.repartition(2)), "t"))
    assert sorted(r["unit"] for r in again.collect()) == sorted(r["unit"] for r in units.collect())
    got = mixing.mix(docs, block=64).collect()
    for source in "ab":
        own = [r for r in got if r["source"] == source]
        assert abs(sum(r["taken"] for r in own) - own[0]["target"]) <= 8
    clash = docs.withColumn("_row", F.lit("r")).withColumn("_copies", F.lit("c")).withColumn("unit", F.lit("u"))
    assert {(r["_row"], r["_copies"], r["unit"]) for r in mixing.apply_mix(clash).collect()} == {("r", "c", "u")}
    assert mixing.apply_mix(clash.limit(0)).collect() == []


def test_flight_agrees_with_a_naive_one_in_expectation():
    p, z = np.array([0.3, 0.6, 0.5, 0.2, 0.9, 0.5]), np.array([5, 3, 8, 2, 7, 1])
    mean = np.mean([mixing.land(mixing.fly(p, z, s), z) for s in range(4000)], axis=0)
    flown = np.mean([mixing.fly(p, z, s) for s in range(4000)], axis=0)
    assert np.abs(flown - p).max() < 0.04 and set(np.unique(mixing.land(mixing.fly(p, z, 1), z))) <= {0.0, 1.0} and np.abs(mean - p).max() < 0.35


# --- decontamination


@pytest.mark.parametrize("block_windows", [3, 250_000])
def test_decontamination_with_map_columns_and_repeated_ids(spark, block_windows):
    item = "one two three four five six seven eight nine ten eleven twelve thirteen fourteen"
    bench = spark.createDataFrame([(1, item), (1, item), (2, "...")], "item_id long, text string")
    docs = docs_of(spark, [(5, f"a {item} b", "s"), (5, "clean words", "s"), (None, item.upper(), "s"), (None, None, "s"), (6, item.replace(" ", "-"), "s")])
    wide = docs.withColumn("m", F.create_map(F.lit("k"), F.lit(1))).withColumn("_row", F.lit("r")).withColumn("n_words", F.lit("clash"))
    kept = decontaminate.drop_contaminated(wide, bench, block_windows=block_windows)
    assert kept.columns == wide.columns and sorted((r["text"] or "", r["_row"], r["n_words"], r["m"]["k"]) for r in kept.collect()) == [("", "r", "clash", 1), ("clean words", "r", "clash", 1)]
    judged = decontaminate.decontaminate(docs, bench, block_windows=block_windows).collect()
    assert sorted((r["n_hit"], r["item_ids"]) for r in judged) == [(0, []), (0, []), (14, ["1"]), (14, ["1"]), (14, ["1"])]
    assert decontaminate.decontaminate(docs.limit(0), bench, block_windows=block_windows).collect() == []
    assert all(r["n_hit"] == 0 for r in decontaminate.decontaminate(docs, bench.limit(0), block_windows=block_windows).collect())


# --- repeats, neighbours


def test_a_very_long_text_and_clashing_columns(spark):
    r = random.Random(1)
    passage = "".join(r.choice("abcdefgh ") for _ in range(400))
    long = "".join(r.choice("abcdefgh ") for _ in range(2_100_000)) + passage
    docs = docs_of(spark, [(1, long, "s"), (2, passage + "tail", "s")]).withColumn("key", F.lit("k")).withColumn("start", F.lit("s"))
    got = {x["doc_id"]: x["n_removed"] for x in repeats.remove_repeats(docs).collect()}
    assert got == {1: 0, 2: 400}


def test_every_vector_of_an_id_is_answered(spark):
    rows = [(20, [1.0, 0.0]), (20, [0.0, 1.0]), (20, [0.0, 1.0]), (1, [0.9, 0.1]), (2, [0.1, 0.9]), (3, [0.9, 0.1]), (4, [1.0, 2.0, 3.0]), (40, [1.0, 1.0, 1.0]), (5, None)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumn("h", F.lit("clash"))
    got = sorted((r["query_id"], r["rank"], r["vec_id"]) for r in ann.nearest(df, 2, 20).collect())
    assert got == [(20, 1, 1), (20, 1, 2), (20, 2, 1), (20, 2, 3), (40, 1, 4)]


def test_neighbours_in_cells_with_bounds(spark):
    r = np.random.RandomState(5)
    centres = r.normal(size=(8, 12)) * 6
    base = np.concatenate([c + r.normal(size=(150, 12)) * 0.3 for c in centres])
    df = spark.createDataFrame([(i, [float(x) for x in v]) for i, v in enumerate(base)], "vec_id long, embedding array<double>")
    got = {}
    for x in ann.nearest(df, 10, 20, shard_rows=160).collect():
        got.setdefault(x["query_id"], []).append((x["rank"], x["vec_id"]))
    hit = 0
    for i in range(0, len(base), 20):
        s = base @ base[i]
        s[i] = -np.inf
        hit += len({v for _, v in got[i]} & set(np.argsort(-s)[:10].tolist()))
        assert [k for k, _ in sorted(got[i])] == list(range(1, 11))
    assert hit >= 0.95 * 10 * len(got)


# --- pipeline


def test_pipeline_on_hard_rows_and_on_none(spark, tmp_path):
    import corpus_pipeline

    r = random.Random(3)
    text = lambda n: " ".join(f"w{r.randrange(500)}" for _ in range(n))
    rows = [(k, text(30), f"s{k % 3}") for k in range(30)] + [(None, None, None), (None, "", "s1"), (4, text(20), None), (4, text(20), "s1")]
    copies = [(90, rows[0][1], "s0"), (90, rows[0][1], "s0"), (None, rows[1][1], "s2")]
    docs = docs_of(spark, rows + copies).withColumn("_row", F.lit("r")).withColumn("_id", F.lit("i")).withColumn("score", F.lit("c"))
    spark.createDataFrame([(k, 1, int(k == 5)) for k in range(12)], LABELS).write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([(1, rows[2][1])], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    for df in (docs, docs.limit(0)):
        df.write.mode("overwrite").parquet(f"{tmp_path}/documents.parquet")
        got = corpus_pipeline.run(spark, str(tmp_path))
        assert got.columns == [*docs.columns, "shard", "slot"]
        out = got.collect()
        assert all((x["_row"], x["_id"], x["score"]) == ("r", "i", "c") and x["text"] != rows[2][1] and x["doc_id"] != 90 for x in out)
        assert bool(out) == bool(df.count())
